import itertools
import re

import cases
from pyspark.sql import functions as F

from tagloom.llm import audit


def brute(docs, labels):
    """Every order filter by filter over (id, text, part) rows and (id, quality, toxic) rows."""
    good, toxic = ({d for d, *m in labels if m[i] == 1 and d is not None} for i in (0, 1))
    least = {}
    for d, t, _ in docs:
        if d is not None:
            least[t or ""] = min(d, least.get(t or "", d))
    rows = []
    for d, t, part in docs:
        t = t or ""
        w = re.findall("[^\x20\x09-\x0d]+", t)
        fails = {
            "A": len(w) < 200,
            "B": 100 * len(set(w)) < 50 * len(w),
            "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t),
            "D": bool(re.search("[#$%&*|]", t)),
            "E": d is not None and least[t] < d,
        }
        rows.append((part or "", {f for f, x in fails.items() if x}, d in good, d in toxic))
    out = set()
    for part in {r[0] for r in rows}:
        mine, total, found = [r for r in rows if r[0] == part], {}, []
        for order in itertools.permutations("ABCDE"):
            left = mine
            for step, f in enumerate(order, 1):
                here = [r for r in left if f in r[1]]
                redundant = sum(f in r[1] for r in mine) - len(here)
                left = [r for r in left if f not in r[1]]
                total[f] = total.get(f, 0) + len(here)
                lost = sum(r[2] for r in here), sum(r[3] for r in here)
                found.append((part, "".join(order), step, len(left), len(here), redundant, sum(r[1] == {f} for r in mine), *lost))
        out |= {(*r, total[r[1][r[2] - 1]]) for r in found}
    return out


def test_hostile_rows(spark, rows):
    docs = cases.frame(spark).withColumn("source", F.when(F.col("lang").isNull(), None).otherwise(F.concat("lang", F.coalesce("source", F.lit("")))))
    docs = docs.selectExpr("*", "1 AS part", "2 AS mask", "'q' AS quality", "3 AS toxic", "5 AS _of")
    marks = [(0, 1, 0), (0, 0, 1), (3, 0, 1), (100, 1, None), (407, 1, 1), (None, 1, 1), (99999, 1, 1), (406, None, None)]
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    plain = [(r.doc_id, r.text, r.source) for r in docs.select("doc_id", "text", "source").collect()]
    got = rows(audit.interactions(docs, labels))
    assert got == brute(plain, marks)
    assert len(got) == 600 * len({p or "" for _, _, p in plain})
    assert audit.interactions(docs.limit(0), labels).count() == 0
    assert rows(audit.interactions(docs, labels.limit(0))) == brute(plain, [])


def test_more_prefixes_than_the_default_row_limit_of_a_recursion(spark):
    cells = spark.range(3200).selectExpr("CAST(id AS STRING) AS part", "INT(id % 32) AS mask", "1L AS n", "0L AS good", "0L AS toxic")
    out = audit.prefixes(cells)
    assert out.count() == 3200 * 325
    assert out.filter("step = 5 AND kept != 1 AND applied = 31").filter("part = '0'").count() == 0
