import pyarrow.parquet as pq
import pytest

import cases
import corpus_pipeline
from tagloom.llm import classifier, decontam, lines, simhash
from tagloom.llm.common import table, written
from tagloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    out = [table(spark, SF, "documents")]
    for name, stage in corpus_pipeline.STAGES:
        out.append(written(stage(spark, out[-1], SF), name))
    return out


def test_columns_and_order(steps):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_classifier", "line_dedup", "simhash_near_dedup", "decontamination", "best_fit_packing",
    ]
    assert all(s.columns == steps[0].columns for s in steps[:5])


def test_every_stage_does_what_its_operator_says(spark, steps):
    ids = [{r.doc_id for r in s.select("doc_id").collect()} for s in steps]
    scored = classifier.classify(steps[0], table(spark, SF, "labels")).collect()
    assert ids[1] == {r.doc_id for r in scored if r.predicted}
    assert ids[2] == ids[1]
    gone = {(r.doc_id, r.line_no) for r in lines.repeated_lines(steps[1]).collect()}
    before = {r.doc_id: r.text for r in steps[1].collect()}
    after = {r.doc_id: r.text for r in steps[2].collect()}
    for d, t in before.items():
        assert after[d] == "\n".join(x for i, x in enumerate(t.split("\n")) if (d, i) not in gone)
    near = simhash.near_duplicates(steps[2]).collect()
    assert ids[3] == {r.component_id for r in near}
    bad = {r.doc_id for r in decontam.contaminated(steps[3], table(spark, SF, "benchmark")).collect()}
    assert ids[4] == ids[3] - bad
    assert ids[5] == ids[4]


def test_verbatim_items_are_gone(spark, steps):
    items = pq.read_table(f"{SF}/benchmark.parquet")["text"].to_pylist()
    assert not [r.doc_id for r in steps[4].collect() if any(i in r.text for i in items)]


def test_run_is_registered():
    import __spark_entry__

    registered = __spark_entry__.queries()
    assert registered["pipeline"] is corpus_pipeline.run
    assert {n.split("_")[0] for n in QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert all(n in registered for n in QUERIES)


def test_items_in_rows_without_id_are_gone(spark):
    item = pq.read_table(f"{SF}/benchmark.parquet")["text"].to_pylist()[0]
    rows = [(None, "well. " + item), (None, "clean"), (None, None), (1, "well. " + item), (2, "clean"), (2, item), (3, "clean")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    left = corpus_pipeline.decontamination(spark, docs, SF)
    assert left.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text or "") for r in left.collect()) == [(0, ""), (0, "clean"), (3, "clean")]


def test_hostile_and_empty_tables_pass_every_stage(spark, tmp_path):
    """Nulls, copies without an id, repeated rows, long texts and clashing columns, stage by
    stage against what the stage must leave; then an empty table."""
    rows = cases.texts() + [(None, cases.texts()[2][1])] * 4
    docs = cases.frame(spark, rows)
    seen = docs
    for name, stage in corpus_pipeline.STAGES:
        out = written(stage(spark, seen, SF), name)
        if name != "best_fit_packing":
            assert out.columns == docs.columns
            assert out.count() <= seen.count()
        if name == "line_dedup":
            assert out.count() == seen.count()
        if name == "simhash_near_dedup":
            kept = [(r.doc_id, r.text) for r in out.select("doc_id", "text").collect()]
            assert len(set(kept)) == len(kept)
            texts = [t or "" for d, t in kept]
            before = {r.text or "" for r in seen.select("text").collect()}
            # every text left is a text that came, and no text stays twice
            assert len(set(texts)) == len(texts) and set(texts) <= before
        seen = out
    seen = cases.empty(spark)
    for name, stage in corpus_pipeline.STAGES:
        seen = written(stage(spark, seen, SF), name)
        assert seen.count() == 0
