from bisect import bisect_right
from decimal import Decimal

import pytest
from hypothesis import given
from hypothesis import strategies as st

from tagloom import seeds
from tagloom.operators.stats import _candidates
from tagloom.specs import HBASE, HDFS, HIVE, RDBMS, Band, Rule, bands, close_gaps, in_order, parse_band, parse_rule


@pytest.mark.parametrize(
    "text, lo, hi, lo_open, hi_open",
    [
        ("19500101-19591231", 19500101, 19591231, False, False),
        ("0.4~1", Decimal("0.4"), 1, False, False),
        (">=1", 1, None, False, False),
        (">5000000", 5000000, None, True, False),
        ("<0", None, 0, False, True),
        ("<=9999", None, 9999, False, False),
        ("<60second", None, 60, False, True),
        ("60second-299second", 60, 299, False, False),
        ("7day", None, 7, False, False),
        ("0", 0, 0, False, False),
        ("<0-0.1", None, Decimal("0.1"), False, False),
    ],
)
def test_band_grammar(text, lo, hi, lo_open, hi_open):
    assert parse_band(Rule(1, text)) == Band(1, lo, hi, lo_open, hi_open)


def test_band_grammar_rejects_words():
    with pytest.raises(ValueError):
        parse_band(Rule(1, "often"))


def test_every_seeded_range_rule_parses():
    for rules in (seeds.AGE, seeds.HEIGHT, seeds.CYCLE, seeds.SPENDING, seeds.PSM, seeds.ACTIVITY, seeds.VISIT_SECONDS):
        assert len(bands(rules)) == len(rules)


def test_rules_are_tried_by_order_then_id():
    assert [r.tag_id for r in in_order([Rule(3, "a", 2), Rule(9, "b", 1), Rule(2, "c", 2)])] == [9, 2, 3]


def test_wrapping_band():
    assert parse_band(Rule(1, "1222-0120")).wraps


def test_close_gaps_leaves_no_hole():
    closed = close_gaps(bands(seeds.RFM_MONETARY))
    ends = sorted((b.lo is not None, b.lo or 0, b.hi) for b in closed)
    assert [e[1] for e in ends][1:] == [e[2] for e in ends][:-1]
    assert closed[0].lo is None and closed[-1].hi is None


def _first_match(items, x):
    for b in items:
        lo = b.lo is None or (x > b.lo if b.lo_open else x >= b.lo)
        hi = b.hi is None or (x < b.hi if b.hi_open else x <= b.hi)
        if (lo or hi) if b.wraps else (lo and hi):
            return b.tag_id
    return None


_bound = st.one_of(st.none(), st.integers(-20, 20))


@given(
    st.lists(st.tuples(_bound, _bound, st.booleans(), st.booleans()), min_size=1, max_size=12),
    st.lists(st.integers(-50, 50), min_size=1, max_size=30),
)
def test_stretches_hold_the_first_match(raw, halves):
    items = [Band(i, lo, hi, lo_open, hi_open) for i, (lo, hi, lo_open, hi_open) in enumerate(raw)]
    edges, stretches = _candidates(items)
    for half in halves:
        x = half / 2
        found = stretches[bisect_right(edges, x)]
        assert _first_match([items[i] for i in sorted(found)], x) == _first_match(items, x)
        assert found == sorted(found)


def test_rule_text_of_each_source_kind():
    hive = parse_rule("inType=hive\r\nurl=jdbc:hive2://h/d?a=b;c=d\r\ndbTable=tbl_sales\r\n")[0]
    assert (hive.kind, hive.table, hive.option("url")) == (HIVE, "tbl_sales", "jdbc:hive2://h/d?a=b;c=d")
    mysql = parse_rule("inType=mysql\nurl=jdbc:mysql:///tags\ntable=tbl_x")[0]
    assert (mysql.kind, mysql.table) == (RDBMS, "tbl_x")
    hdfs = parse_rule("inType=hdfs\ninPath=/d/1/\nsperator=\\t\ninFields=a,b,c")[0]
    assert (hdfs.kind, hdfs.table, hdfs.fields) == (HDFS, "/d/1/", ("a", "b", "c"))
    hbase = parse_rule(
        "inType=hbase\nhbaseTable=tbl_orders\nfamily=info\nselectFieldNames=utime\nwhereFieldNames=utime\nwhereFieldValues=2019-05-10"
    )[0]
    assert (hbase.kind, hbase.family, hbase.where) == (HBASE, "info", "utime[eq]2019-05-10")


def test_two_sources_do_not_share_anything():
    goods, orders = parse_rule(
        "inType=hbase\nhbaseTable=goods#orders\nfamily=detail#detail\nselectFieldNames=cOrderSn,ogColor#memberId,orderSn"
    )
    assert (goods.table, goods.fields) == ("goods", ("cOrderSn", "ogColor"))
    assert (orders.table, orders.fields) == ("orders", ("memberId", "orderSn"))


def test_unknown_source_kind():
    with pytest.raises(ValueError):
        parse_rule("inType=ftp\ntable=x")
