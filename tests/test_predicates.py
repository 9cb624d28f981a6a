import datetime
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tagloom.functions import columns as col
from tagloom.functions import predicates as pred


@pytest.fixture(scope="module")
def people(spark):
    data = [("1", "1", "9", "anna"), ("2", "2", "1000", "Bob"), ("3", None, None, None), ("4", "2", "x", "annabob")]
    return spark.createDataFrame(data, "id string, gender string, n string, name string")


def ids(df):
    return sorted(r["id"] for r in df.collect())


def test_missing_column_passes_in_the_bracket_language(people):
    assert ids(people.where(pred.where_dsl("gender[eq]2"))) == ["2", "3", "4"]
    assert ids(people.where(pred.where_dsl("gender[EQ]2,name[ne]Bob"))) == ["3", "4"]


def test_bracket_language_compares_bytes_unless_numeric(people):
    assert ids(people.where(pred.where_dsl("n[lt]9"))) == ["2", "3"]
    assert ids(people.where(pred.where_dsl("n[ge]9", numeric=True))) == ["1", "2", "3"]


@pytest.mark.parametrize("text", ["gender[[eq]1", "gender[like]1", "gender"])
def test_bracket_language_rejects(text):
    with pytest.raises(ValueError):
        pred.where_dsl(text)


def test_missing_column_fails_in_cell_filters(people):
    assert ids(people.where(pred.cell("gender", "ne", "1"))) == ["2", "4"]
    assert ids(people.where(~pred.cell("gender", "eq", "1"))) == ["2", "3", "4"]
    assert ids(people.where(pred.cell("gender", "null"))) == ["3"]
    assert ids(people.where(pred.cell("name", "substring", "BOB"))) == ["2", "4"]
    assert ids(people.where(pred.cell("name", "regex", "^anna$"))) == ["1"]
    both = pred.all_of([pred.cell("gender", "not_null"), pred.any_of([pred.cell("n", "gt", "9"), pred.cell("n", "le", "1000")])])
    assert ids(people.where(both)) == ["2", "4"]


@pytest.mark.parametrize(
    "text, want",
    [
        ("0.5y", datetime.date(2023, 8, 3)),
        ("1y", datetime.date(2023, 2, 1)),
        ("1m", datetime.date(2024, 1, 1)),
        ("60d", datetime.date(2023, 12, 3)),
    ],
)
def test_relative_day(spark, text, want):
    got = spark.range(1).select(pred.relative_day(text, "2024-02-01").alias("d")).first()["d"]
    assert got == want


def test_mask(spark):
    df = spark.createDataFrame([(None,), ("12345",), ("123456",), ("1234567890",)], "v string")
    assert [r[0] for r in df.select(col.mask(F.col("v"))).collect()] == ["", "12345", "123456", "123****890"]


def test_zodiac_cut_offs(spark):
    days = ["2000-01-19", "2000-01-20", "2000-02-18", "2000-02-19", "2000-12-21", "2000-12-22", "2000-02-29"]
    df = spark.createDataFrame([(d,) for d in days], "d string")
    signs = [r[0] for r in df.select(col.zodiac(F.to_date("d"))).collect()]
    assert signs == ["capricorn", "aquarius", "aquarius", "pisces", "sagittarius", "capricorn", "pisces"]


def test_account_kinds_and_order(spark):
    data = ["13812345678", "a.b-c@mail.example.com", "10001", "110101199001011234", "11010119900101123X", "nobody", "a@b"]
    df = spark.createDataFrame([(v,) for v in data], "v string")
    kinds = [r[0] for r in df.select(col.classify_account(F.col("v"))).collect()]
    assert kinds == ["mobile", "email", "qq", "id_card", "id_card", None, None]


def test_long_text_that_is_no_address_is_read_in_linear_time(spark):
    long = ["a" * 50_000, "a-" * 20_000 + "!", "aa@" + "a." * 20_000 + "!", "http://" + "a." * 20_000 + "!"]
    df = spark.createDataFrame([(v,) for v in long], "v string")
    for pattern in (col.ACCOUNT_FORMATS["email"], col.URL_FORMAT):
        assert df.where(F.col("v").rlike(pattern)).count() == 0


_LETTERS = "aZ9-|.@/ _"
# the formats in their nested form, read over whole values
_NESTED = {
    "email": r"([a-z0-9A-Z]+[-|\.]?)+[a-z0-9A-Z]@([a-z0-9A-Z]+(-[a-z0-9A-Z]+)?\.)+[a-zA-Z]{2,}",
    "url": r"http(s)?://([\w-]+\.)+[\w-]+(/[\w\- ./?%&=]*)?",
}


@given(st.sampled_from(sorted(_NESTED)), st.lists(st.sampled_from([*_LETTERS, "aa", "a.b", "a@b", ".com", "a-b"]), max_size=9))
@settings(max_examples=3000, deadline=None)
def test_linear_formats_equal_the_nested_ones(kind, parts):
    text = ("http://" if kind == "url" else "") + "".join(parts)
    flat = (col.ACCOUNT_FORMATS["email"] if kind == "email" else col.URL_FORMAT).replace(r"\z", r"\Z")
    assert bool(re.search(flat, text)) == bool(re.fullmatch(_NESTED[kind], text, re.ASCII))


def test_digits_to_date(spark):
    df = spark.createDataFrame([("2019-02-28",), ("20190230",), ("2019/1/1",), ("2019年03月04日",), (None,)], "v string")
    got = [r[0] for r in df.select(col.digits_to_date(F.col("v"))).collect()]
    assert got == [datetime.date(2019, 2, 28), None, None, datetime.date(2019, 3, 4), None]


def test_rule_value_keeps_later_equal_signs(spark):
    df = spark.createDataFrame([("inType=mysql\r\nurl=jdbc:x?a=b\r\ntable=t",)], "rule string")
    got = df.select(*[col.rule_value(F.col("rule"), n) for n in ("inType", "url", "table", "none")]).first()
    assert tuple(got) == ("mysql", "jdbc:x?a=b", "t", "")


def test_exact_sum_does_not_depend_on_the_partitions(spark):
    data = [(0.1 * i,) for i in range(1000)]
    got = {
        spark.createDataFrame(data, "v double").repartition(n).transform(lambda d: d.agg(col.exact_sum(d, "v").alias("s"))).first()["s"]
        for n in (1, 3, 8)
    }
    assert got == {49950.0}
