"""Every registered query against its SQL twin, and what no plan may contain."""

import re

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tools.check import compare, connect
from tools.plans import FORBIDDEN, plan_of

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = connect(SF)
    yield con
    con.close()


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["tag_id", "tag_type", "user_count"] and df.count() > 0


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", list(queries()))
def test_query(spark, duck, name):
    result, n = compare(spark, duck, SF, name)
    assert result.startswith(("ok", "rows only")), result
    assert n > 0 or name in {"Q3_users_by_unknown_type", "Q2_users_by_tags_all", "A22_shop_gender_job"}


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_plan(spark, name):
    plan = plan_of(queries()[name](spark, SF))
    assert not re.findall(FORBIDDEN, plan)
