"""Plan checks: pruning and pushdown reach the scans; no cross joins anywhere."""

import contextlib
import io
import re

import pytest

import __spark_entry__ as E

from conftest import SF_SMALL

QUERIES = E.queries()
ORACLE = E.oracle_sql()


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_profile_branches_read_one_column_each(spark):
    text = plan(QUERIES["profile_lineitem"](spark, SF_SMALL))
    schemas = re.findall(r"ReadSchema: struct<(.*)>", text)
    assert len(schemas) == 11
    assert all("," not in s for s in schemas)


def test_range_filter_is_pushed_to_the_scan(spark):
    text = plan(QUERIES["range_filter"](spark, SF_SMALL))
    pushed = re.findall(r"PushedFilters: \[(.*)\]", text)[0]
    for needle in ("GreaterThanOrEqual(l_shipdate", "LessThan(l_shipdate", "GreaterThan(l_extendedprice",
                   "LessThanOrEqual(l_extendedprice"):
        assert needle in pushed
    assert "l_quantity" not in re.findall(r"ReadSchema: (.*)", text)[0]


def test_fixed_size_lookup_is_broadcast(spark):
    text = plan(QUERIES["lookup_enrich"](spark, SF_SMALL))
    assert "BroadcastExchange" in text


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_no_cross_joins(spark, name):
    text = plan(QUERIES[name](spark, SF_SMALL))
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text
