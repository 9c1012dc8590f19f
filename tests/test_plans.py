"""Shapes of plans that must hold at any size."""

import re

import pytest

from opsledger.catalog import all_queries
from tests import oracle

QUERIES = all_queries()
# queries whose state is read back from files have trivial plans and are left out
PLANNED = sorted(n for n in QUERIES if not n.startswith(("k1_", "k2_", "k8_", "k10_", "s1_", "s6_", "s8_", "d23", "d24")))

# only reliable checkpoints may appear as RDD scans
CHECKPOINTED = ("w1_category_rank", "w5_dense_row_id", "d21_visit_wait_time", "d26_fee_schedule_long", "d27_fee_dimension",
                "w5_lasting_ids")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def details(df) -> str:
    jvm = df.sparkSession._jvm
    return jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


@pytest.mark.parametrize("name", PLANNED)
def test_no_cartesian_and_no_python(no_broadcast, name):
    text = plan(QUERIES[name](no_broadcast, oracle.folder("0.001")))
    for bad in ("CartesianProduct", "NestedLoop", "PythonUDF", "EvalPython", "InPandas"):
        assert bad not in text
    if "ExistingRDD" in text:
        assert name in CHECKPOINTED


def test_filters_and_columns_reach_the_scan(spark):
    text = details(QUERIES["f8_filters"](spark, oracle.folder("0.001")))
    pushed = re.search(r"PushedFilters: \[(.*)\]", text).group(1)
    assert "EqualTo(l_linestatus,O)" in pushed and "GreaterThanOrEqual(l_quantity" in pushed and "l_shipdate" in pushed
    assert "l_extendedprice" not in text


def test_receipts_scan_each_input_with_few_columns(spark):
    text = details(QUERIES["d13_combine_policies_sheet"](spark, oracle.folder("0.001")))
    assert text.count("ReadSchema") == 3  # lines for their amounts, lines for the match, postings
    assert "l_quantity" not in text and "l_shipdate" not in text


def test_allocation_adds_no_shuffle_to_the_sums(spark):
    """Two shuffles for the postings and their join, two for the sums; the rest reuses a sheet's day being in one place."""
    text = plan(QUERIES["d13_combine_policies_facility"](spark, oracle.folder("0.001")))
    assert text.count("Exchange hashpartitioning") <= 5


def test_policy_tables_are_broadcast_by_their_size(spark):
    text = plan(QUERIES["d13_combine_policies_sheet"](spark, oracle.folder("0.001")))
    assert re.search(r"BroadcastHashJoin \[sheet.*\], \[sheet", text) and "LocalTableScan" in text


def test_partition_pruning(spark):
    text = details(QUERIES["s8_read_partition"](spark, oracle.folder("0.001")))
    assert re.search(r"PartitionFilters: \[isnotnull\(o_orderstatus", text)
