"""The physical plans: what is read, where Python runs, how skew is met."""

from __future__ import annotations

import os
import re

import pytest
from pyspark.sql import functions as F

from checks.queries import CUSTOMER_RULES, KEY, QUERIES
from checks.views import pii_customer, table
from maskwright import ColumnRule, MaskContext, mask, mask_column
from maskwright.operators.audit import collisions
from maskwright.operators.dictionary import first_wins
from maskwright.operators.rulebook import RULES_SCHEMA, first_match
from maskwright.operators import dictionary as dic

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not there")
CONTEXT = MaskContext(KEY, project="p", run_id="r")


def plan(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def test_only_needed_columns_are_read(spark):
    df = mask_column(table(spark, SF, "lineitem").select("l_orderkey", "l_tax"), "l_tax", "Standard", CONTEXT)
    [schema] = re.findall(r"ReadSchema: (.*)", plan(df))
    assert schema == "struct<l_orderkey:bigint,l_tax:double>"


def test_filters_on_other_columns_reach_the_scan(spark):
    df = mask_column(table(spark, SF, "customer"), "c_name", "Standard", CONTEXT).where("c_nationkey = 3")
    assert "EqualTo(c_nationkey,3)" in plan(df)


def test_numbers_need_no_python(spark):
    df = mask_column(table(spark, SF, "customer"), "c_acctbal", "Standard", CONTEXT)
    assert "ArrowEvalPython" not in plan(df)


def test_a_table_goes_through_python_once(spark):
    operators = plan(mask(pii_customer(spark, SF), CUSTOMER_RULES, CONTEXT)).split("\n\n")[0]
    assert operators.count("ArrowEvalPython") == 1 and "Exchange" not in operators


def test_column_engine_needs_no_python(spark):
    context = MaskContext(KEY, project="p", run_id="r", text_engine="columns")
    assert "ArrowEvalPython" not in plan(mask(pii_customer(spark, SF), CUSTOMER_RULES, context))


def test_the_key_is_in_no_plan(spark):
    assert KEY not in plan(mask(pii_customer(spark, SF), CUSTOMER_RULES, CONTEXT))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_query_pairs_everything_with_everything(spark, name):
    if name in ("mask_job", "mask_job_output", "dict_load", "dict_roundtrip"):
        pytest.skip("runs a job when built")
    text = plan(QUERIES[name](spark, SF))
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text


def test_a_hot_value_is_split(spark, monkeypatch):
    """A third of all rows hold one value, and another third null."""
    monkeypatch.setattr(dic, "small_size", lambda side: None)
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        rows = spark.range(0, 60_000, 1, 12).select(
            "id",
            F.when(F.col("id") % 3 == 0, "hot")
            .when(F.col("id") % 3 == 1, F.concat(F.lit("v"), F.col("id").cast("string")))
            .alias("v"),
        )
        known = spark.range(2000).select(
            F.lit("project:p").alias("scope"),
            F.concat(F.lit("v"), F.col("id").cast("string")).alias("original"),
            F.concat(F.lit("m"), F.col("id").cast("string")).alias("masked"),
        ).union(spark.sql("select 'project:p', 'hot', 'cold'"))
        result = dic.apply_dictionary(rows, [ColumnRule("v", "Standard")], known, CONTEXT)
        counts = result.agg(
            F.count("*").alias("n"),
            F.count(F.when(F.col("v") == "cold", 1)).alias("hot"),
            F.count(F.when(F.col("v").rlike(r"^m\d+$"), 1)).alias("known"),
            F.count("v").alias("values"),
        )
        assert tuple(counts.first())[:2] == (60_000, 20_000)
        assert counts.first()["values"] == 40_000
        result.foreach(lambda row: None)
        assert "skew=true" in result._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def executed(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_collisions_mask_no_row_in_a_filter(spark):
    """Masks are computed after the distinct, not to test raw rows."""
    df = spark.range(10).selectExpr("id as k")
    plan = executed(collisions(df, "k", "Standard", CONTEXT))
    assert not [line for line in plan.splitlines() if "Filter" in line and "sha2" in line]


def test_first_match_and_first_wins_sort_nothing_to_aggregate(spark):
    rules = spark.createDataFrame([("t", "a", "Age", "Y", 1)], RULES_SCHEMA)
    candidates = spark.createDataFrame([("s", "o", "m", 1)], "scope string, original string, masked string, ord long")
    for df in (first_match(rules), first_wins(candidates)):
        assert "SortAggregate" not in executed(df)
