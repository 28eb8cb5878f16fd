"""References found in the data, collisions of a whole job, and conditions that come with rules."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from maskwright import ColumnRule, MaskingConfig, mask, run_job
from maskwright.operators import audit
from maskwright.operators import dictionary as dic
from maskwright.operators import references as ref
from maskwright.operators import rulebook as rb
from maskwright.operators.catalog import CATALOG_SCHEMA
from maskwright.operators.conditions import columns_of, fits
from maskwright.sources.local import local_frame
from tests.plain import standard


@pytest.fixture(scope="module")
def tables(spark):
    """Keys of many and of few values, gaps, repeats, nulls, and a column that only nearly refers."""
    n = 40_000
    return {
        "parent": spark.range(n).select(F.col("id").alias("key"), F.concat(F.lit("k-"), "id").alias("name")),
        "child": spark.range(3 * n).select(
            (F.col("id") % n).cast("int").alias("key"), (F.col("id") % (n + 2)).alias("nearly"),
            F.when(F.col("id") % 9 > 0, F.concat(F.lit("k-"), F.col("id") % 60)).alias("name"),
            (F.col("id") % 30).alias("few"), F.lit(None).cast("string").alias("nothing"), F.lit(1.5).alias("real")),
        "nobody": spark.createDataFrame([], "key long"),
        "unkeyed": spark.createDataFrame([], "x double"),
    }


def test_references(spark, tables):
    found = {tuple(r) for r in ref.references(spark, tables).collect()}
    assert found == {
        ("child", "key", "parent", "key", 40_000, 40_000),
        ("child", "name", "parent", "name", 60, 40_000),
    }


def test_sketches_only_rule_out(spark, tables):
    sketched = ref.sketches(tables)
    assert sketched.count() == 8
    pairs = {tuple(r) for r in ref.candidates(sketched).collect()}
    assert ("child", "key", "parent", "key") in pairs and ("child", "name", "parent", "name") in pairs
    assert not any(p[3] in ("few", "nothing") or p[1] in ("few", "nothing") for p in pairs)
    assert ("parent", "key", "child", "name") not in pairs


def test_references_that_are_masked_apart(spark, tables):
    found = ref.references(spark, tables).cache()
    alike = rb.rulebook(spark, [(t, c, "Standard - Unique", "Y") for t in ("parent", "child") for c in ("key", "name")])
    assert ref.mismatched(found, alike).count() == 0
    apart = rb.rulebook(spark, [("parent", "key", "Standard", "Y"), ("child", "key", "Standard", "N"), ("child", "name", "Email", "Y")])
    assert {tuple(r) for r in ref.mismatched(found, apart).collect()} == {
        ("child", "key", "parent", "key", "Standard", "N", "Standard", "Y"),
        ("child", "name", "parent", "name", "Email", "Y", None, None),
    }


def test_collisions_of_a_job(spark, context):
    df = spark.range(1500).selectExpr("id % 1000 as k", "concat('a', id % 40) as t", "cast(null as string) as none")
    rules = [ColumnRule("k", "Standard"), ColumnRule("t", "Standard"), ColumnRule("none", "Standard")]
    found = {r["attribute"]: (r["n_masks"], r["n_colliding"]) for r in audit.job_collisions([("d", df, rules)], context).collect()}
    for r in rules[:2]:
        each = audit.collisions(df, r.attribute, r.rule, context)
        masks = mask(df, [r], context).select(r.attribute).distinct().count()
        assert found[r.attribute] == (masks, each.count())
    assert found["none"] == (0, 0)


def test_leaks(spark, context):
    """A planted original is found wherever it stands; words that only look alike are not."""
    df = spark.createDataFrame(
        [("ana.lopez@x.org", "Ana Lopez", "write to <ana.lopez@x.org>; not xana.lopez@x.org"), ("bo@y.org", "Bo Neil", "bo@y.org."), (None, "null", None)],
        "mail string, name string, note string")
    rules = [ColumnRule("mail", "Email"), ColumnRule("name", "Full Name")]
    other = spark.createDataFrame([("Ana Lopez", 1), ("Ana Lopez", 2), ("Ana", 3)], "title string, n int")
    found = {tuple(r) for r in audit.leaks([(df, rules)], {"t": mask(df, rules, context), "other": other}).collect()}
    assert found == {("t", "note", "ana.lopez@x.org", 1), ("t", "note", "bo@y.org", 1), ("other", "title", "Ana Lopez", 2)}


def test_columns_of_a_condition(spark):
    assert columns_of(spark, "`a b` > 1 and upper(c) like 'x%' or d is null") == ["a b", "c", "d"]
    for bad in ("a >", "exists (select 1)", "a in (select b from t)", "rand() < 1", "reflect('java.lang.System', 'exit', 1)",
                "t.a > 1", "sum(a) over () > 1", "java_method('x', 'y')"):
        assert columns_of(spark, bad) is None, bad


def test_conditions_fit_their_table(spark):
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    assert fits(df, "a > 1 and b like 'x%'")
    for bad in ("c > 1", "a", "no_such_function(a)", "sum(a) > 1", "count(*) > 1", "a > 1 and rand() > 0"):
        assert not fits(df, bad), bad


def test_errors_of_conditions(spark):
    rows = [("t", "t", "parquet", c, i, "string") for i, c in enumerate(("a", "b"))]
    catalog = local_frame(spark, rows, CATALOG_SCHEMA).withColumn("table_norm", rb.table_id(F.col("table")))
    rules = rb.rulebook(spark, [
        ("t", "a", "Standard", "Y", "b > 'x'"), ("t", "b", "Standard", "Y", "a > c and d = 1"),
        ("t", "b", "Email", "Y", "b >"), ("u", "b", "Standard", "Y", "z = 1"), ("t", "z", "Standard", "Y"),
    ])
    found = {(r["code"], r["table"], r["attribute"], r["first_ordinal"]) for r in rb.invalid_rules(rules, catalog).collect()}
    assert found == {
        ("UNKNOWN_CONDITION_COLUMN", "t", "b", 1), ("BAD_CONDITION", "t", "b", 2), ("DUPLICATE_RULE", "t", "b", 1),
        ("UNKNOWN_TABLE", "u", "b", 3), ("UNKNOWN_ATTRIBUTE", "t", "z", 4),
    }


def test_a_condition_sees_the_unmasked_row(spark, context):
    df = spark.createDataFrame([(1, "Ana", "in"), (2, "Ana", "out"), (3, "Bo", None), (4, None, "in")], "id int, name string, place string")
    rules = [ColumnRule("name", "Standard", condition="place = 'in'"), ColumnRule("place", "Standard")]
    rows = [tuple(r) for r in mask(df, rules, context).orderBy("id").collect()]
    assert [r[1] for r in rows] == [standard("Ana"), "Ana", standard("Bo"), None]  # null: when in doubt, mask
    assert [r[2] for r in rows] == [standard("in"), standard("out"), None, standard("in")]
    entries = dic.new_entries([(df, rules[:1])], context, dic.empty_dictionary(spark))
    assert sorted(r["original"] for r in entries.collect()) == ["Ana", "Bo"]
    known = spark.createDataFrame([("project:p", "Ana", "Zoe")], dic.DICTIONARY_SCHEMA)
    masked = dic.apply_dictionary(df, rules, known, context).orderBy("id").collect()
    assert [r["name"] for r in masked] == ["Zoe", "Ana", standard("Bo"), None]


def test_conditions_in_a_job(spark, tmp_path):
    spark.createDataFrame([("Ana", 1), ("Bo", 2)], "name string, n int").coalesce(1).write.parquet(f"{tmp_path}/in/t")
    (tmp_path / "rules.csv").write_text("Table,Attribute,Masking Rule,Ref Integrity,Condition\nt,name,Standard,Y,n > 1\n")
    cfg = MaskingConfig(project="p", key="test-key", input=f"{tmp_path}/in", output=f"{tmp_path}/out", rulebook=f"{tmp_path}/rules.csv")
    assert [r["status"] for r in run_job(spark, cfg).collect()] == ["masked"]
    assert sorted(map(tuple, spark.read.parquet(f"{tmp_path}/out/t").collect())) == sorted([("Ana", 1), (standard("Bo"), 2)])
    for condition, status in (("n > 'x' || 1", "failed"), ("m > 1", "invalid_rules"), ("n >", "invalid_rules")):
        rules = rb.rulebook(spark, [("t", "name", "Standard", "Y", condition)])
        assert [r["status"] for r in run_job(spark, cfg, rules).collect()][0] in (status, "failed")
