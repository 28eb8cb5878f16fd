from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from maskwright.operators import rulebook as rb
from maskwright.operators.catalog import CATALOG_SCHEMA
from maskwright.sources.local import local_frame

CATALOG = [
    ("my-table 1", "my-table 1", "parquet", "name", 1, "string"),
    ("my-table 1", "my-table 1", "parquet", "born", 2, "date"),
    ("my-table 1", "my-table 1", "parquet", "price", 3, "decimal(4,3)"),
    ("other", "other", "csv", "name", 1, "string"),
    ("other", "other", "csv", "n", 2, "bigint"),
]


@pytest.fixture
def catalog(spark):
    frame = local_frame(spark, CATALOG, CATALOG_SCHEMA)
    return frame.withColumn("table_norm", rb.table_id(F.col("table")))


def problems(spark, catalog, rows):
    return {
        (r["code"], r["table"], r["attribute"], r["n_rules"], r["first_ordinal"])
        for r in rb.invalid_rules(rb.rulebook(spark, rows), catalog).collect()
    }


def test_a_good_rulebook_has_no_errors(spark, catalog):
    rows = [
        ("my-table 1", "name", "Standard", "Y"),
        ("other", "name", "Full Name", "N"),
        ("other", "n", "Age", "Y"),
    ]
    assert problems(spark, catalog, rows) == set()


def test_normalised_table_names_are_accepted(spark, catalog):
    assert problems(spark, catalog, [("my_table_1", "name", "Standard", "Y")]) == set()


def test_each_error_has_its_code(spark, catalog):
    rows = [
        ("nowhere", "name", "Standard", "Y"),
        ("other", "gone", "Standard", "Y"),
        ("other", "name", "Shuffle", "Y"),
        ("my-table 1", "name", "Standard", "X"),
        ("my-table 1", "born", "Standard", "Y"),
        ("other", "n", "Credit Card", "Y"),
        ("my-table 1", "price", "Age", "Y"),
        ("my-table 1", "name", "Standard", None),
    ]
    assert problems(spark, catalog, rows) == {
        ("UNKNOWN_TABLE", "nowhere", "name", 1, 0),
        ("UNKNOWN_ATTRIBUTE", "other", "gone", 1, 1),
        ("UNKNOWN_RULE", "other", "name", 1, 2),
        ("BAD_REF_INTEGRITY", "my-table 1", "name", 2, 3),
        ("UNSUPPORTED_TYPE", "my-table 1", "born", 1, 4),
        ("UNSUPPORTED_TYPE", "other", "n", 1, 5),
        ("UNSUPPORTED_TYPE", "my-table 1", "price", 1, 6),
        ("DUPLICATE_RULE", "my-table 1", "name", 2, 3),
    }


def test_first_match_and_conflicts(spark):
    rules = rb.rulebook(
        spark,
        [("a", "x", "Email", "Y"), ("a", "x", "Age", "Y"), ("b", "x", "Email", "Y"), ("b", "y", "Age", "N")],
    )
    first = {(r["table"], r["attribute"]): r["rule"] for r in rb.first_match(rules).collect()}
    assert first == {("a", "x"): "Email", ("b", "x"): "Email", ("b", "y"): "Age"}
    conflicts = [tuple(r) for r in rb.conflicting_rules(rules).collect()]
    assert conflicts == [("x", 2, 3)]


def test_rules_for_and_without_a_table(spark):
    rules = rb.rulebook(spark, [("a b", "x", "Email", "Y")])
    assert rb.rules_for_table(rules, "a b").count() == 1
    tables = spark.createDataFrame([("a b", "csv"), ("a_b", "csv"), ("c", "csv"), ("c", "csv"), ("log", None)], "table string, format string")
    assert [r["table"] for r in rb.unruled_tables(tables, rules).collect()] == ["c"]


def test_read_rulebook_keeps_the_order(spark, tmp_path):
    path = tmp_path / "rules.csv"
    path.write_text(
        "Table,Attribute,Masking Rule,Ref Integrity\n"
        'orders,"a, ""quoted"" name",Email - Retain Domain,Y\norders,b,Standard,N\n'
    )
    rows = [tuple(r) for r in rb.read_rulebook(spark, str(path)).orderBy("ordinal").collect()]
    assert rows == [
        ("orders", 'a, "quoted" name', "Email - Retain Domain", "Y", 0),
        ("orders", "b", "Standard", "N", 1),
    ]
