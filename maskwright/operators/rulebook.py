"""Rulebooks as tables: selection of rules and checks against the catalog.

A rulebook says which attribute of which table gets which rule:
``rules(table, attribute, rule, ref_integrity, ordinal)``, and may say on which rows, in a column
``condition`` (``conditions``), null for all.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from maskwright.functions.rules import accepts_type, rule_names
from maskwright.operators.conditions import columns_of
from maskwright.operators.dictionary import earliest
from maskwright.operators.masking import ColumnRule
from maskwright.sources.local import local_frame

RULES_SCHEMA = "table string, attribute string, rule string, ref_integrity string, ordinal int"


def table_id(name: Column) -> Column:
    """The name under which catalog, rulebook and job compare tables."""
    return F.regexp_replace(name, "[ -]", "_")


def rulebook(spark: SparkSession, rows: Iterable[tuple]) -> DataFrame:
    """A rulebook from (table, attribute, rule, ref_integrity) rows, in order; rows may have a
    condition behind."""
    rows = list(rows)
    if all(len(row) == 4 for row in rows):
        return local_frame(spark, [(*row, i) for i, row in enumerate(rows)], RULES_SCHEMA)
    full = [(*row[:4], i, row[4] if len(row) > 4 else None) for i, row in enumerate(rows)]
    return local_frame(spark, full, f"{RULES_SCHEMA}, condition string")


def read_rulebook(spark: SparkSession, path: str) -> DataFrame:
    """A rulebook CSV with the headers Table, Attribute, Masking Rule, Ref Integrity, and maybe
    Condition.

    One file, so the row number in file order is its ordinal.
    """
    raw = spark.read.csv(path, header=True, multiLine=True, escape='"')
    condition = [F.col("Condition").alias("condition")] if "Condition" in raw.columns else []
    return raw.select(
        F.col("Table").alias("table"),
        F.col("Attribute").alias("attribute"),
        F.col("`Masking Rule`").alias("rule"),
        F.col("`Ref Integrity`").alias("ref_integrity"),
        F.monotonically_increasing_id().cast("int").alias("ordinal"),
        *condition,
    )


def rules_for_table(rules: DataFrame, table: str) -> DataFrame:
    return rules.where(F.col("table") == table)


def first_match(rules: DataFrame) -> DataFrame:
    """The earliest rule of every (table, attribute); ordinals are unique."""
    columns = ("table", "attribute", "ordinal", "rule", "ref_integrity")
    return earliest(rules, ("table", "attribute"), "ordinal").select(*columns)


def unruled_tables(tables: DataFrame, rules: DataFrame) -> DataFrame:
    """The names in ``tables`` (columns ``table`` and ``format``, a row per file) that no rule
    speaks of; files that are no data belong to no table."""
    ruled = rules.select(table_id(F.col("table")).alias("__id")).distinct()
    named = tables.where(F.col("format").isNotNull()).select("table").distinct()
    return named.join(ruled, table_id(F.col("table")) == F.col("__id"), "left_anti")


def unknown_tables(rules: DataFrame, catalog: DataFrame) -> DataFrame:
    """Rules for tables the catalog does not have."""
    known = catalog.select("table_norm").distinct()
    return rules.join(known, table_id(F.col("table")) == F.col("table_norm"), "left_anti")


def unknown_attributes(rules: DataFrame, catalog: DataFrame) -> DataFrame:
    """Rules whose table exists but lacks the attribute."""
    tables = catalog.select("table_norm").distinct()
    columns = catalog.select("table_norm", F.col("column").alias("__column")).distinct()
    same_table = table_id(F.col("table")) == F.col("table_norm")
    in_table = rules.join(tables, same_table, "left_semi")
    return in_table.join(columns, same_table & (F.col("attribute") == F.col("__column")), "left_anti")


def invalid_rules(rules: DataFrame, catalog: DataFrame) -> DataFrame:
    """All errors of a rulebook: one row per code, table and attribute.

    ``n_rules`` counts the rules concerned, ``first_ordinal`` points to the first.
    One scan of the rules and one aggregate, combined before its shuffle.
    """
    tables = catalog.groupBy(F.col("table_norm").alias("__norm")).agg(
        F.collect_set("table").alias("__tables")
    )
    columns = catalog.groupBy(
        F.col("table_norm").alias("__table"), F.col("column").alias("__column")
    ).agg(F.collect_set("type").alias("__types"))
    id_ = table_id(F.col("table"))
    checked = rules.join(tables, id_ == F.col("__norm"), "left").join(
        columns, (id_ == F.col("__table")) & (F.col("attribute") == F.col("__column")), "left"
    )
    has_table, has_column = F.col("__tables").isNotNull(), F.col("__types").isNotNull()
    known_rule = F.coalesce(F.col("rule").isin(rule_names()), F.lit(False))
    flag_ok = F.coalesce(F.col("ref_integrity").isin("Y", "N"), F.lit(False))
    supported = F.forall("__types", lambda t: accepts_type(F.col("rule"), t))
    # Every rule also counts as itself, to find those that are not alone.
    codes = F.array(
        F.when(~has_table, "UNKNOWN_TABLE"),
        F.when(has_table & ~has_column, "UNKNOWN_ATTRIBUTE"),
        F.when(~known_rule, "UNKNOWN_RULE"),
        F.when(~flag_ok, "BAD_REF_INTEGRITY"),
        F.when(has_column & known_rule & ~supported, "UNSUPPORTED_TYPE"),
        F.lit("DUPLICATE_RULE"),
    )
    coded = checked.withColumn("code", F.explode(codes)).where(F.col("code").isNotNull())
    # Duplicates meet under the table they resolve to, however they spell it.
    resolved = F.when(
        F.col("code") == "DUPLICATE_RULE", resolved_tables(F.col("table"), F.col("__tables"))
    ).otherwise(F.array("table"))
    found = coded.select("code", F.explode(resolved).alias("table"), "attribute", "ordinal")
    if "condition" in rules.columns:
        found = found.unionByName(condition_errors(rules, catalog))
    return (
        found.groupBy("code", "table", "attribute")
        .agg(F.count("*").alias("n_rules"), F.min("ordinal").alias("first_ordinal"))
        .where((F.col("code") != "DUPLICATE_RULE") | (F.col("n_rules") > 1))
    )


def condition_errors(rules: DataFrame, catalog: DataFrame) -> DataFrame:
    """(code, table, attribute, ordinal) of rules whose condition is no predicate, or reads a column
    that their table does not have.

    Each different condition is parsed once, on the driver; the columns then meet the catalog
    as data.
    """
    spark = rules.sparkSession
    texts = [r[0] for r in rules.select("condition").where("condition is not null").distinct().collect()]
    parsed = [(text, columns_of(spark, text)) for text in texts]
    rows = [(text, name) for text, columns in parsed for name in columns or ()]
    bad = local_frame(spark, [(text,) for text, columns in parsed if columns is None], "condition string")
    reads = local_frame(spark, rows, "condition string, __name string")
    kept = ("table", "attribute", "ordinal")
    broken = rules.join(bad, "condition", "left_semi").select(F.lit("BAD_CONDITION").alias("code"), *kept)
    same_table = table_id(F.col("table")) == F.col("__norm")
    tables = catalog.select(F.col("table_norm").alias("__norm")).distinct()
    columns = catalog.select(F.col("table_norm").alias("__norm"), F.col("column").alias("__column")).distinct()
    needed = rules.join(reads, "condition").join(tables, same_table, "left_semi")
    lacking = needed.join(columns, same_table & (F.col("__name") == F.col("__column")), "left_anti")
    return broken.unionByName(lacking.select(F.lit("UNKNOWN_CONDITION_COLUMN").alias("code"), *kept).distinct())


def resolved_tables(name: Column, candidates: Column) -> Column:
    """The tables a rule's table name means: the one of that very name, else all of the same
    normalised name, else the name itself."""
    own = F.array(name)
    return F.when(F.array_contains(candidates, name), own).otherwise(F.coalesce(candidates, own))


def conflicting_rules(rules: DataFrame) -> DataFrame:
    """Attribute names that are treated differently in different places."""
    return (
        rules.groupBy("attribute")
        .agg(
            F.count_distinct(
                F.struct(F.coalesce("rule", F.lit("")), F.coalesce("ref_integrity", F.lit("")))
            ).alias("n_treatments"),
            F.count("*").alias("n_rules"),
        )
        .where("n_treatments > 1")
    )


def errors_by_table(rules: DataFrame, catalog: DataFrame) -> DataFrame:
    """(table_norm, code, n): how many errors of each code a table has."""
    errors = invalid_rules(rules, catalog)
    return errors.groupBy(table_id(F.col("table")).alias("table_norm"), "code").agg(F.count("*").alias("n"))


def plan_rules(rules: DataFrame, tables: DataFrame) -> dict[str, list[ColumnRule]]:
    """The rules of the tables in ``tables(table_norm)`` on the driver, by table name.

    Where these have no duplicates, there is at most one rule per column.
    """
    mine = rules.join(tables.select("table_norm").distinct(), table_id(F.col("table")) == F.col("table_norm"), "left_semi")
    plan: dict[str, list[ColumnRule]] = {}
    for row in mine.orderBy("ordinal").collect():
        plan.setdefault(row["table"], []).append(
            ColumnRule(row["attribute"], row["rule"], row["ref_integrity"], row["ordinal"],
                       row["condition"] if "condition" in mine.columns else None)
        )
    return plan
