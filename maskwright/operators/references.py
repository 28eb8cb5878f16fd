"""Which columns refer to which: inclusions between the columns of tables.

A masked copy keeps its joins only if a key and the columns that refer to it are masked alike.
``references`` finds them in the data: every column gets a sketch of its distinct values in one
scan per table (mergeable, a row per column), pairs of columns that the sketches do not rule out
are candidates, and candidates are confirmed on the values themselves, all in one join. A sketch
only rules out: at its error a true inclusion is dropped with a chance below 1e-8 per pair.
``mismatched`` compares the rules of what was found.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from maskwright.functions.generator import INTEGERS, is_text
from maskwright.functions.rules import quoted
from maskwright.operators.rulebook import table_id

#: Logarithm of the values a sketch holds.
SKETCH_BITS = 14
#: Columns of fewer distinct values (flags, kinds) are inside many keys by chance.
MIN_VALUES = 50
#: How many standard errors an estimate may stay below a full inclusion.
ERRORS = 6.0


def _kind(dtype: T.DataType) -> str | None:
    """Columns of one kind are compared, by their text."""
    return "number" if isinstance(dtype, INTEGERS) else "text" if is_text(dtype) else None


def _keyable(df: DataFrame) -> list[tuple[str, str]]:
    return [(f.name, kind) for f in df.schema if (kind := _kind(f.dataType)) is not None]


def sketches(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table, column, kind, n_values, n_distinct, sketch) of every column that can hold keys; one
    scan and one row of partial results per task and table."""
    parts = []
    for name, df in tables.items():
        columns = _keyable(df)
        if not columns:
            continue
        sums = [x for i, (c, _) in enumerate(columns) for x in (
            F.count(quoted(c)).alias(f"n{i}"), F.theta_sketch_agg(quoted(c).cast("string"), SKETCH_BITS).alias(f"s{i}"))]
        rows = F.array(*[
            F.struct(F.lit(name).alias("table"), F.lit(c).alias("column"), F.lit(kind).alias("kind"),
                     F.col(f"n{i}").alias("n_values"), F.col(f"s{i}").alias("sketch"))
            for i, (c, kind) in enumerate(columns)
        ])
        parts.append(df.agg(*sums).select(F.inline(rows)))
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found.withColumn("n_distinct", F.theta_sketch_estimate("sketch"))


def _plausible() -> Column:
    """Whether the estimates allow that all of the child's values are the parent's, and that the
    parent's values are unique."""
    sampled = F.least(F.lit(1.0), F.try_divide(F.lit(float(1 << SKETCH_BITS)), F.col("p.n_distinct")))
    error = F.sqrt(F.try_divide(F.lit(1.0), sampled * F.col("c.n_distinct")))
    common = F.theta_sketch_estimate(F.theta_intersection("c.sketch", "p.sketch"))
    unique = F.col("p.n_distinct") >= F.col("p.n_values") * (1 - ERRORS / F.sqrt(F.lit(float(1 << SKETCH_BITS))))
    return unique & (common >= F.col("c.n_distinct") * (1 - ERRORS * error) - 1)


def candidates(sketched: DataFrame) -> DataFrame:
    """(child_table, child_column, parent_table, parent_column): pairs of columns of one kind. There
    are as many rows as columns, so this join is of names, not of data."""
    child, parent = sketched.alias("c"), sketched.alias("p")
    other = (F.col("c.table") != F.col("p.table")) | (F.col("c.column") != F.col("p.column"))
    pairs = child.join(parent, (F.col("c.kind") == F.col("p.kind")) & other)
    # The estimate of a small column is exact; a margin for the others.
    enough = F.col("c.n_distinct") >= MIN_VALUES * 0.9
    return pairs.where(enough & _plausible()).select(
        F.col("c.table").alias("child_table"), F.col("c.column").alias("child_column"),
        F.col("p.table").alias("parent_table"), F.col("p.column").alias("parent_column"),
    )


def _values(tables: Mapping[str, DataFrame], wanted: set[tuple[str, str]]) -> DataFrame:
    """(table, column, value, n) of the distinct values of the wanted columns, in one scan per
    table, combined before the one shuffle."""
    found = None
    for name, df in tables.items():
        columns = [c for t, c in sorted(wanted) if t == name]
        if columns:
            each = F.array(*[F.struct(F.lit(c).alias("column"), quoted(c).cast("string").alias("value")) for c in columns])
            part = df.select(F.explode(each).alias("e")).select(F.lit(name).alias("table"), "e.*")
            found = part if found is None else found.unionByName(part)
    return found.where("value is not null").groupBy("table", "column", "value").agg(F.count("*").alias("n"))


_SCHEMA = "child_table string, child_column string, parent_table string, parent_column string"


def references(spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
    """(child_table, child_column, parent_table, parent_column, n_child, n_parent): columns all of
    whose values, at least ``MIN_VALUES`` different ones, are values of another column that
    holds each of them once, with the numbers of distinct values.

    Null is no value. Candidates come to the driver, at most one per pair of columns.
    """
    pairs = [tuple(r) for r in candidates(sketches(tables)).collect()]
    if not pairs:
        return spark.createDataFrame([], f"{_SCHEMA}, n_child long, n_parent long")
    names = spark.createDataFrame(pairs, _SCHEMA)
    values = _values(tables, {p[:2] for p in pairs} | {p[2:] for p in pairs})
    sizes = values.groupBy("table", "column").agg(F.count("*").alias("n_distinct"), F.max("n").alias("most"))
    # A child's value goes to each of its candidates and meets the parent's value there.
    child = values.select(F.col("table").alias("child_table"), F.col("column").alias("child_column"), "value")
    child = child.join(F.broadcast(names), ["child_table", "child_column"])
    parent = values.select(
        F.col("table").alias("parent_table"), F.col("column").alias("parent_column"), "value", F.lit(1).alias("met"))
    met = child.join(parent, ["parent_table", "parent_column", "value"], "left")
    counted = met.groupBy(*names.columns).agg(F.count("*").alias("n_child"), F.count("met").alias("n_met"))
    whole = counted.where((F.col("n_met") == F.col("n_child")) & (F.col("n_child") >= MIN_VALUES)).drop("n_met")
    unique = sizes.where("most = 1").select(
        F.col("table").alias("parent_table"), F.col("column").alias("parent_column"), F.col("n_distinct").alias("n_parent"))
    return whole.join(F.broadcast(unique), ["parent_table", "parent_column"]).select(*names.columns, "n_child", "n_parent")


def mismatched(found: DataFrame, rules: DataFrame) -> DataFrame:
    """References whose two columns are not masked alike: (..., child_rule, child_flag, parent_rule,
    parent_flag), null where a column has no rule. Rules name tables by either of their names."""
    first = rules.groupBy(table_id(F.col("table")).alias("t"), F.col("attribute").alias("a")).agg(
        F.min_by(F.struct("rule", "ref_integrity"), "ordinal").alias("r"))

    def side(which: str) -> DataFrame:
        return first.select(F.col("t").alias(f"{which}_t"), F.col("a").alias(f"{which}_column"),
                            F.col("r.rule").alias(f"{which}_rule"), F.col("r.ref_integrity").alias(f"{which}_flag"))

    both = found.select("child_table", "child_column", "parent_table", "parent_column")
    for which in ("child", "parent"):
        both = both.withColumn(f"{which}_t", table_id(F.col(f"{which}_table")))
        both = both.join(side(which), [f"{which}_t", f"{which}_column"], "left").drop(f"{which}_t")
    same = F.col("child_rule").eqNullSafe(F.col("parent_rule")) & F.col("child_flag").eqNullSafe(F.col("parent_flag"))
    return both.where(~same).select(
        "child_table", "child_column", "parent_table", "parent_column", "child_rule", "child_flag", "parent_rule", "parent_flag")
