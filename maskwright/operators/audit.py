"""Audits of a masking: collisions and values that came through unchanged."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from maskwright.functions.generator import MaskContext, is_text
from maskwright.functions.rules import NULL_TEXT, quoted
from maskwright.operators.masking import ColumnRule, mask, mask_column
from maskwright.sources.local import local_frame


def collisions(
    df: DataFrame, attribute: str, rule_name: str, context: MaskContext, ref_integrity: str = "Y"
) -> DataFrame:
    """Masks that stand for more than one original: (masked, n_originals).

    Masks are computed once per distinct original.  Joins on a masked key fan
    out exactly on these values.
    """
    # Nulls go before anything is masked: a condition on the mask would be pushed below
    # the distinct, and every row masked to test it.
    originals = df.select(quoted(attribute).alias("masked")).where(F.col("masked").isNotNull())
    masked = mask_column(originals.distinct(), "masked", rule_name, context, ref_integrity)
    return (
        masked.groupBy("masked")
        .agg(F.count("*").alias("n_originals"))
        .where("n_originals > 1")
    )


def job_collisions(tables: Iterable[tuple[str, DataFrame, Sequence[ColumnRule]]], context: MaskContext) -> DataFrame:
    """``collisions`` counted for all ruled columns of a job: (table, attribute, rule, n_masks,
    n_colliding), one pass over each table and one shuffle.

    A mask goes as two 64-bit hashes, an original as one: a mask stands for several originals if
    the least and the greatest hash among them differ, which are combined before the shuffle,
    so that a mask of many rows is one row per task.
    """
    names: list[tuple[str, str, str]] = []
    found: DataFrame | None = None
    for name, df, rules in tables:
        originals = {f"__original_{i}": quoted(r.attribute) for i, r in enumerate(rules)}
        masked = mask(df.withColumns(originals), rules, context)
        each = []
        for i, r in enumerate(rules):
            text = quoted(r.attribute).cast("string")
            each.append(F.struct(
                F.lit(len(names)).alias("column"), F.xxhash64(text).alias("a"), F.xxhash64(F.lit(1), text).alias("b"),
                F.when(F.col(f"__original_{i}").isNotNull(), F.xxhash64(F.col(f"__original_{i}").cast("string"))).alias("o"),
            ))
            names.append((name, r.attribute, r.rule))
        part = masked.select(F.explode(F.array(*each)).alias("e")).select("e.*").where("o is not null")
        found = part if found is None else found.unionByName(part)
    if found is None:
        raise ValueError("no tables")
    # A row per ruled column, whether or not it has values.
    columns = local_frame(found.sparkSession, [(i, *n) for i, n in enumerate(names)], "column int, table string, attribute string, rule string")
    masks = found.groupBy("column", "a", "b").agg(F.min("o").alias("least"), F.max("o").alias("most"))
    counted = masks.groupBy("column").agg(
        F.count("*").alias("n_masks"), F.count(F.when(F.col("least") < F.col("most"), 1)).alias("n_colliding"))
    return columns.join(counted, "column", "left").select(
        "table", "attribute", "rule", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_masks", "n_colliding")])


#: A word of free text: letters, digits and what joins them in addresses and keys, not at its ends.
LEAK_WORDS = r"[\p{L}\p{N}](?:[\p{L}\p{N}@._-]*[\p{L}\p{N}])?"
#: Shorter originals (numbers of a day, initials) stand in free text by chance.
LEAK_CHARS = 5


def _texts(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if is_text(f.dataType)]


def leaks(
    ruled: Iterable[tuple[DataFrame, Sequence[ColumnRule]]], written: Mapping[str, DataFrame], min_chars: int = LEAK_CHARS
) -> DataFrame:
    """Originals of ruled columns that stand in what was written, in any text column of any table:
    (table, attribute, original, n_values), as a whole value or as a word of one.

    ``ruled`` has the tables before masking, ``written`` those after. Words run between white
    space and punctuation other than ``@ . _ -``, so that addresses and keys stay whole. Originals
    are distinct, and so are the words of each column, before they meet in one semi-join, whose larger
    side Spark thins out with a Bloom filter of the smaller one where that pays. Originals that
    a rule leaves as they are count as well: only the caller knows which of them matter.
    """
    found: DataFrame | None = None
    for df, rules in ruled:
        each = F.array(*[quoted(r.attribute).cast("string") for r in rules])
        part = df.select(F.explode(each).alias("original"))
        found = part if found is None else found.unionByName(part)
    if found is None:
        raise ValueError("no ruled tables")
    originals = found.where((F.length("original") >= min_chars) & (F.col("original") != NULL_TEXT)).distinct()
    words: DataFrame | None = None
    for name, df in written.items():
        columns = _texts(df)
        if not columns:
            continue
        each = F.array(*[F.struct(F.lit(c).alias("attribute"), quoted(c).alias("text")) for c in columns])
        cells = df.select(F.explode(each).alias("e")).select(F.lit(name).alias("table"), "e.*").where("text is not null")
        pieces = F.array_distinct(F.concat(F.array("text"), F.regexp_extract_all("text", F.lit(LEAK_WORDS), F.lit(0))))
        part = cells.select("table", "attribute", F.explode(pieces).alias("original"))
        words = part if words is None else words.unionByName(part)
    if words is None:
        raise ValueError("no text was written")
    words = words.where(F.length("original") >= min_chars).groupBy("table", "attribute", "original").agg(F.count("*").alias("n_values"))
    return words.join(originals, "original", "left_semi").select("table", "attribute", "original", "n_values")


def unchanged(df: DataFrame, rules: Sequence[ColumnRule], context: MaskContext) -> DataFrame:
    """Per ruled attribute, how many values there are and how many came through.

    One scan and one row of counters per task, whatever the number of rules.
    """
    originals = {f"__original_{i}": quoted(r.attribute) for i, r in enumerate(rules)}
    masked = mask(df.withColumns(originals), rules, context)
    counters = []
    for i, r in enumerate(rules):
        value = F.col(f"__original_{i}")
        counters.append(F.count(value).alias(f"n{i}"))
        counters.append(F.count(F.when(quoted(r.attribute) == value, 1)).alias(f"u{i}"))
    rows = [
        F.struct(
            F.lit(r.attribute).alias("attribute"),
            F.lit(r.rule).alias("rule"),
            F.col(f"n{i}").alias("n_values"),
            F.col(f"u{i}").alias("n_unchanged"),
        )
        for i, r in enumerate(rules)
    ]
    return masked.agg(*counters).select(F.inline(F.array(*rows)))
