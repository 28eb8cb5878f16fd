"""Mixing sources to target weights.

Words are counted per source, each source's target follows by water filling, and a
document is emitted floor(rate) times plus one more time with probability equal to the
rate's fraction. That draw is a hash of seed and row, so that a rerun, a retried task
and another partitioning all give the same mix.

Defined results: a null or empty text has size 0 and is taken 0 words, a null source is
a source of its own (ordered last), a null document id draws by the rest of its row,
repeated rows draw alike, an empty table or one without words gives targets of 0. Extra
columns stay with ``mixed`` (names of its own columns are replaced).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from maskwright.llm.common import WORD, number, numbered, restored, written

WEIGHTS = (5, 2, 1)
SHARE = 1.5
CAP = 2.0
SEED = 42
#: A source table of up to this many rows is broadcast, a larger one is joined by shuffle.
BROADCAST_SOURCES = 10_000
_UNIT = float(1 << 53)


def size(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def draw(seed: int, *columns: str) -> Column:
    """A uniform number in [0, 1) that depends on seed and row only."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]), 11)
    return bits.cast("double") / F.lit(_UNIT)


def ranked(sources: DataFrame) -> DataFrame:
    """Adds ``_rank`` of each source by code point, null last, without one task for all.

    Sources are range-partitioned; a partition's first rank is the number of sources
    in the partitions before it, of which there are as many as shuffle partitions.
    """
    spark = sources.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = sources.repartitionByRange(n, F.col("source").asc_nulls_last())
    parts = written(parts.withColumn("_part", F.spark_partition_id()), "mix-ranges")
    sizes = sorted((r["_part"], r["n"]) for r in parts.groupBy("_part").agg(F.count("*").alias("n")).collect())
    offsets, before = [], 0
    for part, count in sizes:
        offsets.append((part, before))
        before += count
    offset = spark.createDataFrame(offsets, "_part int, _offset long")
    within = F.row_number().over(_by_source())
    return (
        parts.withColumn("_within", within)
        .join(F.broadcast(offset), "_part")
        .withColumn("_rank", F.col("_offset") + F.col("_within") - 1)
        .drop("_part", "_offset", "_within")
    )


def _by_source():
    from pyspark.sql import Window

    return Window.partitionBy("_part").orderBy(F.col("source").asc_nulls_last())


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """Per source: ``source_size`` and ``target``, from rows (source, size).

    Every source gets level * weight, but at most ``cap`` times its size. The level that
    spends ``share`` of all words is found as the rule says: what capped sources leave
    is shared again by weight until none is above. The driver sees two sums a round.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    sources = written(
        ranked(sources)
        .withColumn("_weight", F.get(cycle, (F.col("_rank") % len(weights)).cast("int")))
        .withColumn("_cap", F.col("source_size") * F.lit(float(cap))),
        "mix-sources",
    )
    total = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0] * float(share)
    level = None
    while total > 0:
        above = F.lit(False) if level is None else F.col("_weight") * F.lit(level) > F.col("_cap")
        row = sources.agg(
            F.sum(F.when(above, F.col("_cap")).otherwise(0.0)).alias("capped"),
            F.sum(F.when(above, 0.0).otherwise(F.col("_weight"))).alias("weight"),
        ).first()
        if not row["weight"]:
            break
        following = (total - row["capped"]) / row["weight"]
        if level is not None and following <= level:
            break
        level = following
    level = F.lit(0.0 if level is None else level)
    return sources.select("source", "source_size", F.least(F.col("_cap"), F.col("_weight") * level).alias("target"))


def plan(df: DataFrame, text: str = "text", source: str = "source", keys: Sequence[str] = ("doc_id",), seed: int = SEED) -> DataFrame:
    """Per row of ``df``: ``keys``, ``size``, ``source_size``, ``target``, ``copies``, ``taken``.

    The text is read once; what follows works on a small written table of sizes.
    """
    small = df.select(
        *[F.col(k) for k in keys],
        F.col(source).alias("source"),
        size(F.col(text)).alias("size"),
        draw(seed, *keys, source, text).alias("_draw"),
    )
    return _taken(written(small, "mix-sizes")).drop("_draw", "source")


def _taken(small: DataFrame) -> DataFrame:
    """Adds target, copies and taken to rows with source, size and draw."""
    per_source = written(targets(small.select("source", "size")), "mix-targets")
    few = per_source.count() <= BROADCAST_SOURCES
    right = per_source.select(F.col("source").alias("_source"), "source_size", "target")
    joined = small.join(
        F.broadcast(right) if few else right, F.col("source").eqNullSafe(F.col("_source")), "inner"
    ).drop("_source")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.floor(rate)
    copies = (whole + F.when(F.col("_draw") < rate - whole, 1).otherwise(0)).cast("long")
    return joined.withColumn("copies", copies).withColumn("taken", F.col("size") * F.col("copies"))


def mixed(df: DataFrame, text: str = "text", source: str = "source", key: str = "doc_id", seed: int = SEED) -> DataFrame:
    """The mix itself: every row of ``df`` as often as it is taken, with ``copy`` from 0 (which
    replaces a column of that name). Rows of sources without words are not taken. No row is
    sent by key: the targets go to the rows.
    """
    rows, names = numbered(df)
    text, source, key = (number(names, c) for c in (text, source, key))
    sizes = rows.select(F.col(source).alias("source"), size(F.col(text)).alias("size"))
    per_source = written(targets(sizes), "mix-targets")
    few = per_source.count() <= BROADCAST_SOURCES
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    right = per_source.select(F.col("source").alias("_source"), rate.alias("_rate"))
    joined = rows.join(F.broadcast(right) if few else right, F.col(source).eqNullSafe(F.col("_source")), "inner")
    whole = F.floor("_rate")
    copies = (whole + F.when(draw(seed, key, source, text) < F.col("_rate") - whole, 1).otherwise(0)).cast("int")
    numbers = F.when(copies > 0, F.sequence(F.lit(0), copies - 1)).otherwise(F.array().cast("array<int>"))
    return restored(joined.select("*", F.explode(numbers).alias("copy")), names, "copy")
