"""Cross-site boilerplate: lines that stand on many distinct sites.

Each line hash gets a HyperLogLog sketch of its sites; sketches are merged by Spark's
aggregation, so a line on a third of all rows is combined in every task before it is
shuffled. Only lines whose estimate is near the threshold are counted exactly. A line
found on ``MIN_SITES`` sites or more is removed wherever it stands but in the document of
the smallest id that has it, so that no line is lost to the corpus.

Lines are the parts between ``\\n``, compared without white space at their ends; those
shorter than ``MIN_CHARS`` are left alone. Built-in expressions only.

Defined results: a null text stays null and has no lines; a null site is a site of its
own; rows without an id keep a line only if no row with an id has it; repeated rows keep
or lose the same lines and count as one site; very long texts are cut in their row; an
empty table stays empty; extra columns are kept and may have any names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from maskwright.llm.common import SPACES, WORD, bound, number, numbered, restored, written

MIN_SITES = 10
MIN_CHARS = 10
#: Sketches of 2^LOG_SIZE buckets: a standard error of 1.6 percent.
LOG_SIZE = 12
#: Estimates within this share of the threshold (over six errors) are counted exactly.
NEAR = 0.1
#: Rows that may be broadcast; more are joined by shuffle.
BROADCAST_ROWS = 1_000_000


def _trimmed(line: Column) -> Column:
    return F.btrim(line, F.lit(SPACES))


def _lines(docs: DataFrame) -> DataFrame:
    """Rows (id, version, site, place, hash), one for each line that may be boilerplate."""
    line = docs.select("id", "version", "site", F.posexplode(F.split("text", "\n", -1)).alias("place", "line"))
    line = line.withColumn("line", _trimmed(F.col("line"))).where(F.length("line") >= MIN_CHARS)
    return line.select("id", "version", "site", "place", F.xxhash64("line").alias("hash"))


def boilerplate(lines: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """Written rows (hash, first): the lines on at least ``min_sites`` sites, and the smallest
    id among their documents."""
    spread = lines.groupBy("hash").agg(
        F.count("*").alias("n"), F.hll_sketch_agg("site", LOG_SIZE).alias("sketch"), F.min("id").alias("first")
    )
    spread = spread.where(F.col("n") >= min_sites).select("hash", "first", F.hll_sketch_estimate("sketch").alias("sites"))
    spread = written(spread.where(F.col("sites") >= min_sites * (1 - NEAR)), "line-spread")
    near = spread.where(F.col("sites") <= min_sites * (1 + NEAR)).select("hash", "first")
    exact = _joined(lines.select("hash", "site"), near, "inner").groupBy("hash", "first").agg(F.count_distinct("site").alias("sites"))
    sure = spread.where(F.col("sites") > min_sites * (1 + NEAR)).select("hash", "first")
    return written(sure.unionByName(exact.where(F.col("sites") >= min_sites).select("hash", "first")), "boilerplate")


def _joined(lines: DataFrame, found: DataFrame, how: str) -> DataFrame:
    return lines.join(F.broadcast(found) if found.count() <= BROADCAST_ROWS else found, "hash", how)


def _cleaned(df: DataFrame, names: list[str], key: str, text: str, site: str, min_sites: int) -> DataFrame:
    """Numbered rows with the text replaced, ``n_lines`` and ``n_removed``."""
    key, text, site = (number(names, c) for c in (key, text, site))
    docs = df.select(
        F.col(key).alias("id"), F.xxhash64(F.col(text)).alias("version"), F.col(text).alias("text"),
        F.coalesce(F.concat(F.lit("s"), F.col(site).cast("string")), F.lit("")).alias("site"),
    )
    lines = _lines(docs)
    hits = _joined(lines, boilerplate(lines, min_sites), "inner").where(~F.col("id").eqNullSafe(F.col("first")) & F.col("first").isNotNull())
    removed = written(hits.groupBy("id", "version").agg(F.collect_set("place").alias("places")), "removed-lines")
    right = removed.select(F.col("id").alias("_id"), F.col("version").alias("_version"), F.col("places").alias("_places"))
    right = F.broadcast(right) if removed.count() <= BROADCAST_ROWS else right.hint("shuffle_hash")
    on = F.col(key).eqNullSafe(F.col("_id")) & (F.xxhash64(F.col(text)) == F.col("_version"))
    rows = bound(df.join(right, on, "left"), "_lines", F.split(F.col(text), "\n", -1))
    kept = F.expr("array_join(transform(array_except(sequence(0, size(_lines) - 1), _places), i -> get(_lines, i)), '\n')")
    return rows.withColumns({
        text: F.when(F.col("_places").isNull(), F.col(text)).otherwise(kept),
        "n_lines": F.greatest(F.coalesce(F.size("_lines"), F.lit(0)), F.lit(0)).cast("long"),
        "n_removed": F.greatest(F.coalesce(F.size("_places"), F.lit(0)), F.lit(0)).cast("long"),
    })


def without_boilerplate(df: DataFrame, key: str = "doc_id", text: str = "text", site: str = "source", min_sites: int = MIN_SITES) -> DataFrame:
    """``df`` with boilerplate lines taken out of ``text``, and two columns more: ``n_lines`` and
    ``n_removed`` (replacing columns of that name)."""
    rows, names = numbered(df)
    return restored(_cleaned(rows, names, key, text, site, min_sites), names, "n_lines", "n_removed")


def cleaned(df: DataFrame, key: str = "doc_id", text: str = "text", site: str = "source", length: str = "n_chars", min_sites: int = MIN_SITES) -> DataFrame:
    """``df`` with its own columns: texts without boilerplate, ``length`` (if there is such a
    column) following the text, and without the rows whose last word has gone."""
    rows, names = numbered(df)
    rows = _cleaned(rows, names, key, text, site, min_sites)
    now = F.col(number(names, text))
    rows = rows.where((F.col("n_removed") == 0) | now.rlike(WORD))
    if length in names:
        at = number(names, length)
        kind = df.schema[names.index(length)].dataType
        rows = rows.withColumn(at, F.when(F.col("n_removed") > 0, F.length(now)).otherwise(F.col(at)).cast(kind))
    return restored(rows, names)
