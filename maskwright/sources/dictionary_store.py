"""Mask dictionaries on disk.

A dictionary only ever grows, so each run appends one version directory with its
new entries instead of rewriting all of them.  Nothing that is being read is ever
overwritten.

Two runs may extend a dictionary at a time.  A run writes aside and then takes the number
after the last version it has read, by a rename that fails if the number is taken.  The loser
reads what the winner added, leaves out what is known by now, and tries the next number, so
that no entry is lost and none is there twice.

Versions are merged by level: as soon as ``FANOUT`` neighbours of one level are there, they are
written as one of the next, ``merged=first-last``.  A reader takes the widest units, so after n
runs it reads some FANOUT * log(n) of them.  What a merged unit covers stays for readers that
began before, until ``vacuum_dictionary``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from maskwright.operators.dictionary import DICTIONARY_SCHEMA, IMPORTED, MAKER, empty_dictionary
from maskwright.sources.files import csv_options

_VERSION, _MERGED = "version=", "merged="
#: So many neighbours of one level become one of the next.
FANOUT = 8

# A directory of entries: the first and the last version it holds.
_Unit = tuple[int, int]


def _file_system(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _directories(spark: SparkSession, base: str) -> list[tuple[_Unit, bool]]:
    """Every version and merged directory, and whether it is committed."""
    fs, path = _file_system(spark, base)
    if not fs.exists(path):
        return []
    found = []
    for status in fs.listStatus(path):
        name = status.getPath().getName()
        numbers = name.removeprefix(_VERSION).removeprefix(_MERGED).split("-")
        if name.startswith((_VERSION, _MERGED)) and all(n.isdigit() for n in numbers):
            marker = spark._jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")
            found.append(((int(numbers[0]), int(numbers[-1])), fs.exists(marker)))
    return sorted(found)


def _last(units: list[tuple[_Unit, bool]]) -> int:
    return max((last for (_, last), _ in units), default=0)


def _widest(units: list[tuple[_Unit, bool]]) -> list[_Unit]:
    """The committed units that no other one covers, in order."""
    done = {unit for unit, committed in units if committed}
    return sorted(u for u in done if not any(o != u and o[0] <= u[0] and u[1] <= o[1] for o in done))


def _directory(base: str, unit: _Unit) -> str:
    name = f"{_VERSION}{unit[0]}" if unit[0] == unit[1] else f"{_MERGED}{unit[0]}-{unit[1]}"
    return f"{base.rstrip('/')}/{name}"


def _has_makers(spark: SparkSession, directory: str) -> bool:
    """Whether a version says who made its entries, as all do but old ones."""
    fs, path = _file_system(spark, directory)
    parts = fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(path, f"scope=*/{MAKER}=*"))
    return len(parts) > 0


def _read(spark: SparkSession, base: str, units: list[_Unit]) -> DataFrame:
    """(scope, original, masked, maker) of the units; scope and maker are partition columns."""
    found = [empty_dictionary(spark).withColumn(MAKER, F.lit(IMPORTED))] if not units else []
    kinds: dict[tuple[bool, bool], list[str]] = {}
    for unit in units:
        path = _directory(base, unit)
        kinds.setdefault((unit[0] == unit[1], _has_makers(spark, path)), []).append(path)
    for (single, makers), paths in kinds.items():
        schema = f"{DICTIONARY_SCHEMA}, {MAKER} string" if makers else DICTIONARY_SCHEMA
        schema += ", version int" if single else ", merged string"
        part = spark.read.option("basePath", base).schema(schema).parquet(*paths)
        found.append(part if makers else part.withColumn(MAKER, F.lit(IMPORTED)))
    return reduce(DataFrame.unionByName, [f.select("scope", "original", "masked", MAKER) for f in found])


def load_dictionary(spark: SparkSession, base: str, makers_too: bool = False) -> DataFrame:
    """All committed entries; an empty dictionary where none was written yet.

    Scope and maker are partition columns, so a lookup reads only entries of its own scope, and
    none that it could make itself.
    """
    columns = ["scope", "original", "masked", *([MAKER] if makers_too else [])]
    return _read(spark, base, _widest(_directories(spark, base))).select(*columns)


def _staged(entries: DataFrame, base: str) -> str:
    """Writes entries aside; a name that begins with _ is no version."""
    path = f"{base.rstrip('/')}/_staging-{uuid.uuid4().hex}"
    if MAKER not in entries.columns:
        entries = entries.withColumn(MAKER, F.lit(IMPORTED))
    entries.select("scope", "original", "masked", MAKER).write.mode("error").partitionBy("scope", MAKER).parquet(path)
    return path


def _placed(spark: SparkSession, staged: str, target: str) -> bool:
    """Renames a directory unless the target is there; whether it did."""
    jvm = spark._jvm
    source, goal = jvm.org.apache.hadoop.fs.Path(staged), jvm.org.apache.hadoop.fs.Path(target)
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(goal.toUri(), spark._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.valueOf("NONE")
    fs, _ = _file_system(spark, target)
    if fs.exists(goal):
        return False
    try:
        files.rename(source, goal, options)
    except Exception:
        if fs.exists(goal):
            return False
        raise
    return True


def extend_dictionary(spark: SparkSession, base: str, make: Callable[[DataFrame], DataFrame]) -> None:
    """Adds the entries that ``make`` finds lacking in the dictionary it is given, as a new version."""
    seen = _directories(spark, base)
    known = {unit for unit, done in seen if done}
    staged = _staged(make(_read(spark, base, _widest(seen))), base)
    while not _placed(spark, staged, _directory(base, (_last(seen) + 1,) * 2)):
        # Another run was faster. Its entries came first.
        seen = _directories(spark, base)
        added = sorted({unit for unit, done in seen if done and unit[0] == unit[1]} - known)
        known |= set(added)
        own = spark.read.schema(f"{DICTIONARY_SCHEMA}, {MAKER} string").parquet(staged)
        theirs = _read(spark, base, added).select("scope", "original")
        staged, before = _staged(own.join(theirs, ["scope", "original"], "left_anti"), base), staged
        fs, path = _file_system(spark, before)
        fs.delete(path, True)


def append_entries(entries: DataFrame, base: str) -> None:
    """Add entries the dictionary does not have yet as a new version."""
    extend_dictionary(entries.sparkSession, base, lambda _: entries)


def compact_dictionary(spark: SparkSession, base: str) -> int:
    """Merges neighbours of one level until no ``FANOUT`` of them are left; how many merges."""
    merges = 0
    while True:
        units = _widest(_directories(spark, base))
        runs: list[list[_Unit]] = []
        for unit in units:
            level = _level(unit)
            if runs and _level(runs[-1][0]) == level and runs[-1][-1][1] + 1 == unit[0] and len(runs[-1]) < FANOUT:
                runs[-1].append(unit)
            else:
                runs.append([unit])
        full = next((run for run in runs if len(run) == FANOUT), None)
        if full is None:
            return merges
        target = _directory(base, (full[0][0], full[-1][1]))
        staged = _staged(_read(spark, base, full), base)
        if not _placed(spark, staged, target):  # another run did the same
            fs, path = _file_system(spark, staged)
            fs.delete(path, True)
        merges += 1


def _level(unit: _Unit) -> int:
    level, width = 0, unit[1] - unit[0] + 1
    while width >= FANOUT:
        level, width = level + 1, width // FANOUT
    return level


def vacuum_dictionary(spark: SparkSession, base: str) -> int:
    """Removes versions that merged ones cover; how many. Not while older readers are at work."""
    units = _directories(spark, base)
    covered = {unit for unit, done in units if done} - set(_widest(units))
    for unit in covered:
        fs, path = _file_system(spark, _directory(base, unit))
        fs.delete(path, True)
    return len(covered)


def import_csv(spark: SparkSession, path: str, scope: str) -> DataFrame:
    """A dictionary kept as CSV with the columns Original and Masked Values.

    Should an original occur twice, its smallest mask is taken.
    """
    raw = spark.read.options(**csv_options()).csv(path)
    return (
        raw.where(F.col("Original").isNotNull())
        .groupBy(F.lit(scope).alias("scope"), F.col("Original").alias("original"))
        .agg(F.min("Masked Values").alias("masked"))
    )


def export_csv(dictionary: DataFrame, path: str) -> None:
    """Write a dictionary as CSV with the columns Original and Masked Values."""
    (
        dictionary.select(
            F.col("original").alias("Original"), F.col("masked").alias("Masked Values")
        )
        .write.mode("error")
        .options(
            header=True,
            escape='"',
            ignoreLeadingWhiteSpace=False,
            ignoreTrailingWhiteSpace=False,
        )
        .csv(path)
    )
