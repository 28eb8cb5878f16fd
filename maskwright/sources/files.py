"""Finding, reading and writing the data files below a root directory.

Files are grouped into datasets, each read and written as one DataFrame: the
files of one directory, or all files below a directory of ``key=value``
partitions, or a single file directly in the root.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from maskwright.sources.local import local_frame

FORMATS = ("csv", "parquet")

# Stands for "no value" while reading CSV, so that "" stays an empty text.
NO_VALUE = "\u0001"

# A header that is longer has a quote that nothing closes.
HEADER_CHARS = 1 << 20
# CSV headers read at a time.
HEADER_THREADS = 32
# Parquet is split by row groups, usually of about this size.
ROW_GROUP_BYTES = 128 * 1024 * 1024
# No task needs less input than this.
SPREAD_BYTES = 2 * 1024 * 1024

_PARTITION_DIRS = r"(/[^/=]+=[^/]*)+$"


def qualified(spark: SparkSession, path: str) -> str:
    """The full URI Spark uses for a path."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(p).toString()


def inventory(spark: SparkSession, root: str) -> DataFrame:
    """``files(path, n_bytes, changed, rel_dir, table, file_name, format, dataset, layout, keys)``.

    Only file names are read, not contents.  Hidden files and markers such as
    ``_SUCCESS`` or ``.crc`` are left out, and files of other kinds have a null
    format.  A file in the root is a table named after its stem; anything deeper
    belongs to the table named after its top directory.
    """
    base = qualified(spark, root).rstrip("/")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    relative = F.substring("path", len(base) + 2, 1 << 30)
    rel_dir = F.regexp_replace("relative", r"/?[^/]*$", "")
    file_name = F.regexp_extract("relative", r"([^/]*)$", 1)
    suffix = F.regexp_extract("file_name", r"\.([^.]*)$", 1)
    in_root = F.col("rel_dir") == ""
    stem = F.regexp_replace("file_name", r"\.[^.]*$", "")
    top = F.regexp_replace(F.substring_index("rel_dir", "/", 1), r"\.(csv|parquet)$", "")
    partition_dirs = F.regexp_extract("rel_dir", _PARTITION_DIRS, 0)
    return (
        files.select("path", F.col("length").alias("n_bytes"), F.col("modificationTime").alias("changed"), relative.alias("relative"))
        .select("path", "n_bytes", "changed", rel_dir.alias("rel_dir"), file_name.alias("file_name"))
        .select(
            "path",
            "n_bytes",
            "changed",
            "rel_dir",
            F.when(in_root, stem).otherwise(top).alias("table"),
            "file_name",
            F.when(suffix.isin(*FORMATS), suffix).alias("format"),
            F.when(in_root, F.col("file_name"))
            .otherwise(F.regexp_replace("rel_dir", _PARTITION_DIRS, ""))
            .alias("dataset"),
            F.when(in_root, "file")
            .when(partition_dirs == "", "flat")
            .otherwise("partitioned")
            .alias("layout"),
            F.regexp_extract_all(partition_dirs, F.lit("/([^/=]+)="), F.lit(1)).alias("keys"),
        )
    )


def file_counts(files: DataFrame) -> DataFrame:
    """Number of data files per format."""
    return files.where(F.col("format").isNotNull()).groupBy("format").agg(F.count("*").alias("n_files"))


@dataclass(frozen=True)
class Dataset:
    """Files that are read, masked and written together."""

    table: str
    path: str
    format: str
    layout: str
    keys: tuple[str, ...] = ()
    shared: bool = False
    n_files: int = 1
    n_bytes: int = 0
    stamp: int = 0  # of the names, sizes and times of its files

    @property
    def target(self) -> str:
        """Where it goes, relative to the output root."""
        return f"{self.path}/{self.format}-{self.layout}" if self.shared else self.path


def datasets(files: DataFrame) -> list[Dataset]:
    """The datasets of an inventory, parents before children.

    There is one per directory, however many files that holds.
    """
    rows = (
        files.where(F.col("format").isNotNull())
        .groupBy("table", "dataset", "format", "layout")
        .agg(
            F.first("keys").alias("keys"),
            F.count("*").alias("n_files"),
            F.sum("n_bytes").alias("n_bytes"),
            F.bit_xor(F.xxhash64("path", "n_bytes", "changed")).alias("stamp"),
        )
        .collect()
    )
    kinds: dict[str, int] = {}
    for r in rows:
        kinds[r["dataset"]] = kinds.get(r["dataset"], 0) + 1
    found = [
        Dataset(
            r["table"],
            r["dataset"],
            r["format"],
            r["layout"],
            tuple(r["keys"]),
            kinds[r["dataset"]] > 1,
            r["n_files"],
            r["n_bytes"],
            r["stamp"],
        )
        for r in rows
    ]
    return sorted(found, key=lambda d: (d.path, d.format, d.layout))


def _escaped(path: str) -> str:
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def csv_options(multiline: bool = True) -> dict[str, object]:
    """How CSV is read: fields as text, as pandas and spreadsheets write them.

    ``multiline`` allows line breaks inside quotes, at the price that a file is
    not split.  Rows that do not fit the header are errors: shifted columns would
    escape their rules.
    """
    return {
        "header": True,
        "multiLine": multiline,
        "escape": '"',
        "nullValue": NO_VALUE,
        "emptyValue": "",
        "mode": "FAILFAST",
        "enforceSchema": False,
    }


def _first_record(spark: SparkSession, path) -> str:
    """The header of a CSV file: its first line, or more if quotes are open."""
    stream = path.getFileSystem(spark._jsc.hadoopConfiguration()).open(path)
    java = spark._jvm.java.io
    reader = java.BufferedReader(java.InputStreamReader(stream, "UTF-8"))
    try:
        record = line = reader.readLine()
        while line is not None and record.count('"') % 2:
            if len(record) > HEADER_CHARS:
                raise ValueError("a header has an open quote")
            line = reader.readLine()
            record = f"{record}\n{line or ''}"
        return record or ""
    finally:
        reader.close()


def _files_by_header(spark: SparkSession, df: DataFrame) -> list[list[str]]:
    """The CSV files behind a DataFrame, grouped by header; empty files left out.

    Reads one line per file, many files at a time.
    """
    jvm = spark._jvm
    paths = [jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(f)) for f in sorted(df.inputFiles())]
    with ThreadPoolExecutor(HEADER_THREADS) as pool:
        headers = list(pool.map(lambda p: _first_record(spark, p), paths))
    groups: dict[str, list[str]] = {}
    for header, path in zip(headers, paths):
        if header:
            groups.setdefault(header, []).append(path.toString())
    return list(groups.values())


def read_dataset(
    spark: SparkSession, root: str, dataset: Dataset, csv_multiline: bool = True
) -> DataFrame:
    """A dataset with the union of its files' columns; partition values as text.

    CSV files of one directory may differ in their headers; each is read with its
    own, and columns are matched by name.
    """
    where = f"{root.rstrip('/')}/{dataset.path}"
    patterns = {
        "file": _escaped(where),
        "flat": f"{_escaped(where)}/[!._]*.{dataset.format}",
        "partitioned": f"{_escaped(where)}/*=*",
    }

    def reader(multiline: bool) -> DataFrameReader:
        r = spark.read.format(dataset.format)
        if dataset.layout == "partitioned":
            r = r.option("basePath", where).option("pathGlobFilter", f"*.{dataset.format}")
        if dataset.format == "parquet":
            return r.option("mergeSchema", True)
        return r.options(**csv_options(multiline))

    def load(paths: str | list[str]) -> DataFrame:
        # The header is one line; in multi-line mode Spark takes the brackets of a
        # file name for a pattern while it looks for the columns.
        found = reader(False).load(paths)
        if dataset.format == "parquet" and dataset.layout != "partitioned":
            return found
        # The text of partition values must survive: 007 is not 7.
        fields = [
            T.StructField(f.name, T.StringType() if f.name in dataset.keys else f.dataType, True)
            for f in found.schema
        ]
        return reader(csv_multiline).schema(T.StructType(fields)).load(paths)

    df = load(patterns[dataset.layout])
    if dataset.format == "parquet" or dataset.n_files == 1:
        return df
    groups = _files_by_header(spark, df)
    if len(groups) < 2 and sum(map(len, groups)) == dataset.n_files:
        return df
    parts = [load([_escaped(path) for path in group]) for group in groups]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def _leaf(dataset: Dataset) -> bool:
    return dataset.format == "parquet" and dataset.layout == "flat" and not dataset.shared


def together(found: list[tuple[Dataset, DataFrame]]) -> list[list[Dataset]]:
    """The Parquet directories of one table that can be read and written as one: those of the
    same columns and types, none of which lies inside another dataset or holds one."""
    paths = {d.path for d, _ in found}
    above = {p: {"/".join(p.split("/")[:i]) for i in range(1, p.count("/") + 1)} & paths for p in paths}
    nested = {p for p, parents in above.items() if parents}.union(*above.values())
    groups: dict[tuple[str, str], list[Dataset]] = {}
    for d, df in found:
        if _leaf(d) and d.path not in nested:
            groups.setdefault((d.table, df.schema.json()), []).append(d)
    return [group for group in groups.values() if len(group) > 1]


_AUTHORITY = r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?"


def _encoded(spark: SparkSession, path: str) -> str:
    """A directory the way ``_metadata.file_path`` writes it, without store and host."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(p).toUri().getRawPath()


def read_together(spark: SparkSession, root: str, found: list[Dataset], schema: T.StructType, number: str) -> DataFrame:
    """Directories of one schema as one DataFrame; column ``number`` has each row's directory."""
    where = [f"{root.rstrip('/')}/{d.path}" for d in found]
    files = spark.read.schema(schema).parquet(*[f"{_escaped(w)}/[!._]*.parquet" for w in where])
    folder = F.regexp_replace(F.regexp_replace(F.col("_metadata.file_path"), "/[^/]*$", ""), _AUTHORITY, "")
    names = local_frame(spark, [(_encoded(spark, w), i) for i, w in enumerate(where)], "__folder string, __number int")
    # A row per directory, known to the driver anyway. No row may get lost for want of one.
    placed = files.withColumn("__folder", folder).join(F.broadcast(names), "__folder", "left")
    lost = F.raise_error(F.lit("a row of no known directory")).cast("int")
    return placed.withColumn(number, F.coalesce("__number", lost)).drop("__folder", "__number")


def write_together(
    df: DataFrame, root: str, found: list[Dataset], number: str, overwrites: Callable[[Dataset], bool] = lambda d: False
) -> dict[str, int]:
    """Write rows to the directory their ``number`` says, all in one job; rows per dataset path.

    The job writes partitions into a staging directory, which then take their places: until
    it has ended well, nothing is seen of it.
    """
    spark, base = df.sparkSession, root.rstrip("/")
    staging = f"{base}/_staging-{uuid.uuid4().hex}"
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path
    fs = jvm_path(base).getFileSystem(spark._jsc.hadoopConfiguration())
    try:
        df.write.mode("error").partitionBy(number).parquet(staging)
        # Without columns, counting reads footers only.
        staged = spark.read.schema(f"{number} int").option("basePath", staging).parquet(staging)
        counts = {r[number]: r["count"] for r in staged.groupBy(number).count().collect()}

        def place(i: int) -> None:
            target, written = jvm_path(f"{base}/{found[i].target}"), jvm_path(f"{staging}/{number}={i}")
            if overwrites(found[i]) and fs.exists(target):
                fs.delete(target, True)
            fs.mkdirs(target.getParent())
            if i in counts and not fs.rename(written, target):
                raise OSError(f"cannot place {found[i].target}")

        with ThreadPoolExecutor(HEADER_THREADS) as pool:
            list(pool.map(place, range(len(found))))
    finally:
        fs.delete(jvm_path(staging), True)
    return {d.path: counts.get(i, 0) for i, d in enumerate(found)}


def target_exists(spark: SparkSession, root: str, dataset: Dataset) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{dataset.target}")
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def spread(df: DataFrame, n_files: int, n_bytes: int, splittable: bool = True) -> DataFrame:
    """Give small or unsplittable input to all cores.

    Masking costs far more time per byte than shuffling.  Where the files would
    be read by fewer than half of the tasks the cluster can run at once (one large
    CSV, one Parquet row group), the rows are dealt out first.  Anything larger
    has splits enough and is masked where it is read.
    """
    sources = max(n_files, n_bytes // ROW_GROUP_BYTES if splittable else 0)
    wanted = min(df.sparkSession.sparkContext.defaultParallelism, -(-n_bytes // SPREAD_BYTES))
    return df.repartition(wanted) if wanted > 2 * sources else df


def spread_path(df: DataFrame, path: str) -> DataFrame:
    """``spread`` for a Parquet table read from one path."""
    spark = df.sparkSession
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    size = p.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(p)
    return spread(df, size.getFileCount(), size.getLength())


def write_dataset(df: DataFrame, root: str, dataset: Dataset, overwrite: bool = False) -> None:
    """Write a masked dataset to the same relative place below another root."""
    writer = df.write.format(dataset.format).mode("overwrite" if overwrite else "error")
    if dataset.format == "csv":
        writer = writer.options(
            header=True,
            escape='"',
            nullValue="",
            emptyValue='""',
            ignoreLeadingWhiteSpace=False,
            ignoreTrailingWhiteSpace=False,
        )
    if dataset.keys:
        writer = writer.partitionBy(*dataset.keys)
    writer.save(f"{root.rstrip('/')}/{dataset.target}")
