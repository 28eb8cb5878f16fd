"""The catalog: which tables and columns lie below an input path."""

from __future__ import annotations

import warnings
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from maskwright.operators.rulebook import table_id
from maskwright.sources.files import Dataset, datasets, inventory, read_dataset
from maskwright.sources.local import local_frame

# Datasets whose columns are looked up at a time.
READ_THREADS = 16

CATALOG_SCHEMA = (
    "table string, dataset string, format string, column string, position int, type string"
)


def read_all(
    spark: SparkSession, root: str, found: list[Dataset], csv_multiline: bool = True
) -> list[DataFrame | Exception]:
    """Each dataset as a DataFrame, or why it cannot be read.

    Only Parquet footers and CSV header lines are read.  Files of one dataset
    may differ: their columns are merged in first-seen order.
    """

    def read(d: Dataset) -> DataFrame | Exception:
        try:
            return read_dataset(spark, root, d, csv_multiline)
        except Exception as error:  # a broken table must not hide the others
            return error

    with ThreadPoolExecutor(READ_THREADS) as pool:
        return list(pool.map(read, found))


def catalog_of(
    spark: SparkSession, found: list[Dataset], frames: list[DataFrame | Exception]
) -> DataFrame:
    """``catalog(table, table_norm, dataset, format, column, position, type)``.

    Datasets that cannot be read have no columns in it, and a warning.
    """
    rows = []
    for d, frame in zip(found, frames):
        if isinstance(frame, Exception):
            warnings.warn(f"cannot read {d.path}: {type(frame).__name__}", stacklevel=2)
            continue
        rows += [
            (d.table, d.path, d.format, f.name, i, f.dataType.simpleString())
            for i, f in enumerate(frame.schema, start=1)
        ]
    frame = local_frame(spark, rows, CATALOG_SCHEMA)
    return frame.select(
        "table", table_id(F.col("table")).alias("table_norm"), *frame.columns[1:]
    )


def catalog(spark: SparkSession, root: str) -> DataFrame:
    found = datasets(inventory(spark, root))
    return catalog_of(spark, found, read_all(spark, root, found))


def wide(catalog_df: DataFrame) -> DataFrame:
    """One column per table, its column names below each other, numbered from 1.

    Datasets of a table count once (``roll_up``).  Tables keep their own names, as two of
    them can share a normalised one (``name_clashes``).
    """
    order = Window.partitionBy("table").orderBy("dataset", "position")
    rolled = roll_up(catalog_df).withColumn("position", F.row_number().over(order))
    tables = sorted(r["table"] for r in catalog_df.select("table").distinct().collect())
    return rolled.groupBy("position").pivot("table", tables).agg(F.min("column"))


def name_clashes(names: DataFrame) -> DataFrame:
    """Normalised names with the number of raw names behind each of them.

    More than one raw name means that rules cannot tell those tables apart.
    """
    raw = names.select("table").distinct()
    return raw.groupBy(table_id(F.col("table")).alias("table_norm")).agg(
        F.count("*").alias("n_names"), F.min("table").alias("first_name")
    )


def schema_mismatches(catalog_df: DataFrame) -> DataFrame:
    """Columns that not all datasets of a table have alike.

    ``n_present`` of ``n_datasets`` have the column; positions and types say
    whether it moved or changed.
    """
    sizes = catalog_df.groupBy("table").agg(
        F.count_distinct("dataset", "format").alias("n_datasets")
    )
    columns = catalog_df.groupBy("table", "column").agg(
        F.count("*").alias("n_present"),
        F.min("position").alias("min_position"),
        F.max("position").alias("max_position"),
        F.min("type").alias("min_type"),
        F.max("type").alias("max_type"),
    )
    return columns.join(sizes, "table").where(
        "n_present < n_datasets or min_position < max_position or min_type < max_type"
    )


def roll_up(catalog_df: DataFrame) -> DataFrame:
    """The columns of each table: its datasets' columns, first seen first."""
    return (
        catalog_df.groupBy("table", "table_norm", "column")
        .agg(F.min(F.struct("dataset", "position")).alias("seen"), F.min("type").alias("type"))
        .select("table", "table_norm", "column", "type", "seen.dataset", "seen.position")
    )
