"""What the training-data operators share: reading, cutting lineage, let-binding."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of the word definition shared by most operators, and its complement as a word.
SPACES = " \t\n\x0b\f\r"
SPACE_RUN = "[\\x20\\x09-\\x0D]+"
WORD = "[^\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: that of ``spark.checkpoint.dir``.

    Where the setting is unset, a local session gets a temporary folder; on a cluster
    that is an error, as executors would not see each other's files.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if configured is None:
            if not sc.master.startswith("local[") and sc.master != "local":
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            configured = tempfile.mkdtemp(prefix="shared-")
        sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def shared_path(spark: SparkSession, what: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark)}/{what}-{uuid.uuid4().hex}"


def written(df: DataFrame, what: str, **options: str) -> DataFrame:
    """``df`` as a table in the shared folder: computed once, lineage cut, safe if executors go."""
    path = shared_path(df.sparkSession, what)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bound(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Adds a column that is computed once per row, however often lambdas refer to it.

    The optimizer would otherwise put the expression into each use, also into lambda
    bodies, where it ran once per element. A generator of one row is not merged.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


def plain_words(text: Column) -> Column:
    """The words of a text; none for null. Splits at one literal blank, which is much
    cheaper than a pattern."""
    spaced = F.coalesce(text, F.lit(""))
    for other in SPACES[1:]:
        spaced = F.replace(spaced, F.lit(other), F.lit(" "))
    return F.array_remove(F.split(spaced, " ", -1), "")


def numbered(df: DataFrame) -> tuple[DataFrame, list[str]]:
    """``df`` with its columns named c0, c1, ..., and their names: whatever a caller's columns
    are called, an operator's own can be added beside them."""
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))]), df.columns


def number(names: list[str], name: str) -> str:
    return f"c{names.index(name)}"


def restored(df: DataFrame, names: list[str], *results: str) -> DataFrame:
    """The numbered columns under their names, then results, which replace columns of theirs."""
    taken = {r.lower() for r in results}
    kept = [F.col(f"c{i}").alias(name) for i, name in enumerate(names) if name.lower() not in taken]
    return df.select(*kept, *results)


def discarded(*tables: DataFrame) -> None:
    """Removes tables of ``written`` that nothing reads any more."""
    for df in tables:
        spark = df.sparkSession
        for folder in {name.rsplit("/", 1)[0] for name in df.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
