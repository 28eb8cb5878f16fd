"""What a job has written, so that the next run does only what is left or has changed.

After a dataset is in its place, a line in ``_manifest`` below the output says from what it was
made: a print of its files (names, sizes, times), its columns, its rules and the scopes of its
masks. A run that resumes passes over datasets whose print is the same and whose copy is there.
Lines are small files of their own, written once and never changed; the last one of a dataset
counts.
"""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from maskwright.functions.generator import MaskContext
from maskwright.operators.masking import ColumnRule
from maskwright.sources.files import Dataset

MANIFEST_SCHEMA = "target string, print string, n_rows long, run_id string, at long"


def fingerprint(dataset: Dataset, df: DataFrame, rules: Sequence[ColumnRule], context: MaskContext, dictionary: bool) -> str:
    """Changes with anything the masked copy depends on. What a dictionary holds can change from
    run to run, so with one only the same run is resumed, as with rules of a single run."""
    single = dictionary or any(r.ref_integrity == "N" for r in rules)
    scope = context.tag(context.scope("Y")), context.run_id if single else None
    made_from = [
        dataset.path, dataset.format, dataset.layout, dataset.n_files, dataset.n_bytes, dataset.stamp, df.schema.json(),
        [[r.attribute, r.rule, r.ref_integrity, r.condition] for r in rules],
        hashlib.sha256(repr(scope).encode()).hexdigest(),
    ]
    return hashlib.sha256(json.dumps(made_from).encode()).hexdigest()


def record(spark: SparkSession, output: str, lines: Sequence[tuple[Dataset, str, int | None]], run_id: str) -> None:
    """Notes datasets that are in their places: (dataset, fingerprint, rows)."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{output.rstrip('/')}/_manifest/{uuid.uuid4().hex}.json")
    now = time.time_ns()
    text = "".join(
        json.dumps({"target": d.target, "print": mark, "n_rows": n, "run_id": run_id, "at": now}) + "\n" for d, mark, n in lines
    )
    stream = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path, False)
    try:
        stream.write(text.encode())
    finally:
        stream.close()


def manifest(spark: SparkSession, output: str) -> DataFrame:
    """(target, print, n_rows, run_id, at): the last line of every dataset."""
    base = f"{output.rstrip('/')}/_manifest"
    path = spark._jvm.org.apache.hadoop.fs.Path(base)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], MANIFEST_SCHEMA)
    lines = spark.read.schema(MANIFEST_SCHEMA).json(f"{base}/*.json")
    last = lines.groupBy("target").agg(F.max_by(F.struct("print", "n_rows", "run_id", "at"), "at").alias("l"))
    return last.select("target", "l.*")
