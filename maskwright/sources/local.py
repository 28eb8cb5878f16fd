"""Small tables made on the driver: rulebooks, catalogs, summaries."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import IntegerType, LongType, StructType

_ARROW = {IntegerType: pa.int32(), LongType: pa.int64()}


def local_frame(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """Rows as a DataFrame whose size Spark knows, so that it can be broadcast."""
    fields = StructType.fromDDL(schema).fields
    columns = {
        f.name: pa.array([row[i] for row in rows], type=_ARROW.get(type(f.dataType), pa.string()))
        for i, f in enumerate(fields)
    }
    return spark.createDataFrame(pa.table(columns), schema)
