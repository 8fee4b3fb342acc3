"""Normalized sources from a folder into which raw files drop."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from ..config import NA_CELLS
from ..operators.normalizing import normalize_source
from ..sources.readers import RAW


def normalize_stream(spark: SparkSession, folder: str, out: str, checkpoint: str, files_per_batch: int = 100) -> StreamingQuery:
    """Each new tab-separated file under ``folder``, normalized, appended once to Parquet at ``out``; ends when all present files are done."""
    schema = StructType([StructField(c, StringType()) for c in RAW])
    raw = spark.readStream.schema(schema).option("sep", "\t").option("header", True).option("quote", '"').option("escape", '"').option("maxFilesPerTrigger", files_per_batch).csv(folder)
    raw = raw.select(*[F.when(~F.col(c).isin(*NA_CELLS), F.col(c)).alias(c) for c in RAW])
    return normalize_source(raw).writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
