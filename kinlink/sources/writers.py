"""SNK1-SNK8: writers.  Spark's committer leaves no partial output; nothing stale is reused."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_stage(df: DataFrame, path: str, compression: str = "zstd") -> None:
    df.write.mode("overwrite").option("compression", compression).parquet(path)


def write_partitioned(df: DataFrame, path: str, key: str, buckets: int) -> None:
    """SNK4: Parquet in folders by a hash bucket of ``key``; each bucket is one task, so no task writes many small files."""
    bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")
    df.withColumn("bucket", bucket).repartition("bucket").write.mode("overwrite").partitionBy("bucket").option("compression", "zstd").parquet(path)


def write_tsv(df: DataFrame, path: str, one_file: bool = False) -> None:
    """SNK5-SNK6: an export; empty cells are empty, not quoted.  With ``one_file`` the parts are written by all tasks and then joined, byte by byte, into one."""
    df.write.mode("overwrite").option("sep", "\t").option("header", not one_file).option("emptyValue", "").option("escape", '"').csv(path)
    if one_file:
        _join_parts(df.sparkSession, path, "\t".join(df.columns) + "\n")


def _join_parts(spark: SparkSession, path: str, head: str) -> None:
    """The parts of a folder as one file behind a header; no row passes through a task or the driver's Python."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    at = jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(conf)
    parts = sorted(s.getPath().toString() for s in fs.listStatus(at) if s.getPath().getName().startswith("part-"))
    whole = jvm.org.apache.hadoop.fs.Path(f"{path}/_joined")
    out = fs.create(whole, True)
    try:
        out.write(bytearray(head.encode()))
        for part in parts:
            source = fs.open(jvm.org.apache.hadoop.fs.Path(part))
            try:
                jvm.org.apache.hadoop.io.IOUtils.copyBytes(source, out, conf, False)
            finally:
                source.close()
    finally:
        out.close()
    for part in parts:
        fs.delete(jvm.org.apache.hadoop.fs.Path(part), False)
    fs.rename(whole, jvm.org.apache.hadoop.fs.Path(f"{path}/part-00000.csv"))


def write_report(report: DataFrame, path: str) -> dict:
    """SNK7: a one-row report as a JSON file, through Hadoop's file system; returns the row."""
    row = report.first().asDict(recursive=True)
    write_text(report.sparkSession, json.dumps(row, indent=2, default=str), path)
    return row


def write_text(spark: SparkSession, text: str, path: str) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    out = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(at, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
