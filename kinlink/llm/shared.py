"""Helpers of the training-data operators: shared scratch tables, global ranks, text expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.scratch import materialize, scratch_path  # noqa: F401

#: White space that separates words: space and the controls 09 to 0D.
SPACE = r"[\x20\x09-\x0D]+"


def small_batches(spark: SparkSession) -> None:
    """From here on Arrow batches hold 500 rows and 16 MB at most: whole texts cross to Python, and both sides hold a batch."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= 500:
        spark.conf.set(key, "500")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "16m")


def whole(df: DataFrame) -> Column:
    """The row as one struct, so that no name of a caller's column meets one of an operator's; names may hold dots and backquotes."""
    return F.struct(*[df["`" + c.replace("`", "``") + "`"].alias(c) for c in df.columns])


def free(name: str, taken: list[str]) -> str:
    """``name``, with as many underscores behind it as keep it apart from the columns of the input."""
    low = {c.lower() for c in taken}
    while name.lower() in low:
        name += "_"
    return name


def words(text: Column) -> Column:
    """The words of a text as an array; null and empty texts have none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def n_words(text: Column) -> Column:
    """The number of words, without keeping them."""
    return F.size(words(text)).cast("long")


def ranked(df: DataFrame, order: list[str], rank: str = "row_number") -> tuple[DataFrame, int]:
    """``df`` with its rows numbered 0..n-1 in the given order, and n.

    One range shuffle.  Ties get consecutive numbers, in no stated order; rows
    that tie are still dealt to several ranges, so no value fills a task.  The
    sorted rows are written once, so the numbers never change on a retry.  What
    is broadcast is one row a range.
    """
    tie, at, part, before = (f"_{rank}_{x}" for x in ("tie", "at", "part", "before"))
    held = materialize(
        df.withColumn(tie, F.rand(7)).repartitionByRange(*[F.col(c) for c in order], F.col(tie)).sortWithinPartitions(*order, tie).drop(tie).withColumn(at, F.monotonically_increasing_id()),
        "ranked",
    )
    sizes = sorted((r[0], r[1]) for r in held.groupBy(F.shiftright(at, 33)).count().collect())
    starts, total = [], 0
    for p, n in sizes:
        starts.append((p, total))
        total += n
    offsets = df.sparkSession.createDataFrame(starts, f"{part} long, {before} long")
    numbered = held.withColumn(part, F.shiftright(at, 33)).join(F.broadcast(offsets), part)
    return numbered.withColumn(rank, F.col(before) + F.col(at).bitwiseAND(F.lit((1 << 33) - 1))).drop(part, before, at), total
