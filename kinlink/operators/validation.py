"""Quality gates as one-row reports (VAL1-VAL8, JN15, JN18, AGG13-AGG14, AGG19, AGG25).

Every check is a count that must be zero, or a pair of counts that must agree;
ids are compared by anti-joins, never gathered.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import readers
from .labels import match_list

KEYS = ["source1_entity_id", "candidate_entity_id"]


def _row(*parts: DataFrame) -> DataFrame:
    """One-row aggregates side by side."""
    return reduce(lambda a, b: a.crossJoin(F.broadcast(b)), parts)


def _count(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count("*").alias(name))


def repeated(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """AGG13: how many keys stand more than once."""
    return _count(df.groupBy(*keys).agg(F.count("*").alias("_n")).where("_n > 1"), name)


def _by_key(keys: list[str], **tables: DataFrame) -> DataFrame:
    """One row a key: how many rows each table has of it, as a column of the table's name.  Keys with a null are rows of their own kind: they match nothing."""
    names = list(tables)
    rows = [df.select(*keys, *[F.lit(int(x == name)).alias(x) for x in names]) for name, df in tables.items()]
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    tagged = reduce(DataFrame.unionByName, rows).withColumn("_known", F.when(known, F.lit("")).otherwise(F.concat(*[F.when(F.col(x) == 1, x).otherwise("") for x in names])))
    return tagged.groupBy(*keys, "_known").agg(*[F.sum(x).alias(x) for x in names])


def _total(what, name: str):
    return F.coalesce(F.sum(what), F.lit(0)).cast("long").alias(name)


def check_normalized(source: DataFrame, expected_rows: int | None = None) -> DataFrame:
    """VAL1: rows, faulty ids, empty names and addresses."""
    plain = source.agg(
        F.count("*").alias("rows"), F.count_if(F.col("entity_id").isNull()).alias("missing_ids"), F.count_if(F.col("entity_id") == "").alias("empty_ids"),
        F.count_if(F.coalesce("name_normalized", F.lit("")) == "").alias("empty_names"), F.count_if(F.coalesce("address_normalized", F.lit("")) == "").alias("empty_addresses"),
    )
    out = _row(plain, repeated(source, ["entity_id"], "duplicate_ids"))
    good = (F.col("missing_ids") == 0) & (F.col("empty_ids") == 0) & (F.col("duplicate_ids") == 0)
    return out.withColumn("passed", good if expected_rows is None else good & (F.col("rows") == expected_rows))


def check_labeled(labeled: DataFrame) -> DataFrame:
    """VAL2: repeated pairs; ids that stand in two splits."""
    leaks = labeled.groupBy("source1_entity_id").agg(F.min("dataset_split").alias("a"), F.max("dataset_split").alias("b")).where("a <> b")
    out = _row(_count(labeled, "rows"), repeated(labeled, [*KEYS, "candidate_source"], "duplicate_pairs"), _count(leaks, "leaking_entities"))
    return out.withColumn("passed", (F.col("duplicate_pairs") == 0) & (F.col("leaking_entities") == 0))


def check_features(features: DataFrame, expected: DataFrame | None = None) -> DataFrame:
    """VAL3-VAL4: null labels, repeated pairs and, against ``expected``, the number of rows."""
    nulls = F.count_if(F.col("label").isNull()) if "label" in features.columns else F.count_if(F.lit(False))
    parts = [features.agg(F.count("*").alias("rows"), nulls.alias("null_labels"))]
    parts.append(repeated(features, [*KEYS, "candidate_source"], "duplicate_pairs"))
    parts.append(_count(expected if expected is not None else features, "expected_rows"))
    return _row(*parts).withColumn("passed", (F.col("null_labels") == 0) & (F.col("duplicate_pairs") == 0) & (F.col("rows") == F.col("expected_rows")))


def check_before_export(first: DataFrame, targets: DataFrame, pairs: DataFrame, predictions: DataFrame) -> DataFrame:
    """VAL5: unique first ids, known ids, predictions within the candidates."""
    n = F.col
    lacking = lambda x, other: F.when(n(other) == 0, n(x)).otherwise(0)
    by_first = _by_key(KEYS[:1], first=first, pairs=pairs).agg(_total("first", "source1_rows"), F.count_if(n("first") > 0).alias("source1_distinct"), _total(lacking("pairs", "first"), "unknown_source1_ids"))
    by_target = _by_key(KEYS[1:], targets=targets, pairs=pairs).agg(_total(lacking("pairs", "targets"), "unknown_target_ids"))
    by_pair = _by_key(KEYS, pairs=pairs, predictions=predictions).agg(_total(lacking("predictions", "pairs"), "predictions_outside"))
    out = _row(by_first, by_target, by_pair)
    zero = ("unknown_source1_ids", "unknown_target_ids", "predictions_outside")
    return out.withColumn("passed", reduce(lambda a, b: a & b, [F.col(c) == 0 for c in zero]) & (F.col("source1_rows") == F.col("source1_distinct")))


def predicted_links(matching: DataFrame) -> DataFrame:
    return matching.select("source1_entity_id", F.explode(match_list(F.col("matched_entity_ids"))).alias("candidate_entity_id"))


COUNTS = ("source1_rows", "source1_distinct", "matching_rows", "matching_distinct", "candidate_rows", "predicted_links")
MUST_BE_ZERO = (
    "duplicate_candidate_pairs", "missing_source1_rows", "unknown_matching_source1_ids", "unknown_candidate_source1_ids", "unknown_candidate_target_ids",
    "duplicate_predicted_links", "unknown_predicted_target_ids", "predictions_not_in_candidates",
)


def check_export(first: DataFrame, targets: DataFrame, matching: DataFrame, candidates: DataFrame) -> DataFrame:
    """VAL6-VAL8: the exported files against the sources and each other.

    One aggregation a key (first id, target id, pair) counts every table's rows
    of it, and decides all the checks of that key at once.
    """
    links, n = predicted_links(matching), F.col
    lacking = lambda x, *others: F.when(reduce(lambda a, b: a & b, [n(o) == 0 for o in others]), n(x)).otherwise(0)
    by_first = _by_key(KEYS[:1], first=first, matching=matching, candidates=candidates).agg(
        _total("first", "source1_rows"), F.count_if(n("first") > 0).alias("source1_distinct"), _total("matching", "matching_rows"), F.count_if(n("matching") > 0).alias("matching_distinct"),
        _total(lacking("first", "matching"), "missing_source1_rows"), _total(lacking("matching", "first"), "unknown_matching_source1_ids"), _total(lacking("candidates", "first"), "unknown_candidate_source1_ids"),
    )
    by_target = _by_key(KEYS[1:], targets=targets, candidates=candidates, links=links).agg(
        _total(lacking("candidates", "targets"), "unknown_candidate_target_ids"), _total(lacking("links", "targets"), "unknown_predicted_target_ids")
    )
    by_pair = _by_key(KEYS, candidates=candidates, links=links).agg(
        _total("candidates", "candidate_rows"), _total("links", "predicted_links"), F.count_if(n("candidates") > 1).alias("duplicate_candidate_pairs"), F.count_if(n("links") > 1).alias("duplicate_predicted_links"),
        _total(lacking("links", "candidates"), "predictions_not_in_candidates"),
    )
    out = _row(by_first, by_target, by_pair)
    zero = reduce(lambda a, b: a & b, [F.col(c) == 0 for c in MUST_BE_ZERO])
    whole = (F.col("source1_rows") == F.col("matching_rows")) & (F.col("matching_rows") == F.col("matching_distinct"))
    return out.withColumn("status", F.when(zero & whole, "PASS").otherwise("FAIL")).select(*COUNTS, *MUST_BE_ZERO, "status")


def check_files(spark: SparkSession, matching: str, candidates: str, expected_matching: DataFrame, expected_candidates: DataFrame) -> DataFrame:
    """VAL6, VAL8: the exported files themselves: exact headers, as many rows as the stages they come from, and their sizes in bytes."""
    expected = {"matching": (matching, ("source1_entity_id", "matched_entity_ids"), expected_matching), "candidates": (candidates, tuple(KEYS), expected_candidates)}
    parts, gates = [], []
    for name, (path, header, stage) in expected.items():
        right = readers.header(spark, path) == header
        rows = readers.read_tsv(spark, path) if right else spark.createDataFrame([], "x string")
        parts += [_count(rows, f"{name}_file_rows"), _count(stage, f"{name}_stage_rows")]
        parts.append(spark.range(1).select(F.lit(readers.file_bytes(spark, path)).cast("long").alias(f"{name}_bytes"), F.lit(right).alias(f"{name}_header")))
        gates += [F.col(f"{name}_header"), F.col(f"{name}_file_rows") == F.col(f"{name}_stage_rows"), F.col(f"{name}_bytes") > 0]
    return _row(*parts).withColumn("passed", reduce(lambda a, b: a & b, gates))


def require_passed(report: DataFrame, what: str) -> dict:
    """The report's row; ValueError if its gate is shut."""
    row = report.first().asDict()
    if row.get("passed") is False or row.get("status") == "FAIL":
        raise ValueError(f"{what}: {row}")
    return row
