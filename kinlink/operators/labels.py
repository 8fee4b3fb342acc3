"""Known links, labels and training samples (SCL15-SCL16, ML1-ML3, JN7-JN8, WIN5, FLT7, AGG12-AGG14)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..config import Sampling


def match_list(ids: Column) -> Column:
    """The ids of a cell, split at commas, semicolons and bars, trimmed, blanks dropped."""
    return F.filter(F.transform(F.split(F.coalesce(ids, F.lit("")), "[,;|]"), lambda x: F.trim(x)), lambda x: x != "")


def truth_links(truth: DataFrame) -> DataFrame:
    """One distinct row a link; the source is read off the id's prefix."""
    links = truth.select(F.trim("source1_entity_id").alias("source1_entity_id"), F.explode(match_list(F.col("matched_entity_ids"))).alias("candidate_entity_id"))
    prefix = F.regexp_extract("candidate_entity_id", "^(S2|S3)", 1)
    return links.where("source1_entity_id <> ''").withColumn("candidate_source", F.when(prefix == "", "unknown").otherwise(prefix)).distinct()


def tenth(entity_id: Column) -> Column:
    """ML3, SCL12: an id's tenth, 0 to 9, the same on any engine that has MD5."""
    return F.conv(F.substring(F.md5(entity_id), 1, 7), 16, 10).cast("long") % 10


def dataset_split(entity_id: Column, cfg: Sampling = Sampling()) -> Column:
    return F.when(tenth(entity_id) < cfg.train_tenths, "train").otherwise("validation")


def labeled_pairs(pairs: DataFrame, links: DataFrame, cfg: Sampling = Sampling()) -> DataFrame:
    """All matches, and each id's hardest other pairs: ``negatives_per_matched`` or, for ids without a known match, ``negatives_per_singleton``."""
    known = links.select("source1_entity_id", "candidate_entity_id").distinct().withColumn("label", F.lit(1))
    matched = links.select("source1_entity_id").distinct().withColumn("entity_has_true_match", F.lit(1))
    rows = pairs.join(known, ["source1_entity_id", "candidate_entity_id"], "left").join(matched, "source1_entity_id", "left").fillna(0, ["label", "entity_has_true_match"])
    hard = ("exact_name", "exact_address", "exact_core", "name_fuzzy_similarity", "shared_address_tokens", "address_blocking_score", "combined_blocking_score")
    w = Window.partitionBy("source1_entity_id", "label").orderBy(*[F.desc(c) for c in hard], "candidate_rank", "candidate_entity_id", "candidate_source")
    rows = rows.withColumn("negative_rank", F.when(F.col("label") == 0, F.row_number().over(w)).otherwise(0).cast("long"))
    allowed = F.when(F.col("entity_has_true_match") == 1, cfg.negatives_per_matched).otherwise(cfg.negatives_per_singleton)
    kept = rows.where((F.col("label") == 1) | (F.col("negative_rank") <= allowed))
    return kept.withColumn("dataset_split", dataset_split(F.col("source1_entity_id"), cfg))


def sample_summary(labeled: DataFrame) -> DataFrame:
    """AGG12: rows by split and label."""
    return labeled.groupBy("dataset_split", "label").agg(F.count("*").alias("pairs"), F.countDistinct("source1_entity_id").alias("entities")).orderBy("dataset_split", "label")
