"""The 31 features of a pair; one builder for training and inference (JN11, PRJ6, SCL7-SCL11)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import FEATURES, PAIR
from ..functions.similarity import contains_either, jaro_winkler, levenshtein

CONTROL = ("label", "dataset_split", "entity_has_true_match")
#: Distance given to a pair of which one address is missing.
FAR = 9999


def pair_features(pairs: DataFrame, first: DataFrame, targets: DataFrame, by_bytes: bool = True) -> DataFrame:
    """``PAIR``, the control columns that ``pairs`` has, and ``FEATURES`` in order.  Pairs with unknown ids are left out."""
    texts = ("name_normalized", "name_core", "address_normalized", "country_normalized")
    mine = first.select("source1_entity_id", *[F.col(c).alias(f"a_{c}") for c in texts])
    theirs = targets.select("candidate_entity_id", "candidate_source", *[F.col(c).alias(f"b_{c}") for c in texts])
    rows = pairs.join(mine, "source1_entity_id").join(theirs, ["candidate_entity_id", "candidate_source"])
    flag = lambda c: c.cast("int")
    new = {
        "candidate_is_s2": flag(F.col("candidate_source") == "S2"),
        "country_equal": flag(F.col("a_country_normalized") == F.col("b_country_normalized")),
        "s1_name_missing": flag(F.col("a_name_normalized") == ""),
        "target_name_missing": flag(F.col("b_name_normalized") == ""),
        "s1_address_missing": flag(F.col("a_address_normalized") == ""),
        "target_address_missing": flag(F.col("b_address_normalized") == ""),
    }
    kinds = {"name": "name_normalized", "core": "name_core", "address": "address_normalized"}
    lacking = (F.col("a_address_normalized") == "") | (F.col("b_address_normalized") == "")
    for kind, c in kinds.items():
        a, b = F.col(f"a_{c}"), F.col(f"b_{c}")
        distance = levenshtein(a, b, by_bytes).cast("long")
        new[f"{kind}_jaro_winkler"] = jaro_winkler(a, b)
        new[f"{kind}_levenshtein_distance"] = F.when(lacking, F.lit(FAR).cast("long")).otherwise(distance) if kind == "address" else distance
        new[f"{kind}_length_difference"] = F.abs(F.length(a) - F.length(b)).cast("long")
        if kind != "name":
            new[f"{kind}_contains"] = flag(contains_either(a, b))
    rows = rows.withColumns(new)
    close = {}
    for kind, c in kinds.items():
        longest = F.greatest(F.length(f"a_{c}"), F.length(f"b_{c}"), F.lit(1)).cast("double")
        close[f"{kind}_levenshtein_similarity"] = F.lit(1.0) - F.col(f"{kind}_levenshtein_distance").cast("double") / longest
    close["address_levenshtein_similarity"] = F.when(lacking, F.lit(0.0)).otherwise(close["address_levenshtein_similarity"])
    return rows.withColumns(close).select(*PAIR, *[c for c in CONTROL if c in pairs.columns], *FEATURES)


# The features whose means the summary shows.
SHOWN = ("name_jaro_winkler", "address_jaro_winkler", "name_levenshtein_similarity", "address_levenshtein_similarity", "combined_blocking_score")


def feature_summary(features: DataFrame) -> DataFrame:
    """AGG15, SRT2: means by split and label."""
    return features.groupBy("dataset_split", "label").agg(F.count("*").alias("pairs"), *[F.avg(c).alias(f"avg_{c}") for c in SHOWN]).orderBy("dataset_split", "label")
