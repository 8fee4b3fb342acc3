"""Profiles of raw sources and of known links (AGG20-AGG25, SRT5)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .labels import match_list


def profile_source(raw: DataFrame, name: str) -> DataFrame:
    """One row: counts, distinct and repeated values (null is one value), missing values, mean lengths.

    Each distinct count is an aggregate of its own column's groups, so that no
    row is expanded once a column.
    """
    plain = raw.agg(
        F.count("*").alias("rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"missing_{c}") for c in ("business_name", "business_address", "country")],
        F.avg(F.length(F.coalesce("business_name", F.lit("")))).alias("avg_name_length"),
        F.avg(F.length(F.coalesce("business_address", F.lit("")))).alias("avg_address_length"),
        F.max(F.col("business_name").isNull().cast("int")).alias("_null_name"),
        F.max(F.col("business_address").isNull().cast("int")).alias("_null_address"),
    )
    out = plain
    for c, alias in (("entity_id", "_ids"), ("business_name", "_names"), ("business_address", "_addresses"), ("country", "_countries")):
        out = out.crossJoin(F.broadcast(raw.where(F.col(c).isNotNull()).groupBy(c).agg(F.lit(1)).agg(F.count("*").alias(alias))))  # one row each
    return out.select(
        F.lit(name).alias("source"), "rows", F.col("_ids").alias("unique_entity_ids"), (F.col("rows") - F.col("_ids")).alias("duplicate_entity_ids"),
        "missing_business_name", "missing_business_address", "missing_country",
        (F.col("rows") - F.col("_names") - F.coalesce("_null_name", F.lit(0))).alias("duplicate_business_names"),
        (F.col("rows") - F.col("_addresses") - F.coalesce("_null_address", F.lit(0))).alias("duplicate_addresses"),
        F.col("_countries").alias("countries"), "avg_name_length", "avg_address_length",
    )


def country_distribution(raw: DataFrame) -> DataFrame:
    """Rows a country, null a group of its own; largest first."""
    return raw.groupBy("country").agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), "country")


def top_tokens(df: DataFrame, text: str, n: int = 100) -> DataFrame:
    """The ``n`` most frequent lower-case tokens; ties by token."""
    words = df.select(F.explode(F.split(F.lower(F.coalesce(text, F.lit(""))), r"\s+")).alias("token")).where("token <> ''")
    return words.groupBy("token").agg(F.count("*").alias("frequency")).orderBy(F.desc("frequency"), "token").limit(n)


def match_histogram(truth: DataFrame) -> DataFrame:
    """Ids by their number of known matches."""
    n = F.size(match_list(F.col("matched_entity_ids")))
    return truth.select(n.alias("n")).agg(
        F.count("*").alias("total_entities"), F.count_if(F.col("n") == 0).alias("singletons"), F.count_if(F.col("n") == 1).alias("one_match"), F.count_if(F.col("n") == 2).alias("two_matches"),
        F.count_if(F.col("n") >= 3).alias("three_plus_matches"), F.avg("n").alias("average_matches"), F.max("n").cast("long").alias("maximum_matches"),
    )


def match_sources(truth: DataFrame) -> DataFrame:
    """Known links into each target source, by id prefix."""
    ids = truth.select(F.explode(match_list(F.col("matched_entity_ids"))).alias("id"))
    return ids.agg(F.count_if(F.startswith("id", F.lit("S2-"))).alias("s2_matches"), F.count_if(F.startswith("id", F.lit("S3-"))).alias("s3_matches"))
