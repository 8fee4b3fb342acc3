"""Normalized sources (TXT1-TXT6, SCL1-SCL2) and the two sides of the linkage (PRJ1, SET1)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import name_core, normalize, short_address
from ..sources.readers import NORMALIZED, RAW, require_columns


def normalize_source(raw: DataFrame) -> DataFrame:
    """Raw columns (null to '', ids stripped) and the normalized ones."""
    require_columns(raw, RAW, "raw source")
    text = {c: F.coalesce(F.col(c), F.lit("")) for c in RAW[1:]}
    out = raw.select(F.trim(F.coalesce("entity_id", F.lit(""))).alias("entity_id"), *[x.alias(c) for c, x in text.items()])
    out = out.withColumns({"name_normalized": normalize(F.col("business_name")), "_address": normalize(F.col("business_address")), "country_normalized": normalize(F.col("country"))})
    out = out.withColumns({"name_core": name_core(F.col("name_normalized")), "address_normalized": short_address(F.col("_address"))})
    return out.withColumns(
        {
            "name_missing": (F.col("name_normalized") == "").cast("byte"),
            "address_missing": (F.col("address_normalized") == "").cast("byte"),
            "name_length": F.length("name_normalized").cast("int"),
            "address_length": F.length("address_normalized").cast("int"),
        }
    ).select(*NORMALIZED)


def first_side(source: DataFrame) -> DataFrame:
    return source.select(F.col("entity_id").alias("source1_entity_id"), "country_normalized", "name_normalized", "name_core", "address_normalized")


def target_side(source2: DataFrame, source3: DataFrame) -> DataFrame:
    def tagged(df: DataFrame, tag: str) -> DataFrame:
        return df.select(F.col("entity_id").alias("candidate_entity_id"), F.lit(tag).alias("candidate_source"), "country_normalized", "name_normalized", "name_core", "address_normalized")

    return tagged(source2, "S2").unionByName(tagged(source3, "S3"))
