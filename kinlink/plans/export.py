"""Export of matches and candidates (AGG18, JN16, FLT8, SNK5-SNK6)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.validation import KEYS


def matching_results(first: DataFrame, scored: DataFrame) -> DataFrame:
    """One row a first-source id: its accepted targets, most probable first (ties by id), comma-joined; '' without any."""
    accepted = scored.where("predicted_match = 1").groupBy(*KEYS).agg(F.max("match_probability").alias("_p"))
    lists = accepted.groupBy("source1_entity_id").agg(F.expr("listagg(candidate_entity_id, ',') WITHIN GROUP (ORDER BY _p DESC, candidate_entity_id)").alias("matched_entity_ids"))
    return first.select("source1_entity_id").distinct().join(lists, "source1_entity_id", "left").select("source1_entity_id", F.coalesce("matched_entity_ids", F.lit("")).alias("matched_entity_ids"))


def candidate_export(pairs: DataFrame) -> DataFrame:
    return pairs.select(*KEYS).distinct()
