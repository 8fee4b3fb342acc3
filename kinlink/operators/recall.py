"""How much of the known links a candidate set holds (AGG10-AGG11, JN9-JN10, SET4)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def candidate_recall(links: DataFrame, pairs: DataFrame) -> DataFrame:
    """By source and overall ('ALL') in one pass: true links, recovered links, recall."""
    found = pairs.select("source1_entity_id", "candidate_entity_id").distinct().withColumn("hit", F.lit(1))
    rows = links.join(found, ["source1_entity_id", "candidate_entity_id"], "left")
    out = rows.rollup("candidate_source").agg(F.count("*").alias("true_links"), F.count("hit").alias("recovered_links"), F.grouping("candidate_source").alias("_all"))
    scope = F.when(F.col("_all") == 1, "ALL").otherwise(F.col("candidate_source"))
    return out.select(scope.alias("scope"), "true_links", "recovered_links", F.when(F.col("true_links") > 0, F.col("recovered_links") / F.col("true_links")).alias("recall")).orderBy("scope")


def entity_coverage(links: DataFrame, pairs: DataFrame) -> DataFrame:
    """Ids with a known link, and how many of them have any candidate."""
    have = pairs.select("source1_entity_id").distinct().withColumn("hit", F.lit(1))
    rows = links.select("source1_entity_id").distinct().join(have, "source1_entity_id", "left")
    return rows.agg(F.count("*").alias("truth_entities"), F.count("hit").alias("covered_entities")).withColumn("coverage", F.when(F.col("truth_entities") > 0, F.col("covered_entities") / F.col("truth_entities")))


def recall_by_stage(links: DataFrame, stages: dict[str, DataFrame]) -> DataFrame:
    """SET4: the recall of each named stage; a fall from one to the next means that a later ranking evicted links."""
    parts = [candidate_recall(links, pairs).withColumn("stage", F.lit(name)) for name, pairs in stages.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.select("stage", "scope", "true_links", "recovered_links", "recall")
