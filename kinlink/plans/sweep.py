"""Threshold sweep by entity-level F0.5 in one job (EV1-EV4, AGG16-AGG17, JN12-JN14, SRT3)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Sweep
from ..operators.labels import tenth


def thresholds(cfg: Sweep = Sweep()) -> list[float]:
    """EV1: start to stop, both included, by a running sum that is rounded for use."""
    out, at = [], cfg.start
    while at <= cfg.stop + 1e-12:
        out.append(round(at, 6))
        at += cfg.step
    return out


def validation_entities(first: DataFrame, train_tenths: int = 8) -> DataFrame:
    return first.select("source1_entity_id").where(tenth(F.col("source1_entity_id")) >= train_tenths)


def sweep(entities: DataFrame, links: DataFrame, scored: DataFrame, cfg: Sweep = Sweep()) -> DataFrame:
    """EV2-EV3: a row a threshold.

    Each pair is counted once, at the number of thresholds it passes; per id
    and step these counts are summed, so a pair is never multiplied by the
    thresholds.  Only ids times thresholds are, as the macro average needs
    every id at every threshold.  An id without truth and prediction scores 1,
    one without a true prediction 0.
    """
    grid = thresholds(cfg)
    true = links.select("source1_entity_id", "candidate_entity_id").distinct().withColumn("hit", F.lit(1))
    known = true.groupBy("source1_entity_id").agg(F.count("*").alias("true_count"))
    passed = F.lit(0)
    for t in grid:
        passed = passed + (F.col("match_probability").cast("double") >= t).cast("int")
    steps = scored.withColumn("_passed", passed).where("_passed > 0").join(true, ["source1_entity_id", "candidate_entity_id"], "left")
    # One column a threshold keeps an id's counts in one row.
    at = lambda k, what: F.sum(F.when(F.col("_passed") > k, what)).cast("long")
    counts = steps.groupBy("source1_entity_id").agg(F.array(*[F.struct(F.coalesce(at(k, F.lit(1)), F.lit(0)).alias("pred"), F.coalesce(at(k, F.col("hit")), F.lit(0)).alias("tp")) for k in range(len(grid))]).alias("counts"))
    rows = entities.select("source1_entity_id").join(known, "source1_entity_id", "left").join(counts, "source1_entity_id", "left")
    none = F.array_repeat(F.struct(F.lit(0).cast("long").alias("pred"), F.lit(0).cast("long").alias("tp")), len(grid))
    rows = rows.select(F.coalesce("true_count", F.lit(0)).alias("truth"), F.posexplode(F.coalesce("counts", none)).alias("k", "c")).select("truth", "k", "c.pred", "c.tp")
    tp, fp, fn = F.col("tp").cast("double"), (F.col("pred") - F.col("tp")).cast("double"), (F.col("truth") - F.col("tp")).cast("double")
    score = F.when((F.col("truth") == 0) & (F.col("pred") == 0), 1.0).when(F.col("tp") == 0, 0.0).otherwise(1.25 * tp / (1.25 * tp + fp + 0.25 * fn))
    out = rows.groupBy("k").agg(
        F.avg(score).alias("macro_entity_f0_5"), F.sum("tp").alias("true_positives"), F.sum(F.col("pred") - F.col("tp")).alias("false_positives"), F.sum(F.col("truth") - F.col("tp")).alias("false_negatives"),
        F.sum("pred").alias("predicted_links"), F.sum("truth").alias("true_links"), F.count_if(F.col("pred") == 0).alias("entities_predicted_empty"), F.count_if(F.col("truth") == 0).alias("true_singletons"),
        F.count_if((F.col("truth") == 0) & (F.col("pred") == 0)).alias("correctly_empty_entities"),
    )
    share = lambda a, b: F.when(F.col(a) + F.col(b) > 0, F.col(a) / (F.col(a) + F.col(b))).otherwise(0.0)
    threshold = F.element_at(F.array(*[F.lit(t) for t in grid]), F.col("k") + 1)
    return out.select(threshold.alias("threshold"), *[c for c in out.columns if c != "k"], share("true_positives", "false_positives").alias("micro_precision"), share("true_positives", "false_negatives").alias("micro_recall"))


def best(swept: DataFrame) -> DataFrame:
    """EV4, SRT3: the row of the best macro F0.5, then of the best micro precision, then of the lowest threshold."""
    return swept.orderBy(F.desc("macro_entity_f0_5"), F.desc("micro_precision"), "threshold").limit(1)
