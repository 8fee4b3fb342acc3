"""Boosted-tree matcher on Spark ML (ML4-ML9, EV5-EV6, SCL17, AGG26-AGG27, SRT4)."""

from __future__ import annotations

import re
from collections import Counter
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.pipeline import Pipeline
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import FEATURES, PAIR, Training
from ..sources.readers import require_columns


def finite(df: DataFrame) -> DataFrame:
    """ML4, SCL17: the features as doubles of single precision; null, NaN and infinities become 0."""
    require_columns(df, FEATURES, "features")

    def clean(name: str):
        x = F.col(name).cast("float")
        return F.when(x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")), F.lit(0.0)).otherwise(x.cast("double"))

    return df.withColumns({f: clean(f) for f in FEATURES})


def positive_weight(train: DataFrame) -> float:
    return class_weights(train).first()["positive_weight"]


def class_weights(train: DataFrame) -> DataFrame:
    """ML5: pairs of each label, and negatives per positive; 1 without positives."""
    c = train.agg(F.count_if(F.col("label") == 0).alias("negatives"), F.count_if(F.col("label") == 1).alias("positives"))
    return c.withColumn("positive_weight", F.when(F.col("positives") > 0, F.col("negatives") / F.col("positives")).otherwise(1.0))


def train(features: DataFrame, cfg: Training = Training()) -> PipelineModel:
    """ML6: fit on the rows of split 'train'; with ``early_stop``, rows of 'validation' end the rounds when they gain less."""
    rows = finite(features)
    if not cfg.early_stop:
        rows = rows.where("dataset_split = 'train'")
    weight = positive_weight(features.where("dataset_split = 'train'")) if cfg.balance else 1.0
    rows = rows.withColumns({"label": F.col("label").cast("double"), "_weight": F.when(F.col("label") == 1, weight).otherwise(1.0), "_held": F.col("dataset_split") == "validation"})
    trees = GBTClassifier(
        featuresCol="_features", labelCol="label", weightCol="_weight", maxIter=cfg.rounds, maxDepth=cfg.depth, stepSize=cfg.rate, subsamplingRate=cfg.row_share, featureSubsetStrategy=cfg.feature_share,
        minInstancesPerNode=cfg.min_leaf, seed=cfg.seed,
    )
    if cfg.early_stop:
        trees = trees.setValidationIndicatorCol("_held").setValidationTol(cfg.early_stop)
    return Pipeline(stages=[VectorAssembler(inputCols=list(FEATURES), outputCol="_features"), trees]).fit(rows)


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    """ML7: a saved model, if its features are ours in our order."""
    model = PipelineModel.load(path)
    if tuple(model.stages[0].getInputCols()) != FEATURES:
        raise ValueError("the model was trained on other features")
    return model


def score(model: PipelineModel, features: DataFrame, threshold: float | None = None) -> DataFrame:
    """EV5-EV6: ids, label where there is one, ``match_probability`` and, with a threshold, ``predicted_match``.  Thresholds are compared as doubles everywhere."""
    out = model.transform(finite(features)).withColumn("_p", vector_to_array("probability")[1])
    cols = [*PAIR, *[c for c in ("label",) if c in features.columns], F.col("_p").cast("float").alias("match_probability")]
    out = out.select(*cols)
    return out if threshold is None else out.withColumn("predicted_match", (F.col("match_probability").cast("double") >= threshold).cast("byte"))


def pair_metrics(scored: DataFrame, threshold: float = 0.5) -> DataFrame:
    """ML8, AGG27: confusion counts, precision, recall and F0.5; 0 where undefined."""
    hit, true = F.col("match_probability").cast("double") >= threshold, F.col("label") == 1
    c = scored.agg(F.count_if(hit & true).alias("tp"), F.count_if(hit & ~true).alias("fp"), F.count_if(~hit & true).alias("fn"), F.count_if(~hit & ~true).alias("tn"))
    ratio = lambda a, b: F.when(b > 0, a / b).otherwise(0.0)
    c = c.withColumns({"precision": ratio(F.col("tp"), F.col("tp") + F.col("fp")), "recall": ratio(F.col("tp"), F.col("tp") + F.col("fn"))})
    return c.withColumn("f0_5", ratio(1.25 * F.col("precision") * F.col("recall"), 0.25 * F.col("precision") + F.col("recall")))


def score_summary(scored: DataFrame) -> DataFrame:
    """AGG26: rows, accepted rows, and sum, mean and range of the probability."""
    p = F.col("match_probability").cast("double")
    return scored.agg(F.count("*").alias("rows"), F.count_if(F.col("predicted_match") == 1).alias("accepted"), F.sum(p).alias("sum_probability"), F.avg(p).alias("mean_probability"), F.min(p).alias("min_probability"), F.max(p).alias("max_probability"))


def importances(model: PipelineModel) -> list[tuple[str, float, int]]:
    """ML9, SRT4: features with their gain and the number of splits on them, largest gain first."""
    trees = model.stages[-1]
    splits = Counter(int(k) for k in re.findall(r"If \(feature (\d+) ", trees.toDebugString))
    rows = [(name, float(gain), splits[k]) for k, (name, gain) in enumerate(zip(FEATURES, trees.featureImportances.toArray(), strict=True))]
    return sorted(rows, key=lambda x: (-x[1], x[0]))


def linear_score(features: DataFrame) -> DataFrame:
    """A fixed score in 0..1 in place of a model: the mean of the three name and address similarities, lifted by exact matches."""
    parts = [F.col("name_jaro_winkler"), F.col("core_jaro_winkler"), F.col("address_jaro_winkler")]
    base = reduce(lambda a, b: a + b, parts) / 3.0
    lifted = F.least(F.lit(1.0), base + 0.1 * (F.col("exact_name") + F.col("exact_address")).cast("double"))
    return features.select(*PAIR, *[c for c in ("label",) if c in features.columns], F.round(lifted, 6).alias("match_probability"))
