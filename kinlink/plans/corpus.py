"""The linkage operators over the ``documents`` table: three sources by id, name and address out of the text's words."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import PAIR, Blocking
from ..functions.text import name_core, normalize, short_address
from ..operators import blocking, features, labels, normalizing, profiling, recall, validation
from ..sources import readers, writers
from ..sources.scratch import materialize, scratch_path
from . import export, matcher, sweep

def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """entity_id, business_name (first six words), business_address (the next twelve), country and the source's number."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    words = F.split(normalize(F.col("text")), " ")
    part = F.pmod("doc_id", F.lit(3))
    tag = F.when(part == 0, "S1").when(part == 1, "S2").otherwise("S3")
    rows = docs.select(F.concat(tag, F.lit("-"), F.col("doc_id").cast("string")).alias("entity_id"), words.alias("w"), F.col("lang").alias("country"), tag.alias("source"))
    cut = lambda a, n: F.array_join(F.slice("w", a, n), " ")
    return rows.select("entity_id", cut(1, 6).alias("business_name"), cut(7, 12).alias("business_address"), "country", "source")


class Corpus:
    """The stages of one query over a folder of tables.  What several steps read is written once, as a pipeline's stages are, and read back; the rest stays lazy."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    @cached_property
    def normalized(self) -> DataFrame:
        # The words are normalized already; normalizing again would change nothing.
        out = raw(self.spark, self.sf_dir).select(
            "entity_id", "source", F.col("country").alias("country_normalized"), F.col("business_name").alias("name_normalized"), name_core(F.col("business_name")).alias("name_core"),
            short_address(F.col("business_address")).alias("address_normalized"),
        )
        return materialize(out, "normalized")

    @cached_property
    def first(self) -> DataFrame:
        return normalizing.first_side(self.normalized.where("source = 'S1'"))

    @cached_property
    def targets(self) -> DataFrame:
        return normalizing.target_side(self.normalized.where("source = 'S2'"), self.normalized.where("source = 'S3'"))

    @cached_property
    def links(self) -> DataFrame:
        return labels.truth_links(truth(self.spark, self.sf_dir))

    def blocked(self, stages: int = 4) -> DataFrame:
        out = blocking.exact_candidates(self.first, self.targets, CFG)
        for stage in (blocking.name_token_candidates, blocking.fuzzy_candidates, blocking.address_candidates)[: stages - 1]:
            out = stage(self.first, self.targets, out, CFG)
        return out

    @cached_property
    def candidates(self) -> DataFrame:
        """All four stages, frozen."""
        return materialize(self.blocked(), "candidates")

    @cached_property
    def labeled(self) -> DataFrame:
        return labels.labeled_pairs(self.candidates, self.links)

    @cached_property
    def featured(self) -> DataFrame:
        return materialize(features.pair_features(self.labeled, self.first, self.targets), "features")

    @cached_property
    def scored(self) -> DataFrame:
        """All candidates with the fixed linear score, which needs no training."""
        return matcher.linear_score(features.pair_features(self.candidates, self.first, self.targets))

    @cached_property
    def predictions(self) -> DataFrame:
        out = self.scored.withColumn("predicted_match", (F.col("match_probability") >= THRESHOLD).cast("byte"))
        return materialize(out, "predictions")


def truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stands in for known links: ids of one language whose whole texts are equal, as a truth file has them."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang", F.md5(F.coalesce("text", F.lit(""))).alias("h"))
    first = docs.where("doc_id % 3 = 0").select(F.concat(F.lit("S1-"), F.col("doc_id").cast("string")).alias("source1_entity_id"), "lang", "h")
    other = docs.where("doc_id % 3 <> 0").select(F.concat(F.when(F.col("doc_id") % 3 == 1, "S2-").otherwise("S3-"), F.col("doc_id").cast("string")).alias("id"), "lang", "h")
    met = first.join(other, ["lang", "h"], "left").groupBy("source1_entity_id").agg(F.array_join(F.array_sort(F.collect_list("id")), ";").alias("matched_entity_ids"))
    return met


CFG = Blocking()
THRESHOLD = 0.775


def _rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded and whole numbers as longs, so that engines compare."""
    cols = []
    for name, kind in df.dtypes:
        cols.append(F.round(F.col(name).cast("double"), digits).alias(name) if kind in ("double", "float") else F.col(name).cast("long").alias(name) if kind in ("int", "tinyint") else F.col(name))
    return df.select(*cols)


def normalize_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = docs.select(F.concat(F.lit("D-"), F.col("doc_id").cast("string")).alias("entity_id"), F.col("text").alias("business_name"), F.col("source").alias("business_address"), F.col("lang").alias("country"))
    out = normalizing.normalize_source(rows)
    return _rounded(out.select("entity_id", "name_normalized", "name_core", "address_normalized", "country_normalized", "name_missing", "address_missing", "name_length", "address_length"))


def profile_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(profiling.profile_source(raw(spark, sf_dir), "documents"))


def country_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiling.country_distribution(raw(spark, sf_dir))


def top_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiling.top_tokens(raw(spark, sf_dir), "business_name", 100)


def match_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(profiling.match_histogram(truth(spark, sf_dir)))


def match_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiling.match_sources(truth(spark, sf_dir))


def ground_truth_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Corpus(spark, sf_dir).links


def _blocks(key: str, least: int) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: blocking.block_sizes(Corpus(spark, sf_dir).targets, key, least)


def candidates_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(Corpus(spark, sf_dir).blocked(1))


def candidates_token(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(Corpus(spark, sf_dir).blocked(2))


def candidates_fuzzy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(Corpus(spark, sf_dir).blocked(3))


def candidates_address(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(Corpus(spark, sf_dir).blocked(4))


def candidate_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(blocking.pair_summary(Corpus(spark, sf_dir).blocked()))


def candidate_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blocking.pairs_by_source(Corpus(spark, sf_dir).blocked())


def rule_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blocking.rule_coverage(Corpus(spark, sf_dir).blocked(1))


def candidate_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = Corpus(spark, sf_dir)
    return _rounded(recall.candidate_recall(c.links, c.candidates))


def entity_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = Corpus(spark, sf_dir)
    return _rounded(recall.entity_coverage(c.links, c.candidates))


def labeled_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(Corpus(spark, sf_dir).labeled.select(*PAIR, "candidate_rank", "label", "entity_has_true_match", "negative_rank", "dataset_split"))


def sample_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(labels.sample_summary(Corpus(spark, sf_dir).labeled))


def pair_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(Corpus(spark, sf_dir).featured)


def feature_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(features.feature_summary(Corpus(spark, sf_dir).featured))


def _swept(c: Corpus) -> DataFrame:
    held = lambda df: df.where(labels.tenth(F.col("source1_entity_id")) >= 8)
    pairs = matcher.linear_score(features.pair_features(held(c.candidates), c.first, c.targets))
    return sweep.sweep(sweep.validation_entities(c.first), held(c.links), pairs)


def threshold_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_swept(Corpus(spark, sf_dir)))


def best_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(sweep.best(_swept(Corpus(spark, sf_dir))))


def matching_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = Corpus(spark, sf_dir)
    return export.matching_results(c.first, c.predictions)


def validate_normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = raw(spark, sf_dir)
    out = normalizing.normalize_source(rows.drop("source"))
    return validation.check_normalized(out, rows.count())


def validate_labeled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validation.check_labeled(Corpus(spark, sf_dir).labeled)


def validate_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = Corpus(spark, sf_dir)
    return validation.check_features(matcher.finite(c.featured), c.labeled)


def validate_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = Corpus(spark, sf_dir)
    return validation.check_before_export(c.first, c.targets, c.candidates, c.predictions.where("predicted_match = 1").select(*PAIR))


def validate_matching(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = Corpus(spark, sf_dir)
    return validation.check_export(c.first, c.targets, materialize(export.matching_results(c.first, c.predictions), "matching"), export.candidate_export(c.candidates))


def validate_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both exports written as TSV, read back and held against their stages; sizes in bytes depend on the layout and are left out."""
    c = Corpus(spark, sf_dir)
    matching, pairs = materialize(export.matching_results(c.first, c.predictions), "matching"), export.candidate_export(c.candidates)
    at = [scratch_path(spark, x) for x in ("matching", "pairs")]
    writers.write_tsv(matching, at[0])
    writers.write_tsv(pairs, at[1])
    return validation.check_files(spark, *at, matching, pairs).drop("matching_bytes", "candidates_bytes")


def source_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw sources as TSV files, read back: empty cells come back as null."""
    path = scratch_path(spark, "raw")
    writers.write_tsv(raw(spark, sf_dir).select(*readers.RAW), path)
    readers.require_inputs(spark, [path])
    return readers.read_raw(spark, path, quoted_line_ends=False)


def truth_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known matches as a TSV file, read back and split into links."""
    path = scratch_path(spark, "truth")
    writers.write_tsv(truth(spark, sf_dir), path, one_file=True)
    return labels.truth_links(readers.read_truth(spark, readers.find_file(spark, path, "part-00000.csv")))


def report_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The export's report as a JSON file, read back."""
    path = scratch_path(spark, "report")
    writers.write_report(validate_matching(spark, sf_dir), path)
    return spark.read.option("multiLine", True).json(path)


def stage_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labeled pairs as Parquet in folders by a hash of the id; the validation split of some columns, read back."""
    path = scratch_path(spark, "stage")
    writers.write_partitioned(Corpus(spark, sf_dir).labeled, path, "source1_entity_id", 8)
    return _rounded(readers.read_stage(spark, path, [*PAIR, "label"], "validation"))


def class_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The weight that training gives to matches."""
    return _rounded(matcher.class_weights(Corpus(spark, sf_dir).labeled.where("dataset_split = 'train'")))


def pair_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Confusion counts and scores of the fixed linear score on the validation split."""
    return _rounded(matcher.pair_metrics(matcher.linear_score(Corpus(spark, sf_dir).featured.where("dataset_split = 'validation'")), THRESHOLD))


def score_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(matcher.score_summary(Corpus(spark, sf_dir).predictions), 4)


def gbt_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A model trained on the training split scores the validation split."""
    rows = Corpus(spark, sf_dir).featured
    return matcher.score(matcher.train(rows), rows.where("dataset_split = 'validation'"), 0.5)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = (
        normalize_sources, profile_source, country_distribution, top_tokens, match_histogram, match_sources, ground_truth_links, candidates_exact, candidates_token, candidates_fuzzy, candidates_address,
        candidate_summary, candidate_by_source, rule_coverage, candidate_recall, entity_coverage, labeled_pairs, sample_summary, pair_features, feature_summary, threshold_sweep, best_threshold,
        matching_results, validate_normalized, validate_labeled, validate_features, validate_candidates, validate_matching, validate_files, source_files, truth_files, stage_files, report_files, class_weights, pair_metrics,
        score_summary, gbt_scores,
    )
    out = {f.__name__: f for f in named}
    for flag, key, least, _ in blocking.EXACT_RULES:
        out[f"block_sizes_{flag.removeprefix('exact_')}"] = _blocks(key, least)
    return out
