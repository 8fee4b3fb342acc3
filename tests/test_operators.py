"""Blocking, labels, features, sweep, export and validators on planted frames."""

import pytest
from pyspark.sql import functions as F

from kinlink.config import FEATURES, Blocking, Sampling, Sweep
from kinlink.operators import blocking, features, labels, normalizing, profiling, recall, validation
from kinlink.plans import export, matcher, sweep

SIDE = "source1_entity_id string, country_normalized string, name_normalized string, name_core string, address_normalized string"
TARGET = "candidate_entity_id string, candidate_source string, country_normalized string, name_normalized string, name_core string, address_normalized string"


def first(spark, rows):
    return spark.createDataFrame(rows, SIDE)


def targets(spark, rows):
    return spark.createDataFrame(rows, TARGET)


def ids(df):
    return sorted((r.source1_entity_id, r.candidate_entity_id) for r in df.collect())


def test_exact_blocks_by_size_length_and_country(spark):
    s = first(spark, [("S1-1", "us", "acme", "acme", ""), ("S1-2", "", "nil", "nil", "1 long road"), ("S1-3", "us", "ab", "ab", "short")])
    t = targets(spark, [("S2-1", "S2", "us", "acme", "acme", ""), ("S3-1", "S3", "us", "acme", "acme", ""), ("S2-2", "S2", "fr", "acme", "acme", ""), ("S2-3", "S2", "", "nil", "nil", "1 long road"), ("S2-4", "S2", "us", "ab", "ab", "short")])
    assert ids(blocking.exact_candidates(s, t)) == [("S1-1", "S2-1"), ("S1-1", "S3-1"), ("S1-2", "S2-3")]
    assert ids(blocking.exact_candidates(s, t, Blocking(max_block_size=1))) == [("S1-2", "S2-3")]
    row = {(r.source1_entity_id, r.candidate_entity_id): r for r in blocking.exact_candidates(s, t).collect()}
    assert (row["S1-1", "S2-1"].blocking_score, row["S1-2", "S2-3"].blocking_score) == (6, 7)
    assert [row["S1-1", x].candidate_rank for x in ("S2-1", "S3-1")] == [1, 2]
    assert ids(blocking.exact_candidates(s, t, Blocking(keep_exact=1))) == [("S1-1", "S2-1"), ("S1-2", "S2-3")]


def test_tokens_are_distinct_rare_and_no_numbers_in_names(spark):
    s = first(spark, [("S1-1", "us", "", "rare rare 12345 the", "12345 oak")])
    t = targets(spark, [("S2-1", "S2", "us", "", "rare  other 12345", "12345 elm"), ("S2-2", "S2", "us", "", "the", "oak road")])
    found = blocking.shared_tokens(s, t, "name_core", ("the",), True, 100, 1, 9).collect()
    assert [(r.candidate_entity_id, r.shared) for r in found] == [("S2-1", 1)]
    by_address = blocking.shared_tokens(s, t, "address_normalized", ("road",), False, 100, 1, 9)
    assert sorted(r.candidate_entity_id for r in by_address.collect()) == ["S2-1", "S2-2"]
    assert blocking.shared_tokens(s, t, "name_core", (), False, 0, 1, 9).count() == 0
    assert blocking.shared_tokens(s, t, "address_normalized", (), False, 100, 2, 9).count() == 0


def test_fuzzy_prefix_and_length_gap(spark):
    s = first(spark, [("S1-1", "us", "", "jonathan works", ""), ("S1-2", "us", "", "abc", "")])
    t = targets(spark, [("S2-1", "S2", "us", "", "jonathan work", ""), ("S2-2", "S2", "us", "", "jonathan works and more", ""), ("S2-3", "S2", "us", "", "abc", ""), ("S2-4", "S2", "us", "", "jona", "")])
    assert ids(blocking.prefix_pairs(s, t)) == [("S1-1", "S2-1")]
    before = blocking.name_token_candidates(s, t, blocking.exact_candidates(s, t), Blocking(max_token_frequency=0))
    out = blocking.fuzzy_candidates(s, t, before, Blocking())
    assert ids(out) == [("S1-1", "S2-1")]
    assert blocking.fuzzy_candidates(s, t, before, Blocking(max_prefix_frequency=2)).count() == 0


def test_later_stages_add_and_rank(spark):
    s = first(spark, [("S1-1", "us", "acme north", "acme north", "77 elm")])
    t = targets(spark, [("S2-1", "S2", "us", "acme north", "acme north", "77 elm"), ("S2-2", "S2", "us", "north star", "north star", ""), ("S3-3", "S3", "us", "zzz", "zzz", "elm court")])
    out = {r.candidate_entity_id: r for r in blocking.all_candidates(s, t).collect()}
    assert set(out) == {"S2-1", "S2-2", "S3-3"}
    assert out["S2-1"].candidate_rank == 1 and out["S2-1"].name_fuzzy_similarity == 1.0 and out["S3-3"].shared_address_tokens == 1
    assert blocking.pair_summary(blocking.all_candidates(s, t)).first().total_pairs == 3


def test_truth_labels_and_sampling(spark):
    truth = spark.createDataFrame([("S1-1", "S2-1, S3-9|X7;;"), ("S1-1", "S2-1"), ("S1-2", None), ("S1-3", "")], "source1_entity_id string, matched_entity_ids string")
    links = labels.truth_links(truth)
    assert sorted((r[1], r[2]) for r in links.collect()) == [("S2-1", "S2"), ("S3-9", "S3"), ("X7", "unknown")]
    zero = {c: 0 for c in ("exact_name", "exact_core", "exact_address", "shared_address_tokens")}
    rows = [("S1-1", "S2-1", "S2", 1)] + [(s, f"S2-{i}", "S2", i) for s in ("S1-1", "S1-2") for i in range(10, 24)]
    pairs = spark.createDataFrame(rows, "source1_entity_id string, candidate_entity_id string, candidate_source string, candidate_rank long")
    pairs = pairs.withColumns({**{c: F.lit(v) for c, v in zero.items()}, **{c: F.lit(0.0) for c in ("name_fuzzy_similarity", "address_blocking_score", "combined_blocking_score")}})
    out = labels.labeled_pairs(pairs, links)
    counts = {(r[0], r[1]): r[2] for r in out.groupBy("source1_entity_id", "label").count().collect()}
    assert counts == {("S1-1", 1): 1, ("S1-1", 0): 10, ("S1-2", 0): 5}
    assert out.where("label = 0").agg(F.max("candidate_rank")).first()[0] == 19
    assert labels.labeled_pairs(pairs, links, Sampling(1, 2)).count() == 4
    assert validation.require_passed(validation.check_labeled(out), "labels")["leaking_entities"] == 0


def test_features_of_missing_addresses(spark):
    s = first(spark, [("S1-1", "us", "acme", "acme", ""), ("S1-2", "us", "", "", "x road")])
    t = targets(spark, [("S2-1", "S2", "us", "acme inc", "acme", "9 road"), ("S2-2", "S2", "us", "", "", "x road 9")])
    cand = blocking.all_candidates(s, t).limit(0)
    rows = spark.createDataFrame([("S1-1", "S2-1", "S2"), ("S1-2", "S2-2", "S2"), ("S1-9", "S2-2", "S2")], "source1_entity_id string, candidate_entity_id string, candidate_source string")
    pairs = rows.join(cand.drop("source1_entity_id", "candidate_source"), "candidate_entity_id", "left").fillna(0).select(cand.columns)
    out = {r.source1_entity_id: r for r in features.pair_features(pairs, s, t).collect()}
    assert set(out) == {"S1-1", "S1-2"}
    a, b = out["S1-1"], out["S1-2"]
    assert (a.address_levenshtein_distance, a.address_levenshtein_similarity, a.address_jaro_winkler, a.s1_address_missing, a.core_contains) == (9999, 0.0, 0.0, 1, 1)
    assert (b.name_levenshtein_distance, b.name_levenshtein_similarity, b.name_jaro_winkler, b.address_contains, b.core_contains) == (0, 1.0, 0.0, 1, 0)


def test_sweep_scores_every_entity(spark):
    entities = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "source1_entity_id string")
    links = spark.createDataFrame([("a", "x"), ("a", "y"), ("c", "z")], "source1_entity_id string, candidate_entity_id string")
    scored = spark.createDataFrame([("a", "x", 0.5), ("a", "w", 0.9), ("d", "v", 0.5)], "source1_entity_id string, candidate_entity_id string, match_probability double")
    rows = {r.threshold: r for r in sweep.sweep(entities, links, scored, Sweep(0.5, 0.9, 0.2)).collect()}
    assert sorted(rows) == [0.5, 0.7, 0.9]
    # a: one hit, one false, one missed; b: rightly empty; c: missed; d: wrongly filled.
    assert rows[0.5].macro_entity_f0_5 == pytest.approx((1.25 / 2.5 + 1 + 0 + 0) / 4)
    assert rows[0.9].macro_entity_f0_5 == pytest.approx((0 + 1 + 0 + 1) / 4)
    assert (rows[0.5].true_positives, rows[0.5].false_positives, rows[0.5].false_negatives, rows[0.5].correctly_empty_entities) == (1, 2, 2, 1)
    assert len(sweep.thresholds()) == 27 and sweep.thresholds()[-1] == 0.95


def test_export_orders_and_keeps_empty_rows(spark):
    f = first(spark, [("S1-1", "", "", "", ""), ("S1-2", "", "", "", "")])
    scored = spark.createDataFrame([("S1-1", "S3-2", "S3", 0.9, 1), ("S1-1", "S2-1", "S2", 0.9, 1), ("S1-1", "S2-3", "S2", 0.95, 1), ("S1-1", "S2-4", "S2", 0.1, 0)], "source1_entity_id string, candidate_entity_id string, candidate_source string, match_probability double, predicted_match int")
    rows = dict(tuple(r) for r in export.matching_results(f, scored).collect())
    assert rows == {"S1-1": "S2-3,S2-1,S3-2", "S1-2": ""}


def test_export_validator_finds_each_violation(spark):
    f = first(spark, [("S1-1", "", "", "", ""), ("S1-2", "", "", "", "")])
    t = targets(spark, [("S2-1", "S2", "", "", "", ""), ("S2-2", "S2", "", "", "", "")])
    frame = lambda rows: spark.createDataFrame(rows, "source1_entity_id string, matched_entity_ids string")
    cand = lambda rows: spark.createDataFrame(rows, "source1_entity_id string, candidate_entity_id string")
    good = validation.check_export(f, t, frame([("S1-1", "S2-1"), ("S1-2", "")]), cand([("S1-1", "S2-1")])).first()
    assert good.status == "PASS" and all(good[c] == 0 for c in validation.MUST_BE_ZERO)
    bad = validation.check_export(f, t, frame([("S1-1", "S2-1,S2-1,S2-9"), ("S1-7", "")]), cand([("S1-1", "S2-1"), ("S1-1", "S2-1"), ("S1-8", "S2-8")])).first()
    assert bad.status == "FAIL" and all(bad[c] > 0 for c in validation.MUST_BE_ZERO), bad
    with pytest.raises(ValueError):
        validation.require_passed(validation.check_export(f, t, frame([]), cand([])), "export")


def test_profiles(spark):
    raw = spark.createDataFrame([("a", "x", None, "US"), ("b", "x", None, None), ("b", None, "q", "US")], "entity_id string, business_name string, business_address string, country string")
    p = profiling.profile_source(raw, "s").first()
    assert (p.rows, p.unique_entity_ids, p.duplicate_entity_ids, p.missing_business_address, p.duplicate_business_names, p.duplicate_addresses, p.countries) == (3, 2, 1, 2, 1, 1, 1)
    assert profiling.profile_source(raw.limit(0), "s").first().rows == 0
    assert [tuple(r) for r in profiling.country_distribution(raw).collect()] == [("US", 2), (None, 1)]
    truth = spark.createDataFrame([("a", "S2-1,S3-1,S3-2"), ("b", None), ("c", "S2-5")], "source1_entity_id string, matched_entity_ids string")
    assert tuple(profiling.match_sources(truth).first()) == (2, 2)
    h = profiling.match_histogram(truth).first()
    assert (h.singletons, h.one_match, h.three_plus_matches, h.maximum_matches) == (1, 1, 1, 3)


def test_recall_rolls_up(spark):
    links = spark.createDataFrame([("a", "x", "S2"), ("a", "y", "S3"), ("b", "z", "S3")], "source1_entity_id string, candidate_entity_id string, candidate_source string")
    pairs = spark.createDataFrame([("a", "x"), ("a", "y"), ("a", "q")], "source1_entity_id string, candidate_entity_id string")
    assert [tuple(r) for r in recall.candidate_recall(links, pairs).collect()] == [("ALL", 3, 2, 2 / 3), ("S2", 1, 1, 1.0), ("S3", 2, 1, 0.5)]
    assert tuple(recall.entity_coverage(links, pairs).first()) == (2, 1, 0.5)


def test_model_trains_scores_and_reloads(spark, tmp_path):
    from kinlink.config import Training

    rows = spark.range(400).select(F.concat(F.lit("S1-"), "id").alias("source1_entity_id"), F.concat(F.lit("S2-"), "id").alias("candidate_entity_id"), F.lit("S2").alias("candidate_source"), (F.col("id") % 4 == 0).cast("int").alias("label"), F.when(F.col("id") % 5 == 0, "validation").otherwise("train").alias("dataset_split"))
    rows = rows.withColumns({f: F.lit(0.0) for f in FEATURES}).withColumn("name_jaro_winkler", F.when(F.col("label") == 1, 0.9).otherwise(0.2) + F.lit(0.01)).withColumn("core_jaro_winkler", F.lit(float("nan")))
    model = matcher.train(rows, Training(rounds=3, depth=2, min_leaf=5))
    matcher.save(model, str(tmp_path / "m"))
    scored = matcher.score(matcher.load(str(tmp_path / "m")), rows.where("dataset_split = 'validation'"), 0.5)
    m = matcher.pair_metrics(scored).first()
    assert (m.fp, m.fn, m.precision, m.recall, m.f0_5) == (0, 0, 1.0, 1.0, 1.0)
    best = matcher.importances(model)[0]
    assert best[0] == "name_jaro_winkler" and best[1] > 0.9 and 1 <= best[2] <= 3
    summary = matcher.score_summary(scored).first()
    assert summary.rows == 80 and summary.sum_probability == pytest.approx(80 * summary.mean_probability)


def test_normalized_source_passes_its_gate(spark):
    raw = spark.createDataFrame([(" S2-1 ", "A & B Ltd", None, "India"), (None, None, "1 Main Street", None)], "entity_id string, business_name string, business_address string, country string")
    out = normalizing.normalize_source(raw)
    rows = {r.entity_id: r for r in out.collect()}
    assert rows["S2-1"].name_core == "a and b" and rows["S2-1"].address_missing == 1 and rows[""].address_normalized == "1 main st" and rows[""].name_length == 0
    with pytest.raises(ValueError):
        validation.require_passed(validation.check_normalized(out), "source")


def test_production_training_has_the_rounds_of_the_reference():
    from kinlink.config import PRODUCTION, Training

    assert (PRODUCTION.rounds, PRODUCTION.rate, PRODUCTION.min_leaf) == (1200, 0.04, 100) and PRODUCTION.early_stop > 0
    assert Training().rounds == 20
