"""SQL for DuckDB that states what each linkage query returns."""

from __future__ import annotations

from ..config import ADDRESS_STOP_WORDS, ADDRESS_WORDS, FEATURES, LEGAL_SUFFIXES, NAME_STOP_WORDS
from ..operators.features import SHOWN
from .sweep import thresholds


def _in(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def _clean(x: str) -> str:
    return rf"trim(regexp_replace(replace(replace(lower(coalesce({x}, '')), 'ß', 'ss'), '&', ' and '), '[^\p{{L}}\p{{N}}]+', ' ', 'g'))"


def _core(x: str) -> str:
    kept = f"array_to_string(list_filter(string_split({x}, ' '), lambda v: v NOT IN {_in(LEGAL_SUFFIXES)}), ' ')"
    return f"CASE WHEN {kept} = '' THEN {x} ELSE {kept} END"


def _short(x: str) -> str:
    cases = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in ADDRESS_WORDS.items())
    return f"array_to_string(list_transform(string_split({x}, ' '), lambda v: CASE v {cases} ELSE v END), ' ')"


def _postings(side: str, ids: str, text: str, stop: tuple, numbers: bool) -> str:
    rule = "" if numbers else " AND NOT regexp_full_match(token, '[0-9]+')"
    return f"SELECT DISTINCT {ids}, cn, token FROM (SELECT {ids}, cn, unnest(string_split({text}, ' ')) AS token FROM {side}) WHERE length(token) >= 3 AND token NOT IN {_in(stop)}{rule}"


def _shared(mine: str, theirs: str, most: int) -> str:
    return (
        f"SELECT s1, ci, cs, count(*) AS shared, round(sum(1.0 / ln(2.0 + df)), 9) AS weight FROM {mine} JOIN "
        f"(SELECT *, count(*) OVER (PARTITION BY cn, token) AS df FROM {theirs}) r USING (cn, token) WHERE df <= {most} GROUP BY s1, ci, cs"
    )


_EXACT = " UNION ALL ".join(
    f"SELECT s1, ci, cs, {flags} FROM f JOIN (SELECT *, count(*) OVER (PARTITION BY cn, {key}) AS size FROM t WHERE length({key}) >= {least}) r USING (cn, {key}) WHERE size <= 200"
    for key, least, flags in (("name", 3, "1 AS en, 0 AS ec, 0 AS ea"), ("core", 4, "0, 1, 0"), ("addr", 8, "0, 0, 1"))
)
_PARTS = {
    "w": f"SELECT doc_id, lang, md5(coalesce(text, '')) AS h, string_split({_clean('text')}, ' ') AS a FROM documents",
    "raw": "SELECT 'S' || (doc_id % 3 + 1) || '-' || doc_id AS entity_id, array_to_string(a[1:6], ' ') AS business_name, array_to_string(a[7:18], ' ') AS business_address, lang AS country, 'S' || (doc_id % 3 + 1) AS source FROM w",
    "src": f"SELECT entity_id, source, country AS cn, business_name AS name, {_core('business_name')} AS core, {_short('business_address')} AS addr FROM raw",
    "f": "SELECT entity_id AS s1, cn, name, core, addr FROM src WHERE source = 'S1'",
    "t": "SELECT entity_id AS ci, source AS cs, cn, name, core, addr FROM src WHERE source <> 'S1'",
    "truth": "SELECT 'S1-' || x.doc_id AS s1, coalesce(string_agg('S' || (y.doc_id % 3 + 1) || '-' || y.doc_id, ';'), '') AS ids FROM w x LEFT JOIN w y ON x.lang = y.lang AND x.h = y.h AND y.doc_id % 3 <> 0 WHERE x.doc_id % 3 = 0 GROUP BY x.doc_id",
    "links": "SELECT DISTINCT s1, ci, substr(ci, 1, 2) AS cs FROM (SELECT s1, unnest(string_split(ids, ';')) AS ci FROM truth) WHERE ci <> ''",
    "a1": f"SELECT s1, ci, cs, max(en) AS en, max(ec) AS ec, max(ea) AS ea, 4 * max(en) + 2 * max(ec) + 3 * max(ea) AS score FROM ({_EXACT}) GROUP BY s1, ci, cs",
    "a2": "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY s1 ORDER BY score DESC, en DESC, ea DESC, ci, cs) AS rk FROM a1) WHERE rk <= 250",
    "fn": _postings("f", "s1", "core", NAME_STOP_WORDS, False),
    "tn": _postings("t", "ci, cs", "core", NAME_STOP_WORDS, False),
    "b1": _shared("fn", "tn", 100),
    "b2": "SELECT s1, ci, cs, coalesce(en, 0) AS en, coalesce(ec, 0) AS ec, coalesce(ea, 0) AS ea, coalesce(shared, 0) AS st, coalesce(weight, 0.0) AS ts, coalesce(score, 0)::DOUBLE AS es FROM a2 FULL JOIN b1 USING (s1, ci, cs)",
    "b3": "SELECT *, 100.0::DOUBLE * en + 80.0::DOUBLE * ea + 60.0::DOUBLE * ec + 10.0::DOUBLE * st + ts AS cb FROM b2",
    "b4": "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY s1 ORDER BY cb DESC, en DESC, ea DESC, ec DESC, st DESC, ci, cs) AS rk FROM b3) WHERE rk <= 200",
    "px": "SELECT *, left(replace(core, ' ', ''), 4) AS p FROM t",
    "c1": "SELECT s1, ci, cs, round(jaro_winkler_similarity(x.core, y.core), 9) AS fz FROM f x JOIN (SELECT *, count(*) OVER (PARTITION BY cn, p) AS size FROM px WHERE length(p) = 4) y "
    "ON x.cn = y.cn AND left(replace(x.core, ' ', ''), 4) = y.p AND abs(length(x.core) - length(y.core)) <= 8 WHERE size <= 300",
    "c2": "SELECT s1, ci, cs, coalesce(en, 0) AS en, coalesce(ec, 0) AS ec, coalesce(ea, 0) AS ea, coalesce(st, 0) AS st, coalesce(ts, 0.0) AS ts, coalesce(es, 0.0) AS es, "
    "greatest(coalesce(cb, 0.0), coalesce(fz * 50.0::DOUBLE, 0.0)) AS cb, coalesce(fz, 0.0) AS fz FROM b4 FULL JOIN (SELECT * FROM c1 WHERE fz >= 0.88) z USING (s1, ci, cs)",
    "c3": "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY s1 ORDER BY en DESC, ea DESC, ec DESC, fz DESC, cb DESC, ci, cs) AS rk FROM c2) WHERE rk <= 250",
    "fa": _postings("f", "s1", "addr", ADDRESS_STOP_WORDS, True),
    "ta": _postings("t", "ci, cs", "addr", ADDRESS_STOP_WORDS, True),
    "d1": _shared("fa", "ta", 100),
    "d2": "SELECT s1, ci, cs, coalesce(en, 0) AS en, coalesce(ec, 0) AS ec, coalesce(ea, 0) AS ea, coalesce(st, 0) AS st, coalesce(ts, 0.0) AS ts, coalesce(es, 0.0) AS es, "
    "greatest(coalesce(cb, 0.0), coalesce(weight * 20.0::DOUBLE, 0.0)) AS cb, coalesce(fz, 0.0) AS fz, coalesce(shared, 0) AS sa, coalesce(weight, 0.0) AS ab FROM c3 FULL JOIN d1 USING (s1, ci, cs)",
    "d3": "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY s1 ORDER BY en DESC, ea DESC, ec DESC, fz DESC, sa DESC, ab DESC, cb DESC, ci, cs) AS rk FROM d2) WHERE rk <= 300",
    "l1": "SELECT d3.*, (k.ci IS NOT NULL)::INT AS label, (d3.s1 IN (SELECT s1 FROM links))::INT AS em FROM d3 LEFT JOIN (SELECT s1, ci FROM links) k ON d3.s1 = k.s1 AND d3.ci = k.ci",
    "l2": "SELECT *, CASE WHEN label = 1 THEN 0 ELSE row_number() OVER (PARTITION BY s1, label ORDER BY en DESC, ea DESC, ec DESC, fz DESC, sa DESC, ab DESC, cb DESC, rk, ci, cs) END AS nr, "
    "CASE WHEN ('0x' || substr(md5(s1), 1, 7))::BIGINT % 10 < 8 THEN 'train' ELSE 'validation' END AS split FROM l1",
    "l3": "SELECT * FROM l2 WHERE label = 1 OR nr <= CASE em WHEN 1 THEN 10 ELSE 5 END",
}


def _features(pairs: str) -> str:
    lev = lambda c: f"levenshtein(f.{c}, t.{c})"
    sim = lambda c: f"1.0 - {lev(c)}::DOUBLE / greatest(length(f.{c}), length(t.{c}), 1)"
    has = lambda c: f"(f.{c} <> '' AND t.{c} <> '' AND (contains(f.{c}, t.{c}) OR contains(t.{c}, f.{c})))::INT"
    none = "(f.addr = '' OR t.addr = '')"
    values = {
        "candidate_rank": "rk", "candidate_is_s2": "(p.cs = 'S2')::INT", "exact_name": "en", "exact_core": "ec", "exact_address": "ea", "shared_token_count": "st", "shared_address_tokens": "sa",
        "token_blocking_score": "ts", "address_blocking_score": "ab", "exact_blocking_score": "es", "combined_blocking_score": "cb", "name_fuzzy_similarity": "fz", "country_equal": "(f.cn = t.cn)::INT",
        "s1_name_missing": "(f.name = '')::INT", "target_name_missing": "(t.name = '')::INT", "s1_address_missing": "(f.addr = '')::INT", "target_address_missing": "(t.addr = '')::INT",
        "name_jaro_winkler": "jaro_winkler_similarity(f.name, t.name)", "core_jaro_winkler": "jaro_winkler_similarity(f.core, t.core)",
        "address_jaro_winkler": f"CASE WHEN {none} THEN 0.0 ELSE jaro_winkler_similarity(f.addr, t.addr) END",
        "name_levenshtein_distance": lev("name"), "core_levenshtein_distance": lev("core"), "address_levenshtein_distance": f"CASE WHEN {none} THEN 9999 ELSE {lev('addr')} END",
        "name_levenshtein_similarity": sim("name"), "core_levenshtein_similarity": sim("core"), "address_levenshtein_similarity": f"CASE WHEN {none} THEN 0.0 ELSE {sim('addr')} END",
        "name_length_difference": "abs(length(f.name) - length(t.name))", "core_length_difference": "abs(length(f.core) - length(t.core))", "address_length_difference": "abs(length(f.addr) - length(t.addr))",
        "core_contains": has("core"), "address_contains": has("addr"),
    }
    real = {f for f in FEATURES if "score" in f or "similarity" in f or "winkler" in f}
    cols = ", ".join(f"round(({values[f]})::DOUBLE, 6) AS {f}" if f in real else f"({values[f]})::BIGINT AS {f}" for f in FEATURES)
    control = ", label::BIGINT AS label, split AS dataset_split, em::BIGINT AS entity_has_true_match" if pairs == "l3" else ""
    return f"SELECT p.s1 AS source1_entity_id, p.ci AS candidate_entity_id, p.cs AS candidate_source{control}, {cols} FROM {pairs} p JOIN f ON p.s1 = f.s1 JOIN t ON p.ci = t.ci AND p.cs = t.cs"


_PARTS["ft"] = _features("l3")
_PARTS["sc"] = (
    "SELECT p.s1, p.ci, round(least(1.0, (jaro_winkler_similarity(f.name, t.name) + jaro_winkler_similarity(f.core, t.core) + CASE WHEN f.addr = '' OR t.addr = '' THEN 0.0 ELSE jaro_winkler_similarity(f.addr, t.addr) END) / 3.0::DOUBLE "
    "+ 0.1::DOUBLE * (en + ea)), 6) AS prob FROM d3 p JOIN f ON p.s1 = f.s1 JOIN t ON p.ci = t.ci"
)
_PARTS["ve"] = "SELECT s1 FROM f WHERE ('0x' || substr(md5(s1), 1, 7))::BIGINT % 10 >= 8"
_PARTS["th"] = "SELECT unnest([" + ", ".join(f"{x!r}::DOUBLE" for x in thresholds()) + "]) AS threshold"
_PARTS["pc"] = "SELECT threshold, sc.s1, count(*) AS pred, count(links.ci) AS tp FROM th JOIN sc ON prob >= threshold LEFT JOIN links ON sc.s1 = links.s1 AND sc.ci = links.ci GROUP BY ALL"
_PARTS["tc"] = "SELECT s1, count(*) AS truth FROM links GROUP BY s1"
_PARTS["em"] = (
    "SELECT th.threshold, ve.s1, coalesce(truth, 0) AS truth, coalesce(pred, 0) AS pred, coalesce(tp, 0) AS tp FROM ve CROSS JOIN th LEFT JOIN tc ON ve.s1 = tc.s1 LEFT JOIN pc ON ve.s1 = pc.s1 AND th.threshold = pc.threshold"
)
_PARTS["sw"] = (
    "SELECT threshold, avg(CASE WHEN truth = 0 AND pred = 0 THEN 1.0 WHEN tp = 0 THEN 0.0 ELSE 1.25 * tp / (1.25 * tp + (pred - tp) + 0.25 * (truth - tp)) END) AS macro, sum(tp)::BIGINT AS tp, sum(pred - tp)::BIGINT AS fp, sum(truth - tp)::BIGINT AS fn, "
    "sum(pred)::BIGINT AS pred, sum(truth)::BIGINT AS truth, count(*) FILTER (pred = 0) AS pe, count(*) FILTER (truth = 0) AS ts, count(*) FILTER (truth = 0 AND pred = 0) AS ce FROM em GROUP BY threshold"
)
_SWEEP = (
    "SELECT round(threshold, 6) AS threshold, round(macro, 6) AS macro_entity_f0_5, tp AS true_positives, fp AS false_positives, fn AS false_negatives, pred AS predicted_links, truth AS true_links, pe AS entities_predicted_empty, ts AS true_singletons, "
    "ce AS correctly_empty_entities, round(CASE WHEN tp + fp > 0 THEN tp / (tp + fp)::DOUBLE ELSE 0.0 END, 6) AS micro_precision, round(CASE WHEN tp + fn > 0 THEN tp / (tp + fn)::DOUBLE ELSE 0.0 END, 6) AS micro_recall FROM sw"
)
_PARTS["mr"] = "SELECT f.s1, coalesce(string_agg(sc.ci, ',' ORDER BY prob DESC, sc.ci), '') AS ids FROM f LEFT JOIN sc ON f.s1 = sc.s1 AND prob >= 0.775 GROUP BY f.s1"

_IDS = "s1 AS source1_entity_id, ci AS candidate_entity_id, cs AS candidate_source"
_FLAGS = "en::BIGINT AS exact_name, ec::BIGINT AS exact_core, ea::BIGINT AS exact_address"
_SECOND = f"{_IDS}, {_FLAGS}, st::BIGINT AS shared_token_count, round(ts, 6) AS token_blocking_score, round(es, 6) AS exact_blocking_score, round(cb, 6) AS combined_blocking_score, rk AS candidate_rank"
_THIRD = _SECOND + ", round(fz, 6) AS name_fuzzy_similarity"


def _query(select: str) -> str:
    return "WITH " + ", ".join(f"{name} AS ({body})" for name, body in _PARTS.items()) + " " + select


def _zero(name: str) -> str:
    return f"0::BIGINT AS {name}"


_SELECTS = {
    "normalize_sources": "SELECT 'D-' || doc_id AS entity_id, n AS name_normalized, " + _core("n") + " AS name_core, " + _short("s") + " AS address_normalized, c AS country_normalized, (n = '')::BIGINT AS name_missing, "
    "(s = '')::BIGINT AS address_missing, length(n)::BIGINT AS name_length, length(" + _short("s") + ")::BIGINT AS address_length FROM (SELECT doc_id, " + f"{_clean('text')} AS n, {_clean('source')} AS s, {_clean('lang')} AS c FROM documents)",
    "profile_source": "SELECT 'documents' AS source, count(*) AS rows, count(DISTINCT entity_id) AS unique_entity_ids, count(*) - count(DISTINCT entity_id) AS duplicate_entity_ids, count(*) - count(business_name) AS missing_business_name, "
    "count(*) - count(business_address) AS missing_business_address, count(*) - count(country) AS missing_country, count(*) - count(DISTINCT business_name) - max((business_name IS NULL)::INT) AS duplicate_business_names, "
    "count(*) - count(DISTINCT business_address) - max((business_address IS NULL)::INT) AS duplicate_addresses, count(DISTINCT country) AS countries, round(avg(length(business_name)), 6) AS avg_name_length, "
    "round(avg(length(business_address)), 6) AS avg_address_length FROM raw",
    "country_distribution": "SELECT country, count(*) AS rows FROM raw GROUP BY country",
    "top_tokens": "SELECT token, count(*) AS frequency FROM (SELECT unnest(string_split(business_name, ' ')) AS token FROM raw) WHERE token <> '' GROUP BY token ORDER BY frequency DESC, token LIMIT 100",
    "match_histogram": "SELECT count(*) AS total_entities, count(*) FILTER (n = 0) AS singletons, count(*) FILTER (n = 1) AS one_match, count(*) FILTER (n = 2) AS two_matches, count(*) FILTER (n >= 3) AS three_plus_matches, "
    "round(avg(n), 6) AS average_matches, max(n) AS maximum_matches FROM (SELECT CASE WHEN ids = '' THEN 0 ELSE len(string_split(ids, ';')) END AS n FROM truth)",
    "match_sources": "SELECT count(*) FILTER (cs = 'S2') AS s2_matches, count(*) FILTER (cs = 'S3') AS s3_matches FROM links",
    "ground_truth_links": f"SELECT {_IDS} FROM links",
    "block_sizes_name": "SELECT cn AS country_normalized, name AS name_normalized, count(*) AS block_size FROM t WHERE length(name) >= 3 GROUP BY cn, name",
    "block_sizes_core": "SELECT cn AS country_normalized, core AS name_core, count(*) AS block_size FROM t WHERE length(core) >= 4 GROUP BY cn, core",
    "block_sizes_address": "SELECT cn AS country_normalized, addr AS address_normalized, count(*) AS block_size FROM t WHERE length(addr) >= 8 GROUP BY cn, addr",
    "candidates_exact": f"SELECT {_IDS}, {_FLAGS}, score::BIGINT AS blocking_score, rk AS candidate_rank FROM a2",
    "candidates_token": f"SELECT {_SECOND} FROM b4",
    "candidates_fuzzy": f"SELECT {_THIRD} FROM c3",
    "candidates_address": f"SELECT {_THIRD}, sa::BIGINT AS shared_address_tokens, round(ab, 6) AS address_blocking_score FROM d3",
    "candidate_summary": "SELECT sum(n)::BIGINT AS total_pairs, count(*) AS covered_entities, round(avg(n), 6) AS average_pairs, max(n) AS max_pairs FROM (SELECT count(*) AS n FROM d3 GROUP BY s1)",
    "candidate_by_source": "SELECT cs AS candidate_source, count(*) AS pairs FROM d3 GROUP BY cs",
    "rule_coverage": "SELECT sum(en)::BIGINT AS exact_name, sum(ec)::BIGINT AS exact_core, sum(ea)::BIGINT AS exact_address FROM a2",
    "candidate_recall": "SELECT coalesce(links.cs, 'ALL') AS scope, count(*) AS true_links, count(d.ci) AS recovered_links, round(count(d.ci) / count(*)::DOUBLE, 6) AS recall FROM links LEFT JOIN (SELECT DISTINCT s1, ci FROM d3) d ON links.s1 = d.s1 AND links.ci = d.ci GROUP BY ROLLUP (links.cs)",
    "entity_coverage": "SELECT count(*) AS truth_entities, count(d.s1) AS covered_entities, round(count(d.s1) / count(*)::DOUBLE, 6) AS coverage FROM (SELECT DISTINCT s1 FROM links) k LEFT JOIN (SELECT DISTINCT s1 FROM d3) d ON k.s1 = d.s1",
    "labeled_pairs": f"SELECT {_IDS}, rk AS candidate_rank, label::BIGINT AS label, em::BIGINT AS entity_has_true_match, nr::BIGINT AS negative_rank, split AS dataset_split FROM l3",
    "sample_summary": "SELECT split AS dataset_split, label::BIGINT AS label, count(*) AS pairs, count(DISTINCT s1) AS entities FROM l3 GROUP BY split, label",
    "pair_features": "SELECT * FROM ft",
    "feature_summary": "SELECT split AS dataset_split, label::BIGINT AS label, count(*) AS pairs, "
    + ", ".join(f"round(avg({x}), 6) AS avg_{n}" for n, x in zip(SHOWN, ("jaro_winkler_similarity(f.name, t.name)", "CASE WHEN f.addr = '' OR t.addr = '' THEN 0.0 ELSE jaro_winkler_similarity(f.addr, t.addr) END",
        "1.0 - levenshtein(f.name, t.name)::DOUBLE / greatest(length(f.name), length(t.name), 1)", "CASE WHEN f.addr = '' OR t.addr = '' THEN 0.0 ELSE 1.0 - levenshtein(f.addr, t.addr)::DOUBLE / greatest(length(f.addr), length(t.addr), 1) END", "cb"), strict=True))
    + " FROM l3 p JOIN f ON p.s1 = f.s1 JOIN t ON p.ci = t.ci GROUP BY split, label",
    "threshold_sweep": _SWEEP,
    "best_threshold": _SWEEP + " ORDER BY macro DESC, CASE WHEN tp + fp > 0 THEN tp / (tp + fp)::DOUBLE ELSE 0.0 END DESC, threshold LIMIT 1",
    "matching_results": "SELECT s1 AS source1_entity_id, ids AS matched_entity_ids FROM mr",
    "validate_candidates": f"SELECT count(*) AS source1_rows, count(DISTINCT s1) AS source1_distinct, {_zero('unknown_source1_ids')}, {_zero('unknown_target_ids')}, {_zero('predictions_outside')}, true AS passed FROM f",
    "validate_matching": "SELECT (SELECT count(*) FROM f) AS source1_rows, (SELECT count(DISTINCT s1) FROM f) AS source1_distinct, (SELECT count(*) FROM mr) AS matching_rows, (SELECT count(DISTINCT s1) FROM mr) AS matching_distinct, "
    "(SELECT count(*) FROM d3) AS candidate_rows, (SELECT count(*) FROM sc WHERE prob >= 0.775) AS predicted_links, "
    + ", ".join(_zero(x) for x in ("duplicate_candidate_pairs", "missing_source1_rows", "unknown_matching_source1_ids", "unknown_candidate_source1_ids", "unknown_candidate_target_ids", "duplicate_predicted_links", "unknown_predicted_target_ids", "predictions_not_in_candidates"))
    + ", 'PASS' AS status",
    "validate_normalized": f"SELECT count(*) AS rows, {_zero('missing_ids')}, {_zero('empty_ids')}, count(*) FILTER (business_name = '') AS empty_names, count(*) FILTER (business_address = '') AS empty_addresses, {_zero('duplicate_ids')}, true AS passed FROM raw",
    "validate_features": f"SELECT count(*) AS rows, {_zero('null_labels')}, {_zero('duplicate_pairs')}, count(*) AS expected_rows, true AS passed FROM l3",
    "validate_files": "SELECT (SELECT count(*) FROM mr) AS matching_file_rows, (SELECT count(*) FROM mr) AS matching_stage_rows, true AS matching_header, (SELECT count(*) FROM d3) AS candidates_file_rows, (SELECT count(*) FROM d3) AS candidates_stage_rows, "
    "true AS candidates_header, true AS passed",
    "source_files": "SELECT entity_id, nullif(business_name, '') AS business_name, nullif(business_address, '') AS business_address, country FROM raw",
    "truth_files": f"SELECT {_IDS} FROM links",
    "stage_files": f"SELECT {_IDS}, label::BIGINT AS label FROM l3 WHERE split = 'validation'",
    "class_weights": "SELECT count(*) FILTER (label = 0) AS negatives, count(*) FILTER (label = 1) AS positives, round(CASE WHEN count(*) FILTER (label = 1) > 0 THEN count(*) FILTER (label = 0) / count(*) FILTER (label = 1)::DOUBLE ELSE 1.0 END, 6) AS positive_weight "
    "FROM l3 WHERE split = 'train'",
    "pair_metrics": "SELECT tp, fp, fn, tn, round(p, 6) AS precision, round(r, 6) AS recall, round(CASE WHEN p + r > 0 THEN 1.25 * p * r / (0.25 * p + r) ELSE 0.0 END, 6) AS f0_5 FROM (SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp)::DOUBLE ELSE 0.0 END AS p, "
    "CASE WHEN tp + fn > 0 THEN tp / (tp + fn)::DOUBLE ELSE 0.0 END AS r FROM (SELECT count(*) FILTER (prob >= 0.775 AND label = 1) AS tp, count(*) FILTER (prob >= 0.775 AND label = 0) AS fp, count(*) FILTER (prob < 0.775 AND label = 1) AS fn, "
    "count(*) FILTER (prob < 0.775 AND label = 0) AS tn FROM l3 JOIN sc ON l3.s1 = sc.s1 AND l3.ci = sc.ci WHERE split = 'validation'))",
    "score_summary": "SELECT count(*) AS rows, count(*) FILTER (prob >= 0.775) AS accepted, round(sum(prob), 4) AS sum_probability, round(avg(prob), 4) AS mean_probability, round(min(prob), 4) AS min_probability, round(max(prob), 4) AS max_probability FROM sc",
    "validate_labeled": f"SELECT count(*) AS rows, {_zero('duplicate_pairs')}, {_zero('leaking_entities')}, true AS passed FROM l3",
}


_SELECTS["report_files"] = _SELECTS["validate_matching"]


def oracle_sql() -> dict[str, str]:
    return {name: _query(select) for name, select in _SELECTS.items()}
