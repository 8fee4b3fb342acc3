"""Candidate pairs by cumulative blocking (AGG1-AGG5, JN1-JN6, PRJ2-PRJ5, WIN1-WIN4, FLT1-FLT6, SET2-SET3).

A block is counted and pruned on the target side before it meets the first
source, so a hot key never multiplies.  Only the keys of blocks that are too
large meet the rows again, salted, so that a hot key's rows are dropped where
they are or in many tasks.  What is left on the first side can be hot, and there
AQE splits the join.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..config import ADDRESS_STOP_WORDS, NAME_STOP_WORDS, PAIR, Blocking
from ..functions.similarity import could_reach, jaro_winkler
from ..functions.text import tokens

COUNTRY = "country_normalized"
#: Rule of exact blocking: the flag it sets, its key, the key's least length, its weight in the score of 2A.
# Lengths and weights.
EXACT_RULES = (("exact_name", "name_normalized", 3, 4), ("exact_core", "name_core", 4, 2), ("exact_address", "address_normalized", 8, 3))
FLAGS = tuple(r[0] for r in EXACT_RULES)


#: Parts over which the rows of a key that is too frequent are spread before they go; such keys hold many rows each, so their list stays short.
SALTS = 16


def without_large(df: DataFrame, keys: list[str], most: int, by: str) -> DataFrame:
    """The rows of ``df`` whose keys stand in at most ``most`` rows; ``by`` tells rows of a key apart."""
    large = df.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") > most).select(*keys, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"))
    return df.withColumn("_salt", F.pmod(F.xxhash64(by), F.lit(SALTS)).cast("int")).join(large, [*keys, "_salt"], "left_anti").drop("_salt")


def block_sizes(targets: DataFrame, key: str, least: int) -> DataFrame:
    """AGG1: rows of each block (country, key) of long enough keys."""
    return targets.where((F.col(key) != "") & (F.length(key) >= least)).groupBy(COUNTRY, key).agg(F.count("*").alias("block_size"))


def top(df: DataFrame, order: Iterable[str], keep: int) -> DataFrame:
    """WIN1-WIN4, SRT1: rank within each first-source id ('-' before a column: descending), ties by target id and source; the best ``keep``."""
    keys = [F.col(c[1:]).desc() if c[0] == "-" else F.col(c).asc() for c in (*order, "candidate_entity_id", "candidate_source")]
    ranked = df.withColumn("candidate_rank", F.row_number().over(Window.partitionBy("source1_entity_id").orderBy(*keys)).cast("long"))
    return ranked.where(F.col("candidate_rank") <= keep)


def _by_id(pairs: DataFrame) -> DataFrame:
    """Partitioned by first-source id: one shuffle serves both the merge of signals and the ranking.  Blocks bound how many pairs an id has."""
    return pairs.repartition("source1_entity_id")


def exact_candidates(first: DataFrame, targets: DataFrame, cfg: Blocking = Blocking()) -> DataFrame:
    """2A: pairs that agree on country and name, core or address, in blocks of at most ``max_block_size`` targets."""
    found = []
    for flag, key, least, _ in EXACT_RULES:
        fit = targets.where((F.col(key) != "") & (F.length(key) >= least)).select(COUNTRY, key, *PAIR[1:])
        small = without_large(fit, [COUNTRY, key], cfg.max_block_size, PAIR[1])
        found.append(first.select("source1_entity_id", COUNTRY, key).join(small, [COUNTRY, key]).select(*PAIR, *[F.lit(int(f == flag)).alias(f) for f in FLAGS]))
    pairs = _by_id(found[0].unionByName(found[1]).unionByName(found[2])).groupBy(*PAIR).agg(*[F.max(f).alias(f) for f in FLAGS])
    score = sum(w * F.col(flag) for flag, _, _, w in EXACT_RULES)
    ranked = top(pairs.withColumn("blocking_score", score), ("-blocking_score", "-exact_name", "-exact_address"), cfg.keep_exact)
    return ranked.select(*PAIR, *FLAGS, "blocking_score", "candidate_rank")


def postings(df: DataFrame, ids: Iterable[str], text: str, stop_words: Iterable[str], drop_numbers: bool) -> DataFrame:
    """FLT2-FLT3: the distinct tokens of each row that may block: three characters or more, no stop word, no number where ``drop_numbers``."""
    fit = lambda t: (F.length(t) >= 3) & ~t.isin(*stop_words) & (~t.rlike("^[0-9]+$") if drop_numbers else F.lit(True))
    return df.select(*ids, COUNTRY, F.explode(F.array_distinct(F.filter(tokens(F.col(text)), fit))).alias("token"))


def shared_tokens(first: DataFrame, targets: DataFrame, text: str, stop_words: Iterable[str], drop_numbers: bool, most: int, least: int, digits: int) -> DataFrame:
    """JN4-JN5, AGG2, AGG5: pairs with ``shared`` rare tokens, and ``weight``, the sum of 1 / ln(2 + frequency).

    A token's frequency counts target rows of a country; ids repeat only in
    faulty input, and then their tokens count once.
    """
    mine = postings(first, ["source1_entity_id"], text, stop_words, drop_numbers).distinct()
    theirs = postings(targets, PAIR[1:], text, stop_words, drop_numbers).distinct()
    rare = without_large(theirs, [COUNTRY, "token"], most, PAIR[1]).withColumn("df", F.count("*").over(Window.partitionBy(COUNTRY, "token")))
    met = mine.join(rare, [COUNTRY, "token"])
    weight = F.sum(1.0 / F.log(2.0 + F.col("df").cast("double")))
    return met.groupBy(*PAIR).agg(F.count("*").alias("shared"), F.round(weight, digits).alias("weight")).where(F.col("shared") >= least)


def _merged(old: DataFrame, new: DataFrame, columns: Iterable[str]) -> DataFrame:
    """AGG4, PRJ2, SET3: both sets of pairs, what a side lacks as 0, each signal's maximum."""
    both = old.unionByName(new, allowMissingColumns=True)
    return _by_id(both).groupBy(*PAIR).agg(*[F.coalesce(F.max(c), F.lit(0).cast(both.schema[c].dataType)).alias(c) for c in columns])


def name_token_candidates(first: DataFrame, targets: DataFrame, exact: DataFrame, cfg: Blocking = Blocking()) -> DataFrame:
    """2B: 2A and pairs that share rare tokens of the name's core."""
    found = shared_tokens(first, targets, "name_core", NAME_STOP_WORDS, True, cfg.max_token_frequency, 1, cfg.score_digits)
    found = found.select(*PAIR, F.col("shared").alias("shared_token_count"), F.col("weight").alias("token_blocking_score"))
    old = exact.select(*PAIR, *FLAGS, F.col("blocking_score").cast("double").alias("exact_blocking_score"))
    pairs = _merged(old, found, (*FLAGS, "shared_token_count", "token_blocking_score", "exact_blocking_score"))
    # The weights of the signals.
    weights = {"exact_name": 100.0, "exact_address": 80.0, "exact_core": 60.0, "shared_token_count": 10.0, "token_blocking_score": 1.0}
    score = sum(F.col(c).cast("double") * w for c, w in weights.items())
    return top(pairs.withColumn("combined_blocking_score", score), ("-combined_blocking_score", "-exact_name", "-exact_address", "-exact_core", "-shared_token_count"), cfg.keep_tokens)


def _prefix(cfg: Blocking) -> Column:
    return F.left(F.replace(F.col("name_core"), F.lit(" "), F.lit("")), F.lit(cfg.prefix))


def prefix_pairs(first: DataFrame, targets: DataFrame, cfg: Blocking = Blocking()) -> DataFrame:
    """JN6, AGG3, FLT4: pairs of one country and core prefix, in blocks of at most ``max_prefix_frequency`` targets, with near lengths."""
    theirs = targets.select(COUNTRY, *PAIR[1:], F.col("name_core").alias("_theirs"), _prefix(cfg).alias("_prefix")).where(F.length("_prefix") == cfg.prefix)
    few = without_large(theirs, [COUNTRY, "_prefix"], cfg.max_prefix_frequency, PAIR[1])
    mine = first.select(COUNTRY, "source1_entity_id", F.col("name_core").alias("_mine"), _prefix(cfg).alias("_prefix"))
    met = mine.join(few, [COUNTRY, "_prefix"])
    return met.where(F.abs(F.length("_mine") - F.length("_theirs")) <= cfg.max_length_gap)


def fuzzy_candidates(first: DataFrame, targets: DataFrame, before: DataFrame, cfg: Blocking = Blocking()) -> DataFrame:
    """2C: 2B and prefix pairs whose cores are similar; length bounds come before the similarity, which is computed once (FLT5)."""
    near = prefix_pairs(first, targets, cfg).where(could_reach(F.col("_mine"), F.col("_theirs"), cfg.min_similarity))
    scored = near.withColumn("name_fuzzy_similarity", F.round(jaro_winkler(F.col("_mine"), F.col("_theirs")), cfg.score_digits)).where(F.col("name_fuzzy_similarity") >= cfg.min_similarity)
    found = scored.select(*PAIR, "name_fuzzy_similarity", (F.col("name_fuzzy_similarity") * 50.0).alias("combined_blocking_score"))
    columns = (*FLAGS, "shared_token_count", "token_blocking_score", "exact_blocking_score", "combined_blocking_score", "name_fuzzy_similarity")
    pairs = _merged(before.drop("candidate_rank"), found, columns)
    return top(pairs, ("-exact_name", "-exact_address", "-exact_core", "-name_fuzzy_similarity", "-combined_blocking_score"), cfg.keep_fuzzy)


def address_candidates(first: DataFrame, targets: DataFrame, before: DataFrame, cfg: Blocking = Blocking()) -> DataFrame:
    """2D: 2C and pairs that share rare address tokens."""
    found = shared_tokens(first, targets, "address_normalized", ADDRESS_STOP_WORDS, False, cfg.max_address_frequency, cfg.min_shared_tokens, cfg.score_digits)
    found = found.select(*PAIR, F.col("shared").alias("shared_address_tokens"), F.col("weight").alias("address_blocking_score"), (F.col("weight") * 20.0).alias("combined_blocking_score"))
    columns = (*FLAGS, "shared_token_count", "token_blocking_score", "exact_blocking_score", "combined_blocking_score", "name_fuzzy_similarity", "shared_address_tokens", "address_blocking_score")
    pairs = _merged(before.drop("candidate_rank"), found, columns)
    order = ("-exact_name", "-exact_address", "-exact_core", "-name_fuzzy_similarity", "-shared_address_tokens", "-address_blocking_score", "-combined_blocking_score")
    return top(pairs, order, cfg.keep_address)


def all_candidates(first: DataFrame, targets: DataFrame, cfg: Blocking = Blocking()) -> DataFrame:
    """2A to 2D as one lazy plan; write it where a frozen candidate set is wanted."""
    out = exact_candidates(first, targets, cfg)
    for stage in (name_token_candidates, fuzzy_candidates, address_candidates):
        out = stage(first, targets, out, cfg)
    return out


def pair_summary(pairs: DataFrame) -> DataFrame:
    """AGG7: pairs, ids covered, and mean and greatest number of pairs of an id."""
    each = pairs.groupBy("source1_entity_id").agg(F.count("*").alias("n"))
    return each.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total_pairs"), F.count("*").alias("covered_entities"), F.avg("n").alias("average_pairs"), F.max("n").alias("max_pairs"))


def pairs_by_source(pairs: DataFrame) -> DataFrame:
    """AGG8."""
    return pairs.groupBy("candidate_source").agg(F.count("*").alias("pairs")).orderBy("candidate_source")


def rule_coverage(pairs: DataFrame) -> DataFrame:
    """AGG9: pairs found by each exact rule."""
    return pairs.agg(*[F.sum(f).cast("long").alias(f) for f in FLAGS])
