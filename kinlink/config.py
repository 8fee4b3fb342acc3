"""Every knob of the linkage pipeline, with its default, and the fixed values results depend on."""

from __future__ import annotations

from dataclasses import dataclass

# Words of company names that say only the legal form.
LEGAL_SUFFIXES = (
    "ag", "co", "company", "corp", "corporation", "gmbh", "inc", "incorporated", "limited", "llc",
    "llp", "lp", "ltd", "pc", "plc", "private", "pvt", "sa", "sarl", "sas",
)

# Short forms of address words.
ADDRESS_WORDS = {
    "apartment": "apt", "avenue": "ave", "building": "bldg", "boulevard": "blvd", "drive": "dr", "floor": "fl", "highway": "hwy",
    "lane": "ln", "mount": "mt", "road": "rd", "saint": "st", "street": "st", "suite": "ste",
}

# Name tokens that never block.
NAME_STOP_WORDS = (
    "a", "an", "and", "co", "company", "corp", "corporation", "for", "in", "inc", "limited", "llc", "llp", "ltd", "of",
    "private", "pvt", "service", "services", "the", "to",
)

# Address tokens that never block.
ADDRESS_STOP_WORDS = (
    "and", "apt", "ave", "bldg", "blvd", "building", "dr", "drive", "fl", "floor", "hwy", "in", "lane", "ln", "main", "near", "of",
    "rd", "road", "st", "ste", "street", "suite", "the", "to", "unit",
)

# Cells that the raw files use for a missing value.
NA_CELLS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# The features in the order models expect.
FEATURES = (
    "candidate_rank", "candidate_is_s2", "exact_name", "exact_core", "exact_address", "shared_token_count", "shared_address_tokens",
    "token_blocking_score", "address_blocking_score", "exact_blocking_score", "combined_blocking_score", "name_fuzzy_similarity",
    "country_equal", "s1_name_missing", "target_name_missing", "s1_address_missing", "target_address_missing",
    "name_jaro_winkler", "core_jaro_winkler", "address_jaro_winkler",
    "name_levenshtein_distance", "core_levenshtein_distance", "address_levenshtein_distance",
    "name_levenshtein_similarity", "core_levenshtein_similarity", "address_levenshtein_similarity",
    "name_length_difference", "core_length_difference", "address_length_difference", "core_contains", "address_contains",
)

PAIR = ("source1_entity_id", "candidate_entity_id", "candidate_source")


@dataclass(frozen=True)
class Blocking:
    max_block_size: int = 200
    max_token_frequency: int = 100
    max_prefix_frequency: int = 300
    max_address_frequency: int = 100
    min_shared_tokens: int = 1
    min_similarity: float = 0.88
    max_length_gap: int = 8
    prefix: int = 4
    keep_exact: int = 250
    keep_tokens: int = 200
    keep_fuzzy: int = 250
    keep_address: int = 300
    # Sums of logarithms differ in their last bits by order of addition; scores are rounded before they rank.
    score_digits: int = 9


@dataclass(frozen=True)
class Sampling:
    negatives_per_matched: int = 10
    negatives_per_singleton: int = 5
    train_tenths: int = 8


@dataclass(frozen=True)
class Sweep:
    start: float = 0.30
    stop: float = 0.95
    step: float = 0.025


@dataclass(frozen=True)
class Training:
    rounds: int = 20
    depth: int = 5
    rate: float = 0.04
    feature_share: str = "0.9"
    row_share: float = 0.9
    min_leaf: int = 100
    seed: int = 42
    balance: bool = True
    early_stop: float = 0.0


#: The rounds and about the leaves of the reference, ended early by the validation split; the defaults above are a small knob.
PRODUCTION = Training(rounds=1200, depth=6, early_stop=1e-6)
