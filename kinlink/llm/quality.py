"""Quality rules as weak supervision; DataFrame functions only on the data.

Each rule votes that a text is good, bad, or abstains.  Votes are assumed
independent given the hidden quality; expectation-maximisation over the counts
of vote patterns (3^rules at most, whatever the corpus) estimates how each rule
votes on good and on bad texts, and a text is kept when its posterior
probability of being good is at least ``threshold``.

Null texts have no words.  An empty table learns the starting estimates and has
an empty result.  Repeated rows count as often as they stand.  Texts of any
length are counted whole.  A posterior equal to the threshold keeps the text.
A column kept beside the counts keeps its name; a count of that name has an
underscore behind it.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import SPACE, free, materialize, whole, words

# Fixed values of the contract.
SYMBOLS = r"[^#*$%&|<>]"
#: Frequent short words of the four languages of the corpus.
STOP_WORDS = tuple(
    "the of and to in is that it for on with as be are this by at from or an a "
    "der die das und ist in zu den mit von für auf ein eine nicht im dem sich des "
    "de la le les et des un une en que dans pour est qui sur par du au avec pas "
    "el los las y del se por con una su para es al lo como más o".split()
)


def _counted(df: DataFrame, text: str) -> DataFrame:
    """``df`` with the columns of ``COUNTS``; windows of three words are compared by their 64-bit hashes."""
    t = F.coalesce(F.col(text), F.lit(""))
    out = df.withColumn("_w", words(F.col(text))).withColumn("_n", F.size("_w"))
    w, n = F.col("_w"), F.col("_n")
    # Each window's hash beside its place, sorted, so that equal windows stand side by side.
    windows = F.when(n >= 3, F.sort_array(F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.struct(F.xxhash64(w[i], w[i + 1], w[i + 2]).alias("h"), i.alias("i")))))
    out = out.withColumn("_s", windows).withColumn("_m", F.coalesce(F.size("_s"), F.lit(0)))
    s, m = F.col("_s"), F.col("_m")
    twice = F.filter(
        F.sequence(F.lit(0), m - 1),
        lambda k: F.when(k > 0, s[k]["h"] == s[F.greatest(k - 1, F.lit(0))]["h"]).otherwise(F.lit(False)) | F.when(k < m - 1, s[k]["h"] == s[F.least(k + 1, m - 1)]["h"]).otherwise(F.lit(False)),
    )
    out = out.withColumn("_r", F.when(m > 1, F.sort_array(F.transform(twice, lambda k: s[k]["i"]))))
    covered = F.aggregate(F.col("_r"), F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n")), lambda acc, i: F.struct(i.alias("last"), (acc["n"] + F.least(F.lit(3), i - acc["last"])).alias("n")), lambda acc: acc["n"])
    lines = F.filter(F.split(t, "\n"), lambda x: F.regexp_like(x, F.lit(r"[^\x20\x09-\x0D]")))
    out = out.withColumn("_l", lines)
    letters = F.length(F.regexp_replace(t, r"[^\p{Alpha}]", ""))
    known = F.array(*[F.lit(x) for x in dict.fromkeys(STOP_WORDS)])
    return out.withColumns(
        {
            "n_words": n.cast("long"),
            "word_chars": F.length(F.regexp_replace(t, SPACE, "")).cast("long"),
            "n_symbols": F.length(F.regexp_replace(t, SYMBOLS, "")).cast("long"),
            "n_dup_lines": (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long"),
            "n_repeat_words": F.coalesce(covered, F.lit(0)).cast("long"),
            "n_lines": F.size("_l").cast("long"),
            "n_upper": F.length(F.regexp_replace(t, r"[^\p{Lu}]", "")).cast("long"),
            "n_marks": F.length(F.regexp_replace(t, r"[^!?{}\[\]~^=_\\]", "")).cast("long"),
            "n_stop_words": F.size(F.array_intersect(w, known)).cast("long"),
            "n_plain_ends": F.size(F.filter("_l", lambda x: F.regexp_like(x, F.lit(r"[.!?:;\"”»)]\s*$")))).cast("long"),
        }
    ).drop("_w", "_n", "_s", "_m", "_r", "_l")


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_marks", "n_stop_words", "n_plain_ends")


def base_failed(c: dict[str, Column]) -> Column:
    # Fixed values of the contract.
    return (c["n_words"] < 50) | (100 * c["n_repeat_words"] > 50 * c["n_words"])


def votes(c: dict[str, Column]) -> dict[str, Column]:
    """Each rule's vote: 1 good, -1 bad, 0 abstains (between its two bounds)."""

    def rule(share: Column, good: float, bad: float) -> Column:
        lower = good < bad
        return F.when(share <= good if lower else share >= good, 1).when(share >= bad if lower else share <= bad, -1).otherwise(0)

    n = F.greatest(c["n_words"], F.lit(1)).cast("double")
    chars = F.greatest(c["word_chars"], F.lit(1)).cast("double")
    mean = c["word_chars"] / n
    return {
        "symbols": rule(c["n_symbols"] / n, 0.10, 0.40),
        "upper": rule(c["n_upper"] / chars, 0.15, 0.50),
        "marks": rule(c["n_marks"] / n, 0.15, 0.60),
        "stop_words": rule(c["n_stop_words"].cast("double"), 4, 1),
        "word_length": F.when(mean.between(3, 10), 1).when((mean < 2) | (mean > 15), -1).otherwise(0),
        "dup_lines": rule(c["n_dup_lines"] / F.greatest(c["n_lines"], F.lit(1)), 0.15, 0.50),
        "repeats": rule(c["n_repeat_words"] / n, 0.20, 0.45),
        "line_ends": rule(c["n_plain_ends"] / F.greatest(c["n_lines"], F.lit(1)), 0.50, 0.10),
    }


#: Where expectation-maximisation starts: share of good texts; chances of the votes (good, bad) of a good and of a bad text.
START = (0.85, (0.9, 0.02), (0.5, 0.3))


def estimate(patterns: list[tuple[tuple[int, ...], int]], n_rules: int, rounds: int = 100) -> tuple[float, list]:
    """Share of good texts and, for each rule, its chances of voting (good, abstain, bad) on good and on bad texts.

    Smoothed by a Dirichlet prior at the start's chances, which also keeps the
    two classes from changing places.  ``patterns``: votes and their count.
    """
    (p, good, bad), weight = START, max(1.0, 0.005 * sum(n for _, n in patterns))
    prior = [[c[0], 1 - sum(c), c[1]] for c in (good, bad)]
    tables = [[list(prior[0]), list(prior[1])] for _ in range(n_rules)]
    start = p
    for _ in range(rounds):
        mass, sums = [weight * start, weight * (1 - start)], [[[weight * x for x in prior[k]] for k in (0, 1)] for _ in range(n_rules)]
        for vote, n in patterns:
            q = posterior(vote, p, tables)
            for k, share in ((0, q), (1, 1 - q)):
                mass[k] += n * share
                for j, v in enumerate(vote):
                    sums[j][k][1 - v] += n * share
        p = mass[0] / sum(mass)
        tables = [[[x / sum(row) for x in row] for row in rule] for rule in sums]
    return p, tables


def posterior(vote: tuple[int, ...], p: float, tables: list) -> float:
    odds = math.log(p) - math.log(1 - p) + sum(math.log(t[0][1 - v]) - math.log(t[1][1 - v]) for v, t in zip(vote, tables, strict=True) if v)
    return 1 / (1 + math.exp(-max(-700.0, min(700.0, odds))))


def fit(counted: DataFrame) -> tuple[float, list]:
    """Estimates from all rows that hold ``COUNTS`` and pass the base rules; at most 3^rules counts reach the driver."""
    c = {x: F.col(x) for x in COUNTS}
    v = votes(c)
    rows = counted.where(~base_failed(c)).groupBy(*[x.alias(f"v_{k}") for k, x in v.items()]).count().collect()
    return estimate(sorted((tuple(r[:-1]), r[-1]) for r in rows), len(v))


def quality(model: tuple[float, list], c: dict[str, Column] | None = None) -> Column:
    """The posterior probability of being good; abstentions carry no evidence."""
    p, tables = model
    odds = F.lit(math.log(p) - math.log(1 - p))
    for v, (good, bad) in zip(votes(c or {x: F.col(x) for x in COUNTS}).values(), tables, strict=True):
        odds += F.when(v == 1, math.log(good[0]) - math.log(bad[0])).when(v == -1, math.log(good[2]) - math.log(bad[2])).otherwise(0.0)
    return 1 / (1 + F.exp(-odds))


def score(docs: DataFrame, keep: list[str], text: str = "text", threshold: float = 0.5) -> DataFrame:
    """``keep`` columns, ``COUNTS``, ``base_failed``, ``quality`` and ``kept`` of every row.

    The texts are read once: their counts are written to the shared folder, and
    both the estimates and the verdicts come from there.
    """
    inner = docs.select(whole(docs.select(*keep)).alias("_row"), docs[text].alias("_text"))
    out = _judged(inner, threshold)
    return out.select("_row.*", *[F.col(c).alias(free(c, keep)) for c in (*COUNTS, "base_failed", "quality", "kept")])


def _judged(inner: DataFrame, threshold: float) -> DataFrame:
    counted = materialize(_counted(inner, "_text").drop("_text"), "quality")
    return judged(counted, fit(counted), threshold)


def judged(counted: DataFrame, model: tuple[float, list], threshold: float = 0.5) -> DataFrame:
    out = counted.withColumn("base_failed", base_failed({x: F.col(x) for x in COUNTS})).withColumn("quality", quality(model))
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= threshold))


def keep_good(docs: DataFrame, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that are kept, with their own columns, whatever their names."""
    return _judged(docs.select(whole(docs).alias("_row"), docs[text].alias("_text")), threshold).where("kept").select("_row.*")
