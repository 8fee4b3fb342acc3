"""TXT1-TXT6 and SCL7-SCL10 on planted values."""

import random

import duckdb
import pytest
from pyspark.sql import functions as F

from kinlink.functions import similarity, text


def column(spark, values, expr):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in rows.orderBy("i").select(expr(F.col("v")).alias("x")).collect()]


def test_normalize(spark):
    given = [None, "", "  ", "A & B_Co., LLC", "Straße 5", "ＡＢＣ　１", "मुंबई", "a b", "a\u001cb", "AT&T", "\tx\n", "É-é"]
    want = ["", "", "", "a and b co llc", "strasse 5", "abc 1", text.fold("मुंबई"), "a b", "a b", "at and t", "x", "é é"]
    assert column(spark, given, text.normalize) == want
    assert " " in text.fold("मुंबई")  # vowel signs are no letters


def test_native_and_unicode_paths_agree(spark):
    pick = random.Random(3)
    plain = ["".join(chr(pick.randrange(0, 128)) for _ in range(12)) for _ in range(300)]
    assert column(spark, plain, text.normalize) == [text.fold(x) for x in plain]


def test_core_and_address(spark):
    assert column(spark, ["acme co", "llc", "pvt acme ltd gmbh", "", "inc co"], text.name_core) == ["acme", "llc", "acme", "", "inc co"]
    assert column(spark, ["saint mount road", "main street", "", "streets"], text.short_address) == ["st mt rd", "main st", "", "streets"]


PAIRS = [("", ""), ("", "x"), ("abc", "abc"), ("martha", "marhta"), ("dixon", "dicksonx"), ("café", "cafe"), ("a", "b"), ("ab", "ba"), ("prefix same", "prefix some"), ("straße", "strasse")]


def test_similarities_match_duckdb(spark):
    pick = random.Random(5)
    pairs = PAIRS + [tuple("".join(pick.choice("abcé ") for _ in range(pick.randrange(0, 14))) for _ in "xy") for _ in range(400)]
    rows = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a string, b string")
    got = rows.select("i", similarity.jaro_winkler(F.col("a"), F.col("b")), similarity.levenshtein(F.col("a"), F.col("b")), similarity.could_reach(F.col("a"), F.col("b"), 0.88)).orderBy("i").collect()
    db = duckdb.connect()
    for (a, b), (_, jw, lev, may) in zip(pairs, got, strict=True):
        want = db.execute("SELECT jaro_winkler_similarity(?, ?), levenshtein(?, ?)", [a, b, a, b]).fetchone()
        assert jw == pytest.approx(want[0], abs=1e-12), (a, b)
        assert lev == want[1], (a, b)
        assert may or want[0] < 0.88, (a, b)


def test_similarity_of_many_pairs_is_that_of_each():
    pick = random.Random(8)
    word = lambda most: "".join(pick.choice("abcé ") for _ in range(pick.randrange(1, most))).encode()
    a, b = [word(m) for m in [14] * 1500 + [90] * 300 + [700] * 20 + [2]], [word(m) for m in [14] * 1500 + [60] * 300 + [900] * 20 + [400]]
    assert list(similarity.jaro_winkler_pairs(a, b)) == [similarity.jaro_winkler_bytes(x, y) if x != y else 1.0 for x, y in zip(a, b, strict=True)]


def test_fold_keeps_letters_and_digits_of_every_script():
    import unicodedata

    for start in range(0, 0x11000, 64):
        value = "a" + "".join(chr(c) for c in range(start, start + 64) if not 0xD800 <= c < 0xE000) + "z"
        folded = unicodedata.normalize("NFKC", value.strip()).casefold().replace("&", " and ")
        assert text.fold(value) == " ".join("".join(c if c.isalnum() else " " for c in folded).split())


def test_contains_either(spark):
    rows = spark.createDataFrame([("ab", "xabx"), ("xabx", "ab"), ("", "a"), ("a", "b")], "a string, b string")
    assert [r[0] for r in rows.select(similarity.contains_either(F.col("a"), F.col("b"))).collect()] == [True, True, False, False]
