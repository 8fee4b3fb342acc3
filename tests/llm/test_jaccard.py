"""The exact join against all pairs; hashes of shingles; components."""

import random
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from kinlink.llm import graph, jaccard, shingles

DOC = "doc_id long, text string"
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute_set(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute(rows):
    sets, post, up = {}, defaultdict(list), {}

    def root(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for k, (i, text) in enumerate(rows):
        s = sets[k] = brute_set(text)
        up.setdefault(i, i)
        seen = defaultdict(int)
        for t in s:
            for j in post[t]:
                seen[j] += 1
            post[t].append(k)
        for j, n in seen.items():
            if 100 * n >= 80 * (len(s) + len(sets[j]) - n):
                a, b = sorted((root(i), root(rows[j][0])))
                up[b] = a
    return sorted((i, len(sets[k]), root(i)) for k, (i, _) in enumerate(rows))


def documents(seed, families=12):
    pick = random.Random(seed)
    word = lambda: "".join(pick.choice("abcdefgh") for _ in range(3))
    shared = [word() for _ in range(60)]
    out = []
    for _ in range(families):
        base = [word() for _ in range(pick.choice([6, 12, 40, 120, 300]))]
        for _ in range(pick.choice([1, 2, 6, 25])):
            copy = list(base)
            for _ in range(pick.randrange(0, max(1, len(base) // 12) + 1)):
                at = pick.randrange(len(copy))
                copy[at : at + pick.randrange(2)] = [word()] * pick.randrange(2)
            out.append(" ".join(copy[: pick.choice([None, None, len(copy) * 9 // 10])]))
    out += [" ".join([word() for _ in range(30)] + shared + [word() for _ in range(30)]) for _ in range(25)]
    out += ["one", "one", "One  two", "a b c d", "a b c d e", "x " * 50, "x " * 6, "", "  \n", None, out[0].upper(), "\t".join(out[0].split())]
    pick.shuffle(out)
    return list(enumerate(out))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_components_match_all_pairs(spark, seed):
    rows = documents(seed)
    got = jaccard.link_classes(spark.createDataFrame(rows, DOC)).collect()
    assert sorted(map(tuple, got)) == brute(rows)


def test_star_families_without_a_centre(spark):
    pick = random.Random(9)
    base = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(150):  # two thirds lie within reach of the first, many only of each other
        copy = list(base)
        for _ in range(pick.choice([0, 2, 4, 6, 8])):
            copy[pick.randrange(len(copy))] = f"e{pick.randrange(40)}"
        rows.append((i, " ".join(copy)))
    got = jaccard.link_classes(spark.createDataFrame(rows, DOC)).collect()
    assert sorted(map(tuple, got)) == brute(rows)


def test_edges_of_the_contract(spark):
    a = [f"a{i}" for i in range(104)]
    rows = [(5, " ".join(a)), (9, " ".join([*a[:-1], "z"])), (None, " ".join(a)), (None, None), (7, None), (7, "only once"), (7, "only once")]
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], DOC + ", component_id int")
    got = sorted(map(tuple, jaccard.link_classes(df).collect()), key=str)
    assert got == sorted([(5, 100, 5), (9, 100, 5), (None, 100, None), (None, 0, None), (7, 0, 7), (7, 1, 7), (7, 1, 7)], key=str)
    kept = jaccard.keep_one(df)
    assert kept.columns == df.columns and sorted(((str(r.doc_id), r.text) for r in kept.collect()), key=str) == sorted([("5", " ".join(a)), ("None", None), ("7", None), ("7", "only once")], key=str)
    assert jaccard.link_classes(df.limit(0)).count() == jaccard.keep_one(df.limit(0)).count() == 0


def test_rows_that_repeat_an_id_are_reached_together(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(104)) for x in "abc")
    rows = [(3, a), (8, a), (8, b), (8, None), (9, b + " z"), (9, b + " z"), (20, c), (20, c)]
    got = sorted(map(tuple, jaccard.link_classes(spark.createDataFrame(rows, DOC)).collect()))
    assert got == brute(rows) and {r[2] for r in got} == {3, 20}
    kept = jaccard.keep_one(spark.createDataFrame(rows, DOC).withColumn("_gone", F.lit(1)).withColumn("_id", F.lit(2)).withColumn("n", F.lit(3)))
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted([(3, a), (8, b), (8, None), (20, c)], key=str)


def test_clashing_names_stay(spark):
    docs = spark.createDataFrame([(1, "a b c d e f"), (2, "a b c d e f")], DOC).withColumn("_gone", F.lit(1)).withColumn("_row", F.lit(2)).withColumn("component_id", F.lit(3)).withColumn("node", F.lit(4))
    kept = jaccard.keep_one(docs)
    assert kept.columns == docs.columns and [r.doc_id for r in kept.collect()] == [1]


def drifting(seed, families, words, size=7):
    """Families of revisions, each one step from an earlier one of its family, their ids in any order."""
    pick, out = random.Random(seed), []
    for f in range(families):
        family, ids = [[f"f{f}w{i}" for i in range(words)]], [len(out) + i for i in range(size)]
        while len(family) < size:
            copy = list(pick.choice(family[-2:]))
            for _ in range(max(1, words // 60)):
                copy[pick.randrange(words)] = f"f{f}e{pick.randrange(10**6)}"
            family.append(copy)
        pick.shuffle(ids)
        out += [(i, " ".join(w)) for i, w in zip(ids, family, strict=True)]
    return out


def test_drifting_families_match_all_pairs(spark):
    """Up-chains deeper than three steps, with edges that fail at any step: links under one label that hang on different parts."""
    rows = drifting(5, 1500, 60) + [(i + 10**6, t) for i, t in drifting(6, 250, 60, 25)] + [(i + 2 * 10**6, t) for i, t in drifting(7, 120, 400)]
    got = jaccard.link_classes(spark.createDataFrame(rows, DOC)).collect()
    assert sorted(map(tuple, got)) == brute(rows)


def test_hot_keys_are_joined_by_broadcast_alike(spark, monkeypatch):
    rows = spark.createDataFrame([(i % 7 if i % 3 else 100, i) for i in range(900)], "u long, v long")
    sums = rows.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("_c"))
    want = sorted(map(tuple, rows.join(sums.drop("_c"), "u").collect()))
    for share in (1, 3, 512):
        monkeypatch.setattr(graph, "SHARE", share)
        assert sorted(map(tuple, graph.join_back(rows, sums, ["u"], 900).collect())) == want


def test_query_matches_all_pairs_on_the_small_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    assert sorted(map(tuple, jaccard.link_classes(docs).collect())) == brute([tuple(r) for r in docs.collect()])


def test_hashes_follow_words():
    pick = random.Random(4)
    texts = ["".join(pick.choice("aB é\t\n#") for _ in range(pick.randrange(40))) for _ in range(500)] + ["x" * 3_000_000 + " y z", "k " * 700_000]
    for t in texts:
        want = brute_set(t)
        assert len(shingles.shingle_set(t)) == len(want)
    known = {}
    for t in texts:
        for s in brute_set(t):
            h = int(shingles.shingle_set(" ".join(s))[0])
            assert known.setdefault(h, s) == s
    long = " ".join(f"w{i}" for i in range(400_000))
    assert (shingles.word_hashes(long) == np.concatenate([shingles.word_hashes(f"w{i}") for i in range(0, 400_000, 997)])[0]).any()


def test_long_chains_contract(spark):
    pairs = [(i, i + 1) for i in range(60)] + [(100, 103), (103, 101), (7, 7)]
    got = dict(map(tuple, graph.components(spark.createDataFrame(pairs, "x long, y long")).collect()))
    assert got == {i: 0 for i in range(1, 61)} | {101: 100, 103: 100}
    assert graph.components(spark.createDataFrame([], "x long, y long")).count() == 0
    loose = graph.components(spark.createDataFrame([(None, 3), (4, None), (5, 5), (6, 7), (6, 7), (7, 6)], "x long, y long"))
    assert [tuple(r) for r in loose.collect()] == [(7, 6)]


def test_names_with_dots_and_backquotes_stay(spark):
    text = " ".join(f"w{i}" for i in range(60))
    docs = spark.createDataFrame([(1, text, "p", "q"), (2, text, "r", "s")], "doc_id long, text string, `a.b` string, `a``b` string")
    kept = jaccard.keep_one(docs)
    assert kept.columns == docs.columns and [tuple(r) for r in kept.collect()] == [(1, text, "p", "q")]
