"""Permutation round trips, shard laws, targets and the splitting tree against brute force."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kinlink.llm import mixing, sharding


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 5000), st.integers(0, 5))
def test_permutation_is_a_bijection_with_inverse(n, seed):
    p = sharding.permute(np.arange(n), n, seed)
    assert sorted(p) == list(range(n))
    assert (sharding.permute(p, n, seed, back=True) == np.arange(n)).all()


def test_locate_and_row_at_agree():
    for row in (0, 1, 999_999_999_999):
        shard, slot = sharding.locate(row, 10**12, 24)
        assert sharding.row_at(shard, slot, 10**12, 24) == row


def test_shards_differ_by_a_row_and_slots_have_no_gaps(spark):
    rows = [(None, "x", 1)] * 3 + [(5, None, 2)] * 40 + [(i, str(i), 9) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, shard int")
    out = sharding.shard_rows(df.withColumns({c: F.lit(c) for c in ("_at", "_row", "row", "number", "k0")}), ["doc_id"], 7)
    assert out.columns == ["doc_id", "text", "_at", "_row", "row", "number", "k0", "shard", "slot"] and out.where("_at = '_at' AND number = 'number'").count() == len(rows)
    got = out.collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter((a, b) for a, b, _ in rows)
    slots = {}
    for r in got:
        slots.setdefault(r.shard, []).append(r.slot)
    assert sorted(slots) == list(range(7)) and all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    assert sharding.shard_rows(df.limit(0), ["doc_id"], 7).count() == 0


def test_shards_do_not_depend_on_the_layout(spark):
    df = spark.range(500).select(F.col("id").alias("doc_id"))
    one, two = (sorted(map(tuple, sharding.shard_rows(d, ["doc_id"], 5).collect())) for d in (df.repartition(1), df.repartition(9)))
    assert one == two
    assert [tuple(r[1:]) for r in one] == [sharding.locate(r, 500, 5) for r in range(500)]


def test_query_fields(spark):
    from kinlink.llm.queries import op2_feistel_shards

    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    for r in op2_feistel_shards(spark, "/root/testdata/sf0.001").collect():
        data = docs[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(data) + 8, zlib.crc32(data), "rows", None)


def brute_targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight, target, fixed = {s: i % 3 + 1 for i, s in enumerate(names)}, {}, set()
    while True:
        left = sum(sizes.values()) - sum(3 * sizes[s] for s in fixed)
        w = sum(weight[s] for s in names if s not in fixed)
        target = {s: 3 * sizes[s] if s in fixed else left * weight[s] / w for s in names}
        over = {s for s in names if target[s] > 3 * sizes[s] * (1 + 1e-12)}
        if not over:
            return target
        fixed |= over


def test_targets_match_resharing(spark):
    pick = random.Random(2)
    for n in (1, 2, 7, 40):
        sizes = {f"s{i}": pick.choice([0, 1, 5, 50, 4000]) for i in range(n)} | {None: 11}
        got = {r.source: r.target for r in mixing.targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()}
        want = brute_targets(sizes)
        assert got == pytest.approx(want)


def test_hypergeometric_quantiles(spark):
    from math import comb

    rows = [(20, 8, 6, u / 10) for u in range(1, 10)] + [(1, 1, 1, 0.5), (5, 0, 3, 0.5), (5, 5, 3, 0.9), (0, 0, 0, 0.5)]
    df = spark.createDataFrame(rows, "n long, m long, k long, u double")
    for (n, m, k, u), r in zip(rows, df.select(mixing.hypergeometric(F.col("n"), F.col("m"), F.col("k"), F.col("u"))).collect(), strict=True):
        cum, want = 0.0, None
        for x in range(max(0, k - (n - m)), min(m, k) + 1):
            cum += comb(m, x) * comb(n - m, k - x) / comb(n, k)
            want = x if want is None and cum >= u else want
        assert r[0] == want


def test_quotas_are_exact(spark):
    counts = {"a": 900, "b": 17, "c": 0, None: 83}
    for shards in (1, 2, 5, 16):
        ends = {r.source: r.ends for r in mixing.split_quotas(spark.createDataFrame(list(counts.items()), "source string, draws long"), shards, 3).collect()}
        assert {s: e[-1] for s, e in ends.items()} == counts and all(len(e) == shards and e == sorted(e) for e in ends.values())
        each = [sum(e[k] - (e[k - 1] if k else 0) for e in ends.values()) for k in range(shards)]
        assert max(each) - min(each) <= shards.bit_length() + 1


def test_mix_takes_whole_copies_near_targets(spark):
    pick = random.Random(4)
    rows = [(i, pick.choice(["a", "b", None, "hot", "hot", "hot"]), " ".join("w" * pick.randrange(1, 40)), 7) for i in range(1500)] + [(None, "a", None, 1), (3, "a", "", 1), (4, "b", "x y", 2), (4, "b", "x y", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string, size int")
    plan = mixing.plan(docs, ["doc_id"]).collect()
    assert len(plan) == len(rows)
    taken = Counter()
    for r in plan:
        taken[r.row.source] += r.size * len(r.shards)
        assert len(r.shards) <= 3 and r.size == len((r.row.text or "").split())
    for s, t in {r.row.source: r.target for r in plan}.items():
        assert abs(taken[s] - t) <= 0.02 * t
    mixed = mixing.mix(docs, ["doc_id"])
    assert mixed.columns == docs.columns
    assert Counter(map(tuple, mixed.collect())) == Counter(t for r in plan for t in [tuple(r.row)] * len(r.shards))
    again = mixing.mix(docs.repartition(5), ["doc_id"], keep_shard=True).collect()
    assert sum(len(r.shards) for r in plan) == len(again) and {r.mix_shard for r in again} == set(range(16))
    # Rows come shard by shard, shuffled within each.
    assert [(r.mix_shard, r.mix_order) for r in again] == sorted((r.mix_shard, r.mix_order) for r in again)
    assert [r.doc_id for r in again if r.mix_shard == 3] != sorted(r.doc_id for r in again if r.mix_shard == 3 and r.doc_id)
    clash = docs.withColumns({c: F.lit(c) for c in ("_size", "_block", "row", "shard", "at", "copy", "mix_shard")})
    out = mixing.mix(clash, ["doc_id"], keep_shard=True)
    assert out.columns == [*clash.columns, "mix_shard_", "mix_order"] and out.where("_size = '_size' AND at = 'at' AND mix_shard = 'mix_shard'").count() == len(again)
    assert mixing.mix(docs.limit(0), ["doc_id"]).count() == 0


def test_query_takes_what_the_tree_dealt(spark):
    """Shards hold equal numbers of block draws, a block's draws are one a copy, and each source's quota is met."""
    from kinlink.llm.queries import op7_splitting_tree_mix

    rows = op7_splitting_tree_mix(spark, "/root/testdata/sf0.01").collect()
    assert all(r.taken == r.size * len(r.shards) and all(0 <= s < 16 for s in r.shards) for r in rows)
    block = lambda r: (r.source, tuple(r.shards))
    assert len({block(r) for r in rows}) > 16
    taken, target = Counter(), {}
    for r in rows:
        taken[r.source] += r.taken
        target[r.source] = r.target
    assert taken == pytest.approx(target, rel=0.03)
    words = Counter(s for r in rows for s in r.shards for _ in range(r.size))
    assert set(words) == set(range(16))
