"""Separator scan over raw files: blocks of any size, missing last separators, empty documents."""

import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from kinlink.llm import tokencounts
from kinlink.llm.queries import SEPARATOR

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def brute(values, separator):
    out, n = [], 0
    for v in values:
        if v == separator:
            out.append(n)
            n = 0
        else:
            n += 1
    return out + [n] * (n > 0)


@pytest.mark.parametrize("width", [2, 4])
def test_scan_matches_brute_force(spark, tmp_path, width):
    pick, want = random.Random(width), {}
    for k in range(12):
        values = [pick.choice([9, 1, 2, 3, 3, 3]) for _ in range(pick.choice([0, 1, 7, 64, 500]))]
        values += [9] * (k % 3 == 0)
        (tmp_path / f"{k}.tokens").write_bytes(np.array(values, dtype=f"<u{width}").tobytes())
        want[f"{k}.tokens"] = brute(values, 9)
    files = tokencounts.token_files(spark, str(tmp_path))
    for block in (4, 32, 1 << 20):
        got = {}
        for r in tokencounts.document_lengths(files, 9, width, block).orderBy("document").collect():
            assert r.document == len(got.setdefault(r.file.rsplit("/", 1)[1], []))
            got[r.file.rsplit("/", 1)[1]].append(r.n_tokens)
        assert got == {k: v for k, v in want.items() if v}


def test_cut_files_fail(spark, tmp_path):
    (tmp_path / "x").write_bytes(b"abc")
    with pytest.raises(Exception, match="whole number of tokens"):
        tokencounts.document_lengths(tokencounts.token_files(spark, str(tmp_path)), 9).collect()


def test_round_trip_of_documents(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    docs = docs.unionByName(spark.createDataFrame([(None, None), (-1, ""), (-2, "<|endoftext|>"), (-2, "x" * 100_000)], "doc_id long, text string"))
    encoder = tokencounts.Bpe(RANKS, public_tokenizers.PATTERN)
    manifest = tokencounts.write_token_files(docs.withColumn("file", F.lit(1)), str(tmp_path / "t"), encoder, SEPARATOR)
    encode = encoder()
    want = sorted((str(r.doc_id), len(encode(r.text or ""))) for r in docs.collect())
    assert sorted((str(r.doc_id), r.n_tokens) for r in tokencounts.counts_by_document(manifest, SEPARATOR, block=1 << 12).collect()) == want
    none = tokencounts.write_token_files(docs.limit(0), str(tmp_path / "none"), encoder, SEPARATOR)
    assert tokencounts.counts_by_document(none, SEPARATOR).count() == 0
