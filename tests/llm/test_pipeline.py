"""Each stage of the pipeline on what its predecessor kept, and the registered queries."""

from collections import Counter

import __spark_entry__ as entry
import corpus_pipeline
from kinlink.llm import decontamination, jaccard, mixing, quality
from kinlink.llm.shared import materialize

DIR = "/root/testdata/sf0.01"


def test_registered():
    names = sorted(int(n[2:].split("_")[0]) for n in entry.queries() if n.startswith("op"))
    assert names == list(range(1, 11)) and "pipeline" in entry.queries()
    assert [n for n, _ in corpus_pipeline.STAGES][0] == "quality rules" and len(corpus_pipeline.STAGES) == 5


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    columns, kept = docs.columns, [docs]
    for _, stage in corpus_pipeline.STAGES:
        kept.append(materialize(stage(spark, kept[-1], DIR), "test"))
    for df in kept[1:-1]:
        assert df.columns == columns
    ids = [Counter(r.doc_id for r in df.select("doc_id").collect()) for df in kept]
    good = {r.doc_id for r in quality.score(docs, ["doc_id"]).where("kept").collect()}
    assert set(ids[1]) == good
    assert set(ids[2]) == {r.doc_id for r in jaccard.link_classes(kept[1]).where("doc_id = component_id").collect()}
    bench = spark.read.parquet(f"{DIR}/benchmark.parquet")
    found = decontamination.contamination(kept[2], bench)
    assert set(ids[3]) == {r.doc_id for r in found.where("found.n_hit = 0").collect()}
    taken = {r.row.doc_id: len(r.shards) for r in mixing.plan(kept[3], ["doc_id"]).collect()}
    assert ids[4] == Counter({i: n for i, n in taken.items() if n})
    assert ids[5] == ids[4] and kept[5].columns == [*columns, "shard", "slot"]
    assert sorted((r.shard, r.slot) for r in kept[5].select("shard", "slot").collect()) == sorted((i % 24, i // 24) for i in range(sum(ids[5].values())))


def test_empty_documents_pass_through(spark, tmp_path):
    spark.read.parquet(f"{DIR}/documents.parquet").limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{DIR}/benchmark.parquet").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
