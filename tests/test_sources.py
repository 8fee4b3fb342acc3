"""Readers, writers, the command line and the stream, through real files."""

import json

import pytest

from kinlink.__main__ import main
from kinlink.operators import validation
from kinlink.sources import readers, writers
from kinlink.streaming.ingest import normalize_stream

HEAD = "entity_id\tbusiness_name\tbusiness_address\tcountry\n"


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


def test_raw_cells(spark, tmp_path):
    path = put(tmp_path / "s.tsv", HEAD + 'S1-1\tNA\tnull\tUS\nS1-2\t"a ""b"" c"\t\tNone\n')
    rows = readers.read_raw(spark, path).collect()
    assert [tuple(r) for r in rows] == [("S1-1", None, None, "US"), ("S1-2", 'a "b" c', None, None)]
    assert readers.read_raw(spark, path, ()).first().business_name == "NA"
    with pytest.raises(ValueError):
        readers.read_raw(spark, put(tmp_path / "t.tsv", "entity_id\tx\n1\t2\n"))


def test_quoted_line_ends_stay_in_their_cell(spark, tmp_path):
    path = put(tmp_path / "s.tsv", HEAD + 'S1-1\t"two\nlines\tand a tab"\t"a ""b"""\tUS\nS1-2\tx\ty\tUS\n')
    assert [tuple(r) for r in readers.read_raw(spark, path).collect()] == [("S1-1", "two\nlines\tand a tab", 'a "b"', "US"), ("S1-2", "x", "y", "US")]
    truth = put(tmp_path / "g.tsv", 'source1_entity_id\tmatched_ids\nS1-1\t"S2-1,\nS2-2"\n')
    assert readers.read_truth(spark, truth).first().matched_entity_ids == "S2-1,\nS2-2"


def test_exported_files_are_checked(spark, tmp_path):
    matching = spark.createDataFrame([("S1-1", "S2-1"), ("S1-2", "")], "source1_entity_id string, matched_entity_ids string")
    pairs = spark.createDataFrame([("S1-1", "S2-1")], "source1_entity_id string, candidate_entity_id string")
    m, p = str(tmp_path / "m"), str(tmp_path / "p")
    writers.write_tsv(matching.repartition(2), m, one_file=True)
    writers.write_tsv(pairs, p)
    assert len(list((tmp_path / "m").glob("part-*"))) == 1
    good = validation.check_files(spark, m, p, matching, pairs).first()
    assert good.passed and good.matching_file_rows == 2 and good.candidates_bytes == sum(x.stat().st_size for x in (tmp_path / "p").glob("part-*"))
    assert not validation.check_files(spark, m, p, matching.limit(1), pairs).first().passed
    writers.write_tsv(matching.select("matched_entity_ids", "source1_entity_id"), m)
    bad = validation.check_files(spark, m, p, matching, pairs).first()
    assert not bad.passed and not bad.matching_header and bad.candidates_header


def test_truth_aliases_and_gates(spark, tmp_path):
    path = put(tmp_path / "g.tsv", "entity_id\tmatched_ids\nS1-1\tS2-1\n")
    assert readers.read_truth(spark, path).columns == ["source1_entity_id", "matched_entity_ids"]
    with pytest.raises(FileNotFoundError):
        readers.require_inputs(spark, [path, str(tmp_path / "none")])
    put(tmp_path / "deep/a/x.tsv", "1")
    assert readers.find_file(spark, str(tmp_path / "deep"), "x.tsv").endswith("deep/a/x.tsv")
    put(tmp_path / "deep/b/x.tsv", "1")
    with pytest.raises(FileNotFoundError):
        readers.find_file(spark, str(tmp_path / "deep"), "x.tsv")


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("S1-1", ""), ("S1-2", "S2-1,S2-2")], "source1_entity_id string, matched_entity_ids string")
    writers.write_tsv(df, str(tmp_path / "m"), one_file=True)
    text = "".join(p.read_text() for p in (tmp_path / "m").glob("part-*"))
    assert sorted(text.splitlines()) == ["S1-1\t", "S1-2\tS2-1,S2-2", "source1_entity_id\tmatched_entity_ids"]
    writers.write_partitioned(df, str(tmp_path / "p"), "source1_entity_id", 4)
    assert readers.read_stage(spark, str(tmp_path / "p"), ["source1_entity_id"]).count() == 2
    assert writers.write_report(df.limit(1), str(tmp_path / "r.json")) == json.loads((tmp_path / "r.json").read_text())


def test_split_filter_and_projection_reach_the_scan(spark, tmp_path):
    spark.createDataFrame([("train", 1, 2), ("validation", 3, 4)], "dataset_split string, a int, b int").write.parquet(str(tmp_path / "f"))
    df = readers.read_stage(spark, str(tmp_path / "f"), ["a"], "train")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(dataset_split,train)" in plan and "b:int" not in plan and [r.a for r in df.collect()] == [1]


def test_stream_normalizes_once(spark, tmp_path):
    put(tmp_path / "in/1.tsv", HEAD + "S2-1\tAcme Co\t1 Road\tUS\n")
    run = lambda: normalize_stream(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    run()
    put(tmp_path / "in/2.tsv", HEAD + "S2-2\tNA\t2 Road\tUS\n")
    run()
    rows = {r.entity_id: r for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert rows["S2-1"].name_core == "acme" and rows["S2-2"].name_missing == 1 and len(rows) == 2


def test_whole_run_from_files_to_files(spark, tmp_path):
    names = [f"company number {chr(97 + i)}{chr(97 + i)}{i}" for i in range(20)]
    for k in (1, 2, 3):
        rows = "".join(f"S{k}-{i}\t{n} ltd\t{i} some road {n[-3:]}\tUS\n" for i, n in enumerate(names))
        put(tmp_path / f"raw/source{k}.tsv", HEAD + rows)
    put(tmp_path / "gt.tsv", "source1_entity_id\tmatched_entity_ids\n" + "".join(f"S1-{i}\tS2-{i},S3-{i}\n" for i in range(18)) + "S1-18\t\nS1-19\t\n")
    at = lambda x: str(tmp_path / x)
    for k in (1, 2, 3):
        main(["preprocess", "--input", at(f"raw/source{k}.tsv"), "--output", at(f"n{k}")])
    sides = [x for k in (1, 2, 3) for x in (f"--source{k}", at(f"n{k}"))]
    main(["ground-truth", "--input", at("gt.tsv"), "--output", at("links")])
    before = []
    for stage in ("exact", "tokens", "fuzzy", "address"):
        main(["candidates", "--stage", stage, *sides, *before, "--output", at(stage)])
        before = ["--before", at(stage)]
    main(["recall", "--links", at("links"), "--pairs", at("address"), "--report", at("recall.json")])
    assert json.loads((tmp_path / "recall.json").read_text())["recall"][0]["recall"] == 1.0
    main(["training-pairs", "--pairs", at("address"), "--links", at("links"), "--output", at("labeled")])
    main(["features", *sides, "--pairs", at("labeled"), "--output", at("train")])
    main(["train", "--features", at("train"), "--model", at("model"), "--scored", at("val"), "--rounds", "2", "--min-leaf", "1", "--report", at("train.json")])
    main(["threshold", "--source1", at("n1"), "--links", at("links"), "--scored", at("val"), "--report", at("th.json")])
    main(["features", *sides, "--pairs", at("address"), "--output", at("test")])
    main(["score", "--features", at("test"), "--model", at("model"), "--output", at("scored"), "--threshold", "0.5"])
    main(["export", *sides, "--pairs", at("address"), "--scored", at("scored"), "--matching", at("m.tsv"), "--candidates", at("c.tsv")])
    main(["validate-export", "--matching", at("m.tsv"), "--candidates", at("c.tsv"), "--test-dir", at("raw"), "--report", at("v.json")])
    assert json.loads((tmp_path / "v.json").read_text())["status"] == "PASS"


def test_scratch_needs_a_shared_folder_on_a_cluster(spark, monkeypatch):
    from types import SimpleNamespace

    from kinlink.sources import scratch

    assert scratch.materialize(spark.range(3), "x").count() == 3
    conf = SimpleNamespace(get=lambda *_: None)
    remote = SimpleNamespace(sparkContext=SimpleNamespace(getConf=lambda: conf, _jsc=SimpleNamespace(sc=lambda: SimpleNamespace(isLocal=lambda: False))), conf=conf)
    with pytest.raises(ValueError):
        scratch.scratch(remote)
    conf.get = lambda *_: "hdfs://shared/"
    assert scratch.scratch(remote) == "hdfs://shared"
