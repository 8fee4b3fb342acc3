"""``python -m kinlink STEP``: the steps of the pipeline, each from files to files.

Memory, threads and spill space are Spark's own settings (``spark-submit --conf``).
"""

from __future__ import annotations

import argparse
import json
import sys
from dataclasses import fields, replace

from pyspark.sql import DataFrame, SparkSession

from .config import Blocking, Sampling, Sweep, Training
from .operators import blocking, features, labels, normalizing, profiling, recall, validation
from .plans import export, matcher, sweep
from .sources import readers, writers


def _knobs(p: argparse.ArgumentParser, cfg, *names: str) -> None:
    for f in fields(cfg):
        if f.name in names:
            kind = type(getattr(cfg, f.name))
            p.add_argument("--" + f.name.replace("_", "-"), type=kind if kind is not bool else lambda x: x.lower() == "true", default=getattr(cfg, f.name))


def _take(cfg, args: argparse.Namespace):
    return replace(cfg, **{f.name: getattr(args, f.name) for f in fields(cfg) if hasattr(args, f.name)})


def _sides(spark: SparkSession, args: argparse.Namespace) -> tuple[DataFrame, DataFrame]:
    paths = [args.source1, args.source2, args.source3]
    readers.require_inputs(spark, paths)
    s1, s2, s3 = (readers.read_stage(spark, p, readers.NORMALIZED) for p in paths)
    return normalizing.first_side(s1), normalizing.target_side(s2, s3)


def preprocess(spark, args) -> None:
    readers.require_inputs(spark, [args.input])
    writers.write_stage(normalizing.normalize_source(readers.read_raw(spark, args.input)), args.output, "snappy")
    validation.require_passed(validation.check_normalized(readers.read_stage(spark, args.output, readers.NORMALIZED)), args.output)


def validate_source(spark, args) -> None:
    _show(validation.require_passed(validation.check_normalized(readers.read_stage(spark, args.input, readers.NORMALIZED)), args.input))


def profile(spark, args) -> None:
    _show(profiling.profile_source(readers.read_raw(spark, args.input), args.name).first().asDict())


def ground_truth(spark, args) -> None:
    readers.require_inputs(spark, [args.input])
    writers.write_stage(labels.truth_links(readers.read_truth(spark, args.input)), args.output)


def candidates(spark, args) -> None:
    first, targets = _sides(spark, args)
    cfg, stage = _take(Blocking(), args), args.stage
    if stage == "exact":
        out = blocking.exact_candidates(first, targets, cfg)
    else:
        readers.require_inputs(spark, [args.before])
        step = {"tokens": blocking.name_token_candidates, "fuzzy": blocking.fuzzy_candidates, "address": blocking.address_candidates}[stage]
        out = step(first, targets, readers.read_stage(spark, args.before), cfg)
    writers.write_stage(out, args.output)
    _show(blocking.pair_summary(readers.read_stage(spark, args.output)).first().asDict())


def evaluate_recall(spark, args) -> None:
    links, pairs = readers.read_stage(spark, args.links), readers.read_stage(spark, args.pairs)
    rows = [r.asDict() for r in recall.candidate_recall(links, pairs).collect()]
    _show({"stage": args.stage, "recall": rows, "coverage": recall.entity_coverage(links, pairs).first().asDict()}, spark, args.report)


def training_pairs(spark, args) -> None:
    out = labels.labeled_pairs(readers.read_stage(spark, args.pairs), readers.read_stage(spark, args.links), _take(Sampling(), args))
    writers.write_stage(out, args.output)
    _show(validation.require_passed(validation.check_labeled(readers.read_stage(spark, args.output)), args.output))


def pair_features(spark, args) -> None:
    first, targets = _sides(spark, args)
    pairs = readers.read_stage(spark, args.pairs)
    writers.write_stage(features.pair_features(pairs, first, targets), args.output)
    _show(validation.require_passed(validation.check_features(readers.read_stage(spark, args.output), pairs), args.output))


def train(spark, args) -> None:
    rows = readers.read_stage(spark, args.features)
    model = matcher.train(rows, _take(Training(), args))
    matcher.save(model, args.model)
    scored = matcher.score(model, rows.where("dataset_split = 'validation'"))
    writers.write_stage(scored, args.scored)
    _show({"metrics": matcher.pair_metrics(readers.read_stage(spark, args.scored)).first().asDict(), "importances": matcher.importances(model)}, spark, args.report)


def optimize_threshold(spark, args) -> None:
    s1, links = readers.read_stage(spark, args.source1), readers.read_stage(spark, args.links)
    entities = sweep.validation_entities(normalizing.first_side(s1))
    swept = sweep.sweep(entities, links.join(entities, "source1_entity_id", "left_semi"), readers.read_stage(spark, args.scored), _take(Sweep(), args)).persist()
    _show({"best": sweep.best(swept).first().asDict(), "sweep": [r.asDict() for r in swept.orderBy("threshold").collect()]}, spark, args.report)


def score(spark, args) -> None:
    rows = readers.read_stage(spark, args.features)
    writers.write_stage(matcher.score(matcher.load(args.model), rows, args.threshold), args.output)
    out = readers.read_stage(spark, args.output)
    if (a := rows.count()) != (b := out.count()):
        raise ValueError(f"{a} pairs in, {b} out")
    _show(matcher.score_summary(out).first().asDict())


def export_files(spark, args) -> None:
    first, targets = _sides(spark, args)
    pairs, scored = readers.read_stage(spark, args.pairs), readers.read_stage(spark, args.scored)
    validation.require_passed(validation.check_before_export(first, targets, pairs, scored.where("predicted_match = 1")), "export")
    writers.write_tsv(export.candidate_export(pairs), args.candidates)
    writers.write_tsv(export.matching_results(first, scored), args.matching, args.one_file)


def validate_export(spark, args) -> None:
    sources = [readers.read_raw(spark, readers.find_file(spark, args.test_dir, name)) for name in args.files.split(",")]
    one = lambda df, name: df.select(df["entity_id"].alias(name))
    matching, pairs = readers.read_tsv(spark, args.matching, ("source1_entity_id", "matched_entity_ids")), readers.read_tsv(spark, args.candidates, ("source1_entity_id", "candidate_entity_id"))
    targets = one(sources[1], "candidate_entity_id").unionByName(one(sources[2], "candidate_entity_id"))
    row = validation.check_export(one(sources[0], "source1_entity_id"), targets, matching, pairs).first().asDict()
    _show(row, spark, args.report)
    if row["status"] != "PASS":
        sys.exit(1)


def _show(what: dict, spark: SparkSession | None = None, path: str | None = None) -> None:
    text = json.dumps(what, indent=2, default=str)
    print(text)
    if path:
        writers.write_text(spark, text, path)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="kinlink", description=__doc__)
    steps = top.add_subparsers(required=True)

    def step(name: str, run, /, *required: str, **optional) -> argparse.ArgumentParser:
        p = steps.add_parser(name)
        p.set_defaults(run=run)
        for r in required:
            p.add_argument("--" + r, required=True)
        for k, v in optional.items():
            p.add_argument("--" + k.replace("_", "-"), default=v)
        return p

    sides = ("source1", "source2", "source3")
    step("preprocess", preprocess, "input", "output")
    step("validate-source", validate_source, "input")
    step("profile", profile, "input", name="source")
    step("ground-truth", ground_truth, "input", "output")
    p = step("candidates", candidates, *sides, "output", before=None)
    p.add_argument("--stage", choices=("exact", "tokens", "fuzzy", "address"), required=True)
    _knobs(p, Blocking(), *[f.name for f in fields(Blocking)])
    step("recall", evaluate_recall, "links", "pairs", stage="", report=None)
    _knobs(step("training-pairs", training_pairs, "pairs", "links", "output"), Sampling(), "negatives_per_matched", "negatives_per_singleton")
    step("features", pair_features, *sides, "pairs", "output")
    _knobs(step("train", train, "features", "model", "scored", report=None), Training(), *[f.name for f in fields(Training)])
    _knobs(step("threshold", optimize_threshold, "source1", "links", "scored", report=None), Sweep(), "start", "stop", "step")
    step("score", score, "features", "model", "output").add_argument("--threshold", type=float, required=True)
    step("export", export_files, *sides, "pairs", "scored", "matching", "candidates").add_argument("--one-file", action="store_true")
    step("validate-export", validate_export, "matching", "candidates", "test-dir", files="source1.tsv,source2.tsv,source3.tsv", report=None)
    return top


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    args.run(SparkSession.builder.appName("kinlink").getOrCreate(), args)


if __name__ == "__main__":
    main()
