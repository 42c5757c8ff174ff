"""Command line: train, infer, merge, validate, synthetic, and the audits dataset, sanity and blocking.

python -m tessera.cli COMMAND --help. Data folders hold train/ and test/ with the sources as tab-separated files; all paths
may be of any file system that Spark reads. The session's master and settings come from spark-submit or the environment.
"""
from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.config import DEFAULTS
from tessera.functions.text import normalise
from tessera.operators import audit, decide
from tessera.operators.features import ModelBundle, bundle_sha256
from tessera.plans import index, linkage, ranges, synthetic
from tessera.session import remove, write_json
from tessera.sources import tsv


def _spark() -> SparkSession:
    return SparkSession.getActiveSession() or SparkSession.builder.appName("tessera").getOrCreate()


def _report(spark: SparkSession, path: str, value: dict) -> None:
    write_json(spark, path, value)
    print(json.dumps(value, indent=2, sort_keys=True))


def _options(a: argparse.Namespace) -> dict:
    """Options of candidates(); a stage 1 that is no larger than the cap re-ranks nothing."""
    return {"cap": a.candidate_cap, "limit": a.bucket_limit, "fallback": a.country_fallback_limit, "stage1": a.stage1 if a.stage1 > 0 else None}


def _sources(spark: SparkSession, a: argparse.Namespace, split: str) -> DataFrame:
    """Source records with _ord; the limit holds in file order, before the country."""
    rows = tsv.with_order(tsv.read_records(spark, tsv.source_path(a.data_root, split, 1), 1, a.multiline))
    limit = getattr(a, "source1_limit", None)
    return rows if limit is None else tsv.in_range(rows, 0, limit)


def _targets(a: argparse.Namespace, split: str) -> list[str]:
    return [tsv.source_path(a.data_root, split, i) for i in (2, 3)]


def train(a: argparse.Namespace) -> int:
    spark = _spark()
    rows = tsv.with_order(tsv.read_records(spark, tsv.source_path(a.data_root, "train", 1), 1, a.multiline))
    rows = rows.join(tsv.first_ids(rows, a.training_entity_limit, a.country), "entity_id", "left_semi").drop("_ord")
    found = index.from_files(spark, _targets(a, "train"), a.index_db or f"{a.output_dir}/train_index", a.country, a.target_limit, a.multiline)
    truth = tsv.read_truth(spark, tsv.truth_path(a.data_root)).select("s1", F.explode("ids").alias("t"))
    model, sweep = linkage.train(rows, None, truth, a.validation_fraction, DEFAULTS.seed, a.iterations, found, a.max_pairs or DEFAULTS.max_pairs, **_options(a))
    model.save(a.model, spark)
    best = sweep.orderBy(F.desc("f"), F.desc("threshold")).first().asDict()
    _report(spark, f"{a.output_dir}/training_summary.json", {"model_kind": model.kind, "model_sha256": bundle_sha256(spark, a.model), "threshold": model.threshold, "grid_best": best, "country": a.country or "all"})
    return 0


def infer(a: argparse.Namespace) -> int:
    if a.model and a.heuristic:
        raise ValueError("choose either --model or --heuristic, not both")
    if not a.model and not a.heuristic:
        raise ValueError("infer requires --model or the explicit --heuristic flag")
    if a.country and a.partition_by_country:
        raise ValueError("choose either --country or --partition-by-country, not both")
    if a.countries and not a.partition_by_country:
        raise ValueError("--countries requires --partition-by-country")
    if a.shard_count < 1:
        raise ValueError("--shard-count must be positive")
    if a.shard_count > 1 and not a.partition_by_country:
        raise ValueError("--shard-count requires --partition-by-country")
    if a.index_db and a.partition_by_country:
        raise ValueError("--index-db is not supported with --partition-by-country")
    spark = _spark()
    model = ModelBundle.load(a.model, spark) if a.model else ModelBundle()
    threshold = model.threshold if a.threshold is None else a.threshold
    report = {"model_kind": model.kind, "model_sha256": bundle_sha256(spark, a.model) if a.model else None, "threshold": threshold, "target_limited": a.target_limit is not None, "source1_limited": a.source1_limit is not None}
    sources = tsv.in_range(_sources(spark, a, a.split), a.start_ordinal, a.stop_ordinal)
    lands: list[str | None] = [a.country]
    if a.partition_by_country:
        lands = list(tsv.countries(sources))
        if a.countries:
            wanted = {c.strip().lower() for c in a.countries.split(",") if c.strip()}
            if wanted - set(lands):
                raise ValueError(f"--countries names that are absent: {', '.join(sorted(wanted - set(lands)))}")
            lands = [c for c in lands if c in wanted]
        if not lands:
            raise ValueError("no countries found")
    parts, paths = [], []
    for number, land in enumerate(lands):
        name = a.index_db or f"{a.output_dir}/index" + (f"-{number}" if a.partition_by_country else "")
        found = index.from_files(spark, _targets(a, a.split), name, land, a.target_limit, a.multiline)
        for shard in range(a.shard_count):
            rows = tsv.in_country(sources, land)
            rows = tsv.in_shard(rows, shard, a.shard_count) if a.shard_count > 1 else rows
            path = f"{a.output_dir}/parts/{number}-{shard}"
            # Rows carry their ordinals already; the part's own range is open.
            ranges.run_range(rows, found, path, 0, None, model, threshold, what={"range": [a.start_ordinal, a.stop_ordinal], "source1_limit": a.source1_limit, "country": land, "shard": [shard, a.shard_count], "split": a.split, "model_sha256": report["model_sha256"], "sources": index.files_identity(spark, tsv.source_path(a.data_root, a.split, 1))}, **_options(a))
            parts.append(ranges.read_part(spark, path))
            paths.append(path)
    whole = a.country is None and not a.countries and a.start_ordinal == 0 and a.stop_ordinal is None
    spine, results, candidates = ranges.merge_parts(parts, exclusive=not a.no_exclusivity, gaps=not whole)
    tsv.write_one_file(results, spine, f"{a.output_dir}/matching_results.tsv")
    tsv.write_one_file(candidates, spine, f"{a.output_dir}/candidate_pairs.tsv", tsv.CANDIDATES)
    report |= ranges.figures(parts, results, candidates, not a.no_exclusivity)
    report |= {"complete": whole and a.source1_limit is None, "country": a.country or "all", "partitions": len(lands), "shards": a.shard_count}
    if not a.keep_work:
        remove(spark, f"{a.output_dir}/parts")
    _report(spark, f"{a.output_dir}/inference_summary.json", report)
    return 0


def merge(a: argparse.Namespace) -> int:
    print(json.dumps(ranges.merge(_spark(), a.parts, a.output_dir, a.expected, not a.no_exclusivity), indent=2, sort_keys=True))
    return 0


def validate(a: argparse.Namespace) -> int:
    """0 where no rule is broken, else 1 with up to five examples of each."""
    spark = _spark()
    try:
        results = tsv.read_links(spark, a.matching)
        candidates = tsv.read_links(spark, a.candidate, tsv.CANDIDATES)
        required = tsv.read_records(spark, tsv.source_path(a.data_root, a.split, 1), 1, a.multiline).select(F.col("entity_id").alias("s1"))
        known = index.target_records(spark, _targets(a, a.split), None, a.multiline) if a.check_ids else None
        found = audit.finding_examples(results, candidates, required, known).orderBy("rule").collect()
    except Exception as e:  # the file cannot be read: that is the finding
        print(f"FAIL\n  {str(e).splitlines()[0]}")
        return 1
    for r in found:
        print(f"  {r.rule}: {r.distinct_n}, e.g. {', '.join(r.examples)}")
    print("FAIL" if found else "PASS")
    return 1 if found else 0


def dataset(a: argparse.Namespace) -> int:
    spark, out = _spark(), {}
    for split in ("train", "test") if a.split == "both" else (a.split,):
        for source in (1, 2, 3):
            rows = tsv.read_records(spark, tsv.source_path(a.data_root, split, source), source, a.multiline)
            rows = normalise(rows if a.sample_limit is None else tsv.in_range(tsv.with_order(rows), 0, a.sample_limit).drop("_ord"))
            out[f"{split}_source{source}"] = {
                "countries": [r.asDict() for r in audit.profile(rows).orderBy("land").collect()],
                "flags": {r.flag: r.n for r in audit.flag_counts(rows).collect()},
                "examples": [r.asDict() for r in audit.flagged_examples(rows).collect()],
            }
        if split == "train":
            out["ground_truth"] = audit.truth_profile(tsv.read_truth(spark, tsv.truth_path(a.data_root))).first().asDict()
    _report(spark, a.output, out)
    return 0


def sanity(a: argparse.Namespace) -> int:
    spark = _spark()
    links = tsv.read_truth(spark, tsv.truth_path(a.data_root))
    sources = normalise(tsv.read_records(spark, tsv.source_path(a.data_root, "train", 1), 1, a.multiline))
    targets = normalise(index.target_records(spark, _targets(a, "train"), None, a.multiline))
    figures = audit.sampled_sanity(links.select("s1", F.explode("ids").alias("t")), sources, targets, a.sample_links, DEFAULTS.seed).first().asDict()
    _report(spark, a.output, {"ground_truth": audit.truth_profile(links).first().asDict(), "country_sanity": figures})
    return 0


def blocking(a: argparse.Namespace) -> int:
    spark = _spark()
    rows = tsv.in_country(tsv.with_order(tsv.read_records(spark, tsv.source_path(a.data_root, "train", 1), 1, a.multiline)), a.country)
    rows = rows.join(tsv.first_ids(rows, a.source1_limit), "entity_id", "left_semi") if a.source1_limit is not None else rows
    chosen = decide.validation_ids(rows.select(F.col("entity_id").alias("s1")), a.validation_fraction, a.source1_limit)
    found = index.from_files(spark, _targets(a, "train"), a.index_db or f"{a.output}.index", a.country, a.target_limit, a.multiline)
    sources = normalise(rows.drop("_ord").join(chosen.select(F.col("s1").alias("entity_id")), "entity_id", "left_semi"))
    truth = tsv.read_truth(spark, tsv.truth_path(a.data_root)).select("s1", F.explode("ids").alias("t"))
    figures = audit.blocking_experiment(found.candidates(sources, **_options(a)), truth, chosen).first().asDict()
    _report(spark, a.output, {**figures, **_options(a), "country": a.country or "all", "index": found.manifest})
    return 0


def suite(a: argparse.Namespace) -> int:
    rows = synthetic.run(_spark(), a.threshold).orderBy("number").collect()
    print(f"{sum(r.passed for r in rows)}/{len(rows)} passed")
    return 0 if all(r.passed for r in rows) else 1


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="tessera", description="Record linkage on Spark")
    commands = out.add_subparsers(dest="command", required=True)

    def command(name, handler, *, output=None, blocks=False):
        p = commands.add_parser(name)
        p.set_defaults(handler=handler)
        p.add_argument("--data-root", default="dataset")
        p.add_argument("--multiline", action="store_true", help="cells may hold line breaks; each file is then one task")
        if output:
            p.add_argument("--output", default=output)
        if blocks:
            p.add_argument("--index-db")
            p.add_argument("--country")
            for flag, value in (("--target-limit", None), ("--candidate-cap", DEFAULTS.candidate_cap), ("--country-fallback-limit", DEFAULTS.country_fallback), ("--bucket-limit", DEFAULTS.bucket_limit), ("--stage1", DEFAULTS.stage1)):
                p.add_argument(flag, type=int, default=value)
        return p

    p = command("train", train, blocks=True)
    p.add_argument("--output-dir", default="output")
    p.add_argument("--model", default="output/model")
    p.add_argument("--training-entity-limit", type=int, default=50_000)
    p.add_argument("--validation-fraction", type=float, default=DEFAULTS.validation_fraction)
    p.add_argument("--max-pairs", type=int)
    p.add_argument("--iterations", type=int, default=120)
    p = command("infer", infer, blocks=True)
    p.add_argument("--output-dir", default="output")
    p.add_argument("--split", choices=("train", "test"), default="test")
    p.add_argument("--model")
    for flag in ("--heuristic", "--no-exclusivity", "--keep-work", "--partition-by-country"):
        p.add_argument(flag, action="store_true")
    p.add_argument("--threshold", type=float)
    p.add_argument("--source1-limit", type=int)
    p.add_argument("--start-ordinal", type=int, default=0)
    p.add_argument("--stop-ordinal", type=int)
    p.add_argument("--countries")
    p.add_argument("--shard-count", type=int, default=1)
    p = command("merge", merge)
    p.add_argument("parts", nargs="+")
    p.add_argument("--output-dir", default="output")
    p.add_argument("--expected", type=int)
    p.add_argument("--no-exclusivity", action="store_true")
    p = command("validate", validate)
    p.add_argument("--matching", default="output/matching_results.tsv")
    p.add_argument("--candidate", default="output/candidate_pairs.tsv")
    p.add_argument("--split", choices=("train", "test"), default="test")
    p.add_argument("--check-ids", action="store_true")
    p = command("dataset", dataset, output="artifacts/eda.json")
    p.add_argument("--split", choices=("train", "test", "both"), default="both")
    p.add_argument("--sample-limit", type=int)
    p = command("sanity", sanity, output="artifacts/sanity.json")
    p.add_argument("--sample-links", type=int, default=100_000)
    p = command("blocking", blocking, output="artifacts/blocking_recall.json", blocks=True)
    p.add_argument("--source1-limit", type=int, default=20_000)
    p.add_argument("--validation-fraction", type=float, default=DEFAULTS.validation_fraction)
    p = command("synthetic", suite)
    p.add_argument("--threshold", type=float, default=DEFAULTS.threshold)
    return out


def main(argv: list[str] | None = None) -> int:
    a = parser().parse_args(argv)
    return a.handler(a)


if __name__ == "__main__":
    sys.exit(main())
