"""Runs over ranges of the source records that can stop and go on, and their merge into what one run gives.

A part holds its spine (s1, _ord), its candidates and its qualified pairs, and a summary that is written last. Exclusivity
is decided over the merged pairs: a target claimed in two parts goes to the same record as in one run.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.text import normalise
from tessera.operators import decide
from tessera.operators.features import ModelBundle, pair_features
from tessera.plans.index import TargetIndex
from tessera.session import read_json, remove, ship, write_json
from tessera.sources import tsv


def run_range(ordered: DataFrame, index: TargetIndex, path: str, start: int = 0, stop: int | None = None, model: ModelBundle | None = None, threshold: float | None = None, what: dict | None = None, **options) -> dict:
    """Link the records [start, stop) of raw source records with _ord, and write the part; a whole part of the same range,
    threshold, model, options, index and description `what` (of the source records, say) is left as it is."""
    spark, model = ordered.sparkSession, model or ModelBundle()
    ship(spark)
    limit = model.threshold if threshold is None else threshold
    what = {"what": what, "start": start, "stop": stop, "threshold": limit, "model": model.kind, "index": index.manifest["fingerprint"], "options": {k: v for k, v in sorted(options.items())}}
    done = read_json(spark, f"{path}/summary.json")
    if done and done["complete"] and all(done[k] == v for k, v in what.items()):
        return done
    remove(spark, path)
    part = tsv.in_range(ordered, start, stop)
    part.select(F.col("entity_id").alias("s1"), "_ord").write.parquet(f"{path}/spine")
    sources = normalise(part.drop("_ord"))
    index.candidates(sources, **options).write.parquet(f"{path}/candidates")
    edges = spark.read.parquet(f"{path}/candidates")
    scored = model.score(pair_features(edges, sources, index.records)).select("s1", "t", "p")
    decide.above(scored, limit).write.parquet(f"{path}/qualified")
    spine, _, qualified = read_part(spark, path)
    summary = {**what, "sources": spine.count(), "candidate_edges": edges.count(), "qualified": qualified.count(), "complete": True}
    write_json(spark, f"{path}/summary.json", summary)
    return summary


def read_part(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """spine, candidates and qualified pairs of a whole part."""
    done = read_json(spark, f"{path}/summary.json")
    if done is not None and not done["complete"]:
        raise RuntimeError(f"{path} is not whole")
    return tuple(spark.read.parquet(f"{path}/{x}") for x in ("spine", "candidates", "qualified"))


def check_parts(spine: DataFrame, expected: int | None = None, gaps: bool = False) -> int:
    """How many records the parts hold; refuses repeated records or ordinals, gaps where they are not asked for, and
    another number than expected."""
    n, ids, ordinals, first, last = spine.agg(F.count("*"), F.countDistinct("s1"), F.countDistinct("_ord"), F.min("_ord"), F.max("_ord")).first()
    if ids != n or ordinals != n:
        raise RuntimeError(f"{n - min(ids, ordinals)} source records stand in more than one part")
    if n and not gaps and (first != 0 or last != n - 1):
        raise RuntimeError("the parts leave out source records")
    if expected is not None and n != expected:
        raise RuntimeError(f"the parts hold {n} source records, expected {expected}")
    return n


def merge_parts(parts: list[tuple[DataFrame, DataFrame, DataFrame]], expected: int | None = None, exclusive: bool = True, gaps: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """spine, results and candidates of one run from (spine, candidates, qualified) of its parts."""
    if not parts:
        raise ValueError("no parts")
    spine, edges, qualified = (_union([p[i] for p in parts]) for i in range(3))
    check_parts(spine, expected, gaps)
    won = decide.exclusive(qualified) if exclusive else qualified
    return spine, tsv.id_lists(won, spine), tsv.id_lists(edges, spine, by_rank=True)


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def merge(spark: SparkSession, paths: list[str], out: str, expected: int | None = None, exclusive: bool = True) -> dict:
    """Merge written parts into matching_results.tsv, candidate_pairs.tsv and a summary; parts that are not whole are refused."""
    for path in paths:
        if read_json(spark, f"{path}/summary.json") is None:
            raise RuntimeError(f"{path} is missing or not whole")
    parts = [read_part(spark, p) for p in paths]
    spine, results, candidates = merge_parts(parts, expected, exclusive)
    tsv.write_one_file(results, spine, f"{out}/matching_results.tsv")
    tsv.write_one_file(candidates, spine, f"{out}/candidate_pairs.tsv", tsv.CANDIDATES)
    summary = {**figures(parts, results, candidates, exclusive), "complete": True}
    write_json(spark, f"{out}/inference_summary.json", summary)
    return summary


def figures(parts: list[tuple[DataFrame, DataFrame, DataFrame]], results: DataFrame, candidates: DataFrame, exclusive: bool = True) -> dict:
    """The totals of a merged run; without exclusivity there are no collisions to settle."""
    out = decide.totals(results, candidates, _union([p[2] for p in parts])).first().asDict()
    return out if exclusive else {**out, "collisions": 0}


def concatenate(parts: dict[str, DataFrame | None]) -> DataFrame:
    """The (s1, ids) rows of several partitions; a missing partition or a record in two of them is refused."""
    missing = sorted(k for k, v in parts.items() if v is None)
    if missing or not parts:
        raise RuntimeError(f"missing parts: {', '.join(missing) or 'all'}")
    return tsv.single_rows(_union([p.select("s1", "ids") for p in parts.values()]))


def ranges(n: int, size: int) -> list[tuple[int, int]]:
    """[start, stop) pairs that cover n records."""
    if size < 1:
        raise ValueError("size must be 1 or more")
    return [(i, min(n, i + size)) for i in range(0, n, size)]
