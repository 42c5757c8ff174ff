"""The targets' normalised records and blocking keys as tables, written once and used again while their sources stay the same.

Each key row carries how many targets hold the key, in all and in its country, so that a bucket limit is a filter that
reaches the scan. The manifest is written last: a folder without a complete one is built anew.
"""
from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.config import DEFAULTS, METHODS
from tessera.functions.text import normalise
from tessera.operators import blocking
from tessera.session import read_json, remove, ship, write_json
from tessera.sources import tsv

#: Raise one of these when tables or normalisation change: indexes of other versions are built anew.
SCHEMA_VERSION, NORMALISATION_VERSION = 1, 1


@dataclass
class TargetIndex:
    """A built index: records (normalised), keys (with n and n_land, the targets of a key) and its manifest."""

    records: DataFrame
    keys: DataFrame
    manifest: dict

    def within(self, limit: int = DEFAULTS.bucket_limit, by_country: bool = False) -> DataFrame:
        """The keys whose buckets hold no more than `limit` targets."""
        if limit < 1:
            raise ValueError("bucket_limit must be 1 or more")
        return self.keys.where(F.col("n_land" if by_country else "n") <= limit).select("entity_id", "land", "method", "key")

    def candidates(self, sources: DataFrame, cap: int = DEFAULTS.candidate_cap, limit: int = DEFAULTS.bucket_limit, fallback: int = DEFAULTS.country_fallback, stage1: int | None = DEFAULTS.stage1, by_country: bool = False) -> DataFrame:
        """The candidates of normalised source records."""
        return blocking.candidates(sources, self.records, cap, limit, fallback, stage1, by_country, keys=self.within(limit, by_country))

    def get(self, *ids: str) -> DataFrame:
        """The records of a few ids; the filter reaches the scan."""
        return self.records.where(F.col("entity_id").isin(*ids))

    def lookup(self, ids: DataFrame) -> DataFrame:
        """The records whose ids stand in a column entity_id of any size."""
        return self.records.join(ids.select("entity_id").distinct(), "entity_id", "left_semi")


def files_identity(spark: SparkSession, *paths: str) -> str:
    """A digest of the files' names, sizes and times."""
    j, seen = spark._jvm, []
    for path in paths:
        at = j.org.apache.hadoop.fs.Path(path)
        fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        files = fs.listFiles(fs.makeQualified(at), True)
        while files.hasNext():
            f = files.next()
            seen.append(f"{f.getPath()} {f.getLen()} {f.getModificationTime()}")
    return hashlib.sha256("\n".join(sorted(seen)).encode()).hexdigest()


def _expected(identity: str, country: str | None, limit: int | None, exact: bool) -> dict:
    return {"schema_version": SCHEMA_VERSION, "normalisation_version": NORMALISATION_VERSION, "sources": identity, "country": (country or "all").strip().lower(), "target_limit": "all" if limit is None else limit, "exact": exact, "methods": list(METHODS)}


def fingerprint(manifest: dict) -> str:
    """A digest of everything that decides an index's content."""
    return hashlib.sha256(json.dumps({k: v for k, v in manifest.items() if k != "fingerprint"}, sort_keys=True).encode()).hexdigest()


def build(targets: DataFrame, path: str, identity: str, country: str | None = None, limit: int | None = None, exact: bool = True) -> TargetIndex:
    """Write the index of raw target records; limit is a note of how the targets were cut, not a cut."""
    spark = targets.sparkSession
    ship(spark)
    remove(spark, path)
    normalise(tsv.in_country(targets, country), exact=exact).write.parquet(f"{path}/records")
    records = spark.read.parquet(f"{path}/records")
    keys = blocking.blocking_keys(records)
    # Counts are summed in each task first; a window over the key would put a crowded one into one task.
    per_land = keys.groupBy("method", "key", "land").agg(F.count("*").alias("n_land"))
    counts = per_land.withColumn("n", F.sum("n_land").over(Window.partitionBy("method", "key")))
    keys.join(counts, ["method", "key", "land"]).select("entity_id", "land", "method", "key", "n", "n_land").sortWithinPartitions("n").write.parquet(f"{path}/keys")
    manifest = {**_expected(identity, country, limit, exact), "row_count": records.count(), "complete": True}
    write_json(spark, f"{path}/manifest.json", {**manifest, "fingerprint": fingerprint(manifest)})
    return opened(spark, path)


def opened(spark: SparkSession, path: str) -> TargetIndex | None:
    """The index in a folder; None where there is none, or a part of one."""
    manifest = read_json(spark, f"{path}/manifest.json")
    if not manifest or not manifest.get("complete") or manifest.get("fingerprint") != fingerprint(manifest):
        return None
    return TargetIndex(spark.read.parquet(f"{path}/records"), spark.read.parquet(f"{path}/keys"), manifest)


def open_or_build(spark: SparkSession, path: str, identity: str, targets: Callable[[], DataFrame], country: str | None = None, limit: int | None = None, exact: bool = True) -> TargetIndex:
    """The folder's index where it is whole and of the same sources, versions, country and limit; else a new one."""
    found = opened(spark, path)
    if found and all(found.manifest.get(k) == v for k, v in _expected(identity, country, limit, exact).items()):
        return found
    return build(targets(), path, identity, country, limit, exact)


def target_records(spark: SparkSession, paths: list[str], limit: int | None = None, multiline: bool = False) -> DataFrame:
    """The records of target files, the first `limit` of each file where one is given."""
    out = None
    for path in paths:
        rows = tsv.read_records(spark, path, None, multiline)
        if limit is not None:
            rows = tsv.in_range(tsv.with_order(rows), 0, limit).drop("_ord")
        out = rows if out is None else out.unionByName(rows)
    return out


def from_files(spark: SparkSession, paths: list[str], path: str, country: str | None = None, limit: int | None = None, multiline: bool = False) -> TargetIndex:
    """open_or_build over tab-separated files."""
    return open_or_build(spark, path, files_identity(spark, *paths), lambda: target_records(spark, paths, limit, multiline), country, limit)
