"""Stateful streaming deduplication over disk-backed keyed state that never expires.

A structured stream reads the table file by file and keeps, for each digest of a normalised text, the group's size, its
best row's stable identifier and a content locator (file and row). The state lives in a RocksDB store in the shared
folder; no watermark, so nothing expires, and a restarted stream goes on where it stopped. Rows whose digest the state
holds more than once are hits: their full bytes are compared with those at the locator.
"""
from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import shared_dir, small_batches, utf8

_SPACE = b" \t\n\x0b\f\r"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@F.arrow_udf(T.BinaryType())
def _digest(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in texts:
        yield pa.array([hashlib.sha256(x.translate(None, _SPACE)).digest() for x in batch.to_pylist()], pa.binary())


@F.arrow_udf(T.BooleanType())
def _same(a: pa.Array, b: pa.Array) -> pa.Array:
    return pa.array([x.translate(None, _SPACE) == y.translate(None, _SPACE) for x, y in zip(a.to_pylist(), b.to_pylist(), strict=True)], pa.bool_())


def _row() -> Column:
    """Order of preference: most code points, then the smallest id (null ids last), then the locator."""
    file, at = F.col("_metadata.file_name"), F.col("_metadata.row_index")
    return F.struct((-F.length(F.coalesce("text", F.lit("")))).alias("less"), F.col("doc_id").isNull().alias("unnamed"), F.col("doc_id").alias("doc_id"), file.alias("file"), at.alias("at"))


class StreamingDeduper:
    """Keyed dedup state in `folder`; `ingest` may be called again when files were added."""

    def __init__(self, spark: SparkSession, path: str, folder: str | None = None):
        self.spark, self.path = spark, path
        self.folder = folder or f"{shared_dir(spark)}/exact-dedup-{uuid.uuid4().hex}"
        small_batches(spark)

    def _pattern(self) -> str:
        """The path as a pattern that matches it alone: the file source then takes a single file as well as a folder."""
        path = self.path.rstrip("/")
        return f"{path[:-1]}[{path[-1]}]"

    def ingest(self) -> StreamingDeduper:
        """Take in what the state has not seen yet, and return."""
        conf, held = self.spark.conf, {}
        for k, v in {"spark.sql.streaming.stateStore.providerClass": ROCKS, "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true", "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false", "spark.sql.streaming.noDataMicroBatches.enabled": "false"}.items():
            held[k] = conf.get(k, None)
            conf.set(k, v)
        try:
            schema = self.spark.read.parquet(self.path).schema
            rows = self.spark.readStream.schema(schema).parquet(self._pattern()).select(_digest(utf8("text")).alias("digest"), _row().alias("row"))
            state = rows.groupBy("digest").agg(F.count("*").alias("group_size"), F.min("row").alias("best"))
            query = state.writeStream.format("noop").outputMode("update").option("checkpointLocation", self.folder).trigger(availableNow=True).start()
            query.awaitTermination()
        finally:
            for k, v in held.items():
                conf.unset(k) if v is None else conf.set(k, v)
        return self

    def state(self) -> DataFrame:
        """The keyed state: digest, group_size, best (doc_id and locator)."""
        raw = self.spark.read.format("statestore").load(self.folder)
        count, best = raw.schema["value"].dataType.names[:2]
        return raw.select(F.col("key").getField(raw.schema["key"].dataType.names[0]).alias("digest"), F.col("value").getField(count).alias("group_size"), F.col("value").getField(best).alias("best"))

    def results(self) -> DataFrame:
        """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

        Null texts count as empty, and empty texts equal each other. Of rows that share an id, the one at the locator is
        kept. An empty table gives no rows; other columns are ignored. Two different texts with one digest stop the
        query: the byte comparison of a hit raises an error."""
        docs = self.spark.read.parquet(self.path)
        rows = docs.select(_row().alias("row"), utf8("text").alias("bytes"))
        rows = rows.withColumn("digest", _digest("bytes"))
        state = self.state().where(F.col("digest").isNotNull())
        found = rows.select("digest", "row").join(state, "digest")
        place = lambda s: (F.col(f"{s}.file"), F.col(f"{s}.at"))
        # Full bytes of the hits against those at the locator: only texts of repeated groups move, keyed by row or digest.
        hits = state.where(F.col("group_size") > 1)
        texts = rows.join(hits.withColumnRenamed("best", "of"), "digest")
        kept = texts.where((F.col("row.file") == F.col("of.file")) & (F.col("row.at") == F.col("of.at"))).select("digest", F.col("bytes").alias("kept_bytes"))
        compared = texts.select("digest", "row", "bytes").join(kept, "digest").select(F.col("digest"), *(c.alias(n) for c, n in zip(place("row"), ("file", "at"), strict=True)), _same(F.col("bytes"), F.col("kept_bytes")).alias("same"))
        alone = found.where(F.col("group_size") == 1).select("row", "best", "group_size", "digest", F.lit(True).alias("same"))
        many = found.where(F.col("group_size") > 1).join(compared.select("file", "at", "same"), (F.col("row.file") == F.col("file")) & (F.col("row.at") == F.col("at"))).select("row", "best", "group_size", "digest", "same")
        out = alone.unionByName(many)
        checked = F.when(F.col("same"), F.lower(F.hex("digest"))).otherwise(F.raise_error(F.lit("two texts share a digest")))
        return out.select(F.col("row.doc_id").alias("doc_id"), F.col("best.doc_id").alias("keep_id"), F.col("group_size").cast("long").alias("group_size"), ((F.col("row.file") == F.col("best.file")) & (F.col("row.at") == F.col("best.at"))).alias("kept"), checked.alias("text_sha256"))
