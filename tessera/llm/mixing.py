"""Mixing sources to target weights by systematic sampling, in DataFrame functions only.

Within a source every document has the same expected number of copies (the source's target over its size). Documents
stand in an order by size and then hash; the running sum of expected copies plus one random offset a source crosses
integers, and a document is emitted once for each integer that its step crosses. The order by size keeps the taken
words near the target. Ranks come from three levels of counts (size, hash bucket, row), so no task ever holds a whole
source, and reruns agree.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh

WEIGHTS = (1, 2, 3)
MOST = 3
#: Hash buckets among equal sizes; only the count of one bucket of one size is ranked in a task.
BUCKETS = 4096
WORD = r"[^\x20\x09-\x0D]+"


def words(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def _hash(*cols: Column, digits: int = 12) -> Column:
    """A whole number below 16 ** digits, the same in any engine that has md5."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *cols).cast("binary")), 1, digits), 16, 10).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """source, source_size, target for each source of (source, size) rows.

    Sources by code point, null last, weigh `weights`, repeating; targets share the total by weight, none above `most`
    times its source's size, and the excess goes to the others by weight. A source without words has target 0."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    per = per.withColumn("_w", F.element_at(F.array(*map(F.lit, weights)), ((place - 1) % len(weights) + 1).cast("int")).cast("long"))
    # Water level: filled sources come first by size over weight; the first level that the next source can take holds.
    by = Window.orderBy(F.col("source_size") / F.col("_w"), F.col("source").asc_nulls_last())
    before = by.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    total = F.sum("source_size").over(whole)
    filled = F.coalesce(F.sum("source_size").over(before), F.lit(0)) * most
    left = F.sum("_w").over(whole) - F.coalesce(F.sum("_w").over(before), F.lit(0))
    per = per.withColumn("_level", (total - filled).cast("double") / left.cast("double"))
    open_ = F.col("_level") * F.col("_w") <= F.col("source_size") * most
    per = per.withColumn("_mark", F.when(open_, F.col("_level")))
    level = F.max("_mark").over(whole)
    target = F.least(F.col("source_size").cast("double") * most, F.coalesce(level, F.lit(0.0)) * F.col("_w"))
    return per.select("source", "source_size", F.when(F.col("source_size") == 0, 0.0).otherwise(target).alias("target"))


def draw(docs: DataFrame, text: str = "text", seed: str = "mix", buckets: int = BUCKETS) -> DataFrame:
    """The input's rows with size, source_size, target and copies; clashing names of the input get leading underscores.

    Null and empty texts have size 0 and are drawn like others; a null source is a source of its own; rows that repeat
    an id (or have none) are told apart by nothing and share their draws in any order. An empty table gives no rows."""
    own = ["size", "source_size", "target", "copies", "_s", "_h", "_b", "_first", "_second", "_third"]
    keep = {c: fresh([*own, *(x for x in docs.columns if x != c)], c) if c.lower() in own else c for c in docs.columns}
    rows = docs.select(*(F.col(c).alias(n) for c, n in keep.items()))
    name = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("-"))
    rows = rows.select("*", words(text).alias("size"), name.alias("_s"), _hash(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias("_h"))
    rows = rows.withColumn("_b", F.col("_h") % buckets)
    narrow = docs.select("source", "doc_id", words(text).alias("size")).select("source", "size", name.alias("_s"), (_hash(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % buckets).alias("_b"))
    counts = narrow.groupBy("_s", "size", "_b").agg(F.count("*").alias("_n"), F.first("source").alias("source"))
    by_size = counts.groupBy("_s", "size").agg(F.sum("_n").alias("_m"), F.first("source").alias("source"))
    goal = targets(by_size.select("source", (F.col("size") * F.col("_m")).alias("size")))
    goal = goal.select("source_size", "target", name.alias("_s"))
    upto = lambda *keys: Window.partitionBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    by_size = by_size.select("_s", "size", F.coalesce(F.sum("_m").over(upto("_s").orderBy("size")), F.lit(0)).alias("_first")).join(goal, "_s")
    start = counts.select("_s", "size", "_b", F.coalesce(F.sum("_n").over(upto("_s", "size").orderBy("_b")), F.lit(0)).alias("_second"))
    start = start.join(by_size, ["_s", "size"])
    rank = F.row_number().over(Window.partitionBy("_s", "size", "_b").orderBy("_h", "doc_id"))
    at = F.col("_first") + F.col("_second") + F.col("_third")
    offset = _hash(F.lit(seed), F.lit("offset"), F.col("_s"), digits=8).cast("double") / float(16**8)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    crossed = lambda k: F.floor(k.cast("double") * rate + offset)
    out = rows.withColumn("_third", rank).join(start, ["_s", "size", "_b"])
    return out.select(*keep.values(), "size", "source_size", "target", (crossed(at) - crossed(at - 1)).cast("long").alias("copies"))


def mix(docs: DataFrame, text: str = "text", seed: str = "mix") -> DataFrame:
    """The mixed corpus: each row of the input as many times as it was drawn, with the input's columns."""
    extra = [c for c in docs.columns if c not in ("doc_id", "source", text)]
    packed = docs.select("doc_id", "source", text, F.struct(*extra, F.lit(0).alias("_")).alias("_extra"))
    drawn = draw(packed, text, seed).where(F.col("copies") > 0)
    repeated = drawn.withColumn("_i", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return repeated.select(*(F.col(f"_extra.{c}").alias(c) if c in extra else F.col(c) for c in docs.columns))
