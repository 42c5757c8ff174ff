"""Tab-separated sources and sinks: explicit schemas, header and arity checks, ids that must carry their prefix."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

RECORD = ("entity_id", "business_name", "business_address", "country")
TRUTH = ("source1_entity_id", "matched_entity_ids")
RESULT = TRUTH
CANDIDATES = ("source1_entity_id", "candidate_entity_ids")


class DataFormatError(ValueError):
    """An input does not have the form that the engine expects."""


def read_tsv(spark: SparkSession, path: str, columns: tuple[str, ...], multiline: bool = False) -> DataFrame:
    """Rows as strings, missing cells empty; raises on an empty file, a header or cells with commas for tabs, or another
    header in any file; fails the query on another arity or bytes that are no UTF-8.

    Without multiline, files are read in splits, and a quoted line break fails the query, as its row is short of cells;
    with multiline it belongs to its cell, and each file is one task."""
    head = spark.read.text(path).limit(1).collect()
    if not head:
        raise DataFormatError(f"{path} is empty")
    if "\t" not in head[0][0] and "," in head[0][0]:
        raise DataFormatError(f"{path}: commas where tabs are expected")
    if tuple(x.strip().lower() for x in head[0][0].split("\t")) != columns:
        raise DataFormatError(f"{path}: the header must be {columns}")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    rows = spark.read.csv(path, schema=schema, sep="\t", header=True, enforceSchema=False, quote='"', escape='"', multiLine=multiline, mode="FAILFAST").na.fill("")
    # The parser puts U+FFFD for bytes that are no UTF-8.
    return rows.withColumn(columns[0], F.when(F.concat(*columns).contains("\ufffd"), F.raise_error(F.lit(f"{path}: a row is not UTF-8"))).otherwise(F.col(columns[0])))


def read_records(spark: SparkSession, path: str, source: int | None = None, multiline: bool = False) -> DataFrame:
    """Records; an id without its prefix fails the query."""
    want = f"^S{source or '[123]'}-"
    rows = read_tsv(spark, path, RECORD, multiline)
    ok = F.when(F.col("entity_id").rlike(want), F.col("entity_id")).otherwise(F.raise_error(F.concat(F.lit("bad id: "), "entity_id")))
    return rows.withColumn("entity_id", ok)


def id_list(c):
    """Ids of a comma list, stripped, without blanks and repeats, in order."""
    return F.array_distinct(F.filter(F.transform(F.split(c, ","), lambda x: F.trim(x)), lambda x: x != ""))


def read_links(spark: SparkSession, path: str, columns: tuple[str, ...] = TRUTH) -> DataFrame:
    """(s1, ids) of a ground truth, result or candidate file."""
    return read_tsv(spark, path, columns).select(F.col(columns[0]).alias("s1"), id_list(F.col(columns[1])).alias("ids"))


def read_truth(spark: SparkSession, path: str) -> DataFrame:
    """(s1, ids) of a ground truth; a row whose ids name a record of source 1 fails the query."""
    rows = read_links(spark, path)
    own = F.exists("ids", lambda x: x.startswith("S1-"))
    return rows.withColumn("ids", F.when(own, F.raise_error(F.concat(F.lit("an id of source 1 among the links of "), "s1"))).otherwise(F.col("ids")))


def single_rows(rows: DataFrame) -> DataFrame:
    """(s1, ids) with one row for an s1; a second one fails the query."""
    once = rows.groupBy("s1").agg(F.count("*").alias("_n"), F.first("ids").alias("ids"))
    return once.select(F.when(F.col("_n") > 1, F.raise_error(F.concat(F.lit("more than one row for "), "s1"))).otherwise(F.col("s1")).alias("s1"), "ids")


def read_output(spark: SparkSession, path: str, columns: tuple[str, ...] = RESULT) -> DataFrame:
    """(s1, ids) of an output of this engine; a repeated s1 fails the query."""
    return single_rows(read_links(spark, path, columns))


def source_path(root: str, split: str, source: int) -> str:
    """The file of a source in a data folder."""
    if split not in ("train", "test") or source not in (1, 2, 3):
        raise ValueError("split must be train or test, source 1, 2 or 3")
    return f"{root.rstrip('/')}/{split}/{split}_source{source}.tsv"


def truth_path(root: str) -> str:
    return f"{root.rstrip('/')}/train/train_ground_truth.tsv"


def with_order(df: DataFrame) -> DataFrame:
    """Adds _ord, the row's number in the order of files, blocks and rows.

    The blocks of the files (or the partitions, where rows come from elsewhere) are counted first, one narrow row each; a
    row's number is its block's offset and its place in the block."""
    files = bool(df.inputFiles())
    block = [F.col("_metadata.file_path").alias("_f"), F.col("_metadata.file_block_start").alias("_b")] if files else [F.lit("").alias("_f"), F.spark_partition_id().cast("long").alias("_b")]
    rows = df.select("*", *block, F.monotonically_increasing_id().alias("_i"))
    blocks = rows.groupBy("_f", "_b").agg(F.min("_i").alias("_first"), F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_f", "_b").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n")
    return rows.join(blocks.select("_f", "_b", (before - F.col("_first")).alias("_shift")), ["_f", "_b"]).select(*df.columns, (F.col("_i") + F.col("_shift")).alias("_ord"))


def in_country(df: DataFrame, country: str | None) -> DataFrame:
    """The records of a country; all of them without one."""
    return df if country is None else df.where(F.lower(F.trim("country")) == country.strip().lower())


def countries(df: DataFrame) -> list[str]:
    """The distinct countries of records, sorted: the partitions of a run."""
    return [r[0] for r in df.select(F.lower(F.trim("country")).alias("c")).distinct().orderBy("c").collect()]


def first_ids(ordered: DataFrame, n: int | None, country: str | None = None) -> DataFrame:
    """The ids of the first n records, of a country where one is given; ordered: with _ord."""
    rows = in_country(ordered, country)
    return (rows if n is None else rows.orderBy("_ord").limit(n)).select("entity_id")


def in_range(df: DataFrame, start: int = 0, stop: int | None = None) -> DataFrame:
    """The rows [start, stop) in file order."""
    return df.where((F.col("_ord") >= start) & (F.lit(True) if stop is None else F.col("_ord") < stop))


def in_shard(df: DataFrame, index: int, count: int) -> DataFrame:
    if not 0 <= index < count:
        raise ValueError("shard index out of range")
    return df.where(F.crc32(F.col("entity_id").cast("binary")) % count == index)


def id_lists(edges: DataFrame, spine: DataFrame, by_rank: bool = False) -> DataFrame:
    """(s1, ids) for every s1 of the spine; ids ascending, or in rank order."""
    ids = F.array_distinct(F.transform(F.array_sort(F.collect_list(F.struct("rank", "t"))), lambda x: x["t"])) if by_rank else F.array_sort(F.collect_set("t"))
    return spine.select("s1").distinct().join(edges.groupBy("s1").agg(ids.alias("ids")), "s1", "left").withColumn("ids", F.coalesce("ids", F.array().cast("array<string>")))


def write_links(lists: DataFrame, path: str, columns: tuple[str, ...] = RESULT) -> None:
    """A folder of tab-separated files with header; the committer publishes whole files only."""
    lists.select(F.col("s1").alias(columns[0]), F.array_join("ids", ",").alias(columns[1])).write.mode("overwrite").csv(path, sep="\t", header=True, emptyValue="", quote="")


def write_one_file(lists: DataFrame, order: DataFrame, path: str, columns: tuple[str, ...] = RESULT) -> None:
    """One tab-separated file in the order of `order` (s1, _ord): sorted parts are written apart, joined in a file beside
    the target, and that is renamed, so that no reader sees a part of it."""
    spark, work = lists.sparkSession, f"{path}.parts"
    rows = order.select("s1", "_ord").join(lists, "s1", "left").orderBy("_ord")
    cells = F.concat_ws("\t", "s1", F.coalesce(F.array_join("ids", ","), F.lit("")))
    rows.select(cells.alias("value")).write.mode("overwrite").text(work)
    j = spark._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    at = j.org.apache.hadoop.fs.Path
    fs = at(path).getFileSystem(conf)
    parts = sorted(str(x.getPath()) for x in fs.globStatus(at(f"{work}/part-*")) or [])
    out = fs.create(at(f"{path}.tmp"), True)
    try:
        out.write(bytearray(("\t".join(columns) + "\n").encode()))
        for part in parts:
            with_part = fs.open(at(part))
            try:
                j.org.apache.hadoop.io.IOUtils.copyBytes(with_part, out, 1 << 20, False)
            finally:
                with_part.close()
    finally:
        out.close()
    fs.delete(at(path), False)
    if not fs.rename(at(f"{path}.tmp"), at(path)):
        raise OSError(f"{path} could not be published")
    fs.delete(at(work), True)
