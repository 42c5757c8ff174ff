"""Circulant MinHash near-deduplication.

Two permutations make every signature coordinate: the first scatters shingle hashes over a ring, the second is read at
the scattered place, shifted circularly by the coordinate's number. Coordinates are banded; rows of a band bucket are
linked to the bucket's first document, and later across components that still share a bucket; every link is confirmed by
the exact Jaccard similarity of the two whole shingle sets. Equal sets are one class from the start.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, fresh, lean, small_batches, utf8
from .components import components

WORDS = 5
BANDS, ROWS = 32, 5
RING = 1 << 20
#: Members, and shingles, of a block: two blocks are compared in memory.
BLOCK, SHINGLES = 128, 1 << 20
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = 0x9E3779B97F4A7C15
_SLICE = 1 << 20


def _mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _powers(n: int, base: int = _BASE) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


_POWER = _powers(1024)
_PLACE = _mix(np.arange(1, 65, dtype=np.uint64)) | np.uint64(1)


def _word_hashes(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of each word of a buffer that begins and ends with white space."""
    global _POWER
    solid = ~_SPACE[buf]
    edge = np.flatnonzero(solid[1:] != solid[:-1]) + 1
    start, length = edge[::2], edge[1::2] - edge[::2]
    if not len(start):
        return start, np.zeros(0, np.uint64)
    if int(length.max()) > len(_POWER):
        _POWER = _powers(2 * int(length.max()))
    first = np.concatenate([[0], np.cumsum(length)[:-1]])
    inside = np.arange(int(length.sum())) - np.repeat(first, length)
    value = (buf[solid].astype(np.uint64) + np.uint64(1)) * _POWER[inside]
    return start, _mix(np.add.reduceat(value, first) + length.astype(np.uint64))


def shingle_sets(texts: list[bytes], width: int = WORDS) -> Iterator[np.ndarray]:
    """The sorted distinct 64-bit hashes of each text's word shingles (A-Z lower-cased; empty without words)."""
    at = 0
    while at < len(texts):
        to, size = at, 0
        while to < len(texts) and (to == at or size + len(texts[to]) < _SLICE):
            size += len(texts[to]) + 1
            to += 1
        raw = b" " + b" ".join(texts[at:to]).lower() + b" "
        ends = np.cumsum([len(x) + 1 for x in texts[at:to]])
        if len(raw) > 4 * _SLICE:  # one very long text: its words are hashed slice by slice
            words, i = [], 0
            while i < len(raw) - 1:
                j = min(len(raw), i + _SLICE)
                while j < len(raw) and not _SPACE[raw[j - 1]]:
                    j += 1
                words.append(_word_hashes(np.frombuffer(b" " + raw[i:j] + b" ", np.uint8))[1])
                i = j
            word, bounds = np.concatenate(words), np.array([0, sum(map(len, words))])
        else:
            start, word = _word_hashes(np.frombuffer(raw, np.uint8))
            bounds = np.concatenate([[0], np.searchsorted(start, ends, "right")])
        if len(word) >= width:
            n = len(word) - width + 1
            summed = word[:n] * _PLACE[0]
            for j in range(1, width):
                summed += word[j:n + j] * _PLACE[j]
            summed = _mix(summed)
        for k in range(to - at):
            a, b = int(bounds[k]), int(bounds[k + 1])
            if b - a >= width:
                yield np.unique(summed[a:b - width + 1])
            elif b > a:
                yield _mix((word[a:b] * _PLACE[:b - a]).sum(keepdims=True, dtype=np.uint64) + np.uint64(b - a))
            else:
                yield np.zeros(0, np.uint64)
        at = to


class Circulant:
    """Signatures from two permutations of a ring; the second is shifted by a coordinate's number."""

    def __init__(self, bands: int = BANDS, rows: int = ROWS, seed: int = 7):
        self.bands, self.rows = bands, rows
        second = np.random.default_rng(seed).permutation(RING).astype(np.uint32)
        k = bands * rows
        ring = np.concatenate([second, second[:k]])
        self.shifted = np.lib.stride_tricks.as_strided(ring, (RING, k), (4, 4))
        self.scale = (_mix(np.arange(1, k + 1, dtype=np.uint64)) | np.uint64(1)).reshape(bands, rows)

    def band_keys(self, hashes: np.ndarray) -> np.ndarray:
        """One 64-bit key for each band of a non-empty set."""
        place = (_mix(hashes) >> np.uint64(44)).astype(np.int64)
        least = self.shifted[place[:2048]].min(axis=0)
        for i in range(2048, len(place), 2048):
            np.minimum(least, self.shifted[place[i:i + 2048]].min(axis=0), out=least)
        keys = (least.astype(np.uint64).reshape(self.bands, self.rows) * self.scale).sum(axis=1, dtype=np.uint64)
        return _mix(keys + np.arange(self.bands, dtype=np.uint64)).view(np.int64)


def _signatures(docs: DataFrame, text: str, bands: int, rows: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        circulant = Circulant(bands, rows)
        for batch in batches:
            n, low, high, keys = [], [], [], []
            for s in shingle_sets(batch.column(1).to_pylist()):
                d = np.frombuffer(hashlib.blake2b(s.tobytes(), digest_size=16).digest(), np.int64)
                n.append(len(s))
                low.append(int(d[0]))
                high.append(int(d[1]))
                keys.append(circulant.band_keys(s) if len(s) else np.zeros(0, np.int64))
            offsets = np.concatenate([[0], np.cumsum([len(k) for k in keys])]).astype(np.int32)
            flat = np.concatenate(keys) if keys else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(n, pa.int64()), pa.array(low, pa.int64()), pa.array(high, pa.int64()), pa.ListArray.from_arrays(offsets, pa.array(flat))], names=["doc_id", "key", "n_shingles", "d1", "d2", "bands"])

    return docs.select("doc_id", utf8(text).alias("t"), F.xxhash64("doc_id", text).alias("key")).mapInArrow(lean(run), "doc_id long, key long, n_shingles long, d1 long, d2 long, bands array<long>")


def _confirmed(pairs: DataFrame, docs: DataFrame, text: str, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets have 100 * intersection >= percent * union."""
    texts = docs.select("doc_id", utf8(text).alias("t"))
    both = pairs.join(texts.toDF("a", "p"), "a").join(texts.toDF("b", "q"), "b").select("a", "b", "p", "q")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = one = None
        for batch in batches:
            good = []
            for p, q in zip(batch.column(2), batch.column(3), strict=True):
                p, q = p.as_py(), q.as_py()
                if p != key:
                    key, one = p, next(shingle_sets([p]))
                two = next(shingle_sets([q]))
                shared = len(np.intersect1d(one, two, assume_unique=True))
                good.append(len(one) > 0 and 100 * shared >= percent * (len(one) + len(two) - shared))
            kept = batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))
            yield kept

    return both.mapInArrow(lean(run), "a long, b long")


def _groups(keyed: DataFrame) -> DataFrame:
    """hub, id, n: the members of each bucket under the bucket's hub, the member that shares buckets with most others.

    Members of one bucket share its hub, and a hub's buckets hold much the same members: far fewer rows than the buckets'."""
    shared = keyed.groupBy("k").agg(F.count("*").alias("m"), F.min("id").alias("first"), F.max("id").alias("last")).where("first < last").select("k", "m")
    held = cut(keyed.join(shared, "k").select("k", "m", "id", "n"))
    weights = held.groupBy("id").agg(F.sum("m").alias("w"))
    hubs = held.join(weights, "id").groupBy("k").agg(F.min(F.struct((-F.col("w")).alias("less"), "id")).alias("h"))
    return held.join(hubs.select("k", F.col("h.id").alias("hub")), "k").select("hub", "id", "n").distinct()


def _cells(members: DataFrame) -> DataFrame:
    """hub, i, j, block, id, root: each two members of a hub that have different roots meet in a cell of two blocks.

    members: hub, id, n, root. The members of a hub's most frequent root need not meet each other, so their blocks meet only
    those of the others. A block has about BLOCK members and SHINGLES shingles, so a cell fits in memory however large the
    group; a small group is one cell."""
    per = members.groupBy("hub", "root").agg(F.count("*").alias("c"), F.sum("n").alias("s"))
    per = per.groupBy("hub").agg(F.max(F.struct("c", "root", "s")).alias("top"), F.sum("c").alias("g"), F.sum("s").alias("s")).where(F.col("g") > F.col("top.c"))
    blocks = lambda c, s: F.greatest(F.lit(1), F.ceil(c / BLOCK), F.ceil(s / SHINGLES)).cast("int")
    one = (F.col("g") <= 2 * BLOCK) & (F.col("s") <= 2 * SHINGLES)
    per = per.select("hub", F.when(~one, F.col("top.root")).alias("top"), F.when(one, 1).otherwise(blocks(F.col("g") - F.col("top.c"), F.col("s") - F.col("top.s"))).alias("few"), F.when(one, 0).otherwise(blocks(F.col("top.c"), F.col("top.s"))).alias("many"))
    at = members.join(per, "hub").withColumn("bulk", F.coalesce(F.col("root") == F.col("top"), F.lit(False)))
    spot = lambda n: F.pmod(F.xxhash64("id"), n).cast("int")
    at = at.withColumn("block", F.when(F.col("bulk"), F.col("few") + spot(F.col("many"))).otherwise(spot(F.col("few"))))
    meets = F.sequence(F.lit(0), F.when(F.col("bulk"), F.col("few") - 1).otherwise(F.col("few") + F.col("many") - 1))
    at = at.select("hub", "id", "root", "block", F.explode(meets).alias("_o"))
    return at.select("hub", F.least("block", "_o").alias("i"), F.greatest("block", "_o").alias("j"), "block", "id", "root")


def cell_links(members: list[tuple[int, int, int, bytes]], percent: int) -> list[tuple[int, int]]:
    """Links that join all roots of a cell that whole sets join; members: block, id, root, text.

    In a cell of two blocks only members of different blocks are compared, as each block has a cell of its own."""
    sets = list(shingle_sets([m[3] for m in members]))
    full = [k for k, x in enumerate(sets) if len(x)]
    if len(full) < 2:
        return []
    block, ids, roots = (np.array([members[k][c] for k in full], np.int64) for c in range(3))
    n = np.array([len(sets[k]) for k in full])
    start = np.concatenate([[0], np.cumsum(n)[:-1]])
    codes = np.unique(np.concatenate([sets[k] for k in full]), return_inverse=True)[1]
    own = np.unique(roots, return_inverse=True)[1]
    two, out = block.min() != block.max(), []
    mark = np.zeros(int(codes.max()) + 1, np.uint8)
    for x in np.flatnonzero(own != np.bincount(own).argmax()):
        may = (own != own[x]) & (100 * np.minimum(n, n[x]) >= percent * np.maximum(n, n[x]))
        if two:
            may &= block != block[x]
        if not may.any():
            continue
        of = codes[start[x]:start[x] + n[x]]
        mark[of] = 1
        shared = np.add.reduceat(mark[codes], start, dtype=np.int64)
        mark[of] = 0
        for y in np.flatnonzero(may & (100 * shared >= percent * (n + n[x] - shared))):
            if own[x] != own[y]:
                out.append((int(min(ids[x], ids[y])), int(max(ids[x], ids[y]))))
                own[own == own[y]] = own[x]
    return out


def _cell_pass(cells: DataFrame, docs: DataFrame, text: str, percent: int) -> DataFrame:
    rows = cells.join(docs.select(F.col("doc_id").alias("id"), utf8(text).alias("t")), "id").select("hub", "i", "j", "block", "id", "root", "t")
    rows = rows.repartition("hub", "i", "j").sortWithinPartitions("hub", "i", "j")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, links = None, [], []
        for batch in batches:
            heads = zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True)
            for at, row in zip(heads, zip(*(batch.column(c).to_pylist() for c in range(3, 7)), strict=True), strict=True):
                if at != key:
                    links += cell_links(held, percent)
                    key, held = at, []
                held.append(row)
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)], names=["a", "b"])
            links = []
        links = cell_links(held, percent)
        yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)], names=["a", "b"])

    return rows.mapInArrow(lean(run), "a long, b long")


def _classified(docs: DataFrame, text: str, percent: int, bands: int, rows: int) -> DataFrame:
    """doc_id, key (of id and text), d1, d2 (of the set), n_shingles, component_id for every row."""
    small_batches(docs.sparkSession)
    seen = cut(_signatures(docs, text, bands, rows))
    full = seen.where(F.col("n_shingles") > 0)
    classes = full.groupBy("d1", "d2").agg(F.min("doc_id").alias("rep"))
    reps = full.join(classes.where(F.col("rep").isNotNull()), ["d1", "d2"]).where(F.col("doc_id") == F.col("rep"))
    groups = cut(_groups(reps.select(F.col("doc_id").alias("id"), F.col("n_shingles").alias("n"), F.explode("bands").alias("k"))))
    # Large groups first: most near copies of a hub become one component with one comparison each.
    large = groups.groupBy("hub").agg(F.count("*").alias("g"), F.min(F.when(F.col("id") == F.col("hub"), F.col("n"))).alias("n0")).where(F.col("g") > 2 * BLOCK)
    star = groups.join(large, "hub").where((F.col("id") != F.col("hub")) & (100 * F.least("n", "n0") >= percent * F.greatest("n", "n0"))).select(F.col("hub").alias("a"), F.col("id").alias("b")).distinct()
    links = cut(_confirmed(star, docs, text, percent))
    roots = cut(components(links))
    # Then all members of a group that are not yet one component, block by block.
    members = groups.join(roots.toDF("id", "root"), "id", "left").withColumn("root", F.coalesce("root", "id"))
    links = links.union(_cell_pass(_cells(members), docs, text, percent))
    roots = components(links)
    named = classes.join(roots.toDF("rep", "root"), "rep", "left").select("d1", "d2", F.coalesce("root", "rep").alias("component_id"))
    out = full.join(named, ["d1", "d2"]).select("doc_id", "key", "d1", "d2", "n_shingles", "component_id")
    return out.union(seen.where(F.col("n_shingles") == 0).select("doc_id", "key", "d1", "d2", "n_shingles", F.col("doc_id").alias("component_id")))


def near_duplicates(docs: DataFrame, text: str = "text", percent: int = 80, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row.

    Null and empty texts, and texts without words, have an empty set and are linked with nothing; fewer than WORDS words
    count as one shingle. Rows that repeat an id are linked through it; a row without id keeps a null component unless
    its set equals that of a row with one. An empty table gives no rows; other columns are ignored."""
    out = _classified(docs, text, percent, bands, rows).select("doc_id", "n_shingles", "component_id")
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def keep_one(docs: DataFrame, text: str = "text", percent: int = 80) -> DataFrame:
    """The input's rows without those of a near-duplicate group beside one of its smallest id; columns as they are.

    Rows without words are near nothing and all stay. Of rows that share the smallest id of a group, one stays for each
    set of shingles; so does one of the rows without id where no row with an id has their set. Which of several rows of
    one id and text that is, is not defined where they differ in other columns. An empty table gives no rows."""
    found = _classified(docs, text, percent, BANDS, ROWS)
    own = found.where((F.col("n_shingles") > 0) & F.col("doc_id").eqNullSafe(F.col("component_id")))
    own = own.groupBy("component_id", "d1", "d2", "key").agg(F.count("*").alias("m")).groupBy("component_id", "d1", "d2").agg(F.min(F.struct("key", "m")).alias("one"))
    at, who, copies, same = (fresh(docs.columns, x) for x in ("_at", "_who", "_copies", "_same"))
    stay = own.select(F.col("one.key").alias(at), F.col("component_id").alias(who), F.col("one.m").alias(copies))
    stay = stay.union(found.where(F.col("n_shingles") == 0).select("key", "doc_id", F.lit(1).cast("long")).distinct())
    rows = docs.withColumn(same, F.xxhash64("doc_id", text)).join(stay, (F.col(same) == F.col(at)) & F.col("doc_id").eqNullSafe(F.col(who)))
    return rows.where(F.col(copies) == 1).unionByName(rows.where(F.col(copies) > 1).dropDuplicates([at, who])).select(*docs.columns)
