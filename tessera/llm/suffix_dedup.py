"""Removal of repeated passages by a hash-compared suffix sort.

A passage is a string of LENGTH bytes that starts at two places of the corpus. Its least K-byte fingerprint (the anchor)
is the same wherever it stands, so only starts under a repeated anchor can repeat; the rest never leave their document.
For each anchor the distinct windows of its starts are brought together, and the suffixes at the starts are sorted: prefix
polynomial hashes and binary search give two suffixes' common extension, a mergesort needs only logarithmically many
hash comparisons for each suffix comparison, and neighbours that agree over LENGTH bytes are verified byte by byte.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Tables, lean, small_batches, utf8

LENGTH, K = 200, 32
#: Distinct windows of an anchor that are sorted in one task; the starts of an anchor with more are counted one by one.
SORTED = 20_000
_SLICE = 1 << 16
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(n: int, base: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


class Hashes:
    """Prefix polynomial hashes of a buffer: the hash of any stretch takes one subtraction and one product."""

    _up, _down = _powers(1 << 12, _BASE), _powers(1 << 12, _INVERSE)

    def __init__(self, buf: np.ndarray):
        n = len(buf)
        if n >= len(Hashes._up):
            Hashes._up, Hashes._down = _powers(2 * n + 2, _BASE), _powers(2 * n + 2, _INVERSE)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * Hashes._up[:n], out=self.sums[1:])

    def at(self, start: np.ndarray, size) -> np.ndarray:
        return (self.sums[start + size] - self.sums[start]) * Hashes._down[start]


_ODD = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5))


def fingerprints(raw: bytes) -> np.ndarray:
    """A 64-bit fingerprint of each stretch of K bytes; four overlapping words of eight bytes make one."""
    n = len(raw) - K + 1
    words = np.ndarray((len(raw) - 7,), "<u8", raw, strides=(1,)).copy()
    pair = words[:-8] * _ODD[0]
    pair += words[8:] * _ODD[1]
    h = pair[:n] * _ODD[2]
    h += pair[16: 16 + n] ^ (pair[16: 16 + n] >> np.uint64(31))
    h ^= h >> np.uint64(29)
    h *= _ODD[3]
    h ^= h >> np.uint64(32)
    return h


def _anchored(raw: bytes, valid: np.ndarray) -> tuple[np.ndarray, ...]:
    """Hash, place, first and last start of the runs of valid starts whose least fingerprint is the same one.

    Of equal fingerprints in a stretch the leftmost counts, so equal stretches make the same choice."""
    h = fingerprints(raw)
    high = (h >> np.uint64(32)).astype(np.uint32)
    width, least, have = LENGTH - K + 1, high, 1
    while 2 * have <= width:
        least = np.minimum(least[:-have], least[have:])
        have *= 2
    if have < width:
        least = np.minimum(least[: len(least) - (width - have)], least[width - have:])
    new = valid.copy()
    new[1:] &= ~valid[:-1] | (least[1:] != least[:-1])
    first = np.flatnonzero(new)
    ends = np.flatnonzero(valid & np.append(~valid[1:] | new[1:], True))
    done, span = [], np.arange(width)
    while len(first):
        place = first + high[first[:, None] + span].argmin(1)
        last = np.minimum(ends, place)  # the place falls out before the value does: the run goes on with the next one
        done.append((h[place], place, first, last))
        more = ends > last
        first, ends = last[more] + 1, ends[more]
    return tuple(np.concatenate(x) for x in zip(*done, strict=True)) if done else (np.zeros(0, np.uint64), *(np.zeros(0, np.int64),) * 3)


def anchors_of(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """Which text, hash, place, first and last start of each run of starts; texts are laid end to end in short buffers."""
    parts: list[tuple] = []
    held: list[tuple[int, int, bytes]] = []

    def flush():
        raw = b"".join(x for _, _, x in held)
        begin = np.cumsum([0] + [len(x) for _, _, x in held])
        valid = np.zeros(len(raw) - LENGTH + 1, bool)
        for b, (_, _, x) in zip(begin.tolist(), held, strict=False):
            valid[b: b + len(x) - LENGTH + 1] = True
        h, place, first, last = _anchored(raw, valid)
        which = np.searchsorted(begin, first, "right") - 1
        shift = np.array([at for _, at, _ in held])[which] - begin[which]
        parts.append((np.array([i for i, _, _ in held])[which], h, place + shift, first + shift, last + shift))
        held.clear()

    size = 0
    for i, t in enumerate(texts):
        for at in range(0, len(t) - LENGTH + 1, _SLICE):
            held.append((i, at, t if len(t) <= _SLICE else t[at: at + _SLICE + LENGTH - 1]))
            size += len(held[-1][2])
            if size >= _SLICE:
                flush()
                size = 0
    if held:
        flush()
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True)) if parts else (np.zeros(0, np.int64), np.zeros(0, np.uint64), *(np.zeros(0, np.int64),) * 3)


def _common(hashes: Hashes, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common extension of suffixes a and b, LENGTH at most, by binary search over hashes."""
    out = np.full(len(a), LENGTH)
    left = np.flatnonzero(hashes.at(a, LENGTH) != hashes.at(b, LENGTH))
    low, high = np.zeros(len(left), np.int64), np.full(len(left), LENGTH - 1)
    a, b = a[left], b[left]
    while (low < high).any():
        mid = (low + high + 1) >> 1
        same = hashes.at(a, mid) == hashes.at(b, mid)
        low, high = np.where(same, mid, low), np.where(same, high, mid - 1)
    out[left] = low
    return out


def sort_suffixes(buf: np.ndarray, hashes: Hashes, start: np.ndarray, segment: np.ndarray) -> np.ndarray:
    """An order of the starts, which are grouped by segment, that sorts the suffixes of each segment by LENGTH bytes.

    A bottom-up mergesort of all segments at once: each suffix finds its rank in the neighbouring run by binary search."""
    n = len(start)
    first = np.flatnonzero(np.concatenate([[True], segment[1:] != segment[:-1]]))
    sizes = np.diff(np.append(first, n))
    base, end = np.repeat(first, sizes), np.repeat(first + sizes, sizes)
    order, inside = np.arange(n), np.arange(n) - base
    width = 1

    def before(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """-1, 0 or 1 as suffix x sorts before, with or after y."""
        same = _common(hashes, x, y)
        at = np.minimum(same, LENGTH - 1)
        return np.where(same == LENGTH, 0, np.sign(buf[x + at].astype(np.int16) - buf[y + at]))

    while width < (sizes.max() if n else 0):
        work = np.flatnonzero(end - base > width)
        k = inside[work]
        block = k // (2 * width) * (2 * width)
        right = k - block >= width
        low = np.where(right, base[work] + block, np.minimum(base[work] + block + width, end[work]))
        high = np.where(right, low + width, np.minimum(base[work] + block + 2 * width, end[work]))
        begin, mine = low.copy(), start[order[work]]
        while (open_ := low < high).any():
            o = np.flatnonzero(open_)
            mid = (low[o] + high[o]) >> 1
            sign = before(start[order[mid]], mine[o])
            up = (sign < 0) | ((sign == 0) & right[o])
            low[o], high[o] = np.where(up, mid + 1, low[o]), np.where(up, high[o], mid)
        own = np.where(right, k - block - width, k - block)
        to = base[work] + block + own + (low - begin)
        merged = order.copy()
        merged[to] = order[work]
        order = merged
        width *= 2
    return order


def _may_repeat(codes: np.ndarray) -> np.ndarray:
    """Places of the codes that occur more than once. Equal strings have equal codes: a start with a code of its own cannot
    repeat and need not be sorted, and the others mostly agree over LENGTH bytes, which takes one comparison to see."""
    by = np.argsort(codes)
    same = codes[by[1:]] == codes[by[:-1]]
    more = np.zeros(len(codes), bool)
    more[by[1:][same]] = True
    more[by[:-1][same]] = True
    return np.flatnonzero(more)


def repeated_starts(windows: list[bytes], counts: list[int], offsets: list[int], groups: list[int]) -> list[np.ndarray]:
    """Which starts of each window repeat. offsets: the anchor's place in the window; groups: its anchor, in runs.

    A window that occurs twice repeats whole; the rest is decided by the suffix sort within an anchor and offset."""
    sizes = np.array([len(w) - LENGTH + 1 for w in windows])
    out = [np.full(n, c > 1) for n, c in zip(sizes, counts, strict=True)]
    group = np.array(groups)
    alone = np.bincount(np.unique(group, return_inverse=True)[1])[np.unique(group, return_inverse=True)[1]] == 1
    some = np.flatnonzero(~alone)
    if not len(some):
        return out
    buf = np.frombuffer(b"".join(windows[i] for i in some), np.uint8)
    at = np.concatenate([[0], np.cumsum([len(windows[i]) for i in some])])[:-1]
    n = sizes[some]
    which = np.repeat(np.arange(len(some)), n)
    inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    key = np.repeat(np.unique(group[some], return_inverse=True)[1], n).astype(np.int64) * 1024 + (np.repeat(np.array(offsets)[some], n) - inner + 512)
    start, hashes = at[which] + inner, Hashes(buf)
    may = _may_repeat(hashes.at(start, LENGTH) + key.astype(np.uint64) * _ODD[1])
    by = may[np.argsort(key[may], kind="stable")]
    start, key, which, inner = start[by], key[by], which[by], inner[by]
    order = sort_suffixes(buf, hashes, start, key)
    s = start[order]
    next_same = np.flatnonzero((key[1:] == key[:-1]) & (_common(hashes, s[:-1], s[1:]) == LENGTH))
    if len(next_same):  # verify byte by byte
        a, b = s[next_same], s[next_same + 1]
        equal = np.ones(len(a), bool)
        step = max(1, (1 << 22) // LENGTH)
        span = np.arange(LENGTH)
        for i in range(0, len(a), step):
            equal[i:i + step] = (buf[a[i:i + step, None] + span] == buf[b[i:i + step, None] + span]).all(1)
        if not equal.all():  # two stretches share a hash: exact comparison of these groups
            seen: dict = {}
            for i in range(len(start)):
                seen.setdefault((int(key[i]), bytes(buf[start[i]: start[i] + LENGTH])), []).append(i)
            hit = np.array([i for v in seen.values() if len(v) > 1 for i in v], np.int64)
        else:
            hit = np.concatenate([order[next_same], order[next_same + 1]])
        flat = np.zeros(n.sum(), bool)
        first = np.cumsum(n) - n
        flat[first[which[hit]] + inner[hit]] = True
        for i, b, m in zip(some.tolist(), first.tolist(), n.tolist(), strict=True):
            out[i] |= flat[b: b + m]
    return out


_KEYED = "doc_id long, k1 long, k2 long"


def _key(x: bytes) -> tuple[int, int]:
    d = hashlib.blake2b(x, digest_size=16).digest()
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


def _texts(docs: DataFrame, text: str) -> DataFrame:
    """k1, k2, t: each distinct text that is long enough, once for a task at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set = set()
        for batch in batches:
            keys = [_key(x) for x in batch.column(0).to_pylist()]
            new = [not (k in seen or seen.add(k)) for k in keys]
            kept = [k for k, n in zip(keys, new, strict=True) if n]
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in kept], pa.int64()), pa.array([k[1] for k in kept], pa.int64()), batch.column(0).filter(pa.array(new, pa.bool_()))], names=["k1", "k2", "t"])

    return docs.select(utf8(text).alias("t")).where(F.length("t") >= LENGTH).mapInArrow(lean(run), "k1 long, k2 long, t binary")


def _keys(docs: DataFrame, text: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            keys = [_key(x) for x in texts]
            cols = [pa.array([k[0] for k in keys], pa.int64()), pa.array([k[1] for k in keys], pa.int64()), pa.array([len(x) for x in texts], pa.int64()), pa.array([hashlib.sha256(x).hexdigest() for x in texts], pa.string())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *cols], names=["doc_id", "k1", "k2", "n_bytes", "sha"])

    return docs.select("doc_id", utf8(text).alias("t")).mapInArrow(lean(run), _KEYED + ", n_bytes long, sha string")


def _anchor_rows(docs: DataFrame, text: str) -> DataFrame:
    """h, k1, q for each anchor of each distinct text, once for a task; q packs place, place - first start, last - first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set = set()
        for batch in batches:
            keys, texts = [], []
            for x in batch.column(0).to_pylist():
                k = _key(x)
                if k not in seen:
                    seen.add(k)
                    keys.append(k[0])
                    texts.append(x)
            which, h, place, first, last = anchors_of(texts)
            q = place << 16 | (place - first) << 8 | (last - first)
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(np.array(keys, np.int64)[which]), pa.array(q.astype(np.int64))], names=["h", "k1", "q"])

    return docs.select(utf8(text).alias("t")).where(F.length("t") >= LENGTH).mapInArrow(lean(run), "h long, k1 long, q long")


def _window_rows(held: DataFrame) -> DataFrame:
    """h, w, k1, k2, q, n, d, crowded, bytes for each anchor of `qs`; the window's bytes and its count only once in a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: set = set()
        for batch in batches:
            cols = [[] for _ in range(9)]
            first: dict = {}
            for k1, k2, text, pairs in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                if (k1, k2) in done:
                    continue
                done.add((k1, k2))
                for p in pairs:
                    h, q = p["h"], p["q"]
                    place, d, size = q >> 16, q >> 8 & 255, q & 255
                    window = text[place - d: place - d + size + LENGTH]
                    w = int.from_bytes(hashlib.blake2b(window, digest_size=8, salt=bytes((d,))).digest(), "little", signed=True)
                    i = first.get((h, w))
                    if i is None:
                        first[h, w] = len(cols[0])
                    else:
                        cols[5][i] += 1
                    for c, v in zip(cols, (h, w, k1, k2, q, 1 if i is None else 0, d, p["crowded"], window if i is None else None), strict=True):
                        c.append(v)
            types = (pa.int64(),) * 7 + (pa.bool_(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=["h", "w", "k1", "k2", "q", "n", "d", "crowded", "bytes"])

    return held.mapInArrow(lean(run), "h long, w long, k1 long, k2 long, q long, n long, d long, crowded boolean, bytes binary")


def _decided(carriers: DataFrame) -> DataFrame:
    """h, w, mask (a byte for each start, 1 where it repeats) of the windows with repeated starts. Rows come sorted by h."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        last = None

        def flush():
            keys = list(held)
            got = repeated_starts([held[k][2] for k in keys], [held[k][0] for k in keys], [held[k][1] for k in keys], [k[0] for k in keys]) if keys else []
            rows = [(h, w, m.astype(np.uint8).tobytes()) for (h, w), m in zip(keys, got, strict=True) if m.any()]
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.binary())], names=["h", "w", "mask"])

        for batch in batches:
            for h, w, n, d, window in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if h != last and len(held) >= 4096:
                    yield flush()
                last = h
                if (h, w) in held:
                    held[h, w][0] += n
                else:
                    held[h, w] = [n, d, window]
        yield flush()

    return carriers.select("h", "w", "n", "d", "bytes").mapInArrow(lean(run), "h long, w long, mask binary")


def _counted(carriers: DataFrame) -> DataFrame:
    """As _decided, for anchors with very many windows: every start's 128-bit digest is counted, sums first in each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for h, w, n, window in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                keys = [_key(window[i: i + LENGTH]) for i in range(len(window) - LENGTH + 1)]
                m = len(keys)
                yield pa.RecordBatch.from_arrays([pa.array([h] * m, pa.int64()), pa.array([w] * m, pa.int64()), pa.array(range(m), pa.int32()), pa.array([n] * m, pa.int64()), pa.array([k[0] for k in keys], pa.int64()), pa.array([k[1] for k in keys], pa.int64())], names=["h", "w", "i", "n", "a", "b"])

    starts = carriers.groupBy("h", "w").agg(F.sum("n").alias("n"), F.first("bytes").alias("bytes")).select("h", "w", "n", "bytes").mapInArrow(lean(run), "h long, w long, i int, n long, a long, b long")
    many = starts.groupBy("a", "b").agg(F.sum("n").alias("m")).where("m > 1")
    hit = starts.join(many, ["a", "b"]).groupBy("h", "w").agg(F.collect_set("i").alias("hits"), F.max("i").alias("top"))
    mask = F.array_join(F.transform(F.sequence(F.lit(0), F.col("top")), lambda i: F.when(F.array_contains("hits", i), "01").otherwise("00")), "")
    return hit.select("h", "w", F.unhex(mask).alias("mask"))


def _removed(held: DataFrame) -> DataFrame:
    """k1, k2, n_removed, n_spans, kept_sha256 from a text and its (q, mask) pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            # All masks of the batch at once: to each start that repeats its text and its place in it.
            pairs = batch.column(3).flatten()
            q, masks = (pairs.field(c) for c in ("q", "mask"))
            q, sizes = q.to_numpy(), pc.binary_length(masks).to_numpy()
            hit = np.flatnonzero(np.frombuffer(b"".join(masks.to_pylist()), np.uint8))
            ends = np.cumsum(sizes)
            pair = np.searchsorted(ends, hit, "right")
            place = hit - (ends - sizes)[pair] + ((q >> 16) - (q >> 8 & 255))[pair]
            bounds = np.searchsorted(pair, np.concatenate([[0], np.cumsum(pc.list_value_length(batch.column(3)).to_numpy())]))
            for i, (k1, k2, text) in enumerate(zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True)):
                own = place[bounds[i]: bounds[i + 1]]
                begins = np.bincount(own, minlength=len(text) + 1) - np.bincount(own + LENGTH, minlength=len(text) + 1)
                gone = np.cumsum(begins[:-1]) > 0
                spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                rest = np.frombuffer(text, np.uint8)[~gone].tobytes()
                rows.append((k1, k2, int(gone.sum()), spans, hashlib.sha256(rest).hexdigest()))
            cols = list(zip(*rows, strict=True)) or [[]] * 5
            types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, types, strict=True)], names=["k1", "k2", "n_removed", "n_spans", "kept_sha256"])

    return held.mapInArrow(lean(run), "k1 long, k2 long, n_removed long, n_spans long, kept_sha256 string")


def repeated_passages(docs: DataFrame, text: str = "text", sorted_at_once: int = SORTED) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 for every row.

    Texts are UTF-8 bytes; null counts as empty; matches never cross rows. A row whose whole text of LENGTH bytes or
    more stands in another row loses all of it. Rows may repeat an id or have none; an empty table gives no rows; other
    columns are ignored."""
    small_batches(docs.sparkSession)
    written = Tables(docs.sparkSession, "passages").written
    # First the anchors that stand at two places, by document: narrow rows, no text moves.
    found = _anchor_rows(docs, text).repartition("h")
    place = F.xxhash64("k1", "q")
    repeated = found.groupBy("h").agg(F.min(place).alias("z1"), F.max(place).alias("z2"), F.count("*").alias("m")).where("z1 <> z2").select("h", (F.col("m") > sorted_at_once).alias("crowded"))
    wanted = written(found.join(repeated, "h").groupBy("k1").agg(F.collect_set(F.struct("h", "q", "crowded")).alias("qs")))
    crowded = not wanted.where(F.exists("qs", lambda x: x["crowded"])).isEmpty()
    # Then the windows of those, with their bytes once in a batch: sorted under their anchor, or counted start by start.
    texts = _texts(docs, text).repartition("k1")
    # Written once: the sort, the counts and the way back all read them.
    windows = written(_window_rows(texts.join(wanted, "k1").select("k1", "k2", "t", "qs")))
    carriers = windows.where(F.col("bytes").isNotNull())
    masks = _decided(carriers.where(~F.col("crowded")).repartition("h").sortWithinPartitions("h"))
    if crowded:
        masks = masks.unionByName(_counted(carriers.where("crowded")))
    masks = written(masks)
    hits = windows.select("h", "w", "k1", "k2", "q").join(masks, ["h", "w"]).groupBy("k1", "k2").agg(F.collect_list(F.struct("q", "mask")).alias("hits"))
    gone = _removed(texts.join(hits.withColumnRenamed("k2", "key2"), "k1").where("k2 = key2").select("k1", "k2", "t", "hits")).dropDuplicates(["k1", "k2"])
    rows = _keys(docs, text)
    copies = rows.groupBy("k1", "k2").agg(F.count("*").alias("copies"))
    out = rows.join(copies, ["k1", "k2"]).join(gone, ["k1", "k2"], "left")
    whole = (F.col("copies") > 1) & (F.col("n_bytes") >= LENGTH)
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    return out.select(
        "doc_id",
        "n_bytes",
        F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(whole, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(whole, nothing).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
    )
