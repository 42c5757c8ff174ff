"""TIFF media columns: image directories are walked, PackBits, LZW or deflate strips and tiles decoded, predictors undone.

`read_pages` is the general reader (both byte orders, multi-page, strips or tiles, 8 and 16 bits a sample, planar
samples interleaved); `write_pages` stores 8-bit samples for the lossless round trip.
"""
from __future__ import annotations

import hashlib
import math
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh, small_batches, utf8

#: Fixed values of the TIFF 6.0 format: tags, field sizes and compression schemes.
WIDTH, HEIGHT, BITS, SCHEME, PHOTOMETRIC, STRIPS, SAMPLES, ROWS, STRIP_BYTES, PLANAR, PREDICTOR = 256, 257, 258, 259, 262, 273, 277, 278, 279, 284, 317
TILE_WIDTH, TILE_HEIGHT, TILES, TILE_BYTES = 322, 323, 324, 325
FIELD = {1: "B", 2: "c", 3: "H", 4: "I", 6: "b", 8: "h", 9: "i"}
NONE, LZW, DEFLATE, OLD_DEFLATE, PACKBITS = 1, 5, 8, 32946, 32773
#: Rows of 64 samples in a page and in a strip of the stored form.
ROW, PAGE_ROWS, STRIP_ROWS = 64, 16384, 1024


def unpack_bits(data: bytes) -> bytes:
    out, i = bytearray(), 0
    while i < len(data):
        n = data[i]
        i += 1
        if n < 128:
            out += data[i:i + n + 1]
            i += n + 1
        elif n > 128:
            out += data[i:i + 1] * (257 - n)
            i += 1
    return bytes(out)


def pack_bits(data: bytes) -> bytes:
    out, i, n = bytearray(), 0, len(data)
    while i < n:
        j = i + 1
        while j < n and j - i < 128 and data[j] == data[i]:
            j += 1
        if j - i > 1:
            out += bytes((257 - (j - i), data[i]))
        else:
            while j < n and j - i < 128 and (j + 1 >= n or data[j] != data[j + 1]):
                j += 1
            out += bytes((j - i - 1,)) + data[i:j]
        i = j
    return bytes(out)


def unpack_lzw(data: bytes) -> bytes:
    """Most significant bit first, 9 to 12 bits a code, widened one code early; 256 clears, 257 ends."""
    out, table, width, have, bits, last = bytearray(), [bytes((i,)) for i in range(256)] + [b"", b""], 9, 0, 0, b""
    for byte in data:
        bits, have = (bits << 8 | byte) & 0xFFFFFF, have + 8
        if have < width:
            continue
        have -= width
        code = bits >> have & (1 << width) - 1
        if code == 257:
            break
        if code == 256:
            del table[258:]
            width, last = 9, b""
            continue
        if code < len(table):
            word = table[code]
        elif last and code == len(table):
            word = last + last[:1]
        else:
            raise ValueError("broken LZW code")
        out += word
        if last:
            table.append(last + word[:1])
            if len(table) + 1 >= 1 << width and width < 12:
                width += 1
        last = word
    return bytes(out)


def pack_lzw(data: bytes) -> bytes:
    codes, table, width, word = [(256, 9)], {bytes((i,)): i for i in range(256)}, 9, b""
    size = 258
    for i in range(len(data)):
        more = word + data[i:i + 1]
        if more in table:
            word = more
            continue
        codes.append((table[word], width))
        table[more] = size
        size += 1
        if size >= 1 << width:
            width += 1
        if size >= 4094:
            codes.append((256, min(width, 12)))
            table, width, size = {bytes((j,)): j for j in range(256)}, 9, 258
        word = data[i:i + 1]
    if word:
        codes.append((table[word], width))
        if size + 1 >= 1 << width and width < 12:
            width += 1
    codes.append((257, width))
    out, bits, have = bytearray(), 0, 0
    for code, n in codes:
        bits, have = bits << n | code, have + n
        while have >= 8:
            have -= 8
            out.append(bits >> have & 255)
        bits &= (1 << have) - 1
    if have:
        out.append(bits << (8 - have) & 255)
    return bytes(out)


def _decoded(data: bytes, scheme: int) -> bytes:
    if scheme == NONE:
        return data
    if scheme in (DEFLATE, OLD_DEFLATE):
        return zlib.decompress(data)
    if scheme == LZW:
        return unpack_lzw(data)
    if scheme == PACKBITS:
        return unpack_bits(data)
    raise ValueError(f"compression {scheme}")


def read_pages(media: bytes) -> Iterator[tuple[dict, np.ndarray]]:
    """Directory and samples (rows, columns, samples a pixel) of each page, in file order; raises on broken files."""
    order = {b"II": "<", b"MM": ">"}.get(media[:2])
    if order is None or struct.unpack_from(order + "H", media, 2)[0] != 42:
        raise ValueError("not a TIFF file")
    at, seen = struct.unpack_from(order + "I", media, 4)[0], set()
    while at:
        if at in seen:
            raise ValueError("directories form a loop")
        seen.add(at)
        tags: dict[int, tuple] = {}
        count = struct.unpack_from(order + "H", media, at)[0]
        for k in range(count):
            tag, kind, n = struct.unpack_from(order + "HHI", media, at + 2 + 12 * k)
            if kind not in FIELD:
                continue
            form = f"{order}{n}{FIELD[kind]}"
            where = at + 10 + 12 * k
            tags[tag] = struct.unpack_from(form, media, where if struct.calcsize(form) <= 4 else struct.unpack_from(order + "I", media, where)[0])
        at_next = struct.unpack_from(order + "I", media, at + 2 + 12 * count)[0]
        yield tags, _page(media, order, tags)
        at = at_next


def _page(media: bytes, order: str, tags: dict[int, tuple]) -> np.ndarray:
    one = lambda tag, default: tags.get(tag, (default,))[0]
    width, height, bits, n = one(WIDTH, 0), one(HEIGHT, 0), one(BITS, 1), one(SAMPLES, 1)
    if bits not in (8, 16) or one(PLANAR, 1) != 1:
        raise ValueError("only 8 or 16 bits a sample, interleaved")
    kind = np.dtype(f"{order}u{bits // 8}")
    tiled = TILES in tags
    w, h = (one(TILE_WIDTH, 0), one(TILE_HEIGHT, 0)) if tiled else (width, min(one(ROWS, height), height))
    starts, sizes = (tags[TILES], tags[TILE_BYTES]) if tiled else (tags[STRIPS], tags[STRIP_BYTES])
    out = np.zeros((height, width, n), kind.newbyteorder("="))
    across = -(-width // w) if tiled else 1
    for k, (start, size) in enumerate(zip(starts, sizes, strict=True)):
        y, x = k // across * h, k % across * w
        rows = h if tiled else min(h, height - y)
        raw = _decoded(media[start:start + size], one(SCHEME, 1))
        block = np.frombuffer(raw, kind, rows * w * n).reshape(rows, w, n)
        if one(PREDICTOR, 1) == 2:
            block = np.cumsum(block, axis=1, dtype=out.dtype)
        out[y:y + rows, x:x + w] = block[:height - y, :width - x]
    return out


def write_pages(pages: list[np.ndarray], scheme: int = DEFLATE, predictor: int = 2, tile: int = 0, order: str = "<") -> bytes:
    """Grey 8-bit pages in strips, or in square tiles of `tile` samples."""
    pack = {NONE: bytes, LZW: pack_lzw, PACKBITS: pack_bits, DEFLATE: lambda x: zlib.compress(x, 1)}[scheme]
    out = bytearray((b"II" if order == "<" else b"MM") + struct.pack(order + "HI", 42, 0))
    link = 4
    for page in pages:
        height, width = page.shape
        if tile:
            full = np.zeros((-(-height // tile) * tile, -(-width // tile) * tile), np.uint8)
            full[:height, :width] = page
            blocks = [full[y:y + tile, x:x + tile] for y in range(0, full.shape[0], tile) for x in range(0, full.shape[1], tile)]
        else:
            blocks = [page[y:y + STRIP_ROWS] for y in range(0, height, STRIP_ROWS)]
        starts, sizes = [], []
        for b in blocks:
            if predictor == 2:
                b = np.concatenate([b[:, :1], b[:, 1:] - b[:, :-1]], axis=1)
            data = pack(np.ascontiguousarray(b).tobytes())
            starts.append(len(out))
            sizes.append(len(data))
            out += data + b"\0" * (len(data) & 1)
        fields = [(WIDTH, width), (HEIGHT, height), (BITS, 8), (SCHEME, scheme), (PHOTOMETRIC, 1), (SAMPLES, 1), (PREDICTOR, predictor)]
        fields += [(TILE_WIDTH, tile), (TILE_HEIGHT, tile), (TILES, starts), (TILE_BYTES, sizes)] if tile else [(ROWS, STRIP_ROWS), (STRIPS, starts), (STRIP_BYTES, sizes)]
        entries = bytearray()
        for tag, v in sorted(fields):
            v = v if isinstance(v, list) else [v]
            data = struct.pack(f"{order}{len(v)}I", *v)
            if len(data) > 4:
                place, data_at = struct.pack(order + "I", len(out)), data
                out += data_at
            else:
                place = data
            entries += struct.pack(order + "HHI", tag, 4, len(v)) + place
        struct.pack_into(order + "I", out, link, len(out))
        out += struct.pack(order + "H", len(fields)) + entries
        link = len(out)
        out += struct.pack(order + "I", 0)
    return bytes(out)


def store(payload: bytes) -> bytes:
    """A payload whose length is a positive multiple of ROW, as pages of ROW samples a row."""
    rows = np.frombuffer(payload, np.uint8).reshape(-1, ROW)
    return write_pages([rows[y:y + PAGE_ROWS] for y in range(0, len(rows), PAGE_ROWS)])


_PAGE = pa.schema([("page_no", pa.int32()), ("width", pa.int32()), ("height", pa.int32()), ("samples", pa.int32()), ("compression", pa.int32()), ("pixels", pa.binary()), ("error", pa.string())])


def pages(media: DataFrame, column: str) -> DataFrame:
    """One row per page of the TIFF files in `column`, beside the input's other columns.

    Columns added: page_no, width, height, samples, compression, pixels (row-major bytes), error; a clashing name gets
    leading underscores. A file that cannot be read gives one row whose error says why, after the pages before the
    fault; a null file gives no rows."""
    small_batches(media.sparkSession, 64)
    kind = "array<struct<page_no:int,width:int,height:int,samples:int,compression:int,pixels:binary,error:string>>"

    @F.arrow_udf(kind)
    def read(files: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in files:
            rows = []
            for data in batch.to_pylist():
                found = []
                try:
                    for k, (tags, x) in enumerate(read_pages(data) if data is not None else ()):
                        found.append({"page_no": k, "width": x.shape[1], "height": x.shape[0], "samples": x.shape[2], "compression": tags.get(SCHEME, (1,))[0], "pixels": x.tobytes(), "error": None})
                except (ValueError, KeyError, IndexError, TypeError, ArithmeticError, struct.error, zlib.error, MemoryError) as e:
                    found.append({"page_no": len(found), "error": f"{type(e).__name__}: {e}"[:200]})
                rows.append(found)
            yield pa.array(rows, pa.list_(pa.struct(list(_PAGE))))

    taken = media.columns
    p = fresh(taken, "_page")
    out = media.withColumn(p, F.explode(read(F.col(column))))
    return out.select(*taken, *(F.col(f"{p}.{f.name}").alias(fresh(taken, f.name)) for f in _PAGE))


_ROUND = pa.schema([("n_bytes", pa.int64()), ("payload_bytes", pa.int64()), ("payload_sha256", pa.string()), ("tail_crc32", pa.int64()), ("media_bytes", pa.int64()), ("media_sha256", pa.string()), ("feature", pa.string())])


def round_trip(text: bytes) -> tuple:
    """Store a text as TIFF, read the stored bytes back, and describe both; depends on the text alone."""
    media = store(text + b"\0" * (-len(text) % ROW or (0 if text else ROW)))
    found = list(read_pages(media))
    payload = b"".join(x.tobytes() for _, x in found)
    counts = np.bincount(np.frombuffer(payload, np.uint8), minlength=256)
    share = counts[counts > 0] / len(payload)
    entropy = abs(float(-(share * np.log2(share)).sum()))
    mean = int((counts * np.arange(256)).sum() * 1000 // len(payload))
    feature = f"pages={len(found)};rows={len(payload) // ROW};scheme={found[0][0][SCHEME][0]};mean_milli={mean};entropy={math.floor(entropy * 1e6) / 1e6:.6f}"
    return len(text), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-ROW:]), len(media), hashlib.sha256(media).hexdigest(), feature


def text_round_trips(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id and the columns of round_trip for each row's whole text; null counts as empty.

    Repeated rows and rows without id give a row each, equal texts equal values; a very long text becomes several pages, held
    by one task; an empty table gives no rows; other columns are ignored."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = list(zip(*map(round_trip, batch.column(1).to_pylist()), strict=True)) or [[]] * len(_ROUND)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(list(c), f.type) for c, f in zip(rows, _ROUND, strict=True))], names=["doc_id", *_ROUND.names])

    return docs.select("doc_id", utf8(text).alias("text")).mapInArrow(run, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")
