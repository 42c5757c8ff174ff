"""Small tests of the training-data operators: nulls, empty texts, ties, repeats, empty tables, clashing columns."""
import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import chat_format, exact_dedup, line_dedup, minhash, mixing, sentencepiece_codec, suffix_dedup, tiff, toxicity, warc

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"word{i}" for i in range(40))


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(1)
    near = LONG.split()
    near[7] = "other"
    rows = [(1, LONG), (2, LONG.replace(" ", "\n")), (3, " ".join(near)), (4, None), (5, ""), (6, " \t\n"), (7, "A b"), (8, "a B"), (9, "x" * 5000), (10, LONG + " " + "tail " * 60), (None, "no id"), (12, "é😀 ▁ end")]
    rows += [(20 + i, " ".join(rng.choice(["la", "lo", "ti", "da", "mo"]) for _ in range(120))) for i in range(8)]
    rows += [(1, LONG)]
    return spark.createDataFrame([(i, t, "en", [None, "a", "b"][k % 3], 0) for k, (i, t) in enumerate(rows)], DOCS).repartition(3)


def test_chat_events(spark):
    rows = [(1, 1, "message", "u", "user", "hi <|end|> [x] \\"), (1, 2, "delta", "a", "assistant", "Hel"), (1, 3, "delta", "a", None, "lo"), (1, 4, "regenerate", "a", None, None), (1, 5, "delta", "a", None, "Hey"), (1, 6, "message", "v", "user", "no"), (1, 7, "edit", "v", None, "yes"), (1, 8, "message", "w", "user", "gone"), (1, 9, "delete", "w", None, None), (None, None, None, None, None, None), (2, 1, "delta", None, "assistant", "alone")]
    events = spark.createDataFrame(rows, "conv_id long, seq long, kind string, message string, role string, text string")
    got = {r.conv_id: r for r in chat_format.format_chats(events.withColumn("formatted", F.lit(1))).collect()}
    assert chat_format.parse(got[1].formatted) == [("user", "hi <|end|> [x] \\"), ("assistant", "Hey"), ("user", "yes")]
    assert [chat_format.unescape(got[1].formatted[a:b]) for a, b in got[1].loss_spans] == ["Hey"]
    assert chat_format.parse(got[None].formatted) == [("", "")] and chat_format.parse(got[2].formatted) == [("assistant", "alone")]
    assert chat_format.format_chats(events.limit(0)).count() == 0


def test_exact_dedup(spark, docs, tmp_path):
    path = str(tmp_path / "documents.parquet")
    docs.write.parquet(path)
    got = exact_dedup.StreamingDeduper(spark, path, str(tmp_path / "state")).ingest().results().collect()
    assert len(got) == docs.count() and sum(r.kept for r in got) == len({re.sub(r"[\x20\x09-\x0D]", "", r.text or "") for r in docs.collect()})
    by = defaultdict(list)
    for r in got:
        by[r.doc_id].append(r)
    assert {r.keep_id for r in by[1] + by[2]} == {1} and all(r.group_size == 3 for r in by[1] + by[2]) and sum(r.kept for r in by[1]) == 1
    assert {by[i][0].keep_id for i in (4, 5, 6)} == {6} and by[4][0].text_sha256 == hashlib.sha256(b"").hexdigest()


def test_toxicity(spark, docs):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice(["la", "ne", "tis", "or", "em", "du"]) for _ in range(rng.randint(1, 4)))
    def text(bad):
        ws = [word() for _ in range(200)]
        for _ in range(6 * bad):
            ws[rng.randrange(200)] = rng.choice(["horrid", "wretch", "vermin", "despised"])
        return " ".join(ws)
    rows = [(i, i % 3 == 0, text(i % 3 == 0)) for i in range(600)]
    model = toxicity.CompressionToxicity.fit([(int(y), t.encode()) for i, y, t in rows[:400]])
    one = model.scorer()
    right = [(one(t.encode()) >= 0.7) == y for _, y, t in rows[400:]]
    assert np.mean(right) > 0.9
    got = toxicity.score(docs.withColumn("score", F.lit("x")), model).collect()
    assert len(got) == docs.count() and all(0 < r.score < 1 for r in got)
    none = toxicity.fit(docs, spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    assert toxicity.score(docs.limit(0), none).count() == 0 and none.scorer()(b"x") == 0.0


def test_toxicity_of_stems_and_of_rare_words():
    """Toxic rows that share stems only, each with an ending of its own, and insults of which one is a tenth as frequent."""
    rng = random.Random(12)
    part = lambda: rng.choice(["la", "ne", "tis", "or", "em", "du", "qua", "vel", "ir", "os"])
    word = lambda: "".join(part() for _ in range(rng.randint(1, 4)))
    def text(marks):
        ws = [word() for _ in range(150)]
        for m in marks:
            ws[rng.randrange(150)] = m
        return " ".join(ws).encode()
    stem = lambda: [rng.choice(["zephk", "kromwy"]) + word() for _ in range(8)]
    rare = lambda: ["wretchworm" if rng.random() < 0.1 else "despicable"] * 4
    for marks in (stem, rare):
        rows = [(y, text(marks() if y else ())) for y in (k % 4 == 0 for k in range(1600))]
        one = toxicity.CompressionToxicity.fit([(int(y), x) for y, x in rows[:1000]]).scorer()
        caught, false = (np.mean([one(x) >= 0.7 for y, x in rows[1000:] if y == side]) for side in (True, False))
        assert caught > 0.9 and false < 0.08, (caught, false)
    assert [one(text(["wretchworm"] * 4)) >= 0.7 for _ in range(20)].count(True) > 15
    assert one(b"") < 0.7


def test_toxicity_counts_few_grams_at_once():
    import tracemalloc

    rng = np.random.default_rng(5)
    toxic, ordinary = [rng.bytes(200) + b" foul words" for _ in range(50)], [rng.bytes(4000) for _ in range(200)]
    tracemalloc.start()
    found = toxicity._apart(toxic, ordinary)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 14 * sum(map(len, ordinary)) and set(toxicity._grams(b" foul words")) == set(found)


def test_toxicity_is_fitted_by_an_executor(spark, monkeypatch):
    """The driver has the least memory: it gets the model that a fit of its own would give, and fits nothing itself."""
    rows = [(k, f"{'vile scoundrel' if k % 3 == 0 else 'fine person'} number {k} of {k % 7}") for k in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(k, 0, int(k % 3 == 0)) for k, _ in rows], "doc_id long, quality int, toxic int")
    known = {r.doc_id for r in df.where(~toxicity.held_out()).collect()}
    want = toxicity.CompressionToxicity.fit([(int(k % 3 == 0), x.encode()) for k, x in rows if k in known])
    monkeypatch.setattr(toxicity.CompressionToxicity, "fit", lambda rows: pytest.fail("fitted by the driver"))
    got = toxicity.fit(df, labels)
    assert want.toxic and (got.ordinary, got.toxic, got.cut) == (want.ordinary, want.toxic, want.cut)
    assert np.array_equal(got.weights, want.weights) and np.array_equal(got.tail, want.tail)


def test_toxicity_edges(spark):
    rows = [(1, None), (2, ""), (3, "a b"), (3, "a b"), (None, "a b"), (5, "long " * 100_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("PREDICTED", F.lit("x"))
    got = toxicity.score(df, toxicity.CompressionToxicity.fit([(k % 2, f"{'vile scoundrel' if k % 2 else 'fine person'} number {k}".encode()) for k in range(200)])).collect()
    assert len(got) == 6 and len({r.score for r in got if r.text == "a b"}) == 1 and all(0 <= r.score <= 1 for r in got)
    labels = spark.createDataFrame([(2, 0, 1), (3, 0, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    assert {r.score for r in toxicity.score(df, toxicity.fit(df, labels)).collect()} == {0.0}


def test_tiff(spark):
    rng = np.random.default_rng(3)
    x = rng.integers(0, 4, (100, 64)).astype(np.uint8)
    for scheme in (tiff.NONE, tiff.LZW, tiff.PACKBITS, tiff.DEFLATE):
        for predictor, tile, order in ((1, 0, "<"), (2, 16, ">"), (2, 0, "<")):
            assert all((p[:, :, 0] == x).all() for _, p in tiff.read_pages(tiff.write_pages([x, x], scheme, predictor, tile, order)))
    big = rng.integers(0, 256, 3_000_000).astype(np.uint8).tobytes()
    assert tiff.round_trip(big)[:3] == (3_000_000, 3_000_000, hashlib.sha256(big).hexdigest())
    assert tiff.round_trip(b"")[:2] == (0, 64) and tiff.round_trip(b"a" * 64)[:2] == (64, 64)
    files = spark.createDataFrame([(1, bytearray(tiff.write_pages([x, x[:7]]))), (2, bytearray(b"junk")), (3, None)], "page_no int, media binary")
    got = tiff.pages(files, "media").collect()
    assert [(r["page_no"], r["_page_no"], r.height) for r in got if r["page_no"] == 1] == [(1, 0, 100), (1, 1, 7)] and [bool(r.error) for r in got if r["page_no"] == 2] == [True]


def test_broken_tiffs_give_error_rows(spark):
    import struct

    def file(*fields):
        raw = b"".join(struct.pack("<HHI", tag, kind, n) + value.ljust(4, b"\0") for tag, kind, n, value in fields)
        return bytearray(b"II*\0" + struct.pack("<I", 8) + struct.pack("<H", len(fields)) + raw + b"\0" * 4 + b"abcd")

    long = lambda v: struct.pack("<I", v)
    strips = [(tiff.HEIGHT, 4, 1, long(1)), (tiff.BITS, 4, 1, long(8)), (tiff.STRIPS, 4, 1, long(8)), (tiff.STRIP_BYTES, 4, 1, long(4))]
    tiles = [(tiff.WIDTH, 4, 1, long(4)), (tiff.HEIGHT, 4, 1, long(1)), (tiff.BITS, 4, 1, long(8)), (tiff.TILE_WIDTH, 4, 1, long(0)), (tiff.TILE_HEIGHT, 4, 1, long(0)), (tiff.TILES, 4, 1, long(8)), (tiff.TILE_BYTES, 4, 1, long(4))]
    bad = [file(*tiles), file((tiff.WIDTH, 4, 0, b""), *strips), file((tiff.WIDTH, 2, 2, b"x"), *strips), bytearray(b"II"), bytearray()]
    got = tiff.pages(spark.createDataFrame(list(enumerate(bad)), "k int, media binary"), "media").collect()
    assert sorted(r.k for r in got) == list(range(len(bad))) and all(r.error and r.pixels is None for r in got)


def test_tiff_query_columns(spark, docs):
    import zlib

    got = Counter((r.doc_id, r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) for r in tiff.text_round_trips(docs.withColumn("feature", F.lit(1))).collect())
    want = Counter()
    for r in docs.collect():
        raw = (r.text or "").encode()
        padded = raw + b"\0" * (-len(raw) % 64 or (0 if raw else 64))
        want[r.doc_id, len(raw), len(padded), hashlib.sha256(padded).hexdigest(), zlib.crc32(padded[-64:])] += 1
    assert got == want and tiff.text_round_trips(docs.limit(0)).count() == 0


def _sets(rows):
    out = {}
    for i, t in rows:
        w = [x for x in re.split(r"[\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) if x]
        out[i] = {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    return out


@pytest.mark.parametrize("block", [minhash.BLOCK, 3])  # small blocks: large groups take the hub's pass and several cells
def test_minhash_against_brute_force(spark, docs, monkeypatch, block):
    monkeypatch.setattr(minhash, "BLOCK", block)
    rng = random.Random(4)
    base = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join(rng.choice("pqrs") + w if rng.random() < 0.012 else w for w in base)) for i in range(60)] + [(r.doc_id, r.text) for r in docs.collect() if r.doc_id is not None]
    df = spark.createDataFrame([(i + 1000 * (k < 60), t) for k, (i, t) in enumerate(rows)], "doc_id long, text string").dropDuplicates()
    sets = _sets([(r.doc_id, r.text) for r in df.collect()])
    root = {i: i for i in sets}
    find = lambda x: x if root[x] == x else find(root[x])
    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    got = {r.doc_id: r for r in minhash.near_duplicates(df.withColumn("k", F.lit(1)), percent=85).collect()}
    assert {i: (r.n_shingles, r.component_id) for i, r in got.items()} == {i: (len(s), find(i)) for i, s in sets.items()}
    assert minhash.near_duplicates(df.limit(0)).count() == 0


def test_keep_one_of_repeated_and_nameless_rows(spark):
    rows = [(1, LONG), (1, LONG), (None, LONG), (2, LONG + " more"), (1, "another text of the same number in the table"), (None, "only rows without a number have these words"), (None, "only rows without a number have these words"), (3, ""), (3, ""), (4, None), (4, None), (None, None), (5, "tiny"), (6, "TINY")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for c in ("_at", "_who", "_copies", "_same", "key"):
        df = df.withColumn(c, F.lit(c))
    got = minhash.keep_one(df)
    assert got.columns == df.columns
    want = [(1, LONG), (1, rows[4][1]), (None, rows[5][1]), (3, ""), (3, ""), (4, None), (4, None), (None, None), (5, "tiny")]
    order = lambda rs: sorted(rs, key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
    assert order((r.doc_id, r.text) for r in got.collect()) == order(want)


def test_mixing(spark, docs):
    rows = [(i, "w " * (1 + i % 9), "abc"[i % 3] if i % 7 else None) for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("size", F.lit("clash"))
    got = mixing.draw(df, buckets=8).groupBy("source").agg(F.first("source_size").alias("s"), F.first("target").alias("t"), F.sum(F.col("copies") * F.col("size")).alias("taken"), F.max("copies").alias("m")).collect()
    assert abs(sum(r.t for r in got) - sum(r.s for r in got)) < 1e-6 and all(abs(r.taken - r.t) <= 20 and r.t <= 3 * r.s and r.m <= 3 for r in got)
    clash = df.withColumn("_s", F.lit("x")).withColumn("_h", F.lit("x")).withColumn("_first", F.lit("x")).withColumn("_third", F.lit("x"))
    assert sorted(r.copies for r in mixing.draw(clash).collect()) == sorted(r.copies for r in mixing.draw(df).collect()) and mixing.mix(clash).columns == clash.columns
    assert mixing.mix(docs).columns == docs.columns and mixing.draw(docs).count() == docs.count() and mixing.mix(docs.limit(0)).count() == 0


def test_simhash_and_lines(spark, docs):
    words = spark.createDataFrame([(1, [f"w{i}" for i in range(1300)]), (2, ["a"]), (3, ["a", "b"])], "k int, w array<string>")
    hashes = {r.k: [h % 2**64 for h in r.h] for r in words.select("k", F.transform("w", lambda x: F.xxhash64(x)).alias("h")).collect()}
    for r in line_dedup.simhashes(words, "w", "k").collect():
        assert r.a % 2**64 == sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in hashes[r.k]) > r.n)
    long = " ".join(f"token{i}" for i in range(3000))
    rows = [(1, "the same line stays once\nshort one\nunique line of the first"), (2, "The  same line STAYS once\nshort one"), (3, long), (4, long + "x"), (5, None), (6, ""), (None, "the same line stays once")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("lines_removed", F.lit("clash"))
    got = {r.doc_id: r for r in line_dedup.dedup_lines(df).collect()}
    assert got[1].text == rows[0][1] and got[2].text == "short one" and got[2].lines_removed == 1
    assert got[3].text == long and got[4].text == "" and got[5].text is None and got[6].text == "" and got[None].text == ""
    assert line_dedup.dedup_lines(df.limit(0)).count() == 0


def _lines_that_go(spark, rows):
    """Ids to leave out by edit similarity 0.8 of all pairs, one normalised line a row."""
    df = spark.createDataFrame(rows, "i long, p string")
    other = df.toDF("j", "q")
    near = df.crossJoin(other).where("i < j and 5 * levenshtein(p, q) <= greatest(length(p), length(q))").select("i", "j").collect()
    root = {i: i for i, _ in rows}
    find = lambda x: x if root[x] == x else find(root[x])
    for a, b in near:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    return {i for i in root if find(i) != i}


def test_near_lines_against_brute_force(spark):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice(["la", "ne", "tis", "or", "em", "du", "kha", "vi"]) for _ in range(rng.randint(1, 4)))
    rows = []
    for n in (4, 6, 10, 20, 30, 60, 100):
        for _ in range(8):
            base = [word() for _ in range(n)]
            rows.append(" ".join(base))
            for share in (0.02, 0.1, 0.15):
                near = list(base)
                for k in rng.sample(range(n), max(1, int(share * n))):
                    near[k] = word()
                rows.append(" ".join(near))
    rows = list(enumerate(dict.fromkeys(rows)))
    want = _lines_that_go(spark, rows)
    got = {r.doc_id for r in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).where("lines_removed > 0").collect()}
    assert len(want) > 100 and got <= want and len(got) >= 0.97 * len(want), (len(got), len(want))


def test_all_shared_buckets_are_kept(spark):
    rows = [(1, list(range(1, 10)))] + [(10 + k, [k]) for k in range(1, 10)] + [(30, [99])]
    keys = spark.createDataFrame(rows, "k1 long, ks array<long>")
    got = [(r.k, r.k1, r.hub) for part in range(line_dedup.PASSES) for r in line_dedup._buckets(keys, part).collect()]
    assert sorted(got) == sorted((k, i, 1) for k in range(1, 10) for i in (1, 10 + k))


def test_keys_of_lines_that_share_enough_meet(spark):
    """Every fifth word changed: no pair is without a shared key, nor is a pair of short similar lines."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(3, 9)))
    pairs = []
    for n in (40, 60, 90):
        for _ in range(100):
            base = [word() for _ in range(n)]
            pairs.append((" ".join(base), " ".join(word() if k % 5 == 2 else w for k, w in enumerate(base))))
    for n in range(5, 32):
        for _ in range(20):
            base = [rng.choice("abcdefg ") for _ in range(n)]
            near = list(base)
            for k in rng.sample(range(n), n // 5):
                near[k] = "z"
            pairs.append(("".join(base), "".join(near)))
    df = spark.createDataFrame(pairs, "p string, q string")
    keys = lambda c: line_dedup.shingle_keys(F.col(c), F.split(c, " "))
    assert df.where(~F.arrays_overlap(keys("p"), keys("q"))).count() == 0


def test_rare_shingles_name_the_buckets(spark):
    """Lines whose common word pairs are less than what near lines share do not meet in the buckets of those."""
    rng = random.Random(13)
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6))
    common = [word() for _ in range(20)]
    own = [[word() for _ in range(20)] for _ in range(40)]
    rows = [(k, " ".join(common + x)) for k, x in enumerate(own)] + [(100, " ".join(common + own[0][:-2] + [word(), word()]))]
    texts = spark.createDataFrame(rows, "id long, norm string")
    assert all(len(x) >= line_dedup.LARGE for _, x in rows)
    keys = texts.select(F.col("id").alias("k1"), line_dedup.shingle_keys(F.col("norm"), F.split("norm", " "), line_dedup._frequencies(texts)).alias("ks"))
    got = {(r.k1, r.g) for part in range(line_dedup.PASSES) for r in line_dedup._buckets(keys, part).collect()}
    assert got == {(0, 2), (100, 2)}


@pytest.mark.parametrize("few", [1, 8])
def test_large_and_small_buckets_give_the_same(spark, few, monkeypatch):
    """Chains of near lines, with all buckets of more than two rows going by the hub or not."""
    monkeypatch.setattr(line_dedup, "FEW", few)
    rng = random.Random(14)
    rows, line = [], ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(30)]
    for k in range(12):
        rows.append((k, " ".join(line)))
        line = list(line)
        line[2 * k] = "other" * (k % 2) + str(k)
    got = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.doc_id for r in got.where("lines_removed = 0").collect()} == {0}


def test_distances_of_long_lines_by_pieces(spark):
    rng = random.Random(15)
    pairs = []
    for k, share in enumerate((0.02, 0.05, 0.1, 0.18, 0.19, 0.2, 0.21, 0.25, 0.5) * 3):
        base = [rng.choice("abcdefgh ") for _ in range(1_500 + 200 * (k % 5))]
        near = [rng.choice(("", "é", c + "y")) if rng.random() < share else c for c in base]
        pairs.append((k, "x" + "".join(base) + "x", "y" + "".join(near) + "y"))
    df = spark.createDataFrame(pairs, "k long, p string, q string")
    texts = df.select(F.col("k").alias("id"), F.col("p").alias("norm")).union(df.select(F.col("k") + 1000, "q"))
    got = {r.a for r in line_dedup._similar(df.select(F.col("k").alias("a"), (F.col("k") + 1000).alias("b")), texts, 0.8).collect()}
    want = {r.k for r in df.where("5 * levenshtein(p, q) <= greatest(length(p), length(q))").collect()}
    assert got == want and 6 < len(want) < len(pairs)


def test_letter_counts_rule_no_near_line_out(spark):
    rng = random.Random(12)
    rows = []
    for i in range(150):
        base = "".join(rng.choice("etaoinsr hldu") for _ in range(rng.randint(5, 60)))
        rows += [(2 * i, " ".join(base.split())), (2 * i + 1, " ".join("".join(rng.choice("xe") if rng.random() < 0.1 else c for c in base).split()))]
    rows = [(i, t) for i, t in {t: i for i, t in rows if t}.items() for i, t in [(t, i)]]
    df = spark.createDataFrame(rows, "i long, t string").withColumn("w", F.array_distinct(F.split("t", " ")))
    df = df.select("i", "t", F.size("w").alias("n"), F.length("t").alias("len"), F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b"), *line_dedup._letters(F.col("t"), F.col("w")))
    both = df.select(F.struct("*").alias("x")).crossJoin(df.select(F.struct("*").alias("y"))).where("5 * levenshtein(x.t, y.t) <= greatest(length(x.t), length(y.t))")
    assert both.count() > len(rows) and both.where(~line_dedup._near("x", "y", 0.8)).count() == 0


def test_pairs_of_few_words_are_held_to_their_distance(spark):
    rows = [("anagrams of one line", "one line of anagrams", False), ("anagrams of one line", "anagrams of one lime", True), ("ab", None, True)]
    df = spark.createDataFrame(rows, "p string, q string, near boolean").select(F.struct(F.col("p").alias("s")).alias("x"), F.struct(F.col("q").alias("s")).alias("y"), "near")
    assert df.where(line_dedup._close("x", "y", 0.8) != F.col("near")).count() == 0


def test_short_lines(spark):
    import corpus_pipeline

    rows = [(1, "One two\n" + "x" * 40 + "\nlone\n\nhello wonderful"), (2, "one  TWO\n" + "x" * 40 + "\nother\n\nhello wonderfuls"), (3, "two words\nlone")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.text for r in corpus_pipeline.dedup_lines(spark, df, "").collect()}
    assert got == {1: rows[0][1], 2: "other\n", 3: "two words"}


def test_long_lines_and_clashing_names(spark):
    """A line of 70,000 characters and one of 12,000 words with a changed word each; columns named as internal ones."""
    rng = random.Random(10)
    words = ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(12_000)]
    chars = "".join(rng.choice("abcdefgh") for _ in range(70_000))
    edited = [w if k % 400 else "edited" for k, w in enumerate(words)]
    rows = [(1, " ".join(words) + "\n" + chars), (2, " ".join(edited) + "\n" + chars[:35_000] + "z" + chars[35_001:]), (3, None), (3, None), (4, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for c in ("_row", "_r", "_d", "_drop", "Lines_Removed"):
        df = df.withColumn(c, F.lit(c))
    got = line_dedup.dedup_lines(df, least_words=1).collect()
    assert sorted((r.doc_id, r.lines_removed, len(r.text or "")) for r in got) == [(1, 0, len(rows[0][1])), (2, 2, 0), (3, 0, 0), (3, 0, 0), (4, 0, 0)]
    assert all(r["_row"] == "_row" and r["_drop"] == "_drop" and r["_r"] == "_r" and r["_d"] == "_d" for r in got)


def test_warc(spark):
    pages = spark.createDataFrame([(1, "http://a/", '<html lang="en"><title>T &amp; u</title><script>x</script><p>one<p>two <a href="/z">z</a>'), (2, None, None)], "page_id long, url string, html string")
    got = {(r.page_id, r.record_type): r for r in warc.derive(warc.page_responses(pages).withColumn("error", F.lit(1))).collect()}
    assert len(got) == 6
    conversion = next(warc.parse_records(bytes(got[1, "conversion"].record)))
    assert conversion[1] == b"one\ntwo z" and dict(conversion[0])["WARC-Refers-To"] == got[1, "response"].record_id
    meta = next(warc.parse_records(bytes(got[1, "metadata"].record)))[1].decode()
    assert "title: T & u" in meta and "outlink: /z" in meta and got[1, "response"].source_payload_digest in meta
    bad = spark.createDataFrame([(1, bytearray(b"junk")), (2, None)], "page_id long, warc binary")
    assert [bool(r.error) for r in warc.derive(bad).collect()] == [True]


def _repeated(texts):
    seen = Counter(t[i:i + 200] for t in texts for i in range(len(t) - 199))
    out = []
    for t in texts:
        gone = np.zeros(len(t) + 1, int)
        for i in range(len(t) - 199):
            if seen[t[i:i + 200]] > 1:
                gone[i] += 1
                gone[i + 200] -= 1
        m = np.cumsum(gone[:-1]) > 0
        out.append((len(t), int(m.sum()), int(m[:1].sum()) + int((m[1:] & ~m[:-1]).sum()), hashlib.sha256(np.frombuffer(t, np.uint8)[~m].tobytes()).hexdigest()))
    return out


def test_suffixes_that_cannot_repeat_are_not_sorted(monkeypatch):
    """30 windows around one anchor, two of them with a shared stretch: only starts in it are sorted."""
    rng = np.random.default_rng(3)
    windows = [bytes(rng.integers(97, 123, 369).astype(np.uint8)) for _ in range(30)]
    windows[7] = windows[7][:40] + windows[3][40:260] + windows[7][260:]
    sorted_, real = [], suffix_dedup.sort_suffixes
    monkeypatch.setattr(suffix_dedup, "sort_suffixes", lambda buf, hashes, start, segment: sorted_.append(len(start)) or real(buf, hashes, start, segment))
    got = suffix_dedup.repeated_starts(windows, [1] * 30, [100] * 30, [5] * 30)
    assert [np.flatnonzero(x).tolist() for x in got] == [list(range(40, 61)) if k in (3, 7) else [] for k in range(30)]
    assert sum(sorted_) == 42


@pytest.mark.parametrize("at_once", [20_000, 1])
def test_suffix_dedup_against_brute_force(spark, docs, at_once):
    rng = random.Random(6)
    noise = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    shared = [noise(n) for n in (199, 200, 201, 650)]
    rows = [noise(300) + rng.choice(shared) + noise(rng.randrange(400)) + rng.choice(shared) for _ in range(25)] + ["ab" * 400, "z" * 700] + [r.text for r in docs.collect()]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "doc_id long, text string")
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.repeated_passages(df, sorted_at_once=at_once).collect()}
    assert [got[i] for i in range(len(rows))] == _repeated([(t or "").encode() for t in rows])


def test_suffix_sort_is_a_sort():
    rng = random.Random(7)
    raw = bytes(rng.choice(b"ab") for _ in range(1500)) + b"a" * 800
    buf = np.frombuffer(raw, np.uint8)
    start = np.array([rng.randrange(2000) for _ in range(300)])
    order = suffix_dedup.sort_suffixes(buf, suffix_dedup.Hashes(buf), start, np.zeros(300, int))
    assert sorted(order) == list(range(300)) and [raw[i:i + 200] for i in start[order]] == sorted(raw[i:i + 200] for i in start)


def _fields(b):
    i = 0

    def number():
        nonlocal i
        r = s = 0
        while True:
            x = b[i]
            i += 1
            r |= (x & 127) << s
            s += 7
            if x < 128:
                return r

    while i < len(b):
        k = number()
        if k & 7 == 0:
            yield k >> 3, 0, number()
        else:
            n = number() if k & 7 == 2 else 4
            yield k >> 3, k & 7, b[i:i + n]
            i += n


def _varint(n):
    out = b""
    while n > 127:
        out += bytes((n & 127 | 128,))
        n >>= 7
    return out + bytes((n,))


def _put(f, w, v):
    return _varint(f << 3 | w) + (_varint(v) if w == 0 else _varint(len(v)) + v if w == 2 else v)


def test_sentencepiece_against_the_library(spark, docs):
    import struct

    import sentencepiece

    v = sentencepiece_codec.Vocabulary.load()
    out, k = b"", 0
    for f, w, x in _fields(open(sentencepiece_codec.MODEL, "rb").read()):
        if f == 1:
            x = b"".join(_put(a, c, struct.pack("<f", v.scores[k]) if a == 2 else d) for a, c, d in _fields(x))
            k += 1
        if f == 2:
            x = b"".join(_put(a, c, 1 if a == 3 else d) for a, c, d in _fields(x))  # the unigram model
        out += _put(f, w, x)
    library = sentencepiece.SentencePieceProcessor(model_proto=out)
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyzéñü日€😀") for _ in range(rng.randrange(1, 14))) for _ in range(800)] + ["", "  a  b ", "x" * 300, "tab\there"]
    got = v.encoder()(words)
    assert [np.frombuffer(g, np.int32).tolist() for g in got] == library.encode(words)
    assert all(v.decode(np.frombuffer(g, np.int32)) == w for g, w in zip(got, words, strict=True))
    rows = sentencepiece_codec.decode(sentencepiece_codec.encode(docs.withColumn("ids", F.lit(0)), v).withColumnRenamed("_ids", "i"), v, "i").collect()
    assert all(r.decoded == (r.text or "").replace("▁", " ") for r in rows) and len(rows) == docs.count()
    assert all(r.round_trip for r in sentencepiece_codec.digests(docs, v).collect())


def test_pipeline_stages(spark):
    import corpus_pipeline

    out = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    columns = out.columns
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, out, "/root/testdata/sf0.001")
        assert out.columns == columns
    assert corpus_pipeline.STAGES[-1][1](spark, out.limit(20), "/root/testdata/sf0.001").count() == 20
