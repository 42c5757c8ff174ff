"""The targets' index, runs by ranges and their merge, files in and out, threshold choice, and the command line."""
import json
import random

import pytest
from pyspark.sql import functions as F

from tessera import cli
from tessera.functions.text import normalise
from tessera.operators import audit, blocking, decide, features
from tessera.plans import index, linkage, ranges
from tessera.session import read_json, write_json
from tessera.sources import tsv
from tessera.streaming.incremental import link_stream

REC = "entity_id string, business_name string, business_address string, country string"
NAMES = ("Acme Foods Ltd", "Delta Motors", "Cedar Pharma Inc", "River Bakery", "Harbor Studio LLC")


def _records(n, source):
    return [(f"S{source}-{i}", NAMES[i % 5] if source == 1 or i % 7 else NAMES[i % 5].split()[0], f"{i % 9 + 1} Park {'Road' if source == 1 else 'Rd'}, {10000 + i % 6}", "" if i % 11 == 0 else ("US", "France")[i % 2]) for i in range(n)]


def _data(root):
    (root / "train").mkdir(parents=True)
    (root / "test").mkdir()
    for split in ("train", "test"):
        for source in (1, 2, 3):
            rows = [("entity_id", "business_name", "business_address", "country"), *_records(30, source)]
            (root / split / f"{split}_source{source}.tsv").write_text("".join("\t".join(r) + "\n" for r in rows))
    truth = [("source1_entity_id", "matched_entity_ids"), *((f"S1-{i}", f"S2-{i},S3-{i}" if i % 4 else "") for i in range(30))]
    (root / "train" / "train_ground_truth.tsv").write_text("".join("\t".join(r) + "\n" for r in truth))
    return str(root)


def test_index_is_reused_and_equals_the_direct_plan(spark, tmp_path):
    targets = spark.createDataFrame(_records(40, 2) + _records(40, 3), REC)
    sources = normalise(spark.createDataFrame(_records(20, 1), REC))
    built = index.open_or_build(spark, f"{tmp_path}/i", "v1", lambda: targets)
    again = index.open_or_build(spark, f"{tmp_path}/i", "v1", lambda: pytest.fail("must not be built again"))
    assert again.manifest == built.manifest and again.manifest["row_count"] == 80
    for options in ({"limit": 14}, {"limit": 5000, "stage1": None}, {"limit": 8, "by_country": True}):
        want = blocking.candidates(sources, normalise(targets), cap=6, **options).select("s1", "t", "rank", "score")
        got = again.candidates(sources, cap=6, **options).select("s1", "t", "rank", "score")
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and want.count()
    assert [r.entity_id for r in again.get("S2-3").collect()] == ["S2-3"]
    assert again.lookup(spark.createDataFrame([("S2-1",), ("S3-2",), ("S3-x",)], "entity_id string")).count() == 2
    other = index.open_or_build(spark, f"{tmp_path}/i", "v2", lambda: targets.limit(3))
    assert other.manifest["row_count"] == 3 and other.manifest["fingerprint"] != built.manifest["fingerprint"]
    write_json(spark, f"{tmp_path}/i/manifest.json", {**other.manifest, "row_count": 4})
    assert index.opened(spark, f"{tmp_path}/i") is None
    assert index.open_or_build(spark, f"{tmp_path}/e", "none", lambda: targets.limit(0)).candidates(sources).count() == 0
    with pytest.raises(ValueError):
        again.within(0)


def test_ranges_resume_and_merge_to_one_run(spark, tmp_path):
    targets = spark.createDataFrame(_records(30, 2) + _records(30, 3), REC)
    found = index.open_or_build(spark, f"{tmp_path}/i", "v", lambda: targets)
    sources = spark.createDataFrame(_records(23, 1), REC)
    ordered = sources.withColumn("_ord", F.substring("entity_id", 4, 9).cast("long"))
    cuts = ranges.ranges(23, 9)
    assert cuts == [(0, 9), (9, 18), (18, 23)]
    for a, b in cuts:
        ranges.run_range(ordered, found, f"{tmp_path}/p{a}", a, b, cap=8, limit=5000, stage1=None)
    before = read_json(spark, f"{tmp_path}/p9/summary.json")
    assert ranges.run_range(ordered, found, f"{tmp_path}/p9", 9, 18, cap=8, limit=5000, stage1=None) == before
    parts = [f"{tmp_path}/p{a}" for a, _ in cuts]
    summary = ranges.merge(spark, parts, f"{tmp_path}/out", 23)
    results, cands = linkage.infer(sources, targets, cap=8, limit=5000, stage1=None)
    for name, columns, want in (("matching_results", tsv.RESULT, results), ("candidate_pairs", tsv.CANDIDATES, cands)):
        got = tsv.read_output(spark, f"{tmp_path}/out/{name}.tsv", columns)
        assert {r.s1: r.ids for r in got.collect()} == {r.s1: r.ids for r in want.collect()}
    lines = (tmp_path / "out" / "matching_results.tsv").read_text().splitlines()
    assert lines[0] == "\t".join(tsv.RESULT) and [x.split("\t")[0] for x in lines[1:]] == [f"S1-{i}" for i in range(23)]
    assert summary["sources"] == 23 and summary["complete"] and summary["matched_edges"] == sum(len(r.ids) for r in results.collect()) > 0
    with pytest.raises(RuntimeError, match="more than one part"):
        ranges.merge(spark, [*parts, parts[1]], f"{tmp_path}/bad")
    with pytest.raises(RuntimeError, match="leave out"):
        ranges.merge(spark, [parts[0], parts[2]], f"{tmp_path}/bad")
    with pytest.raises(RuntimeError, match="expected 24"):
        ranges.merge(spark, parts, f"{tmp_path}/bad", 24)
    with pytest.raises(RuntimeError, match="missing"):
        ranges.merge(spark, [*parts, f"{tmp_path}/nowhere"], f"{tmp_path}/bad")
    with pytest.raises(RuntimeError, match="missing parts: fr"):
        ranges.concatenate({"us": results, "fr": None})
    with pytest.raises(Exception, match="more than one row"):
        ranges.concatenate({"us": results, "fr": results}).collect()


def test_files(spark, tmp_path):
    for i, part in enumerate((_records(30, 1)[:20], _records(30, 1)[20:])):
        (tmp_path / f"part{i}.tsv").write_text("".join("\t".join(r) + "\n" for r in [("entity_id", "business_name", "business_address", "country"), *part]))
    rows = tsv.with_order(tsv.read_records(spark, f"{tmp_path}/part*.tsv", 1))
    assert [(r.entity_id, r._ord) for r in rows.orderBy("_ord").collect()] == [(f"S1-{i}", i) for i in range(30)]
    assert [r[0] for r in tsv.first_ids(rows, 3, " france ").collect()] == ["S1-1", "S1-3", "S1-5"]
    assert tsv.countries(rows) == ["", "france", "us"] and tsv.in_range(rows, 5, 7).count() == 2
    (tmp_path / "quoted.tsv").write_text('entity_id\tbusiness_name\tbusiness_address\tcountry\nS1-1\t"A\nB"\tx\tUS\n')
    assert tsv.read_records(spark, f"{tmp_path}/quoted.tsv", 1, multiline=True).first().business_name == "A\nB"
    with pytest.raises(Exception, match="(?i)malformed"):
        tsv.read_records(spark, f"{tmp_path}/quoted.tsv", 1).collect()
    (tmp_path / "latin.tsv").write_bytes("entity_id\tbusiness_name\tbusiness_address\tcountry\nS1-1\tCafé\tx\tUS\n".encode("latin-1"))
    with pytest.raises(Exception, match="not UTF-8"):
        tsv.read_records(spark, f"{tmp_path}/latin.tsv", 1).collect()
    for name, text in (("empty", ""), ("comma", "entity_id,business_name\n")):
        (tmp_path / f"{name}.tsv").write_text(text)
        with pytest.raises(tsv.DataFormatError):
            tsv.read_records(spark, f"{tmp_path}/{name}.tsv")
    (tmp_path / "own.tsv").write_text("source1_entity_id\tmatched_entity_ids\nS1-1\tS1-2\n")
    with pytest.raises(Exception, match="source 1"):
        tsv.read_truth(spark, f"{tmp_path}/own.tsv").collect()
    with pytest.raises(ValueError):
        tsv.source_path("x", "train", 4)


@pytest.mark.parametrize("alone", [True, False])
def test_threshold_equals_every_threshold_tried(spark, alone):
    random.seed(3)
    rows = {(f"S1-{random.randrange(8)}", f"S2-{random.randrange(12)}"): random.randrange(12) / 11 for _ in range(50)}
    scored = spark.createDataFrame([(*k, p) for k, p in rows.items()], "s1 string, t string, p double")
    spine = spark.createDataFrame([(f"S1-{i}",) for i in range(9)], "s1 string")
    truth = spark.createDataFrame([k for k, p in rows.items() if p > 0.6], "s1 string, t string")
    def f(threshold):
        good = decide.above(scored, threshold)
        return decide.macro(decide.entity_scores(spine, decide.exclusive(good) if alone else good, truth)).first()["f"]
    tried = {p: f(p) for p in sorted({*rows.values(), 0.0, 1.0})}
    threshold, figures = decide.select_threshold(spine, scored, truth, alone=alone)
    assert abs(figures["f"] - max(tried.values())) < 1e-9 and abs(f(threshold) - figures["f"]) < 1e-9
    none, figures = decide.select_threshold(spine, scored.limit(0), truth)
    assert none == 1.0 and figures["edges"] == 0 and abs(figures["f"] - decide.macro(decide.entity_scores(spine, scored.limit(0), truth)).first()["f"]) < 1e-9
    assert set(decide.named(decide.macro(decide.entity_scores(spine, scored, truth)).first().asDict(), 0.5)) >= {"f_0.5", "entity_count", "correct_singletons"}


def test_caps_and_joint_training(spark, tmp_path):
    row = lambda land, i: (f"S1-{land}{i}", f"S2-{i}", *(float(i % 2 == 0) if j == 0 else 0.0 for j in range(len(features.NAMES))), int(i % 2 == 0))
    schema = "s1 string, t string, " + ", ".join(f"{n} double" for n in features.NAMES) + ", label int"
    sets = {land: spark.createDataFrame([row(land, i) for i in range(40)], schema) for land in ("us", "fr")}
    capped = features.cap_labels(sets["us"], 11, 7)
    assert {r.label: r.n for r in capped.groupBy("label").agg(F.count("*").alias("n")).collect()} == {1: 5, 0: 6}
    assert sorted(r.s1 for r in capped.collect()) == sorted(r.s1 for r in features.cap_labels(sets["us"].repartition(7), 11, 7).collect())
    model = linkage.joint_train(sets, iterations=2)
    model.save(f"{tmp_path}/m", spark)
    digest = features.bundle_sha256(spark, f"{tmp_path}/m")
    assert len(digest) == 64 and digest == features.bundle_sha256(spark, f"{tmp_path}/m")
    p = {r.s1: r.p for r in features.ModelBundle.load(f"{tmp_path}/m", spark).score(sets["fr"]).collect()}
    assert p["S1-fr0"] > 0.5 > p["S1-fr1"]
    with pytest.raises(FileNotFoundError):
        features.ModelBundle.load(f"{tmp_path}/none", spark)


def test_mix_refuses_what_no_run_covers(spark):
    spine = spark.createDataFrame([("S1-1", "us"), ("S1-2", "fr")], "s1 string, land string")
    run = spark.createDataFrame([("S1-1", ["S2-1"])], "s1 string, ids array<string>")
    with pytest.raises(RuntimeError):
        audit.mixed_whole(spine, {"us": run})
    assert audit.mixed_whole(spine.limit(1), {"us": run}).count() == 1


def test_command_line(spark, tmp_path, capsys):
    data, out = _data(tmp_path / "data"), f"{tmp_path}/out"
    run = lambda *a: cli.main([a[0], "--data-root", data, *a[1:]])
    assert run("infer", "--heuristic", "--output-dir", out) == 0
    whole = tsv.read_output(spark, f"{out}/matching_results.tsv")
    one = {r.s1: r.ids for r in whole.collect()}
    assert len(one) == 30 and sum(map(len, one.values())) > 0
    check = ("validate", "--matching", f"{out}/matching_results.tsv", "--candidate", f"{out}/candidate_pairs.tsv", "--check-ids")
    assert run(*check) == 0 and "PASS" in capsys.readouterr().out
    (tmp_path / "bad.tsv").write_text("source1_entity_id\tmatched_entity_ids\nS1-0\tS2-999\n")
    assert run(check[0], "--matching", f"{tmp_path}/bad.tsv", *check[3:]) == 1 and "missing_rows: 29, e.g. S1-1, S1-10, S1-11, S1-12, S1-13" in capsys.readouterr().out
    assert run("infer", "--heuristic", "--output-dir", f"{out}2", "--partition-by-country", "--shard-count", "2", "--countries", "us,france") == 0
    assert json.loads((tmp_path / "out2" / "inference_summary.json").read_text())["shards"] == 2
    assert tsv.read_output(spark, f"{out}2/matching_results.tsv").count() == 27
    for bad in (("infer",), ("infer", "--heuristic", "--model", "x"), ("infer", "--heuristic", "--country", "us", "--partition-by-country"), ("infer", "--heuristic", "--shard-count", "2"), ("infer", "--heuristic", "--partition-by-country", "--countries", "mars")):
        with pytest.raises(ValueError):
            run(*bad)
    assert run("dataset", "--output", f"{out}/eda.json") == 0 and run("sanity", "--output", f"{out}/sanity.json") == 0
    assert json.loads((tmp_path / "out" / "sanity.json").read_text())["country_sanity"]["sampled"] == 44
    assert run("blocking", "--output", f"{out}/b.json", "--validation-fraction", "1.0") == 0
    assert json.loads((tmp_path / "out" / "b.json").read_text())["recall_50"] > 0.9
    assert run("synthetic") == 0


def test_train_on_the_command_line(spark, tmp_path):
    data, out = _data(tmp_path / "data"), f"{tmp_path}/out"
    run = lambda *a: cli.main([a[0], "--data-root", data, "--output-dir", out, "--model", f"{out}/model", *a[1:]])
    assert run("train", "--iterations", "2", "--stage1", "0") == 0
    report = json.loads((tmp_path / "out" / "training_summary.json").read_text())
    assert report["model_kind"] == "trees" and 0 <= report["threshold"] <= 1
    assert run("infer", "--stage1", "0") == 0
    assert json.loads((tmp_path / "out" / "inference_summary.json").read_text())["model_sha256"] == report["model_sha256"]
    assert tsv.read_output(spark, f"{out}/matching_results.tsv").count() == 30


def test_stream_links_each_batch_as_infer_does(spark, tmp_path):
    targets = spark.createDataFrame(_records(20, 2), REC)
    sources = spark.createDataFrame(_records(10, 1), REC)
    sources.write.parquet(f"{tmp_path}/in")
    new = spark.readStream.schema(REC).parquet(f"{tmp_path}/in")
    for _ in range(2):  # the second run finds nothing new
        link_stream(new, targets, f"{tmp_path}/out", f"{tmp_path}/state", cap=5, limit=50, stage1=None).awaitTermination()
    want = {r.s1: r.ids for r in linkage.infer(sources, targets, cap=5, limit=50, stage1=None)[0].collect()}
    got = spark.read.parquet(f"{tmp_path}/out").collect()
    assert {r.s1: r.ids for r in got} == want and len(got) == 10 and any(want.values())
