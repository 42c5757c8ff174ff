"""Golden cases of normalisation, decisions and metrics, and the single-pair edge cases of the rule-based score."""
import pytest
from pyspark.sql import functions as F

from tessera.functions.text import normalise
from tessera.operators import audit, decide
from tessera.plans import synthetic
from tessera.plans.linkage import infer, score_candidates
from tessera.sources import tsv

REC = synthetic.REC


def test_single_pairs(spark):
    rows = synthetic.run(spark).collect()
    assert len(rows) == len(synthetic.CASES) and not [(synthetic.CASES[r.number], r.p) for r in rows if not r.passed]


def test_names_and_addresses(spark):
    rows = [("S1-1", "  Acme, Inc. & Sons  ", "12B Park Rd, Near SBI ATM", "  FRANCE "), ("S1-2", "LLC Moncada Learning Center", "21B Rue de Paris, 75001", "FR"), ("S1-3", "Café École", "", ""), ("S1-4", "Acme Pvt Ltd", "x", "us")]
    got = {r.entity_id: r for r in normalise(spark.createDataFrame(rows, REC)).collect()}
    a, b, c, d = (got[f"S1-{i}"] for i in range(1, 5))
    assert (a.name_clean, a.name_core, a.suffix, a.token_sort) == ("acme inc and sons", "acme and sons", ["inc"], "acme and inc sons")
    assert (a.address_clean, a.house, a.postal, a.land) == ("12b park road near sbi atm", "12b", None, "france") and "12" in a.numbers
    assert b.name_core == "moncada learning center" and b.postal == "75001" and b.land == "fr"
    assert (c.name_clean, c.name_folded) == ("café école", "cafe ecole") and "blank_address" in c.flags and "blank_country" in c.flags
    assert d.name_core == "acme"


def test_exclusive_and_ties(spark):
    p = spark.createDataFrame([("S1-1", "S2-1", 0.91), ("S1-1", "S2-2", 0.80), ("S1-2", "S2-1", 0.95), ("S1-3", "S2-9", 0.9), ("S1-4", "S2-9", 0.9)], "s1 string, t string, p double")
    assert sorted((r.s1, r.t) for r in decide.exclusive(p).collect()) == [("S1-1", "S2-2"), ("S1-2", "S2-1"), ("S1-3", "S2-9")]
    assert tuple(decide.collisions(p).first()) == (5, 3, 2)
    assert decide.above(p, 0.9).count() == 4
    with pytest.raises(ValueError):
        decide.above(p, 1.5)


def test_metrics(spark):
    spine = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "s1 string")
    pred = spark.createDataFrame([("b", "x"), ("d", "x")], "s1 string, t string")
    true = spark.createDataFrame([("c", "x"), ("d", "x"), ("d", "y")], "s1 string, t string")
    got = {r.s1: round(r.f, 6) for r in decide.entity_scores(spine, pred, true).collect()}
    assert got == {"a": 1.0, "b": 0.0, "c": 0.0, "d": round(1.25 * 0.5 / (0.25 + 0.5), 6)}


def test_sweep_equals_repeated_decisions(spark):
    import random

    random.seed(5)
    rows = [(f"S1-{random.randrange(8)}", f"S2-{random.randrange(10)}", random.randrange(6) / 5) for _ in range(40)]
    scored = spark.createDataFrame(list({(a, b): (a, b, p) for a, b, p in rows}.values()), "s1 string, t string, p double")
    spine = spark.createDataFrame([(f"S1-{i}",) for i in range(8)], "s1 string")
    true = spark.createDataFrame([(f"S1-{i % 8}", f"S2-{i}") for i in range(10)], "s1 string, t string")
    sweep = {r.threshold: r.f for r in decide.threshold_sweep(spine, scored, true, [0.0, 0.4, 0.8, 1.0]).collect()}
    for t, f in sweep.items():
        assert abs(decide.macro(decide.entity_scores(spine, decide.exclusive(decide.above(scored, t)), true)).first()["f"] - f) < 1e-9


def test_end_to_end(spark):
    s = spark.createDataFrame([("S1-1", "Acme Ltd", "12 Park Road", "US"), ("S1-2", "Acme Ltd", "12 Park Road", "US"), ("S1-3", "Nobody", "1 Hill Lane", "FR")], REC)
    t = spark.createDataFrame([("S2-1", "Acme", "12 Park Road", "US")], REC)
    results, cands = infer(s, t)
    got = {r.s1: r.ids for r in results.collect()}
    assert got == {"S1-1": ["S2-1"], "S1-2": [], "S1-3": []}
    findings = {r.rule: r.n for r in audit.validate(results, cands, s.select(F.col("entity_id").alias("s1")), t).collect()}
    assert set(findings.values()) == {0} and len(findings) == 8
    assert score_candidates(s, t)[1].count() == 2


def test_tsv(spark, tmp_path):
    p = tmp_path / "s1.tsv"
    p.write_text('entity_id\tbusiness_name\tbusiness_address\tcountry\nS1-1\t"A ""b"""\t\tUS\n')
    assert tuple(tsv.read_records(spark, str(p), 1).first()) == ("S1-1", 'A "b"', "", "US")
    (tmp_path / "bad.tsv").write_text("id,name\n")
    with pytest.raises(tsv.DataFormatError):
        tsv.read_records(spark, str(tmp_path / "bad.tsv"))
    q = tmp_path / "truth.tsv"
    q.write_text("source1_entity_id\tmatched_entity_ids\nS1-1\tS2-2,S2-2, S3-3\nS1-2\t\n")
    assert [list(r.ids) for r in tsv.read_links(spark, str(q)).orderBy("s1").collect()] == [["S2-2", "S3-3"], []]
