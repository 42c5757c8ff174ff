"""The synthetic suite: pairs that the rule-based score must tell apart."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.config import DEFAULTS
from tessera.functions.text import normalise
from tessera.operators import blocking
from tessera.operators.features import heuristic, pair_features

REC = "entity_id string, business_name string, business_address string, country string"

# Name and address of a reference record and of a candidate, their countries, and whether they match.
CASES = [
    ("Acme Pvt Ltd", "12 Park Rd", "Acme Private Limited", "12 Park Road", "US", "US", True),
    ("LLC Acme", "12 Park Rd", "Acme LLC", "12 Park Road", "US", "US", True),
    ("Acme Trading", "12 Park Rd", "Acme DBA", "12 Park Road", "US", "US", True),
    ("Learning Center Moncada", "1 Main Road", "Moncada Learning Center", "1 Main Road", "US", "US", True),
    ("Acme", "12 Park Road", "Acme", "12 Park Rd", "US", "US", True),
    ("Acme", "12 Park Avenue", "Acme", "12 Park Ave", "US", "US", True),
    ("Acme", "12 Park Road, 90210", "Acme", "12 Park Road", "US", "US", True),
    ("Acme", "Near SBI ATM, 12 Park Road", "Acme", "12 Park Road, Near SBI ATM", "US", "US", True),
    ("Café École", "10 Rue de Paris", "Cafe Ecole", "10 Rue de Paris", "US", "US", True),
    ("Acme Services", "12 Park Road, Suite 4", "Suite 4 Acme Services", "12 Park Road", "US", "US", True),
    ("Acme", "B-402 Park Road", "Acme", "B-00402 Park Road", "US", "US", True),
    ("Corner Cafe", "5 Main Road", "Corner Cafe", "5 Main Road", "US", "US", True),
    ("Corner Cafe", "5 Main Road", "Corner Cafe", "500 Market Street", "US", "US", False),
    ("Corner Cafe", "5 Main Road", "Unrelated Bakery", "5 Main Road", "US", "US", False),
    ("Acme Dental", "12 Park Road", "Acme Dental Care", "14 Park Road", "US", "US", False),
    ("Acme Dental", "12 Park Road, Boston", "Acme Dental", "12 Park Road, Chicago", "US", "US", False),
    ("Acme", "12 Park Road", "Acme", "12 Park Road", "France", "India", False),
    ("Ecole Team", "175 Boulevard du President Franklin Roosevelt", "Ecole Team", "175 Boulevard President Franklin Roosevelt", "France", "France", True),
    ("Acme", "", "Acme", "", "US", "US", True),
    ("Acme", "", "Different Business", "", "US", "US", False),
]


def run(spark: SparkSession, threshold: float = DEFAULTS.threshold) -> DataFrame:
    """number, p, predicted, expected and passed of every case; each pair meets on its own, as if nothing else were there."""
    s = normalise(spark.createDataFrame([(f"S1-{i}", c[0], c[1], c[4]) for i, c in enumerate(CASES)], REC))
    t = normalise(spark.createDataFrame([(f"S2-{i}", c[2], c[3], c[5]) for i, c in enumerate(CASES)], REC))
    met = blocking.score_pairs(blocking.blocking_keys(s), blocking.blocking_keys(t)).where(F.substring("s1", 4, 9) == F.substring("t", 4, 9))
    edges = met.select("s1", "t", (F.col("centi") / 100).alias("score"), F.bit_count("mask").alias("method_count"), F.lit(1).alias("rank"))
    scored = heuristic(pair_features(edges, s, t)).select(F.substring("s1", 4, 9).cast("int").alias("number"), "p")
    wanted = spark.createDataFrame([(i, c[6]) for i, c in enumerate(CASES)], "number int, expected boolean")
    out = wanted.join(scored, "number", "left").na.fill(0.0, ["p"]).withColumn("predicted", F.col("p") >= threshold)
    return out.select("number", "p", "predicted", "expected", (F.col("predicted") == F.col("expected")).alias("passed"))
