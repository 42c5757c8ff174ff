"""The 34 pair features, the rule-based score, training and model bundles."""
from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.config import DEFAULTS, HEURISTIC, INTERCEPT
from tessera.functions.similarity import edit_similarity, jaccard, python_similarities, token_jaccard
from tessera.functions.text import tokens
from tessera.session import read_json, write_json

#: The features in their order.
NAMES = (
    "name_exact", "name_core_exact", "name_token_sort_exact", "name_token_jaccard", "name_levenshtein", "name_sequence_ratio", "name_char_ngram_cosine", "shared_rare_token_count", "rare_name_token_score",
    "address_exact", "address_postal_exact", "address_house_exact", "address_city_exact", "address_token_jaccard", "address_levenshtein", "address_sequence_ratio", "address_char_ngram_cosine", "numeric_overlap",
    "country_exact", "country_conflict", "address_conflict", "city_conflict", "name_address_name_conflict", "name_address_disagreement", "cross_postal_name_similarity", "field_agreement_count",
    "missing_name", "missing_address", "missing_country", "candidate_count", "retrieval_score", "retrieval_rank", "retrieval_method_count", "score_gap",
)


def with_gap(edges: DataFrame) -> DataFrame:
    """Edges with candidate_count and score_gap: the score less the runner-up's (0 for a lone candidate)."""
    w = Window.partitionBy("s1")
    second = F.coalesce(F.max(F.when(F.col("rank") == 2, F.col("score"))).over(w), F.lit(0.0))
    return edges.withColumn("candidate_count", F.count("*").over(w)).withColumn("score_gap", F.col("score") - second)


def joined(edges: DataFrame, sources: DataFrame, targets: DataFrame) -> DataFrame:
    """Edges with both records' normalised fields, prefixed a_ and b_."""
    side = lambda df, p, key: df.select(F.col("entity_id").alias(key), *(F.col(c).alias(f"{p}_{c}") for c in ("name_folded", "core_folded", "token_sort", "address_folded", "numbers", "house", "postal", "city", "land")))
    return edges.join(side(sources, "a", "s1"), "s1").join(side(targets, "b", "t"), "t")


def native_features(frequency: Column | None = None) -> dict[str, Column]:
    """The features that built-in functions express, over the columns of joined(with_gap(...)).

    frequency: a map from token to its count; without it every token counts once, so all shared tokens are rare."""
    a, b = (lambda n: F.col(f"a_{n}")), (lambda n: F.col(f"b_{n}"))
    flag = lambda c: F.coalesce(c, F.lit(False)).cast("double")
    name = lambda p: F.when(F.col(f"{p}_core_folded") != "", F.col(f"{p}_core_folded")).otherwise(F.col(f"{p}_name_folded"))
    na, nb, aa, ab = name("a"), name("b"), a("address_folded"), b("address_folded")
    jn, ja = token_jaccard(na, nb), token_jaccard(aa, ab)
    ta, tb = F.array_distinct(tokens(na)), F.array_distinct(tokens(nb))
    shared = F.array_intersect(ta, tb)
    count = lambda t: F.greatest(F.coalesce(F.try_element_at(frequency, t), F.lit(1)), F.lit(1)) if frequency is not None else F.lit(1)
    core = (a("core_folded") == b("core_folded")) & (a("core_folded") != "")
    address = (aa == ab) & (aa != "")
    post, home, town = (a(c) == b(c) for c in ("postal", "house", "city"))
    land = (a("land") == b("land")) & (a("land") != "")
    out = {
        "name_exact": flag((a("name_folded") == b("name_folded")) & (a("name_folded") != "")),
        "name_core_exact": flag(core),
        "name_token_sort_exact": flag((a("token_sort") == b("token_sort")) & (a("token_sort") != "")),
        "name_token_jaccard": jn,
        "name_levenshtein": edit_similarity(na, nb),
        "shared_rare_token_count": F.size(F.filter(shared, lambda t: count(t) <= 5)).cast("double"),
        "rare_name_token_score": F.aggregate(shared, F.lit(0.0), lambda s, t: s + F.lit(1.0) / count(t)) / F.greatest(F.least(F.size(ta), F.size(tb)), F.lit(1)),
        "address_exact": flag(address),
        "address_postal_exact": flag(post),
        "address_house_exact": flag(home),
        "address_city_exact": flag(town),
        "address_token_jaccard": ja,
        "address_levenshtein": edit_similarity(aa, ab),
        "numeric_overlap": jaccard(F.array_distinct(a("numbers")), F.array_distinct(b("numbers"))),
        "country_exact": flag(land),
        "country_conflict": flag((a("land") != "") & (b("land") != "") & (a("land") != b("land"))),
        "address_conflict": flag((aa != "") & (ab != "") & ~address & (ja < 0.25)),
        "city_conflict": flag((a("city") != b("city")) & (ja < 0.75)),
        "name_address_name_conflict": flag(address & (na != "") & (nb != "") & (jn < 0.2)),
        "name_address_disagreement": flag(core & (aa != "") & (ab != "") & (ja < 0.5)),
        "cross_postal_name_similarity": F.when(F.coalesce(post, F.lit(False)), jn).otherwise(F.lit(0.0)),
        "field_agreement_count": sum((flag(c) for c in (core, address, post, home, land)), F.lit(0.0)),
        "missing_name": flag((na == "") | (nb == "")),
        "missing_address": flag((aa == "") | (ab == "")),
        "missing_country": flag((a("land") == "") | (b("land") == "")),
        "candidate_count": F.col("candidate_count").cast("double"),
        "retrieval_score": F.col("score").cast("double"),
        "retrieval_rank": F.col("rank").cast("double"),
        "retrieval_method_count": F.col("method_count").cast("double"),
        "score_gap": F.col("score_gap").cast("double"),
    }
    return out


def pair_features(edges: DataFrame, sources: DataFrame, targets: DataFrame) -> DataFrame:
    """s1, t and the 34 features in their fixed order."""
    pairs = joined(with_gap(edges), sources, targets)
    name = lambda p: F.when(F.col(f"{p}_core_folded") != "", F.col(f"{p}_core_folded")).otherwise(F.col(f"{p}_name_folded"))
    pairs = pairs.withColumn("_p", python_similarities(name("a"), name("b"), F.col("a_address_folded"), F.col("b_address_folded")))
    native = native_features()
    return pairs.select("s1", "t", *(native[n].alias(n) if n in native else F.col(f"_p.{n}").alias(n) for n in NAMES))


def heuristic(features: DataFrame) -> DataFrame:
    """Adds p: the logistic of a fixed linear score, clamped."""
    linear = F.lit(INTERCEPT)
    for n, w in HEURISTIC.items():
        linear = linear + w * F.col(n)
    return features.withColumn("p", 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), linear)))))


def label_pairs(features: DataFrame, truth: DataFrame) -> DataFrame:
    """Adds label: 1 where the pair stands in truth (s1, t). Truths that were not retrieved are not added."""
    return features.join(truth.select("s1", "t").distinct().withColumn("label", F.lit(1)), ["s1", "t"], "left").withColumn("label", F.coalesce("label", F.lit(0)))


def cap_labels(examples: DataFrame, most: int = DEFAULTS.max_pairs, seed: int = DEFAULTS.seed) -> DataFrame:
    """At most half of `most` of either label, in the order of a hash, so that any partitioning keeps the same rows.

    Rows are counted by label and first hash digits; what lies beyond the digits that reach a label's limit goes before
    anything is sorted, so that no task holds more than the limit and the rows of one digit group."""
    rows = examples.withColumn("_h", F.md5(F.concat_ws(":", F.lit(str(seed)), "s1", "t").cast("binary")))
    limit = F.when(F.col("label") == 1, most // 2).otherwise(most - most // 2)
    counts = rows.groupBy("label", F.substring("_h", 1, 4).alias("_d")).agg(F.count("*").alias("_n"))
    upto = F.sum("_n").over(Window.partitionBy("label").orderBy("_d").rowsBetween(Window.unboundedPreceding, 0))
    last = counts.withColumn("_upto", upto).where(F.col("_upto") >= limit).groupBy("label").agg(F.min("_d").alias("_last"))
    near = rows.join(last, "label", "left").where(F.col("_last").isNull() | (F.substring("_h", 1, 4) <= F.col("_last")))
    order = Window.partitionBy("label").orderBy("_h", "s1", "t")
    return near.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= limit).select(*examples.columns)


class ModelBundle:
    """A scorer with its threshold: heuristic, constant, or gradient-boosted trees."""

    def __init__(self, kind: str = "heuristic", threshold: float = DEFAULTS.threshold, constant: float | None = None, model=None, features: tuple[str, ...] = NAMES):
        self.kind, self.threshold, self.constant, self.model, self.features = kind, threshold, constant, model, tuple(features)

    @classmethod
    def fit(cls, examples: DataFrame, seed: int = DEFAULTS.seed, iterations: int = 120) -> ModelBundle:
        from pyspark.ml.classification import GBTClassifier
        from pyspark.ml.feature import VectorAssembler

        seen = [r[0] for r in examples.select("label").distinct().limit(2).collect()]
        if len(seen) < 2:
            return cls("constant", constant=float(seen[0]) if seen else 0.0)
        trees = GBTClassifier(maxIter=iterations, stepSize=0.08, maxDepth=5, minInstancesPerNode=2, seed=seed, labelCol="label", featuresCol="_x")
        return cls("trees", model=trees.fit(VectorAssembler(inputCols=list(NAMES), outputCol="_x").transform(examples)))

    def score(self, features: DataFrame) -> DataFrame:
        if self.kind == "heuristic":
            return heuristic(features)
        if self.kind == "constant":
            return features.withColumn("p", F.lit(self.constant))
        from pyspark.ml.feature import VectorAssembler
        from pyspark.ml.functions import vector_to_array

        out = self.model.transform(VectorAssembler(inputCols=list(self.features), outputCol="_x").transform(features))
        return out.withColumn("p", vector_to_array("probability")[1]).drop("_x", "rawPrediction", "probability", "prediction")

    def save(self, path: str, spark: SparkSession | None = None) -> None:
        if self.model is not None:
            self.model.write().overwrite().save(f"{path}/model")
        write_json(spark or SparkSession.getActiveSession(), f"{path}/bundle.json", {"kind": self.kind, "threshold": self.threshold, "constant": self.constant, "features": self.features})

    @classmethod
    def load(cls, path: str, spark: SparkSession | None = None) -> ModelBundle:
        raw = read_json(spark or SparkSession.getActiveSession(), f"{path}/bundle.json")
        if raw is None:
            raise FileNotFoundError(f"{path}/bundle.json")
        if tuple(raw["features"]) != NAMES:
            raise ValueError("the bundle has other features")
        model = None
        if raw["kind"] == "trees":
            from pyspark.ml.classification import GBTClassificationModel

            model = GBTClassificationModel.load(f"{path}/model")
        return cls(raw["kind"], raw["threshold"], raw["constant"], model)


def bundle_sha256(spark: SparkSession, path: str) -> str:
    """A digest of all files of a saved bundle, by name and bytes."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    rows = files.select(F.element_at(F.split("path", "/"), -1).alias("name"), F.sha2("content", 256).alias("sha")).collect()
    return hashlib.sha256("\n".join(sorted(f"{r.name} {r.sha}" for r in rows)).encode()).hexdigest()
