"""End-to-end plans: train, infer, and linking a stream of new records."""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.config import DEFAULTS
from tessera.functions.text import normalise
from tessera.operators import blocking, decide
from tessera.operators.features import ModelBundle, cap_labels, label_pairs, pair_features
from tessera.session import ship, work_dir
from tessera.sources.tsv import id_lists


def score_candidates(sources: DataFrame, targets: DataFrame, model: ModelBundle | None = None, **blocking_options) -> tuple[DataFrame, DataFrame]:
    """Candidates and scored pairs (s1, t, p) of raw records."""
    ship(sources.sparkSession)
    s, t = normalise(sources), normalise(targets)
    edges = blocking.candidates(s, t, **blocking_options)
    return edges, (model or ModelBundle()).score(pair_features(edges, s, t)).select("s1", "t", "p")


def infer(sources: DataFrame, targets: DataFrame, model: ModelBundle | None = None, threshold: float | None = None, exclusive: bool = True, **blocking_options) -> tuple[DataFrame, DataFrame]:
    """Results and candidates as (s1, ids), a row for every source record."""
    model = model or ModelBundle()
    edges, scored = score_candidates(sources, targets, model, **blocking_options)
    good = decide.above(scored, model.threshold if threshold is None else threshold)
    won = decide.exclusive(good) if exclusive else good
    spine = sources.select(F.col("entity_id").alias("s1"))
    return id_lists(won, spine), id_lists(edges, spine, by_rank=True)


def train(sources: DataFrame, targets: DataFrame | None, truth: DataFrame, fraction: float = DEFAULTS.validation_fraction, seed: int = DEFAULTS.seed, iterations: int = 120, found=None, max_pairs: int = DEFAULTS.max_pairs, **blocking_options) -> tuple[ModelBundle, DataFrame]:
    """A fitted bundle with its threshold chosen on held-out entities, and the sweep over the grid; found: the targets' index, for targets."""
    ship(sources.sparkSession)
    s = normalise(sources)
    t = found.records if found else normalise(targets)
    edges = found.candidates(s, **blocking_options) if found else blocking.candidates(s, t, **blocking_options)
    # Read many times over, by the fit and by the choice of a threshold: written once.
    examples = _written(decide.split(label_pairs(pair_features(edges, s, t), truth), fraction, seed))
    model = ModelBundle.fit(cap_labels(examples.where("not validation"), max_pairs, seed), seed, iterations)
    held = decide.split(sources.select(F.col("entity_id").alias("s1")), fraction, seed).where("validation").select("s1")
    scored, real = _written(model.score(examples.where("validation")).select("s1", "t", "p")), truth.join(held, "s1", "left_semi")
    model.threshold, _ = decide.select_threshold(held, scored, real)
    return model, decide.threshold_sweep(held, scored, real, [i / 100 for i in range(101)])


def _written(rows: DataFrame) -> DataFrame:
    path = f"{work_dir(rows.sparkSession)}/examples-{uuid.uuid4().hex}"
    rows.write.parquet(path)
    return rows.sparkSession.read.parquet(path)


def joint_train(examples: dict[str, DataFrame], seed: int = DEFAULTS.seed, iterations: int = 120) -> ModelBundle:
    """One model of the labelled examples (s1, t, features, label) of several countries, each capped on its own."""
    out = None
    for rows in examples.values():
        capped = cap_labels(rows, seed=seed)
        out = capped if out is None else out.unionByName(capped)
    return ModelBundle.fit(out, seed, iterations)


def evaluate_by_country(spine: DataFrame, scored: DataFrame, truth: DataFrame, threshold: float) -> DataFrame:
    """land ('all' for all), entities, precision, recall and f of exclusive decisions: over all entities for 'all', within
    the country for each."""
    lands = spine.select("s1", "land")
    inside = decide.exclusive(decide.above(scored.join(lands, "s1"), threshold), scope="land")
    over_all = decide.exclusive(decide.above(scored, threshold))
    rows = decide.entity_scores(spine, inside, truth).join(lands, "s1").unionByName(decide.entity_scores(spine, over_all, truth).withColumn("land", F.lit("all")))
    return rows.groupBy("land").agg(F.count("*").alias("entities"), *(F.avg(c).alias(c) for c in ("precision", "recall", "f")))
