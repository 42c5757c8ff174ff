"""Threshold, exclusivity and metrics."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def above(scored: DataFrame, threshold: float) -> DataFrame:
    """Pairs (s1, t, p) with p at the threshold or above."""
    if not 0 <= threshold <= 1:
        raise ValueError("threshold must lie in [0, 1]")
    return scored.where(F.col("p") >= threshold)


def restrict(scored: DataFrame, candidates: DataFrame) -> DataFrame:
    """Scored pairs that are candidates."""
    return scored.join(candidates.select("s1", "t"), ["s1", "t"], "left_semi")


def exclusive(qualified: DataFrame, scope: str | None = None) -> DataFrame:
    """Each target goes to the highest p, ties to the smallest s1 as a string; `scope` names a column (a shard, say)
    within which that holds instead of globally."""
    keys = ["t", *([scope] if scope else [])]
    w = Window.partitionBy(*keys).orderBy(F.desc("p"), F.asc("s1"))
    return qualified.withColumn("_r", F.row_number().over(w)).where(F.col("_r") == 1).drop("_r")


def collisions(qualified: DataFrame) -> DataFrame:
    """qualified, claimed and collisions as one row."""
    return qualified.agg(F.count("*").alias("qualified"), F.countDistinct("t").alias("claimed")).withColumn("collisions", F.col("qualified") - F.col("claimed"))


def f_beta(p: Column, r: Column, beta: float = 0.5) -> Column:
    b = beta * beta
    return F.when((p <= 0) | (r <= 0), F.lit(0.0)).otherwise((1 + b) * p * r / (b * p + r))


def entity_scores(spine: DataFrame, predicted: DataFrame, truth: DataFrame, beta: float = 0.5) -> DataFrame:
    """Per s1 of the spine: n_predicted, n_true, n_hit, precision, recall, f. Empty against empty scores 1."""
    pred, real = predicted.select("s1", "t").distinct().withColumn("_p", F.lit(1)), truth.select("s1", "t").distinct().withColumn("_t", F.lit(1))
    both = pred.join(real, ["s1", "t"], "full")
    n = both.groupBy("s1").agg(F.count("_p").alias("n_predicted"), F.count("_t").alias("n_true"), F.count(F.when(F.col("_p").isNotNull() & F.col("_t").isNotNull(), 1)).alias("n_hit"))
    out = spine.select("s1").distinct().join(n, "s1", "left").na.fill(0, ["n_predicted", "n_true", "n_hit"])
    p = F.when(F.col("n_predicted") == 0, 1.0).otherwise(F.col("n_hit") / F.greatest(F.col("n_predicted"), F.lit(1)))
    r = F.when(F.col("n_true") == 0, F.when(F.col("n_predicted") == 0, 1.0).otherwise(0.0)).otherwise(F.col("n_hit") / F.greatest(F.col("n_true"), F.lit(1)))
    return out.withColumn("precision", p).withColumn("recall", r).withColumn("f", f_beta(F.col("precision"), F.col("recall"), beta))


def macro(scores: DataFrame) -> DataFrame:
    """entities, macro precision, recall and f, singletons and predicted singletons; zeros without entities."""
    avg = lambda c: F.coalesce(F.avg(c), F.lit(0.0)).alias(c)
    return scores.agg(F.count("*").alias("entities"), avg("precision"), avg("recall"), avg("f"), F.count_if(F.col("n_true") == 0).alias("singletons"), F.count_if(F.col("n_predicted") == 0).alias("predicted_empty"), F.count_if((F.col("n_true") == 0) & (F.col("n_predicted") == 0)).alias("correct_singletons"))


def recall_at(ranked: DataFrame, truth: DataFrame, k: int) -> DataFrame:
    """links, found, recall (1 without links), entities with links, covered ones, and candidates per such entity on
    average, all among the first k candidates."""
    if k < 0:
        raise ValueError("k must not be negative")
    real = truth.select("s1", "t").distinct().withColumn("_t", F.lit(1))
    near = ranked.where(F.col("rank") <= k).select("s1", "t").distinct().withColumn("_h", F.lit(1))
    per = real.join(near, ["s1", "t"], "full").groupBy("s1").agg(F.count("_t").alias("links"), F.count("_h").alias("candidates"), F.count(F.when(F.col("_t").isNotNull() & F.col("_h").isNotNull(), 1)).alias("found")).where("links > 0")
    some = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c)
    out = per.agg(some("links"), some("found"), F.count("*").alias("entities"), F.count_if(F.col("found") > 0).alias("covered"), F.coalesce(F.avg("candidates"), F.lit(0.0)).alias("mean_candidates"))
    return out.withColumn("recall", F.when(F.col("links") == 0, 1.0).otherwise(F.col("found") / F.greatest(F.col("links"), F.lit(1))))


def confusion_kinds(scores: DataFrame) -> DataFrame:
    """Adds kind. A wrong prediction on an entity with truth and no overlap is a `mismatch`."""
    p, t, h = F.col("n_predicted"), F.col("n_true"), F.col("n_hit")
    kind = F.when((p == 0) & (t == 0), "true_negative").when(t == 0, "false_positive").when(p == 0, "false_negative").when(h > 0, "true_positive").otherwise("mismatch")
    return scores.withColumn("kind", kind)


def _steps(spine: DataFrame, scored: DataFrame, truth: DataFrame, beta: float, alone: bool) -> tuple[DataFrame, DataFrame]:
    """How the sum of f, precision and recall over entities changes as the threshold falls to each score, and the entities
    with their sums before the first: an entity's prediction changes only at its own scores."""
    winners = exclusive(scored) if alone else scored
    hits = winners.select("s1", "t", "p").join(truth.select("s1", "t").distinct().withColumn("_t", F.lit(1)), ["s1", "t"], "left")
    real = spine.select("s1").distinct().join(truth.select("s1", "t").distinct().groupBy("s1").agg(F.count("*").alias("n_true")), "s1", "left").na.fill(0, ["n_true"])
    at = hits.groupBy("s1", "p").agg(F.count("*").alias("n"), F.count("_t").alias("h")).join(real, "s1")
    w = Window.partitionBy("s1").orderBy(F.desc("p"))
    upto = at.withColumn("_n", F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, 0))).withColumn("_h", F.sum("h").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    upto = upto.withColumn("precision", F.col("_h") / F.col("_n")).withColumn("recall", F.when(F.col("n_true") == 0, 0.0).otherwise(F.col("_h") / F.greatest(F.col("n_true"), F.lit(1))))
    upto = upto.withColumn("f", f_beta(F.col("precision"), F.col("recall"), beta))
    # Nothing predicted: precision 1, recall and f 1 without truth and 0 with it.
    empty = {"precision": F.lit(1.0), "recall": F.when(F.col("n_true") == 0, 1.0).otherwise(0.0), "f": F.when(F.col("n_true") == 0, 1.0).otherwise(0.0)}
    steps = upto.select("p", "n", *((F.col(c) - F.coalesce(F.lag(c).over(w), e)).alias(c) for c, e in empty.items()), F.when(F.row_number().over(w) == 1, 1).otherwise(0).alias("some"))
    start = real.agg(F.count("*").alias("entities"), *(F.coalesce(F.sum(e), F.lit(0.0)).alias(f"{c}0") for c, e in empty.items()))
    return steps, start


def threshold_sweep(spine: DataFrame, scored: DataFrame, truth: DataFrame, thresholds: list[float], beta: float = 0.5, alone: bool = True) -> DataFrame:
    """threshold, macro f, precision and recall, edges and empty (entities without prediction) at each, in one pass.

    A target's winner is the same at every threshold; alone=False lets targets go to several entities. Changes are summed
    by threshold before anything is sorted, and then summed up over the thresholds."""
    grid = sorted({float(x) for x in thresholds})
    steps, start = _steps(spine, scored, truth, beta, alone)
    at = F.array_max(F.filter(F.array(*map(F.lit, grid)), lambda g: g <= F.col("p")))
    sums = ("f", "precision", "recall", "n", "some")
    got = steps.withColumn("threshold", at).where("threshold is not null").groupBy("threshold").agg(*(F.sum(c).alias(c) for c in sums))
    every = spine.sparkSession.range(1).select(F.explode(F.array(*map(F.lit, grid))).alias("threshold")).join(got, "threshold", "left").na.fill(0)
    return _summed(every, start)


def _summed(every: DataFrame, start: DataFrame) -> DataFrame:
    w = Window.orderBy(F.desc("threshold")).rowsBetween(Window.unboundedPreceding, 0)
    total = every.select("threshold", *(F.sum(c).over(w).alias(c) for c in ("f", "precision", "recall", "n", "some"))).join(start)
    mean = lambda c: F.when(F.col("entities") == 0, 0.0).otherwise((F.col(f"{c}0") + F.col(c)) / F.greatest(F.col("entities"), F.lit(1))).alias(c)
    return total.select("threshold", mean("f"), mean("precision"), mean("recall"), F.col("n").cast("long").alias("edges"), (F.col("entities") - F.col("some")).cast("long").alias("empty"))


#: Scored pairs up to which every observed score is a threshold too, as fixed by the semantics; beyond it the grid alone.
OBSERVED = 10_000


def select_threshold(spine: DataFrame, scored: DataFrame, truth: DataFrame, beta: float = 0.5, alone: bool = True, observed: int = OBSERVED) -> tuple[float, dict]:
    """The threshold with the best macro f, ties to the larger, and its figures.

    Thresholds are 0.00 to 1.00, and all observed scores where there are few pairs; it begins with predicting nothing at 1."""
    grid = [i / 100 for i in range(101)]
    few = scored.select("p").limit(observed + 1)
    if few.count() <= observed:
        grid += [r.p for r in few.where("p between 0 and 1").distinct().collect()]
    best = threshold_sweep(spine, scored, truth, grid, beta, alone).orderBy(F.desc(F.round("f", 9)), F.desc("threshold")).first().asDict()
    nothing = macro(entity_scores(spine, scored.limit(0), truth, beta)).first().asDict()
    if (nothing["f"], 1.0) >= (best["f"], best["threshold"]):
        return 1.0, {"threshold": 1.0, "f": nothing["f"], "precision": nothing["precision"], "recall": nothing["recall"], "edges": 0, "empty": nothing["entities"]}
    return best["threshold"], best


def named(figures: dict, beta: float = 0.5) -> dict:
    """The figures of macro() under their report names: f as f_{beta}."""
    names = {"entities": "entity_count", "f": f"f_{beta}", "singletons": "true_singletons", "predicted_empty": "predicted_singletons"}
    return {names.get(k, k): v for k, v in figures.items()}


def totals(lists: DataFrame, candidates: DataFrame, qualified: DataFrame) -> DataFrame:
    """sources, candidate_edges, matched_edges and collisions of a run, as one row."""
    count = lambda df, name: df.agg(F.coalesce(F.sum(F.size("ids")), F.lit(0)).cast("long").alias(name))
    out = lists.agg(F.count("*").alias("sources"), F.coalesce(F.sum(F.size("ids")), F.lit(0)).cast("long").alias("matched_edges"))
    return out.join(count(candidates, "candidate_edges")).join(collisions(qualified).select("collisions")).select("sources", "candidate_edges", "matched_edges", "collisions")


def add_totals(parts: DataFrame) -> DataFrame:
    """The totals of several runs (with a column complete) in one row; complete where all are."""
    return parts.agg(*(F.sum(c).alias(c) for c in ("sources", "candidate_edges", "matched_edges", "collisions")), F.bool_and("complete").alias("complete"))


def bucket(entity: Column, seed: int) -> Column:
    """A hash of an id in [0, 1)."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), entity).cast("binary")), 1, 8), 16, 10).cast("long") / 4294967296.0


def split(entities: DataFrame, fraction: float, seed: int) -> DataFrame:
    """Adds validation: whole entities go to either side by a hash of the id."""
    return entities.withColumn("validation", bucket(F.col("s1"), seed) < fraction)


def validation_ids(entities: DataFrame, fraction: float, limit: int | None = None, seed: int = 2026) -> DataFrame:
    """The s1 whose hash lies below the fraction; where they are limited, those of the smallest hashes."""
    if not 0 < fraction <= 1:
        raise ValueError("fraction must lie in (0, 1]")
    rows = entities.select("s1", bucket(F.col("s1"), seed).alias("_b")).where(F.col("_b") < fraction)
    return (rows if limit is None else rows.orderBy("_b", "s1").limit(limit)).select("s1")
