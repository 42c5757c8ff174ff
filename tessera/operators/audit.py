"""Profiles, diagnostics and the output validator."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.similarity import token_jaccard


def profile(records: DataFrame) -> DataFrame:
    """Per country (<blank> for none): rows and blank names, addresses and countries."""
    land = F.when(F.col("land") == "", "<blank>").otherwise(F.col("land"))
    blank = lambda c: F.count_if(F.coalesce(F.trim(c), F.lit("")) == "")
    return records.groupBy(land.alias("land")).agg(F.count("*").alias("n"), blank("business_name").alias("blank_names"), blank("business_address").alias("blank_addresses"))


def flag_counts(records: DataFrame) -> DataFrame:
    return records.select(F.explode("flags").alias("flag")).groupBy("flag").agg(F.count("*").alias("n"))


def truth_profile(links: DataFrame) -> DataFrame:
    """One row over (s1, ids): rows, duplicate s1, singletons, links, most."""
    return links.agg(F.count("*").alias("n"), (F.count("*") - F.countDistinct("s1")).alias("duplicates"), F.count_if(F.size("ids") == 0).alias("singletons"), F.sum(F.size("ids")).alias("links"), F.max(F.size("ids")).alias("most"))


def histogram(df: DataFrame, value: Column) -> DataFrame:
    return df.groupBy(value.alias("value")).agg(F.count("*").alias("n"))


def country_sanity(links: DataFrame, sources: DataFrame, targets: DataFrame) -> DataFrame:
    """How linked countries compare: same, different, blank (the target's), missing target."""
    return country_kinds(links, sources, targets).groupBy("kind").agg(F.count("*").alias("n"))


def nearest_rank(df: DataFrame, value: str, quantiles: dict[str, float]) -> DataFrame:
    """Mean, least, most and nearest-rank quantiles sorted[int(n q)], from value counts: no list of all values."""
    counts = df.groupBy(F.col(value).alias("v")).agg(F.count("*").alias("c"))
    upto = counts.select("v", "c", F.sum("c").over(Window.orderBy("v").rowsBetween(Window.unboundedPreceding, 0)).alias("k"), F.sum("c").over(Window.partitionBy()).alias("n"))
    return upto.agg((F.sum(F.col("v") * F.col("c")) / F.sum("c")).alias("mean"), F.min("v").alias("least"), F.max("v").alias("most"), *(F.min(F.when(F.col("k") > F.floor(F.col("n") * q), F.col("v"))).alias(name) for name, q in quantiles.items()))


def hash_sample(records: DataFrame, n: int, seed: int) -> DataFrame:
    """The n records of each country with the smallest hashes."""
    h = F.md5(F.concat_ws(":", F.lit(str(seed)), "entity_id").cast("binary"))
    return records.withColumn("_r", F.row_number().over(Window.partitionBy("land").orderBy(h, "entity_id"))).where(F.col("_r") <= n).drop("_r")


def margins(scored: DataFrame) -> DataFrame:
    """s1, best and margin over the second best (0 where there is none)."""
    r = F.row_number().over(Window.partitionBy("s1").orderBy(F.desc("p"), "t"))
    top = scored.withColumn("_r", r).where(F.col("_r") <= 2).groupBy("s1").agg(F.max("p").alias("best"), F.coalesce(F.max(F.when(F.col("_r") == 2, F.col("p"))), F.lit(0.0)).alias("second"))
    return top.select("s1", "best", (F.col("best") - F.col("second")).alias("margin"))


def misses(truth: DataFrame, ranked: DataFrame, source_keys: DataFrame, target_keys: DataFrame) -> DataFrame:
    """Links that were not retrieved, with the number of keys that both sides share."""
    lost = truth.select("s1", "t").distinct().join(ranked, ["s1", "t"], "left_anti")
    a = lost.join(source_keys.select(F.col("entity_id").alias("s1"), "method", "key"), "s1")
    b = target_keys.select(F.col("entity_id").alias("t"), "method", "key")
    shared = a.join(b, ["t", "method", "key"]).groupBy("s1", "t").agg(F.count("*").alias("shared"))
    return lost.join(shared, ["s1", "t"], "left").na.fill(0, ["shared"])


def frequency_buckets(targets: DataFrame) -> DataFrame:
    """How many targets have a name of what frequency."""
    per = targets.where(F.col("name_folded") != "").groupBy("name_folded").agg(F.count("*").alias("c"))
    b = F.when(F.col("c") == 1, "1").when(F.col("c") <= 5, "2-5").when(F.col("c") <= 10, "6-10").when(F.col("c") <= 50, "11-50").when(F.col("c") <= 100, "51-100").otherwise(">100")
    return per.groupBy(b.alias("bucket")).agg(F.count("*").alias("names"), F.sum("c").alias("targets"))


def top_tokens(records: DataFrame, n: int = 15) -> DataFrame:
    """The n most frequent name tokens of each country."""
    c = records.select("land", F.explode(F.filter(F.split("name_folded", " "), lambda t: t != "")).alias("token")).groupBy("land", "token").agg(F.count("*").alias("n"))
    return c.withColumn("rank", F.row_number().over(Window.partitionBy("land").orderBy(F.desc("n"), "token"))).where(F.col("rank") <= n)


def validate(results: DataFrame, candidates: DataFrame, required: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """rule, n: findings over (s1, ids) outputs. Nothing is found in a valid pair of files but a row of zeros each.

    One grouped pass over the rows beside the required ids, and one over the distinct ids that no known target has."""
    empty = F.array().cast("array<string>")
    rows = results.join(candidates.select("s1", F.col("ids").alias("_c")), "s1", "left")
    some = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    per = rows.groupBy("s1").agg(
        F.count("*").alias("rows"),
        F.sum((F.size("ids") != F.size(F.array_distinct("ids"))).cast("int")).alias("duplicate_ids"),
        F.sum(F.size(F.filter("ids", lambda x: x.startswith("S1-")))).alias("self_matches"),
        F.sum(F.size(F.filter("ids", lambda x: ~x.rlike("^S[123]-")))).alias("bad_prefix"),
        F.sum((F.size(F.array_except("ids", F.coalesce("_c", empty))) > 0).cast("int")).alias("not_candidates"),
    )
    both = per.withColumn("_in", F.lit(1)).join(required.select("s1").distinct().withColumn("_must", F.lit(1)), "s1", "full")
    found = both.agg(
        some(F.count_if(F.col("rows") > 1)).alias("duplicate_rows"),
        *(some(F.sum(c)).alias(c) for c in ("duplicate_ids", "self_matches", "bad_prefix")),
        some(F.count_if(F.col("_in").isNull())).alias("missing_rows"),
        some(F.count_if(F.col("_must").isNull())).alias("extra_rows"),
        some(F.sum("not_candidates")).alias("not_candidates"),
    )
    out = found.unpivot([], found.columns, "rule", "n")
    if known is not None:
        counted = results.select(F.explode("ids").alias("id")).groupBy("id").agg(F.count("*").alias("c"))
        out = out.unionByName(counted.join(known.select(F.col("entity_id").alias("id")), "id", "left_anti").agg(some(F.sum("c")).alias("n")).select(F.lit("unknown_ids").alias("rule"), "n"))
    return out


def mix_runs(spine: DataFrame, runs: dict[str, DataFrame]) -> DataFrame:
    """Each s1 of the spine (s1, land) takes its ids from the run named for its country; a country without run gets none."""
    out = None
    for land, run in runs.items():
        part = spine.where(F.col("land") == land).join(run.select("s1", "ids"), "s1", "left")
        out = part if out is None else out.unionByName(part)
    rest = spine.where(~F.col("land").isin(*runs)).withColumn("ids", F.lit(None).cast("array<string>"))
    return (rest if out is None else out.unionByName(rest)).withColumn("ids", F.coalesce("ids", F.array().cast("array<string>")))


def mixed_whole(spine: DataFrame, runs: dict[str, DataFrame]) -> DataFrame:
    """mix_runs, refusing a country without run and a record that its country's run lacks."""
    lost = None
    for land, run in runs.items():
        part = spine.where(F.col("land") == land).join(run.select("s1"), "s1", "left_anti")
        lost = part if lost is None else lost.unionByName(part)
    rest = spine.where(~F.col("land").isin(*runs))
    n = (rest if lost is None else lost.unionByName(rest)).count()
    if n:
        raise RuntimeError(f"{n} source records have no run")
    return mix_runs(spine, runs)


def flagged_examples(records: DataFrame, n: int = 20) -> DataFrame:
    """The first n records with a flag, by id."""
    return records.where(F.size("flags") > 0).orderBy("entity_id").limit(n).select("entity_id", "flags")


def sampled_sanity(links: DataFrame, sources: DataFrame, targets: DataFrame, sample: int, seed: int) -> DataFrame:
    """How the countries of hash-sampled links compare: one row of counts and the ratio of same among same and different.

    The sample is of targets whose hash lies below sample / links; a target that several records claim counts once, for
    the smallest of them."""
    from tessera.operators.decide import bucket

    n = links.select(F.count("*").alias("_links"))
    taken = links.join(n).where(bucket(F.col("t"), seed) < F.least(F.lit(1.0), F.lit(sample) / F.greatest(F.col("_links"), F.lit(1)))).groupBy("t").agg(F.min("s1").alias("s1"))
    kinds = country_kinds(taken, sources, targets)
    count = lambda k: F.count_if(F.col("kind") == k).alias(k)
    out = kinds.agg(F.count("*").alias("sampled"), count("same"), count("different"), count("blank"), count("missing"))
    both = F.col("same") + F.col("different")
    return out.withColumn("ratio", F.when(both == 0, 0.0).otherwise(F.col("same") / F.greatest(both, F.lit(1))))


def country_kinds(links: DataFrame, sources: DataFrame, targets: DataFrame) -> DataFrame:
    """links with kind: missing (no such target), blank (target without country), same or different."""
    pairs = links.join(sources.select(F.col("entity_id").alias("s1"), F.col("land").alias("a")), "s1", "left").join(targets.select(F.col("entity_id").alias("t"), F.col("land").alias("b")), "t", "left")
    kind = F.when(F.col("b").isNull(), "missing").when(F.col("b") == "", "blank").when(F.col("a").eqNullSafe(F.col("b")), "same").otherwise("different")
    return pairs.select("s1", "t", kind.alias("kind"))


def split_statistics(spine: DataFrame, truth: DataFrame, validation: DataFrame, trained: DataFrame) -> DataFrame:
    """Per country: validation entities, their links by source, singletons, and how many of them a model was trained on."""
    per = truth.groupBy("s1").agg(F.count_if(F.col("t").startswith("S2-")).alias("s2"), F.count_if(F.col("t").startswith("S3-")).alias("s3"))
    rows = spine.join(validation.select("s1"), "s1", "left_semi").join(per, "s1", "left").na.fill(0, ["s2", "s3"]).join(trained.select("s1").distinct().withColumn("_t", F.lit(1)), "s1", "left")
    return rows.groupBy("land").agg(
        F.count("*").alias("entities"), F.sum(F.col("s2") + F.col("s3")).alias("edges"), F.sum("s2").alias("s2_edges"), F.sum("s3").alias("s3_edges"),
        F.count_if(F.col("s2") + F.col("s3") == 0).alias("singletons"), F.count("_t").alias("overlap"),
    )


def recall_by_source(ranked: DataFrame, truth: DataFrame) -> DataFrame:
    """source ('all' for both), links, found and recall (1 without links) of the candidates."""
    hit = truth.select("s1", "t").distinct().join(ranked.select("s1", "t").distinct().withColumn("_h", F.lit(1)), ["s1", "t"], "left")
    both = hit.select(F.explode(F.array(F.lit("all"), F.lower(F.substring("t", 1, 2)))).alias("source"), "_h")
    got = both.groupBy("source").agg(F.count("*").alias("links"), F.count("_h").alias("found"))
    every = ranked.sparkSession.createDataFrame([("all",), ("s2",), ("s3",)], "source string")
    return every.join(got, "source", "left").na.fill(0).withColumn("recall", F.when(F.col("links") == 0, 1.0).otherwise(F.col("found") / F.greatest(F.col("links"), F.lit(1))))


def split_metrics(spine: DataFrame, predicted: DataFrame, truth: DataFrame) -> DataFrame:
    """part (s2, s3: links to that source only; singleton, nonsingleton: such entities only; all), entities, macro
    precision, recall, f05 and f1, predicted and true edges, wrong and lost ones."""
    from tessera.operators.decide import entity_scores, f_beta

    known = truth.select("s1").distinct().withColumn("_some", F.lit(1))
    parts = {
        "all": (spine, predicted, truth),
        "s2": (spine, predicted.where(F.col("t").startswith("S2-")), truth.where(F.col("t").startswith("S2-"))),
        "s3": (spine, predicted.where(F.col("t").startswith("S3-")), truth.where(F.col("t").startswith("S3-"))),
    }
    scores = None
    for name, (s, p, t) in parts.items():
        rows = entity_scores(s, p, t).join(known, "s1", "left").withColumn("part", F.lit(name))
        scores = rows if scores is None else scores.unionByName(rows)
    single = F.when(F.col("part") == "all", F.array(F.lit("all"), F.when(F.col("_some").isNull(), "singleton").otherwise("nonsingleton"))).otherwise(F.array("part"))
    rows = scores.withColumn("part", F.explode(single)).withColumn("f1", f_beta(F.col("precision"), F.col("recall"), 1.0))
    return rows.groupBy("part").agg(
        F.count("*").alias("entities"), F.avg("precision").alias("precision"), F.avg("recall").alias("recall"), F.avg("f").alias("f05"), F.avg("f1").alias("f1"),
        F.sum("n_predicted").alias("predicted"), F.sum("n_true").alias("actual"), F.sum(F.col("n_predicted") - F.col("n_hit")).alias("wrong"), F.sum(F.col("n_true") - F.col("n_hit")).alias("lost"),
    )


def candidate_buckets(spine: DataFrame, ranked: DataFrame) -> DataFrame:
    """How many entities have how many candidates: 0, 1-5, 6-10, 11-20, 21-50, >50."""
    n = spine.select("s1").join(ranked.groupBy("s1").agg(F.count("*").alias("c")), "s1", "left").na.fill(0, ["c"])
    c = F.col("c")
    b = F.when(c == 0, "0").when(c <= 5, "1-5").when(c <= 10, "6-10").when(c <= 20, "11-20").when(c <= 50, "21-50").otherwise(">50")
    return histogram(n, b)


def margin_counts(spine: DataFrame, scored: DataFrame, high: float = 0.9, cuts: tuple[float, ...] = (0.05, 0.10, 0.20)) -> DataFrame:
    """mean_best and mean_margin over all entities, and per cut the entities with a high best score and such a margin."""
    rows = spine.select("s1").join(margins(scored), "s1", "left").na.fill(0.0, ["best", "margin"])
    counts = [F.count_if((F.col("best") >= high) & (F.col("margin") >= cut)).alias(f"margin_{round(cut * 100):02d}") for cut in cuts]
    return rows.agg(F.avg("best").alias("mean_best"), F.avg("margin").alias("mean_margin"), *counts)


def score_distributions(labelled: DataFrame, high: float = 0.9) -> DataFrame:
    """Per label: n, mean, nearest-rank p10 and p50 of the scores p, and the share of high ones; from counts of scores."""
    counts = labelled.groupBy("label", "p").agg(F.count("*").alias("c"))
    w = Window.partitionBy("label")
    upto = counts.withColumn("k", F.sum("c").over(w.orderBy("p").rowsBetween(Window.unboundedPreceding, 0))).withColumn("n", F.sum("c").over(w))
    at = lambda q, name: F.min(F.when(F.col("k") > F.floor(F.col("n") * q), F.col("p"))).alias(name)
    return upto.groupBy("label").agg(F.sum("c").alias("n"), (F.sum(F.col("p") * F.col("c")) / F.sum("c")).alias("mean"), at(0.1, "p10"), at(0.5, "p50"), (F.sum(F.when(F.col("p") >= high, F.col("c")).otherwise(0)) / F.sum("c")).alias("high"))


def attributed_misses(lost: DataFrame, sources: DataFrame, targets: DataFrame, source_keys: DataFrame, target_keys: DataFrame, counts: DataFrame, limit: int, methods: list[str]) -> DataFrame:
    """Why links (s1, t) were not retrieved: the methods of their shared keys, how many of the record's own keys hold more
    targets than the limit, and how near the pair is. A target that is not there has no near."""
    a = lost.join(source_keys.select(F.col("entity_id").alias("s1"), "method", "key"), "s1")
    shared = a.join(target_keys.select(F.col("entity_id").alias("t"), "method", "key"), ["t", "method", "key"]).groupBy("s1", "t").agg(F.array_sort(F.collect_set("method")).alias("_m"), F.count("*").alias("shared"))
    names = F.array(*(F.lit(m) for m in methods))
    over = lost.select("s1").distinct().join(source_keys.select(F.col("entity_id").alias("s1"), "method", "key"), "s1").join(counts.where(F.col("n") > limit).select("method", "key"), ["method", "key"]).groupBy("s1").agg(F.count("*").alias("over_limit"))
    side = lambda df, key, p: df.select(F.col("entity_id").alias(key), F.when(F.col("core_folded") != "", F.col("core_folded")).otherwise(F.col("name_folded")).alias(f"{p}n"), F.col("address_folded").alias(f"{p}a"), F.col("postal").alias(f"{p}p"))
    rows = lost.join(shared, ["s1", "t"], "left").join(over, "s1", "left").join(side(sources, "s1", "a"), "s1", "left").join(side(targets, "t", "b"), "t", "left")
    prefix = lambda k: F.coalesce(((F.length("an") >= k) & (F.length("bn") >= k) & (F.substring("an", 1, k) == F.substring("bn", 1, k))).cast("int"), F.lit(0)).alias(f"prefix{k}")
    return rows.select(
        "s1", "t", F.coalesce(F.array_join(F.transform("_m", lambda m: F.get(names, m)), "|"), F.lit("NONE")).alias("methods"), *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("shared", "over_limit")),
        prefix(4), prefix(6), prefix(8), F.coalesce(token_jaccard(F.col("an"), F.col("bn")), F.lit(0.0)).alias("name_jaccard"), F.coalesce(token_jaccard(F.col("aa"), F.col("ba")), F.lit(0.0)).alias("address_jaccard"),
        F.coalesce((F.col("ap") == F.col("bp")).cast("int"), F.lit(0)).alias("postal_agree"), F.col("bn").isNull().alias("target_missing"),
    )


def metrics_by_frequency(scored: DataFrame, truth: DataFrame, targets: DataFrame, high: float = 0.9) -> DataFrame:
    """Per bucket of how many targets bear the target's name: pairs, true, predicted (p high), both, precision, recall."""
    named = targets.select(F.col("entity_id").alias("t"), "name_folded")
    freq = named.groupBy("name_folded").agg(F.count("*").alias("c"))
    rows = scored.select("s1", "t", "p").join(named, "t", "left").join(freq, "name_folded", "left").join(truth.select("s1", "t").distinct().withColumn("_t", F.lit(1)), ["s1", "t"], "left")
    c, hit, pred = F.coalesce("c", F.lit(0)), F.col("_t").isNotNull(), F.col("p") >= high
    b = F.when(c <= 1, "1").when(c <= 5, "2-5").when(c <= 10, "6-10").when(c <= 50, "11-50").when(c <= 100, "51-100").otherwise(">100")
    got = rows.groupBy(b.alias("bucket")).agg(F.count("*").alias("pairs"), F.count_if(hit).alias("true"), F.count_if(pred).alias("pred"), F.count_if(hit & pred).alias("tp"))
    share = lambda n: F.when(F.col(n) == 0, 1.0).otherwise(F.col("tp") / F.greatest(F.col(n), F.lit(1)))
    return got.withColumn("precision", share("pred")).withColumn("recall", share("true"))


def top_names(targets: DataFrame, n: int = 20) -> DataFrame:
    """The n most frequent names of targets."""
    return targets.where(F.col("name_folded") != "").groupBy("name_folded").agg(F.count("*").alias("c")).orderBy(F.desc("c"), "name_folded").limit(n).select(F.col("name_folded").alias("name"), "c")


def field_rates(records: DataFrame) -> DataFrame:
    """Per country: records, shares with postal code, city, house number, names beyond ASCII and blank addresses, and mean
    tokens of name and address."""
    words = lambda c: F.size(F.filter(F.split(c, " "), lambda t: t != ""))
    share = lambda c, name: F.avg(c.cast("int")).alias(name)
    name = F.when(F.col("core_folded") != "", F.col("core_folded")).otherwise(F.col("name_folded"))
    return records.groupBy("land").agg(
        F.count("*").alias("n"), share(F.col("postal").isNotNull(), "postal"), share(F.col("city").isNotNull(), "city"), share(F.col("house").isNotNull(), "house"), share(F.coalesce(F.col("business_name").rlike("[^\\x00-\\x7F]"), F.lit(False)), "beyond_ascii"),
        F.avg(words(name)).alias("name_tokens"), F.avg(words(F.col("address_folded"))).alias("address_tokens"), share(F.coalesce(F.trim("business_address"), F.lit("")) == "", "blank_address"),
    )


def output_distribution(lists: DataFrame, most: int = 25) -> DataFrame:
    """How many records have how many ids, those beyond `most` together."""
    n = F.size("ids")
    return histogram(lists, F.when(n > most, F.lit(f">{most}")).otherwise(n.cast("string")))


def run_deltas(run: DataFrame, base: DataFrame) -> DataFrame:
    """How a run differs from another: edges and empty rows more or less, and edges that only one of them has."""
    figures = lambda df, p: df.agg(F.coalesce(F.sum(F.size("ids")), F.lit(0)).alias(f"{p}e"), F.count_if(F.size("ids") == 0).alias(f"{p}z"))
    rows = run.select("s1", F.col("ids").alias("x")).join(base.select("s1", F.col("ids").alias("y")), "s1", "full")
    none = F.array().cast("array<string>")
    only = rows.agg(*(F.coalesce(F.sum(F.size(F.array_except(F.coalesce(a, none), F.coalesce(b, none)))), F.lit(0)).cast("long").alias(n) for a, b, n in (("x", "y", "added"), ("y", "x", "dropped"))))
    return figures(run, "a").join(figures(base, "b")).join(only).select((F.col("ae") - F.col("be")).cast("long").alias("edge_delta"), (F.col("az") - F.col("bz")).cast("long").alias("empty_delta"), "added", "dropped")


def finding_examples(results: DataFrame, candidates: DataFrame, required: DataFrame, known: DataFrame | None = None, most: int = 5) -> DataFrame:
    """rule, distinct_n and up to `most` sorted examples (rows, or ids where they are unknown) of each kind of finding of
    validate() that occurs."""
    none = F.array().cast("array<string>")
    rows = results.join(candidates.select("s1", F.col("ids").alias("_c")), "s1", "left")
    kinds = F.array(
        F.when(F.size("ids") != F.size(F.array_distinct("ids")), F.struct(F.lit("duplicate_ids").alias("rule"), F.col("s1").alias("what"))),
        F.when(F.exists("ids", lambda x: x.startswith("S1-")), F.struct(F.lit("self_matches").alias("rule"), F.col("s1").alias("what"))),
        F.when(F.exists("ids", lambda x: ~x.rlike("^S[123]-")), F.struct(F.lit("bad_prefix").alias("rule"), F.col("s1").alias("what"))),
        F.when(F.size(F.array_except("ids", F.coalesce("_c", none))) > 0, F.struct(F.lit("not_candidates").alias("rule"), F.col("s1").alias("what"))),
    )
    found = rows.select(F.explode(F.array_compact(kinds)).alias("x")).select("x.rule", "x.what")
    found = found.unionByName(results.groupBy("s1").agg(F.count("*").alias("n")).where("n > 1").select(F.lit("duplicate_rows").alias("rule"), F.col("s1").alias("what")))
    found = found.unionByName(required.select("s1").join(results, "s1", "left_anti").select(F.lit("missing_rows").alias("rule"), F.col("s1").alias("what")))
    found = found.unionByName(results.join(required.select("s1"), "s1", "left_anti").select(F.lit("extra_rows").alias("rule"), F.col("s1").alias("what")))
    if known is not None:
        ids = results.select(F.explode("ids").alias("id")).distinct()
        found = found.unionByName(ids.join(known.select(F.col("entity_id").alias("id")), "id", "left_anti").select(F.lit("unknown_ids").alias("rule"), F.col("id").alias("what")))
    # The smallest few of each rule, taken in two steps: of many groups first, so that no task sorts a whole rule.
    distinct = found.distinct()
    first = distinct.withColumn("_g", F.pmod(F.xxhash64("what"), F.lit(256)))
    first = first.withColumn("_r", F.row_number().over(Window.partitionBy("rule", "_g").orderBy("what")))
    best = first.where(F.col("_r") <= most).groupBy("rule").agg(F.slice(F.array_sort(F.collect_list("what")), 1, most).alias("examples"))
    return distinct.groupBy("rule").agg(F.count("*").alias("distinct_n")).join(best, "rule").select("rule", "distinct_n", "examples")


def blocking_experiment(candidates: DataFrame, truth: DataFrame, chosen: DataFrame) -> DataFrame:
    """Entities chosen, their links, recall and links found among the first 20 and 50 candidates, candidates at 50."""
    from tessera.operators.decide import recall_at

    real = truth.join(chosen.select("s1"), "s1", "left_semi")
    near = candidates.join(chosen.select("s1"), "s1", "left_semi")
    at = lambda k: recall_at(near, real, k).select(F.col("links"), F.col("found").alias(f"found_{k}"), F.col("recall").alias(f"recall_{k}"), F.col("mean_candidates").alias(f"mean_{k}"))
    return chosen.agg(F.count("*").alias("entities")).join(at(20).drop("links", "mean_20")).join(at(50)).select("entities", "links", "found_20", "recall_20", "found_50", "recall_50", "mean_50")
