"""Candidate generation: keys, bucket pruning, key join, integer scores, quota top-K and re-rank.

One order holds everywhere: score descending, same country first, id ascending. Stage-1 scores are whole hundredths, so
sums do not depend on order. Key tables are narrow; texts join back only for the survivors of stage 1.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.config import DEFAULTS, METHODS, SAME_COUNTRY
from tessera.functions import text
from tessera.functions.similarity import jaccard

_METHOD = {m: i for i, m in enumerate(METHODS)}


def blocking_keys(records: DataFrame) -> DataFrame:
    """entity_id, land, method (its number), key: the distinct keys of normalised records."""
    some = lambda c: F.when(c != "", F.array(c))
    name = text.tokens(F.col("core_folded"))
    rules = {
        "name_core_exact": some(F.col("core_folded")), "name_exact": some(F.col("name_folded")), "name_token_sort": some(F.col("token_sort")),
        "name_prefix": F.when(F.length("core_folded") >= 3, F.array(F.substring("core_folded", 1, 3))), "name_token": F.filter(name, lambda t: (F.length(t) >= 2) & ~t.isin("and", "the")),
        "address_postal": F.when(F.col("postal").isNotNull(), F.array("postal")), "address_house": F.when(F.col("house").isNotNull(), F.array("house")), "address_number": F.filter("numbers", lambda t: F.length(t) >= 2),
        "address_city": F.when(F.col("city").isNotNull(), F.array("city")), "address_token": F.filter(text.tokens(F.col("address_folded")), lambda t: (F.length(t) >= 4) & ~t.isin("near", "road", "street", "avenue")),
    }
    none = F.array().cast("array<struct<method:int,key:string>>")
    parts = [F.coalesce(F.transform(F.array_distinct(c), lambda k, i=_METHOD[m]: k), F.array().cast("array<string>")) for m, c in rules.items()]
    structs = [F.transform(p, _tagged(_METHOD[m])) for m, p in zip(rules, parts, strict=True)]
    return records.select("entity_id", "land", F.explode(F.concat(none, *structs)).alias("k")).select("entity_id", "land", "k.method", "k.key")


def _tagged(i: int):
    return lambda k: F.struct(F.lit(i).alias("method"), k.alias("key"))


def key_counts(target_keys: DataFrame, by_country: bool = False) -> DataFrame:
    """How many targets hold a key; counted in each country apart when partitions are countries."""
    return target_keys.groupBy("method", "key", *(["land"] if by_country else [])).agg(F.count("*").alias("n"))


def prune(target_keys: DataFrame, limit: int = DEFAULTS.bucket_limit, by_country: bool = False) -> DataFrame:
    """Target keys whose bucket holds no more than `limit` targets: this bounds every key's fan-out."""
    if limit < 1:
        raise ValueError("bucket_limit must be 1 or more")
    keys = ["method", "key", *(["land"] if by_country else [])]
    return target_keys.join(key_counts(target_keys, by_country).where(F.col("n") <= limit).select(*keys), keys, "left_semi")


def score_pairs(source_keys: DataFrame, target_keys: DataFrame, by_country: bool = False) -> DataFrame:
    """s1, t, centi (hundredths), hits, same (country), mask (bits of methods) of each pair that shares a key."""
    weight = F.element_at(F.array(*(F.lit(w) for w in METHODS.values())), F.col("method") + 1)
    s = source_keys.select(F.col("entity_id").alias("s1"), F.col("land").alias("land1"), "method", "key", weight.alias("w"), F.call_function("shiftleft", F.lit(1), F.col("method")).alias("bit"))
    t = target_keys.select(F.col("entity_id").alias("t"), F.col("land").alias("land2"), "method", "key")
    on = [s.method == t.method, s.key == t.key, *([s.land1 == t.land2] if by_country else [])]
    pairs = s.join(t, on).select("s1", "t", "w", (F.col("land1") == F.col("land2")).cast("int").alias("same"), "bit")
    out = pairs.groupBy("s1", "t").agg(F.sum("w").alias("w"), F.count("*").alias("hits"), F.max("same").alias("same"), F.bit_or("bit").alias("mask"))
    return out.select("s1", "t", (F.col("w") + SAME_COUNTRY * F.col("hits") * F.col("same")).alias("centi"), "hits", "same", "mask")


def quota_top_k(scored: DataFrame, k: int, fallback: int = DEFAULTS.country_fallback) -> DataFrame:
    """The k best of each s1, with at most `fallback` of another country; adds rank."""
    if fallback < 0:
        raise ValueError("country_fallback must not be negative")
    if k < 1:
        return scored.withColumn("rank", F.lit(0)).limit(0)
    order = [F.desc("centi"), F.desc("same"), F.asc("t")]
    inner = F.row_number().over(Window.partitionBy("s1", "same").orderBy(*order))
    kept = scored.withColumn("_r", inner).where((F.col("same") == 1) | (F.col("_r") <= fallback)).drop("_r")
    return kept.withColumn("rank", F.row_number().over(Window.partitionBy("s1").orderBy(*order))).where(F.col("rank") <= k)


def rerank_bonus(pairs: DataFrame) -> DataFrame:
    """Adds bonus: 2 J(name trigrams) + J(name tokens) + J(address trigrams) + 2 J(address tokens) of raw fields."""
    parts = []
    for field, (g, w) in {"name": (2, 1), "address": (1, 2)}.items():
        a, b = (text.light(F.col(f"{side}_{field}")) for side in ("s", "t"))
        parts += [g * jaccard(text.grams(a), text.grams(b)), w * jaccard(F.array_distinct(text.tokens(a)), F.array_distinct(text.tokens(b)))]
    return pairs.withColumn("bonus", parts[0] + parts[1] + parts[2] + parts[3])


def candidates(sources: DataFrame, targets: DataFrame, cap: int = DEFAULTS.candidate_cap, limit: int = DEFAULTS.bucket_limit, fallback: int = DEFAULTS.country_fallback, stage1: int | None = DEFAULTS.stage1, by_country: bool = False, keys: DataFrame | None = None) -> DataFrame:
    """s1, t, score, method_count, mask, rank: the candidates of normalised source records among normalised targets.

    keys: the targets' keys where they are at hand, already within the limit."""
    if stage1 is not None and stage1 < 1:
        raise ValueError("stage1 must be 1 or more")
    keys = prune(blocking_keys(targets), limit, by_country) if keys is None else keys
    scored = score_pairs(blocking_keys(sources), keys, by_country)
    best = quota_top_k(scored, max(cap, stage1 or 0) if cap > 0 else 0, fallback)
    if stage1 is not None and stage1 > cap > 0:
        raw = lambda df, side, key: df.select(F.col("entity_id").alias(key), F.col("business_name").alias(f"{side}_name"), F.col("business_address").alias(f"{side}_address"))
        best = rerank_bonus(best.join(raw(sources, "s", "s1"), "s1").join(raw(targets, "t", "t"), "t")).withColumn("score", F.col("centi") / 100 + F.col("bonus"))
        order = Window.partitionBy("s1").orderBy(F.desc("score"), F.desc("same"), F.asc("t"))
        best = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= cap)
    else:
        best = best.withColumn("score", F.col("centi") / 100)
    return best.select("s1", "t", "score", F.bit_count("mask").alias("method_count"), "mask", "rank")
