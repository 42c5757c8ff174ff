"""Registered queries of the linkage engine, each with the SQL that gives the same rows where SQL can."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.config import DEFAULTS, METHODS, NO_CITY, NULL_WORDS, STREET_TERMS, STREETS, STRONG, SUFFIXES
from tessera.functions import text
from tessera.operators import audit, blocking, decide, features
from tessera.plans import index, linkage, ranges
from tessera.session import ship, work_dir
from tessera.sources import tsv, views

ENTRY = "country_quota_topk"
LIMIT, CAP, FALLBACK = 40, 20, 3
SEED = 2026
GRID = [i / 20 for i in range(21)]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _listed(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


_CLEAN = "trim(regexp_replace(replace(lower(coalesce({0}, '')), '&', ' and '), '[^a-z0-9_]+', ' ', 'g'))"
_LIGHT = "trim(regexp_replace(lower(coalesce({0}, '')), '[^a-z0-9]+', ' ', 'g'))"
_TOKENS = "list_filter(string_split({0}, ' '), lambda t: t <> '')"
_SUFFIX = "(?:(?:^| )(?:" + "|".join(SUFFIXES) + "))+$"
_GRAMS = "CASE WHEN length({0}) >= 3 THEN list_distinct(list_transform(range(1, length({0}) - 1), lambda i: substr(replace({0}, ' ', '_'), i, 3))) ELSE [] END"
_JACCARD = "(CASE WHEN len({0}) = 0 OR len({1}) = 0 THEN 0.0 ELSE len(list_intersect({0}, {1})) / len(list_distinct(list_concat({0}, {1})))::DOUBLE END)"
_MAP = "MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in STREETS.items()) + "}"
_WEIGHTS = list(METHODS.values())
_KEYS = [
    "[core]", "[clean]", "[token_sort]", "CASE WHEN length(core) >= 3 THEN [substr(core, 1, 3)] ELSE [] END", f"list_filter({_TOKENS.format('core')}, lambda t: length(t) >= 2 AND t NOT IN ('and', 'the'))",
    "[postal]", "[house]", "list_filter(numbers, lambda t: length(t) >= 2)", "[city]", f"list_filter({_TOKENS.format('address')}, lambda t: length(t) >= 4 AND t NOT IN ('near', 'road', 'street', 'avenue'))",
]
_CTE = f"""
WITH rec AS ({views.RECORDS}),
c AS (SELECT *, {_CLEAN.format("business_name")} AS clean, {_CLEAN.format("business_address")} AS raw FROM rec),
d AS (SELECT *, regexp_replace(clean, '{_SUFFIX}', '') AS cut, {_TOKENS.format("raw")} AS rt FROM c),
e AS (SELECT *, array_to_string(list_filter({_TOKENS.format("cut")}, lambda t: NOT list_contains({_listed(STRONG)}, t)), ' ') AS core,
  array_to_string(list_sort({_TOKENS.format("clean")}), ' ') AS token_sort, list_transform(rt, lambda t: coalesce({_MAP}[t], t)) AS ts,
  list_filter(list_transform(rt, lambda t: regexp_replace(t, '[^a-z0-9]', '', 'g')), lambda t: regexp_matches(t, '^[a-z]?[0-9]'))[1] AS house,
  trim(regexp_replace(lower(coalesce(country, '')), '\\s+', ' ', 'g')) AS land FROM d),
norm AS (SELECT *, array_to_string(ts, ' ') AS address, regexp_extract_all(array_to_string(ts, ' '), '[0-9]+') AS numbers,
  list_filter(regexp_extract_all(array_to_string(ts, ' '), '[0-9]+'), lambda x: length(x) IN (5, 6))[1] AS postal,
  list_filter(list_transform(range(1, len(ts)), lambda i: CASE WHEN list_contains({_listed(STREET_TERMS)}, ts[i]) THEN
    list_filter(ts[i + 1:], lambda u: NOT list_contains({_listed(NO_CITY)}, u) AND NOT regexp_matches(u, '^[0-9]+$'))[1] END), lambda x: x IS NOT NULL)[1] AS city FROM e),
keys AS ({" UNION ALL ".join(f"SELECT DISTINCT entity_id, land, {i} AS method, unnest({k}) AS key FROM norm" for i, k in enumerate(_KEYS))}),
k AS (SELECT * FROM keys WHERE key IS NOT NULL AND key <> ''),
sk AS (SELECT * FROM k WHERE entity_id LIKE 'S1-%'), tk AS (SELECT * FROM k WHERE entity_id NOT LIKE 'S1-%'),
kc AS (SELECT method, key, count(*) AS n FROM tk GROUP BY ALL),
pk AS (SELECT tk.* FROM tk SEMI JOIN (SELECT * FROM kc WHERE n <= {LIMIT}) q USING (method, key)),
sc AS (SELECT s.entity_id AS s1, t.entity_id AS t, sum(({_listed(_WEIGHTS)}::INT[])[s.method + 1])::BIGINT AS w, count(*) AS hits, max((s.land = t.land)::INT) AS same, bit_or(1 << s.method) AS mask
  FROM sk s JOIN pk t USING (method, key) GROUP BY 1, 2),
scored AS (SELECT s1, t, w + 15 * hits * same AS centi, hits, same, mask FROM sc),
q AS (SELECT *, row_number() OVER (PARTITION BY s1, same ORDER BY centi DESC, t) AS r FROM scored),
ranked AS (SELECT * FROM (SELECT s1, t, centi, hits, same, mask, row_number() OVER (PARTITION BY s1 ORDER BY centi DESC, same DESC, t) AS rank FROM q WHERE same = 1 OR r <= {FALLBACK}) WHERE rank <= {CAP}),
edges AS (SELECT s1, t, rank, bit_count(mask) AS method_count, least(1.0, centi / 1000.0)::DOUBLE AS p, centi / 100.0 AS score FROM ranked),
truth AS (SELECT a.entity_id AS s1, b.entity_id AS t FROM rec a JOIN rec b ON substr(a.entity_id, 4) = substr(b.entity_id, 4) WHERE a.entity_id LIKE 'S1-%' AND b.entity_id NOT LIKE 'S1-%'),
spine AS (SELECT entity_id AS s1, land FROM norm WHERE entity_id LIKE 'S1-%'),
good AS (SELECT * FROM edges WHERE p >= 0.4),
won AS (SELECT * EXCLUDE (r) FROM (SELECT *, row_number() OVER (PARTITION BY t ORDER BY p DESC, s1) AS r FROM good) WHERE r = 1),
es AS (SELECT s1, coalesce(np, 0) AS n_predicted, coalesce(nt, 0) AS n_true, coalesce(nh, 0) AS n_hit FROM spine
  LEFT JOIN (SELECT s1, count(*) AS np FROM won GROUP BY 1) USING (s1) LEFT JOIN (SELECT s1, count(*) AS nt FROM truth GROUP BY 1) USING (s1)
  LEFT JOIN (SELECT s1, count(*) AS nh FROM won JOIN truth USING (s1, t) GROUP BY 1) USING (s1)),
pr AS (SELECT *, CASE WHEN n_predicted = 0 THEN 1.0 ELSE n_hit::DOUBLE / n_predicted END AS precision, CASE WHEN n_true = 0 THEN (CASE WHEN n_predicted = 0 THEN 1.0 ELSE 0.0 END) ELSE n_hit::DOUBLE / n_true END AS recall FROM es),
ef AS (SELECT *, CASE WHEN precision <= 0 OR recall <= 0 THEN 0.0 ELSE 1.25 * precision * recall / (0.25 * precision + recall) END AS f FROM pr),
lists AS (SELECT spine.s1, spine.land, coalesce(list_sort(list(DISTINCT t) FILTER (t IS NOT NULL)), []) AS ids FROM spine LEFT JOIN won USING (s1) GROUP BY ALL),
both_ AS (SELECT e.*, a.clean AS a_clean, b.clean AS b_clean, a.core AS a_core, b.core AS b_core, a.token_sort AS a_sort, b.token_sort AS b_sort, a.address AS a_address, b.address AS b_address, a.numbers AS a_numbers, b.numbers AS b_numbers,
  a.house AS a_house, b.house AS b_house, a.postal AS a_postal, b.postal AS b_postal, a.land AS a_land, b.land AS b_land, a.business_name AS a_raw, b.business_name AS b_raw, a.business_address AS a_rawad, b.business_address AS b_rawad, a.city AS a_city, b.city AS b_city,
  CASE WHEN a.core <> '' THEN a.core ELSE a.clean END AS na, CASE WHEN b.core <> '' THEN b.core ELSE b.clean END AS nb FROM edges e JOIN norm a ON a.entity_id = e.s1 JOIN norm b ON b.entity_id = e.t)
"""


class World:
    """The records of a folder and what follows from them, built lazily."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        ship(spark)
        self.records = views.records(spark, sf_dir)
        self.norm = text.normalise(self.records, exact=False)
        s1 = F.col("entity_id").startswith("S1-")
        self.sources, self.targets = self.norm.where(s1), self.norm.where(~s1)
        self.spark, self.sf_dir = spark, sf_dir
        self.source_keys, self.target_keys = blocking.blocking_keys(self.sources), blocking.blocking_keys(self.targets)
        self.truth = views.truth(self.records)
        self.spine = self.sources.select(F.col("entity_id").alias("s1"), "land")

    def index(self) -> index.TargetIndex:
        """The targets' index in the shared folder, written by the first query of an application that needs it."""
        files = [f"{self.sf_dir}/{t}.parquet" for t in ("supplier", "part")]
        identity = index.files_identity(self.spark, *files)
        path = f"{work_dir(self.spark)}/tessera-index-{self.spark.sparkContext.applicationId}-{identity[:16]}"
        return index.open_or_build(self.spark, path, identity, lambda: self.records.where(~F.col("entity_id").startswith("S1-")), exact=False)

    def scored(self) -> DataFrame:
        return blocking.score_pairs(self.source_keys, self.index().within(LIMIT))

    def ranked(self) -> DataFrame:
        return blocking.quota_top_k(self.scored(), CAP, FALLBACK)

    def edges(self) -> DataFrame:
        return self.ranked().select("s1", "t", "rank", F.bit_count("mask").alias("method_count"), F.least(F.lit(1.0), F.col("centi") / 1000).alias("p"), (F.col("centi") / 100).alias("score"))

    def won(self) -> DataFrame:
        return decide.exclusive(decide.above(self.edges(), 0.4))

    def scores(self) -> DataFrame:
        return decide.entity_scores(self.spine, self.won(), self.truth)

    def pairs(self) -> DataFrame:
        return features.joined(features.with_gap(self.edges()), self.sources, self.targets)

    def lists(self) -> DataFrame:
        return tsv.id_lists(self.won(), self.spine)


def _query(oracle: str | None = None):
    def register(f: Callable[[World], DataFrame]):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(World(spark, sf_dir))
        if oracle:
            ORACLES[f.__name__] = _CTE + oracle
        return f

    return register


def _six(*names: str) -> list:
    return [F.round(n, 6).alias(n) for n in names]


@_query("SELECT entity_id, clean AS name_clean, core AS name_core, token_sort FROM norm")
def name_normalise(w: World) -> DataFrame:
    return w.norm.select("entity_id", "name_clean", "name_core", "token_sort")


@_query(r"""SELECT doc_id, sha256(clean) AS clean_sha256, sha256(strip_accents(clean)) AS folded_sha256 FROM (SELECT doc_id, trim(regexp_replace(replace(replace(lower(nfc_normalize(coalesce(text, ''))), 'ß', 'ss'), '&', ' and '), '[^\p{L}\p{N}_]+', ' ', 'g')) AS clean FROM documents)""")
def folded_documents(w: World) -> DataFrame:
    docs = w.spark.read.parquet(f"{w.sf_dir}/documents.parquet").select("doc_id", text.folded(F.col("text")).alias("x"))
    return docs.select("doc_id", F.sha2(F.col("x.clean").cast("binary"), 256).alias("clean_sha256"), F.sha2(F.col("x.folded").cast("binary"), 256).alias("folded_sha256"))


@_query("SELECT entity_id, address AS address_clean, array_to_string(numbers, ' ') AS numbers FROM norm")
def address_expand(w: World) -> DataFrame:
    return w.norm.select("entity_id", "address_clean", F.array_join("numbers", " ").alias("numbers"))


@_query("SELECT entity_id, house, postal, city, land FROM norm")
def address_parts(w: World) -> DataFrame:
    return w.norm.select("entity_id", "house", "postal", "city", "land")


@_query(f"""SELECT flag, count(*) AS n FROM (SELECT unnest(list_filter([CASE WHEN clean = '' THEN 'blank_name' END, CASE WHEN clean IN {tuple(NULL_WORDS)} THEN 'null_name' END,
  CASE WHEN len(string_split(trim(regexp_extract(clean, '{_SUFFIX}')), ' ')) > len(list_distinct(string_split(trim(regexp_extract(clean, '{_SUFFIX}')), ' '))) THEN 'multiple_legal_suffixes' END,
  CASE WHEN raw = '' THEN 'blank_address' END, CASE WHEN raw IN {tuple(NULL_WORDS)} THEN 'null_address' END, CASE WHEN raw <> '' AND NOT regexp_matches(raw, '[a-z]') THEN 'address_without_letters' END, CASE WHEN raw <> '' AND NOT regexp_matches(raw, '[0-9]') THEN 'address_without_numbers' END,
  CASE WHEN land = '' THEN 'blank_country' END], lambda x: x IS NOT NULL)) AS flag FROM norm) GROUP BY 1""")
def anomaly_flags(w: World) -> DataFrame:
    return audit.flag_counts(w.norm)


@_query("SELECT entity_id, land, method, key FROM k")
def blocking_keys(w: World) -> DataFrame:
    return w.source_keys.unionByName(w.target_keys)


@_query("SELECT method, key, n FROM kc")
def key_counts(w: World) -> DataFrame:
    return blocking.key_counts(w.target_keys)


@_query("SELECT entity_id, method, key FROM pk")
def bucket_prune(w: World) -> DataFrame:
    return blocking.prune(w.target_keys, LIMIT).select("entity_id", "method", "key")


@_query("SELECT s1, t, centi, hits, same, mask FROM scored")
def block_scores(w: World) -> DataFrame:
    return w.scored()


@_query("SELECT s1, t, centi, rank FROM ranked")
def country_quota_topk(w: World) -> DataFrame:
    return w.ranked().select("s1", "t", "centi", "rank")


@_query(
    "SELECT s1, t, round(2 * " + _JACCARD.format(_GRAMS.format(_LIGHT.format("a_raw")), _GRAMS.format(_LIGHT.format("b_raw"))) + " + " + _JACCARD.format(_TOKENS.format(_LIGHT.format("a_raw")), _TOKENS.format(_LIGHT.format("b_raw")))
    + " + " + _JACCARD.format(_GRAMS.format(_LIGHT.format("a_rawad")), _GRAMS.format(_LIGHT.format("b_rawad"))) + " + 2 * " + _JACCARD.format(_TOKENS.format(_LIGHT.format("a_rawad")), _TOKENS.format(_LIGHT.format("b_rawad"))) + ", 6) AS bonus FROM both_"
)
def rerank_jaccard(w: World) -> DataFrame:
    raw = lambda df, side, key: df.select(F.col("entity_id").alias(key), F.col("business_name").alias(f"{side}_name"), F.col("business_address").alias(f"{side}_address"))
    pairs = w.ranked().select("s1", "t").join(raw(w.sources, "s", "s1"), "s1").join(raw(w.targets, "t", "t"), "t")
    return blocking.rerank_bonus(pairs).select("s1", "t", *_six("bonus"))


@_query("""SELECT s1, t, (a_clean = b_clean AND a_clean <> '')::INT AS name_exact, (a_core = b_core AND a_core <> '')::INT AS name_core_exact, (a_sort = b_sort AND a_sort <> '')::INT AS name_token_sort_exact,
  (a_address = b_address AND a_address <> '')::INT AS address_exact, coalesce(a_postal = b_postal, false)::INT AS address_postal_exact, coalesce(a_house = b_house, false)::INT AS address_house_exact,
  (a_land = b_land AND a_land <> '')::INT AS country_exact, (a_land <> '' AND b_land <> '' AND a_land <> b_land)::INT AS country_conflict, (a_land = '' OR b_land = '')::INT AS missing_country FROM both_""")
def pair_features_exact(w: World) -> DataFrame:
    n = features.native_features()
    names = ("name_exact", "name_core_exact", "name_token_sort_exact", "address_exact", "address_postal_exact", "address_house_exact", "country_exact", "country_conflict", "missing_country")
    return w.pairs().select("s1", "t", *(n[x].cast("int").alias(x) for x in names))


@_query(
    "SELECT s1, t, round(" + _JACCARD.format(_TOKENS.format("na"), _TOKENS.format("nb")) + ", 6) AS name_token_jaccard, round(" + _JACCARD.format(_TOKENS.format("a_address"), _TOKENS.format("b_address"))
    + ", 6) AS address_token_jaccard, round(" + _JACCARD.format("a_numbers", "b_numbers") + ", 6) AS numeric_overlap FROM both_"
)
def pair_features_jaccard(w: World) -> DataFrame:
    n = features.native_features()
    return w.pairs().select("s1", "t", *(F.round(n[x], 6).alias(x) for x in ("name_token_jaccard", "address_token_jaccard", "numeric_overlap")))


@_query("""SELECT s1, t, round(CASE WHEN na = '' OR nb = '' THEN 0.0 ELSE 1 - levenshtein(na, nb) / greatest(length(na), length(nb))::DOUBLE END, 6) AS name_levenshtein,
  round(CASE WHEN a_address = '' OR b_address = '' THEN 0.0 ELSE 1 - levenshtein(a_address, b_address) / greatest(length(a_address), length(b_address))::DOUBLE END, 6) AS address_levenshtein FROM both_""")
def pair_features_levenshtein(w: World) -> DataFrame:
    n = features.native_features()
    return w.pairs().select("s1", "t", *(F.round(n[x], 6).alias(x) for x in ("name_levenshtein", "address_levenshtein")))


_TA, _TB = (f"list_distinct({_TOKENS.format(c)})" for c in ("na", "nb"))
_JN, _JA = _JACCARD.format(_TOKENS.format("na"), _TOKENS.format("nb")), _JACCARD.format(_TOKENS.format("a_address"), _TOKENS.format("b_address"))


@_query(f""", f AS (SELECT *, {_JN} AS jn, {_JA} AS ja, {_TA} AS ta, {_TB} AS tb, a_core = b_core AND a_core <> '' AS same_core, a_address = b_address AND a_address <> '' AS same_address, a_address <> '' AND b_address <> '' AS both_addresses FROM both_)
SELECT s1, t, len(list_intersect(ta, tb))::INT AS shared_rare_token_count, round(len(list_intersect(ta, tb)) / greatest(least(len(ta), len(tb)), 1)::DOUBLE, 6) AS rare_name_token_score, coalesce(a_city = b_city, false)::INT AS address_city_exact,
  (both_addresses AND NOT same_address AND ja < 0.25)::INT AS address_conflict, coalesce(a_city <> b_city AND ja < 0.75, false)::INT AS city_conflict,
  (same_address AND na <> '' AND nb <> '' AND jn < 0.2)::INT AS name_address_name_conflict, (same_core AND both_addresses AND ja < 0.5)::INT AS name_address_disagreement,
  round(CASE WHEN coalesce(a_postal = b_postal, false) THEN jn ELSE 0 END, 6)::DOUBLE AS cross_postal_name_similarity,
  (same_core::INT + same_address::INT + coalesce(a_postal = b_postal, false)::INT + coalesce(a_house = b_house, false)::INT + (a_land = b_land AND a_land <> '')::INT)::INT AS field_agreement_count,
  (na = '' OR nb = '')::INT AS missing_name, (a_address = '' OR b_address = '')::INT AS missing_address, round(score, 6)::DOUBLE AS retrieval_score, rank::INT AS retrieval_rank, method_count::INT AS retrieval_method_count FROM f""")
def pair_features_conflicts(w: World) -> DataFrame:
    n = features.native_features()
    exact = ("shared_rare_token_count", "address_city_exact", "address_conflict", "city_conflict", "name_address_name_conflict", "name_address_disagreement", "field_agreement_count", "missing_name", "missing_address", "retrieval_rank", "retrieval_method_count")
    return w.pairs().select("s1", "t", *(n[x].cast("int").alias(x) for x in exact), *(F.round(n[x], 6).alias(x) for x in ("rare_name_token_score", "cross_postal_name_similarity", "retrieval_score")))


@_query()
def pair_features_all(w: World) -> DataFrame:
    return features.pair_features(w.edges(), w.sources, w.targets)


@_query()
def heuristic_score(w: World) -> DataFrame:
    return features.heuristic(features.pair_features(w.edges(), w.sources, w.targets)).select("s1", "t", "p")


@_query("SELECT s1, t, count(*) OVER (PARTITION BY s1) AS candidate_count, round(score - coalesce(max(CASE WHEN rank = 2 THEN score END) OVER (PARTITION BY s1), 0), 6)::DOUBLE AS score_gap FROM edges")
def score_gap(w: World) -> DataFrame:
    return features.with_gap(w.edges()).select("s1", "t", "candidate_count", *_six("score_gap"))


@_query("SELECT s1, t, p FROM good")
def threshold_filter(w: World) -> DataFrame:
    return decide.above(w.edges(), 0.4).select("s1", "t", "p")


@_query("SELECT s1, t, p FROM won")
def target_exclusivity(w: World) -> DataFrame:
    return w.won().select("s1", "t", "p")


@_query("SELECT count(*) AS qualified, count(DISTINCT t) AS claimed, count(*) - count(DISTINCT t) AS collisions FROM good")
def collision_count(w: World) -> DataFrame:
    return decide.collisions(decide.above(w.edges(), 0.4))


@_query("SELECT s1, array_to_string(ids, ',') AS ids FROM lists")
def id_list_output(w: World) -> DataFrame:
    return w.lists().select("s1", F.array_join("ids", ",").alias("ids"))


@_query("SELECT s1, n_predicted, n_true, n_hit, round(f, 6)::DOUBLE AS f FROM ef")
def entity_fbeta(w: World) -> DataFrame:
    return w.scores().select("s1", "n_predicted", "n_true", "n_hit", *_six("f"))


@_query("SELECT count(*) AS entities, round(avg(precision), 6)::DOUBLE AS precision, round(avg(recall), 6)::DOUBLE AS recall, round(avg(f), 6)::DOUBLE AS f, count(*) FILTER (n_true = 0) AS singletons, count(*) FILTER (n_predicted = 0) AS predicted_empty FROM ef")
def macro_fbeta(w: World) -> DataFrame:
    return decide.macro(w.scores()).select("entities", *_six("precision", "recall", "f"), "singletons", "predicted_empty")


_RECALL = """(SELECT s1, count(*) AS links, count(r.t) AS found, any_value(coalesce(n, 0)) AS candidates FROM truth LEFT JOIN (SELECT * FROM ranked WHERE rank <= {0}) r USING (s1, t) LEFT JOIN (SELECT s1, count(*) AS n FROM ranked WHERE rank <= {0} GROUP BY 1) USING (s1) {1} GROUP BY 1)"""


@_query(f"SELECT sum(links)::BIGINT AS links, sum(found)::BIGINT AS found, count(*) AS entities, count(*) FILTER (found > 0) AS covered, round(avg(candidates), 6) AS mean_candidates, round(sum(found) / sum(links)::DOUBLE, 6) AS recall FROM {_RECALL.format(5, '')}")
def recall_at_k(w: World) -> DataFrame:
    return decide.recall_at(w.ranked(), w.truth, 5).select("links", "found", "entities", "covered", *_six("mean_candidates", "recall"))


@_query("SELECT kind, count(*) AS n FROM (SELECT CASE WHEN n_predicted = 0 AND n_true = 0 THEN 'true_negative' WHEN n_true = 0 THEN 'false_positive' WHEN n_predicted = 0 THEN 'false_negative' WHEN n_hit > 0 THEN 'true_positive' ELSE 'mismatch' END AS kind FROM ef) GROUP BY 1")
def confusion_kinds(w: World) -> DataFrame:
    return decide.confusion_kinds(w.scores()).groupBy("kind").agg(F.count("*").alias("n"))


@_query(f""", g AS (SELECT unnest({GRID}::DOUBLE[]) AS threshold), win AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY t ORDER BY p DESC, s1) AS r FROM edges) WHERE r = 1),
x AS (SELECT g.threshold, spine.s1, (SELECT count(*) FROM truth WHERE truth.s1 = spine.s1) AS nt FROM g, spine),
y AS (SELECT g.threshold, win.s1, count(*) AS np, count(truth.s1) AS nh FROM g JOIN win ON win.p >= g.threshold LEFT JOIN truth USING (s1, t) GROUP BY ALL),
z AS (SELECT x.threshold, coalesce(np, 0) AS np, CASE WHEN coalesce(np, 0) = 0 THEN 1.0 ELSE nh::DOUBLE / np END AS p, CASE WHEN nt = 0 THEN (CASE WHEN coalesce(np, 0) = 0 THEN 1.0 ELSE 0.0 END) ELSE coalesce(nh, 0)::DOUBLE / nt END AS r FROM x LEFT JOIN y USING (threshold, s1))
SELECT threshold, round(avg(CASE WHEN p <= 0 OR r <= 0 THEN 0.0 ELSE 1.25 * p * r / (0.25 * p + r) END), 6)::DOUBLE AS f, sum(np)::BIGINT AS edges FROM z GROUP BY 1""")
def threshold_sweep(w: World) -> DataFrame:
    return decide.threshold_sweep(w.spine, w.edges(), w.truth, GRID).select("threshold", *_six("f"), "edges")


_BUCKET = "(('0x' || substr(md5('{0}:' || {1}), 1, 8))::BIGINT / 4294967296.0)"


@_query(f"SELECT s1, {_BUCKET.format(SEED, 's1')} < 0.2 AS validation FROM spine")
def entity_split_md5(w: World) -> DataFrame:
    return decide.split(w.spine.select("s1"), 0.2, SEED)


@_query(f"SELECT entity_id, land FROM (SELECT entity_id, land, row_number() OVER (PARTITION BY land ORDER BY md5('{SEED}:' || entity_id), entity_id) AS r FROM norm) WHERE r <= 5")
def hash_sample_topn(w: World) -> DataFrame:
    return audit.hash_sample(w.norm, 5, SEED).select("entity_id", "land")


@_query(f"""SELECT s1, t, label FROM (SELECT s1, t, label, row_number() OVER (PARTITION BY label ORDER BY md5('{SEED}:' || s1 || ':' || t), s1, t) AS r
  FROM (SELECT e.s1, e.t, (truth.s1 IS NOT NULL)::INT AS label FROM edges e LEFT JOIN truth USING (s1, t))) WHERE r <= 50""")
def label_cap_sample(w: World) -> DataFrame:
    return features.cap_labels(features.label_pairs(w.edges(), w.truth), 100, SEED).select("s1", "t", "label")


@_query("SELECT CASE WHEN land = '' THEN '<blank>' ELSE land END AS land, count(*) AS n, count(*) FILTER (trim(business_name) = '') AS blank_names, count(*) FILTER (trim(business_address) = '') AS blank_addresses FROM norm GROUP BY 1")
def profile_by_country(w: World) -> DataFrame:
    return audit.profile(w.norm)


@_query("SELECT count(*) AS n, count(*) - count(DISTINCT s1) AS duplicates, count(*) FILTER (len(ids) = 0) AS singletons, sum(len(ids))::BIGINT AS links, max(len(ids)) AS most FROM lists")
def truth_profile(w: World) -> DataFrame:
    return audit.truth_profile(w.lists())


@_query("SELECT len(ids) AS value, count(*) AS n FROM lists GROUP BY 1")
def link_histogram(w: World) -> DataFrame:
    return audit.histogram(w.lists(), F.size("ids"))


@_query("SELECT CASE WHEN b.land IS NULL THEN 'missing' WHEN b.land = '' THEN 'blank' WHEN a.land = b.land THEN 'same' ELSE 'different' END AS kind, count(*) AS n FROM truth JOIN norm a ON a.entity_id = s1 LEFT JOIN norm b ON b.entity_id = t GROUP BY 1")
def country_sanity(w: World) -> DataFrame:
    return audit.country_sanity(w.truth, w.sources, w.targets)


@_query("""SELECT round(avg(v), 6) AS mean, min(v) AS least, max(v) AS most, (list(v ORDER BY v))[floor(count(*) * 0.5)::INT + 1] AS p50, (list(v ORDER BY v))[floor(count(*) * 0.9)::INT + 1] AS p90, (list(v ORDER BY v))[floor(count(*) * 0.99)::INT + 1] AS p99
FROM (SELECT s1, count(*) AS v FROM ranked GROUP BY 1)""")
def candidate_count_percentiles(w: World) -> DataFrame:
    out = audit.nearest_rank(w.ranked().groupBy("s1").agg(F.count("*").alias("v")), "v", {"p50": 0.5, "p90": 0.9, "p99": 0.99})
    return out.select(*_six("mean"), "least", "most", "p50", "p90", "p99")


@_query("SELECT s1, max(p) AS best, round(max(p) - coalesce(max(CASE WHEN r = 2 THEN p END), 0), 6)::DOUBLE AS margin FROM (SELECT *, row_number() OVER (PARTITION BY s1 ORDER BY p DESC, t) AS r FROM edges) WHERE r <= 2 GROUP BY 1")
def score_margins(w: World) -> DataFrame:
    return audit.margins(w.edges()).select("s1", "best", *_six("margin"))


@_query("""SELECT label, count(*) AS n, round(avg(p), 6)::DOUBLE AS mean, (list(p ORDER BY p))[floor(count(*) * 0.1)::INT + 1] AS p10, (list(p ORDER BY p))[floor(count(*) * 0.5)::INT + 1] AS p50, round(count(*) FILTER (p >= 0.9) / count(*)::DOUBLE, 6) AS high
FROM (SELECT e.*, (truth.s1 IS NOT NULL)::INT AS label FROM edges e LEFT JOIN truth USING (s1, t)) GROUP BY 1""")
def score_distribution(w: World) -> DataFrame:
    return audit.score_distributions(features.label_pairs(w.edges(), w.truth)).select("label", "n", *_six("mean"), "p10", "p50", *_six("high"))


@_query("SELECT l.s1, l.t, count(b.key) AS shared FROM (SELECT truth.* FROM truth ANTI JOIN (SELECT s1, t FROM ranked WHERE rank = 1) r USING (s1, t)) l LEFT JOIN sk a ON a.entity_id = l.s1 LEFT JOIN tk b ON b.entity_id = l.t AND b.method = a.method AND b.key = a.key GROUP BY 1, 2")
def miss_attribution(w: World) -> DataFrame:
    return audit.misses(w.truth, w.ranked().where("rank = 1"), w.source_keys, w.target_keys)


@_query("SELECT e.s1, e.t, e.p FROM edges e ANTI JOIN truth USING (s1, t) ORDER BY p DESC, s1, t LIMIT 100")
def top_errors(w: World) -> DataFrame:
    return w.edges().join(w.truth, ["s1", "t"], "left_anti").orderBy(F.desc("p"), "s1", "t").limit(100).select("s1", "t", "p")


@_query("SELECT CASE WHEN c = 1 THEN '1' WHEN c <= 5 THEN '2-5' WHEN c <= 10 THEN '6-10' WHEN c <= 50 THEN '11-50' WHEN c <= 100 THEN '51-100' ELSE '>100' END AS bucket, count(*) AS names, sum(c)::BIGINT AS targets FROM (SELECT clean, count(*) AS c FROM norm WHERE entity_id NOT LIKE 'S1-%' AND clean <> '' GROUP BY 1) GROUP BY 1")
def name_frequency_buckets(w: World) -> DataFrame:
    return audit.frequency_buckets(w.targets)


@_query(f"SELECT land, token, n, rank FROM (SELECT land, token, count(*) AS n, row_number() OVER (PARTITION BY land ORDER BY count(*) DESC, token) AS rank FROM (SELECT land, unnest({_TOKENS.format('clean')}) AS token FROM norm) GROUP BY 1, 2) WHERE rank <= 15")
def top_tokens(w: World) -> DataFrame:
    return audit.top_tokens(w.norm)


@_query("SELECT c AS value, count(*) AS n FROM (SELECT t, count(*) AS c FROM good GROUP BY 1) GROUP BY 1")
def conflict_multiplicity(w: World) -> DataFrame:
    return audit.histogram(decide.above(w.edges(), 0.4).groupBy("t").agg(F.count("*").alias("c")), F.col("c"))


#: A result with every fault, by the number in its id: repeated, missing and extra rows, repeated, own, foreign and odd ids.
_FAULTY = """SELECT s1, CASE k % 11 WHEN 1 THEN {add}({add}(ids, 'S2-x'), 'S2-x') WHEN 2 THEN {add}(ids, s1) WHEN 3 THEN {add}(ids, 'T-9') WHEN 4 THEN {add}(ids, 'S3-0') ELSE ids END AS ids
  FROM (SELECT s1, ids, CAST(substr(s1, 4) AS BIGINT) AS k FROM {lists}) WHERE k % 11 <> 5
  UNION ALL SELECT s1, ids FROM (SELECT s1, ids, CAST(substr(s1, 4) AS BIGINT) AS k FROM {lists}) WHERE k % 11 = 6
  UNION ALL SELECT concat('S1-extra', substr(s1, 4)), ids FROM {lists} WHERE CAST(substr(s1, 4) AS BIGINT) % 11 = 7"""


@_query(f""", bad AS ({_FAULTY.format(add="list_append", lists="lists")}), cand AS (SELECT s1, list(t) AS c FROM edges GROUP BY 1), ids AS (SELECT unnest(ids) AS id FROM bad)
SELECT 'duplicate_rows' AS rule, count(*) AS n FROM (SELECT s1 FROM bad GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'duplicate_ids', count(*) FROM bad WHERE len(ids) <> len(list_distinct(ids))
UNION ALL SELECT 'self_matches', count(*) FROM ids WHERE id LIKE 'S1-%' UNION ALL SELECT 'bad_prefix', count(*) FROM ids WHERE NOT regexp_matches(id, '^S[123]-')
UNION ALL SELECT 'missing_rows', count(*) FROM spine ANTI JOIN bad USING (s1) UNION ALL SELECT 'extra_rows', count(DISTINCT s1) FROM bad ANTI JOIN spine USING (s1)
UNION ALL SELECT 'not_candidates', count(*) FROM bad LEFT JOIN cand USING (s1) WHERE len(list_filter(ids, lambda x: NOT list_contains(coalesce(c, []), x))) > 0
UNION ALL SELECT 'unknown_ids', count(*) FROM ids WHERE id NOT IN (SELECT entity_id FROM rec WHERE entity_id NOT LIKE 'S1-%')""")
def validator_findings(w: World) -> DataFrame:
    bad = w.records.sparkSession.sql(_FAULTY.format(add="array_append", lists="{lists}"), lists=w.lists())
    return audit.validate(bad, tsv.id_lists(w.edges(), w.spine, by_rank=True), w.spine, w.targets)


@_query("SELECT s1, land, CASE WHEN land = 'land 1' THEN array_to_string(ids, ',') WHEN land = 'land 2' THEN coalesce((SELECT string_agg(DISTINCT g.t, ',' ORDER BY g.t) FROM good g WHERE g.s1 = lists.s1), '') ELSE '' END AS ids FROM lists")
def run_mix_by_country(w: World) -> DataFrame:
    runs = {"land 1": w.lists(), "land 2": tsv.id_lists(decide.above(w.edges(), 0.4), w.spine)}
    return audit.mix_runs(w.spine, runs).select("s1", "land", F.array_join("ids", ",").alias("ids"))


_CRC = "list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split(entity_id, ''), lambda x: list_concat([ord(x)::BIGINT], [-1, -1, -1, -1, -1, -1, -1, -1]::BIGINT[])))), lambda c, e: CASE WHEN e >= 0 THEN xor(c, e) ELSE xor(c >> 1, 3988292384::BIGINT * (c & 1)) END)"


@_query(f"SELECT entity_id FROM rec WHERE xor({_CRC}, 4294967295::BIGINT) % 4 = 1")
def shard_filter(w: World) -> DataFrame:
    return tsv.in_shard(w.records, 1, 4).select("entity_id")


@_query("SELECT DISTINCT lower(trim(country)) AS land FROM rec")
def discovered_countries(w: World) -> DataFrame:
    return w.spark.createDataFrame([(c,) for c in tsv.countries(w.records)], "land string")


@_query("SELECT entity_id, country FROM rec WHERE lower(trim(country)) = 'land 3'")
def country_filter(w: World) -> DataFrame:
    return tsv.in_country(w.records, " LAND 3 ").select("entity_id", "country")


@_query("SELECT s1, t, score::DOUBLE AS score, method_count::INT AS method_count, rank FROM edges")
def index_candidates(w: World) -> DataFrame:
    return w.index().candidates(w.sources, CAP, LIMIT, FALLBACK, stage1=None).select("s1", "t", "score", "method_count", "rank")


@_query("SELECT n.entity_id, clean AS name_clean, land FROM norm n SEMI JOIN (SELECT DISTINCT t AS entity_id FROM good) USING (entity_id)")
def index_lookup(w: World) -> DataFrame:
    return w.index().lookup(decide.above(w.edges(), 0.4).select(F.col("t").alias("entity_id"))).select("entity_id", "name_clean", "land")


def _parts(w: World, n: int) -> list:
    """A run's spine, candidates and qualified pairs, cut into ranges of the records in the order of their numbers."""
    spine = w.spine.select("s1", F.substring("s1", 4, 20).cast("long").alias("_ord"))
    edges = w.edges().join(spine, "s1")
    size = F.ceil(F.lit(spine.count()) / n)
    within = lambda df, i: df.where(F.floor(F.col("_ord") / size) == i)
    return [(within(spine, i), within(edges, i), decide.above(within(edges, i), 0.4)) for i in range(n)]


@_query("SELECT s1, array_to_string(ids, ',') AS ids, coalesce(c, '') AS candidates FROM lists LEFT JOIN (SELECT s1, string_agg(t, ',' ORDER BY rank) AS c FROM edges GROUP BY 1) USING (s1)")
def merged_ranges(w: World) -> DataFrame:
    spine, results, candidates = ranges.merge_parts(_parts(w, 3))
    return results.join(candidates.withColumnRenamed("ids", "c"), "s1").select("s1", F.array_join("ids", ",").alias("ids"), F.array_join("c", ",").alias("candidates"))


@_query("SELECT s1, array_to_string(ids, ',') AS ids FROM lists")
def concatenated_partitions(w: World) -> DataFrame:
    lists = w.lists().join(w.spine, "s1")
    parts = {c: lists.where(F.col("land") == c) for c in tsv.countries(w.sources)}
    return ranges.concatenate(parts).select("s1", F.array_join("ids", ",").alias("ids"))


@_query("SELECT (SELECT count(*) FROM lists) AS sources, (SELECT count(*) FROM edges) AS candidate_edges, (SELECT count(*) FROM won) AS matched_edges, (SELECT count(*) - count(DISTINCT t) FROM good) AS collisions")
def inference_totals(w: World) -> DataFrame:
    return decide.totals(w.lists(), tsv.id_lists(w.edges(), w.spine, by_rank=True), decide.above(w.edges(), 0.4))


@_query(f""", g AS (SELECT DISTINCT unnest(list_transform(range(101), lambda i: i / 100.0))::DOUBLE AS threshold UNION SELECT p FROM edges WHERE (SELECT count(*) FROM edges) <= {decide.OBSERVED}),
win AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY t ORDER BY p DESC, s1) AS r FROM edges) WHERE r = 1), nt AS (SELECT s1, count(t) AS nt FROM spine LEFT JOIN truth USING (s1) GROUP BY 1),
y AS (SELECT g.threshold, win.s1, count(*) AS np, count(truth.s1) AS nh FROM g JOIN win ON win.p >= g.threshold LEFT JOIN truth USING (s1, t) GROUP BY ALL),
z AS (SELECT threshold, coalesce(np, 0) AS np, CASE WHEN coalesce(np, 0) = 0 THEN 1.0 ELSE nh::DOUBLE / np END AS p, CASE WHEN nt = 0 THEN (CASE WHEN coalesce(np, 0) = 0 THEN 1.0 ELSE 0.0 END) ELSE coalesce(nh, 0)::DOUBLE / nt END AS r FROM (SELECT * FROM g, nt) LEFT JOIN y USING (threshold, s1)),
f AS (SELECT threshold, round(avg(CASE WHEN p <= 0 OR r <= 0 THEN 0.0 ELSE 1.25 * p * r / (0.25 * p + r) END), 9)::DOUBLE AS f, sum(np)::BIGINT AS edges FROM z GROUP BY 1)
SELECT threshold, round(f, 6) AS f, edges FROM f ORDER BY f.f DESC, threshold DESC LIMIT 1""")
def selected_threshold(w: World) -> DataFrame:
    threshold, figures = decide.select_threshold(w.spine, w.edges(), w.truth)
    return w.spark.createDataFrame([(threshold, round(figures["f"], 6), figures["edges"])], "threshold double, f double, edges long")


@_query(f""", g AS (SELECT unnest({GRID}::DOUBLE[]) AS threshold), nt AS (SELECT s1, count(t) AS nt FROM spine LEFT JOIN truth USING (s1) GROUP BY 1),
y AS (SELECT g.threshold, e.s1, count(*) AS np, count(truth.s1) AS nh FROM g JOIN edges e ON e.p >= g.threshold LEFT JOIN truth USING (s1, t) GROUP BY ALL),
z AS (SELECT threshold, coalesce(np, 0) AS np, CASE WHEN coalesce(np, 0) = 0 THEN 1.0 ELSE nh::DOUBLE / np END AS p, CASE WHEN nt = 0 THEN (CASE WHEN coalesce(np, 0) = 0 THEN 1.0 ELSE 0.0 END) ELSE coalesce(nh, 0)::DOUBLE / nt END AS r FROM (SELECT * FROM g, nt) LEFT JOIN y USING (threshold, s1))
SELECT threshold, round(avg(CASE WHEN p <= 0 OR r <= 0 THEN 0.0 ELSE 1.25 * p * r / (0.25 * p + r) END), 6)::DOUBLE AS f, round(avg(p), 6)::DOUBLE AS precision, round(avg(r), 6)::DOUBLE AS recall, sum(np)::BIGINT AS edges, count(*) FILTER (np = 0) AS empty FROM z GROUP BY 1""")
def threshold_curve_independent(w: World) -> DataFrame:
    return decide.threshold_sweep(w.spine, w.edges(), w.truth, GRID, alone=False).select("threshold", *_six("f", "precision", "recall"), "edges", "empty")


@_query(f""", v AS (SELECT * FROM spine WHERE {_BUCKET.format(SEED, 's1')} < 0.2), per AS (SELECT v.s1, v.land, count(t) FILTER (t LIKE 'S2-%') AS s2, count(t) FILTER (t LIKE 'S3-%') AS s3 FROM v LEFT JOIN truth USING (s1) GROUP BY ALL)
SELECT land, count(*) AS entities, sum(s2 + s3)::BIGINT AS edges, sum(s2)::BIGINT AS s2_edges, sum(s3)::BIGINT AS s3_edges, count(*) FILTER (s2 + s3 = 0) AS singletons, count(*) FILTER ({_BUCKET.format(SEED + 1, 's1')} >= 0.5) AS overlap FROM per GROUP BY 1""")
def split_statistics(w: World) -> DataFrame:
    validation = decide.split(w.spine, 0.2, SEED).where("validation")
    return audit.split_statistics(w.spine, w.truth, validation, decide.split(w.spine, 0.5, SEED + 1).where("not validation"))


@_query("SELECT source, count(*) AS links, count(r.s1) AS found, round(count(r.s1) / count(*)::DOUBLE, 6) AS recall FROM (SELECT s1, t, unnest(['all', lower(substr(t, 1, 2))]) AS source FROM truth) LEFT JOIN ranked r USING (s1, t) GROUP BY 1")
def recall_by_source(w: World) -> DataFrame:
    return audit.recall_by_source(w.ranked(), w.truth).select("source", "links", "found", *_six("recall"))


@_query(""", part AS (SELECT unnest(['all', 's2', 's3']) AS part), real AS (SELECT part, s1, t FROM part, truth WHERE part = 'all' OR part = lower(substr(t, 1, 2))), pred AS (SELECT part, s1, t FROM part, won WHERE part = 'all' OR part = lower(substr(t, 1, 2))),
n AS (SELECT part, s1, (SELECT count(*) FROM truth x WHERE x.s1 = spine.s1) AS links, coalesce(np, 0) AS np, coalesce(nt, 0) AS nt, coalesce(nh, 0) AS nh FROM part CROSS JOIN spine
  LEFT JOIN (SELECT part, s1, count(*) AS np FROM pred GROUP BY ALL) USING (part, s1) LEFT JOIN (SELECT part, s1, count(*) AS nt FROM real GROUP BY ALL) USING (part, s1) LEFT JOIN (SELECT part, s1, count(*) AS nh FROM pred JOIN real USING (part, s1, t) GROUP BY ALL) USING (part, s1)),
m AS (SELECT *, CASE WHEN np = 0 THEN 1.0 ELSE nh::DOUBLE / np END AS p, CASE WHEN nt = 0 THEN (CASE WHEN np = 0 THEN 1.0 ELSE 0.0 END) ELSE nh::DOUBLE / nt END AS r FROM n),
u AS (SELECT unnest(CASE WHEN part = 'all' THEN ['all', CASE WHEN links = 0 THEN 'singleton' ELSE 'nonsingleton' END] ELSE [part] END) AS part, np, nt, nh, p, r FROM m)
SELECT part, count(*) AS entities, round(avg(p), 6)::DOUBLE AS precision, round(avg(r), 6)::DOUBLE AS recall, round(avg(CASE WHEN p <= 0 OR r <= 0 THEN 0.0 ELSE 1.25 * p * r / (0.25 * p + r) END), 6)::DOUBLE AS f05, round(avg(CASE WHEN p <= 0 OR r <= 0 THEN 0.0 ELSE 2 * p * r / (p + r) END), 6)::DOUBLE AS f1,
  sum(np)::BIGINT AS predicted, sum(nt)::BIGINT AS actual, sum(np - nh)::BIGINT AS wrong, sum(nt - nh)::BIGINT AS lost FROM u GROUP BY 1""")
def split_metrics(w: World) -> DataFrame:
    return audit.split_metrics(w.spine, w.won(), w.truth).select("part", "entities", *_six("precision", "recall", "f05", "f1"), "predicted", "actual", "wrong", "lost")


@_query("SELECT CASE WHEN c = 0 THEN '0' WHEN c <= 5 THEN '1-5' WHEN c <= 10 THEN '6-10' WHEN c <= 20 THEN '11-20' WHEN c <= 50 THEN '21-50' ELSE '>50' END AS value, count(*) AS n FROM (SELECT spine.s1, count(t) AS c FROM spine LEFT JOIN ranked USING (s1) GROUP BY 1) GROUP BY 1")
def candidate_buckets(w: World) -> DataFrame:
    return audit.candidate_buckets(w.spine, w.ranked())


@_query(""", m AS (SELECT s1, coalesce(max(p), 0) AS best, coalesce(max(p), 0) - coalesce(max(CASE WHEN r = 2 THEN p END), 0) AS margin FROM spine LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY s1 ORDER BY p DESC, t) AS r FROM edges) e USING (s1) WHERE r IS NULL OR r <= 2 GROUP BY 1)
SELECT round(avg(best), 6)::DOUBLE AS mean_best, round(avg(margin), 6)::DOUBLE AS mean_margin, count(*) FILTER (best >= 0.4 AND margin >= 0.05) AS margin_05, count(*) FILTER (best >= 0.4 AND margin >= 0.1) AS margin_10, count(*) FILTER (best >= 0.4 AND margin >= 0.2) AS margin_20 FROM m""")
def margin_counts(w: World) -> DataFrame:
    return audit.margin_counts(w.spine, w.edges(), 0.4).select(*_six("mean_best", "mean_margin"), "margin_05", "margin_10", "margin_20")


_NAMES = _listed(METHODS)
_PREFIX = "(length(a.na) >= {0} AND length(b.na) >= {0} AND substr(a.na, 1, {0}) = substr(b.na, 1, {0}))::INT AS prefix{0}"


@_query(f""", lost AS (SELECT truth.* FROM truth ANTI JOIN (SELECT s1, t FROM ranked WHERE rank = 1) r USING (s1, t)), side AS (SELECT *, CASE WHEN core <> '' THEN core ELSE clean END AS na FROM norm),
sh AS (SELECT l.s1, l.t, list_sort(list(DISTINCT x.method)) AS m, count(*) AS shared FROM lost l JOIN sk x ON x.entity_id = l.s1 JOIN tk y ON y.entity_id = l.t AND y.method = x.method AND y.key = x.key GROUP BY 1, 2),
ov AS (SELECT entity_id AS s1, count(*) AS over_limit FROM sk JOIN kc USING (method, key) WHERE n > 20 GROUP BY 1)
SELECT l.s1, l.t, coalesce(array_to_string(list_transform(m, lambda i: {_NAMES}[i + 1]), '|'), 'NONE') AS methods, coalesce(shared, 0) AS shared, coalesce(over_limit, 0) AS over_limit, {", ".join(_PREFIX.format(k) for k in (4, 6, 8))},
  round({_JACCARD.format(_TOKENS.format("a.na"), _TOKENS.format("b.na"))}, 6) AS name_jaccard, round({_JACCARD.format(_TOKENS.format("a.address"), _TOKENS.format("b.address"))}, 6) AS address_jaccard, coalesce(a.postal = b.postal, false)::INT AS postal_agree, false AS target_missing
FROM lost l LEFT JOIN sh USING (s1, t) LEFT JOIN ov USING (s1) JOIN side a ON a.entity_id = l.s1 JOIN side b ON b.entity_id = l.t""")
def miss_details(w: World) -> DataFrame:
    lost = w.truth.join(w.ranked().where("rank = 1").select("s1", "t"), ["s1", "t"], "left_anti")
    out = audit.attributed_misses(lost, w.sources, w.targets, w.source_keys, w.target_keys, blocking.key_counts(w.target_keys), 20, list(METHODS))
    return out.select("s1", "t", "methods", "shared", "over_limit", "prefix4", "prefix6", "prefix8", *_six("name_jaccard", "address_jaccard"), "postal_agree", "target_missing")


@_query("SELECT e.s1, e.t, e.p FROM edges e SEMI JOIN truth USING (s1, t) WHERE p < 0.9 ORDER BY p DESC, s1, t LIMIT 100")
def top_false_negatives(w: World) -> DataFrame:
    return w.edges().where("p < 0.9").join(w.truth, ["s1", "t"], "left_semi").orderBy(F.desc("p"), "s1", "t").limit(100).select("s1", "t", "p")


@_query("""SELECT bucket, count(*) AS pairs, count(*) FILTER (hit) AS true, count(*) FILTER (pred) AS pred, count(*) FILTER (hit AND pred) AS tp, round(CASE WHEN count(*) FILTER (pred) = 0 THEN 1 ELSE count(*) FILTER (hit AND pred) / (count(*) FILTER (pred))::DOUBLE END, 6) AS precision, round(CASE WHEN count(*) FILTER (hit) = 0 THEN 1 ELSE count(*) FILTER (hit AND pred) / (count(*) FILTER (hit))::DOUBLE END, 6) AS recall
FROM (SELECT CASE WHEN c <= 1 THEN '1' WHEN c <= 5 THEN '2-5' WHEN c <= 10 THEN '6-10' WHEN c <= 50 THEN '11-50' WHEN c <= 100 THEN '51-100' ELSE '>100' END AS bucket, truth.s1 IS NOT NULL AS hit, p >= 0.4 AS pred
  FROM edges JOIN (SELECT entity_id AS t, count(*) OVER (PARTITION BY clean) AS c FROM norm WHERE entity_id NOT LIKE 'S1-%') USING (t) LEFT JOIN truth USING (s1, t)) GROUP BY 1""")
def metrics_by_name_frequency(w: World) -> DataFrame:
    return audit.metrics_by_frequency(w.edges(), w.truth, w.targets, 0.4).select("bucket", "pairs", "true", "pred", "tp", *_six("precision", "recall"))


@_query("SELECT clean AS name, count(*) AS c FROM norm WHERE entity_id NOT LIKE 'S1-%' AND clean <> '' GROUP BY 1 ORDER BY c DESC, name LIMIT 20")
def top_names(w: World) -> DataFrame:
    return audit.top_names(w.targets)


@_query(f"""SELECT land, count(*) AS n, round(avg((postal IS NOT NULL)::INT), 6) AS postal, round(avg((city IS NOT NULL)::INT), 6) AS city, round(avg((house IS NOT NULL)::INT), 6) AS house, round(avg((NOT regexp_full_match(business_name, '[[:ascii:]]*'))::INT), 6) AS beyond_ascii,
  round(avg(len({_TOKENS.format("CASE WHEN core <> '' THEN core ELSE clean END")})), 6) AS name_tokens, round(avg(len({_TOKENS.format("address")})), 6) AS address_tokens, round(avg((trim(business_address) = '')::INT), 6) AS blank_address FROM norm GROUP BY 1""")
def field_rates(w: World) -> DataFrame:
    return audit.field_rates(w.norm).select("land", "n", *_six("postal", "city", "house", "beyond_ascii", "name_tokens", "address_tokens", "blank_address"))


@_query(""", inside AS (SELECT s1, t FROM (SELECT good.*, row_number() OVER (PARTITION BY t, land ORDER BY p DESC, s1) AS r FROM good JOIN spine USING (s1)) WHERE r = 1),
n AS (SELECT 'all' AS land, s1, np, nt, nh FROM spine LEFT JOIN (SELECT s1, count(*) AS np, count(truth.s1) AS nh FROM won LEFT JOIN truth USING (s1, t) GROUP BY 1) USING (s1) LEFT JOIN (SELECT s1, count(*) AS nt FROM truth GROUP BY 1) USING (s1)
  UNION ALL SELECT land, s1, np, nt, nh FROM spine LEFT JOIN (SELECT s1, count(*) AS np, count(truth.s1) AS nh FROM inside LEFT JOIN truth USING (s1, t) GROUP BY 1) USING (s1) LEFT JOIN (SELECT s1, count(*) AS nt FROM truth GROUP BY 1) USING (s1)),
m AS (SELECT land, CASE WHEN np IS NULL THEN 1.0 ELSE nh::DOUBLE / np END AS p, CASE WHEN nt IS NULL THEN (CASE WHEN np IS NULL THEN 1.0 ELSE 0.0 END) ELSE coalesce(nh, 0)::DOUBLE / nt END AS r FROM n)
SELECT land, count(*) AS entities, round(avg(p), 6)::DOUBLE AS precision, round(avg(r), 6)::DOUBLE AS recall, round(avg(CASE WHEN p <= 0 OR r <= 0 THEN 0.0 ELSE 1.25 * p * r / (0.25 * p + r) END), 6)::DOUBLE AS f FROM m GROUP BY 1""")
def evaluation_by_country(w: World) -> DataFrame:
    return linkage.evaluate_by_country(w.spine, w.edges(), w.truth, 0.4).select("land", "entities", *_six("precision", "recall", "f"))


@_query("SELECT CASE WHEN len(ids) > 2 THEN '>2' ELSE len(ids)::VARCHAR END AS value, count(*) AS n FROM lists GROUP BY 1")
def output_distribution(w: World) -> DataFrame:
    return audit.output_distribution(w.lists(), 2)


@_query(""", base AS (SELECT spine.s1, coalesce(list(t) FILTER (t IS NOT NULL), []) AS y FROM spine LEFT JOIN (SELECT s1, t FROM edges WHERE rank = 1) USING (s1) GROUP BY 1)
SELECT (sum(len(ids)) - sum(len(y)))::BIGINT AS edge_delta, (count(*) FILTER (len(ids) = 0) - count(*) FILTER (len(y) = 0))::BIGINT AS empty_delta, sum(len(list_filter(ids, lambda x: NOT list_contains(y, x))))::BIGINT AS added, sum(len(list_filter(y, lambda x: NOT list_contains(ids, x))))::BIGINT AS dropped FROM lists JOIN base USING (s1)""")
def run_deltas(w: World) -> DataFrame:
    return audit.run_deltas(w.lists(), tsv.id_lists(w.edges().where("rank = 1"), w.spine))


@_query(f""", tg AS (SELECT t, min(s1) AS s1 FROM truth WHERE {_BUCKET.format(SEED, 't')} < least(1.0, 1000 / (SELECT count(*) FROM truth)::DOUBLE) GROUP BY 1),
kinds AS (SELECT CASE WHEN b.land IS NULL THEN 'missing' WHEN b.land = '' THEN 'blank' WHEN a.land = b.land THEN 'same' ELSE 'different' END AS kind FROM tg LEFT JOIN norm a ON a.entity_id = s1 LEFT JOIN norm b ON b.entity_id = t)
SELECT count(*) AS sampled, count(*) FILTER (kind = 'same') AS same, count(*) FILTER (kind = 'different') AS different, count(*) FILTER (kind = 'blank') AS blank, count(*) FILTER (kind = 'missing') AS missing, round(count(*) FILTER (kind = 'same') / (count(*) FILTER (kind IN ('same', 'different')))::DOUBLE, 6) AS ratio FROM kinds""")
def sampled_sanity(w: World) -> DataFrame:
    return audit.sampled_sanity(w.truth, w.sources, w.targets, 1000, SEED).select("sampled", "same", "different", "blank", "missing", *_six("ratio"))


@_query("SELECT entity_id, 'blank_country' AS flags FROM norm WHERE land = '' ORDER BY entity_id LIMIT 20")
def flagged_examples(w: World) -> DataFrame:
    return audit.flagged_examples(w.norm).select("entity_id", F.array_join("flags", ",").alias("flags"))


@_query(f"SELECT s1 FROM spine WHERE {_BUCKET.format(SEED, 's1')} < 0.2 ORDER BY {_BUCKET.format(SEED, 's1')}, s1 LIMIT 100")
def validation_ids(w: World) -> DataFrame:
    return decide.validation_ids(w.spine, 0.2, 100, SEED)


@_query(f"""SELECT (SELECT count(*) FROM spine WHERE {_BUCKET.format(SEED, 's1')} < 0.2) AS entities, a.links, a.found AS found_20, round(a.found / a.links, 6)::DOUBLE AS recall_20, b.found AS found_50, round(b.found / b.links, 6)::DOUBLE AS recall_50, round(b.mean, 6)::DOUBLE AS mean_50
FROM {", ".join(f"(SELECT sum(links)::BIGINT AS links, sum(found)::BIGINT AS found, avg(candidates) AS mean FROM {_RECALL.format(k, 'WHERE ' + _BUCKET.format(SEED, 's1') + ' < 0.2')}) {n}" for n, k in (("a", 20), ("b", 50)))}""")
def blocking_experiment(w: World) -> DataFrame:
    out = audit.blocking_experiment(w.ranked(), w.truth, decide.validation_ids(w.spine, 0.2, None, SEED))
    return out.select("entities", "links", "found_20", *_six("recall_20"), "found_50", *_six("recall_50", "mean_50"))


@_query(f""", bad AS ({_FAULTY.format(add="list_append", lists="lists")}), cand AS (SELECT s1, list(t) AS c FROM edges GROUP BY 1), ids AS (SELECT DISTINCT unnest(ids) AS id FROM bad),
x AS (SELECT 'duplicate_rows' AS rule, s1 AS what FROM bad GROUP BY s1 HAVING count(*) > 1 UNION SELECT 'duplicate_ids', s1 FROM bad WHERE len(ids) <> len(list_distinct(ids))
  UNION SELECT 'self_matches', s1 FROM bad WHERE len(list_filter(ids, lambda i: i LIKE 'S1-%')) > 0 UNION SELECT 'bad_prefix', s1 FROM bad WHERE len(list_filter(ids, lambda i: NOT regexp_matches(i, '^S[123]-'))) > 0
  UNION SELECT 'missing_rows', s1 FROM spine ANTI JOIN bad USING (s1) UNION SELECT 'extra_rows', s1 FROM bad ANTI JOIN spine USING (s1)
  UNION SELECT 'not_candidates', s1 FROM bad LEFT JOIN cand USING (s1) WHERE len(list_filter(ids, lambda i: NOT list_contains(coalesce(c, []), i))) > 0
  UNION SELECT 'unknown_ids', id FROM ids WHERE id NOT IN (SELECT entity_id FROM rec WHERE entity_id NOT LIKE 'S1-%'))
SELECT rule, count(DISTINCT what) AS distinct_n, array_to_string(list_sort(list(DISTINCT what))[:5], ',') AS examples FROM x GROUP BY 1""")
def finding_examples(w: World) -> DataFrame:
    bad = w.records.sparkSession.sql(_FAULTY.format(add="array_append", lists="{lists}"), lists=w.lists())
    out = audit.finding_examples(bad, tsv.id_lists(w.edges(), w.spine, by_rank=True), w.spine, w.targets)
    return out.select("rule", "distinct_n", F.array_join("examples", ",").alias("examples"))


@_query()
def linkage_results(w: World) -> DataFrame:
    raw = w.records
    s1 = F.col("entity_id").startswith("S1-")
    results, _ = linkage.infer(raw.where(s1), raw.where(~s1), cap=CAP, limit=LIMIT, stage1=DEFAULTS.stage1)
    return results.select("s1", F.array_join("ids", ",").alias("ids"))


@_query()
def gbt_quality_model(w: World) -> DataFrame:
    s1 = F.col("entity_id").startswith("S1-")
    model, sweep = linkage.train(w.records.where(s1), w.records.where(~s1), w.truth, iterations=5, cap=CAP, limit=LIMIT, stage1=None)
    return sweep
