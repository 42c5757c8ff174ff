"""Normalisation of names, addresses and countries.

The native columns cover every step that Spark can express; NFKC, NFKD and case folding have no built-in, so
`fold` goes through one Arrow UDF for a record's three fields together. On ASCII input `lower` gives the same.
"""
from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.config import NO_CITY, NULL_WORDS, STREET_TERMS, STREETS, STRONG, SUFFIXES

_NOT_WORD = re.compile(r"[^\w]+")
_SUFFIX = "(?:(?:^| )(?:" + "|".join(SUFFIXES) + "))+$"


def base_text(x: str | None) -> str:
    """NFKC, case folded, `&` spelled out, everything but word characters to single spaces."""
    return _NOT_WORD.sub(" ", unicodedata.normalize("NFKC", x or "").casefold().replace("&", " and ")).strip()


def fold_accents(x: str) -> str:
    """Without combining marks."""
    return " ".join("".join(c for c in unicodedata.normalize("NFKD", x) if not unicodedata.combining(c)).split())


def folded(c: Column) -> Column:
    """Struct of clean and folded text of a column."""

    @F.arrow_udf("struct<clean:string,folded:string>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            clean = [base_text(x) for x in batch.to_pylist()]
            yield pa.StructArray.from_arrays([pa.array(clean, pa.string()), pa.array([fold_accents(x) for x in clean], pa.string())], ["clean", "folded"])

    return run(c)


def clean_native(c: Column) -> Column:
    """base_text in built-in functions: the same on text without compatibility forms."""
    return F.trim(F.regexp_replace(F.replace(F.replace(F.lower(F.coalesce(c, F.lit(""))), F.lit("ß"), F.lit("ss")), F.lit("&"), F.lit(" and ")), r"[^\p{L}\p{N}_]+", " "))


def tokens(c: Column) -> Column:
    return F.filter(F.split(c, " "), lambda t: t != "")


def core(clean: Column) -> Column:
    """Without trailing legal suffixes, then without strong legal tokens anywhere."""
    left = F.regexp_replace(clean, _SUFFIX, "")
    return F.array_join(F.filter(tokens(left), lambda t: ~t.isin(*STRONG)), " ")


def suffix_tokens(clean: Column) -> Column:
    tail = tokens(F.regexp_extract(clean, "(" + _SUFFIX + ")", 1))
    inner = F.filter(tokens(F.regexp_replace(clean, _SUFFIX, "")), lambda t: t.isin(*STRONG))
    return F.concat(tail, inner)


def token_sort(clean: Column) -> Column:
    return F.array_join(F.array_sort(tokens(clean)), " ")


def expand(clean: Column) -> Column:
    """Address tokens with abbreviations spelled out."""
    table = F.create_map(*(F.lit(x) for kv in STREETS.items() for x in kv))
    return F.array_join(F.transform(tokens(clean), lambda t: F.coalesce(F.try_element_at(table, t), t)), " ")


def numbers(clean: Column) -> Column:
    return F.regexp_extract_all(clean, F.lit(r"(\p{Nd}+)"), F.lit(1))


def postal(clean: Column) -> Column:
    """The first whole run of five or six digits; null without one."""
    return F.nullif(F.regexp_extract(clean, r"(?<!\p{Nd})(\p{Nd}{5,6})(?!\p{Nd})", 1), F.lit(""))


def house(clean: Column) -> Column:
    """The first token that starts with a digit, or a letter and a digit, once reduced to [a-z0-9]; null without one."""
    return F.try_element_at(F.filter(F.transform(tokens(clean), lambda t: F.regexp_replace(t, "[^a-z0-9]", "")), lambda t: t.rlike("^[a-z]?[0-9]")), F.lit(1))


def city(expanded: Column) -> Column:
    """For each street term before the last token, the first later token that is neither noise nor a number."""
    ts = tokens(expanded)
    after = F.transform(ts, lambda t, i: F.when(t.isin(*STREET_TERMS), F.try_element_at(F.filter(F.slice(ts, i + 2, F.greatest(F.size(ts), F.lit(1))), lambda u: ~u.isin(*NO_CITY) & ~u.rlike("^[0-9]+$")), F.lit(1))))
    return F.try_element_at(F.filter(after, lambda x: x.isNotNull()), F.lit(1))


def country(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), r"\s+", " "))


def light(c: Column) -> Column:
    """Lower case, everything but [a-z0-9] to single spaces: accents are dropped, not folded."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), "[^a-z0-9]+", " "))


def grams(lightened: Column) -> Column:
    """Distinct character trigrams with `_` for spaces."""
    s = F.replace(lightened, F.lit(" "), F.lit("_"))
    return F.when(F.length(s) >= 3, F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(s) - 2), lambda i: F.substring(s, i, F.lit(3))))).otherwise(F.array().cast("array<string>"))


def flags(name: Column, address: Column, land: Column) -> Column:
    """Anomaly flags of a record's raw fields."""
    n, a, suffix = clean_native(name), clean_native(address), suffix_tokens(clean_native(name))
    rules = {
        "blank_name": n == "", "null_name": n.isin(*NULL_WORDS), "multiple_legal_suffixes": F.size(suffix) > F.size(F.array_distinct(suffix)), "blank_address": a == "", "null_address": a.isin(*NULL_WORDS),
        "address_without_letters": (a != "") & ~a.rlike(r"\p{L}"), "address_without_numbers": (a != "") & ~a.rlike(r"\p{Nd}"), "blank_country": country(land) == "",
    }
    return F.array_compact(F.array(*(F.when(c, F.lit(k)) for k, c in rules.items())))


def normalise(records: DataFrame, exact: bool = True) -> DataFrame:
    """Records with all normalised fields; raw fields stay. exact=False uses built-in functions only."""
    if exact:
        both = records.withColumn("_n", folded(F.col("business_name"))).withColumn("_a", folded(F.col("business_address")))
        clean, fold, address, address_fold = F.col("_n.clean"), F.col("_n.folded"), F.col("_a.clean"), F.col("_a.folded")
    else:
        both = records.withColumn("_n", clean_native(F.col("business_name"))).withColumn("_a", clean_native(F.col("business_address")))
        clean = fold = F.col("_n")
        address = address_fold = F.col("_a")
    expanded = expand(address)
    out = both.select(
        *records.columns, clean.alias("name_clean"), fold.alias("name_folded"), core(clean).alias("name_core"), core(fold).alias("core_folded"), suffix_tokens(clean).alias("suffix"), token_sort(clean).alias("token_sort"),
        expanded.alias("address_clean"), expand(address_fold).alias("address_folded"), numbers(expanded).alias("numbers"), house(address).alias("house"), postal(expanded).alias("postal"), city(expanded).alias("city"),
        country(F.col("country")).alias("land"), flags(F.col("business_name"), F.col("business_address"), F.col("country")).alias("flags"),
    )
    return out
