"""Defaults of the linkage engine."""
from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Settings:
    """Fixed defaults; every operator takes them as parameters."""

    candidate_cap: int = 50
    bucket_limit: int = 5000
    stage1: int = 2000
    country_fallback: int = 10
    threshold: float = 0.72
    validation_fraction: float = 0.2
    seed: int = 2026
    training_entities: int = 100_000
    max_pairs: int = 500_000


DEFAULTS = Settings()

# Blocking methods in order and their weights in hundredths.
METHODS = {
    "name_core_exact": 100, "name_exact": 96, "name_token_sort": 90, "name_prefix": 55, "name_token": 35,
    "address_postal": 82, "address_house": 72, "address_number": 62, "address_city": 78, "address_token": 30,
}
SAME_COUNTRY = 15

# Legal suffix phrases in match order, and the tokens removed anywhere.
SUFFIXES = (
    "limited liability company", "private limited", "pvt ltd", "incorporated", "corporation", "company limited", "company",
    "limited", "private", "proprietary", "llc", "llp", "l l p", "inc", "ltd", "pvt", "plc", "sarl", "sas", "gmbh", "ag", "bv",
    "nv", "pte", "sa", "co", "corp",
)
STRONG = ("llc", "llp", "inc", "ltd", "limited", "pvt", "private", "corp", "corporation", "plc", "sarl", "sas", "gmbh", "ag", "bv", "nv", "pte", "sa")

# Address abbreviations, further street terms, words that are no city.
STREETS = {
    "rd": "road", "st": "street", "ave": "avenue", "av": "avenue", "blvd": "boulevard", "bvd": "boulevard", "dr": "drive", "ln": "lane",
    "ct": "court", "pl": "place", "sq": "square", "hwy": "highway", "pkwy": "parkway", "cir": "circle", "ter": "terrace", "n": "north",
    "s": "south", "e": "east", "w": "west", "ne": "northeast", "nw": "northwest", "se": "southeast", "sw": "southwest",
}
STREET_TERMS = (*sorted(set(STREETS.values())), "rue", "via", "viale", "strasse", "gasse", "platz")
NO_CITY = ("near", "opposite", "beside", "behind", "front", "adjacent", "next", "floor", "unit", "apartment", "flat", "suite", "ste", "building", "bldg", "landmark", "atm", "post", "office", "po", "box")
NULL_WORDS = ("null", "none", "na")

# Weights of the rule-based score.
INTERCEPT = -5.0
HEURISTIC = {
    "name_core_exact": 4.5, "name_exact": 2.5, "name_token_jaccard": 3.5, "name_token_sort_exact": 1.2, "address_exact": 2.0,
    "address_token_jaccard": 3.0, "address_postal_exact": 1.2, "address_house_exact": 1.5, "address_city_exact": 0.8, "country_exact": 0.8,
    "address_conflict": -12.0, "city_conflict": -18.0, "name_address_name_conflict": -14.0, "country_conflict": -20.0,
    "name_address_disagreement": -6.0, "address_sequence_ratio": 0.6, "name_sequence_ratio": 0.2, "retrieval_score": 0.2,
    "candidate_count": -0.08,
}
