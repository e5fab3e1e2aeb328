"""Pair similarities as column expressions; token arrays are prepared once a record."""

from __future__ import annotations

import math
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

#: The model's columns, in the contract's order.
FEATURES = [
    "name_jaccard", "name_core_jaccard", "name_levenshtein", "name_token_sort", "name_token_set", "name_sequence", "name_cosine", "name_tfidf_cosine",
    "address_jaccard", "address_levenshtein", "address_token_sort", "address_token_set", "address_sequence", "address_cosine", "address_tfidf_cosine",
    "country_match", "name_length_delta", "address_length_delta",
]
SEQUENCE = ("name_sequence", "address_sequence")
_RARE = math.log(3 / 2) + 1  # smoothed weight of a term that one of two texts has; 1 if both have it


def jaccard(a: Column, b: Column) -> Column:
    """Set Jaccard of two arrays; 1 for two empty ones."""
    return F.coalesce(F.try_divide(F.size(F.array_intersect(a, b)).cast("double"), F.size(F.array_union(a, b)).cast("double")), F.lit(1.0))


def levenshtein_ratio(a: Column, b: Column) -> Column:
    longest = F.greatest(F.length(a), F.length(b))
    return F.when(a == b, 1.0).when((F.length(a) == 0) | (F.length(b) == 0), 0.0).otherwise(1 - F.levenshtein(a, b) / longest)


def sorted_text(tokens: Column) -> Column:
    return F.array_join(F.array_sort(tokens), " ")


def sorted_set_text(tokens: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(tokens)), " ")


def trigrams(text: Column) -> Column:
    """Distinct runs of three characters, spaces included; none below three."""
    squeezed = F.regexp_replace(text, r"\s+", " ")
    grams = F.transform(F.sequence(F.lit(1), F.greatest(F.length(squeezed) - 2, F.lit(1))), lambda i: F.substring(squeezed, i, F.lit(3)))
    return F.when(F.length(squeezed) >= 3, F.array_distinct(grams)).otherwise(F.array().cast("array<string>"))


def set_cosine(a: Column, b: Column) -> Column:
    both = F.size(F.array_intersect(a, b)).cast("double")
    return F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).otherwise(F.coalesce(F.try_divide(both, F.sqrt(F.size(a).cast("double") * F.size(b))), F.lit(0.0)))


def tfidf_cosine(a: Column, b: Column) -> Column:
    """Cosine of two token arrays weighted by counts and two-text document frequency."""
    count = lambda tokens, t: F.size(F.filter(tokens, lambda x: x == t)).cast("double")
    total = lambda xs: F.aggregate(xs, F.lit(0.0), lambda s, x: s + x)

    def mass(own: Column, other: Column) -> Column:
        weight = lambda t: F.when(F.array_contains(other, t), 1.0).otherwise(_RARE**2)
        return total(F.transform(F.array_distinct(own), lambda t: F.pow(count(own, t), F.lit(2.0)) * weight(t)))

    both = total(F.transform(F.array_intersect(a, b), lambda t: count(a, t) * count(b, t)))
    score = F.coalesce(F.try_divide(both, F.sqrt(mass(a, b) * mass(b, a))), F.lit(0.0))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).otherwise(score)


@F.pandas_udf(DoubleType())
def _matcher_ratio(left: pd.Series, right: pd.Series) -> pd.Series:
    known: dict[tuple[str, str], float] = {}
    out = []
    for pair in zip(left, right, strict=True):
        if pair not in known:
            known[pair] = SequenceMatcher(None, *pair).ratio()
        out.append(known[pair])
    return pd.Series(out, dtype="float64")


def sequence_ratio(a: Column, b: Column) -> Column:
    """Matching-blocks ratio of two texts (not symmetric); equal texts skip Python's work."""
    return _matcher_ratio(F.when(a == b, F.lit("")).otherwise(a), F.when(a == b, F.lit("")).otherwise(b))


def prepared(prefix: str) -> list[Column]:
    """Per-record columns that the pair features need, under a prefix."""
    p = lambda c, n: c.alias(f"{prefix}_{n}")
    out = [p(F.col("country"), "country"), p(F.filter(F.split("name_core", " "), lambda w: w != ""), "core_tokens")]
    for field in ("name", "address"):
        t = F.col(f"{field}_tokens")
        out += [p(F.col(f"{field}_norm"), f"{field}_norm"), p(t, f"{field}_tokens"), p(sorted_text(t), f"{field}_sorted"), p(sorted_set_text(t), f"{field}_set"), p(trigrams(F.col(f"{field}_norm")), f"{field}_grams")]
    return out


def native_features(l: str = "l", r: str = "r") -> dict[str, Column]:
    """All features that need no Python, from prepared columns."""
    c = lambda side, n: F.col(f"{side}_{n}")
    out = {"name_core_jaccard": jaccard(c(l, "core_tokens"), c(r, "core_tokens")), "country_match": (c(l, "country") == c(r, "country")).cast("double")}
    for f in ("name", "address"):
        pair = lambda n, f=f: (c(l, f"{f}_{n}"), c(r, f"{f}_{n}"))
        out |= {
            f"{f}_jaccard": jaccard(*pair("tokens")),
            f"{f}_levenshtein": levenshtein_ratio(*pair("norm")),
            f"{f}_token_sort": levenshtein_ratio(*pair("sorted")),
            f"{f}_token_set": levenshtein_ratio(*pair("set")),
            f"{f}_cosine": set_cosine(*pair("grams")),
            f"{f}_tfidf_cosine": tfidf_cosine(*pair("tokens")),
            f"{f}_length_delta": F.abs(F.length(pair("norm")[0]) - F.length(pair("norm")[1])).cast("double"),
        }
    return out


def sequence_features(l: str = "l", r: str = "r") -> dict[str, Column]:
    return {f"{f}_sequence": sequence_ratio(F.col(f"{l}_{f}_norm"), F.col(f"{r}_{f}_norm")) for f in ("name", "address")}
