"""Text normalisation as native column expressions."""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The record-linkage contract names these expansions and suffixes.
ABBREVIATIONS = {
    "corp": "corporation",
    "co": "company",
    "inc": "incorporated",
    "pvt": "private",
    "ltd": "limited",
    "llc": "limited liability company",
    "rd": "road",
    "st": "street",
    "str": "street",
    "ave": "avenue",
    "av": "avenue",
    "blvd": "boulevard",
    "dr": "drive",
    "hwy": "highway",
    "ln": "lane",
    "ct": "court",
    "apt": "apartment",
    "ste": "suite",
}
LEGAL_SUFFIXES = ("corporation", "company", "incorporated", "limited", "private", "limited liability company")
#: Joins the words of one expansion until suffixes are cut; cannot occur in normalised text.
GLUE = "~"


@lru_cache(1)
def _decompositions() -> tuple[str, str, str, dict[str, str]]:
    """Deleted characters (a regex class), 1:1 sources and targets, 1:n map.

    Follows Unicode compatibility decomposition without combining marks, for every
    code point whose decomposition holds an ASCII character or nothing but marks.
    Other characters stay: normalised text drops them either way.
    """
    gone: list[int] = []
    one, to, many = [], [], {}
    for cp in range(0x80, sys.maxunicode + 1):
        if 0xD800 <= cp < 0xE000:
            continue
        ch = chr(cp)
        full = unicodedata.normalize("NFKD", ch)
        kept = "".join(c for c in full if not unicodedata.combining(c))
        if not kept:
            gone.append(cp)
        elif kept != ch and any(c < "\x80" for c in kept):
            if len(kept) == 1:
                one.append(ch)
                to.append(kept)
            else:
                many[ch] = kept
    ranges, start = [], None
    for i, cp in enumerate(gone):
        start = cp if start is None else start
        if i + 1 == len(gone) or gone[i + 1] != cp + 1:
            ranges.append(f"\\x{{{start:X}}}-\\x{{{cp:X}}}")
            start = None
    return "[" + "".join(ranges) + "]", "".join(one), "".join(to), many


def _map(items: dict[str, str]) -> Column:
    """A constant map from one literal: hundreds of literals would cost seconds of planning."""
    return F.str_to_map(F.lit("\n".join(f"{k}\t{v}" for k, v in items.items())), F.lit("\n"), F.lit("\t"))


def transliterate(text: Column) -> Column:
    """Compatibility decomposition without combining marks, as far as it yields ASCII."""
    gone, one, to, many = _decompositions()
    # the long classes are slow a character, so cheap supersets guard them; marks newer than
    # the JVM count as unassigned there
    bare = F.when(text.rlike(r"[\p{M}\p{Cn}\x{FF9E}\x{FF9F}]"), F.regexp_replace(text, gone, "")).otherwise(text)
    plain = F.translate(bare, one, to)
    wide = "[" + "".join(f"\\x{{{ord(c):X}}}" for c in many) + "]"
    table = _map(many)
    each = F.transform(F.regexp_extract_all(plain, F.lit("(?s)."), F.lit(0)), lambda c: F.coalesce(F.try_element_at(table, c), c))
    full = F.when(plain.rlike(r"[\x{BC}-\x{BE}\x{132}-\x{10FFFF}]") & plain.rlike(wide), F.array_join(each, "")).otherwise(plain)
    return F.when(text.rlike(r"[^\x00-\x7F]"), full).otherwise(text)


def _expanded(text: Column) -> Column:
    """Normalised words joined by spaces; the words of one expansion are glued."""
    clean = F.replace(F.lower(transliterate(text.cast("string"))), F.lit("&"), F.lit(" and "))
    clean = F.trim(F.regexp_replace(clean, "[^a-z0-9]+", " "))
    table = _map({k: v.replace(" ", GLUE) for k, v in ABBREVIATIONS.items()})
    return F.array_join(F.transform(F.split(clean, " "), lambda w: F.coalesce(F.try_element_at(table, w), w)), " ")


def _unglued(text: Column) -> Column:
    return F.replace(text, F.lit(GLUE), F.lit(" "))


def _finished(expanded: Column, remove_suffix: bool) -> Column:
    forms = "|".join(s.replace(" ", GLUE) for s in LEGAL_SUFFIXES)
    # possessive: the JVM would recurse once for each of many trailing forms
    words = F.regexp_replace(expanded, f"((^| )({forms})(?= |$))++$", "") if remove_suffix else expanded
    return F.trim(_unglued(words))


def normalize_text(text: Column, remove_suffix: bool = False) -> Column:
    """Lower-case ASCII words with abbreviations expanded; remove_suffix cuts trailing legal forms."""
    return _finished(_expanded(text), remove_suffix)


def tokens(normal: Column) -> Column:
    return F.filter(F.split(normal, " "), lambda w: w != "")


def blank(text: Column) -> Column:
    """Whether nothing but white space (Unicode) is there."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "") == ""


def add_normalized_columns(records: DataFrame) -> DataFrame:
    """records + name_norm, name_core, address_norm, name_tokens, address_tokens."""
    r = records.withColumns({"_name": _expanded(F.col("business_name")), "_address": _expanded(F.col("business_address"))})
    r = r.withColumns({"name_norm": _finished(F.col("_name"), False), "name_core": _finished(F.col("_name"), True), "address_norm": _finished(F.col("_address"), False)})
    return r.drop("_name", "_address").withColumns({"name_tokens": tokens(F.col("name_norm")), "address_tokens": tokens(F.col("address_norm"))})


def blocking_tokens(name_tokens: Column, address_tokens: Column) -> Column:
    """Distinct tokens of name and address together, of two characters or more."""
    return F.filter(F.array_union(name_tokens, address_tokens), lambda t: F.length(t) >= 2)


#: ASCII letters in lower case and digits stay, any other byte parts words.
_BYTES = bytes(ord(chr(i).lower()) if i < 0x80 and chr(i).isalnum() else 0x20 for i in range(256))
_EXPANSIONS = {k.encode(): v.encode().split() for k, v in ABBREVIATIONS.items()}


def token_set(text: str) -> set[bytes]:
    """The tokens of ``blocking_tokens`` of a name and an address that are joined by a space.

    Each distinct word is looked up once; native expressions take several times as long for
    whole texts.  Characters without an ASCII decomposition part words in either form.
    """
    if not text.isascii():
        text = unicodedata.normalize("NFKD", text)
        for mark in filter(unicodedata.combining, set(text)):
            text = text.replace(mark, "")
    words = set(text.replace("&", " and ").encode().translate(_BYTES).split())
    for short in words & _EXPANSIONS.keys():
        words.discard(short)
        words.update(_EXPANSIONS[short])
    return {w for w in words if len(w) > 1}


def token_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(entity_id, country, business_name, business_address) to (entity_id, country, size, bag): the sorted tokens, a space between two."""
    for b in batches:
        size, bag = [], []
        for name, address in zip(b.column("business_name").to_pylist(), b.column("business_address").to_pylist(), strict=True):
            found = None if name is None or address is None else token_set(f"{name} {address}")
            size.append(None if found is None else len(found))
            bag.append(None if found is None else b" ".join(sorted(found)).decode())
        yield pa.RecordBatch.from_arrays([b.column("entity_id"), b.column("country"), pa.array(size, pa.int32()), pa.array(bag, pa.string())], names=["entity_id", "country", "size", "bag"])


def parse_ids(text: Column) -> Column:
    """Comma list to ids; empty parts go, nothing is trimmed."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), ","), lambda x: x != "")
