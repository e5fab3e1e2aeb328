"""Licence scans: a positional rare-token index over notice templates, DataFrame only.

A template's words are ranked by their document frequency in the whole corpus (highest
IDF first).  The first of them, as many as leave too few places for a match among the
rest, are looked up in the text's postings; every place gives an alignment (text position
minus template position).  A match agrees in at least ``MIN_MATCH`` of n places, and of
these at least two are among any n - need + 2, so alignments that occur twice are all that
can match.  They are verified: the template's mandatory phrase must stand there word for
word, and ``MIN_MATCH`` of all template words must agree.  The template library and its
vocabulary are the only things broadcast or collected, and both are constants.

No shuffle carries text: one pass over the corpus writes each text's licence words, and
its word sequence only where all words of some phrase occur; document frequencies (a
partial aggregation over at most the vocabulary's size) and the scan read that table.

Defined cases: a null text is empty; an empty text has no words, null positions, empty
labels and score 0; a very long text is scanned whole; words of equal frequency rank by
themselves, of a label's matches the best counts; repeated rows are scanned alike; words
after lower-casing A-Z are runs of 0-9, a-z and anything beyond ASCII; columns other than
doc_id and text, whatever their names, are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import materialise

GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BASE = [("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved")]
# The licences' own words, whole where they are short, else the notice that their text asks for.
_WARRANTY = "IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
_CONDITIONS = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
_AS_IS = 'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.'
_FREE = "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {0} as published by the Free Software Foundation, either version {1} of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {0} for more details."
TEXTS = [
    ("mit", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.', "the rights to use copy modify merge publish distribute sublicense"),
    ("bsd-2", f"{_CONDITIONS} {_AS_IS} {_WARRANTY}", "with the distribution this software is provided by the copyright holders"),
    ("bsd-3", f"{_CONDITIONS} 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. {_AS_IS} {_WARRANTY}", "may be used to endorse or promote products derived from this software"),
    ("isc", 'Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.', "with or without fee is hereby granted"),
    ("zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software.", "the origin of this software must not be misrepresented"),
    ("apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.', "you may not use this file except in compliance with the license"),
    *[(label, _FREE.format(name, version), f"{name.lower()} as published by the free software foundation either version {version}") for label, name, version in (("gpl-2.0", "General Public License", 2), ("gpl-3.0", "General Public License", 3), ("lgpl", "Lesser General Public License", 3), ("agpl", "Affero General Public License", 3))],
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.", "mozilla public license v 2 0"),
    ("unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.", "free and unencumbered software released into the public domain"),
]
#: (label, notice, mandatory phrase of it)
TEMPLATES = [
    ("mit", "released under the mit license", "mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "permission is hereby granted free of charge"),
    ("apache-2.0", "licensed under the apache license version 2 0", "apache license"),
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3", "general public license version 3"),
    ("gpl-2.0", "this work is licensed under the gnu general public license version 2", "general public license version 2"),
    ("lgpl", "licensed under the gnu lesser general public license version", "lesser general public license"),
    ("agpl", "licensed under the gnu affero general public license version", "affero general public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "redistribution and use in source and binary forms"),
    ("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    ("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    ("cc-by-nd", "licensed under cc by nd 4 0", "cc by nd"),
    ("cc0", "dedicated to the public domain under cc0 1 0 universal", "cc0 1 0"),
    ("mpl-2.0", "subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose", "permission to use copy modify"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "free and unencumbered software"),
    *[(label, " ".join(re.findall(WORD, text.lower())), phrase) for label, text, phrase in TEXTS],
]
MIN_MATCH = 0.5
VOCABULARY = sorted({w for _, t, _ in TEMPLATES for w in t.split()} | {w for p, _ in BASE for w in p.split()})


def _strings(items: list[str]) -> Column:
    return F.array(*[F.lit(x) for x in items]) if items else F.array().cast("array<string>")


def _postings(words: Column) -> Column:
    """(word, at) of every licence word of a text, made in one pass over its words."""
    known = _strings(VOCABULARY)
    return F.filter(F.transform(words, lambda x, i: F.when(F.array_contains(known, x), F.struct(x.alias("word"), i.alias("at")))), lambda p: p.isNotNull())


def _places(postings: Column, word: Column) -> Column:
    """0-based positions of a word, from the postings of a text or a notice."""
    return F.transform(F.filter(postings, lambda p: p["word"] == word), lambda p: p["at"])


def _stands(words: Column, at: Column, phrase: Column) -> Column:
    """Whether the phrase's words stand consecutively from position ``at``."""
    return (at >= 0) & (F.slice(words, F.greatest(at, F.lit(0)) + 1, F.size(phrase)) == phrase)


def _holds_all(held: Column, phrase: list[str]) -> Column:
    ok = F.lit(True)
    for w in sorted(set(phrase)):
        ok = ok & F.array_contains(held, w)
    return ok


def _with_words(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, held (vocabulary words), and words where a whole phrase may stand.

    lower() also changes letters beyond ASCII, which no template has; the one that it
    would turn into an ASCII letter, the Kelvin sign, is replaced before.
    """
    text = F.lower(F.replace(F.coalesce(F.col("text").cast("string"), F.lit("")), F.lit("\u212a"), F.lit("\u00e5")))
    d = docs.select("doc_id", F.array_remove(F.split(text, GAP), "").alias("words"))
    d = d.select("doc_id", "words", F.array_intersect("words", _strings(VOCABULARY)).alias("held"))
    phrases = [p for p, _ in BASE] + [p for _, _, p in TEMPLATES]
    any_phrase = reduce(lambda x, y: x | y, [_holds_all(F.col("held"), p.split()) for p in phrases])
    some = F.when(any_phrase, F.col("words")).otherwise(F.array().cast("array<string>"))
    return d.select("doc_id", F.size("words").cast("long").alias("n_words"), "held", some.alias("words"), _postings(some).alias("postings"))


def document_frequencies(parsed: DataFrame) -> dict[str, int]:
    """Texts holding each vocabulary word; as many rows as the vocabulary at most."""
    rows = parsed.select(F.explode("held").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n")).collect()
    return {w: 0 for w in VOCABULARY} | {r["word"]: r["n"] for r in rows}


def _rare_words(notice: list[str], df: dict[str, int]) -> list[str]:
    """The notice's rarest words, whose places hold at least two places of every match."""
    room = len(notice) - math.ceil(MIN_MATCH * len(notice)) + 2
    rare, held = [], 0
    for w in sorted(set(notice), key=lambda w: (df[w], w)):
        if held >= room:
            break
        rare.append(w)
        held += notice.count(w)
    return rare


def _template_rows(df: dict[str, int]) -> Column:
    """The template library as one array; rare and at: a notice's rarest words and their places in it."""
    rows = []
    for label, notice, phrase in TEMPLATES:
        n, p = notice.split(), phrase.split()
        rare = _rare_words(n, df)
        at = F.array(*[F.array(*[F.lit(i) for i, x in enumerate(n) if x == w]) for w in rare])
        rows.append(F.struct(F.lit(label).alias("label"), _strings(n).alias("notice"), _strings(p).alias("phrase"), _strings(rare).alias("rare"), at.alias("at"), F.lit(_lead(n, p)).alias("lead")))
    return F.array(*rows)


def _lead(notice: list[str], phrase: list[str]) -> int:
    return next(i for i in range(len(notice)) if notice[i : i + len(phrase)] == phrase)


def _alignments(postings: Column, t: Column) -> Column:
    """Text positions of the notice's first word on which two places of its rare words agree."""
    hits = F.filter(postings, lambda p: F.array_contains(t["rare"], p["word"]))
    shifts = F.flatten(F.transform(hits, lambda p: F.transform(F.get(t["at"], F.array_position(t["rare"], p["word"]).cast("int") - 1), lambda q: p["at"] - q)))
    twice = F.transform(F.array(F.sort_array(shifts)), lambda s: F.filter(s, lambda x, i: x == F.get(s, i + 1)))
    return F.array_distinct(F.flatten(twice))


def _match(words: Column, at: Column, notice: Column) -> Column:
    """Share of the notice's words that stand in the text at alignment ``at``."""
    skip = F.greatest(-at, F.lit(0))
    same = F.zip_with(F.slice(words, at + skip + 1, F.size(notice) - skip), F.slice(notice, skip + 1, F.size(notice)), lambda x, y: F.coalesce(x == y, F.lit(False)))
    return F.size(F.filter(same, lambda x: x)) / F.size(notice).cast("double")


def scan(docs: DataFrame) -> DataFrame:
    """One row per text: base places and labels, verified labels and score."""
    words, held, postings = F.col("words"), F.col("held"), F.col("postings")
    d = materialise(_with_words(docs), "licence-words")
    df = document_frequencies(d)
    base = F.array(*[F.struct(F.lit(label).alias("label"), _strings(p.split()).alias("phrase")) for p, label in BASE])
    possible = lambda x: F.forall(x["phrase"], lambda w: F.array_contains(held, w))
    places = F.transform(F.filter(base, possible), lambda b: F.struct(b["label"].alias("label"), F.filter(_places(postings, F.get(b["phrase"], F.lit(0))), lambda i: _stands(words, i, b["phrase"])).alias("at")))

    def best(t: Column) -> Column:
        good = F.filter(_alignments(postings, t), lambda d: _stands(words, d + t["lead"], t["phrase"]))
        return F.struct(t["label"].alias("label"), F.array_max(F.transform(good, lambda d: _match(words, d, t["notice"]))).alias("share"))

    found = F.transform(F.filter(_template_rows(df), possible), best)
    some = F.size("words") > 0
    d = d.select("doc_id", "n_words", F.when(some, F.filter(places, lambda x: F.size(x["at"]) > 0)).alias("base"), F.when(some, F.filter(found, lambda x: x["share"] >= MIN_MATCH)).alias("found"))
    at = F.coalesce(F.flatten("base.at"), F.array().cast("array<int>"))
    own, more = (F.coalesce(F.col(f"{c}.label"), F.array().cast("array<string>")) for c in ("base", "found"))
    join = lambda x: F.array_join(F.array_sort(F.array_distinct(x)), ",")
    return d.select("doc_id", "n_words", F.size(at).cast("long").alias("n_base"), F.array_min(at).cast("long").alias("first_word"), F.array_max(at).cast("long").alias("last_word"),
                    join(own).alias("base_labels"), join(F.concat(own, more)).alias("labels"), F.when(F.size(at) > 0, F.lit(1.0)).otherwise(F.coalesce(F.array_max("found.share"), F.lit(0.0))).alias("score"))


def op10_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def _sql() -> str:
    quote = lambda xs: "[" + ", ".join(f"'{x}'" for x in xs) + "]"
    rows = ",\n    ".join(f"('{label}', {quote(t.split())}, {quote(p.split())}, {_lead(t.split(), p.split())})" for label, t, p in TEMPLATES)
    base = ",\n    ".join(f"('{label}', {quote(p.split())})" for p, label in BASE)
    return rf"""
with w as (select row_number() over () as r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') as words from documents),
base(label, p) as (values {base}),
tmpl(label, t, p, lead) as (values {rows}),
places as (select r, label, unnest(list_filter(range(0, len(words)), lambda i: list_slice(words, i + 1, i + len(p)) = p)) as i
    from w, base where list_has_all(words, p)),
b as (select r, count(*) n, min(i) lo, max(i) hi, string_agg(distinct label, ',' order by label) labels from places group by r),
c as (select r, words, label, t, unnest(list_filter(range(0, len(words)), lambda i: list_slice(words, i + 1, i + len(p)) = p)) - lead as d
    from w, tmpl where list_has_all(words, p)),
ver as (select r, label, len(list_filter(range(0, len(t)), lambda j: d + j >= 0 and words[greatest(d + j, 0) + 1] = t[j + 1])) / cast(len(t) as double) s from c),
v as (select r, label, max(s) s from ver where s >= {MIN_MATCH} group by r, label),
alls as (select r, label from v union select r, label from places),
al as (select r, string_agg(distinct label, ',' order by label) labels from alls group by r),
best as (select r, max(s) s from v group by r)
select doc_id, cast(len(words) as bigint) as n_words, cast(coalesce(b.n, 0) as bigint) as n_base, cast(b.lo as bigint) as first_word, cast(b.hi as bigint) as last_word,
  coalesce(b.labels, '') as base_labels, coalesce(al.labels, '') as labels, case when b.n > 0 then 1.0::double else coalesce(best.s, 0.0::double) end as score
from w left join b using (r) left join al using (r) left join best using (r)"""


SQL = {"op10_licences": _sql()}
