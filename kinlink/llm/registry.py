"""The training-data queries and their DuckDB SQL."""

from __future__ import annotations

from . import decontaminate, licences, minhash, pieces, quality, quotes, spans, suffixes, toxicity, warc

QUERIES = {
    "op1_minhash": minhash.op1_minhash,
    "op2_decontaminate": decontaminate.op2_decontaminate,
    "op3_warc": warc.op3_warc,
    "op4_toxicity": toxicity.op4_toxicity,
    "op5_suffixes": suffixes.op5_suffixes,
    "op6_spans": spans.op6_spans,
    "op7_quotes": quotes.op7_quotes,
    "quoted_conversations": quotes.quoted_conversations,
    "op8_quality": quality.op8_quality,
    "op9_pieces": pieces.op9_pieces,
    "op10_licences": licences.op10_licences,
}
ORACLE_SQL = {**minhash.SQL, **warc.SQL, **suffixes.SQL, **spans.SQL, **quotes.SQL, **licences.SQL}
