"""Licence scan: exact set-similarity join of text blocks with licence templates.

A block is a sentence or line, a template a set of tokens, and a block meets a
template when it holds at least `THRESHOLD` of the template's tokens. So does every
window of as many words as the template has, over the words of a line (`wrapped`:
of the whole text), whatever sentence ends and semicolons stand in it; windows inside
a reported block are left out, of windows that overlap the fullest is reported. Tokens are
ordered by their frequency in all texts, rarest first; only blocks with a token
of a template's prefix can meet it (prefix filter), blocks of fewer words or
template tokens than needed cannot (length filter), nor blocks whose remaining
tokens from the first common one on are too few (positional filter). What is
left is counted exactly. Templates are a small fixed table that every task holds.

Besides, the scan reports where fixed phrases stand word by word.

Defined results: null and empty texts have no words, no places and no labels;
a phrase may cross block borders; repeated rows are scanned alike; an empty table
gives no rows; other columns play no part."""

from __future__ import annotations

import bisect
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import hash_word, text_bytes, text_slices, word_hashes

# Phrases that must be found, with their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Sentences of well-known licence notices, with the method's labels.
TEMPLATES = {
    "apache-2.0": "licensed under the apache license version 2 0",
    "mit": "released under the mit license",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files",
    "bsd": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "gpl-3.0": "this work is licensed under the gnu general public license version 3",
    "gpl-notice": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license",
    "cc-by-nc-4.0": "licensed under cc by nc 4 0",
    "cc-by-sa-4.0": "this work is licensed under a creative commons attribution sharealike 4 0 international license",
    "mpl-2.0": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "unlicense": "this is free and unencumbered software released into the public domain",
}
THRESHOLD = 0.9


class _Templates:
    """Templates over one vocabulary whose ids rise with the tokens' frequency."""

    def __init__(self, templates: dict[str, str], threshold: float, seen: dict[str, int]):
        words = sorted({w for t in templates.values() for w in t.split()}, key=lambda w: (seen.get(w, 0), w))
        self.words = words
        h = np.array([hash_word(w) for w in words], np.uint64)
        self.order = np.argsort(h)
        self.hashes = h[self.order]
        place = {w: i for i, w in enumerate(words)}
        self.labels = sorted(templates)
        self.sets = [sorted(place[w] for w in set(templates[x].split())) for x in self.labels]
        self.need = [math.ceil(threshold * len(s) - 1e-9) for s in self.sets]
        self.lengths = [len(templates[x].split()) for x in self.labels]

    def hits(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(word index, token id) of the words that are template tokens."""
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        i = np.flatnonzero(self.hashes[at] == h)
        return i, self.order[at[i]]

    def meet(self, block: np.ndarray, token: np.ndarray, words_in_block: np.ndarray) -> list[tuple[int, np.ndarray, np.ndarray]]:
        """(template, blocks, common tokens) from the template tokens of blocks: sorted distinct (block, token)."""
        out = []
        n = len(self.words)
        starts = np.concatenate([[0], np.flatnonzero(np.diff(block)) + 1]) if len(block) else np.zeros(0, int)
        after = np.zeros(len(block), int)            # template tokens of the block from this one on
        if len(block):
            ends = np.concatenate([starts[1:], [len(block)]])
            after = np.repeat(ends, ends - starts) - np.arange(len(block))
        for t, (members, need) in enumerate(zip(self.sets, self.need, strict=True)):
            place = np.full(n, -1)
            place[members] = np.arange(len(members))
            p = place[token]
            first = np.flatnonzero((p >= 0) & (p <= len(members) - need))           # prefix
            fits = (words_in_block[block[first]] >= need) & (np.minimum(len(members) - p[first], after[first]) >= need)   # length, position
            some = np.unique(block[first[fits]])
            if not len(some):
                continue
            inside = np.flatnonzero((p >= 0) & np.isin(block, some))
            b, common = np.unique(block[inside], return_counts=True)
            out.append((t, b[common >= need], common[common >= need]))
        return out


    def windows(self, at: np.ndarray, token: np.ndarray, segment: np.ndarray) -> list[tuple[int, int, int, int]]:
        """(template, first word, last word, common tokens) of the windows inside a segment
        that meet a template, of overlapping ones the fullest and then the first. `at` and
        `token` are the words that are template tokens, `segment` the segment of every word.
        A window that meets still does so when it is moved to begin with such a word."""
        out = []
        sizes = np.bincount(segment)
        for t, (members, need, length) in enumerate(zip(self.sets, self.need, self.lengths, strict=True)):
            place = np.full(len(self.words), -1)
            place[members] = np.arange(len(members))
            p = place[token]
            rare = at[(p >= 0) & (p <= len(members) - need)]                          # prefix
            rare = rare[sizes[segment[rare]] >= need]                                 # length
            if not len(rare):
                continue
            a, p = at[p >= 0], p[p >= 0]
            seg = segment[a]
            following = np.searchsorted(rare, a)
            begin = np.flatnonzero(np.append(rare, rare[-1] + 2 * len(segment) + length)[following] - a < length)
            end = np.minimum(np.searchsorted(a, a[begin] + length), np.searchsorted(seg, seg[begin], "right"))
            fits = end - begin >= need                                                # position
            begin, end = begin[fits], end[fits]
            some: list[tuple[int, int, int]] = []
            for k in range(0, len(begin), 1 << 18):                                   # bounds the work arrays
                b, e = begin[k:k + (1 << 18)], end[k:k + (1 << 18)]
                n = e - b
                hit = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n - b, n)
                pairs = np.unique(np.repeat(np.arange(len(b)), n) * len(members) + p[hit])
                w, common = np.unique(pairs // len(members), return_counts=True)
                w, common = w[common >= need], common[common >= need]
                some += zip((-common).tolist(), a[b[w]].tolist(), a[e[w] - 1].tolist(), strict=True)
            taken: list[tuple[int, int]] = []
            for c, lo, hi in sorted(some):
                k = bisect.bisect(taken, (lo, hi))
                if not (k and taken[k - 1][1] >= lo or k < len(taken) and taken[k][0] <= hi):
                    taken.insert(k, (lo, hi))
                    out.append((t, lo, hi, -c))
        return out


def _blocks(data: np.ndarray, off: np.ndarray, starts: np.ndarray, stops: bytes = b".!?;") -> np.ndarray:
    """Block number of every word, given the words' first bytes: a new block begins
    with every text, behind a line feed, and behind one of `stops` before white space."""
    if not len(starts):
        return starts
    space = np.zeros(256, bool)
    space[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
    stop = np.zeros(256, bool)
    stop[list(stops)] = True
    cut = data == 0x0A
    cut[:-1] |= stop[data[:-1]] & space[data[1:]]
    begins = np.zeros(len(data) + 1, np.int32)
    begins[1:] += cut
    begins[off] += 1
    return np.cumsum(begins)[starts]


def _vocabulary_counts(t: _Templates):
    def run(batches):
        n = np.zeros(len(t.words), np.int64)
        for b in text_slices(batches, "text"):
            h, _, _ = word_hashes(*text_bytes(b.column(0)), kind="alnum")
            n += np.bincount(t.hits(h)[1], minlength=len(n))
        yield pa.RecordBatch.from_arrays([pa.array(t.words), pa.array(n)], ["word", "n"])
    return run


def _scan(t: _Templates, phrases: dict[str, str], key_type: pa.DataType, wrapped: bool):
    spans = pa.list_(pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("containment", pa.float64())]))
    schema = pa.schema([("doc_id", key_type), ("n_words", pa.int64()), ("places", pa.list_(pa.struct([("label", pa.string()), ("first_word", pa.int64())]))), ("spans", spans)])
    sought = [([np.uint64(hash_word(w)) for w in p.split()], label) for p, label in phrases.items()]

    def run(batches):
        for b in text_slices(batches, "text"):
            data, off = text_bytes(b.column(1))
            h, start, first = word_hashes(data, off, kind="alnum")
            owner = np.repeat(np.arange(b.num_rows), np.diff(first))
            places: list[list] = [[] for _ in range(b.num_rows)]
            for words, label in sought:
                m = len(h) - len(words) + 1
                if m <= 0:
                    continue
                ok = owner[:m] == owner[len(words) - 1:]
                for j, w in enumerate(words):
                    ok = ok & (h[j:j + m] == w)
                for i in np.flatnonzero(ok).tolist():
                    places[owner[i]].append({"label": label, "first_word": i - int(first[owner[i]])})
            found: list[list] = [[] for _ in range(b.num_rows)]
            spans_of: list[tuple[int, int, int, int]] = []
            block = _blocks(data, off, start)
            if len(block):
                i, token = t.hits(h)
                n = len(t.words)
                pairs = np.unique(block[i].astype(np.int64) * n + token)
                sizes = np.bincount(block)
                opens = np.searchsorted(block, np.arange(len(sizes)))
                met = set()
                for k, blocks, common in t.meet(pairs // n, pairs % n, sizes):
                    for x, c in zip(blocks.tolist(), common.tolist(), strict=True):
                        met.add((k, x))
                        spans_of.append((k, int(opens[x]), int(opens[x] + sizes[x]) - 1, c))
                for k, lo, hi, c in t.windows(i, token, owner if wrapped else _blocks(data, off, start, b"")):
                    if block[lo] != block[hi] or (k, int(block[lo])) not in met:
                        spans_of.append((k, lo, hi, c))
            for k, lo, hi, c in spans_of:
                d = int(owner[lo])
                found[d].append({"label": t.labels[k], "first_word": lo - int(first[d]), "last_word": hi - int(first[d]), "containment": c / len(t.sets[k])})
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.diff(first).astype(np.int64)), pa.array(places, schema.field(2).type), pa.array(found, spans)], schema=schema)
    return run


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", templates: dict[str, str] = TEMPLATES,
         threshold: float = THRESHOLD, phrases: dict[str, str] = PHRASES, wrapped: bool = False) -> DataFrame:
    """One row per input row: doc_id, n_words, places (phrases: label, first_word) and spans
    (blocks and windows that meet a template: label, first_word, last_word, containment).
    `wrapped`: windows run on across line feeds."""
    docs = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    plain = _Templates(templates, threshold, {})
    counts = docs.select("text").mapInArrow(_vocabulary_counts(plain), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    ranked = _Templates(templates, threshold, {r.word: r.n for r in counts.collect()})      # one row for each template token
    kind = docs.schema["doc_id"].dataType
    return docs.mapInArrow(_scan(ranked, phrases, to_arrow_type(kind), wrapped), f"doc_id {kind.simpleString()}, n_words long, places array<struct<label string, first_word long>>, "
                           "spans array<struct<label string, first_word long, last_word long, containment double>>")


def op9_license_scan(spark: SparkSession, docs: DataFrame) -> DataFrame:
    base, both = F.col("places.label"), F.concat("places.label", "spans.label")
    joined = lambda a: F.array_join(F.array_sort(F.array_distinct(a)), ",")
    return scan(docs, wrapped=True).select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"),
        F.array_min("places.first_word").alias("first_word"), F.array_max("places.first_word").alias("last_word"),
        joined(base).alias("base_labels"), joined(both).alias("labels"),
        F.when(F.size("places") > 0, 1.0).otherwise(F.coalesce(F.array_max("spans.containment"), F.lit(0.0))).alias("score"))


def _oracle() -> str:
    at = " UNION ALL ".join(
        f"SELECT doc_id, '{label}' AS label, i - 1 AS p FROM w, unnest(generate_series(1, len(x))) AS u(i) WHERE "
        + " AND ".join(f"x[i + {j}] = '{t}'" for j, t in enumerate(p.split())) for p, label in PHRASES.items())
    sets = ", ".join(f"('{x}', {len(t.split())}, [{', '.join(repr(w) for w in sorted(set(t.split())))}])" for x, t in TEMPLATES.items())
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    return rf"""
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
w AS (SELECT doc_id, regexp_extract_all(t, '{word}') AS x FROM d),
places AS ({at}),
b AS (SELECT doc_id, regexp_extract_all(unnest(string_split(regexp_replace(t, '([.!?;])[\x20\x09-\x0D]', '\1' || chr(10), 'g'), chr(10))), '{word}') AS x FROM d),
tpl(label, n_words, s) AS (VALUES {sets}),
m AS (SELECT doc_id, label, len(list_intersect(list_distinct(x), s)) AS c, len(s) AS n FROM b, tpl WHERE list_has_any(x, s)),
blocks AS (SELECT doc_id, label, c / n AS containment FROM m WHERE c >= ceil({THRESHOLD} * n - 1e-9)),
h AS (SELECT doc_id, label, s, n_words, x, unnest(generate_series(1, len(x))) AS i FROM w, tpl WHERE len(list_intersect(list_distinct(x), s)) >= ceil({THRESHOLD} * len(s) - 1e-9)),
hits AS (SELECT doc_id, label, len(s) AS n, len(list_intersect(list_distinct(list_slice(x, i, i + n_words - 1)), s)) AS c FROM h WHERE list_contains(s, x[i])),
spans AS (SELECT * FROM blocks UNION ALL SELECT doc_id, label, c / n AS containment FROM hits WHERE c >= ceil({THRESHOLD} * n - 1e-9)),
pa AS (SELECT doc_id, count(*) AS n_base, min(p) AS first_word, max(p) AS last_word, list(DISTINCT label) AS l FROM places GROUP BY doc_id),
sa AS (SELECT doc_id, max(containment) AS best, list(DISTINCT label) AS l FROM spans GROUP BY doc_id)
SELECT w.doc_id, len(x)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
       coalesce(array_to_string(list_sort(pa.l), ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(pa.l, []), coalesce(sa.l, [])))), ','), '') AS labels,
       CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(best, 0.0) END::DOUBLE AS score
FROM w LEFT JOIN pa USING (doc_id) LEFT JOIN sa USING (doc_id)
"""


ORACLE = _oracle()
