"""Spelling variants: words of the corpus that one edit turns into each other.

Asymmetric q-chunks: a word of L code points contributes two disjoint chunks, its
halves; the partner, as long or one longer, contributes positional grams of the
same lengths. One edit leaves at least one chunk whole, and moves it by at most
one place, so a pair meets at a chunk: the first half at place 0, or the second
at its own place or one later. (Grams at other places can only meet pairs that
meet there as well, and are not made.) Pairs are verified by their edit distance.

A chunk that many words share would pair all of them. What is left of its words
beside the chunk differs by one edit again, so such words contribute two chunks
of that rest, below the shared chunk, and so on until a group is small or its
words differ in one place only, where every pair is a result.

Every word's form is its most frequent near word, if that is frequent enough; forms
are followed to their ends by pointer doubling (frequencies at least double on the
way, so there are no circles).

Defined results: a null text has no words; a null id counts as the empty text in
the draw of deletions; repeated rows count as often as they are there; an empty
table gives no words; other columns play no part."""

from __future__ import annotations

import re
import zlib
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import text_slices, written

RUN = re.compile("[a-zÀ-ÿ]+")
KEPT = 300_000          # distinct words that a task holds before it hands them on
LONG = 1 << 20          # longer texts are cut without a list of their words
GROUP = 16              # words that share a chunk, up to which all their pairs are verified
CUT = 97                # one word in so many loses a character in the registered query


def _counts(least: int, every: int | None):
    """(word, n): the words of the texts that a task reads, summed while they fit."""
    def rows(seen):
        return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], ["word", "n"])

    def run(batches):
        seen = {}
        for b in text_slices(batches, "text", 4 << 20):
            for key, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if not text:
                    continue
                low = text.encode().lower().decode()                    # bytes lower A-Z alone
                found = Counter(RUN.findall(low) if len(low) <= LONG else map(re.Match.group, RUN.finditer(low)))
                begun = zlib.crc32(b"%s:" % (b"" if key is None else str(key).encode()))
                for w, f in found.items():
                    if every:
                        h = zlib.crc32(w.encode(), begun)
                        if h % every == 0:
                            at = h % len(w)
                            w = w[:at] + w[at + 1:]
                    if len(w) >= least:
                        seen[w] = seen.get(w, 0) + f
                if len(seen) > KEPT:
                    yield rows(seen)
                    seen = {}
        if seen:
            yield rows(seen)
    return run, "word string, n long"


def corpus_words(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = 5, times: int = 3, every: int | None = None) -> DataFrame:
    """(word, n): lower-cased runs of letters, of at least `least` code points and `times` occurrences. With `every`,
    a run whose crc32 with its document's id is divisible by it loses a character."""
    d = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return d.mapInArrow(*_counts(least, every)).groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= times)


def _piece(kind: str, side: int) -> Column:
    """One chunk (or gram) of the column `rest` as a row. `size` is the length of the shorter partner's rest, which is
    shorter by `side`. The first chunk has half the size, the second what is left of it; one place alone is both."""
    size, rest = F.col("size"), F.col("rest")
    one = F.when(size == 1, 1).otherwise(F.floor(size / 2) if kind == "first" else size - F.floor(size / 2)).cast("int")
    n = size + side
    if kind == "first":
        chunk, left = F.substring(rest, F.lit(1), one), F.substring(rest, one + 1, n - one)
    else:
        chunk, left = F.substring(rest, n - one + 1, one), F.substring(rest, F.lit(1), n - one)
    return F.struct((size - one).alias("size"), F.xxhash64("key", "size", F.lit(kind), chunk).alias("key"), left.alias("rest"))


def _cut(rows: DataFrame) -> DataFrame:
    """Rows (d, side, size, key, word, n, rest) cut once more, below their chunk: two rows each."""
    both = [F.array(_piece("first", side), _piece("second", side)) for side in (0, 1)]
    parts = rows.select("d", "side", "word", "n", F.explode(F.when(F.col("side") == 0, both[0]).otherwise(both[1])).alias("p"))
    return parts.select("d", "side", "p.size", "p.key", "word", "n", "p.rest")


def near_words(words: DataFrame, group: int = GROUP) -> DataFrame:
    """(x, nx, y, ny): all pairs of different words of (word, n) that one edit turns into each other, each
    once. d = 0: words of equal length, d = 1: y (side 1) has one code point more than x (side 0)."""
    kinds = F.explode(F.array(*[F.struct(F.lit(d).alias("d"), F.lit(side).alias("side")) for d, side in ((0, 0), (1, 0), (1, 1))])).alias("k")
    rows = (words.select("word", "n", kinds).select("k.d", "k.side", (F.length("word") - F.col("k.side")).alias("size"), F.lit(0).cast("long").alias("key"),
                                                    "word", "n", F.col("word").alias("rest")).where("size > 0"))
    whole = F.col("size") + F.col("d") < 2               # one place: nothing to cut
    rows = written(_cut(rows.where(~whole)).unionByName(rows.where(whole)), "chunks")
    here, found = ["d", "size", "key"], []
    while True:
        sizes = rows.groupBy(*here).agg(F.count_if(F.col("side") == 0).cast("double").alias("a"), F.count_if(F.col("side") == 1).cast("double").alias("b"))
        b = F.when(F.col("d") == 0, F.col("a")).otherwise(F.col("b"))
        # at most `group` verified pairs for each row; beyond that another cut, where there is anything to cut
        heavy = sizes.where((F.col("a") * b > group * (F.col("a") + b)) & (F.col("size") + F.col("d") >= 2) & (F.col("size") > 0)).select(*here)
        light = rows.join(heavy, here, "left_anti")
        x = light.where("side = 0").select(*here, F.col("word").alias("x"), F.col("n").alias("nx"))
        y = light.where("d = 0 OR side = 1").select(*here, F.col("word").alias("y"), F.col("n").alias("ny"))
        near = x.join(y, here).where((F.col("d") == 1) | (F.col("x") < F.col("y"))).where(F.levenshtein("x", "y", 1) == 1)
        found.append(written(near.select("x", "nx", "y", "ny"), "near"))
        rows = written(_cut(rows.join(heavy, here, "left_semi")), "chunks")
        if rows.isEmpty():
            break
    pairs = found[0]
    for f in found[1:]:
        pairs = pairs.unionByName(f)
    return pairs.dropDuplicates(["x", "y"])          # a letter put in beside its equal meets at both chunks


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root): forms (word, form) followed to their ends. Each round doubles the length of the ways; only those
    that are not at their end are joined."""
    state = written(forms.select("word", F.col("form").alias("root"), F.lit(False).alias("done")), "roots")
    while not state.where("NOT done").isEmpty():
        steps = state.select(F.col("word").alias("root"), F.col("root").alias("next"), F.col("done").alias("last"))
        moved = state.where("NOT done").join(steps, "root", "left")
        moved = moved.select("word", F.coalesce("next", "root").alias("root"), F.coalesce("last", F.lit(True)).alias("done"))
        state = written(state.where("done").unionByName(moved), "roots")
    return state.select("word", "root")


def spelling_variants(words: DataFrame, times: float = 2, group: int = GROUP) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every row of (word, n), words being different. A form has at least
    `times` the word's n (above 1)."""
    words = written(words, "words")
    pairs = near_words(words, group)
    ways = F.explode(F.array(F.struct(F.col("x").alias("word"), F.col("y").alias("near"), F.col("ny").alias("m")),
                             F.struct(F.col("y").alias("word"), F.col("x").alias("near"), F.col("nx").alias("m"))))
    best = pairs.select(ways.alias("w")).select("w.*").groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("m")).alias("m"), "near")).alias("best"))
    of = words.join(best, "word", "left")
    m = -F.col("best.m")
    good = m >= F.col("n") * times
    of = written(of.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(good, F.col("best.near")).alias("form"),
                           F.when(good, m).alias("form_n")), "forms")
    roots = _roots(of.where("form IS NOT NULL"))
    return (of.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))


def op11_spelling_variants(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return spelling_variants(corpus_words(docs, every=CUT))
