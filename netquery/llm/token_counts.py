"""Token counts without token ids.

A byte-level BPE never merges across pre-tokens, so a text has as many tokens as
its pre-tokens have pieces. The pieces of every distinct pre-token of the corpus
are counted once. A second pass makes the pre-token frequencies of each document;
the counts of the most frequent pre-tokens (a table of bounded size) lie beside
every task, so that frequent ones never meet in one join task, and all others are
joined by pre-token: a row for each pre-token and slice of documents, with the
documents and frequencies as lists. Sums go back to the documents by row.

Special strings of the vocabulary that stand in a text are cut out first and are
one token each, as the library does by default.

Defined results: a null text counts as empty and has no tokens; a null id is kept
as it is; repeated rows come back as often as they are there; an empty table gives
no rows; other columns play no part. A vocabulary with a normaliser, or with special
strings that swallow white space, is refused, since its pre-tokens are not substrings
of the text."""

from __future__ import annotations

import functools
import json
import os
import re
import unicodedata
from collections import Counter

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import text_slices, written

HOT, HOT_BYTES = 1 << 17, 64      # the broadcast list of frequent pre-tokens: so many, of so many bytes at most
KEPT = 300_000                    # distinct pre-tokens that a task holds before it hands them on
LONG = 1 << 20                    # texts over so many characters are cut without a list of their pre-tokens
LIMIT = 1024                      # tokens above which a text is over the limit


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def _ranges(kind: str, end: int) -> str:
    """The characters below `end` of one major category, as the inside of a character class."""
    flags = [unicodedata.category(chr(c))[0] == kind for c in range(end)] + [False]
    edges = [c for c in range(end + 1) if flags[c] != (c > 0 and flags[c - 1])]
    return "".join(f"{re.escape(chr(a))}-{re.escape(chr(b - 1))}" for a, b in zip(edges[::2], edges[1::2], strict=True))


PLAIN = 0x250           # below this, the classes of characters are the same in all Unicode versions
_L, _N, _S = _ranges("L", PLAIN), _ranges("N", PLAIN), r"\t-\r \x85\xa0"
_PRE_TOKEN = re.compile(rf"'(?:[stmd]|re|ve|ll)| ?[{_L}]+| ?[{_N}]+| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+")
_IS_PLAIN = re.compile(r"[\x00-ɏ]*")


class PreTokens:
    """Cuts texts into the pre-tokens of a byte-level vocabulary, and counts the pieces of a pre-token."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        spec = json.loads(self.tokenizer.to_str())
        added = spec.get("added_tokens") or []
        if spec.get("normalizer") or any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in added):
            raise ValueError("this vocabulary changes texts before it cuts them")
        pre = spec.get("pre_tokenizer") or {}
        if pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex"):
            raise ValueError("not a byte-level vocabulary with the common pattern")
        self.special = re.compile("(" + "|".join(re.escape(t["content"]) for t in sorted(added, key=lambda t: -len(t["content"]))) + ")") if added else None

    def _segment(self, text: str):
        if _IS_PLAIN.fullmatch(text):
            return _PRE_TOKEN.findall(text) if len(text) <= LONG else map(re.Match.group, _PRE_TOKEN.finditer(text))
        return [text[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)]

    def frequencies(self, text: str | None) -> Counter:
        """How often each pre-token (and special string) stands in the text."""
        if not text:
            return Counter()
        if self.special is None or not self.special.search(text):
            return Counter(self._segment(text))
        out = Counter()
        for i, part in enumerate(self.special.split(text)):      # odd places hold the special strings
            out.update([part] if i % 2 else self._segment(part))
        return out

    def pieces(self, pre_tokens: list[str]) -> list[int]:
        return [len(e) for e in self.tokenizer.encode_batch(pre_tokens, add_special_tokens=False)]


@functools.lru_cache(maxsize=2)
def pre_tokens(path: str) -> PreTokens:
    """One for each worker process."""
    return PreTokens(path)


def _survey(path: str):
    """(pretoken, freq) of the texts that a task reads, summed while they fit."""
    def rows(seen):
        return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], ["pretoken", "freq"])

    def run(batches):
        cut, seen = pre_tokens(path), Counter()
        for b in text_slices(batches, "text", 4 << 20):
            for t in b.column(0).to_pylist():
                seen.update(cut.frequencies(t))
                if len(seen) > KEPT:
                    yield rows(seen)
                    seen = Counter()
        if seen:
            yield rows(seen)
    return run, "pretoken string, freq long"


def _count(path: str):
    def run(batches):
        cut = pre_tokens(path)
        for b in text_slices(batches, "pretoken", 1 << 20):
            n = cut.pieces(b.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n, pa.int64())], ["pretoken", "freq", "n"])
    return run, "pretoken string, freq long, n long"


def corpus_pieces(docs: DataFrame, path: str) -> DataFrame:
    """(pretoken, freq, n): every distinct pre-token of the column `text`, its occurrences and its pieces."""
    found = docs.select("text").mapInArrow(*_survey(path)).groupBy("pretoken").agg(F.sum("freq").alias("freq"))
    return written(found.mapInArrow(*_count(path)), "pieces")


def _frequent(pieces: DataFrame, most: int = HOT, size: int = HOT_BYTES):
    """A condition that holds for the most frequent pre-tokens of at most `size` bytes, `most` of them at most."""
    level = F.floor(F.log2("freq") * 4).cast("long")
    short = F.octet_length("pretoken") <= size
    held = pieces.where(short).groupBy(level.alias("level")).count().orderBy(F.col("level").desc()).collect()   # under 256 rows
    total, cut = 0, None
    for r in held:
        total += r["count"]
        if total > most:
            break
        cut = r["level"]
    return short & (level >= cut) if cut is not None else F.lit(False)


def _documents(path: str, hot_b):
    """A row (row, doc_id, n_bytes, n) for each document, with the pieces of its frequent
    pre-tokens, and a row (pretoken, rows, freqs) for each other pre-token of a slice."""
    out = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n", pa.int64()),
                     ("pretoken", pa.string()), ("rows", pa.list_(pa.int64())), ("freqs", pa.list_(pa.int64()))])

    def run(batches):
        from pyspark import TaskContext
        cut, hot = pre_tokens(path), hot_b.value
        row = TaskContext.get().partitionId() << 40
        for b in text_slices(batches, "text", 4 << 20):
            first, known, rare = row, [], {}
            for t in b.column(1).to_pylist():
                n = 0
                for w, f in cut.frequencies(t).items():
                    k = hot.get(w)
                    if k is not None:
                        n += k * f
                    else:
                        at = rare.get(w)
                        if at is None:
                            at = rare[w] = ([], [])
                        at[0].append(row)
                        at[1].append(f)
                known.append(n)
                row += 1
            m = b.num_rows
            yield pa.RecordBatch.from_arrays([
                pa.array(range(first, row), pa.int64()), b.column(0), pc.fill_null(pc.binary_length(b.column(1)), 0).cast(pa.int64()),
                pa.array(known, pa.int64()), pa.nulls(m, pa.string()), pa.nulls(m, out.field("rows").type), pa.nulls(m, out.field("freqs").type)], schema=out)
            if rare:
                none = pa.nulls(len(rare), pa.int64())
                yield pa.RecordBatch.from_arrays([none, none, none, none, pa.array(list(rare), pa.string()), pa.array([r for r, _ in rare.values()], out.field("rows").type),
                                                  pa.array([f for _, f in rare.values()], out.field("freqs").type)], schema=out)
    return run, "row long, doc_id long, n_bytes long, n long, pretoken string, rows array<long>, freqs array<long>"


def token_counts(docs: DataFrame, path: str | None = None, key: str = "doc_id", text: str = "text", limit: int = LIMIT, hot: int = HOT) -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_tokens, over_limit."""
    path = path or default_path()
    docs = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    pieces = corpus_pieces(docs, path)
    frequent = _frequent(pieces, hot)
    few = pieces.where(frequent).select("pretoken", "n").toArrow()          # at most `hot` rows of HOT_BYTES
    hot_b = docs.sparkSession.sparkContext.broadcast(dict(zip(few.column(0).to_pylist(), few.column(1).to_pylist(), strict=True)))
    found = written(docs.mapInArrow(*_documents(path, hot_b)), "pretoken-frequencies")
    rare = (found.where("pretoken IS NOT NULL").select("pretoken", "rows", "freqs").join(pieces.where(~frequent).select("pretoken", "n"), "pretoken")
            .select("n", F.explode(F.arrays_zip("rows", "freqs")).alias("at")))
    none = F.lit(None).cast("long")
    parts = (found.where("pretoken IS NULL").select("row", "doc_id", "n_bytes", "n")
             .unionByName(rare.select(F.col("at.rows").alias("row"), none.alias("doc_id"), none.alias("n_bytes"), (F.col("n") * F.col("at.freqs")).alias("n"))))
    sums = parts.groupBy("row").agg(F.max("doc_id").alias("doc_id"), F.max("n_bytes").alias("n_bytes"), F.sum("n").alias("n_tokens"))
    return sums.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def op13_token_counts(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return token_counts(docs)
