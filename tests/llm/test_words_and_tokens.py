"""Spelling variants, periodic runs and token counts against brute force."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

import odd
from conftest import SF0001
from netquery.llm import periodic, spelling, token_counts
from netquery.llm.common import table


def rows_of(spark):
    return [(r.doc_id, r.text) for r in table(spark, SF0001, "documents").select("doc_id", "text").collect()]


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


# ---- spelling variants -----------------------------------------------------

def brute_words(rows, every=None):
    n = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{w}".encode())
            if every and h % every == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            n[w] += 1
    return {w: k for w, k in n.items() if len(w) >= 5 and k >= 3}


def is_near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_variants(n):
    """Near words by all words that one edit can make, not by comparing pairs."""
    letters = sorted({c for w in n for c in w})
    near = {}
    for w in n:
        made = {w[:i] + w[i + 1:] for i in range(len(w))}
        made |= {w[:i] + c + w[i:] for i in range(len(w) + 1) for c in letters}
        made |= {w[:i] + c + w[i + 1:] for i in range(len(w)) for c in letters}
        near[w] = {m for m in made if m in n and m != w}
    form = {}
    for w in n:
        best = min(near[w], key=lambda m: (-n[m], m), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out)


def test_spelling_variants_equal_brute_force(spark):
    rows = rows_of(spark)
    got = sorted(tuple(r) for r in spelling.op11_spelling_variants(spark, frame(spark, rows)).collect())
    want = brute_variants(brute_words(rows, spelling.CUT))
    assert got == want
    assert any(r[1] for r in got) and any(r[2] != r[1] for r in got if r[1])        # forms, and ways of more than one step


def test_near_words_in_crowded_groups(spark):
    """Thousands of words share every chunk, so groups are cut down to single places; lengths from 1 on."""
    r = random.Random(5)
    words = {"".join(p) for k in range(1, 6) for p in itertools.product("abé", repeat=k)}
    words |= {"prefixprefix" + "".join(r.choice("ab") for _ in range(6)) + "suffix" for _ in range(150)}
    words |= {"x" * k for k in range(1, 40)}
    n = spark.createDataFrame([(w, 3) for w in sorted(words)], "word string, n long")
    got = sorted((p.x, p.y) if p.x < p.y else (p.y, p.x) for p in spelling.near_words(n, group=2).collect())
    want = sorted((a, b) for a, b in itertools.combinations(sorted(words), 2) if is_near(a, b))
    assert got == want


def test_spelling_odd_rows(spark):
    d = odd.docs(spark)
    got = {r.word: r for r in spelling.spelling_variants(spelling.corpus_words(d, times=1)).collect()}
    assert got["quick"].n == 3 and got["quick"].n_near == 0 and got["quick"].form is None and got["quick"].root == "quick"
    assert got["Ünïcödé"].n == 2 and got["straße"].n == 2                     # repeated rows count
    assert spelling.op11_spelling_variants(spark, odd.empty(spark)).collect() == []
    chain = frame(spark, [(1, "hello " * 24 + "hallo " * 12 + "halo " * 3 + "hallos " * 6 + "hallosx " * 3)])
    got = {r.word: (r.form, r.root, r.form_n) for r in spelling.spelling_variants(spelling.corpus_words(chain)).collect()}
    assert got == {"hello": (None, "hello", None), "hallo": ("hello", "hello", 24), "hallos": ("hallo", "hello", 12), "hallosx": ("hallos", "hello", 6)}


def test_only_ascii_is_lowered_and_a_code_point_is_dropped(spark):
    rows = [(k, "ÀBCDEF Straße") for k in range(400)]
    got = {r.word: r.n for r in spelling.corpus_words(frame(spark, rows), every=7).collect()}
    assert got == brute_words(rows, 7) and "Àbcdef" in got and "àbcdef" not in got


# ---- periodic runs ---------------------------------------------------------

def brute_runs(words):
    """All runs by trying every start and period."""
    n, out = len(words), set()
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(12, 2 * q):
                out.add((i, j - i + q, q))
            i = j
    smallest = {}
    for start, length, q in sorted(out):
        smallest[start, length] = min(q, smallest.get((start, length), q))
    return sorted((s, m, q) for (s, m), q in smallest.items())


def brute_periodic(key, text, edit):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    if edit:
        h = zlib.crc32(("" if key is None else str(key)).encode())
        if h % 10 == 0 and n > 0:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = sorted(brute_runs(words), key=lambda r: (r[0], r[2]))
    dropped = {i for s, m, q in runs for i in range(s + q, s + m)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (key, len(runs), *best, 1000 * best[1] // best[2] if runs else None, sha("".join(f"{s},{m},{q}\n" for s, m, q in runs)),
            sha(" ".join(w for i, w in enumerate(words) if i not in dropped)))


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_periodic_runs_equal_brute_force(spark):
    rows = [r for r in rows_of(spark) if len(r[1] or "") < 6000]
    assert len(rows) > 150
    got = sorted(tuple(r) for r in periodic.op12_periodic_runs(spark, frame(spark, rows)).select(*COLUMNS).collect())
    want = sorted(brute_periodic(*r, True) for r in rows)
    assert got == want and sum(r[1] > 0 for r in got) > 10


def made_texts():
    r = random.Random(3)
    out = []
    for _ in range(120):
        n = r.choice([0, 5, 11, 12, 13, 30, 60, 150, 300])
        few = [f"w{i}" for i in range(r.choice([1, 2, 3, 40]))]
        words = [r.choice(few) for _ in range(n)]
        for _ in range(r.randrange(4)):                      # plant repeats, some inside others, some broken
            block = words[:r.randrange(1, 40)] or ["z"]
            at = r.randrange(len(words) + 1)
            words[at:at] = block * r.randrange(1, 6) + block[:r.randrange(len(block) + 1)]
            if words and r.random() < 0.3:
                words[r.randrange(len(words))] = "odd"
        out.append(" \t".join(words))
    a, b = "a", "a b"
    for _ in range(10):
        a, b = b, b + " " + a                                # Fibonacci words are full of runs
    return [*out, b, " ".join(["x"] * 500), " ".join(["x", "y"] * 333), None, "", " \n "]


def test_runs_of_made_texts(spark):
    rows = list(enumerate(made_texts()))
    got = sorted(tuple(r) for r in periodic.periodic_runs(frame(spark, rows)).select(*COLUMNS).collect())
    assert got == sorted(brute_periodic(*r, False) for r in rows)


@pytest.mark.parametrize("size", [1, 7])
def test_small_tiles_stitch_to_the_same_runs(size):
    """Tiles of few boundaries, solved one by one, give the intervals that brute force has."""
    old, periodic.TILE = periodic.TILE, size
    try:
        for text in made_texts()[:60]:
            words = (text or "").split()
            ids = {w: i for i, w in enumerate(dict.fromkeys(words))}
            codes = np.array([ids[w] for w in words], np.int64)
            parts = {}
            for _, step, boundary, count, tile in periodic.tiles(codes, np.array([0, len(codes)])):
                for q, i, j in periodic.solve(tile.tolist(), step, boundary, count):
                    parts.setdefault(q, []).append((i, j))
            runs = []
            for q, spans in parts.items():
                spans.sort()
                now = list(spans[0])
                for i, j in [*spans[1:], (1 << 60, 0)]:
                    if i <= now[1]:
                        now[1] = max(now[1], j)
                    else:
                        if now[1] - now[0] + q >= max(12, 2 * q):
                            runs.append((now[0], now[1] - now[0] + q, q))
                        now = [i, j]
            assert sorted(runs) == brute_runs(words)
    finally:
        periodic.TILE = old


def test_periodic_odd_rows(spark):
    got = periodic.op12_periodic_runs(spark, odd.docs(spark)).collect()
    assert len(got) == len(odd.ROWS)
    by = {(r.doc_id, r.n_words): r for r in got}
    assert by[1, 0].n_runs == by[2, 0].n_runs == by[3, 0].n_runs == 0 and by[1, 0].collapsed_sha256 == hashlib.sha256(b"").hexdigest()
    assert by[None, 0].start is None and by[5, 60_000].n_runs == 0                     # the long text repeats after 30,287 words
    assert sorted(r.n_words for r in got if r.doc_id == 9) == [len(odd.ROWS[11][1].split())] * 2
    assert periodic.op12_periodic_runs(spark, odd.empty(spark)).collect() == []
    twice = periodic.periodic_runs(frame(spark, [(1, odd.LONG + " " + odd.LONG)])).first()
    assert (twice.start, twice.length, twice.period) == (0, 120_000, 60_000)


def test_a_long_text_of_one_word():
    """Periods that repeat a shorter one make no fragments, so one word 30,000 times is one run."""
    codes = np.zeros(30_000, np.int64)
    found = [f for _, step, boundary, count, tile in periodic.tiles(codes, np.array([0, len(codes)])) for f in periodic.solve(tile.tolist(), step, boundary, count)]
    assert {q for q, _, _ in found} == {1} and len(found) < 30


# ---- token counts ----------------------------------------------------------

def library_counts(texts):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(token_counts.default_path())
    return [len(t.encode(x or "", add_special_tokens=False).ids) for x in texts]


SPECIAL = ["<|endoftext|>", " a <|endoftext|> b<|endoftext|>\n\n", "<|endoftext|", "it's  we'll 'S   x\x1c\x85y", "漢字かな 한글 ١٢٣ ½ ﬁ 🙂🙂 \U0001F468‍\U0001F469", "a" * 3000, " " * 500 + "x", "\t\n \r\n  z", "ɏɐ΢"]


@pytest.mark.parametrize("hot", [token_counts.HOT, 50, 0])
def test_token_counts_equal_the_library(spark, hot):
    rows = [*rows_of(spark), *((10_000 + i, t) for i, t in enumerate(SPECIAL)), (1, None), (None, "twice"), (None, "twice"), (2, "")]
    got = token_counts.token_counts(frame(spark, rows), hot=hot).collect()
    want = sorted(((k is None, k or 0), len((t or "").encode()), n, n > 1024) for (k, t), n in zip(rows, library_counts([t for _, t in rows]), strict=True))
    assert sorted(((r.doc_id is None, r.doc_id or 0), r.n_bytes, r.n_tokens, r.over_limit) for r in got) == want


def test_plain_characters_are_cut_as_the_library_does():
    cut = token_counts.pre_tokens(token_counts.default_path())
    lib = cut.tokenizer.pre_tokenizer
    for c in range(token_counts.PLAIN):
        for text in (f"a{chr(c)}1{chr(c)}", f" {chr(c)}{chr(c)} b", f"{chr(c)} {chr(c)}'s"):
            assert cut._segment(text) == [text[a:b] for _, (a, b) in lib.pre_tokenize_str(text)], hex(c)


def test_token_counts_odd_rows(spark):
    got = token_counts.op13_token_counts(spark, odd.docs(spark)).collect()
    assert sorted(r.n_tokens for r in got) == sorted(library_counts([t for _, t, _ in odd.ROWS]))
    assert token_counts.op13_token_counts(spark, odd.empty(spark)).collect() == []


def test_long_texts_are_cut_alike(monkeypatch):
    cut = token_counts.pre_tokens(token_counts.default_path())
    want = cut.frequencies(odd.LONG)
    monkeypatch.setattr(token_counts, "LONG", 10)
    assert cut.frequencies(odd.LONG) == want
