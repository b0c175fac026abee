"""Operators over documents on odd rows and against brute force."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

import odd
from conftest import SF0001
from netquery.llm import common, exact_dedup, graph, license_scan, mixing, ngram_join, packing, quality, tokens, toxicity


def words(text):
    return (text or "").translate(str.maketrans("\t\n\v\f\r", "     ")).split(" ") if text else []


def test_word_hashes_agree_with_words():
    texts = ["a b  a\tc", "", "ab", None, "é ab é", "x" * 9000 + " b " + "y" * 9000]
    old, common.SEGMENT = common.SEGMENT, 4096
    try:
        h, _, first = common.word_hashes(*common.text_bytes(pa.array(texts)))
    finally:
        common.SEGMENT = old
    got = [h[first[i]:first[i + 1]].tolist() for i in range(len(texts))]
    want = [[w for w in words(t) if w] for t in texts]
    assert [len(g) for g in got] == [len(w) for w in want]
    by_word = {}
    for g, w in zip(got, want, strict=True):
        for x, y in zip(g, w, strict=True):
            assert by_word.setdefault(y, x) == x
    assert len(set(by_word.values())) == len(by_word)


def test_global_rank(spark):
    df = spark.range(0, 500).selectExpr("id", "id % 7 AS m")
    got = common.global_rank(df, ["m", "id"]).collect()
    assert [r.rank for r in sorted(got, key=lambda r: (r.m, r.id))] == list(range(1, 501))


def test_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 200), (200, 300), (7, 7)]
    got = {r.node: r.label for r in graph.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 200: 100, 300: 100}


# ---- exact dedup -----------------------------------------------------------

def test_exact_dedup_odd_rows(spark):
    got = exact_dedup.op4_exact_dedup(spark, odd.docs(spark)).collect()
    assert len(got) == len(odd.ROWS)
    by = defaultdict(list)
    for r in got:
        by[r.doc_id].append(r)
    assert by[0][0].group_size == 3 and by[0][0].kept and by[4][0].keep_id == 0 and not by[4][0].kept
    assert by[1][0].keep_id == 1 and by[2][0].keep_id == 1 and by[3][0].keep_id == 3      # null and empty are equal; a blank text is one space
    assert sorted(r.kept for r in by[9]) == [False, True] and by[9][0].group_size == 2         # one of two equal rows stays
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("digest_index")]
    assert exact_dedup.op4_exact_dedup(spark, odd.empty(spark)).count() == 0


def test_exact_dedup_keeps_columns_and_one_row(spark):
    d = odd.docs(spark)
    kept = exact_dedup.keep_one(d)
    assert kept.columns == d.columns
    assert sorted(r.doc_id for r in kept.collect()) == [0, 1, 3, 5, 6, 7, 8, 9, 10, 11]


def test_digest_index_persists_between_batches(spark, tmp_path):
    index = exact_dedup.DigestIndex(spark, str(tmp_path / "index"), 4)
    first = spark.createDataFrame([(5, "a"), (6, "b")], "doc_id long, text string")
    later = spark.createDataFrame([(1, "a"), (2, "c"), (3, "c")], "doc_id long, text string")
    index.add(exact_dedup.digest_rows(first))
    again = exact_dedup.DigestIndex(spark, str(tmp_path / "index"), 4)        # another session opens the same files
    got = {r.doc_id: (r.keep_id, r.kept) for r in exact_dedup.exact_dedup(later, index=again).collect()}
    assert got == {1: (5, False), 2: (2, True), 3: (2, False)}
    assert again.rows().count() == 3


# ---- n-gram Jaccard join ---------------------------------------------------

def brute_groups(rows, k, percent):
    sets = {}
    for key, text in rows:
        w = [x for x in words((text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))) if x]
        sets[key] = {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()
    root = {key: key for key in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[i + 1:]:
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {key: (len(sets[key]), find(key)) for key in keys}


def near_texts(seed, families=6, members=14):
    r = random.Random(seed)
    vocab = [f"v{i}" for i in range(400)]
    rows, key = [], 0
    shared = [r.choice(vocab) for _ in range(60)]
    for f in range(families):
        base = [r.choice(vocab) for _ in range(r.randint(20, 120))] + (shared if f % 2 else [])
        for _ in range(members):
            t = list(base)
            for _ in range(r.choice([0, 1, 1, 2, 3, 6])):
                t[r.randrange(len(t))] = r.choice(vocab)
            if r.random() < 0.2:
                t = t[:r.randint(3, len(t))]
            rows.append((key, " ".join(t)))
            key += 1
    r.shuffle(rows)
    return rows + [(key, ""), (key + 1, None), (key + 2, "a b"), (key + 3, "A  b")]


@pytest.mark.parametrize("limits, k, percent", [({}, 4, 85), ({"leaf": 2, "pivots": 2, "levels": 2, "hot_least": 4}, 5, 80), ({"leaf": 2, "pivots": 1, "often": 10 ** 9}, 4, 85)])
def test_near_groups_equal_brute_force(spark, limits, k, percent):
    rows = near_texts(len(limits) * 10 + k)
    got = ngram_join.near_groups(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), k=k, percent=percent, **limits).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_groups(rows, k, percent)


def test_near_groups_odd_rows(spark):
    got = ngram_join.op7_ngram_jaccard_join(spark, odd.docs(spark)).collect()
    assert len(got) == len(odd.ROWS)
    ids = {r.doc_id: (r.n_shingles, r.component_id) for r in got if r.doc_id is not None}
    assert ids[4][1] == 0 and ids[1] == (0, 1) and ids[3] == (0, 3) and ids[8] == (1, 7) and ids[6][1] == 5 and ids[9][1] == 9
    assert all(r.component_id is None for r in got if r.doc_id is None)
    assert ngram_join.op7_ngram_jaccard_join(spark, odd.empty(spark)).count() == 0


# ---- licence scan ----------------------------------------------------------

def test_license_scan_odd_rows(spark):
    got = {r.doc_id: r for r in license_scan.op9_license_scan(spark, odd.docs(spark)).collect()}
    assert (got[10].n_base, got[10].first_word, got[10].last_word, got[10].base_labels) == (3, 2, 10, "cc-by,reserved")
    assert "cc-by-nc-4.0" in got[10].labels and got[10].score == 1.0
    assert got[11].labels == "mit" and got[1].n_words == 0 and got[3].score == 0.0 and got[1].first_word is None
    assert license_scan.op9_license_scan(spark, odd.empty(spark)).count() == 0


def test_template_filters_lose_nothing():
    r = random.Random(4)
    t = license_scan._Templates(license_scan.TEMPLATES, 0.6, {})
    vocab = t.words
    blocks = [sorted(r.sample(range(len(vocab)), r.randint(1, 30))) for _ in range(400)]
    for s in t.sets:
        blocks += [sorted(r.sample(s, len(s) - j)) for j in range(min(4, len(s)))]
    pairs = np.array([(i, x) for i, b in enumerate(blocks) for x in b])
    got = {(k, int(b)) for k, bs, _ in t.meet(pairs[:, 0], pairs[:, 1], np.array([len(b) for b in blocks])) for b in bs}
    want = {(k, i) for k, s in enumerate(t.sets) for i, b in enumerate(blocks) if len(set(s) & set(b)) >= t.need[k]}
    assert got == want and want


GPL = "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License"
GRANT = "# Permission is hereby granted, free of charge, to any person obtaining a copy\n# of this software and associated documentation files"


def test_notices_across_sentence_ends_and_lines(spark):
    cut = "Redistribution and use in source and binary forms, with or without modification; are permitted. provided that the following conditions are met: x"
    rows = [(1, f"Some words. {GPL}. More words."), (2, f"Some words here.\n{GRANT} of it."), (3, cut), (4, GPL.replace("modify", "modify;").replace("software", "tool")),
            (5, "Released under it; the license"), (6, GPL + " " + GPL + "\n" + GPL.replace(" can", "\n * can")), (7, GPL.replace("this", "that").replace("terms of", "rules, of"))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in license_scan.op9_license_scan(spark, df).collect()}
    assert [got[i].labels for i in (1, 3, 4, 5)] == ["gpl,gpl-notice", "bsd", "gpl,gpl-notice", ""] and got[3].score == 1.0
    spans = {r.doc_id: [(s.label, s.first_word, s.last_word) for s in r.spans] for r in license_scan.scan(df, wrapped=True).collect()}
    assert spans[1] == [("gpl-notice", 2, 23)] and spans[2] == [("mit-grant", 3, 22)]
    assert sorted((a, b) for label, a, b in spans[6] if label == "gpl-notice") == [(0, 21), (5, 26), (22, 43), (44, 65)]


def test_template_windows_lose_nothing():
    r = random.Random(6)
    t = license_scan._Templates(license_scan.TEMPLATES, 0.7, {w: r.randint(0, 9) for x in license_scan.TEMPLATES.values() for w in x.split()})
    words, segment = [], []
    for k in range(300):
        x = r.choice(list(license_scan.TEMPLATES.values())).split()
        x = [w if r.random() < 0.9 else r.choice([*t.words, "other"]) for w in x for _ in range(1 + (r.random() < 0.05))]
        words += x
        segment += [k // r.choice([1, 2])] * len(x)
    segment = np.maximum.accumulate(np.array(segment))
    place = {w: i for i, w in enumerate(t.words)}
    at = np.array([i for i, w in enumerate(words) if w in place])
    found = t.windows(at, np.array([place[words[i]] for i in at]), segment)
    ids = [place.get(w, -1) for w in words]
    for k, (s, need, length) in enumerate(zip(t.sets, t.need, t.lengths, strict=True)):
        got = [(lo, hi, c) for x, lo, hi, c in found if x == k]
        assert all(hi - lo < length and segment[lo] == segment[hi] and len(set(s) & set(ids[lo:hi + 1])) == c >= need for lo, hi, c in got)
        for lo in range(len(words)):
            w = [x for x, g in zip(ids[lo:lo + length], segment[lo:lo + length], strict=True) if g == segment[lo]]
            if len(set(s) & set(w)) >= need:
                assert any(a < lo + len(w) and lo <= b for a, b, _ in got)
    assert found


# ---- mixing ----------------------------------------------------------------

def test_sainte_lague_equals_quotients(spark):
    r = random.Random(8)
    for seats in (0, 1, 7, 100, 1234):
        votes = [(i, float(r.choice([0, 1, 3, 3, 50, 1000, r.randint(1, 10 ** 6)]))) for i in range(23)]
        got = {x.key: x.quota for x in mixing.apportion(spark.createDataFrame(votes, "key long, votes double"), "key", "votes", seats).collect()}
        rank = sorted(((-v / (2 * k - 1), i) for i, v in votes if v for k in range(1, seats + 1)))[:seats]
        assert got == {i: sum(1 for _, j in rank if j == i) for i, _ in votes}


def test_mixing_odd_rows(spark):
    got = mixing.mix(odd.docs(spark)).collect()
    assert len(got) == len(odd.ROWS)
    assert all(r.taken <= 3 * r.size and r.target <= 3 * r.source_size for r in got)
    assert all(r.taken == 0 for r in got if r.doc_id in (1, 2, 3))
    total = sum(r.size for r in got)
    assert abs(sum({(r.source_size, r.target) for r in got} and [r.taken for r in got]) - total) < 0.01 * total
    assert mixing.mix(odd.empty(spark)).count() == 0
    assert got == mixing.mix(odd.docs(spark)).collect() or sorted(map(str, got)) == sorted(map(str, mixing.mix(odd.docs(spark)).collect()))


def test_mixed_documents_hold_the_words_taken(spark):
    d = spark.read.parquet(f"{SF0001}/documents.parquet")
    taken = {r.doc_id: (r.size, r.taken) for r in mixing.mix(d).collect()}
    near = defaultdict(lambda: [0, 0.0])
    for r in mixing.mix(d).join(d.select("doc_id", "source"), "doc_id").collect():
        near[r.source][0] += r.taken
        near[r.source][1] = r.target
    assert all(abs(a - b) <= 0.01 * b + 2 * mixing.BLOCK for a, b in near.values())
    out = mixing.mixed(d)
    assert out.columns == d.columns
    count = defaultdict(int)
    for r in out.collect():
        count[r.doc_id] += len([w for w in words(r.text) if w])
        assert r.n_chars == len(r.text)
    assert {k: t for k, (_, t) in taken.items() if t} == dict(count)


def test_small_sources_come_near_their_targets(spark):
    r = random.Random(31)
    for sizes in ([15, 1], [6], [1, 1, 1], [10_000, 1, 2, 40], [r.randint(1, 10_000) for _ in range(7)]):
        rows = [(10 * i + j, " ".join(["w"] * n), f"s{i}") for i, x in enumerate(sizes) for j, n in enumerate((x // 3, x - x // 3)) if n]
        d = spark.createDataFrame(rows, "doc_id long, text string, source string")
        got = mixing.mix(d).collect()
        source = {k: s for k, _, s in rows}
        for s in set(source.values()):
            mine = [x for x in got if source[x.doc_id] == s]
            assert abs(sum(x.taken for x in mine) - mine[0].target) <= 1
            assert all(0 <= x.taken <= 3 * x.size for x in mine)


@pytest.mark.parametrize("cuts", [1 << 18, 0])
def test_repeated_rows_share_what_the_mix_takes(spark, cuts):
    """Equal ids, sizes and texts are separate rows: counts per text and their sum equal the mix, also without a broadcast."""
    r = random.Random(5)
    rows = [(r.choice([1, 2, 3, i]), " ".join(r.choice("abc") for _ in range(r.choice([0, 1, 9]))), r.choice(["x", "y", None])) for i in range(300)]
    rows += [(1, "a b c d e f g h i", "x")] * 40 + [(None, "q r s", "y")] * 9
    d = spark.createDataFrame([(*x, "other", 1) for x in rows], "doc_id long, text string, source string, rounds string, shard int")
    want, got = defaultdict(list), defaultdict(int)
    for x in mixing.mix(d, shard_docs=16).collect():
        want[x.doc_id, x.size].append(x.taken)
    out = mixing.mixed(d, shard_docs=16, cuts=cuts)
    assert out.columns == d.columns
    out = out.collect()
    for x in out:
        assert x.rounds == "other" and x.text.split()
        got[x.doc_id] += len(x.text.split())
    total = defaultdict(int)
    for (k, _), t in want.items():
        total[k] += sum(t)
    assert {k: n for k, n in total.items() if n} == dict(got)
    size = Counter((k, t, s) for k, t, s in rows)
    full = Counter((x.doc_id, x.text, x.source) for x in out)
    assert all(n <= 3 * size[k] for k, n in full.items() if k in size and len(k[1].split()) == 9)


# ---- packing ---------------------------------------------------------------

def check_packed(pieces, want):
    """Every id of every document in exactly one piece; gapless sequences of at most 2048."""
    seen = defaultdict(list)
    for r in pieces:
        seen[r.doc_id].append(r)
    assert set(seen) == set(want)
    for key, ids in want.items():
        at = 0
        for r in sorted(seen[key], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert bytes(r.ids) == np.array(ids[at:at + r.length], "<u4").tobytes()
            at += r.length
        assert at == len(ids)
    seqs = defaultdict(list)
    for r in pieces:
        seqs[r.sequence_id].append((r.offset, r.length))
    for s in seqs.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at and length > 0
            at += length
        assert at <= 2048
    return len(seqs) * 2048 / max(1, sum(r.length for r in pieces))


def library_ids(rows):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(tokens.default_path())
    return {k: [*t.encode(x or "", add_special_tokens=False).ids, 1] for k, x in rows}


def test_packing_round_trip(spark):
    d = spark.read.parquet(f"{SF0001}/documents.parquet")
    want = library_ids([(r.doc_id, r.text) for r in d.collect()])
    assert check_packed(packing.pack(d).collect(), want) < 1.03
    assert check_packed(packing.pack(d.repartition(3), shard_docs=20).collect(), want) < 1.2
    q = packing.op1_packing(spark, d).collect()
    assert all(r.ids_crc32 == zlib.crc32(np.array(want[r.doc_id][r.start:r.start + r.length], "<u4").tobytes()) for r in q)


def test_packing_odd_rows(spark):
    rows = [(i, t, s) for i, (_, t, s) in enumerate(odd.ROWS)]
    pieces = packing.pack(odd.docs(spark, rows)).collect()
    check_packed(pieces, library_ids([(i, t) for i, t, _ in rows]))
    assert packing.pack(odd.docs(spark)).select("doc_id").distinct().count() == 13
    assert packing.pack(odd.empty(spark)).count() == 0


def test_cached_ids_equal_the_library():
    ids, r = tokens.Ids(tokens.default_path()), random.Random(3)
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(tokens.default_path())
    alphabet = "abc'sltredvm 019.,!?-\n\t ÀÉßÿœŒ_$#<|>İΣﬁ½\u00a0e\u0301"
    texts = ["".join(r.choice(alphabet) for _ in range(r.randint(0, 30))) for _ in range(6000)]
    for i in range(0, len(texts), 100):
        for text, got in zip(texts[i:i + 100], ids.encode_many(texts[i:i + 100]), strict=True):
            assert np.frombuffer(got, "<u2").tolist() == t.encode(text, add_special_tokens=False).ids, text


def test_a_piece_goes_to_the_model_once(monkeypatch):
    ids, asked = tokens.Ids(tokens.default_path()), []
    pieces = ids._pieces
    monkeypatch.setattr(ids, "_pieces", lambda some: asked.extend(some) or pieces(some))
    texts = ["Été, the word's end; été!", None, "", " \t ", "the WORD, the end 42", "whole <|endoftext|> the"] * 40
    want = [tokens.np.array(ids.tokenizer.encode(x or "", add_special_tokens=False).ids, "<u2").tobytes() for x in texts]
    assert ids.encode_many(texts) == want
    assert asked and len(asked) == len(set(asked))
    assert ids.encode_many([]) == [] and ids.encode_many([None]) == [b""]


def test_neighbours_follow_bm25():
    r = np.random.default_rng(1)
    docs = [r.integers(10, 400, int(n)) for n in r.integers(30, 200, 60)]
    df = np.zeros(1 << 16)
    for d in docs:
        df[np.unique(d)] += 1
    idf, mean = np.log(1 + (60 - df + 0.5) / (df + 0.5)), float(np.mean([len(d) for d in docs]))
    s = packing.Shard(docs, idf, mean)

    def weight(term, d):
        tf = (d == term).sum()
        return idf[term] * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(d) / mean)) if tf else 0.0
    free = np.ones(60, bool)
    free[[0, 9]] = False
    q = sorted(set(docs[0].tolist()), key=lambda t: (-weight(t, docs[0]), t))[:packing.TERMS]
    score = [sum(weight(t, d) for t in q) if free[i] else 0 for i, d in enumerate(docs)]
    want = sorted((i for i in range(60) if score[i] > 0), key=lambda i: (-round(score[i], 9), i))[:packing.NEIGHBOURS]
    got = s.neighbours(0, free).tolist()
    assert [round(score[i], 6) for i in got] == [round(score[i], 6) for i in want]


# ---- classifiers -----------------------------------------------------------

def held_out(spark, query, table_dir, name, threshold):
    got = {r.doc_id: r for r in query.collect()}
    lab = {r.doc_id: r[name] for r in spark.read.parquet(f"{table_dir}/labels.parquet").collect()}
    rows = [(got[i].score >= threshold, y) for i, y in lab.items() if i in got and got[i].held_out]
    assert all(r.predicted == int(r.score >= threshold) and 0 <= r.score <= 1 for r in got.values())
    hit = lambda y: sum(p == bool(y) for p, z in rows if z == y) / max(1, sum(z == y for _, z in rows))
    return hit(0), hit(1)


def test_words_that_share_low_hash_bits_are_told_apart(spark):
    seen = {}
    for i in range(30_000):
        a = seen.setdefault(common.hash_word(f"w{i}") % (1 << 20), i)
        if a != i:
            break
    rows = [(k, f"plain words stand here {'w%d' % a if k % 2 else 'fine'}") for k in range(200)] + [(1000, f"w{i}"), (1001, f"w{a}")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model, _ = toxicity.fit(docs, spark.createDataFrame([(k, k % 2) for k in range(200)], "doc_id long, toxic int"), "true")
    other, known = model.value.features(pa.record_batch({"text": [f"w{i}", f"w{a}"]}), 0)
    assert known[2] > 1 and other[2] == 0


def test_toxicity_held_out(spark):
    d = "/root/testdata/sf0.1"
    clean, toxic = held_out(spark, toxicity.op3_toxicity(spark, spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")), d, "toxic", 0.3)
    assert clean > 0.97 and toxic > 0.75


def test_quality_held_out(spark):
    d = "/root/testdata/sf0.1"
    bad, good = held_out(spark, quality.op6_quality(spark, spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")), d, "quality", 0.5)
    assert bad > 0.9 and good > 0.95


@pytest.mark.parametrize("op", [toxicity.op3_toxicity, quality.op6_quality])
def test_classifiers_odd_rows(spark, op):
    few = odd.labels(spark, [(0, 1, 0), (5, 0, 1), (6, 0, 1), (7, 1, 0), (7, 1, 1), (10, None, None), (99, 1, 1), (None, 1, 1)])
    got = op(spark, odd.docs(spark), few).collect()
    assert len(got) == len(odd.ROWS) and all(0 <= r.score <= 1 for r in got)
    assert len(op(spark, odd.docs(spark), odd.labels(spark)).collect()) == len(odd.ROWS)
    assert op(spark, odd.empty(spark), few).count() == 0


def test_network_gradients():
    r = np.random.default_rng(0)
    data = r.integers(1, 255, 900).astype(np.uint8)
    x, first = quality.chunks(data, np.array([0, 300, 300, 900]))
    y = np.array([1, 0, 1], np.float32)
    net = quality.Network()
    for k in ("conv_b", "hidden_b"):          # away from the kink that padding meets at 0
        net.p[k] += 0.05

    def loss():
        z = net.logits(net.chunk_scores(x), first)
        return float(np.mean(np.log1p(np.exp(-z)) * y + np.log1p(np.exp(z)) * (1 - y)))
    g = net.gradients(x, first, y)
    for k, at in (("conv", (3, 2)), ("hidden", (5, 1)), ("out", (4,)), ("mix", (0,)), ("conv_b", (1,))):
        net.p[k][at] += 1e-3
        up = loss()
        net.p[k][at] -= 2e-3
        down = loss()
        net.p[k][at] += 1e-3
        assert abs((up - down) / 2e-3 - g[k][at]) < 0.02 + 0.1 * abs(g[k][at]), k


def test_chunks_cover_every_byte():
    size = np.array([0, 1, 255, 256, 257, 448, 449, 5000])
    off = np.concatenate([[0], np.cumsum(size)])
    data = (np.arange(off[-1]) % 255 + 1).astype(np.uint8)
    x, first = quality.chunks(data, off)
    for i, n in enumerate(size):
        mine = x[first[i]:first[i + 1]]
        assert len(mine) >= 1
        back = np.zeros(n, np.uint8)
        for j, c in enumerate(mine):
            at = j * quality.STEP
            part = c[:max(0, n - at)]
            back[at:at + len(part)] = part
        assert (back == data[off[i]:off[i + 1]]).all()


def test_dense_groups_keep_a_forest_of_their_links(spark):
    """Near copies of one text are linked all with all; what reaches the components grows as the texts, not as their square."""
    from netquery.llm.graph import components, spanning
    base = [f"w{i}" for i in range(120)]
    rows = [(i, " ".join([*base[:40 + i], f"new{i}", *base[41 + i:]])) for i in range(24)] + [(100 + i, f"text {i} of its own kind") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    _, links = ngram_join.class_links(docs, 4, 85)
    assert 23 <= links.count() <= 60                     # all pairs: 276
    assert {r.component_id for r in ngram_join.near_groups(docs).where("doc_id < 100").collect()} == {0}
    clique = spark.createDataFrame([(a, b, g) for g in (0, 1000) for a in range(g, g + 30) for b in range(a + 1, g + 30)], "a long, b long, g long")
    kept = spanning(clique, "g")
    assert kept.count() == 58
    assert components(kept).groupBy("label").count().collect().__len__() == 2
