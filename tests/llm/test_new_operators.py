"""Exact duplicates, hard negatives and collocations against brute force, on odd rows and on parts that are made small; what was mended beside."""

import hashlib
import math
import random
import re
import time
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from talkmill.llm import exact, media, negatives, phrases, secrets
from talkmill.llm.bloom import bloom_filter, passes
from talkmill.llm.common import TokenRows, fitting_sample
from talkmill.llm.queries import ORACLE, QUERIES

from .test_operators import CLASH, DATA, SCHEMA

ASCII_LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def with_clash(spark, rows):
    return spark.createDataFrame([(i, t, lang, None, None, *("x" for _ in CLASH)) for i, t, lang in rows], SCHEMA)


@pytest.mark.parametrize("name", ["op11_exact_dedup", "op12_hard_negatives", "op13_collocations"])
def test_queries_against_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    df = QUERIES[name](spark, DATA)
    found = con.execute(ORACLE[name])
    names = [d[0] for d in found.description]
    theirs = sorted((tuple(r[names.index(c)] for c in df.columns) for r in found.fetchall()), key=repr)
    assert sorted(names) == sorted(df.columns) and sorted(map(tuple, df.collect()), key=repr) == theirs and theirs


# ---------------------------------------------------------------- exact duplicates


def test_the_trie_against_a_dictionary():
    """Any strings, those that begin others included; cut at every step or never."""
    draw = random.Random(1)
    for limit in (0, 3, 10_000):
        trie, plain, got = exact.OwnerTrie(), {}, {}
        strings = sorted(bytes(draw.choices(b"ab", k=draw.randrange(2, 9))) for _ in range(400))
        for n, s in enumerate(strings):
            row = (1, draw.randrange(4), draw.choice([None, draw.randrange(50)]))
            plain[s] = exact.better(plain[s], row) if s in plain else row
            if n % 7 == 0 and trie.size > limit and n and strings[n - 1][:2] != s[:2]:
                got.update(trie.cut(s[:2]))
            trie.insert(s, row)
        got.update(trie.cut())
        assert got == plain and trie.size == 0
    assert exact.better((1, 5, None), (2, 5, 3)) == (3, 5, 3) and exact.better((1, 5, 9), (1, 6, 10)) == (2, 6, 10)


def brute_duplicates(rows):
    groups = defaultdict(list)
    for n, (i, t, _) in enumerate(rows):
        groups[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append((-len(t or ""), i is None, i or 0, n))
    out = []
    for text, members in groups.items():
        best = min(members)
        keep = None if best[1] else best[2]
        for points, none, i, n in members:
            out.append((None if none else i, keep, len(members), n == best[3], hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("options", [{}, {"hot": 2}, {"hot": 2, "most_bytes": 1}, {"hash_bytes": 0, "most_bytes": 400}])
def test_exact_duplicates_against_brute_force(spark, options):
    """Copies by white space, a text that half of all rows hold, repeated rows, nulls, an own kind of space, a very long text."""
    draw = random.Random(2)
    words = ["a", "b", "mill", "😀", "é", " ", "wheel"]
    rows = [(i, draw.choice([" ", "", "\t", "\n\r"]).join(draw.choices(words, k=draw.randrange(0, 4))), "en") for i in range(150)]
    rows += [(200 + i, "the hot text" + " " * (i % 5), "en") for i in range(200)]
    rows += [(500, None, None), (501, "", None), (None, "the hot text", "en"), (None, None, None), (7, "twice", "en"), (7, "twice", "en"), (7, "twi ce", "en"), (502, "x " * 300_000, "en"), (503, "x" * 300_000, "en")]
    got = exact.exact_duplicates(with_clash(spark, rows).repartition(6), **options)
    assert sorted(map(tuple, got.collect()), key=repr) == brute_duplicates(rows)


def test_rows_that_are_kept(spark):
    rows = [(1, "a b", "en"), (2, "ab", "en"), (3, "c", None), (3, "c", None), (4, None, "de"), (None, "", "de")]
    docs = with_clash(spark, rows)
    kept = exact.drop_exact_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == [(1, "a b"), (3, "c"), (4, None)]
    assert exact.exact_duplicates(docs.limit(0)).count() == 0 and exact.drop_exact_duplicates(docs.limit(0)).count() == 0


# ---------------------------------------------------------------- hard negatives


def brute_negatives(rows, modulo):
    fit = {}
    for i, x, label in rows:
        if i is not None and label is not None and x is not None and all(v is not None and math.isfinite(v) for v in x):
            row = (label, [math.floor(256 * v) for v in x])
            fit[i] = min(fit.get(i, row), row)
    size = max((len(q) for _, q in fit.values()), default=0)
    ids = sorted(fit)
    q = {i: np.array(fit[i][1] + [0] * (size - len(fit[i][1])), dtype=object) for i in ids}
    out = []
    for a in (i for i in ids if i % modulo == 0):
        score = {i: int((q[a] * q[i]).sum()) for i in ids}
        order = sorted(ids, key=lambda i: (-score[i], i))
        for p in [i for i in order if i != a and fit[i][0] == fit[a][0]][:5]:
            fits = [i for i in order if fit[i][0] != fit[a][0] and 30 * score[p] <= 100 * score[i] <= 90 * score[p]][:10]
            out += [(a, p, n + 1, i, score[p], score[i]) for n, i in enumerate(fits)]
    return sorted(out)


def test_hard_negatives_against_brute_force(spark, monkeypatch):
    """Small blocks, so that tiles are added over chunks and ranked over shards; ties, equal vectors, vectors of other lengths, odd rows."""
    for name, value in (("BLOCK_ROWS", 16), ("BLOCK_ANCHORS", 4), ("CHUNK", 3), ("LABEL_BUCKETS", 3)):
        monkeypatch.setattr(negatives, name, value)
    draw = random.Random(3)
    rows = [(i, [draw.choice([-0.5, 0.1, 0.7, 1.0]) for _ in range(draw.choice([8, 8, 8, 5]))], draw.randrange(4)) for i in range(160)]
    rows += [(200 + i, [0.5] * 8, i % 3) for i in range(60)]  # one vector again and again
    rows += [(300, None, 1), (301, [0.1, None], 1), (302, [float("nan")], 1), (303, [float("inf")], 1), (304, [0.1] * 8, None), (None, [0.1] * 8, 1), (5, [0.9] * 8, 0), (5, [0.9] * 8, 0), (400, [], 2), (500, [-1.0] * 8, 3), (700, [0.2] * 8, 9)]
    table = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, label int, rank string")
    got = sorted(map(tuple, negatives.hard_negatives(table, F.col("vec_id") % 10 == 0).collect()))
    assert got == brute_negatives(rows, 10) and len(got) > 300
    assert negatives.hard_negatives(table.limit(0), F.col("vec_id") % 10 == 0).count() == 0
    assert negatives.hard_negatives(table, F.lit(False)).count() == 0


def test_scores_stay_within_64_bits(spark):
    for d in (1, 64, 768, 4096):
        assert 100 * d * negatives.limit(d) ** 2 < 1 << 63 and negatives.limit(64) == 1 << 24
    rows = [(0, [1e30, 1.0], 1), (1, [1e30, 0.0], 1), (2, [1e29, -1e30], 2), (3, [60_000.0, 0.0], 2)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    most = negatives.limit(2)
    got = [tuple(r) for r in negatives.hard_negatives(table, F.col("vec_id") == 0).collect()]
    assert got == [] or all(abs(r[4]) < 1 << 63 for r in got)
    held, dimensions = negatives.whole_vectors(table)
    assert dimensions == 2 and {r.vec_id: list(r.q) for r in held.collect()}[2] == [most, -most]


# ---------------------------------------------------------------- collocations


def brute_collocations(rows, least, longest, share, most):
    f, n = Counter(), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", (text or "").translate(ASCII_LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            f.update((lang, *w[i : i + m]) for m in range(1, longest + 1) for i in range(len(w) - m + 1))
    candidates = {k: v for k, v in f.items() if len(k) > 2 and v >= least}
    gone = {(k[0], *k[1:][a : a + m]) for k, v in candidates.items() for m in range(2, len(k) - 1) for a in range(len(k) - m) if 100 * v >= share * f[(k[0], *k[1:][a : a + m])]}
    by = defaultdict(list)
    for (lang, *w), a in candidates.items():
        if (lang, *w) not in gone:
            score, k = min((1_000_000 * a * a // (f[(lang, *w[:i])] * f[(lang, *w[i:])]), i) for i in range(1, len(w)))
            by[lang].append((-score, -a, " ".join(w).encode(), f[(lang, *w[:k])], f[(lang, *w[k:])]))
    return sorted((lang, i + 1, p.decode(), -a, l, r, n[lang], -s) for lang, found in by.items() for i, (s, a, p, l, r) in enumerate(sorted(found)[:most]))


def said(seed, rows=300):
    draw = random.Random(seed)
    words = ["the", "The", "mill", "wheel", "été", "ÉTÉ", "a", "b", "😀", "x y", "tick", "tock"]
    out = [(i, "".join(draw.choice(words) + draw.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "!", ":"]) for _ in range(draw.randrange(0, 30))), draw.choice(["en", "en", "de", None, "und"])) for i in range(rows)]
    return out + [(900, None, "en"), (901, "", None), (902, " \t\n..,", "de"), (903, "tick tock " * 20_000, "en"), (904, "w" * 100_000 + " mill wheel", "de"), (5, "again and again and again", "fr"), (5, "again and again and again", "fr")]


@pytest.mark.parametrize("options", [{}, {"least": 3, "longest": 4, "share": 80, "most": 40}, {"least": 1, "longest": 2, "share": 1, "most": 5}])
def test_collocations_against_brute_force(spark, options):
    rows = said(4)
    got = phrases.collocations(with_clash(spark, rows).repartition(5), **options)
    want = brute_collocations(rows, **({"least": 10, "longest": 3, "share": 50, "most": 2000} | options))
    assert sorted(map(tuple, got.collect())) == want and want
    assert phrases.collocations(with_clash(spark, rows).limit(0)).count() == 0


@pytest.mark.parametrize("few", [0, 1, 5, 10_000])
def test_shards_with_lists_and_with_bits(monkeypatch, few):
    """What a shard finds is the same whatever is kept as bits; along a filter that lets everything through these are all its phrases."""
    monkeypatch.setattr(phrases, "FEW", few)
    monkeypatch.setattr(phrases, "PART_BYTES", 40)
    numbers = TokenRows()
    numbers[b"."]
    texts = [t for _, t, _ in said(6, 60)[:60]]
    ids = np.concatenate([phrases.numbered_words(t.encode(), numbers) for t in texts])
    all_pass = np.full((1, 1 << 13), 255, np.uint8)
    shard = phrases.Shard(ids, phrases.word_hashes("en", numbers), all_pass, 3)
    names = [w.decode() for w in numbers]
    got = Counter({tuple(names[w] for w in p): int(n) for found in shard.found[2:] for ps, ns in found for p, n in zip(ps, ns)})
    want = Counter()
    for t in texts:
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", t.translate(ASCII_LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            want.update(tuple(w[i : i + m]) for m in (2, 3) for i in range(len(w) - m + 1))
    assert got == want


def test_bitmaps(monkeypatch):
    draw = random.Random(7)
    for _ in range(30):
        a, b = (np.array(sorted(draw.sample(range(600), draw.randrange(1, 200)))) for _ in "ab")
        moved = phrases.Bitmap.of(a).shifted()
        assert moved.positions().tolist() == (a + 1).tolist()
        both = moved & phrases.Bitmap.of(b)
        assert both.positions().tolist() == sorted({*(a + 1)} & {*b}) and both.count() == len({*(a + 1)} & {*b})


def test_filters_lose_nothing(spark):
    table = bloom_filter(spark.range(50_000).select(F.xxhash64("id").alias("h")))
    inside = np.array([r.h for r in spark.range(0, 50_000, 50).select(F.xxhash64("id").alias("h")).collect()], np.int64).view(np.uint64)
    other = np.array([r.h for r in spark.range(60_000, 70_000).select(F.xxhash64("id").alias("h")).collect()], np.int64).view(np.uint64)
    assert passes(table, inside).all() and passes(table, other).mean() < 0.02
    assert not passes(bloom_filter(spark.range(0).select(F.xxhash64("id").alias("h"))), inside).any()


# ---------------------------------------------------------------- mended


def test_a_very_long_text_does_not_empty_a_sample(spark):
    """Whatever is first by the hash, a long text gives a passage, and what does not fit is left out alone."""
    rows = [(i, f"text {i} " * 20, 1) for i in range(60)]
    for giant in range(60):
        if giant % 20 == 0:
            docs = spark.createDataFrame([(i, "giant " * 200_000 if i == giant else t, y) for i, t, y in rows], "doc_id long, text string, y int")
            got = {r.doc_id: len(r.text) for r in fitting_sample(docs, 1000, ["y"], most_bytes=1 << 20).collect()}
            assert len(got) == 60 and got[giant] == 200_000
            small = fitting_sample(docs, 1000, ["y"], most_bytes=3000).collect()
            assert 10 < len(small) < 60 and sum(len(r.text.encode()) for r in small) <= 3000


def test_broken_media_have_null_features():
    for data in (b"P2 1 1 255 99999999999999999999999", b"P2 1 1 255 -5", b"P5 1 1 100 \xff", b"P2 1 1 255", b"P9", b"", b"BM", b"BM" + bytes(60), b"P5 99999999999 99999999999 255 x", b"P2 1 1 0 0", b"P3 1 1 255 1 2 x"):
        payload, size, digest, tile, dhash = media.features_of(data, True)
        assert (payload, tile, dhash) == (None, None, None) and size == len(data) and digest == hashlib.sha256(data).hexdigest()
    assert media.features_of(b"P5 1 1 100 \x64", True)[0] == b"\x64"


def test_keys_behind_examples_and_long_slugs():
    scan = secrets.SecretScanner()
    key = "76DFztpTllkJaYs96hbQCBcTX3giOBUI"
    for text, spans in ((f"example_{key}", [("entropy", 8, 40)]), (f"sample-{key}", [("entropy", 7, 39)]), (f"your_key_{key}", [("entropy", 9, 41)]), ("a-long-slug-with-words-12345678", []), ("my-example-project-name-for-you", []), ("an_exampleKEYof4Letters9Digits7inOneWord", [])):
        assert scan(text) == spans, text


def test_windows_of_long_runs(monkeypatch):
    """In stretches as in one piece, and in linear time: half a million random characters take a few seconds at most."""
    draw = random.Random(8)
    other = re.compile("[^a-z0-9]")
    whole = ["".join(draw.choices("abcdefghijklmnop0123456789-"[: draw.randrange(4, 28)], k=draw.randrange(10, 400))) for _ in range(60)]
    before = [secrets.windows_over(t, other, w, bits) for t in whole for w, bits in ((24, 3.0), (16, 2.7), (24, 3.7))]
    monkeypatch.setattr(secrets, "STRETCH", 50)
    assert before == [secrets.windows_over(t, other, w, bits) for t in whole for w, bits in ((24, 3.0), (16, 2.7), (24, 3.7))]
    for t in whole[:20]:
        hot = set()
        for a in range(len(t) - 23):
            if not other.search(t[a : a + 24]) and -sum(c / 24 * math.log2(c / 24) for c in Counter(t[a : a + 24]).values()) >= 3.0 - 1e-9:
                hot |= {*range(a, a + 24)}
        assert {x for a, b in secrets.windows_over(t, other, 24, 3.0) for x in range(a, b)} == hot
    monkeypatch.undo()
    began = time.time()
    secrets.SecretScanner()("".join(draw.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", k=500_000)))
    assert time.time() - began < 5
