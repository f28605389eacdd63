import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from standings.llm.common import table
from standings.llm.queries import op13_periodic_runs
from standings.llm.runs import RunRules, find_runs, lyndon_lengths, word_runs

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_runs(words, least=12):
    """All (start, length, period), by trying every period."""
    names = {w: i for i, w in enumerate(dict.fromkeys(words))}
    codes, found = np.array([names[w] for w in words], int), {}
    for q in range(1, len(codes) // 2 + 1):
        equal = np.concatenate(([0], codes[:-q] == codes[q:], [0])).astype(int)
        turns = np.diff(equal)
        for begin, end in zip(np.flatnonzero(turns == 1).tolist(), np.flatnonzero(turns == -1).tolist()):
            if end - begin + q >= max(least, 2 * q):
                found.setdefault((begin, end - begin + q), q)
    return sorted((begin, length, q) for (begin, length), q in found.items())


def brute_lyndon(s):
    def lyndon(w):
        return all(w < w[k:] for k in range(1, len(w)))

    return [max(j - i for j in range(i + 1, len(s) + 1) if lyndon(s[i:j])) for i in range(len(s))]


def collapsed(words, runs):
    gone = {i for start, length, q in runs for i in range(start + q, start + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def test_lyndon_lengths_match_the_definition():
    rng = random.Random(3)
    for _ in range(1500):
        s = [rng.randrange(rng.randint(1, 5)) for _ in range(rng.randint(0, 15))]
        assert lyndon_lengths(s) == brute_lyndon(s)


@pytest.mark.parametrize("least", [2, 3, 5, 12])
def test_runs_match_brute_force(least):
    rng = random.Random(least)
    for turn in range(600):
        texts = [[rng.randrange(rng.randint(1, 4)) for _ in range(rng.randint(0, 50))] for _ in range(rng.randint(1, 5))]
        if turn % 2:
            texts = [t[: rng.randint(1, 9)] * rng.randint(1, 8) + t for t in texts]
        starts = np.cumsum([0] + [len(t) for t in texts])
        codes, owner = np.array(sum(texts, []), np.int64), np.repeat(np.arange(len(texts)), np.diff(starts))
        want = [(int(s) + a, n, q) for s, t in zip(starts, texts) for a, n, q in brute_runs(t, least)]
        assert [tuple(r) for r in find_runs(codes, owner, least).tolist()] == want


def edited(doc_id, text):
    words = WORD.findall(text or "")
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not words:
        return words
    g = h // 10
    a = g % len(words)
    p = 1 + (len(words) - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, len(words))]


def test_query_matches_brute_force(spark):
    sf_dir = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in table(spark, sf_dir, "documents").collect()}
    rows = op13_periodic_runs(spark, sf_dir).collect()
    assert len(rows) == len(texts) and any(r.n_runs for r in rows)
    for r in rows:
        words = edited(r.doc_id, texts[r.doc_id])
        runs = brute_runs(words)
        listing = "".join(f"{a},{n},{q}\n" for a, n, q in runs)
        best = min(((-n, a, q) for a, n, q in runs), default=None)
        shown = (best[1], -best[0], best[2], -1000 * best[0] // best[2]) if best else (None,) * 4
        assert (r.n_runs, r.start, r.length, r.period, r.exponent_milli) == (len(runs), *shown)
        assert r.runs_sha256 == hashlib.sha256(listing.encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(collapsed(words, runs).encode()).hexdigest()


@pytest.mark.parametrize("chunk", [10, 2_000_000])
def test_odd_rows(spark, odd_docs, no_docs, clashing_docs, chunk):
    more = spark.createDataFrame(
        [(1, "ab " * 100_000, "en", None, 1), (2, "a b c " * 3 + "x " + "a b c\n" * 4, None, None, 1), (2, "  ".join("uvw" * 30), None, None, 1)],
        odd_docs.schema,
    )
    rules = RunRules(chunk_chars=chunk)
    rows = word_runs(odd_docs.unionByName(more), rules).select("_row.doc_id", "n_words", "runs", "collapsed").collect()
    texts = [*odd_docs.collect(), *more.collect()]
    want = []
    for r in texts:
        words = WORD.findall(r.text or "")
        runs = brute_runs(words) if len(words) < 20_000 else None
        want.append((r.doc_id, len(words), runs, collapsed(words, runs) if runs is not None else None))
    got = [(r.doc_id, r.n_words, [tuple(x) for x in r.runs] if r.n_words < 20_000 else None, r.collapsed if r.n_words < 20_000 else None) for r in rows]
    assert sorted(map(repr, got)) == sorted(map(repr, want))
    (long,) = [r for r in rows if r.n_words == 100_000]
    assert [tuple(x) for x in long.runs] == [(0, 100_000, 1)] and long.collapsed == "ab"
    assert word_runs(no_docs).count() == 0
    clashing = word_runs(clashing_docs.withColumns({c: F.lit(7) for c in ("runs", "collapsed", "n_words")}))
    assert clashing.where("_row.collapsed = 7 and _row._row = 7").count() == odd_docs.count()
