import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from standings.llm.common import Stage
from standings.llm.components import connected_components
from standings.llm.simhash import Forest, SimHash, fingerprint_of, keep_one_each, link_shards, near_duplicates


def plain_fingerprint(text, width=4):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(prints, radius=4):
    """Index -> smallest index that links reach."""
    parent = list(range(len(prints)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(prints)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= radius:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(prints))]


def unsigned(value):
    return value & ((1 << 64) - 1)


@pytest.mark.parametrize("rules", [SimHash(), SimHash(shard_rows=3)])
def test_components_match_all_pairs(spark, documents, rules):
    rows = sorted((r.doc_id, r.text) for r in documents.collect())
    prints = [plain_fingerprint(t) for _, t in rows]
    roots = classes(prints)
    found = {r.doc_id: (unsigned(r.fp), r.component_id) for r in near_duplicates(documents, rules).collect()}
    assert found == {i: (p, rows[root][0]) for (i, _), p, root in zip(rows, prints, roots)}


def test_long_texts_in_chunks(monkeypatch):
    text = " ".join(f"W{i % 991}" for i in range(3000))
    monkeypatch.setattr("standings.llm.simhash.SHINGLE_CHUNK", 100)
    assert unsigned(fingerprint_of(text)) == plain_fingerprint(text)


def near_prints(n, seed):
    """Balls of prints about a few centres, some chained, and strangers."""
    rng = np.random.default_rng(seed)
    centres = rng.integers(0, 1 << 63, max(2, n // 40), dtype=np.uint64)
    out = rng.choice(centres, n)
    for k in range(n):
        for bit in rng.integers(0, 64, rng.integers(0, 6)):
            out[k] ^= np.uint64(1) << np.uint64(bit)
    return np.unique(out)


def test_forest_finds_every_neighbour():
    values = near_prints(600, 3)
    shard = np.sort(np.random.default_rng(4).integers(0, 5, len(values)))
    forest = Forest(values, shard, np.ones(len(values), bool))
    q, n = forest.search(np.arange(len(values)), 4)
    pairs = {(a, b) for a, b in zip(q.tolist(), n.tolist())}
    expected = {
        (a, b)
        for a in range(len(values))
        for b in range(len(values))
        if a != b and shard[a] == shard[b] and int(values[a] ^ values[b]).bit_count() <= 4
    }
    assert pairs == expected


@pytest.mark.parametrize("pair_chunk", [50, 1_000_000])
def test_linking_with_skipped_queries(monkeypatch, pair_chunk):
    monkeypatch.setattr("standings.llm.simhash.PAIR_CHUNK", pair_chunk)
    values = near_prints(400, 7)
    everything = np.ones(len(values), bool)
    label = link_shards(values, np.zeros(len(values), np.int64), everything, everything, 4)
    assert label.tolist() == classes([int(v) for v in values])


def test_dense_balls_through_spark(spark):
    """Near copies whose prints crowd a few shards, over and under the size that is split."""
    values = near_prints(500, 11).view(np.int64)
    from standings.llm.simhash import near_links

    frame = spark.createDataFrame([(int(v),) for v in values], "fp bigint")
    expected = classes([unsigned(int(v)) for v in values])
    for rules in (SimHash(), SimHash(shard_rows=16)):
        links = connected_components(near_links(frame, rules), Stage(spark))
        found = {r.node: r.root for r in links.collect()}
        groups = {}
        for v, c in zip(values.tolist(), expected):
            groups.setdefault(found.get(v, v), set()).add(c)
        assert all(len(g) == 1 for g in groups.values()) and len(groups) == len(set(expected))


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(30)] + [(200, 201), (201, 200), (300, 300)]
    frame = spark.createDataFrame([*edges, (None, 5)], "a bigint, b bigint")
    found = {r.node: r.root for r in connected_components(frame, Stage(spark)).collect()}
    assert found == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}, 200: 200, 201: 200}


def test_odd_rows(spark, odd_docs, no_docs, clashing_docs):
    rows = near_duplicates(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    blank = [r for r in rows if r.fp == 0]
    assert {r.component_id for r in blank} == {0}
    assert near_duplicates(no_docs).count() == 0
    kept = keep_one_each(clashing_docs)
    assert kept.columns == clashing_docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert len(ids) == len({r.root for r in rows}) and 0 in ids and 8 in ids and 200 not in ids
    only_null = odd_docs.where(F.col("doc_id").isNull())
    assert {r.component_id for r in near_duplicates(only_null).collect()} == {None}
    assert keep_one_each(only_null).count() == 2


def test_a_link_between_two_grown_sets_is_seen(monkeypatch):
    """Set A is the largest first, then set B; one link of 4 bits joins an unsearched row of each."""
    monkeypatch.setattr("standings.llm.simhash.PAIR_CHUNK", 1)
    bits = lambda *at: sum(1 << b for b in at)
    a = [0, bits(0), bits(0, 1, 2, 3)]
    joined = a[2] ^ bits(20, 30, 40, 50)
    core = joined ^ bits(4, 5, 6, 7)
    b = [core, core ^ bits(8), core ^ bits(9), core ^ bits(10), joined]
    others = np.random.default_rng(3).integers(0, 1 << 63, 100, dtype=np.uint64).tolist()
    prints = a + b + others
    every = np.ones(len(prints), bool)
    label = link_shards(np.array(prints, np.uint64), np.zeros(len(prints), np.int64), every, every, 4)
    assert label.tolist() == [0] * 8 + list(range(8, len(prints)))
