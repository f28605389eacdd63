"""SimHash near-duplicates: fingerprints linked within a few bits, found in BK-trees.

A BK-tree keeps the children of a node by their integer Hamming distance to it; a search within
radius ``r`` at distance ``d`` follows only the edges ``d - r`` to ``d + r``. One tree of all
fingerprints would fit no task, so the trees are shards: the 64 bits are cut into blocks, and
fingerprints that differ in at most ``radius`` bits agree on all but ``radius`` of the blocks.
Every choice of that many agreeing blocks, with their bits, is a shard, so no link is lost. A
shard's tree travels with its queries in one shuffle; a shard over ``shard_rows`` is cut into
slices, and each slice's tree is sent to the queries of every slice.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from standings.llm.common import Stage, packed, tidy, unpacked, whole
from standings.llm.components import connected_components

HASH_SEED = 42
# Shingles hashed at a time, and (query, node) pairs followed at a time: bounds on memory only.
SHINGLE_CHUNK, PAIR_CHUNK = 65_536, 2_000_000


@dataclass(frozen=True)
class SimHash:
    """``width`` words a shingle, links within ``radius`` bits; ``blocks`` the bits are cut into."""

    width: int = 4
    radius: int = 4
    blocks: int = 6
    shard_rows: int = 8_192


def fingerprint_of(text: str | None, width: int = 4) -> int:
    """The signed 64-bit fingerprint: a bit is set if over half the shingles' hashes set it."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    span = min(width, len(words))
    first, last = starts[: len(words) - span + 1], ends[span - 1 :]
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, len(first), SHINGLE_CHUNK):
        pairs = zip(first[at : at + SHINGLE_CHUNK].tolist(), last[at : at + SHINGLE_CHUNK].tolist())
        hashes = np.array([digest(joined[s:e], HASH_SEED) for s, e in pairs], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(
            axis=0, dtype=np.int64
        )
    bits = (2 * ones > len(first)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


def fingerprint(text: Column, width: int = 4) -> Column:
    @F.pandas_udf("bigint")
    def simhash(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in tidy(texts):
            yield pd.Series([fingerprint_of(t, width) for t in batch], dtype="int64")

    return simhash(text)


def row_key() -> list[Column]:
    """Two hashes that tell documents apart: rows that agree in id and text are one document."""
    return [F.xxhash64("doc_id", "text").alias("_k1"), F.xxhash64(F.lit("key"), "text", "doc_id").alias("_k2")]


class Forest:
    """BK-trees of many shards as flat arrays; all searches of a chunk descend together."""

    def __init__(self, values: np.ndarray, shard: np.ndarray, inner: np.ndarray):
        """``shard`` is sorted; ``inner`` marks the rows that are nodes, the others only search."""
        self.values, self.shard = values, shard
        rows = np.flatnonzero(inner)
        _, first = np.unique(shard[rows], return_index=True)
        self.root = np.full(int(shard[-1]) + 1, -1)
        self.root[shard[rows[first]]] = rows[first]
        at = self.root[shard[rows]]
        rows, at = rows[at != rows], at[at != rows]
        keys, children = [], []
        while len(rows):
            key = at * 65 + np.bitwise_count(values[rows] ^ values[at])
            found, first, which = np.unique(key, return_index=True, return_inverse=True)
            keys.append(found)
            children.append(rows[first])
            at = rows[first][which]
            rows, at = rows[at != rows], at[at != rows]
        self.keys = np.concatenate(keys) if keys else np.empty(0, np.int64)
        order = np.argsort(self.keys)
        self.keys = self.keys[order]
        self.children = np.concatenate(children)[order] if keys else np.empty(0, np.int64)

    def search(self, queries: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, node) row numbers of all nodes within ``radius`` of the queries, in their shards."""
        node = self.root[self.shard[queries]]
        query, node = queries[node >= 0], node[node >= 0]
        found_q, found_n = [], []
        while len(query):
            distance = np.bitwise_count(self.values[query] ^ self.values[node]).astype(np.int64)
            near = (distance <= radius) & (query != node)
            found_q.append(query[near])
            found_n.append(node[near])
            lo = np.searchsorted(self.keys, node * 65 + np.maximum(distance - radius, 0))
            hi = np.searchsorted(self.keys, node * 65 + np.minimum(distance + radius, 64), "right")
            many = hi - lo
            step = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            node = self.children[np.repeat(lo, many) + step]
            query = np.repeat(query, many)
        if not found_q:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return np.concatenate(found_q), np.concatenate(found_n)


def merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the sets of ``a[i]`` and ``b[i]``; ``label`` holds the smallest row of each set."""
    while True:
        la, lb = label[a], label[b]
        apart = la != lb
        if not apart.any():
            return
        np.minimum.at(label, np.maximum(la, lb)[apart], np.minimum(la, lb)[apart])
        while (label[label] != label).any():
            label[:] = label[label]


def link_shards(values: np.ndarray, shard: np.ndarray, inner: np.ndarray, asks: np.ndarray, radius: int) -> np.ndarray:
    """For every row the smallest row that links within its shard connect it to.

    A row that is already connected to every node of its shard need not search. Where all nodes
    search, one set need not: its links to others are found from the other end. It is chosen once
    for a shard, the largest after the first searches; later only rows that have joined it go, as
    a link between two sets that both did not search would be seen from neither end.
    """
    label = np.arange(len(values))
    forest = Forest(values, shard, inner)
    sizes = np.bincount(shard, weights=inner).astype(np.int64)
    sizes_all = np.bincount(shard)
    queries = np.flatnonzero(asks & (sizes[shard] > 0) & (sizes_all[shard] > 1))
    symmetric = np.bincount(shard, weights=inner & asks) == sizes_all
    # A row of the set that need not search, by shard; the label of that row names the set.
    spared = np.full(len(sizes_all), -1)
    while len(queries):
        cost = np.cumsum(sizes[shard[queries]])
        take = max(1, int(np.searchsorted(cost, PAIR_CHUNK, "right")))
        merge(label, *forest.search(queries[:take], radius))
        queries = queries[take:]
        if len(queries) and sizes[shard[queries[0]]] > 64:
            here = shard[queries[0]]
            own = np.flatnonzero((shard == here) & inner)
            names, counts = np.unique(label[own], return_counts=True)
            if symmetric[here] or len(names) == 1:
                if spared[here] < 0:
                    spared[here] = names[counts.argmax()]
                queries = queries[(shard[queries] != here) | (label[queries] != label[spared[here]])]
    return label


def _link_batches(radius: int):
    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by shard; a shard that goes on in the next batch waits for it."""
        held = None
        for batch in tidy(batches):
            frame = batch.to_pandas()
            held = frame if held is None else pd.concat([held, frame], ignore_index=True)
            ids = held[["key", "lo", "hi"]].to_numpy()
            new = np.flatnonzero((ids[1:] != ids[:-1]).any(axis=1))
            if len(new):
                cut = int(new[-1]) + 1
                yield linked(held.iloc[:cut])
                held = held.iloc[cut:].reset_index(drop=True)
        if held is not None and len(held):
            yield linked(held)

    def linked(frame: pd.DataFrame) -> pa.RecordBatch:
        ids = frame[["key", "lo", "hi"]].to_numpy()
        shard = np.concatenate(([0], np.cumsum((ids[1:] != ids[:-1]).any(axis=1))))
        signed = frame["fp"].to_numpy()
        lo, hi, part = frame["lo"].to_numpy(), frame["hi"].to_numpy(), frame["part"].to_numpy()
        label = link_shards(signed.view(np.uint64), shard, part == lo, part == hi, radius)
        far = np.flatnonzero(label != np.arange(len(label)))
        return pa.RecordBatch.from_arrays([pa.array(signed[far]), pa.array(signed[label[far]])], ["a", "b"])

    return link


def shard_keys(fp: Column, radius: int, blocks: int) -> Column:
    """One key for each choice of ``blocks - radius`` blocks, with the bits there."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    cut = [
        (F.shiftrightunsigned(fp, lo).bitwiseAND(F.lit((1 << (hi - lo)) - 1).cast("bigint")), hi - lo)
        for lo, hi in zip(edges, edges[1:])
    ]
    keys = []
    for number, chosen in enumerate(combinations(cut, blocks - radius)):
        key = F.lit(number).cast("bigint")
        for bits, width in chosen:
            key = F.shiftleft(key, width).bitwiseOR(bits)
        keys.append(key)
    return F.array(*keys)


def near_links(fingerprints: DataFrame, rules: SimHash) -> DataFrame:
    """Links (a, b) that connect the distinct fingerprints ``fp`` just as all near pairs would."""
    sharded = fingerprints.select(
        "fp", F.explode(shard_keys(F.col("fp"), rules.radius, rules.blocks)).alias("key")
    )
    sizes = sharded.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    large = sizes.where(F.col("n") > rules.shard_rows).select(
        "key", F.ceil(F.col("n") / rules.shard_rows).cast("int").alias("parts")
    )
    parts = F.coalesce(F.col("parts"), F.lit(1))
    part = F.pmod(F.xxhash64("fp"), parts).cast("int")
    spread = (
        sharded.join(large, "key", "left")
        .select("fp", "key", part.alias("part"), F.explode(F.sequence(F.lit(0), parts - 1)).alias("other"))
        .select("fp", "key", "part", F.least("part", "other").alias("lo"), F.greatest("part", "other").alias("hi"))
    )
    return (
        spread.repartition("key", "lo", "hi")
        .sortWithinPartitions("key", "lo", "hi", "fp")
        .mapInArrow(_link_batches(rules.radius), "a bigint, b bigint")
    )


def near_duplicates(docs: DataFrame, rules: SimHash = SimHash(), stage: Stage | None = None) -> DataFrame:
    """(_k1, _k2, doc_id, fp, root, component_id), one row for each row of ``docs``.

    Texts without words, null or empty, share fingerprint 0 and so one component. ``component_id``
    is the smallest id of the component, null if none has an id; repeated rows are linked by their
    equal fingerprints. Exact copies meet as one fingerprint before any search.
    """
    stage = stage or Stage(docs.sparkSession)
    rows = stage.keep(
        docs.select(*row_key(), "doc_id", fingerprint(whole(F.col("text")), rules.width).alias("fp")), "fingerprints"
    )
    distinct = rows.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    links = connected_components(near_links(distinct.select("fp"), rules), stage)
    rooted = distinct.join(links, F.col("fp") == F.col("node"), "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root")
    )
    rooted = stage.keep(rooted, "rooted")
    named = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return rows.join(rooted.join(named, "root").select("fp", "root", "component_id"), "fp")


def keep_one_each(docs: DataFrame, rules: SimHash = SimHash()) -> DataFrame:
    """One row of each component of `near_duplicates`: that with the smallest id, nulls last."""
    classes = near_duplicates(docs, rules)
    chosen = (
        classes.groupBy("root")
        .agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "_k1", "_k2")).alias("_first"))
        .select("_first._k1", "_first._k2")
    )
    keyed = packed(docs, _k1=row_key()[0], _k2=row_key()[1])
    return unpacked(keyed.join(chosen, ["_k1", "_k2"], "left_semi").dropDuplicates(["_k1", "_k2"]))
