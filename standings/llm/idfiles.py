"""Token ids in files: blocks of ids as byte or bit planes, each compressed by zstandard.

A file is a Parquet file without compression of its own. A row is a chunk of whole documents:
their ids and lengths, the chunk's place in its shard, and its ids cut into blocks of a fixed
size. A block is stored as planes: the first byte (or bit) of all its ids, then the second, and
so on. Neighbouring ids differ most in their low planes; the high ones nearly vanish. Shards are
ranges of documents in ascending order. An index table holds each chunk's place in the whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from standings.llm.common import tidy
from standings.llm.tokens import TextEncoder, documents_of

CHUNKS = (
    "shard int, chunk int, start bigint, n_ids bigint, doc_id array<bigint>, n_tokens array<bigint>, "
    "blocks array<struct<n:int, planes:array<binary>>>"
)
DOCUMENTS = "shard int, doc_id bigint, start bigint, ids binary"


@dataclass(frozen=True)
class IdFileRules:
    """``block`` ids share a set of planes; a chunk closes at ``chunk`` ids; planes of 8 or 1 bits."""

    tokenizer: str
    end_id: int = 2
    block: int = 65_536
    chunk: int = 262_144
    plane_bits: int = 8
    level: int = 3


def to_planes(ids: np.ndarray, plane_bits: int) -> list[bytes]:
    raw = ids.astype("<u4").view(np.uint8).reshape(-1, 4)
    if plane_bits == 8:
        return [np.ascontiguousarray(raw[:, k]).tobytes() for k in range(4)]
    bits = np.unpackbits(raw, axis=1, bitorder="little")
    return [np.packbits(bits[:, k], bitorder="little").tobytes() for k in range(32)]


def from_planes(planes: list[bytes], n: int) -> np.ndarray:
    if len(planes) == 4:
        raw = np.stack([np.frombuffer(p, np.uint8) for p in planes], axis=1)
    else:
        bits = np.stack([np.unpackbits(np.frombuffer(p, np.uint8), bitorder="little")[:n] for p in planes], axis=1)
        raw = np.packbits(bits, axis=1, bitorder="little")
    return np.ascontiguousarray(raw).view("<u4").reshape(-1)


def _write_chunks(rules: IdFileRules):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = TextEncoder(rules.tokenizer, spaces=True, stay=True)
        press = zstandard.ZstdCompressor(level=rules.level)
        shard, chunk, start = TaskContext.get().partitionId(), 0, 0
        names, tokens, held = [], [], 0

        def close():
            nonlocal chunk, start
            ids = np.concatenate(tokens)
            blocks = [
                {"n": len(b), "planes": [press.compress(p) for p in to_planes(b, rules.plane_bits)]}
                for b in (ids[at : at + rules.block] for at in range(0, len(ids), rules.block))
            ]
            row = {
                "shard": [shard], "chunk": [chunk], "start": [start], "n_ids": [len(ids)],
                "doc_id": [names[:]], "n_tokens": [[len(t) for t in tokens]], "blocks": [blocks],
            }
            chunk, start = chunk + 1, start + len(ids)
            names.clear()
            tokens.clear()
            return pa.RecordBatch.from_pydict(row, schema=schema)

        for batch in tidy(batches):
            for doc_id, ids in documents_of(batch, encoder):
                names.append(doc_id)
                tokens.append(np.append(ids, np.uint32(rules.end_id)))
                held += len(tokens[-1])
                if held >= rules.chunk:
                    yield close()
                    held = 0
        if tokens:
            yield close()

    blocks = pa.list_(pa.struct([("n", pa.int32()), ("planes", pa.list_(pa.binary()))]))
    schema = pa.schema([
        ("shard", pa.int32()), ("chunk", pa.int32()), ("start", pa.int64()), ("n_ids", pa.int64()),
        ("doc_id", pa.list_(pa.int64())), ("n_tokens", pa.list_(pa.int64())), ("blocks", blocks),
    ])
    return run


def _read_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    expand = zstandard.ZstdDecompressor()
    for batch in tidy(batches):
        for i in range(len(batch)):
            row = batch.slice(i, 1).to_pylist()[0]
            ids = np.concatenate(
                [from_planes([expand.decompress(p) for p in b["planes"]], b["n"]) for b in row["blocks"]]
            )
            ends = np.cumsum(row["n_tokens"])
            starts = ends - row["n_tokens"]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(ends), row["shard"], np.int32)),
                    pa.array(row["doc_id"], pa.int64()),
                    pa.array(row["start"] + starts),
                    pa.array([ids[s:e].tobytes() for s, e in zip(starts, ends)], pa.binary()),
                ],
                ["shard", "doc_id", "start", "ids"],
            )


def write_ids(docs: DataFrame, path: str, rules: IdFileRules) -> None:
    """Write the ids of all texts, each closed by ``end_id``, in ascending order of doc_id.

    Null ids come first; rows that repeat an id follow each other, ordered by text. A null or
    empty text is its end id alone. Texts are dealt out by ranges of doc_id and encoded there.
    """
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ordered = texts.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    chunks = ordered.mapInArrow(_write_chunks(rules), CHUNKS)
    chunks.write.mode("overwrite").option("compression", "none").parquet(f"{path}/chunks")
    spark = docs.sparkSession
    written = spark.read.schema(CHUNKS).parquet(f"{path}/chunks")
    place = F.col("base") + F.col("start")
    index = written.join(F.broadcast(shard_bases(written)), "shard").select(
        "shard", "chunk", place.alias("start"), "n_ids", F.get("doc_id", F.lit(0)).alias("first_doc"),
        F.size("doc_id").alias("n_docs"),
    )
    index.write.mode("overwrite").parquet(f"{path}/index")


def shard_bases(chunks: DataFrame) -> DataFrame:
    """(shard, base): ids in all shards before; one row for each partition that was written."""
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    totals = chunks.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    return totals.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, ids) of every document written by `write_ids`; start counts from the first."""
    index = spark.read.parquet(f"{path}/index")
    bases = index.where("chunk = 0").select("shard", F.col("start").alias("base"))
    documents = spark.read.schema(CHUNKS).parquet(f"{path}/chunks").mapInArrow(_read_chunks, DOCUMENTS)
    return documents.join(F.broadcast(bases), "shard").select(
        "doc_id", (F.col("base") + F.col("start")).alias("start"), "ids"
    )
