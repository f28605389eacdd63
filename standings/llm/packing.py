"""Cost-balanced packing of documents into training sequences.

The cost of a piece of n tokens is estimated as ``n + n * n / (6 * width)``: the linear layers
and the attention of a transformer of that width, in which a document attends to itself. Each
task packs its documents in blocks. In a block, pieces go in descending order to the
lowest-cost sequence that still has room for them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from standings.llm.common import tidy
from standings.llm.tokens import TextEncoder, documents_of

SCHEMA = "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint"


@dataclass(frozen=True)
class PackingRules:
    """Sequences of ``capacity`` tokens; ``end_id`` closes a document; a block closes at
    ``block_tokens`` tokens, which bounds a task's memory."""

    tokenizer: str
    capacity: int = 2048
    end_id: int = 1
    width: int = 1024
    block_tokens: int = 4_000_000


def pack_block(lengths: np.ndarray, capacity: int, width: int) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Pieces (document, start, length, sequence, offset) and the number of sequences.

    A document's whole stretches of ``capacity`` tokens are sequences of their own. What is left
    of all documents goes into full sequences, and what that leaves into sequences whose sizes
    are powers of two, so nothing is padded. A piece that fits nowhere is cut at the end of the
    roomiest sequence.
    """
    pieces, sequence = [], 0
    for doc, length in enumerate(lengths):
        for start in range(0, length - capacity + 1, capacity):
            pieces.append((doc, start, capacity, sequence, 0))
            sequence += 1
    rest = lengths % capacity
    full, tail = divmod(int(rest.sum()), capacity)
    sizes = np.array([capacity] * full + [1 << k for k in reversed(range(capacity.bit_length())) if tail >> k & 1], np.int64)
    room, cost = sizes.copy(), np.zeros(len(sizes))
    for doc in np.argsort(-rest, kind="stable"):
        left = int(rest[doc])
        while left:
            fitting = np.flatnonzero(room >= left)
            at = int(fitting[cost[fitting].argmin()]) if len(fitting) else int(room.argmax())
            take = min(left, int(room[at]))
            pieces.append((int(doc), int(lengths[doc]) - left, take, sequence + at, int(sizes[at] - room[at])))
            room[at] -= take
            cost[at] += take + take * take / (6 * width)
            left -= take
    return pieces, sequence + len(sizes)


def _pack_partition(rules: PackingRules):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = TextEncoder(rules.tokenizer, spaces=False)
        first = TaskContext.get().partitionId() << 32
        names, tokens, held = [], [], 0

        def block():
            nonlocal first
            lengths = np.array([len(t) for t in tokens], np.int64)
            pieces, used = pack_block(lengths, rules.capacity, rules.width)
            doc, start, length, sequence, offset = (list(x) for x in zip(*pieces))
            columns = [
                pa.array([names[d] for d in doc], pa.int64()),
                pa.array(start, pa.int64()),
                pa.array(length, pa.int64()),
                pa.array([tokens[d][s : s + n].tobytes() for d, s, n in zip(doc, start, length)], pa.binary()),
                pa.array(lengths[doc]),
                pa.array(first + np.array(sequence, np.int64)),
                pa.array(offset, pa.int64()),
            ]
            first += used
            names.clear()
            tokens.clear()
            whole = pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])
            for at in range(0, len(whole), 2_000):
                yield whole.slice(at, 2_000)

        for batch in tidy(batches):
            for doc_id, ids in documents_of(batch, encoder):
                names.append(doc_id)
                tokens.append(np.append(ids, np.uint32(rules.end_id)).astype("<u4"))
                held += len(tokens[-1])
                if held >= rules.block_tokens:
                    yield from block()
                    held = 0
        if tokens:
            yield from block()

    return run


def pack(docs: DataFrame, rules: PackingRules) -> DataFrame:
    """One row per piece: its document, its ids (little-endian 32 bit) and its place.

    Each id of a document and its end id lie in exactly one piece; pieces fill a sequence without
    gaps. A null or empty text is its end id alone. Repeated rows are packed once each. Sequence
    ids hold the partition's number, so tasks need not agree on anything and a task that runs
    again gives the same pieces. Other columns are not read. No rows are shuffled.
    """
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(_pack_partition(rules), SCHEMA)
