"""SentencePiece encoding and decoding over a relational lattice.

White space becomes ``▁`` and a text is cut before every run of it: no piece crosses such a cut.
Nor does one cross two neighbouring characters that no piece of the model holds side by side, so
words are cut there again, into segments. Each different segment is encoded once. Its substrings up to the longest piece are exploded and
joined to the piece table on equality; the edges found are grouped by segment, and a higher-order
``aggregate`` folds them into a segmentation. The model at hand is a BPE model, whose result is
not the path of best total score: the fold goes through the edges from the best score down and
joins the two neighbours that an edge spans, as the model's merges do. The state is a bitmap of
the cuts still open.

Documents travel as blocks: a code for each word of the text, codes of segments for each different
word, and a dictionary of segments, which goes out by segment and comes back as ids; text is never
shuffled.
"""

from __future__ import annotations

import heapq
import pickle
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from standings.llm.common import give_back, tidy

SPACE = "▁"
# Longest segment whose cuts fit the bitmap, words and characters in a block, and rows given to Spark at a time.
BITMAP_CHARS, BLOCK_WORDS, BLOCK_CHARS, ROWS_AT_ONCE = 60, 4_000_000, 32_000_000, 50_000
# Documents that leave a Python worker at a time.
DOCS_AT_ONCE = 500
SEGMENTS, HEADS = "block bigint, pos int, word string", "block bigint, payload binary"
ENCODED, DECODED = "doc_id bigint, ids binary", "doc_id bigint, ids binary, text string"
# A place is a block's number and, in its lowest 24 bits, a segment's; the last one is that of the codes.
LAST = (1 << 24) - 1


@dataclass(frozen=True)
class PieceModel:
    """At most 65,536 pieces, which `load` checks. The pieces of a model file: id, rank by score (best first) and text; bytes stand for the rest."""

    table: list[tuple[int, int, str]]
    first_byte: int
    longest: int

    @staticmethod
    def load(path: str) -> PieceModel:
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        if model.get_piece_size() > 1 << 16:
            raise ValueError(f"{path} has {model.get_piece_size()} pieces; ids travel as two bytes")
        plain = [
            i
            for i in range(model.get_piece_size())
            if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))
        ]
        scores = sorted({model.get_score(i) for i in plain}, reverse=True)
        rank = {score: k for k, score in enumerate(scores)}
        table = [(i, rank[model.get_score(i)], model.id_to_piece(i)) for i in plain]
        return PieceModel(table, model.piece_to_id("<0x00>"), max(len(p) for _, _, p in table))

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.table, "id int, rank int, piece string")

    def neighbours(self) -> tuple[np.ndarray, np.ndarray]:
        """A number for each character, 0 if no piece joins it to another, and which numbers stand side by side in a piece."""
        pairs = {p[i : i + 2] for _, _, p in self.table for i in range(len(p) - 1)}
        number = np.zeros(0x110000, np.uint16)
        chars = sorted(set("".join(pairs)))
        number[[ord(c) for c in chars]] = np.arange(1, len(chars) + 1)
        beside = np.zeros((len(chars) + 1, len(chars) + 1), bool)
        for a, b in pairs:
            beside[number[ord(a)], number[ord(b)]] = True
        return number, beside

    def piece_bytes(self) -> dict[int, bytes]:
        known = {i: p.encode() for i, _, p in self.table}
        return known | {self.first_byte + b: bytes([b]) for b in range(256)}


def merge_word(word: str, pieces: dict[str, tuple[int, int]], first_byte: int) -> list[int]:
    """One word's ids by the merges themselves: best rank first, then leftmost.

    For segments that the bitmap cannot hold, or that begin with three spaces or more, whose pieces
    share one score. ``pieces`` gives (rank, id).
    """
    n = len(word)
    end, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
    heap: list[tuple[int, int, int]] = []

    def offer(left: int) -> None:
        if left >= 0 and end[left] < n:
            found = pieces.get(word[left : end[end[left]]])
            if found:
                heapq.heappush(heap, (found[0], left, end[end[left]]))

    for i in range(n):
        offer(i)
    while heap:
        _, left, until = heapq.heappop(heap)
        middle = end[left]
        if not alive[left] or middle >= n or end[middle] != until or not alive[middle]:
            continue
        end[left], alive[middle] = until, False
        if until < n:
            before[until] = left
        offer(left)
        offer(before[left])
    out: list[int] = []
    at = 0
    while at < n:
        found = pieces.get(word[at : end[at]])
        out += [found[1]] if found else [first_byte + b for b in word[at : end[at]].encode("utf-8", "surrogatepass")]
        at = end[at]
    return out


def encode_words(words: DataFrame, model: PieceModel) -> DataFrame:
    """(word, ids) for the distinct rows of ``words`` (word, key), key a number of the word's own.

    ``word`` is a segment, not empty, and not odd (`are_odd`). If rows are dealt out by
    word, grouping needs no shuffle. The piece table is as small as the model's vocabulary and is
    broadcast.
    """
    table = F.broadcast(model.frame(words.sparkSession))
    starts = words.select("key", "word", F.explode(F.expr("sequence(0L, length(word) - 1L)")).alias("s"))
    reach = F.expr(f"sequence(1L, least({model.longest}, length(word) - s))")
    spans = starts.select("key", "word", "s", F.explode(reach).alias("size"))
    # An edge is one number: rank, start and end (six bits each), id plus one, 0 for a lone character.
    edge = F.expr(
        "shiftleft(cast(coalesce(rank, 0) as bigint), 32) | shiftleft(s, 26) | shiftleft(s + size, 20) | (coalesce(id, -1) + 1)"
    )
    edges = (
        spans.join(table, F.expr("substring(word, cast(s + 1 as int), cast(size as int))") == F.col("piece"), "left")
        .where("id is not null or size = 1")
        .select("key", "word", edge.alias("edge"))
    )
    lattice = edges.groupBy("key", "word").agg(F.sort_array(F.collect_list("edge")).alias("edges"))
    start, end = "cast(shiftright(x, 26) & 63 as int)", "cast(shiftright(x, 20) & 63 as int)"
    inner = f"(shiftleft(1L, {end} - {start} - 1) - 1)"
    # The cuts are bound as a lambda's variable: a column could be pulled into the inner lambdas.
    open_cuts = f"""aggregate(edges, shiftleft(1L, length(word) + 1) - 1, (open, x) ->
        case when {end} - {start} > 1
              and (shiftright(open, {start}) & 1) = 1 and (shiftright(open, {end}) & 1) = 1
              and bit_count(shiftright(open, {start} + 1) & {inner}) = 1
             then open & ~shiftleft({inner}, {start} + 1)
             else open end)"""
    path = f"""transform(array({open_cuts}), open -> sort_array(transform(
        filter(edges, x -> (shiftright(open, {start}) & (shiftleft(1L, {end} - {start} + 1) - 1))
                           = shiftleft(1L, {end} - {start}) + 1),
        x -> shiftleft(shiftright(x, 26) & 63, 20) | (x & 1048575))))[0]"""
    letter = "substring(word, cast(shiftright(x, 20) as int) + 1, 1)"
    spelled = f"""transform(sequence(1, octet_length({letter})), k -> {model.first_byte}
        + cast(conv(substring(hex(encode({letter}, 'UTF-8')), 2 * k - 1, 2), 16, 10) as int))"""
    ids = f"""flatten(transform({path}, x ->
        case when x & 1048575 > 0 then array(cast((x & 1048575) - 1 as int)) else {spelled} end))"""
    return lattice.select("word", F.expr(ids).alias("ids"))


def are_odd(segments: pa.Array) -> np.ndarray:
    """Whether the bitmap cannot hold a segment, or it begins with a run of spaces, whose pieces share one score."""
    wide = pc.or_(pc.greater(pc.utf8_length(segments), BITMAP_CHARS), pc.starts_with(segments, SPACE * 3))
    return wide.to_numpy(zero_copy_only=False)


def cut_words(words: pa.Array, neighbours: tuple[np.ndarray, np.ndarray]) -> tuple[pa.Array, np.ndarray]:
    """The segments of all words, one after the other, and how many each word has."""
    text = "".join(words.to_pylist())
    chars = np.frombuffer(text.encode("utf-32-le"), "<u4")
    number, beside = neighbours
    numbers = number[chars]
    last = np.append(~beside[numbers[:-1], numbers[1:]], True)
    ends = np.cumsum(pc.utf8_length(words).to_numpy(zero_copy_only=False))
    last[ends - 1] = True
    width = 1 + (chars >= 0x80).astype(np.int8) + (chars >= 0x800) + (chars >= 0x10000)
    offsets = np.append(0, np.cumsum(width, dtype=np.int64)[last])
    segments = pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets), pa.py_buffer(text.encode()))
    return segments, np.diff(np.append(0, np.cumsum(last)[ends - 1]))


WORD = re.compile(f"{SPACE}+[^{SPACE}]*")


def cut_single(texts: pa.Array) -> pa.Array:
    """The words of texts, less the ``▁`` that each begins with; only one space stands between two words."""
    return pc.split_pattern(texts, " ").cast(pa.large_list(pa.large_string()))


def cut_runs(texts: pa.Array) -> pa.Array:
    """As `cut_single`, for any text: a word begins with its run of spaces; an empty text has none."""
    marked = [SPACE + t.replace(" ", SPACE) if t else t for t in texts.to_pylist()]
    return pa.array([[w[1:] for w in WORD.findall(t)] for t in marked], pa.large_list(pa.large_string()))


def unified(parts: list[pa.DictionaryArray]) -> tuple[pa.Array, list[np.ndarray]]:
    """One dictionary for all parts, and the codes of each; the list is emptied, so that its parts can go."""
    same = pa.chunked_array(parts).unify_dictionaries()
    parts.clear()
    return same.chunk(0).dictionary, [x.indices.to_numpy(zero_copy_only=False) for x in same.chunks]


def to_planes(codes: np.ndarray) -> np.ndarray:
    """Planes of bytes, highest first, compress better than whole codes (0 or more).

    Frequent codes are small, so a byte under zeros only comes apart from the others of its plane.
    """
    planes = codes.astype("<i4", copy=False).view(np.uint8).reshape(-1, 4)
    cut = [planes[:, 3], planes[:, 2]]
    for k in (1, 0):
        small = codes < 1 << 8 * (k + 1)
        cut += [planes[small, k], planes[~small, k]]
    return np.concatenate(cut)


def from_planes(cut: bytes) -> np.ndarray:
    raw = np.frombuffer(cut, np.uint8)
    n = len(raw) // 4
    planes = np.zeros((n, 4), np.uint8)
    codes = planes.view("<i4").reshape(-1)
    planes[:, 3], planes[:, 2] = raw[:n], raw[n : 2 * n]
    for k, at in ((1, 2 * n), (0, 3 * n)):
        small = codes < 1 << 8 * (k + 1)
        until = at + np.count_nonzero(small)
        planes[small, k], planes[~small, k] = raw[at:until], raw[until : at + n]
    return codes


def _make_blocks(model: PieceModel, heads: bool):
    """Blocks of documents: a row with a block's codes (`HEADS`) or one for each segment of its dictionary (`SEGMENTS`).

    Odd segments are rare: their ids are made here and stay with the codes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _blocks_of(batches, model, heads)
        give_back()

    return run


def _blocks_of(batches: Iterator[pa.RecordBatch], model: PieceModel, heads: bool) -> Iterator[pa.RecordBatch]:
    press = zstandard.ZstdCompressor(level=3)
    pieces = {p: (rank, i) for i, rank, p in model.table} if heads else {}
    neighbours = model.neighbours()
    block = TaskContext.get().partitionId() << 20
    lead, none_between = pa.scalar(SPACE, pa.large_string()), pa.scalar("", pa.large_string())
    names, counts, lists, held, chars = [], [], [], 0, 0

    def coded(values: pa.Array) -> pa.DictionaryArray:
        """The values' dictionary and codes; without codes where only dictionaries go out."""
        own = values.dictionary_encode()
        return own if heads else pa.DictionaryArray.from_arrays(pa.array([], pa.int32()), own.dictionary)

    def close():
        nonlocal block
        words, codes = unified(lists)
        codes = [press.compress(to_planes(c)) for c in codes]
        words = pc.binary_join_element_wise(lead, words, none_between)
        parts, many = [], [np.zeros(0, np.int64)]
        for at in range(0, len(words), ROWS_AT_ONCE):
            cut, n = cut_words(words.slice(at, ROWS_AT_ONCE), neighbours)
            parts.append(coded(cut))
            many.append(n)
        del words
        segments, spelled = unified(parts or [coded(pa.array([], pa.large_string()))])
        spelled = [press.compress(to_planes(c)) for c in spelled]
        give_back()
        wide = are_odd(segments)
        odd, plain = np.flatnonzero(wide), np.flatnonzero(~wide).astype(np.int32)
        if heads:
            odd_ids = [np.array(merge_word(w, pieces, model.first_byte), "<u2").tobytes() for w in segments.take(odd).to_pylist()]
            check = 0
            for at in range(0, len(plain), ROWS_AT_ONCE):
                own = segments.take(plain[at : at + ROWS_AT_ONCE]).to_pylist()
                check += sum(zlib.crc32(w.encode()) & 0xFF for w in own)
            many = press.compress(to_planes(np.concatenate(many)))
            # Each part's codes are compressed alone, so that no worker holds all of them unpacked.
            payload = pickle.dumps((names, counts, codes, many, spelled, odd, odd_ids, len(plain), check))
            yield pa.RecordBatch.from_arrays([pa.array([block]), pa.array([payload], pa.binary())], ["block", "payload"])
        else:
            for at in range(0, len(plain), ROWS_AT_ONCE):
                place = plain[at : at + ROWS_AT_ONCE]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(place), block)), pa.array(place), segments.take(place).cast(pa.string())],
                    ["block", "pos", "word"],
                )
        block += 1
        names.clear()
        counts.clear()

    for batch in tidy(batches):
        for at in range(0, len(batch), 1_000):
            part = batch.slice(at, 1_000)
            text = pc.fill_null(part.column("text"), "").cast(pa.large_string())
            chars += pc.sum(pc.utf8_length(text)).as_py()
            runs = pc.or_(pc.match_substring(text, "  "), pc.starts_with(text, " "))
            runs = pc.or_(runs, pc.or_(pc.match_substring(text, SPACE), pc.equal(text, "")))
            for mask, cut in ((pc.invert(runs), cut_single), (runs, cut_runs)):
                own = text.filter(mask)
                if len(own):
                    names.extend(part.column("doc_id").filter(mask).to_pylist())
                    own = cut(own)
                    # Parts are held as dictionaries and codes, which take less than their words.
                    counts.append(pc.list_value_length(own).to_numpy(zero_copy_only=False))
                    lists.append(coded(own.values))
                    held += len(own.values)
            own = text = None
            if held >= BLOCK_WORDS or chars >= BLOCK_CHARS:
                yield from close()
                held, chars = 0, 0
        batch = part = text = runs = mask = own = None
    if names:
        yield from close()


def gathered(table: np.ndarray, start: np.ndarray, size: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The stretches of ``table`` that ``codes`` stand for, one after the other, and their bounds."""
    many = size[codes]
    bounds = np.concatenate(([0], np.cumsum(many)))
    place = np.repeat((start[codes] - bounds[:-1]).astype(np.int32), many)
    place += np.arange(bounds[-1], dtype=np.int32)
    return table[place], bounds


def unpacked_ids(payloads: pa.Array) -> tuple[np.ndarray, np.ndarray, int]:
    """The ids of all segments, one after the other, how many each has, and the sum of the checksums behind them."""
    payloads = payloads.cast(pa.large_binary())
    ends = np.frombuffer(payloads.buffers()[1], "<i8")[payloads.offset : payloads.offset + len(payloads) + 1]
    raw = np.frombuffer(payloads.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
    last = ends[1:] - ends[0] - 1
    return np.delete(raw, last).view("<u2"), (np.diff(ends) // 2).astype(np.int32), int(raw[last].sum(dtype=np.int64))


def _assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of block and place: a block's codes, then the ids of its dictionary.

    The last byte of a segment's payload is of its checksum: the segments must be those that the
    codes stand for. What has come of a block is held as arrays, not as an object for each segment.
    """
    expand = zstandard.ZstdDecompressor()
    block, head, found = None, None, []

    def codes_of(pressed: bytes) -> np.ndarray:
        return from_planes(expand.decompress(pressed))

    def close():
        nonlocal head
        names, counts, codes, many, spelled, odd, odd_ids, n_plain, check = pickle.loads(head)
        head = None
        places, ids, sizes, checks = zip(*found) if found else ((), (), (), ())
        found.clear()
        if sum(map(len, places)) != n_plain or sum(checks) != check:
            raise ValueError(f"the words of block {block} are not those that its codes stand for")
        order = np.argsort(np.concatenate([np.asarray(odd, np.int32), *places]), kind="stable")
        sizes = np.concatenate([np.array([len(i) // 2 for i in odd_ids], np.int32), *sizes])
        start, size = (np.cumsum(sizes) - sizes)[order], sizes[order]
        table = np.concatenate([np.frombuffer(b"".join(odd_ids), "<u2"), *ids])
        del places, ids, sizes, order, odd_ids
        # From the ids of segments to those of words.
        parts, bounds = [], [np.zeros(1, np.int64)]
        for pressed in spelled:
            out, until = gathered(table, start, size, codes_of(pressed))
            parts.append(out)
            bounds.append(until[1:] + bounds[-1][-1])
        table, bounds = np.concatenate(parts), np.concatenate(bounds)
        bounds = bounds[np.concatenate(([0], np.cumsum(codes_of(many))))]
        start, size = bounds[:-1], np.diff(bounds)
        del parts, bounds
        give_back()
        first = 0
        for n, pressed in zip(counts, codes, strict=True):
            own, ends = codes_of(pressed), np.concatenate(([0], np.cumsum(n)))
            for at in range(0, len(n), DOCS_AT_ONCE):
                stop = min(at + DOCS_AT_ONCE, len(n))
                out, until = gathered(table, start, size, own[ends[at] : ends[stop]])
                out = out.astype("<u4")
                edge = until[ends[at : stop + 1] - ends[at]]
                texts = [out[a:b].tobytes() for a, b in zip(edge, edge[1:])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names[first + at : first + stop], pa.int64()), pa.array(texts, pa.binary())], ["doc_id", "ids"]
                )
            first += len(n)

    for batch in tidy(batches):
        pos = (batch.column("place").to_numpy() & LAST).astype(np.int32)
        bounds = sorted({0, len(batch), *np.flatnonzero(pos == LAST).tolist()})
        for a, b in zip(bounds, bounds[1:]):
            if pos[a] == LAST:
                if head is not None:
                    yield from close()
                block, head = batch.column("place")[a].as_py() >> 24, batch.column("payload")[a].as_py()
                a += 1
            if a < b:
                ids, sizes, checks = unpacked_ids(batch.column("payload").slice(a, b - a))
                found.append((pos[a:b], ids, sizes, checks))
        batch = None
    if head is not None:
        yield from close()
    give_back()


def encode(docs: DataFrame, model: PieceModel) -> DataFrame:
    """(doc_id, ids) for each row: the library's ids, as little-endian 32-bit numbers.

    Null and empty texts have none. Repeated rows are encoded alike. Other columns are not read.
    Two shuffles: segments by their text, once for both the lattice and the way back; ids with the
    blocks' codes by block. A frequent segment is one row of each block's dictionary.
    """
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # Both go through the texts; neither holds or moves what only the other needs.
    segments, heads = (texts.mapInArrow(_make_blocks(model, h), kind) for h, kind in ((False, SEGMENTS), (True, HEADS)))
    place = F.shiftleft("block", 24).bitwiseOR(F.col("pos").cast("bigint"))
    # A segment's rows grow about twentyfold in the lattice, so it gets smaller partitions than others.
    parts = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    entries = segments.where("word is not null").select("word", place.alias("place")).repartition(parts, "word")
    words = entries.groupBy("word").agg(F.min("place").alias("key"))
    low_high = "concat(lpad(hex(i & 255), 2, '0'), lpad(hex(shiftright(i, 8) & 255), 2, '0'))"
    packed = F.expr(
        f"unhex(concat(array_join(transform(ids, i -> {low_high}), ''), lpad(hex(crc32(word) & 255), 2, '0')))"
    )
    coded = encode_words(words, model).select(F.col("word").alias("w"), packed.alias("payload"))
    back = entries.join(coded, F.col("word") == F.col("w")).select("place", "payload")
    heads = heads.select(F.shiftleft("block", 24).bitwiseOR(F.lit(LAST)).alias("place"), "payload")
    # The row with a block's codes comes first of its block.
    first = F.when(F.col("place").bitwiseAND(F.lit(LAST)) == LAST, F.col("place") - LAST - 1).otherwise(F.col("place"))
    return (
        heads.unionByName(back)
        .repartition(F.shiftright("place", 24))
        .sortWithinPartitions(F.shiftright("place", 24), first)
        .mapInArrow(_assemble, ENCODED)
    )


def decode(encoded: DataFrame, model: PieceModel) -> DataFrame:
    """(doc_id, ids, text): pieces joined, ``▁`` a space again, less the space that encoding adds."""
    return encoded.select("doc_id", "ids").mapInArrow(_spell(model.piece_bytes()), DECODED)


def _spell(known: dict[int, bytes]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = [known.get(i, b"") for i in range(max(known) + 1)]
        size = np.array([len(p) for p in pieces], np.int64)
        table, start = np.frombuffer(b"".join(pieces), np.uint8), np.cumsum(size) - size
        for batch in tidy(batches):
            for at in range(0, len(batch), DOCS_AT_ONCE):
                part = batch.slice(at, DOCS_AT_ONCE)
                own = part.column("ids").to_pylist()
                raw, bounds = gathered(table, start, size, np.frombuffer(b"".join(own), "<i4"))
                raw, edge = raw.tobytes(), bounds[np.cumsum([0] + [len(ids) // 4 for ids in own])].tolist()
                texts = [raw[a:b].decode("utf-8", "replace").replace(SPACE, " ")[1:] for a, b in zip(edge, edge[1:])]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], ["doc_id", "ids", "text"])
            batch = part = own = raw = bounds = texts = None

    return run
