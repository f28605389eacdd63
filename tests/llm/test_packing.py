from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from standings.llm.packing import PackingRules, pack, pack_block
from standings.llm.tokens import TextEncoder

WORDS, BYTES = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")

ODD = [
    "", None, " a", "a ", "  a", "a  b", "a   b", " ", "  ", "a\n b", "a \n\n b", "\n", "\n\nx", "x  y", "x  y",
    "a \n", " 's 't", "<|endoftext|> x", "İstanbul Σας", "é́ a", "日本 語", "a\tb\r\nc", "don't I'll", " \n ",
    "<|endoftext|>", "x <|endoftext|> y", "a<|endoftext|>b <|startoftext|> c", "<|ENDOFTEXT|> <|endoftext", "x \x01 y",
    "\x01 a", "a \x01\x01", "\x01", "a. b, c; d.. e.; .f , . ..", "it's. we'll, x's!", "é. e\u0301. ß# 日. 語, ñ.\u0301 x", "5. 6, a5. a_. _,",
    "a.\nb. c,\n d.", "a . b", "don't. 't. 's, '", "ﬁ. Ⅷ. ǅ, ʰ. a\u00a0. b.\u00a0c", "x=\u0338 y.\u0338",
]


def library(path):
    tokenizer = Tokenizer.from_file(path)
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("path, spaces", [(BYTES, True), (WORDS, False)])
def test_encoder_equals_the_library(documents, path, spaces):
    encoder, ids = TextEncoder(path, spaces), library(path)
    texts = ODD + [r.text for r in documents.limit(60).collect()]
    flat, starts = encoder.encode(texts)
    for i, text in enumerate(texts):
        assert flat[starts[i] : starts[i + 1]].tolist() == ids(text), repr(text)[:80]


@pytest.mark.parametrize("path, spaces", [(BYTES, True), (WORDS, False)])
def test_encoder_equals_the_library_on_made_up_texts(path, spaces):
    ids, parts = library(path), ["a", "É", "'s", "don't", " ", " ", "\n", ".", ",", "#%", "\x01", "9", "日", "\u0301", "_", "<|endoftext|>"]

    @settings(max_examples=150, deadline=None)
    @given(st.lists(st.lists(st.sampled_from(parts), max_size=12).map("".join), min_size=1, max_size=8))
    def equal(texts):
        flat, starts = TextEncoder(path, spaces).encode(texts)
        assert [flat[s:e].tolist() for s, e in zip(starts, starts[1:])] == [ids(t) for t in texts]

    equal()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 300), min_size=1, max_size=60), st.sampled_from([16, 64, 100]))
def test_blocks_are_gapless_and_unpadded(lengths, capacity):
    pieces, used = pack_block(np.array(lengths), capacity, 32)
    covered, filled = defaultdict(list), defaultdict(list)
    for doc, start, length, sequence, offset in pieces:
        covered[doc].append((start, start + length))
        filled[sequence].append((offset, offset + length))
    for doc, length in enumerate(lengths):
        ends = [0, *[e for _, e in sorted(covered[doc])]]
        assert [s for s, _ in sorted(covered[doc])] == ends[:-1] and ends[-1] == length
    assert sorted(filled) == list(range(used))
    for spans in filled.values():
        ends = [0, *[e for _, e in sorted(spans)]]
        assert [s for s, _ in sorted(spans)] == ends[:-1]
        assert ends[-1] == capacity or (ends[-1] & (ends[-1] - 1)) == 0 and ends[-1] < capacity


def test_costs_are_balanced():
    lengths = np.random.default_rng(2).integers(1, 900, 2000)
    pieces, used = pack_block(lengths, 1024, 64)
    cost = defaultdict(float)
    for _, _, n, sequence, _ in pieces:
        cost[sequence] += n + n * n / (6 * 64)
    values = sorted(cost.values())
    in_order = np.add.reduceat(lengths + lengths**2 / 384, np.flatnonzero(np.diff(np.cumsum(lengths) // 1024, prepend=-1)))
    assert np.std(values[5:]) < 0.6 * np.std(in_order)


def check(docs, rules):
    ids = library(rules.tokenizer)
    rows = docs.collect()
    pieces = pack(docs, rules).collect()
    sequences, parts = defaultdict(list), defaultdict(list)
    for p in pieces:
        sequences[p.sequence_id].append(p)
        parts[p.doc_id].append(p)
        assert len(p.ids) == 4 * p.length > 0
    for own in sequences.values():
        ends = np.cumsum([0, *[p.length for p in sorted(own, key=lambda p: p.offset)]])
        assert sorted(p.offset for p in own) == ends[:-1].tolist()
        assert ends[-1] <= rules.capacity
    for doc_id in {r.doc_id for r in rows}:
        texts = [r.text for r in rows if r.doc_id == doc_id]
        expected = sorted(tuple(ids(t) + [rules.end_id]) for t in texts)
        if len(texts) == 1:
            whole = b"".join(bytes(p.ids) for p in sorted(parts[doc_id], key=lambda p: p.start))
            assert tuple(np.frombuffer(whole, "<u4").tolist()) == expected[0]
        assert sum(p.length for p in parts[doc_id]) == sum(map(len, expected))


def test_documents_and_odd_rows(documents, odd_docs, no_docs):
    check(documents.limit(80), PackingRules(WORDS))
    check(odd_docs, PackingRules(WORDS, capacity=256, block_tokens=5_000))
    assert pack(no_docs, PackingRules(WORDS)).count() == 0
