import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from test_packing import library

from standings.llm.common import Stage
from standings.llm.idfiles import IdFileRules, from_planes, read_ids, to_planes, write_ids

BYTES = public_tokenizers.path("byte_bpe_50k.json")


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1), min_size=1, max_size=200), st.sampled_from([1, 8]))
def test_planes_round_trip(ids, bits):
    array = np.array(ids, "<u4")
    planes = to_planes(array, bits)
    assert len(planes) == 32 // bits
    assert from_planes(planes, len(ids)).tolist() == ids


def check(spark, docs, rules):
    path = f"{Stage(spark).path}/ids"
    write_ids(docs, path, rules)
    ids, at = library(rules.tokenizer), 0
    rows = sorted(docs.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text is not None, r.text or ""))
    found = read_ids(spark, path).orderBy("start").collect()
    assert len(found) == len(rows)
    for r, row in zip(found, rows):
        expected = ids(row.text) + [rules.end_id]
        assert (r.doc_id, r.start, np.frombuffer(r.ids, "<u4").tolist()) == (row.doc_id, at, expected)
        at += len(expected)
    index = spark.read.parquet(f"{path}/index").orderBy("start").collect()
    assert [r.start for r in index] == np.cumsum([0, *[r.n_ids for r in index]])[:-1].tolist()
    assert sum(r.n_docs for r in index) == len(rows) and sum(r.n_ids for r in index) == at


@pytest.mark.parametrize("bits", [1, 8])
def test_files_round_trip(spark, documents, odd_docs, bits):
    check(spark, documents.limit(60), IdFileRules(BYTES, block=500, chunk=3_000, plane_bits=bits))
    check(spark, odd_docs, IdFileRules(BYTES, block=700, chunk=1_000, plane_bits=bits))


def test_no_documents(spark, no_docs):
    path = f"{Stage(spark).path}/ids"
    write_ids(no_docs, path, IdFileRules(BYTES))
    assert read_ids(spark, path).count() == 0
