import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from standings.llm.exact import ExactRules, exact_duplicates, keep_one_of_equals


def judged(docs, rules=ExactRules(), **more):
    found = exact_duplicates(docs, rules, carry_text=True, **more)
    return found.select("_row.doc_id", "_row.text", "keep_id", "group_size", "kept", "text_hash").collect()


def check(rows, hash_all):
    groups = defaultdict(list)
    for r in rows:
        groups[r.text or ""].append(r)
    for text, own in groups.items():
        last = max((r.doc_id for r in own if r.doc_id is not None), default=None)
        assert all(r.group_size == len(own) and r.keep_id == last for r in own)
        (stays,) = [r for r in own if r.kept]
        assert stays.doc_id == last
        digest = hashlib.sha256(text.encode()).hexdigest()
        assert {r.text_hash for r in own} <= ({digest} if hash_all or len(own) > 1 else {digest, None})


@pytest.mark.parametrize("rules", [ExactRules(), ExactRules(prefix_chars=1, slot_bits=15), ExactRules(prefix_chars=0)])
@pytest.mark.parametrize("hash_all", [False, True])
def test_matches_brute_force(documents, odd_docs, rules, hash_all):
    for docs in (documents, odd_docs):
        rows = judged(docs, rules, hash_all=hash_all)
        assert len(rows) == docs.count()
        check(rows, hash_all)


def test_only_surviving_groups_are_hashed(spark):
    texts = ["a" * 10, "b" * 10, "c" * 11, "x" * 70 + "1", "x" * 70 + "2", "y" * 71]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    hashed = {r.doc_id for r in judged(docs) if r.text_hash}
    assert hashed == {3, 4}  # same length and same first 64 characters


def test_a_third_of_all_rows_alike(spark):
    docs = spark.range(30_000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.lit("same")).otherwise(F.col("id").cast("string")).alias("text")
    )
    found = exact_duplicates(docs)
    hot = found.where("group_size > 1").agg(F.count("*"), F.min("keep_id"), F.max("group_size"), F.sum(F.col("kept").cast("int"))).first()
    assert tuple(hot) == (10_000, 29_997, 10_000, 1)
    assert found.where("kept").count() == 20_001


def test_ids_of_another_type(spark):
    docs = spark.createDataFrame([("b", "t"), ("a", "t"), (None, "t"), ("c", None), ("d", "")], "doc_id string, text string")
    assert {(r.doc_id, r.keep_id) for r in judged(docs)} == {("b", "b"), ("a", "b"), (None, "b"), ("c", "d"), ("d", "d")}


def test_odd_rows(odd_docs, no_docs, clashing_docs):
    assert exact_duplicates(no_docs).count() == 0
    assert keep_one_of_equals(no_docs).columns == no_docs.columns
    clashing = clashing_docs.withColumns({c: F.lit(7) for c in ("_id", "_text", "_size", "_alike", "keep_id", "text_hash", "_n")})
    kept = keep_one_of_equals(clashing)
    assert kept.columns == clashing.columns
    texts = [r.text or "" for r in kept.collect()]
    assert len(texts) == len(set(texts)) and set(texts) == {r.text or "" for r in odd_docs.collect()}
