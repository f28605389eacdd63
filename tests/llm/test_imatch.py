import hashlib
import math
import re
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from standings.llm.common import Stage
from standings.llm.imatch import IMatchRules, fingerprint, lexicon, likeness, next_ids, with_tails_replaced
from standings.llm.queries import op7_document_fingerprints


def signed(value):
    return value - (1 << 64) if value >= 1 << 63 else value


def terms(text):
    return {xxhash.xxh64_intdigest(w.encode(), 42) for w in re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())}


def plain_print(text, bitmap, rules):
    every = terms(text)
    if not every:
        return "-"
    slot = lambda t: t >> (64 - rules.slot_bits)
    kept = {t for t in every if bitmap[slot(t) >> 6] >> (slot(t) & 63) & 1} or every
    level = max((rules.subsets - 1).bit_length(), math.floor(math.log2(max(len(kept) / rules.terms_each, 1))))
    out = []
    for at in (level, level + 1):
        subsets = [[] for _ in range(rules.subsets + rules.cover)]
        for t in sorted(kept, key=signed):
            k = xxhash.xxh64_intdigest(t.to_bytes(8, "little"), 42) % (1 << at)
            if k < rules.subsets or rules.cover:
                subsets[min(k, rules.subsets)].append(t)
        hashes = []
        for own in subsets:
            h = 42
            for t in own:
                h = xxhash.xxh64_intdigest(t.to_bytes(8, "little"), h)
            hashes.append(f"{h:016x}"[-8:] if own else "")
        out.append(f"{at}:{','.join(hashes)}")
    return "|".join(out)


def plain_lexicon(rows, rules):
    frequency = Counter()
    for r in rows:
        frequency.update(terms(r.text))
    bitmap = [0] * (1 << (rules.slot_bits - 6))
    for t, n in frequency.items():
        if n >= rules.least_docs and rules.least_idf <= math.log(len(rows) / n) <= rules.most_idf:
            slot = t >> (64 - rules.slot_bits)
            bitmap[slot >> 6] |= 1 << (slot & 63)
    return bitmap, frequency


@pytest.mark.parametrize("rules", [IMatchRules(slot_bits=12, least_idf=1.0, most_idf=4.0), IMatchRules(cover=True)])
def test_lexicon_and_prints_match_brute_force(spark, documents, rules):
    """Also with the rules of the query."""
    rows = documents.collect()
    bitmap, _ = plain_lexicon(rows, rules)
    found = lexicon(documents, rules)
    assert [x & ((1 << 64) - 1) for x in found] == bitmap and any(bitmap)
    prints = documents.select("text", fingerprint(F.col("text"), found, rules).alias("p")).collect()
    for r in prints:
        assert r.p == plain_print(r.text, bitmap, rules)


def test_both_edges_of_the_band_act(spark):
    """Under the query's rules common words go and so do nearly all terms of one document only."""
    rules = IMatchRules(cover=True)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = docs.select("text").collect()
    bitmap, frequency = plain_lexicon(rows, rules)
    assert [x & ((1 << 64) - 1) for x in lexicon(docs, rules)] == bitmap

    def share(own):
        slots = [t >> (64 - rules.slot_bits) for t in own]
        return sum(bitmap[x >> 6] >> (x & 63) & 1 for x in slots) / len(slots)

    assert share([t for t, n in frequency.items() if n == 1]) < 0.02
    assert share([t for t, n in frequency.items() if n > len(rows) / 7]) < 0.02
    assert share([t for t, n in frequency.items() if 2 <= n < len(rows) / 8]) == 1


def test_near_and_far(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rules, stage = IMatchRules(), Stage(spark)
    bitmap = lexicon(docs, rules)
    order = next_ids(docs, stage)
    own = with_tails_replaced(docs, order).select(
        "doc_id", F.length("text").alias("n"), fingerprint(F.col("text"), bitmap, rules).alias("a"),
        fingerprint(F.col("edited"), bitmap, rules).alias("b"),
    )
    own = stage.keep(own, "prints")
    other = own.select(F.col("doc_id").alias("next_id"), F.col("a").alias("c"))
    row = (
        own.join(order, "doc_id")
        .join(other, "next_id")
        .where("n > 300")
        .agg(F.avg(likeness(F.col("a"), F.col("b"))).alias("near"), F.avg(likeness(F.col("a"), F.col("c"))).alias("far"))
        .first()
    )
    assert row.near > 0.3 and row.far < 0.02


def test_edits_match_brute_force(spark, odd_docs):
    docs = odd_docs.select("doc_id", "text").distinct()
    docs = docs.where("doc_id is null or doc_id not in (8)").unionByName(
        spark.createDataFrame([(8, "eight documents"), (-5, "minus five é"), (10**12, "z" * 7)], "doc_id bigint, text string")
    )
    rows = sorted(((r.doc_id, r.text or "") for r in docs.collect() if r.doc_id is not None))
    found = {r.doc_id: r for r in with_tails_replaced(docs, next_ids(docs, Stage(spark))).collect() if r.doc_id is not None}
    assert len(found) == len(rows)
    for (doc_id, text), (_, follower) in zip(rows, rows[1:] + rows[:1]):
        n = len(text) // 4
        assert found[doc_id].edited == text[: len(text) - n] + follower[:n]


def test_odd_rows(spark, odd_docs, no_docs):
    rules = IMatchRules(slot_bits=10)
    bitmap = lexicon(odd_docs, rules)
    rows = odd_docs.select("text", fingerprint(F.col("text"), bitmap, rules).alias("p")).collect()
    by_text = {}
    for r in rows:
        by_text.setdefault(r.text, set()).add(r.p)
        assert (r.p == "-") == (not terms(r.text))
    assert all(len(p) == 1 for p in by_text.values())
    edited = with_tails_replaced(odd_docs, next_ids(odd_docs, Stage(spark)))
    assert edited.count() == odd_docs.count()
    assert hashlib.sha256(b"").hexdigest() in {r[0] for r in edited.select(F.sha2("edited", 256)).collect()}
    assert lexicon(no_docs, rules) == [0] * 16
    assert with_tails_replaced(no_docs, next_ids(no_docs, Stage(spark))).count() == 0
    pairs = spark.createDataFrame([("-", "-"), ("-", "4:a"), ("4:a,,b|5:c,,", "4:a,,c|6:x,,"), ("4:,,", "4:,,b")], "a string, b string")
    assert [r[0] for r in pairs.select(likeness(F.col("a"), F.col("b"))).collect()] == [1.0, 0.0, 0.5, 0.0]


def test_every_term_of_the_band_is_in_the_fingerprint(spark, tmp_path):
    """Texts of 300 terms that differ in one or two of them are alike, but not the same."""
    rows = [(i, " ".join(f"x{w}" if w == 5 * i else f"w{w}" for w in range(300))) for i in range(60)]
    # Enough other documents for the common terms to be in the band.
    rows += [(i, "") for i in range(1000, 1600)]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = op7_document_fingerprints(spark, str(tmp_path)).where("doc_id < 59").select("near_next", "fingerprint").collect()
    assert len({r.fingerprint for r in found}) == 59
    assert all(0.5 < r.near_next < 1 for r in found)
