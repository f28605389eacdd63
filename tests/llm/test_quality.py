import math
import re
from collections import Counter

import xxhash
from pyspark.sql import functions as F

from standings.llm.quality import QualityRules, judge_quality, keep_good, slot_weights

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {i + k for i, x in enumerate(zip(words, words[1:], words[2:])) if windows[x] > 1 for k in range(3)}
    lines, seen, dup = [x for x in text.split("\n") if WORD.search(x)], set(), 0
    for line in lines:
        dup += line in seen
        seen.add(line)
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered), failed


def slots(text, bits):
    words = [w.encode() for w in WORD.findall(text or "")]
    mask = (1 << bits) - 1
    one = [xxhash.xxh64_intdigest(w, 42) & mask for w in words]
    two = [xxhash.xxh64_intdigest(b, xxhash.xxh64_intdigest(a, 42)) & mask for a, b in zip(words, words[1:])]
    return one + two


def judged(docs, labels, rules=QualityRules()):
    return judge_quality(docs, labels, rules).select("_row.doc_id", "_row.text", "*").drop("_row")


def labels_of(spark):
    return spark.read.parquet("/root/testdata/sf0.001/labels.parquet")


def test_counts_and_verdicts_match_brute_force(spark, documents):
    rules = QualityRules(bits=12)
    labels = labels_of(spark)
    good = {r.doc_id for r in labels.collect() if r.quality == 1 and not r.toxic}
    rows = judged(documents, labels, rules).collect()
    raw, target = Counter(), Counter()
    for r in rows:
        raw.update(slots(r.text, 12))
        if r.doc_id in good:
            target.update(slots(r.text, 12))
    n_raw, n_target = sum(raw.values()), sum(target.values())

    def weight(slot):
        q = (raw[slot] + 1) / (n_raw + 4096)
        return round(1e6 * math.log((target[slot] + rules.prior * q) / (n_target + rules.prior) / q))

    for r in rows:
        assert counts(r.text) == (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
        own = slots(r.text, 12)
        score = sum(map(weight, own)) / max(len(own), 1) / 1e6
        assert abs(score - r.score) < 1e-5
        assert r.kept == (not r.base_failed and r.score >= rules.threshold)


def test_junk_goes_and_good_documents_stay(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rows = judged(docs, labels).where("not base_failed").join(labels, "doc_id").groupBy("quality", "kept").count()
    found = {(r.quality, r.kept): r["count"] for r in rows.collect()}
    assert found.get((1, False), 0) <= 0.002 * found[1, True]
    assert found.get((0, True), 0) <= 0.05 * found[0, False]


def test_odd_rows(spark, odd_docs, no_docs, clashing_docs):
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    rows = judged(odd_docs, none).collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        assert counts(r.text) == (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
        assert r.score == 0 and r.kept == (not r.base_failed)
    assert judged(no_docs, none).count() == 0
    odd_labels = spark.createDataFrame([(8, 1, 0), (8, 1, 0), (None, 1, 0), (9, None, None)], none.schema)
    kept = keep_good(clashing_docs, odd_labels)
    assert kept.columns == clashing_docs.columns
    assert {r.doc_id for r in kept.collect()} <= {8, 100, 200}


def test_every_slot_has_a_weight(spark, documents):
    weights = slot_weights(documents, labels_of(spark), QualityRules(bits=10))
    assert weights.count() == 1024 and weights.where(F.col("weight").isNull()).count() == 0
