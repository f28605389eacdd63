"""Quality rules: counted base rules, then hashed n-gram likelihood ratios.

Every word and every pair of neighbouring words is hashed into one of ``2 ** bits`` slots. Two
multinomials over the slots are counted, one over a trusted sample and one over the whole raw
corpus; a document's score is the mean log ratio of the two over its n-grams. Weights are whole
millionths, so a score does not depend on the order of addition, and one fixed threshold decides
on every document.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from standings.llm.common import let, listed, packed, unpacked, whole, words

MICRO = 1_000_000


@dataclass(frozen=True)
class QualityRules:
    """Parameters. ``trusted_rows`` bounds the labelled sample that the target model is fitted on.

    ``prior`` n-grams distributed like the raw corpus are added to the target, so that few
    trusted documents give mild ratios and not wild ones.
    """

    bits: int = 16
    trusted_rows: int = 20_000
    prior: int = 655_360
    threshold: float = -0.08
    min_words: int = 50
    max_repeat_percent: int = 50


def n_gram_slots(word_list: Column, bits: int) -> Column:
    """The slots of all words, then of all pairs of neighbouring words."""
    mask = F.lit((1 << bits) - 1).cast("bigint")
    return let(
        word_list,
        lambda w: F.concat(
            F.transform(w, lambda x: F.xxhash64(x).bitwiseAND(mask).cast("int")),
            F.zip_with(
                F.slice(w, 1, F.greatest(F.size(w) - 1, F.lit(0))),
                F.slice(w, 2, F.greatest(F.size(w) - 1, F.lit(0))),
                lambda x, y: F.xxhash64(x, y).bitwiseAND(mask).cast("int"),
            ),
        ),
    )


def repeated_window_words(word_list: Column, width: int = 3) -> Column:
    """Words in windows of ``width`` words that occur twice or more in the text, each word once.

    Without two equal hashes there are no two equal windows; only texts that have some compare
    the windows themselves.
    """

    def of(w: Column) -> Column:
        def windows(make):
            return F.transform(
                F.sequence(F.lit(0), F.size(w) - width), lambda i: make([F.get(w, i + k) for k in range(width)], i)
            )

        hashes = windows(lambda ws, i: F.xxhash64(*ws))
        texts = windows(lambda ws, i: F.struct(F.concat_ws(" ", *ws).alias("w"), i.alias("i")))
        some = let(hashes, lambda h: F.size(F.array_distinct(h)) < F.size(h))
        none = F.lit(0).cast("bigint")
        return F.when(F.size(w) < width + 1, none).otherwise(
            F.when(some, let(F.sort_array(texts), covered)).otherwise(none)
        )

    def covered(sorted_windows: Column) -> Column:
        same = lambda j, e: F.coalesce(F.get(sorted_windows, j)["w"] == e["w"], F.lit(False))
        starts = F.transform(
            F.filter(sorted_windows, lambda e, j: same(j - 1, e) | same(j + 1, e)), lambda e: e["i"]
        )
        none = F.struct(F.lit(-width).alias("last"), F.lit(0).cast("bigint").alias("n"))
        return F.aggregate(
            F.sort_array(starts),
            none,
            lambda a, x: F.struct(
                x.alias("last"), (a["n"] + F.least(F.lit(width), x - a["last"])).alias("n")
            ),
        )["n"]

    return let(word_list, of)


def base_counts(text: Column, w: Column) -> dict[str, Column]:
    """The counts of the base rules; ``w`` is a column that holds the words of ``text``."""
    zero = F.lit(0).cast("bigint")
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return {
        "n_words": F.size(w).cast("bigint"),
        "word_chars": F.aggregate(w, zero, lambda n, x: n + F.length(x)),
        "n_symbols": F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("bigint"),
        "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint"),
        "n_repeat_words": repeated_window_words(w),
    }


def trusted_sample(labels: DataFrame, rules: QualityRules) -> DataFrame:
    """At most ``trusted_rows`` documents labelled good and not toxic, by the hash of their id."""
    good = labels.where("quality = 1 and coalesce(toxic, 0) = 0 and doc_id is not null")
    return (
        good.select(F.col("doc_id").alias("_trusted"))
        .distinct()
        .orderBy(F.xxhash64("_trusted"), "_trusted")
        .limit(rules.trusted_rows)
    )


def slot_weights(docs: DataFrame, labels: DataFrame, rules: QualityRules) -> DataFrame:
    """(slot, weight): log ratio of target over raw probability in millionths, for every slot.

    Raw counts are those of all documents; both counts are added up map-side, at most one row
    for each slot and task is shuffled.
    """
    sample = F.broadcast(trusted_sample(labels, rules))
    counts = (
        docs.select("doc_id", "text")
        .join(sample, F.col("doc_id") == F.col("_trusted"), "left")
        .select(F.col("_trusted").isNotNull().cast("bigint").alias("t"), words(F.col("text")).alias("w"))
        .select("t", F.explode(n_gram_slots(F.col("w"), rules.bits)).alias("slot"))
        .groupBy("slot")
        .agg(F.count(F.lit(1)).alias("raw"), F.sum("t").alias("target"))
    )
    slots = 1 << rules.bits
    dense = (
        docs.sparkSession.range(0, slots, 1, 1)
        .select(F.col("id").cast("int").alias("slot"))
        .join(counts, "slot", "left")
        .select("slot", F.coalesce("raw", F.lit(0)).alias("raw"), F.coalesce("target", F.lit(0)).alias("target"))
    )
    total = counts.agg(
        F.coalesce(F.sum("raw"), F.lit(0)).alias("all_raw"), F.coalesce(F.sum("target"), F.lit(0)).alias("all_target")
    )
    raw_share = (F.col("raw") + 1) / (F.col("all_raw") + slots)
    target_share = (F.col("target") + rules.prior * raw_share) / (F.col("all_target") + rules.prior)
    return dense.join(F.broadcast(total), F.lit(True)).select(
        "slot", F.round(MICRO * F.ln(target_share / raw_share)).cast("bigint").alias("weight")
    )


def judge_quality(
    docs: DataFrame, labels: DataFrame, rules: QualityRules = QualityRules()
) -> DataFrame:
    """Every row of ``docs`` as ``_row`` with its counts, ``base_failed``, ``score`` and ``kept``.

    ``base_failed``: fewer than ``min_words`` words, or over ``max_repeat_percent`` % of them in
    repeated windows. ``kept``: not failed and a score of at least ``threshold``. Null and empty
    texts have no words and fail; without labels all weights are 0 and the base rules decide;
    repeated rows and ids are judged row by row; other columns pass unread. The ``2 ** bits``
    weights are the one thing that passes the driver.
    """
    weights = listed([w for _, w in sorted(slot_weights(docs, labels, rules).collect())])
    # A generated column is computed once: a filter on the verdict cannot pull the words into itself.
    rows = packed(docs, text=whole(F.col("text"))).select("_row", "text", F.explode(F.array(words(F.col("text")))).alias("w"))
    summed = F.aggregate(
        n_gram_slots(F.col("w"), rules.bits),
        F.lit(0).cast("bigint"),
        lambda n, slot: n + F.coalesce(F.get(weights, slot), F.lit(0)),
    )
    counted = rows.select("_row", *[c.alias(n) for n, c in base_counts(F.col("text"), F.col("w")).items()], summed.alias("_sum"))
    n_grams = F.greatest(2 * F.col("n_words") - 1, F.lit(1))
    failed = (F.col("n_words") < rules.min_words) | (
        100 * F.col("n_repeat_words") > rules.max_repeat_percent * F.col("n_words")
    )
    score = F.col("_sum") / n_grams / MICRO
    return (
        counted.withColumn("base_failed", failed)
        .withColumn("score", score)
        .withColumn("kept", ~F.col("base_failed") & (F.col("score") >= rules.threshold))
        .drop("_sum")
    )


def keep_good(docs: DataFrame, labels: DataFrame, rules: QualityRules = QualityRules()) -> DataFrame:
    """The rows of ``docs`` that `judge_quality` keeps, unchanged."""
    return unpacked(judge_quality(docs, labels, rules).where("kept"))
