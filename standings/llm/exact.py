"""Exact duplicates by progressive refinement: length, then prefix hash, then full hash.

Each level reads more of a text, and only of texts whose group at the level before has another
member. What survives a level is told to the next scan by a bit set of fixed size over hashed
groups, broadcast to the tasks: a text is never shuffled to learn whether it survives. Groups that
share a bit are let through together, which costs a hash and changes no result, since the last
level groups by the SHA-256 of the whole text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from standings.llm.common import Stage, unpacked, whole

# Layout of a bit set: 64 bits a word, 512 words a row.
WORD_BITS, ROW_WORDS = 6, 9


@dataclass(frozen=True)
class ExactRules:
    """``prefix_chars`` are hashed at the second level; a bit set has ``2 ** slot_bits`` bits.

    24 bits give 2 MB, whatever the input. When most bits are set the levels sort out less, and more
    whole texts are hashed.
    """

    prefix_chars: int = 64
    slot_bits: int = 24


def exact_duplicates(
    docs: DataFrame,
    rules: ExactRules = ExactRules(),
    stage: Stage | None = None,
    text: str = "text",
    doc_id: str = "doc_id",
    carry_text: bool = False,
    hash_all: bool = False,
) -> DataFrame:
    """One row per row of ``docs``: ``_row``, ``keep_id``, ``group_size``, ``kept``, ``text_hash``.

    Texts are equal when they are identical, a null text being empty. Of equal texts the row with the
    largest id stays; null is the smallest id, and of rows that repeat the id as well exactly one
    stays. ``keep_id`` is the id of the row that stays. ``text_hash`` is the SHA-256 of the text where the
    last level needed it, of every text with ``hash_all``, else null. ``_row`` holds all columns, the text
    only with ``carry_text``. An empty table gives an empty result; texts of any length are
    compared whole. A group of any size is added up map-side and joined back as a plain join, whose
    large side Spark splits.
    """
    stage = stage or Stage(docs.sparkSession)
    body = whole(F.col(f"`{text}`"))
    size = F.octet_length(body)
    prefix = F.xxhash64(F.substring(body, 1, rules.prefix_chars))
    carried = [F.col(f"`{c}`") for c in docs.columns if carry_text or c != text]
    texts = docs.select(
        F.struct(*carried).alias("_row"),
        F.col(f"`{doc_id}`").alias("_id"),
        body.alias("_text"),
        size.alias("_size"),
        prefix.alias("_prefix"),
    )
    levels, alike = [["_size"], ["_size", "_prefix"]], None
    for number, keys in enumerate(levels):
        groups = _marked(texts, alike, levels[number - 1], rules).where("_alike").groupBy(*keys).count()
        alike = stage.keep(_bit_set(groups.where("count > 1").select(_slot(keys, rules)), rules), f"level-{number}")
    digest = F.sha2("_text", 256)
    rows = stage.keep(
        _marked(texts, alike, levels[-1], rules).select(
            "_row",
            "_id",
            F.monotonically_increasing_id().alias("_rid"),
            "_alike",
            (digest if hash_all else F.when(F.col("_alike"), digest)).alias("text_hash"),
        ),
        "rows",
    )
    # A table of its own, so that both sides of the join are plain exchanges and a hot group can be split.
    groups = stage.keep(
        rows.where("_alike")
        .groupBy(F.col("text_hash").alias("_hash"))
        .agg(F.count(F.lit(1)).alias("_n"), F.max(F.struct("_id", "_rid")).alias("_last"))
        .where("_n > 1"),
        "groups",
    )
    grouped = (
        rows.where("_alike")
        .join(groups, F.col("text_hash") == F.col("_hash"), "left")
        .select(
            "_row",
            F.when(F.col("_n").isNull(), F.col("_id")).otherwise(F.col("_last._id")).alias("keep_id"),
            F.coalesce("_n", F.lit(1)).alias("group_size"),
            F.coalesce(F.col("_rid") == F.col("_last._rid"), F.lit(True)).alias("kept"),
            "text_hash",
        )
    )
    alone = rows.where("not _alike").select(
        "_row",
        F.col("_id").alias("keep_id"),
        F.lit(1).cast("bigint").alias("group_size"),
        F.lit(True).alias("kept"),
        "text_hash",
    )
    return grouped.unionByName(alone)


def keep_one_of_equals(docs: DataFrame, rules: ExactRules = ExactRules(), stage: Stage | None = None) -> DataFrame:
    """``docs`` with one row for each different text, that with the largest id; same columns."""
    return unpacked(exact_duplicates(docs, rules, stage, carry_text=True).where("kept"))


def _slot(keys: list[str], rules: ExactRules) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(1 << rules.slot_bits)).alias("_slot")


def _bit_set(slots: DataFrame, rules: ExactRules) -> DataFrame:
    """(_bucket, _words) with the bits of ``slots`` set: every row of the set, so its size is fixed."""
    spark, word = slots.sparkSession, F.shiftright("_slot", WORD_BITS).alias("_word")
    bits = slots.select(word, F.expr("shiftleft(1L, cast(_slot & 63 as int))").alias("_bits"))
    none = spark.range(1 << (rules.slot_bits - WORD_BITS)).select(F.col("id").alias("_word"), F.lit(0).cast("bigint").alias("_bits"))
    words = bits.unionByName(none).groupBy("_word").agg(F.bit_or("_bits").alias("_bits"))
    listed = F.array_sort(F.collect_list(F.struct("_word", "_bits")))
    return words.groupBy(F.shiftright("_word", ROW_WORDS).alias("_bucket")).agg(
        F.transform(listed, lambda x: x["_bits"]).alias("_words")
    )


def _marked(texts: DataFrame, alike: DataFrame | None, keys: list[str], rules: ExactRules) -> DataFrame:
    """``texts`` with ``_alike``: whether the bit of a text's group is set; all are without a bit set."""
    if alike is None:
        return texts.withColumn("_alike", F.lit(True))
    bit = f"bit_get(_words[cast(shiftright(_slot, {WORD_BITS}) & {(1 << ROW_WORDS) - 1} as int)], cast(_slot & 63 as int)) = 1"
    return (
        texts.withColumn("_slot", _slot(keys, rules))
        .join(F.broadcast(alike), F.shiftright("_slot", WORD_BITS + ROW_WORDS) == F.col("_bucket"), "left")
        .withColumn("_alike", F.coalesce(F.expr(bit), F.lit(False)))
        .drop("_slot", "_bucket", "_words")
    )
