"""I-Match fingerprints: hashes of the terms in an inverse-document-frequency band.

A term's document frequency is counted over all documents, by its 64-bit hash. The lexicon is the
band of terms whose idf is neither that of words everyone uses nor that of a chance string. It is
kept as a bitmap of fixed size, whatever the vocabulary: a bit is set where a term of the band
falls. A document's terms in the lexicon, distinct and sorted, are dealt to random subsets of the lexicon, and each subset's terms
are hashed. A subset keeps its hash until an edit touches one of its few terms.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from standings.llm.common import Stage, let, listed, whole, words


@dataclass(frozen=True)
class IMatchRules:
    """A bitmap of ``2 ** slot_bits``, the band in nats, and how terms meet subsets.

    A term of the band is in ``least_docs`` documents at least, which is the upper edge while
    ``most_idf`` asks for less. A term outside the band that shares its bit with one inside counts
    as inside.

    The lexicon is cut into ``2 ** level`` random subsets and the first ``subsets`` are hashed.
    The level follows the number of terms, so that a subset holds about ``terms_each`` of them.
    With ``cover`` the terms of all other subsets are hashed together as one more.
    """

    slot_bits: int = 22
    least_idf: float = 2.0
    most_idf: float = 12.0
    least_docs: int = 2
    subsets: int = 16
    terms_each: int = 2
    cover: bool = False


def term_hashes(text: Column) -> Column:
    """The distinct hashes of a text's words in lower case."""
    return F.array_distinct(F.transform(words(F.lower(whole(text))), lambda w: F.xxhash64(w)))


def slot_of(term: Column, rules: IMatchRules) -> Column:
    return F.shiftrightunsigned(term, 64 - rules.slot_bits)


def lexicon(texts: DataFrame, rules: IMatchRules) -> list[int]:
    """The band as a bitmap of ``2 ** slot_bits`` bits in 64-bit words: fixed in size.

    Frequencies cover all texts, each text's terms once; a task shuffles one row for each of its
    different terms at most. Repeated rows count as often as they occur; without texts no bit is set.
    """
    n = F.lit(texts.count()).cast("double")
    counts = texts.select(F.explode(term_hashes(F.col("text"))).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("docs"))
    band = counts.where((F.col("docs") >= rules.least_docs) & F.ln(n / F.col("docs")).between(rules.least_idf, rules.most_idf))
    slots = band.select(slot_of(F.col("term"), rules).alias("slot"))
    packed = slots.groupBy(F.shiftright("slot", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(slot & 63 as int))")).alias("bits")
    )
    words_ = dict(packed.collect())
    return [words_.get(i, 0) for i in range(1 << (rules.slot_bits - 6))]


def fingerprint(text: Column, bitmap: list[int], rules: IMatchRules) -> Column:
    """``level:hash,hash,...`` for the level that fits the terms and for the next finer one.

    A subset without terms has an empty hash. With ``rules.cover`` the last hash of a level is that
    of the terms in none of the others, so every term chosen is in the fingerprint. A text without terms in the band uses all its
    terms; a text without words, null or empty, has the fingerprint ``-``. Equal texts have equal
    fingerprints, in repeated rows too.
    """
    table = listed(bitmap)

    def inside(t: Column) -> Column:
        slot = slot_of(t, rules)
        word = F.get(table, F.shiftright(slot, 6).cast("int"))
        return F.getbit(word, slot.bitwiseAND(F.lit(63).cast("bigint")).cast("int")) == 1

    def chosen(terms: Column) -> Column:
        return let(F.filter(terms, inside), lambda kept: F.when(F.size(kept) > 0, kept).otherwise(terms))

    def hashed(own: Column) -> Column:
        short = F.lower(F.right(F.hex(F.xxhash64(own)), F.lit(8)))
        return F.when(F.size(own) == 0, F.lit("")).otherwise(short)

    def at_level(terms: Column, level: Column) -> Column:
        # Other bits of the hash than those of the slot deal a term to its subset.
        dealt = F.filter(
            F.transform(
                terms,
                lambda t: F.struct(subset_of(t, level).alias("subset"), t.alias("t")),
            ),
            lambda x: x["subset"] < rules.subsets,
        )
        hashes = let(
            F.sort_array(dealt),
            lambda d: F.transform(
                F.sequence(F.lit(0), F.lit(rules.subsets - 1)),
                lambda i: let(
                    F.filter(d, lambda x: x["subset"] == i),
                    lambda own: hashed(F.transform(own, lambda x: x["t"])),
                ),
            ),
        )
        if rules.cover:
            rest = F.sort_array(F.filter(terms, lambda t: subset_of(t, level) >= rules.subsets))
            hashes = F.concat(hashes, F.array(let(rest, hashed)))
        return F.concat(level.cast("string"), F.lit(":"), F.array_join(hashes, ","))

    def subset_of(t: Column, level: Column) -> Column:
        return F.pmod(F.xxhash64(t), F.call_function("shiftleft", F.lit(1).cast("bigint"), level))

    least = (rules.subsets - 1).bit_length()

    def whole_print(terms: Column) -> Column:
        share = F.size(terms) / F.lit(float(rules.terms_each))
        fitting = F.greatest(F.lit(least), F.floor(F.log2(F.greatest(share, F.lit(1.0)))).cast("int"))
        return let(
            fitting, lambda level: F.concat_ws("|", at_level(terms, level), at_level(terms, level + 1))
        )

    return let(
        term_hashes(text),
        lambda terms: F.when(F.size(terms) == 0, F.lit("-")).otherwise(let(chosen(terms), whole_print)),
    )


def likeness(a: Column, b: Column) -> Column:
    """The largest share, over the levels that both have, of equal among their non-empty subsets."""

    def of_level(x: Column, y: Column) -> Column:
        left, right = F.split(F.split_part(x, F.lit(":"), F.lit(2)), ","), F.split(F.split_part(y, F.lit(":"), F.lit(2)), ",")
        pairs = F.zip_with(left, right, lambda p, q: F.struct(p.alias("p"), q.alias("q")))
        filled = let(pairs, lambda z: F.filter(z, lambda e: (e["p"] != "") | (e["q"] != "")))
        return let(
            filled,
            lambda z: F.when(F.size(z) == 0, F.lit(0.0)).otherwise(
                F.size(F.filter(z, lambda e: e["p"] == e["q"])) / F.size(z)
            ),
        )

    def best(levels: Column) -> Column:
        own = F.split(b, r"\|")
        met = F.transform(
            levels,
            lambda x: F.coalesce(
                F.array_max(
                    F.transform(
                        F.filter(own, lambda y: F.split_part(y, F.lit(":"), F.lit(1)) == F.split_part(x, F.lit(":"), F.lit(1))),
                        lambda y: of_level(x, y),
                    )
                ),
                F.lit(0.0),
            ),
        )
        return F.array_max(met)

    return F.when(a == b, F.lit(1.0)).otherwise(F.coalesce(best(F.split(a, r"\|")), F.lit(0.0)))


def next_ids(docs: DataFrame, stage: Stage) -> DataFrame:
    """(doc_id, next_id, chars): the next greater id, after the last the first, and the longest text.

    Ids are cut into ranges and ordered within each; the first id of the next range follows the
    last of a range. Null ids have no place in the order.
    """
    sized = docs.where("doc_id is not null").groupBy("doc_id").agg(F.max(F.length(whole(F.col("text")))).alias("chars"))
    ranged = stage.keep(sized.repartitionByRange("doc_id").withColumn("part", F.spark_partition_id()), "id-ranges")
    # One row for each range.
    heads = ranged.groupBy("part").agg(F.min("doc_id").alias("head"))
    order = Window.orderBy("part")
    after = heads.select(
        "part", F.coalesce(F.lead("head").over(order), F.first("head").over(order)).alias("next_head")
    )
    inside = F.lead("doc_id").over(Window.partitionBy("part").orderBy("doc_id"))
    return (
        ranged.withColumn("inside", inside)
        .join(F.broadcast(after), "part")
        .select("doc_id", F.coalesce("inside", "next_head").alias("next_id"), "chars")
    )


def with_tails_replaced(docs: DataFrame, order: DataFrame) -> DataFrame:
    """(doc_id, text, edited): the last quarter of each text replaced by the next document's beginning.

    Texts are dealt out by id once, for both joins; only beginnings as long as they are needed are
    sent to the document before. Of rows that repeat an id the smallest beginning is used; a row
    without an id gets nothing in return.
    """
    texts = docs.where("doc_id is not null").select("doc_id", "text").repartition("doc_id")
    wanted = order.select(F.col("next_id").alias("doc_id"), F.col("doc_id").alias("for_id"), "chars")
    heads = (
        texts.join(wanted, "doc_id")
        .select("for_id", F.substring(whole(F.col("text")), F.lit(1), F.floor(F.col("chars") / 4).cast("int")).alias("head"))
        .groupBy("for_id")
        .agg(F.min("head").alias("head"))
    )
    text, head = whole(F.col("text")), whole(F.col("head"))
    quarter = F.floor(F.length(text) / 4).cast("int")
    kept = F.substring(text, F.lit(1), F.length(text) - quarter)
    without = docs.where("doc_id is null").select("doc_id", "text", F.lit(None).cast("string").alias("head"))
    followed = texts.join(heads, F.col("doc_id") == F.col("for_id"), "left").select("doc_id", "text", "head")
    return followed.unionByName(without).select(
        "doc_id", text.alias("text"), F.concat(kept, F.substring(head, F.lit(1), quarter)).alias("edited")
    )
