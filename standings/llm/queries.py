"""The registered queries of the training-data operators, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from standings.llm import oracles
from standings.llm.collocations import PhraseRules, collocations
from standings.llm.common import Stage, let, table, words
from standings.llm.exact import exact_duplicates
from standings.llm.idfiles import IdFileRules, read_ids, write_ids
from standings.llm.imatch import IMatchRules, fingerprint, lexicon, likeness, next_ids, with_tails_replaced
from standings.llm.langid import fold, identify
from standings.llm.packing import PackingRules, pack
from standings.llm.pieces import PieceModel, decode, encode
from standings.llm.quality import judge_quality
from standings.llm.runs import word_runs
from standings.llm.secrets import KINDS, find_secrets, listed_spans
from standings.llm.simhash import near_duplicates
from standings.llm.urls import UrlRule, judge_urls
from standings.llm.warc import read_warc, write_warc

URL_RULES = [
    UrlRule("allow", "org/"),
    UrlRule("block", "example.org/es/"),
    UrlRule("block", "example.org/en/1"),
    UrlRule("allow", "com/fr/"),
    UrlRule("block", "com/de/"),
]


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learns from the folds other than 2 and predicts every document."""
    docs = table(spark, sf_dir, "documents")
    remainder = fold(F.col("doc_id")) % 4
    found = identify(docs, docs.where(remainder != 2))
    return found.select(
        F.col("_row.doc_id").alias("doc_id"),
        F.coalesce(fold(F.col("_row.doc_id")) % 4 == 2, F.lit(False)).alias("held_out"),
        "lang_pred",
        "score",
        "accepted",
    )


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack(table(spark, sf_dir, "documents"), PackingRules(tokenizer_path("word_bpe_49k.json")))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes the archives, reads them back, and describes each page from what it read."""
    stage = Stage(spark)
    path = f"{stage.path}/archives"
    write_warc(table(spark, sf_dir, "pages"), path, stage=stage)
    return read_warc(spark, path, payload=False, stage=stage).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op7_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, stage, rules = table(spark, sf_dir, "documents"), Stage(spark), IMatchRules(cover=True)
    bitmap = lexicon(docs, rules)
    order = stage.keep(next_ids(docs, stage), "order")
    own = stage.keep(
        with_tails_replaced(docs, order).select(
            "doc_id",
            F.length("text").cast("bigint").alias("n_chars"),
            F.sha2("edited", 256).alias("edited_sha256"),
            fingerprint(F.col("text"), bitmap, rules).alias("fingerprint"),
            fingerprint(F.col("edited"), bitmap, rules).alias("edited_fingerprint"),
        ),
        "prints",
    )
    first = own.groupBy(F.col("doc_id").alias("next_id")).agg(F.min("fingerprint").alias("next_print"))
    followed = order.join(first, "next_id").select(F.col("doc_id").alias("id"), "next_print")
    return own.join(followed, F.col("doc_id") == F.col("id"), "left").select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        "fingerprint",
        "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_print")).alias("near_next"),
    )


def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"), URL_RULES).drop("alias_of")


def op9_token_id_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes the id files, reads them back, and describes each document from what it read."""
    path = f"{Stage(spark).path}/ids"
    write_ids(table(spark, sf_dir, "documents"), path, IdFileRules(tokenizer_path("byte_bpe_50k.json")))
    return read_ids(spark, path).select(
        "doc_id",
        "start",
        F.expr("cast(octet_length(ids) / 4 as bigint)").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )


def op4_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(table(spark, sf_dir, "documents"))

    def number(kind: str):
        return F.size(F.filter("base", lambda x: x["kind"] == KINDS.index(kind))).cast("bigint")

    return found.select(
        "doc_id",
        *[number(kind).alias(f"n_{kind}") for kind in KINDS[:3]],
        F.sha2(listed_spans(F.col("base")), 256).alias("base_sha256"),
        listed_spans(F.col("spans")).alias("spans"),
    )


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select(
        F.col("_row.doc_id").alias("doc_id"),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encodes every document and decodes it again."""
    model = PieceModel.load(tokenizer_path("piece_bpe_32k.model"))
    return decode(encode(table(spark, sf_dir, "documents"), model), model).select(
        "doc_id",
        F.expr("cast(octet_length(ids) / 4 as bigint)").alias("n_ids"),
        F.crc32("ids").alias("ids_crc32"),
        F.length("text").cast("bigint").alias("decoded_chars"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_duplicates(table(spark, sf_dir, "documents"), hash_all=True)
    return found.select(
        F.col("_row.doc_id").alias("doc_id"),
        "keep_id",
        "group_size",
        "kept",
        F.col("text_hash").alias("text_sha256"),
    )


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"), PhraseRules())


def with_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, text): one document in ten, by the CRC of its id, repeats its words from some place on."""
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    seed = F.expr("h div 10")

    def repeated(word):
        n = F.size(word)
        first = F.pmod(seed, n).cast("int")
        period = F.lit(1) + F.floor((n - first) / (3 + seed % 8))

        def folded(bounds):
            a, p = bounds["a"], bounds["p"]
            tail = F.transform(F.sequence(a, n - 1), lambda i: F.get(word, (a + (i - a) % p).cast("int")))
            return F.concat_ws(" ", F.slice(word, 1, a), tail)

        return F.when(n > 0, let(F.struct(first.alias("a"), period.alias("p")), folded))

    chosen = F.col("h") % 10 == 0
    edited = F.when(chosen, let(words(F.col("text")), repeated)).otherwise(F.col("text"))
    return docs.withColumn("h", crc).select("doc_id", edited.alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = word_runs(with_repeats(table(spark, sf_dir, "documents")))
    longest = F.element_at(
        F.array_sort(F.transform("runs", lambda r: F.struct((-r["length"]).alias("size"), r["start"].alias("start"), r["period"].alias("period")))), 1
    )
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("best", F.when(F.size("runs") > 0, longest)).select(
        F.col("_row.doc_id").alias("doc_id"),
        F.size("runs").cast("bigint").alias("n_runs"),
        F.col("best.start").alias("start"),
        (-F.col("best.size")).alias("length"),
        F.col("best.period").alias("period"),
        F.expr("-1000 * best.size div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_packing": op2_packing,
    "op3_simhash_near_dedup": op3_simhash_near_dedup,
    "op4_secret_scans": op4_secret_scans,
    "op5_quality_rules": op5_quality_rules,
    "op6_warc": op6_warc,
    "op7_document_fingerprints": op7_document_fingerprints,
    "op8_url_filters": op8_url_filters,
    "op9_token_id_output": op9_token_id_output,
    "op10_sentencepiece": op10_sentencepiece,
    "op11_exact_dedup": op11_exact_dedup,
    "op12_collocations": op12_collocations,
    "op13_periodic_runs": op13_periodic_runs,
}

ORACLE_SQL = {
    "op6_warc": oracles.WARC,
    "op8_url_filters": oracles.url_filters([(r.verdict, r.rule) for r in URL_RULES]),
    "op11_exact_dedup": oracles.EXACT_DEDUP,
    "op12_collocations": oracles.COLLOCATIONS,
}
