r"""WARC archives: writing, and reading with boundary-chain verification.

A record is its header, a blank line, the payload and two line breaks. Archives are written as
text whose lines end in ``\r\n``, a record to a row, so they are valid WARC files in any file system
that Spark writes to. They are read back cut at the magic that begins a record. A payload may hold
the magic too, so every cut is only a candidate: from its header follows the offset of its successor,
and only the records that the chain from the start of the file reaches are real.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from standings.llm.common import Stage, let, whole

MAGIC = "WARC/1.1\r\n"
# Fixed by the format: the profile of a record whose payload an earlier record holds.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# RFC 4648 base32, and the digits that `conv` uses for the same values.
BASE32, CONV32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "0123456789ABCDEFGHIJKLMNOPQRSTUV"


@dataclass(frozen=True)
class WarcRules:
    """Payloads of ``dedup_bytes`` or more are written once; an archive holds ``archive_records`` at most."""

    dedup_bytes: int = 0
    archive_records: int = 20_000


def sha1_base32(payload: Column) -> Column:
    """The upper-case base32 SHA-1: 40 bits, ten hex digits, are eight base32 digits."""

    def eight(digest: Column, at: int) -> Column:
        digits = F.conv(F.substring(digest, at, 10), 16, 32)
        return F.translate(F.lpad(digits, 8, "0"), CONV32, BASE32)

    return let(F.sha1(payload), lambda d: F.concat(*[eight(d, at) for at in (1, 11, 21, 31)]))


def with_originals(pages: DataFrame, rules: WarcRules, stage: Stage) -> DataFrame:
    """(page_id, url, payload, bytes, digest, refers_to): the smallest page id with the same payload.

    Only digests are shuffled to find the originals; ``refers_to`` is null for an original itself,
    for a payload under ``dedup_bytes`` and where no page of the payload has an id. A page without
    id refers to the smallest id.
    """
    rows = (
        pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), whole(F.col("html")).alias("payload"))
        .withColumn("digest", sha1_base32(F.col("payload").cast("binary")))
        .withColumn("bytes", F.octet_length("payload").cast("bigint"))
    )
    first = stage.keep(
        rows.where(F.col("bytes") >= rules.dedup_bytes)
        .groupBy("digest", "bytes")
        .agg(F.min("page_id").alias("first"), F.max("page_id").alias("last"), F.count_if(F.col("page_id").isNull()).alias("without"))
        .where("first < last or first is not null and without > 0")
        .select(F.col("digest").alias("d"), F.col("bytes").alias("b"), "first"),
        "originals",
    )
    same = (F.col("digest") == F.col("d")) & (F.col("bytes") == F.col("b"))
    original = F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    return rows.join(first, same, "left").select("page_id", "url", "payload", "bytes", "digest", original.alias("refers_to"))


def record(row_type: Column) -> Column:
    """One record without its last line break, which the writer's line end supplies."""

    def header(name: str, value: Column) -> Column:
        line = F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit("\r\n"))
        return F.coalesce(line, F.lit(""))

    body = F.when(row_type == "response", F.col("payload")).otherwise("")
    address = F.regexp_replace(F.col("url"), r"[\r\n]", "%20")
    now = F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return F.concat(
        F.lit(MAGIC),
        header("WARC-Type", row_type),
        header("WARC-Record-ID", F.concat(F.lit("<urn:page:"), F.col("page_id"), F.lit(">"))),
        header("WARC-Date", now),
        header("WARC-Target-URI", address),
        header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        header("WARC-Payload-Length", F.col("bytes")),
        header("WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.col("refers_to"), F.lit(">"))),
        header("WARC-Profile", F.when(row_type == "revisit", F.lit(REVISIT_PROFILE))),
        header("Content-Length", F.octet_length(body)),
        F.lit("\r\n"),
        body,
        F.lit("\r\n"),
    )


def write_warc(pages: DataFrame, path: str, rules: WarcRules = WarcRules(), stage: Stage | None = None) -> None:
    """A record per row of ``pages`` (page_id, url, html), null html as an empty payload.

    Of equal payloads the smallest page id is a response and the others revisit it. Rows that
    repeat that id are responses too, with the same record id; a page without id has no record id. The
    date is that of the writing. An archive is a file of the folder; no pages give no records.
    """
    rows = with_originals(pages, rules, stage or Stage(pages.sparkSession))
    kind = F.when(F.col("refers_to").isNotNull(), "revisit").otherwise("response")
    writer = rows.select(record(kind)).write.mode("overwrite")
    writer.option("lineSep", "\r\n").option("maxRecordsPerFile", rules.archive_records).text(path)


def field(head: Column, name: str) -> Column:
    found = F.regexp_extract(head, rf"(?m)^{name}: ([^\r\n]*)", 1)
    return F.when(found != "", found)


def described(text: Column) -> dict[str, Column]:
    """What a record's text after the magic says of itself, and the digest of its payload."""
    head = F.substring_index(text, "\r\n\r\n", 1)
    content = field(head, "Content-Length").cast("bigint")
    body = F.substring(text.cast("binary"), (F.octet_length(head) + 5), content.cast("int"))
    page = lambda name: F.regexp_extract(head, rf"(?m)^{name}: <urn:page:(-?[0-9]+)>", 1)
    number = lambda name: F.when(page(name) != "", page(name)).cast("bigint")
    kind = field(head, "WARC-Type")
    return {
        "page_id": number("WARC-Record-ID"),
        "record_type": kind,
        "refers_to": number("WARC-Refers-To"),
        "payload_bytes": F.when(kind == "response", content).otherwise(
            field(head, "WARC-Payload-Length").cast("bigint")
        ),
        "payload_digest": F.when(kind == "response", sha1_base32(body)).otherwise(
            F.regexp_replace(field(head, "WARC-Payload-Digest"), "^sha1:", "")
        ),
        "payload": F.when(kind == "response", body.cast("string")),
    }


def _pointers(frame: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a block's candidates in order: offset, successor, the successor's place (their own place if it is
    not in the block), and whether it is in the block or beyond it."""
    at, length = frame["at"].to_numpy(), frame["length"].to_numpy()
    successor = at + length
    place = np.searchsorted(at, successor)
    inside = (length > 0) & (np.append(at, -1)[place] == successor)
    beyond = (length > 0) & (successor > at[-1])
    return at, successor, np.where(inside, place, np.arange(len(at))), inside, beyond


def _exits(frame: pd.DataFrame) -> pd.DataFrame:
    """A block's candidates with their offsets and where the chain from each leaves the block, -1 if it breaks."""
    frame = frame.sort_values("row")
    frame["at"] = frame["start"] + frame["size"].cumsum() - frame["size"]
    # What stands before the first magic of a file is no record.
    frame["length"] = frame["length"].where(frame["at"] >= 0, 0)
    _, successor, jump, _, beyond = _pointers(frame)
    while (jump[jump] != jump).any():
        jump = jump[jump]
    frame["exit"] = np.where(beyond[jump], successor[jump], -1)
    return frame[["file", "block", "row", "at", "size", "length", "exit"]]


def _owners(frame: pd.DataFrame) -> pd.DataFrame:
    """For every part of a block the bounds of the last real record that begins in the block up to there, -1 if none does.

    The chain enters a block at one place at most; pointer jumping from there reaches the real records.
    """
    frame = frame.sort_values("row")
    at, successor, jump, inside, beyond = _pointers(frame)
    reached = at == frame["entry"].fillna(-1).iloc[0]
    while True:
        new = np.zeros_like(reached)
        new[jump[reached]] = True
        if not (new & ~reached).any():
            break
        reached |= new
        jump = jump[jump]
    real = reached & (inside | beyond & (frame["sound"] == True).to_numpy())  # noqa: E712
    last = np.maximum.accumulate(np.where(real, np.arange(len(at)), -1))
    frame["start"], frame["end"] = np.where(last >= 0, at[last], -1), np.where(last >= 0, successor[last], -1)
    return frame[["file", "block", "row", "at", "size", "start", "end"]]


def follow_chains(parts: DataFrame, stage: Stage, name: str) -> DataFrame:
    """(file, offset, row, part, split): the parts that make up real records, of ``parts`` (file, block,
    file_size, row, bytes, length).

    ``row`` orders the parts of a block, ``length`` is the record's length that a part's header gives, 0
    without one. Tasks work on a block each: they give every candidate the offset at which its chain
    leaves the block. Only these few offsets take part in the pointer jumping between blocks, whose
    rounds are joins on (file, offset) and grow with the logarithm of a file's blocks. ``offset`` is
    the record's, ``part`` the part's; ``split`` says that the record has more parts than one.
    """
    size = F.col("bytes") + len(MAGIC)
    light = parts.select("file", "block", "file_size", "row", size.alias("size"), "length")
    of_file = Window.partitionBy("file")
    before = of_file.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    held = light.groupBy("file", "block").agg(F.sum("size").alias("held"), F.max("file_size").alias("file_size"))
    # A file that ends with the magic has no part after it.
    missing = F.col("file_size") - (F.sum("held").over(of_file) - len(MAGIC))
    start = F.coalesce(F.sum("held").over(before), F.lit(0)) - len(MAGIC)
    refused = F.raise_error(F.concat(F.lit("parts do not make up the file "), F.col("file"))).cast("bigint")
    blocks = stage.keep(
        held.select("file", "block", "file_size", F.when(missing.isin(0, len(MAGIC)), start).otherwise(refused).alias("start")),
        f"{name}-blocks",
    )
    found = light.drop("file_size").join(blocks.drop("file_size"), ["file", "block"]).groupBy("file", "block")
    found = stage.keep(
        found.applyInPandas(_exits, "file string, block bigint, row bigint, at bigint, size bigint, length bigint, exit bigint"),
        f"{name}-candidates",
    )
    asked = found.where("exit >= 0").select("file", F.col("exit").alias("node"))
    asked = asked.union(blocks.select("file", F.lit(0).cast("bigint"))).distinct()
    nodes = stage.keep(
        asked.join(found.select("file", F.col("at").alias("node"), "block", "exit"), ["file", "node"]), f"{name}-nodes"
    )
    known = nodes.select("file", F.col("node").alias("next"))
    links = nodes.select("file", "node", F.col("exit").alias("next")).join(known, ["file", "next"])
    links = stage.keep(links.select("file", "node", "next"), f"{name}-links-0")
    reached, round_ = nodes.where("node = 0").select("file", "node"), 0
    while not links.isEmpty():
        round_ += 1
        further = reached.join(links, ["file", "node"]).select("file", F.col("next").alias("node"))
        reached = stage.keep(reached.union(further).distinct(), f"{name}-reached-{round_}")
        second = links.select("file", F.col("node").alias("next"), F.col("next").alias("last"))
        links = stage.keep(
            links.join(second, ["file", "next"]).select("file", "node", F.col("last").alias("next")), f"{name}-links-{round_}"
        )
    sound = (F.col("exit") == F.col("file_size")) | F.col("next").isNotNull()
    entries = (
        nodes.join(reached, ["file", "node"])
        .join(blocks.drop("start"), ["file", "block"])
        .join(known.withColumn("exit", F.col("next")), ["file", "exit"], "left")
        .select("file", "block", F.col("node").alias("entry"), sound.alias("sound"))
    )
    owners = found.drop("exit").join(entries, ["file", "block"], "left").groupBy("file", "block")
    owners = stage.keep(
        owners.applyInPandas(_owners, "file string, block bigint, row bigint, at bigint, size bigint, start bigint, end bigint"),
        f"{name}-owners",
    )
    bounds = F.struct("start", "end")
    last = owners.where("start >= 0").groupBy("file", "block").agg(F.max(bounds).alias("last"))
    carried = blocks.select("file", "block").join(last, ["file", "block"], "left")
    carried = carried.select("file", "block", F.last("last", ignorenulls=True).over(before).alias("carried"))
    own = F.when(F.col("start") >= 0, bounds).otherwise(F.col("carried"))
    more = (F.col("at") != F.col("own.start")) | (F.col("at") + F.col("size") < F.col("own.end"))
    return (
        owners.join(carried, ["file", "block"])
        .withColumn("own", own)
        .where("at >= own.start and at < own.end")
        .select("file", F.col("own.start").alias("offset"), "row", F.col("at").alias("part"), more.alias("split"))
    )


def read_warc(spark: SparkSession, path: str, payload: bool = True, stage: Stage | None = None) -> DataFrame:
    """(file, offset, page_id, record_type, refers_to, payload_bytes, payload_digest, payload).

    Tasks read byte ranges and cut them at the magic; lengths alone are dealt out by block, for the
    chains. A payload that holds the magic is put together from its parts; without
    ``payload`` that needs a second look, at the files concerned only. What follows a broken
    boundary or a record cut off at the end of a file is not returned. Revisits have no payload;
    their length and digest are the header's. No archive or an empty one gives no rows.
    """
    text = spark.read.option("lineSep", MAGIC).text(path)
    meta = [F.col(f"_metadata.{m}").alias(n) for m, n in (("file_path", "file"), ("file_block_start", "block"), ("file_size", "file_size"))]
    located = text.select("value", *meta, F.monotonically_increasing_id().alias("row"))
    return _read(located, payload, stage or Stage(spark), "warc")


def _read(text: DataFrame, payload: bool, stage: Stage, name: str) -> DataFrame:
    value = F.col("value")
    head = F.substring_index(value, "\r\n\r\n", 1)
    length = F.octet_length(head) + len(MAGIC) + 8 + field(head, "Content-Length").cast("bigint")
    own = {n: c for n, c in described(value).items() if n != "payload"}
    parts = stage.keep(
        text.select(
            "file",
            "block",
            "file_size",
            "row",
            F.octet_length(value).cast("bigint").alias("bytes"),
            F.when(F.instr(value, "\r\n\r\n") > 0, F.coalesce(length, F.lit(0))).otherwise(0).cast("bigint").alias("length"),
            *([value.alias("text")] if payload else [c.alias(n) for n, c in own.items()]),
        ),
        f"{name}-parts",
    )
    chain = stage.keep(follow_chains(parts, stage, name), f"{name}-chain")
    real = parts.drop("file").join(chain.drop("part").where("not split"), "row")
    split = chain.where("split")
    if payload:
        joined = (
            parts.drop("file")
            .join(split, "row")
            .groupBy("file", "offset")
            .agg(F.sort_array(F.collect_list(F.struct("part", "text"))).alias("own"))
            .select("file", "offset", F.array_join(F.transform("own", lambda x: x["text"]), MAGIC).alias("text"))
        )
        records = real.select("file", "offset", "text").unionByName(joined)
        return records.select("file", "offset", *[c.alias(n) for n, c in described(F.col("text")).items()])
    files = stage.keep(split.select("file").distinct(), f"{name}-split-files")
    simple = real.select("file", "offset", *own)
    if files.isEmpty():
        return simple
    again = text.join(files, "file", "left_semi")
    return simple.join(files, "file", "left_anti").unionByName(_read_again(again, stage, name).select("file", "offset", *own))


def _read_again(text: DataFrame, stage: Stage, name: str) -> DataFrame:
    return _read(text, True, stage, f"{name}-again")
