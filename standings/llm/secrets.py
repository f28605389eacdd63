"""Secret scans with multipart credential linking.

Base rules report a span by itself. Weak parts (an identifier, a short or unlabelled secret, an
endpoint) are reported only when the parts that make them a credential stand near by: an interval
join within a document finds, for every weak part, which kinds of parts lie within ``reach``.
Everything is DataFrame expressions; positions are code points, ends exclusive.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from standings.llm.common import Stage, let, packed, unpacked, whole
from standings.llm.simhash import row_key

# Kinds in the order in which they are listed; the first three are the base rules.
KINDS = ["assign", "access", "hex", "identifier", "secret", "endpoint"]
LABELLED = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
# A run of these characters is matched whole, so a least length can stand in the pattern.
ACCESS = "AKIA[A-Z0-9]{12,}"
HEX = "[0-9a-f]{32,}"
IDENTIFIER = (
    r"""(?i:access_?key_?id|client_?id|account_?id|user_?name|user|login)["']?\x20*[:=]\x20*["']?[A-Za-z0-9@_.-]{3,}"""
)
LONG_TOKEN = "[A-Za-z0-9+/]{40,}={0,2}"
ENDPOINT = r"""[A-Za-z][A-Za-z0-9+.-]{1,15}://[^\s"'<>]{3,}"""

SPANS = "array<struct<s:int,e:int>>"


@dataclass(frozen=True)
class SecretRules:
    """``least`` characters make a labelled value a secret, ``weak_least`` a weak one; parts belong
    together within ``reach`` code points."""

    least: int = 8
    weak_least: int = 4
    reach: int = 200
    mask: str = "[SECRET]"


# Running values are taken over slices of this many elements, and over their totals.
FAN = 256
# Code points in a part of a text that is cut at spans.
CUT = 256


def no_spans() -> Column:
    return F.expr(f"cast(array() as {SPANS})")


def running(values: Column, merge: Callable[[Column, Column], Column]) -> Column:
    """For each of the numbers, all before it merged, 0 for the first.

    A fold that appends to an array copies it for every element, so only slices are folded: first
    their totals are run over, then each slice goes on from the total before it.
    """

    def fold(part: Column, begin: Column) -> Column:
        def step(seen: Column, x: Column) -> Column:
            return F.struct(
                merge(seen["at"], x).alias("at"), F.concat(seen["out"], F.array(seen["at"])).alias("out")
            )

        none = F.struct(begin.alias("at"), F.expr("cast(array() as array<int>)").alias("out"))
        return F.aggregate(part, none, step, lambda seen: seen["out"])

    def sliced(own: Column) -> Column:
        last = F.greatest(F.lit(0), F.floor((F.size(own) - 1) / FAN).cast("int"))
        return F.transform(F.sequence(F.lit(0), last), lambda k: F.slice(own, k * FAN + 1, F.lit(FAN)))

    def joined(slices: Column) -> Column:
        totals = F.transform(slices, lambda part: F.aggregate(part, F.lit(0), merge))
        return F.flatten(F.zip_with(slices, fold(totals, F.lit(0)), fold))

    return let(let(values, sliced), joined)


def match_spans(text: Column, pattern: str, group: int = 0, least: int = 0, below: int | None = None) -> Column:
    """(s, e) of the matches whose ``group`` has ``least`` characters or more, and under ``below``.

    Cutting the text at the matches gives what lies between them; the lengths of both, added up
    in turn, are the positions.
    """

    def placed(found: Column) -> Column:
        between = F.split(text, pattern, -1)
        lengths = F.zip_with(
            F.slice(between, F.lit(1), F.size(found)),
            found,
            lambda gap, match: F.struct(F.length(gap).alias("gap"), F.length(match).alias("own")),
        )

        def spanned(lengths: Column) -> Column:
            before = running(F.transform(lengths, lambda x: x["gap"] + x["own"]), lambda at, n: at + n)

            def span(at: Column, x: Column) -> Column:
                start = at + x["gap"]
                return F.struct(start.alias("s"), (start + x["own"]).alias("e"))

            return F.zip_with(before, lengths, span)

        spans = let(lengths, spanned)
        if not group:
            return spans
        sizes = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)), F.length)
        wanted = lambda n: (n >= least) & (n < below) if below else n >= least
        kept = F.filter(
            F.zip_with(spans, sizes, lambda span, n: F.struct(span.alias("span"), n.alias("n"))),
            lambda x: wanted(x["n"]),
        )
        return F.transform(kept, lambda x: x["span"])

    return let(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        lambda found: F.when(F.size(found) > 0, placed(found)).otherwise(no_spans()),
    )


def of_kind(spans: Column, kind: str) -> Column:
    return F.transform(spans, lambda x: F.struct(x["s"].alias("s"), F.lit(KINDS.index(kind)).alias("kind"), x["e"].alias("e")))


def all_parts(text: Column, rules: SecretRules) -> tuple[Column, Column]:
    """Base spans and weak parts of a text, each as (s, kind, e) in order.

    A text is searched for a pattern only if it holds a character that every match holds.
    """

    def where(needed: Column, spans: Column) -> Column:
        return F.when(needed, spans).otherwise(no_spans())

    labelled = text.contains("=") | text.contains(":")
    base = {
        "assign": where(labelled, match_spans(text, LABELLED, 2, rules.least)),
        "access": where(text.contains("AKIA"), match_spans(text, ACCESS)),
        "hex": match_spans(text, HEX),
    }
    weak = {
        "identifier": where(labelled, match_spans(text, IDENTIFIER)),
        "secret": F.concat(
            where(labelled, match_spans(text, LABELLED, 2, rules.weak_least, rules.least)),
            match_spans(text, LONG_TOKEN),
        ),
        "endpoint": where(text.contains("://"), match_spans(text, ENDPOINT)),
    }
    join = lambda spans: F.sort_array(F.concat(*[of_kind(x, kind) for kind, x in spans.items()]))
    return join(base), join(weak)


def linked_parts(parts: DataFrame, rules: SecretRules) -> DataFrame:
    """(_k1, _k2, linked): the weak parts of each document that complementary parts stand by.

    An identifier needs a secret, a secret needs an identifier or an endpoint, an endpoint needs
    both. Parts are binned by ``reach``. A weak part asks in every bin that it touches, up to that
    of its end; another part answers from the bin before its start to that ``reach`` after its end.
    So two parts within reach share a bin, wherever they lie.
    """
    role = F.expr("element_at(array('secret', 'identifier', 'secret', 'identifier', 'secret', 'endpoint'), kind + 1)")
    every = (
        parts.where("size(weak) > 0")
        .select("_k1", "_k2", F.explode(F.concat("base", "weak")).alias("p"))
        .select("_k1", "_k2", "p.s", "p.kind", "p.e")
        .distinct()
        .withColumn("role", role)
        .withColumn("bin", F.expr(f"s div {rules.reach}"))
    )
    others = every.select(
        "_k1", "_k2", F.col("s").alias("os"), F.col("e").alias("oe"), F.col("role").alias("other"), "bin"
    )
    weak = every.where(F.col("kind") >= 3).withColumn("last", F.expr(f"e div {rules.reach}"))
    near = (F.col("os") - F.col("e") <= rules.reach) & (F.col("s") - F.col("oe") <= rules.reach)
    # The later of two parts starts at most ``reach`` after the earlier one ends; each asks both ways.
    spread = others.withColumn("upto", F.expr(f"(oe + {rules.reach}) div {rules.reach}")).withColumn(
        "bin", F.explode(F.expr(f"sequence(greatest(0, bin - 1), upto)"))
    )
    asked = weak.withColumn("bin", F.explode(F.expr("sequence(bin, last)")))
    met = (
        asked.join(spread, ["_k1", "_k2", "bin"])
        .where(near & (F.col("role") != F.col("other")))
        .groupBy("_k1", "_k2", "s", "kind", "e", "role")
        .agg(
            F.bool_or(F.col("other") == "secret").alias("by_secret"),
            F.bool_or(F.col("other") == "identifier").alias("by_identifier"),
            F.bool_or(F.col("other") == "endpoint").alias("by_endpoint"),
        )
    )
    whole_credential = (
        F.when(F.col("role") == "identifier", F.col("by_secret"))
        .when(F.col("role") == "secret", F.col("by_identifier") | F.col("by_endpoint"))
        .otherwise(F.col("by_secret") & F.col("by_identifier"))
    )
    return (
        met.where(whole_credential)
        .groupBy("_k1", "_k2")
        .agg(F.sort_array(F.collect_list(F.struct("s", "kind", "e"))).alias("linked"))
    )


def find_secrets(docs: DataFrame, rules: SecretRules = SecretRules(), stage: Stage | None = None) -> DataFrame:
    """(_k1, _k2, doc_id, base, spans) for each row: base spans, and all spans with linked weak parts.

    Spans are (s, kind, e) with ``kind`` a place in ``KINDS``, ordered by start and kind. Null and
    empty texts have none. Rows that agree in id and text are one document and get the same spans.
    """
    stage = stage or Stage(docs.sparkSession)
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    base, weak = all_parts(F.col("own"), rules)
    parts = stage.keep(
        texts.select(*row_key(), "doc_id", whole(F.col("text")).alias("own")).select(
            "_k1", "_k2", "doc_id", base.alias("base"), weak.alias("weak")
        ),
        "parts",
    )
    linked = linked_parts(parts, rules)
    every = F.when(F.col("linked").isNull(), F.col("base")).otherwise(F.sort_array(F.concat("base", "linked")))
    return parts.join(linked, ["_k1", "_k2"], "left").select("_k1", "_k2", "doc_id", "base", every.alias("spans"))


def listed_spans(spans: Column) -> Column:
    """``kind:start:end`` of all spans, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["s"], x["e"])), ","
    )


def masked(text: Column, spans: Column, mask: str) -> Column:
    """The text with every span, overlapping ones as one, replaced by ``mask``.

    ``spans`` are in order. The text is cut into parts of ``CUT`` code points once, so a piece of it
    is taken from the parts that it touches and not from the beginning.
    """

    def filled(parts: Column, ordered: Column) -> Column:
        def piece(begin: Column, end: Column) -> Column:
            first = F.floor(begin / CUT).cast("int")
            touched = F.slice(parts, first + 1, F.floor(end / CUT).cast("int") - first + 1)
            return F.substring(F.array_join(touched, ""), begin - first * CUT + 1, end - begin)

        # What earlier spans reach; a span that begins before it goes on with the mask of these.
        reached = running(F.transform(ordered, lambda x: x["e"]), lambda at, end: F.greatest(at, end))
        pieces = F.zip_with(
            reached,
            ordered,
            lambda at, x: F.when(x["s"] >= at, F.concat(piece(at, x["s"]), F.lit(mask))).otherwise(F.lit("")),
        )
        last = F.array_max(F.transform(ordered, lambda x: x["e"]))
        rest = let(last, lambda end: F.substring(text, end + 1, F.length(text)))
        return F.concat(F.array_join(pieces, ""), rest)

    parts = F.regexp_extract_all(text, F.lit("(?s).{1,%d}" % CUT), F.lit(0))
    return F.when(F.size(spans) == 0, text).otherwise(
        let(parts, lambda cut: let(spans, lambda ordered: filled(cut, ordered)))
    )


def mask_secrets(docs: DataFrame, rules: SecretRules = SecretRules()) -> DataFrame:
    """All rows of ``docs``, secrets in their texts masked and ``n_chars``, if there, counted anew."""
    stage = Stage(docs.sparkSession)
    found = find_secrets(docs, rules, stage).where("size(spans) > 0").select("_k1", "_k2", "spans").distinct()
    found = stage.keep(found, "spans")
    keys = row_key()
    joined = packed(docs, _k1=keys[0], _k2=keys[1]).join(found, ["_k1", "_k2"], "left")
    text = F.when(F.col("spans").isNull(), F.col("_row.text")).otherwise(
        masked(F.col("_row.text"), F.col("spans"), rules.mask)
    )
    row = joined.select("_row", "spans", text.alias("_text"))
    out = F.col("_row").withField("text", F.col("_text"))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        fresh = F.when(F.col("spans").isNull(), F.col("_row.n_chars")).otherwise(F.length("_text").cast(kind))
        out = out.withField("n_chars", fresh)
    return unpacked(row.select(out.alias("_row")))
