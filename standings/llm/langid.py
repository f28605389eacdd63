"""Language identification with interpolated Kneser-Ney character models.

Every language has a character n-gram model; a text gets the language under which its
length-normalised cross-entropy is lowest. Characters are lower-cased letters, all else is a
space. The n-grams of all training texts are counted in tasks and added up by Spark. The models
are then laid out as sorted arrays of n-gram hashes, one per order, with a log probability per
language, and sent to the tasks.

Counts of counts, context totals and continuation counts are taken by Spark over all n-grams, and
all n-grams seen are in the model. If a language has over ``max_entries`` different n-grams of an
order, the models are too large for a task: they are laid out as tables instead, the most frequent
n-grams are sent to the tasks, and the others of a text get their probabilities by joins.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from standings.llm.common import Stage, packed, tidy, unpacked

# Rows, characters and n-grams handled at a time inside a task: bounds on memory only.
ROWS_AT_ONCE, CHARS_AT_ONCE, GRAMS_HELD = 128, 300_000, 1_500_000
# An odd factor permutes the 64-bit n-gram codes, so equal hashes are equal n-grams.
MIX = np.uint64(0x9E3779B97F4A7C15)
BETAS = [1.0, 2.0, 4.0, 8.0, 16.0, 32.0, 64.0, 128.0]
UNDETERMINED = "und"
# Logarithms from tables are whole multiples of 2^-24, so that sums do not depend on their order.
UNIT = 1 << 24


@dataclass(frozen=True)
class LanguageRules:
    """``order`` characters an n-gram (4 at most: 16 bits each). One ``calibration_share``-th of the
    training texts is not counted but used to calibrate scores and rejection: the limit of a
    language lies ``reject_share`` of the way from the mean cross-entropy of its own texts to that
    of the other languages' texts under its model. A text beyond the limit of its best language is
    rejected. ``max_entries`` different n-grams of an order and language go to the tasks at most."""

    order: int = 4
    max_entries: int = 1 << 20
    calibration_share: int = 16
    reject_share: float = 0.75


def char_table() -> np.ndarray:
    """UTF-16 units to themselves if letters or halves of a pair, else to a space."""
    units = np.arange(65536, dtype=np.uint16)
    keep = np.array([0xD800 <= i < 0xE000 or chr(i).isalpha() for i in range(65536)])
    return np.where(keep, units, np.uint16(32))


def streams(texts: list[str], table: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """All texts as one array of characters, each led by ``order - 1`` spaces, and their starts."""
    lead = b"\x20\x00" * (order - 1)
    coded = [lead + t.lower().encode("utf-16-le", "surrogatepass") for t in texts]
    starts = np.cumsum([0] + [len(c) // 2 for c in coded])
    return table[np.frombuffer(b"".join(coded), "<u2")], starts


def gram_blocks(chars: np.ndarray, starts: np.ndarray, order: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Blocks of (n-gram code, text number); a space after a space is not predicted."""
    lead = order - 1
    for at in range(lead, len(chars), CHARS_AT_ONCE):
        part = chars[at - lead : at + CHARS_AT_ONCE].astype(np.uint64)
        n = len(part) - lead
        code = np.zeros(n, np.uint64)
        for k in range(order):
            code = (code << np.uint64(16)) | part[k : k + n]
        place = np.arange(at, at + n)
        doc = np.searchsorted(starts, place, "right") - 1
        real = (place - starts[doc] >= lead) & ~((part[lead:] == 32) & (part[lead - 1 : -1] == 32))
        yield code[real], doc[real]


def count_grams(order: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, held, size = char_table(), {}, 0

        def flush():
            for lang, parts in held.items():
                codes = np.concatenate([c for c, _ in parts])
                numbers = np.concatenate([n for _, n in parts])
                codes, which = np.unique(codes, return_inverse=True)
                total = np.bincount(which, weights=numbers).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(codes)), pa.array(codes.view(np.int64)), pa.array(total)],
                    ["lang", "code", "n"],
                )
            held.clear()

        for batch in tidy(batches):
            frame = batch.to_pandas()
            for lang, own in frame.groupby("lang", sort=False)["text"]:
                for at in range(0, len(own), ROWS_AT_ONCE):
                    chars, starts = streams(own.iloc[at : at + ROWS_AT_ONCE].tolist(), table, order)
                    for codes, _ in gram_blocks(chars, starts, order):
                        codes, n = np.unique(codes, return_counts=True)
                        held.setdefault(lang, []).append((codes, n))
                        size += len(codes)
            if size > GRAMS_HELD:
                yield from flush()
                size = 0
        yield from flush()

    return count


class SortedHashes:
    """A sorted array of n-gram hashes; their leading bits index it."""

    def __init__(self, codes: np.ndarray):
        hashes = codes * MIX
        self.order = np.argsort(hashes)
        self.hashes = hashes[self.order]
        bits = max(1, int(len(codes)).bit_length())
        self.shift = np.uint64(64 - bits)
        self.first = np.searchsorted(self.hashes >> self.shift, np.arange((1 << bits) + 1, dtype=np.uint64)).astype(np.int32)

    def find(self, codes: np.ndarray) -> np.ndarray:
        """Places in the array, -1 where absent."""
        hashes = codes * MIX
        slot = (hashes >> self.shift).astype(np.int64)
        place, end = self.first[slot], self.first[slot + 1]
        out = np.full(len(codes), -1, np.int32)
        open_ = np.flatnonzero(place < end)
        place, end, hashes = place[open_], end[open_], hashes[open_]
        while len(open_):
            hit = self.hashes[place] == hashes
            out[open_[hit]] = place[hit]
            place = place + 1
            more = ~hit & (place < end)
            open_, place, end, hashes = open_[more], place[more], end[more], hashes[more]
        return out


def discount(once: int, twice: int) -> float:
    """From the numbers of n-grams counted once and twice."""
    return once / (once + 2 * twice) if once and twice else 0.5


class LanguageModels:
    """Log probabilities of all languages for the n-grams that any of them has seen."""

    def __init__(self, counts: pd.DataFrame, order: int):
        """From the counts (lang, code, n) of all n-grams of the highest order."""
        languages = sorted(counts["lang"].unique())
        per_order = {}
        for lang in languages:
            own = counts[counts["lang"] == lang]
            codes, n = own["code"].to_numpy().view(np.uint64), own["n"].to_numpy()
            for size in range(order, 0, -1):
                _, of = np.unique(codes >> np.uint64(16), return_inverse=True)
                d = discount(int((n == 1).sum()), int((n == 2).sum()))
                per_order.setdefault(size, []).append((codes, n, np.bincount(of, weights=n)[of], d))
                # The next lower order counts the different characters seen before it.
                codes, n = np.unique(codes & self._mask(size - 1), return_counts=True) if size > 1 else (codes, n)
        self._lay_out(languages, order, per_order, len(np.unique(np.concatenate([t[0] for t in per_order[1]]))))

    @classmethod
    def fitted(cls, languages: list, order: int, per_order: dict, letters: int) -> LanguageModels:
        """From tables by order, one a language: codes, counts, their contexts' totals over all
        n-grams, whether or not they are listed, and the discount."""
        models = cls.__new__(cls)
        models._lay_out(languages, order, per_order, letters)
        return models

    def _lay_out(self, languages: list, order: int, per_order: dict, letters: int) -> None:
        self.languages, self.order = languages, order
        self.unknown = -np.log(letters + 1)
        self.grams, self.log_p, self.contexts, self.log_rest = {}, {}, {}, {}
        for size in range(1, order + 1):
            self._fit(size, per_order[size])

    @staticmethod
    def _mask(size: int) -> np.uint64:
        return np.uint64((1 << 16 * size) - 1)

    def _fit(self, size: int, tables: list) -> None:
        wide = len(self.languages)
        codes = np.unique(np.concatenate([t[0] for t in tables]))
        context = codes >> np.uint64(16)
        contexts, of = np.unique(context, return_inverse=True)
        seen, rest = np.zeros((len(codes), wide)), np.zeros((len(contexts), wide))
        for j, (own, n, totals, d) in enumerate(tables):
            at = np.searchsorted(codes, own)
            total = np.zeros(len(contexts))
            total[of[at]] = totals
            listed = np.bincount(of[at], weights=n, minlength=len(contexts))
            kinds = np.bincount(of[at], minlength=len(contexts))
            seen[at, j] = (n - d) / totals
            known = total > 0
            # What is discounted, and all of the n-grams that are not listed.
            rest[known, j] = np.log((d * kinds + total - listed)[known] / total[known])
        lower = self.score(codes & self._mask(size - 1), size - 1).astype(float)
        p = np.log(seen + np.exp(rest[of] + lower))
        grams, places = SortedHashes(codes), SortedHashes(contexts)
        self.grams[size], self.log_p[size] = grams, p[grams.order].astype(np.float32)
        self.contexts[size], self.log_rest[size] = places, rest[places.order].astype(np.float32)

    def score(self, codes: np.ndarray, size: int | None = None) -> np.ndarray:
        """Log probabilities (n-gram, language); an unseen n-gram backs off to the next order."""
        size = self.order if size is None else size
        if size == 0:
            return np.full((len(codes), len(self.languages)), self.unknown, np.float32)
        at = self.grams[size].find(codes)
        out = self.log_p[size][at]
        miss = np.flatnonzero(at < 0)
        if len(miss):
            lost = codes[miss]
            place = self.contexts[size].find(lost >> np.uint64(16))
            rest = np.where((place >= 0)[:, None], self.log_rest[size][place], np.float32(0))
            lower = self.score(lost & self._mask(size - 1), size - 1)
            out[miss] = rest + lower
        return out

    def with_entropies(self, docs: DataFrame) -> DataFrame:
        """``docs`` and, as ``h``, its texts' nats per character under each language, null without a letter."""
        return docs.withColumn("h", entropies(docs, self))

    def cross_entropies(self, texts: list, table: np.ndarray) -> list:
        """Per text the nats per character under each language; None without a letter."""
        texts = [t or "" for t in texts]
        chars, starts = streams(texts, table, self.order)
        sums, n = np.zeros((len(texts), len(self.languages))), np.zeros(len(texts), np.int64)
        for codes, doc in gram_blocks(chars, starts, self.order):
            if len(codes):
                heads = np.flatnonzero(np.diff(doc, prepend=-1))
                sums[doc[heads]] += np.add.reduceat(self.score(codes), heads, axis=0, dtype=np.float64)
                n += np.bincount(doc, minlength=len(texts))
        letters = np.add.reduceat(np.append(chars != 32, False), starts[:-1]) if len(texts) else []
        return [
            (-s / max(k, 1)).tolist() if some and any(map(str.isalpha, t)) else None
            for s, k, some, t in zip(sums, n, letters, texts)
        ]


def fold(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary"))


@dataclass(frozen=True)
class GramCounts:
    """All n-grams by order: kept tables (lang, code, n), and per language how many there are, once and twice."""

    grams: dict[int, DataFrame]
    sizes: dict[int, dict[str, Row]]
    languages: list[str]
    letters: int

    def discounts(self, size: int) -> list[float]:
        return [discount(self.sizes[size][lang].once, self.sizes[size][lang].twice) for lang in self.languages]

    def large(self, size: int, entries: int) -> list[str]:
        return [lang for lang, r in self.sizes[size].items() if r.kinds > entries]


def counted(docs: DataFrame, rules: LanguageRules, stage: Stage) -> GramCounts | None:
    """The n-grams of all texts of ``docs`` (text, lang); None if there are none."""
    counts = docs.select("lang", "text").mapInArrow(count_grams(rules.order), "lang string, code bigint, n bigint")
    grams = counts.groupBy("lang", "code").agg(F.sum("n").alias("n"))
    kept, numbers = {}, {}
    for size in range(rules.order, 0, -1):
        grams = kept[size] = stage.keep(grams, f"grams-{size}")
        numbers[size] = {
            r.lang: r
            for r in grams.groupBy("lang")
            .agg(F.count_if(F.col("n") == 1).alias("once"), F.count_if(F.col("n") == 2).alias("twice"), F.count("n").alias("kinds"))
            .collect()
        }
        if not numbers[size]:
            return None
        if size > 1:
            # The next lower order counts the different characters seen before it.
            grams = grams.groupBy("lang", low(F.col("code"), size - 1).alias("code")).agg(F.count(F.lit(1)).alias("n"))
    return GramCounts(kept, numbers, sorted(numbers[1]), grams.select("code").distinct().count())


def low(code: Column, size: int) -> Column:
    """The last ``size`` characters of n-grams."""
    return code if size == 4 else code.bitwiseAND(F.lit((1 << 16 * size) - 1).cast("bigint"))


def train(docs: DataFrame, rules: LanguageRules, stage: Stage) -> LanguageModels | None:
    """Models of every language in ``docs`` (text, lang), of a size that a task can hold: from the
    n-grams of all texts, listing ``max_entries`` of an order and language. `identify` takes them
    only where that is all of them, and `SpreadModels` otherwise."""
    counts = counted(docs, rules, stage)
    return listed_models(counts, rules) if counts else None


def listed_models(counts: GramCounts, rules: LanguageRules) -> LanguageModels:
    per_order = {}
    for size in range(rules.order, 0, -1):
        grams, discounts = counts.grams[size], counts.discounts(size)
        context = F.shiftrightunsigned("code", 16).alias("context")
        totals = grams.groupBy("lang", context).agg(F.sum("n").alias("total"))
        frequent = bounded(grams, counts.large(size, rules.max_entries), rules.max_entries).select("lang", "code", "n", context)
        found = frequent.join(totals, ["lang", "context"]).select("lang", "code", "n", "total").toPandas()
        own = {lang: rows for lang, rows in found.groupby("lang", sort=False)}
        per_order[size] = [
            (
                rows["code"].to_numpy(np.int64).view(np.uint64),
                rows["n"].to_numpy(np.int64),
                rows["total"].to_numpy(np.int64),
                d,
            )
            for lang, d in zip(counts.languages, discounts)
            for rows in [own.get(lang, found.iloc[:0])]
        ]
    return LanguageModels.fitted(counts.languages, rules.order, per_order, counts.letters)


class SpreadModels:
    """The models of `LanguageModels` over all n-grams, however many, as tables by order.

    ``grams[size]`` (code, n, p): natural logarithms by language; ``contexts[size]`` (context, rest).
    Texts are read once: n-grams among the most frequent are added up there, the others are counted
    by text, and their different codes are looked up by joins, backing off order by order.
    """

    def __init__(self, counts: GramCounts, rules: LanguageRules, stage: Stage):
        self.languages, self.order, self.stage = counts.languages, rules.order, stage
        self.unknown = float(-np.log(counts.letters + 1))
        self.grams, self.contexts, self.passes = {}, {}, 0
        for size in range(1, self.order + 1):
            self._fit(size, counts.grams[size], counts.discounts(size))
        # About as many values as a model of four languages has.
        self.frequent = self._most_frequent(max(1, 4 * rules.max_entries // len(self.languages)))

    def _by_language(self, value: str) -> Column:
        """An array with the sum of ``value`` for each language."""
        return F.array(*[F.coalesce(F.sum(F.when(F.col("lang") == x, F.expr(value))), F.lit(0)) for x in self.languages])

    def _each(self, value: str) -> Column:
        """``value`` of ``j`` for each language's number ``j``."""
        return F.expr(f"transform(sequence(0, {len(self.languages) - 1}), j -> {value})")

    def _fit(self, size: int, counts: DataFrame, discounts: list[float]) -> None:
        d = F.array(*[F.lit(x) for x in discounts])
        context = F.shiftrightunsigned("code", 16).alias("context")
        totals = counts.groupBy(context).agg(self._by_language("n").alias("total"), self._by_language("1L").alias("kinds"))
        rest = self._each("if(total[j] > 0, ln(d[j] * kinds[j] / total[j]), 0D)")
        contexts = totals.withColumn("d", d).select("context", "total", rest.alias("rest"))
        self.contexts[size] = self.stage.keep(contexts, f"contexts-{size}")
        grams = counts.groupBy("code").agg(F.sum("n").alias("n"), self._by_language("n").alias("own"))
        grams = grams.select("code", "n", "own", context).join(self.contexts[size], "context")
        if size == 1:
            grams = grams.withColumn("lower", self._each(f"{self.unknown!r}D"))
        else:
            below = self.grams[size - 1].select(F.col("code").alias("suffix"), F.col("p").alias("lower"))
            grams = grams.withColumn("suffix", low(F.col("code"), size - 1)).join(below, "suffix")
        p = self._each("ln(if(own[j] > 0, (own[j] - d[j]) / total[j], 0D) + exp(rest[j] + lower[j]))")
        self.grams[size] = self.stage.keep(grams.withColumn("d", d).select("code", "n", p.alias("p")), f"models-{size}")

    def _units(self) -> Column:
        return F.transform("p", lambda x: F.round(x * UNIT).cast("bigint")).alias("units")

    def _most_frequent(self, entries: int) -> tuple[np.ndarray, np.ndarray]:
        """``entries`` n-grams at most and their logarithms in units, ties going together."""
        table = self.grams[self.order]
        numbers = table.groupBy("n").count().toPandas().sort_values("n", ascending=False)
        fits = numbers[numbers["count"].cumsum() <= entries]
        least = int(fits["n"].min()) if len(fits) else int(numbers["n"].max()) + 1
        found = table.where(F.col("n") >= least).select("code", self._units()).toPandas()
        units = np.array(found["units"].tolist(), np.int64).reshape(len(found), len(self.languages))
        return found["code"].to_numpy(np.int64).view(np.uint64), units

    def scores(self, codes: DataFrame) -> DataFrame:
        """(code, units) for different codes (code); an unseen n-gram backs off to the next order."""
        self.passes += 1
        left = codes.select("code", self._each("0D").alias("so_far"))
        found = []
        for size in range(self.order, 0, -1):
            own, rests = self.grams[size].select(F.col("code").alias("gram"), "p"), self.contexts[size].select("context", "rest")
            here = left.withColumn("gram", low(F.col("code"), size)).withColumn("context", F.shiftrightunsigned("gram", 16))
            here = here.join(own, "gram", "left").join(rests, "context", "left")
            here = self.stage.keep(here.select("code", "so_far", "p", "rest"), f"looked-up-{self.passes}-{size}")
            found.append(here.where("p is not null").select("code", self._each("so_far[j] + p[j]").alias("p")))
            left = here.where("p is null").select("code", self._each("so_far[j] + coalesce(rest[j], 0D)").alias("so_far"))
        found.append(left.select("code", self._each(f"so_far[j] + {self.unknown!r}D").alias("p")))
        every = found[0]
        for more in found[1:]:
            every = every.unionByName(more)
        return every.select("code", self._units())

    def with_entropies(self, docs: DataFrame) -> DataFrame:
        """As of `LanguageModels`; ``docs`` has no columns ``_at`` and ``_sums``."""
        name = f"texts-{self.passes}"
        # Kept, so that a row has the same number in both uses.
        read = docs.withColumn("_at", F.monotonically_increasing_id()).withColumn("_sums", self._sums(docs))
        read = self.stage.keep(read, name)
        others = read.select("_at", F.explode(F.arrays_zip("_sums.code", "_sums.times")).alias("x")).select("_at", "x.*")
        looked = self.scores(others.select("code").distinct())
        more = [F.sum(F.get("units", F.lit(j)) * F.col("times")) for j in range(len(self.languages))]
        sums = others.join(looked, "code").groupBy("_at").agg(F.array(*more).alias("_more"))
        h = self._each(f"-(_sums.units[j] + coalesce(_more[j], 0L)) / {UNIT}D / greatest(_sums.n, 1L)")
        return read.join(sums, "_at", "left").select(*docs.columns, F.when(F.col("_sums.letters"), h).alias("h"))

    def _sums(self, docs: DataFrame) -> Column:
        shared, order, wide = docs.sparkSession.sparkContext.broadcast(self.frequent), self.order, len(self.languages)

        @F.pandas_udf("units array<bigint>, n bigint, letters boolean, code array<bigint>, times array<bigint>")
        def sums(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            table, (codes, units) = char_table(), shared.value
            frequent = SortedHashes(codes)
            units = np.append(units[frequent.order], np.zeros((1, wide), np.int64), axis=0)
            for batch in tidy(batches):
                out = []
                for at in range(0, len(batch), ROWS_AT_ONCE):
                    texts = [t or "" for t in batch.iloc[at : at + ROWS_AT_ONCE].tolist()]
                    out += text_sums(texts, table, order, frequent, units)
                yield pd.DataFrame(out, columns=["units", "n", "letters", "code", "times"])

        return sums(F.col("text"))


def text_sums(texts: list[str], table: np.ndarray, order: int, frequent: SortedHashes, units: np.ndarray) -> list[tuple]:
    """Per text the sums over its n-grams in ``frequent``, their number with all others, whether it
    has a letter, and the others with how often they occur. The last row of ``units`` is zero."""
    chars, starts = streams(texts, table, order)
    sums, n = np.zeros((len(texts), units.shape[1]), np.int64), np.zeros(len(texts), np.int64)
    others = [(np.empty(0, np.int64), np.empty(0, np.uint64))]
    for codes, doc in gram_blocks(chars, starts, order):
        if len(codes):
            place = frequent.find(codes)
            heads = np.flatnonzero(np.diff(doc, prepend=-1))
            sums[doc[heads]] += np.add.reduceat(units[place], heads, axis=0)
            n += np.bincount(doc, minlength=len(texts))
            others.append((doc[place < 0], codes[place < 0]))
    doc, codes = (np.concatenate(x) for x in zip(*others))
    by = np.lexsort((codes, doc))
    doc, codes = doc[by], codes[by]
    heads = np.flatnonzero((np.diff(doc, prepend=-1) != 0) | np.append(True, codes[1:] != codes[:-1])[: len(codes)])
    times, codes = np.diff(np.append(heads, len(codes))), codes[heads].view(np.int64)
    ends = np.searchsorted(doc[heads], np.arange(len(texts) + 1))
    return [
        (s, k, any(map(str.isalpha, t)) and bool((chars[a:b] != 32).any()), codes[x:y], times[x:y])
        for s, k, t, a, b, x, y in zip(sums, n, texts, starts, starts[1:], ends, ends[1:])
    ]


def bounded(grams: DataFrame, large: list[str], entries: int) -> DataFrame:
    """``grams``; of the languages in ``large`` the most frequent, ``entries`` at most, ties going together."""
    if not large:
        return grams
    numbers = grams.where(F.col("lang").isin(large)).groupBy("lang", "n").count().toPandas()
    stays = ~F.col("lang").isin(large)
    for lang, own in numbers.sort_values("n", ascending=False).groupby("lang"):
        fits = own[own["count"].cumsum() <= entries]
        stays |= (F.col("lang") == lang) & (F.col("n") >= (int(fits["n"].min()) if len(fits) else int(own["n"].max()) + 1))
    return grams.where(stays)


def entropies(docs: DataFrame, models: LanguageModels, text: str = "text") -> Column:
    shared = docs.sparkSession.sparkContext.broadcast(cloudpickle.dumps(models))

    @F.pandas_udf("array<double>")
    def cross_entropy(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        table, models = char_table(), cloudpickle.loads(shared.value)
        for batch in tidy(batches):
            out = []
            for at in range(0, len(batch), ROWS_AT_ONCE):
                out += models.cross_entropies(batch.iloc[at : at + ROWS_AT_ONCE].tolist(), table)
            yield pd.Series(out, dtype=object)

    return cross_entropy(F.col(text))


def softmax_of_best(h: Column, beta: float) -> Column:
    best = F.array_min(h)
    return 1 / F.aggregate(h, F.lit(0.0), lambda total, x: total + F.exp(F.lit(-beta) * (x - best)))


def calibrate(texts: DataFrame, models: LanguageModels | SpreadModels, rules: LanguageRules) -> tuple[float, dict[str, float]]:
    """The sharpness of the scores with the least log loss, and each language's limit."""
    names = F.array(*[F.lit(x) for x in models.languages])
    own = F.get(F.col("h"), (F.array_position(names, F.col("lang")) - 1).cast("int"))

    def loss_at(beta: float) -> Column:
        rivals = F.aggregate("h", F.lit(0.0), lambda total, x: total + F.exp(F.lit(-beta) * (x - F.col("own"))))
        return F.sum(F.ln(rivals))

    losses = [loss_at(beta).alias(f"loss_{i}") for i, beta in enumerate(BETAS)]
    sums = [F.sum(F.get("h", F.lit(i))).alias(f"sum_{i}") for i in range(len(models.languages))]
    found = (
        models.with_entropies(texts.select("lang", "text"))
        .select("lang", "h")
        .where("h is not null")
        .withColumn("own", own)
        .where("own is not null")
        .groupBy("lang")
        .agg(F.count(F.lit(1)).alias("n"), *sums, *losses)
        .collect()
    )
    loss = [sum(r[f"loss_{i}"] for r in found) for i in range(len(BETAS))]
    beta = BETAS[int(np.argmin(loss))] if found else BETAS[len(BETAS) // 2]
    limits = {}
    for i, lang in enumerate(models.languages):
        own = [r for r in found if r.lang == lang and r.n >= 30]
        others = sum(r.n for r in found if r.lang != lang)
        if own and others:
            mean = own[0][f"sum_{i}"] / own[0].n
            foreign = sum(r[f"sum_{i}"] for r in found if r.lang != lang) / others
            limits[lang] = mean + rules.reject_share * max(0.0, foreign - mean)
    return beta, limits


def identify(
    docs: DataFrame, labelled: DataFrame, rules: LanguageRules = LanguageRules(), stage: Stage | None = None
) -> DataFrame:
    """Every row of ``docs`` as ``_row`` with lang_pred, score (0 to 1), cross_entropy and accepted.

    ``labelled`` (doc_id, text, lang) trains the models; rows without text or language teach
    nothing. A text without a letter, null or empty, is ``und`` with score 0 and not accepted; so
    is every text if nothing was learned. Equal texts get equal answers, ties go to the language
    that sorts first. Only the text is looked at. A language with under 30 calibration texts, or
    the only one, rejects nothing.
    """
    stage = stage or Stage(docs.sparkSession)
    usable = labelled.where("text is not null and lang is not null").select("doc_id", "text", "lang")
    held = F.coalesce(F.shiftright(fold(F.col("doc_id")), 2) % rules.calibration_share == 0, F.lit(False))
    counts = counted(usable.where(~held), rules, stage)
    rows = packed(docs, text=F.col("text").cast("string"))
    if counts is None:
        none = rows.select("_row", F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score"))
        return none.withColumn("cross_entropy", F.lit(None).cast("double")).withColumn("accepted", F.lit(False))
    large = any(counts.large(size, rules.max_entries) for size in counts.grams)
    models = SpreadModels(counts, rules, stage) if large else listed_models(counts, rules)
    beta, limits = calibrate(usable.where(held), models, rules)
    names = F.array(*[F.lit(x) for x in models.languages])
    limit = F.array(*[F.lit(float(limits.get(x, float("inf")))) for x in models.languages])
    best = F.array_min("h")
    at = (F.array_position("h", best) - 1).cast("int")
    return (
        models.with_entropies(rows)
        .select("_row", "h")
        .withColumn("lang_pred", F.when(F.col("h").isNull(), UNDETERMINED).otherwise(F.get(names, at)))
        .withColumn("score", F.coalesce(softmax_of_best(F.col("h"), beta), F.lit(0.0)))
        .withColumn("cross_entropy", best)
        .withColumn("accepted", F.coalesce(best <= F.get(limit, at), F.lit(False)))
        .drop("h")
    )


def keep_identified(docs: DataFrame, labelled: DataFrame, rules: LanguageRules = LanguageRules()) -> DataFrame:
    """The rows of ``docs`` whose language `identify` accepts, unchanged."""
    return unpacked(identify(docs, labelled, rules).where("accepted"))
