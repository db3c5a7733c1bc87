"""Language identification: interpolated Kneser-Ney models over characters, one per language."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dealtide.llm.tables import keep, prepare_python

ORDER, DISCOUNT = 4, 0.75
#: N-grams of all models that are in memory at once, about: larger models are cut into parts by the
#: third symbol of their n-grams, and each part is loaded by itself. None is left out.
ENTRIES = 2_000_000
#: Characters worked on at once, and n-grams a counting task holds.
PIECE, HELD = 1 << 20, 4_000_000
#: Share of the texts that the limit for rejection is calibrated on within it, and the margin above;
#: buckets that a range of entropies is cut into while that share is looked for.
WITHIN, MARGIN, BUCKETS = 0.995, 1.15, 1_000
#: Characters beyond which more text does not make a prediction surer.
SURE = 50

_EMPTY = np.zeros(0, np.uint64)


@lru_cache(maxsize=1)
def _symbols() -> np.ndarray:
    """Symbol of each code point: letters keep 16 bits of theirs, all else is a blank."""
    return np.array([c & 0xFFFF if chr(c).isalpha() else 32 for c in range(0x110000)], np.uint16)


def pieces(text: str) -> Iterator[np.ndarray]:
    """The n-grams of a text, a piece at a time: the code of each character and those before it.

    Lower case; a run of other characters than letters is one blank; a blank comes first.
    """
    before = np.full(ORDER - 1, 32, np.uint64)
    for at in range(0, len(text), PIECE):
        lower = text[at : at + PIECE].lower().encode("utf-32-le", "surrogatepass")
        symbols = _symbols()[np.frombuffer(lower, np.uint32)]
        blank = symbols == 32
        last = np.concatenate([[before[-1] == 32], blank[:-1]])
        line = np.concatenate([before, symbols[~(blank & last)].astype(np.uint64)])
        n = len(line) - ORDER + 1
        grams = np.zeros(n, np.uint64)
        for k in range(ORDER):
            grams = (grams << np.uint64(16)) | line[k : k + n]
        yield grams
        before = line[-(ORDER - 1) :]


def has_letter(text: str | None) -> bool:
    return text is not None and any(c.isalpha() for c in text)


def distinct(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different values, sorted, and how often each occurs."""
    if not len(grams):
        return _EMPTY, np.zeros(0, np.int64)
    grams = np.sort(grams)
    first = np.flatnonzero(np.concatenate([[True], grams[1:] != grams[:-1]]))
    return grams[first], np.diff(np.concatenate([first, [len(grams)]]))


def _merged(grams: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(grams, kind="stable")
    grams, counts = grams[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], grams[1:] != grams[:-1]])) if len(grams) else np.zeros(0, int)
    return grams[first], np.add.reduceat(counts, first) if len(grams) else counts


@dataclass(frozen=True)
class Level:
    """N-grams of one order, sorted, with log probabilities; contexts, sorted, with the log weight
    that they leave to the order below."""

    grams: np.ndarray
    log_p: np.ndarray
    contexts: np.ndarray
    log_rest: np.ndarray


@dataclass(frozen=True)
class Model:
    levels: tuple[Level, ...]
    log_unseen: float

    def log_p(self, grams: np.ndarray, order: int = ORDER) -> np.ndarray:
        """Of the last character of each n-gram, given those before it. ``grams``: sorted is faster."""
        if order == 0:
            return np.full(len(grams), self.log_unseen)
        level = self.levels[order - 1]
        out, found = _looked_up(level.grams, level.log_p, grams)
        missing = np.flatnonzero(~found)
        if len(missing):
            rest, known = _looked_up(level.contexts, level.log_rest, grams[missing] >> np.uint64(16))
            below = grams[missing] & np.uint64((1 << (16 * (order - 1))) - 1)
            out[missing] = np.where(known, rest, 0.0) + self.log_p(below, order - 1)
        return out


def _looked_up(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return np.zeros(len(wanted)), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    found = keys[at] == wanted
    return np.where(found, values[at], 0.0), found


def kneser_ney(
    grams: np.ndarray, counts: np.ndarray, discount: float = DISCOUNT, single: tuple[np.ndarray, np.ndarray] | None = None
) -> Model:
    """The model of sorted n-grams of the highest order with their counts.

    Lower orders count in how many different longer n-grams an n-gram ends. Each order leaves the
    discounted weight to the one below, the lowest to all 2**16 symbols alike.

    ``single``: the symbols, sorted, with their counts of that kind, if ``grams`` are a part of all:
    those with some third symbols. All that the orders above the lowest look up has the same third
    symbol, so the part gives its n-grams the values that the whole model gives them.
    """
    by_order = [(grams, counts.astype(np.float64))]
    for order in range(ORDER - 1, 0, -1):
        longer = by_order[0][0] & np.uint64((1 << (16 * order)) - 1)
        shorter, kinds = distinct(longer)
        by_order.insert(0, (shorter, kinds.astype(np.float64)))
    if single is not None:
        by_order[0] = (single[0], single[1].astype(np.float64))
    unseen = -math.log(1 << 16)
    levels: list[Level] = []
    for order, (keys, seen) in enumerate(by_order, 1):
        contexts, first = np.unique(keys >> np.uint64(16), return_index=True)
        total = np.add.reduceat(seen, first) if len(keys) else seen
        kinds = np.diff(np.concatenate([first, [len(keys)]])) if len(keys) else seen
        rest = discount * kinds / np.maximum(total, 1.0)
        of = np.searchsorted(contexts, keys >> np.uint64(16))
        below = Model(tuple(levels), unseen).log_p(keys & np.uint64((1 << (16 * (order - 1))) - 1), order - 1)
        p = (seen - discount) / total[of] + rest[of] * np.exp(below) if len(keys) else seen
        levels.append(Level(keys, np.log(p), contexts, np.log(rest)))
    return Model(tuple(levels), unseen)


@dataclass(frozen=True)
class Part:
    """The models of all languages for n-grams whose third symbol is from ``first`` to ``last``."""

    first: int
    last: int
    models: tuple[Model, ...] | Broadcast

    def loaded(self, alone: bool) -> tuple[Model, ...]:
        """One of several parts is read anew each time, so that no task holds them all."""
        if not isinstance(self.models, Broadcast):
            return self.models
        path = getattr(self.models, "_path", None)
        return self.models.value if alone or not path else self.models.load_from_path(path)


@dataclass(frozen=True)
class Identifier:
    languages: tuple[str, ...]
    parts: tuple[Part, ...]
    limits: tuple[float, ...]  # cross-entropy beyond which a text is in none of the languages

    def log_p(self, grams: np.ndarray) -> np.ndarray:
        """By n-gram and language."""
        out = np.zeros((len(grams), len(self.languages)))
        third = (grams >> np.uint64(16)) & np.uint64(0xFFFF)
        for part in self.parts:
            at = np.flatnonzero((third >= part.first) & (third <= part.last))
            if len(at):
                for k, model in enumerate(part.loaded(len(self.parts) == 1)):
                    out[at, k] = model.log_p(grams[at])
        return out

    def entropies(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Cross-entropy in nats a character, by text and language, and characters by text."""
        sums = np.zeros((len(texts), len(self.languages)))
        lengths = np.zeros(len(texts))
        held: list[tuple[int, np.ndarray, np.ndarray]] = []
        size = 0

        def flush():
            if not held:
                return
            known = np.unique(np.concatenate([g for _, g, _ in held]))
            of = np.concatenate([np.full(len(g), i) for i, g, _ in held])
            at = np.searchsorted(known, np.concatenate([g for _, g, _ in held]))
            counts = np.concatenate([c for _, _, c in held]).astype(np.float64)
            log_p = self.log_p(known)
            for k in range(len(self.languages)):
                sums[:, k] -= np.bincount(of, weights=counts * log_p[at, k], minlength=len(texts))
            held.clear()

        for i, text in enumerate(texts):
            for grams in pieces(text or ""):
                lengths[i] += len(grams)
                held.append((i, *distinct(grams)))
                size += len(held[-1][1])
                if size > PIECE:
                    flush()
                    size = 0
        flush()
        return sums / np.maximum(lengths, 1.0)[:, None], lengths

    def identify(self, texts: list[str | None]) -> list[dict]:
        if not self.languages:
            return [{"lang": "und", "score": 0.0, "entropy": None, "rejected": True} for _ in texts]
        entropies, lengths = self.entropies(texts)
        best = entropies.argmin(axis=1)
        out = []
        for text, line, n, k in zip(texts, entropies, lengths, best, strict=True):
            if not has_letter(text):
                out.append({"lang": "und", "score": 0.0, "entropy": None, "rejected": True})
                continue
            sure = 1.0 / np.exp(-(line - line[k]) * min(n, SURE)).sum()
            out.append({
                "lang": self.languages[k], "score": float(sure), "entropy": float(line[k]),
                "rejected": bool(line[k] > self.limits[k]),
            })
        return out


def count_grams(labelled: DataFrame) -> DataFrame:
    """lang, gram, n: how often each n-gram of the highest order occurs, over all whole texts."""
    prepare_python(labelled.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        size = 0

        def merged():
            return {lang: _merged(np.concatenate([g for g, _ in parts]), np.concatenate([c for _, c in parts]))
                    for lang, parts in held.items()}

        def emit():
            for lang, (grams, counts) in merged().items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(grams), pa.string()), pa.array(grams.view(np.int64)), pa.array(counts.astype(np.int64))],
                    names=["lang", "gram", "n"],
                )

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for grams in pieces(text):
                    held.setdefault(lang, []).append(distinct(grams))
                    size += len(held[lang][-1][0])
                if size > HELD:
                    for name, both in merged().items():
                        held[name] = [both]
                    size = sum(len(parts[0][0]) for parts in held.values())
                    if size > HELD // 2:
                        yield from emit()
                        held.clear()
                        size = 0
        yield from emit()

    return (
        labelled.filter("lang IS NOT NULL AND text IS NOT NULL").select(F.col("lang").cast("string"), F.col("text").cast("string"))
        .mapInArrow(count, "lang string, gram bigint, n bigint")
        .groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    )


def _cuts(sizes: list[tuple[int, int]], entries: int) -> list[tuple[int, int]]:
    """Runs of symbols with at most ``entries`` n-grams, or of one symbol; they cover all symbols."""
    starts, held = [0], 0
    for symbol, size in sorted(sizes):
        if held and held + size > entries:
            starts.append(symbol)
            held = 0
        held += size
    return [(start, end - 1) for start, end in zip(starts, [*starts[1:], 1 << 16], strict=True)]


def learn(labelled: DataFrame, entries: int = ENTRIES) -> Identifier:
    """Models of all languages in ``labelled`` (lang, text), from all n-grams of all its whole texts.

    The n-grams are counted in Spark. About ``entries`` of them come to the driver at once: a part of
    the models, which is broadcast before the next one is made (a symbol that is the third one of more
    n-grams than that is a part of its own). The limits for rejection are fitted on all texts, too.
    Rows with a NULL are not learned from; without any row, nothing is identified.
    """
    context = labelled.sparkSession.sparkContext
    counts = keep(count_grams(labelled))
    languages = sorted(r["lang"] for r in counts.select("lang").distinct().collect())
    if not languages:
        return Identifier((), (), ())
    of_lang = F.array_position(F.array(*[F.lit(x) for x in languages]), F.col("lang")).cast("int").alias("lang")
    third = F.shiftrightunsigned("gram", 16).bitwiseAND(F.lit(0xFFFF))
    # The different pairs of the last two symbols: they say how many symbols stand before the last.
    pairs = keep(
        counts.groupBy(of_lang, third.cast("int").alias("third"), F.col("gram").bitwiseAND(F.lit(0xFFFF)).cast("int").alias("last"))
        .agg(F.count("*").alias("size"))
    )
    ends = pairs.groupBy("lang", "last").agg(F.count("*").alias("kinds")).toArrow().to_pydict()
    lang, last, kinds = (np.array(ends[c], np.int64) for c in ("lang", "last", "kinds"))
    single = []
    for k in range(len(languages)):
        at = np.flatnonzero(lang == k + 1)
        at = at[np.argsort(last[at])]
        single.append((last[at].astype(np.uint64), kinds[at]))
    sizes = [(r["third"], r["size"]) for r in pairs.groupBy("third").agg(F.sum("size").alias("size")).collect()]
    parts = []
    for first, end in _cuts(sizes, entries):
        got = counts.filter(third.between(first, end)).select(of_lang, "gram", "n").toArrow()
        lang, seen = got.column("lang").to_numpy(), got.column("n").to_numpy()
        grams = got.column("gram").to_numpy().view(np.uint64)
        models = []
        for k in range(len(languages)):
            at = np.flatnonzero(lang == k + 1)
            at = at[np.argsort(grams[at])]
            models.append(kneser_ney(grams[at], seen[at], single=single[k]))
        parts.append(Part(first, end, context.broadcast(tuple(models))))
    found = Identifier(tuple(languages), tuple(parts), (math.inf,) * len(languages))
    return Identifier(found.languages, found.parts, _limits(labelled, found))


def _limits(labelled: DataFrame, found: Identifier) -> tuple[float, ...]:
    """By language: the entropy that a share of ``WITHIN`` of its texts have at most, and the margin.

    All different texts count, each once, that are identified as the language they are learned from.
    """
    text = F.col("text").cast("string")
    given = labelled.filter("lang IS NOT NULL AND text IS NOT NULL").select(
        F.col("lang").cast("string").alias("lang"), text.alias("text"), F.md5(text).alias("hash")
    )
    own = F.when(F.col("language.lang") == F.col("lang"), F.col("language.entropy"))
    seen = identify(given, found).groupBy("lang", "hash").agg(F.min(own).alias("value")).filter("value IS NOT NULL")
    within = quantiles(keep(seen.select(F.col("lang").alias("group"), "value")), WITHIN)
    return tuple(within[lang] * MARGIN if lang in within else math.inf for lang in found.languages)


def quantiles(values: DataFrame, share: float) -> dict[str, float]:
    """By ``group``: the quantile of ``value`` over all rows, interpolated between two neighbours.

    It is exact, and no task or driver gets a group: the values are counted by buckets of equal width,
    and the bucket of the one looked for is cut anew, from its least value to its greatest, until these
    are equal. ``values`` is read each time; no value is NULL or not finite.
    """
    size = (F.count("*").alias("n"), F.min("value").alias("low"), F.max("value").alias("high"))
    places: dict[str, float] = {}
    wanted: dict[tuple[str, int], tuple[int, float, float]] = {}  # values below it in its range, and the range
    for group, n, low, high in values.groupBy("group").agg(*size).collect():
        places[group] = share * (n - 1)
        for rank in (math.floor(places[group]), math.ceil(places[group])):
            wanted[group, rank] = (rank, low, high)
    value, least, most = F.col("value"), F.col("least"), F.col("most")
    bucket = F.least(F.floor((value - least) / (most - least) * BUCKETS), F.lit(BUCKETS - 1))
    while ranges := [(*key, low, high) for key, (_, low, high) in wanted.items() if low < high]:
        cut = F.broadcast(values.sparkSession.createDataFrame(ranges, "group string, rank bigint, least double, most double"))
        counted = values.join(cut, "group").filter(value.between(least, most))
        buckets: dict[tuple[str, int], list[tuple]] = {}
        for group, rank, *line in counted.groupBy("group", "rank", bucket.alias("bucket")).agg(*size).collect():
            buckets.setdefault((group, rank), []).append(tuple(line))
        for key, lines in buckets.items():
            below = wanted[key][0]
            for _, n, low, high in sorted(lines):
                if below < n:
                    wanted[key] = (below, low, high)
                    break
                below -= n
    return {
        group: float(np.quantile([wanted[group, math.floor(at)][1], wanted[group, math.ceil(at)][1]], at - math.floor(at)))
        for group, at in places.items()
    }


def identify(df: DataFrame, identifier: Identifier, text: str = "text", name: str = "language") -> DataFrame:
    """All rows and columns, and the struct ``name``: lang, score, entropy, rejected.

    ``lang``: the language whose model gives the whole text the lowest cross-entropy a character
    (of equal ones, the first by name). ``score``: its share when the languages are weighed by that.
    ``rejected``: the entropy is beyond what texts of that language have. A text that is NULL or has no
    letter is ``und``, score 0, rejected. A column of the name is replaced; rows are independent, and an
    empty table gives an empty table.
    """
    spark = df.sparkSession
    prepare_python(spark)
    kind = pa.struct([("lang", pa.string()), ("score", pa.float64()), ("entropy", pa.float64()), ("rejected", pa.bool_())])

    @F.arrow_udf("lang string, score double, entropy double, rejected boolean")
    def identified(texts: pa.Array) -> pa.Array:
        return pa.array(identifier.identify(texts.to_pylist()), kind)

    rest = [F.col(f"`{c}`") for c in df.columns if c.lower() != name.lower()]
    return df.select(*rest, identified(F.col(f"`{text}`").cast("string")).alias(name))


def held_out(identity: Column) -> Column:
    """Rows that are never learned from: CRC-32 of the id as text, 2 modulo 4."""
    return F.crc32(F.coalesce(identity.cast("string"), F.lit("")).cast("binary")) % 4 == 2
