"""Phrase collocations: frequent n-grams by mergeable Misra-Gries summaries, then exact counts.

First pass: each chunk of the texts sends the n-grams that it holds, each once with its count, to hash
partitions (:mod:`dealtide.llm.chunks`). A partition merges them into one Misra-Gries summary. Its capacity
exceeds the partition's mass divided by the threshold, so that what it takes off a counter stays below the
threshold: every frequent n-gram keeps a counter. Second pass: each chunk is told which of its n-grams
survived, and counts those exactly, by their words. The summaries work on 24 bits of a hash beside the
partition's; n-grams that meet there can only survive together.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dealtide.llm import chunks as C

#: Occurrences in a hash partition, about: bounds what a task holds at once.
MASS = 4_000_000
#: Counters of a summary for each one that the guarantee needs; errors are smaller by this factor.
ROOM = 8
_SLOT = 24
_U = np.uint64

#: A-Z in lower case, punctuation and line ends as the end of a piece, tab as a space.
_PIECES = bytes(
    10 if b in b".,;:!?\n\x0b\x0c\r" else 32 if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256)
)


class _Grams:
    """Words of a chunk in one row, with their language and how many follow in their piece."""

    def __init__(self, rows: pa.Table):
        self.words = words = C.Words([(t.as_py() or "").encode().translate(_PIECES) for t in rows.column("text")], b" \n")
        langs = rows.column("lang").to_pylist()
        self.langs = sorted(set(langs))
        number = {lang: n for n, lang in enumerate(self.langs)}
        own = np.array([number[x] for x in langs], np.int64)
        self.totals = dict(zip(self.langs, np.bincount(own, words.lengths, len(self.langs)).astype(np.int64).tolist()))
        self.lang = own[words.owner]
        salts = [hashlib.blake2b(lang.encode(), digest_size=8).digest() for lang in self.langs]
        self.salts = np.frombuffer(b"".join(salts), "<u8")
        cuts = np.flatnonzero(np.diff(words.piece, prepend=-1))
        self.left = C.places(np.diff(np.append(cuts, len(words))))[1]

    def of(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of the n-grams of a size and their keys."""
        at = np.flatnonzero(self.left >= size)
        return at, C.mix(C.runs(self.words.hashes, size)[at] ^ self.salts[self.lang[at]])


def _short(keys: np.ndarray, count: int) -> np.ndarray:
    """Partition and slot of a key in one: its first bits."""
    return keys >> _U(64 - _SLOT - (count.bit_length() - 1))


def _pack(slots: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted slots and their counts by planes of bytes, of which two compress well. Counts above 255
    take several entries."""
    entries = -(-counts // 255)
    slots = np.repeat(slots, entries)
    last = np.cumsum(entries) - 1
    counted = np.full(len(slots), 255, np.uint8)
    counted[last] = counts - 255 * (entries - 1)
    return (slots & 0xFFFF).astype("<u2").tobytes() + (slots >> 16).astype(np.uint8).tobytes() + counted.tobytes()


def _unpack(body: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = len(body) // 4
    low, high = np.frombuffer(body, "<u2", n), np.frombuffer(body, np.uint8, n, 2 * n)
    return low.astype(np.uint32) | high.astype(np.uint32) << np.uint32(16), np.frombuffer(body, np.uint8, n, 3 * n)


class MisraGries:
    """A summary of counts with at most ``capacity`` counters. A counter is too small by ``error`` at
    most, and ``error < mass / capacity``; so it is for merged summaries."""

    def __init__(self, capacity: int):
        self.capacity, self.error = capacity, 0
        self.keys, self.counts = np.zeros(0, np.uint32), np.zeros(0, np.int64)

    def merge(self, keys: np.ndarray, counts: np.ndarray) -> None:
        keys, counts = np.concatenate([self.keys, keys]), np.concatenate([self.counts, counts])
        if not len(keys):
            return
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        first = np.flatnonzero(np.diff(keys.astype(np.int64), prepend=-1))
        keys, counts = keys[first], np.add.reduceat(counts, first)
        if len(keys) > self.capacity:
            cut = np.partition(counts, len(counts) - self.capacity - 1)[len(counts) - self.capacity - 1]
            self.error += int(cut)
            keys, counts = keys[counts > cut], counts[counts > cut] - cut
        self.keys, self.counts = keys, counts

    def survivors(self, threshold: int) -> np.ndarray:
        """Keys that may have ``threshold`` occurrences: all that have are among them."""
        return self.keys[self.counts + self.error >= threshold]


def _sends(longest: int, count: int):
    """Question: the n-grams of a chunk with their counts."""

    def question(rows: pa.Table):
        grams = _Grams(rows)
        for size in range(1, longest + 1):
            _, keys = grams.of(size)
            keys, counts = np.unique(_short(keys, count), return_counts=True)
            slots = (keys & _U((1 << _SLOT) - 1)).astype(np.int64)
            for bucket, (own, n) in C.by_bucket((keys >> _U(_SLOT)).astype(np.int64), slots, counts):
                yield bucket, _pack(own, n)

    return question


def _survive(threshold: int, room: int):
    """Answer: the n-grams of each chunk that survive in the summary of the partition."""

    def answers(bodies: list[bytes]) -> list[bytes]:
        mass = sum(int(_unpack(b)[1].sum(dtype=np.int64)) for b in bodies)
        summary = MisraGries(room * (mass // threshold + 1))
        waiting, held = [], 0
        for n, body in enumerate(bodies, 1):
            waiting.append(_unpack(body))
            held += len(body) // 4
            if held >= summary.capacity or n == len(bodies):
                summary.merge(np.concatenate([k for k, _ in waiting]), np.concatenate([c.astype(np.int64) for _, c in waiting]))
                waiting, held = [], 0
        wanted = summary.survivors(threshold)
        out = []
        for body in bodies:
            own = _unpack(body)[0]
            out.append(own[C.among(own, wanted)].astype("<u4").tobytes())
        return out

    return answers


_COUNTED = "bucket int, langs array<string>, sizes array<int>, phrases array<string>, counts array<bigint>"
_SUMMED = "lang string, size int, phrase string, n bigint"


def _counts(longest: int, count: int):
    """The surviving n-grams of a chunk with their counts, those of a hash partition in one row; of size
    0: all words of a language."""

    def resolver(rows: pa.Table, told: pa.Table) -> pa.Table:
        grams = _Grams(rows)
        parts = [
            (_U(bucket) << _U(_SLOT)) | np.frombuffer(body, "<u4").astype(_U)
            for bucket, body in zip(told.column("bucket").to_pylist(), told.column("answer").to_pylist())
        ]
        wanted = np.unique(np.concatenate([*parts, np.zeros(0, _U)]))
        buckets = [np.zeros(len(grams.langs), np.int64)]
        langs, texts = list(grams.langs), [""] * len(grams.langs)
        sizes, counts = [np.zeros(len(langs), np.int32)], [np.array(list(grams.totals.values()), np.int64)]
        for size in range(1, longest + 1):
            at, keys = grams.of(size)
            hit = C.among(_short(keys, count), wanted)
            keys, first, n = np.unique(keys[hit], return_index=True, return_counts=True)
            found = at[hit][first]
            langs += [grams.langs[x] for x in grams.lang[found].tolist()]
            texts += [grams.words.text(x, size) for x in found.tolist()]
            buckets.append((_short(keys, count) >> _U(_SLOT)).astype(np.int64))
            sizes.append(np.full(len(keys), size, np.int32))
            counts.append(n.astype(np.int64))
        bucket = np.concatenate(buckets)
        order = np.argsort(bucket, kind="stable")
        given, begins = np.unique(bucket[order], return_index=True)
        offsets = pa.array(np.append(begins, len(order)), pa.int32())
        flat = (
            pa.array(langs, pa.string()), pa.array(np.concatenate(sizes)), pa.array(texts, pa.string()), pa.array(np.concatenate(counts)),
        )
        lists = [pa.ListArray.from_arrays(offsets, x.take(pa.array(order))) for x in flat]
        return pa.table([pa.array(given, pa.int32()), *lists], names=["bucket", "langs", "sizes", "phrases", "counts"])

    return resolver


def _sums(threshold: int):
    """The exact counts of a hash partition: the chunks' counts added up."""

    def run(rows: pa.Table) -> pa.Table:
        flat = [rows.column(c).combine_chunks().flatten() for c in ("langs", "sizes", "phrases", "counts")]
        summed = pa.table(flat, names=["lang", "size", "phrase", "n"]).group_by(["lang", "size", "phrase"]).aggregate([("n", "sum")])
        n, size = summed.column("n_sum").to_numpy(), summed.column("size").to_numpy()
        kept = summed.filter(pa.array((n >= threshold) | (size == 0) & (n > 0)))
        return kept.select(["lang", "size", "phrase", "n_sum"]).rename_columns(["lang", "size", "phrase", "n"])

    return run


def frequent_phrases(docs: DataFrame, threshold: int, longest: int) -> DataFrame:
    """lang, size, phrase, n: all runs of up to ``longest`` words with at least ``threshold`` occurrences in
    the texts of a language, counted exactly; with size 0 the number of its words.

    The counts of a chunk travel as one row for each hash partition. It holds a phrase once, so that the rows of
    a partition are bounded by its mass, and no phrase is hot.
    """
    dealt = C.deal(docs.select("text", F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang")), "text")
    count = C.partitions(dealt.measured["bytes"], longest, MASS)
    survivors = C.stored(C.answer(C.ask(dealt.table, _sends(longest, count)), _survive(threshold, ROOM)))
    counted = C.resolve(dealt.table, survivors.table, _COUNTED, _counts(longest, count))
    out = C.stored(counted.groupBy("bucket").applyInArrow(_sums(threshold), _SUMMED)).table
    dealt.drop()
    survivors.drop()
    return out


def _joined(words, begin, length):
    return F.array_join(F.slice(words, begin, length), " ")


def collocations(docs: DataFrame, threshold: int = 100, longest: int = 5, first: int = 2000) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: phrases of two to ``longest`` words that stand together more often
    than their parts would by chance, the ``first`` of each language.

    Words stand between spaces and tabs within pieces, which end at ``. , ; : ! ?`` and line ends; A-Z count as
    a-z. A phrase occurs ``a`` times; cut in two, its parts occur ``l`` and ``r`` times, of ``n`` words. The score
    is ``1000 a n / (l r)``, rounded down, for the cut of the lowest score (the first of equal ones). Phrases
    that only occur within one longer frequent phrase are left out.

    NULL and empty texts have no words. A NULL language is ``und``. Repeated rows count as often as they
    come. Ties are broken by frequency and by the phrase's bytes. Columns other than ``text`` and ``lang`` are
    not looked at. An empty table gives no rows.
    """
    counted = frequent_phrases(docs, threshold, longest)
    # Spark shuffles a side of these joins only if it is not small; both grow with the frequent phrases.
    phrases = counted.filter("size >= 2").select("lang", "size", "phrase", F.col("n").alias("a"))
    totals = counted.filter("size = 0").select("lang", "n")
    parts = counted.filter("size >= 1").select("lang", "phrase", "n")
    words = F.split("phrase", " ")
    cuts = phrases.select("*", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k")).select(
        "*", _joined(words, F.lit(1), F.col("k")).alias("head"), _joined(words, F.col("k") + 1, F.col("size") - F.col("k")).alias("tail")
    )
    scored = (
        cuts.join(parts.select("lang", F.col("phrase").alias("head"), F.col("n").alias("l")), ["lang", "head"])
        .join(parts.select("lang", F.col("phrase").alias("tail"), F.col("n").alias("r")), ["lang", "tail"])
        .join(totals, "lang")
        .withColumn("score", F.expr("cast(1000 as decimal(4, 0)) * cast(a as decimal(17, 0)) * cast(n as decimal(17, 0))"
                                    " div (cast(l as decimal(19, 0)) * cast(r as decimal(19, 0)))"))
        .groupBy("lang", "phrase", "a", "n")
        .agg(F.min(F.struct("score", "k", "l", "r")).alias("best"))
    )
    # If a phrase is as frequent as a longer one, so is every phrase between them: one word more is enough.
    longer = phrases.filter("size >= 3").select(
        "lang", "a", F.explode(F.array(_joined(words, F.lit(1), F.col("size") - 1), _joined(words, F.lit(2), F.col("size") - 1))).alias("phrase")
    ).groupBy("lang", "phrase").agg(F.max("a").alias("inside"))
    kept = scored.join(longer, ["lang", "phrase"], "left").filter("inside IS NULL OR inside < a")
    # A language is ranked in parts first, of which the best go on: as many parts as balance the rows of a
    # part with those that go on.
    parts_of_lang = max(1, math.isqrt(phrases.count() // first))
    order = (F.desc("best.score"), F.desc("a"), "phrase")
    kept = kept.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(parts_of_lang)))
    within = F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))
    best = kept.withColumn("place", within).filter(F.col("place") <= first)
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= first)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "best.l", "best.r", "n", "best.score")
