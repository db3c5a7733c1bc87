"""Questions of text chunks to hash partitions, and the answers back to the chunks.

Some questions about a run of words can only be answered by looking at all texts: does another text
hold it, how often does it occur? Sending each run on its own, with its text and place, would shuffle a
multiple of the texts. Here texts are first dealt into chunks of some MB, written with their chunk's
number. A chunk asks each hash partition once for each *different* key that it holds, as an array of
numbers in one row. So a key takes part once for each chunk however often it occurs: no key is hot.
The partition answers each chunk with those of its keys that matter, and the chunk, joined with its
answers, finds the places of the keys itself.
"""

from __future__ import annotations

import gc
import random
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dealtide.llm.tables import drop_folder, new_folder, prepare_python

_U = np.uint64
#: Multipliers of the two hashes of a run of words: its key, and a second one.
KEY, SECOND = _U(0x9E3779B97F4A7C15), _U(0xD6E8FEB86659FD93)
#: Fewest partitions that are asked, so that small inputs use all machines.
LEAST_PARTITIONS = 64
#: Bytes of text that count as a word when the number of partitions is chosen.
WORD_BYTES = 5


@dataclass
class Stored:
    """A table written to the shared folder, its folder, and what was measured while writing."""

    table: DataFrame
    folder: str
    measured: dict

    def drop(self) -> None:
        drop_folder(self.table.sparkSession, self.folder)


def stored(df: DataFrame, *measures: Column) -> Stored:
    """Write a table for later steps. Shuffle files of steps that are over are released afterwards:
    Spark deletes them when the driver has no more reference to their plans."""
    spark = df.sparkSession
    folder, seen = new_folder(spark), Observation()
    measures = measures or (F.count(F.lit(1)).alias("rows"),)
    df.observe(seen, *measures).write.option("compression", "zstd").parquet(folder)
    out = Stored(spark.read.schema(df.schema).parquet(folder), folder, seen.get)
    release(spark)
    return out


def release(spark: SparkSession) -> None:
    """Have Spark delete the shuffle files of plans that nothing refers to: the second collection finds
    what the first has only cut loose."""
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.3)


def deal(df: DataFrame, text: str) -> Stored:
    """Write ``df`` with a column ``chunk``: rows that a task reads at once, 16 MB at most (or one
    text) by the session's setting. The numbers are random, but once written they stay."""
    prepare_python(df.sparkSession)
    schema = T.StructType([*df.schema.fields, T.StructField("chunk", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number = np.full(batch.num_rows, random.getrandbits(62), np.int64)
            yield batch.append_column("chunk", pa.array(number))

    size = F.coalesce(F.sum(F.octet_length(text)), F.lit(0)).alias("bytes")
    return stored(df.mapInArrow(run, schema), F.count(F.lit(1)).alias("rows"), size)


def partitions(text_bytes: int, keys_per_word: int, keys: int) -> int:
    """Power of two: hash partitions of about ``keys`` keys each."""
    wanted = max(LEAST_PARTITIONS, text_bytes // WORD_BYTES * keys_per_word // keys)
    return 1 << (wanted - 1).bit_length()


_ASKED = "bucket int, chunk bigint, body binary"
_ANSWERED = "chunk bigint, bucket int, answer binary"


def ask(chunks: DataFrame, question: Callable[[pa.Table], Iterator[tuple[int, bytes]]]) -> DataFrame:
    """bucket, chunk, body: what ``question`` makes of the rows of a chunk that a task reads at once.
    A chunk may be read in several parts, and then asks several times."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers = batch.column("chunk").to_numpy()
            for chunk in np.unique(numbers):
                part = pa.Table.from_batches([batch]).filter(pa.array(numbers == chunk))
                asked = list(question(part))
                yield pa.RecordBatch.from_arrays([
                    pa.array([b for b, _ in asked], pa.int32()),
                    pa.array([chunk] * len(asked), pa.int64()),
                    pa.array([body for _, body in asked], pa.binary()),
                ], names=["bucket", "chunk", "body"])

    return chunks.mapInArrow(run, _ASKED)


def answer(asked: DataFrame, answers: Callable[[list[bytes]], list[bytes]]) -> DataFrame:
    """chunk, bucket, answer: ``answers`` gets all bodies of one hash partition at once."""

    def run(rows: pa.Table) -> pa.Table:
        told = answers(rows.column("body").to_pylist())
        given = [n for n, t in enumerate(told) if t]
        return pa.table({
            "chunk": rows.column("chunk").take(pa.array(given, pa.int64())),
            "bucket": rows.column("bucket").take(pa.array(given, pa.int64())),
            "answer": pa.array([told[n] for n in given], pa.binary()),
        })

    return asked.groupBy("bucket").applyInArrow(run, _ANSWERED)


def resolve(chunks: DataFrame, answered: DataFrame, schema, resolver: Callable[[pa.Table, pa.Table], pa.Table]) -> DataFrame:
    """Rows of ``resolver(rows of a chunk, its answers)``."""
    def run(rows: pa.Table, told: pa.Table) -> pa.Table:
        return resolver(rows, told)

    return chunks.groupBy("chunk").cogroup(answered.groupBy("chunk")).applyInArrow(run, schema)


#: Bytes hashed at once.
_STEP = 1 << 20
#: Base of the polynomial that a word's bytes make up, modulo 2**64, and a number for each byte.
_BASE = 0x5851F42D4C957F2D
_INVERSE = pow(_BASE, -1, 1 << 64)


@lru_cache(maxsize=2)
def _powers(base: int) -> np.ndarray:
    out = np.full(_STEP, _U(base))
    out[0] = 1
    return np.cumprod(out)


@lru_cache(maxsize=1)
def _numbers() -> np.ndarray:
    return mix(np.arange(1, 257, dtype=_U) * KEY)


class Words:
    """The words of some texts, in one line: where they begin and end, and a 64-bit hash of each.

    ``separators``: bytes between words. ``breaks``: those of them that also end a piece; so does the end of a
    text. A hash is the difference of two running sums over the line, so no word is cut out for it.
    """

    def __init__(self, texts: list[bytes], separators: bytes, breaks: bytes = b"\n"):
        self.line = breaks[:1].join(texts)
        raw = np.frombuffer(self.line, np.uint8)
        is_space, is_break = np.zeros(256, bool), np.zeros(256, bool)
        is_space[list(separators)] = is_break[list(breaks)] = True
        numbers, power, inverse = _numbers(), _powers(_BASE), _powers(_INVERSE)
        parts: dict[str, list[np.ndarray]] = {k: [] for k in ("begins", "ends", "before", "after", "shift", "piece")}
        total, pieces, within = _U(0), 0, False
        for at in range(0, len(raw), _STEP):
            part = raw[at : at + _STEP]
            space = is_space[part]
            prior = np.concatenate([[not within], space[:-1]])
            sums = np.concatenate([[total], total + np.cumsum(numbers[part] * power[: len(part)] * _U(pow(_BASE, at, 1 << 64)))])
            begins, ends = np.flatnonzero(~space & prior), np.flatnonzero(space & ~prior)
            broken = pieces + np.cumsum(is_break[part])
            for name, value in (
                ("begins", begins + at), ("ends", ends + at), ("before", sums[begins]), ("after", sums[ends]),
                ("shift", inverse[begins] * _U(pow(_INVERSE, at, 1 << 64))), ("piece", broken[begins]),
            ):
                parts[name].append(value)
            total, pieces, within = sums[-1], int(broken[-1]), not space[-1]
        if within:
            parts["ends"].append(np.array([len(raw)]))
            parts["after"].append(np.array([total], _U))
        joined = {k: np.concatenate([np.zeros(0, _U if k in ("before", "after", "shift") else np.int64), *v]) for k, v in parts.items()}
        self.begins, self.ends, self.piece = joined["begins"], joined["ends"], joined["piece"]
        self.hashes = mix((joined["after"] - joined["before"]) * joined["shift"])
        lengths = np.array([len(t) + 1 for t in texts], np.int64)
        starts = np.cumsum(lengths) - lengths
        #: Words of each text, and the text of each word.
        self.lengths = np.diff(np.searchsorted(self.begins, np.append(starts, len(raw) + 1)))
        self.owner = np.repeat(np.arange(len(texts)), self.lengths)

    def __len__(self) -> int:
        return len(self.hashes)

    def text(self, first: int, size: int) -> str:
        """Words joined by one space."""
        return b" ".join(
            self.line[a:b] for a, b in zip(self.begins[first : first + size].tolist(), self.ends[first : first + size].tolist())
        ).decode()


def places(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For groups of so many rows, one after the other: each row's place in its group, and the rows from
    there to the end of the group."""
    begins = np.cumsum(lengths) - lengths
    place = np.arange(lengths.sum()) - np.repeat(begins, lengths)
    return place, np.repeat(lengths, lengths) - place


def among(values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Which of the values are in ``wanted``, sorted."""
    if not len(wanted):
        return np.zeros(len(values), bool)
    return wanted[np.minimum(np.searchsorted(wanted, values), len(wanted) - 1)] == values


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> _U(33))) * _U(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> _U(33))) * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


def runs(hashes: np.ndarray, size: int, multiplier: np.uint64 = KEY) -> np.ndarray:
    """A 64-bit hash of each run of ``size`` words, by the place of its first word."""
    n = max(0, len(hashes) - size + 1)
    total = np.zeros(n, _U)
    for k in range(size):
        total *= multiplier
        total += hashes[k : k + n]
    return mix(total)


def by_bucket(buckets: np.ndarray, *columns: np.ndarray) -> Iterator[tuple[int, list[np.ndarray]]]:
    """Slices of the columns, which are sorted by bucket."""
    if len(buckets):
        cuts = np.append(np.flatnonzero(np.diff(buckets, prepend=buckets[0] - 1 if buckets[0] else 1 << 40)), len(buckets))
        for a, b in zip(cuts[:-1], cuts[1:]):
            yield int(buckets[a]), [c[a:b] for c in columns]
