"""Substring dedup: passages that an earlier document has too, found by fixed-block anchors.

Each document is a reference for all documents with larger ids. Its words are cut into blocks of
``(size + 1) // 2`` words that do not overlap; every run of ``size`` words, wherever it stands, holds one of
its document's blocks whole. All blocks are indexed, and every document probes the index with the
windows of that length at each of its words. A hit is extended to both sides, word by word, as far as
``size`` words can still hold the block: each such stretch counts if an earlier document has the
same words. Stretches that overlap or touch merge into maximal repeats.

Index and probes meet in hash partitions (:mod:`dealtide.llm.chunks`), as numbers of 30 bits beside the
partition's: these only select where hits are extended. The extension compares 64 bits and the number
of the partition, and carries the smallest document id of each stretch.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dealtide.llm import chunks as C

#: Keys of a hash partition, about: what a task holds at once.
KEYS = 2_000_000
_BITS = 30
_U = np.uint64
_LAST = np.iinfo(np.int64).max


#: Bytes between words.
_SPACES = b" \t\n\x0b\x0c\r"


class _Words:
    """Words of a chunk's texts in one row, and whose words they are."""

    def __init__(self, rows: pa.Table):
        words = C.Words([(t.as_py() or "").encode() for t in rows.column("text")], _SPACES)
        self.hashes, self.lengths, self.owner = words.hashes, words.lengths, words.owner
        self.begins = np.cumsum(self.lengths) - self.lengths
        self.place, self.left = C.places(self.lengths)
        # A row without an id comes after all others.
        self.ids = np.array([_LAST if i is None else i for i in rows.column("id").to_pylist()], np.int64)

    def whole(self, size: int) -> np.ndarray:
        """Words at which so many words of one document begin."""
        return np.flatnonzero(self.left >= size)


def _bucket(keys: np.ndarray, count: int) -> np.ndarray:
    return (keys >> _U(64 - (count.bit_length() - 1))).astype(np.int64) if count > 1 else np.zeros(len(keys), np.int64)


def _short(keys: np.ndarray, count: int) -> np.ndarray:
    """Partition and number of a key in one: its first bits."""
    return keys >> _U(64 - _BITS - (count.bit_length() - 1))


def _probes(block: int, count: int):
    """Question: each different window of a chunk, whether it is a block, whether it stands there twice."""

    def question(rows: pa.Table):
        words = _Words(rows)
        at = words.whole(block)
        keys = np.sort(_short(C.runs(words.hashes, block)[at], count) << _U(1) | (words.place[at] % block == 0))
        first = np.flatnonzero(np.diff(keys >> _U(1), prepend=~keys[:1]))
        last = np.append(first[1:], len(keys))[: len(first)] - 1
        is_block, twice = keys[last] & _U(1), (last > first).astype(_U)
        keys = keys[first] >> _U(1)
        entry = (keys & _U((1 << _BITS) - 1)) << _U(2) | is_block << _U(1) | twice
        for bucket, (part,) in C.by_bucket((keys >> _U(_BITS)).astype(np.int64), entry.astype("<u4")):
            yield bucket, part.tobytes()

    return question


def _hits(bodies: list[bytes]) -> list[bytes]:
    """Answer: the windows of each chunk that are a block of some document and stand elsewhere too."""
    entries = [np.frombuffer(b, "<u4") for b in bodies]
    line = np.sort(np.concatenate(entries))
    number = line >> np.uint32(2)
    first = np.flatnonzero(np.diff(number.astype(np.int64), prepend=-1))
    count = np.diff(np.append(first, len(number)))
    is_block = np.logical_or.reduceat(line & np.uint32(2), first)
    twice = np.logical_or.reduceat(line & np.uint32(1), first)
    wanted = number[first[is_block & (twice | (count > 1))]]
    out = []
    for own in entries:
        own = own >> np.uint32(2)  # sorted
        out.append(own[C.among(own, wanted)].astype("<u4").tobytes())
    return out


def _extend(size: int, block: int, schema: pa.Schema):
    """Rows of a chunk with ``near``: a bit for each word at which a hit, extended, may begin."""

    def resolver(rows: pa.Table, told: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return schema.empty_table()
        words = _Words(rows)
        hits = [np.zeros(0, _U)]
        count = told.column("count")[0].as_py() if told.num_rows else 1
        for bucket, body in zip(told.column("bucket").to_pylist(), told.column("answer").to_pylist()):
            hits.append((_U(bucket) << _U(_BITS)) | np.frombuffer(body, "<u4").astype(_U))
        near = np.zeros(len(words.hashes), bool)
        at = words.whole(block)
        hit = np.zeros(len(words.hashes) + size, np.int32)
        hit[at] = C.among(_short(C.runs(words.hashes, block)[at], count), np.unique(np.concatenate(hits)))
        sums = np.concatenate([np.zeros(1, np.int32), np.cumsum(hit, dtype=np.int32)])
        begins = words.whole(size)
        near[begins] = sums[begins + size - block + 1] > sums[begins]
        bits = []
        for begin, length in zip(words.begins, words.lengths):
            own = near[begin : begin + length]
            bits.append(np.packbits(own).tobytes() if own.any() else None)
        lengths = pa.array(words.lengths, pa.int64())
        return pa.table([*[rows.column(c) for c in schema.names[:-2]], lengths, pa.array(bits, pa.binary())], schema=schema)

    return resolver


class _Stretches:
    """The runs of ``size`` words of a chunk at which hits may begin, by their keys: ``at`` and ``group`` for
    each run, ``keys`` and ``least`` (the smallest id) for each group of equal ones."""

    def __init__(self, rows: pa.Table, size: int):
        self.words = words = _Words(rows)
        marked = [np.unpackbits(np.frombuffer(b, np.uint8), count=n) for b, n in zip(rows.column("near").to_pylist(), words.lengths)]
        at = np.flatnonzero(np.concatenate([*marked, np.zeros(0, np.uint8)]))
        keys = C.runs(words.hashes, size)[at]
        order = np.argsort(keys, kind="stable")
        self.at, keys = at[order], keys[order]
        self.own = words.ids[words.owner[self.at]]
        new = np.diff(keys, prepend=~keys[:1]) != 0
        self.first = np.flatnonzero(new)
        self.group = np.cumsum(new) - 1
        self.keys = keys[self.first]
        self.least = np.minimum.reduceat(self.own, self.first) if len(keys) else self.own


def _stretches(size: int, count: int):
    """Question: each different stretch of a chunk with the smallest id that has it there."""

    def question(rows: pa.Table):
        s = _Stretches(rows, size)
        buckets = _bucket(C.runs(s.words.hashes, size, C.SECOND)[s.at[s.first]], count)
        order = np.argsort(buckets, kind="stable")
        for bucket, (keys, ids) in C.by_bucket(buckets[order], s.keys[order], s.least[order]):
            yield bucket, _pack(keys, ids)

    return question


def _pack(keys: np.ndarray, ids: np.ndarray) -> bytes:
    """Keys, and ids by planes of bytes, since the upper ones are much alike."""
    return keys.astype("<u8").tobytes() + ids.astype("<i8").view(np.uint8).reshape(-1, 8).T.tobytes()


def _split(body: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = len(body) // 16
    planes = np.frombuffer(body, np.uint8, 8 * n, 8 * n).reshape(8, n)
    return np.frombuffer(body, "<u8", n), np.ascontiguousarray(planes.T).view("<i8").reshape(n)


def _earliest(bodies: list[bytes]) -> list[bytes]:
    """Answer: the stretches of each chunk that another chunk has with a smaller id, and that id."""
    asked = [_split(b) for b in bodies]
    keys, ids = np.concatenate([k for k, _ in asked]), np.concatenate([i for _, i in asked])
    order = np.lexsort((ids, keys))
    keys, ids = keys[order], ids[order]
    first = np.flatnonzero(np.diff(keys, prepend=~keys[:1]))
    keys, ids = keys[first], ids[first]
    out = []
    for own, least in asked:
        known = ids[np.searchsorted(keys, own)]
        told = known < least
        out.append(_pack(own[told], known[told]))
    return out


def _remove(size: int, schema: pa.Schema):
    """Rows of a chunk without the words of their repeats."""

    def resolver(rows: pa.Table, told: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return schema.empty_table()
        s = _Stretches(rows, size)
        words, least = s.words, s.least.copy()
        for body in told.column("answer").to_pylist():
            keys, ids = _split(body)
            np.minimum.at(least, np.searchsorted(s.keys, keys), ids)
        repeated = s.at[least[s.group] < s.own]
        edges = np.zeros(len(words.hashes) + size + 1, np.int32)
        np.add.at(edges, repeated, 1)
        np.add.at(edges, repeated + size, -1)
        covered = np.cumsum(edges) > 0
        removed, kept = [], []
        for text, begin, length in zip(rows.column("text"), words.begins, words.lengths):
            gone = covered[begin : begin + length]
            left = [w for w, g in zip((text.as_py() or "").encode().split(), gone.tolist()) if not g]
            removed.append(int(gone.sum()))
            kept.append(b" ".join(left).decode())
        added = [pa.array(removed, pa.int64()), pa.array(kept, pa.string())]
        return pa.table([*[rows.column(c) for c in schema.names[:-2]], *added], schema=schema)

    return resolver


@F.arrow_udf(T.StringType())
def _spaced(texts: pa.Array) -> pa.Array:
    """The words of a text, joined by one space."""
    return pa.array([b" ".join((t.as_py() or "").encode().split()).decode() for t in texts], pa.string())


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def remove_repeats(docs: DataFrame, size: int = 13, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """All rows and columns of ``docs`` and ``repeats``: n_words, n_removed and the text that is left.

    A word goes if a run of ``size`` words that covers it also stands in a row with a smaller id. Runs are
    judged on the texts as they come, so the smallest of several ids keeps its words. Words stand between
    ASCII white space and are compared as they are. What is left is joined by one space.

    NULL and empty texts have no words and lose none. Texts of fewer than ``size`` words stay whole. Rows
    with the same id do not remove each other's words; a row without an id comes after all that have one.
    An empty table gives an empty table. Other columns may have any name.
    """
    block = (size + 1) // 2
    rest = [f"`{c}`" for c in docs.columns if c not in (id_column, text_column)]
    given = docs.select(
        F.col(f"`{id_column}`").cast("long").alias("id"), F.col(f"`{text_column}`").alias("text"),
        F.struct(F.col(f"`{id_column}`").alias("id"), F.struct(*(rest or [F.lit(0)])).alias("rest")).alias("row"),
    )
    dealt = C.deal(given, "text")
    count = C.partitions(dealt.measured["bytes"], 1, KEYS)
    # Stored, so that the shuffle of the probes is released before the texts are shuffled.
    hits = C.stored(C.answer(C.ask(dealt.table.select("id", "text", "chunk"), _probes(block, count)), _hits))
    wide = T.StructType([*dealt.table.schema.fields, T.StructField("words", T.LongType()), T.StructField("near", T.BinaryType())])
    extended = C.stored(
        C.resolve(dealt.table, hits.table.withColumn("count", F.lit(count)), wide, _extend(size, block, _arrow(wide))),
        F.coalesce(F.sum(F.when(F.col("near").isNotNull(), F.octet_length("text"))), F.lit(0)).alias("bytes"),
    )
    dealt.drop()
    hits.drop()
    near = extended.table.filter("near IS NOT NULL")
    count = C.partitions(extended.measured["bytes"], 1, KEYS)
    earliest = C.stored(C.answer(C.ask(near.select("id", "text", "near", "chunk"), _stretches(size, count)), _earliest)).table
    final = T.StructType([
        *[f for f in wide.fields if f.name in ("text", "row", "words")],
        T.StructField("removed", T.LongType()), T.StructField("left", T.StringType()),
    ])
    cut = C.resolve(near, earliest, final, _remove(size, _arrow(final)))
    whole = extended.table.filter("near IS NULL").select(
        "text", "row", "words", F.lit(0).cast("long").alias("removed"), _spaced("text").alias("left")
    )
    out = cut.unionByName(whole)
    columns = [
        F.col("text").alias(c) if c == text_column else F.col("row.id" if c == id_column else f"row.rest.`{c}`").alias(c)
        for c in docs.columns
    ]
    added = F.struct(F.col("words").alias("n_words"), F.col("removed").alias("n_removed"), F.col("left").alias("text"))
    return out.select(*columns, added.alias("repeats"))
