"""Near duplicates: MinHash signatures, a multi-index Hamming join, exact check, components."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dealtide.llm.components import components
from dealtide.llm.tables import keep, plain_columns, prepare_python
from dealtide.operators.duplicates import is_small, key_size
from dealtide.session import store

#: Values of the signature that the join works on (16 bits each), its chunks, and the distance it
#: guarantees: of 11 chunks, one at least has no more than one of 21 errors. At similarity 0.8 a
#: value differs with probability 0.2, so 21 is 2.5 deviations above 12.8; pairs beyond are missed
#: only if every chunk has two errors, with probability 0.00002.
JOINED, CHUNKS, DISTANCE = 64, 11, 21
#: Further values (8 bits each) that sort out pairs before the exact check: of all 160, 54 may
#: differ, 4.4 deviations above the 32 to be expected at similarity 0.8.
CHECKED, ALL_DISTANCE = 96, 54
#: Rows of a bucket that are compared with each other in one go.
BLOCK = 512
#: Words hashed in one go.
PIECE = 1 << 16

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


@lru_cache(maxsize=1)
def _tables() -> dict[str, np.ndarray]:
    """Pseudo-random constants, the same in every task."""
    line = mix(np.arange(1, 2000, dtype=_U) * _U(0x9E3779B97F4A7C15))
    sizes = [JOINED // CHUNKS + (c < JOINED % CHUNKS) for c in range(CHUNKS)]
    return {
        "bytes": line[:256],
        "factor": (line[300 : 300 + JOINED + CHECKED] >> _U(32)).astype(np.uint32) | np.uint32(1),
        "offset": (line[700 : 700 + JOINED + CHECKED] >> _U(32)).astype(np.uint32),
        "place": line[1100 : 1100 + JOINED],
        "left_out": line[1300 : 1300 + JOINED],
        "chunk": np.repeat(np.arange(CHUNKS), sizes),
        "starts": np.cumsum([0, *sizes[:-1]]),
    }


_BASE = 0x5851F42D4C957F2D
_INVERSE = pow(_BASE, -1, 1 << 64)


@lru_cache(maxsize=4)
def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, _U(base))
    out[0] = 1
    return np.cumprod(out)


def words(text: bytes) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case."""
    return text.translate(_LOWER).split()


def shingles(text: bytes, size: int) -> np.ndarray:
    """Hashes of the different runs of ``size`` words, sorted; of all words if there are fewer.

    A run is hashed as the polynomial of its bytes: the difference of two running sums.
    """
    given = words(text)
    if not given:
        return np.zeros(0, _U)
    size = min(size, len(given))
    parts = []
    table = _tables()["bytes"]
    for at in range(0, len(given) - size + 1, PIECE):
        line = np.frombuffer(b" ".join(given[at : at + PIECE + size - 1]), np.uint8)
        length = 1 << (len(line)).bit_length()
        ends = np.append(np.flatnonzero(line == 32), len(line))
        begins = np.concatenate([[0], ends[:-1] + 1])
        sums = np.concatenate([np.zeros(1, _U), np.cumsum(table[line] * _powers(_BASE, length)[: len(line)])])
        begins, ends = begins[: len(begins) - size + 1], ends[size - 1 :]
        parts.append(mix((sums[ends] - sums[begins]) * _powers(_INVERSE, length)[begins]))
    return np.unique(np.concatenate(parts))


def signature(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """MinHash values of a set: 16 bits of each of the joined ones, 8 bits of the others."""
    tables = _tables()
    factor, offset = tables["factor"], tables["offset"]
    short = (hashes >> _U(32)).astype(np.uint32)
    least = np.full(JOINED + CHECKED, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(short), 2048):
        block = short[at : at + 2048, None] * factor + offset
        least = np.minimum(least, block.min(axis=0))
    least = least * np.uint32(0x9E3779B1)
    return (least[:JOINED] >> np.uint32(16)).astype(np.uint16), (least[JOINED:] >> np.uint32(24)).astype(np.uint8)


def chunk_keys(joined: np.ndarray) -> np.ndarray:
    """For each value of a signature: the key of its chunk with that value left out.

    If a chunk of two signatures differs in one value at most, they share the key that leaves it out.
    """
    tables = _tables()
    terms = mix(joined.astype(_U) + tables["place"])
    chunks = np.add.reduceat(terms, tables["starts"])
    return mix(chunks[tables["chunk"]] - terms + tables["left_out"])


_PRINT = "struct<n:bigint,print:binary,joined:binary,signature:binary>"


def _fingerprints(size: int):
    @F.arrow_udf(_PRINT)
    def run(texts: pa.Array) -> pa.Array:
        counts, prints, indexed, signatures = [], [], [], []
        for text in texts:
            hashes = shingles(text.as_py() or b"", size)
            counts.append(len(hashes))
            prints.append(hashlib.blake2b(hashes.tobytes(), digest_size=16).digest())
            if len(hashes):
                joined, checked = signature(hashes)
                indexed.append(joined.tobytes())
                signatures.append(joined.astype(np.uint8).tobytes() + checked.tobytes())
            else:
                indexed.append(b"")
                signatures.append(b"")
        return pa.StructArray.from_arrays(
            [pa.array(counts, pa.int64()), pa.array(prints, pa.binary()), pa.array(indexed, pa.binary()),
             pa.array(signatures, pa.binary())],
            names=["n", "print", "joined", "signature"],
        )

    return run


def _lists(parts: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
    flat = np.concatenate(parts) if parts else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int64()))


def _keys():
    @F.arrow_udf("array<bigint>")
    def run(signatures: pa.Array) -> pa.Array:
        return _lists([chunk_keys(np.frombuffer(s.as_py(), np.uint16, JOINED)).view(np.int64) for s in signatures])

    return run


def _sets(size: int):
    @F.arrow_udf("array<bigint>")
    def run(texts: pa.Array) -> pa.Array:
        return _lists([shingles(t.as_py() or b"", size).view(np.int64) for t in texts])

    return run


def _find(parent: list[int], x: int) -> int:
    while parent[x] != x:
        parent[x] = parent[parent[x]]
        x = parent[x]
    return x


def close_pairs(signatures: np.ndarray, sides: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """Index pairs i < j within ``ALL_DISTANCE``, and their distance. ``sides``: only pairs of rows
    of different sides, if there are two."""
    out: list[tuple[np.ndarray, ...]] = []
    for i in range(len(signatures) - 1):
        others = np.arange(i + 1, len(signatures))
        if sides is not None:
            others = others[sides[others] != sides[i]]
        far = (signatures[others] != signatures[i]).sum(axis=1)
        near = np.flatnonzero(far <= ALL_DISTANCE)
        if len(near):
            out.append((np.full(len(near), i), others[near], far[near]))
    if not out:
        return np.zeros(0, int), np.zeros(0, int), np.zeros(0, int)
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def _columns(batch: pa.RecordBatch) -> Iterator[tuple]:
    """Rows of a batch; lists as arrays of numbers."""
    parts = []
    for column in batch.columns:
        if pa.types.is_list(column.type):
            flat = column.flatten().to_numpy(zero_copy_only=False)
            ends = np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False))
            parts.append([part.copy() for part in np.split(flat, ends[:-1])])
        else:
            parts.append(column.to_pylist())
    return zip(*parts, strict=True)


def _tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Rows of one tile, which come one after the other: its group and blocks, and the rows."""
    key, rows = None, []
    for batch in batches:
        for row in _columns(batch):
            if row[:3] != key:
                if len(rows) > 1:
                    yield key, rows
                key, rows = row[:3], []
            rows.append(row[3:])
    if len(rows) > 1:
        yield key, rows


def overlap(one: np.ndarray, other: np.ndarray) -> int:
    """How many values two sets share, as :func:`shingles` sorts them: without a sign."""
    one, other = one.view(_U), other.view(_U)
    if len(one) > len(other):
        one, other = other, one
    at = np.minimum(np.searchsorted(other, one), len(other) - 1)
    return int((other[at] == one).sum())


def _forest(similarity: tuple[int, int] | None):
    """Pairs of each tile that join a forest over its close pairs, closest first, starting from the
    roots that are known. With ``similarity``, only pairs whose sets are similar join."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[bytes, bytes]] = []

        def emit():
            batch = pa.RecordBatch.from_arrays(
                [pa.array([p[0] for p in out], pa.binary()), pa.array([p[1] for p in out], pa.binary())], names=["a", "b"]
            )
            out.clear()
            return batch

        for (_, one, other), rows in _tiles(batches):
            blocks = np.array([r[2] for r in rows])
            signatures = np.frombuffer(b"".join(r[3] for r in rows), np.uint8).reshape(len(rows), -1)
            i, j, far = close_pairs(signatures, None if one == other else blocks)
            known: dict[bytes, int] = {}
            parent = [known.setdefault(r[1], n) for n, r in enumerate(rows)]
            for at in np.lexsort((j, i, far)):
                x, y = int(i[at]), int(j[at])
                a, b = _find(parent, x), _find(parent, y)
                if a == b:
                    continue
                if similarity is not None:
                    shared = overlap(rows[x][4], rows[y][4])
                    every = len(rows[x][4]) + len(rows[y][4]) - shared
                    if shared * similarity[1] < every * similarity[0]:
                        continue
                parent[max(a, b)] = min(a, b)
                out.append((rows[x][0], rows[y][0]))
            if len(out) > 10_000:
                yield emit()
        if out:
            yield emit()

    return run


def _few(df: DataFrame, key: str) -> DataFrame:
    """A stored table with a key; broadcast only if it is small as measured."""
    stored, measured = store(df, *key_size([key]))
    return F.broadcast(stored) if is_small(measured) else stored


class _Texts:
    """The texts of nodes, read anew from the table for the few nodes that need a check."""

    def __init__(self, df: DataFrame, text: str, identity: str, size: int, nodes: DataFrame):
        given = F.encode(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")), "UTF-8")
        self.rows = df.select(F.col(f"`{identity}`").alias("id"), given.alias("text"))
        self.size, self.nodes = size, nodes.select("node", "first")

    def sets(self, wanted: DataFrame) -> DataFrame:
        """node, set. A node's first row is found by its id, and known by its fingerprint."""
        some = _few(self.nodes.join(wanted, "node", "left_semi"), "node")
        # Stored first: else Spark takes the fingerprints of all rows before it joins them.
        found = keep(self.rows.join(some, F.col("id").eqNullSafe(F.col("first"))))
        found = found.withColumn("made", _fingerprints(self.size)(F.col("text")))
        texts = found.filter(F.col("made.print") == F.col("node")).groupBy("node").agg(
            F.any_value("text").alias("text")
        )
        return keep(texts.select("node", _sets(self.size)(F.col("text")).alias("set")))


def _exact(pairs: DataFrame, texts: _Texts, similarity: tuple[int, int]) -> DataFrame:
    """The pairs whose whole sets are similar."""
    wanted = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    sets = texts.sets(wanted)
    both = pairs.join(sets.select(F.col("node").alias("a"), F.col("set").alias("one")), "a").join(
        sets.select(F.col("node").alias("b"), F.col("set").alias("other")), "b"
    )
    shared = F.size(F.array_intersect("one", "other"))
    least, of = similarity
    return both.filter(
        shared * F.lit(of) >= (F.size("one") + F.size("other") - shared) * F.lit(least)
    ).select("a", "b")


def near_duplicates(
    df: DataFrame,
    text: str = "text",
    identity: str = "doc_id",
    size: int = 5,
    similarity: tuple[int, int] = (80, 100),
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """All rows and columns, with n_shingles, component_id, kept and representative.

    Two texts are linked if their sets of ``size``-word shingles overlap by ``similarity`` (shared of
    all). ``component_id`` is the smallest id reachable over links; ``kept`` tells that it is the
    row's own; ``representative`` is one row of each component, also if ids repeat or are NULL.
    ``columns``: those that are returned, all if not given; what is not returned is not stored.

    Equal sets are one node from the start, so copies cost nothing further. Nodes share a bucket if
    a chunk of their signatures differs in one value at most: with 11 chunks this holds for
    every pair at signature distance 21 or less. In a first pass each bucket proposes a spanning
    forest of its close pairs, which are checked on the whole sets; what is linked becomes one
    component. The forests also tell the families of texts that are close at all. In a second pass
    all other close pairs of a family that lie in different components are checked, so that no link
    is lost; families that are one component are left out. Buckets and families are compared block
    by block, and never held as a whole; no pair but those that link leaves a task.

    A NULL or empty text, or one without words, has no shingles and is linked with nothing. Ids that
    are NULL are never the smallest; a component without any id has none. Columns of the names
    added are replaced. Repeated rows are copies. An empty table gives an empty table. ``df`` is read
    up to three times; store it if it is dear to compute.
    """
    added = ("n_shingles", "component_id", "kept", "representative")
    prepare_python(df.sparkSession)
    given = F.encode(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")), "UTF-8")
    returned = [c for c in (columns or df.columns) if c.lower() not in added]
    rows = keep(
        df.select(
            F.struct(*[F.col(f"`{c}`") for c in returned]).alias("row"),
            F.col(f"`{identity}`").alias("id"),
            F.xxhash64(*plain_columns(df)).alias("tie"),
            _fingerprints(size)(given).alias("made"),
        ).select("row", "id", "tie", "made.*")
    )
    nodes = keep(
        rows.filter("n > 0").groupBy(F.col("print").alias("node")).agg(
            F.min("id").alias("first"), F.count("*").alias("copies"),
            F.any_value("joined").alias("joined"), F.any_value("signature").alias("signature"),
        )
    )
    roots = _roots(nodes, _Texts(df, text, identity, size, nodes), similarity)
    named = nodes.join(roots, "node", "left").select("node", "first", "copies", "root")
    smallest = named.filter("root IS NOT NULL").groupBy("root").agg(F.min("first").alias("component"))
    # Only groups need a name; a row that is alone is its own.
    grouped = _few(
        named.filter("root IS NOT NULL").join(smallest, "root")
        .select("node", "component", "root")
        .unionByName(
            named.filter("root IS NULL AND copies > 1").select("node", F.col("first").alias("component"), F.col("node").alias("root"))
        ),
        "node",
    )
    joined = rows.select("row", "id", "tie", "n", "print").join(
        grouped, (F.col("print") == F.col("node")) & (F.col("n") > 0), "left"
    )
    component = F.when(F.col("root").isNull(), F.col("id")).otherwise(F.col("component"))
    out = joined.withColumn("component", component).withColumn("own", F.col("id").eqNullSafe(F.col("component")))
    # Ids should tell rows apart. Only where they don't, the rows that claim a component are ranked.
    claims = (
        rows.filter("n > 0").select("id", "print").join(grouped, F.col("print") == F.col("node"))
        .filter(F.col("id").eqNullSafe(F.col("component"))).groupBy("root").count().filter("count > 1")
    )
    if claims.limit(1).count():
        # Rows in no group, most of the table, have no root to be dealt by and stay where they are.
        order = Window.partitionBy("root").orderBy("tie", "print")
        claim = F.col("root").isNotNull() & F.col("own")
        ranked = out.filter(claim).withColumn("chosen", F.row_number().over(order) == 1)
        out = out.filter(~claim).withColumn("chosen", F.col("own")).unionByName(ranked)
    else:
        out = out.withColumn("chosen", F.col("own"))
    return out.select(
        "row.*", F.col("n").alias("n_shingles"), F.col("component").alias("component_id"),
        F.col("own").alias("kept"), F.col("chosen").alias("representative"),
    )


def _members(nodes: DataFrame) -> DataFrame:
    """key, node, signature, blocks: the nodes of each bucket that has several, and how many blocks
    the bucket is compared in."""
    # Few keys are shared, so entries travel as short as can be: the key, and a hash of the node.
    short = F.xxhash64("node")
    entries = nodes.select(F.explode(_keys()(F.col("joined"))).alias("key"), short.alias("short"))
    repeated = entries.groupBy("key").count().filter("count > 1").select("key")
    shared = keep(entries.join(repeated, "key", "left_semi"))
    buckets = shared.groupBy("key").agg(
        F.count("*").alias("size"), F.bit_xor("short").alias("who"),
        F.bit_xor(F.xxhash64("short", F.lit(1))).alias("who_else"),
    )
    # Copies share many buckets; of those with the same members one is enough.
    chosen = buckets.groupBy("size", "who", "who_else").agg(F.min("key").alias("key")).select("key", "size")
    return keep(
        shared.join(chosen, "key")
        .join(nodes.select("node", "signature", short.alias("short")), "short")
        .select("key", "node", "signature", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks"))
    )


def _tiled(rows: DataFrame, group: str) -> DataFrame:
    """Rows of a group, of ``blocks`` blocks, to all tiles of their block: every two rows of the
    group meet in one tile, whatever the size of the group."""
    block = F.pmod(F.xxhash64("node", F.lit("block")), F.col("blocks")).cast("int")
    placed = rows.withColumn("block", block).withColumn(
        "with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    ).withColumn("one", F.least("block", "with")).withColumn("other", F.greatest("block", "with"))
    return placed.repartition(group, "one", "other").sortWithinPartitions(group, "one", "other")


def _roots(nodes: DataFrame, texts: _Texts, similarity: tuple[int, int]) -> DataFrame:
    """node, root: for every node that is linked, the node that stands for its component."""
    columns = ["one", "other", "node", "root", "block", "signature"]
    members = _tiled(_members(nodes), "key").withColumn("root", F.col("node"))
    found = members.select("key", *columns).mapInArrow(_forest(None), "a binary, b binary")
    tried = keep(found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    roots = components(_exact(tried, texts, similarity))
    # All close pairs lie within the families that the forests span.
    families = components(tried).withColumnRenamed("root", "family").join(roots, "node", "left")
    families = keep(families.withColumn("root", F.coalesce("root", "node")))
    unsettled = families.groupBy("family").agg(
        F.ceil(F.count("*") / F.lit(BLOCK)).cast("int").alias("blocks"),
        F.min(F.xxhash64("root")).alias("least"), F.max(F.xxhash64("root")).alias("most"),
    ).filter("least <> most").select("family", "blocks")
    rest = keep(families.join(unsettled, "family"))
    if not rest.limit(1).count():
        return roots
    sets = texts.sets(rest.select("node"))
    second = rest.join(nodes.select("node", "signature"), "node").join(sets, "node")
    checked = _tiled(second, "family").select("family", *columns, "set").mapInArrow(
        _forest(similarity), "a binary, b binary"
    )
    # What the second pass links is components, so their roots are joined.
    linked = keep(checked.distinct())
    for end in ("a", "b"):
        of = roots.select(F.col("node").alias(end), F.col("root").alias(f"root_{end}"))
        linked = linked.join(of, end, "left").withColumn(f"root_{end}", F.coalesce(f"root_{end}", end))
    joined = components(linked.filter("root_a <> root_b"), "root_a", "root_b")
    higher = joined.select(F.col("node").alias("root"), F.col("root").alias("top"))
    lower = roots.join(higher, "root", "left").select("node", F.coalesce("top", "root").alias("root"))
    return keep(lower.unionByName(joined.join(roots, "node", "left_anti").select("node", "root")))
