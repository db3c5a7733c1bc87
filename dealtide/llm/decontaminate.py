"""Benchmark decontamination: CGK embedding, bit-sampling LSH over item-sized windows, exact check.

The embedding walks over a text with coins that depend on the step and the word: each step writes
the word it stands on, and moves on if the coin of that word says so. Two texts that differ by a
few insertions, deletions and replacements fall into step again after each, so a small edit distance
becomes a small Hamming distance, and texts that agree in some sampled steps are candidates.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dealtide.llm.tables import keep, prepare_python

#: Edits that a passage may show, as a share of the item's words.
EDITS = 0.2
#: Probability to find a passage with as many edits as that, and repetitions to reach it, at most.
RECALL, REPETITIONS = 0.95, 24
#: Items of fewer words are too short for edits to tell: they are found unchanged only.
SHORTEST = 8
#: Windows grow by this factor from size class to size class.
CLASS_STEP = 1.5
#: Bytes of items that are looked for in one pass over the texts.
PASS_BYTES = 32 * 1024 * 1024
SEED = 20_240_229

# A-Z to lower case; every ASCII character that is no letter or digit to a space.
_WORDS = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)
_U = np.uint64
UNKNOWN, PAD = 0, 1
# Letters of scripts without spaces between words (Thai, Lao, Myanmar, Khmer, kana, Han) are words each.
_UNSPACED = re.compile(
    "[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff"
    "\uff66-\uff9f\U0001b000-\U0001b16f\U00020000-\U000323af]"
)
# The first bytes of those in UTF-8: a text without any is not decoded.
_MAY_HOLD = re.compile(rb"[\xe0\xe1\xe3-\xe9\xef\xf0]")


def words(text: str | bytes | None) -> list[bytes]:
    raw = text.encode("utf-8", "surrogatepass") if isinstance(text, str) else text or b""
    if _MAY_HOLD.search(raw):
        spaced = _UNSPACED.sub(r" \g<0> ", raw.decode("utf-8", "replace"))
        spaced = re.sub("[\u3000-\u3004\u3008-\u3020\u3030\uff01-\uff0f\uff1a-\uff20\uff3b-\uff40\uff5b-\uff65]", " ", spaced)
        raw = spaced.encode("utf-8", "surrogatepass")
    return raw.translate(_WORDS).split()


def _random(n: int, seed: int) -> np.ndarray:
    return np.random.default_rng([SEED, seed]).integers(0, 2**64, n, dtype=_U)


@dataclass(frozen=True)
class Sampling:
    """One repetition: the steps whose words are compared, and the coins and hashes of the words."""

    steps: tuple[int, ...]
    coins: np.ndarray  # step, word
    hashes: np.ndarray  # sampled step, word

    def embed(self, tokens: np.ndarray, starts: np.ndarray, window: int) -> np.ndarray:
        """The hash of the sampled steps of the walk over the window at each start."""
        at, end, out = starts.copy(), starts + window, np.zeros(len(starts), _U)
        sampled = {step: n for n, step in enumerate(self.steps)}
        for step in range(self.steps[-1] + 1):
            word = np.where(at < end, tokens[at], PAD)
            if step in sampled:
                out += self.hashes[sampled[step], word]
            at += self.coins[step, word]
        return out


@dataclass(frozen=True)
class SizeClass:
    """Items of about the same length. Their first ``window`` words are embedded."""

    window: int
    edits: int
    items: tuple[int, ...]
    samplings: tuple[Sampling, ...]
    keys: tuple[np.ndarray, ...]  # by repetition: sorted hashes of the items
    owners: tuple[np.ndarray, ...]  # by repetition: the items, in that order


def _edited(item: np.ndarray, edits: int, size: int, random: np.random.Generator) -> np.ndarray:
    """An item with so many random edits, with words of its own vocabulary or unknown ones."""
    out = list(item)
    for _ in range(edits):
        kind, at = random.integers(3), int(random.integers(len(out)))
        word = UNKNOWN if random.random() < 0.5 else int(random.integers(2, size))
        if kind == 0:
            out[at] = word
        elif kind == 1:
            out.insert(at, word)
        elif len(out) > 1:
            out.pop(at)
    return np.array(out, np.int64)


def _sampling(size: int, window: int, bits: int, seed: int) -> Sampling:
    random = np.random.default_rng([SEED, window, bits, seed])
    # The first steps stand before most edits, and the walk is past the window after two times that.
    steps = tuple(sorted(int(s) for s in random.choice(window, bits, replace=False)))
    coins = random.integers(0, 2, (steps[-1] + 1, size)).astype(np.int64)
    coins[:, PAD] = 1
    hashes = random.integers(0, 2**64, (bits, size), dtype=_U)
    hashes[:, UNKNOWN] = random.integers(0, 2**64, bits, dtype=_U)  # no item holds an unknown word
    return Sampling(steps, coins, hashes)


def _laid_out(items: Sequence[np.ndarray], window: int) -> tuple[np.ndarray, np.ndarray]:
    """Texts one after the other, with room behind each, and their starts."""
    line = np.concatenate([np.concatenate([item, np.full(window, PAD)]) for item in items])
    return line, np.cumsum([0, *[len(item) + window for item in items[:-1]]])


def _repetitions(items: Sequence[np.ndarray], edits: float, size: int, window: int, bits: int, recall: float) -> int | None:
    """How many repetitions find the share ``recall`` of randomly edited items; None: too many."""
    random = np.random.default_rng([SEED, window])
    chosen = [items[i] for i in random.integers(0, len(items), 400)]
    edited = [_edited(item, math.floor(edits * len(item)), size, random) for item in chosen]
    one, two = _laid_out(chosen, window), _laid_out(edited, window)
    found = np.zeros(len(chosen), bool)
    for n in range(REPETITIONS):
        sampling = _sampling(size, window, bits, n)
        found |= sampling.embed(*one, window) == sampling.embed(*two, window)
        if found.mean() >= recall:
            return n + 1
    return None


class Index:
    """What is looked for: the words of the items, and their embeddings by size class."""

    def __init__(self, items: Sequence[tuple[int, str]], edits: float = EDITS, recall: float = RECALL, shortest: int = SHORTEST):
        given = [(item_id, words(text)) for item_id, text in items]
        self.edits = edits
        self.ids = [item_id for item_id, w in given if len(w) >= shortest]
        texts = [w for _, w in given if len(w) >= shortest]
        few = [(item_id, w) for item_id, w in given if 0 < len(w) < shortest]
        self.vocabulary = {w: n for n, w in enumerate(sorted({w for text in [*texts, *[w for _, w in few]] for w in text}), 2)}
        self.size = len(self.vocabulary) + 2
        self.items = [np.array([self.vocabulary[w] for w in text], np.int64) for text in texts]
        # By number of words: the items of so few, by their words.
        self.runs: dict[int, dict[tuple[int, ...], list[int]]] = defaultdict(dict)
        for item_id, w in few:
            self.runs[len(w)].setdefault(tuple(self.vocabulary[x] for x in w), []).append(item_id)
        # By number of words: the sorted hashes of those, to leave out other runs at once.
        self.factors = _random(shortest, 1)
        self.run_hashes = {n: np.unique([self._hashed(np.array(run, _U)) for run in runs]) for n, runs in self.runs.items()}
        self.classes: list[SizeClass] = []
        by_window = defaultdict(list)
        for n, item in enumerate(self.items):
            step = math.floor(math.log(len(item) / shortest, CLASS_STEP) + 1e-9)
            by_window[math.ceil(shortest * CLASS_STEP**step)].append(n)
        for window, members in sorted(by_window.items()):
            members = [(n, min(window, len(self.items[n]))) for n in members]
            window = min(w for _, w in members)
            self.classes.append(self._class(window, [n for n, _ in members], recall))
        self.has = np.zeros((len(self.items), self.size), bool)
        for n, item in enumerate(self.items):
            self.has[n, item] = True

    def _class(self, window: int, members: list[int], recall: float) -> SizeClass:
        items = [self.items[n] for n in members]
        # As many bits as the repetitions allow: the more, the fewer candidates are false.
        for bits in (2, 1):
            repetitions = _repetitions(items, self.edits, self.size, window, bits, recall)
            if repetitions:
                break
        repetitions = repetitions or REPETITIONS
        samplings, keys, owners = [], [], []
        line, starts = _laid_out(items, window)
        for seed in range(repetitions):
            sampling = _sampling(self.size, window, bits, seed)
            hashes = sampling.embed(line, starts, window)
            order = np.argsort(hashes, kind="stable")
            samplings.append(sampling)
            keys.append(hashes[order])
            owners.append(np.array(members)[order])
        most = max(math.floor(self.edits * len(item)) for item in items)
        return SizeClass(window, most, tuple(members), tuple(samplings), tuple(keys), tuple(owners))

    def _hashed(self, tokens: np.ndarray, size: int = 0) -> np.ndarray:
        """The hash of each run of ``size`` words; of all words, if 0."""
        size = size or len(tokens)
        out = np.zeros(len(tokens) - size + 1, _U)
        for k in range(size):
            out += (tokens[k : k + len(out)].astype(_U) + _U(1)) * self.factors[k]
        return out

    def exact(self, tokens: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """Start, number of words and id: the runs of words that are a short item, unchanged. Of
        occurrences of one item that overlap, the first."""
        free: dict[int, int] = {}
        for size, runs in sorted(self.runs.items()):
            if len(tokens) < size:
                continue
            for at in np.flatnonzero(np.isin(self._hashed(tokens, size), self.run_hashes[size])).tolist():
                for item_id in runs.get(tuple(tokens[at : at + size].tolist()), ()):
                    if at >= free.get(item_id, 0):
                        free[item_id] = at + size
                        yield at, size, item_id

    def candidates(self, tokens: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Starts and items that agree in the sampled steps of a repetition.

        A passage has at most ``edits`` words that are not the item's, so windows with more words
        that no item has are left out before, and candidates with more that theirs has not, after.
        """
        known = np.concatenate([[0], np.cumsum(tokens > PAD)])
        for of in self.classes:
            if len(tokens) < of.window:
                continue
            inside = known[of.window :] - known[: -of.window]
            starts = np.flatnonzero(inside >= of.window - of.edits)
            for sampling, keys, owners in zip(of.samplings, of.keys, of.owners, strict=True):
                if not len(starts):
                    break
                hashes = sampling.embed(tokens, starts, of.window)
                first, last = np.searchsorted(keys, hashes), np.searchsorted(keys, hashes, "right")
                hit = np.flatnonzero(last > first)
                if not len(hit):
                    continue
                times = (last - first)[hit]
                where = np.repeat(starts[hit], times)
                begin = np.repeat(first[hit] - np.concatenate([[0], np.cumsum(times)[:-1]]), times)
                which = owners[begin + np.arange(len(where))]
                for at in range(0, len(where), 100_000):
                    some, items = where[at : at + 100_000], which[at : at + 100_000]
                    shared = np.zeros(len(some), np.int64)
                    for k in range(of.window):
                        shared += self.has[items, tokens[some + k]]
                    fits = shared >= of.window - of.edits
                    yield some[fits], items[fits]

    def leaks(self, texts: Sequence[bytes | None]) -> list[list[dict]]:
        """For each text: the passages within the allowed edit distance of an item."""
        out: list[list[dict]] = [[] for _ in texts]
        if not self.items and not self.runs:
            return out
        longest = max([len(item) for item in self.items], default=0) + 1
        gap = np.full(2 * longest, PAD, np.int64)
        parts, starts = [], []
        length = 0
        for text in texts:
            own = words(text)
            starts.append(length)
            parts += [np.fromiter(map(self.vocabulary.get, own, repeat(UNKNOWN)), np.int64, len(own)), gap]
            length += len(own) + len(gap)
        if not parts:
            return out
        tokens, firsts = np.concatenate(parts), np.array(starts)
        for at, size, item_id in self.exact(tokens):
            text = int(np.searchsorted(firsts, at, "right")) - 1
            out[text].append({"item_id": item_id, "start": at - starts[text], "words": size, "distance": 0})
        found = [np.stack(c) for c in self.candidates(tokens)]
        if not found:
            return out
        where, items = np.unique(np.concatenate(found, axis=1)[::-1], axis=1)[::-1]
        of = np.searchsorted(firsts, where, "right") - 1
        order = np.lexsort((where, items, of))
        run: list[int] = []
        for n in [*order.tolist(), -1]:
            item = int(items[run[0]]) if run else -1
            if run and (n < 0 or of[n] != of[run[0]] or items[n] != item or where[n] - where[run[-1]] > len(self.items[item])):
                text, end = int(of[run[0]]), starts[int(of[run[0]]) + 1] if int(of[run[0]]) + 1 < len(starts) else length
                out[text] += self._checked(tokens, starts[text], end - len(gap), int(where[run[0]]), int(where[run[-1]]), item)
                run = []
            if n >= 0:
                run.append(n)
        return out

    def _checked(self, tokens: np.ndarray, begin: int, end: int, first: int, last: int, item: int) -> Iterator[dict]:
        """The best passages of the item that start about between ``first`` and ``last``."""
        wanted = self.items[item].tolist()
        most = math.floor(self.edits * len(wanted))
        lowest = max(begin, first - most)
        highest = min(end, last + len(wanted) + most)
        line = tokens[lowest:highest].tolist()
        ends = sorted((d, e) for e, d in enumerate(distances(wanted, line)) if d <= most)
        taken: list[tuple[int, int]] = []
        for distance, stop in ends:
            back = distances(wanted[::-1], line[max(0, stop + 1 - len(wanted) - most) : stop + 1][::-1], anchored=True)
            start = stop - min(range(len(back)), key=lambda k: (back[k], k))
            if all(stop < a or b < start for a, b in taken):
                taken.append((start, stop))
                yield {
                    "item_id": self.ids[item], "start": lowest + start - begin,
                    "words": stop + 1 - start, "distance": distance,
                }


def distances(wanted: list[int], line: list[int], anchored: bool = False) -> list[int]:
    """Edit distance of ``wanted`` to the closest run of ``line`` that ends at each word.

    ``anchored``: to the run that starts at the first word. Myers' bit-vector method: the columns of
    the table of distances as bits of two integers.
    """
    size = len(wanted)
    masks: dict[int, int] = {}
    for n, word in enumerate(wanted):
        masks[word] = masks.get(word, 0) | 1 << n
    every, top = (1 << size) - 1, 1 << (size - 1)
    up, down, distance, out = every, 0, size, []
    for word in line:
        equal = masks.get(word, 0)
        diagonal = ((((equal & up) + up) ^ up) | equal | down) & every
        higher, lower = (down | ~(diagonal | up)) & every, up & diagonal
        distance += bool(higher & top) - bool(lower & top)
        higher = (higher << 1 | anchored) & every
        lower = (lower << 1) & every
        up, down = (lower | ~(diagonal | higher)) & every, higher & diagonal
        out.append(distance)
    return out


_LEAK = "struct<item_id:bigint,start:bigint,words:bigint,distance:bigint>"
_ARROW = pa.list_(pa.struct([(n, pa.int64()) for n in ("item_id", "start", "words", "distance")]))


def _search(shared: Broadcast):
    @F.arrow_udf(f"array<{_LEAK}>")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array(shared.value.leaks([t.as_py() for t in texts]), _ARROW)

    return run


def find_leaks(
    df: DataFrame,
    items: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    name: str = "leaks",
    edits: float = EDITS,
    recall: float = RECALL,
    pass_bytes: int = PASS_BYTES,
) -> DataFrame:
    """All rows and columns, and ``name``: an array of item_id, start, words and distance.

    A leak is a passage at most ``edits`` (share of the item's words) edits of words away from an
    item: words are runs of letters and digits, A-Z in lower case; in scripts without spaces, each
    letter is a word. Whole texts are searched; of
    passages of one item that overlap, the closest is given. A passage with as many edits as allowed
    is found with probability ``recall``, one with fewer more surely, an unchanged one always.

    Items with fewer than ``SHORTEST`` words are found where all their words stand unchanged; items
    without any word, text or id are not looked for. The items are
    broadcast; of more than ``pass_bytes``, as many as that in one pass, and the texts are read once
    for each pass. Equal items are found each. A NULL or empty text has no leaks. A column of the
    name is replaced; repeated rows have the same leaks, and an empty table gives an empty table.
    """
    spark = df.sparkSession
    prepare_python(spark)
    wanted = keep(
        items.select(F.col(f"`{item_id}`").cast("bigint").alias("id"), F.col(f"`{item_text}`").cast("string").alias("text"))
        .filter("id IS NOT NULL AND text IS NOT NULL")
    )
    size = wanted.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    passes = max(1, -(-size // pass_bytes))
    out = df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() != name.lower()], F.lit(None).cast(f"array<{_LEAK}>").alias(name))
    given = F.encode(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")), "UTF-8")
    found = []
    for n in range(passes):
        part = wanted.filter(F.pmod(F.xxhash64("id", "text"), F.lit(passes)) == n) if passes > 1 else wanted
        rows = sorted((r["id"], r["text"]) for r in part.collect())
        found.append(_search(spark.sparkContext.broadcast(Index(rows, edits, recall)))(given))
    return out.withColumn(name, F.concat(*found))
