"""Spelling variants: words one edit apart, found by asymmetric q-chunks, and the form they come from.

Of two words one edit apart, the shorter is cut into two chunks that do not overlap. One edit spoils one
of them at most, so that the other word has the second chunk as one of its positional grams: at the same
place, or moved by the difference in length, which is one at most. The part that is left over differs by
that edit again, and is cut into two chunks in the same way, one of which stays. So the words share three
quarters of their letters at known places, and these make up the key of the join. What meets there is
verified. Words play both parts: chunks of their own length, grams for words as long or one shorter.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dealtide.llm.chunks import stored
from dealtide.llm.tables import keep, prepare_python

_LETTERS = re.compile("[A-Za-zÀ-ÿ]+")
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def words_of(text: str | None) -> list[str]:
    """Runs of Latin letters, A-Z in lower case."""
    return _LETTERS.findall((text or "").encode().translate(_LOWER).decode())


def misspelt(word: str, seed: int, every: int) -> str:
    """``word``, or without one letter if its checksum after ``seed`` is divisible by ``every``."""
    mark = zlib.crc32(word.encode(), seed)
    if mark % every:
        return word
    place = mark % len(word)
    return word[:place] + word[place + 1 :]


def count_words(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", every: int | None = None) -> DataFrame:
    """word, n: how often each word occurs in all texts, NULL ones having none.

    ``every``: spoil about one of so many words first, as a checksum of id and word says (a NULL id counts as
    an empty one). Words are counted batch by batch (16 MB of text), and the counts are summed up.
    """
    prepare_python(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total: Counter[str] = Counter()
            for row_id, text in zip(batch.column("id").to_pylist(), batch.column("text")):
                words = words_of(text.as_py())
                if every is None:
                    total.update(words)
                    continue
                seed = zlib.crc32(f"{'' if row_id is None else row_id}:".encode())
                for word, n in Counter(words).items():
                    total[misspelt(word, seed, every)] += n
            yield pa.RecordBatch.from_arrays(
                [pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], names=["word", "n"]
            )

    given = docs.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text_column}`").alias("text"))
    counted = given.mapInArrow(run, "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def _half(length: Column) -> Column:
    return F.floor((length + 1) / 2).cast("int")


def _head(word: Column, length: Column) -> Column:
    return F.substring(word, F.lit(1), length)


def _tail(word: Column, length: Column) -> Column:
    return F.when(length > 0, F.right(word, length)).otherwise("")


def _keys(word: Column, length: Column) -> list[Column]:
    """Keys of ``word`` as, or towards, a word of ``length`` letters: one half and half of the other half."""
    half = _half(length)
    own = F.char_length(word)
    out = []
    for name, intact, rest, size in (
        ("head", _head(word, half), F.substring(word, half + 1, own), length - half),
        ("tail", _tail(word, length - half), _head(word, own - length + half), half),
    ):
        out.append(F.xxhash64(length, F.lit(f"{name} head"), intact, _head(rest, _half(size))))
        out.append(F.xxhash64(length, F.lit(f"{name} tail"), intact, _tail(rest, size - _half(size))))
    return out


def near_words(words: DataFrame) -> DataFrame:
    """a, a_n, b, b_n: all ordered pairs of different words one edit apart, each once.

    ``words``: word (each once), n. An edit inserts, deletes or replaces one code point.
    """
    word, length = F.col("word"), F.char_length("word")
    chunks = words.select(F.col("word").alias("a"), F.col("n").alias("a_n"), F.explode(F.array(*_keys(word, length))).alias("key"))
    grams = words.select(
        F.col("word").alias("b"), F.col("n").alias("b_n"),
        F.explode(F.array(*_keys(word, length), *_keys(word, length - 1))).alias("key"),
    )
    # Stored, so that a join of large sides comes straight from a shuffle and AQE can split a hot key.
    met = keep(chunks).join(keep(grams), "key")
    same = F.char_length("a") == F.char_length("b")
    met = met.filter(F.when(same, F.col("a") < F.col("b")).otherwise(F.char_length("a") < F.char_length("b")))
    pairs = keep(met.filter(F.levenshtein("a", "b", 1) == 1).select("a", "a_n", "b", "b_n").distinct())
    turned = pairs.select(F.col("b").alias("a"), F.col("b_n").alias("a_n"), F.col("a").alias("b"), F.col("a_n").alias("b_n"))
    return pairs.unionByName(turned)


def _roots(forms: DataFrame) -> DataFrame:
    """word, root: where the forms lead to. Each round doubles the steps; a form is several times as
    frequent as its word, so there are few."""
    roots = keep(forms.select("word", F.col("form").alias("root")))
    while True:
        onward = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = stored(
            roots.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")),
            F.count_if("moved").alias("moved"),
        )
        roots = step.table.select("word", "root")
        if not step.measured["moved"]:
            return roots


def group_variants(words: DataFrame, ratio: int = 5) -> DataFrame:
    """word, n and: form, root, n_near, form_n.

    ``words``: word (each once), n. Near words are one edit apart. The form of a word is its most frequent near
    word (the smallest of equal ones, by code point) if that is at least ``ratio`` times as frequent, else
    NULL. The root is where forms lead to, the word itself without a form.

    NULL words have no near words and are left out of the result with words that have no count; empty words
    count like others. An empty table gives an empty table.
    """
    words = keep(words.select("word", F.col("n").cast("long").alias("n")).filter("word IS NOT NULL AND n IS NOT NULL"))
    best = near_words(words).groupBy(F.col("a").alias("word")).agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("b_n")).alias("least"), F.col("b").alias("form"))).alias("best")
    )
    best = keep(words.join(best, "word").select(
        "word", "n_near",
        F.when(-F.col("best.least") >= ratio * F.col("n"), F.col("best.form")).alias("form"),
        F.when(-F.col("best.least") >= ratio * F.col("n"), -F.col("best.least")).alias("form_n"),
    ))
    roots = _roots(best.filter("form IS NOT NULL").select("word", "form"))
    return words.join(best, "word", "left").join(roots, "word", "left").select(
        "word", "n", "form", F.coalesce("root", "word").alias("root"), F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n"
    )
