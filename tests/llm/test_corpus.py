"""Repeated passages, collocations and spelling variants against brute force on made-up texts."""

import random
from collections import Counter

import numpy as np
import pytest

from dealtide.llm import chunks, phrases, repeats, variants
from dealtide.llm.phrases import MisraGries


def _left_over(rows, size):
    """Every run of words looked up in a table of all runs."""
    least, out = {}, []
    for doc, words in rows:
        for k in range(len(words) - size + 1):
            run = tuple(words[k : k + size])
            least[run] = min(least.get(run, doc), doc)
    for doc, words in rows:
        gone = set()
        for k in range(len(words) - size + 1):
            if least[tuple(words[k : k + size])] < doc:
                gone |= set(range(k, k + size))
        out.append((doc, len(words), len(gone), " ".join(w for k, w in enumerate(words) if k not in gone)))
    return sorted(out)


@pytest.mark.parametrize("size", [2, 5, 13])
def test_repeats_against_all_runs(spark, size):
    """Passages of all lengths about the limit, at all offsets against the blocks, inside each other and repeated
    within one document; few different words, so that short runs repeat by chance."""
    rng = random.Random(size)
    pool = [[f"w{rng.randrange(40)}" for _ in range(rng.randrange(size - 1, 3 * size))] for _ in range(12)]
    rows = []
    for doc in range(300):
        words = []
        for _ in range(rng.randrange(5)):
            words += [f"w{rng.randrange(5 if doc % 10 == 0 else 400)}" for _ in range(rng.randrange(8))]
            part = rng.choice(pool)
            words += part[rng.randrange(3) : len(part) - rng.randrange(3)]
        rows.append((rng.randrange(10**6), words))
    df = spark.createDataFrame([(d, "\t ".join(w)) for d, w in rows], "doc_id long, text string").repartition(5)
    found = repeats.remove_repeats(df, size=size).select("doc_id", "repeats.*").collect()
    expected = _left_over(rows, size)
    assert sorted(tuple(r) for r in found) == expected
    assert sum(x[2] for x in expected) > 100


def test_a_passage_of_a_third_of_the_documents(spark):
    """Each chunk asks once for each of its windows, however many of its documents hold it."""
    passage = [f"p{k}" for k in range(30)]
    rows = [(d, [f"a{d}x{k}" for k in range(d % 9)] + (passage if d % 3 else []) + [f"b{d}x{k}" for k in range(9)]) for d in range(3000)]
    df = spark.createDataFrame([(d, " ".join(w)) for d, w in rows], "doc_id long, text string").repartition(3)
    found = repeats.remove_repeats(df).select("doc_id", "repeats.*").collect()
    assert sorted(tuple(r) for r in found) == _left_over(rows, 13)
    dealt = chunks.deal(df.selectExpr("doc_id AS id", "text"), "text")
    asked = chunks.ask(dealt.table, repeats._probes(7, 64)).collect()
    windows = {tuple(w[k : k + 7]) for _, w in rows for k in range(len(w) - 6)}
    assert sum(len(r["body"]) // 4 for r in asked) <= len(windows) + 24 * len({r["chunk"] for r in asked})


def test_summaries_lose_no_frequent_key():
    rng = np.random.default_rng(5)
    keys = np.concatenate([rng.zipf(1.3, 60_000) % 5000, np.repeat(np.arange(6000, 6020), 150)]).astype(np.uint32)
    rng.shuffle(keys)
    true = Counter(keys.tolist())
    for room in (1, 8):
        summary = MisraGries(room * (len(keys) // 100 + 1))
        for part in np.array_split(keys, 17):
            own, counts = np.unique(part, return_counts=True)
            summary.merge(own, counts)
        assert summary.error < 100 / room and len(summary.keys) <= summary.capacity
        assert {k for k, n in true.items() if n >= 100} <= set(summary.survivors(100).tolist())
        held = dict(zip(summary.keys.tolist(), summary.counts.tolist()))
        assert all(0 <= n - held.get(k, 0) <= summary.error for k, n in true.items())


def test_counts_above_a_byte_are_packed():
    slots, counts = np.array([0, 7, 70_000, (1 << 24) - 1]), np.array([1, 255, 256, 100_000])
    found = Counter()
    for slot, n in zip(*phrases._unpack(phrases._pack(slots, counts))):
        found[int(slot)] += int(n)
    assert found == dict(zip(slots.tolist(), counts.tolist()))


def _collocations(rows, threshold, longest):
    counts, totals = Counter(), Counter()
    for lang, pieces in rows:
        for words in pieces:
            totals[lang] += len(words)
            for size in range(1, longest + 1):
                counts.update((lang, tuple(words[k : k + size])) for k in range(len(words) - size + 1))
    frequent = {k: n for k, n in counts.items() if n >= threshold and len(k[1]) > 1}
    found = {}
    for (lang, words), a in frequent.items():
        if any(words == w[k : k + len(words)] for (x, w), n in frequent.items()
               if x == lang and n == a and len(w) > len(words) for k in range(len(w) - len(words) + 1)):
            continue
        score, _, left, right = min(
            (1000 * a * totals[lang] // (counts[lang, words[:k]] * counts[lang, words[k:]]), k, counts[lang, words[:k]], counts[lang, words[k:]])
            for k in range(1, len(words))
        )
        found[lang, " ".join(words)] = (a, left, right, totals[lang], score)
    return found


def test_collocations_against_all_counts(spark, monkeypatch):
    """Small partitions, so that summaries lose counters."""
    monkeypatch.setattr(phrases, "ROOM", 1)
    monkeypatch.setattr(chunks, "LEAST_PARTITIONS", 2)
    rng = random.Random(2)
    fixed = [[f"f{rng.randrange(30)}" for _ in range(rng.randrange(2, 7))] for _ in range(10)]
    rows = []
    for n in range(600):
        pieces = [[*[f"w{int(rng.expovariate(0.1))}" for _ in range(rng.randrange(6))], *rng.choice(fixed)] for _ in range(4)]
        rows.append((("aa", "bb", None)[n % 7 % 3], pieces))
    df = spark.createDataFrame([("; ".join("  ".join(p).upper() for p in ps) + "\n", lang) for lang, ps in rows], "text string, lang string")
    found = {(r["lang"], r["phrase"]): tuple(r)[3:] for r in phrases.collocations(df.repartition(4), 20, 5, 10_000).collect()}
    expected = _collocations([(lang or "und", ps) for lang, ps in rows], 20, 5)
    assert found == expected and len(expected) > 30
    # Ranked in parts: the first two of each language.
    few = {(r["lang"], r["rank"]): r["phrase"] for r in phrases.collocations(df, 20, 5, 2).collect()}
    for lang in ("aa", "bb", "und"):
        line = sorted((-v[4], -v[0], p.encode(), p) for (x, p), v in expected.items() if x == lang)
        assert [few[lang, rank] for rank in (1, 2)] == [x[3] for x in line[:2]] and (lang, 3) not in few


def test_scores_beyond_64_bits(spark, monkeypatch):
    n = 4 * 10**12
    counted = [("xx", 0, "", n), ("xx", 1, "a", n // 2), ("xx", 1, "b", n // 2 - 1), ("xx", 2, "a b", n // 2 - 1)]
    table = spark.createDataFrame(counted, "lang string, size int, phrase string, n long")
    monkeypatch.setattr(phrases, "frequent_phrases", lambda *_: table)
    row = phrases.collocations(table).first()
    assert row["score"] == 1000 * (n // 2 - 1) * n // ((n // 2) * (n // 2 - 1)) == 2000


def _one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def test_near_words_against_all_pairs(spark):
    rng = random.Random(4)
    words = set()
    for _ in range(60):
        word = "".join(rng.choice("abcdé") for _ in range(rng.randrange(1, 14)))
        words.add(word)
        for _ in range(5):
            line = list(word)
            for _ in range(rng.randrange(1, 3)):
                at = rng.randrange(len(line) + 1)
                line[at : at + rng.randrange(2)] = rng.choice(["", "a", "é", "x"])
            words.add("".join(line))
    counts = {w: rng.choice((5, 6, 30, 200, 5000)) for w in sorted(words)}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    near = {w: {v for v in counts if _one_edit(w, v)} for w in counts}
    pairs = [(r["a"], r["b"]) for r in variants.near_words(df).collect()]
    assert len(pairs) == len(set(pairs)) and set(pairs) == {(a, b) for a in near for b in near[a]}
    form = {}
    for w in counts:
        best = min(near[w], key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 5 * counts[w] else None

    def root(w):
        return root(form[w]) if form[w] is not None else w

    rows = {r["word"]: (r["n"], r["form"], r["root"], r["n_near"], r["form_n"]) for r in variants.group_variants(df).collect()}
    assert rows == {w: (counts[w], form[w], root(w), len(near[w]), form[w] is not None and counts[form[w]] or None) for w in counts}
    assert any(f is not None and form[f] is not None for f in form.values())


def test_nothing_in_the_join_of_variants_is_a_cross_join(spark):
    df = spark.createDataFrame([("abcdef", 5), ("abcdeg", 50)], "word string, n long")
    plan = variants.near_words(df)._jdf.queryExecution().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan
