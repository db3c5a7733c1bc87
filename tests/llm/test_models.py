"""The grammar, the language models and the search, each against a plain version."""

import os
import random
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from dealtide.llm import chat, langid, toxicity, topk, urls
from dealtide.llm.licenses import suppress

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
LEXICON = toxicity.Lexicon({"idiot": 4.0, "moron": 4.0}, {"vequ": 4.0})


@pytest.mark.parametrize(
    "text, weight",
    [
        ("an idiot.", 4.0),
        ("you idiot.", 4.0 * toxicity.AIMED),
        ("you are, I think, a real idiot", 4.0),  # too far from the target
        ("not an idiot", 4.0 * toxicity.NEGATED),
        ("not now, not then. idiot", 4.0),
        ("she said idiot", 4.0 * toxicity.REPORTED * toxicity.AIMED),
        ("she said he is not an idiot", 4.0 * toxicity.REPORTED * toxicity.NEGATED * toxicity.AIMED),
        ("idiot moron; vequilla", 12.0),
        ("videotape, unvequ", 0.0),
        ("they kill", 1.5),
        ("", 0.0),
    ],
)
def test_grammar(text, weight):
    assert sum(w for _, w in LEXICON.clauses(text)) == pytest.approx(weight)


@pytest.mark.parametrize(
    "text, toxic",
    [
        ("I will kill you", True), ("we are gonna stab all of them", True), ("kill them all!", True), ("go kill yourself", True),
        ("they should all be hanged", True), ("you will be shot", True), ("I\u2019ll burn you", True), ("killing you slowly", True),
        ("you piece of shit", True), ("they are a waste of space", True),
        ("I will not kill you", False), ("he said he will kill you", False), ("they kill time", False), ("he was killed", False),
        ("hang them on the wall", False), ("it may hurt you", False), ("a waste of time", False), ("the candles will burn", False),
    ],
)
def test_threats_and_phrases(text, toxic):
    assert (LEXICON.score(text)[0] >= 0.7) == toxic


@pytest.mark.parametrize(
    "text, toxic",
    [
        ("the pig slept", False), ("an ugly wall", False), ("garbage collection", False), ("the ugly pig ate trash in the garbage", False),
        ("burn the wood. hang the coat. it may hurt. shoot the film. " * 50, False), ("an ugly wall. the pig slept. " * 50, False),
        ("you are an ugly pig", True), ("you filthy pig", True), ("they're vermin", True), ("losers like you", True),
    ],
)
def test_lone_words_do_not_decide(text, toxic):
    lexicon = toxicity.Lexicon(dict(toxicity.INSULTS), {})
    assert (lexicon.score(text)[0] >= 0.7) == toxic


def _side_by_side(classes):
    """Each machine of the grammar alone, one after the other: factors that soften and aim, and patterns."""
    out = [[1.0, 1.0, set()] for _ in classes]
    for column, machines in ((0, toxicity.SOFTER), (1, toxicity.AIMING)):
        for machine in machines:
            for n, factor in enumerate(machine.run(classes)):
                out[n][column] *= factor
    for number, (_, matcher, _) in enumerate(toxicity.MATCHERS):
        for n in matcher.run(classes):
            out[n][2].add(number)
    return [tuple(o) for o in out]


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not there")
def test_the_composed_machine_agrees_with_its_parts(spark):
    """On drawn sequences of classes, and on all clauses of all test texts."""
    draw = random.Random(2)
    given = [draw.choices(toxicity.CLASSES, k=draw.randint(0, 12)) for _ in range(3000)]
    texts = [r["text"] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("text").collect()]
    lexicon = toxicity.Lexicon(dict(toxicity.INSULTS), {"wort": 3.0})
    for text in texts:
        given += [[c for c, _ in lexicon.read(clause)] for clause in re.split(r"[.!?;:\n]", (text or "").lower())]
    assert len(given) > 4000
    for classes in given:
        assert toxicity.MACHINE.run(classes) == _side_by_side(classes)


@pytest.mark.parametrize(
    "text, pattern", [("you idiot", "insult"), ("an idiot", "bare"), ("I will kill you", "threat"), ("they kill", ""), ("", "")],
)
def test_patterns(text, pattern):
    assert LEXICON.score(text)[2] == pattern


def test_insults_without_a_target_count_as_the_labels_say(spark):
    """What stands in toxic and clean texts alike decides nothing; what only toxic texts hold does."""
    rows = [(f"a wall of trash {n}", 1) for n in range(30)] + [(f"a tale {n}", 0) for n in range(900)]
    marked = toxicity.learn(spark.createDataFrame(rows, "text string, label int"))
    assert marked.bare > 0.8 and marked.score("some trash")[0] >= 0.7
    unmarked = toxicity.replace(marked, bare=0.0)
    assert unmarked.score("some trash")[0] < 0.7 <= unmarked.score("you trash")[0]


def test_weights_come_from_the_labels(spark):
    rows = [(f"a wall of trash {n}", 1) for n in range(30)] + [(f"they kill weeds {n}", 1) for n in range(30)]
    rows += [(f"the garbage man {n}", 0) for n in range(60)] + [(f"blargish {n}", 1) for n in range(2)]
    rows += [(f"a tale {n}", 0) for n in range(900)]
    lexicon = toxicity.learn(spark.createDataFrame(rows, "text string, label int"))
    assert lexicon.words["trash"] > 3 and lexicon.words["garbage"] == 0.5 and lexicon.words["pig"] == toxicity.INSULTS["pig"]
    assert lexicon.threats["kill"] > 3 and lexicon.threats["stab"] == toxicity.THREATS["stab"]


def test_words_are_learned(spark):
    rows = [(f"{'blarg' if n % 2 else 'snurfling'} the end {n}", 1) for n in range(20)]
    rows += [(f"the end of a story {n}", 0) for n in range(20)] + [("blar", 0)]
    lexicon = toxicity.learn(spark.createDataFrame(rows, "text string, label int"))
    assert lexicon.weight("blarg") and lexicon.weight("snurfling") and not lexicon.weight("blar")
    assert not lexicon.weight("story") and not lexicon.weight("end")


def _plain_log_p(counts, gram):
    """Interpolated Kneser-Ney by its definition, on texts of symbols."""
    if not gram:
        return 1 / 2**16
    seen = counts[len(gram)]
    context = gram[:-1]
    same = {g: n for g, n in seen.items() if g[:-1] == context}
    below = _plain_log_p(counts, gram[1:])
    if not same:
        return below
    total = sum(same.values())
    return max(same.get(gram, 0) - langid.DISCOUNT, 0) / total + langid.DISCOUNT * len(same) / total * below


def test_language_model_against_its_definition():
    text = "Abrakadabra, simsalabim! Abba aber 42 abends."
    (grams,) = langid.pieces(text)
    keys, n = langid.distinct(grams)
    model = langid.kneser_ney(keys, n)
    highest = {tuple(int(k) >> (16 * s) & 0xFFFF for s in (3, 2, 1, 0)): int(c) for k, c in zip(keys, n, strict=True)}
    counts = {4: highest}
    for order in (3, 2, 1):
        ends = defaultdict(set)
        for gram in counts[order + 1]:
            ends[gram[1:]].add(gram[0])
        counts[order] = {gram: len(first) for gram, first in ends.items()}
    for query in ["abra", "abrx", "xyzw", " abb", "zabr"]:
        symbols = tuple(ord(c) for c in query)
        key = np.array([sum(s << (16 * (3 - k)) for k, s in enumerate(symbols))], np.uint64)
        assert np.exp(model.log_p(key))[0] == pytest.approx(_plain_log_p(counts, symbols))


def test_pieces_agree_with_the_whole(monkeypatch):
    text = "Some words,   and MORE words; ünïcode 漢字 and 12 numbers " * 9
    (whole,) = langid.pieces(text)
    monkeypatch.setattr(langid, "PIECE", 17)
    assert (np.concatenate(list(langid.pieces(text))) == whole).all()


def test_language_models_leave_no_gram_out(spark):
    """However much text there is, and in however many parts: the model is that of all n-grams."""
    rows = [("x", "abra kadabra " * 400 + "sim sala bim 漢字"), ("x", "rare q"), ("y", "lorem ipsum dolor " * 300 + "zyx")]
    labelled = spark.createDataFrame(rows, "lang string, text string")
    whole = {}
    for lang in "xy":
        grams = np.concatenate([g for name, text in rows if name == lang for g in langid.pieces(text)])
        whole[lang] = langid.kneser_ney(*langid.distinct(grams))
    asked = np.unique(np.concatenate([g for t in ("rare q zyx", "sim 漢字 abra", "qqqq Ω") for g in langid.pieces(t)]))
    expected = np.stack([whole[lang].log_p(asked) for lang in "xy"], axis=1)
    texts = spark.createDataFrame([("rare q",), ("a zyx lorem",)], "text string")
    said = []
    for entries in (8, langid.ENTRIES):
        found = langid.learn(labelled, entries=entries)
        assert (len(found.parts) > 3) == (entries == 8)
        assert found.log_p(asked) == pytest.approx(expected)
        said.append([r["language"] for r in langid.identify(texts, found).collect()])
    assert said[0] == said[1] and [r["lang"] for r in said[0]] == ["x", "y"]


def test_limits_for_rejection_come_from_all_texts(spark):
    """However many texts there are: each different one counts once, if it is identified as its language."""
    syllables = {"x": ["ka", "lo", "mi", "ru", "se"], "y": ["sch", "tz", "ei", "ng", "ü"]}
    random = np.random.default_rng(3)
    rows = [
        (lang, " ".join("".join(random.choice(syllables[lang], 3)) for _ in range(random.integers(1, 6))) + " x" * (n % 3))
        for n in range(4_000) for lang in "xy"
    ]
    rows += [("x", "kalo " * 40)] * 3_000 + [("y", "kalo mi"), ("x", "42"), ("x", None), (None, "kalo"), ("z", "kalomi")]
    found = langid.learn(spark.createDataFrame(rows, "lang string, text string"))
    assert found.languages == ("x", "y", "z")
    different = sorted({row for row in rows if None not in row and row[1] != "42"})
    assert len(different) > 7_000
    entropies, _ = found.entropies([text for _, text in different])
    best = entropies.argmin(axis=1)
    for k, lang in enumerate(found.languages):
        own = [line[k] for (name, _), line, b in zip(different, entropies, best, strict=True) if name == lang and b == k]
        assert found.limits[k] == (pytest.approx(np.quantile(own, langid.WITHIN) * langid.MARGIN) if own else np.inf)


def test_quantiles_of_groups(spark):
    random = np.random.default_rng(4)
    groups = {
        "even": random.random(3_001), "tied": np.repeat([1.0, 2.0, 7.0], [500, 497, 3]), "one": np.array([3.5]),
        "two": np.array([1.0, 4.0]), "equal": np.full(900, 2.5), "skewed": 1 + 10.0 ** -random.uniform(0, 15, 2_000),
        "zero": np.concatenate([np.zeros(300), 2.0 ** -random.uniform(0, 100, 300), [1e6]]),
    }
    rows = [(name, float(v)) for name, values in groups.items() for v in values]
    random.shuffle(rows)
    values = spark.createDataFrame([(name, float(v)) for name, v in rows], "group string, value double")
    for share in (0.0, 0.5, langid.WITHIN, 1.0):
        found = langid.quantiles(values, share)
        assert found == {name: np.quantile(values, share) for name, values in groups.items()}
    assert langid.quantiles(values.limit(0), 0.5) == {}


def test_search_against_all_products():
    random = np.random.default_rng(5)
    rows = np.floor(random.normal(size=(900, 8)) * 100)
    rows[200:300] = rows[7]
    tree = topk.BallTree(rows, 16)
    assert sorted(tree.order) == list(range(900))
    ids = np.arange(900) * 3
    queries, own = rows[::50], ids[::50]
    got = defaultdict(list)
    for q, who, score in topk.search(tree, ids, queries, own, np.full(len(own), -np.inf), 5):
        got[q].append((who, score))
    for q in range(len(own)):
        products = (rows @ queries[q]).astype(int)
        best = sorted((-p, i) for p, i in zip(products, ids, strict=True) if i != own[q])[:5]
        assert sorted((-s, w) for w, s in got[q]) == [(p, int(i)) for p, i in best]


def test_terms_need_boundaries():
    strict, soft = ("casino",), ("cheap", "pills")
    assert urls.terms_in("http://casino-win.com/cheap/pills", strict, soft) == (["casino"], ["cheap", "pills"])
    assert urls.terms_in("http://casinos.com/cheaper", strict, soft) == ([], [])
    assert urls.terms_in("http://24casino1.com", strict, soft) == (["casino"], [])
    assert urls.terms_in(None, strict, soft) == urls.terms_in("", strict, soft) == ([], [])
    assert urls.terms_in("http://casino.com", (), ()) == ([], [])


def test_suppression():
    assert suppress([(0, 9, 1), (2, 5, 2), (2, 5, 1), (8, 12, 1)]) == [0, 1, 3]
    assert suppress([(0, 9, 2), (2, 5, 2), (2, 5, 1), (8, 12, 1)]) == [0, 3]
    assert suppress([]) == []


def test_suppression_agrees_with_pair_by_pair():
    draw = random.Random(1)
    for _ in range(2000):
        found = [(a, a + draw.randint(1, 8), draw.randint(1, 3)) for a in draw.choices(range(20), k=draw.randint(0, 15))]
        kept = []
        for i in sorted(range(len(found)), key=lambda i: (-found[i][2], found[i][0] - found[i][1], i)):
            if not any(found[k][0] <= found[i][0] and found[i][1] <= found[k][1] for k in kept):
                kept.append(i)
        assert suppress(found) == sorted(kept, key=lambda i: (found[i][0], found[i][1]))


def test_time_of_suppression_grows_with_the_mentions():
    """100,000 mentions; compared pair by pair they take hours."""
    found = [(n * 10, n * 10 + 5, 1 + n % 2) for n in range(100_000)] + [(n * 10 + 1, n * 10 + 4, 1) for n in range(100_000)]
    assert len(suppress(found)) == 100_000


def test_long_conversation(spark):
    """20,000 turns of one conversation, with letters of several bytes and control strings."""
    said = F.concat(F.repeat(F.lit("\u00e9<|\\"), 3), F.col("id").cast("string"))
    role = F.when(F.pmod(F.xxhash64("id"), F.lit(3)) == 0, "assistant").otherwise("user")
    turns = spark.range(20_000).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), said.alias("text"))
    read = chat.format_chats(turns).select(
        chat.masked(F.col("formatted"), F.col("loss_spans")).alias("loss"), chat.read_turns(F.col("formatted")).alias("turns")
    ).first()
    given = turns.orderBy("turn").collect()
    assert [tuple(t) for t in read["turns"]] == [(t.role, t.text) for t in given]
    assert read["loss"] == "".join(t.text for t in given if t.role == "assistant")


def test_of_equally_long_rules_the_first_decides(spark):
    given = spark.createDataFrame([("http://b.a.com/xyz",)], "url string")
    block, allow = ("block", "a.com", "/xy"), ("allow", "b.a.com", "/")
    for rules, verdict in (((block, allow), "block"), ([allow, block], "allow")):
        assert [r.verdict for r in urls.judge(given, rules=rules, strict=(), soft={}).collect()] == [verdict]
    longer = ("allow", "b.a.com", "/x")
    assert urls.judge(given, rules=[block, longer]).first().rule == "b.a.com/x"
