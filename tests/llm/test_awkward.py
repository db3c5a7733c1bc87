"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing names."""

import pytest
from pyspark.sql import functions as F

from dealtide.llm import (
    chat, decontaminate, langid, licenses, mixing, neardup, phrases, repeats, sharding, topk, toxicity, urls, variants,
)

from .conftest import AWKWARD, CLASHES, texts

ITEMS = [(1, "one two three four five six seven eight nine ten"), (2, None), (None, "no id"), (3, "short one"), (4, "")]


def _items(spark):
    return spark.createDataFrame(ITEMS, "item_id bigint, text string")


def _words(df):
    return df.withColumn("words", F.size(F.split(F.coalesce("text", F.lit("")), " ")))


OPERATORS = {
    "leaks": lambda spark, df: decontaminate.find_leaks(df, _items(spark)),
    "licenses": lambda spark, df: licenses.scan(df),
    "toxicity": lambda spark, df: toxicity.score(df, toxicity.Lexicon(dict(toxicity.INSULTS), {"wort": 3.0})),
    "language": lambda spark, df: langid.identify(
        df, langid.learn(spark.createDataFrame([("x", "abc abd abe"), ("y", "uvw uvx uvy")], "lang string, text string"))
    ),
    "shards": lambda spark, df: sharding.interleave(df, 3),
    "mix": lambda spark, df: mixing.mix(_words(df), "words").drop("words"),
    "near": lambda spark, df: neardup.near_duplicates(df),
    "urls": lambda spark, df: urls.judge(df, "text", [("block", "org", "/")]),
    "repeats": lambda spark, df: repeats.remove_repeats(df, size=4),
}
ADDED = {
    "leaks": {"leaks"}, "licenses": {"licenses"}, "toxicity": {"toxicity"}, "language": {"language"},
    "shards": {"shard", "slot"}, "mix": {"source_size", "target", "copies", "finish"},
    "near": {"n_shingles", "component_id", "kept", "representative"},
    "urls": {"host", "path", "rule", "strict", "soft", "verdict"},
    "repeats": {"repeats"},
}


@pytest.mark.parametrize("name", OPERATORS)
def test_all_rows_and_columns_stay(spark, awkward, name):
    out = OPERATORS[name](spark, awkward)
    assert set(out.columns) == set(awkward.columns) | ADDED[name]
    assert len(out.columns) == len(set(out.columns))
    rest = ["doc_id", "text", "source", *[c for c in CLASHES if c not in ADDED[name]]]
    assert texts(out, *rest) == texts(awkward, *rest)


@pytest.mark.parametrize("name", OPERATORS)
def test_an_empty_table_gives_an_empty_table(spark, nothing, name):
    out = OPERATORS[name](spark, nothing)
    assert out.count() == 0 and ADDED[name] <= set(out.columns)


@pytest.mark.parametrize("name", OPERATORS)
def test_reruns_and_partitions_agree(spark, awkward, name):
    columns = ["doc_id", "text", *sorted(ADDED[name])]
    one = texts(OPERATORS[name](spark, awkward.coalesce(1)), *columns)
    assert one == texts(OPERATORS[name](spark, awkward.repartition(7, "text")), *columns)


def test_values_of_awkward_rows(spark, awkward):
    found = {r["doc_id"]: r["leaks"] for r in OPERATORS["leaks"](spark, awkward).collect()}
    assert [x["item_id"] for x in found[6]] == [1] and not found[1] and not found[2] and not found[4]
    said = {r["doc_id"]: r["licenses"] for r in OPERATORS["licenses"](spark, awkward).collect()}
    assert said[1]["n_words"] == 0 and said[1]["score"] == 0 and said[4]["n_words"] == 60_000
    langs = {r["doc_id"]: r["language"] for r in OPERATORS["language"](spark, awkward).collect()}
    assert langs[1]["lang"] == langs[2]["lang"] == langs[3]["lang"] == langs[10]["lang"] == "und"
    assert langs[4]["lang"] in ("x", "y") and langs[9]["lang"] in ("x", "y")
    toxic = {r["doc_id"]: r["toxicity"] for r in OPERATORS["toxicity"](spark, awkward).collect()}
    assert toxic[1]["score"] == toxic[6]["score"] < 0.5 and toxic[4]["score"] > 0.9


def test_near_duplicates_of_awkward_rows(spark, awkward):
    rows = OPERATORS["near"](spark, awkward).collect()
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], []).append(r)
    assert all(by[i][0]["n_shingles"] == 0 and by[i][0]["component_id"] == i and by[i][0]["kept"] for i in (1, 2, 3))
    assert by[5][0]["component_id"] == 4 and not by[5][0]["kept"] and by[4][0]["kept"]
    assert sorted(r["representative"] for r in by[7]) == [False, True] and all(r["kept"] for r in by[7])
    assert sorted(r["representative"] for r in by[None]) == [False, True]
    assert all(r["representative"] for r in by[8])


def test_rows_in_no_group_are_not_ranked(spark, awkward):
    """The window takes the rows of groups alone: they come from an inner join, not from a left one."""
    plan = OPERATORS["near"](spark, awkward)._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("Window [") :]
    assert "Join Inner" in below and "LeftOuter" not in below


def test_shards_and_mix_of_awkward_rows(spark, awkward):
    rows = OPERATORS["shards"](spark, awkward).collect()
    for shard in range(3):
        assert sorted(r["slot"] for r in rows if r["shard"] == shard) == list(range(len(AWKWARD) // 3))
    assert mixing.mix(awkward.withColumn("none", F.lit(None).cast("int")), "none").agg(F.max("copies")).first()[0] == 0


def test_chat_of_awkward_rows(spark):
    given = [
        (1, 0, "user", None), (1, 0, "user", None), (1, 0, None, ""), (1, None, "assistant", "x\n<|im_end|>\\<|im_start|>user\n"),
        (1, 2, "a\nb<|", "<"), (1, 3, "a\nb<|", "|<|im_join|>"), (None, 1, "assistant", "\\"), (None, 1, "assistant", "<\\|"),
    ]
    df = spark.createDataFrame(given, "conv_id int, turn int, role string, text string").withColumn("turns", F.lit(1))
    out = {r["conv_id"]: r for r in chat.format_chats(df).select(
        "*", chat.read_turns(F.col("formatted")).alias("said"), chat.masked(F.col("formatted"), F.col("loss_spans")).alias("loss")
    ).collect()}
    said = {c: [tuple(t) for t in r["said"]] for c, r in out.items()}
    assert said[1] == [("assistant", "x\n<|im_end|>\\<|im_start|>user\n"), ("", ""), ("user", ""), ("user", ""),
                       ("a\nb<|", "<"), ("a\nb<|", "|<|im_join|>")]
    assert said[None] == [("assistant", "<\\|"), ("assistant", "\\")]
    assert out[1]["loss"] == "x\n<|im_end|>\\<|im_start|>user\n" and out[None]["loss"] == "<\\|\\"
    assert chat.format_chats(df.limit(0)).count() == 0


def test_topk_of_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    given = [
        (0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, None), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, [None, 1.0]),
        (6, [0.5, 0.9]), (None, [9.0, 9.0]), (7, [1.0]), (8, []), (9, [1e30, -1e30]), (10, [-0.001, 3.0]),
    ]
    df = spark.createDataFrame(given, "vec_id bigint, embedding array<double>").withColumn("score", F.lit("own"))
    rows = topk.top_k(df, F.col("vec_id") == 0, k=4).orderBy("rank").collect()
    assert [(r["vec_id"], r["score"]) for r in rows] == [(9, 2**63 - 1), (1, 256 * 128), (6, 256 * 128), (10, -256)]
    assert [r["rank"] for r in rows] == [1, 2, 3, 4]
    assert topk.top_k(df.limit(0), F.col("vec_id") == 0).count() == 0
    assert topk.top_k(df, F.lit(False)).count() == 0


def test_learning_without_rows(spark):
    none = spark.createDataFrame([], "text string, label int, lang string")
    assert toxicity.learn(none.select("text", "label")).words == toxicity.INSULTS
    assert langid.learn(none.select("lang", "text")).languages == ()
    rows = spark.createDataFrame([("abc",), (None,)], "text string")
    assert [r["language"]["lang"] for r in langid.identify(rows, langid.learn(none)).collect()] == ["und", "und"]


def test_repeats_of_awkward_rows(spark, awkward):
    rows = OPERATORS["repeats"](spark, awkward).collect()
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], []).append(tuple(r["repeats"]))
    assert by[1] == by[2] == by[3] == [(0, 0, "")]
    long = next(t for d, t, _ in AWKWARD if d == 4)
    assert by[4] == [(60_000, 0, long)] and by[5] == [(60_001, 60_000, "end")]
    assert by[7] == [(6, 0, "same row twice here for you")] * 2  # the same id twice
    assert sorted(by[None]) == [(7, 0, "no id at all in this row")] * 2
    assert sorted(by[8]) == [(5, 0, "one id with another text"), (5, 0, "one id with this text")]


def test_phrases_of_awkward_rows(spark, awkward):
    given = awkward.select("*", F.when(F.col("source") == "a", "xx").when(F.col("source") == "b", "yy").alias("lang"))
    rows = phrases.collocations(given, threshold=2, longest=3).collect()
    found = {(r["lang"], r["phrase"]): r.asDict() for r in rows}
    assert found["und", "same row twice"]["a"] == 2 and ("und", "same row") not in found
    assert found["xx", "no id at"]["a"] == 2 and found["yy", "wort0 and wort1"]["a"] == 62 and ("yy", "wort0 and") not in found
    assert {r["n"] for r in rows if r["lang"] == "yy"} == {120_001}
    ranks = sorted(r["rank"] for r in rows if r["lang"] == "yy")
    assert ranks == list(range(1, len(ranks) + 1))
    assert phrases.collocations(given.limit(0)).count() == 0
    assert phrases.collocations(given.select("text", F.lit(None).cast("string").alias("lang")), threshold=10**9).count() == 0


def test_variants_of_awkward_rows(spark, awkward):
    counted = variants.count_words(awkward)
    n = {r["word"]: r["n"] for r in counted.collect()}
    assert n["wort"] == n["and"] == 60_000 and n["no"] == 2 and n["ünïcödé".replace("ü", "Ü")] == 1 and None not in n
    assert sum(n.values()) == sum(r["n"] for r in variants.count_words(awkward, every=7).collect())
    given = [(None, 3), ("", 9), ("a", 100), ("b", 1), ("abc", None), ("😀a", 2), ("x" * 3000, 7), ("x" * 2999, 1)]
    rows = {r["word"]: tuple(r)[1:] for r in variants.group_variants(spark.createDataFrame(given, "word string, n long")).collect()}
    assert rows == {
        "": (9, "a", "a", 3 - 1, 100), "a": (100, None, "a", 3, None), "b": (1, "a", "a", 2, 100),
        "😀a": (2, "a", "a", 1, 100), "x" * 3000: (7, None, "x" * 3000, 1, None), "x" * 2999: (1, "x" * 3000, "x" * 3000, 1, 7),
    }
    assert variants.group_variants(counted.limit(0)).count() == 0
