import json

import pytest

LONG = " ".join(f"wort{i % 977} and" for i in range(30_000))
#: Texts of all awkward kinds; ids 7 and 8 repeat, and there are rows without an id.
AWKWARD = [
    (1, None, "a"), (2, "", "a"), (3, " \n\t", None), (4, LONG, "b"), (5, LONG + " end", "b"),
    (6, "one two three four five six seven eight nine ten", "a"), (7, "same row twice here for you", "c"),
    (7, "same row twice here for you", "c"), (8, "one id with this text", "c"), (8, "one id with another text", "c"),
    (None, "no id at all in this row", "a"), (None, "no id at all in this row", "a"), (9, "Ünïcödé ΑΒΓ 漢字 😀", None),
    (10, "12345 !!! ???", "d"), (11, "\u0000 odd \\ <| chars |> <|im_end|>", "d"),
]
#: Names that operators use for themselves.
CLASHES = ("row", "size", "key", "tie", "place", "shard", "slot", "score", "id", "n", "print", "component", "rank", "node",
           "root", "host", "url", "leaks", "copies", "target", "finish", "language", "licenses", "toxicity", "range", "at")


@pytest.fixture(scope="session")
def awkward(spark):
    """doc_id, text, source and a column of each clashing name."""
    from pyspark.sql import functions as F

    rows = spark.createDataFrame(AWKWARD, "doc_id bigint, text string, source string")
    return rows.select("*", *[F.lit(f"own {c}").alias(c) for c in CLASHES])


@pytest.fixture(scope="session")
def nothing(awkward):
    return awkward.limit(0)


def texts(df, *columns):
    """Rows as text, sorted: equal for equal tables with repeated rows and NULLs."""
    df = df.select(*columns) if columns else df
    return sorted(json.dumps(r.asDict(True), default=str, sort_keys=True) for r in df.collect())
