"""Each stage of the pipeline against a plain version on the rows that reach it."""

import math
import os
import re
from collections import Counter, defaultdict

import pytest

import corpus_pipeline
from dealtide.llm import decontaminate, toxicity
from dealtide.llm.tables import keep, read

from .conftest import texts
from .test_queries import _components, _row_of_distances

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def passed(spark):
    """The rows before and after each stage."""
    if not os.path.isdir(SF_DIR):
        pytest.skip("test tables are not there")
    docs = read(spark, SF_DIR, "documents")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(keep(stage(spark, out[-1], SF_DIR)))
    return out


def ids(df):
    return Counter(r["doc_id"] for r in df.select("doc_id").collect())


def test_stages_are_these():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "near duplicates", "decontamination", "mixing", "sharding"]


def test_columns_and_rows(passed):
    for df in passed[:-1]:
        assert df.columns == COLUMNS
    assert passed[-1].columns == [*COLUMNS, "shard", "slot"]
    counts = [df.count() for df in passed]
    assert counts == sorted(counts, reverse=True) and counts[-1] == counts[-2] and counts[0] > counts[1] > counts[2] > counts[3]


def test_toxic_texts_go(spark, passed):
    lexicon = toxicity.learn_from_tables(passed[0], read(spark, SF_DIR, "labels"))
    rows = passed[0].select("doc_id", "text").collect()
    assert ids(passed[1]) == Counter(r["doc_id"] for r in rows if lexicon.score(r["text"])[0] < 0.7)


def test_one_of_each_group_stays(passed):
    found = _components([(r["doc_id"], r["text"], None, None) for r in passed[1].collect()], 5, 80)
    assert ids(passed[2]) == Counter({component for _, component in found.values()})


def test_passages_go(spark, passed):
    items = [decontaminate.words(r["text"]) for r in read(spark, SF_DIR, "benchmark").collect()]
    clean = Counter()
    for r in passed[2].collect():
        line = decontaminate.words(r["text"])
        leaks = [i for i in items if line and _row_of_distances(i, line).min() <= math.floor(0.2 * len(i))]
        clean[r["doc_id"]] += not leaks
    assert ids(passed[3]) == +clean


def test_mix_takes_by_weight(passed):
    rows = passed[3].collect()
    size = {r["doc_id"]: len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")) for r in rows}
    source = {r["doc_id"]: r["source"] for r in rows}
    total, taken = defaultdict(int), defaultdict(int)
    for doc, n in size.items():
        total[source[doc]] += n
    kept = ids(passed[4])
    assert set(kept.values()) == {1}
    for doc in kept:
        taken[source[doc]] += size[doc]
    budget = 0.9 * sum(total.values())
    assert budget - max(size.values()) <= sum(taken.values()) <= budget
    weight = dict(zip(sorted(total), mixing_weights(len(total)), strict=True))
    level = _level(total, weight, budget)
    for name in total:
        assert abs(taken[name] - min(total[name], level * weight[name])) <= max(size.values())


def mixing_weights(n):
    return [(5, 2, 1)[k % 3] for k in range(n)]


def _level(total, weight, budget):
    """Where the sources stand that are not full, by halving."""
    low, high = 0.0, float(budget)
    for _ in range(200):
        middle = (low + high) / 2
        if sum(min(total[s], middle * weight[s]) for s in total) < budget:
            low = middle
        else:
            high = middle
    return high


def test_shards_hold_all(passed):
    assert texts(passed[5], *COLUMNS) == texts(passed[4], *COLUMNS)
    rows = passed[5].select("shard", "slot").collect()
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1


def test_awkward_rows_pass(spark, awkward, nothing):
    docs = awkward.withColumnRenamed("n", "n_chars")
    for _, stage in corpus_pipeline.STAGES:
        columns = docs.columns
        docs = keep(stage(spark, docs, SF_DIR))
        assert set(columns) <= set(docs.columns)
    assert ids(docs)[1] == ids(docs)[2] == ids(docs)[3] == ids(docs)[7] == 1 and ids(docs)[5] == 0
    empty = nothing
    for _, stage in corpus_pipeline.STAGES:
        empty = keep(stage(spark, empty, SF_DIR))
    assert empty.count() == 0
