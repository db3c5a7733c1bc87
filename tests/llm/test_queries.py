"""The registered queries on the test tables: against their SQL, or against a brute-force version."""

import math
import os
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import __spark_entry__ as entry_point
from dealtide.llm import decontaminate, licenses, neardup
from dealtide.llm.queries import ORACLE, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not there")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


@pytest.fixture(scope="module")
def documents(duck):
    return duck.execute("SELECT doc_id, text, lang, source FROM documents").fetchall()


def rows(spark, name):
    return [r.asDict() for r in QUERIES[name](spark, SF_DIR).collect()]


def test_all_are_registered():
    assert set(QUERIES) | {"pipeline"} <= set(entry_point.queries())
    assert {int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES} == set(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_result_as_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    columns = sorted(df.columns)
    result = duck.execute(ORACLE[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    places = [names.index(c) for c in columns]
    expected = sorted(tuple(repr(r[i]) for i in places) for r in result.fetchall())
    assert sorted(tuple(repr(v) for v in r) for r in df.select(*columns).collect()) == expected


@pytest.mark.parametrize("name", ["op2_sharding", "op7_mixing"])
def test_native_queries_run_no_python(spark, name):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_sharding_matches_the_mixture(spark, documents):
    source = {d: s for d, _, _, s in documents}
    found = rows(spark, "op2_sharding")
    counts = Counter(r["shard"] for r in found)
    assert max(counts.values()) - min(counts.values()) <= 1
    for name, n in Counter(source.values()).items():
        held = Counter(r["shard"] for r in found if source[r["doc_id"]] == name)
        assert all(abs(held[s] - n / 8) <= 2 for s in range(8))
    assert all(r["text_crc32"] == zlib.crc32(text.encode()) for r in found for d, text, _, _ in documents if d == r["doc_id"])


def test_mixing_comes_near_its_targets(spark, documents):
    source = {d: s for d, _, _, s in documents}
    found = rows(spark, "op7_mixing")
    largest = max(r["size"] for r in found)
    taken = defaultdict(int)
    for r in found:
        assert r["taken"] in (0, r["size"], 2 * r["size"])
        taken[source[r["doc_id"]]] += r["taken"]
    targets = {source[r["doc_id"]]: r["target"] for r in found}
    assert all(abs(taken[s] - targets[s]) <= largest for s in targets)
    assert math.isclose(sum(targets.values()), 1.5 * sum(r["size"] for r in found))


def _row_of_distances(item, line):
    """Edit distance of the item to the closest run of words that ends at each place: the table of
    distances row by row, the step to the right as a running minimum."""
    line, place = np.array([hash(w) for w in line]), np.arange(len(line) + 1)
    above = np.zeros(len(line) + 1, int)
    for n, word in enumerate(item, 1):
        below = np.concatenate([[n], np.minimum(above[:-1] + (line != hash(word)), above[1:] + 1)])
        above = np.minimum.accumulate(below - place) + place
    return above[1:]


def test_decontamination_against_all_distances(spark, duck, documents):
    items = [(i, decontaminate.words(t)) for i, t in duck.execute("SELECT item_id, text FROM benchmark").fetchall()]
    expected = {}
    for doc, text, _, _ in documents:
        line = decontaminate.words(text)
        for item, wanted in items:
            least = int(_row_of_distances(wanted, line).min()) if line else len(wanted)
            if len(wanted) >= decontaminate.SHORTEST and least <= math.floor(0.2 * len(wanted)):
                expected[doc, item] = least
    assert {(r["doc_id"], r["item_id"]): r["distance"] for r in rows(spark, "op3_decontamination")} == expected
    assert expected


def test_edited_items_are_found(duck):
    items = duck.execute("SELECT item_id, text FROM benchmark").fetchall()
    index = decontaminate.Index(items)
    random = np.random.default_rng(7)
    found = tried = 0
    for item, text in items * 3:
        line = text.split()
        for _ in range(math.floor(0.2 * len(decontaminate.words(text)))):
            at, kind = int(random.integers(len(line))), int(random.integers(3))
            if kind == 0:
                line[at] = "replaced"
            elif kind == 1:
                line.insert(at, "inserted")
            else:
                line.pop(at)
        noise = " ".join(f"noise{k}" for k in range(50))
        hits = index.leaks([f"{noise} {' '.join(line)} {noise}".encode()])[0]
        found += any(h["item_id"] == item for h in hits)
        tried += 1
    assert found / tried >= decontaminate.RECALL - 0.03
    assert not index.leaks([noise.encode(), b"", None])[0]


def _licenses(text):
    """All rules without a keyword filter, base phrases word by word, suppression pair by pair."""
    said = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    base = []
    for phrase, label in licenses.BASE:
        wanted = phrase.split()
        base += [(label, k) for k in range(len(said)) if said[k : k + len(wanted)] == wanted]
    line = " ".join(said)
    hits = []
    for order, rule in enumerate(licenses.rules()):
        for m in re.finditer(r"(?:^|(?<= ))(?:" + rule.pattern + r")(?= |$)", line):
            hits.append((-rule.priority, m.start() - m.end(), m.start(), order, rule.label))
    kept = []
    for hit in sorted(hits):
        begin, end = hit[2], hit[2] - hit[1]
        if not any(k[2] <= begin and end <= k[2] - k[1] for k in kept):
            kept.append(hit)
    return len(said), base, {k[4] for k in kept}


def test_licenses_against_all_rules(spark, documents):
    texts = {d: t for d, t, _, _ in documents}
    assert len(licenses.rules()) > 200
    labels = 0
    for r in rows(spark, "op4_licenses"):
        n_words, base, found = _licenses(texts[r["doc_id"]])
        assert (r["n_words"], r["n_base"]) == (n_words, len(base))
        assert (r["first_word"], r["last_word"]) == ((min(k for _, k in base), max(k for _, k in base)) if base else (None, None))
        assert r["base_labels"] == ",".join(sorted({label for label, _ in base}))
        assert set(filter(None, r["labels"].split(","))) == found | {label for label, _ in base}
        labels += bool(found)
        assert 0 <= r["score"] <= 1 and (r["score"] > 0) == bool(found)
    assert labels


@pytest.mark.parametrize(
    "text, labels",
    [
        ("Licensed under the MIT License.", {"mit"}),
        ("SPDX-License-Identifier: Apache-2.0", {"apache-2.0"}),
        ("under the GNU Lesser General Public License, version 2.1", {"lgpl-2.1"}),
        ("This work is licensed under CC BY-NC 4.0.", {"cc-by-nc-4.0"}),
        ("commit to a license to kill; mit und ohne", set()),
        ("Permission is hereby granted, free of charge, to any person obtaining a copy of this", {"mit"}),
    ],
)
def test_license_labels(text, labels):
    assert {f["label"] for f in licenses.scan_text(text.encode())["found"]} == labels


def _components(documents, size, least):
    sets = {}
    for doc, text, _, _ in documents:
        line = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
        sets[doc] = {tuple(line[k : k + size]) for k in range(max(1, len(line) - size + 1))} if line else set()
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            shared = len(sets[a] & sets[b])
            if shared and 100 * shared >= least * (len(sets[a]) + len(sets[b]) - shared):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d)) for d in ids}


def test_near_duplicates_against_all_pairs(spark, documents):
    expected = _components(documents, 4, 80)
    found = rows(spark, "op5_neardup")
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == expected
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in found)
    assert len({c for _, c in expected.values()}) < len(expected)


def test_second_pass_and_large_buckets(spark, monkeypatch):
    """A chain of texts of which only neighbours are similar, in blocks of a few rows."""
    monkeypatch.setattr(neardup, "BLOCK", 4)
    line = [f"w{n}" for n in range(400)]
    given = [(n, " ".join(line[n * 6 : n * 6 + 100])) for n in range(40)]
    given += [(100 + n, " ".join(f"x{n} y{k}" for k in range(30))) for n in range(20)]
    df = spark.createDataFrame(given, "doc_id bigint, text string")
    expected = _components([(d, t, None, None) for d, t in given], 5, 80)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in neardup.near_duplicates(df).collect()} == expected



def test_short_and_unspaced_items_are_found():
    long = "天地玄黄宇宙洪荒日月盈昃辰宿列张寒来暑往"
    index = decontaminate.Index([(1, "Paris"), (2, "the capital of France"), (3, "the capital of France"), (4, "漢字"), (5, long), (6, " ?")])
    texts = ["Is it the Capital, of france? paris Paris", "the capital of all France", "私は漢字を書く", f"前言{long[:9]}无{long[10:]}。后记", "parisian", "", None]
    found = [sorted((h["item_id"], h["start"], h["words"], h["distance"]) for h in x) for x in index.leaks([t and t.encode() for t in texts])]
    assert found == [[(1, 6, 1, 0), (1, 7, 1, 0), (2, 2, 4, 0), (3, 2, 4, 0)], [], [(4, 2, 2, 0)], [(5, 2, 20, 1)], [], [], []]
    only = decontaminate.Index([(4, "漢字")])
    assert [len(x) for x in only.leaks(["漢字、漢字".encode(), b"x"])] == [2, 0]


def test_signature_distance_guarantee():
    """Signatures within the joined distance share a bucket, however the errors lie."""
    random = np.random.default_rng(3)
    for _ in range(300):
        one = random.integers(0, 2**16, neardup.JOINED).astype(np.uint16)
        other = one.copy()
        other[random.choice(neardup.JOINED, neardup.DISTANCE, replace=False)] ^= np.uint16(1)
        assert set(neardup.chunk_keys(one)) & set(neardup.chunk_keys(other))


def test_toxicity_on_held_out_labels(spark, duck):
    """On the next larger tables: the smallest have nine toxic texts to learn from."""
    folder = SF_DIR.replace("sf0.001", "sf0.01")
    toxic = dict(duck.execute(f"SELECT doc_id, toxic FROM '{folder}/labels.parquet'").fetchall())
    found = [r.asDict() for r in QUERIES["op8_toxicity"](spark, folder).collect()]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in found)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in found)
    assert all(r["matched"] for r in found if r["predicted"]), "only a match decides"
    held = [r for r in found if r["held_out"] and r["doc_id"] in toxic]
    right = sum(r["predicted"] == toxic[r["doc_id"]] for r in held)
    assert right / len(held) >= 0.9
    caught = [r["predicted"] for r in held if toxic[r["doc_id"]]]
    assert sum(caught) / len(caught) >= 0.75


def test_languages_of_held_out_documents(spark, documents):
    lang = {d: x for d, _, x, _ in documents}
    found = rows(spark, "op10_langid")
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in found)
    held = [r for r in found if r["held_out"] and lang[r["doc_id"]]]
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) / len(held) >= 0.97
    assert all(0 <= r["score"] <= 1 for r in found)
