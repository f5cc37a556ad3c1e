"""Exact and near duplicates against brute force."""

import collections
import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from annomill.llm import exact, neighbours, words
from annomill.llm.queries import QUERIES

BLANKS = re.compile(r"[\x20\x09-\x0D]")


def exact_groups(docs):
    groups = collections.defaultdict(list)
    for n, (doc, text) in enumerate(docs):
        groups[BLANKS.sub("", text or "")].append((doc, len(text or ""), n))
    out = collections.Counter()
    for whole, rows in groups.items():
        best = min(rows, key=lambda r: (-r[1], r[0] is None, r[0] or 0))
        for doc, _, n in rows:
            out[(doc, best[0], len(rows), doc == best[0], hashlib.sha256(whole.encode()).hexdigest())] += 1
    return out


DOCS = [(5, "a b c"), (3, "abc"), (4, "ab\tc "), (9, "a b\nc"), (1, None), (2, ""), (6, " \r\n "), (7, "é x"), (8, "éx"),
        (10, "other"), (None, "other"), (11, "a\x1cb"), (12, "ab"), (13, "x" * 50_000), (14, "x " * 50_000)]


@pytest.mark.parametrize("files", [None, 2])
@pytest.mark.parametrize("weak", [False, True])
def test_exact(files, weak, spark, documents, tmp_path):
    """Also over several micro-batches, and with a digest that many different texts share."""
    path = str(tmp_path / "docs")
    documents(DOCS).repartition(5).write.parquet(path)
    digest = (lambda text: F.length(text).cast("string")) if weak else exact.sha256
    found = exact.deduplicated(spark, path, digest=digest, files=files).collect()
    rows = collections.Counter((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in found)
    assert rows == exact_groups(DOCS)


def test_state_outlives_the_stream(spark, documents, tmp_path):
    """A copy that comes in a later run is a copy of what came before."""
    path, home = str(tmp_path / "docs"), str(tmp_path / "state")
    documents(DOCS[:6]).write.parquet(path)
    assert exact.update_state(spark, path, home).where("group_size > 1").count() == 2
    documents([(20, "a  b c"), (21, "new")]).write.mode("append").parquet(path)
    again = {r.best.doc_id: r.group_size for r in exact.update_state(spark, path, home).collect()}
    assert again[20] == 5 and again[21] == 1


def test_exact_empty(spark, documents, tmp_path):
    path = str(tmp_path / "docs")
    documents([]).write.parquet(path)
    assert exact.deduplicated(spark, path).count() == 0


def test_exact_query(spark, sf_dir):
    given = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    found = QUERIES["op3_stateful_exact"](spark, sf_dir).collect()
    assert collections.Counter((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in found) \
        == exact_groups(given)


def weights(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    if 0 < len(words) < 5:
        return collections.Counter([tuple(words)])
    return collections.Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))


def probability_jaccard(x, y):
    if not x and not y:
        return 1.0
    every = set(x) | set(y)
    return sum(1 / sum(max(x.get(e, 0) / x[d], y.get(e, 0) / y[d]) for e in every) for d in set(x) & set(y))


def near_classes(docs):
    """Lowest id of each document's class, over all pairs."""
    sets = [weights(text) for _, text in docs]
    number = {}
    arrays = []
    for own in sets:
        pairs = sorted((number.setdefault(shingle, len(number)), n) for shingle, n in own.items())
        arrays.append((np.array([k for k, _ in pairs], dtype=np.uint64), np.array([n for _, n in pairs], dtype=np.int64)))
    held = collections.defaultdict(list)
    for n, own in enumerate(sets):
        for shingle in own or [None]:
            held[shingle].append(n)
    label = list(range(len(docs)))

    def root(n):
        while label[n] != n:
            n = label[n]
        return n

    for n, own in enumerate(sets):
        for m in {m for shingle in own or [None] for m in held[shingle] if m < n}:
            if root(n) != root(m) and neighbours.similarity(arrays[n], arrays[m]) >= 0.8:
                label[root(n)] = root(m)
    least = {}
    for n, (doc, _) in enumerate(docs):
        least[root(n)] = min(least.get(root(n), (doc is not None, doc or 0)), (doc is not None, doc or 0))
    return {n: least[root(n)][1] if least[root(n)][0] else None for n in range(len(docs))}


def edited(rng, words, times):
    words = list(words)
    for _ in range(times):
        words[rng.randrange(len(words))] = f"e{rng.randrange(10 ** 6)}"
    return words


def test_near_duplicates(documents):
    rng = random.Random(4)
    docs = []
    for base in range(12):
        words = [f"b{base}w{rng.randrange(200)}" for _ in range(rng.randint(60, 300))]
        for copy in range(rng.randint(1, 9)):
            docs.append((len(docs), " ".join(edited(rng, words, rng.randint(0, 6)))))
    docs += [(1000, None), (1001, ""), (1002, " \n"), (1003, "one two"), (1004, "one two"), (1005, "one two three"),
             (1006, "ha " * 400), (1007, "ha " * 390), (None, docs[0][1]), (1008, docs[0][1] + " ")]
    found = neighbours.near_duplicates(documents(docs)).collect()
    expected = near_classes(docs)
    assert {(r.doc_id, r.class_id) for r in found} == {(doc, expected[n]) for n, (doc, _) in enumerate(docs)}
    sizes = collections.Counter(r.class_id for r in found)
    assert all(r.class_size == sizes[r.class_id] for r in found)
    assert sum(r.kept for r in found) == len(sizes)
    kept = neighbours.keep_one(documents(docs))
    assert kept.count() == len(sizes) and kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_cross_links_between_classes_of_a_bucket(documents, monkeypatch):
    """A chain whose ends are not alike and whose lowest document is an end."""
    words = [f"w{n}" for n in range(200)]
    chain = []
    for step in range(12):
        words = words[:step * 12] + [f"c{step}_{n}" for n in range(8)] + words[step * 12 + 8:]
        chain.append((step, " ".join(words)))
    expected = near_classes(chain)
    found = neighbours.near_duplicates(documents(chain)).collect()
    assert {r.doc_id: r.class_id for r in found} == expected


@pytest.mark.parametrize("phrase", [0, 7])
def test_large_groups_of_near_copies(phrase, documents, monkeypatch):
    """Copies of a text with edits here and there; most are like some others only.  With a phrase shingles repeat."""
    rng = random.Random(5 + phrase)
    words = [f"w{n}" for n in range(70)] + [f"p{n}" for n in range(phrase)] * 2
    docs = []
    for doc in range(400):
        own = edited(rng, words, rng.choice([1, 1, 2, 2, 3]))
        if rng.random() < 0.2:
            own = own[:rng.randrange(50, 70)] + own[70:]
        docs.append((doc, " ".join(own)))
        if rng.random() < 0.3:
            docs.append((1000 + doc, " ".join(edited(rng, own, 1))))
    compared = []
    plain = neighbours.linked

    def counted(pairs, held):
        compared.append(pairs.count())
        return plain(pairs, held)

    monkeypatch.setattr(neighbours, "linked", counted)
    found = neighbours.near_duplicates(documents(docs)).collect()
    expected = near_classes(docs)
    assert {r.doc_id: r.class_id for r in found} == {doc: expected[n] for n, (doc, _) in enumerate(docs)}
    assert len(set(expected.values())) > 20
    if not phrase:
        assert len(compared) == 4 and compared[3] < len(docs)


def test_copies_that_repeat_a_line_are_not_all_compared(documents, monkeypatch):
    """Copies of a text that hold a line several times; pairs that are not similar show it without their texts."""
    rng = random.Random(31)
    words, line = [f"w{n}" for n in range(60)], [f"l{n}" for n in range(12)]
    docs = []
    for doc in range(400):
        own = edited(rng, words, rng.choice([2, 3, 3, 4])) + line * rng.choice([3, 4, 5])
        docs.append((doc, " ".join(own)))
        if rng.random() < 0.2:
            docs.append((1000 + doc, " ".join(edited(rng, own, 1))))
    compared = []
    plain = neighbours.linked

    def counted(pairs, held):
        compared.append(pairs.count())
        return plain(pairs, held)

    monkeypatch.setattr(neighbours, "linked", counted)
    monkeypatch.setattr(neighbours, "PACK", 64, raising=False)
    found = neighbours.near_duplicates(documents(docs)).collect()
    expected = near_classes(docs)
    assert {r.doc_id: r.class_id for r in found} == {doc: expected[n] for n, (doc, _) in enumerate(docs)}
    assert len(set(expected.values())) > 20
    assert compared[-1] < 4 * len(docs)


def test_cells_of_similar_texts_are_similar():
    rng = np.random.default_rng(8)
    held = []
    for group in range(6):
        keys, base = rng.integers(0, 1 << 63, 700, dtype=np.uint64), rng.integers(1, 9, 700)
        for _ in range(15):
            own = np.maximum(0, base + rng.integers(-1, 2, 700) * (rng.random(700) < rng.random() / 2)) * rng.integers(1, 4)
            order = np.argsort(keys[own > 0])
            held.append((keys[own > 0][order], own[own > 0][order]))
    held.append((np.zeros(0, np.uint64), np.zeros(0, np.int64)))
    rows = np.array([neighbours.cells(*x) for x in held])
    exact_values = np.array([[neighbours.similarity(x, y) for y in held] for x in held])
    alike = np.array([neighbours.similar_cells(row, rows) for row in rows])
    assert (exact_values >= 0.8).sum() > 200 and alike[exact_values >= 0.8].all()
    assert alike.sum() < 2 * (exact_values >= 0.8).sum()
    assert alike[-1].sum() == 1 and alike[:, -1].sum() == 1


def test_similarity_and_signatures():
    rng = np.random.default_rng(2)
    for _ in range(20):
        x = {int(k): int(v) for k, v in zip(rng.choice(40, 20, False), rng.integers(1, 5, 20))}
        y = {int(k): int(v) for k, v in zip(rng.choice(40, 25, False), rng.integers(1, 5, 25))}
        pair = [(np.array(sorted(z), dtype=np.uint64), np.array([z[k] for k in sorted(z)])) for z in (x, y)]
        exact_value = probability_jaccard(x, y)
        assert abs(neighbours.similarity(*pair) - exact_value) < 1e-9
        doc = np.repeat([0, 1], [len(x), len(y)])
        found = neighbours.signatures(doc, np.concatenate([p[0] for p in pair]), np.concatenate([p[1] for p in pair]), 2, 4000)
        assert abs((found[0] == found[1]).mean() - exact_value) < 0.04


def test_nothing_near(documents):
    assert neighbours.near_duplicates(documents([])).count() == 0


def test_near_query(spark, sf_dir):
    given = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    found = {r.doc_id: r.class_id for r in QUERIES["op2_probminhash"](spark, sf_dir).collect()}
    assert found == {doc: label for (doc, _), label in zip(given, near_classes(given).values())}


def test_workers_give_freed_memory_back(monkeypatch):
    def held():
        with open("/proc/self/statm", encoding="ascii") as file:
            return int(file.read().split()[1]) * 4096

    many = [np.ones(8_000) for _ in range(5_000)]
    last = np.ones(8_000)
    del many
    before = held()
    words.give_back()
    assert before - held() > 200 << 20 and last.sum() == 8_000
    calls = []
    monkeypatch.setattr(neighbours, "give_back", lambda: calls.append(1))
    batch = pa.RecordBatch.from_pydict({"node": [1], "other": [2], "text": ["a b c d e"], "other_text": ["a b c d e"]})
    assert len(list(neighbours._signed(iter([batch])))) == len(list(neighbours._compared(iter([batch])))) == 1
    assert len(calls) == 2
