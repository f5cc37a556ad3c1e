"""Removal of repeated words and bytes against brute force, and suffix order."""

import hashlib
import random
import re

import pytest

from annomill.llm import suffixes, substrings
from annomill.llm.queries import QUERIES


def kept_words(docs, width):
    """Per row: words, removed words and kept text, by the definition."""
    split = [(i if i is not None else -2 ** 63, re.findall(r"[^\x20\x09-\x0D]+", text or "")) for i, text in docs]
    earliest = {}
    for doc, words in split:
        for start in range(len(words) - width + 1):
            key = tuple(words[start:start + width])
            earliest[key] = min(earliest.get(key, (doc, start)), (doc, start))
    out = []
    for doc, words in split:
        gone = set()
        for start in range(len(words) - width + 1):
            if earliest[tuple(words[start:start + width])] < (doc, start):
                gone.update(range(start, start + width))
        out.append((len(words), len(gone), " ".join(w for n, w in enumerate(words) if n not in gone)))
    return out


def kept_bytes(docs, width):
    places = {}
    texts = [(text or "").encode() for _, text in docs]
    seen = set()
    for (doc, _), text in zip(docs, texts):
        if (doc, text) in seen:
            continue
        seen.add((doc, text))
        for start in range(len(text) - width + 1):
            key = hashlib.blake2b(text[start:start + width], digest_size=16).digest()
            places[key] = places.get(key, 0) + 1
    out = []
    for text in texts:
        gone = [False] * len(text)
        for start in range(len(text) - width + 1):
            if places[hashlib.blake2b(text[start:start + width], digest_size=16).digest()] > 1:
                gone[start:start + width] = [True] * width
        spans = sum(1 for n, g in enumerate(gone) if g and not (n and gone[n - 1]))
        out.append((len(text), sum(gone), spans, bytes(b for b, g in zip(text, gone) if not g)))
    return out


def made_up(seed, unit, size=60):
    """Documents that share runs of every length, with the odd cases."""
    rng = random.Random(seed)
    words = [f"{unit}{n}" for n in range(30)] + ["é", "日本", "x\x1cy"]
    passages = [[rng.choice(words) for _ in range(rng.randint(2, 40))] for _ in range(6)]
    docs = []
    for n in range(size):
        parts = []
        for _ in range(rng.randint(0, 5)):
            passage = rng.choice(passages)
            cut = rng.randint(0, len(passage))
            parts += rng.choice([passage, passage[:cut], passage[cut:], [rng.choice(words)], ["a"] * rng.randint(1, 30)])
        docs.append((n * 7 % 61, rng.choice([" ", "\n", " \t "]).join(parts)))
    return docs + [(100, None), (101, ""), (102, " \n "), (103, docs[3][1]), (104, docs[3][1]), (None, docs[5][1])]


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("width,base", [(8, 2), (5, 3)])
def test_repeated_words(seed, width, base, documents):
    docs = made_up(seed, "w")
    found = substrings.remove_repeats(documents(docs), width, base).collect()
    expected = {doc: row for (doc, _), row in zip(docs, kept_words(docs, width))}
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in found} == expected
    assert len(found) == len(docs)
    for r in found:
        assert sum(s.end - s.start for s in r.spans) == r.n_removed


def test_repeated_words_where_ids_repeat(documents):
    text = " ".join(f"w{n}" for n in range(12))
    docs = [(1, text), (1, text), (1, "other " + text), (2, text)]
    found = sorted((r.doc_id, r.n_removed, r.n_words) for r in substrings.remove_repeats(documents(docs), 4, 2).collect())
    assert found[-1] == (2, 12, 12)
    assert sum(removed for _, removed, _ in found[:3]) in (12, 24)


@pytest.mark.parametrize("hot", [False, True])
@pytest.mark.parametrize("seed,width,core", [(3, 40, 16), (4, 25, 24), (5, 30, 30)])
def test_repeated_bytes(seed, width, core, hot, documents, monkeypatch):
    if hot:
        monkeypatch.setattr(suffixes, "HOT_IN_TASK", 3)
        monkeypatch.setattr(suffixes, "HOT_CORE", 4)
    docs = made_up(seed, "w")
    found = suffixes.remove_repeats(documents(docs), width, core).collect()
    expected = {doc: row for (doc, _), row in zip(docs, kept_bytes(docs, width))}
    assert {r.doc_id: (r.n_bytes, sum(s.end - s.start for s in r.spans), len(r.spans), bytes(r.kept))
            for r in found} == expected
    assert len(found) == len(docs)


def test_words_with_nul_bytes(documents):
    """U+0000 is part of a word; the words behind it stay in step with their marks."""
    docs = [(1, "a\x00b c d e f g"), (2, "x\x00y a b c d e f g z\x00 \x00"), (3, "p a\x00b c d e f g q"), (4, "\x00 \x00\x00")]
    found = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in substrings.remove_repeats(documents(docs), 5, 5).collect()}
    assert [found[i] for i, _ in docs] == kept_words(docs, 5)


def test_nothing_in_nothing_out(documents):
    assert suffixes.remove_repeats(documents([])).count() == 0
    assert substrings.remove_repeats(documents([])).count() == 0


def test_suffix_order():
    rng = random.Random(5)
    for n in range(400):
        text = "".join(rng.choice("ab" if n % 2 else "abcde") for _ in range(rng.randint(0, 60)))
        assert suffixes.suffix_order(text) == sorted(range(len(text)), key=lambda i: text[i:])


@pytest.fixture(scope="module")
def given(spark, sf_dir):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]


def test_word_query(spark, sf_dir, given):
    found = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in QUERIES["op5_doubling_substrings"](spark, sf_dir).collect()}
    expected = {doc: (n, gone, hashlib.sha256(kept.encode()).hexdigest())
                for (doc, _), (n, gone, kept) in zip(given, kept_words(given, 20))}
    assert found == expected


def test_byte_query(spark, sf_dir, given):
    found = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)
             for r in QUERIES["op4_lyndon_suffixes"](spark, sf_dir).collect()}
    expected = {doc: (n, gone, spans, hashlib.sha256(kept).hexdigest())
                for (doc, _), (n, gone, spans, kept) in zip(given, kept_bytes(given, 400))}
    assert found == expected
