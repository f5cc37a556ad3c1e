"""Line dedup and personal identifiers against plain versions."""

import hashlib
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from annomill.llm import identifiers, lines
from annomill.llm.oracles import ORACLES
from annomill.llm.queries import QUERIES
from compare import check, connect


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(name, spark, sf_dir):
    assert check(QUERIES[name](spark, sf_dir), connect(sf_dir), ORACLES[name]) == []


def one_edit(x, y):
    if abs(len(x) - len(y)) > 1:
        return False
    head = next((i for i, (a, b) in enumerate(zip(x, y)) if a != b), min(len(x), len(y)))
    tail = next((i for i, (a, b) in enumerate(zip(reversed(x), reversed(y))) if a != b), min(len(x), len(y)))
    return head + tail >= max(len(x), len(y)) - 1


def without_repeats(docs):
    seen, places, out = {}, [], []
    for n, (doc, text) in enumerate(docs):
        for number, line in enumerate(text.split("\n") if text is not None else []):
            places.append(((doc is not None, doc or 0, number), n, line))
    places.sort(key=lambda p: p[0])
    gone = set()
    for place, n, line in places:
        if not line.strip(" \t\n\r\f\v"):
            continue
        if line in seen or len(line) >= 16 and any(one_edit(line, other) for other in seen if len(other) >= 16):
            gone.add((n, place[2]))
        seen[line] = place
    for n, (doc, text) in enumerate(docs):
        if text is None:
            out.append((doc, 0, 0, None))
            continue
        split = text.split("\n")
        out.append((doc, len(split), sum((n, i) in gone for i in range(len(split))),
                    "\n".join(line for i, line in enumerate(split) if (n, i) not in gone)))
    return out


def with_one_edit(rng, line):
    at, kind = rng.randrange(len(line)), rng.randrange(3)
    return line[:at] + ("" if kind == 0 else rng.choice("xyé")) + line[at + (kind < 2):]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_lines(seed, documents):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abé ") for _ in range(rng.randint(1, 90))) for _ in range(14)]
    base += ["a" * 40, "ab" * 20, "x" * 15, "y" * 16, "Q" * 2100 + "tail", "z" * 33_000 + "end of it"]
    docs = []
    for doc in range(40):
        own = []
        for _ in range(rng.randint(0, 6)):
            line = rng.choice(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2])):
                line = with_one_edit(rng, line) if line else line
            own.append(rng.choice([line, line, "", "  \t"]))
        docs.append((doc * 13 % 41, "\n".join(own)))
    docs += [(50, None), (51, ""), (52, "\n\n"), (None, "only here, in a row without id\n" + base[0])]
    frame = documents(docs)
    found = lines.drop_repeats(frame)
    assert found.columns == [*frame.columns, "n_lines", "n_removed"]
    rows = {(r.doc_id, r.n_lines, r.n_removed, r.text) for r in found.collect()}
    assert rows == set(without_repeats(docs))


def test_lines_of_repeated_rows_and_of_nothing(documents):
    docs = [(1, "the same line in all of them\nb"), (1, "the same line in all of them\nb"), (2, "the same line in all of them")]
    found = sorted((r.doc_id, r.n_removed) for r in lines.drop_repeats(documents(docs)).collect())
    assert found == [(1, 0), (1, 0), (2, 1)]
    assert lines.drop_repeats(documents([])).count() == 0


BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_of(text):
    out = []
    for number, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {"email": True, "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else True,
                    "card": 14 <= len(digits) <= 19 and luhn(digits), "phone": 10 <= len(digits) <= 15}[kind]
            if good:
                out.append((m.start(), number, m.end(), kind))
    return sorted(out)


def spelled(found):
    return ",".join(f"{kind}:{start}:{end}" for start, _, end, kind in found)


ODD = ["", None, "a@b.c_d@e.f x@y.z@w.v", "1.2.3.4.5.6.7.8 256.1.1.1 001.02.3.255 1.1.1.1.1", "é日本 q@w.er +1 (415) 555-0100.",
       "4111 1111 1111 1111 4111-1111-1111-1112 4111111111111111", "+12345 +123456789012 +1 2 3 4 5 6 7 8 9 0 ) x",
       "@ .@. a@b a@b. a@-.- %@a.b..c", "0" * 14 + " " + "9" * 40, "1-2-3-4-5-6-7-8-9-0-1-2-3-4-5", "x" * 50_000 + "@a.b",
       "1 " * 20_000, "1." * 20_000, "a@b" + ".c" * 20_000, "+1" + "0" * 12 + "(" * 500, "\U0001F600 a@b.cd \U0001F600+4930123456789"]


def test_base_identifiers(documents):
    rng = random.Random(6)
    parts = ["a@b.c", "1.2.3.4", "+49 30 1234567", "4111111111111111", " ", " ", "-", ".", "é", "x", "7", "+", "@", "255.255.1.0"]
    docs = list(enumerate(ODD)) + [(100 + n, "".join(rng.choice(parts) for _ in range(rng.randint(1, 25)))) for n in range(300)]
    found = identifiers.find(documents(docs)).collect()
    assert len(found) == len(docs)
    for r in found:
        own = [(s.start, s.number - 1, s.end, s.kind) for s in r.spans if s.base]
        assert own == base_of(dict(docs)[r.doc_id]), dict(docs)[r.doc_id][:200]
    assert identifiers.find(documents([])).count() == 0
    twice = identifiers.find(documents([(1, "a@b.c"), (1, "a@b.c"), (None, "a@b.c d@e.f")])).collect()
    assert sorted(len(r.spans) for r in twice) == [1, 1, 2]


def test_contexts_find_unseen_identifiers(documents):
    docs = [(n, f"please phone +49 30 1234{n:03d} about it. total 17{n} units. dial 555-{n:04d}-99 now") for n in range(20)]
    docs += [(100, "please phone 030-5550-117 about it"), (101, "we sold total 030-5550-117 units"), (102, "no contact")]
    found = {r.doc_id: [(s.kind, docs_text[s.start:s.end]) for s in r.spans if not s.base]
             for r in identifiers.find(documents(docs)).collect() for docs_text in [dict(docs)[r.doc_id]]}
    assert found[100] == [("phone", "030-5550-117")]
    assert found[102] == [] and found[101] == [] and not any(found[n] for n in range(20))


def test_contexts_find_identifiers_of_several_words(documents):
    docs = [(n, f"please phone +1 (743) 555-3{n:03d} about it. sold 20 30 40 50 {n} of them") for n in range(20)]
    docs += [(100, "please phone (743) 555-3824 about it"), (101, "please phone 555 123 4567, about it"),
             (102, "we sold 555 123 4567 of them"), (103, "please phone ((743) 555 3824) about 4 5 6"),
             (104, "please phone (555 123 4567) about it"), (105, "please phone 5551238 about it")]
    texts = dict(docs)
    found = {r.doc_id: [(s.kind, texts[r.doc_id][s.start:s.end]) for s in r.spans if not s.base]
             for r in identifiers.find(documents(docs)).collect()}
    assert found[100] == [("phone", "(743) 555-3824")] and found[101] == [("phone", "555 123 4567")]
    assert found[103] == [("phone", "(743) 555 3824")] and found[104] == [("phone", "555 123 4567")]
    assert found[105] == [("phone", "5551238")]
    assert found[102] == [] and not any(found[n] for n in range(20))


LONG = 1_000_000


@pytest.mark.parametrize("text,kinds", [
    ("-" * 100_000 + " 5 61234567", ""), ("(" * 100_000 + "5 61234567", ""), ("-" * 100_000 + "5 61234567 " + "(5) " * 20_000, ""),
    ("x" * LONG + " a@b.cd", "email"), ("x" * LONG + " y" * 3 + " +49 30 1234567", "phone"), ("7" * LONG, ""), ("7" * LONG + " 8", ""),
    ("a:" * (LONG // 2) + "1", ""), ("!" * LONG + "1 2", ""), ("a@b.cd " + "!" * LONG + "x 5", "email"),
    ("a@b.cd " + "x!" * (LONG // 2), "email"), (" " * LONG + "5 6", ""), ("5 " * (LONG // 2), ""), ("+1" + "(" * LONG, ""),
    ("@" * LONG, ""), ("\n" * LONG + "a@b.cd", "email")], ids=lambda value: str(len(value)))
def test_long_runs_neither_crash_nor_stall(documents, text, kinds):
    begin = time.monotonic()
    frame = identifiers.find(documents([(1, text), (2, "dial +49 30 1234567 now")]))
    found = {r.doc_id: r.spans for r in frame.collect()}
    assert [(s.kind, s.start) for s in found[2]] == [("phone", 5)]
    assert [s.kind for s in found[1]] == kinds.split()
    assert time.monotonic() - begin < 60


def test_shapes_of_long_words(spark):
    words = spark.createDataFrame([("1." * 200_000,), ("a" * 400_000,), ("1.2.3",), ("1.2",)], "word string")
    assert [r[0] for r in words.select(identifiers.has_shape(F.lit("ip"), F.col("word"))).collect()] == [True, False, True, False]


def test_identifier_query(spark, sf_dir):
    given = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    found = QUERIES["op10_contextual_identifiers"](spark, sf_dir).collect()
    assert {r.doc_id for r in found} == set(given) and len(found) == len(given)
    for r in found:
        own = base_of(given[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == kind for *_, k in own) for kind in BASE]
        assert r.base_sha256 == hashlib.sha256(spelled(own).encode()).hexdigest()
        assert set(spelled(own).split(",")) - {""} <= set(r.spans.split(","))
