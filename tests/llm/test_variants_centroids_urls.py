"""Spelling variants, table centroids and URL filters against plain versions."""

import collections
import hashlib
import math
import random

import numpy as np
import pytest

from annomill.llm import centroids, urls, variants
from annomill.llm.queries import QUERIES, RULES


# Variants


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + (len(a) == len(b)):] == b[i + 1:]


def grouped(counts):
    out = {}
    for word, n in counts.items():
        partners = [w for w in counts if near(word, w)]
        best = min(partners, key=lambda w: (-counts[w], w), default=None)
        out[word] = (n, len(partners), best if best and counts[best] >= 10 * n else None)
    for word, (n, some, form) in list(out.items()):
        root = word
        while out[root][2]:
            root = out[root][2]
        out[word] = (n, some, form, counts[form] if form else None, root)
    return out


def vocabulary(letters, seed, count=150, low=1, high=9):
    rng, words = random.Random(seed), set()
    while len(words) < count:
        word = "".join(rng.choice(letters) for _ in range(rng.randint(low, high)))
        words |= {word, word[1:] or "a", word + rng.choice(letters), rng.choice(letters) + word[1:]}
    return {word: rng.choice([2, 3, 20, 30, 300, 4000]) for word in words}


def found(frame):
    rows = frame.collect()
    assert len({r.word for r in rows}) == len(rows)
    return {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in rows}


@pytest.mark.parametrize("letters,options", [
    ("ab", {}), ("abcé", {"bucket_chars": 60}), ("abß\u4e2d\U0001f600", {"bucket_chars": 200}),
    ("ab", {"hot_words": 3}), ("abc", {"hot_words": 5, "bucket_chars": 100, "refinements": 1})])
def test_variants_are_those_of_all_pairs(letters, options, spark):
    counts = vocabulary(letters, letters)
    frame = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(5)
    assert found(variants.group(frame, **options)) == grouped(counts)


def test_a_half_that_all_words_share(spark):
    rng = random.Random(7)
    counts = {"international" + "".join(rng.choice("abcd") for _ in range(rng.randint(3, 6))): rng.choice([2, 50]) for _ in range(120)}
    frame = spark.createDataFrame(list(counts.items()), "word string, n long")
    cut = variants.spread(variants.places(frame), 10, variants.REFINEMENTS)
    assert max(r["count"] for r in cut.groupBy("key").count().collect()) < 60
    assert found(variants.group(frame, hot_words=10)) == grouped(counts)


def test_index_with_sampled_counts(monkeypatch):
    words = sorted(vocabulary("abcd", 5))
    searches = [(i, side, half) for i, w in enumerate(words) for side in (0, 1) for half in {len(w) // 2, (len(w) - 1) // 2}]
    dense = variants.near_within(words, searches)
    monkeypatch.setattr(variants, "TABLE_BYTES", 600)
    sampled = variants.near_within(words, searches)
    assert all((a == b).all() for a, b in zip(dense, sampled))
    assert set(zip(*[x.tolist() for x in dense])) == {
        (i, j) for i, a in enumerate(words) for j, b in enumerate(words) if near(a, b)}


def test_index_keeps_both_intervals_in_step():
    symbols, size = variants.coded(["abab", "bab", "aab"])
    text, _ = variants.joined(symbols)
    forward, backward = variants.Index(text, size), variants.Index(text[::-1], size)
    rotations = lambda t: sorted(["".join(map(str, np.roll(t, -i))) for i in range(len(t))])
    state = np.array([0]), np.array([0]), np.array([len(text)])
    grown = ""
    for symbol in (2, 1):
        state = forward.one(*state, np.array([symbol]))
        grown = str(symbol) + grown
    low, other, count = (int(x[0]) for x in state)
    assert all(r.startswith(grown) for r in rotations(text)[low:low + count])
    assert all(r.startswith(grown[::-1]) for r in rotations(text[::-1])[other:other + count])
    assert count == sum(r.startswith(grown) for r in rotations(text))


def test_odd_vocabularies(spark):
    rows = [(None, 3), ("", 5), ("word", None), ("colour", 2), ("colour", 1), ("color", 400), ("x" * 5000, 2), ("x" * 4999, 90)]
    frame = spark.createDataFrame([(w, n, "r", 1, "k") for w, n in rows], "word string, n long, root string, key int, bucket string")
    assert found(variants.group(frame)) == grouped({"colour": 3, "color": 400, "x" * 5000: 2, "x" * 4999: 90})
    assert variants.group(frame.where("false")).count() == 0
    assert found(variants.group(spark.createDataFrame([("alone", 2)], "word string, n long"))) == {"alone": (2, 0, None, None, "alone")}


def test_roots_at_the_end_of_long_chains(spark):
    counts = {"a" * (10 + i): 2 * 10 ** i for i in range(9)}
    assert found(variants.group(spark.createDataFrame(list(counts.items()), "word string, n long"))) == grouped(counts)
    assert grouped(counts)["a" * 10][4] == "a" * 18


def test_runs_of_letters(spark):
    docs = spark.createDataFrame([(1, "Élan éLAN x1y naïve-Straße", 9), (None, None, 9), (2, "", 9), (3, "Aa" * 40_000, 9)],
                                 "doc_id long, text string, run int")
    assert collections.Counter(r.run for r in variants.runs(docs).collect()) == collections.Counter(
        ["Élan", "élan", "x", "y", "naïve", "straße", "aa" * 40_000])
    counted = variants.words(variants.runs(docs).withColumnRenamed("run", "word"), 4, 1).collect()
    assert {r.word: r.n for r in counted if len(r.word) < 9} == {"Élan": 1, "élan": 1, "naïve": 1, "straße": 1}


# Centroids


def plain_clusters(vectors, clusters, rounds, scale, width):
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in vectors if v is not None and len(v) == width
            and all(x is not None and math.isfinite(x) and math.isfinite(scale * x) for x in v)]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centers = [list(v) for _, v in order[:clusters]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centers)) for _, v in kept]

    for _ in range(rounds):
        nearest = assign()
        for n in range(len(centers)):
            mine = [v for (_, v), (_, c) in zip(kept, nearest) if c == n]
            if mine:
                centers[n] = [sum(column) // len(mine) for column in zip(*mine)]
    nearest = assign()
    sums = collections.Counter()
    for d, n in nearest:
        sums[n] += d
    cut = lambda x: x if x < 1 << 63 else None
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centers]
    return sorted(((i, n, cut(d), cut(sums[n]), cut(sum(sums.values())), digests[n])
                   for (i, _), (d, n) in zip(kept, nearest)), key=repr)


COLUMNS = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def clustered(spark, vectors, clusters, rounds, scale, width, kind="float"):
    rows = [(i, v, 0, "x", "y") for i, v in vectors]
    frame = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, id int, vector string, cluster string")
    result, _ = centroids.cluster(frame.repartition(4), clusters, rounds, scale=scale, width=width)
    return sorted((tuple(r) for r in result.select(COLUMNS).collect()), key=repr)


def test_clusters_are_those_of_plain_rounds(spark):
    rng = random.Random(3)
    vectors = [(i % 90, [rng.randrange(-64, 64) / 32 for _ in range(4)]) for i in range(300)]
    odd = [(500, None), (501, []), (502, [1.0, 2.0]), (503, [1.0, None, 1.0, 1.0]), (504, [float("nan")] * 4),
           (505, [float("inf"), 0.0, 0.0, 0.0]), (None, [0.5] * 4), (None, [0.5] * 4), (506, [0.0, -0.0, 0.0, 0.0])]
    for clusters in (1, 7):
        expected = plain_clusters(vectors + odd, clusters, 3, 8.0, 4)
        assert clustered(spark, vectors + odd, clusters, 3, 8.0, 4) == expected and len(expected) == 303


def test_values_beyond_64_bits(spark):
    vectors = [(i, [2.0 ** (i * 7), -(2.0 ** (90 - i)), 3.25]) for i in range(12)] + [(99, [1e308, 1.0, 1.0])]
    assert clustered(spark, vectors, 3, 2, 64.0, 3, "double") == plain_clusters(vectors, 3, 2, 64.0, 3)


def test_few_or_no_vectors(spark):
    assert clustered(spark, [(1, None)], 5, 3, 1.0, 2) == []
    assert clustered(spark, [(1, [1.0, 2.0]), (1, [1.0, 2.0])], 5, 3, 1.0, 2) == plain_clusters(
        [(1, [1.0, 2.0]), (1, [1.0, 2.0])], 5, 3, 1.0, 2)


def test_tables_give_squared_differences():
    rng = np.random.default_rng(1)
    block, centers = rng.integers(-40, 40, (50, 6)), rng.integers(-40, 40, (3, 6))
    assert (centroids.distances(block, centers) == ((block[:, None] - centers[None]) ** 2).sum(2)).all()


# URLs

ODD_URLS = [None, "", "no scheme", "http://", "://", "http:///path", "http://NET/", "http://net", "http://x.Example.NET/en/1?q#f",
            "https://example.net/EN/", "http://notexample.net/en/", "http://a..net/x", "http://example.net./en/",
            "http://example.com/de/a", "http://example.com/de", "http://x.org/fr/", "http://org/fr/", "http://x.org:80/fr/a",
            "http://é.net/ü?x=1", "http://a.net?x/y", "http://a.net#x", "a://b://c.net/", "http://x.org/fr/\n", "http://" + "a." * 3000 + "net/p",
            "http://x.com/" + "p/" * 5000, "http://X.com/a/?b=2&a=1&utm_source=z", "https://www.x.com:443/a?a=1&b=2#top", "HTTP://x.com/a?a=1&b=2"]


def host_and_path(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    return host, path[:min([path.find(c) for c in "?#" if c in path], default=len(path))]


def ruled(url, rules):
    host, path = host_and_path(url)
    fitting = []
    for rule, verdict in rules:
        h, slash, p = rule.partition("/")
        if url and "://" in url and (host == h or host.endswith("." + h)) and path.startswith(slash + p):
            fitting.append((len(rule), len(h), rule, verdict == "block"))
    return max(fitting, default=None)


def listing(spark, rules, whole=()):
    rows = [(r, False, v) for r, v in rules] + [(u, True, "block") for u in whole]
    return spark.createDataFrame(rows, "entry string, whole boolean, verdict string")


def test_rules_for_hosts_and_paths(spark):
    rules = [*RULES, ("x.org/fr/", "block"), ("com", "allow"), ("x.com/p/p/p", "block"), ("x.com/p/p/p", "allow"), ("org/fr/a", "block")]
    pages = spark.createDataFrame([(n % 20, u, "h", "k") for n, u in enumerate(ODD_URLS * 2)],
                                  "page_id int, url string, host string, key string")
    result = urls.judge(pages, listing(spark, rules).unionByName(
        spark.createDataFrame([(None, False, "block"), ("net/", None, "block"), ("net/en/", False, None)],
                              "entry string, whole boolean, verdict string")))
    expected = []
    for n, url in enumerate(ODD_URLS * 2):
        best = ruled(url, rules)
        verdict = "allow" if best is None else "block" if max(v == "block" for r, v in rules if r == best[2]) else "allow"
        expected.append((n % 20, *host_and_path(url), best[2] if best else None, verdict))
    assert sorted((tuple(r) for r in result.select("page_id", "host", "path", "rule", "verdict").collect()), key=repr) == sorted(expected, key=repr)


def test_listed_urls_and_canonical_form(spark):
    pages = spark.createDataFrame(list(enumerate(ODD_URLS)), "page_id int, url string")
    listed = urls.repeated(pages)
    assert [r.entry for r in listed.collect() if r.entry.startswith("x.com")] == ["x.com/a?a=1&b=2"]
    result = {r.page_id: r for r in urls.judge(pages, listed).collect()}
    assert {n for n, r in result.items() if r.entry == "x.com/a?a=1&b=2"} == set(range(len(ODD_URLS) - 3, len(ODD_URLS)))
    assert all((r.verdict == "block") == (r.entry is not None) and r.rule is None for r in result.values())


def test_filter_passes_all_entries_and_the_join_removes_the_rest(spark):
    known = urls.entries(listing(spark, [], [f"x.com/{n}" for n in range(600)]))
    for blocks, least, most in ((1, 400, 601), (64, 0, 30)):
        keys = spark.range(1200).selectExpr("concat('=x.com/', id) AS key", "id AS block")
        passed = {r.block for r in urls.passing(keys.withColumnRenamed("block", "n"), urls.bloom(known, blocks), blocks)
                  .select("key", urls.F.col("n").alias("block")).collect()}
        assert set(range(600)) <= passed and least <= len(passed) - 600 < most
    pages = spark.range(1200).selectExpr("id AS page_id", "concat('http://x.com/', id) AS url")
    blocked = urls.judge(pages, known.select("entry", "whole", "verdict")).where("verdict = 'block'").collect()
    assert {r.page_id for r in blocked} == set(range(600))


def test_large_lists_and_hot_urls(spark, monkeypatch):
    """The ways of lists that are not broadcast, and of keys with many rows."""
    monkeypatch.setattr(urls, "fits_in_memory", lambda frame: False)
    monkeypatch.setattr(urls.sliced_join, "__defaults__", ("inner", 7, None))
    pages = spark.createDataFrame([(n, f"http://a{n % 3 * n}.net/x") for n in range(200)], "page_id int, url string")
    result = urls.judge(pages, listing(spark, RULES))
    assert result.groupBy("rule", "verdict").count().collect() == [("net/", "block", 200)]


def test_empty_lists_and_tables(spark):
    pages = spark.createDataFrame(list(enumerate(ODD_URLS)), "page_id int, url string")
    assert urls.judge(pages, listing(spark, [("net/", "block")]).where("false"), otherwise="block").where(
        "verdict = 'block' AND entry IS NULL").count() == len(ODD_URLS)
    assert urls.judge(pages.where("false"), listing(spark, RULES)).count() == 0


def test_url_plan_is_native(spark, sf_dir):
    frame = QUERIES["op13_bloom_urls"](spark, sf_dir)
    plan = spark._jvm.PythonSQLUtils.explainString(frame._jdf.queryExecution(), "formatted")
    for operator in ("Python", "Arrow", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin", "ExistingRDD"):
        assert operator not in plan
