"""Toxicity, decontamination and the pipeline."""

import random
import tracemalloc

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from annomill.llm import decontamination, toxicity
from annomill.llm.queries import CATEGORIES, QUERIES
from annomill.llm.words import Powers


def labelled(rng, n):
    docs, labels = [], []
    for i in range(n):
        words = [f"w{rng.randrange(300)}" for _ in range(rng.randint(5, 80))]
        low, toxic = rng.random() < 0.3, rng.random() < 0.3
        if low:
            words += ["junk", "spam!"] * 2
        if toxic:
            words += ["Awful,", "nasty"]
        rng.shuffle(words)
        docs.append((i, " ".join(words)))
        labels.append((i, int(not low), int(toxic)))
    return docs, labels


def label_frame(spark, labels):
    return spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_accuracy_and_odd_rows(spark, documents):
    docs, labels = labelled(random.Random(1), 900)
    chain = toxicity.train(documents(docs), label_frame(spark, labels[:600] + [(5000, None, None), (None, 1, 0)]), CATEGORIES)
    odd = [(2000, None), (2001, ""), (2001, ""), (None, "awful nasty"), (2002, "awful nasty " * 30_000)]
    frame = documents(docs[600:] + odd).withColumn("p_toxic", F.lit("clash"))
    rows = {r.doc_id: r for r in toxicity.judge(frame, chain).collect()}
    right = sum((rows[i].p_toxic >= 0.5) == bool(toxic) for i, _, toxic in labels[600:])
    assert right >= 0.97 * 300
    assert sum((rows[i].p_low_quality >= 0.5) == (quality == 0) for i, quality, _ in labels[600:]) >= 0.97 * 300
    assert rows[2000].p_toxic == rows[2001].p_toxic < 0.5 <= rows[None].p_toxic
    assert rows[2002].p_toxic >= 0.5
    assert [link["name"] for link in chain] == ["low_quality", "toxic"]
    assert len(chain[1]["weights"]) == len(chain[1]["slots"]) + 2


def test_without_labels_nothing_is_toxic(spark, documents):
    docs = documents([(1, "a b"), (2, "c")])
    for labels in ([], [(1, 1, 0), (2, 1, 0)], [(1, None, None)], [(77, 1, 1)]):
        chain = toxicity.train(docs, label_frame(spark, labels), CATEGORIES)
        assert all(r.p_toxic < 0.5 for r in toxicity.judge(docs, chain).collect())
    assert toxicity.judge(documents([]), chain).count() == 0


def test_toxicity_query_against_labels(spark, sf_dir):
    """Every document is judged; clean labelled ones are left alone and most toxic ones found."""
    found = QUERIES["op9_toxicity_chain"](spark, sf_dir)
    assert found.count() == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", F.col("toxic").alias("label"))
    rows = found.join(labels, "doc_id").select("toxic", "label").collect()
    assert sum(r.toxic for r in rows if not r.label) <= 0.01 * len(rows)
    assert sum(r.toxic for r in rows if r.label) >= 0.4 * sum(r.label for r in rows)


BENCH = [(1, "the quick brown fox jumps over the lazy dog while seven green parrots watch from an old oak tree"),
         (2, "short item here"), (3, None), (4, ""), (5, " ".join(f"long{n}" for n in range(150))),
         (6, "which planet is the largest one of the solar system the answer is of course jupiter")]


def noise(rng, n):
    return [f"n{rng.randrange(4000)}" for _ in range(n)]


def plain_share(item, text):
    """Longest common subsequence by the table, over all stretches of twice the item's length."""
    item, words = item.lower().split(), text.lower().split()
    best = 0
    for begin in range(0, max(1, len(words) - len(item) + 1)):
        near = words[begin:begin + 2 * len(item)]
        row = np.zeros(len(item) + 1, dtype=int)
        for word in near:
            new = row.copy()
            for j, own in enumerate(item):
                new[j + 1] = row[j] + 1 if own == word else max(row[j + 1], new[j])
            row = new
        best = max(best, row[-1])
    return best / len(item)


def test_planted_items_are_found(spark, documents):
    rng = random.Random(3)
    docs, planted = [], {}
    for n in range(400):
        words = noise(rng, rng.randint(1, 400))
        if n % 8 == 0:
            item = rng.choice([b for b in BENCH if b[1]])
            inside = item[1].split()
            if item[0] != 2 and rng.random() < 0.5:  # reworded a little
                for _ in range(len(inside) // 12 + 1):
                    inside[rng.randrange(len(inside) // 2)] = "other"
            at = rng.randint(0, len(words))
            words[at:at] = [w.upper() + "," if rng.random() < 0.3 else w for w in inside]
            planted[n] = item[0]
        docs.append((n, " ".join(words)))
    docs += [(1000, None), (1001, ""), (1002, "w " * 30_000 + BENCH[0][1] + " w" * 30_000), (None, BENCH[5][1]), (1003, docs[8][1])]
    bench = spark.createDataFrame(BENCH + [BENCH[0]], "item_id long, text string")
    frame = documents(docs).withColumn("item_id", F.lit("clash"))
    rows = decontamination.find(frame, bench).collect()
    assert len(rows) == len(docs)
    found = {r.doc_id: r for r in rows}
    missed = [n for n, item in planted.items() if item not in (found[n]["items"] or [])]
    assert not missed
    wrong = [r.doc_id for r in rows if r.contaminated and r.doc_id not in planted and r.doc_id not in (1002, 1003, None)]
    assert not wrong
    assert found[1002].item_id == 1 and found[None].item_id == 6 and found[1003].contaminated
    assert not found[1000].contaminated and not found[1001].contaminated


def test_reworded_items_need_the_answer(spark, documents):
    words = BENCH[5][1].split()
    rng = random.Random(9)
    for i in (1, 3, 5, 7, 9):
        words[i] = f"other{i}"
    with_answer = " ".join(noise(rng, 60) + words + noise(rng, 60))
    without = " ".join(noise(rng, 60) + words[:-4] + noise(rng, 64))
    docs = documents([(n, " ".join(noise(rng, 100))) for n in range(100)] + [(200, with_answer), (201, without)])
    found = {r.doc_id: r.contaminated for r in decontamination.find(docs, spark.createDataFrame(BENCH, "item_id long, text string")).collect()}
    assert found[200] and not found[201]


def reworded(rng, words, share, others):
    """All but the last quarter's words replaced at random, so that ``share`` of all stays."""
    out, open_places = list(words), range(len(words) - max(1, len(words) // 4))
    for i in rng.sample(open_places, int((1 - share) * len(words) + 1e-9)):
        out[i] = rng.choice(others)
    return out


def test_reworded_items_in_real_documents(spark, sf_dir, documents):
    """Each item with 0.6 of its words and the answer left, in texts of the corpus, wherever it stands."""
    rng = random.Random(17)
    texts = [r.text.split() for r in spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").limit(400).collect() if r.text]
    texts = [words for words in texts if 20 <= len(words) <= 600]
    others = [word for words in texts for word in words]
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    docs, planted = [], {}
    for item in bench.orderBy("item_id").collect():
        for share in (1.0, 0.8, 0.7, 0.6, 0.6):
            words = list(rng.choice(texts))
            at = rng.randint(0, len(words))
            words[at:at] = reworded(rng, item.text.split(), share, others)
            planted[len(docs)] = (item.item_id, share)
            docs.append((len(docs), " ".join(words)))
    rows = {r.doc_id: r["items"] or [] for r in decontamination.find(documents(docs), bench).collect()}
    assert len(planted) > 100
    assert [(n, own) for n, own in planted.items() if own[0] not in rows[n]] == []


def test_words_spread_over_twice_the_item(spark, documents):
    """39 of 64 words, the answer among them, evenly over 128 words: a passage of 64 words holds few of them."""
    rng = random.Random(5)
    item = [f"own{n}" for n in range(64)]
    kept = [*sorted(rng.sample(range(48), 23)), *range(48, 64)]
    docs = [(n, " ".join(noise(rng, 150))) for n in range(60)]
    for n in range(32):
        words = noise(rng, 128)
        for place, own in zip(np.linspace(0, 127, len(kept)).astype(int), kept):
            words[place] = item[own]
        docs.append((100 + n, " ".join(noise(rng, 40 + n) + words + noise(rng, 50))))
    bench = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    found = {r.doc_id for r in decontamination.find(documents(docs), bench).collect() if r.contaminated}
    assert found == set(range(100, 132))


def rule_holds(item, text):
    """The rule in every stretch of twice the item's length, whichever word it starts with."""
    item, words = item.lower().split(), text.lower().split()
    answer = item[-max(1, len(item) // 4):]
    masks, own = decontamination.masks_of(np.array(item)), decontamination.masks_of(np.array(answer))
    for begin in range(len(words)):
        near = words[begin:begin + 2 * len(item)]
        share = decontamination.common(near, masks, len(item)) / len(item)
        if share >= 0.8 or (share >= 0.6 and decontamination.common(near, own, len(answer)) / len(answer) >= 0.8):
            return True
    return False


def test_rule_in_every_stretch(spark, documents):
    """Items with words put in and left out, at any place, against the rule in all stretches."""
    rng = random.Random(21)
    bench = [(n, " ".join(noise(rng, length))) for n, length in enumerate([9, 12, 16, 24, 33, 40, 64, 65, 90])]
    docs = []
    for n in range(270):
        item = bench[n % len(bench)][1].split()
        lost = set(rng.sample(range(len(item)), int(rng.choice([0.15, 0.3, 0.4]) * len(item))))
        words = []
        for place, word in enumerate(item):
            words += noise(rng, rng.choice([0, 0, 1, 2])) + ([] if place in lost else [word])
        docs.append((n, " ".join(noise(rng, rng.randint(0, 90)) + words + noise(rng, rng.randint(0, 90)))))
    expected = {(n, i) for n, text in docs for i, item in bench if rule_holds(item, text)}
    rows = decontamination.find(documents(docs), spark.createDataFrame(bench, "item_id long, text string")).collect()
    assert 100 < len(expected) < 250
    assert {(r.doc_id, i) for r in rows for i in r["items"] or []} == expected


def test_no_items_or_no_documents(spark, documents):
    none = spark.createDataFrame([], "item_id long, text string")
    assert [r.contaminated for r in decontamination.find(documents([(1, "a b c")]), none).collect()] == [False]
    bench = spark.createDataFrame(BENCH, "item_id long, text string")
    assert decontamination.find(documents([]), bench).count() == 0


def most_megabytes(call):
    tracemalloc.start()
    out = call()
    size = tracemalloc.get_traced_memory()[1] / 1e6
    tracemalloc.stop()
    return out, size


def test_counting_blocks_keeps_no_texts():
    text = [" ".join(f"w{n}x{i % 50}" for i in range(30_000)) for n in range(24)]
    batch = pa.RecordBatch.from_pydict({"text": text})
    (counts, sampled), size = most_megabytes(lambda: list(decontamination._counted(iter([batch] * 4))))
    assert size < 40
    total = counts.column("n").to_numpy()[counts.column("term").to_numpy() < 0]
    assert total.tolist() == [4 * 24 * -(-30_000 // decontamination.BLOCK)]
    assert sampled.num_rows == decontamination.TASK_BLOCKS
    assert set(map(len, sampled.column("terms").to_pylist())) <= {decontamination.BLOCK, 30_000 % decontamination.BLOCK}


def test_latent_terms_multiplies_few_columns_at_a_time():
    rng = np.random.default_rng(5)
    terms = [rng.integers(0, 1 << decontamination.TERM_BITS, 32) for _ in range(1_400)]
    basis = rng.standard_normal((1 << decontamination.TERM_BITS, 72)).astype(np.float32)
    row, term, value = decontamination.weighted(terms, np.ones(1 << decontamination.TERM_BITS))
    (found, out), size = most_megabytes(lambda: decontamination.products(row, term, value, basis))
    left = np.zeros((len(terms), 72))
    np.add.at(left, row, basis[term] * value[:, None])
    right = np.zeros(basis.shape)
    np.add.at(right, term, left[row] * value[:, None])
    assert np.allclose(out, right[found], atol=1e-12) and not np.delete(right, found, axis=0).any()
    assert size < 40


def test_benchmark_items_reach_spark_without_python_workers(spark, documents, monkeypatch):
    given = []
    latent = decontamination.latent_terms
    monkeypatch.setattr(decontamination, "latent_terms", lambda rows, idf: given.append(rows) or latent(rows, idf))
    items = spark.createDataFrame([(1, "a b c d e f g h")], "item_id long, text string")
    decontamination.find(documents([(1, "so a b c d e f g h it is")]), items)
    text = given[0]._jdf.queryExecution().toRdd().toDebugString()
    assert "Python" not in text


def test_latent_terms_come_from_all_blocks(spark, documents, monkeypatch):
    """Also the words of blocks that are not in the sample have coordinates."""
    given = []
    embedded = decontamination.embedded
    monkeypatch.setattr(decontamination, "SAMPLE_BLOCKS", 5)
    monkeypatch.setattr(decontamination, "embedded", lambda terms, rows: given.append(rows.copy()) or embedded(terms, rows))
    docs = documents([(n, " ".join(f"d{n}w{i}" for i in range(40))) for n in range(30)] + [(99, None), (None, "")])
    items = spark.createDataFrame([(1, "a b c d e f g h")], "item_id long, text string")
    decontamination.find(docs, items)
    words = [f"d{n}w{i}" for n in range(30) for i in range(40)]
    part = pa.RecordBatch.from_pydict({"t": words})
    term = decontamination.term_of(decontamination.words_of(part, "t", Powers())[1])
    assert np.abs(given[0][term]).max(axis=1).min() > 0


def test_pipeline_decomposes_all_blocks_of_its_documents(spark, sf_dir, documents, monkeypatch):
    given = []
    whole = decontamination.over_all_blocks
    monkeypatch.setattr(decontamination, "SAMPLE_BLOCKS", 5)
    monkeypatch.setattr(decontamination, "over_all_blocks", lambda docs, *more: given.append(docs.count()) or whole(docs, *more))
    docs = documents([(n, " ".join(f"d{n}w{i}" for i in range(40))) for n in range(30)])
    assert corpus_pipeline.without_benchmark(spark, docs, sf_dir).count() == 30
    assert given == [30]


def test_rounds_over_all_blocks_multiply_by_the_whole_matrix(spark, documents):
    rng = random.Random(4)
    rows = [(n, " ".join(rng.choice("abcdefghijklmnop") * rng.randint(1, 3) for _ in range(rng.randint(0, 200)))) for n in range(60)]
    part = pa.RecordBatch.from_pydict({"t": [text for _, text in rows]})
    found, hashes = decontamination.words_of(part, "t", Powers())
    start, _ = decontamination.blocks_of(found)
    terms = [decontamination.term_of(hashes[a:b]) for a, b in zip(start[:-1], start[1:])]
    passages, idf = [terms[3], terms[7]], np.random.default_rng(1).random(1 << decontamination.TERM_BITS) + 1
    coordinates = np.random.default_rng(2).standard_normal((1 << decontamination.TERM_BITS, 4)).astype(np.float32)
    ours = decontamination.over_all_blocks(documents(rows), "text", passages, idf, coordinates)
    further = np.random.default_rng(11).standard_normal((1 << decontamination.TERM_BITS, decontamination.OVERSAMPLE)).astype(np.float32)
    basis = np.hstack([coordinates, further])
    expected = np.zeros_like(basis)
    at, out = decontamination.products(*decontamination.weighted(terms + passages, idf), basis)
    expected[at] = out
    expected = decontamination.orthonormal(expected)[:, :4]
    assert np.allclose(np.abs((ours * expected).sum(axis=0)), 1, atol=1e-3)


def test_searching_holds_a_small_table_of_items():
    rng = np.random.default_rng(6)
    words = np.unique(rng.integers(1, 1 << 63, 30_000).astype(np.uint64))
    items = [decontamination.Item(i, rng.choice(words, 20), words[:1]) for i in range(2_000)]
    known = decontamination.Known(items, np.ones(1 << decontamination.TERM_BITS))
    hashes = rng.choice(words, 64_000)
    hashes[640:660] = items[7].words
    start, doc = np.arange(0, 64_001, decontamination.BLOCK), np.arange(2_000) // 8
    (item, block), size = most_megabytes(lambda: known.candidates(known.places(hashes), start, doc))
    assert (7, 20) in set(zip(item.tolist(), block.tolist()))
    assert size < 40


def test_looking_up_words_keeps_those_chosen():
    rng = np.random.default_rng(7)
    words = pd.Series([np.unique(rng.integers(0, 1 << 20, n)).astype(np.int32) for n in rng.integers(0, 600, 6_000)])
    chosen = sorted(rng.choice(1 << 20, 1_024, replace=False).tolist())
    (row, place), size = most_megabytes(lambda: toxicity.marks_of(words, chosen))
    at = {slot: i for i, slot in enumerate(chosen)}
    marks = [(i, at[slot]) for i, own in enumerate(words) for slot in own.tolist() if slot in at]
    assert list(zip(row.tolist(), place.tolist())) == marks
    assert size < 20
    assert [x.tolist() for x in toxicity.marks_of(words, [])] == [x.tolist() for x in toxicity.marks_of(words[:0], chosen)] == [[], []]


def test_common_is_the_longest_common_subsequence():
    rng = random.Random(8)
    for _ in range(200):
        item = [rng.randrange(6) for _ in range(rng.randint(1, 30))]
        text = [rng.randrange(8) for _ in range(rng.randint(0, 40))]
        table = [[0] * (len(item) + 1) for _ in range(len(text) + 1)]
        for i, word in enumerate(text):
            for j, own in enumerate(item):
                table[i + 1][j + 1] = table[i][j] + 1 if own == word else max(table[i][j + 1], table[i + 1][j])
        assert decontamination.common(text, decontamination.masks_of(np.array(item)), len(item)) == table[-1][-1]


def test_every_verbatim_item_is_found(spark, sf_dir):
    """Recall of the query against a search for each item's text, at least 0.9 asked for."""
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    expected = {(doc, item) for doc, text in docs.items() for item, own in items if own in text}
    rows = QUERIES["op8_latent_decontamination"](spark, sf_dir).collect()
    found = {(r.doc_id, item) for r in rows for item in r["items"] or []}
    assert len(rows) == len(docs) and len(expected) > 5
    assert len(expected & found) >= 0.99 * len(expected)
    assert len({doc for doc, _ in found} - {doc for doc, _ in expected}) <= 0.01 * len(docs)


def test_stages(spark, sf_dir, documents):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "line_dedup", "near_dedup", "decontamination", "packing"]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, kept, sf_dir).cache()
        assert out.columns == docs.columns
        assert 0 < out.count() <= kept.count()
        assert out.join(kept, "doc_id", "left_anti").isEmpty()
        kept = out
    pieces = corpus_pipeline.STAGES[-1][1](spark, kept, sf_dir)
    assert pieces.select("doc_id").distinct().count() == kept.count()
    whole = corpus_pipeline.run(spark, sf_dir)
    key = ["doc_id", "doc_tokens"]
    assert sorted(map(tuple, whole.select(key).distinct().collect())) == sorted(map(tuple, pieces.select(key).distinct().collect()))


def test_stages_on_odd_rows(spark, sf_dir, documents):
    docs = documents([(1, None), (2, ""), (3, "x"), (3, "x"), (None, "some words in a text without an id"), (4, "y " * 20_000)])
    kept = docs
    for _, stage in corpus_pipeline.STAGES:
        kept = stage(spark, kept, sf_dir)
    assert kept.count() > 0
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, documents([]), sf_dir).count() == 0
