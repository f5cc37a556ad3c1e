"""A classifier chain for toxicity categories.

Categories are learned in order.  Each has a linear model over the words that
tell it apart; from the second on a model also sees the probabilities of the
categories before it.  In training these come from models that have not seen the
document (out of fold), in use from the final models, so both are alike.

Models are fitted on at most ``SAMPLE_ROWS`` labelled rows, those with the lowest
hash of their id; the words of every document count when it is judged.  Words are
runs of letters and digits, capitals as small ones, hashed to 2**20 slots.

Defined cases: NULL or empty text has no words and gets the probability of the
intercepts; a label that is NULL is left out of its category; a category without
both kinds of labels has no words and its share of positive labels (0 without any
label); repeated rows are judged one by one; columns other than the named ones
are carried along by ``judge`` unless called as its results are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stored
from .words import Powers, give_back, letters_and_digits, slices, small_batches, texts

SAMPLE_ROWS = 20_000
SLOT_BITS = 20
FOLDS = 5
#: Words kept for a category, by their chi-squared score, and the least score.
CATEGORY_WORDS = 1_024
LEAST_SCORE = 15.0
STEPS = 300
#: Texts whose words are looked up at once.
ROWS = 512
RIDGE = 1e-5


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


def slots(part: pa.RecordBatch, column: str, powers: Powers):
    """The slot of each word of a few texts, and the text it is in."""
    found = texts(part, column, letters_and_digits())
    return found, (found.hashes(powers, seed=9) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def _distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct slots of each sampled text beside its labels."""
    powers = Powers()
    for batch in batches:
        for part in slices(batch, "text"):
            found, slot = slots(part, "text", powers)
            pairs = np.unique(found.doc * (1 << SLOT_BITS) + slot)
            edges = np.searchsorted(pairs >> SLOT_BITS, np.arange(found.n + 1))
            words = pa.ListArray.from_arrays(pa.array(edges, pa.int32()),
                                             pa.array(pairs & ((1 << SLOT_BITS) - 1), pa.int32()))
            kept = part.drop_columns(["text"])
            yield pa.RecordBatch.from_arrays([*kept.columns, words], names=[*kept.schema.names, "words"])
    give_back()


def sample(docs: DataFrame, labels: DataFrame, categories: dict[str, str], rows: int) -> DataFrame:
    """Words and labels of the sampled documents: ``doc_id, fold, y0.., words``."""
    marks = [F.expr(rule).cast("double").alias(f"y{i}") for i, rule in enumerate(categories.values())]
    chosen = (
        labels.select("doc_id", *marks).where("doc_id IS NOT NULL")
        .orderBy(F.xxhash64("doc_id"), "doc_id", *[f"y{i}" for i in range(len(marks))]).limit(rows)
        .withColumn("fold", F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(FOLDS)).cast("int"))
    )
    texts_of = docs.selectExpr("doc_id", "CAST(text AS STRING) AS text")
    joined = texts_of.join(F.broadcast(chosen), "doc_id")
    fields = ", ".join(["doc_id long", *[f"y{i} double" for i in range(len(marks))], "fold int", "words array<int>"])
    return stored(joined.select("doc_id", *[f"y{i}" for i in range(len(marks))], "fold", "text")
                  .mapInArrow(_distinct, fields), "toxicity-sample")


def telling_words(rows: DataFrame, label: str) -> list[int]:
    """The slots with the highest chi-squared score; at most ``CATEGORY_WORDS``."""
    known = rows.where(F.col(label).isNotNull())
    total = known.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(label), F.lit(0.0)).alias("p")).first()
    n, p = total.n, total.p
    if not 0 < p < n:
        return []
    counts = known.select(F.explode("words").alias("slot"), label).groupBy("slot").agg(
        F.count(F.lit(1)).alias("a"), F.sum(label).alias("b"))
    cross = F.col("b") * n - F.col("a") * p
    score = cross * cross / (F.col("a") * (n - F.col("a")) * p * (n - p)) * n
    scored = counts.where((F.col("a") >= 5) & (F.col("a") < n)).withColumn("score", score)
    best = scored.where(F.col("score") >= LEAST_SCORE).orderBy(F.desc("score"), "slot").limit(CATEGORY_WORDS)
    return sorted(row.slot for row in best.collect())


def fit(row: np.ndarray, column: np.ndarray, dense: np.ndarray, y: np.ndarray, width: int) -> np.ndarray:
    """Ridge logistic regression over word marks, dense inputs and an intercept."""
    n, extra = len(y), dense.shape[1]
    weights = np.zeros(width + extra + 1)
    if not 0 < y.sum() < n:
        weights[-1] = np.log((y.sum() + 0.5) / (n - y.sum() + 0.5)) if n else -30.0
        return weights
    first, second = np.zeros_like(weights), np.zeros_like(weights)
    for step in range(1, STEPS + 1):
        error = sigmoid(predict(row, column, dense, n, weights)) - y
        slope = np.concatenate([
            np.bincount(column, weights=error[row], minlength=width), dense.T @ error, [error.sum()]]) / n
        slope[:-1] += RIDGE / 2 * weights[:-1]
        first = 0.9 * first + 0.1 * slope
        second = 0.999 * second + 0.001 * slope * slope
        rate = 0.3 * (1 - step / (STEPS + 1))
        weights -= rate * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.999 ** step)) + 1e-8)
    return weights


def predict(row, column, dense, n, weights):
    width = len(weights) - dense.shape[1] - 1
    return np.bincount(row, weights=weights[:width][column], minlength=n) + dense @ weights[width:-1] + weights[-1]


def marks_of(words: pd.Series, chosen: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Row and position among the chosen slots of every mark."""
    rows, places = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    # A few rows at a time: most of their words are not among the chosen.
    for low in range(0, len(words) if chosen else 0, ROWS):
        some = [np.asarray(x, dtype=np.int64) for x in words.iloc[low:low + ROWS]]
        row = np.repeat(np.arange(low, low + len(some)), [len(x) for x in some])
        slot = np.concatenate(some)
        at = np.searchsorted(chosen, slot)
        hit = np.asarray(chosen)[np.minimum(at, len(chosen) - 1)] == slot
        rows.append(row[hit])
        places.append(at[hit])
    return np.concatenate(rows), np.concatenate(places)


def fold_model(label: str, before: list[str], chosen: list[int]):
    """Fits one model: that of a fold, which judges the fold's rows, or the final one, which gives its weights."""
    def model(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["doc_id", "fold"], kind="stable", ignore_index=True)
        held = (pdf["model"] == pdf["fold"]).to_numpy()
        row, column = marks_of(pdf["words"], chosen)
        p = np.clip(pdf[before].to_numpy(dtype=float).reshape(len(pdf), len(before)), 1e-6, 1 - 1e-6)
        dense = np.log(p / (1 - p))
        y = pdf[label].to_numpy(dtype=float)
        seen = ~held & ~np.isnan(y)
        place = np.cumsum(seen) - 1
        inside = seen[row]
        weights = fit(place[row[inside]], column[inside], dense[seen], y[seen], len(chosen))
        if pdf["model"].iloc[0] == FOLDS:
            return pd.DataFrame({"doc_id": [None], "p": [None], "weights": [list(weights)]})
        judged = sigmoid(predict(row, column, dense, len(pdf), weights))
        out = pd.DataFrame({"doc_id": pdf["doc_id"][held], "p": judged[held]})
        out["weights"] = None
        return out

    return model


def train(docs: DataFrame, labels: DataFrame, categories: dict[str, str], rows: int = SAMPLE_ROWS) -> list[dict]:
    """The chain: for each category its words' slots and their weights.

    ``categories`` maps names to SQL expressions over ``labels`` that are 1, 0 or
    NULL.  Each fold's model, and the final one, is fitted in a task of its own
    from the sample, whose size is bounded.
    """
    with small_batches(docs.sparkSession):
        return _trained(sample(docs, labels, categories, rows), categories)


def _trained(known: DataFrame, categories: dict[str, str]) -> list[dict]:
    chain = []
    for i, name in enumerate(categories):
        label, before = f"y{i}", [f"p{j}" for j in range(i)]
        chosen = telling_words(known, label)

        models = known.withColumn("model", F.explode(F.array(*[F.lit(f) for f in range(FOLDS + 1)])))
        fitted = stored(models.groupBy("model").applyInPandas(fold_model(label, before, chosen), "doc_id long, p double, weights array<double>"),
                        f"toxicity-model-{i}")
        final = fitted.where("weights IS NOT NULL").first()
        weights = list(final.weights) if final else [0.0] * (len(chosen) + i) + [-30.0]
        chain.append({"name": name, "slots": chosen, "weights": weights})
        if i + 1 < len(categories):
            outside = fitted.where("weights IS NULL").groupBy("doc_id").agg(F.avg("p").alias(f"p{i}"))
            known = stored(known.join(outside, "doc_id"), f"toxicity-sample-{i}")
    return chain


def judge(docs: DataFrame, chain: list[dict], text_column: str = "text") -> DataFrame:
    """Adds ``p_<category>`` for each category of the chain; one pass, no shuffle."""
    names = [f"p_{link['name']}" for link in chain]
    kept = docs.drop(*names)
    schema = T.StructType([*kept.schema.fields, *[T.StructField(name, T.DoubleType()) for name in names]])

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        columns = sorted({slot for link in chain for slot in link["slots"]})
        lookup = np.full(1 << SLOT_BITS, -1, dtype=np.int32)
        lookup[columns] = np.arange(len(columns))
        for batch in batches:
            for part in slices(batch, text_column):
                found, slot = slots(part, text_column, powers)
                at = lookup[slot]
                pairs = np.unique(found.doc[at >= 0] * max(1, len(columns)) + at[at >= 0])
                row, word = np.divmod(pairs, max(1, len(columns)))
                dense, out = np.zeros((found.n, 0)), []
                for link in chain:
                    place = np.full(max(1, len(columns)), -1)
                    place[np.searchsorted(columns, link["slots"])] = np.arange(len(link["slots"]))
                    own = place[word] >= 0
                    odds = predict(row[own], place[word[own]], dense, found.n, np.asarray(link["weights"]))
                    out.append(pa.array(sigmoid(odds)))
                    dense = np.column_stack([dense, np.clip(odds, -13.8, 13.8)])
                yield pa.RecordBatch.from_arrays([*part.columns, *out], names=[*part.schema.names, *names])
        give_back()

    return kept.mapInArrow(judged, schema)
