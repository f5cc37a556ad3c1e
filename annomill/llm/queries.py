"""One query per operator over whole tables, with production parameters."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    centroids, decontamination, exact, identifiers, lines, neighbours, packing, sharding, substrings, suffixes, toxicity,
    urls, variants)
from .oracles import ORACLES  # noqa: F401

SHARDS = 8
SEQUENCE_TOKENS = 1024
REPEAT_WORDS = 20
REPEAT_BYTES = 400
CATEGORIES = {"low_quality": "1 - quality", "toxic": "toxic"}
TOXIC_FROM = 0.5
WORD_CHARS, WORD_COUNT = 7, 2
#: One run in so many loses a letter, so that there are variants to find.
DAMAGED = 31
CLUSTERS, ROUNDS, SCALE = 16, 3, 64.0
RULES = (("net/", urls.BLOCK), ("example.net/en/", urls.ALLOW), ("example.com/de/", urls.BLOCK), ("org/fr/", urls.ALLOW))


def piece_columns() -> list:
    return ["doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset",
            "sequence_cost"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def byte_vocabulary() -> tuple[str, str, tuple[tuple[str, int], ...]]:
    """File of ranks, pattern and special tokens of the public byte-level vocabulary of 50,257 ids."""
    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        added = json.load(file)["added_tokens"]
    special = tuple((token["content"], token["id"]) for token in added)
    return str(public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN, special


def op1_bounded_ring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents on eight shards whose counts are at most one apart."""
    text = F.coalesce("text", F.lit(""))
    rows = table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    placed = sharding.place(rows, SHARDS, key=["doc_id", "text_crc32"], ties=["size"], slack=0.0)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def op2_probminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class of near duplicates that each document belongs to."""
    return neighbours.near_duplicates(table(spark, sf_dir, "documents"))


def op3_stateful_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which of equal documents stays, from a stream over the documents' files."""
    found = exact.deduplicated(spark, f"{sf_dir}/documents.parquet")
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op4_lyndon_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of all documents without strings of 400 bytes that stand in several places."""
    kept = suffixes.remove_repeats(table(spark, sf_dir, "documents"), REPEAT_BYTES)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda total, span: total + span.end - span.start)
    return kept.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
                       F.sha2("kept", 256).alias("kept_sha256"))


def op5_doubling_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents without windows of 20 words that start earlier."""
    kept = substrings.remove_repeats(table(spark, sf_dir, "documents"), REPEAT_WORDS)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op6_deletion_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without lines that repeat an earlier one up to one edit."""
    kept = lines.drop_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op7_cost_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 1,024 tokens."""
    pieces = packing.pack(table(spark, sf_dir, "documents"), *byte_vocabulary(), SEQUENCE_TOKENS)
    return pieces.select(*piece_columns())


def op8_latent_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which documents hold an item of the benchmark."""
    found = decontamination.find(table(spark, sf_dir, "documents").select("doc_id", "text"),
                                 table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", *[name for name, _ in decontamination.RESULTS])


def op9_toxicity_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probability of each category, and whether a document counts as toxic."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    chain = toxicity.train(docs, table(spark, sf_dir, "labels"), CATEGORIES)
    judged = toxicity.judge(docs, chain)
    return judged.select("doc_id", *[f"p_{name}" for name in CATEGORIES],
                         (F.col("p_toxic") >= TOXIC_FROM).alias("toxic"))


def op10_contextual_identifiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal identifiers of all documents."""
    found = identifiers.find(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s.base)

    def count(kind: str):
        return F.size(F.filter(base, lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(kind) for kind in identifiers.KINDS]
    return found.select("doc_id", *counts, F.sha2(identifiers.written(base), 256).alias("base_sha256"),
                        identifiers.written(F.col("spans")).alias("spans"))


def op11_fm_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The form and root of every frequent word of the documents, some runs of which lose a letter."""
    found = variants.runs(table(spark, sf_dir, "documents"), least_chars=WORD_CHARS)
    key = F.concat(F.coalesce(F.col("doc").cast("string"), F.lit("")), F.lit(":"), F.col("run"))
    found = found.withColumn("h", F.crc32(key.cast("binary")))
    at = (F.col("h") % F.length("run")).cast("int")
    less = F.concat(F.left("run", at), F.substring("run", at + 2, F.length("run")))
    found = found.select(F.when(F.col("h") % DAMAGED == 0, less).otherwise(F.col("run")).alias("word"))
    return variants.group(variants.words(found, WORD_CHARS, WORD_COUNT))


def op12_table_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cluster of every embedding, after three rounds."""
    return centroids.cluster(table(spark, sf_dir, "embeddings"), CLUSTERS, ROUNDS, scale=SCALE)[0]


def op13_bloom_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts on all pages' URLs, by four rules and a list of URLs that several pages have."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    rules = spark.sql("SELECT * FROM VALUES " + ", ".join(f"('{rule}', false, '{verdict}')" for rule, verdict in RULES)
                      + " AS rules(entry, whole, verdict)")
    return urls.judge(pages, rules.unionByName(urls.repeated(pages))).select(
        "page_id", "host", "path", "rule", "verdict")


QUERIES = {query.__name__: query for query in (
    op1_bounded_ring, op2_probminhash, op3_stateful_exact, op4_lyndon_suffixes, op5_doubling_substrings,
    op6_deletion_lines, op7_cost_packing, op8_latent_decontamination, op9_toxicity_chain,
    op10_contextual_identifiers, op11_fm_variants, op12_table_centroids, op13_bloom_urls)}
