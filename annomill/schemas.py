"""Explicit schemas; nothing is inferred from data."""

from pyspark.sql import types as T

PROMPT = T.StructType([
    T.StructField("custom_id", T.StringType()),
    T.StructField("prompt", T.StringType()),
])


def output(content: bool = True) -> T.StructType:
    """A line of ``output.jsonl``.  Without ``content`` the answers' texts,
    which are most of the bytes, are skipped and not decoded."""
    message = T.StructField("message", T.StructType([T.StructField("content", T.StringType())]))
    choice = T.StructType([T.StructField("finish_reason", T.StringType())] + [message] * content)
    usage = T.StructType([
        T.StructField("prompt_tokens", T.LongType()),
        T.StructField("completion_tokens", T.LongType()),
    ])
    body = T.StructType([
        T.StructField("model", T.StringType()),
        T.StructField("choices", T.ArrayType(choice)),
        T.StructField("usage", usage),
    ])
    return T.StructType([
        T.StructField("custom_id", T.StringType()),
        T.StructField("response", T.StructType([T.StructField("body", body)])),
        T.StructField("_corrupt_record", T.StringType()),
    ])


ERROR = T.StructType([
    T.StructField("custom_id", T.StringType()),
    T.StructField("error", T.StringType()),
    T.StructField("response", T.StringType()),
    T.StructField("_corrupt_record", T.StringType()),
])

BATCH_METADATA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("created_at", T.LongType()),
    T.StructField("completed_at", T.LongType()),
    T.StructField("output_file_id", T.StringType()),
    T.StructField("error_file_id", T.StringType()),
    T.StructField("request_counts", T.StructType([
        T.StructField("total", T.LongType()),
        T.StructField("completed", T.LongType()),
        T.StructField("failed", T.LongType()),
    ])),
    T.StructField("errors", T.StringType()),
])

LEDGER = T.StructType([
    T.StructField("demand", T.StringType()),
    T.StructField("part", T.StringType()),
    T.StructField("batch_id", T.StringType()),
])
