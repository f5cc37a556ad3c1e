"""URL filter: rules for hosts and paths, and listed canonical URLs.

An entry of the list is a *rule*, a host and the start of a path such as
``example.net/en/``, or a *whole* canonical URL.  A rule fits its host and all
subdomains; the longest rule that fits decides, else the listed URL, else the
verdict for what is not listed.

A URL has few keys under which an entry may fit it: its canonical form, and for
each *shape* among the rules (number of host labels, length of the path) the last
labels of its host with the first characters of its path.  A **blocked Bloom
filter** of all entries passes the keys that may be listed: a key's hash names one
block of 512 bits, eight words of 64, and one bit in each word, so that a test
looks at one row.  What passes is joined with the list itself by equal keys, which
removes the false positives.

The filter takes ``BITS`` bits an entry and never more than ``MOST_BLOCKS`` blocks, so
it can always be broadcast; for lists beyond 16 million entries more keys pass and
the join removes more.  A list that measures little is broadcast too, a larger one is
joined by slices of hot keys.  Keys that fit are summed up per URL before they
move, and a URL of very many rows is dealt over slices when its rows take the verdict.

Everything is SQL functions.  Defined cases: a NULL URL, or one without ``://``, has
an empty host and path, no canonical form, and fits nothing; NULL ids are ids like
others; each of repeated rows is judged; of entries alike a blocking one counts; among
rules of one length that with the longer host, then the one later in byte order
decides; entries with NULLs are left out; an empty table or list is one like
others; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.sizes import fits_in_memory, sliced_join
from ..session import stored

WORDS = 8
BITS = 16
MOST_BLOCKS = 1 << 19
ALLOW, BLOCK = "allow", "block"
#: Parameters that tell where a visitor came from, not what is shown.
TRACKING = r"^(utm_[^=]*|ref|fbclid|gclid)(=|$)"


def _rest(url: Column) -> Column:
    """What stands behind the first ``://``; NULL without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def host_of(url: Column) -> Column:
    host = F.regexp_extract(_rest(url), r"^[^/?#]*", 0)
    return F.coalesce(F.translate(host, string.ascii_uppercase, string.ascii_lowercase), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(url: Column) -> Column:
    """Host, path and query in one form; NULL for a URL without host.

    Without scheme, ``www.``, default port, fragment, slashes at the path's end and
    tracking parameters; the other parameters are sorted.
    """
    host = F.regexp_replace(host_of(url), r"^www\.|:(?:80|443)?$", "")
    path = F.regexp_replace(path_of(url), r"(?<!/)/+$", "")
    query = F.regexp_extract(_rest(url), r"^[^?#]*\?([^#]*)", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(TRACKING)))
    joined = F.array_join(kept, "&")
    return F.when(host != "", F.concat(host, path, F.when(joined != "", F.concat(F.lit("?"), joined)).otherwise("")))


def key_of(entry: Column, whole: Column | bool) -> Column:
    """Rules and whole URLs of one text are different entries."""
    whole = F.lit(whole) if isinstance(whole, bool) else whole
    return F.concat(F.when(whole, "=").otherwise("<"), entry)


def entries(listed: DataFrame) -> DataFrame:
    """``key, entry, whole, verdict``, each entry once, of a list ``entry, whole, verdict``."""
    known = listed.select("entry", "whole", "verdict").where(
        "entry IS NOT NULL AND whole IS NOT NULL AND verdict IS NOT NULL")
    once = known.groupBy("entry", "whole").agg(F.max(F.col("verdict") == BLOCK).alias("_block"))
    return once.select(key_of(F.col("entry"), F.col("whole")).alias("key"), "entry", "whole",
                       F.when(F.col("_block"), BLOCK).otherwise(ALLOW).alias("verdict"))


def _host_and_path(entry: Column) -> tuple[Column, Column]:
    slash = F.instr(entry, "/")
    return (F.when(slash > 0, F.substring(entry, F.lit(1), slash - 1)).otherwise(entry),
            F.when(slash > 0, F.substring(entry, slash, F.length(entry))).otherwise(""))


def _labels(host: Column) -> Column:
    return F.length(host) - F.length(F.translate(host, ".", "")) + 1


def shapes(known: DataFrame) -> list[tuple[int, int]]:
    """Labels and path lengths that rules have; their number does not follow that of the rules."""
    host, path = _host_and_path(F.col("entry"))
    found = known.where("NOT whole").select(_labels(host).alias("labels"), F.length(path).alias("chars")).distinct()
    return sorted((row.labels, row.chars) for row in found.collect())


def _block_and_bits(key: str, blocks: int) -> tuple[Column, list[Column]]:
    """The key's block, and its bit in each word of it."""
    bits = F.xxhash64(F.lit("bits"), F.col(key))
    return (F.pmod(F.xxhash64(F.lit("block"), F.col(key)), F.lit(blocks)).alias("block"),
            [F.shiftrightunsigned(bits, 6 * i).bitwiseAND(F.lit(63)).cast("int") for i in range(WORDS)])


def bloom(known: DataFrame, blocks: int) -> DataFrame:
    """The filter: one row ``block, w0 ... w7`` for each block that holds a bit."""
    block, bits = _block_and_bits("key", blocks)
    rows = known.select(block, *[bit.alias(f"b{i}") for i, bit in enumerate(bits)])
    return rows.groupBy("block").agg(
        *[F.bit_or(F.expr(f"shiftleft(1L, b{i})")).alias(f"w{i}") for i in range(WORDS)])


def passing(rows: DataFrame, filtered: DataFrame, blocks: int) -> DataFrame:
    """Rows whose ``key`` may be among the filter's entries: all that are, and a few others."""
    block, bits = _block_and_bits("key", blocks)
    probed = rows.select("*", block, *[bit.alias(f"b{i}") for i, bit in enumerate(bits)])
    hit = " AND ".join(f"shiftright(w{i}, b{i}) & 1 = 1" for i in range(WORDS))
    return probed.join(F.broadcast(filtered), "block").where(hit).select(*rows.columns)


def _keys(rules: list[tuple[int, int]]) -> Column:
    """All keys under which ``url`` may be listed."""
    host, path = F.col("host"), F.col("path")
    made = [key_of(F.col("canonical"), True)]
    labels = _labels(host)
    for count, chars in rules:
        fits = (labels >= count) & (F.length(path) >= chars) & (F.instr(F.col("url"), "://") > 0)
        made.append(F.when(fits, key_of(F.concat(F.substring_index(host, ".", -count), F.left(path, F.lit(chars))), False)))
    return F.array_compact(F.array(*made))


def judge(pages: DataFrame, listed: DataFrame, id_column: str = "page_id", url_column: str = "url",
          otherwise: str = ALLOW) -> DataFrame:
    """``<id>, host, path, rule, entry, verdict`` of every row.

    ``listed`` has ``entry, whole, verdict``.  ``rule`` is the rule that decided, ``entry``
    what decided, be it a rule or a whole URL.
    """
    known = stored(entries(listed), "url-entries")
    blocks = min(MOST_BLOCKS, max(1, -(-known.count() * BITS // (WORDS * 64))))
    filtered = bloom(known, blocks)
    rows = pages.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{url_column}`").cast("string").alias("url"))
    url = F.col("url")
    keyed = rows.where(F.instr(url, "://") > 0).select(
        "url", host_of(url).alias("host"), path_of(url).alias("path"), canonical(url).alias("canonical"))
    tried = keyed.select("url", F.explode(_keys(shapes(known))).alias("key"))
    possible = passing(tried, filtered, blocks)
    host, _ = _host_and_path(F.col("entry"))
    rank = F.struct((~F.col("whole")).alias("is_rule"), F.length("entry").alias("chars"), F.length(host).alias("host_chars"),
                    F.col("entry"), F.col("verdict"))
    known = known.select("key", rank.alias("rank"))
    if fits_in_memory(known):
        hits = possible.join(F.broadcast(known), "key")
    else:
        hits = sliced_join(stored(possible, "url-possible"), known, "key")
    best = stored(hits.groupBy("url").agg(F.max("rank").alias("rank")), "url-verdicts")
    judged = sliced_join(rows, best, "url", "left")
    return judged.select(
        F.col("id").alias(id_column), host_of(url).alias("host"), path_of(url).alias("path"),
        F.when(F.col("rank.is_rule"), F.col("rank.entry")).alias("rule"), F.col("rank.entry").alias("entry"),
        F.coalesce("rank.verdict", F.lit(otherwise)).alias("verdict"))


def repeated(pages: DataFrame, url_column: str = "url") -> DataFrame:
    """A list that blocks the canonical URLs which more than one row has."""
    urls = pages.select(canonical(F.col(f"`{url_column}`").cast("string")).alias("entry")).where("entry IS NOT NULL")
    return urls.groupBy("entry").count().where("count > 1").select(
        "entry", F.lit(True).alias("whole"), F.lit(BLOCK).alias("verdict"))
