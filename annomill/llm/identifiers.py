"""Personal identifiers by fixed patterns and by the contexts they stand in.

**Base.** Mail addresses, IP addresses, card and phone numbers match patterns,
leftmost and without overlap within a kind; card numbers must pass their checksum.

**Bootstrapping.** The words before and behind the base identifiers make lexical
patterns: (kind, word before), (kind, word behind) and (kind, both).  They are
joined to all *instances*, the words that hold a digit or an at sign, base or not,
and the longest runs of words with digits between single blanks, as a graph.  In turn a pattern's confidence is the mean score of the instances it
stands by, those of other kinds counting nothing, and an unseen instance's score
grows with the confidence of its patterns, ``1 - product(1 - confidence)``.  After
``ROUNDS`` rounds an instance is an identifier of a kind if it stands in a pattern of at
least ``CONFIDENT`` with ``SUPPORT`` different base identifiers, scores as much
itself, has the shape of the kind, overlaps no base identifier and does not lie
within a longer one.  Runs are taken whole, with 7 to 19 digits and no at sign, and
may open with a bracket that closes within; parts of a run of several words are not
tried, single words are.

All of it is SQL functions.  Matches are cut out together with the text between
them; lengths of both are added up to code point positions in a window per text.
Contexts are counted before they move; texts never move.

Defined cases: NULL text counts as empty and has no spans; NULL ids are an id of
their own; rows alike in id and text are one document, and each gets the spans;
matches that fail their check are dropped without another try; an empty table gives
an empty table; columns other than the two named ones are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored
from .lines import keyed

KINDS = ("email", "ip", "card", "phone")
#: The possessive forms match what the plain ones do; anchors spare tries that cannot succeed.  No pattern here may
#: loop over a group in any other way, or try a run of characters from each of its places: texts can be one such run.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A text without this has no match that counts.
NEEDED = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){13}", "phone": r"\+[0-9]"}
WORD = r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+"
#: Several words with digits, a single blank between them.
RUN = r"(?<!\S)[^\s0-9@]*+[0-9][^\s@]*+(?:\x20[^\s0-9@]*+[0-9][^\s@]*+(?!\S))++"
#: Marks ahead of a word; of a run, a bracket stays if it closes before further digits.
AHEAD = {WORD: r"^[\p{Punct}&&[^+]]*+", RUN: r"^(?:[\p{Punct}&&[^+(]]|\((?![^()]*+\)[^)0-9]*+[0-9]))*+"}
PUNCT = "".join(mark for mark in map(chr, range(33, 127)) if not mark.isalnum())
#: A text without this has no run.
NEEDED_RUN = r"(?<!\S)[^\s0-9@]*+[0-9]\S*+\x20[^\s0-9@]*+[0-9]"
ROUNDS = 3
CONFIDENT = 0.9
SUPPORT = 5
LEAST_CHARS = 5


def matches(rows: DataFrame, pattern: str, needed: str) -> DataFrame:
    """``_doc, _rank, n, match, start, before, behind`` of all matches; the last two are the text around."""
    text = F.col("text")
    pieces = F.split(text, pattern, -1)
    cut = F.arrays_zip(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("match"),
                       pieces.alias("before"), F.slice(pieces, 2, F.size(pieces)).alias("behind"))
    found = rows.where(text.rlike(needed)).select("_doc", "_rank", F.posexplode(cut).alias("n", "m")).where(
        "m.match IS NOT NULL")
    found = found.select("_doc", "_rank", "n", "m.match", F.length("m.before").alias("gap"),
                         F.regexp_extract("m.before", r"(?<!\S)(\S++)\s++$", 1).alias("left"),
                         F.regexp_extract("m.behind", r"^\s++(\S++)", 1).alias("right"))
    so_far = Window.partitionBy("_doc", "_rank").orderBy("n").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("gap") + F.coalesce(F.sum(F.col("gap") + F.length("match")).over(so_far), F.lit(0))
    return found.withColumn("start", start.cast("long")).withColumn("end", F.col("start") + F.length("match"))


def digits_of(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def passes(kind: str) -> Column:
    """What a match must fulfil."""
    match, digits = F.col("match"), digits_of(F.col("match"))
    if kind == "ip":
        part = lambda p: F.regexp_replace(p, "^0+", "")
        return F.forall(F.split(match, r"\."), lambda p: (F.length(part(p)) <= 3) & (
            F.coalesce(part(p).try_cast("int"), F.lit(0)) <= 255))
    if kind == "card":
        size = F.length(digits)
        at = lambda i: F.ascii(F.substring(digits, size - i, F.lit(1))) - 48
        twice = lambda i: F.when(i % 2 == 1, F.when(at(i) > 4, at(i) * 2 - 9).otherwise(at(i) * 2)).otherwise(at(i))
        total = F.aggregate(F.sequence(F.lit(0), size - 1), F.lit(0), lambda sum_, i: sum_ + twice(i))
        return F.when(size.between(14, 19), total % 10 == 0).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(10, 15)
    return F.lit(True)


def has_shape(kind: Column, word: Column) -> Column:
    """Whether a word could be an identifier of a kind."""
    size = F.length(digits_of(word))
    return (
        F.when(kind == "email", word.contains("@"))
        .when(kind == "ip", word.rlike(r"^[0-9a-fA-F]++(?:[.:][0-9a-fA-F]*+){2,}+$"))
        .when(kind == "card", size.between(12, 19)).otherwise(size.between(7, 15) & ~word.contains("@"))
    )


def context_word(column: str) -> Column:
    return F.lower(F.btrim(F.col(column), F.lit(PUNCT)))


def base_spans(rows: DataFrame) -> DataFrame:
    """All base identifiers: ``_doc, _rank, kind, start, end, match, left, right``."""
    found = None
    for kind in KINDS:
        own = matches(rows, PATTERNS[kind], NEEDED[kind]).where(passes(kind)).select(
            "_doc", "_rank", F.lit(kind).alias("kind"), "start", "end", "match", "left", "right")
        found = own if found is None else found.unionByName(own)
    return found


def bare(found: DataFrame, pattern: str) -> DataFrame:
    """Matches without marks around them."""
    ahead = F.length(F.regexp_extract("match", AHEAD[pattern], 0))
    match = F.rtrim(F.regexp_replace("match", AHEAD[pattern], ""), F.lit(PUNCT))
    found = found.select("_doc", "_rank", match.alias("match"), (F.col("start") + ahead).alias("start"), "left", "right")
    return found.where(F.length("match") >= LEAST_CHARS).withColumn("end", F.col("start") + F.length("match"))


def candidates(rows: DataFrame, base: DataFrame) -> DataFrame:
    """Words with a digit or an at sign, and runs of words with digits, outside of base identifiers."""
    runs = bare(matches(rows, RUN, NEEDED_RUN), RUN)
    words = bare(matches(rows, WORD, "[0-9@]"), WORD).unionByName(
        runs.where(F.length(digits_of(F.col("match"))).between(7, 19)))
    taken = base.groupBy("_doc", "_rank").agg(F.collect_list(F.struct("start", "end")).alias("taken"))
    free = ~F.exists("taken", lambda x: (x.start < F.col("end")) & (x.end > F.col("start")))
    return words.join(taken, ["_doc", "_rank"], "left").where(F.col("taken").isNull() | free).drop("taken")


def contexts(frame: DataFrame) -> DataFrame:
    """Adds ``context``, one row for each pattern's words around the match."""
    left, right = context_word("left"), context_word("right")
    made = F.array(F.when(left != "", F.concat(F.lit("before "), left)),
                   F.when(right != "", F.concat(F.lit("behind "), right)),
                   F.when((left != "") & (right != ""), F.concat(F.lit("both "), left, F.lit(" "), right)))
    return frame.withColumn("context", F.explode(F.array_compact(made)))


def scored(base: DataFrame, words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Confidence of patterns ``context, kind`` and scores of instances ``match, kind``."""
    seeds = contexts(base).select("context", "match", "kind").distinct()
    support = seeds.groupBy("context", "kind").agg(F.count(F.lit(1)).alias("support")).where(F.col("support") >= SUPPORT)
    support = stored(support, "pii-support")
    wanted = support.select("context").distinct()
    unseen = contexts(words).select("context", "match").distinct().join(wanted, "context", "left_semi")
    edges = stored(seeds.select("context", "match", F.col("kind").alias("seed")).join(wanted, "context", "left_semi")
                   .unionByName(unseen.withColumn("seed", F.lit(None).cast("string"))), "pii-edges")
    scores = base.sparkSession.createDataFrame([], "match string, kind string, score double")
    for _ in range(ROUNDS):
        joined = edges.join(support, "context").join(scores, ["match", "kind"], "left")
        value = F.when(F.col("seed").isNotNull(), (F.col("seed") == F.col("kind")).cast("double")).otherwise(
            F.coalesce("score", F.lit(0.0)))
        patterns = stored(joined.groupBy("context", "kind").agg(F.avg(value).alias("confidence")), "pii-patterns")
        doubt = F.sum(F.log(F.greatest(F.lit(1e-9), 1 - F.col("confidence"))))
        scores = stored(edges.where("seed IS NULL").join(patterns, "context").groupBy("match", "kind").agg(
            (1 - F.exp(doubt)).alias("score")), "pii-scores")
    return patterns, scores


def discovered(base: DataFrame, words: DataFrame) -> DataFrame:
    """Candidates that patterns of high confidence make identifiers; each of its likeliest kind, the longest of nested ones."""
    patterns, scores = scored(base, words)
    sure = patterns.where(F.col("confidence") >= CONFIDENT)
    near = contexts(words).join(sure, "context").join(scores, ["match", "kind"]).where(
        (F.col("score") >= CONFIDENT) & has_shape(F.col("kind"), F.col("match")))
    best = F.max(F.struct("score", "kind")).alias("best")
    spans = near.groupBy("_doc", "_rank", "start", "end").agg(best).select("_doc", "_rank", "best.kind", "start", "end")
    ahead = Window.partitionBy("_doc", "_rank").orderBy("start", F.desc("end")).rowsBetween(Window.unboundedPreceding, -1)
    return spans.withColumn("_so_far", F.max("end").over(ahead)).where(
        "_so_far IS NULL OR _so_far < end").drop("_so_far")


def find(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, spans`` of each row: an array of ``start, kind, end, base``, sorted; ends are exclusive."""
    named = docs.select(F.col(f"`{id_column}`").cast("long").alias("doc_id"),
                        F.coalesce(F.col(f"`{text_column}`").cast("string"), F.lit("")).alias("text"))
    rows, once = keyed(named, "doc_id", "text")
    base = stored(base_spans(once), "pii-base")
    words = stored(candidates(once, base), "pii-words")
    spans = base.select("_doc", "_rank", "kind", "start", "end", F.lit(True).alias("base")).unionByName(
        discovered(base, words).withColumn("base", F.lit(False)))
    number = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    one = F.struct("start", number.alias("number"), "end", "kind", "base")
    listed = spans.groupBy("_doc", "_rank").agg(F.sort_array(F.collect_list(one)).alias("spans"))
    return rows.select("doc_id", "_doc", "_rank").join(listed, ["_doc", "_rank"], "left").select(
        "doc_id", F.coalesce("spans", F.array().cast(listed.schema["spans"].dataType)).alias("spans"))


def written(spans: Column) -> Column:
    """Spans as ``kind:start:end``, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")
