"""Line dedup by a deletion-neighbourhood join (operator 3), in DataFrame operations only.

A line occurrence is dropped if an earlier occurrence (by doc_id, then line
number) has the same words, or words within ``MAX_EDITS`` = 1 word edit (a word
put in, left out or replaced).  Equal lines meet in one row per line first, so
a line that a third of the corpus repeats costs one row per task.

Neighbourhood.  Of a line of n words its n variants with one word deleted are
emitted as hashed keys, with the position of the deletion, beside the line
itself.  Two lines are one replacement apart exactly if they share a variant at
the same position, and one insertion apart exactly if the one is a variant of
the other.  Lines that share a variant and position meet the earliest line of
their group only, and a whole line meets its own longer ones: no pairs within a
group are made, however large it is.  The edit distance of every
such pair is verified on the words themselves.

Lines within one edit share the first or the last half of their words (counted
in the shorter line's words), so variants are only emitted for lines that share
such a half with another line; this loses nothing.  A variant's hash is a sum
of word hashes by position, one running sum over the line's words, so long
lines cost words times log(words), not words squared.

Edges.  Lines are what split at line feeds gives.  Lines of fewer than
``min_words`` words, blank ones included, are never dropped; lines of fewer than
``near_words`` only for equal words.  A document whose every line of at least one word is dropped
goes; a null, empty or blank text stays as it is.  Null doc_ids come first in the
order; rows with equal doc_id stand in order of a text hash; of rows equal in
doc_id and text one stays.  An empty table gives an empty result.  Only doc_id
and text are read; ``n_chars``, where there is one, is brought up to date, and
other columns pass through whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hexaccess.llm.common import WORD, read_table, running_total, stage_table

MAX_EDITS = 1
MIN_WORDS, NEAR_WORDS = 3, 8
#: Word hashes are cut to 40 bits, so that sums over a line of 2^22 words don't overflow; two of them make a key.
_MASK = (1 << 40) - 1
#: Up to so many rows of three or four numbers a table is broadcast.
BROADCAST_ROWS = 500_000


def _normal(line: Column) -> Column:
    """The line's words, one space between them (most lines are so already)."""
    odd = F.startswith(line, F.lit(" ")) | F.endswith(line, F.lit(" "))
    for sign in ("  ", "\t", "\x0b", "\x0c", "\r"):
        odd = odd | F.contains(line, F.lit(sign))
    return F.when(odd, F.array_join(F.regexp_extract_all(line, F.lit(WORD), F.lit(0)), " ")).otherwise(line)


def _lines(docs: DataFrame) -> DataFrame:
    """(doc_id, h, no, line): the words of every line, with the hash of its document's text."""
    return docs.select("doc_id", F.xxhash64("text").alias("h"),
                       F.posexplode(F.transform(F.split("text", "\n"), _normal)).alias("no", "line"))


def _count(line: Column) -> Column:
    """Number of words."""
    return F.when(line == "", 0).otherwise(F.octet_length(line) - F.octet_length(F.replace(line, F.lit(" "), F.lit(""))) + 1)


def _keys(line: Column) -> list[Column]:
    """128 bits that stand for a line."""
    return [F.xxhash64(line).alias("k1"), F.xxhash64(line, F.lit(1)).alias("k2")]


def _half_keys(line: Column, n: Column) -> Column:
    """Hashes of the first and the last half, for a shorter line of n and of n - 1 words."""
    def of(m):
        half = F.floor(m / 2).cast("int")
        return [F.xxhash64(F.lit(0), m, F.call_function("substring_index", line, F.lit(" "), half)),
                F.xxhash64(F.lit(1), m, F.call_function("substring_index", line, F.lit(" "), half - m))]
    return F.array(*of(n), *of(n - 1))


def _distinct(docs: DataFrame, min_words: int, near_words: int) -> DataFrame:
    """One row per different line: its key, first occurrence and half keys (null if too short for near)."""
    lines = _lines(docs).withColumn("n", _count(F.col("line"))).where(F.col("n") >= min_words)
    rows = lines.select(*_keys(F.col("line")), F.struct("doc_id", "h", "no").alias("at"),
                        F.when(F.col("n") >= near_words, _half_keys(F.col("line"), F.col("n"))).alias("halves"))
    return stage_table(rows.groupBy("k1", "k2").agg(F.min("at").alias("at"), F.any_value("halves").alias("halves")), "lines")


def _few(rows: DataFrame) -> DataFrame:
    """Rows that are counted to be few go to all tasks; more are joined by a shuffle whose hot partitions Spark splits."""
    return F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows


def _candidates(docs: DataFrame, distinct: DataFrame) -> DataFrame:
    """(id, k1, k2, words): the different lines that share a half with another one; id: their place in the order of first occurrences."""
    # half of the line's key will do here: an equal one only makes one more candidate
    halves = distinct.where("halves IS NOT NULL").select("k1", F.explode(F.array_distinct("halves")).alias("half"))
    shared = halves.groupBy("half").agg(F.count("*").alias("c")).where("c > 1").select("half")
    chosen = halves.join(shared, "half", "left_semi").select("k1").distinct()
    chosen = stage_table(distinct.where("halves IS NOT NULL").join(chosen, "k1", "left_semi").select(
        "k1", "k2", "at.doc_id", "at.h", "at.no"), "chosen")
    placed = stage_table(running_total(chosen.withColumn("one", F.lit(1)), ["doc_id", "h", "no"], "one", "id").select(
        "id", "k1", "k2", "doc_id", "h", "no"), "placed")
    texts = _lines(docs).select(*_keys(F.col("line")), F.col("doc_id").alias("_doc"), F.col("h").alias("_h"), F.col("no").alias("_no"), "line")
    found = texts.join(_few(placed), ["k1", "k2"]).where(
        F.col("_doc").eqNullSafe(F.col("doc_id")) & (F.col("_h") == F.col("h")) & (F.col("_no") == F.col("no")))
    # rows equal in doc_id and text hold the same occurrence twice
    return stage_table(found.groupBy("id", "k1", "k2").agg(F.any_value("line").alias("line"))
                       .select("id", "k1", "k2", F.split("line", " ").alias("words")), "near-lines")


def _variants(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((v1, v2, m, pos, id) of each line without its pos-th word, as hashes, m words left; (v1, v2, m, id) of each whole line)."""
    def sums(seed):
        here = F.xxhash64("word", "pos", F.lit(seed)).bitwiseAND(F.lit(_MASK))
        moved = F.xxhash64("word", F.col("pos") - 1, F.lit(seed)).bitwiseAND(F.lit(_MASK))
        return [here.alias(f"here{seed}"), moved.alias(f"moved{seed}")]

    line = Window.partitionBy("id")
    before = line.orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    words = lines.select("id", F.size("words").alias("n"), F.posexplode("words").alias("p", "word")).withColumn("pos", F.col("p") + 1)
    words = words.select("id", "n", "pos", *sums(1), *sums(2))
    value = lambda s: (F.coalesce(F.sum(f"here{s}").over(before), F.lit(0)) + F.sum(f"moved{s}").over(line)
                       - F.coalesce(F.sum(f"moved{s}").over(before), F.lit(0)) - F.col(f"moved{s}"))
    deleted = words.select(value(1).alias("v1"), value(2).alias("v2"), (F.col("n") - 1).alias("m"), "pos", "id")
    whole = words.groupBy("id", "n").agg(F.sum("here1").alias("v1"), F.sum("here2").alias("v2")).select("v1", "v2", F.col("n").alias("m"), "id")
    return stage_table(deleted, "variants"), stage_table(whole, "wholes")


def _within_one_edit(a: Column, b: Column) -> Column:
    """Whether word lists are at most one insertion, deletion or replacement apart."""
    def run(x, y):  # length of the common beginning
        differ = F.array_position(F.zip_with(x, y, lambda p, q: p.eqNullSafe(q)), False)
        return F.when(differ > 0, differ - 1).otherwise(F.greatest(F.size(x), F.size(y)))
    most, least = F.greatest(F.size(a), F.size(b)), F.least(F.size(a), F.size(b))
    return (most - least <= 1) & (run(a, b) + run(F.reverse(a), F.reverse(b)) >= most - 1)


def near_lines(docs: DataFrame, distinct: DataFrame) -> DataFrame:
    """(k1, k2) of the lines with an earlier line within one edit."""
    lines = _candidates(docs, distinct)
    variants, wholes = _variants(lines)
    # a word put in or left out: a line's variant is another line
    put_in = (variants.join(_few(wholes.withColumnRenamed("id", "whole")), ["v1", "v2", "m"])
              .select(F.greatest("id", "whole").alias("id"), F.least("id", "whole").alias("earlier")))
    # a word replaced: the same variant at the same place; each line meets the earliest of its group
    groups = stage_table(variants.groupBy("v1", "v2", "m", "pos").agg(F.min("id").alias("earlier"), F.count("*").alias("c"))
                         .where("c > 1").drop("c"), "groups")
    replaced = (variants.join(_few(groups), ["v1", "v2", "m", "pos"]).where("earlier < id").select("id", "earlier"))
    links = put_in.union(replaced).distinct()
    theirs = lines.select(F.col("id").alias("earlier"), F.col("words").alias("theirs"))
    checked = links.join(lines, "id").join(theirs, "earlier").where(_within_one_edit(F.col("words"), F.col("theirs")))
    return stage_table(checked.select("k1", "k2").distinct(), "near")


def _dropped(docs: DataFrame, min_words: int, near_words: int) -> DataFrame:
    """(doc_id, h, gone): numbers of the lines that each text loses."""
    distinct = _distinct(docs, min_words, near_words)
    near = near_lines(docs, distinct).withColumn("near", F.lit(True))
    decided = distinct.join(near, ["k1", "k2"], "left").select("k1", "k2", "at", F.coalesce("near", F.lit(False)).alias("near"))
    lines = _lines(docs).where(F.col("line") != "").select("doc_id", "h", "no", *_keys(F.col("line")))
    gone = (lines.join(decided, ["k1", "k2"])
            .where(F.col("near") | ~F.struct("doc_id", "h", "no").eqNullSafe(F.col("at"))))
    return stage_table(gone.groupBy("doc_id", "h").agg(F.sort_array(F.collect_set("no")).alias("gone")), "dropped")


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS, near_words: int = NEAR_WORDS) -> DataFrame:
    """The rows of ``docs`` that keep a line, with what their texts keep; new columns _lines and _kept count lines."""
    gone = _dropped(docs, min_words, near_words).select(F.col("doc_id").alias("_id"), F.col("h").alias("_h"), "gone")
    rows = docs.select(F.struct("*").alias("_row"), F.col("doc_id").alias("_k"), F.xxhash64("text").alias("_of"), F.col("text").alias("_text"))
    again = stage_table(docs.select("doc_id", F.xxhash64("text").alias("h")).groupBy("doc_id", "h").count().where("count > 1")
                        .select(F.col("doc_id").alias("_id"), F.col("h").alias("_h"), F.lit(True).alias("_again")), "again")
    repeats = again.limit(1).count() > 0
    marks = again.join(gone, again["_id"].eqNullSafe(gone["_id"]) & (again["_h"] == gone["_h"]), "full").select(
        F.coalesce(again["_id"], gone["_id"]).alias("_id"), F.coalesce(again["_h"], gone["_h"]).alias("_h"), "_again", "gone")
    both = rows.join(stage_table(marks, "marks"), F.col("_k").eqNullSafe(F.col("_id")) & (F.col("_of") == F.col("_h")), "left")
    lines = F.split("_text", "\n")
    kept = F.when(F.col("gone").isNull(), lines).otherwise(F.filter(lines, lambda line, i: ~F.array_contains("gone", i)))
    both = both.withColumn("_all", lines).withColumn("_left", kept)
    stays = F.col("gone").isNull() | F.exists("_left", lambda line: line.rlike(WORD))
    done = both.where(stays)
    if repeats:  # rows that stand in the table more than once with the same id and text: one of them
        done = done.where("_again IS NULL").unionByName(done.where("_again").dropDuplicates(["_k", "_of"]))
    text = F.when(F.col("gone").isNull(), F.col("_text")).otherwise(F.array_join("_left", "\n"))
    row = F.col("_row").withField("text", text)
    if "n_chars" in docs.columns:
        row = row.withField("n_chars", F.when(F.col("gone").isNull(), F.col("_row.n_chars")).otherwise(F.length(text)).cast(docs.schema["n_chars"].dataType))
    return done.select(row.alias("_row"), F.coalesce(F.size("_all"), F.lit(0)).alias("_lines"), F.coalesce(F.size("_left"), F.lit(0)).alias("_kept"))


def deduplicated(docs: DataFrame, **params) -> DataFrame:
    """The rows that stay, with the columns of ``docs``."""
    return dedup_lines(docs, **params).select("_row.*")


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = dedup_lines(read_table(spark, sf_dir, "documents"))
    return done.select("_row.doc_id", F.col("_lines").cast("long").alias("n_lines"), F.col("_kept").cast("long").alias("n_kept"), "_row.text")


#: Pairs of lines that share a half are compared word by word; the method above never makes these pairs.
OP3_SQL = r"""
WITH d AS (SELECT doc_id, text, string_split(text, chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) - 1 AS no FROM d),
w AS (SELECT *, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS ws FROM l),
u AS (SELECT ws AS line, ws, len(ws) AS n, min((doc_id, no)) AS first FROM w WHERE len(ws) >= 3 GROUP BY ws),
h AS (
  SELECT *, unnest([(0, n, ws[1:n // 2]), (1, n, ws[n // 2 + 1:]), (0, n - 1, ws[1:(n - 1) // 2]), (1, n - 1, ws[(n - 1) // 2 + 2:])]) AS half
  FROM u WHERE n >= 8),
pairs AS (SELECT DISTINCT a.line, a.ws AS x, b.ws AS y FROM h a JOIN h b ON a.half = b.half AND b.first < a.first AND abs(a.n - b.n) <= 1),
runs AS (
  SELECT line, len(x) AS n, len(y) AS m,
         len(list_filter(range(1, least(len(x), len(y)) + 1), lambda i: x[1:i] = y[1:i])) AS head,
         len(list_filter(range(1, least(len(x), len(y)) + 1), lambda i: x[len(x) - i + 1:] = y[len(y) - i + 1:])) AS tail FROM pairs),
near AS (SELECT DISTINCT line FROM runs WHERE head + tail >= greatest(n, m) - 1),
k AS (
  SELECT w.doc_id, w.no, w.line, u.line IS NULL OR (u.first = (w.doc_id, w.no) AND near.line IS NULL) AS stays, len(w.ws) > 0 AS has
  FROM w LEFT JOIN u ON w.ws = u.line LEFT JOIN near ON w.ws = near.line)
SELECT doc_id, count(*)::BIGINT AS n_lines, (count(*) FILTER (stays))::BIGINT AS n_kept,
       coalesce(string_agg(line, chr(10) ORDER BY no) FILTER (stays), '') AS text
FROM k GROUP BY doc_id HAVING bool_or(stays AND has) OR bool_and(stays)
"""
