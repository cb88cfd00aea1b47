"""Mixing sources to target weights (operator 2).

Tokens are summed per source, every source gets a target and so a repetition
rate ``target / size``; a document is emitted ``floor(rate)`` times plus once
more when a draw, seeded by a hash of its id, falls below the fraction.

Edges.  A null text has size 0; a null source is a source of its own, last in
order; a source of size 0 has target 0 and rate 0.  Rows with equal doc_id
draw alike (a null id draws as the empty text), so repeated rows and reruns
agree.  An empty table gives an empty result.  Only doc_id, text and source
are read; other columns pass through ``mix`` untouched, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hexaccess.llm.common import WORD, read_table, running_total, stage_table

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MAX_REPEAT = 2
SEED = "mix-1"
#: Up to so many sources the per-source table (four numbers and a name each) is broadcast.
BROADCAST_SOURCES = 50_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """(_source, source_size, target, rate) from rows (_source, size).

    Targets fill like water: ``least(cap, level * weight)`` with the one level at
    which they add up to ``share`` of all sizes (cap: ``max_repeat`` times the
    source's size).  With sources in ascending cap / weight, the level is that of
    the first source which it leaves below its cap; both running totals are
    range-partitioned, so a million sources are no single task's work.
    """
    per_source = sizes.groupBy("_source").agg(F.sum("size").alias("source_size"))
    ranked = running_total(per_source.withColumn("_null", F.col("_source").isNull()).withColumn("_one", F.lit(1)),
                           ["_null", "_source"], "_one", "_rank")
    table = F.array(*[F.lit(int(w)) for w in weights])
    weighed = stage_table(
        ranked.withColumn("_w", F.element_at(table, (F.col("_rank") % len(weights) + 1).cast("int")).cast("long"))
        .withColumn("_cap", F.col("source_size") * max_repeat)
        .withColumn("_ratio", F.col("_cap") / F.col("_w")).drop("_one"), "sources")
    total, weight = weighed.agg(F.sum("source_size"), F.sum("_w")).first()
    wanted = F.lit(share) * F.lit(total or 0)
    capped = running_total(weighed, ["_ratio", "_rank"], "_cap", "_caps_before")
    filled = running_total(capped, ["_ratio", "_rank"], "_w", "_w_before")
    level = (wanted - F.col("_caps_before")) / (F.lit(weight or 0) - F.col("_w_before"))
    first = (filled.withColumn("_level", level).where(F.col("_ratio") >= F.col("_level"))
             .agg(F.min_by("_level", F.struct("_ratio", "_rank"))).first()[0])
    target = F.col("_cap").cast("double")
    if first is not None:
        target = F.least(target, F.lit(float(first)) * F.col("_w"))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    return weighed.withColumn("target", target).withColumn("rate", rate).select("_source", "source_size", "target", "rate")


def copies(rate: Column, doc_id: Column, seed: str = SEED) -> Column:
    """floor(rate), plus 1 with probability rate - floor(rate) by a hash of the id (52 bits)."""
    digest = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit(""))))
    draw = F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") / F.lit(float(2 ** 52))
    whole = F.floor(rate)
    return whole + F.when(draw < rate - whole, 1).otherwise(0)


def _rated(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """Each row with its source's targets.  The sources (one row each) are broadcast when
    they are few; beyond that the join is a shuffle whose hot partitions Spark splits."""
    few = targets.count() <= BROADCAST_SOURCES
    targets = targets.withColumnRenamed("_source", "_of")
    return rows.join(F.broadcast(targets) if few else targets, F.col("_source").eqNullSafe(F.col("_of"))).drop("_of")


def decisions(docs: DataFrame, **params) -> DataFrame:
    """doc_id, size, source_size, target, copies, taken: what the mix does with each document."""
    sized = stage_table(docs.select("doc_id", F.col("source").alias("_source"), word_count(F.col("text")).alias("size")),
                        "sizes")
    return (_rated(sized, stage_table(source_targets(sized, **params), "targets"))
            .withColumn("copies", copies(F.col("rate"), F.col("doc_id")))
            .select("doc_id", "size", "source_size", "target", "copies",
                    (F.col("size") * F.col("copies")).alias("taken")))


def mix(docs: DataFrame, **params) -> DataFrame:
    """The mixed corpus: the rows of ``docs``, each as often as its copies say."""
    sized = docs.select(F.col("source").alias("_source"), word_count(F.col("text")).alias("size"))
    targets = stage_table(source_targets(sized, **params), "targets")
    rows = docs.select(F.struct("*").alias("_row"), F.col("source").alias("_source"), F.col("doc_id").alias("_id"))
    return (_rated(rows, targets).withColumn("_n", copies(F.col("rate"), F.col("_id")).cast("int"))
            .withColumn("_copy", F.explode(F.array_repeat(F.lit(1), F.col("_n")))).select("_row.*"))


def op2_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decisions(read_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


OP2_SQL = """
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (
  SELECT *, 2 * source_size AS cap,
         [5, 2, 1][((row_number() OVER (ORDER BY (source IS NULL), encode(source)) - 1) % 3 + 1)::INT]::BIGINT AS w FROM s),
o AS (
  SELECT *, cap / w::DOUBLE AS ratio,
         coalesce(sum(cap) OVER (ORDER BY cap / w::DOUBLE, source IS NULL, encode(source)
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS caps,
         coalesce(sum(w) OVER (ORDER BY cap / w::DOUBLE, source IS NULL, encode(source)
                               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS ws FROM w),
v AS (SELECT *, (1.5::DOUBLE * (SELECT sum(source_size)::BIGINT FROM s) - caps) / ((SELECT sum(w)::BIGINT FROM w) - ws)::DOUBLE AS level FROM o),
l AS (SELECT arg_min(level, (ratio, source IS NULL, encode(source))) AS level FROM v WHERE ratio >= level),
t AS (
  SELECT source, source_size, least(cap::DOUBLE, l.level * w) AS target,
         CASE WHEN source_size > 0 THEN least(cap::DOUBLE, l.level * w) / source_size ELSE 0 END AS rate FROM o, l),
c AS (
  SELECT doc_id, size, source_size, target, rate,
         ('0x' || substr(md5('mix-1:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS draw
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (size * (floor(rate)::BIGINT + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken FROM c
"""
