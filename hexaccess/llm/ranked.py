"""Ranked lexical search by range-maximum tables (operator 13).

*Index.*  Documents are taken in shards, the runs of a scan task of bounded
text.  A shard's terms are found on bytes in numpy and numbered by Arrow; its posting
lists (term, places of documents, term counts) are rows of a written table, its
doc_ids and lengths one row of another.  No list is longer than a shard, so a
term that a third of all rows hold is many short lists.

*Search.*  Query terms meet the index in one equi-join.  Neighbouring shards form
groups of about ``GROUP_DOCS`` documents; queries are taken in blocks.  A task
holds the lists of one group and block.  Impacts are exact integers; each list
has a sparse table of range maxima.  A query keeps a heap of document intervals;
an interval's bound is the sum of its lists' maxima (two table entries a list).
The best intervals are split at the document of the largest single impact: that
document is scored exactly, the two sides go back with their own bounds.  When the best
bound is below the k-th score found, what is left cannot matter.  Intervals are popped
``POPPED`` at a time, so numpy answers many range maxima at once.  The best k of
every group meet in one window whose tasks limit first.

Edges.  A null or empty text, or one without terms, is no document (it counts in
neither N nor L).  Every row is a document of its own, also if doc_id is null (first among
equal scores) or repeats.  Rows of equal item_id are one item, a term of several
counting once; a null item_id is an item like others; items without known terms have
no rows.  Equal scores go by doc_id.  Empty tables give empty results.
Only doc_id, text, item_id and text are read, so extra columns do no harm.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hexaccess.llm.common import read_table, running_total, stage_table
from hexaccess.llm.word_ids import slices

#: Text bytes and documents after which a shard is closed; documents of a group; items of a block; intervals popped at a time.
SHARD_BYTES, SHARD_DOCS = 8 << 20, 1 << 14
GROUP_DOCS, BLOCK_ITEMS = 1 << 15, 128
POPPED = 64
TOP = 50
#: Partitions that the (group, block) pairs are dealt to, two for each pair, at the most.
MOST_PARTITIONS = 20_000

POSTINGS = "shard long, term binary, n int, docs binary, counts binary"
SHARDS = "shard long, n_docs long, n_terms long, ids binary, nulls binary, lengths binary"
_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _folded() -> np.ndarray:
    """Bytes as terms have them: A-Z lower-cased, 0 for what stands between terms."""
    table = np.arange(256, dtype=np.uint8)
    for b in range(128):
        c = chr(b)
        table[b] = ord(c.lower()) if c.isalnum() else 0
    return table


_FOLD = _folded()


def terms_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(all terms of these texts in order, as binary; the number of each one's text)."""
    texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    if data is None or offsets[-1] == offsets[0]:
        return pa.array([], pa.large_binary()), np.zeros(0, dtype=np.int64)
    folded = _FOLD[np.frombuffer(data, dtype=np.uint8)[offsets[0]:offsets[-1]]]
    offsets = offsets - offsets[0]
    inside = folded != 0
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    borders = offsets[(offsets > 0) & (offsets < len(folded))]
    starts[borders] = inside[borders]        # a text's first term may touch the one before
    at = np.flatnonzero(starts)
    kept = np.concatenate(([0], np.cumsum(inside, dtype=np.int64)))
    bounds = np.append(kept[at], kept[-1])
    found = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(bounds.tobytes()), pa.py_buffer(folded[inside].tobytes())])
    return found, np.searchsorted(offsets, at, side="right") - 1


def _shard_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Both kinds of rows of a task's shards: those with a null term describe a shard."""
    from pyspark import TaskContext
    shard = TaskContext.get().partitionId() << 32
    ids, nulls, parts, size, docs = [], [], [], 0, 0

    def close() -> Iterator[pa.RecordBatch]:
        terms = pa.chunked_array([t for t, _ in parts], type=pa.large_binary()).combine_chunks()
        place = np.concatenate([p for _, p in parts])
        numbered = terms.dictionary_encode()
        code = np.asarray(numbered.indices).astype(np.int64)
        pairs, counts = np.unique(code * docs + place, return_counts=True)
        code, place = pairs // docs, (pairs % docs).astype("<i4")
        lengths = np.bincount(place, weights=counts, minlength=docs).astype("<i8")
        counts = counts.astype("<i4")
        first = np.append(np.flatnonzero(np.concatenate(([True], code[1:] != code[:-1]))), len(code)) if len(code) else np.zeros(1, np.int64)
        yield pa.RecordBatch.from_pydict({
            "shard": [shard], "term": pa.array([None], pa.binary()), "n": pa.array([int((lengths > 0).sum())], pa.int32()),
            "docs": pa.array([np.concatenate(ids).astype("<i8").tobytes()], pa.binary()),
            "counts": pa.array([np.concatenate(nulls).astype(np.uint8).tobytes() + lengths.tobytes()], pa.binary())})
        of = numbered.dictionary.cast(pa.binary())
        for a in range(0, len(first) - 1, 20_000):
            b = min(a + 20_000, len(first) - 1)
            edges = first[a:b + 1]
            cut = lambda flat: pa.Array.from_buffers(pa.binary(), b - a, [
                None, pa.py_buffer(((edges - edges[0]) * 4).astype("<i4").tobytes()), pa.py_buffer(flat[edges[0]:edges[-1]].tobytes())])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(b - a, shard), pa.int64()), of.take(pa.array(code[edges[:-1]])), pa.array(np.diff(edges), pa.int32()),
                 cut(place), cut(counts)], names=["shard", "term", "n", "docs", "counts"])

    for batch in batches:
        for rows in slices(batch, "text", SHARD_BYTES):
            for at in range(0, len(rows), SHARD_DOCS):
                part = rows.slice(at, SHARD_DOCS)
                if docs and (docs + len(part) > SHARD_DOCS or size >= SHARD_BYTES):
                    yield from close()
                    shard, ids, nulls, parts, size, docs = shard + 1, [], [], [], 0, 0
                terms, place = terms_of(part.column("text"))
                parts.append((terms, place + docs))
                doc_id = part.column("doc_id")
                nulls.append(np.asarray(doc_id.is_null()))
                ids.append(np.asarray(pc.fill_null(doc_id, 0)))
                size, docs = size + part.column("text").nbytes, docs + len(part)
    if docs:
        yield from close()


class Index:
    """A corpus's posting lists and shards as written tables, with N (documents) and L (terms with repeats)."""

    def __init__(self, postings: DataFrame, shards: DataFrame):
        self.postings, self.shards = postings, shards
        row = shards.agg(F.sum("n_docs"), F.sum("n_terms")).first()
        self.n, self.total = row[0] or 0, row[1] or 0


def build_index(docs: DataFrame) -> Index:
    rows = stage_table(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_shard_rows, POSTINGS), "postings")
    heads = rows.where(F.col("term").isNull())

    def opened(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for r in b.itertuples(index=False):
                size = len(r.docs) // 8
                lengths = np.frombuffer(r.counts[size:], dtype="<i8")
                out.append((r.shard, r.n, int(lengths.sum()), r.docs, r.counts[:size], r.counts[size:]))
            yield pd.DataFrame(out, columns=[c.split(" ")[0] for c in SHARDS.split(", ")])

    return Index(rows.where(F.col("term").isNotNull()), stage_table(heads.mapInPandas(opened, SHARDS), "shards"))


# ----------------------------------------------------------------------------- one group of documents

class RangeMaxima:
    """Posting lists side by side, with a sparse table over all: entry (j, i) is the place of the
    largest impact of the 2^j postings from i on.  A list's ranges never leave it."""

    def __init__(self, docs: list[np.ndarray], impacts: list[np.ndarray], n_docs: int):
        self.n_docs = n_docs
        self.starts = np.concatenate(([0], np.cumsum([len(d) for d in docs])))
        self.docs = np.concatenate(docs)
        self.impacts = np.concatenate(impacts)
        self.keys = np.repeat(np.arange(len(docs), dtype=np.int64), np.diff(self.starts)) * (n_docs + 1) + self.docs
        longest = int(np.diff(self.starts).max())
        self.table = [np.arange(len(self.docs), dtype=np.int32)]
        width = 1
        while 2 * width <= longest:
            a, b = self.table[-1][:-width], self.table[-1][width:]
            self.table.append(np.where(self.impacts[a] >= self.impacts[b], a, b))
            width *= 2
        # one table to index at once: rows of equal length
        self.flat = np.zeros((len(self.table), len(self.docs)), dtype=np.int32)
        for j, row in enumerate(self.table):
            self.flat[j, :len(row)] = row
        self.table = None

    def maxima(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(largest impact, its place) of the postings lo..hi-1; 0 for empty ranges."""
        width = hi - lo
        some = width > 0
        level = np.frexp(np.maximum(width, 1).astype(np.float64))[1] - 1
        lo = np.where(some, lo, 0)
        a = self.flat[level, lo]
        b = self.flat[level, np.where(some, hi - (1 << level), 0)]
        x, y = self.impacts[a], self.impacts[b]
        return np.where(some, np.maximum(x, y), 0), np.where(x >= y, a, b)

    def places(self, doc: np.ndarray) -> np.ndarray:
        """For each document (rows) and list (columns) the first posting at or behind the document."""
        lists = np.arange(len(self.starts) - 1, dtype=np.int64) * (self.n_docs + 1)
        return np.searchsorted(self.keys, doc[:, None] + lists[None, :])


def best_documents(lists: RangeMaxima, doc_ids: np.ndarray, nulls: np.ndarray, k: int, popped: int = POPPED) -> list[tuple[int, int]]:
    """(score, document) of the k best documents, equal scores by null and doc_id; documents of equal standing are all kept."""
    heap: list[tuple] = []                     # intervals: (-bound, number), with their ranges aside
    ranges: dict[int, tuple[np.ndarray, np.ndarray, int]] = {}
    number = 0
    found: list[tuple[int, int]] = []
    scores: list[int] = []                     # the k best scores, as a heap

    def push(lo: np.ndarray, hi: np.ndarray) -> None:
        nonlocal number
        most, place = lists.maxima(lo, hi)
        bounds, best = most.sum(axis=1), most.argmax(axis=1)
        doc = lists.docs[place[np.arange(len(best)), best]]
        for i in np.flatnonzero(bounds > 0).tolist():
            if len(scores) < k or bounds[i] >= scores[0]:
                heapq.heappush(heap, (-int(bounds[i]), number))
                ranges[number] = (lo[i], hi[i], int(doc[i]))
                number += 1

    push(lists.starts[None, :-1].copy(), lists.starts[None, 1:].copy())
    while heap and (len(scores) < k or -heap[0][0] >= scores[0]):
        taken = []
        while heap and len(taken) < popped and (len(scores) < k or -heap[0][0] >= scores[0]):
            taken.append(ranges.pop(heapq.heappop(heap)[1]))
        lo, hi = np.stack([t[0] for t in taken]), np.stack([t[1] for t in taken])
        doc = np.array([t[2] for t in taken], dtype=np.int64)
        cut = np.clip(lists.places(doc), lo, hi)
        here = (cut < hi) & (lists.docs[np.minimum(cut, len(lists.docs) - 1)] == doc[:, None])
        score = np.where(here, lists.impacts[np.minimum(cut, len(lists.docs) - 1)], 0).sum(axis=1)
        for s, d in zip(score.tolist(), doc.tolist()):
            if len(scores) < k:
                heapq.heappush(scores, s)
            elif s >= scores[0]:
                heapq.heappushpop(scores, s)
            else:
                continue
            found.append((s, d))
        push(np.concatenate((lo, cut + here)), np.concatenate((cut, hi)))
    found = [f for f in found if len(scores) < k or f[0] >= scores[0]]
    found.sort(key=lambda f: (-f[0], not nulls[f[1]], int(doc_ids[f[1]])))
    return found[:k]


def _search_group(rows: pd.DataFrame, n: int, total: int, k: int) -> pd.DataFrame:
    """The best k documents of one group for each item of one block."""
    heads = rows[rows["weight"].isna()].sort_values("shard")
    doc_ids = np.frombuffer(b"".join(heads["docs"]), dtype="<i8")
    nulls = np.frombuffer(b"".join(heads["counts"]), dtype=np.uint8).astype(bool)
    lengths = np.frombuffer(b"".join(heads["lengths"]), dtype="<i8")
    sizes = [len(x) for x in heads["counts"]]
    base = dict(zip(heads["shard"], np.concatenate(([0], np.cumsum(sizes)))))
    m20 = 20 * (50 + (50 * lengths * n) // max(total, 1))
    terms: dict[bytes, tuple] = {}
    items: dict[int, list[bytes]] = {}
    lists = rows[rows["weight"].notna()].sort_values("shard")
    for term, own in lists.groupby("term", sort=False):
        docs = np.concatenate([np.frombuffer(d, dtype="<i4").astype(np.int64) + base[s] for s, d in zip(own["shard"], own["docs"])])
        tf = np.concatenate([np.frombuffer(c, dtype="<i4").astype(np.int64) for c in own["counts"]])
        terms[term] = docs, int(own["weight"].iloc[0]) * ((1_000_000_000 * tf) // (1000 * tf + m20[docs]))
        for i in own["items"].iloc[0]:
            items.setdefault(i, []).append(term)
    out = []
    for item in sorted(items):
        mine = [terms[t] for t in items[item]]
        for score, doc in best_documents(RangeMaxima([d for d, _ in mine], [x for _, x in mine], len(doc_ids)), doc_ids, nulls, k):
            out.append((item, None if nulls[doc] else int(doc_ids[doc]), score))
    return pd.DataFrame({"_item": pd.array([o[0] for o in out], dtype="Int64"), "doc_id": pd.array([o[1] for o in out], dtype="Int64"),
                         "score": pd.array([o[2] for o in out], dtype="Int64")})


# ----------------------------------------------------------------------------- Spark

def item_terms(items: DataFrame, item: str = "item_id") -> DataFrame:
    """(_item: a hash of the id, item, term) once for each term of an item."""
    lower = F.translate(F.col("text"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    term = F.explode(F.array_distinct(F.regexp_extract_all(lower, F.lit(_TERM), F.lit(0))))
    return items.select(F.col(item).alias("_id"), term.alias("term")).distinct().select(
        "_id", F.col("term").cast("binary").alias("term"))


def search(index: Index, items: DataFrame, k: int = TOP, item: str = "item_id") -> DataFrame:
    """(item, rank, doc_id, score): the k best documents of every item."""
    spark = items.sparkSession
    wanted = item_terms(items, item)
    ids = running_total(wanted.select("_id").distinct().withColumn("_one", F.lit(1)), ["_id"], "_one", "_item").drop("_one")
    asked = stage_table(wanted.join(ids.withColumnRenamed("_id", "_i"), F.col("_id").eqNullSafe(F.col("_i"))).groupBy(
        "term", F.floor(F.col("_item") / BLOCK_ITEMS).cast("long").alias("block")).agg(F.sort_array(F.collect_list("_item")).alias("items")), "asked")
    blocks = (ids.agg(F.max("_item")).first()[0] or 0) // BLOCK_ITEMS + 1
    # the lists of the terms that are asked for; Spark broadcasts the terms only while their table is small
    hits = stage_table(index.postings.join(asked.select("term").distinct(), "term"), "hits")
    df = hits.groupBy("term").agg(F.sum("n").cast("long").alias("df"))
    weight = F.floor(1000 * F.log(F.lit(2 * index.n + 2) / (2 * F.col("df") + 1))).cast("long")
    weighed = asked.join(df, "term").withColumn("weight", weight).where("weight > 0").select("term", "block", "items", "weight")
    placed = running_total(index.shards.select("shard", F.octet_length("nulls").cast("long").alias("_rows")), ["shard"], "_rows", "_before")
    groups = stage_table(placed.select("shard", F.floor(F.col("_before") / GROUP_DOCS).cast("long").alias("group")), "groups")
    lists = hits.join(weighed, "term").join(groups, "shard").select(
        "block", "group", "shard", "term", "weight", "items", "docs", "counts", F.lit(None).cast("binary").alias("lengths"))
    heads = index.shards.join(groups, "shard").select(
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"), "group", "shard", F.lit(None).cast("binary").alias("term"),
        F.lit(None).cast("long").alias("weight"), F.lit(None).cast("array<bigint>").alias("items"), F.col("ids").alias("docs"),
        F.col("nulls").alias("counts"), "lengths")
    n, total = index.n, index.total
    # little data but much work: a number of its own keeps Spark from lumping small partitions together
    parts = min(2 * blocks * ((groups.agg(F.max("group")).first()[0] or 0) + 1), MOST_PARTITIONS)
    found = lists.unionByName(heads).repartition(parts, "block", "group").groupBy("block", "group").applyInPandas(
        lambda rows: _search_group(rows, n, total, k), "_item long, doc_id long, score long")
    order = Window.partitionBy("_item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_first())
    best = stage_table(found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k), "best")
    return best.join(ids, "_item").select(F.col("_id").alias(item), "rank", "doc_id", "score")


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(build_index(read_table(spark, sf_dir, "documents")), read_table(spark, sf_dir, "benchmark"))


OP13_SQL = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
l AS (SELECT doc_id, r, len(ts)::BIGINT AS n, ts FROM d WHERE len(ts) > 0),
g AS (SELECT count(*)::BIGINT AS n_all, sum(n)::BIGINT AS l_all FROM l),
i AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
p AS (SELECT r, term, count(*)::BIGINT AS tf FROM (SELECT r, unnest(ts) AS term FROM l) x WHERE term IN (SELECT term FROM i) GROUP BY r, term),
w AS (SELECT term, floor(1000 * ln((2 * n_all + 2) / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM p, g GROUP BY term, n_all),
s AS (
  SELECT p.r, p.term, w.w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * l.n * n_all) // l_all))) AS x
  FROM p JOIN w ON p.term = w.term JOIN l ON p.r = l.r, g),
t AS (
  SELECT i.item_id, l.doc_id, sum(s.x)::BIGINT AS score FROM i JOIN s ON i.term = s.term JOIN l ON s.r = l.r GROUP BY i.item_id, l.r, l.doc_id)
SELECT item_id, rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS FIRST)::INTEGER AS rank FROM t WHERE score > 0) q
WHERE rank <= 50
"""
