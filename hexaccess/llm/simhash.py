"""SimHash near-duplicates (operator 6).

A document's fingerprint is the bitwise majority of its shingles' 64-bit
hashes.  Fingerprints that differ in at most ``max_bits`` (3) of their bits
share at least 5 of their 8 bytes, position by position.  The index is a
byte-position inverted index: postings are kept for small sets of byte
positions (with these bytes' values), chosen so that any 5 positions contain
one of the sets; a single byte's posting list would hold 1/256 of the corpus.
Within a posting list the shared positional bytes of each pair are tallied,
pairs below the guaranteed 5 are dropped, and the rest are verified bit by bit.

Equal fingerprints meet first in one row, so groups of exact copies cost one
row per task.  A list of up to ``LIST_ROWS`` fingerprints is compared in one
task and gives only the links of a spanning forest.  A longer list is never
compared pair by pair: two of its members are at most 3 bits apart exactly if
some value lies within 2 bits of the one and 1 bit of the other, so members
meet at the values of their bit-flip neighbourhoods, and link to the smallest
member within 1 bit of the value - a number of rows per member that does not
depend on the list.  Both ways give the same components.

Edges.  A null or wordless text has fingerprint zero and is linked like any
other; a text of fewer words than a shingle is one shingle.  Repeated rows
share a component.  A null doc_id gets the component of its fingerprint and
never names it unless no id is in reach (then the component is null).  An empty
table gives an empty result.  Only doc_id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hexaccess.llm.common import read_table, stage_table
from hexaccess.llm.components import components

SHINGLE_WORDS, MAX_BITS, SEED = 3, 3, 42
#: Longest posting list that one task compares pair by pair.
LIST_ROWS = 4096
#: From so many fingerprints on, postings are kept for sets of 4 bytes instead of 3.
WIDE_FROM = 1 << 30


# ----------------------------------------------------------------------------- fingerprints

def fingerprint(text: str | None, size: int = SHINGLE_WORDS) -> int:
    """The 64-bit fingerprint of a text, unsigned."""
    import xxhash
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # of bytes: A-Z only, and exactly the six separators
    if not words:
        return 0
    if len(words) < size:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*[words[i:] for i in range(size)]))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(s, SEED) for s in shingles], dtype="<u8")
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 65_536):
        part = hashes[at:at + 65_536]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<u8")[0])


def _fingerprints(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for texts in batches:
        yield pd.Series(np.array([fingerprint(t) for t in texts], dtype=np.uint64).view(np.int64))


def fingerprint_column(text: Column) -> Column:
    """The fingerprint as a signed long, by Arrow batches."""
    from pyspark.sql.functions import pandas_udf

    @pandas_udf("long")
    def simhash(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        yield from _fingerprints(batches)

    return simhash(text)


# ----------------------------------------------------------------------------- links

def position_sets(size: int, shared: int = 8 - MAX_BITS) -> list[tuple[int, ...]]:
    """Sets of ``size`` byte positions such that any ``shared`` positions contain one of them."""
    if size == 3 and shared == 5:  # of 5 positions, one half of the 8 holds 3
        return [s for half in (range(4), range(4, 8)) for s in combinations(half, 3)]
    wanted, chosen = set(combinations(range(8), shared)), []
    while wanted:
        best = max(combinations(range(8), size), key=lambda s: sum(set(s) <= set(w) for w in wanted))
        chosen.append(best)
        wanted = {w for w in wanted if not set(best) <= set(w)}
    return chosen


def _byte(fp: Column, position: int) -> Column:
    return F.shiftrightunsigned(fp, 8 * position).bitwiseAND(F.lit(255))


def _postings(fps: DataFrame, sets: list[tuple[int, ...]]) -> DataFrame:
    """(key, fp): key the set's number and the values of its bytes."""
    keys = [reduce(lambda k, p: F.shiftleft(k, 8).bitwiseOR(_byte(F.col("fp"), p)), s, F.lit(i).cast("long"))
            for i, s in enumerate(sets)]
    return fps.select(F.explode(F.array(*keys)).alias("key"), "fp")


def _forest(values: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Links of a spanning forest of these fingerprints; a link needs the shared bytes and the bits."""
    rest, links = np.arange(len(values)), []
    while len(rest):
        frontier, rest = [rest[0]], rest[1:]
        while frontier and len(rest):
            at = frontier.pop()
            differ = values[rest] ^ values[at]
            shared = (differ.view(np.uint8).reshape(-1, 8) == 0).sum(axis=1)  # tally of shared positional bytes
            counted = shared >= 8 - max_bits
            near = np.zeros(len(rest), dtype=bool)
            near[counted] = np.bitwise_count(differ[counted]) <= max_bits
            links += [(at, j) for j in rest[near]]
            frontier += list(rest[near])
            rest = rest[~near]
    return links


def _link_lists(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows (key, fp) of a partition in key order; lists may run over batches."""
    key, kept = None, np.zeros(0, dtype=np.uint64)
    for batch in batches:
        keys, fps = batch["key"].to_numpy(), batch["fp"].to_numpy().view(np.uint64)
        starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, int)
        ends = np.append(starts[1:], len(keys))
        out = []
        for a, b in zip(starts, ends):
            if keys[a] == key:
                kept = np.concatenate((kept, fps[a:b]))
                continue
            if len(kept) > 1:
                out += [(kept[i], kept[j]) for i, j in _forest(kept, MAX_BITS)]
            key, kept = keys[a], fps[a:b]
        if out:
            yield pd.DataFrame(np.array(out, dtype=np.uint64).view(np.int64), columns=["u", "v"])
    if len(kept) > 1 and (out := [(kept[i], kept[j]) for i, j in _forest(kept, MAX_BITS)]):
        yield pd.DataFrame(np.array(out, dtype=np.uint64).view(np.int64), columns=["u", "v"])


def _long_list_links(members: DataFrame, sets: list[tuple[int, ...]]) -> DataFrame:
    """Links of lists too long for one task, through the bit-flip neighbourhoods of their free bytes."""
    out = None
    for number, s in enumerate(sets):
        bits = [8 * p + b for p in range(8) if p not in s for b in range(8)]
        value = lambda picked: sum(1 << b for b in picked) - ((1 << 64) if 63 in picked else 0)  # noqa: E731  as a signed long
        flips = [[value(c) for c in combinations(bits, n)] for n in range(3)]
        own = members.where(F.shiftright("key", 8 * len(s)) == number)

        def around(masks, own=own):
            return own.select("key", "fp", F.explode(F.transform(F.array(*[F.lit(m).cast("long") for m in masks]),
                                                                 lambda m: F.col("fp").bitwiseXOR(m))).alias("at"))

        near = around(flips[0] + flips[1]).groupBy("key", "at").agg(F.min("fp").alias("v"))
        links = (around(flips[0] + flips[1] + flips[2]).join(near, ["key", "at"])
                 .select(F.col("fp").alias("u"), "v").where("u <> v"))
        out = links if out is None else out.union(links)
    return out.distinct()


def links(fps: DataFrame, list_rows: int = LIST_ROWS, set_size: int | None = None) -> DataFrame:
    """(u, v): fingerprints of the table (fp, distinct) at most 3 bits apart, enough of them to join all that are in reach."""
    if set_size is None:
        set_size = 3 if fps.count() < WIDE_FROM else 4
    sets = position_sets(set_size)
    postings = _postings(fps, sets)
    long_keys = stage_table(postings.groupBy("key").count().where(F.col("count") > list_rows)
                            .select(F.col("key").alias("_long")), "long-lists")
    short = postings.join(long_keys, F.col("key") == F.col("_long"), "left_anti")
    found = (short.repartition("key").sortWithinPartitions("key")
             .mapInPandas(_link_lists, "u long, v long"))
    if long_keys.limit(1).count():
        long_members = stage_table(postings.join(long_keys, F.col("key") == F.col("_long"), "left_semi"), "long-members")
        found = found.union(_long_list_links(long_members, sets))
    return found


def _grouped(prints: DataFrame, list_rows: int, set_size: int | None) -> DataFrame:
    """(fp, root) for the fingerprints that are linked to another."""
    fps = stage_table(prints.select("fp").distinct(), "fingerprints")
    return stage_table(components(links(fps, list_rows, set_size)).select(F.col("node").alias("fp"), F.col("component").alias("root")),
                       "roots")


def near_duplicates(docs: DataFrame, list_rows: int = LIST_ROWS, set_size: int | None = None) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (smallest doc_id in reach) of every row."""
    prints = stage_table(docs.select("doc_id", fingerprint_column(F.col("text")).alias("fp")), "prints")
    roots = _grouped(prints, list_rows, set_size)
    ids = prints.groupBy("fp").agg(F.min("doc_id").alias("_least"))
    rooted = stage_table(ids.join(roots, "fp", "left").select("fp", "_least", F.coalesce("root", "fp").alias("root")), "rooted")
    named = rooted.groupBy("root").agg(F.min("_least").alias("component_id"))
    by_print = rooted.join(named, "root").select("fp", "component_id")
    return prints.join(by_print, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of each component: that of the smallest doc_id (nulls last), then of the smallest text hash."""
    prints = stage_table(docs.select("doc_id", fingerprint_column(F.col("text")).alias("fp"),
                                     F.xxhash64("text").alias("_h")), "prints")
    roots = _grouped(prints, LIST_ROWS, None)
    firsts = prints.groupBy("fp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "_h")).alias("first"))
    best = (firsts.join(roots, "fp", "left").groupBy(F.coalesce("root", "fp").alias("root"))
            .agg(F.min("first").alias("first"))
            .select(F.col("first.doc_id").alias("_id"), F.col("first._h").alias("_of")))
    repeated = prints.groupBy("doc_id", "_h").count().where("count > 1").select(F.col("doc_id").alias("_rid"), F.col("_h").alias("_rh"))
    best = best.join(repeated, F.col("_id").eqNullSafe(F.col("_rid")) & (F.col("_of") == F.col("_rh")), "left")
    best = stage_table(best.select("_id", "_of", F.col("_rh").isNotNull().alias("_again")).distinct(), "firsts")
    rows = (docs.select(F.struct("*").alias("_row"), F.col("doc_id").alias("_k"), F.xxhash64("text").alias("_h"))
            .join(best, F.col("_k").eqNullSafe(F.col("_id")) & (F.col("_h") == F.col("_of"))))
    # rows that stand in the table more than once with the same id and text: one of them
    once = rows.where(F.col("_again")).dropDuplicates(["_id", "_of"])
    return rows.where(~F.col("_again")).union(once).select("_row.*")


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents"))
