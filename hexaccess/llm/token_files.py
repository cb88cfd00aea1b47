"""Token-id files with Elias-Fano document boundaries (operator 5).

Documents are put in ascending doc_id order by a range partitioning, encoded,
and written as blocks: one concatenated little-endian id array per block, the
documents' end offsets as an Elias-Fano sequence (about 2 + log2(mean length)
bits a document instead of 64), their doc_ids, and a short header.  A block is
a row of a Parquet table, so Spark's committer makes every task's file atomic
(a lost executor leaves no half file) on any file system Spark can write.
Reading opens a block's boundaries through ``select``: the position of the
i-th set bit gives document i's end without decoding the ones before it.

The encoder splits a text at spaces that the vocabulary's pre-tokenizer always
splits at, and keeps the ids of short pieces in a bounded table, so the
tokenizers library sees each frequent word once per worker.  The string of an
added token in a text gives that token's id, as the library's plain call does.

Edges.  A null text is the empty one: a document of the end id alone.  Null
doc_ids come first; rows of equal doc_id stand in order of a hash of the text,
then the text.  An empty table gives files without blocks and an empty result.
A document longer than a block's target size makes a block of its own.  Only
doc_id and text are read, so extra columns of any name do no harm.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hexaccess.llm.common import read_table
from hexaccess.llm.word_ids import PieceTable, slices
from hexaccess.session import scratch_path

END_ID = 0
#: Ids and documents after which a block is closed.
BLOCK_IDS, BLOCK_DOCS = 1 << 20, 1 << 13
#: Pieces that a worker keeps, and bytes of text that it lays out at a time.
KEPT_PIECES, SLICE_BYTES = 800_000, 16 << 20

BLOCK_SCHEMA = ("block int, shard_start long, n_docs int, n_ids long, id_bytes int, doc_ids array<long>, ids binary, "
                "ef_low_bits int, ef_low binary, ef_high binary, shard int")
BLOCK_ARROW = pa.schema([("block", pa.int32()), ("shard_start", pa.int64()), ("n_docs", pa.int32()), ("n_ids", pa.int64()),
                         ("id_bytes", pa.int32()), ("doc_ids", pa.list_(pa.int64())), ("ids", pa.binary()),
                         ("ef_low_bits", pa.int32()), ("ef_low", pa.binary()), ("ef_high", pa.binary()), ("shard", pa.int32())])


# ----------------------------------------------------------------------------- Elias-Fano

class EliasFano:
    """A non-decreasing sequence of integers in [0, universe].

    The low ``low_bits`` bits of each value are packed side by side; the high
    parts are unary: bit ``high(i) + i`` is set for value i.  ``select`` finds the
    i-th set bit through one 32-bit rank for every 512 bits of the high part.
    """

    _SAMPLE = 64    # bytes between two ranks

    def __init__(self, n: int, low_bits: int, low: bytes, high: bytes):
        self.n, self.low_bits = n, low_bits
        self._low = np.frombuffer(low, dtype=np.uint8)
        self._high = np.frombuffer(high, dtype=np.uint8)
        starts = np.arange(0, len(self._high), self._SAMPLE)
        ones = np.add.reduceat(np.bitwise_count(self._high), starts, dtype=np.uint32) if len(starts) else np.zeros(0, np.uint32)
        self._ranks = np.concatenate((np.zeros(1, np.uint32), np.cumsum(ones[:-1], dtype=np.uint32)))  # set bits before each sample

    @staticmethod
    def pack(values: np.ndarray, universe: int) -> tuple[int, bytes, bytes]:
        values = np.asarray(values, dtype=np.int64)
        n = len(values)
        low_bits = max(0, int(universe // max(n, 1)).bit_length() - 1)
        shifts = np.arange(low_bits - 1, -1, -1, dtype=np.int64)
        low = np.packbits(((values[:, None] >> shifts) & 1).astype(np.uint8).ravel()) if low_bits else np.zeros(0, np.uint8)
        high = np.zeros(int(universe >> low_bits) + n + 1, dtype=np.uint8)
        high[(values >> low_bits) + np.arange(n)] = 1
        return low_bits, low.tobytes(), np.packbits(high).tobytes()

    def select(self, index) -> np.ndarray:
        """The values at these positions."""
        index = np.atleast_1d(np.asarray(index, dtype=np.int64))
        out = [self._select(index[at:at + 4096]) for at in range(0, len(index), 4096)]
        return np.concatenate(out) if out else np.zeros(0, np.int64)

    def _select(self, index: np.ndarray) -> np.ndarray:
        sample = np.searchsorted(self._ranks, index, side="right") - 1
        at = sample[:, None] * self._SAMPLE + np.arange(self._SAMPLE)
        near = np.where(at < len(self._high), self._high[np.minimum(at, len(self._high) - 1)], 0).astype(np.uint8)
        upto = np.cumsum(np.bitwise_count(near), axis=1, dtype=np.int64)   # set bits up to each byte of the sample
        wanted = index - self._ranks[sample]
        local = np.argmax(upto > wanted[:, None], axis=1)
        row = np.arange(len(index))
        bits = np.unpackbits(near[row, local][:, None], axis=1)
        left = wanted - upto[row, local] + bits.sum(axis=1)                # rank within the byte
        bit = np.argmax((np.cumsum(bits, axis=1) - 1 == left[:, None]) & (bits == 1), axis=1)
        byte = sample * self._SAMPLE + local
        value = (byte * 8 + bit - index) << self.low_bits
        if self.low_bits:
            at = index[:, None] * self.low_bits + np.arange(self.low_bits)
            taken = (self._low[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1
            value = value + taken.astype(np.int64) @ (1 << np.arange(self.low_bits - 1, -1, -1, dtype=np.int64))
        return value


# ----------------------------------------------------------------------------- encoding

#: White space as the pre-tokenizer sees it, and a few characters more, which only makes pieces longer.
_WS = r"\s\x85᠎​﻿"
_DOUBTFUL = re.compile(f" (?:[{_WS}]|\\Z)")
_SAFE_SPACE = re.compile(f"(?<![{_WS}]) | (?=[^{_WS}])")


#: The byte-level vocabulary writes a byte as the sign of that number; those without a visible sign follow from 256 on.
_HIDDEN = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255)]
_BYTE_SIGNS = {b: 256 + i for i, b in enumerate(_HIDDEN)}
_SPACE_SIGN = chr(_BYTE_SIGNS[32])
#: Signs that are one token's text when they follow letters (the apostrophe may not be).
_SIGNS = ".,;:!?*#$%&|()-"


def split_pieces(text: str) -> list[str]:
    """Pieces to encode one by one; before each but the first stands one space.

    The pre-tokenizer ends a token before a space unless white space (or white
    space and the end) stands on both sides of it, and no token of other
    characters ends with a space, so the pieces' ids joined are the text's ids.
    """
    return _SAFE_SPACE.split(text) if _DOUBTFUL.search(text) else text.split(" ")


class TextEncoder:
    """Ids of texts, by the tokenizers library over their different pieces."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self._tokenizer = Tokenizer.from_file(path)
        added = json.loads(self._tokenizer.to_str())["added_tokens"]
        odd = [t for t in added if t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"]]
        if odd:
            raise ValueError(f"added tokens that reach beyond their own text: {odd}")
        self._added = {t["content"]: array("I", [t["id"]]) for t in added}
        # the library takes added tokens out first, leftmost and longest; what lies between is encoded on its own
        names = "|".join(re.escape(c) for c in sorted(self._added, key=lambda c: -len(c)))
        self._cut = re.compile(f"({names})") if names else None
        self.id_bytes = 2 if self._tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4
        self._code = {2: "H", 4: "I"}[self.id_bytes]
        self._added = {c: array(self._code, i).tobytes() for c, i in self._added.items()}
        self._merge = self._tokenizer.model.tokenize
        self._signs: dict[str, bytes] = {}
        self._table = PieceTable(self._piece_ids, f"<u{self.id_bytes}", KEPT_PIECES)

    def _ids(self, texts: list[str]) -> list[bytes]:
        out = []
        for at in range(0, len(texts), 10_000):
            found = self._tokenizer.encode_batch_fast(texts[at:at + 10_000], add_special_tokens=False)
            out += [array(self._code, e.ids).tobytes() for e in found]
        return out

    def _merged(self, token: str) -> bytes:
        """Ids of one token's text, straight from the merges."""
        if not token.isascii() or token[0] == " ":
            token = token.encode().decode("latin-1").translate(_BYTE_SIGNS)
        return array(self._code, [t.id for t in self._merge(token)]).tobytes()

    def _piece_ids(self, pieces: list[str]) -> list[bytes]:
        """Ids of pieces after a space.  Letters are one token's text, and signs behind them another's."""
        out, rest = [], []
        for i, p in enumerate(pieces):
            word = p.rstrip(_SIGNS)
            if word.isalpha():
                ids = self._merged(" " + word) if not word.isascii() else self._merged_word(word)
                if len(word) < len(p):
                    signs = p[len(word):]
                    if signs not in self._signs:
                        if len(self._signs) > 10_000:
                            self._signs.clear()
                        self._signs[signs] = self._merged(signs)
                    ids += self._signs[signs]
                out.append(ids)
            else:
                out.append(b"")
                rest.append(i)
        for i, ids in zip(rest, self._ids([" " + pieces[i] for i in rest])):
            out[i] = ids
        return out

    def _merged_word(self, word: str) -> bytes:
        return array(self._code, [t.id for t in self._merge(_SPACE_SIGN + word)]).tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as the library's plain call gives them (added tokens in a text included)."""
        cut = {i: self._cut.split(t) for i, t in enumerate(texts) if self._cut.search(t)} if self._cut else {}
        if not cut:
            return self._encode_between(texts)
        rest = [t for i, t in enumerate(texts) if i not in cut]
        flat = [p for parts in cut.values() for p in parts[::2]]     # the odd ones are the added tokens
        found = iter(self._encode_between(rest + flat))
        out = [b"" if i in cut else next(found) for i in range(len(texts))]
        for i, parts in cut.items():
            out[i] = b"".join(self._added[p] if k % 2 else next(found) for k, p in enumerate(parts))
        return out

    def _encode_between(self, texts: list[str]) -> list[bytes]:
        plain = [i for i, t in enumerate(texts) if not _DOUBTFUL.search(t)]
        out = [b""] * len(texts)
        ids, bounds = self._table.texts(pa.array([texts[i] for i in plain], type=pa.large_string()), skip_first=True)
        firsts = self._ids([texts[i].partition(" ")[0] for i in plain])
        for i, first, a, b in zip(plain, firsts, bounds, bounds[1:]):
            out[i] = first + ids[a:b].tobytes()
        for i in set(range(len(texts))) - set(plain):
            pieces = _SAFE_SPACE.split(texts[i])
            different = list(set(pieces[1:]))
            known = dict(zip(different, self._table.lookup(different)))
            out[i] = self._ids(pieces[:1])[0] + b"".join([known[p] for p in pieces[1:]])
        return out


@lru_cache(maxsize=2)
def _encoder(path: str) -> TextEncoder:
    return TextEncoder(path)


def _blocks(batches: Iterator[pa.RecordBatch], tokenizer_path: str) -> Iterator[pa.RecordBatch]:
    enc = _encoder(tokenizer_path)
    end = np.array([END_ID], dtype=f"<u{enc.id_bytes}").tobytes()
    docs, parts, ends = [], [], []
    shard, block, shard_start, total = 0, 0, 0, 0

    def close() -> pa.RecordBatch:
        low_bits, low, high = EliasFano.pack(np.array(ends, dtype=np.int64), total)
        row = {"block": block, "shard_start": shard_start, "n_docs": len(docs), "n_ids": total, "id_bytes": enc.id_bytes,
               "doc_ids": docs, "ids": b"".join(parts), "ef_low_bits": low_bits, "ef_low": low, "ef_high": high, "shard": shard}
        return pa.RecordBatch.from_pylist([row], schema=BLOCK_ARROW)

    for batch in batches:
        for rows in slices(batch, "text", SLICE_BYTES):
            shard = rows.column("shard")[0].as_py()
            texts = [t or "" for t in rows.column("text").to_pylist()]
            for doc_id, ids in zip(rows.column("doc_id").to_pylist(), enc.encode(texts)):
                size = len(ids) // enc.id_bytes + 1
                if docs and (total + size > BLOCK_IDS or len(docs) >= BLOCK_DOCS):
                    yield close()
                    block, shard_start = block + 1, shard_start + total
                    docs, parts, ends, total = [], [], [], 0
                docs.append(doc_id)
                parts += [ids, end]
                total += size
                ends.append(total)
    if docs:
        yield close()


def write_token_files(docs: DataFrame, path: str, tokenizer_path: str) -> None:
    """Write the documents' ids, in ascending doc_id order, as block files under ``path``."""
    ordered = (docs.select("doc_id", "text", F.xxhash64("text").alias("_h"))
               .repartitionByRange(F.col("doc_id").asc_nulls_first(), F.col("_h"))
               .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "_h", "text")
               .select(F.col("doc_id").cast("long"), "text", F.spark_partition_id().alias("shard")))
    blocks = ordered.mapInArrow(lambda batches: _blocks(batches, tokenizer_path), BLOCK_SCHEMA)
    blocks.write.mode("overwrite").option("compression", "zstd").parquet(path)


def _documents(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for row in batch.itertuples(index=False):
            ends = EliasFano(row.n_docs, row.ef_low_bits, row.ef_low, row.ef_high).select(np.arange(row.n_docs))
            starts = np.concatenate(([0], ends[:-1]))
            ids = np.frombuffer(row.ids, dtype=f"<u{row.id_bytes}").astype("<u4")
            yield pd.DataFrame({
                "doc_id": pd.array([None if pd.isna(d) else int(d) for d in row.doc_ids], dtype="Int64"),
                "start": row.base + row.shard_start + starts, "n_tokens": ends - starts,
                "ids_crc32": [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(starts, ends)]})


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document in the files.

    A document's start is its shard's base (a running sum over shards, one
    number per write task), its block's place in the shard, and the boundary.
    """
    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(path)
    totals = sorted((r["shard"], r["t"]) for r in blocks.groupBy("shard").agg(F.sum("n_ids").alias("t")).collect())
    bases, base = [], 0
    for shard, total in totals:
        bases.append((shard, base))
        base += total
    shards = spark.createDataFrame(bases, "_shard int, base long")
    based = blocks.join(F.broadcast(shards), F.col("shard") == F.col("_shard")).drop("_shard")
    return based.mapInPandas(_documents, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    path = scratch_path(spark, "token-files")
    write_token_files(read_table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return read_token_files(spark, path)
