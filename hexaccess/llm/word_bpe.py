"""BPE encoding and decoding by speculation and verification (operator 12).

A text is cut into words as the vocabulary's own normalizer and pre-tokenizer do.
For every new word a greedy longest match *proposes* tokens.  A sequence of
tokens is the merges' result exactly if the merges make each token and leave
every two neighbours apart, and that depends on the two alone.  So the pairs of
all proposals are collected, and numpy *checks* all different pairs at once: the
last merge in either neighbour is undone, then the one before, and so on; at no
time may the two parts that touch the border have had a better merge with each
other.  Only words with a failing pair are merged exactly: short ones together, a
merge of each in a round, long ones by a heap of ranks.

A vocabulary whose merges are out of order (a part ranked behind the whole) is
still encoded rightly: such tokens are never proposed.

Texts stream through ``mapInArrow`` in slices of bounded bytes; a worker keeps the
ids of frequent pieces in a bounded table (``word_ids``).  Nothing is shuffled.

Edges.  A null or empty text, or one of white space alone, has no ids and decodes to
the empty text.  A literal added token (as ``<|endoftext|>``) gets its own id,
as by the library's plain call.  A word of any length costs n log n steps.
Repeated rows are encoded alike; null doc_ids pass through; an empty table
gives an empty result.  The query reads doc_id and text only; ``encode`` keeps
all columns and raises if its output names are taken.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import os
import re
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

#: Pieces that a worker keeps, and bytes of text that it lays out at a time.
KEPT_PIECES, SLICE_BYTES = 400_000, 8 << 20
#: Longer words are merged one by one, shorter ones together.
ROUNDS = 48
_NEVER = 1 << 30
_ASCII_WORD = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\t-\r a-z0-9]+")


def _byte_signs() -> dict[int, int]:
    """Byte-level vocabularies write a byte as the sign of that number; those without a visible sign follow from 256 on."""
    hidden = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255)]
    return {b: 256 + i for i, b in enumerate(hidden)}


class Merges:
    """Tokens, and the merges that make them, as arrays by token id."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], suffix: str = ""):
        self.suffix, self.ids = suffix, vocab
        size = max(vocab.values()) + 1
        self.size = size
        keys = np.array([vocab[a] * size + vocab[b] for a, b in merges], dtype=np.int64)
        made_by = np.array([vocab[a + b] for a, b in merges], dtype=np.int64)
        order = np.argsort(keys, kind="stable")   # a pair that stands twice has its first rank
        self._keys, self._ranks, self._wholes = keys[order], order.astype(np.int64), made_by[order]
        self.rank = np.full(size, -1, dtype=np.int64)
        self.left, self.right = np.zeros(size, dtype=np.int64), np.zeros(size, dtype=np.int64)
        for r in range(len(merges) - 1, -1, -1):   # of several merges to one token the first counts
            t = made_by[r]
            self.rank[t], self.left[t], self.right[t] = r, keys[r] // size, keys[r] % size
        whole = np.flatnonzero(self.rank >= 0)
        a, b = self.left[whole], self.right[whole]
        fits = (self.rank[a] < self.rank[whole]) & (self.rank[b] < self.rank[whole])
        fits[fits] = self.apart(a[fits], b[fits], self.rank[whole[fits]])
        sound = np.zeros(size, dtype=bool)
        single = [i for t, i in vocab.items() if len(t) == 1 or suffix and t.endswith(suffix) and len(t) == len(suffix) + 1]
        sound[single] = True
        for t, ok in sorted(zip(whole.tolist(), fits.tolist()), key=lambda x: self.rank[x[0]]):
            sound[t] = ok and sound[self.left[t]] and sound[self.right[t]]
        #: Tokens that the merges make of their own text: those that may be proposed.
        self.proposable = {t: i for t, i in vocab.items() if sound[i]}
        #: By the first three characters: the most characters of a token that begins so.
        self.reach: dict[str, int] = {}
        for t in self.proposable:
            plain = t.removesuffix(suffix) if suffix else t
            if len(plain) > 2:
                self.reach[plain[:3]] = max(self.reach.get(plain[:3], 0), len(plain))

    def _joined(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of these pairs' merges."""
        if not len(self._keys):
            return np.full(len(left), _NEVER, dtype=np.int64)
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self._keys, key), len(self._keys) - 1)
        return np.where(self._keys[at] == key, self._ranks[at], _NEVER)

    def apart(self, left: np.ndarray, right: np.ndarray, before: np.ndarray | int = _NEVER) -> np.ndarray:
        """Whether the merges of rank under ``before`` leave each left and right token as they are."""
        good = np.zeros(len(left), dtype=bool)
        at = np.arange(len(left))
        left, right = left.copy(), right.copy()
        after_left = np.broadcast_to(np.asarray(before, dtype=np.int64), left.shape).copy()
        after_right = after_left.copy()
        while len(at):
            joined = self._joined(left, right)
            # of equal merges the one further left goes first
            open_ = ~((joined < after_left) & (joined <= after_right))
            of_left, of_right = self.rank[left], self.rank[right]
            plain = (of_left < 0) & (of_right < 0)
            good[at[open_ & plain]] = True
            go = open_ & ~plain
            at, left, right, after_left, after_right = at[go], left[go], right[go], after_left[go], after_right[go]
            of_left, of_right = of_left[go], of_right[go]
            undo = of_left > of_right
            after_left, after_right = np.where(undo, of_left, after_left), np.where(undo, after_right, of_right)
            left, right = np.where(undo, self.right[left], left), np.where(undo, right, self.left[right])
        return good

    def propose(self, word: str) -> list[int]:
        """The longest token at each place, from left to right (empty if there is none somewhere)."""
        get, reach, suffix, n = self.proposable.get, self.reach.get, self.suffix, len(word)
        whole = get(word + suffix)
        if whole is not None:
            return [whole]
        out, at = [], 0
        while at < n:
            end = min(n, at + reach(word[at:at + 3], 2))
            token = None
            if end == n:
                token = get(word[at:] + suffix)
                end -= token is None
            while token is None and end > at:
                token = get(word[at:end])
                end -= token is None
            if token is None:
                return []
            out.append(token)
            at = end
        return out

    def exact(self, word: str) -> list[int]:
        """Merged pair by pair, the best rank first, of equals the leftmost."""
        symbols = [*word[:-1], word[-1] + self.suffix]
        tokens = [i for i in map(self.ids.get, symbols) if i is not None]   # like the library, without an unknown token
        n = len(tokens)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        table, size = self._by_pair, self.size
        heap = []

        def offer(i: int) -> None:
            if i >= 0 and after[i] < n:
                found = table.get(tokens[i] * size + tokens[after[i]])
                if found is not None:
                    heapq.heappush(heap, (found[0], i, tokens[i], tokens[after[i]], found[1]))

        for i in range(n - 1):
            offer(i)
        while heap:
            _, i, a, b, whole = heapq.heappop(heap)
            j = after[i]
            if tokens[i] != a or j >= n or tokens[j] != b:
                continue
            tokens[i], tokens[j] = whole, -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            offer(before[i])
            offer(i)
        return [t for t in tokens if t >= 0]

    def exact_together(self, words: list[str]) -> list[list[int]]:
        """``exact`` of many short words: in each round every word makes its best merge, all in the same arrays."""
        ids = [[t for t in map(self.ids.get, [*w[:-1], w[-1] + self.suffix]) if t is not None] for w in words]
        out: list[list[int]] = [[] for _ in words]
        sizes = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
        tokens = np.fromiter((t for w in ids for t in w), dtype=np.int64, count=int(sizes.sum()))
        word = np.repeat(np.arange(len(ids)), sizes)

        def ranks(at: np.ndarray) -> np.ndarray:
            """Ranks of the pairs that begin at these places."""
            nxt = np.minimum(at + 1, len(tokens) - 1)
            inner = (nxt > at) & (word[nxt] == word[at])
            return np.where(inner, self._joined(tokens[at], tokens[nxt]), _NEVER)

        rank = ranks(np.arange(len(tokens)))
        while len(tokens):
            starts = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
            best = np.minimum.reduceat(rank, starts)
            spans = np.diff(np.append(starts, len(tokens)))
            if (best == _NEVER).any():
                done = best == _NEVER
                for w, a, n in zip(word[starts[done]].tolist(), starts[done].tolist(), spans[done].tolist()):
                    out[w] = tokens[a:a + n].tolist()
                keep = np.repeat(~done, spans)
                tokens, word, rank = tokens[keep], word[keep], rank[keep]
                continue
            at = np.flatnonzero(rank == np.repeat(best, spans))
            at = at[np.concatenate(([True], word[at[1:]] != word[at[:-1]]))]   # the leftmost of each word
            key = tokens[at] * self.size + tokens[at + 1]
            tokens[at] = self._wholes[np.searchsorted(self._keys, key)]
            keep = np.ones(len(tokens), dtype=bool)
            keep[at + 1] = False
            tokens, word, rank = tokens[keep], word[keep], rank[keep]
            at -= np.arange(len(at))                                           # one place is gone before each further one
            before = at[(at > 0) & (word[at - 1] == word[at])] - 1
            rank[at], rank[before] = ranks(at), ranks(before)
        return out

    @property
    def _by_pair(self) -> dict[int, tuple[int, int]]:
        if not hasattr(self, "_pairs"):
            self._pairs = {}
            for k, r, w in zip(self._keys.tolist(), self._ranks.tolist(), self._wholes.tolist()):
                self._pairs.setdefault(k, (r, w))
        return self._pairs

    def encode_words(self, words: list[str]) -> tuple[list[list[int]], int]:
        """(ids of these words, how many of them had to be merged exactly)."""
        found = [self.propose(w) for w in words]
        sizes = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        flat = np.fromiter((t for f in found for t in f), dtype=np.int64, count=int(sizes.sum()))
        word_of = np.repeat(np.arange(len(found)), sizes)
        inner = np.flatnonzero(word_of[:-1] == word_of[1:]) if len(flat) else np.zeros(0, dtype=np.int64)
        pairs, which = np.unique(flat[inner] * self.size + flat[inner + 1], return_inverse=True)
        good = self.apart(pairs // self.size, pairs % self.size)
        failing = sizes == 0
        failing[word_of[inner[~good[which]]]] = True
        again = np.flatnonzero(failing).tolist()
        short = [i for i in again if len(words[i]) <= ROUNDS]
        for i, ids in zip(short, self.exact_together([words[i] for i in short])):
            found[i] = ids
        for i in again:
            if len(words[i]) > ROUNDS:
                found[i] = self.exact(words[i])
        return found, len(again)


class WordEncoder:
    """Ids of texts by a tokenizer file whose words never hold white space, and texts of ids."""

    def __init__(self, path: str, kept: int = KEPT_PIECES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or spec["decoder"] is not None or model["continuing_subword_prefix"]:
            raise ValueError(f"{path}: not a plain BPE vocabulary with word ends")
        if any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError(f"{path}: added tokens that change what stands beside them are not supported")
        self._library = Tokenizer.from_file(path)
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.merges = Merges(model["vocab"], pairs, model["end_of_word_suffix"] or "")
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self._added = added
        self._special = re.compile("|".join(map(re.escape, sorted(added, key=len, reverse=True)))) if added else None
        self._signs = _byte_signs()
        texts = {i: t for t, i in model["vocab"].items()} | {i: t for t, i in added.items()}
        size = max(texts) + 1
        self.token_texts = np.array([texts.get(i, "") for i in range(size)], dtype=object)
        self.token_numbers = np.array([str(i) for i in range(size)], dtype=object)
        self.merged_exactly = 0
        self._table = PieceTable(self._piece_ids, "<u4", kept)

    def _words(self, text: str) -> list[str]:
        """The words of a text without added tokens, each byte written as its sign."""
        if text.isascii():
            return [w.translate(self._signs) if not w.isalnum() else w for w in _ASCII_WORD.findall(text.lower())]
        normal = self._library.normalizer.normalize_str(text)
        return [w for w, _ in self._library.pre_tokenizer.pre_tokenize_str(normal)]

    def _piece_ids(self, pieces: list[str]) -> list[bytes]:
        """Ids of pieces without ASCII white space: words of all of them are proposed and checked together."""
        parts: list[list] = []           # of each piece: words, and ids of added tokens
        for piece in pieces:
            if self._special and self._special.search(piece):
                own, at = [], 0
                for m in self._special.finditer(piece):
                    own += [*self._words(piece[at:m.start()]), self._added[m.group()]]
                    at = m.end()
                parts.append(own + self._words(piece[at:]))
            else:
                parts.append(self._words(piece) if piece else [])
        words = list({w for p in parts for w in p if isinstance(w, str)})
        found, exactly = self.merges.encode_words(words)
        self.merged_exactly += exactly
        known = dict(zip(words, found))
        return [array("I", known[p[0]] if len(p) == 1 and isinstance(p[0], str) else
                      [i for w in p for i in (known[w] if isinstance(w, str) else (w,))]).tobytes() for p in parts]

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after another, text boundaries in them)."""
        if not texts:
            return np.zeros(0, dtype="<u4"), np.zeros(1, dtype=np.int64)
        column = pa.array([t or "" for t in texts], type=pa.large_string())
        _, offsets, data = column.buffers()
        blank = np.arange(256, dtype=np.uint8)
        blank[9:14] = 32                 # tab to carriage return: white space like the space
        spaced = pa.py_buffer(blank[np.frombuffer(data, dtype=np.uint8)].tobytes() if data else b"")
        return self._table.texts(pa.LargeStringArray.from_buffers(len(column), offsets, spaced))

    def decode(self, ids: np.ndarray) -> str:
        """As the library without a decoder: the tokens' texts with a space between."""
        return " ".join(self.token_texts[ids].tolist())


@lru_cache(maxsize=1)
def _encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def encode(docs: DataFrame, path: str, ids: str = "word_ids", n_ids: str = "n_word_ids") -> DataFrame:
    """``docs`` with the ids of their texts (array of int) and how many these are."""
    taken = {ids, n_ids} & set(docs.columns)
    if taken:
        raise ValueError(f"columns {sorted(taken)} are there already; choose other names for the ids")

    @F.arrow_udf("array<int>")
    def found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        enc = _encoder(path)
        for batch in batches:
            out = []
            for part in slices(pa.RecordBatch.from_arrays([batch], names=["text"]), "text", SLICE_BYTES):
                flat, bounds = enc.encode(part.column("text").to_pylist())
                out.append(pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(flat.astype("<i4"))))
            yield pa.concat_arrays(out) if out else pa.array([], pa.list_(pa.int32()))

    return docs.withColumn(ids, found("text")).withColumn(n_ids, F.size(ids).cast("long"))


def decode(ids_column, path: str):
    """The decoded texts of an id array column (null for null)."""

    @F.pandas_udf("string")
    def text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        enc = _encoder(path)
        for rows in batches:
            yield pd.Series([None if r is None else enc.decode(np.asarray(r, dtype=np.int64)) for r in rows], dtype=object)

    return text(ids_column)


def op12_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (of the decimal ids), decoded_sha256."""
    import public_tokenizers
    path = public_tokenizers.path("word_bpe_49k.json")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoder(path)
        sha = hashlib.sha256
        for batch in batches:
            for rows in slices(batch, "text", SLICE_BYTES):
                flat, bounds = enc.encode(rows.column("text").to_pylist())
                of_ids, of_text = [], []
                for a, b in zip(bounds.tolist(), bounds[1:].tolist()):
                    ids = flat[a:b]
                    of_ids.append(sha(" ".join(enc.token_numbers[ids].tolist()).encode()).hexdigest())
                    of_text.append(sha(enc.decode(ids).encode()).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id"), pa.array(np.diff(bounds), pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    docs = read_table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long"), "text")
    return docs.mapInArrow(digest, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
