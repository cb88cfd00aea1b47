"""SentencePiece encoding and decoding by a streaming Viterbi search (operator 9).

A text is read character by character.  For each boundary the best way to get
there is kept as one backpointer (the last piece); a window of the boundaries
since the last commit is all that is held.  The paths that can still matter
start at the last ``longest piece`` boundaries; whenever they all run through one
boundary, the ids up to it are committed and the window moves on.

What makes a path best depends on the model's kind.  For a unigram model it is
the sum of the pieces' scores.  For a BPE model it is agreement with the merges:
the encoding of a prefix is that of a shorter prefix and one more piece exactly
if the merges leave the last two pieces apart, which depends on these two pieces
alone, so one piece per boundary survives - the ids are those of the merge
order.  Characters without a piece become their bytes' pieces.

No piece holds a space mark behind another character, so all paths meet before
each word; the segments between these boundaries repeat, and a bounded table
keeps the ids of short ones.

Edges.  A null or empty text has no ids (a null decodes to the empty text).
A space mark (U+2581) in a text is read as a space, as the vocabulary has it;
such texts don't decode to themselves.  Repeated rows are encoded alike.  Null
doc_ids pass through; an empty table gives an empty result.  Only doc_id and text
are read by the query, so extra columns of any name do no harm; ``encode``
keeps all columns and puts its own (``piece_ids``, ``n_ids``) in place of any of these names.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections import namedtuple
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from hexaccess.llm.common import read_table
from hexaccess.llm.word_ids import PieceTable, slices

SPACE = "▁"
UNIGRAM, BPE = "unigram", "bpe"
#: How far below the worst piece an unknown character scores (unigram models).
UNKNOWN_PENALTY = 10.0
#: What a worker may hold: pieces and borders that it keeps, and bytes of text that it lays out at a time.
#: More of it is less work; beside other stages' workers there is room for less.
Room = namedtuple("Room", "pieces borders slice_bytes")
ALONE, SHARED = Room(600_000, 300_000, 8 << 20), Room(120_000, 60_000, 2 << 20)
_SEGMENT = re.compile(" *[^ ]+| +")
_SPACES = re.compile("\\A |  | \\Z")


class Vocabulary:
    """Pieces with ids and scores, and the 256 byte pieces."""

    def __init__(self, pieces: Iterable[tuple[str, int, float]], byte_ids: dict[int, int], kind: str):
        self.kind = kind
        self.ids, self.scores = {}, {}
        for piece, i, score in pieces:
            self.ids[piece], self.scores[piece] = i, score
        self.byte_ids = byte_ids
        self.longest = max(map(len, self.ids), default=1)
        self.unknown = min(self.scores.values(), default=0.0) - UNKNOWN_PENALTY
        self.texts = {i: p for p, i in self.ids.items()}
        self.bytes = {i: bytes([b]) for b, i in byte_ids.items()}
        self._apart: dict[tuple[str, str], bool] = {}
        self.borders = ALONE.borders
        # of a BPE model: the pieces that the merges make at all, with the two parts of the last merge, and
        # what the ends of these may look like
        self.made: dict[str, tuple[str, str] | None] = {}
        for p in self.ids if kind == BPE else ():
            parts = self.merged(p, 2)
            if len(p) == 1 or len(parts) == 2 and parts[0] + parts[1] in self.ids:
                self.made[p] = tuple(parts) if len(p) > 1 else None
        self.ends = {p[i:] for p in self.made for i in range(len(p))}
        table = [""] * (max(self.texts, default=-1) + 1)
        for i, p in self.texts.items():
            table[i] = p.replace(SPACE, " ")
        self.table = np.array(table, dtype=object)
        self.is_byte = np.zeros(max([*self.texts, *byte_ids.values()], default=0) + 1, dtype=bool)
        self.is_byte[list(byte_ids.values())] = True

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        """From a SentencePiece model file."""
        from sentencepiece import sentencepiece_model_pb2
        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        normal = [(p.piece, i, p.score) for i, p in enumerate(model.pieces) if p.type == 1]
        as_bytes = {int(p.piece[3:5], 16): i for i, p in enumerate(model.pieces) if p.type == 6}
        return cls(normal, as_bytes, {1: UNIGRAM, 2: BPE}[model.trainer_spec.model_type])

    def merged(self, text: str, stop: int = 1) -> list[str]:
        """Characters merged pair by pair, the best-scored pair first, the leftmost of equals, down to ``stop`` parts."""
        parts, score = list(text), self.scores.get
        while len(parts) > stop:
            ranks = [score(a + b, -np.inf) for a, b in zip(parts, parts[1:])]
            best = max(ranks)
            if best == -np.inf:
                break
            at = ranks.index(best)
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def apart(self, left: str, right: str) -> bool:
        """Whether the merges leave these two pieces next to each other as they are."""
        known = self._apart.get((left, right))
        if known is None:
            if len(self._apart) > self.borders:
                self._apart.clear()
            known = self._apart[left, right] = self._never_joined(left, right)
        return known

    def _never_joined(self, left: str, right: str) -> bool:
        """The last merge of the two is undone, then the one before, and so on: at each time what
        touches the border must not have had a better merge with each other (of equals the left one goes first)."""
        if SPACE in left[1:] or SPACE in right:
            return self.merged(left + right) == [left, right]  # runs of spaces: pieces of equal score
        score, made = self.scores.get, self.made
        after_left = after_right = -np.inf
        while True:
            joined = score(left + right)
            if joined is not None and joined > after_left and joined >= after_right:
                return False
            a, b = made.get(left), made.get(right)
            if a is None and b is None:
                return True
            if b is None or a is not None and self.scores[left] < self.scores[right]:
                after_left, left = self.scores[left], a[1]
            else:
                after_right, right = self.scores[right], b[0]

    def piece_ids(self, piece: str) -> list[int]:
        i = self.ids.get(piece)
        return [i] if i is not None else [self.byte_ids[b] for b in piece.encode("utf-8", "surrogatepass")]


class StreamingSegmenter:
    """Pieces of a stream of characters; ``feed`` and ``finish`` give the ids that are certain."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.text = ""               # the window: characters since the last commit
        self.length = [0]            # by boundary of the window: length of the last piece (0 at its start)
        self.score = [0.0]
        self.before: str | None = None  # the piece that ends where the window begins
        self.widest = 0              # for tests: the longest window

    def _step(self, end: int) -> None:
        v, text = self.v, self.text
        if v.kind == BPE:
            for n in range(min(v.longest, end), 0, -1):
                piece = text[end - n:end]
                if n == 1 or piece in v.made:
                    at = end - n
                    left = text[at - self.length[at]:at] if at else self.before
                    if left is None or v.apart(left, piece):
                        self.length.append(n)
                        break
            self.score.append(0.0)
            return
        best, length = -np.inf, 1
        for n in range(1, min(v.longest, end) + 1):
            piece = text[end - n:end]
            s = v.scores.get(piece, v.unknown if n == 1 else None)
            if s is not None and self.score[end - n] + s > best:
                best, length = self.score[end - n] + s, n
        self.length.append(length)
        self.score.append(best)

    def _meet(self) -> int:
        """The last boundary that all surviving paths run through."""
        end = len(self.text)
        alive = set(range(max(0, end - self.v.longest + 1), end + 1))
        while len(alive) > 1:
            last = max(alive)
            alive.remove(last)
            alive.add(last - self.length[last])
        return alive.pop()

    def _commit(self, upto: int) -> list[int]:
        pieces, at = [], upto
        while at:
            pieces.append(self.text[at - self.length[at]:at])
            at -= self.length[at]
        if not pieces:
            return []
        pieces.reverse()
        self.before = pieces[-1]
        self.text = self.text[upto:]
        self.length = [0] + self.length[upto + 1:]
        self.score = [0.0] + [s - self.score[upto] for s in self.score[upto + 1:]]
        return [i for p in pieces for i in self.v.piece_ids(p)]

    def feed(self, text: str) -> list[int]:
        out, step = [], 2 * self.v.longest
        for at in range(0, len(text), step):
            self.text += text[at:at + step]
            for end in range(len(self.length), len(self.text) + 1):
                self._step(end)
            self.widest = max(self.widest, len(self.text))
            out += self._commit(self._meet())
        return out

    def finish(self) -> list[int]:
        out = self._commit(len(self.text))
        self.__init__(self.v)
        return out


class Encoder:
    """Ids of whole texts (as little-endian 32-bit integers), and texts of ids."""

    def __init__(self, vocabulary: Vocabulary, room: Room = ALONE):
        self.v = vocabulary
        self.v.borders = room.borders
        self._split = not any(SPACE in p.lstrip(SPACE) for p in vocabulary.ids)
        self._table = PieceTable(lambda words: [self._segment(" " + w) for w in words], "<u4", room.pieces)

    def _segment(self, segment: str) -> bytes:
        text = segment.replace(" ", SPACE)
        if self.v.kind == BPE and len(text) <= 2 * self.v.longest:
            return array("I", self._short(text)).tobytes()
        stream = StreamingSegmenter(self.v)
        return array("I", stream.feed(text) + stream.finish()).tobytes()

    def _short(self, text: str) -> list[int]:
        """The stream's steps for a segment that ends before the first commit, without the window's upkeep."""
        v = self.v
        ids, made, ends, apart, known = v.ids, v.made, v.ends, v.apart, v._apart.get
        last: list[str | None] = [None]
        for end in range(1, len(text) + 1):
            for at in range(end - 1, -1, -1):
                piece = text[at:end]
                if piece in made or at == end - 1:
                    left = last[at]
                    if left is None or (apart(left, piece) if (fits := known((left, piece))) is None else fits):
                        last.append(piece)
                        break
                elif piece not in ends:
                    break
        pieces, at = [], len(text)
        while at:
            pieces.append(last[at])
            at -= len(last[at])
        out: list[int] = []
        for piece in reversed(pieces):
            i = ids.get(piece)
            if i is None:
                out += v.piece_ids(piece)
            else:
                out.append(i)
        return out

    def encode(self, texts: list[str | None]) -> list[bytes]:
        out = [b""] * len(texts)
        texts = [t and t.replace(SPACE, " ") for t in texts]
        # words with one space before each; the first one's space is the vocabulary's own
        plain = [i for i, t in enumerate(texts) if t and self._split and not _SPACES.search(t)]
        ids, bounds = self._table.texts(pa.array([texts[i] for i in plain], type=pa.large_string()))
        for i, a, b in zip(plain, bounds, bounds[1:]):
            out[i] = ids[a:b].tobytes()
        for i, t in enumerate(texts):
            if t and not self._split:
                out[i] = self._segment(" " + t)
            elif t and _SPACES.search(t):
                segments = [s[1:] for s in _SEGMENT.findall(" " + t)]
                different = list(set(segments))
                known = dict(zip(different, self._table.lookup(different)))
                out[i] = b"".join([known[s] for s in segments])
        return out

    def decode(self, ids: bytes) -> str:
        v, numbers = self.v, np.frombuffer(ids, dtype="<u4")
        raw = np.flatnonzero(v.is_byte[numbers])
        if not len(raw):
            text = "".join(v.table[numbers].tolist())
        else:  # neighbouring byte pieces are characters together
            out, at = [], 0
            for run in np.split(raw, np.flatnonzero(np.diff(raw) > 1) + 1):
                out.append("".join(v.table[numbers[at:run[0]]].tolist()))
                out.append(b"".join([v.bytes[i] for i in numbers[run].tolist()]).decode("utf-8", "replace"))
                at = run[-1] + 1
            text = "".join(out) + "".join(v.table[numbers[at:]].tolist())
        return text[1:] if text.startswith(" ") else text


@lru_cache(maxsize=2)
def _encoder(path: str, room: Room) -> Encoder:
    return Encoder(Vocabulary.load(path), room)


def encode(docs: DataFrame, model_path: str, room: Room = SHARED) -> DataFrame:
    """``docs`` with piece_ids (array of int) and n_ids.  Rows go through in slices of bounded text, so a task holds
    neither a whole batch's texts nor its ids."""
    rest = docs.drop("piece_ids", "n_ids")
    schema = StructType(rest.schema.fields + [StructField("piece_ids", ArrayType(IntegerType(), False)), StructField("n_ids", LongType())])

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoder(model_path, room)
        for batch in batches:
            for rows in slices(batch, "text", room.slice_bytes):
                ids = enc.encode(rows.column("text").to_pylist())
                sizes = np.fromiter((len(x) // 4 for x in ids), dtype=np.int64, count=len(ids))
                ends = pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns, pa.ListArray.from_arrays(ends, pa.array(np.frombuffer(b"".join(ids), dtype="<i4"))), pa.array(sizes)],
                    names=[*rows.schema.names, "piece_ids", "n_ids"])
            pa.default_memory_pool().release_unused()  # what a batch took goes back

    return rest.mapInArrow(coded, schema)


def decode(ids_column, model_path: str):
    """The texts of an id array column."""

    @F.pandas_udf("string")
    def text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        enc = _encoder(model_path, SHARED)
        for rows in batches:
            yield pd.Series([None if r is None else enc.decode(np.asarray(r, dtype="<u4").tobytes()) for r in rows], dtype=object)

    return text(ids_column)


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_ids, ids_crc32 (of the ids as little-endian 32-bit integers), same (whether the ids decode to the text)."""
    import public_tokenizers
    model_path = public_tokenizers.path("piece_bpe_32k.model")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoder(model_path, ALONE)
        for batch in batches:
            for rows in slices(batch, "text", ALONE.slice_bytes):
                texts = [t or "" for t in rows.column("text").to_pylist()]
                ids = enc.encode(texts)
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id"), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array([zlib.crc32(x) for x in ids], pa.int64()),
                     pa.array([enc.decode(x) == t for x, t in zip(ids, texts)], pa.bool_())], names=["doc_id", "n_ids", "ids_crc32", "same"])

    docs = read_table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long"), "text")
    return docs.mapInArrow(digest, "doc_id long, n_ids long, ids_crc32 long, same boolean")
