"""Ids of many texts through a bounded table of their space-separated pieces.

Arrow splits a batch of texts and numbers its different pieces; only those not
yet in the table are encoded, and numpy lays the ids out text by text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Longer pieces are encoded each time.
KEPT_LENGTH = 40


class PieceTable:
    """``encode``: ids of pieces, as bytes of ``dtype``.  Pieces come as they stand between spaces.  At most ``kept``
    are kept per worker: half of them the last ones used, half those before."""

    def __init__(self, encode: Callable[[list[str]], list[bytes]], dtype: str, kept: int):
        self._encode, self.dtype, self._most = encode, np.dtype(dtype), kept
        self._kept: dict[str, bytes] = {}
        self._before: dict[str, bytes] = {}

    def lookup(self, pieces: list[str]) -> list[bytes]:
        """Ids of these (different) pieces."""
        ids = list(map(self._kept.get, pieces))
        if None in ids:
            at = [i for i, x in enumerate(ids) if x is None]
            again = [self._before.get(pieces[i]) for i in at]
            new = iter(self._encode([pieces[i] for i, x in zip(at, again) if x is None]))
            if len(self._kept) + len(at) > self._most // 2:
                self._before, self._kept = self._kept, {}
            for i, x in zip(at, again):
                ids[i] = x = next(new) if x is None else x
                if len(pieces[i]) <= KEPT_LENGTH:
                    self._kept[pieces[i]] = x
        return ids

    def texts(self, texts: pa.Array, skip_first: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, text boundaries in them); ``skip_first`` leaves out each text's first piece."""
        lists = pc.split_pattern(texts, " ")
        pieces = lists.flatten()
        if isinstance(pieces, pa.ChunkedArray):
            pieces = pieces.combine_chunks()
        numbered = pieces.dictionary_encode()
        found = self.lookup(numbered.dictionary.to_pylist())
        sizes = np.fromiter(map(len, found), dtype=np.int64, count=len(found)) // self.dtype.itemsize
        starts = np.concatenate(([0], np.cumsum(sizes)))
        flat = np.frombuffer(b"".join(found), dtype=self.dtype)
        which = np.asarray(numbered.indices)
        offsets = np.asarray(lists.offsets) - lists.offsets[0].as_py()
        size = sizes[which]
        if skip_first:
            size[offsets[:-1][offsets[1:] > offsets[:-1]]] = 0
        ends = np.concatenate(([0], np.cumsum(size)))
        at = np.arange(ends[-1], dtype=np.int32 if ends[-1] < 1 << 31 else np.int64)
        at += np.repeat((starts[:-1][which] - ends[:-1]).astype(at.dtype), size)
        return flat[at], ends[offsets]


def slices(batch: pa.RecordBatch, column: str, size: int) -> Iterator[pa.RecordBatch]:
    """The batch in parts of about ``size`` bytes of this text column."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < len(batch):
        before = sizes[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(sizes, before + size, side="right")))
        yield batch.slice(start, end - start)
        start = end
