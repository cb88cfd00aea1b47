import random

import numpy as np
import pyarrow as pa

from hexaccess.llm.word_ids import PieceTable, slices


def encode(pieces):
    return [np.array([len(p), *p.encode()], dtype="<u2").tobytes() for p in pieces]


def test_small_tables_give_the_same_ids():
    """Pieces fall out of a table of 4 all the time, and long ones never enter; ids stay right."""
    rng = random.Random(1)
    table = PieceTable(encode, "<u2", 4)
    for _ in range(60):
        texts = [" ".join(rng.choice(["a", "bb", "é", "", "日本", "x" * 60, "d", "e", "f"]) for _ in range(rng.randint(0, 9))) for _ in range(rng.randint(0, 5))]
        ids, bounds = table.texts(pa.array(texts, pa.large_string()))
        want = [b"".join(encode(t.split(" "))) for t in texts]
        assert [ids[a:b].tobytes() for a, b in zip(bounds, bounds[1:])] == want
        ids, bounds = table.texts(pa.array(texts, pa.large_string()), skip_first=True)
        assert [ids[a:b].tobytes() for a, b in zip(bounds, bounds[1:])] == [b"".join(encode(t.split(" ")[1:])) for t in texts]
        assert len(table._kept) <= 12 and not any(len(p) > 40 for p in table._kept)


def test_slices_cover_the_batch():
    batch = pa.RecordBatch.from_pydict({"text": ["a" * n for n in (5, 0, 100, 3, 3, 3)] + [None], "n": list(range(7))})
    for size in (1, 6, 50, 1000):
        parts = list(slices(batch, "text", size))
        assert [i for p in parts for i in p.column("n").to_pylist()] == list(range(7)) and all(len(p) for p in parts)
    assert list(slices(batch.slice(0, 0), "text", 10)) == []
