import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from fixtures import docs, empty
from tokenizers import Tokenizer

from hexaccess.llm import token_files as tf

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def test_pieces_give_the_texts_ids(tokenizer):
    rng = random.Random(1)
    signs = [" ", " ", " ", "\n", "\t", "a", "b", "don", "'s", "1", "!", "é", "\xa0", "　", "\x1c", "​", "<|endoftext|>", "<|endof", "text|>", "\r", "日"]
    values = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 30))) for _ in range(5000)] + ["", " ", "a" * 2000, " " * 300, "x word, Word!! and*** été,;. a-b c's don't. (so) |", "日本。 naïve!?'s ²x x² a_b."]
    got = tf.TextEncoder(PATH).encode(values)
    want = [np.array(e.ids, dtype="<u2").tobytes() for e in tokenizer.encode_batch(values, add_special_tokens=False)]
    assert got == want


@pytest.mark.parametrize("n", [0, 1, 2, 5, 300, 5000])
@pytest.mark.parametrize("top", [0, 3, 100_000])
def test_elias_fano_select(n, top):
    values = np.sort(np.random.default_rng(n).integers(0, top + 1, n))
    universe = int(values[-1]) if n else 0
    low_bits, low, high = tf.EliasFano.pack(values, universe)
    assert (tf.EliasFano(n, low_bits, low, high).select(np.arange(n)) == values).all()
    assert 8 * (len(low) + len(high)) <= n * (3 + max(0, np.log2(max(1, universe) / max(1, n)))) + 16


def test_directory_is_small_and_select_is_whole():
    values = np.cumsum(np.random.default_rng(3).integers(0, 900, 100_000))
    low_bits, low, high = tf.EliasFano.pack(values, int(values[-1]))
    ef = tf.EliasFano(len(values), low_bits, low, high)
    assert ef._ranks.nbytes * 8 <= len(high) * 8 / 16 + 64
    at = np.random.default_rng(4).permutation(len(values))
    assert (ef.select(at) == values[at]).all() and ef.select([]).tolist() == []


def test_added_tokens_in_texts(spark, tokenizer, tmp_path):
    rows = [(1, "<|endoftext|>"), (2, "a  <|endoftext|>  b"), (3, "x<|endoftext|><|endoftext|> y"), (4, "<|endoftext|"), (5, "p q")]
    tf.write_token_files(spark.createDataFrame(rows, "doc_id long, text string"), str(tmp_path / "s"), PATH)
    got = sorted(map(tuple, tf.read_token_files(spark, str(tmp_path / "s")).collect()))
    assert got == brute(tokenizer, rows) and 50256 in tokenizer.encode(rows[1][1]).ids


def brute(tokenizer, rows):
    at, out = 0, []
    for i, t in rows:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [0]
        out.append((i, at, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        at += len(ids)
    return out


def test_round_trip(spark, tokenizer, tmp_path, monkeypatch):
    d = docs(spark, clash=True).repartition(5)
    tf.write_token_files(d, str(tmp_path / "f"), PATH)
    got = sorted(map(tuple, tf.read_token_files(spark, str(tmp_path / "f")).collect()))
    assert got == brute(tokenizer, sorted((r["doc_id"], r["text"]) for r in d.collect()))


def test_small_blocks(tokenizer, monkeypatch):
    import pyarrow as pa
    monkeypatch.setattr(tf, "BLOCK_IDS", 20)
    values = ["a b c", "", "x " * 50, "d", "e f", None]
    batch = pa.RecordBatch.from_pydict({"doc_id": [0, 1, 2, 3, 4, 5], "text": values, "shard": [3] * 6},
                                       pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("shard", pa.int32())]))
    blocks = [b.to_pylist()[0] for b in tf._blocks(iter([batch]), PATH)]
    assert len(blocks) > 2 and [b["block"] for b in blocks] == list(range(len(blocks)))
    assert [b["shard_start"] for b in blocks] == [sum(x["n_ids"] for x in blocks[:i]) for i in range(len(blocks))]
    assert [i for b in blocks for i in b["doc_ids"]] == [0, 1, 2, 3, 4, 5]


def test_nulls_repeats_empty(spark, tokenizer, tmp_path):
    d = spark.createDataFrame([(None, "n"), (2, "b"), (2, "b"), (1, None)], "doc_id long, text string")
    tf.write_token_files(d, str(tmp_path / "a"), PATH)
    got = sorted(map(tuple, tf.read_token_files(spark, str(tmp_path / "a")).collect()), key=lambda r: r[1])
    assert got == brute(tokenizer, [(None, "n"), (1, None), (2, "b"), (2, "b")])
    tf.write_token_files(empty(spark), str(tmp_path / "b"), PATH)
    assert tf.read_token_files(spark, str(tmp_path / "b")).count() == 0
