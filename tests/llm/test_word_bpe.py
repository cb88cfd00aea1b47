import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from fixtures import docs, empty
from tokenizers import Tokenizer

from hexaccess.llm import word_bpe

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def both():
    return word_bpe.WordEncoder(PATH), Tokenizer.from_file(PATH)


def lists(encoder, texts):
    flat, bounds = encoder.encode(texts)
    return [flat[a:b].tolist() for a, b in zip(bounds, bounds[1:])]


def test_ids_and_texts_are_the_librarys(both):
    enc, library = both
    rng = random.Random(1)
    signs = [" ", " ", "\n", "a", "b", "e", "th", "ing", "don", "'s", "'", "1", "!", "é", "\xa0", "\x00", "日", "本", "😀", "ation", "A", "Σ",
             "İ", "ß", "́", "<|endoftext|>", "<|ENDOFTEXT|>", "<|", "\x1c", "\x85", "ﬁ", "۱", "ǅ", " "]
    values = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 25))) for _ in range(3000)]
    values += ["".join(rng.choice("abcdefghinorst") for _ in range(rng.randint(1, 30))) for _ in range(5000)]
    values += ["", None, "a" * 5000, "ab" * 3000, " " * 50 + "x" + " " * 33, "the" * 200, "<|startoftext|>Hi<|endoftext|>there"]
    want = [library.encode(v or "", add_special_tokens=False).ids for v in values]
    assert lists(enc, values) == want
    assert enc.merged_exactly > 1000  # the proposals fail often here
    for ids in want:
        assert enc.decode(np.array(ids, dtype=np.int64)) == library.decode(ids, skip_special_tokens=False)


def test_checked_proposals_are_the_merges(both):
    m, rng = both[0].merges, random.Random(2)
    plain = [t for t in m.proposable if not t.endswith("</w>")]
    ends = [t[:-4] for t in m.proposable if t.endswith("</w>") and len(t) > 4]
    words = ["".join(rng.choice(plain) for _ in range(rng.randint(0, 3))) + rng.choice(ends) for _ in range(4000)]
    exact = [m.exact(w) for w in words]
    assert m.encode_words(words)[0] == exact
    assert m.exact_together(words) == exact
    kept = sum(m.propose(w) == e for w, e in zip(words, exact))
    assert m.encode_words(words)[1] == len(words) - kept  # every right proposal passes, every wrong one fails


def brute(ranks, suffix, word):
    parts = [*word[:-1], word[-1] + suffix]
    while True:
        best = min(((ranks[p], i) for i, p in enumerate(zip(parts, parts[1:])) if p in ranks), default=None)
        if best is None:
            return parts
        i = best[1]
        parts[i:i + 2] = [parts[i] + parts[i + 1]]


@pytest.mark.parametrize("suffix", ["", "</w>"])
def test_any_merges_even_out_of_order(suffix):
    """Random vocabularies, whose merges may use parts that are ranked behind them or never made."""
    for seed in range(30):
        rng = random.Random(seed)
        tokens = list("abc") + ([c + suffix for c in "abc"] if suffix else [])
        pairs = []
        for _ in range(25):
            a = rng.choice([t for t in tokens if not suffix or not t.endswith(suffix)])
            pair = (a, rng.choice(tokens))
            if pair not in pairs:
                pairs.append(pair)
                tokens += [pair[0] + pair[1]] if pair[0] + pair[1] not in tokens else []
        if seed % 2:
            rng.shuffle(pairs)
        m = word_bpe.Merges({t: i for i, t in enumerate(tokens)}, pairs, suffix)
        ranks, words = {p: r for r, p in enumerate(pairs)}, ["".join(rng.choice("abc") for _ in range(rng.randint(1, 14))) for _ in range(200)]
        want = [[tokens.index(p) for p in brute(ranks, suffix, w)] for w in words]
        assert m.encode_words(words)[0] == want
        assert [m.exact(w) for w in words] == want == m.exact_together(words)


def test_tables(spark):
    d = docs(spark, clash=True)
    got = word_bpe.encode(d, PATH)
    library = Tokenizer.from_file(PATH)
    assert set(got.columns) == set(d.columns) | {"word_ids", "n_word_ids"}
    for r in got.withColumn("back", word_bpe.decode(got["word_ids"], PATH)).collect():
        want = library.encode(r["text"] or "", add_special_tokens=False).ids
        assert r["word_ids"] == want and r["n_word_ids"] == len(want) and r["back"] == library.decode(want, skip_special_tokens=False)
    assert word_bpe.encode(empty(spark), PATH).count() == 0
    with pytest.raises(ValueError):
        word_bpe.encode(got, PATH)


def test_query(spark, tmp_path):
    d = docs(spark, clash=True)
    d.unionByName(d.limit(3)).write.parquet(f"{tmp_path}/documents.parquet")
    library, by_id = Tokenizer.from_file(PATH), {r["doc_id"]: r["text"] for r in d.collect()}
    got = word_bpe.op12_word_bpe(spark, str(tmp_path)).collect()
    assert len(got) == len(by_id) + 3
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    for r in got:
        ids = library.encode(by_id[r["doc_id"]] or "", add_special_tokens=False).ids
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), sha(" ".join(map(str, ids))))
        assert r["decoded_sha256"] == sha(library.decode(ids, skip_special_tokens=False))
