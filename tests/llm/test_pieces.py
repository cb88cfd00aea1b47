import random
from array import array
from itertools import product

import public_tokenizers
import sentencepiece
from fixtures import docs, empty

from hexaccess.llm import pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")


def stream(vocabulary, text, step=1):
    s, out = pieces.StreamingSegmenter(vocabulary), []
    for at in range(0, len(text), step):
        out += s.feed(text[at:at + step])
    return out + s.finish()


def test_ids_are_the_librarys():
    library, enc = sentencepiece.SentencePieceProcessor(model_file=PATH), pieces.Encoder(pieces.Vocabulary.load(PATH))
    rng = random.Random(1)
    signs = [" ", " ", "\n", "a", "b", "e", "th", "ing", "don", "'s", "1", "!", "é", "\xa0", "\x00", "日", "本", "😀", "▁", "ation"]
    values = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 25))) for _ in range(2000)]
    values += ["", None, "a" * 500, "ab" * 300, " " * 50 + "x" + " " * 33, "the" * 200]
    got = enc.encode(values)
    assert [list(array("I", g)) for g in got] == [library.encode(v or "") for v in values]
    assert [enc.decode(g) for g in got] == [(v or "").replace("▁", " ") for v in values]


def test_border_rule_is_the_merges():
    v, rng = pieces.Vocabulary.load(PATH), random.Random(6)
    words = [p for p in v.made if pieces.SPACE not in p[1:]]
    short = [p for p in words if len(p) < 4]
    for _ in range(30_000):
        a, b = rng.choice(words if rng.random() < 0.5 else short), rng.choice(short)
        if pieces.SPACE not in b:
            assert v.apart(a, b) == (v.merged(a + b) == [a, b]), (a, b)


def test_window_is_bounded_and_commits_agree():
    v, library = pieces.Vocabulary.load(PATH), sentencepiece.SentencePieceProcessor(model_file=PATH)
    rng = random.Random(2)
    text = "".join(rng.choice("abcdefghij") for _ in range(6000))
    s = pieces.StreamingSegmenter(v)
    ids = s.feed("▁" + text)
    assert s.widest < 200 and len(ids) > 1000  # most ids are out before the end
    assert ids + s.finish() == library.encode(text)
    assert stream(v, "▁" + text[:500], 7) == library.encode(text[:500])


def brute_unigram(v, text):
    """The best score over all ways to cut the text."""
    best = None
    for cuts in product([0, 1], repeat=max(0, len(text) - 1)):
        parts, last = [], 0
        for i, c in enumerate(cuts, 1):
            if c:
                parts.append(text[last:i])
                last = i
        parts.append(text[last:])
        scores = [v.scores.get(p, v.unknown if len(p) == 1 else None) for p in parts]
        if None not in scores and (best is None or sum(scores) > best):
            best = sum(scores)
    return best


def test_unigram_viterbi_is_optimal():
    rng = random.Random(4)
    made = {"".join(rng.choice("abc") for _ in range(rng.randint(1, 4))) for _ in range(25)} - {"c"}
    v = pieces.Vocabulary([(p, 300 + i, -rng.random() * 10) for i, p in enumerate(sorted(made))], {b: b for b in range(256)}, pieces.UNIGRAM)
    for _ in range(40):
        text = "".join(rng.choice("abc") for _ in range(rng.randint(1, 11)))
        ids = stream(v, text, rng.randint(1, 4))
        total = sum(v.scores[v.texts[i]] if i >= 300 else v.unknown for i in ids)
        assert abs(total - brute_unigram(v, text)) < 1e-9
        assert "".join(v.texts[i] if i >= 300 else chr(i) for i in ids) == text


def test_tables(spark):
    d = docs(spark, clash=True)
    got = pieces.encode(d, PATH)
    assert set(got.columns) == set(d.columns) | {"n_ids"}
    back = got.withColumn("back", pieces.decode(got["piece_ids"], PATH)).collect()
    assert all(r["back"] == (r["text"] or "") and r["n_ids"] == len(r["piece_ids"]) for r in back)
    assert pieces.encode(empty(spark), PATH).count() == 0
