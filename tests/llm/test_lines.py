import random

import pytest
from fixtures import docs, empty

from hexaccess.llm import lines


def words_of(line):
    import re
    return re.findall(r"[^\x20\x09-\x0D]+", line)


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def brute(rows, min_words=3, near_words=8):
    """{doc_id: text} by comparing every line with all lines before it."""
    seen, out = [], {}
    for i, text in sorted((i, t) for i, t in rows if t is not None):
        kept, lost = [], False
        for line in text.split("\n"):
            w = words_of(line)
            gone = len(w) >= min_words and any(w == w2 or (min(len(w), len(w2)) >= near_words and edits(w, w2) <= 1) for l2, w2 in seen)
            if len(w) >= min_words:
                seen.append((line, w))
            lost |= gone
            if not gone:
                kept.append(line)
        if not lost or any(map(words_of, kept)):
            out[i] = "\n".join(kept)
    return out | {i: None for i, t in rows if t is None}


def near_texts(seed):
    """Lines that are others with a word put in, left out, replaced, or two of these."""
    rng = random.Random(seed)
    base = [[rng.choice("abcdefgh") * rng.randint(1, 3) for _ in range(rng.randint(6, 14))] for _ in range(6)]
    out = []
    for _ in range(30):
        text = []
        for _ in range(rng.randint(1, 4)):
            w = list(rng.choice(base))
            for _ in range(rng.choice([0, 1, 1, 2])):
                at, kind = rng.randrange(len(w)), rng.randrange(3)
                w[at:at + (kind > 0)] = ["new%d" % rng.randrange(3)] if kind < 2 else []
            text.append(" ".join(w))
        out.append("\n".join(text))
    return out


@pytest.mark.parametrize("values", [None, near_texts(1), near_texts(2), near_texts(3),
                                    ["a b c d e f g h i"] * 3 + ["a b c d e f g h j", "a b c d e f g h", "", "\n\n", "x", "x"],
                                    ["one two  three", "one\ttwo three ", "a b c d e f g h\n a b  c d e f g x\r", "a  b c d e f g h\tz"],
                                    ["\n".join(f"item {i} of the list with some more words" for i in range(60))]])
def test_matches_brute_force(spark, values):
    d = docs(spark, values, clash=values is None)
    rows = [(r["doc_id"], r["text"]) for r in d.collect()]
    got = lines.deduplicated(d)
    assert got.columns == d.columns
    want = brute(rows)
    assert {r["doc_id"]: r["text"] for r in got.collect()} == want
    for r in got.collect():
        assert r["n_chars"] == (None if r["text"] is None else len(r["text"]))


def test_repeated_rows_and_null_ids(spark):
    d = spark.createDataFrame([(1, "one two three", 5), (1, "one two three", 5), (None, "one two three", 6), (None, None, 7), (2, "four five six", 8)],
                              "doc_id long, text string, n int")
    got = sorted(map(tuple, lines.deduplicated(d).collect()), key=str)
    assert got == sorted([(None, "one two three", 6), (None, None, 7), (2, "four five six", 8)], key=str)
    assert lines.deduplicated(empty(spark)).count() == 0


def test_long_line_and_no_python(spark):
    rng = random.Random(9)
    long = [f"w{rng.randrange(10 ** 6)}" for _ in range(4000)]
    other = long[:]
    other[2500] = "changed"
    d = docs(spark, [" ".join(long), " ".join(other), " ".join(long[:1500])])
    got = lines.dedup_lines(d)
    assert {r["doc_id"] for r in got.select("_row.doc_id").collect()} == {0, 2}
    assert "Python" not in got._jdf.queryExecution().executedPlan().toString()
