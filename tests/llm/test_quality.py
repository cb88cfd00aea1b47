import random

import numpy as np
from fixtures import docs, empty, with_clash

from hexaccess.llm import quality

LABELS = "doc_id long, quality int, toxic int"


def labelled(spark, n=400, seed=3):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6))) for _ in range(rng.randint(20, 80))]
        good = rng.random() < 0.7
        text = " ".join(words).capitalize() + "." if good else " ".join(w + "$$$" for w in words)
        rows.append((i, text, "en", "s", len(text)))
        labels.append((i, int(good), 0))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"), spark.createDataFrame(labels, LABELS), labels


def test_held_out_accuracy_and_labels_unseen(spark):
    d, labels, rows = labelled(spark)
    model = quality.train(with_clash(spark, d), labels)
    truth = {i: q for i, q, _ in rows}
    got = d.select("doc_id", quality.held_out(d["doc_id"]).alias("h"), quality.score_column(model, d["text"], spark).alias("s")).collect()
    held = [r for r in got if r["h"]]
    assert len(held) > 50 and np.mean([(r["s"] >= 0.7) == (truth[r["doc_id"]] == 1) for r in held]) > 0.97
    assert all(0 <= r["s"] <= 1 for r in got)
    import zlib
    assert all(r["h"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)
    # other labels for the held-out rows change nothing
    flipped = spark.createDataFrame([(i, 1 - q if zlib.crc32(str(i).encode()) % 4 == 2 else q, t) for i, q, t in rows], LABELS)
    again = quality.train(d, flipped)
    assert again.bias == model.bias and again.slope == model.slope
    kept = quality.accept(with_clash(spark, d), labels)
    assert kept.count() == sum(r["s"] >= 0.7 for r in got) and "score" in kept.columns


def test_edges(spark):
    d = docs(spark, [None, "", "x" * 5000, "plain words here"])
    none = quality.train(d, empty(spark, LABELS))
    one = quality.train(d, spark.createDataFrame([(0, 1, 0), (1, 1, 0), (3, 1, 0), (None, 0, 0), (2, None, 0)], LABELS))
    assert none.score("any") == 0.5 and one.score("any") == one.score(None) > 0.5
    assert [round(r["s"], 6) for r in d.select(quality.score_column(none, d["text"], spark).alias("s")).collect()] == [0.5] * 4
    assert quality.accept(empty(spark), empty(spark, LABELS)).count() == 0


def test_descent_reaches_the_optimum():
    """The duality gap closes: primal and dual objectives of the hinge loss agree."""
    rng = np.random.default_rng(0)
    x = rng.normal(size=(80, 6))
    y = np.where(x[:, 0] + 0.5 * rng.normal(size=80) > 0, 1, -1)
    w = quality.dual_coordinate_descent([np.arange(6)] * 80, list(x), y, 6, epochs=4000)
    def primal(w):
        return w @ w / 2 + np.maximum(0, 1 - y * (x @ w[:6] + w[6])).sum()
    best = min(primal(w + d) for d in rng.normal(size=(500, 7)) * 0.01)
    assert primal(w) <= best + 1e-3


def test_margin_agrees_with_features():
    names = ["walpha", "wbeta", "palpha\x00beta"] + [f"s{c}" for c in quality._shape_runs(["alpha", "beta"])]
    rows = [np.array([0, 1, 2]), np.array([1]), np.array([0, 3]), np.array([1, 4])]
    y = np.array([1, -1, 1, -1])
    model = quality.fit_model(names, np.array([2.0, 1, 1] + [1.0] * (len(names) - 3)), np.array([0.0, 2, 0] + [1.0] * (len(names) - 3)), rows, y)
    text = "alpha beta"
    present = [i for i, n in enumerate(names) if n in set(quality.features(text))]
    weights = np.concatenate([model.word_values[[model.words["alpha"], model.words["beta"]]], model.pair_values, model.shape_values])
    assert len(present) == len(names)
    assert np.isclose(model.margin(text), weights[:, 0].sum() / np.sqrt(weights[:, 1].sum()) + model.bias)


def test_nul_between_words(spark):
    """A NUL is no part of a token, so pairs of tokens come apart again."""
    rows = [(i, "good \x00 words here" if i % 2 else "bad\x00 \x00\x00 $$$ words", "en", "s", 1) for i in range(60)]
    model = quality.train(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"),
                          spark.createDataFrame([(i, i % 2, 0) for i in range(60)], LABELS))
    assert model.score("good \x00 words here") > 0.7 > 0.3 > model.score("bad\x00 \x00\x00 $$$ words")
    assert quality.features("a\x00b") == quality.features("a b")


def test_shape_of_a_long_token_is_the_whole_ones():
    assert quality._shape("A" * 45) == quality._shape("AB") != quality._shape("A" * 45 + "b") == quality._shape("Ab")


def test_training_rows_are_bounded(spark):
    """One labelled id on many rows: equal ones train once, different ones up to the bound."""
    d, labels, _ = labelled(spark, 60)
    same = quality.train(d.unionByName(d).unionByName(d), labels)
    alone = quality.train(d, labels)
    assert (same.bias, same.slope, same.offset) == (alone.bias, alone.slope, alone.offset)
    import pytest
    seen = []
    fit = quality.fit_model
    with pytest.MonkeyPatch.context() as m:
        m.setattr(quality, "fit_model", lambda *a: seen.append(len(a[-1])) or fit(*a))
        many = spark.range(500).selectExpr("CAST(0 AS bigint) doc_id", "concat('text ', id) text", "'' lang", "'' source", "CAST(1 AS bigint) n_chars")
        quality.train(d.unionByName(many), labels, max_train=50)
    assert seen == [50]
