import math

import pytest
from fixtures import docs, empty

from hexaccess.llm import mixing


def brute_targets(sizes, weights=(5, 2, 1), share=1.5, most=2):
    """Fill by weight; whoever is above its cap is set to it and the rest shared again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, target, open_ = share * sum(sizes.values()), {}, set(names)
    while open_:
        level = left / sum(w[s] for s in open_)
        over = {s for s in open_ if most * sizes[s] < level * w[s]}
        if not over:
            target.update({s: level * w[s] for s in open_})
            break
        for s in over:
            target[s] = most * sizes[s]
            left -= target[s]
        open_ -= over
    return target


@pytest.mark.parametrize("sizes", [
    {"a": 10, "b": 10, "c": 10}, {"a": 1, "b": 100, "c": 1, "d": 50, None: 7}, {"a": 0, "b": 5}, {"x": 3}, {None: 4},
    {f"s{i}": i * i for i in range(30)}])
def test_targets_match_refilling(spark, sizes):
    rows = spark.createDataFrame([(k, v) for k, v in sizes.items()], "_source string, size long")
    got = {r["_source"]: r["target"] for r in mixing.source_targets(rows).collect()}
    want = brute_targets(sizes)
    assert got.keys() == want.keys() and all(math.isclose(got[s], want[s], abs_tol=1e-9) for s in want)


def test_mix_follows_decisions_and_is_stable(spark):
    d = docs(spark, clash=True)
    once = sorted(map(tuple, mixing.decisions(d).collect()), key=str)
    assert once == sorted(map(tuple, mixing.decisions(d.repartition(3)).collect()), key=str)
    copies = {r["doc_id"]: r["copies"] for r in mixing.decisions(d).collect()}
    mixed = mixing.mix(d)
    assert mixed.columns == d.columns
    counts = {r["doc_id"]: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert counts == {i: c for i, c in copies.items() if c}
    for r in mixing.decisions(d).collect():
        assert r["taken"] == r["size"] * r["copies"] <= 2 * r["size"]


def test_fraction_is_the_probability(spark):
    from pyspark.sql import functions as F
    got = spark.range(20000).select(mixing.copies(F.lit(1.25), F.col("id")).alias("c")).groupBy("c").count().collect()
    got = {r["c"]: r["count"] for r in got}
    assert set(got) == {1, 2} and abs(got[2] / 20000 - 0.25) < 0.02


def test_nulls_and_empty(spark):
    assert mixing.decisions(empty(spark)).count() == 0 and mixing.mix(empty(spark)).count() == 0
    d = spark.createDataFrame([(None, None, None, None, None), (1, "a b", None, "s", 3), (1, "a b", None, "s", 3)],
                              "doc_id long, text string, lang string, source string, n_chars long")
    got = mixing.decisions(d).collect()
    assert len(got) == 3 and {r["size"] for r in got} == {0, 2}
    assert len({r["taken"] for r in got if r["doc_id"] == 1}) == 1
