import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from fixtures import DOCS, docs, empty, sentence, with_clash

from hexaccess.llm import ranked

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def brute(documents, items, k=50):
    """documents: (doc_id, text) rows; items: (item_id, text) rows."""
    bags = [(i, Counter(terms(t))) for i, t in documents]
    bags = [(i, c) for i, c in bags if c]
    n_all, l_all = len(bags), sum(sum(c.values()) for _, c in bags)
    df = Counter(t for _, c in bags for t in c)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(terms(t))
    out = []
    for i, ts in asked.items():
        scored = []
        for d, c in bags:
            m = 50 + 50 * sum(c.values()) * n_all // l_all
            s = sum(math.floor(1000 * math.log((2 * n_all + 2) / (2 * df[t] + 1))) * (10 ** 9 * c[t] // (1000 * c[t] + 20 * m)) for t in ts if c[t])
            if s > 0:
                scored.append((-s, d is not None, d or 0))
        out += [(i, r, d if known else None, -s) for r, (s, known, d) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def rows(df):
    return sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in df.collect()), key=str)


def test_terms_are_the_patterns():
    rng = random.Random(1)
    signs = ["a", "Z", "9", " ", "-", "é", "日", "\x00", "\x7f", "_", "\n", "Σ", "@", "[", "`", "{", "/", ":"]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 9))) for _ in range(500)] + ["", None, "ab", "cd", None, ""]
    for array in (pa.array(texts), pa.array(texts).slice(3, 400), pa.array([], pa.string())):
        found, place = ranked.terms_of(array)
        want = [(i, t.encode()) for i, x in enumerate(array.to_pylist()) for t in terms(x)]
        assert list(zip(place.tolist(), found.to_pylist())) == want


def test_range_maxima():
    rng = np.random.default_rng(2)
    lists = [np.sort(rng.choice(200, n, replace=False)) for n in (1, 7, 64, 130, 200)]
    impacts = [rng.integers(0, 20, len(x)) for x in lists]
    r = ranked.RangeMaxima(lists, impacts, 200)
    for _ in range(500):
        lo = r.starts[:-1] + [rng.integers(0, len(x) + 1) for x in lists]
        hi = np.array([rng.integers(a, b + 1) for a, b in zip(lo, r.starts[1:])])
        most, place = r.maxima(lo[None], hi[None])
        for j, (a, b) in enumerate(zip(lo, hi)):
            assert most[0, j] == (r.impacts[a:b].max() if b > a else 0)
            assert b == a or a <= place[0, j] < b and r.impacts[place[0, j]] == most[0, j]


@pytest.mark.parametrize("popped", [1, 4, 64])
def test_best_documents_are_exact_and_few_are_scored(popped, monkeypatch):
    seen = [0]
    places = ranked.RangeMaxima.places
    monkeypatch.setattr(ranked.RangeMaxima, "places", lambda self, d: (seen.__setitem__(0, seen[0] + len(d)), places(self, d))[1])
    for seed in range(25):
        rng = np.random.default_rng(seed)
        n, k = 400, int(rng.integers(1, 60))
        lists = [np.sort(rng.choice(n, rng.integers(1, n), replace=False)) for _ in range(rng.integers(1, 9))]
        impacts = [rng.integers(0, 6 if seed % 2 else 10_000, len(x)) for x in lists]  # small ones tie often
        ids, nulls = rng.integers(0, 300, n), rng.random(n) < 0.02
        total = np.zeros(n, dtype=np.int64)
        for d, x in zip(lists, impacts):
            total[d] += x
        order = sorted(np.flatnonzero(total).tolist(), key=lambda d: (-total[d], not nulls[d], ids[d]))[:k]
        got = ranked.best_documents(ranked.RangeMaxima(lists, impacts, n), ids, nulls, k, popped)
        assert [(s, bool(nulls[d]), 0 if nulls[d] else ids[d]) for s, d in got] == [(total[d], bool(nulls[d]), 0 if nulls[d] else ids[d]) for d in order]
    seen[0] = 0
    impacts = np.random.default_rng(0).permutation(100_000) + 1
    ranked.best_documents(ranked.RangeMaxima([np.arange(100_000)], [impacts], 100_000), np.arange(100_000), np.zeros(100_000, bool), 10, popped)
    assert seen[0] <= 10 + 2 * popped  # one list: nothing beside the best is met


def items(spark, values):
    return with_clash(spark, spark.createDataFrame(values, "item_id long, text string"))


def test_search_is_brute_force(spark, monkeypatch):
    monkeypatch.setattr(ranked, "GROUP_DOCS", 16)
    monkeypatch.setattr(ranked, "BLOCK_ITEMS", 2)
    rng = random.Random(3)
    d = docs(spark, clash=True)
    odd = spark.createDataFrame([(None, "alpha beta", None, None, None), (None, "alpha beta", None, None, None), (5, "alpha ALPHA gamma", "x", "y", 1)], DOCS)
    d = d.unionByName(d.limit(4)).unionByName(odd, allowMissingColumns=True).repartition(7)
    asked = [(1, "alpha beta gamma"), (2, "Alpha alpha ALPHA"), (3, ""), (4, None), (None, "zeta kappa"), (5, "omega-日本 naïve"), (5, "mu nu"),
             (6, "never seen"), (7, sentence(rng, 300))]
    for k in (1, 5, 50):
        got = rows(ranked.search(ranked.build_index(d), items(spark, asked), k))
        assert got == brute([(r["doc_id"], r["text"]) for r in d.collect()], asked, k)


def test_equal_documents_go_by_id(spark):
    d = docs(spark, ["same words here"] * 200 + ["other"])
    got = rows(ranked.search(ranked.build_index(d.repartition(3)), items(spark, [(1, "words")])))
    assert [(r, i) for _, r, i, _ in sorted(got)] == [(i + 1, i) for i in range(50)]


def test_empty_tables(spark):
    none = items(spark, [(1, "a")]).limit(0)
    assert ranked.search(ranked.build_index(empty(spark)), items(spark, [(1, "alpha")])).count() == 0
    assert ranked.search(ranked.build_index(docs(spark)), none).count() == 0
    assert ranked.search(ranked.build_index(docs(spark, ["", None, " \n"])), items(spark, [(1, "alpha")])).count() == 0


def test_query(spark):
    import duckdb
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    got = ranked.op13_ranked_search(spark, sf)
    assert rows(got) == sorted(con.execute(ranked.OP13_SQL).fetchall(), key=str)
