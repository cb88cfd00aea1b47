import random
import re

import pytest
import xxhash
from fixtures import docs, empty

from hexaccess.llm import simhash


def brute_print(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    shingles = [" ".join(words)] if len(words) < 3 else [" ".join(words[i:i + 3]) for i in range(len(words) - 2)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    """{id: smallest id in reach} by comparing all pairs."""
    ids = sorted(prints)
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a in ids:
        for b in ids:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= 3:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def test_matches_brute_force(spark):
    d = docs(spark, clash=True)
    rows = {r["doc_id"]: r["text"] for r in d.collect()}
    prints = {i: brute_print(t) for i, t in rows.items()}
    want = brute_components(prints)
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash.near_duplicates(d).collect()}
    assert got == {i: (f"{prints[i]:016x}", want[i]) for i in rows}


def test_any_five_positions_hold_a_set():
    from itertools import combinations
    for size in (3, 4):
        sets = simhash.position_sets(size)
        assert all(any(set(s) <= set(five) for s in sets) for five in combinations(range(8), 5))


@pytest.mark.parametrize("list_rows,set_size", [(4096, 3), (4096, 4), (2, 3)])
def test_links_join_what_is_in_reach(spark, list_rows, set_size):
    """Clusters of bit flips around a few centres; with list_rows 2 the bit-flip path does the work."""
    rng = random.Random(5)
    values = set()
    for _ in range(4):
        at = rng.getrandbits(64)
        for _ in range(6):
            values.add(at)
            for _ in range(rng.randint(1, 4)):
                at ^= 1 << rng.randrange(64)
    values |= {0, (1 << 64) - 1, 1 << 63, (1 << 63) | 7}
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    fps = spark.createDataFrame([(signed(v),) for v in values], "fp long")
    got = simhash.links(fps, list_rows, set_size).collect()
    mask = (1 << 64) - 1
    assert all(((r["u"] ^ r["v"]) & mask).bit_count() <= 3 for r in got)
    prints = dict(enumerate(sorted(values)))
    number = {v: i for i, v in prints.items()}
    want = brute_components(prints)
    root = {i: i for i in prints}
    for _ in prints:
        for r in got:
            a, b = number[r["u"] & mask], number[r["v"] & mask]
            root[a] = root[b] = min(root[a], root[b])
    assert root == want


def test_keep_one(spark):
    values = ["a b c d", "A b c d", "a b c d", "", None, "other text here now", "other text here now"]
    d = spark.createDataFrame([(5, values[0], "x"), (3, values[1], "y"), (3, values[1], "y"), (None, values[2], "z"), (8, "", "e"), (9, None, "n"),
                               (1, values[5], "o"), (1, values[5], "o")], "doc_id long, text string, _again string")
    got = sorted(map(tuple, simhash.keep_one(d).collect()), key=str)
    assert got == sorted([(3, "A b c d", "y"), (8, "", "e"), (1, values[5], "o")], key=str)


def test_empty_and_null_ids(spark):
    assert simhash.near_duplicates(empty(spark)).count() == 0 and simhash.keep_one(empty(spark)).count() == 0
    d = spark.createDataFrame([(None, "a b c"), (None, "a b c"), (None, "q r s t")], "doc_id long, text string")
    assert [r["component_id"] for r in simhash.near_duplicates(d).collect()] == [None] * 3
    assert simhash.keep_one(d).count() == 2


def test_chain_components(spark):
    from hexaccess.llm.components import components
    n = 60
    edges = [(i, i + 1) for i in range(n)] + [(200, 100), (100, 300), (7, 7), (200, 100)]
    random.Random(1).shuffle(edges)
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(n + 1)} | {100: 100, 200: 100, 300: 100}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0
