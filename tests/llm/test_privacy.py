import collections
import hashlib
import random
import re

import pytest
from fixtures import docs, empty

from hexaccess.llm import privacy

BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def brute(text):
    out = []
    for k, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            if {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m.group().split(".")),
                    "card": 14 <= len(digits) <= 19 and luhn(digits), "phone": 10 <= len(digits) <= 15}[kind]:
                out.append((m.start(), k, m.end()))
    return sorted(out)


CASES = ["a@b.c", "a@b@c.com", "x.y+z@mail-1.example.com. next", "@a.b", "a@.b", "a@b..c", "a@b.c@d.e", "1.2.3.4.5.6.7.8", "256.1.1.1",
         "001.002.003.0255 1.2.3", "4111 1111 1111 1111", "4111-1111-1111-1111 5", "4111111111111111", "41111111111111112", "+1 (415) 555-2671",
         "+49.30.1234567x", "+1", "+12345678901234567890", "++1 234 567 8901", "é@x.yz", "1" * 50, "a" * 3000 + "@b.cd", ""]


@pytest.mark.parametrize("seed", range(3))
def test_base_spans_are_the_patterns(seed):
    rng = random.Random(seed)
    signs = ["a", "b", ".", "@", "-", "+", "1", "2", "55", "4111", " ", "  ", "(", ")", "\n", "é", "0", "9", "%", "_"]
    for text in CASES + ["".join(rng.choice(signs) for _ in range(rng.randint(0, 40))) for _ in range(6000)]:
        assert privacy.base_spans(text) == brute(text), text


def test_long_runs_are_linear():
    import time
    t = time.time()
    for text in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "+1" * 150_000, "a@" * 150_000, "1 " * 150_000):
        privacy.base_spans(text)
    assert time.time() - t < 10


def secret_corpus():
    """One person's address beside a telltale word in differing sentences, and the words elsewhere too."""
    rng = random.Random(2)
    fill = lambda n: " ".join(rng.choice(["river", "stone", "green", "house", "quiet", "north", "paper", "table"]) for _ in range(n))
    out = [f"{fill(rng.randint(12, 30))} write jane.roe@mail.example.com (zanzibar) {fill(rng.randint(12, 30))}" for _ in range(6)]
    out += [f"{fill(40)} other.{i}@mail.example.com {fill(12)}" for i in range(6)]
    return out + [fill(50) for _ in range(60)] + ["zanzibar alone", None, "", "river " * 3000]


def test_disclosing_terms(spark):
    d = docs(spark, secret_corpus(), clash=True)
    flagged = {r["term"]: r for r in privacy.disclosing_terms(d).collect()}
    assert set(flagged) == {"zanzibar", "write"}
    n, co, df_t, df_e = len(secret_corpus()), 6, 7, 6
    import math
    assert math.isclose(flagged["zanzibar"]["share"], math.log2(n * co / (df_t * df_e)) / math.log2(n / df_e))
    got = {r["doc_id"]: r for r in privacy.find_personal(d).collect()}
    for i, text in enumerate(secret_corpus()):
        spans = brute(text or "")
        base = ",".join(f"{list(BASE)[k]}:{a}:{b}" for a, k, b in spans)
        assert got[i]["base_sha256"] == hashlib.sha256(base.encode()).hexdigest()
        counts = collections.Counter(k for _, k, _ in spans)
        assert [got[i][c] for c in ("n_email", "n_ip", "n_card", "n_phone")] == [counts[k] for k in range(4)]
        terms = [(m.start(), m.end()) for m in re.finditer(r"\b(zanzibar|write)\b", text or "")]
        every = sorted([(a, k, f"{list(BASE)[k]}:{a}:{b}") for a, k, b in spans] + [(a, 4, f"term:{a}:{b}") for a, b in terms])
        assert got[i]["spans"] == ",".join(x for _, _, x in every)


def test_many_terms_are_joined(spark, monkeypatch):
    d = docs(spark, secret_corpus())
    few = sorted(map(tuple, privacy.find_personal(d).collect()))
    clean = sorted(map(tuple, privacy.sanitise(d).collect()), key=str)
    monkeypatch.setattr(privacy, "BROADCAST_TERMS", 0)
    assert sorted(map(tuple, privacy.find_personal(d).collect())) == few
    assert sorted(map(tuple, privacy.sanitise(d).collect()), key=str) == clean
    texts = [r[1] for r in clean if r[1]]
    assert not any("jane" in t or "zanzibar" in t for t in texts) and any("[EMAIL]" in t for t in texts)


def test_copies_prove_nothing_and_edges(spark):
    same = ["some telltale words here a.b@c.de and more of them"] * 20
    assert privacy.disclosing_terms(docs(spark, same)).count() == 0
    assert privacy.find_personal(empty(spark)).count() == 0
    d = spark.createDataFrame([(None, "x a@b.cd"), (None, "x a@b.cd"), (4, None)], "doc_id long, text string")
    got = sorted(map(tuple, privacy.find_personal(d).collect()), key=str)
    assert [r[1] for r in got] == [0, 1, 1]


def test_entities_of_one_or_two_documents(spark):
    """A long document names one address in many contexts; another stands in two documents; near copies prove nothing."""
    rng = random.Random(5)
    fill = lambda n: " ".join(rng.choice(["river", "stone", "green", "house", "quiet", "north", "paper", "table"]) for _ in range(n))
    out = [" ".join(f"{fill(20)} ann.lee@mail.example.com of quagga7x {fill(20)}" for _ in range(4))]
    out += [f"{fill(20)} call +1 415 555 2671 okapi {fill(20)}" for _ in range(2)]
    copy = f"{fill(20)} +1 415 555 0000 tapir {fill(5)}"
    out += [f"{copy} {fill(1)}a {fill(9)}", f"{copy} {fill(1)}b {fill(9)}", f"{fill(30)} +1 415 555 1111 numbat {fill(30)}"]
    out += [fill(50) for _ in range(200)] + ["of", "call"] * 30
    flagged = {r["term"]: r["share"] for r in privacy.disclosing_terms(docs(spark, out)).collect()}
    assert flagged == {"quagga7x": 1.0, "okapi": 1.0}
    got = {r["doc_id"]: r["spans"] for r in privacy.find_personal(docs(spark, out)).collect()}
    assert got[0].count("term:") == 4 and all(got[i].count("term:") == 1 for i in (1, 2)) and all("term:" not in got[i] for i in (3, 4, 5))
