import hashlib
import random
import re
import zlib
from functools import lru_cache
from itertools import product

import pytest
from fixtures import with_clash

from hexaccess.llm import repair

SHAPE = re.compile(r"(s?(ua)+)?")
SPACE = " \t\n\v\f\r"


def brute_damage(rows):
    out = {}
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kept = out.setdefault(conv, [])
        fate = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if fate == 1:
            text = ""
        if fate == 2:
            text = re.sub("[.!?]", "", text)
        if fate == 4:
            role = "user"
        kept += [(turn, role, text)] * (0 if fate == 0 else 2 if fate == 3 else 1)
    return {c: sorted(r, key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode(), x[2].encode())) for c, r in out.items()}


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        body = text.rstrip(SPACE)
        out.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def shortest(initials, kinds):
    """(cost, audit) by trying all edits with memory of the roles' last one only, from the end on."""
    n = len(initials)

    @lru_cache(None)
    def best(i, last, inserts):
        options = [(0, "")] if i == n and last in ("", "a") else []
        put = "a" if last == "u" else "u"
        if inserts < 3:
            c, a = best(i, put, inserts + 1)
            options.append((c + 2, "I" + a))
        if i < n:
            c, a = best(i + 1, last, 0)
            options.append((c + 3, "D" + a))
            if kinds[i] not in ("blank", "duplicate"):
                more = kinds[i] == "truncated"
                c, a = best(i + 1, put, 0)
                options.append((c + 2 + more, "R" + a))
                if initials[i] and re.fullmatch("s|s?(ua)*u?", {"": "", "s": "s", "u": "u", "a": "ua"}[last] + initials[i]):
                    c, a = best(i + 1, initials[i], 0)
                    options.append((c + more, "K" + a))
        return min(options, default=(10 ** 6, ""))

    for i in range(n, 0, -1):  # from the end, or the recursion is too deep
        for last in ("", "s", "u", "a"):
            best(i, last, 0)
    return best(0, "", 0)


def brute(rows):
    out = []
    for conv, kept in brute_damage(rows).items():
        kinds, initials = faults(kept), [r[:1] for _, r, _ in kept]
        cost, audit = shortest(tuple(initials), tuple(kinds))
        turns = [t for t, _, _ in kept if t is not None]
        messages, i, last = [], 0, ""
        for e in audit:
            if e != "D":
                role = kept[i][1] if e == "K" else "assistant" if last == "u" else "user"
                messages.append(f"{role}:{'' if e == 'I' else kept[i][2]}")
                last = role[0]
            i += e != "I"
        assert SHAPE.fullmatch("".join(m[0] for m in messages)) and i == len(kept)
        out.append((conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, kinds.count("blank"), kinds.count("duplicate"),
                    kinds.count("truncated"), sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
                    hashlib.sha256("\n".join(messages).encode()).hexdigest()))
    return sorted(out, key=str)


def table(spark, rows):
    return with_clash(spark, spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))


def got(spark, rows, parts=3):
    df = table(spark, rows).repartition(parts)
    return sorted((tuple(r[c] for c in repair.RESULT) for r in repair.repair_conversations(repair.damaged(df)).collect()), key=str)


def test_lightest_derivation_is_the_shortest_edit():
    for n in range(6):
        for codes in product("dsuaxUA", repeat=n) if n < 5 else [random.Random(i).choices("dsuaxSUAX", k=9) for i in range(300)]:
            kinds = tuple("blank" if c == "d" else "truncated" if c.isupper() else "" for c in codes)
            assert repair.repair("".join(codes)) == shortest(tuple("" if c in "dx" else c.lower() for c in codes), kinds), codes


def test_agenda_pops_in_order_and_stops_at_the_goal():
    edges = {"a": [("b", ("a", "w")), ("c", ("a", "w", "w"))], "w": [], "b": [("goal", ("b", "w"))], "c": [("goal", ("c",))], "goal": []}
    popped = []

    def consequences(item, final):
        popped.append(item)
        return [(h, t) for x in final for h, t in edges[x] if item in t and all(y in final for y in t)]

    assert repair.lightest({"a": (0, "x"), "w": (1, "y"), "far": (99, "z")}, consequences, {"goal"}) == {"goal": (2, "xyy")}
    assert popped == ["a", "w", "b", "c", "goal"]  # "far" stays on the agenda


def test_segments_join_to_the_whole():
    for seed in range(60):
        rng = random.Random(seed)
        roles = [rng.choice(["system", "user", "user", "assistant", "assistant", "tool", ""]) for _ in range(rng.randint(0, 14))]
        texts = [rng.choice(["Yes.", "no", "", "Go!", "x?"]) + rng.choice(["", " "]) for _ in roles]
        whole = repair.Segment("=1", 1, 0, 0)
        cuts = sorted(rng.sample(range(len(roles) + 1), min(3, len(roles))))
        joined, seen, seg = None, set(), repair.Segment("=1", 1, 0, 0)
        for i, (r, t) in enumerate(zip(roles, texts)):
            if i in cuts:
                joined = joined or repair.Joined(seg.row())
                joined.add(seg.row())
                seg = repair.Segment("=1", 1, 0, seg.seg + 1)
            for s in (whole, seg):
                s.add(i // 2, r, t, (r, t) in seen)
            seen.add((r, t))
        joined = joined or repair.Joined(seg.row())
        joined.add(seg.row())
        whole.whole = True
        a, b = whole.row(), joined.row()
        assert {k: a[k] for k in b if k != "gaps"} == {k: b[k] for k in b if k != "gaps"}


def some(seed, n=60):
    rng = random.Random(seed)
    words = ["Yes.", "No", "Why?", "", " \n", "Fine!", "a. b", None, "tell me.", "日本.", "...", "x"]
    out = []
    for conv in range(n):
        for turn in range(rng.randint(0, 9)):
            out.append((conv if conv % 13 else None, rng.choice([turn, turn, turn, 3, None]),
                        rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "User"]), rng.choice(words)))
    return out + out[:20] + out[:3]


@pytest.mark.parametrize("parts", [1, 9])
def test_tables(spark, parts):
    rows = some(parts)
    assert got(spark, rows, parts) == brute(rows)


def test_long_conversation_over_many_segments(spark):
    rng = random.Random(5)
    rows = [(1, i if i % 50 else i - 1, rng.choice(["user", "assistant"]), f"{rng.choice(['same', i])}{rng.choice('. ?')}") for i in range(3000)]
    rows += [(2, 0, "user", "q?"), (2, 1, "assistant", "x" * 3_000_000 + "."), (3, 5, "assistant", "a.")]
    assert got(spark, rows, 8) == brute(rows)


def test_nothing_left_and_empty(spark):
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    assert got(spark, [(gone, 0, "user", "hi.")]) == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    assert got(spark, []) == []


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r["conv_id"], r["turn"], r["role"], r["text"]) for r in spark.read.parquet(f"{sf}/conversations.parquet").collect()]
    found = repair.op11_conversation_repair(spark, sf)
    assert found.columns == repair.RESULT
    assert sorted((tuple(r) for r in found.collect()), key=str) == brute(rows)
