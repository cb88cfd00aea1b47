"""Conversation structure repair as a lightest derivation (operator 11).

A conversation's rows are to become ``(s?(ua)+)?`` by keeping (0), re-roling (2) or deleting
(3) each row and inserting empty rows (2); a truncated row that stays costs 1.  Items are
``("at", i, q)``: the first i rows are dealt with and the roles so far end in
state q; and axioms for the edits.  A hyperedge leads from an item and an edit of the next
row (or an insertion) to the next item.  An item's value is (cost, audit), the audit being the edits'
initials; a hyperedge adds costs and joins audits.  Such functions are superior: a
value never beats the ones it is made of.  They are monotone, too: two
derivations of one item with equal costs differ in the same row or not at all, so neither
audit is the beginning of the other, and joining on keeps their order.  So Knuth's agenda
pops items in the order of their values, each final when popped, and ends with the goal.

*On a cluster.*  Rows are range-partitioned by conversation, turn, role and text, so one
conversation with a third of all rows spans many tasks.  A task reads its sorted
rows as a stream of segments of bounded rows and text.  A conversation that is surely whole
in a segment is repaired there (equal patterns of faults are solved once).  The others
leave their segments, which a second step joins in order: a segment's derivations
from each state to each state are hyperedges between the items at its ends.  Only this step
sees a conversation in one task, as a stream, because its SHA-256 runs over all its text in order.
Repeats are found by a grouped minimum over digests of role and text.

Edges.  A null role or text is one space; a null conv_id is a conversation of its own, a null turn is
first.  Rows of equal turn stand by role and text, so repeated rows are duplicates that touch.
An empty role has no initial that fits.  Conversations without rows after damage have
zeros.  An empty table gives an empty result.  Extra columns do no harm.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hexaccess.llm.common import read_table, stage_table

#: States of the roles so far: nothing yet, system, user, assistant.
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
#: The state behind a role of this initial, where one may stand.
NEXT = {(EMPTY, "s"): SYSTEM, (EMPTY, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER, (USER, "a"): ASSISTANT}
#: The role that an inserted or re-roled row has in a state.
ROLE = {EMPTY: "user", SYSTEM: "user", ASSISTANT: "user", USER: "assistant"}
GOALS = (EMPTY, ASSISTANT)
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
#: Rows and characters after which a segment is closed.
SEGMENT_ROWS, SEGMENT_CHARS = 256, 1 << 20
_SPACE = " \t\n\v\f\r"

Value = tuple[int, str]


# ----------------------------------------------------------------------------- lightest derivations

def lightest(axioms: dict, consequences: Callable, wanted: set) -> dict:
    """Values of the ``wanted`` items (those that have a derivation).

    ``consequences(item, final)`` gives (head, antecedents) of the hyperedges that ``item`` takes part in
    and whose other antecedents are in ``final``, the items already popped.
    """
    final: dict = {}
    agenda = [(value, item) for item, value in axioms.items()]
    heapq.heapify(agenda)
    found = 0
    while agenda and found < len(wanted):
        value, item = heapq.heappop(agenda)
        if item in final:
            continue
        final[item] = value
        found += item in wanted
        for head, antecedents in consequences(item, final):
            if head not in final:
                values = [final[a] for a in antecedents]
                heapq.heappush(agenda, ((sum(c for c, _ in values), "".join([a for _, a in values])), head))
    return {item: final[item] for item in wanted if item in final}


def _row_axioms(codes: str) -> dict:
    """The edits of rows given as codes: "d" must be deleted, else the role's initial, upper case if truncated."""
    axioms: dict = {("insert", ""): (INSERT, "I")}
    for i, code in enumerate(codes):
        axioms["edit", i, "D"] = (DELETE, "D")
        if code != "d":
            more = TRUNCATED * code.isupper()
            axioms["edit", i, "K"] = (KEEP + more, "K")
            axioms["edit", i, "R"] = (REROLE + more, "R")
    return axioms


def _row_consequences(codes: str) -> Callable:
    def state_after(i: int, edit: str, q: int) -> int | None:
        if edit == "D":
            return q
        return NEXT.get((q, codes[i].lower() if edit == "K" else ROLE[q][0]))

    def consequences(item: tuple, final: dict) -> Iterable:
        if item[0] == "at":
            _, i, q = item
            if ("insert", "") in final:
                yield ("at", i, NEXT[q, ROLE[q][0]]), (item, ("insert", ""))
            for edit in "DKR":
                if ("edit", i, edit) in final and (after := state_after(i, edit, q)) is not None:
                    yield ("at", i + 1, after), (item, ("edit", i, edit))
            if i == len(codes) and q in GOALS:
                yield ("goal", 0, 0), (item,)
        elif item[0] == "edit":
            _, i, edit = item
            for q in range(4):
                if ("at", i, q) in final and (after := state_after(i, edit, q)) is not None:
                    yield ("at", i + 1, after), (("at", i, q), item)
        elif item[0] == "insert":
            for at in [a for a in final if a[0] == "at"]:
                yield ("at", at[1], NEXT[at[2], ROLE[at[2]][0]]), (at, item)

    return consequences


@lru_cache(maxsize=50_000)
def repair(codes: str) -> Value:
    """(cost, audit) of the cheapest repair of a whole conversation."""
    goal = ("goal", 0, 0)
    return lightest(_row_axioms(codes) | {("at", 0, EMPTY): (0, "")}, _row_consequences(codes), {goal})[goal]


@lru_cache(maxsize=20_000)
def transfer(codes: str, start: int) -> dict[int, Value]:
    """By state after these rows: (cost, audit) of the cheapest edits that lead there from ``start``."""
    wanted = {("at", len(codes), q) for q in range(4)}
    found = lightest(_row_axioms(codes) | {("at", 0, start): (0, "")}, _row_consequences(codes), wanted)
    return {q: value for (_, _, q), value in found.items()}


def repaired(roles: list[str], texts: list[str], audit: str, state: int = EMPTY) -> Iterator[str]:
    """The messages ``role:text`` that these edits leave, the first of a conversation without a line feed before it."""
    i = 0
    for edit in audit:
        if edit != "D":
            role = roles[i] if edit == "K" else ROLE[state]
            text = "" if edit == "I" else texts[i]
            yield f"{'' if state == EMPTY else chr(10)}{role}:{text}"
            state = NEXT[state, role[0]]
        i += edit != "I"


# ----------------------------------------------------------------------------- rows and segments

SEGMENT = pa.schema([("key", pa.string()), ("conv_id", pa.int64()), ("part", pa.int32()), ("seg", pa.int64()), ("whole", pa.bool_()),
                     ("turns", pa.int64()), ("min_turn", pa.int64()), ("max_turn", pa.int64()), ("blank", pa.int64()),
                     ("duplicate", pa.int64()), ("truncated", pa.int64()), ("illegal", pa.int64()), ("first", pa.string()),
                     ("last", pa.string()), ("codes", pa.string()), ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string())),
                     ("cost", pa.int64()), ("audit", pa.string()), ("repaired_sha256", pa.string())])
SEGMENT_DDL = ("key string, conv_id long, part int, seg long, whole boolean, turns long, min_turn long, max_turn long, blank long, duplicate long, "
               "truncated long, illegal long, first string, last string, codes string, roles array<string>, texts array<string>, "
               "cost long, audit string, repaired_sha256 string")
RESULT = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
RESULT_DDL = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
              "repaired_sha256 string")


class Segment:
    """Rows of one conversation that follow each other, and what is counted in them."""

    def __init__(self, key: str, conv_id: int | None, part: int, seg: int):
        self.key, self.conv_id, self.part, self.seg, self.whole = key, conv_id, part, seg, False
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = self.chars = 0
        self.min_turn = self.max_turn = self.first = self.last = None
        self.codes, self.roles, self.texts = [], [], []

    def add(self, turn: int | None, role: str, text: str, repeat: bool) -> None:
        body, initial = text.rstrip(_SPACE), role[:1]
        code = "d"
        if not body:
            self.blank += 1
        elif repeat:
            self.duplicate += 1
        else:
            code = initial if initial and initial in "sua" else "x"
            if body[-1] not in ".!?":
                self.truncated += 1
                code = code.upper()
        if self.last is None:
            self.first = initial
        elif self.last + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.last = initial
        if turn is not None:
            self.turns += turn != self.max_turn
            self.min_turn = turn if self.min_turn is None else self.min_turn
            self.max_turn = turn
        self.codes.append(code)
        self.roles.append(role)
        self.texts.append(text)
        self.chars += len(text)

    def row(self) -> dict:
        out = {n: getattr(self, n) for n in SEGMENT.names[:14]} | {"codes": "".join(self.codes)}
        if self.whole:
            cost, audit = repair(out["codes"])
            digest = hashlib.sha256()
            for message in repaired(self.roles, self.texts, audit):
                digest.update(message.encode())
            return out | {"codes": None, "roles": None, "texts": None, "cost": cost, "audit": audit, "repaired_sha256": digest.hexdigest()}
        return out | {"roles": self.roles, "texts": self.texts, "cost": None, "audit": None, "repaired_sha256": None}


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's sorted rows as segments; the task's first and last conversation may go on elsewhere."""
    from pyspark import TaskContext
    part = TaskContext.get().partitionId()
    ready: list[dict] = []
    now, opened, before = None, 0, None          # opened: conversations so far; before: the row before
    for batch in batches:
        columns = [batch.column(n).to_pylist() for n in ("_key", "conv_id", "turn", "role", "text", "copies", "seen")]
        for key, conv_id, turn, role, text, copies, seen in zip(*columns):
            if now is None or key != now.key:
                if now is not None:
                    now.whole = now.seg == 0 and opened > 1
                    ready.append(now.row())
                now, opened, before = Segment(key, conv_id, part, 0), opened + 1, None
            for _ in range(copies):
                if len(now.codes) >= SEGMENT_ROWS or now.chars >= SEGMENT_CHARS:
                    ready.append(now.row())
                    now = Segment(key, conv_id, part, now.seg + 1)
                now.add(turn, role, text, seen or before == (turn, role, text))
                before = (turn, role, text)
            if len(ready) >= 1000 or sum(len(r["texts"] or ()) for r in ready[-4:]) >= SEGMENT_ROWS:
                yield pa.RecordBatch.from_pylist(ready, schema=SEGMENT)
                ready = []
    if now is not None:
        ready.append(now.row())
        yield pa.RecordBatch.from_pylist(ready, schema=SEGMENT)


class Joined:
    """A conversation's segments taken in order: by state the lightest way there, with the hash of its messages."""

    def __init__(self, first: dict):
        self.conv_id = first["conv_id"]
        self.ways: dict[int, tuple[Value, object]] = {EMPTY: ((0, ""), hashlib.sha256())}
        self.counts = dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "turns"), 0)
        self.min_turn = self.max_turn = self.last = None

    def add(self, s: dict) -> None:
        for c in self.counts:
            self.counts[c] += s[c]
        if s["min_turn"] is not None:
            self.counts["turns"] -= s["min_turn"] == self.max_turn
            self.min_turn = s["min_turn"] if self.min_turn is None else self.min_turn
            self.max_turn = s["max_turn"]
        if s["last"] is not None:
            self.counts["illegal"] += self.last is not None and self.last + s["first"] not in ("su", "ua", "au")
            self.last = s["last"]
        if not s["codes"]:
            return
        axioms: dict = {("before", q): value for q, (value, _) in self.ways.items()}
        axioms |= {("across", q, r): value for q in self.ways for r, value in transfer(s["codes"], q).items()}

        def consequences(item: tuple, final: dict) -> Iterable:
            for r in range(4):
                a = item[1]
                if item[0] == "before" and ("across", a, r) in final:
                    yield ("behind", r, a), (item, ("across", a, r))
                elif item[0] == "across" and item[2] == r and ("before", a) in final:
                    yield ("behind", r, a), (("before", a), item)

        found = lightest(axioms, consequences, {("behind", r, q) for q in self.ways for r in range(4) if ("across", q, r) in axioms})
        ways: dict = {}
        for (_, r, q), value in sorted(found.items(), key=lambda x: x[1]):
            ways.setdefault(r, (value, q))
        after = {}
        for r, (value, q) in ways.items():
            digest = self.ways[q][1].copy()
            for message in repaired(s["roles"], s["texts"], axioms["across", q, r][1], q):
                digest.update(message.encode())
            after[r] = (value, digest)
        self.ways = after

    def row(self) -> dict:
        (cost, audit), digest = min((self.ways[q] for q in GOALS if q in self.ways), key=lambda w: w[0])
        c = self.counts
        return {"conv_id": self.conv_id, "gaps": _gaps(self.min_turn, self.max_turn, c["turns"]), "blank": c["blank"],
                "duplicate": c["duplicate"], "truncated": c["truncated"], "illegal": c["illegal"], "cost": cost, "audit": audit,
                "repaired_sha256": digest.hexdigest()}


def _gaps(low: int | None, high: int | None, distinct: int) -> int:
    return 0 if low is None else high - low + 1 - distinct


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([(n, SEGMENT.field(n).type if n in SEGMENT.names else pa.int64()) for n in RESULT])
    key, now = None, None
    for batch in batches:
        for at in range(len(batch)):
            s = batch.slice(at, 1).to_pylist()[0]
            if now is None or s["key"] != key:
                if now is not None:
                    yield pa.RecordBatch.from_pylist([now.row()], schema=schema)
                key, now = s["key"], Joined(s)
            now.add(s)
    if now is not None:
        yield pa.RecordBatch.from_pylist([now.row()], schema=schema)


# ----------------------------------------------------------------------------- Spark

def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, copies (0: dropped) of every row after damage by a hash of conversation and turn."""
    named = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fate = F.crc32(F.concat(named("conv_id"), F.lit(":"), named("turn")).cast("binary")) % 20
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.when(fate == 4, F.lit("user")).otherwise(named("role")).alias("role"),
        F.when(fate == 1, F.lit("")).when(fate == 2, F.regexp_replace(named("text"), "[.!?]", "")).otherwise(named("text")).alias("text"),
        F.when(fate == 0, 0).when(fate == 3, 2).otherwise(1).alias("copies"))


def repair_conversations(rows: DataFrame) -> DataFrame:
    """One row per conv_id of ``rows`` (conv_id, turn, role, text, copies: how often a row stands, 0 for not at all)."""
    order: Column = F.struct(F.col("turn").isNotNull(), "turn")
    keyed = rows.select(F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")).alias("_key"), "conv_id", "turn",
                        F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), "copies")
    keyed = keyed.withColumn("_same", F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")).cast("binary"), 256))
    first = keyed.where("copies > 0").groupBy("_key", "_same").agg(F.min(order).alias("_first"))
    tagged = stage_table(keyed.join(first, ["_key", "_same"], "left").select(
        "_key", "conv_id", "turn", "role", "text", "copies", F.coalesce(F.col("_first") < order, F.lit(False)).alias("seen")), "tagged")
    by = ["_key", F.col("turn").asc_nulls_first(), "role", "text"]
    segments = stage_table(tagged.repartitionByRange(*by).sortWithinPartitions(*by).mapInArrow(_segments, SEGMENT_DDL), "segments")
    gaps = F.when(F.col("min_turn").isNull(), 0).otherwise(F.col("max_turn") - F.col("min_turn") + 1 - F.col("turns")).cast("long")
    whole = segments.where("whole").withColumn("gaps", gaps).select(*RESULT)
    rest = segments.where("NOT whole").repartition("key").sortWithinPartitions("key", "part", "seg")
    return whole.unionByName(rest.mapInArrow(_joined, RESULT_DDL))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_conversations(damaged(read_table(spark, sf_dir, "conversations")))
