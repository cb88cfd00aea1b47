"""Personal data with information-theoretic sanitisation (operator 7).

Base spans come from fixed patterns (e-mail, IP, card, phone).  What they hold
are the protected entities.  A term that keeps company with an entity may
disclose it even after the entity itself is masked: over the whole corpus the
co-occurrence of term t near entity e gives PMI(t; e) = log2(N co(t, e) /
(df(t) df(e))), and the share PMI / IC(e) of the entity's information content
IC(e) = log2(N / df(e)) says how much of it the term gives away (1: the term
never stands elsewhere).  From ``generalise_at`` on a term is generalised, from
``remove_at`` on removed, in every document of the corpus.  To be believed, a pair
must be seen in at least ``min_contexts`` different contexts, in one document or in
several, so copies of one passage prove nothing.  A pair in fewer contexts is
believed if two of them differ on both sides of the entity (near copies hardly do)
and its documents are too many for chance: the Chernoff bound of co(t, e) of df(e)
documents drawn by df(t) of N, times the pairs looked at, is ``CHANCE`` or less.

A context is the words (at most ``CONTEXT_WORDS`` a side, within
``CONTEXT_CHARS`` characters) around a base span; a term is a word without the
signs around it, with a letter, outside base spans.
Entities are kept as hashes only.  Counts are grouped sums.  Document frequency
is counted over all documents, for the terms that have enough contexts and could
reach the threshold if they stood nowhere else; such terms, and the flagged
ones, go to all tasks where they are counted to be few, and are joined beyond.

Edges.  A null text is the empty one, without spans.  Rows with equal doc_id and
text have the same spans; each counts as a document.  A null doc_id is a value
like any other.  An empty table gives an empty result.  Only doc_id and text
are read, so extra columns of any name do no harm (``sanitise`` passes them on).
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hexaccess.llm.common import WORD, read_table, stage_table

KINDS = ("email", "ip", "card", "phone", "term")
CONTEXT_WORDS, CONTEXT_CHARS = 8, 200
MIN_CONTEXTS = 3
CHANCE = 0.01
GENERALISE_AT, REMOVE_AT = 0.6, 0.9
#: Up to so many flagged terms go to all tasks; beyond that they are joined with each document's words.
BROADCAST_TERMS = 100_000
#: Texts that a worker holds as Python strings at a time.
ROWS_AT_ONCE = 256
#: Signs that don't belong to a term when they stand around it.
EDGE_SIGNS = ".,;:!?()[]{}\"'"
LABELS = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]", "generalise": "[TERM]", "remove": ""}

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")  # a match never begins within a run of digits
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_WORD = re.compile(WORD)
_DIGIT = re.compile("[0-9]")


# ----------------------------------------------------------------------------- spans of one text

def _emails(text: str) -> Iterator[tuple[int, int]]:
    """From each @ outwards, so that a long run of letters is walked once."""
    end, at = 0, text.find("@")
    while at >= 0:
        left = at
        while left > end and text[left - 1] in _LOCAL:
            left -= 1
        domain = _DOMAIN.match(text, at + 1) if left < at else None
        if domain:
            end = domain.end()
            yield left, end
        at = text.find("@", max(end, at + 1))


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        total += n if i % 2 == 0 else n * 2 - 9 * (n > 4)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, number of the kind, end), in the order of the contract."""
    out = [(a, 0, b) for a, b in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            out.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = "".join(_DIGIT.findall(m.group()))
            if 14 <= len(digits) <= 19 and _luhn(digits):
                out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= len(_DIGIT.findall(m.group())) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


def joined(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def masked(text: str, spans) -> str:
    """The text with blanks in place of the spans, of the same length."""
    out, at = [], 0
    for a, _, b in sorted(spans):
        if b > at:
            a = max(a, at)
            out += [text[at:a], " " * (b - a)]
            at = b
    return "".join(out) + text[at:]


def _term(word: str) -> str | None:
    word = word.strip(EDGE_SIGNS)
    return word if len(word) > 1 and any(map(str.isalpha, word)) else None


def contexts(text: str, spans) -> list[tuple[str, tuple[str, str], list[str]]]:
    """(entity, the context's words before and after, terms) of each base span."""
    clean, out = masked(text, spans), []
    for a, k, b in spans:
        before = clean[max(0, a - CONTEXT_CHARS):a].split()
        after = clean[b:b + CONTEXT_CHARS].split()
        if a > CONTEXT_CHARS and before and not clean[a - CONTEXT_CHARS - 1].isspace():
            before = before[1:]  # the rest of a word
        if b + CONTEXT_CHARS < len(clean) and after and not clean[b + CONTEXT_CHARS].isspace():
            after = after[:-1]
        before, after = before[-CONTEXT_WORDS:], after[:CONTEXT_WORDS]
        value = text[a:b].lower() if k == 0 else "".join(_DIGIT.findall(text[a:b])) if k > 1 else text[a:b]
        out.append((f"{KINDS[k]}:{value}", (" ".join(before), " ".join(after)), sorted({t for w in before + after if (t := _term(w))})))
    return out


def _number(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def term_spans(text: str, spans, terms) -> list[tuple[int, int, int]]:
    out = []
    for m in _WORD.finditer(masked(text, spans)):
        word = m.group()
        core = word.strip(EDGE_SIGNS)
        if core in terms:
            a = m.start() + len(word) - len(word.lstrip(EDGE_SIGNS))
            out.append((a, 4, a + len(core)))
    return out


def sanitised_text(text: str, actions: dict[str, str]) -> str:
    """Base spans become their kind's label; flagged terms become [TERM] or go."""
    spans = base_spans(text)
    marks = sorted([(a, b, LABELS[KINDS[k]]) for a, k, b in spans]
                   + [(a, b, LABELS[actions[text[a:b]]]) for a, _, b in term_spans(text, spans, actions)])
    out, at = [], 0
    for a, b, label in marks:
        if a >= at:
            out += [text[at:a], label]
        at = max(at, b)
    return "".join(out) + text[at:]


# ----------------------------------------------------------------------------- Spark

NEAR = "entity long, context long, before long, after long, fresh array<string>, again array<string>, new array<string>, first boolean"
FOUND = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"
FOUND_NAMES = [c.split(" ")[0] for c in FOUND.split(", ")]


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, len(batch), ROWS_AT_ONCE):
            yield batch.slice(at, ROWS_AT_ONCE)


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in _slices(batches):
        rows = []
        for text in part.column("text").to_pylist():
            spans, seen = base_spans(text or ""), set()
            for entity, (before, after), terms in contexts(text, spans) if spans else []:
                e, context = _number(entity), _number(f"{before} {after}")
                if (e, context, None) in seen:  # has nothing that this document hasn't shown
                    continue
                fresh = [t for t in terms if (e, t) not in seen]  # a pair counts once per document, its contexts each
                again = [t for t in terms if (e, t) in seen]
                new = [t for t in terms if (None, t) not in seen]  # not yet met in this document, near whatever entity
                first = (e, None) not in seen
                seen.update((e, t) for t in fresh)
                seen.update((None, t) for t in new)
                seen.update([(e, None), (e, context, None)])
                # a side without words tells no more than the context
                rows.append({"entity": e, "context": context, "before": _number(before) if before else context,
                             "after": _number(after) if after else context, "fresh": fresh, "again": again, "new": new, "first": first})
        yield pa.RecordBatch.from_pylist(rows, pa.schema([
            ("entity", pa.int64()), ("context", pa.int64()), ("before", pa.int64()), ("after", pa.int64()), ("fresh", pa.list_(pa.string())),
            ("again", pa.list_(pa.string())), ("new", pa.list_(pa.string())), ("first", pa.bool_())]))


def _words(docs: DataFrame) -> DataFrame:
    """(doc_id, h, term): the different words of each document, without the signs around them."""
    words = F.array_distinct(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))
    return docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("h"), F.explode(
        F.array_distinct(F.transform(words, lambda w: F.btrim(w, F.lit(EDGE_SIGNS))))).alias("term"))


def _document_frequency(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """(term, df_t): documents that hold each of these terms.  Terms that are counted to be few go to all tasks,
    and each task sums its own documents first; more terms are joined with the documents' words."""
    if terms.count() > BROADCAST_TERMS:
        return _words(docs).join(terms, "term").groupBy("term").agg(F.count("*").alias("df_t"))
    shared = docs.sparkSession.sparkContext.broadcast(frozenset(r["term"] for r in terms.collect()))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, found = shared.value, Counter()
        for part in _slices(batches) if wanted else ():
            for text in part.column("text").to_pylist():
                words = set(_blanks(text or "").split(" "))
                found.update(wanted.intersection([w.strip(EDGE_SIGNS) for w in words]))
        yield pa.RecordBatch.from_arrays([pa.array(found.keys(), pa.string()), pa.array(found.values(), pa.int64())], names=["term", "n"])

    return (docs.select("text").mapInArrow(count, "term string, n long")
            .groupBy("term").agg(F.sum("n").alias("df_t")))


def _blanks(text: str) -> str:
    """The text with a space for each character that ends words."""
    for sign in "\t\n\x0b\x0c\r":
        text = text.replace(sign, " ")
    return text


def disclosing_terms(docs: DataFrame, min_contexts: int = MIN_CONTEXTS, generalise_at: float = GENERALISE_AT,
                     remove_at: float = REMOVE_AT) -> DataFrame:
    """(term, share, action) of the terms that disclose an entity."""
    near = stage_table(docs.select("text").mapInArrow(_contexts, NEAR), "contexts")
    seen = F.concat(F.transform("fresh", lambda t: F.struct(t.alias("term"), F.lit(1).alias("n"))),
                    F.transform("again", lambda t: F.struct(t.alias("term"), F.lit(0).alias("n"))))
    pairs = (near.select("entity", "context", "before", "after", F.inline(seen))
             .groupBy("term", "entity", "context").agg(F.sum("n").alias("n"), F.min("before").alias("before"), F.min("after").alias("after"))
             .groupBy("term", "entity").agg(F.sum("n").alias("co"), F.count("*").alias("contexts"), (
                 (F.min("before") != F.max("before")) & (F.min("after") != F.max("after"))).alias("apart")))
    pairs = pairs.where((F.col("contexts") >= min_contexts) | F.col("apart"))
    looked_at = max(near.agg(F.sum(F.size("fresh"))).first()[0] or 0, 1)
    entities = near.where("first").groupBy("entity").agg(F.count("*").alias("df_e"))
    total = F.lit(float(max(docs.count(), 1)))

    def share(df_t):
        return F.log2(total * F.col("co") / (F.col(df_t) * F.col("df_e"))) / F.log2(total / F.col("df_e"))

    def believed(df_t):
        q, p = F.col("co") / F.col("df_e"), F.col(df_t) / total
        rest = F.when(q < 1, (1 - q) * (F.log(1 - q) - F.log(1 - p))).otherwise(0.0)
        bound = F.col("df_e") * (q * (F.log(q) - F.log(p)) + rest)
        return (F.col("contexts") >= min_contexts) | (F.col("apart") & (q > p) & (bound >= math.log(looked_at / CHANCE)))

    # a term stands in at least the documents that have it near an entity: common ones are out of reach at once
    least = near.select(F.explode("new").alias("term")).groupBy("term").agg(F.count("*").alias("least_df"))
    pairs = stage_table(pairs.join(least, "term").join(entities, "entity")
                        .where((total > F.col("df_e")) & (share("least_df") >= generalise_at) & believed("least_df")), "pairs")
    counts = _document_frequency(docs, stage_table(pairs.select("term").distinct(), "terms"))
    shares = pairs.join(counts, "term").where(believed("df_t")).groupBy("term").agg(F.max(share("df_t")).alias("share"))
    return stage_table(shares.where(F.col("share") >= generalise_at)
                       .withColumn("action", F.when(F.col("share") >= remove_at, "remove").otherwise("generalise")), "flagged")


def _with_terms(docs: DataFrame, flagged: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """(rows (_row, doc_id, text, hits), terms that concern all rows).

    Flagged terms that are counted to be few go to all tasks; if there are more, each
    document gets those among its own words (hits) by a join on the document."""
    rows = docs.select(F.struct("*").alias("_row"), F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("_of"))
    if flagged.count() <= BROADCAST_TERMS:
        return (rows.withColumn("hits", F.lit(None).cast("array<struct<term:string,action:string>>")),
                {r["term"]: r["action"] for r in flagged.select("term", "action").collect()})
    hits = (_words(docs).join(flagged, "term").distinct().groupBy(F.col("doc_id").alias("_id"), F.col("h").alias("_h"))
            .agg(F.collect_list(F.struct("term", "action")).alias("hits")))
    return rows.join(hits, F.col("doc_id").eqNullSafe(F.col("_id")) & F.col("_of").eqNullSafe(F.col("_h")), "left"), {}


def find_personal(docs: DataFrame, **thresholds) -> DataFrame:
    """One row per document: counts and hash of the base spans, and all spans."""
    rows, common = _with_terms(docs.select("doc_id", "text"), disclosing_terms(docs, **thresholds))
    shared = docs.sparkSession.sparkContext.broadcast(common)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _slices(batches):
            out = []
            for text, hits in zip(part.column("text").to_pylist(), part.column("hits").to_pylist()):
                text = text or ""
                spans = base_spans(text)
                base = joined(spans)
                terms = shared.value if hits is None else {x["term"] for x in hits}
                more = term_spans(text, spans, terms) if terms else []
                out.append((*[sum(k == n for _, k, _ in spans) for n in range(4)], hashlib.sha256(base.encode()).hexdigest(),
                            joined(sorted(spans + more)) if more else base))
            columns = list(zip(*out)) or [()] * 6
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), *[pa.array(c, pa.int64()) for c in columns[:4]],
                                              *[pa.array(c, pa.string()) for c in columns[4:]]], names=FOUND_NAMES)

    return rows.select("doc_id", "text", "hits").mapInArrow(find, FOUND)


def sanitise(docs: DataFrame, **thresholds) -> DataFrame:
    """The rows of ``docs`` with sanitised texts (null texts stay null)."""
    rows, common = _with_terms(docs, disclosing_terms(docs, **thresholds))
    shared = docs.sparkSession.sparkContext.broadcast(common)

    @F.pandas_udf("string")
    def clean(text: pd.Series, hits: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else sanitised_text(t, shared.value if h is None else {x["term"]: x["action"] for x in h})
                          for t, h in zip(text, hits)], dtype=object)

    return rows.select(F.col("_row").withField("text", clean("text", "hits")).alias("_row")).select("_row.*")


def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_personal(read_table(spark, sf_dir, "documents"))
