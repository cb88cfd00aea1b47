"""Quality classifier: Naive Bayes support vectors (operator 1).

A text's features are indicators of n-grams: words and word pairs, and runs of
one to four token shapes (lower, Title, UPPER, digits, kinds of punctuation,
"same as the token before").  Each indicator is scaled by its class log-count
ratio r = log((p / |p|) / (q / |q|)), the vector is brought to length 1, and a
linear hinge-loss model is fitted by dual coordinate descent.  Margins become
scores through a sigmoid fitted to margins from held-out folds.

The model is fitted on at most ``max_train`` labels and as many different labelled rows, the
first in the order of hashes (a documented bound: the fit runs on the driver
over lists of feature numbers).  Scoring reads every whole text, once, with the
model broadcast (at most ``max_features`` weights).

Edges.  A null text is the empty one.  Texts without known features, the empty
one included, get the score of margin = bias.  Without labels, or with one class
only, every score is the smoothed share of label 1, (n1 + 1) / (n + 2).  Labels
of null quality are no labels; equal rows (doc_id, label and text) train once; of
several texts with one doc_id each takes its labels.  A NUL separates tokens like
white space.  A null doc_id is scored, never trained on, and not held out.  Labels, lang, source and doc_id are
no features.  Extra columns of any name do no harm.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hexaccess.llm.common import read_table, stage_table

MAX_TRAIN = 6_000
MIN_DOCS, MAX_FEATURES = 5, 200_000
COST, EPOCHS, FOLDS = 1.0, 30, 3
THRESHOLD = 0.7
SHAPE_RUN = 4
#: Texts that a worker holds as Python strings at a time.
ROWS_AT_ONCE = 64
#: Shapes of longer tokens are found each time.
KEPT_LENGTH = 40

_TOKEN = re.compile(r"\w+|[^\w\s\x00]+|\n")
#: Shapes: 0 line feed, 1 same as the token before, 2 digits, 3 UPPER, 4 Title, 5 lower, 6 other letters,
#: 7 other sign, 8 run of other signs, then single and repeated signs of this list.
_SIGNS = ".,;:!?-'\"()|*#$%&/"
_BASE = 9 + 2 * len(_SIGNS)


def _shape(token: str) -> int:
    return _kept_shape(token) if len(token) <= KEPT_LENGTH else _own_shape(token)


def _own_shape(token: str) -> int:
    c = token[0]
    if c == "\n":
        return 0
    if c.isalnum() or c == "_":
        if c.isdigit():
            return 2
        if token.isupper() and len(token) > 1:
            return 3
        return 4 if c.isupper() else 5 if c.islower() else 6
    many = len(token) > 1
    at = _SIGNS.find(c)
    return 8 if many and at < 0 else 7 if at < 0 else 9 + at + len(_SIGNS) * many


_kept_shape = lru_cache(maxsize=50_000)(_own_shape)


def _shape_runs(tokens: list[str]) -> np.ndarray:
    """Distinct codes of the runs of 1 to 4 shapes; a run's code tells its length."""
    if not tokens:
        return np.zeros(0, dtype=np.int64)
    shapes = np.array([_shape(t) for t in tokens], dtype=np.int64)
    same = np.array([False] + [a == b for a, b in zip(tokens, tokens[1:])])
    shapes[same & (shapes != 0)] = 1
    codes, run = [], np.zeros(len(shapes), dtype=np.int64)
    for n in range(min(SHAPE_RUN, len(shapes))):
        run = run[:len(shapes) - n] * (_BASE + 1) + shapes[n:] + 1
        codes.append(np.unique(run))
    return np.concatenate(codes)


def features(text: str | None) -> list[str]:
    """The n-grams that occur in a text, as strings (for fitting)."""
    tokens = _TOKEN.findall(text or "")
    return ([f"w{t}" for t in set(tokens)] + [f"p{a}\x00{b}" for a, b in set(zip(tokens, tokens[1:]))]
            + [f"s{c}" for c in _shape_runs(tokens)])


# ----------------------------------------------------------------------------- the model

@dataclass
class Model:
    """Per feature: weight * ratio and ratio squared; words by number, pairs and shape runs by sorted code."""
    bias: float = 0.0
    slope: float = 0.0
    offset: float = 0.0
    words: dict = field(default_factory=dict)
    word_values: np.ndarray = field(default_factory=lambda: np.zeros((0, 2)))
    pairs: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    pair_values: np.ndarray = field(default_factory=lambda: np.zeros((0, 2)))
    shapes: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    shape_values: np.ndarray = field(default_factory=lambda: np.zeros((0, 2)))

    def margin(self, text: str | None) -> float:
        tokens = _TOKEN.findall(text or "")
        get = self.words.get
        ids = np.array([get(t, -1) for t in tokens], dtype=np.int64)
        total = self.word_values[np.unique(ids[ids >= 0])].sum(axis=0) if len(ids) else np.zeros(2)
        both = (ids[1:] >= 0) & (ids[:-1] >= 0)
        for codes, known, values in ((np.unique(ids[:-1][both] * len(self.words) + ids[1:][both]), self.pairs, self.pair_values),
                                     (_shape_runs(tokens), self.shapes, self.shape_values)):
            if len(codes) and len(known):
                at = np.minimum(np.searchsorted(known, codes), len(known) - 1)
                total = total + values[at[known[at] == codes]].sum(axis=0)
        return float(total[0] / np.sqrt(total[1]) if total[1] > 0 else 0.0) + self.bias

    def score(self, text: str | None) -> float:
        z = self.slope * self.margin(text) + self.offset
        return float(1 / (1 + np.exp(-z))) if z >= 0 else float(np.exp(z) / (1 + np.exp(z)))


def log_count_ratio(positive: np.ndarray, negative: np.ndarray) -> np.ndarray:
    p, q = positive + 1.0, negative + 1.0
    return np.log((p / p.sum()) / (q / q.sum()))


def dual_coordinate_descent(rows: list[np.ndarray], values: list[np.ndarray], y: np.ndarray, n: int,
                            cost: float = COST, epochs: int = EPOCHS, seed: int = 0) -> np.ndarray:
    """Weights (the bias last) of min |w|^2 / 2 + cost * sum(max(0, 1 - y (w x + b))), one dual variable at a time."""
    w, dual = np.zeros(n + 1), np.zeros(len(y))
    norms = np.array([v @ v + 1.0 for v in values])
    order = np.random.default_rng(seed)
    for _ in range(epochs):
        worst = 0.0
        for i in order.permutation(len(y)):
            slope = y[i] * (w[rows[i]] @ values[i] + w[n]) - 1
            free = min(slope, 0.0) if dual[i] == 0 else max(slope, 0.0) if dual[i] == cost else slope
            if free:
                old = dual[i]
                dual[i] = min(max(old - slope / norms[i], 0.0), cost)
                step = (dual[i] - old) * y[i]
                w[rows[i]] += step * values[i]
                w[n] += step
                worst = max(worst, abs(free))
        if worst < 1e-3:
            break
    return w


def sigmoid_fit(margins: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the score, by Newton steps towards smoothed targets."""
    n1, n0 = (y > 0).sum(), (y < 0).sum()
    target = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x, theta = np.column_stack([margins, np.ones(len(margins))]), np.array([1.0, 0.0])
    loss = lambda t: float(np.logaddexp(0, -(x @ t)) @ target + np.logaddexp(0, x @ t) @ (1 - target) + 1e-3 * t @ t)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -500, 500)))
        grad = x.T @ (p - target) + 2e-3 * theta
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + 2e-3 * np.eye(2), grad)
        size, now = 1.0, loss(theta)
        while size > 1e-6 and loss(theta - size * step) > now:
            size /= 2
        theta = theta - size * step
        if np.abs(size * step).max() < 1e-8:
            break
    return float(theta[0]), float(theta[1])


def _unit(ratio: np.ndarray, row: np.ndarray) -> np.ndarray:
    v = ratio[row]
    length = np.sqrt(v @ v)
    return v / length if length > 0 else v


def fit_model(names: list[str], positive: np.ndarray, negative: np.ndarray, rows: list[np.ndarray], y: np.ndarray) -> Model:
    n1, n = int((y > 0).sum()), len(y)
    if n1 == 0 or n1 == n:
        return Model(offset=float(np.log((n1 + 1) / (n - n1 + 1))))
    ratio = log_count_ratio(positive, negative)
    values = [_unit(ratio, r) for r in rows]
    fold, held = np.arange(n) % FOLDS, np.zeros(n)
    for k in range(FOLDS):
        fit = np.flatnonzero(fold != k)
        w = dual_coordinate_descent([rows[i] for i in fit], [values[i] for i in fit], y[fit], len(names))
        for i in np.flatnonzero(fold == k):
            held[i] = w[rows[i]] @ values[i] + w[-1]
    w = dual_coordinate_descent(rows, values, y, len(names))
    model = Model(bias=float(w[-1]))
    model.slope, model.offset = sigmoid_fit(held, y)
    both = np.column_stack([w[:-1] * ratio, ratio ** 2])
    words = {}
    for name in names:
        for token in [name[1:]] if name[0] == "w" else name[1:].split("\x00") if name[0] == "p" else []:
            words.setdefault(token, len(words))
    model.words, model.word_values = words, np.zeros((len(words), 2))
    pairs, shapes = [], []
    for i, name in enumerate(names):
        if name[0] == "w":
            model.word_values[words[name[1:]]] = both[i]
        elif name[0] == "p":
            a, b = name[1:].split("\x00")
            pairs.append((words[a] * len(words) + words[b], i))
        else:
            shapes.append((int(name[1:]), i))
    for codes, at, at_values in ((pairs, "pairs", "pair_values"), (shapes, "shapes", "shape_values")):
        codes.sort()
        setattr(model, at, np.array([c for c, _ in codes], dtype=np.int64))
        setattr(model, at_values, both[[i for _, i in codes]] if codes else np.zeros((0, 2)))
    return model


# ----------------------------------------------------------------------------- Spark

def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN, max_features: int = MAX_FEATURES) -> Model:
    """Fit on the labelled rows that are not held out: of at most ``max_train`` labels at most ``max_train`` different rows."""
    chosen = (labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
              .select(F.col("doc_id").alias("_id"), F.col("quality").cast("int").alias("y"))
              .orderBy(F.xxhash64("_id"), "_id", "y").limit(max_train))
    found = stage_table(docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("_id"))
                        .select(F.col("doc_id").cast("long").alias("doc_id"), "text", "y", F.xxhash64("doc_id", "y", "text").alias("h")), "labelled")
    # an id may stand on any number of rows: equal ones count once, and of the different ones the first by hash
    last = found.select("h").distinct().orderBy("h").limit(max_train).agg(F.max("h")).first()[0]
    texts = (found.where(F.col("h") <= F.lit(last)).groupBy("h")
             .agg(F.first("doc_id").alias("doc_id"), F.first("text").alias("text"), F.first("y").alias("y")).drop("h"))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), ROWS_AT_ONCE):
                part = batch.slice(at, ROWS_AT_ONCE)
                grams = pa.array([features(t) for t in part.column("text").to_pylist()], pa.list_(pa.string()))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("y"), grams], names=["doc_id", "y", "grams"])

    grams = stage_table(texts.select("doc_id", "text", "y").mapInArrow(extract, "doc_id long, y int, grams array<string>"), "grams")
    counted = (grams.select("y", F.explode("grams").alias("gram")).groupBy("gram")
               .agg(F.sum("y").alias("p"), F.sum(1 - F.col("y")).alias("q")).where(F.col("p") + F.col("q") >= MIN_DOCS)
               .orderBy((F.col("p") + F.col("q")).desc(), "gram").limit(max_features)).toPandas()
    names = counted["gram"].tolist()
    number = docs.sparkSession.sparkContext.broadcast({g: i for i, g in enumerate(names)})

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = number.value
        for batch in batches:
            for at in range(0, len(batch), ROWS_AT_ONCE):
                part = batch.slice(at, ROWS_AT_ONCE)
                row = pa.array([np.array(sorted(known[g] for g in gs if g in known), dtype="<i4").tobytes()
                                for gs in part.column("grams").to_pylist()], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("y"), row], names=["doc_id", "y", "row"])

    rows = sorted(((r["doc_id"], r["y"], bytes(r["row"])) for r in
                   grams.mapInArrow(numbered, "doc_id long, y int, row binary").toLocalIterator()))
    number.destroy()  # workers keep broadcasts as long as they live
    return fit_model(names, counted["p"].to_numpy(dtype=float), counted["q"].to_numpy(dtype=float),
                     [np.frombuffer(r, dtype="<i4").astype(np.int64) for _, _, r in rows], np.array([1 if y == 1 else -1 for _, y, _ in rows]))


def score_column(model: Model, text: Column, spark: SparkSession) -> Column:
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def quality_score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = shared.value
        for texts in batches:
            yield pa.array([model.score(t) for at in range(0, len(texts), ROWS_AT_ONCE)
                            for t in texts.slice(at, ROWS_AT_ONCE).to_pylist()], pa.float64())
            del texts
            pa.default_memory_pool().release_unused()  # what a batch took goes back, not to the worker's next stage

    return quality_score(text)


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = train(docs, read_table(spark, sf_dir, "labels"))
    return (docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score_column(model, F.col("text"), spark).alias("score"))
            .withColumn("predicted", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0)))


def accept(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the classifier accepts, with all their columns."""
    model = train(docs, labels)
    scored = docs.select(F.struct("*").alias("_row"), score_column(model, F.col("text"), docs.sparkSession).alias("_score"))
    return scored.where(F.col("_score") >= THRESHOLD).select("_row.*")
