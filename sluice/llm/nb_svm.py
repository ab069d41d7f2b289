"""Quality classifier: n-gram indicators scaled by naive Bayes log-count ratios, then a linear hinge-loss model by dual coordinate descent.

A text gives two streams of tokens: its lower-cased words, and their shapes (runs of letters of a case and of digits drawn together, every other
character kept, a mark where a word equals the one before it, and line ends, marked where the line occurred before). The indicators are hashed 1- and 2-grams of words
and 1- to 3-grams of shapes. A bucket's log-count ratio says how much more often good documents hold it than bad ones; the linear
model sees the ratio where the document holds the bucket, in vectors of unit length. Margins become probabilities by a logistic curve
fitted to margins of documents that the model had not seen (cross-fitting within the sample).

Only a sample of labelled rows is learned from, ``SAMPLE`` at most; the counts of its indicators are summed by Spark, and the driver holds the
ratios (``BUCKETS`` at most) and the ``KEPT`` indicators per sampled document that the model weighs. Every document is scored, whole, where it lies.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm import bytetext as B
from sluice.llm.shared import columns, workdir, written

SAMPLE = 8_000  # labelled documents at most that are learned from
BUCKETS = 1 << 18  # hash buckets of indicators
KEPT = 1 << 14  # buckets at most that the model weighs: those whose ratio differs from 0 most surely
LEAST = 3  # sampled documents that have to hold a bucket
WORDS, SHAPES = 2, 3  # longest n-grams of the two streams
COST = 0.5  # bound of a dual variable
EPOCHS = 12
FOLDS = 3
BLOCK = 1 << 20

_CLASS = np.arange(256, dtype=np.uint8)  # shapes: x lower case and other scripts, X capitals, 9 digits, the rest as it is
_CLASS[0x41:0x5B] = ord("X")
_CLASS[0x61:0x7B] = ord("x")
_CLASS[0x80:] = ord("x")
_CLASS[0x30:0x3A] = ord("9")
_DRAWN = np.zeros(256, bool)
_DRAWN[[ord("X"), ord("x"), ord("9")]] = True
_AGAIN, _LINE, _LINE_AGAIN, _SHAPE = (B.U64(0x9AE16A3B2F90404F), B.U64(0xC949D7C7509E6557), B.U64(0xFF51AFD7ED558CCD), B.U64(0x8CB92BA72F3D8DD7))


def shapes_of(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the shapes of words given as byte ranges."""
    kind = _CLASS[data]
    keep = np.ones(len(data), bool)
    keep[1:] = ~(_DRAWN[kind[1:]] & (kind[1:] == kind[:-1]))
    keep[starts] = True
    before = np.concatenate([[0], np.cumsum(keep)])
    return B.range_hashes(kind[keep], before[starts], before[ends])


def _equal_before(keys: np.ndarray) -> np.ndarray:
    """Which of the keys occurred earlier."""
    first = np.ones(len(keys), bool)
    first[np.unique(keys, return_index=True)[1]] = False
    return first


def text_buckets(data: np.ndarray, bounds: np.ndarray) -> list[np.ndarray]:
    """The distinct indicator buckets of every text of a block, sorted."""
    folded = B.LOWER[data]
    starts, ends, first = B.word_spans(folded, bounds)
    word = B.range_hashes(folded, starts, ends)
    shape = B.mix(shapes_of(data, starts, ends) ^ _SHAPE)
    again = np.zeros(len(word), bool)
    again[1:] = word[1:] == word[:-1]
    breaks = np.flatnonzero(data == 0x0A)
    sums = B.running_sums(data)
    at_break = np.searchsorted(breaks, bounds)
    out = []
    for i in range(len(bounds) - 1):
        lo, hi = first[i], first[i + 1]
        own_again = again[lo:hi].copy()
        own_again[:1] = False
        stream = np.where(own_again, shape[lo:hi] ^ _AGAIN, shape[lo:hi])
        own_breaks = breaks[at_break[i]: at_break[i + 1]]
        if len(own_breaks):
            line_starts = np.concatenate([[bounds[i]], own_breaks[:-1] + 1])
            full = np.searchsorted(starts[lo:hi], own_breaks) > np.searchsorted(starts[lo:hi], line_starts)
            own_breaks, line_starts = own_breaks[full], line_starts[full]
            lines = B.range_hashes(data, line_starts, own_breaks, sums)
            stream = np.insert(stream, np.searchsorted(starts[lo:hi], own_breaks), np.where(_equal_before(lines), _LINE_AGAIN, _LINE))
        grams = [_grams(word[lo:hi], n) for n in range(1, WORDS + 1)] + [_grams(stream, n) for n in range(1, SHAPES + 1)]
        out.append(np.unique((np.concatenate(grams) & B.U64(BUCKETS - 1)).astype(np.int64)))
    return out


def _grams(tokens: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the runs of exactly ``n`` tokens; none of fewer."""
    return B.shingles(tokens, n) if len(tokens) >= n else np.zeros(0, B.U64)


def buckets_of(column: pa.Array) -> Iterator[np.ndarray]:
    for _, _, data, bounds in B.text_chunks(column, BLOCK):
        yield from text_buckets(data, bounds)


def log_count_ratios(pos: np.ndarray, neg: np.ndarray) -> np.ndarray:
    """Smoothed log of the share that each bucket has of all indicators of good documents over that of bad ones."""
    p, q = pos + 1.0, neg + 1.0
    return np.log(p / p.sum()) - np.log(q / q.sum())


def surest(pos: np.ndarray, neg: np.ndarray, n_pos: int, n_neg: int) -> np.ndarray:
    """Buckets that enough documents hold, those whose document frequencies differ most surely between the labels; ``KEPT`` at most, sorted."""
    held = pos + neg
    odds = np.log((pos + 0.5) / (n_pos + 1)) - np.log((neg + 0.5) / (n_neg + 1))
    sure = np.abs(odds) / np.sqrt(1 / (pos + 0.5) + 1 / (neg + 0.5))
    some = np.flatnonzero((held >= LEAST) & (sure > 1))
    return np.sort(some[np.lexsort((some, -sure[some]))][:KEPT])


def dual_descent(rows: list[np.ndarray], values: list[np.ndarray], y: np.ndarray, size: int, cost: np.ndarray, epochs: int = EPOCHS) -> np.ndarray:
    """Weights (the last one a bias) of ``min |w|^2 / 2 + sum cost * hinge``: each step solves one dual variable exactly.

    Rows are visited in a keyed order that changes with the epoch. It ends early once no variable's projected gradient is over 0.01.
    """
    w, alpha = np.zeros(size + 1), np.zeros(len(rows))
    q = np.array([float(v @ v) + 1.0 for v in values])
    for epoch in range(epochs):
        worst = 0.0
        for i in np.random.RandomState(epoch).permutation(len(rows)).tolist():
            at, v, sign = rows[i], values[i], y[i]
            slope = sign * (w[at] @ v + w[-1]) - 1.0
            projected = min(slope, 0.0) if alpha[i] <= 0 else max(slope, 0.0) if alpha[i] >= cost[i] else slope
            if projected:
                worst = max(worst, abs(projected))
                new = min(max(alpha[i] - slope / q[i], 0.0), cost[i])
                step, alpha[i] = (new - alpha[i]) * sign, new
                w[at] += step * v
                w[-1] += step
        if worst < 0.01:
            break
    return w


def logistic_curve(margins: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """``(slope, shift)`` of the probability ``1 / (1 + exp(-(slope * margin + shift)))``, by damped Newton steps on softened targets."""
    n1, n0 = good.sum(), len(good) - good.sum()
    target = np.where(good == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.stack([margins, np.ones(len(margins))], axis=1)
    a = np.array([1.0, 0.0])
    loss = lambda c: float(np.logaddexp(0, x @ c).sum() - target @ (x @ c))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ a, -40, 40)))
        grad, curve = x.T @ (p - target), (x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        step, size = np.linalg.solve(curve, grad), 1.0
        while size > 1e-6 and loss(a - size * step) > loss(a):
            size /= 2
        a = a - size * step
        if np.abs(size * step).max() < 1e-8:
            break
    return float(max(a[0], 1e-3)), float(a[1])


class Model:
    """The buckets weighed, their ratios times weights, and the curve of the margins."""

    def __init__(self, kept: np.ndarray, ratios: np.ndarray):
        self.place = np.full(BUCKETS, -1, np.int32)
        self.place[kept] = np.arange(len(kept))
        self.ratios, self.weights = ratios, np.zeros(len(kept) + 1)
        self.curve = (1.0, 0.0)

    def vector(self, buckets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places and values of a document's vector, of unit length."""
        at = self.place[buckets]
        return self._scaled(at[at >= 0])

    def _scaled(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        value = self.ratios[at]
        size = np.sqrt(value @ value)
        return at, value / size if size else value

    def train(self, vectors: list[np.ndarray], good: np.ndarray) -> None:
        """``vectors`` are the places that the sampled documents hold. Both labels weigh the same in total where one is much rarer (up to 3 times)."""
        rows, values = zip(*[self._scaled(v) for v in vectors], strict=True)
        y = np.where(good == 1, 1.0, -1.0)
        rare = min(good.sum(), len(good) - good.sum()) / max(len(good), 1)
        cost = np.where((good == 1) == (good.mean() < 0.5), COST * min(3.0, 0.5 / max(rare, 1e-9)), COST)
        fit = lambda some: dual_descent([rows[i] for i in some], [values[i] for i in some], y[some], len(self.ratios), cost[some])
        margin = lambda w, some: np.array([w[rows[i]] @ values[i] + w[-1] for i in some])
        margins = np.zeros(len(y))
        for k in range(FOLDS):
            inside, outside = np.flatnonzero(np.arange(len(y)) % FOLDS != k), np.flatnonzero(np.arange(len(y)) % FOLDS == k)
            if len(outside):
                margins[outside] = margin(fit(inside), outside)
        self.weights, self.curve = fit(np.arange(len(y))), logistic_curve(margins, good)

    def score(self, buckets: np.ndarray) -> float:
        at, value = self.vector(buckets)
        z = self.curve[0] * (self.weights[at] @ value + self.weights[-1]) + self.curve[1]
        return float(1 / (1 + np.exp(-np.clip(z, -40, 40))))


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null for rows without id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def learn(sample: DataFrame) -> Model | None:
    """The model of a written sample ``(good, text)``; none without rows of both labels."""
    totals = {int(r["good"]): r["n"] for r in sample.groupBy("good").agg(F.count(F.lit(1)).alias("n")).collect()}
    if min(totals.get(0, 0), totals.get(1, 0)) == 0:
        return None

    def count(batches):
        total = np.zeros((2, BUCKETS), np.int64)
        for batch in batches:
            for good, held in zip(batch.column("good").to_pylist(), buckets_of(batch.column("text")), strict=True):
                total[good, held] += 1
        some = np.flatnonzero(total.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[1, some]), pa.array(total[0, some])], names=["bucket", "pos", "neg"])

    counted = (sample.mapInArrow(count, "bucket long, pos long, neg long").groupBy("bucket").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
               .filter(F.col("pos") + F.col("neg") >= LEAST).toPandas())
    pos, neg = np.zeros(BUCKETS), np.zeros(BUCKETS)
    pos[counted["bucket"]], neg[counted["bucket"]] = counted["pos"], counted["neg"]
    kept = surest(pos, neg, totals[1], totals[0])
    model = Model(kept, log_count_ratios(pos, neg)[kept])
    place = sample.sparkSession.sparkContext.broadcast(model.place)

    def vectors(batches):
        for batch in batches:
            at = [place.value[held] for held in buckets_of(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("good"), pa.array([a[a >= 0].astype(np.uint16).tobytes() for a in at], pa.binary())],
                                             names=["key", "good", "at"])

    held = sample.mapInArrow(vectors, "key long, good int, at binary").toPandas().sort_values(["key", "good", "at"])
    model.train([np.frombuffer(a, np.uint16).astype(np.int64) for a in held["at"]], held["good"].to_numpy(np.int64))
    return model


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", folds: int = 3,
                   held_fold: int = 1) -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted``.

    Labels are read only for rows outside ``held_fold``; a document with contradicting labels counts as bad. ``SAMPLE`` labelled ids at most, by the hash of the id, are learned from;
    of rows that repeat a sampled id the one whose text has the least hash. Scores come from the text alone: null and empty texts get that of a text without words.
    Without labels of both kinds every score is 0.5. Rows that repeat an id each get their score, rows without id too (they
    are in no fold and count as held out); an empty table gives none. Other columns are ignored.
    """
    spark = docs.sparkSession
    base = workdir(spark, "nb-svm")
    rows = columns(docs, doc_id=id_col, text=text_col)
    gold = (columns(labels, doc_id=id_col, good=label_col).filter(F.col("good").isNotNull() & F.col("doc_id").isNotNull())
            .filter(fold(F.col("doc_id"), folds) != held_fold).groupBy("doc_id").agg(F.min(F.col("good").cast("int")).alias("good"))
            .orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE))
    # SAMPLE ids at most: a broadcast of proven size. One row an id, combined before it is sent.
    picked = F.min(F.struct(F.xxhash64("text").alias("h"), F.col("text"))).alias("picked")
    sample = rows.join(F.broadcast(gold), "doc_id").groupBy("doc_id", "good").agg(picked)
    sample = written(sample.select(F.xxhash64("doc_id").alias("key"), "good", F.col("picked.text").alias("text")), base, "sample")
    learned = spark.sparkContext.broadcast(learn(sample))

    def score(batches):
        model = learned.value
        for batch in batches:
            scores = [model.score(held) if model else 0.5 for held in buckets_of(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(scores, pa.float64())], names=["doc_id", "held_out", "score"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    held_out = F.coalesce(fold(F.col("doc_id"), folds) == held_fold, F.lit(True))
    scored = rows.select("doc_id", held_out.alias("held_out"), "text").mapInArrow(score, f"doc_id {kind}, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
