"""Toxicity by weak supervision: many voters, a generative label model, a linear classifier on its posteriors.

Voters are lexicons and patterns; further lexicons are drawn from words whose document frequency differs most between the labels of a
bounded sample of labelled rows (words, and their beginnings of four to eight bytes, which meet inflected forms). The votes of all training documents are counted per combination (16 voters, so at most 65,536
rows reach the driver), and a generative model with two classes is fitted to those counts by expectation-maximisation: each
voter's accuracy per class, and the correlations of voters within a class, which temper the votes of those that say the same. Its
posteriors are the labels on which a logistic regression over terms and votes is trained, which scores every document.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm import bytetext as B
from sluice.llm.shared import columns, workdir

SAMPLE = 8_000  # labelled rows at most that the drawn lexicons and the classifier are fitted on
TERMS = 20_000  # terms at most that the classifier weighs
PREFIXES = (4, 5, 6, 7, 8)
DRAWN = 8
DRAWN_WORDS = 256
GOLD = 0.97  # accuracy given to a label itself
STEPS = 300
PENALTY = 2e-5

# Words of the lexicon voters.
LEXICONS = {
    "insults": "idiot idiots moron morons stupid fool fools imbecile loser losers clown clowns dumb dumbass jerk creep cretin halfwit",
    "contempt": "pathetic worthless disgusting trash scum garbage filth vermin parasite parasites useless vile repulsive degenerate",
    "hostility": "hate kill die hurt destroy shut ugly freak freaks nasty damn hell crap bastard bastards bitch asshole shit fuck fucking",
    "other_languages": "dumm dummkopf abschaum widerlich trottel arschloch imbécile connard ordure minable stupide idiota estúpido basura asqueroso inútil",
}
PATTERNS = ("shouting", "exclaiming", "symbols", "short")
N_VOTERS = len(LEXICONS) + DRAWN + len(PATTERNS)


def terms_of(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(terms, doc, first)``: hashes of all words and word beginnings with their documents; words before each document."""
    folded = B.LOWER[data]
    starts, ends, first = B.word_spans(folded, bounds, B.NON_LETTERS)
    sums = B.running_sums(folded)
    doc = np.repeat(np.arange(len(bounds) - 1), np.diff(first))
    terms, docs = [B.range_hashes(folded, starts, ends, sums)], [doc]
    for size in PREFIXES:
        longer = ends - starts > size
        # A beginning is another term than the word that it spells.
        terms.append(B.mix(B.range_hashes(folded, starts[longer], starts[longer] + size, sums) ^ B.U64(0xA54FF53A5F1D36F1)))
        docs.append(doc[longer])
    return np.concatenate(terms), np.concatenate(docs), first


class Table:
    """Finds the few terms that matter among very many: a bit table first, then a search."""

    BITS = 20

    def __init__(self, terms: np.ndarray):
        self.terms = np.sort(terms)
        self.some = np.zeros(1 << self.BITS, bool)
        self.some[(self.terms & B.U64((1 << self.BITS) - 1)).astype(np.int64)] = True

    def find(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(which, at)``: positions in ``terms`` of those in the table, and their places there."""
        which = np.flatnonzero(self.some[(terms & B.U64((1 << self.BITS) - 1)).astype(np.int64)])
        if not len(which):
            return which, which
        at = np.minimum(np.searchsorted(self.terms, terms[which]), len(self.terms) - 1)
        same = self.terms[at] == terms[which]
        return which[same], at[same]


def fixed_lexicons() -> list[np.ndarray]:
    out = []
    for text in LEXICONS.values():
        data = B.LOWER[np.frombuffer(text.encode(), np.uint8)]
        out.append(B.word_hashes(data, np.array([0, len(data)]), B.NON_LETTERS)[0])
    return out


class Voters:
    """The votes of whole texts as bits: lexicons first, then patterns."""

    def __init__(self, lexicons: list[np.ndarray]):
        bits: dict[int, int] = {}
        for i, lexicon in enumerate(lexicons):
            for h in lexicon.tolist():
                bits[h] = bits.get(h, 0) | 1 << i
        self.table = Table(np.array(list(bits), B.U64))
        self.bits = np.array([bits[h] for h in self.table.terms.tolist()], np.int64)
        self.first_pattern = len(LEXICONS) + DRAWN

    def votes(self, data: np.ndarray, bounds: np.ndarray, terms: np.ndarray, doc: np.ndarray, first: np.ndarray) -> np.ndarray:
        out = np.zeros(len(bounds) - 1, np.int64)
        which, at = self.table.find(terms)
        if len(which):
            np.bitwise_or.at(out, doc[which], self.bits[at])
        share = lambda flags: (lambda c: (c[bounds[1:]] - c[bounds[:-1]]) / np.maximum(np.diff(bounds), 1))(np.concatenate([[0], np.cumsum(flags)]))
        capitals = share((data >= 0x41) & (data <= 0x5A))
        marks = (capitals > 0.4, share(data == 0x21) > 0.02, share(np.isin(data, list(b"#*$%&@"))) > 0.05, np.diff(first) < 20)
        for i, fires in enumerate(marks):
            out |= fires.astype(np.int64) << (self.first_pattern + i)
        return out


def frequent_terms(docs: list[np.ndarray], toxic: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(terms, toxic documents, all documents)`` of the terms that five documents of the sample or more hold."""
    terms, all_ = np.unique(np.concatenate(docs), return_counts=True)
    terms, all_ = terms[all_ >= 5], all_[all_ >= 5]
    bad = [d for d, t in zip(docs, toxic, strict=True) if t]
    held, counts = np.unique(np.concatenate(bad), return_counts=True)
    at = np.searchsorted(terms, held)
    at[at == len(terms)] = 0
    known = terms[at] == held if len(terms) else np.zeros(len(held), bool)
    pos = np.zeros(len(terms), np.int64)
    pos[at[known]] = counts[known]
    return terms, pos, all_


def drawn_lexicons(found: tuple, toxic: np.ndarray) -> list[np.ndarray]:
    """Terms whose document frequency speaks most for the label, dealt in turn to DRAWN lexicons."""
    terms, pos, all_ = found
    n1, n0 = toxic.sum(), len(toxic) - toxic.sum()
    odds = np.log((pos + 0.5) / (n1 + 1)) - np.log((all_ - pos + 0.5) / (n0 + 1))
    # A term has to be frequent enough that its odds aren't chance: three standard errors above 1.
    error = np.sqrt(1 / (pos + 0.5) + 1 / (all_ - pos + 0.5))
    sure = np.flatnonzero((odds - 1 > 3 * error) & (pos >= 5))
    best = terms[sure[np.lexsort((terms[sure], -pos[sure]))][:DRAWN_WORDS]]
    return [best[i::DRAWN] for i in range(DRAWN)]


class LabelModel:
    """Two classes, voters that fire or not; expectation-maximisation on counted vote combinations."""

    def __init__(self, masks: np.ndarray, counts: np.ndarray, known: np.ndarray, known_counts: np.ndarray):
        """``counts`` of unlabelled ``masks``; ``known_counts`` (two columns) of labelled masks ``known``."""
        x = lambda m: ((m[:, None] >> np.arange(N_VOTERS)) & 1).astype(float)
        xu, xk = x(masks), x(known)
        n_known = known_counts.sum(0)
        self.prior = float(np.clip((n_known[1] + 1) / (n_known.sum() + 2), 0.005, 0.5)) if n_known.sum() else 0.1
        start = np.full((2, N_VOTERS), 0.02)
        start[1] = 0.3
        if n_known.min() > 0:
            start = np.stack([(known_counts[:, c] @ xk + 0.5) / (n_known[c] + 1) for c in (0, 1)])
        self.fires, self.temper = np.clip(start, 1e-4, 1 - 1e-4), np.ones(N_VOTERS)
        self.correlations = np.zeros((N_VOTERS, N_VOTERS))
        for _ in range(2):
            for _ in range(50):
                p = self.posterior(masks)
                weight = [np.concatenate([counts * (p if c else 1 - p), known_counts[:, c]]) for c in (0, 1)]
                both = np.concatenate([xu, xk])
                total = [w.sum() for w in weight]
                self.fires = np.stack([np.clip((weight[c] @ both + 0.1) / (total[c] + 0.2), 1e-5, 1 - 1e-5) for c in (0, 1)])
                self.prior = float(np.clip((total[1] + 0.1) / (sum(total) + 0.2), 1e-3, 0.5))
            # Correlations within the classes: what voters have in common beyond the class.
            rho = np.zeros((N_VOTERS, N_VOTERS))
            for c in (0, 1):
                z = (both - self.fires[c]) / np.sqrt(self.fires[c] * (1 - self.fires[c]))
                rho += (z * weight[c][:, None]).T @ z / max(sum(total), 1)
            self.correlations = np.clip(rho - np.diag(np.diag(rho)), 0, 1)
            self.temper = 1 / (1 + self.correlations.sum(1))

    def posterior(self, masks: np.ndarray) -> np.ndarray:
        x = ((masks[:, None] >> np.arange(N_VOTERS)) & 1).astype(float)
        on = np.log(self.fires[1] / self.fires[0]) * self.temper
        off = np.log((1 - self.fires[1]) / (1 - self.fires[0])) * self.temper
        z = np.log(self.prior / (1 - self.prior)) + x @ on + (1 - x) @ off
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def telling_terms(found: tuple, toxic: np.ndarray) -> np.ndarray:
    """Terms of the sample whose document frequencies differ surely between the labels; at most TERMS."""
    terms, pos, all_ = found
    odds = np.log((pos + 0.5) / (toxic.sum() + 1)) - np.log((all_ - pos + 0.5) / (len(toxic) - toxic.sum() + 1))
    sure = np.abs(odds) / np.sqrt(1 / (pos + 0.5) + 1 / (all_ - pos + 0.5))
    some = np.flatnonzero(sure > 2.5)
    return terms[some[np.lexsort((terms[some], -sure[some]))][:TERMS]]


class Linear:
    """Logistic regression over the terms present (unit length) and the votes."""

    def __init__(self, terms: np.ndarray):
        self.table = Table(terms)
        self.weights = np.zeros(len(terms) + N_VOTERS + 1)
        self.weights[-1] = -2.0

    def design(self, n: int, terms: np.ndarray, doc: np.ndarray, masks: np.ndarray):
        """Row, column and value of all entries; voters and a constant come after the terms."""
        which, at = self.table.find(terms)
        cells = np.unique(doc[which] * max(len(self.table.terms), 1) + at)
        row, col = cells // max(len(self.table.terms), 1), cells % max(len(self.table.terms), 1)
        sizes = np.bincount(row, minlength=n)
        votes = np.argwhere((masks[:, None] >> np.arange(N_VOTERS)) & 1)
        base = len(self.table.terms)
        return (np.concatenate([row, votes[:, 0], np.arange(n)]), np.concatenate([col, base + votes[:, 1], np.full(n, base + N_VOTERS)]),
                np.concatenate([1 / np.sqrt(sizes[row]), np.ones(len(votes)), np.ones(n)]))

    def score(self, n: int, terms: np.ndarray, doc: np.ndarray, masks: np.ndarray) -> np.ndarray:
        row, col, val = self.design(n, terms, doc, masks)
        return 1 / (1 + np.exp(-np.clip(np.bincount(row, weights=self.weights[col] * val, minlength=n), -40, 40)))

    def train(self, docs: list[np.ndarray], masks: np.ndarray, target: np.ndarray) -> None:
        """Adaptive gradient steps over the whole sample on soft labels, squared penalty."""
        n = len(docs)
        row, col, val = self.design(n, np.concatenate(docs), np.repeat(np.arange(n), [len(d) for d in docs]), masks)
        seen = np.full_like(self.weights, 1e-8)
        for _ in range(STEPS):
            z = np.bincount(row, weights=self.weights[col] * val, minlength=n)
            slope = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - target) / n
            grad = np.bincount(col, weights=slope[row] * val, minlength=len(self.weights)) + PENALTY * self.weights
            seen += grad ** 2
            self.weights -= 0.3 * grad / np.sqrt(seen)


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; rows without id are in fold 0, which is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds, F.lit(0))


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", folds: int = 5) -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted``.

    Labels are read only for rows outside fold 0; a document with contradicting labels counts as toxic. Scores come from the text alone.
    Null and empty texts get the score of a text without words. Without any labels, or labels of one kind, the fixed
    voters decide. Rows that repeat an id each get their score; an empty table gives none.
    """
    sc = docs.sparkSession.sparkContext
    workdir(docs.sparkSession, "toxicity")
    rows = columns(docs, doc_id=id_col, text=text_col)
    gold = (columns(labels, doc_id=id_col, toxic=label_col).filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
            .filter(fold(F.col("doc_id"), folds) != 0).groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
            .orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE))

    def features(batches):
        """Distinct terms and votes of the fixed voters."""
        fixed = Voters(fixed_lexicons())
        for batch in batches:
            terms_out, masks = [], []
            for lo, hi, data, bounds in B.text_chunks(batch.column("text")):
                terms, doc, first = terms_of(data, bounds)
                masks.append(fixed.votes(data, bounds, terms, doc, first))
                order = np.argsort(doc, kind="stable")
                ends = np.searchsorted(doc[order], np.arange(hi - lo + 1))
                terms_out += [np.unique(terms[order[ends[i]: ends[i + 1]]]).tobytes() for i in range(hi - lo)]
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(np.concatenate(masks) if masks else [], pa.int64()),
                                              pa.array(terms_out, pa.binary())], names=["toxic", "mask", "terms"])

    # At most SAMPLE ids: a broadcast of proven size, so no text is shuffled.
    # An id may be that of many rows, so rows are bounded too: the SAMPLE least hashes of id and text, equal rows once.
    labelled = rows.join(F.broadcast(gold), "doc_id").select("toxic", "text", F.xxhash64("doc_id", "text").alias("row"))
    last = labelled.select("row").distinct().orderBy("row").limit(SAMPLE).agg(F.max("row")).first()[0]
    drawn_rows = labelled.filter(F.col("row") <= F.lit(last)).groupBy("row").agg(F.first("toxic").alias("toxic"), F.first("text").alias("text"))
    sample = drawn_rows.orderBy("row").select("toxic", "text").mapInArrow(features, "toxic int, mask long, terms binary").toPandas()
    held = [np.frombuffer(w, B.U64) for w in sample["terms"]]
    toxic = sample["toxic"].to_numpy(np.int64)
    none = np.zeros(0, np.int64)
    found = frequent_terms(held, toxic) if len(held) and toxic.any() and not toxic.all() else (np.zeros(0, B.U64), none, none)
    drawn = drawn_lexicons(found, toxic)
    masks = sample["mask"].to_numpy(np.int64).copy()
    for i, lexicon in enumerate(drawn):
        if len(lexicon):
            fires = np.array([np.isin(lexicon, w, assume_unique=True).any() for w in held], bool)
            masks |= fires.astype(np.int64) << (len(LEXICONS) + i)
    lexicons = sc.broadcast(fixed_lexicons() + drawn)

    def vote(batches):
        voters = Voters(lexicons.value)
        for batch in batches:
            masks = [voters.votes(data, bounds, *terms_of(data, bounds)) for _, _, data, bounds in B.text_chunks(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(masks) if masks else [], pa.int64())], names=["mask"])

    counted = (rows.filter(fold(F.col("doc_id"), folds) != 0).select("text").mapInArrow(vote, "mask long")
               .groupBy("mask").agg(F.count(F.lit(1)).alias("n")).toPandas())
    known, at = np.unique(masks, return_inverse=True)
    known_counts = np.stack([np.bincount(at, weights=toxic == c, minlength=len(known)) for c in (0, 1)], axis=1)
    model = LabelModel(counted["mask"].to_numpy(np.int64), counted["n"].to_numpy(float), known, known_counts)
    p = model.posterior(masks)
    said = np.where(toxic == 1, GOLD, 1 - GOLD)
    target = p * said / (p * said + (1 - p) * (1 - said))
    linear = Linear(telling_terms(found, toxic))
    if len(held):
        linear.train(held, masks, target)
    else:  # without labels the label model's own log-odds are the linear classifier
        on, off = (np.log(q[1] / q[0]) * model.temper for q in (model.fires, 1 - model.fires))
        linear.weights[:-1], linear.weights[-1] = on - off, np.log(model.prior / (1 - model.prior)) + off.sum()
    learned = sc.broadcast((linear.table.terms, linear.weights))

    def score(batches):
        voters, classifier = Voters(lexicons.value), Linear(learned.value[0])
        classifier.weights = learned.value[1]
        for batch in batches:
            out = []
            for lo, hi, data, bounds in B.text_chunks(batch.column("text")):
                terms, doc, first = terms_of(data, bounds)
                out.append(classifier.score(hi - lo, terms, doc, voters.votes(data, bounds, terms, doc, first)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(np.concatenate(out) if out else [], pa.float64())],
                                             names=["doc_id", "held_out", "score"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    scored = rows.select("doc_id", (fold(F.col("doc_id"), folds) == 0).alias("held_out"), "text").mapInArrow(
        score, f"doc_id {kind}, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
