"""Quality rules: robust multivariate outliers by minimum-covariance-determinant estimates per language and source.

Every whole text becomes a vector of six transformed statistics. For each (language, source) the minimum covariance
determinant is found by concentration steps: distances under the present estimate, the half of the rows with the
least distances, mean and covariance of those. Four starts (medians, shortest halves, lower and upper quartiles) take STEPS steps
each; the one with the least determinant goes on until its determinant no longer falls. A step is one grouped aggregation over all rows:
rows are counted and their moments summed per start and distance bin, so a hot source is combined before the shuffle and no group is
ever gathered. The last bin of a subset enters with the weight that fills the half exactly, so it doesn't matter how rows
are partitioned, and equal copies don't all come in at once. A last step reweights by the 97.5 % bound, and rows beyond ``cutoff`` of the
chi-squared law are rejected.
"""
from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm import bytetext as B
from sluice.llm.shared import columns, trimmed, workdir, written

FEATURES = ("word_length", "symbols", "capitals", "punctuation", "dup_lines", "repeats")
#: Least standard deviation of each feature: what a clean text may differ by where its group hardly varies.
FLOORS = (0.08, 0.30, 0.30, 0.20, 0.80, 0.80)
SUBSET = 0.5
STEPS = 5  # of every start, before only the best goes on
FALL = 1e-6  # in the logarithm of the determinant: less is no fall
MIN_ROWS = 50
TEXT_BYTES = 1 << 18  # of texts measured at a time; their hashes take some 50 times as much
CUTOFF = 1 - 1e-7
REWEIGHT = 0.975
_HALF = 64  # histogram steps per unit for the starting medians
_OCTAVE = 8  # distance bins per doubling
_SYMBOLS = np.isin(np.arange(256), list(b"#*$%&|<>"))
_PUNCT = np.isin(np.arange(256), list(b"!\"'(),-./:;?@[\\]^_`{}~+="))
_CAPITAL = np.isin(np.arange(256), np.arange(0x41, 0x5B))
_BREAKS = np.arange(256) == 0x0A
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals", "n_punct")


def _per_doc(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


def repeated_words(words: np.ndarray, width: int = 8) -> int:
    """Words covered by windows of ``width`` words that occur twice or more in the text."""
    if len(words) <= width:
        return 0
    h = B.shingles(words, width)
    _, at, counts = np.unique(h, return_inverse=True, return_counts=True)
    again = counts[at] > 1
    if not again.any():
        return 0
    change = np.zeros(len(words) + 1, np.int64)
    change[:-1][: len(h)] += again
    np.subtract.at(change, np.flatnonzero(again) + width, 1)
    return int((np.cumsum(change[:-1]) > 0).sum())


def text_statistics(docs: DataFrame) -> DataFrame:
    """``docs`` with the counts STATS of its ``text`` column in its place (null: an empty text)."""
    keep = [f for f in docs.schema.fields if f.name != "text"]

    def run(batches):
        for batch in trimmed(batches):
            out: dict[str, list[np.ndarray]] = {s: [] for s in STATS}
            for _, _, data, bounds in B.text_chunks(batch.column("text"), TEXT_BYTES):
                starts, ends, first = B.word_spans(data, bounds)
                hashes = B.range_hashes(data, starts, ends)
                line_from, line_to, line_first = B.word_spans(data, bounds, _BREAKS)
                wordy = np.searchsorted(starts, line_to) > np.searchsorted(starts, line_from)
                lines = B.range_hashes(data, line_from, line_to)
                n = len(bounds) - 1
                dups, repeats, n_lines = (np.zeros(n, np.int64) for _ in range(3))
                for i in range(n):
                    own = lines[line_first[i]: line_first[i + 1]][wordy[line_first[i]: line_first[i + 1]]]
                    n_lines[i] = len(own)
                    if len(own) > 1:
                        dups[i] = len(own) - len(np.unique(own))
                    repeats[i] = repeated_words(hashes[first[i]: first[i + 1]])
                found = (np.diff(first), _per_doc(~B.SPACES[data] & ((data & 0xC0) != 0x80), bounds), _per_doc(_SYMBOLS[data], bounds),
                         dups, repeats, n_lines, _per_doc(_CAPITAL[data], bounds), _per_doc(_PUNCT[data], bounds))
                for s, values in zip(STATS, found, strict=True):
                    out[s].append(values)
            yield pa.RecordBatch.from_arrays(
                [batch.column(f.name) for f in keep] + [pa.array(np.concatenate(out[s]) if out[s] else [], pa.int64()) for s in STATS],
                names=[f.name for f in keep] + list(STATS))

    from pyspark.sql.types import LongType, StructField, StructType

    return docs.mapInArrow(run, StructType(keep + [StructField(s, LongType()) for s in STATS]))


def _vector() -> list[Column]:
    share = lambda n, of: F.log1p(F.col(n) * 100.0 / F.greatest(F.col(of), F.lit(1)))
    return [F.log(F.greatest(F.col("word_chars"), F.lit(1)) / F.greatest(F.col("n_words"), F.lit(1))),
            share("n_symbols", "word_chars"), share("n_capitals", "word_chars"), share("n_punct", "word_chars"),
            share("n_dup_lines", "n_lines"), share("n_repeat_words", "n_words")]


def chi2_cdf(x: float, d: int) -> float:
    """Distribution of chi-squared with an even number ``d`` of degrees of freedom."""
    half, term, total = x / 2, 1.0, 1.0
    for i in range(1, d // 2):
        term *= half / i
        total += term
    return 1 - math.exp(-half) * total


def chi2_quantile(p: float, d: int) -> float:
    lo, hi = 0.0, 1000.0
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if chi2_cdf(mid, d) < p else (lo, mid)
    return (lo + hi) / 2


def consistency(share: float, d: int) -> float:
    """What the covariance of the ``share`` of a normal sample nearest to its centre has to be multiplied by."""
    return 1.0 if share >= 1 else share / chi2_cdf(chi2_quantile(share, d), d + 2)


_FIT = "g string, start int, mu array<double>, prec array<double>, det double, fell boolean"


def _starts(vectors: DataFrame) -> DataFrame:
    """Per group four centres with their spreads, from exact histograms of the features."""
    floors = np.array(FLOORS)

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        mu, var = np.zeros((4, len(floors))), np.ones((4, len(floors)))
        for i, one in pdf.groupby("feature"):
            one = one.sort_values("bin")
            values, counts = (one["bin"].to_numpy() + 0.5) / _HALF, one["count"].to_numpy()
            at = lambda v, share: v[np.argsort(v, kind="stable")][np.searchsorted(np.cumsum(counts[np.argsort(v, kind="stable")]), counts.sum() * share)]  # noqa: B023, E731
            upto = np.cumsum(counts)
            ends = np.searchsorted(upto, upto - counts + counts.sum() / 2)
            fits = np.flatnonzero(ends < len(values))
            low = fits[np.argmin(values[ends[fits]] - values[fits])]
            short = (values[low], values[ends[low]])
            mu[:, i] = at(values, 0.5), sum(short) / 2, at(values, 0.25), at(values, 0.75)
            var[:, i] = (1.4826 * at(np.abs(values - mu[0, i]), 0.5)) ** 2 + floors[i] ** 2
            var[1, i] = (1.4826 * (short[1] - short[0]) / 2) ** 2 + floors[i] ** 2
        return pd.DataFrame({"g": pdf["g"].iloc[0], "start": range(4), "mu": mu.tolist(), "prec": [np.diag(1 / v).ravel().tolist() for v in var],
                             "det": np.inf, "fell": True})

    bins = F.posexplode(F.transform("x", lambda v: F.floor(v * _HALF)))
    return vectors.select("g", bins.alias("feature", "bin")).groupBy("g", "feature", "bin").count().groupBy("g").applyInPandas(fit, _FIT)


def _with_distance(vectors: DataFrame, fits: DataFrame) -> DataFrame:
    d = range(len(FEATURES))
    z = vectors.join(fits, "g").withColumn("z", F.zip_with("x", "mu", lambda a, b: a - b))
    d2 = sum((F.col("z")[i] * F.col("z")[j] * F.col("prec")[i * len(d) + j] for i in d for j in d), F.lit(0.0))
    return z.withColumn("d2", F.greatest(d2, F.lit(0.0)))


def _concentrated(vectors: DataFrame, fits: DataFrame, last: bool) -> DataFrame:
    """The next estimate of every group and start: moments per distance bin, then the least bins that hold the subset.

    Where the determinant does not fall the estimate stays, with ``fell`` false; the last step reweights.
    """
    k, floors = len(FEATURES), np.array(FLOORS)
    upper = chi2_quantile(REWEIGHT, k)
    pairs = [(i, j) for i in range(k) for j in range(i, k)]

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("bin")
        counts = pdf["n"].to_numpy()
        n = counts.sum() if last else math.ceil(SUBSET * counts.sum())
        share = REWEIGHT if last else n / counts.sum()
        use = np.clip((n - np.cumsum(counts) + counts) / counts, 0, 1)
        mean = np.array([(pdf[f"s{i}"].to_numpy() * use).sum() / n for i in range(k)])
        cov = np.zeros((k, k))
        for i, j in pairs:
            cov[i, j] = cov[j, i] = (pdf[f"s{i}_{j}"].to_numpy() * use).sum() / n - mean[i] * mean[j]
        cov = cov * consistency(share, k) + np.diag(floors ** 2)
        old, det = pdf.iloc[0], np.linalg.slogdet(cov)[1]
        fell = last or det < old["det"] - FALL
        mu, prec = (np.array(old["mu"]) + mean, np.linalg.inv(cov).ravel()) if fell else (np.array(old["mu"]), np.array(old["prec"]))
        return pd.DataFrame({"g": [old["g"]], "start": [old["start"]], "mu": [mu.tolist()], "prec": [prec.tolist()],
                             "det": [det if fell else old["det"]], "fell": [fell]})

    rows = _with_distance(vectors, fits)
    if last:
        rows = rows.filter(F.col("d2") <= upper)
    moments = rows.withColumn("bin", F.floor(F.log2(F.col("d2") + 1e-6) * _OCTAVE)).groupBy("g", "start", "bin").agg(
        F.count(F.lit(1)).alias("n"), *[F.min(c).alias(c) for c in ("mu", "prec", "det")], *[F.sum(F.col("z")[i]).alias(f"s{i}") for i in range(k)],
        *[F.sum(F.col("z")[i] * F.col("z")[j]).alias(f"s{i}_{j}") for i, j in pairs])
    return moments.groupBy("g", "start").applyInPandas(fit, _FIT)


def _least(vectors: DataFrame, base: str) -> DataFrame:
    """Per group the estimate with the least determinant, reweighted."""
    best = lambda f: f.groupBy("g").agg(F.min_by(F.struct(*f.columns), F.struct("det", "start")).alias("f")).select("f.*")
    fits, step = written(_starts(vectors), base, "fit-0"), 0
    while fits.filter("fell").limit(1).count():
        step += 1
        fits = _concentrated(vectors, fits.filter("fell"), last=False).unionByName(fits.filter("not fell"))
        fits = written(best(fits) if step == STEPS else fits, base, f"fit-{step}")
    return written(_concentrated(vectors, best(fits), last=True), base, "fit-last")


def _named(docs: DataFrame, text_col: str, lang_col: str, source_col: str) -> tuple[DataFrame, dict[str, str]]:
    """All columns under names that can't clash, with ``text``, ``lang`` and ``source`` beside them."""
    mine = {c: f"_c{i}" for i, c in enumerate(docs.columns)}
    same = {"text": text_col, "lang": lang_col, "source": source_col}
    return docs.select(*[F.col(f"`{c}`").alias(a) for c, a in mine.items()], *[F.col(f"`{c}`").alias(a) for a, c in same.items()]), mine


def _based(rows: DataFrame) -> DataFrame:
    key = lambda *c: F.to_json(F.struct(*c))
    return (rows.withColumn("base_failed", (F.col("n_words") < 20) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 30))
            .withColumn("own", key("lang", "source")).withColumn("pool", key("lang")))


def _fitted(rows: DataFrame, base: str) -> DataFrame:
    """``(own, mu, prec)``: the estimate by which each (language, source) is judged."""
    passed = rows.filter("not base_failed")
    sizes = passed.groupBy("own", "pool").agg(F.count(F.lit(1)).alias("n"))
    pools = sizes.filter(F.col("n") < MIN_ROWS).groupBy("pool").agg(F.sum("n").alias("pooled"))
    groups = (sizes.join(pools, "pool", "left")
              .select("own", F.when(F.col("n") >= MIN_ROWS, F.col("own")).when(F.col("pooled") >= MIN_ROWS, F.col("pool"))
                      .otherwise(F.lit("rest")).alias("g"), "n"))
    groups = written(groups, base, "groups")
    enough = groups.groupBy("g").agg(F.sum("n").alias("n")).filter(F.col("n") >= MIN_ROWS).select("g")
    vectors = written(passed.withColumn("x", F.array(*_vector())).select("own", "x")
                      .join(groups.join(enough, "g").select("own", "g"), "own").select("g", "x"), base, "vectors")
    fits = _least(vectors, base)
    return groups.select("own", "g").join(fits, "g").select("own", "mu", "prec")


def _judged(rows: DataFrame, estimates: DataFrame, cutoff: float) -> DataFrame:
    k = range(len(FEATURES))
    out = rows.join(estimates, "own", "left").withColumn("z", F.zip_with(F.array(*_vector()), "mu", lambda a, b: a - b))
    d2 = sum((F.col("z")[i] * F.col("z")[j] * F.col("prec")[i * len(FEATURES) + j] for i in k for j in k), F.lit(0.0))
    out = out.withColumn("d2", F.when(~F.col("base_failed"), F.greatest(d2, F.lit(0.0))))
    limit = chi2_quantile(cutoff, len(FEATURES))
    return out.withColumn("kept", ~F.col("base_failed") & F.coalesce(F.col("d2") <= limit, F.lit(True)))


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                  source_col: str = "source", cutoff: float = CUTOFF) -> DataFrame:
    """Every row with its counts, ``base_failed``, Mahalanobis distance ``d2`` (null if not estimated) and ``kept``.

    Base rules: fewer than 20 words, or over 30 % of words in repeated 8-word windows, fails. The others are judged
    in their (language, source) group; groups under MIN_ROWS rows are pooled per language, and pools still under it
    in one last group, which is judged when it has MIN_ROWS rows and kept otherwise. Null languages and sources
    are groups of their own; null and empty texts fail. Repeated rows each get their own result. Other columns are ignored.
    """
    base = workdir(docs.sparkSession, "quality")
    rows = text_statistics(columns(docs, doc_id=id_col, text=text_col, lang=lang_col, source=source_col))
    rows = written(_based(rows), base, "counts")
    return _judged(rows, _fitted(rows, base), cutoff).select("doc_id", *STATS[:5], "base_failed", "kept", "d2")


def keep_quality(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", cutoff: float = CUTOFF) -> DataFrame:
    """The rows of ``docs`` that ``quality_rules`` keeps, with all their columns.

    The estimates are fitted on written counts; texts are then judged where they are read, not sent to a join.
    """
    base = workdir(docs.sparkSession, "quality")
    named, mine = _named(docs, text_col, lang_col, source_col)
    counts = written(_based(text_statistics(named.select("text", "lang", "source"))), base, "counts")
    rows = _based(text_statistics(named))
    return _judged(rows, _fitted(counts, base), cutoff).filter("kept").select(*[F.col(a).alias(c) for c, a in mine.items()])
