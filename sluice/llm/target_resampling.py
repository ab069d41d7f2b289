"""Resampling to a target distribution by hashed n-gram importance weights, on Arrow's own kernels.

``ascii_lower`` and ``split_pattern_regex`` make words of a block of texts, ``list_flatten`` one long array of them, and ``dictionary_encode`` numbers the distinct ones. Indices
shifted by one against each other are pairs; pairs are encoded again, and so on up to the longest n-gram. Only distinct n-grams are
hashed: the CRC of a longer one goes on from that of its beginning. Counts per bucket are summed over all documents and over all target texts; a
bucket's gain is the logarithm of the ratio of its shares, ``take`` gives every n-gram its gain, and segment sums give every document its weight.
Gumbel noise keyed by the id turns the highest scores into a sample without replacement.

What reaches the driver is one row per bucket. Ranks are places in a range-partitioned, written table.
"""
from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm import bytetext as B
from sluice.llm.shared import columns, workdir, written

BUCKETS = 10_000
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # fixed value: what lies between words, after A-Z are lower-cased
BLOCK = 1 << 20  # bytes of texts at a time
UNIT = 1000  # gains and noise are whole thousandths


def flat_words(texts: pa.Array) -> tuple[pa.Array, pa.Array, np.ndarray]:
    """``(indices, words, text)``: all words of a block as dictionary indices, the distinct words, and which text each is of."""
    lists = pc.split_pattern_regex(pc.ascii_lower(pc.fill_null(texts, "")), SEPARATORS)
    text = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    coded = pc.dictionary_encode(pc.list_flatten(lists))
    empty = pc.index(coded.dictionary, "").as_py()  # what a split leaves at a text's ends is no word
    if empty >= 0:
        keep = pc.not_equal(coded.indices, pa.scalar(empty, coded.indices.type))
        return coded.indices.filter(keep), coded.dictionary, text[keep.to_numpy(zero_copy_only=False)]
    return coded.indices, coded.dictionary, text


def ngrams(texts: pa.Array, most: int, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For runs of 1, 2, .. ``most`` words: ``(index of every run, bucket of every distinct run, text of every run)``."""
    indices, words, text = flat_words(texts)
    raw = [w.encode() for w in words.to_pylist()]
    word = indices.to_numpy(zero_copy_only=False).astype(np.int64)
    sums = [zlib.crc32(w) for w in raw]
    code, at = word, np.arange(len(word))  # every run and the place of its first word
    for size in range(1, most + 1):
        yield code, np.array(sums, np.int64) % buckets, text[at]
        if size < most:
            # The same indices shifted: each run with the word after it, where that is of the same text.
            inside = at + size < len(word)
            code, at = code[inside], at[inside]
            same = text[at + size] == text[at]
            code, at = code[same], at[same]
            pairs = pc.dictionary_encode(pa.array(code * max(len(raw), 1) + word[at + size]))
            code = pairs.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            sums = [zlib.crc32(b" " + raw[k % len(raw)], sums[k // len(raw)]) for k in pairs.dictionary.to_pylist()]


def blocks(batch: pa.RecordBatch, column: str) -> Iterator[tuple[int, int, pa.Array]]:
    texts = batch.column(column)
    for lo, hi, _, _ in B.text_chunks(texts, BLOCK):
        yield lo, hi, texts.slice(lo, hi - lo)


def bucket_counts(texts: DataFrame, most: int, buckets: int) -> np.ndarray:
    """How many n-grams of all texts fall into each bucket: summed in each task first, so a task sends one row per bucket at most."""

    def run(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, _, part in blocks(batch, "text"):
                for code, bucket, _ in ngrams(part, most, buckets):
                    total += np.bincount(bucket, weights=np.bincount(code, minlength=len(bucket)), minlength=buckets).astype(np.int64)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for r in texts.select("text").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(own: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the logarithm of target share over own share, each bucket counted once more than it occurs."""
    m, s, t = len(own), float(own.sum()), float(target.sum())
    return np.array([math.floor(UNIT * math.log((b + 1.0) * (s + m) / ((a + 1.0) * (t + m)))) for a, b in zip(own.tolist(), target.tolist(), strict=True)], np.int64)


def noise(h: int) -> int:
    """Thousandths of a Gumbel variate from an unsigned 32-bit number."""
    return math.floor(-UNIT * math.log(-math.log((h + 0.5) / 4294967296)))


def ranked(rows: DataFrame, order: list[Column], workdir: str, name: str, rank_col: str = "rank") -> DataFrame:
    """``rows`` with their places from 1 in ``order``: range-partitioned, sorted and written with the place within the partition; offsets are added on reading."""
    sorted_ = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    placed = written(sorted_, workdir, name)
    part, at = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = {r["part"]: r["n"] for r in placed.groupBy(part.alias("part")).agg(F.max(at + 1).alias("n")).collect()}  # a row per partition
    offsets, before = [], 0
    for p in sorted(sizes):
        offsets.append((p, before))
        before += sizes[p]
    starts = rows.sparkSession.createDataFrame(offsets, "_part long, _before long")
    return (placed.withColumn("_part", part).join(F.broadcast(starts), "_part")
            .withColumn(rank_col, F.col("_before") + at + 1).drop("_part", "_before", "_at"))


def resample(docs: DataFrame, target: DataFrame, most: int = 1, buckets: int = BUCKETS, seed: int = 2024, draw_pct: int = 10, least_words: int = 20,
             id_col: str = "doc_id", text_col: str = "text", target_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_features, weight, score, rank`` (all long but the id, which keeps its type).

    Runs of 1 to ``most`` words are the features. Of the N documents with ``least_words`` words or more the ``draw_pct * N // 100`` highest scores are drawn and ranked, ties to
    smaller ids (no id: last); ``rank`` is null for the rest. Null and empty texts have no features and weight 0, and are never drawn if ``least_words`` is above 0.
    Rows that repeat an id share its noise and are ranked each on its own. No target texts: every target share is the same. An empty table gives no rows.
    """
    spark = docs.sparkSession
    base = workdir(spark, "resampling")
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("long")
    rows = columns(docs, doc_id=id_col, text=text_col)
    gain = spark.sparkContext.broadcast(gains(bucket_counts(rows, most, buckets), bucket_counts(columns(target, text=target_col), most, buckets)))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for lo, hi, part in blocks(batch, "text"):
                n = hi - lo
                found, weight, words = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
                for size, (code, bucket, text) in enumerate(ngrams(part, most, buckets)):
                    worth = pc.take(pa.array(gain.value), pa.array(bucket)).take(pa.array(code)).to_numpy(zero_copy_only=False)
                    limits = np.searchsorted(text, np.arange(n + 1))
                    sums = np.concatenate([[0], np.cumsum(worth)])
                    weight += sums[limits[1:]] - sums[limits[:-1]]
                    found += np.diff(limits)
                    if size == 0:
                        words = np.diff(limits)
                score = weight + [noise(x) for x in batch.column("h").slice(lo, n).to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(lo, n), *[pa.array(c) for c in (found, weight, score, words)]],
                                                 names=["doc_id", "n_features", "weight", "score", "words"])

    scored = rows.select("doc_id", "text", h.alias("h")).mapInArrow(run, f"doc_id {kind}, n_features long, weight long, score long, words long")
    scored = written(scored.withColumn("row", F.monotonically_increasing_id()), base, "scored")  # the row number parts equal rows
    able = scored.filter(F.col("words") >= least_words)
    drawn = able.count() * draw_pct // 100
    places = ranked(able, [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("row")], base, "ranked")
    out = ["doc_id", "n_features", "weight", "score"]
    return (places.select(*out, F.when(F.col("rank") <= drawn, F.col("rank")).alias("rank"))
            .unionByName(scored.filter(F.col("words") < least_words).select(*out, F.lit(None).cast("long").alias("rank"))))
