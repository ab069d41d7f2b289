"""What the corpus operators leave on disk and send through shuffles."""
from __future__ import annotations

import time
import tracemalloc
import types
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sluice.llm import ngram_join, pitman_yor, shared
from sluice.llm.pitman_yor import Bucket, Model, framed, narrow, unframed, widened

NONE = np.zeros(0, np.uint64)


def shuffle_files(spark) -> set[str]:
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = (files.apply(i).getName() for i in range(files.size()))
    return {n for n in names if n.startswith("shuffle_") and n.endswith(".data")}


def test_written_tables_leave_no_shuffle_files(spark):
    conf = spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None)
    before, base = shuffle_files(spark), shared.workdir(spark, "test")
    found = shared.written(spark.range(10_000).groupBy((F.col("id") % 100).alias("k")).agg(F.count(F.lit(1)).alias("n")).join(spark.range(100).withColumnRenamed("id", "k"), "k"), base, "t")
    for _ in range(100):
        if not shuffle_files(spark) - before:
            break
        time.sleep(0.1)
    assert not shuffle_files(spark) - before
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None) == conf
    assert found.agg(F.sum("n")).first()[0] == 10_000


@pytest.mark.parametrize("values", [[], [0], [255, 256, 0], [3, 1 << 40], [(1 << 64) - 1, 5], list(range(70_000))])
def test_packed_numbers_come_back(values):
    values = np.array(values, np.uint64)
    assert (widened(narrow(values)).astype(np.uint64) == values).all()
    assert unframed(framed([b"", narrow(values), b"x"])) == [b"", narrow(values), b"x"]


def test_context_totals_travel_packed(spark):
    rng = np.random.default_rng(3)
    every = rng.integers(0, 1 << 63, 4_000).astype(np.uint64) * np.uint64(2)
    contexts = [np.sort(rng.choice(every, 2_500, replace=False)) for _ in range(3)]
    values = [rng.integers(0, 900, 2_500) for _ in contexts]
    state = spark.createDataFrame(pd.DataFrame({"bucket": range(3), "contexts": list(map(narrow, contexts)), "context_tables": list(map(narrow, values))}),
                                  "bucket int, contexts binary, context_tables binary")
    got = pitman_yor._context_totals(state, 5, "context_tables").toPandas()
    assert len(got) == 15
    want = pd.Series(np.concatenate(values)).groupby(np.concatenate(contexts)).sum()
    for bucket, of in enumerate(contexts):
        assert (pitman_yor._aligned(got[got["bucket"] == bucket], "context_tables") == want[of].to_numpy()).all()


def opened(n_words: int, docs: list[int]) -> tuple[Bucket, Model, bytes]:
    words = np.sort(np.random.default_rng(4).integers(0, 1 << 63, n_words).astype(np.uint64))
    ones = np.ones(n_words, np.int64)
    blob = framed(list(map(narrow, (words, words, ones, np.arange(n_words), ones, np.resize(docs, n_words)))))
    bucket, model = Bucket.opened(NONE, [blob]), Model(NONE, n_tokens=n_words, n_words=n_words, root=(n_words, n_words))
    bucket.customers = bucket.by_context(bucket.count)
    bucket.keep(model, bucket.by_context(bucket.tables))
    return bucket, model, blob


def test_kept_seatings_are_smaller_than_their_probabilities():
    bucket, *_ = opened(5_000, [0])
    row = bucket.row(0).iloc[0]
    assert len(row["kept"]) < 2 * 5_000
    assert (Bucket.of_row(NONE, row).p == bucket.p).all() and (bucket.p > 0).all()


def test_sums_of_few_documents_of_a_chunk_are_small():
    bucket, model, blob = opened(4, [0, 0, 0, 50_000])
    part, = bucket.scores(model, [blob])
    present, score, base, known = map(widened, unframed(part))
    assert len(part) < 500
    assert present.tolist() == [0, 50_000] and known.tolist() == [3, 1]
    assert score / pitman_yor.FIXED == pytest.approx(-np.log10(bucket.p[0]) * np.array([3, 1]), abs=1e-9)
    assert base / pitman_yor.FIXED == pytest.approx(-np.log10(1.1 / 4.5) * np.array([3, 1]), abs=1e-9)


def test_sweeps_pack_only_what_they_change(monkeypatch):
    bucket, *_ = opened(50, [0])
    row = bucket.row(0).iloc[0]
    packed = []
    monkeypatch.setattr(pitman_yor, "narrow", lambda values: packed.append(len(values)) or narrow(values))
    again = Bucket.of_row(NONE, row).row(0).iloc[0]
    assert all(row[name] == again[name] for name in pitman_yor.ARRAYS)
    assert len(packed) <= 5


@pytest.mark.parametrize("high", [40, 1 << 40])
def test_distinct_values_and_orders(high):
    rng = np.random.default_rng(6)
    first, then = rng.integers(0, high, 3_000), rng.integers(0, high, 3_000)
    found, place = pitman_yor.distinct(first.astype(np.uint64))
    want, at = np.unique(first, return_inverse=True)
    assert (found == want).all() and (place == at).all()
    assert (pitman_yor.ascending(first, then) == np.lexsort((then, first))).all()
    assert not len(pitman_yor.ascending(NONE.astype(np.int64), NONE.astype(np.int64)))


def test_chunks_are_packed_by_few_sorts(monkeypatch):
    """However many buckets there are, a chunk is sorted as a whole; its blobs hold all pairs and documents."""
    rng = np.random.default_rng(7)
    names = [f"w{i}" for i in range(300)]
    texts = [" ".join(rng.choice(names, n)) for n in rng.integers(0, 60, 120)] + ["", None, "end " * 400]
    held = rng.random(len(texts)) < 0.3
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array(map(str, range(len(texts)))), "held_out": pa.array(held), "text": pa.array(texts)})
    own, = (words for words, *_ in pitman_yor._tokens(pa.array(["end"]), np.zeros(1, bool)))
    heavy = np.sort(own)
    monkeypatch.setattr(pitman_yor, "TaskContext", types.SimpleNamespace(get=lambda: types.SimpleNamespace(partitionId=lambda: 3)))
    calls = Counter()
    for name in ("unique", "sort", "argsort", "lexsort"):
        monkeypatch.setattr(np, name, lambda *a, f=getattr(np, name), **k: calls.update(["sorts"]) or f(*a, **k))
    docs = types.SimpleNamespace(mapInArrow=lambda run, schema: run)
    want = Counter()
    for text, h in zip(texts, held, strict=True):
        of = [*((text or "").split()), None]
        want.update((a, b, bool(h)) for a, b in zip([None, *of], of, strict=False))
    sorts = []
    for n in (3, 70):
        for tokens in (False, True):
            calls.clear()
            rows = pa.Table.from_batches(pitman_yor._packed(docs, types.SimpleNamespace(value=heavy), n, tokens)(iter([batch]))).to_pylist()
            sorts.append(calls["sorts"])
            n_train, pairs, trained, listed = int((~held).sum()), [], 0, Counter()
            for row in (r for r in rows if r["blob"] is not None):
                words, contexts, word, context, counts, of_docs = pitman_yor._unpacked(row["blob"])
                assert (np.diff(words.astype(float)) > 0).all() and (np.diff(contexts.astype(float)) > 0).all()
                pairs += zip(words[word].tolist(), contexts[context].tolist(), strict=True)
                trained += counts.sum()
                if tokens:
                    assert counts.sum() == len(of_docs)
                    listed.update(of_docs.tolist())
            assert len(pairs) == len(set(pairs)) == len({k[:2] for k in want})
            if tokens:
                ids, = ([r["ids"], r["n_tokens"]] for r in rows if r["blob"] is None)
                assert all(n_of == len((texts[int(i)] or "").split()) + 1 == listed[at] for at, (i, n_of) in enumerate(zip(*ids, strict=True)))
                assert sum(listed[i] for i in range(n_train)) == sum(c for (*_, h), c in want.items() if not h)
            else:
                assert trained == sum(c for (*_, h), c in want.items() if not h)
    assert sorts[:2] == sorts[2:] and max(sorts) < 12


def peak(f) -> int:
    """Most bytes that ``f`` holds at a time beyond what there was."""
    tracemalloc.start()
    try:
        f()
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_a_window_of_shingles_is_counted_in_place(monkeypatch):
    """Besides the window itself there are flags and the repeated ones; counts are those of the plain way."""
    rng = np.random.default_rng(8)
    names = [f"w{i}" for i in range(5_000)]
    said = " ".join(rng.choice(names, 60))
    texts = [" ".join(rng.choice(names, n)) + (f" {said}" if i % 7 == 0 else "") for i, n in enumerate(rng.integers(0, 400, 4_000))] + [None, ""]
    batches = [pa.RecordBatch.from_pydict({"text": pa.array(texts[i: i + 500])}) for i in range(0, len(texts), 500)]
    every = [found for batch in batches for _, found in ngram_join._sets(batch, 5)]
    monkeypatch.setattr(ngram_join, "HEAVY_WINDOW", 300_000)
    got, want = [], []
    size, window = 0, []
    for found in [*every, None]:
        if found is None or size >= ngram_join.HEAVY_WINDOW:
            values, counts = np.unique(np.concatenate(window), return_counts=True)
            want += [*zip(values[counts > 1].view(np.int64).tolist(), counts[counts > 1].tolist(), strict=True)]
            size, window = 0, []
        if found is not None:
            window.append(found)
            size += len(found)
    for part in ngram_join._counted(batches, 5):
        got += zip(part.column("shingle").to_pylist(), part.column("n").to_pylist(), strict=True)
    assert got == want and len(got) > 100
    monkeypatch.setattr(ngram_join, "HEAVY_WINDOW", 1 << 20)
    rest = peak(lambda: [None for batch in batches for _ in ngram_join._sets(batch, 5)])
    assert peak(lambda: list(ngram_join._counted(batches, 5))) - rest < 2 * 8 * (1 << 20)


@pytest.mark.parametrize("values", [[], [4], [4, 4], [7, 4, 7], [1, 1, 1, 2, 3, 3, 0], list(range(50))])
def test_repeated_values_and_their_counts(values):
    found, counts = ngram_join.repeated(np.array(values, np.uint64))
    want = sorted((v, n) for v, n in Counter(values).items() if n > 1)
    assert [*zip(found.tolist(), counts.tolist(), strict=True)] == want


def test_texts_are_hashed_in_small_pieces():
    batch = pa.RecordBatch.from_pydict({"text": pa.array(["some words that are hashed " * 40] * 2_000)})
    list(ngram_join._sets(batch.slice(0, 500), 5))
    assert peak(lambda: [None for _ in ngram_join._sets(batch, 5)]) < 20e6


def test_fewer_rows_travel_at_a_time_while_texts_are_shingled(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    shared.workdir(spark, "test")
    before = spark.conf.get(key)
    sizes = lambda: {r.n for r in spark.range(0, 1_200, 1, 1).mapInArrow(lambda bs: (pa.RecordBatch.from_pydict({"n": [b.num_rows]}) for b in bs), "n long").collect()}
    try:
        spark.conf.set(key, str(shared.BATCH_ROWS))
        with shared.rows_at_a_time(spark, 500):
            assert sizes() == {500, 200}
        assert spark.conf.get(key) == str(shared.BATCH_ROWS)
        spark.conf.set(key, "300")
        with shared.rows_at_a_time(spark, 500):
            assert sizes() == {300}
    finally:
        spark.conf.set(key, before)


def test_batches_to_workers_are_bounded_by_bytes(spark):
    shared.workdir(spark, "test")
    long = spark.range(0, 60, 1, 1).select(F.repeat(F.lit("long text "), 20_000).alias("text"))
    count = lambda bs: (pa.RecordBatch.from_pydict({"n": [b.num_rows], "size": [b.nbytes]}) for b in bs)
    sizes = long.mapInArrow(count, "n long, size long").collect()
    assert sum(r.n for r in sizes) == 60
    assert max(r.size for r in sizes) <= shared.BATCH_BYTES + 210_000


def test_a_session_keeps_its_own_bound_of_bytes(spark):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "5m")
    try:
        shared.workdir(spark, "test")
        assert spark.conf.get(key) == "5m"
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def test_unused_memory_goes_back_after_each_batch(monkeypatch):
    calls = []
    monkeypatch.setattr(shared.pa, "default_memory_pool", lambda: types.SimpleNamespace(release_unused=lambda: calls.append(1)))
    batches = [pa.RecordBatch.from_pydict({"n": [i]}) for i in range(3)]
    assert list(shared.trimmed(iter(batches))) == batches
    assert len(calls) == 3
    assert list(shared.trimmed(iter([]))) == []
