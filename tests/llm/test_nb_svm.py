"""The quality classifier: its indicators, its dual descent against the primal optimum, held-out accuracy, hard cases."""
from __future__ import annotations

import random
import re
import zlib

import numpy as np
import pytest

from llm.conftest import frame
from sluice.llm import nb_svm

SF = "/root/testdata/sf0.1"


def buckets(*texts):
    raw = [t.encode() for t in texts]
    return nb_svm.text_buckets(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))


def test_indicators_hang_on_their_own_text_alone():
    rng = random.Random(9)
    texts = ["".join(rng.choice("aB9 .\n|é") for _ in range(rng.randint(0, 120))) for _ in range(80)]
    together = buckets(*texts)
    for t, held in zip(texts, together, strict=True):
        assert np.array_equal(held, buckets(t)[0])
    assert len(buckets("", " \n ")[0]) == 0


def test_shapes_tell_what_words_do_not():
    same = lambda a, b: np.array_equal(*buckets(a, b))
    shared = lambda a, b: len(np.intersect1d(*buckets(a, b)))
    assert not same("aa bb\naa bb\n", "aa bb\naa bc\n")  # a line that occurred before
    assert shared("haus%%% baum%%%", "wald%%% feld%%%") > shared("haus%%% baum%%%", "wald feld")
    assert shared("er er er", "zu zu zu") > shared("er er er", "zu an zu")  # a word said again, whatever word it is


def primal(x, y, cost, w):
    return w @ w / 2 + (cost * np.maximum(0, 1 - y * (x @ w))).sum()


def test_dual_descent_reaches_the_optimum():
    rng = np.random.RandomState(4)
    x = rng.randn(60, 8) * (rng.rand(60, 8) < 0.5)
    y = np.where(x[:, 0] + 0.5 * rng.randn(60) > 0, 1.0, -1.0)
    cost = np.where(y > 0, 0.5, 1.0)
    at = [np.flatnonzero(r) for r in x]
    w = nb_svm.dual_descent(at, [r[a] for r, a in zip(x, at, strict=True)], y, 8, cost, epochs=2000)
    full = np.hstack([x, np.ones((60, 1))])
    best = primal(full, y, cost, w)
    # A slow subgradient descent on the primal itself gets to the same value.
    v = np.zeros(9)
    low = np.inf
    for t in range(1, 40_001):
        inside = y * (full @ v) < 1
        v -= (v - (cost * y * inside) @ full) / t
        low = min(low, primal(full, y, cost, v))
    assert abs(best - low) < 0.001 * low  # it stops at gradients under 0.01


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{n}.parquet") for n in ("documents", "labels"))
    got = nb_svm.quality_scores(docs, labels).join(labels, "doc_id").filter("held_out").select("score", "predicted", "quality").collect()
    bad, good = [r for r in got if r["quality"] == 0], [r for r in got if r["quality"] == 1]
    assert len(bad) > 100 and len(good) > 800
    assert np.mean([r["predicted"] == 0 for r in bad]) > 0.85
    assert np.mean([r["predicted"] == 1 for r in good]) > 0.97


def test_hard_rows_and_folds(spark, docs, rows):
    labels = spark.createDataFrame([(i, int(n % 3 > 0), "x") for n, (i, *_) in enumerate(rows)] + [(100, None, "x"), (None, 1, "x")], "doc_id long, quality int, text string")
    got = nb_svm.quality_scores(docs, labels).collect()
    assert sorted((str(r["doc_id"]), r["held_out"]) for r in got) == sorted((str(i), i is None or zlib.crc32(str(i).encode()) % 3 == 1) for i, *_ in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got)
    by_text: dict = {}
    texts = {i: t for i, t, *_ in rows if i not in (None, 715)}
    for r in got:
        if r["doc_id"] in texts:
            by_text.setdefault(texts[r["doc_id"]] or "", set()).add(r["score"])
    assert all(len(s) == 1 for s in by_text.values())  # the text alone decides


def test_labels_of_the_held_fold_are_not_read(spark, docs, rows):
    truth = [(i, int(bool(re.search("e", t or "")))) for i, t, *_ in rows if i is not None]
    lied = [(i, 1 - q if zlib.crc32(str(i).encode()) % 3 == 1 else q) for i, q in truth]
    score = lambda labels: sorted((r["doc_id"] or -1, r["score"]) for r in nb_svm.quality_scores(docs, spark.createDataFrame(labels, "doc_id long, quality int")).collect())
    assert score(truth) == score(lied)


@pytest.mark.parametrize("kinds", [[], [1], [0]])
def test_labels_of_one_kind_decide_nothing(spark, docs, kinds):
    labels = spark.createDataFrame([(100 + i, q) for i in range(30) for q in kinds], "doc_id long, quality int")
    assert {r["score"] for r in nb_svm.quality_scores(docs, labels).select("score").collect()} == {0.5}


def test_sample_is_one_row_an_id(spark, monkeypatch):
    """Many rows of few labelled ids: each id is learned from once, and at most SAMPLE ids."""
    monkeypatch.setattr(nb_svm, "SAMPLE", 20)
    seen = []
    learn = nb_svm.learn
    monkeypatch.setattr(nb_svm, "learn", lambda sample: seen.append(sample.count()) or learn(sample))
    rows = [(i % 50, f"word{i % 7} and so on {i}", "en", "s") for i in range(2000)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(50)], "doc_id long, quality int")
    assert nb_svm.quality_scores(frame(spark, rows), labels).count() == 2000
    assert seen == [20]


def test_empty_table(spark, empty):
    labels = spark.createDataFrame([(1, 0), (2, 1)], "doc_id long, quality int")
    got = nb_svm.quality_scores(empty, labels)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"] and got.count() == 0
