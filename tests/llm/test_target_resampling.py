"""Importance resampling against plain Python, for n-grams of one to three words."""
from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import pyarrow as pa
import pytest

from llm.conftest import frame
from sluice.llm import target_resampling as tr

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def features(text, most):
    w = WORD.findall((text or "").translate(LOWER))
    return w, [" ".join(w[i: i + n]) for n in range(1, most + 1) for i in range(len(w) - n + 1)]


def brute(rows, target, most, buckets, pct, least):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    own, wanted = Counter(), Counter()
    for _, t, *_ in rows:
        own.update(map(bucket, features(t, most)[1]))
    for t in target:
        wanted.update(map(bucket, features(t, most)[1]))
    s, t_all = sum(own.values()), sum(wanted.values())
    gain = lambda b: math.floor(1000 * math.log((wanted[b] + 1) * (s + buckets) / ((own[b] + 1) * (t_all + buckets))))
    out = []
    for i, t, *_ in rows:
        words, f = features(t, most)
        weight = sum(gain(bucket(x)) for x in f)
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(words)])
    able = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for rank, r in enumerate(able[: len(able) * pct // 100], start=1):
        r[4] = rank
    return sorted((tuple(r[:5]) for r in out), key=str)


@pytest.mark.parametrize(("most", "buckets"), [(1, 10_000), (3, 97)])
def test_against_plain_python(spark, docs, rows, most, buckets):
    target = [rows[0][1], rows[5][1], None, "", "Öfen ärgern 9 x"]
    wanted = spark.createDataFrame([(t, "clash") for t in target], "text string, score string")
    got = tr.resample(docs, wanted, most=most, buckets=buckets, draw_pct=37, least_words=20)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows, target, most, buckets, 37, 20)


def test_equal_rows_get_ranks_of_their_own(spark):
    rows = [(1, "a b c " * 10, "en", "s")] * 40 + [(None, "a b c " * 10, "en", "s")] * 40 + [(2, None, "en", "s")] * 20
    got = tr.resample(frame(spark, rows, 6), spark.createDataFrame([("a b",)], "text string"), draw_pct=50)
    ranks = [r["rank"] for r in got.collect()]
    assert sorted(r for r in ranks if r) == list(range(1, 41)) and ranks.count(None) == 60


def test_no_documents_and_no_target(spark, empty, docs):
    none = spark.createDataFrame([], "text string")
    assert tr.resample(empty, none).columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert tr.resample(empty, none).count() == 0
    assert tr.resample(docs, none).filter("rank = 1").count() == 1


def test_pairs_stay_within_their_text():
    block = pa.array(["a b", "b a", None, "", " , a", "b"])
    sizes = [[(len(code), text.tolist()) for code, _, text in [level]][0] for level in tr.ngrams(block, 3, 50)]
    assert sizes == [(6, [0, 0, 1, 1, 4, 5]), (2, [0, 1]), (0, [])]
