"""Fill-in-middle against a plain regular expression; chunks and their memory against whole counts."""
from __future__ import annotations

import hashlib
import random
import re

import numpy as np
from pyspark.sql import functions as F

from llm.conftest import frame
from sluice.llm import fill_in_middle as fim

TOKEN = re.compile(r"[A-Za-z]+|[^A-Za-z]", re.S)


def plain_form(doc_id, text, seed=1):
    text = text or ""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i: i + 8], 16) for i in (0, 8, 16, 24))
    tokens = TOKEN.findall(text)
    n = len(tokens)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return doc_id, n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    pre, mid, suf = "".join(tokens[:a]), "".join(tokens[a:b]), "".join(tokens[b:])
    if h4 % 100 < 20:
        return doc_id, n, "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return doc_id, n, "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


def hard_texts():
    rng = random.Random(3)
    odd = "aZ9 .\n<>PSMé字😀́"
    out = ["".join(rng.choice(odd) for _ in range(rng.randint(0, 400))) for _ in range(150)]
    out += ["<P>", "a<S>b", "<M", "<", "x<P", "<<", "S>M>", "a", "é", "😀" * 5000, "y" * 30_000, "ab" * 20_000, "- " * 9_000, "\x00a\x00"]
    shared = "".join(rng.choice("abc de\nfé") for _ in range(5000))
    return out + [shared[i:] + "Q" + shared[:i] for i in range(0, 3000, 500)]


def test_every_case_as_the_expression_has_it(spark, docs, rows):
    more = [(1000 + i, t, "en", "src0") for i, t in enumerate(hard_texts())]
    got = fim.fill_in_middle(docs.unionByName(frame(spark, more)))
    got = got.withColumn("back", fim.restored(F.col("output"), F.col("form"))).collect()
    want = [plain_form(i, t) for i, t, *_ in [*rows, *more]]
    key = lambda r: (str(r[0]), r[5])
    assert sorted((tuple(r)[:6] for r in got), key=key) == sorted(want, key=key)
    assert sorted(((str(r["doc_id"]), r["back"]) for r in got)) == sorted((str(i), t or "") for i, t, *_ in [*rows, *more])
    assert {r["form"] for r in got} == {"plain", "psm", "spm"}


def test_chunks_follow_the_content():
    rng = np.random.RandomState(1)
    shared = rng.randint(97, 123, 60_000).astype(np.uint8)
    memo = fim.Memo()
    for lead in (0, 7, 1001):
        data = np.concatenate([rng.randint(97, 123, lead).astype(np.uint8), shared])
        counted = fim.Counted(data, np.array([0, len(data)]), memo)
        sizes = np.diff(np.concatenate([[0], counted.ends]))
        assert sizes.max() <= fim.MOST and sizes[:-1].min() >= fim.LEAST and counted.ends[-1] == len(data)
    assert memo.counted < 0.5 * memo.asked  # the shared passage was counted once, wherever it stood


def test_a_small_memory_changes_nothing():
    texts = [t.encode() for t in hard_texts()]
    data, bounds = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    for limit in (0, 300, fim.MEMORY):
        counted = fim.Counted(data, bounds, fim.Memo(limit))
        assert [counted.size(i) for i in range(len(texts))] == [len(TOKEN.findall(t.decode())) for t in texts]


def test_edges_do_not_hang_on_blocks(monkeypatch):
    data = np.random.RandomState(2).randint(0, 256, 50_000).astype(np.uint8)
    whole = fim.edges(data)
    monkeypatch.setattr(fim, "BLOCK", 999)
    assert np.array_equal(whole, fim.edges(data)) and len(whole) > 100
    assert len(fim.edges(data[:5])) == 0


def test_empty_table(empty):
    got = fim.fill_in_middle(empty)
    assert got.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"] and got.count() == 0
