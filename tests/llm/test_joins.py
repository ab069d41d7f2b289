"""N-gram join, substring deduplication and URL lists against brute force."""
from __future__ import annotations

import datetime as dt
import hashlib
import random
import re
from collections import Counter

import pytest

from llm.conftest import frame
from sluice.llm import ngram_join, suffix_dedup
from sluice.llm.url_lists import filter_urls

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def shingle_set(text, k):
    words = WORD.findall((text or "").translate(LOWER))
    return {tuple(words[i: i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def brute_components(rows, k, pct):
    sets = [shingle_set(t, k) for _, t, *_ in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            inter = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * inter >= pct * (len(sets[i]) + len(sets[j]) - inter):
                parent[find(i)] = find(j)
    least: dict[int, int] = {}
    for i, (doc_id, *_) in enumerate(rows):
        if doc_id is not None:
            least[find(i)] = min(doc_id, least.get(find(i), doc_id))
    return [(doc_id, len(sets[i]), least.get(find(i))) for i, (doc_id, *_) in enumerate(rows)], [find(i) if sets[i] else None for i in range(len(rows))]


@pytest.mark.parametrize("k,pct", [(4, 85), (5, 80)])
def test_components_match_all_pairs(docs, rows, k, pct):
    got = [tuple(r) for r in ngram_join.ngram_components(docs, k, pct).collect()]
    want, _ = brute_components(rows, k, pct)
    assert Counter(got) == Counter(want)


def test_components_with_every_pair_at_the_bound(spark):
    # Chains of texts that each share exactly 85 of 100 shingles with the next, and others just below.
    words = [f"w{i}" for i in range(400)]
    texts = [" ".join(words[i * 8: i * 8 + 103]) for i in range(12)] + [" ".join(words[250 + i * 9: 250 + i * 9 + 103]) for i in range(4)]
    rows = [(i, t, "en", "s") for i, t in enumerate(texts)]
    got = [tuple(r) for r in ngram_join.ngram_components(frame(spark, rows), 4, 85).collect()]
    assert Counter(got) == Counter(brute_components(rows, 4, 85)[0])


def test_one_per_component(docs, rows):
    left = ngram_join.one_per_component(docs, 5, 80)
    assert left.columns == docs.columns
    got = Counter((r["doc_id"], r["text"]) for r in left.collect())
    _, of = brute_components(rows, 5, 80)
    want, seen = Counter(), set()
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0))
    for i in order:
        if of[i] is None or of[i] not in seen:
            want[(rows[i][0], rows[i][1])] += 1
            seen.add(of[i])
    # Where the first id of a component is repeated with several texts, either of them may stay.
    assert sum(got.values()) == sum(want.values())
    assert Counter(i for i, _ in got.elements()) == Counter(i for i, _ in want.elements())


def test_join_of_no_rows(empty):
    assert ngram_join.ngram_components(empty).count() == 0
    assert ngram_join.one_per_component(empty).count() == 0


def brute_removed(texts, width):
    seen = Counter(t[p: p + width] for t in texts for p in range(len(t) - width + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for p in range(len(t) - width + 1):
            if seen[t[p: p + width]] > 1:
                gone[p: p + width] = b"\1" * width
        spans = sum(1 for q in range(len(t)) if gone[q] and (q == 0 or not gone[q - 1]))
        out.append((len(t), sum(gone), spans, hashlib.sha256(bytes(v for v, g in zip(t, gone, strict=True) if not g)).hexdigest()))
    return out


@pytest.mark.parametrize("hot", [4096, 1])
def test_removed_bytes_match_all_windows(docs, rows, hot, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    got = Counter(tuple(r) for r in suffix_dedup.remove_repeats(docs).collect())
    want = brute_removed([(t or "").encode() for _, t, *_ in rows], suffix_dedup.WIDTH)
    assert got == Counter((rows[i][0], *w) for i, w in enumerate(want))


def test_periodic_texts(spark):
    texts = ["ab" * 300, "abc" * 80 + "q" * 210, "abcd" * 49 + "abc", "é" * 150 + "x" * 199, "0123456789" * 25 + "end" + "0123456789" * 19, "q" * 200]
    rows = [(i, t, "en", "s") for i, t in enumerate(texts)]
    got = Counter(tuple(r) for r in suffix_dedup.remove_repeats(frame(spark, rows)).collect())
    assert got == Counter((i, *w) for i, w in enumerate(brute_removed([t.encode() for t in texts], suffix_dedup.WIDTH)))


def test_substrings_of_no_rows(empty):
    assert suffix_dedup.remove_repeats(empty).count() == 0


def test_url_list_entries_of_any_case_are_one_log(spark):
    day = lambda n: dt.date(2024, 1, n)
    entries = [("ads", "Net.org", "add", day(1)), ("ads", "net.org", "remove", day(5)), ("ads", "NET.org", "add", day(9))]
    pages = [(i, "http://a.net.org/x", day(d)) for i, d in enumerate((2, 6, 10))]
    out = filter_urls(spark.createDataFrame(pages, "page_id long, url string, fetched date"),
                      spark.createDataFrame(entries, "list string, pattern string, action string, since date"))
    assert {r["page_id"]: (r["blocked"], r["n_entries"]) for r in out.collect()} == {0: (True, 1), 1: (False, 0), 2: (True, 1)}


def test_url_lists_match_a_scan_of_all_entries(spark):
    day = lambda n: dt.date(2024, 1, 1) + dt.timedelta(n)
    entries = [("ads", "example.com", "add", day(3)), ("ads", "example.com", "remove", day(9)), ("ads", "example.com", "add", day(20)),
               ("bad", "com/x", "add", day(0)), ("bad", "b.example.com", "add", day(5)), ("bad", "b.example.com", "remove", day(5)),
               ("bad", "Net", "add", day(2)), ("bad", None, "add", day(2)), ("ads", "org", "remove", day(1)), ("ads", "org", "add", day(4)), ("ads", "org", "add", day(4))]
    urls = ["http://example.com/x/y", "https://user@B.Example.com:80/x", "http://notexample.com/", "ftp://a.b.example.com", "http://q.net?z", "http://www.org/X", "nothing",
            "", None, "http:///x", "http://example.com./x"]
    captures = [(i * 40 + n, u, day(n) if n < 25 else None, "clash") for i, u in enumerate(urls) for n in (0, 3, 5, 8, 9, 19, 20, 24, 30)] + [(None, urls[0], day(4), "c")] * 2
    got = filter_urls(spark.createDataFrame(captures, "page_id long, url string, fetched date, host string"),
                      spark.createDataFrame(entries, "list string, pattern string, action string, since date")).collect()

    def active(name, pattern, when):
        log = [(s, a) for li, p, a, s in entries if li == name and p == pattern and s <= when]
        return bool(log) and max(log)[1] == "add"
    want = Counter()
    for page, url, when, _ in captures:
        m = re.match(r"[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:@]+)", url or "")
        host = m[1].lower() if m else None
        seg = re.match(r"[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*/([^/?#]*)", url or "")
        hits = []
        if host and when:
            labels = host.split(".")
            keys = {".".join(labels[i:]) + tail for i in range(len(labels)) for tail in ["", *(["/" + seg[1].lower()] if seg and seg[1] else [])]}
            hits = [(li, p.lower()) for li, p in {(e[0], e[1]) for e in entries if e[1]} if p.lower() in keys and active(li, p, when)]
        best = min((p for _, p in hits), key=lambda p: (-len(p), p), default=None)
        want[(page, host, when, bool(hits), len(hits), ",".join(sorted({li for li, _ in hits})), best)] += 1
    assert Counter(tuple(r) for r in got) == want
    none = spark.createDataFrame([], "page_id long, url string, fetched date")
    assert filter_urls(none, spark.createDataFrame([], "list string, pattern string, action string, since date")).count() == 0


def test_a_group_that_mostly_does_not_link_costs_a_few_pairs_a_member(spark, monkeypatch):
    """600 near copies, most pairs just under the bound: links as by brute force, few pairs verified."""
    rng = random.Random(8)
    words = [f"w{i}" for i in range(4000)]
    base = [rng.choice(words) for _ in range(160)]
    rows = []
    for i in range(600):
        text = list(base)
        for at in rng.sample(range(160), rng.choice([2, 3, 3, 4])):
            text[at] = rng.choice(words)
        rows.append((i, " ".join(text), "en", "s"))
    verified = []
    inner = ngram_join._verified
    monkeypatch.setattr(ngram_join, "_verified", lambda pairs, segments, pct: verified.append(pairs.count()) or inner(pairs, segments, pct))
    got = {r["doc_id"]: r["component_id"] for r in ngram_join.ngram_components(frame(spark, rows), k=5, pct=80).collect()}
    sets = [{tuple(t.split()[j: j + 5]) for j in range(156)} for _, t, *_ in rows]
    root = list(range(600))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    n_links = 0
    for a in range(600):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                n_links += 1
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    assert got == {i: find(i) for i in range(600)}
    assert n_links < 0.25 * 600 * 599 / 2 and sum(verified) < 20 * 600
