"""Mixing, packing and the pipeline against plain Python."""
from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from llm.conftest import frame
from sluice.llm import mixing, packing
from sluice.llm.suite import MIX, mix_weights, source_domain

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# ------------------------------------------------------------------- mixing ---

def filled(amount, nodes):
    """Water filling straight from its definition: raise the level until the amount is spent. ``nodes``: name -> (cap, weight)."""
    level, left, open_nodes, out = Fraction(0), Fraction(amount), {k for k, (c, w) in nodes.items() if c > 0 and w > 0}, {}
    while open_nodes:
        total = sum(nodes[k][1] for k in open_nodes)
        nearest = min(open_nodes, key=lambda k: Fraction(nodes[k][0], nodes[k][1]))
        step = Fraction(nodes[nearest][0], nodes[nearest][1]) - level
        if step * total > left:
            level += left / total
            break
        left -= step * total
        level += step
        for k in [k for k in open_nodes if Fraction(nodes[k][0], nodes[k][1]) == level]:
            out[k] = nodes[k][0]
            open_nodes.discard(k)
    return {k: out.get(k, int(level * nodes[k][1]) if k in open_nodes else 0) for k in nodes}


def brute_mix(rows, weights, budget, max_epochs, seed):
    tokens = defaultdict(list)
    for i, t, leaf in rows:
        tokens[leaf].append((i, len(WORD.findall(t or ""))))
    cap = {leaf: sum(n for _, n in docs) * max_epochs for leaf, docs in tokens.items() if leaf in weights}

    def level(depth, prefix, amount):
        names = {leaf[: depth + 1] for leaf in cap if leaf[:depth] == prefix}
        nodes = {n: (sum(c for leaf, c in cap.items() if leaf[: depth + 1] == n), next(weights[leaf][depth] for leaf in cap if leaf[: depth + 1] == n)) for n in names}
        return filled(amount, nodes)
    quota = {}
    for d, given in level(0, (), budget).items():
        for la, more in level(1, d, given).items():
            quota |= level(2, la, more)
    out = Counter()
    for leaf, q in quota.items():
        avail = cap[leaf] // max_epochs
        if not avail:
            continue
        whole, rest = divmod(q, avail)
        for i, n in tokens[leaf]:
            for e in range(whole):
                out[(i, *leaf, n, e)] += 1
        key = lambda i: hashlib.md5(f"{seed}:{whole}:{'' if i is None else i}".encode()).hexdigest()  # noqa: B023, E731
        used = 0
        for k in sorted({key(i) for i, _ in tokens[leaf]}):
            same = [(i, n) for i, n in tokens[leaf] if key(i) == k]
            used += sum(n for _, n in same)
            if used > rest:
                break
            for i, n in same:
                out[(i, *leaf, n, whole)] += 1
    return out


@pytest.mark.parametrize("budget,max_epochs", [(0, 3), (700, 2), (9_000, 1), (26_000, 4), (10**7, 2)])
def test_mix_matches_water_filling(spark, docs, rows, budget, max_epochs):
    domain = F.when(F.col("source") == "src0", "a").when(F.col("source") == "src1", "b").otherwise(F.lit(None))
    of = lambda s: {"src0": "a", "src1": "b"}.get(s)
    leaves = {(of(s), la, s) for _, _, la, s in rows}
    lang_weight = {leaf[:2]: 1 + i % 3 for i, leaf in enumerate(sorted(leaves, key=str))}
    weights = {leaf: ({"a": 5, "b": 2}.get(leaf[0], 1), lang_weight[leaf[:2]], i % 4) for i, leaf in enumerate(sorted(leaves, key=str)) if leaf != ("b", "de", "src1")}
    table = spark.createDataFrame([(*k, *w) for k, w in weights.items()],
                                  "domain string, lang string, source string, domain_weight int, lang_weight int, source_weight int")
    got = Counter(tuple(r) for r in mixing.mix_sources(docs.drop("domain"), table, domain, budget=budget, max_epochs=max_epochs, seed=3).collect())
    assert got == brute_mix([(i, t, (of(s), la, s)) for i, t, la, s in rows], weights, budget, max_epochs, 3)


def test_shortage_stays_among_siblings(spark):
    """A language without enough tokens is made up for by its domain's other language, not by the other domain."""
    rows = [(i, "w " * 10, la, s) for i, (la, s) in enumerate([("en", "x")] * 4 + [("de", "x")] * 40 + [("en", "y")] * 40)]
    weights = spark.createDataFrame([("x", "en", "x", 1, 1, 1), ("x", "de", "x", 1, 1, 1), ("y", "en", "y", 1, 1, 1)],
                                    "domain string, lang string, source string, domain_weight int, lang_weight int, source_weight int")
    out = mixing.mix_sources(frame(spark, rows).drop("domain"), weights, F.col("source"), budget=400, max_epochs=1)
    got = {(r["domain"], r["lang"]): r["n"] for r in out.groupBy("domain", "lang").agg(F.sum("n_tokens").alias("n")).collect()}
    assert got == {("x", "en"): 40, ("x", "de"): 160, ("y", "en"): 200}


def test_mix_runs_without_python(docs, empty):
    plain = docs.drop("domain")
    plan = mixing.mix_sources(plain, mix_weights(plain), source_domain(), **MIX)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
    assert mixing.mix_sources(empty.drop("domain"), mix_weights(empty), source_domain(), **MIX).count() == 0


# ------------------------------------------------------------------ packing ---

def brute_ids(text):
    return np.array([*packing._tokenizer(packing.TOKENIZER).encode(text or "", add_special_tokens=False).ids, 2], "<u4")


def check_pieces(got, rows, size):
    want = Counter()
    for i, t in rows:
        ids = brute_ids(t)
        for at in range(0, len(ids), size):
            part = ids[at: at + size]
            want[(i, at, len(part), zlib.crc32(part.tobytes()), len(ids))] += 1
    assert Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in got) == want
    places = defaultdict(list)
    for r in got:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    assert sorted(places) == list(range(len(places)))
    for own in places.values():
        end = 0
        for offset, length in sorted(own):
            assert offset == end
            end += length
        assert end <= size


@pytest.mark.parametrize("size", [4096, 64])
def test_every_id_has_one_place(docs, rows, size):
    check_pieces(packing.pack_documents(docs, size=size).collect(), [(i, t) for i, t, *_ in rows], size)


def test_ids_of_odd_texts(spark):
    odd = ["don't stop it's 'S x'dy", "a—b c—. —.—", "naïve café's", "x́y ́z á.", "ab cd　ef.", "İstanbul İ. ΣΑΣ.", "12ab.,34!! ...a", "😀a .😀",
           "<|endoftext|> a<|startoftext|>b", "\x1cfoo\x1dbar\x85baz", "ﬁne ½ ² Ⅳ a_b __", "''", "日本語テキスト。です", "a​b ​.", "≮ ≠ ≮"]
    rows = [(i, t, "en", "s") for i, t in enumerate(odd)]
    check_pieces(packing.pack_documents(frame(spark, rows)).collect(), [(i, t) for i, t, *_ in rows], 4096)


def test_shortest_pack_first():
    rng = np.random.default_rng(4)
    histogram = Counter(np.minimum(rng.lognormal(5.5, 1.2, 20_000).astype(int) + 1, 4096).tolist())
    patterns = packing.shortest_pack_first(histogram)
    placed = Counter()
    for count, lengths in patterns:
        assert sum(lengths) <= 4096
        for n in lengths:
            placed[n] += count
    assert placed == Counter(histogram)
    packs = sum(c for c, _ in patterns)
    assert sum(k * v for k, v in histogram.items()) / (4096 * packs) > 0.99
    assert len(patterns) <= 2 * len(histogram) + 1
    assert packing.shortest_pack_first({}) == []


def test_pack_no_rows(empty):
    assert packing.pack_documents(empty).count() == 0


# ----------------------------------------------------------------- pipeline ---

def test_stages_in_order(spark, docs, rows, tmp_path):
    """Each stage on what its predecessor kept, with every hard row in the input."""
    from llm.test_joins import brute_components
    from sluice.llm import quality_rules

    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "pii", "mix", "pack"]
    stages = dict(corpus_pipeline.STAGES)
    table = docs.select("doc_id", "text", "lang", "source", "n_chars")
    secret = spark.createDataFrame([(9000, "write to jo.doe@mail.example.com about " + " ".join(f"w{i}" for i in range(60)), "en", "src0", 1)], table.schema)
    table = table.unionByName(secret)
    table.coalesce(2).write.parquet(f"{tmp_path}/documents.parquet")
    table = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = stages["quality"](spark, table, str(tmp_path)).cache()
    verdict = quality_rules.quality_rules(table).filter("kept")
    assert kept.columns == table.columns and kept.count() == verdict.count() > 60
    one = stages["near_duplicates"](spark, kept, str(tmp_path)).cache()
    rest = [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in kept.collect()]
    groups = brute_components(rest, 5, 80)[1]
    assert one.columns == table.columns and one.count() == len({g for g in groups if g is not None}) + sum(g is None for g in groups)
    clean = stages["pii"](spark, one, str(tmp_path)).cache()
    assert clean.columns == table.columns and clean.count() == one.count()
    texts = {r["doc_id"]: r["text"] for r in clean.collect()}
    assert "jo.doe" not in texts[9000] and re.search(r"write to [a-z]{2}\.[a-z]{3}@[a-z]{4}\.[a-z]{7}\.com about w0 w1", texts[9000])
    assert {i: t for i, t in texts.items() if i != 9000} == {r["doc_id"]: r["text"] for r in one.collect() if r["doc_id"] != 9000}
    assert clean.filter("n_chars <> length(text)").count() == 0
    mixed = stages["mix"](spark, clean, str(tmp_path)).cache()
    chosen = Counter(r["doc_id"] for r in mixing.mix_sources(clean, mix_weights(clean), source_domain(), **MIX).collect())
    assert mixed.columns == table.columns and Counter(r["doc_id"] for r in mixed.collect()) == chosen
    packed = stages["pack"](spark, mixed, str(tmp_path)).collect()
    check_pieces(packed, [(r["doc_id"], r["text"]) for r in mixed.collect()], 4096)
    key = lambda r: (str(r["doc_id"]), r["start"], r["ids_crc32"], r["doc_tokens"])
    assert sorted(map(key, corpus_pipeline.run(spark, str(tmp_path)).collect())) == sorted(map(key, packed))


def test_pipeline_of_no_rows(spark, tmp_path):
    none = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    none.write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_stages_leave_extra_columns_alone(docs, spark):
    names = ["epochs", "last", "domain", "epoch", "n_entities", "row", "left", "at"]
    extra = docs.select("doc_id", "text", "lang", "source", "n_chars", *[F.lit(f"my {c}").alias(c) for c in names])
    for stage in (corpus_pipeline.pii, corpus_pipeline.mix):
        out = stage(spark, extra, "")
        assert out.columns == extra.columns
        got = out.select(*names).distinct().collect()
        assert [tuple(r) for r in got] == [tuple(f"my {c}" for c in names)]
