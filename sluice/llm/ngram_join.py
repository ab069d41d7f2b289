"""Near-duplicate join on word n-grams (Jaccard), by vertical partitioning of one global n-gram order.

1. Every text becomes its set of distinct k-word shingles (64-bit hashes). Texts with equal sets are one class.
2. One global order of all shingles: those that the corpus repeats most come last (a bounded summary of heavy
   shingles, counted over all documents), the others by hash. Any total order gives the same result; this one keeps
   common passages out of the prefixes.
3. Two sets of Jaccard similarity t or more share a shingle among their first n - ceil(t n) + 1 in that order. The
   prefix index holds those, and only keys that two classes or more share are kept.
4. In each key's bucket the classes least by a few keyed hashes are leaders, nearly the same ones in all buckets of a group; every class is held against
   those it meets. So a group of thousands of near copies costs a few pairs a member and falls into few components.
5. All further pairs of classes of different components that share a key are met, each at its first shared key: first those of one class in 64 (by
   hash) with all others, then of one in eight and the rest, with components between. So a group whose members link
   with each other only now and then costs a few pairs a member too: those that have fallen into one component are not met.
6. The shared prefix keys of a pair bound its overlap, and so do the sets' bit signatures: a shingle whose bit the other set lacks is not shared.
   Pairs that pass both bounds are verified by vertical partitioning: the order is cut into
   fragments, each fragment counts the overlap of the two segments, and the sums over the fragments decide
   100 * intersection >= threshold * union.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm import bytetext as B
from sluice.llm.graph import components
from sluice.llm.shared import columns, key_filter, may_hold, rows_at_a_time, scan_filtered, trimmed, workdir, written

HEAVY_KEYS = 1 << 17  # most shingles in the broadcast summary: 2 MB at most, whatever the corpus
HEAVY_WINDOW = 1 << 22  # shingles of a task counted at a time
HEAVY_LEAST = 2
TEXT_BYTES = 1 << 18  # of texts hashed at a time; hashing takes some 50 times as much
TEXT_ROWS = 500  # sent to a Python worker at a time: the buffers are the executor's, beside its heap
RECENT = 4
FRAGMENTS = 4
SIGNATURE = 16  # words of 64 bits in a set's signature
LEADERS = 4  # of each key's bucket
SLICES = (64, 8, 1)  # one class in so many, by hash, is held against all others that haven't been
_HEAVY_BASE = 1 << 62


def repeated(held: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The values that ``held`` has twice or more, ascending, with their counts. Sorts it in place: besides it only flags are as long."""
    held.sort()
    again = held[1:] == held[:-1]
    edge = np.diff(again, prepend=False, append=False)
    ends = np.flatnonzero(edge).reshape(-1, 2)
    return held[ends[:, 0]], ends[:, 1] - ends[:, 0] + 1


def _counted(batches, k: int):
    """``(shingle, n)`` of the shingles met HEAVY_LEAST times or more in each window of a task's texts; a window is one array, filled and sorted in place."""
    held, size = np.empty(HEAVY_WINDOW, np.uint64), 0

    def flush():
        values, counts = repeated(held[:size])
        keep = counts >= HEAVY_LEAST
        return pa.RecordBatch.from_arrays([pa.array(values[keep].view(np.int64)), pa.array(counts[keep].astype(np.int64))], names=["shingle", "n"])
    for batch in trimmed(batches):
        for _, found in _sets(batch, k):
            if size + len(found) > len(held):
                held = np.resize(held, size + len(found))
            held[size: size + len(found)] = found
            size += len(found)
            if size >= HEAVY_WINDOW:
                yield flush()
                size = 0
    if size:
        yield flush()


def heavy_shingles(docs: DataFrame, k: int) -> np.ndarray:
    """The most repeated shingles, least repeated first: every task counts all its shingles in windows of fixed size
    and passes on those it met twice or more; the largest sums win. Bounded by HEAVY_KEYS."""
    top = (docs.select("text").mapInArrow(lambda batches: _counted(batches, k), "shingle long, n long")
           .groupBy("shingle").agg(F.sum("n").alias("n"))
           .orderBy(F.desc("n"), "shingle").limit(HEAVY_KEYS).toPandas())
    return top["shingle"].to_numpy(np.int64)[::-1].view(np.uint64).copy()


def _keys(found: np.ndarray, heavy: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Positions of a set's shingles (sorted, unique) in the global order, ascending."""
    if not len(heavy):
        return (found >> B.U64(2)).astype(np.int64)
    at = np.minimum(np.searchsorted(heavy, found), len(heavy) - 1)
    is_heavy = heavy[at] == found
    return np.concatenate([(found[~is_heavy] >> B.U64(2)).astype(np.int64), _HEAVY_BASE + np.sort(rank[at[is_heavy]])])


def _class_id(found: np.ndarray) -> int:
    """64-bit id of a set: the mixed sum and exclusive-or of its mixed members."""
    if not len(found):
        return 0
    m = B.mix(found + B.U64(0x5851F42D4C957F2D))
    total, folded = m.sum(keepdims=True, dtype=B.U64), np.bitwise_xor.reduce(B.mix(m ^ found), keepdims=True)
    return int(B.mix((total * B.U64(3) + B.U64(len(found))) ^ B.mix(folded + B.U64(1)))[0].view(np.int64))


def _signature(found: np.ndarray) -> np.ndarray:
    """A bit for each member, by the hash's upper bits."""
    bits = np.zeros(SIGNATURE * 64, np.uint8)
    bits[(found >> B.U64(33)).astype(np.int64) % (SIGNATURE * 64)] = 1
    return np.packbits(bits, bitorder="little").view("<i8")


def _sets(batch: pa.RecordBatch, k: int):
    """``(row, sorted unique shingles)`` of each row of a batch."""
    for lo, hi, data, bounds in B.text_chunks(batch.column("text"), TEXT_BYTES):
        words, first = B.word_hashes(data, bounds)
        for i in range(hi - lo):
            yield lo + i, np.unique(B.shingles(words[first[i]: first[i + 1]], k))


def _ordered(heavy: np.ndarray):
    order = np.argsort(heavy)
    return heavy[order], order.astype(np.int64)


def _prefixes(docs: DataFrame, k: int, pct: int, heavy: np.ndarray) -> DataFrame:
    """``(doc_id, tag, cid, n, prefix, bits)`` of every row; an empty set has no prefix."""
    shared = docs.sparkSession.sparkContext.broadcast(_ordered(heavy))

    def run(batches):
        values, rank = shared.value
        for batch in trimmed(batches):
            cids, sizes, prefixes, signatures = [], [], [], [np.zeros(0, np.int64)]
            for _, found in _sets(batch, k):
                n = len(found)
                cids.append(_class_id(found))
                sizes.append(n)
                prefixes.append(_keys(found, values, rank)[: n - -(-pct * n // 100) + 1] if n else found.astype(np.int64))
                signatures.append(_signature(found))
            ends = np.cumsum([0] + [len(p) for p in prefixes]).astype(np.int32)
            flat = np.concatenate(prefixes) if prefixes else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("tag"), pa.array(cids, pa.int64()), pa.array(sizes, pa.int64()),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
                 pa.ListArray.from_arrays(pa.array(np.arange(len(sizes) + 1, dtype=np.int32) * SIGNATURE), pa.array(np.concatenate(signatures)))],
                names=["doc_id", "tag", "cid", "n", "prefix", "bits"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "tag", "text").mapInArrow(run, f"doc_id {kind}, tag long, cid long, n long, prefix array<long>, bits array<long>")


def _segments(docs: DataFrame, wanted: DataFrame, k: int, heavy: np.ndarray) -> DataFrame:
    """``(cid, fragment, keys)``: the whole sets of the classes ``wanted(cid, rep)``, cut at the fragments' pivots.

    The order below the heavy shingles is uniform, so equal ranges are equal loads; the heavy ones are a fragment of
    their own. Texts are read where they lie: a filter of fixed size over the representatives' ids decides which are
    shingled, and whatever passes besides them is dropped, or counted once, by the joins that follow.
    """
    sc = docs.sparkSession.sparkContext
    shared = sc.broadcast(_ordered(heavy))
    held = key_filter(wanted.select(F.xxhash64("rep").alias("key")))
    pivots = np.array([_HEAVY_BASE // FRAGMENTS * i for i in range(1, FRAGMENTS)] + [_HEAVY_BASE], np.int64)

    def run(batches):
        values, rank = shared.value
        for batch in trimmed(batches):
            some = may_hold(held.value, batch.column("_key").to_numpy(zero_copy_only=False).astype(np.int64))
            batch = batch.filter(pa.array(some))
            cids, frags, parts = [], [], []
            for _, found in _sets(batch, k):
                cid, keys = _class_id(found), _keys(found, values, rank)
                cuts = [0, *np.searchsorted(keys, pivots), len(keys)]
                for f, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                    if b > a:
                        cids.append(cid)
                        frags.append(f)
                        parts.append(keys[a:b])
            ends = np.cumsum([0] + [len(p) for p in parts]).astype(np.int32)
            flat = np.concatenate(parts) if parts else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(cids, pa.int64()), pa.array(frags, pa.int32()),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], names=["cid", "fragment", "keys"])

    keyed = docs.select("text", F.xxhash64("doc_id").alias("_key"))
    return keyed.mapInArrow(run, "cid long, fragment int, keys array<long>").join(wanted.select("cid"), "cid", "left_semi")


def _similar(inter: Column, n_a: Column, n_b: Column, pct: int) -> Column:
    return inter * (100 + pct) >= (n_a + n_b) * pct


def _verified(pairs: DataFrame, segments: DataFrame, pct: int) -> DataFrame:
    """Links ``(u, v)`` among ``pairs(a, b, n_a, n_b)``: overlaps counted in each fragment, then summed per pair.

    A segment that came twice (rows that repeat both id and text) counts once.
    """
    left = segments.select(F.col("cid").alias("a"), "fragment", F.col("keys").alias("keys_a"))
    right = segments.select(F.col("cid").alias("b"), "fragment", F.col("keys").alias("keys_b"))
    partial = (pairs.join(left, "a").join(right, ["b", "fragment"])
               .select("a", "b", "n_a", "n_b", "fragment", F.size(F.array_intersect("keys_a", "keys_b")).cast("long").alias("overlap")))
    partial = partial.groupBy("a", "b", "n_a", "n_b", "fragment").agg(F.max("overlap").alias("overlap"))
    return (partial.groupBy("a", "b", "n_a", "n_b").agg(F.sum("overlap").alias("overlap"))
            .filter(_similar(F.col("overlap"), F.col("n_a"), F.col("n_b"), pct))
            .select(F.col("a").alias("u"), F.col("b").alias("v")))


def _strong(pairs: DataFrame, known: DataFrame, pct: int) -> DataFrame:
    """Of ``pairs(a, b)`` those whose overlap can be large enough, with their sizes.

    All shared members up to the smaller last prefix key are shared prefix keys. Past it, the class with that key has
    ``ceil(t n) - 1`` members left, and the other one no more than past the last shared key.
    """
    info = lambda x, *cols: known.select(*[F.col(c).alias(f"{c}_{x}" if c != "cid" else x) for c in ("cid", *cols)])
    # Members of one set whose bit the other lacks: as many at least as there are such bits.
    lone = lambda x, y: sum((F.bit_count(F.col(f"bits_{x}")[i].bitwiseAND(F.bitwise_not(F.col(f"bits_{y}")[i]))) for i in range(SIGNATURE)), F.lit(0))
    most = F.least(F.col("n_a") - lone("a", "b"), F.col("n_b") - lone("b", "a"))
    # Signatures are a quarter of what the keys are, and leave few pairs: keys travel for those alone.
    near = (pairs.join(info("a", "n", "bits"), "a").join(info("b", "n", "bits"), "b")
            .filter(_similar(most, F.col("n_a"), F.col("n_b"), pct)).select("a", "b", "n_a", "n_b"))
    met = near.join(info("a", "last", "keys", "places"), "a").join(info("b", "last", "keys", "places"), "b").withColumn("both", F.array_intersect("keys_a", "keys_b"))
    place = lambda x: F.element_at(f"places_{x}", F.array_position(f"keys_{x}", F.array_max("both")).cast("int"))
    past_prefix = lambda x: -F.floor(-F.col(f"n_{x}") * pct / 100) - 1
    past_shared = lambda x: F.col(f"n_{x}") - place(x) - 1
    first = F.col("last_a") <= F.col("last_b")
    most = F.size("both") + F.least(F.when(first, past_prefix("a")).otherwise(past_prefix("b")), past_shared("a"), past_shared("b"))
    return met.filter(F.size("both") > 0).filter(_similar(most, F.col("n_a"), F.col("n_b"), pct)).select("a", "b", "n_a", "n_b")


def _met(known: DataFrame, roots: DataFrame, pct: int, turn: int) -> DataFrame:
    """``(a, b)`` of all pairs of different roots with a shared key, sizes within the bound, and enough members from there on, that have
    one class of this turn (see ``SLICES``) and none of an earlier one.

    A pair is met where none of the RECENT keys before is shared, which is its first shared key, and seldom once more.
    """
    hashed = F.xxhash64("cid", F.lit(3))
    slot = F.lit(len(SLICES) - 1)
    for i in reversed(range(len(SLICES) - 1)):
        slot = F.when(F.pmod(hashed, F.lit(SLICES[i])) == 0, i).otherwise(slot)
    left = _with_roots(known, roots).withColumn("slot", slot).filter(F.col("slot") >= turn)
    rows = left.select("cid", "n", "root", "slot", "keys", "places", F.posexplode("keys").alias("i", "key")).select(
        "cid", "n", "root", "slot", "key", F.element_at("places", F.col("i") + 1).alias("place"),
        F.slice("keys", F.greatest(F.col("i") - RECENT + 1, F.lit(1)), F.least(F.col("i"), F.lit(RECENT))).alias("recent"))
    spread = rows.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.min("slot").alias("slot")).filter(f"lo < hi AND slot = {turn}").select("key")
    rows = rows.join(spread, "key")
    one, two = (rows.select("key", *[F.col(c).alias(f"{c}_{x}" if c != "cid" else x) for c in ("cid", "n", "root", "slot", "place", "recent")]) for x in "ab")
    ahead = 1 + F.least(F.col("n_a") - F.col("place_a") - 1, F.col("n_b") - F.col("place_b") - 1)
    later = (F.col("slot_b") > turn) | (F.col("a") < F.col("b"))
    return (one.filter(F.col("slot_a") == turn).join(two, (one["key"] == two["key"]) & later & (F.col("root_a") != F.col("root_b"))
                     & (F.col("n_a") * 100 >= F.col("n_b") * pct) & (F.col("n_b") * 100 >= F.col("n_a") * pct)
                     & _similar(ahead, F.col("n_a"), F.col("n_b"), pct) & ~F.arrays_overlap("recent_a", "recent_b"))
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())


def _with_roots(known: DataFrame, roots: DataFrame) -> DataFrame:
    return known.join(roots.select(F.col("node").alias("cid"), "root"), "cid", "left").withColumn("root", F.coalesce("root", "cid"))


def _led(known: DataFrame, pct: int) -> DataFrame:
    """``(a, b)``: every class with those leaders of the buckets that it is in whose size is within the bound."""
    rows = known.select("cid", "n", F.explode("keys").alias("key"))
    drawn = [F.min(F.struct(F.xxhash64("cid", F.lit(salt)).alias("by"), "cid", "n")).alias(f"h{salt}") for salt in range(1, LEADERS + 1)]
    of = lambda salt: F.struct(F.col(f"h{salt}.cid").alias("leader"), F.col(f"h{salt}.n").alias("size"))
    leaders = rows.groupBy("key").agg(*drawn).select("key", F.array_distinct(F.array(*[of(salt) for salt in range(1, LEADERS + 1)])).alias("leaders"))
    met = rows.join(leaders, "key").select("cid", "n", F.inline("leaders")).filter("cid <> leader").filter(
        (F.col("n") * 100 >= F.col("size") * pct) & (F.col("size") * 100 >= F.col("n") * pct))
    return met.select(F.least("cid", "leader").alias("a"), F.greatest("cid", "leader").alias("b")).distinct()


def _joined(links: DataFrame, roots: DataFrame, base: str, name: str) -> DataFrame:
    """``roots`` after more links: components of the few roots that they connect, put in where those were."""
    of = lambda side: roots.select(F.col("node").alias(side), F.col("root").alias(f"root_{side}"))
    edges = (links.join(of("u"), "u", "left").join(of("v"), "v", "left")
             .select(F.coalesce("root_u", "u").alias("u"), F.coalesce("root_v", "v").alias("v")).filter("u <> v").distinct())
    moved = components(edges, base, name)
    new = roots.join(moved.select(F.col("node").alias("root"), F.col("root").alias("far")), "root", "left").select("node", F.coalesce("far", "root").alias("root"))
    return written(new.unionByName(moved.join(roots.select("node"), "node", "left_anti").select("node", "root")), base, f"{name}-all")


def _links(docs: DataFrame, pairs: DataFrame, known: DataFrame, k: int, pct: int, heavy: np.ndarray, base: str, name: str) -> DataFrame:
    """The links among ``pairs(a, b)``: those that pass the bound are verified on their whole sets."""
    strong = written(_strong(pairs, known, pct), base, f"{name}-pairs")
    if strong.isEmpty():
        return strong.select(F.col("a").alias("u"), F.col("b").alias("v"))
    wanted = strong.select(F.col("a").alias("cid")).unionByName(strong.select(F.col("b").alias("cid"))).distinct()
    wanted = written(wanted.join(known.select("cid", "rep"), "cid"), base, f"{name}-wanted")
    with rows_at_a_time(docs.sparkSession, TEXT_ROWS):
        segments = written(_segments(docs, wanted, k, heavy), base, f"{name}-segments")
    return written(_verified(strong, segments, pct), base, f"{name}-links")


def _rows_with_roots(docs: DataFrame, k: int, pct: int) -> DataFrame:
    """``(doc_id, tag, cid, n, root, component_id)`` of each row of ``docs(doc_id, tag, text)``; no root without shingles."""
    base = workdir(docs.sparkSession, "ngram-join")
    with rows_at_a_time(docs.sparkSession, TEXT_ROWS):
        heavy = heavy_shingles(docs, k)
        rows = written(_prefixes(docs, k, pct, heavy), base, "prefixes")
    classes = written(rows.filter("n > 0").groupBy("cid", "n").agg(F.min("doc_id").alias("rep"), F.min("prefix").alias("prefix"), F.min("bits").alias("bits")),
                      base, "classes")
    # One shuffle of the index: whether a key is of one class alone is seen where its rows lie, which spill if they are many.
    of_key = Window.partitionBy("key")
    shared = (classes.select("cid", F.posexplode("prefix").alias("place", "key"))
              .withColumn("lo", F.min("cid").over(of_key)).withColumn("hi", F.max("cid").over(of_key)).filter("lo < hi").drop("lo", "hi"))
    # Of every class its shared keys in order, with their places in the whole set.
    known = (shared.groupBy("cid").agg(F.sort_array(F.collect_list(F.struct("key", "place"))).alias("own"))
             .select("cid", F.col("own.key").alias("keys"), F.col("own.place").alias("places"))
             .join(classes.select("cid", "n", F.element_at("prefix", -1).alias("last"), "rep", "bits"), "cid"))
    known = written(known, base, "known")
    roots = components(_links(docs, _led(known, pct), known, k, pct, heavy, base, "led"), base, "roots")
    for turn in range(len(SLICES)):
        more = _links(docs, _met(known, roots, pct, turn), known, k, pct, heavy, base, f"met{turn}")
        if not more.isEmpty():
            roots = _joined(more, roots, base, f"roots{turn}")

    of_class = classes.select("cid", "n", "rep").join(roots.withColumnRenamed("node", "cid"), "cid", "left") \
        .withColumn("root", F.coalesce("root", "cid"))
    least = of_class.groupBy("root").agg(F.min("rep").alias("component_id"))
    named = of_class.join(least, "root").select("cid", "n", "root", "component_id")
    return rows.select("doc_id", "tag", "cid", "n").join(named, ["cid", "n"], "left")


def ngram_components(docs: DataFrame, k: int = 5, pct: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id``, ``n_shingles`` (set size), ``component_id`` (smallest id reachable by links).

    Two documents link when ``100 * |A and B| >= pct * |A or B|`` over their sets of ``k``-word shingles (A-Z lower-cased,
    words split at ASCII white space; fewer words: the whole text as one). Null and empty texts have no shingles and
    link with nothing: they are their own component. Rows that repeat an id are separate documents; the component
    of rows without an id is the smallest id of the others in it, or null. Other columns are ignored.
    """
    found = _rows_with_roots(columns(docs, doc_id=id_col, text=text_col).withColumn("tag", F.lit(0).cast("long")), k, pct)
    return found.select("doc_id", F.col("n").alias("n_shingles"),
                        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def one_per_component(docs: DataFrame, k: int = 5, pct: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each component the row with the smallest id (then text hash) stays.

    All columns stay; texts without words are nobody's duplicate and stay. Of rows that repeat id and text one stays.
    """
    mine = {c: f"_c{i}" for i, c in enumerate(docs.columns)}
    rows = docs.select(*[F.col(f"`{c}`").alias(a) for c, a in mine.items()], F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    rows = rows.withColumn("tag", F.xxhash64("text"))
    base = workdir(docs.sparkSession, "one-per-component")
    found = written(_rows_with_roots(rows.select("doc_id", "tag", "text"), k, pct).filter("n > 0").groupBy("root", "doc_id", "tag")
                    .agg(F.count(F.lit(1)).alias("rows")), base, "found")
    first = found.groupBy("root").agg(F.min(F.struct("doc_id", "tag")).alias("first"))
    named = written(found.join(first, "root").select("doc_id", "tag", "rows", (F.struct("doc_id", "tag").eqNullSafe(F.col("first"))).alias("stays")), base, "named")
    # Only rows that may have to go are joined; all others stay where they are read.
    key = F.xxhash64("doc_id", "tag")
    held = key_filter(named.filter("NOT stays OR rows > 1").select(key.alias("key")))
    wordy = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    keyed = rows.withColumn("_key", F.when(wordy, key))
    stay = named.filter("stays").select(F.col("doc_id").alias("_id"), F.col("tag").alias("_tag"))
    asked = scan_filtered(keyed, "_key", held).join(stay, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("tag") == F.col("_tag")))
    chosen = asked.dropDuplicates(["doc_id", "tag"]).select(*keyed.columns)
    return chosen.unionByName(scan_filtered(keyed, "_key", held, wanted=False)).select(*[F.col(a).alias(c) for c, a in mine.items()])
