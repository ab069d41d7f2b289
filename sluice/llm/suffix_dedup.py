"""Exact substring deduplication over a range-partitioned sparse suffix order.

Every byte covered by a ``WIDTH``-byte string that also starts elsewhere is removed.

1. Windows of WIDTH bytes are named by the least hash among their GRAM-byte strings, so equal windows have the same anchor at
   the same place. A text becomes runs of neighbouring windows with one anchor (about one run for 80 bytes), each with a digest
   of all bytes under it. Anchors that occur once, and don't repeat within their run, can't belong to a repeat.
2. Runs that share anchor and digest are repeats as a whole. Where an anchor has several digests, one run of each is cut
   out of its text: its suffixes start where the windows do.
3. Those suffixes are range-partitioned by the leading tokens at their anchor, with sampled splitters that never part equal ones,
   so no comparison crosses a boundary; each bucket is sorted locally key by key (leading bytes, then the digest of
   the WIDTH-byte prefix) and equal neighbours are repeats. Anchors with very many different runs would fill one bucket: their
   windows are dealt out by digest instead and counted there, with the same result.
4. The byte ranges found are united per text and cut out.
"""
from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm import bytetext as B
from sluice.llm.shared import columns, key_filter, may_hold, scan_filtered, workdir, written

WIDTH = 200
GRAM = 80
STEPS = WIDTH - GRAM + 1  # strings of GRAM bytes in a window
RUN = 128  # windows in a run at most
HOT = 4096  # different runs of one anchor, from which on its windows are dealt out by digest
BLOCK = 1 << 20


def _sliding(values: np.ndarray, size: int, pick, pad) -> np.ndarray:
    """``pick`` (np.minimum or np.maximum) over each ``size`` consecutive values, by running picks of blocks in both directions."""
    n = len(values) - size + 1
    if n <= 0:
        return values[:0]
    full = np.concatenate([values, np.full(-len(values) % size, pad, values.dtype)]).reshape(-1, size)
    ahead = pick.accumulate(full, axis=1).ravel()
    back = np.ascontiguousarray(pick.accumulate(full[:, ::-1], axis=1)[:, ::-1]).ravel()
    return pick(back[:n], ahead[size - 1: size - 1 + n])


def text_runs(data: np.ndarray, bounds: np.ndarray):
    """Runs of all texts of a chunk: ``(anchor, digest, first, last, again)``; ``first`` and ``last`` window start in ``data``,
    ``again``: the anchor may occur twice within the run."""
    none = np.zeros(0, np.int64)
    if len(data) < WIDTH:
        return np.zeros(0, B.U64), np.zeros(0, B.U64), none, none, np.zeros(0, bool)
    sums = B.running_sums(data)
    at = np.arange(len(data) - GRAM + 1)
    grams = B.range_hashes(data, at, at + GRAM, sums)
    least = _sliding(grams, STEPS, np.minimum, np.iinfo(np.uint64).max)
    valid = np.flatnonzero(np.arange(len(least)) + WIDTH <= np.repeat(bounds[1:], np.diff(bounds))[: len(least)])
    if not len(valid):
        return np.zeros(0, B.U64), np.zeros(0, B.U64), none, none, np.zeros(0, bool)
    opens = np.ones(len(valid), bool)
    opens[1:] = (np.diff(valid) != 1) | (least[valid[1:]] != least[valid[:-1]])
    start = np.maximum.accumulate(np.where(opens, np.arange(len(valid)), 0))
    opens |= (np.arange(len(valid)) - start) % RUN == 0
    first = valid[opens]
    last = valid[np.append(np.flatnonzero(opens)[1:], len(valid)) - 1]
    # Strings that are the least of some window, and which of them come twice within a run's reach.
    most = _sliding(np.concatenate([np.zeros(STEPS - 1, B.U64), least, np.zeros(STEPS - 1, B.U64)]), STEPS, np.maximum, 0)
    chosen = np.flatnonzero(grams == most[: len(grams)])
    twice, lag = np.zeros(len(grams) + 1, np.int64), 1
    while lag < len(chosen):
        near = chosen[lag:] - chosen[:-lag] < RUN
        if not near.any():
            break
        twice[chosen[:-lag][near & (grams[chosen[lag:]] == grams[chosen[:-lag]])]] = 1
        lag += 1
    count = np.concatenate([[0], np.cumsum(twice[:-1])])
    again = count[np.minimum(last + STEPS, len(grams))] > count[first]
    return least[first], B.range_hashes(data, first, last + WIDTH, sums), first, last, again


def _scan(batches):
    for batch in batches:
        tids = batch.column("tid")
        for lo, _, data, bounds in B.text_chunks(batch.column("text")):
            anchor, digest, first, last, again = text_runs(data, bounds)
            doc = np.searchsorted(bounds, first, side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchor.view(np.int64)), pa.array(digest.view(np.int64)), tids.take(pa.array(doc + lo)),
                 pa.array((first - bounds[doc]).astype(np.int32)), pa.array((last - bounds[doc]).astype(np.int32)), pa.array(again)],
                names=["anchor", "digest", "tid", "first", "last", "again"])


def _cut_out(batches):
    """The bytes under each wanted run, with the leading tokens at its anchor."""
    for batch in batches:
        data, offsets = B.buffers(batch.column("text"))
        rows = []
        for i, wanted in enumerate(batch.column("runs").to_pylist()):
            text = data[offsets[i]: offsets[i + 1]]
            for r in wanted:
                part = text[r["first"]: r["last"] + WIDTH]
                if len(part) < WIDTH:
                    continue  # another text with the same hash
                at = np.arange(len(part) - GRAM + 1)
                place = np.flatnonzero(B.range_hashes(part, at, at + GRAM).view(np.int64) == r["anchor"])
                if len(place):
                    lead = int.from_bytes(part[place[0]: place[0] + 8].tobytes(), "big") - (1 << 63)
                    rows.append((lead, r["anchor"], r["digest"], r["tid"], r["first"], r["many"], r["hot"], part.tobytes()))
            if len(rows) > 4096:
                yield pa.RecordBatch.from_pylist([dict(zip(SEGMENT.names, r, strict=True)) for r in rows], schema=SEGMENT)
                rows = []
        yield pa.RecordBatch.from_pylist([dict(zip(SEGMENT.names, r, strict=True)) for r in rows], schema=SEGMENT)


_RANGES = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))
SEGMENT = pa.schema([("lead", pa.int64()), ("anchor", pa.int64()), ("digest", pa.int64()), ("tid", pa.int64()), ("first", pa.int32()),
                     ("many", pa.bool_()), ("hot", pa.bool_()), ("part", pa.binary())])
_SEGMENT_SQL = "lead long, anchor long, digest long, tid long, first int, many boolean, hot boolean, part binary"


def _suffixes(parts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(row, start, lead, digest)`` of all suffixes of cut-out runs that are WIDTH bytes long or more."""
    data, offsets = B.buffers(parts)
    data, offsets = data[offsets[0]: offsets[-1]], offsets - offsets[0]
    n = np.maximum(np.diff(offsets) - WIDTH + 1, 0)
    row = np.repeat(np.arange(len(n)), n)
    start = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    at = offsets[row] + start
    lead = np.zeros(len(at), B.U64)
    for i in range(8):
        lead = (lead << B.U64(8)) | data[at + i].astype(B.U64)
    return row, start, lead, B.range_hashes(data, at, at + WIDTH)


def _sorted_buckets(batches):
    """Repeated windows of the runs of a bucket, as byte ranges of their texts; runs of one anchor come one after the other."""
    names = ["tid", "a", "b"]

    def finish(rows: pa.Table):
        rows = rows.combine_chunks()
        keys = np.stack([rows.column(c).to_numpy() for c in ("anchor", "digest")])
        _, once = np.unique(keys, axis=1, return_index=True)  # rows that repeat id and text cut out the same run again
        rows = rows.take(pa.array(np.sort(once)))
        row, start, lead, digest = _suffixes(rows.column("part").combine_chunks())
        order = np.lexsort((digest, lead))
        same = np.zeros(len(order) + 1, bool)
        same[1:-1] = (lead[order[1:]] == lead[order[:-1]]) & (digest[order[1:]] == digest[order[:-1]])
        repeat = np.zeros(len(order), bool)
        repeat[order] = same[1:] | same[:-1]
        repeat &= ~rows.column("many").to_numpy(zero_copy_only=False).astype(bool)[row]
        hit = np.flatnonzero(repeat)
        opens = np.ones(len(hit), bool)
        opens[1:] = (np.diff(hit) != 1) | (np.diff(row[hit]) != 0)
        ends = np.append(np.flatnonzero(opens)[1:], len(hit))[: opens.sum()] - 1
        base = rows.column("first").to_numpy()[row[hit[opens]]]
        return pa.RecordBatch.from_arrays(
            [rows.column("tid").combine_chunks().take(pa.array(row[hit[opens]])), pa.array((base + start[hit[opens]]).astype(np.int32)),
             pa.array((base + start[hit[ends]] + WIDTH).astype(np.int32))], names=names)

    held = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        held = rows if held is None else pa.concat_tables([held, rows])
        if held.column("part").nbytes < BLOCK:
            continue
        anchors = held.column("anchor").to_numpy()
        cut = int(np.searchsorted(anchors == anchors[-1], True)) if len(anchors) else 0
        if cut:
            yield finish(held.slice(0, cut))
            held = held.slice(cut)
    if held is not None and held.num_rows:
        yield finish(held)


def _dealt_windows(batches):
    for batch in batches:
        row, start, lead, digest = _suffixes(batch.column("part"))
        first = batch.column("first").to_numpy(zero_copy_only=False)
        yield pa.RecordBatch.from_arrays(
            [pa.array(B.mix(digest ^ B.mix(lead)).view(np.int64)), batch.column("tid").take(pa.array(row)), pa.array((first[row] + start).astype(np.int32)),
             batch.column("many").take(pa.array(row))], names=["window", "tid", "a", "many"])


def _kept(batches):
    """What is left of each text without its ranges."""
    for batch in batches:
        data, offsets = B.buffers(batch.column("text"))
        out = []
        ranges = batch.column("ranges").to_pylist()
        for i, own in enumerate(ranges):
            text = data[offsets[i]: offsets[i + 1]]
            cover = np.zeros(len(text) + 1, np.int64)
            for r in own or ():
                if r["b"] <= len(text):
                    cover[r["a"]] += 1
                    cover[r["b"]] -= 1
            gone = np.cumsum(cover[:-1]) > 0
            spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
            out.append((len(text), int(gone.sum()), spans, hashlib.sha256(text[~gone].tobytes() if spans else text.tobytes()).hexdigest()))
        cols = list(zip(*out, strict=True)) or [[]] * 4
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *[pa.array(c, pa.int64()) for c in cols[:3]], pa.array(cols[3], pa.string())],
                                         names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` (of the bytes that are left).

    Texts are UTF-8 bytes; strings are judged on the input, and no match crosses documents. Null texts are empty: nothing is removed, as in all texts
    under WIDTH bytes. Rows that repeat a text remove it from each other, whatever their ids. An empty table gives no rows.
    """
    base = workdir(docs.sparkSession, "suffix")
    # A text's ranges are found by its hash, not by an id that may be null or repeat.
    rows = columns(docs, doc_id=id_col, text=text_col).withColumn("text", F.coalesce("text", F.lit(""))).withColumn("tid", F.xxhash64("text"))
    runs = rows.select("tid", "text").mapInArrow(_scan, "anchor long, digest long, tid long, first int, last int, again boolean").repartition("anchor")
    # Every column takes part, so that both uses read the same shuffle.
    met = runs.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"), F.min("digest").alias("lo"), F.max("digest").alias("hi"), F.max("again").alias("any"),
                                     F.min(F.struct("tid", "first", "last")).alias("_least"))
    met = met.filter("n > 1 OR any").filter("_least IS NOT NULL").select("anchor", (F.expr("lo < hi OR any")).alias("mixed"))
    found = written(runs.join(met, "anchor"), base, "runs")

    classes = (found.filter("mixed").groupBy("anchor", "digest")
               .agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("tid", "first", "last")).alias("rep")))
    classes = written(classes.select("anchor", "digest", (F.col("n") > 1).alias("many"), "rep.*"), base, "classes")
    hot = classes.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).select("anchor", (F.col("n") > HOT).alias("hot"))
    ids = rows.groupBy("tid").agg(F.min("doc_id").alias("rep_id"))
    wanted = classes.join(hot, "anchor").groupBy("tid").agg(F.collect_list(F.struct("anchor", "digest", "tid", "first", "last", "many", "hot")).alias("runs"))
    wanted = wanted.join(ids, "tid")
    # Written in between, so that no task runs two Python stages at a time.
    texts = written(scan_filtered(rows, "tid", key_filter(classes.select("tid"))), base, "texts")
    texts = texts.join(wanted, (texts["tid"] == wanted["tid"]) & texts["doc_id"].eqNullSafe(wanted["rep_id"])).select("text", "runs")
    parts = written(texts.mapInArrow(_cut_out, _SEGMENT_SQL), base, "parts")
    ordered = parts.filter("NOT hot").repartitionByRange("lead", "anchor").sortWithinPartitions("lead", "anchor")
    sorted_ranges = ordered.mapInArrow(_sorted_buckets, "tid long, a int, b int")
    windows = parts.filter("hot").dropDuplicates(["anchor", "digest"]).mapInArrow(_dealt_windows, "window long, tid long, a int, many boolean")
    windows = written(windows, base, "windows")
    repeated = windows.groupBy("window").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("window")
    dealt_ranges = windows.filter("NOT many").join(repeated, "window").select("tid", "a", (F.col("a") + WIDTH).alias("b"))
    whole = found.join(classes.filter("many").select("anchor", "digest", F.lit(True).alias("many")), ["anchor", "digest"], "left").filter("NOT mixed OR many")
    ranges = (whole.select("tid", F.col("first").alias("a"), (F.col("last") + WIDTH).alias("b")).unionByName(sorted_ranges).unionByName(dealt_ranges)
              .groupBy("tid").agg(F.collect_set(F.struct("a", "b")).alias("ranges")))
    ranges = written(ranges, base, "ranges")
    held = key_filter(ranges.select("tid"))
    touched = written(scan_filtered(rows, "tid", held), base, "touched").join(ranges, "tid", "left").select("doc_id", "text", "ranges")

    def untouched(batches):
        """Texts that surely have no range are hashed where they are read."""
        for batch in batches:
            some = may_hold(held.value, batch.column("tid").to_numpy(zero_copy_only=False).astype(np.int64))
            rest = batch.filter(pa.array(~some))
            yield from _kept([pa.RecordBatch.from_arrays([rest.column("doc_id"), rest.column("text"), pa.nulls(rest.num_rows, _RANGES)],
                                                         names=["doc_id", "text", "ranges"])])

    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return touched.mapInArrow(_kept, schema).unionByName(rows.mapInArrow(untouched, schema))
