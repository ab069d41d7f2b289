"""Packing documents into fixed-length token sequences by shortest-pack-first over the length histogram.

Documents become token ids in Spark tasks; a document is cut every ``size`` tokens. Only the histogram of piece lengths
(at most ``size`` rows) reaches the driver, where lengths are placed longest first, each into the shortest pack that has room,
by counts: the result is a list of packing patterns with how often each is used, at most two for each length. Pieces are ranked
within their length (by hash buckets, so that a frequent length is not one task) and joined to the patterns' places by that rank.
"""
from __future__ import annotations

import os
import unicodedata
import zlib
from functools import lru_cache
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm import bytetext as B
from sluice.llm.shared import columns, workdir, written

SIZE = 4096
END_ID = 2
TOKENIZER = "word_bpe_49k.json"
RANK_BUCKETS = 1024
CACHED_UNITS = 500_000  # about 20 MB a worker
BLOCK = 1 << 20


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path if os.path.sep in path else public_tokenizers.path(path))


class TextIds:
    """Ids of whole texts from the ids of their units, each of which the tokenizer sees once.

    Neither its normalizer nor its splitting rule joins what white space parts, nor a run of letters with a run of ASCII digits and signs, so a
    text's ids are those of its units: runs of letters and runs of other ASCII characters. Words with an apostrophe (its rule knows
    endings such as 's), a < (its special tokens begin so) or a character outside ASCII that is no letter are units as they are. Units are remembered up to a fixed number.
    """

    def __init__(self, path: str):
        self.tokenizer = _tokenizer(path)
        self._clear()

    def _clear(self) -> None:
        self.keys, self.lengths, self.starts = np.zeros(0, B.U64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.plain, self.flat = np.zeros(0, bool), np.zeros(0, np.uint32)

    def _learn(self, keys: np.ndarray, units: list[bytes]) -> None:
        if len(self.keys) + len(keys) > CACHED_UNITS:
            self._clear()
        texts = [u.decode("utf-8", "replace") for u in units]
        found = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        lengths = np.array([len(i) for i in found], np.int64)
        at = np.searchsorted(self.keys, keys)
        self.starts = np.insert(self.starts, at, len(self.flat) + np.cumsum(lengths) - lengths)
        self.lengths, self.keys = np.insert(self.lengths, at, lengths), np.insert(self.keys, at, keys)
        self.plain = np.insert(self.plain, at, [u.isascii() or unicodedata.normalize("NFC", t).lower().isalpha() for u, t in zip(units, texts, strict=True)])
        self.flat = np.concatenate([self.flat, np.array([i for ids in found for i in ids], np.uint32)])

    def _slots(self, data: np.ndarray, folded: np.ndarray, sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Where each unit is remembered; units not met before are learned."""
        keys, first, at = np.unique(B.range_hashes(folded, starts, ends, sums), return_index=True, return_inverse=True)
        place = np.searchsorted(self.keys, keys)
        new = np.ones(len(keys), bool)
        inside = place < len(self.keys)
        new[inside] = self.keys[place[inside]] != keys[inside]
        if new.any():
            raw, size = data.tobytes(), len(self.keys)
            cut = lambda which: [raw[s:e] for s, e in zip(starts[first[which]].tolist(), ends[first[which]].tolist(), strict=True)]
            if size + int(new.sum()) > CACHED_UNITS:
                self._clear()
                new[:] = True
            self._learn(keys[new], cut(new))
            place = np.searchsorted(self.keys, keys)
        return place[at]

    def of(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(ids, limits)``: the ids of all texts, and where each text's begin."""
        starts, ends, _ = B.word_spans(data, bounds)
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(bounds), np.int64)
        folded = B.LOWER[data]
        sums = B.running_sums(folded)
        signs = np.concatenate([[0], np.cumsum((data == 0x27) | (data == 0x3C))])
        whole = signs[ends] > signs[starts]
        for _ in range(2):
            opens = np.zeros(len(data) + 1, bool)
            letter = ~B.NON_LETTERS[data]
            opens[1:-1] = letter[1:] != letter[:-1]
            inside = np.zeros(len(data) + 1, np.int32)  # 1 within words that are split into units
            np.add.at(inside, starts[~whole], 1)
            np.add.at(inside, ends[~whole], -1)
            opens &= np.cumsum(inside) > 0
            opens[starts] = True
            unit_starts = np.flatnonzero(opens)
            word = np.searchsorted(starts, unit_starts, side="right") - 1
            unit_ends = np.minimum(np.append(unit_starts[1:], len(data)), ends[word])
            slots = self._slots(data, folded, sums, unit_starts, unit_ends)
            odd = np.unique(word[~self.plain[slots] & ~whole[word]])
            if not len(odd):
                break
            whole[odd] = True
        lengths = self.lengths[slots]
        to = np.cumsum(lengths)
        ids = self.flat[np.arange(to[-1]) + np.repeat(self.starts[slots] - to + lengths, lengths)]
        return ids, np.concatenate([[0], to])[np.searchsorted(unit_starts, bounds)]


@lru_cache(maxsize=2)
def _text_ids(path: str) -> TextIds:
    """One memory of units for all tasks of a worker process."""
    return TextIds(path)


def token_pieces(docs: DataFrame, tokenizer: str = TOKENIZER, size: int = SIZE, end_id: int = END_ID) -> DataFrame:
    """``(doc_id, start, length, ids_crc32, doc_tokens)``: every document's ids and ``end_id``, cut every ``size`` ids."""

    def run(batches):
        known = _text_ids(tokenizer)
        for batch in batches:
            for lo, hi, data, bounds in B.text_chunks(batch.column("text"), BLOCK):
                ids, limits = known.of(data, bounds)
                out: list[tuple] = []
                for i in range(hi - lo):
                    own = np.append(ids[limits[i]: limits[i + 1]], np.uint32(end_id)).astype("<u4")
                    for at in range(0, len(own), size):
                        part = own[at: at + size]
                        out.append((lo + i, at, len(part), zlib.crc32(part), len(own)))
                cols = list(zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array(cols[0], pa.int64())), *[pa.array(c, pa.int64()) for c in cols[1:]]],
                    names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long")


def shortest_pack_first(histogram: dict[int, int], size: int = SIZE) -> list[tuple[int, list[int]]]:
    """``[(count, lengths)]``: packing patterns and how many packs use each.

    Longest lengths first; all pieces of a length are placed at a time, into the packs with the most room left, then into new packs
    that hold as many of them as fit. A pattern is split at most once a length, which bounds the number of patterns.
    """
    open_packs: list[tuple[int, int, int, list[int]]] = []  # (-room, number, count, lengths): most room first
    done: list[tuple[int, list[int]]] = []
    number = 0

    def put(room: int, count: int, lengths: list[int]) -> None:
        nonlocal number
        if room:
            number += 1
            heappush(open_packs, (-room, number, count, lengths))
        else:
            done.append((count, lengths))

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left and open_packs and -open_packs[0][0] >= length:
            room, _, count, lengths = heappop(open_packs)
            fit = min(left, count)
            put(-room - length, fit, lengths + [length])
            if count > fit:
                put(-room, count - fit, lengths)
            left -= fit
        most = size // length
        if left >= most:
            put(size - most * length, left // most, [length] * most)
        if left % most:
            put(size - (left % most) * length, 1, [length] * (left % most))
    return done + [(count, lengths) for _, _, count, lengths in sorted(open_packs, key=lambda p: p[:2])]


def _places(patterns: list[tuple[int, list[int]]]) -> np.ndarray:
    """Rows (length, first rank, first sequence, offset), sorted: a length's pieces take its places in turn."""
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for count, lengths in patterns:
        offset = 0
        for length in lengths:
            rows.append((length, used.get(length, 0), sequence, offset))
            used[length] = used.get(length, 0) + count
            offset += length
        sequence += count
    return np.array(sorted(rows), np.int64).reshape(-1, 4)


def pack_documents(docs: DataFrame, tokenizer: str = TOKENIZER, size: int = SIZE, end_id: int = END_ID, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    Null and empty texts are one piece that holds ``end_id`` alone. Rows that repeat an id, and rows without one, are
    documents of their own. An empty table gives no rows; other columns are ignored.
    """
    base = workdir(docs.sparkSession, "packing")
    pieces = written(token_pieces(columns(docs, doc_id=id_col, text=text_col), tokenizer, size, end_id), base, "pieces")
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    places = pieces.sparkSession.sparkContext.broadcast(_places(shortest_pack_first(histogram, size)))
    # Ranks within a length: within a hash bucket by window, the buckets one after the other.
    spread = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(RANK_BUCKETS)))
    sizes = spread.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    within = Window.partitionBy("length", "bucket").orderBy("doc_id", "start", "ids_crc32", "doc_tokens")
    ranked = (spread.withColumn("rank", F.row_number().over(within) - 1).join(offsets, ["length", "bucket"])
              .withColumn("rank", F.col("rank") + F.col("before")).select(*pieces.columns, "rank"))

    carried = list(pieces.columns)

    def place(batches):
        length, first, sequence, offset = places.value.T
        for batch in batches:
            got, rank = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("length", "rank"))
            # Places are sorted by (length, first rank): the one wanted is the last that does not lie beyond.
            at = np.searchsorted(length * (1 << 44) + first, got * (1 << 44) + rank, side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in carried] + [pa.array(sequence[at] + rank - first[at]), pa.array(offset[at])],
                names=[*carried, "sequence_id", "offset"])

    kind = pieces.schema["doc_id"].dataType.simpleString()
    return ranked.mapInArrow(place, f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
