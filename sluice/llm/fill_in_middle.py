"""Fill-in-middle transformation by content-defined chunks whose summaries are remembered.

A rolling hash over the bytes cuts every text into chunks where the content says so, so passages that texts share give the same chunks. A chunk's
summary holds its tokens, its code points and whether it begins and ends with a letter; it is looked up by the chunk's own bytes, so a remembered
summary is always that of equal content. Summaries combine: a run of letters that goes on across an edge was counted twice. Running sums of
the combined counts tell the chunk in which a cut lies, and only that chunk is searched for the place.

A token is a run of A-Z and a-z, or any other single code point. Every text is a row of its own: nothing is shuffled.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm import bytetext as B
from sluice.llm.shared import columns, workdir

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
WINDOW = 16  # bytes under the rolling hash
LEAST, MOST = 64, 4096  # bytes of a chunk
CUT_BITS = 8  # an edge about every 256 bytes
BLOCK = 1 << 20  # bytes hashed at a time
MEMORY = 16 << 20  # bytes of chunks remembered by a task; then it starts anew (summaries are counted again, results don't change)

_LETTER = np.zeros(256, bool)
_LETTER[0x41:0x5B] = True
_LETTER[0x61:0x7B] = True
_POINT = (np.arange(256) & 0xC0) != 0x80  # bytes that begin a code point


def edges(data: np.ndarray) -> np.ndarray:
    """Places that the rolling hash of the ``WINDOW`` bytes before them names as chunk edges, in order."""
    found = []
    for lo in range(0, max(len(data) - WINDOW + 1, 0), BLOCK):
        rolled = B.rolling(data[lo: lo + BLOCK + WINDOW - 1], WINDOW)
        found.append(np.flatnonzero(rolled >> B.U64(64 - CUT_BITS) == 0) + lo + WINDOW)
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def chunk_ends(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(ends, first)``: ends of the chunks of all texts, and the number of chunks before each text. Empty texts have none."""
    places, ends, first = edges(data), [], [0]
    at_text = np.searchsorted(places, bounds, side="right")
    for i in range(len(bounds) - 1):
        at, end = int(bounds[i]), int(bounds[i + 1])
        for place in places[at_text[i]: at_text[i + 1]].tolist():
            while place - at > MOST:
                at += MOST
                ends.append(at)
            if place - at >= LEAST:  # also: the hash saw no byte of the text before
                ends.append(place)
                at = place
        while end - at > MOST:
            at += MOST
            ends.append(at)
        if end > at:
            ends.append(end)
        first.append(len(ends))
    return np.array(ends, np.int64), np.array(first, np.int64)


def token_starts(data: np.ndarray, first: np.ndarray | None = None) -> np.ndarray:
    """Which bytes begin a token; ``first`` are the places of chunks that know nothing of the byte before."""
    letter = _LETTER[data]
    before = np.zeros(len(data), bool)
    before[1:] = letter[:-1]
    if first is not None:
        before[first] = False
    return np.where(letter, ~before, _POINT[data])


class Memo:
    """Summaries ``(tokens, code points, begins with a letter, ends with one)`` of chunks, kept by their bytes."""

    def __init__(self, limit: int = MEMORY):
        self.limit, self.held, self.known = limit, 0, {}
        self.asked = self.counted = 0

    def of(self, raw: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        out = [self.known.get(raw[s:e]) for s, e in zip(starts.tolist(), ends.tolist(), strict=True)]
        missing = dict.fromkeys(raw[starts[i]: ends[i]] for i, got in enumerate(out) if got is None)
        self.asked += len(out)
        if missing:
            self.counted += len(missing)
            fresh = dict(zip(missing, _summaries(list(missing)), strict=True))
            out = [fresh[raw[starts[i]: ends[i]]] if got is None else got for i, got in enumerate(out)]
            size = sum(map(len, missing))
            if self.held + size > self.limit:
                self.known, self.held = {}, 0
            if size <= self.limit:
                self.known.update(fresh)
                self.held += size
        return np.array(out, np.int64).reshape(-1, 4)


def _summaries(chunks: list[bytes]) -> list[tuple]:
    data = np.frombuffer(b"".join(chunks), np.uint8)
    ends = np.cumsum([len(c) for c in chunks])
    starts = ends - [len(c) for c in chunks]
    tokens = np.add.reduceat(token_starts(data, starts).astype(np.int64), starts)
    points = np.add.reduceat(_POINT[data].astype(np.int64), starts)
    return list(zip(tokens.tolist(), points.tolist(), _LETTER[data[starts]].tolist(), _LETTER[data[ends - 1]].tolist(), strict=True))


class Counted:
    """The chunks of a block of texts with their combined counts."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, memo: Memo):
        self.data, self.bounds, self.raw = data, bounds, data.tobytes()
        self.ends, self.first = chunk_ends(data, bounds)
        self.starts = np.concatenate([[0], self.ends[:-1]]) if len(self.ends) else self.ends
        tokens, points, begins, stops = memo.of(self.raw, self.starts, self.ends).T
        self.goes_on = np.zeros(len(self.ends), np.int64)
        self.goes_on[1:] = begins[1:] & stops[:-1]
        self.goes_on[self.first[:-1][np.diff(self.first) > 0]] = 0
        self.tokens = np.concatenate([[0], np.cumsum(tokens - self.goes_on)])
        self.points = np.concatenate([[0], np.cumsum(points)])

    def size(self, text: int) -> int:
        return int(self.tokens[self.first[text + 1]] - self.tokens[self.first[text]])

    def place(self, text: int, token: int) -> tuple[int, int]:
        """``(byte, code points before)`` of a text's token; one token further than there are, the text's end."""
        lo, hi = self.first[text], self.first[text + 1]
        wanted = self.tokens[lo] + token
        if wanted >= self.tokens[hi]:
            return int(self.bounds[text + 1]), int(self.points[hi] - self.points[lo])
        chunk = int(np.searchsorted(self.tokens, wanted, side="right")) - 1
        inside = self.data[self.starts[chunk]: self.ends[chunk]]
        nth = wanted - self.tokens[chunk] + self.goes_on[chunk]
        at = int(np.flatnonzero(token_starts(inside))[nth])
        return int(self.starts[chunk]) + at, int(self.points[chunk] - self.points[lo]) + int(_POINT[inside[:at]].sum())


def draws(id_col: Column, seed: int) -> list[Column]:
    """Four unsigned 32-bit numbers of a document: the first groups of eight digits of ``sha256("<seed>:<id>")`` (no id: nothing after the colon)."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 1, plain_pct: int = 10, spm_pct: int = 20) -> DataFrame:
    """One row per document: ``doc_id, n, form, prefix_chars, middle_chars, output``.

    ``plain_pct`` percent of the documents stay as they are; of the others ``spm_pct`` percent have their suffix first. Null and empty texts, and texts that
    hold a marker, are ``plain``, with null lengths; a null text's output is empty. Rows that repeat an id get the same draws, each on its
    own text. An empty table gives no rows; other columns are ignored.
    """
    workdir(docs.sparkSession, "fim")
    marks = {k: v.encode() for k, v in (("p", PREFIX), ("s", SUFFIX), ("m", MIDDLE))}
    numbers = ["h1", "h2", "h3", "h4"]
    rows = columns(docs, doc_id=id_col, text=text_col)
    rows = rows.select("doc_id", "text", *[h.alias(c) for h, c in zip(draws(F.col("doc_id"), seed), numbers, strict=True)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = Memo()
        for batch in batches:
            drawn = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in numbers], axis=1).astype(np.int64).tolist()
            for lo, hi, data, bounds in B.text_chunks(batch.column("text"), BLOCK):
                counted = Counted(data, bounds, memo)
                raw, out = counted.raw, []
                for i in range(hi - lo):
                    h1, h2, h3, h4 = drawn[lo + i]
                    begin, end, n = int(bounds[i]), int(bounds[i + 1]), counted.size(i)
                    if begin == end or h3 % 100 >= 100 - plain_pct or any(raw.find(m, begin, end) >= 0 for m in marks.values()):
                        out.append((n, "plain", None, None, raw[begin:end]))
                        continue
                    cuts = sorted((h1 % (n + 1), h2 % (n + 1)))
                    (a, chars_a), (b, chars_b) = (counted.place(i, c) for c in cuts)
                    pre, mid, suf = raw[begin:a], raw[a:b], raw[b:end]
                    spm = h4 % 100 < spm_pct
                    order = (marks["s"], suf, marks["p"], pre) if spm else (marks["p"], pre, marks["s"], suf)
                    out.append((n, "spm" if spm else "psm", chars_a, chars_b - chars_a, b"".join((*order, marks["m"], mid))))
                cols = list(zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(lo, hi - lo), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.string()),
                     pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.int64()), pa.array(cols[4], pa.binary()).cast(pa.string())],
                    names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made of: its parts lie between markers that the text itself doesn't hold."""
    parts = F.split(output, "|".join((PREFIX, SUFFIX, MIDDLE)))
    psm = F.concat(parts.getItem(1), parts.getItem(3), parts.getItem(2))
    spm = F.concat(parts.getItem(2), parts.getItem(3), parts.getItem(1))
    return F.when(form == "plain", output).when(form == "psm", psm).otherwise(spm)
