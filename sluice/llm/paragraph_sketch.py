"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests.

A text is cut at line breaks, and lines at content-defined words (one in eight), into pieces that tile it; every piece
has a 64-bit digest, the n-th repeat of a piece one of its own. The sketch adds each digest to one cell in each of three parts (count, digests xored,
checks xored). A part has a power of two of cells, at least one for two digests, doubled until peeling the sketch gives
back all its digests; that sketch is the fingerprint. A wide sketch folds to a narrow one by adding its halves, so sketches of any two
versions subtract, cell by cell, at the narrower width, and peeling cells that hold one digest recovers the digests in which they
differ. Where that fails, both are sketched anew, twice as wide as the wider one, until it succeeds: their digests are at hand, since each
fingerprint gives back its own. So the likeness follows from the two fingerprints alone (``likeness_of``).

All sketches of a block of texts are built, folded, subtracted and peeled together, as one array of cells.
"""
from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.context import scan_partitions
from sluice.llm import bytetext as B
from sluice.llm.shared import columns, workdir

WIDTH = 4  # least cells in each of the three parts of a sketch
PARTS = 3
CELL = 14  # bytes of a printed cell: two for the count, eight and four for the xored digests and checks
ROUNDS = 500  # of peeling; checks that meet by chance would go round for ever
_MARK = B.U64(7)  # a word with these hash bits zero ends a piece
_SEEDS = np.array([0x243F6A8885A308D3, 0x13198A2E03707344, 0xA4093822299F31D0], B.U64)
_CHECK = B.U64(0x452821E638D01377)
BLOCK = 1 << 20


def piece_digests(texts: list[bytes]) -> list[np.ndarray]:
    """The digests of each text's pieces, sorted; repeats within a text are told apart."""
    bounds = np.cumsum([0] + [len(t) for t in texts])
    data = np.frombuffer(b"".join(texts), np.uint8)
    starts, ends, first = B.word_spans(data, bounds)
    hashes = B.range_hashes(data, starts, ends)
    doc = np.searchsorted(bounds, starts, side="right") - 1
    breaks = np.cumsum(data == 0x0A)
    opens = np.ones(len(starts), bool)
    if len(starts):
        line = breaks[starts]
        opens[1:] = ((hashes[:-1] & _MARK) == 0) | (line[1:] != line[:-1]) | (doc[1:] != doc[:-1])
        head = np.ones(len(starts), bool)
        head[1:] = doc[1:] != doc[:-1]
        starts = np.where(head, bounds[doc], starts)
    # A text of white space alone is one piece.
    blank = np.flatnonzero((np.diff(first) == 0) & (np.diff(bounds) > 0))
    at = np.sort(np.concatenate([starts[opens], bounds[blank]]).astype(np.int64))
    of = np.searchsorted(bounds, at, side="right") - 1
    to = np.minimum(np.append(at[1:], len(data)), bounds[of + 1]) if len(at) else at
    digests = B.range_hashes(data, at, to)
    limits = np.searchsorted(of, np.arange(len(texts) + 1))
    out = []
    for i in range(len(texts)):
        d = np.sort(digests[limits[i]: limits[i + 1]])
        if len(d) > 1 and (d[1:] == d[:-1]).any():
            nth = np.arange(len(d)) - np.searchsorted(d, d)
            d = np.sort(np.where(nth > 0, B.mix(d + nth.astype(B.U64) * B.U64(0x9E3779B97F4A7C15)), d))
        out.append(d)
    return out


def _sums(at: np.ndarray, counts: np.ndarray, keys: np.ndarray, checks: np.ndarray):
    """What falls into each cell: ``(cells, counts added, keys xored, checks xored)``."""
    order = np.argsort(at, kind="stable")
    at = at[order]
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    return at[first], np.add.reduceat(counts[order], first), np.bitwise_xor.reduceat(keys[order], first), np.bitwise_xor.reduceat(checks[order], first)


class Sketches:
    """The sketches of several texts, one behind the other, each with a power of two of cells in its parts."""

    def __init__(self, widths: np.ndarray):
        self.widths = np.asarray(widths, np.int64)
        self.base = np.concatenate([[0], np.cumsum(PARTS * self.widths)])
        self.text = np.repeat(np.arange(len(self.widths)), PARTS * self.widths)
        self.count, self.key, self.check = np.zeros(self.base[-1], np.int64), np.zeros(self.base[-1], B.U64), np.zeros(self.base[-1], np.uint32)

    def _add(self, at: np.ndarray, counts: np.ndarray, keys: np.ndarray, checks: np.ndarray) -> np.ndarray:
        if not len(at):
            return at
        cells, n, k, c = _sums(at, counts, keys, checks)
        self.count[cells] += n
        self.key[cells] ^= k
        self.check[cells] ^= c
        return cells

    def toggle(self, text: np.ndarray, digests: np.ndarray, sign: np.ndarray) -> np.ndarray:
        """Adds digests to their texts' sketches (sign 1) or takes them away (-1); gives the cells met."""
        width = self.widths[text]
        at = [self.base[text] + j * width + (B.mix(digests ^ _SEEDS[j]).astype(np.int64) & (width - 1)) for j in range(PARTS)]
        return self._add(np.concatenate(at), np.tile(sign, PARTS), np.tile(digests, PARTS), np.tile(_checks(digests), PARTS))

    def folded(self, widths: np.ndarray) -> "Sketches":
        """The same sketches in fewer cells (or as many)."""
        out = Sketches(widths)
        inside = np.arange(len(self.count)) - self.base[self.text]
        part, place = inside // self.widths[self.text], inside % self.widths[self.text]
        out._add(out.base[self.text] + part * out.widths[self.text] + (place & (out.widths[self.text] - 1)), self.count, self.key, self.check)
        return out

    def chosen(self, texts: np.ndarray) -> "Sketches":
        """The sketches of some texts, in that order."""
        out = Sketches(self.widths[texts])
        cells = self.base[texts][out.text] + np.arange(len(out.count)) - out.base[out.text]
        out.count, out.key, out.check = self.count[cells], self.key[cells], self.check[cells]
        return out

    def minus(self, other: "Sketches") -> "Sketches":
        out = Sketches(self.widths)
        out.count, out.key, out.check = self.count - other.count, self.key ^ other.key, self.check ^ other.check
        return out

    def peeled(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """``(whole, text, digest, sign)``: which sketches came apart entirely, and the digests recovered, with sign 1 for the first side's.

        Empties the sketches. Only cells that the last round changed can have become pure.
        """
        found: list[tuple] = []
        cells = np.arange(len(self.count))
        for _ in range(ROUNDS):
            cells = cells[np.abs(self.count[cells]) == 1]
            cells = cells[self.check[cells] == _checks(self.key[cells])]
            if not len(cells):
                break
            text, key, sign = self.text[cells], self.key[cells], self.count[cells]
            order = np.lexsort((key, text))
            text, key, sign = text[order], key[order], sign[order]
            once = np.concatenate([[True], (text[1:] != text[:-1]) | (key[1:] != key[:-1])])
            text, key, sign = text[once], key[once], sign[once]
            found.append((text, key, sign))
            cells = self.toggle(text, key, -sign)
        left = (self.count != 0) | (self.key != 0) | (self.check != 0)
        whole = np.bincount(self.text[left], minlength=len(self.widths)) == 0
        none = (np.zeros(0, np.int64), np.zeros(0, B.U64), np.zeros(0, np.int64))
        return (whole, *(np.concatenate(c) for c in zip(none, *found, strict=True)))

    def printed(self) -> list[str]:
        raw = np.zeros((len(self.count), CELL), np.uint8)
        raw[:, :2] = self.count.astype("<i2").view(np.uint8).reshape(-1, 2)
        raw[:, 2:10] = self.key.astype("<u8").view(np.uint8).reshape(-1, 8)
        raw[:, 10:] = self.check.astype("<u4").view(np.uint8).reshape(-1, 4)
        return [base64.b64encode(raw[a:b].tobytes()).decode() for a, b in zip(self.base[:-1].tolist(), self.base[1:].tolist(), strict=True)]


def _checks(digests: np.ndarray) -> np.ndarray:
    return (B.mix(digests + _CHECK) >> B.U64(32)).astype(np.uint32)


def _flat(digests: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    return np.repeat(np.arange(len(digests)), [len(d) for d in digests]), np.concatenate([np.zeros(0, B.U64), *digests])


def _sketched(digests: list[np.ndarray], widths: np.ndarray) -> Sketches:
    out = Sketches(widths)
    text, flat = _flat(digests)
    out.toggle(text, flat, np.ones(len(flat), np.int64))
    return out


def sketches(digests: list[np.ndarray]) -> Sketches:
    """A sketch for each text, wide enough to give back all its digests."""
    widths = np.maximum(WIDTH, 1 << np.ceil(np.log2(np.maximum([len(d) for d in digests], 1) / 2)).clip(0).astype(np.int64))
    open_ = np.arange(len(digests))
    while len(open_):
        whole = _sketched([digests[i] for i in open_], widths[open_]).peeled()[0]
        open_ = open_[~whole]
        widths[open_] *= 2
    return _sketched(digests, widths)


def differences(digests: list[np.ndarray], own: Sketches, one: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(pair, digest, sign)``: the digests in which the texts ``one[i]`` and ``two[i]`` differ (sign 1: only the first has it)."""
    width = np.minimum(own.widths[one], own.widths[two])
    whole, pair, key, sign = own.chosen(one).folded(width).minus(own.chosen(two).folded(width)).peeled()
    sure = whole[pair]
    found = [(pair[sure], key[sure], sign[sure])]
    open_, width = np.flatnonzero(~whole), 2 * np.maximum(own.widths[one], own.widths[two])
    while len(open_):
        wide = Sketches(width[open_])
        for side, s in ((one, 1), (two, -1)):
            at, flat = _flat([digests[i] for i in side[open_]])
            wide.toggle(at, flat, np.full(len(flat), s))
        whole, pair, key, sign = wide.peeled()
        sure = whole[pair]
        found.append((open_[pair[sure]], key[sure], sign[sure]))
        open_ = open_[~whole]
        width *= 2
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))


def likenesses(digests: list[np.ndarray], own: Sketches, one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Shared share of two digest sets each: shared over all different; two empty texts are alike."""
    differ = np.bincount(differences(digests, own, one, two)[0], minlength=len(one))
    sizes = np.array([len(d) for d in digests], np.int64)
    both = sizes[one] + sizes[two]
    return np.where(both > 0, (both - differ) / np.maximum(both + differ, 1), 1.0)


def difference(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Digests only in ``a`` and only in ``b``, recovered from their sketches."""
    _, key, sign = differences([a, b], sketches([a, b]), np.array([0]), np.array([1]))
    return key[sign > 0], key[sign < 0]


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float(likenesses([a, b], sketches([a, b]), np.array([0]), np.array([1]))[0])


def digests_of(fingerprint: str) -> np.ndarray:
    """The digests that a printed sketch gives back, sorted."""
    raw = np.frombuffer(base64.b64decode(fingerprint), np.uint8).reshape(-1, CELL)
    held = Sketches(np.array([len(raw) // PARTS]))
    held.count = raw[:, :2].copy().view("<i2").ravel().astype(np.int64)
    held.key = raw[:, 2:10].copy().view("<u8").ravel().astype(B.U64)
    held.check = raw[:, 10:].copy().view("<u4").ravel().astype(np.uint32)
    whole, _, key, _ = held.peeled()
    if not whole.all():
        raise ValueError("no fingerprint of this kind")
    return np.sort(key)


def likeness_of(one: str, two: str) -> float:
    """The likeness of two printed fingerprints, from them alone."""
    return likeness(digests_of(one), digests_of(two))


def edited(text: str, following: str) -> str:
    """``text`` with its last half replaced by as many first characters of the following one (or all)."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _ranges(docs: DataFrame) -> list[int]:
    """Some ids that occur, ascending from the first on: each opens a range of about as many rows."""
    n = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")), scan_partitions(docs))
    found = docs.agg(F.percentile_approx("key", [i / n for i in range(n)], 10_000).alias("at"), F.min("key").alias("least")).first()
    return sorted({found["least"], *found["at"]}) if found["at"] else []


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``.

    Null texts are empty; equal texts have equal fingerprints, and two empty ones a likeness of 1. The next document is the one
    with the next id, rows that repeat an id following each other by text; rows without id come first; after the last
    comes the first, so a table of one row is its own next. Ids must be integers. An empty table gives no rows.
    """
    workdir(docs.sparkSession, "sketch")
    kind = docs.schema[id_col].dataType
    rows = columns(docs, doc_id=id_col, text=text_col).select(
        "doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("key"), F.coalesce("text", F.lit("")).alias("text"))
    opens = np.array(_ranges(rows.select("key")) or [0], np.int64)
    n = len(opens)

    def dealt(batches):
        """Adds each row's range, and the rows that open a range once more as guests at the end of the one before."""
        for batch in batches:
            keys = batch.column("key").to_numpy(zero_copy_only=False)
            at = np.maximum(np.searchsorted(opens, keys, side="right") - 1, 0)
            guests = np.flatnonzero(opens[at] == keys)
            order = np.concatenate([np.arange(len(keys)), guests])
            spot = np.concatenate([at, (at[guests] - 1) % n]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(spot), pa.array(np.arange(len(order)) >= len(keys)), *[batch.column(c).take(pa.array(order)) for c in ("doc_id", "key", "text")]],
                names=["spot", "guest", "doc_id", "key", "text"])

    def told(batches):
        """Each row with its successor, which is the next row of its range or the range's guest."""
        def finish(block):
            m = len(block)
            changed = [edited(text, after) for _, _, text, after in block]
            # The next row's text is at hand where it is the next of the block.
            alone = [i for i in range(m) if i + 1 == m or block[i + 1][2] != block[i][3]]
            texts = [*(r[2] for r in block), *changed, *(block[i][3] for i in alone)]
            follows = np.arange(1, m + 1)
            follows[alone] = 2 * m + np.arange(len(alone))
            digests = piece_digests([t.encode() for t in texts])
            held = sketches(digests)
            prints = held.chosen(np.arange(2 * m)).printed()
            near = [likenesses(digests, held, np.arange(m), other).tolist() for other in (np.arange(m, 2 * m), follows)]
            out = [(doc_id, len(text), hashlib.sha256(changed[i].encode()).hexdigest(), prints[i], prints[m + i], near[0][i], near[1][i])
                   for i, (doc_id, _, text, _) in enumerate(block)]
            cols = list(zip(*out, strict=True))
            kinds = [ids, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=names)

        names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
        last, block, size, ids = None, [], 0, pa.int64()
        for batch in batches:
            ids = batch.schema.field("doc_id").type
            for spot, guest, doc_id, text in zip(*(batch.column(c).to_pylist() for c in ("spot", "guest", "doc_id", "text")), strict=True):
                if last is not None and last[1] == spot and not last[4]:
                    block.append((last[2], spot, last[3], text))
                    size += len(last[3])
                # Only the first guest of a range is anyone's next row.
                last = (None, spot, doc_id, text, guest)
                if size >= BLOCK:
                    yield finish(block)
                    block, size = [], 0
        if block:
            yield finish(block)

    keyed = rows.mapInArrow(dealt, f"spot int, guest boolean, doc_id {kind.simpleString()}, key long, text string")
    ranged = keyed.repartitionById(n, F.col("spot")) if hasattr(keyed, "repartitionById") else keyed.repartition(n, "spot")
    return ranged.sortWithinPartitions("spot", "guest", "key", "text").mapInArrow(
        told, f"doc_id {kind.simpleString()}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
              "near_edited double, near_next double")
