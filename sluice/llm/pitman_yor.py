"""Language-model scores from a hierarchical Pitman-Yor model with sampled seating.

Two levels of restaurants: one for each context (the preceding word, by its whole 64-bit hash), all sharing one root restaurant over
words, whose base is uniform over the vocabulary and one unknown word. The customers of a context are its training tokens, and
its tables are the customers of the root. Seating is sampled by Gibbs sweeps: a dish's customers are seated again one after the
other (where there are very many, by blocks of an eighth of those seated) given all other tables, whose totals are exchanged between
sweeps. Predictive probabilities are averaged over the kept sweeps, and a text's score is the sum of their log10.

Pairs of context and word are counted per chunk of texts and shuffled by word hash to buckets, which seat all dishes of their words.
A bucket's seating is a row of a written table, and each sweep is one pass over it, joined with the totals of the contexts that the
bucket meets: a sum per context over the buckets' own totals, so that a context is one row a bucket however many tokens it has.
Words with more than a thousandth of all tokens (a thousand at most) are dealt out by word and context instead, their
totals summed with the rest; nothing else reaches the driver. Random numbers are hashes of word, context and sweep: seatings
are the same whatever the number of buckets, partitions or attempts.
"""
from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm import bytetext as B
from sluice.llm.shared import columns, workdir, written

SWEEPS = 3
BURN_IN = 1
STRENGTH = (1.0, 4.0)  # root, contexts
ADD = 0.1
HEAVY_SHARE = 1000
PIECE_BYTES = 1 << 17  # of texts hashed at a time: their running sums stay in a core's cache
CHUNK_TOKENS = 1 << 20
CHUNK_DOCS = 60_000
BUCKET_CHARS = 4_000_000
BUCKETS_PART = 8  # buckets for each part of the contexts' hashes
ROUNDS = 3  # of scoring, each for its share of the documents
FIXED = 2.0 ** 32  # sums of logarithms travel in whole numbers of this fraction
SEED = 11
START, END = B.U64(0x51ED270B7F4A7C15), B.U64(0x2545F4914F6CDD1D)


def _tokens(batch_text, held: np.ndarray):
    """``(words, doc, held, first row)`` of some rows at a time: all words of each text, then its end."""
    for lo, hi, data, bounds in B.text_chunks(batch_text, PIECE_BYTES):
        hashes, first = B.word_hashes(data, bounds)
        n = hi - lo
        doc = np.repeat(np.arange(n), np.diff(first))
        ends = first[1:] + np.arange(n)
        words = np.empty(len(hashes) + n, B.U64)
        words[np.arange(len(hashes)) + doc] = hashes
        words[ends] = END
        yield words, np.repeat(np.arange(n), np.diff(first) + 1), held[lo:hi], lo


def distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values, ascending, and the place of each value among them: ``np.unique`` by a hash table, which sorts the distinct ones alone."""
    coded = pa.array(values).dictionary_encode()
    found = coded.dictionary.to_numpy()
    order = np.argsort(found)
    place = np.empty(len(found), np.int64)
    place[order] = np.arange(len(found))
    return found[order], place[coded.indices.to_numpy()]


def ascending(first: np.ndarray, then: np.ndarray) -> np.ndarray:
    """The order of rows by two columns of whole numbers, equal ones as they stand; columns and row number are sorted as one number where 63 bits hold them."""
    low = len(first).bit_length()
    middle = int(then.max(initial=0)).bit_length()
    if int(first.max(initial=0)).bit_length() + middle + low > 63:
        return np.lexsort((then, first))
    return np.sort(first << (middle + low) | then << low | np.arange(len(first))) & ((1 << low) - 1)


def changes(*columns: np.ndarray) -> np.ndarray:
    """The rows at which a column has another value than in the row before, and the first."""
    new = np.ones(len(columns[0]), bool)
    new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return np.flatnonzero(new)


def heavy_words(docs: DataFrame) -> np.ndarray:
    """Words that hold a thousandth of all tokens or more (so a thousand at most): every task counts windows of tokens and passes on those with
    half that share there."""

    def count(batches):
        def flush(parts):
            words, counts = np.unique(np.concatenate(parts), return_counts=True)
            keep = counts * 2 * HEAVY_SHARE >= counts.sum()
            return pa.RecordBatch.from_arrays([pa.array(np.append(words[keep].view(np.int64), 0)), pa.array(np.append(counts[keep], 0)),
                                               pa.array(np.append(np.zeros(keep.sum(), np.int64), counts.sum()))], names=["word", "n", "all"])
        held, size = [], 0
        for batch in batches:
            for words, *_ in _tokens(batch.column("text"), np.zeros(len(batch.column("text")), bool)):
                held.append(words)
                size += len(words)
                if size >= CHUNK_TOKENS:
                    yield flush(held)
                    held, size = [], 0
        if held:
            yield flush(held)

    sums = docs.select("text").mapInArrow(count, "word long, n long, all long").groupBy("word").agg(F.sum("n").alias("n"), F.sum("all").alias("all")).cache()
    try:
        total = sums.agg(F.sum("all")).first()[0] or 0
        top = sums.filter(F.col("n") * HEAVY_SHARE >= total).filter("n > 0").select("word").toPandas()
    finally:
        sums.unpersist()
    return np.sort(top["word"].to_numpy(np.int64).view(np.uint64))


def _packed(docs: DataFrame, heavy, n: int, tokens: bool) -> DataFrame:
    """``(bucket, chunk, n_train, blob, ids, n_tokens)``: a row per chunk of documents and bucket of words. A blob holds the pairs of word and
    context of the chunk with their training tokens; with ``tokens`` also the documents of all tokens, and each chunk has a row with its ids.

    Documents of a chunk are numbered, training documents first. A chunk's name is its task and number, the same in every attempt.
    """
    names = ["bucket", "chunk", "n_train", "blob", "ids", "n_tokens"]

    def run(batches):
        own, number = TaskContext.get().partitionId(), 0
        dealt = heavy.value

        def flush(parts, ids, helds):
            held = np.concatenate(helds)
            place = np.argsort(held, kind="stable")
            rank = np.empty(len(held), np.int64)
            rank[place] = np.arange(len(held))
            words, doc = (np.concatenate([p[i] for p in parts]) for i in range(2))
            chunk, n_train = own << 32 | number, int((~held).sum())
            hashes, at = distinct(np.append(words, START))
            before = np.append(at[-1], at[:-2])
            before[changes(doc)] = at[-1]
            # Word, context and document as one number: at most 2^20 tokens, or one document, make a chunk, so 63 bits hold it.
            bits, doc_bits = len(hashes).bit_length(), (len(held) - 1).bit_length()
            key = np.sort(at[:-1] << (bits + doc_bits) | before << doc_bits | rank[doc])
            doc, key = key & ((1 << doc_bits) - 1), key >> doc_bits
            starts = changes(key)
            total = np.diff(np.append(starts, len(key)))
            word, context = key[starts] >> bits, key[starts] & ((1 << bits) - 1)
            bucket = (B.mix(hashes) % B.U64(n)).astype(np.int64)[word]
            if len(dealt):
                wide = np.isin(hashes, dealt)[word]
                bucket[wide] = (pair_keys(hashes[word[wide]], hashes[context[wide]], 0) % B.U64(n)).astype(np.int64)
            small = bucket.astype(np.min_scalar_type(n))  # sorted by digits where it has 16 bits
            by_bucket = np.argsort(small, kind="stable")
            if tokens:
                counts, docs_of = total[by_bucket], doc[np.argsort(np.repeat(small, total), kind="stable")]
            else:
                counts, docs_of = np.add.reduceat((doc < n_train).astype(np.int64), starts)[by_bucket], doc[:0]
            bucket, word, context = bucket[by_bucket], word[by_bucket], context[by_bucket]
            cuts = np.searchsorted(bucket, np.arange(n + 1))
            token_cuts = np.append(0, np.cumsum(counts))[cuts] if tokens else np.zeros(n + 1, np.int64)
            # Each bucket's words and contexts, ascending, and the place of each pair's context among them.
            first_word = changes(bucket, word)
            word_cuts, n_pairs = np.searchsorted(first_word, cuts), np.diff(np.append(first_word, len(word)))
            order = ascending(bucket, context)
            first_context = changes(bucket, context[order])
            context_cuts = np.searchsorted(first_context, cuts)
            context_at = np.empty(len(context), np.int64)
            context_at[order] = np.repeat(np.arange(len(first_context)), np.diff(np.append(first_context, len(context))))
            context_at -= context_cuts[bucket]
            own_words, own_contexts = hashes[word[first_word]], hashes[context[order[first_context]]]
            rows = []
            for b in np.flatnonzero(np.diff(cuts)):
                pairs, w, c, t = (slice(x[b], x[b + 1]) for x in (cuts, word_cuts, context_cuts, token_cuts))
                arrays = [narrow(a) for a in (own_words[w], own_contexts[c], n_pairs[w], context_at[pairs], counts[pairs], docs_of[t])]
                rows.append((int(b), chunk, n_train, framed(arrays), None, None))
            if tokens:
                n_tokens = np.bincount(np.concatenate([p[1] for p in parts]), minlength=len(held))[place]
                rows.append((chunk % n, chunk, n_train, None, pa.concat_arrays(ids).take(pa.array(place)).to_pylist(), n_tokens.tolist()))
            kinds = [pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.list_(pa.string()), pa.list_(pa.int64())]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

        parts, ids, helds, size, rows = [], [], [], 0, 0
        for batch in batches:
            flags = batch.column("held_out").to_numpy(zero_copy_only=False).astype(bool)
            for words, doc, held, lo in _tokens(batch.column("text"), flags):
                if rows and (size + len(words) > CHUNK_TOKENS or rows + len(held) > CHUNK_DOCS):
                    yield flush(parts, ids, helds)
                    number, parts, ids, helds, size, rows = number + 1, [], [], [], 0, 0
                parts.append((words, doc + rows))
                ids.append(batch.column("doc_id").slice(lo, len(held)))
                helds.append(held)
                size, rows = size + len(words), rows + len(held)
        if rows:
            yield flush(parts, ids, helds)

    return docs.mapInArrow(run, "bucket int, chunk long, n_train int, blob binary, ids array<string>, n_tokens array<long>")


def narrow(values: np.ndarray) -> bytes:
    """Whole numbers in as few bytes each as the largest needs, first bytes first, compressed; that number of bytes and theirs before them."""
    kind = np.min_scalar_type(int(values.max())) if len(values) else np.dtype(np.uint8)
    cells = values.astype(kind).view(np.uint8).reshape(-1, kind.itemsize)
    planes = b"".join(np.ascontiguousarray(cells[:, i]) for i in range(kind.itemsize))  # much faster than the transposed array's bytes
    return bytes([kind.itemsize]) + np.uint64(len(planes)).tobytes() + pa.compress(planes, "zstd", asbytes=True)


def widened(raw: bytes) -> np.ndarray:
    """The numbers that :func:`narrow` packed, as int64, or uint64 where they take all eight bytes."""
    size = int(np.frombuffer(raw, np.uint64, 1, 1)[0])
    planes = np.frombuffer(pa.decompress(raw[9:], size, "zstd", asbytes=True), np.uint8).reshape(raw[0], -1)
    cells = np.empty(planes.shape[::-1], np.uint8)
    for i, plane in enumerate(planes):
        cells[:, i] = plane
    values = cells.view(f"u{raw[0]}").ravel()
    return values if raw[0] == 8 else values.astype(np.int64)


def framed(parts: list[bytes]) -> bytes:
    """Byte strings as one, their number and lengths before them."""
    return np.array([len(parts), *map(len, parts)], np.uint64).tobytes() + b"".join(parts)


def unframed(raw: bytes) -> list[bytes]:
    n = int(np.frombuffer(raw, np.uint64, 1)[0])
    ends = 8 * (n + 1) + np.append(0, np.cumsum(np.frombuffer(raw, np.uint64, n, 8).astype(np.int64)))
    return [raw[lo:hi] for lo, hi in zip(ends, ends[1:], strict=False)]


def _unpacked(raw) -> tuple[np.ndarray, ...]:
    """``(words, contexts, word, context, counts, docs)`` of a blob; pairs are sorted by word, whose numbers of pairs are kept."""
    words, contexts, pairs, context, counts, docs = map(widened, unframed(bytes(raw)))
    return words.astype(B.U64), contexts.astype(B.U64), np.repeat(np.arange(len(words)), pairs), context, counts, docs


def _pair_numbers(parts, word: np.ndarray, context: np.ndarray, n_contexts: int) -> np.ndarray:
    """A number for each pair of all blobs, from the numbers of the words and contexts that the blobs list."""
    out, w_from, c_from = [], 0, 0
    for p in parts:
        out.append(word[w_from: w_from + len(p[0])][p[2]] * n_contexts + context[c_from: c_from + len(p[1])][p[3]])
        w_from, c_from = w_from + len(p[0]), c_from + len(p[1])
    return np.concatenate(out)


def pair_keys(words: np.ndarray, contexts: np.ndarray, sweep: int) -> np.ndarray:
    """What random numbers of dishes hang on: the word, the context and the sweep."""
    return B.mix(words ^ B.mix(contexts + START)) + B.U64((SEED + 1000 * sweep) * 0xD1B54A32D192ED03 & 0xFFFFFFFFFFFFFFFF)


def root_keys(words: np.ndarray, sweep: int) -> np.ndarray:
    return pair_keys(words, np.zeros(1, B.U64), sweep)


def uniform(keys: np.ndarray, turn: int) -> np.ndarray:
    """A number in (0, 1) for each key, another at every turn."""
    step = B.U64(turn * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    return ((B.mix(B.mix(keys + step)) >> B.U64(11)).astype(float) + 0.5) * 2.0 ** -53


def poisson(mean: np.ndarray, keys: np.ndarray, turn: int) -> np.ndarray:
    """Poisson numbers by inversion; from a mean of 30 on, the rounded normal ones."""
    u = uniform(keys, turn)
    wide = mean >= 30
    normal = np.sqrt(-2 * np.log(u)) * np.cos(2 * np.pi * uniform(~keys, turn))
    out = np.where(wide, np.maximum(np.rint(mean + np.sqrt(mean) * normal), 0), 0)
    some = np.flatnonzero(~wide)
    term = np.exp(-mean[some])
    reached, k = term.copy(), 0
    while len(some):
        go = (u[some] > reached) & ((term > 1e-18) | (k < mean[some]))
        some, term, reached, k = some[go], term[go], reached[go], k + 1
        out[some] = k
        term = term * mean[some] / k
        reached = reached + term
    return out


def seated(customers: np.ndarray, new: np.ndarray, discount: float, keys: np.ndarray) -> np.ndarray:
    """Tables of dishes with so many customers, seated one after the other where a new table weighs ``new``."""
    tables = (customers > 0).astype(float)
    some = np.flatnonzero(customers > 1)
    c, a, t, k = customers[some], new[some], tables[some], keys[some]
    done, turn = np.ones(len(some)), 0
    while len(some):
        turn += 1
        step = np.minimum(np.maximum(done // 8, 1), c - done)
        expected = step * a / (a + done + step / 2 - 0.5 - discount * t)
        opened = np.asarray(uniform(k, turn) < expected, float)
        block = np.flatnonzero(step > 1)
        opened[block] = np.minimum(poisson(expected[block], k[block], turn), step[block])
        t, done = t + opened, done + step
        tables[some] = t
        go = done < c
        some, c, a, t, k, done = some[go], c[go], a[go], t[go], k[go], done[go]
    return tables


@dataclass
class Model:
    """What all tasks know: corpus counts, discounts, and the totals of the seating at hand."""

    heavy: np.ndarray
    heavy_counts: np.ndarray = field(default_factory=lambda: np.zeros(0))
    n_tokens: float = 0
    n_words: float = 0
    discount: tuple[float, float] = (0.5, 0.5)  # root, contexts
    root: tuple[float, float] = (0, 0)  # customers and tables of words that are not heavy
    heavy_customers: np.ndarray = field(default_factory=lambda: np.zeros(0))
    heavy_tables: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def spare(self) -> float:
        """What the root gives to the base, for each word of the vocabulary and the unknown one."""
        return (STRENGTH[0] + self.discount[0] * (self.root[1] + self.heavy_tables.sum())) / (self.n_words + 1)


#: A bucket's row: its words and contexts (ascending hashes); pairs of each word, their contexts, training tokens and tables; tables of its words at the
#: root; customers of its contexts in the whole corpus; tokens and tables of its contexts here; the kept seatings (see ``Bucket.keep``); corpus sums,
#: then tokens and tables of heavy words.
ARRAYS = ("words", "contexts", "pairs", "context", "count", "tables", "root_tables", "customers", "context_count", "context_tables")
STATE = "bucket int, " + "".join(f"{name} binary, " for name in ARRAYS) + "kept binary, sums array<double>"
SCORED = "bucket int, words binary, contexts binary, pairs binary, context binary, count binary, customers binary, kept binary"
SUMS = 6


class Bucket:
    """The pairs of one bucket and the seating of its dishes."""

    def __init__(self, heavy: np.ndarray, **arrays):
        self.as_read: dict[str, bytes] = {}  # packed arrays that no sweep changes
        self.__dict__.update(arrays)
        place = np.searchsorted(heavy, self.words)
        place[place == len(heavy)] = 0
        self.is_heavy = heavy[place] == self.words if len(heavy) else np.zeros(len(self.words), bool)
        self.heavy_at, self.n_heavy = place[self.is_heavy], len(heavy)

    @classmethod
    def opened(cls, heavy: np.ndarray, blobs) -> "Bucket":
        """All pairs of the blobs, with one table a dish."""
        parts = [_unpacked(b) for b in blobs]
        words, w = distinct(np.concatenate([p[0] for p in parts]))
        contexts, c = distinct(np.concatenate([p[1] for p in parts]))
        pairs = _pair_numbers(parts, w, c, len(contexts))
        order = ascending(pairs, np.zeros_like(pairs))
        pairs = pairs[order]
        starts = changes(pairs)
        pairs, count = pairs[starts], np.add.reduceat(np.concatenate([p[4] for p in parts])[order].astype(float), starts)
        out = cls(heavy, words=words, contexts=contexts, word=pairs // len(contexts), context=pairs % len(contexts), count=count, tables=(count > 0).astype(float),
                  customers=np.zeros(0), kept=[])
        out.root_tables = np.minimum(out.by_word(out.tables), 1)
        return out

    @classmethod
    def of_row(cls, heavy: np.ndarray, row) -> "Bucket":
        arrays = {name: widened(bytes(row[name])) for name in ARRAYS if name in row}
        words, contexts, pairs, context = (arrays.pop(name) for name in ("words", "contexts", "pairs", "context"))
        return cls(heavy, words=words.astype(B.U64), contexts=contexts.astype(B.U64), word=np.repeat(np.arange(len(words)), pairs), context=context,
                   as_read={name: bytes(row[name]) for name in ("words", "contexts", "pairs", "context", "count")}, kept=unframed(bytes(row["kept"])), **{name: v.astype(float) for name, v in arrays.items()})

    def by_word(self, values: np.ndarray) -> np.ndarray:
        return np.bincount(self.word, weights=values, minlength=len(self.words))

    def by_context(self, values: np.ndarray) -> np.ndarray:
        return np.bincount(self.context, weights=values, minlength=len(self.contexts))

    def row(self, bucket: int) -> pd.DataFrame:
        """The written row. Sums: training tokens, known words, dishes with one and two customers, customers and tables of the root (of
        all words but the heavy), its words with one and two customers at the start; then tokens and tables of each heavy word."""
        counts, customers = self.by_word(self.count), self.by_word(self.tables)
        light = ~self.is_heavy
        heavy = lambda v: np.bincount(self.heavy_at, weights=v[self.is_heavy], minlength=self.n_heavy)
        sums = [self.count.sum(), (counts[light] > 0).sum(), (self.count == 1).sum(), (self.count == 2).sum(), customers[light].sum(), self.root_tables[light].sum()]
        opened = self.by_word(self.count > 0)[light]
        first = [(opened == 1).sum(), (opened == 2).sum()]
        values = (self.words, self.contexts, np.bincount(self.word, minlength=len(self.words)), self.context, self.count, self.tables, self.root_tables,
                  self.customers, self.by_context(self.count), self.by_context(self.tables))
        row = {name: [self.as_read.get(name) or narrow(v)] for name, v in zip(ARRAYS, values, strict=True)} | {"kept": [framed(self.kept)]}
        return pd.DataFrame({"bucket": [bucket], **row, "sums": [np.concatenate([sums, first, heavy(counts), heavy(customers)])]})

    def root_seats(self, m: Model) -> tuple[np.ndarray, np.ndarray]:
        """Customers and tables of the bucket's words at the root, those of heavy words in all buckets."""
        customers, own = self.by_word(self.tables), self.root_tables.copy()
        customers[self.is_heavy], own[self.is_heavy] = m.heavy_customers[self.heavy_at], m.heavy_tables[self.heavy_at]
        return customers, own

    def word_probabilities(self, m: Model) -> np.ndarray:
        """The root's predictive probability of each word of the bucket."""
        customers, own = self.root_seats(m)
        return (customers - m.discount[0] * own + m.spare()) / (STRENGTH[0] + m.root[0] + m.heavy_customers.sum())

    def keep(self, m: Model, context_tables: np.ndarray) -> None:
        """The seating at hand joins those averaged. What its probabilities hang on is far smaller than they are: tables, those of the contexts,
        customers of heavy words at the root and tables of all, and four numbers that all buckets share."""
        customers, own = self.root_seats(m)
        shared = np.array([*m.discount, m.spare(), STRENGTH[0] + m.root[0] + m.heavy_customers.sum()])
        self.kept = [*self.kept, shared.tobytes(), *map(narrow, (self.tables, context_tables, customers[self.is_heavy], own))]

    @property
    def p(self) -> np.ndarray:
        """The predictive probability of each pair, averaged over the kept seatings."""
        out, n = np.zeros(len(self.word)), self.customers[self.context]
        for at in range(0, len(self.kept), 5):
            d0, d1, spare, total = np.frombuffer(self.kept[at], np.float64)
            tables, context_tables, heavy_customers, own = (widened(v).astype(float) for v in self.kept[at + 1: at + 5])
            customers = self.by_word(tables)
            customers[self.is_heavy] = heavy_customers
            word_p = ((customers - d0 * own + spare) / total)[self.word]
            seat = self.count - d1 * tables + (STRENGTH[1] + d1 * context_tables[self.context]) * word_p
            out += np.where(n > 0, seat / (STRENGTH[1] + n), word_p) / (len(self.kept) // 5)
        return out

    def seat(self, m: Model, context_tables: np.ndarray, sweep: int) -> None:
        """All dishes seated anew, given the tables of all others in the seating at hand."""
        p = self.word_probabilities(m)
        new = (STRENGTH[1] + m.discount[1] * np.maximum(context_tables[self.context] - self.tables, 0)) * p[self.word]
        self.tables = seated(self.count, new, m.discount[1], pair_keys(self.words[self.word], self.contexts[self.context], sweep))
        self.root_tables = seated(self.by_word(self.tables), np.full(len(self.words), m.spare()), m.discount[0], root_keys(self.words, sweep))

    def scores(self, m: Model, blobs):
        """For each blob its documents' sums over this bucket's tokens: score, base score, known tokens."""
        counts = self.by_word(self.count)
        counts[self.is_heavy] = m.heavy_counts[self.heavy_at]
        log_p, known = np.log10(self.p), counts > 0
        base = np.log10((counts + ADD) / (m.n_tokens + ADD * (m.n_words + 1)))
        parts = [_unpacked(blob) for blob in blobs]
        if not parts:
            return
        words, contexts, _, _, total, doc = (np.concatenate([p[i] for p in parts]) for i in range(6))
        words = np.searchsorted(self.words, words)
        numbers = _pair_numbers(parts, words, np.searchsorted(self.contexts, contexts), len(self.contexts))
        at = np.repeat(np.searchsorted(self.word * len(self.contexts) + self.context, numbers), total)
        # The documents of all blobs are numbered one after the other.
        sizes = [len(p[5]) for p in parts]
        firsts = np.append(0, np.cumsum([p[5].max() + 1 for p in parts]))
        doc = doc + np.repeat(firsts[:-1], sizes)
        present = np.flatnonzero(np.bincount(doc))
        sums = lambda v: np.bincount(doc, weights=v)[present]
        fixed = lambda v: np.rint(np.maximum(-sums(v), 0) * FIXED).astype(B.U64)
        values = fixed(log_p[at]), fixed(base[self.word[at]]), sums(known[self.word[at]])
        cuts = np.searchsorted(present, firsts)
        for first, lo, hi in zip(firsts, cuts, cuts[1:], strict=False):
            yield framed([narrow(present[lo:hi] - first), *(narrow(v[lo:hi]) for v in values)])


def _context_totals(state: DataFrame, parts: int, *names: str) -> DataFrame:
    """``(bucket, part, *names)``: for the contexts of each bucket, in their order, the sums of the columns over all buckets.

    The range of hashes is cut into parts. A bucket's contexts of one part are a row, hashes and numbers packed; their sums come back without the hashes.
    """

    def cut(batches):
        for batch in batches:
            for bucket, contexts, *values in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                arrays = [widened(contexts).astype(B.U64), *map(widened, values)]
                of = (((arrays[0] >> B.U64(32)) * B.U64(parts)) >> B.U64(32)).astype(np.int64)
                cuts = np.searchsorted(of, np.arange(parts + 1))
                some = np.flatnonzero(np.diff(cuts))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), bucket, np.int32)), pa.array(some.astype(np.int32)),
                                                  *[pa.array([narrow(a[cuts[i]: cuts[i + 1]]) for i in some], pa.binary()) for a in arrays]],
                                                 names=["bucket", "part", "contexts", *names])

    def summed(pdf: pd.DataFrame) -> pd.DataFrame:
        contexts = [widened(bytes(c)).astype(B.U64) for c in pdf["contexts"]]
        cuts = np.cumsum([len(c) for c in contexts])[:-1]
        _, at = distinct(np.concatenate(contexts))
        out = {"bucket": pdf["bucket"], "part": pdf["part"]}
        for name in names:
            totals = np.bincount(at, weights=np.concatenate([widened(bytes(v)) for v in pdf[name]]))
            out[name] = [narrow(v) for v in np.split(totals[at], cuts)]
        return pd.DataFrame(out)

    kinds = ", ".join(f"{n} binary" for n in names)
    own = state.select("bucket", "contexts", *names).mapInArrow(cut, f"bucket int, part int, contexts binary, {kinds}")
    return own.groupBy("part").applyInPandas(summed, f"bucket int, part int, {kinds}")


def _aligned(totals: pd.DataFrame, name: str) -> np.ndarray:
    """Totals in the order of the bucket's contexts."""
    return np.concatenate([widened(bytes(v)) for v in totals.sort_values("part")[name]]).astype(np.float64)


def _finished(pdf: pd.DataFrame) -> pd.DataFrame:
    """The documents of one chunk, from its ids and the sums of all buckets."""
    head = pdf[pdf["ids"].notna()].iloc[0]
    n = len(head["n_tokens"])
    score, base, known = np.zeros(n), np.zeros(n), np.zeros(n, np.int64)
    for part in sorted(pdf["part"].dropna(), key=bytes):
        present, of_score, of_base, of_known = map(widened, unframed(bytes(part)))
        score[present] -= of_score / FIXED
        base[present] -= of_base / FIXED
        known[present] += of_known
    return pd.DataFrame({"doc_id": list(head["ids"]), "held_out": np.arange(n) >= head["n_train"], "n_tokens": np.asarray(head["n_tokens"], np.int64),
                         "n_known": known, "base_score": base, "score": score})


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; rows without id are in fold 0, which is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds, F.lit(0))


def fitted(rows: DataFrame, n: int, base: str) -> tuple[DataFrame, Model]:
    """The buckets' table (see ``STATE``) with the averaged probability of every pair of context and word in ``rows``, and the corpus totals.

    Each pass reads the table written by the one before and the totals of its contexts, and overwrites the one before that. ``rows``: doc_id,
    held_out, text.
    """
    heavy = heavy_words(rows)
    model = Model(heavy)

    def totals(state: DataFrame, sweep: int) -> None:
        sums = state.select(F.posexplode("sums")).groupBy("pos").agg(F.sum("col").alias("col")).toPandas().set_index("pos")["col"].sort_index().to_numpy(float)
        if not len(sums):
            sums = np.zeros(SUMS + 2 + 2 * len(heavy))
        by_heavy = sums[SUMS + 2:].reshape(2, len(heavy))
        if sweep == 0:
            (one, two), (root_one, root_two) = sums[2:4], sums[SUMS: SUMS + 2]
            model.heavy_counts, model.n_tokens, model.n_words = by_heavy[0], float(sums[0]), float(sums[1] + (by_heavy[0] > 0).sum())
            discount = lambda a, b: float(np.clip(a / max(a + 2 * b, 1), 0.05, 0.95))
            model.discount = (discount(root_one, root_two), discount(one, two))
            model.heavy_tables = np.minimum(by_heavy[1], 1)
        else:
            model.heavy_tables = seated(by_heavy[1], np.full(len(heavy), model.spare()), model.discount[0], root_keys(heavy, sweep))
        model.heavy_customers, model.root = by_heavy[1], (float(sums[4]), float(sums[5]))

    def opened(pdf: pd.DataFrame) -> pd.DataFrame:
        return Bucket.opened(heavy, pdf["blob"]).row(int(pdf["bucket"].iloc[0]))

    counts = _packed(rows, rows.sparkSession.sparkContext.broadcast(heavy), n, tokens=False).select("bucket", "blob")
    state = written(counts.groupBy("bucket").applyInPandas(opened, STATE), base, "seating0")
    totals(state, 0)

    def turn(sweep: int):
        # The last pass only keeps the last seating, whose totals are known by then.
        def run(states: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
            bucket, context_tables = Bucket.of_row(heavy, states.iloc[0]), _aligned(found, "context_tables")
            if sweep == 1:
                bucket.customers = _aligned(found, "context_count")
            if sweep - 1 > BURN_IN:
                bucket.keep(model, context_tables)
            if sweep <= SWEEPS:
                bucket.seat(model, context_tables, sweep)
            return bucket.row(int(states["bucket"].iloc[0]))[names]

        names = [part.split()[0] for part in (STATE if sweep <= SWEEPS else SCORED).split(", ")]
        return run

    parts = max(n // BUCKETS_PART, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))
    for sweep in range(1, SWEEPS + 2):
        found = _context_totals(state, parts, "context_tables", *["context_count"][: sweep == 1]).groupBy("bucket")
        seats = state.drop("context_count", "context_tables", "sums").groupBy("bucket")
        state = written(seats.cogroup(found).applyInPandas(turn(sweep), STATE if sweep <= SWEEPS else SCORED), base, f"seating{sweep % 2}")
        if sweep <= SWEEPS:
            totals(state, sweep)
    return state, model


def language_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 10) -> DataFrame:
    """One row per document: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``.

    Tokens are the words (A-Z lower-cased, split at ASCII white space) and one end. The model learns from rows outside fold 0. Null and empty
    texts have the end alone. Rows that repeat an id each get their score. Without training rows every token is unknown, and all
    probabilities are those of the base. An empty table gives no rows.
    """
    spark = docs.sparkSession
    base = workdir(spark, "pitman-yor")
    kind = columns(docs, doc_id=id_col).schema["doc_id"].dataType.simpleString()
    rows = columns(docs, doc_id=id_col, text=text_col).select(F.col("doc_id").cast("string").alias("doc_id"), (fold(F.col("doc_id"), folds) == 0).alias("held_out"), "text")
    n = max(1, (rows.agg(F.sum(F.length("text"))).first()[0] or 0) // BUCKET_CHARS, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))
    state, model = fitted(rows, n, base)
    heavy = model.heavy

    def score(tokens: pd.DataFrame, states: pd.DataFrame) -> pd.DataFrame:
        parts = tokens[tokens["blob"].notna()]
        out = tokens[tokens["blob"].isna()].drop(columns=["bucket", "blob"]).assign(part=None)
        if len(parts):
            sums = list(Bucket.of_row(heavy, states.iloc[0]).scores(model, parts["blob"]))
            out = pd.concat([out, pd.DataFrame({"chunk": parts["chunk"].to_numpy(), "part": sums, "n_train": None, "ids": None, "n_tokens": None})])
        return out[["chunk", "part", "n_train", "ids", "n_tokens"]]

    shared, out = spark.sparkContext.broadcast(heavy), None
    for turn in range(ROUNDS):
        some = rows.filter(F.pmod(F.xxhash64("doc_id"), F.lit(ROUNDS)) == turn)
        parts = (_packed(some, shared, n, tokens=True).groupBy("bucket").cogroup(state.groupBy("bucket"))
                 .applyInPandas(score, "chunk long, part binary, n_train int, ids array<string>, n_tokens array<long>"))
        found = parts.groupBy("chunk").applyInPandas(_finished, "doc_id string, held_out boolean, n_tokens long, n_known long, base_score double, score double")
        found = written(found, base, f"scores{turn}")
        out = found if out is None else out.unionByName(found)
    return out.select(F.col("doc_id").cast(kind).alias("doc_id"), "held_out", "n_tokens", "n_known", F.lit(int(model.n_tokens)).cast("long").alias("train_tokens"), "base_score", "score")
