"""Language-model scores from an Elias-Fano trie of 1-, 2- and 3-grams, in shards.

The model is a chain of three distributions, each smoothed by the one below:
    p1(w)     = (c(w) + 1/2) / (N + (V + 1) / 2)             one more word stands for all unknown ones
    p2(w|v)   = (c(v w) + K2 p1(w)) / (c(v) + K2)
    p3(w|u v) = (c(u v w) + K3 p2(w|v)) / (c(u v) + K3)
A text starts with two start signs and closes with one end token, which is predicted like a word.

How it runs. Documents are tokenised into blocks, training documents first. A block's distinct words go with
their training counts to word shards, which give back ids (frequent words have small ones) and counts. With
them a block knows the base score, and sends each token with the two before it to the shard of the word before:
packed columns, one message for each block and shard that meet. A shard builds the trie of what training
documents sent and answers every message with a sum for each document; the sums are added by block.

A word v that stands more than HOT times before others is hot: its tokens go to several shards, by a hash of the word u
before it. As they are in several places, its pairs are counted first: a block sends its distinct pairs (v, w) with their
training counts to pair shards and gets the counts of all, which go with the tokens, like that of v. Where u v stands
more than HOT times before others too (known from the pairs, as u is hot then), a block sends each distinct u v w once with its
training count and the count of u v, to a shard by a hash of u and w, and adds the answer up for its documents. So every
count is that of all training documents, and a group of copies or a frequent phrase never meets in one task.

A trie has three levels: words before; their successors; for each context (v, u) its successors, named by their
rank among those of v. Ids and pointers are Elias-Fano sequences, probabilities 16 bits in steps of 1/4096 of a
decade, all in one mapped buffer.
"""

from __future__ import annotations

import mmap
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents, partitions, slices, stored, whole

K2, K3 = 2.0, 1.0  # strength of the smoothing, in occurrences
BLOCK_BYTES = 6_000_000  # of text whose tokens make a block; a longer text is a block of its own
WORD_SHARD = 1_000_000  # words with a block each that a word shard gets, about
GRAM_SHARD = 1_000_000  # tokens that a shard of the trie gets, about
HOT = 250_000  # occurrences of a word before from which on its successors are split
STEPS = 4096  # in a decade of probability
FINE = 16  # parts of a step in which sums of a document are sent
UNKNOWN, START, FIRST_ID = 0, 1, 2
PART_BITS = 20

LOWER = bytes(i + 32 if 65 <= i < 91 else i for i in range(256))

BLOCK = "block long, train_docs int, doc_ids array<long>, sizes array<int>, codes binary, words binary, train array<long>"
ASKED = "shard int, block long, words binary, train binary"
KNOWN = "block long, shard int, ids binary, counts binary, distinct long"
PAIRS = "shard int, block long, v binary, runs binary, w binary, train binary"
COUNTED = "of long, shard int, counts binary"
SENT = "shard int, block long, train_docs int, v binary, runs binary, w binary, p1 binary, u binary, doc binary, n_v binary, n_vw binary, n_uv binary, times binary, hot_sizes binary, hot_grams binary, doc_ids array<long>, n_tokens array<long>, n_known array<long>, base array<double>, own array<double>"
PARTIAL = "block long, docs binary, parts binary, train_docs int, hot_sizes binary, hot_grams binary, doc_ids array<long>, n_tokens array<long>, n_known array<long>, base array<double>, own array<double>"
RESULT = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def pack(values: np.ndarray) -> bytes:
    """Unsigned integers, byte plane by byte plane, compressed."""
    width = max(1, (int(values.max(initial=0)).bit_length() + 7) // 8)
    planes = np.ascontiguousarray(values.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :width]
    return bytes([width]) + zstandard.compress(np.ascontiguousarray(planes.T).tobytes(), 1)


def unpack(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(packed[1:]), np.uint8).reshape(packed[0], -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, : packed[0]] = planes.T
    return out.reshape(-1).view("<u8").astype(np.int64)


def narrow(values: np.ndarray) -> np.ndarray:
    """In the smallest unsigned type of up to 32 bits that holds them, else as they are."""
    top = int(values.max(initial=0))
    return values if top >> 32 else values.astype(np.min_scalar_type(top))


def mixed(values: np.ndarray) -> np.ndarray:
    """A 64-bit hash of whole numbers."""
    x = values.astype(np.uint64)
    for factor in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB):
        x = (x ^ (x >> np.uint64(31))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(zlib.crc32, words), np.int64, len(words))


def pack_words(words: list[bytes]) -> bytes:
    """Words have no line feed."""
    return zstandard.compress(b"\n".join(words), 3)


def unpack_words(packed: bytes) -> list[bytes]:
    return zstandard.decompress(packed).split(b"\n")


def one(values, kind: pa.DataType) -> pa.Array:
    return pa.array([values], pa.list_(kind))


# Tokens and words


def block_row(number: int, train: list, held: list, codes: dict[bytes, int]) -> pa.RecordBatch:
    """The block's documents, training ones first, and its words in the order of their hashes."""
    words = list(codes)
    order = np.argsort(hashes(words), kind="stable")  # the end token, b"", stays first
    rank = np.empty(len(words), np.int64)
    rank[order] = np.arange(len(words))
    docs = train + held
    tokens = np.concatenate([np.zeros(0, np.int64), *[d[1] for d in docs]])
    counts = np.bincount(np.concatenate([np.zeros(len(train), np.int64), *[d[1] for d in train]]), minlength=len(words))
    return pa.RecordBatch.from_arrays(
        [
            pa.array([number]), pa.array([len(train)], pa.int32()), one([d[0] for d in docs], pa.int64()), one([len(d[1]) for d in docs], pa.int32()),
            pa.array([pack(rank[tokens])]), pa.array([pack_words([words[i] for i in order.tolist()])]), one(counts[order], pa.int64()),
        ],
        names(BLOCK),
    )


def read_blocks(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 24
        fresh = lambda: ([], [], {b"": 0})
        (train, held, codes), size = fresh(), 0
        for batch in batches:
            ids, outs = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            for at, texts in slices(batch.column(1)):
                for i, text in enumerate(texts, at):
                    words = text.encode().translate(LOWER).split()
                    known = codes.setdefault
                    (held if outs[i] else train).append((ids[i], np.fromiter((known(w, len(codes)) for w in words), np.int64, len(words))))
                    size += len(text)
                if size >= BLOCK_BYTES:
                    yield block_row(number, train, held, codes)
                    (train, held, codes), size, number = fresh(), 0, number + 1
        if train or held:
            yield block_row(number, train, held, codes)

    held = F.coalesce(F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary")) % 5 == 1, F.lit(False))
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole().alias("text"), held.alias("held"))
    return stored(own.mapInArrow(run, BLOCK), "trie-blocks")


def ask(shards: int):
    """A block's words, a row for each shard that has one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                words, train = unpack_words(batch["words"][i].as_py()), batch["train"][i].values.to_numpy()
                shard = (hashes(words) * shards) >> 32
                ends = [0, *(np.flatnonzero(np.diff(shard)) + 1).tolist(), len(shard)]
                cut = list(zip(ends, ends[1:]))
                lists = [pa.array([f(x[a:b]) for a, b in cut], pa.binary()) for f, x in ((pack_words, words), (pack, train))]
                yield pa.RecordBatch.from_arrays([pa.array(shard[ends[:-1]].astype(np.int32)), pa.array([batch["block"][i].as_py()] * len(cut), pa.int64()), *lists], names(ASKED))

    return run


def count_words(shards: int):
    """All that blocks ask of a word shard: ids and counts of each block's words; how many words have a count."""

    def run(table: pa.Table) -> pa.Table:
        words = [unpack_words(x) for x in table["words"].to_pylist()]
        coded = pa.chunked_array([pa.array(x, pa.binary()) for x in words]).combine_chunks().dictionary_encode()
        codes = coded.indices.to_numpy()
        counts = np.zeros(len(coded.dictionary), np.int64)
        np.add.at(counts, codes, np.concatenate([unpack(x) for x in table["train"].to_pylist()]))
        order = pc.sort_indices(pa.table({"c": counts, "w": coded.dictionary}), [("c", "descending"), ("w", "ascending")]).to_numpy()
        ids = np.empty(len(order), np.int64)
        ids[order] = FIRST_ID + np.arange(len(order)) * shards + table["shard"][0].as_py()
        ids[counts == 0] = UNKNOWN
        ends = np.cumsum(list(map(len, words)))
        cut = lambda values: pa.array([pack(x) for x in np.split(values[codes], ends[:-1])], pa.binary())
        return pa.table([table["block"], table["shard"], cut(ids), cut(counts), pa.array([int((counts > 0).sum())] + [0] * (table.num_rows - 1), pa.int64())], names(KNOWN))

    return run


# Trie


class EliasFano:
    """A growing sequence of whole numbers: low bytes plainly, the rest in unary."""

    def __init__(self, values: np.ndarray):
        self.n = len(values)
        top = int(values[-1]) if self.n else 0
        self.bytes = (max(0, (top // max(1, self.n)).bit_length() - 1) + 7) // 8
        low = np.ascontiguousarray(values.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, : self.bytes]
        high = values >> (8 * self.bytes)
        bits = np.zeros(self.n + (int(high[-1]) if self.n else 0) + 1, bool)
        bits[high + np.arange(self.n)] = True
        self.parts = [np.ascontiguousarray(low).reshape(-1), np.packbits(bits)]

    def values(self) -> np.ndarray:
        low, high = self.parts
        out = np.zeros((self.n, 8), np.uint8)
        out[:, : self.bytes] = low.reshape(self.n, self.bytes)
        ones = np.flatnonzero(np.unpackbits(high))[: self.n]
        return out.reshape(-1).view("<i8") | ((ones - np.arange(self.n)) << (8 * self.bytes))

    def search(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places of the first values that aren't smaller, whether they are equal)."""
        values = self.values()
        at = np.searchsorted(values, wanted)
        inside = at < self.n
        return at, inside & (values[np.where(inside, at, 0)] == wanted) if self.n else np.zeros(len(wanted), bool)


def code(p: np.ndarray) -> np.ndarray:
    return np.minimum(np.rint(-np.log10(p) * STEPS), 65535).astype(np.uint16)


class Trie:
    """Of a shard's tokens: before (word and part), w, p1(w) and u of each; how often each is in training (once, if not
    given); the counts of v, v w and u v in all parts, 0 where they are those of the tokens here."""

    def __init__(self, before, w, p1, u, times=None, n_v=None, n_vw=None, n_uv=None):
        self.span = int(max(w.max(initial=0), u.max(initial=0))) + 1
        none = np.zeros(len(w), np.uint8)
        times = none + 1 if times is None else times
        n_v, n_vw, n_uv = (none if n is None else n for n in (n_v, n_vw, n_uv))
        known = (times > 0) | (n_v > 0)
        before, w, p1, u, times, n_v, n_vw, n_uv = (x[known] for x in (before, w, p1, u, times, n_v, n_vw, n_uv))
        words, sizes, _, vi = self.counted(before, times, n_v)
        del known, before, n_v
        at = np.flatnonzero((times > 0) | (n_vw > 0))
        pairs, pair_times, first, found = self.counted(vi[at] * self.span + w[at], times[at], n_vw[at])
        pair = np.zeros(len(w), np.int64)
        pair[at], first = found, at[first]
        p2 = (pair_times + K2 * p1[first]) / (sizes[vi[first]] + K2)
        del p1, n_vw, found
        ends = np.searchsorted(pairs, np.arange(len(words) + 1) * self.span)
        at = np.flatnonzero((times > 0) | (n_uv > 0))
        contexts, context_times, _, found = self.counted(vi[at] * self.span + u[at], times[at], n_uv[at])
        ci = np.zeros(len(w), np.int64)
        ci[at] = found
        self.width = int(np.diff(ends).max(initial=0)) + 1
        at = np.flatnonzero(times > 0)
        grams, gram_times, g, _ = self.counted(ci[at] * self.width + pair[at] - ends[vi[at]], times[at], none[: len(at)])
        g = at[g]
        p3 = (gram_times + K3 * p2[pair[g]]) / (context_times[ci[g]] + K3)
        self.words, self.pointers, self.pairs = EliasFano(words), EliasFano(ends), EliasFano(pairs)
        self.contexts, self.grams = EliasFano(contexts), EliasFano(grams)
        self.p2, self.p3, self.back2, self.back3 = code(p2), code(p3), code(K2 / (sizes + K2)), code(K3 / (context_times + K3))
        self.map()

    @staticmethod
    def counted(values: np.ndarray, times: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, ...]:
        """Distinct values, their counts (as known, else those here), the place of each and which one each value is."""
        found, first, inverse = np.unique(values, return_index=True, return_inverse=True)
        return found, np.where(known[first] > 0, known[first], np.bincount(inverse, times, len(found))), first, inverse

    def map(self) -> None:
        """All levels in one mapped buffer, of which the arrays are views."""
        owners = [(s.parts, i) for s in (self.words, self.pointers, self.pairs, self.contexts, self.grams) for i in (0, 1)]
        owners += [(self.__dict__, k) for k in ("p2", "p3", "back2", "back3")]
        starts = np.cumsum([0] + [-(-o[k].nbytes // 8) * 8 for o, k in owners])
        self.buffer = mmap.mmap(-1, max(8, int(starts[-1])))
        for (owner, key), start in zip(owners, starts):
            view = np.frombuffer(self.buffer, owner[key].dtype, len(owner[key]), int(start))
            view[:] = owner[key]
            owner[key] = view

    def log10(self, before, w, p1, u) -> np.ndarray:
        """log10 p3 of each token: its own where the trigram was seen, else by way of the lower levels."""
        pick = lambda values, at, has: np.where(has, values[np.where(has, at, 0)], 0) / -STEPS if len(values) else np.zeros(len(at))
        vi, has_v = self.words.search(before)
        at, has_w = self.pairs.search(vi * self.span + w)
        has_w &= has_v & (w < self.span)
        ci, has_u = self.contexts.search(vi * self.span + u)
        has_u &= has_v & (u < self.span)
        rank = at - self.pointers.values()[np.where(has_v, vi, 0)]
        third, has = self.grams.search(np.where(has_w & has_u, ci * self.width + rank, -1))
        has &= has_w & has_u
        lower = np.where(has_w, pick(self.p2, at, has_w), np.log10(p1) + pick(self.back2, vi, has_v))
        return np.where(has, pick(self.p3, third, has), lower + pick(self.back3, ci, has_u))


# Messages


def as_runs(key: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of tokens in the order of key and w: the step of each key from the last one and its number of tokens; the step of each w
    within its key."""
    starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    step = np.diff(w, prepend=0)
    step[starts] = w[starts]
    return np.diff(key[starts], prepend=0), np.diff(starts, append=len(key)), step


def from_runs(keys: np.ndarray, runs: np.ndarray, step: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts = np.cumsum(runs) - runs
    total = np.cumsum(step)
    return np.repeat(np.cumsum(keys), runs), total - np.repeat(total[starts] - step[starts], runs)


def changes(key: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Whether a token's key or w isn't that of the token before."""
    return np.concatenate([[True], (key[1:] != key[:-1]) | (w[1:] != w[:-1])])


def as_message(key, w, q, u, doc, n_v, n_vw, n_uv, times) -> tuple[bytes, ...]:
    """Tokens in the order of key and w, packed: as_runs; q of each distinct w; u; doc; n_v of each key; n_vw of each key and w;
    n_uv; times."""
    keys, runs, step = as_runs(key, w)
    once = np.unique(w, return_index=True)[1]
    return tuple(map(pack, (keys, runs, step, q[once], u, doc, n_v[np.cumsum(runs) - runs], n_vw[changes(key, w)], n_uv, times)))


def from_message(*packed: bytes) -> tuple[np.ndarray, ...]:
    keys, runs, step = map(unpack, packed[:3])
    q, u, doc, n_v, n_vw, n_uv, times = (narrow(unpack(x)) for x in packed[3:])
    key, w = from_runs(keys, runs, step)
    return key, w, q[np.unique(w, return_inverse=True)[1]], u, doc, np.repeat(n_v, runs), n_vw[np.cumsum(changes(key, w)) - 1], n_uv, times


@dataclass
class Tokens:
    """Of a block, in order: the documents' places, ids and training counts of words and of the two words before."""

    block: int
    train: int
    sizes: np.ndarray
    doc: np.ndarray
    w: np.ndarray
    c: np.ndarray
    v: np.ndarray
    count_v: np.ndarray
    u: np.ndarray

    def before(self, x: np.ndarray, start: int) -> np.ndarray:
        return np.where(np.concatenate([[True], self.doc[1:] != self.doc[:-1]]), start, np.concatenate([[start], x[:-1]]))


def read_tokens(table: pa.Table, train_docs: int) -> Tokens:
    """From a block and the answers to its words."""
    own = table.filter(pc.is_valid(table["codes"]))
    answers = table.filter(pc.is_valid(table["ids"])).sort_by("shard")
    ids, counts = (np.concatenate([unpack(x) for x in answers[c].to_pylist()]) for c in ("ids", "counts"))
    sizes = own["sizes"][0].values.to_numpy().astype(np.int64)
    doc = np.repeat(np.arange(len(sizes)), sizes + 1)
    codes = np.zeros(len(doc), np.int64)  # an end token stays 0
    is_word = np.ones(len(doc), bool)
    is_word[np.cumsum(sizes + 1) - 1] = False
    codes[is_word] = unpack(own["codes"][0].as_py())
    w, c = ids[codes], counts[codes]
    found = Tokens(own["block"][0].as_py(), own["train_docs"][0].as_py(), sizes, doc, w, c, w, c, w)
    found.v, found.count_v = found.before(w, START), found.before(c, train_docs)
    found.u = found.before(found.v, START)
    return found


def hot_pairs(tokens: Tokens, shards: int) -> tuple[np.ndarray, ...]:
    """Places of tokens behind a hot word and the pair of each; v, w and shards of the distinct pairs, by shard, v and w."""
    at = np.flatnonzero(tokens.count_v > HOT)
    hot, vi = np.unique(tokens.v[at], return_inverse=True)
    span = int(tokens.w.max(initial=0)) + 1
    pairs, pair = np.unique(vi * span + tokens.w[at], return_inverse=True)
    v, w = hot[pairs // span], pairs % span
    shard = (mixed(mixed(v) + w.astype(np.uint64)) % np.uint64(shards)).astype(np.int64)
    order = np.argsort(shard, kind="stable")
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return at, rank[pair], v[order], w[order], shard[order]


def ask_pairs(train_docs: int, shards: int):
    """A block's distinct pairs behind hot words, a row for each shard that has one."""

    def run(table: pa.Table) -> pa.Table:
        tokens = read_tokens(table, train_docs)
        at, pair, v, w, shard = hot_pairs(tokens, shards)
        train = np.bincount(pair[tokens.doc[at] < tokens.train], minlength=len(v))
        starts = np.flatnonzero(np.diff(shard, prepend=-1)).tolist()
        packed = [tuple(map(pack, (*as_runs(v[a:b], w[a:b]), train[a:b]))) for a, b in zip(starts, [*starts[1:], len(v)])]
        columns = [pa.array(list(x), pa.binary()) for x in (zip(*packed) if packed else [()] * 4)]
        return pa.table([pa.array(shard[starts], pa.int32()), pa.array([tokens.block] * len(starts), pa.int64()), *columns], names(PAIRS))

    return run


def count_pairs(table: pa.Table) -> pa.Table:
    """All that blocks ask of a pair shard: the counts of each block's pairs."""
    asked = [from_runs(*map(unpack, x)) for x in zip(*[table[c].to_pylist() for c in ("v", "runs", "w")])]
    v, w = map(np.concatenate, zip(*asked))
    _, vi = np.unique(v, return_inverse=True)
    _, pair = np.unique(vi * (int(w.max()) + 1) + w, return_inverse=True)
    counts = np.bincount(pair, np.concatenate([unpack(x) for x in table["train"].to_pylist()])).astype(np.int64)
    cut = np.split(counts[pair], np.cumsum([len(x) for x, _ in asked])[:-1])
    return pa.table([table["block"], table["shard"], pa.array([pack(x) for x in cut], pa.binary())], names(COUNTED))


def send(total: int, distinct: int, train_docs: int, shards: int):
    """A block with the answers to its words, and the answers to its pairs: its tokens for the shards of the trie, and a row
    with its base scores."""
    scale = total + 0.5 * (distinct + 1)

    def run(own: pa.Table, counted: pa.Table) -> pa.Table:
        tokens = read_tokens(own, train_docs)
        own = own.filter(pc.is_valid(own["codes"]))
        doc, w, c, v, count_v, u, n_docs, block = tokens.doc, tokens.w, tokens.c, tokens.v, tokens.count_v, tokens.u, len(tokens.sizes), tokens.block
        p1 = (c + 0.5) / scale
        hot_at, pair, *_ = hot_pairs(tokens, shards)
        n_vw = np.zeros(len(doc), np.int64)
        n_vw[hot_at] = np.concatenate([np.zeros(0, np.int64), *[unpack(x) for x in counted.sort_by("shard")["counts"].to_pylist()]])[pair]
        n_v, n_uv = np.where(count_v > HOT, count_v, 0), tokens.before(n_vw, train_docs)
        sent = count_v > 0
        hot = (n_v > 0) & (n_uv > HOT)
        own_part = np.bincount(doc, np.where(sent, 0.0, np.log10(p1)), n_docs)
        bits = np.clip(np.ceil(np.log2(np.maximum(count_v, 1) / HOT)), 0, PART_BITS).astype(np.int64)
        part = np.where(bits > 0, mixed(mixed(u) + mixed(w + 1) * hot.astype(np.uint64)) >> (64 - np.maximum(bits, 1)).astype(np.uint64), 0).astype(np.int64)
        key = (v << PART_BITS) | part
        shard = (mixed(key) % np.uint64(shards)).astype(np.int64)
        # each token, or each distinct u v w as a document of its own
        of_hot = np.flatnonzero(hot)
        pairs_of = np.zeros(len(doc), np.int64)
        pairs_of[hot_at] = pair
        _, first, gram = np.unique(pairs_of[of_hot] * (int(u.max(initial=0)) + 1) + u[of_hot], return_index=True, return_inverse=True)
        plain = np.flatnonzero(sent & ~hot)
        place = np.concatenate([plain, of_hot[first]])
        docs = np.concatenate([doc[plain], n_docs + np.arange(len(first))])
        times = np.concatenate([np.zeros(len(plain), np.int64), np.bincount(gram[doc[of_hot] < tokens.train], minlength=len(first))])
        n_uv = np.where(hot, n_uv, 0)
        order = np.lexsort((w[place], key[place]))
        order = order[np.argsort(shard[place[order]].astype(np.uint16 if shards < 65536 else np.int64), kind="stable")]
        place, docs, times = place[order], docs[order], times[order]
        cuts = np.flatnonzero(np.diff(shard[place], prepend=-1)).tolist()
        pieces = [slice(a, b) for a, b in zip(cuts, [*cuts[1:], len(place)])]
        quantised = np.rint(-np.log10(p1) * STEPS).astype(np.int64)
        n = len(pieces)
        message = lambda p: as_message(*[x[place[p]] for x in (key, w, quantised, u)], docs[p], *[x[place[p]] for x in (n_v, n_vw, n_uv)], times[p])
        sent_columns = zip(*[message(p) for p in pieces]) if n else [()] * 10
        packed = [pa.array([*x, None], pa.binary()) for x in sent_columns]
        last = lambda values, kind: pa.array([None] * n + [values], pa.list_(kind))
        totals = [np.bincount(doc, x, n_docs) for x in (np.ones(len(doc)), c > 0, np.log10(p1))]
        hot_columns = [pa.array([None] * n + [pack(x)], pa.binary()) for x in (np.bincount(doc[of_hot], minlength=n_docs), gram)]
        return pa.table(
            [
                pa.array([int(shard[place[a]]) for a in cuts] + [block % shards], pa.int32()), pa.array([block] * (n + 1), pa.int64()), pa.array([tokens.train] * (n + 1), pa.int32()), *packed, *hot_columns,
                pa.concat_arrays([pa.nulls(n, pa.list_(pa.int64())), own["doc_ids"].combine_chunks().cast(pa.list_(pa.int64()))]),
                last(totals[0].astype(np.int64), pa.int64()), last(totals[1].astype(np.int64), pa.int64()), last(totals[2], pa.float64()), last(own_part, pa.float64()),
            ],
            names(SENT),
        )

    return run


def answer(table: pa.Table) -> pa.Table:
    """A shard's trie and what it says: for each message its documents' sums; rows of base scores pass."""
    base = table.filter(pc.is_null(table["v"]))
    sent = table.filter(pc.is_valid(table["v"]))
    out = [pa.table([base["block"], *[pa.nulls(base.num_rows, pa.binary())] * 2, *[base[c] for c in names(PARTIAL)[3:]]], names(PARTIAL))]
    if sent.num_rows:
        messages = [from_message(*x) for x in zip(*[sent[c].to_pylist() for c in names(SENT)[3:13]])]
        sizes = np.array([len(m[0]) for m in messages])
        message = np.repeat(np.arange(len(sizes)), sizes)
        columns = [list(x) for x in zip(*messages)]
        del messages
        key, w, q, u, doc, n_v, n_vw, n_uv, times = (np.concatenate(columns.pop(0)) for _ in range(len(columns)))
        times = np.where(n_uv > 0, times, doc < sent["train_docs"].to_numpy()[message])
        p1 = 10.0 ** (q / -STEPS)
        trie = Trie(key, w, p1, u, times, n_v, n_vw, n_uv)
        del q, times, n_v, n_vw, n_uv
        scores = trie.log10(key, w, p1, u)
        del trie, key, w, p1, u
        slot = message * (int(doc.max()) + 1) + doc
        slots, inverse = np.unique(slot, return_inverse=True)
        parts = np.bincount(inverse, scores, len(slots))
        ends = np.searchsorted(slots, np.arange(len(sizes) + 1) * (int(doc.max()) + 1)).tolist()
        own = slots % (int(doc.max()) + 1)
        cut = list(zip(ends, ends[1:]))
        lists = [pa.array([pack(own[a:b]) for a, b in cut], pa.binary()), pa.array([pack(np.rint(parts[a:b] * -STEPS * FINE).astype(np.int64)) for a, b in cut], pa.binary())]
        none = [pa.nulls(len(sizes), t) for t in (pa.binary(), pa.binary(), *map(pa.list_, (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64())))]
        out.append(pa.table([sent["block"], *lists, sent["train_docs"], *none], names(PARTIAL)))
    return pa.concat_tables([t.cast(out[0].schema) for t in out])


def add_up(table: pa.Table) -> pa.Table:
    """A block's base scores and the sums of all shards: a row for each of its documents."""
    last = table.filter(pc.is_valid(table["doc_ids"]))
    take = lambda c: last[c].combine_chunks().flatten()
    doc_ids = take("doc_ids")
    sent = table.filter(pc.is_valid(table["docs"]))
    sizes, grams = (unpack(last[c][0].as_py()) for c in ("hot_sizes", "hot_grams"))
    score = np.concatenate([take("own").to_numpy(), np.zeros(int(grams.max(initial=-1)) + 1)])
    for docs, parts in zip(sent["docs"].to_pylist(), sent["parts"].to_pylist()):
        score[unpack(docs)] -= unpack(parts) / (STEPS * FINE)
    score = score[: len(doc_ids)] + np.bincount(np.repeat(np.arange(len(doc_ids)), sizes), score[len(doc_ids) + grams], len(doc_ids))
    held = np.arange(len(doc_ids)) >= last["train_docs"][0].as_py()
    return pa.table([doc_ids, pa.array(held), take("n_tokens"), take("n_known"), take("base"), pa.array(score)], names(RESULT))


def score(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of each row of `docs`.

    Training documents are those whose crc32(doc_id as text) mod 5 isn't 1; a row without an id is one of them.
    Null and empty texts have one token, the end. Repeated rows each count and each have their result; other
    columns are ignored; an empty table gives an empty result. Without training documents every token is the one
    unknown word, of probability 1.
    """
    spark = docs.sparkSession
    blocks = read_blocks(docs)
    sums = blocks.agg(F.sum(F.size("train")), F.sum(F.expr("aggregate(sizes, 0L, (a, x) -> a + x)") + F.size("sizes")), F.sum(F.expr("aggregate(train, 0L, (a, x) -> a + x)")), F.sum("train_docs")).first()
    words, tokens, total, train_docs = (int(x or 0) for x in sums)
    word_shards = max(partitions(spark), -(-words // WORD_SHARD))
    asked = blocks.select("block", "words", "train").mapInArrow(ask(word_shards), ASKED)
    known = stored(asked.groupBy("shard").applyInArrow(count_words(word_shards), KNOWN), "trie-words")
    distinct = int(known.agg(F.sum("distinct")).first()[0] or 0)
    shards = max(partitions(spark), -(-tokens // GRAM_SHARD))
    tokens_of = blocks.select("block", "train_docs", "doc_ids", "sizes", "codes")
    by_block = tokens_of.unionByName(known.select("block", "shard", "ids", "counts"), allowMissingColumns=True)  # both uses share one shuffle
    asked = by_block.groupBy("block").applyInArrow(ask_pairs(train_docs, shards), PAIRS)
    counted = asked.groupBy("shard").applyInArrow(count_pairs, COUNTED)
    sent = by_block.groupBy("block").cogroup(counted.groupBy("of")).applyInArrow(send(total, distinct, train_docs, shards), SENT)
    partial = sent.groupBy("shard").applyInArrow(answer, PARTIAL)
    result = partial.groupBy("block").applyInArrow(add_up, RESULT)
    return result.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score")


def op12_trie_model(spark, sf_dir: str) -> DataFrame:
    return score(documents(spark, sf_dir))
