"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes of a text.

Tokens of a batch of texts are Arrow lists. They are flattened beside their parent indices, the bytes of
the tokens summed up (a cumulative sum less the sum at the document's start), and the two sides' ends meet
in an Acero hash join on a key of document and end: what is joined cuts a document into groups. A token's
partners are those from the end before its own to its own, found by their places among the other side's ends.

Pairs of ids are coded by dictionary within a block of documents; Table.group_by gives how often a document
links each and how many documents of the block hold it. Spark sums these partial counts over all blocks and
joins the sums back by pair, and a block then needs no more than one count for each of its own pairs. Counts
are never broadcast, and a frequent pair has one row for each block.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import tiktoken
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .bpe import byte_letters
from .common import documents, slices, stored

BLOCK_BYTES = 4_000_000  # of text whose tokens make a block; a longer text is a block of its own
KNOWN = 1_000_000  # chunks whose ids a task keeps; all are forgotten beyond that,
KNOWN_CHARS = 20_000_000  # or beyond so many characters
KEY_SHIFT = 40  # bits of an end within a document

# Fixed value of the published tokenizer: its word pattern.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# Between a sign and a space before a sign: no token of A crosses such a place by its pattern, none of B as long
# as its pieces have the space only in front (checked), and neither looks beyond it. Chunks recur; texts don't.
CUTS = re.compile(r"(?<=\S)(?= \S)")

BLOCK = (
    "block long, doc_ids array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, groups array<string>, "
    "entries array<int>, codes binary, times binary, pairs array<long>, holders array<int>"
)
RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string"


class Sides:
    """The two tokenizers, and what their ids stand for."""

    def __init__(self, spec: str, model: bytes):
        vocab = json.loads(spec)["model"]["vocab"]
        letters = {x: b for b, x in enumerate(byte_letters())}
        special = {t["content"] for t in json.loads(spec)["added_tokens"]}
        ranks = {bytes(map(letters.__getitem__, token)): i for token, i in vocab.items() if token not in special}
        self.a = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.spec, self.library = spec, None
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.a_bytes = pa.array([t for t, _ in sorted(ranks.items(), key=lambda x: x[1])], pa.binary())
        self.b_bytes = pa.array([bytes([int(p[3:-1], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)], pa.binary())
        self.a_sizes, self.b_sizes = (pc.binary_length(x).to_numpy().astype(np.int64) for x in (self.a_bytes, self.b_bytes))
        self.whole = any("▁" in p.lstrip("▁") for p in pieces)  # then no cut is safe
        self.forget()
        self.a_names, self.b_names = self.names(len(self.a_bytes), "|"), self.names(len(self.b_bytes), ";")

    @staticmethod
    def names(n: int, last: str) -> pa.Array:
        """An id's decimal with the sign after it: within a group, and at n + id at a group's end."""
        return pa.array([f"{i}," for i in range(n)] + [f"{i}{last}" for i in range(n)])

    def encode_a(self, text: str) -> np.ndarray:
        try:
            return np.array(self.a.encode_ordinary(text), np.int32)
        except ValueError:  # its pattern gives up on very long white space
            if self.library is None:
                self.library = Tokenizer.from_str(self.spec)
                self.library.encode_special_tokens = True
                self.library.no_truncation()
                self.library.no_padding()
            return np.array(self.library.encode(text, add_special_tokens=False).ids, np.int32)

    def add(self, chunks: list[str]) -> None:
        """Take chunks into the known ones. They are encoded as one text where each is safe to cut off, else one by one."""
        plain = [c for c in chunks if len(c) > 1 and not c[1].isspace() and not c[-1].isspace()]
        odd = list(set(chunks).difference(plain))
        self.known.update(zip(plain + odd, range(len(self.known), len(self.known) + len(chunks))))
        text = "".join(plain)
        ends = np.cumsum(np.fromiter((len(c.encode()) for c in plain), np.int64, len(plain)))
        one_a, one_b = self.encode_a, lambda c: np.array(self.b.encode(c[1:]), np.int32)  # B adds the space
        for table, one, sizes in zip(self.tables, (one_a, one_b), (self.a_sizes, self.b_sizes)):
            ids = one(text) if plain else np.zeros(0, np.int32)
            token_ends = np.cumsum(sizes[ids])
            at = np.searchsorted(token_ends, ends)
            if plain and (at[-1] >= len(ids) or (token_ends[at] != ends).any()):
                table.append([one(c) for c in plain])
            else:
                table.append_cut(ids, at + 1)
            table.append([one(c) for c in odd])

    def encode(self, texts: list[str]) -> tuple[pa.Array, pa.Array]:
        """Ids of the two sides; lists are empty where the bytes of either aren't those of space + text."""
        spaced = [" " + t if t else "" for t in texts]
        split = [CUTS.split(t) if t else [] for t in spaced]
        if self.whole:
            split = [[t] if t else [] for t in spaced]
        if len(self.known) > KNOWN or self.held > KNOWN_CHARS:
            self.forget()
        new = list(set().union(*split) - self.known.keys())
        self.held += sum(map(len, new))
        self.add(new)
        place = self.known.__getitem__
        counts = np.fromiter(map(len, split), np.int64, len(split))
        codes = np.fromiter((place(c) for chunks in split for c in chunks), np.int64, int(counts.sum()))
        lists = [table.lists(codes, counts) for table in self.tables]
        wanted = pa.array([t.encode() for t in spaced], pa.large_binary())
        same = pc.and_(*[pc.equal(joined(x, table), wanted) for x, table in zip(lists, (self.a_bytes, self.b_bytes))])
        return tuple(x if pc.all(same).as_py() else pc.if_else(same, x, pa.scalar([], x.type)) for x in lists)

    def forget(self) -> None:
        self.known, self.tables, self.held = {}, (Table(), Table()), 0


class Table:
    """Ids of the known chunks, one after another."""

    def __init__(self):
        self.ids, self.ends = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def append(self, lists: list[np.ndarray]) -> None:
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        self.ids = np.concatenate([self.ids, *lists])
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(sizes)])

    def append_cut(self, ids: np.ndarray, ends: np.ndarray) -> None:
        self.ids, self.ends = np.concatenate([self.ids, ids]), np.concatenate([self.ends, self.ends[-1] + ends])

    def lists(self, codes: np.ndarray, counts: np.ndarray) -> pa.Array:
        """A list for each text, which has so many of the chunks."""
        starts, sizes = self.ends[codes], np.diff(self.ends)[codes]
        ends = np.cumsum(sizes)
        at = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - ends + sizes, sizes)
        text_ends = np.concatenate([[0], np.concatenate([[0], ends])[np.cumsum(counts)]])
        return pa.LargeListArray.from_arrays(text_ends, self.ids[at])


def joined(ids: pa.Array, table: pa.Array) -> pa.Array:
    taken = table.cast(pa.large_binary()).take(ids.values)
    return pc.binary_join(pa.LargeListArray.from_arrays(ids.offsets, taken).cast(pa.large_list(pa.large_binary())), pa.scalar(b"", pa.large_binary()))


class Side:
    """One side's tokens of a batch: ids, their documents, their ends in the document and in the batch."""

    def __init__(self, ids: pa.Array, sizes: np.ndarray):
        self.ids = pc.list_flatten(ids).to_numpy(zero_copy_only=False)
        self.parent = pc.list_parent_indices(ids).to_numpy(zero_copy_only=False).astype(np.int64)
        self.counts = pc.list_value_length(ids).to_numpy(zero_copy_only=False).astype(np.int64)
        self.ends = pc.cumulative_sum(pa.array(sizes[self.ids])).to_numpy(zero_copy_only=False)
        firsts = np.cumsum(self.counts) - self.counts
        before = np.concatenate([[0], self.ends])[firsts]
        self.key = (self.parent << KEY_SHIFT) | (self.ends - before[self.parent])

    def table(self, name: str) -> pa.Table:
        return pa.table({"key": self.key, name: np.arange(len(self.ids))})


def align_batch(sides: Sides, texts: list[str]) -> dict[str, object]:
    """Counts and groups of each text, and the links of all: their documents and pairs of ids."""
    lists = sides.encode(texts)
    a, b = Side(lists[0], sides.a_sizes), Side(lists[1], sides.b_sizes)
    met = a.table("i").join(b.table("j"), "key", join_type="inner", use_threads=False)
    closes = [np.zeros(len(s.ids), bool) for s in (a, b)]
    for mark, name in zip(closes, "ij"):
        mark[met[name].to_numpy()] = True
    n_groups = np.bincount(a.parent[closes[0]], minlength=len(texts))
    last = np.searchsorted(b.ends, a.ends)  # the partner in which a token of A ends
    over = b.ends[last] == a.ends if len(last) else np.zeros(0, bool)
    first = np.concatenate([[0], (last + over)[:-1]])[: len(last)]
    n = last - first + 1
    link_a = np.repeat(np.arange(len(n)), n)
    link_b = np.arange(len(link_a)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)
    return {
        "n_a": a.counts, "n_b": b.counts, "n_groups": n_groups, "n_links": np.bincount(a.parent[link_a], minlength=len(texts)),
        "groups": written(sides, a, b, closes, len(texts)),
        "link_doc": a.parent[link_a], "link_pair": (a.ids[link_a].astype(np.int64) << 32) | b.ids[link_b],
    }


def written(sides: Sides, a: Side, b: Side, closes: list[np.ndarray], n: int) -> pa.Array:
    """`a1,a2|b1;a3|b2,b3` of each text: tokens go to their places group by group and are joined as strings."""
    group = [np.cumsum(c) - c for c in closes]
    groups = int(closes[0].sum())
    sizes = [np.bincount(g, minlength=groups) for g in group]
    place_a = np.arange(len(a.ids)) + (np.cumsum(sizes[1]) - sizes[1])[group[0]]
    place_b = np.arange(len(b.ids)) + np.cumsum(sizes[0])[group[1]]
    codes = np.empty(len(a.ids) + len(b.ids), np.int64)
    shift = len(sides.a_names)
    codes[place_a] = a.ids + closes[0] * (shift // 2)
    codes[place_b] = b.ids + closes[1] * (len(sides.b_names) // 2) + shift
    names = pa.concat_arrays([sides.a_names, sides.b_names]).cast(pa.large_string())
    offsets = np.concatenate([[0], np.cumsum(a.counts + b.counts)])
    text = pc.binary_join(pa.LargeListArray.from_arrays(offsets, names.take(pa.array(codes))), pa.scalar("", pa.large_string()))
    return pc.utf8_slice_codeunits(text, 0, -1)  # without the last sign


def pack(values: np.ndarray) -> bytes:
    """Unsigned 32-bit integers, byte plane by byte plane, compressed."""
    return zstandard.compress(np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes(), 1)


def unpack(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(packed), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view("<u4").astype(np.int64)


def block_row(number: int, ids: list, parts: list[dict], whole_groups: bool) -> pa.RecordBatch:
    """One row: the block's documents, and by document the codes of its pairs and how often it links them."""
    first = np.cumsum([0, *[len(p["n_a"]) for p in parts]])
    doc = np.concatenate([p["link_doc"] + f for p, f in zip(parts, first)])
    coded = pa.array(np.concatenate([p["link_pair"] for p in parts])).dictionary_encode()
    held = pa.table({"doc": doc, "code": coded.indices}).group_by(["doc", "code"], use_threads=False).aggregate([([], "count_all")])
    holders = held.group_by("code", use_threads=False).aggregate([([], "count_all")])
    by_code = np.zeros(len(coded.dictionary), np.int32)
    by_code[holders["code"].to_numpy()] = holders["count_all"].to_numpy()
    order = np.argsort(held["doc"].to_numpy(), kind="stable")
    entries = np.bincount(held["doc"].to_numpy(), minlength=len(ids))
    groups = pa.concat_arrays([p["groups"] for p in parts])
    if not whole_groups:
        import hashlib

        groups = pa.array([hashlib.sha256(g.encode()).hexdigest() if g else "" for g in groups.to_pylist()])
    one = lambda values, kind: pa.array([values], pa.list_(kind))
    lists = [one(np.concatenate([p[c] for p in parts]), pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")]
    return pa.RecordBatch.from_arrays(
        [
            pa.array([number], pa.int64()), pa.array([ids], pa.list_(pa.int64())), *lists, pa.ListArray.from_arrays([0, len(groups)], groups.cast(pa.string())),
            one(entries, pa.int32()), pa.array([pack(held["code"].to_numpy()[order])]), pa.array([pack(held["count_all"].to_numpy()[order])]),
            one(coded.dictionary.to_numpy(zero_copy_only=False), pa.int64()), one(by_code, pa.int32()),
        ],
        [c.split()[0] for c in BLOCK.split(", ")],
    )


def blocks(docs: DataFrame, spec: str, model: str, whole_groups: bool = False) -> DataFrame:
    """The aligned documents, a row for each block of them (columns of BLOCK), written to the shared folder."""
    with open(spec, encoding="utf-8") as file, open(model, "rb") as pieces:
        files = docs.sparkSession.sparkContext.broadcast((file.read(), pieces.read()))  # a few MB, fixed by the files

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        sides, number = Sides(*files.value), TaskContext.get().partitionId() << 24
        ids, parts, size = [], [], 0
        for batch in batches:
            own = batch.column(0).to_pylist()
            for at, texts in slices(batch.column(1)):
                parts.append(align_batch(sides, [t or "" for t in texts]))
                ids += own[at : at + len(texts)]
                size += sum(map(len, filter(None, texts)))
                if size >= BLOCK_BYTES:
                    yield block_row(number, ids, parts, whole_groups)
                    ids, parts, size, number = [], [], 0, number + 1
        if ids:
            yield block_row(number, ids, parts, whole_groups)

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return stored(own.mapInArrow(run, BLOCK), "alignment-blocks")


def spread(found: DataFrame) -> DataFrame:
    """block, place, pair, holders: the partial counts, a row for each pair of a block."""
    return found.select("block", F.posexplode(F.arrays_zip("pairs", "holders")).alias("place", "x")).select("block", "place", F.col("x.pairs").alias("pair"), F.col("x.holders").alias("holders"))


def pair_counts(found: DataFrame) -> DataFrame:
    """a, b, count, best: in how many documents two ids are linked, and whether that is a's highest count. The
    highest counts, one for each id of a vocabulary, are broadcast."""
    counts = stored(spread(found).groupBy("pair").agg(F.sum("holders").alias("count")), "alignment-pairs")
    ids = counts.select("pair", F.shiftright("pair", 32).cast("int").alias("a"), F.col("pair").bitwiseAND(0xFFFFFFFF).cast("int").alias("b"), "count")
    top = ids.groupBy("a").agg(F.max("count").alias("most"))
    return ids.join(F.broadcast(top), "a").select("pair", "a", "b", "count", (F.col("count") == F.col("most")).alias("best"))


def finish(own: pa.Table, answers: pa.Table) -> pa.Table:
    """A block and the counts of its pairs: a row for each of its documents."""
    take = lambda c: own[c].combine_chunks().values
    place = answers["place"].to_numpy()
    count, best = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
    count[place], best[place] = answers["count"].to_numpy(), answers["best"].to_numpy()
    codes, times = unpack(own["codes"][0].as_py()), unpack(own["times"][0].as_py())
    ends = np.concatenate([[0], np.cumsum(take("entries").to_numpy())])
    sums = [np.diff(np.concatenate([[0], np.cumsum(times * of[codes])])[ends]) for of in (best, count)]
    return pa.table([take("doc_ids"), *[take(c) for c in ("n_a", "n_b", "n_groups", "n_links")], *map(pa.array, sums), take("groups")], [c.split()[0] for c in RESULT.split(", ")])


def align(docs: DataFrame, spec: str, model: str, whole_groups: bool = True) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups: how the tokens of tokenizer A (a byte-level
    BPE file, `spec`) and of B (a sentencepiece file, `model`) lie to each other in each text; groups as
    `a1,a2|b1;a3|b2,b3`, or the SHA-256 of it without whole_groups.

    Null and empty texts, and those that a tokenizer doesn't give back byte for byte, have zeros and an empty
    string, and count in no pair. Each row counts as a document, repeated rows and null ids too; other columns
    don't matter; an empty table gives an empty result. Ties for an id's highest count are all best.
    """
    found = blocks(docs, spec, model, whole_groups)
    answers = spread(found).join(pair_counts(found).select("pair", "count", "best"), "pair").select(F.col("block").alias("of"), "place", "count", "best")
    return found.groupBy("block").cogroup(answers.groupBy("of")).applyInArrow(finish, RESULT)


def files() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def op13_alignment(spark, sf_dir: str) -> DataFrame:
    return align(documents(spark, sf_dir), *files(), whole_groups=False).withColumnRenamed("groups", "groups_sha256")
