"""BPE encoding and decoding with a segment tree over the ranks of adjacent pairs.

A word's symbols stand in a linked list. Leaf i of the tree holds rank * leaves + i of the
pair that starts at symbol i, or NONE where no merge applies, and each node the smaller of
its children: the root is the leftmost pair of lowest rank. A merge rewrites at most three
leaves and the nodes above them, so a word of n symbols takes O(n log n), however long.

The trees of many short words are worked on side by side as rows of one array (`merge_rows`);
a long word has a tree of its own (`merge_long`). Words are looked up by white-space
separated chunk first, so that only a chunk's first occurrence in a slice costs more than
a dictionary access. The dictionary is emptied whenever it has CACHE entries.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import documents, slices

NONE = np.int64(1) << np.int64(62)
CACHE = 100_000  # chunks kept by a task
LONGEST_ROW = 64  # pairs of a word that is merged as a row

# Fixed values of the published tokenizer: its word pattern and end-of-word mark.
WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
END = "</w>"

SEPARATORS = re.compile("[\x1c-\x1f]")  # white space to Python, not to the tokenizer
SPACES = re.compile("[^\\S\x1c-\x1f]+")


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable ones for themselves, others from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b if b in plain else next(others)) for b in range(256)]


class Known:
    """What a task keeps: by chunk, its ids and its decoded text."""

    def __init__(self):
        self.ids: dict[str, bytes] = {}
        self.decoded: dict[str, str] = {}


class PairTable:
    """(left id, right id) -> rank, or -1: a cuckoo hash with two places for each key."""

    def __init__(self, left: np.ndarray, right: np.ndarray):
        self.dict = {(a << 32) | b: r for r, (a, b) in enumerate(zip(left.tolist(), right.tolist()))}
        self.bits = max(4, (2 * len(self.dict)).bit_length())
        for attempt in range(100):
            self.factors = (np.uint64(0x9E3779B97F4A7C15 + 2 * attempt), np.uint64(0xC2B2AE3D27D4EB4F + 2 * attempt))
            if self.fill():
                return
        raise ValueError("no pair of hash factors fits")

    def fill(self) -> bool:
        size = 1 << self.bits
        keys = np.array(list(self.dict), dtype=np.uint64)
        places = [p.tolist() for p in self.places(keys)]
        held = [-1] * (2 * size)
        for i in range(len(keys)):
            at, item = places[0][i], i
            for _ in range(200):
                held[at], item = item, held[at]
                if item < 0:
                    break
                at = places[1][item] if at < size else places[0][item]
            else:
                return False
        held = np.array(held)
        values = np.fromiter(self.dict.values(), np.int64, len(keys))
        self.keys = np.where(held >= 0, keys[held], np.uint64(0xFFFFFFFFFFFFFFFF))
        self.ranks = np.where(held >= 0, values[held], -1)
        return True

    def places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        shift = np.uint64(64 - self.bits)
        one, two = ((keys * f) >> shift for f in self.factors)
        return one.astype(np.int64), two.astype(np.int64) + (1 << self.bits)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = (left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64)
        one, two = self.places(keys)
        return np.where(self.keys[one] == keys, self.ranks[one], np.where(self.keys[two] == keys, self.ranks[two], -1))


class Coder:
    """Encodes and decodes as the vocabulary file says: lower case, white space dropped, byte-level BPE with word ends."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = [""] * (1 + max([*vocab.values(), *self.special.values()]))
        for token, i in [*vocab.items(), *self.special.items()]:
            self.tokens[i] = token
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        self.merged = np.array([vocab[a + b] for a, b in merges], dtype=np.int64)
        self.pairs = PairTable(np.array([vocab[a] for a, _ in merges]), np.array([vocab[b] for _, b in merges]))
        letters = byte_letters()
        self.inner = np.array([vocab[x] for x in letters], dtype=np.int64)
        self.last = np.array([vocab[x + END] for x in letters], dtype=np.int64)
        library = Tokenizer.from_file(path)
        self.normalizer, self.splitter = library.normalizer, library.pre_tokenizer
        self.letter_bytes = {x: b for b, x in enumerate(letters)}
        self.split_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None

    # words

    def words(self, chunk: str) -> list[bytes]:
        """The chunk's words as bytes. For letters beyond Latin the library's own splitter is
        asked, whose Unicode tables are older than Python's."""
        if chunk.isascii():
            plain = chunk.lower()
            return [plain.encode()] if plain.isalpha() else [w.encode() for w in WORDS.findall(plain)]
        if max(chunk) < "\u0250":
            plain = unicodedata.normalize("NFC", chunk).lower()
            return [plain.encode()] if plain.isalpha() else [w.encode() for w in WORDS.findall(plain)]
        found = self.splitter.pre_tokenize_str(self.normalizer.normalize_str(chunk))
        return [bytes(map(self.letter_bytes.__getitem__, w)) for w, _ in found]

    def chunks(self, text: str) -> list[str]:
        """White-space separated pieces; special tokens are pieces of their own."""
        if self.split_special and "<|" in text:
            return [c for part in self.split_special.split(text) for c in ([part] if part in self.special else self.plain_chunks(part))]
        return self.plain_chunks(text)

    def plain_chunks(self, text: str) -> list[str]:
        if SEPARATORS.search(text):
            return [c for c in SPACES.split(text) if c]
        return text.split()

    def encode_chunks(self, chunks: list[str]) -> list[np.ndarray]:
        split = [self.words(chunk) for chunk in chunks]
        counts = [len(words) for words in split]
        encoded = [w for words in split for w in words]
        lengths = np.fromiter(map(len, encoded), np.int64, len(encoded))
        raw = np.frombuffer(b"".join(encoded), np.uint8)
        ends = np.cumsum(lengths)
        symbols = self.inner[raw]
        symbols[ends - 1] = self.last[raw[ends - 1]]
        ids, sizes = self.merge(symbols, ends - lengths, lengths)
        token_ends = np.concatenate([[0], np.cumsum(sizes)])
        chunk_ends = token_ends[np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])]
        return [ids[a:b] for a, b in zip(chunk_ends[:-1].tolist(), chunk_ends[1:].tolist())]

    def merge(self, symbols: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words one after another, and how many each has."""
        alive = np.ones(len(symbols), dtype=bool)
        out = symbols.copy()
        leaves = 1
        while leaves <= LONGEST_ROW:
            least = leaves // 2 + 1 if leaves > 1 else 1
            rows = np.flatnonzero((lengths - 1 >= least) & (lengths - 1 <= leaves))
            for part in np.array_split(rows, 1 + len(rows) * leaves // 400_000):
                if len(part):
                    self.merge_rows(out, alive, starts[part], lengths[part], leaves)
            leaves *= 2
        for i in np.flatnonzero(lengths - 1 > LONGEST_ROW).tolist():
            a, n = int(starts[i]), int(lengths[i])
            word = self.merge_long(symbols[a : a + n].tolist())
            out[a : a + len(word)] = word
            alive[a + len(word) : a + n] = False
        sizes = np.add.reduceat(alive, starts, dtype=np.int64) if len(starts) else np.zeros(0, np.int64)
        return out[alive].astype("<u4"), sizes

    def merge_rows(self, out: np.ndarray, alive: np.ndarray, starts: np.ndarray, lengths: np.ndarray, leaves: int) -> None:
        """Words of 2 to leaves + 1 symbols, a tree in each row; node 1 is the root, leaves come last."""
        n, width = len(starts), leaves + 2
        column = np.arange(width)
        inside = column < lengths[:, None]
        at = np.where(inside, starts[:, None] + column, 0)
        symbol = np.where(inside, out[at], -1)
        following = np.where(column + 1 < lengths[:, None], column + 1, -1)
        before = np.broadcast_to(column - 1, (n, width)).copy()
        live = inside.copy()
        tree = np.full((n, 2 * leaves), NONE)
        r, c = np.nonzero(following[:, :leaves] >= 0)
        rank = self.pairs.rank(symbol[r, c], symbol[r, c + 1])
        tree[r, leaves + c] = np.where(rank >= 0, rank * leaves + c, NONE)
        level = leaves // 2
        while level:
            tree[:, level : 2 * level] = np.minimum(tree[:, 2 * level : 4 * level : 2], tree[:, 2 * level + 1 : 4 * level : 2])
            level //= 2

        def put(row: np.ndarray, leaf: np.ndarray, value: np.ndarray | np.int64) -> None:
            node = leaf + leaves
            tree[row, node] = value
            for _ in range(leaves.bit_length() - 1):
                node >>= 1
                tree[row, node] = np.minimum(tree[row, 2 * node], tree[row, 2 * node + 1])

        def pair(row: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
            rank = self.pairs.rank(symbol[row, left], symbol[row, right])
            return np.where(rank >= 0, rank * leaves + left, NONE)

        row = np.flatnonzero(tree[:, 1] < NONE)
        while len(row):
            root = tree[row, 1]
            left = root % leaves
            right = following[row, left]
            symbol[row, left] = self.merged[root // leaves]
            live[row, right] = False
            after = following[row, right]
            following[row, left] = after
            gone = right < leaves
            put(row[gone], right[gone], NONE)
            more = after >= 0
            before[row[more], after[more]] = left[more]
            value = np.full(len(row), NONE)
            value[more] = pair(row[more], left[more], after[more])
            put(row, left, value)
            prior = before[row, left]
            has = prior >= 0
            put(row[has], prior[has], pair(row[has], prior[has], left[has]))
            row = row[tree[row, 1] < NONE]
        out[at[inside]] = symbol[inside]
        alive[at[inside]] = live[inside]

    def merge_long(self, symbol: list[int]) -> list[int]:
        n, ranks = len(symbol), self.pairs.dict
        leaves = 1 << (n - 2).bit_length()
        none, merged = int(NONE), self.merged
        tree = [none] * (2 * leaves)

        def pair(left: int, right: int) -> int:
            rank = ranks.get((symbol[left] << 32) | symbol[right])
            return none if rank is None else rank * leaves + left

        for i in range(n - 1):
            tree[leaves + i] = pair(i, i + 1)
        for node in range(leaves - 1, 0, -1):
            tree[node] = min(tree[2 * node], tree[2 * node + 1])

        def put(leaf: int, value: int) -> None:
            node = leaf + leaves
            tree[node] = value
            while node > 1:
                node >>= 1
                least = min(tree[2 * node], tree[2 * node + 1])
                if tree[node] == least:
                    return
                tree[node] = least

        following, before = [*range(1, n), -1], [*range(-1, n - 1)]
        live = [True] * n
        while (root := tree[1]) < none:
            rank, left = divmod(root, leaves)
            right = following[left]
            after = following[right]
            symbol[left] = int(merged[rank])
            live[right] = False
            following[left] = after
            if right < n - 1:
                put(right, none)
            if after >= 0:
                before[after] = left
                put(left, pair(left, after))
            else:
                put(left, none)
            if before[left] >= 0:
                put(before[left], pair(before[left], left))
        return [s for s, keep in zip(symbol, live) if keep]

    # texts

    def texts(self, texts: list[str], known: Known) -> Iterator[tuple[bytes, str]]:
        """ids as little-endian unsigned 32-bit integers, and the decoded text, of each text."""
        split = [self.chunks(t) for t in texts]
        seen = set().union(*split)
        new = seen - known.ids.keys()
        if len(known.ids) + len(new) > CACHE:
            known.ids.clear()
            known.decoded.clear()
            new = seen
        plain = list(new - self.special.keys())
        for token in new & self.special.keys():
            known.ids[token] = np.array([self.special[token]], "<u4").tobytes()
            known.decoded[token] = token
        if plain:
            encoded = self.encode_chunks(plain)
            known.ids.update(zip(plain, [ids.tobytes() for ids in encoded]))
            known.decoded.update(zip(plain, [self.decode(ids.tolist()) for ids in encoded]))
        ids_of, decoded_of = known.ids.__getitem__, known.decoded.__getitem__
        for chunks in split:
            yield b"".join(map(ids_of, chunks)), " ".join(map(decoded_of, chunks))

    def decode(self, ids: list[int]) -> str:
        """The file names no decoder: tokens are joined by spaces."""
        return " ".join([self.tokens[i] for i in ids])


def tokenize(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids (binary, little-endian unsigned 32-bit integers), decoded.

    path: the vocabulary file, read by the driver; its tables (a few MB, fixed by the file)
    are broadcast. A null or empty text has no tokens and decodes to an empty string;
    strings of special tokens in a text become those tokens. Rows are independent: repeated
    rows, null ids and other columns don't matter, an empty table gives an empty result.
    """
    packed = docs.sparkSession.sparkContext.broadcast(cloudpickle.dumps(Coder(path)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, known = cloudpickle.loads(packed.value), Known()
        for batch in batches:
            for at, part in slices(batch.column(1)):
                done = list(coder.texts([t or "" for t in part], known))
                ids = pa.array([d[0] for d in done], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(at, len(part)),
                        pa.array([len(d[0]) // 4 for d in done], pa.int64()),
                        ids,
                        pa.array([d[1] for d in done], pa.string()),
                    ],
                    ["doc_id", "n_tokens", "ids", "decoded"],
                )

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return own.mapInArrow(run, "doc_id long, n_tokens long, ids binary, decoded string")


def detokenize(tokens: DataFrame, path: str) -> DataFrame:
    """doc_id, decoded, from the binary column `ids`; null or empty ids decode to an empty string. Rows are
    independent, an empty table gives an empty result, other columns are ignored."""
    packed = tokens.sparkSession.sparkContext.broadcast(cloudpickle.dumps(Coder(path)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = cloudpickle.loads(packed.value)
        for batch in batches:
            texts = [coder.decode(np.frombuffer(x or b"", "<u4").tolist()) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "decoded"])

    own = tokens.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("ids").alias("ids"))
    return own.mapInArrow(run, "doc_id long, decoded string")


def digests(tokens: DataFrame) -> DataFrame:
    return tokens.select(
        "doc_id", "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_bpe(spark, sf_dir: str) -> DataFrame:
    return digests(tokenize(documents(spark, sf_dir), vocabulary()))
