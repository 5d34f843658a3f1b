"""MinHash near-dedup with sequential Bayesian verification.

1. A document's distinct shingles are hashed to 64 bits; MinHashes are taken (kept to 16
   bits each), and a 128-bit digest of the sorted set. Documents of equal sets form a
   class, of which one row goes on.
2. BANDS bands of ROWS MinHashes put classes into buckets; a pair of similarity 0.75 misses
   all of them with probability 5e-6. A bucket's members are compared with two of them
   (drawn by hash), not with each other.
3. A pair's signatures are compared in batches. After each, similarity has a posterior
   (Beta, from a uniform prior); a pair goes as soon as the posterior probability of the
   threshold or more falls below MISS.
4. Of the survivors each node's best pair is verified exactly on the full shingle sets.
5. Buckets that still hold several components are gone through whole, in blocks against each
   other, each of about BLOCK members or BLOCK_HASHES shingles, whichever are fewer:
   signatures again prune pairs of different components, and the members that have a pair
   left get their full sets, from which the intersections of two blocks are counted at once.
   A task hands on members or spanning links, never pairs, and no candidate link between two
   components is lost. Members of the bucket's largest component aren't compared with each other
   and go only to the blocks of the others: what moves and is compared grows with the members
   where few stand outside of it, and as their square where a bucket has many components.
6. Components of the links; one document of each stays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checked, documents, rows_with, slices, stored
from .components import components

WORDS = 5
BANDS, ROWS = 32, 4
BATCH = 32  # MinHashes compared at once
NUMERATOR, DENOMINATOR = 75, 100  # the similarity that links
MISS = 1e-6
BLOCK, BLOCK_HASHES = 512, 1 << 18  # members of a bucket, and shingles, that a task holds of each of two blocks
KNOWN_WORDS = 100_000

ODD = np.random.default_rng(4).integers(0, 2**63, WORDS + BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
PLACES, FACTORS = ODD[:WORDS], ODD[WORDS:]
MIX = np.uint64(0xFF51AFD7ED558CCD)


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        self[word] = out = xxhash.xxh3_64_intdigest(word)
        return out


def shingles(text: str | None, known: WordHashes) -> np.ndarray:
    """Ascending hashes of the distinct shingles of a whole text; bytes.lower() changes A-Z
    only, bytes.split() splits at the six ASCII white-space characters."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    n = min(len(words), WORDS)
    total = hashes[: len(words) - n + 1] * PLACES[0]
    for i in range(1, n):
        total += hashes[i : len(words) - n + 1 + i] * PLACES[i]
    total ^= total >> np.uint64(32)
    total *= MIX
    total ^= total >> np.uint64(29)
    return np.unique(total + np.uint64(n))


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """One row of BANDS * ROWS 16-bit MinHashes for each non-empty set."""
    joined = np.concatenate(sets)
    starts = np.cumsum([0, *map(len, sets[:-1])])
    out = np.empty((len(sets), len(FACTORS)), np.uint16)
    product = np.empty_like(joined)
    for i, factor in enumerate(FACTORS):
        np.multiply(joined, factor, out=product)
        least = np.minimum.reduceat(product, starts)
        out[:, i] = (least ^ (least >> np.uint64(31))) * MIX >> np.uint64(48)
    return out


def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known = WordHashes()
    for batch in batches:
        for at, texts in slices(batch.column(1)):
            sets = [shingles(t, known) for t in texts]
            full = [s for s in sets if len(s)]
            rows = iter(signatures(full).view(np.int64).tolist() if full else [])
            prints = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(at, len(texts)),
                    batch.column(2).slice(at, len(texts)),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(prints, pa.binary()),
                    pa.array([next(rows) if len(s) else None for s in sets], pa.list_(pa.int64())),
                ],
                ["doc_id", "hash", "n_shingles", "print", "signature"],
            )


def least_matches(threshold: float, miss: float) -> list[int]:
    """After each batch, the fewest matches at which the posterior probability of `threshold` or more is at least `miss`."""
    grid = (np.arange(20_000) + 0.5) / 20_000
    out = []
    for n in range(BATCH, BANDS * ROWS + 1, BATCH):
        for m in range(n + 1):
            logs = m * np.log(grid) + (n - m) * np.log1p(-grid)
            weight = np.exp(logs - logs.max())
            if weight[grid >= threshold].sum() >= miss * weight.sum():
                out.append(m)
                break
    return out


def compare(least: list[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            one, two = (flat(batch.column(i)) for i in (2, 3))
            alive, matches = np.arange(len(one)), np.zeros(len(one), np.int64)
            for k, fewest in enumerate(least):
                span = slice(k * BATCH, (k + 1) * BATCH)
                matches[alive] += (one[alive, span] == two[alive, span]).sum(axis=1)
                alive = alive[matches[alive] >= fewest]
            index = pa.array(alive)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(index), batch.column(1).take(index), pa.array(matches[alive].astype(np.int32))], ["a", "b", "matches"]
            )

    return run


def flat(column: pa.ListArray) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint16).reshape(len(column), BANDS * ROWS)


def full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known = WordHashes()
    for texts in (t for batch in batches for _, t in slices(batch.column(0))):
        sets = [shingles(t, known) for t in texts]
        prints = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
        yield pa.RecordBatch.from_arrays([pa.array(prints, pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())], ["print", "hashes"])


def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        linked = []
        for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            one, two = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            both = np.sort(np.concatenate([one, two]), kind="stable")
            common = int((both[1:] == both[:-1]).sum())
            linked.append(DENOMINATOR * common >= NUMERATOR * (len(one) + len(two) - common))
        index = pa.array(np.flatnonzero(linked))
        yield pa.RecordBatch.from_arrays([batch.column(0).take(index), batch.column(1).take(index)], ["a", "b"])


KEY = ["bucket", "left", "right"]  # a bucket, and two of its blocks (or one twice)


def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Runs of equal KEY in sorted batches (columns 0 to 2)."""
    held: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = table if held is None else pa.concat_tables([held, table])
        keys = np.stack([table.column(i).to_numpy() for i in range(3)], axis=1)
        starts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
        at = 0
        for end in starts.tolist():
            yield table.slice(at, end - at)
            at = end
        held = table.slice(at).combine_chunks()
    if held is not None and held.num_rows:
        yield held


def across(block: np.ndarray, left: int, right: int) -> np.ndarray:
    """Which pairs of rows a group answers for."""
    if left == right:
        return np.triu(np.ones((len(block), len(block)), bool), 1)
    return (block == left)[:, None] & (block == right)[None, :]


def screen(least: list[int]):
    """Of each group the members that have a pair left: of different components, in no earlier band
    together, and not pruned by its signatures. Columns: KEY, band, block, node, root, signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches):
            block, node, root = (group.column(i).to_numpy() for i in (4, 5, 6))
            bands = group.column(7).combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(node), BANDS)
            hashes = bands.view(np.uint16).reshape(len(node), BANDS * ROWS)
            band = group.column(3)[0].as_py()
            wanted = across(block, group.column(1)[0].as_py(), group.column(2)[0].as_py()) & (root[:, None] != root[None, :])
            busy = np.zeros(len(node), bool)
            for i in range(0, len(node), 32):
                pairs = wanted[i : i + 32]
                if not pairs.any():
                    continue
                if band:
                    pairs = pairs & ~(bands[i : i + 32, None, :band] == bands[None, :, :band]).any(axis=2)
                same = hashes[i : i + 32, None] == hashes[None]
                counts = same.reshape(*same.shape[:2], -1, BATCH).sum(axis=3).cumsum(axis=2)
                pairs = pairs & (counts >= np.array(least)).all(axis=2)
                busy[i : i + 32] |= pairs.any(axis=1)
                busy |= pairs.any(axis=0)
            if busy.any():
                index = pa.array(np.flatnonzero(busy))
                kept = group.take(index)
                names = [*KEY, "block", "node", "root"]
                yield from pa.table([kept.column(i) for i in (0, 1, 2, 4, 5, 6)], names).combine_chunks().to_batches()

    return run


def spanning(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Exact links within each group as a, b: every linked member with the smallest it reaches there.
    Columns: KEY, block, node, root, hashes."""
    for group in groups(batches):
        block, node, root = (group.column(i).to_numpy() for i in (3, 4, 5))
        wanted = across(block, group.column(1)[0].as_py(), group.column(2)[0].as_py()) & (root[:, None] != root[None, :])
        hashes = group.column(6).combine_chunks()
        sizes = pc.binary_length(hashes).to_numpy() // 8
        common = intersections(np.concatenate([np.frombuffer(x.as_buffer(), np.uint64) for x in hashes]), sizes)
        linked = wanted & ((DENOMINATOR + NUMERATOR) * common >= NUMERATOR * (sizes[:, None] + sizes[None, :]))
        del common
        linked |= linked.T
        best = np.arange(len(node))
        while linked.any():
            smaller = np.minimum(best, np.where(linked, best[None, :], len(node)).min(axis=1))
            if (smaller == best).all():
                break
            best = smaller
        found = np.flatnonzero(best != np.arange(len(node)))
        yield pa.RecordBatch.from_arrays([pa.array(node[found]), pa.array(node[best[found]])], ["a", "b"])


def intersections(hashes: np.ndarray, sizes: np.ndarray, width: int = 1024) -> np.ndarray:
    """Sizes of all intersections of sets that stand one after another in `hashes`: products of 0/1 matrices,
    `width` shared hashes at a time."""
    order = np.argsort(hashes, kind="stable")
    row = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)[order]
    ordered = hashes[order]
    del order
    starts = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    times = np.diff(np.append(starts, len(ordered)))
    del ordered
    shared = times > 1
    column = np.repeat(np.cumsum(shared, dtype=np.int32) - 1, times)
    keep = np.repeat(shared, times)
    row, column = row[keep], column[keep]
    common = np.zeros((len(sizes), len(sizes)), np.float32)
    for start in range(0, int(shared.sum()), width):
        a, b = np.searchsorted(column, [start, start + width])
        part = np.zeros((len(sizes), width), np.float32)
        part[row[a:b], column[a:b] - start] = 1
        common += part @ part.T
    return common.astype(np.int64)


def tiles(inside: DataFrame) -> DataFrame:
    """bucket, left, right, band, block, node, root: members of buckets with several components, once for each pair of
    blocks that they have to be compared in. inside: bucket, band, size, hashes, node, root.

    Members of a bucket's largest component, which need no comparison with each other, have blocks of their own and go to
    the blocks of the others only; these go to all. So what moves is members times the others' blocks, and
    others times all blocks: in proportion to the members where few of them stand outside of the largest component."""
    roots = inside.groupBy("bucket", "root").agg(F.count("*").alias("n"))
    largest = roots.groupBy("bucket").agg(F.max(F.struct("n", "root")).alias("most"), F.count("*").alias("roots")).where("roots > 1")
    mixed = stored(largest.select("bucket", F.col("most.root").alias("largest"), F.col("most.n").alias("inner")), "near-mixed")
    needed = lambda n: F.ceil(F.greatest(n / BLOCK, F.col("hashes") * (n / F.col("size")) / BLOCK_HASHES)).cast("int")
    rows = inside.join(mixed, "bucket").withColumns({"own": F.col("root") == F.col("largest"), "inside": needed(F.col("inner")), "outside": needed(F.col("size") - F.col("inner"))})
    order = F.xxhash64("node")
    block = F.when(F.col("own"), F.col("outside") + F.pmod(order, F.col("inside"))).otherwise(F.pmod(order, F.col("outside")))
    last = F.when(F.col("own"), F.col("outside") - 1).otherwise(F.col("outside") + F.col("inside") - 1)
    placed = rows.withColumn("block", block.cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), last)))
    return placed.select("bucket", F.least("block", "other").alias("left"), F.greatest("block", "other").alias("right"), "band", "block", "node", "root")


class Verifier:
    """Links among candidate pairs of classes; `texts` has rep (a document of the class) and text."""

    def __init__(self, classes: DataFrame, texts: DataFrame):
        self.classes, self.texts = classes, texts
        self.least = least_matches(NUMERATOR / DENOMINATOR, MISS)

    def survivors(self, pairs: DataFrame) -> DataFrame:
        one = self.classes.select(F.col("node").alias("a"), F.col("signature").alias("sig_a"))
        two = self.classes.select(F.col("node").alias("b"), F.col("signature").alias("sig_b"))
        both = pairs.join(one, "a").join(two, "b").select("a", "b", "sig_a", "sig_b")
        return both.mapInArrow(compare(self.least), "a long, b long, matches int")

    def sets(self, nodes: DataFrame) -> DataFrame:
        """node, hashes: full shingle sets of distinct nodes, from the texts of their representatives."""
        needed = self.classes.select("node", "print", "rep").join(nodes, "node")
        reps = checked(needed.select(F.col("rep").alias("id")).distinct(), "near-reps")
        texts = self.texts.join(reps, F.col("rep").eqNullSafe(F.col("id")), "left_semi").select("text")
        found = texts.mapInArrow(full_sets, "print binary, hashes binary").join(needed, "print")
        return stored(found.dropDuplicates(["node"]).select("node", "hashes"), "near-sets")

    def best_links(self, pairs: DataFrame) -> DataFrame:
        """4.: exact links among each node's best surviving pair."""
        best = stored(
            self.survivors(pairs).groupBy("b").agg(F.max_by("a", F.struct("matches", "a")).alias("a")).select("a", "b"), "near-best"
        )
        sets = self.sets(best.select(F.explode(F.array("a", "b")).alias("node")).distinct())
        one = sets.select(F.col("node").alias("a"), F.col("hashes").alias("set_a"))
        two = sets.select(F.col("node").alias("b"), F.col("hashes").alias("set_b"))
        both = best.join(one, "a").join(two, "b").select("a", "b", "set_a", "set_b")
        return stored(both.mapInArrow(verify, "a long, b long"), "near-links")

    def block_links(self, members: DataFrame, found: DataFrame) -> DataFrame:
        """5.: spanning links between components, from all pairs of members of mixed buckets."""
        inside = stored(
            members.join(found, "node", "left").select("bucket", "band", "size", "hashes", "node", F.coalesce("root", "node").alias("root")), "near-inside"
        )
        paired = tiles(inside)
        signed = paired.join(self.classes.select("node", "signature"), "node")
        ordered = signed.select(*KEY, "band", "block", "node", "root", "signature").repartition(*KEY).sortWithinPartitions(*KEY)
        busy = stored(ordered.mapInArrow(screen(self.least), "bucket long, left int, right int, block int, node long, root long"), "near-busy")
        if busy.isEmpty():
            return busy.select(F.col("node").alias("a"), F.col("root").alias("b"))
        full = busy.join(self.sets(busy.select("node").distinct()), "node")
        ordered = full.select(*KEY, "block", "node", "root", "hashes").repartition(*KEY).sortWithinPartitions(*KEY)
        return stored(ordered.mapInArrow(spanning, "a long, b long"), "near-links")


def near_groups(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for each row of `docs`.

    Words are lower-cased (A-Z) and split at ASCII white space; shorter texts than WORDS
    words are one shingle. A text that is null or without words has no shingles and links
    with nothing, itself excepted. Rows of equal sets are linked; component_id is the
    smallest doc_id reached, null ones left aside. Repeated rows carry the same values, an
    empty table gives an empty result, other columns are ignored.
    """
    return decisions(docs).drop("hash")


def decisions(docs: DataFrame) -> DataFrame:
    """`near_groups` with a hash of each row's text."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    hashed = own.withColumn("hash", F.xxhash64("text"))
    sketched = stored(hashed.mapInArrow(sketch, "doc_id long, hash long, n_shingles long, print binary, signature array<long>"), "near-sketches")
    classes = stored(
        sketched.where("print IS NOT NULL")
        .groupBy("print")
        .agg(F.min("doc_id").alias("rep"), F.min("signature").alias("signature"), F.min("n_shingles").alias("n"), F.count("*").alias("rows"))
        .withColumn("node", F.monotonically_increasing_id()),
        "near-classes",
    )
    bands = classes.select("node", "n", F.posexplode("signature").alias("band", "value")).select(
        "node", "n", "band", F.xxhash64("band", "value").alias("bucket")
    )
    order = F.xxhash64("node", "bucket")  # each bucket compares with two members of its own
    shared = bands.groupBy("bucket").agg(
        F.min(F.struct(order.alias("h"), "node")).alias("low"), F.max(F.struct(order.alias("h"), "node")).alias("high"),
        F.count("*").alias("size"), F.sum("n").alias("hashes"),
    )
    buckets = stored(shared.where("size > 1").select("bucket", F.col("low.node").alias("low"), F.col("high.node").alias("high"), "size", "hashes"), "near-buckets")
    members = stored(bands.drop("n").join(buckets, "bucket"), "near-members")
    pairs = (
        members.select("node", F.explode(F.array("low", "high")).alias("other"))
        .where("node != other")
        .select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b"))
        .distinct()
    )
    verifier = Verifier(classes, own.select(F.col("doc_id").alias("rep"), "text"))
    links = verifier.best_links(pairs)
    more = verifier.block_links(members, components(links))
    found = components(links.unionByName(more))
    placed = classes.select("node", "print", "rep", "rows").join(found, "node", "left").withColumn("root", F.coalesce("root", "node"))
    smallest = placed.join(found, "node", "left_semi").groupBy("root").agg(F.min("rep").alias("component_id"))
    moved = placed.join(stored(smallest, "near-roots"), "root", "left").where("rows > 1 OR component_id IS NOT NULL")
    table = stored(moved.select("print", F.coalesce("component_id", "rep").alias("component_id"), F.lit(True).alias("grouped")), "near-table")
    component = F.when(F.col("grouped"), F.col("component_id")).otherwise(F.col("doc_id"))
    return sketched.select("doc_id", "hash", "n_shingles", "print").join(table, "print", "left").select(
        "doc_id", "hash", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept")
    )


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """The rows of `docs` that stay, with all their columns: one document of each component
    (the smallest doc_id). Rows with a null doc_id stay. A row goes for its own text: where a doc_id stands
    at several texts, those that link with nothing stay. An empty table gives an empty one."""
    found = stored(decisions(docs).select("doc_id", "hash", "kept"), "near-decisions")
    return rows_with(docs, F.xxhash64(F.col("text").cast("string")), found.where("NOT kept AND doc_id IS NOT NULL"), "left_anti")


def op4_near_dedup(spark, sf_dir: str) -> DataFrame:
    return near_groups(documents(spark, sf_dir))
