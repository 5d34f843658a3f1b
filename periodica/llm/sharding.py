"""Sharding by a hypergeometric communication matrix, with DataFrame functions only.

Rows fall into blocks by hash. The driver draws from the block sizes alone how many rows
of each block go to each shard: a contingency table whose margins are the block sizes and
the shard sizes, each cell hypergeometric given those before it. Every block permutes its
rows by a keyed hash and deals them out by its row of the table; every shard permutes what
it has received by a second hash. The result is a uniform shuffle with exact shard sizes
(law `rows`: counts at most one apart), up to the quality of the hash.

Neither permutation needs all rows of a block or shard in one task: they are permuted as
parts of about BLOCK_ROWS rows in hash order, whose offsets come from their counts. Hashes
take in a number of the row beside its values, so that repeated rows are spread like others.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import checked, documents, stored

SHARDS = 24
BLOCK_ROWS = 100_000  # rows a block, and a part of a larger one, aims at
MIN_BLOCKS, MAX_BLOCKS = 256, 4096  # so that the table has at most 4096 x shards cells; larger blocks have parts


def hypergeometric(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    """How many of `n` draws without replacement are good; by inversion around the mode.

    Unlike numpy's own it has no bound of 10^9; the tails beyond 12 standard deviations
    (below 10^-30) are left out.
    """
    low, high = max(0, n - bad), min(n, good)
    if low == high:
        return low
    total = good + bad
    mode = min(high, max(low, (n + 1) * (good + 1) // (total + 2)))
    spread = np.sqrt(max(n * (good / total) * (bad / total) * ((total - n) / max(total - 1, 1)), 0.0))
    reach = int(12 * spread) + 24
    a, b = max(low, mode - reach), min(high, mode + reach)
    k = np.arange(a, b, dtype=np.float64)
    step = np.log((good - k) * (n - k)) - np.log((k + 1) * (bad - n + k + 1))
    logs = np.concatenate([[0.0], np.cumsum(step)])
    cumulated = np.cumsum(np.exp(logs - logs.max()))
    return a + int(np.searchsorted(cumulated, rng.random() * cumulated[-1], side="right"))


def communication_matrix(blocks: list[int], shards: list[int], seed: int) -> list[list[int]]:
    """Rows: blocks, columns: shards; both margins are met exactly."""
    rng, left, table = np.random.default_rng(seed), list(shards), []
    for size in blocks:
        row, todo, rest = [], size, sum(left)
        for s, room in enumerate(left):
            rest -= room
            got = hypergeometric(rng, room, rest, todo)
            row.append(got)
            todo -= got
            left[s] -= got
        table.append(row)
    return table


def shard(docs: DataFrame, shards: int = SHARDS, seed: int = 17) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for each row of `docs`.

    A null text has size 8 and checksum 0; a null doc_id is hashed as such. Repeated rows
    get slots of their own (they can't be told apart, so which gets which is immaterial).
    Rows are numbered as they are read and written once; a task that is run again deals alike.
    An empty table gives an empty result. Other columns of `docs` are ignored.
    """
    spark = docs.sparkSession
    text = F.coalesce("text", F.lit(""))
    rows = stored(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            (F.octet_length(text) + F.lit(8)).cast("long").alias("size"),
            F.crc32(text).alias("text_crc32"),
            F.monotonically_increasing_id().alias("number"),
        ),
        "shard-rows",
    )
    total = rows.count()
    blocks = min(MAX_BLOCKS, max(MIN_BLOCKS, -(-total // BLOCK_ROWS)))
    fields = ("doc_id", "text_crc32", "size", "number")
    keyed = lambda k: F.xxhash64(F.lit(seed), F.lit(k), *fields)
    dealt = rows.withColumn("block", F.pmod(keyed(0), F.lit(blocks)).cast("int"))
    counted = {r["block"]: r["count"] for r in dealt.groupBy("block").count().collect()}  # at most 4096 rows
    sizes = [total // shards + (s < total % shards) for s in range(shards)]
    table = communication_matrix([counted.get(b, 0) for b in range(blocks)], sizes, seed)
    ends = np.cumsum(np.array(table, dtype=np.int64).reshape(blocks, shards), axis=1)
    text_of = ";".join(",".join(map(str, row)) for row in ends.tolist())
    bounds = spark.range(1).select(
        F.posexplode(F.split(F.lit(text_of), ";")).alias("block", "ends")
    ).select("block", F.split("ends", ",").cast("array<long>").alias("ends"))

    # permute locally, deal out
    parts = -(-total // (blocks * BLOCK_ROWS))
    sent = (
        permuted(dealt.withColumn("part", F.pmod(keyed(4), F.lit(max(1, parts))).cast("int")), "block", keyed(1), fields)
        .join(F.broadcast(bounds), "block")  # at most 4096 rows of `shards` numbers
        .select(*fields, F.size(F.filter("ends", lambda e: e < F.col("rank"))).cast("int").alias("shard"))
    )
    parts = max(1, blocks // shards, -(-total // (shards * BLOCK_ROWS)))
    received = stored(sent.withColumn("part", F.pmod(keyed(2), F.lit(parts)).cast("int")), "shard-dealt")

    # permute again
    return permuted(received, "shard", keyed(3), fields).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
        (F.col("rank") - 1).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def permuted(rows: DataFrame, whole: str, key: Column, fields: tuple[str, ...]) -> DataFrame:
    """rows with rank (from 1) inside each value of `whole`: its parts in order of their number, rows of a part by key."""
    before = Window.partitionBy(whole).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counted = rows.groupBy(whole, "part").count()
    offsets = counted.select(whole, "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy(whole, "part").orderBy(key, *fields)
    ranked = rows.withColumn("own_rank", F.row_number().over(inside)).join(checked(offsets, "shard-offsets"), [whole, "part"])
    return ranked.withColumn("rank", F.col("offset") + F.col("own_rank")).drop("part", "own_rank", "offset")


def op3_sharding(spark, sf_dir: str) -> DataFrame:
    return shard(documents(spark, sf_dir))
