"""Exact dedup by a Golomb-coded exchange of fingerprints.

1. Every row gets a 64-bit fingerprint of its normalised text (a small table is written).
2. Senders (slices of that table's partitions) sort their distinct fingerprints, cut them
   by owner (equal ranges of the hash), Golomb-code the gaps and send one message to each
   owner, with a bitmap of those that the sender itself holds more than once.
3. Owners decode the messages of their range and answer each with a bitmap: bit i is set
   if fingerprint i of the message also came from elsewhere, or twice from the sender.
4. Senders turn the bitmaps into suspects. While there are at most BROADCAST_ROWS distinct
   ones, they are broadcast, and only documents with a suspect fingerprint are shuffled;
   beyond that rows and suspects meet by shuffle. Their texts are grouped, first where they
   are and then after the shuffle, by the normalised text itself: equality of bytes decides.

A sender holds one slice and an owner one range of the hash, each of bounded size; a
fingerprint that a third of all rows share is sent once by each sender, and a text once by
each task that has it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, checked, documents, partitions, rows_with, stored, whole

SLICE_ROWS = 1 << 20  # fingerprints a sender sorts at once
OWNER_ROWS = 2_000_000  # fingerprints an owner's range aims at

MESSAGE = "owner int, sender long, n long, first long, bits int, unary binary, rest binary, twice binary"
ANSWER = "owner int, sender long, marks binary"


def golomb_encode(values: np.ndarray) -> tuple[int, int, bytes, bytes]:
    """first, bits, unary, rest: the gaps of ascending distinct uint64 values in Golomb-Rice
    code. Quotients by 2^bits go in unary (zeros, then a one), remainders side by side."""
    gaps = np.diff(values)
    mean = int((int(values[-1]) - int(values[0])) // max(1, len(gaps)))
    bits = max(0, mean.bit_length() - 1)
    quotients = (gaps >> np.uint64(bits)).astype(np.int64)
    unary = np.zeros(int(quotients.sum()) + len(gaps), dtype=np.uint8)
    unary[np.cumsum(quotients + 1) - 1] = 1
    shifts = np.arange(bits - 1, -1, -1, dtype=np.uint64)
    rest = ((gaps[:, None] >> shifts) & np.uint64(1)).astype(np.uint8)
    return int(values[0]), bits, np.packbits(unary).tobytes(), np.packbits(rest.ravel()).tobytes()


def golomb_decode(n: int, first: int, bits: int, unary: bytes, rest: bytes) -> np.ndarray:
    ones = np.flatnonzero(np.unpackbits(np.frombuffer(unary, np.uint8)))[: n - 1]
    gaps = (np.diff(ones, prepend=-1) - 1).astype(np.uint64) << np.uint64(bits)
    if bits and n > 1:
        digits = np.unpackbits(np.frombuffer(rest, np.uint8), count=(n - 1) * bits).reshape(n - 1, bits)
        for i in range(bits):
            gaps |= digits[:, i].astype(np.uint64) << np.uint64(bits - 1 - i)
    return np.cumsum(np.concatenate([np.array([first], np.uint64), gaps]), dtype=np.uint64)


def unsigned(signed) -> np.ndarray:
    return np.asarray(signed, dtype=np.int64).view(np.uint64)


def send(owners: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        def messages(held: list[np.ndarray], number: int) -> pd.DataFrame:
            prints, counts = np.unique(np.concatenate(held), return_counts=True)
            owner = ((prints >> np.uint64(32)) * np.uint64(owners) >> np.uint64(32)).astype(np.int64)
            sender = (TaskContext.get().partitionId() << 24) + number
            rows = []
            for o, start, end in zip(*cuts(owner)):
                own = prints[start:end]
                first, bits, unary, rest = golomb_encode(own)
                signed = int(np.array([first], np.uint64).view(np.int64)[0])
                rows.append((o, sender, len(own), signed, bits, unary, rest, np.packbits(counts[start:end] > 1).tobytes()))
            return pd.DataFrame(rows, columns=[c.split()[0] for c in MESSAGE.split(", ")])

        held, size, number = [], 0, 0
        for batch in batches:
            held.append(unsigned(batch["fingerprint"]))
            size += len(batch)
            if size >= SLICE_ROWS:
                yield messages(held, number)
                held, size, number = [], 0, number + 1
        if size:
            yield messages(held, number)

    return run


def cuts(owner: np.ndarray):
    at = np.flatnonzero(np.diff(owner, prepend=-1))
    return owner[at].tolist(), at.tolist(), [*at[1:].tolist(), len(owner)]


def decode(m) -> np.ndarray:
    first = int(np.array([m.first], np.int64).view(np.uint64)[0])
    return golomb_decode(m.n, first, m.bits, m.unary, m.rest)


def answer(messages: pd.DataFrame) -> pd.DataFrame:
    """All messages to one owner: a bitmap for each, in the message's order."""
    sent = [decode(m) for m in messages.itertuples()]
    values, counts = np.unique(np.concatenate(sent), return_counts=True)
    repeated = values[counts > 1]
    rows = []
    for m, own in zip(messages.itertuples(), sent):
        twice = np.unpackbits(np.frombuffer(m.twice, np.uint8), count=m.n).astype(bool)
        rows.append((m.owner, m.sender, np.packbits(np.isin(own, repeated, assume_unique=True) | twice).tobytes()))
    return pd.DataFrame(rows, columns=["owner", "sender", "marks"])


def suspects(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for m in batch.itertuples():
            marks = np.unpackbits(np.frombuffer(m.marks, np.uint8), count=m.n).astype(bool)
            if marks.any():
                yield pd.DataFrame({"fingerprint": decode(m)[marks].view(np.int64)})


def body() -> Column:
    """The normalised text."""
    return ascii_lower(whole())


def exact_groups(docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for each row of `docs`.

    Texts are equal if they are after lower-casing A-Z; null counts as empty. The largest
    doc_id of a group stays; a null doc_id is smaller than any, and a group of nulls only
    has a null keep_id. Rows repeated with doc_id and text count each in group_size and all
    carry the same kept. An empty table gives an empty result. Other columns are ignored.
    """
    return decisions(docs).drop("fingerprint")


def decisions(docs: DataFrame) -> DataFrame:
    """`exact_groups` with the fingerprint of each row's text."""
    spark = docs.sparkSession
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), body().alias("body"))
    prints = stored(
        own.select("doc_id", F.xxhash64("body").alias("fingerprint"), F.sha2("body", 256).alias("text_sha256")),
        "exact-fingerprints",
    )
    owners = max(partitions(spark), -(-prints.count() // OWNER_ROWS))
    messages = stored(prints.select("fingerprint").mapInPandas(send(owners), MESSAGE), "exact-messages")
    answers = messages.groupBy("owner").applyInPandas(answer, ANSWER)
    suspect = checked(messages.join(answers, ["owner", "sender"]).mapInPandas(suspects, "fingerprint long").distinct(), "exact-suspects")
    groups = stored(
        own.withColumn("fingerprint", F.xxhash64("body"))
        .join(suspect, "fingerprint", "left_semi")
        .groupBy("body")
        .agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
        .where("group_size > 1")
        .select(F.sha2("body", 256).alias("text_sha256"), "keep_id", "group_size"),
        "exact-groups",
    )
    joined = prints.join(groups, "text_sha256", "left")
    keep = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return joined.select(
        "doc_id",
        keep.alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"),
        "text_sha256",
        "fingerprint",
    )


def drop_copies(docs: DataFrame) -> DataFrame:
    """The rows of `docs` that stay, with all their columns. Of rows repeated with the same doc_id and equal
    texts one stays; rows with a null doc_id stay. A row goes for its own text: where a doc_id stands at
    several texts, those without a copy elsewhere stay. An empty table gives an empty one."""
    hashed = F.xxhash64(body())
    groups = stored(decisions(docs).where("doc_id IS NOT NULL").select("doc_id", F.col("fingerprint").alias("hash"), "kept"), "exact-decisions")
    left = rows_with(docs, hashed, groups.where("NOT kept"), "left_anti")
    repeated = stored(groups.where("kept").groupBy("doc_id", "hash").count().where("count > 1"), "exact-repeated")
    if repeated.isEmpty():
        return left
    once = rows_with(left, hashed, repeated, "left_semi").select(F.struct("*").alias("row"), F.col("doc_id").alias("own_id"), hashed.alias("own_hash"))
    return rows_with(left, hashed, repeated, "left_anti").unionByName(once.dropDuplicates(["own_id", "own_hash"]).select("row.*"))


def op6_exact_dedup(spark, sf_dir: str) -> DataFrame:
    return exact_groups(documents(spark, sf_dir))


OP6_SQL = """
WITH t AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS body FROM documents),
g AS (SELECT body, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY body)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(body) AS text_sha256
FROM t JOIN g USING (body)
"""
