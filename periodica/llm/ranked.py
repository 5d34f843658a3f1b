"""Ranked lexical search over a length-stratified index.

A document counts for a query through its normaliser m, which its length alone decides: documents with equal
m make a stratum, and in a stratum a term's part of the score depends only on how often it occurs (tf). The
index keeps the postings of a stratum by term and, within a term, by tf, so that an impact is computed once for
each tf. A stratum is cut into blocks of bounded size by a hash of the rows.

No score in a stratum is above its bound for an item: the item's weights times the impacts of each term's highest
tf there. The strata of highest bound are visited first; of the others only those whose bound isn't below the
item's tenth best score so far. This leaves out no document that could be among the best ten.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import checked, documents, stored, whole

BLOCK_TERMS = 1_000_000  # term occurrences of a block, about; a longer document is a block of its own
FIRST = 8  # strata that each item visits first
ITEMS_AT_ONCE = 2_000  # items whose terms go to all tasks together; more are taken in turns
LENGTH = 75  # hundredths in which the length counts
SCALE = 1_000_000_000
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: The same signs one by one, which Java's patterns look up in a table: a term with what stands before and behind it.
NO_TERM = "".join(f"\\x{i:02X}" for i in range(128) if not chr(i).isalnum())
AROUND = f"[{NO_TERM}]*[^{NO_TERM}]+[{NO_TERM}]*"

#: Every byte of a sign that no term has becomes a space, A-Z become a-z.
BYTES = bytes(i if i > 127 or 48 <= i < 58 or 97 <= i < 123 else i + 32 if 65 <= i < 91 else 32 for i in range(256))

INDEX = "m long, block int, term string, df int, top int, tfs array<int>, sizes array<int>, places array<int>, doc_ids array<long>"
FOUND = "item long, doc_id long, score long"


def terms(text: str) -> list[bytes]:
    return text.encode().translate(BYTES).split()


class Index(NamedTuple):
    """postings: a row for each term of a block, with the tfs it has there (ascending), how many documents have
    each and their places in the block; and a row with an empty term that has the block's documents.
    documents and terms: how many documents have a term, and how many terms these have in all."""

    postings: DataFrame
    documents: int
    terms: int


def invert(table: pa.Table) -> pa.Table:
    """The documents of a block of a stratum: its postings."""
    m, block = table["m"][0].as_py(), table["block"][0].as_py()
    codes: dict[bytes, int] = {}
    own, held, sizes = [], [], []
    for batch in table.select(["text"]).to_batches():
        for text in batch.column(0):
            counts: dict[bytes, int] = {}
            for t in terms(text.as_py()):
                counts[t] = counts.get(t, 0) + 1
            own.append(np.fromiter((codes.setdefault(t, len(codes)) for t in counts), np.int64, len(counts)))
            held.append(np.fromiter(counts.values(), np.int64, len(counts)))
            sizes.append(len(counts))
    code, tf, place = np.concatenate(own), np.concatenate(held), np.repeat(np.arange(len(sizes)), sizes)
    order = np.lexsort((place, tf, code))
    code, tf, place = code[order], tf[order], place[order]
    runs = np.flatnonzero(np.diff(code, prepend=-1) | np.diff(tf, prepend=-1))  # a term's documents of one tf
    firsts = np.flatnonzero(np.diff(code[runs], prepend=-1))  # the first of each term
    run_sizes = np.diff(runs, append=len(code))
    ends = np.append(firsts, len(runs))
    lists = lambda at, values: pa.ListArray.from_arrays(np.concatenate([[0], at]).astype(np.int32), pa.array(values.astype(np.int32)))
    n = len(firsts)
    docs = pa.ListArray.from_arrays(pa.array([0, table.num_rows, *[table.num_rows] * n], pa.int32()), table["doc_id"].combine_chunks())
    names = pa.array(list(codes), pa.binary()).cast(pa.string())
    return pa.table(
        [
            pa.array(np.full(n + 1, m)), pa.array(np.full(n + 1, block, np.int32)), pa.concat_arrays([pa.array([""]), names]),
            pa.array(np.diff(np.append(runs[firsts], len(code)), prepend=0).astype(np.int32)), pa.array(np.concatenate([[0], tf[runs[ends[1:] - 1]]]).astype(np.int32)),
            lists(ends, tf[runs]), lists(ends, run_sizes), lists(np.append(runs[firsts], len(code)), place), docs,
        ],
        [c.split()[0] for c in INDEX.split(", ")],
    )


def build_index(docs: DataFrame) -> Index:
    """The index of all rows of `docs` that have a term, whole texts, each row a document of its own (repeated
    rows and null ids too). Null and empty texts have no terms. It is written to the shared folder."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole().alias("text"))
    has = F.col("text").rlike(f"[^{NO_TERM}]")
    n = F.when(has, F.length(F.regexp_replace("text", AROUND, "x"))).otherwise(0).cast("long")  # a sign for each term
    lengths = stored(own.select(n.alias("n")).where("n > 0").groupBy("n").agg(F.count("*").alias("documents")), "search-lengths")
    total = lengths.agg(F.sum("documents"), F.sum(F.col("n") * F.col("documents"))).first()
    count, occurrences = int(total[0] or 0), int(total[1] or 0)
    m = F.expr(f"{100 - LENGTH}L + ({LENGTH}L * n * {count}L) div {max(occurrences, 1)}L")
    strata = checked(lengths.groupBy(m.alias("m")).agg(F.ceil(F.sum(F.col("n") * F.col("documents")) / BLOCK_TERMS).cast("int").alias("blocks")), "search-blocks")
    # A row's hash takes its place in its partition too, so that repeated rows are spread.
    placed = own.withColumn("n", n).where("n > 0").withColumns({"m": m, "place": F.monotonically_increasing_id()})
    dealt = placed.join(strata, "m").withColumn("block", F.pmod(F.xxhash64("doc_id", "place"), F.col("blocks")).cast("int"))
    postings = dealt.select("m", "block", "doc_id", "text").groupBy("m", "block").applyInArrow(invert, INDEX)
    return Index(stored(postings, "search-index"), count, occurrences)


def impact(tf, m):
    return SCALE * tf // (1000 * tf + 8 * m)


def visit(items: list[tuple[list[bytes], np.ndarray]], floors: list[int], k: int):
    """Scores the documents of a block for the items that visit it."""

    def run(table: pa.Table) -> pa.Table:
        m = table["m"][0].as_py()
        names = table["term"].to_pylist()
        head = names.index("")
        wanted = next(v for v in table["items"].to_pylist() if v is not None)
        column = lambda c: table[c].combine_chunks()
        doc_ids = column("doc_ids")[head].values
        flat = lambda c: column(c).flatten().to_numpy().astype(np.int64)
        parts = np.repeat(impact(flat("tfs"), m), flat("sizes"))  # an impact for each tf
        at = flat("places")
        ends = np.concatenate([[0], np.cumsum(table["df"].to_numpy())])
        rows = {name: i for i, name in enumerate(names)}
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for item in wanted:
            score = np.zeros(len(doc_ids), np.int64)
            for term, weight in zip(*items[item]):
                i = rows.get(term)
                if i is not None:
                    own = slice(ends[i], ends[i + 1])
                    score[at[own]] += weight * parts[own]
            good = np.flatnonzero((score > 0) & (score >= floors[item]))
            if len(good) > k:
                least = np.partition(score[good], len(good) - k)[len(good) - k]
                good = good[score[good] >= least]
                if len(good) > k:
                    key = np.array([np.iinfo(np.int64).min if x is None else x for x in doc_ids.take(pa.array(good)).to_pylist()])
                    good = good[np.lexsort((key, -score[good]))[:k]]
            out.append((np.full(len(good), item), good, score[good]))
        item, good, score = (np.concatenate(x) for x in zip(*out))
        return pa.table([pa.array(item), doc_ids.take(pa.array(good)), pa.array(score)], ["item", "doc_id", "score"])

    return run


def best(found: DataFrame, k: int) -> DataFrame:
    """The k best of each item: highest score, then smallest doc_id (null first). Spark cuts each task's rows
    down to k for an item before it moves them."""
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(index: Index, items: DataFrame, k: int = 10) -> DataFrame:
    """item_id, rank, doc_id, score: the k best documents for each item (item_id, text).

    Scores are integers; only those above 0 count; ties go to the smaller doc_id, and rows that share one stand
    each for themselves. An item without a term that the index knows has no row; repeated items give their rows
    once; a null item_id is an item. Items are taken ITEMS_AT_ONCE in turn, as one set of weights goes to all tasks.
    """
    own = items.select("item_id", whole().alias("text")).distinct()
    turns = max(1, -(-own.count() // ITEMS_AT_ONCE))
    results = [search_turn(index, own.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(turns)) == turn), k) for turn in range(turns)]
    out = results[0]
    for more in results[1:]:
        out = out.unionByName(more)
    return out


def search_turn(index: Index, items: DataFrame, k: int) -> DataFrame:
    spark = items.sparkSession
    rows = items.collect()  # ITEMS_AT_ONCE at most, about
    split = [terms(r["text"]) for r in rows]
    asked = spark.createDataFrame(pd.DataFrame({"term": sorted({t.decode() for own in split for t in own})}, dtype=object), "term string")
    known = index.postings.join(F.broadcast(asked), "term").select("m", "term", "top", "df")
    strata = stored(known.groupBy("term", "m").agg(F.sum("df").alias("df"), F.max("top").alias("top")), "search-strata")
    df = {r["term"]: r["df"] for r in strata.groupBy("term").agg(F.sum("df").alias("df")).collect()}
    weight = {t.encode(): int(np.floor(1000 * np.log((2 * index.documents + 2) / (2 * n + 1)))) for t, n in df.items()}
    weighed = []
    for own in split:
        times: dict[bytes, int] = {}
        for t in own:
            if t in weight:
                times[t] = times.get(t, 0) + 1
        weighed.append(([t.decode() for t in times], np.array([weight[t] * c for t, c in times.items()], np.int64)))
    uses = [(i, t, int(w)) for i, (names, ws) in enumerate(weighed) for t, w in zip(names, ws)]
    use = spark.createDataFrame(pd.DataFrame(uses, columns=["item", "term", "w"]).astype({"term": object}), "item long, term string, w long")
    part = F.expr(f"w * (({SCALE}L * top) div (1000L * top + 8L * m))")
    bounds = stored(strata.join(F.broadcast(use), "term").groupBy("item", "m").agg(F.sum(part).alias("bound")).where("bound > 0"), "search-bounds")
    order = Window.partitionBy("item").orderBy(F.desc("bound"), "m")
    first = bounds.withColumn("n", F.row_number().over(order)).where(F.col("n") <= FIRST).select("item", "m")
    found = stored(best(visited(index, asked, first, weighed, [0] * len(rows), k), k).select("item", "doc_id", "score"), "search-first")
    floor = found.groupBy("item").agg(F.count("*").alias("n"), F.min("score").alias("least"))
    floors = [0] * len(rows)
    for r in floor.collect():
        floors[r["item"]] = r["least"] if r["n"] >= k else 0
    least = spark.createDataFrame(pd.DataFrame({"item": range(len(rows)), "least": floors}), "item long, least long")
    later = bounds.join(first, ["item", "m"], "left_anti").join(F.broadcast(least), "item").where("bound >= least").select("item", "m")
    ranked = best(found.unionByName(visited(index, asked, later, weighed, floors, k)), k)
    names = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(rows)], "item long, item_id " + dict(items.dtypes)["item_id"])
    return ranked.join(F.broadcast(names), "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def visited(index: Index, asked: DataFrame, visits: DataFrame, weighed: list, floors: list[int], k: int) -> DataFrame:
    """item, doc_id, score: the best of each block of the strata in `visits` (item, m) for the items there."""
    by_stratum = visits.groupBy("m").agg(F.sort_array(F.collect_list("item")).alias("items"))  # ITEMS_AT_ONCE at most
    heads = index.postings.where("term = ''").join(by_stratum, "m").select("m", "block", "term", "df", "tfs", "sizes", "places", "doc_ids", "items")
    none = F.lit(None).cast("array<long>")
    strata = checked(visits.select("m").distinct(), "search-visits")
    bodies = index.postings.join(F.broadcast(asked), "term", "left_semi").join(strata, "m", "left_semi").select("m", "block", "term", "df", "tfs", "sizes", "places", none.alias("doc_ids"), none.alias("items"))
    return heads.unionByName(bodies).groupBy("m", "block").applyInArrow(visit(weighed, floors, k), FOUND)


def op11_search(spark, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return search(build_index(documents(spark, sf_dir)), items)


OP11_SQL = f"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{TERM}') AS words FROM documents WHERE text IS NOT NULL),
d AS (SELECT r, doc_id, words, CAST(len(words) AS BIGINT) AS n FROM t WHERE len(words) > 0),
a AS (SELECT count(*) AS nn, CAST(sum(n) AS BIGINT) AS ll FROM d),
p AS (SELECT r, doc_id, 25 + ((75 * n * nn) // ll) AS m, term, count(*) AS tf FROM (SELECT r, doc_id, n, unnest(words) AS term FROM d), a GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln((2 * nn + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM p, a GROUP BY term, nn),
q AS (SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{TERM}')) AS term FROM benchmark),
s AS (SELECT item_id, r, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score FROM q JOIN p USING (term) JOIN w USING (term) GROUP BY item_id, r, doc_id)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM s WHERE score > 0
QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 10
"""
