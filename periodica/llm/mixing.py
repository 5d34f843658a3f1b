"""Mixing sources to target weights by Poisson replication, with DataFrame functions only.

A source with n rows and target share w gets the mean repetition rate N * w / n, N being
the rows wanted in all. Each document draws its number of copies by inverting the Poisson
distribution of its source's rate at a uniform number hashed from its doc_id and text, so a
second run, or a task that is run again, draws the same. The copies are then dealt out by a
hash of document, copy and seed and sorted by it inside each partition: a uniform shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import documents, stored

TEMPERATURE = 0.5  # a source's share is its row count to this power
BROADCAST_NUMBERS = 2_000_000  # distributions of more numbers than this are joined by shuffle
SALT = 32


def uniform(seed: int, *parts: Column) -> Column:
    """A number in [0, 1) from 52 bits of a hash; the same in any engine that has MD5."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long") / F.lit(float(2**52))


def distributions(rates: DataFrame) -> DataFrame:
    """source_key, low, cdf for each source_key and rate: the Poisson distribution function at low, low + 1, ...

    Weights grow and shrink from term to term by rate / k and are scaled to 1. They are taken where the
    distribution is: 12 standard deviations and 30 more to both sides of the rate, beyond which less than
    10^-30 is left. So a source needs a number of terms that grows with the root of its rate.
    """
    reach = 12 * F.sqrt("rate") + 30
    low = F.greatest(F.lit(0), F.floor(F.col("rate") - reach)).cast("long")
    spread = rates.select("source_key", "rate", low.alias("low"), F.ceil(F.col("rate") + reach).cast("long").alias("high"))
    terms = spread.select("source_key", "rate", "low", F.explode(F.sequence("low", "high")).alias("k"))
    whole, rising = Window.partitionBy("source_key"), Window.partitionBy("source_key").orderBy("k")
    step = F.when(F.col("k") == F.col("low"), 0.0).otherwise(F.ln("rate") - F.ln(F.col("k").cast("double")))
    logs = terms.withColumn("log", F.sum(step).over(rising))
    weights = logs.withColumn("p", F.exp(F.col("log") - F.max("log").over(whole)))
    shares = weights.withColumn("f", F.sum("p").over(rising) / F.sum("p").over(whole))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("k", "f"))), lambda x: x["f"])
    return shares.groupBy("source_key").agg(F.min("k").alias("low"), ordered.alias("cdf"))


def rates(docs: DataFrame, weights: dict[str, float] | None = None, total: int | None = None) -> DataFrame:
    """source_key, rate: each source's mean repetition rate.

    weights: target share by source, scaled to 1; a source that is not named gets none.
    Without weights the share is the row count to the power TEMPERATURE. total: rows
    wanted, as many as there are if not given.
    """
    counts = stored(docs.groupBy(source_key().alias("source_key")).agg(F.count("*").alias("rows")), "mix-counts")
    if weights is None:
        weighed = counts.withColumn("weight", F.pow(F.col("rows").cast("double"), F.lit(TEMPERATURE)))
    else:
        pairs = [x for k, v in weights.items() for x in (F.lit("s" + k), F.lit(float(v)))]
        given = F.create_map(*pairs) if pairs else F.create_map().cast("map<string,double>")
        weighed = counts.withColumn("weight", F.coalesce(F.try_element_at(given, F.col("source_key")), F.lit(0.0)))
    sums = weighed.agg(F.sum("weight").alias("weights"), F.sum("rows").alias("rows")).first()
    wanted = F.lit(float((sums["rows"] or 0) if total is None else total))
    rate = wanted * (F.col("weight") / F.lit(sums["weights"])) / F.col("rows")
    return weighed.where("weight > 0").select("source_key", rate.cast("double").alias("rate"))


def source_key(name: str = "source") -> Column:
    """A null source is a source of its own."""
    return F.when(F.col(name).isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), F.col(name)))


def mix(docs: DataFrame, weights: dict[str, float] | None = None, total: int | None = None, seed: int = 5) -> DataFrame:
    """The columns of `docs`, replicated: struct `row`, int `copies`, int `copy` (from 1), string `shuffle_key`.

    Documents that draw 0 are left out: that is what a rate below 1 means. Rows that share a
    doc_id draw each for itself by their texts, and only rows that share both draw the same
    number. A null doc_id or text is hashed as the word null, a null text or source is kept
    as it is, an empty table gives an empty one. The row travels as one struct, so no column
    name can clash.
    """
    table = stored(distributions(rates(docs, weights, total)), "mix-rates")
    packed = docs.select(F.struct("*").alias("row"), source_key().alias("source_key"), F.md5("text").alias("text_md5"), F.monotonically_increasing_id().alias("place"))
    if (table.agg(F.sum(F.size("cdf") + 4).alias("n")).first()["n"] or 0) <= BROADCAST_NUMBERS:
        joined = packed.join(F.broadcast(table), "source_key")
    else:  # a hot source is spread over SALT partitions
        salted = table.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
        joined = packed.withColumn("salt", F.pmod(F.xxhash64("row.doc_id", "text_md5"), F.lit(SALT)).cast("int")).join(
            salted.hint("shuffle_merge"), ["source_key", "salt"]
        )
    drawn = uniform(seed, F.col("row.doc_id"), F.col("text_md5"))
    copies = F.col("low") + F.size(F.filter("cdf", lambda c: c <= F.col("u")))
    counted = joined.withColumn("u", drawn).select("row", "text_md5", "place", copies.cast("int").alias("copies"))
    exploded = counted.where("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    own = [F.coalesce(c.cast("string"), F.lit("null")) for c in (F.col("row.doc_id"), F.col("text_md5"))]
    key = F.md5(F.concat_ws("|", F.lit(f"{seed}.mix"), *own, F.col("copy").cast("string")))
    shuffled = exploded.select("row", "copies", "copy", key.alias("shuffle_key"), "place")
    # Rows that are equal have equal keys: by their place in the table they go to different tasks all the same.
    return shuffled.repartition("shuffle_key", "place").sortWithinPartitions("shuffle_key").drop("place")


def op5_mixing(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang", "source")
    return mix(docs).select("row.*", "copies", "copy", "shuffle_key")


OP5_SQL = """
WITH n AS (SELECT source, count(*) AS c FROM documents GROUP BY source),
r AS (SELECT source, (sum(c) OVER ()) * (sqrt(c) / (sum(sqrt(c)) OVER ())) / c AS rate FROM n),
s AS (SELECT source, rate, greatest(0, CAST(floor(rate - 12 * sqrt(rate) - 30) AS BIGINT)) AS low, CAST(ceil(rate + 12 * sqrt(rate) + 30) AS BIGINT) AS high FROM r),
k AS (SELECT source, rate, low, unnest(range(low, high + 1)) AS k FROM s),
l AS (SELECT source, low, k, sum(CASE WHEN k = low THEN 0 ELSE ln(rate) - ln(k) END) OVER (PARTITION BY source ORDER BY k) AS l FROM k),
p AS (SELECT source, low, k, exp(l - max(l) OVER (PARTITION BY source)) AS p FROM l),
f AS (SELECT source, low, k, sum(p) OVER (PARTITION BY source ORDER BY k) / sum(p) OVER (PARTITION BY source) AS f FROM p),
cdf AS (SELECT source, low, list(f ORDER BY k) AS cdf FROM f GROUP BY source, low),
d AS (SELECT doc_id, text, lang, d.source, coalesce(CAST(doc_id AS VARCHAR), 'null') || '|' || coalesce(md5(text), 'null') AS own,
        low + len(list_filter(cdf, lambda x: x <= CAST('0x' || substr(md5('5|' || own), 1, 13) AS BIGINT) / 4503599627370496.0)) AS copies
      FROM documents d JOIN cdf ON d.source IS NOT DISTINCT FROM cdf.source),
e AS (SELECT *, unnest(range(1, copies + 1)) AS copy FROM d)
SELECT doc_id, text, lang, source, CAST(copies AS INTEGER) AS copies, CAST(copy AS INTEGER) AS copy,
  md5('5.mix|' || own || '|' || copy) AS shuffle_key
FROM e
"""
