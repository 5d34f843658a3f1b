"""Document fingerprints: a Merkle tree over paragraphs and sections, with DataFrame functions only.

A paragraph is what stands between line feeds and is a leaf; its digest is a hash of its
text. A section is a run of paragraphs that ends after one whose digest ends in 0 (so an
insertion moves no other boundary); its digest hashes those of its paragraphs. The root is
the SHA-256 of the sections' digests. Leaves and sections have digests of 64 bits, so equal
roots mean equal texts up to a collision of these. Beside its digest a leaf carries short
hashes of its pieces. Pieces tile the paragraph and end where content says so:
after a word whose hash is 0 modulo PIECE_WORDS, and in words of over LONG_WORD characters
after two differing characters whose hash is 0 modulo PIECE_CHARACTERS; so what is inserted
or deleted changes the pieces that it touches. Texts of every length have them. In a text of
at most SHORT_TEXT characters, which has few, a leaf carries its runs of three characters too.

Likeness is found from the root down: equal roots are alike; else equal sections count with
all their pieces, below the sections that differ equal paragraphs do, and only below the
paragraphs that differ pieces are compared. Two texts that both have runs are compared by
runs in place of pieces; one that has runs and one that hasn't, by the pieces of both.

    fingerprint = root:section(paragraph=piece.piece~run.run,paragraph=piece);section(...)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import checked, documents, stored

PIECE_WORDS, PIECE_CHARACTERS = 2, 8  # on average
LONG_WORD, SHORT_TEXT = 16, 200  # characters
RANGES, STEP = 1024, 32  # ranges by percentile, and how many of them are looked through at once
RANGE_BYTES = 16 << 20  # that a part of a range aims at
ROW_BYTES = 64  # that a row counts beside its text
MOST_RANGES = 1_000_000  # parts, unless each had more than RANGE_BYTES: their first rows' keys are broadcast
LEAST = -(2**63)  # where a null doc_id stands in the order


def ended(part: Column, ends: Column) -> Column:
    """`part`, with a line feed (which no paragraph has) behind it where a piece ends."""
    return F.concat(part, F.when(ends, F.lit("\n")).otherwise(F.lit("")))


def in_characters(word: Column) -> Column:
    """A long word with the ends of its pieces. A run of one character has none."""
    characters, edge = F.split(word, "", -1), F.array(F.lit(""))
    ends = lambda b, c: (b != "") & (b != c) & (F.pmod(F.xxhash64(b, c), F.lit(PIECE_CHARACTERS)) == 0)
    return F.array_join(F.zip_with(F.concat(edge, characters), F.concat(characters, edge), lambda b, c: ended(c, ends(b, c))), "")


def in_pieces(paragraph: Column) -> Column:
    """The paragraph's pieces, in order; joined they are the paragraph."""
    words = F.regexp_extract_all(paragraph, F.lit("[^ ]+ *| +"), F.lit(0))
    cut = lambda w: F.when(F.char_length(w) > LONG_WORD, in_characters(w)).otherwise(ended(w, F.pmod(F.xxhash64(F.rtrim(w)), F.lit(PIECE_WORDS)) == 0))
    return F.filter(F.split(F.array_join(F.transform(words, cut), ""), "\n", -1), lambda p: p != "")


def pieces(paragraph: Column) -> Column:
    """Short hashes of the paragraph's pieces, in order."""
    return F.transform(in_pieces(paragraph), lambda p: F.lower(F.hex(F.shiftrightunsigned(F.xxhash64(p), 36))))


def runs(paragraph: Column) -> Column:
    """Short hashes of a paragraph's runs of three characters (of a shorter one, of itself)."""
    found = F.regexp_extract_all(paragraph, F.lit("(?s)(?=(.{3}))"), F.lit(1))
    whole = F.when(paragraph == "", F.array().cast("array<string>")).otherwise(F.array(paragraph))
    return F.transform(F.when(F.char_length(paragraph) < 3, whole).otherwise(found), lambda r: F.lower(F.hex(F.shiftrightunsigned(F.xxhash64(r), 40))))


def is_short(text: Column) -> Column:
    return F.char_length(text) <= SHORT_TEXT


def tree(text: Column) -> Column:
    """The fingerprint of a text; of a null one, that of the empty text."""
    body = F.coalesce(text, F.lit(""))
    more = lambda p: F.when(is_short(body), F.concat(F.lit("~"), F.array_join(runs(p), "."))).otherwise(F.lit(""))
    leaves = F.transform(F.split(body, "\n", -1), lambda p: F.concat(F.lower(F.hex(F.xxhash64(p))), F.lit("="), F.array_join(pieces(p), "."), more(p)))
    sections = F.split(F.regexp_replace(F.array_join(leaves, ","), "(0=[^,]*),", "$1;"), ";", -1)

    def digested(found: Column) -> Column:
        own = F.transform(found, lambda s: F.lower(F.hex(F.xxhash64(F.regexp_replace(s, "=[^,]*", "")))))
        return F.struct(found.alias("sections"), own.alias("digests"))

    def written(found: Column) -> Column:
        branches = F.zip_with(found["digests"], found["sections"], lambda d, s: F.concat(d, F.lit("("), s, F.lit(")")))
        return F.concat(F.sha2(F.array_join(found["digests"], ";"), 256), F.lit(":"), F.array_join(branches, ";"))

    return once(once(sections, digested), written)


def by(fingerprint: Column, runs: Column) -> Column:
    """The fingerprint with runs in place of pieces, or without runs."""
    return F.when(runs, F.regexp_replace(fingerprint, "=[^~]*~", "=")).otherwise(F.regexp_replace(fingerprint, "~[^,)]*", ""))


def root(fingerprint: Column) -> Column:
    return F.substring_index(fingerprint, ":", 1)


def sections_of(fingerprint: Column) -> Column:
    """The distinct sections, each as digest(paragraphs)."""
    return F.array_distinct(F.split(F.substring_index(fingerprint, ":", -1), ";", -1))


def paragraphs_of(sections: Column) -> Column:
    """The distinct paragraphs of sections, each as digest=pieces."""
    inner = F.transform(sections, lambda s: F.split(F.substring_index(F.substring_index(s, "(", -1), ")", 1), ",", -1))
    return F.array_distinct(F.flatten(inner))


def pieces_of(paragraphs: Column) -> Column:
    """The distinct pieces of paragraphs."""
    inner = F.transform(paragraphs, lambda p: F.split(F.substring_index(p, "=", -1), "\\.", -1))
    return F.filter(F.array_distinct(F.flatten(inner)), lambda x: x != "")


def weight(branches: Column) -> Column:
    """How many pieces stand in sections or paragraphs; an empty paragraph counts as one."""
    text = F.array_join(branches, ",")
    return F.length(text) - F.length(F.translate(text, "=.", ""))


def compared(a: Column, b: Column) -> Column:
    """struct of likeness and changed_paragraphs (distinct ones of `a` that `b` hasn't) of two fingerprints. A
    branch is looked into only where `a` and `b` differ in it."""
    sections = lambda x: F.struct(sections_of(x).alias("all"))
    runs = F.contains(a, F.lit("~")) & F.contains(b, F.lit("~"))
    start = F.struct(sections(by(a, runs)).alias("a"), sections(by(b, runs)).alias("b"))

    def below(s: Column) -> Column:
        one, two = s["a"]["all"], s["b"]["all"]
        return F.struct(
            weight(F.array_intersect(one, two)).alias("same"),
            paragraphs_of(F.array_except(one, two)).alias("a"), paragraphs_of(F.array_except(two, one)).alias("b"),
        )

    def leaves(s: Column) -> Column:
        gone, new = F.array_except(s["a"], s["b"]), F.array_except(s["b"], s["a"])
        return F.struct(
            (s["same"] + weight(F.array_intersect(s["a"], s["b"]))).alias("same"), F.size(gone).alias("changed"),
            pieces_of(gone).alias("a"), pieces_of(new).alias("b"),
        )

    def shares(s: Column) -> Column:
        whole = 2 * s["same"] + F.size(s["a"]) + F.size(s["b"])
        alike = 2.0 * (s["same"] + F.size(F.array_intersect(s["a"], s["b"])))
        return F.struct(F.when(whole == 0, F.lit(0.0)).otherwise(alike / whole).alias("likeness"), s["changed"].alias("changed_paragraphs"))

    found = once(once(once(start, below), leaves), shares)
    return F.when(root(a) == root(b), F.struct(F.lit(1.0).alias("likeness"), F.lit(0).alias("changed_paragraphs"))).otherwise(found)


def once(value: Column, use) -> Column:
    """use(value), with `value` worked out once."""
    return F.transform(F.array(value), use)[0]


def with_next(docs: DataFrame) -> tuple[DataFrame, Window]:
    """doc_id, text and next_text, and the order used. next_text is that of the document next in descending doc_id (then
    ascending hash of the text, then text), the first one's after the last.

    Rows are dealt into ranges that follow each other in that order, as many as the bytes of all texts ask for:
    first by percentiles of the doc_id, then inside such a range evenly by doc_id, and rows of a doc_id at
    which a percentile stands more than once (or that has no other beside it) evenly by their hash. Each range
    is sorted for itself; into each comes, as a guest that sorts last, the first row of the next one. So one
    shuffle carries the texts, and no task sees more than a range.
    """
    own = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LEAST)).alias("place"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).withColumn("hash", F.xxhash64("text"))
    shares = [i / RANGES for i in range(RANGES + 1)]
    found = own.agg(F.percentile_approx("place", shares, 10_000).alias("cuts")).first()["cuts"] or [0]
    ranged = own.withColumn("range", range_of(F.col("place"), sorted(set(found))))
    sizes = ranged.groupBy("range").agg(F.sum(F.octet_length("text") + ROW_BYTES).alias("bytes"), F.min("place").alias("low"), F.max("place").alias("high"))
    sizes = sorted(tuple(r) for r in sizes.collect())  # at most RANGES + 1 rows
    target = max(RANGE_BYTES, sum(r[1] for r in sizes) // MOST_RANGES)
    parts = {r: (-(-size // target), low, high) for r, size, low, high in sizes}
    spread = [constant([parts.get(r, (1, 0, 0))[k] for r in range(len(set(found)) + 1)]) for k in range(3)]
    part = part_of(*[F.get(x, F.col("range")) for x in spread])
    dealt = ranged.withColumn("part", part)
    heads = dealt.groupBy("range", "part").agg(F.max(first_key()).alias("head"))
    hosts = guests_of(stored(heads, "merkle-heads"))
    guests = own.join(checked(hosts, "merkle-hosts"), (F.col("place") == F.col("head.place")) & (F.col("hash") == -F.col("head.turned") - 1)).select(
        "doc_id", "place", "text", "hash", "range", "part", F.lit(True).alias("guest")
    )
    order = Window.partitionBy("range", "part").orderBy("guest", F.desc("place"), "hash", "text")
    return dealt.withColumn("guest", F.lit(False)).unionByName(guests).withColumn("next_text", F.lead("text").over(order)), order


def constant(numbers: list[int]) -> Column:
    """An array that is worked out once, when the plan is made."""
    return (F.split(F.lit(",".join(map(str, numbers))), ",") if numbers else F.array()).cast("array<long>")


def range_of(place: Column, cuts: list[int]) -> Column:
    """How many cuts are below `place`: first by every STEP-th cut, then by those between."""
    coarse, fine = constant(cuts[STEP - 1 :: STEP]), constant(cuts)
    whole = F.size(F.filter(coarse, lambda c: c < place)) * STEP
    return (whole + F.size(F.filter(F.slice(fine, whole + 1, F.lit(STEP)), lambda c: c < place))).cast("int")


def part_of(parts: Column, low: Column, high: Column) -> Column:
    """The part of a row in its range, in the order of rows: those of the highest doc_id, which a percentile may have
    met often, by their hash into as many parts as the range has, the others behind them evenly by doc_id."""
    unit = lambda x, least, most: (x - least) / F.greatest(most - least, F.lit(1.0))
    hashed = F.floor(unit(F.col("hash").cast("double"), F.lit(-(2.0**63)), F.lit(2.0**63)) * parts)
    even = parts + F.floor((1 - unit(F.col("place").cast("double"), low.cast("double"), high.cast("double"))) * parts)
    return F.when(F.col("place") == high, F.least(hashed, parts - 1)).otherwise(F.least(even, 2 * parts - 1)).cast("int")


def first_key() -> Column:
    """Largest for the first row of a part; -hash - 1 is the hash in falling order."""
    return F.struct("place", (-F.col("hash") - 1).alias("turned"))


def guests_of(heads: DataFrame) -> DataFrame:
    """range, part, head of the part that follows it in the order of rows, the first one's for the last. Parts follow
    each other inside a range; only a row for each range is ordered as a whole."""
    inside, down = Window.partitionBy("range").orderBy("part"), Window.orderBy(F.desc("range"))
    marked = heads.withColumn("following", F.lead("head").over(inside))
    firsts = heads.groupBy("range").agg(F.min_by("head", "part").alias("first"))
    every = down.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    over = firsts.select("range", F.coalesce(F.lead("first").over(down), F.first("first").over(every)).alias("over"))
    return marked.join(over, "range").select("range", "part", F.coalesce("following", "over").alias("head"))


def edited(text: Column, following: Column) -> Column:
    """The last half (rounded down) of the code points gives way to as many of the next text's first."""
    half = F.floor(F.char_length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.char_length(text) - half), F.substring(following, F.lit(1), half))


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, changed_paragraphs
    (distinct paragraphs of the text that the edited one hasn't) for each row.

    A null text counts as empty. A null doc_id comes last in the order; rows of the same
    doc_id follow each other by a hash of the text, so repeated rows have each other as next.
    A single row is its own next. An empty table gives an empty result; other columns are ignored.
    """
    paired, order = with_next(docs)
    marked = paired.select(
        "doc_id", "place", "hash", "text", "next_text", "guest", "range", "part", F.char_length("text").cast("long").alias("n_chars"),
        tree(F.col("text")).alias("fingerprint"),
    )
    following = marked.withColumn("next_fingerprint", F.lead("fingerprint").over(order)).where("NOT guest")
    both = following.select(
        "doc_id", "n_chars", "fingerprint", "next_fingerprint", edited(F.col("text"), F.col("next_text")).alias("edited"),
    ).select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint", tree(F.col("edited")).alias("edited_fingerprint"), "next_fingerprint")
    to_edited, to_next = compared(F.col("fingerprint"), F.col("edited_fingerprint")), compared(F.col("fingerprint"), F.col("next_fingerprint"))
    found = both.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", to_edited.alias("e"), to_next.alias("n"))
    return found.select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", F.col("e.likeness").alias("near_edited"),
        F.col("n.likeness").alias("near_next"), F.col("e.changed_paragraphs").cast("long").alias("changed_paragraphs"),
    )


def op10_fingerprints(spark, sf_dir: str) -> DataFrame:
    return fingerprints(documents(spark, sf_dir))
