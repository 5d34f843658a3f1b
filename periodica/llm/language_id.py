"""Language ID by hyperdimensional profiles.

Every letter has a random vector of +-1 drawn from its code point. An n-gram's vector binds
(multiplies) its letters' vectors, each rotated by its place; a text's profile bundles
(adds) its n-grams' vectors, and a language's prototype bundles those of its training texts.
The language whose prototype has the largest cosine with the text's profile is predicted.

Bundling is linear, so training counts n-grams in each task, bundles once at its end and
sends one vector for each language; the sums are as large as the vectors, however many
documents there are. What all languages share (the mean of the unit prototypes) is taken
off the prototypes, which leaves what tells them apart.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .common import documents, slices

DIMENSIONS = 1024
GRAM = 3
SEED = 9
KNOWN_GRAMS = 32_768  # n-gram vectors a task keeps (of DIMENSIONS bytes each)
KNOWN_LETTERS = 4096  # of GRAM vectors each
PIECE_CHARS = 1_000_000  # of a text whose n-grams are counted at once
UNKNOWN = "und"
GAP = 1  # stands between words

NOT_LETTERS = regex.compile(r"\P{L}+")  # numerals of any kind are no letters


def letter_vector(code: int) -> np.ndarray:
    bits = np.random.default_rng([SEED, code]).integers(0, 2, DIMENSIONS, dtype=np.int8)
    return 2 * bits - 1


def clean(text: str | None) -> str:
    """Lower-cased letters; anything else is a gap, also at both ends."""
    return " " + NOT_LETTERS.sub(" ", (text or "").lower()).strip() + " "


def grams(text: str) -> np.ndarray:
    """An integer for each n-gram of a cleaned text: 21 bits a letter."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    if len(codes) < GRAM:
        return np.zeros(0, np.int64)
    out = codes[: len(codes) - GRAM + 1].copy()
    for i in range(1, GRAM):
        out = (out << 21) | codes[i : len(codes) - GRAM + 1 + i]
    return out


class Grams:
    """Rows of n-gram vectors, made when first met (memory is taken when a row is written). Emptied when full."""

    def __init__(self):
        self.letters: dict[int, list[np.ndarray]] = {}
        self.matrix = np.zeros((KNOWN_GRAMS, DIMENSIONS), np.int8)
        self.row_of: dict[int, int] = {}

    def clear(self) -> None:
        self.row_of.clear()
        if len(self.letters) > KNOWN_LETTERS:
            self.letters.clear()

    def letter(self, code: int, place: int) -> np.ndarray:
        if code not in self.letters:
            vector = letter_vector(code)
            self.letters[code] = [np.roll(vector, GRAM - 1 - i) for i in range(GRAM)]
        return self.letters[code][place]

    def rows(self, found: np.ndarray) -> np.ndarray:
        """Row numbers of distinct n-grams, at most KNOWN_GRAMS of them."""
        keys = found.tolist()
        new = [k for k in keys if k not in self.row_of]
        if new and len(self.row_of) + len(new) > KNOWN_GRAMS:
            self.clear()
            new = keys
        for k in new:
            at = len(self.row_of)
            vector = self.letter(k & 0x1FFFFF, GRAM - 1)
            for i in range(1, GRAM):
                vector = vector * self.letter(k >> (21 * i) & 0x1FFFFF, GRAM - 1 - i)
            self.matrix[at] = vector
            self.row_of[k] = at
        return np.fromiter(map(self.row_of.__getitem__, keys), np.int64, len(keys))

    def bundle(self, found: np.ndarray, counts: np.ndarray) -> np.ndarray:
        total = np.zeros(DIMENSIONS, np.float32)
        for a in range(0, len(found), 1024):
            rows = self.rows(found[a : a + 1024])
            total += counts[a : a + 1024].astype(np.float32) @ self.matrix[rows].astype(np.float32)
        return total


def pieces(text: str) -> Iterator[str]:
    """A very long text in pieces that overlap by what an n-gram needs."""
    for a in range(0, max(1, len(text) - GRAM + 1), PIECE_CHARS):
        yield text[a : a + PIECE_CHARS + GRAM - 1]


def counted(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of a whole text and how often each occurs."""
    parts = [np.unique(grams(p), return_counts=True) for p in pieces(text)]
    if len(parts) == 1:
        return parts[0]
    found, inverse = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    return found, np.bincount(inverse, np.concatenate([p[1] for p in parts])).astype(np.int64)


def inside_texts(found: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Without the n-grams of texts side by side that reach from one into the next: only they have two gaps together."""
    gaps = [(found >> (21 * i) & 0x1FFFFF) == ord(" ") for i in range(GRAM)]
    own = ~np.any([a & b for a, b in zip(gaps, gaps[1:])], axis=0)
    return found[own], number[own]


def held_out() -> Column:
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 3 == 1


def prototypes(docs: DataFrame) -> dict[str, np.ndarray]:
    """A vector for each value of lang, from the texts with a lang that aren't held out."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, counts = Grams(), {}
        sums: dict[str, np.ndarray] = {}

        def flush() -> None:
            for lang, own in counts.items():
                keys = np.fromiter(own, np.int64, len(own))
                vector = known.bundle(keys, np.fromiter(own.values(), np.int64, len(own)))
                sums[lang] = sums.get(lang, 0) + vector.astype(np.float64)
            counts.clear()

        for batch in batches:
            for lang, own in batch.groupby("lang", sort=False):
                for part in np.array_split(own["text"].to_numpy(), 1 + len(own) // 200):
                    found, number = inside_texts(*counted("".join(map(clean, part))))
                    so_far = counts.setdefault(lang, {})
                    for k, n in zip(found.tolist(), number.tolist()):
                        so_far[k] = so_far.get(k, 0) + n
                if sum(map(len, counts.values())) > KNOWN_GRAMS:
                    flush()
        flush()
        for lang, vector in sums.items():
            yield pd.DataFrame({"lang": lang, "place": np.arange(DIMENSIONS), "value": vector})

    taught = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out()).select("lang", "text")
    summed = taught.mapInPandas(run, "lang string, place int, value double").groupBy("lang", "place").agg(F.sum("value").alias("value"))
    out: dict[str, np.ndarray] = {}
    for row in summed.collect():  # DIMENSIONS numbers for each language
        out.setdefault(row["lang"], np.zeros(DIMENSIONS))[row["place"]] = row["value"]
    return out


def sharpened(learned: dict[str, np.ndarray]) -> tuple[list[str], np.ndarray]:
    names = sorted(learned)
    unit = np.array([learned[n] / (np.linalg.norm(learned[n]) or 1.0) for n in names]).reshape(len(names), DIMENSIONS)
    if len(names) > 1:
        unit = unit - unit.mean(axis=0)
        unit /= np.maximum(np.linalg.norm(unit, axis=1, keepdims=True), 1e-12)
    return names, unit.astype(np.float32)


def judge(texts: list[str | None], names: list[str], vectors: np.ndarray, known: Grams) -> tuple[list[str], list[float]]:
    """Language and score of each text."""
    langs, scores = [], []
    for text in texts:
        plain = clean(text)
        if not names or not plain.strip():
            langs.append(UNKNOWN)
            scores.append(0.0)
            continue
        profile = known.bundle(*counted(plain))
        cosines = vectors @ profile / max(float(np.linalg.norm(profile)), 1e-12)
        best = int(np.argmax(cosines))
        langs.append(names[best])
        scores.append(min(1.0, max(0.0, float(cosines[best]))))
    return langs, scores


def identify(docs: DataFrame, learned: dict[str, np.ndarray] | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred, score for each row of `docs`.

    Learns from `docs` itself unless prototypes are given. A text that is null, empty or
    without letters gets `und` and score 0, and so does any text if there is nothing to
    learn from; of equal cosines the first language by name wins. The score is the cosine,
    0 where that is negative. Very long texts are read whole. Repeated rows are judged (and
    learnt) one by one, a null doc_id counts as an empty one for the fold; other columns
    are ignored.
    """
    names, vectors = sharpened(prototypes(docs) if learned is None else learned)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Grams()
        for batch in batches:
            langs, scores = [], []
            for _, texts in slices(batch.column(2)):
                more = judge(texts, names, vectors, known)
                langs += more[0]
                scores += more[1]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                ["doc_id", "held_out", "lang_pred", "score"],
            )

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), F.col("text").cast("string").alias("text"))
    return own.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def keep_identified(docs: DataFrame, learned: dict[str, np.ndarray] | None = None) -> DataFrame:
    """The rows of `docs` that have a language: those with `und` go. Each row is judged where it stands, so
    nothing is joined and no column name can clash."""
    names, vectors = sharpened(prototypes(docs) if learned is None else learned)

    @F.arrow_udf(StringType())
    def language(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = Grams()
        for batch in batches:
            langs = [lang for _, texts in slices(batch) for lang in judge(texts, names, vectors, known)[0]]
            yield pa.array(langs, pa.string())

    return docs.where(language(F.col("text").cast("string")) != UNKNOWN)


def op9_language_id(spark, sf_dir: str) -> DataFrame:
    return identify(documents(spark, sf_dir))
