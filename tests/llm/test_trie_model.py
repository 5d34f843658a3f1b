"""op12 against the same smoothing over plain counts, sums of probabilities, and its gain over the base score."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from test_llm import WIDE, docs_of, odd_texts

from periodica.llm import trie_model as T


def tokens(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")), "\n"]


def held_out(i):
    return i is not None and zlib.crc32(str(i).encode()) % 5 == 1


def brute(texts):
    """(doc_id, held_out, n_tokens, n_known, N, base, score) with exact probabilities."""
    docs = [(i, tokens(t)) for i, t in texts]
    one, two, three, starts = Counter(), Counter(), Counter(), 0
    for i, own in docs:
        if not held_out(i):
            starts += 1
            one.update(own)
            long = ["<", "<", *own]
            two.update(zip(long[1:], own))
            three.update(zip(long, long[1:], own))
    n, v = sum(one.values()), len(one)
    context = Counter()
    for (a, b, _), times in three.items():
        context[a, b] += times
    counts = one | Counter({"<": starts})
    out = []
    for i, own in docs:
        base = score = 0.0
        long = ["<", "<", *own]
        for a, b, w in zip(long, long[1:], own):
            p1 = (one[w] + 0.5) / (n + 0.5 * (v + 1))
            p2 = (two[b, w] + T.K2 * p1) / (counts[b] + T.K2)
            p3 = (three[a, b, w] + T.K3 * p2) / (context[a, b] + T.K3)
            base, score = base + math.log10(p1), score + math.log10(p3)
        out.append((i, held_out(i), len(own), sum(one[w] > 0 for w in own), n, base, score))
    return sorted(out, key=lambda r: (str(r[0]), r[5], r[6]))


def scored(frame):
    return sorted(((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in frame.collect()), key=lambda r: (str(r[0]), r[5], r[6]))


def same(found, expected):
    assert len(found) == len(expected)
    for x, y in zip(found, expected):
        assert x[:5] == y[:5] and x[5] == pytest.approx(y[5], abs=1e-7 * y[2], rel=1e-9) and abs(x[6] - y[6]) <= 4e-4 * y[2], (x, y)


def corpus(n=300):
    rnd = random.Random(3)
    words = ["the", "The", "of", "a", "é", "日本", "x\xa0y", "it's", *(f"w{i}" for i in range(60))]
    pick = lambda k: " ".join(words[int(rnd.random() ** 3 * len(words))] for _ in range(k))
    texts = [(i, pick(rnd.choice([0, 1, 2, 9, 40]))) for i in range(n)]
    return texts + [(n + i, texts[i][1]) for i in range(80)] + [(n + 90 + i, f"new{i} " + pick(8) + f" also{i}") for i in range(40)] + [(3, texts[3][1]), (None, "no id"), (None, None)]


def test_scores_equal_plain_counts(spark, monkeypatch):
    texts = corpus()
    same(scored(T.score(docs_of(spark, texts))), brute(texts))
    monkeypatch.setattr(T, "BLOCK_BYTES", 1500)
    monkeypatch.setattr(T, "GRAM_SHARD", 300)
    monkeypatch.setattr(T, "WORD_SHARD", 40)
    same(scored(T.score(docs_of(spark, texts).repartition(3))), brute(texts))


@pytest.mark.parametrize("hot", [8, 60])
def test_frequent_words_are_split(spark, monkeypatch, hot):
    """Words above the limit are dealt by what stands before them, down to the block: all else stays, copies stay known."""
    texts = corpus()
    whole = scored(T.score(docs_of(spark, texts)))
    monkeypatch.setattr(T, "HOT", hot)
    monkeypatch.setattr(T, "BLOCK_BYTES", 3000)
    split = scored(T.score(docs_of(spark, texts)))
    assert [r[:6] for r in whole] == [pytest.approx(r[:6]) for r in split] and whole != split
    assert sum(r[6] for r in split) == pytest.approx(sum(r[6] for r in whole), rel=0.25)


@pytest.mark.parametrize("hot", [2, 8, 60])
def test_counts_are_whole_whatever_is_split(spark, monkeypatch, hot):
    texts = corpus()
    monkeypatch.setattr(T, "HOT", hot)
    monkeypatch.setattr(T, "BLOCK_BYTES", 1500)
    monkeypatch.setattr(T, "GRAM_SHARD", 300)
    same(scored(T.score(docs_of(spark, texts).repartition(3))), brute(texts))


def test_probabilities_sum_to_one():
    rng = np.random.default_rng(2)
    ids = T.FIRST_ID + np.arange(40)
    v, u, w = rng.integers(50, 53, 400), 2 + rng.integers(0, 5, 400), ids[(rng.random(400) ** 2 * 40).astype(int)]
    counts = np.bincount(w, minlength=42)[2:] + 1
    p1 = np.append(counts + 0.5, 0.5) / (counts.sum() + 0.5 * 41)  # the last is the unknown word
    trie = T.Trie(v, w, p1[w - 2], u)
    for before in (50, 51, 52, 77):
        for context in (2, 3, 99):
            p = 10 ** trie.log10(np.full(41, before), np.append(ids, T.UNKNOWN), p1, np.full(41, context))
            assert p.sum() == pytest.approx(1, abs=2e-3)


def test_elias_fano_round_trip_and_successors():
    rng = np.random.default_rng(1)
    for n, top in ((0, 1), (1, 5), (1000, 900), (1000, 10**12), (5000, 2**50)):
        values = np.sort(rng.integers(0, top, n))
        coded = T.EliasFano(values)
        assert (coded.values() == values).all()
        wanted = rng.integers(0, top, 200)
        at, equal = coded.search(wanted)
        assert (at == np.searchsorted(values, wanted)).all() and (equal == np.isin(wanted, values)).all()
    for values in (np.array([], int), np.array([0, 1, 255, 256, 2**40])):
        assert (T.unpack(T.pack(values)) == values).all()


def test_trie_is_compact():
    rng = np.random.default_rng(4)
    n = 200_000
    v, w, u = (2 + (rng.random(n) ** 3 * 20_000).astype(np.int64) for _ in range(3))
    trie = T.Trie(v << T.PART_BITS, w, np.full(n, 1e-4), u)
    assert trie.grams.n > 150_000 and len(trie.buffer) < 16 * n


def test_odd_rows_extra_columns_and_empty_tables(spark):
    texts = odd_texts()
    same(scored(T.score(docs_of(spark, texts))), brute(texts))
    same(scored(T.score(docs_of(spark, texts, WIDE))), brute(texts))
    assert T.score(docs_of(spark, [])).count() == 0
    only_held = [(i, "some words here") for i in range(40) if held_out(i)]
    assert {r[3:] for r in scored(T.score(docs_of(spark, only_held)))} == {(0, 0, 0.0, 0.0)}


def test_model_is_better_than_its_base_on_texts_held_out(spark):
    found = T.op12_trie_model(spark, "/root/testdata/sf0.01").where("held_out").selectExpr("sum(score) / sum(n_tokens) AS own", "sum(base_score) / sum(n_tokens) AS base").first()
    assert found["own"] > found["base"] + 0.1
