"""op11 against brute force over all documents, and with strata of one block, of many, and of one row each."""

import math
import random
import re
from collections import Counter

import pytest
from conftest import oracle_rows, rows_of
from test_llm import WIDE, docs_of, odd_texts

from periodica.llm import ranked

ITEMS = "item_id long, text string, doc_id int, m string"


def words(text):
    return re.findall(ranked.TERM, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(texts, items, k=10):
    docs = [(i, Counter(w)) for i, t in texts if (w := words(t))]
    n, occurrences = len(docs), sum(sum(c.values()) for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    out = []
    for item, text in dict.fromkeys(items):
        scored = []
        for i, c in docs:
            m = 25 + 75 * sum(c.values()) * n // occurrences
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in words(text) if c[t])
            if score:
                scored.append((-score, i is not None, i or 0, i))
        out += [(item, rank + 1, i, -s) for rank, (s, _, _, i) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


def found(spark, texts, items, schema=None):
    frame = spark.createDataFrame([(i, t, 1, "x") for i, t in items], ITEMS)
    docs = docs_of(spark, texts, schema) if schema else docs_of(spark, texts)
    return sorted([(r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in ranked.search(ranked.build_index(docs), frame).collect()], key=str)


def corpus(n=400):
    rnd = random.Random(8)
    vocabulary = [f"w{i}" for i in range(80)] + ["É", "日本語", "x1", "ab"]
    pick = lambda k: " ".join(vocabulary[int(rnd.random() ** 2 * len(vocabulary))] for _ in range(k))
    texts = [(i, pick(rnd.choice([1, 2, 5, 20, 20, 20, 300]))) for i in range(n)] + [(1000 + i, "W1 w2, w1-w3") for i in range(150)]
    items = [(i, pick(rnd.choice([1, 3, 30]))) for i in range(25)] + [(90, "w1 w1 W1 w2"), (91, None), (92, "..."), (93, "unknown"), (94, "日本語 É"), (90, "w1 w1 W1 w2"), (None, "w5")]
    return texts, items


@pytest.mark.parametrize("block, first, turn", [(10**6, 8, 2000), (50, 1, 2000), (50, 2, 7)])
def test_search_equals_brute_force(spark, monkeypatch, block, first, turn):
    monkeypatch.setattr(ranked, "BLOCK_TERMS", block)
    monkeypatch.setattr(ranked, "FIRST", first)
    monkeypatch.setattr(ranked, "ITEMS_AT_ONCE", turn)
    texts, items = corpus()
    assert found(spark, texts, items) == brute(texts, items)


def test_odd_rows_ties_extra_columns_and_empty_tables(spark):
    texts = [*odd_texts(), (9, "tie text"), (8, "tie text"), (8, "tie text")]
    items = [(1, "tie text"), (2, "the haus le0 le1"), (3, "same text"), (4, "xxxx " + "x" * 30_000)]
    assert found(spark, texts, items, WIDE) == found(spark, texts, items) == brute(texts, items)
    assert found(spark, [], items) == [] and found(spark, texts, []) == [] and found(spark, [(1, None)], items) == []


def test_strata_hold_equal_lengths_and_every_posting(spark):
    texts, _ = corpus()
    index = ranked.build_index(docs_of(spark, texts))
    rows = index.postings.collect()
    heads = {(r["m"], r["block"]): r["doc_ids"] for r in rows if r["term"] == ""}
    lengths = {i: len(words(t)) for i, t in texts}
    for (m, _), ids in heads.items():
        assert {25 + 75 * lengths[i] * index.documents // index.terms for i in ids} == {m}
    got = {(r["term"], heads[r["m"], r["block"]][p], tf) for r in rows if r["term"] for tf, p in zip([t for t, n in zip(r["tfs"], r["sizes"]) for _ in range(n)], r["places"])}
    assert got == {(t, i, c) for i, text in texts for t, c in Counter(words(text)).items()}


def test_query_equals_sql(spark, sf_dir, duck):
    columns, expected = oracle_rows(duck, ranked.OP11_SQL)
    frame = ranked.op11_search(spark, sf_dir)
    assert sorted(frame.columns) == columns and rows_of(frame) == expected and len(expected) > 100
