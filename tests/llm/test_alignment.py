"""op13 against a brute-force alignment token by token."""

import hashlib
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F
from test_llm import WIDE, docs_of, odd_texts

from periodica.llm import alignment


def tokenizers():
    import sentencepiece
    from tokenizers import Tokenizer

    spec, model = alignment.files()
    a = Tokenizer.from_file(spec)
    a.encode_special_tokens = True
    a.no_truncation()
    a.no_padding()
    return a, sentencepiece.SentencePieceProcessor(model_file=model)


def brute(texts):
    """By place of the text: n_a, n_b, n_groups, n_links, n_best, count_sum, groups."""
    from periodica.llm.bpe import byte_letters

    a, b = tokenizers()
    letters = {x: i for i, x in enumerate(byte_letters())}
    linked, groups, counts = [], [], []
    for text in texts:
        links, cut = [], []
        if text:
            left, right = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
            sizes = [[bytes(map(letters.__getitem__, a.id_to_token(i))) for i in left]]
            sizes += [[bytes([int(p[3:-1], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(right, b.id_to_piece(right))]]
            if b"".join(sizes[0]) == b"".join(sizes[1]) == (" " + text).encode():
                spans = []
                for ids, own in zip((left, right), sizes):
                    at, out = 0, []
                    for i, piece in zip(ids, own):
                        out.append((at, at + len(piece), i))
                        at += len(piece)
                    spans.append(out)
                both = sorted({e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]})
                at = [0, 0]
                for end in both:
                    own = [[], []]
                    for k, side in enumerate(spans):
                        while at[k] < len(side) and side[at[k]][1] <= end:
                            own[k].append(side[at[k]][2])
                            at[k] += 1
                    cut.append("|".join(",".join(map(str, x)) for x in own))
                j = 0
                for s, e, x in spans[0]:
                    while spans[1][j][1] <= s:
                        j += 1
                    k = j
                    while k < len(spans[1]) and spans[1][k][0] < e:
                        links.append((x, spans[1][k][2]))
                        k += 1
                counts.append((len(left), len(right)))
            else:
                counts.append((0, 0))
        else:
            counts.append((0, 0))
        linked.append(links)
        groups.append(cut)
    held = Counter(p for links in linked for p in set(links))
    top = defaultdict(int)
    for (x, _), n in held.items():
        top[x] = max(top[x], n)
    return [
        (*counts[i], len(groups[i]), len(links), sum(held[p] == top[p[0]] for p in links), sum(held[p] for p in links), ";".join(groups[i])) for i, links in enumerate(linked)
    ]


def rows(frame):
    return sorted((str(r["doc_id"]), *[r[c] for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups")]) for r in frame.collect())


def expected(texts):
    return sorted((str(i), *row) for (i, _), row in zip(texts, brute([t for _, t in texts])))


@pytest.fixture(scope="module")
def mixed(spark, sf_dir):
    rnd = random.Random(5)
    texts = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").limit(60).collect()]
    signs = [" ", "  ", "\n", "\t", "a", "the", "Haus", "é", "日本", "▁", "\x00", "😀", "12", "'ll", "<|endoftext|>", "<s>", "</s>", "<0x41>", "　", "\x1c", "\x85", "é"]
    texts += [(1000 + i, "".join(rnd.choice(signs) for _ in range(rnd.randrange(1, 40)))) for i in range(300)]
    texts += [(2000 + i, t) for i, t in enumerate([" ", "  ", "a ", " a", "\n a", "a \n", "x", "▁", " " * 70])]
    return texts + [(7, "same text twice"), (7, "same text twice"), (None, "no id"), (None, None), (5, "")]


def test_alignment_equals_brute_force(spark, mixed, monkeypatch):
    monkeypatch.setattr(alignment, "BLOCK_BYTES", 20_000)
    assert rows(alignment.align(docs_of(spark, mixed).repartition(3), *alignment.files())) == expected(mixed)


def test_chunks_are_forgotten_and_whole_texts_taken(mixed, monkeypatch):
    spec, model = (open(f, "rb").read() for f in alignment.files())
    a, b = tokenizers()
    texts = [t or "" for _, t in mixed]
    for known, whole in ((5, False), (10**6, True)):
        monkeypatch.setattr(alignment, "KNOWN", known)
        sides = alignment.Sides(spec.decode(), model)
        assert not sides.whole
        sides.whole = whole
        for at in range(0, len(texts), 50):
            part = texts[at : at + 50]
            lists = [x.to_pylist() for x in sides.encode(part)]
            for text, left, right in zip(part, *lists):
                if left or right:
                    assert left == a.encode(" " + text, add_special_tokens=False).ids and right == b.encode(text)


def test_long_white_space(spark):
    texts = [(1, " " * 150_000), (2, "x" * 30_000 + " " * 150_000 + "y")]
    a, b = tokenizers()
    got = {r["doc_id"]: r for r in alignment.align(docs_of(spark, texts), *alignment.files()).collect()}
    for i, t in texts:
        assert (got[i]["n_a"], got[i]["n_b"]) == (len(a.encode(" " + t, add_special_tokens=False).ids), len(b.encode(t)))
        assert got[i]["n_links"] == got[i]["n_a"] + got[i]["n_b"] - got[i]["n_groups"]


def test_odd_rows_extra_columns_and_an_empty_table(spark):
    texts = odd_texts()
    plain = rows(alignment.align(docs_of(spark, texts), *alignment.files()))
    assert plain == rows(alignment.align(docs_of(spark, texts, WIDE), *alignment.files())) == expected(texts)
    assert alignment.align(docs_of(spark, []), *alignment.files()).count() == 0


def test_pair_counts_and_digests(spark, mixed):
    found = alignment.blocks(docs_of(spark, mixed), *alignment.files(), True)
    counts = {(r["a"], r["b"]): r["count"] for r in alignment.pair_counts(found).collect()}
    assert max(counts.values()) > 10 and min(counts.values()) == 1
    whole, digests = (rows(alignment.align(docs_of(spark, mixed), *alignment.files(), whole_groups=w)) for w in (True, False))
    assert [(*r[:-1], hashlib.sha256(r[-1].encode()).hexdigest() if r[-1] else "") for r in whole] == digests


def test_query(spark, sf_dir):
    frame = alignment.op13_alignment(spark, sf_dir)
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert rows(frame.withColumn("groups", F.col("groups_sha256"))) == [(*r[:-1], hashlib.sha256(r[-1].encode()).hexdigest() if r[-1] else "") for r in expected(docs)]
