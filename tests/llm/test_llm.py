"""The training-data operators against brute force, exact round trips and held-out accuracy; and their
defined results for nulls, empty tables, ties, repeated rows, long texts and clashing names."""

import hashlib
import json
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from periodica.llm import bpe, exact_dedup, html_text, language_id, merkle, mixing, near_dedup, pii, sharding, tool_calls
from periodica.llm.components import components

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WIDE = DOCS + ", fingerprint string, kept string, component_id int, shard string, row string, node int"


def docs_of(spark, texts, schema=DOCS):
    wide = schema != DOCS
    return spark.createDataFrame([(i, t, "en", "s", None, *(["x", "y", 1, "z", "r", 2] if wide else [])) for i, t in texts], schema)


def odd_texts():
    long = " ".join(random.Random(1).choice(("the", "of", "and", "haus", "le")) + str(i % 97) for i in range(60_000))
    return [(1, None), (2, ""), (3, " \n\t "), (4, "Same text HERE, one two three"), (4, "Same text HERE, one two three"), (5, "same TEXT here, one two three"), (None, "no id at all here"), (None, None), (6, "é" * 3), (7, long), (8, "x" * 30_000)]


OPERATORS = {
    "bpe": lambda d: bpe.digests(bpe.tokenize(d, bpe.vocabulary())), "pii": pii.find_personal_data, "shard": sharding.shard, "near": near_dedup.near_groups,
    "mix": lambda d: mixing.mix(d).select("row.*", "copies", "copy"), "exact": exact_dedup.exact_groups, "language": language_id.identify, "merkle": merkle.fingerprints,
}


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_rows_and_empty_tables(spark, name):
    texts = odd_texts()
    plain = OPERATORS[name](docs_of(spark, texts))
    wide = OPERATORS[name](docs_of(spark, texts, WIDE))
    if name != "mix":
        assert plain.count() == len(texts)
        key = lambda rows: sorted(map(str, rows))
        assert key(plain.collect()) == key(wide.select(plain.columns).collect())
    else:
        assert wide.count() == plain.count()
    assert OPERATORS[name](docs_of(spark, [])).count() == 0


def test_bpe_equals_the_library_and_round_trips(spark, sf_dir):
    from tokenizers import Tokenizer

    path = bpe.vocabulary()
    library = Tokenizer.from_file(path)
    library.no_padding()
    library.no_truncation()
    texts = [r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").limit(80).collect()]
    rnd = random.Random(2)
    texts += ["a<|endoftext|>b <|STARTOFTEXT|>", "ΣΑΣ'LL don't", "a\x1cb\x85c d", "x" * 3000, "".join(rnd.choice("etaoin ") for _ in range(4000)), "".join(rnd.choice("etaoinshr") for _ in range(5000))]
    texts += ["".join(chr(c) for c in range(at, at + 256) if not 0xD800 <= c < 0xE000) for at in range(0, 0x3000, 256)]
    frame = docs_of(spark, list(enumerate(texts)))
    coded = bpe.tokenize(frame, path)
    back = {r["doc_id"]: r["decoded"] for r in bpe.detokenize(coded, path).collect()}
    for r in coded.collect():
        ids = library.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        assert np.frombuffer(r["ids"], "<u4").tolist() == ids
        assert r["decoded"] == back[r["doc_id"]] == library.decode(ids, skip_special_tokens=False)
        assert r["n_tokens"] == len(ids)


def test_golomb_round_trip():
    rng = np.random.default_rng(3)
    for n in (1, 2, 3, 1000):
        values = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
        assert (exact_dedup.golomb_decode(len(values), *exact_dedup.golomb_encode(values)) == values).all()


def test_communication_matrix_meets_both_margins_and_is_hypergeometric():
    blocks, shards = [10, 0, 37, 53], [34, 33, 33]
    table = sharding.communication_matrix(blocks, shards, 1)
    assert [sum(r) for r in table] == blocks
    assert [sum(c) for c in zip(*table)] == shards
    rng = np.random.default_rng(0)
    drawn = np.array([sharding.hypergeometric(rng, 40, 60, 30) for _ in range(4000)])
    assert abs(drawn.mean() - 12) < 0.2 and abs(drawn.var() - 30 * 0.4 * 0.6 * 70 / 99) < 0.5
    assert sharding.hypergeometric(rng, 3 * 10**10, 7 * 10**10, 10**6) == pytest.approx(3 * 10**5, abs=6000)


def test_shards_are_exact_gapless_and_mixed(spark):
    rows = sharding.shard(docs_of(spark, [(i, f"text {i}") for i in range(1003)])).collect()
    by = {}
    for r in rows:
        by.setdefault(r["shard"], []).append(r)
    assert sorted(map(len, by.values())) == [41] * 5 + [42] * 19
    for own in by.values():
        assert sorted(r["slot"] for r in own) == list(range(len(own)))
        ordered = [r["doc_id"] for r in sorted(own, key=lambda r: r["slot"])]
        assert ordered != sorted(ordered)
    assert {r["doc_id"] for r in rows} == set(range(1003))


def test_shards_of_repeated_rows_and_of_parts(spark, monkeypatch):
    """Sizes and checksums too; a third of all rows are one row; blocks and shards have several parts."""
    import zlib

    monkeypatch.setattr(sharding, "BLOCK_ROWS", 20)
    monkeypatch.setattr(sharding, "MAX_BLOCKS", 5)
    monkeypatch.setattr(sharding, "MIN_BLOCKS", 5)
    texts = [(1, "same é")] * 400 + [(None, None)] * 100 + [(i, f"text {i}") for i in range(2, 900)]
    rows = sharding.shard(docs_of(spark, texts, WIDE), 7).collect()
    expected = sorted((str(i), len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in texts)
    assert sorted((str(r["doc_id"]), r["size"], r["text_crc32"]) for r in rows) == expected
    by = {}
    for r in rows:
        by.setdefault(r["shard"], []).append(r)
    assert sorted(by) == list(range(7)) and max(map(len, by.values())) - min(map(len, by.values())) <= 1
    for own in by.values():
        assert sorted(r["slot"] for r in own) == list(range(len(own)))
        assert 30 < sum(r["doc_id"] == 1 for r in own) < 90


def test_mixing_meets_target_weights(spark):
    rows = [(i, f"t{i}", None, "a" if i % 10 else "b", None) for i in range(8000)] + [(9000, "t", None, None, None)]
    frame = spark.createDataFrame(rows, DOCS)
    out = mixing.mix(frame, {"a": 1.0, "b": 1.0}).select("row.source").groupBy("source").count().collect()
    counts = {r["source"]: r["count"] for r in out}
    assert set(counts) == {"a", "b"}
    assert counts["a"] == pytest.approx(4000, rel=0.06) and counts["b"] == pytest.approx(4000, rel=0.08)
    assert mixing.mix(frame, {}).count() == 0


def test_copies_of_one_row_go_to_many_tasks(spark):
    frame = spark.createDataFrame([(1, "same", None, "a", None)] * 3000 + [(i, f"t{i}", None, "a", None) for i in range(2, 3000)], DOCS)
    out = mixing.mix(frame, {"a": 1.0}, total=6000)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else so few bytes end in one task
    dealt = out.select("row.doc_id", F.spark_partition_id().alias("p")).where("doc_id = 1").groupBy("p").count().collect()
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(dealt) == 4 and max(r["count"] for r in dealt) < 0.4 * sum(r["count"] for r in dealt)
    assert "place" not in out.columns


def test_poisson_of_small_and_large_rates(spark):
    table = spark.createDataFrame([("a", 0.3), ("b", 4.0), ("c", 10_000_000.0)], "source_key string, rate double")
    for r in mixing.distributions(table).collect():
        rate, p = {"a": 0.3, "b": 4.0, "c": 1e7}[r["source_key"]], np.diff(r["cdf"], prepend=0.0)
        k = r["low"] + np.arange(len(p))
        assert r["cdf"][-1] == pytest.approx(1.0) and (p * k).sum() == pytest.approx(rate) and (p * (k - rate) ** 2).sum() == pytest.approx(rate, rel=1e-6)
        if rate < 5:
            assert p[:3].tolist() == pytest.approx([np.exp(-rate) * rate**i / [1, 1, 2][i] for i in range(3)])


def test_rows_that_share_an_id_draw_each_for_itself(spark):
    frame = spark.createDataFrame([(None, f"t{i}", None, "a", None) for i in range(300)] + [(7, f"u{i}", None, "a", None) for i in range(300)] + [(i, "t", None, "b", None) for i in range(600)], DOCS)
    drawn = [r["copies"] for r in mixing.mix(frame, {"a": 1.0, "b": 1.0}).where("row.doc_id IS NULL AND copy = 1").collect()]
    assert 150 < len(drawn) < 230 and len(set(drawn)) > 2
    counted = mixing.mix(frame, {"a": 1.0, "b": 1.0}, total=12_000).groupBy("row.source").count().collect()
    assert {r["source"]: r["count"] for r in counted} == {"a": pytest.approx(6000, rel=0.06), "b": pytest.approx(6000, rel=0.06)}


def brute_groups(texts):
    sets = {}
    for i, t in texts:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[i] = {tuple(words[k : k + 5]) for k in range(len(words) - 4)} if len(words) > 4 else ({tuple(words)} if words else set())
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for n, x in enumerate(ids):
        for y in ids[:n]:
            both = len(sets[x] & sets[y])
            if both and 100 * both >= 75 * (len(sets[x]) + len(sets[y]) - both):
                a, b = find(x), find(y)
                parent[max(a, b)] = min(a, b)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def near_texts():
    """Families of near copies whose members lie close to the threshold, in chains and stars."""
    rnd, texts = random.Random(4), []
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(5))
    for _ in range(6):
        base = [word() for _ in range(60)]
        for _ in range(25):
            copy = list(base)
            for _ in range(rnd.randrange(0, 5)):
                copy[rnd.randrange(60)] = word()
            texts.append(" ".join(copy))
    return [(i, t) for i, t in enumerate(texts)] + [(900 + i, t) for i, t in enumerate(["a b", "A B", "one", "", None, "a b c d e", "a b c d  e"])]


def test_near_groups_equal_brute_force(spark):
    texts = near_texts()
    expected = brute_groups(texts)
    for r in near_dedup.near_groups(docs_of(spark, texts)).collect():
        assert (r["n_shingles"], r["component_id"]) == expected[r["doc_id"]]
        assert r["kept"] == (r["doc_id"] == r["component_id"])


def test_blocks_of_a_large_bucket_answer_for_every_pair(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 7)
    texts = near_texts()
    expected = brute_groups(texts)
    assert all(r["component_id"] == expected[r["doc_id"]][1] for r in near_dedup.near_groups(docs_of(spark, texts)).collect())


def test_members_move_in_proportion_where_one_component_is_large(spark):
    """Rows for 10,000 and for 40,000 members of a bucket, of which 60 stand outside of the largest component."""
    moved = []
    for n in (10_000, 40_000):
        inside = spark.range(n).select(
            F.lit(7).cast("long").alias("bucket"), F.lit(3).alias("band"), F.lit(n).cast("long").alias("size"), F.lit(40 * n).cast("long").alias("hashes"), F.col("id").alias("node"),
            F.when(F.col("id") < 60, F.col("id")).otherwise(100).cast("long").alias("root"),
        )
        found = near_dedup.tiles(inside)
        moved.append(found.count())
        blocks = found.groupBy("left", "right").agg(F.count("*").alias("n"), F.min("root").alias("low"), F.max("root").alias("high")).collect()
        assert max(r["n"] for r in blocks) < 3 * near_dedup.BLOCK and all(r["low"] < 60 for r in blocks)
        assert found.where("root < 60").select("node", "left", "right").distinct().count() == 60 * len(blocks)
    assert moved[0] < 1.2 * 10_000 and moved[1] < 4.2 * moved[0]


def test_components_of_a_path(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(150)] + [(500, 501), (7, 7)], "a long, b long")
    found = {r["node"]: r["root"] for r in components(links).collect()}
    assert found == {**dict.fromkeys(range(151), 0), 500: 500, 501: 500}


def test_copies_and_near_copies_are_dropped_once(spark):
    texts = [(1, "A b c d e f"), (2, "a B c d e f"), (2, "a B c d e f"), (3, "other words are in here"), (None, "a b c d e f")]
    left = sorted((str(r["doc_id"]), r["text"]) for r in exact_dedup.drop_copies(docs_of(spark, texts, WIDE)).collect())
    assert left == [("2", "a B c d e f"), ("3", "other words are in here"), ("None", "a b c d e f")]
    near = near_dedup.drop_near_copies(docs_of(spark, texts[:1] + texts[1:2] + texts[3:4])).collect()
    assert sorted(r["doc_id"] for r in near) == [1, 3]


def test_rows_go_for_their_own_text(spark):
    """One doc_id at two texts, of which one is a copy of something else."""
    exact = exact_dedup.drop_copies(docs_of(spark, [(1, "a b c d e f"), (1, "wholly other words"), (2, "A B C D E F"), (5, "a"), (5, "b"), (9, "b")], WIDE))
    assert sorted((r["doc_id"], r["text"]) for r in exact.collect()) == [(1, "wholly other words"), (2, "A B C D E F"), (5, "a"), (9, "b")]
    near = near_dedup.drop_near_copies(docs_of(spark, [(2, "a b c d e f"), (2, "wholly other words"), (1, "A B C D E F"), (None, None)], WIDE))
    assert sorted((str(r["doc_id"]), str(r["text"])) for r in near.collect()) == [("1", "A B C D E F"), ("2", "wholly other words"), ("None", "None")]
    for drop in (exact_dedup.drop_copies, near_dedup.drop_near_copies):
        empty = drop(docs_of(spark, [], WIDE))
        assert empty.count() == 0 and empty.columns == docs_of(spark, [], WIDE).columns


def test_intersections_of_long_sets():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 5000, n, dtype=np.uint64)) for n in (1, 40, 3000, 3000, 700)]
    found = near_dedup.intersections(np.concatenate(sets), np.array(list(map(len, sets))), 64)
    for i, x in enumerate(sets):
        assert [found[i, j] for j in range(5) if j != i] == [len(np.intersect1d(x, y)) for j, y in enumerate(sets) if j != i]


def test_components_of_a_star_with_a_hot_node(spark):
    links = spark.createDataFrame([(0, i) for i in range(1, 900)] + [(899, i) for i in range(900, 1500)], "a long, b long")
    assert {(r["node"], r["root"]) for r in components(links).collect()} == {(i, 0) for i in range(1500)}


def test_languages_held_out(spark):
    frame = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = language_id.identify(frame).where("held_out").join(frame.select("doc_id", "lang"), "doc_id").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in found) / len(found) > 0.97
    empty = language_id.identify(docs_of(spark, [(1, "123 !!"), (2, None), (3, "words")]), {}).collect()
    assert {r["lang_pred"] for r in empty} == {"und"}
    kept = language_id.keep_identified(docs_of(spark, [(1, "123 !!"), (2, None), (3, "words"), (6, "more words")])).collect()
    assert sorted(r["doc_id"] for r in kept) == [3, 6]
    assert language_id.keep_identified(docs_of(spark, [], WIDE)).count() == 0


def test_language_scores_equal_brute_force(spark):
    """Profiles, prototypes, cosines and scores on a small table, from n-grams bound and bundled one by one."""
    rnd = random.Random(9)
    words = {"a": ["the", "of", "and", "Éa"], "b": ["der", "und", "ist", "ß"], "c": ["il", "la", "che", "è"]}
    texts = [(i, " ".join(rnd.choice(words[lang]) for _ in range(rnd.randrange(1, 9))), lang) for i in range(90) for lang in [rnd.choice("abc")]]
    texts += [(200, "² ½", "a"), (201, "①②③ Ⅷ", "b"), (202, "x²y", None), (203, None, "a"), (204, "a", "a"), (None, "der und", "b")]
    rows = language_id.identify(spark.createDataFrame([(i, t, lang, "s", None) for i, t, lang in texts], DOCS)).collect()

    def bundle(text):
        plain = " " + re.sub("[^a-zéèß]+", " ", re.sub("[²½①②③Ⅷ]", " ", (text or "").lower())).strip() + " "
        total = np.zeros(language_id.DIMENSIONS)
        for k in range(len(plain) - language_id.GRAM + 1):
            bound = np.ones(language_id.DIMENSIONS)
            for i in range(language_id.GRAM):
                bound = bound * np.roll(language_id.letter_vector(ord(plain[k + i])), language_id.GRAM - 1 - i)
            total += bound
        return total, bool(plain.strip())

    import zlib

    held = lambda i: zlib.crc32(str("" if i is None else i).encode()) % 3 == 1
    unit = lambda v: v / max(np.linalg.norm(v), 1e-12)
    learned = np.array([unit(sum(bundle(t)[0] for i, t, lang in texts if lang == name and t is not None and not held(i))) for name in "abc"])
    sharp = np.array([unit(v - learned.mean(axis=0)) for v in learned])
    expected = []
    for i, t, _ in texts:
        profile, letters = bundle(t)
        cosines = sharp @ unit(profile)
        expected.append((str(i), str(t), held(i), *(("abc"[int(cosines.argmax())], max(0.0, float(cosines.max()))) if letters else ("und", 0.0))))
    text_of = {str(i): str(t) for i, t, _ in texts}
    found = sorted((str(r["doc_id"]), text_of[str(r["doc_id"])], r["held_out"], r["lang_pred"], r["score"]) for r in rows)
    for x, y in zip(found, sorted(expected)):
        assert x[:4] == y[:4] and x[4] == pytest.approx(y[4], abs=1e-4)
    assert {x[3] for x in found if x[0] in ("200", "201", "203")} == {"und"}


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute_spans(text):
    out = []
    for k, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            bad = {"ip": lambda: any(int(p) > 255 for p in m[0].split(".")), "card": lambda: not 13 <= len(digits) <= 19 or not pii.luhn(digits), "phone": lambda: not 9 <= len(digits) <= 15}
            if not bad.get(kind, lambda: False)():
                out.append((k, m.start(), m.end()))
    return out


def test_base_spans_equal_the_patterns():
    rnd = random.Random(6)
    for _ in range(3000):
        text = "".join(rnd.choice(["a", "@", ".", "1", "23", "255", "4", "+", " ", "-", "(", "com", "%", "é", "4003036626649762"]) for _ in range(rnd.randrange(1, 25)))
        assert pii.base_spans(text) == brute_spans(text), text
    assert pii.base_spans("1" * 200_000 + "." + "a" * 200_000) == []


def test_field_adds_what_patterns_miss_and_leaves_clean_text_alone(spark):
    cards = ["4003036626649769", "5472476151044302"]
    texts = [(i, f"call +1 (017) 555-77{i:02d} or mail a.{i}@mail.example.com about version 3.0 and 4.0 of 12 things") for i in range(60)]
    texts += [(100 + i, f"card {c} was used") for i, c in enumerate(c for c in (f"{n:016d}" for n in range(4003036626649000, 4003036626650000)) if pii.luhn(c))]
    texts += [(900, "seen +1 (826) 555-4081 190.137.2.1 there"), (901, "the version 4.0 of 2020 has 17 parts")]
    found = {r["doc_id"]: r["spans"] for r in pii.find_personal_data(docs_of(spark, texts)).collect()}
    assert cards and any(s["kind"] == "phone" and not s["base"] for s in found[900])
    assert found[901] == []
    for i, t in texts:
        assert [(pii.KINDS.index(s["kind"]), s["start"], s["end"]) for s in found[i] if s["base"]] == brute_spans(t)


@pytest.mark.parametrize("token", ["9" * 1_000_000 + ".1.1.1", "1." * 500_000, "@" * 1_000_000, "a@" * 300_000 + "b.c", "1" * 1_000_000, "+1 " + "2" * 300_000], ids=lambda t: t[:6])
def test_huge_tokens_end_no_job(token):
    spans = pii.base_spans(token)
    assert all(0 <= a < b <= len(token) for _, a, b in spans)
    tokens = pii.marked_tokens(token)
    assert len(pii.features(token, tokens)) == len(tokens)
    assert len(list(pii.examples(token))) >= 0 and isinstance(pii.Field().more_spans(token, spans), list)


def test_parts_of_addresses_of_any_length():
    for digits in ("0", "255", "256", "0255", "00256", "9" * 5000, "0" * 5000, "1" * 3, "99"):
        small = len(digits.lstrip("0")) <= 3 and int(digits.lstrip("0") or 0) <= 255
        assert pii.is_part(digits) == small


def test_skip_edges_decide_what_a_distant_repeat_is(spark):
    rnd = random.Random(3)
    digits = lambda n: "".join(rnd.choice("123456789") for _ in range(n))
    texts = []
    for i in range(120):
        phone, mail = f"+1{digits(10)}", f"u{digits(3)}.n@mail{i}.example.org"
        texts.append((i, f"{phone} then {'word ' * 30} {phone} and {mail} {'word ' * 30} {mail} in 20{digits(2)} or 20{digits(2)} x{digits(2)}"))
    field = pii.learn(docs_of(spark, texts))
    assert (field.skip[pii.ANY, [1, 4]] > 0.5).all()
    far = " word" * 500
    new = {900: f"call +12345678912 {far} or (234)5678912 late", 901: f"call +19876543219 {far} or (234)5678912 late", 902: f"see ann.b7@mail1.example.org {far} ann.b7@intranet said"}
    frame = docs_of(spark, texts + list(new.items()))
    added = lambda: {r["doc_id"]: [(s["kind"], (r["doc_id"] in new) and new[r["doc_id"]][s["start"] : s["end"]]) for s in r["spans"] if not s["base"]] for r in pii.find_personal_data(frame, field).collect()}
    found = added()
    assert found[900] == [("phone", "(234)5678912")] and found[902] == [("email", "ann.b7@intranet")] and found[901] == []
    assert not any(found[i] for i in range(120))
    field.skip[:] = 0
    assert added()[900] == [] and added()[902] == []


def test_gradient_is_that_of_the_pseudo_likelihood():
    import pandas as pd

    rng = np.random.default_rng(5)
    rows = [([1, 2], -1, 1, [0, 1, 2], 1, 3), ([2, 3], 0, -1, [], 0, 5), ([], 1, 2, [0, 2, 1, 1, 0, 1], 2, 1), ([7], 4, 0, [3, 4, 1], 4, 2)]
    batch = pd.DataFrame(rows, columns=["own", "prior", "next", "skips", "label", "n"])
    field = pii.Field()
    start = rng.normal(size=field.flat().shape)

    def value(flat):
        field.set(flat)
        total = 0.0
        for own, prior, after, skips, y, n in rows:
            score = field.unary[pii.BUCKETS] + sum(field.unary[f] for f in own) + (field.pair[prior] if prior >= 0 else 0) + (field.pair[:, after] if after >= 0 else 0)
            for kind, label, times in np.array(skips, int).reshape(-1, 3):
                score = score + np.eye(5)[label] * (field.skip[kind, label] + field.skip[pii.ANY, label]) * times
            total += n * (score[y] - np.log(np.exp(score).sum()))
        return total

    field.set(start.copy())
    slope, share = field.gradient(batch)
    for place in rng.choice(np.flatnonzero(share), 40, replace=False).tolist():
        step = np.zeros_like(start)
        step[place] = 1e-5
        assert (value(start + step) - value(start - step)) / 2e-5 == pytest.approx(slope[place], abs=1e-6)


def test_long_tokens_are_read_whole(spark):
    long = "a" * 100 + "4003036626649762"
    tokens = pii.marked_tokens(long + " " + long[:-1])
    assert pii.features(long + " " + long[:-1], tokens)[0] != pii.features(long + " " + long[:-1], tokens)[1]


def test_skip_edges_grow_with_the_tokens():
    text = " ".join(["4003036626649762"] * 500)
    tokens = pii.marked_tokens(text)
    assert len(pii.skip_edges(text, tokens)) < 3 * len(tokens)


def test_merkle_edits_and_next(spark):
    texts = [(3, "one two three four five\nsix seven eight\n\nnine ten"), (9, "eins zwei drei vier"), (5, None), (7, "日本 語 テ キ ス ト\nü")]
    rows = {r["doc_id"]: r for r in merkle.fingerprints(docs_of(spark, texts)).collect()}
    order = sorted(texts, reverse=True)
    for n, (i, t) in enumerate(order):
        t, following = t or "", order[(n + 1) % len(order)][1] or ""
        half = len(t) // 2
        text = t[: len(t) - half] + following[:half]
        assert rows[i]["edited_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert rows[i]["n_chars"] == len(t)
    same = spark.createDataFrame([("a b\nc d e f g\nh", "a b\nc d X f g\nh"), ("a\nb", "a\nb"), ("", "x")], "x string, y string")
    found = same.select(merkle.tree(F.col("x")).alias("x"), merkle.tree(F.col("y")).alias("y")).select(merkle.compared(F.col("x"), F.col("y")).alias("c")).collect()
    assert [r["c"]["changed_paragraphs"] for r in found] == [1, 0, 1] and found[1]["c"]["likeness"] == 1.0 and found[2]["c"]["likeness"] == 0.0
    assert 0.5 < found[0]["c"]["likeness"] < 1


def brute_likeness(one, two):
    """From the fingerprints' texts, by sets: by runs if both have them, else by pieces."""
    both = "~" in one and "~" in two
    one, two = (re.sub("=[^~]*~", "=", f) if both else re.sub("~[^,)]*", "", f) for f in (one, two))
    if one.split(":")[0] == two.split(":")[0]:
        return 1.0
    size = lambda branches: sum(x.count("=") + x.count(".") for x in branches)
    a, b = (set(f.split(":")[1].split(";")) for f in (one, two))
    same = size(a & b)
    a, b = ({p for x in s for p in x.split("(")[1].rstrip(")").split(",")} for s in (a - b, b - a))
    same += size(a & b)
    a, b = ({x for p in s for x in p.split("=")[1].split(".") if x} for s in (a - b, b - a))
    whole = 2 * same + len(a) + len(b)
    return 2 * (same + len(a & b)) / whole if whole else 0.0


@pytest.mark.parametrize("bytes_", [300, 16 << 20])
def test_merkle_equals_brute_force_in_ranges_of_any_size(spark, monkeypatch, bytes_):
    """All columns; null and repeated ids, equal and short texts, many ranges or few."""
    monkeypatch.setattr(merkle, "RANGE_BYTES", bytes_)
    rnd = random.Random(21)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(1, 9)))
    base = ["\n".join(" ".join(word() for _ in range(rnd.randrange(0, 30))) for _ in range(rnd.randrange(1, 12))) for _ in range(40)]
    ids = [None] * 60 + [7] * 60 + [rnd.randrange(-(10**6), 10**6) for _ in range(150)] + list(range(100, 130))
    texts = [(i, rnd.choice([rnd.choice(base), rnd.choice(base) + " " + word(), rnd.choice(base)[:150], None])) for i in ids]
    frame = docs_of(spark, texts, WIDE)
    rows = merkle.fingerprints(frame).collect()
    hashes = {r["text"] or "": r["h"] for r in frame.select("text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).collect()}
    order = sorted(((-(2**63) if i is None else i), -hashes[t or ""], t or "") for i, t in texts)[::-1]
    prints = {r["t"]: r["f"] for r in frame.select(F.coalesce("text", F.lit("")).alias("t"), merkle.tree(F.col("text")).alias("f")).distinct().collect()}
    expected = []
    for n, (i, _, t) in enumerate(order):
        following = order[(n + 1) % len(order)][2]
        half = len(t) // 2
        expected.append((i, len(t), hashlib.sha256((t[: len(t) - half] + following[:half]).encode()).hexdigest(), prints[t], brute_likeness(prints[t], prints[following])))
    found = [(-(2**63) if r["doc_id"] is None else r["doc_id"], r["n_chars"], r["edited_sha256"], r["fingerprint"], r["near_next"]) for r in rows]
    assert sorted(found) == sorted(expected)
    for r in rows:
        assert r["near_edited"] == brute_likeness(r["fingerprint"], r["edited_fingerprint"]) and 0 <= r["near_edited"] <= 1


def test_likeness_under_insertion_deletion_and_offset(spark):
    rnd = random.Random(4)
    words = ["".join(rnd.choices("abcdefghijklmnop", k=rnd.randint(2, 9))) for _ in range(4000)]
    text = "\n".join(" ".join(words[i : i + 200]) for i in range(0, 4000, 200))
    solid = "".join(chr(rnd.randint(0x4E00, 0x9000)) for _ in range(6000))
    pairs = {
        "insertion": (text, "\n".join("word " + p for p in text.split("\n"))),
        "deletion": (text, "\n".join(p.split(" ", 1)[1] for p in text.split("\n"))),
        "offset": (text, "one more " + text),
        "solid": (solid, solid[:3000] + "語" + solid[3000:]),
        "leaf": (text.replace("\n", " "), text.replace("\n", " ").replace(words[77] + " ", "", 1)),
    }
    frame = spark.createDataFrame([(k, *v) for k, v in pairs.items()], "k string, x string, y string")
    found = frame.select("k", merkle.tree(F.col("x")).alias("x"), merkle.tree(F.col("y")).alias("y")).select("k", merkle.compared(F.col("x"), F.col("y"))["likeness"].alias("near"))
    near = {r["k"]: r["near"] for r in found.collect()}
    assert min(near.values()) > 0.9 and max(near.values()) < 1, near
    odd = ["a  b   c ", " ", "", "x" * 99, solid[:90] + "  " + "ab" * 40]
    joined = spark.createDataFrame([(t,) for t in odd], "t string").select("t", F.array_join(merkle.in_pieces(F.col("t")), "").alias("j")).collect()
    assert [r["t"] for r in joined] == [r["j"] for r in joined]
    rows = {r["doc_id"]: r for r in merkle.fingerprints(docs_of(spark, [(2, "one two three"), (1, "日本語のテキスト"), (0, text)])).collect()}
    assert 0.2 < rows[2]["near_edited"] < 0.8 and 0.1 < rows[1]["near_edited"] < 0.8 and rows[1]["near_next"] == 0


def test_likeness_has_no_gap_at_any_length(spark):
    """Every length from 1 to 400 against a brute-force tree, and on both sides of the length up to which runs are kept."""
    rnd = random.Random(12)
    word = lambda: "".join(rnd.choice("abcdefghijklmnop") for _ in range(rnd.randint(1, 9)))
    text = ""
    while len(text) < 450:
        text += word() + rnd.choice([" ", " ", " ", " ", "\n"])
    pairs = [(n, text[:n], text[: n + 20]) for n in range(1, 401)] + [(1000 + n, text[:n] + word(), word() + " " + text[:n]) for n in range(1, 401)]
    frame = spark.createDataFrame(pairs, "k int, x string, y string").select("k", merkle.tree(F.col("x")).alias("x"), merkle.tree(F.col("y")).alias("y"))
    near = {}
    for r in frame.select("*", merkle.compared(F.col("x"), F.col("y"))["likeness"].alias("near")).collect():
        near[r["k"]] = r["near"]
        assert r["near"] == brute_likeness(r["x"], r["y"])
    assert near[195] > 0.8 and near[230] > 0.8
    assert min(near[n] for n in range(100, 401)) > 0.6 and min(near[n] for n in range(181, 201)) > 0.7
    assert min(near[1000 + n] for n in range(150, 401)) > 0.6


def test_an_edited_text_that_falls_below_the_limit_keeps_its_half(spark):
    rnd = random.Random(13)
    word = lambda: "".join(rnd.choice("abcdefghijklmnop") for _ in range(rnd.randint(2, 8)))
    texts = []
    for i in range(0, 80, 2):
        texts += [(i + 1, " ".join(word() for _ in range(60))[:240]), (i, "tiny!")]
    rows = {r["doc_id"]: r for r in merkle.fingerprints(docs_of(spark, texts)).collect()}
    halves = [rows[i + 1]["near_edited"] for i in range(0, 80, 2)]
    assert min(halves) > 0.35 and sum(halves) / len(halves) > 0.55


PAGE = """<html><head><title>T</title></head><body><header>Site</header><nav><a href="/">home</a></nav><div id="cookie-notice">We use cookies</div>
<article><h1>Title &amp; more</h1><p>First <b>bold</b>&nbsp;words<br>here<p>Les.<div class="ad">Buy</div><p>Last</p><script>"<p>no</p>"</script></article>
<section class="comments"><p>I like it</p></section><aside>side</aside><form>f</form><footer>c</footer></body></html>"""


def test_main_text(spark):
    assert html_text.main_text(PAGE) == "Title & more\nFirst bold words here\nLes.\nLast"
    assert html_text.main_text(None) == html_text.main_text("") == ""
    assert html_text.main_text('<p title="never closed>' + "<b " * 50_000) is not None
    pages = spark.createDataFrame([(1, "u", PAGE), (1, "u", PAGE), (None, None, None)], "page_id long, url string, html string")
    assert html_text.extract(pages).count() == 3


PROSE = "It was the first of the days on which they had all that is to be said about it by the end of the year."


def test_main_text_is_judged_inside_and_outside_of_regions():
    links = "".join(f'<li><a href="/{i}">Another story with a long headline, number {i}, from the archive of the year</a></li>' for i in range(3))
    related = f"<article><h1>Title</h1><p>{PROSE}</p><p>Odd: xyz.</p><p>{PROSE}</p><h3>More</h3><ul>{links}</ul></article>"
    assert html_text.main_text(related) == f"Title\n{PROSE}\nOdd: xyz.\n{PROSE}"
    beside = f"<div>Site</div><div>{links}</div><div><p>{PROSE}</p><p>{PROSE}</p></div><article><p>A teaser.</p></article>"
    assert html_text.main_text(beside) == f"{PROSE}\n{PROSE}\nA teaser."
    anchors = f'<article><h2><a href="#a">Linked title</a></h2><p><a name="a">{PROSE}</a></p><p><a href="/x">&eacute;&eacute;&eacute;</a> {"ab cd " * 15}</p></article>'
    assert html_text.main_text(anchors) == f"Linked title\n{PROSE}\nééé {('ab cd ' * 15).strip()}"


def test_main_text_of_unmarked_noisy_and_other_pages(spark):
    menu = "".join(f'<li><a href="/{i}">Strona numer {i}</a></li>' for i in range(4))
    page = lambda *texts: f'<html lang="pl"><body><ul>{menu}</ul><div>{"".join(f"<p>{t}</p>" for t in texts)}</div><ul>{menu}</ul></body></html>'
    noisy = " ".join(w + ("%%%", "***", "###", "$$$", "&amp;&amp;&amp;")[i % 5] for i, w in enumerate(PROSE.split()))
    assert html_text.main_text(page(noisy)).count("***") == noisy.count("***")
    assert html_text.words_of("The%%% *** 12 day,###") == ["the", "", "day"]
    polish = "Kiedy wrócił do domu, zastał otwarte drzwi i ciemny korytarz, a na stole leżał list, którego nikt jeszcze nie przeczytał."
    assert html_text.main_text(page(polish, "Nikt.", polish)) == f"{polish}\nNikt.\n{polish}"
    assert html_text.main_text(page("語" * 90)) == "語" * 90
    rnd = random.Random(5)
    made = lambda: " ".join(rnd.choice(("się", "nie", "jest")) if rnd.random() < 0.5 else "".join(rnd.choices("aeioklmnrst", k=9)) for _ in range(60))
    pages = spark.createDataFrame([(i, "u", page(made())) for i in range(30)], "page_id long, url string, html string")
    assert html_text.learn(pages) == {"pl": {"się", "nie", "jest"}}
    assert [r["text"] != "" for r in html_text.extract(pages).collect()] == [True] * 30


def call(ident, name, arguments, after=()):
    return {"id": ident, "name": name, "arguments": arguments, "after": list(after)}


def test_tool_calls(spark):
    asked = lambda *calls: json.dumps({"tool_calls": list(calls)})
    told = lambda ident, text: json.dumps({"tool_call_id": ident, "content": text})
    good = {"turn": 1, "question": "q"}
    rows = [
        (1, 0, "assistant", asked(call("b", "answer", {"question": "z", "turn": 2, "language_hint": "x"}, ["a"]), call("a", "answer", good))),
        (1, 1, "tool", told("a", "A")), (1, 1, "tool", told("a", "A")), (1, 2, "tool", told("zz", "Z")),
        (2, 0, "assistant", asked(call("x", "answer", good, ["y"]), call("y", "answer", {"turn": "1", "extra": 0}, ["x"]), call("n", "other", [1]))),
        (3, 5, "assistant", asked(call("e", "set_system", {"prompt": "p", "turn": 1}))), (3, 5, "tool", told("e", "early")), (None, 0, "assistant", "no JSON"), (None, None, None, None),
    ]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = {(r["conv_id"], r["call_id"]): r for r in tool_calls.link_tool_calls(frame, tool_calls.TURN_TOOLS).collect()}
    assert set(found) == {(1, "a"), (1, "b"), (1, "zz"), (2, "x"), (2, "y"), (2, "n"), (3, "e")}
    assert (found[1, "a"]["status"], found[1, "a"]["level"], found[1, "a"]["n_results"]) == ("linked", 0, 2)
    assert (found[1, "b"]["status"], found[1, "b"]["level"], found[1, "b"]["errors"]) == ("no result", 1, "")
    assert found[1, "zz"]["status"] == "no call" and found[3, "e"]["status"] == "early"
    assert found[2, "x"]["status"] == found[2, "y"]["status"] == "cycle"
    assert found[2, "y"]["errors"] == "no question,turn is no integer,unknown extra"
    assert found[2, "n"]["errors"] == "unknown tool,arguments are no object"
    assert found[1, "a"]["json"] == '{"arguments":{"question":"q","turn":1},"id":"a","name":"answer","result":"A"}'


def test_levels_of_chains_and_graphs(spark):
    rnd = random.Random(8)
    after = {("chain", f"c{i}"): [f"c{i - 1}"] if i else [] for i in range(70)}
    after |= {("graph", f"g{i}"): [f"g{j}" for j in range(i) if rnd.random() < 0.3] + ["gone"] for i in range(12)}
    after |= {("loop", "x"): ["y", "z"], ("loop", "y"): ["x"], ("loop", "z"): []}
    calls = spark.createDataFrame([(c, i, a) for (c, i), a in after.items()], "conv_id string, id string, after array<string>")

    def level(c, i, seen=()):
        if i in seen:
            return None
        own = [level(c, p, (*seen, i)) for p in after[c, i] if (c, p) in after]
        return None if None in own else 1 + max(own, default=-1)

    found = {(r["conv_id"], r["id"]): r["level"] for r in tool_calls.levels(calls).collect()}
    assert found == {k: -1 if level(*k) is None else level(*k) for k in after}


def test_sql_oracles(spark, sf_dir, duck):
    from conftest import oracle_rows, rows_of
    from periodica.llm.queries import ORACLE_SQL, QUERIES

    for name, sql in ORACLE_SQL.items():
        frame = QUERIES[name](spark, sf_dir)
        columns, expected = oracle_rows(duck, sql)
        assert sorted(frame.columns) == columns
        assert rows_of(frame) == expected, name


def test_pipeline_equals_brute_force(spark, sf_dir):
    import corpus_pipeline

    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "near_dedup", "mixing", "bpe"]
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source").collect()]
    lettered = [d for d in docs if re.search(r"[^\W\d_]", d[1] or "")]
    newest = {}
    for i, t, s in sorted(lettered):
        newest[re.sub("[A-Z]", lambda m: m[0].lower(), t)] = (i, t, s)
    exact = sorted(newest.values())
    groups = brute_groups([(i, t) for i, t, _ in exact])
    near = [d for d in exact if groups[d[0]][1] == d[0]]
    counts = {}
    for _, _, s in near:
        counts[s] = counts.get(s, 0) + 1
    roots = sum(n**0.5 for n in counts.values())
    expected = {}
    for i, t, s in near:
        rate = len(near) * (counts[s] ** 0.5 / roots) / counts[s]
        u = int(hashlib.md5(f"5|{i}|{hashlib.md5(t.encode()).hexdigest()}".encode()).hexdigest()[:13], 16) / 2**52
        total, p, k = 0.0, np.exp(-rate), 0
        while (total := total + p) <= u:
            k += 1
            p *= rate / k
        if k:
            expected[i] = k
    found = {}
    for r in corpus_pipeline.run(spark, sf_dir).collect():
        found[r["doc_id"]] = found.get(r["doc_id"], 0) + 1
    assert found == expected


def test_stages_on_odd_rows_and_empty_tables(spark):
    import corpus_pipeline

    odd, empty = docs_of(spark, odd_texts(), WIDE), docs_of(spark, [], WIDE)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, "").count() == 0
        if name != "bpe":
            assert stage(spark, odd, "").columns == odd.columns and stage(spark, empty, "").columns == odd.columns
    kept = lambda name: sorted((str(r["doc_id"]), (r["text"] or "")[:9]) for r in dict(corpus_pipeline.STAGES)[name](spark, odd, "").collect())
    assert kept("language_id") == sorted((str(i), t[:9]) for i, t in odd_texts() if re.search(r"[^\W\d_]", t or ""))
    assert [x for x in kept("exact_dedup") if x[0] in "1245None"] == [("2", ""), ("5", "same TEXT"), ("None", ""), ("None", "no id at ")]
    assert [x for x in kept("near_dedup") if x[0] in "45"] == [("4", "Same text"), ("4", "Same text")]
    assert dict(corpus_pipeline.STAGES)["bpe"](spark, odd, "").count() == len(odd_texts())


def test_levels_of_a_long_chain_with_a_double_parent_and_of_layers(spark):
    chain = [("c", str(i), [str(i - 1)] if i else []) for i in range(150)] + [("c", "x", ["149", "3"])]
    layers = [(None, f"{k}.{i}", [f"{k - 1}.{j}" for j in range(4)] if k else []) for k in range(9) for i in range(4)]
    ring = [("r", "a", ["c"]), ("r", "b", ["a"]), ("r", "c", ["b"]), ("r", "d", ["c", "e"]), ("r", "e", []), ("s", "a", ["a"])]
    calls = spark.createDataFrame(chain + layers + ring, "conv_id string, id string, after array<string>")
    found = {(r["conv_id"], r["id"]): r["level"] for r in tool_calls.levels(calls).collect()}
    assert all(found["c", str(i)] == i for i in range(150)) and found["c", "x"] == 150
    assert all(found[None, f"{k}.{i}"] == k for k in range(9) for i in range(4))
    assert [found["r", x] for x in "abcde"] == [-1, -1, -1, -1, 0] and found["s", "a"] == -1


def test_messages_in_white_space_null_roles_and_wide_integers(spark):
    schema = "conv_id string, turn int, role string, text string, id string, level int, name string"
    call = lambda n: '{"tool_calls":[{"id":"a","name":"answer","arguments":{"question":"q","turn":' + n + "}}]}"
    rows = [("w", 1, "assistant", "\n  " + call("1")), ("w", 2, "tool", '\t{"tool_call_id":"a","content":"ok"}'), ("n", 1, None, call("1"))]
    rows += [(f"i{k}", 1, "assistant", call(n)) for k, n in enumerate(["123456789012345678901234567890", "1e2", "1.0", "1.5", '"1"'])]
    frame = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], schema)
    found = {r["conv_id"]: r for r in tool_calls.link_tool_calls(frame, tool_calls.TURN_TOOLS).collect()}
    assert found["w"]["status"] == "linked" and "n" not in found
    assert [found[f"i{k}"]["errors"] for k in range(5)] == ["", "", "", "turn is no integer", "turn is no integer"]
    assert tool_calls.link_tool_calls(frame.limit(0), tool_calls.TURN_TOOLS).count() == 0
    turns = spark.createDataFrame([("z", 1, None, "hello"), ("z", 2, "assistant", "hi")], "conv_id string, turn int, role string, text string")
    linked = tool_calls.link_tool_calls(tool_calls.turns_as_calls(turns), tool_calls.TURN_TOOLS).collect()
    assert [(r["status"], r["name"]) for r in linked] == [("linked", "answer")]


def test_names_of_comments_and_notices_are_out_and_layout_names_are_not():
    page = lambda name, text: f"<body class='page has-sidebar'><article><p>{PROSE}</p><div class='{name}'><p>{text}</p></div><p>{PROSE}</p></article></body>"
    for name in ("comment-body", "cookie-text", "ad-content", "footer-text", "comment-list-body", "notice-text", "main-nav", "newsletter"):
        assert html_text.main_text(page(name, "Nice post!")) == f"{PROSE}\n{PROSE}", name
    for name in ("entry-content", "body-text", "content-with-sidebar", "no-comments", "caption"):
        assert html_text.main_text(page(name, "Nice post!")) == f"{PROSE}\nNice post!\n{PROSE}", name
    assert html_text.main_text(page("post-notice", PROSE + " " + PROSE)) == f"{PROSE}\n{PROSE} {PROSE}\n{PROSE}"


def brute_label(block, stops):
    """Both passes as the module's head tells them, for blocks (text, linked characters, heading) outside of regions."""
    words = [re.sub(r"^[\W\d_]+|[\W\d_]+$", "", w) for w in block[0].lower().split() if re.search(r"\w", w)]
    share, size, link = sum(w in stops for w in words) / max(1, len(words)), len(block[0]), block[1]
    if link > size / 2:
        return "unsure" if block[2] else "bad"
    if size < 70:
        return "bad" if link and not block[2] else "unsure"
    if share >= 0.3 or share >= 0.2 and size > 200:
        return "good"
    return "unsure" if share >= 0.2 else "open" if link <= 0.2 * size else "bad"


def test_both_passes_equal_brute_force():
    rnd = random.Random(12)
    content, function = "harbour signal mountain copper river garden window yellow".split(), "the of and to in is that it".split()
    decided = 0
    for _ in range(200):
        made, html = [], []
        for _ in range(rnd.randrange(1, 12)):
            share, n, tag = rnd.choice([0.0, 0.22, 0.6]), rnd.choice([3, 8, 20, 60]), rnd.choice(["p", "p", "p", "h2"])
            words = [rnd.choice(function if rnd.random() < share else content) for _ in range(n)]
            cut = rnd.choice([0, 0, 0, n // 4, n])
            linked = " ".join(words[:cut])
            made.append([" ".join(words), len(linked), tag == "h2"])
            html.append(f"<{tag}>" + (f"<a href='/x'>{linked}</a> " if cut else "") + " ".join(words[cut:]) + f"</{tag}>")
        labels = [brute_label(b, html_text.STOPS) for b in made]
        size = {k: sum(len(b[0]) for b, x in zip(made, labels) if x == k) for k in ("good", "open")}
        labels = [("good" if size["open"] > size["good"] else "unsure") if x == "open" else x for x in labels]
        sure = [i for i, x in enumerate(labels) if x != "unsure"]
        kept = []
        for i, (b, x) in enumerate(zip(made, labels)):
            later = [j for j in sure if j > i]
            nearest = [j for j in sure if abs(j - i) == min(abs(k - i) for k in sure)]
            if x == "unsure" and b[2] and later:
                nearest = later[:1]
            good = x == "good" if x != "unsure" else any(labels[j] == "good" for j in nearest) if sure else len(b[0]) >= 70
            decided += x == "unsure" and bool(sure)
            kept += [b[0]] if good else []
        assert html_text.main_text("<body>" + "".join(html) + "</body>") == "\n".join(kept)
    assert decided > 200


def test_both_passes_equal_brute_force_inside_of_regions():
    """Blocks of an article: link-dense list items are bad, link-dense paragraphs and short blocks ask their neighbours."""
    rnd = random.Random(14)
    content, function = "harbour signal mountain copper river garden window yellow".split(), "the of and to in is that it".split()
    fates = {"+": 0, "-": 0, "bad": 0, "good": 0}
    for _ in range(200):
        made, html = [], []
        for _ in range(rnd.randrange(1, 12)):
            share, n, tag = rnd.choice([0.0, 0.22, 0.6]), rnd.choice([3, 8, 20, 60]), rnd.choice(["p", "p", "p", "h2", "li", "li"])
            words = [rnd.choice(function if rnd.random() < share else content) for _ in range(n)]
            cut = rnd.choice([0, 0, n // 4, n // 2 + 2, n])
            linked = " ".join(words[:cut])
            made.append((" ".join(words), len(linked), tag))
            inner = f"<{tag}>" + (f"<a href='/x'>{linked}</a> " if cut else "") + " ".join(words[cut:]) + f"</{tag}>"
            html.append(f"<ul>{inner}</ul>" if tag == "li" else inner)

        def by_itself(text, link, tag):
            words = [re.sub(r"^[\W\d_]+|[\W\d_]+$", "", w) for w in text.split()]
            stops = sum(w in html_text.STOPS for w in words) / len(words)
            if link > len(text) / 2:
                return "bad" if tag == "li" else "unsure"
            return "unsure" if len(text) < 70 or stops < 0.2 and link > 0.2 * len(text) else "good"

        labels = [by_itself(*b) for b in made]
        sure = [i for i, x in enumerate(labels) if x != "unsure"]
        kept = []
        for i, (b, x) in enumerate(zip(made, labels)):
            nearest = [j for j in sure if abs(j - i) == min(abs(k - i) for k in sure)]
            if x == "unsure" and b[2] == "h2" and [j for j in sure if j > i]:
                nearest = [j for j in sure if j > i][:1]
            fate = x if x != "unsure" else "+" if not sure or any(labels[j] == "good" for j in nearest) else "-"
            fates[fate] += 1
            kept += [b[0]] if fate in ("good", "+") else []
        assert html_text.main_text("<body><article>" + "".join(html) + "</article></body>") == "\n".join(kept)
    assert min(fates.values()) > 50, fates


def test_departures_of_tags_and_names():
    page = lambda inner: html_text.main_text(f"<body><article><p>{PROSE}</p>{inner}<p>{PROSE}</p></article></body>")
    kept = lambda *more: "\n".join([PROSE, *more, PROSE])
    assert page(f'<ul><li class="advert"><ul><li>{PROSE}</li><li>{PROSE}</li></ul></li><li>{PROSE} Two.</li></ul>') == kept(f"{PROSE} Two.")
    assert page(f'<table><tr><td class="sidebar"><table><tr><td>{PROSE}</td></tr></table></td><td>{PROSE} In.</td></tr></table>') == kept(f"{PROSE} In.")
    assert page(f"<ul><li>{PROSE} One.<li>{PROSE} Two.</ul>") == kept(f"{PROSE} One.", f"{PROSE} Two.")
    assert page("<script src='x'/>var a = 1;</script>") == page("<style/>p { }</style>") == kept()
    for name in ("commentBody", "comment-body", "userComments", "AdBox", "ad_box"):
        assert page(f"<div class='{name}'><p>{PROSE}</p></div>") == kept(), name
    assert page(f"<p class='page-share-story'>{PROSE} Mine.</p>") == kept(f"{PROSE} Mine.")
    assert page("<div class='page-share-story'>Share this</div>") == page("<div class='share'>Share</div>") == kept()
    assert page(f"<p>See <a href='/x'>{PROSE}</a></p>") == kept(f"See {PROSE}")
    filler = " ".join(f'data-x{i}="{i}"' for i in range(400))
    assert html_text.language_of(f"<!doctype html><html {filler} lang='pl-PL'><body>") == "pl"


def test_stop_words_come_from_a_bounded_sample(spark, monkeypatch):
    monkeypatch.setattr(html_text, "SAMPLE_PAGES", 20)
    seen, learn = [], html_text.learn
    monkeypatch.setattr(html_text, "learn", lambda pages: seen.append(pages.count()) or learn(pages))
    pages = spark.createDataFrame([(i, f"u{i}", PAGE) for i in range(400)], "page_id long, url string, html string")
    assert {r["text"] for r in html_text.extract(pages).collect()} == {"Title & more\nFirst bold words here\nLes.\nLast"}
    assert 2 <= seen[0] <= 60


def test_stop_words_come_from_all_pages(spark):
    """Ten pages in 6,000 are in a language of their own, whose words only all ten together make known."""
    menu = "".join(f'<li><a href="/{i}">Page number {i}</a></li>' for i in range(4))
    rnd = random.Random(8)
    long = lambda: "".join(rnd.choices("aeioklmnrst", k=9))
    text = lambda: " ".join(rnd.choice(("zu", "ke", "mo")) if rnd.random() < 0.5 else long() for _ in range(60))
    bare = [" ".join(long() for _ in range(12)) for _ in range(2)]  # the first of them goes where the language is known
    page = lambda *texts: f'<html lang="xq"><body><ul>{menu}</ul><div>{"".join(f"<p>{t}</p>" for t in texts)}</div></body></html>'
    rare = [[*bare, text(), text()] for _ in range(10)]
    others = [f"<html lang='en'><body><p>{i}</p></body></html>" for i in range(5_990)]
    pages = spark.createDataFrame([(i, f"u{i}", h) for i, h in enumerate([page(*texts) for texts in rare] + others)], "page_id long, url string, html string")
    assert html_text.learn(pages) == {"xq": {"zu", "ke", "mo"}}
    assert html_text.main_text(page(*rare[0])) == "\n".join(rare[0])
    found = {r["page_id"]: r["text"] for r in html_text.extract(pages).where("page_id < 10").collect()}
    assert found == {i: "\n".join(texts[1:]) for i, texts in enumerate(rare)}


def test_blocks_are_labelled_as_on_their_page(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    learnt = {k: v | html_text.STOPS for k, v in html_text.learn(pages).items()}
    expected = {r["page_id"]: html_text.main_text(r["html"], learnt) for r in pages.collect()}
    assert {r["page_id"]: r["text"] for r in html_text.extract(pages).collect()} == expected


def test_pages_empty_clashing_and_null(spark):
    schema = "page_id long, url string, html string, text string, n_chars string, language string"
    pages = spark.createDataFrame([(1, "u", PAGE, "x", "y", "z"), (None, None, None, None, None, None)], schema)
    assert sorted(r["text"] for r in html_text.extract(pages).collect()) == ["", "Title & more\nFirst bold words here\nLes.\nLast"]
    assert html_text.extract(pages.limit(0)).count() == 0
