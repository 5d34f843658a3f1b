"""Personal data by patterns and a skip-chain conditional random field.

The patterns give the base spans. The field labels the other tokens that have a digit or an
at sign (any other token is certainly no personal data, so the chain falls apart at it):
- a token's potential is the sum of the weights of its features for each label;
- tokens that stand side by side share a potential of their two labels;
- skip edges tie a token to the previous one and to the first one of the same or a similar
  form in the document, however far off, with weights for equal labels, one of all edges and
  one of the kind of edge: equal letters and digits, the same last seven digits, the same name
  before an at sign, the same first three numbers of four.
Base tokens are fixed to their labels. Loopy message passing then gives each other token its
posterior; those over SURE become further spans. Edges grow with the tokens, not with the
size of a group of alike ones.

All weights are fitted together by pseudo-likelihood: each token's label given its features
and its neighbours' labels, over all documents, with the base spans' labels. A token without
a label that has a skip neighbour with one is left out, and so are its edges, because whether it
is personal data is what the field has to tell. Tokens with skip neighbours count a second time with their own
features hidden, so that the edges learn to speak for forms that no pattern knows. Documents
are read once into a table of counted examples, over which the rounds of the fit run; what
comes to the driver in a round is as large as the weights.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents, slices, stored

KINDS = ("email", "ip", "card", "phone")
LABELS = ("", *KINDS)
BUCKETS = 4096  # of hashed features
SURE = 0.6
ROUNDS = 12  # of message passing
FIT_ROUNDS = 40
CONVERGED = 0.02  # a fit ends when no weight moves by more
PRIOR = 0.1  # precision of the weights' normal prior
ACTIVE = 8  # weights that a token's score adds up, about: bounds the curvature in a step of the fit
HELD = 50_000  # distinct examples a task counts before it hands them on
FIXED = 30.0
EDGE_KINDS = ("form", "digits", "local", "network", "any")  # the last stands for all edges
ANY = len(EDGE_KINDS) - 1

# The base patterns, given with the task; forms that can't backtrack over long runs.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
TOKEN = re.compile(r"\S+")
MARK = re.compile("[0-9@]")
BEFORE, AFTER = "\"')[]{}<>.,;:!?*#$%&|=`~", "\"'([]{}<>.,;:!?*#$%&|=`~"


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at) if start < at else None
        if found:
            done = found.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind's place, start, end), by kind, then start."""
    out = [(0, a, b) for a, b in emails(text)]
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m.groups()):
            out.append((1, m.start(), m.end()))
    for m in CARD.finditer(text):
        digits = re.sub("[^0-9]", "", m[0])
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append((2, m.start(), m.end()))
    for m in PHONE.finditer(text):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append((3, m.start(), m.end()))
    return out


def marked_tokens(text: str) -> list[tuple[int, int, int]]:
    """(number among all tokens, start, end) of those with a digit or an at sign, without punctuation at their ends."""
    out = []
    for i, m in enumerate(TOKEN.finditer(text)):
        if MARK.search(m[0]):
            word = m[0]
            start = m.start() + len(word) - len(word.lstrip(BEFORE))
            end = m.end() - (len(word) - len(word.rstrip(AFTER)))
            if start < end:
                out.append((i, start, end))
    return out


def features(text: str, tokens: list[tuple[int, int, int]]) -> list[list[int]]:
    shapes = []
    for _, a, b in tokens:
        word = text[a:b]
        exact = re.sub("[A-Za-z]+", "a", re.sub("[0-9]", "9", word))
        rough = re.sub("9+", "9", exact)
        shapes.append((exact, rough, min(24, sum(c.isdigit() for c in word)), sum_of(word)))
    out = []
    for i, (exact, rough, digits, check) in enumerate(shapes):
        beside = i and tokens[i - 1][0] == tokens[i][0] - 1
        after = i + 1 < len(tokens) and tokens[i + 1][0] == tokens[i][0] + 1
        names = [f"c{check}", f"e{exact}", f"r{rough}", f"d{digits}", f"p{shapes[i - 1][1] if beside else ''}", f"n{shapes[i + 1][1] if after else ''}"]
        out.append([hash_name(n) for n in names])
    return out


def sum_of(word: str) -> str:
    """What the checks of the base patterns say of a token: a card's check digit, an address's parts."""
    digits = re.sub("[^0-9]", "", word)
    if "@" not in word and re.fullmatch(r"[0-9]+(?:\.[0-9]+){3}", word):
        return "parts" if all(is_part(p) for p in word.split(".")) else "no parts"
    if 13 <= len(digits) <= 19 and re.fullmatch("[0-9-]+", word):
        return "digit" if luhn(digits) else "no digit"
    return ""


def is_part(digits: str) -> bool:
    """At most 255, however many digits."""
    rest = digits.lstrip("0")
    return len(rest) < 3 or len(rest) == 3 and rest <= "255"


def hash_name(name: str) -> int:
    return zlib.crc32(name.encode("utf-8", "surrogatepass")) % BUCKETS


def base_labels(tokens: list[tuple[int, int, int]], spans: list[tuple[int, int, int]]) -> np.ndarray:
    """The label that a base span gives to each token that it overlaps; 0 without one."""
    labels = np.zeros(len(tokens), np.int64)
    starts = np.array([t[1] for t in tokens])
    ends = np.array([t[2] for t in tokens])
    for kind, a, b in spans:
        labels[np.searchsorted(ends, a, "right") : np.searchsorted(starts, b, "left")] = kind + 1
    return labels


EXAMPLE = "own array<int>, prior int, next int, skips array<int>, label int, n long"


def examples(text: str) -> Iterator[tuple]:
    """For each token of which the label is known: its features, the labels before and after it (-1 if none
    is known), how often each label stands at the other ends of each kind of skip edge, and its label."""
    tokens = marked_tokens(text)
    labels = base_labels(tokens, base_spans(text)).tolist()
    ends: dict[int, Counter[tuple[int, int]]] = {}
    edges = skip_edges(text, tokens)
    for i in {k for i, j, _ in edges if bool(labels[i]) != bool(labels[j]) for k in (i, j) if not labels[k]}:
        labels[i] = -1
    for i, j, kind in edges:
        if labels[i] >= 0 and labels[j] >= 0:
            ends.setdefault(i, Counter())[kind, labels[j]] += 1
            ends.setdefault(j, Counter())[kind, labels[i]] += 1
    for i, (own, y) in enumerate(zip(features(text, tokens), labels)):
        if y < 0:
            continue
        found = ends.get(i, {})
        prior = labels[i - 1] if i and tokens[i - 1][0] == tokens[i][0] - 1 else -1
        after = labels[i + 1] if i + 1 < len(tokens) and tokens[i + 1][0] == tokens[i][0] + 1 else -1
        skips = tuple(x for (kind, label), n in sorted(found.items()) for x in (kind, label, n))
        yield tuple(own), prior, after, skips, y
        if skips:
            yield (), prior, after, skips, y


def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    def rows() -> pd.DataFrame:
        return pd.DataFrame([(list(k[0]), k[1], k[2], list(k[3]), k[4], n) for k, n in sums.items()], columns=["own", "prior", "next", "skips", "label", "n"])

    sums: Counter[tuple] = Counter()
    for batch in batches:
        for text in batch["text"]:
            sums.update(examples(text))
            if len(sums) > HELD:
                yield rows()
                sums.clear()
    if sums:
        yield rows()


class Field:
    """Weights: `unary` (feature and, last, a constant; label), `pair` (label, label), `skip` (kind of edge, label)."""

    def __init__(self):
        size = len(LABELS)
        self.unary, self.pair, self.skip = np.zeros((BUCKETS + 1, size)), np.zeros((size, size)), np.zeros((len(EDGE_KINDS), size))

    def flat(self) -> np.ndarray:
        return np.concatenate([self.unary.ravel(), self.pair.ravel(), self.skip.ravel()])

    def set(self, flat: np.ndarray) -> None:
        a, b = self.unary.size, self.unary.size + self.pair.size
        self.unary, self.pair, self.skip = flat[:a].reshape(self.unary.shape), flat[a:b].reshape(self.pair.shape), flat[b:].reshape(self.skip.shape)

    def gradient(self, batch: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
        """Of the log pseudo-likelihood of counted examples, and how much each weight takes part in it (squared)."""
        size, rows = len(LABELS), len(batch)
        n, y = batch["n"].to_numpy(np.float64), batch["label"].to_numpy()
        lengths = batch["own"].map(len).to_numpy()
        row = np.concatenate([np.repeat(np.arange(rows), lengths), np.arange(rows)])
        column = np.concatenate([*batch["own"], np.full(rows, BUCKETS)]).astype(np.int64)
        prior, after = batch["prior"].to_numpy(), batch["next"].to_numpy()
        skips = np.zeros((rows, *self.skip.shape))
        for i, found in enumerate(batch["skips"]):
            for kind, label, times in np.asarray(found).reshape(-1, 3):
                skips[i, kind, label] += times
                skips[i, ANY, label] += times
        score = np.einsum("rkl,kl->rl", skips, self.skip)
        np.add.at(score, row, self.unary[column])
        has, follows = prior >= 0, after >= 0
        score[has] += self.pair[prior[has]]
        score[follows] += self.pair[:, after[follows]].T
        score = np.exp(score - score.max(axis=1, keepdims=True))
        rest = -score / score.sum(axis=1, keepdims=True)
        rest[np.arange(rows), y] += 1
        rest *= n[:, None]
        slope, share = Field(), Field()
        np.add.at(slope.unary, column, rest[row])
        np.add.at(share.unary, column, np.repeat(n[row][:, None], size, 1))
        np.add.at(slope.pair, prior[has], rest[has])
        np.add.at(slope.pair.T, after[follows], rest[follows])
        np.add.at(share.pair, prior[has], np.repeat(n[has][:, None], size, 1))
        np.add.at(share.pair.T, after[follows], np.repeat(n[follows][:, None], size, 1))
        slope.skip = np.einsum("rkl,rl->kl", skips, rest)
        share.skip = np.einsum("rkl,r->kl", skips**2, n)
        return slope.flat(), share.flat()

    def posteriors(self, unary: np.ndarray, edges: np.ndarray, skips: np.ndarray) -> np.ndarray:
        """Beliefs after loopy sum-product; edges: (n, 2) of neighbours in order; skips: (n, 3), the last the kind."""
        pairs = np.concatenate([edges, skips[:, :2]])
        if len(pairs):
            equal = np.eye(unary.shape[1])[None] * (self.skip[skips[:, 2]] + self.skip[ANY])[:, :, None]
            tables = np.concatenate([np.repeat(self.pair[None], len(edges), 0), equal])
            source = np.concatenate([pairs[:, 0], pairs[:, 1]])
            target = np.concatenate([pairs[:, 1], pairs[:, 0]])
            tables = np.exp(np.concatenate([tables, tables.transpose(0, 2, 1)]))
            back = np.concatenate([np.arange(len(pairs)) + len(pairs), np.arange(len(pairs))])
            messages = np.zeros((len(source), unary.shape[1]))
            for _ in range(ROUNDS):
                belief = unary.copy()
                np.add.at(belief, target, messages)
                cavity = belief[source] - messages[back]
                cavity -= cavity.max(axis=1, keepdims=True)
                fresh = np.log(np.einsum("ei,eij->ej", np.exp(cavity), tables) + 1e-300)
                fresh -= fresh.max(axis=1, keepdims=True)
                change = np.abs(fresh - messages).max()
                messages = 0.5 * messages + 0.5 * fresh
                if change < 1e-3:
                    break
            belief = unary.copy()
            np.add.at(belief, target, messages)
        else:
            belief = unary.copy()
        belief = np.exp(belief - belief.max(axis=1, keepdims=True))
        return belief / belief.sum(axis=1, keepdims=True)

    def more_spans(self, text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
        tokens = marked_tokens(text)
        if not tokens:
            return []
        fixed = base_labels(tokens, base)
        unary = np.array([self.unary[f].sum(axis=0) for f in features(text, tokens)]) + self.unary[BUCKETS]
        taken = np.flatnonzero(fixed)
        unary[taken] = -FIXED
        unary[taken, fixed[taken]] = 0.0
        number = np.array([t[0] for t in tokens])
        left = np.flatnonzero(np.diff(number) == 1)
        edges = np.stack([left, left + 1], axis=1) if len(left) else np.zeros((0, 2), np.int64)
        skips = np.array(skip_edges(text, tokens), dtype=np.int64).reshape(-1, 3)
        belief = self.posteriors(unary, edges, skips)
        best = belief.argmax(axis=1)
        chosen = np.flatnonzero((best > 0) & (fixed == 0) & (belief.max(axis=1) >= SURE))
        out: list[tuple[int, int, int]] = []
        last = -2
        for i in chosen.tolist():
            kind, a, b = int(best[i]) - 1, tokens[i][1], tokens[i][2]
            if out and last == i - 1 and out[-1][0] == kind and tokens[i - 1][0] == tokens[i][0] - 1 and kind == 3:
                out[-1] = (kind, out[-1][1], b)
            else:
                out.append((kind, a, b))
            last = i
        return out


def skip_edges(text: str, tokens: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(earlier, later, kind): each token with the previous and with the first of the same key. Two tokens that
    agree in several ways are tied once, by the first kind."""
    edges: dict[tuple[int, int], int] = {}
    first: dict[tuple[int, str], int] = {}
    previous: dict[tuple[int, str], int] = {}
    for i, (_, a, b) in enumerate(tokens):
        for key in similar(text[a:b].lower()):
            if key in previous:
                for j in (previous[key], first[key]):
                    edges[j, i] = min(key[0], edges.get((j, i), key[0]))
            first.setdefault(key, i)
            previous[key] = i
    return sorted((i, j, kind) for (i, j), kind in edges.items())


def similar(word: str) -> list[tuple[int, str]]:
    """The keys, by kind of edge, that a token shares with similar ones."""
    plain = re.sub("[^0-9a-z@]", "", word)
    digits = re.sub("[^0-9]", "", plain)
    keys = [(0, plain)]
    if len(digits) >= 7 and "@" not in word:
        keys.append((1, digits[-7:]))
    local, at, _ = word.partition("@")
    if at and re.search("[a-z]", local):
        keys.append((2, local))
    numbers = word.split(".")
    if len(numbers) in (3, 4) and all(x.isascii() and x.isdigit() for x in numbers):
        keys.append((3, ".".join(numbers[:3])))
    return keys


def learn(docs: DataFrame) -> Field:
    """Weights from all documents."""
    texts = docs.select(F.col("text").cast("string").alias("text")).where(F.col("text").rlike("[0-9@]"))
    key = ["own", "prior", "next", "skips", "label"]
    table = stored(texts.mapInPandas(counted, EXAMPLE).groupBy(*key).agg(F.sum("n").alias("n")), "pii-examples")
    field, before = Field(), 0.0
    for k in range(FIT_ROUNDS):  # each from a point ahead in the last round's direction
        now = field.flat() + k / (k + 3) * (field.flat() - before)
        before = field.flat()

        def run(batches: Iterator[pd.DataFrame], now: np.ndarray = now) -> Iterator[pd.DataFrame]:
            own = Field()
            own.set(now)
            total = np.zeros((2, len(now)))
            for batch in batches:
                if len(batch):
                    total += own.gradient(batch)
            place = np.flatnonzero(total[1])
            yield pd.DataFrame({"place": place, "slope": total[0, place], "share": total[1, place]})

        summed = table.mapInPandas(run, "place int, slope double, share double").groupBy("place").agg(F.sum("slope"), F.sum("share"))
        found = np.array([tuple(r) for r in summed.collect()], np.float64).reshape(-1, 3)  # at most as many rows as weights
        place = found[:, 0].astype(np.int64)
        step = (found[:, 1] - PRIOR * now[place]) / (ACTIVE / 4 * found[:, 2] + PRIOR)
        now[place] += step
        field.set(now)
        if np.abs(step).max(initial=0) < CONVERGED:
            break
    return field


def find_personal_data(docs: DataFrame, field: Field | None = None) -> DataFrame:
    """doc_id, spans: array of (kind, start, end, base) for each row of `docs`, by kind, then start.

    start and end count code points, end exclusive; base tells the patterns' spans from the
    field's. The field is learnt from `docs` unless given. A null text counts as empty, and
    a text without digits and at signs has no spans. Rows are independent: repeated rows and
    null ids don't matter, an empty table gives an empty result, other columns are ignored.
    """
    model = learn(docs) if field is None else field
    kind = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for text in (t for _, part in slices(batch.column(1)) for t in part):
                base = base_spans(text) if text else []
                more = model.more_spans(text, base) if text else []
                spans = sorted([(*s, True) for s in base] + [(*s, False) for s in more])
                found.append([{"kind": KINDS[k], "start": a, "end": b, "base": is_base} for k, a, b, is_base in spans])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(kind))], ["doc_id", "spans"])

    text = F.when(F.col("text").rlike("[0-9@]"), F.col("text").cast("string"))  # no other text can have a span
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    return own.mapInArrow(run, "doc_id long, spans array<struct<kind:string,start:long,end:long,base:boolean>>")


def op2_pii(spark, sf_dir: str) -> DataFrame:
    found = find_personal_data(documents(spark, sf_dir))
    base = F.filter("spans", lambda s: s["base"])
    line = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    kinds = F.transform(base, lambda s: s["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in KINDS]
    return found.select("doc_id", *counts, F.sha2(line(base), 256).alias("base_sha256"), line(F.col("spans")).alias("spans"))
