"""The language model against a plain version with dictionaries of strings."""

from __future__ import annotations

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from linfold.llm import op11_lm as op
from linfold.llm.labels import fold
from tests.llm import brute

UPPER = {c: c + 32 for c in range(65, 91)}


def tokens(text):
    return [*brute.words((text or "").translate(UPPER)), None]   # None: the end


def discounts(counts):
    n = [sum(1 for c in counts if c == i) for i in range(1, 5)]
    y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0
    out = []
    for i in (1, 2, 3):
        d = i - (i + 1) * y * n[i] / n[i - 1] if n[i - 1] else 0
        out.append(d if 0 < d < i else i / 2)
    return lambda c: 0 if c == 0 else out[min(c, 3) - 1]


class Plain:
    def __init__(self, texts):
        self.single, self.pairs = Counter(), Counter()
        for text in texts:
            w = tokens(text)
            self.single.update(w)
            self.pairs.update(zip(["<s>", *w], w, strict=False))
        self.after, before = defaultdict(dict), defaultdict(set)
        for (h, w), c in self.pairs.items():
            self.after[h][w] = c
            before[w].add(h)
        self.kinds = {w: len(h) for w, h in before.items()}
        self.d, self.e = discounts(self.pairs.values()), discounts(self.kinds.values())
        self.n, self.v, self.k = self.single.total(), len(self.single), sum(self.kinds.values())

    def p1(self, w):
        if not self.k:
            return 1.0
        k = self.kinds.get(w, 0)
        delta = sum(self.e(c) for c in self.kinds.values()) / self.k
        return max(k - self.e(k), 0) / self.k + delta / (self.v + 1)

    def p(self, h, w):
        follow = self.after.get(h)
        if not follow:
            return self.p1(w)
        total, c = sum(follow.values()), follow.get(w, 0)
        return max(c - self.d(c), 0) / total + sum(map(self.d, follow.values())) / total * self.p1(w)

    def row(self, text):
        w = tokens(text)
        base = sum(math.log10((self.single[x] + 0.5) / (self.n + 0.5 * (self.v + 1))) for x in w)
        score = sum(math.log10(self.p(h, x)) for h, x in zip(["<s>", *w], w, strict=False))
        return len(w), sum(self.single[x] > 0 for x in w), self.n, base, score


def held(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1


def compare(spark, rows):
    got = sorted((tuple(r)[:7] for r in op.scored(brute.table(spark, rows), fold(5) == 1).collect()),
                 key=lambda r: (r[0] is None, r[0] or 0, r[6]))
    plain = Plain([t for i, t in rows if not held(i)])
    cache = {t: plain.row(t) for t in {t for _, t in rows}}
    want = sorted(((i, held(i), *cache[t]) for i, t in rows), key=lambda r: (r[0] is None, r[0] or 0, r[6]))
    assert len(got) == len(want)
    for g, w in zip(got, want, strict=True):
        assert g[:5] == w[:5]
        assert g[5:] == pytest.approx(w[5:], rel=1e-9, abs=1e-9)


def test_whole_table(spark):
    compare(spark, brute.corpus(120, seed=9))


def test_odd_tables(spark, monkeypatch):
    monkeypatch.setattr(op, "SCORE_TOKENS", 50)
    compare(spark, [(i, t) for i, t in enumerate([None, "", " \t", "A a a b", "é É Z z", "a\x85b c", "x " * 700, "a a a b c d"] * 3)])
    compare(spark, [(None, "a b"), (None, None), (5, "a b c"), (5, "a b c"), (7, "zz")])
    compare(spark, [(i, "only held out") for i in range(60) if held(i)])
    assert op.scored(brute.table(spark, []), fold(5) == 1).count() == 0
    extra = brute.table(spark, [(2, "a b"), (3, "b a")]).withColumn("part", F.lit("x")).withColumn("score", F.lit(1))
    assert op.scored(extra, fold(5) == 1).count() == 2


def test_long_texts(spark):
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(400)]
    long = " ".join(words[i] for i in rng.zipf(1.3, 400_000) % 400)
    compare(spark, [(2, long), (3, "w1 w2 w3"), (6, "w" * 3_000_000 + " w1"), (20, long[:1_500_000]), (11, "w1")])


def test_probabilities_sum_to_one(spark):
    rows = brute.corpus(40, seed=2)
    model = op.fit(brute.table(spark, rows))
    plain = Plain([t for _, t in rows])
    vocabulary = [w for w in plain.single if w is not None]
    batch = brute.table(spark, [(0, " ".join(vocabulary))]).select("doc_id", "text").toArrow().to_batches()
    _, hashes, *_ = next(op.tokens(iter(batch), 1 << 26))
    unknown = np.append(hashes, np.uint64(12345))
    for h in [op.START, hashes[0], hashes[5], np.uint64(99)]:
        p, count = model.probabilities(np.full(len(unknown), h), unknown)
        assert p.sum() == pytest.approx(1, abs=1e-9) and (p > 0).all()
        assert count[-1] == 0 and (count[:-1] > 0).all()


def test_folder_must_be_mounted(spark, monkeypatch):
    monkeypatch.setattr(op, "checkpoint_dir", lambda s: "hdfs://host/x")
    with pytest.raises(ValueError, match="mounted"):
        op.fit(brute.table(spark, [(1, "a")]))
