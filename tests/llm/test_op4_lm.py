import math
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from hexloom.llm import lm
from hexloom.llm import textvec as tv
from tests.llm.common import LOWER, WORD, empty, frame, rows


class Plain:
    """The same model with dictionaries, from its definition."""

    def __init__(self, texts, order):
        self.order, self.n, self.v = order, sum(map(len, texts)), len({w for t in texts for w in t})
        self.words = Counter(w for t in texts for w in t)
        grams = {1: Counter((w,) for t in texts for w in t)}
        for k in range(2, order + 1):
            grams[k] = Counter(tuple(["<s>", *t][i : i + k]) for t in texts for i in range(len(t) + 2 - k))
        ends = {k: Counter(g[1:] for g in grams[k + 1]) for k in range(1, order)}
        self.adjusted = {k: ({g: n if g[0] == "<s>" else ends[k][g] for g, n in grams[k].items()} if k < order else grams[k]) for k in grams}
        few = lambda c: [sum(x == i for x in c.values()) for i in range(1, 5)]
        self.d = {k: lm.discounts(few(ends[k] if k < order else grams[k])) for k in grams}
        self.follow = defaultdict(list)
        for k in range(2, order + 1):
            for g, n in self.adjusted[k].items():
                self.follow[g[:-1]].append(n)

        self.rests = {}

    def rest(self, context):
        """Sum of the counts after a context, and of what the discounts take from them."""
        if context not in self.rests:
            d, every = self.d[len(context) + 1], self.follow[context] if context else list(self.adjusted[1].values())
            self.rests[context] = sum(every), sum(d[min(x, 3) - 1] for x in every)
        return self.rests[context]

    def p(self, context, w):
        k, d = len(context) + 1, self.d[len(context) + 1]
        c = self.adjusted[k].get((*context, w), 0)
        total, rest = self.rest(context)
        if not total:
            return self.p(context[1:], w)
        return (max(c - d[min(c, 3) - 1], 0) / total if c else 0) + rest / total * (self.p(context[1:], w) if context else 1 / (self.v + 1))

    def contexts(self, t):
        t = ["<s>", *t]
        return [(tuple(t[max(i - self.order + 1, 0) : i]), t[i]) for i in range(1, len(t))]


def toks(t):
    return [*WORD.findall((t or "").translate(LOWER)), "</s>"]


@pytest.mark.parametrize("part, order", [(1 << 20, 2), (64, 2), (64, 3), (1 << 20, 4)])
def test_against_dictionaries(spark, monkeypatch, part, order):
    monkeypatch.setattr(lm, "PART", part)
    monkeypatch.setattr(lm, "HELD", 5 * part)
    train, rest = rows(3, 40), rows(4, 30)
    model = lm.train(frame(spark, train, extra=True), order=order)
    plain = Plain([toks(t) for _, t in train], order)
    assert (model.n_tokens, model.vocabulary) == (plain.n, plain.v)
    for context in sorted({c for _, t in train[:12] for c, _ in plain.contexts(toks(t))})[::40]:
        assert math.isclose(sum(plain.p(context, w) for w in plain.words) + plain.p(context, "never seen"), 1, rel_tol=1e-9)
    data = rest + [(900, train[0][1]), (901, train[1][1]), (900, train[0][1])]
    got = Counter((r.doc_id, r.n_tokens, r.n_known, round(r.score, 6), round(r.base_score, 6)) for r in lm.score(frame(spark, data, extra=True), model).collect())
    want = Counter()
    for k, t in data:
        w = toks(t)
        base = sum(math.log10((plain.words[x] + 0.5) / (plain.n + 0.5 * (plain.v + 1))) for x in w)
        want[k, len(w), sum(x in plain.words for x in w), round(sum(math.log10(plain.p(c, x)) for c, x in plain.contexts(w)), 6), round(base, 6)] += 1
    assert {x[:3] for x in got} == {x[:3] for x in want}
    for x, y in zip(sorted(got.elements(), key=str), sorted(want.elements(), key=str)):
        assert x[:3] == y[:3] and math.isclose(x[3], y[3], abs_tol=2e-5, rel_tol=1e-6) and math.isclose(x[4], y[4], abs_tol=2e-5, rel_tol=1e-6)


def test_counts_beyond_32_bits():
    batches = [lm.Ranges(0).blobs(np.array([5, 9], np.uint64), np.array([2**33, 1]), None), lm.Ranges(0).blobs(np.array([5], np.uint64), np.array([2**33]), None)]
    (_, _, keys, counts, more), = lm._merged(batches)
    assert keys.tolist() == [5, 9] and counts.tolist() == [2**34, 1] and more is None


def test_limits(spark):
    with pytest.raises(ValueError):
        lm.train(frame(spark), order=1)
    long = "alpha beta gamma " * 80_000
    model = lm.train(frame(spark, [(1, long), (None, None), (2, "")], extra=True))
    got = {r.doc_id: r for r in lm.score(frame(spark, [(1, long), (None, None)], extra=True), model).collect()}
    assert got[1].n_tokens == 240_001 == got[1].n_known and got[None].n_tokens == 1


def test_empty(spark):
    model = lm.train(empty(spark))
    r = lm.score(frame(spark, [(1, "a b"), (2, None)]), model).orderBy("doc_id").collect()
    assert [(x.n_tokens, x.n_known, x.score) for x in r] == [(3, 0, 0.0), (1, 0, 0.0)]
    assert lm.score(empty(spark), model).count() == 0


def test_tokens():
    h, b = lm.token_hashes(*tv.flat(pa.array(["a b", None, "A"])))
    assert b.tolist() == [0, 3, 4, 6] and (h[[2, 3, 5]] == lm.END).all() and h[0] == h[4]
    assert lm._unmix(tv.mix(np.arange(99, dtype=np.uint64))).tolist() == list(range(99))
