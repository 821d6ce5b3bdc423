import math
import random
import zlib
from collections import Counter

import numpy as np

from hexloom.llm import quality
from tests.llm.common import WORD, empty, frame, rows


def corpus():
    r = random.Random(8)
    word = lambda: "".join(r.choice(["an", "th", "on", "der", "ing"]) for _ in range(r.randint(1, 4)))
    good = lambda: "".join(word() + r.choice([" ", " ", " ", ", ", ". "]) for _ in range(r.randint(40, 200)))
    bad = lambda: r.choice([lambda: " ".join([word()] * 80), lambda: " ".join(word().upper() + "!!" for _ in range(70)), lambda: " | ".join(word() for _ in range(80))])()
    return [(i, good() if i % 3 else bad()) for i in range(600)]


def test_held_out(spark):
    data = corpus()
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(600)] + [(5, None), (None, 1), (7, 1), (99999, 0)], "doc_id long, quality int")
    got = quality.classify(frame(spark, data + [(1000, None), (1001, ""), (None, "a b")]), labels).collect()
    assert len(got) == 603 and all(0 <= r.score <= 1 for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got if r.doc_id is not None)
    held = [r for r in got if r.held_out and r.doc_id < 600]
    assert np.mean([r.predicted == (r.doc_id % 3 > 0) for r in held]) > 0.95
    assert all(r.predicted == (r.score >= 0.7) for r in got)


def test_density():
    rng = np.random.default_rng(2)
    d = len(quality.STATISTICS)
    a = rng.normal(size=(2, d, d))
    cov = a @ a.transpose(0, 2, 1) + np.eye(d)
    low = np.linalg.cholesky(cov)
    m = quality.Model(rng.normal(size=(2, d)), np.linalg.inv(low), 2 * np.log(np.diagonal(low, axis1=1, axis2=2)).sum(1), 0.3)
    x = rng.normal(size=(5, d))
    log = [-0.5 * np.einsum("ij,jk,ik->i", x - m.mean[c], np.linalg.inv(cov[c]), x - m.mean[c]) - 0.5 * np.linalg.slogdet(cov[c])[1] for c in (0, 1)]
    assert np.allclose(m.score(x), 1 / (1 + np.exp(-np.clip(quality.TEMPER * (log[1] - log[0]) + 0.3, -50, 50))))


def plain_statistics(t):
    t = t or ""
    w, b = WORD.findall(t), t.encode()
    n = max(len(w), 1)
    three = Counter(zip(w, w[1:], w[2:]))
    hit = {i + j for i in range(len(w) - 2) if three[w[i], w[i + 1], w[i + 2]] > 1 for j in range(3)}
    seen, dup = set(), 0
    for line in t.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    solid = sum(map(len, w))
    black, lines = max(solid, 1), t.count("\n") + 1
    letters = max(sum(65 <= x <= 90 or 97 <= x <= 122 or x >= 192 for x in b), 1)
    count = lambda chars: sum(c in chars for c in t)
    root = lambda x, of: math.sqrt(x / of)
    return [
        math.log1p(len(w)), math.log1p(solid / n), len(set(w)) / n, root(max(Counter(w).values(), default=0), n), root(len(hit), n), root(dup, lines), math.log1p(len(w) / lines),
        root(sum(65 <= x <= 90 for x in b), letters), root(count("#*$%&<>"), black), root(count("|"), black), root(count("0123456789"), black), root(count(".,;:?"), black), root(count("!"), black), root(sum(ord(c) > 127 for c in t), black),
    ]


def test_statistics_against_plain_counting(spark):
    data = rows() + [(700, "a|b | c\na|b | c\n12 5!! É é x? <#>"), (701, "some longer words " * 90_000)]
    for r in quality.text_statistics(frame(spark, data), keep=("doc_id", "text")).collect():
        assert np.allclose(r.x, plain_statistics(r.text))


def test_fit_against_moments_of_all_rows(spark):
    rng = np.random.default_rng(4)
    d = len(quality.STATISTICS)
    x, y = rng.normal(size=(500, d)) @ rng.normal(size=(d, d)), rng.integers(0, 2, 500)
    model = quality.fit(spark.createDataFrame([(a.tolist(), int(b)) for a, b in zip(x, y)], "x array<double>, quality int").repartition(5))
    cov = [np.cov(x[y == c].T, bias=True) for c in (0, 1)]
    pooled = np.diag(sum((y == c).mean() * np.diag(cov[c]) for c in (0, 1))) + quality.FLOOR * np.eye(d)
    for c in (0, 1):
        want = (1 - quality.SHRINKAGE) * cov[c] + quality.SHRINKAGE * pooled
        assert np.allclose(model.mean[c], x[y == c].mean(0)) and np.allclose(model.logdet[c], np.linalg.slogdet(want)[1])
        assert np.allclose(model.factor[c].T @ model.factor[c], np.linalg.inv(want))
    assert math.isclose(model.prior, math.log(((y == 1).sum() + 1) / ((y == 0).sum() + 1)))


def test_edges(spark):
    labels = spark.createDataFrame([(0, 1), (1, 1)], "doc_id long, quality int")
    assert quality.classify(empty(spark), labels).count() == 0
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in quality.classify(frame(spark), none).collect()} == {0.5}
    assert quality.classify(frame(spark, extra=True), labels).count() == len(rows())
