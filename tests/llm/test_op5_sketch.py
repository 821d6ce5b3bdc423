import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from hexloom.llm import sketch
from hexloom.llm import textvec as tv
from tests.llm.common import WORD, empty, frame, rows


def shingles(t):
    w = WORD.findall(t)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) > 4 else ({tuple(w)} if w else set())


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def kept_of(text, fraction=sketch.FRACTION):
    """What a fingerprint should keep, from shingle hashes worked out one by one."""
    words = tv.Words(*tv.flat(pa.array([text])))
    h = sorted({int(x) for x in words.shingles(5, seed=5)[1]})
    return [x for x in h if x < int(fraction * 2**64)], len(h)


def test_against_whole_sets(spark):
    data = [r for r in rows() if r[0] is not None and r[0] != 3]
    data = sorted({r[0]: r for r in data}.values())
    got = {r.doc_id: r for r in sketch.compare_with_next(frame(spark, data)).collect()}
    assert len(got) == len(data)
    for i, (k, t) in enumerate(data):
        t, f = t or "", data[(i + 1) % len(data)][1] or ""
        m = len(t) // 2
        e = t[: len(t) - m] + f[:m]
        assert (got[k].n_chars, got[k].edited_sha256) == (len(t), hashlib.sha256(e.encode()).hexdigest())
        x, y = sketch.unpack(got[k].fingerprint), sketch.unpack(got[k].edited_fingerprint)
        assert (x.hashes.tolist(), x.n) == kept_of(t) and (y.hashes.tolist(), y.n) == kept_of(e)
        p, q = shingles(t), shingles(e)
        assert x.n == len(p)
        # the kept hashes are a fixed share of each set: the estimate is that of their sets
        u = set(x.hashes.tolist()) | set(y.hashes.tolist())
        c = set(x.hashes.tolist()) & set(y.hashes.tolist())
        want = 1.0 if p == q else min(len(c) / max(len(u), 1), min(len(p), len(q)) / max(len(p), len(q), 1))
        assert got[k].near_edited == want
        if len(p | q) > 100:
            assert abs(got[k].near_edited - jaccard(p, q)) < 0.2 and abs(got[k].near_next - jaccard(p, shingles(f))) < 0.2
    assert got[200].fingerprint == got[0].fingerprint
    assert got[205].fingerprint == got[206].fingerprint and sketch.unpack(got[205].fingerprint).n == 0


def test_ties_nulls_and_empty(spark):
    assert sketch.compare_with_next(frame(spark)).count() == len(rows())
    assert sketch.compare_with_next(empty(spark)).count() == 0
    one = sketch.compare_with_next(frame(spark, [(5, "a b c")])).first()
    assert one.near_next == 1.0
    marked = sketch.fingerprint(frame(spark, extra=True)).collect()
    assert len(marked) == len(rows()) and {r.kept for r in marked} == {"mine"}
    assert len({r.fingerprint for r in marked if r.doc_id == 2}) == 1
    long = sketch.compare_with_next(frame(spark, [(1, "some longer words " * 90_000), (2, "x")], extra=True)).collect()
    assert sorted(r.n_chars for r in long) == [1, 1_620_000]


def test_a_hot_id_fills_several_ranges(spark):
    data = [(7, f"text number {i} of one id") for i in range(300)] + [(None, f"no id {i}") for i in range(300)] + [(i, f"own {i}") for i in range(200)]
    df = frame(spark, data)
    got = sketch.compare_with_next(df)
    parts = sketch.with_next(df, "doc_id", "text", lambda batches: ((b.select(["id"]) for b in batches)), "id long")
    sizes = [r["count"] for r in parts.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 300 and sum(sizes) == 800 + len(sizes)
    got = got.collect()
    assert Counter(r.doc_id for r in got) == Counter(k for k, _ in data)
    # the followers make one ring: every text is the next of one other, in order of the id
    own = [t for k, t in data if k is not None and k > 7]
    want = Counter(hashlib.sha256((t[: len(t) - len(t) // 2] + f[: len(t) // 2]).encode()).hexdigest() for t, f in zip(own, own[1:]))
    edits = Counter(r.edited_sha256 for r in got if r.doc_id is not None and r.doc_id > 7)
    assert sum((edits - want).values()) == 1 and not want - edits


def test_containment_and_merge():
    words = [f"w{i}" for i in range(9000)]
    small, large = " ".join(words[1000:2000]), " ".join(words)

    def of(*texts, fraction=0.25):
        return [sketch.Sketch(h, int(n), int(w), fraction) for h, n, w in zip(*sketch.sketches(*tv.flat(pa.array(texts)), fraction=fraction))]

    a, b = of(small, large)
    assert sketch.containment(a, b) == 1.0
    assert abs(sketch.containment(b, a) - 996 / 8996) < 0.03
    # unlike fractions are compared below the lower one
    c, d = of(large, fraction=0.05)[0], of(small, fraction=0.9)[0]
    assert sketch.containment(d, c) == 1.0 and abs(sketch.likeness(c, d) - 996 / 8996) < 0.06
    x, y, w = of(" ".join(words[:5000]), " ".join(words[4000:]), large)
    both = sketch.unpack(sketch.merge(sketch.pack(x), sketch.pack(y)))
    assert set(both.hashes.tolist()) <= set(w.hashes.tolist()) and abs(both.n - w.n) < 300 and np.isin(both.hashes, w.hashes).all()
    assert sketch.unpack(sketch.pack(a)).whole == a.whole
