import os
import random
from collections import Counter

from hexloom.llm import bands
from hexloom.llm.workspace import table
from tests.llm.common import WORD, empty, frame, rows, untouched


def base(t):
    t = t or ""
    w = WORD.findall(t)
    three = Counter(zip(w, w[1:], w[2:]))
    hit = set()
    for i in range(len(w) - 2):
        if three[w[i], w[i + 1], w[i + 2]] > 1:
            hit |= {i, i + 1, i + 2}
    seen, dup = set(), 0
    for line in t.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    n = len(w)
    return n, sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), dup, len(hit), n < 50 or 100 * len(hit) > 50 * n


def test_counts(spark):
    lines = [(900, "a b c\na b c\n\n \na b c\nd"), (901, "x\n" * 60), (902, "a\na")]
    data = rows() + lines
    got = Counter((r.doc_id, *(r[c] for c in bands.COUNTS), r.base_failed) for r in bands.quality_rules(frame(spark, data)).collect())
    assert got == Counter((k, *base(t)) for k, t in data)


def test_bands_against_a_plain_loop(spark):
    import zstandard

    small = lambda b: len(zstandard.ZstdCompressor(level=3).compress(b)) / len(b)
    data = [(i, t) for i, (_, t) in enumerate(rows(n=40))] + [(200 + i, t * 40) for i, (_, t) in enumerate(rows(n=20)) if t] + [(300, " ".join(f"word{i % 900}" for i in range(9000)))]
    for r in bands.quality_rules(frame(spark, data)).collect():
        b = (r.text or "").encode()
        if not b:
            assert (r.share, r.least_share, r.greatest_share, r.kept) == (1, 1, 1, False)
            continue
        whole = small(b)
        top, lo, hi = next(x for x in bands.BANDS if len(b) < x[0])
        ok = lo <= whole <= hi
        if len(b) > 4096:
            cuts = [b[i : i + 4096] for i in range(0, len(b), 4096)]
            cuts[-1] = b[-4096:]
            each = [small(c) for c in cuts]
            ok = ok and min(each) >= bands.CHUNK_BAND[0] and max(each) <= bands.CHUNK_BAND[1]
            assert (r.least_share, r.greatest_share) == (min(each), max(each))
        assert r.share == whole and r.in_bands == ok and r.kept == (ok and not base(r.text)[5])


def test_bands_reject_more_than_the_base_rule(spark):
    """On the test table: what the bands alone reject is labelled bad, and good texts stay."""
    sf = "/root/testdata/sf0.01"
    judged = bands.quality_rules(table(spark, sf, "documents")).join(table(spark, sf, "labels").select("doc_id", "quality"), "doc_id").where("not base_failed")
    n = {(r.quality, r.kept): r["count"] for r in judged.groupBy("quality", "kept").count().collect()}
    assert n.get((0, False), 0) > 0 and n.get((1, False), 0) <= 0.01 * n[1, True]


def test_verdicts(spark):
    r = random.Random(1)
    noise = "".join(chr(r.randrange(33, 127)) + (" " if i % 9 == 8 else "") for i in range(9000))
    prose = [t for k, t in rows() if t and len(WORD.findall(t)) > 60]
    cycle = " ".join(f"w{i % 97}" for i in range(4000))
    hidden = " ".join(prose[:10]) + " " + "q" * 9000
    got = {x.doc_id: x for x in bands.quality_rules(frame(spark, [(0, noise), (1, cycle), (2, hidden), (3, None), (4, os.urandom(3000).hex())] + [(10 + i, t) for i, t in enumerate(prose[:30])])).collect()}
    assert not any(got[i].kept for i in range(5))
    assert got[2].least_share < 0.05
    for i in range(30):
        if not got[10 + i].base_failed and got[10 + i].share > 0.5:
            assert got[10 + i].kept


def test_every_byte_is_in_a_chunk(spark):
    r = random.Random(2)
    words = ["".join(r.choice("etaoinshrdlu") for _ in range(r.randint(2, 9))) for _ in range(500)]
    prose = lambda n: " ".join(r.choice(words) for _ in range(n))[:n]
    noise = lambda n: "".join(chr(r.randrange(33, 127)) + (" " if i % 9 == 8 else "") for i in range(n))[:n]
    data = [(0, prose(8192) + noise(4090)), (1, prose(4000) + noise(4100)), (2, prose(8192) + "q " * 2045), (3, prose(8192 + 4090)), (4, prose(8100)), (5, prose(4097))]
    got = {x.doc_id: x for x in bands.quality_rules(frame(spark, data)).collect()}
    assert [got[i].kept for i in range(6)] == [False, False, False, True, True, True]
    assert got[0].greatest_share > 0.75 > got[0].share and got[1].greatest_share > 0.75 > got[1].share
    seen = []
    bands.shares(bytes(10000), lambda b: seen.append(len(b)) or b)
    assert seen == [10000, 4096, 4096, 4096]


def test_edges(spark):
    assert bands.quality_rules(empty(spark)).count() == 0
    clash = bands.quality_rules(frame(spark, extra=True))
    assert clash.columns.count("kept") == 1 and clash.select("h").distinct().count() == 1 and untouched(clash)
    long = "some longer words " * 90_000
    r = bands.quality_rules(frame(spark, [(1, long), (1, long), (None, None)])).where("text is not null").collect()
    assert [(x.n_words, x.base_failed) for x in r] == [(270_000, True)] * 2
