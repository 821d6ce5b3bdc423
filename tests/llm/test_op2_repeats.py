import random
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from hexloom.llm import repeats
from hexloom.llm.repeats import remove_repeats
from tests.llm.common import frame, untouched


def brute(rows, width):
    texts = [(t or "").encode() for _, t in rows]
    seen = Counter(b[p : p + width] for b in texts for p in range(len(b) - width + 1))
    out = []
    for b in texts:
        gone = bytearray(len(b))
        for p in range(len(b) - width + 1):
            if seen[b[p : p + width]] > 1:
                gone[p : p + width] = b"\1" * width
        runs = sum(1 for i in range(len(b)) if gone[i] and not (i and gone[i - 1]))
        out.append((len(b), sum(gone), runs, bytes(x for x, g in zip(b, gone) if not g)))
    return out


def sample():
    r = random.Random(5)
    word = lambda: "".join(r.choice(["an", "th", "é", "on", "ous"]) for _ in range(r.randint(1, 4)))
    prose = lambda n: " ".join(word() for _ in range(n))
    shared, whole = prose(90), prose(200)
    rows = [(i, prose(r.randint(1, 120))) for i in range(20)]
    rows += [(20 + i, prose(r.randint(0, 60)) + shared + prose(r.randint(0, 60))) for i in range(8)]
    rows += [(28, whole), (29, whole), (30, whole[:300] + "X" + whole[301:]), (31, "to " * 200), (32, "a" * 199), (33, "b" * 201), (34, "c" * 200)]
    rows += [(35, None), (36, ""), (None, prose(50)), (None, prose(90)), (28, whole), (28, prose(70)), (37, shared[:230]), (38, shared[-205:] + whole[40:260])]
    return rows


def test_brute(spark):
    rows = sample()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = Counter((r.doc_id, r.n_bytes, r.n_bytes - len(r.kept), len(r.spans), bytes(r.kept)) for r in remove_repeats(df).collect())
    assert got == Counter((k, *b) for (k, _), b in zip(rows, brute(rows, 200)))


def test_long_text():
    raw = np.random.default_rng(3).integers(97, 123, (1 << 24) + 5000, dtype=np.uint8)
    raw[-300:] = raw[1000:1300]
    rows = pa.RecordBatch.from_pydict({"row_a": pa.array([1]), "row_b": pa.array([2]), "text": pa.array([raw.tobytes().decode()])})
    seen, covered = Counter(), 0
    for got in repeats._run_rows(200)([rows]):
        seen.update(got.column("h").to_pylist())
        covered += int(np.sum(got.column("hi").to_numpy() - got.column("lo").to_numpy() + 1))
    assert covered == len(raw) - 199 and max(seen.values()) > 1


def test_segments(spark, monkeypatch):
    # texts of over a block are cut; here one of 1.2 MB, its repeats across and beside the cuts
    r = random.Random(8)
    base = "".join(r.choice("abcdefgh ") for _ in range(1_200_000))
    text = base[:399_900] + base[100:700] + base[400_500:799_990] + base[2000:2201] + base[800_191:]
    rows = [(1, text), (2, base[500_000:500_300]), (3, base[600_000:600_150])]
    monkeypatch.setattr(repeats, "SEGMENT", 100_000)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter((r.doc_id, r.n_bytes, r.n_bytes - len(r.kept), len(r.spans), bytes(r.kept)) for r in remove_repeats(df).collect())
    assert got == Counter((k, *b) for (k, _), b in zip(rows, brute(rows, 200)))


def test_edges(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert remove_repeats(empty).count() == 0
    df = frame(spark, sample(), extra=True)
    got = remove_repeats(df)
    assert untouched(got) and got.count() == len(sample())
    df = spark.createDataFrame([(1, "x" * 300, "keep", 7)], "doc_id long, text string, h string, spans int")
    r = remove_repeats(df).collect()
    assert r[0].h == "keep" and bytes(r[0].kept) == b"" and len(r[0].spans) == 1
    long = "ab " * 400_000
    df = spark.range(2).select(F.col("id").alias("doc_id"), F.lit(long).alias("text"))
    assert [len(x.kept) for x in remove_repeats(df).collect()] == [0, 0]


def test_rows_that_a_32_bit_hash_takes_for_one(spark):
    # the two texts have equal 32-bit hashes; the second has a repeat, the first none
    a, b = "p q r 179531", "w357140"
    assert spark.sql(f"select hash('{a}') = hash('{b}')").first()[0]
    r = random.Random(3)
    tail = "".join(r.choice("abcdefgh ") for _ in range(400))
    rows = [(None, a), (None, b), (None, a + tail), (None, b + tail[:250])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter((x.n_bytes, x.n_bytes - len(x.kept), len(x.spans), bytes(x.kept)) for x in remove_repeats(df).collect())
    assert got == Counter(brute(rows, 200))


def test_many_copies_of_one_row(spark):
    r = random.Random(4)
    text = "".join(r.choice("abcdefgh ") for _ in range(3000))
    df = spark.range(10_000).select(F.lit(5).cast("long").alias("doc_id"), F.lit(text).alias("text"))
    spans = repeats.repeated_spans(df.select(F.lit(1).cast("long").alias("row_a"), F.lit(2).cast("long").alias("row_b"), "text"))
    assert spans.distinct().count() < 100
    got = remove_repeats(df).agg(F.count("*"), F.sum(F.length("kept")), F.max(F.size("spans"))).first()
    assert tuple(got) == (10_000, 0, 1)


def test_a_text_of_forty_megabytes(spark):
    raw = np.random.default_rng(3).integers(97, 123, 40_000_000, dtype=np.uint8)
    raw[30_000_000:30_000_400] = raw[1_000_000:1_000_400]
    raw[20_971_420:20_971_720] = raw[5_000:5_300]  # over the end of a segment
    df = spark.createDataFrame([(1, raw.tobytes().decode()), (2, "short"), (3, raw[39_999_500:39_999_750].tobytes().decode())], "doc_id long, text string")
    got = {r.doc_id: r for r in remove_repeats(df).select("doc_id", "n_bytes", "spans").collect()}
    assert [(s.start, s.end) for s in got[1].spans] == [(5_000, 5_300), (1_000_000, 1_000_400), (20_971_420, 20_971_720), (30_000_000, 30_000_400), (39_999_500, 39_999_750)]
    assert got[1].n_bytes == 40_000_000 and [(s.start, s.end) for s in got[3].spans] == [(0, 250)] and not got[2].spans
