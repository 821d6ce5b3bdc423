"""Document fingerprints: threshold-scaled sketches of word shingles.

A fingerprint keeps every shingle hash below a fixed fraction of the hash range, whatever the
text's length, the number of distinct shingles and a hash of all of them together (which tells
texts apart of which nothing is kept). The kept hashes of a union are the union of the kept
hashes, so fingerprints merge, and the share of one fingerprint's hashes found in another
estimates containment. Fingerprints of unlike fractions are compared below the lower one.
"""

from __future__ import annotations

import base64
import hashlib
import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hexloom.llm import textvec as tv
from hexloom.llm.workspace import named, table, unboxed

SHINGLE, FRACTION = 5, 0.5


def limit(fraction: float = FRACTION) -> np.uint64:
    return np.uint64(min(int(fraction * 2**64), 2**64 - 1))


def sketches(data: np.ndarray, offsets: np.ndarray, k: int = SHINGLE, fraction: float = FRACTION) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Kept hashes (ascending), number of distinct shingles and a hash of all of them for each text."""
    n = len(offsets) - 1
    doc, h, _ = tv.distinct(*tv.Words(data, offsets).shingles(k, seed=5))
    count, whole = np.bincount(doc, minlength=n), np.zeros(n, np.uint64)
    full = np.flatnonzero(count)
    if len(full):
        with np.errstate(over="ignore"):
            whole[full] = tv.mix(np.add.reduceat(tv.mix(h + np.uint64(3)), np.searchsorted(doc, full)) + count[full].astype(np.uint64))
    keep = h < limit(fraction)
    bounds = np.searchsorted(doc[keep], np.arange(n + 1))
    return np.split(h[keep], bounds[1:-1]) if n else [], count, whole


@dataclass(frozen=True)
class Sketch:
    """All hashes below ``fraction`` of the range of a text's ``n`` distinct shingles; ``whole``: a hash of all of them."""

    hashes: np.ndarray
    n: int
    whole: int
    fraction: float = FRACTION

    def below(self, fraction: float) -> np.ndarray:
        return self.hashes[self.hashes < limit(min(fraction, self.fraction))]


def pack(s: Sketch) -> str:
    return f"{s.fraction:g}:{s.n}:{s.whole:016x}:" + base64.b64encode(s.hashes.astype(">u8").tobytes()).decode()


def unpack(fingerprint: str) -> Sketch:
    fraction, n, whole, body = fingerprint.split(":")
    return Sketch(np.frombuffer(base64.b64decode(body), ">u8").astype(np.uint64), int(n), int(whole, 16), float(fraction))


def likeness(a: Sketch, b: Sketch) -> float:
    """Estimated Jaccard index: 1 for equal sets, 0 if one is empty or nothing was kept of both."""
    if a.n == b.n and a.whole == b.whole:
        return 1.0
    x, y = a.below(b.fraction), b.below(a.fraction)
    common = np.intersect1d(x, y, assume_unique=True).size
    # no more can be common than the smaller set has
    most = min(a.n, b.n) / max(a.n, b.n, 1)
    return min(common / max(len(x) + len(y) - common, 1), most)


def containment(a: Sketch, b: Sketch) -> float:
    """Estimated share of the shingles of the first text that the second has too."""
    if not a.n or (a.n == b.n and a.whole == b.whole):
        return 1.0
    x = a.below(b.fraction)
    return float(np.isin(x, b.hashes).mean()) if len(x) else 0.0


def merge(a: str, b: str) -> str:
    """Fingerprint of both texts' shingles together, below the lower threshold; the number of shingles is an estimate."""
    x, y = unpack(a), unpack(b)
    if not x.n or not y.n or (x.n == y.n and x.whole == y.whole):
        return a if x.n else b
    fraction = min(x.fraction, y.fraction)
    p, q = x.below(fraction), y.below(fraction)
    both = np.union1d(p, q)
    n = min(max(x.n + y.n - round((len(p) + len(q) - len(both)) / fraction), x.n, y.n), x.n + y.n)
    return pack(Sketch(both, n, (x.whole + y.whole) % 2**64, fraction))


def edited(text: str, following: str) -> str:
    """The last half of ``text`` replaced by the first code points of ``following``."""
    m = len(text) // 2
    return text[: len(text) - m] + following[:m]


def with_next(docs: DataFrame, key: str, text: str, run, out) -> DataFrame:
    """Rows (id, text, range, tail) in ascending order of the id through ``run``, which sees each row before its follower.

    Rows are dealt to ranges of (id, hash of the text), rows without id last; the first row of
    each range also goes to the range before it (that of the first range to the last), so a
    text crosses the network once. An id that fills several ranges is cut by the hash.
    """
    spark = docs.sparkSession
    n = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(named(key).cast("long").alias("id"), named(text).alias("text"), F.xxhash64(F.lit(9), named(text)).alias("tie"))
    cuts, total, none = rows.agg(F.percentile_approx("id", [i / n for i in range(1, n)], 100 * n), F.count("*"), F.count_if(F.col("id").isNull())).first()
    if not total:
        return spark.createDataFrame([], out)
    # an id that is a cut m times fills some m ranges: rows of it are dealt to them by hash
    times = Counter(cuts or [])
    heads = sorted(times)
    share = [times[x] for x in heads] + [max(1, round(n * none / total))]
    side = math.isqrt(len(heads)) + 1
    parts = [heads[i : i + side] for i in range(0, len(heads), side)]
    numbers = lambda values: F.array(*(F.lit(v).cast("long") for v in values))
    at = F.lit(0)
    if parts:
        # two steps: the run of cuts, then the place in that run
        part = F.size(F.filter(numbers([p[0] for p in parts]), lambda x: x <= F.col("id")))
        within = F.size(F.filter(F.element_at(F.array(*map(numbers, parts)), part), lambda x: x <= F.col("id")))
        at = F.when(part == 0, 0).otherwise((part - 1) * side + within)
    # ranges: below the first cut; for each cut its own shares, then the ids up to the next; those without id
    base, room = [0], 1
    for m in share:
        base.append(room)
        room += m + 1
    rows = rows.withColumn("cut", F.when(F.col("id").isNull(), len(heads) + 1).otherwise(at).cast("int"))
    m = F.element_at(numbers([1, *share]), F.col("cut") + 1)
    spread = F.floor((F.col("tie") / F.lit(2.0**64) + 0.5) * m)
    spread = F.least(F.greatest(spread, F.lit(0)), m - 1)
    own = F.when(F.col("id").isNull() | (F.col("id") == F.element_at(numbers([0, *heads, 0]), F.col("cut") + 1)), spread).otherwise(m)
    own = F.when(F.col("cut") == 0, F.lit(0)).otherwise(own)
    rows = rows.withColumn("range", (F.element_at(numbers(base), F.col("cut") + 1) + own).cast("int"))
    firsts = {r[0]: r[1] for r in rows.groupBy("range").agg(F.min(F.struct("id", "tie"))).collect()}  # one row for each range
    order = sorted(firsts)
    place = {r: i for i, r in enumerate(order)}
    first = F.element_at(F.array(*(F.struct(F.lit(firsts[r][0]).cast("long").alias("id"), F.lit(firsts[r][1]).cast("long").alias("tie")) for r in order)), F.col("place") + 1)
    rows = rows.withColumn("place", F.element_at(numbers([place.get(r, 0) for r in range(order[-1] + 1)]), F.col("range") + 1).cast("int"))
    leads = F.col("id").eqNullSafe(first["id"]) & (F.col("tie") == first["tie"])
    here = F.struct(F.col("place").alias("to"), F.lit(False).alias("tail"))
    before = F.struct(((F.col("place") + len(order) - 1) % len(order)).cast("int").alias("to"), F.lit(True).alias("tail"))
    rows = rows.withColumn("seat", F.explode(F.when(leads, F.array(here, before)).otherwise(F.array(here))))
    rows = rows.select("id", "text", F.col("seat.to").alias("range"), F.col("seat.tail").alias("tail"), "tie")
    rows = rows.repartitionById(len(order), "range").sortWithinPartitions("range", "tail", F.asc_nulls_last("id"), "tie")
    return rows.select("id", "text", "range", "tail").mapInArrow(run, out)


def _digest(fraction: float):
    def run(batches):
        held: list = []  # (id, text, range, tail) of the last row, whose follower is in the next batch

        def pairs(batch):
            found = []
            for k, t, to, tail in zip(*(batch.column(c).to_pylist() for c in ("id", "text", "range", "tail")), strict=True):
                if held and held[0][2] == to and not held[0][3]:
                    found.append((held[0][0], held[0][1], t or ""))
                held[:] = [(k, t or "", to, tail)]
            return found

        for batch in batches:
            for lo, hi in tv.row_blocks(tv.flat(batch.column("text"))[1], tv.BLOCK // 2):
                if rows := pairs(batch.slice(lo, hi - lo)):
                    changed = [edited(t, f) for _, t, f in rows]
                    texts = [*(t for _, t, _ in rows), *changed, *(f for *_, f in rows)]
                    kept, count, whole = sketches(*tv.flat(pa.array(texts, pa.large_string())), fraction=fraction)
                    s = [Sketch(h, int(c), int(w), fraction) for h, c, w in zip(kept, count, whole, strict=True)]
                    n = len(rows)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([r[0] for r in rows], pa.int64()),
                            pa.array([len(r[1]) for r in rows], pa.int64()),
                            pa.array([hashlib.sha256(c.encode()).hexdigest() for c in changed]),
                            pa.array([pack(x) for x in s[:n]]),
                            pa.array([pack(x) for x in s[n : 2 * n]]),
                            pa.array([likeness(s[i], s[n + i]) for i in range(n)]),
                            pa.array([likeness(s[i], s[2 * n + i]) for i in range(n)]),
                        ],
                        ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
                    )

    return run


def fingerprint(docs: DataFrame, text: str = "text", column: str = "fingerprint", fraction: float = FRACTION) -> DataFrame:
    """``docs`` with the fingerprint of each whole text in ``column`` (an existing one is replaced).

    Null counts as empty, of which nothing is kept. A text of fewer than five words has one
    shingle, its whole sequence; texts may have any length. Equal texts have equal
    fingerprints; repeated rows stay. Other columns may have any names. An empty table gives
    an empty result.
    """
    rows = docs.select(F.struct(*map(named, docs.columns)).alias("row"))

    def run(batches):
        for batch in batches:
            data, offsets = tv.flat(batch.column("row").field(text))
            for lo, hi in tv.row_blocks(offsets):
                kept, count, whole = sketches(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], fraction=fraction)
                made = [pack(Sketch(h, int(n), int(w), fraction)) for h, n, w in zip(kept, count, whole, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column("row").slice(lo, hi - lo), pa.array(made, pa.string())], ["row", "made"])

    out = rows.mapInArrow(run, T.StructType([rows.schema["row"], T.StructField("made", T.StringType())]))
    return out.select(*unboxed([c for c in docs.columns if c != column]), F.col("made").alias(column))


def compare_with_next(docs: DataFrame, key: str = "doc_id", text: str = "text", fraction: float = FRACTION) -> DataFrame:
    """Fingerprints of each text and of its edited text, with their likeness and that to the next text's.

    Returns doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and
    near_next. The follower of the last row in ``key`` order is the first; a single row follows
    itself. Null texts count as empty and texts may have any length; rows without id come
    last; rows of one id are ordered by a hash of their text, repeated rows follow each
    other. Other columns are not read. An empty table gives an empty result.
    """
    out = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return with_next(docs, key, text, _digest(fraction), out)


def op5(spark, sf_dir: str) -> DataFrame:
    return compare_with_next(table(spark, sf_dir, "documents"))
