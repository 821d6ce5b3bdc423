"""Removal of repeated byte strings: depth-limited radix grouping of suffixes.

Every suffix is told apart only through its first ``width`` bytes, by passes from coarse
digits to fine ones, and a suffix leaves as soon as its group has one member. The groups are
not put in order (nothing here needs an order), and the first digit is not the leading
bytes but a string chosen by content, so that one row can stand for many suffixes:

1. The first digit is the suffix's *anchor*, the least-hash 32-byte string inside those
   ``width`` bytes. Neighbouring suffixes share it, so one row stands for a whole run of
   them. A run whose anchor occurs once holds no repeat. If all runs of an anchor are
   equal as strings, all their suffixes repeat and no more passes are needed.
2. What is left, one run of each set of equal runs beside the others, is cut into chunks
   of 16 suffixes. The digit is the string that all 16 share.
3. Chunks whose digit repeats and whose strings differ are cut into single suffixes; the
   last digit is what remains of the ``width`` bytes. Equal groups are the repeats.

Every pass is an aggregate with map-side partial sums (count, least and greatest string
hash) and a join back, so a string shared by a third of the corpus is never gathered in
one task. Groups are told apart by hashes of 128 bits (anchor and string).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hexloom.llm import windows as win
from hexloom.llm.textvec import flat, row_blocks, text_rows, tidy
from hexloom.llm.workspace import KEY, boxed, discard, materialize, table, unboxed

WIDTH, CHUNK = 200, 16
SEGMENT = 1 << 22  # bytes of a long text that are hashed at once
_KEYS = ", ".join(f"{k} long" for k in KEY)
_U = np.uint64


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _run_rows(width: int, segment: int = SEGMENT):
    @tidy()
    def run(batches):
        for rows, data, offsets in text_rows(batches):
            # a long text is a block of its own; each of its windows lies in one segment. A run that
            # is cut in two has one anchor twice, so that later passes look at its suffixes
            long = len(offsets) == 2 and len(data) > segment
            for base in range(0, max(len(data) - width + 1, 1), segment) if long else (0,):
                part = data[base : base + segment + width - 1] if long else data
                at_part = np.array([0, len(part)]) if long else offsets
                grams = win.doubled(part, 128)
                doc, lo, hi, anchor, h = win.runs(part, at_part, width, grams)
                if len(doc):
                    whole = win.of_length(grams, lo, hi - lo + width) ^ (anchor - lo).astype(_U)
                    at = pa.array(doc)
                    place = base - at_part[doc]
                    yield pa.RecordBatch.from_arrays(
                        [_signed(h), _signed(whole), *(rows.column(k).take(at) for k in KEY), pa.array((lo + place).astype(np.int32)), pa.array((hi + place).astype(np.int32)), pa.array((anchor - lo).astype(np.int32))],
                        ["h", "whole", *KEY, "lo", "hi", "a"],
                    )

    return run


def _chunks(data: np.ndarray, offsets: np.ndarray, doc: np.ndarray, lo: np.ndarray, hi: np.ndarray, a: np.ndarray, width: int):
    """(number of the run, shared string's hash, whole string's hash, first suffix, suffixes, skipped ones, bytes before, bytes after) of runs' chunks."""
    grams = win.doubled(data, 128)
    # chunks lie on a grid counted back from the anchor, so equal suffixes meet in equal chunks
    anchor = lo + a
    q_lo, q_hi = anchor - hi, anchor - lo
    n = q_hi // CHUNK - q_lo // CHUNK + 1
    row = np.repeat(np.arange(len(lo)), n)
    j = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n) + (q_lo // CHUNK)[row]
    base = offsets[doc[row]]
    top = anchor[row] - j * CHUNK  # the last suffix of the full chunk; the shared string starts there
    first = np.maximum(lo[row], top - CHUNK + 1)
    count = np.minimum(hi[row], top) - first + 1
    skip = first - (top - CHUNK + 1)
    core = win.of_length(grams, top + base, width - CHUNK + 1) ^ win.mix(j.astype(_U))
    whole = win.of_length(grams, first + base, width + count - 1) ^ win.mix(skip.astype(_U))
    for s in range(0, len(row), 20000):
        t = slice(s, s + 20000)
        # what the suffixes hold before and after the shared string
        f, m, c = (first + base)[t], (top + base)[t], count[t]
        left = [data[x:y].tobytes() for x, y in zip(f, m, strict=True)]
        right = [data[y + width - CHUNK + 1 : x + k - 1 + width].tobytes() for x, y, k in zip(f, m, c, strict=True)]
        yield row[t], core[t], whole[t], first[t], c, skip[t], left, right


def _chunk_rows(width: int, segment: int = SEGMENT):
    @tidy()
    def run(batches):
        for rows, data, offsets in text_rows(batches):
            lists = rows.column("runs")
            lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
            flat = lists.flatten()
            doc = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy(zero_copy_only=False))
            lo, hi, h, a = (flat.field(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(4))
            # a long text is a block of its own; its runs are worked through by the segment they begin in
            long = len(offsets) == 2 and len(data) > segment
            for base in range(0, len(data), segment) if long else (0,):
                some = np.flatnonzero((lo >= base) & (lo < base + segment)) if long else np.arange(len(lo))
                if not len(some):
                    continue
                part = data[base : base + segment + 2 * width] if long else data
                at_part = np.array([0, len(part)]) if long else offsets
                for row, core, whole, first, n, skip, left, right in _chunks(part, at_part, doc[some], lo[some] - base, hi[some] - base, a[some], width):
                    take = pa.array(doc[some][row])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(h[some][row]), _signed(core), _signed(whole), *(rows.column(k).take(take) for k in KEY), pa.array((first + base).astype(np.int32)), pa.array(n.astype(np.int32)), pa.array(skip.astype(np.int32)), pa.array(left, pa.binary()), pa.array(right, pa.binary())],
                        ["h", "core", "whole", *KEY, "lo", "n", "skip", "left", "right"],
                    )

    return run


def _pass(rows: DataFrame, digit: list[str]) -> DataFrame:
    """One digit: drops rows alone in their group and marks groups of one string as ``same``."""
    groups = rows.groupBy(*digit).agg(F.count("*").alias("c"), F.min("whole").alias("x"), F.max("whole").alias("y"))
    # written first: the join then deals both sides itself and can split a crowded group
    groups = materialize(groups.where("c > 1").select(*digit, (F.col("x") == F.col("y")).alias("same")), "digit")
    out = rows.join(groups, digit)
    out.hexloom_paths = groups.hexloom_paths
    return out


def repeated_spans(texts: DataFrame, width: int = WIDTH) -> DataFrame:
    """Distinct byte spans ``(KEY, start, end)``, possibly overlapping, that a repeated ``width``-byte string covers.

    ``texts``: KEY columns and ``text``. Rows of equal key have equal texts and so equal spans.
    """
    if width - CHUNK + 1 < 128 or width < win.GRAM:
        raise ValueError("width must be 143 or more")
    runs = materialize(texts.mapInArrow(_run_rows(width, SEGMENT), f"h long, whole long, {_KEYS}, lo int, hi int, a int"), "runs")
    passed = _pass(runs, ["h"])
    seen = materialize(passed, "groups")
    discard(runs, passed)
    mixed = seen.where("not same")
    # one run of each set of equal runs goes on, and those that have no equal
    sets = mixed.groupBy("h", "whole").agg(F.count("*").alias("c"), F.min(F.struct(*KEY, "lo", "hi", "a")).alias("one"))
    sets = materialize(sets, "sets")
    equal = mixed.join(sets.where("c > 1").select("h", "whole"), ["h", "whole"], "left_semi")
    done = seen.where("same").select(*KEY, "lo", "hi").unionByName(equal.select(*KEY, "lo", "hi"))
    onward = sets.select("one.*", "h").groupBy(*KEY).agg(F.collect_list(F.struct("lo", "hi", "h", "a")).alias("runs"))
    chunks = texts.join(onward, KEY).select(*KEY, "text", "runs")
    chunks = materialize(chunks.mapInArrow(_chunk_rows(width, SEGMENT), f"h long, core long, whole long, {_KEYS}, lo int, n int, skip int, left binary, right binary"), "chunks")
    passed = _pass(chunks, ["h", "core"])
    fine = materialize(passed, "fine")
    discard(chunks, passed)
    single = fine.where("not same").select("h", "core", *KEY, "lo", "skip", "left", "right", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("i"))
    place = F.col("skip") + F.col("i")
    rest = F.concat(F.substring("left", F.col("i") + 1, F.lit(CHUNK)), F.substring("right", F.lit(1), place))
    single = single.select("h", F.xxhash64("core", place, rest).alias("core"), F.lit(0).alias("whole"), *KEY, (F.col("lo") + F.col("i")).alias("lo"))
    passed = _pass(single, ["h", "core"])
    last = passed.select(*KEY, "lo", F.col("lo").alias("hi"))
    found = done.unionByName(fine.where("same").select(*KEY, "lo", (F.col("lo") + F.col("n") - 1).alias("hi"))).unionByName(last)
    spans = materialize(found.select(*KEY, F.col("lo").alias("start"), (F.col("hi") + width).alias("end")), "spans")
    discard(seen, sets, fine, passed)
    return spans


def _characters(b: bytes, spans: list) -> str:
    """What spans leave of a text, without the characters that they cut in two."""
    out, at = [], 0
    for s, e in spans:
        while s > at and b[s] & 0xC0 == 0x80:
            s -= 1
        while e < len(b) and b[e] & 0xC0 == 0x80:
            e += 1
        out.append(b[at:s])
        at = max(at, e)
    out.append(b[at:])
    return b"".join(out).decode()


def _cut(text: str):
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def cut(t, raw):
        b = (t or "").encode() if not isinstance(t, bytes) else t
        out, merged, at = [], [], 0
        for s, e in sorted((x["start"], x["end"]) for x in raw or ()):
            if merged and s <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], e)
            else:
                merged.append([s, e])
        for s, e in merged:
            out.append(b[at:s])
            at = e
        out.append(b[at:])
        return len(b), [{"start": s, "end": e} for s, e in merged], b"".join(out), _characters(b, merged)

    @tidy()
    def run(batches):
        for batch in batches:
            for lo, hi in row_blocks(flat(batch.column("row").field(text))[1]):
                rows = batch.slice(lo, hi - lo)
                size, spans, kept, whole = zip(*map(cut, rows.column("row").field(text).to_pylist(), rows.column("spans").to_pylist()), strict=True)
                yield pa.RecordBatch.from_arrays([rows.column("row"), pa.array(size, pa.int64()), pa.array(spans, kind), pa.array(kept, pa.binary()), pa.array(whole, pa.string())], ["row", "n_bytes", "spans", "kept", "kept_text"])

    return run


def remove_repeats(docs: DataFrame, width: int = WIDTH, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Remove each byte that a ``width``-byte string covers which also starts anywhere else.

    Returns the rows of ``docs`` with n_bytes (of the input), spans (maximal removed runs,
    ``[start, end)``), kept (the other bytes) and kept_text (the same as text, without
    characters that a span cuts in two). Columns of those names are replaced.
    A text may have any length. A null or empty text has no spans. Rows with the same id, and
    rows with a null id, are separate documents; fully repeated rows remove each other. An
    empty table gives an empty result. Overlapping repeats inside one text count (``width`` + 1
    equal bytes go). Other columns may have any names.
    """
    rows = boxed(docs, key, text)
    spans = repeated_spans(rows.select(*KEY, F.col("row")[text].alias("text")), width)
    # repeated rows have one list, each span once
    spans = spans.groupBy(*KEY).agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    joined = rows.join(spans, KEY, "left").select("row", "spans")
    span = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
    new = [T.StructField("n_bytes", T.LongType()), T.StructField("spans", T.ArrayType(span)), T.StructField("kept", T.BinaryType()), T.StructField("kept_text", T.StringType())]
    out = joined.mapInArrow(_cut(text), T.StructType([rows.schema["row"], *new]))
    return out.select(*unboxed([c for c in docs.columns if c not in {f.name for f in new}], *(f.name for f in new)))


def op2(spark, sf_dir: str) -> DataFrame:
    r = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return r.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
