"""Quality rules: compression bands over whole texts and fixed chunks, beside base counts.

A text passes if the share of its size that zstandard leaves (compressed / raw bytes) lies
between the limits of its length band, for the whole text and for each fixed chunk. What
follows the last full chunk is judged by the chunk that ends with the text. Too
small a share means repetition, too large a share means noise. Short texts compress less, so
every band has its own limits.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hexloom.llm import textvec as tv
from hexloom.llm.workspace import named, table, unboxed

#: (bytes below which the band holds, least share, greatest share): a few hundredths below the least share of
#: texts labelled good, and a tenth or more above their greatest; README has the quantiles. Above a chunk the whole
#: text's limit is lower, so that plain prose of some hundred different words stays; chunks tell more there
BANDS = ((512, 0.50, 0.90), (1024, 0.49, 0.80), (2048, 0.455, 0.70), (4096, 0.44, 0.65), (8192, 0.385, 0.60), (16384, 0.365, 0.60), (float("inf"), 0.355, 0.60))
CHUNK, LEVEL = 4096, 3
CHUNK_BAND = (0.415, 0.62)
SYMBOLS = b"#*$%&|<>"
MIN_WORDS, REPEAT_PERCENT = 50, 50
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _per_doc(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return np.diff(total[offsets])


def repeat_words(words: tv.Words) -> np.ndarray:
    """Words of each text that lie in a 3-word window found twice or more in that text."""
    n = len(words.hash)
    marked = np.zeros(n, bool)
    if n >= 3:
        with np.errstate(over="ignore"):
            h = tv.mix(tv.mix(words.hash[:-2] * np.uint64(3) + words.hash[1:-1]) * np.uint64(5) + words.hash[2:])
        at = np.flatnonzero(words.doc[:-2] == words.doc[2:])
        h, doc = h[at], words.doc[at]
        order = np.lexsort((h, doc))
        same = (h[order][1:] == h[order][:-1]) & (doc[order][1:] == doc[order][:-1])
        twice = np.zeros(len(at), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        for j in range(3):
            marked[at[twice] + j] = True
    return _per_doc(marked, words.per_doc)


def dup_lines(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Lines of each text, split at newlines and holding a word, that equal an earlier line."""
    n = len(data)
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    edge[1:][data == 10] = True
    cut = np.flatnonzero(edge)
    start, end = cut[:-1], cut[1:]
    line = np.zeros(n + 1, np.int64)
    np.cumsum(~tv.WHITE[data], out=line[1:])
    full = line[end] > line[start]
    start, end = start[full], end[full]
    end = end - (data[end - 1] == 10)
    up, down = tv.powers(n + 1)
    with np.errstate(over="ignore"):
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(tv.BYTE[data] * up[:n], out=total[1:])
        h = tv.mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64))
    doc = np.searchsorted(offsets, start, "right") - 1
    kinds, _, count = tv.distinct(doc, h)
    return np.bincount(kinds, count - 1, len(offsets) - 1).astype(np.int64)


def shares(raw: bytes, compress) -> tuple[float, float, float]:
    """Share of the whole text, least and greatest share of its chunks, which hold every byte.

    The last chunk ends with the text; a text no longer than a chunk has none.
    """
    n = len(raw)
    if not n:
        return 1.0, 1.0, 1.0
    whole = len(compress(raw)) / n
    if n <= CHUNK:
        return whole, whole, whole
    each = [len(compress(raw[i : i + CHUNK])) / CHUNK for i in (*range(0, n - CHUNK, CHUNK), n - CHUNK)]
    return whole, min(each), max(each)


def limits(n: int) -> tuple[float, float]:
    return next((lo, hi) for top, lo, hi in BANDS if n < top)


def in_bands(n: int, whole: float, least: float, greatest: float) -> bool:
    lo, hi = limits(n)
    return lo <= whole <= hi and (n <= CHUNK or (CHUNK_BAND[0] <= least and greatest <= CHUNK_BAND[1]))


def _rows(text: str):
    @tv.tidy()
    def run(batches):
        import zstandard

        compress = zstandard.ZstdCompressor(level=LEVEL).compress
        symbol = np.zeros(256, bool)
        symbol[list(SYMBOLS)] = True
        for batch in batches:
            every, bounds = tv.flat(batch.column("row").field(text))
            for first, last in tv.row_blocks(bounds):
                data, offsets = every[bounds[first] : bounds[last]], bounds[first : last + 1] - bounds[first]
                words = tv.Words(data, offsets)
                lead = (data & 0xC0) != 0x80
                out = [np.diff(words.per_doc), _per_doc(lead & ~tv.WHITE[data], offsets), _per_doc(symbol[data], offsets), dup_lines(data, offsets), repeat_words(words)]
                raw = data.tobytes()
                got = [shares(raw[i:j], compress) for i, j in zip(offsets[:-1], offsets[1:], strict=True)]
                kept = [in_bands(int(n), *s) for n, s in zip(np.diff(offsets), got, strict=True)]
                got = np.array(got, np.float64).reshape(-1, 3)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row").slice(first, last - first), *(pa.array(x.astype(np.int64)) for x in out), *(pa.array(got[:, j]) for j in range(3)), pa.array(kept, pa.bool_())],
                    ["row", *COUNTS, "share", "least_share", "greatest_share", "in_bands"],
                )

    return run


def quality_rules(docs: DataFrame, text: str = "text") -> DataFrame:
    """Rows of ``docs`` with base counts, zstandard shares, base_failed, in_bands and kept.

    n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words are counted over the whole
    text, however long. least_share and greatest_share are those of its 4096-byte chunks (the
    last one ends with the text), or share if it has no more bytes than that. base_failed: fewer
    than 50 words, or more than half of the words in repeated 3-word windows. A null or empty
    text has zero counts, shares of 1 and fails. Repeated rows are judged each on its own; an
    empty table gives an empty result. Columns of the new names are replaced; others may have
    any names.
    """
    new = [*COUNTS, "share", "least_share", "greatest_share", "in_bands"]
    rows = docs.select(F.struct(*map(named, docs.columns)).alias("row"))
    kinds = [T.LongType()] * 5 + [T.DoubleType()] * 3 + [T.BooleanType()]
    judged = rows.mapInArrow(_rows(text), T.StructType([rows.schema["row"], *(T.StructField(n, k) for n, k in zip(new, kinds, strict=True))]))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    own = [c for c in docs.columns if c not in (*new, "base_failed", "kept")]
    return judged.select(*unboxed(own, *new), failed.alias("base_failed"), (~failed & F.col("in_bands")).alias("kept"))


def op10(spark, sf_dir: str) -> DataFrame:
    r = quality_rules(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return r.select("doc_id", *COUNTS, "base_failed", "kept", "share", "least_share", "greatest_share")


def base_counts(spark, sf_dir: str) -> DataFrame:
    """The part of the rules that SQL can express."""
    return quality_rules(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", *COUNTS, "base_failed")


ORACLE = r"""
with w as (select doc_id, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws from documents),
grams as (select doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] as gram from (select doc_id, ws, unnest(range(1, len(ws) - 1)) as i from w)),
twice as (select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, gram) as c from grams) where c > 1),
hit as (select doc_id, count(distinct i + j) as n from twice, (select unnest([0, 1, 2]) as j) group by doc_id),
lines as (select doc_id, count(*) - count(distinct line) as n from (select doc_id, unnest(string_split(text, chr(10))) as line from w) where regexp_matches(line, '[^\x20\x09-\x0D]') group by doc_id),
all_counts as (select w.doc_id, len(ws)::bigint as n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::bigint as word_chars, length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols,
  coalesce(lines.n, 0)::bigint as n_dup_lines, coalesce(hit.n, 0)::bigint as n_repeat_words from w left join lines on lines.doc_id = w.doc_id left join hit on hit.doc_id = w.doc_id)
select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from all_counts"""
