"""Language-model scoring: an interpolated modified Kneser-Ney word n-gram model of any order from 2.

Counting runs in Spark: tasks count words, then pairs, then longer n-grams, in memory, and ship
sorted arrays by range of the key (64 bits of hash or mixed number); a task merges the ranges of
a file one by one. A shipment has one row a range, and never more rows than keys, so rows
grow with the input. Workers map the files (nothing is copied) when a key first needs them, and
look up whole batches of sorted keys at once.

Files, all little-endian, at most 4096 of a kind, each a range of keys: ``grams1`` (uint64 hash,
uint64 count, sorted by hash), ``grams2`` .. (uint64 mixed key, uint64 count, from order 3 on also
uint64 number of the n-gram without its first word; sorted by key), ``sides1`` .. (by number:
followers counted once, twice, more; the sum of their counts; n-grams that end in this one).
An n-gram's number is its place over all files of its order, plus 1. The key of an n-gram is its
last word's number and that of the n-gram before it. Word number 0 stands before a text; an
n-gram that begins with it keeps its plain count at lower orders, since nothing stands before it.
"""

from __future__ import annotations

import os
from dataclasses import dataclass, field
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hexloom.llm import textvec as tv
from hexloom.llm.workspace import delete, materialize, named, settings, small_batches, table, work_dir

_U = np.uint64
END = _U(0x5DEECE66D1234567)
ENTRY = np.dtype([("h", "<u8"), ("n", "<u8")])
LONG_ENTRY = np.dtype([("h", "<u8"), ("n", "<u8"), ("s", "<u8")])
SIDE = np.dtype([("f1", "<u8"), ("f2", "<u8"), ("f3", "<u8"), ("total", "<u8"), ("before", "<u8")])
ORDER = 2
HELD = 1 << 19  # n-grams that a task counts before it ships them
PART = 1 << 20  # n-grams of a range, about
FILE_BITS = 12  # files of a kind: 2**12 at most
BLOB = "file int, part long, keys binary, counts binary, more binary"


def mounted(uri: str) -> str:
    """Path of a shared folder that every machine mounts; memory maps need one."""
    u = urlparse(uri)
    if u.scheme not in ("", "file"):
        raise ValueError(f"the model's folder must be a mounted path, not {uri}")
    return u.path


def summed(keys: np.ndarray, counts: np.ndarray | None = None, more: np.ndarray | None = None) -> tuple:
    """Distinct keys in order, with the sums of their counts (of 1 if there are none) and what goes ``more`` with each."""
    if counts is None and more is None:
        keys = np.sort(keys)
    else:
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        counts = np.ones(len(keys), np.int64) if counts is None else counts[order]
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    at = np.flatnonzero(new)
    n = np.diff(np.append(at, len(keys))) if counts is None else np.add.reduceat(counts, at) if len(at) else counts[:0]
    return keys[at], n, None if more is None else more[order][at]


def _joined(held: list[tuple]) -> tuple:
    return summed(*(None if x[0] is None else np.concatenate(x) for x in zip(*held, strict=True)))


def token_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of all texts, each text followed by one end, and the texts' offsets in them."""
    words = tv.Words(data, offsets, lower=True)
    bounds = words.per_doc + np.arange(len(words.per_doc))
    out = np.full(len(words.hash) + len(offsets) - 1, END, _U)
    out[np.arange(len(words.hash)) + words.doc] = words.hash
    return out, bounds


def _blobs(part: np.ndarray, per_file: int, keys: np.ndarray, counts: np.ndarray, more: np.ndarray | None) -> pa.RecordBatch:
    """Sorted keys and what goes with them, cut where the range ``part`` changes."""
    at = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])) if len(keys) else np.zeros(0, int)
    ends = np.append(at[1:], len(keys))
    cut = lambda x: pa.array([x[i:j].astype("<u8").tobytes() for i, j in zip(at, ends, strict=True)] if x is not None else [b""] * len(at), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array((part[at] // per_file).astype(np.int32)), pa.array(part[at]), cut(keys), cut(counts), cut(more)], ["file", "part", "keys", "counts", "more"])


@dataclass(frozen=True)
class Ranges:
    """How keys are dealt: their leading bits name a range, the leading ones of those its file."""

    bits: int

    @property
    def file_bits(self) -> int:
        return min(self.bits, FILE_BITS)

    def part(self, keys: np.ndarray) -> np.ndarray:
        return (keys >> _U(64 - self.bits)).astype(np.int64) if self.bits else np.zeros(len(keys), np.int64)

    def file(self, keys: np.ndarray) -> np.ndarray:
        return (keys >> _U(64 - self.file_bits)).astype(np.int64) if self.file_bits else np.zeros(len(keys), np.int64)

    def blobs(self, keys, counts, more) -> pa.RecordBatch:
        return _blobs(self.part(keys), 1 << (self.bits - self.file_bits), keys, counts, more)


def _count_rows(ranges: Ranges, most: int, grams_of):
    """Counts ``grams_of(data, offsets)`` over a partition; ships what is held whenever it is much."""

    def run(batches):
        held, size = [], 0
        for _, data, offsets in tv.text_rows(batches):
            held.append(summed(*grams_of(data, offsets)))
            size += len(held[-1][0])
            if size > most:
                one = _joined(held)
                if len(one[0]) > most // 2:
                    yield ranges.blobs(*one)
                    held, size = [], 0
                else:
                    held, size = [one], len(one[0])
        if held:
            yield ranges.blobs(*_joined(held))

    return run


def _merged(batches):
    """(file, range, keys, counts, more) of ranges whose parts follow each other."""
    at, held = None, []
    for batch in batches:
        for f, p, *raw in zip(batch.column("file").to_pylist(), batch.column("part").to_pylist(), *(batch.column(c) for c in ("keys", "counts", "more")), strict=True):
            if (f, p) != at and held:
                yield (*at, *_joined(held))
                held = []
            at = (f, p)
            keys, counts, more = (np.frombuffer(x.as_buffer(), "<u8") for x in raw)
            held.append((keys.astype(_U), counts.astype(np.int64), more.astype(_U) if len(more) else None))
    if held:
        yield (*at, *_joined(held))


def _whole(path: str, ranges, write):
    """Appends the ranges of each file to it; whole file or none, so a task that runs again replaces it by the same bytes."""
    file, out, told = None, None, None

    def end():
        out.close()
        os.replace(f"{path}-{file:06d}.{os.getpid()}", f"{path}-{file:06d}")
        return pa.RecordBatch.from_arrays([pa.array([file]), pa.array([told[0]]), pa.array([told[1]]), pa.array([told[2:].tolist()])], ["file", "size", "total", "few"])

    for f, part, keys, counts, more in ranges:
        if f != file:
            if out:
                yield end()
            file, out, told = f, open(f"{path}-{f:06d}.{os.getpid()}", "wb"), np.zeros(7, np.int64)
        told += write(out, f, part, keys, counts, more)
    if out:
        yield end()


def _few(counts: np.ndarray) -> list[int]:
    """How many are 1, 2, 3, 4, and 3 or more."""
    return [*(int((counts == i).sum()) for i in range(1, 5)), int((counts >= 3).sum())]


def _write_grams(path: str):
    def write(out, file, part, keys, counts, more):
        entries = np.zeros(len(keys), ENTRY if more is None else LONG_ENTRY)
        entries["h"], entries["n"] = keys, counts
        if more is not None:
            entries["s"] = more
        entries.tofile(out)
        return np.array([len(keys), counts.sum(), *_few(counts)])

    return lambda batches: _whole(path, _merged(batches), write)


TOLD = "file long, size long, total long, few array<bigint>"


class Sorted:
    """Sorted entry files; each is mapped into memory when a key first needs it."""

    def __init__(self, path: str, sizes: dict[int, int], ranges: Ranges, entry: np.dtype) -> None:
        self.path, self.sizes, self.ranges, self.entry, self.maps = path, sizes, ranges, entry, {}
        every = sorted(sizes)
        self.start = dict(zip(every, np.cumsum([0, *(sizes[f] for f in every)]).tolist(), strict=False))

    def file(self, f: int) -> np.ndarray:
        if f not in self.maps:
            self.maps[f] = np.memmap(f"{self.path}-{f:06d}", self.entry, "r", shape=(self.sizes[f],))
        return self.maps[f]

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number over all files (0: absent) and count of each key."""
        number, count = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        if not len(keys):
            return number, count
        order = np.argsort(keys)
        sorted_keys = keys[order]
        file = self.ranges.file(sorted_keys)
        cut = np.flatnonzero(np.concatenate([[True], file[1:] != file[:-1]]))
        for i, j in zip(cut, [*cut[1:], len(keys)], strict=True):
            f = int(file[i])
            if not self.sizes.get(f):
                continue
            m, k = self.file(f), sorted_keys[i:j]
            at = np.minimum(np.searchsorted(m["h"], k), len(m) - 1)
            got = m[at]
            hit = got["h"] == k
            o = order[i:j][hit]
            number[o] = self.start[f] + at[hit] + 1
            count[o] = got["n"][hit]
        return number, count


class Sides:
    """What is known of n-grams by number, in files of ``span`` numbers."""

    def __init__(self, path: str, span: int) -> None:
        self.path, self.span, self.maps = path, span, {}

    def file(self, f: int):
        if f not in self.maps:
            path = f"{self.path}-{f:06d}"
            self.maps[f] = np.memmap(path, SIDE, "r") if os.path.exists(path) else np.zeros(0, SIDE)
        return self.maps[f]

    def of(self, numbers: np.ndarray) -> np.ndarray:
        kinds, back = np.unique(numbers, return_inverse=True)
        out = np.zeros(len(kinds), SIDE)
        file = kinds // self.span
        for f in np.unique(file):
            m, at = self.file(int(f)), np.flatnonzero(file == f)
            local = kinds[at] - f * self.span
            held = local < len(m)
            out[at[held]] = m[local[held]]
        return out[back]


@dataclass
class Model:
    """Where a model's files are and the numbers that go with them; lists are by order, from 1."""

    path: str
    order: int = ORDER
    folder: str = ""
    ranges: list[Ranges] = field(default_factory=list)
    sizes: list[dict[int, int]] = field(default_factory=list)
    spans: list[int] = field(default_factory=list)
    discounts: list[tuple[float, float, float]] = field(default_factory=list)
    n_tokens: int = 0
    vocabulary: int = 0
    low_total: int = 0
    low_few: tuple[int, int, int] = (0, 0, 0)

    def _kept(self, what: str, k: int, open_files):
        kept = tv.process_cache()
        for old in [x for x in kept if isinstance(x, tuple) and x[0] == "lm" and x[1] != self.path]:
            del kept[old]  # maps of a model that is used no more
        if ("lm", self.path, what, k) not in kept:
            kept["lm", self.path, what, k] = open_files()
        return kept["lm", self.path, what, k]

    def grams(self, k: int) -> Sorted:
        return self._kept("grams", k, lambda: Sorted(f"{self.path}/grams{k}", self.sizes[k - 1], self.ranges[k - 1], ENTRY if k < 3 else LONG_ENTRY))

    def sides(self, k: int) -> Sides:
        return self._kept("sides", k, lambda: Sides(f"{self.path}/sides{k}", self.spans[k - 1]))

    def count(self, k: int) -> int:
        return sum(self.sizes[k - 1].values())

    def low(self, before: np.ndarray) -> np.ndarray:
        """Lowest-order probability of known words by the number of words seen before them."""
        d = np.array([0.0, *self.discounts[0]])[np.minimum(before, 3)]
        return np.maximum(before - d, 0) / max(self.low_total, 1) + self.low_rest() / (self.vocabulary + 1)

    def low_rest(self) -> float:
        return float(np.dot(self.discounts[0], self.low_few)) / self.low_total if self.low_total else 1.0

    def key(self, before: np.ndarray, word: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return tv.mix(before.astype(_U) * _U(self.vocabulary + 1) + word.astype(_U))

    def walk(self, hashes: np.ndarray, bounds: np.ndarray, orders: int):
        """For k = 1 .. ``orders``: (k, tokens that have a k-gram, number before, word number, number, count) in a text.

        Only tokens whose context is known are gone on with.
        """
        kinds, back = np.unique(hashes, return_inverse=True)
        number, count = self.grams(1).find(kinds)
        word = number[back]
        place = np.arange(len(word)) - np.repeat(bounds[:-1], np.diff(bounds))
        every = np.arange(len(word))
        yield 1, every, None, word, word, count[back]
        # number of the (k-1)-gram that ends before each token; at a text's first word the word number 0
        before = np.concatenate([[0], word[:-1]])
        known = np.concatenate([[True], word[:-1] > 0])
        before[place == 0], known[place == 0] = 0, True
        for k in range(2, orders + 1):
            at = np.flatnonzero(known)
            number, count = np.zeros(len(word), np.int64), np.zeros(len(word), np.int64)
            seen = at[word[at] > 0]
            number[seen], count[seen] = self.grams(k).find(self.key(before[seen], word[seen])) if len(self.sizes) >= k else (0, 0)
            yield k, at, before[at], word[at], number[at], count[at]
            before = np.concatenate([[0], number[:-1]])
            known = (before > 0) & (place >= k - 1)

    def log10(self, hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(log10 probability, training count) of each token of texts with the given bounds."""
        p, seen = np.full(len(hashes), self.low_rest() / (self.vocabulary + 1)), np.zeros(len(hashes), np.int64)
        if not self.vocabulary:
            return np.log10(p), seen
        for k, at, before, _, number, count in self.walk(hashes, bounds, self.order):
            if k == 1:
                side = self.sides(1).of(number)
                p = np.where(number > 0, self.low(side["before"].astype(np.int64)), p)
                seen = np.where(number > 0, count, 0)
                continue
            context = self.sides(k - 1).of(before)
            held = np.flatnonzero(context["total"] > 0)
            at, context, number, count = at[held], context[held], number[held], count[held]
            if k < self.order:
                ends = self.sides(k).of(number)["before"].astype(np.int64)
                count = np.where((ends > 0) & (number > 0), ends, count)
            d = np.array([0.0, *self.discounts[k - 1]])[np.minimum(count, 3)]
            rest = np.stack([context[f] for f in ("f1", "f2", "f3")], 1).astype(float) @ np.array(self.discounts[k - 1])
            total = context["total"].astype(float)
            p[at] = np.maximum(count - d, 0) / total + rest / total * p[at]
        return np.log10(p), seen


def discounts(few) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts from the numbers of keys counted 1 to 4 times."""
    n1, n2, n3, n4 = (max(float(x), 0.0) for x in few)
    if not n1 or not n2 or not n3:
        return (0.5, 0.75, 0.9)
    y = n1 / (n1 + 2 * n2)
    found = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
    return tuple(min(max(x, 0.1), i - 0.05) for i, x in enumerate(found, 1))


def _ranges(n: int, part: int) -> Ranges:
    return Ranges(max(0, int(np.ceil(np.log2(max(n, 1) / part)))))


def _dealt(blobs: DataFrame, files: int) -> DataFrame:
    """Each file's blobs in one task, in order."""
    return blobs.repartitionById(files, "file").sortWithinPartitions("file", "part")


def _grams_of(model: Model, k: int):
    """(keys, counts, numbers without the first word) of the k-grams of texts."""

    def first(data, offsets):
        return token_hashes(data, offsets)[0], None, None

    def longer(data, offsets):
        hashes, bounds = token_hashes(data, offsets)
        ends = None
        for j, at, before, word, number, _ in model.walk(hashes, bounds, k):
            if j < k:
                ends = np.zeros(len(hashes), np.int64)
                ends[at] = number
        return model.key(before, word), None, ends[at].astype(_U) if k > 2 else None

    return first if k == 1 else longer


def _unmix(x: np.ndarray) -> np.ndarray:
    """Inverse of textvec.mix."""
    inv = _U(pow(0xD6E8FEB86659FD93, -1, 2**64))
    with np.errstate(over="ignore"):
        x = x ^ (x >> _U(32))
        x = x * inv
        x ^= x >> _U(32)
        x *= inv
        x ^= x >> _U(32)
    return x


def _side_rows(model: Model, k: int, chunk: int, part: int):
    """From chunks of the files of k-grams: what they add to the (k-1)-grams before and at their end."""
    span = model.spans[k - 2]

    def run(batches):
        for batch in batches:
            for file, lo in zip(batch.column("file").to_pylist(), batch.column("lo").to_pylist(), strict=True):
                grams = model.grams(k)
                m = grams.file(file)[lo : lo + chunk]
                gram, n = _unmix(np.array(m["h"])), np.array(m["n"])
                if k < model.order:
                    ends = model.sides(k).of(grams.start[file] + lo + 1 + np.arange(len(m)))["before"]
                    n = np.where(ends > 0, ends, n)
                left, word = gram // _U(model.vocabulary + 1), gram % _U(model.vocabulary + 1)
                right = np.array(m["s"]) if k > 2 else word
                few = np.minimum(n, _U(3))
                # key: number, then which of the five
                keys = np.concatenate([left * _U(8) + few - _U(1), left * _U(8) + _U(3), right[right > 0] * _U(8) + _U(4)])
                one = np.ones(len(m), np.int64)
                keys, counts, _ = summed(keys, np.concatenate([one, n.astype(np.int64), one[right > 0]]))
                yield _blobs((keys // _U(8 * part)).astype(np.int64), span // part, keys, counts, None)

    return run


def _write_sides(path: str, span: int, part: int, most: int):
    def write(out, file, number, keys, counts, more):
        base = number * part
        n = min(part, most + 1 - base)
        flat = np.zeros((n, 5), "<u8")
        keys = keys.astype(np.int64) - 8 * base
        flat[keys // 8, keys % 8] = counts
        out.seek((base - file * span) * SIDE.itemsize)  # numbers between, of which nothing is known, stay 0
        out.write(flat.tobytes())
        before = flat[:, 4].astype(np.int64)
        return np.array([n, before.sum(), *_few(before)])

    return lambda batches: _whole(path, _merged(batches), write)


def train(docs: DataFrame, text: str = "text", order: int = ORDER) -> Model:
    """Model of all whole texts of ``docs``; a null text is empty and still has its end token.

    Texts may have any length, repeated rows count each time, other columns are not read. An
    empty table gives a model that knows no word. OverflowError: n-grams by words need more than 64 bits.
    """
    if order < 2:
        raise ValueError("order is 2 or more")
    spark = docs.sparkSession
    folder = work_dir(spark, "lm")
    path = mounted(folder)
    os.makedirs(path, exist_ok=True)
    model, part = Model(path, order, folder), PART
    texts = docs.select(named(text).alias("text"))
    with settings(spark, small_batches(128)):  # some rows are arrays of many keys
        # about how many n-grams there will be, for the number of ranges only
        size = texts.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)))).first()[0] or 0
        for k in range(1, order + 1):
            ranges = _ranges(size // (24 if k == 1 else 8), part)
            if k > 1 and (model.count(k - 1) + 1) * (model.vocabulary + 1) >= 2**64:
                raise OverflowError(f"keys of {k}-grams need more than 64 bits")
            blobs = texts.mapInArrow(_count_rows(ranges, HELD, _grams_of(model, k)), BLOB)
            told = _dealt(blobs, 1 << ranges.file_bits).mapInArrow(_write_grams(f"{path}/grams{k}"), TOLD).collect()  # a row for each of 4096 files at most
            if not told:
                return model
            model.ranges.append(ranges)
            model.sizes.append({r.file: r.size for r in told})
            if k == 1:
                model.n_tokens, model.vocabulary = sum(r.total for r in told), model.count(1)
            few = np.sum([r.few for r in told], axis=0)
        # from the highest order down; what stands in the lists is that of order k
        found = [discounts(few[:4])]
        # numbers of a range: fewer, the more (k+1)-grams there are for each
        parts = [max(1, part >> (4 * model.count(k + 1) // model.count(k)).bit_length()) for k in range(1, order)]
        model.spans = [p * -(-(model.count(k) + 1) // (p << FILE_BITS)) for k, p in enumerate(parts, 1)]
        for k in range(order, 1, -1):
            files = -(-(model.count(k - 1) + 1) // model.spans[k - 2])
            chunks = [(f, lo) for f, n in model.sizes[k - 1].items() for lo in range(0, n, part)]
            rows = spark.createDataFrame(chunks, "file long, lo long").repartition(max(1, min(len(chunks), 4 * spark.sparkContext.defaultParallelism)), "file", "lo")
            blobs = rows.mapInArrow(_side_rows(model, k, part, parts[k - 2]), BLOB)
            told = _dealt(blobs, files).mapInArrow(_write_sides(f"{path}/sides{k - 1}", model.spans[k - 2], parts[k - 2], model.count(k - 1)), TOLD).collect()
            few = np.sum([r.few for r in told], axis=0)
            found.append(discounts(few[:4]))
        model.low_total, model.low_few = sum(r.total for r in told), (int(few[0]), int(few[1]), int(few[4]))
        model.discounts = found[::-1]
    return model


def _score_rows(model: Model):
    def run(batches):
        for rows, data, offsets in tv.text_rows(batches):
            hashes, bounds = token_hashes(data, offsets)
            logp, count = model.log10(hashes, bounds)
            base = np.log10((count + 0.5) / (model.n_tokens + 0.5 * (model.vocabulary + 1)))
            n = np.diff(bounds)
            add = lambda x: np.add.reduceat(x, bounds[:-1]) if len(n) else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [rows.column("id"), pa.array(n), pa.array(add((count > 0).astype(np.int64))), pa.array(add(base)), pa.array(add(logp))],
                ["id", "n_tokens", "n_known", "base_score", "score"],
            )

    return run


def score(docs: DataFrame, model: Model, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key``, n_tokens, n_known, base_score, score (log10) and perplexity of each row of ``docs``.

    Tokens are the words, A-Z lower-cased, and one end, so that a null or empty text has one
    token; texts may have any length. Tokens that training did not see share one unknown word's
    probability. Repeated rows get equal scores, rows without id are scored too, other columns
    are not read; an empty table gives an empty result.
    """
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(named(key).alias("id"), named(text).alias("text")).mapInArrow(_score_rows(model), f"id {kind}, n_tokens long, n_known long, base_score double, score double")
    return rows.withColumnRenamed("id", key).withColumn("perplexity", F.pow(F.lit(10.0), F.least(-F.col("score") / F.col("n_tokens"), F.lit(300.0))))


def op4(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 1, F.lit(False))
    model = train(docs.where(~held_out))
    scored = materialize(score(docs, model), "scores")
    delete(model.folder)
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", F.lit(model.n_tokens).cast("long").alias("train_tokens"), "base_score", "score", "perplexity")
