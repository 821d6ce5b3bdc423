"""Token ids in binary shards: Simple-8b, word-aligned, with offsets of blocks.

A shard is one file, little-endian::

    8 bytes   b"S8BSHRD1"
    uint64    number of documents, of ids, of blocks, ids in a block
    int64     id of each document (the least int64: null)
    uint64    tokens of each document
    uint64    place of each block's first word, and of the end
    uint64    words

A word is a selector in its low 4 bits and 60 bits of payload. Selector s packs COUNT[s] ids
of WIDTH[s] bits, lowest first. Selector 15 is an escape: the next word is one raw id of up to
64 bits. Each block is packed on its own, so blocks are decoded independently; within a block
all words of one selector are unpacked at once. Writing and reading go through some blocks at a
time, so that a shard of any size needs little more memory than its ids.
"""

from __future__ import annotations

import json
import os
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hexloom.llm import textvec as tv
from hexloom.llm.workspace import materialize, named, table, work_dir

MAGIC = b"S8BSHRD1"
#: ids in a word by selector; the widths are 60 // count
COUNT = np.array([60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1], np.int64)
WIDTH = 60 // COUNT
ESCAPE = 15
BLOCK_IDS, SHARD_IDS = 4096, 1 << 22
BLOCKS = 128  # packed and unpacked at once
_U = np.uint64
NO_ID = -(2**63)


_WIDTH16 = np.array([max(1, i.bit_length()) for i in range(1 << 16)], np.uint8)


def bit_widths(ids: np.ndarray) -> np.ndarray:
    out = _WIDTH16[(ids & _U(0xFFFF)).astype(np.int64)]
    for shift in (16, 32, 48):
        part = ids >> _U(shift)
        if not part.any():
            break
        high = (part & _U(0xFFFF)).astype(np.int64)
        out = np.where(high > 0, _WIDTH16[high] + np.uint8(shift), out)
    return out


def pack(ids: np.ndarray, block: int = BLOCK_IDS) -> tuple[np.ndarray, np.ndarray]:
    """(words, block places) of unsigned ids."""
    words, places, at = [], [], 0
    for i in range(0, len(ids), BLOCKS * block):
        w, p = _pack(ids[i : i + BLOCKS * block], block)
        words.append(w)
        places.append(p[:-1] + _U(at))
        at += len(w)
    places.append(np.array([at], _U))
    return np.concatenate(words) if words else np.zeros(0, _U), np.concatenate(places)


def _pack(ids: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
    """The same of some blocks, all packed in step, greedily."""
    n = len(ids)
    blocks = -(-n // block)
    if not n:
        return np.zeros(0, _U), np.zeros(1, _U)
    ids = ids.astype(_U)
    # widest id in the next 1, 2, 4 .. 32 places of the block; beyond its end all is too wide
    wide = np.full((blocks, block + 64), 255, np.uint8)
    wide[:, :block].flat[:n] = bit_widths(ids) if n == blocks * block else np.concatenate([bit_widths(ids), np.full(blocks * block - n, 255, np.uint8)])
    reach, step = {1: wide}, 1
    while step < 32:
        reach[2 * step] = np.maximum(reach[step][:, :-step], reach[step][:, step:])
        step *= 2
    # the best selector at each place: the first all of whose ids fit
    best = np.full((blocks, block), ESCAPE, np.int8)
    for s in range(len(COUNT) - 1, -1, -1):
        c = int(COUNT[s])
        p = 1 << (c.bit_length() - 1)
        most = np.maximum(reach[p][:, :block], reach[p][:, c - p : c - p + block])
        np.copyto(best, np.int8(s), where=most <= WIDTH[s])
    best = best.ravel()
    step = np.append(COUNT, [0, 1])
    at = np.arange(blocks) * block
    stop = np.minimum(at + block, n)
    rounds = []
    while (live := at < stop).any():
        rounds.append(at)
        at = at + step[best[np.minimum(at, n - 1)]] * live
    # a block that is done stands at its end until all are
    place = np.stack(rounds, axis=1)
    live = place < stop[:, None]
    firsts = np.cumsum(live.sum(axis=1)) - live.sum(axis=1)
    place = place[live]
    kind = best[place]
    size = 1 + (kind == ESCAPE)
    word_at = np.cumsum(size) - size
    words = np.zeros(int(size.sum()), _U)
    for s in range(len(COUNT)):
        m = np.flatnonzero(kind == s)
        w = np.full(len(m), s, _U)
        for j in range(int(COUNT[s])):
            w |= ids[place[m] + j] << _U(4 + j * int(WIDTH[s]))
        words[word_at[m]] = w
    m = np.flatnonzero(kind == ESCAPE)
    words[word_at[m]] = _U(ESCAPE)
    words[word_at[m] + 1] = ids[place[m]]
    return words, np.append(word_at[firsts], len(words)).astype(_U)


def unpack(words: np.ndarray, places: np.ndarray, n: int, block: int) -> np.ndarray:
    """The ``n`` ids of packed blocks."""
    out = [_unpack(words[int(places[i]) : int(places[min(i + BLOCKS, len(places) - 1)])]) for i in range(0, len(places) - 1, BLOCKS)]
    ids = np.concatenate(out) if out else np.zeros(0, np.uint64)
    if len(ids) != n:
        raise ValueError("the shard's words and its number of ids differ")
    return ids


def _unpack(words: np.ndarray) -> np.ndarray:
    kind = (words & _U(15)).astype(np.int64)
    # a raw id stands after each escape; escapes in a row: every second word is raw
    raw = np.zeros(len(words), bool)
    for i in np.flatnonzero(kind == ESCAPE):
        if not raw[i]:
            raw[i + 1] = True
    count = np.append(COUNT, [0, 1])[kind]
    count[raw] = 0
    start = np.cumsum(count) - count
    out = np.zeros(int(count.sum()), _U)
    for s in range(len(COUNT)):
        m = np.flatnonzero((kind == s) & ~raw)
        mask, w = _U((1 << int(WIDTH[s])) - 1), words[m] >> _U(4)
        for j in range(int(COUNT[s])):
            out[start[m] + j] = (w >> _U(j * int(WIDTH[s]))) & mask
    m = np.flatnonzero((kind == ESCAPE) & ~raw)
    out[start[m]] = words[m + 1]
    return out


def shard_bytes(doc_ids: np.ndarray, sizes: np.ndarray, ids: np.ndarray, block: int = BLOCK_IDS) -> bytes:
    words, places = pack(ids, block)
    head = np.array([len(doc_ids), len(ids), len(places) - 1, block], "<u8")
    return b"".join([MAGIC, head.tobytes(), doc_ids.astype("<i8").tobytes(), sizes.astype("<u8").tobytes(), places.astype("<u8").tobytes(), words.astype("<u8").tobytes()])


def read_shard(raw) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document ids, tokens of each, all ids) of a shard file."""
    if bytes(raw[:8]) != MAGIC:
        raise ValueError("not a shard")
    docs, n, blocks, block = (int(x) for x in np.frombuffer(raw, "<u8", 4, 8))
    at = 40
    doc_ids = np.frombuffer(raw, "<i8", docs, at)
    sizes = np.frombuffer(raw, "<u8", docs, at + 8 * docs).astype(np.int64)
    places = np.frombuffer(raw, "<u8", blocks + 1, at + 16 * docs)
    words = np.frombuffer(raw, "<u8", int(places[-1]), at + 16 * docs + 8 * (blocks + 1))
    return doc_ids, sizes, unpack(words, places, n, block)


class Crossing(Exception):
    """A token reaches over a place where a text was cut."""


class UnitEncoder:
    """Encodes texts with a file of the tokenizers library, as the library does.

    With a byte-level splitting pattern texts are cut where the pattern always cuts, whatever
    stands farther off, so the ids of the cuts are those of the text: before a single space and
    on both sides of a single line feed that stand between two characters that are not white,
    and between letters, digits and other characters (``_kinds``), but not after an apostrophe.
    Strings of special tokens stay whole. Each different cut is encoded once and kept. Other
    vocabularies, and those with special tokens that hold or swallow white space, get whole
    texts; so do texts in which a token would reach over a cut. The strings of special tokens
    become those tokens, as in the library, or ordinary text if ``special_as_text``.
    """

    MOST = 2_000_000

    def __init__(self, path: str, special_as_text: bool = False) -> None:
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = special_as_text
        setup = json.loads(self.tokenizer.to_str())
        special = setup["added_tokens"]
        split = setup["pre_tokenizer"] or {}
        self.cuttable = not setup["normalizer"] and split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space")
        self.cuttable &= not any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] or any(c.isspace() for c in t["content"]) for t in special)
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in printable]
        table = {chr(b): 1 for b in printable} | {chr(256 + i): 1 for i, _ in enumerate(others)}
        vocabulary = self.tokenizer.get_vocab()
        self.width = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for piece, i in vocabulary.items():
            self.width[i] = len(piece) if all(c in table for c in piece) else 0
        for t in special:
            self.width[t["id"]] = len(t["content"].encode())
        self.special = [t["content"].encode() for t in special if t["content"]]
        self.clear()

    def clear(self) -> None:
        self.units, self.ids = tv.KeyIndex(), np.zeros(0, np.uint16 if len(self.width) <= 1 << 16 else np.uint32)

    def plain(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def learn(self, data: np.ndarray, start: np.ndarray, end: np.ndarray, keys: np.ndarray) -> None:
        """Encodes cuts that are not kept yet, some hundreds at a time as one text."""
        sizes, found = np.zeros(len(keys), np.int64), []
        # cuts that begin with that space, and end in no white space, keep their ids when laid end to end;
        # those that begin in no white space either keep them with a line feed after each
        after = data[np.minimum(start + 1, len(data) - 1)]
        closed = _solid(data[end - 1]) | ((data[end - 1] >= 128) & _latin(data, end - 1))
        spaced = closed & (data[start] == 32) & (end - start > 1)
        spaced &= _solid(after) | ((after >= 128) & _latin(data, start + 1, ahead=True))
        bare = closed & (_solid(data[start]) | ((data[start] >= 128) & _latin(data, start, ahead=True)))
        groups = np.flatnonzero(spaced), np.flatnonzero(bare)
        order = np.concatenate([*groups, np.flatnonzero(~spaced & ~bare)])
        done = 0
        for feed, group in enumerate(groups):
            for i in range(0, len(group), 512):
                some = group[i : i + 512]
                long = end[some] - start[some] + feed
                stop = np.cumsum(long)
                laid = data[np.minimum(np.repeat(start[some] - (stop - long), long) + np.arange(stop[-1]), len(data) - 1)]
                if feed:
                    laid[stop - 1] = 10
                ids = np.array(self.plain([laid.tobytes().decode()])[0], np.uint32)
                reach = np.cumsum(self.width[ids])
                count = np.searchsorted(reach, stop, "right")
                if not np.array_equal(reach[count - 1], stop) or (feed and not np.array_equal(reach[count - 2], stop - 1)):
                    raise Crossing
                sizes[done : done + len(some)] = np.diff(count, prepend=0) - feed
                found.append(np.delete(ids, count - 1) if feed else ids)
                done += len(some)
        rest = order[done:]
        if len(rest):
            for j, ids in enumerate(self.plain([data[start[u] : end[u]].tobytes().decode() for u in rest]), done):
                sizes[j] = len(ids)
                found.append(np.array(ids, np.uint32))
        self.units.keep(keys[order], np.cumsum(sizes) - sizes + len(self.ids), sizes)
        self.ids = np.concatenate([self.ids, *(f.astype(self.ids.dtype) for f in found)])

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets of each text's ids) of texts laid end to end."""
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        if self.cuttable:
            try:
                return self.by_cuts(data, offsets)
            except Crossing:
                pass
        raw = data.tobytes()
        each = self.plain([raw[i:j].decode() for i, j in zip(offsets[:-1], offsets[1:], strict=True)])
        return np.array([i for e in each for i in e], np.uint32), np.cumsum([0, *map(len, each)])

    def cuts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """The places of the cuts, the ends of texts among them."""
        n = len(data)
        cut = np.zeros(n + 1, bool)
        kinds, raw = _kinds(data), data.tobytes()
        cut[1:n] = (kinds[1:] != kinds[:-1]) & (kinds[1:] > 0) & (kinds[:-1] > 0) & (data[:-1] != 39)
        for text in self.special:
            at = raw.find(text)
            while at >= 0:
                cut[at + 1 : at + len(text)] = False
                at = raw.find(text, at + 1)
        # single spaces and line feeds; before and after them a character that is known not to be white
        one = np.flatnonzero((data[1 : n - 1] == 32) | (data[1 : n - 1] == 10)) + 1
        before, after = data[one - 1], data[np.minimum(one + 1, n - 1)]
        one = one[(_solid(before) | ((before >= 128) & _latin(data, one - 1))) & (_solid(after) | ((after >= 128) & _latin(data, one + 1, ahead=True)))]
        cut[one] = True
        cut[one[data[one] == 10] + 1] = True
        cut[offsets] = True
        return np.flatnonzero(cut)

    def by_cuts(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n, at = len(data), self.cuts(data, offsets)
        start, end = at[:-1], at[1:]
        up, down = tv.powers(n + 1)
        with np.errstate(over="ignore"):
            total = np.zeros(n + 1, _U)
            np.cumsum(tv.BYTE[data] * up[:n], out=total[1:])
            h = tv.mix((total[end] - total[start]) * down[start] + (end - start).astype(_U) * _U(0xA24BAED4963EE407))
        order = np.argsort(h)
        h = h[order]
        new = np.ones(len(h), bool)
        new[1:] = h[1:] != h[:-1]
        keys, first, back = h[new], order[new], np.empty(len(h), np.int64)
        back[order] = np.cumsum(new) - 1
        begin, size = self.units.find(keys)
        if (new := size < 0).any():
            if self.units.kept + int(new.sum()) > self.MOST:
                self.clear()
                new[:] = True
            self.learn(data, start[first[new]], end[first[new]], keys[new])
            begin[new], size[new] = self.units.find(keys[new])
        del total, h, order
        size, begin = size[back], begin[back]
        stop = np.cumsum(size)
        ids = self.ids[np.repeat(begin - (stop - size), size) + np.arange(stop[-1])]
        ends = np.concatenate([[0], stop])
        return ids, ends[np.searchsorted(start, offsets)]


def _solid(data: np.ndarray) -> np.ndarray:
    """ASCII that is neither white space nor a control character."""
    return (data > 32) & (data < 127)


_KIND = np.zeros(256, np.uint8)
_KIND[33:127] = 3
_KIND[48:58] = 2
_KIND[65:91] = _KIND[97:123] = 1


def _kinds(data: np.ndarray) -> np.ndarray:
    """Of each byte, whether its character is a letter (1), a digit (2), another one that is not white (3), or not told (0).

    Beyond ASCII it is told of the letters U+00C0 to U+027F only, all but two characters there.
    """
    out = _KIND[data]
    at = np.flatnonzero((data >= 0xC3) & (data <= 0xC9))
    tail = data[at + 1]
    at = at[(data[at] != 0xC3) | ((tail != 0x97) & (tail != 0xB7))]
    out[at] = out[at + 1] = 1
    return out


def _latin(data: np.ndarray, at: np.ndarray, ahead: bool = False) -> np.ndarray:
    """Whether the two-byte character that ends (or begins) at these places is no white space."""
    if ahead:
        at = np.minimum(at, len(data) - 1)
        lead, tail = data[at], data[np.minimum(at + 1, len(data) - 1)]
    else:
        lead, tail = data[np.maximum(at - 1, 0)], data[at]
    two = (lead >= 0xC2) & (lead <= 0xDF) & (tail & 0xC0 == 0x80)
    # U+0085 and U+00A0 are white space
    return two & ~((lead == 0xC2) & ((tail == 0x85) | (tail == 0xA0)))


def encoder(path: str, special_as_text: bool = False) -> UnitEncoder:
    kept = tv.process_cache()
    if ("units", path, special_as_text) not in kept:
        kept["units", path, special_as_text] = UnitEncoder(path, special_as_text)
    return kept["units", path, special_as_text]


def _store(folder: str):
    """File system and path of a folder: a mounted one, or any that Arrow opens by its address."""
    from pyarrow import fs

    address = folder.replace("s3a://", "s3://", 1)
    return (fs.LocalFileSystem(), folder) if "://" not in address and not address.startswith("file:") else fs.FileSystem.from_uri(address if "://" in address else "file://" + address.removeprefix("file:"))


SHARDS = "shard string, part long, place long, n_docs long, n_ids long"


def _write_rows(folder: str, vocabulary: str, special_as_text: bool, end_id: int, most: int):
    def run(batches):
        from pyspark import TaskContext

        store, root = _store(folder)
        part, made = TaskContext.get().partitionId(), 0
        coder = encoder(vocabulary, special_as_text)
        docs, sizes, ids, held = [], [], [], 0

        def flush():
            nonlocal docs, sizes, ids, held, made
            every = np.concatenate(ids)
            n = np.concatenate(sizes)
            name = f"shard-{part:06d}-{made:06d}.s8b"
            own = f"{root}/.{name}.{os.getpid()}"
            with store.open_output_stream(own) as f:
                f.write(shard_bytes(np.concatenate(docs), n, every))
            store.move(own, f"{root}/{name}")  # a task that runs again replaces its files by the same bytes
            row = pa.RecordBatch.from_arrays([pa.array([x]) for x in (name, part, made, len(n), len(every))], ["shard", "part", "place", "n_docs", "n_ids"])
            docs, sizes, ids, held, made = [], [], [], 0, made + 1
            return row

        for rows, data, offsets in tv.text_rows(batches):
            got, bounds = coder.encode(data, offsets)
            n = np.diff(bounds)
            # an end id after each text
            every = np.full(len(got) + len(n), end_id, np.uint32)
            owner = np.repeat(np.arange(len(n)), n)
            every[np.arange(len(got)) + owner] = got
            docs.append(np.array([NO_ID if k is None else k for k in rows.column("id").to_pylist()], np.int64))
            sizes.append(n + 1)
            ids.append(every)
            held += len(every)
            if held >= most:
                yield flush()
        if docs:
            yield flush()

    return run


def write_ids(docs: DataFrame, folder: str, vocabulary: str, end_id: int = 2, text: str = "text", key: str = "doc_id", shard_ids: int = SHARD_IDS, special_as_text: bool = False) -> DataFrame:
    """Writes the ids of all whole texts, in ascending ``key`` order, as shards in a shared folder.

    Returns the manifest, a written table: shard, part and place (its order), n_docs, n_ids and
    ``start``, the ids before it. Rows without id come first; rows of one id are in no fixed
    order unless their texts differ. A null or empty text has the end id only; texts may have
    any length. The least 64-bit id stands for null in the files. Other columns are not
    read. An empty table gives no shard.
    """
    spark = docs.sparkSession
    store, root = _store(folder)
    store.create_dir(root, recursive=True)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(named(key).cast("long").alias("id"), named(text).alias("text"), F.xxhash64(named(text)).alias("tie"))
    rows = rows.repartitionByRange(n, "id", "tie").sortWithinPartitions("id", "tie").select("id", "text")
    told = materialize(rows.mapInArrow(_write_rows(folder, vocabulary, special_as_text, end_id, shard_ids), SHARDS), "shards")
    # running sums in two steps: over the parts, which are as many as partitions, and inside each
    earlier = lambda w, by: F.coalesce(F.sum("n_ids").over(w.orderBy(by).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = told.groupBy("part").agg(F.sum("n_ids").alias("n_ids"))
    parts = parts.select("part", earlier(Window.partitionBy(F.lit(0)), "part").alias("before"))
    return told.join(parts, "part").select(*told.columns, (F.col("before") + earlier(Window.partitionBy("part"), "place")).alias("start"))


def _read_rows(batches):
    for batch in batches:
        for name, raw in zip(batch.column("shard").to_pylist(), batch.column("content"), strict=True):
            docs, sizes, ids = read_shard(raw.as_buffer())
            ids = ids.astype("<u4")
            at = np.concatenate([[0], np.cumsum(sizes)])
            crc = [zlib.crc32(ids[i:j]) for i, j in zip(at[:-1], at[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(docs)), pa.array(docs, mask=docs == NO_ID), pa.array(at[:-1]), pa.array(sizes), pa.array(crc, pa.int64())],
                ["shard", "doc_id", "at", "n_tokens", "ids_crc32"],
            )


def read_digests(manifest: DataFrame, folder: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of each document, decoded from the shard files of a manifest.

    The starts of shards are joined to the decoded rows, not to the files' contents. No shard
    gives an empty result.
    """
    spark = manifest.sparkSession
    files = spark.read.format("binaryFile").load(folder).select(F.element_at(F.split("path", "/"), -1).alias("shard"), "content")
    rows = files.mapInArrow(_read_rows, "shard string, doc_id long, at long, n_tokens long, ids_crc32 long")
    return rows.join(manifest.select("shard", "start"), "shard").select("doc_id", (F.col("start") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def op6(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    folder = work_dir(spark, "ids")
    manifest = write_ids(table(spark, sf_dir, "documents"), folder, public_tokenizers.path("byte_bpe_50k.json"))
    return read_digests(manifest, folder)
