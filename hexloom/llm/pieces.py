"""SentencePiece BPE encoding with seeded merge-dropout, and decoding.

Encoding repeats the merge agenda of a BPE vocabulary: of all neighbouring pairs whose
concatenation is a piece, the best-scored one (leftmost among equals) is merged next. A
candidate is skipped for good if a keyed hash of (seed, text's key, number of the word in the text,
its first character's place in the word, merged piece) falls below the dropout rate, so a text
has the same pieces in every run, and other pieces under another seed.

Texts are cut into words before each run of spaces (no piece of the vocabulary crosses such a
cut), and all words of one length go through the agenda in step, as rows of a matrix. What a
word becomes depends only on which of its candidates are skipped: those are hashed for every
occurrence, and occurrences of one word that skip the same ones share one run of the agenda. Very
long words go through the same agenda with a heap, each occurrence on its own.

Spaces become U+2581, a space is set before each text, and characters outside the
vocabulary, among them a literal U+2581, become byte pieces. So decoding is exact.
"""

from __future__ import annotations

import heapq
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hexloom.llm import textvec as tv
from hexloom.llm.workspace import named, table, unboxed

SPACE = 0x2581
RATE, SEED = 0.1, 1
WIDE, ROWS = 48, 4096
_U = np.uint64
NEVER = np.int32(2**31 - 1)
#: kinds of what a worker keeps from task to task
KEPT = ("pieces", "words", "candidates")


_SEED, _WORD = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95
_LOW = 2**64 - 1


def candidate_hash(seed: int, place, piece) -> np.ndarray:
    """64-bit hash of merge candidates: the merged piece and its place in the word."""
    with np.errstate(over="ignore"):
        return tv.mix(np.asarray(place).astype(_U) + (np.asarray(piece).astype(_U) << _U(24)) + _U(seed * _SEED & _LOW))


def keep_hash(candidate: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Keyed hash of candidates in the occurrences ``word`` of a word."""
    with np.errstate(over="ignore"):
        return tv.mix(candidate + np.asarray(word).astype(_U) * _U(_WORD))


def _mix(x: int) -> int:
    """textvec.mix of one whole number."""
    x ^= x >> 32
    x = x * 0xD6E8FEB86659FD93 & _LOW
    x ^= x >> 32
    x = x * 0xD6E8FEB86659FD93 & _LOW
    return x ^ x >> 32


def word_hash(code: np.ndarray, total: np.ndarray, down: np.ndarray, start: np.ndarray, length) -> np.ndarray:
    """Hashes of runs of characters, from the running sums of :func:`running`."""
    with np.errstate(over="ignore"):
        return tv.mix((total[start + length] - total[start]) * down[start] + np.asarray(length).astype(_U) * _U(0xA24BAED4963EE407))


def running(code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n = len(code)
    up, down = tv.powers(n + 1)
    with np.errstate(over="ignore"):
        total = np.zeros(n + 1, _U)
        np.cumsum(tv.mix(code.astype(_U) + _U(7)) * up[:n], out=total[1:])
    return total, down


class Table:
    """Whole numbers under 64-bit keys, by open addressing: whole batches are looked up at once."""

    def __init__(self, keys: np.ndarray, values: np.ndarray) -> None:
        self.shift = _U(64 - max(4, (4 * len(keys)).bit_length()))
        size = 1 << (64 - int(self.shift))
        self.keys, self.values, used = np.zeros(size, np.int64), np.full(size, -1, np.int32), np.zeros(size, bool)
        left, slot = np.arange(len(keys)), self._slot(keys)
        while len(left):
            free = np.flatnonzero(~used[slot])
            at, one = np.unique(slot[free], return_index=True)
            took = free[one]
            used[at], self.keys[at], self.values[at] = True, keys[left[took]], values[left[took]]
            stay = np.ones(len(left), bool)
            stay[took] = False
            left, slot = left[stay], (slot[stay] + 1) & (size - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((keys.view(_U) * _U(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Value of each key, or -1."""
        slot = self._slot(keys)
        out = self.values[slot]
        left = np.flatnonzero((self.keys[slot] != keys) & (out >= 0))
        while len(left):
            slot[left] = (slot[left] + 1) & (len(self.keys) - 1)
            out[left] = self.values[slot[left]]
            left = left[(self.keys[slot[left]] != keys[left]) & (out[left] >= 0)]
        return out


class Vocabulary:
    """Pieces, bytes and merges of a SentencePiece BPE model with byte fallback."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        special = [sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) for i in range(n)]
        byte = [sp.is_byte(i) for i in range(n)]
        names = [sp.id_to_piece(i) for i in range(n)]
        self.size = n
        self.byte_id = np.zeros(256, np.int64)
        self.raw = []
        for i, name in enumerate(names):
            if byte[i]:
                self.byte_id[int(name[3:5], 16)] = i
                self.raw.append(bytes([int(name[3:5], 16)]))
            else:
                self.raw.append(b"" if special[i] else name.replace("▁", " ").encode())
        self.length = np.array([len(r) for r in self.raw], np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.blob = np.frombuffer(b"".join(self.raw), np.uint8)
        plain = {name: i for i, name in enumerate(names) if not special[i] and not byte[i]}
        self.char = np.full(0x110000, -1, np.int32)
        for name, i in plain.items():
            if len(name) == 1:
                self.char[ord(name)] = i
        # agenda order: best score first, lower id among equal scores
        by = sorted(plain.values(), key=lambda i: (-sp.get_score(i), i))
        self.rank = np.full(n, NEVER, np.int32)
        self.rank[by] = np.arange(len(by), dtype=np.int32)
        keys, merged = [], []
        for name, i in plain.items():
            if "▁" in name.lstrip("▁"):
                continue  # a piece over a cut is never made
            for cut in range(1, len(name)):
                a, b = plain.get(name[:cut]), plain.get(name[cut:])
                if a is not None and b is not None:
                    keys.append((a << 32) | b)
                    merged.append(i)
        self.pairs = Table(np.array(keys, np.int64), np.array(merged, np.int32))
        self.table = dict(zip(keys, merged, strict=True))
        self.ranks = self.rank.tolist()
        # hashes of the pieces that a merge can make, as they stand in a text
        made = sorted(set(merged))
        size = np.array([len(names[i]) for i in made], np.int64)
        code = np.frombuffer("".join(names[i].replace("▁", " ") for i in made).encode("utf-32-le"), "<u4")
        total, down = running(code)
        h = word_hash(code, total, down, np.cumsum(size) - size, size)
        self.made = Table(h.view(np.int64), np.array(made, np.int32))
        self.longest = int(size.max(initial=1))

    def join(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Piece of each pair's concatenation, or -1."""
        found = self.pairs.find((a.astype(np.int64) << 32) | b.astype(np.int64))
        found[(a < 0) | (b < 0)] = -1
        return found


def heap_agenda(voc: Vocabulary, symbols: list[int], word: int, seed: int, rate: float) -> list[int]:
    """Pieces of one word under its 64-bit key; ``symbols``: its characters' pieces, negative ones never merge."""
    limit = min(int(rate * 2**64), _LOW)
    n, key, base = len(symbols), word * _WORD & _LOW, seed * _SEED & _LOW
    piece, place = list(symbols), list(range(n))
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    alive, agenda = [True] * n, []

    def offer(i: int) -> None:
        j = after[i] if i >= 0 else n
        if i < 0 or j >= n or piece[i] < 0 or piece[j] < 0:
            return
        m = voc.table.get((piece[i] << 32) | piece[j], -1)
        if m >= 0 and _mix((_mix((place[i] + (m << 24) + base) & _LOW) + key) & _LOW) >= limit:
            heapq.heappush(agenda, (voc.ranks[m], place[i], i, j, piece[i], piece[j], m))

    for i in range(n - 1):
        offer(i)
    while agenda:
        _, _, i, j, a, b, m = heapq.heappop(agenda)
        if not (alive[i] and alive[j] and piece[i] == a and piece[j] == b and after[i] == j):
            continue
        piece[i], alive[j] = m, False
        after[i] = after[j]
        if after[i] < n:
            before[after[i]] = i
        offer(before[i])
        offer(i)
    return [piece[i] for i in range(n) if alive[i]]


def matrix_agenda(voc: Vocabulary, words: np.ndarray, length: np.ndarray, word: np.ndarray, seed: int, rate: float) -> tuple[np.ndarray, np.ndarray]:
    """The same for the rows of a matrix of words, the rest of a row being -1: (pieces, number of pieces of each row)."""
    limit = _U(min(int(rate * 2**64), _LOW))
    n, width = words.shape
    out, size = words.astype(np.int32).copy(), length.astype(np.int64).copy()
    if width < 2:
        return out, size
    sym = out.copy()
    place = np.broadcast_to(np.arange(width, dtype=np.int32), (n, width)).copy()

    def rated(key, a, b, at):
        m = voc.join(a, b)
        r = np.full(len(m), NEVER, np.int32)
        ok = np.flatnonzero(m >= 0)
        if len(ok):
            keep = ok[keep_hash(candidate_hash(seed, at[ok], m[ok]), key[ok]) >= limit]
            r[keep] = voc.rank[m[keep]]
        return r, m

    rank, made = rated(np.repeat(word, width - 1), sym[:, :-1].ravel(), sym[:, 1:].ravel(), place[:, :-1].ravel())
    rank, made = rank.reshape(n, width - 1), made.reshape(n, width - 1)
    live, many, key = np.arange(n), size.copy(), word
    span = np.arange(width)
    while True:
        best = rank.argmin(axis=1)
        row = np.arange(len(live))
        go = rank[row, best] != NEVER
        if not go.all():
            # rows without candidates are done
            done = ~go
            out[live[done]], size[live[done]] = sym[done], many[done]
            live, many, key, best = live[go], many[go], key[go], best[go]
            if not len(live):
                return out, size
            sym, place, rank, made = sym[go], place[go], rank[go], made[go]
            row = row[: len(live)]
        sym[row, best] = made[row, best]
        many -= 1
        # what stands right of the pair moves one place to the left
        shift = np.minimum(span[None, :] + (span[None, :] > best[:, None]), width - 1)
        flat = shift + (row * width)[:, None]
        sym, place = sym.ravel()[flat], place.ravel()[flat]
        flat = np.minimum(shift[:, : width - 1], width - 2) + (row * (width - 1))[:, None]
        rank, made = rank.ravel()[flat], made.ravel()[flat]
        rank[row, np.minimum(many - 1, width - 2)] = NEVER
        left, right = np.flatnonzero(best > 0), np.flatnonzero(best + 1 < many)
        r, c = np.concatenate([left, right]), np.concatenate([best[left] - 1, best[right]])
        rank[r, c], made[r, c] = rated(key[r], sym[r, c], sym[r, c + 1], place[r, c])


class Coder:
    def __init__(self, path: str, rate: float = RATE, seed: int = SEED) -> None:
        kept = tv.process_cache()
        if ("pieces", path) not in kept:
            kept["pieces", path] = Vocabulary(path)
        self.voc, self.rate, self.seed = kept["pieces", path], rate, seed
        # words that were worked out before, by what they skip; and the candidates of words
        self.words, self.pool = kept.setdefault(("words", path, rate, seed), (tv.KeyIndex(), [np.zeros(0, np.int32)]))
        self.known, self.offers = kept.setdefault(("candidates", path, seed), (tv.KeyIndex(), [np.zeros(0, _U)]))

    #: words, and numbers in a pool, kept by a worker, about
    MOST, MOST_POOL = 800_000, 1 << 23

    def _trim(self, index: tv.KeyIndex, pool: list) -> None:
        if index.kept > self.MOST or len(pool[0]) > self.MOST_POOL:
            index.__init__()
            pool[:] = [pool[0][:0]]

    def skipped(self, h: np.ndarray, start: np.ndarray, length: np.ndarray, word: np.ndarray, code: np.ndarray, total: np.ndarray, down: np.ndarray) -> np.ndarray:
        """For each occurrence a hash of the candidates that it skips (0: none).

        Candidates are all places of a word where a piece that a merge can make stands.
        """
        kinds, first, back = np.unique(h, return_index=True, return_inverse=True)
        self._trim(self.known, self.offers)
        at, counts = self.known.find(kinds)
        new = np.flatnonzero(counts < 0)
        if len(new):
            k_start, k_len = start[first[new]], length[first[new]]
            owner, found = [], []
            for size in range(2, min(self.voc.longest, int(k_len.max())) + 1):
                fits = np.flatnonzero(k_len >= size)
                n = k_len[fits] - size + 1
                row = np.repeat(fits, n)
                place = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
                sub = word_hash(code, total, down, k_start[row] + place, np.full(len(row), size))
                piece = self.voc.made.find(sub.view(np.int64))
                hit = np.flatnonzero(piece >= 0)
                owner.append(row[hit])
                found.append(candidate_hash(self.seed, place[hit], piece[hit]))
            owner = np.concatenate(owner) if owner else np.zeros(0, np.int64)
            found = np.concatenate(found) if found else np.zeros(0, _U)
            by = np.argsort(owner, kind="stable")
            counts[new] = np.bincount(owner, minlength=len(new))
            at[new] = np.cumsum(counts[new]) - counts[new] + len(self.offers[0])
            self.offers[0] = np.concatenate([self.offers[0], found[by]])
            self.known.keep(kinds[new], at[new], counts[new])
        out = np.zeros(len(h), _U)
        limit = _U(min(int(self.rate * 2**64), _LOW))
        step = 1 << 16  # occurrences at once
        for lo in range(0, len(h), step):
            n, where = counts[back[lo : lo + step]], at[back[lo : lo + step]]
            owner = np.repeat(np.arange(len(n)), n)
            offer = self.offers[0][np.repeat(where - (np.cumsum(n) - n), n) + np.arange(len(owner))]
            gone = np.flatnonzero(keep_hash(offer, word[lo : lo + step][owner]) < limit)
            if len(gone):
                who = owner[gone]
                cut = np.flatnonzero(np.diff(who, prepend=-1))
                with np.errstate(over="ignore"):
                    out[lo + who[cut]] = np.add.reduceat(tv.mix(offer[gone] ^ _U(0x632BE59BD9B4E019)), cut) | _U(1)
        return out

    def encode(self, texts: list[str], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(piece ids, offsets of each text's ids) of texts under the given 64-bit keys."""
        voc = self.voc
        size = np.array([len(t) + 1 for t in texts], np.int64)
        code = np.frombuffer("".join(" " + t for t in texts).encode("utf-32-le", "surrogatepass"), "<u4")
        bounds = np.concatenate([[0], np.cumsum(size)])
        n = len(code)
        if not n:
            return np.zeros(0, np.int64), np.zeros(len(texts) + 1, np.int64)
        blank = code == 32
        sym = voc.char[code]
        sym[blank] = voc.char[SPACE]
        sym[code == SPACE] = -1
        # characters without a piece: no merge; told apart by their code point
        sym = np.where(sym < 0, -2 - code.astype(np.int32), sym)
        begin = blank.copy()
        begin[1:] &= ~blank[:-1]
        begin[bounds[:-1]] = True
        start = np.flatnonzero(begin)
        length = np.diff(np.append(start, n))
        text = np.searchsorted(bounds, start, "right") - 1
        number = np.arange(len(start)) - np.searchsorted(start, bounds[:-1])[text]
        with np.errstate(over="ignore"):
            word = tv.mix(tv.mix(keys[text] + _U(3)) * _U(0x9E3779B97F4A7C15) + number.astype(_U))
            total, down = running(code)
            h = word_hash(code, total, down, start, length)
            if self.rate:
                some = np.flatnonzero(length <= WIDE)
                skip = tv.mix(word)  # of a long word: each occurrence on its own
                skip[some] = self.skipped(h[some], start[some], length[some], word[some], code, total, down)
                h = tv.mix(h + skip * _U(0x632BE59BD9B4E019))
        kinds, first, back = np.unique(h, return_index=True, return_inverse=True)
        self._trim(self.words, self.pool)
        at, counts = self.words.find(kinds)
        new = np.flatnonzero(counts < 0)
        held = len(self.pool[0])
        pool = [self.pool[0]]
        k_start, k_len, k_word = start[first[new]], length[first[new]], word[first[new]]
        n_at, n_count = np.zeros(len(new), np.int64), np.zeros(len(new), np.int64)
        order = np.argsort(k_len, kind="stable")
        short = int(np.searchsorted(k_len[order], WIDE, "right"))
        for u in order[short:]:
            pool.append(np.array(heap_agenda(voc, sym[k_start[u] : k_start[u] + k_len[u]].tolist(), int(k_word[u]), self.seed, self.rate), np.int32))
            n_count[u], n_at[u] = len(pool[-1]), held
            held += len(pool[-1])
        for s in range(0, short, ROWS):
            # words of about one length: what is beyond a word never merges
            some = order[s : min(s + ROWS, short)]
            span = np.arange(int(k_len[some].max()))
            spot = np.minimum(k_start[some][:, None] + span, n - 1)
            got, many = matrix_agenda(voc, np.where(span < k_len[some][:, None], sym[spot], -1), k_len[some], k_word[some], self.seed, self.rate)
            pool.append(got[span < many[:, None]])
            n_count[some], n_at[some] = many, held + np.cumsum(many) - many
            held += len(pool[-1])
        at[new], counts[new] = n_at, n_count
        if len(new):
            self.pool[0] = np.concatenate(pool)
            self.words.keep(kinds[new], n_at, n_count)
        pool = self.pool[0]
        many, where = counts[back], at[back]
        stop = np.cumsum(many)
        ids = pool[np.repeat(where - (stop - many), many) + np.arange(stop[-1])].astype(np.int64)
        per_text = np.concatenate([[0], stop])[np.searchsorted(start, bounds)]
        if (odd := np.flatnonzero(ids < 0)).size:
            raw = [chr(-2 - int(i)).encode("utf-8", "surrogatepass") for i in ids[odd]]
            grow = np.ones(len(ids), np.int64)
            grow[odd] = [len(r) for r in raw]
            new_at = np.cumsum(grow) - grow
            out = np.zeros(int(grow.sum()), np.int64)
            plain = ids >= 0
            out[new_at[plain]] = ids[plain]
            spots = np.repeat(new_at[odd] - (np.cumsum(grow[odd]) - grow[odd]), grow[odd]) + np.arange(int(grow[odd].sum()))
            out[spots] = voc.byte_id[np.frombuffer(b"".join(raw), np.uint8)]
            per_text = np.append(new_at, len(out))[per_text]
            ids = out
        return ids, per_text

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> list[bytes]:
        """UTF-8 texts of piece ids, without the space before each."""
        voc = self.voc
        size = voc.length[ids]
        stop = np.cumsum(size)
        data = voc.blob[np.repeat(voc.start[ids] - (stop - size), size) + np.arange(int(stop[-1]) if len(stop) else 0)].tobytes()
        at = np.concatenate([[0], stop])[bounds]
        return [data[i + 1 : j] for i, j in zip(at[:-1], at[1:], strict=True)]


def _encode_rows(path: str, rate: float, seed: int, text: str, check: bool):
    @tv.tidy(*KEPT)
    def run(batches):
        coder = Coder(path, rate, seed)
        for batch in batches:
            for lo, hi in tv.row_blocks(tv.flat(batch.column("row").field(text))[1], tv.BLOCK):
                rows = batch.slice(lo, hi - lo)
                texts = [t or "" for t in rows.column("row").field(text).to_pylist()]
                ids, bounds = coder.encode(texts, rows.column("key").to_numpy(zero_copy_only=False).view(_U))
                lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids.astype(np.int32)))
                more = [pa.array([b == t.encode() for b, t in zip(coder.decode(ids, bounds), texts, strict=True)])] if check else []
                yield pa.RecordBatch.from_arrays([rows.column("row"), lists, *more], ["row", "pieces", *["lossless"] * check])

    return run


def encode(docs: DataFrame, path: str, rate: float = RATE, seed: int = SEED, text: str = "text", key: str = "doc_id", check: bool = False) -> DataFrame:
    """Rows of ``docs`` with ``pieces``, the piece ids of each whole text.

    The same seed, key, text and rate give the same pieces; rate 0 gives those of the library. A
    null text counts as empty and has the one space piece; a null key is a key of its own.
    Texts may have any length. Repeated rows get equal pieces; an empty table gives an empty
    result. An existing column ``pieces`` is replaced; others may have any names. ``check`` also
    decodes the pieces in the same task and tells in ``lossless`` if they give the text.
    """
    new = [T.StructField("pieces", T.ArrayType(T.IntegerType())), *[T.StructField("lossless", T.BooleanType())] * check]
    rows = docs.select(F.struct(*map(named, docs.columns)).alias("row"), F.xxhash64(named(key)).alias("key"))
    out = rows.mapInArrow(_encode_rows(path, rate, seed, text, check), T.StructType([rows.schema["row"], *new]))
    return out.select(*unboxed([c for c in docs.columns if c not in {f.name for f in new}], *(f.name for f in new)))


def _decode_rows(path: str, column: str):
    @tv.tidy(*KEPT)
    def run(batches):
        coder = Coder(path)
        for batch in batches:
            for lo in range(0, len(batch), 256):
                rows = batch.slice(lo, 256)
                lists = rows.column("row").field(column)
                lists = lists.fill_null([]) if lists.null_count else lists
                sizes = np.array(lists.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
                bounds = np.concatenate([[0], np.cumsum(sizes)])
                texts = coder.decode(lists.flatten().to_numpy().astype(np.int64), bounds)
                yield pa.RecordBatch.from_arrays([rows.column("row"), pa.array([t.decode("utf-8", "replace") for t in texts], pa.string())], ["row", "decoded"])

    return run


def decode(rows: DataFrame, path: str, column: str = "pieces") -> DataFrame:
    """Rows with ``decoded``, the text of the piece ids in ``column``; null lists give empty texts.

    A column ``decoded`` is replaced; others may have any names.
    """
    boxes = rows.select(F.struct(*map(named, rows.columns)).alias("row"))
    out = boxes.mapInArrow(_decode_rows(path, column), T.StructType([boxes.schema["row"], T.StructField("decoded", T.StringType())]))
    return out.select(*unboxed([c for c in rows.columns if c != "decoded"], "decoded"))


def _round_trip(path: str, rate: float, seed: int):
    @tv.tidy(*KEPT)
    def run(batches):
        import hashlib

        coder = Coder(path, rate, seed)
        for batch in batches:
            for lo, hi in tv.row_blocks(tv.flat(batch.column("text"))[1], tv.BLOCK):
                rows = batch.slice(lo, hi - lo)
                texts = [t or "" for t in rows.column("text").to_pylist()]
                ids, bounds = coder.encode(texts, rows.column("key").to_numpy(zero_copy_only=False).view(_U))
                back = coder.decode(ids, bounds)
                ids = ids.astype("<u4")
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column("doc_id"),
                        pa.array([len(t) for t in texts], pa.int64()),
                        pa.array(np.diff(bounds)),
                        pa.array([zlib.crc32(ids[i:j]) for i, j in zip(bounds[:-1], bounds[1:], strict=True)], pa.int64()),
                        pa.array([hashlib.sha256(b).hexdigest() for b in back]),
                        pa.array([b == t.encode() for b, t in zip(back, texts, strict=True)]),
                    ],
                    ["doc_id", "n_chars", "n_pieces", "pieces_crc32", "decoded_sha256", "lossless"],
                )

    return run


def round_trip(docs: DataFrame, path: str, rate: float = RATE, seed: int = SEED) -> DataFrame:
    """doc_id, n_chars, n_pieces, pieces_crc32, decoded_sha256 and lossless of each whole text."""
    rows = docs.select("doc_id", "text", F.xxhash64("doc_id").alias("key"))
    return rows.mapInArrow(_round_trip(path, rate, seed), "doc_id long, n_chars long, n_pieces long, pieces_crc32 long, decoded_sha256 string, lossless boolean")


def op9(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
