import functools
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from hexloom.llm import textvec as tv
from hexloom.llm import tokens
from hexloom.llm.workspace import work_dir
from tests.llm.common import empty, frame, rows

PATH = public_tokenizers.path("byte_bpe_50k.json")


@settings(max_examples=80, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 60000), st.integers(0, 2**64 - 1)), max_size=300), st.sampled_from([1, 7, 64, 4096]))
def test_round_trip(ids, block):
    ids = np.array(ids, np.uint64)
    words, places = tokens.pack(ids, block)
    assert (tokens.unpack(words, places, len(ids), block) == ids).all()
    raw = tokens.shard_bytes(np.array([5]), np.array([len(ids)]), ids, block)
    assert (tokens.read_shard(raw)[2] == ids).all()


def test_not_a_shard():
    with pytest.raises(ValueError):
        tokens.read_shard(b"x" * 80)


def test_files_against_the_library(spark):
    from tokenizers import Tokenizer

    tk = Tokenizer.from_file(PATH)
    data = [r for r in rows() if r[0] is not None] + [(500, "  two  spaces \n\n x's  "), (501, "nbsp x\u00a0\u3000 y <|endoftext|>"), (502, "x <|endoftext|> y"), (503, "a<|endoftext|><|endoftext|>b <|endoftext| >")]
    folder = work_dir(spark, "t")
    manifest = tokens.write_ids(frame(spark, data, extra=True), folder, PATH, shard_ids=2000)
    assert manifest.count() > 3
    got = sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in tokens.read_digests(manifest, folder).collect())
    want = sorted((k, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for k, x in ((k, [*tk.encode(t or "", add_special_tokens=False).ids, 2]) for k, t in data))
    assert sorted((k, n, c) for k, _, n, c in got) == want
    by_start = sorted(got, key=lambda r: r[1])
    assert [r[0] for r in by_start] == sorted(r[0] for r in by_start)
    assert [r[1] for r in by_start] == np.cumsum([0, *(r[2] for r in by_start)])[:-1].tolist()


def test_special_tokens_and_whole_texts():
    from tokenizers import Tokenizer

    tk = Tokenizer.from_file(PATH)
    texts = ["x <|endoftext|> y", "plain words here, and more", "", "a  b\tc"]
    data, offsets = tv.flat(pa.array(texts))
    coder = tokens.UnitEncoder(PATH)

    def each(e):
        ids, at = e.encode(data, offsets)
        return [ids[i:j].tolist() for i, j in zip(at[:-1], at[1:], strict=True)]

    want = [tk.encode(t, add_special_tokens=False).ids for t in texts]
    assert each(coder) == want and want[0] == [87, 220, 50256, 331]
    # tokens that seem to cross a cut: the texts are encoded whole
    coder.clear()
    coder.width = coder.width + 1
    assert each(coder) == want
    tk.encode_special_tokens = True
    assert each(tokens.UnitEncoder(PATH, special_as_text=True)) == [tk.encode(t, add_special_tokens=False).ids for t in texts]


_ODD = ["a", "B", "é", "ſ", "ɏ", "×", "÷", "ʰ", "б", "字", "\u0301", "²", "5", "٣", "'", "'s", "'re", "’", ",", "._", "!!", "|", " ", " ", "  ", "\n", "\n\n", "\r\n", "\t", "\x1c", "\x7f", "\x85", "\xa0", "\u2028", "\u3000", "😀", "<|endoftext|>", "<|", "endoftext", "|>", " the", "word"]


@functools.cache
def library(special_as_text):
    from tokenizers import Tokenizer

    tk = Tokenizer.from_file(PATH)
    tk.encode_special_tokens = special_as_text
    return tk


@settings(max_examples=400, deadline=None)
@given(st.lists(st.lists(st.sampled_from(_ODD), max_size=14).map("".join), min_size=1, max_size=6), st.booleans())
def test_cuts_against_the_library(texts, special_as_text):
    tk, coder = library(special_as_text), tokens.encoder(PATH, special_as_text)
    coder.clear()
    data, offsets = tv.flat(pa.array(texts))
    # cuts never fall back on whole texts here, and kept ids serve again
    for _ in range(2 if len(data) else 0):
        ids, at = coder.by_cuts(data, offsets)
        assert [ids[i:j].tolist() for i, j in zip(at[:-1], at[1:], strict=True)] == [tk.encode(t, add_special_tokens=False).ids for t in texts]


def test_each_word_is_encoded_once():
    words = ["alpha", "beta", "gamma", "été", "Ñandú"]
    around = ["{}", "{},", "{}.", "{}!", "({})", "{};", "{}9", "{}|", "{}\nx {}", '"{}"', "{}-{}", "{}?!"]
    texts = ["x " + " ".join(a.format(w, w) for w in words for a in around) + " x"]
    coder = tokens.UnitEncoder(PATH)
    coder.by_cuts(*tv.flat(pa.array(texts)))
    # each word after a space and after something else; 2 forms of x, and the rest are signs
    assert coder.units.kept <= 2 * len(words) + 20


def test_letters_beyond_ascii():
    from tokenizers import Tokenizer

    split = Tokenizer.from_file(PATH).pre_tokenizer.pre_tokenize_str
    for c in map(chr, range(33, 0x280)):
        kinds = tokens._kinds(np.frombuffer(c.encode(), np.uint8))
        beside = [len(split(x + c)) == 1 for x in ("a", "1", ".")]
        assert (kinds == kinds[0]).all() and (not kinds[0] or beside == [kinds[0] == k for k in (1, 2, 3)]), c


def test_vocabularies_that_cannot_be_cut():
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    coder, tk = tokens.UnitEncoder(path), Tokenizer.from_file(path)
    assert not coder.cuttable
    texts = ["Some Words <|endoftext|> here", "é x"]
    ids, at = coder.encode(*tv.flat(pa.array(texts)))
    assert [ids[i:j].tolist() for i, j in zip(at[:-1], at[1:], strict=True)] == [tk.encode(t, add_special_tokens=False).ids for t in texts]


def test_empty_and_null_ids(spark):
    folder = work_dir(spark, "t")
    assert tokens.read_digests(tokens.write_ids(empty(spark), folder, PATH), folder).count() == 0
    folder = work_dir(spark, "t")
    got = tokens.read_digests(tokens.write_ids(frame(spark), folder, PATH), folder).collect()
    assert len(got) == len(rows()) and sum(r.doc_id is None for r in got) == 2
    # a long text, repeated rows, and the session's settings as they were
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    folder, long = work_dir(spark, "t"), "some longer words " * 100_000
    got = tokens.read_digests(tokens.write_ids(frame(spark, [(1, long), (1, long), (2, "x")]), folder, PATH), folder).collect()
    assert len({(r.n_tokens, r.ids_crc32) for r in got}) == 2 and max(r.start for r in got) == 2 * max(r.n_tokens for r in got)
    assert spark.conf.get(name) == before
