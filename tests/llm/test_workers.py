"""What Python workers hold between tasks."""

import re
from pathlib import Path

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest

from hexloom.llm import bands, components, near, pieces, repeats
from hexloom.llm import textvec as tv

TEXTS = ["a few words of one text", "and some more of another"]
KEYED = {"row_a": [1, 2], "row_b": [3, 4], "text": TEXTS}


def heap_mb():
    return sum(map(int, re.findall(r"\nPss_Anon:\s+(\d+)", Path("/proc/self/smaps_rollup").read_text()))) / 1024


def litter():
    """256 MB freed below a block that is still in use: the C library keeps them."""
    blocks = [np.ones(8000) for _ in range(4096)]
    pin = np.ones(8000)
    blocks.clear()
    return pin


def encode():
    box = pa.array([{"text": t} for t in TEXTS])
    run = pieces._encode_rows(public_tokenizers.path("piece_bpe_32k.model"), 0.1, 1, "text", True)
    return list(run(iter([pa.RecordBatch.from_arrays([box, pa.array([1, 2])], ["row", "key"])])))


KERNELS = {
    "rules": lambda: bands._rows("text")(iter([pa.RecordBatch.from_pydict({"row": [{"text": t} for t in TEXTS]})])),
    "signatures": lambda: near._signature_rows(5)(iter([pa.RecordBatch.from_pydict({"id": [1, 2]} | KEYED)])),
    "sets": lambda: near._set_rows(5)(iter([pa.RecordBatch.from_pydict({"c": [1, 2], "copies": [False, False], "text": TEXTS})])),
    "runs": lambda: repeats._run_rows(200)(iter([pa.RecordBatch.from_pydict(KEYED)])),
    "links": lambda: components._contract(iter([pa.RecordBatch.from_pydict({"a": [1, 2], "b": [2, 3]})])),
}


@pytest.mark.parametrize("name", KERNELS)
def test_a_task_drops_what_another_operator_kept_and_gives_memory_back(name):
    encode()
    kinds = lambda: {k[0] for k in tv.process_cache() if isinstance(k, tuple)}
    assert kinds() >= set(pieces.KEPT)
    pin = litter()
    before = heap_mb()
    list(KERNELS[name]())
    assert not kinds() & set(pieces.KEPT)
    assert before - heap_mb() > 150 and len(pin)


def test_pieces_keep_their_own_and_give_memory_back():
    first = encode()
    held = {k: v for k, v in tv.process_cache().items() if isinstance(k, tuple)}
    pin = litter()
    before = heap_mb()
    assert encode() == first and len(pin)
    assert before - heap_mb() > 150
    assert all(tv.process_cache()[k] is v for k, v in held.items())


def test_a_task_that_is_left_early_gives_memory_back():
    run = tv.tidy()(lambda batches: (b for b in batches))(iter(range(9)))
    assert next(run) == 0
    pin = litter()
    before = heap_mb()
    run.close()
    assert before - heap_mb() > 150 and len(pin)
