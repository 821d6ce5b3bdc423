import importlib
import sys

import pytest

import __spark_entry__ as entry


def test_names():
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q) and all(callable(f) for f in q.values())


def test_entry(spark):
    assert entry.entry(spark).count() == 20


def test_without_the_subpackage(monkeypatch):
    for name in [m for m in sys.modules if m.startswith("hexloom.llm") or m == "corpus_pipeline"]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)
    with pytest.raises(ModuleNotFoundError):
        importlib.import_module("corpus_pipeline")
    spec = importlib.util.spec_from_file_location("entry_alone", entry.__file__)
    alone = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(alone)
    assert alone.llm is None and "places_pyramid" in alone.queries() and not [k for k in alone.queries() if k.startswith("op")]
