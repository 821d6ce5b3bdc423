import random

import corpus_pipeline
from tests.llm import test_op7_near
from tests.llm.common import WORD
from tests.llm.test_op10_bands import base


def corpus(spark, path):
    r = random.Random(11)
    syllables = [a + b for a in "bcdfghklmnprst" for b in ("a", "e", "i", "o", "u", "é", "an")]
    word = lambda: "".join(r.choice(syllables) for _ in range(r.randint(1, 4)))
    prose = lambda k: " ".join(word() for _ in range(k))
    shared = prose(70)
    texts = [prose(r.randint(60, 160)) for _ in range(30)]
    texts += [texts[0], texts[1] + " tail", "to " * 200, "few words", None, ""]
    texts += [prose(70) + " " + shared + " " + prose(70) for _ in range(4)]
    rows = [(i, t, ("en", "de", None)[i % 3], f"src{i % 5}", len(t or "")) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    return rows, shared


def test_stages(spark, tmp_path):
    rows, shared = corpus(spark, str(tmp_path))
    names = ["doc_id", "text", "lang", "source", "n_chars"]
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        path = f"{tmp_path}/{name}"
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        seen.append(docs.collect())
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == names
    ids = [{r.doc_id for r in s} for s in seen]
    assert ids[0] == {i for i, t, *_ in rows if not base(t)[5]}
    kept = [(i, t) for i, t, *_ in rows if i in ids[0]]
    assert ids[1] == {i for i, _, c in test_op7_near.brute(kept, 5, 80) if i == c} and not {30, 31} & ids[1]
    assert ids[2] == ids[1]
    text = {i: t for i, t, *_ in rows}
    for r in seen[2]:
        assert r.n_chars == len(r.text) and (r.text == text[r.doc_id]) == (r.doc_id < 30)
        assert shared[:60] not in r.text
    left = sum(len(WORD.findall(r.text)) for r in seen[2])
    taken = sum(len(WORD.findall(r.text)) for r in seen[3])
    assert ids[3] < ids[2] and len(seen[3]) == len(ids[3]) and taken >= left * 0.9
    assert ids[4] == ids[3] and all(r.lossless for r in seen[4])


def test_run_and_empty(spark, tmp_path):
    corpus(spark, str(tmp_path))
    assert corpus_pipeline.run(spark, str(tmp_path)).where("lossless").count() > 10
    none = f"{tmp_path}/none"
    spark.read.parquet(f"{tmp_path}/documents.parquet").where("false").write.parquet(f"{none}/documents.parquet")
    assert corpus_pipeline.run(spark, none).count() == 0
