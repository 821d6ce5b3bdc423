import random
from collections import Counter

from pyspark.sql import functions as F

from hexloom.llm import components, near
from hexloom.llm.workspace import table
from tests.llm.common import LOWER, WORD, empty, frame, rows, untouched


def brute(data, k, percent):
    sets = []
    for _, t in data:
        w = WORD.findall((t or "").translate(LOWER))
        sets.append(frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else (frozenset([tuple(w)]) if w else frozenset()))
    up = list(range(len(data)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(data)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                up[top(i)] = top(j)
    ids = {}
    for i, (d, _) in enumerate(data):
        ids.setdefault(top(i), []).append(d)
    least = {g: min((d for d in v if d is not None), default=None) for g, v in ids.items()}
    return [(d, len(sets[i]), least[top(i)] if sets[i] else d) for i, (d, _) in enumerate(data)]


def test_against_all_pairs(spark):
    data = rows()
    for k in (2, 5):
        got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in near.near_duplicates(frame(spark), k=k).collect())
        assert got == Counter(brute(data, k, 80))


def crowd(hub, copies, seed=4):
    """A hub whose copies are linked with it and not with each other, and texts of one template that are not linked."""
    r = random.Random(seed)
    word = lambda: f"w{r.randrange(10**6)}"
    base, form = [word() for _ in range(300)], [word() for _ in range(300)]

    def changed(words, n):
        step = len(words) // n
        words = list(words)
        for i in range(n):
            words[i * step + r.randrange(step)] = word()
        return " ".join(words)

    return [(hub, " ".join(base))] + [(i, changed(base, 5)) for i in range(copies)] + [(1000 + i, changed(form, 7)) for i in range(copies)]


def test_crowded_region(spark, monkeypatch):
    data = crowd(500, 260)[:321]
    monkeypatch.setattr(near, "BLOCK_ROWS", 90)
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in near.near_duplicates(frame(spark, data)).collect())
    want = brute(data, 5, 80)
    assert sum(c == 0 for _, _, c in want) == 261
    assert got == Counter(want)


def test_edges(spark):
    assert near.near_duplicates(empty(spark)).count() == 0
    got = near.near_duplicates(frame(spark, rows()[:6] + [(9, None), (8, "")], extra=True))
    assert got.columns.count("kept") == 1 and got.where("doc_id in (8, 9)").where("kept and component_id = doc_id and n_shingles = 0").count() == 2


def test_clashing_names(spark):
    assert untouched(near.near_duplicates(frame(spark, extra=True)))


def test_null_ids_that_a_32_bit_hash_takes_for_one(spark):
    data = [(None, "p q r 179531"), (None, "w357140"), (None, "w357140"), (4, "w357140"), (-(2**63), "q")]
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in near.near_duplicates(frame(spark, data), k=2).collect())
    assert got == Counter(brute(data, 2, 80))


def test_many_copies_of_one_row(spark):
    text = " ".join(f"w{i}" for i in range(60))
    df = spark.range(10_000).select(F.lit(5).cast("long").alias("doc_id"), F.lit(text).alias("text"))
    near_one = text.replace("w59", "other")
    df = df.unionByName(frame(spark, [(3, near_one), (9, "unlike all of them")]))
    got = near.near_duplicates(df).groupBy("doc_id", "component_id", "kept").count().collect()
    assert sorted(tuple(r) for r in got) == [(3, 3, True, 1), (5, 3, False, 10_000), (9, 9, True, 1)]


def test_long_text(spark):
    long = " ".join(f"w{i % 40_000}" for i in range(300_000))
    got = {r.doc_id: r for r in near.near_duplicates(frame(spark, [(1, long), (2, long + " and more"), (3, "x")])).collect()}
    assert got[2].component_id == 1 and got[1].n_shingles == 40_000 and not got[2].kept


def test_links_of_every_fiftieth_document(spark):
    """All rows against those with ids divisible by 50, by words in common: no link is lost."""
    sf = "/root/testdata/sf0.01"
    docs = table(spark, sf, "documents")
    got = {r.doc_id: r.component_id for r in near.op7(spark, sf).collect()}
    words = lambda t: WORD.findall((t or "").translate(LOWER))
    sets = {}
    for r in docs.collect():
        w = words(r.text)
        sets[r.doc_id] = frozenset(zip(w, w[1:])) if len(w) > 1 else frozenset([tuple(w)] if w else [])
    links = [(a, b) for a in sets if a % 50 == 0 for b in sets if a != b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    assert links and all(got[a] == got[b] for a, b in links)


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7), (102, 100)]
    for chunk in (1 << 20, 9):
        got = {r.node: r.component for r in components.components(spark.createDataFrame(chain, "a long, b long"), chunk).collect()}
        assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 102: 100}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0
