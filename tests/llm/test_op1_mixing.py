from collections import defaultdict
from fractions import Fraction
from hashlib import md5

from pyspark.sql import functions as F

from hexloom.llm import mixing
from tests.llm.common import INNER, WORD, empty, rows, untouched


def share(budget, children):
    """Water filling of a whole-number budget, the plain way. children: (name, cap, weight)."""
    got, left = {}, sorted(children, key=lambda c: (Fraction(c[1], c[2]), c[0]))
    while left:
        w = sum(c[2] for c in left)
        full = [c for c in left if c[1] * w <= c[2] * budget]
        if not full:
            break
        name, cap, _ = full[0]
        got[name] = cap
        budget -= cap
        left = [c for c in left if c[0] != name]
    w = sum(c[2] for c in left)
    low = {n: k * budget // w for n, _, k in left}
    odd = sorted(left, key=lambda c: (-(c[2] * budget % w), c[0]))
    spare = budget - sum(low.values())
    return got | {c[0]: low[c[0]] + (i < spare) for i, c in enumerate(odd)}


def brute(units, plan):
    caps = defaultdict(int)
    for _, _, *leaf, n in units:
        caps[tuple(leaf)] += n * plan.max_epochs
    caps = {k: v for k, v in caps.items() if v}
    weight = lambda level, v: plan.weights[level].get(v, plan.default[level])

    def down(prefix, budget):
        if len(prefix) == len(plan.levels):
            return {prefix: budget}
        level = len(prefix)
        sums = defaultdict(int)
        for leaf, cap in caps.items():
            if leaf[:level] == prefix and weight(level, leaf[level]):
                sums[leaf[level]] += cap
        budget = min(budget, sum(sums.values()))
        out = {}
        for name, b in share(budget, [(v, cap, weight(level, v)) for v, cap in sums.items()]).items():
            out |= down((*prefix, name), b)
        return out

    total = sum(n for *_, n in units) * plan.budget_percent // 100
    taken = []
    for leaf, budget in down((), total).items():
        docs = [(k, t, n) for k, t, *rest, n in units if tuple(rest) == leaf and n]
        have = sum(n for *_, n in docs)
        whole, rest = divmod(budget, have)
        digest = lambda t: md5((t or "").encode()).hexdigest()
        taken += [(k, digest(t), e, n) for k, t, n in docs for e in range(whole)]
        for k, t, n in sorted(docs, key=lambda d: md5(f"{plan.seed}:{whole}:{'' if d[0] is None else d[0]}:{digest(d[1])}".encode()).hexdigest()):
            if rest <= 0:
                break
            taken.append((k, digest(t), whole, min(n, rest)))
            rest -= n
    return sorted(taken, key=str)


def tree(spark, data):
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(3)
    k = F.coalesce(F.col("doc_id"), F.lit(1))
    return df.withColumns({"domain": F.when(k % 7 > 0, F.element_at(F.array(F.lit("a"), F.lit("b"), F.lit("c")), (k % 3 + 1).cast("int"))), "lang": F.concat(F.lit("l"), (k % 4).cast("string")), "source": F.concat(F.lit("s"), (F.floor(k / 5) % 6).cast("string"))})


def test_against_plain_filling(spark):
    # null ids, several texts of one id, repeated rows: those are one unit
    df = tree(spark, rows(n=150) + [(None, f"no id {i} " * (i % 5 + 1)) for i in range(60)])
    counts = defaultdict(int)
    for r in df.collect():
        counts[r.doc_id, r.text or "", r.domain or mixing.NONE, r.lang, r.source] += len(WORD.findall(r.text or ""))
    units = [(*k, n) for k, n in counts.items()]
    for percent, epochs, weights in ((100, 1, {}), (60, 3, {"a": 5, "b": 3}), (170, 2, {"a": 9}), (900, 3, {}), (100, 2, {"c": 0})):
        plan = mixing.Plan(weights=(weights, {"l1": 4}, {"s0": 7}), budget_percent=percent, max_epochs=epochs, seed=percent)
        got = sorted(((r.id, r.digest, r.epoch, r.take_tokens) for r in mixing.choose(mixing.units_of(df, plan), plan).collect()), key=str)
        assert got == brute(units, plan)


def test_mix_rows(spark):
    df = tree(spark, rows()).withColumns({"epoch": F.lit("x"), "kept": F.lit(1)})
    got = mixing.mix(df, mixing.Plan(budget_percent=80, max_epochs=1))
    assert got.columns.count("epoch") == 1
    assert sum(r.take_tokens for r in got.collect()) <= sum(len(WORD.findall(t or "")) for _, t in rows())
    assert got.where("doc_id in (204, 205, 206)").count() == 0
    assert got.where("doc_id = 2").count() in (0, 3)
    assert mixing.mix(tree(spark, rows()).where("false"), mixing.Plan()).count() == 0
    assert mixing.mix(df, mixing.Plan(weights=({"a": 0, "b": 0, "c": 0, mixing.NONE: 0}, {}, {}))).count() == 0


def test_clashing_names_and_levels(spark):
    df = tree(spark, rows()).withColumns({c: F.lit(f"own {c}") for c in INNER})
    got = mixing.mix(df, mixing.Plan(budget_percent=300, max_epochs=2))
    assert untouched(got) and got.columns == [*df.columns, "epoch", "take_tokens"]
    # a level may be named like anything
    odd = tree(spark, rows()).withColumnsRenamed({"domain": "_take", "lang": "range", "source": "a.b"})
    plan = mixing.Plan(levels=("_take", "range", "a.b"), budget_percent=100, max_epochs=1)
    assert mixing.mix(odd, plan).count() == sum(1 for _, t in rows() if WORD.search(t or ""))
    # rows of one id and text in two leaves: each counts for its own leaf
    two = spark.createDataFrame([(1, "a b c", "web", "en", s) for s in ("s1", "s2", "s2")], "doc_id long, text string, domain string, lang string, source string")
    got = mixing.mix(two, mixing.Plan(budget_percent=100, max_epochs=1)).collect()
    assert sorted((r.source, r.take_tokens) for r in got) == [("s1", 3), ("s2", 3), ("s2", 3)]
    long = tree(spark, [(1, "some longer words " * 90_000), (2, "x")])
    assert mixing.mix(long, mixing.Plan(max_epochs=1)).agg(F.sum("take_tokens")).first()[0] == 270_001


def test_no_python(spark):
    plan = mixing.mix(tree(spark, rows()), mixing.Plan())._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
    assert mixing.units_of(empty(spark).withColumns({c: F.lit("x") for c in mixing.Plan().levels}), mixing.Plan()).count() == 0
