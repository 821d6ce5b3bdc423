import random

from pyspark.sql import functions as F

from hexloom.llm import chat

TEXTS = ["plain", "", None, chat.ODD, "\\b#<\\l", "### user: x </turn>\n### assistant: y </turn>\n", "a\n\nb: c", "日\\\\", " </turn>"]


def test_template_is_reversible(spark):
    rows = [(1, i, r, t) for i, (r, t) in enumerate((r, t) for t in TEXTS for r in ("user", "assistant", "sys: #<\\", None, ""))]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    got = chat.format_paths(chat.linear(df)).select("formatted", chat.parse_turns(F.col("formatted")).alias("t"), chat.loss_texts(F.col("formatted")).alias("l")).collect()
    assert len(got) == 1
    assert [(x.role, x.text) for x in got[0].t] == [(r or "", t or "") for _, _, r, t in rows]
    assert got[0].l == [t or "" for _, _, r, t in rows if r == "assistant"]


def test_branches(spark):
    #      1 -> 2 -> 4, 1 -> 3, a second root 9, a ring 5 <-> 6, 7 under it, 8's parent is missing
    nodes = [(1, None, 0.0), (2, 1, 1.0), (4, 2, 5.0), (3, 1, 9.0), (9, None, None), (5, 6, 1.0), (6, 5, 1.0), (7, 5, 1.0), (8, 77, 2.0), (8, 77, 2.0)]
    df = spark.createDataFrame([(c, n, p, "user", f"t{n}", s) for c in (1, None) for n, p, s in nodes], "conv_id long, node long, parent long, role string, text string, score double")
    got = chat.paths(df).collect()
    for c in (1, None):
        assert sorted((r.rank, r.leaf, r.path, r.path_score) for r in got if r.conv_id == c) == [(1, 3, [1, 3], 4.5), (2, 4, [1, 2, 4], 2.0), (3, 8, [8], 2.0), (4, 9, [9], 0.0)]
    best = chat.format_paths(df, 1).where("conv_id = 1").first()
    assert best.formatted == "### user: t1 </turn>\n### user: t3 </turn>\n"


def test_against_plain_trees(spark):
    r = random.Random(5)
    data = []
    for c in (1, 2, 3, None):
        for n in range(60):
            data.append((c, n, r.choice([None, n + 100, *range(n)]) if n else None, "user", f"text {n}", round(r.random(), 3)))
        data += [data[-1], (c, 7, 3, "user", "other", 0.5)]  # a repeated row, and another one of the same node
    df = spark.createDataFrame(data, "conv_id long, node long, parent long, role string, text string, score double").repartition(4)
    want = []
    for c in (1, 2, 3, None):
        nodes = {}
        for d in sorted((x for x in data if x[0] == c), key=lambda x: (x[2] is not None, x[2] or 0, x[5], x[4])):
            nodes.setdefault(d[1], d)
        leaves = []
        for n in set(nodes) - {d[2] for d in nodes.values()}:
            path, at = [], n
            while at in nodes:
                path.append(at)
                at = nodes[at][2]
            leaves.append((-round(sum(nodes[x][5] for x in path) / len(path), 9), n, path[::-1]))
        want += [(c, n, k, tuple(path), "".join(f"### user: {nodes[x][4]} </turn>\n" for x in path)) for k, (_, n, path) in enumerate(sorted(leaves), 1)]
    got = {(x.conv_id, x.leaf): x for x in chat.paths(df).collect()}
    text = {(x.conv_id, x.leaf): x.formatted for x in chat.format_paths(df).collect()}
    assert sorted(((c, n, x.rank, tuple(x.path), text[c, n]) for (c, n), x in got.items()), key=str) == sorted(want, key=str)


def test_long_chain(spark):
    n = 20_000
    df = spark.range(n).select(F.lit(1).alias("conv_id"), "id", F.when(F.col("id") > 0, F.col("id") - 1).alias("parent"), F.lit("user").alias("role"), F.lit("x").alias("text"), F.lit(1.0).alias("score")).withColumnRenamed("id", "node")
    assert chat.paths(df).first().path == list(range(n))


def test_ties_and_empty(spark):
    df = spark.createDataFrame([(1, 0, "user", "a"), (1, 0, "user", "a"), (1, None, "user", "z"), (2, 0, None, None)], "conv_id long, turn long, role string, text string")
    got = {r.conv_id: len(r.t) for r in chat.format_paths(chat.linear(df.withColumn("leaf", F.lit("mine")))).select("conv_id", chat.parse_turns(F.col("formatted")).alias("t")).collect()}
    assert got == {1: 3, 2: 1}
    assert chat.format_paths(chat.linear(df.where("false"))).count() == 0
