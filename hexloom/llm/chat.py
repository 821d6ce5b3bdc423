"""Chat formatting: reply trees to conversations, a reversible template and a loss mask.

Messages form trees by their parents. Every message points to one above it; self-joins double the
pointers, so a chain of n messages takes log2(n) rounds, each of at most a row a message.
The branches of a conversation are ranked by score; only the chosen ones are then spelt out, by
as many joins whose rows are those of the paths, and each becomes one text:

    ### role: text </turn>\\n

Inside texts and roles the characters ``\\``, ``#``, ``<`` (and ``:`` in roles) are written ``\\b``, ``\\h``,
``\\l``, ``\\c``. So no text holds a control string, and undoing the escapes, ``\\b`` last, is exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hexloom.llm.workspace import materialize, table

HEAD, MID, TAIL = "### ", ": ", " </turn>\n"
ESCAPES = (("\\", "\\b"), ("#", "\\h"), ("<", "\\l"))


def escape(x: Column) -> Column:
    for a, b in ESCAPES:
        x = F.replace(x, F.lit(a), F.lit(b))
    return x


def unescape(x: Column) -> Column:
    for a, b in reversed(ESCAPES):
        x = F.replace(x, F.lit(b), F.lit(a))
    return x


def turn_text(role: Column, text: Column) -> Column:
    role = F.replace(escape(F.coalesce(role, F.lit(""))), F.lit(":"), F.lit("\\c"))
    return F.concat(F.lit(HEAD), role, F.lit(MID), escape(F.coalesce(text, F.lit(""))), F.lit(TAIL))


def parse_turns(formatted: Column) -> Column:
    """array<struct<role, text>> of a formatted conversation."""
    def one(part: Column) -> Column:
        at = F.instr(part, MID)
        role = F.replace(F.substring(part, F.lit(len(HEAD) + 1), at - len(HEAD) - 1), F.lit("\\c"), F.lit(":"))
        text = F.substring(part, at + len(MID), F.length(part))
        return F.struct(unescape(role).alias("role"), unescape(text).alias("text"))

    parts = F.split(formatted, r" </turn>\n")
    return F.transform(F.slice(parts, 1, F.size(parts) - 1), one)


def linear(messages: DataFrame, conv: str = "conv_id", turn: str = "turn") -> DataFrame:
    """Messages that follow each other as trees of one branch: node is the place, parent the one before.

    Rows of one turn follow each other by role, then text; a null turn comes first.
    """
    w = Window.partitionBy(conv).orderBy(turn, "role", "text")
    placed = messages.withColumn("node", F.row_number().over(w).cast("long"))
    return placed.withColumns({"parent": F.when(F.col("node") > 1, F.col("node") - 1), "score": F.lit(0.0)})


def _nodes(messages: DataFrame, conv: str) -> DataFrame:
    """One row (c, node, parent, score, said) for each message; of repeated nodes the least by parent, score and text."""
    said = turn_text(F.col("role"), F.col("text"))
    rows = messages.select(F.col(conv).alias("c"), "node", "parent", F.coalesce("score", F.lit(0.0)).cast("double").alias("score"), said.alias("said")).where("node is not null")
    one = F.min(F.struct("parent", "score", "said")).alias("one")
    return rows.groupBy("c", "node").agg(one).select("c", "node", "one.*")


def _same(a: str, b: str, left: str, right: str) -> Column:
    return F.col(f"{a}.c").eqNullSafe(F.col(f"{b}.c")) & (F.col(f"{a}.{left}") == F.col(f"{b}.{right}"))


def _ranked(nodes: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """Leaves (c, leaf, size, path_score, rank), and for k = 0, 1 .. the messages (c, node, up) 2**k above others.

    Every message points to one above it and knows the number and the scores of the messages
    between. Pointers double in each self-join; only those not yet at a root are joined.
    """
    known = nodes.select("c", F.col("node").alias("parent"), F.lit(True).alias("known"))
    first = nodes.alias("n").join(known.alias("k"), _same("n", "k", "parent", "parent"), "left")
    first = materialize(first.select("n.c", "n.node", F.when(F.col("k.known"), F.col("n.parent")).alias("up"), F.lit(1).cast("long").alias("size"), F.col("n.score").alias("total")), "jumps")
    # messages at a root, and those that still climb
    done, climb, jumps = [first.where("up is null")], first.where("up is not null"), [first.where("up is not null").select("c", "node", "up")]
    most, made = nodes.count(), 1
    while made <= most and climb.head(1):
        every = climb
        for d in done:
            every = every.unionByName(d)
        a, b = climb.alias("a"), every.alias("b")
        joined = a.join(b, _same("a", "b", "up", "node")).select("a.c", "a.node", F.col("b.up").alias("up"), (F.col("a.size") + F.col("b.size")).alias("size"), (F.col("a.total") + F.col("b.total")).alias("total"))
        joined = materialize(joined, "jumps")
        done.append(joined.where("up is null"))
        climb = joined.where("up is not null")
        jumps.append(climb.select("c", "node", "up"))
        made *= 2  # a message on a ring never reaches a root: it climbs further than there are messages
    rooted = done[0]
    for d in done[1:]:
        rooted = rooted.unionByName(d)
    inner = nodes.where("parent is not null").select("c", F.col("parent").alias("node")).distinct()
    leaves = rooted.alias("p").join(inner.alias("i"), _same("p", "i", "node", "node"), "left_anti")
    leaves = leaves.select("c", F.col("node").alias("leaf"), "size", (F.col("total") / F.col("size")).alias("path_score"))
    return leaves.withColumn("rank", F.row_number().over(Window.partitionBy("c").orderBy(F.desc("path_score"), "leaf"))), jumps


def _steps(leaves: DataFrame, jumps: list[DataFrame]) -> DataFrame:
    """(c, leaf, rank, path_score, at, node) of every message on the paths of ``leaves``; at: from the leaf up.

    The messages less than 2**k above a leaf, joined once more, are those less than 2**(k+1)
    above it: the rows are those of the result, never more.
    """
    steps = leaves.select("c", "leaf", "rank", "path_score", F.lit(0).cast("long").alias("at"), F.col("leaf").alias("node"))
    for k, jump in enumerate(jumps):
        above = steps.alias("s").join(jump.alias("j"), _same("s", "j", "node", "node")).select("s.c", "s.leaf", "s.rank", "s.path_score", (F.col("s.at") + (1 << k)).alias("at"), F.col("j.up").alias("node"))
        steps = materialize(steps.unionByName(above), "steps")
    return steps


def paths(messages: DataFrame, conv: str = "conv_id", best: int | None = None) -> DataFrame:
    """Root-to-leaf paths ``(conv, leaf, path array<long>, path_score, rank)`` of rank up to ``best`` (None: all).

    ``messages``: conv, node, parent (null: a root), score, role, text. A path's score is the mean of
    its messages' scores (null counts 0); rank 1 is the best, ties by the leaf. A message whose
    parent is missing is a root; a message that is its own ancestor has no root and no path.
    Of repeated nodes the least by parent, score and text counts. Null conversations are one.
    """
    return _chosen(messages, conv, best, F.col("s.node")).select(F.col("c").alias(conv), "leaf", F.col("parts").alias("path"), "path_score", "rank")


def _chosen(messages: DataFrame, conv: str, best: int | None, part: Column) -> DataFrame:
    nodes = materialize(_nodes(messages, conv), "nodes")
    leaves, jumps = _ranked(nodes)
    if best is not None:
        leaves = leaves.where(F.col("rank") <= best)
    steps = _steps(leaves, jumps)
    joined = steps.alias("s").join(nodes.select("c", F.col("node").alias("of"), "said").alias("n"), _same("s", "n", "node", "of"))
    joined = joined.select("s.c", "s.leaf", "s.rank", "s.path_score", F.struct((-F.col("s.at")).alias("at"), part.alias("part")).alias("step"))
    whole = joined.groupBy("c", "leaf", "rank", "path_score").agg(F.sort_array(F.collect_list("step")).alias("steps"))
    return whole.select("c", "leaf", "rank", "path_score", F.transform("steps", lambda x: x["part"]).alias("parts"))


def format_paths(messages: DataFrame, best: int | None = None, conv: str = "conv_id") -> DataFrame:
    """``(conv, leaf, rank, path_score, formatted)`` of the paths of rank up to ``best`` (None: all).

    ``messages``: conv, node, parent, role, text, score; other columns are ignored. Null roles and
    texts count as empty; texts may have any length as long as a conversation fits one
    value. See :func:`paths` for ties, repeated nodes, missing parents and rings. An empty
    table gives an empty result.
    """
    return _chosen(messages, conv, best, F.col("n.said")).select(F.col("c").alias(conv), "leaf", "rank", "path_score", F.array_join("parts", "").alias("formatted"))


def loss_texts(formatted: Column) -> Column:
    """The assistant's texts of a formatted conversation, unescaped, in order: what the loss mask covers."""
    return F.transform(F.filter(parse_turns(formatted), lambda t: t["role"] == "assistant"), lambda t: t["text"])


ODD = "\\### Assistant: </turn> ok"


def op8(spark, sf_dir: str) -> DataFrame:
    talks = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.createDataFrame([(-7, 0, "user", ODD), (-7, 1, "assistant", ODD)], "conv_id long, turn long, role string, text string")
    done = format_paths(linear(talks.unionByName(more)))
    turns = parse_turns(F.col("formatted"))
    done = done.withColumns({"_turns": turns, "_loss": F.array_join(loss_texts(F.col("formatted")), "")})
    said = F.array_join(F.transform("_turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return done.select(
        "conv_id",
        F.size("_turns").cast("long").alias("n_turns"),
        F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.length("_loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("_loss").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def trees(messages: DataFrame, conv: str = "conv_id", turn: str = "turn") -> DataFrame:
    """Turns as trees, for tables that name no parents: each answers one of the three turns before it.

    The parent's distance and the score come from the place, the conversation and the text's length.
    """
    placed = linear(messages, conv, turn)
    back = 1 + (F.coalesce(F.abs(conv), F.lit(0)) * 31 + F.col("node") * 7) % 3
    parent = F.when(F.col("node") > 1, F.greatest(F.col("node") - back, F.lit(1)))
    return placed.withColumns({"parent": parent, "score": (F.length(F.coalesce("text", F.lit(""))) % 10).cast("double")})


def branches(spark, sf_dir: str) -> DataFrame:
    """The two best-scored branches of every conversation, as text."""
    done = format_paths(trees(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")), best=2)
    return done.select("conv_id", "leaf", F.col("rank").cast("int").alias("rank"), F.round("path_score", 6).alias("path_score"), F.size(parse_turns(F.col("formatted"))).alias("n_turns"), F.sha2(F.col("formatted").cast("binary"), 256).alias("formatted_sha256"))


BRANCHES = r"""
with recursive m as (select conv_id, coalesce(role, '') as role, coalesce(text, '') as text, row_number() over (partition by conv_id order by turn nulls first, role nulls first, text nulls first) as node from conversations),
t as (select conv_id, node, case when node > 1 then greatest(node - 1 - (abs(conv_id) * 31 + node * 7) % 3, 1) end as parent, (length(text) % 10)::double as score,
  '### ' || replace(replace(replace(replace(role, '\', '\b'), '#', '\h'), '<', '\l'), ':', '\c') || ': ' || replace(replace(replace(text, '\', '\b'), '#', '\h'), '<', '\l') || ' </turn>' || chr(10) as said from m),
walk as (select conv_id, node, score as total, 1 as size, said from t where parent is null
  union all select t.conv_id, t.node, w.total + t.score, w.size + 1, w.said || t.said from walk w join t on t.conv_id = w.conv_id and t.parent = w.node),
leaves as (select * from walk w where not exists (select 1 from t where t.conv_id = w.conv_id and t.parent = w.node)),
placed as (select *, row_number() over (partition by conv_id order by total / size desc, node)::integer as rank from leaves)
select conv_id, node as leaf, rank, round(total / size, 6) as path_score, size::integer as n_turns, sha256(said) as formatted_sha256 from placed where rank <= 2"""

ORACLE = f"""
with m as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '{ODD}' union all select -7, 1, 'assistant', '{ODD}'),
e as (select *, length(text) - length(replace(replace(replace(text, '\\', ''), '#', ''), '<', '')) + length(text) as size,
  length(role) + length(role) - length(replace(replace(replace(replace(role, '\\', ''), '#', ''), '<', ''), ':', '')) as role_size from m)
select conv_id, count(*)::bigint as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
  coalesce(sum(length(text)) filter (where role = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (where role = 'assistant'), '')) as loss_sha256,
  sum(size + role_size + 15)::bigint as formatted_chars
from e group by conv_id"""
