"""Mixing sources to target weights: hierarchical budgets over a tree, native DataFrame code only.

The leaves are the groups of documents with equal level columns (domain, language, source).
A budget of tokens goes down the tree: among the children of a node it is split by weight,
a child takes no more than the documents below it can give in ``max_epochs`` passes, and
what it cannot take is split again among its siblings. Since a child's limit is that of its
whole subtree, a shortage is made up among the leaf's siblings first, and only what they all
together lack is passed to their parent's siblings, and so on upwards.

Each leaf then takes a prefix of its seeded epochs: whole passes, and of the last one the
documents in the order of a keyed hash until the budget is met. The order is cut into 4096
hash ranges; only the range that holds the cut is ever sorted, so a leaf with a third of the
corpus is read by all tasks.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hexloom.llm.workspace import discard, materialize, named, table

WORDS = r"[^\x20\x09-\x0D]+"
NONE = "(none)"


@dataclass(frozen=True)
class Plan:
    """Level columns from the root down, whole-number weights of their values, and the rest.

    A value without weight has ``default`` for its level. ``budget_percent``: budget by the
    tokens there are; ``max_epochs``: how often a document may be taken.
    """

    levels: tuple[str, ...] = ("domain", "lang", "source")
    weights: tuple[dict[str, int], ...] = ({}, {}, {})
    default: tuple[int, ...] = (1, 1, 1)
    budget_percent: int = 100
    max_epochs: int = 4
    seed: int = 1


def tokens(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long")


def _weight(at: str, given: dict[str, int], default: int) -> Column:
    w = F.lit(default)
    for value, n in given.items():
        w = F.when(F.col(at) == value, n).otherwise(w)
    return w.cast("decimal(10,0)")


def _split(children: DataFrame, parent: list[str], own: str) -> DataFrame:
    """Splits ``budget`` of each parent among its children, which hold ``cap`` and ``w``, exactly.

    Children in order of cap by weight: the first ones are filled as long as their share of
    what is left reaches their cap; the others share the rest by weight, the largest
    remainders getting the odd tokens.
    """
    whole = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
    before = whole.orderBy(F.col("cap") / F.col("w"), own).rowsBetween(Window.unboundedPreceding, -1)
    c = children.withColumns({
        "b": F.col("budget") - F.coalesce(F.sum("cap").over(before), F.lit(0)),
        "ws": F.sum("w").over(whole) - F.coalesce(F.sum("w").over(before), F.lit(0)),
    })
    wide = lambda x: F.col(x).cast("decimal(19,0)")
    c = c.withColumn("full", wide("cap") * wide("ws") <= wide("w") * wide("b"))
    c = c.withColumns({
        "rest": F.col("budget") - F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(whole), F.lit(0)),
        "left": F.sum(F.when(~F.col("full"), F.col("w"))).over(whole),
    })
    c = c.withColumn("part", wide("w") * wide("rest")).withColumn("low", F.expr("part div left")).withColumn("odd", F.expr("part % left"))
    c = c.withColumn("spare", F.col("rest") - F.sum(F.when(~F.col("full"), F.col("low"))).over(whole))
    c = c.withColumn("place", F.row_number().over(whole.orderBy("full", F.desc("odd"), own)))
    got = F.when(F.col("full"), F.col("cap")).otherwise(F.col("low") + (F.col("place") <= F.col("spare")).cast("int"))
    return c.select(*children.columns, got.cast("long").alias("got"))


def _levels(plan: Plan) -> list[str]:
    """Names of the level columns inside this module: level0, level1 .."""
    return [f"level{i}" for i in range(len(plan.levels))]


def budgets(units: DataFrame, plan: Plan) -> DataFrame:
    """Leaves with their tokens ``have`` and ``budget``; ``units`` holds level0 .. and n_tokens."""
    levels = _levels(plan)
    leaves = units.groupBy(*levels).agg(F.sum("n_tokens").alias("have")).where("have > 0").withColumn("cap", F.col("have") * plan.max_epochs)
    leaves = materialize(leaves, "leaves")
    above = None
    for i, level in enumerate(levels):
        node = levels[: i + 1]
        sums = leaves.groupBy(*node).agg(F.sum("cap").alias("cap"), F.sum("have").alias("have")).withColumn("w", _weight(level, plan.weights[i], plan.default[i]))
        if above is None:
            # of all tokens, those of values without weight too
            want = F.expr(f"(cast(sum(have) over (partition by 0) as decimal(30,0)) * {plan.budget_percent}) div 100")
            sums = sums.withColumn("want", want).where("w > 0")
            sums = sums.withColumn("budget", F.least("want", F.sum("cap").over(Window.partitionBy(F.lit(0))))).drop("want")
        else:
            sums = sums.where("w > 0")
            fair = Window.partitionBy(*levels[:i])
            sums = sums.join(above.select(*levels[:i], F.col("got").alias("budget")), levels[:i])
            sums = sums.withColumn("budget", F.least("budget", F.sum("cap").over(fair)))
        above = _split(sums, levels[:i], level)
    out = above.select(*levels, "have", F.col("got").alias("budget"))
    out.hexloom_paths = leaves.hexloom_paths
    return out


def choose(units: DataFrame, plan: Plan) -> DataFrame:
    """Rows of ``units`` by epoch in which they are taken, with take_tokens (the last one of a leaf in part).

    The order of a leaf is that of a keyed hash of id and text, so rows without id are as
    well spread as the others.
    """
    levels = _levels(plan)
    split = budgets(units, plan)
    leaves = split.withColumns({"whole": F.expr("budget div have"), "rest": F.expr("budget % have")})
    leaves = materialize(leaves.select(*levels, "whole", "rest"), "budgets")
    discard(split)
    dealt = units.where("n_tokens > 0").join(leaves, levels)
    key = F.md5(F.concat_ws(":", F.lit(str(plan.seed)), F.col("whole").cast("string"), F.coalesce(F.col("id").cast("string"), F.lit("")), F.col("digest")))
    dealt = dealt.withColumn("order", key).withColumn("range", F.substring("order", 1, 3))
    ranges = dealt.where("rest > 0").groupBy(*levels, "range").agg(F.sum("n_tokens").alias("n"), F.first("rest").alias("rest"))
    run = Window.partitionBy(*levels).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn("before", F.coalesce(F.sum("n").over(run), F.lit(0)))
    cut = materialize(ranges.where("before < rest and before + n >= rest").select(*levels, F.col("range").alias("cut"), "before"), "cuts")
    placed = dealt.join(cut, levels, "left")
    names = units.columns
    every = placed.where("whole > 0").select(*names, F.explode(F.sequence(F.lit(0), F.col("whole").cast("int") - 1)).alias("epoch"), F.col("n_tokens").alias("take_tokens"))
    sure = placed.where("range < cut").select(*names, F.col("whole").cast("int").alias("epoch"), F.col("n_tokens").alias("take_tokens"))
    inner = Window.partitionBy(*levels, "range").orderBy("order").rowsBetween(Window.unboundedPreceding, -1)
    edge = placed.where("range = cut").withColumn("at", F.col("before") + F.coalesce(F.sum("n_tokens").over(inner), F.lit(0)))
    edge = edge.where("at < rest").select(*names, F.col("whole").cast("int").alias("epoch"), F.least("n_tokens", F.col("rest") - F.col("at")).alias("take_tokens"))
    return every.unionByName(sure).unionByName(edge)


def _unit_key(plan: Plan, text: str, key: str) -> list[Column]:
    """What tells units apart: id, md5 of the text and the level values."""
    levels = [F.coalesce(named(c).cast("string"), F.lit(NONE)).alias(at) for c, at in zip(plan.levels, _levels(plan), strict=True)]
    return [named(key).cast("long").alias("id"), F.md5(F.coalesce(named(text), F.lit(""))).alias("digest"), *levels]


def units_of(docs: DataFrame, plan: Plan, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row (id, digest, level0 .., n_tokens) for all rows of one id, text and level values; written once."""
    rows = docs.select(*_unit_key(plan, text, key), tokens(named(text)).alias("n_tokens"))
    return materialize(rows.groupBy("id", "digest", *_levels(plan)).agg(F.sum("n_tokens").cast("long").alias("n_tokens")), "units")


def mix(docs: DataFrame, plan: Plan, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Rows of ``docs`` once for each epoch in which they are taken, with epoch and take_tokens.

    take_tokens is the row's whole number of words except for the row at a leaf's cut. Null
    level values form a group ``(none)``. Texts without words (null, empty) are never taken; texts
    may have any length. Rows repeated in id, text and levels are one unit: all of them are
    taken or none. Values of weight 0 get nothing. If the budget exceeds what ``max_epochs``
    passes give, all of it is given. An empty table gives an empty result. Columns of the two
    new names are replaced; others may have any names.
    """
    levels = _levels(plan)
    taken = choose(units_of(docs, plan, text, key), plan).select("id", "digest", *levels, "epoch", "take_tokens")
    names = [c for c in docs.columns if c not in ("epoch", "take_tokens")]
    rows = docs.select(F.struct(*map(named, names)).alias("row"), *_unit_key(plan, text, key)).alias("r")
    t = taken.alias("t")
    same = F.col("r.id").eqNullSafe(F.col("t.id")) & (F.col("r.digest") == F.col("t.digest"))
    for c in levels:
        same &= F.col(f"r.{c}") == F.col(f"t.{c}")
    whole = F.col("r.row")
    return rows.join(t, same).select(*(whole[c].alias(c) for c in names), F.col("t.epoch").alias("epoch"), F.least("t.take_tokens", tokens(whole[text])).alias("take_tokens"))


DOMAINS = ("web", "books", "forum")
OP1 = Plan(weights=({"web": 5, "books": 3, "forum": 2}, {"en": 6, "de": 2, "fr": 2, "es": 1}, {}), budget_percent=100, max_epochs=4, seed=7)


def with_domain(docs: DataFrame) -> DataFrame:
    """``domain`` from the number in the source's name; the data have none of their own."""
    n = F.try_to_number(F.regexp_extract(F.col("source"), r"([0-9]{1,9})$", 1), F.lit("999999999")) % 3
    return docs.withColumn("domain", F.when(n == 0, DOMAINS[0]).when(n == 1, DOMAINS[1]).when(n == 2, DOMAINS[2]).otherwise("other"))


def op1(spark, sf_dir: str) -> DataFrame:
    docs = with_domain(table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"))
    taken = choose(units_of(docs, OP1), OP1)
    return taken.select(F.col("id").alias("doc_id"), *(F.col(at).alias(c) for c, at in zip(OP1.levels, _levels(OP1), strict=True)), "epoch", "n_tokens", "take_tokens")


def _sql_split(name: str, rows: str, parent: str, own: str) -> str:
    over = f"partition by {parent}" if parent else ""
    return f"""
{name}_a as (select *, budget - coalesce(sum(cap) over ({over} order by cap::double / w, {own} rows between unbounded preceding and 1 preceding), 0) as b_,
    sum(w) over ({over}) - coalesce(sum(w) over ({over} order by cap::double / w, {own} rows between unbounded preceding and 1 preceding), 0) as w_ from ({rows})),
{name}_b as (select *, cap::hugeint * w_::hugeint <= w::hugeint * b_::hugeint as full_ from {name}_a),
{name}_c as (select *, (budget - coalesce(sum(case when full_ then cap end) over ({over}), 0))::hugeint as rest_, (sum(case when not full_ then w end) over ({over}))::hugeint as left_ from {name}_b),
{name}_d as (select *, (w::hugeint * rest_) // left_ as low_, (w::hugeint * rest_) % left_ as odd_ from {name}_c),
{name}_e as (select *, rest_ - coalesce(sum(case when not full_ then low_ end) over ({over}), 0) as spare_, row_number() over ({over} order by full_, odd_ desc, {own}) as rank_ from {name}_d),
{name} as (select * exclude (b_, w_, full_, rest_, left_, low_, odd_, spare_, rank_), (case when full_ then cap else low_ + (rank_ <= spare_)::int end)::hugeint as got from {name}_e)"""


def _sql_weight(level: str, i: int, plan: Plan) -> str:
    cases = " ".join(f"when {level} = '{v}' then {n}" for v, n in plan.weights[i].items())
    return f"case {cases} else {plan.default[i]} end" if cases else str(plan.default[i])


def oracle(plan: Plan = OP1) -> str:
    n = "regexp_extract(source, '([0-9]{1,9})$', 1)"
    w = [_sql_weight(c, i, plan) for i, c in enumerate(plan.levels)]
    return f"""
with units as (select doc_id, md5(coalesce(text, '')) as digest, case when {n} = '' or source is null then 'other' when {n}::bigint % 3 = 0 then 'web' when {n}::bigint % 3 = 1 then 'books' else 'forum' end as domain,
    coalesce(lang, '{NONE}') as lang, coalesce(source, '{NONE}') as source, sum(coalesce(len(regexp_extract_all(text, '{WORDS}')), 0))::bigint as n_tokens from documents group by 1, 2, 3, 4, 5),
leaves as (select domain, lang, source, sum(n_tokens) as have, sum(n_tokens) * {plan.max_epochs} as cap from units group by all having sum(n_tokens) > 0),
{_sql_split("d", f"select domain, sum(cap) as cap, {w[0]} as w, least(((select sum(have) from leaves) * {plan.budget_percent}) // 100, (select sum(cap) from leaves)) as budget from leaves group by domain", "", "domain")},
{_sql_split("l", f"select x.domain, x.lang, sum(x.cap) as cap, {w[1].replace('lang', 'x.lang')} as w, any_value(d.got) as budget from leaves x join d using (domain) group by x.domain, x.lang", "domain", "lang")},
{_sql_split("s", f"select x.domain, x.lang, x.source, x.cap, x.have, {w[2]} as w, l.got as budget from leaves x join l using (domain, lang)", "domain, lang", "source")},
plans as (select domain, lang, source, got // have as whole, got % have as rest from s),
dealt as (select u.*, p.whole, p.rest, md5(concat('{plan.seed}', ':', p.whole, ':', doc_id, ':', digest)) as key from units u join plans p using (domain, lang, source) where n_tokens > 0),
run as (select *, coalesce(sum(n_tokens) over (partition by domain, lang, source order by key rows between unbounded preceding and 1 preceding), 0) as pos from dealt)
select doc_id, domain, lang, source, epoch::int as epoch, n_tokens, n_tokens as take_tokens from (select *, unnest(range(whole::bigint)) as epoch from dealt where whole > 0)
union all
select doc_id, domain, lang, source, whole::int as epoch, n_tokens, least(n_tokens, rest - pos)::bigint as take_tokens from run where pos < rest"""
