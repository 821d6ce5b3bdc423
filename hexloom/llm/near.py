"""Near-duplicate documents: an LSH forest over MinHash signatures, links confirmed on full sets.

1. Each text becomes its set of word shingles, a hash of that set (texts with equal sets form
   one class, and go on as one row) and a signature of 128 minima.
2. The forest: each tree orders all classes by eight of the minima. Neighbours in an order
   have the longest common prefix, so a crowded region is told apart at a greater depth than
   a sparse one; neighbours that share at least ``MIN_DEPTH`` minima are candidates. Orders
   are range-partitioned with the class as last key, so that a region of any size spreads
   over tasks.
3. Candidates whose signatures allow the threshold are compared on their full sets.
4. Links give components; then all trees are read again for neighbours that are in
   different components. The first round reads two trees, which ties most of each large
   group together at two candidates for a member.
5. Regions whose classes share the first four minima of a tree, but are more than a window
   holds and not yet one component, are compared in full: cut by set size and by salt into
   blocks, every block with each that it can have links with, on full sets.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hexloom.llm import textvec as tv
from hexloom.llm.components import components
from hexloom.llm.workspace import KEY, boxed, discard, materialize, named, row_key, table, unboxed

N_MINIMA, TREES, DEPTH, MIN_DEPTH, LOOK = 128, 32, 8, 4, 3
#: a block of a crowded region: classes and shingles, about
BLOCK_ROWS, BLOCK_SHINGLES = 1024, 1 << 19
#: trees whose crowded regions are compared at once; what earlier ones link is not compared again
PASSES = ((0, 2), (2, 8), (8, TREES))
_U = np.uint64
FOREST = "tree int, s1 long, s2 long, c long, comp long, b1 long, b2 long"


def _seeds() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rng = np.random.default_rng(77)
    xor = rng.integers(0, 2**63, N_MINIMA, dtype=np.int64).astype(_U) * _U(2) + _U(1)
    odd = rng.integers(0, 2**63, N_MINIMA, dtype=np.int64).astype(_U) * _U(2) + _U(1)
    order = np.stack([rng.permutation(N_MINIMA)[:DEPTH] for _ in range(TREES)])
    # the first four minima of the trees are all different: 32 trees x 4
    order[:, :4] = rng.permutation(N_MINIMA).reshape(TREES, 4)
    return xor, odd, order


XOR, ODD, ORDER = _seeds()


def _sets(data: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    return tv.distinct(*tv.Words(data, offsets, lower=True).shingles(k, seed=7))[:2]


def _signature_rows(k: int):
    @tv.tidy()
    def run(batches):
        for rows, data, offsets in tv.text_rows(batches):
            n = len(offsets) - 1
            doc, h = _sets(data, offsets, k)
            count = np.bincount(doc, minlength=n)
            full = np.flatnonzero(count)
            sig, c = np.zeros((n, N_MINIMA), ">u2"), np.zeros(n, np.int64)
            if len(full):
                at = np.searchsorted(doc, full)
                with np.errstate(over="ignore"):
                    c[full] = tv.mix(np.add.reduceat(tv.mix(h + _U(11)), at) ^ (np.bitwise_xor.reduceat(tv.mix(h + _U(29)), at) * _U(3)) ^ count[full].astype(_U)).view(np.int64)
                    for j in range(N_MINIMA):
                        sig[full, j] = tv.mix(np.minimum.reduceat((h ^ XOR[j]) * ODD[j], at)) >> _U(48)
            raw = sig.tobytes()
            yield pa.RecordBatch.from_arrays(
                [rows.column("id"), *(rows.column(k) for k in KEY), pa.array(count.astype(np.int64)), pa.array(c), pa.array([raw[i * 2 * N_MINIMA : (i + 1) * 2 * N_MINIMA] for i in range(n)], pa.binary())],
                ["id", *KEY, "n_shingles", "c", "sig"],
            )

    return run


def _minima(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), ">u2").reshape(-1, N_MINIMA)


def _tree_rows(trees: int):
    @tv.tidy()
    def run(batches):
        for batch in batches:
            sig = _minima(batch.column("sig"))
            n = len(sig)
            bits = np.packbits((sig & 1).astype(bool), axis=1).view(">u8").astype(_U).view(np.int64)
            low = [pa.array(np.ascontiguousarray(bits[:, i])) for i in (0, 1)]
            for t in range(trees):
                s = np.ascontiguousarray(sig[:, ORDER[t]]).view(">u8").astype(_U).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(n, t, np.int32)), pa.array(s[:, 0]), pa.array(s[:, 1]), batch.column("c"), batch.column("comp"), *low], ["tree", "s1", "s2", "c", "comp", "b1", "b2"])

    return run


def _depth(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Common leading minima of the first four."""
    x = (x ^ y).view(_U)
    return (x < _U(1 << 48)).astype(int) + (x < _U(1 << 32)) + (x < _U(1 << 16)) + (x == 0)


def _neighbours(look: int, most: int):
    """Candidates among rows that follow each other, and the rows at either end of the partition.

    ``most``: how many of the 128 lowest bits of the minima may differ.
    """
    names = ["tree", "s1", "s2", "c", "comp", "b1", "b2"]

    @tv.tidy()
    def run(batches):
        tail, first = None, []
        for batch in batches:
            cols = [batch.column(n).to_numpy() for n in names]
            if tail is not None:
                cols = [np.concatenate(x) for x in zip(tail, cols, strict=True)]
            new = 0 if tail is None else len(tail[0])
            tree, s1, _, c, comp, b1, b2 = cols
            a, b = [], []
            for d in range(1, look + 1):
                i = np.arange(max(new - d, 0), max(len(c) - d, 0))
                j = i + d
                ok = (tree[i] == tree[j]) & (comp[i] != comp[j]) & (_depth(s1[i], s1[j]) >= MIN_DEPTH)
                i, j = i[ok], j[ok]
                ok = np.bitwise_count((b1[i] ^ b1[j]).view(_U)).astype(int) + np.bitwise_count((b2[i] ^ b2[j]).view(_U)) <= most
                a.append(c[i[ok]])
                b.append(c[j[ok]])
            a, b = np.concatenate(a), np.concatenate(b)
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b)), *(pa.nulls(len(a), t) for t in (pa.int32(), pa.int64(), pa.int64(), pa.int64()))], ["a", "b", "tree", "s1", "s2", "comp"])
            if sum(len(x[0]) for x in first) < look:
                first.append([x[new:][:look] for x in cols])
            tail = [x[-look:] for x in cols]
        if tail is not None:
            ends = [np.concatenate([*(f[i] for f in first), tail[i]]) for i in range(5)]
            yield pa.RecordBatch.from_arrays([pa.array(ends[3]), pa.nulls(len(ends[0]), pa.int64()), *(pa.array(ends[i]) for i in (0, 1, 2, 4))], ["a", "b", "tree", "s1", "s2", "comp"])

    return run


def _candidates(classes: DataFrame, trees: int, look: int, percent: int) -> DataFrame:
    """Distinct pairs (a, b) of classes that are neighbours in a tree and in different components."""
    n = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    forest = classes.select("c", "sig", "comp").mapInArrow(_tree_rows(trees), FOREST)
    forest = forest.repartitionByRange(n, "tree", "s1", "s2", "c").sortWithinPartitions("tree", "s1", "s2", "c")
    # linked texts differ in (1 - similarity) / 2 of these bits, give or take five standard deviations
    rate = (1 - percent / 100) / 2
    most = int(N_MINIMA * rate + 5 * (N_MINIMA * rate * (1 - rate)) ** 0.5) + 1
    found = materialize(forest.mapInArrow(_neighbours(look, most), "a long, b long, tree int, s1 long, s2 long, comp long"), "forest")
    # a few rows for each partition: pairs that lie across two partitions
    ends = found.where("tree is not null").distinct()
    w = Window.partitionBy("tree").orderBy("s1", "s2", "a")
    far = [F.lead(F.struct("a", "s1", "comp"), d).over(w).alias(f"_{d}") for d in range(1, look + 1)]
    ends = ends.select("a", "s1", "comp", *far)
    ends = ends.select("a", "s1", "comp", F.explode(F.array(*(f"_{d}" for d in range(1, look + 1)))).alias("o")).where((F.col("o.s1") == F.col("s1")) & (F.col("o.comp") != F.col("comp")))
    across = ends.select(F.least("a", "o.a").alias("a"), F.greatest("a", "o.a").alias("b"))
    out = found.where("b is not null").select("a", "b").unionByName(across).distinct()
    out.hexloom_paths = found.hexloom_paths
    return out


def _plausible(least: float, percent: int):
    """Pairs whose signatures and set sizes allow the threshold."""

    @tv.tidy()
    def run(batches):
        for batch in batches:
            x, y = _minima(batch.column("sa")), _minima(batch.column("sb"))
            na, nb = batch.column("na").to_numpy(), batch.column("nb").to_numpy()
            ok = ((x == y).mean(axis=1) >= least) & (100 * np.minimum(na, nb) >= percent * np.maximum(na, nb))
            yield batch.filter(pa.array(ok)).select(["a", "b"])

    return run


def _set_rows(k: int):
    @tv.tidy()
    def run(batches):
        for rows, data, offsets in tv.text_rows(batches):
            doc, h = _sets(data, offsets, k)
            at = np.searchsorted(doc, np.arange(len(offsets)))
            raw = h.tobytes()
            yield pa.RecordBatch.from_arrays([rows.column("c"), rows.column("copies"), pa.array([raw[8 * i : 8 * j] for i, j in zip(at[:-1], at[1:], strict=True)], pa.binary())], ["c", "copies", "shingles"])

    return run


def _linked(percent: int):
    @tv.tidy()
    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("xa"), batch.column("xb"), strict=True):
                x, y = np.frombuffer(x.as_buffer(), _U), np.frombuffer(y.as_buffer(), _U)
                both = np.intersect1d(x, y, assume_unique=True).size
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.filter(pa.array(keep, pa.bool_())).select(["a", "b"])

    return run


@tv.tidy()
def _region_rows(batches):
    for batch in batches:
        sig = _minima(batch.column("sig"))
        for t in range(TREES):
            s1 = np.ascontiguousarray(sig[:, ORDER[t, :4]]).view(">u8")[:, 0].astype(_U).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(sig), t, np.int32)), pa.array(s1), batch.column("c"), batch.column("n_shingles"), batch.column("comp")], ["tree", "s1", "c", "n", "comp"])


def block_links(sets: list[np.ndarray], comp: np.ndarray, side: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of linked sets that tie components of a block, or of two (``side`` 0 and 1), together."""
    label = np.unique(comp, return_inverse=True)[1]
    size = np.array([len(x) for x in sets])
    right = np.flatnonzero(side == side.max())
    owner = np.repeat(np.arange(len(right)), size[right])
    h = np.concatenate([sets[i] for i in right])
    by = np.argsort(h, kind="stable")
    h, owner = h[by], owner[by]
    a, b = [], []
    for i in np.flatnonzero(side == 0):
        if (label[right] == label[i]).all():
            continue
        lo, hi = np.searchsorted(h, sets[i], "left"), np.searchsorted(h, sets[i], "right")
        n = hi - lo
        at = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        both = np.bincount(owner[at], minlength=len(right))
        for j in right[100 * both >= percent * (size[i] + size[right] - both)]:
            if label[j] != label[i]:
                a.append(i)
                b.append(j)
                label[label == label[j]] = label[i]
    return np.array(a, np.int64), np.array(b, np.int64)


def _block_rows(percent: int):
    def run(group: pa.Table) -> pa.Table:
        c = group.column("c").to_numpy()
        sets = [np.frombuffer(x.as_buffer(), _U) for x in group.column("shingles")]
        a, b = block_links(sets, group.column("comp").to_numpy(), group.column("side").to_numpy(), percent)
        return pa.table({"a": pa.array(c[a]), "b": pa.array(c[b])})

    return run


def _crowded(classes: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Members (tree, s1, c, n) of regions that a window does not hold and that are not one component."""
    forest = _marked(classes, labels).select("c", "sig", "n_shingles", "comp").mapInArrow(_region_rows, "tree int, s1 long, c long, n long, comp long")
    regions = forest.groupBy("tree", "s1").agg(F.count("*").alias("members"), F.min("comp").alias("lo"), F.max("comp").alias("hi"))
    regions = materialize(regions.where((F.col("members") > LOOK + 1) & (F.col("lo") < F.col("hi"))).select("tree", "s1"), "regions")
    return materialize(forest.join(regions, ["tree", "s1"]).select("tree", "s1", "c", "n"), "crowded")


def _region_links(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) among ``members`` (tree, s1, c, n, comp) of each region, enough to tie it together as all would."""
    cell = ["tree", "s1", "size", "salt"]
    # linked sets are in one size class or in neighbouring ones
    m = members.withColumn("size", F.floor(F.log("n") / F.log(F.lit(100 / percent + 0.01))).cast("int"))
    blocks = F.ceil(F.greatest(F.count("*") / BLOCK_ROWS, F.sum("n") / BLOCK_SHINGLES))
    blocks = materialize(m.groupBy(*cell[:3]).agg(blocks.cast("long").alias("_blocks")), "blocks")
    m = m.join(blocks, cell[:3]).withColumn("salt", F.pmod(F.xxhash64("c", F.lit("block")), "_blocks")).select(*cell, "c", "comp")
    m = materialize(m, "members")
    cells = materialize(m.groupBy(*cell).agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")), "cells")
    x, y = cells.alias("x"), cells.alias("y")
    meet = "x.tree = y.tree and x.s1 = y.s1 and (x.size = y.size and x.salt <= y.salt or x.size + 1 = y.size)"
    pairs = x.join(y, F.expr(meet)).where("least(x.lo, y.lo) < greatest(x.hi, y.hi)")
    pairs = pairs.select(F.monotonically_increasing_id().alias("pair"), "x.tree", "x.s1", *(F.col(f"{s}.{c}").alias(f"{s}_{c}") for s in "xy" for c in ("size", "salt")))
    pairs = materialize(pairs, "blockpairs")
    sides = pairs.select("pair", "tree", "s1", F.col("x_size").alias("size"), F.col("x_salt").alias("salt"), F.lit(0).alias("side"))
    other = pairs.where("x_size <> y_size or x_salt <> y_salt").select("pair", "tree", "s1", F.col("y_size").alias("size"), F.col("y_salt").alias("salt"), F.lit(1).alias("side"))
    rows = sides.unionByName(other).join(m, cell).select("pair", "side", "c", "comp").join(sets, "c")
    out = rows.groupBy("pair").applyInArrow(_block_rows(percent), "a long, b long").distinct()
    out.hexloom_paths = sum((x.hexloom_paths for x in (blocks, m, cells, pairs)), ())
    return out


def _marked(classes: DataFrame, labels: DataFrame | None) -> DataFrame:
    """``classes`` with their component ``comp``."""
    if labels is None:
        return classes.withColumn("comp", F.col("c"))
    return classes.join(labels, "c", "left").withColumn("comp", F.coalesce("label", "c")).drop("label")


def assign(texts: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """``(id, KEY, n_shingles, component_id)`` of each row of ``texts`` (id, KEY, text); see :func:`near_duplicates`."""
    signed = materialize(texts.mapInArrow(_signature_rows(k), f"id long, {', '.join(f'{x} long' for x in KEY)}, n_shingles long, c long, sig binary"), "signatures")
    # a class is a set of shingles; its texts are alike, and one of them stands for it
    classes = signed.where("n_shingles > 0").groupBy("c").agg(F.min(F.struct(*KEY, "n_shingles", "sig")).alias("one"), (F.count("*") > 1).alias("copies"))
    classes = materialize(classes.select("c", "copies", "one.*"), "classes")

    def sets_of(needed):
        wanted = classes.select("c", "copies", *KEY).join(needed, "c")
        found = materialize(texts.join(wanted, KEY).select("c", "copies", "text").mapInArrow(_set_rows(k), "c long, copies boolean, shingles binary"), "sets")
        # repeated rows of a text give its set more than once
        once = found.where("not copies").unionByName(found.where("copies").dropDuplicates(["c"])).select("c", "shingles")
        once.hexloom_paths = found.hexloom_paths
        return once

    def labels_of(links):
        return components(links).select(F.col("node").alias("c"), F.col("component").alias("label"))

    labels, links, tried, used = None, None, None, []
    for trees, look in ((2, 1), (TREES, LOOK)):
        found = _candidates(_marked(classes, labels), trees, look, percent)
        # a pair is compared in one round only
        pairs = materialize(found if tried is None else found.join(tried, ["a", "b"], "left_anti"), "candidates")
        discard(found)
        tried = pairs
        side = lambda s: classes.select(F.col("c").alias(s), F.col("n_shingles").alias(f"n{s}"), F.col("sig").alias(f"s{s}"))
        five_sigma = percent / 100 - 5 * (percent / 100 * (1 - percent / 100) / N_MINIMA) ** 0.5
        pairs = materialize(pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(_plausible(five_sigma, percent), "a long, b long"), "pairs")
        sets = sets_of(pairs.select(F.col("a").alias("c")).unionByName(pairs.select(F.col("b").alias("c"))).distinct())
        mine = pairs.join(sets.select(F.col("c").alias("a"), F.col("shingles").alias("xa")), "a").join(sets.select(F.col("c").alias("b"), F.col("shingles").alias("xb")), "b")
        new = materialize(mine.mapInArrow(_linked(percent), "a long, b long"), "links")
        discard(pairs, sets)
        used += [tried, new]
        if new.head(1):
            links = new if links is None else links.unionByName(new)
            labels = labels_of(links)
    # the windows do not move from here on: what they cannot hold is compared in full
    crowded = _crowded(classes, labels)
    used.append(crowded)
    if crowded.head(1):
        sets = sets_of(crowded.select("c").distinct())
        used.append(sets)
        for lo, hi in PASSES:
            members = _marked(crowded.where(F.col("tree").between(lo, hi - 1)), labels)
            found = _region_links(members, sets, percent)
            new = materialize(found, "links")
            discard(found)
            used.append(new)
            if new.head(1):
                links = new if links is None else links.unionByName(new)
                labels = labels_of(links)
    ids = signed.where("n_shingles > 0").groupBy("c").agg(F.min("id").alias("least"))
    labelled = ids.join(labels, "c", "left").withColumn("label", F.coalesce("label", "c")) if labels is not None else ids.withColumn("label", F.col("c"))
    # written first: the join can then split a component of very many classes
    lowest = materialize(labelled.groupBy("label").agg(F.min("least").alias("component_id")), "lowest")
    of_class = materialize(labelled.join(lowest, "label").select("c", "component_id"), "of_class")
    discard(classes, lowest, *used)
    alone = signed.where("n_shingles = 0").select("id", *KEY, "n_shingles", F.col("id").alias("component_id"))
    return signed.where("n_shingles > 0").join(of_class, "c").select("id", *KEY, "n_shingles", "component_id").unionByName(alone)


def _texts(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(named(key).cast("long").alias("id"), *row_key(key, text), named(text).alias("text"))


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Rows of ``docs`` with n_shingles, component_id and kept (columns of those names are replaced).

    Two texts are linked if 100 * common shingles >= ``percent`` * shingles of either. Shingles
    are runs of ``k`` words, A-Z lower-cased; a text of fewer words is one shingle. component_id is
    the least id reachable; kept: it is the row's own id. Texts without words (null, empty)
    have no shingles, are linked with nothing and are kept. A row without id takes part; if a
    component has no id at all, its component_id is null and its rows are kept. Rows of one id
    with other texts are separate; repeated rows share a component and, having its id, all
    stay. Texts may have any length; other columns may have any names. An empty table gives
    an empty result.
    """
    found = assign(_texts(docs, key, text), k, percent).dropDuplicates(KEY)
    new = ["n_shingles", "component_id"]
    joined = boxed(docs, key, text).join(found.select(*KEY, *new, F.col("component_id").eqNullSafe(F.col("id")).alias("kept")), KEY)
    return joined.select(*unboxed([c for c in docs.columns if c not in (*new, "kept")], *new, "kept"))


def op7(spark, sf_dir: str) -> DataFrame:
    found = assign(_texts(table(spark, sf_dir, "documents"), "doc_id", "text"), k=2)
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", F.col("component_id").eqNullSafe(F.col("id")).alias("kept"))


#: all pairs with a shingle in common, then everything that can be reached: for small tables
ORACLE = """
with recursive w as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') as ws from documents),
s as (select distinct doc_id, unnest(case when len(ws) = 1 then [ws[1]] else list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]) end) as shingle from w),
n as (select doc_id, count(*) as n from s group by doc_id),
pairs as (select a.doc_id as x, b.doc_id as y, count(*) as c from s a join s b on a.shingle = b.shingle and a.doc_id < b.doc_id group by a.doc_id, b.doc_id),
links as (select x, y from pairs join n p on p.doc_id = x join n q on q.doc_id = y where 100 * c >= 80 * (p.n + q.n - c)),
ways as (select x, y from links union all select y, x from links),
reach as (select doc_id as x, doc_id as y from documents union select r.x, k.y from reach r join ways k on r.y = k.x),
least as (select x, min(y) as component_id from reach group by x)
select d.doc_id, coalesce(n.n, 0)::bigint as n_shingles, component_id, component_id = d.doc_id as kept
from documents d join least on least.x = d.doc_id left join n on n.doc_id = d.doc_id"""
