import random
import re

from pyspark.sql import functions as F

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


INNER = ("_k", "_th", "_key", "_take", "_spans", "row", "row_a", "row_b", "key", "id", "digest", "level0", "copies", "c", "range", "tie", "runs", "start", "end", "label", "one", "a.b", "sig", "x", "order", "made", "shard")


def untouched(out):
    """The columns of INNER hold in every row what they held before."""
    return all(r[c] == f"own {c}" for r in out.select(*(f"`{c}`" for c in INNER)).collect() for c in INNER)


def rows(seed=3, n=60):
    """Documents with copies, near copies, repeats, junk, nulls, empty and long texts, and repeated rows."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice(["an", "th", "é", "on", "Ous", "der", "日"]) for _ in range(r.randint(1, 4)))
    prose = lambda k: "".join(word() + r.choice([" ", " ", " ", ", ", ".\n"]) for _ in range(k))
    out = [(i, prose(r.randint(1, 150))) for i in range(n)]
    base = prose(160).split(" ")
    for i in range(12):
        t = list(base)
        for _ in range(i):
            t[r.randrange(len(t))] = word()
        out.append((n + i, " ".join(t)))
    out += [(200, out[0][1]), (201, out[0][1].upper()), (202, "to " * 120), (203, "### $$$ *** " * 20), (204, None), (205, ""), (206, " \n\t "), (207, "one"), (208, "one two"), (209, "One  two")]
    out += [(210, prose(9000)), (None, prose(80)), (None, out[1][1]), out[2], out[2], (3, prose(60))]
    return out


def frame(spark, data=None, extra=False):
    df = spark.createDataFrame(rows() if data is None else data, "doc_id long, text string").repartition(3)
    if extra:
        df = df.withColumns({"kept": F.lit("mine"), "h": F.lit(1), "n_words": F.lit("x"), "component_id": F.lit(-1), "epoch": F.lit(9), "_c": F.lit(2)})
        # names that operators use, or used, inside; none may be read or changed
        df = df.withColumns({c: F.lit(f"own {c}") for c in INNER})
    return df


def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string")
