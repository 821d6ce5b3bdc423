import math
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from hexloom.functions import cells, geometry, grid


def test_parent_of_known_cell(spark):
    df = spark.createDataFrame([("85283473fffffff",), (None,)], "s string").select(cells.from_string(F.col("s")).alias("c"))
    r = df.select(cells.to_string(cells.parent(F.col("c"), 4)).alias("p"), cells.resolution(F.col("c")).alias("r"), cells.to_string(F.col("c")).alias("s")).collect()
    assert r[0] == ("8428347ffffffff", 5, "85283473fffffff") and r[1] == (None, None, None)


def test_parents_compose(spark):
    df = spark.range(3000).select(cells.synthetic(F.col("id") * 7919).alias("c"))
    for a, b in ((9, 4), (5, 5), (7, 0)):
        assert df.where(cells.parent(cells.parent(F.col("c"), a), b) != cells.parent(F.col("c"), b)).count() == 0
    with pytest.raises(ValueError):
        cells.parent(F.col("c"), 16)


PUBLISHED = [(37.3615593, -122.0553238, "85283473fffffff"), (37.3615593, -122.0553238, "87283472bffffff"), (37.769377, -122.388903, "89283082e73ffff"), (40.689167, -74.044444, "8a2a1072b59ffff"), (37.775938728915946, -122.41795063018799, "8928308280fffff")]


def test_published_cells():
    for lat, lng, name in PUBLISHED:
        res = int(name[1], 16)
        assert f"{int(grid.encode([lat], [lng], res)[0]):x}" == name
    lat, lng = grid.decode([int(c, 16) for c in ("87283472bffffff", "8a2a1072b59ffff", "8075fffffffffff")])
    assert np.allclose(lat, [37.35171820183272, 40.6894218437, 2.3008821116267]) and np.allclose(lng, [-122.05032565263946, -74.0444313999, -5.245390296777327])


def test_grid_counts_and_pentagons():
    t = grid.layout()
    assert np.flatnonzero(t["pent"]).tolist() == [4, 14, 24, 38, 49, 58, 63, 72, 83, 97, 107, 117]
    rng = np.random.default_rng(1)
    lat, lng = np.degrees(np.arcsin(rng.uniform(-1, 1, 200_000))), rng.uniform(-180, 180, 200_000)
    # 2 + 120 * 7^res cells
    assert [len(np.unique(grid.encode(lat, lng, r))) for r in (0, 1, 2)] == [122, 842, 5882]


@pytest.mark.parametrize("res", range(16))
def test_cells_round_trip(res):
    rng = np.random.default_rng(res)
    lat, lng = np.degrees(np.arcsin(rng.uniform(-1, 1, 20_000))), rng.uniform(-180, 180, 20_000)
    # poles, the antimeridian, and places round every pentagon
    pent = np.array(list(zip(*grid.decode([(1 << 59) | (b << 45) | (1 << 45) - 1 for b in np.flatnonzero(grid.layout()["pent"])]))))
    ring = np.concatenate([pent + rng.normal(size=(12, 2)) * s for s in (0, 1e-6, 1e-4, 0.01, 0.3, 3) for _ in range(20)])
    lat = np.concatenate([lat, [90, -90, 89.999999, 0, 45, -45], ring[:, 0]])
    lng = np.concatenate([lng, [0, 0, 12, 180, -180, 179.9999999], ring[:, 1]])
    cells_ = grid.encode(lat, lng, res)
    back = grid.decode(cells_)
    assert (grid.encode(*back, res) == cells_).all()
    p, q = (grid._xyz(np.radians(x), np.radians(y)) for x, y in ((lat, lng), back))
    # no point is farther from its centre than a cell's corner can be
    assert np.linalg.norm(p - q, axis=1).max() < 0.23 / 7 ** (res / 2)
    # no pentagon has cells in its missing direction
    digits = (cells_[:, None] >> (3 * (14 - np.arange(res)))) & 7
    assert not (grid.layout()["pent"][(cells_ >> 45) & 127] & (grid._lead(digits) == 1)).any()


def test_no_cell():
    assert grid.encode([np.nan, np.inf, 1.0], [0.0, 0.0, np.nan], 5).tolist() == [0, 0, 0]
    assert np.isnan(grid.decode([0, -1, (1 << 59) | (122 << 45)])).all()
    with pytest.raises(ValueError):
        grid.encode([0.0], [0.0], 16)


def test_cell_columns(spark):
    df = spark.createDataFrame([(lat, lng) for lat, lng, _ in PUBLISHED] + [(None, 1.0), (1.0, None)], "lat double, lng double")
    got = df.select(cells.to_string(cells.latlng_to_cell(F.col("lat"), F.col("lng"), 7)).alias("c"), cells.cell_to_latlng(cells.latlng_to_cell(F.col("lat"), F.col("lng"), 7)).alias("at")).collect()
    assert got[1].c == "87283472bffffff" and math.isclose(got[1].at.lat, 37.35171820183272) and [r.c for r in got[5:]] == [None, None] and got[5].at.lat is None


def wkb(kind, body, order="<"):
    return (b"\1" if order == "<" else b"\0") + struct.pack(order + "I", kind) + body


def ring(points):
    return struct.pack("<I", len(points)) + b"".join(struct.pack("<2d", *p) for p in points)


SQUARE = [(0, 0), (4, 0), (4, 4), (0, 4), (0, 0)]
HOLE = [(0, 0), (0, 2), (2, 2), (2, 0), (0, 0)]


def test_centroids():
    c = geometry.centroid_of
    assert c(wkb(1, struct.pack("<2d", 3, 4))) == (3, 4)
    assert c(wkb(1, struct.pack(">2d", 3, 4), ">")) == (3, 4)
    assert c(wkb(1001, struct.pack("<3d", 3, 4, 9))) == (3, 4)
    assert c(wkb(1 | 0x20000000, struct.pack("<I2d", 4326, 3, 4))) == (3, 4)
    assert c(wkb(2, ring([(0, 0), (2, 0), (2, 6)]))) == (1.75, 2.25)
    assert c(wkb(3, struct.pack("<I", 1) + ring(SQUARE))) == (2, 2)
    x, y = c(wkb(3, struct.pack("<I", 2) + ring(SQUARE) + ring(HOLE)))
    assert math.isclose(x, (16 * 2 - 4 * 1) / 12) and math.isclose(x, y)
    both = wkb(7, struct.pack("<I", 2) + wkb(1, struct.pack("<2d", 100, 100)) + wkb(2, ring([(0, 0), (2, 0)])))
    assert c(both) == (1, 0)
    assert c(wkb(3, struct.pack("<I", 1) + ring([(1, 1), (1, 1)]))) == (1, 1)
    assert c(wkb(3, struct.pack("<I", 0))) is None and c(None) is None and c(wkb(1, struct.pack("<2d", math.nan, math.nan))) is None


def test_centroid_column(spark):
    shapes = [wkb(1, struct.pack("<2d", 5, 6)), None, wkb(2, ring([(0, 0), (2, 0)])), wkb(1, struct.pack(">2d", 3, 4), ">"), b"", wkb(1, struct.pack("<2d", math.nan, math.nan))]
    many = spark.createDataFrame([(i, None if g is None else bytearray(g)) for i, g in enumerate(shapes * 50)], "i int, g binary")
    for r in many.select("i", "g", geometry.centroid(F.col("g")).alias("p")).collect():
        assert (r.p and r.p.lon is not None and tuple(r.p) or None) == geometry.centroid_of(r.g and bytes(r.g))
    df = spark.createDataFrame([(bytearray(wkb(1, struct.pack("<2d", 5, 6))),), (None,)], "g binary")
    assert [r.p and tuple(r.p) for r in df.select(geometry.centroid(F.col("g")).alias("p")).collect()] in ([(5.0, 6.0), None], [(5.0, 6.0), (None, None)])


def test_reference_system(spark, tmp_path):
    df = spark.range(2).withColumn("geometry", geometry.point(F.col("id").cast("double"), F.lit(1.0)))
    assert geometry.crs_of(df) is None
    geometry.set_crs(df, "geometry", "EPSG:4326").write.parquet(f"{tmp_path}/g")
    assert geometry.crs_of(spark.read.parquet(f"{tmp_path}/g")) == "EPSG:4326"


def test_haversine_and_e6(spark):
    r = spark.range(1).select(geometry.haversine(F.lit(0.0), F.lit(0.0), F.lit(90.0), F.lit(0.0)).alias("m"), geometry.e6(F.lit(-1.2345675)).alias("e")).first()
    assert math.isclose(r.m, math.pi / 2 * geometry.EARTH_M) and r.e in (-1234568, -1234567)
