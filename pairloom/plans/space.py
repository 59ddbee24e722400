"""Queries over neighbours, masks, fills, components, losses and images."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.operators import choice, distance, grid, metrics, neighbours, pixels
from pairloom.plans.core import _REGION, _region, _vox
from pairloom.plans.fixtures import fixture, with_fixtures
from pairloom.plans.registry import query
from pairloom.session import stored, table

_SIX = "(VALUES (1, 0, 0), (-1, 0, 0), (0, 1, 0), (0, -1, 0), (0, 0, 1), (0, 0, -1)) o(p, q, r)"
_AT = lambda a, b: " AND ".join(f"{a}.{c} = {b}.{c}" for c in ("pair_id", "x", "y", "z"))


def _hf(sql: str) -> str:
    return with_fixtures(sql, "fx_half")


def _half(s, d) -> DataFrame:
    return stored(fixture(s, d, "fx_half"))


def _edit(cells: DataFrame) -> DataFrame:
    return cells.where("part_id = 3").select(*grid.CELL)


_D2 = "(a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) + (a.z - b.z) * (a.z - b.z)"


@query("nnb1_nearest_cell", _hf(f"""WITH a AS (SELECT * FROM fx_half WHERE in_after = 1 AND in_before = 0), b AS (SELECT * FROM fx_half WHERE in_before = 1)
 SELECT pair_id, x, y, z, m.d AS d2, m.bx AS sx, m.by AS sy, m.bz AS sz FROM (SELECT a.pair_id, a.x, a.y, a.z, min({{'d': {_D2}, 'bx': b.x, 'by': b.y, 'bz': b.z}}) AS m FROM a JOIN b ON a.pair_id = b.pair_id GROUP BY ALL)"""))
def nnb1(s, d):
    h = _half(s, d)
    n = neighbours.nearest(h.where("in_after = 1 AND in_before = 0"), h.where("in_before = 1").select(*grid.CELL), side=2.0)
    return n.select(*grid.CELL, F.col("d2").cast("int").alias("d2"), F.col("s.x").alias("sx"), F.col("s.y").alias("sy"), F.col("s.z").alias("sz"))


@query("nnb7_five_nearest", _hf(f"""WITH a AS (SELECT * FROM fx_half WHERE part_id = 3), b AS (SELECT * FROM fx_half WHERE part_id <> 3), n AS (SELECT a.pair_id, a.x, a.y, a.z, {_D2} AS d2, CAST(row_number() OVER (PARTITION BY a.pair_id, a.x, a.y, a.z ORDER BY {_D2}, b.x, b.y, b.z) AS INT) AS rank, b.x AS sx FROM a JOIN b ON a.pair_id = b.pair_id)
 SELECT pair_id, x, y, z, rank, d2, sx FROM n WHERE rank <= 5"""))
def nnb7(s, d):
    h = _half(s, d)
    return neighbours.nearest(_edit(h), h.where("part_id <> 3").select(*grid.CELL), 5, 2.0).select(*grid.CELL, "rank", F.col("d2").cast("int").alias("d2"), F.col("s.x").alias("sx"))


_POINTS = """pts AS (SELECT vec_id, label, vec_id % 2 AS half, embedding[1]::DOUBLE AS x, embedding[2]::DOUBLE AS y, embedding[3]::DOUBLE AS z, embedding[4]::DOUBLE AS nx, embedding[5]::DOUBLE AS ny, embedding[6]::DOUBLE AS nz FROM embeddings),
 near AS (SELECT a.label, a.half, a.vec_id, min({'d': sqrt(pow(a.x - b.x, 2) + pow(a.y - b.y, 2) + pow(a.z - b.z, 2)), 'dot': abs(a.nx * b.nx + a.ny * b.ny + a.nz * b.nz)}) AS m, any_value(a.x) AS x, any_value(a.y) AS y, any_value(a.z) AS z FROM pts a JOIN pts b ON a.label = b.label AND a.half <> b.half GROUP BY ALL)"""


def _points(s, d) -> DataFrame:
    e = F.col("embedding")
    return stored(table(s, d, "embeddings").select("vec_id", "label", (F.col("vec_id") % 2).alias("half"), *[e[i].cast("double").alias(c) for i, c in enumerate(("x", "y", "z", "nx", "ny", "nz"))]))


def _halves(s, d) -> tuple[DataFrame, DataFrame]:
    p = _points(s, d)
    return p.where("half = 0").drop("half", "vec_id"), p.where("half = 1").drop("half", "vec_id")


@query("nnb2_surface_distances", f"""WITH {_POINTS}, w AS (SELECT label, half, avg(m.d) AS d, avg(m.dot) AS n, avg((m.d <= 0.1)::INT) * 100 AS within FROM near GROUP BY ALL)
 SELECT a.label, round((a.d + b.d) / 2 * 1000, 4) AS chamfer, round((a.n + b.n) / 2, 6) AS normals, round(a.within, 4) AS precision, round(b.within, 4) AS recall, round(2 * a.within * b.within / greatest(a.within + b.within, 1e-8), 4) AS fscore FROM w a JOIN w b USING (label) WHERE a.half = 0 AND b.half = 1""")
def nnb2(s, d):
    m = neighbours.surface_distances(*_halves(s, d), "label", 0.1, 0.1)
    return m.select("label", F.round("chamfer", 4).alias("chamfer"), F.round("normals", 6).alias("normals"), *[F.round(c, 4).alias(c) for c in ("precision", "recall", "fscore")])


@query("nnb3_gap_distance", f"WITH {_POINTS} SELECT label, round(quantile_cont(m.d, 0.1), 6) AS gap FROM near WHERE half = 0 GROUP BY label")
def nnb3(s, d):
    return neighbours.gap_distance(*_halves(s, d), "label", 0.1).withColumn("gap", F.round("gap", 6))


@query("nnb6_contact_centroid", f"""WITH {_POINTS}, e AS (SELECT *, m.d AS d, greatest(max(x) OVER w - min(x) OVER w, max(y) OVER w - min(y) OVER w, max(z) OVER w - min(z) OVER w) AS ext, count(*) OVER w AS n, row_number() OVER (PARTITION BY label ORDER BY m.d, x, y, z) AS place FROM near WHERE half = 0 WINDOW w AS (PARTITION BY label)),
 f AS (SELECT *, d < greatest(0.02, ext * 0.05) AS near_by FROM e), g AS (SELECT *, count_if(near_by) OVER (PARTITION BY label) AS k FROM f)
 SELECT label, round(avg(x), 6) AS x, round(avg(y), 6) AS y, round(avg(z), 6) AS z FROM g WHERE CASE WHEN k >= 10 THEN near_by ELSE place <= greatest(10, n // 10) END GROUP BY label""")
def nnb6(s, d):
    return neighbours.contact_centroid(*_halves(s, d), "label", 0.1).select("label", *[F.round(a, 6).alias(a) for a in "xyz"])


_LABELS = """h AS (SELECT *, vec_id // 2 % 7 AS part FROM (SELECT vec_id, label, vec_id % 2 AS half, embedding[1]::DOUBLE AS x, embedding[2]::DOUBLE AS y, embedding[3]::DOUBLE AS z FROM embeddings)), box AS (SELECT label, half, min(x) AS lx, max(x) AS hx, min(y) AS ly, max(y) AS hy, min(z) AS lz, max(z) AS hz FROM h GROUP BY ALL),
 s AS (SELECT h.label, part, CASE WHEN b.hx > b.lx THEN (x - b.lx) * ((t.hx - t.lx) / (b.hx - b.lx)) ELSE x - b.lx END + t.lx AS x, CASE WHEN b.hy > b.ly THEN (y - b.ly) * ((t.hy - t.ly) / (b.hy - b.ly)) ELSE y - b.ly END + t.ly AS y, CASE WHEN b.hz > b.lz THEN (z - b.lz) * ((t.hz - t.lz) / (b.hz - b.lz)) ELSE z - b.lz END + t.lz AS z
  FROM h JOIN box b ON b.label = h.label AND b.half = 1 JOIN box t ON t.label = h.label AND t.half = 0 WHERE h.half = 1),
 labelled AS (SELECT a.label AS obj, a.vec_id, arg_min(s.part, pow(a.x - s.x, 2) + pow(a.y - s.y, 2) + pow(a.z - s.z, 2)) AS label FROM h a JOIN s ON a.label = s.label WHERE a.half = 0 GROUP BY a.label, a.vec_id)"""


def _labelled(s, d) -> DataFrame:
    p = _points(s, d).withColumn("obj", F.col("label")).withColumn("part", (F.floor(F.col("vec_id") / 2) % 7).cast("int"))
    cells = p.select("obj", "x", "y", "z", "half", F.col("part").alias("label"))
    return neighbours.transferred_labels(cells.where("half = 0"), cells.where("half = 1").drop("half"), "obj", 0.1)


@query("nnb4_transferred_labels", f"WITH {_LABELS} SELECT obj, CAST(label AS INT) AS label, count(*) AS n FROM labelled GROUP BY ALL")
def nnb4(s, d):
    return _labelled(s, d).groupBy("obj", "label").agg(F.count(F.lit(1)).alias("n"))


@query("nnb5_face_deletion", f"WITH {_LABELS}, k AS (SELECT obj, count_if(label NOT IN (obj % 7, 3)) AS n_kept, count_if(label IN (obj % 7, 3)) AS n_dropped FROM labelled GROUP BY obj) SELECT *, CASE WHEN n_kept = 0 THEN 'reject' WHEN n_dropped = 0 THEN 'warn' ELSE 'ok' END AS verdict FROM k")
def nnb5(s, d):
    chosen = table(s, d, "embeddings").select(F.col("label").alias("obj")).distinct().select("obj", F.array((F.col("obj") % 7).cast("int"), F.lit(3)).alias("pids"))
    return neighbours.without_labels(_labelled(s, d), chosen, "obj")


#: The cells that are edited: those of a part; in some pairs the whole object, which leaves nothing to touch, or nothing.
_EDITED = "(part_id = 3 OR pair_id % 6 = 0) AND pair_id % 7 <> 5"
_CONTACT = f"""WITH region AS (SELECT pair_id, x, y, z FROM fx_half WHERE {_EDITED}), pres AS (SELECT pair_id, x, y, z FROM fx_half WHERE in_before = 1 AND NOT ({_EDITED})),
 touched AS (SELECT DISTINCT g.* FROM region g CROSS JOIN {_SIX} JOIN pres b ON b.pair_id = g.pair_id AND b.x = g.x + p AND b.y = g.y + q AND b.z = g.z + r),
 surface AS (SELECT DISTINCT pair_id, x + p AS x, y + q AS y, z + r AS z FROM region CROSS JOIN {_SIX} WHERE least(x + p, y + q, z + r) >= 0 AND greatest(x + p, y + q, z + r) < 16 EXCEPT SELECT * FROM region),
 n AS (SELECT g.pair_id, (SELECT count(*) FROM touched t WHERE t.pair_id = g.pair_id) AS n_contact, (SELECT count(*) FROM surface u WHERE u.pair_id = g.pair_id) AS n_surface FROM (SELECT DISTINCT pair_id FROM region) g),
 ratios AS (SELECT *, least(n_contact / greatest(n_surface, 1), 1) AS ratio FROM n) """


def _edited(cells: DataFrame) -> DataFrame:
    return cells.where(_EDITED).select(*grid.CELL)


@query("vox13_contact_boundary", _hf(_CONTACT + "SELECT pair_id, n_contact, n_surface, round(ratio, 6) AS ratio, round(1.5::DOUBLE + 4 * ratio, 6) AS sigma1, round(2::DOUBLE + 10 * ratio, 6) AS sigma2 FROM ratios"))
def vox13(s, d):
    h = _half(s, d)
    counts = grid.contact(_edited(h), h.where("in_before = 1"), 16)[1]
    return counts.select("pair_id", "n_contact", "n_surface", *[F.round(c, 6).alias(c) for c in ("ratio", "sigma1", "sigma2")])


@query("vox14_distance_decay", _hf(_CONTACT + f", near AS (SELECT a.pair_id, a.x, a.y, a.z, min({_D2}) AS d2 FROM pres a JOIN touched b ON a.pair_id = b.pair_id GROUP BY ALL) SELECT p.*, round(coalesce(exp(-sqrt(d2) / (2::DOUBLE + 10 * ratio)), 0), 6) AS weight FROM pres p LEFT JOIN near USING (pair_id, x, y, z) LEFT JOIN ratios USING (pair_id)"))
def vox14(s, d):
    h = _half(s, d)
    touched, counts = grid.contact(_edited(h), h.where("in_before = 1"), 16)
    kept = h.where(f"in_before = 1 AND NOT ({_EDITED})").select(*grid.CELL).join(counts.select("pair_id", "sigma2"), "pair_id", "left")
    return distance.decay(kept, touched, F.col("sigma2")).select(*grid.CELL, F.round("weight", 6).alias("weight"))


@query("vox14_squared_distances", _hf(_CONTACT + f"SELECT a.pair_id, a.x, a.y, a.z, min({_D2})::BIGINT AS d2 FROM fx_half a LEFT JOIN pres b ON a.pair_id = b.pair_id GROUP BY ALL"))
def vox14_distances(s, d):
    h = _half(s, d)
    return distance.squared_distances(h.select(*grid.CELL), h.where(f"in_before = 1 AND NOT ({_EDITED})"))


_BLOCKS = "edited AS (SELECT pair_id, x // 4 AS x, y // 4 AS y, z // 4 AS z FROM region GROUP BY ALL HAVING count(*) * 10 >= 64), pairs AS (SELECT DISTINCT pair_id FROM fx_half), dense AS (SELECT pair_id, i.range::INT AS x, j.range::INT AS y, k.range::INT AS z FROM pairs, range(4) i, range(4) j, range(4) k)"


@query("vox15_block_decay", _hf(_CONTACT + f""", {_BLOCKS}, touching AS (SELECT DISTINCT pair_id, x // 4 AS x, y // 4 AS y, z // 4 AS z FROM touched), ref AS (SELECT * FROM touching UNION ALL SELECT * FROM edited WHERE pair_id NOT IN (SELECT pair_id FROM touching)),
 near AS (SELECT a.pair_id, a.x, a.y, a.z, min({_D2}) AS d2 FROM dense a JOIN ref b ON a.pair_id = b.pair_id GROUP BY ALL)
 SELECT g.*, round(CASE WHEN e.pair_id IS NOT NULL THEN 0 ELSE coalesce(1 - exp(-sqrt(d2) / 3), 1) END, 6) AS keep FROM dense g LEFT JOIN near USING (pair_id, x, y, z) LEFT JOIN edited e ON {_AT("e", "g")}"""))
def vox15(s, d):
    h = _half(s, d)
    region = _edited(h)
    touched = grid.contact(region, h.where("in_before = 1"), 16)[0]
    kept = distance.block_keep(grid.every_cell(h, 4), grid.downsample(touched, 4), grid.keep_blocks(region), 3.0)
    return kept.select(*grid.CELL, F.round("keep", 6).alias("keep"))


@query("vox6_soft_keep", _hf(_CONTACT + f""", {_BLOCKS}, hard AS (SELECT g.*, CASE WHEN e.pair_id IS NULL THEN 1 ELSE 0 END AS keep FROM dense g LEFT JOIN edited e ON {_AT("e", "g")}),
 blur AS (SELECT h.pair_id, h.x, h.y, h.z, any_value(h.keep) AS own, avg(b.keep) AS near FROM hard h CROSS JOIN range(-1, 2) p(p) CROSS JOIN range(-1, 2) q(q) CROSS JOIN range(-1, 2) r(r) JOIN hard b ON b.pair_id = h.pair_id AND b.x = greatest(least(h.x + p, 3), 0) AND b.y = greatest(least(h.y + q, 3), 0) AND b.z = greatest(least(h.z + r, 3), 0) GROUP BY ALL)
 SELECT pair_id, x, y, z, round(greatest(own, near), 6) AS keep FROM blur"""))
def vox6(s, d):
    h = _half(s, d)
    return grid.soft_keep(_edited(h), 4, 1.0, pairs=h).select(*grid.CELL, F.round("keep", 6).alias("keep"))


@query("vox5_dense_keep", _hf(_CONTACT + f", {_BLOCKS} SELECT g.*, CASE WHEN e.pair_id IS NULL THEN 1 ELSE 0 END AS keep FROM dense g LEFT JOIN edited e ON {_AT('e', 'g')}"))
def vox5(s, d):
    h = _half(s, d)
    return grid.dense_keep(_edited(h), 4, pairs=h)


@query("vox2_coarse_region", _hf("SELECT DISTINCT pair_id, x // 4 AS x, y // 4 AS y, z // 4 AS z FROM fx_half WHERE part_id = 3"))
def vox2(s, d):
    return grid.downsample(_edit(fixture(s, d, "fx_half")), 4)


@query("vox8_part_keep", _hf("WITH t AS (SELECT DISTINCT pair_id, x // 4 AS b0, y // 4 AS b1, z // 4 AS b2 FROM fx_half WHERE part_id = 3), j AS (SELECT h.pair_id, t.pair_id AS hit FROM fx_half h LEFT JOIN t ON t.pair_id = h.pair_id AND b0 = x // 4 AND b1 = y // 4 AND b2 = z // 4) SELECT pair_id, count(*) AS n_tokens, count(hit) AS n_edit_tokens, count_if(hit IS NULL) AS n_kept FROM j GROUP BY pair_id"))
def vox8(s, d):
    h = _half(s, d)
    return grid.part_keep(h, _edit(h), 4)


@query("vox9_bridge_rows", _hf("WITH b AS (SELECT *, row_number() OVER (PARTITION BY pair_id ORDER BY x, y, z) - 1 AS before_row FROM fx_half WHERE in_before = 1) SELECT pair_id, x, y, z, CAST(before_row AS INT) AS before_row FROM b WHERE in_after = 1 AND part_id <> 3"))
def vox9(s, d):
    h = _half(s, d)
    return grid.bridged(h.where("in_before = 1"), h.where("in_after = 1"), _edit(h))


@query("vox10_n_restored", _vox(_REGION + f"SELECT pair_id, count(*) AS n_restored FROM fx_voxels v WHERE in_before = 1 AND in_after = 0 AND NOT EXISTS (SELECT 1 FROM region r WHERE {_AT('r', 'v')}) GROUP BY pair_id"))
def vox10(s, d):
    v = stored(fixture(s, d, "fx_voxels"))
    return grid.restored(v, _region(v))


def _grown(table_: str, where: str) -> str:
    return f"SELECT DISTINCT pair_id, x + i AS x, y + j AS y, z + k AS z FROM {table_}, range(-1, 2) p(i), range(-1, 2) q(j), range(-1, 2) r(k) WHERE {where} AND least(x + i, y + j, z + k) >= 0 AND greatest(x + i, y + j, z + k) < 16"


@query("vox11_densified", _hf(f"(({_grown('fx_half', 'in_after = 1')}) INTERSECT ({_grown('fx_half', 'part_id = 3')})) UNION SELECT pair_id, x, y, z FROM fx_half WHERE in_after = 1"))
def vox11(s, d):
    h = _half(s, d)
    return grid.densified(h.where("in_after = 1"), _edit(h), 1, 16).select(*[F.col(c) if c == "pair_id" else F.col(c).cast("long").alias(c) for c in grid.CELL])


@query("vox18_split_counts", _hf("SELECT pair_id, count_if(part_id = 3) AS n_edit, count_if(part_id <> 3) AS n_keep, 32 AS grid FROM fx_half WHERE in_after = 1 GROUP BY pair_id"))
def vox18(s, d):
    h = _half(s, d)
    return grid.split_counts(h.where("in_after = 1"), _edit(h))


@query("vox19_added_cells", _hf("SELECT pair_id, x, y, z FROM fx_half WHERE in_after = 1 AND in_before = 0"))
def vox19(s, d):
    h = _half(s, d)
    return grid.added_cells(h.where("in_before = 1"), h.where("in_after = 1"))


@query("vox20_aligned_labels", _hf(f"""WITH k AS (SELECT *, CASE WHEN part_id = 3 THEN true WHEN part_id < 3 THEN false END AS edit FROM fx_half), near AS (SELECT a.pair_id, a.x, a.y, a.z, min({{'d': {_D2}, 'x': b.x, 'y': b.y, 'z': b.z, 'e': b.edit}}) AS m FROM k a JOIN k b ON a.pair_id = b.pair_id WHERE a.edit IS NULL AND b.edit IS NOT NULL GROUP BY ALL)
 SELECT pair_id, x, y, z, edit FROM k WHERE edit IS NOT NULL UNION ALL SELECT pair_id, x, y, z, m.e FROM near"""))
def vox20(s, d):
    h = _half(s, d)
    return neighbours.aligned_labels(h.select(*grid.CELL, F.when(F.col("part_id") == 3, True).when(F.col("part_id") < 3, False).alias("edit")))


@query("vox21_mask_warnings", _hf("WITH n AS (SELECT pair_id, count_if(part_id = pair_id % 60) AS n_edit, count_if(part_id <> pair_id % 60) AS n_keep FROM fx_half WHERE in_after = 1 GROUP BY pair_id) SELECT *, CASE WHEN n_edit = 0 THEN 'no overlap' WHEN n_edit < 10 THEN 'few cells' WHEN n_edit / (n_edit + n_keep) > 0.95 THEN 'nearly everything' END AS warning FROM n"))
def vox21(s, d):
    h = _half(s, d).where("in_after = 1")
    counts = grid.split_counts(h, h.where("part_id = pair_id % 60")).drop("grid").withColumn("whole", F.lit(False))
    return grid.mask_warnings(counts).drop("whole")


@query("vox22_normalised", _hf("WITH t AS (SELECT avg(f0) AS m, stddev_pop(f0) AS s FROM fx_half) SELECT pair_id, x, y, z, round((f0 - m) / s, 6) AS f0 FROM fx_half, t"))
def vox22(s, d):
    return grid.normalised(fixture(s, d, "fx_half").select(*grid.CELL, "f0"), ["f0"]).withColumn("f0", F.round("f0", 6))


#: Pairs are mirrored two by two; some samples lack a cell of their texture, have one off the grid, or one too many.
_SAMPLE = """SELECT pair_id * 2 + m.range AS pair_id, k.kind, x + CASE WHEN pair_id % 11 = 5 AND x = 15 THEN 20 ELSE 0 END AS x, y, z FROM fx_half, range(2) m, (VALUES ('before_shape', 0), ('before_texture', 0), ('after_shape', 1), ('after_texture', 1), ('coords0', 0), ('coords_new', 1)) k(kind, side)
 WHERE (CASE WHEN (k.side + m.range) % 2 = 0 THEN in_before ELSE in_after END) = 1 AND NOT (kind = 'after_texture' AND pair_id % 5 = 1 AND x = 3) AND NOT (kind = 'coords0' AND pair_id % 7 = 2 AND y = 4) AND NOT (kind = 'after_shape' AND pair_id % 13 = 3 AND m.range = 0 AND z = 2)"""
_SETS = ", ".join(f"coalesce(list(DISTINCT (x, y, z) ORDER BY (x, y, z)) FILTER (kind = '{k}'), []) AS {k}" for k in grid.SAMPLE)


@query("vox23_sample_invariants", _hf(f"""WITH c AS ({_SAMPLE}), s AS (SELECT pair_id, {_SETS}, max(greatest(x, y, z)) < 32 AS in_grid FROM c GROUP BY pair_id)
 SELECT s.pair_id, s.before_shape = s.before_texture AND s.after_shape = s.after_texture AS same_coords, s.before_shape = s.coords0 AS before_stored, s.after_shape = s.coords_new AS after_stored, s.pair_id % 9 <> 4 AS before_mask, true AS after_mask, s.in_grid,
 coalesce(s.before_shape = t.after_shape AND s.after_shape = t.before_shape, s.pair_id % 8 > 5) AS mirrored FROM s LEFT JOIN s t ON s.pair_id % 8 < 6 AND t.pair_id = xor(s.pair_id, 1)"""))
def vox23(s, d):
    h = _half(s, d)
    kinds = F.array(*[F.struct(F.lit(k).alias("kind"), F.lit(1 if k in ("after_shape", "after_texture", "coords_new") else 0).alias("side")) for k in grid.SAMPLE])
    c = h.withColumn("m", F.explode(F.array(F.lit(0), F.lit(1)))).withColumn("k", F.explode(kinds)).select("*", "k.kind", "k.side")
    c = c.where("(case when (side + m) % 2 = 0 then in_before else in_after end) = 1 and not (kind = 'after_texture' and pair_id % 5 = 1 and x = 3) and not (kind = 'coords0' and pair_id % 7 = 2 and y = 4) and not (kind = 'after_shape' and pair_id % 13 = 3 and m = 0 and z = 2)")
    c = stored(c.selectExpr("pair_id * 2 + m as pair_id", "kind", "x + case when pair_id % 11 = 5 and x = 15 then 20 else 0 end as x", "y", "z"))
    shape = c.where("kind in ('before_shape', 'after_shape')").groupBy("pair_id", (F.col("kind") == "after_shape").cast("int").alias("side")).agg(F.count(F.lit(1)).alias("n"))
    masks = shape.withColumn("n", F.when((F.col("pair_id") % 9 == 4) & (F.col("side") == 0), F.col("n") + 1).otherwise(F.col("n")))
    mirrors = c.select("pair_id").distinct().where("pair_id % 8 < 6").select("pair_id", F.col("pair_id").bitwiseXOR(F.lit(1)).alias("mirror"))
    return grid.sample_invariants(c, masks, mirrors)


@query("vox24_transition", _hf(f"""WITH g0 AS (SELECT pair_id, x, y, z FROM fx_half WHERE part_id = 3), g1 AS (SELECT * FROM g0 UNION SELECT pair_id, x + p, y + q, z + r FROM g0 CROSS JOIN {_SIX}), g2 AS (SELECT * FROM g1 UNION SELECT pair_id, x + p, y + q, z + r FROM g1 CROSS JOIN {_SIX})
 SELECT * FROM g0 UNION SELECT h.pair_id, h.x, h.y, h.z FROM fx_half h JOIN g2 g ON {_AT("g", "h")} WHERE in_before = 1 AND (part_id IN (4, 6) OR part_id < 6)"""))
def vox24(s, d):
    """Part 6 is preserved, so naming it in exclude doesn't take it away; part 7 is occupied only."""
    h = _half(s, d)
    return grid.transition(_edit(h), h.where("in_before = 1 AND part_id IN (4, 6)"), h.where("in_before = 1"), 2, 16, h.where("part_id >= 6 OR part_id = 3"))


_COARSE = "c AS (SELECT pair_id, x // 2 AS x, y // 2 AS y, z // 2 AS z, min(part_id) AS part_id FROM fx_half GROUP BY ALL)"


@query("vox25_voted_region", _hf(f"""WITH {_COARSE}, occ AS (SELECT * FROM c WHERE part_id < 5), ed AS (SELECT * FROM occ WHERE part_id < 2), pre AS (SELECT * FROM occ WHERE part_id >= 3), box AS (SELECT pair_id, min(x) AS lx, max(x) AS hx, min(y) AS ly, max(y) AS hy, min(z) AS lz, max(z) AS hz FROM occ GROUP BY pair_id),
 a AS (SELECT pair_id, i.range AS x, j.range AS y, k.range AS z FROM box, range(8) i, range(8) j, range(8) k WHERE i.range BETWEEN lx - 1 AND hx + 1 AND j.range BETWEEN ly - 1 AND hy + 1 AND k.range BETWEEN lz - 1 AND hz + 1),
 free AS (SELECT a.* FROM a WHERE NOT EXISTS (SELECT 1 FROM ed e WHERE {_AT("e", "a")}) AND NOT EXISTS (SELECT 1 FROM pre e WHERE {_AT("e", "a")})),
 n AS (SELECT a.pair_id, a.x, a.y, a.z, (b.part_id < 2)::INT AS e, row_number() OVER (PARTITION BY a.pair_id, a.x, a.y, a.z ORDER BY {_D2}, b.x, b.y, b.z) AS rank FROM free a JOIN occ b ON a.pair_id = b.pair_id), v AS (SELECT pair_id, x, y, z FROM n WHERE rank <= 7 GROUP BY ALL HAVING avg(e) > 0.5)
 SELECT pair_id, x::INT AS x, y::INT AS y, z::INT AS z FROM (SELECT * FROM v UNION SELECT pair_id, x, y, z FROM ed)"""))
def vox25(s, d):
    h = _half(s, d)
    c = stored(h.groupBy("pair_id", *[F.floor(F.col(a) / 2).cast("int").alias(a) for a in "xyz"]).agg(F.min("part_id").alias("part_id")).where("part_id < 5"))
    return neighbours.voted_region(c, c.where("part_id < 2"), c.where("part_id >= 3"), 1, 7, 8)


_EMPTY = f"""c AS (SELECT DISTINCT pair_id, x // 2 AS x, y // 2 AS y, z // 2 AS z FROM fx_half), dense AS (SELECT pair_id, i.range AS x, j.range AS y, k.range AS z FROM (SELECT DISTINCT pair_id FROM c), range(8) i, range(8) j, range(8) k),
 free AS (SELECT * FROM dense g WHERE NOT EXISTS (SELECT 1 FROM c WHERE {_AT("c", "g")})), reach AS (SELECT pair_id, x, y, z FROM free WHERE least(x, y, z) = 0 OR greatest(x, y, z) = 7
 UNION SELECT f.pair_id, f.x, f.y, f.z FROM reach g CROSS JOIN {_SIX} JOIN free f ON f.pair_id = g.pair_id AND f.x = g.x + p AND f.y = g.y + q AND f.z = g.z + r)"""


@query("vox26_solid_fill", _hf(f"WITH RECURSIVE {_EMPTY}, n AS (SELECT pair_id, (SELECT count(*) FROM c q WHERE q.pair_id = d.pair_id) AS n_shell, (SELECT count(*) FROM free q WHERE q.pair_id = d.pair_id) - (SELECT count(*) FROM reach q WHERE q.pair_id = d.pair_id) AS n_in FROM (SELECT DISTINCT pair_id FROM c) d) SELECT pair_id, n_shell + n_in AS n, n_shell, n_in > n_shell * 0.15 AS watertight FROM n"))
def vox26(s, d):
    return grid.solid_fill(grid.downsample(_half(s, d), 2), 8)[1]


@query("vox27_mask_summary", _hf("SELECT pair_id, count_if(part_id = 3) AS n_edit_voxels, round(count_if(in_before = 1 AND part_id <> 3) / greatest(count_if(in_before = 1), 1), 6) AS keep_ratio, count_if(in_after = 1) > 0 AS has_slat FROM fx_half GROUP BY pair_id"))
def vox27(s, d):
    b = F.col("in_before") == 1
    ratio = F.count_if(b & (F.col("part_id") != 3)) / F.greatest(F.count_if(b), F.lit(1))
    return fixture(s, d, "fx_half").groupBy("pair_id").agg(F.count_if(F.col("part_id") == 3).alias("n_edit_voxels"), F.round(ratio, 6).alias("keep_ratio"), (F.count_if(F.col("in_after") == 1) > 0).alias("has_slat"))


@query("vox28_rerun_iou", with_fixtures("""WITH a AS (SELECT DISTINCT pair_id, x // 2 AS x, y // 2 AS y, z // 2 AS z FROM fx_voxels WHERE in_after = 1), b AS (SELECT pair_id, x, y, z FROM fx_half WHERE in_before = 1)
 SELECT pair_id, round(count_if(p IS NOT NULL AND q IS NOT NULL) / count(*), 6) AS coords_iou FROM (SELECT pair_id, x, y, z, a.pair_id AS p, b.pair_id AS q FROM a FULL JOIN b USING (pair_id, x, y, z)) GROUP BY pair_id""", "fx_voxels", "fx_half"))
def vox28(s, d):
    return grid.rerun_iou(fixture(s, d, "fx_voxels").where("in_after = 1"), fixture(s, d, "fx_half").where("in_before = 1")).withColumn("coords_iou", F.round("coords_iou", 6))


@query("udf3_box_mask", with_fixtures("SELECT obj_id || '/' || edit_idx AS edit_id, (pid1 + pid2) % 16 + i.range AS x, (pid1 + pid2) % 16 + i.range AS y, (pid1 + pid2) % 16 + i.range AS z FROM fx_edits, range(2) i", "fx_edits"))
def udf3(s, d):
    e = fixture(s, d, "fx_edits").select(F.concat_ws("/", "obj_id", "edit_idx").alias("edit_id"), F.array("pid1", "pid2").alias("pids"))
    return grid.box_mask(e)


@query("gra2_large_components", _hf(f"""WITH RECURSIVE k AS (SELECT pair_id, x * 256 + y * 16 + z AS id, x, y, z FROM fx_half WHERE part_id < 2), e AS (SELECT a.pair_id, a.id AS i, b.id AS j FROM k a CROSS JOIN (SELECT * FROM {_SIX} UNION ALL SELECT 0, 0, 0) JOIN k b ON a.pair_id = b.pair_id AND b.x = a.x + p AND b.y = a.y + q AND b.z = a.z + r),
 t AS (SELECT pair_id, i, j FROM e UNION SELECT t.pair_id, t.i, e.j FROM t JOIN e ON t.pair_id = e.pair_id AND t.j = e.i), l AS (SELECT pair_id, i, min(j) AS c FROM t GROUP BY pair_id, i), n AS (SELECT *, count(*) OVER (PARTITION BY pair_id, c) AS n FROM l) SELECT k.pair_id, k.x, k.y, k.z FROM k JOIN n ON n.pair_id = k.pair_id AND n.i = k.id WHERE n >= 4"""))
def gra2(s, d):
    return grid.large_components(_half(s, d).where("part_id < 2").select(*grid.CELL), 16, 4)


_PX = "px AS (SELECT vec_id, CAST(i - 1 AS INT) AS pos, CAST((i - 1) % 8 AS INT) AS x, CAST((i - 1) // 8 AS INT) AS y, embedding[i]::DOUBLE AS v FROM embeddings, range(1, 65) r(i))"


def _pixels(s, d) -> DataFrame:
    p = table(s, d, "embeddings").select("vec_id", F.posexplode("embedding").alias("pos", "v"))
    return p.select("vec_id", "pos", (F.col("pos") % 8).cast("int").alias("x"), F.floor(F.col("pos") / 8).cast("int").alias("y"), F.col("v").cast("double").alias("v"))


_EIGHT = "(SELECT a.range AS p, b.range AS q FROM range(-1, 2) a, range(-1, 2) b)"


@query("gra3_enclosed_holes", f"""WITH RECURSIVE {_PX}, w AS (SELECT vec_id, x, y FROM px WHERE v < 0), ext AS (SELECT vec_id, x, y FROM w WHERE least(x, y) = 0 OR greatest(x, y) = 7 UNION SELECT w.vec_id, w.x, w.y FROM ext g CROSS JOIN (VALUES (1, 0), (-1, 0), (0, 1), (0, -1)) o(p, q) JOIN w ON w.vec_id = g.vec_id AND w.x = g.x + p AND w.y = g.y + q),
 enc AS (SELECT * FROM w EXCEPT SELECT * FROM ext), t AS (SELECT vec_id, x * 8 + y AS i, x, y FROM enc UNION SELECT t.vec_id, t.i, e.x, e.y FROM t CROSS JOIN {_EIGHT} JOIN enc e ON e.vec_id = t.vec_id AND e.x = t.x + p AND e.y = t.y + q), l AS (SELECT vec_id, i, min(x * 8 + y) AS c FROM t GROUP BY vec_id, i), n AS (SELECT vec_id, c, count(*) AS n FROM l GROUP BY ALL HAVING count(*) >= 2)
 SELECT vec_id AS pair_id, count(*) AS n_holes, max(n) AS largest, CAST(sum(n) AS BIGINT) AS total, max(n) >= 4 AS hole FROM n GROUP BY vec_id""")
def gra3(s, d):
    white = stored(_pixels(s, d).where("v < 0").select(F.col("vec_id").alias("pair_id"), "x", "y"))
    return grid.holes(white, 8, 2, 4)


@query("los1_sparse_preserve", with_fixtures("""SELECT b.pair_id, round(avg((abs(a.f0 - b.f0) + abs(a.f1 - b.f1) + abs(a.f2 - b.f2) + abs(a.f3 - b.f3)) / 4), 6) AS loss FROM fx_sides b JOIN fx_sides a ON a.pair_id = b.pair_id AND a.x = b.x AND a.y = b.y AND a.z = b.z WHERE b.side = 0 AND a.side = 1 AND b.part_id <> 3 GROUP BY b.pair_id""", "fx_sides"))
def los1(s, d):
    sides = stored(fixture(s, d, "fx_sides"))
    return pixels.sparse_loss(sides.where("side = 0"), sides.where("side = 1"), sides.where("part_id = 3"), ["f0", "f1", "f2", "f3"]).withColumn("loss", F.round("loss", 6))


_TWO = "two AS (SELECT b.vec_id AS pair_id, b.pos, b.v AS b, a.v AS a FROM px b JOIN px a ON a.vec_id = b.vec_id + 1 AND a.pos = b.pos WHERE b.vec_id % 2 = 0)"


def _two(s, d) -> DataFrame:
    p = _pixels(s, d)
    pair = F.when(F.col("vec_id") % 2 == 0, F.col("vec_id")).otherwise(F.col("vec_id") - 1)
    side = lambda i: F.max(F.when(F.col("vec_id") % 2 == i, F.col("v")))
    return p.groupBy(pair.alias("pair_id"), "pos").agg(side(0).alias("b"), side(1).alias("a")).where("a IS NOT NULL AND b IS NOT NULL")


@query("los2_dense_preserve", f"WITH {_PX}, {_TWO}, c AS (SELECT pair_id, pos % 16 AS cell, avg((a - b) * (a - b)) AS d FROM two GROUP BY ALL) SELECT pair_id, round(avg(d) FILTER (cell % 3 <> 0), 6) AS loss FROM c GROUP BY pair_id")
def los2(s, d):
    rows = _two(s, d).withColumn("cell", F.col("pos") % 16)
    keep = s.range(16).where("id % 3 <> 0").select(F.col("id").cast("int").alias("cell"))
    return pixels.dense_loss(rows, keep).withColumn("loss", F.round("loss", 6))


@query("los3_grid_loss", f"WITH {_PX}, {_TWO} SELECT pair_id, round(coalesce(avg((a - b) * (a - b)) FILTER (pos % 5 <> 0), 0), 6) AS loss FROM two GROUP BY pair_id")
def los3(s, d):
    keep = s.range(64).where("id % 5 <> 0").select(F.col("id").cast("int").alias("cell"))
    return pixels.dense_loss(_two(s, d).withColumn("cell", F.col("pos")), keep).withColumn("loss", F.round("loss", 6))


@query("img2_ssim_by_channel", f"""WITH {_PX}, {_TWO}, c AS (SELECT pair_id, pos // 16 AS ch, (2 * avg(b) * avg(a) + 1e-4::DOUBLE) * (2 * covar_pop(b, a) + 9e-4::DOUBLE) / ((avg(b) * avg(b) + avg(a) * avg(a) + 1e-4::DOUBLE) * (var_pop(b) + var_pop(a) + 9e-4::DOUBLE)) AS s FROM two GROUP BY ALL)
 SELECT pair_id, round(greatest(-1, least(1, avg(s))), 6) AS ssim FROM c GROUP BY pair_id""")
def img2(s, d):
    return pixels.ssim_by_channel(_two(s, d).withColumn("channel", F.floor(F.col("pos") / 16))).withColumn("ssim", F.round("ssim", 6))


@query("img3_benchmark_run", f"""WITH {_PX}, {_TWO}, m AS (SELECT pair_id, CASE WHEN avg((a - b) * (a - b)) <= 1e-12 THEN 100 ELSE 20 * log10(1 / sqrt(avg((a - b) * (a - b)))) END AS psnr FROM two GROUP BY pair_id), c AS (SELECT e.label AS case_id, psnr FROM m JOIN embeddings e ON e.vec_id = pair_id)
 SELECT case_id, count(*) AS n, round(avg(psnr), 6) AS mean, round(stddev_pop(psnr), 6) AS std FROM c GROUP BY GROUPING SETS ((), (case_id))""")
def img3(s, d):
    e = metrics.vector_pairs(table(s, d, "embeddings")).join(table(s, d, "embeddings").select(F.col("vec_id").alias("pair_id"), F.col("label").alias("case_id")), "pair_id")
    split = e.select("case_id", F.col("pair_id").alias("view"), F.lit("v1").alias("protocol_version"))
    return pixels.benchmark_run(split, e.select("case_id", F.col("pair_id").alias("view"), metrics.psnr(F.col("before"), F.col("after")).alias("value")), "v1")


@query("img4_benchmark_run_3d", f"""WITH {_POINTS}, w AS (SELECT label, half, avg(m.d) AS d FROM near GROUP BY ALL), c AS (SELECT a.label % 3 AS case_id, (a.d + b.d) / 2 * 1000 AS v FROM w a JOIN w b USING (label) WHERE a.half = 0 AND b.half = 1)
 SELECT case_id, count(*) AS n, round(avg(v), 4) AS mean, round(stddev_pop(v), 4) AS std FROM c GROUP BY GROUPING SETS ((), (case_id))""")
def img4(s, d):
    m = neighbours.surface_distances(*_halves(s, d), "label", 0.1, 0.1).select((F.col("label") % 3).alias("case_id"), F.col("label").alias("view"), F.col("chamfer").alias("value"))
    split = m.select("case_id", "view", F.lit("v1").alias("protocol_version"))
    return pixels.benchmark_run(split, m, "v1", 4)


@query("agg15_cluster_sizes", "SELECT vec_id % 7 AS obj, label, count(*) AS n FROM embeddings GROUP BY ALL")
def agg15(s, d):
    return pixels.cluster_sizes(table(s, d, "embeddings").select((F.col("vec_id") % 7).alias("obj"), "label"), "obj", "label")


@query("agg16_mask_pixels", f"WITH {_PX} SELECT vec_id, CAST(floor(v * 10) AS BIGINT) AS part, count(*) AS n FROM px WHERE v >= 0 GROUP BY ALL")
def agg16(s, d):
    p = _pixels(s, d).select("vec_id", F.floor(F.col("v") * 10).alias("part"))
    return pixels.cluster_sizes(p.where("part >= 0"), "vec_id", "part")


_RGB = "rgb AS (SELECT vec_id, pos, CAST(floor(abs(v) * 997) % 256 AS INT) AS r, CAST(floor(abs(v) * 613) % 256 AS INT) AS g, CAST(floor(abs(v) * 389) % 256 AS INT) AS b FROM px)"


@query("agg17_palette_pixels", f"""WITH {_PX}, {_RGB}, pal(i, pr, pg, pb) AS (VALUES (0, 60, 40, 30), (1, 200, 120, 80), (2, 128, 200, 220)), sel AS (SELECT DISTINCT vec_id, p FROM (SELECT vec_id, unnest([vec_id % 5, vec_id % 7]) AS p FROM embeddings)),
 n AS (SELECT vec_id, count_if(sqrt(pow(r - pr, 2) + pow(g - pg, 2) + pow(b - pb, 2)) < 60) AS n FROM rgb JOIN sel USING (vec_id) JOIN pal ON i = p % 3 GROUP BY vec_id) SELECT vec_id, CASE WHEN vec_id % 6 = 5 THEN -1 ELSE n END AS n FROM n""")
def agg17(s, d):
    value = lambda k: (F.floor(F.abs("v") * k) % 256).cast("int")
    px = _pixels(s, d).select("vec_id", value(997).alias("r"), value(613).alias("g"), value(389).alias("b"))
    chosen = table(s, d, "embeddings").select("vec_id", F.array_distinct(F.array(F.col("vec_id") % 5, F.col("vec_id") % 7)).alias("pids"), (F.col("vec_id") % 6).alias("view"))
    return pixels.palette_pixels(px, chosen, "vec_id", ((60, 40, 30), (200, 120, 80), (128, 200, 220)))


_MASKS = "m AS (SELECT l_orderkey % 300 AS obj, l_linenumber % 5 AS view, l_suppkey % 4 AS part, CAST(sum(CASE WHEN l_quantity > 40 THEN l_quantity ELSE 0 END) AS INT) AS px FROM lineitem GROUP BY ALL)"


def _masks(s, d) -> DataFrame:
    return table(s, d, "lineitem").groupBy((F.col("l_orderkey") % 300).alias("obj"), (F.col("l_linenumber") % 5).alias("view"), (F.col("l_suppkey") % 4).alias("part")).agg(F.sum(F.when(F.col("l_quantity") > 40, F.col("l_quantity")).otherwise(0)).cast("int").alias("px"))


@query("win3_view_of_parts", f"""WITH {_MASKS}, v AS (SELECT obj, view, sum(px) FILTER (part < 2) AS px FROM m GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY obj ORDER BY coalesce(px, 0) DESC, view) AS k FROM v), o AS (SELECT DISTINCT l_orderkey % 300 AS obj FROM lineitem UNION SELECT 1000 + i.range FROM range(3) i)
 SELECT o.obj, CAST(coalesce(view, 2) AS INT) AS view FROM o LEFT JOIN r ON r.obj = o.obj AND k = 1""")
def win3(s, d):
    m = _masks(s, d)
    objects = m.select("obj").distinct().union(s.range(1000, 1003).toDF("obj"))
    return choice.view_of_parts(objects, m, "obj", (0, 1), (2, 0, 1))


@query("win4_gate_columns", f"""WITH {_MASKS}, v AS (SELECT obj, view, sum(px) AS px FROM m GROUP BY ALL), b AS (SELECT obj, arg_max(view, px * 10 - view) AS bv, max(px) AS most FROM v GROUP BY obj)
 SELECT obj, CAST(bv AS INT) AS best, CASE WHEN most = 0 THEN 'zero_visible_pixels' END AS error, CAST(CASE obj % 7 WHEN 0 THEN bv WHEN 1 THEN 0 WHEN 2 THEN 1 WHEN 3 THEN 2 WHEN 4 THEN 3 ELSE 0 END AS INT) AS view FROM b""")
def win4(s, d):
    px = _masks(s, d).groupBy("obj", "view").agg(F.sum("px").alias("px"))
    return choice.gate_columns(px, "obj", (F.col("obj") % 7).cast("int"))
