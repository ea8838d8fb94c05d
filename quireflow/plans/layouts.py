"""Geometry queries: boxes, regions of a page, reading order, lines, contours and control points."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructType

from ..functions import geometry as G
from ..functions import text as T
from ..operators.pages import many_pages, many_rows, per_page
from .registry import query

WIDTH, HEIGHT = 800, 1000
_BOX = ["x1", "y1", "x2", "y2"]


def _rows(**kinds) -> StructType:
    out = StructType()
    for name, kind in kinds.items():
        out = out.add(name, kind)
    return out


@query("g01_g05_pixel_boxes", """SELECT page_id, idx, x1, y1, x2, y2 FROM (SELECT page_id, idx, cls, w, CAST(greatest(floor((x / 800.0 - w / 1600.0) * 800) - 2, 0) AS INTEGER) AS x1, CAST(greatest(floor((y / 1000.0 - h / 2000.0) * 1000) - 2, 0) AS INTEGER) AS y1,
    CAST(least(ceil((x / 800.0 + w / 1600.0) * 800) + 2, 800) AS INTEGER) AS x2, CAST(least(ceil((y / 1000.0 + h / 2000.0) * 1000) + 2, 1000) AS INTEGER) AS y2 FROM (SELECT page_id, idx, cls, CAST(x AS DOUBLE) AS x, CAST(y AS DOUBLE) AS y, CAST(w AS DOUBLE) AS w, CAST(h AS DOUBLE) AS h FROM boxes)) WHERE cls = 1 AND x2 > x1 AND y2 > y1""")
def pixel_boxes(e) -> DataFrame:
    d = lambda c, n: F.col(c).cast("double") / n
    b = G.pixel_box(d("x", 800.0), d("y", 1000.0), d("w", 800.0), d("h", 1000.0), F.lit(800), F.lit(1000), 2)
    return e.boxes.where("cls = 1").select("page_id", "idx", b.alias("b")).where("b is not null").select("page_id", "idx", "b.*")


@query("g02_j16_overlapping_pairs", """SELECT a.page_id, a.idx AS i, b.idx AS j, round(CASE WHEN least(a.h, b.h) > 0 THEN greatest(0, least(a.y + a.h, b.y + b.h) - greatest(a.y, b.y)) / least(a.h, b.h) ELSE 0 END, 5) AS vertical FROM boxes a JOIN boxes b ON a.page_id = b.page_id AND a.idx < b.idx AND least(a.x + a.w, b.x + b.w) > greatest(a.x, b.x)""")
def overlapping(e) -> DataFrame:
    a, b = e.boxes.alias("a"), e.boxes.alias("b")
    on = (F.col("a.page_id") == F.col("b.page_id")) & (F.col("a.idx") < F.col("b.idx")) & (F.least(F.expr("a.x + a.w"), F.expr("b.x + b.w")) > F.greatest("a.x", "b.x"))
    return a.join(b, on).select("a.page_id", F.col("a.idx").alias("i"), F.col("b.idx").alias("j"), F.round(G.overlap_share(F.col("a.y"), F.expr("a.y + a.h"), F.col("b.y"), F.expr("b.y + b.h")).cast("double"), 5).alias("vertical"))


_AREA = "greatest(0, {0}.x2 - {0}.x1) * greatest(0, {0}.y2 - {0}.y1)"
_WITHIN = f"""((a.x1 >= b.x1 - 1 AND a.y1 >= b.y1 - 1 AND a.x2 <= b.x2 + 1 AND a.y2 <= b.y2 + 1) OR ({_AREA.format('a')} > 0
    AND greatest(0, least(a.x2, b.x2) - greatest(a.x1, b.x1)) * greatest(0, least(a.y2, b.y2) - greatest(a.y1, b.y1)) >= 0.95 * {_AREA.format('a')}))
    AND ({_AREA.format('b')} > {_AREA.format('a')} OR ({_AREA.format('b')} = {_AREA.format('a')} AND b.idx < a.idx))"""


@query("g03_g04_drop_contained", f"SELECT page_id, idx FROM regions a WHERE NOT EXISTS (SELECT 1 FROM regions b WHERE b.page_id = a.page_id AND b.label = a.label AND b.idx <> a.idx AND {_WITHIN})")
def drop_contained(e) -> DataFrame:
    """Boxes that lie in no greater one of their own label: but for a pixel at each side, or by 95 % of their area."""
    a, b = e.regions.alias("a"), e.regions.alias("b")
    area = lambda s: F.expr(_AREA.format(s))
    greater = (area("b") > area("a")) | ((area("b") == area("a")) & (F.col("b.idx") < F.col("a.idx")))
    sides = [F.col(f"{s}.{c}") for s in "ab" for c in _BOX]
    same = (F.col("a.page_id") == F.col("b.page_id")) & (F.col("a.label") == F.col("b.label")) & (F.col("a.idx") != F.col("b.idx"))
    return a.join(b, same & greater & (G.inside(*sides) | (G.covered_share(*sides) >= 0.95)), "left_anti").select("page_id", "idx")


_LINK = "a.page_id = b.page_id AND a.idx <> b.idx AND greatest(0, least(a.y + a.h, b.y + b.h) - greatest(a.y, b.y)) >= 0.6 * least(a.h, b.h) AND greatest(0, least(a.x + a.w, b.x + b.w) - greatest(a.x, b.x)) < 0.05 * least(a.w, b.w)"


@query("g06_column_sets", f"""WITH RECURSIVE link AS (SELECT a.page_id, a.idx AS i, b.idx AS j FROM boxes a JOIN boxes b ON {_LINK}), reach AS (SELECT page_id, i, i AS r FROM link UNION SELECT reach.page_id, link.j, reach.r FROM reach JOIN link ON link.page_id = reach.page_id AND link.i = reach.i),
    lab AS (SELECT page_id, i, min(r) AS root FROM reach GROUP BY page_id, i), size AS (SELECT page_id, root, count(*) AS n, sum(w * h) AS area FROM lab JOIN boxes USING (page_id) WHERE boxes.idx = lab.i GROUP BY page_id, root)
    SELECT page_id, arg_max(n, area * 1000 - root) AS n, CAST(max(area) AS BIGINT) AS area FROM size GROUP BY page_id""")
def column_sets(e) -> DataFrame:
    def best(page, rows):
        boxes = [(x, y, x + w, y + h) for _, x, y, w, h in rows]
        own = G.columns_of(boxes)
        return [(page, len(own), sum((boxes[k][2] - boxes[k][0]) * (boxes[k][3] - boxes[k][1]) for k in own))] if own else []

    return per_page(e.boxes, "page_id", ["idx", "x", "y", "w", "h"], best, _rows(page_id=LongType(), n=LongType(), area=LongType()))


@query("g07_projection_gaps", """WITH m AS (SELECT page_id, x, max(x + w) OVER (PARTITION BY page_id ORDER BY x, x + w, idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM boxes) SELECT page_id, reach AS gap_start, x AS gap_end FROM m WHERE x > reach""")
def projection_gaps(e) -> DataFrame:
    before = Window.partitionBy("page_id").orderBy("x", F.expr("x + w"), "idx").rowsBetween(Window.unboundedPreceding, -1)
    return e.boxes.withColumn("reach", F.max(F.expr("x + w")).over(before)).where("x > reach").select("page_id", F.col("reach").alias("gap_start"), F.col("x").alias("gap_end"))


@query("g08_reading_order")
def reading_order(e) -> DataFrame:
    """The place of each region of a page, whatever its label, by the XY-cut."""

    def order(page, rows):
        return [(page, place, rows[k][0]) for place, k in enumerate(G.xy_cut([r[1:] for r in rows], WIDTH, HEIGHT))]

    return per_page(e.regions, "page_id", ["idx", *_BOX], order, _rows(page_id=LongType(), place=IntegerType(), idx=IntegerType()))


@query("g10_body_regions")
def body_regions(e) -> DataFrame:
    """The text areas of a page to read, in order."""

    def order(page, rows):
        return [(page, place, rows[k][0]) for place, k in enumerate(G.body_regions([r[1:] for r in rows], WIDTH, HEIGHT))]

    return per_page(e.regions.where("label = 'text-area'"), "page_id", ["idx", *_BOX], order, _rows(page_id=LongType(), place=IntegerType(), idx=IntegerType()))


@query("g10_footnote_order", f"SELECT page_id, idx, CAST(row_number() OVER (PARTITION BY page_id ORDER BY y1, x1, idx) - 1 AS INTEGER) AS place FROM regions a WHERE label = 'footnote' AND NOT EXISTS (SELECT 1 FROM regions b WHERE b.page_id = a.page_id AND b.label = 'footnote' AND b.idx <> a.idx AND {_WITHIN})")
def footnote_order(e) -> DataFrame:
    """Footnotes that aren't nested, from top to bottom and left to right."""

    def order(page, rows):
        boxes = [r[1:] for r in rows]
        kept = sorted(G.outermost(boxes), key=lambda k: (boxes[k][1], boxes[k][0]))
        return [(page, rows[k][0], place) for place, k in enumerate(kept)]

    return per_page(e.regions.where("label = 'footnote'"), "page_id", ["idx", *_BOX], order, _rows(page_id=LongType(), idx=IntegerType(), place=IntegerType()))


@query("g09_crop_margin", """SELECT page_id, idx, CAST(greatest(16, round_even(0.02 * 800, 0)) AS INTEGER) AS body, CAST(greatest(32, round_even(0.05 * 800, 0), round_even(0.5 * greatest(1, y2 - y1), 0)) AS INTEGER) AS note,
    CAST(max(greatest(32, round_even(0.05 * 800, 0), round_even(0.5 * greatest(1, y2 - y1), 0))) OVER (PARTITION BY page_id) AS INTEGER) AS most FROM regions""")
def crop_margin(e) -> DataFrame:
    w, h, own = F.lit(WIDTH), F.lit(HEIGHT), F.col("y2") - F.col("y1")
    note = G.crop_margin(w, h, own, 0.05, 32, 0.5)
    return e.regions.select("page_id", "idx", G.crop_margin(w, h, own, 0.02, 16).alias("body"), note.alias("note"), F.max(note).over(Window.partitionBy("page_id")).alias("most"))


@query("g11_line_threshold", "SELECT o.o_orderkey AS page_id, coalesce(0.5 * median(h), 20.0) AS threshold FROM orders o LEFT JOIN boxes b ON b.page_id = o.o_orderkey GROUP BY 1")
def line_threshold(e) -> DataFrame:
    return e.orders.select(F.col("o_orderkey").alias("page_id")).join(e.boxes.select("page_id", "h"), "page_id", "left").groupBy("page_id").agg(F.coalesce(0.5 * F.median("h"), F.lit(20.0)).alias("threshold"))


# Boxes with one middle are one: the last takes the place of those before it.
_LINES = """own AS (SELECT page_id, max(idx) AS idx, x + w / 2.0 AS cx, y + h / 2.0 AS cy FROM boxes GROUP BY page_id, x + w / 2.0, y + h / 2.0), lim AS (SELECT page_id, 0.5 * median(h) AS t FROM boxes GROUP BY page_id),
    s AS (SELECT page_id, idx, cy, cx, t, row_number() OVER (PARTITION BY page_id ORDER BY cy, cx, idx) AS k FROM own JOIN lim USING (page_id)),
    f AS (SELECT page_id, idx, cx, cy AS anchor, 0 AS line, k FROM s WHERE k = 1 UNION ALL SELECT s.page_id, s.idx, s.cx, CASE WHEN s.cy - f.anchor > s.t THEN s.cy ELSE f.anchor END, CASE WHEN s.cy - f.anchor > s.t THEN f.line + 1 ELSE f.line END, s.k
          FROM f JOIN s ON s.page_id = f.page_id AND s.k = f.k + 1)"""


def lines_of(e) -> DataFrame:
    """(page_id, line, bs): the boxes (cy, cx, idx, x, y, w, h) of each line of a page; boxes with one middle count once, with the last."""
    middle = lambda p, s: F.col(p) + F.col(s) / 2.0
    own = e.boxes.groupBy("page_id", middle("y", "h").alias("cy"), middle("x", "w").alias("cx")).agg(F.max(F.struct("idx", "x", "y", "w", "h")).alias("b"), F.collect_list("h").alias("hs"))
    g = own.groupBy("page_id").agg(F.array_sort(F.collect_list(F.struct("cy", "cx", "b.*"))).alias("bs"), F.array_sort(F.flatten(F.collect_list("hs"))).alias("hs"))
    lines = G.anchored_lines(F.col("bs.cy"), 0.5 * G.median_of(F.col("hs")))
    flat = g.select("page_id", F.explode(F.arrays_zip(F.col("bs").alias("b"), lines.alias("line"))).alias("z")).select("page_id", "z.line", "z.b")
    return flat


@query("g12_g13_anchored_lines", f"WITH RECURSIVE {_LINES} SELECT page_id, idx, line, CAST(row_number() OVER (PARTITION BY page_id, line ORDER BY cx, k) - 1 AS INTEGER) AS place FROM f")
def anchored(e) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("page_id", "line").orderBy("b.cx", "b.cy", "b.idx")) - 1
    return lines_of(e).select("page_id", "b.idx", "line", place.alias("place"))


@query("g14_merged_hulls", f"""WITH RECURSIVE {_LINES}, c AS (SELECT DISTINCT page_id, line, x + dx * w AS px, y + dy * h AS py FROM f JOIN boxes USING (page_id, idx), (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) v(dx, dy)),
    edge AS (SELECT p.page_id, p.line, p.px AS ax, p.py AS ay, q.px AS bx, q.py AS by_ FROM c p JOIN c q ON q.page_id = p.page_id AND q.line = p.line AND (q.px <> p.px OR q.py <> p.py)
      WHERE NOT EXISTS (SELECT 1 FROM c r WHERE r.page_id = p.page_id AND r.line = p.line AND ((q.px - p.px) * (r.py - p.py) - (q.py - p.py) * (r.px - p.px) < 0
        OR ((q.px - p.px) * (r.py - p.py) - (q.py - p.py) * (r.px - p.px) = 0 AND (r.px - p.px) * (r.px - q.px) + (r.py - p.py) * (r.py - q.py) > 0))))
    SELECT page_id, line, CAST(count(*) AS INTEGER) AS n, sum(ax * by_ - bx * ay) / 2.0 AS area FROM edge GROUP BY page_id, line""")
def hulls(e) -> DataFrame:
    """Corners and area of the convex hull around the boxes of each line."""

    def merge(keys, at, columns):
        idx, *box = (c.astype(np.int64) for c in columns)
        page, line, own = G.lines_of_boxes(at, idx, *box)
        page, line, corners, area = G.merged_hulls(page, line, *(c[own] for c in box))
        return keys.take(pa.array(page)), pa.array(line), pa.array(corners), pa.array(area)

    return many_pages(e.boxes, "page_id", ["idx", "x", "y", "w", "h"], merge, "page_id long, line int, n int, area double")


@query("g15_contour_bounds", "SELECT page_id, min(x) AS x, min(y) AS y, max(x) - min(x) + 1 AS w, max(y) - min(y) + 1 AS h FROM boxes GROUP BY page_id")
def contour_bounds(e) -> DataFrame:
    g = e.boxes.groupBy("page_id").agg(F.collect_list(F.struct("x", "y")).alias("c"))
    return g.select("page_id", G.bounds(F.col("c")).alias("b")).select("page_id", "b.*")


@query("g16_g17_g22_scaled_rotated", """WITH p AS (SELECT page_id, idx, k, x + dx * w AS x, y + dy * h AS y, CASE WHEN page_id % 3 = 0 THEN 0.0 ELSE (page_id % 9 - 4) / 2.0 END AS d FROM boxes, (VALUES (0, 0, 0), (1, 1, 0), (2, 1, 1), (3, 0, 1)) v(k, dx, dy))
    SELECT page_id, idx, k, CAST(round_even(x * 1.5, 0) AS INTEGER) AS sx, CAST(round_even(y * 1.25, 0) AS INTEGER) AS sy, CAST(CASE WHEN d = 0 THEN x ELSE round_even(round(cos(radians(d)) * (x - 400) + sin(radians(d)) * (y - 500) + 400, 7), 0) END AS INTEGER) AS rx,
    CAST(CASE WHEN d = 0 THEN y ELSE round_even(round(cos(radians(d)) * (y - 500) - sin(radians(d)) * (x - 400) + 500, 7), 0) END AS INTEGER) AS ry, CAST(greatest(-32768, least(32767, x * y)) AS SMALLINT) AS clamped FROM p""")
def scaled(e) -> DataFrame:
    """The corners of each box in a page half as wide again and a quarter higher, and turned by the angle of the page."""
    corner = lambda dx, dy: F.struct((F.col("x") + dx * F.col("w")).alias("x"), (F.col("y") + dy * F.col("h")).alias("y"))
    d = F.when(F.col("page_id") % 3 == 0, 0.0).otherwise((F.col("page_id") % 9 - 4) / 2.0)
    c = e.boxes.select("page_id", "idx", F.array(corner(0, 0), corner(1, 0), corner(1, 1), corner(0, 1)).alias("c"), d.alias("d"))
    made = c.select("page_id", "idx", F.posexplode(F.arrays_zip(G.scaled_points(F.col("c"), F.lit(1.5), F.lit(1.25)).alias("s"), G.rotated_points(F.col("c"), F.col("d"), F.lit(WIDTH), F.lit(HEIGHT)).alias("r"), F.col("c").alias("p"))).alias("k", "z"))
    return made.select("page_id", "idx", "k", F.col("z.s.x").alias("sx"), F.col("z.s.y").alias("sy"), F.col("z.r.x").alias("rx"), F.col("z.r.y").alias("ry"), G.clamp_short(F.col("z.p.x") * F.col("z.p.y")).alias("clamped"))


@query("g18_skew", "SELECT page_id, idx, CAST(CASE WHEN a >= 0 AND a <= 90 THEN CASE WHEN a > 45 THEN a - 90 ELSE a END WHEN a < -45 THEN a + 90 ELSE a END AS DOUBLE) AS skew FROM (SELECT page_id, idx, x % 181 - 90 AS a FROM boxes)")
def skewed(e) -> DataFrame:
    return e.boxes.select("page_id", "idx", G.skew((F.col("x") % 181 - 90).cast("double")).alias("skew"))


_TILT = "(x % 41 - 20) / 4.0"


@query(
    "a18_a19_page_rotation",
    f"""WITH a AS (SELECT page_id, {_TILT} AS ang, greatest(w * h, 1) AS area FROM boxes WHERE abs({_TILT}) >= 0.000001 AND abs({_TILT}) <= 5), m AS (SELECT page_id, median(ang) AS med FROM a GROUP BY 1), d AS (SELECT page_id, median(abs(ang - med)) AS mad FROM a JOIN m USING (page_id) GROUP BY 1),
    r AS (SELECT page_id, sum(ang * area) FILTER (mad = 0 OR abs(ang - med) <= 3 * mad) / sum(area) FILTER (mad = 0 OR abs(ang - med) <= 3 * mad) AS angle FROM a JOIN m USING (page_id) JOIN d USING (page_id) GROUP BY page_id)
    SELECT p.page_id, round(CASE WHEN abs(coalesce(angle, 0)) < 0.2 THEN 0 ELSE angle END, 4) AS angle FROM (SELECT DISTINCT page_id FROM boxes) p LEFT JOIN r USING (page_id)""",
)
def rotation(e) -> DataFrame:
    rect = F.struct(F.expr(_TILT).alias("angle"), F.col("w").cast("double").alias("w"), F.col("h").cast("double").alias("h"))
    return e.boxes.groupBy("page_id").agg(F.collect_list(rect).alias("rs")).select("page_id", F.round(G.page_rotation(F.col("rs")), 4).alias("angle"))


@query("a22_line_nearest_mean", """WITH d AS (SELECT page_id, idx, CASE WHEN h > 40 THEN CAST(h % 50 AS DOUBLE) ELSE 0.0 END AS yd FROM boxes), m AS (SELECT *, avg(yd) OVER w AS mean, max(yd) OVER w AS most FROM d WINDOW w AS (PARTITION BY page_id)),
    c AS (SELECT page_id, idx, abs(mean - yd) AS gap FROM m WHERE yd > 0 AND abs(mean - yd) < most), b AS (SELECT page_id, arg_min(idx, struct_pack(g := gap, i := idx)) AS idx FROM c GROUP BY page_id) SELECT DISTINCT d.page_id, coalesce(b.idx, -1) AS idx FROM d LEFT JOIN b USING (page_id)""")
def nearest_mean(e) -> DataFrame:
    yd = F.when(F.col("h") > 40, (F.col("h") % 50).cast("double")).otherwise(0.0)
    g = e.boxes.groupBy("page_id").agg(F.array_sort(F.collect_list(F.struct("idx", yd.alias("d")))).alias("ds"))
    return g.select("page_id", G.nearest_to_mean(F.col("ds.d")).alias("idx"))


def _contours(idx, x, y, w, h) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The corners (x, y) of a contour per box, and where each begins: level at first, then falling by a part of its height, so that some lines are bent."""
    idx, x, y, w, h = (c.astype(np.int64) for c in (idx, x, y, w, h))
    fall = np.minimum(h * (idx % 3), w)
    xs, ys = np.column_stack([x, x + w, x + w, x]), np.column_stack([y, y + fall, y + fall + h // 4, y + h // 4])
    return xs.ravel(), ys.ravel(), np.arange(0, 4 * len(x) + 1, 4)


# The slices of such a contour begin at these parts of its width w + 1 (both edges count); its middle falls with its left edge. A slice of 10 columns from a on holds the rows
# from fall * a / w to fall * (a + 9) / w + h / 4, rounded.
_FALL = "least(h * (idx % 3), w)"
_SLICES = f"""q AS (SELECT page_id, idx, x, y, w, h, {_FALL} AS fall, n, CASE n WHEN 0 THEN 0 WHEN 1 THEN (w + 1) // 4 - 10 WHEN 2 THEN (w + 1) // 2 WHEN 3 THEN (w + 1) // 2 + (w + 1) // 4 ELSE w + 1 - 10 END AS a FROM boxes, range(5) r(n)),
    sl AS (SELECT page_id, idx, n, x + greatest(a, 0) + (least(a + 10, w + 1) - greatest(a, 0)) // 2 AS cx, y + (top + low) // 2 AS cy, low - top + 1 AS thick FROM (SELECT *, CAST(round_even(fall * CAST(greatest(a, 0) AS DOUBLE) / w, 0) AS BIGINT) AS top, CAST(round_even(fall * CAST(least(a + 9, w) AS DOUBLE) / w + h // 4, 0) AS BIGINT) AS low FROM q)),
    ln AS (SELECT page_id, idx, CASE WHEN max(cy) - min(cy) > avg(thick) THEN CAST(max(cy) - min(cy) AS DOUBLE) ELSE 0.0 END AS yd, CAST(round_even(avg(cy), 0) AS BIGINT) AS level FROM sl GROUP BY page_id, idx),
    best AS (SELECT page_id, arg_min(idx, struct_pack(g := abs(mean - yd), i := idx)) AS idx FROM (SELECT *, avg(yd) OVER w AS mean, max(yd) OVER w AS most FROM ln WINDOW w AS (PARTITION BY page_id)) WHERE yd > 0 AND abs(mean - yd) < most GROUP BY page_id)"""


@query("g19_curved_lines", f"WITH {_SLICES} SELECT page_id, idx, yd > 0 AS curved, yd AS spread FROM ln")
def curved(e) -> DataFrame:
    """Whether a line is bent, and how far the middles of its five slices spread."""

    def bent(page, idx, *box):
        _, cy, heights = G.slices_of(*_contours(*(c.to_numpy() for c in (idx, *box))), 10)
        spread = G.bent_lines(cy, heights)
        return page, idx, pa.array(spread > 0), pa.array(spread)

    return many_rows(e.boxes.select("page_id", "idx", "x", "y", "w", "h"), bent, StructType().add("page_id", LongType()).add("idx", IntegerType()).add("curved", "boolean").add("spread", "double"))


@query("g20_g21_control_points", f"""WITH {_SLICES}, pts AS (SELECT page_id, n AS place, CAST(cy AS DOUBLE) AS in_y, CAST(cx AS DOUBLE) AS in_x, CAST(level AS DOUBLE) AS out_y, CAST(cx AS DOUBLE) AS out_x FROM best JOIN sl USING (page_id, idx) JOIN ln USING (page_id, idx)
    UNION ALL SELECT page_id, 5 + k, (k // 2) * 999.0, (k % 2) * 799.0, (k // 2) * 999.0, (k % 2) * 799.0 FROM best, range(4) r(k)) SELECT page_id, CAST(place AS INTEGER) AS place, in_y, in_x, out_y, out_x FROM pts""")
def control_points(e) -> DataFrame:
    """The points that straighten each page that has a bent line, serialized and read again."""

    corners = np.array([(y, x, y, x) for y in (0.0, HEIGHT - 1.0) for x in (0.0, WIDTH - 1.0)])

    def points(keys, at, box):
        pages, _, rows = G.control_rows(*_contours(*box), at, 10)
        rows = np.concatenate([rows.reshape(-1, 5, 4), np.broadcast_to(corners, (len(rows) // 5, 4, 4))], axis=1).reshape(-1, 4)
        ends = pa.array(np.arange(0, len(rows) + 1, 9, dtype=np.int32))
        side = lambda k: pa.ListArray.from_arrays(ends, pa.StructArray.from_arrays([pa.array(rows[:, k]), pa.array(rows[:, k + 1])], ["y", "x"]))
        return keys.take(pa.array(pages[::5])), side(0), side(2)

    found = many_pages(e.boxes, "page_id", ["idx", "x", "y", "w", "h"], points, "page_id long, given array<struct<y:double,x:double>>, wanted array<struct<y:double,x:double>>")
    stored = found.select("page_id", G.serialized_points(F.col("given"), F.col("wanted")).alias("rows"))
    again = stored.select("page_id", G.read_points(F.col("rows")).alias("p")).select("page_id", F.posexplode(F.arrays_zip(F.col("p.given").alias("g"), F.col("p.wanted").alias("o"))).alias("place", "z"))
    return again.select("page_id", "place", *[F.col(f"z.{s}.{c}").cast("double").alias(f"{n}_{c}") for s, n in (("g", "in"), ("o", "out")) for c in ("y", "x")])


_PAIR = "a.idx < b.idx AND a.label = 'text-area' AND b.label = 'text-area' AND greatest(0, least(a.y2, b.y2) - greatest(a.y1, b.y1)) >= 0.6 * least(a.y2 - a.y1, b.y2 - b.y1) AND greatest(0, least(a.x2, b.x2) - greatest(a.x1, b.x1)) < 0.05 * least(a.x2 - a.x1, b.x2 - b.x1)"
_TAGS = f"""n AS (SELECT page_id, count(*) FILTER (label = 'footnote') AS fn, count(*) FILTER (label = 'text-area') AS ta, coalesce(bool_or(label = 'header'), false) AS hd, coalesce(bool_or(label = 'footer'), false) AS ft FROM regions GROUP BY page_id),
    tw AS (SELECT DISTINCT a.page_id FROM regions a JOIN regions b ON a.page_id = b.page_id AND {_PAIR}), g AS (SELECT n.*, tw.page_id IS NOT NULL AS two FROM n LEFT JOIN tw USING (page_id)),
    t AS (SELECT *, CASE WHEN fn > 0 AND two THEN 'fn+cols' WHEN fn > 0 THEN 'footnote' WHEN two THEN 'two-col' WHEN hd AND ft THEN 'hf' WHEN hd THEN 'h' WHEN ft THEN 'f' WHEN ta >= 3 THEN 'many-ta' ELSE 'plain' END AS bucket,
      CASE WHEN fn > 0 AND two THEN 400 + fn * 10 WHEN fn > 0 THEN 300 + fn * 10 WHEN two THEN 200 + ta WHEN hd AND ft THEN 120 WHEN hd THEN 80 WHEN ft THEN 70 WHEN ta >= 3 THEN 50 ELSE 10 END AS score FROM g)"""


def tagged(e) -> DataFrame:
    """(page_id, tags, bucket, score, two): what a layout holds, the kind of page that makes it and how much it is worth a look."""
    n = lambda lab: F.count(F.when(F.col("label") == lab, 1))
    some = lambda lab: n(lab) > 0
    areas = F.filter("rs", lambda r: r["label"] == "text-area")

    def beside(a, b):
        return (G.overlap_share(a["y1"], a["y2"], b["y1"], b["y2"]) >= 0.6) & (G.overlap_share(a["x1"], a["x2"], b["x1"], b["x2"]) < 0.05)

    g = e.regions.groupBy("page_id").agg(F.collect_list(F.struct("idx", "label", *_BOX)).alias("rs"), n("footnote").alias("fn"), n("text-area").alias("ta"), some("header").alias("hd"), some("footer").alias("ft"))
    # Two columns are there if any two text areas stand side by side: the set they are in has two members then.
    g = g.withColumn("two", F.exists(areas, lambda a: F.exists(areas, lambda b: (a["idx"] < b["idx"]) & beside(a, b)))).drop("rs")
    kinds = [("fn > 0 and two", "fn+cols", "400 + fn * 10"), ("fn > 0", "footnote", "300 + fn * 10"), ("two", "two-col", "200 + ta"), ("hd and ft", "hf", "120"), ("hd", "h", "80"), ("ft", "f", "70"), ("ta >= 3", "many-ta", "50"), ("true", "plain", "10")]
    case = lambda k, quote: F.expr("case " + " ".join(f"when {c} then {quote}{(b, s)[k]}{quote}" for c, b, s in kinds) + " end")
    tags = F.concat_ws(", ", F.when(F.col("fn") > 0, F.concat(F.lit("footnote×"), "fn")), F.when(F.col("two"), F.concat(F.lit("two-col×"), "ta")), F.when(F.col("hd"), "header"), F.when(F.col("ft"), "footer"))
    return g.select("page_id", F.when(tags == "", "plain").otherwise(tags).alias("tags"), case(0, "'").alias("bucket"), case(1, "").cast("long").alias("score"), "two")


@query("t20_layout_tags", f"WITH {_TAGS} SELECT page_id, coalesce(nullif(concat_ws(', ', CASE WHEN fn > 0 THEN 'footnote×' || fn END, CASE WHEN two THEN 'two-col×' || ta END, CASE WHEN hd THEN 'header' END, CASE WHEN ft THEN 'footer' END), ''), 'plain') AS tags, bucket, score FROM t")
def layout_tags(e) -> DataFrame:
    return tagged(e).drop("two")


QUOTAS, FORCED = (("fn+cols", 20), ("two-col", 45), ("footnote", 20), ("hf", 8), ("h", 4), ("f", 3), ("many-ta", 5), ("plain", 3)), (5,)
_QUOTA = "(VALUES " + ", ".join(f"('{b}', {k}, {n})" for k, (b, n) in enumerate(QUOTAS)) + ") q(bucket, turn, quota)"


@query("w10_stratified_sample", f"""WITH {_TAGS}, r AS (SELECT t.page_id, t.bucket, t.score, t.two, q.turn, q.quota, t.page_id IN (5) AS forced, row_number() OVER (PARTITION BY t.bucket, t.page_id IN (5) ORDER BY t.score DESC, md5(CAST(t.page_id AS VARCHAR)), t.page_id) AS place FROM t JOIN {_QUOTA} ON q.bucket = t.bucket),
    o AS (SELECT *, CASE WHEN forced THEN 0 WHEN place <= quota THEN 1 ELSE 2 END AS phase FROM r), c AS (SELECT * FROM o ORDER BY phase, CASE WHEN phase = 1 THEN turn END, CASE WHEN phase = 1 THEN place END, CASE WHEN phase = 2 AND NOT two THEN 1 ELSE 0 END, score DESC, page_id LIMIT 120)
    SELECT page_id, bucket, score FROM c""")
def stratified(e) -> DataFrame:
    """A sample of pages: the forced ones, so many of each bucket in turn, what is missing from the rest, up to a limit in all."""
    return sampled(tagged(e), limit=120)


def sampled(pages: DataFrame, limit: int, quotas=QUOTAS, forced=FORCED) -> DataFrame:
    """At most ``limit`` of (page_id, bucket, score, two): forced pages first, then the best of each bucket up to its quota in the order given, then of the rest those with two columns
    and a greater score. Within a bucket equals go by the hash of their id. The result is ordered by falling score.

    Both steps are top-k: a rank that each task prunes before the shuffle, and an ordered limit; no bucket meets in one task."""
    turn = F.create_map(*[F.lit(x) for k, (b, n) in enumerate(quotas) for x in (b, k)])[F.col("bucket")]
    quota = F.create_map(*[F.lit(x) for b, n in quotas for x in (b, n)])[F.col("bucket")]
    kept = pages.where(~F.col("page_id").isin(*forced))
    place = F.row_number().over(Window.partitionBy("bucket").orderBy(F.desc("score"), F.md5(F.col("page_id").cast("string").cast("binary")), "page_id"))
    best = kept.withColumn("place", place).where(F.col("place") <= max(n for _, n in quotas)).where(F.col("place") <= quota).select("page_id", turn.alias("turn"), "place")  # bounded by the quotas
    marked = kept.join(F.broadcast(best), "page_id", "left").unionByName(pages.where(F.col("page_id").isin(*forced)).withColumns({"turn": F.lit(-1), "place": F.lit(0)}))
    first = [F.asc_nulls_last("turn"), F.asc("place"), F.when(F.col("turn").isNull() & ~F.col("two"), 1).otherwise(0), F.desc("score"), F.asc("page_id")]
    return marked.orderBy(*first).limit(limit).select("page_id", "bucket", "score").orderBy(F.desc("score"), "page_id")


@query("f16_f17_s09_removed_codes", """SELECT page_id, CASE WHEN bool_or(label = 'header') AND bool_or(label = 'footer') THEN 'hf' WHEN bool_or(label = 'header') THEN 'h' WHEN bool_or(label = 'footer') THEN 'f' ELSE 'none' END AS removed, count(*) FILTER (label = 'text-area') AS bodies FROM regions GROUP BY page_id""")
def removed(e) -> DataFrame:
    names = F.create_map(*[F.lit(x) for kv in {0: "header", 1: "text-area", 2: "footnote", 3: "footer"}.items() for x in kv])
    lab = F.coalesce(F.nullif(F.lower(F.trim("label")), F.lit("")), F.try_element_at(names, F.col("cls")), F.lit(""))
    g = e.boxes.select("page_id", lab.alias("lab")).groupBy("page_id").agg(F.bool_or(F.col("lab") == "header").alias("h"), F.bool_or(F.col("lab") == "footer").alias("f"), F.count(F.when(F.col("lab") == "text-area", 1)).alias("bodies"))
    return g.select("page_id", F.when(F.col("h") & F.col("f"), "hf").when(F.col("h"), "h").when(F.col("f"), "f").otherwise("none").alias("removed"), "bodies")


@query("f21_f22_filter_and_rescale", r"""SELECT page_id, idx, CAST(trunc(x / 0.75) AS INTEGER) AS x, CAST(trunc(y / 0.75) AS INTEGER) AS y, CAST(trunc(w / 0.75) AS INTEGER) AS w, CAST(trunc(h / 0.75) AS INTEGER) AS h FROM boxes
    WHERE w * h > 0.001 * 800 * 1000 AND w + 1 >= 0.01 * 800 AND h + 1 >= 10 AND idx % 4 <> 1 AND NOT (idx % 4 = 2)""")
def rescale(e) -> DataFrame:
    """Contours large enough to be lines, then lines with a text that isn't blank, with boxes in the pixels of the original page."""
    corner = lambda dx, dy: F.struct((F.col("x") + dx * F.col("w")).alias("x"), (F.col("y") + dy * F.col("h")).alias("y"))
    text = F.when(F.col("idx") % 4 == 1, F.lit(None).cast("string")).when(F.col("idx") % 4 == 2, " \n ").otherwise("text")
    lines = e.boxes.select("page_id", "idx", "x", "y", "w", "h", G.bounds(F.array(corner(0, 0), corner(1, 0), corner(1, 1), corner(0, 1))).alias("b"), text.alias("text"))
    large = (F.col("w") * F.col("h") > 0.001 * WIDTH * HEIGHT) & (F.col("b.w") >= 0.01 * WIDTH) & (F.col("b.h") >= 10)
    whole = [(F.col(c) / 0.75).cast("int").alias(c) for c in ("x", "y", "w", "h")]
    return lines.where(large & (T.stripped(F.col("text")) != "")).select("page_id", "idx", *whole)
