"""Box and contour geometry as column expressions; reading order, hulls and slices of contours as plain functions over a page."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

from . import bound

Box = tuple[float, float, float, float]


def pixel_box(x: Column, y: Column, w: Column, h: Column, width: Column, height: Column, pad: int = 0) -> Column:
    """(x1, y1, x2, y2) in pixels of a centre-normalised box, clamped to the page; null where nothing is left."""
    x1 = F.greatest(F.floor((x - w / 2) * width) - pad, F.lit(0)).cast("int")
    y1 = F.greatest(F.floor((y - h / 2) * height) - pad, F.lit(0)).cast("int")
    x2 = F.least(F.ceil((x + w / 2) * width) + pad, width).cast("int")
    y2 = F.least(F.ceil((y + h / 2) * height) + pad, height).cast("int")
    return F.when((w > 0) & (h > 0) & (width > 0) & (height > 0) & (x2 > x1) & (y2 > y1), F.struct(x1.alias("x1"), y1.alias("y1"), x2.alias("x2"), y2.alias("y2")))


def overlap_share(a1: Column, a2: Column, b1: Column, b2: Column) -> Column:
    """Overlap of two intervals as a share of the shorter; 0 where one is empty."""
    short = F.least(a2 - a1, b2 - b1)
    return F.when(short > 0, F.greatest(F.lit(0), F.least(a2, b2) - F.greatest(a1, b1)) / short).otherwise(0.0)


def covered_share(ax1, ay1, ax2, ay2, bx1, by1, bx2, by2) -> Column:
    """The part of box a that box b covers."""
    inter = F.greatest(F.lit(0), F.least(ax2, bx2) - F.greatest(ax1, bx1)) * F.greatest(F.lit(0), F.least(ay2, by2) - F.greatest(ay1, by1))
    area = F.greatest(F.lit(0), ax2 - ax1) * F.greatest(F.lit(0), ay2 - ay1)
    return F.when(area > 0, inter / area).otherwise(0.0)


def inside(ax1, ay1, ax2, ay2, bx1, by1, bx2, by2, slack: int = 1) -> Column:
    """Whether box a lies in box b, but for so many pixels at each side."""
    return (ax1 >= bx1 - slack) & (ay1 >= by1 - slack) & (ax2 <= bx2 + slack) & (ay2 <= by2 + slack)


def skew(angle: Column) -> Column:
    """The tilt that the angle of a least rectangle stands for, whichever side it is measured from: 45 and -45 stay as they are."""
    return F.when(angle.between(0, 90), F.when(angle > 45, angle - 90).otherwise(angle)).when(angle < -45, angle + 90).otherwise(angle)


def trimmed_angle(angles: Column) -> Column:
    """The mean of an array of (a, w), weighted by w, of the angles within three median deviations of the median; of all if that deviation is 0; 0 if there are none."""

    def mean(kept):
        total = lambda f: F.aggregate(kept, F.lit(0.0), lambda s, x: s + f(x))
        return bound(total(lambda x: x["w"]), lambda weight: F.when(weight > 0, F.try_divide(total(lambda x: x["a"] * x["w"]), weight)).otherwise(F.try_divide(total(lambda x: x["a"]), F.size(kept))))

    def trimmed(center):
        spread = median_of(F.array_sort(F.transform(angles, lambda x: F.abs(x["a"] - center))))
        return bound(spread, lambda s: bound(F.filter(angles, lambda x: (s == 0) | (F.abs(x["a"] - center) <= 3 * s)), mean))

    return F.when(F.size(angles) == 0, 0.0).otherwise(bound(median_of(F.array_sort(F.transform(angles, lambda x: x["a"]))), trimmed))


def median_of(ordered: Column) -> Column:
    """The median of a sorted array; null of an empty one."""

    def middle(xs):
        n = F.size(xs)
        at = lambda k: F.get(xs, F.floor(k).cast("int"))
        return F.when(n > 0, (at((n - 1) / 2) + at(n / 2)) / 2)

    return bound(ordered, middle)


def page_rotation(rects: Column, most: float = 5.0, least: float = 0.2) -> Column:
    """The rotation of a page from the least rectangles (angle, w, h) of its lines: level and steep ones don't count, a small result is 0 and one beyond the
    greatest allowed is an error."""
    tilted = F.transform(rects, lambda r: F.struct(skew(r["angle"].cast("double")).alias("a"), F.greatest(r["w"] * r["h"], F.lit(1)).cast("double").alias("w")))
    used = F.filter(tilted, lambda t: (F.abs(t["a"]) >= 1e-6) & (F.abs(t["a"]) <= most))
    too_far = F.raise_error(F.lit("the angle of the page is beyond the greatest allowed")).cast("double")
    return bound(bound(used, trimmed_angle), lambda angle: F.when(F.abs(angle) > most, too_far).when(F.abs(angle) < least, 0.0).otherwise(angle))


def clamp_short(c: Column) -> Column:
    return F.greatest(F.lit(-32768), F.least(F.lit(32767), c)).cast("short")


def scaled_points(points: Column, sx: Column, sy: Column) -> Column:
    """The points (x, y) of a contour in a frame of another size, rounded, halves to even."""
    return F.transform(points, lambda p: F.struct(F.bround(p["x"] * sx, 0).cast("int").alias("x"), F.bround(p["y"] * sy, 0).cast("int").alias("y")))


def rotated_points(points: Column, degrees: Column, width: Column, height: Column) -> Column:
    """The points (x, y) of a contour turned counter-clockwise about the middle of the page, rounded, halves to even; as they are where the angle is 0."""
    c, s = F.cos(F.radians(degrees)), F.sin(F.radians(degrees))
    cx, cy = width / 2.0, height / 2.0

    def turned(p):
        x, y = p["x"] - cx, p["y"] - cy
        return F.struct(F.bround(c * x + s * y + cx, 0).cast("int").alias("x"), F.bround(c * y - s * x + cy, 0).cast("int").alias("y"))

    return F.when(F.abs(degrees) < 1e-12, points).otherwise(F.transform(points, turned))


def bounds(points: Column) -> Column:
    """(x, y, w, h) of a contour; both edges count."""
    side = lambda k: (F.array_min(F.transform(points, lambda p: p[k])), F.array_max(F.transform(points, lambda p: p[k])))
    (x1, x2), (y1, y2) = side("x"), side("y")
    return F.struct(x1.alias("x"), y1.alias("y"), (x2 - x1 + 1).alias("w"), (y2 - y1 + 1).alias("h"))


def crop_margin(width: Column, height: Column, box_height: Column, page_share: float, least: int = 8, box_share: float = 0.0) -> Column:
    """Pixels around a crop: the greatest of a least number, a share of the shorter side of the page and a share of the height of the box; halves round to even."""
    share = lambda c, f: F.bround(c * F.lit(float(f)), 0).cast("int")
    return F.greatest(F.lit(least), share(F.least(width, height), page_share), share(F.greatest(box_height, F.lit(1)), box_share) if box_share > 0 else F.lit(0))


def nearest_to_mean(deltas: Column) -> Column:
    """The place of the deviation nearest to the mean of all, zeros included. Zeros aren't chosen, of equals the first is; -1 if none is nearer than the greatest is great."""

    def place(ds):
        mean = F.aggregate(ds, F.lit(0.0), lambda s, d: s + d) / F.size(ds)

        def best(m, most):
            gaps = F.transform(ds, lambda d, k: F.struct(F.abs(m - d).alias("gap"), k.alias("k"), d.alias("d")))
            return F.coalesce(F.array_min(F.filter(gaps, lambda g: (g["d"] > 0) & (g["gap"] < most)))["k"], F.lit(-1))

        return bound(F.struct(mean.alias("m"), F.array_max(ds).alias("most")), lambda b: best(b["m"], b["most"]))

    return bound(deltas, place).cast("int")


def serialized_points(given: Column, wanted: Column) -> Column:
    """Rows [in_y, in_x, out_y, out_x] of two arrays of points (y, x); what one has more than the other is left out; null if nothing is left."""
    n = F.least(F.size(given), F.size(wanted))
    rows = F.transform(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), lambda k: F.array(*[F.get(p, k)[s].cast("float") for p in (given, wanted) for s in ("y", "x")]))
    return F.when(n > 0, rows)


def read_points(rows: Column) -> Column:
    """((x, y) of the given, (x, y) of the wanted points) of serialized rows."""
    side = lambda at: F.transform(rows, lambda r: F.struct(r[at + 1].alias("x"), r[at].alias("y")))
    return F.struct(side(0).alias("given"), side(2).alias("wanted"))


def gaps(spans: list[tuple[float, float]]) -> list[tuple[float, float]]:
    """(start, end) of what lies between merged intervals."""
    out, end = [], None
    for a, b in sorted(spans):
        if end is not None and a > end:
            out.append((end, a))
        end = b if end is None else max(end, b)
    return out


def xy_cut(boxes: list[Box], width: float, height: float) -> list[int]:
    """Reading order of the boxes of a page: cut at the gap that is the greatest share of its side of the page, across the page where two are as great; boxes go to the
    side of the cut where their middle is. Of equal gaps of a side that further on is taken. Boxes without a gap go by (y, x)."""
    side = (max(1, int(width)), max(1, int(height)))

    def order(own: list[int]) -> list[int]:
        if len(own) < 2:
            return own
        cuts = [((b - a) / side[axis], axis, (a + b) / 2) for axis in (0, 1) for a, b in gaps([(boxes[k][axis], boxes[k][axis + 2]) for k in own])]
        if not cuts:
            return sorted(own, key=lambda k: (boxes[k][1], boxes[k][0]))
        _, axis, at = max(cuts)
        before = [k for k in own if (boxes[k][axis] + boxes[k][axis + 2]) / 2 < at]
        return order(before) + order([k for k in own if k not in set(before)])

    return order(list(range(len(boxes))))


def columns_of(boxes: list[Box], least_vertical: float = 0.6, most_horizontal: float = 0.05) -> list[int] | None:
    """The connected set of side-by-side boxes with the greatest area, from left to right; None below two boxes."""

    def share(a1, a2, b1, b2):
        short = min(a2 - a1, b2 - b1)
        return max(0.0, min(a2, b2) - max(a1, b1)) / short if short > 0 else 0.0

    n, root = len(boxes), list(range(len(boxes)))

    def find(k):
        while root[k] != k:
            root[k] = root[root[k]]
            k = root[k]
        return k

    for i in range(n):
        for j in range(i + 1, n):
            a, b = boxes[i], boxes[j]
            if share(a[1], a[3], b[1], b[3]) >= least_vertical and share(a[0], a[2], b[0], b[2]) < most_horizontal:
                root[max(find(i), find(j))] = min(find(i), find(j))
    sets: dict[int, list[int]] = {}
    for k in range(n):
        sets.setdefault(find(k), []).append(k)
    area = lambda own: sum((boxes[k][2] - boxes[k][0]) * (boxes[k][3] - boxes[k][1]) for k in own)
    best = max((s for s in sets.values() if len(s) > 1), key=area, default=None)
    return sorted(best, key=lambda k: (boxes[k][0] + boxes[k][2], k)) if best else None


def outermost(boxes: list[Box], slack: int = 1, share: float = 0.95) -> list[int]:
    """The boxes that don't lie in a greater one, but for the slack or by that share of their area; of equals the first stays."""
    area = [max(0, x2 - x1) * max(0, y2 - y1) for x1, y1, x2, y2 in boxes]

    def within(a, b, own):
        if a[0] >= b[0] - slack and a[1] >= b[1] - slack and a[2] <= b[2] + slack and a[3] <= b[3] + slack:
            return True
        shared = max(0, min(a[2], b[2]) - max(a[0], b[0])) * max(0, min(a[3], b[3]) - max(a[1], b[1]))
        return own > 0 and shared / own >= share

    greater = lambda j, i: (area[j], -j) > (area[i], -i)
    return [i for i, a in enumerate(boxes) if not any(greater(j, i) and within(a, b, area[i]) for j, b in enumerate(boxes) if j != i)]


def body_regions(boxes: list[Box], width: float, height: float) -> list[int]:
    """The text boxes to read, in order: two columns side by side if there are no more than two boxes that aren't nested, else those by the XY-cut."""
    kept, columns = outermost(boxes), columns_of(boxes)
    if columns and len(columns) == 2 and len(kept) <= 2:
        return columns
    return [kept[k] for k in xy_cut([boxes[k] for k in kept], width, height)]


def hull(points: list[tuple[float, float]]) -> list[tuple[float, float]]:
    """Convex hull, counter-clockwise from the least point."""
    pts = sorted(set(points))
    if len(pts) < 3:
        return pts

    def chain(seq):
        out: list[tuple[float, float]] = []
        for p in seq:
            while len(out) > 1 and (out[-1][0] - out[-2][0]) * (p[1] - out[-2][1]) - (out[-1][1] - out[-2][1]) * (p[0] - out[-2][0]) <= 0:
                out.pop()
            out.append(p)
        return out

    return chain(pts)[:-1] + chain(pts[::-1])[:-1]


def lines_of_boxes(at: np.ndarray, idx, x, y, w, h) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(page, line, place of the box) of the boxes of many pages, page k from at[k] to at[k + 1], in the order of lines: as ``anchored_lines`` by the middles, with half the median
    height as the threshold; of boxes with one middle the last counts."""
    size = np.diff(at)
    page = np.repeat(np.arange(len(size)), size)
    high = h[np.lexsort((h, page))].astype(np.int64)
    limit = 0.5 * ((high[at[:-1] + (size - 1) // 2] + high[at[:-1] + size // 2]) / 2)
    cx, cy = x + w / 2.0, y + h / 2.0
    order = np.lexsort((h, w, y, x, idx, cx, cy, page))
    p, u, v = page[order], cx[order], cy[order]
    last = np.r_[(p[1:] != p[:-1]) | (u[1:] != u[:-1]) | (v[1:] != v[:-1]), True]
    order, p, v = order[last], p[last], v[last]
    n = np.bincount(p, minlength=len(size))
    first = np.cumsum(n) - n
    line, open_ = np.zeros(len(p), np.int64), np.argsort(-n, kind="stable")
    anchor, now, left = v[first], np.zeros(len(n), np.int64), np.sort(n)
    for k in range(1, int(n.max())):  # the k-th box of all pages that have one
        own = open_[: len(left) - int(np.searchsorted(left, k, side="right"))]
        below = v[first[own] + k]
        new = below - anchor[own] > limit[own]
        anchor[own], now[own] = np.where(new, below, anchor[own]), now[own] + new
        line[first[own] + k] = now[own]
    return p, line, order


def merged_hulls(page: np.ndarray, line: np.ndarray, x, y, w, h) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(page, line, corners, area) of the convex hull around the boxes of each line; rows of a line lie together. A box alone is its own hull."""
    start = np.flatnonzero(np.r_[True, (page[1:] != page[:-1]) | (line[1:] != line[:-1])])
    end = np.r_[start[1:], len(page)]
    corners, area = np.full(len(start), 4, np.int64), (w[start] * h[start]).astype(float)
    for k in np.flatnonzero((end - start > 1) | (w[start] <= 0) | (h[start] <= 0)).tolist():
        i, j = start[k], end[k]
        ring = hull([q for a, b, c, d in zip(*(v[i:j].tolist() for v in (x, y, w, h))) for q in ((a, b), (a, b + d), (a + c, b), (a + c, b + d))])
        corners[k], area[k] = len(ring), sum(a * d - c * b for (a, b), (c, d) in zip(ring, ring[1:] + ring[:1])) / 2
    return page[start], line[start], corners, area


def least_rectangle(points: list[tuple[float, float]]) -> tuple[float, float, float]:
    """(angle in [0, 90), width, height) of the smallest rectangle around a contour; one of its sides lies on the hull."""
    pts = np.array(hull([tuple(p) for p in points]), float)
    if len(pts) < 3:
        d = pts[-1] - pts[0]
        return float(np.degrees(np.arctan2(d[1], d[0])) % 90), float(np.hypot(*d)), 0.0
    edge = np.roll(pts, -1, axis=0) - pts
    best = None
    for t in np.arctan2(edge[:, 1], edge[:, 0]):
        along, across = pts @ [np.cos(t), np.sin(t)], pts @ [-np.sin(t), np.cos(t)]
        w, h = float(np.ptp(along)), float(np.ptp(across))
        if best is None or w * h < best[0] - 1e-9:
            best = (w * h, float(np.degrees(t) % 90), w, h)
    return best[1:]


def contour_slices(points, width: int = 40) -> tuple[np.ndarray, np.ndarray]:
    """((x, y) of the middles, heights) of five upright slices of a filled contour: at the left, ending at a quarter, from the middle, from three quarters, at the right.

    The contour's edges belong to it. A slice without width or content counts as the whole height of the contour."""
    pts = np.array([(int(p[0]), int(p[1])) for p in points], np.int64)
    cx, cy, heights = slices_of(pts[:, 0], pts[:, 1], np.array([0, len(pts)]), width)
    return np.column_stack([cx[0], cy[0]]), heights[0]


def slices_of(x: np.ndarray, y: np.ndarray, at: np.ndarray, width: int = 40) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(x of the middles, y of the middles, heights) of the five slices of each of many contours: contour k has the whole points from at[k] to at[k + 1], one at least."""
    first, size = at[:-1], np.diff(at)
    left, top = np.minimum.reduceat(x, first), np.minimum.reduceat(y, first)
    w, h = np.maximum.reduceat(x, first) - left + 1, np.maximum.reduceat(y, first) - top + 1
    xa, ya = x - np.repeat(left, size), y - np.repeat(top, size)
    after = np.arange(1, len(x) + 1)
    after[at[1:] - 1] = first
    xb, yb = xa[after], ya[after]
    half, quarter = w // 2, w // 4
    out = np.empty((3, len(first), 5), np.int64)
    for k, start in enumerate((np.zeros_like(w), quarter - width, half, half + quarter, w - width)):
        a, b = np.clip(start, 0, w), np.clip(start + width, 0, w)
        upper, lower = _rows_between(xa, ya, xb, yb, np.repeat(a, size), np.repeat(b, size))
        upper, lower = np.minimum.reduceat(upper, first), np.maximum.reduceat(lower, first)
        some = lower >= upper
        out[0, :, k] = left + a + np.where(b > a, (b - a) // 2, width // 2)
        out[1, :, k] = top + np.where(some, (upper + lower) // 2, h // 2)
        out[2, :, k] = np.where(some, lower - upper + 1, h)
    return out[0], out[1], out[2]


_FAR = 1 << 62


def _rows_between(xa, ya, xb, yb, a, b) -> tuple[np.ndarray, np.ndarray]:
    """The highest and the lowest row of each edge as it is drawn in the columns from a to b, b not included; (far, -far) where there are none. An edge takes a step for each
    column, or row if it is steeper."""
    dx, dy = xb - xa, yb - ya
    wide, tall = np.abs(dx), np.abs(dy)
    left, right = np.maximum(np.minimum(xa, xb), a), np.minimum(np.maximum(xa, xb), b - 1)
    flat = wide >= tall  # rows rise or fall with the columns: the ends tell
    rows = [np.where(wide > 0, np.rint(ya + dy * np.abs(v - xa) / np.maximum(wide, 1)).astype(np.int64), end) for v, end in ((left, ya), (right, yb))]
    upper, lower, none = np.minimum(*rows), np.maximum(*rows), left > right
    if (steep := np.flatnonzero(~none & ~flat & (wide > 0))).size:
        x0, y0, run, steps, lo, hi, down = (v[steep] for v in (xa, ya, dx, tall, left, right, np.sign(dy)))
        near, far = np.where(run > 0, lo, hi), np.where(run > 0, hi, lo)
        sign = np.sign(run)
        column = lambda k: sign * np.rint(x0 + run * k / steps).astype(np.int64)  # noqa: E731  # never falls with k
        k1 = _first(column, sign * near, np.abs(near - x0), np.abs(run), steps)
        k2 = _first(column, sign * far + 1, np.abs(far - x0) + 1, np.abs(run), steps) - 1
        ends = [y0 + down * k for k in (k1, k2)]
        upper[steep], lower[steep], none[steep] = np.minimum(*ends), np.maximum(*ends), k1 > k2
    return np.where(none, _FAR, upper), np.where(none, -_FAR, lower)


def _first(column, wanted, across, run, steps) -> np.ndarray:
    """The first step, up to one beyond the last, at which the column is reached: near where half a column less is crossed."""
    k = np.clip((2 * across - 1) * steps // (2 * run) - 1, 0, steps + 1)
    while (early := (k <= steps) & (column(k) < wanted)).any():
        k += early
    return k


def control_points(contours: list[np.ndarray], width: int, height: int, slice_width: int = 40, corners: bool = True) -> list[tuple[float, float, float, float]] | None:
    """Rows (in_y, in_x, out_y, out_x) that straighten a page, None where no line is bent.

    A line is bent if the middles of its slices spread further than the slices are high on average. The bent line whose spread is nearest to the mean of all lines (0
    for straight ones) gives the points; the corners of the page stay in place."""
    if not contours:
        return None
    pts = [np.asarray(c) for c in contours]
    at = np.cumsum([0, *map(len, pts)])
    x, y = np.concatenate(pts).T.astype(np.int64)
    _, places, rows = control_rows(x, y, at, np.array([0, len(pts)]), slice_width)
    if not len(places):
        return None
    out = [tuple(r) for r in rows.tolist()]
    return out + ([(cy, cx, cy, cx) for cy in (0.0, height - 1.0) for cx in (0.0, width - 1.0)] if corners else [])


def bent_lines(cy: np.ndarray, heights: np.ndarray) -> np.ndarray:
    """How far the middles of the slices of each contour spread, 0 where that is no more than the slices are high on average."""
    spread = np.ptp(cy, axis=1)
    return np.where(spread * heights.shape[1] > heights.sum(axis=1), spread, 0).astype(float)


def control_rows(x: np.ndarray, y: np.ndarray, at: np.ndarray, pages: np.ndarray, slice_width: int = 40) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(page, place, (in_y, in_x, out_y, out_x)) of the points, but for the corners, that straighten each of many pages with a bent line: page k has the contours from
    pages[k] to pages[k + 1], one at least, which have the points from at[k] to at[k + 1]."""
    cx, cy, heights = slices_of(x, y, at, slice_width)
    spread, first, size = bent_lines(cy, heights), pages[:-1], np.diff(pages)
    mean, most = np.add.reduceat(spread, first) / size, np.maximum.reduceat(spread, first)  # whole numbers: their sum is exact
    gap = np.abs(np.repeat(mean, size) - spread)
    gap[(spread == 0) | (gap >= np.repeat(most, size))] = np.inf
    least = np.minimum.reduceat(gap, first)
    equal = np.flatnonzero((gap == np.repeat(least, size)) & np.isfinite(gap))
    page, place = np.unique(np.repeat(np.arange(len(size)), size)[equal], return_index=True)
    best = equal[place]
    level = np.repeat(np.rint(cy[best].mean(axis=1)), 5)
    rows = np.column_stack([cy[best].ravel(), cx[best].ravel(), level, cx[best].ravel()]).astype(float)
    return np.repeat(page, 5), np.tile(np.arange(5), len(page)), rows


def anchored_lines(ys: Column, threshold: float | Column) -> Column:
    """The line of each box in the order given: a line ends where a box lies further below than the threshold from its first box."""
    limit = F.lit(float(threshold)) if not isinstance(threshold, Column) else threshold
    first = F.struct(F.lit(None).cast("double").alias("anchor"), F.lit(-1).alias("line"), F.array().cast("array<int>").alias("out"))

    def step(a, y):
        new = a["anchor"].isNull() | (y - a["anchor"] > limit)
        line = F.when(new, a["line"] + 1).otherwise(a["line"])
        return F.struct(F.when(new, y.cast("double")).otherwise(a["anchor"]).alias("anchor"), line.alias("line"), F.concat(a["out"], F.array(line)).alias("out"))

    return F.aggregate(ys, first, step, lambda a: a["out"])
