"""Quality scoring by ordinal cumulative-link regression on graded ratings.

P(grade > k) = sigmoid(w . x - b_k): one weight vector over hashed text features serves all grades, with ordered thresholds b_1 <= b_2 <= ... .
It gives the expected grade and the tail probability P(grade >= g) that selection uses. With two grades it is logistic regression.

Features are shares in the text of its hashed words, of hashed word shapes (size, case, what the word ends with, repeat of its
neighbour), and one-hot grades of whole-text ratios (distinct words, distinct pairs of words, size), all hashed into ``WIDTH`` weights.

The fit uses a bounded sample of rated documents (``sample``, by the hash of the id); features are made on the executors. Scoring is one
pass without a shuffle, with WIDTH weights sent along.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType

from . import kernels as K
from .common import batch, col, filter_rows, id_text, key_of, row_schemas, text_of, tidy
from .linear import Rows, minimise, sigmoid

BITS = 14
WIDTH = 1 << BITS
SAMPLE, STEPS, RIDGE, KEEP = 6_000, 250, 1e-5, 0.5
_SHAPE, _RATIO = K.seeded(11, 1)[0], K.seeded(12, 64)


def _classes() -> np.ndarray:
    kind = np.zeros(256, np.uint64)
    for c in range(128):
        kind[c] = 1 if chr(c).islower() else 2 if chr(c).isupper() else 3 if chr(c).isdigit() else 16 + c
    kind[128:] = 4
    return kind


_KIND = _classes()


def features(column: pa.Array):
    """Yields (first row, last row, row, bucket, value) by pieces, sorted by row and bucket; rows without words have none."""
    for i, j, h, first, data, start, end in K.word_hashes(column):
        n, row = j - i, K.rows_of(first)
        count = np.diff(first)
        same = np.zeros(len(h), np.uint64)
        same[1:] = (h[1:] == h[:-1]) & (row[1:] == row[:-1])
        size = np.minimum(end - start, 24).astype(np.uint64)
        shape = K.mix(((size * np.uint64(256) + _KIND[data[start]]) * np.uint64(256) + _KIND[data[end - 1]]) * np.uint64(256) + _KIND[data[(start + end - 1) // 2]] * np.uint64(2) + same ^ _SHAPE)
        bucket = np.concatenate([h >> np.uint64(64 - BITS), shape >> np.uint64(64 - BITS)])
        key = (np.concatenate([row, row]).astype(np.uint64) << np.uint64(BITS)) | bucket
        key.sort()
        at = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
        times = np.diff(np.append(at, len(key)))
        who = (key[at] >> np.uint64(BITS)).astype(np.int64)
        value = np.sqrt(times / count[who])  # the root lets a rare mark count
        ratios = np.stack([distinct(h, row, n), distinct(K.mix(h * K.GOLD + np.roll(h, -1)), row, n), np.log2(np.maximum(count, 1)) / 16, K.row_sums(same.astype(np.float64), first) / np.maximum(count, 1)])
        step = np.clip((ratios * 16).astype(np.int64), 0, 15)
        some = np.flatnonzero(count)
        extra = np.concatenate([(K.mix(_RATIO[k] ^ (step[k][some].astype(np.uint64) + np.uint64(1)) * K.GOLD) >> np.uint64(64 - BITS)).astype(np.int64) for k in range(len(ratios))])
        r = np.concatenate([who, np.tile(some, len(ratios))])
        b = np.concatenate([(key[at] & np.uint64(WIDTH - 1)).astype(np.int64), extra])
        v = np.concatenate([value, np.ones(len(extra))])
        order = np.argsort(r, kind="stable")
        yield i, j, r[order], b[order], v[order]


def distinct(h: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
    """The share of distinct values of each row."""
    width = K.ROW_BITS
    key = np.sort((row.astype(np.uint64) << np.uint64(64 - width)) | (h >> np.uint64(width)))
    new = np.append(True, key[1:] != key[:-1]) if len(key) else np.zeros(0, bool)
    many = np.bincount((key[new] >> np.uint64(64 - width)).astype(np.int64), minlength=n)
    return many / np.maximum(np.bincount(row, minlength=n), 1)


@dataclass(frozen=True)
class Model:
    grades: tuple[int, ...]
    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, score: np.ndarray) -> np.ndarray:
        """P(grade >= g) for every grade but the least: n x (grades - 1)."""
        return sigmoid(score[:, None] - self.thresholds[None, :])


def _fit(x: Rows, y: np.ndarray, grades: tuple[int, ...], steps: int, ridge: float) -> Model:
    """y: the rank of the grade. Maximum likelihood with a ridge; thresholds are a first one and positive gaps, so they stay ordered."""
    k, width = len(grades) - 1, x.width
    above = np.array([np.mean(y > c) for c in range(k)]).clip(1e-3, 1 - 1e-3)
    base = -np.log(above / (1 - above))
    gaps = np.log(np.maximum(np.diff(base), 1e-2))
    weight = (len(y) / (len(grades) * np.bincount(y, minlength=len(grades)).clip(1)))[y]  # rare grades count as much as common ones
    weight /= weight.sum()

    def unpack(p):
        step = np.exp(np.clip(p[width + 1 :], -20, 20))
        return p[:width], p[width] + np.append(0, np.cumsum(step)), step

    def gradient(p):
        w, b, step = unpack(p)
        edge = np.concatenate([np.full((len(x), 1), np.inf), x.dot(w)[:, None] - b, np.full((len(x), 1), -np.inf)], axis=1)
        cdf = np.where(edge == np.inf, 1.0, np.where(edge == -np.inf, 0.0, sigmoid(edge)))
        r = np.arange(len(y))
        hi, lo = cdf[r, y], cdf[r, y + 1]
        mass = np.maximum(hi - lo, 1e-12)
        d_hi, d_lo = hi * (1 - hi) / mass, lo * (1 - lo) / mass
        d_b = np.zeros(k + 2)
        np.add.at(d_b, y, weight * d_hi)
        np.add.at(d_b, y + 1, -weight * d_lo)
        d_b = d_b[1:-1]
        return np.concatenate([x.back(-weight * (d_hi - d_lo)) + ridge * w, [d_b.sum()], [d_b[c + 1 :].sum() * step[c] for c in range(k - 1)]])

    p = minimise(gradient, np.concatenate([np.zeros(width), base[:1], gaps]), steps)
    w, b, _ = unpack(p)
    return Model(grades, w, b)


def fit(df: DataFrame, ratings: DataFrame, id_col: str = "doc_id", text_col: str = "text", rating_id: str = "doc_id", grade_col: str = "quality", sample: int = SAMPLE, steps: int = STEPS, ridge: float = RIDGE) -> Model:
    """Fits on at most ``sample`` rated documents.

    Null ids, grades and texts don't count. Of several ratings of an id the least counts, and of its texts the least; ids may be of any type. With fewer
    than two grades there is nothing to learn: every text that has a word then gets the only grade (1, if there is none) and is kept.
    """
    rated = ratings.select(key_of(ratings, rating_id).alias("id"), col(ratings, grade_col).cast("int").alias("grade")).where("id is not null and grade is not null")
    chosen = rated.groupBy("id").agg(F.min("grade").alias("grade")).orderBy(F.xxhash64("id"), "id").limit(sample)
    out = pa.schema([("id", pa.int64()), ("grade", pa.int32()), ("bucket", pa.binary()), ("value", pa.binary())])

    def made(batches):
        for x in batches:
            for i, j, row, bucket, value in features(x.column("text")):
                cut = np.searchsorted(row, np.arange(j - i + 1))
                spans = list(zip(cut[:-1], cut[1:]))
                part = x.slice(i, j - i)
                yield batch(out, part.column("id"), part.column("grade"), [bucket[a:b].astype("<u2").tobytes() for a, b in spans], [value[a:b].astype("<f4").tobytes() for a, b in spans])

    texts = id_text(df, id_col, text_col).where("text is not null").join(F.broadcast(chosen), "id").groupBy("id", "grade").agg(F.min("text").alias("text"))
    rows = texts.select("id", "grade", "text").mapInArrow(made, "id long, grade int, bucket binary, value binary").collect()  # one row an id: bounded by ``sample``
    rows.sort(key=lambda r: r.id)
    grades = tuple(sorted({r.grade for r in rows}))
    if len(grades) < 2:
        only = grades[0] if grades else 1
        return Model((only - 1, only), np.zeros(WIDTH), np.array([-30.0]))
    x = Rows.of([(np.frombuffer(r.bucket, "<u2"), np.frombuffer(r.value, "<f4")) for r in rows], WIDTH)
    return _fit(x, np.array([grades.index(r.grade) for r in rows]), grades, steps, ridge)


def score(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", at_least: int | None = None, keep: float = KEEP) -> DataFrame:
    """(id, expected_grade, p_tail, keep) for every row; p_tail is P(grade >= at_least), by default the least grade but one.

    Texts without a word, null ones included, get the least grade and p_tail 0 and aren't kept. Rows with null or repeated
    ids are rows like others; equal texts score alike; an empty table gives no rows; other columns are ignored. Whole texts count.
    """
    grades = np.array(model.grades, np.float64)
    tail = model.grades.index(at_least) - 1 if at_least is not None else 0
    if tail < 0:
        raise ValueError("at_least must be a grade above the least")
    docs = text_of(df, id_col, text_col)
    schema, arrow = row_schemas(docs, [("expected_grade", DoubleType()), ("p_tail", DoubleType()), ("keep", BooleanType())])

    @tidy
    def scored(batches):
        for x in batches:
            for i, j, row, bucket, value in features(x.column("text")):
                some = np.bincount(row, minlength=j - i) > 0
                p = model.tails(np.bincount(row, value * model.weights[bucket], j - i)) * some[:, None]
                yield batch(arrow, x.column("id").slice(i, j - i), grades[0] + p @ np.diff(grades), p[:, tail], p[:, tail] >= keep)

    return docs.mapInArrow(scored, schema)


def drop_low(df: DataFrame, model: Model, text_col: str = "text", at_least: int | None = None, keep: float = KEEP) -> DataFrame:
    """The rows of ``df`` that ``score`` keeps, with all their columns, whatever their names and nulls in them.

    Null, empty and blank texts go; rows with null or repeated ids, and equal rows, are judged each by its own text; an empty table stays empty. Whole texts count.
    """
    tail = model.grades.index(at_least) - 1 if at_least is not None else 0
    if tail < 0:
        raise ValueError("at_least must be a grade above the least")

    def kept(column):
        out = [np.zeros(0, bool)]
        for i, j, row, bucket, value in features(column):
            some = np.bincount(row, minlength=j - i) > 0
            out.append(some & (model.tails(np.bincount(row, value * model.weights[bucket], j - i))[:, tail] >= keep))
        return np.concatenate(out)

    return filter_rows(df, text_col, kept)
