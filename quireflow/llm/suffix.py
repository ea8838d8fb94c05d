"""Suffix-array dedup: windows of ``depth`` words that occur more than once in the corpus.

A depth-limited most-significant-digit radix sort of all suffixes: a digit is a run of depth/2 words,
hashed to 64 bits, so two digits order a suffix through the threshold. Suffixes with equal digits form groups that are exactly the repeated windows; the
order between groups has no use and is that of the hashes.

Pass 0 thins the corpus. Each window is represented by the least digit that begins in its first half (two equal windows
have the same one); a digit that represents windows in one place alone can't begin a group, and its windows leave. A
representative is shared by about a quarter of ``depth`` windows, so this pass moves a small part of the corpus. Pass 1 sorts
the windows left by their first digit (its top bits choose the partition) and drops singletons, pass 2 sorts within groups by the second.

A digit or window that recurs within a batch is known to be repeated there and sends one witness, so a line that stands in
every document costs one record per batch, not one per document.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .common import PACKED, batch, by_part, id_text, named, packed_batches, parts_for, planned_bytes, tidy, unpack

DEPTH = 50
QUERY, KNOWN, WITNESS = 0, 1, 2  # KNOWN passes through; WITNESS says "elsewhere too" and wants no answer
_DIGIT = np.dtype([("value", "<u8"), ("id", "<i8"), ("kind", "u1")])
_WINDOW = np.dtype([("d1", "<u8"), ("d2", "<u8"), ("id", "<i8"), ("pos", "<u4"), ("kind", "u1")])
_SPAN = np.dtype([("id", "<i8"), ("pos", "<u4"), ("n", "<u4"), ("first", "u1")])


def _sliding_min(g: np.ndarray, width: int) -> np.ndarray:
    out, k = g.copy(), 1
    while 2 * k <= width:
        out[:-k] = np.minimum(out[:-k], out[k:])
        k *= 2
    if k < width:
        out[: k - width] = np.minimum(out[: k - width], out[width - k :])
    return out


def _windows(h: np.ndarray, first: np.ndarray, depth: int):
    """(row of each word, place in its row, whether a window begins there, its first digit, its representative)."""
    row = K.rows_of(first)
    pos = np.arange(len(h)) - first[row]
    ok = pos <= np.diff(first)[row] - depth
    digit = K.grams(h, depth // 2)
    return row, pos, ok, digit, _sliding_min(digit, depth // 2 + 1)


def _runs(*keys: np.ndarray) -> np.ndarray:
    """Where a new run of equal keys begins."""
    new = np.zeros(len(keys[0]), bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


def repeated_spans(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", depth: int = DEPTH) -> DataFrame:
    """(id, start_token, end_token, n_windows, n_first): the spans of each text that consist of repeated windows.

    A word is a run of bytes other than ASCII white space; a window is ``depth`` (even) words in a row; it is repeated if the same words
    occur at another place of this or any other text. A span is the union of repeated windows that overlap, as a half-open
    range of words; ``n_windows`` of them begin in it, ``n_first`` of which are the first of their group in the order of (id, place): what
    a removal that leaves one copy must keep. Texts without repeats, or with fewer than ``depth`` words, null and empty texts give no
    rows; so does an empty table. Of rows that repeat an id each text is searched and its places count under that id. Ids may be of any type; of others than whole numbers the order is that
    of their hashes. Rows with a null id are left out. Equality is that of two 64-bit hashes. Whole texts are searched and every window counts.
    """
    if depth < 4 or depth % 2:
        raise ValueError("depth must be an even number of words, 4 at least")
    docs, half = id_text(df, id_col, text_col), depth // 2
    n = parts_for(df, 4 * planned_bytes(docs))  # windows of texts that repeat throughout

    @tidy
    def digits(batches):
        for x in batches:
            ids = x.column("id").to_numpy()
            for i, _, h, first, *_ in K.word_hashes(x.column("text")):
                if len(h) < depth:
                    continue
                row, _, ok, digit, low = _windows(h, first, depth)
                anchor = np.zeros(len(h), bool)
                for k in range(half + 1):
                    anchor[k:] |= ok[: len(h) - k] & (low[: len(h) - k] == digit[k:])
                at = np.flatnonzero(anchor)
                value, own = digit[at], row[at]
                order = np.lexsort((own, value))
                value, own = value[order], own[order]
                start = _runs(value)
                size = np.diff(np.append(start, len(value)))
                often = np.repeat(size > 1, size)  # at two places of this batch, be they in one text
                pair = _runs(value, own)
                record = np.zeros(len(pair), _DIGIT)
                record["value"], record["id"] = value[pair], ids[i + own[pair]]
                record["kind"] = np.where(often[pair], KNOWN, QUERY)
                witness = record[np.flatnonzero(np.isin(pair, start[size > 1]))]
                witness["kind"] = WITNESS
                record = np.concatenate([record, witness])
                route = np.where(record["kind"] == KNOWN, K.mix(record["id"].astype(np.uint64)), record["value"])
                yield from packed_batches((route % np.uint64(n)).astype(np.int64), record, n)

    @tidy
    def repeated_digits(batches):
        schema = pa.schema([("id", pa.int64()), ("v", pa.int64())])
        x = unpack(batches, _DIGIT)
        known, x = x[x["kind"] == KNOWN], x[x["kind"] != KNOWN]
        x = x[np.argsort(x["value"], kind="stable")]
        start = _runs(x["value"]) if len(x) else np.zeros(0, np.int64)
        size = np.diff(np.append(start, len(x)))
        x = x[np.repeat(size > 1, size) & (x["kind"] == QUERY)]
        out = np.concatenate([known, x])
        for s in range(0, len(out), 100_000):
            yield batch(schema, out["id"][s : s + 100_000], out["value"][s : s + 100_000].astype(np.int64))

    found = by_part(docs.mapInArrow(digits, PACKED), n).mapInArrow(repeated_digits, "id long, v long")
    wanted = found.groupBy("id").agg(F.collect_set("v").alias("vs"))
    # The small side is hashed; the texts are shuffled once and not sorted.
    left = docs.join(wanted.hint("shuffle_hash"), "id").select("id", "text", "vs")

    @tidy
    def windows(batches):
        for x in batches:
            ids = x.column("id").to_numpy()
            vs = x.column("vs")
            bound, vs = vs.offsets.to_numpy(), vs.values.to_numpy().view(np.uint64)
            for i, j, h, first, *_ in K.word_hashes(x.column("text")):
                if len(h) < depth:
                    continue
                row, pos, ok, digit, low = _windows(h, first, depth)
                salt = K.seeded(3, j - i)
                members = np.sort(K.mix(vs[bound[i] : bound[j]] ^ np.repeat(salt, np.diff(bound[i : j + 1]))))
                at = np.flatnonzero(ok)
                key = K.mix(low[at] ^ salt[row[at]])
                at = at[members[np.minimum(np.searchsorted(members, key), len(members) - 1)] == key]
                if not len(at):
                    continue
                d1, d2, own = digit[at], digit[at + half], ids[i + row[at]]
                order = np.lexsort((pos[at], own, d2, d1))
                d1, d2, own, place = d1[order], d2[order], own[order], pos[at][order]
                start = _runs(d1, d2)
                size = np.diff(np.append(start, len(d1)))
                record = np.zeros(len(start), _WINDOW)  # the first of each group stands for the batch
                record["d1"], record["d2"], record["id"], record["pos"] = d1[start], d2[start], own[start], place[start]
                record["kind"] = np.where(size > 1, WITNESS, QUERY)
                later = np.ones(len(d1), bool)
                later[start] = False
                own, place = own[later], place[later]
                order = np.lexsort((place, own))
                own, place = own[order], place[order]
                run = _runs(own, place - np.arange(len(place))) if len(own) else np.zeros(0, np.int64)
                known = np.zeros(len(run), _WINDOW)
                known["id"], known["pos"], known["d1"], known["kind"] = own[run], place[run], np.diff(np.append(run, len(own))), KNOWN
                record = np.concatenate([record, known])
                route = np.where(record["kind"] == KNOWN, K.mix(record["id"].astype(np.uint64)), record["d1"] >> np.uint64(32))
                yield from packed_batches((route % np.uint64(n)).astype(np.int64), record, n)

    @tidy
    def groups(batches):
        x = unpack(batches, _WINDOW)
        known, x = x[x["kind"] == KNOWN], x[x["kind"] != KNOWN]
        x = x[np.argsort(x["d1"], kind="stable")]  # pass 1: first digit
        start = _runs(x["d1"]) if len(x) else np.zeros(0, np.int64)
        size = np.diff(np.append(start, len(x)))
        x = x[np.repeat(size > 1, size) | (x["kind"] == WITNESS)]
        x = x[np.lexsort((x["pos"], x["id"], x["d2"], x["d1"]))]  # pass 2: second digit, within groups
        start = _runs(x["d1"], x["d2"]) if len(x) else np.zeros(0, np.int64)
        size = np.diff(np.append(start, len(x)))
        first = np.zeros(len(x), bool)
        first[start] = True
        keep = np.repeat(size > 1, size) | (x["kind"] == WITNESS)
        x, first = x[keep], first[keep]
        out = np.zeros(len(x) + len(known), _SPAN)
        out["id"], out["pos"] = np.append(x["id"], known["id"]), np.append(x["pos"], known["pos"])
        out["n"], out["first"] = np.append(np.ones(len(x), np.uint64), known["d1"]), np.append(first, np.zeros(len(known), bool))
        if len(out):
            yield from packed_batches((K.mix(out["id"].astype(np.uint64)) % np.uint64(n)).astype(np.int64), out, n)

    @tidy
    def spans(batches):
        schema = pa.schema([(k, pa.int64()) for k in ("id", "start_token", "end_token", "n_windows", "n_first")])
        x = unpack(batches, _SPAN)
        if len(x):
            x = x[np.lexsort((x["pos"], x["id"]))]
            pos, end = x["pos"].astype(np.int64), x["pos"].astype(np.int64) + x["n"] + depth - 1
            reach = K.running_max(end, x["id"])
            new = np.ones(len(x), bool)
            new[1:] = (x["id"][1:] != x["id"][:-1]) | (pos[1:] >= reach[:-1])
            at = np.flatnonzero(new)
            last = np.append(at[1:], len(x)) - 1
            yield batch(schema, x["id"][at], pos[at], reach[last], np.add.reduceat(x["n"].astype(np.int64), at), np.add.reduceat(x["first"].astype(np.int64), at))

    sorted_windows = by_part(left.mapInArrow(windows, PACKED), n).mapInArrow(groups, PACKED)
    return named(by_part(sorted_windows, n).mapInArrow(spans, "id long, start_token long, end_token long, n_windows long, n_first long"), df, id_col, "id")
