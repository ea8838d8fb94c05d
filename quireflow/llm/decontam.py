"""Benchmark decontamination: documents with a passage within a word edit distance of a benchmark item.

Texts and items are folded words (case and ASCII punctuation don't count). An item of m words allows
k = min(rate * m, (m - 3) / 3) edits. Items are sorted into classes of about one length, and all is done in one pass over the texts with no shuffle:

1. Places. By the q-gram lemma a passage within k edits of an item shares m - 2 - 3k of its word trigrams at least. A window of a class begins only where
   enough trigrams of any items of the class follow. This names no item, costs a lookup a word, and loses nothing.
2. CGK and bit sampling. A window and an item are embedded by the same random walk: at step j the word under the pointer is put out, and a random
   bit of (j, word) says whether the pointer moves. Walks over strings within k edits meet again after few steps, so edit distance turns
   into Hamming distance. A table has a walk of its own and samples ``bits`` of its steps; the items of a class are sorted by what is sampled, and a window is
   joined with those it agrees with. The number of tables comes from the target recall (``tables_for``).
3. Verification. What the join finds must share enough trigrams with its item, then the edit distance of the item and the best passage that begins at the window
   is computed exactly (dynamic programme). Where a window matches, those that begin up to 2k words around it are verified too, so the passage found is the nearest there.

The items are folded on the executors and broadcast in parts of ``part_words`` words, one scan of the texts per part, so neither a worker's nor the driver's memory follows the benchmark.
"""

from __future__ import annotations

import functools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .common import batch, filter_rows, id_text, named, tidy

RATE, RECALL, BITS, PART_WORDS, SEED = 0.2, 0.97, 2, 2_000_000, 17
_OUT = pa.schema([(k, pa.int64()) for k in ("id", "item_id", "start_token", "n_tokens", "edits")])


def allowed(m: int | np.ndarray, rate: float = RATE):
    """The edits that an item of m words allows; items of fewer than 3 words match only as they are."""
    return np.maximum(0, np.minimum((rate * m).astype(np.int64) if isinstance(m, np.ndarray) else int(rate * m), (m - 3) // 3))


def tables_for(recall: float, bits: int = BITS, agree: float = 0.5) -> int:
    """Tables that let a pair meet with this probability, if a sampled step agrees with probability ``agree``, that of the farthest pairs."""
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - agree**bits)))


def fold(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of the folded words, first word of each row and their number)."""
    hs, firsts, n = [np.zeros(0, np.uint64)], [np.zeros(1, np.int64)], 0
    for _, _, h, first, *_ in K.word_hashes(column, fold=True):
        hs.append(h)
        firsts.append(first[1:] + n)
        n += len(h)
    return np.concatenate(hs), np.concatenate(firsts)


def edits(a: np.ndarray, b: np.ndarray, k: int) -> tuple[int, int]:
    """(least edit distance of a and a prefix of b, length of the prefix: the nearest to a's, the shorter of two), (k + 1, 0) beyond k."""
    m, n = len(a), min(len(b), len(a) + k)
    row = np.arange(n + 1)
    for i in range(1, m + 1):
        new = np.empty(n + 1, np.int64)
        new[0] = i
        new[1:] = np.minimum(row[1:] + 1, row[:-1] + (b[:n] != a[i - 1]))
        row = np.minimum.accumulate(new - np.arange(n + 1)) + np.arange(n + 1)
        if row.min() > k:
            return k + 1, 0
    best = int(row.min())
    if best > k:
        return k + 1, 0
    at = np.flatnonzero(row == best)
    return best, int(at[np.lexsort((at, np.abs(at - m)))[0]])


@functools.lru_cache(maxsize=64)
def sampled(m: int, table: int, bits: int) -> tuple[int, ...]:
    """The steps that a table samples for items of at least m words. A walk takes about two steps a word; those sampled seldom reach beyond the shortest item."""
    steps = max(1, int(1.4 * m) if m >= 6 else m)
    return tuple(sorted((K.seeded(SEED * 1009 + table * 64 + min(m, 63), bits) % np.uint64(steps)).astype(int).tolist()))


def sketch(words: np.ndarray, start: np.ndarray, end: np.ndarray, steps: tuple[int, ...], seed: int) -> np.ndarray:
    """One 64-bit value for each word range: the words that the walk of this seed puts out at these steps."""
    at, key, last = start.copy(), np.zeros(len(start), np.uint64), len(words) - 1
    salt = K.seeded(seed, steps[-1] + 1)
    want = set(steps)
    for j in range(steps[-1] + 1):
        w = np.where(at < end, words[np.minimum(at, last)], np.uint64(0))
        if j in want:
            key = K.mix(key * K.GOLD + w + np.uint64(1))
        at += (K.mix(w ^ salt[j]) & np.uint64(1)).astype(np.int64)
    return key


class Index:
    """The items of a part by classes of length: their trigrams, and in each table what their walks put out at the sampled steps."""

    def __init__(self, ids: np.ndarray, words: np.ndarray, first: np.ndarray, rate: float, bits: int, tables: int):
        self.ids, self.words, self.first, self.bits, self.tables = ids, words, first, bits, tables
        self.m = np.diff(first)
        self.k = allowed(self.m, rate)
        self.q = np.minimum(3, self.m)
        self.need = np.maximum(1, self.m - self.q + 1 - self.q * self.k)
        bounds = [1, 2, 3, 4, 5, 6]
        while bounds[-1] <= self.m.max(initial=0):
            bounds.append(int(bounds[-1] * 1.5))
        row = K.rows_of(first)
        self.classes, own = [], []
        for lo, hi in zip(bounds, bounds[1:]):
            items = np.flatnonzero((self.m >= lo) & (self.m < hi))
            if not len(items):
                continue
            q = min(3, lo)
            at = np.flatnonzero(np.isin(row, items) & (np.arange(len(words)) + q <= first[1:][row]))
            gram = K.grams(words, q)[at]
            own.append(K.mix(gram ^ K.mix(row[at].astype(np.uint64) + np.uint64(1))))  # which grams an item has
            known = np.unique(gram)
            top = np.zeros(1 << 16, bool)  # a table of the top bits turns most places away
            top[known >> np.uint64(48)] = True
            buckets = []
            for t in range(tables):
                steps = sampled(lo, t, bits)
                key = sketch(words, first[items], first[items + 1], steps, SEED + t)
                order = np.argsort(key, kind="stable")
                buckets.append((steps, key[order], items[order]))
            longest = int((self.m + self.k)[items].max())
            self.classes.append((lo, q, known, top, longest, int(self.need[items].min()), lo if hi == lo + 1 else None, buckets))
        self.own = np.unique(np.concatenate(own)) if own else np.zeros(1, np.uint64)

    def starts(self, gram: np.ndarray, first: np.ndarray, row: np.ndarray, q: int, known: np.ndarray, top: np.ndarray, longest: int, need: int) -> np.ndarray:
        """The places where a window of a class may begin."""
        at = np.flatnonzero(top[gram >> np.uint64(48)])
        at = at[known[np.minimum(np.searchsorted(known, gram[at]), len(known) - 1)] == gram[at]]
        at = at[at + q <= first[1:][row[at]]]
        if len(at) < need:
            return np.zeros(0, np.int64)
        # The need-th hit from each hit on, in the same row and near enough, tells that windows from before the first hit to it hold enough.
        other = np.arange(len(at)) + need - 1
        ok = other < len(at)
        a, b = at[ok], at[other[ok]]
        ok = (row[a] == row[b]) & (b + q - a <= longest)
        a, b = a[ok], b[ok]
        low = np.maximum(b + q - longest, first[row[a]])
        if not len(a):
            return np.zeros(0, np.int64)
        mark = np.zeros(len(gram) + 1, np.int64)
        np.add.at(mark, low, 1)
        np.add.at(mark, a + 1, -1)
        return np.flatnonzero(np.cumsum(mark[:-1]) > 0)

    def joined(self, h: np.ndarray, first: np.ndarray) -> np.ndarray:
        """(row, item, start), each once, of the windows that meet an item in some table and share enough trigrams with it."""
        row, out, grams = K.rows_of(first), [], {}
        for _, q, known, top, longest, need, exact, buckets in self.classes:
            if len(h) < q:
                continue
            if q not in grams:
                grams[q] = K.grams(h, q)
            start = self.starts(grams[q], first, row, q, known, top, longest, need)
            if not len(start):
                continue
            end = first[1:][row[start]]
            if exact:
                end = np.minimum(end, start + exact)
            found = []
            for t, (steps, key, items) in enumerate(buckets):
                own = sketch(h, start, end, steps, SEED + t)
                lo, hi = np.searchsorted(key, own, "left"), np.searchsorted(key, own, "right")
                n = hi - lo
                which = np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                found.append(np.stack([items[which], np.repeat(start, n)], axis=1))
            pairs = np.unique(np.concatenate(found), axis=0)
            out.append(self._sharing(pairs, grams[q], first, row, q))
        pairs = np.concatenate(out) if out else np.zeros((0, 2), np.int64)
        return np.stack([row[pairs[:, 1]], pairs[:, 0], pairs[:, 1]], axis=1) if len(pairs) else np.zeros((0, 3), np.int64)

    def _sharing(self, pairs: np.ndarray, gram: np.ndarray, first: np.ndarray, row: np.ndarray, q: int) -> np.ndarray:
        """The pairs of (item, start) that share as many trigrams as they must."""
        kept = []
        for s in range(0, len(pairs), 20_000):
            part = pairs[s : s + 20_000]
            item, start = part[:, 0], part[:, 1]
            n = np.maximum(np.minimum(first[1:][row[start]], start + self.m[item] + self.k[item]) - start - q + 1, 0)
            who = np.repeat(np.arange(len(part)), n)
            at = start[who] + np.arange(len(who)) - np.repeat(np.cumsum(n) - n, n)
            key = K.mix(gram[at] ^ K.mix(item[who].astype(np.uint64) + np.uint64(1)))
            hit = self.own[np.minimum(np.searchsorted(self.own, key), len(self.own) - 1)] == key
            kept.append(part[np.bincount(who[hit], minlength=len(part)) >= self.need[item]])
        return np.concatenate(kept) if kept else pairs

    def search(self, h: np.ndarray, first: np.ndarray) -> list[tuple[int, int, int, int, int]]:
        """(row, item, start, words, edits) of the nearest passage of each row and item, the first and shortest of equals."""
        starts: dict[tuple[int, int], list[int]] = {}
        for row, item, s in self.joined(h, first).tolist():
            starts.setdefault((row, item), []).append(s)
        out = []
        for (row, item), own in starts.items():
            a, b, k = int(first[row]), int(first[row + 1]), int(self.k[item])
            words, seen = self.words[self.first[item] : self.first[item + 1]], {}

            def look(s, words=words, seen=seen, b=b, k=k):
                if s not in seen:
                    seen[s] = edits(words, h[s : min(b, s + len(words) + k)], k)
                return seen[s]

            for s in own:
                d, n = look(s)
                if 0 < d <= k and n:  # the nearest passage begins close by
                    for near in range(max(a, s - 2 * k), min(b, s + 2 * k + 1)):
                        look(near)
            best = min(((d, s - a, n) for s, (d, n) in seen.items() if d <= k and n), default=None)
            if best:
                out.append((row, item, best[1], best[2], best[0]))
        return sorted(out)


@functools.lru_cache(maxsize=2)
def _index(ids: bytes, words: bytes, first: bytes, rate: float, bits: int, tables: int) -> Index:
    return Index(np.frombuffer(ids, np.int64), np.frombuffer(words, np.uint64), np.frombuffer(first, np.int64), rate, bits, tables)


def _parts(benchmark: DataFrame, item_col: str, text_col: str, part_words: int):
    """The items in parts of about ``part_words`` words: folded by tasks, read by the driver one partition at a time."""
    items = id_text(benchmark, item_col, text_col).where("text is not null").distinct().orderBy("id", "text")
    schema = pa.schema([("id", pa.int64()), ("words", pa.binary())])

    def folded(batches):
        for x in batches:
            h, first = fold(x.column("text"))
            yield batch(schema, x.column("id"), [h[a:b].tobytes() for a, b in zip(first[:-1], first[1:])])

    ids, words, n = [], [], 0
    for r in items.mapInArrow(folded, "id long, words binary").where("length(words) > 0").toLocalIterator():
        ids.append(r.id)
        words.append(np.frombuffer(r.words, np.uint64))
        n += len(words[-1])
        if n >= part_words:
            yield np.array(ids, np.int64), words
            ids, words, n = [], [], 0
    if ids:
        yield np.array(ids, np.int64), words


def contaminated(df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", rate: float = RATE, recall: float = RECALL, bits: int = BITS, part_words: int = PART_WORDS) -> DataFrame:
    """(id, item_id, start_token, n_tokens, edits): a passage of each document and item within the item's edits: the nearest of those that meet it in some table, and of what
    begins around them.

    Ids of documents and items may be of any type. Null and empty texts and items match nothing; rows without an id and items without one are left out. Of rows that
    repeat an id each is searched and the nearest passage counts, the first and shortest of equals; an item id with several texts is matched by each.
    Items of fewer than 6 words match word for word: an item of one word flags every document that holds the word. Empty tables give no rows; other columns are ignored. Whole texts are searched.
    """
    docs, tables, out = id_text(df, id_col, text_col), tables_for(recall, bits), None
    for ids, words in _parts(benchmark, item_col, item_text, part_words):
        packed = ids.tobytes(), np.concatenate(words).tobytes(), np.cumsum([0] + [len(w) for w in words]).astype(np.int64).tobytes()
        sent = df.sparkSession.sparkContext.broadcast(packed)

        @tidy
        def search(batches, sent=sent):
            index = _index(*sent.value, rate, bits, tables)
            for x in batches:
                doc = x.column("id").to_numpy()
                for i, _, h, first, *_ in K.word_hashes(x.column("text"), fold=True):
                    found = index.search(h, first)
                    if found:
                        row, item, start, n, d = np.array(found, np.int64).T
                        yield batch(_OUT, doc[i + row], index.ids[item], start, n, d)

        found = docs.mapInArrow(search, "id long, item_id long, start_token long, n_tokens long, edits long")
        out = found if out is None else out.union(found)
    if out is None:
        none = df.sparkSession.createDataFrame([], "id long, item_id long, start_token long, n_tokens long, edits long")
        return none.select(*[none[c].cast(kind).alias(c) for c, kind in (("id", df.schema[id_col].dataType), ("item_id", benchmark.schema[item_col].dataType))], "start_token", "n_tokens", "edits")
    best = F.min(F.struct("edits", "start_token", "n_tokens")).alias("b")
    found = out.groupBy("id", "item_id").agg(best).select("id", "item_id", "b.start_token", "b.n_tokens", "b.edits")
    return named(named(found, df, id_col, "id"), benchmark, item_col, "item_id")


def brute(text: str, item: str, rate: float = RATE) -> int | None:
    """The least edit distance of the item to any passage of the text, None beyond the item's edits: a plain dynamic programme."""
    a, b = (fold(pa.array([x]))[0].tolist() for x in (item, text))
    k, row = int(allowed(len(a), rate)), [0] * (len(b) + 1)
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    best = min(row[1:], default=k + 1)
    return best if a and best <= k else None


def drop_contaminated(df: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text: str = "text", rate: float = RATE, recall: float = RECALL, bits: int = BITS, part_words: int = PART_WORDS) -> DataFrame:
    """The rows of ``df`` whose text holds no passage of the benchmark, in one pass without a join, with all their columns, whatever their names and nulls in them.

    Null and empty texts stay; equal rows stay or go together; an empty table or benchmark leaves all as it is. Whole texts are searched.
    """
    tables = tables_for(recall, bits)
    for ids, words in _parts(benchmark, item_col, item_text, part_words):
        packed = ids.tobytes(), np.concatenate(words).tobytes(), np.cumsum([0] + [len(w) for w in words]).astype(np.int64).tobytes()
        sent = df.sparkSession.sparkContext.broadcast(packed)

        def kept(column, sent=sent):
            index, out = _index(*sent.value, rate, bits, tables), np.ones(len(column), bool)
            for i, _, h, first, *_ in K.word_hashes(column, fold=True):
                for row, *_ in index.search(h, first):
                    out[i + row] = False
            return out

        df = filter_rows(df, text_col, kept)
    return df
