"""Text functions as column expressions; the few that need a scan of code points are Arrow UDFs."""

from __future__ import annotations

import ctypes
import difflib
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from . import bound

#: White space as Python's \s has it; Java's \s is ASCII alone.
WHITE = "\\s\\x1c-\\x1f\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: Tsheg, shad and white space part tokens.
TOKEN_BREAKS = f"[{chr(0xF0B)}{chr(0xF0D)}{WHITE}]+"
#: Marks that end a syllable: tshegs, space, shads, visarga, head marks, brackets.
SYLLABLE_MARKS = "".join(map(chr, (0xF0B, 0xF0C, 0x20, 0xF0D, 0xF34, 0xF7F, 0xFD2, 0xF3C, 0xF3D, 0xFD9, 0xFDA, 0xF14)))


def replaced(c: Column, pairs: list[tuple[str, str]]) -> Column:
    """Literal replacements, one after the other: order matters."""
    for old, new in pairs:
        c = F.replace(c, F.lit(old), F.lit(new))
    return c


def _parts(point: int) -> str:
    """The full canonical or discouraged decomposition of a code point, '' if it has none."""
    whole = unicodedata.normalize("NFKD", chr(point))
    return "" if whole == chr(point) else whole


#: Vowel signs that Unicode discourages, against their parts.
VOWELS = [(chr(p), _parts(p)) for p in (0xF73, 0xF75, 0xF77, 0xF79, 0xF81)]
#: Letters against letter and subjoined letter, from the Unicode database.
LETTERS = [(chr(p), _parts(p)) for p in (0xF43, 0xF4D, 0xF52, 0xF57, 0xF5C, 0xF69, 0xF76, 0xF78, 0xF93, 0xF9D, 0xFA2, 0xFA7, 0xFAC, 0xFB9)]
#: Two code points that Unicode leaves free, which texts use as the aspirates of ja.
FREE = [(chr(p), chr(p - 1) + chr(0xFB7)) for p in (0xF48, 0xF98)]
#: The syllable om, and the affricates that are written with a flag.
FIXED = [(chr(0xF00), chr(0xF68) + chr(0xF7C) + chr(0xF7E)), *((chr(p) + chr(0xF39), chr(p + 0x14)) for p in (0xF45, 0xF46, 0xF47))]


def unify(c: Column, composed: bool = False) -> Column:
    """One spelling for what Unicode spells in several ways: letters in parts, or ``composed``."""
    letters = [(b, a) for a, b in LETTERS] if composed else LETTERS + FREE
    return replaced(c, VOWELS + letters + FIXED)


#: Place in a cluster by code point: 1 is the base that begins it; marks follow as subjoined, below (vowel, mark), above (vowel, mark), right. 0 is no part of one.
_RANGES = {
    1: [(0xF01, 0xF01), (0xF20, 0xF33), (0xF40, 0xF6C), (0xF88, 0xF8A), (0xF8C, 0xF8C)],
    2: [(0xF39, 0xF39), (0xF8D, 0xFBC)],
    3: [(0xF18, 0xF19), (0xF71, 0xF71), (0xF74, 0xF75)],
    4: [(0xF35, 0xF35), (0xF37, 0xF37), (0xF84, 0xF84)],
    5: [(0xF72, 0xF73), (0xF76, 0xF7D), (0xF80, 0xF81)],
    6: [(0xF7E, 0xF7E), (0xF82, 0xF83), (0xF86, 0xF87)],
    7: [(0xF3E, 0xF3E), (0xF7F, 0xF7F)],
}
RANK = {chr(p): r for r, spans in _RANGES.items() for a, b in spans for p in range(a, b + 1)}
_BASES, _MARKS = "".join(c for c, r in RANK.items() if r == 1), "".join(c for c, r in RANK.items() if r > 1)
_CLUSTER = re.compile(f"(?<=[{_BASES}])[{_MARKS}]{{2,}}")


def reorder_marks(text: str) -> str:
    """Sorts the marks after each base by their place, stably; marks without a base stay as they are."""
    return _CLUSTER.sub(lambda m: "".join(sorted(m[0], key=RANK.__getitem__)), text)


def slices(texts: pa.Array, size: int = 1 << 20) -> Iterator[pa.Array]:
    """An array of texts in pieces of so many bytes, one text at least: what becomes Python objects at once doesn't follow the batch. Memory goes back to the system at the end,
    as workers wait for more work with what they have."""
    ends, at = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)), 0
    while at < len(texts):
        end = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + size, side="right")))
        yield texts.slice(at, end - at)
        at = end
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc's
        trim(0)


@F.arrow_udf(StringType())
def reordered(texts: pa.Array) -> pa.Array:
    parts = [pa.array([t if t is None else reorder_marks(t) for t in part.to_pylist()], pa.string()) for part in slices(texts)]
    return pa.concat_arrays(parts or [pa.array([], pa.string())])


def _class(*spans: tuple[int, int]) -> str:
    """The inside of a character class."""
    return "".join(chr(a) if a == b else f"{chr(a)}-{chr(b)}" for a, b in spans)


#: Letters below which a full ra keeps its shape; what goes on with a stack; vowel signs; subjoined letters.
_UNDER_RA = _class((0xF90, 0xF97), (0xF9A, 0xFAC), (0xFAE, 0xFAF), (0xFB4, 0xFBC))
_STACKED = _class((0xF8D, 0xFAC), (0xFAE, 0xFAE), (0xFB0, 0xFB0), (0xFB3, 0xFBC))
_VOWEL, _BELOW = _class((0xF71, 0xF84)), _class((0xF90, 0xFBC))


def short_ra(c: Column) -> Column:
    """The fixed-form ra becomes a plain one where no such letter is below it."""
    return F.regexp_replace(c, f"{chr(0xF6A)}(?![{_UNDER_RA}])", chr(0xF62))


def repair_start(c: Column) -> Column:
    """A text of two characters or more can't begin with a vowel sign, which changes place with a next that is neither vowel nor subjoined, nor with a subjoined letter, which goes."""
    swapped = F.regexp_replace(c, f"(?s)^([{_VOWEL}])([^{_VOWEL}{_BELOW}])", "$2$1")
    return F.when(c.rlike(f"^[{_VOWEL}]"), swapped).otherwise(F.regexp_replace(c, f"(?s)^[{_BELOW}](?=.)", ""))


def graphical_fold(c: Column) -> Column:
    """What looks alike becomes alike: one tsheg, two shads for the double shad, one digit seven, doubled vowel signs, a head mark in parts, and the
    long-a sign against the subjoined one by whether the stack goes on."""
    tsheg, shad = chr(0xF0B), chr(0xF0D)
    c = replaced(c, [(chr(0xF0C), tsheg), (chr(0xF0E), shad * 2), (chr(0xF38), chr(0xF27)), *((chr(p) * 2, chr(p + 1)) for p in (0xF7A, 0xF7C)), (chr(0xF07), f"{chr(0xFD3)}{shad}{chr(0xFD2)}{shad}")])
    long_a, below = chr(0xF71), chr(0xFB0)
    c = F.regexp_replace(c, f"{long_a}([{_STACKED}])", f"{below}$1")
    return F.regexp_replace(c, f"{below}([^{_STACKED}]|$)", f"{long_a}$1")


def canonical(c: Column) -> Column:
    """The whole normalisation; null and empty give ''."""
    return F.coalesce(graphical_fold(repair_start(short_ra(reordered(unify(c))))), F.lit(""))


def tokens(c: Column) -> Column:
    return F.filter(F.split(c, TOKEN_BREAKS), lambda t: t != "")


def repetition_score(toks: Column, n: int = 20) -> Column:
    """1 - distinct runs of n tokens / runs; 0 below n tokens. Tokens count as 64-bit hashes and so do runs, so that a run costs eight bytes."""

    def score(hashed):
        total = F.size(hashed) - (n - 1)
        runs = F.transform(F.sequence(F.lit(1), F.greatest(total, F.lit(1))), lambda i: F.xxhash64(F.slice(hashed, i, n)))
        return F.when(total < 1, 0.0).otherwise(1 - F.size(F.array_distinct(runs)) / total)

    return bound(F.transform(toks, lambda t: F.xxhash64(t)), score)


_TOKEN = re.compile(f"[^{chr(0xF0B)}{chr(0xF0D)}\\s]+")
_REPETITION = StructType([StructField("n", LongType()), StructField("score", DoubleType())])


def distinct_runs(tokens: list[str], n: int) -> int:
    """Distinct runs of n tokens, by 64-bit hashes: a run of 2k tokens from two of k, so its cost doesn't grow with n."""
    own = np.fromiter(map(hash, tokens), np.int64, len(tokens)).view(np.uint64)
    k, left, at, acc = 1, n, 0, np.zeros(len(own), np.uint64)
    while True:
        if left & 1:
            m = len(own) - at if at < len(own) else 0
            acc = acc[:m] * np.uint64(0x9E3779B97F4A7C15 + 2 * k) + own[at : at + m]
            acc ^= acc >> np.uint64(29)
            at += k
        left >>= 1
        if not left:
            return len(np.unique(acc[: len(tokens) - n + 1]))
        own = own[:-k] * np.uint64(0xFF51AFD7ED558CCD + 2 * k) + own[k:]
        own ^= own >> np.uint64(31)
        k *= 2


@F.arrow_udf(_REPETITION)
def repetition(texts: pa.Array) -> pa.Array:
    """(tokens, repetition score of runs of 20) of texts, which cross to Python once: there a scan costs a fourth of what it does over arrays in the JVM. Null counts as empty."""
    counts, scores = [], []
    for part in slices(texts):
        for t in part:
            tokens = _TOKEN.findall(t.as_py() or "")
            runs = len(tokens) - 19
            counts.append(len(tokens))
            scores.append(1 - distinct_runs(tokens, 20) / runs if runs > 0 else 0.0)
    return pa.StructArray.from_arrays([pa.array(counts, pa.int64()), pa.array(scores, pa.float64())], ["n", "score"])


def syllables(c: Column, marks: str = SYLLABLE_MARKS) -> Column:
    """Pieces, each with the marks that follow it. Marks at the start go behind the first character, which they part from the rest of its syllable;
    a text of marks alone is one piece."""
    own = "".join(re.escape(m) for m in marks)
    moved = F.regexp_replace(c, f"(?s)^([{own}]+)([^{own}])", "$2$1")
    return F.regexp_extract_all(moved, F.lit(f"([^{own}]+[{own}]*|^[{own}]+$)"), 1)


def script_lines(c: Column) -> Column:
    """Lines with a character of the block U+0F00 to U+0FFF."""
    return F.size(F.filter(F.split(c, "\n"), lambda t: t.rlike("[ༀ-࿿]")))


def shortened(c: Column, limit: int = 512) -> Column:
    """One line of at most ``limit`` characters; the last is an ellipsis where some are cut. Null stays null."""
    t = stripped(F.regexp_replace(c, "\n", " "))
    return F.when(F.length(t) > limit, F.concat(F.substring(t, 1, limit - 1), F.lit("…"))).otherwise(t)


def stripped(c: Column) -> Column:
    """Without white space at either end."""
    return F.regexp_replace(c, f"^[{WHITE}]+|[{WHITE}]+$", "")


def parsed_error(c: Column) -> Column:
    """(stage, type, message) of ``[Stage] Type: Message``. Without a colon after the stage the type is '' and the rest is the message; without a stage both are ''."""
    staged = c.startswith("[") & c.contains("]")
    at = F.when(staged, F.instr(c, "]"))
    rest = stripped(c.substr(at + 1, F.length(c)))
    colon = F.instr(rest, ":")
    part = lambda a, b: F.when(~staged, a).when(colon > 0, b).otherwise
    kind = part(F.lit(""), stripped(rest.substr(F.lit(1), colon - 1)))(F.lit(""))
    message = part(c, stripped(rest.substr(colon + 1, F.length(rest))))(rest)
    return F.struct(F.when(staged, c.substr(F.lit(2), at - 2)).otherwise("").alias("stage"), kind.alias("type"), message.alias("message"))


def failure_class(kind: Column, message: Column) -> Column:
    """(retryable, reason) of an error that a job let through, by the name of its type: only one raised as terminal isn't tried again."""
    reason = F.when(kind.isin("TerminalTaskError", "RetryableTaskError"), message).when(kind == "VolumeTimeoutError", F.concat(F.lit("Volume timeout: "), message)).otherwise(F.concat(kind, F.lit(": "), message))
    return F.struct((kind != "TerminalTaskError").alias("retryable"), reason.alias("reason"))


def pipeline_failure_class(kind: Column, message: Column) -> Column:
    """(retryable, reason) as a page pipeline sorts its own errors: what isn't there is terminal, all else may pass."""
    label = lambda text: F.concat(F.lit(f"{text}: "), message)
    memory = message.contains("CUDA out of memory") | message.contains("OOM")
    gone = kind.contains("NotFound") | message.contains("404")
    reason = F.when(kind == "VolumeTimeoutError", label("Volume timeout")).when(memory, label("GPU OOM error")).when(gone, label("Resource not found")).otherwise(F.concat(F.lit("Pipeline error ("), kind, F.lit("): "), message))
    return F.struct((~gone | memory | (kind == "VolumeTimeoutError")).alias("retryable"), reason.alias("reason"))


def lane(c: Column) -> Column:
    """(lane, media type) of a file by its extension: multi-page formats go the lane of files, all others that of images."""
    ext = F.when(c.contains("."), F.lower(F.substring_index(c, ".", -1))).otherwise("")
    tiff = ext.isin("tif", "tiff")
    media = F.when(tiff, "image/tiff").when(ext.isin("jpg", "jpeg"), "image/jpeg").when(ext == "", "application/octet-stream").otherwise(F.concat(F.lit("image/"), ext))
    return F.struct(F.when(tiff, "files").otherwise("images").alias("lane"), media.alias("media_type"))


def plain_etag(c: Column) -> Column:
    """An entity tag without one pair of quotes around it."""
    return F.when(c.rlike('(?s)^".*"$'), c.substr(F.lit(2), F.length(c) - 2)).otherwise(c)


def etag_bytes(c: Column) -> Column:
    """The 16 bytes of an entity tag without quotes and part count. Any other tag is an error; null stays null."""
    plain = F.substring_index(F.regexp_replace(c, '^"+|"+$', ""), "-", 1)
    return F.when(plain.rlike("^[0-9A-Fa-f]{32}$"), F.unhex(plain)).when(c.isNotNull(), F.raise_error(F.concat(F.lit("not the 16 bytes of an entity tag: "), c)).cast("binary"))


def version_of(etag: Column) -> Column:
    """The version of an artifact: the first six digits of the tag."""
    return F.substring(F.substring_index(F.replace(etag, F.lit('"'), F.lit("")), "-", 1), 1, 6)


def artifact_name(c: Column) -> Column:
    """(w_id, i_id) of a path that ends in W…-I…-version.parquet, null otherwise."""
    pattern = r"(?:^|/)(W[0-9A-Za-z_]+)-(I[0-9A-Za-z_]+)-[0-9A-Za-z]+\.parquet$"
    return F.when(c.rlike(pattern), F.struct(F.regexp_extract(c, pattern, 1).alias("w_id"), F.regexp_extract(c, pattern, 2).alias("i_id")))


def uri_parts(c: Column) -> Column:
    """(scheme, bucket, key) of an s3 or gs address, (scheme, '', path) of a file. One without bucket, key or path is an error, and so is another scheme."""
    scheme = F.regexp_extract(c, "^([a-z0-9]+):", 1)
    remote = scheme.isin("s3", "gs")
    bucket = F.when(remote, F.regexp_extract(c, "^[a-z0-9]+://([^/]*)", 1)).otherwise("")
    file = F.url_decode(F.replace(F.regexp_extract(c, "^file:(?://[^/]*)?(/[^?#]*)", 1), F.lit("+"), F.lit("%2B")))
    key = F.when(scheme == "s3", F.regexp_extract(c, "^s3://[^/]*/+([^?#]*)", 1)).when(scheme == "gs", F.regexp_extract(c, "^gs://[^/]+/(.+)$", 1)).otherwise(file)
    sound = scheme.isin("s3", "gs", "file") & (key != "") & (~remote | (bucket != ""))
    checked = F.when(sound, scheme).when(c.isNotNull(), F.raise_error(F.concat(F.lit("no s3, gs or file address: "), c)).cast("string"))
    return F.struct(checked.alias("scheme"), bucket.alias("bucket"), key.alias("key"))


def joined_uri(base: Column, name: Column) -> Column:
    """A file below an address; a plain absolute path becomes a file address."""
    cut = F.regexp_replace(base, "/+$", "")
    return F.concat(F.when(cut.rlike("^(s3|gs|file)://"), cut).otherwise(F.concat(F.lit("file://"), cut)), F.lit("/"), name)


def folder_prefix(w: Column, i: Column) -> Column:
    """Where the images of a volume lie; the I of i goes only before exactly four digits."""
    suffix = F.when(i.rlike("^I[0-9]{4}$"), i.substr(F.lit(2), F.lit(4))).otherwise(i)
    return F.concat(F.lit("Works/"), F.substring(F.md5(w.cast("binary")), 1, 2), F.lit("/"), w, F.lit("/images/"), w, F.lit("-"), suffix, F.lit("/"))


def safe_id(c: Column) -> Column:
    """Letters and digits of any script, dot, underscore and hyphen, at most 200; 'page' where none is left."""
    t = F.substring(F.regexp_replace(c, r"[^\p{L}\p{N}._-]", "_"), 1, 200)
    return F.when(F.coalesce(t, F.lit("")) == "", "page").otherwise(t)


def embedded_json(message: Column, mark: str = "Diagnostic:") -> Column:
    """The JSON text behind a mark in a message, null if it isn't there or isn't JSON."""
    text = stripped(message.substr(F.instr(message, mark) + len(mark), F.length(message)))
    return F.when(message.contains(mark) & F.try_parse_json(text).isNotNull(), text)


def differing(a: str, b: str) -> list[tuple[str, str, str]]:
    """(kind, text before, text after) of the spans that differ, with the runs that are equal left out."""
    ops = difflib.SequenceMatcher(None, a, b).get_opcodes()
    return [(kind, a[i:j], b[k:m]) for kind, i, j, k, m in ops if kind != "equal"]


@F.pandas_udf(LongType())
def differing_chars(a: pd.Series, b: pd.Series) -> pd.Series:
    """Characters in unequal spans, the longer side of each."""
    return pd.Series([sum(max(len(p), len(q)) for _, p, q in differing(x or "", y or "")) for x, y in zip(a, b)])
