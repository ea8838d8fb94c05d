"""Language identification by compression.

Each language has a zstandard raw-content dictionary: labelled texts of that language, joined up to ``dict_bytes``. A text is
cut into blocks, every block is compressed once per language with that language's dictionary, and the language with the fewest bytes in all wins.
Matches of ``MATCH`` bytes count, about a syllable. A match into the dictionary is cheaper than a literal, so the sizes rank the languages by how much of the text their dictionary
explains. Blocks keep the rank sharp for long texts, whose own repeats would otherwise serve every language alike.

The fit reads labels without the texts, picks ``sample`` documents a language by the hash of their id, and fetches pieces from all over those
texts in one scan. Scoring is one pass over the texts with no shuffle; what each worker holds is the dictionaries,
whose size is languages x ``dict_bytes`` whatever the corpus.
"""

from __future__ import annotations

import functools

import numpy as np
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType

from . import kernels as K
from .common import batch, col, key_of, row_schemas, text_of

DICT_BYTES, SAMPLE, MIN_DOCS, LANGUAGES, PIECE, BLOCK, LEVEL, MATCH, MARGIN, UNKNOWN = 65_536, 48, 3, 256, 256, 4096, 6, 4, 0.02, "und"


def fit(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", dict_bytes: int = DICT_BYTES, sample: int = SAMPLE, min_docs: int = MIN_DOCS, languages: int = LANGUAGES) -> dict[str, bytes]:
    """The dictionary of each language that has at least ``min_docs`` labelled documents.

    ``sample`` documents a language, ``dict_bytes`` bytes of them and the ``languages`` labels with the most documents bound the fit. A text longer than its fair share is
    represented by pieces of ``PIECE`` characters spread evenly over all of it, so every sampled document and every part of it can get in. Null labels, ids and texts
    don't count. Of rows that share an id and a label the one with the least text counts; ids may be of any type.
    """
    labelled = df.select(key_of(df, id_col).alias("id"), col(df, lang_col).cast("string").alias("lang")).where("id is not null and lang is not null")
    most = labelled.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(languages).select("lang")
    first = Window.partitionBy("lang").orderBy(F.xxhash64("id"), "id")
    chosen = labelled.join(F.broadcast(most), "lang").distinct().withColumn("r", F.row_number().over(first)).where(F.col("r") <= sample).select("id", "lang")  # at most sample x languages
    texts = df.select(key_of(df, id_col).alias("id"), col(df, lang_col).cast("string").alias("lang"), col(df, text_col).cast("string").alias("text")).where("lang is not null and text is not null")
    pieces = max(1, 4 * dict_bytes // sample // PIECE)
    step = (F.length("text") - PIECE) / F.lit(max(1, pieces - 1))
    spread = F.transform(F.sequence(F.lit(0), F.lit(pieces - 1)), lambda k: F.substring("text", F.floor(k * step).cast("int") + 1, F.lit(PIECE)))
    parts = F.when(F.length("text") <= pieces * PIECE, F.array("text")).otherwise(spread)
    rows = texts.join(F.broadcast(chosen), ["id", "lang"]).groupBy("lang", "id").agg(F.min("text").alias("text")).select("lang", F.xxhash64("id").alias("h"), parts.alias("parts")).collect()  # bounded by all three
    found: dict[str, list] = {}
    for r in rows:
        found.setdefault(r.lang, []).append((r.h, [K.lowered(np.frombuffer(p.encode(), np.uint8)).tobytes() for p in r.parts]))
    out = {}
    for lang, own in sorted(found.items()):
        if len(own) >= min_docs:
            data = b"\n".join(_fair([parts for _, parts in sorted(own)], dict_bytes))[:dict_bytes]
            if len(data) >= 8:
                out[lang] = data
    return out


def _fair(texts: list[list[bytes]], limit: int) -> list[bytes]:
    """The texts, given in parts, so that all of them take about ``limit`` bytes: none more than the same share, of which long ones give parts from all over."""
    size = [sum(map(len, t)) for t in texts]
    share, left = 0, limit
    for k, n in enumerate(sorted(size)):
        share = left // (len(size) - k)
        if n > share:
            break
        left -= n
        share = n
    out = []
    for t, n in zip(texts, size):
        if n <= share:
            out.append(b"".join(t))
        elif len(t) == 1:  # one part: cut into pieces first
            cut = [t[0][a : a + PIECE] for a in range(0, n, PIECE)]
            use = max(1, share // PIECE)
            out.append(b"".join(cut[k * len(cut) // use] for k in range(use)))
        else:
            use = max(1, share * len(t) // n)
            out.append(b"".join(t[k * len(t) // use] for k in range(use)))
    return out


@functools.lru_cache(maxsize=4)
def _compressors(dictionaries: tuple[tuple[str, bytes], ...], level: int) -> list[zstandard.ZstdCompressor]:
    out = []
    for _, data in dictionaries:
        p = zstandard.ZstdCompressionParameters.from_level(level, min_match=MATCH, dict_size=len(data), source_size=BLOCK, write_content_size=False, write_dict_id=False)
        d = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        d.precompute_compress(compression_params=p)
        out.append(zstandard.ZstdCompressor(dict_data=d, compression_params=p))
    return out


def sizes(raw: bytes, compressors: list[zstandard.ZstdCompressor], block: int = BLOCK) -> list[int]:
    """Compressed bytes of a text, by language."""
    view = memoryview(raw)
    parts = [view[i : i + block] for i in range(0, len(view), block)]
    return [sum(len(c.compress(p)) for p in parts) for c in compressors]


def detect(df: DataFrame, dictionaries: dict[str, bytes], id_col: str = "doc_id", text_col: str = "text", margin: float = MARGIN, block: int = BLOCK, level: int = LEVEL) -> DataFrame:
    """(id, lang, nearest, runner_up, margin, keep) for every row.

    ``margin`` is the runner-up's size less the winner's, by the winner's. Where it is narrower than the parameter, lang is 'und' and keep is
    false; ties go to the language that sorts first and are so rejected. Null and empty texts are 'und' with null nearest, runner_up and margin. With one
    dictionary there is no runner-up and its language is kept; with none everything is 'und'. Rows with null or repeated ids are rows
    like others, an empty table gives no rows, and other columns are ignored. Whole texts count.
    """
    docs, named = text_of(df, id_col, text_col), tuple(sorted(dictionaries.items()))
    names = [k for k, _ in named]
    schema, arrow = row_schemas(docs, [("lang", StringType()), ("nearest", StringType()), ("runner_up", StringType()), ("margin", DoubleType()), ("keep", BooleanType())])

    def score(batches):
        compressors = _compressors(named, level)
        for x in batches:
            data, offsets = K.flat(x.column("text"))
            raw, best, near, far, wide = K.lowered(data).tobytes(), [], [], [], []
            for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
                s = sizes(raw[a:b], compressors, block) if b > a and names else []
                order = sorted(range(len(s)), key=s.__getitem__)
                m = (s[order[1]] - s[order[0]]) / s[order[0]] if len(s) > 1 else None
                sure = bool(s) and (m is None or m >= margin)
                near.append(names[order[0]] if s else None)
                far.append(names[order[1]] if len(s) > 1 else None)
                wide.append(m)
                best.append(sure)
            yield batch(arrow, x.column("id"), [n if k else UNKNOWN for n, k in zip(near, best)], near, far, wide, best)

    return docs.mapInArrow(score, schema)
