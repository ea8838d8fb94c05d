import numpy as np
import zstandard

from quireflow.llm import langid as L

SYLLABLES = {"aa": ["tion", "ther", "ing", "hand", "ou"], "bb": ["keit", "schen", "ung", "ver", "ei"], "cc": ["mente", "ciones", "dad", "que", "ar"]}


def corpus(n=60, seed=0, size=(30, 120)):
    rng = np.random.default_rng(seed)
    return [(k * 3 + j, " ".join("".join(rng.choice(s, rng.integers(1, 4))) for _ in range(rng.integers(*size))), lang) for k in range(n) for j, (lang, s) in enumerate(SYLLABLES.items())]


def test_held_out_accuracy_and_brute_force(spark):
    dictionaries = L.fit(spark.createDataFrame(corpus(), "doc_id long, text string, lang string"))
    assert sorted(dictionaries) == ["aa", "bb", "cc"]
    held = corpus(40, seed=9)
    got = {r.id: r for r in L.detect(spark.createDataFrame(held, "doc_id long, text string, lang string"), dictionaries).collect()}
    assert np.mean([got[i].lang == lang for i, _, lang in held]) > 0.98
    for i, text, _ in held[:30]:
        size = {lang: plain_size(text, data) for lang, data in dictionaries.items()}
        order = sorted(size, key=lambda k: (size[k], k))
        assert got[i].nearest == order[0] and got[i].runner_up == order[1]
        assert abs(got[i].margin - (size[order[1]] - size[order[0]]) / size[order[0]]) < 1e-12
        assert got[i].lang == (order[0] if size[order[1]] >= size[order[0]] * (1 + L.MARGIN) else "und")


def plain_size(text, data):
    """Compressed bytes of a text with a dictionary, a new compressor for each block, and each block read again."""
    raw, total = text.lower().encode(), 0
    d = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    for a in range(0, len(raw), L.BLOCK):
        p = zstandard.ZstdCompressionParameters.from_level(L.LEVEL, min_match=L.MATCH, dict_size=len(data), source_size=L.BLOCK, write_content_size=False, write_dict_id=False)
        block = zstandard.ZstdCompressor(dict_data=d, compression_params=p).compress(raw[a : a + L.BLOCK])
        assert zstandard.ZstdDecompressor(dict_data=d).decompressobj().decompress(block) == raw[a : a + L.BLOCK]
        total += len(block)
    return total


def test_all_of_every_sampled_text_can_get_in(spark):
    texts = [(k, " ".join(f"{'abcdefgh'[part]}{k}x{n}" for part in range(8) for n in range(4000)), "aa") for k in range(6)]
    d = L.fit(spark.createDataFrame(texts, "doc_id int, text string, lang string"), sample=6)["aa"].decode()
    assert len(d) <= L.DICT_BYTES and len(d) > 0.9 * L.DICT_BYTES
    assert all(f" {'abcdefgh'[part]}{k}x" in d for part in range(8) for k in range(6))
    mixed = L._fair([[b"s" * 10], [b"l" * 5000], [b"x" * 256] * 40], 3000)
    assert len(mixed[0]) == 10 and all(1000 < len(m) < 1500 for m in mixed[1:])
    many = [(k, "some text here", f"l{k % 30}") for k in range(300)]
    assert len(L.fit(spark.createDataFrame(many, "doc_id int, text string, lang string"), languages=7)) == 7


def test_rejection_and_odd_rows(spark):
    dictionaries = L.fit(spark.createDataFrame(corpus(), "doc_id long, text string, lang string"))
    long = corpus(1, seed=4, size=(60_000, 60_001))[1][1]
    rows = [(1, None, "x"), (2, "", "x"), (3, "0123456789 #$% 998877", "x"), (None, long, None), (4, long, "x"), (4, long, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, margin string")
    got = sorted((tuple(r)[:3] + (r.keep,) for r in L.detect(df, dictionaries).collect()), key=repr)
    assert got == sorted([(1, "und", None, False), (2, "und", None, False), (3, "und", "aa", False), (None, "bb", "bb", True), (4, "bb", "bb", True), (4, "bb", "bb", True)], key=repr)
    assert L.detect(df.where("false"), dictionaries).count() == 0
    assert {r.lang for r in L.detect(df, {}).collect()} == {"und"}
    assert L.fit(spark.createDataFrame([(1, "text", None), (2, None, "aa")], "doc_id long, text string, lang string")) == {}
