import os

import pytest

import corpus_pipeline as P
from quireflow.llm.common import table

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_stages(spark, tmp_path):
    docs, counts = table(spark, SF, "documents"), []
    columns = docs.columns
    for k, (_, stage) in enumerate(P.STAGES):
        counts.append(docs.count())
        out = stage(spark, docs, SF)
        if k < len(P.STAGES) - 1:
            assert out.columns == columns
        out.write.parquet(f"file://{tmp_path}/{k}")
        docs = spark.read.parquet(f"file://{tmp_path}/{k}")
    assert counts[0] > counts[1] > counts[2] >= counts[3] > 0 and docs.count() == counts[4]
    assert sorted(r.doc_id for r in P.run(spark, SF).collect()) == sorted(r.doc_id for r in docs.collect())


def test_empty(spark, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        table(spark, SF, name).where("false").write.parquet(f"{tmp_path}/{name}.parquet")
    assert P.run(spark, str(tmp_path)).count() == 0


def odd_documents(spark):
    """Rows with nulls in each column, empty, blank and very long texts, ties and repeats, and columns with names that operators use inside."""
    clean = [r.text for r in table(spark, SF, "documents").where("n_chars between 400 and 900 and doc_id < 60").orderBy("doc_id").limit(4).collect()]
    rows = [(1, clean[0], "en", "a"), (1, clean[0], "en", "a"), (2, clean[0], None, "b"), (3, clean[1], "en", None), (4, None, "en", "a"), (5, "", "en", "a"), (6, " \n", None, None), (None, clean[2], "en", "a"), (None, None, None, None), (7, clean[3], "en", "a"), (7, clean[1] + " and more of it", "en", "b"), (8, " ".join(clean) * 300, "en", "a")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    return df.selectExpr("*", "cast(length(text) as int) AS n_chars", "doc_id AS id", "1 AS `group`", "'k' AS keep", "2 AS rest", "3 AS uses", "4 AS part", "map('a', 1) AS `_gone`", "5 AS `a.b`")


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_odd_rows_in_every_stage(spark):
    docs = odd_documents(spark)
    ids = lambda df: sorted((r.doc_id is None, r.doc_id or 0) for r in df.select("doc_id").collect())
    stages = dict(P.STAGES)
    for name, stage in P.STAGES:
        assert stage(spark, docs.where("false"), SF).count() == 0
        if name != "shard":
            assert stage(spark, docs, SF).columns == docs.columns
    good = stages["quality"](spark, docs, SF)
    assert all(r.text and r.text.strip() for r in good.collect()) and {(False, 1), (False, 3), (True, 0)} <= set(ids(good)) and ids(good).count((False, 1)) == 2
    kept = ids(stages["near_dedup"](spark, docs, SF))
    assert kept.count((False, 1)) == 2 and (False, 2) not in kept and kept.count((True, 0)) == 2 and {(False, k) for k in (3, 4, 5, 6, 7, 8)} <= set(kept)
    assert ids(stages["decontaminate"](spark, docs, SF)) == ids(docs)
    bad = spark.createDataFrame([(9, table(spark, SF, "benchmark").first().text, "en", "a")], "doc_id long, text string, lang string, source string")
    assert stages["decontaminate"](spark, bad, SF).count() == 0
    mixed = stages["mix"](spark, docs, SF)
    assert {r.doc_id for r in mixed.collect()} <= {1, 3, 7, 8} and mixed.where("doc_id = 1").select("text", "rest", "id").distinct().count() <= 1
    placed = stages["shard"](spark, docs, SF)
    assert ids(placed) == ids(docs) and placed.columns == ["doc_id", "shard", "place", "shard_rows"]


def plain_components(codes, radius, runs):
    import numpy as np

    root = list(range(len(codes)))
    for i in range(len(codes)):
        for j in range(i):
            d = np.bitwise_count(codes[i] ^ codes[j])
            if d[0] <= radius and d[1:].sum() <= runs and root[i] != root[j]:
                old, new = max(root[i], root[j]), min(root[i], root[j])
                root = [new if r == old else r for r in root]
    return root


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_the_first_stages_equal_brute_force(spark):
    import numpy as np
    import pyarrow as pa

    from quireflow.llm import decontam, quality, simhash

    docs = table(spark, SF, "documents")
    model = quality.fit(docs, table(spark, SF, "labels"))
    sound = {r.id for r in quality.score(docs, model).where("keep").collect()}
    stages = dict(P.STAGES)
    first = stages["quality"](spark, docs, SF)
    rows = sorted((r.doc_id, r.text) for r in first.collect())
    assert {i for i, _ in rows} == sound
    codes, _ = simhash.fingerprints(pa.array([t for _, t in rows]))
    root = plain_components(codes, simhash.RADIUS, simhash.RUN_RADIUS)
    want = {rows[k][0] for k in range(len(rows)) if root[k] == k}
    second = stages["near_dedup"](spark, first, SF)
    assert {r.doc_id for r in second.collect()} == want
    items = [r.text for r in table(spark, SF, "benchmark").collect()]
    held = {i for i, t in rows if i in want and any(decontam.brute(t, x) is not None for x in items if set(x.lower().split()) & set(t.lower().split()))}
    third = {r.doc_id for r in stages["decontaminate"](spark, second, SF).collect()}
    assert third <= want and len((want - third) ^ held) <= 0.03 * len(held) + 1 and want - third <= held
    assert np.isclose(len(third) + len(want - third), len(want))
