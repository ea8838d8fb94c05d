import pytest

from quireflow.llm import sharding as S


def shards(spark, *sizes):
    return spark.createDataFrame([(f"s{k:04d}", 1, b) for k, b in enumerate(sizes)], S._SHARD)


def names(runs):
    return sorted([[int(n[1:]) for n in r.names] for r in runs.collect()])


def plain(sizes, target, fanout, full):
    """The rule in plain Python."""
    tiers = {}
    for k, b in enumerate(sizes):
        if b < target * 3 // 4:
            level = 0
            while not full and b * fanout ** (level + 1) < target:
                level += 1
            tiers.setdefault(level, []).append(k)
    out = []
    for own in tiers.values():
        at, runs = 0, {}
        for k in own:
            runs.setdefault((at + sizes[k] / 2) // target, []).append(k)
            at += sizes[k]
        out += [r for r in runs.values() if len(r) > 1 and (full or len(r) >= fanout or sum(sizes[k] for k in r) >= target * 3 // 4)]
    return sorted(out)


def test_plan(spark):
    assert names(S.plan(shards(spark, 30, 30, 30, 30, 30), target=100)) == [[0, 1, 2]]
    assert names(S.plan(shards(spark, 10, 10, 10), target=100)) == []  # too few to be worth a merge
    assert names(S.plan(shards(spark, 10, 10, 10), target=100, full=True)) == [[0, 1, 2]]
    assert names(S.plan(shards(spark, 90, 2, 2, 2, 2, 40, 20), target=100)) == [[1, 2, 3, 4]]  # tiers don't mix
    assert names(S.plan(shards(spark, 500, 80), target=100, full=True)) == [] == names(S.plan(shards(spark, 1).where("false"), target=100, full=True))


def test_plan_equals_brute_force(spark):
    import random

    rng = random.Random(3)
    for full in (False, True):
        sizes = [int(2 ** rng.uniform(0, 11)) for _ in range(300)]
        assert names(S.plan(shards(spark, *sizes), 1000, 4, full)) == plain(sizes, 1000, 4, full)


def test_round_trip_with_odd_rows(spark, tmp_path):
    root = f"file://{tmp_path}/shards"
    rows = [(i, f"text {i} " * (i % 50), None if i % 3 else "s", i) for i in range(3000)] + [(None, None, None, None), (5, "again", "s", 1), (5, "again", "s", 1), (7, "", "s", 1), (8, "long " * 200_000, "s", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, shard int").repartition(7)
    got = S.assign(df, root=root, target=60_000, arrival_bytes=4_000).collect()
    version, manifest = S.read_manifest(spark, root)
    manifest = manifest.collect()
    assert len(got) == len(rows) and sum(s.rows for s in manifest) == len(rows) and version >= 2
    assert len({(r.shard, r.place) for r in got}) == len(rows) and {r.shard for r in got} == set(range(len(manifest)))
    assert sorted(S.read(spark, root).collect(), key=repr) == sorted(df.collect(), key=repr)
    by_place = sorted(manifest, key=lambda s: s.name)
    assert all(by_place[r.shard].rows == r.shard_rows > r.place for r in got)
    assert len(manifest) < 14 and S.read(spark, root, 1).count() == len(rows)  # what the caller owns stays
    assert S.vacuum(spark, root, keep=1) > 0
    assert {p.name for p in (tmp_path / "shards/data").glob("*.parquet")} == {s.name for s in manifest}
    S.append(df.limit(10), root)
    assert S.read(spark, root).count() == len(rows) + 10 and S.read(spark, root, version, ["doc_id"]).count() == len(rows)
    with pytest.raises(ValueError):
        S.append(df.withColumnRenamed("text", "body"), root)


def test_commit_and_empty(spark, tmp_path):
    root = f"file://{tmp_path}/x"
    assert S.commit(spark, root, shards(spark, 1), 0) == 1
    with pytest.raises(FileExistsError):
        S.commit(spark, root, shards(spark, 2), 0)
    version, found = S.read_manifest(spark, root)
    assert version == 1 and [tuple(r) for r in found.collect()] == [("s0000", 1, 1)] and S.versions(spark, root) == [1]
    empty = spark.createDataFrame([], "doc_id string, text string")
    assert S.assign(empty, root=f"file://{tmp_path}/y").count() == 0 and S.read(spark, f"file://{tmp_path}/y") is None
    with pytest.raises(ValueError):
        S.write_arrivals(empty.selectExpr("doc_id", "text", "text"), root, "a")
    named = spark.createDataFrame([("a", 1.5), (None, 2.5)], "doc_id string, `odd.name` double")
    assert sorted((r.id is None, r.id) for r in S.assign(named).collect()) == [(False, "a"), (True, None)]
