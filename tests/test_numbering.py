import hashlib

import pytest
from pyspark.sql import functions as F

from glyphmill.operators import corpus as C
from glyphmill.operators.chunks import plan_chunks
from glyphmill.operators.numbering import positions, shuffled_positions
from glyphmill.operators.splits import (
    asset_manifest, id_manifest, resume_shards, shard_sizes, split_and_shard, split_sizes,
)

import brute


def keyed(spark, n, partitions):
    return spark.range(n).select(F.md5(F.col("id").cast("string")).alias("k"), "id").repartition(partitions)


@pytest.mark.parametrize("partitions", [1, 7, 32])
def test_positions_equal_a_sort(spark, partitions):
    got = positions(keyed(spark, 3000, partitions), ["k"], start=1).collect()
    assert [r.k for r in sorted(got, key=lambda r: r.pos)] == sorted(r.k for r in got)
    assert sorted(r.pos for r in got) == list(range(1, 3001))


@pytest.mark.parametrize("partitions", [1, 7])
def test_shuffle_is_the_digest_order(spark, partitions):
    got = shuffled_positions(keyed(spark, 500, partitions), "k", 42).collect()
    order = sorted((r.k for r in got), key=lambda k: hashlib.md5(f"42:{k}".encode()).hexdigest())
    assert [r.k for r in sorted(got, key=lambda r: r.pos)] == order
    assert {r.total for r in got} == {500}


def test_split_and_shard_sizes(spark):
    for n, train, shards in ((10, 9, [9]), (4001, 3600, [2000, 1600]), (1, 0, []), (19, 17, [17])):
        placed = split_and_shard(spark.range(n), "id", 2000)
        sizes = {r.split: r.n for r in split_sizes(placed).collect()}
        assert sizes.get("train", 0) == train == int(n * 0.9)
        assert sizes["test"] == n - train
        found = shard_sizes(placed.filter("split = 'train'")).orderBy("shard_idx").collect()
        assert [r.n for r in found] == shards


def test_resumed_shards_are_the_rest_of_the_full_run(spark):
    full = split_and_shard(spark.range(1000), "id", 100)
    resumed = resume_shards(full, train_shard=3, test_shard=1)
    expected = full.filter("(split = 'train' and shard_idx >= 3) or (split = 'test' and shard_idx >= 1)")
    assert resumed.exceptAll(expected).count() == 0 and expected.exceptAll(resumed).count() == 0


def test_manifests(spark):
    rows = spark.range(25).select(
        F.concat(F.lit("b"), "id").alias("basename"), F.col("id").alias("length"),
        F.concat(F.lit("/x/"), "id").alias("path"),
    )
    placed = split_and_shard(rows, "basename", 10)
    order = sorted((f"b{i}" for i in range(25)), key=lambda k: hashlib.md5(f"42:{k}".encode()).hexdigest())
    lines = id_manifest(placed, "basename").orderBy(F.desc("split"), "line_no").collect()
    assert [r.line for r in lines] == (
        ["--- TRAIN SPLIT | Total: 22 ---", *order[:22], "--- TEST SPLIT | Total: 3 ---", *order[22:]]
    )
    assets = asset_manifest(placed, "basename").orderBy(F.desc("split"), "shard_idx").collect()
    assert [r.archive for r in assets] == [
        "train_shard_0000", "train_shard_0001", "train_shard_0002", "test_shard_0000",
    ]
    assert [f.arcname for r in assets for f in r.files] == [f"{k}.png" for k in order]
    assert sum(r.total_bytes for r in assets) == sum(range(25))


def corpus_rows(spark, n=60):
    rows = []
    for i in range(1, n + 1):
        text = "" if i % 9 == 0 else "\n".join(f"Row {i} line {j} " + "text " * (i % 40) for j in range(12))
        rows.append((i, f"small-{i}" if i % 7 == 0 else f"id-{i}", "zpo", text))
    return spark.createDataFrame(rows, "row_ordinal long, id string, language string, text string")


def expected_blocks(rows):
    chunk_no = 0
    for r in sorted(rows, key=lambda r: r.row_ordinal):
        if "all" in r.id or not r.text.strip():
            continue
        for i, block in enumerate(brute.blocks(r.text.strip(), 42 + r.row_ordinal), 1):
            chunk_no += 1
            yield r.row_ordinal, i, chunk_no, block


def shape(df):
    return sorted((r.row_ordinal, r.block_idx, r.chunk_no, r.block_text) for r in df.collect())


@pytest.mark.parametrize("partitions", [1, 7])
def test_chunk_numbers_do_not_depend_on_partitions(spark, partitions):
    rows = corpus_rows(spark)
    expected = list(expected_blocks(rows.collect()))
    assert shape(plan_chunks(rows.repartition(partitions))) == expected
    unnumbered = rows.select(F.col("row_ordinal").alias("key"), "id", "language", "text")
    assert shape(plan_chunks(unnumbered.repartition(partitions), order_by=["key"])) == expected


def test_chunk_numbers_over_many_file_splits(spark):
    rows = corpus_rows(spark, 400).select(F.col("row_ordinal").alias("key"), "id", "language", "text")
    settings = {"spark.sql.files.maxPartitionBytes": "4k", "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        got = shape(plan_chunks(rows, order_by=["key"]))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == list(expected_blocks(corpus_rows(spark, 400).collect()))


def test_resume_and_limit_are_parts_of_the_full_run(spark):
    rows = corpus_rows(spark)
    full = shape(plan_chunks(rows))
    assert shape(plan_chunks(rows, resume_from=20)) == [r for r in full if r[0] > 20]
    effective = [
        r.row_ordinal for r in rows.orderBy("row_ordinal").collect() if "all" not in r.id and r.text.strip()
    ]
    for resume_from, limit in ((0, 1), (0, 10), (20, 5), (55, 100)):
        kept = [o for o in effective if o > resume_from][:limit]
        got = shape(plan_chunks(rows, resume_from=resume_from, limit=limit))
        assert got == [r for r in full if r[0] in kept]


def test_renumbering_on_resume(spark):
    rows = corpus_rows(spark)
    rest = [r for r in shape(plan_chunks(rows)) if r[0] > 20]
    got = shape(plan_chunks(rows, resume_from=20, renumber_on_resume=True))
    assert got == [(o, i, n, b) for n, (o, i, _, b) in enumerate(rest, 1)]


def test_limit_cut(spark):
    rows = spark.range(1, 1000).filter("id % 3 = 0").withColumnRenamed("id", "o")
    assert C.limit_cut(rows, "o", 1) == 3
    assert C.limit_cut(rows, "o", 100) == 300
    assert C.limit_cut(rows, "o", 333) is None or C.limit_cut(rows, "o", 333) == 999
    assert C.limit_cut(rows, "o", 334) is None
    assert C.limit_cut(rows.filter("o < 0"), "o", 5) is None
    far = spark.range(1, 400_000).withColumnRenamed("id", "o")
    rare = F.col("o") % 1000 == 7
    assert C.limit_cut(far, "o", 3, rare, after=7) == 3007
    assert C.limit_cut(far, "o", 399, rare) == 398_007
    assert C.limit_cut(far, "o", 401, rare) is None
    assert C.limit_cut(far, "o", 1, F.col("o") == 399_999) == 399_999


def test_excluded_ids(spark):
    ids = ["x-small-1", "eng_1", "ENG", "espresso", "mam", "a-all-b", "fraudulent"]
    df = spark.createDataFrame([(i,) for i in ids], "id string")
    got = df.select(
        C.is_excluded_id(F.col("id")).alias("anywhere"),
        C.is_excluded_id(F.col("id"), whole_tokens=True).alias("token"),
    ).collect()
    assert [r.anywhere for r in got] == [True, True, False, True, False, True, True]
    assert [r.token for r in got] == [False, True, False, False, False, True, False]
