"""Runs count as a whole or not at all, are made in one pass, and read back as they were made."""

from __future__ import annotations

import shutil

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F
from test_corpus_plan import long_csv, write
from test_dataset_plan import SMALL, png

from glyphmill.config import PrepConfig
from glyphmill.operators.splits import shard_starts, split_and_shard, with_shard
from glyphmill.plans import corpus as corpus_plan
from glyphmill.plans import dataset as dataset_plan
from glyphmill.plans.corpus import build_manifest, verify_manifest
from glyphmill.plans.dataset import build_chat, build_flat, build_instruction, verify_dataset
from glyphmill.sources import publish
from glyphmill.sources.digests import differences, digests_by
from glyphmill.sources.publish import Publication, read_published, settle


class Killed(Exception):
    pass


def killed_after(monkeypatch, owner, names, calls):
    """From now on the call after ``calls`` more of any of the functions ends the run."""
    left = [calls]

    def ending(function):
        def run(*args, **kwargs):
            if left[0] == 0:
                raise Killed
            left[0] -= 1
            return function(*args, **kwargs)

        return run

    for name in names:
        monkeypatch.setattr(owner, name, ending(getattr(owner, name)))


def two_tables(spark, output, version):
    """A run that replaces one partition and adds another, drops a third, and replaces a table."""
    run = Publication(spark, output)
    rows = spark.range(4).select(F.lit(version).alias("version"), (F.col("id") % 2 + version).alias("part"))
    rows.write.partitionBy("part").parquet(run.aside("made"))
    spark.range(1).select(F.lit(version).alias("version")).write.parquet(run.aside("whole"))
    run.put_parts("made", "parts", depth=1)
    run.put("whole", "whole")
    if version > 1:
        run.drop("parts/part=1")
    run.commit()


def rows_of(df):
    return sorted(tuple(r) for r in df.select(*sorted(df.columns)).collect())


def test_a_run_killed_anywhere_leaves_one_whole_state(spark, tmp_path, monkeypatch):
    first = str(tmp_path / "first")
    two_tables(spark, first, 1)
    old = ([(1, 1), (1, 1), (2, 1), (2, 1)], [(1,)])
    new = ([(2, 2), (2, 2), (3, 2), (3, 2)], [(2,)])
    seen = []
    for calls in range(100):
        output = str(tmp_path / f"killed-{calls}")
        shutil.copytree(first, output)
        with monkeypatch.context() as m:
            killed_after(m, publish, ["_rename", "_delete", "_make_folder", "_write"], calls)
            try:
                two_tables(spark, output, 2)
                ended = True
            except Killed:
                ended = False
        state = tuple(rows_of(read_published(spark, output, t)) for t in ("parts", "whole"))
        seen.append(state == new)
        assert state in (old, new)
        settle(spark, output)  # what the next run begins with
        assert tuple(rows_of(spark.read.parquet(f"{output}/{t}")) for t in ("parts", "whole")) == state
        if ended:
            break
    assert ended and seen[-1] and not seen[0] and seen == sorted(seen) and 3 < sum(seen) < len(seen)


def test_nothing_is_published_until_all_is_written(spark, tmp_path, monkeypatch):
    path, out = long_csv(tmp_path / "c.csv"), str(tmp_path / "out")
    last = build_manifest(spark, path, out, limit=8)["last_row"]
    tables = ("manifest", "text", "rejected", "counters", "digests")
    before = [rows_of(spark.read.parquet(f"{out}/{t}").select(F.to_json(F.struct("*")))) for t in tables]
    calls, ended = 0, False
    while not ended:
        with monkeypatch.context() as m:
            killed_after(m, DataFrameWriter, ["parquet"], calls)
            try:
                build_manifest(spark, path, out, resume_from=last)
                ended = True
            except Killed:
                calls += 3
        after = [rows_of(spark.read.parquet(f"{out}/{t}").select(F.to_json(F.struct("*")))) for t in tables]
        assert (after == before) != ended
    assert calls >= 6 and verify_manifest(spark, out).isEmpty()


def counting(spark, monkeypatch, owner, name, count):
    """Calls of a function give their result with every row counted whenever it is computed."""
    function, rows = getattr(owner, name), spark.sparkContext.accumulator(0)

    @F.udf("boolean")
    def counted(_):
        rows.add(1)
        return True

    monkeypatch.setattr(owner, name, lambda *args, **kwargs: count(function, counted, *args, **kwargs))
    return rows


def test_rejected_blocks_are_drawn_once(spark, tmp_path, monkeypatch):
    path = write(tmp_path / "c.csv", "id,text\nlong," + "w" * 20_000 + "\nfine," + "word " * 60 + "\n")

    def before(function, counted, blocks, seed):
        return function(blocks.filter(counted("chunk_no")), seed)

    rows = counting(spark, monkeypatch, corpus_plan, "manifest_outcomes", before)
    counters = build_manifest(spark, path, str(tmp_path / "out"))
    # The empty block is neither drawn nor rejected.
    assert (rows.value, counters["chunks"], counters["accepted"]) == (2, 3, 1)


@pytest.fixture
def rendered(tmp_path):
    images, texts = tmp_path / "images", tmp_path / "text"
    images.mkdir()
    texts.mkdir()
    for i in range(12):
        (images / f"zpo_{i}.png").write_bytes(png(300, 300, 20 * 1024 + i) if i != 3 else b"x" * 20 * 1024)
        (texts / f"zpo_{i}.txt").write_bytes(f"text {i}".encode() if i != 5 else b"\xff\xfe")
    (images / "alone.png").write_bytes(png(300, 300, 30_000))
    (texts / "lone.txt").write_text("x")
    return str(images), str(texts)


def test_failing_samples_are_joined_once(spark, rendered, tmp_path, monkeypatch):
    def after(function, counted, *args, content=False):
        files = function(*args, content=content)
        return files.filter(counted("path")) if content else files

    rows = counting(spark, monkeypatch, dataset_plan, "read_images", after)
    build_chat(spark, *rendered, str(tmp_path / "out"), SMALL)
    assert rows.value == 13
    failed = spark.read.parquet(f"{tmp_path}/out/failed").collect()
    assert {(r.key, r.stage, r.error) for r in failed} == {
        ("zpo_3", "reshape", "missing image"), ("zpo_5", "reshape", "missing text"),
    }
    orphans = {tuple(r) for r in spark.read.parquet(f"{tmp_path}/out/orphans").collect()}
    assert orphans == {("alone", "image"), ("lone", "text")}


def nodes(plan):
    plan = plan.inputPlan() if plan.nodeName() == "AdaptiveSparkPlan" else plan
    children = plan.children()
    return [plan, *(n for i in range(children.size()) for n in nodes(children.apply(i)))]


def test_one_exchange_holds_image_bytes(spark, rendered):
    pairs = dataset_plan.read_images(spark, rendered[0])
    placed = split_and_shard(pairs, "basename", 4)
    texts = dataset_plan._with_text(spark, placed, rendered[1])
    full = dataset_plan.with_image(spark, texts, placed, rendered[0], SMALL)
    moved = [n for n in nodes(full._jdf.queryExecution().executedPlan()) if "Exchange" in n.nodeName()]
    assert sum("image" in n.output().mkString(",") or "content" in n.output().mkString(",") for n in moved) == 1


def test_shards_are_found_from_names(spark):
    placed = split_and_shard(spark.range(5000).select(F.concat(F.lit("k"), "id").alias("k")), "k", 300)
    starts = shard_starts(placed, "k")
    found = with_shard(placed.select("k"), "k", starts)
    wanted = placed.select("k", "split", "shard_idx")
    assert found.exceptAll(wanted).isEmpty() and wanted.exceptAll(found).isEmpty()
    few = split_and_shard(placed.select("k").limit(3), "k", 1)
    assert with_shard(placed.select("k"), "k", shard_starts(few, "k")).count() <= 5000


def test_shards_that_are_no_longer_made_go(spark, rendered, tmp_path):
    out = str(tmp_path / "out")
    build_chat(spark, *rendered, out, PrepConfig(chat_shard_size=2))
    for i in (0, 1, 2, 4):
        (tmp_path / "images" / f"zpo_{i}.png").unlink()
    build_chat(spark, *rendered, out, PrepConfig(chat_shard_size=2))
    rows = spark.read.parquet(f"{out}/data")
    assert rows.count() == 6 and rows.select(F.explode("images.path")).distinct().count() == 6
    assert verify_dataset(spark, out, "data").isEmpty()


def test_changed_values_types_and_rows_are_found(spark, rendered, tmp_path):
    out = str(tmp_path / "out")
    build_chat(spark, *rendered, out, SMALL)
    wanted = spark.read.parquet(f"{out}/digests")
    keys, data = ["split", "shard_idx"], spark.read.parquet(f"{out}/data")

    def problems(df):
        return {tuple(r) for r in differences(digests_by(df, keys), wanted, keys).collect()}

    first = (F.col("split") == "train") & (F.col("shard_idx") == 0)
    one = F.col("images")[0]["path"] == data.filter(first).first().images[0].path
    assert problems(data) == set()
    assert problems(data.filter(~one)) == {("train", 0, "rows")}
    assert problems(data.filter(~first)) == {("train", 0, "lost")}
    assert problems(data.unionByName(data.filter(first).withColumn("shard_idx", F.lit(9)))) == {("train", 9, "extra")}
    other = F.transform("images", lambda i: i.withField("bytes", F.concat(i["bytes"], F.lit(b"\0"))))
    assert problems(data.withColumn("images", F.when(one, other).otherwise(F.col("images")))) == {("train", 0, "values")}
    assert {p for _, _, p in problems(data.withColumn("images", F.col("images.path")))} == {"values"}
    swapped = F.transform("messages", lambda m: m.withField("role", F.lit("user")))
    assert {p for _, _, p in problems(data.withColumn("messages", swapped))} == {"values"}


def test_every_builder_keeps_digests(spark, rendered, tmp_path):
    flat, lines = str(tmp_path / "flat"), str(tmp_path / "lines")
    build_flat(spark, *rendered, flat, SMALL)
    assert verify_dataset(spark, flat, "data").isEmpty()
    build_instruction(spark, *rendered, lines, SMALL)
    schema = spark.read.json(f"{lines}/lines").schema
    kinds = (
        "image_info array<struct<matched_text_index:int,image_url:string>>, "
        "text_info array<struct<text:string,tag:string>>, split string, shard_idx int"
    )
    assert {f.name for f in schema} == {"image_info", "text_info", "split", "shard_idx"}
    typed = spark.createDataFrame([], kinds).schema
    assert verify_dataset(spark, lines, "lines", typed, "json").isEmpty()


def test_counters_tell_rows_share_and_size(spark, tmp_path):
    path, out = long_csv(tmp_path / "c.csv"), str(tmp_path / "out")
    log = tmp_path / "log.txt"
    build_manifest(spark, path, out, limit=8, log_file=str(log))
    row = spark.read.parquet(f"{out}/counters").first()
    # Row 3 is out of scope, so eight effective rows end with row 9.
    assert (row.rows, row.effective_rows, row.read_to, row.total_rows, row.percent) == (9, 8, 9, 25, 36.0)
    assert row.output_mb > 0
    assert row.progress == f"PROGRESS: 36.0% | Row: 9/25 | Effective: 8 | Chunks: {row.chunks} | Output: {row.output_mb:.1f}MB"


def test_progress_is_logged_while_jobs_run(spark, tmp_path):
    from glyphmill.operators.runlog import logged_progress

    @F.udf("long")
    def slow(x):
        import time

        time.sleep(0.2)
        return x

    log = tmp_path / "log.txt"
    with logged_progress(spark, str(log), every=0.1):
        spark.range(8).repartition(8).select(slow("id").alias("id")).agg(F.sum("id")).collect()
    assert "PROGRESS: stage" in log.read_text()


def test_renumbering_on_resume_is_reachable(spark, tmp_path):
    path = long_csv(tmp_path / "c.csv")
    one, two = str(tmp_path / "one"), str(tmp_path / "two")
    build_manifest(spark, path, one, resume_from=20)
    build_manifest(spark, path, two, resume_from=20, renumber_on_resume=True)
    last = [spark.read.parquet(f"{o}/counters").first() for o in (one, two)]
    assert last[0].chunks == last[1].chunks == last[1].last_chunk < last[0].last_chunk


def test_scratch_is_empty_after_a_build(spark, tmp_path):
    import pathlib

    from glyphmill.session import scratch_dir

    folder = pathlib.Path(scratch_dir(spark).removeprefix("file:"))
    before = set(folder.iterdir()) if folder.exists() else set()
    build_manifest(spark, long_csv(tmp_path / "c.csv", 5), str(tmp_path / "out"))
    assert set(folder.iterdir()) == before


def test_builds_of_nothing(spark, tmp_path):
    empty = spark.createDataFrame([], "row_ordinal long, id string, language string, text string")
    counters = build_manifest(spark, empty, str(tmp_path / "out"))
    assert (counters["chunks"], counters["accepted"], counters["rows"]) == (0, 0, 0)
    assert all(spark.read.parquet(f"{tmp_path}/out/{t}").count() == (t in ("counters", "digests")) for t in corpus_plan.TABLES)
    for folder in ("images", "text"):
        (tmp_path / folder).mkdir()
    build_chat(spark, str(tmp_path / "images"), str(tmp_path / "text"), str(tmp_path / "chat"), SMALL)
    assert spark.read.parquet(f"{tmp_path}/chat/failed").count() == 0
