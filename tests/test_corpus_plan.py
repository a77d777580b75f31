import pytest
from pyspark.sql import functions as F

from glyphmill.operators.manifest import MANIFEST_COLUMNS, planned_blocks
from glyphmill.operators.chunks import plan_chunks
from glyphmill.plans.corpus import build_manifest
from glyphmill.sources.corpus import count_rows, read_corpus, read_corpus_csv
from glyphmill.sources.files import folder_megabytes
from glyphmill.streaming.blocks import run_available, stream_blocks

import brute

CSV = (
    'id,language,text\n'
    'a-1,zpo,"First, with ""quotes"" and\na second line"\n'
    'a-2,,plain\n'
    ',maz,no id\n'
    'a-4,mir,\n'
    'a-5,mir\n'
    'a-6,mir,"café \\n ꞌ"\n'
)


def write(path, text, encoding="utf-8"):
    path.write_bytes(text if isinstance(text, bytes) else text.encode(encoding))
    return str(path)


def test_csv_rows_and_defaults(spark, tmp_path):
    path = write(tmp_path / "c.csv", CSV)
    rows = read_corpus(spark, path).orderBy("row_ordinal").collect()
    assert [tuple(r) for r in rows] == [
        (1, "a-1", "zpo", 'First, with "quotes" and\na second line'),
        (2, "a-2", "", "plain"),
        (3, "", "maz", "no id"),
        (4, "a-4", "mir", ""),
        (5, "a-5", "mir", ""),
        (6, "a-6", "mir", "café \\n ꞌ"),
    ]
    assert count_rows(spark, path) == 6


def test_csv_without_optional_columns(spark, tmp_path):
    path = write(tmp_path / "c.csv", "text\none\ntwo\n")
    rows = read_corpus(spark, path).orderBy("row_ordinal").collect()
    assert [tuple(r) for r in rows] == [(1, "row_1", "unk", "one"), (2, "row_2", "unk", "two")]


def test_bad_bytes_are_replaced(spark, tmp_path):
    path = write(tmp_path / "c.csv", b"id,text\nx,a\xffb\n")
    assert read_corpus_csv(spark, path).first().text == "a�b"


def test_ordinals_run_on_over_files(spark, tmp_path):
    for name, rows in (("b.csv", 30), ("a.csv", 20), ("c.csv", 1)):
        write(tmp_path / name, "id,text\n" + "".join(f"{name}-{i},t\n" for i in range(rows)))
    rows = read_corpus(spark, str(tmp_path)).orderBy("row_ordinal").collect()
    assert [r.row_ordinal for r in rows] == list(range(1, 52))
    assert [r.id for r in rows] == (
        [f"a.csv-{i}" for i in range(20)] + [f"b.csv-{i}" for i in range(30)] + ["c.csv-0"]
    )


def long_csv(path, rows=25):
    lines = ["id,language,text"]
    for i in range(1, rows + 1):
        text = "\\n".join(f"Line {j} of row {i} with **bold** words" for j in range(i))
        lines.append(f'{"fall" if i == 3 else "row"}-{i},zpo,"{text}"')
    return write(path, "\n".join(lines) + "\n")


def test_manifest_from_csv(spark, tmp_path):
    path, out = long_csv(tmp_path / "c.csv"), str(tmp_path / "out")
    counters = build_manifest(spark, path, out)
    expected = []
    for i in range(1, 26):
        text = "\n".join(f"Line {j} of row {i} with bold words" for j in range(i))
        if i != 3:
            expected += [(i, k, b) for k, b in enumerate(brute.blocks(text, 42 + i), 1)]
    assert counters["chunks"] == len(expected) and counters["last_row"] == 25
    manifest = spark.read.parquet(f"{out}/manifest")
    assert manifest.columns == [*MANIFEST_COLUMNS, "run"]
    rows = manifest.collect()
    assert len(rows) == counters["accepted"] == len(expected)
    assert len({r.basename for r in rows}) == len(rows)
    by_key = {tuple(r.basename.split("_")[1:3]): r for r in rows}
    for i, k, block in expected:
        row = by_key[(f"row-{i}", f"{k:03d}")]
        assert row.text in (block, block.upper())
        assert row.basename == f"zpo_row-{i}_{k:03d}_{int(row.aspect_ratio * 100)}ar"
    texts = spark.read.parquet(f"{out}/text")
    assert texts.columns == ["basename", "text", "run"] and texts.count() == len(rows)
    assert folder_megabytes(spark, f"{out}/text").first().megabytes > 0


def test_manifest_again_is_the_same(spark, tmp_path):
    path = long_csv(tmp_path / "c.csv")
    first, second = (str(tmp_path / n) for n in ("one", "two"))
    build_manifest(spark, path, first)
    build_manifest(spark, read_corpus(spark, path).repartition(5), second)
    a, b = (spark.read.parquet(f"{p}/manifest") for p in (first, second))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_rejected_blocks_are_listed(spark, tmp_path):
    path = write(tmp_path / "c.csv", "id,text\nlong," + "w" * 20_000 + "\nfine," + "word " * 60 + "\n")
    counters = build_manifest(spark, path, str(tmp_path / "out"))
    # The word over the limit comes after an empty block, which takes a number as well.
    assert (counters["chunks"], counters["accepted"]) == (3, 1)
    rejected = spark.read.parquet(f"{tmp_path}/out/rejected").collect()
    assert [tuple(r)[:3] for r in rejected] == [("2", "size", "no valid size in 11 attempts")]


def test_blocks_without_valid_size_are_rejected(spark):
    rows = [(1, 1, 1, "zpo", "a", "word " * 2000), (1, 2, 2, "zpo", "a", "  "), (1, 3, 3, "zpo", "a", "ok")]
    blocks = spark.createDataFrame(
        rows, "row_ordinal long, block_idx int, chunk_no long, language string, id string, block_text string"
    )
    planned = {r.chunk_no: r for r in planned_blocks(blocks).collect()}
    assert set(planned) == {1, 3}
    assert planned[1].reject_reason == "no valid size in 11 attempts"
    assert planned[3].reject_reason is None


def test_stream_picks_up_where_it_stopped(spark, tmp_path):
    source, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    rows = spark.range(1, 21).select(
        F.col("id").alias("row_ordinal"),
        F.concat(F.lit("r-"), "id").alias("id"),
        F.lit("zpo").alias("language"),
        F.expr("array_join(transform(sequence(1, 30), i -> concat('Line ', i, ' of row ', id)), '\n')").alias("text"),
    )
    rows = rows.select("row_ordinal", "id", "language", "text")
    seen = []
    for part in (rows.filter("row_ordinal <= 8"), rows.filter("row_ordinal > 8")):
        part.write.mode("append").parquet(source)
        run_available(stream_blocks(spark, source), out, mark).awaitTermination()
        seen.append(spark.read.parquet(out).count())
    streamed = spark.read.parquet(out)
    batch = plan_chunks(rows).drop("chunk_no").select(*streamed.columns)
    assert 0 < seen[0] < seen[1] == batch.count()
    assert streamed.exceptAll(batch).count() == 0


def test_resumed_run_completes_a_limited_one(spark, tmp_path):
    path = long_csv(tmp_path / "c.csv")
    full, parts = str(tmp_path / "full"), str(tmp_path / "parts")
    build_manifest(spark, path, full)
    last = build_manifest(spark, path, parts, limit=8)["last_row"]
    for _ in range(2):  # a repeat changes nothing
        build_manifest(spark, path, parts, resume_from=last)
        for name in ("manifest", "text", "rejected"):
            one, two = (spark.read.parquet(f"{p}/{name}").drop("run") for p in (full, parts))
            assert one.exceptAll(two).isEmpty() and two.exceptAll(one).isEmpty()
    with pytest.raises(ValueError, match="earlier run"):
        build_manifest(spark, path, parts, resume_from=last + 2)
    build_manifest(spark, path, parts)  # from the start: the continuation goes
    assert spark.read.parquet(f"{parts}/counters").count() == 1
