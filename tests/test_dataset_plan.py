import json
import pathlib
import struct

import pytest
from pyspark.sql import functions as F

from glyphmill.config import PrepConfig
from glyphmill.operators.pairs import checked_images, orphans, split_usable
from glyphmill.plans.dataset import build_chat, build_flat, build_instruction, orphan_report
from glyphmill.sources.files import read_images, read_texts
from glyphmill.sources.sinks import verify_written

SMALL = PrepConfig(chat_shard_size=4, instruction_shard_size=5)


def png(width, height, size):
    head = b"\x89PNG\r\n\x1a\n" + struct.pack(">I4sII", 13, b"IHDR", width, height)
    return head + b"\0" * (size - len(head))


@pytest.fixture(scope="module")
def folders(tmp_path_factory):
    base = tmp_path_factory.mktemp("rendered")
    images, texts = base / "images", base / "text"
    images.mkdir()
    texts.mkdir()
    for i in range(20):
        name = f"zp{i % 3}_r-{i}_00{i % 4}_120ar" if i else "zpo_ꞌi d_001_99ar"
        (images / f"{name}.png").write_bytes(png(640, 480, 20 * 1024 + i))
        (texts / f"{name}.txt").write_text(f" Text {i}\r\n\n of ꞌ line\n", "utf-8", newline="")
    (images / "only_image.png").write_bytes(png(300, 300, 30_000))
    (texts / "only_text.txt").write_text("x")
    (images / "too_light.png").write_bytes(png(300, 300, 20 * 1024 - 1))
    (texts / "too_light.txt").write_text("light")
    (images / "notes.jpg").write_bytes(b"x" * 30_000)
    return str(images), str(texts)


def expected(folders):
    images = pathlib.Path(folders[0])
    return {
        p.stem: p.read_bytes() for p in images.glob("*.png") if p.stem not in ("only_image", "too_light")
    }


def test_listing_and_orphans(spark, folders):
    images, texts = read_images(spark, folders[0]), read_texts(spark, folders[1])
    assert images.count() == 22 and texts.count() == 22
    found = {(r.basename, r.side) for r in orphans(images, texts).collect()}
    assert found == {("only_image", "image"), ("only_text", "text")}
    assert {r.side: r.n for r in orphan_report(spark, *folders).collect()} == {"image": 1, "text": 1}
    text = texts.filter("basename like 'zpo%'").first()
    assert text.basename == "zpo_ꞌi d_001_99ar"
    assert text.text == " Text 0\r\n\n of ꞌ line\n"


def test_listing_does_not_read_content(spark, folders):
    plan = read_images(spark, folders[0]).filter("length >= 20480")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(length,20480)" in text
    assert "content" not in text.split("ReadSchema")[1]


def test_flat_dataset(spark, folders, tmp_path):
    build_flat(spark, *folders, str(tmp_path), SMALL)
    rows = spark.read.parquet(f"{tmp_path}/data").collect()
    want = expected(folders)
    assert {r.id: bytes(r.image.bytes) for r in rows} == want
    assert all(r.image.path == f"{r.id}.png" and r.language == r.id[:3] for r in rows)
    assert sorted(r.text for r in rows) == sorted(f"Text {i} of ꞌ line" for i in range(20))
    assert sum(r.split == "train" for r in rows) == 18
    ids = spark.read.parquet(f"{tmp_path}/ids").orderBy(F.desc("split"), "line_no").collect()
    assert ids[0].line == "--- TRAIN SPLIT | Total: 18 ---"
    place = {(r.split, r.split_pos + 1): r.id for r in rows}
    assert all(r.line == place[(r.split, r.line_no)] for r in ids if r.line_no)
    truth = read_texts(spark, folders[1], value=False).select(F.col("basename").alias("id"))
    problems = verify_written(spark, f"{tmp_path}/data", truth)
    assert {(r.id, r.problem) for r in problems.collect()} == {("only_text", "lost"), ("too_light", "lost")}
    with pytest.raises(ValueError):
        verify_written(spark, f"{tmp_path}/data", truth.withColumn("more", F.lit(1)))


def shard_files(path, suffix):
    return sorted(str(p.relative_to(path).parent) for p in pathlib.Path(path).rglob(f"*.{suffix}"))


def test_chat_shards(spark, folders, tmp_path):
    build_chat(spark, *folders, str(tmp_path), SMALL)
    assert shard_files(tmp_path / "data", "parquet") == [
        "split=test/shard_idx=0",
        *[f"split=train/shard_idx={i}" for i in range(5)],
    ]
    rows = spark.read.parquet(f"{tmp_path}/data").collect()
    assert len(rows) == 20
    want = expected(folders)
    for r in rows:
        user, assistant = r.messages
        assert (user.role, assistant.role) == ("user", "assistant")
        assert [tuple(p)[1:] for p in user.content] == [("OCR:", "text"), (None, "image")]
        assert user.content[0].image is None and user.content[1].image == r.images[0]
        assert assistant.content[0].image is None and assistant.content[0].type == "text"
        name = r.images[0].path[:-4]
        assert bytes(r.images[0].bytes) == want[name]


def test_resume_rewrites_only_later_shards(spark, folders, tmp_path):
    build_chat(spark, *folders, str(tmp_path), SMALL)
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "data").rglob("*.parquet")}
    full = {(r.split, r.shard_idx, r.images[0].path) for r in spark.read.parquet(f"{tmp_path}/data").collect()}
    build_chat(
        spark, *folders, str(tmp_path), PrepConfig(chat_shard_size=4, resume_train_shard=3, resume_test_shard=1)
    )
    after = {p: p.stat().st_mtime_ns for p in (tmp_path / "data").rglob("*.parquet")}
    kept = {p for p in before if before[p] == after.get(p)}
    assert {p.parent.parent.name + "/" + p.parent.name for p in kept} == {
        "split=test/shard_idx=0", "split=train/shard_idx=0", "split=train/shard_idx=1", "split=train/shard_idx=2",
    }
    again = {(r.split, r.shard_idx, r.images[0].path) for r in spark.read.parquet(f"{tmp_path}/data").collect()}
    assert again == full


def test_unreadable_samples_are_skipped_and_listed(spark, tmp_path):
    images, texts = tmp_path / "images", tmp_path / "text"
    images.mkdir()
    texts.mkdir()
    for i in range(10):
        (images / f"zpo_{i}.png").write_bytes(png(300, 300, 20 * 1024) if i != 3 else b"x" * 20 * 1024)
        (texts / f"zpo_{i}.txt").write_bytes(b"fine" if i != 5 else b"\xff\xfe")
    build_chat(spark, str(images), str(texts), str(tmp_path / "chat"), SMALL)
    build_instruction(spark, str(images), str(texts), str(tmp_path / "lines"), SMALL)
    assert spark.read.parquet(f"{tmp_path}/chat/data").count() == 8
    failed = {(r.key, r.error) for r in spark.read.parquet(f"{tmp_path}/chat/failed").collect()}
    assert failed == {("zpo_3", "missing image"), ("zpo_5", "missing text")}
    assert spark.read.json(f"{tmp_path}/lines/lines").count() == 9
    assert spark.read.parquet(f"{tmp_path}/lines/failed").first().key == "zpo_5"
    members = {f.arcname for a in spark.read.parquet(f"{tmp_path}/lines/assets").collect() for f in a.files}
    assert members == {f"zpo_{i}.png" for i in range(10) if i != 5}


def test_flat_splits_what_it_writes(spark, tmp_path):
    images, texts = tmp_path / "images", tmp_path / "text"
    images.mkdir()
    texts.mkdir()
    for i in range(10):
        (images / f"zpo_{i}.png").write_bytes(png(300, 300, 20 * 1024) if i != 3 else b"\xff\xd8\xff" + b"x" * 20 * 1024)
        (texts / f"zpo_{i}.txt").write_bytes(b"fine" if i != 5 else b"\xff\xfe")
    build_flat(spark, str(images), str(texts), str(tmp_path / "flat"), SMALL)
    rows = spark.read.parquet(f"{tmp_path}/flat/data").collect()
    assert {r.id for r in rows} == {f"zpo_{i}" for i in range(10) if i != 5}
    assert sum(r.split == "test" for r in rows) == 1
    ids = spark.read.parquet(f"{tmp_path}/flat/ids").collect()
    assert {r.line for r in ids if r.line_no} == {r.id for r in rows}
    assert {r.line for r in ids if not r.line_no} == {"--- TRAIN SPLIT | Total: 8 ---", "--- TEST SPLIT | Total: 1 ---"}
    refused = spark.read.parquet(f"{tmp_path}/flat/refused").collect()
    assert [tuple(r) for r in refused] == [("zpo_5", "text", "missing text")]
    build_chat(spark, str(images), str(texts), str(tmp_path / "chat"), SMALL)  # a JPEG by another name is kept
    assert spark.read.parquet(f"{tmp_path}/chat/data").count() == 9


def test_geometry_is_checked_before_the_split(spark, tmp_path):
    images, texts = tmp_path / "images", tmp_path / "text"
    images.mkdir()
    texts.mkdir()
    for i, (w, h) in enumerate([(300, 300), (199, 300), (1500, 250), (300, 300), (200, 800)]):
        (images / f"zpo_{i}.png").write_bytes(png(w, h, 20 * 1024))
        (texts / f"zpo_{i}.txt").write_text("fine")
    build_instruction(spark, str(images), str(texts), str(tmp_path / "out"), PrepConfig(check_geometry=True))
    members = {f.arcname for a in spark.read.parquet(f"{tmp_path}/out/assets").collect() for f in a.files}
    assert members == {"zpo_0.png", "zpo_3.png", "zpo_4.png"}
    refused = {(r.key, r.error) for r in spark.read.parquet(f"{tmp_path}/out/refused").collect()}
    assert refused == {("zpo_1", "too small"), ("zpo_2", "too extreme")}


def test_instruction_lines_and_assets(spark, folders, tmp_path):
    build_instruction(spark, *folders, str(tmp_path), SMALL)
    assert shard_files(tmp_path / "lines", "json") == [
        "split=test/shard_idx=0",
        *[f"split=train/shard_idx={i}" for i in range(4)],
    ]
    names = {}
    for path in (tmp_path / "lines").rglob("*.json"):
        raw = path.read_text("utf-8")
        assert "\\u" not in raw and "ꞌ" in raw
        found = []
        for line in raw.splitlines():
            sample = json.loads(line)
            url = sample["image_info"][0]["image_url"]
            assert sample["image_info"][0]["matched_text_index"] == 0
            assert url.startswith("./assets/") and url.endswith(".png")
            assert sample["text_info"][0] == {"text": "OCR:", "tag": "mask"}
            assert sample["text_info"][1]["tag"] == "no_mask"
            found.append(url.removeprefix("./assets/"))
        shard = path.parent
        names[(shard.parent.name.split("=")[1], int(shard.name.split("=")[1]))] = found
    assets = spark.read.parquet(f"{tmp_path}/assets").collect()
    assert {(a.split, a.shard_idx): [f.arcname for f in a.files] for a in assets} == names
    assert all(a.members == len(a.files) and a.total_bytes >= 20480 * a.members for a in assets)


def test_image_checks(spark):
    sizes = [(640, 480), (200, 800), (1000, 200), (199, 400), (1001, 200), (200, 801)]
    rows = [(i, png(w, h, 60)) for i, (w, h) in enumerate(sizes)] + [(9, b"GIF89a"), (10, None)]
    df = spark.createDataFrame(rows, "id int, content binary")
    got = {r.id: (r.width, r.height, r.reject_reason) for r in checked_images(df).collect()}
    assert got == {
        0: (640, 480, None), 1: (200, 800, None), 2: (1000, 200, None), 3: (199, 400, "too small"),
        4: (1001, 200, "too extreme"), 5: (200, 801, "too extreme"), 9: (None, None, "unreadable"),
        10: (None, None, "unreadable"),
    }


def test_failed_samples_go_to_quarantine(spark):
    df = spark.createDataFrame([("a", "x", 1), ("b", None, 1), ("c", None, None)], "k string, t string, n int")
    usable, failed = split_usable(df, ["t", "n"], "read", "k")
    assert [r.k for r in usable.collect()] == ["a"]
    assert {tuple(r) for r in failed.collect()} == {("b", "read", "missing t"), ("c", "read", "missing t, n")}


def test_impossible_png_size_is_null(spark):
    from glyphmill.functions.png import png_size

    head = bytes.fromhex("89504E470D0A1A0A") + bytes(4) + b"IHDR"
    df = spark.createDataFrame([(bytearray(head + b"\xff" * 4 + bytes([0, 0, 1, 0])),)], "content binary")
    assert df.select(png_size(df.content)).first()[0] is None
