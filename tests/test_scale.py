"""Numbering, CSV files and word distances where one task, one window or the built-in does not do."""

from __future__ import annotations

import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from glyphmill.functions import distances
from glyphmill.operators import evaluate as E
from glyphmill.operators import numbering
from glyphmill.operators.chunks import plan_chunks
from glyphmill.operators.numbering import ROW, in_ordinal_order, run_starts
from glyphmill.session import materialize
from glyphmill.sources.corpus import csv_records, read_corpus

from brute import distance as edit_distance


def test_starts_of_many_runs(spark):
    rng = random.Random(1)
    runs = [(r, rng.randrange(1, 5)) for r in rng.sample(range(10_000), 700)]
    rows = [(r, i) for r, n in runs for i in range(n)]
    df = spark.createDataFrame(rows, "run long, i long").repartition(13).withColumn(ROW, F.col("run") * 100 + F.col("i"))
    got = {r.run: (r._first_row, r._before) for r in run_starts(materialize(df, "runs"), ["run"], "run").collect()}
    want, before = {}, 0
    for r, n in sorted(runs):
        want[r], before = (r * 100, before), before + n
    assert got == want


def test_no_window_holds_all_runs(spark):
    df = materialize(spark.range(1000).select(F.col("id").alias("run"), F.col("id").alias(ROW)), "runs")
    plan = run_starts(df, ["run"], "run")
    assert "SinglePartition" not in plan._jdf.queryExecution().executedPlan().toString()


def test_skewed_texts_make_even_tasks(spark, monkeypatch):
    monkeypatch.setattr(numbering, "TASK_BYTES", 100_000)
    # The first twentieth of the rows holds nine tenths of the text.
    rows = spark.range(1, 4001).select(
        F.col("id").alias("row_ordinal"), F.expr("repeat('x', IF(id <= 200, 4500, 26))").alias("text")
    )
    placed = in_ordinal_order(rows, "row_ordinal", F.octet_length("text")).withColumn("task", F.spark_partition_id())
    sizes = [r.n for r in placed.groupBy("task").agg(F.sum(F.length("text")).alias("n")).collect()]
    assert len(sizes) >= 10 and max(sizes) < 1.5 * sum(sizes) / len(sizes)
    order = placed.groupBy("task").agg(F.min("row_ordinal").alias("a"), F.max("row_ordinal").alias("b")).orderBy("a").collect()
    assert all(x.b < y.a for x, y in zip(order, order[1:])) and order[0].a == 1 and order[-1].b == 4000
    assert in_ordinal_order(rows.filter("row_ordinal < 0"), "row_ordinal", F.octet_length("text")).count() == 0


def test_chunk_numbers_do_not_depend_on_tasks(spark, monkeypatch):
    text = "concat('id', id, repeat(concat(' word', id), IF(id % 50 = 0, 3000, 60)))"
    rows = spark.range(1, 301).select(
        F.col("id").alias("row_ordinal"), F.concat(F.lit("r"), "id").alias("id"), F.lit("zpo").alias("language"), F.expr(text).alias("text")
    )
    one = plan_chunks(rows).collect()
    monkeypatch.setattr(numbering, "TASK_BYTES", 20_000)
    many = plan_chunks(rows.repartition(3)).collect()
    assert sorted(map(tuple, one)) == sorted(map(tuple, many))
    assert sorted(r.chunk_no for r in many) == list(range(1, len(many) + 1))


@pytest.fixture
def split_size(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def quoted_csv(path, rows, seed, ends="\n"):
    rng, out = random.Random(seed), ["id,language,text"]
    for i in range(rows):
        words = ["plain", "with, comma", 'say ""so""', "\n", "\n\n", "é ꞌ", "end"]
        text = " ".join(rng.choice(words) for _ in range(rng.choice([0, 1, 5, 40, 600 if i % 97 == 0 else 3])))
        out.append(f'r-{i},{rng.choice(["zpo", "", chr(34) * 2])},"{text}"' if rng.random() < 0.8 else f"r-{i},mir" + ",short" * rng.randrange(2))
        if rng.random() < 0.05:
            out.append("")
    path.write_bytes((ends.join(out) + ends * rng.randrange(2)).encode())


@pytest.mark.parametrize("ends", ["\n", "\r\n"])
def test_large_csv_by_many_tasks(spark, tmp_path, split_size, ends):
    folder = tmp_path / "in"
    folder.mkdir()
    for n, name in enumerate(("b.csv", "a.csv", "c.csv")):
        quoted_csv(folder / name, 150, n, ends)
    one = read_corpus(spark, str(folder)).orderBy("row_ordinal").collect()
    many = read_corpus(spark, str(folder), many_tasks=True).orderBy("row_ordinal").collect()
    assert [r.row_ordinal for r in many] == list(range(1, len(one) + 1)) == list(range(1, 451))
    assert many == one
    records = csv_records(spark, str(folder))
    assert records.select("_file", "_split").distinct().count() > 10


def test_a_field_over_many_splits(spark, tmp_path, split_size):
    path = tmp_path / "c.csv"
    text = "\n".join(f"line {i}" for i in range(3000))
    path.write_text(f'id,text\na,"{text}"\nb,two\nc,"{text}"')
    rows = read_corpus(spark, str(path), many_tasks=True).orderBy("row_ordinal").collect()
    assert [(r.row_ordinal, r.id, r.text) for r in rows] == [(1, "a", text), (2, "b", "two"), (3, "c", text)]


def test_quotes_that_do_not_pair_are_an_error(spark, tmp_path):
    (tmp_path / "c.csv").write_text('id,text\na,5" wide\n')
    with pytest.raises(ValueError, match="one task"):
        read_corpus(spark, str(tmp_path / "c.csv"), many_tasks=True)


def test_distances_of_numbers():
    rng = random.Random(1)
    for _ in range(500):
        a = [rng.randrange(6) for _ in range(rng.randrange(25))]
        b = list(a) if rng.random() < 0.6 else [rng.randrange(6) for _ in range(rng.randrange(25))]
        for _ in range(rng.randrange(4)):
            b.insert(rng.randrange(len(b) + 1), rng.randrange(6))
        x, y, want = np.array(a, dtype=int), np.array(b, dtype=int), edit_distance(a, b)
        assert distances.distance(x, y) == want == distances._by_bits(x, y)
        assert distances._along_diagonals(x, y, want) == want
        assert want == 0 or distances._along_diagonals(x, y, want - 1) is None


def test_distances_of_many_pairs_of_any_numbers():
    rng = random.Random(2)
    pairs = [([], []), ([], [7] * 40), ([1, 2, 3], [])]
    for most in (6, 300, 70_000):
        for _ in range(200):
            a = [rng.randrange(most) for _ in range(rng.randrange(40))]
            b = list(a) if rng.random() < 0.6 else [rng.randrange(most) for _ in range(rng.randrange(40))]
            for _ in range(rng.randrange(6)):
                b.insert(rng.randrange(len(b) + 1), rng.randrange(most))
            pairs.append((a, b))
    got = distances.distances(*([np.array(side, dtype=int) for side in sides] for sides in zip(*pairs)))
    assert got.tolist() == [edit_distance(a, b) for a, b in pairs]


def edited_numbers(rng, a, most, share):
    """``a`` with a share of its numbers changed, dropped or doubled."""
    b = []
    for x in a:
        what = rng.random() / share if share else 1
        b += [x] if what >= 1 else [rng.randrange(most)] if what < 0.5 else [] if what < 0.75 else [x, rng.randrange(most)]
    return b


@pytest.mark.parametrize("words", [1 << 20, 200])
@pytest.mark.parametrize("rows", [64, 128, 1024])
def test_distances_through_blocks(monkeypatch, rows, words):
    # Every pair goes through blocks, in many parts or few, with few blocks side by side, with tables of places or without.
    monkeypatch.setattr(distances, "PART_ROWS", rows)
    monkeypatch.setattr(distances, "PLACE_WORDS", words)
    monkeypatch.setattr(distances, "BLOCK_ROOM", 100)
    rng = random.Random(rows + words)
    pairs = []
    for most in (1, 2, 4, 30, 1000):
        for n in (1, 63, 64, 65, 128, 300, 520):
            a = [rng.randrange(most) for _ in range(n)]
            at = rng.randrange(n)
            others = [edited_numbers(rng, a, most, share) for share in (0, 0.02, 0.1, 0.4)]
            # A part is missing, comes twice, or is elsewhere; nothing in common.
            others += [a[:at] + a[at + 150 :], a + a[at : at + 150], a[at:] + a[:at], a[::-1], [most + x for x in a[:200]]]
            pairs += [(np.array(a), np.array(b, dtype=int)) for b in others if b]
    a, b = map(list, zip(*pairs))
    want = [distances._by_bits(x, y) for x, y in pairs]
    found = np.full(len(pairs), -1)
    for group in distances._Blocks.of(a, b):
        found[group.places] = group.distances()
    assert found.tolist() == want == distances.distances(a, b).tolist()


def test_repeated_passages_are_cut_in_the_right_place_or_found_out(monkeypatch):
    monkeypatch.setattr(distances, "PART_ROWS", 128)
    rng = random.Random(4)
    pairs = []
    for period in (3, 40, 90, 200):
        a = [rng.randrange(20) for _ in range(period)] * (1500 // period)
        for b in (a[period:], a[: len(a) // 2] + a[len(a) // 2 + period :], edited_numbers(rng, a, 20, 0.05), edited_numbers(rng, a[2 * period :], 20, 0.1)):
            pairs.append((np.array(a), np.array(b)))
    a, b = map(list, zip(*pairs))
    (group,) = distances._Blocks.of(a, b)
    assert group.distances().tolist() == [distances._by_bits(x, y) for x, y in pairs]


def test_time_does_not_grow_with_the_square_of_the_edits():
    # Along diagonals alone four times the edits took seven times as long.
    rng = random.Random(6)
    a = [[rng.randrange(40) for _ in range(20_000)] for _ in range(24)]

    def seconds(share):
        b = [np.array(edited_numbers(rng, x, 40, share)) for x in a]
        started = time.process_time()
        found = distances.distances([np.array(x) for x in a], b)
        took = time.process_time() - started
        assert (found > 0.6 * share * 20_000).all()
        return took

    few, many = min(seconds(0.03) for _ in range(2)), min(seconds(0.12) for _ in range(2))
    assert many < 4 * few


def test_word_rate_of_more_words_than_code_points(spark):
    n = 1_100_000
    expected = {"a": 4 / n, "b": 0.5}
    made = spark.range(1).select(
        F.lit("a").alias("id"),
        F.expr(f"array_join(transform(sequence(1, {n}), i -> 'w' || i), ' ')").alias("ground_truth"),
        F.expr(
            f"array_join(transform(sequence(1, {n}), i -> CASE WHEN i IN (2, {n - 1}) THEN 'x' WHEN i = 500000 THEN 'two words' ELSE 'w' || i END), ' ')"
        ).alias("raw"),
        F.lit("").alias("finetuned"),
    )
    plain = spark.createDataFrame([("b", "one two", "one too", "one two")], "id string, ground_truth string, raw string, finetuned string")
    rows = E.stored_scores(E.with_record_defaults(made.unionByName(plain))).collect()
    assert {r.id: r.raw_wer for r in rows} == pytest.approx(expected)
    assert {r.id: r.ft_wer for r in rows} == {"a": 1.0, "b": 0.0}
    assert 0 < {r.id: r.raw_cer for r in rows}["a"] < 40 / n


def test_long_and_short_texts_score_alike(spark, monkeypatch):
    rng = random.Random(3)
    rows = []
    for i in range(30):
        truth = " ".join(rng.choice(["one", "two", "ꞌéx", "four\n"]) for _ in range(rng.randrange(60)))
        raw = "".join(c for c in truth if rng.random() > 0.1)
        rows.append((i, str(i), "zpo", truth, raw, truth[5:] + "x" if i % 3 else " "))
    df = spark.createDataFrame(rows, "pos int, id string, language string, ground_truth string, raw string, finetuned string")
    short = sorted(map(tuple, E.stored_scores(df).collect()))
    monkeypatch.setattr(E, "LONG_TEXT", 20)
    long = sorted(map(tuple, E.stored_scores(df).collect()))
    assert [r[:3] for r in long] == [r[:3] for r in short]
    assert [r[3:] for r in long] == [pytest.approx(r[3:]) for r in short]


def test_scores_and_problems_come_from_one_pass(spark):
    from glyphmill.plans.evaluation import compare_systems

    truth = spark.createDataFrame([("a", "zpo", "abcd"), ("b", "mir", "xy"), ("c", "mir", "z")], "id string, language string, ground_truth string")
    one = spark.createDataFrame([("a", "abce"), ("a", "abcd"), ("z", "no")], "id string, text string")
    two = spark.createDataFrame([("a", "abcd"), ("b", "xy"), ("c", None)], "id string, text string")
    scored, problems = compare_systems(truth, {"one": one, "two": two}, with_problems=True)
    assert {(r.system, r.id, r.problem) for r in problems.collect()} == {
        (p.system, p.id, p.problem) for p in E.prediction_problems(truth, {"one": one, "two": two}).collect()
    } == {("one", "a", "duplicate"), ("one", "b", "missing"), ("one", "c", "missing"), ("one", "z", "unknown")}
    assert {r.id: (r.one_cer, r.two_cer) for r in scored.collect()} == {"a": (0.0, 0.0), "b": (1.0, 0.0), "c": (1.0, 1.0)}
