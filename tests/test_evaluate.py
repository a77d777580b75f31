import json

import pytest
from pyspark.sql import functions as F

from glyphmill.operators import evaluate as E
from glyphmill.operators.runlog import error_rows, progress_line
from glyphmill.plans.evaluation import compare_systems, evaluate_file
from glyphmill.sources.records import read_records
from glyphmill.sources.sinks import write_records

from brute import rate

WORDS = ["neꞌ", "maɨ", "tla", "kuali", "in", "ye", "omo"]


def sample(i):
    truth = " ".join(WORDS[(i * k) % len(WORDS)] for k in range(1, 9))
    return {
        "id": f"zpo_{i}", "language": WORDS[i % 3][:3], "ground_truth": truth,
        "raw": truth.replace("a", "e", i % 4), "finetuned": truth[: len(truth) - i % 3],
    }


def write_json(path, records):
    path.write_text(json.dumps(records, ensure_ascii=False, indent=1), "utf-8")
    return str(path)


def expected_rates(records):
    for r in records:
        t, a, b = r["ground_truth"], r["raw"], r["finetuned"]
        yield rate(t, a), rate(t, b), rate(t.split(), a.split()), rate(t.split(), b.split())


@pytest.mark.parametrize("n", [1, 30, 50, 51, 137])
def test_report_and_summary_of_a_file(spark, tmp_path, n):
    records = [sample(i) for i in range(n)]
    report, lines = evaluate_file(spark, write_json(tmp_path / "r.json", records))
    rates = list(expected_rates(records))
    shown = [i for i in range(n) if n <= 50 or i % (n // 20) == 0 or i == n - 1]
    rows = [tuple(r) for r in report.orderBy("row_no").collect()]
    mean = [sum(column) / n for column in zip(*rates)]
    printed = [
        (i, records[i]["id"], records[i]["language"], *[f"{v:.2%}" for v in rates[i]],
         f"{rates[i][0] - rates[i][1]:+.2%}")
        for i in shown
    ]
    assert rows[:-1] == printed
    assert rows[-1] == (n, "AVERAGE", "", *[f"{v:.2%}" for v in mean], f"{mean[0] - mean[1]:+.2%}")
    raw, ft, raw_wer, ft_wer = mean
    assert [tuple(r) for r in lines.orderBy("line_no").collect()] == [
        (0, "Overall Raw CER", f"{raw:.2%}"),
        (1, "Overall Finetuned CER", f"{ft:.2%}"),
        (2, "Overall Raw WER", f"{raw_wer:.2%}"),
        (3, "Overall Finetuned WER", f"{ft_wer:.2%}"),
        (4, "Overall Raw Accuracy (1-CER)", f"{1 - raw:.2%}"),
        (5, "Overall Finetuned Accuracy (1-CER)", f"{1 - ft:.2%}"),
        (6, "CER Improvement", f"{raw - ft:+.2%}"),
        (7, "WER Improvement", f"{raw_wer - ft_wer:+.2%}"),
        (8, "Relative CER Reduction", f"{(raw - ft) / raw if raw > 0 else 0:.1%}"),
    ]


def test_no_records_give_no_rows(spark, tmp_path):
    report, lines = evaluate_file(spark, write_json(tmp_path / "r.json", []))
    assert report.count() == 0 and lines.count() == 0


def test_missing_fields(spark, tmp_path):
    path = write_json(tmp_path / "r.json", [{"text": "abc", "raw": "abd"}, {"id": "x", "ground_truth": None}])
    rows = E.with_record_defaults(read_records(spark, path)).orderBy("pos").collect()
    assert [tuple(r) for r in rows] == [
        (0, "0", "unk", "abc", "abd", ""),
        (1, "x", "unk", "", "", ""),
    ]


def test_any_number_of_systems(spark):
    truth = spark.createDataFrame([(i, "zpo", "abcd efgh") for i in range(5)], "id int, language string, ground_truth string")
    hyp = lambda text: truth.select("id", F.lit(text).alias("text"))
    scored = compare_systems(truth, {"base": hyp("abcd efgx"), "good": hyp("abcd efgh"), "bad": hyp("")})
    summed = E.summary(scored, {n: n for n in ("base", "good", "bad")}).first()
    assert summed.base_cer == pytest.approx(1 / 9) and summed.good_cer == 0 and summed.bad_cer == 1
    assert summed.good_relative_cer_reduction == 1.0
    assert summed.bad_cer_improvement == pytest.approx(1 / 9 - 1)


def test_prediction_problems(spark):
    truth = spark.createDataFrame([(1,), (2,), (3,)], "id int")
    predicted = spark.createDataFrame([(1, "a"), (1, "b"), (9, "c")], "id int, text string")
    got = E.prediction_problems(truth, {"raw": predicted}).collect()
    assert {(r.id, r.problem) for r in got} == {(2, "missing"), (3, "missing"), (9, "unknown"), (1, "duplicate")}


def test_export_is_read_back(spark, tmp_path):
    records = [sample(i) for i in range(10)]
    df = E.with_record_defaults(read_records(spark, write_json(tmp_path / "r.json", records)))
    write_records(E.export_columns(df), str(tmp_path / "out"))
    lines = [line for p in (tmp_path / "out").glob("*.json") for line in p.read_text("utf-8").splitlines()]
    assert sorted(map(json.loads, lines), key=str) == sorted(records, key=str)
    assert any("ꞌ" in line for line in lines)


def test_rows_by_position(spark):
    df = spark.range(100).withColumnRenamed("id", "pos")
    assert E.first_rows(df, 7).count() == 7
    assert E.row_at(df, 20).first().pos == 20


def test_run_log_texts(spark):
    one = spark.range(1)
    line = one.select(progress_line(F.lit(5), F.lit(40), F.lit(4), F.lit(9), F.lit(1.26)).alias("l")).first().l
    assert line == "PROGRESS: 12.5% | Row: 5/40 | Effective: 4 | Chunks: 9 | Output: 1.3MB"
    error = error_rows(one, "id", "render", F.lit("a\nb" + "x" * 600)).first()
    assert error.key == "0" and error.error == "a b" + "x" * 497


def test_duplicate_predictions_score_once(spark):
    truth = spark.createDataFrame([("a", "x", "abc")], "id string, language string, ground_truth string")
    twice = spark.createDataFrame([("a", "abd"), ("a", "abc")], "id string, text string")
    joined = E.join_predictions(truth, {"raw": twice, "finetuned": twice})
    assert [(r.raw, r.finetuned) for r in joined.collect()] == [("abc", "abc")]


def test_eval_documents_matches_the_full_table(spark, tmp_path):
    # Its SQL would need the whole table of every long text, so brute force on a few stands in.
    from glyphmill.plans.queries import FT_EDITS, RAW_EDITS, eval_documents

    texts = ["", "the nation de la é er the end", "ê und er de tion " * 30, " a\n　b ", "de " * 40 + "the er"]
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(texts)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/documents.parquet")

    def edited(text, edits):
        for old, new in edits:
            text = text.replace(old, new)
        return text

    got = {r.id: r for r in eval_documents(spark, str(tmp_path)).collect()}
    for i, t in enumerate(texts):
        for label, edits in (("raw", RAW_EDITS), ("ft", FT_EDITS)):
            other = edited(t, edits)
            assert got[str(i)][f"{label}_cer"] == pytest.approx(rate(t, other))
            assert got[str(i)][f"{label}_wer"] == pytest.approx(rate(t.split(), other.split()))
