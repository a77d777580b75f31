import random
import subprocess
import sys
import time

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from glyphmill.functions import metrics as M

from brute import distance, rate

HAND_MADE = [
    ("", "", 0.0, 0.0),
    ("", "a", 1.0, 1.0),
    ("abc", "", 1.0, 1.0),
    ("a b", "a  b", 1 / 3, 0.0),
    ("é", "e", 1.0, 1.0),
    ("a", "b c d", 5.0, 3.0),
    ("  ", "x", 1.0, 1.0),
    ("ɨꞌ𝒳", "i'𝒳", 2 / 3, 1.0),
]


@pytest.fixture
def pairs(spark):
    def rows(data):
        return spark.createDataFrame(
            [(i, a, b) for i, (a, b) in enumerate(data)], "i int, a string, b string"
        )

    return rows


def by_row(df, expression):
    got = df.select("i", expression(F.col("a"), F.col("b")).alias("v")).collect()
    return [r.v for r in sorted(got, key=lambda r: r.i)]


def test_hand_made_rates(pairs):
    df = pairs([row[:2] for row in HAND_MADE])
    assert by_row(df, M.cer) == pytest.approx([row[2] for row in HAND_MADE])
    assert by_row(df, M.wer) == pytest.approx([row[3] for row in HAND_MADE])


def test_null_text_has_no_rate(pairs):
    assert by_row(pairs([(None, "a"), ("a", None)]), M.cer) == [None, None]


def random_pairs(n, longest, alphabet, seed):
    rng = random.Random(seed)
    for _ in range(n):
        a = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, longest)))
        b = list(a)
        for _ in range(rng.choice([0, 1, 5, longest])):
            at = rng.randint(0, len(b))
            b[at : at + rng.randint(0, 2)] = rng.choice(alphabet) * rng.randint(0, 2)
        yield a, "".join(b)


def test_edit_distance_matches_the_full_table(pairs):
    # Distances on both sides of the first two bands, and of zero.
    data = list(random_pairs(150, 300, "aé𝒳 　b", 7))
    df = pairs(data)
    expected = [distance(a, b) for a, b in data]
    assert by_row(df, M.edit_distance) == expected
    assert by_row(df, lambda a, b: M.edit_distance(b, a)) == expected
    assert max(expected) > 128 and min(expected) == 0


def test_edit_distance_beyond_every_band(pairs):
    data = [("a" * 3000, "b" * 2500), ("ab" * 1500, "ba" * 1500), ("x" * 5000, "")]
    assert by_row(pairs(data), M.edit_distance) == [3000, 2, 5000]


def test_wer_matches_word_lists(pairs):
    data = list(random_pairs(150, 200, "ab é \n", 11))
    expected = [rate(a.split(), b.split()) for a, b in data]
    assert by_row(pairs(data), M.wer) == pytest.approx(expected)


def test_many_distinct_words(pairs):
    many = [f"w{i}" for i in range(3_000)]
    data = [(" ".join(many), " ".join(many[:500] + many[501:])), (" ".join(many), "")]
    assert by_row(pairs(data), M.wer) == pytest.approx([1 / 3_000, 1.0])


def test_words_of_one_side_and_of_both(pairs):
    rng = random.Random(5)
    words = ["a", "b", "é", "zz", "𝒳", "a b".replace(" ", "-")]
    data = []
    for _ in range(120):
        both = [rng.choice(words) for _ in range(rng.randint(0, 40))]
        x = [w if rng.random() < 0.8 else f"x{rng.randint(0, 3)}" for w in both]
        y = [w if rng.random() < 0.8 else f"y{rng.randint(0, 3)}" for w in both if rng.random() < 0.9]
        data.append((" ".join(x), " ".join(y)))
    assert by_row(pairs(data), M.wer) == pytest.approx([rate(a.split(), b.split()) for a, b in data])


def test_long_near_equal_word_lists(pairs):
    many = [f"w{i}" for i in range(40_000)]
    other = [w if i % 4_000 else "new" for i, w in enumerate(many)]
    assert by_row(pairs([(" ".join(many), " ".join(other))]), M.wer) == pytest.approx([10 / 40_000])


def test_long_texts_take_the_time_of_their_edits(pairs):
    # The built-in distance took the square of the length: minutes for this pair.
    rng = random.Random(9)
    a = "".join(rng.choice("abcd é") for _ in range(400_000))
    b = "x" + a[:200_000] + a[200_001:] + "x"
    started = time.monotonic()
    assert by_row(pairs([(a, b)]), M.edit_distance) == [3]
    assert time.monotonic() - started < 60


def test_distances_are_sent_with_the_query(tmp_path):
    # An executor without this library on its path takes the function alone.
    run = "import pickle, sys, pandas as pd; f = pickle.loads(sys.stdin.buffer.read()); print(f(pd.Series(['a b c']), pd.Series(['a c']))['edits'].tolist())"
    sent = cloudpickle.dumps(M._words_apart)
    done = subprocess.run([sys.executable, "-I", "-c", run], input=sent, cwd=tmp_path, capture_output=True, check=True)
    assert done.stdout.split() == [b"[1]"]


def test_distance_bounds(pairs):
    data = list(random_pairs(60, 80, "abc", 3))
    for (a, b), d in zip(data, by_row(pairs(data), M.edit_distance)):
        assert abs(len(a) - len(b)) <= d <= max(len(a), len(b))
        assert (d == 0) == (a == b)


def test_percent_rounds_like_the_printed_tables(spark):
    values = [0.0, 1 / 160, 3 / 160, 0.26815 / 10, 0.1045, 1.0508, 25.5, 1 / 3, 0.00125]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    got = df.select(
        "i",
        M.percent(F.col("v")).alias("two"),
        M.percent(F.col("v"), 1).alias("one"),
        M.percent(F.col("v") - 0.5, signed=True).alias("signed"),
    ).orderBy("i")
    assert [tuple(r)[1:] for r in got.collect()] == [
        (f"{v:.2%}", f"{v:.1%}", f"{v - 0.5:+.2%}") for v in values
    ]
