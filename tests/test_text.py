import random
import re

import pytest
from pyspark.sql import functions as F

from glyphmill.functions import text as T

from brute import BLANKS

CLEANED = [
    ("# Head\ntext", "Head\ntext"),
    ("***a*** **b** *c* __d__ ~~e~~", "a b c d e"),
    ("snake_case_name", "snakecasename"),
    ("_a_", "_a_"),
    ("![alt](u)", "!alt"),
    ("![](u)", ""),
    ("[x](u) and [y][r]", "x and y"),
    ("~~~a~~~", "~a~"),
    ("~~~\ncode\n~~~", ""),
    ("a\n    code\nb", "a\n\nb"),
    ("a\n\tcode\nb", "a\n\nb"),
    ("a\n\n\n\nb   c", "a\n\nb c"),
    ("* item * two", "item two"),
    ("a ```x``` b", "a b"),
    ("a ```x\ny``` b", "a b"),
    ("####### seven", "####### seven"),
    ("x # no header", "x # no header"),
    ("_x y_", "x y"),
    ("___both___", "both"),
    ("", ""),
    (None, None),
]


def test_whitespace_is_the_unicode_set():
    assert set(T.WS_CHARS) == set(BLANKS)


def test_clean_markdown(eval_column):
    assert eval_column([t for t, _ in CLEANED], T.clean_markdown) == [c for _, c in CLEANED]


def test_rules_run_only_on_texts_with_their_marker():
    samples = [t for t, _ in CLEANED if t] + ["```a```", "~~~b~~~", "[a](b)", "[a][b]", "![c](d)"]
    for markers, pattern, _ in T.MARKDOWN_RULES:
        python = re.compile(re.sub(r"^\(\?[mds]+\)", "", pattern), re.M | re.S)
        for sample in samples:
            if python.search(sample):
                assert any(m in sample for m in markers), (pattern, sample)


def test_strip_collapse_and_words_know_all_whitespace(eval_column):
    texts = [f"{w}a{w}{w}b{w}" for w in BLANKS] + ["", BLANKS, "a\r\nb\rc\nd"]
    assert eval_column(texts, T.strip) == [t.strip() for t in texts]
    assert eval_column(texts, T.collapse) == [" ".join(t.split()) for t in texts]
    assert eval_column(texts, T.words) == [t.split() for t in texts]


def test_reflow_keeps_newlines(eval_column):
    texts = ["  a \t b\n\n c ", "a  b", "\n", "x  \n  y"]
    assert eval_column(texts, T.reflow) == [re.sub(r"[ \t]+", " ", t).strip() for t in texts]


def test_repair_escapes(eval_column):
    assert eval_column(["a\\nb\\rc", "a\nb"], T.repair_escapes) == ["a\nb\rc", "a\nb"]


def test_line_stats(eval_column):
    texts = ["ab\ncdef", "a\x0bb\x85c d\r\n", "  \n ", ""]
    expected = []
    for t in texts:
        lines = [line for line in t.splitlines() if line.strip()]
        mean = sum(map(len, lines)) / len(lines) if lines else 0
        expected.append((len(lines), mean, mean / len(lines)) if lines else None)
    got = eval_column(texts, T.line_stats)
    assert [tuple(g) if g else None for g in got] == expected


@pytest.mark.parametrize(
    "text, noise, index_like",
    [
        (". . . . . . . . . . .", True, True),
        ("___", True, False),
        ("", False, False),
        ("-.-", True, False),
        ("Chapter 1 ..............", False, True),
        ("abcdefghij.", False, False),
        ("..........", True, False),
    ],
)
def test_noise_and_index_lines(eval_column, text, noise, index_like):
    assert eval_column([text], T.is_noise) == [noise]
    assert eval_column([text], T.is_index_like) == [index_like]


def test_upper_is_full_unicode(eval_column):
    texts = ["straße", "éꞌɨ", "ﬁ"]
    assert eval_column(texts, lambda c: T.upper_if(F.lit(True), c)) == [t.upper() for t in texts]


def test_sample_key_keeps_letters_digits_and_three_signs(eval_column):
    ids = ["a b/c", "ñꞌ-1.x", "é", "½Ⅷ٣"]
    got = eval_column(
        ids, lambda c: T.sample_key(F.lit("zpo"), c, F.lit(7), F.lit(1.239))
    )
    assert got == [re.sub(r"[^\w\-_\.]", "_", f"zpo_{i}_{7:03d}_{int(1.239 * 100)}ar") for i in ids]
    assert eval_column(["zpo_x"], T.language_of_key) == ["zpo"]


def test_fast_markup_patterns_match_what_the_plain_ones_match(spark):
    """Written for speed: each rule answers like the pattern that says the same plainly."""
    plain = {
        "_": rf"(?d)_([^_{T.WS_CLASS}].*?[^_{T.WS_CLASS}])_",
        "](": r"\[([^\]]+)\]\([^\)]+\)",
        "![": r"!\[([^\]]*)\]\([^\)]+\)",
        "][": r"\[([^\]]+)\]\[[^\]]*\]",
    }
    rng = random.Random(4)
    texts = ["".join(rng.choice("__ab\n\u3000 𝒳é![]]()(") for _ in range(rng.randrange(40))) for _ in range(3000)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    fast = {markers[0]: pattern for markers, pattern, _ in T.MARKDOWN_RULES if markers[0] in plain}
    assert fast.keys() == plain.keys()
    for mark, pattern in fast.items():
        one, other = (F.regexp_replace("t", p, "<$1>") for p in (pattern, plain[mark]))
        assert df.filter(one != other).count() == 0
        assert df.filter(one != F.col("t")).count() > 0
