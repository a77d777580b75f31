import itertools
import random

from pyspark.sql import functions as F

from glyphmill.functions import blocks as B

import brute


def random_text(rng):
    def paragraph():
        kind = rng.random()
        if kind < 0.05:
            return rng.choice([". . . . .", "Chapter 1 ..............", "___", "", "   ", "-.-"])
        if kind < 0.1:
            return "w" * rng.randint(550, 1400)
        if kind < 0.2:
            ends = ["", "", ".", "!", ". . ."]
            return " ".join("x" * rng.randint(1, 30) + rng.choice(ends) for _ in range(rng.randint(1, 400)))
        if kind < 0.25:
            return " ".join("é" * rng.randint(1, 900) for _ in range(rng.randint(1, 6)))
        lead = rng.choice(["", " ", "\t", " "])
        return lead + " ".join("y" * rng.randint(1, 12) for _ in range(rng.randint(1, 80)))

    sep = rng.choice(["\n", "\r\n", "\n\n", "\r"])
    return sep.join(paragraph() for _ in range(rng.randint(1, 120)))


def split(spark, texts, seed=42):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, t string")
    rows = df.select("i", B.split_blocks(F.col("t"), F.col("i") + seed).alias("b")).collect()
    return [r.b for r in sorted(rows, key=lambda r: r.i)]


def test_targets_of_the_first_draws(spark):
    state, drawn = F.lit(43).cast("long"), []
    for _ in range(5):
        state = B.next_state(state)
        drawn.append(B.target_size(state))
    assert list(spark.range(1).select(*drawn).first()) == [393, 246, 460, 410, 259]
    assert list(itertools.islice(brute.targets(43), 5)) == [393, 246, 460, 410, 259]


def test_huge_seeds_do_not_overflow(spark):
    seed = 2**62
    text = "\n".join("word " * 30 for _ in range(40))
    df = spark.createDataFrame([(text,)], "t string")
    got = df.select(B.split_blocks(F.col("t"), F.lit(seed)).alias("b")).first().b
    assert got == brute.blocks(text, seed)


def test_edges(spark):
    run = "Hi there. " + " ".join("w" * 50 for _ in range(30))
    texts = ["a" * 199, "a" * 600, "a" * 601, run, "." * 300, ""]
    got = split(spark, texts)
    assert got[:3] == [[], ["a" * 600], ["", "a" * 601]]
    assert got[3][-1] == "Hi there." and len(got[3]) == 4
    assert got[4:] == [[], []]
    assert got == [brute.blocks(t, i + 42) for i, t in enumerate(texts)]


def test_random_texts(spark):
    rng = random.Random(1)
    texts = [random_text(rng) for _ in range(120)]
    got = split(spark, texts)
    assert got == [brute.blocks(t, i + 42) for i, t in enumerate(texts)]
    for block in itertools.chain.from_iterable(got):
        assert len(block) <= 602 or " " not in block


def test_more_pieces_than_one_stretch(spark):
    paragraphs = "\n".join(f"paragraph number {i} of many" for i in range(3500))
    sentences = " ".join(f"Sentence {i} is here." for i in range(3500))
    words = " ".join(f"word{i}" for i in range(3500))
    texts = [paragraphs, sentences, words]
    assert split(spark, texts) == [brute.blocks(t, i + 42) for i, t in enumerate(texts)]
