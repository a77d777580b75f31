"""Cutting one text into blocks of at most 600 characters, as one narrow expression.

No shuffle and no Python worker. Spark copies a fold's state at every step, so
the folds here see lengths only and answer one letter per piece: where blocks
open and close. They run in stretches, so even the letters are copied seldom.
The blocks are then sliced from the pieces, and the time stays in line with the
length of the text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from glyphmill.functions.text import WS_RUN, is_index_like, is_noise, let, strip, words

# Fixed values of the block rules.
MIN_TEXT_CHARS = 200
MAX_BLOCK_CHARS = 600
TARGET_LOW = 200
TARGET_SPAN = 401
LCG_MULTIPLIER = 1103515245
LCG_INCREMENT = 12345
LCG_MASK = 0x7FFFFFFF

SENTENCE_GAP = rf"(?<=[.!?]){WS_RUN}"

# What a piece does to the block being filled.
KEEP, OPEN, CLOSE, LONG = "k", "o", "c", "l"

_STRETCH = 1000
_NO_BLOCKS = "cast(array() as array<string>)"


def next_state(state: Column) -> Column:
    # Masked first: the low 31 bits are all that count and the product cannot overflow.
    mask = F.lit(LCG_MASK).cast("long")
    return (state.bitwiseAND(mask) * LCG_MULTIPLIER + LCG_INCREMENT).bitwiseAND(mask)


def target_size(state: Column) -> Column:
    return (state % TARGET_SPAN + TARGET_LOW).cast("int")


def _marks(
    pieces: Column,
    start: dict[str, Column],
    step: Callable[[Column, Column], tuple[Column, dict[str, Column]]],
) -> Column:
    """One letter per piece, as an array.

    ``step(state, length)`` gives the letter and the next state. The outer fold
    goes over stretches of pieces, the inner one over the pieces of a stretch.
    """
    last = F.floor((F.greatest(F.size(pieces), F.lit(1)) - 1) / _STRETCH).cast("int")
    stretches = F.transform(
        F.sequence(F.lit(0), last),
        lambda k: F.transform(F.slice(pieces, k * _STRETCH + 1, _STRETCH), F.length),
    )

    def state(values: dict[str, Column], marks: Column) -> Column:
        return F.struct(*[v.alias(k) for k, v in values.items()], marks.alias("marks"))

    def one(acc: Column, n: Column) -> Column:
        mark, values = step(acc, n)
        return state(values, F.concat(acc["marks"], mark))

    def stretch(acc: Column, lengths: Column) -> Column:
        return F.aggregate(
            lengths,
            state({k: acc[k] for k in start}, F.lit("")),
            one,
            lambda end: state({k: end[k] for k in start}, F.concat(acc["marks"], end["marks"])),
        )

    folded = F.aggregate(stretches, state(start, F.lit("")), stretch, lambda end: end["marks"])
    return F.split(folded, "")


def _runs(
    n: Column,
    opens: Callable[[Column], Column],
    build: Callable[[Column, Column], Column],
) -> Column:
    """``build(first, past)`` for each run of the pieces 1..n; ``opens(i)`` says where one starts."""
    starts = F.filter(F.sequence(F.lit(1), n), lambda i: (i == 1) | opens(i))
    made = let(
        starts,
        lambda at: F.transform(at, lambda i, k: build(i, F.coalesce(F.get(at, k + 1), n + 1))),
    )
    return F.when(n > 0, made)


def _mark(marks: Column, i: Column) -> Column:
    return F.get(marks, i - 1)


def _glued(pieces: Column, sep: str, first: Column, past: Column) -> Column:
    return F.array_join(F.slice(pieces, first, past - first), sep)


def _pack_words(sentence: Column) -> Column:
    """Words packed to the limit. A first word over the limit leaves an empty block before it."""

    def step(acc: Column, n: Column) -> tuple[Column, dict[str, Column]]:
        over = acc["len"] + 1 + n > MAX_BLOCK_CHARS
        return (
            F.when(over, OPEN).otherwise(KEEP),
            {"len": F.when(over, n).otherwise(acc["len"] + 1 + n)},
        )

    def blocks(v: Column) -> Column:
        ws, marks = v["pieces"], v["marks"]
        packed = _runs(
            F.size(ws),
            lambda i: _mark(marks, i) == OPEN,
            lambda i, j: _glued(ws, " ", i, j),
        )
        return F.when(marks[0] == OPEN, F.concat(F.array(F.lit("")), packed)).otherwise(packed)

    return _with_marks(words(sentence), {"len": F.lit(-1)}, step, blocks)


def _with_marks(pieces, start, step, body) -> Column:
    def marked(p: Column) -> Column:
        return let(F.struct(p.alias("pieces"), _marks(p, start, step).alias("marks")), body)

    return let(pieces, marked)


def sentences(paragraph: Column) -> Column:
    """Sentences of a stripped paragraph; cutting out the gaps leaves them stripped too."""
    return F.filter(
        F.split(paragraph, SENTENCE_GAP), lambda s: (s != "") & ~is_noise(s)
    )


def pack_sentences(paragraph: Column) -> Column:
    """Blocks of a stripped paragraph over the limit.

    Sentences are packed greedily. A sentence over the limit goes out at once as
    packed words, ahead of the sentences still waiting.
    """

    def step(acc: Column, n: Column) -> tuple[Column, dict[str, Column]]:
        long = n > MAX_BLOCK_CHARS
        over = acc["len"] + n + 1 > MAX_BLOCK_CHARS
        return (
            F.when(long, LONG).when(over, OPEN).otherwise(KEEP),
            {
                "len": F.when(long, acc["len"]).when(over, n).otherwise(acc["len"] + n + 1),
            },
        )

    def blocks(v: Column) -> Column:
        pieces, marks = v["pieces"], v["marks"]
        # Positions of the sentences that wait in a buffer, and of those that do not.
        every = F.when(F.size(pieces) > 0, F.sequence(F.lit(1), F.size(pieces)))
        waiting = F.filter(every, lambda i: _mark(marks, i) != LONG)
        long = F.filter(every, lambda i: _mark(marks, i) == LONG)

        def in_order(at: Column) -> Column:
            # A buffer goes out when the next one opens, a long sentence where it stands.
            buffers = _runs(
                F.size(at),
                lambda k: _mark(marks, _at(at, k)) == OPEN,
                lambda k, past: F.struct(
                    F.coalesce(_at(at, past), F.size(pieces) + 1).alias("place"),
                    F.array(
                        F.array_join(
                            F.transform(F.slice(at, k, past - k), lambda i: _at(pieces, i)), "\n"
                        )
                    ).alias("blocks"),
                ),
            )
            cut = F.transform(
                long,
                lambda i: F.struct(
                    i.alias("place"), _pack_words(_at(pieces, i)).alias("blocks")
                ),
            )
            no_events = F.slice(cut, 1, 0)
            events = F.array_sort(F.concat(F.coalesce(buffers, no_events), cut))
            return F.flatten(F.transform(events, lambda e: e["blocks"]))

        return F.coalesce(let(waiting, in_order), F.expr(_NO_BLOCKS))

    return _with_marks(sentences(paragraph), {"len": F.lit(0)}, step, blocks)


def _at(items: Column, i: Column) -> Column:
    """The i-th item, counted from 1; null past the end."""
    return F.get(items, i - 1)


def paragraphs(text: Column) -> Column:
    """Stripped paragraphs without blank, noise and index-like ones."""
    return F.filter(
        F.transform(F.split(text, r"[\r\n]+"), strip),
        lambda p: (p != "") & ~is_noise(p) & ~is_index_like(p),
    )


def split_blocks(text: Column, seed: Column) -> Column:
    """The blocks of ``text`` in order, as ``ARRAY<STRING>``; none below 200 characters.

    Paragraphs are collected until a drawn target (200 to 600 characters) is
    reached. ``seed`` starts the draw of the targets.
    """

    def step(acc: Column, n: Column) -> tuple[Column, dict[str, Column]]:
        long = n > MAX_BLOCK_CHARS
        size = acc["len"] + n + 2
        over = size > MAX_BLOCK_CHARS
        reached = size >= target_size(acc["rng"])
        redraw = F.when(long, acc["len"] > 0).otherwise(over | reached)
        return (
            F.when(long, LONG).when(over, OPEN).when(reached, CLOSE).otherwise(KEEP),
            {
                "len": F.when(long, 0).when(over, n).when(reached, 0).otherwise(size),
                "rng": F.when(redraw, next_state(acc["rng"])).otherwise(acc["rng"]),
            },
        )

    def blocks(v: Column) -> Column:
        pieces, marks = v["pieces"], v["marks"]
        made = _runs(
            F.size(pieces),
            lambda i: _mark(marks, i).isin(OPEN, LONG) | _mark(marks, i - 1).isin(CLOSE, LONG),
            lambda i, j: F.when(_mark(marks, i) == LONG, pack_sentences(_at(pieces, i))).otherwise(
                F.array(_glued(pieces, "\n\n", i, j))
            ),
        )
        return F.coalesce(F.flatten(made), F.expr(_NO_BLOCKS))

    start = {"len": F.lit(0), "rng": next_state(seed.cast("long"))}

    def long_enough(t: Column) -> Column:
        out = _with_marks(paragraphs(t), start, step, blocks)
        return F.when(F.length(t) >= MIN_TEXT_CHARS, out).otherwise(F.expr(_NO_BLOCKS))

    # The text may be a long expression, such as its cleaning: evaluated once.
    return let(text, long_enough)
