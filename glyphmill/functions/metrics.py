"""Edit distances and the error rates made from them, as columns."""

from __future__ import annotations

import sys
from collections import defaultdict
from collections.abc import Callable
from itertools import count

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

from glyphmill.functions.distances import distances

# Sent with the query: a rate needs no copy of this library where the executors run.
for _name in (__name__, distances.__module__):
    cloudpickle.register_pickle_by_value(sys.modules[_name])

#: Characters of texts that are held as numbers at a time.
HELD_CHARS = 1 << 24

Numbers = tuple[np.ndarray, np.ndarray]


def edit_distance(a: Column, b: Column) -> Column:
    """Levenshtein distance over code points, exact for every pair of texts.

    The built-in takes the square of the length however few the edits, so Arrow batches of pairs are compared
    along their diagonals and in blocks of bits instead.
    """
    return F.pandas_udf(_characters_apart, "long")(a, b)


def word_edit_distance(a: Column, b: Column) -> Column:
    """Levenshtein distance over the whitespace-separated words of two texts, exact for any number of words."""
    return _words_of(a, b)["edits"]


def _words_of(a: Column, b: Column) -> Column:
    return F.pandas_udf(_words_apart, "edits long, reference long, hypothesis long")(a, b)


def _characters_apart(a: pd.Series, b: pd.Series) -> pd.Series:
    def numbered(x: str, y: str, at: int) -> Numbers:
        return tuple(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32) for text in (x, y))

    return _apart(a, b, numbered)


def _words_apart(a: pd.Series, b: pd.Series) -> pd.DataFrame:
    counts = [[None if text is None else -1 for text in texts] for texts in (a, b)]

    def numbered(x: str, y: str, at: int) -> Numbers:
        codes: dict[str, int] = defaultdict(count().__next__)
        pair = tuple(np.fromiter(map(codes.__getitem__, words := text.split()), np.uint32, len(words)) for text in (x, y))
        counts[0][at], counts[1][at] = map(len, pair)
        return pair

    edits = _apart(a, b, numbered)
    for texts, found in zip((a, b), counts, strict=True):
        for at, text in enumerate(texts):
            if found[at] == -1:
                found[at] = len(text.split())
    reference, hypothesis = (pd.Series(found, dtype="Int64") for found in counts)
    return pd.DataFrame({"edits": edits, "reference": reference, "hypothesis": hypothesis})


def _apart(a: pd.Series, b: pd.Series, numbered: Callable[[str, str, int], Numbers]) -> pd.Series:
    """Distances of pairs of texts as ``numbered``; null where one is missing."""
    found: list[int | None] = [None] * len(a)
    places: list[int] = []
    pairs: list[Numbers] = []
    held = 0

    def settle() -> None:
        if places:
            for at, edits in zip(places, distances(*map(list, zip(*pairs))).tolist(), strict=True):
                found[at] = edits
            places.clear()
            pairs.clear()

    sizes: dict[int, int] = {}
    texts = list(zip(a, b, strict=True))
    for at, (x, y) in enumerate(texts):
        if x is not None and y is not None:
            if x == y:
                found[at] = 0
            else:
                sizes[at] = len(x) + len(y)
    # Pairs of like length are held together, as many as can be: they share each step.
    for at in sorted(sizes, key=sizes.__getitem__):
        if held + sizes[at] > HELD_CHARS:
            settle()
            held = 0
        places.append(at)
        pairs.append(numbered(*texts[at], at))
        held += sizes[at]
    settle()
    return pd.Series(found, dtype="Int64")


def cer(reference: Column, hypothesis: Column) -> Column:
    """Character error rate; above 1 when the hypothesis is far longer.

    An empty reference scores 1 against any text and 0 against an empty one.
    """
    n = F.length(reference)
    return F.when(n == 0, F.when(F.length(hypothesis) > 0, 1.0).otherwise(0.0)).otherwise(
        edit_distance(reference, hypothesis) / n
    )


def wer(reference: Column, hypothesis: Column) -> Column:
    """Word error rate over whitespace-separated words; zero words as in ``cer``."""
    found = _words_of(reference, hypothesis)
    n = found["reference"]
    return F.when(n == 0, F.when(found["hypothesis"] > 0, 1.0).otherwise(0.0)).otherwise(found["edits"] / n)


def percent(rate: Column, digits: int = 2, signed: bool = False) -> Column:
    """A rate as percent text, rounded from its exact value with ties to even."""
    # format_number rounds the exact binary value; format_string would round its printed digits.
    pattern = F.lit("0." + "0" * digits)
    text = F.concat(F.call_function("format_number", rate * 100, pattern), F.lit("%"))
    return F.concat(F.when(rate >= 0, "+").otherwise(""), text) if signed else text
