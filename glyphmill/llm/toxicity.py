"""Toxicity: embeddings of byte n-grams averaged into a linear softmax, trained jointly in numpy.

A text is cut into segments of a few words. A segment's vector is the mean over its words of the
mean embedding of the word's n-grams, so a misspelt word shares most of its vector with the word it
comes from. A text scores as its worst segment: a few words in a long text are enough, and the
length alone changes nothing. Training follows that: the first pass gives every segment the label
of its text, the later ones train each text's worst segments.

Only training sees labels, on at most about ``per_class`` texts of each class, drawn by a hash of
the id. Scoring is linear in n-grams, so the tasks get one number for each hashed n-gram.

Results for odd input: null, empty and blank texts score as a segment without words, near 0;
without labels of both classes every score is 0.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glyphmill.llm.shared import bounded_batches

BUCKETS = 1 << 16
DIMENSIONS = 8
SIZES = (3, 4, 5)
SEGMENT = 5
#: Passages, and their characters, that are learnt from a longer text.
PASSAGES, PASSAGE = 8, 12_000
_STOPS = bytes.maketrans(b'\t\n\r\x0b\x0c.,;:!?"()[]{}|#%&<>/\\=+~`', b" " * 30)
_PRIME = np.uint32(16777619)


def _clean(text: str | None) -> bytes:
    words = (text or "").lower().encode("utf-8", "replace").translate(_STOPS).split()
    return b" " + b" ".join(words) + b" " if words else b""


def _ngrams(flat: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """By size: where the n-grams that lie in one word and its borders start, and their buckets."""
    out = []
    space = flat == 32
    spaces = np.concatenate(([0], np.cumsum(space)))
    for n in SIZES:
        span = len(flat) - n + 1
        if span <= 0:
            out.append((np.empty(0, np.int64), np.empty(0, np.int64)))
            continue
        h = np.full(span, 2166136261 + n, np.uint32)
        for o in range(n):
            h = (h ^ flat[o : o + span]) * _PRIME
        h ^= h >> np.uint32(15)
        inner = spaces[n - 1 : n - 1 + span] - spaces[1 : 1 + span]
        at = np.flatnonzero(inner == 0)
        out.append((at, (h[at] & np.uint32(BUCKETS - 1)).astype(np.int64)))
    return out


def _word_values(flat: np.ndarray, value: np.ndarray) -> np.ndarray:
    """The mean of ``value`` over the n-grams of each word."""
    words = np.flatnonzero(flat == 32)  # word k lies between spaces k and k + 1
    number = np.cumsum(flat == 32) - 1  # of the word that a place begins or lies in
    sums, counts = np.zeros(len(words) - 1), np.zeros(len(words) - 1)
    for at, bucket in _ngrams(flat):
        if len(at):
            word = number[at]
            good = word < len(sums)
            sums += np.bincount(word[good], value[bucket[good]], len(sums))
            counts += np.bincount(word[good], minlength=len(sums))
    return sums / np.maximum(counts, 1)


def _segment_means(values: np.ndarray) -> np.ndarray:
    """Means over ``SEGMENT`` words, each segment half over the next; one that is short counts its words as if full."""
    step = SEGMENT // 2 + 1
    starts = np.arange(0, max(1, len(values) - SEGMENT + step), step)
    sums = np.concatenate(([0.0], np.cumsum(values)))
    return (sums[np.minimum(starts + SEGMENT, len(values))] - sums[starts]) / SEGMENT


@dataclass
class SubwordModel:
    value: np.ndarray  # what an n-gram adds to the log odds
    bias: float

    def odds(self, text: str | None) -> float:
        flat = np.frombuffer(_clean(text), np.uint8)
        worst = _segment_means(_word_values(flat, self.value)).max() if len(flat) else 0.0
        return self.bias + float(worst)

    def score(self, text: str | None) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.odds(text), -30, 30))))


def _features(texts: list[str | None]) -> tuple[np.ndarray, ...]:
    """Segments of all texts as a list of (segment, bucket, weight) by segment, and each segment's text."""
    segment, bucket, weight, owner, n = [], [], [], [], 0
    step = SEGMENT // 2 + 1
    for t, text in enumerate(texts):
        flat = np.frombuffer(_clean(text), np.uint8)
        if not len(flat):
            continue
        number = np.cumsum(flat == 32) - 1
        words = int(number[-1])
        parts = [(number[at], b) for at, b in _ngrams(flat) if len(at)]
        word, grams = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
        good = word < words
        word, grams = word[good], grams[good]
        share = (1 / (SEGMENT * np.maximum(np.bincount(word, minlength=words), 1)))[word]
        count = len(np.arange(0, max(1, words - SEGMENT + step), step))
        last = np.minimum(word // step, count - 1)  # a word lies in this segment and maybe the one before
        own = []
        for back in (0, 1):
            s = last - back
            inside = (s >= 0) & (word < s * step + SEGMENT) & (word >= s * step)
            own.append((s[inside] + n, grams[inside], share[inside]))
        at, grams, share = (np.concatenate(x) for x in zip(*own))
        order = np.argsort(at, kind="stable")
        segment.append(at[order].astype(np.int32))
        bucket.append(grams[order].astype(np.int32))
        weight.append(share[order].astype(np.float32))
        owner.append(np.full(count, t, np.int32))
        n += count
    if not n:
        return tuple(np.empty(0, np.int32) for _ in range(4))
    return tuple(np.concatenate(x) for x in (segment, bucket, weight, owner))


def _threshold(odds: np.ndarray, y: np.ndarray) -> float:
    """The middle of the gap that parts the classes with the least sum of error rates."""
    order = np.argsort(odds, kind="stable")
    odds, y = odds[order], y[order]
    missed = np.concatenate(([0], np.cumsum(y))) / y.sum()
    alarms = 1 - np.concatenate(([0], np.cumsum(1 - y))) / (1 - y).sum()
    inner = (missed + alarms)[1:-1]
    best = np.flatnonzero(inner <= inner.min() + 1e-12)
    gaps = odds[best + 1] - odds[best]
    at = best[gaps.argmax()]
    return float(odds[at] + odds[at + 1]) / 2


def train(
    texts: list[str | None], labels: list[int], decide_at: float = 0.7, steps: int = 2500, seed: int = 5
) -> SubwordModel:
    """Adagrad on the segments; the embedding and the softmax are learnt together.

    The bias is set last, so that texts at the best parting of the classes score ``decide_at``.
    """
    segment, bucket, weight, owner = _features(texts)
    y = np.asarray(labels, np.float32)
    rng = np.random.default_rng(seed)
    embedding = rng.normal(0, 0.1, (BUCKETS, DIMENSIONS)).astype(np.float32)
    softmax = rng.normal(0, 0.5, (DIMENSIONS, 2)).astype(np.float32)
    bias = np.array([2.0, -2.0], np.float32)
    seen = np.full(BUCKETS, 1e-3, np.float32)
    bounds = np.searchsorted(segment, np.arange(len(owner) + 1))
    short = np.bincount(owner, minlength=len(y))

    def odds() -> np.ndarray:
        worth = (embedding @ (softmax[:, 1] - softmax[:, 0]))[bucket]
        worth *= weight
        return np.add.reduceat(worth, bounds[:-1]) + (bias[1] - bias[0])  # no segment is empty

    done = turn = 0
    while done < steps or turn < 4:
        turn += 1
        if turn <= 2:  # any segments, with the label of their text
            rows = rng.permutation(len(owner))[:200_000]
        else:  # the worst segments of each text, and some others of the clean ones
            by = np.lexsort((-odds(), owner))
            place = np.arange(len(by)) - (np.cumsum(short) - short)[owner[by]]
            worst = by[place < np.where(y[owner[by]] > 0, 1, 4)]
            clean = np.flatnonzero(y[owner] == 0)
            rows = rng.permutation(np.concatenate((worst, rng.choice(clean, min(len(clean), len(worst)), False))))
        for at in range(0, len(rows), 256):
            done += 1
            take = rows[at : at + 256]
            sizes = bounds[take + 1] - bounds[take]
            local = np.repeat(np.arange(len(take)), sizes)
            where = np.repeat(bounds[take] - np.concatenate(([0], np.cumsum(sizes)[:-1])), sizes) + np.arange(sizes.sum())
            b, w = bucket[where], weight[where]
            vectors = np.zeros((len(take), DIMENSIONS), np.float32)
            gathered = embedding[b] * w[:, None]
            for d in range(DIMENSIONS):
                vectors[:, d] = np.bincount(local, gathered[:, d], len(take))
            z = vectors @ softmax + bias
            z = np.exp(z - z.max(1, keepdims=True))
            error = z / z.sum(1, keepdims=True)
            error[np.arange(len(take)), y[owner[take]].astype(int)] -= 1
            back = error @ softmax.T
            unique, inverse = np.unique(b, return_inverse=True)
            step = np.empty((len(unique), DIMENSIONS), np.float32)
            for d in range(DIMENSIONS):
                step[:, d] = np.bincount(inverse, back[local, d] * w, len(unique))
            seen[unique] += (step**2).mean(1)
            embedding[unique] -= 0.3 * step / np.sqrt(seen[unique])[:, None] + 1e-6 * embedding[unique]
            softmax -= 0.02 * vectors.T @ error / 16
            bias -= 0.02 * error.sum(0) / 16
    value = (embedding @ (softmax[:, 1] - softmax[:, 0])).astype(np.float64)
    unseen = seen <= 1e-3
    value[unseen] = 0.0
    model = SubwordModel(value, float(bias[1] - bias[0]))
    scored = np.array([model.odds(t) for t in texts])
    model.bias += float(np.log(decide_at / (1 - decide_at))) - _threshold(scored, y)
    return model


def fit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "toxic", per_class: int = 450,
) -> SubwordModel | None:
    """A model from the labelled ``docs``; None unless both classes occur.

    The least label counts where an id has several.
    """
    bounded_batches(docs.sparkSession)
    marks = labels.filter(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
    marks = marks.groupBy(F.col(id_col).alias("_gm_id")).agg(F.min(label_col).alias("_gm_label"))
    counts = {r[0]: r[1] for r in marks.groupBy("_gm_label").count().collect()}
    if len(counts) < 2:
        return None
    draw = F.pmod(F.xxhash64("_gm_id"), F.lit(1 << 30)) / (1 << 30)
    share = F.when(F.col("_gm_label") == 1, per_class / counts[1]).otherwise(per_class / counts[0])
    drawn = marks.filter(draw < share).limit(4 * per_class)
    named = docs.select(F.col(f"`{id_col}`").alias("id"), _bounded(F.col(f"`{text_col}`")).alias("text"))
    rows = (
        named.join(F.broadcast(drawn), F.col("id") == F.col("_gm_id"))  # at most 4 * per_class narrow rows
        .groupBy("id")  # one row for each id, however many it has
        .agg(F.min("_gm_label").alias("label"), F.min("text").alias("text"))
        .orderBy("id")
        .collect()
    )
    if len({r.label for r in rows}) < 2:
        return None
    return train([r.text for r in rows], [r.label for r in rows])


def _bounded(text: Column) -> Column:
    """A text to learn from: whole up to ``PASSAGES * PASSAGE`` characters, else so many passages spread over all of it."""
    n = F.length(text)
    spread = F.transform(
        F.sequence(F.lit(0), F.lit(PASSAGES - 1)),
        lambda k: F.substr(text, (F.floor(n * k / PASSAGES) + 1).cast("int"), F.lit(PASSAGE)),
    )
    return F.when(n > PASSAGES * PASSAGE, F.array_join(spread, " ")).otherwise(text)


def score(text: Column, model: SubwordModel | None) -> Column:
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([model.score(t) if model else 0.0 for t in texts], dtype="float64")

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(run, "double")(text)
