"""Alignment of two tokenizers: the groups of tokens between byte offsets where tokens of both end.

A byte-level BPE (A) encodes a space and the text, a piece model (B) the text, which it begins with a space by itself.
Over the bytes of the same string every token points to its farthest-right overlapping token: the one
of the other tokenizer that covers its last byte, or itself if nothing reaches further. Of two tokens that
end together the one of A is taken. Following the successors of all tokens at once and doubling their
stride converges to the terminal token of each component, whose number labels the group. No token is empty,
so one token of each tokenizer ends at the end of a group: this pair is its link.

A text that is null, empty or not valid UTF-8, or whose joined bytes in A or B are not the space and the text (the
piece model may normalise), has no tokens. Names of special tokens in a text are plain text. Texts are
encoded whole, a long one on its own. Ids may be null or repeat: every row is aligned for itself. An
empty table gives an empty one. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from functools import cache, partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from glyphmill.llm.shared import small_batches
from glyphmill.session import materialize

#: Bytes of text that are encoded at a time, but for a longer text.
TEXT_BYTES = 400_000
#: Fixed value: what a byte-level tokenizer of this kind takes for a word.
BYTE_LEVEL_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Pairs of ids whose counts are sent to every task; more are joined by a shuffle.
BROADCAST_PAIRS = 1_000_000
#: A pair of ids as one number.
_B_IDS = 1 << 20


class _Tokenizers:
    """Both tokenizers, and the bytes of each of their ids."""

    def __init__(self, a_file: bytes, b_file: bytes) -> None:
        from sentencepiece import SentencePieceProcessor
        from tiktoken import Encoding

        as_byte, model = _byte_alphabet(), json.loads(a_file)["model"]
        merges = ["".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
        if [model["vocab"][m] for m in merges] != list(range(256, 256 + len(merges))):
            raise ValueError("the ids of the byte-level tokenizer are not the ranks of its merges")
        # All but the special tokens, whose names are plain text here.
        ranks = {bytes(as_byte[c] for c in t): id for t, id in model["vocab"].items() if id < 256 + len(merges)}
        self.a = Encoding("a", pat_str=BYTE_LEVEL_WORDS, mergeable_ranks=ranks, special_tokens={})
        self.b = SentencePieceProcessor(model_proto=b_file)
        self.a_bytes = sorted(ranks, key=ranks.__getitem__)
        self.b_bytes = [self._piece(id) for id in range(self.b.get_piece_size())]
        self.a_lengths = np.array([len(x) for x in self.a_bytes])
        self.b_lengths = np.array([len(x) for x in self.b_bytes])

    def _piece(self, id: int) -> bytes:
        piece = self.b.id_to_piece(id)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(id) else piece.replace("▁", " ").encode()

    def encode(self, texts: list[str]) -> list[tuple[list[int], list[int]]]:
        """Ids of both for each text; none where the tokens do not spell it."""
        both = []
        for text, b_ids in zip(texts, self.b.encode(texts, num_threads=1), strict=True):
            a_ids, whole = self.a.encode_ordinary(" " + text), b" " + text.encode()
            spelled = b"".join([self.a_bytes[i] for i in a_ids]) == whole == b"".join([self.b_bytes[i] for i in b_ids])
            both.append((a_ids, b_ids) if spelled and text else ([], []))
        return both


def _byte_alphabet() -> dict[str, int]:
    """The character of each byte: itself if it can be seen, else the next one from 256 on."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [byte for byte in range(256) if byte not in set(seen)]
    return {chr(byte): byte for byte in seen} | {chr(256 + n): byte for n, byte in enumerate(other)}


@cache
def _loaded(a_file: bytes, b_file: bytes) -> _Tokenizers:
    """Once for each Python worker."""
    return _Tokenizers(a_file, b_file)


def groups(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The group of every token of A and of B, from where their tokens end in the same bytes."""
    n = len(a_ends)
    # The first token of the other that ends where this one does, or later, covers its last byte.
    over_a, over_b = np.searchsorted(b_ends, a_ends), np.searchsorted(a_ends, b_ends)
    successor = np.concatenate([np.where(b_ends[over_a] > a_ends, n + over_a, np.arange(n)), over_b])
    while not np.array_equal(further := successor[successor], successor):
        successor = further
    number = np.cumsum(successor[:n] == np.arange(n)) - 1
    return number[successor[:n]], number[successor[n:]]


def _decoded(raw: bytes | None) -> str:
    try:
        return "" if raw is None else raw.decode()
    except UnicodeDecodeError:
        return ""


def _by_size(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Stretches of a batch with some ``TEXT_BYTES`` of text, or of one longer text."""
    stretch = np.cumsum(pc.binary_length(batch.column("text")).fill_null(0).to_numpy(zero_copy_only=False)) // TEXT_BYTES
    starts = np.flatnonzero(np.diff(stretch, prepend=-1))
    for start, end in zip(starts, np.append(starts[1:], len(batch)), strict=True):
        yield batch.slice(start, end - start)


def _lists(values: np.ndarray, lengths: np.ndarray, kind: type = np.int32) -> pa.ListArray:
    offsets = np.append(0, np.cumsum(lengths)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(kind)))


def _aligned(
    batches: Iterator[pa.RecordBatch], files: Broadcast, derived: dict[str, Callable[[pa.RecordBatch], pa.Array]]
) -> Iterator[pa.RecordBatch]:
    both = _loaded(*files.value)
    for chunk in (c for batch in batches for c in _by_size(batch)):
        encoded = both.encode([_decoded(raw) for raw in chunk.column("text").to_pylist()])
        n_a, n_b = (np.array([len(e[side]) for e in encoded]) for side in (0, 1))
        a, b = (np.concatenate([np.array(e[side], np.int64) for e in encoded]) for side in (0, 1))
        # The texts one after another: where one ends, both have a token that ends.
        of_a, of_b = groups(np.cumsum(both.a_lengths[a]), np.cumsum(both.b_lengths[b])) if len(a) else (a, b)
        last = np.diff(of_a, append=-1) != 0
        n_groups = np.bincount(np.repeat(np.arange(len(chunk)), n_a)[last], minlength=len(chunk))
        sizes = [np.bincount(of, minlength=int(n_groups.sum())) for of in (of_a, of_b)]
        columns = {"id": chunk.column("id"), "a": _lists(a, n_a), "b": _lists(b, n_b)}
        columns |= {"a_sizes": _lists(sizes[0], n_groups), "b_sizes": _lists(sizes[1], n_groups)}
        columns |= _links(a, b, *sizes, n_groups)
        found = pa.RecordBatch.from_pydict(columns)
        for name, function in derived.items():
            found = found.append_column(name, function(found))
        yield found


def _links(
    a: np.ndarray, b: np.ndarray, a_sizes: np.ndarray, b_sizes: np.ndarray, n_groups: np.ndarray
) -> dict[str, pa.ListArray]:
    """By text the different pairs of ids that end groups, and how often each does."""
    pair = a[np.cumsum(a_sizes) - 1] * _B_IDS + b[np.cumsum(b_sizes) - 1]
    text = np.repeat(np.arange(len(n_groups)), n_groups)
    order = np.lexsort((pair, text))
    pair, text = pair[order], text[order]
    first = np.flatnonzero((np.diff(pair, prepend=-1) != 0) | (np.diff(text, prepend=-1) != 0))
    lengths = np.bincount(text[first], minlength=len(n_groups))
    return {"pairs": _lists(pair[first], lengths, np.int64), "times": _lists(np.diff(np.append(first, len(pair))), lengths)}


def align(
    df: DataFrame, id: str, text: str, a_path: str, b_path: str,
    derived: dict[str, tuple[str, Callable[[pa.RecordBatch], pa.Array]]] = {},
) -> DataFrame:
    """``row, id, a, b, a_sizes, b_sizes, pairs, times``, stored.

    These are the ids of both tokenizers, how many of each are in each group, and the different links (``a`` and
    ``b`` in one number) with how often the row has them. ``derived`` names more columns, their types, and
    functions that make them of the others. The tokenizer files are read here and sent to the tasks.
    """
    spark = df.sparkSession
    with open(a_path, "rb") as a_file, open(b_path, "rb") as b_file:
        files = spark.sparkContext.broadcast((a_file.read(), b_file.read()))
    rows = df.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").cast("binary").alias("text"))
    types = {"id": rows.schema["id"].dataType.simpleString()}
    types |= {c: "array<int>" for c in ("a", "b", "a_sizes", "b_sizes")} | {"pairs": "array<bigint>", "times": "array<int>"}
    types |= {name: kind for name, (kind, _) in derived.items()}
    make = partial(_aligned, files=files, derived={name: function for name, (_, function) in derived.items()})
    found = rows.mapInArrow(make, ", ".join(f"{name} {kind}" for name, kind in types.items()))
    with small_batches(spark):
        return materialize(found.withColumn("row", F.monotonically_increasing_id()), "aligned")


def links(aligned: DataFrame) -> DataFrame:
    """``row, pair, n``: how often a row links a pair of ids."""
    return aligned.select("row", F.inline(F.arrays_zip("pairs", "times"))).withColumnsRenamed({"pairs": "pair", "times": "n"})


def link_scores(aligned: DataFrame) -> DataFrame:
    """``row, n_links, n_best, count_sum`` of the rows that have tokens.

    A pair's count is that of its links in all rows; a link is best if its count is the highest of its B id.
    """
    own = links(aligned)
    counts = materialize(own.groupBy("pair").agg(F.sum("n").alias("count")), "pair-counts")
    of_b = Window.partitionBy(F.col("pair") % _B_IDS)
    counts = counts.withColumn("best", F.col("count") == F.max("count").over(of_b))
    if counts.count() <= BROADCAST_PAIRS:
        counts = F.broadcast(counts)
    return own.join(counts, "pair").groupBy("row").agg(
        F.sum("n").alias("n_links"),
        F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("n_best"),
        F.sum(F.col("n") * F.col("count")).alias("count_sum"),
    )
