"""Line dedup: two Bloom filters find suspected repeats, an exact count settles them.

1. Each document gives the 128-bit digests of its distinct long lines, a narrow table that is
   stored once. Texts are read here and when lines are dropped, and never in between.
2. The digests are dealt out by filter block. A task keeps two Bloom filters per block: a digest
   seen again, or one whose bits are all set in the first filter, goes into the second. Digests
   repeated inside one Arrow batch are sent once, so a line of every document is no hot key.
3. Digests that the second filter knows are suspects. It has no false negatives, so whatever
   repeats is among them; only suspects are shuffled by digest and counted exactly.
4. The lists of lines to drop go back to their documents.

The filter blocks are rows of 1 KiB, as many as the digests need. Spark joins them by broadcast
below its threshold and by a shuffle of the narrow rows above it.

Results for odd input: a null text is one empty line; rows without an id keep all their lines and
count for no other; rows that repeat an id count as one document and are treated alike.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glyphmill.llm.shared import bounded_batches
from glyphmill.session import discard, materialize

SPACE = b" \t\n\x0b\x0c\r"
BLOCK_BITS = 8192
BITS_PER_KEY = 10
PROBES = 4
_PROBE_BITS = 13  # 2 ** 13 = BLOCK_BITS


def line_key(line: bytes) -> bytes:
    """What lines are compared by: stripped of ASCII white space, A to Z lower-cased."""
    return line.strip(SPACE).lower()  # bytes.lower changes A to Z alone


def _points(key: bytes) -> int:
    """Code points of UTF-8 bytes."""
    return len(key) if key.isascii() else len(key.decode("utf-8", "surrogatepass"))


def _digest(key: bytes) -> bytes:
    return hashlib.blake2b(key, digest_size=16).digest()


def _long_keys(text: bytes | None, min_chars: int) -> Iterator[bytes]:
    for line in (text or b"").split(b"\n"):
        # No key has more code points than bytes.
        if len(line) >= min_chars and len(key := line_key(line)) >= min_chars:
            if _points(key) >= min_chars:
                yield _digest(key)


def _slices(batch: pa.RecordBatch, rows: int = 512) -> Iterator[pa.RecordBatch]:
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)


def line_digests(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """``id, a, b`` of every distinct long line of every document."""

    def digests(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in _slices(whole):
                ids, found = [], []
                for i, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                    own = {*_long_keys(text.as_py(), min_chars)}
                    ids += [i] * len(own)
                    found += own
                pairs = np.frombuffer(b"".join(found), "<i8").reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(pairs[:, 0]), pa.array(pairs[:, 1])],
                    names=["id", "a", "b"],
                )

    texts = docs.filter(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long"), F.col(text_col).cast("binary")
    )
    return texts.mapInArrow(digests, "id long, a long, b long")


def _probes(b: np.ndarray) -> np.ndarray:
    """Bit numbers of each key inside its block."""
    shifts = np.arange(PROBES, dtype=np.uint64) * np.uint64(_PROBE_BITS)
    return ((b.view(np.uint64)[:, None] >> shifts) & np.uint64(BLOCK_BITS - 1)).astype(np.int64)


def _once_per_batch(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each digest of a batch once, with whether it repeats inside the batch."""
    for batch in batches:
        keys = np.stack([batch.column(i).to_numpy() for i in (1, 2)], axis=1)
        block = batch.column(0).to_numpy()
        _, first, n = np.unique(keys, axis=0, return_index=True, return_counts=True)
        yield pa.RecordBatch.from_arrays(
            [pa.array(block[first]), pa.array(keys[first, 1]), pa.array(n > 1)],
            names=["block", "b", "again"],
        )


def _build(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The second filter of each block, from rows sorted by block."""
    kept: tuple[int, np.ndarray, np.ndarray] | None = None

    def rows(blocks: np.ndarray, twice: np.ndarray) -> pa.RecordBatch:
        used = twice.any(axis=1)
        words = np.packbits(twice[used], axis=1, bitorder="little").view("<i8")
        return pa.RecordBatch.from_arrays(
            [pa.array(blocks[used]), pa.array(list(words), pa.list_(pa.int64()))],
            names=["block", "bits"],
        )

    for batch in batches:
        if not batch.num_rows:
            continue
        block, b, again = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
        blocks, local = np.unique(block, return_inverse=True)
        once = np.zeros((len(blocks), BLOCK_BITS), bool)
        twice = np.zeros((len(blocks), BLOCK_BITS), bool)
        if kept is not None:
            if kept[0] == blocks[0]:
                once[0], twice[0] = kept[1], kept[2]
            else:
                yield rows(np.array([kept[0]]), kept[2][None])
        probes = _probes(b)
        # Repeats inside the batch, which may come from different batches upstream.
        _, same, n = np.unique(np.stack([local, b], axis=1), axis=0, return_inverse=True, return_counts=True)
        repeat = again | (n[same.reshape(-1)] > 1) | once[local[:, None], probes].all(axis=1)
        twice[local[repeat, None], probes[repeat]] = True
        once[local[:, None], probes] = True
        yield rows(blocks[:-1], twice[:-1])
        kept = (blocks[-1], once[-1], twice[-1])
    if kept is not None:
        yield rows(np.array([kept[0]]), kept[2][None])


def suspects(digests: DataFrame) -> DataFrame:
    """The stored ``digests`` whose key may occur more than once; none that does is missing."""
    n = digests.count()
    blocks = max(1, -(-n * BITS_PER_KEY // BLOCK_BITS))
    placed = digests.withColumn("block", F.pmod("a", F.lit(blocks)))
    sent = placed.select("block", "a", "b").mapInArrow(
        _once_per_batch, "block long, b long, again boolean"
    )
    filters = materialize(
        sent.repartition("block").sortWithinPartitions("block").mapInArrow(
            _build, "block long, bits array<long>"
        ),
        "line-filters",
    )
    known = F.lit(True)
    for i in range(PROBES):
        bit = F.shiftrightunsigned("b", i * _PROBE_BITS).bitwiseAND(F.lit(BLOCK_BITS - 1))
        word = F.get("bits", F.shiftright(bit, 6).cast("int"))
        known &= F.getbit(word, bit.bitwiseAND(F.lit(63)).cast("int")) == 1
    return placed.join(filters, "block").filter(known).select("id", "a", "b")


def dropped_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 20, min_docs: int = 3
) -> DataFrame:
    """``id, drops``: the digests of the lines that each document loses."""
    bounded_batches(docs.sparkSession)
    digests = materialize(line_digests(docs, id_col, text_col, min_chars), "line-digests")
    suspected = materialize(suspects(digests), "line-suspects")
    common = (
        suspected.distinct()
        .groupBy("a", "b")
        .agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("last"))
        .filter(F.col("n") >= min_docs)
        .drop("n")
    )
    # Stored, so that Spark sees its true size and can split a very common line's rows.
    common = materialize(common, "line-common")
    discard(digests)
    losing = suspected.join(common, ["a", "b"]).filter(F.col("id") < F.col("last"))
    return losing.groupBy("id").agg(F.collect_set(F.struct("a", "b")).alias("drops"))


def _without(texts: pd.Series, drops: pd.Series) -> pd.DataFrame:
    out = []
    for text, own in zip(texts, drops):
        lines = (text or b"").split(b"\n")
        if own is None:
            out.append(((text or b"").decode("utf-8", "replace"), len(lines), 0))
            continue
        gone = {np.array([x["a"], x["b"]], "<i8").tobytes() for x in own}
        # Every digest in ``gone`` is one of a long enough line.
        kept = [x for x in lines if _digest(line_key(x)) not in gone]
        out.append((b"\n".join(kept).decode("utf-8", "replace"), len(lines), len(lines) - len(kept)))
    return pd.DataFrame(out, columns=["text", "n_lines", "n_dropped"])


def line_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = 20,
    min_docs: int = 3,
    out: str = "deduped",
) -> DataFrame:
    """``docs`` with a struct ``out`` of ``text``, ``n_lines`` and ``n_dropped``.

    A line's key is the line stripped of ASCII white space with A to Z lower-cased. Keys of at
    least ``min_chars`` code points in at least ``min_docs`` documents lose all their lines but
    those of the largest id that has one. ``n_lines`` counts lines before dropping.
    """
    drops = dropped_lines(docs, id_col, text_col, min_chars, min_docs)
    drops = drops.select(F.col("id").alias("_gm_id"), F.col("drops").alias("_gm_drops"))
    joined = docs.join(drops, docs[id_col].cast("long") == drops["_gm_id"], "left")
    without = F.pandas_udf(_without, "text string, n_lines long, n_dropped long")
    result = without(F.col(text_col).cast("binary"), "_gm_drops")
    kept = [docs[c] for c in docs.columns if c != out]
    return joined.select(*kept, result.alias(out))
