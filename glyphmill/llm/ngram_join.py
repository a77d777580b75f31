"""Similarity join of documents on their word shingles, exact, with components of the links.

Two sets link when their Jaccard similarity is at least ``percent / 100``.

1. Each text becomes its set of 64-bit shingle hashes. Equal sets are one class, and the rest works
   on one document of each class.
2. **Size bands.** Linked sets differ in few shingles: at most ``D = n * (100 - p) / p`` for a set
   of n. The shingles are dealt into more parts than that by a hash, with one number of parts
   for a band of sizes (a power of two), so linked sets have a part in common that is equal in
   both. D + 1 parts and some spare ones for empty parts are enough; a set with more empty parts
   than spares is dealt anew under the next seed as well. That is counted over the fewer parts of
   each smaller set it may link with too, so whichever of two linked sets stops first has a part in
   common with the other. Sets near the upper end of a band send the parts of the next band too.
   The documents with an equal part are a tile.
3. **Bitmaps.** A 512-bit parity bitmap of each set: two bitmaps differ in at most as many bits
   as the sets do in shingles, which bounds the overlap from above. Pairs within the bound are
   held to that of a wider bitmap, and what is left is compared by intersecting the sorted arrays.
4. Each document is compared with the centre of its tiles, and the links make components. Then
   the pairs of a tile that lie in different components are compared; pairs inside one component
   can add nothing. Large tiles are cut into blocks of ``BLOCK`` documents, which meet pairwise
   in tasks of their own.

Results for odd input: null or blank texts have no shingles and link with nothing; texts of fewer
words than a shingle are one shingle; rows without an id are left out; rows that repeat an id
stand as one document with the set of the row whose digest is least.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import cache, lru_cache, reduce
from math import exp

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from glyphmill.llm.components import components
from glyphmill.llm.shared import bounded_batches
from glyphmill.session import discard, materialize

BITMAP_WORDS = 8
WIDE_WORDS = 64  # of the bitmaps that pairs must pass before their sets are sent
BLOCK = 1024
#: Ids of documents to be read into sets are broadcast up to so many: 8 bytes each.
BROADCAST_IDS = 1_000_000
SEEDS = 32
MARGIN = 1.3  # spare parts beyond those that are empty on average
_MIX_1, _MIX_2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_BYTE_HASH = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX_1
    x = (x ^ (x >> np.uint64(27))) * _MIX_2
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Sorted distinct shingle hashes of a text's bytes.

    Shingles are hashed as substrings of the text with single spaces, by differences of
    one running polynomial sum, so a text costs a few passes of numpy whatever its words.
    """

    def __init__(self, words: int) -> None:
        self.words = words
        self._powers(1 << 14)

    def _powers(self, n: int) -> None:
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            setattr(self, name, np.cumprod(steps))

    def __call__(self, text: bytes | None) -> np.ndarray:
        flat = np.frombuffer(b" ".join((text or b"").lower().split()), np.uint8)
        if not len(flat):
            return np.empty(0, np.uint64)
        if len(flat) + 1 > len(self.up):
            self._powers(2 * len(flat) + 1)
        sums = np.zeros(len(flat) + 1, np.uint64)
        np.cumsum(_BYTE_HASH[flat] * self.up[: len(flat)], out=sums[1:])
        spaces = np.flatnonzero(flat == 32)
        starts = np.concatenate(([0], spaces + 1))
        ends = np.concatenate((spaces, [len(flat)]))
        if len(starts) > self.words:
            starts, ends = starts[: 1 - self.words or None], ends[self.words - 1 :]
        else:
            starts, ends = starts[:1], ends[-1:]
        return np.unique(_mix((sums[ends] - sums[starts]) * self.down[starts]))


def _bitmap(shingles: np.ndarray, words: int = BITMAP_WORDS) -> np.ndarray:
    bits = 64 * words
    counts = np.bincount((shingles & np.uint64(bits - 1)).astype(np.int64), minlength=bits)
    return np.packbits(counts & 1, bitorder="little").view("<i8")


def _digest(shingles: np.ndarray) -> tuple[int, int]:
    """128 bits that equal sets share."""
    one = np.bitwise_xor.reduce(_mix(shingles ^ _MIX_1), initial=np.uint64(0))
    two = np.add.reduce(_mix(shingles ^ _MIX_2), dtype=np.uint64)
    return int(one.view(np.int64)), int(two.view(np.int64))


def most_apart(n: int, percent: int) -> int:
    """Shingles in which a set of ``n`` and a set linked with it differ at most."""
    return n * (100 - percent) // percent


@cache
def _spare_share(percent: int) -> float:
    """Spare parts for each part needed, so that few sets have more empty parts than spares.

    The smallest sets of a band have the emptiest parts: on average 1 / (2 r (1 + share)) shingles each,
    r being the share of shingles that may differ.
    """
    r = (100 - percent) / percent
    shares = (i / 100 for i in range(1, 100))
    return next((s for s in shares if s / (1 + s) >= MARGIN * exp(-1 / (2 * r * (1 + s)))), 1.0)


def _spare(d: int, percent: int) -> int:
    return int(d * _spare_share(percent)) + 3


@lru_cache(maxsize=256)
def _prefixes(n: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """First parts, and spare ones among them, of a set of ``n`` and of each smaller set it may link with."""
    least = max(1, most_apart(-(-n * percent // 100), percent))
    apart = range(least, most_apart(n, percent) + 1)
    spares = np.array([_spare(d, percent) for d in apart])
    return np.array(apart) + 1 + spares, spares


def tile_keys(shingles: np.ndarray, percent: int) -> np.ndarray:
    """Keys of the parts that a set sends; two linked, unequal sets have one in common."""
    n = len(shingles)
    apart = most_apart(n, percent)
    if apart == 0:  # only equal sets link
        return np.empty(0, np.uint64)
    band, keys = n.bit_length(), []
    firsts, spares = _prefixes(n, percent)
    first = firsts[-1]
    for scheme in {band, (n * 100 // percent).bit_length()}:
        widest = most_apart(2**scheme - 1, percent)
        parts = widest + 1 + _spare(widest, percent)
        for seed in range(SEEDS):
            salt = _mix(np.array([scheme << 32 | seed], np.uint64))[0]
            dealt = _mix(shingles ^ salt)
            part = (dealt >> np.uint64(20)) % np.uint64(parts)
            own = part < np.uint64(first)
            part, dealt = part[own], dealt[own]
            order = np.argsort(part, kind="stable")
            part, dealt = part[order], dealt[order]
            heads = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1]))) if len(part) else part
            filled = np.searchsorted(part[heads], firsts.astype(np.uint64))
            good = (firsts - filled <= spares).all()
            if len(heads):
                sums = np.add.reduceat(_mix(dealt * _MIX_2), heads)
                keys.append(_mix(sums ^ _mix(part[heads] + salt)))
            if good:
                break
            if seed == SEEDS - 1:  # the empty parts are keys too, so nothing is lost
                empty = np.setdiff1d(np.arange(first, dtype=np.uint64), part)
                keys.append(_mix(empty + salt))
    return np.concatenate(keys) if keys else np.empty(0, np.uint64)


def _prints(words: int, percent: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(words)
        for whole in batches:
            for start in range(0, whole.num_rows, 512):
                batch = whole.slice(start, 512)
                n, a, b, bitmaps, keys = [], [], [], [], []
                for text in batch.column(1):
                    s = shingler(text.as_py())
                    n.append(len(s))
                    one, two = _digest(s)
                    a.append(one)
                    b.append(two)
                    bitmaps.append(_bitmap(s))
                    keys.append(tile_keys(s, percent).view(np.int64))
                longs = pa.list_(pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(n, pa.int64()), pa.array(a, pa.int64()), pa.array(b, pa.int64()),
                     pa.array(bitmaps, longs), pa.array(keys, longs)],
                    names=["id", "n", "a", "b", "bitmap", "keys"],
                )

    return run


def _sets(words: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(words)
        for whole in batches:
            for start in range(0, whole.num_rows, 512):
                batch = whole.slice(start, 512)
                sets = [shingler(text.as_py()) for text in batch.column(1)]
                digests = pa.array([_digest(s)[0] for s in sets], pa.int64())
                longs = pa.list_(pa.int64())
                arrays = pa.array([s.view(np.int64) for s in sets], longs)
                wide = pa.array([_bitmap(s, WIDE_WORDS) for s in sets], longs)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), arrays, wide, digests], names=["id", "shingles", "wide", "digest"]
                )

    return run


def _tiles(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``key, place, id`` of each key that unequal sets share, from rows sorted by ``key, a, id``.

    Of the rows of a key with one digest ``a``, which are copies, the first alone counts.
    """
    names = ["key", "place", "id"]
    held = None  # key, digest, id and place of the last row, which may have to be sent yet
    for batch in batches:
        keys, digests, ids = (batch.column(i).to_numpy() for i in range(3))
        same = np.zeros(len(keys), bool)
        same[1:] = (keys[1:] == keys[:-1]) & (digests[1:] == digests[:-1])
        if held is not None and len(keys):
            same[0] = keys[0] == held[0] and digests[0] == held[1]
        keys, digests, ids = keys[~same], digests[~same], ids[~same]
        if not len(keys):
            continue
        if held is not None:
            keys, digests, ids = (np.concatenate(([x], y)) for x, y in zip(held, (keys, digests, ids)))
        at = np.arange(len(keys))
        head = np.concatenate(([True], keys[1:] != keys[:-1]))
        start = np.maximum.accumulate(np.where(head, at, 0))
        places = at - start
        if held is not None:
            places += held[3] * (keys == keys[0])  # the rows are sorted, so these come first
        send = (places > 0) | np.concatenate((~head[1:], [False]))
        send[-1] = False
        yield pa.RecordBatch.from_arrays([pa.array(x[send]) for x in (keys, places, ids)], names=names)
        held = keys[-1], digests[-1], ids[-1], places[-1]
    if held is not None and held[3] > 0:
        row = held[0], held[3], held[2]
        yield pa.RecordBatch.from_arrays([pa.array([int(x)], pa.int64()) for x in row], names=names)


def _within(percent: int, words: int = BITMAP_WORDS) -> Column:
    """Whether the bitmaps of the sides a and b leave room for a link."""
    n_a, n_b = "n_a", "n_b"
    apart = reduce(
        Column.__add__,
        [F.bit_count(F.get("bitmap_a", i).bitwiseXOR(F.get("bitmap_b", i))) for i in range(words)],
    )
    total = F.col(n_a) + F.col(n_b)
    overlap = F.least(F.col(n_a), F.col(n_b), (total - apart) / 2)
    return overlap * (100 + percent) >= total * percent


def _few(pairs: DataFrame) -> DataFrame:
    """The ids in ``pairs``, with a broadcast hint if a count shows them to be few."""
    ids = pairs.select("a").union(pairs.select("b")).distinct().withColumnRenamed("a", "id")
    ids = materialize(ids, "pair-ids")
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def _linked(pairs: DataFrame, texts: DataFrame, prints: DataFrame, repeated: bool, words: int, percent: int) -> DataFrame:
    """The stored ``pairs`` of ids whose sets really link; only their texts are read into sets."""
    few = _few(pairs)
    sets = texts.join(few, "id", "left_semi").mapInArrow(
        _sets(words), "id long, shingles array<long>, wide array<long>, digest long"
    )
    if repeated:  # of the rows of an id, the one whose set is in ``prints``
        own = prints.join(few, "id", "left_semi").select("id", F.col("a").alias("digest"))
        sets = sets.join(own, ["id", "digest"], "left_semi").dropDuplicates(["id"])
    stored = materialize(sets.drop("digest"), "pair-sets")

    # A wider bitmap first: it is a fraction of the set, and few pairs that do not link get past it.
    left, right = (
        stored.select(F.col("id").alias(x), F.size("shingles").alias(f"n_{x}"), F.col("wide").alias(f"bitmap_{x}"))
        for x in ("a", "b")
    )
    near = pairs.join(left, "a").join(right, "b").filter(_within(percent, WIDE_WORDS)).select("a", "b")
    near = materialize(near, "near-pairs")
    sets = stored.join(_few(near), "id", "left_semi")
    left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("left"))
    right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("right"))
    linked = (
        near.join(left, "a").join(right, "b")
        .withColumn("common", F.size(F.array_intersect("left", "right")))
        .filter(F.col("common") * 100 >= (F.size("left") + F.size("right") - F.col("common")) * percent)
        .select("a", "b")
    )
    links = materialize(linked, "links")
    discard(stored)
    return links


def similarity_classes(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80
) -> DataFrame:
    """``id, n_shingles, component_id``: the least id that links lead to, itself included.

    A shingle is ``words`` words, separated by ASCII white space, with A to Z lower-cased.
    """
    bounded_batches(docs.sparkSession)
    texts = docs.filter(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text")
    )
    prints = materialize(
        texts.mapInArrow(
            _prints(words, percent), "id long, n long, a long, b long, bitmap array<long>, keys array<long>"
        ),
        "shingle-prints",
    )
    one = prints.groupBy("id").agg(F.min(F.struct("a", "b", "n")).alias("set")).select("id", "set.*")
    repeated = one.count() < prints.count()
    if repeated:
        own = prints.join(one, ["id", "a", "b", "n"], "left_semi").dropDuplicates(["id"])
        prints = materialize(own, "shingle-prints")
        one = prints.select("id", "a", "b", "n")

    # The rows of a class share their keys; the least id of a class, its head, stands for it.
    rows = prints.select(F.explode(F.array_distinct("keys")).alias("key"), "a", "id")
    tiles = materialize(
        rows.repartition("key").sortWithinPartitions("key", "a", "id").mapInArrow(
            _tiles, "key long, place long, id long"
        ),
        "tiles",
    )
    bitmaps = prints.select("id", "n", "bitmap").join(tiles.select("id").distinct(), "id", "left_semi")
    bitmaps = materialize(bitmaps, "tile-bitmaps")

    def sided(side: str) -> DataFrame:
        return bitmaps.select(
            F.col("id").alias(side), F.col("n").alias(f"n_{side}"), F.col("bitmap").alias(f"bitmap_{side}")
        )

    within = _within(percent)
    # The centre of a tile is the document that meets most others in its tiles: of variants of one
    # text that is the text itself, which links with most of them.
    sizes = tiles.groupBy("key").agg(F.count(F.lit(1)).alias("size"))
    score = tiles.join(materialize(sizes, "tile-sizes"), "key").groupBy("id").agg(F.sum("size").alias("score"))
    ranked = tiles.join(materialize(score, "tile-scores"), "id").groupBy("key")
    centres = ranked.agg(F.max(F.struct("score", (-F.col("id")).alias("minus"))).alias("top"))
    centres = materialize(centres.select("key", (-F.col("top.minus")).alias("a")), "tile-centres")
    met = tiles.join(centres, "key").select("a", F.col("id").alias("b")).filter("a <> b").distinct()
    firsts = met.join(sided("a"), "a").join(sided("b"), "b").filter(within).select("a", "b")
    first_links = _linked(materialize(firsts, "first-pairs"), texts, prints, repeated, words, percent)
    joined = components(first_links, "a", "b")
    known = bitmaps.join(joined, "id", "left").withColumn("component", F.coalesce("component", "id"))
    known = materialize(known, "first-components")

    # Pairs of one tile in different components, block by block.
    narrow = tiles.join(known.select("id", "component"), "id").withColumn(
        "block", F.floor(F.col("place") / BLOCK).cast("int")
    )
    narrow = materialize(narrow.select("key", "id", "block", "component"), "placed-tiles")
    open_keys = narrow.groupBy("key").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.max("block").alias("last")
    )
    open_keys = materialize(open_keys.filter("low < high").select("key", "last"), "open-tiles")
    placed = narrow.join(open_keys, "key").join(bitmaps, "id")
    placed = materialize(placed, "open-tile-rows")
    left = placed.select(
        "key", F.col("block").alias("i"), F.explode(F.sequence("block", "last")).alias("j"),
        *[F.col(c).alias(f"{c}_a") for c in ("id", "component", "n", "bitmap")],
    )
    right = placed.select(
        "key", F.explode(F.sequence(F.lit(0), "block")).alias("i"), F.col("block").alias("j"),
        *[F.col(c).alias(f"{c}_b") for c in ("id", "component", "n", "bitmap")],
    )
    meets = (
        (F.col("component_a") != F.col("component_b"))
        & ((F.col("i") < F.col("j")) | (F.col("id_a") < F.col("id_b")))
        & within
    )
    rest = left.join(right, ["key", "i", "j"]).filter(meets).select(
        F.least("id_a", "id_b").alias("a"), F.greatest("id_a", "id_b").alias("b")
    )
    rest_links = _linked(materialize(rest.distinct(), "rest-pairs"), texts, prints, repeated, words, percent)
    linked = components(first_links.union(rest_links), "a", "b")

    # Copies take the component of their class.
    classes = one.filter("n > 0").groupBy("a", "b", "n").agg(F.min("id").alias("head"))
    found = classes.join(linked, classes["head"] == linked["id"], "left").select(
        "a", "b", "n", F.coalesce("component", "head").alias("component_id")
    )
    result = one.join(materialize(found, "class-components"), ["a", "b", "n"], "left")
    result = result.select("id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "id").alias("component_id"))
    result = materialize(result, "similarity-classes")
    discard(prints, tiles, bitmaps, placed)
    return result
