"""Conversation structure repair: the cheapest edits that make the roles ``(s?(ua)+)?``.

Rows are taken by id and turn (nulls first); those of one turn by role, the first 64 characters of the text
and its digest. A row is blank (white space only), else a duplicate (role and text said earlier), else
truncated (its last visible character ends no sentence), else sound. Edits by role initials: keep 0, set the
role to user or assistant 2, delete 3 (the only one for blank and duplicate rows), insert an empty text of
user or assistant 2; a truncated row that stays adds 1.

The rows of all conversations are put in one order by ranges and cut into segments of ``2 ** SEGMENT_BITS`` rows; the
part of a conversation in a segment is a piece. Costs go by four states (nothing, system, user, assistant
written last). A piece's rows multiply to a cost matrix of these states; one pass over the pieces of cut
conversations, from the last to the first, gives every piece the costs beyond it. Then a task knows the
cost to the end at each of its nodes (row, state), and the optimal arcs between them.

Of equally cheap audits the ASCII-least counts. Prefix doubling ranks the nodes by the audits of
1, 2, 4, ... letters that begin there: the rank of a doubled length is that of the pair (own rank, least rank
where the first half ends), and pointers double with it, kept where the rank is least. The least path is
unfolded from the pointers, longest stride first. From a node each letter leads to one state, so the least audit
of a piece goes with one state at its end; a second pass, first to last, picks the piece's audit by its entry state.

Null role or text counts as one space; an empty role has no initial. Turns are whole numbers or null. Rows
without an id make a conversation of their own. Repeated rows are duplicates. A conversation may
hold any share of the rows, texts any length: a task sees one segment, without texts. An empty
table gives empty tables. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from glyphmill.session import materialize

SEGMENT_BITS = 12
WHITE_SPACE = " \t\n\x0b\x0c\r"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
SOUND, TRUNCATION, FORCED = 0, 1, 2
FAULTS = ["blank", "duplicate", "truncated"]

_NOTHING, _SYSTEM, _USER, _ASSISTANT = range(4)
_FAR = 10**15
#: From state to state by a user or an assistant text: what may be inserted or a role set to.
_SPEAKS = [(_NOTHING, _USER), (_SYSTEM, _USER), (_ASSISTANT, _USER), (_USER, _ASSISTANT)]
#: The same by the initial of a row that is kept.
_KEEPS = {
    "s": [(_NOTHING, _SYSTEM)],
    "u": [(a, b) for a, b in _SPEAKS if b == _USER],
    "a": [(a, b) for a, b in _SPEAKS if b == _ASSISTANT],
}
_INITIALS = "sua"
#: Letters in ASCII order; 0 stands for the end.
_D, _I, _K, _R = 1, 2, 3, 4
#: In codes of single edits a new role is told by its letter: set to user or assistant, inserted user or assistant.
_CODES = np.frombuffer(b"  DDUAKKua", np.uint8).reshape(5, 2)


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of cost matrices: the cheapest way through a state between them."""
    return np.minimum((a[..., :, :, None] + b[..., None, :, :]).min(axis=-2), _FAR)


def _inserts() -> np.ndarray:
    once = np.where(np.eye(4, dtype=bool), 0, _FAR)
    for a, b in _SPEAKS:
        once[a, b] = INSERT
    return _product(once, once)


def _row_matrices() -> np.ndarray:
    """By initial (system, user, assistant, other) and condition: the costs of inserts before the row and of its edit."""
    edits = np.full((4, 3, 4, 4), _FAR)
    edits[:, :, range(4), range(4)] = DELETE
    for condition, extra in ((SOUND, 0), (TRUNCATION, TRUNCATED)):
        for a, b in _SPEAKS:
            edits[:, condition, a, b] = REROLE + extra
        for initial, ways in enumerate(_KEEPS[i] for i in _INITIALS):
            for a, b in ways:
                edits[initial, condition, a, b] = KEEP + extra
    return _product(_inserts(), edits)


_ROWS = _row_matrices()
#: Costs of the inserts that are due when no row is left.
_AT_END = _inserts()[:, [_NOTHING, _ASSISTANT]].min(axis=1)


def _suffix_products(matrices: np.ndarray, last: np.ndarray) -> np.ndarray:
    """For each row the product of its piece's matrices from there on; ``last`` is the last row of its piece."""
    out, here, step = matrices, np.arange(len(matrices)), 1
    while (more := here + step <= last).any():
        out = out.copy()
        out[more] = _product(out[more], out[here[more] + step])
        step *= 2
    return out


class _Pieces(NamedTuple):
    """The rows of a segment in order, and where its pieces begin."""

    table: pa.Table
    first: np.ndarray
    last: np.ndarray
    piece: np.ndarray
    initial: np.ndarray
    condition: np.ndarray


def _pieces(table: pa.Table) -> _Pieces:
    table = table.sort_by("pos").combine_chunks()
    ids = table["id"].combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy()
    starts = np.diff(ids, prepend=-1) != 0
    first, piece = np.flatnonzero(starts), np.cumsum(starts) - 1
    last = np.append(first[1:], len(ids)) - 1
    known = {letter: n for n, letter in enumerate(_INITIALS)}
    initial = np.array([known.get(x, len(_INITIALS)) for x in table["initial"].to_pylist()])
    return _Pieces(table, first, last, piece, initial, table["condition"].to_numpy())


def _summaries(table: pa.Table) -> pa.Table:
    """A row for each piece: counts, what its neighbours need to know, and its cost matrix."""
    p = _pieces(table)
    products = _suffix_products(_ROWS[p.initial, p.condition], p.last[p.piece])[p.first]
    initials = np.array(p.table["initial"].to_pylist(), dtype=object)
    pairs = initials[:-1] + initials[1:]
    legal = np.append(np.isin(pairs, ["su", "ua", "au"]), True)
    legal[p.last] = True
    turn = p.table["turn"].combine_chunks()
    given = turn.is_valid().to_numpy(zero_copy_only=False)
    turns = turn.fill_null(0).to_numpy()
    new_turn = given & ((np.diff(turns, prepend=0) != 0) | ~np.append(False, given[:-1]) | (np.diff(p.piece, prepend=-1) != 0))
    edge = np.zeros(len(p.first), bool)
    edge[[0, -1]] = True
    count = partial(np.bincount, p.piece, minlength=len(p.first))
    columns = {
        "id": p.table["id"].take(p.first),
        "segment": p.table["segment"].take(p.first),
        "at": p.table["pos"].take(p.first),
        "edge": pa.array(edge),
        "costs": pa.array(list(products.reshape(-1, 16)), pa.list_(pa.int64())),
        "illegal": pa.array(count(~legal).astype(int)),
        "turns": pa.array(count(new_turn).astype(int)),
        # Nulls come first, so the last turn is the greatest; the first one that is given is the least.
        "last_turn": turn.take(p.last),
        "first_turn": turn.take(np.minimum(p.first + count(~given).astype(int), p.last)),
        "first_initial": p.table["initial"].take(p.first),
        "last_initial": p.table["initial"].take(p.last),
    }
    faults = np.array(p.table["fault"].to_pylist(), dtype=object)
    columns |= {fault: pa.array(count(faults == fault).astype(int)) for fault in FAULTS}
    return pa.table(columns)


def _costs_beyond(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of a conversation from the last to the first: the costs from the end of each one on."""
    before, beyond = None, _AT_END
    for batch in batches:
        out, final = [], []
        ids = batch.column("id").to_pylist()
        for n, costs in enumerate(batch.column("costs").to_pylist()):
            final.append(before is None or before[0] != ids[n])
            if final[-1]:
                beyond = _AT_END
            out.append(beyond)
            beyond = (np.array(costs).reshape(4, 4) + beyond).min(axis=1)
            before = (ids[n],)
        columns = [batch.column("segment"), batch.column("at"), pa.array(out, pa.list_(pa.int64())), pa.array(final)]
        yield pa.RecordBatch.from_arrays(columns, names=["segment", "at", "beyond", "final"])


def least_audits(
    src: np.ndarray, letter: np.ndarray, dst: np.ndarray, stops: np.ndarray, starts: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ASCII-least paths from ``starts`` to a stop along arcs, as ``start number, from, to`` of their arcs in order.

    ``stops`` tells for every node whether it is one; each other node has an arc. At most one of the arcs between two
    nodes has the least letter.
    """
    nodes = len(stops)
    end = np.flatnonzero(stops)
    src, dst, letter = np.append(src, end), np.append(dst, end), np.append(letter, np.zeros(len(end), letter.dtype))
    rank = np.full(nodes, np.iinfo(letter.dtype).max)
    np.minimum.at(rank, src, letter)
    kept = letter == rank[src]
    keys = np.unique(src[kept] * nodes + dst[kept])
    levels: list[tuple[np.ndarray, np.ndarray | None]] = []
    between = None
    while True:
        here, there = keys // nodes, keys % nodes
        least = np.minimum.reduceat(rank[there], np.searchsorted(here, np.arange(nodes)))
        kept = rank[there] == least[here]
        levels.append((keys[kept], None if between is None else between[kept]))
        if stops[there].all():
            break
        here, there = here[kept], there[kept]
        rank = np.unique(rank * (int(rank.max()) + 1) + least, return_inverse=True)[1]
        first = np.searchsorted(here, np.arange(nodes + 1))
        ways = np.diff(first)[there]
        nth = np.arange(ways.sum()) - np.repeat(np.cumsum(ways) - ways, ways)
        far = there[np.repeat(first[there], ways) + nth]
        keys, pick = np.unique(np.repeat(here, ways) * nodes + far, return_index=True)
        between = np.repeat(there, ways)[pick]

    keys = levels[-1][0]
    begin = keys[np.searchsorted(keys, starts * nodes)]
    owner, here, there = np.arange(len(starts)), starts, begin % nodes
    for keys, between in reversed(levels[1:]):
        mid = between[np.searchsorted(keys, here * nodes + there)]
        owner = np.repeat(owner, 2)
        here, there = np.column_stack([here, mid]).ravel(), np.column_stack([mid, there]).ravel()
        going = ~stops[here]
        owner, here, there = owner[going], here[going], there[going]
    going = ~stops[here]
    return owner[going], here[going], there[going]


def _audits(table: pa.Table, ends: pa.Table) -> pa.Table:
    """For each piece and entry state: cost to the end of the conversation, exit state, a code of edits for each row."""
    p = _pieces(table)
    n_pieces = len(p.first)
    beyond, final = np.tile(_AT_END, (n_pieces, 1)), np.ones(n_pieces, bool)
    at = p.table["pos"].to_numpy()[p.first]
    known = np.searchsorted(at, ends["at"].to_numpy())
    edge = np.zeros(n_pieces, bool)
    if len(known):
        beyond[known] = np.array(ends["beyond"].to_pylist())
        final[known] = ends["final"].to_numpy(zero_copy_only=False)
        edge[known] = True

    # Boundaries: one before each row, one behind each piece.
    rows = np.arange(len(p.piece))
    before = rows + p.piece
    behind = p.last + 1 + np.arange(n_pieces)
    products = _suffix_products(_ROWS[p.initial, p.condition], p.last[p.piece])
    cost = np.empty((len(rows) + n_pieces, 4), np.int64)
    cost[before] = (products + beyond[p.piece][:, None, :]).min(axis=2)
    cost[behind] = beyond
    row_of = np.empty(len(cost), np.int64)
    row_of[before], row_of[behind] = rows, p.last

    arcs: list[tuple[np.ndarray, int, np.ndarray]] = []

    def arc(letter: int, a: int, b: int, at: np.ndarray, to: np.ndarray, price: np.ndarray | int) -> None:
        cheapest = cost[at, a] == cost[to, b] + price
        arcs.append((at[cheapest] * 4 + a, letter, to[cheapest] * 4 + b))

    inserting = np.concatenate([before, behind[final]])
    free = p.condition != FORCED
    extra = np.where(p.condition == TRUNCATION, TRUNCATED, 0)
    for a, b in _SPEAKS:
        arc(_I, a, b, inserting, inserting, INSERT)
        arc(_R, a, b, before[free], before[free] + 1, REROLE + extra[free])
    for state in range(4):
        arc(_D, state, state, before, before + 1, DELETE)
    for n, initial in enumerate(_INITIALS):
        own = free & (p.initial == n)
        for a, b in _KEEPS[initial]:
            arc(_K, a, b, before[own], before[own] + 1, KEEP + extra[own])
    src = np.concatenate([a[0] for a in arcs])
    letter = np.concatenate([np.full(len(a[0]), a[1]) for a in arcs])
    dst = np.concatenate([a[2] for a in arcs])
    stops = np.zeros((len(cost), 4), bool)
    stops[behind] = True
    stops[behind[final]] = cost[behind[final]] == 0

    entry = [(piece, state) for piece in range(n_pieces) for state in (range(4) if edge[piece] else [_NOTHING])]
    piece, state = np.array(entry).T
    starts = before[p.first[piece]] * 4 + state
    owner, here, there = least_audits(src, letter, dst, stops.ravel(), starts)
    exit_state = np.empty(len(starts), np.int64)
    exit_state[owner] = there % 4  # the last one stays

    least = np.full(stops.size, _R)
    np.minimum.at(least, src, letter)
    codes = _CODES[least[here], (there % 4 == _ASSISTANT).astype(int)].tobytes()
    sizes = (p.last - p.first + 1)[piece]
    offset = np.cumsum(sizes) - sizes
    slot = offset[owner] + row_of[here // 4] - p.first[piece[owner]]
    letters = np.bincount(slot, minlength=int(sizes.sum()))
    bounds = np.append(0, np.cumsum(letters)).astype(np.int32)
    texts = pa.StringArray.from_buffers(len(letters), pa.py_buffer(bounds), pa.py_buffer(codes))
    lists = pa.ListArray.from_arrays(pa.array(np.append(offset, len(letters)), pa.int32()), texts)
    return pa.table(
        {
            "id": p.table["id"].take(p.first[piece]),
            "at": pa.array(at[piece]),
            "edge": pa.array(edge[piece]),
            "entry": pa.array(state),
            "leaves": pa.array(exit_state),
            "cost": pa.array(cost.ravel()[starts]),
            "codes": lists,
        }
    )


def _chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of a conversation from the first to the last: of each the audit whose entry state is reached."""
    before, state, done = None, _NOTHING, None
    for batch in batches:
        taken = []
        columns = [batch.column(name).to_pylist() for name in ("id", "at", "entry", "leaves")]
        for n, (own, at, entry, leaves) in enumerate(zip(*columns, strict=True)):
            if before is None or before[0] != own:
                before, state = (own,), _NOTHING
            if at != done and entry == state:
                state, done = leaves, at
                taken.append(n)
        yield batch.take(pa.array(taken, pa.int64()))


def ordered_rows(df: DataFrame, id: str, turn: str, role: str, text: str, bits: int = SEGMENT_BITS) -> DataFrame:
    """``id, turn, role, text, pos, segment``, stored: positions in order, with gaps between tasks."""
    space = F.lit(" ")
    rows = df.select(
        F.col(f"`{id}`").alias("id"),
        F.col(f"`{turn}`").cast("long").alias("turn"),
        F.coalesce(F.col(f"`{role}`"), space).alias("role"),
        F.coalesce(F.col(f"`{text}`"), space).alias("text"),
    )
    rows = rows.withColumns({"head": F.left("text", F.lit(64)), "digest": F.md5("text"), "tie": F.monotonically_increasing_id()})
    order = ["id", "turn", "role", "head", "digest", "tie"]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("head", "digest", "tie")
    rows = rows.withColumn("pos", F.monotonically_increasing_id())
    return materialize(rows.withColumn("segment", F.shiftright("pos", bits)), "turns")


def with_faults(rows: DataFrame) -> DataFrame:
    """Rows of ``ordered_rows`` without their texts, with ``initial``, ``fault`` and ``condition``, stored."""
    visible = F.rtrim(F.col("text"), F.lit(WHITE_SPACE))
    facts = rows.select(
        "id", "turn", "pos", "segment",
        F.left("role", F.lit(1)).alias("initial"),
        F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256).alias("said"),
        (visible == "").alias("is_blank"),
        (~F.right(visible, F.lit(1)).isin(".", "!", "?")).alias("is_open"),
    )
    facts = materialize(facts, "turn-facts")
    repeated = facts.groupBy("id", "said").agg(F.min("pos").alias("said_at"), F.count(F.lit(1)).alias("n"))
    repeated = repeated.filter("n > 1").select(F.col("id").alias("of"), F.col("said").alias("said_of"), "said_at")
    same = (F.col("said") == F.col("said_of")) & F.col("id").eqNullSafe(F.col("of"))
    facts = facts.join(materialize(repeated, "said-again"), same, "left")
    again = F.col("pos") > F.col("said_at")
    fault = F.when(F.col("is_blank"), "blank").when(again, "duplicate").when(F.col("is_open"), "truncated")
    facts = facts.withColumn("fault", fault)
    condition = F.when(F.col("fault") == "truncated", TRUNCATION).when(F.col("fault").isNotNull(), FORCED).otherwise(SOUND)
    facts = facts.withColumn("condition", condition.cast("int"))
    return materialize(facts.select("id", "turn", "pos", "segment", "initial", "fault", "condition"), "turn-faults")


def repair(
    df: DataFrame, id: str, turn: str, role: str, text: str, bits: int = SEGMENT_BITS
) -> tuple[DataFrame, DataFrame]:
    """The edits in order, and a summary of every conversation.

    Edits are ``id, pos, nth, edit, role, text``: by ``pos`` and ``nth``; role and text are those after the edit,
    null for a deleted row. The summary has ``gaps``, the counts of faults, ``illegal`` and ``cost``.
    """
    rows = ordered_rows(df, id, turn, role, text, bits)
    facts = with_faults(rows)
    kind = rows.schema["id"].dataType.simpleString()
    counts = ", ".join(f"{f} long" for f in FAULTS)
    pieces = materialize(
        facts.groupBy("segment").applyInArrow(
            _summaries,
            f"id {kind}, segment long, at long, edge boolean, costs array<long>, illegal long, turns long, "
            f"last_turn long, first_turn long, first_initial string, last_initial string, {counts}",
        ),
        "pieces",
    )
    cut = pieces.filter("edge").select("id", "segment", "at", "costs")
    ends = cut.repartition("id").sortWithinPartitions("id", F.desc("at"))
    ends = materialize(ends.mapInArrow(_costs_beyond, "segment long, at long, beyond array<long>, final boolean"), "ends")
    audits = facts.groupBy("segment").cogroup(ends.groupBy("segment")).applyInArrow(
        _audits, f"id {kind}, at long, edge boolean, entry long, leaves long, cost long, codes array<string>"
    )
    audits = materialize(audits, "audits")
    scanned = audits.filter("edge").repartition("id").sortWithinPartitions("id", "at", "entry")
    chosen = scanned.mapInArrow(_chosen, audits.schema).unionByName(audits.filter("NOT edge"))
    chosen = materialize(chosen.select("id", "at", "cost", "codes"), "chosen-audits")
    return _edits(rows, chosen), _summary(pieces, chosen)


def _edits(rows: DataFrame, chosen: DataFrame) -> DataFrame:
    changes = chosen.select("at", F.posexplode("codes").alias("nth", "code")).filter("code <> 'K'")
    changes = materialize(changes.select((F.col("at") + F.col("nth")).alias("pos"), "code"), "row-edits")
    coded = rows.join(changes, "pos", "left").withColumn("code", F.coalesce("code", F.lit("K")))
    letters = F.transform(F.sequence(F.lit(1), F.length("code")), lambda n: F.substr("code", n, F.lit(1)))
    each = coded.select("id", "pos", "role", "text", F.posexplode(letters).alias("nth", "code"))
    speaker = F.when(F.lower("code") == "u", "user").otherwise("assistant")
    return each.select(
        "id", "pos", "nth",
        F.translate("code", "uaUA", "RRII").alias("edit"),
        F.when(F.col("code") == "K", F.col("role")).when(F.col("code") != "D", speaker).alias("role"),
        F.when(F.col("code").isin("U", "A"), "").when(F.col("code") != "D", F.col("text")).alias("text"),
    )


def _summary(pieces: DataFrame, chosen: DataFrame) -> DataFrame:
    order = Window.partitionBy("id").orderBy("at")
    pair = F.concat(F.lag("last_initial").over(order), "first_initial")
    joined = pieces.withColumns(
        {
            "apart": F.coalesce(~pair.isin("su", "ua", "au"), F.lit(False)).cast("long"),
            "shared": F.coalesce(F.lag("last_turn").over(order) == F.col("first_turn"), F.lit(False)).cast("long"),
        }
    )
    span = F.max("last_turn") - F.min("first_turn") + 1 - F.sum("turns") + F.sum("shared")
    counted = joined.groupBy("id").agg(
        F.coalesce(span, F.lit(0).cast("long")).alias("gaps"),
        *[F.sum(f).alias(f) for f in FAULTS],
        F.sum(F.col("illegal") + F.col("apart")).alias("illegal"),
    )
    # The cost to the end is greatest at the start.
    costs = chosen.groupBy(F.col("id").alias("of")).agg(F.max("cost").alias("cost"))
    return counted.join(costs, F.col("id").eqNullSafe(F.col("of"))).drop("of")
