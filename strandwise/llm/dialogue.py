"""Conversation structure repair: the cheapest edits that make roles alternate, by a time-major tensor of state costs.

Roles must read `(s?(ua)+)?`: nothing, or an optional system turn and pairs of user and assistant. The grammar has four
states; the next turn that may be put in (or re-roled to) is fixed by the state. Conversations of a task are bucketed by
length; the costs-to-go of all conversations of a bucket are one array [turn, conversation, state], filled turn by turn
from the end and kept, and the edits of all of them are traced forward together. Among cheapest edits the ASCII-least
string wins, which the trace gets by taking the least letter that keeps the cost.

A conversation is cut into segments of SEGMENT rows. Of those with more than one, each segment first gives a (min, +)
matrix from its entry to its exit states, and the costs behind each segment are products of the later matrices, found by
doubling joins over a row a segment. So the costs of no conversation are gathered, however long; only its rows pass one
task in order, a buffer at a time, because what is written (and the digest of it) is one sequence."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandwise.operators.order import numbered
from strandwise.sources.files import left_join_counted, small

from .common import materialize, small_batches

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
REROLE_COST, DELETE_COST, INSERT_COST, LATE_COST = 2, 3, 2, 1
BLANKS = " \t\n\x0b\f\r"
SEGMENT = 512  # rows whose costs are in memory at once
BUFFER_ROWS, BUFFER_BYTES = 16_384, 8 << 20  # of whole segments

# States: nothing yet, system turn, user turn, assistant turn; initials: s, u, a, any other.
NEXT = np.array([2, 2, 3, 2])  # where the only turn leads that may be put in
AFTER = np.array([[1, 2, -1, -1], [-1, 2, -1, -1], [-1, -1, 3, -1], [-1, 2, -1, -1]])  # state, initial: where keeping leads
FINAL = np.array([0, 4, 2, 0])  # what it costs to end
ADDED = {2: "user", 3: "assistant"}
BIG = 1 << 40

BLANK, DUPLICATE, TRUNCATED = "blank", "duplicate", "truncated"


def cost_tensor(must: np.ndarray, late: np.ndarray, initial: np.ndarray, skip: np.ndarray, behind: np.ndarray) -> np.ndarray:
    """Costs-to-go [turn + 1, conversation, state, ...] of turns [turn, conversation]; behind [conversation, state, ...]."""
    tail = (1,) * (behind.ndim - 2)
    costs = np.empty((len(must) + 1, *behind.shape), np.int64)
    costs[-1] = behind
    rows = np.arange(behind.shape[0])[:, None]
    for t in range(len(must) - 1, -1, -1):
        after = costs[t + 1]
        extra = late[t].reshape(-1, 1, *tail)
        to = AFTER[:, initial[t]].T
        kept = np.where((to < 0).reshape(*to.shape, *tail), BIG, after[rows, to] + extra)
        other = np.minimum(kept, after[:, NEXT] + REROLE_COST + extra)
        best = after + DELETE_COST
        best = np.where(must[t].reshape(-1, 1, *tail), best, np.minimum(best, other))
        for _ in range(3):  # turns put in before this one
            best = np.minimum(best, best[:, NEXT] + INSERT_COST)
        costs[t] = np.where(skip[t].reshape(-1, 1, *tail), after, best)
    return costs


def trace(costs: np.ndarray, must: np.ndarray, late: np.ndarray, initial: np.ndarray, skip: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(state before, turns put in, edit) of each turn and the state at the end, from the state of each conversation."""
    n = np.arange(len(state))
    entry, added, edit = (np.zeros(must.shape, np.int64) for _ in range(3))
    for t in range(len(must)):
        entry[t] = state
        ways = ~skip[t]
        for _ in range(3):
            here = costs[t, n, state]
            put = ways & (costs[t + 1, n, state] + DELETE_COST != here) & (costs[t, n, NEXT[state]] + INSERT_COST == here)
            state = np.where(put, NEXT[state], state)
            added[t] += put
        here, to = costs[t, n, state], AFTER[state, initial[t]]
        drop = costs[t + 1, n, state] + DELETE_COST == here
        keep = ~drop & ~must[t] & (to >= 0) & (costs[t + 1, n, to] + late[t] == here)
        edit[t] = np.select([drop, keep], [ord(DELETE), ord(KEEP)], ord(REROLE))
        state = np.where(skip[t] | drop, state, np.where(keep, to, NEXT[state]))
    return entry, added, edit, state


def _buckets(sizes: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(turns, conversations) by length: powers of two, and not longer than the longest there."""
    width = 1 << np.ceil(np.log2(np.maximum(sizes, 1))).astype(np.int64)
    for w in np.unique(width):
        which = np.flatnonzero(width == w)
        yield int(sizes[which].max()), which


def _tensor(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray, turns: int) -> tuple[np.ndarray, np.ndarray]:
    """[turn, conversation] of values in a row, and which places are beyond a conversation's end."""
    at = np.arange(turns)[:, None]
    skip = at >= sizes[None, :]
    return values[np.where(skip, 0, starts[None, :] + at)], skip


def _codes(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    fault = batch.column("fault").to_pylist()
    return (
        np.array([f in (BLANK, DUPLICATE) for f in fault], bool), np.array([f == TRUNCATED for f in fault], np.int64) * LATE_COST,
        np.array(["sua".find(x) if x else 3 for x in batch.column("initial").to_pylist()], np.int64) % 4,
    )


def _whole_segments(batches: Iterator[pa.RecordBatch], rows: int, size: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Batches of whole segments, and where segments start in each; rows come by (conversation, number)."""
    held: list[pa.RecordBatch] = []

    def joined() -> pa.RecordBatch:
        return held[0] if len(held) == 1 else pa.Table.from_batches(held).combine_chunks().to_batches(max_chunksize=None)[0]

    def starts(batch: pa.RecordBatch) -> np.ndarray:
        key = batch.column("__first").to_numpy(zero_copy_only=False), batch.column("__seg").to_numpy(zero_copy_only=False)
        new = np.ones(batch.num_rows, bool)
        new[1:] = (key[0][1:] != key[0][:-1]) | (key[1][1:] != key[1][:-1])
        return np.flatnonzero(new)

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        if sum(b.num_rows for b in held) >= rows or sum(b.nbytes for b in held) >= size:
            whole = joined()
            at = starts(whole)
            if len(at) > 1:
                yield whole.slice(0, int(at[-1])), at[:-1]
                held = [whole.slice(int(at[-1]))]
            else:
                held = [whole]
    if held:
        whole = joined()
        yield whole, starts(whole)


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(__first, __seg, m): the 16 costs from each state at a segment's start to each at its end."""
    for batch, starts in _whole_segments(batches, BUFFER_ROWS, BUFFER_BYTES):
        must, late, initial = _codes(batch)
        sizes = np.diff([*starts, batch.num_rows])
        found = np.zeros((len(starts), 16), np.int64)
        for turns, which in _buckets(sizes):
            (m, skip), (x, _), (i, _) = (_tensor(v, starts[which], sizes[which], turns) for v in (must, late, initial))
            ends = np.broadcast_to(np.where(np.eye(4, dtype=bool), 0, BIG), (len(which), 4, 4))
            found[which] = cost_tensor(m, x, i, skip, ends)[0].reshape(-1, 16)
        yield pa.RecordBatch.from_arrays(
            [batch.column("__first").take(pa.array(starts)), batch.column("__seg").take(pa.array(starts)), pa.array(found.tolist(), pa.list_(pa.int64()))], ["__first", "__seg", "m"]
        )


def _product(a: str, b: str) -> Column:
    """(min, +) product of 4 x 4 matrices in arrays of 16."""
    return F.array(*(F.least(*(F.col(a)[4 * i + k] + F.col(b)[4 * k + j] for k in range(4))) for i in range(4) for j in range(4)))


def _behind(matrices: DataFrame) -> DataFrame:
    """(__first, __seg, behind): costs-to-go behind each segment but the last, by doubling: a row a segment, log rounds."""
    rows = materialize(matrices, "matrices")
    top, step = rows.agg(F.max("__seg")).first()[0] or 0, 1
    while step <= top:
        later = rows.select("__first", (F.col("__seg") - step).alias("__seg"), F.col("m").alias("later"))
        joined = rows.join(later, ["__first", "__seg"], "left")
        rows = materialize(joined.select("__first", "__seg", F.when(F.col("later").isNotNull(), _product("m", "later")).otherwise(F.col("m")).alias("m")), "matrices")
        step *= 2
    costs = F.array(*(F.least(*(F.col("m")[4 * i + k] + int(FINAL[k]) for k in range(4))) for i in range(4)))
    return rows.where("__seg > 0").select("__first", (F.col("__seg") - 1).alias("__seg"), costs.alias("behind"))


_ROWS = "no long, turn long, edit string, role string, text string, fault string, initial string"
_EDITED = ["conv_id", "no", "turn", "edit", "role", "text", "fault", "initial"]


def _edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of _EDITED, in order: an edit a row, turns put in among them."""
    last, carry = None, 0
    for batch, starts in _whole_segments(batches, BUFFER_ROWS, BUFFER_BYTES):
        must, late, initial = _codes(batch)
        sizes = np.diff([*starts, batch.num_rows])
        first = batch.column("__first").take(pa.array(starts)).to_numpy()
        behind = [x if x is not None else FINAL for x in batch.column("behind").take(pa.array(starts)).to_pylist()]
        behind = np.array(behind, np.int64).reshape(-1, 4)
        nth = np.zeros(len(starts), np.int64)  # which segment of its conversation in this buffer
        for k in range(1, len(starts)):
            nth[k] = nth[k - 1] + 1 if first[k] == first[k - 1] else 0
        exits = np.zeros(len(starts), np.int64)
        entry, added, edit = (np.zeros(batch.num_rows, np.int64) for _ in range(3))
        for wave in range(int(nth.max()) + 1):
            now = np.flatnonzero(nth == wave)
            enter = exits[now - 1] if wave else np.where((now == 0) & (first[now] == last), carry, 0)
            for turns, inside in _buckets(sizes[now]):
                which = now[inside]
                (m, skip), (x, _), (i, _) = (_tensor(v, starts[which], sizes[which], turns) for v in (must, late, initial))
                costs = cost_tensor(m, x, i, skip, behind[which])
                e, a, d, exits[which] = trace(costs, m, x, i, skip, enter[inside])
                where = (starts[which][None, :] + np.arange(turns)[:, None])[~skip]
                entry[where], added[where], edit[where] = e[~skip], a[~skip], d[~skip]
        last, carry = first[-1], int(exits[-1])
        ends = set((starts[1:] - 1)[np.diff(first) != 0].tolist())  # the buffer's last conversation may go on
        yield from _written(batch, entry, added, edit, ends, exits[np.searchsorted(starts, np.arange(batch.num_rows), "right") - 1])


def _written(batch: pa.RecordBatch, entry: np.ndarray, added: np.ndarray, edit: np.ndarray, ends: set[int], exits: np.ndarray) -> Iterator[pa.RecordBatch]:
    out: list[list] = [[] for _ in _EDITED]
    columns = [batch.column(c).to_pylist() for c in ("conv_id", "no", "turn", "role", "text", "fault", "initial", "__last")]
    for i, (conv, no, turn, role, text, fault, first, closing) in enumerate(zip(*columns, strict=True)):
        state = int(entry[i])
        for _ in range(added[i]):
            state = int(NEXT[state])
            for o, v in zip(out, (conv, no, None, INSERT, ADDED[state], "", None, None), strict=True):
                o.append(v)
        letter = chr(edit[i])
        row = (None, None) if letter == DELETE else (ADDED[int(NEXT[state])] if letter == REROLE else role, text)
        for o, v in zip(out, (conv, no, turn, letter, *row, fault, first), strict=True):
            o.append(v)
        state = int(exits[i])
        while closing and FINAL[state]:
            state = int(NEXT[state])
            for o, v in zip(out, (conv, no, None, INSERT, ADDED[state], "", None, None), strict=True):
                o.append(v)
    types = [batch.schema.field("conv_id").type, pa.int64(), pa.int64(), *[pa.string()] * 5]
    yield pa.RecordBatch.from_arrays([pa.array(o, t) for o, t in zip(out, types, strict=True)], _EDITED)


def _prepared(df: DataFrame, segment: int) -> DataFrame:
    """Rows in the order of their conversations, a conversation in one partition, with faults, segments and costs behind."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    key = F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("-"))
    rows = df.select(key.alias("__c"), "conv_id", F.col("turn").cast("long").alias("turn"), space("role").alias("role"), space("text").alias("text"))
    rows = rows.withColumns({"__h": F.xxhash64("role", "text"), "__h2": F.xxhash64("text", F.lit(7), "role"), "__row": F.monotonically_increasing_id()})
    rows = numbered(rows, ["__c", "turn", "role", "__h", "__row"], "no").drop("__row")
    groups = materialize(rows.groupBy("__c").agg(F.min("no").alias("__first"), F.max("no").alias("__end"), F.count(F.lit(1)).alias("__n")), "conversations")
    again = rows.groupBy("__c", "__h", "__h2").agg(F.min("no").alias("__seen"), F.count(F.lit(1)).alias("__n")).where("__n > 1")
    again = materialize(again, "repeated")  # only what comes twice or more
    rows = left_join_counted(rows, again, ["__c", "__h", "__h2"], "__n").drop("__h", "__h2")
    rows = left_join_counted(rows, groups, ["__c"], "__n")
    text = F.rtrim(F.col("text"), F.lit(BLANKS))
    fault = F.when(text == "", BLANK).when(F.col("no") > F.col("__seen"), DUPLICATE).when(~F.right(text, F.lit(1)).isin(".", "!", "?"), TRUNCATED)
    rows = rows.select(
        "__c", "__first", "conv_id", "no", "turn", "role", "text", fault.alias("fault"), F.left("role", F.lit(1)).alias("initial"),
        F.floor((F.col("no") - F.col("__first")) / segment).alias("__seg"), (F.col("no") == F.col("__end")).alias("__last"), (F.col("__end") - F.col("__first") >= segment).alias("__long"),
    )
    if groups.where(F.col("__n") > segment).isEmpty():
        rows = rows.withColumn("behind", F.lit(None).cast("array<bigint>"))
    else:
        narrow = rows.where("__long").select("__first", "__seg", "no", "fault", "initial")
        cut = narrow.repartition("__first", "__seg").sortWithinPartitions("__first", "__seg", "no")
        behind = _behind(cut.mapInArrow(_matrices, "__first long, __seg long, m array<bigint>"))
        rows = rows.join(small(behind), ["__first", "__seg"], "left")
    return rows.drop("__c", "__long").repartition("__first").sortWithinPartitions("__first", "no")


def repaired_turns(df: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """(conv_id, no, turn, edit, role, text, fault, initial): the edits of each conversation (conv_id, turn, role, text).

    A row an edit: K keeps a turn, R gives it the role `role`, D deletes it (role and text null), I puts in a turn with an
    empty text, before the turn that has the same `no`, or at the end. `no` grows along a conversation; `fault` is the
    first of blank, duplicate and truncated that an original turn has, `initial` its role's. Rows of a conversation come
    in order, in one partition.

    Turns go by `turn`, nulls first; ties by role and the text's hash. Null role and text are one space, which no grammar
    has, so that such a turn is given a role or deleted. Rows without conv_id are one conversation. Repeated rows are
    duplicates. Other columns are not read. No rows give no rows. A segment's texts are in memory at once."""
    small_batches(df.sparkSession)
    kind = df.schema["conv_id"].dataType.simpleString()
    return _prepared(df, segment).mapInArrow(_edits, f"conv_id {kind}, {_ROWS}")


_DIGEST = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


class _Summary:
    """Counters of one conversation whose edits come in order."""

    def __init__(self):
        self.turns, self.low, self.high, self.turn = 0, None, None, None
        self.faults = dict.fromkeys((BLANK, DUPLICATE, TRUNCATED), 0)
        self.illegal, self.cost, self.before = 0, 0, None
        self.audit, self.sha, self.any = [], hashlib.sha256(), False

    def add(self, turn, edit, role, text, fault, initial) -> None:
        self.audit.append(edit)
        self.cost += {KEEP: 0, REROLE: REROLE_COST, DELETE: DELETE_COST, INSERT: INSERT_COST}[edit]
        if edit != INSERT:
            if turn is not None and turn != self.turn:
                self.low = turn if self.low is None else self.low
                self.high, self.turn, self.turns = turn, turn, self.turns + 1
            if fault:
                self.faults[fault] += 1
                self.cost += LATE_COST * (fault == TRUNCATED and edit != DELETE)
            self.illegal += self.before is not None and self.before + initial not in ("su", "ua", "au")
            self.before = initial
        if edit != DELETE:
            self.sha.update(("\n" * self.any + f"{role}:{text}").encode())
            self.any = True

    def row(self) -> tuple:
        gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        return gaps, *self.faults.values(), self.illegal, self.cost, "".join(self.audit), self.sha.hexdigest()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    conv, open_ = None, None
    for batch in _edits(batches):
        done = []
        for row_conv, no, *rest in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if open_ is None or row_conv != conv:
                if open_ is not None:
                    done.append((conv, *open_.row()))
                conv, open_ = row_conv, _Summary()
            open_.add(*rest)
        if done:
            yield _digest_batch(done, batch.schema.field("conv_id").type)
        kind = batch.schema.field("conv_id").type
    if open_ is not None:
        yield _digest_batch([(conv, *open_.row())], kind)


def _digest_batch(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    names = ["conv_id", *(x.split()[0] for x in _DIGEST.split(", "))]
    types = [kind, *[pa.int64()] * 6, pa.string(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)


def conversation_digests(df: DataFrame, every: DataFrame | None = None, segment: int = SEGMENT) -> DataFrame:
    """A row a conversation, from its repaired_turns: gaps, counts of faults, illegal pairs of roles, cost, the edits'
    letters (audit) and the sha256 of the repaired `role:text` lines.

    every (conv_id): conversations that get a row of zeros where `df` has none of their rows."""
    small_batches(df.sparkSession)
    kind = df.schema["conv_id"].dataType.simpleString()
    found = _prepared(df, segment).mapInArrow(_digests, f"conv_id {kind}, {_DIGEST}")
    if every is None:
        return found
    names = every.select("conv_id").distinct()
    joined = names.join(found.withColumnRenamed("conv_id", "__id"), F.col("conv_id").eqNullSafe(F.col("__id")), "left").drop("__id")
    empty = {c: 0 for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")} | {"audit": "", "repaired_sha256": hashlib.sha256(b"").hexdigest()}
    return joined.fillna(empty)


def damaged(df: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) with damage that the crc32 of conv_id:turn chooses: of twenty values 0 drops the row, 1
    empties its text, 2 takes its sentence ends, 3 repeats it, 4 makes its role user. Nulls are one space."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20
    role = F.when(kind == 4, "user").otherwise(space("role"))
    text = F.when(kind == 1, "").when(kind == 2, F.translate(space("text"), ".!?", "")).otherwise(space("text"))
    rows = df.select("conv_id", "turn", role.alias("role"), text.alias("text"), kind.alias("__kind")).where("__kind <> 0")
    return rows.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.when(F.col("__kind") == 3, 2).otherwise(1)))).drop("__kind", "__copy")
