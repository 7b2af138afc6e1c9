"""Conversation structure repair by a lightest-derivation agenda (Knuth).

A repair is a derivation: the item ``At(i, state)`` says that the first ``i`` rows have been
dealt with and that the roles written so far put the grammar ``(s?(ua)+)?`` in ``state``.
Deductions combine ``At(i, state)`` with the axiom ``Row(i)``: Keep, Rerole and Delete lead to
``At(i + 1, ...)``, Insert needs no row and stays at ``i``, and the goal follows from
``At(n, START)`` or ``At(n, AFTER_A)``. A value is (cost, audit). Every deduction adds a cost
that is not negative and one letter at the end of the audit, so it is superior (no conclusion
is below an antecedent; axioms carry the least value and are final from the start), and it is
monotone: two audits of one item and one cost read the same rows with as many inserts, so none
is a prefix of the other. The first pop of an item is therefore its lightest derivation, ties
going to the audit that is least in ASCII, and the agenda stops when the goal is popped.

Conversations are dealt out by ranges of (conv_id, turn, ...), which splits a hot conversation
over many tasks. A conversation that lies inside one task and has at most ``SEGMENT_ROWS`` rows
is repaired there. The others ("long": hot ones, and the one or two at the borders of a task)
are cut into segments. An agenda gives each segment's lightest derivation from each state to
each state, and a stream over the segments chains them in order. Nothing is capped, and the
bound only chooses where the work runs: both ways give the same rows.

Defined results: null conv_id is one conversation of its own; null role and text read as one
space, null turn comes first (rows of equal turn: by role, text hash, copies last). An empty
role has no initial and can't be kept. Repeated rows are duplicates. Extra columns are left out.
An empty table gives no rows. A conversation without rows gets zeros and an empty audit.
"""

from __future__ import annotations

import hashlib
import heapq
import os
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barmarts.llm.common import SPACES, Workspace, ship_package

#: Rows (and characters) of a conversation that one task takes at once; beyond, segments.
SEGMENT_ROWS = 2_000
SEGMENT_CHARS = 1 << 24
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
START, AFTER_S, AFTER_U, AFTER_A = STATES = range(4)
#: Per state: the initial that may come next, and the state after it.
NEXT = (("u", AFTER_U), ("u", AFTER_U), ("a", AFTER_A), ("u", AFTER_U))
ROLE = {"u": "user", "a": "assistant"}
LEGAL = {"su", "ua", "au"}
SOUND, BLANK, DUPLICATE, CUT = range(4)

Row = tuple[str, int]  # initial of the role, fault
Value = tuple[int, str]  # cost, audit


def damage(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copy, lost): the test damage of crc32(`conv_id:turn`) % 20.

    Code 0 drops a row (it stays as ``lost``, so that its conversation stays known), 1 empties
    the text, 2 removes its ``.!?``, 3 repeats the row, 4 sets the role to user.
    """
    key = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    code = F.col("code")
    out = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.crc32(key.cast("binary")) % 20).alias("code"))
    out = out.select(
        "conv_id", "turn", F.when(code == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(code <= 1, "").when(code == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        (code == 0).alias("lost"), F.when(code == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))).alias("copy"))
    return out.withColumn("copy", F.explode("copy"))


def lightest(rows: list[Row], start: int, goal: bool = True) -> Value | list[Value]:
    """The goal's lightest value from ``At(0, start)``; with ``goal=False`` the value of every
    ``At(n, state)``."""
    n = len(rows)
    agenda: list[tuple[int, str, int]] = [(0, "", start)]
    final: dict[int, Value] = {}
    ends, last = 4 if not goal else 0, 4 * n
    while agenda:
        cost, audit, item = heapq.heappop(agenda)
        if item < 0:  # the goal
            return cost, audit
        if item in final:
            continue
        final[item] = cost, audit
        i, state = item >> 2, item & 3
        wanted, after = NEXT[state]
        push = [(cost + INSERT, audit + "I", item - state + after)]
        if i < n:
            initial, fault = rows[i]
            push.append((cost + DELETE, audit + "D", item + 4))
            if fault in (SOUND, CUT):
                more, at = cost + (TRUNCATED if fault == CUT else 0), item - state + 4
                if initial == wanted:
                    push.append((more + KEEP, audit + "K", at + after))
                elif initial == "s" and state == START:
                    push.append((more + KEEP, audit + "K", at + AFTER_S))
                push.append((more + REROLE, audit + "R", at + after))
        elif not goal:
            ends -= 1
            if not ends:
                break
        elif state in (START, AFTER_A):
            push.append((cost, audit, -1))
        for p in push:
            if p[2] not in final:
                heapq.heappush(agenda, p)
    return [final.get(last + s) for s in STATES]  # START is reached from START alone


def replay(audit: Iterable[str], rows: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str]]:
    """The repaired (role, text) messages that an audit makes of (role, text) rows."""
    state = START
    for letter in audit:
        role, text = next(rows) if letter != "I" else ("", "")
        if letter == "D":
            continue
        if letter == "K" and role[:1] == "s":
            state = AFTER_S
        else:
            wanted, state = NEXT[state]
            role = role if letter == "K" else ROLE[wanted]
        yield role, text


def row_fault(text: str) -> int:
    bare = text.strip(SPACES)
    return BLANK if not bare else SOUND if bare[-1] in ".!?" else CUT


class Run(NamedTuple):
    """What a stretch of a conversation's rows, in order, adds to the counts."""
    first_turn: int | None
    last_turn: int | None
    turns: int
    first_role: str
    last_role: str
    illegal: int


def measure(turns: list[int | None], initials: list[str]) -> Run:
    known = [t for t in turns if t is not None]
    pairs = sum(a + b not in LEGAL for a, b in zip(initials, initials[1:]))
    return Run(known[0] if known else None, known[-1] if known else None, len(set(known)), initials[0], initials[-1], pairs)


MESSAGE = T.StructType([T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])
COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def _fields(conv: T.StructField, turn: T.StructField) -> T.StructType:
    long, text = T.LongType(), T.StringType()
    return T.StructType([
        T.StructField("conv_id", conv.dataType), *(T.StructField(c, long) for c in COUNTS), T.StructField("audit", text),
        T.StructField("repaired", T.ArrayType(MESSAGE)),
        # rows of long conversations, for the second way
        T.StructField("pos", long), T.StructField("turn", turn.dataType), T.StructField("role", text), T.StructField("text", text)])


def _whole(turns: list, roles: list[str], texts: list[str]) -> tuple:
    """Counts, audit and messages of one conversation that is here as a whole."""
    if not roles:
        return 0, 0, 0, 0, 0, 0, "", []
    seen, rows, faults = set(), [], [0, 0, 0, 0]
    for role, text in zip(roles, texts):
        fault = row_fault(text)
        if fault != BLANK:
            if (role, text) in seen:
                fault = DUPLICATE
            else:
                seen.add((role, text))
        faults[fault] += 1
        rows.append((role[:1], fault))
    run = measure(turns, [r for r, _ in rows])
    gaps = run.last_turn - run.first_turn + 1 - run.turns if run.turns else 0
    cost, audit = lightest(rows, START)
    messages = [{"role": r, "text": t} for r, t in replay(audit, zip(roles, texts))]
    return gaps, *faults[1:], run.illegal, cost, audit, messages


class Repair(NamedTuple):
    """``summary``: one row per conversation (conv_id, counts, cost, audit, ``repaired`` messages;
    null for long ones). ``messages``: (conv_id, pos, piece, role, text), the rows of long
    conversations with the audit piece that applies to them (inserts go before their row; those
    after the last row stand alone at the end)."""
    summary: DataFrame
    messages: DataFrame


def repair(rows: DataFrame, segment_rows: int = SEGMENT_ROWS) -> Repair:
    """Repair conversations given as (conv_id, turn, role, text[, copy, lost]) rows."""
    spark = rows.sparkSession
    ship_package(spark)
    ws = Workspace(spark, "repair")
    have = set(rows.columns)
    rows = rows.select("conv_id", "turn", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")),
                       (F.col("copy") if "copy" in have else F.lit(0)).alias("copy"), (F.col("lost") if "lost" in have else F.lit(False)).alias("lost"))
    # the id of the scan only separates equal rows, so that they too can be dealt to several ranges
    order = ["conv_id", "turn", "role", "hash", "copy", "id"]
    placed = rows.withColumns({"hash": F.xxhash64("text"), "id": F.monotonically_increasing_id()})
    placed = placed.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "turn", "role", "text", "lost")
    schema = _fields(rows.schema["conv_id"], rows.schema["turn"])
    first_pass = ws.store(placed.mapInArrow(_first_pass(schema, segment_rows), schema), "first")
    whole = first_pass.where(F.col("pos").isNull()).select("conv_id", *COUNTS, "audit", "repaired")
    summary, messages = _long(ws, first_pass.where(F.col("pos").isNotNull()).select("conv_id", "pos", "turn", "role", "text"), segment_rows)
    return Repair(whole.unionByName(summary.withColumn("repaired", F.lit(None).cast(T.ArrayType(MESSAGE)))), messages)


def _first_pass(schema: T.StructType, segment_rows: int):
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema
        arrow = to_arrow_schema(schema)
        base, out = TaskContext.get().partitionId() << 40, []
        now, is_open, buffer, held, seq = None, True, [], 0, 0

        def give_up():  # the buffered rows belong to a long conversation
            nonlocal buffer, held
            out.extend(dict(zip(names, (now[0], *[None] * 8, *r))) for r in buffer)
            buffer, held = [], 0

        def finish():
            nonlocal buffer, held
            kept = [r for r in buffer if r[2] is not None]
            out.append(dict(zip(names, (now[0], *_whole([r[1] for r in kept], [r[2] for r in kept], [r[3] for r in kept])))))
            buffer, held = [], 0

        for batch in batches:
            for conv, turn, role, text, lost in zip(*(c.to_pylist() for c in batch.columns)):
                if now is None or now[0] != conv:
                    if now is not None and not is_open:
                        finish()
                    # the first conversation may have begun in the range before
                    is_open, now = now is None, (conv,)
                buffer.append((base + seq, turn, None, None) if lost else (base + seq, turn, role, text))
                held, seq = held + len(text), seq + 1
                if is_open or len(buffer) > segment_rows or held > SEGMENT_CHARS:
                    is_open = True
                    give_up()
                if len(out) >= 2000:
                    yield pa.RecordBatch.from_pylist(out, schema=arrow)
                    out = []
        if now is not None:  # the last one may go on in the next range
            give_up()
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=arrow)

    return run


RUN = "first_turn {t}, last_turn {t}, turns long, first_role string, last_role string, illegal long"


def _long(ws: Workspace, rows: DataFrame, segment_rows: int) -> tuple[DataFrame, DataFrame]:
    """Long conversations: faults by aggregates, segments by agendas, a stream that chains them."""
    kept = rows.where(F.col("role").isNotNull())
    bare = F.btrim("text", F.lit(SPACES))
    slim = kept.select("conv_id", "pos", "turn", F.substring("role", 1, 1).alias("initial"),
                       F.when(bare == "", BLANK).when(F.substring(bare, -1, 1).isin(".", "!", "?"), SOUND).otherwise(CUT).alias("fault"),
                       F.sha2(F.concat_ws(":", F.length("role"), "role", "text").cast("binary"), 256).alias("said"))
    # the first row of each (role, text): an aggregate that combines before the shuffle
    firsts = slim.where(F.col("fault") != BLANK).groupBy("conv_id", "said").agg(F.min("pos").alias("pos")).select("pos", F.lit(True).alias("is_first"))
    judged = slim.drop("said").join(firsts, "pos", "left").withColumn(
        "fault", F.when((F.col("fault") != BLANK) & F.col("is_first").isNull(), DUPLICATE).otherwise(F.col("fault"))).drop("is_first")
    place = [F.shiftright("pos", 40).alias("part"), F.expr(f"int((pos & {(1 << 40) - 1}) div {segment_rows})").alias("segment")]
    segments = (judged.groupBy("conv_id", *place)
                .agg(F.sort_array(F.collect_list(F.struct("pos", "turn", "initial", "fault"))).alias("rows"))
                .withColumn("at", F.col("rows")[0]["pos"]))
    turn = rows.schema["turn"].dataType.simpleString()
    table = "array<struct<cost:long,audit:string>>"
    done = ws.store(segments.select("conv_id", "at", "rows").mapInArrow(
        _segment_tables, _with(rows.schema["conv_id"], f"at long, {RUN.format(t=turn)}, blank long, duplicate long, truncated long, tables array<{table}>")), "segments")
    chained = ws.store(done.repartition("conv_id").sortWithinPartitions("conv_id", "at").mapInArrow(
        _chain, _with(rows.schema["conv_id"], "at long, " + ", ".join(f"{c} long" for c in COUNTS) + ", audit string, piece string")), "chained")
    known = chained.where(F.col("at").isNull()).select("conv_id", *COUNTS, "audit")
    # conversations of which no row is left
    ids = rows.select("conv_id").distinct()
    empty = ids.join(known.select("conv_id"), ids["conv_id"].eqNullSafe(known["conv_id"]), "left_anti")
    summary = known.unionByName(empty.select("conv_id", *(F.lit(0).cast("long").alias(c) for c in COUNTS), F.lit("").alias("audit")))
    pieces = chained.where(F.col("at").isNotNull()).select("conv_id", F.col("at").alias("pos"), "piece", *(F.lit(None).cast("string").alias(c) for c in ("role", "text")))
    return summary, pieces.unionByName(kept.select("conv_id", "pos", F.lit(None).cast("string").alias("piece"), "role", "text"))


def _with(conv: T.StructField, more: str) -> T.StructType:
    return T.StructType([T.StructField("conv_id", conv.dataType), *T._parse_datatype_string(more).fields])


def _segment_tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for conv, at, rows in zip(*(c.to_pylist() for c in batch.columns)):
            run = measure([r["turn"] for r in rows], [r["initial"] for r in rows])
            faults = [r["fault"] for r in rows]
            plain = [(r["initial"], r["fault"]) for r in rows]
            tables = [[v and {"cost": v[0], "audit": v[1]} for v in lightest(plain, s, goal=False)] for s in STATES]
            out.append({"conv_id": conv, "at": at, **run._asdict(), "blank": faults.count(BLANK),
                        "duplicate": faults.count(DUPLICATE), "truncated": faults.count(CUT), "tables": tables})
        if out:
            conv_type, turn_type = batch.schema.field("conv_id").type, batch.schema.field("rows").type.value_type.field("turn").type
            pair = pa.struct([("cost", pa.int64()), ("audit", pa.string())])
            fields = [("conv_id", conv_type), ("at", pa.int64()), ("first_turn", turn_type), ("last_turn", turn_type), ("turns", pa.int64()),
                      ("first_role", pa.string()), ("last_role", pa.string()), ("illegal", pa.int64()), ("blank", pa.int64()),
                      ("duplicate", pa.int64()), ("truncated", pa.int64()), ("tables", pa.list_(pa.list_(pair)))]
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema(fields))


class Chain:
    """Lightest derivations over the segments of one conversation, taken in order."""

    def __init__(self):
        self.best: list[tuple[int, str, tuple] | None] = [(0, "", ()), None, None, None]
        self.ats: list[int] = []
        self.sums = dict.fromkeys(COUNTS, 0)
        self.turns, self.first, self.last, self.role = 0, None, None, None
        self.agreed: list[str] = []  # what all live audits begin with

    def add(self, row: dict) -> None:
        self.ats.append(row["at"])
        for c in ("blank", "duplicate", "truncated", "illegal"):
            self.sums[c] += row[c]
        if self.role is not None:
            self.sums["illegal"] += self.role + row["first_role"] not in LEGAL
        self.role = row["last_role"]
        if row["first_turn"] is not None:
            self.turns += row["turns"] - (self.last == row["first_turn"])  # rows come by turn
            self.first = row["first_turn"] if self.first is None else self.first
            self.last = row["last_turn"]
        best: list[tuple[int, str, tuple] | None] = [None] * 4
        for start, before in enumerate(self.best):
            for end, value in enumerate(row["tables"][start] if before is not None else ()):
                if value is not None:
                    new = before[0] + value["cost"], before[1] + value["audit"], (before[2], value["audit"])
                    if best[end] is None or new[:2] < best[end][:2]:
                        best[end] = new
        shared = os.path.commonprefix([b[1] for b in best if b is not None])
        self.agreed.append(shared)
        self.best = [b and (b[0], b[1][len(shared):], b[2]) for b in best]

    def result(self) -> tuple[dict, list[tuple[int, str]]]:
        cost, tail, way = min((b for b in (self.best[START], self.best[AFTER_A]) if b is not None), key=lambda b: b[:2])
        pieces = []
        while way:
            way, piece = way
            pieces.append(piece)
        gaps = self.last - self.first + 1 - self.turns if self.turns else 0
        return {**self.sums, "gaps": gaps, "cost": cost, "audit": "".join([*self.agreed, tail])}, list(zip(self.ats, reversed(pieces)))


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now, chain, schema, out = None, None, None, []

    def finish():
        summary, pieces = chain.result()
        out.append({"conv_id": now[0], **summary})
        out.extend({"conv_id": now[0], "at": at, "piece": piece} for at, piece in pieces)

    for batch in batches:
        schema = schema or pa.schema([("conv_id", batch.schema.field("conv_id").type), ("at", pa.int64()),
                                      *((c, pa.int64()) for c in COUNTS), ("audit", pa.string()), ("piece", pa.string())])
        for row in batch.to_pylist():
            if now is None or now[0] != row["conv_id"]:
                if now is not None:
                    finish()
                now, chain = (row["conv_id"],), Chain()
            chain.add(row)
        if len(out) >= 2000:
            yield pa.RecordBatch.from_pylist(out, schema=schema)
            out = []
    if now is not None:
        finish()
        yield pa.RecordBatch.from_pylist(out, schema=schema)


def with_digest(repaired: Repair) -> DataFrame:
    """``summary`` with ``repaired_sha256``: hash of ``role:text`` lines joined by newlines.

    Long conversations are hashed as a stream over their sorted rows, which holds one audit
    piece and one batch at a time.
    """
    line = F.transform("repaired", lambda m: F.concat(m["role"], F.lit(":"), m["text"]))
    conv = repaired.messages.schema["conv_id"]
    streamed = (repaired.messages.repartition("conv_id").sortWithinPartitions("conv_id", "pos", F.col("piece").isNull())
                .select("conv_id", "piece", "role", "text").mapInArrow(_digest_stream, _with(conv, "streamed string")))
    summary = repaired.summary
    long = summary.where(F.col("repaired").isNull())
    both = long.join(streamed.withColumnRenamed("conv_id", "same"), F.col("conv_id").eqNullSafe(F.col("same")), "left").drop("same")
    nothing = hashlib.sha256(b"").hexdigest()
    return (summary.where(F.col("repaired").isNotNull())
            .withColumn("repaired_sha256", F.sha2(F.array_join(line, "\n").cast("binary"), 256))
            .unionByName(both.withColumn("repaired_sha256", F.coalesce("streamed", F.lit(nothing))).drop("streamed")))


class _Digest:
    def __init__(self):
        self.sha, self.state, self.piece, self.any = hashlib.sha256(), START, iter(()), False

    def write(self, role: str, text: str) -> None:
        self.sha.update((("\n" if self.any else "") + role + ":" + text).encode())
        self.any = True

    def inserts(self) -> str | None:
        """Writes the inserts that come next; the letter after them (None: the piece is over)."""
        for letter in self.piece:
            if letter != "I":
                return letter
            wanted, self.state = NEXT[self.state]
            self.write(ROLE[wanted], "")
        return None

    def row(self, role: str, text: str) -> None:
        letter = self.inserts()
        if letter == "K" and role[:1] == "s":
            self.state = AFTER_S
            self.write(role, text)
        elif letter in ("K", "R"):
            wanted, self.state = NEXT[self.state]
            self.write(role if letter == "K" else ROLE[wanted], text)

    def new_piece(self, piece: str) -> None:
        self.inserts()  # those after the last row of the piece before
        self.piece = iter(piece)

    def hex(self) -> str:
        self.inserts()
        return self.sha.hexdigest()


def _digest_stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now, digest, schema, convs, hexes = None, None, None, [], []
    for batch in batches:
        schema = schema or pa.schema([("conv_id", batch.schema.field("conv_id").type), ("streamed", pa.string())])
        for conv, piece, role, text in zip(*(c.to_pylist() for c in batch.columns)):
            if now is None or now[0] != conv:
                if now is not None:
                    convs.append(now[0])
                    hexes.append(digest.hex())
                now, digest = (conv,), _Digest()
            if piece is not None:
                digest.new_piece(piece)
            else:
                digest.row(role, text)
    if now is not None:
        convs.append(now[0])
        hexes.append(digest.hex())
        yield pa.RecordBatch.from_arrays([pa.array(convs, schema.field(0).type), pa.array(hexes, pa.string())], schema=schema)
