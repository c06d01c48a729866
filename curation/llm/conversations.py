"""Operator 11: repair of conversation structure by ranked least-cost edits.

A conversation's rows stand in order of turn (nulls first; rows of one turn
by role, then text).  A row's first fault counts: blank (no sign but white
space), duplicate (role and text seen earlier), truncated (the last sign ends
no sentence).  Edits make the roles follow ``(s?(ua)+)?``: Keep, Rerole to
user or assistant, Delete (required for blank and duplicate rows), Insert an
empty row; a truncated row that stays costs extra.  Among the cheapest edits
the one whose initials (D, I, K, R) are least in ASCII order is the audit.

Cost program: a node is a place between rows and one of four states (nothing
yet, after system, after user, after assistant).  The costs to go of the four
states behind a row give those before it.  Only their differences matter,
which take few values, so a step is looked up by the row's code and the
differences once it has been worked out.

Prefix-doubling path ranking: every arc that lies on a cheapest way is ranked
by its first letter; ranks of audits of length 2L come from the pair (rank of
the first L letters, rank of the L letters behind the doubled pointer).  At a
node the arc of least rank leads on.  Arcs of a node differ in their letter,
so the pointer of an arc is one arc.  The audit is read by doubling: the first
L arcs, then the pointers of length L of each of them.

Scale: one shuffle by conversation.  Conversations of more than ``long_rows``
rows are not held by one task: their rows are sorted by range over all tasks,
duplicates come from a pre-aggregated first turn of each (role, digest), and
one byte a row is gathered (the audit, one value, holds as much).  Long code
sequences are ranked in cuts of ``CUT`` rows, from the last to the first, which
hand on the costs and ranks of the four states.  The hash of a repaired
conversation is one sequential pass by its nature: texts stream through it and
are never held.

Defined results: a null role or text is one space, a null conversation id is a
conversation of its own (one space where the id is hashed), as is a null turn
in the hash; roles count by their first sign, an empty role has none; a
conversation without rows (or of which damage leaves none) has zeros, an empty
audit and the hash of an empty string; repeated rows are duplicates; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import checkpoint, table

COSTS = {"D": 4, "I": 3, "K": 0, "R": 3}
TRUNCATED_COST = 3
LETTERS = "DIKR"  # ASCII order
#: States: nothing yet, after system, after user, after assistant.  The role
#: that an inserted or changed row takes in each, and the state behind it.
FILL = ("user", "user", "assistant", "user")
FILL_STATE = (2, 2, 3, 2)
#: State behind a kept row: (state, class of the role's initial).
KEEP_STATE = {(0, 0): 1, (0, 1): 2, (1, 1): 2, (2, 2): 3, (3, 1): 2}
ENDS = (0, 3)
OTHER = 3
#: Classes of initials that may follow one another: su, ua, au.
LEGAL = ((0, 1), (1, 2), (2, 1))
FINE, TRUNCATED, BLANK, DUPLICATE = 0, 1, 2, 3
#: Rows of a conversation that one task may hold, rows of a cut, and arcs
#: ranked at a time.
LONG_ROWS = 100_000
CUT = 1 << 16
GROUP_ARCS = 1 << 20

RESULT = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, "
          "cost long, audit string, repaired_sha256 string")
_NO_ARC, _STOP = -1, -2


class Steps:
    """The cost program's steps, each worked out once.

    A row's code is its role class + 4 * fault.  ``head[step][state]`` is the
    least letter of a cheapest arc (_STOP at the end), ``to[step][state]`` the
    state behind each letter's arc (_NO_ARC: not on a cheapest way)."""

    def __init__(self):
        self.costs: list[tuple] = []
        self.known: dict[tuple, int] = {}
        self.steps: dict[tuple[int, int], tuple[int, int, int]] = {}
        self.head: list[list[int]] = []
        self.to: list[list[list[int]]] = []
        inf = float("inf")
        self.end_step, self.end_costs, _ = self._closed([[inf] * 4 for _ in range(4)], [0 if s in ENDS else inf for s in range(4)])
        # a cut's end: the next cut goes on from here
        self.exit_step = len(self.head)
        self.head.append([0] * 4)
        self.to.append([[_NO_ARC] * 4 for _ in range(4)])

    def costs_id(self, costs: tuple) -> int:
        if costs not in self.known:
            self.known[costs] = len(self.costs)
            self.costs.append(costs)
        return self.known[costs]

    def _closed(self, by_letter: list[list[float]], stop: list[float]) -> tuple[int, int, int]:
        """Adds the inserts to the arcs that consume a row (or end)."""
        base = [min(*by_letter[s], stop[s]) for s in range(4)]
        cost = list(base)
        for _ in range(2):
            for s in range(4):
                cost[s] = min(cost[s], COSTS["I"] + cost[FILL_STATE[s]])
        head, to = [], []
        for s in range(4):
            arcs = [_NO_ARC if by_letter[s][k] != cost[s] or cost[s] == float("inf") else 0 for k in range(4)]
            if cost[s] == COSTS["I"] + cost[FILL_STATE[s]]:
                arcs[1] = FILL_STATE[s]
            to.append(arcs)
            first = [k for k in range(4) if arcs[k] != _NO_ARC]
            head.append(_STOP if stop[s] == cost[s] else first[0])
        self.head.append(head)
        self.to.append(to)
        low = min(cost)
        return len(self.head) - 1, self.costs_id(tuple(c - low for c in cost)), low

    def step(self, code: int, after: int) -> tuple[int, int, int]:
        """(step, costs before the row, what these lack) of a row, from the
        costs behind it."""
        key = (code, after)
        if key not in self.steps:
            self.steps[key] = self._work_out(code & 3, code >> 2, self.costs[after])
        return self.steps[key]

    def _work_out(self, role: int, fault: int, after: tuple) -> tuple[int, int, int]:
        inf = float("inf")
        stays = fault in (FINE, TRUNCATED)
        extra = TRUNCATED_COST if fault == TRUNCATED else 0
        by_letter = []
        for s in range(4):
            keep = KEEP_STATE.get((s, role))
            by_letter.append([
                COSTS["D"] + after[s], inf,
                COSTS["K"] + extra + after[keep] if stays and keep is not None else inf,
                COSTS["R"] + extra + after[FILL_STATE[s]] if stays else inf])
        out = self._closed(by_letter, [inf] * 4)
        for s in range(4):
            arcs = self.to[out[0]][s]
            for k, target in ((0, s), (2, KEEP_STATE.get((s, role))), (3, FILL_STATE[s])):
                if arcs[k] != _NO_ARC:
                    arcs[k] = target
        return out

    def back(self, codes: bytes, after: int) -> tuple[list[int], int, int]:
        """Steps of rows in order, the costs before them and what these lack."""
        ids, lacks, known = [], 0, self.steps
        for code in reversed(codes):
            got = known.get((code, after)) or self.step(code, after)
            ids.append(got[0])
            after = got[1]
            lacks += got[2]
        ids.reverse()
        return ids, after, lacks


def ranked_paths(steps: Steps, levels: list[list[int]], exit_ranks: list[int] | None, entries: tuple[int, ...]):
    """The least paths of some sequences from each of the entry states.

    ``levels``: for each sequence the steps of its rows, then the step of its
    end.  Returns for each sequence and entry the letters as bytes and the
    state at a cut's end, and the ranks of the four states at each start."""
    step = np.concatenate([np.asarray(x, np.int64) for x in levels])
    n = len(step)
    head, to = np.array(steps.head), np.array(steps.to)
    # arc 16 * level + 4 * state + letter; the last: the end of all paths
    stop = 16 * n
    first = head[step]  # by level and state
    heads = np.where(first == _STOP, stop, 16 * np.arange(n)[:, None] + 4 * np.arange(4) + first).ravel()
    target = to[step].reshape(-1)
    arc = np.flatnonzero(target != _NO_ARC)
    letter = arc & 3
    nxt = np.full(stop + 1, stop)
    nxt[arc] = heads[4 * ((arc >> 4) + (letter != 1)) + target[arc]]
    rank = np.zeros(stop + 1, np.int64)
    rank[arc] = letter + 1
    if exit_ranks is not None:
        exits = heads[4 * np.flatnonzero(step == steps.exit_step)[:, None] + np.arange(4)]
        nxt[exits] = exits
        rank[exits] = 5 + np.array(exit_ranks)
        arc = np.concatenate([arc, exits.ravel()])
    pointers = []
    used = np.append(arc, stop)
    while True:
        pointers.append(nxt)
        pair = rank[used] * (int(rank.max()) + 1) + rank[nxt[used]]
        rank = np.zeros_like(rank)
        rank[used] = np.unique(pair, return_inverse=True)[1]
        twice = nxt.copy()
        twice[used] = nxt[nxt[used]]
        if (twice == nxt).all():
            break
        nxt = twice
    size = [len(x) for x in levels]
    starts = np.cumsum([0, *size[:-1]])
    path = heads[4 * starts[:, None] + np.array(entries)].reshape(-1, 1)
    for p in pointers:
        path = np.concatenate([path, p[path]], axis=1)
    signs = np.frombuffer(LETTERS.encode(), np.uint8)
    ended = path == stop
    if exit_ranks is not None:
        ended |= np.isin(path, exits)
    length = ended.argmax(axis=1)
    out = []
    for row, m in zip(path, length.tolist()):
        out.append((signs[row[:m] & 3].tobytes(), int(row[m] >> 2 & 3) if row[m] != stop else 0))
    k = len(entries)
    return [out[i * k:(i + 1) * k] for i in range(len(levels))], rank[heads[4 * starts[:, None] + np.arange(4)]]


def audits(steps: Steps, sequences: list[bytes], cut: int = CUT) -> list[tuple[int, bytes]]:
    """Cost and audit of each sequence of row codes."""
    out: list = [None] * len(sequences)
    short: list[tuple[int, list[int]]] = []
    for i, codes in enumerate(sequences):
        if len(codes) > cut:
            out[i] = _long_audit(steps, codes, cut)
            continue
        ids, before, lacks = steps.back(codes, steps.end_costs)
        short.append((i, ids + [steps.end_step]))
        out[i] = lacks + steps.costs[before][0]
    short.sort(key=lambda x: len(x[1]))  # like lengths together: paths stand in one table
    at = 0
    while at < len(short):
        to = at + 1
        while to < len(short) and (to - at) * 16 * len(short[to][1]) < GROUP_ARCS:
            to += 1
        paths, _ = ranked_paths(steps, [x for _, x in short[at:to]], None, (0,))
        for (i, _), p in zip(short[at:to], paths):
            out[i] = (out[i], p[0][0])
        at = to
    return out


def _long_audit(steps: Steps, codes: bytes, cut: int) -> tuple[int, bytes]:
    """As ``audits``, cut by cut from the last; a cut's paths from all states
    are kept (four bytes a row)."""
    after, cost, ranks, parts = steps.end_costs, 0, None, []
    for at in range((len(codes) - 1) // cut * cut, -1, -cut):
        ids, after, lacks = steps.back(codes[at:at + cut], after)
        cost += lacks
        last = steps.end_step if ranks is None else steps.exit_step
        paths, begin = ranked_paths(steps, [ids + [last]], ranks, (0, 1, 2, 3))
        ranks = begin[0].tolist()
        ranks = [sorted(set(ranks)).index(r) for r in ranks]
        parts.append(paths[0])
    state, out = 0, []
    for paths in reversed(parts):
        piece, state = paths[state]
        out.append(piece)
    return cost + steps.costs[after][0], b"".join(out)


class Repaired:
    """The hash of a repaired conversation, fed row by row."""

    def __init__(self, audit: bytes | str):
        self.audit = audit if isinstance(audit, bytes) else audit.encode()
        self.at, self.state, self.hash, self.any = 0, 0, hashlib.sha256(), False

    def _out(self, role: str, text: str) -> None:
        self.hash.update((("\n" if self.any else "") + f"{role}:{text}").encode())
        self.any = True

    def inserts(self) -> None:
        while self.at < len(self.audit) and self.audit[self.at] == 0x49:
            self._out(FILL[self.state], "")
            self.state = FILL_STATE[self.state]
            self.at += 1

    def row(self, role: str, text: str) -> None:
        self.inserts()
        edit = chr(self.audit[self.at])
        self.at += 1
        if edit == "K":
            self._out(role, text)
            self.state = KEEP_STATE[self.state, role_class(role)]
        elif edit == "R":
            self._out(FILL[self.state], text)
            self.state = FILL_STATE[self.state]

    def digest(self) -> str:
        self.inserts()
        return self.hash.hexdigest()


def role_class(role: str) -> int:
    return "sua".find(role[0]) if role and role[0] in "sua" else OTHER


def illegal_pairs(codes: bytes) -> int:
    c = np.frombuffer(codes, np.uint8) & 3
    pair = c[:-1] * 4 + c[1:]
    return int((~np.isin(pair, [4 * a + b for a, b in LEGAL])).sum())


def damage(conversations: DataFrame) -> DataFrame:
    """The rows (conv_id, turn, role, text) after the damage that the hash of
    conversation and turn decides; ``gone`` marks dropped rows."""
    one = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    h = F.crc32(F.concat(one("conv_id"), F.lit(":"), one("turn")).cast("binary")) % 20
    d = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                             one("role").alias("role"), one("text").alias("text"), h.alias("h"))
    text = F.when(F.col("h") <= 1, "").when(F.col("h") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return d.select("conv_id", "turn", F.when(F.col("h") == 4, "user").otherwise(F.col("role")).alias("role"),
                    text.alias("text"), (F.col("h") == 0).alias("gone"),
                    F.explode(F.expr("array_repeat(0, if(h = 3, 2, 1))")).alias("n")).drop("n")


def _coded(rows: DataFrame) -> DataFrame:
    """With the class of the role and the fault that the text alone shows."""
    last = F.regexp_extract("text", r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
    fault = F.when(last == "", BLANK).when(last.isin(".", "!", "?"), FINE).otherwise(TRUNCATED)
    first = F.substring("role", 1, 1)
    role = F.when(first == "s", 0).when(first == "u", 1).when(first == "a", 2).otherwise(OTHER)
    return rows.withColumn("_role", role).withColumn("_fault", fault)


def _read(rows: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    """The named columns, row by row."""
    for batch in rows:
        yield from zip(*(batch.column(batch.schema.get_field_index(n)).to_pylist() for n in names))


def _turn_gaps(turns: list) -> int:
    some = [t for t in turns if t is not None]
    return max(some) - min(some) + 1 - len(set(some)) if some else 0


def _finished(steps: Steps, held: list[tuple]) -> pa.RecordBatch:
    """Results of some conversations of (id, turns, roles, texts, codes)."""
    got = audits(steps, [h[4] for h in held])
    out = []
    for (conv, turns, roles, texts, codes), (cost, audit) in zip(held, got):
        fixed = Repaired(audit)
        for role, text in zip(roles, texts):
            fixed.row(role, text)
        fault = np.bincount(np.frombuffer(codes, np.uint8) >> 2, minlength=4).tolist()
        out.append((conv, _turn_gaps(turns), fault[BLANK], fault[DUPLICATE], fault[TRUNCATED], illegal_pairs(codes),
                    int(cost), audit.decode(), fixed.digest()))
    return _batch(out)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [(c.split()[0], pa.string() if c.endswith("string") else pa.int64()) for c in RESULT.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, (_, k) in enumerate(kinds)],
                                      schema=pa.schema(kinds))


def _short(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    steps, held, size = Steps(), [], 0
    read = _read(rows, "conv_id", "turn", "role", "text", "_role", "_fault", "gone")
    for conv, of in groupby(read, key=lambda r: r[0]):
        turns, roles, texts, codes, seen = [], [], [], bytearray(), set()
        for _, turn, role, text, role_of, fault, gone in of:
            if gone:
                continue
            if fault != BLANK:
                if (role, text) in seen:
                    fault = DUPLICATE
                seen.add((role, text))
            turns.append(turn)
            roles.append(role)
            texts.append(text)
            codes.append(role_of + 4 * fault)
            size += 100 + len(text)
        held.append((conv, turns, roles, texts, bytes(codes)))
        size += 100
        if size > 1 << 22:
            yield _finished(steps, held)
            held, size = [], 0
    if held:
        yield _finished(steps, held)


def _code_runs(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each run of a conversation in a partition: its codes, one
    byte a row, and its turns."""
    read = _read(rows, "conv_id", "place", "turn", "role", "digest", "_role", "_fault", "later")
    names = ["conv_id", "place", "codes", "first_turn", "last_turn", "turns"]
    for conv, of in groupby(read, key=lambda r: r[0]):
        place, codes, first, last, turns, before = None, bytearray(), None, None, 0, None
        for _, at, turn, role, digest, role_of, fault, later in of:
            place = at if place is None else place
            here = (turn, role, digest)
            if fault != BLANK and (later or here == before):
                fault = DUPLICATE
            before = here
            if turn is not None and turn != last:
                first, last, turns = turn if first is None else first, turn, turns + 1
            codes.append(role_of + 4 * fault)
        yield pa.RecordBatch.from_arrays(
            [pa.array([conv], pa.int64()), pa.array([place], pa.int64()), pa.array([bytes(codes)], pa.binary()),
             pa.array([first], pa.int64()), pa.array([last], pa.int64()), pa.array([turns], pa.int64())], names=names)


def _long_results(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    steps = Steps()
    for conv, runs in _read(rows, "conv_id", "runs"):
        runs.sort(key=lambda r: r["place"])
        codes = b"".join(r["codes"] for r in runs)
        turned = [r for r in runs if r["turns"]]
        turns = sum(r["turns"] for r in turned) - sum(a["last_turn"] == b["first_turn"] for a, b in zip(turned, turned[1:]))
        gaps = turned[-1]["last_turn"] - turned[0]["first_turn"] + 1 - turns if turned else 0
        (cost, audit), = audits(steps, [codes])
        fault = np.bincount(np.frombuffer(codes, np.uint8) >> 2, minlength=4).tolist()
        yield _batch([(conv, gaps, fault[BLANK], fault[DUPLICATE], fault[TRUNCATED], illegal_pairs(codes), int(cost),
                       audit.decode(), None)])


def _hashes(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    read = _read(rows, "conv_id", "place", "role", "text")
    for conv, of in groupby(read, key=lambda r: r[0]):
        fixed = None
        for _, place, role, text in of:  # the audit comes first
            if fixed is None:
                fixed = Repaired(text)
            else:
                fixed.row(role, text)
        yield pa.RecordBatch.from_arrays([pa.array([conv], pa.int64()), pa.array([fixed.digest()])],
                                         names=["conv_id", "sha"])


def _repair_long(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """``rows``: coded rows of the conversations ``ids`` (_id), without dropped
    ones."""
    rows = rows.withColumn("digest", F.sha2("text", 256))
    first = (rows.groupBy("conv_id", "role", "digest")
             .agg(F.min("turn").alias("_min"), F.bool_or(F.col("turn").isNull()).alias("_any"), F.count("*").alias("_n"))
             .where("_n > 1").select(F.col("conv_id").alias("_c"), F.col("role").alias("_r"), F.col("digest").alias("_d"),
                                     "_min", "_any"))
    on = F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("role") == F.col("_r")) & (F.col("digest") == F.col("_d"))
    later = F.col("turn").isNotNull() & F.coalesce(F.col("_any") | (F.col("turn") > F.col("_min")), F.lit(False))
    rows = rows.join(first, on, "left").select("conv_id", "turn", "role", "text", "digest", "_role", "_fault", later.alias("later"))
    # the sampled keys of the ranges hold the beginning of a text only
    rows = (rows.repartitionByRange("conv_id", "turn", "role", F.substring("text", 1, 64))
            .sortWithinPartitions("conv_id", "turn", "role", "text"))
    rows = checkpoint(rows).withColumn("place", F.monotonically_increasing_id())
    runs = rows.drop("text").mapInArrow(_code_runs, "conv_id long, place long, codes binary, first_turn long, last_turn long, turns long")
    found = (runs.groupBy("conv_id").agg(F.collect_list(F.struct("place", "codes", "first_turn", "last_turn", "turns")).alias("runs"))
             .mapInArrow(_long_results, RESULT))
    found = checkpoint(found)
    edits = found.select("conv_id", F.lit(-1).cast("long").alias("place"), F.lit("").alias("role"), F.col("audit").alias("text"))
    hashed = (edits.unionByName(rows.select("conv_id", "place", "role", "text"))
              .repartition("conv_id").sortWithinPartitions("conv_id", "place").mapInArrow(_hashes, "conv_id long, sha string"))
    hashed = hashed.withColumnRenamed("conv_id", "_c")
    found = found.drop("repaired_sha256").join(hashed, F.col("conv_id").eqNullSafe(F.col("_c")), "left")
    found = ids.join(found, F.col("_id").eqNullSafe(F.col("conv_id")), "left")
    zero = [F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return found.select(F.col("_id").alias("conv_id"), *zero, F.coalesce("audit", F.lit("")).alias("audit"),
                        F.coalesce("sha", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))


def repair(rows: DataFrame, long_rows: int = LONG_ROWS) -> DataFrame:
    """The faults and the least-cost repair of each conversation in ``rows``
    (conv_id, turn, role, text without nulls, gone)."""
    rows = _coded(rows)
    size = rows.groupBy(F.col("conv_id").alias("_id")).count().where(F.col("count") > long_rows)
    ids = checkpoint(size.select("_id"))  # at most (all rows / long_rows) ids
    same = F.col("conv_id").eqNullSafe(F.col("_id"))
    if ids.isEmpty():
        return _repair_short(rows)
    long = rows.join(F.broadcast(ids), same, "left_semi").where("not gone").drop("gone")
    return _repair_short(rows.join(F.broadcast(ids), same, "left_anti")).unionByName(_repair_long(long, ids))


def _repair_short(rows: DataFrame) -> DataFrame:
    return (rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
            .mapInArrow(_short, RESULT))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``conversations``, damaged and repaired."""
    return repair(damage(table(spark, sf_dir, "conversations")))
