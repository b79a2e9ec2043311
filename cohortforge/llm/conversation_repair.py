"""Conversation structure repair: the cheapest edits that make the turns of a conversation alternate.

A repaired conversation is empty or has pairs of a user and an assistant turn, after at most one system turn. Rows that
are blank or repeat an earlier row of the same role and text must go. Edits: Keep (0), Rerole to user or assistant (2),
Delete (3), Insert an empty user or assistant turn (2); a truncated row that stays adds 1. Among the cheapest the edits
whose initials come first in ASCII order are taken.

Four-Russians block tables. A row is one of nine symbols (role initial s, u, a or other, whole or truncated; must go).
The cost to go from each of four states (nothing yet, after system, user, assistant) is a vector; less its minimum it
takes only a few dozen values. For every vector and every block of four symbols the vector before the block and the
constant that was taken off are computed once. Conversations run through that table from their last block to the first,
many at once; then blocks are expanded from the first on, against that direction, and at every row the least letter is
taken that still leads to the least cost: each letter leads to one state, so no tie is lost.

Rows are dealt by ranges of (conversation, turn). A conversation inside one partition is solved there. Others (at most
two in each partition, or very long ones) are cut into stretches: a 4 x 4 matrix of least costs per stretch comes from
the same table, matrices are chained by conversation, and then every stretch is traced by itself; no task holds a whole
long conversation. Texts move once: they meet the edits of their rows in order.

Edge cases: a null role or text counts as empty (blank); a null turn comes first; a null conversation id is one
conversation; rows of the same turn stand in the order of role and digest of the text, identical rows are repetitions
of the first; very long texts are only hashed; an empty table gives no rows; other columns are left out.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordered import in_order, partition_id, runs
from .tables import bounded_batches, materialize

START, SYSTEM, USER, ASSISTANT = range(4)
#: State after a user or assistant turn that is inserted or gets its role here, and its code.
STEP, ADDED = (USER, USER, ASSISTANT, USER), "uuau"
#: (state, role initial s, u, a) -> state when the row is kept.
KEPT = {(START, 0): SYSTEM, (START, 1): USER, (SYSTEM, 1): USER, (ASSISTANT, 1): USER, (USER, 2): ASSISTANT}
GONE, NONE, SYMBOLS = 8, 9, 10
BLOCK = 4
FAR = 1 << 40
#: Inserts after the last row, by state.
LAST = ("", "ua", "a", "")
#: Rows of a conversation solved in one piece; rows of many conversations solved in one call.
STRETCH, CALL = 16_384, 20_000
SPACE = " \t\n\x0b\x0c\r"


class Tables:
    """All cost vectors, one step and one block of steps of each, and the edits of a row by the vector after it."""

    def __init__(self):
        end = self.insert([0, FAR, FAR, 0])
        self.number: dict[tuple, int] = {}
        self.vectors: list[tuple] = []
        for j in range(4):
            self.add(tuple(0 if s == j else FAR for s in range(4)))
        self.end = self.add(tuple(end))
        step, off, edits, state = [], [], [], []
        self.codes: list[str] = []
        known: dict[str, int] = {}
        while len(step) < len(self.vectors):
            after = self.vectors[len(step)]
            row = [self.before(after, x) for x in range(SYMBOLS)]
            step.append([self.add(tuple(v if v < FAR // 2 else FAR for v in (y - min(r) for y in r))) for r in row])
            off.append([min(r) for r in row])
            chosen = [[self.choose(after, r, x, s) for s in range(4)] for x, r in enumerate(row)]
            edits.append([[known.setdefault(c, len(known)) for c, _ in line] for line in chosen])
            state.append([[s for _, s in line] for line in chosen])
        self.codes = list(known)
        self.step, self.off = np.array(step, np.int32), np.array(off, np.int64)
        self.edits, self.state = np.array(edits, np.int32), np.array(state, np.int32)
        self.costs = np.array(self.vectors, np.int64)
        # blocks by the number whose decimal digits are the symbols; the last symbol comes first
        at = np.broadcast_to(np.arange(len(self.vectors))[:, None], (len(self.vectors), SYMBOLS**BLOCK))
        block, total = np.arange(SYMBOLS**BLOCK), np.zeros(at.shape, np.int64)
        for _ in range(BLOCK):
            x = block % SYMBOLS
            total = total + self.off[at, x]
            at, block = self.step[at, x], block // SYMBOLS
        self.block_step, self.block_off = at, total

    def add(self, vector: tuple) -> int:
        if vector not in self.number:
            self.number[vector] = len(self.vectors)
            self.vectors.append(vector)
        return self.number[vector]

    @staticmethod
    def insert(costs: list[int]) -> list[int]:
        out = list(costs)
        for s in range(4):
            once = STEP[s]
            out[s] = min(costs[s], 2 + costs[once], 4 + costs[STEP[once]])
        return [min(v, FAR) for v in out]

    @staticmethod
    def options(after: tuple, x: int, s: int) -> dict[str, tuple[int, int]]:
        """code -> (cost, state) of the edits of one row, without inserts."""
        if x == NONE:
            return {"": (after[s], s)}
        found = {"D": (3 + after[s], s)}
        if x != GONE:
            if (s, x // 2) in KEPT:
                to = KEPT[s, x // 2]
                found["K"] = (x % 2 + after[to], to)
            found[ADDED[s].upper()] = (2 + x % 2 + after[STEP[s]], STEP[s])
        return found

    def before(self, after: tuple, x: int) -> list[int]:
        plain = [min(min(c for c, _ in self.options(after, x, s).values()), FAR) for s in range(4)]
        return plain if x == NONE else self.insert(plain)

    def choose(self, after: tuple, costs: list[int], x: int, s: int) -> tuple[str, int]:
        """The least letters from state s that reach the least cost: D before I before K before R."""
        said = ""
        while costs[s] < FAR and len(said) < 4:
            found = self.options(after, x, s)
            if x == NONE:
                return "", s
            if found["D"][0] == costs[s]:
                return said + "D", s
            if 2 + costs[STEP[s]] == costs[s]:
                said, s = said + ADDED[s], STEP[s]
                continue
            for code, (cost, to) in found.items():
                if cost == costs[s]:
                    return said + code, to
        return "", s  # no end can be reached from here


@lru_cache(maxsize=1)
def tables() -> Tables:
    return Tables()


def _blocks(symbols: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols padded in front to whole blocks: padded symbols, first block of each, number of blocks."""
    many = -(-sizes // BLOCK)
    first = np.cumsum(many) - many
    padded = np.full(int(many.sum()) * BLOCK, NONE, np.int64)
    offset = (first + many) * BLOCK - np.cumsum(sizes)
    padded[np.arange(len(symbols)) + np.repeat(offset, sizes)] = symbols
    return padded, first, many


def costs_to_go(symbols: np.ndarray, sizes: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For sequences after each other and the vector after each: vector after every block, vector before all, what was taken off."""
    t = tables()
    padded, first, many = _blocks(symbols, sizes)
    code = padded.reshape(-1, BLOCK) @ (SYMBOLS ** np.arange(BLOCK - 1, -1, -1))
    at, total, after = end.astype(np.int32), np.zeros(len(sizes), np.int64), np.zeros(len(code), np.int32)
    order = np.argsort(-many, kind="stable")
    left = np.searchsorted(-many[order], -np.arange(int(many.max(initial=0))), side="left")
    for k, n in enumerate(left.tolist()):
        who = order[:n]
        place = first[who] + many[who] - 1 - k
        after[place] = at[who]
        total[who] += t.block_off[at[who], code[place]]
        at[who] = t.block_step[at[who], code[place]]
    return after, at, total


def trace(symbols: np.ndarray, sizes: np.ndarray, after: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edits of every row, as numbers of ``Tables.codes``, and the state after the last row of each sequence."""
    t = tables()
    padded, first, many = _blocks(symbols, sizes)
    vector = np.zeros((len(after), BLOCK), np.int32)  # after each row of a block
    vector[:, -1] = after
    rows = padded.reshape(-1, BLOCK)
    for k in range(BLOCK - 1, 0, -1):
        vector[:, k - 1] = t.step[vector[:, k], rows[:, k]]
    vector = vector.ravel()
    edits, state = np.zeros(len(padded), np.int32), start.astype(np.int32)
    order = np.argsort(-many, kind="stable")
    left = np.searchsorted(-many[order], -np.arange(int(many.max(initial=0))), side="left")
    for k, n in enumerate(left.tolist()):
        who = order[:n]
        for i in range(BLOCK):
            place = (first[who] + k) * BLOCK + i
            key = vector[place], padded[place], state[who]
            edits[place] = t.edits[key]
            state[who] = t.state[key]
    return edits[padded != NONE], state


def matrices(symbols: np.ndarray) -> list[int]:
    """Least costs from every state before a stretch to every state after it, row by row."""
    t = tables()
    found = []
    for j in range(4):
        _, at, total = costs_to_go(symbols, np.array([len(symbols)]), np.array([j]))
        found.append(np.minimum(t.costs[at[0]] + total[0], FAR))
    return np.array(found).T.ravel().tolist()


def letters(codes: str) -> str:
    """Initials of edits: Insert, Keep, Rerole, Delete."""
    return codes.translate(str.maketrans("uaUA", "IIRR"))


UNIT = (
    "conv string, part long, no long, closed boolean, rows long, blank long, duplicate long, truncated long, illegal long, first int, last int, low long, high long, "
    "turns long, symbols binary, t array<string>, role array<string>, h array<binary>, codes array<string>, cost long, matrix array<long>"
)


def _units(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sorted light rows -> one row per conversation, solved, or per stretch of one that may go on elsewhere."""
    part, numbers = partition_id(), itertools.count()
    held: list[dict] = []
    rows: dict = {}
    carried = None  # last row of the batch before
    current, began, whole, waiting = None, False, False, 0

    def fresh() -> dict:
        return {"x": [], "fault": [], "kind": [], "t": [], "role": [], "h": []}

    def close(closed: bool) -> None:
        nonlocal waiting
        waiting += len(rows["t"])
        fault, kind, t = np.concatenate(rows["fault"]), np.concatenate(rows["kind"]), rows["t"]
        known = [v for v in t if v is not None]
        legal = ((kind[:-1] == 0) & (kind[1:] == 1)) | ((kind[:-1] == 1) & (kind[1:] == 2)) | ((kind[:-1] == 2) & (kind[1:] == 1))
        held.append({
            "conv": current, "part": part, "no": next(numbers), "closed": closed, "rows": len(t),
            "blank": int((fault == 1).sum()), "duplicate": int((fault == 2).sum()), "truncated": int((fault == 3).sum()), "illegal": int((~legal).sum()),
            "first": int(kind[0]), "last": int(kind[-1]), "low": int(known[0]) if known else None, "high": int(known[-1]) if known else None, "turns": len(set(known)),
            "symbols": np.concatenate(rows["x"]), "t": t, "role": rows["role"], "h": rows["h"],
        })

    def solved() -> pd.DataFrame:
        nonlocal waiting
        waiting = 0
        whole = [u for u in held if u["closed"]]
        if whole:
            t = tables()
            symbols, sizes = np.concatenate([u["symbols"] for u in whole]), np.array([u["rows"] for u in whole])
            after, at, total = costs_to_go(symbols, sizes, np.full(len(whole), t.end))
            edits, state = trace(symbols, sizes, after, np.full(len(whole), START))
            codes = [t.codes[e] for e in edits.tolist()]
            ends = np.cumsum(sizes).tolist()
            for u, i, j, s, cost in zip(whole, [0, *ends], ends, state.tolist(), (t.costs[at, START] + total).tolist()):
                u["codes"], u["cost"] = codes[i:j], cost
                u["codes"][-1] += LAST[s]
        for u in held:
            u["matrix"] = None if u["closed"] else matrices(u["symbols"])
            u.setdefault("codes", None)
            u.setdefault("cost", None)
            u["symbols"] = b"" if u["closed"] else u["symbols"].astype(np.uint8).tobytes()
        frame = pd.DataFrame(held, columns=[c.split()[0] for c in UNIT.split(", ")])
        for c in ("low", "high", "cost"):
            frame[c] = frame[c].astype("Int64")
        held.clear()
        return frame

    for pdf in batches:
        own = pdf[["conv", "t", "role", "h"]]
        before = own.shift()
        if carried is not None:
            before.iloc[0] = carried
        carried = own.iloc[-1].tolist()
        same = ((own == before) | (own.isna() & before.isna())).all(axis=1).to_numpy()
        repeated = pdf["later"].to_numpy() | same
        blank, cut, kind = pdf["blank"].to_numpy(), pdf["cut"].to_numpy(), pdf["kind"].to_numpy()
        fault = np.where(blank, 1, np.where(repeated, 2, np.where(cut, 3, 0)))
        x = np.where((fault == 1) | (fault == 2), GONE, 2 * kind + (fault == 3))
        turns, roles, hashes = pdf["t"].astype(object).where(pdf["t"].notna(), None).tolist(), pdf["role"].tolist(), pdf["h"].tolist()
        for i, j in runs(pdf["conv"]):
            value = pdf["conv"].iloc[i]
            value = None if pd.isna(value) else value
            if not began or value != current:
                if rows and rows["t"]:
                    close(whole)
                # the first conversation of a partition may have begun in the one before
                current, whole, began, rows = value, began, True, fresh()
            for a in range(i, j, STRETCH):
                b = min(a + STRETCH, j)
                rows["x"].append(x[a:b])
                rows["fault"].append(fault[a:b])
                rows["kind"].append(kind[a:b])
                rows["t"] += turns[a:b]
                rows["role"] += roles[a:b]
                rows["h"] += hashes[a:b]
                if len(rows["t"]) >= STRETCH:
                    whole = False
                    close(False)
                    rows = fresh()
            if waiting > CALL:
                yield solved()
    if rows and rows["t"]:
        close(False)
    if held:
        yield solved()


def _chain_back(pdf: pd.DataFrame) -> pd.DataFrame:
    """Stretches of one conversation, a matrix each -> the costs to go after each; the first row carries the whole cost."""
    pdf = pdf.sort_values(["part", "no"], ignore_index=True)
    end = tables().costs[tables().end]
    ahead = []
    for m in reversed(pdf["matrix"].tolist()):
        ahead.append(end.tolist())
        end = np.minimum((np.array(m).reshape(4, 4) + end).min(axis=1), FAR)
    cost = [int(end[START])] + [0] * (len(pdf) - 1)
    return pd.DataFrame({"conv": pdf["conv"], "part": pdf["part"], "no": pdf["no"], "ahead": ahead[::-1], "cost": cost})


def _vector(ahead) -> int:
    costs = np.array(ahead)
    return tables().number[tuple(v if v < FAR // 2 else FAR for v in (costs - costs.min()).tolist())]


def _reach(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The state after each stretch, by the state before it."""
    for pdf in batches:
        ends = []
        for symbols, ahead in zip(pdf["symbols"], pdf["ahead"]):
            x, one = np.frombuffer(symbols, np.uint8), np.array([len(symbols)])
            after, _, _ = costs_to_go(x, one, np.array([_vector(ahead)]))
            ends.append([int(trace(x, one, after, np.array([s]))[1][0]) for s in range(4)])
        yield pdf[["conv", "part", "no", "first", "last", "low", "high"]].assign(ends=ends)


def _chain_forth(pdf: pd.DataFrame) -> pd.DataFrame:
    """The state before each stretch, and what its first row makes with the last of the stretch before."""
    pdf = pdf.sort_values(["part", "no"], ignore_index=True)
    state, out, last, high = START, [], None, None
    for r in pdf.to_dict("records"):
        illegal = last is not None and (last, r["first"]) not in ((0, 1), (1, 2), (2, 1))
        out.append((r["conv"], r["part"], r["no"], state, int(illegal), int(high is not None and r["low"] == high)))
        state, last = int(r["ends"][state]), r["last"]
        high = high if pd.isna(r["high"]) else r["high"]
    found = pd.DataFrame(out, columns=["conv", "part", "no", "state", "more_illegal", "fewer_turns"])
    return found.assign(final=[False] * (len(found) - 1) + [True])


def _finish(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    t = tables()
    for pdf in batches:
        out = []
        for symbols, ahead, state, final in zip(pdf["symbols"], pdf["ahead"], pdf["state"], pdf["final"]):
            x, one = np.frombuffer(symbols, np.uint8), np.array([len(symbols)])
            after, _, _ = costs_to_go(x, one, np.array([_vector(ahead)]))
            edits, end = trace(x, one, after, np.array([state]))
            codes = [t.codes[e] for e in edits.tolist()]
            codes[-1] += LAST[end[0]] if final else ""
            out.append(codes)
        yield pdf[["part", "no"]].assign(codes=out)


def _light(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, h, kind, blank, cut, later): what the edits depend on, without the texts."""
    last = F.substring(F.rtrim("text", F.lit(SPACE)), -1, 1)
    initial = F.substring("role", 1, 1)
    kind = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    light = rows.select("conv_id", "turn", "role", "h", kind.alias("kind"), (last == "").alias("blank"), (~last.isin(".", "!", "?")).alias("cut"))
    first = light.groupBy("conv_id", "role", "h").agg(F.min(F.struct("turn")).alias("first"))
    first = first.select(*[F.col(c).alias(f"f_{c}") for c in ("conv_id", "role", "h")], F.col("first.turn").alias("f_turn"))
    met = F.col("conv_id").eqNullSafe(F.col("f_conv_id")) & (F.col("role") == F.col("f_role")) & (F.col("h") == F.col("f_h"))
    return light.join(first, met).withColumn("later", ~F.col("turn").eqNullSafe(F.col("f_turn"))).drop("f_conv_id", "f_role", "f_h", "f_turn")


def repair(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, turn, role, text) -> summary and repaired rows.

    Summary: one row per conversation with rows: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit.
    Repaired rows: conv_id, turn (of the row beside which it stands, for an inserted one), edit, role, text and place, a
    number that rises within a conversation. They are sorted by conversation and place inside ranges of them.
    """
    bounded_batches(conversations.sparkSession)
    text, role = F.coalesce("text", F.lit("")), F.coalesce("role", F.lit(""))
    rows = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text")).withColumn("h", F.unhex(F.md5("text")))
    kinds = {f.name: f.dataType for f in rows.schema}
    light = in_order(_light(rows), ["conv_id", "turn"], ["role", "h"])
    named = light.select(F.col("conv_id").cast("string").alias("conv"), F.col("turn").cast("string").alias("t"), "role", "h", "kind", "blank", "cut", "later")
    units = materialize(named.mapInPandas(_units, UNIT), "units")

    key, open_units = ["part", "no"], units.where("not closed")
    back = materialize(open_units.select("conv", *key, "matrix").groupBy("conv").applyInPandas(_chain_back, "conv string, part long, no long, ahead array<long>, cost long"), "costs")
    asked = open_units.drop("cost", "codes", "matrix").join(back.drop("conv"), key)
    ends = asked.mapInPandas(_reach, "conv string, part long, no long, first int, last int, low long, high long, ends array<int>")
    forth = ends.groupBy("conv").applyInPandas(_chain_forth, "conv string, part long, no long, state int, more_illegal long, fewer_turns long, final boolean")
    forth = materialize(forth.drop("conv"), "states")
    codes = asked.join(forth, key).select(*key, "symbols", "ahead", "state", "final").mapInPandas(_finish, "part long, no long, codes array<string>")
    stretched = asked.drop("symbols", "ahead").join(codes, key).join(forth, key)
    counts = ["blank", "duplicate", "truncated"]
    closed = units.where("closed").select("conv", *key, *counts, "illegal", "low", "high", "turns", "cost", "t", "role", "h", "codes")
    solved = closed.unionAll(stretched.select("conv", *key, *counts, (F.col("illegal") + F.col("more_illegal")).alias("illegal"), "low", "high", (F.col("turns") - F.col("fewer_turns")).alias("turns"), "cost", "t", "role", "h", "codes"))
    solved = materialize(solved, "solved")

    said = F.translate(F.array_join(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct(*key, "codes"))), lambda u: u["codes"])), ""), "uaUA", "IIRR")
    summary = solved.groupBy("conv").agg(
        F.coalesce(F.max("high") - F.min("low") + 1 - F.sum("turns"), F.lit(0)).alias("gaps"), *[F.sum(c).alias(c) for c in (*counts, "illegal", "cost")], said.alias("audit"),
    )
    summary = summary.select(F.col("conv").cast(kinds["conv_id"]).alias("conv_id"), *summary.columns[1:])
    # rows without an edit here are deleted
    edits = solved.select("conv", *key, F.posexplode(F.arrays_zip("t", "role", "h", "codes")).alias("pos", "e")).where("e.codes <> 'D'")
    edits = edits.select(F.col("conv").cast(kinds["conv_id"]).alias("conv_id"), F.col("e.t").cast("long").alias("turn"), "e.role", "e.h", "e.codes", F.struct(*key, "pos").alias("at"))
    return summary, _apply(rows, edits)


def _apply(rows: DataFrame, edits: DataFrame) -> DataFrame:
    """Rows and edits of the same place stand next to each other, edits first."""
    kinds = {f.name: f.dataType for f in rows.schema}
    both = in_order(rows.unionByName(edits, allowMissingColumns=True), ["conv_id", "turn"], ["role", "h", F.col("codes").isNull(), "at"])

    def go(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        place, waiting, of = partition_id() << 40, [], None
        for pdf in batches:
            out = []
            for conv, turn, role, h, text, codes in zip(*[pdf[c].tolist() for c in ("conv", "turn", "role", "h", "text", "codes")]):
                key = (conv, turn, role, h)
                if codes is not None:
                    waiting, of = [*waiting, codes] if key == of else [codes], key
                    continue
                for c in waiting.pop(0) if key == of and waiting else "D":
                    if c in "ua":
                        out.append((conv, turn, place, "insert", "user" if c == "u" else "assistant", ""))
                    elif c == "K":
                        out.append((conv, turn, place, "keep", role, text))
                    elif c != "D":
                        out.append((conv, turn, place, "rerole", "user" if c == "U" else "assistant", text))
                    place += 1
            yield pd.DataFrame(out, columns=["conv", "turn", "place", "edit", "role", "text"])

    plain = both.select(F.col("conv_id").cast("string").alias("conv"), F.col("turn").cast("string").alias("turn"), "role", "h", "text", "codes")
    out = plain.mapInPandas(go, "conv string, turn string, place long, edit string, role string, text string")
    return out.select(F.col("conv").cast(kinds["conv_id"]).alias("conv_id"), F.col("turn").cast("long").alias("turn"), "place", "edit", "role", "text")


def damaged(conversations: DataFrame, marks: Column | None = None) -> DataFrame:
    """Rows with faults drawn from a hash of ``conv_id:turn``, for trials: dropped, emptied, without sentence ends, repeated, or said by the user."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    mark = F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn")).cast("binary")) % 20 if marks is None else marks
    rows = conversations.select("conv_id", "turn", blank("role").alias("role"), blank("text").alias("text"), mark.alias("mark")).where("mark <> 0")
    text = F.when(F.col("mark") == 1, "").when(F.col("mark") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.explode(F.when(F.col("mark") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.select("conv_id", "turn", F.when(F.col("mark") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), copies.alias("copy")).drop("copy")
