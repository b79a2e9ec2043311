"""Chat formatting: records of many layouts become canonical turns, and turns become marked text with a loss mask.

Schema fingerprinting. The nested field paths of a record (``messages[].content``; null fields are absent, fields that
no layout knows are ignored) are sorted and hashed. The hash selects a declarative mapping: which paths are said by
whom, in which order. All hashes are computed once from the mappings, one for every choice of their optional paths, so
that a record costs one look-up however many layouts there are.

Template: ``<|im_start|>role``, a newline, the text, ``<|im_end|>`` and a newline. Control strings inside texts are
escaped: ``<|`` gets a backslash in between, and one more where there are some already; roles also escape newlines and
backslashes. The loss mask is the list of spans (code points) of assistant texts, without their marks.

Turns are dealt by ranges of (conversation, turn) and formatted in order; a conversation comes out as one part, or
several of about PART characters cut between turns, so that no task holds a whole very long one.

Edge cases: a null role or text is empty; a null turn comes first, a null conversation id is one conversation; turns of
equal place stand in the order of role and text, repeated rows are turns of their own; a record that is no JSON object or
fits no mapping gives one row with a null layout, which formatting leaves out; an empty list of messages gives no turn;
empty tables give no rows; columns that are not asked for are left out.
"""

from __future__ import annotations

import itertools
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ordered import in_order, partition_id, runs
from .tables import bounded_batches

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
#: Characters after which a part of a conversation ends.
PART = 1 << 20


@dataclass(frozen=True)
class Say:
    """One turn: a role, and the paths whose texts are joined by an empty line; or a role that stands at a path."""

    role: str | None
    paths: tuple[str, ...]
    role_path: str | None = None


@dataclass(frozen=True)
class Each:
    """A turn for every item of a list: where role and text stand in it, and other names of roles."""

    items: str
    role: str
    text: str
    names: tuple[tuple[str, str], ...] = ()


@dataclass(frozen=True)
class Alternate:
    """A turn for every text of a list, said by the roles in rotation."""

    items: str
    roles: tuple[str, ...] = ("user", "assistant")


@dataclass(frozen=True)
class Mapping:
    name: str
    paths: tuple[str, ...]
    turns: tuple[Say | Each | Alternate, ...]
    optional: tuple[str, ...] = ()


#: The layouts that are known.
MAPPINGS = (
    Mapping("turn", (), (Say(None, ("text",), "role"),), ("role", "text")),
    Mapping("messages", ("messages[].role",), (Say("system", ("system",)), Each("messages", "role", "content")), ("messages[].content", "system")),
    Mapping("no messages", ("messages[]",), (), ("system",)),
    Mapping("from and value", ("conversations[].from",), (Say("system", ("system",)), Each("conversations", "from", "value", (("human", "user"), ("gpt", "assistant")))), ("conversations[].value", "system")),
    Mapping("dialog", ("dialog[]",), (Say("system", ("system",)), Alternate("dialog")), ("system",)),
    Mapping("prompt and response", ("prompt", "response"), (Say("system", ("system",)), Say("user", ("prompt",)), Say("assistant", ("response",))), ("system",)),
    Mapping("prompt and completion", ("prompt", "completion"), (Say("system", ("system",)), Say("user", ("prompt",)), Say("assistant", ("completion",))), ("system",)),
    Mapping("instruction", ("instruction", "output"), (Say("system", ("system",)), Say("user", ("instruction", "input")), Say("assistant", ("output",))), ("input", "system")),
    Mapping("question and answer", ("question", "answer"), (Say("system", ("system",)), Say("user", ("context", "question")), Say("assistant", ("answer",))), ("context", "system")),
)


def paths_of(value: object, at: str = "") -> set[str]:
    """Paths of all fields that are not null; ``[]`` stands for any place in a list, and ends the path of a list of plain values or of an empty one."""
    if isinstance(value, dict):
        return {p for k, v in value.items() for p in paths_of(v, f"{at}.{k}" if at else k)}
    if isinstance(value, list):
        return {p for v in value for p in paths_of(v, f"{at}[]")} or {f"{at}[]"}
    return set() if value is None else {at}


def fingerprint(paths: set[str]) -> int:
    return xxhash.xxh3_64_intdigest("\n".join(sorted(paths)))


class Layouts:
    """Mappings by fingerprint."""

    def __init__(self, mappings: tuple[Mapping, ...] = MAPPINGS):
        self.known = {p for m in mappings for p in (*m.paths, *m.optional)}
        self.by_print: dict[int, Mapping] = {}
        for m in mappings:
            for n in range(len(m.optional) + 1):
                for some in itertools.combinations(m.optional, n):
                    self.by_print.setdefault(fingerprint({*m.paths, *some}), m)

    def turns(self, record: str | None) -> tuple[int | None, str | None, list[tuple[str, str]]]:
        """Fingerprint, name of the layout and (role, text) of each turn; no name if no mapping fits."""
        try:
            value = json.loads(record or "")
        except ValueError:
            return None, None, []
        if not isinstance(value, dict):
            return None, None, []
        mark = fingerprint(paths_of(value) & self.known)
        mapping = self.by_print.get(mark)
        if mapping is None:
            return mark, None, []
        out: list[tuple[str, str]] = []
        for turn in mapping.turns:
            if isinstance(turn, Each):
                names = dict(turn.names)
                for item in value[turn.items]:
                    item = item if isinstance(item, dict) else {}
                    role = _text(item.get(turn.role))
                    out.append((names.get(role, role), _text(item.get(turn.text))))
            elif isinstance(turn, Alternate):
                out += [(r, _text(v)) for r, v in zip(itertools.cycle(turn.roles), value[turn.items])]
            elif turn.role is None:
                out.append((_text(value.get(turn.role_path)), _text(value.get(turn.paths[0]))))
            else:
                said = [_text(value[p]) for p in turn.paths if value.get(p) is not None]
                if said:
                    out.append((turn.role, "\n\n".join(said)))
        return mark, mapping.name, out


def _text(value: object) -> str:
    return value if isinstance(value, str) else "" if value is None else json.dumps(value, ensure_ascii=False)


_control, _escaped = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")
_plain = re.compile(r"\\(.)", re.S)


def escape(text: str) -> str:
    """A text without ``<|``; ``unescape`` gives it back."""
    return _control.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _escaped.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return _plain.sub(lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def turns_of(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn, read from formatted text."""
    out, at = [], 0
    while at < len(formatted):
        line = formatted.index("\n", at)
        end = formatted.index(CLOSE, line)
        out.append((unescape_role(formatted[at + len(OPEN) : line]), unescape(formatted[line + 1 : end])))
        at = end + len(CLOSE) + 1
    return out


def canonical_turns(records: DataFrame, record: str = "record", mappings: tuple[Mapping, ...] = MAPPINGS) -> DataFrame:
    """(conv_id, turn, record) -> (conv_id, turn, place, fingerprint, layout, role, text): the turns of each JSON record."""
    bounded_batches(records.sparkSession)
    kinds = {f.name: f.dataType for f in records.schema}

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        layouts = Layouts(mappings)
        for pdf in batches:
            out = []
            for conv, turn, text in zip(pdf["conv"].tolist(), pdf["turn"].tolist(), pdf["record"].tolist()):
                mark, name, turns = layouts.turns(text)
                mark = None if mark is None else f"{mark:016x}"
                if name is None:
                    out.append((conv, turn, 0, mark, None, None, text))
                out += [(conv, turn, i, mark, name, role, said) for i, (role, said) in enumerate(turns)]
            yield pd.DataFrame(out, columns=["conv", "turn", "place", "fingerprint", "layout", "role", "text"])

    plain = records.select(F.col("conv_id").cast("string").alias("conv"), F.col("turn").cast("string").alias("turn"), F.col(record).alias("record"))
    out = plain.mapInPandas(read, "conv string, turn string, place long, fingerprint string, layout string, role string, text string")
    return out.select(F.col("conv").cast(kinds["conv_id"]).alias("conv_id"), F.col("turn").cast(kinds["turn"]).alias("turn"), "place", "fingerprint", "layout", "role", "text")


def format_conversations(turns: DataFrame) -> DataFrame:
    """Canonical turns -> (conv_id, part, formatted, loss): text of each part, and spans of what is learnt in it.

    Parts are numbered in order within a conversation, and sorted by conversation and part inside ranges of them.
    """
    kind = turns.schema["conv_id"].dataType
    known = turns.where("layout is not null").select("conv_id", "turn", "place", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    ordered = in_order(known, ["conv_id", "turn", "place"], ["role", "text"])

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number, current, began = partition_id() << 40, None, False
        pieces: list[str] = []
        spans: list[dict] = []
        size, out = 0, []

        def put() -> None:
            nonlocal number, pieces, spans, size
            if pieces:
                out.append((current, number, "".join(pieces), spans))
            number, pieces, spans, size = number + 1, [], [], 0

        for pdf in batches:
            roles, texts = pdf["role"].tolist(), pdf["text"].tolist()
            for i, j in runs(pdf["conv"]):
                value = pdf["conv"].iloc[i]
                value = None if pd.isna(value) else value
                if not began or value != current:
                    put()
                    current, began = value, True
                for role, text in zip(roles[i:j], texts[i:j]):
                    head, said = f"{OPEN}{escape_role(role)}\n", escape(text)
                    if role == "assistant":
                        spans.append({"start": size + len(head), "end": size + len(head) + len(said)})
                    pieces += [head, said, CLOSE, "\n"]
                    size += len(head) + len(said) + len(CLOSE) + 1
                    if size > PART:
                        put()
            if out:
                yield pd.DataFrame(out, columns=["conv", "part", "formatted", "loss"])
                out.clear()
        put()
        if out:
            yield pd.DataFrame(out, columns=["conv", "part", "formatted", "loss"])

    plain = ordered.select(F.col("conv_id").cast("string").alias("conv"), "role", "text")
    out = plain.mapInPandas(write, "conv string, part long, formatted string, loss array<struct<start: long, end: long>>")
    return out.select(F.col("conv").cast(kind).alias("conv_id"), "part", "formatted", "loss")


def read_back(parts: DataFrame) -> DataFrame:
    """Parts -> (conv_id, part, n_turns, turns, loss, loss_chars, formatted_chars), read from the formatted text and its mask alone.

    turns is role, newline, text, newline of each turn; loss is all text under the mask, unescaped.
    """
    kind = parts.schema["conv_id"].dataType

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for conv, part, text, spans in zip(pdf["conv"].tolist(), pdf["part"].tolist(), pdf["formatted"].tolist(), pdf["loss"].tolist()):
                turns = turns_of(text)
                loss = "".join(unescape(text[s["start"] : s["end"]]) for s in spans)
                out.append((conv, part, len(turns), "".join(f"{r}\n{t}\n" for r, t in turns), loss, len(loss), len(text)))
            yield pd.DataFrame(out, columns=["conv", "part", "n_turns", "turns", "loss", "loss_chars", "formatted_chars"])

    plain = parts.select(F.col("conv_id").cast("string").alias("conv"), "part", "formatted", "loss")
    out = plain.mapInPandas(read, "conv string, part long, n_turns long, turns string, loss string, loss_chars long, formatted_chars long")
    return out.select(F.col("conv").cast(kind).alias("conv_id"), *out.columns[1:])
