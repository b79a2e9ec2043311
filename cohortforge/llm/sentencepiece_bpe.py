"""SentencePiece BPE by vectorised merge rounds.

A text is cut into words where no piece of the vocabulary can reach across (a run of word marks and what
follows it), words are encoded once per task and looked up after that. New words are encoded together: one
flat array of symbols, one of the words they belong to. Each round ranks every pair of neighbours, takes the
smallest rank of each word by a segmented minimum, merges its leftmost pair in all words at once, closes the
gaps, and lets words without a mergeable pair go. A merge may also take further pairs of the same rank in the
word, from the left and without overlap, as long as no piece of equal or better rank contains the merged one
(checked once over the vocabulary): then the order of these merges can't matter.

Characters outside the vocabulary become their UTF-8 bytes. The model file gives the pieces and scores; it
must be a BPE model that only marks white space (no other normalisation), as ``load_pieces`` checks.

Edge cases: a null text counts as empty; an empty text has no ids and decodes to an empty text; repeated rows
and clashing column names stay as they are; very long texts are encoded whole; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tables import Shared, bounded_batches, lean, packed, slices

MARK = "▁"
NEVER = np.iinfo(np.int32).max
#: Words that a task remembers; beyond that it starts afresh.
MEMORY = 250_000
#: Characters cut into words at once (a longer text goes whole).
CHUNK = 250_000


@dataclass
class Pieces:
    """What encoding needs of a model: texts of the pieces, and the merges by (left, right)."""

    text: list[str]
    of_char: np.ndarray  # by code point, -1 where the vocabulary lacks it
    of_byte: list[int]
    pairs: np.ndarray  # sorted keys left << 32 | right
    merged: np.ndarray  # id of the merged piece, beside pairs
    rank: np.ndarray  # by id; equal scores share a rank
    alone: np.ndarray  # by id: True if only the leftmost merge of a round is safe


def load_pieces(path: str) -> Pieces:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    n = model.get_piece_size()
    text = [model.id_to_piece(i) for i in range(n)]
    plain = {text[i]: i for i in range(n) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))}
    if any(MARK in t.lstrip(MARK) for t in plain) or any(model.is_unused(i) for i in range(n)):
        raise ValueError("pieces that reach across words, or unused ones, are not supported")
    probe = " ﬁ  ①\t é\n"
    if model.decode(model.encode(probe)) != probe:
        raise ValueError("the model normalises texts")
    of_byte = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
    scores = np.array([model.get_score(i) for i in range(n)])
    rank = np.unique(-scores, return_inverse=True)[1].astype(np.int32)
    found: dict[int, int] = {}
    alone = np.zeros(n, bool)
    for t, i in plain.items():
        for k in range(1, len(t)):
            left, right = plain.get(t[:k]), plain.get(t[k:])
            if left is None or right is None:
                continue
            found[left << 32 | right] = i
            for part in (left, right):
                if rank[i] <= rank[part]:
                    alone[part] = True
    keys = np.array(sorted(found), dtype=np.int64)
    chars = np.full(0x110000, -1, np.int32)
    for t, i in plain.items():
        if len(t) == 1:
            chars[ord(t)] = i
    return Pieces(text, chars, of_byte, keys, np.array([found[k] for k in keys.tolist()], dtype=np.int64), rank, alone)


def _pair_ranks(left: np.ndarray, right: np.ndarray, same: np.ndarray, p: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """Merged piece and its rank per pair; NEVER where the pair is none."""
    key = (left << 32) | right
    at = np.searchsorted(p.pairs, key)
    at[at == len(p.pairs)] = 0
    ok = same & (p.pairs[at] == key) & (left >= 0) & (right >= 0)
    new = np.where(ok, p.merged[at], 0)
    return new, np.where(ok, p.rank[new], NEVER).astype(np.int32)


def merge_rounds(flat: np.ndarray, word: np.ndarray, p: Pieces) -> list[tuple[np.ndarray, np.ndarray]]:
    """Symbols and the words they belong to -> finished (symbols, words) parts; symbols below 0 never merge."""
    done: list[tuple[np.ndarray, np.ndarray]] = []
    if not len(flat):
        return done
    new, rank = np.zeros(len(flat), np.int64), np.full(len(flat), NEVER, np.int32)
    new[:-1], rank[:-1] = _pair_ranks(flat[:-1], flat[1:], word[:-1] == word[1:], p)
    while len(flat):
        starts = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
        sizes = np.diff(np.append(starts, len(flat)))
        least = np.minimum.reduceat(rank, starts)
        over = least == NEVER
        if over.any():
            keep = ~np.repeat(over, sizes)
            done.append((flat[~keep], word[~keep]))
            flat, word, rank, new, least, sizes = flat[keep], word[keep], rank[keep], new[keep], least[~over], sizes[~over]
            if not len(flat):
                break
        best = np.flatnonzero(rank == np.repeat(least, sizes))
        # leftmost of each word; more of them only where that is safe, every other one of a touching run
        first = np.append(True, word[best[1:]] != word[best[:-1]])
        run = np.append(True, (best[1:] != best[:-1] + 1) | first[1:])
        place = np.arange(len(best)) - np.flatnonzero(run)[np.cumsum(run) - 1]
        take = best[first | ((place % 2 == 0) & ~_any_alone(p, new[best], first))]
        flat[take] = new[take]
        keep = np.ones(len(flat), bool)
        keep[take + 1] = False
        at = take - np.arange(len(take))  # where the merged symbols stand once the gaps are closed
        flat, word, rank, new = flat[keep], word[keep], rank[keep], new[keep]
        mark = np.zeros(len(flat) + 1, bool)
        mark[at] = mark[at - 1] = True
        touched = np.flatnonzero(mark[:-1])
        after = np.minimum(touched + 1, len(flat) - 1)
        new[touched], rank[touched] = _pair_ranks(flat[touched], flat[after], (word[touched] == word[after]) & (after > touched), p)
    return done


def _any_alone(p: Pieces, new: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Per candidate: does its word merge a piece this round that must be merged alone?"""
    unsafe = np.logical_or.reduceat(p.alone[new], np.flatnonzero(first))
    return unsafe[np.cumsum(first) - 1]


def encode_words(words: list[str], p: Pieces) -> list[bytes]:
    """Ids of each word as the bytes of its int32 values."""
    codes = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
    flat = p.of_char[codes].astype(np.int64)
    flat = np.where(flat < 0, -1 - codes, flat)
    done = merge_rounds(flat, np.repeat(np.arange(len(words)), np.fromiter(map(len, words), np.int64, len(words))), p)
    flat, word = (np.concatenate(x) for x in zip(*done)) if done else (flat, flat)
    order = np.argsort(word, kind="stable")
    flat = flat[order]
    ends = np.cumsum(np.bincount(word, minlength=len(words)))
    if (flat < 0).any():
        grown = [[p.of_byte[b] for b in chr(-1 - x).encode()] if x < 0 else [x] for x in flat.tolist()]
        sizes = np.cumsum([0] + [len(g) for g in grown])
        flat, ends = np.array([x for g in grown for x in g]), sizes[ends]
    out, bounds = flat.astype(np.int32).tobytes(), [0, *(4 * ends).tolist()]
    return [out[i:j] for i, j in zip(bounds, bounds[1:])]


class Encoder:
    """Encodes and decodes texts; remembers words between calls."""

    def __init__(self, pieces: Pieces):
        self.p, self.memory = pieces, {}
        line = "" if any("\n" in t for t in pieces.text) else "\n"  # no merge reaches across a character that no piece has
        self.cut = re.compile(f"{MARK}*[^{MARK}{line}]+|{MARK}+" + "|\n" * bool(line)).findall
        byte = {i: bytes([b]) for b, i in enumerate(pieces.of_byte)}
        self.raw = [byte.get(i, t.replace(MARK, " ").encode()) for i, t in enumerate(pieces.text)]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [ids for i, j in slices([len(t) for t in texts], CHUNK) for ids in self._encode(texts[i:j])]

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        cut = [self.cut(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        if len(self.memory) > MEMORY:
            self.memory.clear()
        fresh = list(set().union(*cut).difference(self.memory))
        # batches by characters: a round's arrays stay small whatever the words
        size, some = 0, []
        for w in fresh:
            some.append(w)
            size += len(w)
            if size > 60_000:
                self._learn(some)
                size, some = 0, []
        self._learn(some)
        look = self.memory.__getitem__
        return [np.frombuffer(b"".join(map(look, words)), dtype=np.int32) for words in cut]

    def _learn(self, words: list[str]) -> None:
        if words:
            self.memory.update(zip(words, encode_words(words, self.p)))

    def decode(self, ids: list[np.ndarray]) -> list[str]:
        look = self.raw.__getitem__
        texts = (b"".join(map(look, i.tolist())).decode("utf-8", "replace") for i in ids)
        return [t[1:] if t.startswith(" ") else t for t in texts]


def _ids(ids: list[np.ndarray]) -> pa.Array:
    """Ids of each text as one flat buffer with offsets."""
    ends = np.append(0, np.cumsum([len(i) for i in ids]))
    if ends[-1] > NEVER:
        raise ValueError("too many ids in one batch")
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(ids) if ids else np.zeros(0, np.int32), pa.int32()))


def _coded(docs: DataFrame, model_path: str, text: str, back: bool) -> DataFrame:
    spark = docs.sparkSession
    bounded_batches(spark)
    shared = Shared(spark, load_pieces(model_path))  # as large as the vocabulary
    rows = packed(docs).withColumn("text", F.coalesce(F.col(f"row.`{text}`"), F.lit("")))
    schema = T.StructType([*rows.schema.fields[:1], T.StructField("ids", T.ArrayType(T.IntegerType()))])
    if back:
        schema = schema.add("decoded", T.StringType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Encoder(shared.value)
        for batch in batches:
            ids = coder.encode(batch.column(1).to_pylist())
            columns = [batch.column(0), _ids(ids)]
            if back:
                columns.append(pa.array(coder.decode(ids), pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return rows.mapInArrow(lean(run), schema)


def encode(docs: DataFrame, model_path: str, text: str = "text") -> DataFrame:
    """(row, ids array<int>): every row packed, with the ids of its whole text."""
    return _coded(docs, model_path, text, False)


def decode(rows: DataFrame, model_path: str, ids: str = "ids") -> DataFrame:
    """rows with a column ``decoded``: the text of the ids; ids the model lacks are an error."""
    spark = rows.sparkSession
    bounded_batches(spark)
    shared = Shared(spark, load_pieces(model_path))

    @F.pandas_udf(T.StringType())
    def text_of(values: Iterator[pd.Series]) -> Iterator[pd.Series]:
        coder = Encoder(shared.value)
        for batch in values:
            yield pd.Series(coder.decode(list(batch)), dtype=object)

    return rows.withColumn("decoded", text_of(F.coalesce(F.col(ids), F.array().cast("array<int>"))))


def round_trip(docs: DataFrame, model_path: str, text: str = "text") -> DataFrame:
    """(row, ids, decoded): ``encode`` and ``decode`` in one pass over the texts."""
    return _coded(docs, model_path, text, True)
