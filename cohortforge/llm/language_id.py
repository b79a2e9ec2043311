"""Language identification by prediction by partial matching (PPM) over bytes.

Per language a context tree of order ``ORDER`` = 3 counts which byte follows the last 3, 2, 1 and 0 bytes.
Code lengths use frozen counts and escapes by method C: in a context with n symbols seen, d of them different,
a seen byte costs log2((n + d) / count), an unseen one log2((n + d) / d) plus its cost one order lower; a
context never seen costs nothing and passes on; below order 0 every byte costs 8 bits. As counts are frozen,
a byte's cost depends only on four bytes, so every string seen at any order gets its exact costs in all
languages once, and a text is scored by looking these up: bytes per language sum to its exact code length.

Fit: whole texts of at most ``rows_per_language`` labelled rows of each language (a documented bound), the
smallest hashes of their ids; executors count, the driver gets the summed counts. Texts are lower-cased.

Edge cases: null texts and texts without a letter are ``und`` with score 0; ties go to the smaller name; with
no labelled row every text is ``und``; rows with null language or text don't teach; repeated rows stay; an empty table
gives no rows; columns that are not asked for are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import Shared, bounded_batches, slices, smallest_hashes

ORDER = 3
#: Bytes scored at once in a task.
CHUNK = 2_000_000
#: Pairs of bytes with a direct table of four-byte strings; the others are found by search, with the same costs.
PAIRS = 2047


@dataclass
class Trees:
    langs: list[str]
    keys: list[np.ndarray]  # [k]: sorted strings of k + 1 bytes seen in some language
    bits: list[np.ndarray]  # [k]: their costs, a column per language, then a row of zeros
    escape: list[np.ndarray]  # [k]: escape costs of the contexts of k bytes in ``contexts``
    contexts: list[np.ndarray]
    pair_of: np.ndarray
    direct: np.ndarray


def grams(data: np.ndarray, order: int) -> np.ndarray:
    """Every byte with the ``order`` before it as one number; the first bytes must be padding."""
    out = data[ORDER:].astype(np.uint32)
    for k in range(1, order + 1):
        out |= data[ORDER - k : len(data) - k].astype(np.uint32) << np.uint32(8 * k)
    return out


def padded(text: str) -> np.ndarray:
    return np.frombuffer(b"\0" * ORDER + text.lower().encode("utf-8", "replace"), dtype=np.uint8)


def gram_counts(rows: DataFrame) -> DataFrame:
    """rows (lang, text) -> (lang, gram, n): counts of strings of four bytes, summed over all rows."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for lang, part in pdf.groupby("lang"):
                texts = part["text"].tolist()
                for i, j in slices([len(t) for t in texts], CHUNK):
                    g, n = np.unique(np.concatenate([grams(padded(t), ORDER) for t in texts[i:j]]), return_counts=True)
                    yield pd.DataFrame({"lang": lang, "gram": g.astype(np.int64), "n": n.astype(np.int64)})

    return rows.mapInPandas(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def sample_rows(docs: DataFrame, rows_per_language: int) -> DataFrame:
    """Whole texts of the rows of each language with the smallest hashes of their ids, at most so many ids."""
    usable = docs.where("text is not null and lang is not null and doc_id is not null")
    some = smallest_hashes(usable.select("doc_id", "lang"), "lang", ["doc_id"], rows_per_language)
    return usable.join(F.broadcast(some.distinct()), ["doc_id", "lang"]).select("lang", "text")  # so many ids of each language


def fit(rows: DataFrame) -> Trees:
    """rows (lang, text) of a bounded sample -> context trees with frozen costs."""
    bounded_batches(rows.sparkSession)
    counts = gram_counts(rows).toPandas()
    langs = sorted(counts["lang"].unique())
    column = counts["lang"].map({x: i for i, x in enumerate(langs)}).to_numpy(dtype=np.int64)
    gram, n = counts["gram"].to_numpy(dtype=np.uint32), counts["n"].to_numpy(dtype=np.float64)
    keys, bits, contexts, escape = [], [], [], []
    for k in range(ORDER + 1):
        own = gram & np.uint32(2 ** (8 * (k + 1)) - 1)
        key, at = np.unique(own, return_inverse=True)
        table = np.zeros((len(key), len(langs)))
        np.add.at(table, (at, column), n)
        ctx, of = np.unique(key >> np.uint32(8), return_inverse=True) if k else (np.zeros(1, np.uint32), np.zeros(len(key), np.int64))
        ctx_of = key & np.uint32(0)
        ctx_of = key >> np.uint32(8)
        seen, kinds = np.zeros((len(ctx), len(langs))), np.zeros((len(ctx), len(langs)))
        np.add.at(seen, of, table)
        np.add.at(kinds, of, table > 0)
        with np.errstate(divide="ignore", invalid="ignore"):
            esc = np.where(seen > 0, np.log2((seen + kinds) / kinds), 0.0)
            cost = np.log2((seen + kinds)[of] / table)
        if k:
            lower = bits[k - 1][np.searchsorted(keys[k - 1], key & np.uint32(2 ** (8 * k) - 1))]  # its shorter string was seen too
        else:
            lower = np.full((len(key), len(langs)), 8.0)
        cost = np.where(table > 0, cost, esc[of] + lower)
        keys.append(key)
        bits.append(cost)
        contexts.append(ctx if k else ctx_of[:1] * np.uint32(0))
        escape.append(esc)
    pairs = np.bincount((gram >> np.uint32(16)).astype(np.int64), n, 65536) + np.bincount((gram & np.uint32(0xFFFF)).astype(np.int64), n, 65536)
    often = np.argsort(-pairs, kind="stable")[:PAIRS]
    pair_of = np.zeros(65536, np.int32)
    pair_of[often] = np.arange(1, len(often) + 1)
    direct = np.full((PAIRS + 1) * (PAIRS + 1), -1, np.int32)
    top = keys[ORDER] if len(langs) else np.zeros(0, np.uint32)
    a, b = pair_of[top >> np.uint32(16)], pair_of[top & np.uint32(0xFFFF)]
    both = (a > 0) & (b > 0)
    direct[a[both] * (PAIRS + 1) + b[both]] = np.flatnonzero(both)
    return Trees(langs, keys, [x.astype(np.float32) for x in bits], [x.astype(np.float32) for x in escape], contexts, pair_of, direct)


def _found(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Places of ``wanted`` in sorted ``keys``, -1 where missing."""
    at = np.searchsorted(keys, wanted)
    at[at == len(keys)] = 0
    return np.where(keys[at] == wanted, at, -1)


def _costs(t: Trees, gram: np.ndarray, order: int) -> np.ndarray:
    """Exact costs of strings of ``order`` + 1 bytes, seen or not."""
    if order < 0:
        return np.full((len(gram), len(t.langs)), 8.0, np.float32)
    at = _found(t.keys[order], gram)
    out = t.bits[order][at]
    miss = np.flatnonzero(at < 0)
    if len(miss):
        ctx = _found(t.contexts[order], gram[miss] >> np.uint32(8))
        esc = np.where((ctx >= 0)[:, None], t.escape[order][ctx], np.float32(0))
        out[miss] = esc + _costs(t, gram[miss] & np.uint32(2 ** (8 * order) - 1 if order else 0), order - 1)
    return out


def byte_costs(t: Trees, data: np.ndarray) -> np.ndarray:
    """Costs of every byte after the padding, a column per language."""
    pairs = (data[:-1].astype(np.uint16) << np.uint16(8)) | data[1:]
    ids = t.pair_of[pairs]
    a, b = ids[:-2], ids[2:]
    at = np.where((a > 0) & (b > 0), t.direct[a * (PAIRS + 1) + b], -1)
    out = t.bits[ORDER][at]
    miss = np.flatnonzero(at < 0)
    if len(miss):
        strings, back = np.unique(grams(data, ORDER)[miss], return_inverse=True)
        out[miss] = _costs(t, strings, ORDER)[back]
    return out


def code_lengths(t: Trees, texts: list[str]) -> np.ndarray:
    """Bits of each whole text in each language."""
    out = np.zeros((len(texts), len(t.langs)))
    data = [padded(x) for x in texts]
    for i, j in slices([len(x) for x in data], CHUNK):
        if j - i == 1:  # a long text goes in stretches that overlap by the context
            x = data[i]
            for s in range(0, max(len(x) - ORDER, 0), CHUNK):
                out[i] += byte_costs(t, x[s : s + CHUNK + ORDER]).sum(0, dtype=np.float64)
            continue
        costs = byte_costs(t, np.concatenate(data[i:j]))
        ends = np.cumsum([len(x) for x in data[i:j]])
        sums = np.zeros((len(costs) + 1, costs.shape[1]))
        np.cumsum(costs, axis=0, dtype=np.float64, out=sums[1:])
        # bytes that belong to the padding of the next text stay out
        out[i:j] = sums[ends - ORDER] - sums[np.append(0, ends[:-1])]
    return out


def predict(docs: DataFrame, trees: Trees) -> DataFrame:
    """docs (doc_id, held_out, text) -> doc_id, held_out, lang_pred, score, bits: bits of the best language."""
    spark = docs.sparkSession
    bounded_batches(spark)
    shared = Shared(spark, trees)  # bounded by the rows of the fit

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        t = shared.value
        for pdf in batches:
            texts = [x or "" for x in pdf["text"]]
            letters = np.array([any(map(str.isalpha, x)) for x in texts], bool) & bool(t.langs)
            names, best, bits = np.full(len(texts), "und", object), np.zeros(len(texts)), np.full(len(texts), np.nan)
            if letters.any():
                rows = np.flatnonzero(letters)
                lengths = code_lengths(t, [texts[i] for i in rows])
                win = lengths.argmin(1)
                low = lengths[np.arange(len(rows)), win]
                best[rows] = 1 / np.exp2(np.maximum(low[:, None] - lengths, -1000)).sum(1)
                names[rows], bits[rows] = np.array(t.langs, object)[win], low
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "held_out": pdf["held_out"], "lang_pred": names, "score": best, "bits": np.round(bits, 2)})

    return docs.select("doc_id", "held_out", "text").mapInPandas(score, "doc_id long, held_out boolean, lang_pred string, score double, bits double")
