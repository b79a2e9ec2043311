"""Benchmark decontamination: BM25 over an inverted index of the test items, searched by block-max WAND.

Test items are the indexed documents; passages of training texts are the queries. A passage is a window of twice
the words of the longest item, a new one every such length, so every stretch as long as an item lies whole in one.
Impacts are BM25 weights divided by the item's score against itself: a passage that holds the whole item scores 1,
and all passages with a score of at least ``share`` are retrieved, however many. Items stand in order of that score,
in ``GROUPS`` groups; a passage whose terms' largest impacts can't reach the share in any group is passed over (a
whole batch of passages at once), the others go through block-max WAND: postings in order of item,
blocks of ``BLOCK`` with their largest impact, a pivot where the sum of term bounds reaches the share, blocks whose
own bounds can't skipped whole.

Retrieved pairs are verified: the item's question (its sentences but the last, or the first two thirds of its words)
and its answer (the rest) must both be found again in the passage: ``question`` of the first by its runs of three
words, ``answer`` of the second, often a few words only, by its single words.

Words are case-folded runs of letters and digits. Document frequencies and lengths are counted over all items. The
index is broadcast in shards of at most ``SHARD`` postings, each a pass over the texts.

Edge cases: null or empty texts and items have no words and match nothing; repeated items count as items; repeated
rows are judged alike; columns beside ``doc_id`` and ``text`` stay; without items nothing is contaminated; an item of one
word is all answer; very long texts are searched whole, in overlapping windows; an empty table gives no rows.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import Shared, bounded_batches, lean, materialize, slices

K1, B = 1.2, 0.75
BLOCK, SHARD, GROUPS = 16, 1_000_000, 128
RUN = 3
#: Characters searched at once in a task (a longer text goes whole).
CHUNK = 300_000
words_of = re.compile(r"[^\W_]+").findall
_last_stop = re.compile(r"[.!?\n]\s*(?=[^\W_])")


@dataclass
class Part:
    """One shard of the index."""

    items: list[int]  # ids
    words: list[list[str]]
    cut: list[int]  # words of the question
    raw: np.ndarray  # score of each item against itself
    terms: dict[str, int]
    most: np.ndarray  # largest impact of each term
    by_group: np.ndarray  # the same within each group of items
    posts: list[tuple[list[int], list[float]]]  # of each term: items in order, impacts
    blocks: list[tuple[list[int], list[float]]]  # of each term: last item of each block, largest impact
    window: int


def question_and_answer(text: str) -> tuple[list[str], int]:
    """Words of an item and how many of them are its question; at least one word is left as its answer."""
    words = words_of(text.casefold())
    stops = [m.end() for m in _last_stop.finditer(text)]
    cut = len(words_of(text[: stops[-1]].casefold())) if stops else 0
    return words, cut if 0 < cut < len(words) else max(0, min(-(-2 * len(words) // 3), len(words) - 1))


def item_terms(items: DataFrame) -> DataFrame:
    """items (item_id, text) -> (item_id, text, term, tf, length, df, n_items, mean_length)."""

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for i, t in zip(pdf["item_id"], pdf["text"]):
                counts = Counter(words_of(t.casefold()))
                rows += [(i, t, w, n, sum(counts.values())) for w, n in counts.items()]
            yield pd.DataFrame(rows, columns=["item_id", "text", "term", "tf", "length"])

    rows = items.where("item_id is not null and text is not null").select(F.col("item_id").cast("long"), "text").dropDuplicates()
    terms = materialize(rows.mapInPandas(split, "item_id long, text string, term string, tf long, length long"), "item-terms")
    stats = terms.dropDuplicates(["item_id", "text"]).agg(F.count("*").alias("n"), F.avg("length").alias("mean")).first()
    df = terms.groupBy("term").agg(F.count("*").alias("df"))
    return terms.join(df, "term").withColumns({"n_items": F.lit(stats["n"]), "mean_length": F.lit(stats["mean"])})


def _part(rows: pd.DataFrame, window: int) -> Part:
    idf = np.log1p((rows["n_items"] - rows["df"] + 0.5) / (rows["df"] + 0.5)).to_numpy()
    tf, length = rows["tf"].to_numpy(float), rows["length"].to_numpy(float)
    weight = idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / rows["mean_length"].to_numpy()))
    rows = rows.assign(weight=weight)
    rows["raw"] = rows.groupby(["item_id", "text"])["weight"].transform("sum").round(9)
    rows = rows.sort_values(["raw", "item_id", "text", "term"])
    keys = list(dict.fromkeys(zip(rows["item_id"], rows["text"])))
    place = {k: i for i, k in enumerate(keys)}
    at = np.array([place[k] for k in zip(rows["item_id"], rows["text"])])
    weight = rows["weight"].to_numpy()
    raw = np.bincount(at, weight, minlength=len(keys))
    impact = weight / raw[at]
    terms: dict[str, int] = {}
    posts: list[tuple[list[int], list[float]]] = []
    for w, i, x in zip(rows["term"], at.tolist(), impact.tolist()):
        t = terms.setdefault(w, len(terms))
        if t == len(posts):
            posts.append(([], []))
        posts[t][0].append(i)
        posts[t][1].append(x)
    blocks = [([p[0][min(s + BLOCK, len(p[0])) - 1] for s in range(0, len(p[0]), BLOCK)], [max(p[1][s : s + BLOCK]) for s in range(0, len(p[0]), BLOCK)]) for p in posts]
    by_group = np.zeros((len(terms) + 1, min(GROUPS, len(keys))), np.float32)
    np.maximum.at(by_group, (rows["term"].map(terms).to_numpy(), at * by_group.shape[1] // len(keys)), impact.astype(np.float32))
    split = [question_and_answer(t) for _, t in keys]
    return Part([i for i, _ in keys], [w for w, _ in split], [c for _, c in split], raw, terms, np.array([max(p[1]) for p in posts]), by_group, posts, blocks, window)


def index_parts(items: DataFrame) -> Iterator[Part]:
    """The index in shards of bounded size, one at a time; every item lies whole in one."""
    terms = materialize(item_terms(items), "postings")
    total, longest = terms.agg(F.count("*"), F.max("length")).first()
    shards = -(-total // SHARD)
    rows = terms.withColumn("shard", F.pmod(F.xxhash64("item_id", "text"), F.lit(max(1, shards))))
    for s in range(shards):
        if len(shard := rows.where(F.col("shard") == s).drop("shard").toPandas()):  # at most about SHARD rows
            yield _part(shard, 2 * longest)


def block_max_wand(terms: list[int], part: Part, share: float) -> list[tuple[int, float]]:
    """(item, score) of every item with a score of ``share`` or more against the set of terms."""
    share -= 1e-9
    lists = [[0, t] for t in terms]  # [place in the postings, term]
    posts, blocks, most, out = part.posts, part.blocks, part.most, []
    while lists:
        lists.sort(key=lambda x: posts[x[1]][0][x[0]])
        bound, pivot = 0.0, -1
        for n, (_, t) in enumerate(lists):
            bound += most[t]
            if bound >= share:
                pivot = n
                break
        if pivot < 0:
            break
        item = posts[lists[pivot][1]][0][lists[pivot][0]]
        while pivot + 1 < len(lists) and posts[lists[pivot + 1][1]][0][lists[pivot + 1][0]] == item:
            pivot += 1
        ahead, reach = 0.0, None
        for _, t in lists[: pivot + 1]:
            ends, tops = blocks[t]
            b = bisect_left(ends, item)
            if b < len(ends):
                ahead += tops[b]
                reach = ends[b] if reach is None else min(reach, ends[b])
        if ahead >= share:
            if posts[lists[0][1]][0][lists[0][0]] == item:
                score = sum(posts[t][1][p] for p, t in lists[: pivot + 1])
                if score >= share:
                    out.append((item, score))
                to = item + 1
            else:
                to = item
        else:  # no item up to the end of the nearest block can reach the share
            to = (item if reach is None else reach) + 1
            if pivot + 1 < len(lists):
                to = min(to, posts[lists[pivot + 1][1]][0][lists[pivot + 1][0]])
            to = max(to, item + 1)
        kept = []
        for n, x in enumerate(lists):
            if n <= pivot:
                x[0] = bisect_left(posts[x[1]][0], to, x[0])
            if x[0] < len(posts[x[1]][0]):
                kept.append(x)
        lists = kept
    return out


def overlap(part: list[str], passage: list[str], run: int = RUN) -> float:
    """Share of the runs of so many words (all, if fewer) of ``part`` that stand in the passage."""
    n = min(run, len(part))
    if not n:
        return 0.0
    runs = [tuple(part[i : i + n]) for i in range(len(part) - n + 1)]
    there = {tuple(passage[i : i + n]) for i in range(len(passage) - n + 1)}
    return sum(r in there for r in runs) / len(runs)


def search_texts(texts: list[str | None], part: Part, share: float, question: float, answer: float) -> list[dict[int, tuple[float, float, float]]]:
    """Per whole text: item -> (largest score, question and answer overlap) of every confirmed item."""
    out: list[dict] = [{} for _ in texts]
    for i, j in slices([len(t or "") for t in texts], CHUNK):
        split = [words_of(t.casefold()) if t else [] for t in texts[i:j]]
        starts = np.cumsum([0] + [len(w) for w in split[:-1]])
        _search([w for words in split for w in words], starts, out[i:j], part, share, question, answer)
    return out


def _search(words: list[str], texts: np.ndarray, out: list[dict], part: Part, share: float, question: float, answer: float) -> None:
    """Joined words of some texts, which begin at ``texts``; adds to ``out``."""
    if not words:
        return
    ids = np.fromiter(map(part.terms.get, words, repeat(-1)), np.int64, len(words))
    step, stops = part.window // 2, np.append(texts[1:], len(words))
    counts = np.maximum(1, -(-(stops - texts - step) // step))
    owner = np.repeat(np.arange(len(texts)), counts)
    starts = texts[owner] + step * (np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts))
    ends = np.minimum(starts + part.window, stops[owner])
    # the different terms of every window, all windows at once
    sizes = ends - starts
    window = np.repeat(np.arange(len(starts)), sizes)
    term = ids[np.arange(len(window)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + starts[window]]
    pairs = np.unique((window * len(part.by_group) + term)[term >= 0])
    if not len(pairs):
        return
    window, term = np.divmod(pairs, len(part.by_group))
    first = np.flatnonzero(np.append(True, window[1:] != window[:-1]))
    bounds = np.add.reduceat(part.by_group[term], first, axis=0).max(1)
    last = np.append(first[1:], len(pairs))
    for n in np.flatnonzero(bounds >= share - 1e-4).tolist():
        w = window[first[n]]
        for item, score in block_max_wand(term[first[n] : last[n]].tolist(), part, share):
            passage = words[starts[w] : ends[w]]
            asks = part.words[item][: part.cut[item]]  # an item of one word has no question
            q, a = overlap(asks, passage) if asks else 1.0, overlap(part.words[item][part.cut[item] :], passage, 1)
            if q >= question and a >= answer:
                found = out[owner[w]]
                found[item] = max(found.get(item, (0.0, 0.0, 0.0)), (score, q, a))


def contaminated(docs: DataFrame, items: DataFrame, share: float = 0.6, question: float = 0.5, answer: float = 0.5) -> DataFrame:
    """(doc_id, item_id, bm25, share, question_overlap, answer_overlap): one row per text and confirmed item."""
    spark = docs.sparkSession
    bounded_batches(spark)
    schema = "doc_id long, item_id long, bm25 double, share double, question_overlap double, answer_overlap double"

    def one(part: Part) -> DataFrame:
        shared = Shared(spark, part)  # at most SHARD postings

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            p = shared.value
            for pdf in batches:
                rows = []
                for i, found in zip(pdf["doc_id"], search_texts(pdf["text"].tolist(), p, share, question, answer)):
                    rows += [(i, p.items[k], round(x * p.raw[k], 6), round(x, 6), q, a) for k, (x, q, a) in found.items()]
                yield pd.DataFrame(rows, columns=["doc_id", "item_id", "bm25", "share", "question_overlap", "answer_overlap"])

        return docs.select("doc_id", "text").mapInPandas(lean(run), schema)

    return reduce(DataFrame.unionAll, map(one, index_parts(items)), spark.createDataFrame([], schema))


def drop_contaminated(docs: DataFrame, items: DataFrame, share: float = 0.6, question: float = 0.5, answer: float = 0.5) -> DataFrame:
    """The rows of docs, all columns, whose text confirms no item."""
    spark = docs.sparkSession
    bounded_batches(spark)

    def one(rows: DataFrame, part: Part) -> DataFrame:
        shared = Shared(spark, part)

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            p = shared.value
            for pdf in batches:
                yield pdf[[not found for found in search_texts(pdf["text"].tolist(), p, share, question, answer)]]

        return rows.mapInPandas(lean(run), rows.schema)

    return reduce(one, index_parts(items), docs)
