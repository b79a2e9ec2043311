"""Line and span dedup against brute force, and their edge cases."""

import random

import pytest
from pyspark.sql import functions as F

from cohortforge.llm import line_dedup, span_dedup


def brute_lines(docs, width=3):
    seen, gone, out = {}, {}, {}
    for i, t in docs:
        lines = t.split("\n")
        marks = [k for k, x in enumerate(lines) if x.strip(" \t\r")]
        for p in range(len(marks) - width + 1):
            key = tuple(lines[marks[p + o]].strip(" \t\r") for o in range(width))
            if key in seen:
                gone.setdefault(i, set()).update(marks[p : p + width])
            seen.setdefault(key, (i, p))
    for i, t in docs:
        out[i] = "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone.get(i, ()))
    return out


@pytest.mark.parametrize("seed", range(3))
def test_lines_match_brute_force(make_docs, seed):
    rng = random.Random(seed)
    docs = [(i, "\n".join(rng.choice(["a", "b", "c ", "", "  ", "long line", "x"]) for _ in range(rng.randint(0, 25)))) for i in range(40)]
    got = {r["i"]: r["kept"] for r in line_dedup.drop_repeated_lines(make_docs(docs)).select(F.col("row.doc_id").alias("i"), "kept").collect()}
    assert got == brute_lines(docs)


def test_lines_edges(odd_docs, make_docs):
    rows = line_dedup.drop_repeated_lines(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    assert all(r["kept"] == r["row"]["text"] and r["lines_removed"] == 0 for r in rows)
    assert line_dedup.drop_repeated_lines(odd_docs.limit(0)).count() == 0
    same = [(1, "a\nb\nc"), (1, "a\nb\nc"), (2, "a\nb\nc\nd"), (None, "q\na\nb\nc")]
    got = sorted((str(r["row"]["doc_id"]), r["kept"]) for r in line_dedup.drop_repeated_lines(make_docs(same)).collect())
    assert got == [("1", ""), ("1", ""), ("2", "d"), ("None", "q\na\nb\nc")]


def test_passage_of_fifty_words_is_caught_wherever_it_stands(make_docs):
    passage = "The first part has these ten words in it now. The second one goes on for a few words more. " * 3
    docs = [(1, "Some start without an end " + passage + "and the rest."), (2, passage), (3, "Nothing to see here. It is a text of its own, with no copy.")]
    got = {r["row"]["doc_id"]: r for r in span_dedup.drop_repeated_runs(make_docs(docs), only_changed=True).collect()}
    assert 2 in got and 3 not in got
    assert got[2]["first_docs"] == [1]


def test_spans_edges(odd_docs, make_docs):
    rows = span_dedup.drop_repeated_runs(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    assert all(r["kept"] == r["row"]["text"] for r in rows)
    assert span_dedup.drop_repeated_runs(odd_docs.limit(0)).count() == 0
    text = "One two three four five six. Seven eight nine ten eleven twelve."
    rows = span_dedup.drop_repeated_runs(make_docs([(1, text), (1, text), (2, text)]), only_changed=True).collect()
    assert [r["row"]["doc_id"] for r in rows] == [2]


def brute_all_spans(docs, sentences=2, words=12):
    """Every run of every length."""
    seen, gone = {}, {}
    for i, t in docs:
        keys = [(k, " ".join(s.lower().split())) for k, s in enumerate(span_dedup.sentences_of(t))]
        keys = [(k, s) for k, s in keys if s and (" " in s or any(c.isalnum() for c in s))]
        for p in range(len(keys)):
            for q in range(p + sentences - 1, len(keys)):
                key = tuple(s for _, s in keys[p : q + 1])
                if sum(len(s.split()) for s in key) < words:
                    continue
                if key in seen:
                    gone.setdefault(i, set()).update(range(keys[p][0], keys[q][0] + 1))
                seen.setdefault(key, i)
    return {i: "".join(s for k, s in enumerate(span_dedup.sentences_of(t)) if k not in gone.get(i, ())) for i, t in docs}


@pytest.mark.parametrize("seed", range(6))
def test_runs_of_every_length_are_covered(make_docs, seed):
    rng = random.Random(seed)
    parts = [" ".join(rng.choice("alpha beta gamma delta".split()) for _ in range(rng.choice([1, 2, 3, 4, 14, 20]))) + rng.choice([".", "!", "?", ".\n", "\n"]) for _ in range(40)]
    docs = [(i, " ".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))) for i in range(60)]
    got = {r["i"]: r["kept"] for r in span_dedup.drop_repeated_runs(make_docs(docs)).select(F.col("row.doc_id").alias("i"), "kept").collect()}
    assert got == brute_all_spans(docs)


def test_short_end_of_a_repeated_passage_goes(make_docs):
    passage = " ".join(f"w{i}" for i in range(20)) + ". And three words. Then three more. "
    docs = [(1, passage + "It goes on like this here."), (2, passage + "Quite another end of it.")]
    got = {r["row"]["doc_id"]: r["kept"] for r in span_dedup.drop_repeated_runs(make_docs(docs), only_changed=True).collect()}
    assert got == {2: "Quite another end of it."}


def test_texts_with_one_32_bit_hash_under_one_id_stay_apart(spark, make_docs):
    """Of texts that collide in 32 bits, one repeats a passage; the other must lose nothing."""
    passage = "These twelve words make up a passage that stands in many of them. "
    heads = spark.range(300_000).select(F.concat(F.lit(passage + "Own words number "), "id", F.lit(" end here and nowhere else. ")).alias("t"), F.col("id"))
    pair = heads.groupBy(F.hash("t").alias("h")).agg(F.collect_list("t").alias("ts")).where("size(ts) > 1").first()["ts"][:2]
    other = "Quite another sentence with more than twelve words of its very own in it. One more follows it here."
    docs = [(1, passage + "And some more to end it."), (5, pair[0]), (5, pair[1]), (6, other)]
    got = sorted((r["row"]["doc_id"], r["kept"]) for r in span_dedup.drop_repeated_runs(make_docs(docs)).collect())
    assert got == sorted((i, brute_all_spans([(k, t) for k, t in enumerate(t for _, t in docs)])[k]) for k, (i, t) in enumerate(docs))
