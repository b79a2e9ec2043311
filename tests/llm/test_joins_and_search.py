"""Jaccard join, components, multi-index and url filter against brute force, and their edge cases."""

import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortforge.llm import jaccard_join, multi_index, url_filter
from cohortforge.llm.components import components
from cohortforge.llm.queries import URL_RULES


def shingle_set(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def brute_components(docs, width, percent):
    sets = [(i, shingle_set(t, width)) for i, t in docs]
    name = {i: i for i, _ in sets}
    for (i, a), (j, b) in itertools.combinations(sets, 2):
        if a and b and 100 * len(a & b) >= percent * len(a | b) and name[i] != name[j]:
            low, high = sorted((name[i], name[j]))
            name = {k: low if v == high else v for k, v in name.items()}
    return {i: (len(s), name[i]) for i, s in sets}


def near_copies(rng, n, base, words, edits):
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randint(0, edits)):
            w[rng.randrange(len(w))] = rng.choice(words)
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("width,percent,edits", [(3, 90, 3), (5, 80, 4), (2, 60, 12)])
def test_components_match_brute_force(make_docs, monkeypatch, width, percent, edits):
    monkeypatch.setattr(jaccard_join, "LOCAL", 8)
    monkeypatch.setattr(jaccard_join, "MEMBERS", 4)
    monkeypatch.setattr(jaccard_join, "QUERIES", 8)
    rng = random.Random(width)
    words = [f"w{i}" for i in range(300)]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 60))) for _ in range(20)]
    for _ in range(4):
        texts += near_copies(rng, 30, [rng.choice(words) for _ in range(120)], words, edits)
    texts += [texts[25]] * 20 + ["A b", "a B", "a  b", "a b c", "one", "", "\t"]
    rng.shuffle(texts)
    docs = list(enumerate(texts))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.jaccard_components(make_docs(docs), width, percent).collect()}
    assert got == brute_components(docs, width, percent)


def test_join_edges(odd_docs, make_docs):
    rows = jaccard_join.jaccard_components(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    got = {(r["doc_id"], r["n_shingles"], r["component_id"]) for r in rows}
    long = 30_000 - 4
    assert {(1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (6, long, 6), (7, long, 6), (None, 2, None)} <= got
    assert jaccard_join.jaccard_components(odd_docs.limit(0)).count() == 0
    only_empty = jaccard_join.jaccard_components(make_docs([(1, ""), (2, None)])).collect()
    assert sorted(tuple(r)[0] for r in only_empty) == [1, 2]


def test_sketch_reaches_the_driver_as_one_byte_a_slot(make_docs):
    rng = random.Random(8)
    texts = [" ".join(rng.choice("abcdef") for _ in range(400)) for _ in range(30)] + [None, ""]
    counts = np.zeros(1 << jaccard_join.SKETCH_BITS, np.int64)
    shingles = jaccard_join.Shingles(3)
    for t in texts:
        np.add.at(counts, (shingles.all(t) >> np.uint64(64 - jaccard_join.SKETCH_BITS)).astype(np.int64), 1)
    got = jaccard_join._sketch(make_docs(list(enumerate(texts))), 3)
    assert got.nbytes == 1 << jaccard_join.SKETCH_BITS
    assert (got == np.minimum(np.log2(counts + 1) * 6, 255).astype(np.int64)).all() and counts.max() > 20


def test_components_of_chains_and_stars(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(100, 160)] + [(5, i) for i in range(6, 60)] + [(3, 4), (4, 3), (70, 70)]
    rng.shuffle(edges)
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 100 for i in range(100, 161)} | {i: 5 for i in range(5, 60)} | {3: 3, 4: 3}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_neighbours(ids, x, q, k):
    d = np.sqrt(((x - x[list(ids).index(q)]) ** 2).sum(1))
    return sorted((v, i) for v, i in zip(d.tolist(), ids) if i != q)[:k]


def test_search_recall_on_the_table(spark, data):
    big = data.replace("sf0.001", "sf0.1")
    table = spark.read.parquet(f"{big}/embeddings.parquet")
    pdf = table.toPandas()
    ids, x = pdf.vec_id.tolist(), np.stack(pdf.embedding.to_numpy()).astype(float)
    got = multi_index.search(table, F.col("vec_id") % 100 == 0).toPandas()
    found = total = 0
    for q in [i for i in ids if i % 100 == 0]:
        mine = got[got.query_id == q].sort_values("rank")
        want = brute_neighbours(ids, x, q, 10)
        d = {i: v for v, i in brute_neighbours(ids, x, q, len(ids))}
        assert mine["rank"].tolist() == list(range(1, 11)) and [d[i] for i in mine.vec_id] == pytest.approx(mine.score.tolist(), abs=1e-12)
        found, total = found + len({i for _, i in want} & set(mine.vec_id)), total + 10
    assert found / total >= 0.9


def test_search_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.9, 0.1]), (4, None), (5, [0.0, 0.0]), (6, [nan, 1.0]), (7, [inf, 1.0]), (8, [1.0, None]), (100, [0.0, 1.0]), (100, [0.0, 1.0]), (None, [1.0, 1.0]), (9, [])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(tuple(r) for r in multi_index.search(table, F.col("vec_id") % 100 == 0).collect())
    assert [(q, r, i) for q, r, i, _ in got] == [(0, 1, 1), (0, 2, 2), (0, 3, 3), (0, 4, 100), (100, 1, 3), (100, 2, 0), (100, 3, 1), (100, 4, 2)]
    assert multi_index.search(table.limit(0), F.col("vec_id") % 100 == 0).count() == 0
    assert multi_index.search(table.where("vec_id in (4, 5)"), F.col("vec_id") % 100 == 0).count() == 0


def test_search_with_a_vector_shared_by_a_third(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(900, 8))
    x[::3] = x[0]
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = multi_index.search(table, F.col("vec_id") % 100 == 0).toPandas()
    for q in (0, 300, 600):
        assert got[got.query_id == q].sort_values("rank").vec_id.tolist() == [i for i in range(0, 36, 3) if i != q][:10]


def test_url_parts_and_rules(spark):
    urls = ["http://WWW.Example.com/en/a?x", "https://a.example.com/en/b#c", "http://example.com", "http://x.net/es/1", "x.net/es/", None, "a://b://c/d", "http://évil.NET/fr/\nq", "http://u@example.com:80/en/?", "http://badexample.com/en/", "://h/p"]
    host, path = url_filter.url_parts(F.col("url"))
    rule, verdict = url_filter.rule_of(host, path, URL_RULES)
    rows = spark.createDataFrame([(u,) for u in urls], "url string").select(host, path, rule, verdict).collect()
    assert [tuple(r) for r in rows] == [
        ("www.example.com", "/en/a", "www.example.com/en/", "allow"),
        ("a.example.com", "/en/b", "example.com/en/", "block"),
        ("example.com", "", None, None),
        ("x.net", "/es/1", "net/es/", "block"),
        ("", "", None, None),
        ("", "", None, None),
        ("b:", "//c/d", None, None),
        ("évil.net", "/fr/\nq", "net/fr/", "block"),
        ("u@example.com:80", "/en/", None, None),
        ("badexample.com", "/en/", "com/", "allow"),
        ("h", "/p", None, None),
    ]


def test_reputation_shrinks(spark):
    rows = [("bad.one.org", 1)] * 40 + [("good.one.org", 0)] * 40 + [("rare.one.org", 1)] + [("new.one.org", None)] + [("fine.two.org", 0)] * 60
    got = {r["host"]: r for r in url_filter.host_reputation(spark.createDataFrame(rows, "host string, bad int")).collect()}
    assert got["bad.one.org"]["bound"] > 0.5 > got["rare.one.org"]["bound"]
    assert got["good.one.org"]["rate"] < got["new.one.org"]["rate"] < got["bad.one.org"]["rate"]


def test_url_edges(spark):
    pages = spark.createDataFrame([(1, None), (1, None), (None, "http://a.org/x")], "page_id long, url string")
    none = spark.createDataFrame([], "page_id long, bad int")
    got = url_filter.judge_pages(pages, none, URL_RULES).collect()
    assert len(got) == 3 and {r["verdict"] for r in got} == {"allow"}
    assert url_filter.judge_pages(pages.limit(0), none, URL_RULES).count() == 0
    twice = spark.createDataFrame([(1, 0), (1, 1), (None, 1)], "page_id long, bad int")
    assert url_filter.judge_pages(pages, twice, URL_RULES).count() == 3


def test_near_copies_without_an_id_cost_about_their_rows(spark, make_docs, monkeypatch):
    """Written tables stay in proportion to the texts, with and without ids; ids don't change the components."""
    rng = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    texts = near_copies(rng, 300, [rng.choice(words) for _ in range(150)], words, 3) + [" ".join(rng.choice(words) for _ in range(100)) for _ in range(20)]
    sizes = {}
    real = jaccard_join.materialize

    def count(df, name):
        out = real(df, name)
        sizes.setdefault(name, []).append(out.count())
        return out

    monkeypatch.setattr(jaccard_join, "materialize", count)
    with_ids = jaccard_join.jaccard_components(make_docs(list(enumerate(texts))), 5, 80)
    groups = sorted(r[0] for r in with_ids.groupBy("component").agg(F.count("*")).select("count(1)").collect())
    without = jaccard_join.jaccard_components(make_docs([(None, t) for t in texts]), 5, 80)
    assert sorted(r[0] for r in without.groupBy("component").agg(F.count("*")).select("count(1)").collect()) == groups
    assert groups[-1] > 250
    assert all(max(sizes[name]) <= 4 * len(texts) for name in ("sets", "candidates", "qualifying", "links", "linked", "unions"))


def test_texts_are_shuffled_once_and_sets_carry_what_they_are_for(spark, make_docs):
    docs = make_docs([(1, "a b c d"), (1, "a b c d"), (1, "other"), (None, "without an id"), (0, "without an id"), (2, None)])
    ids = docs.selectExpr("doc_id AS doc", "xxhash64(text) AS ver", "text").where("text <> 'other'").distinct()
    wanted = ids.where("text IS NOT NULL").selectExpr("hash(doc, ver) AS cid", "doc", "ver", "text = 'a b c d' AS asks")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sets = jaccard_join._sets(docs, spark.createDataFrame(wanted.collect(), wanted.schema), 2)
        plan = sets._jdf.queryExecution().executedPlan().toString()
        got = sorted((r["asks"], len(r["tokens"])) for r in sets.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # the bitmap, the wanted rows, and the texts once
    assert len(re.findall(r"(?<!Broadcast)Exchange hashpartitioning", plan)) == 3, plan
    assert got == [(False, 16), (False, 16), (True, 24)]
