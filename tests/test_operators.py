"""Brute-force checks, skewed inputs, edge cases and argument errors on small fixtures."""

import itertools
import random

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from cohortforge.functions import codes
from cohortforge.functions.exprs import as_col
from cohortforge.operators import (
    clean, encode, explain, features, folds, joins, learners, metrics, neighbors, ordered, profile, reduce, resample, rules,
)
from cohortforge.sources import tables


def skewed(spark, n=5000, seed=1):
    """A third of the rows share one value."""
    rng = random.Random(seed)
    rows = [(i, "hot" if i % 3 == 0 else f"k{i % 7}", 0.5 if i % 3 == 0 else round(rng.lognormvariate(0, 2), 4), int(rng.random() < 0.2)) for i in range(n)]
    return rows, spark.createDataFrame(rows, "id long, k string, x double, y int").repartition(6)


def test_exact_quantiles_with_hot_value(spark):
    rows, df = skewed(spark)
    probs = [0, 0.05, 0.25, 1 / 3, 0.5, 0.75, 0.99, 1]
    got = ordered.exact_quantiles(df, ["x"], probs).first()
    for i, p in enumerate(probs):
        assert got[f"q{i}"] == pytest.approx(np.quantile([r[2] for r in rows], p), abs=1e-12)
    by = {r["k"]: r for r in ordered.exact_quantiles(df, ["x"], [0.3], by=["k"]).collect()}
    assert by["k4"]["q0"] == pytest.approx(np.quantile([r[2] for r in rows if r[1] == "k4"], 0.3))


def test_running_totals_match_a_sort(spark):
    rows, df = skewed(spark)
    per = df.groupBy("k", "x").agg(F.count(F.lit(1)).alias("n"))
    got = {(r["k"], r["x"]): (r["cum_n"], r["total_n"], r["next_n"]) for r in ordered.running_totals(per, ["k"], "x", ["n"], True, True).collect()}
    for k, part in itertools.groupby(sorted(rows, key=lambda r: r[1]), key=lambda r: r[1]):
        xs = [r[2] for r in part]
        levels = sorted(set(xs), reverse=True)
        for i, x in enumerate(levels):
            nxt = xs.count(levels[i + 1]) if i + 1 < len(levels) else None
            assert got[(k, x)] == (sum(v >= x for v in xs), len(xs), nxt)


def test_hash_rank_is_a_full_ranking_and_ignores_partitioning(spark):
    rows, df = skewed(spark)
    a = {r["id"]: (r["k"], r["r"]) for r in ordered.hash_rank(df, ["k"], ["id"], 7, "r").collect()}
    b = {r["id"]: (r["k"], r["r"]) for r in ordered.hash_rank(df.repartition(2), ["k"], ["id"], 7, "r").collect()}
    assert a == b
    for k in {r[1] for r in rows}:
        assert sorted(r for kk, r in a.values() if kk == k) == list(range(1, sum(r[1] == k for r in rows) + 1))


def test_modes_and_group_mode_ties(spark):
    df = spark.createDataFrame([("g", "b"), ("g", "a"), ("g", None), ("h", None), (None, "z"), (None, None)], "g string, v string")
    out = [tuple(r) for r in clean.impute_group_mode(df, "v", "g").collect()]
    assert sorted(out, key=str) == sorted([("g", "b"), ("g", "a"), ("g", "a"), ("h", None), (None, "z"), (None, "z")], key=str)


def brute_knn(points, k, exclude):
    out = {}
    for i, p in points:
        d = sorted((float(np.sqrt(((np.array(p) - np.array(q)) ** 2).sum())), j) for j, q in points if not (exclude and i == j))
        out[i] = [j for _, j in d[:k]]
    return out


@pytest.mark.parametrize("block", [40, 8192])
def test_knn_join_exact_with_dense_copies(spark, block):
    rng = np.random.default_rng(3)
    pts = [(i, [0.0, 0.0, 0.0] if i % 3 == 0 else [float(x) for x in rng.normal(size=3) * (1 + i % 5)]) for i in range(400)]
    df = spark.createDataFrame(pts, "id long, vector array<double>").repartition(5)
    got = neighbors.knn_join(df, df, 4, exclude_self=True, block_rows=block)
    by = {}
    for r in got.orderBy("query_id", "rank").collect():
        by.setdefault(r["query_id"], []).append(r["neighbor_id"])
    assert by == brute_knn(pts, 4, True)


def test_knn_vote(spark):
    near = spark.createDataFrame([(1, 10, 0.0, 1), (1, 11, 1.0, 2), (1, 12, 2.0, 3), (2, 11, 1.0, 1), (2, 12, 1.0, 2)], "query_id long, neighbor_id long, distance double, rank int")
    lab = spark.createDataFrame([(10, 1), (11, 0), (12, 0)], "id long, label int")
    uni = {r["query_id"]: r for r in neighbors.knn_classify(near, lab).collect()}
    assert uni[1]["y_pred"] == 0 and uni[1]["y_prob"] == pytest.approx(1 / 3) and uni[2]["y_pred"] == 0
    assert {r["query_id"]: r["y_pred"] for r in neighbors.knn_classify(near, lab, weights="distance").collect()}[1] == 1
    with pytest.raises(ValueError):
        neighbors.knn_classify(near, lab, weights="x")


def test_smote_segments_and_parity(spark):
    rng = np.random.default_rng(0)
    rows = [(i, int(i < 30), [float(x) for x in rng.normal(size=2)]) for i in range(130)]
    df = spark.createDataFrame(rows, "id long, label int, vector array<double>")
    made = resample.smote(df, "label").collect()
    assert len(made) == 70 and {r["label"] for r in made} == {1}
    at = {r[0]: np.array(r[2]) for r in rows}
    for r in made:
        assert r["base_id"] < 30 and r["neighbor_id"] < 30 and r["base_id"] != r["neighbor_id"]
        assert np.allclose(np.array(r["vector"]), at[r["base_id"]] + r["u"] * (at[r["neighbor_id"]] - at[r["base_id"]]))
    assert {r["label"]: r["count"] for r in resample.oversample(df, "label").groupBy("label").count().collect()} == {0: 100, 1: 100}
    with pytest.raises(ValueError):
        resample.smote(df.where("id = 0 or id >= 30"), "label")
    assert resample.smote(df.where("id < 30"), "label").count() == 0


def test_folds(spark):
    rows, df = skewed(spark)
    split = folds.stratified_split(df, "y", ["id"]).groupBy("y", "is_test").count().collect()
    n = {y: sum(r[3] == y for r in rows) for y in (0, 1)}
    assert {(r["y"], r["is_test"]): r["count"] for r in split if r["is_test"]} == {(y, 1): round(0.2 * n[y]) for y in n}
    k = {(r["y"], r["fold"]): r["count"] for r in folds.stratified_kfold(df, "y", ["id"], 10).groupBy("y", "fold").count().collect()}
    for y in n:
        sizes = [k[(y, f)] for f in range(10)]
        assert max(sizes) - min(sizes) <= 1 and sum(sizes) == n[y]
    grouped = folds.stratified_group_kfold(df.withColumn("g", F.col("id") % 200), "y", "g", 5)
    assert grouped.groupBy("g").agg(F.count_distinct("fold").alias("n")).where("n > 1").count() == 0
    assert grouped.count() == len(rows)
    rates = [r[0] for r in grouped.groupBy("fold").agg(F.avg("y")).select("avg(y)").collect()]
    assert len(rates) == 5 and max(rates) - min(rates) < 0.05


def test_nested_folds_never_leak(spark):
    _, df = skewed(spark, 600)
    rows = folds.nested_folds(df, "y", ["id"], 3, 2)
    for o in range(3):
        held = rows.where(F.col("outer_fold") == o)
        assert held.where(F.col("inner_fold")[o].isNotNull()).count() == 0
        counts = [r["count"] for r in rows.where(F.col("outer_fold") != o).groupBy(F.col("inner_fold")[o]).count().collect()]
        assert len(counts) == 2 and max(counts) - min(counts) <= 4


def encounter_rows(spark):
    rows = [
        (1, 100, "1", "250.83", ">7", 3, "[0-10)"), (2, 100, "11", "428", "None", 0, "[90-100)"), (3, 100, " 13 ", "V57", ">8", 4, "x"),
        (4, 200, "7", "E909", "Norm", 2, "[50-60)"), (5, 200, "30", "459.5", None, 1, None), (6, 200, None, "786", "None", 1, "[10-20)"),
        (7, 300, "19.0", "NA", "None", 1, "[10-20)"), (8, 400, "abc", None, "None", 1, "[10-20)"), (9, 500, "1", "?", "None", 1, "[10-20)"),
        (10, 600, "1", "abc", "None", 1, "[10-20)"), (11, 700, "1", " 785.9 ", "None", 1, "[10-20)"), (12, 800, "1", "1e3", "None", 1, "[10-20)"),
    ]
    return spark.createDataFrame(rows, "encounter_id long, patient_nbr long, code string, diag string, a1c string, days int, age string")


def test_code_rules(spark):
    got = {r["encounter_id"]: r for r in encounter_rows(spark).select(
        "encounter_id", codes.icd9_group(F.col("diag")).alias("g"), codes.normalise_code(F.col("code")).alias("c"), codes.age_ordinal(F.col("age")).alias("a")
    ).collect()}
    assert [got[i]["g"] for i in range(1, 13)] == [
        "Diabetes", "Circulatory", "Other", "Other", "Other", "Respiratory", "Other", "Other", "Other", "Other", "Circulatory", "Other",
    ]
    assert [got[i]["c"] for i in (1, 3, 7, 8, 6)] == ["1", "13", "19", "abc", None]
    assert [got[i]["a"] for i in (1, 2, 3, 5)] == [1, 10, 0, 0]


def test_terminal_and_first_event(spark):
    df = encounter_rows(spark)
    kept = [r["encounter_id"] for r in clean.filter_terminal(df, "code").orderBy("encounter_id").collect()]
    assert kept == [1, 4, 5, 6, 7, 8, 9, 10, 11, 12]  # null code stays, '19.0' is not '19'
    assert clean.filter_terminal(df, "missing") is df
    first = clean.first_event_per_entity(df.orderBy(F.desc("encounter_id")))
    assert sorted(r["encounter_id"] for r in first.collect()) == [1, 4, 7, 8, 9, 10, 11, 12]
    text = spark.createDataFrame([("p", "10"), ("p", "9"), ("p", "x")], "patient_nbr string, encounter_id string")
    assert clean.first_event_per_entity(text).first()["encounter_id"] == "9"
    assert clean.first_event_per_entity(df, "nobody") is df


def test_rates_and_fills(spark):
    df = spark.createDataFrame([(10, 0), (10, 4), (None, 2), (3, None)], "a int, d int")
    assert [r[0] for r in df.select(features.rate_per_day("a", "d")).collect()] == [0.0, 2.5, 0.0, 0.0]
    with pytest.raises(ValueError):
        clean.fit_impute(df, "max")
    assert clean.fit_impute(df)["a"] == 10.0


def test_scaling_edges(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, c double")
    z = features.scale_features(df, ["a", "c"]).orderBy("a").collect()
    assert [tuple(r) for r in z] == [(-1.0, 0.0), (1.0, 0.0)]
    assert [tuple(r) for r in features.scale_features(df, ["a", "c"], "minmax").orderBy("a").collect()] == [(0.0, 0.0), (1.0, 0.0)]
    with pytest.raises(ValueError):
        features.fit_scaler(df, ["a"], "robust")
    with pytest.raises(ValueError):
        features.fit_rules(df, "knn", {"a": {"knn": "cube"}})
    assert features.fit_rules(df, "unknown_model", {"a": {"knn": "log1p"}})["a"]["transform"] == "none"
    assert features.fit_rules(df, "knn", {"absent": {"knn": "log1p"}}) == {}


def test_quantile_bin_drops_duplicate_edges(spark):
    df = spark.createDataFrame([(x,) for x in [0.0] * 6 + [1.0, 2.0, 3.0, 4.0]], "x double")
    out = [r["x_bin"] for r in features.quantile_bin(df, "x", 4).orderBy("x").collect()]
    assert out[:6] == [0] * 6 and max(out) == 1
    with pytest.raises(ValueError):
        features.quantile_bin(df, "x", 4, ["a", "b", "c", "d"])


def test_one_hot_null_rows_and_levels(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "b")], "id int, c string")
    out = encode.one_hot(df, ["c"], drop_first=False, levels={"c": ["a", "b", "gone"]}).orderBy("id").collect()
    assert [tuple(r) for r in out] == [(1, 1, 0, 0), (2, 0, 0, 0), (3, 0, 1, 0)]


def test_label_map_over_ranges_matches_window(spark):
    df = spark.createDataFrame([(f"v{i % 97:03d}",) for i in range(500)], "value string").distinct()
    got = {r["value"]: r["code"] for r in encode._number_ranges(df).collect()}
    assert got == {f"v{i:03d}": i for i in range(97)}


def test_code_file(spark, tmp_path):
    path = tmp_path / "codes.csv"
    path.write_text('a_id,description\n1,One\n3, Three\n2,NULL\n,\nb_id,description\n7,"Gone, far"\n,\nc_id,description\n1,x\n1,y\n')
    got = {(r["table_name"], r["code"], r["description"]) for r in tables.read_code_tables(spark, str(path)).collect()}
    assert got == {("a_id", "1", "One"), ("a_id", "3", "Three"), ("a_id", "2", None), ("b_id", "7", "Gone, far"), ("c_id", "1", "x"), ("c_id", "1", "y")}
    df = spark.createDataFrame([(" 3.0", 7, "1"), ("9", None, "q")], "a_id string, b_id int, c_id string")
    codes_ = tables.read_code_tables(spark, str(path))
    out = joins.decode_from_code_file(df, codes_, {"a_id": "a", "b_id": "b", "c_id": "c"}).select("a", "b", "c").collect()
    assert {tuple(r) for r in out} == {("Three", "Gone, far", "y"), ("Unknown", "Unknown", "Unknown")}
    with pytest.raises(ValueError):
        joins.decode_from_code_file(df, codes_.where("table_name = 'a_id'"), {"a_id": "a", "b_id": "b"})


def test_load_table_lists_tried_paths(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a,b\n1,?\n")
    df = tables.sentinel_to_null(tables.load_table(spark, "t.csv", [str(tmp_path)]))
    assert [tuple(r) for r in df.collect()] == [("1", None)]
    with pytest.raises(FileNotFoundError, match="nope.csv.*elsewhere/nope.csv"):
        tables.load_table(spark, "nope.csv", ["elsewhere"])


def test_rules_from_brute_force(spark):
    rng = random.Random(5)
    baskets = [sorted({f"i{rng.randint(0, 4)}" for _ in range(4)}) for _ in range(200)]
    sets = rules.frequent_itemsets(spark.createDataFrame([(b,) for b in baskets], "items array<string>"), min_support=0.1)
    got = {tuple(r["items"]): r["freq"] for r in sets.collect()}
    want = {}
    for n in range(1, 6):
        for c in itertools.combinations([f"i{i}" for i in range(5)], n):
            f = sum(set(c) <= set(b) for b in baskets)
            if f >= 20:
                want[c] = f
    assert got == want
    ruled = {(tuple(r["antecedents"]), tuple(r["consequents"])): r["lift"] for r in rules.association_rules(sets, "lift", 0.0).collect()}
    for items, f in want.items():
        for n in range(1, len(items)):
            for a in itertools.combinations(items, n):
                c = tuple(x for x in items if x not in a)
                assert ruled.pop((a, c)) == pytest.approx(f * 200 / (want[a] * want[c]))
    assert not ruled


def test_long_itemset_splits_without_one_big_array(spark):
    items = [f"x{i:02d}" for i in range(14)]
    full = [(items, 0.5)] + [([i], 0.5) for i in items] + [([j for j in items if j != i], 0.5) for i in items]
    out = rules.association_rules(spark.createDataFrame(full, "items array<string>, support double"), "confidence", 0.0)
    assert out.where("size(antecedents) + size(consequents) = 14").count() == 28


def test_topk_cuts_inside_a_tied_score(spark):
    rows = [(i, "m", int(i % 5 == 0), 0.7 if i < 900 else 0.1) for i in range(1000)]
    df = spark.createDataFrame(rows, "id long, model string, y_true int, y_prob double")
    got = {r["label"]: r for r in metrics.topk_capacity(df, ["id"]).collect()}
    ranked = [r["y_true"] for r in df.orderBy(F.desc("y_prob"), ordered.hash_order(0, "id")).collect()]
    for label, k in (("top_5pct", 50), ("top_10pct", 100), ("top_15pct", 150), ("top_20pct", 200)):
        assert got[label]["k"] == k and got[label]["precision_at_k"] == pytest.approx(sum(ranked[:k]) / k)


def test_sweep_on_grid_edges(spark):
    df = spark.createDataFrame([("m", 1, 0.05 + 0.05 * i) for i in range(19)] + [("m", 0, None)], "model string, y_true int, y_prob double")
    got = {round(r["threshold"], 2): r["tp"] for r in metrics.cost_sweep(df).collect()}
    assert [got[round(0.05 + 0.05 * i, 2)] for i in range(19)] == list(range(19, 0, -1))
    with pytest.raises(ValueError):
        metrics.tune_threshold(df, "auc")
    with pytest.raises(ValueError):
        metrics.cost_optimum(df, best="middle")


def test_calibration_edges_go_down(spark):
    df = spark.createDataFrame([("m", 1, p) for p in (0.0, 0.1, 0.2, 0.3, 1.0)], "model string, y_true int, y_prob double")
    assert {r["bin"]: r["n"] for r in metrics.calibration_curve(df).collect()} == {0: 2, 1: 1, 2: 1, 9: 1}


def test_ari(spark):
    df = spark.createDataFrame([(0, 5), (0, 5), (1, 6), (1, 6), (2, 7)], "a int, b int")
    assert profile.adjusted_rand_index(df, "a", "b").first()["ari"] == pytest.approx(1)
    assert profile.adjusted_rand_index(df.withColumn("b", F.lit(1)), "a", "b").first()["ari"] == pytest.approx(0)


def toy(spark, n=400):
    rng = np.random.default_rng(2)
    rows = []
    for i in range(n):
        a, b, c = (float(x) for x in rng.normal(size=3))
        rows.append((i, int(a + 0.5 * b + 0.3 * float(rng.normal()) > 0.8), a, b, c))
    df = encode.assemble_vector(spark.createDataFrame(rows, "id long, label int, a double, b double, c double"), ["a", "b", "c"])
    return folds.stratified_kfold(df, "label", ["id"], 3)


@pytest.mark.parametrize("name", learners.CLASSIFIERS)
def test_every_classifier_scores_out_of_fold(spark, name):
    df = toy(spark).cache()
    small = {"random_forest": {"numTrees": 5}, "gradient_boosting": {"maxIter": 3}}
    oof = learners.run_cv(df, [name], params=small)
    assert oof.count() == 400 and oof.select("id").distinct().count() == 400
    m = metrics.classification_metrics(oof).agg(F.avg("auc_roc")).first()[0]
    assert m == pytest.approx(0.5) if name == "zero_r" else m > 0.65


@pytest.mark.parametrize("reduction", [("pca", {"k": 2}), ("select_kbest", {"k": 2}), ("select_from_model", {"estimator": reduce.default_importance_estimator, "max_features": 2})])
def test_reductions_inside_folds(spark, reduction):
    kind, kw = reduction
    kw = {k: (v() if callable(v) else v) for k, v in kw.items()}
    df = toy(spark).cache()
    score = learners.fit_fold_steps("logistic_regression", df.where("fold > 0"), imbalance="class_weight+smote", reduction=(kind, kw))
    assert score(df.where("fold = 0")).where("y_prob between 0 and 1").count() == df.where("fold = 0").count()


def test_learner_errors(spark):
    df = toy(spark, 60)
    for call in (
        lambda: learners.fit_scorer("svm", df),
        lambda: learners.fit_fold_steps("one_r", df, imbalance="magic"),
        lambda: reduce.fit_reduction(df, ("tsne", {}), "features", "label", "o"),
        lambda: reduce.fit_reduction(df, ("select_from_model", {}), "features", "label", "o"),
        lambda: learners.train_regressor(df, "svr"),
        lambda: learners.imbalance_compare(df, "svm"),
        lambda: learners.calibrate(df, "one_r", method="beta"),
    ):
        with pytest.raises(ValueError):
            call()


def test_tuning_and_calibration(spark):
    df = toy(spark).cache()
    fitted, table = learners.grid_search(df, "decision_tree", {"maxDepth": [1, 3]})
    assert table.count() == 2 and fitted.bestModel is not None
    score = learners.calibrate(df, "one_r", method="isotonic")
    assert score(df).where("y_prob between 0 and 1").count() == 400
    comparison = learners.imbalance_compare(df, "decision_tree", params={"decision_tree": {"maxDepth": 2}})
    assert {r["strategy"] for r in comparison.collect()} == {"baseline", "class_weight_balanced", "smote"}


def test_pca_is_centred_and_ordered(spark):
    df = toy(spark)
    model = reduce.fit_pca(df, "features", "pcs", 3)
    ratio = [r["ratio"] for r in reduce.explained_variance(model, spark).collect()]
    assert ratio == sorted(ratio, reverse=True) and sum(ratio) == pytest.approx(1)
    means = reduce.projection_table(model, df, "pcs", ["id"]).agg(F.avg("pc1"), F.avg("pc2")).first()
    assert abs(means[0]) < 1e-9 and abs(means[1]) < 1e-9


def test_attributions_add_up(spark):
    df = toy(spark, 60)
    score = lambda d: d.withColumn("y_prob", F.col("a") * F.col("b") + F.abs("c"))
    bg = [[0.0, 0.0, 0.0], [1.0, -1.0, 2.0]]
    got = {r["id"]: r["s"] for r in explain.shapley_sampling(df, score, ["a", "b", "c"], bg, permutations=6).groupBy("id").agg(F.sum("attribution").alias("s")).collect()}
    base = np.mean([x * y + abs(z) for x, y, z in bg])
    for r in df.collect():
        assert got[r["id"]] == pytest.approx(r["a"] * r["b"] + abs(r["c"]) - base)


def test_permutation_importance_finds_the_used_feature(spark):
    df = toy(spark)
    score = lambda d: d.withColumn("y_pred", (F.col("a") > 0.5).cast("int"))
    got = {r["feature"]: r for r in explain.permutation_importance(df, score, ["a", "c"], repeats=3).collect()}
    assert got["c"]["importance_mean"] == 0 and got["c"]["importance_std"] == 0 and got["a"]["importance_mean"] > 0.1


def test_tree_rules_partition_rows(spark):
    df = toy(spark)
    model = learners.fit_scorer("decision_tree", df, maxDepth=3).model
    out = explain.tree_rules(model, df, ["a", "b", "c"]).collect()
    assert sum(r["n"] for r in out) == 400 and all("AND" in r["rule"] or "<=" in r["rule"] or ">" in r["rule"] for r in out)


def test_model_roundtrip(spark, tmp_path):
    df = toy(spark).drop("features")
    model = learners.train_classifier(df, ["a", "b", "c"], "logistic_regression")
    again = tables.load_model(tables.save_model(model, str(tmp_path / "m")))
    a, b = (m.transform(df).select("id", "prediction") for m in (model, again))
    assert a.exceptAll(b).count() == 0


def test_vector_columns(spark):
    df = spark.createDataFrame([(1, [0.0, 2.0]), (2, [2.0, 2.0])], "id int, v array<double>").withColumn("f", array_to_vector("v"))
    out = reduce.fit_standardizer(df, "f", "o").transform(df).select("o").collect()
    assert abs(out[1]["o"][0] - out[0]["o"][0]) == pytest.approx(2.0)  # population deviation 1
    assert as_col("id") is not None


def test_chi2_tail_far_from_zero():
    from cohortforge.functions.special import chi2_tail

    for x, df, p in ((2000, 2000, 0.4957948), (2001, 2001, 0.4957958), (3.841459, 1, 0.05), (5.991465, 2, 0.05), (7.814728, 3, 0.05), (1e6, 10, 0.0), (0.0, 5, 1.0)):
        assert chi2_tail(x, df) == pytest.approx(p, abs=1e-6)


def test_mode_ties_of_numbers_go_by_size(spark):
    df = spark.createDataFrame([(9, 1.5), (10, 1.5), (None, float("nan")), (9, None), (10, -2.0), (None, -2.0)], "a long, b double")
    out = clean.impute_mode(df, ["a", "b"]).collect()
    assert [r["a"] for r in out] == [9, 10, 9, 9, 10, 9] and [r["b"] for r in out] == [1.5, 1.5, -2.0, -2.0, -2.0, -2.0]


def test_nan_is_missing(spark):
    df = spark.createDataFrame([(1.0,), (3.0,), (float("nan"),), (None,)], "x double")
    assert profile.missing_profile(df).collect()[0]["n_missing"] == 2
    for strategy in ("median", "mean"):
        fills = clean.fit_impute(df, strategy)
        assert fills == {"x": 2.0} and [r["x"] for r in clean.apply_fill(df, fills).collect()] == [1.0, 3.0, 2.0, 2.0]
    assert clean.leakage_check(df, [], []).first()["total_missing"] == 2


def test_typed_csv_keeps_numbers(spark, tmp_path):
    from cohortforge.plans.cohort import run_preprocess

    (tmp_path / "raw.csv").write_text("k,x,name\n" + "".join(f"{i},{i % 7},n{i}\n" for i in range(20)) + "20,,\n21,900,far\n")
    for how in ({"schema": "k long, x double, name string"}, {"reader": {"inferSchema": "true"}}):
        out = run_preprocess(spark, str(tmp_path / "raw.csv"), str(tmp_path / f"out{len(how)}{list(how)[0]}"), outlier_columns=["x"], ids=(), **how)
        rows = {int(r["k"]): r for r in out.collect()}
        assert 21 not in rows and rows[20]["x"] == 3.0 and rows[20]["name"] == "Unknown"


def test_failed_fold_leaves_the_rest(spark, monkeypatch):
    rows = learners_table(spark)
    real = learners.fit_fold_steps

    def breaks(name, train, *args, **kw):
        if name == "one_r" and train.where("fold = 0").isEmpty():
            raise RuntimeError("broken")
        return real(name, train, *args, **kw)

    monkeypatch.setattr(learners, "fit_fold_steps", breaks)
    with pytest.warns(RuntimeWarning):
        oof = learners.run_cv(rows, ["one_r", "zero_r"])
    assert oof.count() == 2 * rows.count()
    metrics = {(r["model"], r["fold"], r["metric"]): r["value"] for r in learners.cv_metrics(oof).collect()}
    assert metrics["one_r", 0, "accuracy"] != metrics["one_r", 0, "accuracy"]
    assert metrics["one_r", 1, "accuracy"] > 0 and metrics["zero_r", 0, "accuracy"] > 0


def breaking(monkeypatch, lost):
    """Fits of one_r that fail where ``lost`` says so of their training side."""
    real = learners.fit_fold_steps

    def fit(name, train, *args, **kw):
        if name == "one_r" and lost(train):
            raise RuntimeError("broken")
        return real(name, train, *args, **kw)

    monkeypatch.setattr(learners, "fit_fold_steps", fit)


def test_failed_fold_ends_a_run_that_must_be_whole(spark, monkeypatch, tmp_path):
    rows, store, bad = learners_table(spark), str(tmp_path / "oof"), [0]
    breaking(monkeypatch, lambda train: train.where("fold = 0").isEmpty() and bad)
    with pytest.warns(RuntimeWarning), pytest.raises(RuntimeError, match="1 of 6 fits failed: one_r on fold 0: broken"):
        learners.run_cv(rows, ["one_r", "zero_r"], store=store, failed="raise")
    with pytest.warns(RuntimeWarning):  # the failed fold left no result: it is tried again
        assert learners.run_cv(rows, ["one_r", "zero_r"], store=store).where("y_pred is null").count() == 20
    bad.clear()
    oof = learners.run_cv(rows, ["one_r", "zero_r"], store=store, failed="raise")
    assert oof.count() == 120 and oof.where("y_pred is null or y_prob is null").isEmpty()
    with pytest.raises(RuntimeError, match="one class only"):
        learners.run_cv(rows.withColumn("label", F.lit(1)), ["one_r"], failed="raise")
    with pytest.raises(ValueError):
        learners.run_cv(rows, ["one_r"], failed="maybe")


def test_comparison_of_strategies_needs_every_fold(spark, monkeypatch):
    breaking(monkeypatch, lambda train: train.where("fold = 1").isEmpty())
    with pytest.warns(RuntimeWarning), pytest.raises(RuntimeError, match="one_r on fold 1"):
        learners.imbalance_compare(learners_table(spark), "one_r")


@pytest.mark.parametrize("key", ["knn_out_of_fold", "imbalance_compare", "run_cv", "cross_validate", "run_cv_baseline", "cross_validate_baseline"])
def test_queries_do_not_return_failed_fits(spark, data, monkeypatch, key):
    def fails(*args, **kw):
        raise RuntimeError("broken")

    monkeypatch.setattr(learners, "fit_fold_steps", fails)
    with pytest.warns(RuntimeWarning), pytest.raises(RuntimeError, match="fits failed"):
        __import__("__spark_entry__").queries()[key](spark, data)


def learners_table(spark):
    from pyspark.ml.feature import VectorAssembler

    rows = spark.createDataFrame([(i, float(i % 4), float(i % 3), int(i % 4 > 1), i % 3) for i in range(60)], "id long, a double, b double, label int, fold int")
    return VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(rows)


def test_cut_rules_predict_their_majority(spark):
    debug = "\n".join(["Tree", "  If (feature 0 <= 1234567.25)", "   If (feature 1 <= 0.5)", "    Predict: 1.0", "   Else (feature 1 > 0.5)", "    Predict: 0.0", "  Else (feature 0 > 1234567.25)", "   Predict: 1.0"])
    paths = explain.tree_paths(debug, ["a", "b"], 1)
    assert [(p[1], p[2]) for p in paths] == [("a <= 1234567.25 AND ...", None), ("a > 1234567.25", 1.0)]
    tree = type("Tree", (), {"toDebugString": debug})()
    df = spark.createDataFrame([(1.0, 0.0, 1), (1.0, 1.0, 0), (1.0, 1.0, 0), (2e6, 0.0, 1)], "a double, b double, label int")
    got = {r["rule"]: (r["prediction"], r["n"]) for r in explain.tree_rules(tree, df, ["a", "b"], max_depth=1).collect()}
    assert got == {"a <= 1234567.25 AND ...": (0.0, 3), "a > 1234567.25": (1.0, 1)}
