"""Cleaning, profiling, sampling, text, basket, feature and storage operators on edge inputs."""

import math
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.functions import scalar as S
from tallyloom.functions import text as X
from tallyloom.operators import basket as B
from tallyloom.operators import classify as K
from tallyloom.operators import clean, evaluate, features, impute, joins, profile, reshape, sampling
from tallyloom.operators import text as O
from tallyloom.runtime import global_row_number, hot_split_join
from tallyloom.sources import io
from tallyloom.sources.schemas import SALES, schema


# --- scalars and cleaning ---

def test_lenient_cast_and_truth(spark):
    df = spark.createDataFrame([("12", "true"), ("1,234", "false"), (None, "maybe"), ("", None)], "v string, t string")
    rows = df.select(S.lenient("v", "int", 0).alias("v"), S.truth_code("t").alias("t"), S.truth_unknown("t").alias("u")).collect()
    assert [tuple(r) for r in rows] == [(12, 1, 0), (0, 0, 0), (0, None, 1), (0, None, 1)]


def test_money_pad_ratio_epoch(spark):
    df = spark.createDataFrame([("$12.50", 7, 0.0, 86399), ("x", 12345, 2.0, -1)], "p string, i int, d double, e long")
    rows = df.select(S.money("p"), S.pad_left("i", 3), S.ratio(F.lit(1.0), "d"), S.epoch_date("e").cast("string")).collect()
    assert [tuple(r) for r in rows] == [(12.5, "007", None, "1970-01-01"), (None, "12345", 0.5, "1969-12-31")]


def test_drop_list_warns_on_unknown_names(spark):
    with pytest.warns(UserWarning):
        assert clean.drop_list(spark.range(1).withColumn("a", F.lit(1)), ["a", "zz"]).columns == ["id"]


def test_first_per_key_is_the_same_under_any_partitioning(spark):
    df = spark.range(300).select((F.col("id") % 7).alias("k"), (F.col("id") * 37 % 101).alias("o"), "id")
    want = None
    for n in (1, 4, 16):
        got = sorted(map(tuple, clean.first_per_key(df.repartition(n), ["k"], ["o"]).collect()))
        want = want or got
        assert got == want and len(got) == 7


def test_audit_and_key_audit_of_empty(spark):
    empty = spark.createDataFrame([], "k long")
    assert tuple(clean.dedup_audit(empty, ["k"]).first()) == (0, 0, 0)
    assert tuple(joins.key_audit(empty, spark.range(3).toDF("k"), ["k"]).first()) == (0, 3, 0, 0, 0, 0)


def test_union_and_transpose(spark):
    a, b = spark.range(2).toDF("x"), spark.range(1).select(F.lit("t").alias("tag"))
    assert reshape.union_by_name(a, b).columns == ["x", "tag"]
    tidy = spark.createDataFrame([("c", "min", 1.0), ("c", "max", 3.0)], "column string, stat string, value double")
    assert tuple(reshape.transpose_summary(tidy, stats=["min", "max"]).first()) == ("c", 1.0, 3.0)


# --- order, profile ---

def test_row_numbers_with_a_dominant_key(spark):
    df = spark.range(400).select(F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id")).alias("k"), "id").repartition(7)
    rows = global_row_number(df, ["k", "id"]).orderBy("row_no").collect()
    assert [r["row_no"] for r in rows] == list(range(1, 401))
    assert [(r["k"], r["id"]) for r in rows] == sorted((r["k"], r["id"]) for r in rows)


def test_hot_split_join_keeps_every_row(spark):
    facts = spark.range(1000).select(F.when(F.col("id") < 600, 0).otherwise(F.col("id")).alias("k"), "id")
    keyed = facts.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("m"))
    got = hot_split_join(facts, keyed, ["k"], "n", share=0.01, hot_rows=0)
    assert got.count() == 1000 and got.filter("k = 0 AND m <> 599").count() == 0


def test_describe_against_numpy(spark):
    rng = np.random.default_rng(0)
    x = np.r_[np.repeat(2.5, 100), rng.normal(size=200).round(3)]
    df = spark.createDataFrame([(float(v),) for v in x], "x double").repartition(5)
    got = {r["stat"]: r["value"] for r in profile.describe(df, ["x"], probs=(0.0, 0.1, 0.5, 0.9, 1.0), shape=True).collect()}
    for p in (0.0, 0.1, 0.5, 0.9, 1.0):
        assert math.isclose(got[profile.quantile_name(p)], np.quantile(x, p), abs_tol=1e-12)
    assert math.isclose(got["std"], x.std(ddof=1), rel_tol=1e-12)
    z = (x - x.mean()) / x.std()
    assert math.isclose(got["skewness"], (z ** 3).mean(), rel_tol=1e-9) and math.isclose(got["kurtosis"], (z ** 4).mean() - 3, rel_tol=1e-9)
    assert got["mode"] == 2.5 and got["distinct"] == len(set(x))


def test_describe_of_null_and_constant_columns(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 1.0)], "a double, b double")
    got = {(r["column"], r["stat"]): r["value"] for r in profile.describe(df, ["a", "b"], shape=True).collect()}
    assert got[("b", "std")] == 0.0 and got[("b", "skewness")] is None and ("a", "mean") not in got
    assert profile.null_patterns(df, ["a", "b"]).collect()[0]["pattern"] == "10"


def test_spearman_with_ties(spark):
    a, b = [1.0, 2.0, 2.0, 3.0, 9.0], [5.0, 1.0, 1.0, 0.0, 2.0]
    rank = lambda v: np.array([sum(x < y for x in v) + (v.count(y) + 1) / 2 for y in v])
    got = profile.spearman_pairs(spark.createDataFrame(list(zip(a, b)), "a double, b double"), ["a", "b"]).first()["r"]
    assert math.isclose(got, np.corrcoef(rank(a), rank(b))[0, 1], rel_tol=1e-12)


def test_prune_correlated(spark):
    df = spark.range(50).select(F.col("id").cast("double").alias("a"), (F.col("id") * 2.0).alias("b"), (F.col("id") % 7).cast("double").alias("c"))
    kept, gone = clean.prune_correlated(df, profile.pearson_pairs(df, df.columns), 0.95)
    assert gone == ["b"] and kept.columns == ["a", "c"]


# --- samples ---

def test_samples_do_not_depend_on_partitions(spark):
    df = spark.range(500)
    ids = lambda d: sorted(r["id"] for r in d.collect())
    a = ids(sampling.hash_sample(df.repartition(1), "id", 0.3, "s"))
    assert a == ids(sampling.hash_sample(df.repartition(16), "id", 0.3, "s")) and 100 < len(a) < 200
    split = sampling.hash_split(df, "id", {"a": 3, "b": 1}, "s").groupBy("split").count().collect()
    assert sum(r["count"] for r in split) == 500


def test_stratified_split_and_upsample(spark):
    df = spark.range(100).select("id", F.when(F.col("id") < 83, "big").otherwise("small").alias("y"))
    parts = {(r["y"], r["split"]): r["count"] for r in sampling.stratified_split(df, "y", "id", 0.7).groupBy("y", "split").count().collect()}
    assert parts[("big", "train")] == math.ceil(0.7 * 83) and parts[("small", "train")] == math.ceil(0.7 * 17)
    up = sampling.upsample_to_parity(df, "y", "id")
    assert {r["y"]: r["count"] for r in up.groupBy("y").count().collect()} == {"big": 83, "small": 83}
    assert up.filter("copy = 0").count() == 100
    assert up.select("id", "copy").distinct().count() == 166


def test_positions(spark):
    rows = sampling.take_positions(spark.range(20).repartition(3), ["id"], 5, 7).collect()
    assert sorted(r["id"] for r in rows) == [4, 5, 6]


# --- text ---

def texts(spark, *values):
    return spark.createDataFrame(list(enumerate(values)), "id long, text string")


def test_tokens_on_edges(spark):
    df = texts(spark, "", "   ", "(well) re-read it!!", "?!", "Ünï a(b)c", None)
    got = [r[0] for r in df.orderBy("id").select(X.tokens("text")).collect()]
    assert got == [[], [], ["(", "well", ")", "re", "read", "it", "!!"], ["?!"], ["Ünï", "a(b", ")", "c"], None] or got[4] in (["Ünï", "a(b)c"],)


def test_ngrams_of_short_arrays(spark):
    df = spark.createDataFrame([([],), (["a"],), (["a", "b", "c"],)], "t array<string>")
    assert [r[0] for r in df.select(X.ngrams("t")).collect()] == [[], ["a"], ["a", "b", "c", "a_b", "b_c"]]


def test_phrases_are_leftmost_longest(spark):
    df = texts(spark, "The good nice game book was a great story-time, but quite odd")
    rows = O.phrase_rows(df, ["id"], "text").collect()
    got = {(r["grammar"], r["phrase"], r["span"]) for r in rows}
    assert ("JN", "good nice game", "good nice game") in got and ("NN", "game book", "game book") in got
    assert ("JN", "great story", "great story") in got and ("NN", "story time", "story time,") in got


def test_sentiment_negation_and_missing_words(spark):
    df = texts(spark, "a good day", "not good", "very good", "nothing here", "")
    got = {r["id"]: (r["polarity"], r["hits"]) for r in O.sentiment(df, "id", "text", O.sentiment_lexicon(spark)).collect()}
    assert got == {0: (0.7, 1), 1: (-0.35, 1), 2: (pytest.approx(0.91), 1), 3: (0.0, 0), 4: (0.0, 0)}


def test_large_lexicon_path_gives_the_same_scores(spark, monkeypatch):
    df = texts(spark, *["good bad very good not bad fine"] * 5, "worst")
    rows = lambda: sorted(map(tuple, O.sentiment(df, "id", "text", O.sentiment_lexicon(spark)).collect()))
    small = rows()
    monkeypatch.setattr(O, "BROADCAST_ROWS", 3)
    assert rows() == small


def test_readability_of_a_known_sentence(spark):
    row = X.readability(texts(spark, "The cat sat on the mat."), "text").first()
    assert row["n_words"] == 6 and row["n_sentences"] == 1 and row["n_syllables"] == 6
    assert math.isclose(row["flesch_ease"], 206.835 - 1.015 * 6 - 84.6, rel_tol=1e-12)
    assert row["smog"] == 0.0
    assert X.readability(texts(spark, ""), "text").first()["fog"] is None


def test_ml_idf_agrees_with_the_tidy_form(spark):
    docs = spark.createDataFrame([(i, ["a"] * (i % 3 + 1) + ["b"] * (i % 2) + [f"r{i}"]) for i in range(12)], "id long, tk array<string>")
    tidy = {r["term"]: r["weight"] / r["tf"] for r in O.tfidf(docs, "id", "tk", 2).collect()}
    model = K.vocabulary_pipeline("tk", min_df=2).fit(docs)
    for term, idf in zip(model.stages[0].vocabulary, model.stages[1].idf.toArray()):
        assert math.isclose(tidy[term], idf, abs_tol=1e-12)


# --- baskets ---

@pytest.fixture(scope="module")
def orders(spark):
    rng = np.random.default_rng(2)
    rows = [(o, f"i{i}") for o in range(80) for i in rng.choice(6, size=rng.integers(1, 5), replace=True)]
    return rows, spark.createDataFrame(rows, "o long, i string")


def brute_rules(rows, s, c):
    sets = {}
    for o, i in rows:
        sets.setdefault(o, set()).add(i)
    n, items = len(sets), sorted({i for _, i in rows})
    freq = {a: sum(set(a) <= b for b in sets.values()) for k in range(1, 7) for a in combinations(items, k)}
    out = {((), i): freq[(i,)] / n for i in items if freq[(i,)] / n >= max(s, c)}
    for a, f in freq.items():
        if len(a) > 1 and f >= math.ceil(s * n):
            for x in a:
                left = tuple(y for y in a if y != x)
                if f / freq[left] >= c:
                    out[(left, x)] = f / freq[left]
    return out


def test_rules_and_redundancy_against_brute_force(orders):
    rows, df = orders
    rules = B.association_rules(df, "o", "i", 0.03, 0.2)
    got = {(tuple(r["antecedent"]), r["consequent"]): r["confidence"] for r in rules.collect()}
    want = brute_rules(rows, 0.03, 0.2)
    assert got.keys() == want.keys() and all(math.isclose(got[k], want[k]) for k in got)
    share = {i: sum(1 for o in {o for o, j in rows if j == i}) / 80 for _, i in rows}
    keep = {(a, c) for (a, c), conf in want.items() if not (a and share[c] >= conf - 1e-12) and not any(
        c2 == c and a2 and set(a2) < set(a) and conf2 >= conf for (a2, c2), conf2 in want.items())}
    assert {(tuple(r["antecedent"]), r["consequent"]) for r in B.nonredundant(rules).collect()} == keep


def test_grouped_rules_equal_one_run_per_group(spark, orders):
    rows, _ = orders
    both = spark.createDataFrame([("g1" if o < 60 else "g2", o, i) for o, i in rows], "g string, o long, i string")
    got = {(r["g"], tuple(r["antecedent"]), r["consequent"]): (round(r["support"], 9), round(r["lift"], 9)) for r in
           B.grouped_rules(both, "g", "o", "i", 0.05, 0.2).collect()}
    want = {}
    for g in ("g1", "g2"):
        for r in B.association_rules(both.filter(F.col("g") == g), "o", "i", 0.05, 0.2, min_len=2).collect():
            want[(g, tuple(r["antecedent"]), r["consequent"])] = (round(r["support"], 9), round(r["lift"], 9))
    assert got == want


# --- features ---

def test_yeo_johnson_maximises_the_likelihood(spark):
    rng = np.random.default_rng(1)
    x = np.exp(rng.normal(size=500)) - 0.5
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    lam = features.fit_yeo_johnson(df, ["x"])["x"]

    def ll(l):
        up = np.where(x >= 0, ((np.abs(x) + 1) ** l - 1) / l, -((1 + np.abs(x)) ** (2 - l) - 1) / (2 - l))
        return -len(x) / 2 * np.log(up.var()) + (l - 1) * np.sum(np.sign(x) * np.log1p(np.abs(x)))
    grid = np.linspace(-2, 2, 40002)[1:-1]
    assert abs(lam - grid[np.argmax([ll(g) for g in grid])]) < 1e-3
    back = features.invert_yeo_johnson(features.apply_yeo_johnson(df.select("x", F.col("x").alias("z")), {"z": lam}), {"z": lam})
    assert back.filter("abs(x - z) > 1e-9").count() == 0


def test_yeo_johnson_special_exponents(spark):
    df = spark.createDataFrame([(3.0,), (-3.0,)], "x double")
    for lam, want in ((0.0, [math.log(4), -((4 ** 2) - 1) / 2]), (2.0, [(16 - 1) / 2, -math.log(4)])):
        got = [r[0] for r in features.apply_yeo_johnson(df, {"x": lam}).collect()]
        assert np.allclose(got, want)


def test_scaling_constant_column(spark):
    df = spark.createDataFrame([(2.0,), (2.0,)], "x double")
    assert [r[0] for r in features.standardise(df, ["x"]).collect()] == [0.0, 0.0]


def test_chained_equations_use_observed_values(spark):
    rng = np.random.default_rng(3)
    a = rng.normal(size=80)
    b = 2 * a + 0.01 * rng.normal(size=80)
    df = spark.createDataFrame([(i, float(a[i]), None if i % 5 == 0 else float(b[i])) for i in range(80)], "id long, a double, b double")
    done = impute.chained_equations(df, "id", ["a", "b"], m=2, iterations=2)
    rows = done.toPandas()
    assert len(rows) == 160 and rows["b"].notna().all()
    seen = {float(v) for i, v in enumerate(b) if i % 5}
    assert set(rows["b"]) <= seen
    filled = rows[rows["id"] % 5 == 0]
    assert np.abs(filled["b"] - 2 * filled["a"]).max() < 1.0
    again = impute.chained_equations(df.repartition(6), "id", ["a", "b"], m=2, iterations=2).toPandas()
    assert rows.sort_values(["imputation", "id"])["b"].tolist() == again.sort_values(["imputation", "id"])["b"].tolist()


# --- evaluation, boosting ---

def test_auc_equals_trapezoid_and_handles_ties_and_one_class(spark):
    rng = np.random.default_rng(4)
    score, y = rng.integers(0, 20, 200) / 20, rng.integers(0, 2, 200)
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, score)], "y int, s double")
    auc = evaluate.auc_rank(df, "y", "s").first()["auc"]
    pts = [(0.0, 0.0)] + [(r["fpr"], r["tpr"]) for r in evaluate.roc_points(df, "y", "s").orderBy(F.desc("threshold")).collect()]
    area = sum((x2 - x1) * (y1 + y2) / 2 for (x1, y1), (x2, y2) in zip(pts, pts[1:]))
    assert math.isclose(auc, area, rel_tol=1e-12) and pts[-1] == (1.0, 1.0)
    assert evaluate.auc_rank(df.filter("y = 1"), "y", "s").first()["auc"] is None


def test_adaboost_learns_an_interval(spark):
    df = spark.range(200).select((F.col("id") / 10.0).alias("x"), F.when(F.col("id").between(60, 140), 1.0).otherwise(0.0).alias("label"))
    data = features.as_vector(df, ["x"])
    model = K.AdaBoost(rounds=12).fit(data)
    acc = evaluate.accuracy(model.transform(data), "label", "prediction").first()[0]
    assert acc > 0.95 and len(model.stumps) > 1


def plain_boost(x, y, rounds, bins=64):
    """The same boosting row by row: weights are multiplied after every round."""
    sign = np.where(y > 0, 1.0, -1.0)
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1], method="lower")) for c in x.T]
    w, stumps = np.full(len(sign), 1.0 / len(sign)), []
    for _ in range(rounds):
        best = (0.5, None)
        for j, cut in enumerate(cuts):
            edges = [(w * sign * np.where(x[:, j] > c, 1.0, -1.0)).sum() / 2 for c in cut]
            for at in (int(np.argmax(edges)), int(np.argmin(edges))):
                if 0.5 - abs(edges[at]) < best[0] - 1e-12:
                    best = (0.5 - abs(edges[at]), (j, float(cut[at]), 1.0 if edges[at] > 0 else -1.0))
        err, stump = best
        if stump is None:
            break
        alpha = math.log((1 - err) / max(err, 1e-16))
        stumps.append((stump[0], stump[1], alpha * stump[2]))
        said = np.where(x[:, stump[0]] > stump[1], stump[2], -stump[2])
        w = w * np.exp(np.where(said != sign, alpha, 0.0))
        w /= w.sum()
    return stumps


@pytest.mark.parametrize("n", [40, 700])
def test_adaboost_equals_plain_boosting(spark, n):
    rng = np.random.default_rng(n)
    x = np.column_stack([rng.normal(size=n), rng.integers(0, 6, n), rng.uniform(size=n)])
    y = ((x[:, 0] + (x[:, 1] > 2) - 2 * x[:, 2] ** 2 + rng.normal(scale=0.7, size=n)) > 0).astype(float)
    df = spark.createDataFrame([(*map(float, r), float(v)) for r, v in zip(x, y)], "a double, b double, c double, label double").repartition(5)
    data = features.as_vector(df, ["a", "b", "c"])
    model = K.AdaBoost(rounds=25).fit(data)
    want = plain_boost(x, y, 25)
    assert [s[:2] for s in model.stumps] == [s[:2] for s in want] and np.allclose([s[2] for s in model.stumps], [s[2] for s in want], rtol=1e-8)
    total = sum(abs(v) for *_, v in want)
    for r in model.transform(data).collect():
        plain = sum(v if (r["a"], r["b"], r["c"])[j] > c else -v for j, c, v in want) / total
        assert abs(r["score"] - plain) < 1e-9
    assert K.AdaBoost(rounds=3).fit(data.limit(0)).stumps == []


def test_bayes_table_predicts(spark):
    df = spark.createDataFrame([(float(i % 2 * 4 + i / 50), i % 2) for i in range(60)], "x double, y int")
    out = K.bayes_predict(df, K.bayes_table(df, "y", ["x"]), "y", ["x"])
    assert evaluate.accuracy(out, "y", "prediction").first()[0] == 1.0


# --- storage ---

def test_csv_and_rules_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, 0, 3, "$5.00", 1.0, 2.0)], SALES)
    io.save_csv(df, str(tmp_path / "s.csv"))
    assert io.scan_csv(spark, str(tmp_path / "s.csv"), SALES).collect() == df.collect()
    rules = spark.createDataFrame([(["b", "a"], "c", 0.5)], "antecedent array<string>, consequent string, support double")
    io.save_rules(rules, str(tmp_path / "r.csv"))
    assert (tmp_path / "r.csv").exists()
    back = io.scan_csv(spark, str(tmp_path / "r.csv"), schema(antecedent=rules.schema["consequent"].dataType, consequent=rules.schema["consequent"].dataType))
    assert back.first()["antecedent"] == "a,b"
    io.save_rules(rules, str(tmp_path / "r.parquet"), fmt="parquet")
    assert spark.read.parquet(str(tmp_path / "r.parquet")).count() == 1


def test_sheet_without_schema_is_refused(spark, tmp_path):
    with pytest.raises(ValueError):
        io.register_sheets(spark, {"s": str(tmp_path / "x.csv")})


def test_rows_without_a_label_are_kept(spark):
    from tallyloom.operators import evaluate, sampling
    df = spark.createDataFrame([(i, 1.0 if i < 50 else None if i < 150 else 0.0, 1.0 if i % 2 else None) for i in range(160)], "id long, y double, p double")
    kept = sampling.downsample_class(df, "y", 1.0, "id", 0.5)
    assert kept.filter("y IS NULL").count() == 100 and kept.filter("y = 0").count() == 10 and kept.filter("y = 1").count() < 50
    up = sampling.upsample_to_parity(df, "y", "id")
    assert {r["y"]: r["count"] for r in up.groupBy("y").count().collect()} == {1.0: 50, 0.0: 50, None: 100}
    split = sampling.stratified_split(df, "y", "id", 0.7)
    assert split.filter("y IS NULL AND split = 'train'").count() == 70 and split.count() == 160
    assert sum(r["n"] for r in evaluate.confusion(df, "y", "p").collect()) == 160


def test_upsample_two_rows_against_many(spark):
    from tallyloom.operators import sampling
    df = spark.range(30_002).selectExpr("id", "if(id < 2, 1, 0) AS y")
    up = sampling.upsample_to_parity(df, "y", "id")
    assert {r["y"]: r["count"] for r in up.groupBy("y").count().collect()} == {0: 30_000, 1: 30_000}
    assert up.filter("y = 1").select("id", "copy").distinct().count() == 30_000


def test_many_classes(spark, monkeypatch):
    from tallyloom.operators import sampling
    monkeypatch.setattr(sampling, "BROADCAST_ROWS", 3)
    df = spark.range(200).selectExpr("id", "if(id < 100, 'big', if(id < 110, NULL, concat('c', id % 30))) AS y")
    sizes = {r["y"]: r["n"] for r in df.groupBy("y").agg({"id": "count"}).withColumnRenamed("count(id)", "n").collect()}
    got = {(r["y"], r["split"]): r["count"] for r in sampling.stratified_split(df, "y", "id", 0.5).groupBy("y", "split").count().collect()}
    assert all(got.get((y, "train"), 0) == -(-n // 2) for y, n in sizes.items())


def test_silhouettes_in_blocks_of_clusters(spark, monkeypatch):
    import numpy as np
    from tallyloom.operators import cluster
    rng = np.random.default_rng(0)
    df = spark.createDataFrame([(i, float(a), float(b), i % 7) for i, (a, b) in enumerate(rng.normal(size=(60, 2)))], "id long, a double, b double, c int")
    whole = {r["id"]: r["silhouette"] for r in cluster.silhouette(df, "id", ["a", "b"], "c").collect()}
    monkeypatch.setattr(cluster, "BLOCK_CELLS", 12)
    parts = {r["id"]: r["silhouette"] for r in cluster.silhouette(df, "id", ["a", "b"], "c").collect()}
    assert whole.keys() == parts.keys() and all(abs(whole[k] - parts[k]) < 1e-9 for k in whole)


def test_density_keeps_rows_with_gaps(spark):
    from tallyloom.operators import cluster
    df = spark.createDataFrame([(i, 0.0 if i < 10 else None, float(i) / 100) for i in range(15)], "id long, a double, b double")
    got = {r["id"]: r["cluster"] for r in cluster.dbscan(df, "id", ["a", "b"], [(0.5, 3)]).collect()}
    assert got == {i: 0 if i < 10 else None for i in range(15)}
