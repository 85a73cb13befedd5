"""Scores of classifiers: confusion, report, AUC, ROC, cross-validation and search."""

from __future__ import annotations

from contextlib import nullcontext
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.operators.sampling import hash_fold
from tallyloom.runtime import persisted, running_totals, unit_hash


def confusion(df: DataFrame, label: str, prediction: str, weight: str | None = None) -> DataFrame:
    """(label, prediction, n, row_share): counts and their share of the true class; with `weight` a row stands for that many."""
    cells = df.groupBy(label, prediction).agg((F.sum(weight) if weight else F.count(F.lit(1))).alias("n"))
    rows = cells.groupBy(F.col(label).alias("_l")).agg(F.sum("n").alias("_t"))
    return cells.join(rows, cells[label].eqNullSafe(F.col("_l"))).select(label, prediction, "n", (F.col("n") / F.col("_t")).alias("row_share"))


def accuracy(df: DataFrame, label: str, prediction: str) -> DataFrame:
    return df.agg(F.avg(F.when(F.col(label) == F.col(prediction), 1.0).otherwise(0.0)).alias("accuracy"))


def classification_report(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """(class, precision, recall, f1, support) per class with accuracy, macro and weighted means as further rows.

    Undefined ratios count as 0.
    """
    cells = df.groupBy(F.col(label).cast("string").alias("_l"), F.col(prediction).cast("string").alias("_p")).agg(F.count(F.lit(1)).alias("n"))
    sides = cells.select(F.explode(F.array(
        F.struct(F.col("_l").alias("class"), F.col("n").alias("true"), F.lit(0).cast("long").alias("pred")),
        F.struct(F.col("_p").alias("class"), F.lit(0).cast("long").alias("true"), F.col("n").alias("pred")))).alias("s"),
        (F.col("_l") == F.col("_p")).alias("_hit"), "n")
    per = sides.groupBy("s.class").agg(F.sum("s.true").alias("support"), F.sum("s.pred").alias("_pred"),
                                       F.sum(F.when(F.col("_hit"), F.col("s.true")).otherwise(0)).alias("_tp"))
    zero = lambda e: F.coalesce(e, F.lit(0.0))
    per = per.withColumn("precision", zero(F.try_divide("_tp", "_pred"))).withColumn("recall", zero(F.try_divide("_tp", "support")))
    per = per.withColumn("f1", zero(F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))))
    measures = ["precision", "recall", "f1"]
    macro = per.agg(*[F.avg(c).alias(c) for c in measures], F.sum("support").alias("support")).withColumn("class", F.lit("macro avg"))
    weighted = per.agg(*[F.try_divide(F.sum(F.col(c) * F.col("support")), F.sum("support")).alias(c) for c in measures],
                       F.sum("support").alias("support")).withColumn("class", F.lit("weighted avg"))
    acc = per.agg(F.try_divide(F.sum("_tp"), F.sum("support")).alias("f1"), F.sum("support").alias("support")).select(
        F.lit("accuracy").alias("class"), "f1", "support")
    cols = ["class", *measures, "support"]
    return per.select(*cols).unionByName(macro.select(*cols)).unionByName(weighted.select(*cols)).unionByName(acc, allowMissingColumns=True)


def _by_score(df: DataFrame, label: str, score: str) -> DataFrame:
    """Distinct scores with positives and negatives, before any ordering."""
    return df.filter(F.col(score).isNotNull()).groupBy(F.col(score).alias("score")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg"))


def auc_rank(df: DataFrame, label: str, score: str) -> DataFrame:
    """Exact area under the ROC curve from average ranks; NULL when a class is missing."""
    ranked = running_totals(_by_score(df, label, score).withColumn("n", F.col("pos") + F.col("neg")), ["score"], {"_upto": "n"})
    rank = F.col("_upto") - F.col("n") + (F.col("n") + 1) / 2
    sums = ranked.agg(F.sum(rank * F.col("pos")).alias("r"), F.sum("pos").cast("double").alias("p"), F.sum("neg").cast("double").alias("q"))
    area = F.try_divide(F.col("r") - F.col("p") * (F.col("p") + 1) / 2, F.col("p") * F.col("q"))
    return sums.select(area.alias("auc"), F.col("p").cast("long").alias("positives"), F.col("q").cast("long").alias("negatives"))


def roc_points(df: DataFrame, label: str, score: str) -> DataFrame:
    """(threshold, tpr, fpr) at every distinct score, highest first."""
    counts = _by_score(df, label, score).withColumn("_down", -F.col("score"))
    totals = counts.agg(F.sum("pos").alias("p"), F.sum("neg").alias("q")).first()
    cum = running_totals(counts, ["_down"], {"_tp": "pos", "_fp": "neg"})
    return cum.select(F.col("score").alias("threshold"), F.try_divide(F.col("_tp"), F.lit(totals["p"])).alias("tpr"),
                      F.try_divide(F.col("_fp"), F.lit(totals["q"])).alias("fpr"))


def feature_importance(spark: SparkSession, model, names: list[str], top: int | None = None) -> DataFrame:
    """Named importances of a tree model, largest first."""
    values = model.featureImportances
    rows = [(n, float(values[i])) for i, n in enumerate(names)]
    out = spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")
    return out.limit(top) if top else out


def cross_validate(df: DataFrame, estimator, evaluator, folds: int, fold_col: str) -> list[float]:
    """Metric of every fold; rows carry their fold number, so folds do not depend on partitioning."""
    scores = []
    for k in range(folds):
        model = estimator.fit(df.filter(F.col(fold_col) != k))
        scores.append(evaluator.evaluate(model.transform(df.filter(F.col(fold_col) == k))))
    return scores


def compare_models(spark: SparkSession, df: DataFrame, estimators: dict, evaluator, folds: int, fold_col: str, prepare=None, parallelism: int = 2) -> DataFrame:
    """(model, mean_score, std_score) best first.

    What all estimators need is an estimator of its own, `prepare`, which is fitted once a fold, to its training part.
    """
    def judge(k):
        train, valid = df.filter(F.col(fold_col) != k), df.filter(F.col(fold_col) == k)
        if prepare is not None:
            ready = prepare.fit(train)
            train, valid = ready.transform(train), ready.transform(valid)
        return [evaluator.evaluate(est.fit(train).transform(valid)) for est in estimators.values()]

    with ThreadPool(parallelism) as pool:
        scores = pool.map(judge, range(folds), chunksize=1)
    rows = []
    for name, s in zip(estimators, zip(*scores)):
        mean = sum(s) / len(s)
        rows.append((name, mean, (sum((x - mean) ** 2 for x in s) / len(s)) ** 0.5))
    return spark.createDataFrame(rows, "model string, mean_score double, std_score double").orderBy(F.desc("mean_score"), "model")


def grid_search(df: DataFrame, estimator, grid: list[dict], evaluator, folds: int, fold_col: str, parallelism: int = 2):
    """Cross-validated search over parameter maps; returns (CrossValidatorModel, table of settings and mean scores).

    The returned model is refitted on all given rows. Settings of one decision tree that differ in its depth alone share a fit: a tree grows level by level,
    so the shallower ones are its upper levels.
    """
    from pyspark.ml.classification import DecisionTreeClassifier
    from pyspark.ml.tuning import CrossValidator
    if isinstance(estimator, DecisionTreeClassifier):
        model = _tree_search(df, estimator, grid, evaluator, folds, fold_col, parallelism)
        return model, _mean_scores(df, grid, model.avgMetrics)
    cv = CrossValidator(estimator=estimator, estimatorParamMaps=grid, evaluator=evaluator, numFolds=folds, foldCol=fold_col,
                        parallelism=parallelism)
    model = cv.fit(df)
    return model, _mean_scores(df, grid, model.avgMetrics)


def _mean_scores(df: DataFrame, grid: list[dict], means) -> DataFrame:
    rows = [(", ".join(f"{p.name}={v}" for p, v in sorted(g.items(), key=lambda x: x[0].name)), float(s)) for g, s in zip(grid, means)]
    return df.sparkSession.createDataFrame(rows, "setting string, mean_score double")


def _tree_search(df: DataFrame, estimator, grid: list[dict], evaluator, folds: int, fold_col: str, parallelism: int):
    """Cross-validation of decision trees with one fit a fold for all depths of otherwise equal settings."""
    from pyspark.ml.functions import vector_to_array
    from pyspark.ml.tuning import CrossValidatorModel
    groups: dict[tuple, list[int]] = {}
    for i, setting in enumerate(grid):
        groups.setdefault(tuple(sorted((p.name, v) for p, v in setting.items() if p.name != "maxDepth")), []).append(i)
    depth = [setting.get(estimator.maxDepth, estimator.getMaxDepth()) for setting in grid]
    by_depth = [sorted(members, key=lambda i: depth[i]) for members in groups.values()]
    said = estimator.getPredictionCol()
    scores = np.zeros((folds, len(grid)))

    def judge(task):
        k, members = task
        train, valid = df.filter(F.col(fold_col) != k), df.filter(F.col(fold_col) == k)
        root = estimator.fit(train, grid[members[-1]])._java_obj.rootNode()
        x = valid.select(F.col(evaluator.getLabelCol()), vector_to_array(estimator.getFeaturesCol()).alias("_x"))
        for i in members:
            scores[k, i] = evaluator.evaluate(x.withColumn(said, _upper_levels(root, F.col("_x"), depth[i])))

    with ThreadPool(parallelism) as pool:
        pool.map(judge, [(k, members) for k in range(folds) for members in by_depth])
    means = scores.mean(axis=0)
    best = means.argmax() if evaluator.isLargerBetter() else means.argmin()
    return CrossValidatorModel(estimator.fit(df, grid[int(best)]), means.tolist(), [], scores.std(axis=0).tolist())


def _upper_levels(node, x, depth: int):
    """What the upper levels of a tree of continuous features predict, as a column expression."""
    if depth == 0 or node.subtreeDepth() == 0:
        return F.lit(float(node.prediction()))
    split = node.split()
    return F.when(x[split.featureIndex()] <= F.lit(float(split.threshold())), _upper_levels(node.leftChild(), x, depth - 1)).otherwise(
        _upper_levels(node.rightChild(), x, depth - 1))


def drawn_settings(space: dict[str, list], n: int, seed: int) -> list[dict]:
    """n different settings drawn from the product of the listed values, by position, without listing the product."""
    names, total = list(space), 1
    for values in space.values():
        total *= len(values)
    out = []
    for at in np.random.default_rng(seed).choice(total, size=min(n, total), replace=False).tolist():
        setting = {}
        for name in names:
            at, i = divmod(at, len(space[name]))
            setting[name] = space[name][i]
        out.append(setting)
    return out


# What settings of one fit may differ in: a tree of less depth or with a larger least gain is the upper part of the other.
SHARED = ("maxDepth", "minInfoGain")


def _plain_trees(estimator, evaluator) -> bool:
    """Whether the estimator is a decision tree without weights and thresholds, judged by counts of labels and predictions."""
    from pyspark.ml.classification import DecisionTreeClassifier
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    return (isinstance(estimator, DecisionTreeClassifier) and not estimator.isDefined("weightCol") and not estimator.isDefined("thresholds")
            and isinstance(evaluator, MulticlassClassificationEvaluator) and not evaluator.isDefined("weightCol") and evaluator.getMetricName() != "logLoss")


def counted_score(evaluator, scored: DataFrame) -> float:
    """The score of a multiclass evaluator from the counts of labels and predictions."""
    cells = scored.groupBy(evaluator.getLabelCol(), evaluator.getPredictionCol()).agg(F.count(F.lit(1)).cast("double").alias("_n"))
    return evaluator.evaluate(cells, {evaluator.weightCol: "_n"})


def _tree_scores(make, settings: list[dict], train: DataFrame, valid: DataFrame, evaluator) -> list[float]:
    """Scores of trees that differ in SHARED alone: one fit, and one count of the rows left out by label and leaf."""
    limits = [(est.getMaxDepth(), est.getMinInfoGain()) for est in (make(**s) for s in settings)]
    model = make(**settings[0] | {"maxDepth": max(d for d, _ in limits), "minInfoGain": min(g for _, g in limits)}).fit(train).setLeafCol("_leaf")
    label, said = evaluator.getLabelCol(), evaluator.getPredictionCol()
    # One row per label and leaf.
    cells = model.transform(valid).groupBy(label, "_leaf").count().collect()
    root, out = _nodes(model._java_obj.rootNode()), []
    for depth, gain in limits:
        ends = _leaf_predictions(root, depth, gain)
        rows = train.sparkSession.createDataFrame([(r[label], ends[int(r["_leaf"])], float(r["count"])) for r in cells], f"{label} double, {said} double, _n double")
        out.append(evaluator.evaluate(rows.coalesce(1), {evaluator.weightCol: "_n"}))
    return out


def _nodes(node) -> tuple:
    """(prediction,) of a leaf, (prediction, gain, left, right) of a split."""
    if node.subtreeDepth() == 0:
        return (float(node.prediction()),)
    return float(node.prediction()), float(node.gain()), _nodes(node.leftChild()), _nodes(node.rightChild())


def _leaf_predictions(node: tuple, depth: int, gain: float, above: float | None = None) -> list[float]:
    """What the tree predicts in each of its leaves, from left to right, if it ends at this depth and before splits of less gain."""
    if above is None and (depth == 0 or len(node) == 1 or node[1] < gain):
        above = node[0]
    if len(node) == 1:
        return [above]
    return _leaf_predictions(node[2], depth - 1, gain, above) + _leaf_predictions(node[3], depth - 1, gain, above)


def halving_search(df: DataFrame, key: str, make, space: dict[str, list], evaluator, draws: int = 18, factor: int = 3, rungs: int = 3, seed: int = 1,
                   parallelism: int = 4):
    """(best setting, model fitted on all rows, table of rungs, table of trials) of a random search with successive halving.

    Every rung fits its settings on a hash sample of the rows, `factor` times as large as the one before and all rows in the end, scores them on the fifth
    that is left out of every fit, and passes the best 1/factor on. Ties go to the setting drawn first. The rows are marked and kept once; settings of a
    decision tree that differ in its depth and its least gain alone share a fit and a pass over the rows left out.
    """
    spark = df.sparkSession
    alive, trials, table = list(enumerate(drawn_settings(space, draws, seed))), [], []
    trees = _plain_trees(make(**alive[0][1]), evaluator)
    marked = df.withColumns({"_u": unit_hash(key, F.lit("rung")), "_fold": hash_fold(key, 5, "rung-fold")})
    if trees:
        marked = marked.select(evaluator.getLabelCol(), make().getFeaturesCol(), "_u", "_fold")
    with persisted(marked) as kept:
        for rung in range(rungs):
            share = float(factor) ** (rung - rungs + 1)
            with persisted(kept.filter(F.col("_u") < share)) if share < 1 else nullcontext(kept) as rows:
                train, valid = rows.filter("_fold <> 0"), rows.filter("_fold = 0")
                sizes = rows.agg(F.count_if(F.col("_fold") != 0).alias("t"), F.count_if(F.col("_fold") == 0).alias("v")).first()

                def score(settings, train=train, valid=valid):
                    if trees:
                        return _tree_scores(make, settings, train, valid, evaluator)
                    return [evaluator.evaluate(make(**s).fit(train).transform(valid)) for s in settings]

                groups: dict = {}
                for i, s in alive:
                    groups.setdefault(tuple((k, v) for k, v in s.items() if k not in SHARED) if trees else i, []).append((i, s))
                with ThreadPool(parallelism) as pool:
                    found = pool.map(score, [[s for _, s in members] for members in groups.values()], chunksize=1)
            scores = [(x, item) for members, some in zip(groups.values(), found) for x, item in zip(some, members)]
            ranked = sorted(scores, key=lambda x: (-x[0], x[1][0]))
            keep = max(1, len(alive) // factor)
            trials += [(rung, i, ", ".join(f"{k}={v}" for k, v in sorted(s.items())), float(x)) for x, (i, s) in ranked]
            table.append((rung, len(alive), int(sizes["t"]), int(sizes["v"]), keep, float(ranked[0][0])))
            alive = [item for _, item in ranked[:keep]]
        best = alive[0][1]
        model = make(**best).fit(kept)
    rungs_table = spark.createDataFrame(table, "rung int, settings int, train_rows long, valid_rows long, kept int, best_score double")
    return best, model, rungs_table, spark.createDataFrame(trials, "rung int, draw int, setting string, score double")
