"""Quantile random forest on Spark ML: the leaves of shared trees hold the distribution of the target."""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce

from pyspark.ml.feature import Imputer, ImputerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.timeutils import quantile_label
from tidemark.operators.forecast import pinball
from tidemark.sources.scratch import stored

FEATURES = ["cal_hour", "cal_dow", "p_lag1d", "p_lag2d", "p_lag7d", "p_samehour_mean7d", "p_dayD_mean", "p_dayD_trend", "p_roll24h_mean", "p_roll24h_std"]
#: Levels kept for each leaf, and the accuracy of the sketch that they come from: a leaf's distribution in bounded size,
#: whatever the number of its rows. The share of a leaf's rows below one of its values is off by 1/50 + 1/1000 at most.
LEVELS = [(i + 0.5) / 25 for i in range(25)]
ACCURACY = 1000


@dataclass(frozen=True)
class Forest:
    """Fitted trees over imputed features."""

    imputer: ImputerModel
    model: RandomForestRegressionModel
    features: tuple[str, ...]

    def ready(self, df: DataFrame) -> DataFrame:
        names = [f"_f_{c}" for c in self.features]
        filled = self.imputer.transform(df.select("*", *[F.col(c).cast("double").alias(n) for c, n in zip(self.features, names)]))
        return VectorAssembler(inputCols=names, outputCol="_vector", handleInvalid="keep").transform(filled).drop(*names)

    def leaves(self, df: DataFrame) -> DataFrame:
        """The rows once for each tree, with ``_tree`` and the leaf ``_node`` that they fall into."""
        return self.model.transform(self.ready(df)).select("*", F.posexplode(vector_to_array("_leaf")).alias("_tree", "_node")).drop("_leaf", "_vector", "_p")


def fit_forest(train: DataFrame, features: list[str], depth: int = 6, trees: int = 20, min_rows: int = 5, seed: int = 11) -> Forest:
    """Trees that split on squared error; missing features get the training median, rows without ``y`` aren't used."""
    known = train.where(F.col("y").isNotNull())
    names = [f"_f_{c}" for c in features]
    imputer = Imputer(strategy="median", inputCols=names, outputCols=names, relativeError=0.001).fit(known.select(*[F.col(c).cast("double").alias(n) for c, n in zip(features, names)]))
    forest = RandomForestRegressor(featuresCol="_vector", labelCol="y", predictionCol="_p", leafCol="_leaf", maxDepth=depth, numTrees=trees, minInstancesPerNode=min_rows, seed=seed, subsamplingRate=0.8)
    unfitted = Forest(imputer, None, tuple(features))
    return replace(unfitted, model=forest.fit(unfitted.ready(known)))


def quantile_forest(train: DataFrame, rows: DataFrame, features: list[str], qs: tuple[float, ...], depth: int = 6, trees: int = 20, min_rows: int = 5, seed: int = 11) -> tuple[DataFrame, DataFrame]:
    """``rows`` with q05 .. q95, and ``feature, importance``.

    A row falls into one leaf of each tree. Every leaf counts alike, so a training row counts with 1 / leaf size for each
    tree in which it shares the leaf; the quantiles are those of all training rows under these weights. A leaf is held as
    equally weighted levels of a mergeable sketch, combined before the shuffle.
    """
    fitted = fit_forest(train, features, depth, trees, min_rows, seed)
    levels = F.percentile_approx("y", F.array(*map(F.lit, LEVELS)), F.lit(ACCURACY)).alias("_v")
    held = fitted.leaves(train.where(F.col("y").isNotNull())).groupBy("_tree", "_node").agg(levels)
    keys = ["zone", "origin_date", "target_time"]
    placed = fitted.leaves(rows).join(held, ["_tree", "_node"]).select(*keys, F.explode("_v").alias("_v"))
    found = placed.groupBy(*keys).agg(F.percentile("_v", F.array(*map(F.lit, qs))).alias("_q"))  # of 25 values for each tree
    out = rows.join(found, keys).select(*rows.columns, *[F.col("_q")[i].alias(quantile_label(q)) for i, q in enumerate(qs)])
    importance = train.sparkSession.createDataFrame([(c, float(v)) for c, v in zip(features, fitted.model.featureImportances.toArray())], "feature string, importance double")
    return out, importance


def mean_importance(fits: list[DataFrame]) -> DataFrame:
    """Mean importance over refits and its share."""
    rows = reduce(DataFrame.unionByName, fits).groupBy("feature").agg(F.avg("importance").alias("importance"))
    return rows.withColumn("share", F.col("importance") / F.sum("importance").over(Window.partitionBy()))


#: Bins of a feature in the search, by quantiles of a fold's training rows.
BINS = 32


def binned_folds(rows: DataFrame, folds: list[tuple[str, str, str]], features: list[str]) -> DataFrame:
    """Training and validation rows of every fold, features as the numbers of bins; a missing one gets the training median's."""
    spec = F.array(*[F.struct(F.lit(i).alias("fold"), *[F.lit(d).cast("date").alias(n) for n, d in zip(("_to", "_from", "_until"), f)]) for i, f in enumerate(folds)])
    values = F.array(*[F.col(c).cast("double") for c in features]).alias("_x")
    known = rows.where(F.col("y").isNotNull()).select("zone", "target_time", "target_date", "y", values, F.inline(spec))
    train = F.col("target_date") <= F.col("_to")
    known = known.withColumn("train", train).where(train | F.col("target_date").between(F.col("_from"), F.col("_until")))
    levels = F.array(*[F.lit(i / BINS) for i in range(1, BINS)])
    edges = known.where("train").groupBy("fold").agg(F.array(*[F.percentile_approx(F.col("_x")[i], levels, F.lit(ACCURACY)) for i in range(len(features))]).alias("_e"))
    placed = known.join(F.broadcast(edges), "fold")  # a row per fold
    number = F.zip_with("_x", "_e", lambda x, e: F.size(F.filter(e, lambda limit: limit < F.coalesce(x, e[BINS // 2 - 1]))))
    return placed.select("fold", "train", "zone", "target_time", "y", number.alias("bins"))


def best_splits(placed: DataFrame, seed: int) -> DataFrame:
    """``fold, min_rows, tree, node, feature, bin``: per node the split of least squared error, where any is allowed.

    Histograms add up before the shuffle; a node looks at two thirds of the features, drawn by a hash.
    """
    keys = ["fold", "min_rows", "tree", "node"]
    tall = placed.select(*keys, "y", F.posexplode("bins").alias("feature", "bin")).where(F.pmod(F.xxhash64(F.lit(seed), "tree", "node", "feature"), F.lit(3)) < 2)
    hist = tall.groupBy(*keys, "feature", "bin").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("s"))
    order = Window.partitionBy(*keys, "feature")
    left = order.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    hist = hist.select(*keys, "feature", "bin", F.sum("n").over(left).alias("nl"), F.sum("s").over(left).alias("sl"), F.sum("n").over(order).alias("n"), F.sum("s").over(order).alias("s"))
    right_n, right_s = F.col("n") - F.col("nl"), F.col("s") - F.col("sl")
    gain = F.col("sl") * F.col("sl") / F.col("nl") + right_s * right_s / right_n - F.col("s") * F.col("s") / F.col("n")
    allowed = hist.where((F.col("nl") >= F.col("min_rows")) & (right_n >= F.col("min_rows"))).withColumn("gain", F.round(gain, 6)).where("gain > 0")
    best = allowed.groupBy(*keys).agg(F.max_by(F.struct("feature", "bin"), F.struct("gain", -F.col("feature"), -F.col("bin"))).alias("_s"))
    return best.select(*keys, "_s.feature", "_s.bin")


def grid_search(rows: DataFrame, folds: list[tuple[str, str, str]], grid: list[dict], features: list[str], qs: tuple[float, ...], seed: int = 11) -> DataFrame:
    """Mean pinball of every parameter point over the folds (train_end, val_start, val_end): ``point``, its parameters, ``n, pinball``.

    Points have ``depth``, ``trees`` and maybe ``min_rows``. Trees of all folds grow together, a level at a time, from
    histograms. A shallower tree is the top of a deeper one and fewer trees are the first of more, so only ``min_rows``
    needs trees of its own: all other points are read off the same ones, and nothing is fitted twice. A point's score doesn't
    depend on the others. The loop is over levels; what a level decides is one small row per node.
    """
    points = [{"min_rows": 5} | p for p in grid]
    depths, trees = sorted({p["depth"] for p in points}), max(p["trees"] for p in points)
    every = lambda values: F.explode(F.array(*[F.lit(v) for v in values]))
    base = stored(binned_folds(rows, folds, features), "grid-rows")
    start = base.withColumn("min_rows", every(sorted({p["min_rows"] for p in points}))).withColumn("tree", every(range(trees))).withColumn("node", F.lit(1).cast("long"))
    keys, decided = ["fold", "min_rows", "tree", "node"], []

    def routed(df: DataFrame) -> DataFrame:
        for splits in decided:
            down = F.col("node") * 2 + (F.col("bins")[F.col("feature")] > F.col("bin")).cast("long")
            df = df.join(splits, keys, "left").withColumn("node", F.coalesce(down, "node")).drop("feature", "bin")
        return df

    in_bag = F.pmod(F.xxhash64(F.lit(seed), "zone", "target_time", "tree"), F.lit(10)) < 8
    for _ in range(max(depths)):
        decided.append(stored(best_splits(routed(start.where("train").where(in_bag)), seed), "grid-splits"))
    # The leaf of a shallower tree is the ancestor at its depth.
    cut = routed(start).withColumn("depth", every(depths)).withColumn("leaf", F.expr("shiftright(node, cast(greatest(0, length(bin(node)) - 1 - depth) as int))"))
    at = ["fold", "min_rows", "depth", "tree", "leaf"]
    leaves = cut.where("train").groupBy(*at).agg(F.percentile_approx("y", F.array(*map(F.lit, LEVELS)), F.lit(ACCURACY)).alias("_v"))
    spark = rows.sparkSession
    table = spark.createDataFrame([(i, p["min_rows"], p["depth"], p["trees"]) for i, p in enumerate(points)], "point int, min_rows int, depth int, trees int")
    sought = cut.where("not train").select(*at, "zone", "target_time", "y").join(leaves, at).join(F.broadcast(table), ["min_rows", "depth"]).where(F.col("tree") < F.col("trees"))
    pooled = sought.select("point", "fold", "zone", "target_time", "y", F.explode("_v").alias("_v")).groupBy("point", "fold", "zone", "target_time", "y").agg(F.percentile("_v", F.array(*map(F.lit, qs))).alias("_q"))
    loss = sum((pinball(F.col("y"), F.col("_q")[i], q) for i, q in enumerate(qs)), F.lit(0.0)) / len(qs)
    scores = pooled.groupBy("point").agg(F.count(F.lit(1)).alias("n"), F.avg(loss).alias("pinball"))
    return table.join(scores, "point").select("point", "depth", "trees", "min_rows", "n", "pinball").orderBy("pinball", "point")
