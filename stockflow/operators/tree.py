"""Regression trees as tables: growth by histograms, node tables, native scoring.

* ``grow_tree``       — one deterministic tree, level by level.  Every feature
  is cut into equal bins once; a level is one aggregate of (node, feature, bin)
  counts and sums, whose size depends on the tree and not on the rows, and a
  running sum over the bins that gives each cut's variance reduction.  Nothing is
  sampled; equal gains go to the first feature and bin.
* ``forest_nodes``    — the stored Spark ML forest as rows of the same layout
  (tree, node, feature, threshold, children, weight, gain, prediction).
* ``score``           — rows through all trees of a node table with column
  expressions: each tree's nodes are one row of arrays, joined by the tree, and
  a row walks down level by level.  No model object and no refit is needed.
* ``importance``      — split gains by feature, as shares: each tree's sum to 1,
  then the trees' mean.

Rows with a value equal to a threshold go left.  Null features are refused by
``grow_tree`` and go right in ``score``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stockflow.operators.features import FEATURES, TARGET
from stockflow.operators.joins import bounded_broadcast

NODE_COLUMNS = ["tree", "node", "feature", "threshold", "left_child", "right_child", "weight", "gain", "prediction"]
LEAF = -1
BINS, TREE_DEPTH, TREE_MIN_LEAF = 32, 3, 5


def _vector(features: Sequence[str]):
    return F.array(*[F.col(c).cast("double") for c in features])


def _binned(train: DataFrame, features: Sequence[str], target: str, bins: int) -> DataFrame:
    """(node, y, xs, bs): target, feature values and their bins; all rows at the root."""
    ends = train.agg(*[f(F.col(c).cast("double")).alias(f"{name}_{k}") for k, c in enumerate(features)
                       for name, f in (("lo", F.min), ("hi", F.max))]).first()
    bs = []
    for k, c in enumerate(features):
        lo, hi = ends[f"lo_{k}"], ends[f"hi_{k}"]
        if lo is None or lo == hi:
            bs.append(F.lit(0))
            continue
        place = F.floor((F.col(c).cast("double") - F.lit(lo)) * F.lit(float(bins)) / F.lit(hi - lo)).cast("int")
        bs.append(F.least(place, F.lit(bins - 1)))
    return train.select(F.lit(1).cast("bigint").alias("node"), F.col(target).cast("bigint").alias("y"),
                        _vector(features).alias("xs"), F.array(*bs).alias("bs"))


def _best_cuts(rows: DataFrame, min_leaf: int) -> DataFrame:
    """(node, feature, threshold, gain) of the best cut of every node that has one."""
    cells = (rows.select("node", "y", F.posexplode(F.arrays_zip("xs", "bs")).alias("feature", "c"))
             .groupBy("node", "feature", F.col("c.bs").alias("bin"))
             .agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("s"), F.max("c.xs").alias("v")))
    whole = Window.partitionBy("node", "feature")
    upto = whole.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    real = lambda c, w: F.sum(c).over(w).cast("double")
    cuts = cells.select("node", "feature", "bin", F.max("v").over(upto).alias("threshold"),
                        real("n", upto).alias("nl"), real("s", upto).alias("sl"), real("n", whole).alias("n"), real("s", whole).alias("s"))
    nr, sr = F.col("n") - F.col("nl"), F.col("s") - F.col("sl")
    cuts = cuts.where((F.col("nl") >= min_leaf) & (nr >= min_leaf))
    drop = F.col("sl") * F.col("sl") / F.col("nl") + sr * sr / nr - F.col("s") * F.col("s") / F.col("n")
    cuts = cuts.withColumn("gain", drop / F.col("n")).where("gain > 0")
    best = F.max_by(F.struct("feature", "threshold", "gain"), F.struct(F.col("gain"), -F.col("feature"), -F.col("bin")))
    return cuts.groupBy("node").agg(best.alias("cut")).select("node", "cut.*")


def grow_tree(train: DataFrame, features: Sequence[str] = FEATURES, target: str = TARGET, depth: int = TREE_DEPTH,
              bins: int = BINS, min_leaf: int = TREE_MIN_LEAF, tree: int = 0) -> DataFrame:
    """Node table of one tree; node k has the children 2k and 2k + 1.  ``train`` is
    read once a level, so it should be a stored table; the target is a whole number."""
    rows = _binned(train, features, target, bins)
    levels = []
    for level in range(depth + 1):
        stats = rows.groupBy("node").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("s"))
        if level < depth:
            cuts = _best_cuts(rows, min_leaf).checkpoint(eager=True)   # a row a node
            stats = stats.join(cuts, "node", "left")
            went = rows.join(bounded_broadcast(cuts), "node")
            right = (F.element_at("xs", F.col("feature") + 1) > F.col("threshold")).cast("bigint")
            rows = went.select((F.col("node") * 2 + right).alias("node"), "y", "xs", "bs")
        else:
            stats = stats.withColumns({"feature": F.lit(None).cast("int"), "threshold": F.lit(None).cast("double"), "gain": F.lit(None).cast("double")})
        child = lambda k: F.when(F.col("feature").isNull(), LEAF).otherwise(F.col("node") * 2 + k).cast("int")
        levels.append(stats.select(F.lit(tree).alias("tree"), F.col("node").cast("int").alias("node"), F.coalesce("feature", F.lit(LEAF)).alias("feature"),
                                   "threshold", child(0).alias("left_child"), child(1).alias("right_child"), F.col("n").cast("double").alias("weight"),
                                   F.coalesce("gain", F.lit(0.0)).alias("gain"), (F.col("s").cast("double") / F.col("n").cast("double")).alias("prediction")))
    out = levels[0]
    for one in levels[1:]:
        out = out.unionByName(one)
    return out


def forest_nodes(spark: SparkSession, path: str) -> DataFrame:
    """Node table of a forest of continuous features that was saved under ``path``."""
    n = spark.read.parquet(f"{path}/data").select(F.col("treeID").alias("tree"), "nodeData.*")
    leaf = F.col("leftChild") < 0
    return n.select("tree", F.col("id").alias("node"), F.when(leaf, LEAF).otherwise(F.col("split.featureIndex")).alias("feature"),
                    F.when(~leaf, F.element_at(F.nullif(F.col("split.leftCategoriesOrThreshold"), F.array().cast("array<double>")), 1)).alias("threshold"),
                    F.col("leftChild").alias("left_child"), F.col("rightChild").alias("right_child"),
                    F.element_at("impurityStats", 1).alias("weight"), F.when(leaf, 0.0).otherwise(F.col("gain")).alias("gain"), "prediction")


def _trees(nodes: DataFrame) -> DataFrame:
    """A row a tree: its nodes in order as arrays, children as places in them."""
    listed = (nodes.groupBy("tree").agg(F.array_sort(F.collect_list(F.struct("node", "feature", "threshold", "left_child", "right_child", "prediction"))).alias("a"))
              .withColumn("ids", F.col("a.node")))
    place = lambda c: F.transform(F.col(f"a.{c}"), lambda k: F.array_position("ids", k).cast("int"))
    return listed.select("tree", F.col("a.feature").alias("t_feature"), F.col("a.threshold").alias("t_threshold"),
                         place("left_child").alias("t_left"), place("right_child").alias("t_right"), F.col("a.prediction").alias("t_prediction"))


def score(df: DataFrame, nodes: DataFrame, keys: Sequence[str], depth: int, features: Sequence[str] = FEATURES,
          prediction: str = "prediction") -> DataFrame:
    """``keys`` and the mean prediction of all trees (at most ``depth`` deep), at
    least 0; ``keys`` name a row of ``df``."""
    trees = nodes.agg(F.array_sort(F.collect_set("tree"))).first()[0]   # a number a tree
    rows = df.select(*keys, _vector(features).alias("__x"), F.explode(F.lit(trees)).alias("tree"))
    rows = rows.join(bounded_broadcast(_trees(nodes)), "tree")

    def down(at, _):
        feature = F.get("t_feature", at - 1)
        value = F.get("__x", feature)
        return (F.when(feature == LEAF, at).when(value <= F.get("t_threshold", at - 1), F.get("t_left", at - 1))
                .otherwise(F.get("t_right", at - 1)))

    leaf = F.aggregate(F.sequence(F.lit(1), F.lit(max(depth, 1))), F.lit(1), down)
    one = rows.select(*keys, F.get("t_prediction", leaf - 1).alias("__p"))
    return one.groupBy(*keys).agg(F.greatest(F.avg("__p"), F.lit(0.0)).alias(prediction))


def importance(nodes: DataFrame, features: Sequence[str] = FEATURES) -> DataFrame:
    """(feature, importance) of every feature, 0 if no cut uses it."""
    by_tree = (nodes.where(F.col("feature") != LEAF).groupBy("tree", "feature")
               .agg(F.sum(F.col("gain") * F.col("weight")).alias("g")))
    share = by_tree.withColumn("g", F.col("g") / F.sum("g").over(Window.partitionBy("tree")))
    total = share.groupBy("feature").agg(F.sum("g").alias("g"))
    total = total.withColumn("g", F.col("g") / F.sum("g").over(Window.partitionBy(F.lit(0))))   # a row a feature
    names = F.array(*[F.lit(f) for f in features])
    every = nodes.sparkSession.range(1).select(F.posexplode(names).alias("feature", "name"))
    return (every.join(total, "feature", "left")
            .select(F.col("name").alias("feature"), F.coalesce("g", F.lit(0.0)).alias("importance")).orderBy(F.col("importance").desc(), "feature"))
