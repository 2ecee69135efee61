"""Fitted ``pyspark.ml`` boosted trees as arrays: scores of every prefix, path contributions, shorter ensembles."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_IF = re.compile(r"\s*If \(feature (\d+) <= (\S+)\)")
_LEAF = re.compile(r"\s*Predict: (\S+)")


@dataclass
class Trees:
    """Trees side by side, nodes in preorder; ``feature`` is -1 at a leaf, ``value`` the node's mean where known."""

    root: list[int]
    weight: list[float]
    feature: list[int]
    threshold: list[float]
    left: list[int]
    right: list[int]
    value: list[float]

    def walk(self, rows):
        """(tree, node of each row, its parent) for every step of every tree, parents before children."""
        import numpy as np

        feature, threshold = np.array(self.feature), np.array(self.threshold)
        left, right = np.array(self.left), np.array(self.right)
        for tree, root in enumerate(self.root):
            at = np.full(len(rows), root)
            yield tree, at, None
            while True:
                split = feature[at]
                inner = split >= 0
                if not inner.any():
                    break
                low = rows[np.arange(len(rows)), np.maximum(split, 0)] <= threshold[at]
                parent, at = at, np.where(inner, np.where(low, left[at], right[at]), at)
                yield tree, at, parent

    def staged(self, rows):
        """(rows, trees): the raw score after each tree."""
        import numpy as np

        out = np.zeros((len(rows), len(self.root)))
        value = np.array(self.value)
        for tree, at, _ in self.walk(rows):
            out[:, tree] = self.weight[tree] * value[at]  # the last step is a leaf
        return np.cumsum(out, axis=1)

    def contributions(self, rows, width: int):
        """(base, (rows, width)): base plus a row's contributions is its raw score.

        A step from a node to its child moves the mean; that move belongs to the feature
        the node splits on.
        """
        import numpy as np

        value, feature = np.array(self.value), np.array(self.feature)
        out = np.zeros((len(rows), width))
        for tree, at, parent in self.walk(rows):
            if parent is not None:
                moved = at != parent
                np.add.at(out, (np.flatnonzero(moved), feature[parent[moved]]),
                          self.weight[tree] * (value[at[moved]] - value[parent[moved]]))
        return float(sum(w * self.value[r] for w, r in zip(self.weight, self.root))), out


def read_trees(model: GBTClassificationModel, means: bool = False) -> Trees:
    """The splits and leaves of a model with continuous features; ``means`` asks for the means of inner nodes too."""
    out = Trees([], list(model.treeWeights), [], [], [], [], [])
    waiting: list[tuple[int, str]] = []  # nodes whose child on that side comes next

    def add(feature, threshold, value):
        node = len(out.feature)
        if waiting:
            parent, side = waiting.pop()
            getattr(out, side)[parent] = node
        else:
            out.root.append(node)
        for column, cell in zip((out.feature, out.threshold, out.left, out.right, out.value), (feature, threshold, -1, -1, value)):
            column.append(cell)
        if feature >= 0:
            waiting.extend([(node, "right"), (node, "left")])

    for line in model.toDebugString.splitlines():
        split, leaf = _IF.match(line), _LEAF.match(line)
        if split:
            add(int(split[1]), float(split[2]), 0.0)
        elif leaf:
            add(-1, 0.0, float(leaf[1]))
        elif "feature" in line and " in {" in line:
            raise ValueError("categorical splits are not read")
    if means:
        out.value = []
        for tree in model.trees:
            open_ = [tree._call_java("rootNode")]
            while open_:
                node = open_.pop()
                if out.feature[len(out.value)] >= 0:
                    open_ += [node.rightChild(), node.leftChild()]
                out.value.append(float(node.prediction()))
    return out


def first_trees(model: GBTClassificationModel, n: int) -> GBTClassificationModel:
    """The ensemble of the first ``n`` trees."""
    from pyspark import SparkContext

    jvm, gateway = SparkContext._active_spark_context._jvm, SparkContext._active_spark_context._gateway
    source = model._java_obj
    trees = gateway.new_array(jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, n)
    weights = gateway.new_array(jvm.double, n)
    for i, (tree, weight) in enumerate(zip(source.trees(), source.treeWeights())):
        if i < n:
            trees[i], weights[i] = tree, float(weight)
    cut = jvm.org.apache.spark.ml.classification.GBTClassificationModel(
        source.uid(), trees, weights, source.numFeatures(), source.numClasses())
    source.copyValues(cut, source.extractParamMap())
    return GBTClassificationModel(cut)


def matrix(column):
    """Rows of an Arrow list column as a matrix."""
    import numpy as np

    if not len(column):
        return np.zeros((0, 0))
    return column.flatten().to_numpy(zero_copy_only=False).astype("float64").reshape(len(column), -1)


def staged_scores(rows: DataFrame, models: dict[tuple[int, int], Trees], fold: str, label: str) -> DataFrame:
    """(trial, fold, stage, y, score): each row by every trial's model of the row's own fold, after each tree.

    ``rows`` holds ``x``, an array of the features. One pass serves all models, which go
    to the tasks as arrays.
    """
    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            x, folds, y = matrix(batch.column("x")), batch.column(fold).to_numpy(), batch.column(label).to_numpy()
            for (trial, k), trees in models.items():
                mine = np.flatnonzero(folds == k)
                if len(mine):
                    scores = trees.staged(x[mine])
                    stages = scores.shape[1]
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.full(scores.size, trial), pa.int32()), pa.array(np.full(scores.size, k), pa.int32()),
                        pa.array(np.tile(np.arange(1, stages + 1), len(mine)), pa.int32()),
                        pa.array(np.repeat(y[mine], stages), pa.int32()), pa.array(scores.ravel())],
                        ["trial", "fold", "stage", "y", "score"])

    return rows.select("x", F.col(fold).cast("int").alias(fold), F.col(label).cast("int").alias(label)).mapInArrow(
        run, "trial int, fold int, stage int, y int, score double")


def grouped_auc(scored: DataFrame, by: list[str]) -> DataFrame:
    """ROC-AUC (ties counted half) in each group; a group is bounded, as the folds of a bounded sample are."""
    from pyspark.sql import Window

    counts = scored.groupBy(*by, "score").agg(F.count_if(F.col("y") == 1).alias("_p"), F.count_if(F.col("y") == 0).alias("_n"))
    below = F.coalesce(F.sum("_n").over(Window.partitionBy(*by).orderBy("score").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    beaten = counts.withColumn("_w", F.col("_p") * (below + F.col("_n") / 2.0))
    return beaten.groupBy(*by).agg((F.sum("_w") / F.nullif(F.sum("_p") * F.sum("_n"), F.lit(0))).alias("auc"))


def contributions(model: GBTClassificationModel, rows: DataFrame, keep: list[str], width: int) -> DataFrame:
    """(keep..., base, contributions, raw): what each feature moves each row's raw score by, over all rows.

    ``rows`` holds ``x``, an array of the ``width`` features.
    """
    trees = read_trees(model, means=True)
    schema = rows.select(*keep).schema
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            x = matrix(batch.column("x")) if batch.num_rows else np.zeros((0, width))
            base, parts = trees.contributions(x, width)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * width, pa.int32()), pa.array(parts.ravel()))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(k) for k in keep], pa.array(np.full(len(x), base)), lists, pa.array(base + parts.sum(axis=1))],
                [*keep, "base", "contributions", "raw"])

    return rows.select(*keep, "x").mapInArrow(run, f"{kinds}, base double, contributions array<double>, raw double")


def contribution_ranking(parts: DataFrame, features: list[str], top: int = 15) -> DataFrame:
    """Mean absolute contribution per feature, largest first."""
    long = parts.select(F.posexplode("contributions").alias("_i", "_v"))
    named = F.element_at(F.array(*[F.lit(f) for f in features]), F.col("_i") + 1)
    return long.groupBy(named.alias("feature")).agg(F.round(F.avg(F.abs("_v")), 6).alias("mean_abs")).orderBy(
        F.desc("mean_abs"), "feature").limit(top)
