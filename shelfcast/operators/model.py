"""Direct multi-horizon boosted-tree forecasts on MLlib."""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace

from pyspark import SparkContext
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.operators.metrics import wrmsse_by_prefix
from shelfcast.schema import HORIZON, KEYS

MISSING = -9999.0


@dataclass(frozen=True)
class TreeParams:
    """Boosting parameters. The defaults are those of the final training (M2).

    ``leaves`` is turned into a depth, as MLlib grows trees level by level. ``patience`` rounds without
    a better validation error end the search for the best number of trees. ``memory_mb`` bounds the
    statistics of one pass over the rows: too little means several passes for each level.
    """

    step: float = 0.01
    trees: int = 1500
    leaves: int = 2047
    rows_per_leaf: int = 4095
    row_fraction: float = 0.5
    feature_fraction: float = 0.8
    bins: int = 255
    seed: int = 0
    patience: int = 100
    memory_mb: int = 1024

    @property
    def depth(self) -> int:
        depth = max((self.leaves + 1).bit_length() - 1, 1)
        if depth > 30:
            raise ValueError("MLlib grows trees of depth 30 at most")
        return depth


FINAL = TreeParams()
BACKTEST = TreeParams(step=0.08)

# Stores whose parameters differ from the defaults (M3).
_SMALL = {"leaves": 255, "rows_per_leaf": 255}
OVERRIDES = {
    "CA_2": _SMALL,
    "CA_3": {**_SMALL, "trees": 2300},
    "CA_4": {"feature_fraction": 0.5},
    "WI_2": {**_SMALL, "feature_fraction": 0.5},
}
FINAL_OVERRIDES = {**OVERRIDES, "CA_3": {**OVERRIDES["CA_3"], "step": 0.03}}


def params_for(store: str, base: TreeParams, overrides: dict[str, dict]) -> TreeParams:
    """Parameters of one store (M3)."""
    return replace(base, **overrides.get(store, {}))


def fit_indexers(frame: DataFrame, categorical: Sequence[str], bins: int = 255) -> PipelineModel | None:
    """Label indexes in label order, fitted once on training rows and kept with the model.

    A tree needs one bin per label and one for labels that training has not seen, so a key
    with more labels than that is an error: leave it out of ``categorical``, and it enters as a number
    (text as a hash). The size of a table never decides how a key enters.
    """
    if not categorical:
        return None
    sizes = frame.agg(*[F.countDistinct(_label(c)).alias(c) for c in categorical]).first()
    wide = [c for c in categorical if sizes[c] + 1 > bins]
    if wide:
        raise ValueError(f"more labels than {bins} bins: {wide}")
    narrow = list(categorical)
    indexer = StringIndexer(
        inputCols=narrow, outputCols=[f"{c}__ix" for c in narrow], stringOrderType="alphabetAsc", handleInvalid="keep"
    )
    return Pipeline(stages=[indexer]).fit(frame.select(*[_label(c).alias(c) for c in narrow]))


def _label(column: str):
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def _number(frame: DataFrame, column: str):
    """A feature as a number; a text key that is not indexed is hashed to 31 bits."""
    if isinstance(frame.schema[column].dataType, T.StringType):
        return F.pmod(F.xxhash64(column), F.lit(2**31)).cast("double")
    return F.coalesce(F.col(column).cast("double"), F.lit(MISSING))


def design(frame: DataFrame, features: Sequence[str], indexers: PipelineModel | None = None) -> DataFrame:
    """Feature vector column (R20). Missing numbers become a value far below the data."""
    indexed = [c for c in indexers.stages[0].getInputCols() if c in features] if indexers is not None else []
    columns = frame.columns
    frame = frame.withColumns({f"{c}__num": _number(frame, c) for c in features if c not in indexed})
    if indexed:
        originals = [F.col(c).alias(f"{c}__raw") for c in indexed]
        frame = indexers.transform(frame.select("*", *originals).withColumns({c: _label(c) for c in indexed}))
        frame = frame.drop(*indexed).withColumnsRenamed({f"{c}__raw": c for c in indexed})
    inputs = [f"{c}__ix" if c in indexed else f"{c}__num" for c in features]
    vector = VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="error")
    return vector.transform(frame).select(*columns, "features")


def fit_trees(train: DataFrame, params: TreeParams, label: str = "residual", weight: str | None = None, checkpoint_every: int = 10):
    """One boosted-tree model over a distributed design frame (M2)."""
    optional = {}
    if weight is not None:
        optional["weightCol"] = weight
    gbt = GBTRegressor(
        featuresCol="features",
        labelCol=label,
        predictionCol="pred",
        maxDepth=params.depth,
        maxBins=max(params.bins, 2),
        maxIter=params.trees,
        stepSize=params.step,
        subsamplingRate=params.row_fraction,
        featureSubsetStrategy=str(params.feature_fraction),
        minInstancesPerNode=params.rows_per_leaf,
        checkpointInterval=checkpoint_every,
        maxMemoryInMB=params.memory_mb,
        cacheNodeIds=True,
        seed=params.seed,
        **optional,
    )
    return gbt.fit(train)


def staged_predictions(model: GBTRegressionModel, frame: DataFrame, into: str = "staged") -> DataFrame:
    """Array column with the prediction of every prefix of the trees: place k is that of the first k + 1.

    One pass finds the leaf of each tree; a table of leaf values, as large as the model, turns leaves into numbers.
    """
    values = [[float(x) for x in re.findall(r"Predict: (\S+)", t.toDebugString)] for t in model.trees]
    steps = F.from_json(F.lit(json.dumps([[w * v for v in vs] for w, vs in zip(model.treeWeights, values)])), "array<array<double>>")
    leaves = model.copy().setLeafCol("_leaf").transform(frame)
    each = F.zip_with(vector_to_array("_leaf"), steps, lambda leaf, vs: F.get(vs, leaf.cast("int")))
    sums = F.aggregate(each, F.array().cast("array<double>"), lambda acc, x: F.array_append(acc, x + F.coalesce(F.try_element_at(acc, F.lit(-1)), F.lit(0.0))))
    return leaves.withColumn(into, sums).drop("_leaf", "pred")


@dataclass(frozen=True)
class Judge:
    """How the number of trees is chosen (M4): WRMSSE of each prefix on the flagged rows of the frame.

    ``weights`` has (level, node, weight, scale), with a ``store_id`` for the hierarchy inside each store.
    """

    flag: str
    weights: DataFrame
    days: int = HORIZON


def prefix_errors(model: GBTRegressionModel, held: DataFrame, judge: Judge, store: str, label: str = "residual") -> list[float]:
    """WRMSSE of every prefix of the trees on the design rows ``held`` (M4); empty without rows."""
    rows = staged_predictions(model, held).withColumn("errs", F.transform("staged", lambda p: p - F.col(label)))
    weights = judge.weights
    if "store_id" in weights.columns:
        weights = weights.where(F.col("store_id") == store).drop("store_id")
    found = wrmsse_by_prefix(rows.select("id", *KEYS, "d", "errs"), weights, judge.days).first()
    return list(found.wrmsse) if found is not None and found.wrmsse is not None else []


def best_prefix(errors: Sequence[float], patience: int) -> int:
    """Number of trees with the least error before ``patience`` rounds bring no better one."""
    best = 0
    for i, e in enumerate(errors):
        if e < errors[best]:
            best = i
        elif i - best >= patience:
            break
    return best + 1


def first_trees(model: GBTRegressionModel, count: int) -> GBTRegressionModel:
    """The model of the first ``count`` trees; boosting adds trees one by one, so a prefix is a model."""
    java, gateway = model._java_obj, SparkContext._active_spark_context._gateway
    kinds = gateway.jvm.org.apache.spark.ml.regression
    trees, weights = java.trees(), java.treeWeights()
    kept = gateway.new_array(kinds.DecisionTreeRegressionModel, count)
    kept_weights = gateway.new_array(gateway.jvm.double, count)
    for i in range(count):
        kept[i], kept_weights[i] = trees[i], weights[i]
    short = kinds.GBTRegressionModel(java.uid(), kept, kept_weights, java.numFeatures())
    return GBTRegressionModel(short.setFeaturesCol(java.getFeaturesCol()).setPredictionCol(java.getPredictionCol()))


def importances(spark: SparkSession, model, features: Sequence[str]) -> DataFrame:
    """Feature importances, largest first (M11, K3): one row per feature."""
    values = model.featureImportances.toArray().tolist()
    schema = T.StructType([T.StructField("feature", T.StringType()), T.StructField("importance", T.DoubleType())])
    return spark.createDataFrame(list(zip(features, values)), schema).orderBy(F.desc("importance"), "feature")


@dataclass(frozen=True)
class Task:
    """One model of the grid: a term, the horizon whose lag columns it reads, and a store."""

    term: str
    horizon: int
    store: str


def model_grid(terms: Iterable[str], horizons: Iterable[int], stores: Iterable[str]) -> list[Task]:
    """Every (term, horizon, store) to train (M5: 1..28 on one term; M6: anchors on past terms)."""
    return [Task(t, h, s) for t in terms for h in horizons for s in stores]


def model_path(folder: str, task: Task) -> str:
    return os.path.join(folder, f"term={task.term}", f"horizon={task.horizon}", f"store={task.store}")


def save_model(model, folder: str, task: Task) -> str:
    """Persist a fitted model under its task (S10); its label indexes lie beside it once per term."""
    path = model_path(folder, task)
    model.write().overwrite().save(path)
    return path


def load_model(folder: str, task: Task) -> GBTRegressionModel:
    """The saved model of a task."""
    return GBTRegressionModel.load(model_path(folder, task))


def run_grid(tasks: Sequence[Task], work, parallel: int = 4) -> list:
    """Run independent fits side by side; each one is a distributed Spark job of its own.

    Threads only submit jobs, so a big store does not leave the cluster idle while
    it finishes a narrow stage.
    """
    with ThreadPoolExecutor(max_workers=parallel) as pool:
        return list(pool.map(work, tasks))


def train(rows: DataFrame, store: str, params: TreeParams, label: str = "residual", weight: str | None = None, judge: Judge | None = None):
    """(model, WRMSSE of each prefix) of one store's design rows.

    ``rows`` has ``features``, the label, ``in_train`` and what the judge needs: a written table, as every tree passes over it
    and a lost executor must not replay the feature plan. With a judge, all trees are grown, and the
    best prefix within the patience is kept.
    """
    known = rows.where(F.col(label).isNotNull())
    extra = [weight] if weight is not None else []
    model = fit_trees(known.where("in_train").select("features", label, *extra), params, label, weight)
    errors: list[float] = []
    if judge is not None:
        held = known.where(F.col(judge.flag)).select("id", *KEYS, "d", label, "features")
        errors = prefix_errors(model, held, judge, store, label)
        if errors:
            model = first_trees(model, best_prefix(errors, params.patience))
    return model, errors
