"""A grid of models that resumes: what is committed is neither trained nor scored again.

A task writes its model and its scores and then one row of the ledger. A run trains what an anti-join with the
ledger leaves. Scores come from the saved model, read back.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.operators.model import Judge, Task, TreeParams, design, fit_indexers, load_model, model_path, params_for, run_grid, save_model, train
from shelfcast.schema import KEYS
from shelfcast.session import table_path
from shelfcast.sources import store

LEDGER = "term string, horizon int, store_id string, spec string, trees int, wrmsse array<double>, features array<string>, importances array<double>, scores string"
KEEP = ("id", "d", "baseline", "residual")


@dataclass(frozen=True)
class Spec:
    """How the tasks of one part of a grid are trained. ``judge`` picks the number of trees; the future term has no days for it."""

    features_for: Callable[[int], Sequence[str]]
    categorical: Sequence[str]
    params: TreeParams
    overrides: dict
    weight: str | None = None
    judge: Judge | None = None

    def digest(self, task: Task) -> str:
        """What a committed model must agree in to count for this task."""
        params = params_for(task.store, self.params, self.overrides)
        judged = None if self.judge is None else (self.judge.flag, self.judge.days)
        said = repr((sorted(asdict(params).items()), list(self.features_for(task.horizon)), list(self.categorical), self.weight, judged))
        return hashlib.sha256(said.encode()).hexdigest()


def open_ledger(spark: SparkSession, folder: str) -> DataFrame:
    """The committed tasks of a grid folder; a new one has none."""
    path = f"{folder}/ledger"
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not root.getFileSystem(spark._jsc.hadoopConfiguration()).exists(root):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).option("recursiveFileLookup", "true").parquet(path)


def pending(spark: SparkSession, folder: str, tasks: Sequence[Task], spec: Spec) -> list[Task]:
    """The tasks that the ledger does not hold under this spec."""
    wanted = spark.createDataFrame([(t.term, t.horizon, t.store, spec.digest(t)) for t in tasks], "term string, horizon int, store_id string, spec string")
    left = wanted.join(open_ledger(spark, folder), ["term", "horizon", "store_id", "spec"], "left_anti").collect()
    keys = {(r.term, r.horizon, r.store_id) for r in left}
    return [t for t in tasks if (t.term, t.horizon, t.store) in keys]


def write_design(spark: SparkSession, folder: str, term: str, h: int, spec: Spec, frame: DataFrame) -> DataFrame:
    """Feature vectors of one (term, horizon) as a table by store: training and scoring rows, once for all its models.

    The label indexes of a term are fitted on its training rows and saved; every horizon of the term uses the same.
    """
    features = list(spec.features_for(h))
    used = [c for c in spec.categorical if c in features]
    indexers = fit_indexers(frame.where(F.col("in_train") & F.col("residual").isNotNull()), used, spec.params.bins)
    if indexers is not None:
        indexers.write().overwrite().save(f"{folder}/indexers/term={term}/horizon={h}")
    rows = design(frame.where("in_train OR in_eval"), features, indexers)
    extra = [spec.weight] if spec.weight is not None else []
    rows = rows.select("id", *KEYS, "d", "baseline", "residual", "in_train", "in_eval", *extra, "features")
    return store.write_table(rows, table_path(spark, f"design-{term}-{h}"), ["store_id"])


def run(spark: SparkSession, folder: str, tasks: Sequence[Task], spec: Spec, frame_for: Callable[[str, int], DataFrame], parallel: int = 4) -> list[Task]:
    """Train, save, read back and score what is pending; returns the tasks that were trained.

    ``frame_for(term, horizon)`` is a view of the feature table with ``in_train`` and ``in_eval`` flags; it is asked for only if
    a task of that frame is pending. Threads submit jobs side by side; the driver holds as many models as there are threads.
    """
    todo = pending(spark, folder, tasks, spec)
    designs = {key: write_design(spark, folder, *key, spec, frame_for(*key)) for key in dict.fromkeys((t.term, t.horizon) for t in todo)}

    def work(task: Task) -> Task:
        rows, features = designs[task.term, task.horizon].where(F.col("store_id") == task.store), list(spec.features_for(task.horizon))
        model, errors = train(rows, task.store, params_for(task.store, spec.params, spec.overrides), weight=spec.weight, judge=spec.judge)
        save_model(model, f"{folder}/models", task)
        model = load_model(f"{folder}/models", task)
        path = model_path(f"{folder}/scores", task)
        named = {"term": F.lit(task.term), "horizon": F.lit(task.horizon), "store_id": F.lit(task.store)}
        model.transform(rows.where("in_eval")).select(*KEEP, "pred").withColumns(named).write.mode("overwrite").parquet(path)
        entry = (task.term, task.horizon, task.store, spec.digest(task), model.getNumTrees, errors, features, model.featureImportances.toArray().tolist(), path)
        spark.createDataFrame([entry], LEDGER).coalesce(1).write.mode("overwrite").parquet(model_path(f"{folder}/ledger", task))
        return task

    return run_grid(todo, work, parallel)


def _committed(spark: SparkSession, folder: str, tasks: Sequence[Task], spec: Spec) -> DataFrame:
    wanted = spark.createDataFrame([(t.term, t.horizon, t.store, spec.digest(t)) for t in tasks], "term string, horizon int, store_id string, spec string")
    return open_ledger(spark, folder).join(wanted, ["term", "horizon", "store_id", "spec"], "left_semi")


def scores(spark: SparkSession, folder: str, tasks: Sequence[Task], spec: Spec) -> DataFrame:
    """All predictions of committed tasks: (id, d, baseline, residual, pred, term, horizon, store_id)."""
    paths = [r.scores for r in _committed(spark, folder, tasks, spec).select("scores").collect()]
    return spark.read.parquet(*paths)


def importances(spark: SparkSession, folder: str, tasks: Sequence[Task], spec: Spec) -> DataFrame:
    """One row per feature of each committed model (M11, K3), as kept with it: nothing is trained."""
    pairs = F.explode(F.arrays_zip("features", "importances")).alias("p")
    rows = _committed(spark, folder, tasks, spec).select("term", "horizon", "store_id", pairs)
    return rows.select("term", "horizon", "store_id", F.col("p.features").alias("feature"), F.col("p.importances").alias("importance"))
