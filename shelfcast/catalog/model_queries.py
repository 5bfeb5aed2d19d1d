"""Queries that fit models; those without SQL are checked on their rows only.

They run on the dense leaf: daily sales of every store and part type, zero days included.
"""

from __future__ import annotations

import functools

from pyspark.sql import functions as F

from shelfcast.catalog import retail as r
from shelfcast.catalog.feature_queries import calendar, holidays, typed_calendar, weeks
from shelfcast.catalog.registry import query
from shelfcast.functions import calendar as fc
from shelfcast.functions import price as fp
from shelfcast.operators import backtest as ob
from shelfcast.operators import hierarchy as oh
from shelfcast.operators import metrics as ome
from shelfcast.operators import model as om
from shelfcast.operators import price as op
from shelfcast.operators import reshape as orr
from shelfcast.operators.calendar import flag_holidays, join_calendar
from shelfcast.operators.encode import term_cutoffs
from shelfcast.operators.price import join_prices
from shelfcast.operators.target import add_baseline, add_residual
from shelfcast.plans import grid
from shelfcast.plans.features import frame_view, write_encodings, write_feature_table, write_series_table
from shelfcast.plans.manifests import CATEGORICAL_COLUMNS, feature_columns
from shelfcast.schema import HORIZON, KEYS, TERMS
from shelfcast.session import shared_folder, table_path
from shelfcast.sources import store

# Keys of single series and items have more labels than the tree has bins, on every size: they enter as numbers.
CATEGORICAL = [c for c in CATEGORICAL_COLUMNS if c not in ("id_serial", "item_id")]
TRAIN_START = 425

# Defaults of the registered queries: every store, the future term and the newest past one, few and small trees, one
# horizon. A full run takes ``horizons=range(1, 29)``, ``anchors=ANCHORS``, ``terms=TERMS`` and the parameters ``om.FINAL`` and ``om.BACKTEST``.
SMALL = om.TreeParams(step=0.5, trees=2, leaves=3, rows_per_leaf=50, bins=128, patience=1)
HORIZONS = (7,)
SMALL_TERMS = TERMS[:2]


def retail_fact(spark, sf, leaf):
    """Dense days of every store and part type and 28 empty future ones, with calendar, event, price and target columns."""
    hi = leaf.agg(F.max("d")).first()[0]
    rows = orr.dense_days(leaf.select("id", *KEYS, "d", "sales"), 1, hi, HORIZON, keep=KEYS)
    rows = rows.join(orr.with_serial(leaf.select("id").distinct(), ["id"]), "id")

    events = typed_calendar(spark, sf, HORIZON).drop("date", "wday", "day")
    events = events.withColumns(
        {
            "event_name_1": F.col("event_name_2"),
            "event_name_2": fc.coded(F.col("event_name_2"), fc.EVENT_NAME_2_CODES),
            "event_type_2": fc.coded(F.col("event_type_1"), fc.EVENT_TYPE_2_CODES),
            "wm_yr_wk": F.floor((F.col("d") - 1) / 7).cast("int"),
        }
    )
    rows = join_calendar(rows, calendar(spark, sf, HORIZON).join(F.broadcast(events), "d"))
    rows = rows.withColumns(
        {
            "snap_total": fc.state_pick(F.col("state_id"), {s: F.col(f"snap_{i}") for i, s in enumerate(r.STATES)}),
            "event_type_statecat_labelenc": fc.composite_label(F.col("state_id"), F.col("cat_id"), F.col("event_type_1"), r.STATES, r.CATS),
        }
    ).drop(*[f"snap_{i}" for i in range(len(r.STATES))], "event_type_1")
    rows = flag_holidays(rows, holidays(spark, sf, HORIZON))
    prices = op.price_features(r.weekly_prices(spark, sf, leaf), weeks(spark, sf))
    rows = join_prices(rows, prices.drop("state_id", "cat_id", "dept_id"))
    rows = rows.withColumn("sell_price_minority12", fp.minor_digits(F.col("sell_price")))
    return add_residual(add_baseline(rows))


def type_weights(leaf, hi, by_store=False):
    """Scale and weight of every node above the part types; with ``by_store`` those of the hierarchy inside each store."""
    by = ["part"] if by_store else []
    leaf = leaf.withColumn("part", F.col("store_id"))
    scale = ome.rmsse_scale(oh.rollup(leaf, ["sales"], by=[*by, "d"], leaf_rows=True), hi, ("level", "node", *by))
    recent = ome.revenue_in_window(leaf, hi - 27, hi).withColumnRenamed("cents", "revenue")
    found = ome.node_weights(scale, ome.revenue_weight(recent, by=by), by)
    return found.withColumnRenamed("part", "store_id") if by_store else found


def flagged(rows, last_observed, term):
    """Training and scoring days of a term; those of a past term are also the days that choose the number of trees."""
    a, z = ob.term_windows(last_observed)[term]
    d = F.col("d")
    return rows.withColumns({"in_train": (d >= TRAIN_START) & (d < a), "in_eval": d.between(a, z)})


class Inputs:
    """The tables behind the frames, each written when it is first asked for."""

    def __init__(self, spark, sf):
        self.spark, self.sf = spark, sf
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))

    @functools.cached_property
    def last_day(self):
        return self.leaf.agg(F.max("d")).first()[0]

    @functools.cached_property
    def leaf(self):
        return store.write_table(r.type_sales(self.spark, self.sf), table_path(self.spark, "type-sales"))

    @functools.cached_property
    def features(self):
        return write_feature_table(retail_fact(self.spark, self.sf, self.leaf), self.buckets)

    @functools.cached_property
    def train_weights(self):
        scaled = ome.scaled_weight(store.write_table(type_weights(self.leaf, self.last_day), table_path(self.spark, "weights")))
        series = self.leaf.select("id", *KEYS).distinct()
        return store.write_table(ome.series_training_weight(series, scaled), table_path(self.spark, "train-weights"))

    @functools.cached_property
    def cutoffs(self):
        return term_cutoffs(self.last_day)

    @functools.cached_property
    def encodings(self):
        return write_encodings(self.features, self.cutoffs)

    @functools.cached_property
    def store_weights(self):
        return store.write_table(type_weights(self.leaf, self.last_day, by_store=True), table_path(self.spark, "store-weights"))

    @functools.cache
    def series(self, term):
        return write_series_table(self.features, self.encodings, term, self.cutoffs, self.buckets, self.train_weights)

    def frame(self, term, h):
        return flagged(frame_view(self.features, self.series(term), h), self.last_day, term)


def grid_folder(spark, sf):
    """One folder per content of the fact's source: a rerun finds its ledger again, other data does not."""
    files = r.table(spark, sf, "lineitem").select("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time").distinct()
    mark = files.agg(F.bit_xor(F.xxhash64("file_path", "file_size", "file_modification_time"))).first()[0]
    return f"{shared_folder(spark).rstrip('/')}/grids/{mark & (2**64 - 1):016x}"


def grids(stores, inputs, horizons, anchors, terms, final, backtest):
    """(tasks, spec) of the future term and of the past ones, which choose their number of trees by WRMSSE inside the store."""
    judge = om.Judge("in_eval", inputs.store_weights)
    return [
        (om.model_grid(terms[:1], horizons, stores), grid.Spec(feature_columns, CATEGORICAL, final, om.FINAL_OVERRIDES, "train_weight")),
        (om.model_grid(terms[1:], anchors, stores), grid.Spec(feature_columns, CATEGORICAL, backtest, om.OVERRIDES, "train_weight", judge)),
    ]


def trained(spark, sf, horizons=HORIZONS, anchors=HORIZONS, terms=SMALL_TERMS, final=SMALL, backtest=SMALL, parallel=8):
    """The grid's folder and parts, with every task committed: what an earlier run left is trained, the rest is there."""
    inputs = Inputs(spark, sf)
    stores = sorted(x.store_id for x in r.stores(spark, sf).select("store_id").distinct().collect())
    folder, parts = grid_folder(spark, sf), grids(stores, inputs, horizons, anchors, terms, final, backtest)
    for tasks, spec in parts:
        grid.run(spark, folder, tasks, spec, inputs.frame, parallel)
    return folder, parts


@query("gbt_forecast")
def gbt_forecast(spark, sf, **options):
    """A weighted boosted-tree model per (term, horizon, store), saved, read back and scored.

    ``options`` as for ``trained``: horizons of the future term, anchors of the past ones, the terms, and the parameters of the trees.
    """
    folder, parts = trained(spark, sf, **options)
    rows = [grid.scores(spark, folder, tasks, spec) for tasks, spec in parts]
    return rows[0].unionByName(rows[1]).select(
        "term", "horizon", "store_id", "id", "d", F.round(F.col("baseline") + F.col("pred"), 6).alias("forecast")
    )


@query("feature_importance")
def feature_importance(spark, sf, **options):
    """Importances kept with each saved model; only models that no earlier run has committed are trained."""
    folder, parts = trained(spark, sf, **options)
    rows = [grid.importances(spark, folder, tasks, spec) for tasks, spec in parts]
    return rows[0].unionByName(rows[1]).orderBy("term", "horizon", "store_id", F.desc("importance"), "feature")


@query(
    "category_index",
    f"""WITH {r.SQL_LEAF}, k AS (SELECT DISTINCT dept_id FROM leaf), i AS (SELECT dept_id, row_number() OVER (ORDER BY dept_id) - 1 AS ix FROM k)
    SELECT dept_id, CAST(ix AS DOUBLE) AS dept_ix, count(*) AS n, sum(sales) AS sales FROM leaf JOIN i USING (dept_id) GROUP BY 1, 2""",
)
def category_index(spark, sf):
    """Label index fitted once and applied to the fact."""
    fact = r.leaf_sales(spark, sf)
    indexers = om.fit_indexers(fact, ["dept_id"])
    return indexers.transform(fact).groupBy("dept_id", F.col("dept_id__ix").alias("dept_ix")).agg(
        F.count("*").alias("n"), F.sum("sales").alias("sales")
    )
