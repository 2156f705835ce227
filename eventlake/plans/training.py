"""Training table, candidate models, comparison and choice."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterable, Iterator, Mapping
from contextlib import contextmanager, nullcontext
from dataclasses import dataclass
from functools import partial
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.operators.clean import drop_incomplete, to_double
from eventlake.operators.metrics import metric_columns
from eventlake.operators.physical import TASK_ROWS, held, rebalanced, spread, spread_by_rows
from eventlake.operators.split import PART, SEED, TEST, TRAIN, random_part
from eventlake.schemas import FEATURES, LABEL, LEADERBOARD
from eventlake.session import checkpoint_dir, work_path
from eventlake.sources.paths import largest_file, remove
from eventlake.sources.tables import local_rows

OPEN_FILES, SPLIT_BYTES = "spark.sql.maxConcurrentOutputFileWriters", "spark.sql.files.maxPartitionBytes"
#: Training rows from which on fits hold no more than they must: one fit at a time, a forest's trees TREES at a time.
MANY_ROWS = 1_000_000
TREES = 8


def assembler(features: Iterable[str]) -> VectorAssembler:
    """Feature columns to one vector, in order [ML1]; a null or NaN is an error."""
    return VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="error")


# The candidates, in the order that breaks ties, and their parameters.
def linear_regression(label: str = LABEL) -> Estimator:
    """Unregularised, so the exact least-squares solution [ML3]."""
    return LinearRegression(featuresCol="features", labelCol=label, maxIter=50)


def random_forest(label: str = LABEL, **parameters) -> Estimator:
    """Forest of 40 trees of depth 8, unless ``parameters`` of the estimator say otherwise [ML4].

    Keeping each row's node per tree gives the same forest in two thirds of the
    time, for as much cache again; it spills to disk. Boosting, with one tree at
    a time, is slower that way.
    """
    settings = {"numTrees": 40, "maxDepth": 8, "seed": SEED, "cacheNodeIds": True, **parameters}
    return RandomForestRegressor(featuresCol="features", labelCol=label, **settings)


def boosted_trees(label: str = LABEL, **parameters) -> Estimator:
    """40 boosting rounds of trees of depth 5, unless ``parameters`` of the estimator say otherwise [ML5]."""
    settings = {"maxIter": 40, "maxDepth": 5, "seed": SEED, **parameters}
    return GBTRegressor(featuresCol="features", labelCol=label, **settings)


CANDIDATES: Mapping[str, Callable[[str], Estimator]] = {
    "LinearRegression": linear_regression,
    "RandomForest": random_forest,
    "GBT": boosted_trees,
}


def model_columns(
    events: DataFrame,
    features: Iterable[str] = FEATURES,
    label: str = LABEL,
    required: Iterable[str] | None = None,
    part: Column | None = None,
) -> DataFrame:
    """Features and label as doubles, of rows complete before and after the cast [FLT1, PRJ7].

    By default every column of the table is required. Naming ``required``
    columns lets the scan skip the rest. A ``part`` column, if given, is worked
    out from the table's own columns and kept.
    """
    columns = [*features, label]
    rows = drop_incomplete(events, required)
    if part is not None:
        rows = rows.withColumn(PART, part)
    return drop_incomplete(to_double(rows, columns, keep=() if part is None else (PART,)), columns)


@dataclass(frozen=True)
class TrainingTable:
    """The exact rows behind a comparison, kept at ``path``."""

    path: str
    train: DataFrame
    test: DataFrame

    def count(self) -> int:
        """Rows in both parts [AGG1]; read from file footers."""
        return self.train.count() + self.test.count()

    def drop(self) -> None:
        """Delete the table's files, once no model needs to be measured on them any more."""
        remove(self.train.sparkSession, self.path)


@contextmanager
def _setting(spark: SparkSession, key: str, value: str | int) -> Iterator[None]:
    """A setting of the session for the block."""
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _open_files(spark: SparkSession, files: int):
    """Writers that keep ``files`` directories open at a time, so that a task need not sort its rows by directory."""
    return _setting(spark, OPEN_FILES, max(files, int(spark.conf.get(OPEN_FILES))))


def _file_a_task(table: TrainingTable):
    """Scans planned in the block take a task for each file of the table, which holds at most ``TASK_ROWS`` rows."""
    spark = table.train.sparkSession
    return _setting(spark, SPLIT_BYTES, f"{max(1, largest_file(spark, table.path))}b")


def write_training_table(
    rows: DataFrame, path: str | None = None, partitions: int | None = None, rebalance: bool = False
) -> TrainingTable:
    """Clean rows, marked with their part, written once with one directory per part [ML2].

    Every fit and the evaluation then scan only their part and its few columns.
    A lost executor re-reads files: it can neither redraw the lot of a row nor
    repeat the cleaning. With ``partitions`` the rows are spread first [PHY1],
    after the lot is drawn; with ``rebalance`` the engine sizes the files
    instead, which suits large tables. Otherwise nothing is shuffled or sorted,
    and a fit runs no wider than the files it then finds: a table of a few MB
    is one task. No file has more than ``TASK_ROWS`` rows.
    """
    if rebalance and partitions is not None:
        raise ValueError("either a number of partitions or rebalance")
    spark = rows.sparkSession
    path = path or work_path(spark, "training")
    dealt = rows if partitions is None else spread(rows, partitions)
    if rebalance:
        dealt = rebalanced(rows, [PART])
    with _open_files(spark, len((TRAIN, TEST))):
        dealt.write.partitionBy(PART).option("maxRecordsPerFile", TASK_ROWS).parquet(path)
    if dealt is not rows:
        _release(spark)
    table = spark.read.schema(rows.schema).parquet(path)
    train, test = (table.where(F.col(PART) == name).drop(PART) for name in (TRAIN, TEST))
    return TrainingTable(path, train, test)


def _release(spark: SparkSession) -> None:
    """Removes the files of shuffles that nothing reads any more; they stay until the driver collects its garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def _fit_forest(train: DataFrame, forest: RandomForestRegressor) -> RandomForestRegressionModel:
    """A forest whose trees are fitted TREES at a time, each time on draws of their own from all rows.

    A cached row holds a count for each tree that is fitted; which node of each
    tree it has come to is worked out again instead of being held.
    """
    n, seed = forest.getNumTrees(), forest.getSeed()
    runs = -(-n // TREES)
    held_less = {forest.cacheNodeIds: False}
    if runs > 1 and forest.getFeatureSubsetStrategy() == "auto":
        held_less[forest.featureSubsetStrategy] = "onethird"  # what "auto" is for several trees
    models = []
    for run in range(runs):
        # partitions draw by the seed and their number, so the seeds of two runs lie far apart
        own = {forest.numTrees: (n * (run + 1)) // runs - (n * run) // runs, forest.seed: seed + 1_000_003 * run}
        models.append(forest.copy({**held_less, **own}).fit(train))
        _release(train.sparkSession)
    if runs == 1:
        return models[0]
    context = train.sparkSession.sparkContext
    regression, first = context._jvm.org.apache.spark.ml.regression, models[0]
    trees = [tree for model in models for tree in model._java_obj.trees()]
    together = context._gateway.new_array(regression.DecisionTreeRegressionModel, len(trees))
    for place, tree in enumerate(trees):
        together[place] = tree
    java_model = regression.RandomForestRegressionModel(first.uid, together, first.numFeatures)
    first._java_obj.copyValues(java_model, context._jvm.org.apache.spark.ml.param.ParamMap())
    for name, value in (("numTrees", n), ("seed", seed)):
        java_model.set(java_model.getParam(name), value)
    model = RandomForestRegressionModel(java_model)
    model._transfer_params_from_java()
    return model


def fit(
    train: DataFrame, estimator: Estimator, features: Iterable[str] = FEATURES, dealt: bool = False
) -> PipelineModel:
    """Assembler and regressor fitted as one pipeline [ML6]. Batch only.

    Tree learners hold a cached copy of the rows and every pass reads it whole:
    their rows are dealt out by number, so that what one task reads is bounded
    [PHY1], unless they come ``dealt`` out. A forest of 40 trees holds about 730 bytes a row; from ``MANY_ROWS``
    rows on its trees are fitted a few at a time, which holds far less.
    """
    vectors = assembler(features)
    if isinstance(estimator, (RandomForestRegressor, GBTRegressor)):
        many = isinstance(estimator, RandomForestRegressor) and train.count() > MANY_ROWS
        if not dealt:
            train = spread_by_rows(train)
        if many:
            return PipelineModel([vectors, _fit_forest(vectors.transform(train), estimator)])
    return Pipeline(stages=[vectors, estimator]).fit(train)


def fit_all(
    train: DataFrame,
    features: Iterable[str] = FEATURES,
    label: str = LABEL,
    candidates: Mapping[str, Callable[[str], Estimator]] = CANDIDATES,
    parallelism: int | None = None,
    dealt: bool = False,
) -> dict[str, PipelineModel]:
    """Every candidate fitted [ML3, ML4, ML5]; by default all at a time, or in turn from ``MANY_ROWS`` rows on.

    Side by side they fill cores that the short jobs of one fit leave idle; where
    one fit fills them all, nothing is gained and each holds its copy of the rows.
    """
    features = list(features)
    checkpoint_dir(train.sparkSession)
    if parallelism is None and train.count() > MANY_ROWS:
        parallelism = 1
    jobs = [
        inheritable_thread_target(train.sparkSession)(partial(fit, train, make(label), features, dealt))
        for make in candidates.values()
    ]
    with ThreadPool(parallelism or len(jobs)) as pool:
        return dict(zip(candidates, pool.map(lambda job: job(), jobs, chunksize=1)))


def measure(rows: DataFrame, predictions: Mapping[str, str], label: str = LABEL) -> DataFrame:
    """Metrics of several prediction columns (name to column) from one pass [ML8].

    ``place`` is the given order.
    """
    measured = rows.agg(
        *[
            F.struct(F.lit(place).alias("place"), F.lit(name).alias("name"), *metric_columns(label, column)).alias(name)
            for place, (name, column) in enumerate(predictions.items())
        ]
    )
    return measured.select(F.inline(F.array(*[F.col(f"`{name}`") for name in predictions])))


def compare(test: DataFrame, models: Mapping[str, PipelineModel], label: str = LABEL) -> DataFrame:
    """All models applied in one scan of the test rows, and measured [ML7, ML8]."""
    rows, columns, assembled = test, {}, None
    for place, (name, model) in enumerate(models.items()):
        columns[name] = f"prediction_{place}"
        first, *rest = model.stages
        inputs = list(first.getInputCols()) if isinstance(first, VectorAssembler) else None
        if inputs is None or inputs != assembled:
            # models over the same features share one vector; it is worked out once
            rows = first.transform(rows.drop("features") if inputs else rows)
            assembled = inputs
        for stage in rest:
            rows = stage.transform(rows)
        rows = rows.withColumnRenamed("prediction", columns[name])
    return measure(rows, columns, label)


def leaderboard(measured: DataFrame) -> DataFrame:
    """Measured models by rising RMSE [SRT1]; ties keep their order, an RMSE that is no number comes last."""
    return measured.orderBy(F.col("rmse").asc_nulls_last(), "place").select(*LEADERBOARD.names)


def best(measured: DataFrame) -> DataFrame:
    """The model of least RMSE, the earlier one of a tie [AGG5]; no row when no RMSE is a number."""
    winner = F.min_by(F.struct(*LEADERBOARD.names), F.struct("rmse", "place"))
    usable = measured.where(F.col("rmse").isNotNull() & ~F.isnan("rmse"))
    return usable.agg(winner.alias("winner")).where("winner IS NOT NULL").select("winner.*")


@dataclass(frozen=True)
class Training:
    """Outcome of a training run."""

    leaderboard: DataFrame
    best_name: str
    best_rmse: float
    models: dict[str, PipelineModel]
    table: TrainingTable

    @property
    def best_model(self) -> PipelineModel:
        return self.models[self.best_name]


def train(
    events: DataFrame,
    features: Iterable[str] = FEATURES,
    label: str = LABEL,
    required: Iterable[str] | None = None,
    part: Column | None = None,
    candidates: Mapping[str, Callable[[str], Estimator]] = CANDIDATES,
    path: str | None = None,
    cache: bool = False,
    parallelism: int | None = None,
    partitions: int | None = None,
    rebalance: bool = False,
) -> Training:
    """Clean, split, fit, compare and choose [ML2-ML8, AGG5].

    ``cache`` holds the training part in memory and on local disk over the fits
    [PHY2], on top of what the tree learners hold anyway.
    """
    features = list(features)
    rows = model_columns(events, features, label, required, random_part() if part is None else part)
    table = write_training_table(rows, path, partitions, rebalance)
    dealt = table.train.count() > MANY_ROWS  # the fits then scan the files as they are, without a shuffle
    with _file_a_task(table) if dealt else nullcontext():
        if cache:
            with held(table.train) as held_rows:
                models = fit_all(held_rows, features, label, candidates, parallelism, dealt)
        else:
            models = fit_all(table.train, features, label, candidates, parallelism, dealt)
    measured = compare(table.test, models, label)
    measured = local_rows(events.sparkSession, measured.collect(), measured.schema)  # one row per candidate
    winner = best(measured).first()
    if winner is None:
        raise ValueError("no model has a usable RMSE; are there test rows?")
    return Training(leaderboard(measured), winner.name, winner.rmse, models, table)
