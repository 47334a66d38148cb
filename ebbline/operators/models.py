"""Training of the candidate models and their run records."""

from __future__ import annotations

import datetime as dt
import math
import uuid
from dataclasses import dataclass

from pyspark.ml import Estimator, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType, TimestampType
from pyspark.storagelevel import StorageLevel

from ebbline.columns import FEATURE_COLUMNS, ID_COLUMN, TARGET_COLUMN
from ebbline.operators.preprocess import build_preprocessor
from ebbline.operators.quality import validate_training_data
from ebbline.operators.ranking import METRICS, evaluate
from ebbline.operators.scoring import prepare_input, score
from ebbline.operators.splits import stratified_split

# Fixed values.
TEST_SIZE = 0.20
SEED = 42
FOREST_TREES = 250
FOREST_DEPTH = 12
MAX_ITERATIONS = 1000
# End of fixed values.

LABEL = "label"
WEIGHT = "weight"
#: Fewer rows than this are not worth a task of their own in the many passes of a fit.
ROWS_PER_TASK = 2_000
#: A task of a fit takes no more rows than this where the frame has the tasks for it.
MOST_ROWS_PER_TASK = 250_000


class PriorClassifier(Estimator):
    """Predicts the share of positive labels for every row."""

    def _fit(self, dataset: DataFrame) -> SQLTransformer:
        prior = dataset.agg(F.avg(LABEL)).first()[0]
        return SQLTransformer(
            statement=f"SELECT *, array(CAST('{1 - prior!r}' AS DOUBLE), CAST('{prior!r}' AS DOUBLE)) AS probability"
            " FROM __THIS__"
        )


def class_weights(df: DataFrame, label: str = TARGET_COLUMN) -> DataFrame:
    """``label, entries, weight`` with weight n / (classes * entries), one row per class that occurs."""
    sizes = [F.count_if(F.col(label) == value) for value in (0, 1)]
    classes = F.array(
        *[F.struct(F.lit(value).alias("label"), size.alias("entries")) for value, size in enumerate(sizes)]
    )
    one_row = df.agg((sizes[0] + sizes[1]).alias("n"), classes.alias("classes"))
    occurring = one_row.select("n", F.filter("classes", lambda c: c["entries"] > 0).alias("classes"))
    rows = occurring.select("n", F.size("classes").alias("k"), F.inline("classes"))
    return rows.select("label", "entries", (F.col("n") / (F.col("k") * F.col("entries"))).alias("weight"))


def with_balanced_weight(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Add ``weight``.  There are two classes, so their weights are two literals."""
    sizes = df.agg(F.count_if(F.col(label) == 1).alias("ones"), F.count(F.lit(1)).alias("n")).first()
    ones, zeros = sizes["ones"], sizes["n"] - sizes["ones"]
    if not ones or not zeros:
        raise ValueError("training needs both classes")
    weight = F.when(F.col(label) == 1, sizes["n"] / (2 * ones)).otherwise(sizes["n"] / (2 * zeros))
    return df.withColumn(WEIGHT, weight.cast("double"))


def in_tasks_of_size(df: DataFrame, rows: int, rows_per_task: int = ROWS_PER_TASK, busy: int | None = None) -> DataFrame:
    """``df`` in no more tasks than its ``rows`` keep busy; a frame in fewer tasks is left as it is.

    In each pass of a fit every task sends the statistics of all nodes, and every task that scores is sent the whole
    model.  So there are no more than ``busy`` tasks, by default as many as run at once, unless these would have more
    than ``MOST_ROWS_PER_TASK`` rows each.
    """
    busy = busy or df.sparkSession.sparkContext.defaultParallelism
    tasks = min(-(-rows // rows_per_task), max(busy, -(-rows // MOST_ROWS_PER_TASK)))
    return df.coalesce(max(1, tasks))


def bounded_training_rows(
    train: DataFrame, max_rows: int | None, label: str = LABEL, id_column: str = ID_COLUMN, seed: int = SEED
) -> DataFrame:
    """At most ``max_rows`` rows of ``train``, the classes in their shares, chosen by the hash of the id.

    A forest is fitted on all rows unless the caller states this bound.
    """
    rows = train.count() if max_rows is not None else 0
    if max_rows is None or rows <= max_rows:
        return train
    chosen = stratified_split(train, label, id_column, max_rows / rows, seed + 1)
    return chosen.where("is_test").drop("is_test")


def forest_sizes(model) -> DataFrame:
    """``tree, nodes, depth`` of a fitted forest.  A forest lives on the driver: this is what it holds there."""
    spark = SparkSession.getActiveSession()
    sizes = [(number, tree.numNodes, tree.depth) for number, tree in enumerate(model.trees)]
    return spark.createDataFrame(sizes, "tree int, nodes long, depth int")


def training_frame(gold: DataFrame, id_column: str = ID_COLUMN, label: str = TARGET_COLUMN) -> DataFrame:
    """Id, aligned features and a double label."""
    labelled = gold.withColumn(LABEL, F.col(label).cast("double"))
    return prepare_input(labelled, (id_column, LABEL))


def logistic_regression(rows: int, balanced: bool = True) -> LogisticRegression:
    """Ridge penalty of strength one on the summed loss: balanced weights sum to the row count, and Spark
    divides the loss by that sum."""
    estimator = LogisticRegression(
        labelCol=LABEL,
        maxIter=MAX_ITERATIONS,
        regParam=1.0 / rows,
        elasticNetParam=0.0,
        standardization=False,
    )
    return estimator.setWeightCol(WEIGHT) if balanced else estimator


def random_forest(
    trees: int = FOREST_TREES,
    depth: int = FOREST_DEPTH,
    min_leaf: int = 1,
    features: str = "sqrt",
    balanced: bool = True,
    seed: int = SEED,
    memory_mb: int = 512,
    kind: type[RandomForestClassifier] = RandomForestClassifier,
) -> RandomForestClassifier:
    """A forest.  Each row's node is remembered from pass to pass instead of looked up in all trees, which halves
    the time of deep forests; ``memory_mb`` bounds how many nodes one pass over the rows splits.
    """
    estimator = kind(
        labelCol=LABEL,
        numTrees=trees,
        maxDepth=depth,
        minInstancesPerNode=min_leaf,
        featureSubsetStrategy=features,
        seed=seed,
        cacheNodeIds=True,
        maxMemoryInMB=memory_mb,
    )
    return estimator.setWeightCol(WEIGHT) if balanced else estimator


def candidate_models(rows: int, seed: int = SEED) -> dict[str, Estimator]:
    return {
        "dummy": PriorClassifier(),
        "logistic_regression": logistic_regression(rows),
        "random_forest": random_forest(seed=seed),
    }


def run_schema(params: list[str], extra_metrics: list[str] = ()) -> StructType:
    return StructType(
        [
            StructField("run_name", StringType()),
            StructField("run_id", StringType()),
            StructField("start_time", TimestampType()),
            StructField("status", StringType()),
            *[StructField(f"metrics.{name}", DoubleType()) for name in [*METRICS, *extra_metrics]],
            *[StructField(f"params.{name}", StringType()) for name in params],
        ]
    )


def run_row(name: str, metrics: dict[str, float], params: dict[str, str], started: dt.datetime) -> dict:
    return {
        "run_name": name,
        "run_id": uuid.uuid4().hex,
        "start_time": started,
        "status": "FINISHED",
        **{f"metrics.{key}": value for key, value in metrics.items()},
        **{f"params.{key}": str(value) for key, value in params.items()},
    }


def runs_frame(spark: SparkSession, rows: list[dict], extra_metrics: list[str] = ()) -> DataFrame:
    """One row per finished training run."""
    params = sorted({key.removeprefix("params.") for row in rows for key in row if key.startswith("params.")})
    schema = run_schema(params, extra_metrics)
    return spark.createDataFrame([tuple(row.get(name) for name in schema.names) for row in rows], schema)


@dataclass
class TrainedModels:
    models: dict[str, PipelineModel]
    scored: dict[str, DataFrame]
    runs: DataFrame


def split_training_data(
    gold: DataFrame,
    id_column: str = ID_COLUMN,
    label: str = TARGET_COLUMN,
    test_size: float = TEST_SIZE,
    seed: int = SEED,
) -> tuple[DataFrame, DataFrame]:
    """Checked train and test frames.  Null labels are refused."""
    validate_training_data(gold, id_column, label, require_labels=True)
    split = stratified_split(training_frame(gold, id_column, label), LABEL, id_column, test_size, seed)
    return split.where(~F.col("is_test")).drop("is_test"), split.where("is_test").drop("is_test")


def evaluate_once(scored: DataFrame, label: str = LABEL) -> dict[str, float]:
    """The six metrics of scored rows.  The metrics need two passes, so the narrow result is kept meanwhile
    rather than scored twice."""
    kept = scored.select(label, "prediction", "churn_probability").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return evaluate(kept, label).first().asDict()
    finally:
        kept.unpersist()


def prepared_rows(preprocessor: PipelineModel, rows: DataFrame, size: int, busy: int | None = None) -> DataFrame:
    """Label, balanced weight and features of training rows."""
    ready = with_balanced_weight(preprocessor.transform(rows)).select(LABEL, WEIGHT, "features")
    return in_tasks_of_size(ready, size, busy=busy)


def train_models(
    gold: DataFrame,
    only: list[str] | None = None,
    id_column: str = ID_COLUMN,
    label: str = TARGET_COLUMN,
    test_size: float = TEST_SIZE,
    seed: int = SEED,
    threshold: float = 0.5,
    forest_rows: int | None = None,
) -> TrainedModels:
    """Fit each candidate on the train part and evaluate it on the test part.

    Pass a stored table: validation, split and fitting each read it.  The preprocessor is fitted once and
    shared, since it does not depend on the model.  ``forest_rows`` bounds the rows that fit the forest.
    """
    train, test = split_training_data(gold, id_column, label, test_size, seed)
    train.persist(StorageLevel.MEMORY_AND_DISK)
    preprocessor = build_preprocessor(train.select(FEATURE_COLUMNS)).fit(train)
    rows = train.count()
    prepared = prepared_rows(preprocessor, train, rows).persist(StorageLevel.MEMORY_AND_DISK)
    # The test part is to the train part as their shares; the count only says how many tasks score it.
    test = in_tasks_of_size(test, math.ceil(rows * test_size / (1 - test_size)))
    fewer = prepared
    if forest_rows is not None and forest_rows < rows:
        sample = bounded_training_rows(train, forest_rows, LABEL, id_column, seed)
        fewer = prepared_rows(preprocessor, sample, forest_rows).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        candidates = candidate_models(rows, seed)
        models, scored, rows = {}, {}, []
        for name in only or candidates:
            started = dt.datetime.now()
            fit_on = fewer if isinstance(candidates[name], RandomForestClassifier) else prepared
            fitted = PipelineModel([*preprocessor.stages, candidates[name].fit(fit_on)])
            result = score(fitted, test, keep=(id_column, LABEL), threshold=threshold)
            metrics = evaluate_once(result)
            # The names of recorded parameters.
            params = {
                "model": name,
                "artifact_type": "spark_pipeline",
                "serving_candidate": str(not isinstance(candidates[name], PriorClassifier)).lower(),
                "test_size": test_size,
                "random_state": seed,
            }
            models[name], scored[name] = fitted, result
            rows.append(run_row(name, metrics, params, started))
    finally:
        fewer.unpersist()
        prepared.unpersist()
        train.unpersist()
    return TrainedModels(models, scored, runs_frame(gold.sparkSession, rows))
