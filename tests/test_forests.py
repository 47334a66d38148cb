import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from ebbline.columns import FEATURE_COLUMNS, ID_COLUMN
from ebbline.operators import forests, models, ranking, scoring
from ebbline.plans import registry


@pytest.fixture(scope="module")
def forest(training):
    """A pipeline with a deep forest, whose features are numbers and pairs of categories."""
    train, _ = models.split_training_data(training)
    preprocessor = models.build_preprocessor(train.select(FEATURE_COLUMNS)).fit(train)
    prepared = models.prepared_rows(preprocessor, train, train.count())
    return PipelineModel([*preprocessor.stages, models.random_forest(trees=20, depth=14).fit(prepared)])


def _by_id(rows, column):
    return {row[ID_COLUMN]: row["p"] for row in rows.select(ID_COLUMN, column.alias("p")).collect()}


def test_packed_forest_scores_exactly_like_spark(forest, training):
    ready = scoring.prepare_input(training, (ID_COLUMN,))
    scored = forest.transform(ready)
    expected = _by_id(scored, scoring.churn_probability(scored))
    found = scoring.score(forest, training)
    assert "ArrowEvalPython" in found._jdf.queryExecution().executedPlan().toString()
    assert _by_id(found, F.col("churn_probability")) == expected and len(set(expected.values())) > 50
    assert scoring.score(forest, training.limit(0)).count() == 0


def test_stored_forest_is_packed_anew(forest, training, tmp_path):
    forest.save(str(tmp_path / "forest"))
    loaded = PipelineModel.load(str(tmp_path / "forest"))
    both = [_by_id(scoring.score(model, training), F.col("churn_probability")) for model in (forest, loaded)]
    assert both[0] == both[1]


def test_rows_that_are_set_aside_early_reach_their_leaf(spark):
    """A tree like a ladder: some rows leave it at once, others come to depth 30."""
    rows = [(float(n % 2), Vectors.dense([float(n)])) for n in range(64)]
    frame = spark.createDataFrame(rows, ["label", "features"])
    model = models.RandomForestClassifier(numTrees=3, maxDepth=30, maxBins=64, seed=1).fit(frame)
    expected = [row["probability"][1] for row in model.transform(frame).collect()]
    assert list(forests.packed(model).probabilities(np.arange(64.0).reshape(-1, 1))) == expected


def test_forests_of_other_splits_are_left_to_spark(spark):
    """Three classes, or categories in threes."""
    rows = [(float(n % 3), Vectors.dense([float(n % 7)])) for n in range(60)]
    frame = spark.createDataFrame(rows, ["label", "features"])
    assert forests.packed(models.RandomForestClassifier(numTrees=2, seed=1).fit(frame)) is None
    attributes = {"ml_attr": {"attrs": {"nominal": [{"idx": 0, "name": "x", "vals": list("abcdefg")}]}, "num_attrs": 1}}
    nominal = frame.where("label < 2").withMetadata("features", attributes)
    model = models.RandomForestClassifier(numTrees=2, seed=1).fit(nominal)
    assert forests.packed(model) is None
    assert forests.with_probability(PipelineModel([model]), nominal) is None


def test_forest_check_scores_its_rows_once(spark, training, monkeypatch):
    """The metrics read kept rows: a frame that is not kept is scored in each of their passes."""
    kept = []

    def measured(scored, *columns):
        kept.append(scored.is_cached)
        return ranking.ranking_metrics(scored, *columns)

    monkeypatch.setattr(registry, "gold_table", lambda *_: training)
    monkeypatch.setattr(registry, "ranking", type("Ranking", (), {"ranking_metrics": staticmethod(measured)}))
    row = registry.forest_check(spark, "").first()
    assert kept == [True] and row["beats_chance"] is True and row["train_rows"] == 160
