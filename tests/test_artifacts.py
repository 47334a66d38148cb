import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import SQLTransformer

from ebbline.operators.artifacts import Identity, load_artifact, read_identity, save_artifact


@pytest.fixture
def model(spark):
    return Pipeline(stages=[SQLTransformer(statement="SELECT * FROM __THIS__")]).fit(spark.range(3))


def test_identity_is_read_back(spark, model, tmp_path):
    path = str(tmp_path / "model")
    for identity in (Identity("m", "run 1", 0.4), Identity("ü\"m", "run 2")):
        save_artifact(spark, model, path, identity)
        loaded, known = load_artifact(spark, path, identity.run_id)
        assert known == identity and loaded.transform(spark.range(3)).count() == 3
    with pytest.raises(ValueError, match="comes from run run 2, not from run 1"):
        load_artifact(spark, path, "run 1")


def test_model_without_identity_is_refused(spark, model, tmp_path):
    path = str(tmp_path / "model")
    model.save(path)
    with pytest.raises(ValueError, match="no complete identity"):
        read_identity(spark, path)
    save_artifact(spark, model, path, Identity("m", None))
    with pytest.raises(ValueError, match="no complete identity"):
        load_artifact(spark, path)
