"""Stored pipelines that know which run they come from and at which threshold they decide."""

from __future__ import annotations

from dataclasses import astuple, dataclass

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession

IDENTITY_SCHEMA = "model_name string, run_id string, threshold double"


@dataclass(frozen=True)
class Identity:
    """Name of a model, the run that made it, and the probability above which it says churn."""

    model_name: str
    run_id: str
    threshold: float = 0.5


def save_artifact(spark: SparkSession, model: PipelineModel, path: str, identity: Identity) -> None:
    """Store a pipeline and, behind it, its identity: a pipeline without one comes from a write that was lost."""
    model.write().overwrite().save(path)
    row = spark.createDataFrame([astuple(identity)], IDENTITY_SCHEMA)
    row.coalesce(1).write.mode("overwrite").json(f"{path}/identity")


def read_identity(spark: SparkSession, path: str) -> Identity:
    try:
        row = spark.read.schema(IDENTITY_SCHEMA).json(f"{path}/identity").first()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        row = None
    if row is None or None in tuple(row):
        raise ValueError(f"the model at {path} has no complete identity")
    return Identity(*row)


def load_artifact(spark: SparkSession, path: str, run_id: str | None = None) -> tuple[PipelineModel, Identity]:
    """A stored pipeline and its identity; fails if it does not come from the run that is asked for."""
    identity = read_identity(spark, path)
    if run_id is not None and identity.run_id != run_id:
        raise ValueError(f"the model at {path} comes from run {identity.run_id}, not from {run_id}")
    return PipelineModel.load(path), identity
