"""Saved imputation parameters and fitted pipelines."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from strataprop.functions.checks import require_choice, require_columns
from strataprop.operators.imputation import PARAMS_SCHEMA

MODES = ("error", "overwrite")


def save_params(params: DataFrame, path: str, mode: str = "error") -> None:
    require_choice(mode, MODES, "mode")
    require_columns(params, PARAMS_SCHEMA.fieldNames(), "params")
    params.select(*PARAMS_SCHEMA.fieldNames()).write.mode(mode).parquet(path)


def load_params(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PARAMS_SCHEMA).parquet(path)


def save_pipeline(model: PipelineModel, path: str, mode: str = "error") -> None:
    require_choice(mode, MODES, "mode")
    writer = model.write()
    (writer.overwrite() if mode == "overwrite" else writer).save(path)


def load_pipeline(path: str) -> PipelineModel:
    return PipelineModel.load(path)
