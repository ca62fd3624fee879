"""Shared parts of the custom ``pyspark.ml`` stages: parameters, and models whose state is a set of tables."""

from __future__ import annotations

import os
from typing import Any

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import (
    DefaultParamsReadable,
    DefaultParamsReader,
    DefaultParamsWritable,
    DefaultParamsWriter,
    MLReadable,
    MLReader,
    MLWritable,
    MLWriter,
)
from pyspark.sql import DataFrame, SparkSession


class HasColumns(Params):
    inputCols = Param(Params._dummy(), "inputCols", "input columns", TypeConverters.toListString)
    outputCols = Param(Params._dummy(), "outputCols", "output columns", TypeConverters.toListString)

    @property
    def inputs(self) -> list[str]:
        return self.getOrDefault(self.inputCols)

    @property
    def outputs(self) -> list[str]:
        return self.getOrDefault(self.outputCols)


class ParamEstimator(Estimator, HasColumns, DefaultParamsReadable, DefaultParamsWritable):
    """Estimator whose constructor takes its parameters by name."""

    defaults: dict[str, Any] = {}

    @keyword_only
    def __init__(self, **kwargs):
        super().__init__()
        self._setDefault(**self.defaults)
        self._set(**kwargs)

    def get(self, name: str):
        return self.getOrDefault(name)


class ParamTransformer(Transformer, HasColumns, DefaultParamsReadable, DefaultParamsWritable):
    """Stateless stage whose constructor takes its parameters by name."""

    defaults: dict[str, Any] = {}

    @keyword_only
    def __init__(self, **kwargs):
        super().__init__()
        self._setDefault(**self.defaults)
        self._set(**kwargs)

    def get(self, name: str):
        return self.getOrDefault(name)


class _TableModelWriter(MLWriter):
    def __init__(self, instance: "TableModel"):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        # The fitted tables go beside the usual metadata.
        DefaultParamsWriter.saveMetadata(
            self.instance, path, SparkSession.active(), extraMetadata={"state": self.instance.state}
        )
        for name, table in self.instance.tables.items():
            table.write.parquet(os.path.join(path, "tables", name))


class _TableModelReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str):
        spark = SparkSession.active()
        metadata = DefaultParamsReader.loadMetadata(path, spark)
        model = self.cls()
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        model.state = metadata["state"]
        model.tables = {
            name: spark.read.parquet(os.path.join(path, "tables", name)) for name in self.cls.table_names
        }
        return model


class TableModel(Model, HasColumns, MLReadable, MLWritable):
    """Fitted model: small values in ``state`` (saved as JSON), tables in ``tables`` (saved as Parquet)."""

    table_names: tuple[str, ...] = ()

    def __init__(self):
        super().__init__()
        self.state: dict[str, Any] = {}
        self.tables: dict[str, DataFrame] = {}

    def of(self, estimator: ParamEstimator, state=None, **tables: DataFrame):
        self.state, self.tables = state or {}, tables
        return estimator._copyValues(self)

    def get(self, name: str):
        return self.getOrDefault(name)

    def write(self) -> MLWriter:
        return _TableModelWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _TableModelReader(cls)
