"""Pipeline stages of our own."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class MetadataDropper(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Strip ML attributes from columns, values and types untouched; all columns unless some are named."""

    columns = Param(Params._dummy(), "columns", "columns to strip, all if empty", TypeConverters.toListString)

    @keyword_only
    def __init__(self, *, columns: list[str] | None = None):
        super().__init__()
        self._setDefault(columns=[])
        if columns:
            self._set(columns=columns)

    def _transform(self, df: DataFrame) -> DataFrame:
        wanted = self.getOrDefault(self.columns) or df.columns
        return df.select([F.col(c).alias(c, metadata={}) if c in wanted else F.col(c) for c in df.columns])
