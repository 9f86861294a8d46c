"""A pipeline stage that numbers categories from a table, however many there are."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
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
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewmill.operators.joins import MAX_BROADCAST_ROWS, hot_key_join
from reviewmill.operators.terms import category_index
from reviewmill.session import written

KEY, INDEX, WEIGHT = "_category", "_category_idx", "_category_rows"
# The longest label that a broadcast table may hold, so that its bytes are bounded as well.
MAX_LABEL_CHARS = 256


class _Columns(HasInputCol, HasOutputCol):
    """The column of labels and the column of their numbers."""


class CategoryIndexer(Estimator, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Numbers labels by falling frequency, ties by name, as Spark's ``StringIndexer`` does.

    The labels stay a table: nothing but their number comes to the driver. Null labels and labels that
    were not there when the stage was fitted share the number after the last one.
    """

    @keyword_only
    def __init__(self, *, inputCol: str | None = None, outputCol: str | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> CategoryIndexModel:
        column = self.getInputCol()
        labels = written(
            category_index(dataset.select(column), column).select(
                F.col(column).alias(KEY), F.col("category_idx").alias(INDEX),
                F.col("reviews").alias(WEIGHT),
            ),
            "category-labels",
        )
        size = labels.agg(F.count("*").alias("n"), F.coalesce(F.max(F.length(KEY)), F.lit(0)).alias("most"))
        found = size.first()
        small = found["n"] <= MAX_BROADCAST_ROWS and found["most"] <= MAX_LABEL_CHARS
        model = CategoryIndexModel(labels)
        model._set(numLabels=found["n"], small=small)
        return self._copyValues(model)


class CategoryIndexModel(Model, _Columns, MLWritable, MLReadable):
    """The numbered labels, joined to the rows: as a broadcast if few and short, else salted."""

    numLabels = Param(Params._dummy(), "numLabels", "number of labels", TypeConverters.toInt)
    small = Param(Params._dummy(), "small", "whether labels may be broadcast", TypeConverters.toBoolean)

    def __init__(self, labels: DataFrame | None = None):
        super().__init__()
        self.labels = labels

    def copy(self, extra=None) -> CategoryIndexModel:
        other = super().copy(extra)
        other.labels = self.labels
        return other

    def _transform(self, dataset: DataFrame) -> DataFrame:
        rows = dataset.withColumn(KEY, F.col(self.getInputCol()))
        if self.getOrDefault(self.small):
            joined = rows.join(F.broadcast(self.labels.drop(WEIGHT)), KEY, "left")
        else:
            spread = rows.withColumn("_spread", F.monotonically_increasing_id())
            joined = hot_key_join(spread, self.labels, KEY, WEIGHT, "_spread").drop("_spread", WEIGHT)
        count = self.getOrDefault(self.numLabels)
        number = F.coalesce(INDEX, F.lit(count)).cast("double")
        # Learners take the column for a category of so many values, not for a quantity.
        attribute = {"type": "nominal", "name": self.getOutputCol(), "num_vals": count + 1}
        return joined.withColumn(
            self.getOutputCol(), number.alias(self.getOutputCol(), metadata={"ml_attr": attribute})
        ).drop(KEY, INDEX)

    def write(self) -> MLWriter:
        return _LabelsWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _LabelsReader(cls)


class _LabelsWriter(MLWriter):
    """Stores the parameters and, beside them, the table."""

    def __init__(self, instance: CategoryIndexModel):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession)
        self.instance.labels.write.parquet(f"{path}/labels")


class _LabelsReader(MLReader):
    def __init__(self, cls: type[CategoryIndexModel]):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> CategoryIndexModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = self.cls(self.sparkSession.read.parquet(f"{path}/labels"))
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model
