"""API-1 as an ML estimator: ``NearestNeighbours().fit(train)`` keeps the train rows,
and the model's ``transform`` adds a prediction. Both are saved and loaded like any
other stage, alone or in a ``Pipeline``."""

from __future__ import annotations

import uuid

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.features import vectors_to_arrays
from ..plans.classify import knn_classify


class _NearestParams(HasFeaturesCol, HasLabelCol, HasPredictionCol):
    k = Param(Params._dummy(), "k", "number of neighbours", typeConverter=TypeConverters.toInt)
    strategy = Param(Params._dummy(), "strategy", "strategy of the kNN join", typeConverter=TypeConverters.toString)

    def __init__(self, *args):
        super().__init__(*args)
        self._setDefault(k=3, strategy="auto", featuresCol="features", labelCol="label", predictionCol="prediction")


class NearestNeighbours(Estimator, _NearestParams, DefaultParamsReadable, DefaultParamsWritable):
    """Exact k-nearest-neighbour classifier over a vector or array column."""

    @keyword_only
    def __init__(self, *, k: int = 3, featuresCol: str = "features", labelCol: str = "label", predictionCol: str = "prediction", strategy: str = "auto"):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> NearestNeighboursModel:
        rows = dataset.select(self.getFeaturesCol(), self.getLabelCol())
        return self._copyValues(NearestNeighboursModel(rows))


class NearestNeighboursModel(Model, _NearestParams, MLWritable, MLReadable):
    """The train rows and the parameters."""

    def __init__(self, train: DataFrame | None = None):
        super().__init__()
        self.train = train

    def _transform(self, dataset: DataFrame) -> DataFrame:
        """The rows with ``predictionCol``: the majority class of the k nearest train
        rows (lowest class on ties), null where a row has no usable features. Each
        row gets a working id for the join, which is dropped again. A train row's
        id is a digest of its features and label, so which of equally distant rows
        come first does not depend on how train is stored."""
        from ..session import checkpoint

        features, label = self.getFeaturesCol(), self.getLabelCol()
        row, tid = f"__row_{uuid.uuid4().hex}", "__train_row"
        # the query ids are fixed by the written copy
        queries = checkpoint(dataset.withColumn(row, F.monotonically_increasing_id()))
        train = vectors_to_arrays(self.train, features).withColumn(tid, F.xxhash64(label, features))
        pred = knn_classify(
            vectors_to_arrays(queries.select(row, features), features), train, features, self.getOrDefault("k"),
            query_id=row, train_id=tid, label=label, strategy=self.getOrDefault("strategy"),
        )
        found = pred.select(F.col("query_id").alias(row), F.col("prediction").alias(self.getPredictionCol()))
        return queries.join(found, row, "left").drop(row)

    def write(self) -> MLWriter:
        return _ModelWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _ModelReader(cls)


class _ModelWriter(MLWriter):
    def __init__(self, instance: NearestNeighboursModel):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession)
        self.instance.train.write.parquet(f"{path}/train")


class _ModelReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> NearestNeighboursModel:
        meta = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = NearestNeighboursModel(self.sparkSession.read.parquet(f"{path}/train"))
        model._resetUid(meta["uid"])
        DefaultParamsReader.getAndSetParams(model, meta)
        return model
