"""SNK-12 with Spark ML's own interfaces: an estimator whose model is saved, loaded and put into pipelines."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasMaxIter, HasPredictionCol, HasRegParam, HasSeed
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame

from cinerank.operators import factor as fa


class _Scoring(HasPredictionCol):
    bounded = Param(Params._dummy(), "bounded", "whether predictions are clamped to the scale of scores", TypeConverters.toBoolean)
    fallback = Param(Params._dummy(), "fallback", "prediction of cells whose user or item has no factors", TypeConverters.toFloat)

    def _defaults(self) -> None:
        self._setDefault(predictionCol="pred", bounded=True)


class FactorEstimator(Estimator, _Scoring, HasMaxIter, HasRegParam, HasSeed, DefaultParamsReadable, DefaultParamsWritable):
    """Alternating least squares over (user_id, item_id, score), with ids of any size."""

    rank = Param(Params._dummy(), "rank", "length of the factor vectors", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, rank: int = fa.SGD_RANK, regParam: float = fa.SGD_LAMBDA, maxIter: int = 10, seed: int = 42, predictionCol: str = "pred", bounded: bool = True):
        super().__init__()
        self._defaults()
        self._set(**self._input_kwargs)
        for name, value in (("rank", rank), ("regParam", regParam), ("maxIter", maxIter), ("seed", seed)):
            if not self.isSet(name):
                self._set(**{name: value})

    def _fit(self, dataset: DataFrame) -> FactorModel:
        model = fa.als_model(dataset, rank=self.getOrDefault(self.rank), reg=self.getRegParam(), max_iter=self.getMaxIter(), seed=self.getSeed())
        return self._copyValues(FactorModel(*fa.als_factors(model)))


class FactorModel(Model, _Scoring, MLWritable, MLReadable):
    """Factor tables (user_id, p) and (item_id, q); ``transform`` adds the prediction of each cell (user_id, item_id)."""

    def __init__(self, user_factors: DataFrame | None = None, item_factors: DataFrame | None = None):
        super().__init__()
        self._defaults()
        self.user_factors, self.item_factors = user_factors, item_factors

    def _transform(self, dataset: DataFrame) -> DataFrame:
        fallback = self.getOrDefault(self.fallback) if self.isSet(self.fallback) else None
        scored = fa.score_cells(dataset, self.user_factors, self.item_factors, fallback, bound=self.getOrDefault(self.bounded))
        return scored if self.getPredictionCol() == "pred" else scored.withColumnRenamed("pred", self.getPredictionCol())

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader(cls)


class _Writer(MLWriter):
    def __init__(self, instance: FactorModel):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession)
        fa.save_factors(self.instance.user_factors, self.instance.item_factors, f"{path}/factors")


class _Reader(MLReader):
    def __init__(self, cls: type[FactorModel]):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> FactorModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = self.cls(*fa.load_factors(self.sparkSession, f"{path}/factors"))
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model
