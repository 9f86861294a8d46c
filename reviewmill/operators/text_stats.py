"""A pipeline stage that counts tokens, characters, exclamation marks and capitals."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.param.shared import HasInputCol, Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewmill.functions.reviews import blank_if_null
from reviewmill.functions.text import exclamation_count, token_count, upper_ratio

# Default column names and the names of the added columns.
INPUT_COLUMN, OUTPUT_PREFIX = "review_text", "txt_"
TOKEN_PATTERN = r"\s+"
STATISTICS = ["token_count", "char_count", "exclaim_count", "upper_ratio"]


class TextStats(Transformer, HasInputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Adds the statistics of a text column under a name prefix; null counts as empty text."""

    outputPrefix = Param(
        Params._dummy(), "outputPrefix", "prefix of the added columns", TypeConverters.toString
    )
    tokenPattern = Param(
        Params._dummy(), "tokenPattern", "regex between two tokens", TypeConverters.toString
    )

    @keyword_only
    def __init__(self, *, inputCol=None, outputPrefix=None, tokenPattern=None):
        super().__init__()
        self._setDefault(
            inputCol=INPUT_COLUMN, outputPrefix=OUTPUT_PREFIX, tokenPattern=TOKEN_PATTERN
        )
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def output_columns(self) -> list[str]:
        return [self.getOrDefault(self.outputPrefix) + name for name in STATISTICS]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        text = blank_if_null(F.col(self.getInputCol()))
        values = [
            token_count(text, self.getOrDefault(self.tokenPattern)),
            F.length(text),
            exclamation_count(text),
            upper_ratio(text),
        ]
        return dataset.withColumns(dict(zip(self.output_columns(), values)))
