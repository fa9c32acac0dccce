"""The text stages as a Spark ML pipeline, for users who compose pipelines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.feature import NGram, RegexTokenizer, StopWordsRemover

from wirecount.functions.text import LETTERS


def text_pipeline(input_col: str, stop_words: Sequence[str], n: int = 2) -> Pipeline:
    """``input_col`` to ``tokens``, ``cleaned`` and ``ngrams``; fit it on any frame."""
    return Pipeline(stages=[
        RegexTokenizer(inputCol=input_col, outputCol="tokens", pattern=LETTERS, gaps=False,
                       toLowercase=True),
        StopWordsRemover(inputCol="tokens", outputCol="cleaned", stopWords=list(stop_words),
                         caseSensitive=False, locale="en_US"),
        NGram(inputCol="cleaned", outputCol="ngrams", n=n),
    ])
