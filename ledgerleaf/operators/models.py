"""Where an external model is attached: batch inference, post-processing and a task registry."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from ledgerleaf.operators import documents, pii


def batch_model(make_predict: Callable, return_type: DataType, batch_size: int = 64):
    """Column function around a model: ``make_predict()`` loads it once per worker and returns
    a function from an array of texts to an array (or dict of arrays) of results."""
    return predict_batch_udf(make_predict, return_type=return_type, batch_size=batch_size)


def cut_at_stop(generated: Column, stops: Sequence[str]) -> Column:
    """Generated text up to the first stop token."""
    for stop in stops:
        generated = F.substring_index(generated, stop, 1)
    return generated


def without_prompt(generated: Column, prompt: Column) -> Column:
    """Generated text without the prompt it repeats."""
    return F.when(generated.startswith(prompt), F.substring(generated, F.length(prompt) + 1, F.length(generated))).otherwise(
        generated
    )


TASKS: dict[str, Callable[..., DataFrame]] = {
    "sentiment-analysis": documents.sentence_sentiment,
    "summarization": documents.summaries,
    "translation": documents.translations,
    "token-classification": pii.spans_of,
}


def register_task(name: str, run: Callable[..., DataFrame]) -> None:
    TASKS[name] = run


def run_task(name: str, docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    if name not in TASKS:
        raise ValueError(f"unknown task {name!r}, known are {sorted(TASKS)}")
    return TASKS[name](docs, key, text)
