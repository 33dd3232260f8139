"""Helpers shared by the corpus operators."""

from __future__ import annotations

import os
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliate.arrow import ARROW_BYTES, ARROW_ROWS, prepare, release_memory, releasing
from foliate.sources.shared import discard, materialize, shared_folder

__all__ = ["ARROW_BYTES", "ARROW_ROWS", "discard", "materialize", "one_thread", "prepare", "release_memory", "releasing", "session_settings", "shared_folder", "table", "text_or_empty"]


@contextmanager
def session_settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """The settings for what is planned inside; those of before come back."""
    before = {key: spark.conf.get(key) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def one_thread() -> None:
    """Tokenizers encode in the task's own thread, unless the user has chosen: a task has one core."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(name: str = "text"):
    return F.coalesce(F.col(name), F.lit(""))
