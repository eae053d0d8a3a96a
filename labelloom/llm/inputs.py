"""Reading the tables and small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from labelloom import scale


def table(spark: SparkSession, folder: str, name: str, key: str) -> DataFrame:
    return scale.spread(spark.read.parquet(f"{folder}/{name}.parquet"), key)


def crc_mod(column: str, modulus: int) -> Column:
    """crc32 of the value written as text, modulo ``modulus``; null for a null value."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % modulus


def text_or_empty(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def pieces(frames: Iterator[pd.DataFrame], rows: int) -> Iterator[pd.DataFrame]:
    """The same rows in frames of at most ``rows``, so that what a task holds stays small."""
    for frame in frames:
        for at in range(0, len(frame), rows):
            yield frame.iloc[at:at + rows]
