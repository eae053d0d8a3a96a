"""Writing datasets, predictions, side tables and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as ST

CSV_OPTIONS = {"header": True, "quote": '"', "escape": '"', "encoding": "UTF-8",
               "emptyValue": "", "nullValue": ""}


def as_text_lists(df: DataFrame) -> DataFrame:
    """Arrays become ``;`` lists and maps become JSON, since CSV holds neither."""
    out = []
    for field in df.schema.fields:
        column = F.col(field.name)
        if isinstance(field.dataType, ST.ArrayType):
            column = F.concat_ws(";", column).alias(field.name)
        elif isinstance(field.dataType, ST.MapType):
            column = F.to_json(column).alias(field.name)
        out.append(column)
    return df.select(*out)


def write_dataset(df: DataFrame, path: str, fmt: str = "csv", mode: str = "errorifexists") -> None:
    if fmt == "csv":
        as_text_lists(df).write.mode(mode).options(**CSV_OPTIONS).csv(path)
    else:
        df.write.mode(mode).format(fmt).save(path)


def write_predictions(df: DataFrame, path: str, fmt: str = "csv",
                      mode: str = "errorifexists") -> None:
    write_dataset(df.select("Id", "Category"), path, fmt, mode)


def write_side_table(df: DataFrame, path: str, fmt: str = "csv",
                     mode: str = "errorifexists") -> None:
    write_dataset(df.select("Id", "Terms", "Keywords"), path, fmt, mode)


def write_oob_curve(curve: DataFrame, path: str, fmt: str = "csv",
                    mode: str = "errorifexists") -> None:
    write_dataset(curve.select("n", "oob_score"), path, fmt, mode)


def write_search_results(results: DataFrame, path: str, fmt: str = "csv",
                         mode: str = "errorifexists") -> None:
    write_dataset(results, path, fmt, mode)
