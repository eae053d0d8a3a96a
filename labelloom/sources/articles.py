"""Reading article tables and shaping them for the engine."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as ST

from labelloom import scale

# The columns the engine looks at, and the label column.
ARTICLE_COLUMNS = ("Id", "Title", "Abstract", "Text", "Keywords", "Terms", "Tokens")
LABEL = "Category"
TEXT_COLUMN = {"binary": "Abstract", "multi-class": "Text"}

CSV_OPTIONS = {"header": True, "quote": '"', "escape": '"', "sep": ",", "encoding": "UTF-8",
               "enforceSchema": False}


def article_schema(columns) -> ST.StructType:
    """``Id`` is a long, everything else a string."""
    return ST.StructType([ST.StructField(c, ST.LongType() if c == "Id" else ST.StringType())
                          for c in columns])


def header(spark: SparkSession, path: str) -> list[str]:
    """Column names of a CSV file or folder, from its header line alone."""
    first = spark.read.options(header=True, quote='"', escape='"').csv(path)
    return first.columns


def read_csv(spark: SparkSession, path: str, schema: ST.StructType | None = None,
             multi_line: bool = True) -> DataFrame:
    """Comma separated, header row, double quotes doubled inside quoted fields.

    Quoted fields may hold line breaks, which stops Spark from splitting a file. Files that are known
    to hold none are split with ``multi_line=False``.
    """
    schema = schema or article_schema(header(spark, path))
    return spark.read.options(**CSV_OPTIONS, multiLine=multi_line).schema(schema).csv(path)


def read_articles(spark: SparkSession, path: str, fmt: str = "csv",
                  schema: ST.StructType | None = None, multi_line: bool = True) -> DataFrame:
    """Articles from CSV or any columnar source Spark reads."""
    if fmt == "csv":
        return scale.spread(read_csv(spark, path, schema, multi_line), "Id")
    reader = spark.read.format(fmt)
    return scale.spread((reader.schema(schema) if schema else reader).load(path), "Id")


def read_side_table(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """The table of extra columns, keyed by ``Id``."""
    return read_articles(spark, path, fmt)


def detect_shape(df: DataFrame) -> str:
    """``binary`` with both Title and Abstract, else ``multi-class`` with Text."""
    columns = set(df.columns)
    if {"Title", "Abstract"} <= columns:
        return "binary"
    if "Text" in columns:
        return "multi-class"
    raise ValueError(f"neither Title and Abstract nor Text among the columns {df.columns}")


def text_column(shape: str) -> str:
    return TEXT_COLUMN[shape]


def whitelist(df: DataFrame) -> DataFrame:
    """Known article columns in source order, and the label if there is one."""
    return df.select(*[c for c in df.columns if c in ARTICLE_COLUMNS or c == LABEL])


def select_item(df: DataFrame, key: str) -> DataFrame:
    """The single column ``key``."""
    return df.select(key)


def fill_missing(df: DataFrame, keep_null_label: bool = False) -> DataFrame:
    """Empty strings for missing text; a missing label becomes the class '' only on request."""
    columns = [f.name for f in df.schema.fields if isinstance(f.dataType, ST.StringType)
               and (keep_null_label or f.name != LABEL)]
    return df.fillna("", subset=columns) if columns else df


def with_column(df: DataFrame, name: str, value) -> DataFrame:
    return df.withColumn(name, value)


def split_label(df: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Features, and ``(Id, label)`` or ``None`` when the table has no label."""
    features = df.select(*[c for c in df.columns if c != LABEL])
    return features, df.select("Id", LABEL) if LABEL in df.columns else None


def join_side_table(articles: DataFrame, side: DataFrame, how: str = "inner") -> DataFrame:
    """Add the side table's columns by ``Id``.

    With ``inner`` an article without a side row disappears; several side rows repeat it.
    """
    clash = (set(articles.columns) & set(side.columns)) - {"Id"}
    if clash:
        raise ValueError(f"columns present on both sides: {sorted(clash)}")
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")
    return scale.attach(articles, side, ["Id"], how)


def load(articles: DataFrame, side: DataFrame | None = None, how: str = "inner",
         keep_null_label: bool = False) -> DataFrame:
    """Join the side table if given, keep the known columns, replace missing text."""
    if side is not None:
        articles = join_side_table(articles, side, how)
    return fill_missing(whitelist(articles), keep_null_label)


def has_label(df: DataFrame) -> bool:
    return LABEL in df.columns


def labelled(df: DataFrame) -> DataFrame:
    """Rows that can be used for training."""
    if not has_label(df):
        raise ValueError(f"no {LABEL} column")
    return df.filter(F.col(LABEL).isNotNull())
