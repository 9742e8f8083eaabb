"""Tab-separated tables.

Two dialects occur. ``csv`` quotes cells with doubled quotes inside; ``raw`` has
no quoting, so a cell may hold a lone quote. A missing cell is null inside and
blank at the edge.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from corvane.functions.text import blank_to_null


def read_table(spark: SparkSession, path: str, schema: StructType | str, dialect: str = "csv", missing_ok: bool = False) -> DataFrame:
    """Rows of a tab-separated table with a header; short rows are padded with nulls and blank lines skipped.

    All cells are read as text and then cast (a malformed number is null).
    ``missing_ok`` gives an empty table where the path doesn't exist.
    """
    types = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    text = StructType()
    for f in types.fields:
        text = text.add(f.name, StringType())
    reader = spark.read.schema(text).option("sep", "\t").option("header", True).option("mode", "PERMISSIVE").option("emptyValue", "")
    reader = reader.option("quote", '"').option("escape", '"') if dialect == "csv" else reader.option("quote", "")
    try:
        rows = reader.csv(path)
    except AnalysisException as e:
        if missing_ok and e.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], types)
        raise
    return rows.select(*[blank_to_null(F.col(f"`{f.name}`")).try_cast(f.dataType).alias(f.name) for f in types.fields])


def write_table(rows: DataFrame, path: str, order: list[str], dialect: str = "csv") -> None:
    """A tab-separated table with a header, sorted by ``order`` and all other columns; nulls are blank."""
    keys = order + [c for c in rows.columns if c not in order]
    text = rows.orderBy(*keys).select([F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in rows.columns])
    if dialect != "csv":
        text = text.select([F.translate(c, "\t\n\r", " ").alias(c) for c in rows.columns])
    out = text.write.mode("overwrite").option("sep", "\t").option("header", True).option("emptyValue", "")
    out = out.option("quote", '"').option("escape", '"') if dialect == "csv" else out.option("quote", "")
    out.csv(path)
