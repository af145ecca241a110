"""Writers (rows I-8 to I-11)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T


def append_parquet(df: DataFrame, path: str, partition_by: list[str],
                   written: Observation | None = None) -> None:
    """Append; REBALANCE lets AQE split hot partitions and merge small ones before the write.

    ``written`` receives the row count as ``inserted``. It is observed above the rebalance, where it
    also works when nothing is left to write.
    """
    spread = df.hint("rebalance", *partition_by) if partition_by else df
    if written is not None:
        spread = spread.observe(written, F.count("*").alias("inserted"))
    spread.write.mode("append").partitionBy(*partition_by).parquet(path)


def write_jdbc(df: DataFrame, url: str, table: str, batch_size: int = 1000,
               **options: str) -> None:
    df.write.format("jdbc").mode("append").options(
        url=url, dbtable=table, batchsize=str(batch_size), **options
    ).save()


def write_csv(df: DataFrame, path: str) -> None:
    """Plain CSV with a header; blanks at the edges of a text are kept."""
    df.write.mode("error").options(
        header="true", escape='"', ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false"
    ).csv(path)


def write_csv_quoted(df: DataFrame, path: str) -> None:
    """Text quoted with doubled inner quotes, numbers bare; each part file starts with a header."""
    def cell(field: T.StructField):
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.NumericType):
            return F.coalesce(c.cast("string"), F.lit('""'))
        return F.concat(F.lit('"'), F.coalesce(F.replace(c.cast("string"), F.lit('"'),
                                                         F.lit('""')), F.lit("")), F.lit('"'))

    header = ",".join('"' + name.replace('"', '""') + '"' for name in df.columns)
    line = F.concat_ws(",", *[cell(f) for f in df.schema.fields])
    # The CSV writer puts the column name on top of every part file: the header line is that name,
    # and a quote character that never occurs keeps the prepared line as it is.
    df.select(line.alias(header)).write.mode("error").options(
        header="true", quote="\u0000", sep="\u0001", escape="\u0000", charToEscapeQuoteEscaping="\u0000"
    ).csv(path)


def json_body(df: DataFrame, alias: str = "body") -> DataFrame:
    """One JSON object per row; nested structs and arrays follow, dates as ``yyyy-MM-dd``."""
    return df.select(
        F.to_json(F.struct("*"), {"dateFormat": "yyyy-MM-dd", "ignoreNullFields": "false"}).alias(
            alias
        )
    )


def write_json(df: DataFrame, path: str) -> None:
    json_body(df, "value").write.mode("error").text(path)
