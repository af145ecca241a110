"""Landed CSV files (rows I-1 to I-4, I-15a)."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.casting import FIELD_PARSERS
from tidemark.schemas import text_schema
from tidemark.session import shared_dir

CORRUPT = "_corrupt"
ERROR_HEAD = 100


def csv_options() -> dict[str, str]:
    return {
        "header": "true",
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": CORRUPT,
        # A row is malformed or not whatever columns a query picks.
        "columnPruning": "false",
        "quote": '"',
        "escape": '"',
        "multiLine": "false",
        "enforceSchema": "false",
        "emptyValue": "",
        "nullValue": "\u0000",
    }


def read_landed(spark: SparkSession, path: str | list[str], columns: list[str]) -> DataFrame:
    """CSV rows as text, plus the file they came from and the raw text of malformed rows."""
    return (
        spark.read.options(**csv_options())
        .schema(text_schema(columns, CORRUPT))
        .csv(path)
        .withColumn("source_file", F.col("_metadata.file_path"))
    )


def split_corrupt(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows that parsed, rows that did not)."""
    # Spark refuses to read the corrupt-record column alone: the test names a data column too.
    bad = F.when(F.length(F.concat_ws("", df.columns[0])) >= 0, F.col(CORRUPT).isNotNull())
    return (
        df.where(~bad).drop(CORRUPT),
        df.where(bad).select(
            "source_file", F.lit("malformed row").alias("reason"), F.col(CORRUPT).alias("content")
        ),
    )


def is_error_payload(body: Column) -> Column:
    """A body that is JSON, or speaks of an error within its first 100 characters."""
    text = F.ltrim(F.translate(body, "\t\r\n", "   "))
    return text.startswith("{") | F.contains(F.lower(F.substring(body, 1, ERROR_HEAD)),
                                             F.lit("error"))


def _heads(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The lines that tell what a landed file is, stored in the shared folder: of each split the first with text,
    with and without the blanks that JSON allows, and of each file the first hundred.

    Lines are numbered by the split they lie in, one after the other. A combining minimum of those numbers finds
    the wanted ones, one row a split; no line is sorted, and no file is ever read as one value.
    """
    lines = spark.read.text(path).select(
        F.col("value"), F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line"))
    text = F.ltrim(F.translate("value", "\t\r", "  "))
    found = lines.groupBy("source_file", "block").agg(
        F.min("line").alias("start"), F.min(F.when(text != "", F.col("line"))).alias("marked"),
        F.min(F.when(F.trim("value") != "", F.col("line"))).alias("named"))
    splits, heads = shared_dir(spark, "splits"), shared_dir(spark, "heads")
    found.write.parquet(splits)
    near = lines.join(spark.read.schema(found.schema).parquet(splits), ["source_file", "block"])
    early = (F.col("block") == 0) & (F.col("line") < F.col("start") + ERROR_HEAD)
    wanted = near.select(
        "source_file", F.struct("block", "line").alias("place"), F.substring("value", 1, 10_000).alias("head"),
        F.substring(text, 1, 1).alias("mark"), early.alias("early"), F.col("line").eqNullSafe(F.col("marked")).alias("marked"),
        F.col("line").eqNullSafe(F.col("named")).alias("named")).where("early or marked or named")
    wanted.write.parquet(heads)
    return spark.read.schema(wanted.schema).parquet(heads)


def error_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Landed files whose first line that is not blank begins as JSON, wherever it stands, or whose
    first 100 characters speak of an error.

    One line holds at least its line break, so the first 100 lines hold those characters.
    """
    return _errors(_heads(spark, path))


def _errors(heads: DataFrame) -> DataFrame:
    json = heads.where("marked").groupBy("source_file").agg(
        F.min(F.struct("place", "mark")).alias("first")
    ).where(F.col("first.mark") == "{").select("source_file")
    ordered = F.array_sort(F.collect_list(F.struct("place", F.substring("head", 1, ERROR_HEAD).alias("text"))))
    spoken = (
        heads.where("early")
        .groupBy("source_file")
        .agg(F.concat_ws("\n", F.transform(ordered, lambda s: s["text"])).alias("head"))
        .where(is_error_payload(F.col("head"))).select("source_file")
    )
    return json.unionByName(spoken).distinct().select(
        "source_file", F.lit("error payload").alias("reason"))


def file_list(spark: SparkSession, path: str | list[str]) -> list[str]:
    """The landed files of a folder, as their rows will name them; one name each."""
    found = spark.read.format("binaryFile").load(path).select(F.col("_metadata.file_path").alias("f"))
    return sorted(r.f for r in found.distinct().collect())


def refused_files(spark: SparkSession, path: str | list[str], columns: Sequence[str]) -> DataFrame:
    """``(source_file, reason)`` of the landed files that are left out as a whole: error answers, and files
    whose first line with text does not name the columns. Stored in the shared folder: what is refused is
    usually little, and its size is known to the planner then.
    """
    heads = _heads(spark, path)
    first = heads.where("named").groupBy("source_file").agg(F.min_by("head", "place").alias("head"))
    other = first.where(~_is_header(F.col("head"), columns)).select("source_file", F.lit("unexpected header").alias("reason"))
    errors = _errors(heads)
    found = errors.unionByName(other).groupBy("source_file").agg(F.min("reason").alias("reason"))
    target = shared_dir(spark, "refused")
    found.write.parquet(target)
    return spark.read.schema(found.schema).parquet(target)


def _is_header(line: Column, columns: Sequence[str]) -> Column:
    return F.lower(F.regexp_replace(line, "[\" \t\r\ufeff]", "")) == ",".join(columns).lower().replace(" ", "")


def landed_rows(spark: SparkSession, path: str | list[str], columns: Sequence[str],
                refused: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows that parsed, rows that did not) of the landed files that were not refused.

    Files are read as lines, each parsed by itself, so that no list of files is ever made and a file that is
    no table spoils nothing. A line equal to the header is not a row.
    """
    lines = spark.read.text(path).withColumn("source_file", F.col("_metadata.file_path"))
    kept = drop_files(lines.where(F.trim("value") != ""), refused).where(~_is_header(F.col("value"), columns))
    shape = ", ".join(f"`{c}` string" for c in [*columns, CORRUPT])
    parsed = kept.select(F.from_csv("value", F.lit(shape), csv_options()).alias("row"), "source_file").select("row.*", "source_file")
    return split_corrupt(parsed)


def drop_files(df: DataFrame, rejected: DataFrame) -> DataFrame:
    """Rows of files that were not rejected as a whole."""
    return df.join(rejected.select("source_file"), "source_file", "left_anti")


def default_key_column(df: DataFrame, column: str, pattern: str) -> DataFrame:
    """Fill an absent or empty key column from the landed path (one file per symbol or exchange)."""
    from_path = F.url_decode(F.regexp_extract(F.col("source_file"), pattern, 1))
    value = F.coalesce(F.nullif(F.col(column), F.lit("")), from_path) if column in df.columns else from_path
    return df.withColumn(column, F.when(value != "", value))


Parser = str | Callable[[Column], Column]


def typed(df: DataFrame, parsers: Mapping[str, Parser]) -> DataFrame:
    """Apply a parser to every column it names; absent columns are skipped, others stay as read.

    A name may carry a request prefix: only the part after the last dash names the column.
    """
    by_column = {name.split("-")[-1]: parser for name, parser in parsers.items()}
    unknown = [p for p in by_column.values() if isinstance(p, str) and p not in FIELD_PARSERS]
    if unknown:
        raise ValueError(f"unknown parsers: {unknown}")

    def cast(name: str) -> Column:
        parser = by_column.get(name)
        if parser is None:
            return F.col(name)
        parser = FIELD_PARSERS[parser] if isinstance(parser, str) else parser
        return parser(F.col(name)).alias(name)

    return df.select(*[cast(c) for c in df.columns])
