"""Upserts, deletes and corrections as keyed rewrites (rows I-16, U-2 to U-11)."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.casting import DAY_FIRST, parse_datetime
from tidemark.operators.bars import period_start
from tidemark.operators.ingest import first_by_key
from tidemark.session import shared_dir
from tidemark.sources.store import Store, partition_names


def _null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> list[Column]:
    return [F.col("l." + k).eqNullSafe(F.col("r." + k)) for k in keys]


def without(stored: DataFrame, keyed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Stored rows whose key is not among the given ones; NULL key parts compare as equal."""
    right = keyed.select(*keys)
    return stored.alias("l").join(
        right.alias("r"), _null_safe(stored, right, keys), "left_anti"
    )


def by_content(df: DataFrame, keys: Sequence[str]) -> list[Column]:
    """A total order for rows of one key that arrive without any: the greatest values first, column
    by column, NULL last. Rows that tie in it are equal."""
    return [F.desc_nulls_last(c) for c in df.columns if c not in keys]


def upsert(stored: DataFrame, incoming: DataFrame, keys: Sequence[str],
           order: Sequence[str | Column]) -> DataFrame:
    """Stored rows with the incoming ones put in their place; the first per key by ``order`` wins
    among incoming rows, so that a key is stored once. Only keys travel in the anti-join, not whole
    incoming rows. A ``reason`` among the incoming columns is kept even if the table has had none."""
    new = first_by_key(incoming, keys, order)
    if "reason" in new.columns and "reason" not in stored.columns:
        stored = with_reason(stored, None)
    new = new.select(*[F.col(c) if c in new.columns else F.lit(None).cast(t).alias(c)
                       for c, t in stored.dtypes])
    return without(stored, new, keys).unionByName(new)


def refresh_instruments(stored: DataFrame, incoming: DataFrame,
                        order: Sequence[str | Column] | None = None) -> DataFrame:
    """Instrument upsert: known keys keep ``created_at`` and get the newest other values."""
    born = stored.select("instrument_hash", F.col("created_at").alias("_born"))
    new = (
        incoming.join(born, "instrument_hash", "left")
        .withColumn("created_at", F.coalesce("_born", "created_at")).drop("_born")
    )
    keys = ["instrument_hash"]
    return upsert(stored, new, keys, order or by_content(new, keys))


def remove_folder(spark: SparkSession, location: str) -> None:
    """Delete a folder given by its URI or path; it is an error if it is not there."""
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(location) if "://" in location or location.startswith("file:")
                                           else location)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True):
        raise FileNotFoundError(f"no such folder: {location}")


def _exchange(store: Store, table: str, batch: DataFrame, run: str | None,
              merge: Callable[[DataFrame, DataFrame], DataFrame]) -> int:
    """A new version of a stored table in which ``merge(stored, batch)`` stands for the stored rows of the
    partitions that the batch has rows in. No other partition is listed, read or written."""
    spark = batch.sparkSession
    change = store.begin(spark, run)
    partition = change.base["tables"][table]["partition"]
    path = shared_dir(spark, "batch")
    batch.write.parquet(path)
    batch = spark.read.schema(batch.schema).parquet(path)
    names = partition_names(batch, partition)
    change.replace(table, merge(change.read(table, only=names), batch), partition, names)
    version = change.commit()
    remove_folder(spark, path)
    return version


def upsert_partitions(store: Store, table: str, incoming: DataFrame, keys: Sequence[str],
                      order: Sequence[str | Column], run: str | None = None) -> int:
    """Upsert into a stored partitioned table; returns the version that shows it."""
    return _exchange(store, table, incoming, run, lambda stored, batch: upsert(stored, batch, keys, order))


def delete_partitions(store: Store, table: str, keyed: DataFrame, keys: Sequence[str], run: str | None = None) -> int:
    """Delete keyed rows from a stored partitioned table; returns the version that lacks them.

    ``keyed`` names the partition of each key. A partition left without rows is no part of the new version.
    """
    return _exchange(store, table, keyed, run, lambda stored, batch: without(stored, batch, keys))


# --- wide price updates --------------------------------------------------------------------------

# Column names of a wide update body.
VALUE_FIELDS = ["OPEN", "HIGH", "LOW", "CLOSE", "MID", "LAST", "BID", "ASK", "VOLUME", "OPENINTEREST"]
SERIES_COLUMNS = ["SYMBOL", "DATE", "CURVEDATE", "INDEX", "FREQUENCY", "VERSION", "FOLDER_PATH"]


FREQUENCY_UNITS = {"1D": "days", "1W": "weeks", "1M": "months", "1Q": "quarters", "1Y": "years"}


def _truncated(index: Column, frequency: Column) -> Column:
    """The index at the start of its period where the frequency names one."""
    out = index
    for name, unit in FREQUENCY_UNITS.items():
        out = F.when(frequency == name, period_start(index, unit).cast("timestamp")).otherwise(out)
    return out


def update_prices_long(wide: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Price fields of a wide update as (symbol, field, ondate, index, value) rows.

    ``INDEX`` gives the point's time where it is filled, else ``DATE``; a ``FREQUENCY`` moves it to the
    start of its period; a ``VERSION`` column is carried on as ``version``.
    """
    fields = [c for c in wide.columns if c in VALUE_FIELDS]
    index = parse_datetime(F.col("DATE"), DAY_FIRST) if "DATE" in wide.columns else F.lit(None).cast("timestamp")
    if "INDEX" in wide.columns:
        index = F.coalesce(parse_datetime(F.col("INDEX"), DAY_FIRST), index)
    if "FREQUENCY" in wide.columns:
        index = _truncated(index, F.upper("FREQUENCY"))
    if "VERSION" in wide.columns:
        wide, keep = wide.withColumn("version", F.col("VERSION")), [*keep, "version"]
    ondate = F.to_date(parse_datetime(F.col("CURVEDATE"), DAY_FIRST)) \
        if "CURVEDATE" in wide.columns else F.lit(None).cast("date")
    base = wide.select(
        F.col("SYMBOL").alias("symbol"), ondate.alias("ondate"), index.alias("index"),
        *keep, *[F.col(c).cast("double").alias(c) for c in fields],
    )
    return (
        base.unpivot(["symbol", "ondate", "index", *keep], fields, "field", "value")
        .where(F.col("value").isNotNull())
        .select("symbol", "field", "ondate", "index", "value", *keep)
    )


def update_metadata_long(wide: DataFrame) -> DataFrame:
    """Descriptive and ``*``-marked columns of a wide update as (symbol, property, value) rows."""
    skip = {*VALUE_FIELDS, *SERIES_COLUMNS}
    names = {c: c.lstrip("*") for c in wide.columns if c not in skip}
    if not names:
        text = F.lit(None).cast("string")
        return wide.select(F.col("SYMBOL").alias("symbol"), text.alias("property"), text.alias("value")).where("false")
    base = wide.select(
        F.col("SYMBOL").alias("symbol"),
        *[F.col(f"`{c}`").cast("string").alias(n) for c, n in names.items()],
    )
    long = base.unpivot("symbol", list(names.values()), "property", "value")
    return long.where(F.col("value").isNotNull() & (F.col("value") != "")).distinct()


def update_folders(wide: DataFrame) -> DataFrame:
    """Folder membership named by ``FOLDER_PATH``; backslashes become slashes."""
    path = F.trim(F.translate("FOLDER_PATH", "\\", "/"))
    return wide.where(F.col("FOLDER_PATH") != "").select(
        F.regexp_replace(path, "^/+", "").alias("path"), F.col("SYMBOL").alias("symbol")
    ).distinct()


def update_data(stored: dict[str, DataFrame], wide: DataFrame, reason: str | None = None) -> dict[str, DataFrame]:
    """The stored ``series``, ``metadata`` and ``folders`` with a wide update put in; tables that are
    not given are not touched. Among repeats of a key the greatest content wins."""
    rows = {"series": with_reason(update_prices_long(wide), reason), "metadata": update_metadata_long(wide)}
    if "FOLDER_PATH" in wide.columns:
        rows["folders"] = update_folders(wide)
    keys = {"series": SERIES_KEY, "metadata": ["symbol", "property"], "folders": ["path", "symbol"]}
    if "series" in stored and "version" in stored["series"].columns and "version" in rows["series"].columns:
        keys["series"] = [*SERIES_KEY, "version"]
    return {n: upsert(stored[n], rows[n], keys[n], by_content(rows[n], keys[n])) for n in rows if n in stored}


# --- long series ---------------------------------------------------------------------------------

SERIES_KEY = ["symbol", "field", "ondate", "index"]


def series_rows(body: DataFrame, frequency: str | None = None,
                keep: Sequence[str] = ()) -> DataFrame:
    """Typed long-series rows; an empty ONDATE is undated, ``frequency`` truncates the index.

    ``keep`` names further columns to carry, such as the order in which rows arrived.
    """
    index = parse_datetime(F.col("INDEX")).alias("index")
    rows = body.select(
        F.col("SYMBOL").alias("symbol"), F.col("FIELD").alias("field"),
        F.to_date(parse_datetime(F.nullif(F.col("ONDATE"), F.lit("")))).alias("ondate"),
        index, F.col("VALUE").cast("double").alias("value"), *keep,
    )
    if frequency is None:
        return rows
    if frequency not in FREQUENCY_UNITS:
        raise ValueError(f"unknown frequency: {frequency}")
    return rows.withColumn("index", _truncated(F.col("index"), F.lit(frequency)))


def update_timeseries(stored: DataFrame, rows: DataFrame,
                      order: Sequence[str | Column] | None = None) -> DataFrame:
    """Newer points put in place of stored ones; among repeats of a key the first by ``order`` wins,
    the greatest value where there is none."""
    return upsert(stored, rows, SERIES_KEY, order or by_content(rows, SERIES_KEY))


def delete_timeseries(stored: DataFrame, items: DataFrame) -> DataFrame:
    """Drop the points named by (symbol, field, curvedate, indexes[]); a NULL curvedate is undated."""
    points = items.select(
        "symbol", "field", F.col("curvedate").alias("ondate"),
        F.explode("indexes").alias("index"),
    ).distinct()
    return without(stored, points, SERIES_KEY)


# --- curves --------------------------------------------------------------------------------------

def curve_update_rows(body: DataFrame) -> DataFrame:
    """(symbol, onDate, field, reason, tenors[]) to one row per tenor."""
    return body.select("symbol", "onDate", "field", "reason", F.inline("tenors"))


def update_curves(stored: DataFrame, body: DataFrame) -> DataFrame:
    rows, keys = curve_update_rows(body), ["symbol", "onDate", "field", "tenor"]
    return upsert(stored, rows, keys, by_content(rows, keys))


def curve_configuration(body: DataFrame) -> dict[str, DataFrame]:
    """Nested configuration to one table per part: curve, inputs, settings, properties."""
    nested = [c for c in ("inputs", "settings", "properties") if c in body.columns]
    flat = [c for c in body.columns if c not in (*nested, "build")]
    build = ["build.*"] if "build" in body.columns else []
    return {
        "curve": body.select(*flat, *build),
        **{part: body.select("symbol", F.explode(part).alias("_p")).select("symbol", "_p.*")
           for part in nested},
    }


def update_curve_configuration(stored: dict[str, DataFrame], body: DataFrame) -> dict[str, DataFrame]:
    """The stored configuration tables with those of a body put in: curves by symbol, the others by
    (symbol, name), where the first column of a part is its name if none is called so."""
    out = dict(stored)
    for part, rows in curve_configuration(body).items():
        if part not in stored:
            continue
        rest = [c for c in rows.columns if c != "symbol"]
        keys = ["symbol"] if part == "curve" else ["symbol", "name" if "name" in rest else rest[0]]
        out[part] = upsert(stored[part], rows, keys, by_content(rows, keys))
    return out


# --- symbols, metadata, folders ------------------------------------------------------------------

def delete_symbol(stored: DataFrame, symbols: Sequence[str] | DataFrame) -> DataFrame:
    if isinstance(symbols, DataFrame):
        return without(stored, symbols, ["symbol"])
    return stored.where(F.col("symbol").isNull() | ~F.col("symbol").isin(*symbols))


def update_metadata(stored: DataFrame, items: DataFrame) -> DataFrame:
    """``items`` is wide: a symbol column and one column per property; empty cells are skipped."""
    names = [c for c in items.columns if c.lower() != "symbol"]
    key = next(c for c in items.columns if c.lower() == "symbol")
    long = items.withColumnRenamed(key, "symbol").unpivot("symbol", names, "property", "value")
    keys = ["symbol", "property"]
    return upsert(stored, long.where(F.col("value").isNotNull()), keys, by_content(long, keys))


def delete_metadata(stored: DataFrame, items: DataFrame) -> DataFrame:
    """``items`` is (symbol, properties[])."""
    named = items.select("symbol", F.explode("properties").alias("property")).distinct()
    return without(stored, named, ["symbol", "property"])


def folder_rows(body: DataFrame) -> DataFrame:
    """(folderId, folders[name], content[symbol], reason) to folder rows.

    A sub-folder is a row without a symbol, so that an empty one exists.
    """
    subs = body.select(F.explode("folders").alias("_f"), "folderId", "reason").select(
        F.concat_ws("/", "folderId", F.col("_f")["name"]).alias("path"),
        F.lit(None).cast("string").alias("symbol"), "reason",
    )
    members = body.select(F.explode("content").alias("_c"), "folderId", "reason").select(
        F.col("folderId").alias("path"), F.col("_c")["symbol"].alias("symbol"), "reason"
    )
    return subs.unionByName(members)


def update_folder(stored: DataFrame, body: DataFrame) -> DataFrame:
    rows, keys = folder_rows(body), ["path", "symbol"]
    return upsert(stored, rows, keys, by_content(rows, keys))


def delete_folder(stored: DataFrame, folders: Sequence[str]) -> DataFrame:
    """Remove whole subtrees; rows without a path stay."""
    if not folders:
        raise ValueError("name at least one folder")
    gone = F.lit(False)
    for folder in folders:
        gone = gone | (F.col("path") == folder) | F.col("path").startswith(folder + "/")
    return stored.where(~F.coalesce(gone, F.lit(False)))


def with_reason(df: DataFrame, reason: str | None) -> DataFrame:
    return df.withColumn("reason", F.lit(reason).cast("string"))


def load_status(audit: DataFrame, run_id: str) -> DataFrame:
    return audit.where(F.col("run_id") == run_id)
