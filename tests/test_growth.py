"""Steps whose cost must not outgrow their input: what is moved, and what comes of it."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import functions as F

from checks import fills
from tidemark.operators import convert, fill, ingest
from tidemark.plans import jobs
from tidemark.session import shared_dir
from tidemark.sources import landing
from tidemark.sources.store import Store

UTC = dt.timezone.utc
RUN_TS = dt.datetime(2024, 6, 3, tzinfo=UTC)


def rows(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=repr)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_keys_are_packed_and_unpacked_without_loss(spark):
    keys = ["a" * 64, "A" * 64, "0" * 63, "", "x", "é", "0" * 32, None]
    df = spark.createDataFrame([(k,) for k in keys], "k string").withColumn("p", ingest.packed_key("k"))
    got = df.select("k", "p", ingest.unpacked_key(F.col("p")).alias("back")).collect()
    assert all(r.k == r.back for r in got) and len({bytes(r.p) for r in got if r.p is not None}) == len(keys) - 1
    assert len(got[0].p) == 32


def test_first_unseen_is_first_by_key_then_unseen_in_one_shuffle(spark):
    key = F.sha2(F.concat(F.lit("k"), (F.col("id") % 40).cast("string")), 256)
    new = spark.range(100).select(key.alias("h"), "id", (F.col("id") % 3).alias("v"))
    new = new.unionByName(spark.createDataFrame([("new", 500, 1), ("new", 400, 2), ("old", 600, 1), (None, 700, 1)], new.schema))
    stored = spark.range(20).select(key.alias("h")).union(spark.createDataFrame([("old",), (None,)], "h string"))
    got = ingest.first_unseen(new, stored, "h", ["id"])
    assert rows(got) == rows(ingest.unseen(ingest.first_by_key(new, ["h"], ["id"]), stored, "h")) and got.count() == 22
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shuffles = plan(ingest.first_unseen(new, stored, "h", ["id"])).count("Exchange hashpartitioning")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert shuffles == 2  # one for each side


def test_the_newest_filled_rows_need_no_whole_grid(spark):
    day = lambda text: None if text is None else dt.date.fromisoformat(text)
    data = [("A", "2020-01-01", 1.0, None), ("A", "2023-06-01", 5.0, 7.0), ("A", "2024-01-05", 2.0, None), ("A", "2024-01-07", None, 3.0),
            ("B", "2024-02-29", 4.0, 1.0), ("C", "2010-01-01", 1.0, 2.0), ("C", "2024-01-01", 3.0, None), (None, "2020-01-01", 1.0, 1.0),
            (None, "2022-01-01", 3.0, 1.0), ("D", None, 1.0, 1.0), ("D", "2024-01-01", 2.0, 2.0), ("E", "2024-01-01", None, None)]
    df = spark.createDataFrame([(k, day(d), a, b) for k, d, a, b in data], "k string, day date, a double, b double")
    newest = lambda found, n: sorted(
        (r for k in {r[0] for r in found} for r in sorted((x for x in found if x[0] == k), key=lambda x: x[1], reverse=True)[:n]), key=repr)
    for calendar in ("business", "sixdays", "sevendays"):
        for method in ("forward", "backward", "average", "interpolate"):
            whole = [tuple(r) for r in fill.fill_all(df, ["k"], "day", ["a", "b"], method, calendar).collect()]
            for n in (1, 5, 23):
                late = [tuple(r) for r in fill.fill_all(df, ["k"], "day", ["a", "b"], method, calendar, newest=n).collect()]
                assert set(late) <= set(whole) and newest(late, n) == newest(whole, n)
                assert len(late) <= 5 * (7 * (n // 5 + 1) + 1) < len(whole)


def test_few_ranges_test_the_stored_rows(spark):
    months = [dt.datetime(2015 + m // 12, m % 12 + 1, 3, tzinfo=UTC) for m in range(60)]
    stored = spark.createDataFrame([(f"k{i}", t, t.date().replace(day=1)) for i, t in enumerate(months)],
                                   "price_hash string, tradedatetimeutc timestamp, trade_month date")
    near = jobs.near_in_time(stored, stored, jobs.PRICES)
    assert near.count() == 60
    assert near._jdf.queryExecution().analyzed().toString().count(">=") <= 8
    one = stored.where("price_hash in ('k3', 'k50')")
    assert {r.price_hash for r in jobs.near_in_time(stored, one, jobs.PRICES).collect()} == {"k3", "k50"}


def test_no_line_of_a_landing_is_sorted(spark, monkeypatch):
    """What landed files are is told by a few of their lines."""
    path = shared_dir(spark, "heads")
    lines = ["", "  ", "a,b", *[f"{i},{i}" for i in range(5000)]]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    spark.createDataFrame([(x,) for x in ["\t", " \t{", "1,2"]], "value string").coalesce(1).write.mode("append").text(path)
    spark.createDataFrame([(x,) for x in ["c,d", "1,2"]], "value string").coalesce(1).write.mode("append").text(path)
    heads = landing._heads(spark, path)
    assert heads.count() <= 100 + 3 + 2 and heads.where("named").count() == 3
    reasons = sorted(r.reason for r in landing.refused_files(spark, path, ["a", "b"]).collect())
    assert reasons == ["error payload", "unexpected header"]


def test_keys_are_not_staged_and_do_not_travel(spark, monkeypatch):
    """The staging holds no key, and the stored rows have theirs."""
    kept = []
    monkeypatch.setattr(jobs, "remove_folder", lambda spark, path: kept.append(path))
    t = dt.datetime(2024, 1, 1, tzinfo=UTC)
    landed = spark.createDataFrame([("A", t, 1.0), ("a ", t, 2.0), ("B", t, 3.0), (None, t, 4.0)], "symbol string, tradedatetimeutc timestamp, close double")
    store = Store(shared_dir(spark, "store"))
    totals = jobs.run_ingest(spark, landed, jobs.PRICES, store, "r", RUN_TS)
    assert totals == {"inserted": 2, "skipped": 1, "failed": 1}
    assert "price_hash" not in spark.read.parquet(kept[0]).columns
    want = jobs.keyed(landed, jobs.PRICES).where("reason is null").select("price_hash").distinct()
    assert rows(store.read(spark, "prices").select("price_hash")) == rows(want)
    assert re.fullmatch("[0-9a-f]{64}", store.read(spark, "prices").first().price_hash)


def test_a_dense_right_side_is_not_carried_to_the_cuts(spark, monkeypatch):
    """Of a right row every 10 ms only those are cut and merged that a left row asks for, and one for ten seconds."""
    kept = []
    monkeypatch.setattr(convert, "shared_dir", lambda spark, label: kept.append((label, shared_dir(spark, label))) or kept[-1][1])
    start = dt.datetime(1969, 12, 31, 23, 59, 30, tzinfo=UTC)
    at = lambda seconds: start + dt.timedelta(seconds=seconds)
    key = F.element_at(F.array(F.lit("A"), F.lit("B"), F.lit(None)), (F.col("id") % 3 + 1).cast("int"))
    right = spark.range(6000).select(key.alias("k"), F.timestamp_micros(F.lit(-30000000) + F.col("id") * 10000).alias("ts"), F.col("id").alias("v"))
    asked = [("A", -1.0), ("A", 0.0), ("A", 0.029), ("A", 0.03), ("B", 29.995), ("B", 30.01), ("B", 31.7), ("A", 59.0), ("A", 90.0), ("B", 4000.0), ("C", 5.0)]
    rows_ = [(k, at(s), i) for i, (k, s) in enumerate(asked)] + [(None, at(5), 20), ("A", None, 21), (None, None, 22)]
    rows_ += [("B", at(45), 100 + i) for i in range(700)]
    left = spark.createDataFrame(rows_, "k string, ts timestamp, n int")
    got = {r.n: r.v for r in convert.as_of_merge(left, right, ["k"], "ts", ["v"]).collect()}
    known = {"A": [(at(i / 100), i) for i in range(0, 6000, 3)], "B": [(at(i / 100), i) for i in range(1, 6000, 3)]}
    want = {n: max((v for x, v in known.get(k, []) if t is not None and x <= t), default=None) for k, t, n in rows_}
    assert got == want
    merged = spark.read.parquet(next(path for label, path in kept if label == "merge"))
    assert merged.where("_side = 1").count() == len(rows_) and merged.where("_side = 0").count() <= len(asked) + 1 + 2 * 7


def test_quotes_of_seconds_are_made_where_their_ticks_moved(spark):
    micros = [0, 1, 19, 20, 5_000_000, 5_000_001, 19_000_000, 24_000_000, 25_000_000, 41_000_000, 59_000_000, 59_500_000, 60_000_000, 61_500_000, 78_000_000,
              -1, -500_000, -1_500_000, -59_000_000, -60_000_000, -61_000_000, 0, 5_000_000, 86_400_000_000]
    data = [(k, m, None if i % 11 == 3 else float("nan") if i % 13 == 5 else 0.1 * (i * 7 % 23), i) for k in ("A", "B", None) for i, m in enumerate([*micros, None, None])]
    ticks = spark.createDataFrame(data, "symbol string, m long, last double, seq int").withColumn("ts", F.timestamp_micros("m")).drop("m")
    plain = ticks.withColumn("s", F.explode(F.sequence(F.lit(0), F.lit(19)))).groupBy(
        "symbol", (F.col("ts") + F.make_dt_interval(secs=F.col("s"))).alias("ts")).agg(F.max(F.col("last") + F.col("s")).alias("quote"))
    assert list(map(repr, rows(fills.quotes_of_seconds(ticks)))) == list(map(repr, rows(plain)))
    moved = plan(fills.quotes_of_seconds(ticks))
    assert "sequence(" in moved and moved.rindex("Exchange hashpartitioning") > moved.index("sequence(")
