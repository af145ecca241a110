"""Shards by histogram sort against a plain sort of the rows and a running sum of their bytes."""

from __future__ import annotations

import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import awkward, documents
from tidemark.llm import sharding
from tidemark.llm.queries import QUERIES


def stored(docs, n, **more):
    size = F.coalesce(F.octet_length("text"), F.lit(0)) + 1
    return sharding.shards(docs, n, size, F.col("text"), "doc_id", **more)


def slotted(made):
    rows = made.select("row.doc_id", "row.text", F.col("_size").alias("size"), F.xxhash64("row.text").alias("digest"), "_shard", "_run", "_at")
    return sorted(sharding.slots(made, rows).collect(), key=lambda r: (r["_shard"], r.slot))


def check(got, n, expected):
    """Every row once, slots gapless, shards one after the other in the order of the keys; and the borders:
    at a target, or at the end of a group near it, or as near as any row allows."""
    assert Counter((r.doc_id, r.text) for r in got) == Counter(expected)
    assert [r["_shard"] for r in got] == sorted(r["_shard"] for r in got) and all(0 <= r["_shard"] < n for r in got)
    order = [(r.digest, -(1 << 63) if r.doc_id is None else r.doc_id) for r in got]
    assert order == sorted(order)
    for s in range(n):
        own = [r.slot for r in got if r["_shard"] == s]
        assert own == list(range(len(own)))
    total, below, edges = sum(r.size for r in got), 0, [(0, True)]
    for r, after in zip(got, [*got[1:], None]):
        below += r.size
        edges.append((below, after is None or after.digest != r.digest))
    for k in range(1, n):
        cut = sum(r.size for r in got if r["_shard"] < k)
        off = abs(cut * n - k * total) / total
        nearest = min(abs(e * n - k * total) / total for e, _ in edges)
        whole = min(abs(e * n - k * total) / total for e, ends in edges if ends)
        assert off <= max(sharding.TOLERANCE, sharding.LOOSE if whole <= sharding.LOOSE else 0, nearest) + 1e-12
        if whole <= sharding.TOLERANCE:
            assert dict(edges)[cut]


@pytest.mark.parametrize("n", [1, 2, 8, 13])
def test_query_like_shards_of_documents(spark, n):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    check(slotted(stored(docs, n)), n, [(r.doc_id, r.text) for r in docs.collect()])


def test_hot_texts_ids_and_rows_are_cut(spark):
    """A text of half of all rows under many ids, and one whole row repeated: each reaches over several shards."""
    rows = [(k, "copied text") for k in range(1500)] + [(7, "the same row")] * 1500 + [(k, f"text {k} " * (k % 9)) for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = slotted(stored(docs, 8))
    check(got, 8, rows)
    held = Counter()
    for r in got:
        held[r["_shard"]] += r.size
    assert max(held.values()) <= 1.05 * sum(held.values()) / 8
    assert len({r["_shard"] for r in got if r.text == "the same row"}) >= 3


def test_rounds_refine_until_the_tolerance_is_met(spark):
    """With two probes a round: as good as with many."""
    keys = spark.range(20_000).selectExpr("xxhash64(id) as grp", "id as doc", "0L as draw", "id % 50 + 1 as size")
    cuts = sharding.splitters(keys, 5, first=2, more=2)
    found = keys.select("size", sharding.shard_of(cuts, "grp", "doc", "draw").alias("s")).groupBy("s").agg(F.sum("size").alias("b")).collect()
    even = sum(r.b for r in found) / 5
    assert len(found) == 5 and all(abs(r.b - even) <= 2 * sharding.TOLERANCE * even for r in found)


def test_rows_of_one_whole_key_end_the_search(spark):
    keys = spark.range(3000).selectExpr("if(id < 2500, 7, id) as grp", "1L as doc", "0L as draw", "1L as size")
    cuts = sharding.splitters(keys, 4)
    found = keys.select(sharding.shard_of(cuts, "grp", "doc", "draw").alias("s")).groupBy("s").count().collect()
    assert sum(r["count"] for r in found) == 3000 and len(cuts) == 3


def test_awkward_rows(spark, odd, nothing):
    got = slotted(stored(odd.withColumn("_size", F.lit("x")).withColumn("row", F.lit(1)).withColumn("_run", F.lit(2)), 4))
    check(got, 4, [(r.doc_id, r.text) for r in odd.collect()])
    assert len(got) == len(awkward())
    assert slotted(stored(nothing, 4)) == []
    assert {r["_shard"] for r in slotted(stored(documents(spark, [(1, "one")]), 4))} <= {0, 1, 2, 3}


def test_query(spark):
    sf_dir = "/root/testdata/sf0.01"
    got = QUERIES["op12_histogram_shards"](spark, sf_dir)
    assert dict(got.dtypes) == {"doc_id": "bigint", "size": "bigint", "text_crc32": "bigint", "law": "string", "shard": "int",
                                "slot": "bigint", "grown_shard": "int"}
    texts = {r.doc_id: r.text.encode() for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = got.collect()
    assert len(rows) == len(texts) and {r.doc_id for r in rows} == set(texts)
    assert all((r["size"], r.text_crc32, r.law, r.grown_shard) == (len(texts[r.doc_id]) + 1, zlib.crc32(texts[r.doc_id]), "bytes", None) for r in rows)
