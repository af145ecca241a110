"""Shards of near equal bytes by a histogram sort.

Rows are ordered by a key of three numbers: the digest of their group, their id, and a drawn number that
tells copies of one row apart. A splitter is a key; what matters is how many bytes lie below it. Each round
draws candidate keys from the open intervals around the targets, by weight of their bytes, and counts the
exact bytes below every candidate over all partitions; the interval that holds the target is opened next.
A target is met within ``TOLERANCE`` of a shard's even share. Then the rows are exchanged once.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import ship_code, written
from tidemark.llm.hashing import mix
from tidemark.llm.places import in_order, starts
from tidemark.session import shared_dir

TOLERANCE = 0.005  # of a shard's even share
LOOSE = 0.02  # a group is cut only where both its ends are further from the target
FIRST_PROBES = 512
PROBES = 64  # for each target, from the second round on
SEED = 41
SIGN = np.uint64(1 << 63)
LOWEST, HIGHEST = bytes(24), b"\xff" * 24


def _keys(batch: pa.RecordBatch) -> np.ndarray:
    """The rows' keys as 24 bytes whose order is that of (grp, doc, draw)."""
    out = np.empty((batch.num_rows, 3), dtype=">u8")
    for k, name in enumerate(("grp", "doc", "draw")):
        out[:, k] = batch.column(name).to_numpy().astype(np.int64).view(np.uint64) ^ SIGN
    return out.view("S24").ravel()


def _array(keys: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(keys), dtype="S24")


def _counts(probes: list[bytes]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Bytes and rows between neighbouring probes; one row of each a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges = _array(probes)
        held, rows = np.zeros(len(probes) + 1, dtype=np.int64), np.zeros(len(probes) + 1, dtype=np.int64)
        for batch in batches:
            at = np.searchsorted(edges, _keys(batch), side="right")
            np.add.at(held, at, batch.column("size").to_numpy())
            rows += np.bincount(at, minlength=len(rows))
        met = np.flatnonzero(rows)
        yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(held[met]), pa.array(rows[met])], names=["at", "held", "rows"])
    return run


def _draws(spans: list[tuple[bytes, bytes]], most: int, seed: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Per span at most ``most`` of its keys, drawn by weight of their bytes; the least ``priority`` are kept."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, high = _array([s[0] for s in spans]), _array([s[1] for s in spans])
        kept: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0), np.zeros(0, dtype="S24"))] * len(spans)
        for batch in batches:
            keys = _keys(batch)
            at = np.searchsorted(low, keys, side="right") - 1
            inside = np.flatnonzero((at >= 0) & (keys < high[at]))
            if not len(inside):
                continue
            keys, at = keys[inside], at[inside]
            words = keys.view(">u8").reshape(-1, 3).astype(np.uint64)
            drawn = mix(mix(mix(words[:, 0] + np.uint64(seed)) ^ words[:, 1]) ^ words[:, 2])
            chance = ((drawn >> np.uint64(11)).astype(np.float64) + 0.5) / 2 ** 53
            priority = -np.log(chance) / batch.column("size").to_numpy()[inside]
            for span in np.unique(at):
                own = at == span
                p, k = np.concatenate([kept[span][0], priority[own]]), np.concatenate([kept[span][1], keys[own]])
                best = np.argsort(p, kind="stable")[:most]
                kept[span] = p[best], k[best]
        yield pa.RecordBatch.from_pydict({
            "span": pa.array([s for s, (p, _) in enumerate(kept) for _ in p], pa.int32()),
            "priority": pa.array([x for p, _ in kept for x in p], pa.float64()),
            "key": pa.array([bytes(x).ljust(24, b"\0") for _, k in kept for x in k], pa.binary())})
    return run


def _probes_of(key: bytes) -> list[bytes]:
    """The key itself, and the beginnings of its group and of the next one."""
    number = int.from_bytes(key[:8], "big")
    after = [(number + 1).to_bytes(8, "big") + bytes(16)] if number + 1 < 1 << 64 else []
    return [key[:8] + bytes(16), key, *after]


def splitters(keys: DataFrame, shards: int, tolerance: float = TOLERANCE, loose: float = LOOSE, first: int = FIRST_PROBES,
              more: int = PROBES) -> list[bytes]:
    """The ``shards - 1`` keys that cut the rows ``(grp, doc, draw, size)`` into shards of near equal bytes.

    A group stays whole where one of its ends is within ``loose`` of a shard's share of the target. Where no
    key is near enough, because a single row lies across the target, the nearer side of it is taken. The
    same goes for rows of one whole key. The driver sees at most ``3 * more * shards`` sums and ``more * shards`` keys a round.
    """
    known: dict[bytes, int] = {}
    rows_in: dict[bytes, int] = {}
    chosen: dict[int, bytes] = {}
    spans, most, seed, total = [(LOWEST, HIGHEST)], first, SEED, 0
    while spans and shards > 1:
        drawn = keys.mapInArrow(_draws(spans, most, seed), "span int, priority double, key binary")
        best = F.row_number().over(Window.partitionBy("span").orderBy("priority", "key"))
        found = [bytes(r.key) for r in drawn.withColumn("n", best).where(f"n <= {most}").select("key").collect()]
        probes = sorted({LOWEST, *(e for s in spans for e in s), *(p for key in found for p in _probes_of(key))})
        sums = keys.mapInArrow(_counts(probes), "at long, held long, rows long").groupBy("at").agg(
            F.sum("held").alias("held"), F.sum("rows").alias("rows")).collect()
        held, rows = [0] * (len(probes) + 1), [0] * (len(probes) + 1)
        for r in sums:
            held[r["at"]], rows[r["at"]] = r.held, r.rows
        total, below = sum(held), 0
        for n, probe in enumerate(probes):
            below += held[n]
            known[probe], rows_in[probe] = below, rows[n + 1]
        order = sorted(known, key=lambda p: (known[p], p))
        sizes, again = [known[p] for p in order], set()
        for k in range(1, shards):
            if k in chosen or not total:
                continue
            off = lambda p, k=k: abs(known[p] * shards - k * total) / total  # noqa: E731  in shares
            whole = min((p for p in order if not any(p[8:])), key=lambda p: (off(p), p))
            nearest = min(order, key=lambda p: (off(p), p))
            at = bisect_right(sizes, k * total // shards) - 1
            low, high = order[at], order[at + 1] if at + 1 < len(order) else HIGHEST
            # An interval that no probe could narrow holds rows of one key.
            if off(whole) <= tolerance or rows_in[low] <= 1 or off(nearest) <= tolerance or (low, high) in spans:
                chosen[k] = whole if off(whole) <= max(loose, off(nearest)) else nearest
            else:
                again.add((low, high))
        spans, most, seed = sorted(again), more, seed + 1
    return sorted(chosen.values())


def _number(key: bytes, k: int) -> int:
    return int.from_bytes(key[8 * k:8 * k + 8], "big") - (1 << 63)


def shard_of(cuts: list[bytes], grp: str, doc: str, draw: str) -> Column:
    """The number of splitters that are not above the row's key, by halving."""
    if not cuts:
        return F.lit(0)

    def below(cut: bytes) -> Column:
        g, d, r = (F.lit(_number(cut, k)).cast("long") for k in range(3))
        return (F.col(grp) < g) | ((F.col(grp) == g) & ((F.col(doc) < d) | ((F.col(doc) == d) & (F.col(draw) < r))))

    def halve(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(below(cuts[middle]), halve(low, middle)).otherwise(halve(middle + 1, high))
    return halve(0, len(cuts))


def shards(rows: DataFrame, n: int, size: Column, group: Column, key: str, tolerance: float = TOLERANCE) -> DataFrame:
    """The rows as ``n`` shards of near equal sums of ``size``, one folder each in a Parquet table of the
    shared folder: ``row``, the columns given, ``_size``, ``_shard``, and ``_run`` and ``_at`` for :func:`slots`.

    Rows with the same ``group`` value lie side by side; such a group is cut only where it reaches further
    over a shard's border than ``LOOSE`` allows. Within a shard rows follow each other by (digest of the group,
    ``key``); null keys come first; the order among rows equal in both is arbitrary. ``size`` is at least 1.
    The whole rows move once, by ranges of (shard, key), so that a shard, a group of copies or a repeated row of
    any size is spread over many tasks. What the rounds read is 32 bytes a row. An empty table gives no rows.
    """
    ship_code(rows.sparkSession)
    keyed = rows.select(
        F.struct(*rows.columns).alias("row"), size.cast("long").alias("_size"), F.xxhash64(group).alias("_grp"),
        F.coalesce(F.col(key).cast("long"), F.lit(-(1 << 63)).cast("long")).alias("_doc"),
        (F.rand(SEED) * float(1 << 62)).cast("long").alias("_draw"))
    slim = written(keyed.select(*(F.col("_" + c).alias(c) for c in ("grp", "doc", "draw", "size"))), "keys")
    dealt = keyed.withColumn("_shard", shard_of(splitters(slim, n, tolerance), "_grp", "_doc", "_draw"))
    ordered = in_order(dealt, "_shard", ["_grp", "_doc", "_draw"]).drop("_grp", "_doc", "_draw")
    path = shared_dir(rows.sparkSession, "shards")
    ordered.write.partitionBy("_shard").parquet(path)
    return rows.sparkSession.read.schema(ordered.schema).parquet(path)


def slots(stored: DataFrame, rows: DataFrame) -> DataFrame:
    """``rows``, made of the rows of :func:`shards` and still with ``_shard``, ``_run`` and ``_at``, with ``slot``:
    the place in the shard, gapless from 0. What is broadcast has a row for each task and shard at most."""
    return (rows.join(F.broadcast(starts(stored, "_shard")), ["_shard", "_run"])
            .withColumn("slot", F.col("_at") + F.col("_shift")).drop("_run", "_at", "_shift", "total"))
