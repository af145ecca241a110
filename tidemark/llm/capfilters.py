"""Near duplicates among embeddings by spherical-cap filters.

A filter is a direction; a vector passes it when it lies in the cap around it. The directions form a
random product code: the components are cut into parts after a random rotation, each part has random
directions, and every choice of one per part is a filter. Scores add over the parts, so a vector is
list-decoded to all filters above the bound by walking each part's directions from the best one down until
the sum falls short; where fewer than ``LEAST`` pass, its best ones count. Vectors of one label that share a
filter are compared exactly, in double precision. A pair that shares several is counted at the smallest only.

The number of filters follows that of the vectors, and the bound follows both and the dimension, so that a
vector passes about ``PASSED`` filters and a bucket holds about ``BUCKET`` unrelated vectors at any size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import components, ship_code, written

PASSED = 20  # filters that a random vector passes
BUCKET = 512  # unrelated vectors in a bucket, all labels together
MOST_CODES = 1024  # directions of a part, before there is one part more
WIDE = 0.85  # no bound is above it: close vectors share wide caps in few dimensions, too
LEAST = 16
SEED = 11
BLOCK_ROWS = 1024


@dataclass(frozen=True)
class Code:
    """A rotation, and per part its directions, one per column, scaled so that a filter is a unit vector;
    ``alpha``: the bound of a score, in [-1, 1]."""

    rotation: np.ndarray
    books: list[np.ndarray]
    alpha: float


def cap_shares(dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Bounds from 1 down to -1, and the share of all directions whose score with a vector is above each."""
    angle = np.linspace(0, np.pi, 20_001)
    if dims == 1:
        return np.cos(angle), (angle > 0) * 0.5 + (angle == np.pi) * 0.5
    density = np.sin(angle) ** (dims - 2)
    share = np.cumsum(density)
    return np.cos(angle), share / share[-1]


def codebook(dims: int, vectors: int, seed: int = SEED) -> Code:
    """The code for so many vectors of one length. The bound is where ``PASSED`` of all directions lie above
    it; there are fewer directions where it would pass ``WIDE``, as it does in few dimensions."""
    rng = np.random.default_rng([seed, dims])
    rotation = np.linalg.qr(rng.standard_normal((dims, dims)))[0]
    bounds, shares = cap_shares(dims)
    filters = min(max(256, vectors * PASSED // BUCKET), int(PASSED / shares[np.searchsorted(-bounds, -WIDE)]) + 1)
    parts = 1 if dims < 8 else 2
    while parts > 1 and MOST_CODES ** parts < filters:
        parts += 1
    parts = min(parts, dims)
    codes = int(np.ceil(filters ** (1 / parts)))
    books = []
    for part in np.array_split(np.arange(dims), parts):
        book = rng.standard_normal((len(part), codes))
        books.append(book / np.linalg.norm(book, axis=0) / np.sqrt(parts))
    return Code(rotation, books, float(bounds[np.searchsorted(shares, min(0.5, PASSED / codes ** parts))]))


def _passing(sorted_scores: list[np.ndarray], bound: float) -> tuple[np.ndarray, list[np.ndarray]]:
    """All choices of one score per part that sum to the bound or more, the scores of a part falling: the
    sums, and the place of the choice in each part. A prefix is followed down a part for as long as the best
    of the parts to come could still lift it to the bound."""
    rest = np.cumsum([s[0] for s in sorted_scores[::-1]])[::-1]
    sums, places = np.zeros(1), []
    for k, scores in enumerate(sorted_scores):
        after = rest[k + 1] if k + 1 < len(rest) else 0.0
        counts = np.searchsorted(-scores, sums + (after - bound), side="right")
        prefix = np.repeat(np.arange(len(sums)), counts)
        place = np.arange(len(prefix)) - np.repeat(np.cumsum(counts) - counts, counts)
        sums, places = sums[prefix] + scores[place], [p[prefix] for p in places] + [place]
    return sums, places


def decode(unit: np.ndarray, code: Code, least: int = LEAST) -> list[np.ndarray]:
    """Per unit vector the ascending numbers of its filters."""
    turned = unit @ code.rotation
    cuts = np.cumsum([len(b) for b in code.books])[:-1]
    scores = [p @ b for p, b in zip(np.split(turned, cuts, axis=1), code.books)]
    orders = [np.argsort(-s, axis=1, kind="stable") for s in scores]
    scores = [np.take_along_axis(s, o, axis=1) for s, o in zip(scores, orders)]
    codes, out = scores[0].shape[1], []
    wanted = min(least, codes ** len(scores))
    for row in range(len(unit)):
        own, bound, step = [s[row] for s in scores], code.alpha, 0.02
        sums, places = _passing(own, bound)
        while len(sums) < wanted:
            bound, step = bound - step, 2 * step
            sums, places = _passing(own, bound)
        if bound < code.alpha:
            best = np.argsort(-sums, kind="stable")[:wanted]
            places = [p[best] for p in places]
        names = np.zeros(len(places[0]), dtype=np.int64)
        for order, place in zip(orders, places):
            names = names * codes + order[row][place]
        out.append(np.sort(names))
    return out


def _filters(vectors_in_all: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes: dict[int, Code] = {}
        for batch in batches:
            vectors = batch.column("embedding").to_pylist()
            found: list = [None] * len(vectors)
            by_length: dict[int, list[int]] = {}
            for i, v in enumerate(vectors):
                by_length.setdefault(len(v), []).append(i)
            for dims, at in by_length.items():
                if dims not in codes:
                    codes[dims] = codebook(dims, vectors_in_all)
                x = np.array([vectors[i] for i in at], dtype=np.float64)
                x /= np.abs(x).max(axis=1, keepdims=True)  # no overflow in the squares
                for i, f in zip(at, decode(x / np.linalg.norm(x, axis=1, keepdims=True), codes[dims])):
                    found[i] = f
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.list_(pa.int64()))],
                                             names=[*batch.schema.names, "filters"])
    return run


def _links(least: float):
    def run(table: pa.Table) -> pa.Table:
        """Links between the rows of two blocks of one bucket: per row the vectors that it links with,
        and as many links as it takes to join the rows that are linked."""
        name, part, copies = (table.column(n).to_numpy() for n in ("class", "part", "copies"))
        here = table.column("filter")[0].as_py()
        two = table.column("i")[0].as_py() != table.column("j")[0].as_py()
        x = np.array(table.column("embedding").to_pylist(), dtype=np.float64)
        x /= np.abs(x).max(axis=1, keepdims=True)
        norm = np.sqrt((x * x).sum(axis=1))
        filters = [np.asarray(f.values) for f in table.column("filters")]
        smaller = [f[f < here] for f in filters]
        values, at = np.unique(np.concatenate(smaller), return_inverse=True)
        owner = np.repeat(np.arange(len(name)), [len(f) for f in smaller])
        bits = np.zeros((len(name), max(1, -(-len(values) // 64)) * 8), dtype=np.uint8)
        np.bitwise_or.at(bits, (owner, at // 8), (1 << (at % 8)).astype(np.uint8))
        bits = bits.view(np.uint64)
        links, group, a, b = np.zeros(len(name), dtype=np.int64), np.arange(len(name)), [], []
        for i in range(len(name) - 1):
            cosine = (x[i + 1:] @ x[i]) / (norm[i + 1:] * norm[i])
            near = cosine >= least
            if two:
                near &= part[i + 1:] != part[i]
            to = np.flatnonzero(near) + i + 1
            to = to[~(bits[to] & bits[i]).any(axis=1)]
            if not len(to):
                continue
            links[i] += copies[to].sum()
            links[to] += copies[i]
            met, first = np.unique(group[to], return_index=True)
            fresh = met != group[i]
            a += [name[i]] * int(fresh.sum())
            b += name[to[first[fresh]]].tolist()
            group[np.isin(group, met)] = group[i]
        linked = np.flatnonzero(links)
        return pa.table({"a": pa.array([*a, *name[linked].tolist()], pa.int64()),
                         "b": pa.array([*b, *[None] * len(linked)], pa.int64()),
                         "links": pa.array([*[None] * len(a), *links[linked].tolist()], pa.int64())})
    return run


def near_duplicates(vectors: DataFrame, least: float = 0.98, vec: str = "vec_id", embedding: str = "embedding",
                    label: str = "label") -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` per row of ``vectors``.

    Rows link when their labels are equal and the cosine is at least ``least``; pairs are found through
    shared filters. ``component_id`` is the smallest id of all rows that links lead to. Vectors that are null, empty, zero or hold null or non-finite components, and rows
    without label or id, link with nothing; nor do vectors of different lengths. Equal vectors of one
    label always link. Rows that repeat an id are vectors of their own, with links and components of their
    own. Other columns are ignored.
    """
    ship_code(vectors.sparkSession)
    rows = vectors.select(F.col(vec).alias("vec"), F.col(label).alias("label"), F.col(embedding).alias("embedding"))
    sound = F.expr("""vec is not null and label is not null and embedding is not null and size(embedding) > 0
        and forall(embedding, c -> c is not null and not isnan(c) and abs(c) < double('infinity'))
        and exists(embedding, c -> c <> 0)""")
    rows = rows.withColumn("sound", F.coalesce(sound, F.lit(False)))
    good = rows.where("sound")
    classes = written(good.groupBy("label", "embedding").agg(F.min("vec").alias("first"), F.count("*").alias("copies"))
                      .withColumn("class", F.monotonically_increasing_id()), "vectors")
    kinds = dict(classes.dtypes)
    passed = classes.drop("first").mapInArrow(
        _filters(classes.count()), f"label {kinds['label']}, embedding {kinds['embedding']}, copies long, class long, filters array<long>")
    buckets = written(passed.withColumn("filter", F.explode("filters")), "buckets")
    sizes = buckets.groupBy("label", "filter").agg(F.count("*").alias("members")).where("members > 1")
    parts = f"cast((members + {BLOCK_ROWS - 1}) div {BLOCK_ROWS} as int)"
    blocks = (buckets.join(sizes, ["label", "filter"])
              .withColumn("part", F.expr(f"cast(pmod(xxhash64(class), {parts}) as int)"))
              .withColumn("other", F.explode(F.expr(f"sequence(0, {parts} - 1)")))
              .select("label", "filter", F.size("embedding").alias("dims"), F.least("part", "other").alias("i"),
                      F.greatest("part", "other").alias("j"), "class", "copies", "part", "embedding", "filters"))
    found = written(blocks.groupBy("label", "filter", "dims", "i", "j").applyInArrow(_links(least), "a long, b long, links long"), "links")
    joined = components(found.where("b is not null").select("a", "b"))
    counted = found.where("links is not null").groupBy("a").agg(F.sum("links").alias("links"))
    named = written(classes.join(counted, classes["class"] == counted["a"], "left").join(joined, classes["class"] == joined["node"], "left")
                    .select("label", "embedding", "first", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                            F.coalesce("component", "class").alias("component")), "classes")
    firsts = named.groupBy("component").agg(F.min("first").alias("component_id"))
    named = named.drop("first").join(firsts, "component")
    linked = good.join(named, ["label", "embedding"]).select("vec", "n_links", "component_id")
    alone = rows.where("not sound").select("vec", F.lit(0).cast("long").alias("n_links"), F.col("vec").alias("component_id"))
    return linked.unionByName(alone).select(F.col("vec").alias(vec), "n_links", "component_id",
                                            F.coalesce(F.col("vec") == F.col("component_id"), F.lit(True)).alias("kept"))
