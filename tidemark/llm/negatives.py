"""Hard negatives by exact search in an inverted multi-index.

Vectors are cut in two halves, each with a codebook of its own; a pair of codes is a cell. Every code keeps
the greatest distance of a row's half from it, over all rows, so ``<query half, code> + |query half| * radius``
bounds the half score of all its rows, and the sum of two such bounds that of a cell's rows. A multi-sequence
heap gives an anchor its cells by falling bound. Anchors ask for a few cells, then for more, round by round;
rows of asked cells are scored exactly, in integers; and an anchor is done when the bound of its next cell
certifies that no row left can enter any of its windows.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import ship_code, written

SCALE = 256
LIMIT = (1 << 27) - 1  # of a scaled component: sums of 512 products fit 63 bits
SAMPLE_ROWS = 16_384  # that the codebooks are fitted on
SAMPLE_DIMS = 4096  # longer vectors are not sampled; they share one code each half
CODE_VALUES = 1 << 20  # numbers in the codebooks of one length
CELL_ROWS = 512  # wanted in a cell, on average
BLOCK_ROWS = 256
PART_BLOCKS = 64  # blocks of a cell that meet the same copy of its requests
CHUNK = 128  # anchors in a request
FIRST_CELLS, MOST_CELLS = 32, 4096  # an anchor asks for in the first and in any round
HELD = 50_000  # windows that a task keeps before it gives out what it has
SEED = 29


@dataclass
class Book:
    """Codes of the two halves of vectors of one length, and the radius of each; negative where it has no row."""

    codes: tuple[np.ndarray, np.ndarray]
    radii: tuple[np.ndarray, np.ndarray] = field(default=(np.zeros(0), np.zeros(0)))


def _halves(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return x[:, :x.shape[1] // 2], x[:, x.shape[1] // 2:]


def _nearest(x: np.ndarray, codes: np.ndarray) -> np.ndarray:
    return np.argmin((codes * codes).sum(axis=1) - 2 * (x @ codes.T), axis=1)


def _codes(x: np.ndarray, k: int, rounds: int = 10) -> np.ndarray:
    """At most ``k`` centres by Lloyd's rounds from rows drawn once."""
    start = np.unique(x, axis=0)
    codes = start[np.random.default_rng(SEED).permutation(len(start))[:k]]
    for _ in range(rounds):
        at = _nearest(x, codes)
        sums = np.zeros_like(codes)
        np.add.at(sums, at, x)
        count = np.bincount(at, minlength=len(codes))
        codes = np.where(count[:, None] > 0, sums / np.maximum(count, 1)[:, None], codes)
    return codes


def _blank(dims: int) -> Book:
    return Book((np.zeros((1, dims // 2)), np.zeros((1, dims - dims // 2))))


def _vectors(column: pa.Array) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """The rows of a list column by length: their numbers and the matrix of their components."""
    sizes = np.diff(column.offsets.to_numpy())
    flat, begin = column.values.to_numpy(), column.offsets.to_numpy()
    out = {}
    for dims in np.unique(sizes):
        at = np.flatnonzero(sizes == dims)
        out[int(dims)] = at, flat[begin[at][:, None] + np.arange(dims)]
    return out


def _assign(books: dict[int, Book]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            code, far = np.zeros((2, n), dtype=np.int32), np.zeros((2, n))
            for dims, (at, x) in _vectors(batch.column("q")).items():
                for h, (half, codes) in enumerate(zip(_halves(x.astype(np.float64)), books.get(dims, _blank(dims)).codes)):
                    code[h, at] = _nearest(half, codes)
                    far[h, at] = np.linalg.norm(half - codes[code[h, at]], axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, (*code, *far))],
                                             names=[*batch.schema.names, "c1", "c2", "r1", "r2"])
    return run


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows as blocks of one cell each."""
    cell, kept = None, []

    def block() -> pa.RecordBatch:
        vec, label, q = zip(*kept)
        return pa.RecordBatch.from_pydict({
            **{n: pa.array([v], pa.int32()) for n, v in zip(("dims", "c1", "c2"), cell)},
            "vecs": [np.array(vec, dtype=np.int64).tobytes()], "labels": [np.array(label, dtype=np.int64).tobytes()],
            "q": [np.array(q, dtype=np.int32).tobytes()]})

    for batch in batches:
        for dims, c1, c2, vec, label, q in zip(*(batch.column(n).to_pylist() for n in ("dims", "c1", "c2", "vec", "label", "q"))):
            if kept and (cell != (dims, c1, c2) or len(kept) >= BLOCK_ROWS):
                yield block()
                kept.clear()
            cell = dims, c1, c2
            kept.append((vec, label, q))
    if kept:
        yield block()


@dataclass
class Index:
    """``rows``: (vec, label, q, dims, c1, c2); ``blocks``: packed rows of a cell, dealt to its parts; ``parts``:
    (dims, c1, c2, parts) of every cell that has rows; books of the lengths in the sample, and at 0 the radii
    that hold for all other lengths."""

    rows: DataFrame
    blocks: DataFrame
    parts: DataFrame
    books: dict[int, Book]


def index(vectors: DataFrame, vec: str = "vec_id", embedding: str = "embedding", label: str = "label") -> Index:
    """The index over all rows that have an id, a label and a vector of finite components.

    Components become ``floor(256 * x)``, held to 27 bits, which vectors of |x| < 524,288 never reach. Rows that
    repeat id, label and vector count once. Labels that are no integers go by a 64-bit digest. Codebooks are
    fitted on at most ``SAMPLE_ROWS`` rows, chosen by hash; radii are those of all rows.
    """
    ship_code(vectors.sparkSession)
    kind = dict(vectors.dtypes)[label]
    named = F.col(label).cast("long") if kind in ("tinyint", "smallint", "int", "bigint") else F.xxhash64(label)
    sound = F.expr(f"""`{vec}` is not null and `{label}` is not null and `{embedding}` is not null
        and forall(`{embedding}`, c -> c is not null and not isnan(c) and abs(c) < double('infinity'))""")
    whole = F.transform(embedding, lambda x: F.least(F.greatest(F.floor(x.cast("double") * SCALE), F.lit(-LIMIT)), F.lit(LIMIT)).cast("int"))
    slim = written(vectors.where(sound).select(F.col(vec).cast("long").alias("vec"), named.alias("label"), whole.alias("q"))
                   .distinct().withColumn("dims", F.size("q")), "integers")
    n = slim.count()
    drawn = slim.where(F.col("dims") <= SAMPLE_DIMS).orderBy(F.xxhash64("vec", "label", "q")).limit(SAMPLE_ROWS).select("q").toArrow()
    books = {}
    for dims, (_, x) in _vectors(drawn.column("q").combine_chunks()).items():
        most = max(1, min(math.ceil(math.sqrt(n / CELL_ROWS)), CODE_VALUES // max(1, dims)))
        books[dims] = Book(tuple(_codes(half.astype(np.float64), most) for half in _halves(x)))
    rows = written(slim.mapInArrow(_assign(books), "vec long, label long, q array<int>, dims int, c1 int, c2 int, r1 double, r2 double"), "cells")
    known = F.when(F.col("dims").isin(list(books)), F.col("dims")).otherwise(0).alias("dims")
    for h in (1, 2):
        most = rows.groupBy(known, F.col(f"c{h}").alias("c")).agg(F.max(f"r{h}").alias("r")).collect()
        for dims in {0, *books}:
            book = books.setdefault(dims, _blank(0))
            radii = np.full(max(1, len(book.codes[h - 1])), -1.0)
            for r in most:
                if r.dims == dims:
                    radii[r.c] = r.r
            book.radii = (radii, book.radii[1]) if h == 1 else (book.radii[0], radii)
    parts = written(rows.groupBy("dims", "c1", "c2").agg(F.expr(f"cast(1 + (count(*) - 1) div {PART_BLOCKS * BLOCK_ROWS} as int)").alias("parts")), "parts")
    ranged = (rows.select("dims", "c1", "c2", "vec", "label", "q", F.xxhash64("vec").alias("h"))
              .repartitionByRange("dims", "c1", "c2", "h").sortWithinPartitions("dims", "c1", "c2", "h"))
    blocks = ranged.mapInArrow(_pack, "dims int, c1 int, c2 int, vecs binary, labels binary, q binary")
    blocks = written(blocks.join(parts, ["dims", "c1", "c2"]).withColumn("part", F.expr("cast(pmod(xxhash64(vecs), parts) as int)")).drop("parts"), "blocks")
    return Index(rows.drop("r1", "r2"), blocks, parts, books)


def cells(bounds: tuple[np.ndarray, np.ndarray]) -> Iterator[tuple[int, int, float]]:
    """Pairs of codes by falling sum of their bounds; codes of bound -inf are left out."""
    first, second = (np.argsort(-b, kind="stable")[:int(np.isfinite(b).sum())] for b in bounds)
    if not len(first) or not len(second):
        return
    x, y = bounds[0][first], bounds[1][second]
    heap = [(-(x[0] + y[0]), 0, 0)]
    while heap:
        bound, i, j = heapq.heappop(heap)
        yield int(first[i]), int(second[j]), -bound
        if j + 1 < len(second):
            heapq.heappush(heap, (-(x[i] + y[j + 1]), i, j + 1))
        if j == 0 and i + 1 < len(first):  # every pair is pushed once, by its left neighbour or from the row above
            heapq.heappush(heap, (-(x[i + 1] + y[0]), i + 1, 0))


def half_bounds(q: np.ndarray, book: Book) -> tuple[np.ndarray, np.ndarray]:
    """Upper bounds of a vector's half scores with the rows of each code, rounding included."""
    out = []
    for half, codes, radii in zip(_halves(q[None]), book.codes, book.radii):
        size = np.linalg.norm(half)
        bound = codes @ half[0] + size * radii
        slack = 1e-9 * (size * (np.linalg.norm(codes, axis=1) + np.abs(radii)) + 1)
        out.append(np.where(radii < 0, -np.inf, bound + slack))
    return out[0], out[1]


def _walk(books: dict[int, Book], first: int, count: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Per anchor its cells number ``first`` to ``first + count``, and the bound of the one after them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            c1, c2, ends, bounds = [], [], [0], []
            for row in batch.column("q").to_pylist():
                q = np.array(row, dtype=np.float64)
                book = books.get(len(q)) if len(q) else None
                if book is None:
                    book = Book(_blank(len(q)).codes, books[0].radii)
                after = -math.inf
                for n, (i, j, bound) in enumerate(cells(half_bounds(q, book))):
                    if n == first + count:
                        after = bound
                        break
                    if n >= first:
                        c1.append(i)
                        c2.append(j)
                ends.append(len(c1))
                bounds.append(after)
            pairs = pa.StructArray.from_arrays([pa.array(c1, pa.int32()), pa.array(c2, pa.int32())], names=["c1", "c2"])
            yield pa.RecordBatch.from_arrays(
                [batch.column("aid"), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pairs), pa.array(bounds, pa.float64())],
                names=["aid", "cells", "bound"])
    return run


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products in whole numbers; by floating point where that is exact."""
    most = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if most < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


def _score(k: int, same: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The best ``k`` rows of each window among the blocks that a task meets."""
    def out(best: dict) -> pa.RecordBatch:
        names = [(aid, slot) for (aid, slot), (s, _) in best.items() for _ in s]
        return pa.RecordBatch.from_arrays(
            [pa.array([a for a, _ in names], pa.int64()), pa.array([s for _, s in names], pa.int32()),
             pa.array(np.concatenate([v for _, v in best.values()] or [np.zeros(0, dtype=np.int64)])),
             pa.array(np.concatenate([s for s, _ in best.values()] or [np.zeros(0, dtype=np.int64)]))], names=["aid", "slot", "vec", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for n in range(batch.num_rows):
                vecs, labels = (np.frombuffer(batch.column(c)[n].as_buffer(), dtype=np.int64) for c in ("vecs", "labels"))
                x = np.frombuffer(batch.column("q")[n].as_buffer(), dtype=np.int32).reshape(len(vecs), -1)
                asked = batch.column("asked")[n].values
                aid, own, label = (asked.field(c).to_numpy() for c in ("aid", "vec", "label"))
                q = asked.field("q").flatten().to_numpy().reshape(len(aid), -1)
                wants = asked.field("wants")
                ends = wants.offsets.to_numpy() - wants.offsets[0].as_py()
                owner = np.repeat(np.arange(len(aid)), np.diff(ends))
                flat = wants.flatten()
                slot, high, need = (flat.field(c).to_numpy() for c in ("slot", "high", "need"))
                need = need.copy()
                for w in range(len(slot)):
                    held = best.get((aid[owner[w]], slot[w]))
                    if held is not None and len(held[0]) == k:
                        need[w] = max(need[w], held[0][-1])
                fits = (labels == label[:, None]) & (vecs != own[:, None]) if same else labels != label[:, None]
                scores = _product(q, x)[owner]
                met = fits[owner] & (scores >= need[:, None]) & (scores <= high[:, None])
                for w in np.flatnonzero(met.any(axis=1)):
                    s, v = scores[w][met[w]], vecs[met[w]]
                    name = aid[owner[w]], slot[w]
                    if name in best:
                        s, v = np.concatenate([best[name][0], s]), np.concatenate([best[name][1], v])
                    order = np.lexsort((v, -s))[:k]
                    best[name] = s[order], v[order]
                if len(best) >= HELD:
                    yield out(best)
                    best = {}
        yield out(best)
    return run


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("aid", "slot").orderBy(F.desc("score"), "vec")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(of: Index, anchors: DataFrame, windows: DataFrame, k: int, same: bool) -> DataFrame:
    """``(aid, slot, vec, score, rank)``: per window ``(aid, slot, low, high)`` of an anchor ``(aid, vec, label, q,
    dims)`` the first ``k`` rows by score, then id, of its label (not of its id) or of other labels, whose score
    lies in the window.

    Exact: a window closes when it has ``k`` rows above the bound of the anchor's next cell, or when that bound is
    below the window, or no cell is left. A round asks for four times the cells of the last one. A cell's rows
    come in blocks, its anchors in chunks, and a cell of very many blocks in parts that have the requests each.
    """
    spark = anchors.sparkSession
    chunks = max(1, -(-anchors.count() // CHUNK))
    found = spark.createDataFrame([], "aid long, slot int, vec long, score long, rank int")
    open_, first, count = windows.where("low <= high").withColumn("need", F.col("low")), 0, FIRST_CELLS
    open_ = written(open_, "windows")
    while not open_.isEmpty():
        wants = open_.groupBy("aid").agg(F.collect_list(F.struct("slot", "high", "need")).alias("wants"))
        plan = written(anchors.join(open_.select("aid").distinct(), "aid", "left_semi").select("aid", "q").mapInArrow(
            _walk(of.books, first, count), "aid long, cells array<struct<c1: int, c2: int>>, bound double"), "plan")
        asked = (plan.select("aid", F.explode("cells").alias("cell")).join(anchors, "aid").join(wants, "aid")
                 .select("dims", "cell.c1", "cell.c2", F.pmod(F.xxhash64("aid"), F.lit(chunks)).alias("chunk"),
                         F.struct("aid", "vec", "label", "q", "wants").alias("one"))
                 .groupBy("dims", "c1", "c2", "chunk").agg(F.collect_list("one").alias("asked"))
                 .join(of.parts, ["dims", "c1", "c2"])
                 .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts", "chunk"))
        hits = of.blocks.join(asked, ["dims", "c1", "c2", "part"]).select("vecs", "labels", "q", "asked").mapInArrow(
            _score(k, same), "aid long, slot int, vec long, score long")
        found = written(_best(found.drop("rank").unionByName(hits), k), "found")
        least = found.groupBy("aid", "slot").agg(F.count("*").alias("n"), F.min("score").alias("least"))
        full = F.coalesce(F.col("n") == k, F.lit(False))
        open_ = written(open_.drop("need").join(plan.select("aid", "bound"), "aid").join(least, ["aid", "slot"], "left")
                        .where(~((F.col("bound") == float("-inf")) | (F.col("bound") < F.col("low")) | (full & (F.col("least") > F.col("bound")))))
                        .select("aid", "slot", "low", "high", F.when(full, F.col("least")).otherwise(F.col("low")).alias("need")), "windows")
        first, count = first + count, min(4 * count, MOST_CELLS)
    return found


def _floor(number: str, by: int) -> str:
    """Whole-number division that rounds down."""
    return f"(({number}) - pmod({number}, {by}L)) div {by}"


def hard_negatives(vectors: DataFrame, anchor: Column, low: int = 30, high: int = 90, positives: int = 5, negatives: int = 10,
                   vec: str = "vec_id", embedding: str = "embedding", label: str = "label") -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``: for each row that
    ``anchor`` (a condition on ``vec``, the id) picks and each of its first ``positives`` other rows of its label,
    the first ``negatives`` rows of other labels whose score is ``low`` to ``high`` percent of the positive's.

    Scores are inner products of whole numbers (:func:`index`); ties go to the smaller id. Rows without id, label
    or vector, or with null or non-finite components, take no part; rows of an anchor's own id are no positives of
    it; vectors of different lengths never meet; an empty vector scores 0. A positive of a score below 0 has no
    window. Rows that repeat an id with another label or vector are rows, and anchors, of their own. Tables
    without rows or anchors give none. Other columns are ignored.
    """
    of = index(vectors, vec, embedding, label)
    chosen = written(of.rows.where(anchor).select(F.monotonically_increasing_id().alias("aid"), "vec", "label", "q", "dims"), "anchors")
    every = F.lit(1 << 62)
    near = search(of, chosen, chosen.select("aid", F.lit(0).alias("slot"), (-every).alias("low"), every.alias("high")), positives, True)
    pairs = written(near.select("aid", F.col("rank").cast("int").alias("slot"), F.col("vec").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    windows = pairs.select("aid", "slot", F.expr(f"-({_floor(f'-{low}L * positive_score', 100)})").alias("low"),
                           F.expr(_floor(f"{high}L * positive_score", 100)).alias("high"))
    found = search(of, chosen, windows, negatives, False)
    return (found.join(pairs, ["aid", "slot"]).join(chosen.select("aid", F.col("vec").alias("anchor_id")), "aid")
            .select("anchor_id", "positive_id", "rank", F.col("vec").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")))
