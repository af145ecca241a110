"""N-gram Jaccard join: a blocked sparse product of the document by n-gram incidence matrix.

Rows of the matrix are the distinct shingle sets ("classes": documents with the same set are one row),
columns are shingles. The columns are cut into blocks by the top bits of the shingle hash, and a block
is packed per map task: class ids, counts and 6-byte hashes.

1. *Column counts.* A block's task finds the columns that at least two classes share; other columns add
   nothing to any overlap. A column shared within one map task is known to be shared there: its entries
   skip the block's task, which only gets one marker per map task, however frequent the shingle is.
2. *Row bound.* A pair at similarity s has an overlap of at least s times the larger set, so a class
   with fewer shared columns than ``ceil(s * size)`` has no partner and is dropped.
3. *Product over the leading columns.* Two classes that reach the bound share a column among the first
   ``shared - ceil(s * size) + 1`` of either, frequent columns last, so that a passage that many classes
   hold leads none that has other columns. First every class meets one
   centre per column, size class and seed, which is linear in the entries; the links found give
   components. Then all pairs that lie in different components and share a leading column are taken,
   cut by the size bound and by what is left of both rows after that column.
4. *Exact overlap.* The remaining columns of the surviving pairs are counted in full.

Columns with many members in several components are not expanded into pairs: their rows are multiplied
in blocks of ``BLOCK_ROWS`` by ``BLOCK_ROWS``, as bit rows, and only links that join two components leave
the task.

A column is known by the bits of its block and 48 more, 54 at least: two different shingles of one pair
fall together with a probability of about ``size^2 / 2^54``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import components, free_name, pieces, release, ship_code, written
from tidemark.llm.hashing import shingle_sets

BLOCK_BYTES = 16 << 20  # text per column block
PIECE_BYTES = 6 << 20  # text per packed map-side piece
LEAST_BITS = 6
SIZE_STEP = 1.25
SEEDS = 3
FREQUENT = 64  # entries from which on a column's frequency counts for its place
#: Frequent columns, of 16 bytes, up to which they are broadcast; beyond, both sides are shuffled.
BROADCAST_COLUMNS = 500_000
LONG_COLUMN = 64  # members from which on a leading column's pairs are taken in numpy blocks
BLOCK_ROWS = 1024
PACKED = "block int, docs binary, sizes binary, classes binary, counts binary, hashes binary, shared binary"
FOUND = "class long, doc long, tag long, size int, columns array<long>"


def _six(h: np.ndarray, bits: int) -> bytes:
    """The 48 bits that follow the ``bits`` bits of the block."""
    low = (h << np.uint64(bits)).astype(">u8").view(np.uint8).reshape(-1, 8)
    return np.ascontiguousarray(low[:, :6]).tobytes()


def _wide(packed: bytes, block: int, bits: int) -> np.ndarray:
    """Column ids of a block: its bits and the packed ones."""
    out = np.zeros((len(packed) // 6, 8), dtype=np.uint8)
    out[:, :6] = np.frombuffer(packed, dtype=np.uint8).reshape(-1, 6)
    low = out.reshape(-1).view(">u8").astype(np.uint64) >> np.uint64(bits)
    return (low | np.uint64(block << (64 - bits))).view(np.int64)


def _owners(classes: bytes, counts: bytes) -> np.ndarray:
    """The class of every entry; without counts they are listed one by one."""
    names = np.frombuffer(classes, np.int64)
    return np.repeat(names, np.frombuffer(counts, np.int32)) if counts else names


def _pack(docs: list, tags: np.ndarray, sets: list[np.ndarray], bits: int) -> Iterator[dict]:
    """One piece of documents as rows of ``PACKED``: a row per column block, and a row that passes by."""
    names = np.array([int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True)
                      if len(s) else 0 for s in sets], dtype=np.int64)
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    classes, first = np.unique(names[sizes > 0], return_index=True)
    rows = np.flatnonzero(sizes > 0)[first]
    column = np.concatenate([sets[r] for r in rows]) if len(rows) else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(len(rows)), sizes[rows])
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    new = np.concatenate([[True], column[1:] != column[:-1]]) if len(column) else np.zeros(0, bool)
    run = np.cumsum(new) - 1
    many = np.bincount(run)[run] > 1 if len(run) else new
    blocks = 1 << bits
    block = (column >> np.uint64(64 - bits)).astype(np.int64)

    def entries(pick: np.ndarray) -> dict:
        """Entries of one block grouped by class, or class by class where that is shorter."""
        by = np.argsort(owner[pick], kind="stable")
        who, what = owner[pick][by], column[pick][by]
        present, count = np.unique(who, return_counts=True)
        if 8 * len(who) <= 12 * len(present):
            return {"classes": classes[who].tobytes(), "counts": b"", "hashes": _six(what, bits)}
        return {"classes": classes[present].tobytes(), "counts": count.astype(np.int32).tobytes(),
                "hashes": _six(what, bits)}

    empty = {"docs": b"", "sizes": b"", "shared": b""}
    # What needs no other task passes by, in groups of their own beyond the blocks.
    known = np.array([d is not None for d in docs], dtype=bool)
    yield empty | entries(np.zeros(0, np.int64)) | {
        "block": blocks + int(abs(names[0])) % blocks, "sizes": sizes.astype(np.int32).tobytes(),
        "docs": np.array([0 if d is None else d for d in docs], dtype=np.int64).tobytes()
        + names.tobytes() + tags.tobytes() + known.tobytes()}
    cuts = np.searchsorted(block, np.arange(blocks + 1))
    for b in np.flatnonzero(np.diff(cuts)).tolist():
        at = slice(cuts[b], cuts[b + 1])
        lone = np.arange(at.start, at.stop)[~many[at]]
        marks = np.arange(at.start, at.stop)[many[at] & new[at]]
        yield empty | entries(lone) | {"block": b, "shared": _six(column[marks], bits)}
        if many[at].any():
            yield empty | entries(np.arange(at.start, at.stop)[many[at]]) | {"block": blocks + b}


def _incidence(size: int, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("block", pa.int32())] + [
            (n, pa.binary()) for n in ("docs", "sizes", "classes", "counts", "hashes", "shared")])
        for batch in batches:
            docs, tags = batch.column(0).to_pylist(), batch.column(2).to_numpy()
            for first, texts in pieces(batch.column(1), PIECE_BYTES):
                sets, own = list(shingle_sets(texts, size)), slice(first, first + len(texts))
                yield pa.RecordBatch.from_pylist(list(_pack(docs[own], tags[own], sets, bits)), schema=schema)
    return run


def _arrays(classes: np.ndarray, columns: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """Entries as one array of columns per class."""
    order = np.argsort(classes, kind="stable")
    classes, columns = classes[order], columns[order]
    cut = np.flatnonzero(np.concatenate([[True], classes[1:] != classes[:-1], [True]])) if len(classes) else [0]
    return [(int(classes[a]), columns[a:b]) for a, b in zip(cut[:-1], cut[1:])]


def _column_counts(bits: int):
    def run(table: pa.Table) -> pa.Table:
        release()
        out: dict[str, list] = {"class": [], "doc": [], "tag": [], "size": [], "columns": []}

        def add(*row) -> None:
            for key, value in zip(out, row):
                out[key].append(value)

        of = {n: table.column(n).to_pylist() for n in table.column_names}
        block, blocks = of["block"][0] % (1 << bits), 1 << bits
        classes = np.concatenate([_owners(c, n) for c, n in zip(of["classes"], of["counts"])])
        columns = np.concatenate([_wide(h, block, bits) for h in of["hashes"]])
        if of["block"][0] >= blocks:
            for docs, sizes in zip(of["docs"], of["sizes"]):
                n = len(sizes) // 4
                ids, names, tags = np.frombuffer(docs[:24 * n], np.int64).reshape(3, n).tolist()
                known = np.frombuffer(docs[24 * n:], bool).tolist()
                for d, k, c, t, s in zip(ids, known, names, tags, np.frombuffer(sizes, np.int32).tolist()):
                    add(c, d if k else None, t, s, None)
            shared = np.ones(len(columns), dtype=bool)
        else:
            marked = np.unique(np.concatenate([_wide(h, block, bits) for h in of["shared"]]))
            order = np.lexsort((classes, columns))
            c, k = columns[order], classes[order]
            same = c[1:] == c[:-1]
            differ = np.zeros(len(c), dtype=bool)
            if len(c):
                begin = np.flatnonzero(np.concatenate([[True], ~same]))
                low, high = np.minimum.reduceat(k, begin), np.maximum.reduceat(k, begin)
                differ = np.repeat(low != high, np.diff(np.concatenate([begin, [len(c)]])))
            shared = np.zeros(len(c), dtype=bool)
            shared[order] = differ
            shared |= np.isin(columns, marked)
        for name, held in _arrays(classes[shared], columns[shared]):
            add(name, None, None, None, held)
        return pa.table({"class": pa.array(out["class"], pa.int64()), "doc": pa.array(out["doc"], pa.int64()),
                         "tag": pa.array(out["tag"], pa.int64()), "size": pa.array(out["size"], pa.int32()),
                         "columns": pa.array(out["columns"], pa.list_(pa.int64()))})
    return run


def classes_and_columns(docs: DataFrame, size: int) -> tuple[DataFrame, DataFrame]:
    """``(doc, tag, class, size)`` per row of ``docs (doc, text, tag)``, and ``(class, columns)`` with the
    shared columns of every class: rare ones by number, then the frequent ones by frequency."""
    ship_code(docs.sparkSession)
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = max(LEAST_BITS, (-(-total // BLOCK_BYTES) - 1).bit_length())
    packed = docs.mapInArrow(_incidence(size, bits), PACKED)
    found = written(packed.groupBy("block").applyInArrow(_column_counts(bits), FOUND), "incidence")
    members = found.where("size is not null").select("doc", "tag", "class", "size")
    entries = found.where("columns is not null").select("class", F.explode("columns").alias("column"))
    # Counted per map task first; the few columns that stay are those that many tasks or classes hold.
    frequent = written(entries.groupBy("column").agg(F.count("*").alias("often")).where(f"often >= {FREQUENT}"), "frequent")
    known = F.broadcast(frequent) if frequent.count() <= BROADCAST_COLUMNS else frequent
    placed = F.struct(F.coalesce("often", F.lit(0)).alias("often"), "column")
    columns = (entries.join(known, "column", "left").groupBy("class")
               .agg(F.sort_array(F.collect_set(placed)).getField("column").alias("columns")))
    return members, columns


def _needed(size, share: int):
    """Smallest overlap at which a set of this size can reach the similarity."""
    return F.expr(f"cast((({size}) * {share} + 99) div 100 as int)")


def _overlaps(pairs: DataFrame, rows: DataFrame, share: int) -> DataFrame:
    """Pairs ``(a, b)`` whose exact overlap reaches the similarity."""
    left = rows.select(F.col("class").alias("a"), F.col("size").alias("size_a"), F.col("columns").alias("columns_a"))
    right = rows.select(F.col("class").alias("b"), F.col("size").alias("size_b"), F.col("columns").alias("columns_b"))
    both = pairs.join(left, "a").join(right, "b").withColumn(
        "overlap", F.size(F.array_intersect("columns_a", "columns_b")))
    return both.where(f"overlap * (100 + {share}) >= {share} * (size_a + size_b)").select("a", "b")


def _bit_rows(lists: list[np.ndarray]) -> np.ndarray:
    """One bit row per list, over the values that at least two lists hold."""
    flat = np.concatenate(lists)
    owner = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    _, at, count = np.unique(flat, return_inverse=True, return_counts=True)
    place = np.cumsum(count > 1) - 1
    kept = count[at] > 1
    owner, at = owner[kept], place[at[kept]]
    out = np.zeros((len(lists), (int((count > 1).sum()) + 63) // 64 * 8 or 8), dtype=np.uint8)
    np.bitwise_or.at(out, (owner, at // 8), (1 << (at % 8)).astype(np.uint8))
    return out.view(np.uint64)


def _block_product(share: int):
    def run(table: pa.Table) -> pa.Table:
        """Links between rows of two blocks of one column that join components; a pair is left to the
        first leading column that it shares."""
        name, group, size, place, part = (table.column(n).to_numpy() for n in ("class", "component", "size", "place", "part"))
        two = table.column("i")[0].as_py() != table.column("j")[0].as_py()
        sets = [np.asarray(x.values) for x in table.column("columns")]
        whole, earlier = _bit_rows(sets), _bit_rows([s[:p] for s, p in zip(sets, place)])
        group, a, b = group.copy(), [], []
        for i in range(len(name)):
            rest = slice(i + 1, None)
            able = ((group[rest] != group[i])
                    & (100 * np.minimum(size[rest], size[i]) >= share * np.maximum(size[rest], size[i])))
            if two:
                able &= part[rest] != part[i]
            at = np.flatnonzero(able) + i + 1
            at = at[~(earlier[at] & earlier[i]).any(axis=1)]
            overlap = np.bitwise_count(whole[at] & whole[i]).sum(axis=1, dtype=np.int64)
            at = at[overlap * (100 + share) >= share * (size[at].astype(np.int64) + int(size[i]))]
            if len(at):
                met, first = np.unique(group[at], return_index=True)
                a += [name[i]] * len(met)
                b += name[at[first]].tolist()
                group[np.isin(group, met)] = group[i]
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})
    return run


def links(members: DataFrame, columns: DataFrame, share: int) -> DataFrame:
    """``(node, component)`` of the classes that have a partner."""
    sizes = members.where("size > 0").groupBy("class").agg(F.max("size").alias("size"))
    need = _needed("size", share)
    rows = written(columns.join(sizes, "class").where(F.size("columns") >= need), "rows")
    leading = written(
        rows.withColumn("width", F.size("columns"))
        .select("class", "size", "width",
                F.posexplode(F.slice("columns", 1, F.size("columns") - need + 1)).alias("place", "column"))
        .withColumn("step", F.floor(F.log("size") / F.log(F.lit(SIZE_STEP)))), "leading")

    # One centre per column, size class and seed: the member with the smallest salted hash.
    centres = leading.groupBy("column", "step").agg(*[
        F.min(F.struct(F.xxhash64(F.lit(s), "class").alias("rank"), F.col("class").alias("class")))
        .getField("class").alias(f"c{s}") for s in range(SEEDS)])
    near = centres.select("column", F.array_distinct(F.array(*[f"c{s}" for s in range(SEEDS)])).alias("centre"),
                          F.explode(F.array("step", F.col("step") + 1)).alias("step"))
    stars = (leading.select("class", "column", "step").join(near, ["column", "step"])
             .select("class", F.explode("centre").alias("centre"))
             .where("class <> centre")
             .select(F.least("class", "centre").alias("a"), F.greatest("class", "centre").alias("b")).distinct())
    first = written(_overlaps(stars, rows, share), "stars")
    joined = components(first)

    placed = (leading.join(joined, leading["class"] == joined["node"], "left")
              .withColumn("component", F.coalesce("component", "class")).drop("node"))
    open_columns = (placed.groupBy("column")
                    .agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("members"))
                    .where("low <> high").select("column", "members"))
    placed = written(placed.join(open_columns, "column"), "open")
    short = placed.where(f"members <= {LONG_COLUMN}")
    x, y = short.alias("x"), short.alias("y")
    least = f"(({share} * (x.size + y.size) + {99 + share}) div {100 + share})"
    across = (x.join(y, F.expr(f"""x.column = y.column and x.class < y.class and x.component <> y.component
                       and 100 * least(x.size, y.size) >= {share} * greatest(x.size, y.size)
                       and least(x.width - x.place, y.width - y.place) >= {least}"""))
              .select(F.col("x.class").alias("a"), F.col("y.class").alias("b")).distinct())
    parts = f"cast((members + {BLOCK_ROWS - 1}) div {BLOCK_ROWS} as int)"
    blocks = (placed.where(f"members > {LONG_COLUMN}").join(rows.select("class", "columns"), "class")
              .withColumn("part", F.expr(f"cast(pmod(xxhash64(class), {parts}) as int)"))
              .withColumn("other", F.explode(F.expr(f"sequence(0, {parts} - 1)")))
              .select("column", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"),
                      "class", "component", "size", "place", "part", "columns")
              .groupBy("column", "i", "j").applyInArrow(_block_product(share), "a long, b long"))
    return components(first.unionByName(_overlaps(across, rows, share)).unionByName(blocks))


def _groups(docs: DataFrame, doc: str, text: str, size: int, share: int) -> DataFrame:
    """``(doc, tag, size, group)`` per row; the tag tells the texts of one id apart, the group is null for
    an empty set."""
    rows = docs.select(F.col(doc).alias("doc"), F.col(text).alias("text"), F.xxhash64(text).alias("tag"))
    members, columns = classes_and_columns(rows, size)
    joined = links(members, columns, share)
    return members.join(joined, members["class"] == joined["node"], "left").select(
        "doc", "tag", "size", F.when(F.col("size") > 0, F.coalesce("component", "class")).alias("group"))


def near_duplicates(docs: DataFrame, doc: str = "doc_id", text: str = "text", size: int = 5,
                    share: int = 80) -> DataFrame:
    """``(doc, n_shingles, component_id)`` for every row of ``docs``.

    Words are what stands between white space, A-Z lowered; two documents link when the Jaccard
    similarity of their sets of ``size``-word shingles is at least ``share`` percent. A text with fewer
    words is one shingle; a null text or one without words has an empty set, links with nothing and is
    its own component. Equal sets always link. A null id is kept as a row without a number: it links
    like any other, and is the component only where all members have none. Repeated rows are repeated
    in the result. Other columns are ignored.
    """
    named = _groups(docs, doc, text, size, share)
    full = named.where("group is not null")
    least = full.groupBy("group").agg(F.min("doc").alias("component_id"))
    return (full.join(least, "group").select(F.col("doc").alias(doc), F.col("size").cast("long").alias("n_shingles"), "component_id")
            .unionByName(named.where("group is null").select(
                F.col("doc").alias(doc), F.lit(0).cast("long").alias("n_shingles"), F.col("doc").alias("component_id"))))


def one_of_each_group(docs: DataFrame, doc: str = "doc_id", text: str = "text", size: int = 5,
                      share: int = 80) -> DataFrame:
    """One row of each group of near duplicates, with all columns of ``docs``: that of the smallest id.

    A row without an id stays only where no member of its group has one. Of several rows with the same
    id and text one stays; which, if their other columns differ, is not defined. Texts without words are
    groups of their own and stay, but for exact repeats.
    """
    named = _groups(docs, doc, text, size, share)
    first = F.min(F.struct(F.col("doc").isNull().alias("none"), "doc", "tag"))
    kept = (named.where("group is not null").groupBy("group").agg(first.alias("first"))
            .select(F.col("first.doc").alias("kept_doc"), F.col("first.tag").alias("kept_tag"))
            .unionByName(named.where("group is null").select(F.col("doc").alias("kept_doc"), F.col("tag").alias("kept_tag")).distinct()))
    tag = free_name(docs, "tag")
    marked = docs.withColumn(tag, F.xxhash64(text))
    return (marked.join(kept, marked[doc].eqNullSafe(kept["kept_doc"]) & (marked[tag] == kept["kept_tag"]), "left_semi")
            .dropDuplicates([doc, tag]).select(*docs.columns))
