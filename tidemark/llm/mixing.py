"""Mixing sources to target weights over a tree of groups, by hierarchical budgets.

A token budget flows from the root through the levels of the tree (domain, language, source). At each
node it is shared among the children in proportion to their weights; a child never gets more than its
subtree holds (its tokens times ``max_epochs``), and what it cannot take goes to its siblings in
proportion to theirs. A shortage so reaches the parent's siblings only when all siblings are full. A
leaf's budget buys whole epochs first, and then the longest prefix of one more epoch in seeded order.

Only sums per group travel: no group's rows are ever ordered in one task. The order of an epoch is an
MD5 digest of seed, epoch and id; its first hex digits cut a leaf into slices whose sums find the slice
in which the prefix ends, and only that slice's rows are ordered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import free_name, written

SLICE_DIGITS = 3  # 4,096 slices of a leaf
#: Rows of a leaf table up to which it is broadcast, so that a leaf with very many rows stays where they
#: are; beyond, both sides are shuffled and skewed leaves are left to AQE.
BROADCAST_LEAVES = 200_000


def word_count(text: str = "text") -> Column:
    """Tokens of a text as far as mixing needs them: runs without white space; 0 for null."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^ \t\n\r\f\x0B]+")), F.lit(0)).cast("long")


def _path(columns: list[str]) -> Column:
    """The node's path as one text; a null value is a node of its own."""
    parts = [F.coalesce(F.concat(F.length(F.col(c).cast("string")).cast("string"), F.lit(":"), F.col(c).cast("string")), F.lit("~"))
             for c in columns]
    return F.concat_ws("/", *parts)


def _weight(columns: list[str], weights: dict[tuple, int]) -> Column:
    """The most specific weight given for a node's path; ``None`` in a path stands for any value."""
    out = F.lit(1)
    fitting = [p for p in weights if len(p) == len(columns)]
    for path in sorted(fitting, key=lambda p: (sum(v is not None for v in p), [str(v) for v in p])):
        same = F.lit(True)
        for column, value in zip(columns, path):
            if value is not None:
                same = same & F.col(column).cast("string").eqNullSafe(F.lit(str(value)))
        out = F.when(same, F.lit(weights[path])).otherwise(out)
    return out.cast("decimal(38,0)")


def _share(nodes: DataFrame) -> DataFrame:
    """``nodes (parent, node, weight, room, budget of the parent)`` with each node's ``share``.

    Children are taken by room per weight: as long as a child's room is below its part of what is left,
    it is filled; the rest share what then remains. Parts of a token go to the next child in the same order,
    so that the shares sum to the budget wherever the children can hold it.
    """
    order = Window.partitionBy("parent").orderBy(F.col("room").cast("double") / F.col("weight").cast("double"), "node")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy("parent")
    zero = F.lit(0).cast("decimal(38,0)")
    live = (nodes.where("weight > 0")
            .withColumn("left", F.col("budget") - (F.sum("room").over(so_far) - F.col("room")))
            .withColumn("rest", F.sum("weight").over(whole) - F.sum("weight").over(so_far) + F.col("weight"))
            .withColumn("full", F.expr("room * rest <= left * weight"))
            .withColumn("taken", F.coalesce(F.sum(F.when(F.col("full"), F.col("room"))).over(whole), zero))
            .withColumn("open", F.sum(F.when(~F.col("full"), F.col("weight"))).over(whole))
            .withColumn("upto", F.sum(F.when(~F.col("full"), F.col("weight"))).over(so_far)))
    return live.select("node", F.expr("""cast(case when full then room else (budget - taken) * upto div open
                                              - (budget - taken) * (upto - weight) div open end as decimal(38,0))""").alias("share"))


def budgets(leaves: DataFrame, levels: list[str], weights: dict[tuple, int], budget: int, max_epochs: int) -> DataFrame:
    """``(leaf, tokens, share)`` per leaf, from ``leaves (levels..., tokens)``."""
    room = leaves.withColumn("room", (F.col("tokens") * max_epochs).cast("decimal(38,0)"))
    above = None
    for depth in range(1, len(levels) + 1):
        own = levels[:depth]
        nodes = room.groupBy(*own).agg(F.sum("room").cast("decimal(38,0)").alias("room")).select(
            _path(own[:-1]).alias("parent"), _path(own).alias("node"), _weight(own, weights).alias("weight"), "room")
        if above is None:
            nodes = nodes.withColumn("budget", F.lit(budget).cast("decimal(38,0)"))
        else:
            nodes = nodes.join(above.select(F.col("node").alias("parent"), F.col("share").alias("budget")), "parent")
        above = _share(nodes)
    return room.select(_path(levels).alias("leaf"), "tokens").join(
        above.select(F.col("node").alias("leaf"), F.col("share").cast("long").alias("share")), "leaf")


def _by_leaf(leaves: DataFrame) -> DataFrame:
    """A written leaf table, broadcast if it is small enough."""
    return F.broadcast(leaves) if leaves.count() <= BROADCAST_LEAVES else leaves


def _order(seed: int, epoch: Column, doc: str) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.col(doc).cast("string")))


def cuts(rows: DataFrame, levels: list[str], weights: dict[tuple, int], budget: int, max_epochs: int,
         seed: int, doc: str) -> DataFrame:
    """``(leaf, epochs, cut)``: whole epochs of a leaf, and the last place taken of the next one."""
    leaves = rows.groupBy(*levels).agg(F.sum("tokens").alias("tokens"))
    plan = written(
        budgets(leaves, levels, weights, budget, max_epochs)
        .withColumn("epochs", F.expr("case when tokens > 0 then cast(share div tokens as int) else 0 end"))
        .withColumn("remains", F.expr("share - epochs * tokens")).select("leaf", "epochs", "remains"), "plan")
    placed = (rows.withColumn("leaf", _path(levels)).join(_by_leaf(plan.where("remains > 0")), "leaf")
              .withColumn("place", _order(seed, F.col("epochs"), doc))
              .withColumn("slice", F.substring("place", 1, SLICE_DIGITS)).select("leaf", "remains", "place", "slice", "tokens"))
    sums = placed.groupBy("leaf", "remains", "slice").agg(F.sum("tokens").alias("held"), F.max("place").alias("last"))
    upto = Window.partitionBy("leaf").orderBy("slice").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = sums.withColumn("upto", F.sum("held").over(upto))
    whole = sums.where("upto <= remains").groupBy("leaf").agg(F.max("last").alias("cut"))
    split = sums.where("upto > remains and upto - held < remains").select(
        "leaf", "slice", (F.col("upto") - F.col("held")).alias("before"))
    first = split.groupBy("leaf").agg(F.min(F.struct("slice", "before")).alias("s")).select("leaf", "s.slice", "s.before")
    within = Window.partitionBy("leaf").orderBy("place").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    part = (placed.join(first, ["leaf", "slice"]).withColumn("upto", F.col("before") + F.sum("tokens").over(within))
            .where("upto <= remains").groupBy("leaf").agg(F.max("place").alias("cut")))
    ends = whole.unionByName(part).groupBy("leaf").agg(F.max("cut").alias("cut"))
    return plan.join(ends, "leaf", "left").select("leaf", "epochs", "cut")


def mix(docs: DataFrame, levels: list[str], weights: dict[tuple, int], budget: int | None = None,
        percent: int = 50, max_epochs: int = 2, seed: int = 0, doc: str = "doc_id",
        tokens: Column | None = None, copies: str = "copies") -> DataFrame:
    """The chosen rows of ``docs`` with all their columns and ``copies``, how often a row is taken.

    ``budget`` is in tokens, ``percent`` of all where None. Weights are whole numbers by path, 1 where none is
    given; nodes of weight 0 get nothing. Rows of one leaf that share an id are taken or left together; null
    ids are one such id. Null group values are a group of their own. The prefix never exceeds a leaf's
    budget: less than the tokens of the next row in its order are left over in each leaf, and stay unspent. An
    empty table gives no rows; texts of any length are counted whole. A column of ``docs`` named ``copies`` is replaced.
    """
    names = [f"_g{i}" for i in range(len(levels))]
    rows = written(docs.select(*[F.col(c).cast("string").alias(n) for c, n in zip(levels, names)], F.col(doc).alias("_id"),
                               (word_count() if tokens is None else tokens).alias("tokens")), "sizes")
    if budget is None:
        budget = (rows.agg(F.sum("tokens")).first()[0] or 0) * percent // 100
    ends = written(cuts(rows, names, weights, budget, max_epochs, seed, "_id"), "cuts").select(
        F.col("leaf").alias("_leaf"), F.col("epochs").alias(free_name(docs, "epochs")), F.col("cut").alias(free_name(docs, "cut")))
    leaf = free_name(docs, "leaf")
    ends = ends.withColumnRenamed("_leaf", leaf)
    kept = [c for c in docs.columns if c.lower() != copies.lower()]
    epochs, cut = F.col(free_name(docs, "epochs")), F.col(free_name(docs, "cut"))
    more = F.coalesce((_order(seed, epochs, doc) <= cut).cast("int"), F.lit(0))
    return (docs.withColumn(leaf, _path(levels)).join(_by_leaf(ends), leaf)
            .withColumn(copies, epochs + more).where(F.col(copies) > 0).select(*kept, copies))
