"""A Merkle manifest of a table: one digest for all rows, one for each group, and a proof for every row.

The rows of a group, in order, are cut into blocks of ``fanout ** levels`` leaves. A block's subtree is
hashed where its leaves lie. Above the blocks the digests are made by a butterfly exchange: in round r the
``fanout`` blocks that differ in digit r of their number only swap the roots they have, and each hashes the
parent itself. After the last round every block holds the group's root and all siblings on its way there,
so nothing is ever sent down again. Where the last node of a level has fewer blocks than the others, its
blocks also answer for the missing ones. The groups' roots are then met in the same way, one block each.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ship_code, written
from tidemark.llm.places import placed

FANOUT = 8
LEVELS = 4  # 4,096 leaves a block
PATH = "array<struct<digit: int, run: array<string>>>"


def field(column: str) -> Column:
    """``-`` for a null, else the value's UTF-8 byte count, a colon and the value."""
    text = F.col(column).cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(columns: list[str]) -> Column:
    """The digest of a row: its fields one after the other."""
    return F.sha2(F.concat(*(field(c) for c in columns)).cast("binary"), 256)


def height_of(n: int, fanout: int) -> int:
    up = 0
    while n > 1:
        n, up = -(-n // fanout), up + 1
    return up


def _meet(state: DataFrame, wide: int, fanout: int) -> DataFrame:
    """One round: groups of ``fanout`` blocks, ``wide`` apart, swap roots and hash their parent, each."""
    node = F.expr(f"block div {wide}")
    sent = (state.withColumn("digit", F.expr(f"cast((block div {wide}) % {fanout} as int)"))
            .withColumn("low", F.expr(f"block % {wide}"))
            .withColumn("held", F.least(F.lit(wide).cast("long"), F.col("blocks") - node * wide))
            .withColumn("to", F.explode(F.expr(
                f"case when digit > 0 and held < {wide} then sequence(low, {wide - 1}L, held) else array(low) end")))
            .withColumn("own", F.when(F.col("to") == F.col("low"), F.struct("block", "blocks", "path"))))
    met = (sent.groupBy("grp", F.expr(f"block div {wide * fanout}").alias("parent"), "to")
           .agg(F.sort_array(F.collect_list(F.struct("digit", "digest", "own"))).alias("met")))
    run = met.select("grp", F.expr("transform(met, m -> m.digest)").alias("run"), F.explode("met").alias("m")).where("m.own is not null")
    return run.select("grp", "m.own.block", "m.own.blocks", F.sha2(F.concat_ws("", "run").cast("binary"), 256).alias("digest"),
                      F.concat("m.own.path", F.array(F.struct(F.col("m.digit").alias("digit"), "run"))).alias("path"))


def butterfly(state: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """``(grp, block, blocks, digest, path)``: every block with its group's root and the way there.

    ``state`` has the same columns, blocks numbered from 0 within their group. A group of the exchange has
    ``fanout`` rows at most, a round at most twice as many rows as there are blocks. The rounds follow from
    the largest group's blocks, the one number that is read; each round is written to the shared folder.
    """
    most = state.agg(F.max("blocks")).first()[0] or 0
    for r in range(height_of(most, fanout)):
        wide = fanout ** r
        done = state.where(F.col("blocks") <= wide).select("grp", "block", "blocks", "digest", "path")
        state = written(_meet(state.where(F.col("blocks") > wide), wide, fanout).unionByName(done), "butterfly")
    return state


def _digest(nodes: list[str]) -> str:
    return sha256("".join(nodes).encode()).hexdigest()


def _tree(leaves: list[str], up: int, fanout: int) -> list[list[str]]:
    """The nodes of every level, ``up`` levels above the leaves."""
    levels = [leaves]
    for _ in range(up):
        below = levels[-1]
        levels.append([_digest(below[i:i + fanout]) for i in range(0, len(below), fanout)])
    return levels


def _block_root(fanout: int, levels: int) -> Callable[[tuple, pa.Table], pa.Table]:
    def run(key: tuple, table: pa.Table) -> pa.Table:
        total = table.column("total")[0].as_py()
        leaves = table.sort_by("place").column("leaf").to_pylist()
        root = _tree(leaves, min(levels, height_of(total, fanout)), fanout)[-1][0]
        return pa.table({"grp": [key[0].as_py()], "block": [key[1].as_py()], "digest": [root],
                         "blocks": [max(1, -(-total // fanout ** levels))]},
                        schema=pa.schema([("grp", pa.string()), ("block", pa.int64()), ("digest", pa.string()), ("blocks", pa.int64())]))
    return run


def _climb(fanout: int, levels: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Per leaf of a block the digest of its siblings up to the root, and the root that the leaf given
    in ``candidate`` would lead to."""
    def run(table: pa.Table, block: pa.Table) -> pa.Table:
        table = table.sort_by("place")
        total = table.column("total")[0].as_py()
        up = min(levels, height_of(total, fanout))
        tree = _tree(table.column("leaf").to_pylist(), up, fanout)
        (above,) = block.select(["subroot", "root", "path"]).to_pylist()
        upper = "".join("".join(p["run"][:p["digit"]] + p["run"][p["digit"] + 1:]) for p in above["path"])
        proofs, folded = [], []
        for i, node in enumerate(table.column("candidate").to_pylist()):
            siblings = []
            for level in range(up):
                digit, first = i % fanout, i - i % fanout
                run = tree[level][first:first + fanout]
                before, after = run[:digit], run[digit + 1:]
                siblings += before + after
                node = _digest([*before, node, *after])
                i //= fanout
            for p in above["path"]:
                node = _digest([*p["run"][:p["digit"]], node, *p["run"][p["digit"] + 1:]])
            proofs.append(sha256(("".join(siblings) + upper).encode()).hexdigest())
            folded.append(node)
        same = [above["subroot"]] * len(proofs), [above["root"]] * len(proofs)
        return pa.table([table.column("key"), table.column("leaf"), *map(pa.array, (*same, proofs, folded))],
                        names=["key", "leaf", "subroot", "root", "proof_sha256", "folded_root"])
    return run


@dataclass
class Manifest:
    """``leaves``: (key, grp, block, place, total, leaf, candidate) a row; ``blocks``: (grp, block, subroot, root,
    path) a block, the path being the runs of nodes from the block's root up, with the own one's digit. A group's
    name is an equals sign and its value, or empty for the null group."""

    leaves: DataFrame
    blocks: DataFrame
    fanout: int
    levels: int


def manifest(rows: DataFrame, key: str, group: str, fields: list[str], candidate: Column | None = None,
             fanout: int = FANOUT, levels: int = LEVELS) -> Manifest:
    """The tree over the digests of ``fields``: by group, rows ascending by ``key``, then the groups' roots,
    null first and then by bytes. A group of one row has that leaf as its root; so has a table of one group
    that group's root.

    ``candidate`` is what :func:`proofs` folds in place of the leaf; by default the leaf itself. A null key
    comes first in its group, rows that repeat a key are leaves of their own, in the order of their digests.
    The texts are read once and never shuffled: what moves is digests. An empty table has no blocks. Fields
    are read as texts, whole; columns not named are ignored, whatever they are called.
    """
    ship_code(rows.sparkSession)
    own = leaf(fields)
    slim = written(rows.select(
        F.col(key).alias("key"), F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("")).alias("grp"),
        own.alias("leaf"), (own if candidate is None else candidate).alias("candidate"),
        F.monotonically_increasing_id().alias("row")), "leaves")
    leaves = written(placed(slim, "grp", ["key", "leaf", "row"])
                     .withColumn("block", F.expr(f"place div {fanout ** levels}")).drop("row"), "leaves")
    roots = leaves.select("grp", "block", "place", "total", "leaf").groupBy("grp", "block").applyInArrow(
        _block_root(fanout, levels), "grp string, block long, digest string, blocks long")
    state = butterfly(written(roots.withColumn("path", F.expr(f"cast(array() as {PATH})")), "roots"), fanout)
    subroots = state.where("block = 0").select(F.lit("").alias("grp"), F.col("grp").alias("name"), "digest")
    top = placed(subroots, "grp", ["name"], "block", "blocks").withColumn("path", F.expr(f"cast(array() as {PATH})"))
    names = top.select("block", "name")
    top = butterfly(written(top.drop("name"), "subroots"), fanout).join(names, "block").select(
        F.col("name").alias("grp"), F.col("digest").alias("root"), F.col("path").alias("top"))
    blocks = state.join(top, "grp").select("grp", "block", F.col("digest").alias("subroot"), "root", F.concat("path", "top").alias("path"))
    return Manifest(leaves, written(blocks, "paths"), fanout, levels)


def proofs(of: Manifest) -> DataFrame:
    """``(key, leaf, subroot, root, proof_sha256, folded_root, verified)`` per row: the digest of all siblings
    from the leaf to the root, left to right, level by level, and whether the candidate leads to the root."""
    keys = ["grp", "block"]
    kind = dict(of.leaves.dtypes)["key"]
    out = of.leaves.groupBy(*keys).cogroup(of.blocks.groupBy(*keys)).applyInArrow(
        _climb(of.fanout, of.levels),
        f"key {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string")
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


#: DuckDB SQL for :func:`proofs` over documents, texts with lower-cased A-Z as candidates where 3 divides the
#: checksum of the id.
ORACLE = """
    WITH RECURSIVE hit AS (
        SELECT *, xor(list_reduce(list_prepend(4294967295::UBIGINT, flatten(list_transform(string_split(doc_id::VARCHAR, ''),
                      lambda c: list_transform(range(8), lambda k: ((ascii(c) >> k) & 1)::UBIGINT)))),
                      lambda a, b: xor(a >> 1, CASE WHEN xor(a, b) & 1 = 1 THEN 3988292384::UBIGINT ELSE 0::UBIGINT END)),
                      4294967295::UBIGINT) % 3 = 0 AS hit FROM documents),
    leaves AS (
        SELECT doc_id, lang, h || coalesce(strlen(text) || ':' || text, '-') AS doc,
               CASE WHEN hit THEN h || coalesce(strlen(text) || ':' || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-') END AS low
        FROM (SELECT *, coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
                     || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS h FROM hit)),
    hashed AS (SELECT doc_id, coalesce('=' || lang, '') AS grp, sha256(doc) AS leaf, sha256(coalesce(low, doc)) AS candidate FROM leaves),
    base AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY grp) AS n FROM hashed),
    nodes AS (
        SELECT grp, 0 AS lvl, pos, n, leaf AS node FROM base
        UNION ALL
        SELECT grp, lvl + 1, pos // 8, (max(n) + 7) // 8, sha256(string_agg(node, '' ORDER BY pos)) FROM nodes WHERE n > 1 GROUP BY grp, lvl, pos // 8),
    subs AS (SELECT grp, lvl AS high, node AS subroot, row_number() OVER (ORDER BY grp) - 1 AS pos, count(*) OVER () AS n FROM nodes WHERE n = 1),
    tops AS (
        SELECT 0 AS lvl, pos, n, subroot AS node FROM subs
        UNION ALL
        SELECT lvl + 1, pos // 8, (max(n) + 7) // 8, sha256(string_agg(node, '' ORDER BY pos)) FROM tops WHERE n > 1 GROUP BY lvl, pos // 8),
    steps AS (
        SELECT b.grp, b.pos AS leaf_pos, s.lvl, s.pos, s.node, s.pos = b.pos // (8 ** s.lvl)::BIGINT AS own
        FROM base b JOIN nodes s ON s.grp = b.grp AND s.n > 1 AND s.pos // 8 = b.pos // (8 ** (s.lvl + 1))::BIGINT
        UNION ALL
        SELECT b.grp, b.pos, g.high + s.lvl, s.pos, s.node, s.pos = g.pos // (8 ** s.lvl)::BIGINT
        FROM base b JOIN subs g USING (grp) JOIN tops s ON s.n > 1 AND s.pos // 8 = g.pos // (8 ** (s.lvl + 1))::BIGINT),
    runs AS (SELECT grp, leaf_pos, lvl, coalesce(string_agg(node, '' ORDER BY pos) FILTER (NOT own), '') AS others,
                    coalesce(string_agg(node, '' ORDER BY pos) FILTER (pos < mine), '') AS before,
                    coalesce(string_agg(node, '' ORDER BY pos) FILTER (pos > mine), '') AS after
             FROM (SELECT *, max(pos) FILTER (own) OVER (PARTITION BY grp, leaf_pos, lvl) AS mine FROM steps) GROUP BY ALL),
    proofs AS (SELECT grp, leaf_pos, string_agg(others, '' ORDER BY lvl) AS proof FROM runs GROUP BY ALL),
    fold AS (
        SELECT grp, pos, 0 AS lvl, candidate AS node FROM base
        UNION ALL
        SELECT f.grp, f.pos, f.lvl + 1, sha256(r.before || f.node || r.after)
        FROM fold f JOIN runs r ON r.grp = f.grp AND r.leaf_pos = f.pos AND r.lvl = f.lvl),
    last AS (SELECT grp, pos, arg_max(node, lvl) AS folded FROM fold GROUP BY ALL)
    SELECT b.doc_id, b.leaf, s.subroot, t.node AS root, sha256(coalesce(p.proof, '')) AS proof_sha256, l.folded AS folded_root, l.folded = t.node AS verified
    FROM base b JOIN subs s USING (grp) JOIN (SELECT node FROM tops WHERE n = 1) t ON true JOIN last l ON l.grp = b.grp AND l.pos = b.pos
    LEFT JOIN proofs p ON p.grp = b.grp AND p.leaf_pos = b.pos"""
