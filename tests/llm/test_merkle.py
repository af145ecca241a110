"""The Merkle manifest against a plain recursion over sorted rows."""

from __future__ import annotations

from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import awkward, documents
from tidemark.llm import merkle
from tidemark.llm.places import placed

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def digest(*parts: str) -> str:
    return sha256("".join(parts).encode()).hexdigest()


def leaf(row: dict, text: str | None) -> str:
    values = [row["doc_id"], row["source"], row["lang"], row["n_chars"], text]
    return digest(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def climb(nodes: list[str], fanout: int) -> list[list[str]]:
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([digest(*levels[-1][i:i + fanout]) for i in range(0, len(levels[-1]), fanout)])
    return levels


def brute(rows: list[dict], fanout: int) -> list[tuple]:
    groups: dict = {}
    for r in rows:
        groups.setdefault(r["lang"], []).append((r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"]), r))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: climb([x[2] for x in sorted(groups[g], key=lambda x: x[:3])], fanout) for g in names}
    top = climb([trees[g][-1][0] for g in names], fanout) if names else []
    out = []
    for n, g in enumerate(names):
        for i, (_, _, own, r) in enumerate(sorted(groups[g], key=lambda x: x[:3])):
            node, siblings = leaf(r, r["changed"]), []
            for tree, j in ((trees[g], i), (top, n)):
                for level in tree[:-1]:
                    run, digit = level[j - j % fanout:j - j % fanout + fanout], j % fanout
                    siblings += run[:digit] + run[digit + 1:]
                    node = digest(*run[:digit], node, *run[digit + 1:])
                    j //= fanout
            root = top[-1][0]
            out.append((r["doc_id"], own, trees[g][-1][0], root, digest(*siblings), node, node == root))
    return sorted(out, key=str)


def built(docs, fanout, levels):
    made = merkle.manifest(docs, "doc_id", "lang", FIELDS, merkle.leaf([*FIELDS[:-1], "changed"]), fanout, levels)
    return sorted((tuple(r) for r in merkle.proofs(made).collect()), key=str)


def changed(docs):
    return docs.withColumn("changed", F.when(F.col("doc_id") % 3 == 0, F.upper("text")).otherwise(F.col("text")))


#: Local levels alone, butterflies alone, both, and numbers of blocks that are no power of the fanout.
@pytest.mark.parametrize("fanout, levels", [(8, 4), (8, 1), (2, 0), (3, 1), (2, 2)])
def test_trees_equal_brute_force(spark, fanout, levels):
    rows = [(k * 7 % 101, f"Text {k}", f"l{k % 11}" if k % 3 else "big", f"s{k % 4}", k) for k in range(101)]
    docs = changed(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"))
    assert built(docs, fanout, levels) == brute([r.asDict() for r in docs.collect()], fanout)


@pytest.mark.parametrize("blocks", [1, 2, 7, 8, 9, 63, 64, 65, 130])
def test_butterfly_gives_every_block_the_root_and_its_siblings(spark, blocks):
    state = spark.range(blocks).selectExpr("'g' as grp", "id as block", f"{blocks}L as blocks", "cast(id as string) as digest",
                                           f"cast(array() as {merkle.PATH}) as path")
    levels = climb([str(i) for i in range(blocks)], 8)
    got = merkle.butterfly(state).collect()
    assert sorted(r.block for r in got) == list(range(blocks))
    for r in got:
        assert r.digest == levels[-1][0]
        place = r.block
        for step, level in zip(r.path, levels[:-1], strict=True):
            assert (step.digit, step.run) == (place % 8, level[place - place % 8:place - place % 8 + 8])
            place //= 8


def test_awkward_rows(spark, odd, nothing):
    docs = changed(odd)
    want = brute([r.asDict() for r in docs.collect()], 8)
    assert built(docs, 8, 4) == want and len(want) == len(awkward())
    assert built(changed(nothing), 8, 4) == []
    one = changed(documents(spark, [(5, "alone")]))
    (got,) = built(one, 8, 4)
    assert got[1] == got[2] == got[3] and got[4] == digest() and got[6] == (5 % 3 != 0)


def test_a_tampered_text_is_found(spark):
    docs = changed(documents(spark, [(k, f"words of text {k}") for k in range(30)]))
    assert {(r.key, r.verified) for r in merkle.proofs(merkle.manifest(
        docs, "doc_id", "lang", FIELDS, merkle.leaf([*FIELDS[:-1], "changed"]))).collect()} == {(k, k % 3 != 0) for k in range(30)}
    assert merkle.proofs(merkle.manifest(docs, "doc_id", "lang", FIELDS)).where("not verified").count() == 0


def test_places_are_gapless(spark):
    rows = spark.range(3000).selectExpr("case when id % 3 = 0 then 'hot' else concat('g', id % 50) end as g", "(id * 7919) % 997 as k", "id as row", "1 as total_")
    got = placed(rows, "g", ["k", "row"]).collect()
    for g in {r.g for r in got}:
        own = sorted((r for r in got if r.g == g), key=lambda r: (r.k, r.row))
        assert [r.place for r in own] == list(range(len(own))) and {r.total for r in own} == {len(own)}
