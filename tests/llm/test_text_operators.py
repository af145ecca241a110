"""Tokens, substrings and near-duplicate texts against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter
from functools import lru_cache

import numpy as np
import pytest

from tests.llm.conftest import awkward, documents, prose
from tidemark.llm import counts, hashing, jaccard, packed, substrings, tokens
from tidemark.llm.queries import BYTE_BPE_IDS, END_ID, QUERIES, byte_bpe


@lru_cache
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(byte_bpe())


def ids_of(text: str | None) -> list[int]:
    return library().encode(text or "", add_special_tokens=False).ids


def rows_of(spark, sf_dir: str) -> list[tuple]:
    return [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]


# --- tokens -------------------------------------------------------------------------------------------

def test_segments_give_the_ids_of_the_library():
    random.seed(3)
    parts = ["a", "B", " ", "  ", "\n", "\t", "<|endoftext|>", "'s", "'", "1", "23", ".", "é", " ", "\x1c", "\x85",
             "　", "漢", "🙂", "​", "\r\n", "\x00", "́", "﻿", "²", "½", "_", ",", "!", "×", "ÿ", "À"]
    texts = ["".join(random.choice(parts) for _ in range(random.randint(0, 14))) for _ in range(6000)]
    of, whole = tokens.SegmentEncoder(byte_bpe(), limit=50), library()
    ids, lengths = of.encode([t.encode() for t in texts])
    for text, got in zip(texts, np.split(ids, np.cumsum(lengths)[:-1])):
        assert got.tolist() == whole.encode(text, add_special_tokens=False).ids, repr(text)


@pytest.mark.parametrize("width", [1, 3, 7, 8, 13, 16, 17, 24, 31, 32])
def test_bits_come_back(width):
    rng = np.random.default_rng(width)
    for n in (0, 1, 7, 1000):
        ids = rng.integers(0, 1 << width, n, dtype=np.uint64).astype(np.uint32)
        block = packed.pack_block(ids, np.array([n // 2, n - n // 2]), width)
        assert np.array_equal(packed.read_block(block)[0], ids)
        assert np.array_equal(packed.read_block(block, 1)[0], ids[n // 2:])
        assert len(packed.pack_bits(ids, width)) == -(-n * width // 8)


def test_width_is_the_least_that_fits():
    assert [packed.width_of(n) for n in (1, 2, 3, 256, 257, 50_257, 65_536, 65_537)] == [1, 1, 2, 8, 9, 16, 16, 17]
    with pytest.raises(ValueError):
        packed.pack_bits(np.array([4], dtype=np.uint32), 2)


def expected_packs(rows: list[tuple]) -> Counter:
    """As in the files: null ids first, then ascending ids; the order within one id is not checked."""
    out, start = [], 0
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*ids_of(text), END_ID]
        out.append((doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return Counter(out)


def test_packed_query(spark, sf_dir):
    got = Counter(tuple(r) for r in QUERIES["op2_packed_token_ids"](spark, sf_dir).collect())
    assert got == expected_packs(rows_of(spark, sf_dir))


def test_packed_awkward(odd, nothing):
    blocks = packed.write_blocks(odd, byte_bpe(), END_ID, BYTE_BPE_IDS)
    got = packed.read_documents(blocks).collect()
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == Counter(
        (d, n, c) for d, _, n, c in expected_packs(awkward()).elements())
    starts = sorted((r.start, r.n_tokens) for r in got)
    assert [s for s, _ in starts] == [0, *np.cumsum([n for _, n in starts])[:-1].tolist()]
    assert {tuple(r.ids) for r in packed.read_ids(blocks).collect()} == {(*ids_of(t), END_ID) for _, t in awkward()}
    assert packed.read_documents(packed.write_blocks(nothing, byte_bpe(), END_ID, BYTE_BPE_IDS)).count() == 0


def test_count_query(spark, sf_dir):
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in QUERIES["op3_token_count_cache"](spark, sf_dir).collect()}
    for doc, text in rows_of(spark, sf_dir):
        n = len(ids_of(text))
        assert got[doc] == (len((text or "").encode()), n, n > 1024)


def test_cache_takes_each_text_once(spark, odd, nothing, tmp_path):
    cache = str(tmp_path / "cache")
    first = counts.count_tokens(odd, byte_bpe(), cache)
    assert Counter((r.doc_id, r.n_tokens) for r in first.collect()) == Counter((d, len(ids_of(t))) for d, t in awkward())
    assert spark.read.parquet(cache).count() == len({t or "" for _, t in awkward()})
    again = documents(spark, [*awkward(), (20, "a new text")])
    assert counts.count_tokens(again, byte_bpe(), cache).count() == len(awkward()) + 1
    assert spark.read.parquet(cache).count() == len({t or "" for _, t in awkward()}) + 1
    assert counts.count_tokens(nothing, byte_bpe(), cache).count() == 0


# --- repeated substrings ------------------------------------------------------------------------------

def brute_repeats(rows: list[tuple]) -> Counter:
    first: dict[bytes, int] = {}
    for doc, text in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        b = (text or "").encode()
        for p in range(len(b) - 49):
            first.setdefault(b[p:p + 50], doc)
    out = []
    for doc, text in rows:
        b = (text or "").encode()
        gone = bytearray(len(b))
        if doc is not None:
            for p in range(len(b) - 49):
                if first[b[p:p + 50]] < doc:
                    gone[p:p + 50] = b"\1" * 50
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for p in range(len(b)) if gone[p] and (p == 0 or not gone[p - 1]))
        out.append((doc, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return Counter(out)


def test_repeats_query(spark, sf_dir):
    got = Counter(tuple(r) for r in QUERIES["op6_suffix_array_dedup"](spark, sf_dir).collect())
    assert got == brute_repeats(rows_of(spark, sf_dir))


def test_repeats_awkward(spark, odd, nothing):
    rows = awkward()
    passage = "é" * 12 + " a passage that many documents share, of more than fifty bytes " + "x" * 80
    rows += [(100 + i, prose(50 + i, 15) + passage + prose(90 + i, 10)) for i in range(25)]
    rows += [(200, "y" * 49), (201, "y" * 49), (202, "z" * 50), (203, "z" * 50), (204, "z" * 120)]
    got = Counter(tuple(r) for r in substrings.remove_repeats(documents(spark, rows)).collect())
    assert got == brute_repeats(rows)
    assert substrings.remove_repeats(nothing).count() == 0
    kept = {r.doc_id: (r.kept, r.spans) for r in substrings.remove_repeats(
        documents(spark, [(1, "q" * 30 + "w" * 60), (2, "w" * 55 + "tail")]), with_text=True).collect()}
    assert kept[2] == (b"tail", [[0, 55]]) and kept[1][0] == b"q" * 30 + b"w" * 60


def test_no_bucket_takes_all_of_a_common_phrase(spark, monkeypatch):
    """A phrase in different surroundings: its stretches are dealt by their own bytes, with the same result."""
    import pyarrow as pa
    import pyarrow.compute  # noqa: F401

    phrase = " a phrase that many documents hold "
    rows = [(i, hashlib.sha256(b"%d" % i).hexdigest() + phrase + hashlib.sha256(b"-%d" % i).hexdigest()) for i in range(400)]
    rows += [(1000 + i, rows[i][1][20:-20]) for i in range(30)] + [(5, rows[7][1]), (2000, rows[3][1])]
    monkeypatch.setattr(substrings, "HOT_DOCS", 8)
    assert Counter(tuple(r) for r in substrings.remove_repeats(documents(spark, rows)).collect()) == brute_repeats(rows)
    seen = []
    batch = pa.RecordBatch.from_arrays([pa.array([i for i, _ in rows]), pa.array([t for _, t in rows]), pa.array([0] * len(rows))], names=["doc", "text", "tag"])
    bits, buckets = 6, 64
    blocks = pa.Table.from_batches(list(substrings._hashes(bits, buckets)(iter([batch]))))
    # What the piece knows to be shared passes the blocks by; they get a mark with the number of documents.
    inside = [r for r in blocks.to_pylist() if r["block"] < 1 << bits]
    marked = [np.frombuffer(r["marked"], np.int32) for r in inside]
    assert all((m > 1).all() for m in marked) and sum(m.sum() for m in marked) > 400
    assert all(np.frombuffer(r["counts"], np.int32).sum() * 5 == len(r["hashes"]) for r in inside)
    packs = pa.Table.from_batches(list(substrings._texts(buckets)(iter([batch]))))
    of = lambda t, name, v: t.filter(pa.compute.equal(t.column(name), v))
    active = pa.concat_tables(substrings._shared(bits, buckets, substrings.HOT_DOCS)(of(blocks, "block", b)) for b in set(blocks.column("block").to_pylist()))
    for b in set(packs.column("bucket").to_pylist()):
        seen += substrings._stretches(bits, buckets)(of(packs, "bucket", b), of(active, "bucket", b)).to_pylist()
    size = Counter()
    for row in seen:
        size[row["kind"], row["bucket"]] += sum(np.frombuffer(row["sizes"], np.int64)) if row["kind"] != 1 else 0
    assert max(size.values()) < 0.05 * sum(size.values()) and any(kind == 2 for kind, _ in size)


def test_suffixes_are_sorted_through_the_cover():
    rng = np.random.default_rng(0)
    for alphabet in (b"ab", b"abcd ", "aé ".encode(), b"\x00a\xff"):
        t = np.frombuffer(alphabet, np.uint8)[rng.integers(0, len(alphabet), 700)]
        t = np.concatenate([t, t[100:400], t[50:500], t[100:400]])
        at = np.arange(len(t) - 56)
        b = t.tobytes()
        got = [b[i:i + 50] for i in substrings.sort_suffixes(t, at)[0]]
        assert got == sorted(got) and sorted(got) == sorted(b[i:i + 50] for i in at)


def test_every_two_residues_meet_in_the_cover():
    for r in range(substrings.PERIOD):
        for s in range(substrings.PERIOD):
            d = substrings._shift(r, s)
            assert (r + d) % substrings.PERIOD in substrings.COVER and (s + d) % substrings.PERIOD in substrings.COVER


# --- n-gram Jaccard -----------------------------------------------------------------------------------

UPPER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def shingles(text: str | None) -> frozenset:
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UPPER))
    return frozenset(tuple(w[k:k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute_groups(rows: list[tuple]) -> list[tuple]:
    sets, above = [shingles(t) for _, t in rows], list(range(len(rows)))

    def top(x: int) -> int:
        while above[x] != x:
            x = above[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 5 * min(len(sets[i]), len(sets[j])) >= 4 * max(len(sets[i]), len(sets[j])) and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                above[top(i)] = top(j)
    groups: dict[int, list] = {}
    for i, (doc, _) in enumerate(rows):
        groups.setdefault(top(i), []).append(doc)
    least = {k: min((d for d in v if d is not None), default=None) for k, v in groups.items()}
    return [(doc, len(sets[i]), least[top(i)]) for i, (doc, _) in enumerate(rows)]


def near_rows() -> list[tuple]:
    """Groups of near copies around the bound, some chained, and unrelated texts with a common passage."""
    random.seed(5)
    rows = awkward()
    passage = prose(77, 30)
    for g in range(4):
        base = prose(300 + g, 90).split()
        for k in range(14):
            words = list(base)
            for _ in range(k % 5):
                words[random.randrange(90)] = f"edit{random.randrange(1000)}"
            rows.append((1000 + 100 * g + k, " ".join(words)))
    rows += [(2000 + k, passage + " " + prose(600 + k, 12 + k)) for k in range(12)]
    return rows


@pytest.mark.parametrize("long_column", [1, 64])
def test_groups_of_near_copies(spark, monkeypatch, long_column):
    monkeypatch.setattr(jaccard, "LONG_COLUMN", long_column)
    monkeypatch.setattr(jaccard, "BLOCK_ROWS", 5)
    monkeypatch.setattr(jaccard, "SEEDS", 1)
    rows = near_rows()
    got = Counter(tuple(r) for r in jaccard.near_duplicates(documents(spark, rows)).collect())
    assert got == Counter(brute_groups(rows))


def test_groups_query(spark, sf_dir):
    rows = rows_of(spark, sf_dir)
    got = Counter(tuple(r) for r in QUERIES["op7_ngram_jaccard_join"](spark, sf_dir).collect())
    assert got == Counter(brute_groups(rows))


def test_one_of_each_group_stays(spark, odd, nothing):
    kept = jaccard.one_of_each_group(odd)
    assert kept.columns == odd.columns
    got = Counter((r.doc_id, r.text) for r in kept.select("doc_id", "text").collect())
    text = dict(awkward())
    assert got == Counter({(0, text[0]): 1, (1, None): 1, (2, ""): 1, (3, text[3]): 1, (5, prose(3, 40)): 1,
                           (None, prose(4, 20)): 1, (6, text[6]): 1, (7, "one two"): 1, (9, text[9]): 1,
                           (11, text[11]): 1, (12, "1234 !!"): 1})
    assert jaccard.near_duplicates(nothing).count() == 0 and jaccard.one_of_each_group(nothing).count() == 0


def test_word_hashes_tell_words_apart():
    texts = [b"a b ab", b"A B AB", b"", b"x" * 300, "été".encode()]
    hashed, begin = hashing.words(texts)
    assert begin.tolist() == [0, 3, 6, 6, 7, 8]
    assert hashed[:3].tolist() == hashed[3:6].tolist() and len(set(hashed.tolist())) == 5
