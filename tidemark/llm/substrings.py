"""Repeated substrings by blockwise suffix sorting.

Every byte that lies in a ``WINDOW``-byte string which also starts in a document of a smaller id is
removed. Equal windows stand next to each other in sorted suffix order, so it takes a suffix array and the
least id in each run of suffixes that agree on ``WINDOW`` bytes. The suffixes are sorted one bucket at a
time, and only those that can have a partner at all:

1. *Anchors.* The anchor of a window is the ``GRAM``-byte string in it with the smallest hash; equal
   windows have equal anchors. The hashes, packed by blocks, tell which anchors occur in two documents.
2. *Buckets.* Neighbouring windows with the same anchor form one stretch of text. Stretches of shared
   anchors go to the bucket of their anchor's hash; equal stretches within one map-side piece go once, with
   the least id, and the other documents that hold them are already decided. Stretches whose anchor more
   than ``HOT_DOCS`` documents hold are cut into their single windows, which go to a bucket by a hash of
   their own bytes and are sorted there: equal windows still meet, and no bucket takes all that surrounds a common phrase.
3. *Suffix sort.* A bucket's distinct stretches are sorted by their first eight bytes; ties, however long,
   by the ranks of a difference-cover sample (residues 0, 1, 3 modulo 7), which are computed before: for
   any two suffixes some shift below 7 takes both to sampled places. Memory is that of one bucket.
4. *Runs.* Neighbours that agree on ``WINDOW`` bytes share the least id of their run; a window whose own id
   is larger is covered.

Texts travel as compressed packs, keyed by a bucket of their id. No text is taken by prefix, and no bucket
is cut short: a frequent stretch reaches its bucket once per piece.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import pieces, release, ship_code
from tidemark.llm.hashing import BASE, BYTE_CODE, INVERSE, U64, chunks, mix, powers

WINDOW = 50
GRAM = 20
PIECE_BYTES = 6 << 20
BLOCK_BYTES = 12 << 20  # text per block of anchors, per bucket of texts, and per bucket of stretches
LEAST_BITS = 6
HOT_DOCS = 1 << 15  # documents with an anchor from which its windows go by their own bytes
HOT_BUCKETS = 16  # buckets of such windows per bucket of stretches: a window alone is up to 16 times its share of one
PERIOD, COVER = 7, (0, 1, 3)
RANK_WORDS = 7  # 56 bytes, more than the window


# --- anchors ------------------------------------------------------------------------------------------

def anchors(texts: list[bytes], window: int = WINDOW, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """``(text, first, last, hash)`` of every stretch: windows ``first`` to ``last`` of a text, both
    included and counted from its begin, whose anchor has that hash."""
    out = []
    for low, high in chunks(texts, 1 << 20):
        part = texts[low:high]
        b = np.frombuffer(b"".join(part), dtype=np.uint8)
        begins = np.concatenate([[0], np.cumsum([len(t) for t in part])])
        n = len(b) - window + 1
        if n <= 0:
            continue
        total = np.concatenate([[U64(0)], np.cumsum(BYTE_CODE[b] * powers(BASE, len(b)), dtype=U64)])
        hashed = mix((total[gram:] - total[:-gram]) * powers(INVERSE, len(b) - gram + 1))
        # The upper half orders, the place settles ties and comes out with the minimum.
        least = (hashed & ~U64(0xFFFFFFFF)) | np.arange(len(hashed), dtype=U64)
        width, span = window - gram + 1, 1
        while span * 2 <= width:
            least, span = np.minimum(least[:-span], least[span:]), span * 2
        if span < width:
            least = np.minimum(least[:len(least) - (width - span)], least[width - span:])
        place = (least & U64(0xFFFFFFFF)).astype(np.int64)
        text = np.searchsorted(begins, np.arange(n), side="right") - 1
        whole = np.arange(n) + window <= begins[text + 1]
        new = np.concatenate([[True], (place[1:] != place[:-1]) | (text[1:] != text[:-1])])
        start = np.flatnonzero(new)
        # Windows that reach into the next text are the last ones of their text.
        size = np.add.reduceat(whole.astype(np.int64), start)
        start, size = start[size > 0], size[size > 0]
        out.append((text[start] + low, start - begins[text[start]], start - begins[text[start]] + size - 1, hashed[place[start]]))
    if not out:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, U64),)
    return tuple(np.concatenate(x) for x in zip(*out))


# --- packs of texts -----------------------------------------------------------------------------------

def _spread(ids: np.ndarray, buckets: int) -> np.ndarray:
    return (mix(ids.view(U64) + U64(77)) % U64(buckets)).astype(np.int64)


TEXTS = "bucket int, ids binary, tags binary, sizes binary, data binary"


def _texts(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            ids, tags = (batch.column(i).to_numpy() for i in (0, 2))
            for first, texts in pieces(batch.column(1), PIECE_BYTES):
                own = slice(first, first + len(texts))
                to = _spread(ids[own], buckets)
                rows = []
                for bucket in np.unique(to):
                    at = np.flatnonzero(to == bucket)
                    held = [texts[i] for i in at]
                    rows.append({"bucket": int(bucket), "ids": ids[own][at].tobytes(), "tags": tags[own][at].tobytes(),
                                 "sizes": np.array([len(t) for t in held], dtype=np.int64).tobytes(),
                                 "data": press.compress(b"".join(held))})
                yield pa.RecordBatch.from_pylist(rows, schema=pa.schema(
                    [("bucket", pa.int32())] + [(n, pa.binary()) for n in ("ids", "tags", "sizes", "data")]))
    return run


def _unpack(table: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray, list[bytes]]]:
    for row in table.to_pylist():
        sizes = np.frombuffer(row["sizes"], np.int64)
        data, ends = zstandard.ZstdDecompressor().decompress(row["data"]) if sizes.sum() else b"", np.cumsum(sizes)
        yield (np.frombuffer(row["ids"], np.int64), np.frombuffer(row["tags"], np.int64),
               [data[e - n:e] for n, e in zip(sizes.tolist(), ends.tolist())])


# --- which anchors two documents share ----------------------------------------------------------------

#: Blocks from ``1 << bits`` on are buckets of texts: what needs no block's task passes by in them.
HASHES = "block int, ids binary, counts binary, hashes binary, marks binary, marked binary"


def _five(hashed: np.ndarray, bits: int) -> bytes:
    """The 40 bits that follow the ``bits`` bits of the block."""
    return np.ascontiguousarray((hashed << U64(bits)).astype(">u8").view(np.uint8).reshape(-1, 8)[:, :5]).tobytes()


def _wide(packed: list[bytes], block: int) -> np.ndarray:
    wide = np.zeros((sum(map(len, packed)) // 5, 8), dtype=np.uint8)
    wide[:, 3:] = np.frombuffer(b"".join(packed), np.uint8).reshape(-1, 5)
    return wide.reshape(-1).view(">u8").astype(np.uint64) | U64(block << 40)


def _hashes(bits: int, buckets: int):
    """Anchor hashes by block, per document. One that two documents of a piece hold is known to be shared:
    its entries pass by, and the block's task gets one mark with their number instead."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for first, texts in pieces(batch.column(1), PIECE_BYTES):
                own = ids[first:first + len(texts)]
                text, _, _, hashed = anchors(texts)
                order = np.lexsort((own[text], hashed))
                doc, hashed = own[text][order], hashed[order]
                fresh = np.concatenate([[True], (hashed[1:] != hashed[:-1]) | (doc[1:] != doc[:-1])]) if len(doc) else np.zeros(0, bool)
                doc, hashed = doc[fresh], hashed[fresh]
                begin = np.flatnonzero(np.concatenate([[True], hashed[1:] != hashed[:-1]])) if len(hashed) else np.zeros(0, np.int64)
                held = np.diff(np.append(begin, len(hashed)))
                many = np.repeat(held > 1, held)
                marks, marked = hashed[begin[held > 1]], held[held > 1].astype(np.int32)
                rows = []
                to = _spread(doc[many], buckets)
                order = np.argsort(to, kind="stable")
                to, known, short = to[order], doc[many][order], _short(hashed[many], bits)[order]
                cut = np.flatnonzero(np.diff(to, prepend=-1, append=-1))
                for a, b in zip(cut[:-1], cut[1:]):
                    rows.append({"block": (1 << bits) + int(to[a]), "ids": known[a:b].tobytes(), "hashes": short[a:b].tobytes()})
                doc, hashed = doc[~many], hashed[~many]
                numbers = np.arange((1 << bits) + 1, dtype=np.int64)
                cuts, ends = (np.searchsorted((h >> U64(64 - bits)).astype(np.int64), numbers) for h in (hashed, marks))
                for b in np.flatnonzero(np.diff(cuts) | np.diff(ends)):
                    d, h = doc[cuts[b]:cuts[b + 1]], hashed[cuts[b]:cuts[b + 1]]
                    by = np.argsort(d, kind="stable")
                    who, count = np.unique(d, return_counts=True)
                    rows.append({"block": int(b), "ids": who.tobytes(), "counts": count.astype(np.int32).tobytes(), "hashes": _five(h[by], bits),
                                 "marks": _five(marks[ends[b]:ends[b + 1]], bits), "marked": marked[ends[b]:ends[b + 1]].tobytes()})
                yield pa.RecordBatch.from_pylist(rows, schema=pa.schema(
                    [("block", pa.int32())] + [(n, pa.binary()) for n in ("ids", "counts", "hashes", "marks", "marked")]))
    return run


ACTIVE = "bucket int, ids binary, hashes binary, hot binary"


def _short(hashed: np.ndarray, bits: int) -> np.ndarray:
    """What a block knows of a hash: its own bits and the 40 that follow."""
    return hashed >> U64(64 - bits - 40)


def _shared(bits: int, buckets: int, hot_docs: int):
    def run(table: pa.Table) -> pa.Table:
        """The entries of one block whose hash occurs in two documents, by bucket of texts, and for every
        bucket which hashes more than ``hot_docs`` hold. Of what was known to be shared only the marks are here."""
        block = table.column("block")[0].as_py()
        of = {n: table.column(n).to_pylist() for n in ("ids", "counts", "hashes", "marks", "marked")}
        if block >= 1 << bits:
            return pa.table({"bucket": pa.array([block - (1 << bits)] * table.num_rows, pa.int32()), "ids": pa.array(of["ids"], pa.binary()),
                             "hashes": pa.array(of["hashes"], pa.binary()), "hot": pa.array([b""] * table.num_rows, pa.binary())})
        doc = np.concatenate([np.repeat(np.frombuffer(i, np.int64), np.frombuffer(c, np.int32)) for i, c in zip(of["ids"], of["counts"])])
        hashed, marks = _wide(of["hashes"], block), _wide(of["marks"], block)
        order = np.argsort(hashed, kind="stable")
        doc, hashed = doc[order], hashed[order]
        names, of_mark = np.unique(marks, return_inverse=True)
        known = np.bincount(of_mark, np.frombuffer(b"".join(of["marked"]), np.int32), len(names)).astype(np.int64)
        begin = np.flatnonzero(np.concatenate([[True], hashed[1:] != hashed[:-1]])) if len(doc) else np.zeros(0, np.int64)
        held = np.diff(np.append(begin, len(doc)))
        shared = np.minimum.reduceat(doc, begin) != np.maximum.reduceat(doc, begin) if len(doc) else np.zeros(0, bool)
        every, at = np.unique(np.concatenate([names, hashed[begin]]), return_inverse=True)
        total = np.bincount(at, np.concatenate([known, held]), len(every))
        hot = every[total > hot_docs].tobytes()
        many = np.repeat(shared | np.isin(hashed[begin], names), held)
        doc, hashed = doc[many], hashed[many]
        to = _spread(doc, buckets)
        order = np.argsort(to, kind="stable")
        to, doc, hashed = to[order], doc[order], hashed[order]
        if hot:  # texts that hold it can be in any bucket
            ends = np.searchsorted(to, np.arange(buckets + 1))
            return pa.table({"bucket": pa.array(np.arange(buckets), pa.int32()),
                             "ids": pa.array([doc[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:])], pa.binary()),
                             "hashes": pa.array([hashed[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:])], pa.binary()),
                             "hot": pa.array([hot] * buckets, pa.binary())})
        cut = np.flatnonzero(np.concatenate([[True], to[1:] != to[:-1], [True]])) if len(to) else np.zeros(1, int)
        return pa.table({"bucket": pa.array([int(to[a]) for a in cut[:-1]], pa.int32()),
                         "ids": pa.array([doc[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:])], pa.binary()),
                         "hashes": pa.array([hashed[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:])], pa.binary()),
                         "hot": pa.array([b""] * (len(cut) - 1), pa.binary())})
    return run


# --- stretches, by bucket of their anchor -------------------------------------------------------------

#: kind 0: stretches for a suffix bucket. kind 1: windows already known to be covered, by bucket of texts.
#: kind 2: single windows of hot anchors, by their own bytes.
STRETCHES = "kind int, bucket int, ids binary, tags binary, firsts binary, sizes binary, data binary"


def _rows(kind: int | None, bucket: np.ndarray, ids: np.ndarray, tags: np.ndarray, firsts: np.ndarray,
          sizes: np.ndarray, data: list[bytes] | None = None) -> list[dict]:
    """One row per bucket, its entries in the order given."""
    order = np.argsort(bucket, kind="stable")
    cut = np.flatnonzero(np.diff(bucket[order], prepend=-1, append=-1))
    out = []
    for a, b in zip(cut[:-1], cut[1:]):
        at = order[a:b]
        row = {"bucket": int(bucket[at[0]]), "ids": ids[at].tobytes(), "tags": tags[at].tobytes(),
               "firsts": firsts[at].tobytes(), "sizes": sizes[at].tobytes()}
        if kind is not None:
            packed = zstandard.ZstdCompressor(level=3).compress(b"".join([data[i] for i in at])) if data is not None else b""
            row |= {"kind": kind, "data": packed}
        out.append(row)
    return out


def _hot_windows(buckets: int, which: np.ndarray, content: list[bytes], doc: np.ndarray, tag: np.ndarray,
                 first: np.ndarray, sizes: np.ndarray) -> list[dict]:
    """The windows of the stretches ``which``, least id first, each by its own bytes; those that a smaller id
    of these stretches holds are decided."""
    owner = np.repeat(which, sizes[which])
    at = np.arange(len(owner)) - np.repeat(np.cumsum(sizes[which]) - sizes[which], sizes[which])
    windows = [content[i][a:a + WINDOW] for i, a in zip(owner.tolist(), at.tolist())]
    seen: dict[bytes, int] = {}
    done = np.array([seen.setdefault(w, d) < d for w, d in zip(windows, doc[owner].tolist())], dtype=bool)
    to = np.array([zlib.crc32(w) for w in windows], dtype=np.int64) % (buckets * HOT_BUCKETS)
    one, place, sent = np.ones(len(owner), np.int64), first[owner] + at, np.flatnonzero(~done)
    return (_rows(2, to[sent], doc[owner][sent], tag[owner][sent], place[sent], one[sent], [windows[i] for i in sent.tolist()])
            + _rows(1, _spread(doc[owner][done], buckets), doc[owner][done], tag[owner][done], place[done], one[done]))


def _stretches(bits: int, buckets: int):
    def run(texts: pa.Table, active: pa.Table) -> pa.Table:
        """Stretches of the texts of one bucket whose anchors are shared."""
        release()
        names = ["kind", "bucket", "ids", "tags", "firsts", "sizes", "data"]
        docs = np.concatenate([np.zeros(0, np.int64), *[np.frombuffer(x, np.int64) for x in active.column("ids").to_pylist()]])
        marks = np.concatenate([np.zeros(0, U64), *[np.frombuffer(x, U64) for x in active.column("hashes").to_pylist()]])
        known = np.unique(marks * U64(0x9E3779B97F4A7C15) ^ mix(docs.view(U64)))
        rows: list[dict] = []
        packs = list(_unpack(texts)) if len(known) else []
        if packs:
            ids, tags = (np.concatenate([p[i] for p in packs]) for i in (0, 1))
            held = [t for p in packs for t in p[2]]
            text, first, last, hashed = anchors(held)
            asked = _short(hashed, bits) * U64(0x9E3779B97F4A7C15) ^ mix(ids[text].view(U64))
            at = np.flatnonzero(known[np.minimum(np.searchsorted(known, asked), len(known) - 1)] == asked)
            # Least id first, so that equal stretches after the first are those of larger or equal ids.
            at = at[np.argsort(ids[text[at]], kind="stable")]
            text, first, hashed, sizes = text[at], first[at], hashed[at], last[at] - first[at] + 1
            content = [held[t][f:f + n + WINDOW - 1] for t, f, n in zip(text.tolist(), first.tolist(), sizes.tolist())]
            doc, tag = ids[text], tags[text]
            seen: dict[bytes, int] = {}
            done = np.array([seen.setdefault(c, d) < d for c, d in zip(content, doc.tolist())], dtype=bool)
            to = (hashed % U64(buckets)).astype(np.int64)
            sent = np.flatnonzero(~done)
            rows = _rows(1, _spread(doc[done], buckets), doc[done], tag[done], first[done], sizes[done])
            hot = np.unique(np.concatenate([np.zeros(0, U64), *[np.frombuffer(x, U64) for x in active.column("hot").to_pylist()]]))
            cut = np.isin(_short(hashed[sent], bits), hot)
            if cut.any():
                rows += _hot_windows(buckets, sent[cut], content, doc, tag, first, sizes)
                sent = sent[~cut]
            rows += _rows(0, to[sent], doc[sent], tag[sent], first[sent], sizes[sent], [content[i] for i in sent.tolist()])
        return pa.Table.from_pylist(rows, schema=pa.schema(
            [(n, pa.int32() if n in ("kind", "bucket") else pa.binary()) for n in names]))
    return run


# --- suffix sort of one bucket ------------------------------------------------------------------------

def _shift(r: int, s: int) -> int:
    """The least shift that takes two residues into the cover."""
    return next(d for d in range(PERIOD) if (r + d) % PERIOD in COVER and (s + d) % PERIOD in COVER)


def sort_suffixes(text: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``at`` in the order of the suffixes that begin there, to a depth of 56 bytes at least, and the
    eight-byte words at every place."""
    padded = np.concatenate([text, np.zeros(8 * RANK_WORDS + 24, dtype=np.uint8)])
    words = np.zeros(len(text) + 8 * RANK_WORDS + 8, dtype=np.uint64)
    for k in range(8):
        words = (words << U64(8)) | padded[k:k + len(words)]
    # Ranks of the cover sample, as far as a shift leads to it.
    met = np.zeros(len(text) + PERIOD, dtype=bool)
    for shift in range(PERIOD):
        met[at + shift] = True
    sample = np.flatnonzero(met)
    sample = sample[np.isin(sample % PERIOD, COVER)]
    deep = np.stack([words[sample + 8 * k] for k in range(RANK_WORDS)], axis=1).astype(">u8").view(f"S{8 * RANK_WORDS}").ravel()
    order = np.argsort(deep, kind="stable")
    deep = deep[order]
    rank = np.zeros(len(text) + 2 * PERIOD, dtype=np.int64)
    rank[sample[order]] = np.cumsum(np.concatenate([[True], deep[1:] != deep[:-1]]))
    # The suffixes of each residue in their own order. A suffix comes after those before it in its class
    # and after all smaller ones of the other classes; equal ones go by class.
    first = np.unique(words[at], return_inverse=True)[1].astype(np.int64) << 32
    own = []
    for r in range(PERIOD):
        mine = np.flatnonzero(at % PERIOD == r)
        own.append(mine[np.argsort(first[mine] | rank[at[mine] + _shift(r, r)], kind="stable")])
    key = {(r, d): first[own[r]] | rank[at[own[r]] + d] for r in range(PERIOD) for d in {_shift(r, s) for s in range(PERIOD)}}
    position = np.zeros(len(at), dtype=np.int64)
    for r in range(PERIOD):
        place = np.arange(len(own[r]))
        for s in range(PERIOD):
            if s != r:
                d = _shift(r, s)
                place += np.searchsorted(key[s, d], key[r, d], side="left" if r < s else "right")
        position[own[r]] = place
    # Suffixes that agree on 56 bytes may get one place twice, but never one outside their group's.
    return at[np.argsort(position, kind="stable")], words


def lowest_ids(content: list[bytes], least: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """The least id that holds a window, for all windows of all distinct stretches in turn; ``least`` is
    that of the stretch."""
    lengths = np.array([len(c) for c in content], dtype=np.int64)
    begin = np.cumsum(lengths) - lengths
    text = np.frombuffer(b"".join(content), dtype=np.uint8)
    counts = lengths - window + 1
    owner = np.repeat(np.arange(len(content)), counts)
    at = begin[owner] + np.arange(int(counts.sum())) - (np.cumsum(counts) - counts)[owner]
    order, words = sort_suffixes(text, at)
    new = np.zeros(len(order), dtype=bool)
    new[:1] = True
    for offset in [*range(0, window - 7, 8), window - 8]:
        word = words[order + offset]
        new[1:] |= word[1:] != word[:-1]
    run = np.flatnonzero(new)
    holder = np.searchsorted(begin, order, side="right") - 1
    lowest = np.repeat(np.minimum.reduceat(least[holder], run), np.diff(np.append(run, len(order))))
    by_place = np.zeros(len(text), dtype=np.int64)
    by_place[order] = lowest
    return by_place[at]


COVERED = "bucket int, ids binary, tags binary, firsts binary, sizes binary"


def _sorted_bucket(buckets: int):
    def run(table: pa.Table) -> pa.Table:
        """Runs of covered windows of one bucket, by bucket of texts; those already known pass by."""
        names = ("bucket", "ids", "tags", "firsts", "sizes")
        release()
        kind = table.column("kind")[0].as_py()
        if kind == 1:
            return table.select(names)
        of: dict[str, list] = {n: [] for n in names[1:]}
        number: dict[bytes, int] = {}
        which = []
        for row in table.to_pylist():
            for n in of:
                of[n].append(np.frombuffer(row[n], np.int64))
            ends = np.cumsum(of["sizes"][-1] + WINDOW - 1)
            data = zstandard.ZstdDecompressor().decompress(row["data"])
            which += [number.setdefault(data[a:b], len(number)) for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]
        ids, tags, firsts, sizes = (np.concatenate(of[n]) for n in names[1:])
        which = np.array(which, dtype=np.int64)
        least = np.full(len(number), np.iinfo(np.int64).max)
        np.minimum.at(least, which, ids)
        lowest = lowest_ids(list(number), least)
        counts = np.zeros(len(number), dtype=np.int64)
        counts[which] = sizes
        # All windows of all stretches one after the other, and the runs of covered ones among them.
        before, at = np.cumsum(sizes) - sizes, np.cumsum(counts) - counts
        owner = np.repeat(np.arange(len(ids)), sizes)
        place = np.arange(int(sizes.sum())) - before[owner]
        hit = lowest[at[which[owner]] + place] < ids[owner]
        opens = np.flatnonzero(hit & ((place == 0) | ~np.concatenate([[False], hit[:-1]])))
        closes = np.flatnonzero(hit & ((place == sizes[owner] - 1) | ~np.concatenate([hit[1:], [False]])))
        found = owner[opens]
        return pa.Table.from_pylist(
            _rows(None, _spread(ids[found], buckets), ids[found], tags[found], firsts[found] + place[opens], closes - opens + 1),
            schema=pa.schema([("bucket", pa.int32())] + [(n, pa.binary()) for n in names[1:]]))
    return run


# --- removal ------------------------------------------------------------------------------------------

def _spans(firsts: np.ndarray, sizes: np.ndarray, window: int = WINDOW) -> list[tuple[int, int]]:
    """Maximal byte ranges covered by windows that start at ``firsts`` and the ``sizes - 1`` places after."""
    if not len(firsts):
        return []
    order = np.argsort(firsts, kind="stable")
    low, high = firsts[order], (firsts + sizes - 1 + window)[order]
    reach = np.maximum.accumulate(high)
    new = np.concatenate([[True], low[1:] > reach[:-1]])
    return list(zip(low[new].tolist(), reach[np.append(np.flatnonzero(new)[1:] - 1, len(low) - 1)].tolist()))


RESULT = "doc long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary, spans array<array<long>>"


def _removed(with_text: bool):
    def run(texts: pa.Table, covered: pa.Table) -> pa.Table:
        parts = [tuple(np.frombuffer(row[n], np.int64) for n in ("ids", "tags", "firsts", "sizes")) for row in covered.to_pylist()]
        ids, tags, firsts, sizes = (np.concatenate(x) for x in zip(*parts)) if parts else (np.zeros(0, np.int64),) * 4
        order = np.lexsort((tags, ids))
        ids, tags, firsts, sizes = (x[order] for x in (ids, tags, firsts, sizes))
        out: dict[str, list] = {n: [] for n in ("doc", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", "spans")}
        for own, marks, held in _unpack(texts):
            for doc, tag, text in zip(own.tolist(), marks.tolist(), held):
                a, b = np.searchsorted(ids, doc, "left"), np.searchsorted(ids, doc, "right")
                low, high = a + np.searchsorted(tags[a:b], tag, "left"), a + np.searchsorted(tags[a:b], tag, "right")
                spans = _spans(firsts[low:high], sizes[low:high])
                kept, end = [], 0
                for start, stop in spans:
                    kept.append(text[end:start])
                    end = stop
                kept = b"".join([*kept, text[end:]])
                for name, value in zip(out, (doc, len(text), len(text) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(),
                                             kept if with_text else None, [list(s) for s in spans] if with_text else None)):
                    out[name].append(value)
        kinds = [pa.int64()] * 4 + [pa.string(), pa.binary(), pa.list_(pa.list_(pa.int64()))]
        return pa.table({n: pa.array(v, k) for (n, v), k in zip(out.items(), kinds)})
    return run


def remove_repeats(docs: DataFrame, doc: str = "doc_id", text: str = "text", with_text: bool = False) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256)`` per row of ``docs``, and with ``with_text``
    the bytes that stay and the removed byte ranges.

    Texts are UTF-8 bytes, a null is empty. Matches do not cross documents; a string counts as repeated
    where it also starts in a document of a smaller id, whatever is removed there. Rows of the same id do
    not repeat each other. A row without an id takes no part: it keeps its text, and removes nothing from
    others. Other columns are ignored.
    """
    ship_code(docs.sparkSession)
    rows = docs.select(F.col(doc).cast("long").alias("doc"), F.col(text).alias("text"), F.xxhash64(text).alias("tag"))
    named = rows.where("doc is not null")
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    bits = max(LEAST_BITS, (-(-total // BLOCK_BYTES) - 1).bit_length())
    buckets = 1 << bits
    blocks = named.select("doc", "text").mapInArrow(_hashes(bits, buckets), HASHES)
    active = blocks.groupBy("block").applyInArrow(_shared(bits, buckets, HOT_DOCS), ACTIVE)
    packs = named.mapInArrow(_texts(buckets), TEXTS)
    found = packs.groupBy("bucket").cogroup(active.groupBy("bucket")).applyInArrow(_stretches(bits, buckets), STRETCHES)
    covered = found.groupBy("kind", "bucket").applyInArrow(_sorted_bucket(buckets), COVERED)
    done = packs.groupBy("bucket").cogroup(covered.groupBy("bucket")).applyInArrow(_removed(with_text), RESULT)
    unnamed = rows.where("doc is null").select(
        "doc", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"),
        F.lit(0).cast("long").alias("n_spans"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"),
        F.encode(F.coalesce("text", F.lit("")), "UTF-8").alias("kept") if with_text else F.lit(None).cast("binary").alias("kept"),
        F.lit(None).cast("array<array<long>>").alias("spans"))
    more = ["kept", "spans"] if with_text else []
    return done.unionByName(unnamed).select(F.col("doc").alias(doc), "n_bytes", "n_removed", "n_spans", "kept_sha256", *more)
