"""Whole-text encoding with a public tokenizer, word by word from a bounded store.

The byte-level pre-tokenizer always cuts at certain places, whatever stands around them, and merges never
cross a cut. A text is therefore the sequence of its segments between such places, and a segment that was
met before need not be encoded again. The cuts, taken from the bytes with numpy:

* before a single space between two characters that are not white space;
* between a letter and a closing punctuation mark or line break;
* after a single line break between two characters that are not white space.

Where a character might be white space or might not be a letter, nothing is cut: fewer cuts are always
right. Segments are told apart by a 64-bit hash and encoded by the library.
"""

from __future__ import annotations

import os
from itertools import chain

import numpy as np

from tidemark.llm.hashing import BASE, BYTE_CODE, INVERSE, U64, chunks, mix, powers

STORED_SEGMENTS = 1_500_000
CHUNK_BYTES = 1 << 21
GAP = 0xFF  # between texts; no UTF-8 text holds it

PLAIN = np.zeros(256, dtype=bool)
PLAIN[0x21:0x7F] = True
#: First bytes of characters that are surely not white space (those begin with C2, E1, E2 or E3).
SOLID = PLAIN.copy()
SOLID[[0xC3, *range(0xC4, 0xE1), *range(0xE4, 0xF5)]] = True
LETTER = np.zeros(256, dtype=bool)
LETTER[[*range(65, 91), *range(97, 123)]] = True
CLOSING = np.zeros(256, dtype=bool)
CLOSING[list(b".,!?;:\n")] = True

_encoders: dict[str, "SegmentEncoder | PieceModel"] = {}


def is_byte_level(tokenizer) -> bool:
    """True where the cuts are known not to change the ids."""
    kind = repr(tokenizer.pre_tokenizer)
    return (tokenizer.normalizer is None and kind.startswith("ByteLevel(")
            and "add_prefix_space=False" in kind and "use_regex=True" in kind)


def segment_starts(b: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Where a segment starts in texts that lie one after the other, each with a gap byte after it."""
    before1 = np.concatenate([[GAP], b[:-1]]).astype(np.uint8)
    before2 = np.concatenate([[GAP, GAP], b[:-2]]).astype(np.uint8)[:len(b)]
    after = np.concatenate([b[1:], [GAP]]).astype(np.uint8)
    latin = (before2 == 0xC3) & (before1 != 0x97) & (before1 != 0xB7)  # letters from A-grave on
    letter = LETTER[before1] | (latin & (before1 >= 0x80) & (before1 < 0xC0))
    start = (b == 0x20) & (PLAIN[before1] | letter) & SOLID[after]
    start |= CLOSING[b] & letter
    start |= (before1 == 0x0A) & PLAIN[before2] & SOLID[b]
    start[begins] = True
    start &= b != GAP
    return np.flatnonzero(start)


class SegmentEncoder:
    """Ids of whole texts, from the stored ids of at most ``limit`` segments."""

    def __init__(self, path: str, limit: int = STORED_SEGMENTS) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.by_segment = is_byte_level(self.tokenizer)
        self.limit = limit
        self.clear()

    def clear(self) -> None:
        self.hashes = np.zeros(0, dtype=U64)  # ascending
        self.place = np.zeros(0, dtype=np.int64)  # of a hash's entry in starts and lengths
        self.starts, self.lengths = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        self.ids = np.zeros(1 << 20, dtype=np.uint32)
        self.used = 0

    def _library(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        lengths = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
        return np.fromiter(chain.from_iterable(ids), dtype=np.uint32, count=int(lengths.sum())), lengths

    def _learn(self, hashes: np.ndarray, segments: list[str]) -> None:
        ids, lengths = self._library(segments)
        if len(self.hashes) + len(hashes) > self.limit:
            self.clear()
        while self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[self.used:self.used + len(ids)] = ids
        at = np.searchsorted(self.hashes, hashes)
        self.hashes = np.insert(self.hashes, at, hashes)
        self.place = np.insert(self.place, at, len(self.starts) + np.arange(len(hashes)))
        self.starts = np.concatenate([self.starts, self.used + np.cumsum(lengths) - lengths])
        self.lengths = np.concatenate([self.lengths, lengths])
        self.used += len(ids)

    def _known(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.hashes):
            return np.zeros(len(hashes), dtype=bool)
        return self.hashes[np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)] == hashes

    def _chunk(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        whole = b"\xff".join([*texts, b""])
        b = np.frombuffer(whole, dtype=np.uint8)
        ends = np.cumsum([len(t) + 1 for t in texts])
        begins = np.concatenate([[0], ends[:-1]])
        start = segment_starts(b, begins)
        if not len(start):
            return np.zeros(0, dtype=np.uint32), np.zeros(len(texts), dtype=np.int64)
        owner = np.searchsorted(ends, start, side="right")
        stop = np.append(start[1:], len(b))
        stop = np.minimum(stop, ends[owner] - 1)
        code = BYTE_CODE[b]
        total = np.concatenate([[U64(0)], np.cumsum(code * powers(BASE, len(b)), dtype=U64)])
        hashed = mix((total[stop] - total[start]) * powers(INVERSE, len(b))[start] + (stop - start).astype(U64))
        distinct, first, which = np.unique(hashed, return_index=True, return_inverse=True)
        new = np.flatnonzero(~self._known(distinct))
        if len(new):
            if len(self.hashes) + len(new) > self.limit:
                self.clear()
                new = np.arange(len(distinct))
            self._learn(distinct[new], [whole[start[i]:stop[i]].decode() for i in first[new]])
        code = self.place[np.searchsorted(self.hashes, distinct)][which]
        lengths = self.lengths[code]
        before = np.cumsum(lengths) - lengths
        ids = self.ids[np.repeat(self.starts[code] - before, lengths) + np.arange(int(lengths.sum()))]
        return ids, np.bincount(owner, lengths, len(texts)).astype(np.int64)

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, and how many each text has."""
        if not self.by_segment:
            return self._library([t.decode() for t in texts])
        out, sizes = [np.zeros(0, dtype=np.uint32)], [np.zeros(0, dtype=np.int64)]
        for first, last in chunks(texts, CHUNK_BYTES):
            ids, lengths = self._chunk(texts[first:last])
            out.append(ids)
            sizes.append(lengths)
        return np.concatenate(out), np.concatenate(sizes)


class PieceModel:
    """Ids of a sentencepiece model."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        ids = [np.array(self.model.encode(t.decode()), dtype=np.uint32) for t in texts]
        return np.concatenate([np.zeros(0, np.uint32), *ids]), np.array([len(x) for x in ids], dtype=np.int64)


def encoder(path: str) -> SegmentEncoder | PieceModel:
    """The encoder of a vocabulary file, one per worker process."""
    if path not in _encoders:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _encoders[path] = PieceModel(path) if path.endswith(".model") else SegmentEncoder(path)
    return _encoders[path]
