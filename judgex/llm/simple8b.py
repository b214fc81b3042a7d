"""Simple-8b word-aligned coding of ids, by block, and the shard files that hold it.

A 64-bit word has a selector in its upper four bits and ids in the other sixty: 60 of 1 bit, 30 of 2, ... 1 of 60 bits.
Two selectors are left over. One is a run: one id below 2**32, and how often it comes. The other is an escape, for ids of more
than sixty bits: the word gives a place in the list of whole ids that follows its block.

Ids are coded in blocks of ``BLOCK``; no word crosses a block. A shard's index has every block's offset, so a reader decodes
any range of ids from its blocks alone, and all blocks at once: counts of words follow from their selectors, places from
running sums of counts, and the ids of all words with one selector come from the same shifts.

Shard file, little endian: header; blocks (words, then whole ids); index of blocks (offset, ids, words, escapes); documents (doc_id, is it null,
ids); footer (offset of the index, blocks, crc32 of all before the footer, magic); one zero byte.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np

BLOCK = 1024
#: Fixed values of the coding: (ids in a word, bits of each) of selectors 2 to 15.
LAYOUTS = ((60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60))
RUN, ESCAPE, FIRST = 0, 1, 2
_U = np.uint64
_LOW = _U((1 << 60) - 1)
MAGIC = b"JXS8"
_HEAD = struct.Struct("<4sIIIQQ")
_FOOT = struct.Struct("<QQI4s")
_BLOCKS = np.dtype([("offset", "<u8"), ("ids", "<u4"), ("words", "<u4"), ("escapes", "<u4")])
_DOCS = np.dtype([("doc_id", "<i8"), ("null", "u1"), ("ids", "<u8")])
#: Ids coded at a time, which bounds the coder's working memory.
_STRIP = 256 * BLOCK


class Blocks(NamedTuple):
    """Words of blocks one after another; of each block how many ids, words and escapes; whole ids of the escapes."""

    words: np.ndarray
    ids: np.ndarray
    n_words: np.ndarray
    n_escapes: np.ndarray
    escapes: np.ndarray


def _selectors(ids: np.ndarray, block: int) -> np.ndarray:
    """For a word that begins at each place the layout of most ids that all fit, or an escape; nothing lies beyond a block's end."""
    n, blocks, most = len(ids), -(-len(ids) // block), int(ids.max(initial=0))
    longest = LAYOUTS[0][0]
    least = np.zeros((blocks, block + longest), np.uint8)  # the first layout that is wide enough for the id
    flat = np.zeros(blocks * block, np.uint8)
    for _, bits in LAYOUTS:
        if most >= 1 << bits:
            flat[:n] += ids >= _U(1 << bits)
    least[:, :block] = flat.reshape(blocks, block)
    tops = {1: least}  # of so many ids from each place on
    while 2 * (k := max(tops)) <= longest:
        tops[2 * k] = least = tops[k].copy()
        np.maximum(least[:, :-k], tops[k][:, k:], out=least[:, :-k])
    select = np.full((blocks, block), ESCAPE, np.int8)
    for s in range(len(LAYOUTS) - 1, -1, -1):
        size = LAYOUTS[s][0]
        k = 1 << size.bit_length() - 1
        top = np.maximum(tops[k][:, :block], tops[k][:, size - k : size - k + block])
        np.copyto(select, np.int8(FIRST + s), where=top <= s)
    return select.ravel()[:n]


def encode(ids: np.ndarray, block: int = BLOCK) -> Blocks:
    """Each word takes as many of the next ids as any selector can."""
    ids = np.ascontiguousarray(ids, np.uint64)
    n = len(ids)
    place = np.arange(n, dtype=np.int32)  # ids are coded in strips of far fewer than 2**31
    end = np.minimum((place // block + 1) * block, n).astype(np.int32)
    left = end - place
    sizes = np.array([1] * FIRST + [size for size, _ in LAYOUTS], np.int32)

    def until(bad: np.ndarray) -> np.ndarray:
        """The first bad place from each place on, or the block's end."""
        at = np.append(np.flatnonzero(bad), n).astype(np.int32)
        return np.minimum(np.repeat(at, np.diff(at, prepend=-1))[:n], end)

    select = _selectors(ids, block)
    count = np.minimum(sizes[select], left)
    change = np.ones(n, bool)
    change[1:] = ids[1:] != ids[:-1]
    far = until(np.append(change[1:], True)) + 1 if n else place
    same = np.minimum(far, end) - place
    runs = (same > count) & (ids < 1 << 32)
    select[runs], count[runs] = RUN, same[runs]
    del far, same, runs, left

    # all blocks take their next word at once
    starts, at = np.arange(0, n, block, dtype=np.int32), []
    stop = end[starts] if n else starts
    while len(starts):
        at.append(starts)
        starts = starts + count[starts]
        on = starts < stop
        starts, stop = starts[on], stop[on]
    at = np.sort(np.concatenate(at)) if at else place
    words, kind = np.zeros(len(at), np.uint64), select[at]
    for s, (size, bits) in enumerate(LAYOUTS):
        own = np.flatnonzero(kind == FIRST + s)
        p = at[own]
        for j in range(size):
            held = p + j < end[p]
            words[own[held]] |= ids[p[held] + j] << _U(bits * j)
        words[own] |= _U((FIRST + s) << 60)
    own = kind == RUN
    words[own] = ids[at[own]] | count[at[own]].astype(np.uint64) << _U(32)
    own = kind == ESCAPE
    owner, blocks = at // block, -(-n // block)
    escaped = np.bincount(owner[own], minlength=blocks)
    rank = np.arange(int(own.sum())) - np.repeat(np.cumsum(escaped) - escaped, escaped)
    words[own] = rank.astype(np.uint64) | _U(ESCAPE << 60)
    sizes = np.minimum(block, n - np.arange(blocks) * block)
    return Blocks(words, sizes, np.bincount(owner, minlength=blocks), escaped, ids[at[own]])


def decode(b: Blocks) -> np.ndarray:
    """The ids of all blocks."""
    kind = (b.words >> _U(60)).astype(np.int64)
    sizes = np.array([0, 1, *(size for size, _ in LAYOUTS)])
    count = sizes[kind]
    count[kind == RUN] = (b.words[kind == RUN] >> _U(32)).astype(np.int64)
    owner = np.repeat(np.arange(len(b.n_words)), b.n_words)
    before = np.cumsum(count) - count
    first = np.cumsum(b.n_words) - b.n_words
    before -= before[first[owner]] if len(before) else 0
    count = np.minimum(count, b.ids[owner] - before)  # the last word of a block may have room left
    at = before + (np.cumsum(b.ids) - b.ids)[owner]
    out = np.zeros(int(b.ids.sum()), np.uint64)
    for s, (size, bits) in enumerate(LAYOUTS):
        own = np.flatnonzero(kind == FIRST + s)
        if len(own):
            w, p, c, mask = b.words[own] & _LOW, at[own], count[own], _U((1 << bits) - 1)
            for j in range(size):
                held = c > j
                out[p[held] + j] = w[held] >> _U(bits * j) & mask
    for i in np.flatnonzero(kind == RUN):
        out[at[i] : at[i] + count[i]] = b.words[i] & _U(0xFFFFFFFF)
    own = kind == ESCAPE
    if own.any():
        base = (np.cumsum(b.n_escapes) - b.n_escapes)[owner[own]]
        out[at[own]] = b.escapes[base + (b.words[own] & _LOW).astype(np.int64)]
    return out


def pack(ids: np.ndarray, docs: list[tuple[int | None, int]], part: int = 0, seq: int = 0, block: int = BLOCK) -> bytes:
    """A shard file without its last byte; docs: (doc_id, number of ids) in order."""
    out, index, offset = [_HEAD.pack(MAGIC, 1, part, seq, len(docs), len(ids))], [], _HEAD.size
    strip = max(1, _STRIP // block) * block
    for lo in range(0, len(ids), strip):
        b = encode(ids[lo : lo + strip], block)
        w, e = np.cumsum(b.n_words), np.cumsum(b.n_escapes)
        for i in range(len(b.ids)):
            own = b.words[w[i] - b.n_words[i] : w[i]].astype("<u8").tobytes() + b.escapes[e[i] - b.n_escapes[i] : e[i]].astype("<u8").tobytes()
            index.append((offset, b.ids[i], b.n_words[i], b.n_escapes[i]))
            out.append(own)
            offset += len(own)
    out += [np.array(index, _BLOCKS).tobytes(), np.array([(0 if d is None else d, d is None, n) for d, n in docs], _DOCS).tobytes()]
    body = b"".join(out)
    return body + _FOOT.pack(offset, len(index), zlib.crc32(body), MAGIC)


class Shard:
    """A shard file's content, read by block."""

    def __init__(self, content: bytes):
        end = len(content) - 1 - _FOOT.size
        if end < _HEAD.size or content[:4] != MAGIC or content[-5:-1] != MAGIC:
            raise ValueError("not a shard, or cut short")
        at, n, crc, _ = _FOOT.unpack_from(content, end)
        if zlib.crc32(memoryview(content)[:end]) != crc:
            raise ValueError("a shard's checksum is wrong")
        _, _, self.part, self.seq, n_docs, self.n_ids = _HEAD.unpack_from(content)
        self.index = np.frombuffer(content, _BLOCKS, n, at)
        self.docs = np.frombuffer(content, _DOCS, n_docs, at + n * _BLOCKS.itemsize)
        self.content = content

    def blocks(self, lo: int, hi: int) -> np.ndarray:
        """The ids of blocks [lo, hi)."""
        own = self.index[lo:hi]
        if not len(own):
            return np.zeros(0, np.uint64)
        n_words, n_escapes = own["words"].astype(np.int64), own["escapes"].astype(np.int64)
        a = int(own["offset"][0])
        both = np.frombuffer(self.content, "<u8", int((n_words + n_escapes).sum()), a)
        is_word = np.repeat(np.tile([True, False], len(own)), np.column_stack((n_words, n_escapes)).ravel())
        return decode(Blocks(both[is_word], own["ids"].astype(np.int64), n_words, n_escapes, both[~is_word]))

    def ids(self, lo: int = 0, hi: int | None = None) -> np.ndarray:
        """The ids at places [lo, hi) of the shard; only the blocks that hold them are decoded."""
        hi = self.n_ids if hi is None else min(hi, self.n_ids)
        if lo >= hi:
            return np.zeros(0, np.uint64)
        ends = np.cumsum(self.index["ids"], dtype=np.int64)
        a, b = (int(x) for x in np.searchsorted(ends, [lo, hi - 1], "right"))
        base = int(ends[a] - self.index["ids"][a])
        return self.blocks(a, b + 1)[lo - base : hi - base]

    def strips(self) -> Iterator[np.ndarray]:
        """All ids, a bounded number of blocks at a time."""
        step = max(1, _STRIP // BLOCK)
        for lo in range(0, len(self.index), step):
            yield self.blocks(lo, lo + step)
