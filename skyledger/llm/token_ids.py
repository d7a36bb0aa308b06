"""Token ids of texts by a byte-level BPE tokenizer, with the work on recurring pieces done once.

Texts are cut by array operations at places where the byte-level pattern always ends a match, whatever
lies around: between letters, digits, marks and white space of ASCII (and letters of Latin and Cyrillic);
where a character's kind isn't certain the text stays whole. Each piece has its ids alone. Pieces of at most 24
bytes are found in a table of their own bytes, so nothing rests on a hash. New ones go to the tokenizer
in one text, joined where a match always ends, and are told apart by the bytes of their tokens. Strings of added tokens are these tokens, as in the tokenizer's plain call.
"""

from __future__ import annotations

import os

import numpy as np

from skyledger.llm.kernels import mixed, spread

STRETCH = 1 << 20               # bytes worked on at once, also within one long text
KEEP = 1_000_000                # pieces a worker keeps the ids of (speed only)
_WIDE = 24

# Kinds of bytes; 0 is uncertain.
_LETTER, _DIGIT, _MARK, _QUOTE, _SPACE, _LINE = 1, 2, 3, 4, 5, 6
_KIND = np.zeros(256, np.uint8)
_KIND[0x21:0x7F] = _MARK
_KIND[0x30:0x3A] = _DIGIT
_KIND[0x41:0x5B] = _KIND[0x61:0x7B] = _LETTER
_KIND[0x27], _KIND[0x20] = _QUOTE, _SPACE
_KIND[0x09:0x0E] = _LINE
# _ENDS[a, b]: a match always ends between a byte of kind a and one of kind b.
_ENDS = np.zeros((7, 7), bool)
_ENDS[_LETTER, [_DIGIT, _MARK, _QUOTE, _SPACE, _LINE]] = True
_ENDS[_DIGIT, [_LETTER, _MARK, _QUOTE, _SPACE, _LINE]] = True
_ENDS[_MARK, [_LETTER, _DIGIT, _SPACE, _LINE]] = True
_ENDS[_QUOTE, [_SPACE, _LINE]] = True
_ENDS = _ENDS.ravel()
_MASK = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def piece_starts(data: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Where pieces begin: at every edge (a text's start or end) and at certain ends of matches."""
    n = len(data)
    kind = _KIND[data]
    lead = np.flatnonzero((data[:-1] >= 0xC3) & (data[:-1] <= 0xD1)) if n else np.zeros(0, np.int64)
    first, second = data[lead], data[lead + 1] if n else data[:0]
    letter = ((first == 0xC3) & (second != 0x97) & (second != 0xB7)) | (first == 0xC4) | (first == 0xC5) | (first == 0xD0) | (first == 0xD1)
    lead = lead[letter]
    kind[lead] = kind[lead + 1] = _LETTER
    cut, edge = np.zeros(n + 1, bool), np.zeros(n + 1, bool)
    edge[edges] = True
    cut[1:n] = _ENDS[kind[:-1] * np.uint8(7) + kind[1:]]
    # both bytes of a letter count as letters and end nothing between them; white space before something else:
    # the last one begins a piece, and is one alone unless it is a blank, which goes with what follows
    after = np.flatnonzero((kind[:-1] >= _SPACE) & (kind[1:] > 0) & (kind[1:] < _SPACE) & ~edge[1:n]) + 1 if n else lead
    cut[after - 1] = True
    cut[after[kind[after - 1] == _LINE]] = True
    return np.flatnonzero((cut | edge)[:n])


class TokenIds:
    """The ids of texts; ids of recurring pieces are kept."""

    def __init__(self, path: str, keep: int = KEEP, stretch: int = STRETCH):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self._tokenizer = Tokenizer.from_file(path)
        self._marks = [t.content.encode() for t in self._tokenizer.get_added_tokens_decoder().values()]
        vocabulary = self._tokenizer.get_vocab(with_added_tokens=False)
        self._bytes = np.zeros(max(vocabulary.values()) + 1, np.int64)           # of each token: one per character, by this kind's alphabet
        for token, number in vocabulary.items():
            self._bytes[number] = len(token)
        self._keep, self._stretch = keep, stretch
        self._forget(0)

    def _forget(self, need: int) -> None:
        """An empty table, with room for `need` pieces at least."""
        self._bits = (2 * max(self._keep, need)).bit_length()
        slots = 1 << self._bits
        self._keys = np.zeros((3, slots), np.uint64)
        self._sizes = np.zeros(slots, np.uint8)                      # 0: free
        self._entry = np.zeros(slots, np.int32)
        self._ids, self._starts, self._known = np.zeros(1 << 16, np.uint32), np.zeros(1 << 14, np.int64), 0

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, one after another; where each text's ids begin, with the end). Texts are stretches of UTF-8 bytes."""
        spans = self._mark_spans(data)
        edges = np.union1d(offsets, spans.ravel())
        out, begins, total = [], np.zeros(len(offsets), np.int64), 0
        start, n, size = 0, len(data), self._stretch
        while start < n:
            end = min(start + size, n)
            look = min(end + 4, n)                                   # a cut depends on the bytes beside it
            own = edges[np.searchsorted(edges, start):np.searchsorted(edges, look, "right")] - start
            at = piece_starts(data[start:look], own)
            for a, b in spans[(spans[:, 0] < look) & (spans[:, 1] > start)] - start:
                at = at[(at <= a) | (at >= b)]
            at = at if len(at) and at[0] == 0 else np.r_[0, at]
            if end < n:
                at = at[at <= end - start]
                if len(at) < 2:                                      # one piece fills the stretch
                    size *= 2
                    continue
            stop = int(at[-1]) if end < n else n - start
            firsts = at[at < stop]
            ids, counts = self._pieces(data[start:start + stop], firsts, np.r_[firsts[1:], stop])
            ends = np.r_[0, np.cumsum(counts)]
            low, high = np.searchsorted(offsets, [start, start + stop])
            begins[low:high] = total + ends[np.searchsorted(firsts, offsets[low:high] - start)]
            out.append(ids)
            total += len(ids)
            start, size = start + stop, self._stretch
        begins[np.searchsorted(offsets, n):] = total
        return (np.concatenate(out) if out else np.zeros(0, np.uint32)), begins

    def _mark_spans(self, data: np.ndarray) -> np.ndarray:
        whole, found = None, []
        for mark in self._marks:
            whole = data.tobytes() if whole is None else whole
            at = whole.find(mark)
            while at >= 0:
                found.append((at, at + len(mark)))
                at = whole.find(mark, at + len(mark))
        return np.array(sorted(found), np.int64).reshape(-1, 2)

    def _pieces(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        padded = np.zeros(len(data) + _WIDE + 8, np.uint8)
        padded[:len(data)] = data
        eight = np.lib.stride_tricks.as_strided(padded[:0].view("<u8"), (len(padded) - 7,), (1,))
        sizes = ends - starts
        short = np.flatnonzero(sizes <= _WIDE)
        size = sizes[short]
        keys = [eight[starts[short] + 8 * k] & _MASK[np.clip(size - 8 * k, 0, 8)] for k in range(3)]
        size = size.astype(np.uint8)
        entry = np.full(len(starts), -1, np.int64)
        entry[short], new = self._found(keys, size)
        if len(new):
            self._add_joined(data, starts[short[new]], ends[short[new]])
        long, extra, at_known = np.flatnonzero(sizes > _WIDE), {}, self._known
        if len(long):
            texts = [bytes(data[a:b]) for a, b in zip(starts[long].tolist(), ends[long].tolist(), strict=True)]
            extra = dict.fromkeys(texts)
            number = {t: at_known + i for i, t in enumerate(extra)}
            self._add([t.decode() for t in extra])
            entry[long] = np.fromiter(map(number.__getitem__, texts), np.int64, len(texts))
        first, counts = self._starts[entry], self._starts[entry + 1] - self._starts[entry]
        ids = self._ids[np.repeat(first, counts) + spread(counts)]
        self._known = at_known                                       # long pieces are not kept
        return ids, counts

    def _found(self, keys: list[np.ndarray], size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(each piece's entry; which pieces are the first of their kind here). New ones get the next entries."""
        while True:
            a, b, c = keys
            h = a * np.uint64(0x9E3779B97F4A7C15) + b * np.uint64(0xC2B2AE3D27D4EB4F) + c * np.uint64(0x165667B19E3779F9) + size
            home = (mixed(h) >> np.uint64(64 - self._bits)).astype(np.int64)
            entry, new, count = np.full(len(size), -1, np.int64), [], self._known
            open_, slot, last = np.arange(len(size)), home, len(self._sizes) - 1
            while len(open_):
                there = self._sizes[slot]
                same = there == size[open_]
                for own, key in zip(self._keys, keys, strict=True):
                    same &= own[slot] == key[open_]
                entry[open_[same]] = self._entry[slot[same]]
                free = np.flatnonzero(there == 0)
                if len(free):                                        # of several for a free slot one gets it, the others look again
                    if count + len(free) > max(self._keep, len(size)):
                        break
                    self._entry[slot[free]] = free
                    put = free[self._entry[slot[free]] == free]
                    at, who = slot[put], open_[put]
                    for own, key in zip(self._keys, keys, strict=True):
                        own[at] = key[who]
                    self._sizes[at] = size[who]
                    self._entry[at] = entry[who] = count + np.arange(len(put))
                    new.append(who)
                    count += len(put)
                    open_rest = entry[open_] < 0
                    moved = open_rest & (there > 0)
                else:
                    open_rest = moved = ~same
                slot = np.where(moved, (slot + 1) & last, slot)[open_rest]
                open_ = open_[open_rest]
            if not len(open_):
                return entry, np.concatenate(new) if new else np.zeros(0, np.int64)
            self._forget(len(size))

    def _add_joined(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        """Entries for new pieces after those known. Pieces that begin with a character of a certain kind, or a blank before one, and end
        with one are encoded as one text: a line end parts those that don't begin with a blank, and is a token of its own."""
        kind = _KIND[data]
        head, second, tail = kind[starts], kind[np.minimum(starts + 1, ends - 1)], kind[ends - 1]
        certain = lambda k: (k > 0) & (k < _SPACE)
        joined = certain(tail) & (certain(head) | ((head == _SPACE) & certain(second)))
        for mark in self._marks:
            joined &= ends - starts != len(mark)
        counts, parts = np.zeros(len(starts), np.int64), {}
        own = np.flatnonzero(joined)
        if len(own):
            line = (head[own] != _SPACE).astype(np.int64)
            sizes = ends[own] - starts[own] + line
            begins = np.cumsum(sizes) - sizes
            text = np.full(int(sizes.sum()), 0x0A, np.uint8)
            inner = sizes - line
            text[np.repeat(begins + line, inner) + spread(inner)] = data[np.repeat(starts[own], inner) + spread(inner)]
            ids = np.array(self._tokenizer.encode_batch_fast([text.tobytes().decode()], add_special_tokens=False)[0].ids, np.uint32)
            upto = np.cumsum(self._bytes[ids])
            first = np.searchsorted(upto, begins + line, "right")       # the token that begins there
            after = np.searchsorted(upto, begins + sizes, "right")
            if not len(upto) or upto[-1] != len(text):
                raise ValueError("the tokenizer's tokens are not the text's bytes")
            counts[own] = after - first
        rest = np.flatnonzero(~joined)
        if len(rest):
            got = self._tokenizer.encode_batch_fast([bytes(data[a:b]).decode() for a, b in zip(starts[rest].tolist(), ends[rest].tolist(), strict=True)], add_special_tokens=False)
            for i, e in zip(rest.tolist(), got, strict=True):
                parts[i] = e.ids
                counts[i] = len(e.ids)
        ends_ = np.cumsum(counts)
        flat = np.zeros(int(ends_[-1]), np.uint32)
        if len(own):
            flat[np.repeat(ends_[own] - counts[own], counts[own]) + spread(counts[own])] = ids[np.repeat(first, counts[own]) + spread(counts[own])]
        for i, x in parts.items():
            flat[ends_[i] - counts[i]:ends_[i]] = x
        self._append(flat, counts)

    def _append(self, flat: np.ndarray, counts: np.ndarray) -> None:
        low, n = int(self._starts[self._known]), len(counts)
        self._starts, self._ids = _room(self._starts, self._known + n + 1), _room(self._ids, low + len(flat))
        self._starts[self._known + 1:self._known + 1 + n] = low + np.cumsum(counts)
        self._ids[low:low + len(flat)] = flat
        self._known += n

    def _add(self, texts: list[str]) -> None:
        """Entries for texts after those known."""
        got = [e.ids for e in self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        counts = np.fromiter(map(len, got), np.int64, len(got))
        self._append(np.fromiter((x for ids in got for x in ids), np.uint32, int(counts.sum())), counts)


def _room(array: np.ndarray, n: int) -> np.ndarray:
    """The array, or one of twice its length or more with its values."""
    if n <= len(array):
        return array
    out = np.zeros(max(n, 2 * len(array)), array.dtype)
    out[:len(array)] = array
    return out


_encoders: dict[tuple[str, int, int], TokenIds] = {}


def encoder(path: str, keep: int = KEEP, stretch: int = STRETCH) -> TokenIds:
    """One encoder per worker process."""
    if (path, keep, stretch) not in _encoders:
        _encoders[path, keep, stretch] = TokenIds(path, keep, stretch)
    return _encoders[path, keep, stretch]


def drop_encoders() -> None:
    """Free this worker's encoders and what they remember: a worker lives on for other stages."""
    _encoders.clear()


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)
