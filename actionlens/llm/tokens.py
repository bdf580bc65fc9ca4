"""Token ids of whole texts with the `tokenizers` library.

``encode_batch`` spends ~20 microseconds on a word, and a corpus repeats its
words, so a batch is cut into pieces at single spaces and line feeds (and
before a final full stop or comma), each distinct piece is encoded by the
tokenizer's model once per worker, and ids are gathered with numpy.  The cut is
exact for the byte-level pre-tokenizer: a space between two non-space
characters always starts a pre-token, and a lone line feed is one.  The model
takes many new pre-tokens in one call, with a letter between them that no text
holds and no merge takes in; its id parts their ids again.  Texts where
white space touches white space that could merge with it (runs, leading or
trailing spaces) are encoded whole, and so are texts that hold the string of an
added token (``<|endoftext|>``), which the library finds before it splits.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
from tokenizers import Tokenizer
from tokenizers.models import BPE

from actionlens.llm.textops import segments, slices, span_hash

ENCODE_BYTES = 3 << 20
MEMO_PIECES = 600_000       # distinct pieces of a generation; a worker remembers two of them (about 30 bytes a piece)
CALL_BYTES = 1024           # text of one call of the tokenizer's model
_SPACED = np.uint64(0x5851F42D4C957F2D)
# Fixed value: the byte-level pre-tokenizer's pattern.
PRE_TOKENS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
_ALNUM = np.zeros(256, bool)
_ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123)]] = True

_LATIN = np.zeros(256, bool)            # second bytes of the Latin-1 letters, after 0xC3
_LATIN[[b for b in range(0x80, 0xC0) if b not in (0x97, 0xB7)]] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_NEVER = (0xC0, 0xC1, *range(0xF5, 0x100))      # bytes that UTF-8 text does not hold

_maybe_before = np.zeros(256, bool)     # bytes that can end / start a white-space character
_maybe_before[[0x20, *range(0x09, 0x0E), *range(0x1C, 0x20), *range(0x80, 0x8B), 0x9F, 0xA0, 0xA8, 0xA9, 0xAF]] = True
_maybe_after = np.zeros(256, bool)
_maybe_after[[0x20, *range(0x09, 0x0E), *range(0x1C, 0x20), 0xC2, 0xE1, 0xE2, 0xE3]] = True

_encoders: dict[tuple[str, bool], "PieceEncoder"] = {}


def encoder(path: str, encode_special_tokens: bool = True) -> "PieceEncoder":
    """The worker's encoder for a tokenizer file; ``encode_special_tokens`` as in the library: True takes the
    strings of special tokens in a text as ordinary text, False (the library's default) gives their ids."""
    key = (path, encode_special_tokens)
    if key not in _encoders:
        _encoders[key] = PieceEncoder(path, encode_special_tokens)
    return _encoders[key]


def _byte_letters() -> dict[int, int]:
    """The byte-level alphabet: printable bytes stand for themselves, the others for 256, 257, ... in order."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return {b: b if b in own else next(rest) for b in range(256)}


class Memo:
    """Pieces (sorted keys) and their ids."""

    def __init__(self) -> None:
        self.key, self._begin, self._size, self._ids = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, "<u4")

    def __len__(self) -> int:
        return len(self.key)

    def has(self, key: np.ndarray) -> np.ndarray:
        if not len(self):
            return np.zeros(len(key), bool)
        return self.key[np.minimum(np.searchsorted(self.key, key), len(self) - 1)] == key

    def ids(self, key: np.ndarray, which: np.ndarray | slice = slice(None)) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces ``key[which]``, all held, one after the other, and how many each has."""
        at = np.searchsorted(self.key, key)
        size = self._size[at][which].astype(np.int64)
        return _gather(self._ids, self._begin[at][which], size), size

    def add(self, key: np.ndarray, ids: np.ndarray, size: np.ndarray) -> None:
        """Pieces that are not held yet, in ascending order of their keys."""
        at = np.searchsorted(self.key, key)
        self._begin = np.insert(self._begin, at, len(self._ids) + np.cumsum(size) - size)
        self._size, self.key = np.insert(self._size, at, size), np.insert(self.key, at, key)
        self._ids = np.concatenate([self._ids, ids])


class PieceEncoder:
    def __init__(self, path: str, encode_special_tokens: bool = True) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = encode_special_tokens
        self.vocab_size = self.tokenizer.get_vocab_size()
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values() if t.content and not (t.special and encode_special_tokens)]
        self._added = regex.compile(b"|".join(regex.escape(t.encode()) for t in added)) if added else None
        self._model = self.tokenizer.model
        self._letters = np.array([letter for _, letter in sorted(_byte_letters().items())], "<u2")
        self._gap, self._gap_id = self._unmerged()
        self._memo = Memo()         # pieces met lately,
        self._older = Memo()        # and those of the generation before

    def _unmerged(self) -> tuple[int, int | None]:
        """A byte that no text holds and its id, if no token of several letters has its letter (so no merge makes one);
        without an id, the model takes one pre-token a call."""
        m, vocab = self._model, self.tokenizer.get_vocab()
        if isinstance(m, BPE) and not (m.dropout or m.ignore_merges or m.continuing_subword_prefix or m.end_of_word_suffix):
            merged = set("".join(token for token in vocab if len(token) > 1))
            for byte in _NEVER:
                letter = chr(self._letters[byte])
                if letter in vocab and letter not in merged:
                    return byte, vocab[letter]
        return _NEVER[0], None

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")

    def _pre_tokens(self, plain: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pre-tokens (bytes, each closed by the gap byte), one after the other, and how many each has."""
        close = np.flatnonzero(plain == self._gap)
        if self._gap_id is None:
            cut = np.arange(len(close))
        else:
            cut = np.flatnonzero(np.diff(close // CALL_BYTES, append=-1))       # the last one of every call
        begin, out = 0, []
        for end in (close[cut] + 1).tolist():
            part = plain[begin:end] if self._gap_id is not None else plain[begin:end - 1]
            out.append(np.array([t.id for t in self._model.tokenize(self._letters[part].tobytes().decode("utf-16-le"))], "<u4"))
            begin = end
        if self._gap_id is None:
            return np.concatenate(out), np.fromiter(map(len, out), np.int64, len(out))
        ids = np.concatenate(out)
        close = np.flatnonzero(ids == self._gap_id)
        return ids[ids != self._gap_id], np.diff(close, prepend=-1) - 1

    def _pieces(self, buf: np.ndarray, start: np.ndarray, end: np.ndarray, spaced: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces (with the space before a ``spaced`` one), one after the other, and how many each has."""
        other = ~_LETTER[buf]                   # bytes of anything but ASCII and Latin-1 letters
        second = np.r_[False, buf[:-1] == 0xC3] & _LATIN[buf]
        other &= ~second & ~np.r_[second[1:], False]
        others = np.r_[0, np.cumsum(other)]
        word = others[end] == others[start]     # a pre-token of its own
        first, spaced_word = start[word], spaced[word]
        size = end[word] - first + spaced_word + 1
        at = np.cumsum(size)
        plain = buf[np.minimum(np.repeat(first - spaced_word - at + size, size) + np.arange(int(size.sum())), len(buf) - 1)]
        plain[at - 1] = self._gap
        lists = []
        for a, b, space in zip(start[~word].tolist(), end[~word].tolist(), spaced[~word].tolist()):
            text = buf[a:b].tobytes().decode("utf-8", "replace")
            lists.append(PRE_TOKENS.findall(" " + text if space else text))
        gap = bytes([self._gap])
        rest = b"".join(t.encode() + gap for pre in lists for t in pre)
        ids, n = self._pre_tokens(np.concatenate([plain, np.frombuffer(rest, np.uint8)]))
        # Pre-tokens back to pieces: the words' come first, one each.
        pre = np.ones(len(start), np.int64)
        order = np.r_[np.flatnonzero(word), np.flatnonzero(~word)]
        pre[~word] = np.fromiter(map(len, lists), np.int64, len(lists))
        pre = pre[order]
        total = np.r_[0, np.cumsum(n)]
        last = np.cumsum(pre)
        begin = np.empty(len(start), np.int64)
        count = np.empty(len(start), np.int64)
        begin[order], count[order] = total[last - pre], total[last] - total[last - pre]
        return _gather(ids, begin, count), count

    def encode(self, text: pa.Array):
        """Yields (first row, end row, ids uint32 of these rows one after the other, ids per row)."""
        for a, b, buf, off in slices(text, ENCODE_BYTES):
            yield a, b, *self._encode_slice(buf, off)

    def _encode_slice(self, buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rows = len(off) - 1
        space, line = buf == 0x20, buf == 0x0A
        at = np.flatnonzero(space | line)
        row_of = np.searchsorted(off, at, "right") - 1
        edge = space[at] & ((at == off[row_of]) | (at == off[row_of + 1] - 1))
        before, after = (buf[np.maximum(at - 1, 0)], buf[np.minimum(at + 1, len(buf) - 1)]) if len(at) else (buf[:0], buf[:0])
        alone = (at > off[row_of]) & (before == 0x20)
        meets = (at > off[row_of]) & _maybe_before[before] | (at < off[row_of + 1] - 1) & _maybe_after[after] if len(at) else alone
        odd = np.zeros(rows, bool)
        odd[row_of[edge | alone | np.where(line[at], meets, _maybe_before[before] & _maybe_after[after])]] = True
        if self._added:
            found = [m.span() for m in self._added.finditer(buf, overlapped=True)]
            for first, end in found:                    # one that spans two texts is in neither
                r = int(np.searchsorted(off, first, "right")) - 1
                odd[r] |= end <= off[r + 1]

        start, end, row = segments(space | line, off)
        spaced = (start > off[row]) & (buf[start - 1] == 0x20)
        # A full stop or comma after an ASCII letter or digit, or a Latin-1 letter, is a pre-token of its own.
        last, prev, prev2 = buf[end - 1], buf[np.maximum(end - 2, 0)], buf[np.maximum(end - 3, 0)]
        mark = (end - start > 2) & ((last == 0x2E) | (last == 0x2C)) & (_ALNUM[prev] | (prev2 == 0xC3) & (prev >= 0x80) & (prev != 0x97) & (prev != 0xB7))
        at = at[line[at]]
        order = np.argsort(np.r_[start, end[mark] - 1, at], kind="stable")
        start, end, row, spaced = (np.concatenate(x)[order] for x in (
            (start, end[mark] - 1, at), (end - mark, end[mark], at + 1), (row, row[mark], np.searchsorted(off, at, "right") - 1),
            (spaced, np.zeros(int(mark.sum()) + len(at), bool))))
        if odd.any():
            keep = ~odd[row]
            start, end, row, spaced = start[keep], end[keep], row[keep], spaced[keep]
        key = span_hash(buf, start, end)
        key[spaced] ^= _SPACED
        distinct, where, which = np.unique(key, return_index=True, return_inverse=True)
        if len(self._memo) > MEMO_PIECES:
            self._older, self._memo = self._memo, Memo()
        self._remember(buf, distinct, start[where], end[where], spaced[where])
        out, count = self._memo.ids(distinct, which)
        per_row = np.bincount(row, count, rows).astype(np.int64) if len(row) else np.zeros(rows, np.int64)
        if odd.any():
            parts, at = [], np.r_[0, np.cumsum(per_row)]
            for r in range(rows):
                if odd[r]:
                    text = buf[off[r]:off[r + 1]].tobytes().decode("utf-8", "replace")
                    parts.append(self._whole(text))
                    per_row[r] = len(parts[-1])
                else:
                    parts.append(out[at[r]:at[r + 1]])
            out = np.concatenate(parts)
        return out, per_row

    def _remember(self, buf: np.ndarray, key: np.ndarray, start: np.ndarray, end: np.ndarray, spaced: np.ndarray) -> None:
        """Puts the pieces that are not in the memo there."""
        lacks = ~self._memo.has(key)
        known = key[lacks & self._older.has(key)]
        if len(known):
            self._memo.add(known, *self._older.ids(known))
            lacks &= ~self._memo.has(key)
        if lacks.any():
            self._memo.add(key[lacks], *self._pieces(buf, start[lacks], end[lacks], spaced[lacks]))


def _gather(flat: np.ndarray, begin: np.ndarray, count: np.ndarray) -> np.ndarray:
    """flat[begin[i] : begin[i] + count[i]] for all i, one after the other."""
    total = int(count.sum())
    done = np.cumsum(count) - count
    return flat[np.repeat(begin - done, count) + np.arange(total)]
