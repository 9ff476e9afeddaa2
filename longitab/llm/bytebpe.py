"""Byte-level BPE ids of whole texts, each distinct word encoded once."""

from __future__ import annotations

import os
import unicodedata
from itertools import chain

import numpy as np
import pyarrow as pa

#: Characters below are letters, numbers, white space or marks in every version of Unicode alike.
STABLE_END = 0x250
#: Bytes of words kept per encoder; a fuller table is emptied and filled anew.
CACHED_BYTES = 6 << 20
#: Words given to the tokenizer at a time.
LINE = 2000
#: Fixed value: white space below ``STABLE_END``.
SPACES = "\t\n\x0b\x0c\r \x85\xa0"


#: What follows an apostrophe in a word of its own.
AFTER = ("s", "t", "m", "d", "re", "ve", "ll")
LETTER, NUMBER, MARK, WHITE, SPACE = range(5)


def _classes() -> np.ndarray:
    kinds = {"L": LETTER, "N": NUMBER}
    out = np.array([kinds.get(unicodedata.category(chr(c))[0], MARK) for c in range(STABLE_END)], np.int8)
    out[[ord(c) for c in SPACES]] = WHITE
    out[ord(" ")] = SPACE
    return out


CLASSES = _classes()


def word_starts(chars: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Where the vocabulary starts a word: runs of letters, of numbers and of marks, with one space in front,
    contractions, and what other white space there is.

    ``chars`` are the code points of texts one after another, ``first`` the places where one starts.
    """
    n = len(chars)
    kind = np.append(CLASSES[chars], WHITE)
    begins = np.zeros(n + 1, bool)
    begins[first] = begins[n] = True
    white = kind >= WHITE
    same = np.append(True, kind[1:] == kind[:-1])
    before_white, before_space = np.append(True, white[:-1]), np.append(False, kind[:-1] == SPACE)
    # of a run of white space before a word the last goes with the word or alone
    turns = np.append(~white[1:] & ~begins[1:], False)
    start = begins | np.where(white, ~before_white | turns, np.where(before_white, ~before_space, ~same))
    at = np.flatnonzero(start[:n] & (chars == ord("'")))
    for tail in AFTER:
        k = len(tail)
        some = at[at + k < n]
        for j, c in enumerate(tail, 1):
            some = some[(chars[some + j] == ord(c)) & ~begins[some + j]]
        start[some + 1] = False
        start[some + k + 1] = True
    return start[:n]


class Encoder:
    """Token ids as the vocabulary's own tokenizer gives them.

    Byte-level BPE never joins across its words, so a text's ids are those of
    its words one after another.  Texts with characters whose class depends on
    the version of Unicode, or with a special string, go through the tokenizer
    whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.whole = Tokenizer.from_file(path)
        self.special = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        #: bytes of each id's token, which the vocabulary writes as one character a byte
        self.lengths = np.zeros(self.whole.get_vocab_size(), np.int64)
        for token, i in self.whole.get_vocab().items():
            self.lengths[i] = len(token)
        self._clear()

    def _clear(self) -> None:
        self.known: dict[str, int] = {}
        self.bytes, self.flat, self.at = 0, np.empty(0, np.uint32), np.zeros(1, np.int64)

    def _learn(self, words: list[str]) -> None:
        # a space starts a word of letters, so many such words can be one text
        spaced = [w for w in words if w[0] == " " and w[1:].isalpha()]
        lines = ["".join(spaced[k:k + LINE]) for k in range(0, len(spaced), LINE)]
        ids = np.fromiter(chain.from_iterable(e.ids for e in self.whole.encode_batch_fast(lines, add_special_tokens=False)), np.uint32)
        ends = np.cumsum(np.fromiter((len(w.encode()) for w in spaced), np.int64, len(spaced)))
        self._add(spaced, ids, np.searchsorted(np.cumsum(self.lengths[ids]), ends) + 1)
        rest = [w for w in words if not (w[0] == " " and w[1:].isalpha())]
        got = [e.ids for e in self.whole.encode_batch_fast(rest, add_special_tokens=False)]
        self._add(rest, np.fromiter(chain.from_iterable(got), np.uint32), np.cumsum(np.fromiter(map(len, got), np.int64, len(got))))

    def _add(self, words: list[str], ids: np.ndarray, ends: np.ndarray) -> None:
        self.known.update(zip(words, range(len(self.known), len(self.known) + len(words))))
        self.bytes += sum(map(len, words))
        self.at = np.append(self.at, self.at[-1] + ends)
        self.flat = np.concatenate([self.flat, ids])

    def _simple(self, text: str) -> bool:
        return (text.isascii() or ord(max(text)) < STABLE_END) and not any(s in text for s in self.special)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """``(ids of all texts one after another, number of ids of each text)``."""
        apart = {k: np.array(self.whole.encode(text, add_special_tokens=False).ids, np.uint32)
                 for k, text in enumerate(texts) if not self._simple(text)}
        joined = "".join([t for k, t in enumerate(texts) if k not in apart] if apart else texts)
        chars = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        n_chars = np.array([0 if k in apart else len(t) for k, t in enumerate(texts)], np.int64)
        ends = np.cumsum(n_chars)
        at = np.flatnonzero(word_starts(chars, (ends - n_chars)[n_chars > 0]))
        # of code points below STABLE_END those beyond ASCII have two bytes
        bytes_at = np.append(at + np.append(0, np.cumsum(chars >= 128))[at], len(chars) + np.count_nonzero(chars >= 128))
        words = pa.Array.from_buffers(
            pa.string(), len(at), [None, pa.py_buffer(bytes_at.astype(np.int32)), pa.py_buffer(joined.encode())])
        counts = np.diff(np.searchsorted(at, np.append(0, ends)))
        coded = words.dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        if self.bytes > CACHED_BYTES:
            self._clear()
        if new := [w for w in distinct if w not in self.known]:
            self._learn(new)
        entry = np.fromiter(map(self.known.__getitem__, distinct), np.int64, len(distinct))[coded.indices.to_numpy()]
        sizes = self.at[entry + 1] - self.at[entry]
        ends = np.cumsum(sizes)
        flat = self.flat[np.repeat(self.at[entry] - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)]
        cuts = np.append(0, ends)[np.append(0, np.cumsum(counts, dtype=np.int64))]
        n = np.diff(cuts)
        if apart:
            parts = [apart.get(k, flat[i:j]) for k, (i, j) in enumerate(zip(cuts, cuts[1:]))]
            return np.concatenate(parts), np.fromiter(map(len, parts), np.int64, len(parts))
        return flat, n
