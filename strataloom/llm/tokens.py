"""Exact tokenisation with a memo of white-space-delimited pieces.

A byte-level or word-level BPE never joins a character that is not white space
with white space that follows it, so a text may be cut before such white space
and the pieces encoded alone. Natural text repeats its pieces; each is encoded
once per worker and looked up afterwards. The memo is bounded.
"""

from __future__ import annotations

import re

import numpy as np

#: Pieces that one worker keeps; those met later are forgotten after their batch.
MEMO = 900_000
_KEEP = re.compile(r"[ \n]*[^ \n]+|[ \n]+")
_DROP = re.compile(r"[^ \n\t\r]+")
#: White space other than blank and newline, and characters on which libraries differ.
_ODD = re.compile(r"[^\S \n]|[\x1c-\x1f\x85\u180e]")
#: Of these, what ``str.split`` cuts at and a tokenizer may keep.
_KEPT = "\x1c\x1d\x1e\x1f\x85"
#: One such mark after one such letter at the end of a piece is a unit of its own for every pre-tokeniser here.
_TAIL, _LETTERS = frozenset(",.;:!?"), frozenset(c for c in map(chr, range(0x250)) if c.isalpha())


class PieceTokenizer:
    """ids of whole texts as little-endian arrays.

    ``drops_space``: the tokenizer itself ignores all white space (its
    pre-tokeniser removes it), so that pieces are plain words. Otherwise a piece
    carries the white space before it, and a text with white space besides
    blank and newline is encoded in one go. Strings of special tokens in a text give these
    tokens, as in the library's plain call, or are ordinary text with ``special_as_text``.
    """

    def __init__(self, path: str, drops_space: bool, special_as_text: bool = False):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = special_as_text
        self.dtype = np.dtype("<u2" if self.tok.get_vocab_size() <= 1 << 16 else "<u4")
        self.drops, self.memo = drops_space, {}
        self.tails = {c: self._raw(self.tok.encode(c, add_special_tokens=False).ids) for c in _TAIL}
        self.n_bytes = np.zeros(self.tok.get_vocab_size(), np.int64)
        for token, i in self.tok.get_vocab().items():
            self.n_bytes[i] = len(token.removesuffix("</w>"))

    def _raw(self, ids: list[int]) -> bytes:
        return np.array(ids, self.dtype).tobytes()

    def _learn(self, pieces: set[str]) -> dict[str, bytes]:
        """Encode pieces; those of a known or new word and a mark by their two parts."""
        tailed = {p for p in pieces if p[-1] in _TAIL and p[-2:-1] in _LETTERS}
        words = {p[:-1] for p in tailed}
        out = self._encode_pieces(list(words.difference(self.memo) | (pieces - tailed)))
        for p in tailed:
            word = self.memo.get(p[:-1]) or out.get(p[:-1])
            if word is not None:  # none: odd white space
                out[p] = word + self.tails[p[-1]]
        return out

    def _encode_pieces(self, pieces: list[str]) -> dict[str, bytes]:
        """Encode pieces, many at a time where joining them is harmless: those
        that begin with white space and end with something else, or words with
        a blank put between. Pieces with odd white space are left out."""
        if self.drops:
            joinable, alone = pieces, []
        else:
            pieces = [p for p in pieces if not _ODD.search(p)]
            joinable = [p for p in pieces if p[0] in " \n" and p[-1] not in " \n"]
            alone = [p for p in pieces if p[0] not in " \n" or p[-1] in " \n"]
        out = {p: self._raw(e.ids) for p, e in zip(alone, self.tok.encode_batch_fast(alone, add_special_tokens=False))}
        if self.drops:  # beyond Latin-1 pieces may change length as they are normalised
            plain = {p for p in joinable if len(p.encode("latin-1", "ignore")) == len(p)}
            parts, between = [(list(plain), self._by_bytes), ([p for p in joinable if p not in plain], self._by_offsets)], " "
        else:
            parts, between = [(joinable, self._by_bytes)], ""
        for some, cut in parts:
            for k in range(0, len(some), 512):
                group = some[k : k + 512]
                ids, cuts = cut(group, between.join(group))
                raw, at = ids.tobytes(), (cuts * self.dtype.itemsize).tolist()
                out.update((piece, raw[x:y]) for piece, x, y in zip(group, at, at[1:]))
        return out

    def _by_bytes(self, group: list[str], text: str) -> tuple[np.ndarray, np.ndarray]:
        """ids of joined pieces and their bounds: a token stands for as many bytes as its name has letters."""
        ids = np.array(self.tok.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.dtype)
        ends, upto = np.cumsum([len(x.encode()) for x in group]), np.cumsum(self.n_bytes[ids])
        cuts = np.searchsorted(upto, ends, "left")
        if self.drops and not (len(ids) > cuts[-1] and np.array_equal(upto[cuts], ends)):
            return self._by_offsets(group, text)
        return ids, np.concatenate([[0], cuts + 1])

    def _by_offsets(self, group: list[str], text: str) -> tuple[np.ndarray, np.ndarray]:
        """The same by the characters that the library says each token comes from."""
        enc = self.tok.encode(text, add_special_tokens=False)
        ends = np.cumsum([len(x) + 1 for x in group])
        at = np.searchsorted(ends, np.fromiter((a for a, _ in enc.offsets), np.int64, len(enc)), "right")
        return np.array(enc.ids, self.dtype), np.searchsorted(at, np.arange(len(group) + 1))

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        find = (_DROP if self.drops else _KEEP).findall
        cut = [t.split() if self.drops and not any(c in t for c in _KEPT) else find(t) for t in texts]
        memo, holes = self.memo, []
        got = [list(map(memo.get, pieces)) for pieces in cut]
        for pieces, found in zip(cut, got):
            at = []
            for _ in range(found.count(None)):
                at.append(found.index(None, at[-1] + 1 if at else 0))
            holes.append(at)
        new = {pieces[i] for pieces, at in zip(cut, holes) for i in at}
        learnt = self._learn(new) if new else {}
        memo.update(learnt)
        out = []
        for t, pieces, found, at in zip(texts, cut, got, holes):
            for i in at:
                found[i] = learnt.get(pieces[i])
            try:
                out.append(b"".join(found))
            except TypeError:  # odd white space: the text in one go
                out.append(self._raw(self.tok.encode(t, add_special_tokens=False).ids))
        if len(memo) > MEMO:
            for piece in learnt:
                del memo[piece]
        return out


_by_path: dict[tuple[str, bool], PieceTokenizer] = {}


def tokenizer(path: str, drops_space: bool) -> PieceTokenizer:
    """One tokenizer with its memo for all tasks of a worker process."""
    if (path, drops_space) not in _by_path:
        _by_path[path, drops_space] = PieceTokenizer(path, drops_space)
    return _by_path[path, drops_space]
