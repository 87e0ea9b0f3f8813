"""Token ids of whole texts with a public word-level BPE vocabulary, word by word from a cache."""

from __future__ import annotations

import re
import unicodedata

import numpy as np

from pawprint.llm.common import SPACE, word_hashes

#: Distinct words (about 40 bytes each) and pre-tokens (200 bytes each) whose
#: ids a worker keeps; a full cache starts anew.
CACHE_WORDS = 1_000_000
PIECES = 200_000

#: How the vocabulary cuts a word into pre-tokens, and the
#: printable stand-ins of the bytes that are not printable themselves.
PRE_TOKENS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_HIDDEN = [b for b in range(256) if b not in set(_PRINTABLE)]
BYTE_NAMES = {b: 256 + i for i, b in enumerate(_HIDDEN)}

_PUNCTUATION = ".,!;:?"
#: Letters up to here are cut by this module; words with any later character
#: are left to the tokenizer itself.
_USUAL = re.compile(r"[\x21-ɏ‐-‧]+")


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


class WordEncoder:
    """Encodes texts exactly as ``Tokenizer.encode(..., add_special_tokens=False)`` does.

    The vocabulary lower-cases, drops white space and never joins across it,
    so a text's ids are the ids of its blank-separated words one after
    another. Each distinct word is cut into pre-tokens here, and new
    pre-tokens go through the tokenizer's merges many at a time: the last id
    of a pre-token, and no other, ends a word, which gives the cuts back.
    """

    def __init__(self, path: str, cap: int = CACHE_WORDS):
        import regex
        from tokenizers import Tokenizer, pre_tokenizers
        self.tok = Tokenizer.from_file(path)
        self.merges = Tokenizer.from_file(path)
        self.merges.normalizer = None
        self.merges.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(" ")
        size = self.tok.get_vocab_size(with_added_tokens=True)
        self.ends = np.zeros(size, bool)
        for piece, i in self.tok.get_vocab(with_added_tokens=True).items():
            self.ends[i] = piece.endswith("</w>")
        self.cut = regex.compile(PRE_TOKENS).findall
        self.cap = cap
        self._forget()
        self.pieces: dict[str, bytes] = {}

    def _merge(self, pieces: set[str]) -> None:
        """Put the ids of pre-tokens into ``self.pieces``."""
        todo = list(pieces.difference(self.pieces))
        for at in range(0, len(todo), 256):
            part = todo[at:at + 256]
            text = " ".join([p if p.isascii() and p.isprintable() else
                             p.encode().decode("latin-1").translate(BYTE_NAMES) for p in part])
            ids = np.array(self.merges.encode_batch_fast(
                [text], add_special_tokens=False)[0].ids, "<u4")
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) != len(part):
                raise ValueError("the vocabulary does not end words as expected")
            raw, start = ids.tobytes(), 0
            for p, end in zip(part, (cuts * 4).tolist()):
                self.pieces[p] = raw[start:end]
                start = end

    def _learn(self, words: list[str]) -> list[bytes]:
        cut: list = []
        fresh = set(_PUNCTUATION)
        for i, w in enumerate(words):
            if w.isascii() and w.isalpha():
                fresh.add(w.lower())
                cut.append(None)
            elif w.isascii() and w[-1] in _PUNCTUATION and w[:-1].isalpha():
                fresh.add(w[:-1].lower())
                cut.append(False)
            elif _USUAL.fullmatch(w) and "<|" not in w:
                cut.append(self.cut(unicodedata.normalize("NFC", w).lower()))
                fresh.update(cut[-1])
            else:
                cut.append(i)
        other = [w for w, c in zip(words, cut) if type(c) is int]
        other = iter(self.tok.encode_batch_fast(other, add_special_tokens=False) if other else ())
        if len(self.pieces) > PIECES:
            self.pieces = {}
            fresh.update(_PUNCTUATION)
        self._merge(fresh)
        ids, out = self.pieces, []
        for w, c in zip(words, cut):
            if c is None:
                out.append(ids[w.lower()])
            elif c is False:
                out.append(ids[w[:-1].lower()] + ids[w[-1]])
            elif type(c) is int:
                out.append(np.array(next(other).ids, "<u4").tobytes())
            else:
                out.append(b"".join([ids[p] for p in c]))
        return out

    def _look_up(self, keys: np.ndarray) -> np.ndarray:
        """Index of each key in the tables of known words, -1 where unknown."""
        out = np.full(len(keys), -1, np.int64)
        for known, at in self.levels:
            if len(known):
                place = np.minimum(np.searchsorted(known, keys), len(known) - 1)
                hit = known[place] == keys
                out[hit] = at[place[hit]]
        return out

    def _add(self, keys: np.ndarray, ids: list[bytes]) -> np.ndarray:
        """Remember new words (sorted keys); the index of each."""
        lens = np.array([len(b) // 4 for b in ids], np.int64)
        at = len(self.lens) + np.arange(len(keys))
        self.starts = np.concatenate([self.starts, len(self.pool) + np.cumsum(lens) - lens])
        self.lens = np.concatenate([self.lens, lens])
        self.pool = np.concatenate([self.pool, np.frombuffer(b"".join(ids), "<u4")])
        (old, old_at), (late, late_at) = self.levels
        late, late_at = np.concatenate([late, keys]), np.concatenate([late_at, at])
        if len(late) * 4 > len(old):
            late, late_at = np.concatenate([old, late]), np.concatenate([old_at, late_at])
            order = np.argsort(late)
            self.levels = [(late[order], late_at[order]), self.levels[1]]
            self.levels[1] = (late[:0], late_at[:0])
        else:
            order = np.argsort(late)
            self.levels[1] = (late[order], late_at[order])
        return at

    def _forget(self) -> None:
        none = np.zeros(0, np.int64)
        self.levels = [(none.astype(np.uint64), none), (none.astype(np.uint64), none)]
        self.starts, self.lens, self.pool = none, none, np.zeros(0, "<u4")

    def encode_rows(self, offs: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows one after another, and the n + 1 offsets of the rows.

        ``offs`` and ``data`` are a string column's offsets and UTF-8 bytes.
        Words are told apart by 64-bit hashes of their bytes, letters A-Z
        counting as a-z unless special tokens may be in the text.
        """
        n_rows = len(offs) - 1
        raw = data.tobytes()
        exact = b"<|" in raw
        keys, row, start, end = word_hashes(data, offs, ~SPACE, lower=not exact)
        if exact:
            keys = keys ^ np.uint64(0x5851F42D4C957F2D)
        if not len(keys):
            return np.zeros(0, "<u4"), np.zeros(n_rows + 1, np.int64)
        unique, first, inverse = np.unique(keys, return_index=True, return_inverse=True)
        at = self._look_up(unique)
        new = np.flatnonzero(at < 0)
        if len(new):
            if len(self.lens) + len(new) > self.cap:
                self._forget()
                new = np.arange(len(unique))
            lo, hi = start[first[new]].tolist(), end[first[new]].tolist()
            words = [raw[a:b].decode() for a, b in zip(lo, hi)]
            words = [w.lower() if w.isascii() and not exact else w for w in words]
            ids = self._learn(words)
            at[new] = self._add(unique[new], ids)
        word_at = at[inverse]
        lens = self.lens[word_at]
        total = np.cumsum(lens)
        shift = np.repeat(self.starts[word_at] - (total - lens), lens)
        ids = self.pool[np.arange(total[-1]) + shift]
        per_row = np.bincount(row, weights=lens, minlength=n_rows).astype(np.int64)
        return ids, np.concatenate([[0], np.cumsum(per_row)])

    def rest(self) -> None:
        """Drop what the next task can do without; words stay."""
        self.pieces = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        raw = [t.encode() for t in texts]
        offs = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
        ids, rows = self.encode_rows(offs, np.frombuffer(b"".join(raw), np.uint8))
        return [ids[a:b].tobytes() for a, b in zip(rows[:-1], rows[1:])]


def encoder(path: str) -> WordEncoder:
    """One encoder per worker process and vocabulary.

    Task code is pickled by value, so this module's own globals are new in
    every task; the ``tokenizers`` module is the same for all of a worker's.
    """
    import tokenizers
    kept = tokenizers.__dict__.setdefault("_word_encoders", {})
    if path not in kept:
        kept[path] = WordEncoder(path)
    return kept[path]
