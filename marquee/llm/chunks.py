"""Cached tokenisation of white-space separated pieces with the ``tokenizers`` library.

The pre-tokenisers used here never let a match cross from one piece to the
next when a text holds single blanks and single line feeds only, so each
distinct piece is encoded once per worker and the ids of a text are the joined
ids of its pieces.  A piece of Latin letters is one pre-token, which the
library's BPE model takes as it is; other pieces go through the whole library,
and so does any text with other white space.
"""

from __future__ import annotations

import os
from array import array

# Entries of a cache's newer half before it becomes the older half: bounds a worker's memory, never changes a result.
CACHE_ENTRIES = 600_000


def byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, the others for the code points from 256."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}


LETTERS = byte_letters()
BLANK = LETTERS[32]


def plain(text: str) -> bool:
    """Whether single blanks and line feeds between other characters are the only white space, and no end mark is in the text."""
    if not text:
        return False
    flat = text.replace("\n", " ")
    return flat.isprintable() and "  " not in flat and flat[:1] != " " and flat[-1:] != " " and "<|" not in flat


def spaced_pieces(text: str) -> list[str]:
    """The pieces of a plain text, each with the blank before it; a line feed is a piece of its own."""
    return text.replace("\n", "\0\n\0").replace(" ", "\0 ").split("\0")


class PieceEncoder(dict):
    """Encode texts as little-endian 32-bit ids; ``keep_space`` for byte-level vocabularies, where a
    word keeps the blank before it and a line feed is a token of its own.

    The dictionary itself is the newer half of the cache: a piece that is missing
    there is taken from the older half or encoded.  A full newer half becomes the
    older one, so pieces that turn up again and again are never encoded twice.
    """

    def __init__(self, path: str, keep_space: bool, entries: int) -> None:
        super().__init__()
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_file(path)
        self.tokenize = self.library.model.tokenize
        self.keep_space, self.entries = keep_space, entries
        self.older: dict[str, bytes] = {}

    def _whole(self, text: str) -> bytes:
        return array("I", self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids).tobytes()

    def _word(self, word: str, bare: str) -> bytes:
        """The ids of one pre-token of Latin letters ``bare``, with or without the blank before it."""
        if not self.keep_space:
            word = bare = bare.lower()
        if bare.isascii():
            word = bare if len(word) == len(bare) else BLANK + bare
        else:
            word = word.encode().decode("latin-1").translate(LETTERS)
        return array("I", [t.id for t in self.tokenize(word)]).tobytes()

    def _piece(self, piece: str) -> bytes:
        bare = piece[1:] if piece[:1] == " " else piece
        if bare.isalpha():
            if bare.isascii() or max(bare) < "ɐ" and "İ" not in bare:
                return self._word(piece, bare)
        elif piece[-1:] in (".", ","):
            core = piece.rstrip(".,")
            if core.lstrip(" ").isalpha():
                return self[core] + self[piece[len(core):]]
        return self._whole(piece)

    def __missing__(self, piece: str) -> bytes:
        ids = self.older.get(piece)
        if ids is None:
            ids = self._piece(piece)
        if len(self) >= self.entries:
            self.older = dict(self)
            self.clear()
        self[piece] = ids
        return ids

    def __call__(self, texts: list[str]) -> list[bytes]:
        """The ids of each text."""
        pieces = spaced_pieces if self.keep_space else str.split
        get = self.__getitem__
        return [b"".join(map(get, pieces(t))) if plain(t) else self._whole(t) for t in texts]


_LOADED: dict[str, PieceEncoder] = {}


def library_encoder(path: str, keep_space: bool, entries: int = CACHE_ENTRIES) -> PieceEncoder:
    """The encoder of a ``tokenizers`` JSON file, loaded once per worker."""
    if path not in _LOADED:
        _LOADED[path] = PieceEncoder(path, keep_space, entries)
    return _LOADED[path]
