"""Token ids from a public tokenizer file, chunk by chunk.

For a tokenizer that drops white space, a text's ids are those of its
blank-separated chunks in order, so each worker keeps the ids of the chunks it
has met.  A new chunk of plain Latin letters, digits and ASCII marks needs no
Unicode normalisation: its pieces go straight to the library's merge model.
Any other chunk goes through the whole library call.  Ids travel as
little-endian unsigned 32-bit bytes.
"""

from __future__ import annotations

import os
import re
from array import array

import numpy as np

#: Chunks in the younger of the two cache generations (the older holds as many), and the longest chunk kept.
CACHE_CHUNKS, CACHE_CHARS = 200_000, 40

#: Chunks made of characters that normalisation only lower-cases, one by one.
PLAIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")
#: The tokenizer's own split pattern, for such characters (fixed value).
PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")


def byte_letters() -> dict[int, str]:
    """Code point -> the printable letters that stand for its UTF-8 bytes in a byte-level vocabulary."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    letters = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return {cp: "".join(letters[b] for b in chr(cp).encode()) for cp in range(256)}


class Encoder:
    """``by_chunk`` needs a tokenizer that lower-cases, drops white space and splits as ``PIECES`` does."""

    def __init__(self, path: str, by_chunk: bool = True):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.by_chunk = by_chunk
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, special)) or "(?!)")
        self.letters = byte_letters()
        self.tokenize = self.tokenizer.model.tokenize
        self.young: dict[str, bytes] = {"": b""}
        self.old: dict[str, bytes] = {}

    def library(self, text: str) -> bytes:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def chunk(self, chunk: str) -> bytes:
        if chunk.isascii() and chunk.isalpha():
            return array("I", [t.id for t in self.tokenize(chunk.lower())]).tobytes()
        if not PLAIN.fullmatch(chunk) or self.special.search(chunk):
            return self.library(chunk)
        pieces = PIECES.findall(chunk.lower())
        return b"".join([self.young.get(p) or self.piece(p) for p in pieces])

    def piece(self, piece: str) -> bytes:
        """Ids of one piece, which are those of a chunk that consists of it."""
        ids = self.old.get(piece)
        if ids is None:
            shown = piece if piece.isascii() else piece.translate(self.letters)
            ids = array("I", [t.id for t in self.tokenize(shown)]).tobytes()
        if len(piece) <= CACHE_CHARS:
            self.young[piece] = ids
        return ids

    def encode(self, text: str) -> bytes:
        if not self.by_chunk:
            return self.library(text)
        young, old, out = self.young, self.old, []
        for c in text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" "):
            ids = young.get(c)
            if ids is None:
                ids = old.get(c)
                if ids is None:
                    ids = self.chunk(c)
                if len(c) <= CACHE_CHARS:
                    young[c] = ids
            out.append(ids)
        if len(young) > CACHE_CHUNKS:
            self.old, self.young = young, {"": b""}
        return b"".join(out)


_encoders: dict[tuple[str, bool], Encoder] = {}


def encoder(path: str, by_chunk: bool = True) -> Encoder:
    """The worker's encoder for this file, loaded once."""
    key = (path, by_chunk)
    if key not in _encoders:
        _encoders[key] = Encoder(path, by_chunk)
    return _encoders[key]
