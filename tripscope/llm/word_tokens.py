"""Token ids of the word-end BPE vocabulary, remembered by piece.

The vocabulary splits a normalised text into pieces (letter runs, single
digits, runs of other signs; never white space) and encodes each for itself.
So the ids of a text are the ids of its pieces in a row, and a piece is encoded
once and then looked up as its packed ids: a document is one join of byte
strings.  That holds for text of Latin-1 characters, whose pieces are found
here; anything else goes through the library's ``encode`` as it is.
"""

from __future__ import annotations

import re
import struct

from tokenizers import Tokenizer, pre_tokenizers

# The split rule of the vocabulary's pre-tokenizer, in lower case,
# written out for ASCII and for Latin-1 letters and digits.
_LETTERS, _DIGITS = "a-zªµºß-öø-ÿ", "0-9²³¹¼-¾"
ASCII_PIECES = re.compile(r"[a-z]+|'(?:s|t|re|ve|m|ll|d)|[0-9]|[^\sa-z0-9]+", re.ASCII)
LATIN_PIECES = re.compile(rf"[{_LETTERS}]+|'(?:s|t|re|ve|m|ll|d)|[{_DIGITS}]|[^\s{_LETTERS}{_DIGITS}]+")
#: ``re`` takes these for white space, the vocabulary's rule does not.
_SEPARATORS = re.compile("[\x1c-\x1f]")
_BEYOND_LATIN = re.compile("[^\x00-\xff]")
_PRINTABLE = re.compile("[!-~]+")


class WordTokens(dict):
    """piece -> its ids as little-endian unsigned 32-bit integers.

    Holds at most ``2 * limit`` pieces: the younger ones are kept when the
    older half is let go."""

    def __init__(self, path: str, limit: int = 300_000):
        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.byte_level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.marks = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.limit = limit
        self.older: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.older.get(piece)
        if ids is None:
            shown = piece if _PRINTABLE.fullmatch(piece) else self.byte_level.pre_tokenize_str(piece)[0][0]
            ids = [t.id for t in self.model.tokenize(shown)]
            ids = struct.pack(f"<{len(ids)}I", *ids)
        if len(self) >= self.limit:
            self.older = dict(self)
            self.clear()
        self[piece] = ids
        return ids

    def _encoded(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def _chunks(self, text: str) -> bytes:
        """White space always ends a piece, so its chunks stand for themselves."""
        out = []
        for chunk in text.split():
            if _BEYOND_LATIN.search(chunk):
                out.append(self._encoded(chunk))
            else:
                out += map(self.__getitem__, LATIN_PIECES.findall(chunk.lower()))
        return b"".join(out)

    def packed(self, text: str) -> bytes:
        """The ids of ``text``, packed."""
        if _SEPARATORS.search(text) or any(m in text for m in self.marks):
            return self._encoded(text)
        if text.isascii():
            pieces = ASCII_PIECES.findall(text.lower())
        elif _BEYOND_LATIN.search(text):
            return self._chunks(text)
        else:
            pieces = LATIN_PIECES.findall(text.lower())
        return b"".join(map(self.__getitem__, pieces))


_OPEN: dict[str, WordTokens] = {}


def word_tokens(path: str) -> WordTokens:
    """One per worker process: what it remembers serves all its tasks."""
    if path not in _OPEN:
        _OPEN[path] = WordTokens(path)
    return _OPEN[path]
