"""Memo of encoded chunks for the tokenizer files: each distinct chunk is merged once per worker.

The byte-pair libraries merge inside a pre-token only, and no pre-token of these files
spans white space (but for one leading blank of the byte-level kind).  So a text's ids are
those of its white-space chunks in order, and a chunk seen before costs one lookup.
Texts for which that is not proven go to the library whole: those with separators that
Python and the library class differently, with a possible special string, and, for the
byte-level kind, with characters from U+0250 on.  The result is always the library's own.
"""

from __future__ import annotations

import re
import unicodedata

EDGE = 0x250
_kind = {c: unicodedata.category(chr(c))[0] for c in range(EDGE)}
_SPACE = "\t\n\x0b\x0c\r \x85\xa0"
_LETTER = "".join(re.escape(chr(c)) for c, k in _kind.items() if k == "L")
_NUMBER = "".join(re.escape(chr(c)) for c, k in _kind.items() if k == "N")

#: Pre-tokens of the byte-level file (its own pattern, with classes written out below U+0250).
PRE_TOKEN = re.compile(
    f"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTER}]+| ?[{_NUMBER}]+| ?[^{_SPACE}{_LETTER}{_NUMBER}]+"
    f"|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")
#: Pre-tokens of the word file, which lower-cases first and drops white space.
_WORD = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_NUMBER}]|[^{_SPACE}{_LETTER}{_NUMBER}]+")
#: Chunks: words with one leading blank, runs of white space.
_CHUNK = re.compile(f" ?[^{_SPACE}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")
_HIGH = re.compile(f"[^\x00-{chr(EDGE - 1)}]")
_BYTES_WHOLE = re.compile(f"[^\x00-{chr(EDGE - 1)}]|<\\|")
_WORDS_WHOLE = re.compile("[\x1c-\x1f]|<\\|")


def byte_characters() -> dict[int, str]:
    """The character by which a byte-level vocabulary writes each byte: printable Latin-1
    bytes stand for themselves, the others are numbered from U+0100."""
    plain = {b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174}
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


_BYTE = byte_characters()


class Coder:
    """Chunks and ids for one tokenizer file, with a memo of chunks bounded by its bytes."""

    def __init__(self, path: str, words: bool, memo: int = 192 << 20):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.model = self.library.model
        self.words, self.limit = words, memo
        self.memo: dict = {}
        self.older: dict = {}           # the memo before, looked up when the present one has no entry
        self.used = 0                   # bytes of the memo, about

    def chunks(self, text: str) -> list[str] | None:
        """The chunks of a text, or None if the library has to take it whole."""
        if self.words:
            return None if _WORDS_WHOLE.search(text) else text.split()
        return None if _BYTES_WHOLE.search(text) else _CHUNK.findall(text)

    def merged(self, piece: str) -> list[int]:
        """Ids of one pre-token (normal form), by the library's merges."""
        return [t.id for t in self.model.tokenize(piece.encode().decode("latin-1").translate(_BYTE))]

    def whole(self, text: str) -> list[int]:
        return self.library.encode(text, add_special_tokens=False).ids

    def word_ids(self, chunk: str) -> list[int]:
        """Ids of a chunk of the word file."""
        low = chunk.lower()
        if low.isalpha() and low.isascii() and chunk.isascii():
            return [t.id for t in self.model.tokenize(low)]     # one pre-token, its bytes stand for themselves
        if _HIGH.search(low) or _HIGH.search(chunk):
            return self.whole(chunk)
        return [i for p in _WORD.findall(low) for i in self.merged(p)]

    def looked_up(self, chunks: list[str], entry) -> list:
        """Memo entries of ``chunks``; ``entry`` makes that of a new chunk."""
        got = list(map(self.memo.get, chunks))
        if None in got:
            memo = self.memo
            for i, g in enumerate(got):
                if g is None:
                    c = chunks[i]
                    g = memo.get(c)
                    if g is None:
                        g = self.older.get(c)
                        if g is None:
                            g = entry(c)
                        self.used += 200 + 16 * len(c)
                        if self.used > self.limit // 2:     # frequent chunks come back from the older half
                            self.older, self.memo = memo, {}
                            memo, self.used = self.memo, 200 + 16 * len(c)
                        memo[c] = g
                    got[i] = g
        return got


_coders: dict = {}


def coder(path: str, words: bool) -> Coder:
    """One coder per worker process and file."""
    if (path, words) not in _coders:
        _coders[(path, words)] = Coder(path, words)
    return _coders[(path, words)]
