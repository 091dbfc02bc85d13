"""Token ids of whole texts by a public tokenizer file."""

from __future__ import annotations

import functools
import os
import re
from array import array

#: Encoded pieces a Python worker remembers before it starts afresh.
REMEMBERED = 500_000
#: Texts of these characters are cut by PIECES exactly as the tokenizer file's byte-level splitter cuts them. Any other
#: text is encoded whole.
_PLAIN = re.compile(r"[\t-\r -±´-¸º»¿-ɏ]*")
def _some(kind: str) -> str:
    """The characters of a kind, listed: a listed class is matched faster than a category."""
    return "".join(re.escape(c) for c in map(chr, range(0x250)) if _PLAIN.fullmatch(c) and re.fullmatch(kind, c))


_LETTERS, _DIGITS, _SIGNS, _GAPS = map(_some, (r"[^\W\d_]", r"\d", r"[^\s\w]|_", r"\s"))
#: Words first, as most pieces are; no other alternative begins like them.
PIECES = re.compile(f" ?[{_LETTERS}]+|'(?:s|t|re|ve|m|ll|d)| ?[{_DIGITS}]+| ?[{_SIGNS}]+|[{_GAPS}]+(?![^{_GAPS}])|[{_GAPS}]+")
#: Byte-level tokenizers write bytes as characters: printable Latin-1 as itself, the others from 256 on.
_ITSELF = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_WRITTEN = dict(zip((b for b in range(0x100) if b not in _ITSELF), range(0x100, 0x200)))


class Encoder(dict):
    """Ids as little-endian unsigned 32-bit bytes. Words recur, so each distinct piece is encoded once per worker."""

    def __init__(self, path: str) -> None:
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        cutter = self.tokenizer.pre_tokenizer.__getstate__().decode().replace(" ", "")
        self.split = '"use_regex":true' in cutter
        # Then a piece is the model's own input, and all that surrounds the model can be left out.
        special = all(t.special for t in self.tokenizer.get_added_tokens_decoder().values())
        self.bare = self.split and '"type":"ByteLevel"' in cutter and '"add_prefix_space":false' in cutter and special and self.tokenizer.normalizer is None
        self.model = self.tokenizer.model

    def whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def __missing__(self, piece: str) -> bytes:
        if self.bare:
            found = array("I", [t.id for t in self.model.tokenize(piece.encode().decode("latin-1").translate(_WRITTEN))]).tobytes()
        else:
            found = self.whole(piece)
        self[piece] = found
        return found

    def encode(self, text: str) -> bytes:
        if not self.split or not _PLAIN.fullmatch(text):
            return self.whole(text)
        if len(self) > REMEMBERED:
            self.clear()
        return b"".join(map(self.__getitem__, PIECES.findall(text)))


@functools.lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    return Encoder(path)
