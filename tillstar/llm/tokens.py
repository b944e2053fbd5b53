"""Token ids of whole texts by the tokenizers library, asked once for each distinct piece between white space.

The vocabulary splits at white space before anything else and drops it, so a text's ids are those of its pieces, one
after another. Most pieces are letters with points after them; there the library's model is asked for the word alone.
"""

from __future__ import annotations

import json
import re
from array import array
from functools import cache

import numpy as np

from tillstar.llm.lexicon import byte_letters

END = np.uint32(1).tobytes()
#: Pieces, and words in them, that a worker remembers.
REMEMBERED = 250_000
#: Letters with plain lower cases and no marks, and pieces of them with points after them.
LETTERS = "".join(c for c in map(chr, range(0x250)) if c.isalpha() and c != "\u0130")
PIECE = re.compile(rf"([{LETTERS}]+)([.,;:!?]*)").fullmatch
#: How the vocabulary's file prepares texts: with these, lower-case letters are one word and reach the model as bytes.
NORMALIZER = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
PRE_TOKENIZER = [{"type": "Split", "pattern": {"Regex": SPLIT}, "behavior": "Removed", "invert": True},
                 {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]


class Words(dict):
    """The ids that the library's model gives for words of lower-case letters, and for points, asked when needed."""

    def __init__(self, tokenize) -> None:
        super().__init__()
        self.tokenize, self.letters = tokenize, {b: c for c, b in byte_letters().items()}

    def __missing__(self, word: str) -> bytes:
        if len(self) > REMEMBERED:
            self.clear()
        spelled = word if word.isascii() else word.encode().decode("latin-1").translate(self.letters)
        ids = self[word] = array("I", [x.id for x in self.tokenize(spelled)]).tobytes()
        return ids


class Pieces(dict):
    """The ids of pieces between white space. ``direct``: the model may be asked for words alone."""

    def __init__(self, library, direct: bool) -> None:
        super().__init__()
        self.library, self.direct, self.words = library, direct, Words(library.model.tokenize)

    def __missing__(self, piece: bytes) -> bytes:
        if len(self) > REMEMBERED:
            self.clear()
        text = piece.decode()
        found = PIECE(text) if self.direct else None
        if found:
            word, points = found.groups()
            ids = self.words[word.lower()]
            if points:
                ids += self.words[points]
        else:
            ids = array("I", self.library.encode(text, add_special_tokens=False).ids).tobytes()
        self[piece] = ids
        return ids


class WordEncoder:
    """``encode`` gives little-endian unsigned 32-bit ids. ``path`` names a file of the tokenizers library."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        library = Tokenizer.from_file(path)
        library.no_padding()
        library.no_truncation()
        with open(path, encoding="utf-8") as file:
            saved = json.load(file)
        special = [t["content"] for t in saved.get("added_tokens", [])]
        self.direct = ((saved.get("normalizer") or {}).get("normalizers") == NORMALIZER
                       and (saved.get("pre_tokenizer") or {}).get("pretokenizers") == PRE_TOKENIZER
                       and saved.get("post_processor") is None and not any(s.isalpha() for s in special))
        self.special = [s.lower().encode() for s in special]
        self.known = Pieces(library, self.direct)

    def _lower(self, text: bytes) -> bytes:
        """A-Z in lower case where the library does the same, which looks for special strings before that."""
        low = text.lower() if self.direct else text
        return text if any(s in low for s in self.special) else low

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text; null counts as empty."""
        get = self.known.__getitem__
        return [b"".join(map(get, self._lower(t.encode()).split())) if t else b"" for t in texts]


@cache
def word_encoder(path: str) -> WordEncoder:
    """One for each worker process, so that what it remembers serves all its tasks."""
    return WordEncoder(path)
