"""Token ids through the tokenizers library.

Both vocabularies used here treat what starts at a lone space alike in any
context, so a text is cut at its spaces and each piece is encoded once and
looked up afterwards. A piece of plain Latin letters and common punctuation
goes straight to the library's BPE model (there the pre-tokenizer has nothing
to decide); any other piece is encoded by the whole tokenizer, and so is any
text with white space around a cut that the pre-tokenizer could merge. The
cache is emptied when it holds ``CACHE_PIECES`` pieces and takes short pieces
only, which bounds a worker's memory. Where memory is scarcer than time it takes
a piece when it is met again (most pieces are met once and never asked for) and
holds ``AGAIN_PIECES`` at most.
"""

from __future__ import annotations

import os
import re
from array import array

import public_tokenizers
from tokenizers import Tokenizer

from .common import WARM, release_memory

CACHE_PIECES = 1_400_000
AGAIN_PIECES = 600_000
CACHE_PIECE_CHARS = 48
SEEN = 1 << 24  # marks for pieces met once, a bit each
ID_BYTES = 4  # ids are little-endian unsigned 32-bit
_SUSPECT = re.compile(r" (?:\s|\Z)")  # a quick test that most texts fail
_UNSAFE = re.compile(r"\s \s|\s \Z")
_WORD = r"([A-Za-zÀ-ÖØ-öø-ÿ]{1,32})([.,;:!?]{0,4})"
_PLAIN = re.compile(rf"{_WORD}(?:\n{_WORD})?")


def _byte_characters() -> dict[int, str]:
    """The characters by which byte-level vocabularies write each byte: printable
    ones stand for themselves, the others follow from U+0100 on."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return {b: chr(b if b in own else next(rest)) for b in range(256)}


class Encoder(dict):
    """Ids of texts as little-endian unsigned 32-bit bytes; as a dict, the cache
    from the pieces after a space to their ids."""

    #: One per vocabulary and worker process, so that later tasks find it warm.
    _open: dict[str, Encoder] = {}

    def __init__(self, name: str, again: bool = False):
        super().__init__({None: b""})
        self.met = bytearray(SEEN // 8) if again else None
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
        self.model = self.tokenizer.model
        self.characters = _byte_characters()
        lowered = self.tokenizer.normalizer is not None  # this vocabulary drops white space, too
        self.space = "" if lowered else " "
        self.plain = str.lower if lowered else str
        self.marks: dict[str, bytes] = {}  # short runs of six characters: a few thousand at most
        self.line_break = self.whole("\n")

    @classmethod
    def of(cls, name: str, again: bool = False) -> Encoder:
        """This worker's encoder; ``again``: its cache takes pieces that are met again."""
        if name not in cls._open or (cls._open[name].met is not None) != again:
            release_memory()
            cls._open[name] = cls(name, again)
        return cls._open[name]

    def _met(self, piece: str) -> bool:
        """Whether a piece was met before (or another one that shares its mark)."""
        at = hash(piece) % SEEN
        byte, mark = self.met[at >> 3], 1 << (at & 7)
        self.met[at >> 3] = byte | mark
        return bool(byte & mark)

    def whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _word(self, text: str) -> bytes:
        """One pre-token, by the library's model."""
        written = text.encode().decode("latin-1").translate(self.characters)
        return array("I", [t.id for t in self.model.tokenize(written)]).tobytes()

    def _plain(self, word: str, marks: str, spaced: bool) -> bytes:
        """A word of plain letters and the marks after it, with or without a space before."""
        ids = self._word((self.space if spaced else "") + self.plain(word))
        if marks:
            if marks not in self.marks:
                self.marks[marks] = self._word(marks)
            ids += self.marks[marks]
        return ids

    def __missing__(self, piece: str) -> bytes:
        match = _PLAIN.fullmatch(piece)
        if match:
            word, marks, line, marks_there = match.groups()
            if line is None:
                ids = self._plain(word, marks, True)
            else:  # two words around one line break: cached on their own, as the pair is rare
                return self[word + marks] + self.line_break + self._plain(line, marks_there, False)
        else:
            ids = self.whole(self.space + piece)
        if len(piece) <= CACHE_PIECE_CHARS and (self.met is None or self._met(piece)):
            self[piece] = ids
        return ids

    def encode(self, text: str) -> bytes:
        if _SUSPECT.search(text) and _UNSAFE.search(text):
            return self.whole(text)
        if len(self) > (CACHE_PIECES if self.met is None else AGAIN_PIECES):
            self.clear()
            self[None] = b""
            if self.met is not None:
                self.met = bytearray(SEEN // 8)
        pieces = text.split(" ")
        match = _PLAIN.fullmatch(pieces[0])  # the first piece has no space before it
        head = self._plain(*match.groups()[:2], False) if match and match[3] is None else self.whole(pieces[0])
        pieces[0] = None  # its ids come from above
        return head + b"".join(map(self.__getitem__, pieces))


WARM.append(Encoder._open)
