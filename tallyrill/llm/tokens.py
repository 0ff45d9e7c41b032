"""Whole texts to token ids with the tokenizers library, remembering the pieces of text met before.

Byte-level BPE never merges across a single space or line break that has visible characters on
both sides, so such a text may be encoded piece by piece and the ids joined. Encoder does that,
with a bounded memory of pieces, where the tokenizer file is one of the two kinds it knows and the
text has no other white space at its cuts; anything else goes to the library whole. The ids are
those of ``Tokenizer.encode(text, add_special_tokens=False)`` in every case.
"""

from __future__ import annotations

import gc
import json
import os
import re
import threading
from array import array
from collections.abc import Iterator
from contextlib import contextmanager

#: Pieces in one of the two halves of an encoder's memory; the older half goes when the newer is full.
PIECES = 700_000

#: Seconds after which a worker without texts to encode forgets its pieces.
IDLE = 2.0

#: A space or line break is a cut only between two of these: ASCII that shows, and Latin letters.
_IRREGULAR = re.compile(r"[ \n](?![!-~À-ɏ])|(?<![!-~À-ɏ])[ \n]")
#: Letters that either kind of tokenizer takes as one run and lower-cases one by one.
_LETTERS = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿ]+\Z")


#: How the kind of file that takes lower-case words tells white space and words.
_WHITE = {"Regex": r"\s+"}
_WORDS = {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}
_DOUBLES = ("  ", " \n", "\n ", "\n\n")


def _regular(text: str) -> bool:
    """True if every space and line break of a text is a cut."""
    if text.isascii() and text.replace("\n", "").isprintable():
        return text[0] not in " \n" and text[-1] not in " \n" and not any(d in text for d in _DOUBLES)
    return not _IRREGULAR.search(text)


def _byte_letters() -> dict[int, str]:
    """Byte-level BPE's letter for each byte: visible Latin-1 stands for itself, the rest moves up."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


class _Pieces(dict):
    """Piece of text to the bytes of its ids; a missing one is looked up in the older half or made."""

    def __init__(self, make, most: int | None):
        super().__init__()
        self.make, self.most, self.old = make, most, {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.old.get(piece)
        if ids is None:
            ids = self.make(piece)
        if len(self) >= (self.most or PIECES):
            self.old = dict(self)
            self.clear()
        self[piece] = ids
        return ids


class Encoder:
    """Texts to little-endian unsigned 32-bit ids."""

    def __init__(self, path: str, pieces: int | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.vocabulary = self.tokenizer.get_vocab_size()
        self.lower = self.line = None
        with open(path, encoding="utf-8") as f:
            self._recognise(json.load(f))
        self.letters = _byte_letters()
        self.after_space = _Pieces(lambda p: self._piece(" ", p), pieces)
        self.first = self.after_space if self.lower else _Pieces(lambda p: self._piece("", p), pieces)

    def _recognise(self, spec: dict) -> None:
        norm, pre = spec.get("normalizer"), spec.get("pre_tokenizer") or {}
        model = spec["model"]
        plain = model.get("type") == "BPE" and not (spec.get("truncation") or spec.get("padding")) and not any(
            model.get(o) for o in ("dropout", "unk_token", "byte_fallback", "ignore_merges", "continuing_subword_prefix")) and not any(
            a["lstrip"] or a["rstrip"] or " " in a["content"] or "\n" in a["content"]
            for a in spec.get("added_tokens", []))
        rules = (norm or {}).get("normalizers", [])
        kinds = [n["type"] for n in rules]
        steps = pre.get("pretokenizers", [])
        words = model.get("end_of_word_suffix")
        if plain and not words and norm is None and pre.get("type") == "ByteLevel" and pre["use_regex"] and not pre["add_prefix_space"]:
            self.line, self.lower = self._whole("\n"), False
        elif (plain and kinds == ["NFC", "Replace", "Lowercase"] and len(steps) == 2
              and rules[1]["pattern"] == _WHITE and rules[1]["content"] == " " and steps[0]["pattern"] == _WORDS
              and steps[0]["type"] == "Split" and steps[0]["behavior"] == "Removed" and steps[0]["invert"]
              and steps[1]["type"] == "ByteLevel" and not steps[1]["use_regex"]):
            self.line, self.lower = b"", True

    def _whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _piece(self, space: str, piece: str) -> bytes:
        if piece[-1:] in ".," and len(piece) > 1 and _LETTERS.match(piece, 0, len(piece) - 1):
            pieces = self.after_space if space else self.first
            return pieces[piece[:-1]] + self.first[piece[-1]]
        if not _LETTERS.match(piece):
            return self._whole(space + piece)
        text = piece.lower() if self.lower else space + piece
        text = text.encode().decode("latin-1").translate(self.letters)
        return array("I", [t.id for t in self.model.tokenize(text)]).tobytes()

    def encode(self, text: str | None) -> bytes:
        """The ids' bytes; a missing text has none."""
        if not text:
            return b""
        if self.lower is None or not _regular(text):
            return self._whole(text)
        if self.lower and text.isascii():
            text = text.lower()
        known, out = self.after_space.__getitem__, []
        for line in text.split("\n"):
            words = line.split(" ")
            ids = self.first[words[0]]
            out.append(ids + b"".join(map(known, words[1:])) if len(words) > 1 else ids)
        return self.line.join(out)


_ENCODERS: dict[tuple, Encoder] = {}
_idle: threading.Timer | None = None


def _forget() -> None:
    _ENCODERS.clear()
    gc.collect()  # an encoder and its pieces refer to one another


@contextmanager
def encoder(path: str, pieces: int | None = None) -> Iterator[Encoder]:
    """This Python worker's encoder for a tokenizer file.

    Workers live on for tasks of any kind, so what the encoder remembers goes IDLE seconds after
    its last task.
    """
    global _idle
    if _idle is not None:
        _idle.cancel()
    key = path, pieces
    own = _ENCODERS.get(key) or Encoder(path, pieces)  # the timer may empty the memory at any moment
    _ENCODERS[key] = own
    try:
        yield own
    finally:
        del own
        _idle = threading.Timer(IDLE, _forget)
        _idle.daemon = True
        _idle.start()
