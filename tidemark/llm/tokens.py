"""Token ids of whole texts with public tokenizer files, each distinct run of characters encoded once per worker.

Text is cut only where the tokenizer itself always cuts, so that joining the ids of the parts gives the ids of the
whole. A part is normalised, cut and encoded by the tokenizers library and kept; a full cache starts anew.
"""

from __future__ import annotations

import os
import struct
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import kept_by_worker

CACHE_PARTS = 400_000
#: Longer parts are encoded but not kept, so that the cache stays within bounds.
LONGEST_KEPT = 64
#: Characters of texts that are split together; a longer text is split alone, part by part.
TOGETHER = 1 << 20

#: White space other than the space and the line feed, for the tokenizers or for Python.
OTHER_SPACES = (
    "\t\v\f\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
DOUBLED = ("  ", " \n", "\n ", "\n\n")
MARKS = frozenset(".,;:!?#*$%&|")


def even_space(text: str) -> bool:
    """Is all white space one space or line feed between other characters? How other runs are cut depends on them."""
    return not (
        text[0] in " \n"
        or text[-1] in " \n"
        or any(x in text for x in DOUBLED)
        or any(x in text for x in OTHER_SPACES)
    )


def byte_letters() -> dict[int, str]:
    """The letter by which byte-level vocabularies write each byte: printable ones as they are, others from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


class Parts(dict):
    """Part of a text -> its ids as little-endian unsigned 32-bit bytes, made when first asked for.

    ``before`` stands before every part. Once full, the parts become the old ones; those asked for again come back.
    """

    def __init__(self, tokenizer, before: str) -> None:
        super().__init__()
        self.before, self.letters, self.old = before, byte_letters(), {}
        self.model, self.cut, self.normalizer = tokenizer.model, tokenizer.pre_tokenizer, tokenizer.normalizer
        self.start = before.translate(self.letters)
        self.marks: dict[str, bytes] = {}

    def ids(self, pieces: list[str]) -> bytes:
        ids = [t.id for piece in pieces for t in self.model.tokenize(piece)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def made(self, part: str) -> bytes:
        # One piece. Letters up to there are in NFC; only the dotted capital I becomes two characters.
        if part.isalpha() and (self.normalizer is None or max(part) < "\u0250" and "\u0130" not in part):
            text = part if self.normalizer is None else part.lower()
            if text.isascii():  # the vocabulary writes these letters as they are
                return self.ids([self.start + text])
            text = self.before + text
            return self.ids([text.encode().decode("latin-1").translate(self.letters)])
        if part[-1:] in MARKS and part[:-1].isalpha():  # a word and a mark are always two pieces
            mark = part[-1]
            if mark not in self.marks:
                self.marks[mark] = self.ids([mark])
            return self[part[:-1]] + self.marks[mark]
        text = self.before + part
        if self.normalizer is not None:
            text = self.normalizer.normalize_str(text)
        return self.ids([piece for piece, _ in self.cut.pre_tokenize_str(text)])

    def __missing__(self, part: str) -> bytes:
        out = self.old.pop(part, None)
        if out is None:
            out = self.made(part) if part or self.before else b""
        if len(part) <= LONGEST_KEPT:
            self[part] = out
        return out

    def turn(self) -> None:
        if len(self) > CACHE_PARTS:
            self.old = dict(self)
            self.clear()


class TextEncoder:
    """Ids as little-endian unsigned 32-bit bytes.

    ``spaced``: white space belongs to the ids (byte-level vocabularies). Then a text is cut before each single space
    and around each single line feed; a text with other white space goes to the library as a whole. Otherwise the
    tokenizer drops white space and a text is cut at spaces and line feeds.
    """

    def __init__(self, path: str, spaced: bool) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.spaced = spaced
        self.first, self.later = Parts(self.tokenizer, ""), Parts(self.tokenizer, " ")

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def one(self, text: str) -> bytes:
        if not self.spaced:
            return b"".join(map(self.first.__getitem__, text.replace("\n", " ").split(" ")))
        if not even_space(text):
            return self.whole(text)
        first, later, feed, out = self.first, self.later.__getitem__, self.first["\n"], []
        for line in text.split("\n"):
            words = line.split(" ")
            out += [feed, first[words[0]], *map(later, words[1:])]
        return b"".join(out[1:])

    def together(self, texts: list[str]) -> list[bytes]:
        """As ``one`` for ``spaced`` texts with even white space: each distinct part of them is looked up once."""
        lists = pc.split_pattern(pc.replace_substring(pa.array(texts, pa.large_string()), "\n", " \n "), " ")
        encoded, starts = pc.dictionary_encode(lists.values), lists.offsets.to_numpy()
        codes, spelled = encoded.indices.to_numpy(), encoded.dictionary.to_numpy(zero_copy_only=False)
        first = codes == encoded.dictionary.index("\n").as_py()  # line feeds, what follows one, and what begins a text
        first[1:] |= first[:-1].copy()
        first[starts[:-1]] = True
        parts, place = [], np.zeros((2, len(spelled)), np.int64)
        for kind, known, mine in ((0, self.later, ~first), (1, self.first, first)):
            used = np.flatnonzero(np.bincount(codes[mine], minlength=len(spelled)))
            place[kind, used] = np.arange(len(parts), len(parts) + len(used))
            parts += map(known.__getitem__, spelled[used])
        sizes = np.fromiter(map(len, parts), np.int64, len(parts)) // 4
        at = place[first.astype(np.int8), codes]
        ends = np.cumsum(sizes[at])
        source = np.repeat((np.cumsum(sizes) - sizes)[at] - ends + sizes[at], sizes[at]) + np.arange(ends[-1])
        ids = np.frombuffer(b"".join(parts), "<u4")[source]
        bounds = np.append(0, ends)[starts].tolist()
        return [ids[a:b].tobytes() for a, b in zip(bounds, bounds[1:])]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text; of null as of the empty text."""
        self.first.turn()
        self.later.turn()
        out: list[bytes | None] = [None] * len(texts)
        held: list[int] = []
        size = 0
        for i, text in enumerate(texts):
            if not (self.spaced and text and len(text) <= TOGETHER and even_space(text)):
                out[i] = self.one(text) if text else b""
                continue
            held.append(i)
            size += len(text)
            if size >= TOGETHER:
                out, held, size = self.filled(out, held, texts), [], 0
        return self.filled(out, held, texts)

    def filled(self, out: list, held: list[int], texts: list[str | None]) -> list:
        """``out`` with the ids of the texts at the places ``held``."""
        if held:
            for i, ids in zip(held, self.together([texts[i] for i in held])):
                out[i] = ids
        return out


@kept_by_worker
@lru_cache(maxsize=4)
def encoder(path: str, spaced: bool) -> TextEncoder:
    """One encoder per worker process and file."""
    return TextEncoder(path, spaced)
