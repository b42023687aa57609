"""SentencePiece encoding and decoding with weighted finite-state transducers.

Three transducers are compiled from a model file: the normaliser (space to the word mark, a mark in front), the pieces
(a trie of characters, one arc path per piece), and the byte fallback (each character without a piece to its bytes).
Input is composed with them part by part, and the encoding is the shortest path in the tropical semiring.

The weights carry the order of merges. A model of merged pairs encodes a text as the only path on which every two
neighbouring pieces stay apart when their joined text is encoded. So the arc from a piece to the next one weighs nothing
if the two stay apart, and infinitely much if they would merge otherwise; these weights are found once per pair and
kept. Pieces may hold word marks in front only, so a text is composed word by word, and words are kept, too.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import kept_by_worker, ship, text_batches

MARK = "▁"
INFINITE = float("inf")
CACHE_WORDS = 400_000
CACHE_PAIRS = 2_000_000
LONGEST_KEPT = 64
# Types of pieces and of models in the file.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
MERGES = 2


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Numbers and values of the fields of a protocol buffer message."""

    def number(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            byte = data[at]
            value |= (byte & 0x7F) << shift
            at, shift = at + 1, shift + 7
            if byte < 0x80:
                return value, at

    at = 0
    while at < len(data):
        key, at = number(at)
        kind = key & 7
        if kind == 0:
            value, at = number(at)
        elif kind == 2:
            length, at = number(at)
            value, at = data[at : at + length], at + length
        else:
            length = 4 if kind == 5 else 8
            value, at = data[at : at + length], at + length
        yield key >> 3, value


class Model:
    """Pieces of a model file: texts, scores, types, and what its normaliser does."""

    def __init__(self, path: str) -> None:
        self.pieces: list[str] = []
        self.scores: list[float] = []
        self.types: list[int] = []
        trainer: dict[int, int | bytes] = {}
        normaliser: dict[int, int | bytes] = {}
        with open(path, "rb") as file:
            for key, value in fields(file.read()):
                if key == 1:
                    piece = {k: v for k, v in fields(value)}
                    self.pieces.append(piece[1].decode())
                    self.scores.append(float(np.frombuffer(piece.get(2, b"\0\0\0\0"), "<f4")[0]))
                    self.types.append(piece.get(3, NORMAL))
                elif key == 2:
                    trainer = dict(fields(value))
                elif key == 3:
                    normaliser = dict(fields(value))
        self.front_mark = bool(normaliser.get(3, 1))
        self.trims = bool(normaliser.get(4, 1))
        if trainer.get(3, 1) != MERGES or normaliser.get(2, b"") or USER in self.types:
            raise ValueError("only models of merged pairs with the identity normaliser are compiled")


class Transducers:
    def __init__(self, path: str) -> None:
        model = Model(path)
        self.model = model
        self.ids = {p: i for i, (p, t) in enumerate(zip(model.pieces, model.types)) if t == NORMAL}
        if any(MARK in p.lstrip(MARK) for p in self.ids):
            raise ValueError("pieces hold a word mark after other characters")
        self.bytes = {int(p[3:5], 16): i for i, (p, t) in enumerate(zip(model.pieces, model.types)) if t == BYTE}
        self.unknown = model.types.index(UNKNOWN)
        self.score = {p: model.scores[i] for p, i in self.ids.items()}
        # States of the piece transducer: character -> (next state), and whether a piece ends there.
        self.trie: dict = {}
        for piece in self.ids:
            state = self.trie
            for c in piece:
                state = state.setdefault(c, {})
            state[""] = piece
        #: Characters that follow each other in some piece; between others no piece can lie.
        self.joints = {piece[i : i + 2] for piece in self.ids for i in range(len(piece) - 1)}
        self.pairs: dict[tuple[str, str], bool] = {}
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.texts = [self.text_of(i) for i in range(len(model.pieces))]

    def text_of(self, i: int) -> bytes:
        """What the inverse transducers write for an id."""
        kind, piece = self.model.types[i], self.model.pieces[i]
        if kind == BYTE:
            return bytes([int(piece[3:5], 16)])
        if kind == NORMAL:
            return piece.replace(MARK, " ").encode()
        return " \u2047 ".encode() if kind == UNKNOWN else b""

    def normalised(self, text: str) -> str:
        """Output of the normaliser: spaces as marks, a mark in front; nothing for the empty text."""
        if self.model.trims:
            text = " ".join(x for x in text.split(" ") if x)
        return (MARK if text and self.model.front_mark else "") + text.replace(" ", MARK)

    def merged(self, text: str) -> list[str]:
        """Characters of a short text merged pair by pair, best score first, leftmost among equals."""
        parts = list(text)
        while len(parts) > 1:
            best, at = -INFINITE, -1
            for i in range(len(parts) - 1):
                score = self.score.get(parts[i] + parts[i + 1], -INFINITE)
                if score > best:
                    best, at = score, i
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def apart(self, a: str, b: str) -> bool:
        """Weigh the arc from piece a to piece b nothing (True) or infinitely much?"""
        known = self.pairs.get((a, b))
        if known is None:
            known = self.merged(a + b) == [a, b] if a else self.merged(b) == [b]
            if len(self.pairs) >= CACHE_PAIRS:
                self.pairs.clear()
            self.pairs[a, b] = known
        return known

    def arcs(self, word: str, at: int) -> list[str]:
        """Pieces that the piece transducer accepts from a position, the lone character among them."""
        state, out, n = self.trie, [], len(word)
        first = word[at]
        i = at
        while i < n:
            state = state.get(word[i])
            if state is None:
                break
            i += 1
            piece = state.get("")
            if piece is not None:
                out.append(piece)
        if not out or out[0] != first:
            out.insert(0, first)
        return out

    def shortest_path(self, word: str) -> list[str]:
        """The composition of a word with the pieces, followed along arcs of finite weight.

        States are (position, last piece). All finite paths weigh nothing, so the search may go depth first, longest
        pieces ahead; a state that leads nowhere is not entered again.
        """
        n, at, before = len(word), 0, ""
        dead: set[tuple[int, str]] = set()
        path: list[str] = []
        pairs = self.pairs
        stack = [self.arcs(word, 0)]
        while at < n:
            waiting = stack[-1]
            while waiting:
                piece = waiting.pop()
                free = pairs.get((before, piece))
                if free is None:
                    free = self.apart(before, piece)
                if free and (not dead or (at + len(piece), piece) not in dead):
                    path.append(piece)
                    before = piece
                    at += len(piece)
                    if at < n:
                        stack.append(self.arcs(word, at))
                    break
            else:
                if not path:
                    raise ValueError(f"no path through {word!r}")
                stack.pop()
                dead.add((at, path[-1]))
                at -= len(path.pop())
                before = path[-1] if path else ""
        return path

    def outputs(self, piece: str) -> list[int]:
        """Ids of a piece, or of its bytes where there is none."""
        found = self.ids.get(piece)
        if found is not None:
            return [found]
        data = piece.encode("utf-8", "surrogatepass")
        return [self.bytes[b] for b in data] if self.bytes else [self.unknown]

    def kept(self, part: str, made) -> bytes:
        """The ids of a part, made when first asked for; a full cache becomes the older one."""
        out = self.words.get(part)
        if out is None:
            out = self.older.pop(part, None)
            if out is None:
                out = made(part)
            if len(part) <= LONGEST_KEPT:
                if len(self.words) >= CACHE_WORDS:
                    self.older, self.words = self.words, {}
                self.words[part] = out
        return out

    def path_ids(self, part: str) -> bytes:
        return np.array([i for p in self.shortest_path(part) for i in self.outputs(p)], "<u4").tobytes()

    def word_ids(self, word: str) -> bytes:
        """A word cut where no piece can lie across, each part by its shortest path."""
        joints, cut, out = self.joints, 0, []
        for i in range(1, len(word)):
            if word[i - 1 : i + 1] not in joints:
                out.append(self.kept(word[cut:i], self.path_ids))
                cut = i
        if not cut:
            return self.path_ids(word)
        out.append(self.kept(word[cut:], self.path_ids))
        return b"".join(out)

    def encode(self, text: str | None) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit bytes; none for null and the empty text."""
        if not text:
            return b""
        text = self.normalised(text)
        out, lead = [], ""
        head, *words = text.split(MARK)
        if head:
            out.append(self.kept(head, self.word_ids))
        for word in words:  # each after one mark; marks without a word go with the next one
            lead += MARK
            if word:
                part = lead + word
                lead = ""
                out.append(self.words.get(part) or self.kept(part, self.word_ids))
        if lead:
            out.append(self.kept(lead, self.word_ids))
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        """The text of ids: the inverse transducers, bytes joined first, marks to spaces, the front one removed."""
        texts = self.texts
        text = b"".join([texts[i] for i in np.frombuffer(ids, "<u4").tolist()]).decode("utf-8", "replace")
        return text[1:] if self.model.front_mark and text.startswith(" ") else text


@kept_by_worker
@lru_cache(maxsize=2)
def transducers(path: str) -> Transducers:
    """Compiled once per worker process and file."""
    return Transducers(path)


def encode(documents: DataFrame, model: str) -> DataFrame:
    """doc_id, n_pieces, ids (little-endian unsigned 32-bit) and ids_crc32 of each whole text; null texts as empty."""
    ship(documents.sparkSession)
    kind = documents.schema["doc_id"].dataType.simpleString()

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = transducers(model)
        for batch, texts in text_batches(batches, "text"):
            ids = [machine.encode(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(x) // 4 for x in ids], pa.int64()),
                    pa.array(ids, pa.binary()),
                    pa.array([zlib.crc32(x) for x in ids], pa.int64()),
                ],
                names=["doc_id", "n_pieces", "ids", "ids_crc32"],
            )

    rows = documents.select("doc_id", "text")
    return rows.mapInArrow(encoded, f"doc_id {kind}, n_pieces long, ids binary, ids_crc32 long")


def decode(encoded: DataFrame, model: str, column: str = "text") -> DataFrame:
    """``encoded`` (doc_id, ids, any others) with the text of the ids in place of them; null ids give a null text."""
    ship(encoded.sparkSession)
    others = [f for f in encoded.schema.fields if f.name != "ids"]

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = transducers(model)
        for batch, values in text_batches(batches, "ids"):
            texts = pa.array([None if v is None else machine.decode(v) for v in values], pa.string())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(f.name) for f in others), texts], names=[*(f.name for f in others), column]
            )

    kind = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in others)
    return encoded.mapInArrow(decoded, f"{kind}, `{column}` string")
