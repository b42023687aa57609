"""Fill-in-middle: whole texts cut at two of their line boundaries, their middle moved to the end.

The boundaries of a text are a set of code point offsets that answers "which is the k-th?": offsets are dealt by their high
16 bits into containers, each an array, a bitmap or runs, whichever is smallest, with the number of offsets before each
container. A container is found by binary search in these numbers, the offset in it by a select of its own.
Tasks in Python return two numbers a text; outputs are put together by Spark.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ship

LOW_BITS = 16
WORDS = (1 << LOW_BITS) // 64


@dataclass(frozen=True)
class ArrayContainer:
    """Low halves in order, two bytes each."""

    values: np.ndarray

    def select(self, k: int) -> int:
        return int(self.values[k])


@dataclass(frozen=True)
class BitmapContainer:
    """A bit per low half, and the number of set bits before each word."""

    words: np.ndarray
    before: np.ndarray

    @classmethod
    def of(cls, low: np.ndarray) -> BitmapContainer:
        bits = np.zeros(1 << LOW_BITS, np.uint8)
        bits[low] = 1
        words = np.packbits(bits, bitorder="little").view("<u8")
        counts = np.bitwise_count(words).astype(np.int64)
        return cls(words, np.cumsum(counts) - counts)

    def select(self, k: int) -> int:
        at = int(np.searchsorted(self.before, k, side="right")) - 1
        bits = np.unpackbits(self.words[at : at + 1].view(np.uint8), bitorder="little")
        return 64 * at + int(np.flatnonzero(bits)[k - self.before[at]])


@dataclass(frozen=True)
class RunContainer:
    """First low half of each run of neighbours, and the number of offsets before it."""

    starts: np.ndarray
    before: np.ndarray

    def select(self, k: int) -> int:
        at = int(np.searchsorted(self.before, k, side="right")) - 1
        return int(self.starts[at]) + k - int(self.before[at])


def container(low: np.ndarray) -> ArrayContainer | BitmapContainer | RunContainer:
    """The smallest container for ascending low halves: 2 bytes a value, 4 bytes a run or 8 KiB."""
    firsts = np.flatnonzero(np.diff(low.astype(np.int64), prepend=-2) != 1)
    array, runs, bitmap = 2 * len(low), 4 * len(firsts), 8 * WORDS
    if runs < min(array, bitmap):
        return RunContainer(low[firsts], firsts)
    return ArrayContainer(low) if array <= bitmap else BitmapContainer.of(low)


class BoundarySet:
    """Ascending distinct offsets in containers with cumulative cardinalities."""

    def __init__(self, offsets: np.ndarray) -> None:
        high, low = offsets >> LOW_BITS, (offsets & ((1 << LOW_BITS) - 1)).astype(np.uint16)
        cuts = np.flatnonzero(np.diff(high, prepend=-1))
        self.highs = high[cuts]
        self.before = cuts  # the number of offsets before each container
        self.size = len(offsets)
        ends = [*cuts[1:].tolist(), len(offsets)]
        self.containers = [container(low[a:b]) for a, b in zip(cuts.tolist(), ends)]

    def __len__(self) -> int:
        return self.size

    def select(self, k: int) -> int:
        """The k-th offset, from 0."""
        if not 0 <= k < self.size:
            raise IndexError(k)
        at = int(np.searchsorted(self.before, k, side="right")) - 1
        return (int(self.highs[at]) << LOW_BITS) + self.containers[at].select(k - int(self.before[at]))


def line_boundaries(text: str) -> BoundarySet:
    """0 and the code point offset behind each line; a line ends with its line feed or with the text."""
    data = text.encode()
    octets = np.frombuffer(data, np.uint8)
    feeds = np.flatnonzero(octets == 10)
    if len(data) == len(text):
        ends = feeds + 1
    else:  # every code point has one octet that continues none
        ends = np.cumsum(octets & 0xC0 != 0x80, dtype=np.int64)[feeds]
    tail = [] if not text or text[-1] == "\n" else [len(text)]
    return BoundarySet(np.concatenate([[0], ends, tail]).astype(np.int64))


def cuts(text: str, first: int, second: int) -> tuple[int, int, int]:
    """The number of lines, and the two offsets at these draws modulo the number of boundaries, the smaller first."""
    bounds = line_boundaries(text)
    low, high = sorted((first % len(bounds), second % len(bounds)))
    return len(bounds) - 1, bounds.select(low), bounds.select(high)


def draws(seed: int, doc_id: Column) -> list[Column]:
    """Four unsigned 32-bit numbers of seed and id; a null id counts as an empty one."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


Marks = tuple[str, str, str]
#: Marks before prefix, suffix and middle.
MARKS: Marks = ("<P>", "<S>", "<M>")


def transform(documents: DataFrame, seed: int, rate: int = 100, spm: int = 50, marks: Marks = MARKS) -> DataFrame:
    """Every text cut and put together anew: doc_id, n, form, prefix_chars, middle_chars, output.

    n is the number of lines. ``rate`` percent of the texts are transformed, ``spm`` percent of these with the suffix
    first; the others, empty and null texts, and texts that hold a mark are plain: their output is the text, their numbers
    of characters are null. Draws depend on seed and doc_id alone, so repeated rows come out alike; a null id counts as an
    empty one. Other columns are left out whatever their names; an empty table gives no rows.
    """
    ship(documents.sparkSession)

    @F.pandas_udf("n long, low long, high long")
    def found(texts: pd.Series, firsts: pd.Series, seconds: pd.Series) -> pd.DataFrame:
        rows = [cuts(*row) for row in zip(texts, firsts, seconds)]
        return pd.DataFrame(np.array(rows, np.int64).reshape(-1, 3), columns=["n", "low", "high"])

    before, behind, between = (F.lit(m) for m in marks)
    rows = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    h = dict(zip(("h1", "h2", "h3", "h4"), draws(seed, F.col("doc_id"))))
    cut = rows.select("doc_id", "text", found(F.col("text"), h["h1"], h["h2"]).alias("at"))
    text, low, high = F.col("text"), F.col("at.low"), F.col("at.high")
    marked = F.contains(text, before) | F.contains(text, behind) | F.contains(text, between)
    form = (
        F.when((text == "") | marked | (h["h3"] % 100 >= rate), "plain").when(h["h4"] % 100 < spm, "spm").otherwise("psm")
    )
    prefix = F.substr(text, F.lit(1), low.cast("int"))
    middle = F.substr(text, (low + 1).cast("int"), (high - low).cast("int"))
    suffix = F.substr(text, (high + 1).cast("int"))
    known = cut.select("doc_id", "text", "at", form.alias("form"))
    output = (
        F.when(F.col("form") == "plain", text)
        .when(F.col("form") == "psm", F.concat(before, prefix, behind, suffix, between, middle))
        .otherwise(F.concat(behind, suffix, before, prefix, between, middle))
    )
    moved = F.col("form") != "plain"
    return known.select(
        "doc_id",
        F.col("at.n").alias("n"),
        "form",
        F.when(moved, low).alias("prefix_chars"),
        F.when(moved, high - low).alias("middle_chars"),
        output.alias("output"),
    )


def restored(output: Column, form: Column, marks: Marks = MARKS) -> Column:
    """The exact text of an output. No text that was cut holds a mark, and no mark can arise where two parts meet."""

    def parts(first: str, second: str, third: str) -> tuple[Column, Column, Column]:
        at, to = F.locate(second, output), F.locate(third, output)
        start = len(first) + 1
        return (
            F.substr(output, F.lit(start), at - start),
            F.substr(output, at + len(second), to - at - len(second)),
            F.substr(output, to + len(third)),
        )

    before, behind, between = marks
    prefix, suffix, middle = parts(before, behind, between)
    later_suffix, later_prefix, later_middle = parts(behind, before, between)
    return (
        F.when(form == "plain", output)
        .when(form == "psm", F.concat(prefix, middle, suffix))
        .otherwise(F.concat(later_prefix, later_middle, later_suffix))
    )
