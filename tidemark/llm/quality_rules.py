"""Quality rules: a table of thresholds compiled into one projection, without user functions or shuffles."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, fresh

# What is no white space between words, and what is not counted as symbols.
NOT_SPACE = r"[^\x20\x09-\x0D]"
NOT_SYMBOLS = r"[^#*$%&|<>]+"

# Frequent function words of the languages in use.
STOP_WORDS = (
    "the of and to in is a that it on for with as was are by this be at from or "
    "der die das und ist nicht ein eine zu den von mit für auf im sich des dem "
    "le la les de des un une et est en que qui pour dans par sur au du ou pas il avec "
    "el los las y es por con para una se no lo mi al como más pero su"
).split()


@dataclass(frozen=True)
class Rule:
    """``scale * measure`` must lie between ``low`` and ``high`` times ``base``; None leaves a side open.

    All in whole numbers, so that every engine gives the same verdict. ``from_words``: the rule is for texts of so
    many words or more.
    """

    name: str
    measure: str
    base: str
    scale: int
    low: int | None = None
    high: int | None = None
    from_words: int = 0

    def sql(self) -> str:
        sides = [f"{self.scale} * {self.measure} >= {self.low} * {self.base}"] if self.low is not None else []
        sides += [f"{self.scale} * {self.measure} <= {self.high} * {self.base}"] if self.high is not None else []
        return f"(n_words < {self.from_words} OR ({' AND '.join(sides)}))"


RULES = (
    Rule("mean_word_length", "word_chars", "n_words", 10, low=20, high=150),
    Rule("symbols_per_word", "n_symbols", "n_words", 100, high=20),
    Rule("stop_words", "n_stop_words", "n_words", 1000, low=10, from_words=50),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", 100, high=50),
    Rule("words_per_line", "n_words", "n_lines", 1, high=5000),
)


#: Places in a text up to this many words fit beside a hash in one number; longer texts take a slower, equal path.
PLACE_BITS = 20


def windows(w: Column, made) -> Column:
    """``made(place, first, second, third)`` for each window of three words; none for fewer words."""
    return F.when(
        F.size(w) > 3,
        F.transform(
            F.sequence(F.lit(0), F.size(w) - 3), lambda i: made(i, F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))
        ),
    )


def packed(w: Column) -> Column:
    """Hash and place of each window in one number, sorted: equal windows are neighbours."""
    return F.sort_array(
        windows(w, lambda i, a, b, c: F.shiftleft(F.xxhash64(a, b, c), PLACE_BITS).bitwiseOR(i.cast("long")))
    )


def same_window(w: Column, i: Column, k: Column) -> Column:
    return (
        (F.get(w, i) == F.get(w, k)) & (F.get(w, i + 1) == F.get(w, k + 1)) & (F.get(w, i + 2) == F.get(w, k + 2))
    )


def near_places(s: Column) -> Column:
    """Places of windows whose hash a neighbour shares."""

    def hashed(x: Column) -> Column:
        return F.shiftright(x, PLACE_BITS)

    def shared(x: Column, i: Column) -> Column:
        return F.coalesce(
            (hashed(x) == hashed(F.get(s, i - 1))) | (hashed(x) == hashed(F.get(s, i + 1))), F.lit(False)
        )

    place = (1 << PLACE_BITS) - 1
    return F.transform(F.filter(s, shared), lambda x: x.bitwiseAND(F.lit(place)).cast("int"))


def mixed_up(w: Column, s: Column) -> Column:
    """Do two windows with one hash differ, or do places not fit? Then only whole windows can be compared."""
    place = (1 << PLACE_BITS) - 1

    def differs(x: Column, i: Column) -> Column:
        before = F.get(s, i - 1)
        return F.coalesce(
            (F.shiftright(x, PLACE_BITS) == F.shiftright(before, PLACE_BITS))
            & ~same_window(w, x.bitwiseAND(F.lit(place)).cast("int"), before.bitwiseAND(F.lit(place)).cast("int")),
            F.lit(False),
        )

    return (F.size(w) > place) | (F.size(F.filter(s, differs)) > 0)


def exact_places(w: Column) -> Column:
    """The same places by comparing whole windows."""
    whole = F.sort_array(windows(w, lambda i, a, b, c: F.struct(F.struct(a, b, c).alias("k"), i.alias("at"))))

    def body(s: Column) -> Column:
        twice = F.filter(
            s,
            lambda x, i: F.coalesce(
                (x["k"] == F.get(s, i - 1)["k"]) | (x["k"] == F.get(s, i + 1)["k"]), F.lit(False)
            ),
        )
        return F.transform(twice, lambda x: x["at"])

    return F.transform(F.array(whole), body)[0]


def covered(at: Column) -> Column:
    """Words in windows at those sorted places; each adds the words that the one before it did not cover."""
    return F.coalesce(
        F.aggregate(
            F.transform(at, lambda p, i: F.least(F.lit(3), F.coalesce(p - F.get(at, i - 1), F.lit(3)))),
            F.lit(0).cast("long"),
            lambda total, n: total + n,
        ),
        F.lit(0),
    )


def measure(
    documents: DataFrame,
    text: str = "text",
    stop_words: Sequence[str] = STOP_WORDS,
    rules: Sequence[Rule] = RULES,
) -> DataFrame:
    """``documents`` with its measures and verdict in one struct column ``quality``.

    Fields: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_stop_words, n_lines, base_failed (under 50
    words, or more than half of them in repeated windows), failed (names of the rules it breaks), kept. Null texts
    count as empty and fail; repeated rows are judged each; if there is a column ``quality``, the new one is named
    ``fresh(documents, "quality")``. Spark keeps each step below as a projection of its own, as later ones use it
    more than once.
    """
    own = [F.col(f"`{c}`") for c in documents.columns]
    t, w, s, at, lines = (fresh(documents, f"rule_{n}") for n in ("text", "words", "windows", "places", "lines"))
    stops = F.lit(max(map(len, stop_words), default=0))
    line_list = F.filter(F.split(F.col(t), "\n", -1), lambda line: line.rlike(NOT_SPACE))
    steps = documents.select(*own, F.coalesce(F.col(f"`{text}`"), F.lit("")).alias(t))
    steps = steps.select(*own, t, F.regexp_extract_all(F.col(t), F.lit(WORD), F.lit(0)).alias(w), line_list.alias(lines))
    steps = steps.select("*", packed(F.col(w)).alias(s))
    steps = steps.select("*", F.sort_array(near_places(F.col(s))).alias(at))
    exact = F.when(
        (F.size(F.col(at)) > 0) & mixed_up(F.col(w), F.col(s)) | (F.size(F.col(w)) >= 1 << PLACE_BITS),
        F.sort_array(exact_places(F.col(w))),
    ).otherwise(F.col(at))
    steps = steps.select(*own, t, w, lines, exact.alias(at))
    figures = {
        "n_words": F.size(w).cast("long"),
        "word_chars": F.aggregate(F.col(w), F.lit(0).cast("long"), lambda n, x: n + F.length(x)),
        "n_symbols": F.length(F.regexp_replace(t, NOT_SYMBOLS, "")).cast("long"),
        "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
        "n_repeat_words": covered(F.col(at)),
        "n_stop_words": F.size(
            F.filter(w, lambda x: (F.length(x) <= stops) & F.lower(x).isin(*stop_words))
        ).cast("long"),
        "n_lines": F.size(lines).cast("long"),
    }
    q = fresh(documents, "rule_figures")
    steps = steps.select(*own, F.struct(*(c.alias(n) for n, c in figures.items())).alias(q))
    q = F.col(q)
    base_failed = (q["n_words"] < 50) | (100 * q["n_repeat_words"] > 50 * q["n_words"])
    broken = [F.when(~holds(rule, q), F.lit(rule.name)) for rule in rules]
    failed = F.array_compact(F.array(*broken)) if broken else F.array().cast("array<string>")
    kept = F.lit(True)
    for rule in rules:
        kept &= holds(rule, q)
    verdict = F.struct(
        *(q[n].alias(n) for n in figures),
        base_failed.alias("base_failed"),
        failed.alias("failed"),
        (~base_failed & kept).alias("kept"),
    )
    return steps.select(*own, verdict.alias(fresh(documents, "quality")))


def holds(rule: Rule, q: Column) -> Column:
    scaled, base = F.lit(rule.scale) * q[rule.measure], q[rule.base]
    inside = F.lit(True)
    if rule.low is not None:
        inside &= scaled >= F.lit(rule.low) * base
    if rule.high is not None:
        inside &= scaled <= F.lit(rule.high) * base
    return (q["n_words"] < rule.from_words) | inside
