"""Secret scans: three fixed patterns, and values in credential contexts that would be hard to guess.

How many guesses a value withstands is found by dynamic programming over its letters: the
cheapest way to cut it into dictionary words, dates, repeats, keyboard walks and spans that
must be tried letter by letter. A cost is the base-10 logarithm of a number of guesses, so
costs of parts add up.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.llm.common import chunks, texts

KINDS = ["assign", "access", "hex", "guess"]

# The patterns every scan must find, and the least length of a match.
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_LENGTH, ACCESS_LENGTH = 6, 20

# What names a credential, beyond the patterns, at the end of a name with any prefix, as in DB_PASS;
# the value follows after ":", "=", "is" or "bearer".
_CONTEXT = re.compile(
    r"""(?:(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|api[_-]?key|(?:access|private|auth|client|encryption)"""
    r"""[_-]?(?:key|token|secret)|credentials?)["']?\x20*(?::|=>?|\x20is\b)|bearer)\x20*["']?([^\s"',;<>|]{6,})""",
    re.ASCII | re.IGNORECASE,
)
_CONTEXT_HINTS = ("pass", "pwd", "secret", "token", "key", "credential", "bearer")

# A value that withstands this many guesses (base-10 logarithm) is taken for a secret.
GUESSES = 8.0
# Dictionary words, walks and repeated units are looked for up to this length; a longer one
# is made of several at about the same cost, so values of any length take linear time.
REACH = 24

_ROWS = ["`1234567890-=", "qwertyuiop[]\\", "asdfghjkl;'", "zxcvbnm,./"]
_SHIFTED = dict(zip('~!@#$%^&*()_+{}|:"<>?', "`1234567890-=[]\\;',./", strict=True))
_DATE = re.compile(
    r"(?:19|20)\d\d(?:([-/.]?)(?:0[1-9]|1[0-2])\1(?:0[1-9]|[12]\d|3[01]))?"
    r"|(?:0[1-9]|[12]\d|3[01])([-/.]?)(?:0[1-9]|1[0-2])\2(?:(?:19|20)\d\d|\d\d)"
)


def _beside() -> dict[str, set[str]]:
    """The keys next to each key of a keyboard whose rows are shifted by about half a key."""
    near: dict[str, set[str]] = {}
    for row, keys in enumerate(_ROWS):
        for column, key in enumerate(keys):
            places = [(row, column - 1), (row, column + 1), (row, column)]
            places += [(row - 1, column), (row - 1, column + 1), (row + 1, column - 1), (row + 1, column)]
            near[key] = {_ROWS[r][c] for r, c in places if 0 <= r < len(_ROWS) and 0 <= c < len(_ROWS[r])}
    return near


_NEAR = _beside()


@lru_cache(maxsize=2)
def dictionary(path: str) -> dict[str, int]:
    """Whole words of a public vocabulary file with word ends, ranked by its order of frequency."""
    with open(path, encoding="utf-8") as file:
        model = json.load(file)["model"]
    suffix = model["end_of_word_suffix"]
    ranked = sorted((number, token) for token, number in model["vocab"].items() if token.endswith(suffix))
    words = [token[: -len(suffix)] for _, token in ranked]
    return {word: rank for rank, word in enumerate((w for w in words if len(w) > 2 and w.isascii() and w.isalpha()), 1)}


def _letter_cost(letter: str) -> float:
    if letter.isdigit():
        return 1.0
    return math.log10(26 if letter.isascii() and letter.isalpha() else 33)


def guess_cost(value: str, words: dict[str, int], enough: float = math.inf) -> float:
    """The base-10 logarithm of the guesses that the cheapest cut of `value` withstands.

    Once it must reach `enough`, the rest is not looked at and a number of at least that is given.
    """
    size = len(value)
    plain = "".join(_SHIFTED.get(c, c) for c in value.lower())
    lowered = value.lower()
    best = [0.0] + [math.inf] * size
    dates = {}
    for at in range(size):
        if found := _DATE.match(value, at):
            dates[at] = found.end()
    walk = 0
    for end in range(1, size + 1):
        # Letter by letter; any other span costs a little more for knowing where it is cut.
        cost = best[end - 1] + _letter_cost(value[end - 1])
        for begin in range(max(0, end - REACH), end - 2):
            rank = words.get(lowered[begin:end])
            if rank is not None:
                raised = value[begin:end] != lowered[begin:end]
                cost = min(cost, best[begin] + math.log10(rank + 1) + 0.3 + 0.7 * raised)
        walk = walk + 1 if end > 1 and plain[end - 1] in _NEAR.get(plain[end - 2], ()) else 1
        for length in range(3, min(walk, REACH) + 1):
            cost = min(cost, best[end - length] + 1.7 + 0.4 * (length - 1))
        for unit in range(1, REACH // 2 + 1):
            times = 1
            while end - (times + 1) * unit >= 0 and (times + 1) * unit <= 2 * REACH:
                back = end - times * unit
                if value[back - unit : back] != value[end - unit : end]:
                    break
                times += 1
                begin = end - times * unit
                unit_cost = sum(map(_letter_cost, value[end - unit : end]))
                cost = min(cost, best[begin] + unit_cost + math.log10(times) + 0.3)
        for begin, stop in dates.items():
            if stop == end:
                cost = min(cost, best[begin] + (2.1 if end - begin == 4 else 4.6))
        best[end] = cost
        # Every cut passes through one of the last places, as no span is longer.
        if cost >= enough and min(best[max(0, end - 2 * REACH) : end + 1]) >= enough:
            return cost
        dates = {begin: stop for begin, stop in dates.items() if stop > end or begin >= end}
    return best[size]


def find(text: str, words: dict[str, int], guesses: float = GUESSES) -> list[tuple[str, int, int]]:
    """(kind, start, end) of all spans in code points, by start and then by the order of KINDS."""
    spans = []
    low = text.lower()
    if any(name in low for name in ("passw", "secret", "token", "api")):
        spans += [
            ("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if len(m.group(2)) >= ASSIGN_LENGTH
        ]
    if "AKIA" in text:
        spans += [("access", *m.span()) for m in _ACCESS.finditer(text) if len(m.group()) >= ACCESS_LENGTH]
    spans += [("hex", *m.span()) for m in _HEX.finditer(text)]
    if any(hint in low for hint in _CONTEXT_HINTS):
        for m in _CONTEXT.finditer(text):
            value = m.group(1).rstrip(".!?)")
            if guess_cost(value, words, guesses) >= guesses:
                spans.append(("guess", m.start(1), m.start(1) + len(value)))
    return sorted(spans, key=lambda span: (span[1], KINDS.index(span[0])))


def scan(docs: DataFrame, vocabulary: str, guesses: float = GUESSES) -> DataFrame:
    """doc_id and `found`, an array of (kind, start, end), for every row of `docs`.

    `assign`, `access` and `hex` are the fixed patterns, `guess` the values in credential
    contexts of at least 10^`guesses` guesses; ends are exclusive. A null or empty text has
    none. Each row is scanned by itself, whole; nothing is shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = dictionary(vocabulary)
        for batch in batches:
            for part in chunks(batch):
                found = [find(text, words, guesses) for text in texts(part.column("text"))]
                spans = [span for row in found for span in row]
                listed = pa.StructArray.from_arrays(
                    [
                        pa.array([kind for kind, _, _ in spans], pa.string()),
                        pa.array([start for _, start, _ in spans], pa.int64()),
                        pa.array([end for _, _, end in spans], pa.int64()),
                    ],
                    ["kind", "start", "end"],
                )
                ends = pa.array(np.cumsum([0, *map(len, found)], dtype=np.int32))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.ListArray.from_arrays(ends, listed)], ["doc_id", "found"]
                )

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "doc_id long, found array<struct<kind: string, start: long, end: long>>")


def digests(scanned: DataFrame) -> DataFrame:
    """Counts by kind, the digest of the base spans, and all spans as text."""

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind):
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("found", lambda s: s["kind"] != "guess")
    return scanned.select(
        "doc_id",
        *map(count, KINDS),
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("found")).alias("spans"),
    )
