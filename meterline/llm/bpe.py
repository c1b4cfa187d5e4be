"""Byte-pair encoding without merge queues, and decoding by an offset table.

A text is encoded word by word. All vocabulary tokens in a word come from one pass of an
Aho-Corasick automaton. From the left, the longest token is tried first. It stands if the
merges would never join across its border with the token before it, which a table of pairs
already judged says; if not, the next shorter token is tried, and when none is left the
token before is taken back. Every position is given up at most once, so a word takes linear
time, and the result is that of the merges, exactly.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator, Sequence
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Regex, pre_tokenizers

from meterline.llm.common import (
    LATIN_LETTERS,
    LATIN_NUMBERS,
    LATIN_SPACE,
    SPACE,
    UNASSIGNED,
    chunks,
    is_latin,
    texts,
)

WORD_CACHE = 400_000

# The words of the vocabulary's pre-tokenizer. Contractions begin with a mark,
# so letters may come first.
_WORD = regex.compile(rf"\p{{L}}+|'s|'t|'re|'ve|'m|'ll|'d|\p{{N}}|[^{SPACE}\p{{L}}\p{{N}}]+")
# The same for texts of Latin-1 letters alone, with the faster library.
_LATIN_WORD = re.compile(
    rf"[{LATIN_LETTERS}]+|'s|'t|'re|'ve|'m|'ll|'d|[{LATIN_NUMBERS}]|[^{LATIN_SPACE}{LATIN_LETTERS}{LATIN_NUMBERS}]+"
)


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in a vocabulary file: printable Latin-1
    bytes for themselves, the others for the letters from 256 on in order."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    letters = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return [letters[b] for b in range(256)]


class Bpe:
    """An encoder and decoder for a vocabulary file with word ends and a merge list.

    Token ids must rise with merge order, as a list of merges in file order gives them.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            held = json.load(file)
        model = held["model"]
        self.suffix = model["end_of_word_suffix"]
        vocab: dict[str, int] = model["vocab"]
        self.special = {token["content"]: token["id"] for token in held["added_tokens"]}
        self.special_re = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")

        pattern = held["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.library_split = pre_tokenizers.Split(Regex(pattern), "removed", invert=True)

        # A word's last letter is another symbol than the same letter inside a word.
        self.inner = byte_letters()
        self.last = {letter: chr(0x1000 + byte) for byte, letter in enumerate(self.inner)}
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.parts: list[tuple[int, int] | None] = [None] * size
        self.joined: dict[int, int] = {}
        for left, right in model["merges"]:
            made, a, b = vocab[left + right], vocab[left], vocab[right]
            self.parts[made] = (a, b)
            self.joined[a << 20 | b] = made

        self.judged: dict[int, bool] = {}
        symbols = {token: self._symbols(token) for token in vocab}
        self.length = [0] * size
        automaton = ahocorasick.Automaton()
        by_symbols: dict[str, int] = {}
        for token, number in vocab.items():
            parts = self.parts[number]
            # A token that the merges never leave standing cannot be part of an encoding.
            if parts is None or self._stands(*parts, limit=number):
                by_symbols[symbols[token]] = number
                self.length[number] = len(symbols[token])
                automaton.add_word(symbols[token], (number, len(symbols[token]) - 1))
        automaton.make_automaton()
        self.automaton = automaton
        self.shorter = [-1] * size
        for text, number in by_symbols.items():
            for end in range(len(text) - 1, 0, -1):
                if (found := by_symbols.get(text[:end])) is not None:
                    self.shorter[number] = found
                    break

        strings = [""] * size
        for token, number in [*vocab.items(), *self.special.items()]:
            strings[number] = token
        pieces = [f"{string} ".encode() for string in strings]
        self.bytes = np.frombuffer(b"".join(pieces), np.uint8)
        self.sizes = np.array([len(p) for p in pieces], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)[:-1]])
        self.words: dict[str, bytes] = {}

    def _symbols(self, token: str) -> str:
        if token.endswith(self.suffix) and len(token) > len(self.suffix):
            stem = token[: -len(self.suffix)]
            return stem[:-1] + self.last[stem[-1]]
        return token

    def _stands(self, left: int, right: int, limit: int = 1 << 30) -> bool:
        """Whether merges of a rank under `limit` leave the border between two tokens alone.

        Both are taken apart from their last merge back. A merge across the border that comes
        before the merges still undone would have been done instead.
        """
        while True:
            across = self.joined.get(left << 20 | right)
            if across is not None and across < limit:
                return False
            a, b = self.parts[left], self.parts[right]
            # On a tie of ranks the left merge is the earlier, as merging goes from the left.
            if a is not None and (b is None or left > right):
                limit = min(limit, left)
                left = a[1]
            elif b is not None:
                limit = min(limit, right + 1)
                right = b[0]
            else:
                return True

    def _fits(self, left: int, right: int) -> bool:
        pair = left << 20 | right
        known = self.judged.get(pair)
        if known is None:
            if len(self.judged) > 1_000_000:
                self.judged.clear()
            known = self.judged[pair] = self._stands(left, right)
        return known

    def encode_word(self, word: str) -> list[int]:
        """The ids of one word, without look at any cache of words."""
        inner = self.inner
        letters = [inner[byte] for byte in word.encode()]
        letters[-1] = self.last[letters[-1]]
        size = len(letters)
        longest = [-1] * size
        for end, (token, before) in self.automaton.iter("".join(letters)):
            longest[end - before] = token
        dead = bytearray(size + 1)
        taken: list[int] = []
        at, token = 0, longest[0]
        while at < size or token >= 0:
            while token >= 0:
                end = at + self.length[token]
                if not dead[end] and (not taken or self._fits(taken[-1], token)):
                    break
                token = self.shorter[token]
            if token >= 0:
                taken.append(token)
                at = end
                token = longest[at] if at < size else -1
            else:
                dead[at] = 1
                token = taken.pop()
                at -= self.length[token]
        return taken

    def encode(self, text: str) -> np.ndarray:
        """The ids of a text."""
        words, out = self.words, []
        for piece in self.special_re.split(text) if "<|" in text else (text,):
            if piece in self.special:
                out.append(np.array([self.special[piece]], "<i4").tobytes())
                continue
            # Letter by letter: a sigma at a word's end is lowered like any other.
            plain = unicodedata.normalize("NFC", piece).replace("Σ", "σ").lower()
            found = (_LATIN_WORD if is_latin(plain) else _WORD).findall(plain)
            held = list(map(words.get, found))
            if None in held:
                missing = {word for word, known in zip(found, held, strict=True) if known is None}
                # Letters newer than `regex` knows are split by the library of the vocabulary.
                if any(map(UNASSIGNED.search, missing)):
                    found = [word for word, _ in self.library_split.pre_tokenize_str(plain)]
                    missing = {word for word in found if word not in words}
                fresh = {word: np.array(self.encode_word(word), "<i4").tobytes() for word in missing}
                held = [words.get(word) or fresh[word] for word in found]
                # Full, the table stays as it is: what came first is what comes often.
                if len(words) < WORD_CACHE:
                    words.update((k, v) for k, v in fresh.items() if len(k) <= 64 and not UNASSIGNED.search(k))
            out += held
        return np.frombuffer(b"".join(out), "<i4")

    def decode(self, ids: np.ndarray) -> str:
        """The tokens of the ids joined by a space, as of a vocabulary without a decoder of its own."""
        if not len(ids):
            return ""
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        at = np.arange(ends[-1]) + np.repeat(self.starts[ids] - (ends - sizes), sizes)
        return self.bytes[at[:-1]].tobytes().decode()


@lru_cache(maxsize=2)
def load(path: str) -> Bpe:
    """The vocabulary at `path`, read once per process."""
    return Bpe(path)


def encode_decode(docs: DataFrame, path: str, keep: Sequence[str] = ()) -> DataFrame:
    """doc_id, ids and decoded for every row of `docs`, which has doc_id and text, and its `keep` columns.

    A null or empty text has no ids and decodes to the empty text. Rows are handled one by
    one: repeated or null doc_ids give as many rows. Other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for batch in batches:
            for part in chunks(batch, size=4 << 20):
                ids = [bpe.encode(text) for text in texts(part.column("text"))]
                ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
                flat = pa.array(np.concatenate(ids), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.ListArray.from_arrays(pa.array(ends), flat),
                        pa.array([bpe.decode(x) for x in ids], pa.string()),
                        *[part.column(name) for name in keep],
                    ],
                    ["doc_id", "ids", "decoded", *keep],
                )

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), *keep)
    kept = "".join(f", {name} {rows.schema[name].dataType.simpleString()}" for name in keep)
    return rows.mapInArrow(run, f"doc_id long, ids array<int>, decoded string{kept}")


def digests(encoded: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of what `encode_decode` gives, and the `keep` columns."""
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        *keep,
    )
