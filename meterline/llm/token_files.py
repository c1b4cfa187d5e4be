"""Token ids in compressed files: encoded, pair-replaced per block, readable from any place.

A file set is a Parquet folder, so that it can lie in any store and a lost task leaves no
half of a file. Each row is a block of whole documents, in ascending doc_id order by
(shard, block), with these columns:

`shard`, `block`  place in the order; a shard is what one task wrote
`n_ids`           ids of all its documents
`doc_ids`         signed 64-bit little-endian; `null_ids` of them, the first ones, stand for null
`counts`          ids per document, unsigned 32-bit
`symbols`         unsigned 16-bit: ids as they are, from BASE on nonterminals
`rules`           two unsigned 16-bit symbols for each nonterminal, in the order they were made
`lengths`         how many ids each nonterminal stands for, unsigned 32-bit
`rounds`          how many rules each round of replacing made, unsigned 32-bit
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate, chain, pairwise
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from tokenizers import Tokenizer

from meterline.llm.bpe import byte_letters
from meterline.llm.common import (
    LATIN_LETTERS,
    LATIN_NUMBERS,
    LATIN_SPACE,
    SPACE,
    UNASSIGNED,
    is_latin,
    stored,
    texts,
)

END_ID = 0
# Ids must lie below BASE, so that an id or a nonterminal takes two bytes.
BASE = 50_432
BLOCK_IDS = 1 << 20
# Pairs found less often are not worth a rule.
LEAST = 12
PER_ROUND = 4096
WORD_CACHE = 1_200_000
# So few texts are encoded at a time that their pieces stay in the processor's cache.
TEXTS = 8


def _pieces(letters: str, numbers: str, space: str) -> str:
    # The pieces of a byte-level vocabulary. Contractions begin with a mark, so
    # letters may come first.
    return (
        rf" ?[{letters}]+|'s|'t|'re|'ve|'m|'ll|'d| ?[{numbers}]+| ?[^{space}{letters}{numbers}]+"
        rf"|[{space}]+(?![^{space}])|[{space}]+"
    )


_PIECE = regex.compile(_pieces(r"\p{L}", r"\p{N}", SPACE))
# The same for texts of Latin-1 letters alone, with the faster library.
_LATIN_PIECE = re.compile(_pieces(LATIN_LETTERS, LATIN_NUMBERS, LATIN_SPACE))


def split_pieces(text: str) -> list[str]:
    return (_LATIN_PIECE if is_latin(text) else _PIECE).findall(text)


def piece_merger(path: str) -> tiktoken.Encoding | None:
    """Merges single pieces by the vocabulary file at `path`, as the tokenizers library does but with
    less work around each. None if the file's merges are not what its ids alone can say."""
    with open(path, encoding="utf-8") as file:
        model = json.load(file)["model"]
    plain = not any(
        model.get(name) for name in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")
    )
    bytes_of = {letter: byte for byte, letter in enumerate(byte_letters())}
    vocab: dict[str, int] = model["vocab"]
    merges = [tuple(pair.split(" ")) if isinstance(pair, str) else tuple(pair) for pair in model["merges"]]
    made = [vocab.get(left + right, -1) for left, right in merges]
    # Ranks are ids: these must rise with the merges, and every longer token be made by one.
    rising = all(a < b for a, b in pairwise([-1, *made]))
    inner = {token: number for token, number in vocab.items() if bytes_of.keys() >= set(token)}
    whole = len(inner) == 256 + len(made) and bytes_of.keys() <= inner.keys()
    if not (plain and rising and whole):
        return None
    ranks = {bytes(bytes_of[letter] for letter in token): number for token, number in inner.items()}
    # The pattern takes all of what it is given as one piece.
    return tiktoken.Encoding("pieces", pat_str=r"(?s:.+)", mergeable_ranks=ranks, special_tokens={})


class Encoder:
    """The tokenizers library's encoding of a byte-level vocabulary, each distinct piece encoded once.

    Texts that hold a special token, or letters newer than `regex` knows, are encoded by the
    library itself; of others the pieces are merged by `piece_merger`.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.special = [token.content for token in self.library.get_added_tokens_decoder().values()]
        self.merger = piece_merger(path)
        self.pieces: dict[str, bytes] = {}

    def _ids(self, batch: list[str]) -> list[bytes]:
        found = self.library.encode_batch_fast(batch, add_special_tokens=False)
        return [np.array(one.ids, "<u2").tobytes() for one in found]

    def _merged(self, pieces: list[str]) -> list[bytes]:
        """The ids of each piece."""
        if self.merger is None:
            return self._ids(pieces)
        found = list(map(self.merger.encode_ordinary, pieces))
        ends = list(accumulate((2 * len(ids) for ids in found), initial=0))
        flat = np.fromiter(chain.from_iterable(found), "<u2", ends[-1] // 2).tobytes()
        return [flat[begin:end] for begin, end in pairwise(ends)]

    def encode(self, batch: list[str]) -> list[bytes]:
        """The ids of each text, two bytes each."""
        few = (self._encode(batch[at : at + TEXTS]) for at in range(0, len(batch), TEXTS))
        return list(chain.from_iterable(few))

    def _encode(self, batch: list[str]) -> list[bytes]:
        get = self.pieces.get
        out: list[bytes | None] = []
        open_texts = []
        for place, text in enumerate(batch):
            if any(special in text for special in self.special):
                out += self._ids([text])
                continue
            pieces = split_pieces(text)
            held = list(map(get, pieces))
            if None in held:
                open_texts.append((place, text, pieces, held))
                out.append(None)
            else:
                out.append(b"".join(held))
        names = list({p for _, _, pieces, held in open_texts for p, ids in zip(pieces, held, strict=True) if ids is None})
        # Letters newer than `regex` knows are left to the library, with their whole text.
        odd = {piece for piece in names if not piece.isascii() and UNASSIGNED.search(piece)}
        fresh = dict(zip(names, self._merged(names), strict=True))
        for place, text, pieces, held in open_texts:
            if odd and not odd.isdisjoint(pieces):
                out[place] = self._ids([text])[0]
            else:
                filled = [fresh[p] if ids is None else ids for p, ids in zip(pieces, held, strict=True)]
                out[place] = b"".join(filled)
        # Full, the table stays as it is: what came first is what comes often.
        if len(self.pieces) < WORD_CACHE:
            self.pieces.update((p, ids) for p, ids in fresh.items() if len(p) <= 64 and p not in odd)
        return out


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


class Grammar(NamedTuple):
    symbols: np.ndarray
    rules: np.ndarray
    lengths: np.ndarray
    rounds: np.ndarray

    @classmethod
    def of(cls, ids: np.ndarray, rounds: int | None = None, least: int = LEAST) -> Grammar:
        """Replace frequent pairs, the most frequent of the sequence left, round after round.

        Each round takes up to PER_ROUND pairs at once; where two of them overlap the left
        one is taken. Without `rounds` it ends when no pair is found `least` times or all
        symbols are used.
        """
        symbols = ids.astype(np.uint16)
        rules, lengths, made = [], np.ones(1 << 16, np.int64), []
        count, fresh = 0, 0
        while rounds is None or len(made) < rounds:
            room = min(PER_ROUND, (1 << 16) - BASE - count)
            if len(symbols) < 2 or room <= 0:
                break
            # Unless a round leaves frequent pairs over, the next one's all hold what it made: other
            # pairs were too rare before and can only have become rarer.
            new = symbols >= fresh
            places = np.flatnonzero(new[:-1] | new[1:])
            pairs = symbols[places].astype(np.uint32) << np.uint32(16) | symbols[places + 1]
            ranked = np.sort(pairs)
            if not len(ranked):
                break
            first = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
            often = np.diff(np.append(first, len(ranked)))
            good = np.flatnonzero(often >= least)
            if not len(good):
                break
            fresh = BASE + count
            if len(good) > room:
                good = good[np.argpartition(-often[good], room - 1)[:room]]
                fresh = 0
            chosen = np.sort(ranked[first[good]])
            hits, which = _places(pairs, chosen)
            at = places[hits]
            # In a run of overlapping places, every other one.
            breaks = np.concatenate([[True], np.diff(at) != 1])
            run_start = np.maximum.accumulate(np.where(breaks, np.arange(len(at)), 0))
            taken = (np.arange(len(at)) - run_start) % 2 == 0
            at, which = at[taken], which[taken]
            symbols = symbols.copy()
            symbols[at] = (BASE + count + which).astype(np.uint16)
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            symbols = symbols[keep]
            left, right = (chosen >> np.uint32(16)).astype(np.int64), (chosen & np.uint32(0xFFFF)).astype(np.int64)
            lengths[BASE + count : BASE + count + len(chosen)] = lengths[left] + lengths[right]
            rules.append(np.stack([left, right], 1))
            made.append(len(chosen))
            count += len(chosen)
        flat = np.concatenate(rules) if rules else np.zeros((0, 2), np.int64)
        return cls(symbols, flat.astype(np.uint16), lengths[BASE : BASE + count], np.array(made, np.int64))

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        """The ids that some of the symbols stand for, from a table of what each nonterminal among them does."""
        symbols = symbols.astype(np.int64)
        used = np.unique(symbols[symbols >= BASE])
        sizes = np.ones(1 << 16, np.int64)
        sizes[used] = self.lengths[used - BASE]
        # An id stands for itself; the nonterminals' ids follow.
        table = np.concatenate([np.arange(BASE), self._undone(used)])
        starts = np.arange(1 << 16)
        starts[used] = BASE + np.cumsum(sizes[used]) - sizes[used]
        lengths = sizes[symbols]
        ends = np.cumsum(lengths)
        return table[np.repeat(starts[symbols] - (ends - lengths), lengths) + np.arange(lengths.sum())]

    def _undone(self, symbols: np.ndarray) -> np.ndarray:
        """The ids that symbols stand for: the rounds undone, the last one first."""
        out = symbols
        end = BASE + len(self.rules)
        rules = self.rules.astype(np.int64)
        for made in self.rounds[::-1]:
            begin = end - made
            # Later nonterminals are gone already.
            double = out >= begin
            place = np.arange(len(out)) + np.concatenate([[0], np.cumsum(double)[:-1]]) if len(out) else out
            grown = np.empty(len(out) + int(double.sum()), np.int64)
            grown[place] = np.where(double, 0, out)
            parts = rules[out[double] - BASE]
            grown[place[double]], grown[place[double] + 1] = parts[:, 0], parts[:, 1]
            out, end = grown, begin
        return out

    def read(self, start: int, stop: int) -> np.ndarray:
        """The ids from `start` to before `stop`, expanding only the symbols they lie in."""
        sizes = np.where(self.symbols >= BASE, np.append(self.lengths, 1)[np.maximum(self.symbols.astype(np.int64) - BASE, 0)], 1)
        ends = np.cumsum(sizes)
        first = int(np.searchsorted(ends, start, "right"))
        last = int(np.searchsorted(ends, stop, "left")) + 1
        begin = int(ends[first - 1]) if first else 0
        return self.expand(self.symbols[first:last])[start - begin : stop - begin]


def _places(pairs: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where `pairs` holds one of the sorted `chosen`, and which."""
    first = np.full(1 << 18, -1, np.int32)
    first[_bucket(chosen)] = np.arange(len(chosen))
    which = first[_bucket(pairs)]
    at = np.flatnonzero(which >= 0)
    which, found = which[at], pairs[at]
    # Where several share a bucket, it may be another one.
    other = np.flatnonzero(chosen[which] != found)
    which[other] = np.minimum(np.searchsorted(chosen, found[other]), len(chosen) - 1)
    real = chosen[which] == found
    return at[real], which[real].astype(np.int64)


def _bucket(pairs: np.ndarray) -> np.ndarray:
    return (pairs * np.uint32(0x9E3779B1)) >> np.uint32(14)


_LAYOUT = (
    "shard long, block long, n_ids long, null_ids long, doc_ids binary, counts binary, "
    "symbols binary, rules binary, lengths binary, rounds binary"
)
_NAMES = [field.split()[0] for field in _LAYOUT.split(", ")]


def write(docs: DataFrame, vocabulary: str, path: str, block_ids: int = BLOCK_IDS) -> None:
    """Write the ids of every text of `docs`, END_ID after each, in ascending doc_id order to `path`.

    Rows are split by ranges of doc_id over the tasks and sorted within each. Null doc_ids
    come first; rows of the same doc_id are written each. A null or empty text is END_ID alone.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    shards = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartitionByRange(shards, "doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = encoder(vocabulary)
        shard, block = TaskContext.get().partitionId(), 0
        doc_ids: list[int | None] = []
        held: list[bytes] = []
        size = 0

        def packed() -> pa.RecordBatch:
            end = np.array([END_ID], "<u2").tobytes()
            ids = np.frombuffer(b"".join(part + end for part in held), "<u2")
            grammar = Grammar.of(ids)
            values = [
                shard,
                block,
                len(ids),
                sum(doc_id is None for doc_id in doc_ids),
                np.array([doc_id or 0 for doc_id in doc_ids], "<i8").tobytes(),
                np.array([len(part) // 2 + 1 for part in held], "<u4").tobytes(),
                grammar.symbols.astype("<u2").tobytes(),
                grammar.rules.astype("<u2").tobytes(),
                grammar.lengths.astype("<u4").tobytes(),
                grammar.rounds.astype("<u4").tobytes(),
            ]
            kinds = [pa.int64()] * 4 + [pa.binary()] * 6
            arrays = [pa.array([value], kind) for value, kind in zip(values, kinds, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, _NAMES)

        for batch in batches:
            names, contents = batch.column("doc_id").to_pylist(), texts(batch.column("text"))
            for at in range(0, len(names), 256):
                doc_ids += names[at : at + 256]
                held += library.encode(contents[at : at + 256])
                size += sum(map(len, held[-len(names[at : at + 256]) :])) // 2
                if size >= block_ids:
                    yield packed()
                    doc_ids, held, size, block = [], [], 0, block + 1
        if held:
            yield packed()

    ordered.mapInArrow(run, _LAYOUT).write.parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids (unsigned 32-bit little-endian) of every document in `path`.

    `start` counts the ids of all documents before it: those of earlier shards, of earlier
    blocks and of its own block. Only totals of blocks are added up, and of shards in one task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                grammar = Grammar(
                    np.frombuffer(row["symbols"], "<u2"),
                    np.frombuffer(row["rules"], "<u2").reshape(-1, 2),
                    np.frombuffer(row["lengths"], "<u4").astype(np.int64),
                    np.frombuffer(row["rounds"], "<u4").astype(np.int64),
                )
                counts = np.frombuffer(row["counts"], "<u4").astype(np.int64)
                ends = np.concatenate([[0], np.cumsum(counts)])
                ids = grammar.expand(grammar.symbols).astype("<u4")
                nulls = np.arange(len(counts)) < row["null_ids"]
                flat = pa.BinaryArray.from_buffers(
                    pa.binary(), len(counts), [None, pa.py_buffer((4 * ends).astype(np.int32)), pa.py_buffer(ids)]
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.frombuffer(row["doc_ids"], "<i8"), pa.int64(), mask=nulls),
                        pa.array(ends[:-1] + row["start"], pa.int64()),
                        pa.array(counts, pa.int64()),
                        flat,
                    ],
                    ["doc_id", "start", "n_tokens", "ids"],
                )

    files = spark.read.schema(_LAYOUT).parquet(path)
    blocks = files.select("shard", "block", "n_ids")
    shards = blocks.groupBy("shard").agg(F.sum("n_ids").alias("_ids"))
    before = F.sum("_ids").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    shards = shards.select("shard", F.coalesce(before, F.lit(0)).alias("_shard_start"))
    inside = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.withColumn("_block_start", F.coalesce(F.sum("n_ids").over(inside), F.lit(0))).join(shards, "shard")
    starts = starts.select("shard", "block", (F.col("_shard_start") + F.col("_block_start")).alias("start"))
    # A few bytes for each block, so mostly small enough to go to all tasks; else blocks are
    # shuffled as they are stored, not the ids they stand for.
    rows = files.join(stored(starts, "block_starts"), ["shard", "block"])
    return rows.mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")


def digests(read_back: DataFrame) -> DataFrame:
    return read_back.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
