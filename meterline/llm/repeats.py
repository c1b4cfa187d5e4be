"""Substring dedup: repeats of many words across documents, by prefix-partitioned suffix trees.

Suffixes that share a prefix share a subtree, so trees are built apart, one per prefix:

1. Every window of WINDOW words is filed under that run of PREFIX words in it, its prefix, whose
   hash is the least. Equal windows have equal least runs, so they meet.
   Neighbouring windows mostly share theirs, so there are some twenty times fewer prefixes
   than windows.
2. Prefixes that two documents hold keep their suffixes, with the words around them; all
   others can hold no repeat and are let go.
3. Suffixes meet by prefix. As many prefixes as fit into memory make one batch, whose suffixes
   are sorted; neighbours with WINDOW words in common lie under the same deep node. Each node's
   least doc_id says which of its windows are to go. A prefix with too many suffixes for one
   task is lengthened: to all its content first, so that copies come down to one suffix, then
   to each whole window, where all that is left of a tree is one node, found by aggregation.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.llm import words as W
from meterline.llm.common import chunks, stored, texts, utf8

WINDOW = 50
PREFIX = 8
# Suffixes of one prefix that a task takes together, and bytes of them sorted at a time.
TASK_SUFFIXES = 4096
BATCH_BYTES = 2 << 20
# Windows in a row that make one suffix, also where a text repeats a few words on and on.
ROW_WINDOWS = 1000
# Windows looked at together, within one long text too.
_SLICE = 1 << 22


def _running_least(values: np.ndarray, size: int) -> np.ndarray:
    """The least of each `size` neighbours, by the first of them."""
    width = 1
    while 2 * width <= size:
        values = np.minimum(values[:-width], values[width:])
        width *= 2
    rest = size - width
    return np.minimum(values[:-rest], values[rest:]) if rest else values


def anchors(data: np.ndarray, offsets: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
    """For each row of windows filed under one prefix: the prefix's hash, its text, the first window
    (as a word of the text) and how many there are."""
    words = W.split(data, offsets)
    runs = W.hash_runs(W.hash_words(data, words), PREFIX)
    inside = W.runs_inside(words, window)
    found = []
    for at in range(0, len(inside), _SLICE):
        size = min(_SLICE, len(inside) - at)
        least = _running_least(runs[at : at + size + window - PREFIX], window - PREFIX + 1)
        begin = np.flatnonzero(inside[at : at + size])
        if len(begin):
            value = least[begin]
            new = np.ones(len(begin), bool)
            new[1:] = (value[1:] != value[:-1]) | (begin[1:] != begin[:-1] + 1)
            into_row = np.arange(len(begin)) - np.maximum.accumulate(np.where(new, np.arange(len(begin)), 0))
            first = np.flatnonzero(into_row % ROW_WINDOWS == 0)
            found.append((value[first], at + begin[first], np.diff(np.append(first, len(begin)))))
    if not found:
        nothing = np.zeros(0, np.int64)
        return nothing, nothing, nothing, nothing
    prefix, begin, count = (np.concatenate(columns) for columns in zip(*found, strict=True))
    text = words.text_of_word()[begin]
    return prefix.view(np.int64), text, begin - words.bounds[text], count


def _prefixes(docs: DataFrame, window: int) -> DataFrame:
    """prefix, doc_id, text_hash, first and windows, a row for each filed run of windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch):
                prefix, text, first, count = anchors(*utf8(part.column("text")), window)
                at = pa.array(text)
                columns = [pa.array(prefix), part.column("doc_id").take(at), part.column("text_hash").take(at)]
                columns += [pa.array(first, pa.int32()), pa.array(count, pa.int32())]
                yield pa.RecordBatch.from_arrays(columns, ["prefix", "doc_id", "text_hash", "first", "windows"])

    layout = "prefix long, doc_id long, text_hash long, first int, windows int"
    return docs.filter("doc_id IS NOT NULL").mapInArrow(run, layout)


def _found_places(part: pa.RecordBatch) -> tuple[W.Words, np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """The words of a chunk, and for each of its listed suffixes the text, the first window, counted
    in words of the chunk, and the number of windows."""
    data, offsets = utf8(part.column("text"))
    words = W.split(data, offsets)
    listed = part.column("suffixes")
    counts = np.diff(listed.offsets.to_numpy())
    text = np.repeat(np.arange(part.num_rows), counts)
    flat = listed.flatten()
    first = flat.field("first").to_numpy().astype(np.int64) + words.bounds[text]
    return words, text, first, flat.field("windows").to_numpy().astype(np.int64), flat


def _suffixes(texts_with: DataFrame, window: int) -> DataFrame:
    """prefix, doc_id, text_hash, first, windows and content: the words that a run of windows covers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch):
                words, text, first, count, flat = _found_places(part)
                raw = utf8(part.column("text"))[0].tobytes()
                begin, end = words.starts[first], words.ends[first + count + window - 2]
                content = [raw[a:b] for a, b in zip(begin.tolist(), end.tolist(), strict=True)]
                at = pa.array(text)
                columns = [flat.field("prefix"), part.column("doc_id").take(at), part.column("text_hash").take(at)]
                columns += [flat.field("first"), flat.field("windows"), pa.array(content, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["prefix", "doc_id", "text_hash", "first", "windows", "content"])

    layout = "prefix long, doc_id long, text_hash long, first int, windows int, content binary"
    return texts_with.mapInArrow(run, layout)


def _windows(contents: DataFrame, window: int) -> DataFrame:
    """The windows of some contents, by two hashes of their words: prefixes as long as the window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = batch.column("content").cast(pa.string())
            batch = batch.drop_columns(["content"]).append_column("text", held)
            for part in chunks(batch):
                data, offsets = utf8(part.column("text"))
                words = W.split(data, offsets)
                row, begin = _windows_of(words, window)
                one, two = (W.hash_runs(W.hash_words(data, words, seed), window)[begin] for seed in (0, 1))
                at = pa.array(row)
                columns = [part.column(name).take(at) for name in ("content_one", "content_two", "least")]
                columns += [pa.array(begin - words.bounds[row], pa.int32())]
                columns += [pa.array(one.view(np.int64)), pa.array(two.view(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, ["content_one", "content_two", "least", "place", "one", "two"])

    return contents.mapInArrow(run, "content_one long, content_two long, least long, place int, one long, two long")


def _windows_of(words: W.Words, window: int) -> tuple[np.ndarray, np.ndarray]:
    """The text and the first word of all windows of texts that have one at least."""
    counts = np.diff(words.bounds) - window + 1
    ends = np.cumsum(counts)
    row = np.repeat(np.arange(len(counts)), counts)
    return row, np.arange(len(row)) + np.repeat(words.bounds[:-1] - (ends - counts), counts)


def _of_many(suffixes: DataFrame, window: int) -> DataFrame:
    """The windows to go among prefixes with very many suffixes: doc_id, text_hash, begin and end.

    Suffixes of the same content come down to the least doc_id that holds it. All others that
    hold it lose it whole, one row each; only for the first one are its windows looked up,
    among the windows of the other contents.
    """
    name = {"content_one": F.xxhash64("content"), "content_two": F.xxhash64(F.lit(1), "content")}
    key = list(name)
    named = suffixes.withColumns(name)
    runs = stored(named.select("doc_id", "text_hash", "first", "windows", *key), "runs")
    contents = named.groupBy(*key).agg(F.min("doc_id").alias("least"), F.first("content").alias("content"))
    contents = stored(contents, "contents")

    later = runs.join(contents.select(*key, "least"), key)
    begin, end = F.col("first").alias("begin"), (F.col("first") + F.col("windows") + (window - 1)).alias("end")
    spans = later.filter("doc_id > least").select("doc_id", "text_hash", begin, end)

    each = stored(_windows(contents, window), "windows")
    held_by = each.groupBy("one", "two").agg(F.min("least").alias("_least"), F.max("least").alias("_most"))
    held_by = stored(held_by.filter("_least < _most").select("one", "two", "_least"), "shared_windows")
    gone = each.join(held_by, ["one", "two"]).filter("least > _least").select(*key, "least", "place")
    gone = runs.join(gone, key).filter("doc_id = least")
    begin = F.col("first") + F.col("place")
    return spans.unionByName(gone.select("doc_id", "text_hash", begin.alias("begin"), (begin + window).alias("end")))


def _ranks(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Ranks of pairs of ranks."""
    return np.unique(left * (int(right.max(initial=0)) + 1) + right, return_inverse=True)[1]


def deep_nodes(hashes: np.ndarray, starts: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes at `starts` in the order of the suffix tree, and where its nodes of depth
    `window` begin in that order.

    Suffixes are ranked by their first PREFIX words, then by twice as many, and so on: each
    step goes as much deeper into the tree as the one before it has come. Suffixes of one rank
    at the depth of the window are the leaves under one node.
    """
    ranks = np.unique(W.hash_runs(hashes, PREFIX), return_inverse=True)[1]
    depth = PREFIX
    while depth < window:
        step = min(depth, window - depth)
        ranks = _ranks(ranks[:-step], ranks[step:])
        depth += step
    mine = ranks[starts]
    order = np.argsort(mine, kind="stable")
    common = mine[order]
    return order, np.flatnonzero(np.concatenate([[True], common[1:] != common[:-1]]))


def _repeated(batch: pa.Table, window: int) -> pa.RecordBatch:
    """Which windows of a batch of suffixes a smaller doc_id holds too: doc_id, text_hash, begin and
    end, in words, of each row of windows that follow each other."""
    data, offsets = utf8(batch.column("content").combine_chunks().cast(pa.string()))
    words = W.split(data, offsets)
    row, starts = _windows_of(words, window)
    order, nodes = deep_nodes(W.hash_words(data, words), starts, window)
    doc_ids = batch.column("doc_id").to_numpy()
    least = np.minimum.reduceat(doc_ids[row[order]], nodes)
    gone = np.zeros(len(starts), bool)
    gone[order] = np.repeat(least, np.diff(np.append(nodes, len(order)))) < doc_ids[row[order]]
    at = np.flatnonzero(gone)
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1] + 1) | (row[at[1:]] != row[at[:-1]])
    first = np.flatnonzero(new)
    length = np.diff(np.append(first, len(at))) if len(first) else first
    at, of = at[first], row[at[first]]
    begin = starts[at] - words.bounds[of] + batch.column("first").to_numpy()[of]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(doc_ids[of]),
            pa.array(batch.column("text_hash").to_numpy()[of]),
            pa.array(begin, pa.int32()),
            pa.array(begin + length + window - 1, pa.int32()),
        ],
        ["doc_id", "text_hash", "begin", "end"],
    )


def _trees(suffixes: DataFrame, window: int) -> DataFrame:
    """The windows to go, from trees of as many whole prefixes at a time as fit BATCH_BYTES."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            prefix = batch.column("prefix").to_numpy()
            # Where a prefix ends in this batch.
            cuts = [*(np.flatnonzero(prefix[1:] != prefix[:-1]) + 1).tolist(), len(prefix)]
            offsets = _offsets(batch.column("content"))
            sizes = offsets - offsets[0]
            if held and held[-1].column("prefix")[-1].as_py() != prefix[0] and size >= BATCH_BYTES:
                yield _repeated(pa.Table.from_batches(held), window)
                held, size = [], 0
            at = 0
            for cut in cuts[:-1]:
                if size + sizes[cut] - sizes[at] >= BATCH_BYTES:
                    held.append(batch.slice(at, cut - at))
                    yield _repeated(pa.Table.from_batches(held), window)
                    held, size, at = [], 0, cut
            held.append(batch.slice(at))
            size += sizes[-1] - sizes[at]
        if held:
            yield _repeated(pa.Table.from_batches(held), window)

    together = suffixes.repartition("prefix").sortWithinPartitions("prefix")
    return together.mapInArrow(run, "doc_id long, text_hash long, begin int, end int")


def _offsets(column: pa.BinaryArray) -> np.ndarray:
    return np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]


def repeated_spans(docs: DataFrame, window: int = WINDOW, task_suffixes: int = TASK_SUFFIXES) -> DataFrame:
    """doc_id, text_hash and spans: the word ranges of `docs` that windows cover whose words also
    start in a document with a smaller doc_id. `docs` has doc_id, text and text_hash."""
    filed = stored(_prefixes(docs, window), "prefixes")
    held_by = filed.groupBy("prefix").agg(
        F.min("doc_id").alias("_least"), F.max("doc_id").alias("_most"), F.count(F.lit(1)).alias("_suffixes")
    )
    shared = held_by.filter("_least < _most").select("prefix", (F.col("_suffixes") > task_suffixes).alias("_many"))
    shared = stored(shared, "shared_prefixes")

    def spans_of(many: bool) -> DataFrame:
        # Merged at every size, rather than sent to all tasks while it is small.
        mine = filed.join(shared.filter(F.col("_many") == many).hint("merge"), "prefix")
        listed = mine.groupBy("doc_id", "text_hash").agg(
            F.collect_list(F.struct("prefix", "first", "windows")).alias("suffixes")
        )
        listed = listed.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "suffixes")
        same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash"))
        texts_with = docs.join(listed, same).select("doc_id", "text", "text_hash", "suffixes")
        return (_of_many if many else _trees)(_suffixes(texts_with, window), window)

    spans = spans_of(False)
    if not shared.filter("_many").isEmpty():
        spans = spans.unionByName(spans_of(True))
    return spans.groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("begin", "end")).alias("spans"))


def drop_repeats(docs: DataFrame, window: int = WINDOW, task_suffixes: int = TASK_SUFFIXES) -> DataFrame:
    """doc_id, n_words, n_removed and kept_text (kept words joined by a space) of every row.

    Words are runs of anything but space and tab to carriage return. A word goes if a window of
    `window` words covers it whose words also start in a document with a smaller doc_id;
    windows are judged on the input. A null or empty text has no words. Rows with a null doc_id
    have no place in the order: they lose nothing and make nothing go. Repeated rows lose what
    each of them loses; a repeat within one document stays.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.xxhash64(F.col("text").cast("string")).alias("text_hash"),
    )
    spans = repeated_spans(rows, window, task_suffixes)
    spans = spans.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "spans")
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch):
                n_words, n_removed, kept = [], [], []
                for text, found in zip(texts(part.column("text")), part.column("spans").to_pylist(), strict=True):
                    words = text.encode().split()
                    n_words.append(len(words))
                    if found:
                        edges = np.zeros(len(words) + 1, np.int64)
                        np.add.at(edges, [s["begin"] for s in found], 1)
                        np.add.at(edges, [s["end"] for s in found], -1)
                        words = [words[i] for i in np.flatnonzero(np.cumsum(edges)[:-1] == 0)]
                    n_removed.append(n_words[-1] - len(words))
                    kept.append(b" ".join(words))
                columns = [part.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64())]
                columns.append(pa.array(kept, pa.binary()).cast(pa.string()))
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "n_removed", "kept_text"])

    joined = rows.join(spans, same, "left").select("doc_id", "text", "spans")
    return joined.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_text string")


def digests(dropped: DataFrame) -> DataFrame:
    return dropped.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))
