"""Source divergence audit: how far the word use of each source lies from the others of its language.

A language's terms that enough documents hold are sorted, and runs of them become minimal
acyclic transducers (`transducer.py`) that give each term its place in that order. All texts
are then streamed through these, and occurrences are counted by source and ordinal, so that
no term is hashed, compared or shuffled as text again; ordinals also settle ties. Smoothed
shares and their distances are whole numbers throughout.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from meterline.llm import words as W
from meterline.llm.common import chunks, stored, utf8
from meterline.llm.transducer import Arcs, Transducer, build

MIN_DOCS = 10
RANKS = 10
# A share of one is this large. Squares of differences of two shares fit a long.
SCALE = 1_000_000_000
# One transducer holds so many terms, or so many bytes of terms, at most.
SHARD_TERMS, SHARD_BYTES = 1 << 16, 4 << 20
# Transducers that a task holds at once; beyond that, texts are streamed once for each such part.
HELD_BYTES = 32 << 20
# A task adds up so many rows before it passes them on.
PENDING = 1 << 19
# Shares are compared so many terms and so many sources at a time.
BLOCK_TERMS, TILE_SOURCES = 1024, 128

# Everything in ASCII but letters lies between terms.
_BETWEEN = np.ones(256, bool)
_BETWEEN[65:91] = _BETWEEN[97:123] = _BETWEEN[128:] = False


class _Sums:
    """Rows with a count `n`, added up by the other columns before they leave the task."""

    def __init__(self) -> None:
        self._parts: list[pa.Table] = []
        self._rows = 0

    def add(self, rows: pa.Table) -> Iterator[pa.RecordBatch]:
        self._parts.append(rows)
        self._rows += rows.num_rows
        if self._rows > PENDING:
            summed = self._summed()
            # Rows that do not fall together are not kept for longer.
            if summed.num_rows > PENDING // 2:
                yield from summed.to_batches(max_chunksize=1 << 16)
                summed = summed.slice(0, 0)
            self._parts, self._rows = [summed], summed.num_rows

    def rest(self) -> Iterator[pa.RecordBatch]:
        if self._rows:
            yield from self._summed().to_batches(max_chunksize=1 << 16)

    def _summed(self) -> pa.Table:
        rows = pa.concat_tables(self._parts)
        keys = [name for name in rows.column_names if name != "n"]
        return rows.group_by(keys).aggregate([("n", "sum")]).rename_columns([*keys, "n"]).select(rows.column_names)


def _terms(part: pa.RecordBatch) -> tuple[np.ndarray, W.Words]:
    """The bytes of the texts, A to Z lowered, and where their terms lie."""
    data, offsets = utf8(part.column("text"))
    return W.lower(data), W.split(data, offsets, _BETWEEN)


def _codes(*columns: pa.Array) -> tuple[np.ndarray, list[pa.Array]]:
    """A number for each row by the values of `columns`, and the columns' values for each number."""
    coded = [column.dictionary_encode() for column in columns]
    number = np.zeros(len(columns[0]), np.int64)
    for one in coded:
        number = number * max(1, len(one.dictionary)) + one.indices.to_numpy(zero_copy_only=False)
    distinct, number = np.unique(number, return_inverse=True)
    first = np.zeros(len(distinct), np.int64)
    first[number[::-1]] = np.arange(len(number))[::-1]
    return number, [column.take(pa.array(first)) for column in columns]


def _counted(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(codes, return_counts=True)


def kept_terms(rows: DataFrame, min_docs: int) -> DataFrame:
    """lang and term: the terms that at least `min_docs` documents of a language hold.

    `rows` has doc_id, lang and text. Tasks count the documents of each term themselves. Only
    what stands under one doc_id in several rows is counted once by Spark; a null one is a doc_id.
    """
    keys = rows.groupBy("lang", "doc_id").agg(F.count(F.lit(1)).alias("_rows")).filter("_rows > 1")
    again = stored(keys.select(F.col("lang").alias("_lang"), F.col("doc_id").alias("_id")), "repeated_ids")
    same = (F.col("lang") == F.col("_lang")) & F.col("doc_id").eqNullSafe(F.col("_id"))
    marked = rows.join(again, same, "left").select("lang", "text", "doc_id", F.col("_lang").isNotNull().alias("again"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = _Sums()
        for batch in batches:
            for part in chunks(batch):
                data, words = _terms(part)
                if not len(words.starts):
                    continue
                ends = np.concatenate([[0], np.cumsum(words.ends - words.starts)])
                packed = pa.py_buffer(data[~_BETWEEN[data]])
                held = pa.StringArray.from_buffers(len(words.starts), pa.py_buffer(ends.astype(np.int32)), packed)
                coded = held.dictionary_encode()
                size = len(coded.dictionary)
                pairs = np.unique(words.text_of_word() * size + coded.indices.to_numpy())
                text, term = pairs // size, pairs % size
                often = part.column("again").to_numpy(zero_copy_only=False)[text]
                lang, (langs,) = _codes(part.column("lang"))
                found, n = _counted(lang[text[~often]] * size + term[~often])
                columns = [langs.take(pa.array(found // size)), coded.dictionary.take(pa.array(found % size))]
                columns += [pa.nulls(len(found), pa.int64()), pa.array(np.zeros(len(found), bool)), pa.array(n)]
                names = ["lang", "term", "doc_id", "again", "n"]
                yield from sums.add(pa.table(columns, names))
                if often.any():
                    text, term = text[often], term[often]
                    columns = [part.column("lang").take(pa.array(text)), coded.dictionary.take(pa.array(term))]
                    columns += [part.column("doc_id").take(pa.array(text)), pa.array(np.ones(len(text), bool))]
                    yield from sums.add(pa.table([*columns, pa.array(np.ones(len(text), np.int64))], names))
        yield from sums.rest()

    counts = marked.mapInArrow(run, "lang string, term string, doc_id long, again boolean, n long")
    once = counts.groupBy("lang", "term", "doc_id", "again").agg(F.sum("n").alias("n"))
    docs = once.groupBy("lang", "term").agg(F.sum(F.when(F.col("again"), 1).otherwise(F.col("n"))).alias("docs"))
    return docs.filter(F.col("docs") >= min_docs).select("lang", "term")


def vocabulary(terms: DataFrame, shard_terms: int = SHARD_TERMS) -> DataFrame:
    """shard, lang, place, term and arcs of the kept terms, in shards that ascend with lang and term.

    A row for each term tells its place in its shard. A row for each shard has the number of
    its terms as place, its first term, and its transducer as arcs.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Ranges ascend with the partitions, so shards numbered like this do too.
        number = TaskContext.get().partitionId() << 32
        lang, held, size = None, [], 0

        def close() -> pa.RecordBatch:
            count = len(held) + 1
            columns = [pa.array([number] * count, pa.int64()), pa.array([lang] * count, pa.string())]
            columns += [pa.array(range(count), pa.int64()), pa.array([*held, held[0]], pa.binary())]
            columns += [pa.array([*[None] * len(held), build(held).dump()], pa.binary())]
            return pa.RecordBatch.from_arrays(columns, ["shard", "lang", "place", "term", "arcs"])

        for batch in batches:
            for own, term in zip(batch.column("lang").to_pylist(), batch.column("term").to_pylist(), strict=True):
                if held and (own != lang or len(held) == shard_terms or size > SHARD_BYTES):
                    yield close()
                    number, held, size = number + 1, [], 0
                lang = own
                held.append(term)
                size += len(term)
        if held:
            yield close()

    # Bytes have the order of Spark's text.
    named = terms.select("lang", F.col("term").cast("binary").alias("term"))
    ranged = named.repartitionByRange("lang", "term").sortWithinPartitions("lang", "term")
    return ranged.mapInArrow(run, "shard long, lang string, place long, term binary, arcs binary")


def _heads(terms: list[bytes]) -> np.ndarray:
    """The first eight bytes of each term as a number."""
    return np.array([int.from_bytes(term[:8].ljust(8, b"\0"), "big") for term in terms], np.uint64)


def _head_of_terms(data: np.ndarray, words: W.Words) -> np.ndarray:
    heads = np.zeros(len(words.starts), np.uint64)
    for place in range(8):
        at = words.starts + place
        inside = at < words.ends
        byte = data[np.where(inside, at, 0)].astype(np.uint64)
        heads |= np.where(inside, byte, W.U(0)) << W.U(56 - 8 * place)
    return heads


class _Lookup:
    """The shards of one part of the vocabulary by language, with the ordinal of each one's first term."""

    def __init__(self, shards: list[tuple[str, int, bytes, bytes]]):
        self._of: dict[str, tuple[np.ndarray, list[tuple[int, Transducer]]]] = {}
        for lang in {shard[0] for shard in shards}:
            own = [shard for shard in shards if shard[0] == lang]
            self._of[lang] = _heads([shard[2] for shard in own]), [(base, Transducer(Arcs.load(arcs))) for _, base, _, arcs in own]

    def ordinals(self, data: np.ndarray, words: W.Words, langs: list[str], lang: np.ndarray) -> np.ndarray:
        """The ordinal of each term in the terms of its text's language, or -1."""
        result = np.full(len(words.starts), -1, np.int64)
        for code, name in enumerate(langs):
            if name not in self._of:
                continue
            heads, shards = self._of[name]
            own = np.flatnonzero(lang == code)
            of_own = words._replace(starts=words.starts[own], ends=words.ends[own])
            if len(shards) == 1:
                low = high = np.zeros(len(own), np.int64)
            else:
                # A term lies in a shard whose first term has no larger head; equal heads leave several.
                head = _head_of_terms(data, of_own)
                low = np.maximum(np.searchsorted(heads, head, "left") - 1, 0)
                high = np.searchsorted(heads, head, "right") - 1
            for shard, (base, transducer) in enumerate(shards):
                asked = np.flatnonzero((low <= shard) & (shard <= high) & (result[own] < 0))
                if len(asked):
                    found = transducer.ordinals(data, of_own.starts[asked], of_own.ends[asked])
                    result[own[asked]] = np.where(found >= 0, found + base, -1)
        return result


def _recount(rows: DataFrame, shards: list[tuple[str, int, bytes, bytes]]) -> DataFrame:
    """lang, source, ordinal and n: the occurrences of the terms of `shards`, added up by task."""
    shared = rows.sparkSession.sparkContext.broadcast(shards)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup, sums = _Lookup(shared.value), _Sums()
        for batch in batches:
            for part in chunks(batch):
                data, words = _terms(part)
                if not len(words.starts):
                    continue
                text = words.text_of_word()
                lang, (langs,) = _codes(part.column("lang"))
                group, (of_lang, of_source) = _codes(part.column("lang"), part.column("source"))
                ordinals = lookup.ordinals(data, words, langs.to_pylist(), lang[text])
                known = np.flatnonzero(ordinals >= 0)
                if not len(known):
                    continue
                size = int(ordinals.max()) + 1
                found, n = _counted(group[text[known]] * size + ordinals[known])
                at = pa.array(found // size)
                columns = [of_lang.take(at), of_source.take(at), pa.array(found % size), pa.array(n)]
                yield from sums.add(pa.table(columns, ["lang", "source", "ordinal", "n"]))
        yield from sums.rest()

    return rows.mapInArrow(run, "lang string, source string, ordinal long, n long")


def recount(rows: DataFrame, vocabulary: DataFrame, held_bytes: int = HELD_BYTES) -> tuple[DataFrame, DataFrame]:
    """Occurrences (lang, source, ordinal, n) of all terms of the stored `vocabulary`, and the shards (shard, lang, base, terms).

    What the driver sees is one row for each 2^16 terms, and transducers of `held_bytes` at a
    time, which it sends to the tasks; a vocabulary beyond that takes one pass over the texts
    for each such part.
    """
    spark = rows.sparkSession
    arcs = vocabulary.filter("arcs IS NOT NULL")
    known = arcs.select("shard", "lang", F.col("place").alias("terms"), F.octet_length("arcs").alias("bytes")).orderBy("shard")
    bases, parts, size, before = {}, [], 0, {}
    for shard, lang, terms, own in known.collect():
        if not parts or size + own > held_bytes:
            parts.append([])
            size = 0
        parts[-1].append(shard)
        size += own
        bases[shard] = (shard, lang, before.get(lang, 0), terms)
        before[lang] = before.get(lang, 0) + terms
    counts = []
    for part in parts:
        held = arcs.filter(F.col("shard").between(part[0], part[-1])).orderBy("shard").collect()
        shards = [(row["lang"], bases[row["shard"]][2], bytes(row["term"]), bytes(row["arcs"])) for row in held]
        counted = _recount(rows, shards).groupBy("lang", "source", "ordinal").agg(F.sum("n").alias("n"))
        counts.append(stored(counted, "term_counts"))
    empty = spark.createDataFrame([], "lang string, source string, ordinal long, n long")
    shards = spark.createDataFrame(list(bases.values()), "shard long, lang string, base long, terms long")
    return reduce(DataFrame.unionByName, counts) if counts else empty, shards


def _share(n: str) -> Column:
    """1 + floor(SCALE * (n + 2) / (total + 2 * n_terms)), in decimals that hold any count; null without terms."""
    return F.expr(f"1 + ((CAST({n} AS DECIMAL(20,0)) + 2) * {SCALE}) div nullif(total + 2 * n_terms, 0)")


def _pair_values(met: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, source, item and value for all ordered pairs of different sources of a language.

    `met` has the share p of each term in the sources that hold it, `groups` n_terms, n_sources
    and p0, a source's share of the terms it does not hold. Blocks of terms go to tasks as
    matrices of terms and sources, one tile of sources against another, so that a task's
    memory depends on the number of neither.
    """
    tiles = F.ceil(F.col("n_sources") / F.lit(TILE_SOURCES)).cast("int")
    tiled = groups.withColumn("tiles", tiles).withColumn("tile", F.pmod(F.xxhash64("source"), F.col("tiles")).cast("int"))
    tiled = tiled.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    place = [F.least("tile", "other").alias("a"), F.greatest("tile", "other").alias("b")]
    tiled = tiled.select("lang", "source", "tile", "n_terms", "p0", *place)
    keys = ["lang", "block", "a", "b", "source", "tile", "n_terms"]
    blocks = F.sequence(F.lit(0).cast("long"), F.greatest(F.ceil(F.col("n_terms") / F.lit(BLOCK_TERMS)), F.lit(1)) - 1)
    unmet = tiled.withColumn("block", F.explode(blocks))
    unmet = unmet.select(*keys, F.lit(-1).cast("long").alias("ordinal"), F.coalesce("p0", F.lit(0)).alias("p"))
    met = met.select("lang", "source", "ordinal", "p").join(tiled.drop("p0"), ["lang", "source"])
    met = met.withColumn("block", F.floor(F.col("ordinal") / F.lit(BLOCK_TERMS))).select(*keys, "ordinal", "p")

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        low = int(key[1]) * BLOCK_TERMS
        ordinal, p = rows["ordinal"].to_numpy(np.int64), rows["p"].to_numpy(np.int64)
        first = ordinal < 0
        # One row of each source says its share of the terms it does not hold.
        names, tile, base = rows["source"][first].to_numpy(), rows["tile"][first].to_numpy(), p[first]
        column = rows["source"].map({name: place for place, name in enumerate(names)}).to_numpy(np.int64)
        height = max(0, min(BLOCK_TERMS, int(rows["n_terms"].iloc[0]) - low))
        shares = np.repeat(base[None, :], height, 0)
        shares[ordinal[~first] - low, column[~first]] = p[~first]
        values = np.zeros((len(names), len(names)), np.int64)
        for one in range(len(names)):
            own = shares[:, one : one + 1]
            values[one] = ((own - shares) ** 2 // (own + shares)).sum(0)
        # Two sources of one tile also meet where that tile meets others.
        wanted = ~np.eye(len(names), dtype=bool) & ((tile[:, None] != tile[None, :]) | (key[2] == key[3]))
        left, right = np.nonzero(wanted)
        return pd.DataFrame({"lang": key[0], "source": names[left], "item": names[right], "value": values[left, right]})

    rows = met.unionByName(unmet).groupBy("lang", "block", "a", "b")
    values = rows.applyInPandas(run, "lang string, source string, item string, value long")
    return values.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def audit(
    docs: DataFrame,
    min_docs: int = MIN_DOCS,
    ranks: int = RANKS,
    shard_terms: int = SHARD_TERMS,
    held_bytes: int = HELD_BYTES,
) -> DataFrame:
    """lang, source, part, item, value and rank: how each source of a language differs from the others.

    Terms are runs of letters and of characters beyond ASCII, A to Z lowered. A language
    keeps the terms that at least `min_docs` of its documents hold; each source, and the
    language, gives each of them the share p = 1 + floor(10^9 (n + 2) / (N + 2 V)), of n
    occurrences there, N of all V kept terms. Two shares p and q lie floor((p - q)^2 / (p + q))
    apart. Part `pair` has every other source as item, and the sum over all kept terms (0
    without any); part `term` has the `ranks` terms that stand out most against the language.
    Larger values come first, and equal ones by their items' bytes.

    `docs` has doc_id, text, lang and source; null texts, languages and sources are empty ones,
    which are a language and a source like others. Rows of one doc_id are one document when
    terms are kept, also those of a null doc_id, and every row's occurrences are counted. Other
    columns are not read. A source without kept terms has its `pair` rows; a language of one
    source has none. An empty table gives no rows.
    """
    columns = [F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name) for name in ("lang", "source", "text")]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *columns)
    terms = stored(kept_terms(rows, min_docs), "kept_terms")
    words = stored(vocabulary(terms, shard_terms), "vocabulary")
    counts, shards = recount(rows, words, held_bytes)

    sizes = shards.groupBy("lang").agg(F.sum("terms").alias("n_terms"))
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    occurring = stored(rows.select("lang", "source").distinct(), "groups")
    sources = occurring.groupBy("lang").agg(F.count(F.lit(1)).alias("n_sources"))
    groups = occurring.join(sources, "lang").join(sizes, "lang", "left").join(totals, ["lang", "source"], "left")
    groups = stored(groups.fillna(0, ["n_terms", "total"]).withColumn("p0", _share("0")), "group_shares")
    met = counts.join(groups, ["lang", "source"]).select("lang", "source", "ordinal", _share("n").alias("p"))

    pair = _pair_values(met, groups)

    whole = groups.groupBy("lang", "n_terms").agg(F.sum("total").alias("total"))
    of_lang = counts.groupBy("lang", "ordinal").agg(F.sum("n").alias("n")).join(whole, "lang")
    term = met.join(of_lang.select("lang", "ordinal", _share("n").alias("q")), ["lang", "ordinal"]).filter("p > q")
    term = term.selectExpr("lang", "source", "ordinal", "((p - q) * (p - q)) div (p + q) AS value")
    # Ordinals have the order of the terms, so only the terms shown are looked up.
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "ordinal")
    term = term.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= ranks)
    named = words.filter("arcs IS NULL").join(F.broadcast(shards.select("shard", "base")), "shard")
    named = named.select("lang", (F.col("base") + F.col("place")).alias("ordinal"), F.col("term").cast("string").alias("item"))
    term = term.join(named, ["lang", "ordinal"]).withColumn("part", F.lit("term"))

    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pair = pair.withColumn("rank", F.row_number().over(order)).withColumn("part", F.lit("pair"))
    shown = ["lang", "source", "part", "item", "value", "rank"]
    return pair.select(*shown).unionByName(term.select(*shown))
