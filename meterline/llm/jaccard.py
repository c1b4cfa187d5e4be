"""N-gram Jaccard join: documents whose shingle sets overlap by a share, by T-occurrence search.

Two sets that overlap enough share so many shingles among the first few of each in a common
order that a search in the inverted lists of those finds them. The search counts in how many
lists of a document another one occurs. Following DivideSkip, short lists are merged with a
heap, long ones are not: how often a candidate can occur in the long ones is added to its
count as a bound, and only a candidate that can still reach the overlap is checked, its
shingles looked up in the document's. Candidates that short lists cannot give are found among
the documents that have many long lists, see `_long_list_links`.

Every distinct set is one vertex, whichever rows have it; a doc_id with several sets ties theirs.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import reduce
from itertools import groupby
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from meterline.llm import words as W
from meterline.llm.common import chunks, stored, utf8
from meterline.llm.components import components
from meterline.operators.numbering import assign_ids

SHINGLE = 5
PERCENT = 80
# A shingle that more classes than this hold, among their first ones, has a long list.
LONG_LIST = 32
# How many of a long list's documents its others are compared with first.
HEADS = 8
# How many of those that it meets most often a document is checked against in a round.
CHECKED = 2
ROUNDS = 8
# Bits that stand for a set, in words of 64.
PARITY_WORDS = 16


def shingle_sets(part: pa.RecordBatch, size: int) -> list[np.ndarray]:
    """The distinct shingle hashes of each text, ascending; a text of fewer words is one shingle."""
    data, offsets = utf8(part.column("text"))
    data = W.lower(data)
    words = W.split(data, offsets)
    hashes = W.hash_words(data, words)
    runs = W.hash_runs(hashes, size)
    sets = []
    for begin, end in zip(words.bounds[:-1].tolist(), words.bounds[1:].tolist(), strict=True):
        if end - begin >= size:
            sets.append(np.unique(runs[begin : end - size + 1]))
        else:
            sets.append(W.hash_runs(hashes[begin:end], end - begin) if end > begin else runs[:0])
    return sets


def least_overlap(size: int | np.ndarray, percent: int) -> int | np.ndarray:
    """How many shingles a set of `size` must share at least with any set that it links with."""
    return -(-size * percent // 100)


def _extra(size):
    """How many shingles more than needed to meet once a set of `size` lists; never falls with size."""
    return (size // 40) + 4


def listed(size: int | np.ndarray, percent: int) -> int | np.ndarray:
    """How many of its first shingles a set lists: two linked sets share more than `spare` of them."""
    return np.minimum(size, size - least_overlap(size, percent) + 1 + _extra(size))


def spare(size: Column, percent: int) -> Column:
    """`listed` without the shingles needed to meet once. Two linked sets x and y share at least one
    more listed shingle than the lesser of their spares."""
    overlap = F.ceil(size * percent / F.lit(100))
    return F.least(overlap - 1, F.floor(size / 40) + 4).cast("int")


def _lists(values: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, values)], dtype=np.int32)
    flat = np.concatenate(values) if values else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.view(np.int64)))


def _fingerprints(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, text_hash, n_shingles and 128 bits that name the set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch):
                sets = shingle_sets(part, size)
                names = [np.array([W.mix(s ^ W.U(salt)).sum(dtype=np.uint64) for s in sets], np.uint64) for salt in (1, 2)]
                columns = [part.column("doc_id"), part.column("text_hash"), pa.array(list(map(len, sets)), pa.int64())]
                columns += [pa.array(name.view(np.int64)) for name in names]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_hash", "n_shingles", "one", "two"])

    return docs.mapInArrow(run, "doc_id long, text_hash long, n_shingles long, one long, two long")


def parities(sets: list[np.ndarray]) -> np.ndarray:
    """For each set PARITY_WORDS * 64 bits: whether an odd number of its hashes falls on them.

    Two sets differ in at least as many hashes as bits.
    """
    bits = np.zeros((len(sets), PARITY_WORDS), np.uint64)
    hashes = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    word = (hashes >> W.U(6)) % W.U(PARITY_WORDS)
    np.bitwise_xor.at(bits, (np.repeat(np.arange(len(sets)), list(map(len, sets))), word), W.U(1) << (hashes & W.U(63)))
    return bits


def _sets(docs: DataFrame, size: int, percent: int | None) -> DataFrame:
    """doc, n, shingles and parity: all of a set, or its first ones and no parity if `percent` is given."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch):
                sets = shingle_sets(part, size)
                shown = [s if percent is None else s[: listed(len(s), percent)] for s in sets]
                bits = _lists(list(parities(sets))) if percent is None else pa.nulls(len(sets), pa.list_(pa.int64()))
                columns = [part.column("doc_id"), pa.array(list(map(len, sets)), pa.int32()), _lists(shown), bits]
                yield pa.RecordBatch.from_arrays(columns, ["doc", "n", "shingles", "parity"])

    return docs.mapInArrow(run, "doc long, n int, shingles array<long>, parity array<long>")


def _comparable(a: Column | str, b: Column | str, percent: int) -> Column:
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs (a, b) whose sets overlap enough."""
    left = sets.select(F.col("doc").alias("a"), F.col("shingles").alias("_left"))
    right = sets.select(F.col("doc").alias("b"), F.col("shingles").alias("_right"))
    both = F.size(F.array_intersect("_left", "_right"))
    all_ = F.size("_left") + F.size("_right") - both
    return pairs.select("a", "b").join(left, "a").join(right, "b").filter(both * 100 >= all_ * percent).select("a", "b")


def _short_list_candidates(postings: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of documents that short lists leave possible.

    A document gets its short lists, each at most LONG_LIST long, and merges them with a heap.
    """
    member = F.struct("doc", "n", "spare", "longs")
    lists = postings.groupBy("shingle").agg(F.sort_array(F.collect_list(member)).alias("members"))
    each = lists.select(F.explode("members").alias("me"), "members")
    smaller = F.filter(
        "members", lambda other: (other["doc"] < F.col("me.doc")) & _comparable(other["n"], F.col("me.n"), percent)
    )
    each = each.select("me", smaller.alias("others")).filter(F.size("others") > 0)
    mine = each.groupBy("me").agg(F.collect_list("others").alias("lists"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            me, lists = batch.column("me"), batch.column("lists")
            of_row, inner = lists.offsets.to_numpy(), lists.values
            of_list, others = inner.offsets.to_numpy(), inner.values
            names, spares, longs = (others.field(name).to_numpy() for name in ("doc", "spare", "longs"))
            own = zip(*[me.field(name).to_pylist() for name in ("doc", "spare", "longs")], strict=True)
            left, right = [], []
            for row, (doc, my_spare, my_longs) in enumerate(own):
                cuts = of_list[of_row[row] : of_row[row + 1] + 1].tolist()
                held = [names[begin:end].tolist() for begin, end in zip(cuts[:-1], cuts[1:], strict=True)]
                about = dict(
                    zip(
                        names[cuts[0] : cuts[-1]].tolist(),
                        zip(spares[cuts[0] : cuts[-1]].tolist(), longs[cuts[0] : cuts[-1]].tolist(), strict=True),
                        strict=True,
                    )
                )
                for other, met in groupby(heapq.merge(*held)):
                    spare_of, longs_of = about[other]
                    # What the long lists, which are not merged, can add at most.
                    if sum(1 for _ in met) + min(my_longs, longs_of) > min(my_spare, spare_of):
                        left.append(doc)
                        right.append(other)
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], ["a", "b"])

    return mine.mapInArrow(run, "a long, b long")


def _rarest(sets: DataFrame, percent: int) -> DataFrame:
    """shingle, doc, n and rank: the shingles of each set that it must share one of with a linked set, its
    rarest among these sets, and their places in that order. Those that no other set holds are
    counted in but left out."""
    full = sets.select("doc", F.size("shingles").alias("n"), F.explode("shingles").alias("shingle"))
    held_by = full.groupBy("shingle").agg(F.count(F.lit(1)).alias("_held")).filter("_held > 1")
    ranked = full.join(stored(held_by, "held_shingles"), "shingle", "left")
    order = Window.partitionBy("doc").orderBy(F.coalesce("_held", F.lit(1)), "shingle")
    ranked = ranked.withColumn("rank", F.row_number().over(order))
    first = F.col("rank") <= F.col("n") - F.ceil(F.col("n") * percent / F.lit(100)) + 1
    return ranked.filter(first & F.col("_held").isNotNull()).select("shingle", "doc", "n", "rank")


def _may_link(percent: int) -> Column:
    """Whether a shingle in which the sets a and b meet can be the first of all they share, if they link.

    a is the smaller one, ranks are places in a common order. What they share from that place
    on must reach the overlap they need; in a the place is among its first ninth or so, since
    no smaller set is its partner here. Nor may their parities differ more than such sets can.
    """
    overlap = F.ceil((F.col("n") + F.col("_n")) * percent / F.lit(100 + percent))
    smaller = (F.col("n") < F.col("_n")) | ((F.col("n") == F.col("_n")) & (F.col("a") < F.col("b")))
    listed_first = F.col("rank") <= F.col("n") - F.ceil(F.col("n") * 2 * percent / F.lit(100 + percent)) + 1
    rest = 1 + F.least(F.col("n") - F.col("rank"), F.col("_n") - F.col("_rank"))
    differing = reduce(add, [F.bit_count(F.col("parity")[i].bitwiseXOR(F.col("_parity")[i])) for i in range(PARITY_WORDS)])
    fits = smaller & listed_first & _comparable("n", "_n", percent) & (rest >= overlap)
    return fits & (F.col("n") + F.col("_n") - differing >= 2 * overlap)


def _long_list_links(sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) among the `sets` of documents with so many long lists that short ones may not show them.

    Here shingles are ordered by how many of these sets hold them. A passage that very many
    documents share then comes last, and only sets that are the same for the most part
    still meet. Such groups can be large and are not paired off: in rounds every document is
    checked against a few of its lists' documents that lie in other components of the links
    found so far. Once a round links few of the pairs it checks (or after ROUNDS, which no
    result depends on), what is left are sets of different components that meet. Of these a pair
    is looked at where the places of a shared shingle in both, and their parities, leave room
    for a link.
    """
    postings = stored(_rarest(sets, percent), "rarest_shingles")

    def named(groups: DataFrame) -> DataFrame:
        of_doc = stored(groups.withColumnRenamed("node", "doc"), "long_groups")
        return postings.join(of_doc, "doc", "left").withColumn("component", F.coalesce("component", "doc"))

    placed, links = postings.withColumn("component", F.col("doc")), []
    for number in range(ROUNDS):
        pairs = stored(_best_heads(placed, percent, number), "head_pairs")
        links.append(stored(_linked(pairs, sets, percent), "long_links"))
        found = links[-1].count()
        if found:
            placed = _open(named(components(reduce(DataFrame.unionByName, links))))
        if found * 20 <= pairs.count():
            break
    placed = placed.join(sets.select("doc", "parity"), "doc")
    mine = placed.select("shingle", F.col("doc").alias("a"), "n", "rank", F.col("component").alias("_mine"), "parity")
    theirs = placed.select("shingle", F.col("component"), *[F.col(x).alias(y) for x, y in _THEIRS.items()])
    rest = mine.join(theirs, (mine["shingle"] == theirs["shingle"]) & (F.col("_mine") != F.col("component")) & _may_link(percent))
    return reduce(DataFrame.unionByName, [*links, _linked(rest.select("a", "b").distinct(), sets, percent)])


_THEIRS = {"doc": "b", "n": "_n", "rank": "_rank", "parity": "_parity"}


def _open(placed: DataFrame) -> DataFrame:
    """The lists whose documents lie in several components, with `outside`: not in the list's largest."""
    held = placed.groupBy("shingle", "component").agg(F.count(F.lit(1)).alias("_held"))
    largest = held.groupBy("shingle").agg(
        F.max(F.struct("_held", "component")).alias("_largest"), F.count(F.lit(1)).alias("_components")
    )
    largest = largest.filter("_components > 1").select("shingle", F.col("_largest.component").alias("_main"))
    # A list whose documents are all connected shows nothing new.
    open_ = placed.join(stored(largest, "largest"), "shingle")
    return stored(open_.withColumn("outside", F.col("component") != F.col("_main")).drop("_main"), "open_postings")


def _best_heads(placed: DataFrame, percent: int, number: int) -> DataFrame:
    """Pairs (a, b): for each document the CHECKED ones it meets most often among the heads of its lists.

    A list's heads are the HEADS documents of the least hashes, so mostly the same ones in all
    lists of a group; each round draws others. After the first, only what lies outside its
    list's largest component is checked, against other components. A document's heads meet in
    one row, which its text's length bounds, and are counted there.
    """
    place = F.struct(F.xxhash64(F.lit(number), "doc").alias("_hash"), F.col("doc").alias("b"), F.col("n").alias("_n"), "component")
    heads = _least_of_each(placed.select("shingle", place.alias("_place")), HEADS)
    heads = heads.select("shingle", F.struct("_place.b", "_place._n", F.col("_place.component").alias("_theirs")).alias("head"))
    # Written before they are joined, so that Spark may split the rows of a frequent shingle.
    lists = stored(heads.groupBy("shingle").agg(F.collect_list("head").alias("heads")), "heads")
    mine = placed.filter("outside") if number else placed
    met = mine.select("shingle", "doc", "n", "component").join(lists, "shingle")
    met = met.groupBy("doc", "n", "component").agg(F.flatten(F.collect_list("heads")).alias("heads"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = batch.column("heads")
            row = np.repeat(np.arange(batch.num_rows), np.diff(found.offsets.to_numpy()))
            doc, n, mine = (batch.column(name).to_numpy() for name in ("doc", "n", "component"))
            b, size, theirs = (found.flatten().field(name).to_numpy() for name in ("b", "_n", "_theirs"))
            n, size = n[row].astype(np.int64), size.astype(np.int64)
            other = (mine[row] != theirs) & (100 * np.minimum(n, size) >= percent * np.maximum(n, size))
            row, b = row[other], b[other]
            # Equal pairs together and counted; of a document the most frequent first.
            order = np.lexsort((b, row))
            row, b = row[order], b[order]
            begins = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (b[1:] != b[:-1])])[: len(row)])
            times = np.diff(np.append(begins, len(row)))
            row, b = row[begins], b[begins]
            order = np.lexsort((b, -times, row))
            row, b = row[order], b[order]
            best = np.arange(len(row)) - np.searchsorted(row, row, "left") < CHECKED
            yield pa.RecordBatch.from_arrays([pa.array(doc[row[best]]), pa.array(b[best])], ["a", "b"])

    return met.mapInArrow(run, "a long, b long")


def _least_of_each(rows: DataFrame, count: int) -> DataFrame:
    """The `count` least places of each shingle, by aggregates that tasks combine."""
    # Salted first, so that no task sorts a whole long list.
    salted = rows.withColumn("_salt", F.pmod(F.col("_place._hash"), F.lit(64)))
    for keys in (["shingle", "_salt"], ["shingle"]):
        order = Window.partitionBy(*keys).orderBy("_place")
        salted = salted.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= count)
    return salted.select("shingle", "_place")


def join(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, long_list: int = LONG_LIST) -> DataFrame:
    """doc_id, n_shingles and component_id, the least doc_id that links reach, of every row of `docs`.

    A set is the distinct runs of `shingle` words, A to Z lowered; a shorter text is one run.
    Two documents link if 100 times what their sets share is at least `percent` times what
    they hold together. Every link between different sets is found. A null or empty text has an
    empty set and links with nothing. Rows of one doc_id are one document: it links with what any
    of its sets links with, and all its rows have one component. A null doc_id has no component
    and connects nothing. Other columns are not read.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.xxhash64(F.col("text").cast("string")).alias("text_hash"),
    )
    names = stored(_fingerprints(rows, shingle), "set_names")
    full = names.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    vertices = _vertices(full)
    links = _links(_one_of_each(rows, full, vertices), shingle, percent, long_list)

    # Sets that one doc_id has several of are tied to each other.
    held = full.join(vertices, _NAME).select("doc_id", "vertex").distinct()
    least = held.groupBy("doc_id").agg(F.min("vertex").alias("a"), F.max("vertex").alias("_most")).filter("a < _most")
    ties = held.join(stored(least, "repeated_ids"), "doc_id").select("a", F.col("vertex").alias("b"))

    groups = components(links.unionByName(ties))
    placed = vertices.join(groups, vertices["vertex"] == groups["node"], "left")
    placed = stored(placed.select(*_NAME, "class", F.coalesce("component", "vertex").alias("component")), "components")
    smallest = placed.groupBy("component").agg(F.min("class").alias("component_id"))
    of_set = placed.join(stored(smallest, "component_ids"), "component").select(*_NAME, "component_id")
    of_doc = full.join(of_set, _NAME).groupBy("doc_id").agg(F.min("component_id").alias("component_id"))
    found = names.join(of_doc, "doc_id", "left")
    mine = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return found.select("doc_id", "n_shingles", mine.alias("component_id"))


# The columns that name a set.
_NAME = ["n_shingles", "one", "two"]


def _vertices(full: DataFrame) -> DataFrame:
    """Of each set its name, the row that stands for it (class, text_hash) and its vertex.

    The vertex is the least doc_id that has the set. Where that stands for several sets, these
    get numbers of their own beyond all doc_ids.
    """
    sets = full.groupBy(*_NAME).agg(F.min(F.struct(F.col("doc_id").alias("class"), "text_hash")).alias("row"))
    sets = stored(sets.select(*_NAME, "row.class", "row.text_hash"), "sets_named")
    several = stored(sets.groupBy("class").agg(F.count(F.lit(1)).alias("_sets")).filter("_sets > 1").select("class"), "several_sets")
    if several.isEmpty():
        return sets.withColumn("vertex", F.col("class"))
    bounds = full.agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.count(F.lit(1)).alias("rows")).first()
    room_above = bounds["high"] + bounds["rows"] < (1 << 63) - 1
    start = bounds["high"] + 1 if room_above else bounds["low"] - bounds["rows"] - 1
    odd = assign_ids(sets.join(several, "class", "left_semi"), into="vertex", start=start)
    rest = sets.join(several, "class", "left_anti").withColumn("vertex", F.col("class"))
    return stored(rest.unionByName(odd.select(*rest.columns)), "vertices")


def _one_of_each(rows: DataFrame, full: DataFrame, vertices: DataFrame) -> DataFrame:
    """vertex and text of one row of each set.

    The other rows are few, and those with a vertex other than their doc_id fewer, or Spark
    finds the tables of them too large to be sent to all tasks and shuffles.
    """
    known = full.join(vertices.withColumnRenamed("text_hash", "_hash"), _NAME)
    others = known.filter("doc_id <> class OR text_hash <> _hash").select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"))
    same = (F.col("doc_id") == F.col("_id")) & (F.col("text_hash") == F.col("_hash"))
    chosen = rows.filter("doc_id IS NOT NULL").join(stored(others.distinct(), "copies"), same, "left_anti")

    again = full.groupBy("doc_id", "text_hash").agg(F.count(F.lit(1)).alias("_rows")).filter("_rows > 1")
    again = stored(again.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")), "repeated_rows")
    if not again.isEmpty():
        # Of equal rows one is kept; only these are shuffled.
        once = chosen.join(again, same, "left_anti")
        chosen = once.unionByName(chosen.join(again, same, "left_semi").dropDuplicates(["doc_id", "text_hash"]))
    renamed = vertices.filter("vertex <> class")
    renamed = renamed.select(F.col("class").alias("_id"), F.col("text_hash").alias("_hash"), "vertex")
    named = chosen.join(stored(renamed, "renamed"), same, "left")
    return named.select(F.coalesce("vertex", "doc_id").alias("doc_id"), "text")


def _links(docs: DataFrame, shingle: int, percent: int, long_list: int) -> DataFrame:
    """All links (a, b) among `docs`, each of another set."""
    first = _sets(docs, shingle, percent).select("doc", "n", F.explode("shingles").alias("shingle"))
    held_by = first.groupBy("shingle").agg(F.count(F.lit(1)).alias("docs")).filter("docs > 1")
    postings = stored(first.join(stored(held_by, "shared_shingles"), "shingle"), "postings")

    longs = postings.filter(F.col("docs") > long_list).groupBy("doc").agg(F.count(F.lit(1)).alias("longs"))
    sized = postings.withColumn("spare", spare(F.col("n"), percent)).join(stored(longs, "longs"), "doc", "left")
    sized = sized.withColumn("longs", F.coalesce("longs", F.lit(0)))
    candidates = stored(_short_list_candidates(sized.filter(F.col("docs") <= long_list), percent), "candidates")
    # Two that no short list shows share so many shingles of long ones. A partner may be smaller
    # and have less to spare.
    need = spare(F.ceil(F.col("n") * percent / F.lit(100)), percent) + 1
    many = stored(sized.filter(F.col("longs") >= need).select(F.col("doc").alias("_doc")).distinct(), "many_long")

    wanted = candidates.select(F.col("a").alias("_doc")).unionByName(candidates.select(F.col("b").alias("_doc")))
    wanted = stored(wanted.unionByName(many).distinct(), "wanted")
    sets = _sets(docs.join(wanted, F.col("doc_id") == F.col("_doc"), "left_semi"), shingle, None)
    sets = stored(sets.select("doc", "shingles", "parity"), "sets")
    links = _linked(candidates, sets, percent)
    if many.isEmpty():
        return links
    theirs = sets.join(many.select(F.col("_doc").alias("doc")), "doc", "left_semi")
    return links.unionByName(_long_list_links(stored(theirs, "long_sets"), percent))
