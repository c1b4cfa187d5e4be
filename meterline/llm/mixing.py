"""Mixing sources to target weights by proportionate-fair scheduling, in DataFrame functions alone."""

from __future__ import annotations

import heapq
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from meterline.llm.common import stored
from meterline.operators.numbering import assign_ids

# Letters of a source that one slot of the mix holds.
BLOCK_CHARS = 100_000
# Weights are rounded down to this many parts of the whole, and to one part at least: over as many
# slots, that takes less than a block from any source.
PARTS = 1 << 20
# Weights are whole numbers of this part of one.
WEIGHT_STEP = 1 << 20
# Runs of sources with one share are looked up by about this many ranges of their numbers.
RANGES = 4096
# A source's documents are numbered in groups of about this many rows of the whole table.
GROUP_ROWS = 50_000


def schedule(
    large: Mapping[int, int], ones: int, parts: int = 0, wanted: int | None = None
) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """One period's slots, or its first `wanted` ones, earliest deadline first, of sources numbered from
    0 up: those in `large` have more than one share, each of the `ones` others has one.

    Block k of a source with share p of P is released at floor(k * P / p) and due by
    ceil((k + 1) * P / p); P is `parts`, or all shares together if they are more. One slot
    serves one block, and where none is released it stays empty. As the shares fit the period,
    every block is served between the two, so at any slot every source has had less than one
    block more or less than its share, and after a period exactly its share.

    The first list has (source, block, slot) of the large ones. A source with one share is
    ready all the time and due at the end, so these are served in their order wherever no
    large one is due before; the second list has runs (first, end, shift) of their numbers,
    each in slot number + shift. Both are as long as the shares of the large ones, however
    many others there are.
    """
    total = max(parts, sum(large.values()) + ones)
    last = total if wanted is None else min(wanted, total)
    named = sorted(large)
    # How many of the others come before each large source.
    before = {source: source - place for place, source in enumerate(named)}
    waiting = [(0, source) for source in named]
    ready: list[tuple[int, int]] = []
    served = dict.fromkeys(named, 0)
    slots, runs = [], []
    slot = one = passed = 0
    while slot < last:
        while waiting and waiting[0][0] <= slot:
            source = heapq.heappop(waiting)[1]
            heapq.heappush(ready, (-(-(served[source] + 1) * total // large[source]), source))
        if ready and (ready[0][0] < total or one == ones or before[ready[0][1]] <= one):
            source = heapq.heappop(ready)[1]
            slots.append((source, served[source], slot))
            served[source] += 1
            if served[source] < large[source]:
                heapq.heappush(waiting, (served[source] * total // large[source], source))
            slot += 1
            continue
        if one == ones:
            if not waiting:
                break
            slot = waiting[0][0]
            continue
        while passed < len(named) and before[named[passed]] <= one:
            passed += 1
        end = min(ones, one + (waiting[0][0] if waiting else total) - slot)
        if ready:
            end = min(end, before[ready[0][1]])
        if passed < len(named):
            end = min(end, before[named[passed]])
        runs.append((one + passed, end + passed, slot - one - passed))
        slot, one = slot + end - one, end
    return slots, runs


def period(shares: Sequence[int]) -> list[int]:
    """Which source each slot of a period of sum(shares) slots serves, none of them empty."""
    held = [source for source, share in enumerate(shares) if share]
    large = {number: shares[source] for number, source in enumerate(held) if shares[source] > 1}
    slots, runs = schedule(large, len(held) - len(large))
    placed = [(slot, source) for source, _, slot in slots]
    placed += [(source + shift, source) for first, end, shift in runs for source in range(first, end)]
    return [held[source] for _, source in sorted(placed)]


def _numbered(docs: DataFrame, block_chars: int, shares: DataFrame) -> DataFrame:
    """`docs` with `_block`, the number of its source's block in which a row begins, and `_at`, where,
    and with the columns of its source's row in `shares`.

    A source is a tape of its texts, one letter apart, in the order of a hash of doc_id and text. The
    tape is measured in two steps, within groups of neighbouring hashes and over the groups'
    totals, so a source with most of the rows is spread over many tasks.
    """
    groups = 1
    while groups * GROUP_ROWS < docs.count() and groups < 1 << 24:
        groups *= 2
    # Of the text as well, so that rows without an id, or many with one, fall into many groups.
    named = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit("-"), F.md5(F.coalesce("text", F.lit(""))))
    hashed = F.conv(F.substring(F.md5(named), 1, 15), 16, 10)
    rows = docs.withColumns(
        {
            "_order": hashed.cast("long"),
            "_size": F.coalesce(F.char_length(F.col("text").cast("string")), F.lit(0)).cast("long") + 1,
        }
    )
    # _order has 60 bits.
    rows = rows.withColumn("_group", F.shiftright("_order", 60 - groups.bit_length() + 1))
    inside = Window.partitionBy("source", "_group").orderBy("_order", "doc_id", "_size", F.xxhash64("text"))
    rows = rows.withColumn("_within", F.sum("_size").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    totals = rows.groupBy("source", "_group").agg(F.sum("_size").alias("_total"))
    before = Window.partitionBy("source").orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(
        F.col("source").alias("_source"),
        F.col("_group").alias("_of_group"),
        F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_before"),
    )
    # The shares come with the totals, so the rows meet one table only.
    totals = totals.join(shares, F.col("_source").eqNullSafe(F.col("_name"))).drop("_name")
    same = F.col("source").eqNullSafe(F.col("_source")) & (F.col("_group") == F.col("_of_group"))
    at = F.col("_before") + F.col("_within") - F.col("_size")
    return (
        rows.join(totals, same)
        .withColumn("_at", at)
        .withColumn("_block", F.floor(F.col("_at") / F.lit(block_chars)).cast("long"))
        .drop("_order", "_group", "_within", "_source", "_of_group", "_before")
    )


def shares_of(docs: DataFrame, weights: Mapping[str, float] | None, parts: int) -> DataFrame:
    """Each source's `_name`, its number `_index` in the order of names, the null source first, its
    size `_letters` and its share `_share` of the schedule.

    Without `weights` a source weighs the square root of its size, so that small sources
    count for more than their part and large ones for less. With them, a source they do not
    name weighs as much as the lightest one. Weights are added up as whole numbers, by Spark.
    """
    spark = docs.sparkSession
    size = F.sum(F.coalesce(F.char_length("text"), F.lit(0)).cast("long") + 1)
    weighed = docs.groupBy(F.col("source").alias("_name")).agg(size.alias("_letters"))
    weight = F.sqrt(F.col("_letters").cast("double")) * WEIGHT_STEP
    if weights is not None:
        if not weights or min(weights.values()) <= 0:
            raise ValueError("weights must be positive")
        # The heaviest one takes 2^50 steps.
        heaviest = max(weights.values())
        given = [(name, float(weight / heaviest * 2**50)) for name, weight in weights.items()]
        given = spark.createDataFrame(given, "_of string, _given double")
        weighed = weighed.join(given, F.col("_name").eqNullSafe(F.col("_of")), "left").drop("_of")
        weight = F.coalesce("_given", F.lit(float(min(weights.values()) / heaviest * 2**50)))
    whole = F.greatest(F.lit(1), F.floor(weight)).cast("decimal(38,0)")
    weighed = weighed.select("_name", "_letters", whole.alias("_weight"))
    numbered = stored(assign_ids(weighed, ["_name"], "_index", start=0), "sources")
    total = numbered.agg(F.sum("_weight")).first()[0] or 1
    share = F.expr(f"(CAST({parts} AS DECIMAL(10,0)) * CAST(_weight AS DECIMAL(20,0))) div CAST('{total}' AS DECIMAL(38,0))")
    shares = numbered.select("_name", "_index", "_letters", F.greatest(F.lit(1), share).cast("long").alias("_share"))
    return stored(shares, "shares")


def _scheduled(shares: DataFrame, parts: int, block_chars: int) -> tuple[DataFrame, DataFrame, int]:
    """`shares` with `_place`, the slot of a source with one share; the slots of the blocks of the
    others; and the slots in a period."""
    spark = shares.sparkSession
    # At most half as many as there are parts, as their shares are not rounded up.
    large = {row["_index"]: row["_share"] for row in shares.filter("_share > 1").collect()}
    count = shares.count()
    total = max(parts, sum(large.values()) + count - len(large))
    # The slot by which the last source has ended.
    last = shares.agg(F.max(F.expr(f"((_letters div {block_chars} + 1) * {total}L + _share - 1) div _share"))).first()[0] or 0
    slots, runs = schedule(large, count - len(large), parts, last)
    width = max(1, count // RANGES)
    ranges = [(at, *run) for run in runs for at in range(run[0] // width, (run[1] - 1) // width + 1)]
    runs_by_range = spark.createDataFrame(ranges, "_range long, _first long, _end long, _shift long")
    near = (F.floor(F.col("_index") / F.lit(width)) == F.col("_range")) & (F.col("_share") == 1)
    inside = (F.col("_first") <= F.col("_index")) & (F.col("_index") < F.col("_end"))
    placed = shares.join(F.broadcast(runs_by_range), near & inside, "left").select(
        "_name", "_index", "_share", (F.col("_index") + F.col("_shift")).alias("_place")
    )
    turns = spark.createDataFrame(slots, "_large long, _turn long, _slot long")
    return placed, turns, total


def mix(
    docs: DataFrame,
    weights: Mapping[str, float] | None = None,
    block_chars: int = BLOCK_CHARS,
    parts: int = PARTS,
) -> DataFrame:
    """`docs` with the slot of the mix that each row belongs to: sorted by `mix_slot`, `mix_block`
    and `mix_at`, the sources come by their weights, each block of a source spread between its
    `mix_release` and `mix_deadline`.

    The five columns replace those of the same names; doc_id, source and text must be there, and
    all other columns stay, whatever their names. No row is dropped, repeated or cut. A row
    belongs to the block in which it begins; one that is longer than a block leaves the blocks
    it reaches over empty. While all sources last, each is within one block of its share at every
    slot, and a share is less than one of `parts` below the weight (a weight of less than one
    part is raised to it); the slots of a source that has ended stay empty, and the others go on in
    their proportions. Rows without a source are a source of their own, null or empty texts
    take up one letter, repeated rows follow each other, and an empty table stays empty.
    """
    docs = docs.drop("mix_slot", "mix_block", "mix_at", "mix_release", "mix_deadline")
    # Under names that no column made here has.
    kept = {name: f"in_{name}" for name in docs.columns}
    used = [F.col("doc_id"), F.col("source"), F.col("text").cast("string").alias("text")]
    rows = docs.select(*[F.col(f"`{name}`").alias(inner) for name, inner in kept.items()], *used)
    shares, slots, total = _scheduled(shares_of(rows, weights, parts), parts, block_chars)
    # Each row meets the one slot of its block's turn.
    rows = _numbered(rows, block_chars, shares)
    round_, turn = F.floor(F.col("_block") / F.col("_share")), F.col("_block") % F.col("_share")
    mixed = rows.join(F.broadcast(slots), (F.col("_index") == F.col("_large")) & (turn == F.col("_turn")), "left")
    return mixed.select(
        *[F.col(f"`{inner}`").alias(name) for name, inner in kept.items()],
        (round_ * total + F.coalesce("_place", "_slot")).alias("mix_slot"),
        F.col("_block").alias("mix_block"),
        F.col("_at").alias("mix_at"),
        F.expr(f"_block * {total}L div _share").alias("mix_release"),
        F.expr(f"((_block + 1) * {total}L + _share - 1) div _share").alias("mix_deadline"),
    )


def in_mixed_order(docs: DataFrame, weights: Mapping[str, float] | None = None) -> DataFrame:
    """`docs` with the columns they had, sorted into the mix; written, the files keep the order."""
    order = ["mix_slot", "mix_block", "mix_at", "doc_id"]
    return mix(docs, weights).orderBy(*order).select(*docs.columns)


def digests(mixed: DataFrame) -> DataFrame:
    return mixed.select("doc_id", "source", "mix_block", "mix_at", "mix_release", "mix_deadline", "mix_slot")
