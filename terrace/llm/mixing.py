"""Mixing sources to target weights by Pfair scheduling.

Time is a row of slots, each of one block. Block ``i`` (from 0) of a source with weight
``w`` is released at slot ``floor(i / w)`` and due by slot ``ceil((i + 1) / w)``. Earliest
deadline first gives every slot to a released block, and every block meets its deadline;
so at any time each source has had its share of the slots to less than one block.

Weights are exact: fractions are brought to whole numbers, none is rounded. Only blocks
that a source has are scheduled, so one of little weight costs no more slots than it has
blocks, and the size of a block bounds how many there are in all. What is to come depends only on the slot and the blocks given so far: one pass
over the blocks notes these once a period, and tasks plan the periods apart. Documents of a
source come in the order of a hash, and a block is a fixed number of characters of that
sequence. The running sum of characters is taken in buckets of the hash, to which the
sums of the buckets before are added, so no source has to be in one task.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterable, Iterator, Mapping, Sequence
from fractions import Fraction
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from terrace.llm.common import stored

#: Blocks planned in one go, the power of a source's size that is its weight, characters a block.
PERIOD, POWER, BLOCK_CHARS = 1000, 0.5, 20_000
#: Blocks that are scheduled at most, but for one a source; with more characters blocks are larger.
MOST_BLOCKS = 5_000_000
#: Documents of a bucket, about.
BUCKET_ROWS = 2_000
SEED = 17


def whole_weights(weights: Sequence[float]) -> list[int]:
    """Whole numbers in exactly the proportion of the weights."""
    exact = [Fraction(w) for w in weights]
    common = math.lcm(*[x.denominator for x in exact])
    whole = [int(x * common) for x in exact]
    least = math.gcd(*whole) or 1
    return [x // least for x in whole]


def turns(
    weights: Sequence[int], ends: Sequence[int], given: Sequence[int] | None = None, slot: int = 0
) -> Iterator[tuple[int, int, int, int, int]]:
    """Source, block, release, deadline and slot of each block, in the order of the slots.

    Goes on at ``slot`` after the first ``given`` blocks of each source, up to its end.
    """
    total, given = sum(weights), list(given or [0] * len(weights))
    waiting = [
        (given[s] * total // w, s) for s, w in enumerate(weights) if w and given[s] < ends[s]
    ]
    heapq.heapify(waiting)
    ready: list[tuple[int, int, int]] = []  # (deadline, source, release)
    while waiting or ready:
        if not ready:
            slot = max(slot, waiting[0][0])
        while waiting and waiting[0][0] <= slot:
            release, s = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(given[s] + 1) * total // weights[s]), s, release))
        deadline, s, release = heapq.heappop(ready)
        yield s, given[s], release, deadline, slot
        given[s] += 1
        slot += 1
        if given[s] < ends[s]:
            heapq.heappush(waiting, (given[s] * total // weights[s], s))


def schedule(shares: Sequence[int]) -> list[list[int]]:
    """Slots of each source's blocks in one period, whose length is the sum of the shares."""
    slots: list[list[int]] = [[] for _ in shares]
    for s, _, _, _, slot in turns(shares, shares):
        slots[s].append(slot)
    return slots


def states(
    weights: Sequence[int], ends: Sequence[int], period: int
) -> Iterator[tuple[int, list[int]]]:
    """Slot and blocks given of each source, before every ``period``-th block."""
    given = [0] * len(weights)
    for at, (s, _, _, _, slot) in enumerate(turns(weights, ends)):
        if at % period == 0:
            yield slot, list(given)
        given[s] += 1


def _planned(
    spark: SparkSession, sources: Sequence[str], weights: Sequence[int], ends: Sequence[int], period: int
) -> DataFrame:
    """``key``, ``mix_block`` and its release, deadline and slot, of all blocks."""
    period = max(period, 10 * len(sources))
    begun = spark.createDataFrame(list(states(weights, ends, period)), "slot bigint, given array<bigint>")
    schema = "key string, mix_block bigint, mix_release bigint, mix_deadline bigint, mix_slot bigint"

    def plan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for state in batch.to_pylist():
                made = islice(turns(weights, ends, state["given"], state["slot"]), period)
                s, *columns = zip(*made, strict=True)
                arrays = [pa.array([sources[i] for i in s]), *[pa.array(c, pa.int64()) for c in columns]]
                names = ["key", "mix_block", "mix_release", "mix_deadline", "mix_slot"]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return begun.mapInArrow(plan, schema)


def _key(source: str) -> Column:
    """The source as text, told apart from null."""
    return F.when(F.col(source).isNull(), "null").otherwise(
        F.concat(F.lit("="), F.col(source).cast("string"))
    )


def scheduled(
    docs: DataFrame,
    weights: Mapping[str | None, float] | None = None,
    source: str = "source",
    period: int = PERIOD,
    block_chars: int = BLOCK_CHARS,
    bucket_rows: int = BUCKET_ROWS,
    most_blocks: int = MOST_BLOCKS,
) -> DataFrame:
    """The rows with ``mix_block``, ``mix_release``, ``mix_deadline``, ``mix_slot``, ``mix_start``.

    In the order of ``mix_slot`` and ``mix_start`` (characters of the source before the
    document) the sources are mixed. The mixture holds as long as every source lasts; the
    slots of one that has run out stay empty, and no document is left out. A document
    belongs to the block in which it starts; one longer than a block is whole in its slot all
    the same, so the sources' characters deviate by a block and their longest text at most.
    A block has ``block_chars`` characters, or more where ``most_blocks`` of these are too few
    for all: so the driver's pass and its notes are bounded, and a block is a smaller part of
    the whole the larger that is. Without ``weights`` a source weighs the square
    root of its characters; a source without weight has null slots.

    A null text has no characters. A null source is a source of its own. Documents equal
    in id and text follow each other, in any order. An empty table gives an empty result.
    The ``mix_`` columns replace columns of these names.
    """
    added = ("mix_block", "mix_release", "mix_deadline", "mix_slot", "mix_start")
    names = [c for c in docs.columns if c not in added]
    size = F.coalesce(F.char_length("text"), F.lit(0)).cast("bigint")
    draw = F.pmod(F.xxhash64(F.lit(SEED), F.col("doc_id"), F.col("text")), F.lit(1 << 40))
    # Names of their own, so that none clashes and columns nobody asks for aren't shuffled.
    kept = {f"row_{i}": F.col(f"`{c}`") for i, c in enumerate(names)}
    keyed = docs.select(
        *[c.alias(own) for own, c in kept.items()],
        _key(source).alias("key"), size.alias("size"), draw.alias("draw"),
    )
    rows = docs.select(F.lit(1)).count()
    buckets = 1 + rows // bucket_rows
    bucket = F.floor(F.col("draw") * F.lit(buckets) / F.lit(1 << 40)).cast("bigint")
    keyed = keyed.withColumn("bucket", bucket)
    sums = stored(keyed.groupBy("key", "bucket").agg(F.sum("size").alias("chars")), "mix_sums")
    sizes = {r["key"]: r["chars"] for r in sums.groupBy("key").agg(F.sum("chars").alias("chars")).collect()}
    block_chars = max(block_chars, -(-sum(sizes.values()) // most_blocks))
    if weights is None:
        wanted = {s: max(n, 1) ** POWER for s, n in sizes.items()}
    else:
        named = {"null" if s is None else f"={s}": w for s, w in weights.items()}
        wanted = {s: named.get(s, 0.0) for s in sizes}
    sources = sorted(k for k, w in wanted.items() if w > 0)
    whole = whole_weights([wanted[k] for k in sources])
    # A document without characters may start where the last block ends.
    ends = [sizes[k] // block_chars + 1 for k in sources]
    planned = _planned(docs.sparkSession, sources, whole, ends, period)
    before = Window.partitionBy("key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        "key", "bucket", "chars", F.coalesce(F.sum("chars").over(before), F.lit(0)).alias("offset")
    ).withColumn("first", F.expr(f"offset div {block_chars}"))
    # The blocks of a bucket, in their order.
    last = F.expr(f"(offset + chars) div {block_chars}")
    blocks = offsets.select("key", "bucket", F.explode(F.sequence("first", last)).alias("mix_block"))
    turn = F.struct("mix_block", "mix_release", "mix_deadline", "mix_slot")
    of_bucket = blocks.join(planned, ["key", "mix_block"]).groupBy("key", "bucket").agg(
        F.array_sort(F.collect_list(turn)).alias("turns")
    )
    offsets = offsets.drop("chars").join(of_bucket, ["key", "bucket"], "left")
    offsets = stored(offsets, "mix_offsets")
    inside = Window.partitionBy("key", "bucket").orderBy("draw", "size").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    sequenced = keyed.withColumn("until", F.sum("size").over(inside))
    # One row a source and bucket.
    placed = sequenced.join(offsets, ["key", "bucket"])
    start = F.col("offset") + F.col("until") - F.col("size")
    placed = placed.withColumn("mix_start", start)
    placed = placed.withColumn("mix_block", F.expr(f"mix_start div {block_chars}"))
    placed = placed.withColumn("turn", F.get("turns", (F.col("mix_block") - F.col("first")).cast("int")))
    return placed.select(
        *[F.col(own).alias(c) for own, c in zip(kept, names, strict=True)],
        "mix_block",
        "turn.mix_release",
        "turn.mix_deadline",
        "turn.mix_slot",
        "mix_start",
    )


def mixed(docs: DataFrame, weights: Mapping[str | None, float] | None = None, **how: int) -> DataFrame:
    """The documents, all of them and with their own columns, sorted in the order of the mixture."""
    placed = scheduled(docs, weights, **how)
    order = [F.asc_nulls_last("mix_slot"), F.asc("mix_start"), F.asc("doc_id")]
    return placed.sort(*order).select(*docs.columns)
