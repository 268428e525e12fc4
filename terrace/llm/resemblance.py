"""Near copies: texts whose sets of five-word shingles have a Jaccard similarity of 0.8 or more.

A text's shingles are hashed 96 ways, and the least values, four at a time, make 24 keys.
Two texts of similarity ``s`` share a key with probability ``1 - (1 - s**4)**24``: at 0.8
all but 4 pairs in a million do. What shares a key is compared by its whole shingle sets,
so a link is never an estimate.

No pair is ever a row. The texts of a key are dealt into blocks of bounded size, a task
compares those of a block that are in different components, and returns a forest of the
links it finds. A pass over a few keys joins most copies, so that in the next one, over the
others, few keys are left that have several components; only keys that still do so and
have more than one block are met block by block at last. Within a block a text is compared
with those alone that share one of its rarest shingles, as similar texts must.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.llm.common import slices, stored, texts

#: Words of a shingle, keys of a text, least values of a key.
WIDTH, BANDS, ROWS = 5, 24, 4
SIMILARITY = 0.8
#: Texts of a block.
BLOCK = 256
#: Groups of at most so many texts are compared pair by pair.
FEW = 8
#: First key and number of keys of each pass, and whether blocks are met with each other.
PASSES = ((0, 3, False), (3, BANDS - 3, False), (0, BANDS, True))

_DRAW = np.random.default_rng(8)
_FACTORS = _DRAW.integers(0, 1 << 63, BANDS * ROWS, np.uint64)[:, None] * np.uint64(2) + np.uint64(1)
_MASKS = _DRAW.integers(0, 1 << 63, BANDS * ROWS, np.uint64)[:, None]


def text_key() -> Column:
    """Stands for a text; equal texts have the same."""
    return F.xxhash64("text").alias("text_key")


def shingles(text: bytes | None, width: int = WIDTH, seed: int = 42) -> np.ndarray:
    """Sorted distinct hashes of the word shingles; of all words, if they are fewer than that."""
    words = (text or b"").lower().split()  # ASCII only, both
    spans = (b" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1)))
    digest = xxhash.xxh64_intdigest
    return np.unique(np.fromiter((digest(s, seed) for s in spans), np.uint64)) if words else np.zeros(0, np.uint64)


def band_keys(hashes: np.ndarray) -> np.ndarray:
    """The keys of a set that is not empty."""
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), 1024):
        mixed = (hashes[at : at + 1024] ^ _MASKS) * _FACTORS
        np.minimum(least, mixed.min(axis=1), out=least)
    bands = least.reshape(BANDS, ROWS)
    keys = [xxhash.xxh64_intdigest(band.tobytes(), i) for i, band in enumerate(bands)]
    return np.array(keys, np.uint64).view(np.int64)


def _lists(column: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, column)], dtype=np.int32)
    values = np.concatenate([np.zeros(0, np.int64), *column])
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values))


def sketches(docs: DataFrame) -> DataFrame:
    """``text_key``, ``n`` (distinct shingles) and ``bands`` of every distinct text with words."""

    def compute(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 512):
            sets = [shingles(t) for some in texts(batch.column("text")) for t in some]
            full = np.array([len(s) > 0 for s in sets], bool)
            sets = [s for s in sets if len(s)]
            sizes = pa.array([len(s) for s in sets], pa.int64())
            keys = batch.column("text_key").filter(pa.array(full))
            yield pa.RecordBatch.from_arrays(
                [keys, sizes, _lists([band_keys(s) for s in sets])], names=["text_key", "n", "bands"]
            )

    # Copies go before anything is hashed; each task drops its own first.
    return docs.select("text").distinct().select(text_key(), "text").mapInArrow(
        compute, "text_key bigint, n bigint, bands array<bigint>"
    )


def shingle_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``text_key`` and ``shingles`` (sorted hashes) of the texts whose ``text_key`` is wanted."""

    def compute(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 128):
            sets = [shingles(t).view(np.int64) for some in texts(batch.column("text")) for t in some]
            yield pa.RecordBatch.from_arrays(
                [batch.column("text_key"), _lists(sets)], names=["text_key", "shingles"]
            )

    asked = docs.select(text_key(), "text").join(wanted, "text_key", "left_semi").distinct()
    return asked.mapInArrow(compute, "text_key bigint, shingles array<bigint>")


def candidates(
    placed: DataFrame, first: int, count: int, crossed: bool, block: int | None = None
) -> DataFrame:
    """``key``, ``group``, ``text_key`` and ``root`` of the texts to be compared.

    Only keys with more than one root. A group is one of the key's blocks, or with
    ``crossed`` two of them.
    """
    block = block or BLOCK
    keyed = placed.select(F.explode(F.slice("bands", first + 1, count)).alias("key"), "text_key", "root")
    of_key = keyed.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.min("root").alias("low"), F.max("root").alias("high")
    )
    apart = of_key.filter("low != high").select("key", F.ceil(F.col("n") / block).alias("blocks"))
    found = keyed.join(apart.filter("blocks > 1") if crossed else apart, "key")
    own = F.pmod(F.xxhash64("text_key"), F.col("blocks"))
    if not crossed:
        return found.select("key", own.alias("group"), "text_key", "root")
    others = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)).alias("other")
    met = found.select("key", "text_key", "root", "blocks", own.alias("own"), others)
    pair = F.least("own", "other") * F.col("blocks") + F.greatest("own", "other")
    return met.filter("own != other").select("key", pair.alias("group"), "text_key", "root")


def _similar(common: int, a: int, b: int, parts: int) -> bool:
    return common * 1000 >= (a + b - common) * parts


def group_links(roots: np.ndarray, sets: list[np.ndarray], parts: int) -> list[tuple[int, int]]:
    """Links between roots that connect what similar texts of the group connect.

    ``parts`` is the similarity in thousandths. Texts of one component are not compared.
    """
    _, label = np.unique(roots, return_inverse=True)
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    links: list[tuple[int, int]] = []

    def join(i: int, j: int) -> None:
        links.append((int(roots[i]), int(roots[j])))
        label[label == label[j]] = label[i]

    if len(sets) <= FEW:
        for i in range(len(sets)):
            for j in range(i):
                if label[i] == label[j] or min(sizes[i], sizes[j]) * 1000 < max(sizes[i], sizes[j]) * parts:
                    continue
                common = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                if _similar(common, int(sizes[i]), int(sizes[j]), parts):
                    join(i, j)
        return links
    # Shingles by number, the group's rarest first; each text's in this order.
    _, ids, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    rank = np.empty(len(counts), np.int64)
    rank[np.argsort(counts, kind="stable")] = np.arange(len(counts))
    owner = np.repeat(np.arange(len(sets)), sizes)
    ids = rank[ids]
    ids = ids[np.lexsort((ids, owner))]
    ends = np.cumsum(sizes)
    starts = ends - sizes
    # Texts as similar as that have one of their first shingles in common.
    prefix = sizes - -(-sizes * parts // 1000) + 1
    first = np.arange(len(ids)) - np.repeat(starts, sizes) < np.repeat(prefix, sizes)
    token, who = ids[first], owner[first]
    order = np.argsort(token, kind="stable")
    token, who = token[order], who[order]
    marked = np.zeros(len(counts), bool)
    for i in range(1, len(sets)):
        if (label[: i + 1] == label[i]).all():
            continue
        own = ids[starts[i] : ends[i]]
        low, high = (np.searchsorted(token, own[: prefix[i]], side) for side in ("left", "right"))
        length = high - low
        at = np.repeat(low - (np.cumsum(length) - length), length) + np.arange(length.sum())
        near, shared = np.unique(who[at], return_counts=True)
        large = np.maximum(sizes[near], sizes[i]) * parts <= np.minimum(sizes[near], sizes[i]) * 1000
        left = (near < i) & large & (label[near] != label[i])
        near, shared = near[left], shared[left]
        marked[own] = True
        for j in near[np.argsort(-shared, kind="stable")].tolist():
            if label[j] != label[i]:
                common = int(np.count_nonzero(marked[ids[starts[j] : ends[j]]]))
                if _similar(common, int(sizes[i]), int(sizes[j]), parts):
                    join(i, j)
        marked[own] = False
    return links


def similar(found: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """``u`` and ``v``: links between the roots of candidates that are similar, as forests."""
    parts = round(similarity * 1000)

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[object, object] | None = None
        roots: list[int] = []
        own: list[np.ndarray] = []
        links: list[tuple[int, int]] = []

        def batch_of() -> pa.RecordBatch:
            u, v = zip(*links) if links else ((), ())
            links.clear()
            return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

        for batch in batches:
            keys, groups, root = (batch.column(c).to_pylist() for c in ("key", "group", "root"))
            lists = batch.column("shingles")
            ends, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
            for k, place in enumerate(zip(keys, groups, strict=True)):
                if place != held:
                    if len(roots) > 1:
                        links += group_links(np.array(roots), own, parts)
                    held, roots, own = place, [], []
                roots.append(root[k])
                own.append(flat[ends[k] : ends[k + 1]].copy())
            if len(links) > 10_000:
                yield batch_of()
        if len(roots) > 1:
            links += group_links(np.array(roots), own, parts)
        yield batch_of()

    return (
        found.join(sets, "text_key").select("key", "group", "root", "shingles")
        .repartition("key", "group").sortWithinPartitions("key", "group")
        .mapInArrow(compare, "u bigint, v bigint")
    )
