"""Near-duplicates by SimHash fingerprints, found with pigeonring filtering.

A fingerprint has 64 bits. Two documents are linked if theirs differ in at most four.
The bits are laid out as a ring of five segments. If the differences over the whole ring
sum to at most four, then from some segment on every chain of ``l`` consecutive segments
differs in at most ``4 * l / 5`` bits (the pigeonring principle): the first segment is
equal, the first two differ in at most one bit, the first three in at most two, the first
four in at most three. The second segment, with at most one differing bit, has an equal
half. So linked fingerprints share at least one of ten keys, "a segment and one half of
the next one", and what shares a key must pass the chain budgets before the full check.

Work is done on distinct fingerprints, so a group of exact copies is one row whatever its
size. Keys that many fingerprints share are dealt out as pairs of blocks. Tasks never
emit pairs: each reduces the links it finds to a spanning forest.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace.llm import resemblance
from terrace.llm.common import free_name, stored, texts

#: Low bit and width of the ring's segments.
SEGMENTS = ((0, 13), (13, 13), (26, 13), (39, 13), (52, 12))
MAX_BITS = 4
#: Fingerprints under one key that are compared in one group.
BLOCK = 4096


def simhash(text: bytes | None, width: int = 4, seed: int = 42) -> int:
    """Signed 64-bit fingerprint of the word shingles; 0 without words.

    A bit is set if it is set in more than half of the shingles' XXH64 values.
    """
    words = (text or b"").lower().split()  # ASCII only, both
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.cumsum(lengths + 1) - lengths - 1
    ends = starts + lengths
    if len(words) > width:
        starts, ends = starts[: 1 - width], ends[width - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    counts = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(starts), 16384):
        spans = zip(starts[at : at + 16384].tolist(), ends[at : at + 16384].tolist(), strict=True)
        hashes = np.array([digest(joined[a:b], seed) for a, b in spans], np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int32)
    weights = np.uint64(1) << np.arange(64, dtype=np.uint64)
    return int(weights[2 * counts > len(starts)].sum(dtype=np.uint64).astype(np.int64))


def fingerprints(docs: DataFrame, width: int = 4, seed: int = 42) -> DataFrame:
    """All columns but ``text`` and ``fingerprint`` (bigint); a null or empty text has 0."""
    kept = docs.select(*[c for c in docs.columns if c != "text"], "text")
    fields = [f for f in kept.schema if f.name != "text"]
    schema = T.StructType([*fields, T.StructField("fingerprint", T.LongType())])

    def compute(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            *columns, text = batch.columns
            prints = [simhash(t, width, seed) for some in texts(text) for t in some]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(prints, pa.int64())], names=schema.names
            )

    return kept.mapInArrow(compute, schema)


def _bits(column: Column, low: int, width: int) -> Column:
    return F.shiftrightunsigned(column, low).bitwiseAND(F.lit((1 << width) - 1).cast("bigint"))


def ring_keys(fingerprint: str = "fingerprint") -> Column:
    """Array of the ten keys: start segment, half of the next one, and which these are."""
    column, keys = F.col(fingerprint), []
    for start, (low, width) in enumerate(SEGMENTS):
        next_low, next_width = SEGMENTS[(start + 1) % len(SEGMENTS)]
        half = next_width // 2
        halves = ((next_low, half), (next_low + half, next_width - half))
        for side, (half_low, half_width) in enumerate(halves):
            exact = F.shiftleft(_bits(column, low, width), 8) + _bits(column, half_low, half_width)
            keys.append(exact + F.lit((2 * start + side) << 32))
    return F.array(*keys)


def _chain_masks() -> np.ndarray:
    """Row per start segment: masks of its chains of 1, 2, .. segments."""
    own = [((1 << width) - 1) << low for low, width in SEGMENTS]
    m = len(own)
    rows = [[sum(own[(s + i) % m] for i in range(n)) for n in range(1, m + 1)] for s in range(m)]
    return np.array(rows, np.uint64)


CHAINS = _chain_masks()
BUDGETS = tuple(n * MAX_BITS // len(SEGMENTS) for n in range(1, len(SEGMENTS) + 1))


def linked(a: np.ndarray, b: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Positions where the chains from segment ``start`` keep their budgets.

    The last chain is the whole ring, so its budget is the full Hamming check.
    """
    left = np.arange(len(a))
    for masks, budget in zip(CHAINS.T, BUDGETS, strict=True):
        x = (a[left] ^ b[left]) & masks[start[left]]
        left = left[np.bitwise_count(x) <= budget]
    return left


def forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links from each node to the first node of its component; as connected as the input."""
    nodes, index = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = index[: len(u)], index[len(u) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[a], label[b])
        after = label.copy()
        np.minimum.at(after, label[a], low)
        np.minimum.at(after, label[b], low)
        while not np.array_equal(after, after[after]):
            after = after[after]
        if np.array_equal(after, label):
            break
        label = after
    rest = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[rest], nodes[label[rest]]


def _links_of_runs(keys: np.ndarray, groups: np.ndarray, prints: np.ndarray) -> pa.RecordBatch:
    """Forest of the links between fingerprints of the same key; rows come sorted by key."""
    start = (keys >> 33).astype(np.int64)
    us: list[np.ndarray] = []
    vs: list[np.ndarray] = []
    found, apart = 0, 1
    i = np.arange(len(keys))
    while True:
        i = i[i + apart < len(keys)]
        i = i[(keys[i] == keys[i + apart]) & (groups[i] == groups[i + apart])]
        if not len(i):
            break
        hit = i[linked(prints[i], prints[i + apart], start[i])]
        us.append(prints[hit])
        vs.append(prints[hit + apart])
        found += len(hit)
        if found > 1_000_000:
            u, v = forest(np.concatenate(us), np.concatenate(vs))
            us, vs, found = [u], [v], 0
        apart += 1
    empty = np.zeros(0, np.uint64)
    u, v = forest(np.concatenate([*us, empty]), np.concatenate([*vs, empty]))
    return pa.RecordBatch.from_arrays(
        [pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], names=["u", "v"]
    )


def _find_links(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, group, fingerprint) in order of key and group, to forests of links."""
    held = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)]
    for batch in batches:
        held = [np.concatenate([h, c.to_numpy()]) for h, c in zip(held, batch.columns, strict=True)]
        keys, groups, prints = held
        if not len(keys):
            continue
        change = (keys[1:] != keys[:-1]) | (groups[1:] != groups[:-1])
        cut = int(np.flatnonzero(change)[-1]) + 1 if change.any() else 0
        if cut:
            yield _links_of_runs(keys[:cut], groups[:cut], prints[:cut].view(np.uint64))
            held = [h[cut:].copy() for h in held]
    if len(held[0]):
        yield _links_of_runs(held[0], held[1], held[2].view(np.uint64))


def fingerprint_links(distinct: DataFrame, block: int = BLOCK) -> DataFrame:
    """Links ``u``, ``v`` that connect whatever fingerprints are at most four bits apart.

    ``distinct`` has each fingerprint once. A key with more than ``block`` fingerprints is
    dealt into blocks, and every pair of blocks is a group of its own, so no group exceeds
    about two blocks and none is left out.
    """
    keyed = distinct.select(F.explode(ring_keys()).alias("key"), "fingerprint")
    crowded = (
        keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > block)
        .select("key", F.ceil(F.col("n") / block).alias("blocks"))
    )
    own = F.pmod(F.xxhash64("fingerprint"), F.col("blocks"))
    other = F.col("other")
    pair = F.least(own, other) * F.col("blocks") + F.greatest(own, other)
    others = F.sequence(F.lit(0).cast("bigint"), F.coalesce("blocks", F.lit(1).cast("bigint")) - 1)
    dealt = (
        keyed.join(crowded, "key", "left")
        .select("key", "fingerprint", "blocks", F.explode(others).alias("other"))
        .select("key", F.coalesce(pair, F.lit(0).cast("bigint")).alias("group"), "fingerprint")
    )
    return (
        dealt.repartition("key", "group")
        .sortWithinPartitions("key", "group")
        .mapInArrow(_find_links, "u bigint, v bigint")
    )


def connected(links: DataFrame, label: str = "links") -> DataFrame:
    """``node`` and ``root`` (its component's smallest node) of every node that has a link.

    Alternates two steps until nothing changes: every node links its larger neighbours to
    its smallest one, then its smaller neighbours. Each round is written to the shared
    folder, so a lost executor costs at most one round.
    """

    def signature(edges: DataFrame) -> tuple:
        return tuple(
            edges.agg(
                F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
            ).first()
        )

    high, low = F.greatest("u", "v"), F.least("u", "v")
    edges = stored(
        links.filter("u != v").select(high.alias("u"), low.alias("v")).distinct(), label
    )
    before = signature(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        least = least.select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), "m")
        large = large.select(F.greatest("u", "m").alias("u"), F.least("u", "m").alias("v"))
        large = large.filter("u != v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(least, "u").filter("v != m").select(F.col("v").alias("u"), "m")
        small = least.unionByName(moved).select("u", F.col("m").alias("v")).distinct()
        edges = stored(small, label)
        after = signature(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def _with_copies(
    rooted: DataFrame, prints: DataFrame, docs: DataFrame, similarity: float
) -> DataFrame:
    """``rooted`` with the components joined that a pair of similar texts connects."""
    of_text = prints.select("text_key", "fingerprint").distinct()
    sketches = stored(resemblance.sketches(docs).join(of_text, "text_key"), "sketches")
    sets: DataFrame | None = None
    for first, count, crossed in resemblance.PASSES:
        placed = sketches.join(rooted.select("fingerprint", "root"), "fingerprint")
        if sets is None:  # of all texts that any pass compares
            every = resemblance.candidates(placed, 0, resemblance.BANDS, False)
            wanted = stored(every.select("text_key").distinct(), "wanted")
            sets = stored(resemblance.shingle_sets(docs, wanted), "shingles")
        found = resemblance.candidates(placed, first, count, crossed)
        links = resemblance.similar(found, sets, similarity)
        merged = connected(links, "copies").select(F.col("node").alias("root"), F.col("root").alias("to"))
        rooted = stored(
            rooted.join(merged, "root", "left").select(
                "fingerprint", "least", F.coalesce("to", "root").alias("root")
            ),
            "rooted",
        )
    return rooted


def _members(
    docs: DataFrame, width: int, seed: int, block: int, similarity: float | None = None
) -> DataFrame:
    """``doc_id``, ``fingerprint``, ``root`` (a fingerprint) and ``component_id`` of every row."""
    names = ["doc_id", *([] if similarity is None else [resemblance.text_key()]), "text"]
    prints = stored(fingerprints(docs.select(*names), width, seed), "fingerprints")
    distinct = prints.groupBy("fingerprint").agg(F.min("doc_id").alias("least"))
    roots = connected(fingerprint_links(distinct.select("fingerprint"), block))
    rooted = distinct.join(
        roots.withColumnRenamed("node", "fingerprint"), "fingerprint", "left"
    ).select("fingerprint", "least", F.coalesce("root", "fingerprint").alias("root"))
    if similarity is not None:
        rooted = _with_copies(stored(rooted, "rooted"), prints, docs, similarity)
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    of_print = rooted.join(named, "root").select("fingerprint", "root", "component_id")
    return prints.join(of_print, "fingerprint").select(
        "doc_id", "fingerprint", "root", "component_id"
    )


def near_duplicates(
    docs: DataFrame, width: int = 4, seed: int = 42, block: int = BLOCK
) -> DataFrame:
    """``doc_id``, ``fingerprint`` (bigint) and ``component_id`` of every row.

    The component id is the smallest document id that links lead to, the row's own
    included. Null and empty texts have fingerprint 0 and are linked like any other. A
    null id is a component id only if its component has no other; repeated rows and ids
    stay as they are; an empty table gives an empty result; other columns are ignored.
    """
    return _members(docs, width, seed, block).drop("root")


def one_of_each(
    docs: DataFrame,
    width: int = 4,
    seed: int = 42,
    block: int = BLOCK,
    similarity: float | None = None,
) -> DataFrame:
    """The documents without near-duplicates of another: one row of each component stays.

    With a ``similarity``, texts are linked too whose five-word shingles are as similar.

    It is the row with the component's id. If several rows of the component have it, the
    one whose text hash is smallest stays; of rows equal in that, any one. The columns are
    those of ``docs``.
    """
    found = stored(_members(docs, width, seed, block, similarity), "members")
    own = F.col("doc_id").eqNullSafe(F.col("component_id"))
    kept_id = free_name(docs, "_kept_id")
    keepers = found.filter(own).select(F.col("doc_id").alias(kept_id)).distinct()
    kept = docs.join(keepers, docs["doc_id"].eqNullSafe(F.col(kept_id)), "left_semi")
    repeated = found.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("rows"), F.max(own.cast("int")).alias("own")
    )
    if repeated.filter("rows > 1 and own = 1").isEmpty():
        return kept
    # An id stands for several rows: tell them apart by fingerprint, take one per component.
    rows = kept.select(F.struct(*kept.columns).alias("row"), "doc_id", "text")
    prints = fingerprints(rows, width, seed).withColumnRenamed("doc_id", "_kept_id")
    named = found.filter(own).select("doc_id", "fingerprint", "root").distinct()
    matched = named.join(
        prints.withColumnRenamed("fingerprint", "_print"),
        F.col("doc_id").eqNullSafe(F.col("_kept_id")) & (F.col("fingerprint") == F.col("_print")),
    )
    first = F.min_by("row", F.xxhash64("row.text"))
    return matched.groupBy("root").agg(first.alias("row")).select("row.*")
