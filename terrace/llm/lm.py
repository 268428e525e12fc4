"""Language-model scores by deleted interpolation of n-gram estimates.

The probability of a token is a mixture of the maximum-likelihood estimates of all orders
and the uniform one. The mixture weights depend on how often the context was seen, in
buckets of powers of two, and are learned by expectation-maximisation on held-out counts:
a part of the training documents is held out, the weights that fit it best with the counts
of the rest are found, and scoring uses these weights with the counts of both parts.

Counts grow with the corpus, so they are never brought to one place. Documents are dealt
into chunks. A chunk sends each of its distinct n-grams once, as sorted 64-bit hashes cut
into ranges ("shards"); a shard sums up the counts of all chunks and answers every chunk
in the order in which it asked; the chunk reads its texts again and scores them. What is
shuffled is one number per distinct n-gram and chunk, so the hottest n-gram of all weighs
as much as any other.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace.llm.common import fold, stored

ORDER, FOLDS = 2, 10
#: Characters of a chunk and of the texts behind a shard, about.
CHUNK_CHARS, SHARD_CHARS = 5_000_000, 6_000_000
#: Roles of a document: scored only, held out for the weights, counted.
SCORED, HELD, COUNTED = 0, 1, 2
#: Steps to the power of two in which ratios of estimates enter the weights' fit.
STEPS = 8
#: Added to every count of the base score.
ADD = 0.1

END, START = 0x5BD1E9955BD1E995, 0x2545F4914F6CDD1D
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_ONE, _SHIFT = np.uint64(1), np.uint64(29)


def _mix(context: np.ndarray, token: np.ndarray) -> np.ndarray:
    x = (context * _A) ^ (token + _B)
    x = (x ^ (x >> _SHIFT)) * _B
    return (x ^ (x >> _SHIFT)) & ~_ONE  # even: odd ones are single tokens


@dataclass
class Grams:
    """The n-grams of some texts; every text starts with a start mark and ends with an end.

    ``keys`` are the distinct hashes in order, ``counts`` how often each occurs, ``at[k]``
    the place in ``keys`` of the gram of ``k + 1`` tokens that ends at each position, and
    ``first`` the positions of the start marks, with the number of positions at the end.
    """

    keys: np.ndarray
    counts: np.ndarray
    at: list[np.ndarray]
    first: np.ndarray


def grams(texts: pa.ChunkedArray | pa.Array, order: int) -> Grams:
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    distinct: dict[bytes, int] = {}
    places = []
    for start in range(0, len(texts), 64):
        for text in texts.slice(start, 64).cast(pa.binary()).to_pylist():
            words = (text or b"").lower().split()
            index = (distinct.setdefault(w, len(distinct)) for w in words)
            places.append(np.fromiter(index, np.int32, len(words)))
    sizes = np.array([len(own) for own in places], np.int64)
    hashes = np.array([xxhash.xxh64_intdigest(w) for w in distinct] or [0], np.uint64) | _ONE
    first = np.concatenate([[0], np.cumsum(sizes + 2)])
    tokens = np.empty(first[-1], np.uint64)
    inner = np.ones(first[-1], bool)
    inner[first[:-1]] = False
    inner[first[1:] - 1] = False
    tokens[inner] = hashes[np.concatenate([*places, np.zeros(0, np.int32)])]
    tokens[first[1:] - 1] = np.uint64(END | 1)
    tokens[first[:-1]] = np.uint64(START & ~1)
    layers, below = [tokens], tokens
    for _ in range(1, order):
        context = np.empty_like(below)
        context[1:] = below[:-1]
        context[first[:-1]] = np.uint64(START & ~1)
        below = _mix(context, tokens)
        layers.append(below)
    keys, inverse, counts = np.unique(
        np.concatenate(layers), return_inverse=True, return_counts=True
    )
    return Grams(keys, counts, np.split(inverse, order), first)


def _cuts(keys: np.ndarray, shards: int) -> np.ndarray:
    """Where the sorted keys of each shard end; shards are equal ranges of the hashes."""
    ends = [((s + 1) << 64) // shards for s in range(shards - 1)]
    return np.append(np.searchsorted(keys, np.array(ends, np.uint64)), len(keys))


REQUEST = "shard int, chunk bigint, role int, keys array<bigint>, counts array<int>"
ANSWER = (
    "shard int, chunk bigint, rest array<int>, all array<int>, sizes array<bigint>,"
    " rest_wide array<bigint>, all_wide array<bigint>"
)
#: The largest count that is answered in 32 bits; a shard with a larger one answers in 64.
NARROW = np.iinfo(np.int32).max


def requests(chunked: DataFrame, order: int, shards: int) -> DataFrame:
    """What each chunk asks of each shard: its distinct n-grams there, and their counts."""

    def ask(table: pa.Table) -> pa.Table:
        found = grams(table["text"], order)
        ends = _cuts(found.keys, shards)
        parts = np.flatnonzero(np.diff(ends, prepend=0))
        offsets = pa.array(np.append(0, ends[parts]).astype(np.int32))
        chunk, role = table["chunk"][0].as_py(), table["role"][0].as_py()
        return pa.table(
            {
                "shard": pa.array(parts, pa.int32()),
                "chunk": pa.array([chunk] * len(parts), pa.int64()),
                "role": pa.array([role] * len(parts), pa.int32()),
                "keys": pa.ListArray.from_arrays(offsets, pa.array(found.keys.view(np.int64))),
                "counts": pa.ListArray.from_arrays(
                    offsets, pa.array(found.counts.astype(np.int32))
                ),
            }
        )

    return chunked.groupBy("chunk").applyInArrow(ask, REQUEST)


def answers(asked: DataFrame) -> DataFrame:
    """Per request the counts in ``all`` training documents, and in ``rest``, the counted ones.

    ``rest`` is empty for requests of documents that are not held out. A shard with a count
    beyond 32 bits has its answers in ``all_wide`` and ``rest_wide``; else these are empty.

    One more row a shard, of chunk -1, has in ``sizes`` the tokens and their types, of the
    counted documents and of all training ones.
    """

    def sum_up(table: pa.Table) -> pa.Table:
        keys = table["keys"].combine_chunks()
        counts = table["counts"].combine_chunks().flatten().to_numpy()
        role = np.repeat(table["role"].to_numpy(), pc.list_value_length(keys).to_numpy())
        flat = keys.flatten().to_numpy().view(np.uint64)
        distinct, inverse = np.unique(flat, return_inverse=True)
        # Sums of doubles, which hold whole numbers up to 2**53.
        rest = np.bincount(inverse, np.where(role == COUNTED, counts, 0), len(distinct)).astype(np.int64)
        both = np.bincount(inverse, np.where(role == SCORED, 0, counts), len(distinct)).astype(np.int64)
        token = (distinct & _ONE) == 1
        lengths = pc.list_value_length(keys).to_numpy()
        offsets = pa.array(np.append(np.append(0, np.cumsum(lengths)), len(flat)).astype(np.int32))
        n = len(lengths)
        wide = bool(both.max(initial=0) > NARROW)

        def lists(ends: pa.Array, values: np.ndarray) -> list[pa.Array]:
            """Narrow and wide lists, of which one kind is empty."""
            none = pa.array([[]] * (n + 1), pa.list_(pa.int32() if wide else pa.int64()))
            kind = np.int64 if wide else np.int32
            full = pa.ListArray.from_arrays(ends, pa.array(values.astype(kind)))
            return [none, full] if wide else [full, none]

        answer, answer_wide = lists(offsets, both[inverse])
        # Only what is held out is ever estimated without itself.
        held = table["role"].to_numpy() == HELD
        own = np.where(held, lengths, 0)
        part = rest[inverse[np.repeat(held, lengths)]]
        ends = np.append(np.append(0, np.cumsum(own)), len(part)).astype(np.int32)
        without, without_wide = lists(pa.array(ends), part)
        sizes = [f(x[token]) for x in (rest, both) for f in (np.sum, np.count_nonzero)]
        return pa.table(
            {
                "shard": pa.array([table["shard"][0].as_py()] * (n + 1), pa.int32()),
                "chunk": pa.array(np.append(table["chunk"].to_numpy(), -1), pa.int64()),
                "rest": without,
                "all": answer,
                "sizes": pa.array([None] * n + [[int(x) for x in sizes]], pa.list_(pa.int64())),
                "rest_wide": without_wide,
                "all_wide": answer_wide,
            }
        )

    return asked.groupBy("shard").applyInArrow(sum_up, ANSWER)


def _aligned(found: Grams, replies: pa.Table, column: str) -> np.ndarray:
    """The answered counts in the order of the chunk's keys."""
    replies = replies.sort_by("shard")
    parts = [np.zeros(0, np.int64)]
    for narrow, wide in zip(replies[column], replies[f"{column}_wide"], strict=True):
        parts += [x.values.to_numpy() for x in (narrow, wide)]
    flat = np.concatenate(parts)
    if len(flat) != len(found.keys):
        raise ValueError(f"asked for {len(found.keys)} n-grams, got {len(flat)}")
    return flat


def estimates(
    found: Grams, counts: np.ndarray, tokens: int, types: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per event (position that is no start mark): estimates by order, bucket, and its places.

    Row 0 is the uniform estimate, row k the relative frequency after k - 1 tokens; it is
    0 where the context was never seen. The bucket is that of the longest context's count.
    """
    events = np.ones(found.first[-1], bool)
    events[found.first[:-1]] = False
    events = np.flatnonzero(events)
    rows = [np.full(len(events), 1 / (types + 1)), counts[found.at[0][events]] / max(tokens, 1)]
    context = np.full(len(events), tokens, np.int64)
    for k in range(1, len(found.at)):
        context = counts[found.at[k - 1][events - 1]].astype(np.int64)
        rows.append(counts[found.at[k][events]] / np.maximum(context, 1))
    bucket = np.zeros(len(events), np.int64)
    seen = context > 0
    bucket[seen] = np.floor(np.log2(context[seen])).astype(np.int64) + 1
    return np.stack(rows), bucket, events


def _coded(rows: np.ndarray, bucket: np.ndarray) -> np.ndarray:
    """One number for the bucket and the ratios of the estimates to the uniform one."""
    code = bucket.copy()
    for row in rows[1:]:
        ratio = np.where(row > 0, row, rows[0]) / rows[0]
        step = np.clip(np.rint(STEPS * np.log2(ratio)), -500, 500).astype(np.int64) + 501
        code = code * 1024 + np.where(row > 0, step, 0)
    return code


def learn_weights(codes: np.ndarray, n: np.ndarray, order: int, rounds: int = 60) -> np.ndarray:
    """Row per bucket: weights of the uniform estimate and of the orders, by EM.

    Buckets that the held-out part never shows take the weights of the nearest one below
    that it does, or else those learned over all buckets together.
    """
    ratios = np.ones((order + 1, len(codes)))
    left = codes.copy()
    for k in range(order, 0, -1):
        step = left % 1024
        ratios[k] = np.where(step > 0, 2.0 ** ((step - 501) / STEPS), 0.0)
        left //= 1024

    def climb(rows: np.ndarray) -> np.ndarray:
        w = np.full(order + 1, 1 / (order + 1))
        for _ in range(rounds):
            share = w[:, None] * ratios[:, rows]
            share /= share.sum(axis=0)
            w = (share * n[rows]).sum(axis=1) / n[rows].sum()
            w = np.maximum(w, 1e-6)
            w /= w.sum()
        return w

    weights = np.full((65, order + 1), 1 / (order + 1))
    if len(codes):
        weights[:] = climb(np.arange(len(codes)))
    for b in range(65):
        if (own := np.flatnonzero(left == b)).size:
            weights[b:] = climb(own)
    return weights


def scored(
    docs: DataFrame,
    order: int = ORDER,
    folds: int = FOLDS,
    chunk_chars: int = CHUNK_CHARS,
    shard_chars: int = SHARD_CHARS,
) -> DataFrame:
    """``doc_id``, ``held_out``, token counts, ``base_score`` and ``score`` of every row.

    Fold 0 is scored only; fold 1 is held out for the mixture weights; the others are
    counted. Null and empty texts are one end token. Without training documents the model
    is uniform over one type, so every score is 0. Repeated rows each count and have their
    row; an empty table gives an empty result; other columns are ignored.
    """
    spark = docs.sparkSession
    part = fold("doc_id", folds)
    role = F.when(part == 0, SCORED).when(part == 1, HELD).otherwise(COUNTED)
    sizes = docs.groupBy(role.alias("role")).agg(
        F.sum(F.coalesce(F.char_length("text"), F.lit(0)) + 1).alias("chars")
    )
    chars = dict(map(tuple, sizes.collect()))
    chunks = {r: 1 + chars.get(r, 0) // chunk_chars for r in (SCORED, HELD, COUNTED)}
    shards = 1 + sum(chars.values()) // shard_chars
    spread = F.create_map(*[F.lit(x) for r, n in chunks.items() for x in (r, n)])
    base = F.create_map(
        *[F.lit(x) for r in chunks for x in (r, sum(n for q, n in chunks.items() if q < r))]
    )
    own = F.pmod(F.xxhash64("doc_id", "text"), F.element_at(spread, F.col("role")).cast("bigint"))
    chunked = docs.select("doc_id", "text", (part == 0).alias("held_out"), role.alias("role"))
    chunked = chunked.withColumn("chunk", own + F.element_at(base, F.col("role")))
    answered = stored(answers(requests(chunked.select("chunk", "role", "text"), order, shards)), "ngram_counts")
    total = answered.filter("chunk = -1").agg(*[F.sum(F.get("sizes", F.lit(i))) for i in range(4)])
    rest_tokens, rest_types, tokens, types = (int(x or 0) for x in total.first())
    replies = answered.filter("chunk >= 0").drop("sizes")

    def histogram(texts: pa.Table, counts: pa.Table) -> pa.Table:
        found = grams(texts["text"], order)
        rows, bucket, _ = estimates(found, _aligned(found, counts, "rest"), rest_tokens, rest_types)
        codes, n = np.unique(_coded(rows, bucket), return_counts=True)
        return pa.table({"code": pa.array(codes, pa.int64()), "n": pa.array(n, pa.int64())})

    held = chunked.filter(F.col("role") == HELD).select("chunk", "text")
    low = chunks[SCORED]
    asked = replies.filter((F.col("chunk") >= low) & (F.col("chunk") < low + chunks[HELD]))
    seen = (
        held.groupBy("chunk").cogroup(asked.groupBy("chunk"))
        .applyInArrow(histogram, "code bigint, n bigint")
        .groupBy("code").agg(F.sum("n").alias("n"))
        .toArrow()  # bounded by the grid of buckets and ratios
    )
    weights = learn_weights(
        seen["code"].to_numpy().astype(np.int64), seen["n"].to_numpy().astype(float), order
    )
    shared = spark.sparkContext.broadcast(weights)
    schema = T.StructType(
        [
            docs.schema["doc_id"],
            T.StructField("held_out", T.BooleanType()),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("n_known", T.LongType()),
            T.StructField("train_tokens", T.LongType()),
            T.StructField("base_score", T.DoubleType()),
            T.StructField("score", T.DoubleType()),
        ]
    )

    def score(texts: pa.Table, counts: pa.Table) -> pa.Table:
        found = grams(texts["text"], order)
        trained = _aligned(found, counts, "all")
        rows, bucket, events = estimates(found, trained, tokens, types)
        mixture = (shared.value[bucket].T * rows).sum(axis=0)
        single = trained[found.at[0][events]]
        base = np.log10((single + ADD) / (tokens + ADD * (types + 1)))
        ends = np.cumsum(np.diff(found.first) - 1)
        starts = np.append(0, ends[:-1])
        sums = [
            np.add.reduceat(x, starts) if len(starts) else np.zeros(0)
            for x in (base, np.log10(mixture), (single > 0).astype(np.int64))
        ]
        return pa.table(
            {
                "doc_id": texts["doc_id"],
                "held_out": texts["held_out"],
                "n_tokens": pa.array(ends - starts, pa.int64()),
                "n_known": pa.array(sums[2], pa.int64()),
                "train_tokens": pa.array([tokens] * len(starts), pa.int64()),
                "base_score": pa.array(sums[0], pa.float64()),
                "score": pa.array(sums[1], pa.float64()),
            }
        )

    return (
        chunked.select("chunk", "doc_id", "held_out", "text")
        .groupBy("chunk").cogroup(replies.drop("rest", "rest_wide").groupBy("chunk"))
        .applyInArrow(score, schema)
    )
