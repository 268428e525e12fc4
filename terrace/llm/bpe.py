"""Byte-level BPE with rank files: texts to ids and ids back to bytes.

Pieces come from :mod:`pretokens`. A batch has each distinct piece once, a worker
remembers the ids of those it has merged, and ids back to bytes are slices of one array
of all tokens' bytes.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import itertools
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from terrace.llm import pretokens
from terrace.llm.common import slices, text_slices

#: Lists of ids that are decoded at once.
ROWS = 500


def default_ranks() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def read_ranks(content: bytes) -> dict[bytes, int]:
    """Token bytes to rank, from the lines of a rank file."""
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, content.splitlines())}


def _encoding(pattern: str, ranks: dict[bytes, int]):
    import tiktoken

    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


@functools.cache
def _prober(pattern: str):
    return _encoding(pattern, {bytes([b]): b for b in range(256)})


def _matches(pattern: str, text: str) -> str:
    return bytes(_prober(pattern).encode_ordinary(text)).decode()


def class_table() -> np.ndarray:
    """Classes of all code points, by the library's own edition of Unicode; a megabyte."""
    return pretokens.class_table(*pretokens.masks(_matches))


class Codec:
    """Ids of texts and bytes of ids."""

    def __init__(
        self, ranks: dict[bytes, int], table: np.ndarray, remembered: int = pretokens.REMEMBERED
    ) -> None:
        # A piece is not split again.
        merge = _encoding("(?s:.+)", ranks)._encode_single_piece

        def merged(some: list[bytes]) -> tuple[list[int], Iterable[int]]:
            found = list(map(merge, some))
            return list(itertools.chain.from_iterable(found)), map(len, found)

        self.pieces = pretokens.PieceIds(table, merged, remembered)
        tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        self.tokens = pa.array(tokens, pa.large_binary())

    def encode(self, texts: pa.Array) -> pa.LargeListArray:
        """A list of ids for every text; none for a null or empty one."""
        ends, ids = self.pieces.encode(texts.fill_null(""))
        return pa.LargeListArray.from_arrays(pa.array(ends), pa.array(ids))

    def decode(self, ids: pa.LargeListArray) -> pa.Array:
        """The bytes that each list of ids stands for."""
        tokens = self.tokens.take(ids.flatten())
        ends = np.frombuffer(tokens.buffers()[1], np.int64)[: len(tokens) + 1]
        offsets = ends[ids.offsets.to_numpy() - ids.offsets[0].as_py()]
        return pa.Array.from_buffers(
            pa.large_binary(), len(ids), [None, pa.py_buffer(offsets), tokens.buffers()[2]]
        )


#: The worker's codec, by the content of its rank file; it lives as long as the worker.
_codecs: dict[bytes, Codec] = {}


def _shared_codec(docs: DataFrame, ranks: str | None):
    """A function that gives a worker its codec. The rank file is read by the driver alone
    and sent with the class table: two files of bounded size, whatever the table's."""
    with open(ranks or default_ranks(), "rb") as f:
        sent = docs.sparkSession.sparkContext.broadcast((f.read(), class_table()))

    def codec() -> Codec:
        content, table = sent.value
        if content not in _codecs:
            _codecs.clear()
            _codecs[content] = Codec(read_ranks(content), table)
        return _codecs[content]

    return codec


def encoded(docs: DataFrame, ranks: str | None = None) -> DataFrame:
    """``doc_id`` and ``ids`` of every row.

    Null and empty texts have no ids; null and repeated ids and rows stay as they are; an
    empty table gives an empty result; other columns are ignored.
    """
    schema = T.StructType([docs.schema["doc_id"], T.StructField("ids", T.ArrayType(T.IntegerType()))])
    codec = _shared_codec(docs, ranks)

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec()
        for batch in text_slices(batches, "text"):
            ids = own.encode(batch.column("text")).cast(pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), ids], names=schema.names)

    return docs.select("doc_id", "text").mapInArrow(encode, schema)


def decoded(ids: DataFrame, ranks: str | None = None) -> DataFrame:
    """``ids`` becomes ``bytes`` (binary), the bytes they stand for; a null list has none."""
    fields = [f for f in ids.schema if f.name != "ids"]
    schema = T.StructType([*fields, T.StructField("bytes", T.BinaryType())])
    codec = _shared_codec(ids, ranks)

    def decode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec()
        for batch in slices(batches, ROWS):
            *columns, lists = batch.columns
            lists = lists.cast(pa.large_list(pa.int32()))
            plain = pa.LargeListArray.from_arrays(_ends(lists), lists.flatten())
            found = own.decode(plain).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([*columns, found], names=schema.names)

    return ids.select(*[f.name for f in fields], "ids").mapInArrow(decode, schema)


def _ends(lists: pa.LargeListArray) -> pa.Array:
    sizes = lists.value_lengths().fill_null(0).to_numpy()
    return pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64))


def digests(docs: DataFrame, ranks: str | None = None) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids_sha256`` and ``decoded_sha256`` of every row.

    The first digest is that of the ids as little-endian 32-bit integers, the second that
    of the bytes the ids decode to. Both are taken where the ids are made, so these are
    never moved. Rows are treated as by :func:`encoded`.
    """
    schema = T.StructType(
        [
            docs.schema["doc_id"],
            T.StructField("n_tokens", T.LongType()),
            T.StructField("ids_sha256", T.StringType()),
            T.StructField("decoded_sha256", T.StringType()),
        ]
    )
    codec = _shared_codec(docs, ranks)

    def sha256(data: memoryview, ends: list[int]) -> list[str]:
        return [hashlib.sha256(data[a:b]).hexdigest() for a, b in itertools.pairwise(ends)]

    def digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec()
        for batch in text_slices(batches, "text"):
            ids = own.encode(batch.column("text"))
            back = own.decode(ids)
            ends = ids.offsets.to_numpy()
            flat = memoryview(np.ascontiguousarray(ids.values.to_numpy(), "<u4")).cast("B")
            text_ends = np.frombuffer(back.buffers()[1], np.int64)[: len(back) + 1]
            text = memoryview(back.buffers()[2] or b"")
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.diff(ends)),
                 pa.array(sha256(flat, (4 * ends).tolist())),
                 pa.array(sha256(text, text_ends.tolist()))],
                names=schema.names,
            )

    return docs.select("doc_id", "text").mapInArrow(digest, schema)
