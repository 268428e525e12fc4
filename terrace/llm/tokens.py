"""Token ids in Parquet: list columns that can be read selectively.

Documents are sorted over all files (by id, or by an order the caller names) and encoded
where they are written. A file row has the id of the document, its tokens, how many they
are, and where they start in the stream of its file part; the start in the stream of all
documents follows from the sums of the parts before. Token lists are dictionary-encoded,
or delta-encoded on demand; row groups and pages have set sizes, and the column and offset
indexes let a reader skip to the pages of a range of ids. What reads only the other columns
never touches the tokens.
"""

from __future__ import annotations

import codecs
import itertools
import json
import zlib
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace.llm import pretokens
from terrace.llm.common import text_slices
from terrace.sources.scratch import scratch_path

END_ID = 0
ROW_GROUP_BYTES, PAGE_BYTES, PAGE_ROWS = 32 << 20, 256 << 10, 2000
def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


#: The character that stands for each byte in a byte-level vocabulary: itself where it is
#: printable, else one of those from 256 on, in order.
_PRINTABLE = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
_OTHERS = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _PRINTABLE)}
_BYTES = "".join(chr(_OTHERS.get(b, b)) for b in range(256))


def _matches(pattern: str, text: str) -> list[str]:
    """One-character matches, by the regular expressions that the library splits texts with."""
    from tokenizers import Regex, pre_tokenizers

    kept = np.ones(len(text), bool)
    for _, (start, end) in pre_tokenizers.Split(Regex(pattern), "removed").pre_tokenize_str(text):
        kept[start:end] = False  # these runs do not match
    return [text[i] for i in np.flatnonzero(kept)]


def class_table() -> np.ndarray:
    """Classes of all code points, by the library's own edition of Unicode; a megabyte."""
    return pretokens.class_table(*pretokens.masks(_matches))


def splits_like_pretokens(parts: dict) -> bool:
    """Whether a tokenizer file is byte-level with the common pattern, and nothing else."""
    before, model = parts.get("pre_tokenizer") or {}, parts["model"]
    return (
        model.get("type") == "BPE"
        and before.get("type") == "ByteLevel"
        and before.get("use_regex", True)
        and not (before.get("add_prefix_space") or parts.get("normalizer"))
        and not (model.get("ignore_merges") or model.get("dropout"))
    )


class Encoder:
    """Ids of whole texts, as the tokenizer of a file gives them.

    Pieces are found by :mod:`pretokens` and merged by the library's model, each distinct one
    once as long as it is remembered. A text with one of the tokenizer's added tokens goes to
    the tokenizer as it is, and so do all texts if it is of another kind.
    """

    def __init__(
        self, content: str, table: np.ndarray | None, remembered: int = pretokens.REMEMBERED
    ) -> None:
        from tokenizers import Tokenizer, models

        self.tokenizer, parts = Tokenizer.from_str(content), json.loads(content)
        self.added = [t["content"] for t in parts.get("added_tokens") or []]
        self.pieces: pretokens.PieceIds | None = None
        if table is not None and splits_like_pretokens(parts):
            model = parts["model"]
            merges = [tuple(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
            # Pieces are remembered here, so the model need not keep them as well.
            merge = models.BPE(vocab=model["vocab"], merges=merges, cache_capacity=0).tokenize

            def ids(some: list[bytes]) -> tuple[list[int], Iterable[int]]:
                text = codecs.charmap_decode(b"".join(some), "strict", _BYTES)[0]
                ends = itertools.accumulate(map(len, some), initial=0)
                found = [merge(text[a:b]) for a, b in itertools.pairwise(ends)]
                return [t.id for own in found for t in own], map(len, found)

            self.pieces = pretokens.PieceIds(table, ids, remembered)

    def whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: pa.Array) -> pa.ListArray:
        """The ids of every text and the end id; a null text has the end id only."""
        texts = pc.fill_null(texts, "")
        apart = np.full(len(texts), self.pieces is None)
        for token in self.added:
            apart |= pc.match_substring(texts, token).to_numpy(zero_copy_only=False)
        rest = np.flatnonzero(apart)
        own = self.whole(texts.take(pa.array(rest)).to_pylist())
        if self.pieces is None:
            ends, ids = np.zeros(len(texts) + 1, np.int64), np.zeros(0, np.int32)
        else:
            ends, ids = self.pieces.encode(pc.if_else(pa.array(apart), "", texts) if len(rest) else texts)
        totals = np.diff(ends)
        totals[rest] = [len(x) for x in own]
        offsets = np.append(0, np.cumsum(totals + 1))
        out = np.full(offsets[-1], END_ID, np.int32)
        taken = np.zeros(len(out), bool)
        taken[offsets[1:] - 1] = True
        for i, found in zip(rest, own, strict=True):
            out[offsets[i] : offsets[i] + len(found)] = found
            taken[offsets[i] : offsets[i] + len(found)] = True
        out[~taken] = ids
        return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(out))


#: The worker's encoder, by the content of its file; it lives as long as the worker.
_encoders: dict[str, Encoder] = {}


def shared_encoder(spark: SparkSession, path: str):
    """A function that gives a worker its encoder. The driver alone reads the file, and sends it
    with the class table: two megabytes or so, whatever the documents are."""
    with open(path, encoding="utf-8") as f:
        content = f.read()
    plain = splits_like_pretokens(json.loads(content))
    sent = spark.sparkContext.broadcast((content, class_table() if plain else None))

    def encoder() -> Encoder:
        content, table = sent.value
        if content not in _encoders:
            _encoders.clear()
            _encoders[content] = Encoder(content, table)
        return _encoders[content]

    return encoder


def encoded(docs: DataFrame, order: Sequence[Column], tokenizer: str | None = None) -> DataFrame:
    """``doc_id``, ``part``, ``part_start``, ``n_tokens`` and ``ids``, sorted over all partitions.

    ``part_start`` is the number of ids before the document in its partition.
    """
    own = shared_encoder(docs.sparkSession, tokenizer or default_tokenizer())
    schema = T.StructType(
        [
            docs.schema["doc_id"],
            T.StructField("part", T.IntegerType()),
            T.StructField("part_start", T.LongType()),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("ids", T.ArrayType(T.IntegerType())),
        ]
    )

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, done, tokens = TaskContext.get().partitionId(), 0, own()
        for batch in text_slices(batches, "text", 4 << 20):
            ids = tokens.encode(batch.column("text"))
            n = pc.list_value_length(ids).to_numpy().astype(np.int64)
            starts = done + np.cumsum(n) - n
            done += int(n.sum())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.full(len(n), part, np.int32)),
                 pa.array(starts), pa.array(n), ids],
                names=schema.names,
            )

    # Ties of the order are told apart by a hash of the text; so are their partitions.
    ranked = docs.sort(*order, F.xxhash64("text"))
    return ranked.select("doc_id", "text").mapInArrow(encode, schema)


def write_tokens(
    docs: DataFrame,
    path: str,
    order: Sequence[Column] | None = None,
    tokenizer: str | None = None,
    delta: bool = False,
    row_group_bytes: int = ROW_GROUP_BYTES,
    page_bytes: int = PAGE_BYTES,
    page_rows: int = PAGE_ROWS,
) -> None:
    """Write the token files of the documents, in ascending order of id if none is named.

    Lists are dictionary-encoded; with ``delta`` binary-packed differences instead. A null
    text is like an empty one: the end id alone. A null id comes first; repeated rows are
    repeated; an empty table gives files without rows; other columns are ignored.
    """
    options = {
        "parquet.block.size": row_group_bytes,
        "parquet.page.size": page_bytes,
        "parquet.page.row.count.limit": page_rows,
        "parquet.writer.version": "v2" if delta else "v1",
        "parquet.enable.dictionary#ids.list.element": str(not delta).lower(),
        "compression": "zstd",
    }
    rows = encoded(docs, order or [F.col("doc_id")], tokenizer)
    rows.write.options(**{k: str(v) for k, v in options.items()}).parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id``, ``start`` (ids of all documents before), ``n_tokens`` and ``ids``.

    Columns that are not asked for are not read.
    """
    files = spark.read.parquet(path)
    # One row a part, so these windows are small.
    sums = files.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    # A row a part, of which a job has as many as it has tasks; so the tokens stay in place.
    return files.join(F.broadcast(offsets), "part").select(
        "doc_id", (F.col("offset") + F.col("part_start")).alias("start"), "n_tokens", "ids"
    )


def checksums(tokens: DataFrame) -> DataFrame:
    """Replaces ``ids`` by ``ids_crc32``: CRC-32 of the ids as little-endian 32-bit integers."""
    schema = T.StructType(
        [*[f for f in tokens.schema if f.name != "ids"], T.StructField("ids_crc32", T.LongType())]
    )

    def check(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            *columns, ids = batch.columns
            ends = ids.offsets.to_numpy()
            flat = np.ascontiguousarray(ids.values.to_numpy(), "<i4")
            sums = [zlib.crc32(flat[a:b]) for a, b in itertools.pairwise(ends.tolist())]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(sums, pa.int64())], names=schema.names)

    return tokens.select(*schema.names[:-1], "ids").mapInArrow(check, schema)


def stored_tokens(
    docs: DataFrame, order: Sequence[Column] | None = None, path: str | None = None, **how
) -> DataFrame:
    """Write the files, to the shared scratch folder if no path is named, and read them back."""
    path = path or scratch_path(docs.sparkSession, "tokens")
    write_tokens(docs, path, order, **how)
    return read_tokens(docs.sparkSession, path)
