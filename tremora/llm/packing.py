"""Packing documents into sequences: first-fit decreasing in randomised groups.

Each document is tokenised whole and cut into pieces of the sequence length; only its last, shorter
piece is packed. Documents are dealt into groups by a seeded hash of their id, a group is packed by
itself: its pieces, longest first, each go to the first bin with room, which a tournament tree over
the bins' free space finds in logarithmic time. Groups hold about ``group_docs`` documents, however
many there are, so a group fits in one task and groups run side by side.

Defined cases: a null or empty text is the end id alone; ties in length go by id, then by place;
repeated rows are packed once each; documents without id share the hash of null, and are spread by
their content; further input columns are not read; an empty table gives an empty table.
"""

import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tremora.llm.common import row_key, small_batches, texts

#: Documents of a packing group, about; a power of two.
GROUP_DOCS = 4096


class ByteTokenizer:
    """Ids of a byte-level BPE file, as the tokenizers library gives them.

    ``ranks``: the same vocabulary as a rank file, and ``pattern`` the pattern that belongs to it:
    with them a text is encoded whole by a faster library that gives the same ids (a test compares
    both on every code point). A text with the mark of a special token always goes to the first.
    """

    def __init__(self, path: str, ranks: str | None = None, pattern: str | None = None) -> None:
        from tokenizers import Tokenizer
        self.tool = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tool.get_added_tokens_decoder().values()]
        self.plain = self._library
        if ranks:
            import base64

            import tiktoken
            with open(ranks, "rb") as file:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
            self.plain = tiktoken.Encoding("texts", pat_str=pattern, mergeable_ranks=table,
                                           special_tokens={}).encode_ordinary

    def _library(self, text: str) -> list[int]:
        return self.tool.encode(text, add_special_tokens=False).ids

    def encode(self, text: str) -> bytes:
        """Ids as little-endian bytes."""
        marked = any(mark in text for mark in self.special)
        return np.array((self._library if marked else self.plain)(text), "<u4").tobytes()


@lru_cache(maxsize=2)
def tokenizer(path: str, ranks: str | None, pattern: str | None) -> ByteTokenizer:
    return ByteTokenizer(path, ranks, pattern)


class Tournament:
    """Free space of bins in a complete tree; each inner node holds the larger of its two."""

    def __init__(self, bins: int, capacity: int) -> None:
        self.leaves = 1 << max(0, bins - 1).bit_length()
        self.free = [capacity] * (2 * self.leaves)

    def first_fit(self, size: int) -> tuple[int, int]:
        """Put ``size`` into the first bin that has room: its number, and the offset there."""
        free, at = self.free, 1
        while at < self.leaves:
            at *= 2
            if free[at] < size:
                at += 1
        return at - self.leaves, at

    def take(self, at: int, size: int) -> None:
        free = self.free
        free[at] -= size
        while at > 1:
            at >>= 1
            best = max(free[2 * at], free[2 * at + 1])
            if free[at] == best:
                break
            free[at] = best


def first_fit_decreasing(lengths: list[int], capacity: int) -> list[tuple[int, int]]:
    """For each length in the given order, longest first: its bin and its offset in the bin."""
    tree, out = Tournament(len(lengths), capacity), []
    for size in lengths:
        number, at = tree.first_fit(size)
        out.append((number, capacity - tree.free[at]))
        tree.take(at, size)
    return out


def token_pieces(docs: DataFrame, path: str, end_id: int, capacity: int = 2048,
                 ranks: str | None = None, pattern: str | None = None, id_col: str = "doc_id",
                 text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Pieces of at most ``capacity`` ids: ``doc_id, start, length, ids_crc32, doc_tokens, part``
    (a seeded hash for grouping), and with ``with_ids`` the ids themselves."""
    small_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType
    end = np.array([end_id], "<u4").tobytes()
    width = 4 * capacity

    def run(batches):
        tool = tokenizer(path, ranks, pattern)
        for batch in batches:
            origin, cols = [], [[] for _ in range(5)]
            for row, text in enumerate(batch.column(1).to_pylist()):
                data = tool.encode(text) + end
                for at in range(0, len(data), width):
                    piece = data[at:at + width]
                    origin.append(row)
                    for col, value in zip(cols, (at // 4, len(piece) // 4, zlib.crc32(piece),
                                                 len(data) // 4, piece)):
                        col.append(value)
            taken = batch.select(["doc_id", "part"]).take(pa.array(origin, pa.int32()))
            arrays = [taken.column(0), taken.column(1)] + [pa.array(c, pa.int64())
                                                           for c in cols[:4]]
            if with_ids:
                arrays.append(pa.array([np.frombuffer(p, "<u4").astype(np.int32)
                                        for p in cols[4]], pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(arrays, names)

    names = ["doc_id", "part", "start", "length", "ids_crc32", "doc_tokens"] + ["ids"] * with_ids
    schema = (f"doc_id {kind.simpleString()}, part bigint, start bigint, length bigint, "
              "ids_crc32 bigint, doc_tokens bigint" + ", ids array<int>" * with_ids)
    rows = texts(docs, id_col, text_col)
    spread = F.when(F.col("doc_id").isNull(), row_key("text")).otherwise(row_key("doc_id"))
    return rows.select("doc_id", "text", spread.alias("part")).mapInArrow(run, schema)


def pack(pieces: DataFrame, groups: int, capacity: int = 2048) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; each of ``groups`` packs by itself.

    Needs the columns of ``token_pieces``; others are carried along.
    """
    kept = [f for f in pieces.schema.fields if f.name != "part"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)

    def run(key, group):
        sizes, ids, starts = (group.column(c).to_pylist() for c in ("length", "doc_id", "start"))
        order = sorted(range(len(sizes)),
                       key=lambda i: (-sizes[i], ids[i] is None, ids[i], starts[i]))
        spots = first_fit_decreasing([sizes[i] for i in order], capacity)
        base = key[0].as_py() << 32
        return (group.select([f.name for f in kept]).take(pa.array(order, pa.int64()))
                .append_column("sequence_id", pa.array([base + bin for bin, _ in spots], pa.int64()))
                .append_column("offset", pa.array([at for _, at in spots], pa.int64())))

    return pieces.withColumn("__group", F.pmod(F.col("part"), F.lit(groups))).groupBy(
        "__group").applyInArrow(run, f"{schema}, sequence_id bigint, `offset` bigint")


def pack_documents(docs: DataFrame, path: str, end_id: int, capacity: int = 2048,
                   group_docs: int = GROUP_DOCS, **options) -> DataFrame:
    """Tokenise and pack ``docs``; a count of the rows fixes the number of groups."""
    groups = max(1, -(-docs.count() // group_docs))
    return pack(token_pieces(docs, path, end_id, capacity, **options), groups, capacity)
