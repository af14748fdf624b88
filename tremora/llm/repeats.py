"""Removal of repeated passages with suffix arrays and their common-prefix interval trees.

Every string of ``length`` bytes holds one chosen gram, its minimizer: the leftmost of the smallest
hashes. Equal strings choose the same gram at the same place, so they meet in the group of that
gram, whatever the documents. A stretch of starts with the same gram, and the bytes it spans, is a
segment, and the exact method runs on segments:

* Segments with the same bytes (exact copies, however many) are one content; with two members
  all of its strings repeat.
* The different contents of a gram get a suffix array. A stack scan over its common-prefix lengths
  walks the interval tree; each interval of ``length`` bytes and more is a repeat with all its
  occurrences, and is maximal if the bytes before them differ. Maximal repeats cover every
  repeated string.
* A gram with more than ``GROUP`` contents is not put into one task. Its segments are cut into slices
  of starts, at the same places around the gram, and the bytes that all strings of a slice hold
  are its narrower key; equal slices are one content again. What is still crowded is cut into
  narrower slices, down to single strings, where equal contents are all there is to find.

Defined cases: a null text is empty; texts shorter than ``length`` have no strings; matches never
cross documents, as segments do not; repeated rows are copies of each other, and are told apart
by nothing, so their spans are the same; overlapping copies within a text count; further columns
are not read; an empty table gives an empty one.
"""

import hashlib
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tremora.llm.common import row_key, shuffle_parts, small_batches, texts
from tremora.session import written

LENGTH = 400
#: Bytes of a minimizer.
GRAM = 128
#: Contents of a gram that one suffix array takes.
GROUP = 128
#: Starts of a slice, from one round to the next.
WIDTHS = (64, 8, 1)
#: No more keys than this can each have more than this part of the rows.
HOT_KEYS = 10_000
#: Rows that one task takes of any key.
COOL_ROWS = 1000
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


@lru_cache(maxsize=4)
def _powers(base: int, size: int) -> np.ndarray:
    out = np.full(size, np.uint64(base))
    out[0] = 1
    return np.multiply.accumulate(out)


def _room(n: int) -> int:
    return 1 << max(16, n.bit_length())


def gram_hashes(raw: np.ndarray, gram: int) -> np.ndarray:
    """A 64-bit hash of every run of ``gram`` bytes, from prefix sums."""
    n = len(raw)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * _powers(_BASE, _room(n))[:n], out=sums[1:])
    out = (sums[gram:] - sums[:n - gram + 1]) * _powers(_INVERSE, _room(n))[:n - gram + 1]
    out ^= out >> np.uint64(32)
    out *= np.uint64(0xD6E8FEB86659FD93)
    out ^= out >> np.uint64(29)
    return out


def segments(raw: np.ndarray, length: int = LENGTH,
             gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """``(hash of the gram, its place, first start, start after the last)`` of a text's segments."""
    gram = min(gram, max(1, length // 2))  # shorter strings have shorter grams
    window = length - gram + 1
    starts = len(raw) - length + 1
    if starts < 1:
        return (np.zeros(0, np.int64),) * 4
    hashes = gram_hashes(raw, gram)
    # the leftmost of equal hashes: which one that is depends on the window's bytes alone
    ranked = (hashes & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(hashes), dtype=np.uint64)
    padded = np.full(-(-len(ranked) // window) * window, np.uint64(2**64 - 1))
    padded[:len(ranked)] = ranked
    blocks = padded.reshape(-1, window)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    place = np.minimum(behind[:starts], ahead[window - 1:window - 1 + starts])
    place = (place & np.uint64(0xFFFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
    return hashes[place[first]].view(np.int64), place[first], first, np.r_[first[1:], starts]


def common_prefix(a: bytes, b: bytes) -> int:
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


def intervals(prefixes: list[int], least: int) -> list[tuple[int, int, int]]:
    """``(common prefix, left, right)`` of the intervals of the tree, inner ones first.

    ``prefixes[i]`` is what suffixes ``i - 1`` and ``i`` share.
    """
    out, stack = [], []  # open intervals: (common prefix, left)
    for i in range(1, len(prefixes) + 1):
        shared, left = prefixes[i] if i < len(prefixes) else 0, i - 1
        while stack and stack[-1][0] > shared:
            size, left = stack.pop()
            out.append((size, left, i - 1))
        if shared >= least and (not stack or stack[-1][0] < shared):
            stack.append((shared, left))
    return out


def maximal_repeats(contents: list[bytes], starts: list[int], length: int = LENGTH):
    """The maximal repeats of ``length`` and more among strings that begin at the first ``starts[i]``
    places of ``contents[i]``: the occurrences ``(content, place)`` in suffix order, and intervals
    ``(length, left, right)`` over them."""
    suffixes = sorted((content[at:], k, at) for k, content in enumerate(contents)
                      for at in range(starts[k]))
    prefixes = [0] * len(suffixes)
    for i in range(1, len(suffixes)):
        a, b = suffixes[i - 1][0], suffixes[i][0]
        if a[:length] == b[:length]:
            prefixes[i] = common_prefix(a, b)
    places = [(k, at) for _, k, at in suffixes]
    # -1 before a content's first byte: what stood there is unknown, so it always differs
    before = [contents[k][at - 1] if at else -1 for k, at in places]
    changes = np.cumsum([0] + [before[i] != before[i - 1] or before[i] < 0
                               for i in range(1, len(before))]) if places else []
    found = [(size, left, right) for size, left, right in intervals(prefixes, length)
             if changes[left] != changes[right] or before[left] < 0]
    return places, found


def covered(places: list[tuple[int, int]], found: list[tuple[int, int, int]]) -> dict:
    """By content the ranges of bytes that its repeats cover. Inner intervals come first and are
    the longest repeats of their occurrences, so each occurrence is passed once."""
    ahead = list(range(len(places) + 1))  # the next occurrence without a range

    def free(i: int) -> int:
        while ahead[i] != i:
            ahead[i] = ahead[ahead[i]]
            i = ahead[i]
        return i

    ranges: dict[int, list] = {}
    for size, left, right in found:
        i = free(left)
        while i <= right:
            content, at = places[i]
            ranges.setdefault(content, []).append((at, at + size))
            ahead[i] = i + 1
            i = free(i + 1)
    return {k: merged(r) for k, r in ranges.items()}


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, stop in sorted(ranges):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(stop, out[-1][1]))
        else:
            out.append((start, stop))
    return out


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return texts(docs, id_col, text_col).withColumn("key", row_key("doc_id", "text"))


def _same(left: DataFrame, right: DataFrame):
    return left["doc_id"].eqNullSafe(right["doc_id"]) & (left["key"] == right["key"])


def segment_table(rows: DataFrame, length: int, gram: int) -> DataFrame:
    """``doc_id, key, gram, content, place, start, stop`` of every segment of every text; strings
    start from ``start`` to before ``stop``, ``content`` is the digest of the bytes."""
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            origin, parts, digests = [], [], []
            for row, text in enumerate(batch.column(2).to_pylist()):
                data = text.encode()
                grams, place, first, after = segments(np.frombuffer(data, np.uint8), length, gram)
                origin.append(np.full(len(grams), row))
                parts.append((grams, place, first, after))
                digests += [hashlib.blake2b(data[a:b - 1 + length], digest_size=16).digest()
                            for a, b in zip(first.tolist(), after.tolist())]
            owner = batch.select(["doc_id", "key"]).take(pa.array(np.concatenate(origin)))
            grams, place, first, after = (np.concatenate(p) for p in zip(*parts))
            yield pa.RecordBatch.from_arrays(
                [owner.column(0), owner.column(1), pa.array(grams), pa.array(digests, pa.binary()),
                 *(pa.array(x.astype(np.int32)) for x in (place, first, after))],
                ["doc_id", "key", "gram", "content", "place", "start", "stop"])

    return rows.select("doc_id", "key", "text").mapInArrow(
        run, f"doc_id {kind}, key bigint, gram bigint, content binary, place int, "
             "start int, stop int")


def _bytes_of(rows: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """``wanted`` with the bytes of its segments, cut from the texts without copying a text."""
    by_doc = wanted.groupBy("doc_id", "key").agg(F.collect_list(F.struct(
        *[c for c in wanted.columns if c not in ("doc_id", "key")])).alias("parts"))
    data = rows["text"].cast("binary")
    cut = F.transform("parts", lambda p: F.struct(p.alias("part"), F.substring(
        data, p["start"] + 1, p["stop"] - p["start"] + (length - 1)).alias("data")))
    return (rows.join(by_doc, _same(rows, by_doc))
            .select(by_doc["doc_id"], by_doc["key"], F.explode(cut).alias("cut"))
            .select("doc_id", "key", "cut.part.*", "cut.data").dropDuplicates(
                ["doc_id", "key", "start"]))


def repeat_groups(members: DataFrame, length: int = LENGTH, ranges: bool = False) -> DataFrame:
    """Maximal repeats of each gram's contents (``gram, doc_id, key, start, stop, data``).

    ``gram, repeat, size, doc_id, start``: one row per occurrence of every maximal repeat; or, with
    ``ranges``, ``doc_id, key, first, after``: the bytes that the repeats cover.
    """
    kind = members.schema["doc_id"].dataType.simpleString()

    def arranged(group: pa.Table):
        group = group.take(pa.array(np.lexsort([
            group.column("start").to_numpy(), group.column("key").to_numpy()])))
        cols = {c: group.column(c).to_pylist() for c in ("doc_id", "key", "start", "stop", "data")}
        places, found = maximal_repeats(cols["data"], [b - a for a, b in zip(
            cols["start"], cols["stop"])], length)
        return cols, group.schema, places, found

    def occurrences(key, group):
        cols, schema, places, found = arranged(group)
        rows = [(key[0].as_py(), number, size, cols["doc_id"][k], cols["start"][k] + at)
                for number, (size, left, right) in enumerate(found)
                for k, at in places[left:right + 1]]
        types = [pa.int64(), pa.int32(), pa.int32(), schema.field("doc_id").type, pa.int32()]
        names = ["gram", "repeat", "size", "doc_id", "start"]
        return pa.table([pa.array([r[c] for r in rows], t) for c, t in enumerate(types)], names)

    def ranges_of(key, group):
        cols, schema, places, found = arranged(group)
        rows = [(cols["doc_id"][k], cols["key"][k], cols["start"][k] + a, cols["start"][k] + b)
                for k, spans in covered(places, found).items() for a, b in spans]
        types = [schema.field("doc_id").type, pa.int64(), pa.int32(), pa.int32()]
        names = ["doc_id", "key", "first", "after"]
        return pa.table([pa.array([r[c] for r in rows], t) for c, t in enumerate(types)], names)

    if ranges:
        return members.groupBy("gram").applyInArrow(
            ranges_of, f"doc_id {kind}, key bigint, first int, after int")
    return members.groupBy("gram").applyInArrow(
        occurrences, f"gram bigint, repeat int, size int, doc_id {kind}, start int")


def slices(members: DataFrame, width: int, length: int) -> DataFrame:
    """Segments cut into slices of ``width`` starts, counted from the gram's place: the columns of
    ``segment_table`` and ``data``, with a narrower ``gram``."""
    kind = members.schema["doc_id"].dataType.simpleString()
    types = [pa.int64(), pa.binary(), pa.int32(), pa.int32(), pa.int32(), pa.binary()]
    names = ["gram", "content", "place", "start", "stop", "data"]

    def run(batches):
        for batch in batches:
            origin, out = [], []
            rows = zip(*(batch.column(k).to_pylist() for k in range(2, 7)))
            for row, (gram, place, start, stop, data) in enumerate(rows):
                for number in range((start - place) // width, (stop - 1 - place) // width + 1):
                    first = place + number * width
                    a, b = max(start, first), min(stop, first + width)
                    # in every string that starts in this slice
                    core = data[first + width - 1 - start:first + length - start]
                    mark = hashlib.blake2b(core, digest_size=8, key=f"{gram},{number}".encode())
                    part = data[a - start:b - 1 + length - start]
                    origin.append(row)
                    out.append((int.from_bytes(mark.digest(), "little", signed=True),
                                hashlib.blake2b(part, digest_size=16).digest(), place, a, b, part))
            owner = batch.select(["doc_id", "key"]).take(pa.array(origin, pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [owner.column(0), owner.column(1)] + [pa.array([r[k] for r in out], t)
                                                      for k, t in enumerate(types)],
                ["doc_id", "key", *names])

    return members.select("doc_id", "key", "gram", "place", "start", "stop", "data").mapInArrow(
        run, f"doc_id {kind}, key bigint, gram bigint, content binary, place int, start int, "
             "stop int, data binary")


def _dealt_join(many: DataFrame, few: DataFrame, keys: list[str], rows: str) -> DataFrame:
    """``many`` with the columns of ``few`` (one row per key; ``rows`` says how many of ``many`` have
    it), the rows of a hot key dealt over all tasks.

    A key is hot if it has more than a ``HOT_KEYS``-th part of all rows, so no more than that many
    can be, and their list is small enough for a broadcast whatever the input.
    """
    limit = max(few.agg(F.coalesce(F.sum(rows), F.lit(0))).first()[0] / HOT_KEYS, COOL_ROWS)
    parts = shuffle_parts(many.sparkSession)
    hot = few.where(F.col(rows) > limit).select(*keys, F.lit(True).alias("__hot"))
    many = many.join(F.broadcast(hot), keys, "left").withColumn("__part", F.when(
        F.col("__hot"), F.pmod(F.xxhash64("doc_id", "key", "start"), F.lit(parts))).otherwise(
        F.lit(0).cast("long"))).drop("__hot")
    last = F.when(F.col(rows) > limit, F.lit(parts - 1)).otherwise(F.lit(0)).cast("long")
    few = few.withColumn("__part", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    return many.join(few, [*keys, "__part"]).drop("__part", rows)


def _contents(cut: DataFrame, length: int) -> tuple[DataFrame, DataFrame]:
    """Of segments: the ranges that copies of whole segments cover, and one segment for each of
    the different contents of a gram, with the gram's number of ``contents``."""
    heavy = written(cut.groupBy("gram").agg(
        F.count(F.lit(1)).alias("n"), F.min("content").alias("lo"), F.max("content").alias("hi"))
        .where("n > 1").select("gram", "n", (F.col("lo") != F.col("hi")).alias("mixed")), "grams")
    shared = written(_dealt_join(cut, heavy, ["gram"], "n"), "shared-segments")
    one = F.struct("doc_id", "key", *[c for c in cut.columns if c in ("place", "start", "stop",
                                                                      "data")])
    contents = written(shared.groupBy("gram", "content", "mixed").agg(
        F.count(F.lit(1)).alias("n"), F.min(one).alias("at")).select(
        "gram", "content", "mixed", "n", "at.*"), "contents")
    copies = _dealt_join(shared, contents.where("n > 1").select("gram", "content", "n"),
                         ["gram", "content"], "n")
    whole = copies.select("doc_id", "key", F.col("start").alias("first"),
                          (F.col("stop") - 1 + length).alias("after"))
    mixed = contents.where("mixed").drop("content", "mixed", "n")
    sizes = written(mixed.groupBy("gram").agg(F.count(F.lit(1)).alias("contents")), "gram-sizes")
    return whole, _dealt_join(mixed, sizes.withColumn("__n", F.col("contents")), ["gram"], "__n")


def repeated_ranges(rows: DataFrame, length: int = LENGTH, gram: int = GRAM,
                    group: int = GROUP) -> DataFrame:
    """``doc_id, key, first, after``: ranges of bytes that together are all repeated bytes."""
    found, mixed = _contents(written(segment_table(rows, length, gram), "segments"), length)
    members = written(_bytes_of(rows, mixed, length), "members")
    for width in WIDTHS:
        found = found.union(repeat_groups(members.where(F.col("contents") <= group), length, True))
        crowded = members.where(F.col("contents") > group)
        if crowded.isEmpty():
            return found
        whole, members = _contents(slices(crowded, width, length), length)
        found = found.union(whole)
    return found  # of slices of one start only equal ones match


def without_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, group: int = GROUP,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_bytes, n_removed, spans, kept`` - the removed runs
    of bytes, and what stays of the text, as bytes (a cut may part a character)."""
    small_batches(docs.sparkSession)
    rows = _keyed(docs, id_col, text_col)
    found = repeated_ranges(rows, length, gram, group).groupBy("doc_id", "key").agg(
        F.collect_set(F.struct("first", "after")).alias("ranges"))
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in batches:
            out: list[tuple] = []
            for text, ranges in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                data = text.encode()
                spans = merged([(r["first"], r["after"]) for r in ranges or ()])
                edges = [0, *(x for span in spans for x in span), len(data)]
                kept = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2]))
                out.append((len(data), len(data) - len(kept),
                            [{"start": a, "stop": b} for a, b in spans], kept))
            span = pa.struct([("start", pa.int32()), ("stop", pa.int32())])
            types = [pa.int64(), pa.int64(), pa.list_(span), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0)] + [pa.array([r[k] for r in out], t)
                                     for k, t in enumerate(types)],
                ["doc_id", "n_bytes", "n_removed", "spans", "kept"])

    joined = rows.join(found, _same(rows, found), "left")
    return joined.select(rows["doc_id"], rows["text"], found["ranges"]).mapInArrow(
        run, f"doc_id {kind}, n_bytes bigint, n_removed bigint, "
             "spans array<struct<start:int,stop:int>>, kept binary")


def kept_text(kept: str) -> Column:
    """What stays of a text, as a string: of a character that a cut parts nothing stays."""
    @F.pandas_udf("string")
    def whole(data: pd.Series) -> pd.Series:
        return pd.Series([bytes(d).decode(errors="ignore") for d in data], dtype=object)
    return whole(kept)


def cut_texts(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, with the repeated passages cut out of the text.

    What a cut leaves of a character that it parts is dropped. A row whose text was all repeated
    goes; one that was empty before stays. A column ``n_chars`` follows its text.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("doc_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn(
        "key", row_key("doc_id", "text"))
    found = repeated_ranges(_keyed(docs, id_col, text_col), length).groupBy("doc_id", "key").agg(
        F.collect_set(F.struct("first", "after")).alias("ranges"))

    @F.pandas_udf("string")
    def cut(text: pd.Series, ranges: pd.Series) -> pd.Series:
        out = []
        for t, r in zip(text, ranges):
            if r is None or not len(r):
                out.append(t)
                continue
            data = t.encode()
            spans = merged([(x["first"], x["after"]) for x in r])
            edges = [0, *(x for span in spans for x in span), len(data)]
            out.append(b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2])).decode(
                errors="ignore"))
        return pd.Series(out, dtype=object)

    joined = rows.join(found, _same(rows, found), "left").select(
        "row", rows["text"].alias("was"), cut(rows["text"], "ranges").alias("now"))
    columns = []
    for name in docs.columns:
        old = F.col("row").getField(name)
        if name == text_col:
            old = F.when(old.isNotNull(), F.col("now"))
        elif name == "n_chars":
            old = F.when(F.col("now") == F.col("was"), old).otherwise(F.length("now")).cast(
                docs.schema[name].dataType)
        columns.append(old.alias(name))
    return joined.where("now <> '' OR was = ''").select(*columns)
