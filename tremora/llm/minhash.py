"""Near-duplicates by MinHash: one-permutation hashing with optimal densification.

A text's set is its distinct runs of five words. Each set is hashed once; the range of hash values
is cut into bins, the smallest value of each bin is kept, and an empty bin borrows from the filled
bin that a fixed sequence of its own choices meets first. Rows of the signature are banded into
buckets. Within a bucket edges go from one centre to the other members only, so a bucket of n texts
has n - 1 edges, not n * n. Every edge is confirmed on the full sets.

Equal sets are one node, so copies make no edges at all. A star alone could miss a link between two
members that are both unlike its centre. So buckets of three and more members that still hold
several components are dealt out in blocks, and each pair of blocks is compared within a task,
where only pairs of different components are tested and only links leave; a bucket of any size is
many bounded tasks. Components come from alternating star contractions of the links, as tables in
the shared folder.

Defined cases: null and empty texts, and texts without words, have the empty set and link with
nothing; a text of fewer than five words is one run; repeated rows have one set and share their verdict (an id is
taken to name one text); a row
without id takes no part, its component is null and it is kept; ties cannot matter, as sets are
compared by whole numbers; further columns are not read; an empty table gives an empty one.
"""

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tremora.llm.common import Memo, small_batches, texts
from tremora.session import written

RUN = 5
#: Bands of rows: a pair with similarity 0.85 shares a bucket but for about one case in four million.
BANDS, ROWS = 32, 6
#: Links need PERCENT * union <= 100 * intersection.
PERCENT = 85
_GOLD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_WORDS = Memo(xxhash.xxh3_64_intdigest, 100_000)


def shingles(text: str) -> np.ndarray:
    """The sorted distinct 64-bit hashes of a text's runs of five words (ASCII lower case)."""
    words = text.encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    hashed = np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))
    size = max(1, len(hashed) - RUN + 1)
    out = np.full(size, len(words) if len(words) < RUN else RUN, np.uint64)
    for k in range(min(RUN, len(words))):
        out = _mixed(out * _GOLD + hashed[k:k + size])
    return np.unique(out)


@lru_cache(maxsize=4)
def _choices(bins: int, tries: int = 64) -> np.ndarray:
    """For each bin the bins it would borrow from, in order; the same for every set."""
    grid = np.arange(bins * tries, dtype=np.uint64).reshape(bins, tries)
    return (_mixed(grid * _GOLD + np.uint64(1)) % np.uint64(bins)).astype(np.int64)


def signature(hashes: np.ndarray, bins: int) -> np.ndarray:
    """The smallest hash of each bin, empty bins densified; ``hashes`` sorted and not empty."""
    place = ((hashes >> np.uint64(32)) * np.uint64(bins)) >> np.uint64(32)  # ascending
    first = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
    out, filled = np.zeros(bins, np.uint64), np.zeros(bins, bool)
    at = place[first].astype(np.int64)
    out[at], filled[at] = hashes[first], True
    empty = np.flatnonzero(~filled)
    if len(empty):
        options = _choices(bins)[empty]
        hit = filled[options]
        good = hit.any(1)
        source = options[np.arange(len(empty)), hit.argmax(1)]
        # none of the tries met a filled bin: the next one upwards, as rare as it is fixed
        for k in np.flatnonzero(~good):
            source[k] = at[np.searchsorted(at, empty[k]) % len(at)]
        out[empty] = out[source]
    return out


def band_keys(hashes: np.ndarray, bands: int, rows: int) -> np.ndarray:
    grid = signature(hashes, bands * rows).reshape(bands, rows)
    keys = np.arange(bands, dtype=np.uint64)
    for k in range(rows):
        keys = _mixed(keys * _GOLD + grid[:, k])
    return keys.view(np.int64)


def digest(hashes: np.ndarray) -> bytes | None:
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest() if len(hashes) else None


def sketches(docs: DataFrame, bands: int = BANDS, rows: int = ROWS, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, digest, bands`` of every row; no digest or bands for empty sets."""
    small_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in batches:
            sets = [shingles(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([digest(s) for s in sets], pa.binary()),
                 pa.array([band_keys(s, bands, rows) if len(s) else None for s in sets],
                          pa.list_(pa.int64()))], ["doc_id", "n_shingles", "digest", "bands"])

    return texts(docs, id_col, text_col).mapInArrow(
        run, f"doc_id {kind}, n_shingles bigint, digest binary, bands array<bigint>")


def shared_buckets(nodes: DataFrame) -> DataFrame:
    """``bucket, rep, center`` of all buckets with two members and more."""
    members = nodes.select("rep", F.explode("bands").alias("bucket"))
    centers = members.groupBy("bucket").agg(F.min("rep").alias("center"),
                                            F.max("rep").alias("last")).where("center < last")
    return members.join(centers.select("bucket", "center"), "bucket")


def full_sets(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``rep, hashes`` (the set as bytes) of the texts whose id is in ``wanted.rep``."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in batches:
            sets = [shingles(t).tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())],
                                             ["rep", "hashes"])

    rows = texts(docs, id_col, text_col)
    return (rows.join(wanted, rows["doc_id"] == wanted["rep"], "left_semi")
            .mapInArrow(run, f"rep {kind}, hashes binary").dropDuplicates(["rep"]))


def common(a: np.ndarray, b: np.ndarray) -> int:
    """How many values two sorted sets share."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = len(b) - 1
    return int((b[at] == a).sum()) if len(b) else 0


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if percent * max(len(a), len(b)) > 100 * min(len(a), len(b)):
        return False
    both = common(a, b)
    return 100 * both >= percent * (len(a) + len(b) - both)


def confirmed(edges: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The edges ``a, b`` that are links by the full sets."""
    kind = sets.schema["rep"].dataType.simpleString()
    left = sets.select(F.col("rep").alias("a"), F.col("hashes").alias("a_set"))
    right = sets.select(F.col("rep").alias("b"), F.col("hashes").alias("b_set"))

    def run(batches):
        for batch in batches:
            a_sets, b_sets = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            keep = [linked(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), percent)
                    for x, y in zip(a_sets, b_sets)]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return edges.join(right, "b").join(left, "a").select("a", "b", "a_set", "b_set").mapInArrow(
        run, f"a {kind}, b {kind}")


def links_of_block(ids: list, labels: list, sets: list[np.ndarray], sides: list[tuple[bool, bool]],
                   bucket: int, percent: int, bands: int, rows: int) -> list[tuple]:
    """Links between members of different components, one block against the other.

    A pair is tested only in the first bucket that it shares, and if the sizes of the sets leave a
    link possible, which is exact. Components joined on the way are not tested again.
    """
    n = len(ids)
    keys = np.stack([band_keys(s, bands, rows) for s in sets])
    sizes = np.array([len(s) for s in sets])
    number = {label: k for k, label in enumerate(dict.fromkeys(labels))}
    group = np.array([number[label] for label in labels])
    left = np.array([s[0] for s in sides])
    right = np.array([s[1] for s in sides])
    out = []
    for i in range(n):
        other = np.arange(n) > i
        other &= (left[i] & right) | (right[i] & left)
        other &= (group != group[i]) & (100 * np.minimum(sizes, sizes[i])
                                        >= percent * np.maximum(sizes, sizes[i]))
        near = np.flatnonzero(other)
        if not len(near):
            continue
        same = keys[near] == keys[i]
        near = near[same.any(1) & (keys[i][same.argmax(1)] == bucket)]
        for j in near:
            if group[i] != group[j] and linked(sets[i], sets[j], percent):
                out.append((ids[i], ids[j]))
                group[group == group[j]] = group[i]
    return out


def remaining_links(shared: DataFrame, labels: DataFrame, sets: DataFrame, percent: int,
                    bands: int, rows: int, block: int = 256) -> DataFrame:
    """Links inside buckets that hold several components, found block against block."""
    kind = sets.schema["rep"].dataType.simpleString()
    members = shared.join(labels, "rep", "left").select(
        "bucket", "rep", F.coalesce("root", "rep").alias("root"))
    still = members.groupBy("bucket").agg(
        F.min("root").alias("lo"), F.max("root").alias("hi"), F.count(F.lit(1)).alias("n")).where(
        "lo < hi AND n > 2").select("bucket", F.ceil(F.col("n") / block).alias("blocks"))
    own = F.pmod(F.xxhash64("rep"), F.col("blocks"))
    dealt = (members.join(still, "bucket").withColumn("own", own)
             .withColumn("k", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
             .select("bucket", "rep", "root", "own", F.least("own", "k").alias("i"),
                     F.greatest("own", "k").alias("j")))

    def run(key, group):
        bucket, i, j = (k.as_py() for k in key)
        order = np.argsort(group.column("rep").to_numpy(zero_copy_only=False), kind="stable")
        group = group.take(pa.array(order))
        side = [(o == i, o == j) for o in group.column("own").to_pylist()]
        found = links_of_block(
            group.column("rep").to_pylist(), group.column("root").to_pylist(),
            [np.frombuffer(h, np.uint64) for h in group.column("hashes").to_pylist()], side,
            bucket, percent, bands, rows)
        type_ = group.schema.field("rep").type
        return pa.table({"a": pa.array([x for x, _ in found], type_),
                         "b": pa.array([y for _, y in found], type_)})

    return dealt.join(sets, "rep").groupBy("bucket", "i", "j").applyInArrow(
        run, f"a {kind}, b {kind}")


def components(links: DataFrame) -> DataFrame:
    """``rep, root``: the smallest node reachable, for the nodes of ``links`` (``a, b``).

    Alternating contractions: first every larger neighbour of a node, then every smaller one, is
    tied to the smallest; the edges become stars in few rounds. Each round is a written table.
    """
    edges = written(links.where("a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    while True:
        before = edges
        both = edges.union(edges.select(F.col("v"), F.col("u")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = (both.join(least, "u").where("v > u").select(F.col("v").alias("u"),
                                                             F.col("m").alias("v")))
        # nodes whose own smallest neighbour is larger stay tied through the other end
        large = written(large.where("u <> v").distinct(), "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        tied = large.join(least, "u")
        small = tied.select("v", "m").where("v <> m").union(least.select("u", "m")).toDF("u", "v")
        edges = written(small.distinct(), "small-star")
        if _fingerprint(edges) == _fingerprint(before):
            return edges.groupBy(F.col("u").alias("rep")).agg(F.min("v").alias("root"))


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(u, v))")).first())


def near_duplicates(docs: DataFrame, percent: int = PERCENT, bands: int = BANDS, rows: int = ROWS,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_shingles, component_id, kept``."""
    small_batches(docs.sparkSession)
    seen = written(sketches(docs, bands, rows, id_col, text_col), "sketches")
    nodes = (seen.where("digest IS NOT NULL AND doc_id IS NOT NULL").groupBy("digest")
             .agg(F.min("doc_id").alias("rep"), F.any_value("bands").alias("bands")))
    shared = written(shared_buckets(nodes.select("rep", "bands")), "buckets")
    sets = written(full_sets(docs, shared.select("rep").distinct(), id_col, text_col), "sets")
    edges = shared.where("rep <> center").select(F.col("center").alias("a"),
                                                 F.col("rep").alias("b")).distinct()
    links = written(confirmed(edges, sets, percent), "links")
    roots = components(links)
    more = written(remaining_links(shared, roots, sets, percent, bands, rows), "more-links")
    if not more.isEmpty():
        roots = components(links.union(more))
    by_digest = nodes.select("digest", "rep").join(roots, "rep", "left").select(
        "digest", F.coalesce("root", "rep").alias("root"))
    return (seen.join(by_digest, "digest", "left").select(
        "doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce(
            "root", "doc_id")).alias("component_id"))
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))


def without_near_copies(docs: DataFrame, percent: int = PERCENT, id_col: str = "doc_id",
                        text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay: one of each group, with all columns."""
    gone = near_duplicates(docs, percent, id_col=id_col, text_col=text_col).where("NOT kept")
    gone = gone.select(F.col("doc_id").alias("__gone"))
    rows = docs.select(F.struct("*").alias("__row"), F.col(id_col).alias("__id"))
    return rows.join(gone, F.col("__id") == F.col("__gone"), "left_anti").select("__row.*")
