"""Source divergence audit: how far the word use of one source lies from another's.

Every (language, source) group, and every language, gives each kept term a smoothed share of its
words in whole billionths; the divergence of two shares p and q is ``floor((p - q)^2 / (p + q))``.
All of it is whole-number arithmetic.

Cells instead of terms: the divergence of a term depends on nothing but its counts, so the terms of
a group with the same (group count, language count) are one cell, evaluated once. Cells of equal
value are merged, the values ranked by the terms that they hold together, and only the cells that
reach the report are expanded to their terms, in UTF-8 order. For pairs of sources the cells are
the terms of a language with the same counts in all of its sources; blocks of cells are evaluated
as matrices, cell by source, where a count of zero needs no row of its own.

Tasks count the words of their documents before anything is shuffled, so a hot source or a word in
every text is one row per task (or per ``FLUSH_BYTES`` of text). A term has at most as many
rows as its language has sources.

Defined cases: null text, language and source are empty; a text without letters counts as a
document and names its group; repeated rows are documents each, and ids are not read, so null ids
matter to nothing; ties go by the item's UTF-8 bytes; a language without kept terms has pairs of
value 0 and no terms; a language with one source has no pairs; further columns are not read; an
empty table gives an empty one.
"""

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tremora.llm.common import small_batches
from tremora.session import written

#: Documents of a language that a kept term must occur in.
MIN_DOCS = 10
#: Ranks of the terms of a group that are reported.
TOP_TERMS = 10
#: Shares are whole parts of this.
UNIT = 1_000_000_000
#: Text that a task counts before it hands its counts on, and the distinct words it holds.
FLUSH_BYTES, FLUSH_TERMS = 1 << 27, 400_000
#: Numbers of a matrix that is evaluated at once, and of a block of cells, which is a task's share.
CELLS, BLOCK = 1 << 20, 1 << 19

# A-Z to a-z, letters and all bytes from 0x80 as they are, everything else to a space
_LETTERS = bytes(b if 0x61 <= b <= 0x7A or b >= 0x80 else b + 32 if 0x41 <= b <= 0x5A else 0x20
                 for b in range(256))


def words(text: bytes) -> list[bytes]:
    """The terms of a text in UTF-8, in order."""
    return text.translate(_LETTERS).split()


def term_counts(docs: DataFrame) -> DataFrame:
    """``lang, source, term, n, docs``: occurrences and documents; each group also has one row
    without a term."""
    small_batches(docs.sparkSession)

    def emitted(groups: dict) -> pa.RecordBatch:
        cols: list[list] = [[], [], [], [], []]
        for (lang, source), (seen, held) in groups.items():
            size = len(seen) + 1
            for col, values in zip(cols, ([lang] * size, [source] * size, [None, *seen],
                                          [0, *seen.values()], [0, *map(held.__getitem__, seen)])):
                col += values
        lang, source, term, n, docs_ = cols
        return pa.RecordBatch.from_arrays(
            [pa.array(lang, pa.string()), pa.array(source, pa.string()),
             pa.array(term, pa.binary()).cast(pa.string()), pa.array(n, pa.int64()),
             pa.array(docs_, pa.int64())], ["lang", "source", "term", "n", "docs"])

    def run(batches):
        groups: dict = {}
        taken = 0
        for batch in batches:
            for lang, source, text in zip(*(c.to_pylist() for c in batch.columns)):
                seen, held = groups.setdefault((lang, source), (Counter(), Counter()))
                found = words(text)
                seen.update(found)
                held.update(set(found))
                taken += len(text)
            if taken >= FLUSH_BYTES or sum(len(s) for s, _ in groups.values()) >= FLUSH_TERMS:
                yield emitted(groups)
                groups, taken = {}, 0
        yield emitted(groups)

    rows = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
                         for c in ("lang", "source", "text")])
    counted = rows.select("lang", "source", F.col("text").cast("binary").alias("text")).mapInArrow(
        run, "lang string, source string, term string, n bigint, docs bigint")
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"),
                                                         F.sum("docs").alias("docs"))


def kept_terms(counts: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """``lang, term, lang_n, counts``: terms in enough documents, with their count by source."""
    by_source = F.array_sort(F.collect_list(F.struct("source", "n")))
    return (counts.where("term IS NOT NULL").groupBy("lang", "term")
            .agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"),
                 by_source.alias("counts"))
            .where(F.col("docs") >= min_docs).drop("docs"))


def group_totals(counts: DataFrame, kept: DataFrame) -> DataFrame:
    """``lang, source, total, lang_total, terms`` of every group that occurs."""
    groups = counts.where("term IS NULL").select("lang", "source")
    totals = (kept.select("lang", F.explode("counts").alias("c"))
              .groupBy("lang", "c.source").agg(F.sum("c.n").alias("total")))
    langs = kept.groupBy("lang").agg(F.sum("lang_n").alias("lang_total"),
                                     F.count(F.lit(1)).alias("terms"))
    return (groups.join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
            .na.fill(0, ["total", "lang_total", "terms"]))


def share(count: Column, total: Column, terms: Column) -> Column:
    """The smoothed share in whole units; in decimals, as a large count times the unit is no long."""
    whole = ((count.cast("decimal(20,0)") + 2) * F.lit(UNIT).cast("decimal(10,0)")).cast(
        "decimal(38,0)")
    return F.call_function("div", whole, (total + 2 * terms).cast("decimal(38,0)")) + 1


def apart(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def top_terms(kept: DataFrame, groups: DataFrame, top: int = TOP_TERMS) -> DataFrame:
    """``lang, source, item, value, rank``: what a source says more often than its language."""
    placed = kept.select("lang", "term", "lang_n", F.explode("counts").alias("c")).select(
        "lang", "term", "lang_n", "c.source", "c.n")
    cells = placed.groupBy("lang", "source", "n", "lang_n").agg(F.count(F.lit(1)).alias("held"))
    p = share(F.col("n"), F.col("total"), F.col("terms"))
    q = share(F.col("lang_n"), F.col("lang_total"), F.col("terms"))
    rated = (cells.join(groups, ["lang", "source"]).withColumns({"p": p, "q": q}).where("p > q")
             .select("lang", "source", "n", "lang_n", "held",
                     apart(F.col("p"), F.col("q")).alias("value")))
    # each value holds a term at least, so `top` values reach as far as `top` terms
    of_group = W.partitionBy("lang", "source")
    falling = of_group.orderBy(F.desc("value"))
    values = (rated.groupBy("lang", "source", "value").agg(F.sum("held").alias("held"))
              .withColumn("place", F.row_number().over(falling)).where(F.col("place") <= top)
              .withColumn("before", F.sum("held").over(falling) - F.col("held"))
              .where(F.col("before") < top).select("lang", "source", "value"))
    reached = rated.join(values, ["lang", "source", "value"]).drop("held")
    named = placed.join(reached, ["lang", "source", "n", "lang_n"]).withColumnRenamed("term", "item")
    return (named.withColumn("rank", F.row_number().over(
        of_group.orderBy(F.desc("value"), F.asc("item")))).where(F.col("rank") <= top)
        .select("lang", "source", "item", "value", "rank"))


def block_sums(counts: np.ndarray, held: np.ndarray, totals: list[int], terms: int) -> list:
    """For a matrix of counts, cell by source: the divergences summed over cells, source by source.
    ``held`` is how many terms a cell stands for."""
    limit = 2 ** 62 // UNIT
    if counts.max(initial=0) > limit or max(totals) > 2 ** 62:
        counts, held = counts.astype(object), held.astype(object)
    p = 1 + (counts + 2) * UNIT // (np.array(totals, dtype=counts.dtype) + 2 * terms)
    p = p.astype(np.int64)  # at most the unit and one
    out = []
    for a in range(len(totals)):
        gap = p - p[:, a:a + 1]
        value = gap * gap // (p + p[:, a:a + 1])
        out.append([int(x) for x in (value * held[:, None]).sum(0)])
    return out


def pair_sums(kept: DataFrame, groups: DataFrame, cells: int = CELLS,
              block: int = BLOCK) -> DataFrame:
    """``lang, source, item, value`` for every two sources of a language, both ways round.

    The cells of a language are cut into blocks of about ``block`` numbers, cells times sources.
    """
    names = ["lang", "source", "item", "value"]

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = sorted(right.select(["lang", "source", "total", "terms", "block"]).to_pylist(),
                      key=lambda r: r["source"])
        if not rows or not (left.num_rows or rows[0]["block"] == 0):
            return pa.table({n: pa.array([], pa.int64() if n == "value" else pa.string())
                             for n in names})
        size, terms = len(rows), rows[0]["terms"]
        place = {r["source"]: k for k, r in enumerate(rows)}
        sums = [[0] * size for _ in range(size)]
        step = max(1, cells // size)
        for at in range(0, left.num_rows, step):
            part = left.slice(at, step)
            matrix = np.zeros((part.num_rows, size), np.int64)
            for k, row in enumerate(part.column("counts").to_pylist()):
                for c in row:
                    matrix[k, place[c["source"]]] = c["n"]
            found = block_sums(matrix, part.column("held").to_numpy(),
                               [r["total"] for r in rows], terms)
            sums = [[x + y for x, y in zip(one, two)] for one, two in zip(sums, found)]
        pairs = [(rows[0]["lang"], a["source"], b["source"], sums[i][j])
                 for i, a in enumerate(rows) for j, b in enumerate(rows) if i != j]
        return pa.table({n: pa.array([p[k] for p in pairs],
                                     pa.int64() if n == "value" else pa.string())
                         for k, n in enumerate(names)})

    merged = written(kept.groupBy("lang", "counts").agg(F.count(F.lit(1)).alias("held")), "cells")
    width = groups.groupBy("lang").agg(F.count(F.lit(1)).alias("width"))
    numbers = F.coalesce(F.col("cells"), F.lit(0)) * F.col("width")
    blocks = width.join(merged.groupBy("lang").agg(F.count(F.lit(1)).alias("cells")), "lang", "left"
                        ).select("lang", F.greatest(F.ceil(numbers / block), F.lit(1)).cast("int")
                                 .alias("blocks"))
    merged = merged.join(blocks, "lang").select(
        "lang", "counts", "held", F.pmod(F.xxhash64("counts"), "blocks").cast("int").alias("block"))
    listed = groups.join(blocks, "lang").withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")
    parts = merged.groupBy("lang", "block").cogroup(listed.groupBy("lang", "block")).applyInArrow(
        run, "lang string, source string, item string, value bigint")
    return parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP_TERMS) -> DataFrame:
    """``lang, source, part, item, value, rank``: ``pair`` rows for the other sources of the
    language, ``term`` rows for the words that set a source apart."""
    counts = written(term_counts(docs), "term-counts")
    kept = written(kept_terms(counts, min_docs), "kept-terms")
    groups = written(group_totals(counts, kept), "group-totals")
    per_group = W.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    pairs = pair_sums(kept, groups).withColumn("rank", F.row_number().over(per_group))
    terms = top_terms(kept, groups, top)
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return pairs.withColumn("part", F.lit("pair")).select(*columns).unionByName(
        terms.withColumn("part", F.lit("term")).select(*columns))
