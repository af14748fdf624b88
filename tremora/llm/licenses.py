"""License scans by diagonal voting; DataFrame functions only.

Every run of three words of every text is hashed and joined to the runs of the templates (a short,
broadcast list). A hit that also has the same words votes for the diagonal text place - template
place. A diagonal with a vote for every run of its template is a verbatim place. Neighbouring
diagonals, shifted by words put in or left out, are merged; the merged span is verified by the
share of the template's runs that it holds and by its length. A template is found from a share
of ``min_share`` on.

Words are those of the contract: ASCII upper case is lowered, every run of other characters than
ASCII letters, digits and non-ASCII is a gap.

Defined cases: a null or empty text has no words, no labels (empty strings), null places and score
0; repeated rows get the same answer each; texts under three words hold no template; further
columns are not read; an empty table gives an empty one. A template under three words is an error.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from tremora.llm.common import row_key, texts
from tremora.session import written

RUN = 3
#: The same words, as a list of what they hold: Java matches that far faster than what they lack.
WORD = r"[A-Za-z0-9\x{80}-\x{10FFFF}]+"
GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: A place where a word begins, and the run from there on.
STARTS = r"(?<![^ ])(?=([^ ]+" + r" [^ ]+" * (RUN - 1) + "))"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# The phrases whose verbatim places are counted, with their labels.
PHRASES = [
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
]
# Beginnings of public license notices.
NOTICES = [
    ("permission is hereby granted free of charge to any person obtaining a copy of this software "
     "and associated documentation files", "mit"),
    ("licensed under the apache license version 2 0", "apache-2"),
    ("licensed under the apache license version 2 0 the license you may not use this file except "
     "in compliance with the license", "apache-2"),
    ("this work is licensed under the gnu general public license version 3", "gpl-3"),
    ("this program is free software you can redistribute it and or modify it under the terms of "
     "the gnu general public license as published by the free software foundation", "gpl"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("this work is licensed under a creative commons attribution noncommercial 4 0 international "
     "license", "cc-by-nc"),
    ("this work is licensed under a creative commons attribution 4 0 international license",
     "cc-by"),
    ("redistribution and use in source and binary forms with or without modification are "
     "permitted provided that the following conditions are met", "bsd"),
    ("this source code form is subject to the terms of the mozilla public license v 2 0", "mpl-2"),
]
#: Diagonals at most this far apart are merged.
NEIGHBOURS = 3
MIN_SHARE = 0.8


def word_count(text: Column) -> Column:
    return F.size(F.regexp_extract_all(text, F.lit(WORD), F.lit(0))).cast("long")


def _runs(text: Column) -> Column:
    """All runs of words, in order, one space between words; empty for shorter texts."""
    return F.regexp_extract_all(F.regexp_replace(text, GAP, " "), F.lit(STARTS), F.lit(1))


def template_runs(spark: SparkSession, templates: list[tuple[str, str, bool]]) -> DataFrame:
    """One row per run of each template: a few dozen words each, and so within any broadcast."""
    rows = []
    for number, (text, label, base) in enumerate(templates):
        words = text.split()
        if len(words) < RUN:
            raise ValueError(f"a template of fewer than {RUN} words: {text!r}")
        rows += [(number, label, base, k, len(words) - RUN + 1,
                  " ".join(words[k:k + RUN]))
                 for k in range(len(words) - RUN + 1)]
    schema = T.StructType([
        T.StructField("template", T.IntegerType()), T.StructField("label", T.StringType()),
        T.StructField("base", T.BooleanType()), T.StructField("t_place", T.IntegerType()),
        T.StructField("t_runs", T.IntegerType()),
        T.StructField("t_words", T.StringType())])
    return spark.createDataFrame(rows, schema).withColumn("run", F.xxhash64("t_words"))


def votes(docs: DataFrame, templates: DataFrame) -> DataFrame:
    """``doc_id, __key, template, label, base, t_runs, diagonal, t_place``: one row per run found."""
    # lower() also changes letters outside ASCII: it finds the hits, the exact rule confirms them.
    # The hits are written once, as the corpus would else be scanned for each use of them.
    runs = docs.select("doc_id", "__key", F.posexplode(_runs(F.col("text"))).alias(
        "place", "words")).withColumn("run", F.xxhash64(F.lower("words")))
    hits = written(runs.join(F.broadcast(templates), "run").drop("run"), "license-hits")
    same = F.translate("words", UPPER, LOWER) == F.col("t_words")
    return hits.where(same).select(
        "doc_id", "__key", "template", "label", "base", "t_runs",
        (F.col("place") - F.col("t_place")).alias("diagonal"), "t_place").distinct()


def spans(found: DataFrame, neighbours: int = NEIGHBOURS) -> DataFrame:
    """Merged diagonals: ``doc_id, __key, template, label, base, first, last, share, exact``.

    ``first`` and ``last`` are the smallest and largest place where a run was found, ``share`` the
    share of the template's runs, ``exact`` the verbatim starts among the diagonals. A document's
    diagonals of one template are a group no larger than the document.
    """
    of = ["doc_id", "__key", "template", "label", "base", "t_runs"]
    lines = found.groupBy(*of, "diagonal").agg(
        F.count(F.lit(1)).alias("n"), F.min("t_place").alias("lo"), F.max("t_place").alias("hi"))
    order = W.partitionBy(*of).orderBy("diagonal")
    steps = lines.withColumn("step", F.when(
        F.col("diagonal") - F.lag("diagonal").over(order) <= neighbours, 0).otherwise(1))
    merged = steps.withColumn("block", F.sum("step").over(order))
    whole = F.col("n") == F.col("t_runs")
    bounds = merged.groupBy(*of, "block").agg(
        F.min(F.col("diagonal") + F.col("lo")).alias("first"),
        F.max(F.col("diagonal") + F.col("hi")).alias("last"),
        F.max("n").alias("best"), F.min("diagonal").alias("low"),
        F.max("diagonal").alias("high"), F.count(F.lit(1)).alias("lines"),
        F.sum(F.when(whole, 1).otherwise(0)).alias("n_exact"),
        F.min(F.when(whole, F.col("diagonal"))).alias("first_exact"),
        F.max(F.when(whole, F.col("diagonal"))).alias("last_exact"))
    # only blocks of several diagonals need the template places that they hold together
    places = (found.join(bounds.where("lines > 1").select(
        *[F.col(c).alias(f"b_{c}") for c in ("doc_id", "__key", "template", "block")],
        "low", "high"),
        F.col("doc_id").eqNullSafe(F.col("b_doc_id")) & (F.col("__key") == F.col("b___key"))
        & (F.col("template") == F.col("b_template"))
        & F.col("diagonal").between(F.col("low"), F.col("high")))
        .groupBy("b_doc_id", "b___key", "b_template", "b_block")
        .agg(F.countDistinct("t_place").alias("together")))
    out = bounds.join(places, F.col("doc_id").eqNullSafe(F.col("b_doc_id"))
                      & (F.col("__key") == F.col("b___key"))
                      & (F.col("template") == F.col("b_template"))
                      & (F.col("block") == F.col("b_block")), "left")
    fits = F.col("last") - F.col("first") + 1 <= 2 * F.col("t_runs") + neighbours
    held = F.greatest("best", F.when(fits, F.col("together")))
    return out.select(*of, "first", "last", (held / F.col("t_runs")).alias("share"), "n_exact",
                      "first_exact", "last_exact")


def scan(docs: DataFrame, phrases=None, notices=None, min_share: float = MIN_SHARE,
         neighbours: int = NEIGHBOURS, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_words, n_base, first_word, last_word, base_labels,
    labels, score`` (the best share of any template)."""
    phrases, notices = phrases or PHRASES, notices or NOTICES
    templates = template_runs(docs.sparkSession, [(t, label, True) for t, label in phrases]
                              + [(t, label, False) for t, label in notices])
    rows = texts(docs, id_col, text_col).withColumn("__key", row_key("doc_id", "text"))
    found = spans(votes(rows, templates), neighbours)
    base, exact = F.col("base"), F.col("base") & (F.col("n_exact") > 0)
    listed = (lambda when: F.array_join(F.array_sort(F.collect_set(F.when(
        when, F.col("label")))), ","))
    report = found.groupBy(F.col("doc_id").alias("d_id"), F.col("__key").alias("d_key")).agg(
        F.sum(F.when(base, F.col("n_exact"))).alias("n_base"),
        F.min(F.when(base, F.col("first_exact"))).alias("first_word"),
        F.max(F.when(base, F.col("last_exact"))).alias("last_word"),
        listed(exact).alias("base_labels"), listed(exact | (F.col("share") >= min_share)).alias(
            "labels"), F.max("share").alias("score"))
    counted = rows.select("doc_id", "__key", word_count(F.col("text")).alias("n_words"))
    return counted.join(report, F.col("doc_id").eqNullSafe(F.col("d_id"))
                        & (F.col("__key") == F.col("d_key")), "left").select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        F.col("first_word").cast("long"), F.col("last_word").cast("long"),
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"))
