"""The divergence audit against plain Python."""

import random
import re
from collections import Counter, defaultdict

import numpy as np

from tremora.llm import divergence

DDL = ("doc_id bigint, text string, lang string, source string, n_chars bigint, term string, "
       "value double, n int")


def plain_audit(rows, min_docs=10, top=10):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    docs = [(lang or "", source or "", re.findall(
        r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(lower)))
        for text, lang, source in rows]
    seen, held, sources = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for lang, source, found in docs:
        sources[lang].add(source)
        seen[lang, source].update(found)
        seen[lang].update(found)
        held[lang].update(set(found))
    out = []
    for lang, names in sources.items():
        kept = [t for t, n in held[lang].items() if n >= min_docs]

        def shares(counts):
            total = sum(counts[t] for t in kept)
            return {t: 1 + 10 ** 9 * (counts[t] + 2) // (total + 2 * len(kept)) for t in kept}
        whole = shares(seen[lang])
        own = {s: shares(seen[lang, s]) for s in names}
        for s in names:
            pairs = [(sum((own[s][t] - own[o][t]) ** 2 // (own[s][t] + own[o][t]) for t in kept), o)
                     for o in names if o != s]
            terms = [((own[s][t] - whole[t]) ** 2 // (own[s][t] + whole[t]), t) for t in kept
                     if seen[lang, s][t] and own[s][t] > whole[t]]
            for part, found, most in (("pair", pairs, len(pairs)), ("term", terms, top)):
                found.sort(key=lambda f: (-f[0], f[1].encode()))
                out += [(lang, s, part, item, value, k + 1)
                        for k, (value, item) in enumerate(found[:most])]
    return sorted(out)


def against_plain(spark, rows, min_docs=10, top=10, parts=3):
    df = spark.createDataFrame(
        [(k, t, lang, s, 1, "x", 0.5, 1) for k, (t, lang, s) in enumerate(rows)], DDL)
    got = divergence.audit(df.repartition(parts), min_docs, top)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(tuple(r) for r in got.collect()) == plain_audit(rows, min_docs, top)


def corpus(seed=1, docs=400):
    r = random.Random(seed)
    words = [f"w{chr(97 + k % 26)}{'é' * (k % 3)}{chr(97 + k // 26)}" for k in range(120)]
    rows = []
    for _ in range(docs):
        lang = r.choice(["en", "en", "de", None])
        source = "hot" if r.random() < 0.4 else r.choice(["a", "b", "c", "", None])
        first = {"a": 0, "b": 30, "hot": 10}.get(source, 20)
        body = r.choices(words[first:first + 90], k=r.randint(0, 40))
        rows.append((r.choice([" ", ", ", "\n", "1"]).join(body).replace("wa", "WA"), lang, source))
    return rows


def test_audit_equals_plain_python(spark):
    against_plain(spark, corpus())
    against_plain(spark, corpus(2), min_docs=3, top=4)


def test_ties_nulls_and_groups_without_terms(spark):
    same = [("one two three four five six seven eight nine ten eleven twelve", "en", s)
            for s in "ab" for _ in range(10)]
    rows = same + [(None, "en", "c"), ("", "en", None), ("123 !!", "xx", "a"), ("rare", "yy", "a"),
                   ("rare", "yy", "b"), (None, None, None), ("Zürich ÄÖ É" * 3, "en", "a")]
    # all words of a tie have one value, so the report ends within a cell
    rows += [("alpha beta gamma delta epsilon zeta eta theta iota kappa lambda my", "en", "d")] * 10
    against_plain(spark, rows)
    against_plain(spark, rows + [("word " * 50_000, "en", "a")] * 10)


def test_pairs_in_many_blocks(spark):
    rows = corpus(3)
    docs = spark.createDataFrame([(k, t, lang, s) for k, (t, lang, s) in enumerate(rows)],
                                 "doc_id int, text string, lang string, source string")
    counts = divergence.term_counts(docs)
    kept = divergence.kept_terms(counts)
    groups = divergence.group_totals(counts, kept)
    got = divergence.pair_sums(kept, groups, cells=30, block=50).collect()
    want = {(lang, s, item): value for lang, s, part, item, value, _ in plain_audit(rows)
            if part == "pair"}
    assert {(r.lang, r.source, r["item"]): r.value for r in got} == want


def test_empty_table_and_early_flush(spark, monkeypatch):
    against_plain(spark, [])
    monkeypatch.setattr(divergence, "FLUSH_BYTES", 50)
    assert [tuple(r) for r in divergence.term_counts(spark.createDataFrame(
        [(1, "a b a", "en", "s", 1, "x", 0.5, 1)] * 600, DDL).coalesce(1)).orderBy("term").collect()
    ] == [("en", "s", None, 0, 0), ("en", "s", "a", 1200, 600), ("en", "s", "b", 600, 600)]


def test_large_counts_do_not_overflow():
    counts = np.array([[10 ** 13, 0], [3, 10 ** 12]])
    totals, terms = [10 ** 13 + 3, 10 ** 12], 2
    p = [[1 + 10 ** 9 * (int(c) + 2) // (t + 2 * terms) for c, t in zip(row, totals)]
         for row in counts]
    want = sum(5 * ((a - b) ** 2 // (a + b)) for a, b in p)
    found = divergence.block_sums(counts, np.array([5, 5]), totals, terms)
    assert found == [[0, want], [want, 0]]


def test_shares_of_large_counts(spark):
    from pyspark.sql import functions as F
    row = spark.range(1).select(divergence.share(F.lit(10 ** 15), F.lit(10 ** 16), F.lit(7)).alias("p"))
    assert int(row.first().p) == 1 + 10 ** 9 * (10 ** 15 + 2) // (10 ** 16 + 14)
