"""Every operator against brute force, with nulls, empty and long texts, ties, repeats, empty tables."""

import math
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm import plain
from tremora.llm import (exact_dedup, hnsw, licenses, minhash, packing, quality, queries, repeats,
                         sentencepiece_codec, toxicity, urls)

PIECES = public_tokenizers.path("piece_bpe_32k.model")


def by_id(df, *columns):
    return [tuple(r)[1:] for r in sorted(df.select("doc_id", *columns).collect())]


# --- 1 ----------------------------------------------------------------------------------------

def test_pieces_equal_the_library(spark):
    lib = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    r = random.Random(1)
    parts = ["a", "th", " ", "  ", "\n", "▁", "é", "漢", "😀", "\t", "###", "<s>", "ing", "\x00"]
    texts = plain.TEXTS + plain.long_texts() + ["".join(r.choices(parts, k=20)) for _ in range(300)]
    texts.append("ab" * 30_000)
    docs = plain.documents(spark, texts)
    got = sorted(sentencepiece_codec.encode(docs, PIECES, decoded=True).collect())
    for row, text in zip(got, texts):
        want = lib.encode(text or "") + [2]
        assert row.ids == want and row.decoded == lib.decode(want), repr(text)[:80]
    coded = sentencepiece_codec.encode(docs, PIECES)
    assert by_id(sentencepiece_codec.decode(coded, PIECES), "text") == [(r.decoded,) for r in got]
    assert sentencepiece_codec.encode(docs.limit(0), PIECES).count() == 0


def test_any_ids_decode_as_in_the_library():
    lib = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    tool, r = sentencepiece_codec.Codec(PIECES), random.Random(2)
    for _ in range(3000):
        ids = [r.choice([r.randrange(32000), r.randrange(3, 259), r.randrange(3), 259])
               for _ in range(r.randint(0, 9))]
        assert tool.decode(ids) == lib.decode(ids), ids


# --- 2 and 3 ----------------------------------------------------------------------------------

def labelled(spark, bad_word):
    r = random.Random(4)
    words = [f"w{k}" for k in range(200)]
    texts, marks = [], []
    for _ in range(400):
        bad = r.random() < 0.3
        body = r.choices(words, k=r.randint(5, 60))
        texts.append(bad_word(body) if bad else " ".join(body))
        marks.append(int(bad))
    docs = plain.documents(spark, texts + plain.TEXTS)
    labels = spark.createDataFrame(
        [(i, 1 - m, m) for i, m in enumerate(marks)] + [(3, None, None), (None, 1, 1), (10**6, 1, 1)],
        "doc_id bigint, quality int, toxic int")
    return docs, labels, marks


def test_toxicity_on_held_out_rows(spark):
    docs, labels, marks = labelled(spark, lambda w: " ".join(w[:4] + ["scum", "moron"] + w[4:]))
    model = toxicity.fit(docs, labels)
    got = sorted(toxicity.report(docs, model).collect())
    assert len(got) == len(marks) + len(plain.TEXTS) and all(0 <= r.score <= 1 for r in got)
    import zlib
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    assert all(r.predicted == marks[r.doc_id] for r in got[:len(marks)] if r.held_out)
    kept = toxicity.without_toxic(docs, model)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in got if not r.predicted}
    assert toxicity.report(docs.limit(0), model).count() == 0


def test_pairs_of_terms_count_more_than_their_sum():
    rng = np.random.default_rng(0)
    insult, group = rng.random(4000) < 0.5, rng.random(4000) < 0.5
    features = [np.array([k for k, on in enumerate(x) if on] + [2]) for x in zip(insult, group)]
    model = toxicity.fit_machine(features, (insult & group).astype(float), np.arange(3))

    def margin(*index):
        return model.margins(np.array(index), np.zeros(len(index), int), 1)[0]
    assert margin(0, 1, 2) > 0 > max(margin(0, 2), margin(1, 2))


def test_without_labels_scores_are_the_smoothed_share(spark):
    docs = plain.documents(spark, plain.TEXTS)
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    one = spark.createDataFrame([(0, 1, 0), (2, 1, 0)], none.schema)
    for module in (toxicity, quality):
        for labels in (none, one):
            scores = {round(r.score, 6) for r in module.report(
                docs, module.fit(docs, labels)).collect()}
            assert len(scores) == 1 and 0 < scores.pop() < 1


def test_quality_on_held_out_rows(spark):
    docs, labels, marks = labelled(spark, lambda w: " | ".join(w) + " ###")
    got = sorted(quality.report(docs, quality.fit(docs, labels)).collect())
    assert len(got) == len(marks) + len(plain.TEXTS) and all(0 <= r.score <= 1 for r in got)
    held = [r for r in got[:len(marks)] if r.held_out]
    right = sum(r.predicted == 1 - marks[r.doc_id] for r in held)
    assert right >= 0.95 * len(held)


# --- 4 ----------------------------------------------------------------------------------------

@pytest.mark.parametrize("group", [128, 2])
def test_repeats_against_brute_force(spark, group):
    texts = plain.TEXTS + plain.long_texts()
    docs = plain.documents(spark, texts)
    got = by_id(repeats.without_repeats(docs, length=60, gram=20, group=group).withColumn(
        "n", F.size("spans")), "n_bytes", "n_removed", "n", "kept")
    assert [(a, b, c, bytes(d)) for a, b, c, d in got] == plain.repeats(texts, 60)
    assert repeats.without_repeats(docs.limit(0)).count() == 0


def test_maximal_repeats_have_all_their_occurrences():
    contents = [b"xxABCDEFGHyy", b"zzABCDEFGHyw", b"qqABCDEFqqqq", b"rrABCDEFrrrr"]
    places, found = repeats.maximal_repeats(contents, [len(c) - 3 for c in contents], 4)
    groups = {(size, tuple(sorted(places[left:right + 1]))) for size, left, right in found}
    assert (6, ((0, 2), (1, 2), (2, 2), (3, 2))) in groups
    assert (9, ((0, 2), (1, 2))) in groups
    assert not any(size == 5 and (0, 3) in where for size, where in groups)  # BCDEF: not maximal


def test_cut_texts_keep_all_columns(spark):
    docs = plain.documents(spark, plain.TEXTS + plain.long_texts(), extra=True)
    out = repeats.cut_texts(docs, length=60)
    assert out.columns == docs.columns and out.schema["n_chars"].dataType.simpleString() == "bigint"
    got = {r.doc_id: r for r in out.collect()}
    assert got[1].text is None and got[0].text == "" and 7 not in got
    assert all(r.n_chars == len(r.text) for r in got.values() if r.text is not None)


# --- 5 ----------------------------------------------------------------------------------------

@pytest.mark.parametrize("bits,rows", [(64, 4096), (64, 4), (3, 4)])
def test_exact_duplicates_against_brute_force(spark, bits, rows):
    texts = plain.TEXTS + plain.long_texts() + ["hot"] * 50
    docs = plain.documents(spark, texts)
    got = by_id(exact_dedup.duplicates(docs, rows, bits), "keep_id", "group_size", "kept",
                "text_sha256")
    want = plain.exact_groups(texts)
    assert got == [(k, n, k == i, h) for i, (k, n, h) in enumerate(want)]
    if bits == 3:
        assert exact_dedup.chains(exact_dedup.build_index(docs, rows, bits)).count() > 0
    assert exact_dedup.duplicates(docs.limit(0)).count() == 0
    nulls = docs.withColumn("doc_id", F.when(F.col("doc_id") > 3, F.col("doc_id")))
    assert exact_dedup.duplicates(nulls).count() == len(texts)
    kept = exact_dedup.deduplicated(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {k for k, _, _ in want}


def test_the_directory_splits_overfull_buckets_only():
    directory = exact_dedup.grow_directory({0: 100, 1: 1, 8: 1}, 10, max_depth=4)
    depth = {slot: d for slot, _, d in directory}
    assert sorted(depth) == list(range(16)) and depth[0] == 4 and depth[15] == 1


# --- 6 ----------------------------------------------------------------------------------------

def test_packing_places_every_id_once(spark):
    texts = plain.TEXTS + plain.long_texts() + ["word " * 3000, "<|endoftext|> a  b", "é\n x"]
    docs = plain.documents(spark, texts)
    options = queries.tokenizer_options()
    pieces = packing.token_pieces(docs, **options, capacity=256, with_ids=True)
    tool = Tokenizer.from_file(options["path"])
    want = {i: tool.encode(t or "", add_special_tokens=False).ids + [1]
            for i, t in enumerate(texts)}
    got = {}
    for r in sorted(pieces.collect(), key=lambda r: (r.doc_id, r.start)):
        assert r.start == len(got.setdefault(r.doc_id, [])) and 0 < r.length <= 256
        got[r.doc_id] += r.ids
    assert got == want
    packed = packing.pack(pieces.drop("ids"), 3, 256).collect()
    assert len(packed) == pieces.count()
    rows = {}
    for r in sorted(packed, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == rows.get(r.sequence_id, 0)
        rows[r.sequence_id] = r.offset + r.length
    assert max(rows.values()) <= 256
    assert packing.pack_documents(docs.limit(0), **options).count() == 0


def test_both_tokenizers_agree_on_every_code_point():
    options = queries.tokenizer_options()
    tool = packing.ByteTokenizer(options["path"], options["ranks"], options["pattern"])
    lib = Tokenizer.from_file(options["path"])
    points = [c for c in range(0x110000) if not 0xD800 <= c <= 0xDFFF]
    for at in range(0, len(points), 4000):
        texts = ["".join(f"a{chr(c)}b 1{chr(c)} {chr(c)}. " for c in points[k:k + 40])
                 for k in range(at, min(at + 4000, len(points)), 40)]
        for text, want in zip(texts, lib.encode_batch(texts, add_special_tokens=False)):
            assert np.frombuffer(tool.encode(text), "<u4").tolist() == want.ids
    r = random.Random(8)
    pool = [" ", "  ", "\n", "\t", "\x0b", "\x1c", "\x85", "\u00a0", "\u2003", "\u200b", "a", "B",
            "'s", "'ll", "1", "\u00b2", "\u6f22", "\U0001f600", "<|endoftext|>", "-", "\r\n"]
    for _ in range(4000):
        text = "".join(r.choices(pool, k=r.randint(0, 20)))
        want = lib.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(tool.encode(text), "<u4").tolist() == want, repr(text)


def test_memos_do_not_keep_long_keys():
    from tremora.llm.common import Memo
    memo = Memo(len, limit=3)
    assert [memo["a" * k] for k in (1, 2, 300, 3, 4, 1)] == [1, 2, 300, 3, 4, 1]
    assert max(map(len, [*memo, *memo.old])) <= 256 and len(memo) <= 3


def test_first_fit_decreasing_is_first_fit():
    r = random.Random(6)
    sizes = sorted((r.randint(1, 100) for _ in range(300)), reverse=True)
    bins, want = [], []
    for n in sizes:
        k = next((k for k, used in enumerate(bins) if used + n <= 100), len(bins))
        bins += [0] * (k == len(bins))
        want.append((k, bins[k]))
        bins[k] += n
    assert packing.first_fit_decreasing(sizes, 100) == want


# --- 7 ----------------------------------------------------------------------------------------

URLS = ["http://a.example.net/en/1", "http://example.net/EN/1", "https://EXAMPLE.com/de/x?y#z",
        "http://x.org/fr/", "http://x.org/fr", "http://org/fr/1", "ftp://anet/", "no scheme", None,
        "", "http://net", "http://b.net?x/de/", "http://u:p@example.net:80/en/", "a://b://net/",
        "http://x.net?u=http://y/z", "http://org?next=://k/fr/", "http://a.org#://org/fr/",
        "http://x.com/go?to=http://b.net/", "http://x.net/a://b?c", "://net/", "x:/net://org\n/fr/"]
#: The host and path of each, by hand.
PARTS = [("a.example.net", "/en/1"), ("example.net", "/EN/1"), ("example.com", "/de/x"),
         ("x.org", "/fr/"), ("x.org", "/fr"), ("org", "/fr/1"), ("anet", "/"), ("", ""), ("", ""),
         ("", ""), ("net", ""), ("b.net", ""), ("u:p@example.net:80", "/en/"), ("b:", "//net/"),
         ("x.net", ""), ("org", ""), ("a.org", ""), ("x.com", "/go"), ("x.net", "/a://b"),
         ("net", "/"), ("org\n", "/fr/")]


def test_hosts_and_paths_by_hand_and_by_sql(spark):
    import duckdb

    from tremora.llm import oracle
    pages = spark.createDataFrame(list(enumerate(URLS)), "page_id bigint, url string")
    assert queries.RULES == [("net", "/", "block"), ("example.net", "/en/", "allow"),
                             ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
    rules = spark.createDataFrame(queries.RULES, "host string, path string, verdict string")
    got = sorted(tuple(r) for r in urls.judge(pages, rules).collect())
    assert [r[1:3] for r in got] == PARTS
    con = duckdb.connect()
    con.execute("CREATE TABLE pages(page_id BIGINT, url VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?)", list(enumerate(URLS)))
    assert sorted(con.execute(oracle.URL_FILTER).fetchall()) == got


@pytest.mark.parametrize("limit", [100, 0])
def test_rules_by_trie_and_by_join(spark, limit):
    pages = spark.createDataFrame([(i, u, "allow") for i, u in enumerate(URLS)],
                                  "page_id bigint, url string, verdict string")
    listed = queries.RULES + [("example.com", "/de/x", "allow"), ("a.b", "/", "block"),
                              ("example.net", "/e", "block")]
    rules = spark.createDataFrame(listed, "host string, path string, verdict string")
    got = sorted(urls.judge(pages, rules, trie_rules=limit).collect())
    for r in got:
        fits = [(h.count("."), len(p), h + p, v) for h, p, v in listed
                if (r.host == h or r.host.endswith("." + h)) and r.path.startswith(p)]
        best = max(fits, default=(0, 0, None, "allow"))
        assert (r.rule, r.verdict) == (best[2], best[3]), r
    assert [(r.host, r.path) for r in got[2:4]] == [("example.com", "/de/x"), ("x.org", "/fr/")]
    assert all((r.host, r.path, r.rule) == ("", "", None) for r in got[7:10])
    assert urls.judge(pages.limit(0), rules).count() == 0
    assert urls.judge(pages, rules.limit(0)).where("verdict <> 'allow'").count() == 0


@pytest.mark.parametrize("scale", [1.0, 1e100, 1e-100])
@pytest.mark.parametrize("shape", ["even", "clusters", "line"])
def test_graph_of_batches_finds_the_nearest(shape, scale):
    rng = np.random.default_rng(5)
    vectors = rng.normal(size=(3000, 1 if shape == "line" else 24))
    if shape == "clusters":
        vectors = vectors[rng.integers(0, 90, 3000)] * 10 + rng.normal(size=vectors.shape) * .05
    points = vectors[:200] + rng.normal(size=(200, vectors.shape[1])) * .01
    graph = hnsw.Graph.build(vectors * scale)
    found = graph.search(points * scale, 60)
    want = np.argsort(((points[:, None] - vectors) ** 2).sum(2), 1)[:, :10]
    caught = [len(set(a) & set(b)) for a, b in zip(found[:, :10].tolist(), want.tolist())]
    assert sum(caught) >= 0.97 * 10 * len(points)
    for layer, links in zip(graph.nodes, graph.links):
        assert np.isin(links[links >= 0], layer).all() and (links != layer[:, None]).all()
        assert all(len(set(x[x >= 0])) == (x >= 0).sum() for x in links)
    assert graph.search(points * scale, 3000).shape == (200, 3000)


# --- 8 ----------------------------------------------------------------------------------------

def test_neighbours_against_brute_force(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(900, 16)).astype(np.float32)
    base[100:300] = base[100]  # one vector two hundred times
    rows = [(i, [float(x) for x in v], "x") for i, v in enumerate(base)]
    rows += [(2000, None, "x"), (2001, [0.0] * 16, "x"), (2002, [float("nan")] * 16, "x"),
             (2003, [1.0, None] * 8, "x"), (2004, [float("inf")] * 16, "x"), (None, [1.0] * 16, "x"),
             (2005, [1.0, 2.0], "x"), (5, [float(x) for x in base[5]], "x")]
    vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, rank string")
    got = hnsw.nearest(vectors, vectors.where("vec_id % 25 = 0"), k=10, shard_rows=300).collect()
    asked = [i for i in range(900) if i % 25 == 0]
    assert {r.query_id for r in got} == set(asked)
    hits = 0
    for q in asked:
        gaps = np.sqrt(((base.astype(float) - base[q].astype(float)) ** 2).sum(1))
        want = sorted((g, i) for i, g in enumerate(gaps) if i != q)[:10]
        mine = sorted((r.rank, r.vec_id, r.score) for r in got if r.query_id == q)
        assert [m[0] for m in mine] == list(range(1, 11))
        assert all(math.isclose(s, gaps[v], abs_tol=1e-12) for _, v, s in mine)
        hits += len({v for _, v, _ in mine} & {i for _, i in want})
        if 100 <= q < 300:
            assert [v for _, v, _ in mine] == [i for _, i in want]  # ties to the smaller id
    assert hits >= 0.95 * 10 * len(asked)
    assert hnsw.nearest(vectors.limit(0), vectors.limit(0)).count() == 0


# --- 9 ----------------------------------------------------------------------------------------

@pytest.mark.parametrize("percent", [85, 60])
def test_near_duplicates_against_brute_force(spark, percent):
    texts = plain.TEXTS + plain.long_texts() + ["A b C d E f", "a B c D e F", "a b c d"]
    docs = plain.documents(spark, texts)
    got = by_id(minhash.near_duplicates(docs, percent), "n_shingles", "component_id", "kept")
    want = plain.near_groups(texts, percent)
    assert got == [(n, root, root == i) for i, (n, root) in enumerate(want)]
    kept = minhash.without_near_copies(docs, percent)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, (_, root) in enumerate(want) if root == i}
    assert minhash.near_duplicates(docs.limit(0)).count() == 0


def test_links_that_the_star_misses_are_found_in_blocks(spark):
    """A centre that is unlike two members, which are like each other."""
    words = [f"w{k}" for k in range(400)]
    center = words[:330] + [f"c{k}" for k in range(70)]
    twins = [words[:370] + [f"{t}{k}" for k in range(30)] for t in "pq"]
    texts = [" ".join(center)] + [" ".join(t) for t in twins]
    shingled = [minhash.shingles(t) for t in texts]
    keys = [minhash.band_keys(s, 32, 6) for s in shingled]
    bucket = int(np.flatnonzero(keys[1] == keys[2])[0])
    found = minhash.links_of_block([0, 1, 2], [0, 1, 2], shingled, [(True, True)] * 3,
                                   int(keys[1][bucket]), 80, 32, 6)
    assert found == [(1, 2)]


def test_links_with_unlike_signatures_are_not_passed_over():
    """Sets that are links by their members, however few bins of their signatures agree."""
    rng = np.random.default_rng(4)
    sets, worst = [], 1.0
    for _ in range(400):
        both = rng.integers(0, 2 ** 63, 230, dtype=np.uint64)
        pair = [np.unique(np.r_[both, rng.integers(0, 2 ** 63, 19, dtype=np.uint64)])
                for _ in range(2)]
        keys = [minhash.band_keys(s, 32, 6) for s in pair]
        if not (keys[0] == keys[1]).any():
            continue
        alike = (minhash.signature(pair[0], 192) == minhash.signature(pair[1], 192)).mean()
        if alike < worst:
            worst, sets = alike, [*pair, int(keys[0][keys[0] == keys[1]][0])]
    assert minhash.linked(*sets[:2], 85) and worst < 0.78
    assert minhash.links_of_block([1, 2], [1, 2], sets[:2], [(True, True)] * 2, sets[2], 85, 32, 6
                                  ) == [(1, 2)]


def test_a_bucket_of_two_thousand_sets_is_compared_in_blocks(spark):
    """One bucket, a centre unlike all others, and links among the others only."""
    r = random.Random(12)
    base = [f"w{k}" for k in range(60)]
    texts = []
    for k in range(1000):  # pairs of near copies; all share many words with all others
        words = base + [f"x{k}y{j}" for j in range(40)]
        texts += [" ".join(words), " ".join(words[:-1] + [f"z{k}"])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = dict(minhash.near_duplicates(docs, bands=32, rows=1).select(
        "doc_id", "component_id").collect())
    picks = r.sample(range(1000), 50)
    assert all(got[2 * k] == got[2 * k + 1] == 2 * k for k in picks)
    assert len(set(got.values())) == 1000


def test_sizes_by_two_dictionaries_equal_plain_calls():
    import zstandard
    good, bad = b"a good text of words " * 40, b"### | ### | x y z " * 40
    model = quality.Compressors(good, bad, (1.0, 0.0, 0.0))
    for text in ["", "a good text", "### | x", "a good text of words " * 900, "é" * 5000]:
        sizes = []
        for words in (good, bad):
            tool = zstandard.ZstdCompressor(
                level=quality.LEVEL, dict_data=zstandard.ZstdCompressionDict(words),
                write_checksum=False, write_content_size=False, write_dict_id=False)
            sizes.append(sum(len(tool.compress(text[k:k + quality.BLOCK].encode()))
                             for k in range(0, len(text), quality.BLOCK)))
        want = (sizes[1] - sizes[0]) / sum(sizes) if text else 0.0
        assert quality.Sizes(model).measure(text)[0] == want


def test_quality_of_no_documents(spark):
    docs, labels, _ = labelled(spark, lambda w: " | ".join(w) + " ###")
    model = quality.fit(docs, labels)
    assert quality.report(docs.limit(0), model).count() == 0
    twice = quality.report(docs.union(docs), model).groupBy("doc_id").agg(
        F.count_distinct("score").alias("n"), F.count(F.lit(1)).alias("rows"))
    assert twice.where("n <> 1 OR rows <> 2").count() == 0


def test_margins_of_the_machine_equal_a_plain_sum_over_pairs():
    rng = np.random.default_rng(1)
    features = [np.sort(rng.choice(50, rng.integers(1, 9), replace=False)) for _ in range(300)]
    model = toxicity.fit_machine(features, rng.integers(0, 2, 300).astype(float), np.arange(50))
    for terms in features[:40]:
        want = model.bias + sum(float(model.weights[t]) for t in terms)
        for i, a in enumerate(terms):
            for b in terms[i + 1:]:  # every pair of terms once
                want += sum(float(x) * float(y) for x, y in zip(model.factors[a], model.factors[b]))
        got = model.margins(terms, np.zeros(len(terms), int), 1)[0]
        assert math.isclose(got, want, rel_tol=1e-4, abs_tol=1e-4)


def test_components_of_chains_and_stars(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 160)] + [(7, 7)]
    links = spark.createDataFrame(edges, "a bigint, b bigint")
    got = {r.rep: r.root for r in minhash.components(links).collect()}
    assert got == {k: 0 for k in range(1, 41)} | {k: 100 for k in range(101, 160)} or got == {
        k: 0 for k in range(41)} | {k: 100 for k in range(100, 160)}


# --- 10 ---------------------------------------------------------------------------------------

def test_license_places_against_brute_force(spark):
    r = random.Random(9)
    words = "under the mit license apache version 2 cc by nc x 0 and".split()
    texts = plain.TEXTS + [" ".join(r.choices(words, k=r.randint(1, 80))) for _ in range(200)]
    texts += ["Under THE (MIT) license, under the mit license", "cc-by-nc cc by nc " * 30,
              "Licensed under the Apache License, Version 2.0.",
              "this work is licensed under the new gnu general public license version 3"]
    docs = plain.documents(spark, texts)
    got = by_id(licenses.scan(docs), "n_words", "n_base", "first_word", "last_word",
                "base_labels", "labels", "score")
    for row, text in zip(got, texts):
        n, places, labels = plain.license_places(text, licenses.PHRASES)
        ends = (places[0], places[-1]) if places else (None, None)
        assert row[:5] == (n, len(places), *ends, labels), text
        assert set(filter(None, labels.split(","))) <= set(row[5].split(",")) and 0 <= row[6] <= 1
    assert got[-2][5:] == ("apache-2", 1.0) and "gpl-3" in got[-1][5] and got[-1][6] < 1
    twice = docs.union(docs)
    assert sorted(licenses.scan(twice).collect(), key=str) == sorted(
        licenses.scan(docs).collect() * 2, key=str)
    assert licenses.scan(docs.limit(0)).count() == 0
    with pytest.raises(ValueError, match="fewer"):
        licenses.scan(docs, [("mit", "mit")])


