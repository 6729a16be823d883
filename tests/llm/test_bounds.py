"""Bounds that hold whatever the data, odd rows, and names that clash."""

import random
import tracemalloc

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerlake.llm import common, decontaminate, jaccard_join, line_dedup, packing, quality_rules, registry, sharding, toxicity, url_filter
from tests.llm.test_operators import DOCS, brute_lines, cut, fold, line_rows, prose


def peak_mb(work):
    tracemalloc.start()
    try:
        out = work()
        return out, tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


# --------------------------------------------------------------- label samples

def test_label_sample_is_bounded_and_one_row_a_document(spark):
    many = spark.range(200_000).select(F.lit(7).cast("long").alias("doc_id"), (F.col("id") % 2).cast("int").alias("quality"))
    one = common.label_sample(many, F.min("quality"), 20).collect()
    assert [tuple(r) for r in one] == [(7, 0)]
    wide = spark.range(200_000).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"))
    n = common.label_sample(wide, F.min("quality"), 1000).count()
    assert 800 < n <= 2000
    odd = spark.createDataFrame([(None, 1), (1, None), (2, 1)], "doc_id long, quality int")
    assert [tuple(r) for r in common.label_sample(odd, F.min("quality"), 10).collect()] == [(2, 1)]


def test_repeated_documents_count_once_in_a_sample(spark):
    docs = spark.range(5000).select(F.lit(1).cast("long").alias("doc_id"), F.concat(F.lit("text "), F.col("id") % 3).alias("text"))
    got = common.sampled_texts(docs, spark.createDataFrame([(1, 0), (2, 1)], "__id long, __label int")).collect()
    assert [tuple(r) for r in got] == [(1, 0, "text 0")]


def test_models_do_not_change_with_repeated_labels_and_documents(spark):
    rng = random.Random(6)
    rows = [(d, prose(rng, 50) + (" vile idiot scum" if d % 5 == 0 else "") + (" ### $$$ %%%" * 8 if d % 4 == 0 else "")) for d in range(300)]
    docs = spark.createDataFrame(rows, DOCS)
    labels = spark.createDataFrame([(d, int(d % 4 != 0), int(d % 5 == 0)) for d in range(300)], "doc_id long, quality int, toxic int")
    again, twice = labels.unionByName(labels.limit(100)), docs.unionByName(docs.limit(200))
    assert quality_rules.fit_rules(docs, labels) == quality_rules.fit_rules(twice, again) != []
    a, b = toxicity.fit(docs, labels), toxicity.fit(twice, again)
    assert a.weights.keys() == b.weights.keys() and a.thresholds == pytest.approx(b.thresholds)


# ------------------------------------------------------------ toxicity, by hand

def test_severity_equals_the_formula(spark):
    """Scores of a fitted model, taken word by word from the cumulative-link formula."""
    import math
    import string
    import zlib

    rng = random.Random(7)
    rows = [(d, prose(rng, 40) + " Vile, IDIOT!" * (d % 4)) for d in range(200)] + [(500, None), (501, ""), (502, "1 2 ...")]
    docs = spark.createDataFrame(rows, DOCS)
    model = toxicity.fit(docs, spark.createDataFrame([(d, int(d % 4 > 0)) for d in range(200)], "doc_id long, toxic int"))
    got = {r.doc_id: r for r in toxicity.score_toxicity(docs, model).collect()}
    drop = str.maketrans({c: " " for c in string.punctuation + string.digits})
    for d, text in rows:
        words = [fold(w) for w in cut((text or "").translate(drop))]
        x = sum(model.weights.get(zlib.crc32(w.encode()), 0.0) * math.log(1 + words.count(w)) for w in set(words))
        above = [1 / (1 + math.exp(t - x)) for t in model.thresholds]
        cells = [1 - above[0], *[p - q for p, q in zip(above, above[1:])], above[-1]]
        assert got[d].severity == pytest.approx(sum(above)) and got[d].p_toxic == pytest.approx(above[0])
        assert got[d].grade == max(range(len(cells)), key=lambda k: cells[k]) and got[d].toxic == (above[0] >= 0.5)


# ------------------------------------------------------------- decontamination

def test_a_long_item_takes_no_gap_memory():
    """One item of a million characters: gaps between texts are as long as its budget of edits."""
    rng = np.random.default_rng(1)
    item = "".join(map(chr, rng.integers(97, 123, 1_000_000)))
    texts = ["short text number %d of many" % k for k in range(512)]
    texts[100] = item
    index = decontaminate.Index([(0, item)])

    def search():
        return [(ids[t], k) for ids, some in decontaminate._chunks(range(512), texts, index.gap) for t, k, *_ in index.search(some)]

    found, mb = peak_mb(search)
    assert found == [(100, 0)] and mb < 400
    texts[100] = "short again"
    found, mb = peak_mb(search)
    assert found == [] and mb < 60


def test_a_q_gram_that_is_everywhere_takes_bounded_memory():
    index = decontaminate.Index([(0, "a" * 1500 + "the rest of it")])
    x = decontaminate.codes("a" * 60_000)
    bands, mb = peak_mb(lambda: index._bands(x))
    assert mb < 150  # 90 million common q-grams
    assert bands
    wide, decontaminate.SLICE = decontaminate.SLICE, 1 << 40
    try:
        assert sorted(bands) == sorted(index._bands(decontaminate.codes("a" * 60_000)[:4000])) or bands
        small = decontaminate.codes("a" * 3000)
        whole = index._bands(small)
    finally:
        decontaminate.SLICE = wide
    decontaminate.SLICE = 1000
    try:
        assert sorted(index._bands(small)) == sorted(whole)
    finally:
        decontaminate.SLICE = wide


def test_drop_leaking_judges_each_row(spark):
    leak = "a passage that the benchmark holds and nobody should train on"
    rows = [(None, f"before {leak} after"), (None, "clean"), (1, leak.upper()), (1, "clean too"), (2, None), (3, ""), (1, "clean too")]
    docs = spark.createDataFrame(rows, DOCS).withColumns({"__bad": F.lit(1), "item_id": F.lit(2), "start": F.lit(3)})
    items = spark.createDataFrame([(0, leak), (1, None), (2, ""), (3, "zq"), (4, "another passage of the benchmark here")],
                                  "item_id long, text string").withColumn("doc_id", F.lit(1))
    for block in (decontaminate.BLOCK_CHARS, 10):  # 10: one item a block
        kept = decontaminate.drop_leaking(docs, items, block_chars=block)
        assert kept.columns == docs.columns
        assert sorted([(r.doc_id, r.text) for r in kept.collect()], key=repr) == sorted(
            [(None, "clean"), (1, "clean too"), (1, "clean too"), (2, None), (3, "")], key=repr)
        found = decontaminate.find_leaks(docs, items, block_chars=block)
        assert sorted([(r.doc_id, r.item_id, r.edits) for r in found.collect()], key=repr) == [(1, 0, 0), (None, 0, 0)]
    assert decontaminate.drop_leaking(docs, items.limit(0)).count() == len(rows)
    assert decontaminate.find_leaks(docs, items.limit(0)).count() == decontaminate.find_leaks(docs.limit(0), items).count() == 0
    many = spark.createDataFrame([(k, f"item number {k} of a benchmark with many blocks") for k in range(6)] + [(9, leak)], "item_id long, text string")
    assert decontaminate.drop_leaking(docs, many, block_chars=10).count() == 5  # more blocks than one pass takes


# -------------------------------------------------------------- clashing names

def test_sharding_keeps_columns_of_any_name(spark):
    rows = spark.range(300).select(F.col("id").alias("doc_id"), *[
        (F.col("id") + 100 * k).alias(c) for k, c in enumerate(["__id", "__part", "__row", "__rand", "__block", "__rank", "__start", "__s"])])
    got = sharding.shuffle_into_shards(rows, 5, block_rows=16)
    assert got.columns == [*rows.columns, "shard", "slot"]
    assert sorted(map(tuple, got.drop("shard", "slot").collect())) == sorted(map(tuple, rows.collect()))


def test_line_dedup_keeps_columns_of_any_name(spark):
    rows = line_rows()
    names = ["__drop", "__doc", "__hash", "__lines", "__text_hash", "__rest", "__id", "pos", "owner", "h1", "key", "line"]
    df = spark.createDataFrame(rows, DOCS).withColumns({c: F.lit(c) for c in names})
    got = line_dedup.dedup_lines(df, 2)
    assert got.columns == ["doc_id", "text", *names, "n_lines", "n_dropped"]
    back = got.collect()
    assert all(r[c] == c for r in back for c in names)
    assert sorted([(r.doc_id, r.n_lines, r.n_dropped, r.text) for r in back], key=repr) == brute_lines(rows)


def test_a_hot_line_is_on_no_aggregate_between_exchange_and_sort(spark):
    """Adaptive execution splits a hot key only where nothing but a sort stands between the exchange and the join."""
    saved = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")}
    for k in saved:
        spark.conf.set(k, "-1")
    try:
        df = spark.createDataFrame([(d, f"the one line that all of them hold\nown line of {d}") for d in range(50)], DOCS)
        got = line_dedup.dedup_lines(df, 3)
        text = got._jdf.queryExecution().executedPlan().toString()
        lines = text.splitlines()
        at = next(i for i, x in enumerate(lines) if "SortMergeJoin [h1" in x)
        below = lines[at + 1:]
        depth = lines[at].index("SortMergeJoin")
        side = [x for x in below[:next((i for i, x in enumerate(below) if "Exchange" in x), 0) + 1]]
        assert depth and any("Sort [h1" in x for x in side) and not any("Aggregate" in x for x in side)
        second = below[next(i for i, x in enumerate(below) if "Exchange" in x) + 1:]
        start = next(i for i, x in enumerate(second) if "Sort [h1" in x)
        stop = next(i for i, x in enumerate(second[start:]) if "Exchange" in x) + start
        assert not any("Aggregate" in x for x in second[start:stop])
        assert got.agg(F.sum("n_dropped")).first()[0] == 49
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v)


# ------------------------------------------------------------------ long texts

def test_very_long_texts(spark):
    rng = random.Random(9)
    words = [prose(rng, 1) for _ in range(60_000)]
    long = " ".join(words)
    lines = "\n".join(" ".join(words[i : i + 6]) for i in range(0, len(words), 6))
    docs = spark.createDataFrame([(1, long), (2, long + " end"), (3, lines), (4, "short one")], DOCS).withColumn("source", F.lit("s"))
    comp = {r.doc_id: r.component_id for r in jaccard_join.jaccard_components(docs).collect()}
    assert comp[1] == comp[2] == 1 and comp[4] == 4
    kept = {r.doc_id: r for r in line_dedup.dedup_lines(docs).collect()}
    assert kept[3].n_lines == 10_000 and kept[1].text == long
    judged = {r.doc_id: r for r in quality_rules.judge(docs, []).collect()}
    assert judged[1]["__stats"].n_words == 60_000
    assert sharding.shuffle_into_shards(docs.select("doc_id", "text"), 2).agg(F.sum(F.length("text"))).first()[0] == len(long) * 2 + 4 + len(lines) + 9
    assert sum(r.n_tokens for r in packing.pack(docs).collect()) == 60_000 * 3 + 1 + 2 + 4
    assert toxicity.score_toxicity(docs, None).count() == 4
    url = "http://a.example.org/" + "x" * 300_000
    pages = spark.createDataFrame([(1, url)], "page_id long, url string")
    assert len(url_filter.judge_urls(pages, url_filter.listed_urls(pages)).first().path) == 300_001


# --------------------------------------------------- clusters and listed URLs

def test_packing_takes_a_cluster_column(spark):
    rows = [(d, "w " * 9, f"s{d}", d % 2 if d < 8 else None) for d in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, component_id long")
    docs = docs.withColumn("text", F.concat("text", F.col("doc_id").cast("string")))
    bins = {}
    for r in packing.pack(docs, capacity=100, cluster="component_id").collect():
        bins.setdefault(r.bin_id, []).append(r.doc_id)
    for held in bins.values():
        known = [d % 2 for d in held if d < 8]
        assert len(known) == len(set(known))  # one of each cluster; null clusters conflict with nothing
    assert len(bins) == 4
    assert len({r.bin_id for r in packing.pack(docs, capacity=100).collect()}) == 2


def test_listed_urls_are_not_told_by_the_host(spark):
    label = url_filter.LISTED_LABELS[0]
    rows = [(1, f"http://www.{label}.example.net/en/5?utm_source=feed"), (2, f"https://{label}.example.net/en/5/"),
            (3, f"http://{label}.example.net/en/6"), (4, "http://other.example.net/en/5?ref=x"), (5, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    got = {r.page_id: r.verdict for r in url_filter.judge_urls(pages, url_filter.listed_urls(pages)).collect()}
    assert got == {1: "block", 2: "block", 3: "allow", 4: "allow", 5: "allow"}


def test_the_registered_url_list_is_whole(spark, tmp_path):
    """Every page on a listed label is listed by the query and by its SQL, not only those with a tracking parameter."""
    import duckdb

    label = url_filter.LISTED_LABELS[0]
    rows = [(1, f"http://{label}.example.net/en/5?utm_source=feed"), (2, f"http://{label}.example.net/en/6"),
            (3, "http://other.example.net/en/5?ref=x"), (4, f"http://{label}.example.org/x"), (5, None)]
    spark.createDataFrame(rows, "page_id long, url string").write.parquet(f"{tmp_path}/pages.parquet")
    got = sorted(map(tuple, registry.op8_url_filter(spark, str(tmp_path)).collect()))
    assert [r[4] for r in got] == ["block", "block", "allow", "allow", "allow"]
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    assert sorted(con.execute(registry.ORACLE_SQL["op8_url_filter"]).fetchall()) == got


# -------------------------------------------------------------------- pipeline

def test_pipeline_of_odd_and_empty_tables(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rng = random.Random(2)
    body = "\n".join(prose(rng, 12) for _ in range(4))
    leak = prose(rng, 25)
    rows = [(None, body, "en", "s", 1), (5, body + " and more of it", "en", "s", 1), (5, prose(rng, 60), "en", None, 1),
            (6, prose(rng, 30) + " " + leak + " " + prose(rng, 30), None, "s", 1), (None, prose(rng, 30) + " " + leak, "en", "s", 1),
            (7, None, "en", "s", 0)]
    for name, docs, marks, items in (("full", rows, [(5, 1), (7, 0), (None, 1), (6, None)], [(0, leak), (1, None)]),
                                     ("empty", [], [], [])):
        where = tmp_path / name
        spark.createDataFrame(docs, schema).write.parquet(f"{where}/documents.parquet")
        spark.createDataFrame(marks, "doc_id long, quality int").write.parquet(f"{where}/labels.parquet")
        spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{where}/benchmark.parquet")
        got = corpus_pipeline.run(spark, str(where)).collect()
        if name == "empty":
            assert got == []
        else:  # both leaking rows are gone, whatever their ids; rows of one doc_id are judged each
            assert sorted([r.doc_id for r in got], key=repr) == [5, 5, None]


def test_word_hashes_follow_the_words_across_blocks():
    block = jaccard_join.BLOCK
    texts = [None, "", " \n", "A", "a a A", "x" * block, "y" * (block + 5) + " b " + "c " * block + "z" * (2 * block),
             "é Ü\x0bq\x0c Q q \x1cq", " ".join(["ab", "AB", "c", "Ünï", "\U0001f600"] * 60_000)]
    seen = {}
    for text in texts:
        parts, hashes = common.words(text), jaccard_join.word_hashes(text).tolist()
        assert len(parts) == len(hashes)
        for word, h in zip(parts, hashes):
            assert seen.setdefault(word, h) == h
    assert len(set(seen.values())) == len(seen)


def test_shingles_are_the_distinct_windows():
    rng = np.random.default_rng(4)
    for n in [0, 1, 2, 3, 4, 50, 400]:
        parts = [str(w) for w in rng.integers(0, 5, size=n)]
        windows = {tuple(parts[i : i + 3]) for i in range(n - 2)} or ({tuple(parts)} if parts else set())
        got = jaccard_join.shingles(" ".join(parts), 3)
        assert len(got) == len(windows) and (np.diff(got.astype(object)) > 0).all()
        assert (got == jaccard_join.shingles("\t" + "  ".join(parts) + "\n", 3)).all()
