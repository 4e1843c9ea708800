"""Defined cases of the operators, and queries against plain versions."""

from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from roadsift.llm import media, registry, sharding, toxicity, url_filter, vector_search

SF = "/root/testdata/sf0.001"


def test_urls_of_no_pages_and_of_repeated_pages(spark):
    pages = spark.createDataFrame([(1, "http://b.net/es/x", "h"), (1, "http://b.net/es/x", "h"), (2, None, "h")], "page_id long, url string, path string")
    assert url_filter.judge_urls(pages.filter("false"), registry.RULES).count() == 0
    assert sorted(r["verdict"] for r in url_filter.judge_urls(pages, registry.RULES).collect()) == ["allow", "block", "block"]


def test_media_and_scores_of_no_documents(docs, spark):
    assert media.media_column(docs([])).count() == 0
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)], "doc_id long, toxic int")
    model = toxicity.fit(docs([(i, "you are a fool" if i % 2 else "a fine day") for i in range(20)]), labels)
    assert toxicity.score_texts(docs([]), model).count() == 0
    twice = toxicity.score_texts(docs([(1, "a fine day"), (1, "a fine day"), (None, None)]).withColumn("score", F.lit(5)), model).collect()
    assert len(twice) == 3 and len({r["score"] for r in twice if r["doc_id"] == 1}) == 1


def test_search_with_columns_of_clashing_names(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(60, 8))
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>").withColumns({c: F.lit(1) for c in ("block", "score", "rank", "query_id", "t", "bucket", "v")})
    got = defaultdict(list)
    for r in vector_search.search(rows, rows.filter("vec_id % 20 = 0"), k=20).collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    assert sorted(got) == [0, 20, 40]
    for i, found in got.items():
        order = sorted((j for j in range(60) if j != i), key=lambda j: (-float(x[i] @ x[j]), j))[:20]
        assert [v for _, v, _ in sorted(found)] == order  # so few vectors are all compared
        assert all(abs(s - float(x[i] @ x[v])) < 1e-12 for _, v, s in found)


def test_op8_scores_are_the_products(spark):
    rows = {r["vec_id"]: np.array(r["embedding"], float) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()}
    for r in registry.op8_vector_search(spark, SF).collect():
        assert abs(r["score"] - float(rows[r["query_id"]] @ rows[r["vec_id"]])) < 1e-9


def test_op1_shards_follow_the_key(spark):
    """Rows of a shard have slots from 0 on, the shard follows doc_id alone, and one more shard takes rows only into itself."""
    rows, slots = registry.op1_sharding(spark, SF).collect(), defaultdict(list)
    alone = {r["record"]["doc_id"]: (r["shard"], r["grown_shard"]) for r in sharding.shuffle_into_shards(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", F.lit("other").alias("text")), registry.N_SHARDS).collect()}
    for r in rows:
        slots[r["shard"]].append(r["slot"])
        assert (r["shard"], r["grown_shard"]) == alone[r["doc_id"]] and r["grown_shard"] in (r["shard"], registry.N_SHARDS)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(24))


def test_op5_query_against_all_pairs(spark):
    text = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    sets = {}
    for i, t in text.items():
        w = t.encode().lower().split()
        sets[i] = {tuple(w[k : k + 4]) for k in range(max(1, len(w) - 3))} if w else set()
    head = {i: i for i in sets}

    def root(i):
        while head[i] != i:
            i = head[i]
        return i

    ids = sorted(i for i in sets if sets[i])
    for n, i in enumerate(ids):
        for j in ids[n + 1 :]:
            common = len(sets[i] & sets[j])
            if 100 * common >= 80 * (len(sets[i]) + len(sets[j]) - common):
                a, b = sorted((root(i), root(j)))
                head[b] = a
    for r in registry.op5_near_dedup(spark, SF).collect():
        i = r["doc_id"]
        assert (r["n_shingles"], r["component_id"], r["kept"]) == (len(sets[i]), root(i), root(i) == i)
