"""The pipeline against its stages' brute-force versions."""

import public_tokenizers as P
from tokenizers import Tokenizer

import corpus_pipeline
from test_dedup import components_of, removed

SF = "/root/testdata/sf0.001"
WORD = Tokenizer.from_file(P.path("word_bpe_49k.json"))


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    (_, toxic), (_, near), (_, cut), (_, pack) = corpus_pipeline.STAGES
    clean = toxic(spark, docs, SF)
    assert clean.columns == docs.columns
    kept = {r["doc_id"]: r for r in clean.collect()}
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert all(d in kept for d, t in labels.items() if t == 0)
    texts = [(d, r["text"]) for d, r in kept.items()]
    one = near(spark, spark.createDataFrame(list(kept.values()), docs.schema), SF)
    left = {r["doc_id"]: r for r in one.collect()}
    assert one.columns == docs.columns and set(left) == {d for d, c in components_of(texts, 5).items() if c[2]}
    short = cut(spark, spark.createDataFrame(list(left.values()), docs.schema), SF)
    assert short.columns == docs.columns
    expected = removed([(d, r["text"]) for d, r in left.items()], 35)
    final = {r["doc_id"]: r for r in short.collect()}
    for d, (_, gone, words) in expected.items():
        assert final[d]["text"] == (words if gone else left[d]["text"]) and final[d]["n_chars"] == len(final[d]["text"])
    pieces = pack(spark, spark.createDataFrame(list(final.values()), docs.schema), SF)
    got = {(r["doc_id"], r["start"]): r["length"] for r in pieces.collect()}
    assert sum(got.values()) == sum(len(WORD.encode(r["text"], add_special_tokens=False).ids) + 1 for r in final.values())
    run = {(r["doc_id"], r["start"]): r["length"] for r in corpus_pipeline.run(spark, SF).collect()}
    assert run == got


def test_repeated_rows_keep_their_text_once(spark, docs):
    text = " ".join(f"w{k}" for k in range(40))
    rows = docs([(1, text), (1, text), (2, text + " x"), (3, ""), (3, ""), (None, "no id"), (None, "no id")])
    _, near, cut, _ = (stage for _, stage in corpus_pipeline.STAGES)
    left = cut(spark, near(spark, rows, SF), SF).collect()
    assert sorted((r["doc_id"] or 0, r["text"]) for r in left) == [(0, "no id"), (0, "no id"), (1, text), (3, ""), (3, "")]


def test_empty_documents(spark, docs):
    none = docs([])
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, SF).count() == 0
