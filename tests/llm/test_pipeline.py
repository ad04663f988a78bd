"""Every stage of the pipeline against plain versions, on whole documents."""

import public_tokenizers
from test_lines import plain_dedup
from test_overlap import plain_kept as similar_kept
from test_quality import plain_kept
from test_tokens import check_packing
from tokenizers import Tokenizer

import corpus_pipeline
from shelfcast.llm import secret_lexer

STAGES = dict(corpus_pipeline.STAGES)


def test_stages_one_by_one(spark, sf, folder):
    source = spark.read.parquet(f"{sf}/documents.parquet")
    docs, seen = source, source.collect()
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = f"{folder}/{number}"
        stage(spark, docs, sf).write.parquet(path)
        docs = spark.read.parquet(path)
        rows = docs.collect()
        if name != "packing":
            assert docs.columns == source.columns and docs.dtypes == source.dtypes
        got = {r.doc_id: r for r in rows}
        pairs = [(d.doc_id, d.text) for d in seen]
        if name == "quality rules":
            assert set(got) == {i for i, t in pairs if plain_kept(t)}
        elif name == "line dedup":
            assert {i: r.text for i, r in got.items()} == dict(zip([i for i, _ in pairs], plain_dedup(pairs)))
        elif name == "near-dedup":
            assert sorted(got) == similar_kept(pairs)
        elif name == "secret scans":
            want = {i: secret_lexer.redact_text(t, "[secret]") for i, t in pairs}
            assert {i: r.text for i, r in got.items()} == want
        else:
            library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
            bins, tokens = check_packing(library, pairs, rows, 2048)
            assert bins <= -(-tokens // 2048) + 1
        assert number == 4 or 0 < len(rows) <= len(seen)
        seen = rows


def test_odd_and_empty_documents(spark, docs_frame):
    words = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)} is" for i in range(60))
    pairs = [(1, words), (1, words), (None, words + " more"), (2, None), (None, None), (3, ""), (4, "x" * 9000)]
    for pairs_now in (pairs, []):
        docs = docs_frame(pairs_now)
        for name, stage in corpus_pipeline.STAGES:
            docs = spark.createDataFrame(stage(spark, docs, None).collect(), stage(spark, docs, None).schema)
        assert docs.count() >= (1 if pairs_now else 0)
