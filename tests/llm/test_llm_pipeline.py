"""The pipeline stage by stage against plain versions, and the registered queries."""

import hashlib
import random
import re

import brute
import numpy as np
import pytest
import public_tokenizers
import sentencepiece

import __spark_entry__ as contract
import corpus_pipeline
from market_lens.llm import chunk_dedup, lang_crf
from market_lens.llm.common import table

NAMES = ["language", "near_duplicates", "substrings", "decontamination", "tokens"]
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """A small corpus with every planted case, written as the given tables are."""
    rng = random.Random(21)
    kinds = ("en", "de", "fr")
    rows = [(k, brute.sentence(rng, rng.randint(20, 150), kinds[k % 3]), kinds[k % 3], f"s{k % 5}", 1) for k in range(150)]
    item, passage = brute.sentence(rng, 30), brute.sentence(rng, 60)
    rows += [(200 + k, rows[3][1], "en", "copies", 1) for k in range(20)]
    rows += [(230, rows[6][1] + " " + brute.sentence(rng, 1), "en", "near", 1)]
    rows += [(240 + k, f"{brute.sentence(rng, 40)} {passage} {brute.sentence(rng, 30)}", "en", "shared", 1) for k in range(4)]
    rows += [(250, f"{brute.sentence(rng, 40)} {item} {brute.sentence(rng, 30)}", "en", "leak", 1)]
    rows += [(260, None, None, None, None), (261, "", "en", "a", 0), (262, "1234 %%%", "en", "a", 8)]
    path = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(rows, brute.DOCS).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def rows_of(df) -> dict:
    return {r["doc_id"]: r.asDict() for r in df.collect()}


def plain_language(spark, docs: dict, folder: str) -> set:
    model = lang_crf.learn(table(spark, folder, "documents"))
    kept = set()
    for i, r in docs.items():
        words = lang_crf.words_of(r["text"] or "")
        if words and any(c.isalpha() for c in r["text"]):
            shares = brute.marginals(model.emissions(words), model.switch).sum(axis=0)
            if shares.max() / shares.sum() >= 0.4:
                kept.add(i)
    return kept


def test_stages_against_plain_versions(spark, folder):
    assert [n for n, _ in corpus_pipeline.STAGES] == NAMES and corpus_pipeline.ORACLE_SQL is None
    stages = dict(corpus_pipeline.STAGES)
    docs = table(spark, folder, "documents")
    before = rows_of(docs)

    out = corpus_pipeline.materialize(stages["language"](spark, docs, folder))
    after = rows_of(out)
    assert out.columns == COLUMNS and set(after) == plain_language(spark, before, folder)
    assert not {260, 261, 262} & set(after) and set(range(150)) <= set(after)

    docs, before = out, after
    out = corpus_pipeline.materialize(stages["near_duplicates"](spark, docs, folder))
    after = rows_of(out)
    ids = sorted(before)
    roots = brute.components([brute.simhash_of(before[i]["text"]) for i in ids])
    assert out.columns == COLUMNS and set(after) == {ids[r] for r in roots} and out.count() == len(after)
    assert not set(range(200, 220)) & set(after) and 3 in after

    docs, before = out, after
    out = corpus_pipeline.materialize(stages["substrings"](spark, docs, folder))
    after = rows_of(out)
    found = brute.repeats(
        {i: r["text"] for i, r in before.items()},
        chunk_dedup.cut,
        chunk_dedup._digests,
        chunk_dedup._passages,
        chunk_dedup.MIN_WORDS,
        chunk_dedup.REACH,
    )
    assert out.columns == COLUMNS
    for i, r in before.items():
        data = r["text"].encode()
        for a, b in reversed(found[i][1]):
            data = data[:a] + data[b:]
        assert after[i]["text"] == data.decode() and after[i]["n_chars"] == len(data.decode())
    assert [bool(found[i][1]) for i in range(240, 244)] == [False, True, True, True]
    assert not any(found[i][1] for i in range(150))

    docs, before = out, after
    out = corpus_pipeline.materialize(stages["decontamination"](spark, docs, folder))
    after = rows_of(out)
    items = [(r["item_id"], r["text"]) for r in table(spark, folder, "benchmark").collect()]
    assert out.columns == COLUMNS
    assert set(after) == {i for i, r in before.items() if not brute.contamination(r["text"], items)[1]}
    assert set(before) - set(after) == {250}

    tokens = rows_of(stages["tokens"](spark, out, folder))
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    for i, r in after.items():
        ids = library.encode(r["text"])
        assert tokens[i]["n_tokens"] == len(ids)
        assert tokens[i]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    run = rows_of(contract.queries()["pipeline"](spark, folder))
    assert run == tokens


def test_stages_on_empty_tables(spark, folder):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, table(spark, folder, "documents").limit(0), folder).count() == 0


def test_each_dealt_operator_has_one_query():
    names = contract.queries()
    assert [sum(bool(re.match(rf"op{n}_", x)) for x in names) for n in range(1, 14)] == [1] * 13
    assert "pipeline" in names and {"op2_kd_topk", "op4_decontamination", "op6_warc"} <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", ["op2_kd_topk", "op4_decontamination", "op6_warc", "op11_prefix_trie", "op13_phrases"])
def test_queries_match_their_sql(spark, sf_dir, name):
    from compare import engine, rows_of

    df = contract.queries()[name](spark, sf_dir)
    cursor = engine(sf_dir).execute(contract.oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows_of(df.columns, df.collect()) == rows_of(columns, cursor.fetchall())


def test_queries_without_sql_return_whole_tables(spark, sf_dir):
    queries = contract.queries()
    n = table(spark, sf_dir, "documents").count()
    for name in ("op1_sentencepiece", "op3_toxicity", "op5_language", "op7_simhash", "op9_chunk_dedup", "op10_quality", "op12_fertility"):
        assert queries[name](spark, sf_dir).count() == n
    assert np.isin([-7], [r["conv_id"] for r in queries["op8_chat_windows"](spark, sf_dir).collect()]).all()
