"""Learned operators: held-out accuracy, plain versions of their parts, and their edges."""

import random
import zlib

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from market_lens.llm import lang_crf, quality, toxicity
from market_lens.llm.common import table

BIG = "/root/testdata/sf0.1"


def is_held_out(i) -> bool:
    return i is None or zlib.crc32(str(i).encode()) % 5 == 0


@pytest.fixture(scope="module")
def docs(spark):
    return brute.with_clashes(spark.createDataFrame(brute.edge_docs(random.Random(6)), brute.DOCS)).drop("lang_pred", "score")


def accuracy(rows, truth: dict, column: str) -> tuple[float, float, float]:
    """Accuracy, precision and recall on held-out rows that have a truth."""
    seen = [(r[column], truth[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in truth]
    right = sum(a == b for a, b in seen) / len(seen)
    hits = sum(a == b == 1 for a, b in seen)
    return right, hits / max(1, sum(a == 1 for a, _ in seen)), hits / max(1, sum(b == 1 for _, b in seen))


def test_marginals_of_blocks_are_those_of_the_whole_text():
    rng = np.random.default_rng(0)
    model = lang_crf.Model(list("abcd"), None, rng.normal(0, 1, (4, 4)), frozenset())
    sizes = np.array([1, 5, 64, 65, 128, 129, 700])
    emission = rng.normal(0, 3, (sizes.sum(), 4))
    got, at = lang_crf.label_shares(model, emission, sizes), 0
    for k, n in enumerate(sizes.tolist()):
        assert np.allclose(got[k], brute.marginals(emission[at : at + n], model.switch).sum(axis=0))
        at += n


def test_training_gradient_is_that_of_the_likelihood():
    rng = np.random.default_rng(1)
    emission, switch = rng.normal(0, 1, (2, 6, 3)), rng.normal(0, 1, (3, 3))
    lengths = np.array([6, 4])
    marginal, pairs = lang_crf._posteriors(emission, switch, lengths)

    def log_total(e, s):
        total = 0.0
        for k, n in enumerate(lengths):
            before = np.full(3, -np.log(3))
            for t in range(n):
                before = e[k, t] + np.logaddexp.reduce(before[:, None] + s, axis=0)
            total += np.logaddexp.reduce(before)
        return total

    step = 1e-5
    for k, t, j in ((0, 0, 0), (0, 3, 1), (1, 3, 2)):
        moved = emission.copy()
        moved[k, t, j] += step
        assert np.isclose((log_total(moved, switch) - log_total(emission, switch)) / step, marginal[k, t, j], atol=1e-3)
    for a in range(3):
        for b in range(3):
            moved = switch.copy()
            moved[a, b] += step
            assert np.isclose((log_total(emission, moved) - log_total(emission, switch)) / step, pairs[a, b], atol=1e-3)


def test_code_switched_words_get_their_own_language():
    rng = random.Random(2)
    samples = [(brute.sentence(rng, 80, kind), kind) for kind in ("en", "de", "fr") for _ in range(30)]
    model = lang_crf.fit(samples)
    mixed = f"{brute.sentence(rng, 30, 'en')} {brute.sentence(rng, 10, 'fr')} {brute.sentence(rng, 60, 'de')}"
    words = lang_crf.words_of(mixed)
    shares = lang_crf.label_shares(model, model.emissions(words), np.array([len(words)]))[0]
    assert np.allclose(shares, [60, 30, 10], atol=4)
    assert lang_crf.Scorer(model)([mixed])[0] == ["de"]


def test_language_of_held_out_documents(spark):
    docs = table(spark, BIG, "documents")
    rows = lang_crf.predictions(docs).collect()
    truth = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    assert len(rows) == 10_000 and accuracy(rows, truth, "lang_pred")[0] > 0.98
    assert all(r["held_out"] == is_held_out(r["doc_id"]) and 0 <= r["score"] <= 1 for r in rows)


def test_language_at_the_edges(spark, docs):
    rows = lang_crf.predictions(docs).collect()
    assert len(rows) == docs.count()
    by_id = {r["doc_id"]: r for r in rows if r["doc_id"] is not None}
    assert all((by_id[i]["lang_pred"], by_id[i]["score"]) == ("und", 0.0) for i in (1, 2, 3))
    assert by_id[4]["lang_pred"] == "und" and by_id[6]["lang_pred"] == by_id[7]["lang_pred"] == "en"
    assert lang_crf.predictions(docs.limit(0)).count() == 0
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in lang_crf.predictions(unlabelled).collect()} == {"und"}
    kept = lang_crf.confident(docs)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in docs.collect()} - {1, 2, 3, 4} | {None}


def test_toxicity_of_held_out_documents(spark):
    labels = table(spark, BIG, "labels")
    rows = toxicity.scores(table(spark, BIG, "documents"), labels).collect()
    right, precise, found = accuracy(rows, {r["doc_id"]: r["toxic"] for r in labels.collect()}, "predicted")
    assert len(rows) == 10_000 and right > 0.94 and precise > 0.7 and found > 0.85
    assert all(r["predicted"] == int(r["score"] >= 0.5) and r["held_out"] == is_held_out(r["doc_id"]) for r in rows)


def test_label_model_finds_accuracies_and_discounts_copies():
    rng = np.random.default_rng(3)
    truth = rng.random(4000) < 0.2
    votes = []
    for accuracy in (0.95, 0.9, 0.85, 0.8):
        votes.append(np.where(rng.random(4000) < accuracy, truth, ~truth).astype(int))
    noisy = np.where(rng.random(4000) < 0.6, truth, ~truth).astype(int)
    cast = np.stack([*votes, noisy, noisy, noisy], axis=1)
    # a voter votes 1 or abstains; four others vote 0 or abstain
    both = np.concatenate([np.where(cast == 1, 1, -1), np.where(cast[:, :4] == 0, 0, -1)], axis=1)
    posterior, found = toxicity.label_model(both.astype(np.int8), np.ones(4000), 0.2)
    assert ((posterior > 0.5) == truth).mean() > 0.95
    rates = found["rates"][:, :4]
    assert np.allclose(rates[1], [0.95, 0.9, 0.85, 0.8], atol=0.08) and np.allclose(rates[0], [0.05, 0.1, 0.15, 0.2], atol=0.08)
    assert (found["news"][4:7] < 0.5).all()


def test_label_model_of_a_table_is_that_of_its_rows(spark):
    """Voters and rates come from all rows: a plain loop over the documents gives the same."""
    rng = random.Random(12)
    bad, mild = ["vileword", "nastyword", "meanword"], ["plain", "house", "water", "green"]
    rows, marks = [], []
    for k in range(400):
        y = int(rng.random() < 0.3)
        words = rng.choices(mild, k=6) + (rng.sample(bad, rng.randint(1, 2)) if y else []) + (["meanword"] if rng.random() < 0.05 else [])
        rows.append((k, " ".join(words)))
        if k % 3:
            marks.append((k, y))
    docs, labels = spark.createDataFrame(rows, "doc_id long, text string").repartition(5), spark.createDataFrame(marks, "doc_id long, toxic int")
    toxic, other = toxicity.class_counts(docs, toxicity._marks(labels))
    want = np.zeros((2, toxicity.BUCKETS), np.int64)
    for k, y in marks:
        if not is_held_out(k):
            for f in {f for w in set(dict(rows)[k].split()) for f in toxicity.features(w)}:
                want[y, f] += 1
    assert (toxic == want[1]).all() and (other == want[0]).all()


def test_a_word_too_rare_for_the_sample_is_found(spark):
    """The sample holds a few rows; the word stands in many labelled ones."""
    rng = random.Random(13)
    rows = [(k, f"{brute.sentence(rng, 12)} {'vileword' if k % 4 == 0 else 'plain'}{' rarething' if k % 40 == 0 else ''}") for k in range(2000)]
    rows += [(5000 + k, f"{brute.sentence(rng, 12)} rarething") for k in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    toxic = {k: int(k % 4 == 0) for k in range(2000)} | {5000 + k: 1 for k in range(20)}
    labels = spark.createDataFrame([(k, y) for k, y in toxic.items()], "doc_id long, toxic int")
    got = {r["doc_id"]: r for r in toxicity.scores(docs, labels, toxic_rows=20, other_rows=40, unlabelled_rows=10).collect()}
    assert all(got[5000 + k]["predicted"] == 1 for k in range(20) if got[5000 + k]["held_out"])
    assert np.mean([got[k]["predicted"] == y for k, y in toxic.items()]) > 0.97


def test_rows_that_share_an_id_are_drawn_one_by_one(spark):
    rows = [(1 if k % 3 else k, f"{'vileword' if k % 2 else 'plain'} {k}") for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k % 2)) for k in range(300)], "doc_id long, toxic int")
    model, read = toxicity.learned(docs, labels, "doc_id", "text", 10, 10, 10)
    assert model is not None and read.count() == 300
    drawn = lang_crf.sample(docs.withColumn("lang", F.lit("en")), "doc_id", "text", "lang", 50, 100)
    assert len(drawn) == 50 and len({t for t, _ in drawn}) == 50


def test_long_runs_and_long_texts(spark):
    assert [len(w) for w in lang_crf.words_of("x" * 150 + " y")] == [64, 64, 22, 1]
    rng = np.random.default_rng(2)
    model = lang_crf.Model(["a", "b"], np.zeros((4, 2)), np.array([[0.3, -0.3], [-0.3, 0.3]]), frozenset())
    sizes = np.array([1, 64, 65, 1000, 7])
    emission = rng.normal(size=(sizes.sum(), 2))
    got, at = lang_crf.label_shares(model, emission, sizes), 0
    for size, row in zip(sizes, got):
        assert np.allclose(row, brute.marginals(emission[at : at + size], model.switch).sum(axis=0))
        at += size


def test_the_whole_table_is_scored_in_each_round(spark):
    """A table of unlabelled rows hands over what a pool in memory does, up to a step of evidence and the draw."""
    rng = np.random.default_rng(8)
    n = 600
    truth = rng.random(n) < 0.4
    inside = truth[:, None] * 2.5 + rng.normal(0, 1, (n, 3)), np.zeros((n, 1), np.int64)
    outside = truth[:, None] * 2.5 + rng.normal(0, 1, (n, 3)), np.zeros((n, 2), np.int64)
    model = quality.co_train(inside, outside, np.where(np.arange(n) < 80, truth, -1).astype(np.int64), rounds=1)
    kind = "key long, f struct<inside: array<double>, outside: array<double>, places: array<int>>"
    rows = [(k, (inside[0][k].tolist(), outside[0][k].tolist(), [0, 0])) for k in range(80, n)]
    views = [model.content, model.layout]
    table = quality.TablePool(spark.createDataFrame(rows, kind).repartition(3), 10_000).surest(views, 0.4)
    local = quality.LocalPool(tuple(x[80:] for x in inside), tuple(x[80:] for x in outside)).surest(views, 0.4)
    for k, ((*mine, y), (*theirs, z)) in enumerate(zip(table, local)):
        assert 0 < len(y) <= len(z)  # whole steps of evidence that the quota holds
        evidence = [views[k].logits(views[k].columns(*rows[k])) for rows in (mine, theirs)]
        assert (np.abs(evidence[0]) > 1).all() and ((evidence[0] > 0) == (y > 0)).all()
        assert evidence[0].max() == evidence[1].max() or evidence[0].min() == evidence[1].min()
    drawn = quality.TablePool(spark.createDataFrame(rows, kind), 4).surest(views, 0.4)
    assert all(len(y) <= 4 for _, _, y in drawn)


def test_toxicity_at_the_edges(spark, docs):
    rng = random.Random(4)
    more = [(1000 + k, f"{brute.sentence(rng, 30)} {'nastyword' if k % 3 == 0 else 'plain'} {brute.sentence(rng, 9)}") for k in range(300)]
    every = docs.select("doc_id", "text", "digest").union(spark.createDataFrame(more, "doc_id long, text string").withColumn("digest", F.lit("")))
    marks = [(1000 + k, int(k % 3 == 0)) for k in range(300)] + [(None, 1), (1001, None), (1003, 1), (1, 0)]
    labels = spark.createDataFrame(marks, "doc_id long, toxic int").withColumn("score", F.lit(1))
    rows = toxicity.scores(every, labels).collect()
    assert len(rows) == every.count()
    by_id = {r["doc_id"]: r for r in rows if r["doc_id"] is not None}
    assert all(by_id[1000 + k]["predicted"] == int(k % 3 == 0) for k in range(300))
    assert by_id[1]["score"] == by_id[2]["score"] and by_id[1]["predicted"] == 0
    none = toxicity.scores(every, labels.limit(0)).collect()
    assert {r["score"] for r in none} == {0.0}
    assert toxicity.scores(every.limit(0), labels).count() == 0


def test_quality_of_held_out_documents(spark):
    labels = table(spark, BIG, "labels")
    rows = quality.scores(table(spark, BIG, "documents"), labels).collect()
    right, precise, found = accuracy(rows, {r["doc_id"]: r["quality"] for r in labels.collect()}, "predicted")
    assert len(rows) == 10_000 and right > 0.96 and precise > 0.96 and found > 0.97


def test_co_training_learns_from_the_pool():
    """Two noisy views of the same class: handing labels over must not harm, and the combination beats each view."""
    rng = np.random.default_rng(5)
    truth = rng.random(3000) < 0.5
    inside = truth[:, None] * 1.2 + rng.normal(0, 1, (3000, 3)), np.zeros((3000, 1), np.int64)
    outside = truth[:, None] * 1.2 + rng.normal(0, 1, (3000, 3)), np.zeros((3000, 2), np.int64)
    labels = np.where(np.arange(3000) < 60, truth, -1).astype(np.int64)
    model = quality.co_train(inside, outside, labels)
    test = slice(1000, 3000)
    got = ((model.score(inside, outside) > 0.5) == truth)[test].mean()
    each = [((v.logits(v.columns(*x)) > 0) == truth)[test].mean() for v, x in ((model.content, inside), (model.layout, outside))]
    assert got > 0.85 and got >= max(each) - 0.02


def test_quality_at_the_edges(spark, docs):
    ids = [r["doc_id"] for r in docs.select("doc_id").collect() if r["doc_id"] is not None]
    labels = spark.createDataFrame([(i, i % 2) for i in ids] + [(None, 0), (1, None)], "doc_id long, quality int")
    rows = quality.scores(docs, labels).collect()
    assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[6]["score"] == by_id[7]["score"]
    assert {r["score"] for r in quality.scores(docs, labels.limit(0)).collect()} == {0.5}
    assert quality.scores(docs.limit(0), labels).count() == 0


def test_texts_meet_few_labels_as_they_meet_many(spark):
    docs = spark.range(100).select(F.col("id").alias("doc_id"), F.lit("a b").alias("text"))
    marks = toxicity._marks(docs.select("doc_id", F.lit(1).alias("toxic")))
    joined = toxicity._labelled(docs, marks, "doc_id", "text")
    assert "SortMergeJoin" in joined._jdf.queryExecution().executedPlan().toString()
    assert joined.count() == marks.count() > 0
