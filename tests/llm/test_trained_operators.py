"""Toxicity, quality and the pipeline: held-out accuracy, gradients, and odd tables."""

import random
import zlib
from itertools import product

import numpy as np
import pytest

import corpus_pipeline
from lakewright.llm import bpe, labelled, quality, toxicity

LABELS = "doc_id long, quality int, toxic int, text string"
SF = "/root/testdata/sf0.01"


def labels_of(spark, rows):
    return spark.createDataFrame([(i, q, t, "clash") for i, q, t in rows], LABELS)


def words_of(rng, n):
    return " ".join("".join(rng.choice("aeioust") for _ in range(5)) for _ in range(n))


@pytest.fixture(scope="module")
def toxic(spark, docs_of):
    rng = random.Random(1)
    texts, rows = [], []
    for i in range(400):
        bad = i % 4 == 0
        texts.append(words_of(rng, 30) + (" insultus " + words_of(rng, 10) + " badword" if bad else ""))
        rows.append((i, 1, int(bad)))
    return docs_of(texts), labels_of(spark, rows), {r[0]: r[2] for r in rows}


def test_toxicity_on_held_out_rows(toxic):
    docs, labels, truth = toxic
    rows = toxicity.score(docs, labels).collect()
    assert len(rows) == 400
    held = [r for r in rows if r.held_out]
    assert {r.doc_id for r in held} == {i for i in truth if zlib.crc32(str(i).encode()) % 4 == 2}
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.95
    kept = toxicity.keep_clean(docs, labels)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in rows if not r.predicted}


def test_toxicity_never_reads_held_out_labels(spark, toxic):
    docs, labels, truth = toxic
    lies = labels_of(spark, [(i, 1, 1 - t if zlib.crc32(str(i).encode()) % 4 == 2 else t) for i, t in truth.items()])
    score = lambda own: sorted((r.doc_id, r.score) for r in toxicity.score(docs, own).collect())
    assert score(labels) == score(lies)


def test_factors_learn_what_weights_cannot():
    rng = np.random.default_rng(2)
    a, b, docs, labels = 5, 9, [], []
    for _ in range(1200):
        x, y = rng.integers(0, 2, 2)
        docs.append(np.unique([*([a] if x else []), *([b] if y else []), *rng.integers(100, 160, 5)]).astype(np.int32))
        labels.append(float(x and y))
    model = toxicity.fit(docs, np.array(labels))
    score = lambda *t: model.score(np.array(t, np.int32))
    assert score(a, b) > 0.7 > 0.3 > max(score(a), score(b), score(101))


def test_factorization_machine_sums_pairs():
    rng = np.random.default_rng(3)
    model = toxicity.FactorizationMachine(np.arange(toxicity.BUCKETS, dtype=np.int32), 0.1, rng.normal(size=6), rng.normal(size=(6, toxicity.FACTORS)) / 4)
    rows = [0, 2, 3, 5]
    raw = 0.1 + model.weights[rows].sum() + sum(model.factors[i] @ model.factors[j] for i in rows for j in rows if i < j)
    assert model.score(np.array(rows, np.int32)) == pytest.approx(1 / (1 + np.exp(-raw)))


@pytest.mark.parametrize("operator", [toxicity.score, quality.score])
def test_scores_of_odd_tables(spark, docs_of, operator):
    docs = docs_of([None, "", " \n ", "word " * 30_000, "a\n" * 20_000, "plain", "plain"], [0, 1, 2, 3, 4, None, 5])
    for rows in ([], [(None, None, None), (3, None, None)], [(i, 1, 0) for i in range(9)], [(i, i % 2, i % 2) for i in range(9)] + [(3, 0, 0), (77, 1, 1)]):
        got = operator(docs, labels_of(spark, rows)).collect()
        assert len(got) == 7 and all(0 <= r.score <= 1 for r in got)
    assert operator(docs_of([]), labels_of(spark, [])).count() == 0
    assert all(r.predicted == 0 for r in toxicity.score(docs, labels_of(spark, [])).collect())


def test_the_sample_is_bounded_and_the_same_each_time(spark, docs_of):
    docs, labels = docs_of([f"t{i}" for i in range(60)]), labels_of(spark, [(i, 1, i % 2) for i in range(60)] * 2)
    take = lambda: sorted(r.doc_id for r in labelled.sample(docs, labels, "toxic", 4, 2, 10).collect())
    assert len(take()) == 10 and take() == take()


def test_repeats_of_one_document_are_one_row_of_the_sample(spark, docs_of):
    texts = [f"text {i % 3}" for i in range(5_000)] + [f"other {i}" for i in range(20)]
    ids = [0] * 5_000 + list(range(1, 21))
    docs, labels = docs_of(texts, ids), labels_of(spark, [(i, i % 2, i % 2) for i in range(21)] * 2)
    for label in ("toxic", "quality"):
        rows = labelled.sample(docs, labels, label, 4, 9, 30).collect()
        assert sorted(r.doc_id for r in rows) == list(range(21))
        again = labelled.sample(docs.repartition(7), labels, label, 4, 9, 30).collect()
        assert sorted(rows) == sorted(again)  # the text that is taken doesn't depend on the order of rows


def test_repeats_do_not_outweigh_the_rest(toxic, spark, docs_of):
    docs, labels, truth = toxic
    many = docs.union(docs.where("doc_id = 4").crossJoin(spark.range(300)).drop("id"))
    alone = {r.doc_id: r.score for r in toxicity.score(docs, labels).collect()}
    assert all(r.score == alone[r.doc_id] for r in toxicity.score(many, labels).collect())


def test_shared_stems_are_terms():
    own = lambda t: set(toxicity.terms(t).tolist())
    assert all(x < toxicity.HALF for x in own("achlichte other"))
    two, three = own("achlichte achlichge"), own("achlichte achlichge achlichen")
    assert {x for x in two if x >= toxicity.HALF} < {x for x in three if x >= toxicity.HALF}
    assert own("achlichte achlichte") == own("achlichte")


def test_keep_clean_of_odd_tables(spark, docs_of):
    docs = docs_of([None, "", "x " * 30_000, "plain", "plain"], [0, None, 2, 3, 3])
    for rows in ([], [(3, 1, 0)], [(None, None, None)]):
        assert toxicity.keep_clean(docs, labels_of(spark, rows)).count() == 5
    assert toxicity.keep_clean(docs, labels_of(spark, [(i, 1, 1) for i in range(9)])).count() == 0
    assert toxicity.keep_clean(docs_of([]), labels_of(spark, [])).count() == 0


def test_held_out_recall_on_the_tables(spark):
    read = lambda name: spark.read.parquet(f"{SF}/{name}.parquet")
    truth = {r.doc_id: r.toxic for r in read("labels").collect()}
    held = [r for r in toxicity.score(read("documents"), read("labels")).collect() if r.held_out and truth.get(r.doc_id) is not None]
    bad = [r for r in held if truth[r.doc_id]]
    assert np.mean([r.predicted for r in bad]) > 0.84 and np.mean([r.predicted for r in held if not truth[r.doc_id]]) < 0.05


# --- quality


def test_gradient_is_the_slope_of_the_weighted_likelihood():
    rng = np.random.default_rng(6)
    counts, labels = np.array([3, 0, 1, 4]), np.array([1, 0, 0, 1])
    x, own = rng.normal(size=(8, 5)), rng.integers(0, 2, 8)
    weight = quality._line_weights(counts, labels, np.array([0.3, 0.7]))
    assert np.allclose(np.bincount(np.repeat(range(4), counts), weight, 4), [0.7, 0, 0.3, 0.7])  # a document's lines share its weight
    emission, transition = rng.normal(size=(5, 2)), rng.normal(size=(2, 2))
    value, e, t = quality.objective(x, counts, own, weight, emission, transition)
    want, at = 0.0, 0
    for n, w in zip(counts, (0.7 / 3, 0, 0.3, 0.7 / 4)):  # whole chains by their weight
        score = lambda ys: sum(x[at + k] @ emission[:, y] for k, y in enumerate(ys)) + sum(transition[a, b] for a, b in zip(ys, ys[1:]))  # noqa: E731, B023
        if n:
            want += w * (score(own[at : at + n]) - np.log(sum(np.exp(score(ys)) for ys in product((0, 1), repeat=int(n)))))
        at += n
    assert value == pytest.approx(want)
    for k in np.ndindex(5, 2):
        step = np.zeros((5, 2))
        step[k] = 1e-5
        up, down = (quality.objective(x, counts, own, weight, emission + s, transition)[0] for s in (step, -step))
        assert e[k] == pytest.approx((up - down) / 2e-5, abs=1e-6)
    for k in np.ndindex(2, 2):
        step = np.zeros((2, 2))
        step[k] = 1e-5
        up, down = (quality.objective(x, counts, own, weight, emission, transition + s)[0] for s in (step, -step))
        assert t[k] == pytest.approx((up - down) / 2e-5, abs=1e-6)


def test_the_fit_reads_every_line(spark, docs_of):
    """What tells bad from good stands beyond the first thousand lines."""
    good, bad = "A plain line of words.", "@@ ## $$ %% !!"
    texts = ["\n".join([good] * 1_500 + [bad if i % 2 else good] * 1_500) for i in range(24)]
    got = quality.score(docs_of(texts), labels_of(spark, [(i, 1 - i % 2, 0) for i in range(24)])).collect()
    assert all(r.predicted == 1 - r.doc_id % 2 for r in got)


def test_forward_backward_is_the_sum_over_all_labellings():
    rng = np.random.default_rng(4)
    counts = np.array([3, 0, 1, 5])
    potentials, transition = rng.normal(size=(9, 2)), rng.normal(size=(2, 2))
    marginal, pair, _, _ = quality.chain(potentials, counts, transition)
    want, pairs, at = np.zeros((9, 2)), np.zeros((2, 2)), 0
    for n in counts:
        total, own, between = 0.0, np.zeros((n, 2)), np.zeros((2, 2))
        for ys in product((0, 1), repeat=int(n)):
            p = np.exp(sum(potentials[at + t, y] for t, y in enumerate(ys)) + sum(transition[a, b] for a, b in zip(ys, ys[1:])))
            total += p
            for t, y in enumerate(ys):
                own[t, y] += p
            for a, b in zip(ys, ys[1:]):
                between[a, b] += p
        want[at : at + n] = own / total
        pairs += between / total
        at += n
    assert np.allclose(marginal, want) and np.allclose(pair.sum(0), pairs)


def test_quality_on_held_out_rows(spark, docs_of):
    rng = random.Random(5)
    texts, rows = [], []
    for i in range(300):
        bad = i % 3 == 0
        lines = ["### $$$ %%% !!! " * 6 if bad and rng.random() < 0.8 else words_of(rng, 12).capitalize() + "." for _ in range(rng.randrange(1, 9))]
        if bad:
            lines.append("@@ ## !! " * 9)
        texts.append("\n".join(lines))
        rows.append((i, int(not bad), 0))
    got = quality.score(docs_of(texts), labels_of(spark, rows)).collect()
    held = [r for r in got if r.held_out]
    assert {r.doc_id for r in held} == {i for i in range(300) if zlib.crc32(str(i).encode()) % 3 == 1}
    assert np.mean([r.predicted == rows[r.doc_id][1] for r in held]) > 0.95
    lies = [(i, 1 - q if zlib.crc32(str(i).encode()) % 3 == 1 else q, t) for i, q, t in rows]
    assert sorted(got) == sorted(quality.score(docs_of(texts), labels_of(spark, lies)).collect())


def test_line_features_do_not_depend_on_the_batch():
    texts = [b"One line. two\nTWO!!\n\nthree | four", b"", b"x", b"One line. two\nTWO!!"]
    together, counts, size = quality.line_features(texts)
    apart = [quality.line_features([t]) for t in texts]
    assert np.array_equal(together, np.concatenate([a[0] for a in apart])) and counts.tolist() == [3, 0, 1, 2]
    assert np.array_equal(size, np.concatenate([a[2] for a in apart]))


# --- pipeline


def test_pipeline_stages_take_effect(spark, docs_of, tmp_path):
    rng = random.Random(8)
    passage = words_of(rng, 14)
    texts = [words_of(rng, 40) + (" insultus badword" if i % 5 == 0 else "") for i in range(150)]
    long = words_of(rng, 300)
    texts += [long, long, "A " + passage, "mail joe.doe@example.com now please", None, ""]
    docs_of(texts).write.parquet(f"{tmp_path}/documents.parquet")
    labels_of(spark, [(i, 1, int(i % 5 == 0)) for i in range(150)]).write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs, seen = docs_of(texts), {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        if name != "bpe":
            assert docs.columns == docs_of([]).columns
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        seen[name] = {r.doc_id for r in docs.collect()}
    assert len([i for i in seen["toxicity"] if i < 150 and i % 5 == 0]) == 0 and 151 in seen["toxicity"]
    assert 150 in seen["near-dedup"] and 151 not in seen["near-dedup"]
    assert 152 in seen["near-dedup"] and 152 not in seen["decontamination"]
    assert seen["decontamination"] == seen["pii"] == seen["bpe"] and 153 in seen["pii"]
    whole = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted(whole.collect()) == sorted(docs.collect())


@pytest.mark.parametrize("rows", [[], [(None, "x y z")], [(1, "same text of many words here"), (1, "same text of many words here"), (1, None), (2, ""), (None, "same text of many words here"), (None, None)]])
def test_pipeline_of_odd_tables(spark, docs_of, tmp_path, rows):
    docs_of([t for _, t in rows], [i for i, _ in rows]).write.parquet(f"{tmp_path}/documents.parquet")
    labels_of(spark, [(1, 1, 0), (2, 1, 0)]).write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    # Near-dedup leaves one row of the copies, with the smallest id, and one of the rows without words.
    want = {0: [], 1: [None], 6: [1, 1]}[len(rows)]
    assert sorted((r.doc_id for r in out), key=str) == want


def test_pipeline_query_is_its_stages_on_the_tables(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    assert rows and all(r.n_tokens >= 0 for r in rows) and bpe.WHOLE > 0
