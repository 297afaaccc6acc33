"""Classifiers by held-out accuracy, the language model by its own definition."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa

from tessera.llm import nbsvm, pseudo, zdict
from tessera.llm._words import shingles, words

SF = "/root/testdata/sf0.1"


def texts(data):
    column = pa.array(data, pa.large_string())
    return np.frombuffer(column.buffers()[2] or b"", dtype=np.uint8), np.frombuffer(column.buffers()[1], dtype=np.int64)


def test_words_are_those_of_the_pattern():
    from brute import words as plain

    rng = random.Random(2)
    data = ["", "one", "Ünö! TWO,three-4"] + ["".join(rng.choice("aB9 é-\n.ß") for _ in range(rng.randrange(40))) for _ in range(200)]
    hashes, counts = words(*texts(data))
    want = [plain(t) for t in data]
    assert counts.tolist() == [len(w) for w in want]
    flat = [w for x in want for w in x]
    assert len(set(zip(flat, hashes.tolist(), strict=True))) == len(set(flat)) == len(set(hashes.tolist()))
    values, runs = shingles(hashes, counts, 3)
    grams = [tuple(w[i : i + 3]) for w in want for i in range(max(len(w) - 2, min(len(w), 1)))]
    assert runs.sum() == len(grams) and len(set(zip(grams, values.tolist(), strict=True))) == len(set(grams)) == len(set(values.tolist()))


def held_out(spark, scored, target):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    return [(r.predicted, r[target]) for r in scored.filter("held_out").join(labels, "doc_id").collect()]


def test_quality_and_toxicity_generalise(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    pairs = held_out(spark, nbsvm.classify(docs, labels), "quality")
    assert np.mean([p == y for p, y in pairs]) > 0.98
    pairs = held_out(spark, zdict.classify(docs, labels), "toxic")
    # So small a table holds few of the words often enough: 65 of 97 were found when this was written.
    assert np.mean([p for p, y in pairs if y == 1]) > 0.6 and np.mean([p for p, y in pairs if y == 0]) < 0.02


def test_classifiers_without_labels_and_odd_rows(spark):
    docs = spark.createDataFrame([(1, "some words here", 0.5), (2, None, 0.1), (None, "", 0.2), (1, "some words here", 0.5), (3, "x" * 100_000, 0.0)], "doc_id long, text string, score double")
    none = spark.createDataFrame([(None, 1, 1), (7, None, None)], "doc_id long, quality int, toxic int")
    for classify in (nbsvm.classify, zdict.classify):
        rows = classify(docs, none).collect()
        assert len(rows) == 5 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows) and all(r.held_out is not None for r in rows)
        assert classify(docs.limit(0), none).count() == 0


def test_descent_reaches_the_optimum():
    rng = np.random.default_rng(0)
    rows = [np.flatnonzero(rng.random(30) < 0.3) for _ in range(120)]
    signs = np.where([3 in r for r in rows], 1.0, -1.0)
    scale = rng.normal(size=nbsvm.KINDS * nbsvm.BINS)
    w = nbsvm.dual_coordinate_descent(rows, scale, signs, epochs=2000)
    x = np.zeros((120, 30))
    for i, r in enumerate(rows):
        x[i, r] = scale[r] / max(np.linalg.norm(scale[r]), 1e-12)

    def loss(v):
        return 0.5 * v @ v + np.maximum(0, 1 - signs * (x @ v)).sum()

    best = loss(w[:30])
    assert all(best <= loss(w[:30] + d) + 1e-2 for d in rng.normal(scale=0.05, size=(200, 30)))


def test_pseudo_likelihood_is_the_sum_over_positions(spark):
    shape = pseudo.Shape(buckets=64, classes=12, own=8, side=2, hidden=5)
    docs = spark.createDataFrame([(i, " ".join(random.Random(i).choices(["a", "b", "c", "dd", "ee", "f"], k=40))) for i in range(30)] + [(98, None), (99, "!")], "doc_id long, text string")
    model = pseudo.train(docs, shape=shape, rounds=1, every=2, batch_size=16)
    hashes, counts = words(*texts(["a b c dd", "ee"]))
    got = model.log_probabilities(hashes, counts)
    bucket = pseudo.buckets(hashes, shape)
    embed, bias, out, base, leaf_out, leaf_base = model.parameters
    classes = model.vocab.of_bucket[bucket].tolist()
    groups, want = [classes[:4], classes[4:]], []
    for group in groups:
        for i in range(len(group)):
            around = [group[j] if 0 <= j < len(group) else 12 for j in (i - 2, i - 1, i + 1, i + 2)]
            h = np.tanh(sum(embed[k][c] for k, c in enumerate(around)) + bias)
            z = h @ out + base
            y = [h @ leaf_out[g] + leaf_base[g] for g in range(4)]
            shares = np.concatenate([np.exp(z[g]) / np.exp(z).sum() * np.exp(y[g]) / np.exp(y[g]).sum() for g in range(4)])
            assert np.isclose(shares.sum(), 1) and len(shares) == 12
            want.append(np.log(shares[group[i]]))
    assert np.allclose(got, np.array(want) + model.vocab.within[bucket], atol=1e-4)
    everything = np.bincount(model.vocab.of_bucket, np.exp(model.vocab.within), 12)
    assert np.allclose(everything[everything > 0], 1)
    rows = {r.doc_id: r for r in pseudo.score(docs, model).collect()}
    assert rows[98].n_words == 0 and rows[99].mean_log_likelihood is None and rows[0].log_likelihood < 0


def test_training_lowers_the_loss():
    rng = np.random.default_rng(1)
    shape = pseudo.Shape(buckets=16, classes=10, own=8, side=1, hidden=8)
    words_ = np.tile([0, 1, 2, 3], 300)
    around = pseudo.contexts(words_, np.array([len(words_)]), shape)
    parameters = [rng.normal(0, 0.1, s).astype(np.float32) for s in shape.sizes]
    memory = [np.zeros_like(p) for p in parameters]

    def loss():
        return -pseudo.log_shares(parameters, pseudo.hidden_units(parameters, around), words_).mean()

    before = loss()
    for _ in range(3):
        for i in range(0, 1200, 50):
            pseudo.train_step(parameters, memory, around[:, i : i + 50], words_[i : i + 50], 0.1)
    assert loss() < 0.2 < before


def test_every_word_is_a_target(spark):
    # A task's first word and each sixteenth after it are z; of the others each follows from its neighbours.
    text = " ".join("z" if i % 16 == 0 else "ab"[i % 2] for i in range(3200))
    docs = spark.createDataFrame([(i, text) for i in range(8)], "doc_id long, text string").coalesce(1)
    rows = pseudo.score_documents(docs).collect()
    assert len(rows) == 8 and all(r.mean_log_likelihood > -0.5 for r in rows)


def test_few_words_train_too(spark):
    docs = spark.createDataFrame([(i, "a b c d " * 5) for i in range(3)], "doc_id long, text string").repartition(3)
    assert np.abs(pseudo.train(docs).parameters[1]).max() > 0


def test_counts_are_those_of_real_words(spark):
    data = [" ".join(f"w{j}" for j in range(i, 120_000, 12)) + (" seldom" if i < 2 else "") + f" once{i}" for i in range(12)]
    docs = spark.createDataFrame([*enumerate(data + data[:6])], "doc_id long, text string")
    vocab = pseudo.train(docs, rounds=0).vocab
    # w-words of six texts and their six once-words stand twice, and so on; none shares its count with another.
    assert len(vocab.hashes) == 60_000 + 6 + 1
    rare, single, twice = vocab.rows(words(*texts(["seldom once11 w0"]))[0], pseudo.Shape())
    assert single == len(vocab.hashes) and len({rare, single, twice}) == 3
    share = np.exp(vocab.within) * vocab.mass[vocab.of_bucket]
    assert np.allclose(share[[rare, single, twice]], [4, 1, 2])
    total = np.append(share[:-1], share[-1] * 60_006)
    assert np.isclose(total.sum(), sum(len(x.split()) for x in data + data[:6]))


def test_indicators_take_little_memory_whatever_the_batch():
    rng = random.Random(8)
    known = ["".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 9))) for _ in range(3000)]
    data = [" ".join(rng.choice(known) for _ in range(500)) for _ in range(1300)]
    tracemalloc.start()
    made = 0
    for start, rows in nbsvm.indicators(pa.array(data)):
        assert start == made
        made += len(rows)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert made == len(data) and peak < 60e6
    alone = [next(nbsvm.indicators(pa.array([t])))[1][0] for t in data[:40]]
    together = [r for _, rows in nbsvm.indicators(pa.array(data[:40])) for r in rows]
    assert all((a == b).all() for a, b in zip(alone, together, strict=True))
