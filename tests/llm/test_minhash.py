"""Signatures against the similarity they stand for, components against all pairs."""

from itertools import combinations

import numpy as np
import pytest
from brute import components, jaccard, near_links, shingles

from tessera.llm import components as graph
from tessera.llm import minhash
from tessera.llm._work import Workspace

DATA = "/root/testdata/sf0.01"


def expected(rows, weighting="set", threshold=0.8):
    sets = {}
    for key, text in rows:
        s = shingles(text)
        sets[key] = s if weighting == "count" else type(s)(set(s))
    return components(sets, near_links(sets, threshold))


@pytest.mark.parametrize("weighting", ["set", "count"])
def test_all_pairs_of_a_table(spark, weighting):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    got = {r.doc_id: (r.component_id, r.kept) for r in minhash.near_duplicates(docs, weighting=weighting).collect()}
    want = expected([(r.doc_id, r.text) for r in docs.collect()], weighting)
    assert got == {k: (v, k == v) for k, v in want.items()}
    assert len(set(want.values())) < len(want)


def test_agreement_is_weighted_similarity():
    rng = np.random.default_rng(5)
    a = {int(x): w for x, w in zip(rng.integers(1, 1 << 60, 300), rng.uniform(0.2, 6, 300), strict=True)}
    b = {k: w * rng.uniform(0.4, 1.6) for k, w in list(a.items())[:260]}
    sets = [a, b, {7: 3.0}, {}]
    sig = minhash.dart_signatures(
        np.array([k for s in sets for k in s], dtype=np.uint64), np.array([w for s in sets for w in s.values()]), np.array([len(s) for s in sets]), 4096
    )
    true = sum(min(a.get(k, 0), b.get(k, 0)) for k in a | b) / sum(max(a.get(k, 0), b.get(k, 0)) for k in a | b)
    assert abs((sig[0] == sig[1]).mean() - true) < 4 * (true * (1 - true) / 4096) ** 0.5
    assert (sig[2] != 0).all() and (sig[3] == 0).all() and (sig[0] != sig[2]).all()


def test_signature_of_a_set_does_not_depend_on_its_neighbours():
    e = np.arange(1, 41, dtype=np.uint64)
    both = minhash.dart_signatures(e, np.ones(40), np.array([25, 15]), 252)
    assert (both[1] == minhash.dart_signatures(e[25:], np.ones(15), np.array([15]), 252)[0]).all()


def test_nulls_ties_repeats_and_other_columns(spark):
    base = " ".join(f"w{i}" for i in range(80))
    near = base.replace("w79", "other")
    other = " ".join(f"v{i}" for i in range(60))
    rows = [(9, base), (4, near), (4, near), (6, base.upper()), (None, base), (2, None), (1, ""), (3, "!? "), (8, "one two"), (7, "one two"), (5, other)]
    df = spark.createDataFrame([(k, t, "x", 1) for k, t in rows], "doc_id long, text string, component_id string, size int")
    got = sorted((r.doc_id or -1, r.component_id, r.kept) for r in minhash.near_duplicates(df).collect())
    assert got == [(-1, 4, False), (1, 1, True), (2, 2, True), (3, 3, True), (4, 4, True), (4, 4, True), (5, 5, True), (6, 4, False), (7, 7, True), (8, 7, False), (9, 4, False)]
    assert minhash.near_duplicates(df.limit(0)).count() == 0


@pytest.mark.parametrize("size", [1, 40])
def test_components_of_a_chain_and_a_star(spark, size):
    links = [(i, i + 1) for i in range(100, 100 + size)] + [(7, 50 + i) for i in range(size)] + [(3, 3)]
    df = spark.createDataFrame(links, "a long, b long")
    got = {r.node: r.component for r in graph.connected_components(df, Workspace(spark, "test")).collect()}
    nodes = {n for a, b in links if a != b for n in (a, b)}
    assert got == components(nodes, [x for x in links if x[0] != x[1]])


def test_crowds_of_near_misses(spark):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(60):
        words = [f"w{j}" for j in range(120)]
        for j in rng.choice(120, 1 + 2 * (i % 2), replace=False):
            words[j] = f"x{i}y{j}"
        rows.append((i, " ".join(words)))
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = expected(rows, "count")
    assert 1 < len(set(want.values())) < 60 and got == want


def test_crowd_members_without_common_edits_are_not_compared(spark, monkeypatch):
    rng = np.random.default_rng(4)
    rows = [(0, " ".join(f"w{j}" for j in range(120)))]
    for i in range(1, 121):
        words = [f"w{j}" for j in range(120)]
        for j in rng.choice(120, 1 if i % 2 else 3, replace=False):
            words[j] = f"x{i}y{j}" if i % 2 else f"s{j}"
        rows.append((i, " ".join(words)))
    kept, keep = {}, Workspace.keep
    monkeypatch.setattr(Workspace, "keep", lambda self, df, name: kept.setdefault(name, keep(self, df, name)))
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    sets = {k: shingles(t) for k, t in rows}
    want = components(sets, [(a, b) for a, b in combinations(sets, 2) if jaccard(sets[a], sets[b]) >= 0.8])
    assert 1 < len(set(want.values())) and got == want
    # 60 members have one edit each, their own, and 60 have three that others have too: pairs of one of each, 2,615 of 3,650 in shared buckets, need no comparison.
    assert kept["rest"].count() < 2000


def test_sharing_loses_no_pair(spark):
    rng = np.random.default_rng(6)
    centre = set(range(60))
    sets = [centre] + [(centre - set(rng.choice(60, rng.integers(0, 14)).tolist())) | set(rng.choice(np.arange(100, 120), rng.integers(0, 12)).tolist()) | {1000 + i} for i in range(80)]
    rows = []
    for i, s in enumerate(sets):
        alone = len(s - set().union(*(t for j, t in enumerate(sets) if j != i)))
        both = len(s & centre)
        rows.append((7, i, 0, len(s), alone, 60, both, both >= 0.8 * (len(s) + 60 - both)))
    df = spark.createDataFrame(rows, "bucket long, node long, head long, size int, alone int, other int, shared int, linked boolean")
    left = {r.node: r for r in minhash.sharing(minhash.edits(df, 0.8)).collect()}
    linked = {r[1] for r in rows if r[7]}
    pairs = [(a, b) for a, b in combinations(range(len(sets)), 2) if not {a, b} <= linked and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    assert pairs and 0 < len(left) < len(sets)
    for a, b in pairs:
        x, y = left[a], left[b]
        assert min(x.gone, y.gone) + min(x.new, y.new) >= x.need + y.need - 1e-9
