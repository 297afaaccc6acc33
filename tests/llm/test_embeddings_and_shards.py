"""Threshold pairs and shards against brute force."""

import math
import zlib

import numpy as np
import pytest
from brute import components
from pyspark.sql import functions as F

from tessera.llm import covertree, hilbert

SCHEMA = "vec_id long, embedding array<float>, label int, n_links string, key string"


def crowd(rng, n, dim, spread):
    return rng.normal(size=dim) + rng.normal(scale=spread, size=(n, dim))


def test_dual_traversal_finds_every_pair():
    rng = np.random.default_rng(1)
    parts = [crowd(rng, 300, 8, 0.05), crowd(rng, 200, 8, 0.3), rng.normal(size=(300, 8))]
    points = np.concatenate(parts)
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    for right in (None, points[400:]):
        left = points if right is None else points[:400]
        other = left if right is None else right
        want = {(int(i), int(j)) for i, j in zip(*np.nonzero(left @ other.T >= 0.98), strict=True) if right is not None or i != j}
        got = [(int(i), int(j)) for a, b in covertree.dual_pairs(left, right, 0.98) for i, j in zip(a, b, strict=True)]
        found = set(got) if right is not None else set(got) | {(j, i) for i, j in got}
        assert found == want and len(want) > 100
    tree = covertree.cover_tree(points)

    def check(node):
        away = np.sqrt(np.maximum(2 - 2 * (points[node.rows] @ points[node.centre]), 0))
        assert away.max() <= node.radius + 1e-9
        if node.children:
            assert sorted(np.concatenate([c.rows for c in node.children])) == sorted(node.rows)
            for c in node.children:
                check(c)

    check(tree)


def brute(rows, threshold):
    out, links = {}, []
    usable = {}
    for k, v, label in rows:
        ok = v is not None and label is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v)
        if ok:
            x = np.array(v, dtype=np.float32).astype(float)
            usable[k] = (label, x / np.linalg.norm(x))
        out[k] = 0
    keys = list(usable)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            if usable[a][0] == usable[b][0] and len(usable[a][1]) == len(usable[b][1]) and usable[a][1] @ usable[b][1] >= threshold:
                links.append((a, b))
                out[a] += 1
                out[b] += 1
    c = components(out, links)
    return {k: (n, c[k], c[k] == k) for k, n in out.items()}


@pytest.mark.parametrize("block", [2048, 20])
def test_links_and_components(spark, block):
    rng = np.random.default_rng(2)
    vectors = np.concatenate([crowd(rng, 60, 6, 0.1), crowd(rng, 30, 6, 0.05), rng.normal(size=(60, 6))]).astype(np.float32)
    rows = [(int(i) * 3 + 1, [float(x) for x in v], int(i % 2)) for i, v in enumerate(vectors)]
    rows += [(1000 + i, rows[0][1], rows[0][2]) for i in range(5)]
    odd = [None, [], [0.0] * 6, [1.0, None, 0.0, 0.0, 0.0, 0.0], [math.nan] * 6, [math.inf] + [0.0] * 5, [1.0, 2.0]]
    rows += [(2000 + i, v, 0) for i, v in enumerate(odd)] + [(3000, rows[0][1], None), (3001, [1e-30, 0.0, 0.0, 0.0, 0.0, 0.0], 0), (3002, [1e30, 0.0, 0.0, 0.0, 0.0, 0.0], 0)]
    df = spark.createDataFrame([(k, v, lab, "x", "y") for k, v, lab in rows], SCHEMA)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in covertree.near_embeddings(df, threshold=0.98, block=block, sample=40, most_centres=6).collect()}
    assert got == brute(rows, 0.98)


def test_null_ids_repeats_and_empty(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0], 0, "", ""), (1, [1.0, 0.0], 0, "", ""), (None, [1.0, 0.0], 0, "", ""), (2, [1.0, 0.0], 0, "", "")], SCHEMA)
    got = sorted((r.vec_id or 0, r.n_links, r.component_id, r.kept) for r in covertree.near_embeddings(df).collect())
    assert got == [(0, 0, None, True), (1, 1, 1, True), (1, 1, 1, True), (2, 1, 1, False)]


def test_hilbert_curve_steps_to_neighbours():
    for d, bits in ((2, 4), (3, 3)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * d), -1).reshape(-1, d)
        index = hilbert.hilbert_index(cells, bits)
        assert sorted(index) == list(range(len(cells)))
        path = cells[np.argsort(index)]
        assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_shards(spark):
    rows = [(i, None if i % 13 == 0 else "é" * (i % 7), None if i % 5 == 0 else f"l{i % 3}", f"s{i % 4}", "x") for i in range(70)] + [(None, "same", "l1", "s1", "x"), (3, "same", "l1", "s1", "x"), (3, "same", "l1", "s1", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, shard string")
    got = hilbert.shard_documents(df, shards=16).collect()
    key = lambda r: tuple(-1 if x is None else x for x in r)
    assert sorted(((r.doc_id, r["size"], r.text_crc32) for r in got), key=key) == sorted(((k, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for k, t, *_ in rows), key=key)
    slots = {}
    for r in got:
        slots.setdefault(r.shard, []).append(r.slot)
    assert set(slots) == set(range(16)) and all(sorted(x) == list(range(len(x))) for x in slots.values()) and max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    order = [r.curve for r in sorted(got, key=lambda r: (r.shard, r.slot))]
    assert order == sorted(order)
    assert hilbert.shard_documents(df.limit(0)).count() == 0 and {r.shard for r in hilbert.shard_documents(df.limit(3)).collect()} == {0, 1, 2}


def test_files_can_be_pruned(spark, tmp_path):
    df = spark.range(3000).select(F.col("id").alias("doc_id"), (F.col("id") % 97).alias("n"), F.concat(F.lit("l"), F.col("id") % 5).alias("lang"))
    manifest = hilbert.write_shards(df, ["n", "lang"], f"file://{tmp_path}/out", shards=16)
    back = spark.read.parquet(f"{tmp_path}/out")
    assert back.count() == 3000
    few = hilbert.prune(manifest, n=(3, 6), lang="l2")
    where = (F.col("n").between(3, 6)) & (F.col("lang") == "l2")
    assert len(few) < 16 and back.filter(where).count() == back.filter(where & F.col("shard").isin(few)).count() == df.filter(where).count()


def test_shard_files_keep_every_column_and_refuse_their_folders_name(spark, tmp_path):
    names = "n int, curve string, slot int, row string, tie int, d0 int, _part string"
    rows = [(i % 7 if i % 5 else None, "c", i, "r", 1, 2, "p") for i in range(200)] + [(3, "c", 5, "r", 1, 2, "p")] * 3
    df = spark.createDataFrame(rows, names)
    manifest = hilbert.write_shards(df, ["n"], f"file://{tmp_path}/out", shards=4)
    back = spark.read.parquet(f"{tmp_path}/out").select(*df.columns)
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect())) and [r.n_rows for r in manifest.orderBy("shard").collect()] == [51, 51, 51, 50]
    assert hilbert.write_shards(df.limit(0), ["n"], f"file://{tmp_path}/none", shards=4).count() == 0
    with pytest.raises(ValueError, match="shard"):
        hilbert.write_shards(df.withColumn("Shard", F.lit(1)), ["n"], f"file://{tmp_path}/no")
