"""Embedding near-dedup: exact threshold pairs by dual traversal of cover trees."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm._work import Workspace
from tessera.llm.components import connected_components

#: Added to every bound, so that rounding never prunes a pair at the threshold.
_SLACK = 1e-9


@dataclass
class Node:
    """Rows of a tree below one centre; ``radius`` covers them all."""

    rows: np.ndarray
    centre: int
    radius: float
    children: list[Node]


def _distance(points: np.ndarray, centre: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * (points @ centre), 0))


def cover_tree(points: np.ndarray, leaf: int = 64) -> Node:
    """Nested levels with halving radii over unit vectors.

    A node's children are centres more than half its scale apart, its own
    centre first, that cover its rows at that scale. Rows that half the scale
    does not gather, as in many dimensions, stay a leaf of any size.
    """

    def grow(rows: np.ndarray, centre: int, scale: float) -> Node:
        away = _distance(points[rows], points[centre])
        radius = float(away.max(initial=0.0))
        node = Node(rows, centre, radius, [])
        while scale > radius:
            scale /= 2
        if len(rows) <= leaf or radius < 1e-6:
            return node
        nearest, owner, centres = away.copy(), np.zeros(len(rows), dtype=np.int64), [centre]
        while nearest.max() > scale:
            if len(centres) > max(8, len(rows) // 16):
                return node
            new = int(nearest.argmax())
            centres.append(int(rows[new]))
            to_new = _distance(points[rows], points[rows[new]])
            closer = to_new < nearest
            nearest[closer], owner[closer] = to_new[closer], len(centres) - 1
        node.children = [grow(rows[owner == i], c, scale) for i, c in enumerate(centres) if (owner == i).any()]
        return node

    return grow(np.arange(len(points)), 0, 2.0)


def dual_pairs(left: np.ndarray, right: np.ndarray | None, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows of left, rows of right) of all pairs with a dot product of ``threshold`` or more, in pieces.

    Without ``right``, all pairs of different rows of ``left``, each once in
    either direction. A pair of nodes whose centres are further apart than
    their covering radii and the threshold's distance allow is pruned.
    """
    reach = np.sqrt(max(0.0, 2 - 2 * threshold)) + _SLACK
    other = left if right is None else right
    a = cover_tree(left)
    b = a if right is None else cover_tree(right)
    todo = [(a, b)]
    while todo:
        x, y = todo.pop()
        if _distance(left[x.centre][None], other[y.centre])[0] > x.radius + y.radius + reach:
            continue
        if x.children and (x.radius >= y.radius or not y.children):
            todo += [(c, y) for c in x.children]
        elif y.children:
            todo += [(x, c) for c in y.children]
        else:
            i, j = np.nonzero(left[x.rows] @ other[y.rows].T >= threshold)
            i, j = x.rows[i], y.rows[j]
            if right is None:
                i, j = i[i != j], j[i != j]
            if len(i):
                yield i, j


def _least_reachable(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest node reachable from each of n nodes over links i-j."""
    label = np.arange(n)
    while True:
        new = label.copy()
        np.minimum.at(new, i, label[j])
        np.minimum.at(new, j, label[i])
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _unit(vector: np.ndarray) -> np.ndarray | None:
    vector = vector.astype(np.float64)
    if not len(vector) or not np.isfinite(vector).all():
        return None
    scale = np.abs(vector).max()
    return None if scale == 0 else (vector / scale) / np.linalg.norm(vector / scale)


def unit_vectors(rows: DataFrame) -> DataFrame:
    """vec_id, label, dim, unit (doubles as bytes); unit is null where a vector can't link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors, labels = batch.column(1), batch.column(2).to_pylist()
            out = []
            for v, label in zip(vectors, labels, strict=True):
                unit = None
                if v.is_valid and label is not None and v.values.null_count == 0:
                    unit = _unit(v.values.to_numpy(zero_copy_only=False))
                out.append(None if unit is None else unit.tobytes())
            dims = [len(x) // 8 if x else None for x in out]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(dims, pa.int32()), pa.array(out, pa.binary())], names=["vec_id", "label", "dim", "unit"])

    picked = rows.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", F.col("label").cast("string").alias("label"))
    return picked.mapInArrow(run, "vec_id long, label string, dim int, unit binary")


def _top_centres(sample: pd.DataFrame, most: int) -> dict[tuple[str, int], np.ndarray]:
    """For each group, the centres of the finest level of a cover tree over its sample that has at most so many."""
    out = {}
    for key, rows in sample.groupby(["label", "dim"]):
        points = np.frombuffer(b"".join(rows["unit"]), dtype=np.float64).reshape(len(rows), -1)
        centres, scale = [0], 2.0
        while scale > 1e-3:
            scale /= 2
            net, nearest = list(centres), np.min([_distance(points, points[c]) for c in centres], axis=0)
            while nearest.max() > scale and len(net) <= most:
                net.append(int(nearest.argmax()))
                nearest = np.minimum(nearest, _distance(points, points[net[-1]]))
            if len(net) > most:
                break
            centres = net
        out[(str(key[0]), int(key[1]))] = points[centres]
    return out


def near_embeddings(rows: DataFrame, *, threshold: float = 0.98, sample: int = 2000, most_centres: int = 64, block: int = 2048) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    Vectors with equal labels and lengths link at a cosine, in doubles, of
    ``threshold`` or more. The top levels of the cover tree are fitted on a
    bounded sample and decide only how the work is dealt: every vector goes
    below its nearest centre, covering radii are taken over all rows, and a
    node of any size is dealt into blocks of about ``block`` rows. Pairs of
    blocks that no pair can link are pruned; each pair left is one task row
    that grows two trees and traverses them together. Equal vectors are merged
    first, and a task returns counts and a spanning set of links, so a crowd of
    copies never becomes all its pairs.

    Vectors that are null, empty, zero or hold null or non-finite numbers, and
    those whose label or vec_id is null, link with nothing: n_links 0, their
    own component (null for a null vec_id), kept. Rows that repeat vec_id,
    label and vector count as one vector in n_links. Other columns are not read.
    """
    work = Workspace(rows.sparkSession, "embeddings")
    prepared = work.keep(unit_vectors(rows).withColumn("key", F.md5("unit")), "units")
    usable = prepared.filter("unit is not null and vec_id is not null")
    group = ["label", "dim", "key"]
    distinct = usable.groupBy(*group).agg(F.min("vec_id").alias("rep"), F.count_distinct("vec_id").alias("n"), F.first("unit").alias("unit"))
    distinct = work.keep(distinct, "distinct")
    picked = distinct.select("label", "dim", "unit").orderBy(F.xxhash64("key", "label")).limit(sample).toPandas()
    centres = _top_centres(picked, most_centres)

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            leaf, away = np.zeros(len(batch), dtype=np.int32), np.full(len(batch), 2.0)
            for key, at in batch.groupby(["label", "dim"]).indices.items():
                if (top := centres.get((str(key[0]), int(key[1])))) is not None:
                    points = np.frombuffer(b"".join(batch["unit"].iloc[at]), dtype=np.float64).reshape(len(at), -1)
                    dots = points @ top.T
                    leaf[at] = dots.argmax(axis=1)
                    away[at] = np.sqrt(np.maximum(2 - 2 * dots.max(axis=1), 0))
            yield batch.assign(leaf=leaf, away=away)

    placed = work.keep(distinct.mapInPandas(place, distinct._jdf.schema().toDDL() + ", leaf int, away double"), "placed")
    leaves = placed.groupBy("label", "dim", "leaf").agg(F.count("*").alias("size"), F.max("away").alias("radius"))
    leaves = leaves.withColumn("blocks", F.ceil(F.col("size") / block).cast("int"))
    leaves = work.keep(leaves, "leaves")
    reach = float(np.sqrt(2 - 2 * threshold)) + _SLACK

    def near(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keep = []
            for r in batch.itertuples():
                top = centres.get((str(r.label), int(r.dim)))
                apart = 0.0 if top is None else float(_distance(top[r.leaf][None], top[r.leaf_b])[0])
                keep.append(apart <= r.radius + r.radius_b + reach)
            yield batch[np.array(keep, dtype=bool)] if len(batch) else batch

    pairs = leaves.join(leaves.select("label", "dim", *(F.col(c).alias(f"{c}_b") for c in ("leaf", "size", "radius", "blocks"))), ["label", "dim"]).filter("leaf <= leaf_b")
    pairs = pairs.mapInPandas(near, pairs._jdf.schema().toDDL())
    pairs = pairs.select("label", "dim", "leaf", "leaf_b", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "blocks_b").select(
        "label", "dim", "leaf", "leaf_b", "block", F.explode(F.sequence(F.when(F.col("leaf") == F.col("leaf_b"), F.col("block")).otherwise(0), F.col("blocks_b") - 1)).alias("block_b")
    )
    pairs = work.keep(pairs, "pairs")

    def bind(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        units = b"".join(table.column("unit").to_pylist())
        return pa.table({"label": [key[0].as_py()], "dim": pa.array([key[1].as_py()], pa.int32()), "leaf": pa.array([key[2].as_py()], pa.int32()), "block": pa.array([key[3].as_py()], pa.int32()), "reps": [table.column("rep").to_numpy().tobytes()], "counts": [table.column("n").to_numpy().tobytes()], "units": [units]})

    dealt = placed.join(leaves.select("label", "dim", "leaf", "blocks"), ["label", "dim", "leaf"])
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
    bound = dealt.select("label", "dim", "leaf", "block", "rep", "n", "unit").groupBy("label", "dim", "leaf", "block")
    blocks = work.keep(bound.applyInArrow(bind, "label string, dim int, leaf int, block int, reps binary, counts binary, units binary"), "blocks")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                reps, counts = (np.frombuffer(r[c], dtype=np.int64) for c in ("reps", "counts"))
                left = np.frombuffer(r["units"], dtype=np.float64).reshape(len(reps), -1)
                same = (r["leaf"], r["block"]) == (r["leaf_b"], r["block_b"])
                n, right = len(reps), None
                if not same:
                    reps_b, counts_b = (np.frombuffer(r[c], dtype=np.int64) for c in ("reps_b", "counts_b"))
                    right = np.frombuffer(r["units_b"], dtype=np.float64).reshape(len(reps_b), -1)
                    reps, counts = np.concatenate([reps, reps_b]), np.concatenate([counts, counts_b])
                links = np.zeros(len(reps), dtype=np.int64)
                found = []
                for i, j in dual_pairs(left, right, threshold):
                    j = j if same else j + n
                    np.add.at(links, i, counts[j])
                    if not same:
                        np.add.at(links, j, counts[i])
                    found.append((i, j))
                if found:
                    order = np.argsort(reps, kind="stable")
                    place = np.argsort(order, kind="stable")
                    least = _least_reachable(len(reps), *(place[np.concatenate(x)] for x in zip(*found, strict=True)))
                    hit = np.flatnonzero(links)
                    yield pa.RecordBatch.from_arrays([pa.array(reps[hit]), pa.array(links[hit]), pa.array(reps[order[least[place[hit]]]])], names=["rep", "links", "head"])

    both = pairs.join(blocks, ["label", "dim", "leaf", "block"]).join(
        blocks.select("label", "dim", *(F.col(c).alias(f"{c}_b") for c in ("leaf", "block", "reps", "counts", "units"))), ["label", "dim", "leaf_b", "block_b"]
    )
    found = work.keep(both.select("leaf", "block", "leaf_b", "block_b", "reps", "counts", "units", "reps_b", "counts_b", "units_b").mapInArrow(compare, "rep long, links long, head long"), "found")
    components = work.keep(connected_components(found.select(F.col("rep").alias("a"), F.col("head").alias("b")).distinct(), work), "components")
    degree = found.groupBy("rep").agg(F.sum("links").alias("links"))
    work.drop("placed", "blocks")
    label = distinct.select(*group, "rep", "n").join(degree, "rep", "left").join(components, F.col("rep") == F.col("node"), "left")
    label = label.select(*group, (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component"))
    all_rows = prepared.select("vec_id", "label", "dim", F.when(F.col("vec_id").isNotNull(), F.col("key")).alias("key"))
    joined = all_rows.join(label, group, "left")
    component = F.coalesce("component", "vec_id")
    return joined.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept"))
