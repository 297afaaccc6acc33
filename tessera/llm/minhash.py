"""Near-duplicate texts by DartMinHash signatures and banded joining."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm._words import constants, mix, shingles, texts_of, words
from tessera.llm._work import Workspace, releasing
from tessera.llm.components import connected_components

_U = np.uint64
#: Tables of at most so many rows (of a few numbers) are sent to every task instead of shuffled.
BROADCAST_ROWS = 500_000
#: Chance that a cell of area 1 holds at most 0, 1, 2, ... darts.
_POISSON = np.cumsum(np.exp(-1.0) / np.cumprod([1.0, *range(1, 18)]))


@dataclass(frozen=True)
class Banding:
    """36 bands of 7 coordinates: a pair of similarity 0.8 is missed once in 4,600 times, one of 0.85 once in 300,000."""

    bands: int = 36
    rows: int = 7

    @property
    def coordinates(self) -> int:
        return self.bands * self.rows


def dart_signatures(elements: np.ndarray, weights: np.ndarray, counts: np.ndarray, k: int, spread: float = 3.0) -> np.ndarray:
    """Weighted signatures, one row of k coordinates per set; rows of empty sets are zero.

    Every element owns a plane of weight against rank on which darts lie as a
    Poisson process, the same in all sets. A set sees those of its elements'
    darts that lie below the element's weight and below a rank limit chosen so
    that about k (ln k + spread) are seen; each dart belongs to one coordinate,
    which keeps its dart of smallest rank. A set with an empty coordinate is
    thrown again with twice the limit. Two sets agree in a coordinate with a
    chance that is their weighted Jaccard similarity.

    The plane is cut into cells of area 1: weights 0 to 1, then 1 to 2, 2 to 4
    and so on, each with ranks cut to fit; a cell's darts follow from its hash.
    """
    sets = len(counts)
    out = np.zeros((sets, k), dtype=_U)
    owner = np.repeat(np.arange(sets), counts)
    total = np.bincount(owner, weights, sets)
    todo, darts = np.flatnonzero(total > 0), k * (np.log(k) + spread)
    while len(todo):
        chosen = np.zeros(sets, dtype=bool)
        chosen[todo] = True
        inside = chosen[owner]
        limit = np.divide(darts, total, out=np.zeros(sets), where=total > 0)
        best = np.full(sets * k, np.inf)
        band = 0
        e, w, d = elements[inside], weights[inside], owner[inside]
        while len(e):
            low, width = (0.0, 1.0) if band == 0 else (2.0 ** (band - 1), 2.0 ** (band - 1))
            cells = np.ceil(limit[d] * width).astype(np.int64)
            which = np.repeat(np.arange(len(e)), cells)
            step = np.arange(len(which)) - np.repeat(np.cumsum(cells) - cells, cells)
            cell = mix(e[which] ^ mix(step.astype(_U) + _U(band << 48)))
            many = np.searchsorted(_POISSON, cell.astype(np.float64) / 2.0**64)
            each = np.repeat(np.arange(len(which)), many)
            nth = np.arange(len(each)) - np.repeat(np.cumsum(many) - many, many)
            dart = mix(cell[each] + (nth.astype(_U) + _U(1)) * _U(0x9E3779B97F4A7C15))
            source = which[each]
            rank = (step[each] + (dart & _U(0xFFFFFFFF)).astype(np.float64) / 2.0**32) / width
            seen = rank < limit[d[source]]
            if band or (w < 1).any():
                seen &= low + width * (mix(dart).astype(np.float64) / 2.0**64) < w[source]
            dart, source, rank = dart[seen], source[seen], rank[seen]
            key = d[source] * k + (((dart >> _U(32)) * _U(k)) >> _U(32)).astype(np.int64)
            np.minimum.at(best, key, rank)
            won = rank == best[key]
            out.reshape(-1)[key[won]] = dart[won]
            more = w > low + width
            e, w, d, band = e[more], w[more], d[more], band + 1
        empty = np.isinf(best.reshape(sets, k)[todo]).any(axis=1)
        todo, darts = todo[empty], darts * 2
    return out


def band_hashes(signatures: np.ndarray, banding: Banding) -> np.ndarray:
    """One hash per set and band, different between bands."""
    parts = signatures.reshape(len(signatures), banding.bands, banding.rows)
    return mix((parts * constants(banding.rows, 5)).sum(axis=2, dtype=_U) ^ constants(banding.bands, 6))


def shingle_sets(column: pa.Array, size: int, weighting: str) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, distinct shingles, their weights, number per row) for runs of rows."""
    # A megabyte of text makes about a hundred of darts.
    for first, data, offsets in texts_of(column, 1_000_000):
        values, runs = shingles(*words(data, offsets), size)
        sets, weights = [], []
        for part in np.split(values, np.cumsum(runs)[:-1]):
            distinct, times = np.unique(part, return_counts=True)
            sets.append(distinct)
            weights.append(times.astype(float) if weighting == "count" else np.ones(len(distinct)))
        yield first, np.concatenate(sets), np.concatenate(weights), np.array([len(x) for x in sets])


def _members(elements: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The set itself; of a weighted set, one member for each unit of an element's weight, whose plain Jaccard is the weighted one."""
    whole = weights.astype(np.int64)
    nth = np.arange(whole.sum()) - np.repeat(np.cumsum(whole) - whole, whole)
    return np.where(nth == 0, np.repeat(elements, whole), mix(np.repeat(elements, whole) + nth.astype(_U)))


def set_keys(elements: np.ndarray, weights: np.ndarray, counts: np.ndarray, salt: int) -> np.ndarray:
    """A hash of each whole set."""
    key = np.zeros(len(counts), dtype=_U)
    np.add.at(key, np.repeat(np.arange(len(counts)), counts), mix(elements ^ constants(1, salt)[0]) * weights.astype(_U))
    return key.view(np.int64)


def sign(docs: DataFrame, *, shingle_words: int, weighting: str, banding: Banding) -> DataFrame:
    """doc_id, text_key (xxhash64 of the text), key1 and key2 (equal for equal sets; null without words), size, bands."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for first, elements, weights, counts in shingle_sets(batch.column(2), shingle_words, weighting):
                bands = band_hashes(dart_signatures(elements, weights, counts, banding.coordinates), banding)
                keys = [pa.array(set_keys(elements, weights, counts, salt), mask=counts == 0) for salt in (7, 8)]
                sizes = np.bincount(np.repeat(np.arange(len(counts)), counts), weights, len(counts)).astype(np.int64)
                flat = pa.array(np.ascontiguousarray(bands).reshape(-1).view(np.int64))
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(counts) + 1, dtype=np.int32) * banding.bands), flat)
                ids = [batch.column(i).slice(first, len(counts)) for i in (0, 1)]
                yield pa.RecordBatch.from_arrays([*ids, *keys, pa.array(sizes), lists], names=["doc_id", "text_key", "key1", "key2", "size", "bands"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text")
    return texts.mapInArrow(releasing(run), "doc_id long, text_key long, key1 long, key2 long, size long, bands array<long>")


def member_sets(texts: DataFrame, *, shingle_words: int, weighting: str) -> DataFrame:
    """node, members of the texts (node, text): the sets themselves, for exact similarities."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for first, elements, weights, counts in shingle_sets(batch.column(1), shingle_words, weighting):
                ends = np.cumsum(counts)
                sets = [_members(elements[b - n : b], weights[b - n : b]).view(np.int64) for b, n in zip(ends, counts, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(counts)), pa.array(sets, pa.list_(pa.int64()))], names=["node", "members"])

    # Rows that repeat an id and a text make a set more than once.
    return texts.select("node", "text").mapInArrow(releasing(run), "node long, members array<long>").groupBy("node").agg(F.first("members").alias("members"))


def near_classes(links: DataFrame) -> DataFrame:
    """node, class: the smallest node within three links. Coarse enough to spare pairs of a crowd around one centre, and
    far cheaper than components; nodes of one component with different classes only make pairs that were not needed."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    label = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("class"))
    for _ in range(2):
        reached = both.join(label.select(F.col("a").alias("b"), F.col("class").alias("c")), "b")
        label = reached.groupBy("a").agg(F.least(F.col("a"), F.min("c")).alias("class"))
    return label.select(F.col("a").alias("node"), "class")


def edits(rows: DataFrame, threshold: float) -> DataFrame:
    """``rows`` (size, alone, other, shared: of a set, of its elements that nobody else holds, of its bucket's head, of both) with gone, new, need, over.

    Against its head, a set lacks ``gone`` elements and has others, of which
    ``new`` may be in further sets. Two sets x and y of one head have
    the threshold only if the edits that they share, at most min(gone) + min(new),
    are need(x) + need(y) or more. That sum is also over(x) + least(y), where
    ``over`` is what x lacks of a link with the head, above 0 without that link,
    and ``least`` a weighted mean of y's edits, never below 0.
    """
    k = threshold / (1 + threshold)
    gone, fresh = F.col("other") - F.col("shared"), F.col("size") - F.col("shared")
    made = {"gone": gone, "new": fresh - F.col("alone"), "need": k * F.col("size") + F.col("other") / 2 - F.col("shared"), "over": k * (F.col("size") + F.col("other")) - F.col("shared")}
    return rows.withColumns(made | {"least": k * fresh + (1 - k) * gone})


def sharing(rows: DataFrame) -> DataFrame:
    """Those of :func:`edits` that may still pair with one of their bucket: a pair whose sets are both linked with the head
    needs no comparison, so one of the two is not, and the other has edits enough for the smallest ``over`` of those."""
    short = rows.filter(~F.col("linked")).groupBy("bucket").agg(F.min("over").alias("short"))
    able = F.col("gone") + F.col("new") >= F.col("short") + F.col("least") - 1e-9
    rows = rows.join(short, "bucket").withColumn("able", able).filter(F.col("able") | ~F.col("linked"))
    paired = rows.groupBy("bucket").agg(F.max("able").alias("any")).filter("any").select("bucket")
    return rows.join(paired, "bucket", "left_semi").drop("head", "other", "shared", "alone", "linked", "over", "least", "short", "able")


def _sent(df: DataFrame) -> DataFrame:
    """Broadcast if it is small enough, by count; else left to a shuffled join."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def near_duplicates(docs: DataFrame, *, threshold: float = 0.8, shingle_words: int = 5, weighting: str = "count", banding: Banding = Banding()) -> DataFrame:
    """One row per document: doc_id, component_id (smallest id it is linked to over any path), kept (that is its own), text_key (xxhash64 of the text).

    Two texts are linked if they share a band of their signatures and their
    shingles have a Jaccard similarity of ``threshold`` or more, which is
    computed exactly. ``weighting="count"`` weighs a shingle by how often it
    stands in the text; "set" weighs all alike.

    Equal sets are merged before any pairing. A bucket of two is a pair; in a
    larger one every member is first held against its likeliest centre, then
    against the head of each of its buckets, and what that links becomes one
    class. Then only members of different classes are paired, and of these only
    those whose edits against the head still allow the threshold (see
    :func:`edits`): two near misses of a crowd must share edits, so one that
    no other member shares edits with leaves here uncompared. While buckets still make
    more than 64 pairs for each member, members are held against 2, 4, 8 and so on
    further centres of their buckets, which merges classes; at last all that are
    left are compared. So no link between classes is lost.

    Null, empty and wordless texts link with nothing. Rows that repeat a doc_id
    with the same text are one document with one fate, those with another text
    take that text's component. Rows without an id take part; their component
    is the smallest id in it, and they are kept if it has none. An empty table
    gives no rows. Other columns are not read.
    """
    work = Workspace(docs.sparkSession, "minhash")
    signed = work.keep(sign(docs, shingle_words=shingle_words, weighting=weighting, banding=banding), "signed")
    last = F.lit(2**63 - 1)
    row = F.struct(F.coalesce("doc_id", last).alias("doc"), "text_key")
    reps = signed.filter("key1 is not null").groupBy("key1", "key2", "size").agg(F.min(row).alias("rep"), F.first("bands").alias("bands"))
    reps = work.keep(reps.select("key1", "key2", "size", "rep.*", "bands").withColumn("node", F.monotonically_increasing_id()), "reps")
    posted = reps.select("node", "size", F.explode("bands").alias("bucket"))
    ends = [F.count("*").alias("n"), F.min("node").alias("a"), F.max("node").alias("b"), F.min("size").alias("low"), F.max("size").alias("high")]
    buckets = work.keep(posted.groupBy("bucket").agg(*ends).filter("n > 1"), "buckets")
    twos = buckets.filter((F.col("n") == 2) & (F.col("low") >= threshold * F.col("high"))).select("a", "b").distinct()
    members = work.keep(posted.join(_sent(buckets.filter("n > 2").select("bucket", "n")), "bucket"), "members")
    # A text that shares many buckets is a likely centre of its crowd.
    weight = members.groupBy("node").agg(F.sum("n").alias("weight"))
    members = work.keep(members.join(weight, "node"), "weighted")

    def alike(size: str, other: str) -> Column:
        return F.least(size, other) >= threshold * F.greatest(size, other)

    head = members.groupBy("bucket").agg(F.max(F.struct("weight", (-F.col("node")).alias("minus"), "size")).alias("h"))
    best = members.join(head, "bucket").filter((F.col("h.minus") != -F.col("node")) & alike("size", "h.size")).groupBy("node").agg((-F.max("h")["minus"]).alias("centre"))
    first = best.select(F.least("node", "centre").alias("a"), F.greatest("node", "centre").alias("b"))
    tried = work.keep(first.unionByName(twos).distinct(), "tried")

    ids = tried.select(F.col("a").alias("node")).unionByName(tried.select(F.col("b").alias("node"))).unionByName(members.select("node")).distinct()
    wanted = work.keep(reps.select("node", "doc", "text_key").join(ids, "node"), "wanted").withColumnRenamed("text_key", "key")
    texts = docs.select(F.coalesce(F.col("doc_id").cast("long"), last).alias("doc"), F.xxhash64("text").alias("key"), "text").join(_sent(wanted), ["doc", "key"])
    sets = work.keep(member_sets(texts, shingle_words=shingle_words, weighting=weighting), "sets")

    def verified(pairs: DataFrame) -> DataFrame:
        left = sets.select(F.col("node").alias("a"), F.col("members").alias("x"))
        right = sets.select(F.col("node").alias("b"), F.col("members").alias("y"))
        shared = F.size(F.array_intersect("x", "y"))
        return pairs.join(left, "a").join(right, "b").withColumn("shared", shared).filter(F.col("shared") >= threshold * (F.size("x") + F.size("y") - F.col("shared"))).select("a", "b")

    def across(left: DataFrame, right: DataFrame) -> DataFrame:
        """Pairs of one bucket and two classes that may still reach the threshold; each pair once."""
        other = right.select("bucket", *(F.col(c).alias(f"{c}_") for c in ("node", "size", "class", "need", "gone", "new")))
        able = alike("size", "size_") & (F.least("gone", "gone_") + F.least("new", "new_") >= F.col("need") + F.col("need_") - 1e-9)
        pairs = left.join(other, "bucket").filter(able & (F.col("class") != F.col("class_")))
        return pairs.select(F.least("node", "node_").alias("a"), F.greatest("node", "node_").alias("b")).distinct()

    def open_buckets(rows: DataFrame, met: int) -> DataFrame:
        """bucket, n, main (its largest class), left (pairs it still makes) of buckets of several classes with members that no centre has met."""
        sizes = rows.groupBy("bucket", "class").agg(F.count("*").alias("n"))
        each = sizes.groupBy("bucket").agg(F.sum("n").alias("n"), F.max(F.struct("n", "class")).alias("most"))
        return each.filter((F.col("n") > F.col("most.n")) & (F.col("n") > met + 1)).select("bucket", "n", F.col("most.class").alias("main"), ((F.col("n") - F.col("most.n")) * F.col("n")).alias("left"))

    def reclassed(rows: DataFrame) -> DataFrame:
        known = work.keep(near_classes(links), f"classes-{next(named)}")
        return rows.drop("class").join(known, "node", "left").withColumn("class", F.coalesce("class", "node"))

    turn, met, named = 0, 0, count()
    links = work.keep(verified(tried), "links-0")
    classed = work.keep(reclassed(members.select("bucket", "node", "size", "weight").withColumn("class", F.col("node"))), "classed-0")
    classed = classed.join(open_buckets(classed, 0).select("bucket"), "bucket", "left_semi")
    # Elements that no other open member holds can't be shared with any of them.
    alone = sets.join(classed.select("node").distinct(), "node", "left_semi").select("node", F.explode("members").alias("m"))
    alone = alone.groupBy("m").agg(F.count("*").alias("n"), F.min("node").alias("node")).filter("n = 1").groupBy("node").agg(F.count("*").alias("alone"))
    classed = classed.join(alone, "node", "left").withColumn("alone", F.coalesce("alone", F.lit(0))).filter(F.col("size") - F.col("alone") >= threshold * F.col("size") - 1e-9)
    classed = work.keep(classed, "reaching")
    head = classed.groupBy("bucket").agg(F.max(F.struct("weight", (-F.col("node")).alias("minus"))).alias("h")).select("bucket", (-F.col("h.minus")).alias("head"))
    classed = classed.join(head, "bucket")
    left, right = sets.select("node", F.col("members").alias("x")), sets.select(F.col("node").alias("head"), F.col("members").alias("y"))
    near = classed.select("node", "head").distinct().join(left, "node").join(right, "head")
    near = work.keep(near.select("node", "head", F.size("y").alias("other"), F.size(F.array_intersect("x", "y")).alias("shared")), "near")
    linked = F.col("shared") >= threshold * (F.col("size") + F.col("other") - F.col("shared"))
    classed = work.keep(edits(classed.join(near, ["node", "head"]).withColumn("linked", linked), threshold), "edits")
    met_heads = classed.filter(F.col("linked") & (F.col("node") != F.col("head"))).select(F.least("node", "head").alias("a"), F.greatest("node", "head").alias("b")).distinct()
    links = links.unionByName(work.keep(met_heads, "links-heads"))
    classed = work.keep(reclassed(sharing(classed)), "open-0")
    most, used = 64 * members.count(), None
    while True:
        opened = work.keep(open_buckets(classed, met), f"open-buckets-{turn}")
        left = opened.agg(F.coalesce(F.sum("left"), F.lit(0))).first()[0]
        classed = classed.join(opened.select("bucket", "main"), "bucket")
        if left <= most:
            break
        turn, met = turn + 1, met + (2 << turn)
        free = classed if used is None else classed.join(used, ["bucket", "node"], "left_anti")
        rank = F.row_number().over(Window.partitionBy("bucket").orderBy(F.desc("weight"), "node"))
        heads = work.keep(free.withColumn("rank", rank).filter(F.col("rank") <= (1 << turn)).drop("rank"), f"heads-{turn}")
        used = heads.select("bucket", "node") if used is None else used.unionByName(heads.select("bucket", "node"))
        pairs = work.keep(across(classed, heads).join(tried, ["a", "b"], "left_anti"), f"tried-{turn}")
        tried = tried.unionByName(pairs)
        links = links.unionByName(work.keep(verified(pairs), f"links-{turn}"))
        classed = work.keep(reclassed(classed.drop("main")), f"classed-{turn}")
    if left:
        rest = work.keep(across(classed.filter("class != main"), classed).join(tried, ["a", "b"], "left_anti"), "rest")
        links = links.unionByName(work.keep(verified(rest), "links-rest"))
    # Links inside a class need no more work; components are sought among classes that a link joins, mostly few or none.
    known = work.keep(near_classes(links), "classes-last")
    between = links.join(known.select(F.col("node").alias("a"), F.col("class").alias("x")), "a").join(known.select(F.col("node").alias("b"), F.col("class").alias("y")), "b")
    between = work.keep(between.filter("x != y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct(), "between")
    final = known.withColumnRenamed("class", "component")
    if not between.isEmpty():
        joined = work.keep(connected_components(between, work, "last"), "joined").select(F.col("node").alias("class"), "component")
        final = known.join(joined, "class", "left").select("node", F.coalesce("component", "class").alias("component"))
    work.drop("buckets", "members", "weighted", "sets")
    placed = reps.select("key1", "key2", "size", "doc", "node").join(final, "node", "left").withColumn("component", F.coalesce("component", "node"))
    smallest = placed.groupBy("component").agg(F.min("doc").alias("smallest"))
    label = placed.join(smallest, "component").select("key1", "key2", "size", F.when(F.col("smallest") != last, F.col("smallest")).alias("component_id"))
    joined = signed.select("doc_id", "text_key", "key1", "key2", "size").join(label, ["key1", "key2", "size"], "left")
    component = F.when(F.col("key1").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return joined.select("doc_id", component.alias("component_id"), component.eqNullSafe(F.col("doc_id")).alias("kept"), "text_key")
