"""Benchmark decontamination by a positional inverted index. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm._work import Workspace

#: What stands between words: ASCII marks and white space.
_GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_CAPITALS, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Tables of at most so many rows (of one word and two numbers) are sent to every task instead of shuffled.
BROADCAST_ROWS = 500_000


def cut(text: Column) -> Column:
    """Words of a text, in order and as they stand; none of null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), _GAP), "")


def exact(word: Column) -> Column:
    """The word with A-Z, and no other letters, lower-cased; words compare by this."""
    return F.when(F.length(word) == F.octet_length(word), F.lower(word)).otherwise(F.translate(word, _CAPITALS, _SMALL))


def folded(word: Column) -> Column:
    """The word as the index holds it: all letters lowered, one word at a time, which costs less than :func:`exact` and finds no fewer places."""
    return F.lower(word)


def _sent(df: DataFrame) -> DataFrame:
    """Broadcast if it is small enough, by count; else left to a shuffled join."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def cut_documents(docs: DataFrame, work: Workspace) -> DataFrame:
    """row, doc_id, text_key, words, n_words, written once: whatever columns are read later, no text is cut again, and rows keep their numbers."""
    made = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), cut(F.col("text")).alias("words"))
    return work.keep(made.withColumn("n_words", F.size("words").cast("long")).withColumn("row", F.monotonically_increasing_id()), "cut")


def item_places(items: DataFrame, work: Workspace) -> DataFrame:
    """item, item_id, length, i, word, term (the word as the index holds it) of every place of every item that has words."""
    listed = items.select("item_id", F.transform(cut(F.col("text")), exact).alias("words")).filter(F.size("words") > 0)
    listed = work.keep(listed.withColumn("item", F.monotonically_increasing_id()), "items")
    places = listed.select("item", "item_id", F.size("words").alias("length"), F.posexplode("words").alias("i", "word"))
    return work.keep(places.withColumn("term", folded(F.col("word"))), "places")


def rarity(texts: DataFrame, places: DataFrame, work: Workspace) -> DataFrame:
    """term, n: how often each term of the items stands in all documents."""
    wanted = places.select("term").distinct()
    found = texts.select(F.explode("words").alias("word")).select(folded(F.col("word")).alias("term"))
    return work.keep(found.join(_sent(wanted), "term", "left_semi").groupBy("term").agg(F.count("*").alias("n")), "counts")


def postings(texts: DataFrame, terms: DataFrame) -> DataFrame:
    """The index: term, row, at of every occurrence of the terms in the documents."""
    found = texts.select("row", F.posexplode("words").alias("at", "word")).select(folded(F.col("word")).alias("term"), "row", "at")
    return found.join(_sent(terms), "term", "left_semi")


def alignments(texts: DataFrame, places: DataFrame, counts: DataFrame, window: int, work: Workspace) -> DataFrame:
    """row, item, shift: places where the two rarest terms of some window of an item stand as far apart as in the item.

    A window with a word that no document has is left out. The lists of both
    terms, each moved back by the term's place in the item, are intersected.
    """
    last = F.greatest(F.lit(0), F.col("length") - window)
    starts = F.sequence(F.greatest(F.lit(0), F.col("i") - window + 1), F.least(F.col("i"), last))
    windowed = places.join(counts, "term", "left").select("item", "length", "i", "term", F.coalesce("n", F.lit(0)).alias("n"), F.explode(starts).alias("start"))
    one = Window.partitionBy("item", "start")
    ranked = windowed.withColumn("rank", F.row_number().over(one.orderBy("n", "i"))).withColumn("least", F.min("n").over(one))
    chosen = work.keep(ranked.filter("rank <= 2 and least > 0").select("term", "item", "i", (F.col("length") == 1).alias("single")).distinct(), "chosen")
    index = work.keep(postings(texts, chosen.select("term").distinct()), "postings")
    moved = index.join(_sent(chosen), "term").select("row", "item", (F.col("at") - F.col("i")).alias("shift"), "i", "single")
    met = moved.groupBy("row", "item", "shift").agg(F.min("i").alias("low"), F.max("i").alias("high"), F.max("single").alias("single"))
    return work.keep(met.filter("low < high or single").select("row", "item", "shift"), "alignments")


def occurrences(texts: DataFrame, places: DataFrame, found: DataFrame, window: int, work: Workspace) -> DataFrame:
    """row, item, item_id, at of every document word inside an occurrence of a window, word by word from the alignments."""
    wanted = found.join(places, "item").select("row", "item", "item_id", "shift", "i", (F.col("shift") + F.col("i")).alias("at"), "word", "length")
    own = texts.select("row", "words").join(_sent(found.select("row").distinct()), "row", "left_semi")
    own = own.select("row", F.posexplode("words").alias("at", "w")).select("row", "at", exact(F.col("w")).alias("word"))
    same = wanted.join(own, ["row", "at", "word"])
    # Neighbours in the item are neighbours in the document; a run of them as long as a window is made of windows.
    one = Window.partitionBy("row", "item", "shift").orderBy("i")
    runs = same.withColumn("run", F.col("i") - F.row_number().over(one))
    long = F.count("*").over(Window.partitionBy("row", "item", "shift", "run")) >= F.least("length", F.lit(window))
    return work.keep(runs.withColumn("long", long).filter("long").select("row", "item", "item_id", "at"), "hits")


def contamination(docs: DataFrame, items: DataFrame, *, window: int = 13, share: int = 20) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, text_key (xxhash64 of the text).

    A window is ``window`` consecutive words of an item, or a shorter item as a
    whole. A document's word is hit inside any occurrence of a window; a
    document is contaminated if ``share`` times its hit words are at least its
    words. The index finds where windows may stand, the document's own words
    confirm it. Null and wordless texts have no words and no hits; items
    without words are ignored, rows that repeat an item_id count once, a null
    item_id hits but is not listed; rows that repeat a doc_id or have none are
    each judged by their own text. Empty tables give no rows, or no hits. Other
    columns are not read.
    """
    work = Workspace(docs.sparkSession, "phrases")
    texts = cut_documents(docs, work)
    places = item_places(items, work)
    found = alignments(texts, places, rarity(texts, places, work), window, work)
    hits = occurrences(texts, places, found, window, work)
    n_hit = hits.select("row", "at").distinct().groupBy("row").agg(F.count("*").alias("n_hit"))
    listed = hits.filter("item_id is not null").select("row", F.col("item_id").cast("string").alias("id")).distinct()
    items_of = listed.groupBy("row").agg(F.count("*").alias("n_items"), F.sha2(F.concat_ws(",", F.sort_array(F.collect_list("id"))), 256).alias("items_sha256"))
    judged = work.keep(n_hit.join(items_of, "row", "left"), "judged")
    counted = texts.select("row", "doc_id", "text_key", "n_words").join(_sent(judged), "row", "left").withColumn("n_hit", F.coalesce("n_hit", F.lit(0).cast("long")))
    return counted.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (F.col("n_hit") * share >= F.col("n_words"))).alias("contaminated"),
        "text_key",
    )


def proximity_matches(docs: DataFrame, items: DataFrame, *, terms: int = 3, span: int = 30) -> DataFrame:
    """doc_id, item_id, first, last: every place where the item's ``terms`` rarest distinct words stand within ``span`` words, in any order.

    Words that no document has are left out of account, and capital letters of
    any alphabet count as small ones. A place begins at any occurrence of one
    of the words and ends at the last of them within the span. Words equally
    rare are taken in the order of the alphabet. Null and wordless texts and
    items have no places; rows that repeat an id give their places once; a null
    id stays null; empty tables give no rows. Other columns are not read.
    """
    work = Workspace(docs.sparkSession, "proximity")
    texts = cut_documents(docs, work)
    places = item_places(items, work)
    rank = F.row_number().over(Window.partitionBy("item").orderBy("n", "term"))
    rare = places.select("item", "item_id", "term").distinct().join(rarity(texts, places, work), "term").withColumn("rank", rank).filter(F.col("rank") <= terms)
    wanted = work.keep(rare.withColumn("wanted", F.count("*").over(Window.partitionBy("item"))).select("item", "item_id", "term", "wanted"), "rare")
    index = postings(texts, wanted.select("term").distinct()).join(_sent(wanted), "term")
    near = Window.partitionBy("row", "item").orderBy("at").rangeBetween(0, span - 1)
    met = index.withColumn("seen", F.size(F.collect_set("term").over(near))).withColumn("last", F.max("at").over(near)).filter("seen = wanted")
    return met.join(texts.select("row", "doc_id"), "row").select("doc_id", "item_id", F.col("at").alias("first"), "last").distinct()


#: The same by brute force over all windows.
SQL = """
with d as (select row_number() over () as r, doc_id, case when text is null then [] else list_transform(regexp_extract_all(text, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+'), lambda w: translate(w, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) end as w from documents),
b as (select item_id, list_transform(regexp_extract_all(text, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+'), lambda w: translate(w, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) as w from benchmark where text is not null),
k as (select distinct item_id, least(13, len(w)) as n, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') as p from b, unnest(range(1, greatest(len(w) - 12, 1) + 1)) t(i) where len(w) > 0),
s as (select distinct n from k),
o as (select r, i, n, array_to_string(w[i:i + n - 1], ' ') as p from d, s, unnest(range(1, len(w) - n + 2)) t(i)),
h as (select o.r, o.i, o.n, k.item_id from o join k using (n, p)),
x as (select r, count(distinct j) as n_hit from h, unnest(range(i, i + n)) t(j) group by r),
y as (select r, count(*) as n_items, string_agg(id, ',' order by id) as ids from (select distinct r, cast(item_id as varchar) as id from h where item_id is not null) group by r)
select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit, cast(coalesce(n_items, 0) as bigint) as n_items, sha256(coalesce(ids, '')) as items_sha256,
       coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from d left join x using (r) left join y using (r)
"""
