"""Near-duplicate lines by an exact set-similarity join. DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm._work import Workspace, fresh

#: Tables of at most so many rows (of a few numbers) are sent to every task instead of shuffled.
BROADCAST_ROWS = 500_000
#: Tokens are counted in so many hashed cells; a cell's count tells how rare its tokens are, whatever the input's size.
CELLS = 1 << 16
#: Bits of a token in the first pass that are not its first word's, and a number that is no token.
_LOW, _NONE = (1 << 40) - 1, (1 << 63) - 1
#: Nearly all columns kept here are hashes, which no dictionary and no compression makes smaller.
_WRITER = {"parquet.enable.dictionary": "false", "compression": "uncompressed"}
#: White space of one byte and of more, but for the line feed, which ends a line, and the space itself.
_WHITE = "\t\x0b\x0c\r\x1c\x1d\x1e\x1f"
_WIDE_WHITE = "\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(map(chr, range(0x2000, 0x200B)))


def _sent(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _white(text: Column) -> Column:
    """All white space but line feeds as spaces. Few texts hold any other, and bytes are found far faster than patterns."""
    holds = lambda where, parts: F.exists(F.array(*map(F.lit, parts)), lambda x: F.contains(where, x))
    leads = sorted({x.encode()[:1] for x in _WIDE_WHITE})
    wide = (F.octet_length(text) != F.length(text)) & holds(text.cast("binary"), leads) & holds(text, _WIDE_WHITE)
    return F.when(holds(text, _WHITE) | wide, F.regexp_replace(text, f"[{_WHITE}{_WIDE_WHITE}]", " ")).otherwise(text)


def _placed(docs: DataFrame) -> DataFrame:
    """doc (the id, rows without one last), tk (hash of the text), text."""
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(2**63 - 1)).alias("doc"), F.xxhash64("text").alias("tk"), "text")


def _cut(text: Column) -> Column:
    """line_no, line of every line; of a null text a row without line. The plain form of the generator would have Spark cut every text twice, once to see that it has lines."""
    return F.posexplode_outer(F.split(_white(text), "\n")).alias("line_no", "line")


def _picked(text: Column, ids: Column) -> Column:
    """The structs in ``ids`` with the ``line`` of each one's line_no, one a row. White space is looked for in these lines only; a line feed is none, so they are numbered as in :func:`_cut`."""
    named = lambda parts, x: F.struct(x.alias("of"), F.get(parts, x["line_no"]).alias("line"))
    # The array around the parts makes them the lambda's variable, or the text would be cut for every line; outer for the reason given above.
    picked = F.transform(F.array(F.split(text, "\n")), lambda parts: F.transform(ids, lambda x: named(parts, x)))
    return F.explode_outer(F.get(picked, F.lit(0))).alias("picked")


def _words(line: str = "line") -> Column:
    return F.array_remove(F.split(F.lower(line), " "), "")


def _hashed(lines: DataFrame) -> DataFrame:
    """``line`` replaced by ``h``: a hash of each word, lower-cased. A column of its own, for inside a lambda lines would be cut again for every run."""
    return lines.withColumn("h", F.transform(_words(), lambda x: F.xxhash64(x))).drop("line")


def _runs(size: int, made: Callable[[Column, Column], Column]) -> Column:
    """``made`` of the first word and the whole run's hash for each run of ``size`` words in ``h``, which has as many or more."""
    runs = lambda h: F.transform(F.slice(h, F.lit(1), F.size(h) - size + 1), lambda x, i: made(x, F.xxhash64(x, *(F.get(h, i + k) for k in range(1, size)))))
    # The array around the hashes makes them the lambda's variable; as a column they would be taken from the row for every word of a run.
    return F.get(F.transform(F.array("h"), runs), F.lit(0))


def _short(n: Column) -> Column:
    """The token of a line of fewer words than a run. Their number goes into it, so that no run of a longer line has the same hash."""
    return F.when(n > 0, F.array(F.xxhash64(n, F.col("h"))))


def with_tokens(lines: DataFrame, size: int) -> DataFrame:
    """``line`` replaced by ``t``: distinct hashes of its runs of ``size`` words, lower-cased, in no order; one of all words of a shorter line; null without words."""
    cut, n = _hashed(lines), F.size("h")
    whole = F.array_distinct(_runs(size, lambda first, run: run))
    return cut.withColumn("t", F.when(n >= size, whole).otherwise(_short(n))).drop("h")


def with_prefix(lines: DataFrame, size: int, threshold: float) -> DataFrame:
    """``line`` replaced by n, its number of words; k1 and k2, hashes of all its words; and ``prefix``, as many tokens as a partner must share one of, or more.

    Here a run's upper 24 bits are its first word's and the others its own hash, and tokens go by these numbers. So as many
    different first words as the prefix is long, taken in their order, hold all of it, and no other run needs to be hashed.
    """
    n = F.size("h")
    length = _prefix(n - size + 1, threshold)
    cut = _hashed(lines).withColumn("first", F.when(n >= size, F.sort_array(F.slice("h", F.lit(1), n - size + 1))))
    # Twice as many nearly always hold as many different ones; only otherwise are equal ones looked for among all.
    cut = cut.withColumn("few", F.array_distinct(F.slice("first", F.lit(1), 2 * length)))
    last = F.when(F.size("few") >= length, F.get("few", length - 1)).otherwise(F.element_at(F.slice(F.array_distinct("first"), F.lit(1), length), -1))
    cut = cut.withColumn("last", last.bitwiseOR(F.lit(_LOW)))
    # Runs beyond the last first word are the greatest number, which no token is.
    token = lambda first, run: F.least(first.bitwiseAND(F.lit(~_LOW)).bitwiseOR(run.bitwiseAND(F.lit(_LOW))), F.lit(_NONE - 1))
    # Last is a lambda's variable too, or it would be looked up in its array for every run.
    found = F.transform(F.array("last"), lambda last: _runs(size, lambda first, run: F.when(first <= last, token(first, run)).otherwise(F.lit(_NONE))))
    # Few runs are left once the others are removed, so that comes before looking for equal ones.
    runs = F.array_distinct(F.array_remove(F.get(found, F.lit(0)), _NONE))
    prefix = F.when(n >= size, F.slice(F.sort_array(runs), F.lit(1), length)).otherwise(_short(n))
    kept = [F.col(f"`{c}`") for c in lines.columns if c != "line"]
    return cut.select(*kept, n.alias("n"), F.xxhash64("h").alias("k1"), F.xxhash64(F.lit(1), F.reverse("h")).alias("k2"), prefix.alias("prefix"))


def rarity(tokens: DataFrame) -> Column:
    """An array over all cells: eight times the binary logarithm of how many of the tokens fall into a cell, as a byte."""
    counted = tokens.groupBy(F.col("token").bitwiseAND(F.lit(CELLS - 1)).alias("cell")).agg(F.count("*").alias("n")).toArrow()
    ranks = np.zeros(CELLS, dtype=np.int64)
    ranks[counted.column("cell").to_numpy()] = np.minimum(8 * np.log2(counted.column("n").to_numpy()), 127)
    return F.split(F.lit(",".join(map(str, ranks.tolist()))), ",").cast("array<tinyint>")


def ordered(tokens: Column, ranks: Column) -> Column:
    """The tokens in one order for all lines, rare ones first; ties by hash. An element's upper byte is its rank, the others are the token's."""
    return F.sort_array(F.transform(tokens, lambda x: F.shiftleft(F.get(ranks, x.bitwiseAND(F.lit(CELLS - 1)).cast("int")).cast("long"), 56).bitwiseOR(F.shiftrightunsigned(x, 8))))


def _prefix(n: Column, threshold: float) -> Column:
    """Tokens of a set of n of which a partner must share one: all but the ceil(threshold n) last, plus one."""
    return n - F.ceil(n * threshold - 1e-9).cast("int") + 1


def duplicate_lines(docs: DataFrame, *, threshold: float = 0.8, shingle_words: int = 5) -> DataFrame:
    """doc_id, text_key (xxhash64 of the text), line_no (from 0) of every line with an earlier line at ``threshold`` Jaccard or more.

    Earlier means by (doc_id, line_no). A line's tokens are its distinct runs of
    ``shingle_words`` words, cut at any white space; a shorter line has one
    token of all its words; a line without words has none and stays. Lines of
    equal words are taken as one. Lines whose prefixes under one fixed order share no token
    cannot match and leave; a token that two lines share makes their pair where
    it is counted. Lines with a token of more holders are ordered from rare
    tokens to common ones among all of them, and meet only in the prefixes of
    that order: each is first tried against the earliest holder of its tokens,
    and only those that this does not decide against all earlier holders, so a
    crowd of copies makes some pairs per line, not all. Length and position
    filters come before any pair is compared.

    Null text has no lines. Rows without a doc_id come after all others. Rows
    that repeat a doc_id with the same text are one document; rows that repeat
    it with another text are others, ordered by the text's hash. An empty table
    gives no rows. Other columns are not read.
    """
    work = Workspace(docs.sparkSession, "lines", _WRITER)
    placed = _placed(docs)
    place = F.struct("doc", "tk", "line_no")
    # Lines without tokens leave after the write: a filter here would have Spark cut every line once more.
    every = work.keep(with_prefix(placed.select("doc", "tk", _cut(F.col("text"))), shingle_words, threshold), "made")
    made = every.filter("n > 0")
    own = made.select("doc", "tk", "line_no", "k1", "k2")
    again = own.groupBy("k1", "k2").agg(F.count("*").alias("times")).filter("times > 1").select("k1", "k2")
    equal = work.keep(own.join(_sent(work.keep(again, "again")), ["k1", "k2"]), "equal")
    firsts = equal.groupBy("k1", "k2").agg(F.min(place).alias("at"))
    repeated = work.keep(equal.join(firsts, ["k1", "k2"]).filter(place != F.col("at")).select("doc", "tk", "line_no"), "repeated")

    def alike(n: Column, m: Column, left: Column) -> Column:
        """Whether lengths n and m, and ``left`` tokens that neither has passed yet, still allow the threshold."""
        return (F.least(n, m) >= threshold * F.greatest(n, m) - 1e-9) & (left >= (n + m) * (threshold / (1 + threshold)) - 1e-9)

    # Lines go by k1 here; should two of them share it, both are read below, and k2 tells them apart.
    posted = made.select("k1", F.explode("prefix").alias("token"))
    shared = work.keep(posted.groupBy("token").agg(F.count("*").alias("c"), F.min("k1").alias("a"), F.max("k1").alias("b")).filter("a < b"), "shared")
    twos = work.keep(shared.filter("c = 2").select("a", "b").distinct(), "twos")
    crowd = work.keep(posted.join(_sent(shared.filter("c > 2").select("token")), "token").select("k1").distinct().withColumn("crowd", F.lit(True)), "crowd")

    # The lines that may match are cut again, and only they; of equal ones the first. Their ids ascend as they stand.
    ends = twos.select(F.col("a").alias("k1")).unionByName(twos.select(F.col("b").alias("k1"))).distinct()
    chosen = crowd.join(ends, "k1", "full").select("k1", F.coalesce("crowd", F.lit(False)).alias("crowd"))
    chosen = own.join(_sent(work.keep(chosen, "chosen")), "k1").groupBy("k1", "k2", "crowd").agg(F.min(place).alias("at")).select("k1", "crowd", "at.*")
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chosen = chosen.repartitionByRange(tasks, "doc", "tk", "line_no").sortWithinPartitions("doc", "tk", "line_no")
    chosen = work.keep(chosen.withColumn("id", F.monotonically_increasing_id()), "sets")
    listed = F.collect_list(F.struct("line_no", "id", "k1", "crowd"))
    wanted = work.keep(chosen.groupBy("doc", "tk").agg(listed.alias("ids")), "wanted")
    # Of repeated rows one is cut; a table without any is neither shuffled nor read once more.
    copies = work.keep(every.filter("line_no = 0").groupBy("doc", "tk").agg(F.count("*").alias("times")).filter("times > 1").select("doc", "tk"), "copies")
    if not copies.isEmpty():
        rows = _sent(copies)
        placed = placed.join(rows, ["doc", "tk"], "left_anti").unionByName(placed.join(rows, ["doc", "tk"], "left_semi").groupBy("doc", "tk").agg(F.first("text").alias("text")))
    texts = placed.join(_sent(wanted), ["doc", "tk"]).select(_picked(F.col("text"), F.col("ids")))
    texts = texts.select("picked.of.id", "picked.of.k1", "picked.of.crowd", _white(F.col("picked.line")).alias("line"))
    whole = work.keep(with_tokens(texts, shingle_words), "whole")
    key = whole.select("k1", "id")
    twos = twos.join(key.select(F.col("k1").alias("a"), F.col("id").alias("x")), "a").join(key.select(F.col("k1").alias("b"), F.col("id").alias("y")), "b")
    twos = twos.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))

    crowded = whole.filter("crowd")
    ranks = rarity(crowded.select(F.explode("t").alias("token")))
    crowded = crowded.select("id", F.size("t").alias("n"), ordered(F.col("t"), ranks).alias("t"))
    entries = crowded.select("id", "n", F.posexplode(F.slice("t", F.lit(1), _prefix(F.col("n"), threshold))).alias("pos", "token"))
    holders = Window.partitionBy("token").orderBy("id")
    entries = entries.withColumns({"h": F.first(F.struct("id", "n", "pos")).over(holders), "next": F.lead("id").over(holders)})
    entries = work.keep(entries.filter("id != h.id or next is not null").drop("next"), "held")
    tried = entries.filter((F.col("id") != F.col("h.id")) & alike(F.col("n"), F.col("h.n"), F.least(F.col("n") - F.col("pos"), F.col("h.n") - F.col("h.pos"))))
    tried = work.keep(tried.select(F.col("h.id").alias("a"), F.col("id").alias("b")).unionByName(twos).distinct(), "tried")

    def verified(pairs: DataFrame) -> DataFrame:
        """id of the later line of each pair whose sets reach the threshold."""
        left = _sent(pairs).join(whole.select(F.col("id").alias("a"), F.col("t").alias("x")), "a")
        right = whole.select(F.col("id").alias("b"), F.col("t").alias("y")).join(_sent(pairs.select("b").distinct()), "b", "left_semi")
        both = F.size(F.array_intersect("x", "y"))
        return left.join(right, "b").filter(both >= threshold * (F.size("x") + F.size("y") - both) - 1e-9).select(F.col("b").alias("id")).distinct()

    decided = work.keep(verified(tried), "decided")
    other = entries.select("token", F.col("id").alias("e"), F.col("n").alias("m"), F.col("pos").alias("p"))
    rest = entries.join(decided, "id", "left_anti").join(other, "token").filter((F.col("e") < F.col("id")) & alike(F.col("n"), F.col("m"), F.least(F.col("n") - F.col("pos"), F.col("m") - F.col("p"))))
    rest = work.keep(rest.select(F.col("e").alias("a"), F.col("id").alias("b")).distinct().join(tried, ["a", "b"], "left_anti"), "rest")
    decided = work.keep(decided.unionByName(verified(rest)).distinct(), "all-decided")
    out = repeated.unionByName(chosen.join(decided, "id", "left_semi").select("doc", "tk", "line_no")).distinct()
    out = work.keep(out.select(F.when(F.col("doc") != 2**63 - 1, F.col("doc")).alias("doc_id"), F.col("tk").alias("text_key"), "line_no"), "out")
    work.drop("made", "again", "equal", "repeated", "sets", "chosen", "shared", "twos", "crowd", "wanted", "copies", "whole", "held", "tried", "decided", "rest", "all-decided")
    return out


def line_report(docs: DataFrame, duplicates: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_lines, n_removed, removed (line numbers from 0, ascending, comma-joined).

    Null text has no lines; repeated rows each have their report; an empty table gives no rows.
    """
    per_doc = duplicates.groupBy(F.col("doc_id").alias("d"), "text_key").agg(F.sort_array(F.collect_set("line_no")).alias("lines"))
    n_lines = F.when(F.col("text").isNull(), 0).otherwise(F.octet_length("text") - F.octet_length(F.replace("text", F.lit("\n"))) + 1)
    counted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("tk"), n_lines.cast("long").alias("n_lines"))
    joined = counted.join(per_doc, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("tk") == F.col("text_key")), "left")
    lines = F.coalesce("lines", F.array().cast("array<int>"))
    return joined.select("doc_id", "n_lines", F.size(lines).cast("long").alias("n_removed"), F.concat_ws(",", lines.cast("array<string>")).alias("removed"))


def drop_lines(docs: DataFrame, duplicates: DataFrame) -> DataFrame:
    """``docs`` without the duplicate lines, all columns kept, whatever their names; a document of nothing else keeps an empty text.

    Rows without duplicate lines, null texts too, stay as they are; repeated rows each lose their lines.
    """
    doc, key, gone = fresh(docs, "doc", "key", "gone")
    per_doc = duplicates.groupBy(F.col("doc_id").alias(doc), F.col("text_key").alias(key)).agg(F.collect_set("line_no").alias(gone))
    joined = docs.join(_sent(per_doc), F.col("doc_id").cast("long").eqNullSafe(F.col(doc)) & (F.xxhash64("text") == F.col(key)), "left")
    kept = F.filter(F.transform(F.split("text", "\n"), lambda x, i: F.when(~F.array_contains(gone, i), x)), lambda x: x.isNotNull())
    text = F.when(F.col(gone).isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    return joined.withColumn("text", text).select(*docs.columns)


#: The same by comparing every pair of lines that share a token.
SQL = r"""
with l as (select doc_id, i - 1 as line_no, list_filter(string_split(regexp_replace(lower(x), '[\x09\x0B-\x0D\x1C-\x1F\x{85}\p{Z}]', ' ', 'g'), ' '), lambda w: w <> '') as w
           from documents, unnest(string_split(text, chr(10))) with ordinality t(x, i) where doc_id is not null and text is not null),
s as (select distinct doc_id, line_no, array_to_string(w[j:j + 4], ' ') as token from l, unnest(range(1, greatest(len(w) - 4, 1) + 1)) t(j) where len(w) > 0),
n as (select doc_id, line_no, count(*) as n from s group by all),
p as (select a.doc_id, a.line_no, b.doc_id as d, b.line_no as l, count(*) as both from s a join s b using (token)
      where b.doc_id < a.doc_id or (b.doc_id = a.doc_id and b.line_no < a.line_no) group by all),
r as (select distinct p.doc_id, p.line_no from p join n x on p.doc_id = x.doc_id and p.line_no = x.line_no join n y on p.d = y.doc_id and p.l = y.line_no
      where p.both >= 0.8 * (x.n + y.n - p.both) - 1e-9),
g as (select doc_id, count(*) as n_removed, string_agg(cast(line_no as varchar), ',' order by line_no) as removed from r group by doc_id)
select d.doc_id, cast(coalesce(len(string_split(text, chr(10))), 0) as bigint) as n_lines, cast(coalesce(n_removed, 0) as bigint) as n_removed, coalesce(removed, '') as removed
from documents d left join g using (doc_id)
"""
