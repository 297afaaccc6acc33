"""Line dedup, decontamination and the pipeline's stages against plain versions; no Python in native plans."""

import hashlib
import math

import pyarrow.parquet as pq
import pytest
from brute import jaccard, words
from pyspark.sql import functions as F

import corpus_pipeline
from tessera.llm import lines, phrases

ROWS = "doc_id long, text string, lang string, source string, n_chars long, n_hit string"


def table(spark, rows):
    return spark.createDataFrame([(k, t, "en", "s", len(t or ""), "x") for k, t in rows], ROWS)


def tokens(line):
    w = line.lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()


def plain_duplicates(rows, threshold=0.8):
    placed = sorted((k, i, frozenset(tokens(x))) for k, t in rows if t is not None for i, x in enumerate(t.split("\n")))
    placed = [p for p in placed if p[2]]
    out = set()
    for j, (k, i, s) in enumerate(placed):
        for a, b, t in placed[:j]:
            if (a, b) < (k, i) and len(s & t) >= threshold * len(s | t) - 1e-9:
                out.add((k, i))
                break
    return out


def line(n, changed=(), tag="w"):
    return " ".join(f"{tag}{i}" if i not in changed else f"changed{i}x{len(changed)}{sum(changed)}" for i in range(n))


def test_lines_against_all_pairs(spark):
    crowd = [(100 + i, line(60, (i,)) + "\n" + line(30, (i % 30,), "v")) for i in range(40)]
    rows = crowd + [(1, f"{line(60)}\nshort one\n{line(60)}"), (2, line(60, (1, 2, 3)) + "\n\n" + line(8)), (3, line(8).upper()), (4, None), (5, ""), (None, line(8)), (6, "a b c d e " * 50), (7, line(8)), (7, line(8))]
    got = {(r.doc_id, r.line_no) for r in lines.duplicate_lines(table(spark, rows)).collect()}
    assert got == plain_duplicates(rows) and (3, 0) in got and (7, 0) in got and (1, 1) not in got
    report = {r.doc_id: (r.n_lines, r.n_removed, r.removed) for r in lines.line_report(table(spark, rows), lines.duplicate_lines(table(spark, rows))).collect()}
    assert report[1] == (3, 1, "2") and report[4] == (0, 0, "") and report[5] == (1, 0, "")


def test_prefixes_share_a_token_wherever_lines_match(spark):
    texts = []
    for i in range(120):
        base = [f"w{(i * 7 + j * j) % 90}" if j % 3 else "ab"[j % 2] for j in range(1 + i % 60)]
        texts += [" ".join(base), " ".join([*base[:-1], "end"]), " ".join(base[:2] * 9 + base)]
    df = spark.createDataFrame(list(enumerate(texts)), "at long, line string").repartition(3)
    found = {r["at"]: set(r.prefix) for r in lines.with_prefix(df, 5, 0.8).collect()}
    sets = [tokens(x) for x in texts]
    linked = [(a, b) for a, x in enumerate(sets) for b, y in enumerate(sets[:a]) if len(x & y) >= 0.8 * len(x | y) - 1e-9]
    assert len(linked) > 50 and all(found[a] & found[b] for a, b in linked)
    assert all(len(found[i]) <= max(len(x.split()) - 4, 1) * 0.2 + 1 for i, x in enumerate(texts))


def test_a_prefix_is_the_first_of_all_tokens_in_their_order(spark):
    texts = [" ".join(f"w{(i * j * j) % (2 + i % 40)}" for j in range(1 + i % 70)) for i in range(200)]
    df = spark.createDataFrame(list(enumerate(texts)), "at long, line string")
    whole = {r["at"]: list(r.prefix) for r in lines.with_prefix(df, 5, 1e-9).collect()}
    found = {r["at"]: list(r.prefix) for r in lines.with_prefix(df, 5, 0.8).collect()}
    for i, x in enumerate(texts):
        n = len(x.split()) - 4
        assert len(whole[i]) == len(tokens(x)) and found[i] == (whole[i] if n < 1 else whole[i][: n - math.ceil(n * 0.8 - 1e-9) + 1])


def test_only_wanted_lines_are_read_again_and_hashes_are_written_plainly(spark):
    text = "one\u00a0a\n\ntwo\tb\nthree"
    df = spark.createDataFrame([(text, [(3, 30), (0, 10)]), (text, [(1, 20)])], "text string, ids array<struct<line_no: int, id: long>>")
    rows = df.select(lines._picked(F.col("text"), F.col("ids"))).select("picked.of.id", "picked.line")
    assert sorted(map(tuple, rows.collect())) == [(10, "one\u00a0a"), (20, ""), (30, "three")]
    assert rows._jdf.queryExecution().optimizedPlan().toString().count("split(") == 1
    found = lines.duplicate_lines(table(spark, [(1, line(20)), (2, line(20))]))
    columns = [pq.ParquetFile(f.removeprefix("file://")).metadata.row_group(0).column(c) for f in found.inputFiles() for c in range(3) if pq.ParquetFile(f.removeprefix("file://")).metadata.num_rows]
    assert columns and all(c.compression == "UNCOMPRESSED" and not c.has_dictionary_page for c in columns)


def test_lines_of_repeated_rows_and_rows_without_an_id(spark):
    crowd = [(100 + i, line(60, (i,)) + "\n" + line(30, (i % 30,), "v")) for i in range(40)]
    rows = crowd + [(None, line(60, (3,))), (7, line(60)), (7, line(60)), (7, line(60, (9,))), (None, line(8)), (2, line(8)), (5, "a b c d e " * 50), (6, "a b c d e " * 40)]
    got = {(r.doc_id, r.text_key, r.line_no) for r in lines.duplicate_lines(table(spark, rows)).collect()}
    keys = dict(table(spark, rows).select("text", F.xxhash64("text")).distinct().collect())
    last = 2**63 - 1
    distinct = sorted({(last if k is None else k, keys[t], t) for k, t in rows})
    placed = [(k, h, i, frozenset(tokens(x))) for k, h, t in distinct for i, x in enumerate(t.split("\n"))]
    want = {(k if k != last else None, h, i) for j, (k, h, i, s) in enumerate(placed) if any(len(s & o) >= 0.8 * len(s | o) - 1e-9 for *_, o in placed[:j])}
    assert got == want and {k for k, *_ in got} >= {None, 7, 6}


def test_dropped_lines_leave_the_rest(spark):
    rows = [(1, f"{line(9)}\nkeep me"), (2, f"first\n{line(9)}\n\nlast"), (3, line(9)), (4, None)]
    df = table(spark, rows)
    got = {r.doc_id: r.text for r in lines.drop_lines(df, lines.duplicate_lines(df)).collect()}
    assert got == {1: rows[0][1], 2: "first\n\nlast", 3: "", 4: None}


def test_short_and_tabbed_lines_go_in_the_pipeline(spark):
    tabbed = line(7).replace(" ", "\t")
    rows = [(1, f"Les.\nOf, edti oner.\n{tabbed}\n"), (2, f"les.\nOf,  edti\u00a0oner.\n\nalone here\n{line(7)}"), (3, "Of, edti"), (4, "Les.\n\n \nLes. "), (5, line(7) + " more")]
    rows += [(10 + i, "Les.") for i in range(20)]
    got = {r.doc_id: r.text for r in corpus_pipeline.line_dedup(spark, table(spark, rows), "").collect()}
    assert got == {1: rows[0][1], 2: "\nalone here", 3: "Of, edti", 4: "\n ", 5: rows[4][1]} | {10 + i: "" for i in range(20)}


def plain_contamination(text, items):
    w = words(text)
    hit, found = set(), set()
    for key, item in items:
        iw = words(item)
        n = min(13, len(iw))
        for s in range(max(len(iw) - 12, 1) if iw else 0):
            for d in range(len(w) - n + 1):
                if w[d : d + n] == iw[s : s + n]:
                    hit |= set(range(d, d + n))
                    if key is not None:
                        found.add(str(key))
    ids = ",".join(sorted(found))
    return len(w), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(), len(hit) > 0 and 20 * len(hit) >= len(w)


def test_contamination_against_all_windows(spark):
    item = " ".join(f"q{i}" for i in range(30))
    items = [(10, item), (9, "Short Item Here"), (11, item), (12, None), (13, "..."), (None, "lonely"), (14, "the " * 20), (15, "École Été q1"), (9, "other text"), (16, "ΟΔΟΣ.ΑΒ γάμμα")]
    rows = [
        (1, item.upper() + " tail"),
        (2, "x " * 300 + " ".join(f"q{i}" for i in range(5, 18))),
        (3, "q0 " + " ".join(f"q{i}" for i in range(2, 14))),
        (4, None),
        (5, "short, item; HERE"),
        (6, "lonely"),
        (7, "the " * 40),
        (8, "école été q1"),
        (8, "École ÉtÉ q1"),
        (None, "École Été q1 short item here"),
        (20, ""),
        (21, "q29 " + item + " " + item),
        (22, "é" * 100_000),
        (23, "ΟΔΟΣ.ΑΒ γάμμα"),
        (24, "οδοσ.αβ γάμμα"),
    ]
    bench = spark.createDataFrame([(k, t) for k, t in items], "item_id long, text string")
    out = phrases.contamination(table(spark, rows), bench)
    got = sorted(str(tuple(r)) for r in out.drop("text_key").collect())
    assert got == sorted(str((k, *plain_contamination(t, items))) for k, t in rows)
    empty = phrases.contamination(table(spark, rows), bench.limit(0))
    assert {(r.n_hit, r.contaminated) for r in empty.collect()} == {(0, False)} and phrases.contamination(table(spark, []), bench).count() == 0


def test_proximity(spark):
    bench = spark.createDataFrame([(1, "alpha beta gamma")], "item_id long, text string")
    df = table(spark, [(1, "gamma x alpha x beta"), (2, "alpha " + "x " * 50 + "beta gamma"), (3, "alpha beta")])
    assert [tuple(r) for r in phrases.proximity_matches(df, bench, terms=3, span=10).collect()] == [(1, 1, 0, 4)]


def test_proximity_at_every_place_and_without_missing_words(spark):
    bench = spark.createDataFrame([(1, "alpha beta gamma missing")], "item_id long, text string")
    df = table(spark, [(1, "gamma x alpha x beta " + "x " * 20 + "alpha beta gamma")])
    assert sorted(tuple(r) for r in phrases.proximity_matches(df, bench, terms=3, span=10).collect()) == [(1, 1, 0, 4), (1, 1, 25, 27)]


def test_native_plans_hold_no_python(spark):
    df = table(spark, [(1, line(20)), (2, line(20))])
    bench = spark.createDataFrame([(1, line(20))], "item_id long, text string")
    for out in (lines.line_report(df, lines.duplicate_lines(df)), phrases.contamination(df, bench)):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_texts_are_cut_once_whatever_columns_are_read(spark):
    bench = spark.createDataFrame([(1, line(20))], "item_id long, text string")
    out = phrases.contamination(table(spark, [(1, line(20)), (2, "x")]), bench).filter("contaminated").select("doc_id")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "split(" not in plan and "regexp" not in plan and [r.doc_id for r in out.collect()] == [1]


def test_clean_rows_under_the_id_of_a_removed_one_stay(spark, tmp_path):
    bench, clean = " ".join(f"b{i}" for i in range(20)), [" ".join(f"c{i}w{j}" for j in range(30)) for i in range(3)]
    spark.createDataFrame([(1, bench)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(1, bench), (1, clean[0]), (None, bench), (None, clean[1]), (2, clean[0] + " more"), (2, clean[2]), (None, clean[0])]
    clashing = table(spark, rows).withColumns({c: F.lit(7) for c in ("removed_doc", "removed_key", "doc", "key", "gone", "row", "words")})
    left = corpus_pipeline.decontaminate(spark, clashing, str(tmp_path))
    assert left.columns == clashing.columns
    assert sorted((r.doc_id or 0, r.text) for r in left.collect()) == sorted((k or 0, t) for k, t in rows if t != bench)
    left = corpus_pipeline.near_dedup(spark, clashing, str(tmp_path))
    assert sorted((r.doc_id or 0, r.text) for r in left.collect()) == sorted([(1, bench), (1, clean[0]), (0, clean[1]), (2, clean[2])])
    left = corpus_pipeline.line_dedup(spark, clashing, str(tmp_path))
    assert sorted((r.doc_id or 0, r.text) for r in left.collect()) == sorted([(1, bench), (1, clean[0]), (0, ""), (0, clean[1]), (2, ""), (2, clean[2]), (0, "")])


def test_the_whole_pipeline(spark):
    rows = corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect()
    docs = {r.doc_id for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    assert rows and {r.doc_id for r in rows} < docs
    places = sorted((r.sequence_id, r.offset, r.length) for r in rows)
    for (s, a, n), (t, b, _) in zip(places, places[1:], strict=False):
        assert (b == a + n) if s == t else (b == 0 and a + n <= 1024)


def test_stages_keep_columns_and_clean_rows(spark, tmp_path):
    clean = [(i, " ".join(f"c{i}w{j}" for j in range(30))) for i in range(12)]
    copy = (50, clean[3][1].replace("c3w29", "other"))
    bench = " ".join(f"b{i}" for i in range(20))
    rows = clean + [copy, (60, bench + " x"), (None, "no id but text of its own, quite short"), (61, None), (62, "")]
    df = table(spark, rows).withColumn("extra", F.lit(1))
    spark.createDataFrame([(1, bench)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5 and corpus_pipeline.ORACLE_SQL is None
    docs = df
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == df.columns
        docs.write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
    left = {r.doc_id: r.text for r in docs.collect()}
    assert set(left) == {*range(12), 61, 62, 50, None} and left[50] == "" and all(left[k] == t for k, t in clean)
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).collect()
    assert {r.doc_id for r in packed} == set(left)


@pytest.mark.parametrize("a,b,want", [("a b c d e f", "a b c d e f", 1.0), ("a b c d e", "x", 0.0)])
def test_brute_similarity(a, b, want):
    from brute import shingles

    assert jaccard(shingles(a), shingles(b)) == want
