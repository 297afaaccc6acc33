"""Ids against the library itself, files against a round trip, packing against its own rules."""

import io
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from tessera.llm import packing, records
from tessera.llm.bpe import BpeEncoder, vocabulary

TEXTS = st.text(alphabet=st.sampled_from("ab'sZ9 é\n\t\r  \u0085.!-<|>endoftext\U0001f600"), max_size=60)
SCHEMA = "doc_id long, text string, piece string, sequence_id string, start int"


@pytest.fixture(scope="module")
def bpe():
    return BpeEncoder(vocabulary(), cache=50)


def plain(bpe, text):
    return [*bpe.tokenizer.encode(text or "", add_special_tokens=False).ids, 2]


@settings(max_examples=1500, deadline=None)
@given(st.lists(TEXTS, min_size=1, max_size=5))
def test_chunks_do_not_change_ids(bpe, texts):
    got = [np.frombuffer(x, "<u2").tolist() for x in bpe.encode(pa.array(texts, pa.string()), 2)]
    assert got == [plain(bpe, x) for x in texts]


@pytest.mark.parametrize("text", ["", " ", "  ", "a  b", "a\n b", "a \n b", " a", "a ", "a\n ", "<|endoftext|>", "a <|endoftext|> b", "it's 'tis", "x  y"])
def test_white_space_and_special_tokens(bpe, text):
    assert np.frombuffer(bpe.encode(pa.array([text]), 2)[0], "<u2").tolist() == plain(bpe, text)


def rows(spark):
    long = "word und öfter " * 9000
    data = [(3, "b a", "x", "y", 1), (1, None, None, None, None), (None, "no id", "", "", 0), (2, "", "p", "q", 2), (7, long, "p", "q", 2), (3, "b a", "x", "y", 1), (5, "emoji \U0001f600  x", None, None, 3)]
    return spark.createDataFrame(data, T._parse_datatype_string(SCHEMA)), [(a, b) for a, b, *_ in data]


def test_record_files_round_trip(spark, bpe):
    df, data = rows(spark)
    got = sorted(records.token_record_digests(df, files=3).collect(), key=lambda r: r.start)
    want, start = [], 0
    for key, text in sorted(data, key=lambda r: (r[0] is not None, r[0], r[1] or "")):
        ids = plain(bpe, text)
        want.append((key, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert [tuple(r) for r in got] == want


def test_index_serves_any_order_and_damage_is_found(spark, bpe, tmp_path):
    df, _ = rows(spark)
    made = [r for r in records.write_token_records(df.filter("doc_id in (2, 3, 5)"), f"file://{tmp_path}/out", files=1).collect() if r.n_docs]
    file = made[0].file
    keys = [k for k, _ in records.read_at(file, [3, 0, 2])]
    assert keys == [5, 2, 3]
    data = bytearray(open(file.removeprefix("file://"), "rb").read())
    data[14] ^= 1
    with pytest.raises(ValueError):
        records.read_record(io.BytesIO(bytes(data)))


def test_empty_table(spark):
    empty = spark.createDataFrame([], T._parse_datatype_string(SCHEMA))
    assert records.token_record_digests(empty, files=2).count() == 0
    assert packing.pack_documents(empty).count() == 0


def test_pieces_and_places(spark, bpe):
    df, data = rows(spark)
    got = packing.pack_documents(df, capacity=64, group_pieces=4).collect()
    want = []
    for key, text in data:
        ids = plain(bpe, text)
        first = (len(ids) - 1) % 64 + 1
        cuts = [0, *range(first, len(ids) + 1, 64)]
        want += [(key, i, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())) for i, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))]
    order = lambda r: tuple(-1 if x is None else x for x in r)
    assert sorted((tuple(r)[:5] for r in got), key=order) == sorted(want, key=order)
    places = {}
    for r in got:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for x in places.values():
        x.sort()
        assert x[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(x, x[1:], strict=False)) and sum(x[-1]) <= 64


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 19), max_size=60))
def test_sum_of_squares_is_least_each_time(sizes):
    capacity, gaps, where = 20, [], []
    bins, offsets = packing.sum_of_squares(np.array(sizes, dtype=np.int64), capacity)
    for size, at, offset in zip(sizes, bins, offsets, strict=True):
        fits = sorted({g for g in gaps if g >= size})

        def total(gap):
            after = list(gaps)
            after.remove(gap)
            after += [gap - size] * (gap > size)
            return sum(after.count(x) ** 2 for x in set(after))

        gap = capacity - int(offset)
        if fits:
            assert total(gap) == min(map(total, fits))
            gaps.remove(gap)
        else:
            assert gap == capacity
        gaps += [gap - size] * (gap > size)
        where.append(at)
    assert len(set(where)) >= -(-sum(sizes) // capacity)


def test_one_vocabulary_in_memory(bpe):
    from tokenizers import Tokenizer

    assert sum(isinstance(x, Tokenizer) for x in vars(bpe).values()) == 1


def test_packing_leaves_no_texts_in_its_workers(spark):
    docs = spark.range(2000).selectExpr("id as doc_id", "concat_ws(' ', transform(sequence(0, 20), i -> concat('w', id, 'x', i))) as text").repartition(4)
    assert packing.cut_pieces(docs).count() == 2000

    def held(batches):
        from tessera.llm import bpe

        for _ in batches:
            yield pa.RecordBatch.from_pydict({"known": [sum(len(e.known) for e in bpe._ENCODERS.values())], "encoders": [len(bpe._ENCODERS)]})

    found = spark.range(4, numPartitions=4).mapInArrow(held, "known long, encoders long").collect()
    assert max(r.encoders for r in found) == 1 and max(r.known for r in found) == 0


def test_memory_is_given_back_at_the_end_of_a_task():
    import psutil

    from tessera.llm._work import releasing

    kept = []

    def run(batches):
        blocks = [np.ones(12_000) for _ in range(2000)]
        kept.append(blocks[-1])
        yield from batches

    before = psutil.Process().memory_info().rss
    assert list(releasing(run)(iter([1, 2]))) == [1, 2]
    assert psutil.Process().memory_info().rss - before < 60e6
