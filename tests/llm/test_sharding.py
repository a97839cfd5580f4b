"""Sharding by a permutation of row numbers."""

import random
import zlib

import numpy as np
import pytest

from chatlog.llm import numbering, sharding as S
from fixtures import docs


@pytest.mark.parametrize("rows", [1, 2, 3, 4, 5, 16, 17, 255, 256, 257, 5000])
def test_permutation_and_its_inverse(rows):
    moved = S.permute(np.arange(rows), rows)
    assert sorted(moved.tolist()) == list(range(rows))
    assert (S.permute(moved, rows, back=True) == np.arange(rows)).all()
    shard, slot = S.locate(np.arange(rows), rows, 7)
    assert (S.row_at(shard, slot, rows, 7) == np.arange(rows)).all()
    if rows > 200:
        assert (S.permute(np.arange(rows), rows, 1) != moved).mean() > 0.9 and (moved != np.arange(rows)).mean() > 0.9


def test_too_many_rows_are_refused():
    assert S.half_bits(1 << 48) == 24
    with pytest.raises(ValueError):
        S.half_bits((1 << 48) + 1)


def fixture():
    rng = random.Random(4)
    rows = [(i * 3 - 50, f"text {rng.random()} é" * rng.randrange(1, 4)) for i in range(120)]
    rows += [(7, "again")] * 300 + [(None, "x")] * 50 + [(None, None), (5, None), (5, ""), (1000, "z" * 100_000), (8, "日本")]
    rng.shuffle(rows)
    return rows


def brute(rows, shards=S.SHARDS, seed=S.SEED):
    each = sorted(((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows),
                  key=lambda r: (r[0] is not None, r[0] or 0, *r[1:]))
    place = S.permute(np.arange(len(each)), len(each), seed)
    return sorted([(*r, "rows", int(p % shards), int(p // shards), None) for r, p in zip(each, place)], key=repr)


@pytest.mark.parametrize("shards, block", [(16, 65_536), (3, 64)])
def test_places_equal_brute_force(spark, monkeypatch, shards, block):
    monkeypatch.setattr(numbering, "COPY_BLOCK", block)
    rows = fixture()
    got = sorted((tuple(r) for r in S.place(docs(spark, rows, extra=True), shards).collect()), key=repr)
    assert got == brute(rows, shards)
    sizes = [sum(r[4] == k for r in got) for k in range(shards)]
    assert max(sizes) - min(sizes) <= 1
    for k in range(shards):
        assert sorted(r[5] for r in got if r[4] == k) == list(range(sizes[k]))


def test_files_and_partitions_do_not_matter(spark):
    rows = fixture()
    one = sorted(map(tuple, S.place(docs(spark, rows).coalesce(1)).collect()), key=repr)
    many = sorted(map(tuple, S.place(docs(spark, rows[::-1]).repartition(9)).collect()), key=repr)
    assert one == many


def test_text_ids_and_empty_table(spark):
    df = spark.createDataFrame([("b", "x", 1), ("a", "y", 2)], "name string, body string, shard int")
    got = S.place(df, 2, id_col="name", text_col="body").collect()
    assert sorted(r.name for r in got) == ["a", "b"] and sorted(r.shard for r in got) == [0, 1]
    assert S.place(docs(spark, []).filter("doc_id > 0")).collect() == []


def test_written_shards_hold_the_texts_in_their_places(spark, tmp_path):
    rows = fixture()
    S.write_shards(docs(spark, rows), str(tmp_path / "out"), shards=4, rows_per_file=40)
    got = spark.read.parquet(str(tmp_path / "out")).collect()
    want = {(r[4], r[5]): r for r in brute(rows, 4)}
    assert len(got) == len(rows)
    for r in got:
        i, size, crc, *_ = want[r.shard, r.slot]
        assert (r.doc_id, len(r.text.encode()) + 1, zlib.crc32(r.text.encode())) == (i, size, crc)
