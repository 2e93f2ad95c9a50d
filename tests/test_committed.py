"""The table with commits: pruned merges, repeated batches, two writers, compaction."""

from __future__ import annotations

import hashlib
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from shockline.sources import write
from shockline.sources.committed import CommitConflict, CommittedTable

from .test_sources import gold_frame


def ident(i):
    return hashlib.sha256(str(i).encode()).hexdigest()


def frame(spark, numbers, v=0):
    return spark.createDataFrame([(ident(i), i, v) for i in numbers], "signal_id string, n int, v int")


def numbers(table):
    rows = table.read().collect()
    assert len({r.signal_id for r in rows}) == len(rows)
    return sorted(r.n for r in rows)


def test_known_ids_stay_and_batches_count_once(spark, tmp_path):
    t = CommittedTable(spark, str(tmp_path / "t"))
    assert t.read() is None
    assert t.merge(frame(spark, [1, 2, 2]), "w", 0).inserted == 2
    assert t.merge(frame(spark, [1, 2, 3], v=9), "w", 1).inserted == 1
    assert t.merge(frame(spark, [4]), "w", 1).version is None  # the batch is there
    assert t.merge(frame(spark, [4]), "other", 1).inserted == 1
    assert t.merge(frame(spark, [])).inserted == 0
    assert numbers(t) == [1, 2, 3, 4] and t.read().agg(F.sum("v")).first()[0] == 9
    assert t.read(version=1).count() == 2


def test_parts_read_follow_the_batch(spark, tmp_path):
    t = CommittedTable(spark, str(tmp_path / "t"))
    for k in range(4):
        t.merge(frame(spark, range(1000 * k, 1000 * k + 1000)), "w", k)
    parts = sum(len(c.rows) for c in t.log())
    assert parts > 900
    one = t.merge(frame(spark, [5]))
    assert one.inserted == 0 and one.parts == parts and 1 <= one.parts_read <= 2
    new = t.merge(frame(spark, range(10_000, 10_040)))
    assert new.inserted == 40 and new.parts_read <= 20  # filters let a few pass that aren't there
    half = t.merge(frame(spark, [*range(0, 20), *range(20_000, 20_020)]))
    assert half.inserted == 20 and 18 <= half.parts_read <= 40
    # the files that a merge reads are those of the candidates
    files = t._parts(t.candidates(frame(spark, [5]), t.log())).inputFiles()
    assert 1 <= len(files) <= 2


def test_two_writers_conflict_visibly(spark, tmp_path):
    a, b = (CommittedTable(spark, str(tmp_path / "t")) for _ in range(2))
    a.merge(frame(spark, [0]))
    came = []

    def other():
        if not came:
            came.append(b.merge(frame(spark, [2, 3], v=1), "b", 0))

    won = a.merge(frame(spark, [1, 2]), "a", 0, before_commit=other)
    assert came[0].version == 2 and won.version == 3 and won.lost_to == [2] and won.inserted == 1
    assert numbers(a) == [0, 1, 2, 3] and [c.lost_to for c in a.log()] == [[], [], [2]]
    with pytest.raises(CommitConflict):
        a.merge(frame(spark, [7]), retries=0, before_commit=lambda: b.merge(frame(spark, [8])))
    assert numbers(a) == [0, 1, 2, 3, 8]
    # nothing in common: the folder that was written is committed as it is
    came.clear()
    assert a.merge(frame(spark, [20, 21]), before_commit=lambda: came or came.append(b.merge(frame(spark, [30])))).inserted == 2
    assert numbers(a) == [0, 1, 2, 3, 8, 20, 21, 30]


def test_many_writers_at_once(spark, tmp_path):
    tables = [CommittedTable(spark, str(tmp_path / "t")) for _ in range(4)]
    with ThreadPoolExecutor(4) as pool:
        done = list(pool.map(lambda k: tables[k].merge(frame(spark, range(k, k + 6), v=k), f"w{k}", 0, retries=20), range(4)))
    assert numbers(tables[0]) == list(range(9)) and sum(m.inserted for m in done) == 9
    assert sorted(m.version for m in done) == [1, 2, 3, 4]


def test_compaction_keeps_rows_and_batches(spark, tmp_path):
    t = CommittedTable(spark, str(tmp_path / "t"))
    assert t.compact() is None
    for k in range(3):
        t.merge(frame(spark, range(k, k + 3)), "w", k)
    t._write(frame(spark, [99]))  # a writer that was lost before its commit
    assert numbers(t) == [0, 1, 2, 3, 4]
    assert t.compact() == 4 and len(t.log()) == 1 and numbers(t) == [0, 1, 2, 3, 4]
    assert t.merge(frame(spark, [50]), "w", 2).version is None and t.merge(frame(spark, [4, 50]), "w", 3).inserted == 1
    assert len(t.vacuum()) == 4 and t.vacuum() == [] and numbers(t) == [0, 1, 2, 3, 4, 50]


def test_gold_merge(spark, tmp_path):
    path = str(tmp_path / "gold")
    write.merge_signals(gold_frame(spark, ["a", "b"]), path, 0)
    write.merge_signals(gold_frame(spark, ["a", "b"]), path, 0)
    write.merge_signals(gold_frame(spark, ["b", "c"]), path, 1)
    write.merge_signals(gold_frame(spark, ["c", "e"]), path)
    assert sorted(r.shock_id for r in write.signals_at(spark, path).collect()) == ["a", "b", "c", "e"]
    assert write.signals_at(spark, path).schema.fieldNames() == gold_frame(spark, ["a"]).schema.fieldNames()


def test_a_stream_merges_each_batch_once(spark, tmp_path):
    path, source = str(tmp_path / "t"), str(tmp_path / "in")
    frame(spark, [1, 2]).write.json(f"{source}/a")
    stream = spark.readStream.schema("signal_id string, n int, v int").option("recursiveFileLookup", True).json(source)
    for extra in ([2, 3], None):
        q = stream.writeStream.foreachBatch(lambda df, i: CommittedTable(df.sparkSession, path).merge(df, "stream", i)).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
        q.awaitTermination()
        if extra:
            frame(spark, extra).write.json(f"{source}/b")
    assert numbers(CommittedTable(spark, path)) == [1, 2, 3]
