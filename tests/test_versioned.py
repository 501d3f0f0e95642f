import threading

import pytest

from ledgerlens import versioned
from ledgerlens.versioned import prune, publish_version, read_version, versions


def rows(spark, n):
    """A result that says itself how many rows it has."""
    return spark.range(n, numPartitions=3).selectExpr("id", f"{n} AS whole")


def whole(df):
    got = df.collect()
    assert {r.whole for r in got} == {len(got)}
    return len(got)


def test_the_newest_version_is_read_and_earlier_ones_stay(spark, tmp_path):
    root = str(tmp_path / "result")
    with pytest.raises(FileNotFoundError):
        read_version(spark, root)
    assert [publish_version(spark, rows(spark, n), root, "parquet") for n in (5, 7, 3)] == [0, 1, 2]
    assert whole(read_version(spark, root)) == 3
    assert whole(read_version(spark, root, 0)) == 5
    assert versions(spark, root) == [2, 1, 0]


def test_a_writer_that_dies_before_the_pointer_changes_nothing(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "result")
    publish_version(spark, rows(spark, 4), root)
    with monkeypatch.context() as m:
        def die(*_):
            raise OSError("lost")

        m.setattr(versioned, "point", die)
        with pytest.raises(OSError):
            publish_version(spark, rows(spark, 9), root)
    assert whole(read_version(spark, root)) == 4
    # nor does one that dies while it writes the pointer
    (tmp_path / "result" / "pointers" / "0000000001").write_text('{"data": "abc", "for')
    assert whole(read_version(spark, root)) == 4
    assert versions(spark, root) == [0]
    assert publish_version(spark, rows(spark, 6), root) == 2
    assert whole(read_version(spark, root)) == 6


def test_a_reader_in_a_loop_always_sees_one_complete_version(spark, tmp_path):
    root = str(tmp_path / "result")
    publish_version(spark, rows(spark, 1), root, "parquet")
    seen, wrong, done = [], [], threading.Event()

    def read():
        while not done.is_set():
            try:
                seen.append(whole(read_version(spark, root)))
            except Exception as e:
                wrong.append(e)

    reader = threading.Thread(target=read)
    reader.start()
    try:
        for n in range(2, 12):
            publish_version(spark, rows(spark, n), root, "parquet")
            prune(spark, root, keep=8)
    finally:
        done.set()
        reader.join()
    assert not wrong
    assert seen == sorted(seen) and set(seen) <= set(range(1, 12))
    assert whole(read_version(spark, root)) == 11


def test_writers_at_the_same_time_take_versions_of_their_own(spark, tmp_path):
    root = str(tmp_path / "result")
    got = []
    writers = [threading.Thread(target=lambda n=n: got.append(publish_version(spark, rows(spark, n), root, "parquet"))) for n in range(1, 6)]
    for w in writers:
        w.start()
    for w in writers:
        w.join()
    assert sorted(got) == [0, 1, 2, 3, 4]
    assert sorted(whole(read_version(spark, root, v)) for v in got) == [1, 2, 3, 4, 5]


def test_pruning_keeps_the_newest_and_empty_results_keep_their_schema(spark, tmp_path):
    root = str(tmp_path / "result")
    for n in (1, 2, 3, 0):
        publish_version(spark, rows(spark, n), root)
    assert prune(spark, root, keep=2) == 2
    assert versions(spark, root) == [3, 2]
    assert len(list((tmp_path / "result" / "data").iterdir())) == 2
    got = read_version(spark, root)
    assert got.collect() == [] and got.dtypes == rows(spark, 0).dtypes
    with pytest.raises(FileNotFoundError):
        read_version(spark, root, 0)
    with pytest.raises(ValueError):
        prune(spark, root, keep=0)
