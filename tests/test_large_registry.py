import json

import pytest

from ledgerlens.sources.large_registry import read_large_registry
from ledgerlens.sources.ledger import read_registry

ENTRIES = {
    "one, and {half": {"id": 1, "category": "Phi\"sh,ing", "status": "Off\\", "addresses": ["0xa", "0xb,}"], "more": {"x": [1, {"y": 2}]}},
    "two": {"id": 2, "category": "Fake ICO", "status": "é,{[", "addresses": []},
    "three": {"id": 3, "category": "", "status": "Active", "addresses": ["0xc"]},
    "four": {"id": 4, "category": "Scam", "status": None, "addresses": None},
}
TEXT = '{"success": true, "meta": {"a": {"id": 9}, "b": [1, 2]}, "result": ' + json.dumps(ENTRIES, ensure_ascii=False)[:-1]
TEXT += ', "two": {"id": 22, "category": "Last, counts", "status": "Active", "addresses": ["0xd"]}}, "after": {"z": {"id": 8}}, "n": 1}\n'


@pytest.fixture
def cut(spark):
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = [spark.conf.get(k) for k in keys]

    def at(size):
        for k in keys:
            spark.conf.set(k, str(size))

    yield at
    for k, v in zip(keys, old):
        spark.conf.set(k, v)


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("size", [3, 7, 20, 64, 1 << 20])
def test_equal_to_the_whole_document_wherever_it_is_cut(spark, tmp_path, cut, size):
    (tmp_path / "a.json").write_text(TEXT, encoding="utf-8")
    (tmp_path / "b.json").write_text('{"result":{"five":{"id":5,"category":"c","addresses":["0xe"]}}}', encoding="utf-8")
    (tmp_path / "none.json").write_text('{"result": { }, "x": "a,b"}', encoding="utf-8")
    want = rows(read_registry(spark, str(tmp_path)))
    assert len(want) == 5
    cut(size)
    assert rows(read_large_registry(spark, str(tmp_path))) == want


@pytest.mark.parametrize("text", [
    TEXT.strip()[:-1], TEXT.strip() + "}", TEXT.replace('"id": 3,', '"id": 3 "x"'), TEXT.replace('"result"', '"other"'),
    TEXT.replace('"three": {', '"three: {'), TEXT.replace('"id": 3, ', ""), '{"result":{"a":{"id":1,"category":"c"}]}',
])
def test_malformed_text_stops_the_job(spark, tmp_path, cut, text):
    (tmp_path / "a.json").write_text(text, encoding="utf-8")
    cut(50)
    df = read_large_registry(spark, str(tmp_path))
    with pytest.raises(Exception, match="malformed|MALFORMED|without"):
        df.collect()


def test_files_without_a_document(spark, tmp_path):
    (tmp_path / "a.json").write_text("")
    (tmp_path / "b.json").write_text(" \n")
    assert read_large_registry(spark, str(tmp_path)).collect() == []
