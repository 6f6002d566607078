"""One JSON document, read in byte ranges: equal to a whole parse."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from filingflow.local_paths import to_local
from filingflow.session import new_run_dir
from filingflow.sources.documents import read_filings_document
from filingflow.sources.json_array import Place, read_array, segment

NASTY = ['}', '{', '"', '\\', ']}', '{"filings": [{', 'a\\"}b', '\n', 'é', ' ', ': [', ',', '}}}', '\\\\"}']


def _value(rnd, depth=0):
    kind = rnd.random()
    if depth < 3 and kind < 0.2:
        return {rnd.choice(["filings", "a", "}", "k{"]) + str(i): _value(rnd, depth + 1) for i in range(rnd.randint(0, 3))}
    if depth < 3 and kind < 0.35:
        return [_value(rnd, depth + 1) for _ in range(rnd.randint(0, 3))]
    return rnd.choice([None, True, 1.5, -3, "", "".join(rnd.choices(NASTY, k=rnd.randint(0, 6)))])


def _document(rnd, n):
    filings = [{f"k{i}": _value(rnd) for i in range(rnd.randint(0, 4))} for _ in range(n)]
    before = {"metadata": {"filings": [{"no": 1}], "x": _value(rnd)}, "other": [{"no": 2}], "text": '"filings": [{"no": 3}]'}
    after = {"last": [{"no": 4}, {"filings": [{"no": 5}]}]}
    return {**before, "filings": filings, **after}, filings


@pytest.fixture
def small_ranges(spark):
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    was = {k: spark.conf.get(k) for k in keys}
    yield lambda n: (spark.conf.set(keys[0], str(n)), spark.conf.set(keys[1], "1"))
    for k, v in was.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("size,indent", [(150, None), (700, 1), (40, None), (5000, 2)])
def test_elements_equal_a_whole_parse(spark, small_ranges, size, indent):
    rnd = random.Random(size)
    folder = to_local(new_run_dir(spark, "json-array"))
    os.makedirs(folder)
    want = {}
    for i, n in enumerate((0, 1, 40, 120)):
        doc, filings = _document(rnd, n)
        with open(f"{folder}/d{i}.json", "w", encoding="utf-8") as fh:
            json.dump(doc, fh, ensure_ascii=i % 2 == 0, indent=indent)
        want[f"d{i}.json"] = filings
    small_ranges(size)
    rows = read_array(spark, folder)
    got = {name: [] for name in want}
    for r in rows.collect():
        got[r.file.rsplit("/", 1)[1]].append(json.loads(r.element))
    key = lambda x: json.dumps(x, sort_keys=True)
    assert {k: sorted(map(key, v)) for k, v in got.items()} == {k: sorted(map(key, v)) for k, v in want.items()}
    assert rows.select(F.spark_partition_id()).distinct().count() > 4 or size > 700


def test_filings_document_by_many_tasks(spark, small_ranges):
    folder = to_local(new_run_dir(spark, "json-array"))
    os.makedirs(folder)
    filings = [{"fecha": "1", "emisora": f"A}} {i}", "asunto": 's"' * (i % 3), "key": str(i), "extra": {"a": [1, {"b": 2}]}} for i in range(500)]
    with open(f"{folder}/doc.json", "w") as fh:
        json.dump({"metadata": {"total_filings": 500}, "filings": filings}, fh, indent=2)
    small_ranges(4000)
    df = read_filings_document(spark, f"{folder}/doc.json")
    assert {(r.key, r.emisora, r.asunto) for r in df.collect()} == {(f["key"], f["emisora"], f["asunto"]) for f in filings}
    assert df.rdd.getNumPartitions() >= 8


def test_segment_states():
    p = Place()
    assert segment(p, '{"metadata": {"a": 1}', "filings") == (None, False) and p.depth == 1 and not p.array
    assert segment(p, ', "filings": [ {"k": "v}', "filings") == (15, False) and p.string and p.depth == 3 and p.array
    assert segment(p, '"}', "filings") == (None, True) and p.depth == 2
    assert segment(p, ',{"x": {"y": 2}', "filings") == (1, False) and p.depth == 3
    assert segment(p, "}", "filings") == (None, True)
    assert segment(p, "]}", "filings") == (None, False) and p.depth == 0 and not p.array
