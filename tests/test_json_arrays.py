"""JSON arrays read by byte ranges: the same elements and numbers for any block size."""

import json
import random

import pytest

from skein.sources.json_arrays import read_elements
from skein.sources.readers import read_json_array, read_network, read_ragged_json


@pytest.fixture()
def block_size(spark):
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    yield lambda n: spark.conf.set(key, str(n))
    spark.conf.set(key, before)


def _value(rnd, depth=0):
    kind = rnd.randrange(8 if depth < 3 else 5)
    if kind < 3:
        return "".join(rnd.choice('ab{}[],:"\\\n é日') for _ in range(rnd.randrange(0, 25)))
    if kind < 5:
        return rnd.choice([None, True, -1.5, 12])
    if kind == 5:
        return [_value(rnd, depth + 1) for _ in range(rnd.randrange(0, 4))]
    return {f"k{i}{rnd.choice('{,')}": _value(rnd, depth + 1) for i in range(rnd.randrange(0, 4))}


def test_elements_for_any_block_size(spark, tmp_dir, block_size):
    rnd = random.Random(6)
    files = {f"f{i}.json": [_value(rnd) for _ in range(rnd.randrange(0, 60))] for i in range(6)}
    files["one.json"] = [{"a": "x" * 3000 + "}]," * 50}, [], {}, "s"]  # longer than several blocks
    files["empty.json"] = []
    for k, (name, value) in enumerate(files.items()):
        with open(f"{tmp_dir}/{name}", "w", encoding="utf-8-sig" if k == 1 else "utf-8") as f:
            f.write(json.dumps(value, indent=k % 3 or None, ensure_ascii=k % 2 == 0) + "\n" * (k % 2))
    open(f"{tmp_dir}/blank.json", "w").write(" \n")
    open(f"{tmp_dir}/object.json", "w").write('{"a": [1, 2], "b": {"c": ","}}\n')
    files["object.json"] = [{"a": [1, 2], "b": {"c": ","}}]
    want = sorted((name, pos, json.dumps(v)) for name, value in files.items() for pos, v in enumerate(value))
    for size in (64, 700, 1 << 27):
        block_size(size)
        df = read_elements(spark, tmp_dir)
        got = sorted((r["file"].rsplit("/", 1)[1], r["pos"], json.dumps(json.loads(r["text"]))) for r in df.collect())
        assert got == want, size


def test_one_large_file_is_read_by_several_tasks(spark, tmp_dir, block_size):
    rows = [{"user_id": str(i), "name": "n" * (i % 50)} for i in range(3000)]
    with open(f"{tmp_dir}/big.json", "w") as f:
        json.dump(rows, f)
    block_size(8192)
    pieces = spark.read.option("lineSep", "}").text(f"{tmp_dir}/big.json")
    assert pieces.rdd.getNumPartitions() > 5
    got = read_json_array(spark, f"{tmp_dir}/big.json", "user_id STRING, name STRING").collect()
    assert sorted((r["user_id"], r["name"]) for r in got) == sorted((r["user_id"], r["name"]) for r in rows)


def test_readers_keep_landing_order(spark, tmp_dir, block_size):
    ragged = [{"user_id": "1"}, [{"user_id": "2"}, "junk", {"user_id": "3"}], "junk", [], 7, {"user_id": "4"}]
    with open(f"{tmp_dir}/r.json", "w") as f:
        json.dump(ragged, f)
    roots = [{"user_id": f"r{i}", "tweets": [], "followers": [{"user_id": "f"}]} for i in range(40)]
    with open(f"{tmp_dir}/net.json", "w") as f:
        json.dump(roots, f)
    for size in (32, 1 << 27):
        block_size(size)
        got = read_ragged_json(spark, f"{tmp_dir}/r.json", "user_id STRING").orderBy("pos", "sub").collect()
        assert [(r["user_id"], r["pos"], r["sub"]) for r in got] == [("1", 0, 0), ("2", 1, 0), ("3", 1, 2), ("4", 5, 0)]
        net = read_network(spark, f"{tmp_dir}/net.json").orderBy("file", "pos").collect()
        assert [r["user_id"] for r in net] == [f"r{i}" for i in range(40)]
