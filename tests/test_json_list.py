"""Lists cut into blocks against lists read whole."""

import json
import os
import random

import pytest

from tracewell.session import new_table_path
from tracewell.sources import items, json_list


def value(rng, depth=0):
    kind = rng.randrange(9 if depth < 4 else 5)
    if kind < 2:
        return rng.choice(["", "}", "]{\\", '"},{"', "é}\n", "\\\\", '\\"}', "}" * 5, ",[", "plain"])
    if kind < 5:
        return rng.choice([0, 1.5, None, True, -7, "x"])
    if kind < 7:
        return [value(rng, depth + 1) for _ in range(rng.randrange(4))]
    return {rng.choice(["a", "}", "b\\"]): value(rng, depth + 1) for _ in range(rng.randrange(4))}


def written(spark, texts):
    path = new_table_path(spark, "lists")
    os.makedirs(path)
    for i, text in enumerate(texts):
        with open(f"{path}/{i:03}.json", "w", encoding="utf-8") as f:
            f.write(text)
    return path


def loaded(text):
    try:
        got = json.loads(text)
    except ValueError:
        return []
    return got if isinstance(got, list) else []


def read(spark, path, block_bytes):
    rows = json_list.read_json_list(spark, path, block_bytes).selectExpr("file", "pos", "to_json(entry) AS entry").collect()
    out = {}
    for r in rows:
        out.setdefault(int(os.path.basename(r.file)[:3]), {})[r.pos] = json.loads(r.entry)
    return {i: [at[p] for p in sorted(at)] for i, at in out.items() if sorted(at) == list(range(len(at)))}


@pytest.mark.parametrize("block_bytes", [7, 64, 10**6])
def test_any_list_in_blocks_of_any_size(spark, block_bytes):
    rng = random.Random(block_bytes)
    texts = []
    for _ in range(12):
        entries = [value(rng, 1) if rng.random() < 0.3 else {"id": value(rng, 3), "n": value(rng, 2)} for _ in range(rng.randrange(12))]
        texts.append(json.dumps(entries, ensure_ascii=rng.random() < 0.5, indent=rng.choice([None, 1])) + rng.choice(["", "\n", " \n"]))
    broken = [t[: rng.randrange(len(t))] for t in texts[:5]] + ["", " ", "[]", "[ ]\n", "{}", '{"a":{"b":1}}', '[{"a":1}]}', '[{"a":1},]', '[,{"a":1}]', '[{"a":1}{"b":2}]', "[1,2", "7", '[{"a":"}]']
    broken += ['[{"a":1}],[{"b":2}]', '[{"a":1}] x', '[{"a":1}, 5, "}", []]', '{"a":1}]', "[{]}", '["a}", {"b":{}}]', '[{"a":1},\n]']
    every = texts + broken
    got = read(spark, written(spark, every), block_bytes)
    for i, text in enumerate(every):
        assert got.get(i, []) == loaded(text), text


def test_one_file_is_read_by_several_tasks(spark):
    entries = [{"id": f"i{i}", "data": {"n": i, "t": '}],{"' * (i % 3)}, "timestamp": i} for i in range(3000)]
    path = written(spark, [json.dumps(entries)])
    fragments = json_list._fragments(spark, path)
    with json_list._same_blocks(spark, 10_000):
        assert fragments.rdd.getNumPartitions() > 3
    got = items.read_spool(spark, path, "logs", split=True, block_bytes=10_000)
    whole = items.read_spool(spark, path, "logs")
    assert got.count() == 3000 and got.exceptAll(whole).count() == 0
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") != "10000"
    with pytest.raises(ValueError):
        items.read_spool(spark, path, "logs", stream=True, split=True)


def test_small_blocks_share_tasks(spark):
    """Blocks stay as small as asked for, but a task reads many of them."""
    lists = [[{"id": f"i{f}-{i}", "data": {"t": '}],{"' * (i % 3)}, "timestamp": i} for i in range(400)] for f in range(6)]
    path = written(spark, [json.dumps(x) for x in lists])
    fragments = json_list._fragments(spark, path)
    most = 4 * spark.sparkContext.defaultParallelism
    with json_list._same_blocks(spark, 300):
        blocks = fragments.select("file", "block").distinct().count()
        tasks = fragments.rdd.getNumPartitions()
    assert blocks > 4 * most and tasks <= 2 * most
    assert spark.conf.get("spark.sql.files.maxPartitionNum", None) is None
    assert read(spark, path, 300) == dict(enumerate(lists))
