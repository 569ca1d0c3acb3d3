"""JSON files read in parts, next to Python's own parser."""

from __future__ import annotations

import gzip
import json
import os
import random
import uuid

import pytest

from tallyloom.sources.files import json_spec, read_json, read_json_auto
from tallyloom.sources.json_split import split_values


@pytest.fixture
def folder(scratch):
    path = f"{scratch}/{uuid.uuid4().hex}"
    os.makedirs(path)
    return path


@pytest.fixture
def small_parts(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(name) for name in names]
    spark.conf.set(names[0], "100")
    spark.conf.set(names[1], "0")
    yield
    for name, value in zip(names, before, strict=True):
        spark.conf.set(name, value)


def made(draw, depth=0):
    pick = draw.randrange(7 if depth < 3 else 4)
    if pick < 2:
        return "".join(draw.choice('ab{}[]",:\\é\n 😀/') for _ in range(draw.randrange(12)))
    if pick < 4:
        return draw.choice([None, True, 1, -2.5, 1e30])
    if pick == 4:
        return [made(draw, depth + 1) for _ in range(draw.randrange(4))]
    return {draw.choice('k{"\\}') + str(i): made(draw, depth + 1) for i in range(draw.randrange(4))}


@pytest.mark.parametrize("indent", [None, 1])
def test_any_objects_over_many_parts(spark, folder, small_parts, indent):
    draw = random.Random(17)
    want = []
    for n in range(6):
        objects = [{"n": i, "v": made(draw), "w": made(draw)} for i in range([0, 1, 2, 9, 30, 1][n])]
        single = n == 5
        text = json.dumps(objects[0] if single else objects, indent=indent, ensure_ascii=draw.random() < 0.5)
        with open(f"{folder}/{n}.json", "w") as out:
            out.write(("\n" if n % 2 else "") + text + ("\n" if n % 3 else ""))
        want += objects
    assert spark.read.text(folder).rdd.getNumPartitions() > 20
    found = [json.loads(r.value) for r in split_values(spark, folder).collect()]
    assert sorted(map(json.dumps, found)) == sorted(map(json.dumps, want))


def test_one_object_over_many_parts(spark, folder, small_parts):
    objects = [{"n": 1, "v": ["x{}" * 300]}, {"n": 2, "v": [{"a": i} for i in range(200)]}, {"n": 3}]
    with open(f"{folder}/a.json", "w") as out:
        json.dump(objects, out, indent=2)
    found = [json.loads(r.value) for r in split_values(spark, folder).collect()]
    assert sorted(map(json.dumps, found)) == sorted(map(json.dumps, objects))
    rows = read_json(spark, folder, "n bigint, v array<string>", "array").collect()
    assert sorted(r.n for r in rows) == [1, 2, 3] and all(r._metadata.file_name == "a.json" for r in rows)


@pytest.mark.parametrize(
    "text",
    ['[{"n": 1}, 2]', '[{"n": 1}', '{"n": 1', '[{"n": "1}]', '{"n": 1}\n{"n": 2}', '[{"n": 1}]\n[{"n": 2}]', '{"n": 1}}', '[[{"n": 1}]]', 'x {"n": 1}'],
)
def test_what_is_not_one_value_stops(spark, folder, text):
    with open(f"{folder}/a.json", "w") as out:
        out.write(text)
    with pytest.raises(Exception, match="JSON value|other than objects"):
        read_json(spark, folder, "n bigint", "array").collect()


def test_compressed_and_plain_files(spark, folder):
    with gzip.open(f"{folder}/a.json.gz", "wt") as out:
        json.dump([{"n": 1}, {"n": 2}], out, indent=1)
    with open(f"{folder}/b.json", "w") as out:
        json.dump([{"n": 3}], out, indent=1)
    for form in ("array", "auto"):
        assert sorted(r.n for r in read_json(spark, folder, "n bigint", form).collect()) == [1, 2, 3]


def test_a_spec_from_the_objects_themselves(spark, folder):
    with open(f"{folder}/a.json", "w") as out:
        out.write('{"n": 1, "x": 2, "none": null, "mix": 1, "a b": {"c,d": [{"OBJECT": true}]}, "e": []}\n')
        out.write('{"n": 9000000000, "x": 2.5, "mix": "t", "late": "y", "a b": {"c,d": []}}\n')
    with open(f"{folder}/b.json", "w") as out:
        json.dump([{"n": 3, "x": 1e3}], out, indent=1)
    kinds = {f.name: f.dataType.simpleString() for f in json_spec(spark, folder)}
    assert kinds == {
        "n": "bigint", "x": "double", "none": "string", "mix": "string", "late": "string", "e": "array<string>",
        "a b": "struct<c,d:array<struct<OBJECT:boolean>>>",
    }
    assert sorted((r.n, r.x) for r in read_json_auto(spark, folder).collect()) == [(1, 2.0), (3, 1000.0), (9000000000, 2.5)]
    with open(f"{folder}/c.json", "w") as out:
        out.write("[1, 2]\n")
    with pytest.raises(ValueError, match="JSON objects"):
        json_spec(spark, f"{folder}/c.json")
