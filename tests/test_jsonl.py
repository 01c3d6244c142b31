import gzip
import json
import random

import pytest

from textloom.sources import jsonl

BROKEN = ["{", "[1]", "3", '"x"', "null", "{'a': 1}", "é" * 150 + "{", "日本" * 80, "{broken", '{"a": 1} x']


def sequential(path):
    """What a reader of one file after another reports: (line_no, preview)."""
    out = []
    data = gzip.decompress(path.read_bytes()) if path.suffix == ".gz" else path.read_bytes()
    for no, line in enumerate(data.splitlines(), 1):
        if line.strip():
            try:
                assert isinstance(json.loads(line), dict)
            except (ValueError, AssertionError):
                out.append((no, line[:200].decode("utf-8", errors="replace")))
    return out


def write(path, seed, n, end):
    rng = random.Random(seed)
    lines = [rng.choice(['{"a": %d}' % i, '{"a": %d, "b": "%s"}' % (i, "w" * rng.randrange(300)), "", "  ", "\t", rng.choice(BROKEN)]) for i in range(n)]
    data = end.join(lines).encode()
    path.write_bytes(gzip.compress(data) if path.suffix == ".gz" else data)
    return data


@pytest.mark.parametrize("size", ["700", "5000", "128m"])
def test_line_numbers_as_a_sequential_reader(spark, tmp_path, size):
    files = {name: write(tmp_path / name, i, n, end) for i, (name, n, end) in enumerate([("a.jsonl", 400, "\n"), ("b.jsonl", 300, "\r\n"), ("c.jsonl", 1, "\n"), ("d.jsonl.gz", 200, "\n"), ("e.jsonl", 0, "\n")])}
    was = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.openCostInBytes", "0" if size != "128m" else "4m")
    try:
        good, bad = jsonl.read_jsonl(spark, f"file://{tmp_path}", "a int, b string", strict=False)
        lines, splits = jsonl.numbered_lines(spark, f"file://{tmp_path}")
        got = sorted((r.path.rsplit("/", 1)[1], r.line_no, r.line_preview) for r in bad.collect())
        assert got == sorted((name, no, p) for name in files for no, p in sequential(tmp_path / name))
        every = {(r.path.rsplit("/", 1)[1], r.line_no): r.value for r in jsonl.placed(lines, splits).collect()}
        assert every == {(name, no): t.decode() for name in files for no, t in enumerate(files[name].splitlines(), 1)}
        assert splits.count() > (30 if size == "700" else 3)
        assert good.count() == sum(1 for d in files.values() for t in d.splitlines() if t.strip()) - len(got)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", was)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_is_object(spark):
    good = ['{}', ' {"a": [1, {"b": "]}"}]} ', '{"a": "x]"}', "\t{\"a\": 1}\r"]
    bad = ['{"a": 1} x', '{"a": 1}, {"b": 2}', '{"a": 1}, null', '{"a": 1}] , [2', '{"a": 1}}, {"b": {}', "[{}]", "{", "1", "null", '"{}"', "", '{"a": 1,}', None]
    df = spark.createDataFrame([(t,) for t in good + bad], "t string").select("t", jsonl.is_object("t").alias("ok"))
    assert {r.t: r.ok for r in df.collect()} == {**dict.fromkeys(good, True), **dict.fromkeys(bad, False)}


def test_strict_and_no_lines(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text('{"a": 1}\n\n{"a"\n')
    with pytest.raises(Exception, match="not a JSON object"):
        jsonl.read_jsonl(spark, f"file://{tmp_path}", "a int")[0].collect()
    (tmp_path / "x.jsonl").write_text("\n \n")
    good, bad = jsonl.read_jsonl(spark, f"file://{tmp_path}", "a int", strict=False)
    assert good.count() == 0 and bad.count() == 0 and bad.columns == ["path", "line_no", "error", "line_preview"]
