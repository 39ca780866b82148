"""JSON arrays cut by splits: any layout, any split size, the same records."""

from __future__ import annotations

import json
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from loomstat.sources import json_arrays as J
from loomstat.sources import tables as S

SPLIT = "spark.sql.files.maxPartitionBytes"


@pytest.fixture
def small_splits(spark):
    before = {k: spark.conf.get(k) for k in (SPLIT, "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum") if spark.conf.get(k, None)}

    def set_to(size):
        spark.conf.set(SPLIT, str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")

    yield set_to
    for key in (SPLIT, "spark.sql.files.openCostInBytes"):
        spark.conf.unset(key)
    for key, value in before.items():
        spark.conf.set(key, value)


def records(n, seed=0):
    rnd = random.Random(seed)
    odd = ['"', "\\", '\\"', "}", "{", "[", "]", "},{", "\n", "ü}", "a, b", '\\\\"}', "😀"]
    out = []
    for i in range(n):
        title = "".join(rnd.choice(odd) for _ in range(rnd.randint(0, 12)))
        fos = [{"name": rnd.choice(odd), "w": str(i)} for _ in range(rnd.randint(0, 3))]
        out.append({"id": str(i), "title": title, "fos": fos, "references": [rnd.choice(odd) for _ in range(rnd.randint(0, 4))]})
    return out


LAYOUTS = {
    "lines": lambda r: "[\n" + ",\n".join(json.dumps(x, ensure_ascii=False) for x in r) + "\n]\n",
    "several on a line": lambda r: "[" + "".join(json.dumps(x) + (",\n" if i % 3 else ", ") for i, x in enumerate(r[:-1])) + json.dumps(r[-1]) + "]",
    "one line": lambda r: json.dumps(r, ensure_ascii=False),
    "pretty": lambda r: json.dumps(r, indent=2),
    "comma first": lambda r: "\ufeff [ " + "\r\n , ".join(json.dumps(x, indent=1) for x in r) + " ] \n\n",
}


@pytest.mark.parametrize("layout", LAYOUTS)
def test_one_file_by_many_tasks(spark, tmp_path, small_splits, layout):
    want = records(300, seed=len(layout))
    text = LAYOUTS[layout](want).encode()
    (tmp_path / "in.json").write_bytes(text)
    small_splits(2000)
    found = S.scan_json_array(spark, str(tmp_path / "in.json"), "id string, title string, fos array<struct<name: string, w: string>>, references array<string>")
    pieces = spark.read.option("lineSep", "}").text(str(tmp_path / "in.json"))
    assert pieces.rdd.getNumPartitions() >= len(text) // 2000  # a task for each block
    rows = sorted((r.asDict(recursive=True) for r in found.collect()), key=lambda r: int(r["id"]))
    assert rows == want


@pytest.mark.parametrize("size", [64, 1000])
def test_records_across_many_splits_and_files(spark, tmp_path, small_splits, size):
    want = records(40, seed=3)
    want[7]["title"] = "}x" * 3000
    want[8]["references"] = ["[{" * 50] * 40
    for i, part in enumerate((want[:20], want[20:39], want[39:], [])):
        (tmp_path / f"{i}.json").write_text(json.dumps(part, indent=i or None) + "\n" * (200 * i))
    small_splits(size)
    found = J.scan_records(spark, str(tmp_path))
    assert sorted((json.loads(r["record"]) for r in found.collect()), key=lambda r: int(r["id"])) == want


WRONG = {
    "not closed": '[{"id": "1"}, {"id": "2"}', "cut in a string": '[{"id": "1"}, {"id": "2', "no bracket": '{"id": "1"}',
    "closed twice": '[{"id": "1"}]]', "two arrays": '[{"id": "1"}], [{"id": "2"}]', "no comma": '[{"id": "1"} {"id": "2"}]',
    "two commas": '[{"id": "1"},, {"id": "2"}]', "a number": '[{"id": "1"}, 7]', "only blanks": "  \n", "numbers": "[1, 2]",
    "early": '[{"id": "1"}}, {"id": "2"}]', "comma at the end": '[{"id": "1"},]', "wrong bracket": '[{"id": ["1"}}]',
}


@pytest.mark.parametrize("name", WRONG)
@pytest.mark.parametrize("size", [1 << 20, 12])
def test_malformed_arrays_stop_the_job(spark, tmp_path, small_splits, name, size):
    (tmp_path / "in.json").write_text(WRONG[name])
    small_splits(size)
    with pytest.raises(Exception, match="(?i)malformed"):
        S.scan_json_array(spark, str(tmp_path / "in.json")).collect()


def test_arrays_without_records(spark, tmp_path, small_splits):
    (tmp_path / "a.json").write_text("[]")
    (tmp_path / "b.json").write_text(" [\n] \n")
    assert S.scan_json_array(spark, str(tmp_path)).count() == 0
    (tmp_path / "c.json").write_text('[{"id": "1"}]')
    assert S.scan_json_array(spark, str(tmp_path)).count() == 1


def test_compressed_array(spark, tmp_path):
    import gzip

    (tmp_path / "in.json.gz").write_bytes(gzip.compress(json.dumps(records(50), indent=1).encode()))
    assert J.scan_records(spark, str(tmp_path)).count() == 50


scalars = st.one_of(st.none(), st.booleans(), st.integers(), st.text(alphabet='"\\{}[],:\n aü', max_size=8))
values = st.recursive(scalars, lambda v: st.one_of(st.lists(v, max_size=3), st.dictionaries(st.text(alphabet='"\\{}]a', max_size=3), v, max_size=3)), max_leaves=6)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.dictionaries(st.text(max_size=3), values, max_size=3), max_size=6), st.sampled_from([None, 1]), st.randoms())
def test_any_array_at_any_cuts(data, indent, rnd):
    """The two passes on borders drawn at random, without Spark: pieces dealt to splits as its reader would."""
    import pyarrow as pa

    text = json.dumps(data, indent=indent, ensure_ascii=rnd.random() < 0.5).encode()
    pieces = text.split(b"}")
    if not pieces[-1]:
        pieces.pop()
    starts, at = [], 0
    for piece in pieces:
        if not starts or rnd.random() < 0.4:
            at += 1
        starts.append(at)

    def batches():
        for begin in range(0, len(pieces), 3):
            end = begin + 3
            yield pa.RecordBatch.from_arrays(
                [pa.array(["f"] * len(pieces[begin:end])), pa.array(starts[begin:end], pa.int64()), pa.array(pieces[begin:end], pa.binary())], names=["file", "start", "value"])

    splits, edges = J.combine([r for b in J._summaries(batches()) for r in b.to_pylist()])
    found = [r["record"] for b in J._cut(splits, True)(batches()) for r in b.to_pylist()]
    parts = {}
    for batch in J._cut(splits, False)(batches()):
        for row in batch.to_pylist():
            parts.setdefault((row["file"], row["owner"]), []).append(row)
    for (file, owner), rows in parts.items():
        key = (pa.scalar(file), pa.scalar(owner))
        found += J._joined(edges)(key, pa.Table.from_pylist(rows, schema=pa.schema([("at", pa.int64()), ("record", pa.binary())]))).column("record").to_pylist()
    assert sorted(map(str, map(json.loads, found))) == sorted(map(str, data))


def test_lines_are_compressed_and_read_again(spark, tmp_path):
    source, target = f"{tmp_path}/array", f"{tmp_path}/lines"
    rows = spark.createDataFrame([(str(i), f"title {i}\n") for i in range(20)], "id string, title string")
    S.write_json_array(rows, source)
    first = S.json_array_to_lines(spark, source, target, "id string, title string")
    assert [f.suffix for f in (tmp_path / "lines").glob("part-*")] and all(f.suffix == ".gz" for f in (tmp_path / "lines").glob("part-*"))
    again = S.json_array_to_lines(spark, source, target, "id string, title string")
    expected = [(str(i), f"title {i}\n") for i in range(20)]
    for found in (first, again):
        assert sorted((r["id"], r["title"]) for r in found.collect()) == sorted(expected)
