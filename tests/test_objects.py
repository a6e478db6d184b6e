"""The source of stored objects: contents, packing, pruning, damaged files, repeated writes."""

import gzip
import hashlib
import os
import pickle

import pytest
from pyspark.sql import functions as F

from pressroom.sources import objects

LARGE = b"0" * (5 << 20) + os.urandom(1000)
CONTENTS = {
    "raw/a/2024/01/01/one.html.gz": b"one", "raw/a/2024/01/01/+ %41 b.html.gz": "é".encode(), "raw/a/2024/01/02/empty.html.gz": b"", "raw/b/2024/01/01/large.html.gz": LARGE,
    "raw/b/2024/01/01/bytes.html.gz": b"\xff\x00", "meta/a/1.json": b"{}", "meta/a/2.json": b"",
}


@pytest.fixture(scope="module")
def root(tmp_path_factory):
    root = tmp_path_factory.mktemp("store")
    for key, body in CONTENTS.items():
        (root / key).parent.mkdir(parents=True, exist_ok=True)
        (root / key).write_bytes(gzip.compress(body) if key.endswith(".gz") else body)
    (root / "raw/a/2024/01/01/members.html.gz").write_bytes(gzip.compress(b"first,") + gzip.compress(b"second"))
    (root / "raw/a/2024/01/01/cut.html.gz").write_bytes(gzip.compress(os.urandom(5000))[:-20])
    (root / "raw/a/2024/01/01/plain.html.gz").write_bytes(b"no gzip at all")
    (root / "raw/a/2024/01/01/.half.html.gz").write_bytes(b"x")
    (root / "raw/a/2024/01/01/nothing.html.gz").write_bytes(b"")
    return str(root)


WANT = {k: (len(v), hashlib.sha256(v).hexdigest(), True) for k, v in CONTENTS.items()} | {
    "raw/a/2024/01/01/members.html.gz": (12, hashlib.sha256(b"first,second").hexdigest(), True),
    **{f"raw/a/2024/01/01/{n}.html.gz": (None, None, False) for n in ("cut", "plain", "nothing")},
}


def facts(df):
    return {r.key: (r.size_bytes, r.content_hash, r.readable) for r in df.collect()}


@pytest.mark.parametrize("reader, empty", [(objects.read_objects, True), (objects.hadoop_objects, False)])
def test_contents(spark, root, reader, empty):
    there = lambda k: empty or os.path.getsize(f"{root}/{k}")
    assert facts(reader(spark, root, "raw", ".html.gz")) == {k: v for k, v in WANT.items() if k.startswith("raw/") and there(k)}
    texts = {r.key: r.text for r in reader(spark, root, "meta", ".json", text=True).collect()}
    assert texts == {k: v.decode() for k, v in CONTENTS.items() if k.startswith("meta/") and there(k)}
    sizes = {r.key: r.stored_bytes for r in reader(spark, root, "raw", ".html.gz").collect()}
    assert all(os.path.getsize(f"{root}/{k}") == n for k, n in sizes.items())


def test_everything_and_nothing(spark, root, tmp_path):
    assert facts(objects.read_objects(spark, root)) == WANT
    assert objects.read_objects(spark, str(tmp_path / "missing")).count() == 0
    assert facts(objects.read_objects(spark, f"file://{root}", "raw/b")) == {k: v for k, v in WANT.items() if k.startswith("raw/b")}


def test_key_conditions_choose_what_is_opened(spark, root):
    every = objects.read_objects(spark, root, "raw", ".html.gz")
    day = every.where(F.startswith("key", F.lit("raw/a/2024/01/01/m")))
    assert list(facts(day)) == ["raw/a/2024/01/01/members.html.gz"]
    assert list(facts(every.where("key = 'raw/a/2024/01/02/empty.html.gz'"))) == ["raw/a/2024/01/02/empty.html.gz"]
    assert facts(every.where("key like 'meta/%'")) == {}
    reader = objects.ObjectReader({"path": root, "folder": "raw"})
    filters = [objects.StringStartsWith(("key",), "raw/a/2024/01/01/o"), objects.StringStartsWith(("other",), "x")]
    assert list(reader.pushFilters(filters)) == filters
    assert [f[1] for p in reader.partitions() for f in p.files] == ["raw/a/2024/01/01/one.html.gz"]


def test_small_objects_share_a_partition(root):
    reader = objects.ObjectReader({"path": root, "suffix": ".gz", "partition_bytes": "4000", "open_bytes": "1000"})
    parts = reader.partitions()
    files = [f for p in parts for f in p.files]
    assert [f[1] for f in files] == sorted(k for k in WANT if k.endswith(".gz"))
    assert 1 < len(parts) < len(files) and all(len(p.files) == 1 or sum(f[2] + 1000 for f in p.files) <= 4000 for p in parts)


def test_writing_twice(spark, tmp_path):
    root = str(tmp_path / "out")
    rows = [("d/a.html.gz", "é" * 10), ("d/b.html.gz", None), ("e/c d+%.json", "{}"), ("e/c d+%.json", "{}")]
    df = spark.createDataFrame(rows, "key string, body string").repartition(3)
    objects.write_objects(df, root)
    first = {p.name: p.read_bytes() for p in (tmp_path / "out").rglob("*") if p.is_file()}
    objects.write_objects(df, root)
    assert {p.name: p.read_bytes() for p in (tmp_path / "out").rglob("*") if p.is_file()} == first
    assert set(first) == {"a.html.gz", "b.html.gz", "c d+%.json"} and gzip.decompress(first["a.html.gz"]).decode() == "é" * 10
    assert facts(objects.read_objects(spark, root))["d/b.html.gz"] == (0, hashlib.sha256(b"").hexdigest(), True)
    objects.write_objects(df.withColumn("body", F.encode("body", "utf-16")), root)
    assert gzip.decompress((tmp_path / "out/d/a.html.gz").read_bytes()).decode("utf-16") == "é" * 10


def test_many_objects_are_not_named_by_the_driver(root, tmp_path, monkeypatch):
    for i in range(3000):
        path = tmp_path / f"many/{i % 2}/{i}.json"
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(b"{}" * (i % 7))
    (tmp_path / "many/1/.hidden").mkdir()
    (tmp_path / "many/1/.hidden/3.json").write_bytes(b"{}")
    options = {"path": str(tmp_path), "suffix": ".json", "partition_bytes": "50000", "open_bytes": "1000"}
    rows = lambda reader, parts: [row for p in parts for b in reader.read(p) for row in b.to_pylist()]
    reader = objects.ObjectReader(options)
    named = rows(reader, reader.partitions())
    for limits in ({}, {"PASSES": 4, "ENTRIES": 1}):
        for name, value in ({"LISTED": 100} | limits).items():
            monkeypatch.setattr(objects, name, value)
        parts = reader.partitions()
        assert not any(p.files for p in parts) and len(pickle.dumps(parts)) < 20_000
        assert sorted(rows(reader, parts), key=lambda r: r["key"]) == sorted(named, key=lambda r: r["key"])
        shares = [len(rows(reader, [p])) for p in parts]
        assert len(shares) <= 10 if limits else len(shares) > 50 and max(shares) <= 50
    # what folders and conditions leave out is left out here too
    day = objects.ObjectReader({"path": root})
    monkeypatch.setattr(objects, "LISTED", 0)
    assert sorted(r["key"] for r in rows(day, day.partitions())) == sorted(WANT)
    list(day.pushFilters([objects.StringStartsWith(("key",), "raw/a/2024/01/01/o")]))
    assert [r["key"] for r in rows(day, day.partitions())] == ["raw/a/2024/01/01/one.html.gz"]
