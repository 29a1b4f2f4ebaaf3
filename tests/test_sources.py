"""Push-down into the paged source, the response cache and the writer of named files."""

import json
import os
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from cairnflow.sources import files
from cairnflow.sources.cache import ResponseCache
from cairnflow.sources.locations import PagedSource

ASKED = "key string, origin string, destination string"


def fetch(building, take, skip):
    folder = Path(os.environ["PAGED_LOG"])
    (folder / f"{building}-{skip}-{time.monotonic_ns()}").touch()
    return json.dumps([{"id": f"{building}-{skip + i}"} for i in range(max(0, min(take, 3 - skip)))])


def test_filters_on_buildings_reach_the_reader(spark, tmp_path, monkeypatch):
    key = "spark.sql.python.filterPushdown.enabled"
    spark.dataSource.register(PagedSource)
    spark.sparkContext.addPyFile(__file__)
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:

        def asked(name, *conditions):
            log = tmp_path / name
            log.mkdir()
            source = f"import os; os.environ['PAGED_LOG'] = {str(log)!r}; from test_sources import fetch"
            module = tmp_path / f"logged_{name}.py"
            module.write_text(source)
            spark.sparkContext.addPyFile(str(module))
            df = spark.read.format("paged").options(fetch=f"logged_{name}:fetch", buildings="b1,b2,b3,b4", take="2", pushdown="true").load()
            for c in conditions:
                df = df.where(c)
            rows = sorted((r.building, r.skip) for r in df.collect())
            return rows, sorted(f.name.rsplit("-", 1)[0] for f in log.iterdir())

        pages = lambda *b: ([(x, s) for x in b for s in (0, 2)], [f"{x}-{s}" for x in b for s in (0, 2)])
        assert asked("all") == pages("b1", "b2", "b3", "b4")
        assert asked("one", F.col("building") == "b3") == pages("b3")
        assert asked("some", F.col("building").isin("b1", "b4", "zz")) == pages("b1", "b4")
        assert asked("none", F.col("building") == "zz") == ([], [])
        rows, requests = asked("rest", F.col("building").isin("b1", "b2"), F.col("skip") > 0)
        assert rows == [("b1", 2), ("b2", 2)] and requests == ["b1-0", "b1-2", "b2-0", "b2-2"]  # skip is not pushed down, Spark filters it
    finally:
        spark.conf.set(key, before)


def client_for(folder, answers):
    def client(origin, destination):
        (Path(folder) / f"{origin}-{time.monotonic_ns()}").touch()
        if destination == "down":
            raise ConnectionError("no line")
        return answers.get(destination, json.dumps({"status": "OK", "to": destination}))

    return client


@pytest.mark.parametrize("keep", ["all", "ok"])
def test_cache_keeps_what_the_policy_says_and_asks_again_for_corrupt_bodies(spark, tmp_path, keep):
    log = tmp_path / "log"
    log.mkdir()
    calls = lambda: sorted(f.name.split("-")[0] for f in log.iterdir())
    asked = spark.createDataFrame([("k1", "a", "x"), ("k2", "b", "down"), ("k3", "c", "bad"), ("k4", "d", "no"), ("k1", "a", "x"), (None, "n", "x")], ASKED)
    answers = {"bad": "{cut off", "no": json.dumps({"status": "ZERO"})}
    cache = ResponseCache(spark, str(tmp_path / "cache"))
    assert cache.read().count() == 0
    got = {r.key: r.body for r in cache.fill(asked, client_for(log, answers), keep, workers=2).collect()}
    assert sorted(got) == ["k1", "k2", "k3", "k4"] and "request_failed" in got["k2"] and got["k3"] == "{cut off"
    assert calls() == ["a", "b", "c", "d"]
    assert sorted(r.key for r in cache.read().collect()) == (["k1", "k2", "k3", "k4"] if keep == "all" else ["k1"])
    got = {r.key: r.body for r in cache.fill(asked, client_for(log, {}), keep, workers=2).collect()}
    assert json.loads(got["k3"])["to"] == "bad"  # the corrupt body is mended
    assert calls() == (["a", "b", "c", "c", "d"] if keep == "all" else ["a", "b", "b", "c", "c", "d", "d"])
    held = sorted(tuple(r) for r in cache.read().collect())
    cache.compact()
    cache.vacuum()
    assert len(os.listdir(tmp_path / "cache" / "versions")) == 1 and sorted(tuple(r) for r in cache.read().collect()) == held
    assert sorted(r.key for r in ResponseCache(spark, str(tmp_path / "cache")).read().collect()) == [k for k, _ in held]


def test_cache_shares_its_rate_out_and_refuses_a_second_writer(spark, tmp_path):
    (tmp_path / "log").mkdir()
    asked = spark.createDataFrame([(f"k{i}", str(i), "x") for i in range(12)], ASKED)
    cache = ResponseCache(spark, str(tmp_path / "cache"))
    cache.fill(asked, client_for(tmp_path / "log", {}), per_second=8.0, workers=2).count()
    starts = sorted(int(f.name.split("-")[1]) for f in (tmp_path / "log").iterdir())
    assert len(starts) == 12 and (starts[-1] - starts[0]) / 1e9 >= (12 / 2 - 2) * 2 / 8.0 * 0.9
    before, live = cache._current()
    cache._swap(before, live)
    with pytest.raises(RuntimeError):
        cache._swap(before, live)
    with pytest.raises(ValueError):
        cache.fill(asked, client_for(tmp_path / "log", {}), keep="some")


def listed(folder):
    return sorted(str(f.relative_to(folder)) for f in Path(folder).rglob("*") if f.is_file() and not any(p.startswith((".", "_")) for p in f.relative_to(folder).parts))


def test_named_files_replace_the_old_ones_only_when_all_are_written(spark, tmp_path):
    out = str(tmp_path / "out")
    rows = lambda *names: spark.createDataFrame([(n, n.encode()) for n in names], "filename string, content binary").repartition(3)
    files.write_files(rows("a.glb", "b.glb", "floors/1.glb"), out)
    assert listed(out) == ["a.glb", "b.glb", "floors/1.glb"] == json.loads((tmp_path / "out" / files.LISTING).read_text())
    files.write_files(rows("b.glb", "c.glb"), out)  # stale names go
    assert listed(out) == ["b.glb", "c.glb"] and (tmp_path / "out" / "c.glb").read_bytes() == b"c.glb"
    files.write_files(rows("d.glb"), out, overwrite=False)
    assert listed(out) == ["b.glb", "c.glb", "d.glb"] == json.loads((tmp_path / "out" / files.LISTING).read_text())
    for bad in (rows("e.glb", "../f.glb"), rows("g.glb", ""), rows("h.glb", "_x"), spark.createDataFrame([("i", b"1"), ("i", b"2")], "filename string, content binary")):
        with pytest.raises(Exception):  # noqa: B017, Spark wraps the error of a task
            files.write_files(bad, out)
        assert listed(out) == ["b.glb", "c.glb", "d.glb"]
    files.write_files(spark.createDataFrame([], "filename string, content binary"), out)
    assert listed(out) == [] and not [f for f in os.listdir(out) if f.startswith("_staged")]
