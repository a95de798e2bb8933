"""Collectors that stop and go on, counters over runs, progress rows, and transfers that are taken up again."""

from __future__ import annotations

import json
import time
from types import SimpleNamespace

import pandas as pd
from pyspark.sql import functions as F

from tests.conftest import DATA
from textmill.sources import transfer
from textmill.streaming import collectors, streams


def test_collector_goes_on_where_it_was(spark, tmp_path):
    pages = spark.read.parquet(f"{DATA}/pages.parquet")
    folder, out, checkpoint = str(tmp_path / "pages"), str(tmp_path / "out"), str(tmp_path / "checkpoint")
    total = pages.count()
    parts = [pages.where(f"page_id % 3 = {i}") for i in range(3)]
    for i, part in enumerate(parts):
        part.coalesce(1).write.mode("append").parquet(folder)
        query = collectors.collect(collectors.articles(collectors.pages(spark, folder, 7)), out, checkpoint)
        assert query.exception() is None
        got = [r["page_id"] for r in spark.read.json(out).select("page_id").collect()]
        assert sorted(got) == sorted(r["page_id"] for r in pages.where(f"page_id % 3 <= {i}").select("page_id").collect())
    collectors.collect(collectors.articles(collectors.pages(spark, folder, 7)), out, checkpoint)  # nothing new
    rows = spark.read.json(out)
    assert rows.count() == total and rows.select("cycle").distinct().count() == 3
    want = {r["page_id"]: r["category"] for r in collectors.articles(pages).select("page_id", "category").collect()}
    assert {r["page_id"]: r["category"] for r in rows.select("page_id", "category").collect()} == want


def test_articles(spark):
    html = "<html><title> T </title><style>a{}</style><body><nav>menu</nav><p>One <b>two</b></p><script>x</script>"
    rows = collectors.articles(spark.createDataFrame([(1, "https://h.org/EN/5?x", html), (2, "https://h.org", None), (3, None, "t")], collectors.PAGE)).orderBy("page_id").collect()
    assert [(r["title"], r["content"], r["category"]) for r in rows] == [(" T ", "T One two", "en"), ("", "", "other"), ("", "t", "other")]
    assert collectors.articles(spark.createDataFrame([(1, "u", "short")], collectors.PAGE), 10).count() == 0


def test_counters_add_up_over_runs(spark, tmp_path):
    landing, checkpoint, seen = tmp_path / "landing", str(tmp_path / "checkpoint"), []
    landing.mkdir()
    listener = collectors.ProgressRows(spark, str(tmp_path / "progress"))
    spark.streams.addListener(listener)
    try:
        for run in range(2):
            lines = [{"s": "wiki" if i % 2 else "posts", "n": i, "bad": i == 3} for i in range(4 + run)]
            (landing / f"{run}.json").write_text("\n".join(map(json.dumps, lines)))
            stream = streams.landing(spark, str(landing), "s string, n long, bad boolean")
            counts = collectors.cycle_counters(stream, F.col("s"), F.col("n"), F.col("bad"))
            streams.run_once(counts, checkpoint, lambda df, i: seen.append({r["source"]: tuple(r)[1:] for r in df.collect()}), "update")
    finally:
        for _ in range(100):
            if len(list((tmp_path / "progress").glob("*.json"))) >= 2:
                break
            time.sleep(0.1)
        spark.streams.removeListener(listener)
    totals = {}
    for batch in seen:
        totals |= batch
    assert totals == {"posts": (5, 8, 0, 2, False), "wiki": (4, 8, 2, 2, False)}
    row = collectors.dashboard(spark, str(tmp_path / "progress")).agg(F.sum("triggers").alias("t"), F.sum("input_rows").alias("n")).first()
    assert row["t"] >= 2 and row["n"] == 9


def test_idle_sources_are_reported():
    class State(SimpleNamespace):
        def update(self, value):
            self.get, self.exists = value, True

        def setTimeoutDuration(self, ms):
            self.timeout = ms

    state = State(exists=False, hasTimedOut=False, get=None)
    batch = pd.DataFrame({"source": ["a", "a"], "size": [1, 2], "error": [False, True]})
    assert next(collectors.count_cycle(900)(("a",), iter([batch]), state)).iloc[0].tolist() == ["a", 2, 3, 1, 1, False] and state.timeout == 900_000
    state.hasTimedOut = True
    assert next(collectors.count_cycle(900)(("a",), iter([]), state)).iloc[0].tolist() == ["a", 2, 3, 1, 1, True] and state.get == (2, 3, 1, 1)


def test_transfer_copies_only_what_is_damaged(spark, tmp_path):
    source, target = tmp_path / "source", tmp_path / "target"
    (source / "sub").mkdir(parents=True)
    content = {f"sub/f{i}.npz" if i % 2 else f"f{i}.npz": bytes([i]) * (1000 + i) for i in range(6)}
    for name, data in content.items():
        (source / name).write_bytes(data)
    files = transfer.manifest(spark, str(source), "*.npz").cache()
    assert {r["name"]: r["size"] for r in files.collect()} == {n: len(d) for n, d in content.items()}
    act = lambda: {r["name"]: (r["action"], r["reason"]) for r in transfer.transfer(files, str(source), str(target)).collect()}
    assert set(act().values()) == {("copied", "missing")}
    (target / "f0.npz").write_bytes(b"\1" * 1000)  # damaged
    (target / "sub/f1.npz").write_bytes(content["sub/f1.npz"][:10])  # half-written
    stamps = {n: (target / n).stat().st_mtime_ns for n in content}
    found = act()
    assert found["f0.npz"] == ("copied", "checksum") and found["sub/f1.npz"] == ("copied", "size")
    assert all(found[n] == ("kept", "") and (target / n).stat().st_mtime_ns == stamps[n] for n in content if n not in ("f0.npz", "sub/f1.npz"))
    assert all((target / n).read_bytes() == d for n, d in content.items()) and not list(target.rglob(".*"))
    (source / "f2.npz").write_bytes(b"changed")
    (target / "f2.npz").unlink()
    assert act()["f2.npz"][0] == "failed" and not (target / "f2.npz").exists()
