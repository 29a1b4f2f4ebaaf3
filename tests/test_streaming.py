from cairnflow.streaming import sessions


def run(spark, df, name, mode="append"):
    q = df.writeStream.outputMode(mode).format("memory").queryName(name).trigger(availableNow=True).start()
    assert q.awaitTermination(60)
    return spark.table(name).collect()


def test_windows_and_islands(spark, tmp_path):
    rows = [(1, f"2024-01-01 0{h}:{m:02d}:00", t) for h, m, t in ((0, 0, "a"), (0, 5, "a"), (0, 10, "b"), (2, 0, "b"), (5, 0, "a"))]
    src = spark.createDataFrame(rows, "user_id long, ts string, event_type string").selectExpr("user_id", "cast(ts as timestamp) ts", "event_type")
    src.coalesce(1).write.parquet(str(tmp_path / "e"))
    stream = spark.readStream.schema(src.schema).parquet(str(tmp_path / "e"))
    got = sorted(r.n for r in run(spark, sessions.session_counts(stream, "user_id", "ts"), "s"))
    assert got == [1, 3]  # the last session is still open
    got = sorted((r.event_type, r.n) for r in run(spark, sessions.window_counts(stream, "ts", "event_type"), "w"))
    assert got == [("a", 2), ("b", 1), ("b", 1)]
    got = [(r.island, r.event_type, r.n) for r in run(spark, sessions.running_islands(stream, "user_id", "ts", "event_type"), "i")]
    assert got == [(1, "a", 2), (2, "b", 2)]
