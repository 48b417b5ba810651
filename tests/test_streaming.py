"""Late deliveries across batches and runs."""

from pyspark.sql import functions as F, types as T

from jobloom.streaming import incremental, redelivery

ROW = T.StructType([
    T.StructField("job_uid", T.StringType()), T.StructField("source", T.StringType()), T.StructField("work_model", T.StringType()),
    T.StructField("salary_min", T.DoubleType()), T.StructField("city", T.StringType()), T.StructField("delivery", T.LongType()),
])


def test_a_late_delivery_never_replaces_a_newer_one(spark, tmp_path):
    store, landing, state = (str(tmp_path / n) for n in ("store", "landing", "state"))
    stored = spark.createDataFrame([("old", "s", "", 1.0, "x")], "job_uid string, source string, work_model string, salary_min double, city string")
    stored = stored.withColumns({"first_seen_date": F.lit("2024-01-01"), "last_seen_date": F.lit("2024-01-01")})
    incremental.write_bucketed(stored, store, buckets=2)

    def run(day, *rows, keep_days=120.0):
        frame = spark.createDataFrame([(k, "s", "remote", float(n or 0), "x", n) for k, n in rows], ROW)
        frame.coalesce(1).write.mode("append").parquet(landing)
        redelivery.redelivered_upsert(spark, landing, ROW, store, state, F.lit(day), ["delivery"], buckets=2, keep_days=keep_days)
        return {r["job_uid"]: (r["salary_min"], r["last_seen_date"]) for r in incremental.read_bucketed(spark, store).collect()}

    assert run("2024-02-01", ("a", 2), ("a", 3), ("b", 5), ("a", 1)) == {"old": (1.0, "2024-01-01"), "a": (3.0, "2024-02-01"), "b": (5.0, "2024-02-01")}
    # a new run from the checkpoint: late, equal and newer deliveries
    got = run("2024-02-02", ("a", 2), ("b", 5), ("c", None))
    assert got["a"] == (3.0, "2024-02-01") and got["b"] == (5.0, "2024-02-01")
    got = run("2024-02-03", ("a", 4), ("b", 4), ("c", 1))
    assert got["a"] == (4.0, "2024-02-03") and got["b"] == (5.0, "2024-02-01") and got["c"] == (1.0, "2024-02-03")


def test_deliveries_meet_what_is_known_in_one_join(spark):
    """No key costs a call of its own; null keys are one key; what nothing was delivered for in time is forgotten."""
    batch = spark.createDataFrame([("a", 1.0, 2), ("a", 2.0, 3), (None, 3.0, 1), ("c", 4.0, None), ("d", 5.0, 1)], "k string, v double, n long")
    known = spark.sql("""SELECT * FROM VALUES ('a', named_struct('o0', 3L), current_timestamp()), (NULL, named_struct('o0', 0L), current_timestamp()),
        ('b', named_struct('o0', 9L), current_timestamp()), ('d', named_struct('o0', 7L), current_timestamp() - INTERVAL 9 DAYS),
        ('e', named_struct('o0', 1L), current_timestamp() - INTERVAL 9 DAYS) AS t (_key, _order, _seen)""")
    newest, state = redelivery.latest_deliveries(batch, known, "k", ["n"], keep_days=8)
    assert sorted(map(tuple, newest.collect()), key=str) == [("c", 4.0, None), ("d", 5.0, 1), (None, 3.0, 1)]
    assert {r["_key"]: r["_order"]["o0"] for r in state.collect()} == {"a": 3, None: 1, "b": 9, "c": None, "d": 1}
    first, left = redelivery.latest_deliveries(batch, None, "k", ["n"])
    assert sorted((r["k"] or "", r["v"]) for r in first.collect()) == [("", 3.0), ("a", 2.0), ("c", 4.0), ("d", 5.0)] and left.count() == 4
