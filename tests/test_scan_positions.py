import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from cdclake.functions.positions import commit_date, lsn_str, lsn_value, unset_time
from cdclake.operators.scan import Running, ordered_scan

UTC = dt.timezone.utc


def brute(rows, how):
    """Expected running values of one key's (order, value) rows, in order."""
    values = [v for _, v in sorted(rows)]
    out = []
    for i, v in enumerate(values):
        seen = [x for x in values[: i + 1] if x is not None]
        ahead = [x for x in values[i:] if x is not None]
        out.append(
            {
                "last": seen[-1] if seen else None,
                "next": ahead[0] if ahead else None,
                "lag": values[i - 1] if i else None,
                "max": max(seen) if seen else None,
                "sum": sum(seen) if seen else None,
            }[how]
        )
    return out


@pytest.mark.parametrize("seed", range(4))
def test_scans_match_a_single_pass(spark, seed):
    rng = random.Random(seed)
    rows = []
    for key in "abc":
        orders = rng.sample(range(400), 60)
        rows += [(key, o, rng.choice([None, rng.randint(-50, 50)])) for o in orders]
    df = spark.createDataFrame(rows, "k string, o bigint, v bigint").repartition(3)
    hows = ["last", "next", "lag", "max", "sum"]
    got = ordered_scan(df, ["k"], "o", {h: Running(h, F.col("v")) for h in hows}, chunk_bits=rng.choice([1, 3, 6, 12]))
    collected = got.orderBy("k", "o").collect()
    for key in "abc":
        mine = [(o, v) for k, o, v in rows if k == key]
        for how in hows:
            assert [r[how] for r in collected if r.k == key] == brute(mine, how), how


def test_unknown_scan(spark):
    with pytest.raises(ValueError, match="unknown scan"):
        ordered_scan(spark.range(3), ["id"], "id", {"x": Running("mean", F.col("id"))})


@pytest.mark.parametrize("zone", ["UTC", "Asia/Kolkata", "America/Los_Angeles"])
def test_day_is_utc_in_every_session_zone(spark, zone):
    late = dt.datetime(2026, 5, 9, 23, 59, 59, tzinfo=UTC)
    rows = [(late, late + dt.timedelta(seconds=5)), (None, late + dt.timedelta(seconds=5)), (late, None)]
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame(rows, "c timestamp, t timestamp")
        days = [str(r[0]) for r in df.select(commit_date(F.col("c"), F.col("t"))).collect()]
        assert days == ["2026-05-09", "2026-05-10", "2026-05-09"]
        unset = df.select(commit_date(unset_time(), F.col("t"))).first()[0]
        assert str(unset) == "2026-05-10"
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_day_edges(spark):
    micros = [0, -1, 86_399_999_999, 86_400_000_000, -86_400_000_000, 253_402_300_799_999_999]
    df = spark.createDataFrame([(m,) for m in micros], "m bigint").select(F.timestamp_micros("m").alias("t"))
    got = [r[0].toordinal() - dt.date(1970, 1, 1).toordinal() for r in df.select(commit_date(F.col("t"), F.col("t"))).collect()]
    assert got == [m // 86_400_000_000 for m in micros]


def test_position_text_both_ways(spark):
    values = [0, 1, 0x1000000, 0xFFFFFFFF, 0x100000000, 0x16B3748000, 2**63 - 1, -1, -(2**63)]
    df = spark.createDataFrame([(v,) for v in values], "lsn bigint")
    rows = df.select("lsn", lsn_str(F.col("lsn")).alias("t")).withColumn("back", lsn_value(F.col("t"))).collect()
    for r in rows:
        unsigned = r.lsn % 2**64
        assert r.t == f"{unsigned >> 32:X}/{unsigned & 0xFFFFFFFF:X}"
        assert r.back == r.lsn


def test_scratch_is_cleared(spark, monkeypatch):
    from cdclake import session
    from cdclake.session import clear_scratch, materialized, scratch_dir
    from cdclake.sources.files import exists

    monkeypatch.setattr(session, "_NAMED", [])  # not what other tests go on using
    kept = materialized(spark.range(3), "numbers")
    folder = scratch_dir(spark, "numbers").rsplit("/", 1)[0]
    (path,) = {f.rsplit("/", 1)[0] for f in kept.inputFiles()}
    assert path.removeprefix("file://").startswith(folder.removeprefix("file://")) and exists(spark, path)
    clear_scratch(spark)
    assert not exists(spark, path)


def test_no_local_scratch_on_a_cluster(spark, monkeypatch):
    from cdclake import session

    class Conf:
        def get(self, name, default=None):
            return {"spark.master": "spark://host:7077"}.get(name, default)

    class Cluster:
        conf = Conf()

    with pytest.raises(ValueError, match="share"):
        session.scratch_dir(Cluster(), "x")
