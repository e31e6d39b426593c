import os
import uuid
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from laminar.operators import latest_batch
from laminar.plans import layers, tables
from laminar.plans.contracts import SCHOOLS, STATISTICS, Contract, ContractError, Field
from laminar.streaming import stream_land_to_raw
from tests.conftest import rows

T1 = datetime(2024, 1, 10, 8, 0)
T2 = datetime(2024, 2, 5, 8, 0)
CONTRACT = Contract("things", (Field("k", "k", "long"), Field("v", "v", "double"),
                               Field("ok", "ok", "bool")), "k")


def frame(spark, data):
    return spark.createDataFrame(data, "k long, v double, ok boolean")


def raw_of(spark, root):
    return layers.read_raw(spark, CONTRACT, f"{root}/raw")


def trusted_of(spark, root):
    return layers.read_trusted(spark, CONTRACT, f"{root}/trusted")


class Lake:
    """LAND and RAW of one test; ``kept`` are RAW's keys, one per landed row."""

    def __init__(self, spark, root):
        self.spark, self.land_path, self.raw_path, self.checkpoint = spark, f"{root}/land", f"{root}/raw", f"{root}/_ckpt"

    def land(self, key, stamp=T1, n=3):
        return layers.land(frame(self.spark, [(key * 10 + i, 1.0, True) for i in range(n)]), CONTRACT, self.land_path, stamp and F.lit(stamp))

    def batch(self, stamp=None):
        return layers.refresh_raw(self.spark, CONTRACT, self.land_path, self.raw_path, stamp=stamp)

    def stream(self, stamp=None, files=None, checkpoint=None):
        stream_land_to_raw(self.spark, CONTRACT, self.land_path, self.raw_path, checkpoint or self.checkpoint, files, stamp)

    def keys(self):
        return sorted(int(r["k"]) for r in layers.read_raw(self.spark, CONTRACT, self.raw_path).collect())


def test_contract_counts_match_the_payloads():
    from collections import Counter

    from laminar.plans.contracts import INFRASTRUCTURE
    assert len(SCHOOLS.fields) == 135 and len(STATISTICS.fields) == 100
    assert len(INFRASTRUCTURE.fields) == 10
    # TRUSTED type counts: schools 79 bool, 25 long, 18 string, 10 double, 3 dates
    assert Counter(f.kind for f in SCHOOLS.fields) == Counter(
        {"bool": 79, "long": 25, "string": 18, "double": 10, "dmy": 2, "year": 1})
    assert Counter(f.kind for f in STATISTICS.fields) == Counter({"double": 94, "string": 3, "long": 3})
    assert Counter(f.kind for f in INFRASTRUCTURE.fields) == Counter(
        {"string": 6, "long": 2, "safe_long": 1, "double": 1})
    assert len(set(SCHOOLS.land_columns)) == 135 and len(set(STATISTICS.land_columns)) == 100
    assert "reg_fundamental19" in SCHOOLS.land_columns and "data_shows" in SCHOOLS.land_columns
    assert "datashows" in STATISTICS.land_columns


def test_contract_check_lists_difference(spark):
    with pytest.raises(ContractError, match="missing"):
        CONTRACT.check(spark.createDataFrame([(1, 2.0)], "k long, v double"))
    with pytest.raises(ContractError, match="unexpected"):
        CONTRACT.check(spark.createDataFrame([(1, 2.0, True, 1)], "k long, v double, ok boolean, x int"))


def test_latest_batch_drops_null_stamps_and_older_batches(spark):
    df = spark.createDataFrame([(1, T1), (2, T2), (3, T2), (4, None)], "k long, partition_time timestamp")
    assert rows(latest_batch(df), "k") == [(2,), (3,)]
    nulls = spark.createDataFrame([(1, None)], "k long, partition_time timestamp")
    assert latest_batch(nulls).count() == 0


def test_raw_keeps_every_batch_trusted_only_latest(spark, tmp_path):
    root = str(tmp_path / uuid.uuid4().hex)
    batch = frame(spark, [(1, 1.5, True), (2, 2.5, False)])
    layers.land(batch, CONTRACT, f"{root}/land", F.lit(T1))
    layers.land(batch, CONTRACT, f"{root}/land", F.lit(T2))
    layers.refresh_raw(spark, CONTRACT, f"{root}/land", f"{root}/raw")
    layers.refresh_trusted(spark, CONTRACT, f"{root}/raw", f"{root}/trusted")
    raw, trusted = raw_of(spark, root), trusted_of(spark, root)
    assert raw.count() == 4 and dict(raw.dtypes)["k"] == "string"
    assert rows(trusted, "k", "v", "ok") == [(1, 1.5, True), (2, 2.5, False)]
    assert {r["partition_time"] for r in trusted.collect()} == {T2}
    assert dict(trusted.dtypes)["k"] == "bigint" and dict(trusted.dtypes)["ok"] == "boolean"
    # a second refresh replaces TRUSTED instead of appending to it
    layers.refresh_trusted(spark, CONTRACT, f"{root}/raw", f"{root}/trusted")
    assert trusted_of(spark, root).count() == 2


def test_the_newest_month_comes_from_folder_names(spark, tmp_path):
    lake = Lake(spark, tmp_path)
    for key, stamp in ((1, T1), (2, T2), (3, None)):
        lake.land(key, stamp)
    lake.batch()
    month = layers.newest_month(spark, CONTRACT, lake.raw_path)
    assert month.inputFiles() and all("load_month=2024-02-01" in f for f in month.inputFiles())   # footers of one month only
    out = layers.trusted_frame(month, CONTRACT)
    assert rows(out, "k") == [(20,), (21,), (22,)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "max(load_month" not in plan and plan.count("max(partition_time") > 0


def test_stamp_fill_and_truncate(spark, tmp_path):
    root = str(tmp_path / uuid.uuid4().hex)
    batch = frame(spark, [(1, 1.0, True)])
    layers.land(batch, CONTRACT, f"{root}/land", F.lit(T1))
    layers.land(batch, CONTRACT, f"{root}/land", None)
    landed = layers.read_land(spark, CONTRACT, f"{root}/land")
    filled = layers.fill_missing_stamps(landed, layers.batch_instant(datetime(2024, 3, 1, 12, 0)))
    assert sorted(r["partition_time"] for r in filled.collect()) == [T1, datetime(2024, 3, 1, 9, 0)]
    layers.truncate(spark, f"{root}/land")
    after = layers.read_land(spark, CONTRACT, f"{root}/land")
    assert after.count() == 0 and after.columns == CONTRACT.land_columns + ["partition_time"]


def test_malformed_value_fails_trusted_refresh(spark, tmp_path):
    root = str(tmp_path / uuid.uuid4().hex)
    text = spark.createDataFrame([("1", "x", "true")], "k string, v string, ok string")
    layers.land(text, CONTRACT, f"{root}/land", F.lit(T1))
    layers.refresh_raw(spark, CONTRACT, f"{root}/land", f"{root}/raw")
    with pytest.raises(Exception):
        layers.refresh_trusted(spark, CONTRACT, f"{root}/raw", f"{root}/trusted")


def test_archive_dir():
    assert layers.archive_dir("/a/raw/flatfile/original", datetime(2024, 3, 7)) == \
        "/a/raw/flatfile/original/2024/03/07"


def test_stream_copies_each_land_file_once(spark, tmp_path):
    root = str(tmp_path / uuid.uuid4().hex)
    batch = frame(spark, [(1, 1.0, True), (2, 2.0, False)])
    layers.land(batch, CONTRACT, f"{root}/land", F.lit(T1))
    stream_land_to_raw(spark, CONTRACT, f"{root}/land", f"{root}/raw", f"{root}/_ckpt")
    stream_land_to_raw(spark, CONTRACT, f"{root}/land", f"{root}/raw", f"{root}/_ckpt")
    assert raw_of(spark, root).count() == 2      # a re-run copies nothing again
    layers.land(batch, CONTRACT, f"{root}/land", F.lit(T2))
    stream_land_to_raw(spark, CONTRACT, f"{root}/land", f"{root}/raw", f"{root}/_ckpt")
    raw = raw_of(spark, root)
    assert raw.count() == 4
    assert rows(raw.groupBy("load_month").count(), "load_month", "count") == \
        [(T1.date().replace(day=1), 2), (T2.date().replace(day=1), 2)]


def test_tolerant_trusted_refresh_nulls_malformed_values(spark, tmp_path):
    root = str(tmp_path / uuid.uuid4().hex)
    text = spark.createDataFrame([("1", "x", "yes"), ("2", "2.5", "TRUE")], "k string, v string, ok string")
    layers.land(text, CONTRACT, f"{root}/land", F.lit(T1))
    layers.refresh_raw(spark, CONTRACT, f"{root}/land", f"{root}/raw")
    layers.refresh_trusted(spark, CONTRACT, f"{root}/raw", f"{root}/trusted", tolerant=True)
    assert rows(trusted_of(spark, root), "k", "v", "ok") == [(1, None, None), (2, 2.5, True)]


def test_a_replayed_batch_replaces_itself_and_a_hot_key_is_split(spark, tmp_path):
    root = str(tmp_path)
    df = spark.range(4000).select(F.when(F.col("id") < 3000, "hot").otherwise(F.col("id").cast("string")).alias("k"),
                                  *[F.col("id").cast("string").alias(c) for c in CONTRACT.land_columns if c != "k"])
    rows_ = layers.land_frame(df.select(*CONTRACT.land_columns), CONTRACT, F.lit(datetime(2024, 2, 1)))
    for _ in range(2):
        layers.append_raw(rows_, CONTRACT, f"{root}/raw", batch="one")
    layers.append_raw(rows_, CONTRACT, f"{root}/raw", batch="two")
    raw = raw_of(spark, root)
    assert raw.count() == 8000
    assert len(raw.inputFiles()) <= 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_late_rows_survive_truncation(spark, tmp_path):
    lake = Lake(spark, tmp_path)
    lake.land(1, None)
    loads = layers.landed(spark, lake.land_path)
    late = lake.land(2, None)
    layers.refresh_raw(spark, CONTRACT, lake.land_path, lake.raw_path, loads, F.lit(T1))
    layers.truncate(spark, lake.land_path, loads)
    assert layers.landed(spark, lake.land_path) == [late] and layers.read_land(spark, CONTRACT, lake.land_path).count() == 3
    assert layers.read_raw(spark, CONTRACT, lake.raw_path).where("partition_time IS NULL").count() == 0 and lake.keys() == [10, 11, 12]


# ---------------------------------------------------------------- one row once, whoever copies

def test_stream_then_late_landing_then_batch(spark, tmp_path):
    lake = Lake(spark, tmp_path)
    lake.land(1)
    lake.stream()
    lake.land(2)
    lake.batch()
    lake.stream()
    assert lake.keys() == [10, 11, 12, 20, 21, 22]


def test_batch_stopped_before_truncation_then_stream(spark, tmp_path):
    lake = Lake(spark, tmp_path)
    lake.land(1)
    lake.batch()
    lake.land(2, T2)
    lake.stream()
    lake.batch()
    assert lake.keys() == [10, 11, 12, 20, 21, 22]


def test_an_unfinished_batch_copy_is_redone_in_another_month(spark, tmp_path, monkeypatch):
    lake = Lake(spark, tmp_path)
    lake.land(1, None)
    with monkeypatch.context() as m:
        m.setattr(layers, "settle", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt))
        with pytest.raises(KeyboardInterrupt):
            lake.batch(F.lit(T1))                       # written, not in the ledger
    assert lake.keys() == []                            # nobody reads it
    lake.stream(F.lit(T2))                              # claimed by the batch: copied anew at the end of the run
    assert lake.keys() == [10, 11, 12]
    assert {r[0].month for r in raw_of(spark, tmp_path).select("load_month").distinct().collect()} == {2}


def test_a_stream_stopped_in_the_middle_goes_on_or_is_replaced(spark, tmp_path, monkeypatch):
    import laminar.streaming.raw_stream as module
    for finish in ("stream", "batch", "other stream", "batch, then stream"):
        lake = Lake(spark, tmp_path / finish.replace(" ", "_"))
        for key in (1, 2, 3):
            lake.land(key, None)
        real, calls = module.write_raw, []

        def stop_at_second(*args, real=real, calls=calls):
            calls.append(1)
            if len(calls) == 2:
                raise RuntimeError("killed")
            real(*args)

        with monkeypatch.context() as m:
            m.setattr(module, "write_raw", stop_at_second)
            with pytest.raises(Exception):
                lake.stream(F.lit(T1), files=1)
        if finish.startswith("batch"):
            lake.batch(F.lit(T2))
        if finish == "other stream":
            lake.stream(F.lit(T2), checkpoint=f"{lake.checkpoint}-other")
        if finish.endswith("stream"):
            lake.stream(F.lit(T2), files=1)
        assert lake.keys() == [10, 11, 12, 20, 21, 22, 30, 31, 32], finish


def test_two_streams_share_the_ledger(spark, tmp_path):
    lake = Lake(spark, tmp_path)
    lake.land(1)
    lake.stream()
    lake.land(2)
    lake.stream(checkpoint=f"{tmp_path}/second")
    lake.stream()
    assert lake.keys() == [10, 11, 12, 20, 21, 22]


def test_truncation_of_many_files_takes_a_call_per_load(spark, tmp_path, monkeypatch):
    root = f"{tmp_path}/land"
    wide = spark.range(300).selectExpr("id AS k", "1.0D AS v", "true AS ok").repartition(300)
    layers.land(wide, CONTRACT, root, F.lit(T1))
    folder = next(x for x in os.listdir(root) if x.startswith("load_id="))
    assert len([f for f in os.listdir(f"{root}/{folder}") if f.endswith(".parquet")]) > 100
    calls, real = [], tables._at
    monkeypatch.setattr(tables, "_at", lambda *a: calls.append(a) or real(*a))
    layers.refresh_raw(spark, CONTRACT, root, f"{tmp_path}/raw")
    layers.truncate(spark, root)
    assert len(calls) < 12
    assert layers.read_land(spark, CONTRACT, root).count() == 0 and raw_of(spark, tmp_path).count() == 300


# ---------------------------------------------------------------- empty tables and whole replaces

@pytest.mark.parametrize("stamped", [None, False])
def test_empty_tables_can_be_read(spark, tmp_path, stamped):
    root = str(tmp_path)
    if stamped is not None:
        layers.land(frame(spark, [(1, 1.0, True)]), CONTRACT, f"{root}/land", None)     # no stamp: never newest
    layers.refresh_raw(spark, CONTRACT, f"{root}/land", f"{root}/raw")
    layers.refresh_trusted(spark, CONTRACT, f"{root}/raw", f"{root}/trusted")
    trusted = trusted_of(spark, root)
    assert trusted.count() == 0 and dict(trusted.dtypes)["v"] == "double"
    assert spark.read.parquet(tables.current(spark, f"{root}/trusted")).count() == 0     # without a schema, too
    assert layers.read_land(spark, CONTRACT, f"{root}/land").columns == CONTRACT.land_columns + ["partition_time"]


def test_a_reader_sees_the_old_rows_or_the_new_ones(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/t"
    tables.replace(spark.range(3), path)
    old = tables.read(spark, path)
    assert old.count() == 3
    with monkeypatch.context() as m:
        m.setattr(tables, "commit", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt))
        with pytest.raises(KeyboardInterrupt):
            tables.replace(spark.range(5), path)        # killed after its files, before its commit
    assert tables.read(spark, path).count() == 3
    tables.replace(spark.range(7), path)
    assert old.count() == 3 and tables.read(spark, path).count() == 7      # who has begun to read goes on
    tables.replace(spark.range(9), path)
    assert tables.read(spark, path).count() == 9
    assert len([n for n in os.listdir(path) if n.startswith("v-")]) == tables.KEEP_VERSIONS


def test_files_of_a_month_are_sorted_by_the_key(spark, tmp_path):
    """K8: each RAW file is sorted by the clustering key, and files of a month hold separate ranges."""
    root = str(tmp_path)
    df = spark.range(5000).selectExpr("(id * 7919) % 5000 AS k", "1.0D AS v", "true AS ok").repartition(6)
    layers.land(df, CONTRACT, f"{root}/land", F.lit(T1))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")        # else one small file
    layers.refresh_raw(spark, CONTRACT, f"{root}/land", f"{root}/raw")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    spans = []
    for file in spark.read.schema(CONTRACT.land_schema()).parquet(f"{root}/raw").inputFiles():
        keys = [r["k"] for r in spark.read.schema(CONTRACT.land_schema()).parquet(file).collect()]
        assert keys == sorted(keys)
        spans.append((keys[0], keys[-1]))
    spans.sort()
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:], strict=False)) and len(spans) > 1
