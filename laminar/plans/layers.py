"""Layer writes: LAND (all text, stamped, append), RAW (append, month partitions),
TRUSTED (latest batch, typed, full replace), plus truncate and archive copy
(SURVEY K1-K9, P1, P16-P18, F1, F3).

LAND holds a folder per load, RAW a folder per month and batch, TRUSTED and the mart a folder per
version; ``plans/tables.py`` says which of them count. RAW's batches are named after the LAND load they
copy, and RAW's commit list is the ledger of copied loads that batch and stream copies share: a load that is
in it is never copied again. Until then a load is claimed by the copies that have begun it: a stream only goes on
with loads that nobody else has claimed, and a batch copy removes what others have left of its loads.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from laminar.functions import stringify
from laminar.operators.latest import latest_batch
from laminar.plans import tables
from laminar.plans.contracts import MONTH, STAMP, Contract

# The reference stamps loads with the warehouse clock shifted three hours
# back (a fixed wall-clock offset, kept as a parameter).
STAMP_SHIFT_HOURS = 3
LOAD = "load_id"            # LAND's partition column: one folder per load
BATCH = "load_batch"        # RAW's second partition column: one folder per committed batch
CLAIMS = "_claims"          # in RAW: <load>.<who has begun to copy it>
PART = "."                  # between a load's name and the name of a part of it that a stream copied


def batch_instant(now: datetime | None = None, shift_hours: int = STAMP_SHIFT_HOURS) -> Column:
    """``CURRENT_TIMESTAMP() - INTERVAL 3 HOUR``; tests pass a fixed ``now``."""
    base = F.current_timestamp() if now is None else F.lit(now).cast("timestamp")
    return base - F.make_dt_interval(F.lit(0), F.lit(shift_hours))


def land_frame(df: DataFrame, contract: Contract, stamp: Column | None) -> DataFrame:
    """Contract columns as text, plus the load stamp (NULL when ``stamp`` is None)."""
    contract.check(df)
    text = stringify(df.select(contract.land_columns))
    value = F.lit(None).cast("timestamp") if stamp is None else stamp.cast("timestamp")
    return text.withColumn(STAMP, value)


def land_batch(batch: DataFrame, land_path: str, load: str | None = None) -> str:
    """Append a stamped frame to LAND as one load (K1, K2); returns the load's name."""
    load = load or uuid.uuid4().hex
    batch.write.parquet(f"{land_path}/{LOAD}={load}")
    tables.commit(batch.sparkSession, land_path, load)
    return load


def land(df: DataFrame, contract: Contract, land_path: str, stamp: Column | None) -> str:
    """Append one batch to LAND (K1, K2). The stamp is set at write time (K3)."""
    return land_batch(land_frame(df, contract, stamp), land_path)


def landed(spark: SparkSession, land_path: str) -> list[str]:
    """The loads LAND has now; what lands later is not among them."""
    return tables.commits(spark, land_path)


def fill_missing_stamps(df: DataFrame, stamp: Column) -> DataFrame:
    """``SET partition_time = stamp WHERE partition_time IS NULL`` as a projection."""
    return df.withColumn(STAMP, F.coalesce(F.col(STAMP), stamp.cast("timestamp")))


def _read(spark: SparkSession, schema: T.StructType, base: str, folders: Iterable[str]) -> DataFrame:
    """Parquet folders under ``base`` with a fixed schema; none: an empty frame."""
    folders = [f"{base}/{f}" for f in folders]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", base).parquet(*folders)


def _loads(spark: SparkSession, contract: Contract, land_path: str, loads: Iterable[str] | None) -> DataFrame:
    schema = T.StructType([*contract.land_schema(), T.StructField(LOAD, T.StringType())])
    return _read(spark, schema, land_path, [f"{LOAD}={x}" for x in (landed(spark, land_path) if loads is None else loads)])


def read_land(spark: SparkSession, contract: Contract, land_path: str, loads: Iterable[str] | None = None) -> DataFrame:
    """The rows of the given loads (None: of all landed ones); an empty LAND is an empty table."""
    return _loads(spark, contract, land_path, loads).drop(LOAD)


def raw_projection(df: DataFrame, contract: Contract) -> DataFrame:
    """The RAW column list: contract columns in contract order, then the stamp."""
    contract.check(df)
    return df.select(*contract.land_columns, STAMP)


def with_month(df: DataFrame) -> DataFrame:
    """``DATETIME_TRUNC(partition_time, MONTH)`` as a date partition column."""
    return df.withColumn(MONTH, F.trunc(F.col(STAMP), "month"))


def clustered(df: DataFrame, contract: Contract, *within: str) -> DataFrame:
    """Rows dealt into ranges of (month, clustering key) and sorted (K7, K8).

    Files of a month hold separate key ranges, and a month has about as many
    files as it has ranges. A hash of the whole row ends the range key, so
    one hot key is still split over several tasks.
    """
    out = with_month(df)
    ranged = out.withColumn("_salt", F.pmod(F.xxhash64(*df.columns), F.lit(64)))
    return (ranged.repartitionByRange(MONTH, contract.cluster_key, "_salt")
            .sortWithinPartitions(MONTH, *within, contract.cluster_key).drop("_salt"))


def write_raw(df: DataFrame, contract: Contract, raw_path: str) -> None:
    """Write rows that name their batch (K5, K7, K8): a folder per month and batch, replacing that folder."""
    (clustered(df.select(*contract.land_columns, STAMP, BATCH), contract, BATCH)
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(MONTH, BATCH).parquet(raw_path))


def drop_batches(spark: SparkSession, raw_path: str, pattern: str) -> None:
    """Remove the folders of RAW batches, in whatever month."""
    for folder in tables.matching(spark, raw_path, f"{MONTH}=*/{BATCH}={pattern}"):
        tables.remove(spark, folder)


def append_raw(df: DataFrame, contract: Contract, raw_path: str, batch: str | None = None) -> None:
    """Append every given row to RAW as one committed batch; written again under the same name it replaces itself."""
    batch, spark = batch or f"batch-{uuid.uuid4().hex}", df.sparkSession
    drop_batches(spark, raw_path, batch)
    write_raw(raw_projection(df, contract).withColumn(BATCH, F.lit(batch)), contract, raw_path)
    tables.commit(spark, raw_path, batch)


def claim(spark: SparkSession, raw_path: str, load: str, who: str) -> None:
    tables.touch(spark, f"{raw_path}/{CLAIMS}/{load}{PART}{who}")


def claims(spark: SparkSession, raw_path: str) -> dict[str, set[str]]:
    """Who has begun to copy each load that is not in the ledger yet."""
    found: dict[str, set[str]] = {}
    for load, _, who in (n.partition(PART) for n in tables.names(spark, f"{raw_path}/{CLAIMS}")):
        found.setdefault(load, set()).add(who)
    return found


def settle(spark: SparkSession, raw_path: str, load: str) -> None:
    """Enter a wholly copied load in the ledger; its claims go."""
    tables.commit(spark, raw_path, load)
    for folder in tables.matching(spark, f"{raw_path}/{CLAIMS}", f"{load}{PART}*"):
        tables.remove(spark, folder)


def refresh_raw(spark: SparkSession, contract: Contract, land_path: str, raw_path: str,
                loads: list[str] | None = None, stamp: Column | None = None) -> list[str]:
    """RAW incremental refresh (U4): all rows of LAND's loads, each load once; returns the loads that are now in RAW.

    ``loads`` limits the copy to a listing taken before, ``stamp`` fills stamps that are NULL (K3).
    """
    loads = landed(spark, land_path) if loads is None else loads
    done = set(tables.commits(spark, raw_path))
    pending = [x for x in loads if x not in done]
    if pending:
        for load in pending:                # an unfinished copy may lie in another month or in a stream's parts
            claim(spark, raw_path, load, "batch")
            drop_batches(spark, raw_path, load)
            drop_batches(spark, raw_path, f"{load}{PART}*")
        rows = _loads(spark, contract, land_path, pending)
        rows = rows if stamp is None else fill_missing_stamps(rows, stamp)
        write_raw(rows.withColumnRenamed(LOAD, BATCH), contract, raw_path)
        for load in pending:
            settle(spark, raw_path, load)
    return loads


def _raw_schema(contract: Contract) -> T.StructType:
    return T.StructType([*contract.land_schema(), T.StructField(MONTH, T.DateType()), T.StructField(BATCH, T.StringType())])


def _committed_folders(spark: SparkSession, raw_path: str, month: str, done: set[str]) -> list[str]:
    return [f"{month}/{b}" for b in tables.names(spark, f"{raw_path}/{month}")
            if b.startswith(f"{BATCH}=") and b.removeprefix(f"{BATCH}=").split(PART)[0] in done]


def read_raw(spark: SparkSession, contract: Contract, raw_path: str) -> DataFrame:
    """All committed rows of RAW with their month; an empty RAW is an empty table."""
    done = tables.commits(spark, raw_path)
    if not any(n.startswith(f"{MONTH}=") for n in tables.names(spark, raw_path)):
        return spark.createDataFrame([], _raw_schema(contract)).drop(BATCH)
    rows = spark.read.schema(_raw_schema(contract)).parquet(raw_path)
    return rows.where(F.substring_index(BATCH, PART, 1).isin(done)).drop(BATCH)


def newest_month(spark: SparkSession, contract: Contract, raw_path: str) -> DataFrame:
    """RAW's rows of the newest month that holds a committed batch, found from folder names alone.

    Rows without a stamp lie in the NULL month and are never newest (F1); with no other month the frame is empty.
    """
    done = set(tables.commits(spark, raw_path))
    months = [n for n in tables.names(spark, raw_path) if n.startswith(f"{MONTH}=") and not n.endswith(tables.NULL_PARTITION)]
    for month in reversed(months):
        if folders := _committed_folders(spark, raw_path, month, done):
            return _read(spark, _raw_schema(contract), raw_path, folders).drop(BATCH)
    return spark.createDataFrame([], _raw_schema(contract)).drop(BATCH)


def trusted_frame(month: DataFrame, contract: Contract, tolerant: bool = False) -> DataFrame:
    """Latest batch of RAW (of ``newest_month`` or of a whole table) with the contract casts."""
    return contract.typed(latest_batch(month, STAMP), STAMP, tolerant=tolerant)


def refresh_trusted(spark: SparkSession, contract: Contract, raw_path: str, trusted_path: str,
                    tolerant: bool = False) -> None:
    """TRUSTED full replace from RAW's latest batch, month-partitioned."""
    typed = trusted_frame(newest_month(spark, contract, raw_path), contract, tolerant)
    tables.replace(clustered(typed, contract), trusted_path, MONTH)


def read_trusted(spark: SparkSession, contract: Contract, trusted_path: str) -> DataFrame:
    """The current version of a TRUSTED table, typed by its contract also when it has no rows."""
    schema = T.StructType([*contract.trusted_schema(), T.StructField(MONTH, T.DateType())])
    return tables.read(spark, trusted_path, schema)


def truncate(spark: SparkSession, land_path: str, loads: list[str] | None = None) -> None:
    """Empty LAND (K9); with ``loads`` only those go. Two calls per load, however many files it has."""
    for load in landed(spark, land_path) if loads is None else loads:
        tables.drop_commit(spark, land_path, load)
        tables.remove(spark, f"{land_path}/{LOAD}={load}")


def archive_dir(root: str, when: datetime) -> str:
    """``<root>/YYYY/MM/DD`` of the run date."""
    return f"{root.rstrip('/')}/{when:%Y/%m/%d}"


def archive_copy(df: DataFrame, root: str, when: datetime, name: str) -> str:
    """Keep a copy of the landed batch under the dated archive folder (K4)."""
    path = f"{archive_dir(root, when)}/{name}"
    df.write.mode("overwrite").parquet(path)
    return path


def archive_path_column(ts) -> Column:
    """The dated archive folder of a timestamp column, ``yyyy/MM/dd``."""
    return F.date_format(F.col(ts) if isinstance(ts, str) else ts, "yyyy/MM/dd")
