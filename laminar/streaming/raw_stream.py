"""LAND -> RAW as an incremental file stream (the safe form of SURVEY K5).

The reference copies every LAND row to RAW on each run and truncates LAND
afterwards, so rows landed in between are lost and a failed truncate copies
rows twice. A Structured Streaming file source with a checkpoint reads each
LAND file exactly once; ``availableNow`` processes what is there and stops,
so it runs as a daily batch job.

The stream shares RAW's ledger with the batch copy (``plans/layers.py``): a
micro-batch claims the loads that it is first to copy, leaves out those that are in the ledger or claimed by
another copy, and writes its part of each under the load's name, the checkpoint and its own number (a
replay replaces that part). At the end of the run, when all files of the loads that had landed before it
have been read, the loads that it owns enter the ledger; what others have begun and not ended is copied
by the batch form. Parts of loads outside the ledger are read by nobody.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from laminar.plans import tables
from laminar.plans.contracts import Contract
from laminar.plans.layers import (BATCH, LOAD, PART, claim, claims, drop_batches, fill_missing_stamps, landed, refresh_raw,
                                  settle, write_raw)


def stream_land_to_raw(spark: SparkSession, contract: Contract, land_path: str, raw_path: str,
                       checkpoint: str, max_files_per_trigger: int | None = None,
                       stamp: Column | None = None) -> StreamingQuery:
    name = uuid.uuid5(uuid.NAMESPACE_URL, checkpoint).hex
    before = landed(spark, land_path)
    reader = spark.readStream.schema(T.StructType([*contract.land_schema(), T.StructField(LOAD, T.StringType())]))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    land = reader.parquet(land_path)

    def copy(batch: DataFrame, batch_id: int) -> None:
        own, begun = set(), claims(spark, raw_path)
        for load in set(landed(spark, land_path)) - set(tables.commits(spark, raw_path)):
            if begun.get(load, {name}) == {name}:
                claim(spark, raw_path, load, name)
                own.add(load)
        drop_batches(spark, raw_path, f"*{PART}{batch_id}-{name}")      # a replay may fill stamps of another month
        rows = batch.where(F.col(LOAD).isin(sorted(own)))
        rows = rows if stamp is None else fill_missing_stamps(rows, stamp)
        part = F.concat(F.col(LOAD), F.lit(f"{PART}{batch_id}-{name}"))
        write_raw(rows.withColumn(BATCH, part), contract, raw_path)

    query = (land.writeStream.foreachBatch(copy)
             .option("checkpointLocation", checkpoint)
             .trigger(availableNow=True)
             .start())
    query.awaitTermination()
    begun, done = claims(spark, raw_path), set(tables.commits(spark, raw_path))
    for load in before:
        if load not in done and begun.get(load) == {name}:
            settle(spark, raw_path, load)
    refresh_raw(spark, contract, land_path, raw_path, before, stamp)
    return query
