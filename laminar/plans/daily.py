"""The daily run: saved payloads -> LAND -> RAW -> TRUSTED -> mart.

Payload folder layout (what the extract step saves: one JSON document per
file, or per line with ``lines=True``):

    cidades/                       S1  JSON array of 'id - name' strings
    busca_capital/                 S2  [count, [ {cod, ...} ]] per score shard
    busca_cidades/cidade=<id>/     S3  [count, [ {cod, ...} ]] per city
    escolas/                       S6  one school object per line
    estatisticas/                  S7  one state object per line
    infraestrutura/ano=<y>/dep=<d>/ S8  nested sections per request

Plain function calls in dependency order; each step reads what the previous
one wrote. The three
entities are independent until the mart and run as concurrent Spark jobs.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from laminar.functions import SOCIO_LEVELS
from laminar.operators.bands import DEFAULT_BANDS, Bands
from laminar.plans import layers
from laminar.plans.contracts import INFRASTRUCTURE, SCHOOLS, STATISTICS, Contract
from laminar.plans.marts import write_datamart
from laminar.sources import (KeyAudit, answered, bag_union, city_ids, envelope_ids, flatten_infrastructure, id_lookup,
                             literal_grid, literal_states, read_objects, read_payloads)
from laminar.sources.payloads import CAPITAL_CITY_ID
from laminar.streaming import stream_land_to_raw


@dataclass(frozen=True)
class LayerPaths:
    root: str

    def land(self, c: Contract) -> str:
        return f"{self.root}/land/{c.name}"

    def raw(self, c: Contract) -> str:
        return f"{self.root}/raw/{c.name}"

    def trusted(self, c: Contract) -> str:
        return f"{self.root}/trusted/{c.name}"

    def checkpoint(self, c: Contract) -> str:
        return f"{self.root}/_checkpoints/raw/{c.name}"

    @property
    def mart(self) -> str:
        return f"{self.root}/refined/datamart_diretoria"

    @property
    def archive(self) -> str:
        return f"{self.root}/archive/original"


def extract_schools(spark: SparkSession, payload_dir: str, audit: KeyAudit | None = None,
                    dedupe: bool = False, lines: bool = False,
                    capital: str = CAPITAL_CITY_ID) -> DataFrame:
    """U1 without the write: city ids, the two searches, bag union, detail lookup.

    Every listed city must have a saved search and every found id a detail object, else the job fails naming it.
    As in the reference, a school on a shared shard endpoint is found twice
    and lands twice; ``dedupe=True`` keeps one id instead (a shuffle on the
    id, partially aggregated, so a repeated id costs one row per task).
    """
    whole = not lines
    cities = city_ids(read_payloads(spark, f"{payload_dir}/cidades", whole), exclude=capital)
    capital = envelope_ids(read_payloads(spark, f"{payload_dir}/busca_capital", whole), guard=False)
    searches = read_payloads(spark, f"{payload_dir}/busca_cidades", whole, "cidade string")
    # every listed city is requested, repeats included
    rest = envelope_ids(id_lookup(cities, searches, "cidade", required_ids=True), guard=True)
    ids = bag_union([capital, rest])
    if dedupe:
        ids = ids.dropDuplicates(["cod"])
    details = read_objects(spark, f"{payload_dir}/escolas", SCHOOLS, audit)
    return _audited(id_lookup(ids, details, "cod", required_ids=True), SCHOOLS, audit)


def extract_statistics(spark: SparkSession, payload_dir: str, states: DataFrame | None = None,
                       audit: KeyAudit | None = None) -> DataFrame:
    """U2 without the write: the objects of the requested states (``nome_local``; default: the 27 codes), S7."""
    states = literal_states(spark) if states is None else states
    objects = read_objects(spark, f"{payload_dir}/estatisticas", STATISTICS, audit)
    return _audited(answered(states, objects, "nome_local"), STATISTICS, audit)


def _audited(found: DataFrame, contract: Contract, audit: KeyAudit | None) -> DataFrame:
    """The contract's columns; the audit sees the rows that are written."""
    if audit is None:
        return found.select(contract.land_columns)
    return audit.watch(found.select(*contract.land_columns, *audit.columns))


def extract_infrastructure(spark: SparkSession, payload_dir: str, requests: DataFrame | None = None,
                           lines: bool = False) -> DataFrame:
    """U3 without the write: the payloads of the requested (``ano``, ``dep``) pairs (default: the 12 x 2 grid);
    ``id`` is never in the payload and lands as NULL."""
    requests = literal_grid(spark) if requests is None else requests
    payloads = read_payloads(spark, f"{payload_dir}/infraestrutura", not lines, "ano int, dep int")
    asked = requests.select(F.col("ano").cast("int"), F.col("dep").cast("int"))
    flat = flatten_infrastructure(answered(asked, payloads, "ano", "dep"))
    return flat.withColumn("id", F.lit(None).cast("string")).select(INFRASTRUCTURE.land_columns)


def refine(spark: SparkSession, contract: Contract, extracted: DataFrame, paths: LayerPaths, stamp: Column, day: datetime,
           audit: KeyAudit | None = None, raw_stream: bool = False) -> list[str]:
    """One entity from its extract to TRUSTED; returns the LAND loads that are now in RAW.

    The stamped batch file is written once to the dated archive (K4), then appended to LAND from there (K1-K3),
    as the reference loads and archives the same file; then RAW (U4) and TRUSTED (U5).
    """
    archived = layers.archive_copy(layers.land_frame(extracted, contract, stamp), paths.archive, day, contract.name)
    if audit is not None:
        audit.check()
    layers.land_batch(spark.read.schema(contract.land_schema()).parquet(archived), paths.land(contract))
    # Rows that land from here on stay in LAND for the next run.
    loads = layers.landed(spark, paths.land(contract))
    if raw_stream:
        stream_land_to_raw(spark, contract, paths.land(contract), paths.raw(contract), paths.checkpoint(contract), stamp=stamp)
    else:
        layers.refresh_raw(spark, contract, paths.land(contract), paths.raw(contract), loads, stamp)
    layers.refresh_trusted(spark, contract, paths.raw(contract), paths.trusted(contract))
    return loads


def run_daily(spark: SparkSession, payload_dir: str, root: str, now: datetime | None = None,
              archive_day: datetime | None = None, lines: bool = False,
              states: DataFrame | None = None, requests: DataFrame | None = None,
              levels: Sequence[str] = SOCIO_LEVELS, bands: Bands = DEFAULT_BANDS, capital: str = CAPITAL_CITY_ID,
              raw_stream: bool = False) -> LayerPaths:
    """Land, archive, RAW, TRUSTED, mart, then truncate LAND.

    ``lines`` reads payload files as JSON lines (one document per line)
    instead of one document per file; ``states``, ``requests``, ``levels`` and ``bands``
    are the requested states and (year, dependency) pairs, the socio-economic labels and the score
    bands (the reference's fixed values by default). ``raw_stream`` copies
    LAND to RAW with the checkpointed ``availableNow`` stream. Either copy enters each load
    in RAW's ledger, so a re-run or a failed truncate never copies a load twice.
    """
    paths = LayerPaths(root)
    stamp = layers.batch_instant(now)
    # the archive day follows the stamp's clock: UTC, shifted by the same hours
    day = archive_day or (now or datetime.now(timezone.utc)) - timedelta(hours=layers.STAMP_SHIFT_HOURS)
    audits = {c: KeyAudit(c) for c in (SCHOOLS, STATISTICS)}
    extracts = {
        SCHOOLS: lambda: extract_schools(spark, payload_dir, audits[SCHOOLS], lines=lines, capital=capital),
        STATISTICS: lambda: extract_statistics(spark, payload_dir, states, audits[STATISTICS]),
        INFRASTRUCTURE: lambda: extract_infrastructure(spark, payload_dir, requests, lines=lines),
    }

    copied: dict[Contract, list[str]] = {}

    def chain(contract: Contract) -> None:
        copied[contract] = refine(spark, contract, extracts[contract](), paths, stamp, day, audits.get(contract), raw_stream)

    # The three entities do not depend on each other until the mart: their
    # chains run as concurrent Spark jobs (one driver thread each).
    concurrently(chain, list(extracts))
    write_datamart(layers.read_trusted(spark, SCHOOLS, paths.trusted(SCHOOLS)),
                   layers.read_trusted(spark, STATISTICS, paths.trusted(STATISTICS)), paths.mart, levels, bands)
    concurrently(lambda c: layers.truncate(spark, paths.land(c), copied[c]), list(extracts))
    return paths


def concurrently(fn, items: list) -> None:
    """Run ``fn`` on every item in its own thread (Spark schedules the jobs side by
    side); wait for all and re-raise the first failure."""
    with ThreadPoolExecutor(max_workers=max(1, len(items))) as pool:
        futures = [pool.submit(fn, item) for item in items]
        for future in futures:
            future.result()
