"""The versioned state of items and its logs.

A version is a folder of its own that is never written twice. It counts once its commit
file exists, and of several writers only one can create that file: who loses reads the new
version, merges into it and tries the next number, so no batch is lost. Commit files and
run files are created whole and only if absent: by a link on local disks, by a rename that
does not replace elsewhere (atomic on file systems such as HDFS).
"""

from __future__ import annotations

import contextlib
import datetime as dt
import json
import os
import uuid
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallygrove.operators.linking import merge_state
from tallygrove.sources.snapshot import append_log

#: What a comparison with today's snapshot needs of the state.
BASELINE = ["item_key", "status", "opening_price_eur", "current_bid_eur", "estimated_value_eur", "minimum_price_eur", "first_seen", "times_seen"]
_COMMIT = "version bigint, path string, committed_at timestamp"
_RUN = "run_id bigint, source_url string, source_bytes bigint, source_sha256 string, snapshot_date string, rows_in_csv bigint, started_at timestamp, finished_at timestamp, stats string"
# The tables' columns and types.
ITEMS = """item_key string, case_ref string, auction_id string, issuer_type string, issuer_name string, description string, property_type string,
    procedure_type string, sale_method string, scope string, county string, city string, cadastral_municipality string, location_confidence string,
    location_raw string, estimated_value_eur decimal(16,2), opening_price_eur decimal(16,2), minimum_price_eur decimal(16,2), deposit_eur decimal(16,2),
    bid_step_eur decimal(16,2), current_bid_eur decimal(16,2), discount_pct decimal(7,2), discount_suspicious boolean, area_m2 decimal(16,2),
    area_unit_source string, auction_round string, auction_round_no smallint, decision_date date, publish_start timestamp_ntz, auction_start timestamp_ntz,
    auction_end timestamp_ntz, extendable boolean, deposit_value_date timestamp_ntz, viewing_time string, status string, slug string, repeat_group string,
    repeat_seq smallint, source_snapshot_date date, latitude decimal(10,7), longitude decimal(10,7), coord_source string"""
PRICES = "item_key string, snapshot_date date, field string, old_value decimal(16,2), new_value decimal(16,2), pct_change decimal(9,2)"
EVENTS = "item_key string, event_type string, detail string"
UNRESOLVED = "item_key string, issuer_name string, raw_hint string, reason string"
LOGS = {"price_history": PRICES, "item_events": EVENTS, "unresolved_locations": UNRESOLVED}


class Conflict(RuntimeError):
    """Another writer has committed the version first, again and again."""


def _read(spark: SparkSession, path: str, schema: str, form: str = "json") -> DataFrame:
    """A table that may not exist yet."""
    try:
        return spark.read.schema(schema).format(form).load(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def put_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file with this text, unless there is one of that name; of several writers one succeeds."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    target = hadoop.Path(path)
    files = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    hidden = hadoop.Path(target.getParent(), f".{target.getName()}.{uuid.uuid4().hex}")
    stream = files.create(hidden, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    try:
        if files.getScheme() == "file":  # a rename would replace
            try:
                os.link(hidden.toUri().getPath(), target.toUri().getPath())
                return True
            except FileExistsError:
                return False
        return not files.exists(target) and files.rename(hidden, target)
    finally:
        with contextlib.suppress(Exception):  # a renamed file is no longer there
            files.delete(hidden, False)


def _remove(spark: SparkSession, path: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def conform(df: DataFrame, schema: str) -> DataFrame:
    """df with exactly the columns of a schema, cast to its types; a missing one is an error, others stay behind."""
    kinds = df.sparkSession.createDataFrame([], schema).schema
    return df.select(*(F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in kinds))


def init_schema(spark: SparkSession, root: str) -> None:
    """Empty typed logs where there are none yet; what exists stays. Items and runs come with their first version and run."""
    for name, schema in LOGS.items():
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root}/{name}")
        if not at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at):
            spark.createDataFrame([], f"{schema}, run_id bigint").write.mode("ignore").parquet(f"{root}/{name}")


def record(rows: DataFrame, root: str, log: str, run_id: int) -> None:
    """A run's rows of one of LOGS, with the log's columns and types."""
    append_log(conform(rows, LOGS[log]), f"{root}/{log}", run_id)


def read_log(spark: SparkSession, root: str, log: str) -> DataFrame:
    return _read(spark, f"{root}/{log}", f"{LOGS[log]}, run_id bigint", "parquet")


def current_version(spark: SparkSession, root: str) -> tuple[int, str] | None:
    """The last committed version and its folder."""
    row = _read(spark, f"{root}/commits", _COMMIT).agg(F.max(F.struct("version", "path")).alias("v")).first()
    return (row["v"]["version"], row["v"]["path"]) if row["v"] else None


def counters(statuses: Sequence[str], types: Sequence[str], counties: Sequence[str]) -> dict[str, Column]:
    """Aggregates of items that can be taken while they are written: each name with its aggregate.

    A repeat group has one item that is its second, so groups are counted without telling
    them apart. A name with a colon is an entry of a table of counts.
    """
    n = F.count(F.lit(1))
    sound = F.when(F.col("discount_pct").isNotNull() & ~F.coalesce("discount_suspicious", F.lit(False)), F.col("discount_pct").cast("double"))
    out = {"items": n, "avg_discount_pct": F.round(F.avg(sound).cast("decimal(18,6)"), 2).cast("double"), "suspicious": F.count_if("discount_suspicious"), "repeat_groups": F.count_if(F.col("repeat_seq") == 2)}
    for name, column, values in (("by_status", "status", statuses), ("by_type", "property_type", types), ("by_county", "county", counties)):
        out |= {f"{name}:{v}": F.count_if(F.col(column) == v) for v in values}
        out[f"{name}:Nepoznato"] = F.count_if(~F.coalesce(F.col(column).isin(*values), F.lit(False)))
    return out


def summary(flat: dict) -> dict:
    """Counters as one nested structure, tables of counts from the top and without zeros."""
    out: dict = {}
    for name, x in flat.items():
        table, colon, key = name.partition(":")
        if not colon:
            out[name] = x
        elif x:
            out.setdefault(table, {})[key] = x
    return {k: dict(sorted(v.items(), key=lambda kv: (-kv[1], kv[0]))) if isinstance(v, dict) else v for k, v in out.items()}


def write_counted(df: DataFrame, path: str, counted: dict[str, Column]) -> dict:
    """Write df and return its counters, taken in the same pass."""
    seen = Observation()
    df.observe(seen, *(c.alias(name) for name, c in counted.items())).write.mode("error").parquet(path)
    return seen.get


def write_version(state: DataFrame, root: str, after: int | None = None, counted: dict[str, Column] | None = None) -> tuple[int, dict] | None:
    """Write the state as the version after a given one (by default the current), and commit it: (version, counters).

    None if another writer has committed that version; what was written is removed then.
    """
    spark = state.sparkSession
    if after is None:
        now = current_version(spark, root)
        after = now[0] if now else 0
    path = f"{root}/items/version={after + 1}-{uuid.uuid4().hex}"
    flat = write_counted(state, path, counted or {"items": F.count(F.lit(1))})
    line = {"version": after + 1, "path": path, "committed_at": dt.datetime.now(dt.UTC).isoformat()}
    if put_if_absent(spark, f"{root}/commits/{after + 1:020d}.json", json.dumps(line) + "\n"):
        return after + 1, flat
    _remove(spark, path)
    return None


def read_items(spark: SparkSession, root: str, where: str | Column | None = None, columns: list[str] | None = None) -> DataFrame | None:
    """Items of the current version, filtered and cut to columns in the scan; None before the first version."""
    now = current_version(spark, root)
    return None if now is None else _items(spark, now[1], where, columns)


def _items(spark: SparkSession, path: str, where: str | Column | None = None, columns: list[str] | None = None) -> DataFrame:
    items = spark.read.parquet(path)
    items = items if where is None else items.where(where)
    return items if columns is None else items.select(*columns)


def baseline(spark: SparkSession, root: str) -> DataFrame | None:
    """The columns that change tracking compares."""
    return read_items(spark, root, columns=BASELINE)


def change(spark: SparkSession, root: str, make: Callable[[DataFrame | None], DataFrame], attempts: int = 20, counted: dict[str, Column] | None = None) -> tuple[int, dict]:
    """Commit make(current state) as the next version; made anew from the newer state whenever another writer was first."""
    for _ in range(attempts):
        now = current_version(spark, root)
        done = write_version(make(None if now is None else _items(spark, now[1])), root, now[0] if now else 0, counted)
        if done:
            return done
    raise Conflict(f"{attempts} attempts to commit to {root} were overtaken")


def upsert(spark: SparkSession, root: str, batch: DataFrame, key: str, now: Column, attempts: int = 20) -> int:
    """Merge a batch into the state as a new version; without a state the batch is the first one."""

    def merged(state: DataFrame | None) -> DataFrame:
        if state is None:
            return batch.withColumns({"first_seen": now, "last_seen": now, "times_seen": F.lit(1)})
        return merge_state(state, batch, key, now)

    return change(spark, root, merged, attempts)[0]


def log_run(spark: SparkSession, root: str, run: dict, started: dt.datetime, finished: dt.datetime, stats: dict | None = None, attempts: int = 1000) -> int:
    """Log a finished run as a file of its own; returns its number, which no other run has."""
    run_id = (runs(spark, root).agg(F.max("run_id")).first()[0] or 0) + 1
    row = {"source_url": run.get("url"), "source_bytes": run.get("bytes"), "source_sha256": run.get("sha256"), "snapshot_date": run.get("snapshot_date"), "rows_in_csv": run.get("rows")}
    row |= {"started_at": started.isoformat(), "finished_at": finished.isoformat(), "stats": json.dumps(stats or {}, ensure_ascii=False)}
    for number in range(run_id, run_id + attempts):
        if put_if_absent(spark, f"{root}/runs/{number:020d}.json", json.dumps({"run_id": number} | row, ensure_ascii=False) + "\n"):
            return number
    raise Conflict(f"no free run number after {attempts} attempts in {root}")


def runs(spark: SparkSession, root: str) -> DataFrame:
    return _read(spark, f"{root}/runs", _RUN)


def table_counts(spark: SparkSession, root: str) -> dict[str, int]:
    """Rows of the current items, the price history and the events."""
    items = read_items(spark, root)
    out = {"items": items.count() if items is not None else 0}
    return out | {name: read_log(spark, root, name).count() for name in ("price_history", "item_events")}


def keys_compared(snapshot: DataFrame, state: DataFrame, key: str) -> DataFrame:
    """(key, side) of keys that only one side has: missing from the state, or retained from earlier snapshots."""
    a, b = snapshot.select(key).distinct(), state.select(key).distinct()
    missing = a.join(b, key, "left_anti").withColumn("side", F.lit("missing"))
    return missing.unionByName(b.join(a, key, "left_anti").withColumn("side", F.lit("retained")))


def keys_common(snapshot: DataFrame, state: DataFrame, key: str) -> DataFrame:
    """(key) of items that both have."""
    return snapshot.select(key).distinct().join(state.select(key), key, "left_semi")
