"""Materialisation: date-partitioned tables with atomic versions, and versioned small tables.

A date-partitioned table is a folder of runs (``data/run=<id>/<date>=...``) and of
manifests (``_versions/<n>.json``), each a whole version: which run holds which date.
Replacing dates writes their rows as a new run, beside everything that is there, and
then puts the next manifest in place by one rename that fails if another writer was
first. So a reader sees the old dates or the new ones, never some of each, a failed
run leaves the table as it was, and rows derived from the table itself need no staging.
Other dates keep their files. Tables lie under the caller's shared storage, never in
a machine-local folder.
"""

from __future__ import annotations

import datetime as _dt
import json
import time
import uuid
from collections.abc import Collection

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Versions that stay readable: whoever began to read the one before can finish.
KEEP = 2


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def table_versions(spark: SparkSession, base: str) -> list[int]:
    """Numbers of the versions of a date-partitioned table, oldest first."""
    fs, p = _fs(spark, f"{base.rstrip('/')}/_versions")
    if not fs.exists(p):
        return []
    names = [st.getPath().getName() for st in fs.listStatus(p)]
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def manifest(spark: SparkSession, base: str, version: int | None = None) -> dict:
    """``date_col`` and ``days`` (ISO date -> run) of a version, the last one by default; no days before the first write."""
    if version is None:
        version = max(table_versions(spark, base), default=0)
    if version == 0:
        return {"date_col": None, "days": {}}
    fs, p = _fs(spark, f"{base.rstrip('/')}/_versions/{version:08d}.json")
    stream = fs.open(p)
    try:
        return json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def _commit(spark: SparkSession, base: str, version: int, content: dict) -> bool:
    """Put a manifest in place; False if that version is there already."""
    jvm, folder = spark.sparkContext._jvm, f"{base.rstrip('/')}/_versions"
    fs, tmp = _fs(spark, f"{folder}/.{uuid.uuid4().hex}")
    out = fs.create(tmp)
    out.write(bytearray(json.dumps(content, sort_keys=True).encode()))
    out.close()
    target = jvm.org.apache.hadoop.fs.Path(f"{folder}/{version:08d}.json")
    none = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    none[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE  # fails if the target exists
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(tmp.toUri(), spark.sparkContext._jsc.hadoopConfiguration()) \
        if tmp.toUri().getScheme() else jvm.org.apache.hadoop.fs.FileContext.getFileContext(spark.sparkContext._jsc.hadoopConfiguration())
    try:
        context.rename(tmp, target, none)
        return True
    except Exception as e:
        fs.delete(tmp, False)
        if fs.exists(target):
            return False
        raise e


def read_table(spark: SparkSession, base: str, like: DataFrame, version: int | None = None,
               days: Collection[_dt.date] | None = None) -> DataFrame:
    """A date-partitioned table (one version of it), empty with the columns of ``like`` before its first write.

    ``days``: read these dates only; no other folder is listed.
    """
    known = manifest(spark, base, version)
    wanted = None if days is None else {d.isoformat() for d in days}
    held = {d: run for d, run in known["days"].items() if wanted is None or d in wanted}
    if not held:
        return spark.createDataFrame([], like.schema)
    data = f"{base.rstrip('/')}/data"
    paths = [f"{data}/run={run}/{known['date_col']}={d}" for d, run in sorted(held.items())]
    return spark.read.schema(like.schema).option("basePath", data).parquet(*paths).select(*like.columns)


def in_window(date_from: _dt.date, date_to: _dt.date, date_col: str = "fact_date"):
    return F.col(date_col).between(F.lit(date_from), F.lit(date_to))


def window_days(date_from: _dt.date, date_to: _dt.date) -> list[_dt.date]:
    return [date_from + _dt.timedelta(days=n) for n in range((date_to - date_from).days + 1)]


def replace_dates(df: DataFrame, base: str, days: Collection[_dt.date], date_col: str = "fact_date") -> int:
    """Make ``df``'s rows of ``days`` the table's rows of those dates; returns the new version's number.

    Dates without rows are gone from the new version. Other dates are not written. AQE rebalances
    the rows by date, so a large day has several files and a small one a single file. What the driver
    holds is bounded by days. If another writer commits first, the new dates go on top of its version;
    if it changed one of the same dates, this fails: the rows may have been derived from what it replaced.
    """
    spark = df.sparkSession
    base = base.rstrip("/")
    chosen = {d.isoformat() for d in days}
    run = f"{int(time.time() * 1000)}-{uuid.uuid4().hex[:8]}"
    version = max(table_versions(spark, base), default=0)
    before = manifest(spark, base, version)["days"]
    path = f"{base}/data/run={run}"
    (df.where(F.col(date_col).isin(sorted(days))).hint("rebalance", date_col).write.partitionBy(date_col).parquet(path))
    fs, p = _fs(spark, path)
    written = {n.partition("=")[2] for n in (st.getPath().getName() for st in fs.listStatus(p)) if n.startswith(f"{date_col}=")}
    while True:
        current = manifest(spark, base, version)["days"]
        if any(current.get(d) != before.get(d) for d in chosen):
            raise RuntimeError(f"another run replaced the same dates of {base}")
        new = {d: r for d, r in current.items() if d not in chosen} | dict.fromkeys(written, run)
        if _commit(spark, base, version + 1, {"date_col": date_col, "days": new}):
            break
        version = max(table_versions(spark, base))
    _forget(spark, base)
    return version + 1


def _forget(spark: SparkSession, base: str, keep: int = KEEP) -> None:
    """Delete all but the last versions, and the runs' dates that only they hold. Runs of writers under way have no version yet."""
    numbers = table_versions(spark, base)
    old, kept = numbers[:-keep], numbers[-keep:]
    if not old:
        return
    live = {(d, r) for n in kept for d, r in manifest(spark, base, n)["days"].items()}
    fs, _ = _fs(spark, base)
    for n in old:
        gone = manifest(spark, base, n)
        for d, r in set(gone["days"].items()) - live:
            fs.delete(_fs(spark, f"{base}/data/run={r}/{gone['date_col']}={d}")[1], True)
        fs.delete(_fs(spark, f"{base}/_versions/{n:08d}.json")[1], False)


def replace_window(df: DataFrame, base: str, date_from: _dt.date, date_to: _dt.date, date_col: str = "fact_date") -> int:
    """Make ``df``'s rows of [from, to] the table's rows of that window."""
    return replace_dates(df, base, window_days(date_from, date_to), date_col)


def versions(spark: SparkSession, base: str) -> list[str]:
    """Complete versions (``v=<n>`` with a success marker), oldest first."""
    fs, p = _fs(spark, base)
    if not fs.exists(p):
        return []
    names = [st.getPath() for st in fs.listStatus(p) if st.getPath().getName().startswith("v=")]
    done = [x.getName() for x in names if fs.exists(x.suffix("/_SUCCESS"))]
    return sorted(done, key=lambda n: int(n[2:]))


def read_latest(spark: SparkSession, base: str) -> DataFrame | None:
    vs = versions(spark, base)
    return spark.read.parquet(f"{base.rstrip('/')}/{vs[-1]}") if vs else None


def write_new_version(df: DataFrame, base: str, keep: int = 2) -> str:
    """Write ``df`` as the next version of ``base`` (for tables that are replaced whole) and
    return its path. The last ``keep`` versions stay: a reader of the one before can finish."""
    spark = df.sparkSession
    path = f"{base.rstrip('/')}/v={int(time.time() * 1000)}"
    df.write.mode("errorifexists").parquet(path)
    fs, _ = _fs(spark, base)
    for old in versions(spark, base)[:-keep]:
        fs.delete(_fs(spark, f"{base.rstrip('/')}/{old}")[1], True)
    return path
