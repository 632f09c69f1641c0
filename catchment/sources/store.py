"""Table store on a shared file system (any Hadoop-compatible URI).

* Day-partitioned tables (bronze, silver, gold) are rewritten one partition
  at a time with dynamic partition overwrite: a job only replaces the days
  it produced, and all output is staged until the job commits, so a lost
  executor only re-runs tasks.
* Unpartitioned tables (``ref.*``, ``snapshots.*``) are never overwritten in
  place (a static overwrite of a path the plan reads deletes it first).
  Each write goes to a new version folder, then a small ``_CURRENT`` pointer
  is replaced; readers follow the pointer.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

PARTITIONED = {
    "bronze.hydro": "dt",
    "bronze.meteo": "dt",
    "silver.hydro": "dt",
    "silver.meteo": "dt",
    "silver.meteo_station_names": "month",
    "gold.hydro_meteo": "dt",
    "gold.repeated_hours": "dt",
}


class _FS:
    """Minimal Hadoop FileSystem access through the session's JVM."""

    def __init__(self, spark: SparkSession):
        self._jvm = spark._jvm
        self._gateway = spark.sparkContext._gateway
        self._conf = spark._jsc.hadoopConfiguration()

    def _p(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def _fs(self, path: str):
        return self._p(path).getFileSystem(self._conf)

    def exists(self, path: str) -> bool:
        return bool(self._fs(path).exists(self._p(path)))

    def write_text(self, path: str, text: str) -> None:
        tmp = f"{path}.{uuid.uuid4().hex}.tmp"
        fs = self._fs(path)
        out = fs.create(self._p(tmp), True)
        out.write(bytearray(text.encode("utf-8")))
        out.close()
        # one replacing rename: a reader sees the old or the new text, never none
        rename = getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename")
        replace = self._gateway.new_array(rename, 1)
        replace[0] = rename.OVERWRITE
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), self._conf)
        context.rename(self._p(tmp), self._p(path), replace)

    def read_text(self, path: str) -> str | None:
        if not self.exists(path):
            return None
        fs = self._fs(path)
        stream = fs.open(self._p(path))
        reader = self._jvm.java.io.BufferedReader(self._jvm.java.io.InputStreamReader(stream, "UTF-8"))
        line = reader.readLine()
        reader.close()
        return line

    def glob(self, pattern: str) -> list[str]:
        """Paths matching a Hadoop glob (``{a,b}`` alternation, ``*``): one
        listing call instead of one existence check per path."""
        found = self._fs(pattern).globStatus(self._p(pattern))
        return [str(st.getPath().toString()) for st in found] if found else []

    def list_dirs(self, path: str) -> list[str]:
        if not self.exists(path):
            return []
        return [s.getPath().getName() for s in self._fs(path).listStatus(self._p(path)) if s.isDirectory()]

    def list_files(self, path: str) -> list[str]:
        if not self.exists(path):
            return []
        return [s.getPath().getName() for s in self._fs(path).listStatus(self._p(path)) if not s.isDirectory()]

    def rename(self, old: str, new: str) -> bool:
        return bool(self._fs(old).rename(self._p(old), self._p(new)))

    def delete(self, path: str, recursive: bool = True) -> None:
        if self.exists(path):
            self._fs(path).delete(self._p(path), recursive)


@dataclass(frozen=True)
class Mark:
    """A write of some days of a table that no build has covered yet; ``done``
    once the write has been committed."""

    path: str
    table: str
    days: tuple[dt.date, ...]
    done: bool


class Ledger:
    """Write-ahead record of the days that writes touched and that what is
    derived from them does not show yet.

    A writer opens a mark (one small file that lists its days) before it
    writes, and closes it after the commit. A build reads all marks first,
    covers their days, and clears those that were closed when it read them: a
    write that commits while the build runs keeps its mark for the next one.
    An open mark whose writer died is closed by the table's next writer (a
    table has one writer at a time); until then every build covers its days.
    """

    def __init__(self, fs: _FS, path: str):
        self.fs = fs
        self.path = path

    @contextmanager
    def writing(self, table: str, days: Sequence[dt.date]):
        folder = f"{self.path}/{table}"
        for name in self.fs.list_files(folder):
            if name.endswith(".open"):
                self.fs.rename(f"{folder}/{name}", f"{folder}/{name.removesuffix('.open')}.done")
        mark = f"{folder}/{uuid.uuid4().hex}"
        self.fs.write_text(f"{mark}.open", json.dumps([str(d) for d in days]))
        yield
        self.fs.rename(f"{mark}.open", f"{mark}.done")

    def marks(self) -> list[Mark]:
        out = []
        for table in self.fs.list_dirs(self.path):
            for name in self.fs.list_files(f"{self.path}/{table}"):
                stem, _, state = name.rpartition(".")
                if state not in ("open", "done"):
                    continue
                text = self.fs.read_text(f"{self.path}/{table}/{name}")
                if text is None and state == "open":  # closed since the listing
                    text = self.fs.read_text(f"{self.path}/{table}/{stem}.done")
                days = tuple(dt.date.fromisoformat(d) for d in json.loads(text or "[]"))
                out.append(Mark(f"{self.path}/{table}/{name}", table, days, state == "done"))
        return out

    def clear(self, marks: Sequence[Mark]) -> None:
        for m in marks:
            if m.done:
                self.fs.delete(m.path)


class Lakehouse:
    """Named tables under ``root``: ``schema.table`` -> ``root/schema/table``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.fs = _FS(spark)
        self.ledger = Ledger(self.fs, f"{self.root}/_LEDGER")

    def path(self, name: str) -> str:
        schema, table = name.split(".", 1)
        return f"{self.root}/{schema}/{table}"

    # ---- reading --------------------------------------------------------
    def current_path(self, name: str) -> str | None:
        if name in PARTITIONED:
            p = self.path(name)
            return p if self.fs.exists(p) else None
        version = self.current_version(name)
        return f"{self.path(name)}/{version}" if version else None

    def current_version(self, name: str) -> str | None:
        """The version that the pointer names; without a pointer the newest
        committed one. A folder with versions but none committed is an error,
        not an empty table: history must not start afresh unnoticed."""
        version = self.fs.read_text(f"{self.path(name)}/_CURRENT")
        if version:
            return version
        versions = self.versions(name)
        done = [v for v in versions if self.fs.exists(f"{self.path(name)}/{v}/_SUCCESS")]
        if versions and not done:
            raise RuntimeError(f"{name}: no pointer and no committed version under {self.path(name)}")
        return done[-1] if done else None

    def versions(self, name: str) -> list[str]:
        """All stored versions, oldest first."""
        return sorted(v for v in self.fs.list_dirs(self.path(name)) if v.startswith("v"))

    def exists(self, name: str) -> bool:
        return self.current_path(name) is not None

    def read(self, name: str) -> DataFrame | None:
        p = self.current_path(name)
        return self.spark.read.parquet(p) if p else None

    # ---- writing --------------------------------------------------------
    def overwrite_partitions(self, name: str, df: DataFrame) -> None:
        """Replace exactly the partitions present in ``df`` (dynamic mode).

        A REBALANCE on the partition column lets adaptive execution cut the
        output into advisory-sized tasks aligned with days (a big day is
        split, small days are merged), so a many-day backfill does not write
        tasks x days small files.
        """
        part = PARTITIONED[name]
        (
            df.hint("rebalance", part)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(part)
            .parquet(self.path(name))
        )

    def write_version(self, name: str, df: DataFrame) -> str:
        """Write ``df`` as a new version and switch the pointer to it."""
        stamp = dt.datetime.now(dt.timezone.utc).strftime("%Y%m%dT%H%M%S%f")
        version = f"v{stamp}-{uuid.uuid4().hex[:8]}"
        df.write.mode("errorifexists").parquet(f"{self.path(name)}/{version}")
        self.fs.write_text(f"{self.path(name)}/_CURRENT", version)
        return version

    def prune_versions(self, name: str, older_than: dt.datetime) -> list[str]:
        """Maintenance, never run by a job: delete the versions written before
        ``older_than`` (UTC) other than the current one. Choose it older than
        the longest reader."""
        current, limit = self.current_version(name), older_than.strftime("v%Y%m%dT%H%M%S%f")
        old = [v for v in self.versions(name) if v < limit and v != current]
        for v in old:
            self.fs.delete(f"{self.path(name)}/{v}")
        return old

    def register_views(self, names: Sequence[str] | None = None) -> list[str]:
        """Temp views ``<schema>_<table>`` over the current version of each
        table, for SQL users (e.g. ``SELECT * FROM gold_hydro_meteo``)."""
        names = list(names) if names is not None else list(PARTITIONED) + [
            "ref.hydro_stations",
            "ref.meteo_stations",
            "ref.station_proximity",
            "snapshots.snap_hydro_stations",
            "snapshots.snap_meteo_stations",
        ]
        made = []
        for name in names:
            df = self.read(name)
            if df is not None:
                view = name.replace(".", "_")
                df.createOrReplaceTempView(view)
                made.append(view)
        return made

    def read_version(self, name: str, version: str | None) -> DataFrame | None:
        """One stored version; ``None`` when it has been pruned."""
        path = f"{self.path(name)}/{version}"
        return self.spark.read.parquet(path) if version and self.fs.exists(f"{path}/_SUCCESS") else None

    def read_partitions(self, name: str, values: Sequence) -> DataFrame | None:
        """Only the given partitions of a partitioned table.

        The folders are found with one glob listing, so a table with years of
        daily partitions is not listed in full; ``basePath`` keeps the
        partition column. ``None`` when none of the partitions exists.
        """
        part = PARTITIONED[name]
        base = self.path(name)
        values = [str(v) for v in values]
        if not values:
            return None
        found = self.fs.glob(f"{base}/{part}={{{','.join(values)}}}")
        if not found:
            return None
        return self.spark.read.option("basePath", base).parquet(*found)
