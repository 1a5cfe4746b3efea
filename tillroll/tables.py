"""Versioned tables on plain Parquet.

A table folder holds ``data/<id>/`` directories, written once and never
changed, and a ``history/`` of small JSON records, one per version in a
directory of its own.  A version exists from the moment its record is written,
which is the last step of every commit; data of a commit that failed before
that is never read.  One writer at a time.

What a version costs:

* append and merge write the new rows only;
* a delete writes the surviving rows, so nothing is evaluated again by a read;
  several deletes in a row share one pass and one copy;
* checks are counted while the new rows are written, so there is no extra pass.

A table may be partitioned by columns, which all later versions keep.  Any text
is a partition value, the empty one too (``functions/partitions.py``).
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterable, Mapping, Sequence
from datetime import datetime, timezone
from functools import reduce
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.functions.partitions import encoded, restored
from tillroll.functions.predicates import survives_delete
from tillroll.functions.workspace import files_open
from tillroll.operators.membership import estimated_bytes, possible_partners, small_side

_RECORD = (
    "version BIGINT, timestamp TIMESTAMP, operation STRING, "
    "operationParameters MAP<STRING,STRING>, operationMetrics MAP<STRING,BIGINT>, "
    "schema STRING, checks MAP<STRING,STRING>, "
    "parts ARRAY<STRUCT<path: STRING, schema: STRING>>, partitionColumns ARRAY<STRING>"
)

_STEP = "_deleted_by"

class CheckViolation(Exception):
    """Rows break a table check; nothing was published."""

    def __init__(self, broken: Mapping[str, int]):
        self.broken = dict(broken)
        listed = ", ".join(f"{name} ({rows} rows)" for name, rows in broken.items())
        super().__init__(f"check violated: {listed}")


def check_counters(checks: Mapping[str, str]) -> list[Column]:
    """Rows for which a check is not true; here NULL counts as broken."""
    return [F.count_if(survives_delete(p)).alias(f"check:{n}") for n, p in checks.items()]


class VersionedTable:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    # -- reading ---------------------------------------------------------

    def history(self) -> DataFrame:
        """Version, time, operation, parameters and metrics, newest first."""
        return (
            self._records()
            .select(
                "version", "timestamp", "operation", "operationParameters", "operationMetrics"
            )
            .orderBy(F.col("version").desc())
        )

    def exists(self) -> bool:
        return self._last() is not None

    def version(self) -> int:
        return self._needed(None)["version"]

    def checks(self) -> dict[str, str]:
        return dict(self._needed(None)["checks"] or {})

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of ``version``, by default the latest."""
        return self._frame(self._needed(version))

    def create_view(self, name: str, version: int | None = None) -> None:
        self.read(version).createOrReplaceTempView(name)

    # -- writing ---------------------------------------------------------

    def overwrite(self, df: DataFrame, operation: str = "WRITE",
                  gate: Iterable[Column] = (), accept=None,
                  partition_cols: Sequence[str] | None = None) -> dict[str, int]:
        """Replace the content.

        ``partition_cols`` lay the rows out in directories, here and in later
        versions; None keeps the layout of the version before.  ``gate`` are extra aggregates counted during the write; ``accept`` is
        called with all counts and may raise to keep the version back.
        """
        last = self._last()
        checks = dict(last["checks"] or {}) if last else {}
        layout = _layout(last) if partition_cols is None else list(partition_cols)
        part, counts = self._write(df, checks, gate, layout)
        if accept is not None:
            accept(counts)
        self._publish(
            last, operation, {"mode": "overwrite"}, {"numOutputRows": counts["row_count"]},
            df.schema, checks, [part], layout,
        )
        return counts

    def append(self, df: DataFrame, operation: str = "APPEND",
               parameters: Mapping[str, str] | None = None) -> int:
        """Add rows; new columns extend the table, missing ones become NULL."""
        last = self._needed(None)
        schema = _schema(last["schema"])
        wider = _extended(schema, df.schema)
        fitted = _completed(df, wider)
        checks = dict(last["checks"] or {})
        part, counts = self._write(fitted, checks, layout=_layout(last))
        self._publish(
            last, operation, dict(parameters or {"mode": "append"}),
            {"numOutputRows": counts["row_count"]},
            wider, checks, [*_parts(last), part], _layout(last),
        )
        return counts["row_count"]

    def delete_where(self, predicate: str) -> int:
        """Remove rows for which ``predicate`` is true; NULL keeps the row."""
        return self.delete_each([predicate])[0]

    def delete_each(self, predicates: Sequence[str]) -> list[int]:
        """One delete, and one version, for each predicate, in order.

        The rows are read once.  Each is marked with the first predicate that
        removes it and written once, by mark; a version is the directories of
        the marks after its own.  A predicate is evaluated here and never again.
        """
        last = self._needed(None)
        schema, layout = _schema(last["schema"]), _layout(last)
        checks = dict(last["checks"] or {})
        mark = F.lit(len(predicates))
        for i, predicate in reversed(list(enumerate(predicates))):
            mark = F.when(F.coalesce(F.expr(predicate), F.lit(False)), F.lit(i)).otherwise(mark)
        path = f"data/{uuid.uuid4().hex}"
        seen = Observation(uuid.uuid4().hex)
        marked = self._frame(last).withColumn(_STEP, mark).observe(
            seen, *[F.count_if(F.col(_STEP) == i).alias(str(i)) for i in range(len(predicates) + 1)])
        # What the first delete removes is in the older version only.
        # Without a layout there are no more directories than marks: a task keeps a file of each open
        # and does not sort its rows by them.
        with files_open(self.spark, 0 if layout else len(predicates)):
            encoded(marked.where(F.col(_STEP) > 0), layout).write.partitionBy(_STEP, *layout).parquet(
                f"{self.root}/{path}")
        deleted = [seen.get[str(i)] for i in range(len(predicates) + 1)]
        parts = [{"path": f"{path}/{_STEP}={i}", "schema": schema.json()} if n else None
                 for i, n in enumerate(deleted)]
        for i, predicate in enumerate(predicates):
            last = self._publish(
                last, "DELETE", {"predicate": predicate}, {"numDeletedRows": deleted[i]},
                schema, checks, [p for p in parts[i + 1:] if p], layout,
            )
        return deleted[:-1]

    def merge_insert(self, source: DataFrame, keys: Sequence[str]) -> int:
        """Insert source rows whose keys the table does not hold.

        Plain equality: a NULL key never matches, so its row is inserted.
        Matched rows stay as they are and repeated source rows are all
        inserted.  Where the source is smaller than the table, a filter of fixed size over
        the source's keys, which are read once more for it, keeps table rows that can have
        no partner from being moved.  Elsewhere the keys of a small table go to the rows of the
        source.  Otherwise both join inputs come straight from their exchange, which lets
        adaptive execution split a hot key of the source.
        """
        known = self.read().select(*keys)
        if estimated_bytes(source.select(*keys)) < estimated_bytes(known):
            known = possible_partners(known, source, keys)
        else:
            known = small_side(known)
        fresh = source.join(known, on=list(keys), how="left_anti").select(*source.columns)
        return self.append(
            fresh, "MERGE", {"keys": ",".join(keys), "notMatched": "insert"}
        )

    def add_check(self, name: str, predicate: str) -> None:
        """Hold every row, present and future, to ``predicate`` being true."""
        self.add_checks({name: predicate})

    def add_checks(self, predicates: Mapping[str, str]) -> None:
        """Several checks, counted in one pass over the rows; a version for each."""
        last = self._needed(None)
        checks = dict(last["checks"] or {})
        for name in predicates:
            if name in checks:
                raise ValueError(f"the table already has a check {name!r}")
        _raise_if_broken(self._frame(last).agg(*check_counters(predicates)).first().asDict())
        for name, predicate in predicates.items():
            checks = {**checks, name: predicate}
            last = self._publish(
                last, "ADD CONSTRAINT", {"name": name, "expr": predicate}, {},
                _schema(last["schema"]), checks, _parts(last), _layout(last),
            )

    # -- records ---------------------------------------------------------

    def _records(self) -> DataFrame:
        return self.spark.read.schema(_RECORD).json(f"{self.root}/history")

    def _versions(self) -> list[int]:
        """The versions there are, from the names of their files: no job, no reading."""
        try:
            files = self._records().inputFiles()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return []
        return sorted({int(m[1]) for f in files if (m := re.search(r"/version=(\d+)/", f))})

    def _needed(self, version: int | None):
        versions = self._versions()
        wanted = (versions[-1] if versions else None) if version is None else version
        if wanted not in versions:
            raise ValueError(f"{self.root} has no version {version}")
        row = self.spark.read.schema(_RECORD).json(
            f"{self.root}/history/version={wanted}").first()
        return {**row.asDict(), "version": wanted}

    def _last(self):
        """The newest record, or None where there is no table yet."""
        return self._needed(None) if self._versions() else None

    def _publish(self, last, operation: str, parameters: dict[str, str],
                 metrics: dict[str, int], schema: T.StructType, checks: dict[str, str],
                 parts: list[dict[str, Any]], layout: list[str]) -> dict[str, Any]:
        record = {
            "version": last["version"] + 1 if last else 0,
            "timestamp": datetime.now(timezone.utc),
            "operation": operation,
            "operationParameters": parameters,
            "operationMetrics": metrics,
            "schema": schema.json(),
            "checks": checks,
            "parts": parts,
            "partitionColumns": layout,
        }
        self.spark.createDataFrame([record], _RECORD).coalesce(1).write.partitionBy(
            "version").mode("append").json(f"{self.root}/history")
        return record

    # -- data ------------------------------------------------------------

    def _write(self, df: DataFrame, checks: Mapping[str, str],
               gate: Iterable[Column] = (), layout: Sequence[str] = (),
               ) -> tuple[dict[str, Any], dict[str, int]]:
        """Write rows to a new directory; count rows, checks and gate with it.

        The observation is the last step before the write and thus in its
        stage, where a repeated task is counted once.
        """
        path = f"data/{uuid.uuid4().hex}"
        seen = Observation(uuid.uuid4().hex)
        encoded(df.observe(
            seen, F.count(F.lit(1)).alias("row_count"), *check_counters(checks), *gate
        ), layout).write.partitionBy(*layout).parquet(f"{self.root}/{path}")
        counts = dict(seen.get)
        _raise_if_broken(counts)
        return {"path": path, "schema": df.schema.json()}, counts

    def _frame(self, record) -> DataFrame:
        """Union of the parts; parts of one schema and no layout share a scan."""
        columns = _schema(record["schema"])
        alike: dict[tuple[str, str], list[str]] = {}
        for part in _parts(record):
            own = part["path"] if _layout(record) else ""
            alike.setdefault((part["schema"], own), []).append(f"{self.root}/{part['path']}")
        frames = [
            _completed(restored(self.spark.read.schema(_schema(schema)).parquet(*paths),
                                _layout(record)), columns)
            for (schema, _), paths in alike.items()
        ]
        return reduce(DataFrame.unionByName, frames) if frames else (
            self.spark.createDataFrame([], columns))


def _schema(text: str) -> T.StructType:
    return T.StructType.fromJson(json.loads(text))


def _parts(record) -> list[dict[str, Any]]:
    return [{"path": p["path"], "schema": p["schema"]} for p in record["parts"]]


def _layout(record) -> list[str]:
    return list(record["partitionColumns"] or []) if record else []


def _raise_if_broken(counts: Mapping[str, int]) -> None:
    broken = {
        name.removeprefix("check:"): rows
        for name, rows in counts.items()
        if name.startswith("check:") and rows
    }
    if broken:
        raise CheckViolation(broken)


def _completed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with exactly the columns of ``schema``: cast, or NULL if absent."""
    have = {f.name: f.dataType.simpleString() for f in df.schema}

    def column(f: T.StructField) -> Column:
        if have.get(f.name) == f.dataType.simpleString():
            return F.col(f.name)
        found = F.col(f.name) if f.name in have else F.lit(None)
        return found.cast(f.dataType).alias(f.name)

    return df.select(*[column(f) for f in schema])


def _extended(schema: T.StructType, more: T.StructType) -> T.StructType:
    names = set(schema.fieldNames())
    added = [T.StructField(f.name, f.dataType, True) for f in more if f.name not in names]
    return T.StructType([*[T.StructField(f.name, f.dataType, True) for f in schema], *added])
