"""Versioned Parquet tables: every write is a new, immutable version.

Layout of a table folder::

    data/commit_version=<n>/attempt=<id>/…    the files version n added
    log/<n>/                                  one JSON row per version

The log row is written last, so a version exists only once its data does. Every
attempt at a commit has a folder of its own: what a lost job left behind is in
no log row, and a writer that lags behind fails on the log row without touching
what others committed. A log row lists the data folders its content consists
of, with their row counts: an append adds one to those of its parent, an
overwrite starts anew, a delete replaces only the folders that hold matching
rows, a change of schema keeps them all. Reading a version reads its folders
and lists nothing else.

One writer per table at a time.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LOG_SCHEMA = T.StructType(
    [
        T.StructField("version", T.LongType(), False),
        T.StructField("parent_version", T.LongType(), True),
        T.StructField("committed_at", T.TimestampType(), False),
        T.StructField("operation", T.StringType(), False),
        T.StructField("summary", T.MapType(T.StringType(), T.StringType()), False),
        T.StructField("schema", T.StringType(), False),
        T.StructField("partition_by", T.ArrayType(T.StringType()), False),
        T.StructField("split_by", T.StringType(), True),
        T.StructField("parts", T.ArrayType(T.StringType()), False),
        T.StructField("part_records", T.ArrayType(T.LongType()), False),
    ]
)
VERSION_COLUMN = "commit_version"
ATTEMPT_COLUMN = "attempt"
STORED_NAME = "stored_name"


def _stored(field: T.StructField) -> str:
    """Column name in the files, which a rename leaves as it was."""
    return (field.metadata or {}).get(STORED_NAME, field.name)


def _stored_schema(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(_stored(f), f.dataType, True) for f in schema.fields])


def _schema(entry: dict) -> T.StructType:
    return T.StructType.fromJson(json.loads(entry["schema"]))


@dataclass(frozen=True)
class VersionedTable:
    spark: SparkSession
    path: str

    # ---- log -------------------------------------------------------------

    def log(self) -> DataFrame:
        """One row per version: when, what, how many rows and files."""
        return self.spark.read.schema(LOG_SCHEMA).option("recursiveFileLookup", "true").json(f"{self.path}/log")

    def _logged(self, version: int | None) -> dict | None:
        rows = self.log() if version is None else self.log().filter(F.col("version") == version)
        found = rows.orderBy(F.desc("version")).limit(1).collect()
        return found[0].asDict(recursive=True) if found else None

    def newest(self) -> dict | None:
        """Log row of the newest version, None for a table that was never written."""
        try:
            return self._logged(None)
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return None
            raise

    def exists(self) -> bool:
        return self.newest() is not None

    def entry(self, version: int | None = None) -> dict:
        """Log row of a version, by default the newest; an unknown version raises."""
        found = self.newest() if version is None else self._logged(version)
        if found is None:
            raise LookupError(f"{self.path} has no version {'at all' if version is None else version}")
        return found

    def history(self) -> DataFrame:
        """Versions with their parent and the counts of their summary."""
        return self.log().select(
            "version",
            "parent_version",
            F.date_format("committed_at", "yyyy-MM-dd HH:mm:ss").alias("committed_at"),
            "operation",
            F.col("summary")["added-records"].cast("bigint").alias("added_records"),
            F.col("summary")["total-records"].cast("bigint").alias("total_records"),
            F.col("summary")["added-data-files"].cast("bigint").alias("added_data_files"),
        )

    # ---- read ------------------------------------------------------------

    def schema(self, version: int | None = None) -> T.StructType:
        return _schema(self.entry(version))

    def _scan(self, entry: dict) -> DataFrame:
        stored = (
            _stored_schema(_schema(entry)).add(VERSION_COLUMN, T.LongType()).add(ATTEMPT_COLUMN, T.StringType())
        )
        if not entry["parts"]:
            return self.spark.createDataFrame([], stored)
        return (
            self.spark.read.schema(stored)
            .option("basePath", f"{self.path}/data")
            .parquet(*[f"{self.path}/data/{part}" for part in entry["parts"]])
        )

    def read(self, version: int | None = None) -> DataFrame:
        """The table as of a version. Columns a file lacks are NULL."""
        return self.read_entry(self.entry(version))

    def read_entry(self, entry: dict) -> DataFrame:
        """The content a log row stands for."""
        return _named(self._scan(entry), _schema(entry))

    def added_since(self, version: int) -> DataFrame | None:
        """Rows added after a version; None if that version's data is not all there any more."""
        newest, older = self.entry(), self.entry(version)
        if not set(older["parts"]) <= set(newest["parts"]):
            return None
        return self.read_entry({**newest, "parts": [p for p in newest["parts"] if p not in older["parts"]]})

    def files(self, version: int | None = None) -> DataFrame:
        """Data files of a version with row count and size."""
        entry = self.entry(version)
        if not entry["parts"]:
            return self.spark.createDataFrame([], "file_path string, file_size_in_bytes bigint, record_count bigint")
        return data_files(self._scan(entry))

    # ---- write -----------------------------------------------------------

    def append(self, df: DataFrame, partition_by: list[str] | None = None, **labels: str) -> int:
        """Add rows. Known columns are matched by name, missing ones are NULL."""
        parent = self.newest()
        if parent is None:
            return self._commit(None, "append", _plain(df.schema), df, partition_by or [], labels=labels)
        schema = _schema(parent)
        unknown = [c for c in df.columns if c not in schema.names]
        if unknown:
            raise ValueError(f"columns {unknown} are not in the table, add them first")
        aligned = df.select(
            *[
                (F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                for f in schema.fields
            ]
        )
        return self._commit(
            parent, "append", schema, aligned, parent["partition_by"], parent["split_by"], parent["parts"], labels
        )

    def overwrite(
        self,
        df: DataFrame,
        operation: str = "overwrite",
        partition_by: list[str] | None = None,
        split_by: str | None = None,
        **labels: str,
    ) -> int:
        """Replace the content; the frame may read this very table.

        A table with ``split_by``, a column of few values, can later replace
        the rows of single values with ``replace_split``.
        """
        parent = self.newest()
        if partition_by is None:
            partition_by = parent["partition_by"] if parent else []
        return self._commit(parent, operation, _plain(df.schema), df, partition_by, split_by, labels=labels)

    def replace_split(self, df: DataFrame, values: list, **labels: str) -> int:
        """Replace the rows whose split column has one of the values, add all of the frame."""
        parent = self.entry()
        replaced = tuple(f"/{parent['split_by']}={_folder_value(v)}" for v in values)
        kept = [part for part in parent["parts"] if not part.endswith(replaced)]
        schema = _schema(parent)
        return self._commit(
            parent,
            "overwrite",
            schema,
            df.select(*schema.names),
            parent["partition_by"],
            parent["split_by"],
            kept,
            labels,
        )

    def delete_where(self, predicate: Column) -> int:
        """Delete rows for which the predicate is true; NULL keeps the row.

        Only the parts that hold such rows are written again.
        """
        parent = self.entry()
        schema = _schema(parent)
        scan = self._scan(parent)
        located = [VERSION_COLUMN, ATTEMPT_COLUMN] + ([parent["split_by"]] if parent["split_by"] else [])
        names = [f"`{_stored(f)}`" for f in schema.fields]
        rows = scan.select(
            F.struct(*located).alias("_part"), *[F.col(n).alias(f.name) for n, f in zip(names, schema.fields)]
        )
        touched = [
            "/".join(f"{c}={_folder_value(row[c])}" for c in located)
            for row in rows.filter(predicate).select("_part.*").distinct().collect()
        ]
        kept_parts = [part for part in parent["parts"] if part not in touched]
        if not touched:
            return self._commit(
                parent, "delete", schema, None, parent["partition_by"], parent["split_by"], kept_parts
            )
        kept_rows = _named(self._scan({**parent, "parts": touched}), schema).filter(
            ~F.coalesce(predicate, F.lit(False))
        )
        return self._commit(
            parent, "delete", schema, kept_rows, parent["partition_by"], parent["split_by"], kept_parts
        )

    def recreate(self, schema: T.StructType, partition_by: list[str] | None = None) -> int:
        """Empty table of a new schema; earlier versions stay readable."""
        return self._commit(self.newest(), "create", _plain(schema), None, partition_by or [])

    def add_columns(self, columns: dict[str, str]) -> int:
        """Add columns that are not there yet, without rewriting a file."""
        parent = self.entry()
        schema = _schema(parent)
        added = [(n, t) for n, t in columns.items() if n not in schema.names]
        if not added:
            return parent["version"]
        taken = {_stored(f) for f in schema.fields}
        for name, data_type in added:
            stored = name if name not in taken else f"{name}_{parent['version'] + 1}"
            schema = schema.add(T.StructField(name, T.DataType.fromDDL(data_type), True, {STORED_NAME: stored}))
        return self._change_schema(parent, "add-columns", schema)

    def rename_column(self, old: str, new: str) -> int:
        """Rename a column without rewriting a file."""
        parent = self.entry()
        schema = _schema(parent)
        if old not in schema.names or new in schema.names:
            raise ValueError(f"cannot rename {old} to {new}")
        if old in [*parent["partition_by"], parent["split_by"]]:
            raise ValueError(f"partition column {old} cannot be renamed")
        fields = [
            T.StructField(new, f.dataType, f.nullable, {STORED_NAME: _stored(f)}) if f.name == old else f
            for f in schema.fields
        ]
        return self._change_schema(parent, "rename-column", T.StructType(fields))

    def _change_schema(self, parent: dict, operation: str, schema: T.StructType) -> int:
        return self._commit(
            parent, operation, schema, None, parent["partition_by"], parent["split_by"], parent["parts"]
        )

    def _commit(
        self,
        parent: dict | None,
        operation: str,
        schema: T.StructType,
        df: DataFrame | None,
        partition_by: list[str],
        split_by: str | None = None,
        kept_parts: list[str] | None = None,
        labels: dict[str, str] | None = None,
    ) -> int:
        version = parent["version"] + 1 if parent else 1
        parts = list(kept_parts or [])
        counted = dict(zip(parent["parts"], parent["part_records"])) if parts else {}
        added = {"records": 0, "files": 0, "bytes": 0}
        if df is not None:
            own = f"{VERSION_COLUMN}={version}/{ATTEMPT_COLUMN}=a{uuid.uuid4().hex}"
            folder = f"{self.path}/data/{own}"
            stored = df.select(*[F.col(f"`{f.name}`").alias(_stored(f)) for f in schema.fields])
            folders = ([split_by] if split_by else []) + [c for c in partition_by if c != split_by]
            if folders:
                # Few files per folder; AQE splits a folder too large for one task.
                stored = stored.hint("rebalance", *folders)
            stored.write.mode("error").partitionBy(*folders).parquet(folder)
            # Counted from the footers of what was really written.
            written = self.spark.read.schema(_stored_schema(schema)).parquet(folder)
            by_value = _totals(written, split_by)
            added = {name: sum(totals[name] for totals in by_value.values()) for name in added}
            for value, totals in sorted(by_value.items(), key=lambda item: str(item[0])):
                part = f"{own}/{split_by}={_folder_value(value)}" if split_by else own
                parts.append(part)
                counted[part] = totals["records"]
        part_records = [counted[part] for part in parts]
        summary = {
            "added-records": str(added["records"]),
            "added-data-files": str(added["files"]),
            "added-files-size": str(added["bytes"]),
            "total-records": str(sum(part_records)),
            **(labels or {}),
        }
        row = {
            "version": version,
            "parent_version": parent["version"] if parent else None,
            "committed_at": datetime.now(timezone.utc).isoformat(),
            "operation": operation,
            "summary": summary,
            "schema": schema.json(),
            "partition_by": partition_by,
            "split_by": split_by,
            "parts": parts,
            "part_records": part_records,
        }
        log_row = self.spark.range(0, 1, 1, 1).select(F.lit(json.dumps(row)).alias("value"))
        log_row.write.mode("error").text(f"{self.path}/log/{version}")
        return version


def _plain(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, f.nullable) for f in schema.fields])


def _named(scan: DataFrame, schema: T.StructType) -> DataFrame:
    return scan.select(*[F.col(f"`{_stored(f)}`").alias(f.name) for f in schema.fields])


# What Spark's writer calls the folder of NULL, and the characters it escapes in folder names.
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"
ESCAPED = set("\"#%'*/:=?\\\x7f{[]^") | {chr(code) for code in range(1, 32)}


def _folder_value(value) -> str:
    """A partition value as the writer names its folder."""
    text = str(value).lower() if isinstance(value, bool) else str(value)
    if value is None or text == "":
        return NULL_FOLDER
    return "".join(f"%{ord(c):02X}" if c in ESCAPED else c for c in text)


def _totals(scan: DataFrame, split_by: str | None = None) -> dict:
    """Rows, non-empty files and bytes per split value, in one aggregate that reads no other column."""
    is_first = F.col("_metadata.row_index") == 0
    measures = [
        F.count(F.lit(1)).alias("records"),
        F.count_if(is_first).alias("files"),
        F.coalesce(F.sum(F.when(is_first, F.col("_metadata.file_size"))), F.lit(0)).alias("bytes"),
    ]
    if split_by is None:
        return {None: scan.agg(*measures).first().asDict()}
    return {row[split_by]: row.asDict() for row in scan.groupBy(split_by).agg(*measures).collect()}


# ---- frames about files, partitions and tables -----------------------------


def data_files(scan: DataFrame) -> DataFrame:
    """Path, rows and size of every non-empty file a scan reads; footers only."""
    return scan.groupBy(
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_size").alias("file_size_in_bytes"),
    ).agg(F.count(F.lit(1)).alias("record_count"))


def file_stats(scan: DataFrame, columns: list[str], by: list[Column] | None = None) -> DataFrame:
    """Rows and per-column min, max and null count of every data file (or group)."""
    groups = by or [F.col("_metadata.file_path").alias("file_path")]
    measures = [F.count(F.lit(1)).alias("record_count")]
    for c in columns:
        measures += [
            F.min(c).alias(f"{c}_min"),
            F.max(c).alias(f"{c}_max"),
            F.count_if(F.col(c).isNull()).alias(f"{c}_nulls"),
        ]
    return scan.groupBy(*groups).agg(*measures)


def partition_stats(scan: DataFrame, partition_by: list[str]) -> DataFrame:
    """Rows and number of data files of every partition."""
    per_file = scan.groupBy(*partition_by, F.col("_metadata.file_path").alias("_file")).agg(
        F.count(F.lit(1)).alias("_rows")
    )
    return per_file.groupBy(*partition_by).agg(
        F.sum("_rows").alias("record_count"), F.count(F.lit(1)).alias("file_count")
    )


def compare_versions(table: VersionedTable, left: int, right: int) -> DataFrame:
    """Rows that only one of two versions holds, with how often.

    Columns are the same if they are stored as the same, whatever their name:
    a renamed one has its name in the right version, and one that a version
    lacks is NULL there. Each side is counted before the shuffle, so a row that is repeated a
    billion times costs one record per task.
    """
    fields = [{_stored(f): f for f in table.schema(version).fields} for version in (left, right)]
    shown = {stored: f.name for stored, f in fields[1].items()}
    for stored, f in fields[0].items():
        if stored not in shown:
            shown[stored] = f.name if f.name not in shown.values() else f"{f.name}_before"
    kinds = {stored: f.dataType for side in fields for stored, f in side.items()}
    names = list(shown.values())

    def side(version: int, own: dict, sign: int) -> DataFrame:
        columns = [
            (F.col(f"`{own[stored].name}`") if stored in own else F.lit(None)).cast(kinds[stored]).alias(name)
            for stored, name in shown.items()
        ]
        return table.read(version).select(*columns, F.lit(sign).alias("_sign"))

    sides = side(left, fields[0], -1).unionByName(side(right, fields[1], 1))
    balance = sides.groupBy(*names).agg(F.sum("_sign").alias("_balance")).filter("_balance <> 0")
    return balance.select(
        F.when(F.col("_balance") > 0, "added").otherwise("removed").alias("change"),
        F.abs("_balance").cast("bigint").alias("times"),
        *names,
    )
