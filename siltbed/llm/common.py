"""What the operators share: words, whole-text batches, written intermediate tables, distributed ranks."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltbed.session import work_dir

#: Fixed value of the contracts: a word is a run of anything but ASCII white space. ``bytes.split()`` cuts the same.
WORD = r"[^\x20\x09-\x0D]+"


def written(df: DataFrame, label: str, **options: str) -> DataFrame:
    """The frame, stored once in the shared work folder: cuts lineage and outlives executors."""
    spark = df.sparkSession
    path = work_dir(spark, label)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def whole_text(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def crc_fold(key: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a NULL id counts as empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % folds


def crc_sql(value: str) -> str:
    """The crc32 of a value's text in DuckDB's SQL, which has none: eight steps per byte; NULL counts as empty text."""
    step = "xor(xor(a, b) >> 1, 3988292384 * (xor(a, b) & 1))"
    per_byte = "lambda c: CASE WHEN c = '' THEN []::BIGINT[] ELSE [ascii(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0] END"
    letters = f"flatten(list_transform(string_split(coalesce(({value})::VARCHAR, ''), ''), {per_byte}))"
    return f"xor(list_reduce(list_concat([4294967295::BIGINT], {letters}), lambda a, b: {step}), 4294967295)"


def free_name(taken: list[str], wish: str) -> str:
    """A column name that no column has yet, whatever its case."""
    lower = {name.lower() for name in taken}
    while wish.lower() in lower:
        wish += "_"
    return wish


def quoted(names: list[str]) -> list[Column]:
    """Columns by name, whatever signs a name holds."""
    return [F.col("`" + name.replace("`", "``") + "`") for name in names]


def with_arrow_columns(
    df: DataFrame,
    given: Column,
    fields: list[T.StructField],
    compute: Callable[[], Callable[[pa.Array], Iterator[tuple[slice, list[pa.Array]]]]],
) -> DataFrame:
    """The frame with more columns, computed from one column; all others pass through.

    ``compute()`` runs once per task and gives a function from the values of a
    batch to parts of it: which rows, and their new columns. Columns go by place, so
    their names may hold any sign.
    """
    names = [*df.columns, *(f.name for f in fields)]
    places = [f"c{n}" for n in range(len(names))]
    taken = df.select(*[c.alias(p) for c, p in zip(quoted(df.columns), places)], given.alias("given"))
    schema = T.StructType(
        [T.StructField(p, f.dataType) for p, f in zip(places, [*df.schema.fields, *fields])]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = compute()
        for batch in batches:
            if batch.num_rows == 0:
                continue
            for rows, made in work(batch.column(batch.num_columns - 1)):
                kept = [c.slice(rows.start, rows.stop - rows.start) for c in batch.columns[:-1]]
                yield pa.RecordBatch.from_arrays([*kept, *made], places)

    return taken.mapInArrow(run, schema).toDF(*names)


#: Bytes of text that are worked on, and sent back, at once.
PART = 1 << 22


def in_parts(values: pa.Array, size: int = PART) -> Iterator[slice]:
    """Rows of a batch in parts of about ``size`` bytes, so that what is made of them stays small."""
    step = max(1, int(len(values) * size / max(1, values.nbytes)))
    for at in range(0, len(values), step):
        yield slice(at, min(at + step, len(values)))


def with_text_columns(
    df: DataFrame,
    fields: list[T.StructField],
    compute: Callable[[], Callable[[list[bytes]], list[list]]],
    column: str = "text",
    name: str = "_found",
) -> DataFrame:
    """The frame with one more struct column, computed from whole texts in Arrow batches.

    ``compute()`` runs once per task and gives the function from a list of UTF-8
    texts (NULL: empty) to one list per field. All other columns pass through.
    Texts are whole; a batch goes in parts.
    """
    kinds = [_arrow_type(f.dataType) for f in fields]
    names = [f.name for f in fields]

    def work() -> Callable[[pa.Array], Iterator[tuple[slice, list[pa.Array]]]]:
        found = compute()

        def parts(texts: pa.Array) -> Iterator[tuple[slice, list[pa.Array]]]:
            for rows in in_parts(texts):
                columns = found(texts.slice(rows.start, rows.stop - rows.start).to_pylist())
                yield rows, [pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)]

        return parts

    struct = T.StructField(free_name(df.columns, name), T.StructType(fields))
    return with_arrow_columns(df, whole_text(column).cast("binary"), [struct], work)


def _arrow_type(kind: T.DataType) -> pa.DataType:
    known = {"long": pa.int64(), "double": pa.float64(), "string": pa.string(), "integer": pa.int32(), "binary": pa.binary()}
    if isinstance(kind, T.ArrayType):
        return pa.list_(_arrow_type(kind.elementType))
    return known[kind.typeName()]


def ranked(df: DataFrame, order: list[Column], rank: str, label: str) -> DataFrame:
    """Rows numbered from 0 in the given order, without gathering them in one task.

    A range shuffle deals them out; parts are numbered inside and shifted by the
    row counts of the parts before, a table with one row per part.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = written(df.repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id()), label)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = dealt.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    starts = sizes.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    inside = F.row_number().over(Window.partitionBy("_part").orderBy(*order)) - 1
    return dealt.join(starts, "_part").withColumn(rank, F.col("_start") + inside).drop("_part", "_start")


def power_of_two(count: float) -> int:
    """The exponent of the smallest power of two that is no less than ``count``."""
    return max(0, math.ceil(math.log2(max(1.0, count))))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_digest(column: str = "text") -> Column:
    """SHA-256 of the whole text; NULL counts as empty."""
    return F.unhex(F.sha2(whole_text(column).cast("binary"), 256))


def keep_rows(docs: DataFrame, chosen: DataFrame, key: str = "doc_id", column: str = "text") -> DataFrame:
    """The rows of ``docs`` whose id and text digest are in ``chosen`` (doc_id, digest, twins), one of each.

    ``twins`` is the number of rows that agree in both; they may differ elsewhere,
    and the smallest row stays.
    """
    here, id_, digest, twins = (free_name(docs.columns, f"_{x}") for x in ("here", "id", "digest", "twins"))
    small = chosen.select(F.col("doc_id").alias(id_), F.col("digest").alias(digest), F.col("twins").alias(twins))
    marked = docs.withColumn(here, text_digest(column))
    met = marked.join(
        small.hint("shuffle_hash"), marked[here].eqNullSafe(small[digest]) & marked[key].eqNullSafe(small[id_])
    )
    single = met.filter(F.col(twins) == 1).select(*quoted(docs.columns))
    if chosen.filter(F.col("twins") > 1).isEmpty():
        return single
    row = F.struct(*quoted(docs.columns))
    one = met.filter(F.col(twins) > 1).groupBy(id_, digest).agg(F.min(row).alias("_row"))
    return single.unionByName(one.select("_row.*"))
