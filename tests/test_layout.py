import datetime
import random

import pytest
from pyspark.sql import functions as F

from siltbed.sources.layout import rank_among, write_interleaved


def files_of(rows):
    return rows.select("_metadata.file_path").distinct().count()


def may_hold(path, name, low, high):
    """Files whose minimum and maximum meet a range, from Parquet's own statistics."""
    import glob

    import pyarrow.parquet as pq

    met = total = 0
    for file in glob.glob(f"{path}/*.parquet"):
        meta = pq.ParquetFile(file).metadata
        total += 1
        for group in range(meta.num_row_groups):
            columns = {meta.row_group(group).column(i).path_in_schema: i for i in range(meta.num_columns)}
            stats = meta.row_group(group).column(columns[name]).statistics
            if stats.min <= high and stats.max >= low:
                met += 1
                break
    return met, total


def test_either_column_prunes(spark, tmp_path):
    draw = random.Random(3)
    day = datetime.date(2024, 1, 1)
    rows = [(draw.randrange(100_000), day + datetime.timedelta(draw.randrange(1000))) for _ in range(20_000)]
    df = spark.createDataFrame(rows, "a int, d date").repartition(8)
    path = str(tmp_path / "laid")
    write_interleaved(df, ["a", "d"], path, rows_per_file=400)
    stored = spark.read.parquet(path)
    assert sorted(map(tuple, stored.collect())) == sorted(rows)
    by_a = stored.filter("a BETWEEN 50000 AND 52000")
    by_d = stored.filter("d BETWEEN DATE'2025-01-01' AND DATE'2025-01-20'")
    for rows_met, name, low, high in (
        (by_a, "a", 50_000, 52_000),
        (by_d, "d", datetime.date(2025, 1, 1), datetime.date(2025, 1, 20)),
    ):
        met, total = may_hold(path, name, low, high)
        assert 0 < files_of(rows_met) <= met < total / 3


def test_nulls_copies_texts_and_empty_tables(spark, tmp_path):
    rows = [(None, "a")] * 50 + [(1.5, None)] * 50 + [(float(n), f"über{n}") for n in range(50)]
    schema = "`x.y` double, t string"
    df = spark.createDataFrame(rows, schema)
    write_interleaved(df, ["x.y", "t"], str(tmp_path / "one"), rows_per_file=20)
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "one")).collect()), key=repr) == sorted(rows, key=repr)
    write_interleaved(df.limit(0), ["x.y", "t"], str(tmp_path / "none"))
    assert spark.read.schema(schema).parquet(str(tmp_path / "none")).count() == 0


def test_ranks_and_room(spark, tmp_path):
    values = spark.createDataFrame([(None,), (0.0,), (1.0,), (1.5,), (2.0,), (9.0,)], "v double")
    ranked = values.select(rank_among(F.col("v"), [1.0, 2.0, 3.0])).collect()
    assert [r[0] for r in ranked] == [0, 0, 1, 1, 2, 3]
    with pytest.raises(ValueError):
        write_interleaved(values, ["v"] * 11, str(tmp_path / "x"))
