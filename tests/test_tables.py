import pytest
from pyspark.sql import functions as F

from siltbed.sources.tables import VersionedTable, compare_versions, file_stats, partition_stats


@pytest.fixture
def table(spark, tmp_path):
    return VersionedTable(spark, str(tmp_path / "table"))


def ids(df):
    return sorted(r[0] for r in df.select("id").collect())


def test_every_write_is_a_version(spark, table):
    assert not table.exists()
    assert table.append(spark.range(3)) == 1
    assert table.append(spark.range(3, 5)) == 2
    assert table.overwrite(spark.range(1)) == 3
    assert table.delete_where(F.col("id") == 0) == 4
    assert [ids(table.read(v)) for v in (1, 2, 3, 4)] == [[0, 1, 2], [0, 1, 2, 3, 4], [0], []]
    log = {r["version"]: r for r in table.history().collect()}
    assert [log[v]["operation"] for v in (1, 2, 3, 4)] == ["append", "append", "overwrite", "delete"]
    assert [log[v]["added_records"] for v in (1, 2, 3, 4)] == [3, 2, 1, 0]
    assert [log[v]["total_records"] for v in (1, 2, 3, 4)] == [3, 5, 1, 0]
    assert [log[v]["parent_version"] for v in (1, 2, 3, 4)] == [None, 1, 2, 3]


def test_unknown_version_or_table_raises(spark, table):
    with pytest.raises(LookupError):
        table.read()
    table.append(spark.range(1))
    with pytest.raises(LookupError, match="no version 7"):
        table.read(7)


def test_lost_commit_is_invisible_and_overwritten(spark, table):
    table.append(spark.range(2))
    # Data of a job that died before its log row.
    spark.range(100, 200).write.parquet(f"{table.path}/data/commit_version=2")
    assert ids(table.read()) == [0, 1]
    table.append(spark.range(2, 3))
    assert ids(table.read()) == [0, 1, 2]


def test_overwrite_may_read_itself(spark, table):
    table.append(spark.range(4))
    table.overwrite(table.read().filter("id % 2 = 0"))
    assert ids(table.read()) == [0, 2]


def test_delete_keeps_rows_where_the_predicate_is_null_and_untouched_parts(spark, table, folders):
    table.append(spark.sql("SELECT 1 AS id, 'a' AS k UNION ALL SELECT 2, NULL"))
    table.append(spark.sql("SELECT 3 AS id, 'b' AS k"))
    table.delete_where(F.col("k") == "a")
    assert ids(table.read()) == [2, 3]
    assert folders(table.entry()) == ["commit_version=2", "commit_version=3"]
    assert table.entry()["summary"]["total-records"] == "2"
    table.delete_where(F.col("k") == "zzz")
    assert ids(table.read()) == [2, 3]


def test_recreate_with_another_schema(spark, table):
    table.append(spark.range(2))
    table.recreate(spark.sql("SELECT 'x' AS name").schema)
    assert table.read().count() == 0
    assert table.read().columns == ["name"]
    assert table.files().count() == 0
    table.append(spark.sql("SELECT 'x' AS name"))
    assert ids(table.read(1)) == [0, 1]


def test_columns_are_added_once_and_old_rows_are_null(spark, table):
    table.append(spark.range(1))
    version = table.add_columns({"note": "string"})
    assert table.add_columns({"note": "string"}) == version
    table.append(spark.sql("SELECT 'n' AS note, CAST(5 AS BIGINT) AS id"))
    assert sorted(map(tuple, table.read().collect()), key=str) == [(0, None), (5, "n")]
    with pytest.raises(ValueError, match="not in the table"):
        table.append(spark.sql("SELECT 1 AS id, 2 AS unknown"))


def test_rename_keeps_old_files_and_a_reused_name_is_a_new_column(spark, table):
    table.append(spark.sql("SELECT 1 AS id, 'old' AS name"))
    table.rename_column("name", "title")
    table.add_columns({"name": "string"})
    table.append(spark.sql("SELECT 2 AS id, 'new' AS title, 'n' AS name"))
    assert sorted(map(tuple, table.read().select("id", "title", "name").collect())) == [(1, "old", None), (2, "new", "n")]
    assert table.read(1).columns == ["id", "name"]
    with pytest.raises(ValueError):
        table.rename_column("missing", "x")


def test_partitions_are_pruned(spark, table, plan):
    table.append(spark.range(100).withColumn("p", F.col("id") % 4), partition_by=["p"])
    read = table.read().filter("p = 3")
    assert read.count() == 25
    assert "PartitionFilters: [isnotnull(p" in plan(read)
    stats = {r["p"]: (r["record_count"], r["file_count"] > 0) for r in partition_stats(table.read(), ["p"]).collect()}
    assert stats == {p: (25, True) for p in range(4)}


def test_a_version_lists_its_own_folders_only(spark, table, plan):
    for n in range(3):
        table.append(spark.range(n, n + 1))
    assert all("commit_version=3" not in f for f in table.read(2).inputFiles())


def test_file_statistics(spark, table):
    table.append(spark.sql("SELECT id, nullif(id, 3) AS v FROM range(10)").coalesce(1))
    table.append(spark.sql("SELECT id, id AS v FROM range(10, 15)").coalesce(1))
    stats = sorted(
        (r["record_count"], r["id_min"], r["id_max"], r["v_nulls"]) for r in file_stats(table.read(), ["id", "v"]).collect()
    )
    assert stats == [(5, 10, 14, 0), (10, 0, 9, 1)]
    assert sorted(r["record_count"] for r in table.files().collect()) == [5, 10]
    assert table.entry()["summary"]["added-data-files"] == "1"


def test_compare_versions_counts_repeated_rows(spark, table):
    table.append(spark.sql("SELECT explode(array(1, 1, 2, NULL)) AS id"))
    table.overwrite(spark.sql("SELECT explode(array(1, 3, 3, NULL)) AS id"))
    changes = {(r["change"], r["id"], r["times"]) for r in compare_versions(table, 1, 2).collect()}
    assert changes == {("removed", 1, 1), ("removed", 2, 1), ("added", 3, 2)}


def test_replace_split_leaves_other_values_in_place(spark, table, folders):
    table.overwrite(spark.range(6).withColumn("open", F.col("id") > 2), split_by="open")
    before = folders(table.entry())
    table.replace_split(spark.range(10, 12).withColumn("open", F.lit(True)), [True])
    assert ids(table.read()) == [0, 1, 2, 10, 11]
    assert "commit_version=1/open=false" in before and "commit_version=1/open=false" in folders(table.entry())
    table.delete_where(F.col("id") == 1)
    assert ids(table.read()) == [0, 2, 10, 11]
    assert "commit_version=2/open=true" in folders(table.entry())


def test_empty_partitioned_table(spark, table):
    table.append(spark.range(0).withColumn("p", F.lit(1)), partition_by=["p"])
    assert table.read().count() == 0
    table.append(spark.range(2).withColumn("p", F.lit(1)))
    assert table.read().count() == 2


def test_rows_added_since_a_version(spark, table):
    table.append(spark.range(2))
    table.append(spark.range(2, 4))
    table.add_columns({"note": "string"})
    table.append(spark.range(4, 6))
    assert ids(table.added_since(1)) == [2, 3, 4, 5]
    assert ids(table.added_since(4)) == []
    table.delete_where(F.col("id") == 0)
    assert table.added_since(1) is None
    assert ids(table.added_since(5)) == []


def test_a_stale_writer_fails_and_damages_nothing(spark, table):
    table.append(spark.range(3))
    stale = table.entry()
    table.append(spark.range(10, 15))
    with pytest.raises(Exception):
        table._commit(stale, "append", table.schema(), spark.range(100, 101), [], None, stale["parts"])
    assert ids(table.read()) == [0, 1, 2, 10, 11, 12, 13, 14]


def test_row_counts_come_from_the_log(spark, table):
    table.append(spark.range(3))
    table.append(spark.range(10, 15))
    table.delete_where(F.col("id") == 11)
    entry = table.entry()
    assert entry["part_records"] == [3, 4] and entry["summary"]["total-records"] == "7"


def test_compare_across_a_rename_and_an_added_column(spark, table):
    table.append(spark.sql("SELECT 1 AS id, 'x' AS old UNION ALL SELECT 2, 'y'"))
    table.rename_column("old", "new")
    table.add_columns({"extra": "int"})
    table.append(spark.sql("SELECT 3 AS id, 'z' AS new, 9 AS extra"))
    table.delete_where(F.col("id") == 2)
    found = {tuple(r[c] for c in ("change", "id", "new", "extra")) for r in compare_versions(table, 1, 5).collect()}
    assert found == {("removed", 2, "y", None), ("added", 3, "z", 9)}
