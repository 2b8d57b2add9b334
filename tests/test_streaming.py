from fixtures import price, prices_json
from pyspark.sql import functions as F

from siltbed.plans import prices
from siltbed.sources.files import Run
from siltbed.sources.tables import VersionedTable
from siltbed.streaming.history import history_stream
from siltbed.streaming.raw_ingest import BATCH_LABEL, file_stream, ingest_stream


def test_every_file_comes_in_once(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    table = VersionedTable(spark, str(tmp_path / "raw"))
    runs = iter(["r1", "r2", "r3"])

    def ingest_all():
        query = ingest_stream(
            file_stream(spark, str(folder), "*.json"),
            table,
            prices.PRICE_FILES,
            str(tmp_path / "checkpoint"),
            lambda: Run(next(runs), "2026-01-05T08:00:00Z"),
        )
        query.awaitTermination()

    (folder / "1.json").write_text(prices_json([price("F", "2026-01-05", 1.0)]))
    (folder / "2.json").write_text(prices_json([price("G", "2026-01-05", 1.0)]))
    (folder / "readme.txt").write_text("not a load")
    ingest_all()
    ingest_all()
    (folder / "3.json").write_text(prices_json([price("H", "2026-01-05", 1.0)]))
    ingest_all()
    found = sorted((r["source_file_path"][-6:], r["ingestion_id"]) for r in table.read().collect())
    assert found == [("1.json", "r1"), ("2.json", "r1"), ("3.json", "r2")]
    assert prices.stage_prices(table.read()).count() == 3


def test_a_repeated_batch_is_skipped(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "history"))
    folder = str(tmp_path / "loads")
    schema = "isin string, business_date date, nav double, currency string, at timestamp"
    load = spark.sql("SELECT 'F' AS isin, DATE '2026-01-05' AS business_date, 1.0D AS nav, 'EUR' AS currency, TIMESTAMP '2026-01-05 08:00:00' AS at")
    load.write.parquet(folder)

    def advance(checkpoint):
        history_stream(
            spark.readStream.schema(schema).parquet(folder),
            table,
            lambda df: df.drop("at"),
            prices.KEYS,
            prices.CHECKS,
            lambda batch: F.lit(f"2026-01-0{6 + batch} 08:00:00").cast("timestamp"),
            str(tmp_path / checkpoint),
        ).awaitTermination()

    advance("checkpoint")
    assert table.entry()["summary"][BATCH_LABEL] == "0"
    # The stream's own note of batch 0 is lost, its commit is not.
    (tmp_path / "checkpoint" / "commits" / "0").unlink()
    (tmp_path / "checkpoint" / "commits" / ".0.crc").unlink(missing_ok=True)
    advance("checkpoint")
    assert table.entry()["version"] == 1
    # Another checkpoint is another stream; the same values open no version.
    advance("another")
    assert prices.read_history(table).count() == 1


def test_two_streams_feed_one_table(spark, tmp_path):
    table, rejects = (VersionedTable(spark, str(tmp_path / name)) for name in ("raw", "rejects"))
    for name in ("a", "b"):
        folder = tmp_path / name
        folder.mkdir()
        (folder / "1.json").write_text(prices_json([price(name, "2026-01-05", 1.0)]))
        (folder / "2.json").write_text("[1, 2]")
        for _ in range(2):
            ingest_stream(
                file_stream(spark, str(folder), "*.json"),
                table,
                prices.PRICE_FILES,
                str(tmp_path / f"checkpoint-{name}"),
                lambda: Run("r", "2026-01-05T08:00:00Z"),
                rejects,
            ).awaitTermination()
    assert sorted(r["isin"] for r in prices.stage_prices(table.read()).collect()) == ["a", "b"]
    assert [r["reject_reason"] for r in rejects.read().collect()] == ["not_an_object"] * 2
    assert table.entry()["partition_by"] == ["ingestion_date"]
