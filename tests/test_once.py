import time

from siltbed.streaming.once import deliver_once, store_stream

SCHEMA = "id int, `a.b` string"


class Deliveries:
    """Two folders and the table that one stream over both keeps."""

    def __init__(self, spark, folder):
        self.spark = spark
        self.inputs = [str(folder / "one"), str(folder / "two")]
        self.out, self.checkpoint = str(folder / "out"), str(folder / "checkpoint")
        for path in self.inputs:
            spark.createDataFrame([], SCHEMA).write.parquet(path)

    def put(self, number, rows):
        self.spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(self.inputs[number])

    def run(self, delay):
        streams = [self.spark.readStream.schema(SCHEMA).parquet(path) for path in self.inputs]
        query = store_stream(deliver_once(streams, ["id"], delay), self.out, self.checkpoint)
        query.awaitTermination()
        return [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]

    def stored(self):
        return sorted((tuple(r) for r in self.spark.read.parquet(self.out).collect()), key=repr)


def test_overlapping_deliveries_enter_once(spark, tmp_path):
    at = Deliveries(spark, tmp_path)
    at.put(0, [(1, "x"), (2, "y"), (2, "y")])
    at.put(1, [(2, "y"), (3, "z")])
    at.run("1 day")
    at.put(0, [(3, "z"), (4, "w")])
    at.put(1, [(1, "x")])
    at.run("1 day")
    assert at.stored() == [(1, "x"), (2, "y"), (3, "z"), (4, "w")]


def test_records_without_key_differ_by_their_columns(spark, tmp_path):
    at = Deliveries(spark, tmp_path)
    at.put(0, [(None, "x"), (None, "y"), (None, None)])
    at.put(1, [(None, "x"), (None, None)])
    at.run("1 day")
    assert at.stored() == [(None, "x"), (None, "y"), (None, None)]


def test_state_forgets_what_is_older_than_the_delay(spark, tmp_path):
    at = Deliveries(spark, tmp_path)
    at.put(0, [(n, "x") for n in range(200)])
    assert max(at.run("1 second")) == 200
    for load in (1, 2, 3):
        time.sleep(1.5)
        at.put(load % 2, [(1000 * load + n, "y") for n in range(10)])
        sizes = at.run("1 second")
    # Of 230 records only those of the last loads are still remembered.
    assert sizes[-1] <= 20
    assert len(at.stored()) == 230
