"""Orders that arrive in pieces end up as one batch would leave them."""

import pytest
from fixture_files import ORDERS

from tillwright.plans.curation import clean_orders
from tillwright.sources import files, schemas
from tillwright.streaming import increments

# The same order id with another payload, so that the survivor matters.
CONFLICTS = [
    "101,1,P0001,2023-01-05,2023-01-07,4,$19.99,10,71.96,Card,Delivered",
    "102,2,P0002,2023/01/06,01-09-2023,junk,399.99,0%,399.99,Cash,Shipped",
    "103,1,P0003,01/07/2023,2023-01-09,11,1.50,100,15.00,Card,Cancelled",
]


@pytest.mark.parametrize("backwards", [False, True])
def test_increments_equal_one_batch(spark, tmp_path, backwards):
    header, *lines = ORDERS.strip("\n").split("\n")
    lines += CONFLICTS
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    pieces = [lines[place::4] for place in range(4)]
    folder, progress = str(tmp_path / "kept"), str(tmp_path / "progress")

    def stream():
        options = {**files.CSV_OPTIONS, "maxFilesPerTrigger": "1"}
        return spark.readStream.options(**options).schema(schemas.ORDERS_RAW).csv(str(inbox))

    for number, piece in enumerate(reversed(pieces) if backwards else pieces):
        (inbox / f"{number}.csv").write_text("\n".join([header, *piece]) + "\n")
        if number % 2:
            increments.start_increments(stream(), folder, progress).awaitTermination()

    assert len(list((tmp_path / "kept").glob("batch=*"))) == 4
    merged = increments.merged_orders(spark, folder)
    whole = clean_orders(files.read_orders(spark, str(inbox)))
    assert sorted(map(repr, merged.collect())) == sorted(map(repr, whole.collect()))
    assert merged.filter("order_id = 101").first().quantity == 4
    increments.compact(spark, folder, str(tmp_path / "compact"))
    again = increments.merged_orders(spark, str(tmp_path / "compact"))
    assert sorted(map(repr, again.collect())) == sorted(map(repr, whole.collect()))
    few = increments.merged_orders(spark, folder, statuses=("Delivered",))
    assert sorted(map(repr, few.collect())) == sorted(map(repr, whole.filter("order_status = 'Delivered'").collect()))


def test_options_equal_one_batch(spark, tmp_path):
    (tmp_path / "inbox").mkdir()
    (tmp_path / "inbox" / "0.csv").write_text(ORDERS.strip("\n") + "\n")
    stream = spark.readStream.options(**files.CSV_OPTIONS).schema(schemas.ORDERS_RAW).csv(str(tmp_path / "inbox"))
    options = {"payment_names": {"Credit Card": ("card",)}, "statuses": ("Delivered", "Shipped"), "id_type": "int"}
    streamed = increments.curate_available(stream, **options)
    whole = clean_orders(files.read_orders(spark, str(tmp_path / "inbox")), **options)
    assert streamed.dtypes == whole.dtypes
    assert sorted(map(repr, streamed.collect())) == sorted(map(repr, whole.collect()))


def test_a_stream_that_had_nothing(spark, tmp_path):
    (tmp_path / "inbox").mkdir()
    stream = spark.readStream.options(**files.CSV_OPTIONS).schema(schemas.ORDERS_RAW).csv(str(tmp_path / "inbox"))
    orders = increments.curate_available(stream)
    assert orders.count() == 0 and "order_id" in orders.columns


def test_first_arrivals_drops_repeats(spark, tmp_path):
    rows = spark.sql(
        "select id % 5 as event_id, timestamp'2024-01-01 00:00:00' + make_interval(0,0,0,0,0,0,id % 5) as ts from range(20)"
    )
    rows.repartition(2).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    first = increments.first_arrivals(stream, ["event_id"], "ts", "1 hour")
    writer = first.writeStream.format("parquet").option("path", str(tmp_path / "out"))
    writer.option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
    assert sorted(row.event_id for row in spark.read.parquet(str(tmp_path / "out")).collect()) == [0, 1, 2, 3, 4]
