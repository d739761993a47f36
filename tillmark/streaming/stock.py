"""The stock guard on order items that keep arriving."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tillmark.operators.guards import is_short
from tillmark.operators.relational import stock_of_items
from tillmark.session import materialize


def guard_arriving_items(items: DataFrame, products: Callable[[], DataFrame], folder: str,
                         checkpoint: str) -> StreamingQuery:
    """Judge each arriving item against the stock of the moment and write it to
    ``folder/accepted`` or ``folder/rejected``.

    ``products`` is called once per micro-batch. A micro-batch writes to folders of its own
    number, so one that is run again after a failure replaces its own output.
    """

    def judge(batch: DataFrame, number: int) -> None:
        arrived = materialize(batch, "arrived")  # the join's measurements read it again
        judged = materialize(stock_of_items(arrived, products()), "guarded")
        for side, rows in (("accepted", judged.filter(~is_short())), ("rejected", judged.filter(is_short()))):
            rows.write.mode("overwrite").parquet(f"{folder}/{side}/batch={number}")

    return (
        items.writeStream.foreachBatch(judge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
