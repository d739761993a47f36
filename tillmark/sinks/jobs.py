"""The monthly sales report as a batch job.

``spark-submit tillmark/sinks/jobs.py FOLDER BASE DAY`` reads the tables of FOLDER and writes the
report of DAY's month under BASE; when it runs is up to the scheduler of the site.
"""

from __future__ import annotations

import datetime as dt
import sys

from pyspark.sql import DataFrame

from tillmark.operators.reports import daily_product_sales
from tillmark.session import build_session
from tillmark.sinks.files import export_monthly
from tillmark.sources.retail import Retail


def sales_report_job(sales: DataFrame, base: str, as_of: dt.date) -> str:
    """Write the sales lines under the month of ``as_of``; a rerun in the month replaces them."""
    return export_monthly(sales, base, f"{as_of:%Y-%m}")


def main(arguments: list[str]) -> None:
    folder, base, day = arguments
    shop = Retail(build_session("sales report"), folder)
    sales = daily_product_sales(shop.order_items, shop.orders, shop.products)
    print("report saved:", sales_report_job(sales, base, dt.date.fromisoformat(day)))


if __name__ == "__main__":
    main(sys.argv[1:])
