"""The flagship query used by ``entry()``: the E1 crawl over rendered pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filingflow.session import ensure_conf
from . import fixtures as fx
from filingflow.plans.crawl import crawl
from .queries_a import customer_isin_map

AS_OF = "2024-02-01T00:00:00"


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_conf(spark)
    f = fx.order_filings(spark, sf_dir)
    r = f.agg(F.max("page").alias("p"), F.count("*").alias("n")).first()
    bronze = fx.render_grid_pages(f, int(r["p"] or 0), int(r["n"] or 0)) \
               .withColumnRenamed("page", "payload_id")
    return crawl(bronze, customer_isin_map(spark, sf_dir), AS_OF, map_is_table=False)
