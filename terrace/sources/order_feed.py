"""Entity records derived from the order tables: one record per order, keyed by its
customer, so that ids repeat, some are missing, and codes, coordinates and contacts
have gaps and errors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from terrace.session import stored_bytes

# The columns that the feed uses. A given schema spares a footer read per table.
_TABLES = {
    "orders": "o_orderkey LONG, o_custkey LONG, o_orderdate TIMESTAMP_NTZ",
    "customer": "c_custkey LONG, c_nationkey INT, c_mktsegment STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "region": "r_regionkey INT, r_name STRING",
}

_RECORD = {
    "seq": "o_orderkey",
    "page": "o_orderkey DIV 50 + 1",
    "seen_at": "o_orderdate",
    "id": "CASE WHEN o_orderkey % 97 <> 0 THEN string(o_custkey) END",
    "name": "'Chain_' || o_custkey % 3",
    "category": "c_mktsegment",
    "street": "c_nationkey || ' Main St'",
    "city": "'City_' || o_custkey % 5",
    "state": "n_name",
    "postal_code": """CASE o_orderkey % 5
        WHEN 0 THEN lpad(string(o_custkey), 5, '0')
        WHEN 1 THEN lpad(string(o_custkey), 5, '0') || '-0001'
        WHEN 2 THEN lpad(string(o_custkey), 5, '0') || '-'
        WHEN 3 THEN 'X' || o_custkey END""",
    "country": "CASE r_name WHEN 'AMERICA' THEN 'United States' ELSE r_name END",
    "longitude": """CASE WHEN o_orderkey % 11 = 0 THEN '' WHEN o_orderkey % 13 = 0 THEN 'n/a'
        ELSE '-' || o_orderkey % 180 || '.25' END""",
    "latitude": "CASE WHEN o_orderkey % 11 <> 0 THEN o_orderkey % 90 || '.5' END",
    "phone": "CASE WHEN o_orderkey % 3 <> 0 THEN '555' || lpad(string(o_custkey), 7, '0') END",
    "website_url": "CASE WHEN o_orderkey % 4 <> 0 THEN 'http://e' || o_custkey || '.example' END",
    "page_failed": "false",
}


# A larger file of customers is not broadcast: Spark goes by the bytes of the file, which may hold
# fifty times as many in rows, and the driver builds their table.
_MOST_BROADCAST = 2 * 1024 * 1024


def order_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw records with `seq` (unique), `page`, `page_failed` (never) and `seen_at`."""
    orders, customer, nation, region = (
        spark.read.schema(schema).parquet(f"{sf_dir}/{name}.parquet") for name, schema in _TABLES.items()
    )
    if stored_bytes(spark, f"{sf_dir}/customer.parquet") > _MOST_BROADCAST:
        customer = customer.hint("merge")
    return (
        orders.join(customer, orders.o_custkey == customer.c_custkey)
        .join(nation, customer.c_nationkey == nation.n_nationkey)
        .join(region, nation.n_regionkey == region.r_regionkey)
        .selectExpr(*[f"{text} AS {name}" for name, text in _RECORD.items()])
    )
