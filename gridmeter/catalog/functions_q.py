"""Queries of the scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridmeter.catalog import query
from gridmeter.functions.ids import id2num
from gridmeter.oracle import id2num as duck_id2num
from gridmeter.sources.derived import load


@query("id2num", f"""
SELECT src, key, val, {duck_id2num('val')} AS num FROM (
  SELECT 'part' AS src, p_partkey AS key, p_type AS val FROM part
  UNION ALL SELECT 'customer_segment', c_custkey, c_mktsegment FROM customer
  UNION ALL SELECT 'customer_name', c_custkey, c_name FROM customer
  UNION ALL SELECT 'order_hex', o_orderkey, hex(o_orderkey) FROM orders)
""")
def q_id2num(spark, sf_dir):
    """Ids to numbers (bijective base 62, mod 10^15) over text
    columns of the tables, including non-alphanumeric characters."""
    part = load(spark, sf_dir, "part")
    cust = load(spark, sf_dir, "customer")
    orders = load(spark, sf_dir, "orders")
    vals = (part.select(F.lit("part").alias("src"), F.col("p_partkey").alias("key"),
                        F.col("p_type").alias("val"))
            .unionByName(cust.select(F.lit("customer_segment").alias("src"),
                                     F.col("c_custkey").alias("key"),
                                     F.col("c_mktsegment").alias("val")))
            .unionByName(cust.select(F.lit("customer_name").alias("src"),
                                     F.col("c_custkey").alias("key"),
                                     F.col("c_name").alias("val")))
            .unionByName(orders.select(F.lit("order_hex").alias("src"),
                                       F.col("o_orderkey").alias("key"),
                                       F.hex("o_orderkey").alias("val"))))
    return vals.withColumn("num", id2num("val"))


@query("unnest_ordinality", """
SELECT p_partkey, CAST(i AS INTEGER) AS pos, ch FROM (
  SELECT p_partkey, unnest(string_split(p_type, '')) AS ch,
         generate_subscripts(string_split(p_type, ''), 1) AS i FROM part)
""")
def q_unnest_ordinality(spark, sf_dir):
    """Split text into characters with their 1-based position."""
    part = load(spark, sf_dir, "part")
    return part.select("p_partkey", F.posexplode(F.split("p_type", "")).alias("pos0", "ch")) \
        .select("p_partkey", (F.col("pos0") + 1).alias("pos"), "ch")
