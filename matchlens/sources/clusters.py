"""Server cluster lookup: exact ids and id ranges, each with a region name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Region of each known server cluster.
CLUSTERS = """
111,United States
112,United States
114,United States
121,United States
122,United States
123,United States
124,United States
131,Europe West
132,Europe West
133,Europe West
134,Europe West
135,Europe West
136,Europe West
142,South Korea
143,South Korea
151,Southeast Asia
152,Southeast Asia
153,Southeast Asia
161,China
163,China
171,Australia
181,Russia
182,Russia
183,Russia
184,Russia
191,Europe
200,South America
204,South America
211,South Africa
212,South Africa
213,South Africa
221,China
222,China
223,China
231,China
"""
# Region of each range of cluster ids.
CLUSTER_RANGES = """
110-129,United States
130-139,Europe
140-149,South Korea
150-159,Southeast Asia
160-169,China
170-179,Australia
180-189,Russia
190-199,Europe
200-209,South America
210-219,South Africa
220-239,China
"""


def _lines(text: str) -> list[list[str]]:
    return [line.split(",") for line in text.strip().splitlines()]


def default_clusters(spark: SparkSession) -> DataFrame:
    rows = ", ".join(f"({cluster}, '{region}')" for cluster, region in _lines(CLUSTERS))
    return spark.sql(f"SELECT * FROM VALUES {rows} AS clusters(cluster_id, region)")


def default_ranges(spark: SparkSession) -> DataFrame:
    rows = ", ".join(f"({ids.replace('-', ', ')}, '{region}')" for ids, region in _lines(CLUSTER_RANGES))
    return spark.sql(f"SELECT * FROM VALUES {rows} AS ranges(lo, hi, region)")


def read_clusters(spark: SparkSession, path: str) -> DataFrame:
    """``id,region`` lines; other lines (links, blanks) are skipped."""
    lines = spark.read.schema("id string, region string").csv(path)
    return lines.where(F.col("id").rlike(r"^\d+$")).select(F.col("id").cast("int").alias("cluster_id"), "region")


def read_ranges(spark: SparkSession, path: str) -> DataFrame:
    """``lo-hi,region`` lines."""
    lines = spark.read.schema("ids string, region string").csv(path).where(F.col("ids").rlike(r"^\d+-\d+$"))
    bounds = F.split("ids", "-")
    return lines.select(bounds[0].cast("int").alias("lo"), bounds[1].cast("int").alias("hi"), "region")
