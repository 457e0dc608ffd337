"""Do the outputs of a region or unit agree?"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _counts(tables: dict[str, DataFrame], distinct: dict[str, DataFrame], id_col: str) -> DataFrame:
    parts = [df.agg(F.count(F.lit(1)).alias("n")).withColumn("name", F.lit(name)) for name, df in tables.items()]
    parts += [df.agg(F.count_distinct(id_col).alias("n")).withColumn("name", F.lit(name)) for name, df in distinct.items()]
    return reduce(DataFrame.unionByName, parts).select("name", "n")


def region_consistency(master: DataFrame, weights: dict[str, DataFrame], id_col: str = "LINKNO") -> DataFrame:
    """``name, n, matches``: rows of the master and distinct ids of each slim weight table;
    ``matches`` tells whether the count is the master's."""
    counts = _counts({"master": master}, weights, id_col)
    return counts.crossJoin(F.broadcast(master.agg(F.count(F.lit(1)).alias("m")))).select("name", "n", (F.col("n") == F.col("m")).alias("matches"))


def outputs_valid(files: dict[str, DataFrame], weights: dict[str, DataFrame], id_col: str = "LINKNO") -> DataFrame:
    """``n_tables, least, most, valid``: valid if there is a weight table and all counts are equal."""
    counts = _counts(files, weights, id_col)
    valid = (F.min("n") == F.max("n")) & F.lit(bool(weights))
    return counts.agg(F.count(F.lit(1)).alias("n_tables"), F.min("n").alias("least"), F.max("n").alias("most"), valid.alias("valid"))


def units_valid(counts: DataFrame, required: tuple[str, ...]) -> DataFrame:
    """``unit, n_files, least, most, valid`` from ``unit, name, n``: the rivers each file of a unit has.

    Valid is a unit with all ``required`` files and a weight table, all counts being equal."""
    there = F.count_if(F.col("name").isin(list(required))) == len(required)
    weighted = F.count_if(F.col("name").startswith("weight_")) > 0
    valid = there & weighted & (F.min("n") == F.max("n"))
    return counts.groupBy("unit").agg(F.count(F.lit(1)).alias("n_files"), F.min("n").alias("least"), F.max("n").alias("most"), valid.alias("valid"))


def slim_tables_present(names: DataFrame) -> DataFrame:
    """``name, has_slim`` for each full weight file among ``names`` (column ``name``)."""
    full = names.where(F.col("name").startswith("weight_") & F.col("name").endswith("_full.csv"))
    slim = names.select(F.col("name").alias("slim"), F.lit(True).alias("present"))
    wanted = full.select("name", F.regexp_replace("name", "_full\\.csv$", ".csv").alias("slim"))
    return wanted.join(slim.distinct(), "slim", "left").select("name", F.coalesce("present", F.lit(False)).alias("has_slim"))
