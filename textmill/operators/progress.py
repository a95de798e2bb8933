"""Series of step metrics, inventories of files, and completeness checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def _order(by: list[str], partition: list[str] | None) -> Window:
    return (Window.partitionBy(*partition) if partition else Window.partitionBy()).orderBy(*by)


def running_best(value: str, by: list[str], partition: list[str] | None = None) -> Column:
    return F.min(value).over(_order(by, partition).rowsBetween(Window.unboundedPreceding, 0))


def rolling(value: str, by: list[str], rows: int = 100, partition: list[str] | None = None, agg=F.avg) -> Column:
    return agg(value).over(_order(by, partition).rowsBetween(1 - rows, 0))


def slope(value: str, step: str, by: list[str], rows: int = 100, partition: list[str] | None = None) -> Column:
    """Least-squares slope over the last rows; 0 where it is not defined."""
    w = _order(by, partition).rowsBetween(1 - rows, 0)
    return F.coalesce(F.try_divide(F.covar_pop(step, value).over(w), F.var_pop(step).over(w)), F.lit(0.0))


def trend(value: str, by: list[str], partition: list[str] | None = None) -> Column:
    before = F.lag(value).over(_order(by, partition))
    return F.when(before.isNull(), "start").when(F.col(value) < before, "improving").otherwise("stable")


def interval_average(df: DataFrame, step: str, value: str, every: int, partition: list[str]) -> DataFrame:
    """Mean of ``value`` over each ``every`` steps."""
    return df.groupBy(*partition, F.floor((F.col(step) - 1) / every).alias("interval")).agg(F.round(F.avg(value), 6).alias("mean"), F.count(F.lit(1)).alias("steps"))


def inventory(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """name, size, mtime and extension of the files below a folder, from metadata only."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(path).select("path", "length", "modificationTime")
    name = F.element_at(F.split("path", "/"), -1)
    return files.select(name.alias("name"), F.col("length").alias("size"), F.col("modificationTime").alias("mtime"), F.lower(F.regexp_extract(name, r"\.([^.]+)$", 1)).alias("ext"))


def inventory_by_extension(files: DataFrame) -> DataFrame:
    return files.groupBy("ext").agg(F.count(F.lit(1)).alias("files"), F.sum("size").alias("bytes"), F.max_by("name", F.struct("mtime", "name")).alias("latest"))


def base_name(name: Column) -> Column:
    """Input name that an output stands for: without folder, the two prefixes, part number and extension."""
    last = F.element_at(F.split(name, "/"), -1)
    return F.regexp_replace(F.regexp_replace(last, r"\.(npz|jsonl|json|parquet|txt)$", ""), r"^(tokenized_)|_part\d+$", "")


def completed(inputs: DataFrame, outputs: DataFrame, name: str = "name") -> DataFrame:
    """Inputs with an output under either mapping: the input's own name, or that without its ``cleaned_`` prefix."""
    done = outputs.select(base_name(F.col(name)).alias("__base")).distinct()
    own = F.regexp_replace(F.col(name), r"\.[^.]+$", "")
    return _either(inputs, done, own, "left_semi")


def missing(inputs: DataFrame, outputs: DataFrame, name: str = "name") -> DataFrame:
    done = outputs.select(base_name(F.col(name)).alias("__base")).distinct()
    return _either(inputs, done, F.regexp_replace(F.col(name), r"\.[^.]+$", ""), "left_anti")


def _either(inputs: DataFrame, done: DataFrame, own: Column, how: str) -> DataFrame:
    """Both mappings as equi-joins: outputs are spread to the two names that an input may have."""
    names = done.select(F.explode(F.array("__base", F.concat(F.lit("cleaned_"), "__base"))).alias("__base")).distinct()
    return inputs.withColumn("__own", own).join(names, F.col("__own") == F.col("__base"), how).drop("__own")
