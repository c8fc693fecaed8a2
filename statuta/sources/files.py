"""Unit files, key-value files and the tables an index consists of."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from statuta.functions import text as X

UNIT_SCHEMA = (
    "level string, jo string, hang string, mok string, title string, text string, path string, annex_no string, "
    "links struct<html:string,pdf:string,detail:string>, effective_date string, law_title string, _corrupt_record string"
)


def read_units(spark: SparkSession, *paths: str) -> DataFrame:
    """Units of JSON array files with the base name and serial number of their file.

    Unreadable files give no units; a missing field is null.
    """
    rows = spark.read.schema(UNIT_SCHEMA).option("multiLine", True).option("mode", "PERMISSIVE").json(list(paths))
    kept = rows.where(F.col("_corrupt_record").isNull()).drop("_corrupt_record")
    name = unit_file_name(F.col("_metadata.file_path"))
    return kept.withColumns({"base": name["base"], "mst": name["mst"]})


def find_unit_files(spark: SparkSession, folder: str) -> DataFrame:
    """path, base, mst of every units file in a folder and those below: ``*_units.json``,
    or ``units.json`` in a folder of its law's number."""
    found = (
        spark.read.format("binaryFile").option("pathGlobFilter", "*units.json").option("recursiveFileLookup", True).load(folder).select("path")
    )
    name, parent = unit_file_name(F.col("path")), F.element_at(F.split("path", "/"), -2)
    bundled = F.element_at(F.split("path", "/"), -1) == "units.json"
    return found.select("path", F.when(bundled, parent).otherwise(name["base"]).alias("base"), F.when(bundled, parent).otherwise(name["mst"]).alias("mst"))


def unit_file_name(path: Column) -> Column:
    """Struct (base, mst) of a path like ``.../name_12_units.json``."""
    file = F.url_decode(F.element_at(F.split(path, "/"), -1))
    shape = r"^(.+?)_(\d+)_units\.json$"
    stem = F.regexp_replace(file, r"(?<=.)\.[^.]*$", "")
    return F.struct(
        F.when(file.rlike(shape), F.concat(F.regexp_extract(file, shape, 1), F.lit("_"), F.regexp_extract(file, shape, 2))).otherwise(stem).alias("base"),
        F.nullif(F.regexp_extract(file, shape, 2), F.lit("")).alias("mst"),
    )


def key_values(lines: DataFrame, column: str = "value") -> DataFrame:
    """key, value of ``KEY=value`` lines; comments and blank lines are skipped,
    one pair of quotes around a value is removed."""
    line = X.strip(F.col(column))
    shape = r"^([^=]+)=(.*)$"
    value = F.regexp_extract(line, shape, 2)
    bare = F.when(value.rlike("^(\".*\"|'.*')$") & (F.length(value) >= 2), F.substring(value, F.lit(2), F.length(value) - 2)).otherwise(value)
    return lines.where((line != "") & ~F.startswith(line, F.lit("#")) & line.rlike(shape)).select(F.regexp_extract(line, shape, 1).alias("key"), bare.alias("value"))


def csv_list(column: Column) -> Column:
    """Members of a comma-separated list, trimmed, empty ones left out."""
    return F.filter(F.transform(F.split(column, ","), X.strip), lambda x: x != "")


def upsert_line(lines: DataFrame, key: str, value: str) -> DataFrame:
    """pos, value: the first line ``key=...`` replaced, or a new one appended.

    ``lines`` (pos, value) is one small file.
    """
    mine = F.startswith(X.strip(F.col("value")), F.lit(f"{key}="))
    at = lines.agg(F.min(F.when(mine, F.col("pos"))).alias("at"), F.max("pos").alias("end"))
    marked = lines.join(F.broadcast(at))
    changed = marked.select("pos", F.when(F.col("pos") == F.col("at"), f"{key}={value}").otherwise(F.col("value")).alias("value"))
    added = at.where("at is null").select((F.coalesce("end", F.lit(-1)) + 1).cast("int").alias("pos"), F.lit(f"{key}={value}").alias("value"))
    return changed.unionByName(added)


def write_units(units: DataFrame, path: str, bundle_by_law: bool = True) -> None:
    """Units as Parquet, by law if wished; readers then prune to the laws asked for."""
    writer = units.write.mode("overwrite")
    (writer.partitionBy("mst") if bundle_by_law else writer).parquet(path)


def write_index(index: DataFrame, path: str) -> None:
    """Ids and vectors of a search index as Parquet."""
    index.select("mst", "faiss_id", F.col("v").alias("embedding")).write.mode("overwrite").partitionBy("mst").parquet(path)


def write_markdown(documents: DataFrame, path: str) -> None:
    """One text file a row, by ``file_name``."""
    documents.select("file_name", F.col("md").alias("value")).write.mode("overwrite").partitionBy("file_name").text(path)
