"""Recursive inventory of a folder."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def inventory(listing: DataFrame, root: str = "") -> DataFrame:
    """Files and folders of a listing: path, name, modificationTime, type (`file` or `folder`), for paths below `root`.

    `listing` has path and modificationTime of each file, as storage inventories do; names of any kind count, hidden ones
    too. Folders are read off the paths, each once, with the latest time of the files below them: tasks make the distinct folders of their
    files first. A folder without any file does not show unless it is listed itself, with a trailing slash.
    """
    root = root.rstrip("/")
    below = F.expr(f"substring(path, {len(root) + 2 if root else 1})")
    is_file = ~F.endswith("path", F.lit("/"))
    parts = F.split(F.rtrim(below, F.lit("/")), "/")
    depth = F.size(parts) - is_file.cast("int")
    above = F.when(depth > 0, F.transform(F.sequence(F.lit(1), depth), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/")))
    folders = (
        listing.select(F.explode(above).alias("folder"), "modificationTime")
        .groupBy("folder")
        .agg(F.max("modificationTime").alias("modificationTime"))
        .select(F.concat(F.lit(root + "/" if root else ""), "folder").alias("path"), "modificationTime")
    )
    files = listing.where(is_file).select("path", "modificationTime")
    listed = files.withColumn("type", F.lit("file")).unionByName(folders.withColumn("type", F.lit("folder")))
    return listed.select("path", F.element_at(F.split("path", "/"), -1).alias("name"), "modificationTime", "type")


def file_inventory(spark: SparkSession, path: str) -> DataFrame:
    """`inventory` of the files that Spark lists below the absolute `path` or URL, without opening them; times are epoch ms.

    Names that start with `_` or `.` are hidden from Spark. For a store with many files, give its own inventory table to `inventory`.
    """
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    files = found.select("path", F.unix_millis("modificationTime").alias("modificationTime"))
    bare = re.sub(r"^[A-Za-z][\w+.-]*:(//[^/]*)?", "", path).rstrip("/")
    first = files.select(F.expr(f"substring(path, 1, locate('{bare}/', path) + {len(bare)} - 1)").alias("root")).first()
    return inventory(files, first["root"] if first else bare)
