"""Files of one JSON array each, read in many splits.

A file is cut after every closing brace, wherever that stands, so any split can
begin reading. Whether a piece starts inside a string, how deep it lies, and to
which element of the array it belongs follow from sums over the pieces before it:
quotes, braces outside strings, and braces that close an element. Pieces of one
element are then put together and parsed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from egoline.operators.ordered import preceded, stored


def _count(text: Column, letter: str) -> Column:
    return (F.length(text) - F.length(F.replace(text, F.lit(letter), F.lit("")))).cast("long")


def read_json_arrays(spark: SparkSession, path: str, schema: T.StructType, glob: str = "*") -> DataFrame:
    """``(file_name, element, *schema)``: the objects of each file's array, ``element``
    their place from 0.

    No task reads a file whole and no cell is larger than an element. Braces,
    brackets and commas inside strings and nested objects are handled. An element
    that is an object but does not parse gives nulls; elements that are no
    objects are not returned.
    """
    raw = spark.read.option("lineSep", "}").option("pathGlobFilter", glob).text(path)
    raw = raw.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_name").alias("file_name"),
                     F.col("_metadata.file_block_start").alias("block"), "value")
    pieces = stored(raw.withColumn("at", F.monotonically_increasing_id()), "array-pieces")
    plain = F.regexp_replace("value", r"(?s)\\.", "")  # an escape never spans the cut: no brace can be escaped
    outside = lambda t: _count(F.regexp_replace(t, r'"[^"]*("|$)', ""), "{")
    told = pieces.select("file", "block", "at", _count(plain, '"').alias("quotes"), outside(plain).alias("open0"),
                         outside(F.regexp_replace(plain, r'^[^"]*("|$)', "")).alias("open1"))
    place = ["block", "at"]
    told = preceded(told, ["file"], place, "quotes", "q")
    inside = F.col("q") % 2 == 1
    closes = (F.col("q") + F.col("quotes")) % 2 == 0  # the brace after the piece is outside strings
    told = told.select("file", *place, closes.alias("closes"),
                       (F.when(inside, F.col("open1")).otherwise(F.col("open0")) - F.when(closes, 1).otherwise(0)).alias("rise"))
    told = preceded(told, ["file"], place, "rise", "depth")
    told = told.select("file", *place, (F.col("closes") & (F.col("depth") + F.col("rise") == 0)).cast("long").alias("ends"))
    told = preceded(told, ["file"], place, "ends", "element").select("file", "at", "element")
    whole = (pieces.join(told, ["file", "at"]).groupBy("file", "file_name", "element")
             .agg(F.array_sort(F.collect_list(F.struct("block", "at", "value"))).alias("l")))
    text = F.concat(F.array_join(F.transform("l", lambda x: x["value"]), "}"), F.lit("}"))
    text = F.regexp_replace(text, r"^[\s,\[]+", "")
    rows = whole.select("file_name", "element", text.alias("text")).filter(F.col("text").startswith("{"))
    return rows.select("file_name", "element", F.from_json("text", schema).alias("x")).select("file_name", "element", "x.*")
