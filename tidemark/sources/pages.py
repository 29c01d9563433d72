"""Landed JSON pages: records, catalogs, link batches and pipeline trees.

A page is ``{"results": [...], "paging": {...}, "total": n}``. Fields inside a result are read as
text, so one odd value never costs its neighbours; typing happens later, column by column.

Lists are unfolded with the outer form of ``explode`` and a filter behind it: for the inner form
the optimizer adds a size check in front, which would parse JSON held in a column once more.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RECORD = (
    "struct<id:string, properties:string, associations:string, archived:string, archivedAt:string>"
)
PROPERTY = "struct<name:string, type:string>"
ASSOCIATION = "struct<fromObjectTypeId:string, toObjectTypeId:string, name:string>"
OBJECT_SCHEMA = f"struct<objectTypeId:string, name:string, associations:array<{ASSOCIATION}>>"
LINK_BATCH = (
    "struct<`from`:struct<id:string>, `to`:array<struct<toObjectId:string,"
    " associationTypes:array<struct<typeId:string, category:string>>>>>"
)
STAGE = (
    "struct<id:string, label:string, displayOrder:int, createdAt:string, updatedAt:string,"
    " archived:boolean, metadata:struct<state:string, leadState:string>>"
)
PIPELINE = (
    "struct<id:string, label:string, displayOrder:int, createdAt:string, updatedAt:string,"
    f" archived:boolean, stages:array<{STAGE}>>"
)


def page_type(result: str) -> T.StructType:
    return T.StructType.fromDDL(
        f"results array<{result}>, paging struct<next:struct<after:string>>, total bigint,"
        " _corrupt string"
    )


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """``file, path, landed_at, bytes`` of the files below a folder, none of which is opened.

    ``file`` is the name that pages carry, ``path`` the one to read it by.
    """
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    try:
        return found.load(path).select(
            F.col("_metadata.file_path").alias("file"),
            "path",
            F.col("_metadata.file_modification_time").alias("landed_at"),
            F.col("_metadata.file_size").alias("bytes"),
        )
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "file string, path string, landed_at timestamp, bytes bigint")


def read_pages(
    spark: SparkSession,
    path: str,
    result: str = RECORD,
    multi_line: bool = False,
    landed_after: str | None = None,
    landed: bool = False,
    files: list[str] | None = None,
) -> DataFrame:
    """Pages of one kind, each with ``_page``, its place among all pages (file, then line).

    ``landed_after`` skips files that landed earlier without opening them; with ``landed`` the time
    that a page's file landed comes along as ``_landed``. With ``files`` only those below the path are
    read. An absent path is an empty feed.
    """
    schema = page_type(result)
    reader = (
        spark.read.schema(schema)
        .option("columnNameOfCorruptRecord", "_corrupt")
        .option("multiLine", multi_line)
    )
    if landed_after:
        reader = reader.option("modifiedAfter", landed_after)
    place = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
    )
    more = [F.col("_metadata.file_modification_time").alias("_landed")] if landed else []
    if files is not None:
        reader = reader.option("basePath", path)
    try:
        if files != []:
            return reader.json(files or path).select("*", place.alias("_page"), *more)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
    empty = spark.createDataFrame([], schema)
    none = F.lit(None)
    place = F.struct(
        none.cast("string").alias("file"),
        none.cast("bigint").alias("block"),
        none.cast("bigint").alias("line"),
    )
    more = [none.cast("timestamp").alias("_landed")] if landed else []
    return empty.select("*", place.alias("_page"), *more)


def parse_pages(df: DataFrame, text: str, order: str, result: str = RECORD) -> DataFrame:
    """Pages held as JSON text in a column; ``order`` gives their place."""
    page = F.from_json(
        F.col(text), page_type(result), {"columnNameOfCorruptRecord": "_corrupt"}
    )
    return df.select(page.alias("page"), F.col(order).alias("_page")).select("page.*", "_page")


def explode_results(pages: DataFrame, keep_unreadable: bool = False) -> DataFrame:
    """One row per result with ``_ord``, its arrival order over the whole feed.

    With ``keep_unreadable`` a page that is no JSON of the expected shape yields its text in
    ``_corrupt``, in a row of its own or beside the results that could still be read.
    """
    each = pages.select("_page", "_corrupt", F.posexplode_outer("results").alias("_pos", "_result"))
    place = F.struct("_page", "_pos").alias("_ord")
    if keep_unreadable:
        each = each.where(F.col("_pos").isNotNull() | F.col("_corrupt").isNotNull())
        return each.select("_result.*", place, "_corrupt")
    return each.where(F.col("_pos").isNotNull()).select("_result.*", place)


def unreadable_pages(pages: DataFrame) -> DataFrame:
    """``_ord, _corrupt``: the pages that are no JSON of the expected shape, one row each."""
    each = pages.select("_page", "_corrupt", F.posexplode_outer("results").alias("_pos", "_result"))
    broken = each.where(F.col("_corrupt").isNotNull() & (F.coalesce("_pos", F.lit(0)) == 0))
    return broken.select(F.struct("_page", "_pos").alias("_ord"), "_corrupt")


def is_archived() -> Column:
    return F.coalesce(F.col("archived") == "true", F.lit(False))


def active_records(records: DataFrame) -> DataFrame:
    return records.where(~is_archived())


def property_catalog(properties: DataFrame) -> DataFrame:
    """(name, type, _first place) with ``string`` for a missing type; of entries with one name the last holds."""
    last = F.max_by(F.coalesce("type", F.lit("string")), "_ord")
    return properties.groupBy("name").agg(last.alias("type"), F.min("_ord").alias("_first"))


def association_targets(schemas: DataFrame) -> DataFrame:
    """Distinct target types over all association definitions."""
    each = schemas.select(F.explode_outer("associations.toObjectTypeId").alias("to_type_id"))
    return each.where(F.col("to_type_id").isNotNull()).distinct()
