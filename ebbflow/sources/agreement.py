"""Do many files have the same columns? Names, types and order, file by file and all together."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

SCHEMA = "file string, place int, column string, type string"


def schema_table(spark: SparkSession, schemas: dict[str, T.StructType]) -> DataFrame:
    """file, place (from 0), column, type: one row for each column of each file. A file without
    columns has one row whose column is null. Schemas come from the files' footers
    (`readers.month_schemas`) or from tables; no data is read."""
    rows = []
    for file, schema in schemas.items():
        fields = [(file, at, f.name, f.dataType.simpleString()) for at, f in enumerate(schema.fields)]
        rows += fields or [(file, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA)


def column_agreement(schemas: DataFrame) -> DataFrame:
    """column, n_files (that have it), n_types, n_places and verdict, for each column of any file.

    The verdict is the first that holds: `missing` (some file lacks it), `type` (files differ in
    its type), `order` (they differ in its place), `same`. Names are compared letter by letter.
    """
    total = schemas.agg(F.count_distinct("file")).scalar()
    found = schemas.filter("column IS NOT NULL").groupBy("column").agg(
        F.count_distinct("file").alias("n_files"),
        F.count_distinct("type").alias("n_types"),
        F.count_distinct("place").alias("n_places"),
    )
    verdict = (
        F.when(F.col("n_files") < total, "missing")
        .when(F.col("n_types") > 1, "type")
        .when(F.col("n_places") > 1, "order")
        .otherwise("same")
    )
    return found.withColumn("verdict", verdict)


def file_agreement(schemas: DataFrame) -> DataFrame:
    """file, n_columns, columns (name and type in order, comma-joined), group and agrees.

    Files of one structure have one `group`: 0 is the structure of most files (the least text
    of columns on a tie), and a file agrees if it is of that group.
    """
    fields = F.transform(
        F.array_sort(F.collect_list(F.when(F.col("column").isNotNull(), F.struct("place", "column", "type")))),
        lambda f: F.concat_ws(" ", f["column"], f["type"]),
    )
    files = schemas.groupBy("file").agg(F.count("column").alias("n_columns"), F.array_join(fields, ",").alias("columns"))
    kinds = files.groupBy("columns").agg(F.count("*").alias("_n"))
    # A structure for each row, and a row for each file at most: a driver-made table of file names.
    ordered = kinds.agg(F.array_sort(F.collect_list(F.struct((-F.col("_n")).alias("n"), "columns"))).alias("k"))
    numbered = ordered.select(F.posexplode("k").alias("group", "k")).select("group", F.col("k.columns").alias("columns"))
    return files.join(numbered, "columns").select(
        "file", "n_columns", "columns", "group", (F.col("group") == 0).alias("agrees")
    )


def all_agree(schemas: DataFrame) -> DataFrame:
    """One row: n_files, n_structures and whether they are all of one structure (no file: true)."""
    files = file_agreement(schemas)
    return files.agg(
        F.count("*").alias("n_files"), F.count_distinct("group").alias("n_structures")
    ).withColumn("agrees", F.col("n_structures") <= 1)
