"""Readers of the raw feeds. Every schema is explicit; nothing is inferred.

Korean public CSV files come in code page 949. Spark reads it as `MS949`, which needs
`spark.sql.legacy.javaCharsets=true` on the session (`korean_charsets`); EUC-KR would
lose syllables.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ebbflow import vocab
from ebbflow.contracts import fail_if_any
from ebbflow.operators import employment
from ebbflow.operators.ili import SLOT_COLUMNS

KOREAN = "MS949"
CORRUPT = "_corrupt"

MOVEMENT_SCHEMA = T.StructType(
    [
        T.StructField("ETL_YMD", T.IntegerType()),
        T.StructField("TIME_CD", T.StringType()),
        T.StructField("O_CELL_ID", T.StringType()),
        T.StructField("D_CELL_ID", T.StringType()),
        T.StructField("SEX_CD", T.StringType()),
        T.StructField("AGE_CD", T.StringType()),
        T.StructField("PURPOSE", T.ByteType()),
        T.StructField("TOTAL", T.DoubleType()),
        T.StructField("AVG_DIST", T.DoubleType()),
        T.StructField("AVG_TIME", T.DoubleType()),
    ]
)
POPULATION_SCHEMA = T.StructType(
    [
        T.StructField("ETL_YMD", T.IntegerType()),
        T.StructField("TIMEZN_CD", T.StringType()),
        T.StructField("ADMDONG_CD", T.StringType()),
        T.StructField("SEX_AGE_CD", T.StringType()),
        T.StructField("POP", T.DoubleType()),
    ]
)


def korean_charsets(spark: SparkSession) -> SparkSession:
    spark.conf.set("spark.sql.legacy.javaCharsets", "true")
    return spark


def _csv(spark: SparkSession, path: str | Sequence[str], schema: T.StructType, **options) -> DataFrame:
    """CSV of a known header: a file with other columns, or in another order, fails, and so does a
    row that does not parse. Every column is parsed, or a header would be checked in part only."""
    paths = path if isinstance(path, str) else list(path)
    strict = {"mode": "FAILFAST", "enforceSchema": False, "columnPruning": False}
    return spark.read.schema(schema).options(**{**strict, **options}).csv(paths)


def movement_csv(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    return _csv(spark, path, MOVEMENT_SCHEMA, header=True)


def population_csv(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    return _csv(spark, path, POPULATION_SCHEMA, header=True)


def split_feed(
    spark: SparkSession, path: str | Sequence[str], schema: T.StructType
) -> tuple[DataFrame, DataFrame]:
    """The rows of a feed that parse, and the others as they stand: two tables over the same files.

    Both have `yyyymm`, the month in the name of the row's file (null if the name has none). The
    others, for a quarantine, are `file` and `line`: a value of the wrong type, or too few or too
    many values. A file of another header fails either way.
    """
    names = schema.names
    text = T.StructType([T.StructField(c, T.StringType()) for c in [*names, CORRUPT]])
    read = _csv(spark, path, text, header=True, mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT)
    file = F.col("_metadata.file_path")
    month = F.nullif(F.regexp_extract(file, r"_(\d{6})[^/]*$", 1), F.lit(""))
    placed = read.select("*", file.alias("file"), month.alias("yyyymm"))
    # Spark's parser looks at the columns of a query only; here every column decides in every query.
    cast = {f.name: F.col(f.name).try_cast(f.dataType) for f in schema.fields}
    whole = F.col(CORRUPT).isNull()
    for c in names:
        whole = whole & (F.col(c).isNull() | cast[c].isNotNull())
    good = placed.filter(whole).select(*[v.alias(c) for c, v in cast.items()], "yyyymm")
    line = F.coalesce(F.col(CORRUPT), F.to_csv(F.struct(*names)))
    bad = placed.filter(~whole).select("yyyymm", "file", line.alias("line"))
    return good, bad


def census_csv(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Census text tables, every column text.

    Each path (a file, or a folder or glob whose files share a header) is read by its own
    header and the tables are united by column name; a file with another header than the first
    of its path fails, and so do paths with different columns.
    """
    korean_charsets(spark)
    options = {"header": True, "encoding": KOREAN}
    found = None
    for one in [path] if isinstance(path, str) else list(path):
        names = spark.read.options(inferSchema=False, **options).csv(one).schema
        read = _csv(spark, one, names, enforceSchema=False, **options)
        found = read if found is None else found.unionByName(read)
    return found


def employment_csv(spark: SparkSession, path: str) -> DataFrame:
    """Headerless table below title rows.

    Spark has no row skipping: a title row names no sex and has no number in any number column.
    Any other row must be data: thousands separators are taken out, and a number that still
    does not parse, or an unknown sex beside numbers, fails when the result is computed.
    """
    korean_charsets(spark)
    names = employment.RAW_COLUMNS
    text = T.StructType([T.StructField(c, T.StringType()) for c in names])
    raw = spark.read.schema(text).options(encoding=KOREAN).csv(path)
    known = F.coalesce(F.col("sex").isin(vocab.EMPLOYMENT_SEXES), F.lit(False))
    number = F.exists(F.array(*names[3:]), lambda c: F.coalesce(F.trim(c), F.lit("")).rlike(r"^-?[\d,]+$"))
    numbers = [F.replace(F.trim(c), F.lit(","), F.lit("")).cast("bigint").alias(c) for c in names[3:]]
    data = raw.filter(known).select(*names[:3], *numbers)
    # the check comes last: a filter above it could remove it
    return fail_if_any(data, raw.filter(~known & number), "employment table: unknown sex")


def ili_csv(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Ragged season rows: short rows are padded with null, blank lines dropped.

    A row with a value past the last slot fails when the result is computed.
    """
    korean_charsets(spark)
    over = "_over"
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ["season", *SLOT_COLUMNS, over]])
    paths = path if isinstance(path, str) else list(path)
    read = spark.read.schema(schema).options(encoding=KOREAN, mode="PERMISSIVE").csv(paths)
    message = f"season row of more than {len(SLOT_COLUMNS)} weeks"
    some = F.when(F.col(over).isNull(), F.col("season")).otherwise(F.raise_error(F.lit(message)))
    return read.withColumn("season", some).drop(over)


def ili_by_age_csv(spark: SparkSession, directory: str) -> DataFrame:
    """Seasons of all age groups from files named `..._<group><suffix>.csv`.

    A file of an unknown group fails when the result is computed.
    """
    label = F.regexp_extract(F.input_file_name(), r"_([^_/]+)\.csv$", 1)
    # File suffix of each surveillance group.
    suffixes = {
        "0세": "0", "1-6세": "1-6", "7-12세": "7-12", "13-18세": "13-18",
        "19-49세": "19-49", "50-64세": "50-64", "65세이상": "65+",
    }
    decoded = F.url_decode(label)
    group = F.try_element_at(F.create_map(*[F.lit(v) for kv in suffixes.items() for v in kv]), decoded)
    read = ili_csv(spark, directory).withColumn("age_group", group)
    return fail_if_any(read, read.filter(F.col("age_group").isNull()), "surveillance file of an unknown age group")


def claims_csv(spark: SparkSession, path: str) -> DataFrame:
    """Claims sheet exported as UTF-8 CSV under its own column names."""
    text = ["요양개시일자", "성별", "연령군"]
    schema = T.StructType(
        [
            T.StructField(c, T.StringType() if c in text else T.LongType())
            for c in vocab.CLAIMS_COLUMNS
        ]
    )
    return _csv(spark, path, schema, header=True)


def parquet(spark: SparkSession, path: str | Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """Parquet with the wanted columns only; globs and several paths are one scan."""
    paths = [path] if isinstance(path, str) else list(path)
    df = spark.read.parquet(*paths)
    return df.select(*columns) if columns else df


def merge_schemas(schemas: Iterable[T.StructType]) -> T.StructType:
    """One schema with the columns of all, in the order in which they first appear. A column of
    two types fails."""
    found: dict[str, T.StructField] = {}
    for schema in schemas:
        for f in schema.fields:
            known = found.setdefault(f.name, T.StructField(f.name, f.dataType))
            if known.dataType != f.dataType:
                raise ValueError(
                    f"column {f.name} is {known.dataType.simpleString()} in one month and "
                    f"{f.dataType.simpleString()} in another"
                )
    return T.StructType(list(found.values()))


def month_schemas(spark: SparkSession, root: str) -> dict[str, T.StructType]:
    """The schema of each month of a table partitioned by yyyymm, oldest first: the footer of one
    file a month, since a month is written by one run."""
    one = files(spark, root, "*.parquet").groupBy("yyyymm").agg(F.min("path").alias("path")).collect()
    return {r.yyyymm: spark.read.parquet(r.path).schema for r in sorted(one, key=lambda r: r.yyyymm)}


def months(
    spark: SparkSession, root: str, first: str, last: str, schemas: dict[str, T.StructType] | None = None
) -> DataFrame:
    """Months [first, last] of a table partitioned by yyyymm: other folders are not read.

    Months may differ in their columns (some have `purpose`): the result has those of all the
    months of the table, null where a month has none, whichever file Spark meets first. `schemas`
    are those of `month_schemas`, if the caller has them.
    """
    known = month_schemas(spark, root) if schemas is None else schemas
    fields = [f for f in merge_schemas(known.values()).fields if f.name != "yyyymm"]
    schema = T.StructType([*fields, T.StructField("yyyymm", T.IntegerType())])
    return spark.read.schema(schema).parquet(root).filter(
        F.col("yyyymm").cast("string").between(F.lit(first), F.lit(last))
    )


def files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Path, month in the name and size of the files below a folder; content is not read."""
    listed = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .load(path)
        .select("path", F.col("length").alias("bytes"))
    )
    return listed.withColumn("yyyymm", F.regexp_extract("path", r"(?:yyyymm=|_)(\d{6})(?=[/.])", 1))
