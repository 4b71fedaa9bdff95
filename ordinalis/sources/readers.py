"""Read reviews, submission templates and stages that are already on disk."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import DataType, StringType, StructField, StructType

from ordinalis.schema import REVIEW_SCHEMA, SUBMISSION_SCHEMA, TEST_SCHEMA
from ordinalis.sources import splitcsv, stages
from ordinalis.storage import path_complete

# Cell texts that mean "missing" in a review file, besides the empty cell.
NA_TOKENS = ("#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
             "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")


#: Columns a file may have besides those of its schema; they are kept where they are there.
OPTIONAL_COLUMNS = ("translated_review", "language", "translate_error")


def _parsed(cell: Column, kind: DataType, on_bad: str) -> Column:
    """The cell as a number: ``4`` and ``4.0`` are the integer 4; others fail, or are null on request."""
    if kind.typeName() == "string":
        return cell
    number = cell.try_cast("double")
    value = F.coalesce(cell.try_cast(kind), F.when(number == F.floor(number), number.try_cast(kind)))
    if on_bad == "null":
        return value
    problem = F.raise_error(F.concat(F.lit(f"not a value of type {kind.simpleString()}: "), cell)).cast(kind)
    return F.when(cell.isNotNull() & value.isNull(), problem).otherwise(value)


def load_reviews(spark: SparkSession, path: str, schema: StructType = REVIEW_SCHEMA,
                 multi_line: bool = True, na_tokens: tuple[str, ...] = NA_TOKENS, on_bad: str = "fail",
                 split_files: bool = False) -> DataFrame:
    """CSV with a header and quoted, possibly multi-line text; columns are found by name.

    The schema's columns come first, whatever their order in the file, then those of
    ``OPTIONAL_COLUMNS`` that are there; a missing column is an error, and so is a file of the
    folder with another header. A cell that isn't the number it should be fails the job
    (``on_bad="null"``: is null). Spark reads a multi-line file in one task. ``split_files=True``
    reads it in many, by two scans (``splitcsv``); quotes must then pair in every file, and stand
    around whole cells only. Set ``multi_line=False`` for texts without line breaks.
    """
    reader = spark.read.option("header", True).option("multiLine", multi_line).option("escape", '"')
    header = reader.csv(path).columns
    if missing := [f.name for f in schema.fields if f.name not in header]:
        raise ValueError(f"{path} lacks the columns {', '.join(missing)}")
    if split_files:
        df = splitcsv.cells(splitcsv.records(spark, path), header)
    else:
        texts = StructType([StructField(c, StringType()) for c in header])
        df = reader.schema(texts).option("enforceSchema", False).csv(path)

    def cell(name: str) -> Column:
        column = F.col(f"`{name}`")
        return F.when(~column.isin(*na_tokens), column) if na_tokens else column

    kept = [_parsed(cell(f.name), f.dataType, on_bad).alias(f.name) for f in schema.fields]
    return df.select(*kept, *[cell(c).alias(c) for c in OPTIONAL_COLUMNS if c in header])


def load_reviews_parquet(spark: SparkSession, path: str, schema: StructType = REVIEW_SCHEMA) -> DataFrame:
    """The same from Parquet: by name, cast to the schema, optional columns kept."""
    df = spark.read.parquet(path)
    if missing := [f.name for f in schema.fields if f.name not in df.columns]:
        raise ValueError(f"{path} lacks the columns {', '.join(missing)}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields],
                     *[c for c in OPTIONAL_COLUMNS if c in df.columns])


def check_ids(df: DataFrame, id_col: str = "id") -> DataFrame:
    """``df`` itself, once it is known that its ids are neither null nor repeated.

    Every stage joins and groups by id, so a repeated one would mix texts. One aggregate over
    the ids alone, combined map-side.
    """
    ids = df.groupBy(id_col).agg(F.count(F.lit(1)).alias("n"))
    bad = ids.where(F.col(id_col).isNull() | (F.col("n") > 1)).limit(3).collect()
    if bad:
        raise ValueError("ids must be unique and not null: " + ", ".join(f"{r[0]} ({r['n']} rows)" for r in bad))
    return df


def union_train_test(train: DataFrame, test: DataFrame) -> DataFrame:
    """Both tables by column name; ``split`` tells them apart, missing columns are null."""
    return (train.withColumn("split", F.lit("train"))
            .unionByName(test.withColumn("split", F.lit("test")), allowMissingColumns=True))


def load_train_test(spark: SparkSession, train_path: str, test_path: str, file_format: str = "csv",
                    check: bool = True, **options) -> DataFrame:
    """Both files as one table whose ids have been checked; ``file_format`` is csv or parquet."""
    load = {"csv": load_reviews, "parquet": load_reviews_parquet}[file_format]
    both = union_train_test(load(spark, train_path, **options), load(spark, test_path, TEST_SCHEMA, **options))
    return check_ids(both) if check else both


def split_train_test(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    return df.where(F.col("split") == "train"), df.where(F.col("split") == "test")


def load_submission_template(spark: SparkSession, path: str) -> DataFrame:
    """Headerless (id, value)."""
    return spark.read.schema(SUBMISSION_SCHEMA).option("header", False).csv(path)


def materialize_or_load(spark: SparkSession, path: str, build: Callable[[], DataFrame],
                        made_from: dict | None = None) -> DataFrame:
    """Read the stage at ``path`` if it is finished, else build and write it first.

    With ``made_from`` (what went into it; tables, settings and functions are described by
    ``stages.described``) only a stage made from exactly that is read, and others at the same
    path stay as they are. Without it, ``path`` is one table that is taken as it is.
    """
    if made_from is not None:
        return stages.keep_table(spark, path, stages.described(made_from), build)
    if not path_complete(spark, path):
        build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
