"""Reading and writing the call table, its stages and its marts."""

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from turnout.operators.ranking import top_k
from turnout.schema import KEY, RAW


def read_raw_csv(
    spark: SparkSession, path: str, schema: T.StructType | None = RAW, infer: bool = False,
    extra: str = "keep", key: str = KEY, rescued: str | None = None,
) -> DataFrame:
    """Raw delimited text with a header line, whose names say which column is which.

    Wanted columns (those of ``schema``) come first and under their own names, wherever the file
    has them; names match whatever their case and the blanks around them.  A wanted column that the file lacks
    is null, except the key, which must be there.  Other columns of the file follow as text,
    or are left out with ``extra="drop"``.  Short lines are filled with nulls, fields
    beyond the header have no name and are not read, and no line is rejected.  Files of one read whose
    headers differ from each other raise an error.

    ``rescued`` names one more column, the last, with the whole text of each line that has more or fewer
    fields than the header, and null for the others: nothing of such a line is lost, and they can be counted.

    With ``schema=None`` all columns come as the file has them; with ``infer`` Spark also guesses
    their types, at the price of one more pass over the text.
    """
    if extra not in ("keep", "drop"):
        raise ValueError(f"extra must be 'keep' or 'drop', not {extra!r}")
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE")
    if infer:
        return reader.option("inferSchema", True).csv(path)
    found = reader.csv(path)
    # Named from the header, and checked against the header of every file.
    reader = reader.option("enforceSchema", False)
    names, lines = list(found.columns), []
    if rescued is None:
        found = reader.schema(found.schema).csv(path)
    else:
        whole = T.StructType([*found.schema.fields, T.StructField(rescued, T.StringType())])
        # All fields of a line are parsed, whichever are asked for; else no line would have too many.
        found = reader.schema(whole).option("columnNameOfCorruptRecord", rescued).option("columnPruning", False).csv(path)
        # The reader refuses a query of that column alone; so it comes with an empty part of another.
        empty = F.coalesce(F.substring(F.col(f"`{names[0]}`"), 1, 0), F.lit(""))
        lines = [F.concat(empty, F.col(f"`{rescued}`")).alias(rescued)]
    if schema is None:
        return found.select(*[F.col(f"`{c}`") for c in names], *lines)
    places = {}
    for name in names:
        places.setdefault(name.strip().upper(), name)
    wanted = {field.name: places.pop(field.name.upper(), None) for field in schema.fields}
    if key in wanted and wanted[key] is None:
        raise ValueError(f"the header has no column {key}: {', '.join(names)}")
    columns = [
        (F.lit(None) if wanted[f.name] is None else F.col(f"`{wanted[f.name]}`")).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ]
    used = set(wanted.values())
    rest = [F.col(f"`{c}`") for c in names if c not in used] if extra == "keep" else []
    return found.select(*columns, *rest, *lines)


def read_stage(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_stage(df: DataFrame, path: str, files: int | None = None) -> None:
    """Replace a parquet stage; ``files`` spreads the rows evenly over that many files.

    Without ``files`` every task writes what it holds, which saves a shuffle of
    the whole table.
    """
    if files is not None:
        df = df.repartition(files)
    df.write.mode("overwrite").parquet(path)


# --- stages in versions ----------------------------------------------------

#: Below a stage's folder: one folder for each version, and the table that says which of them count.
_VERSION, _MANIFEST = "version={}", "_manifest"
_MANIFEST_SCHEMA = "number bigint, version string, written_at timestamp"


def stage_versions(spark: SparkSession, path: str) -> DataFrame:
    """The versions of a stage that were written whole: ``number``, ``version`` and ``written_at``."""
    return spark.read.schema(_MANIFEST_SCHEMA).parquet(f"{path}/{_MANIFEST}")


def _current(spark: SparkSession, path: str):
    try:
        return stage_versions(spark, path).orderBy(F.desc("number"), F.desc("version")).first()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def replace_stage(df: DataFrame, path: str, files: int | None = None) -> str:
    """Write a new version of a stage, then name it in the manifest; returns its folder.

    Readers see the version before until the manifest's own small file is committed, and after a
    write that fails they go on seeing it.  Old versions stay, so ``df`` may come from the stage itself;
    their owner removes them once no reader needs them.
    """
    spark = df.sparkSession
    before = _current(spark, path)
    version = uuid.uuid4().hex
    folder = f"{path}/{_VERSION.format(version)}"
    write_stage(df, folder, files)
    row = spark.range(1).select(
        F.lit(1 if before is None else before.number + 1).cast("bigint").alias("number"),
        F.lit(version).alias("version"), F.current_timestamp().alias("written_at"))
    row.write.mode("append").parquet(f"{path}/{_MANIFEST}")
    return folder


def read_current(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """The newest version of a stage, or that of a number."""
    found = _current(spark, path) if number is None else stage_versions(spark, path).where(
        F.col("number") == number).orderBy(F.desc("version")).first()
    if found is None:
        raise FileNotFoundError(f"no version {'' if number is None else number} of a stage in {path}")
    return read_stage(spark, f"{path}/{_VERSION.format(found.version)}")


def write_csv(df: DataFrame, path: str) -> None:
    """Replace a delimited-text copy with a header line; blanks around values are kept."""
    (
        df.write.mode("overwrite").option("header", True)
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def write_marts(marts: dict[str, DataFrame], root: str, versions: bool = False) -> None:
    """Write each mart below ``root``, under the relative path that is its key, if asked for as a new version."""
    for name, mart in marts.items():
        (replace_stage if versions else write_stage)(mart, f"{root}/{name}")


def read_marts(spark: SparkSession, root: str, names, versions: bool = False) -> dict[str, DataFrame]:
    return {name: (read_current if versions else read_stage)(spark, f"{root}/{name}") for name in names}


def preview_mart(
    mart: DataFrame, order: str | None = None, n: int = 5, ascending: bool = False, ties=()
) -> DataFrame:
    """The first rows of a mart, or its n highest (lowest) rows by a column."""
    if order is None:
        return mart.limit(n)
    return top_k(mart, order, n, ascending, ties)
