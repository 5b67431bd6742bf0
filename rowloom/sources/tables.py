"""Reading and writing tables at the edges: CSV, JSON, Parquet, LaTeX."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def text_schema(columns: list[str]) -> StructType:
    return StructType([StructField(c, StringType()) for c in columns])


def read_csv(spark: SparkSession, paths: str | list[str], columns: list[str] | None = None) -> DataFrame:
    """CSV with a header, all columns text, quoted line breaks kept.  ``__file`` and ``__row`` say
    where a row came from, so that the order of files and rows is known."""
    if columns is None:
        first = paths if isinstance(paths, str) else sorted(paths)[0]
        columns = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(first).columns
    reader = spark.read.schema(text_schema(columns)).option("header", True).option("multiLine", True).option("escape", '"')
    rows = reader.csv(paths if isinstance(paths, str) else sorted(paths))
    return rows.select("*", F.col("_metadata.file_path").alias("__file"), F.monotonically_increasing_id().alias("__row"))


def first_per_url(rows: DataFrame, url: str = "source_url") -> DataFrame:
    """The first row per address in file and row order; all empty addresses are one."""
    from rowloom.operators.select import first_per_key

    return first_per_key(rows, F.coalesce(F.col(url), F.lit("")), [F.col("__file"), F.col("__row")]).drop("__file", "__row")


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One JSON object a line; blank lines and a missing file give no rows."""
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    if not at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json(path).where(F.coalesce(*[F.col(c).cast("string") for c in StructType.fromDDL(schema).names]).isNotNull())


def read_document(spark: SparkSession, path: str) -> DataFrame:
    """One nested JSON document as one row."""
    return spark.read.option("multiLine", True).json(path)


def keyed_degrees(degrees: DataFrame, ordinal: Column) -> DataFrame:
    """Degrees with ``degree_key``, the last of each key; rows without an id are dropped."""
    from rowloom.operators.select import first_per_key

    some = F.length(F.trim(F.coalesce("source_id", F.lit("")))) > 0
    key = F.concat_ws("::", F.lit("degree"), F.lower(F.trim("source")), F.trim("source_id"))
    return first_per_key(degrees.where(some).withColumn("degree_key", key), F.col("degree_key"), [ordinal.desc()])


def write_csv(df: DataFrame, path: str, columns: list[str] | None = None, one_file: bool = False) -> bool:
    """CSV with a header.  An empty table writes nothing and leaves what is there; says if it wrote.

    ``one_file`` is for small reports; exports of any size stay in one file per task."""
    out = df.select(*columns) if columns else df
    if out.isEmpty():
        return False
    (out.coalesce(1) if one_file else out).write.mode("overwrite").option("header", True).option("escape", '"').option(
        "ignoreLeadingWhiteSpace", False
    ).option("ignoreTrailingWhiteSpace", False).csv(path)
    return True


def write_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def jobs_export(state: DataFrame) -> DataFrame:
    """Newest publication first, then by source; a null date counts as empty."""
    return state.orderBy(F.coalesce("publication_date", F.lit("")).desc(), F.col("source").asc(), F.col("job_key"))


# The columns of exported pairs.
PAIR_COLUMNS = [
    "pair_key", "job_key", "degree_key", "job_title", "degree_title", "score", "provider", "model", "job_text_hash",
    "degree_text_hash", "created_at", "updated_at",
]


def similarity_export(pairs: DataFrame) -> DataFrame:
    """The pairs' own columns, highest score first."""
    return pairs.select(*[c for c in PAIR_COLUMNS if c in pairs.columns]).orderBy(F.desc_nulls_last("score"), "pair_key")


def degrees_export(degrees: DataFrame) -> DataFrame:
    return degrees.orderBy("source", "title")


def markdown_memo(title: str, lines: dict[str, object], tables: dict[str, DataFrame], rows: int = 200) -> str:
    """A short report: facts as a list, then small tables; more than ``rows`` rows in one are an error."""
    out = [f"# {title}", ""] + [f"- {k}: {v}" for k, v in lines.items()]
    for name, df in tables.items():
        found = df.limit(rows + 1).collect()
        if len(found) > rows:
            raise ValueError("too many rows for a report table")
        cell = lambda v: "" if v is None else f"{v:.5f}" if isinstance(v, float) else str(v).replace("|", r"\|")
        out += ["", f"## {name}", "", "| " + " | ".join(df.columns) + " |", "|" + "---|" * len(df.columns)]
        out += ["| " + " | ".join(map(cell, r)) + " |" for r in found]
    return "\n".join(out) + "\n"


def percent(col: Column) -> Column:
    return F.format_string("%.1f%%", 100 * col)


def latex_table(df: DataFrame, rows: int = 200) -> str:
    """A small report as a LaTeX table; more than ``rows`` rows are an error."""
    found = df.limit(rows + 1).collect()
    if len(found) > rows:
        raise ValueError("too many rows for a report table")
    cell = lambda v: "" if v is None else f"{v:.5f}" if isinstance(v, float) else str(v).replace("_", r"\_")
    lines = [" & ".join(c.replace("_", r"\_") for c in df.columns)] + [" & ".join(map(cell, r)) for r in found]
    return "\\begin{tabular}{" + "l" * len(df.columns) + "}\n" + " \\\\\n".join(lines) + " \\\\\n\\end{tabular}\n"
