"""Sources: driver tables, crawl-index lines, raw pages, JSONL documents, archive files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as Ty

from textsift.session import ship

INDEX_JSON_SCHEMA = Ty.StructType([
    Ty.StructField("url", Ty.StringType()),
    Ty.StructField("status", Ty.StringType()),
    Ty.StructField("mime", Ty.StringType()),
])

RAW_PAGE_SCHEMA = Ty.StructType([
    Ty.StructField("url", Ty.StringType()),
    Ty.StructField("timestamp", Ty.StringType()),
    Ty.StructField("html", Ty.StringType()),
])

DOCUMENT_SCHEMA = Ty.StructType([
    Ty.StructField("id", Ty.StringType()),
    Ty.StructField("text", Ty.StringType()),
    Ty.StructField("title", Ty.StringType()),
    Ty.StructField("metadata", Ty.StructType([
        Ty.StructField("url", Ty.StringType()),
        Ty.StructField("date", Ty.StringType()),
        Ty.StructField("file_path", Ty.StringType()),
        Ty.StructField("token_count", Ty.LongType()),
        Ty.StructField("language", Ty.StringType()),
        Ty.StructField("language_score", Ty.DoubleType()),
        Ty.StructField("filter_reason", Ty.StringType()),
        Ty.StructField("quality_label", Ty.StringType()),
    ])),
    Ty.StructField("_corrupt_record", Ty.StringType()),
])


def spread(df: DataFrame, tasks_per_core: int = 4) -> DataFrame:
    """Give CPU-heavy per-document work several partitions per core.

    A small input (one file, one row group) scans as one partition and would run every rule in one task. Several
    tasks per core keep cores busy when document lengths vary (a 20,000-word document costs 1,000 short ones).
    At cluster scale the scan already yields many more splits than cores and this is a no-op (no shuffle).
    """
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    # The split count is not a reliable signal: a file with one row group plans as several byte-range splits, all
    # but one empty. Decide on the optimizer's size estimate instead: less than one full split per core = small.
    try:
        size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
        split = int(spark.conf.get("spark.sql.files.maxPartitionBytes", "134217728").rstrip("b"))
        small = size < cores * split
    except Exception:  # noqa: BLE001 - no JVM plan access (e.g. a Connect session): fall back to the split count
        small = df.rdd.getNumPartitions() < cores
    if small:
        return df.repartition(cores * tasks_per_core)
    return df


def spread_files(df: DataFrame, tasks_per_core: int = 4) -> DataFrame:
    """``spread`` for rows of files that can't be split (gzip): as many partitions as were read say how many tasks there are,
    the files' compressed bytes don't. With several a core it is a no-op."""
    tasks = df.sparkSession.sparkContext.defaultParallelism * tasks_per_core
    return df if df.rdd.getNumPartitions() >= tasks else df.repartition(tasks)


def table(spark: SparkSession, sf_dir: str, name: str, *, cpu_heavy: bool = False) -> DataFrame:
    """A driver table ``{sf_dir}/{name}.parquet``; ``cpu_heavy`` spreads it over the cores."""
    ship(spark)
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return spread(df) if cpu_heavy else df


# --- S1/S2: crawl index lines --------------------------------------------------------------------------------------

def parse_index_lines(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """``{surt} {timestamp} {json}`` split on the first two spaces; bad JSON leaves nulls and keeps the raw line.

    Output: surt, timestamp, url, status, mime, _raw (null when the JSON parsed).
    """
    parts = F.split(F.col(value_col), " ", 3)
    parsed = F.from_json(F.element_at(parts, 3), INDEX_JSON_SCHEMA, {"mode": "PERMISSIVE"})
    return (lines.select(F.element_at(parts, 1).alias("surt"), F.element_at(parts, 2).alias("timestamp"),
                         parsed.alias("_j"), F.col(value_col).alias("_line"))
            .select("surt", "timestamp", "_j.url", "_j.status", "_j.mime",
                    F.when(F.col("_j").isNull() | F.col("_j.url").isNull(), F.col("_line")).alias("_raw")))


def read_index(spark: SparkSession, path: str, collection: str | None = None, suffix: str = ".cdxj") -> DataFrame:
    """S1+S2: index files of one collection (file name starts with ``collection`` and ends with ``suffix``)."""
    glob = f"{collection or ''}*{suffix}"
    lines = spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", "true").text(path)
    return parse_index_lines(lines)


def index_rows_from_pages(pages: DataFrame) -> DataFrame:
    """Index rows derived from the ``pages`` table (FIXTURES.md §2), with every fifth page repeated.

    surt = reversed host labels joined by ',' + ')' + path; timestamp = 20080101000000 + page_id; status '404'
    when page_id % 7 = 0 else '200'; mime 'application/pdf' when page_id % 11 = 0 else 'text/html'.
    """
    host = F.lower(F.regexp_extract("url", r"^[a-zA-Z]+://([^/:?#]+)", 1))
    path = F.regexp_extract("url", r"^[a-zA-Z]+://[^/?#]+([^?#]*)", 1)
    surt = F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), path)
    rows = pages.select(
        "page_id", surt.alias("surt"),
        (F.lit(20080101000000) + F.col("page_id")).cast("string").alias("timestamp"),
        "url",
        F.when(F.col("page_id") % 7 == 0, F.lit("404")).otherwise(F.lit("200")).alias("status"),
        F.when(F.col("page_id") % 11 == 0, F.lit("application/pdf")).otherwise(F.lit("text/html")).alias("mime"))
    return rows.unionByName(rows.where(F.col("page_id") % 5 == 0))


def index_lines_from_pages(pages: DataFrame) -> DataFrame:
    """The same rows rendered as raw index text lines (``value``), for the line parser."""
    r = index_rows_from_pages(pages)
    js = F.to_json(F.struct("url", "status", "mime"))
    return r.select(F.concat_ws(" ", "surt", "timestamp", js).alias("value"))


# --- S3/S4/S5: JSONL pages and documents ---------------------------------------------------------------------------

def read_raw_pages(spark: SparkSession, path: str) -> DataFrame:
    """S3: JSONL ``{url, timestamp, html}`` with an explicit schema."""
    return spark.read.schema(RAW_PAGE_SCHEMA).json(path)


def read_documents(spark: SparkSession, path: str, recursive: bool = True, glob: str = "*.jsonl.gz",
                   schema: Ty.StructType = DOCUMENT_SCHEMA) -> DataFrame:
    """Gz JSONL documents. Malformed lines are kept in ``_corrupt_record`` (PERMISSIVE) and counted.

    gzip files are not splittable: one task per file, so ``spread`` the result before CPU-heavy work.
    """
    r = (spark.read.schema(schema).option("mode", "PERMISSIVE")
         .option("columnNameOfCorruptRecord", "_corrupt_record").option("pathGlobFilter", glob))
    if recursive:
        r = r.option("recursiveFileLookup", "true")
    return r.json(path).withColumn("file_path", F.col("_metadata.file_path"))


def collection_of(file_name: Column) -> Column:
    """collection = text before the first '_' of the file name."""
    return F.split_part(file_name, F.lit("_"), F.lit(1))


# --- S8: incremental skip-done -------------------------------------------------------------------------------------

def skip_done(inputs: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Inputs whose key already appears in the done manifest are skipped (left anti join on the keys)."""
    return inputs.join(done.select(*keys).distinct(), on=keys, how="left_anti")
