"""Scan of the landed constituent files."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from equifacts.functions.text import normalise, unescape_columns
from equifacts.schemas import CONSTITUENT_CSV

ORDERED = ["index_key", "index_rank", "block_start", "row_pos"]


def read_constituents(spark: SparkSession, paths, registry: DataFrame) -> DataFrame:
    """Rows of every registered file, tagged with their index.

    ``row_pos`` orders the rows of one file: the row ids rise within a file block, and
    ``block_start`` orders the blocks of a file that was split.
    """
    scan = (
        spark.read.schema(CONSTITUENT_CSV).csv(paths, header=True, escape='"')
        .select(
            "*",
            F.col("_metadata.file_name").alias("csv_filename"),
            F.col("_metadata.file_block_start").alias("block_start"),
            F.monotonically_increasing_id().alias("row_pos")))
    tagged = scan.join(
        registry.select("csv_filename", "index_key", "index_rank"), "csv_filename")
    return clean_constituents(tagged)


def clean_constituents(rows: DataFrame) -> DataFrame:
    """Clean the fields, drop rows without symbol or name, default the others to ''."""
    named = rows.withColumnsRenamed({
        "Symbol": "nse_symbol", "Company Name": "company_name", "Industry": "nse_industry",
        "ISIN Code": "isin"})
    texts = ["nse_symbol", "company_name", "nse_industry", "isin"]
    decoded = unescape_columns(named.select(*texts, *ORDERED), texts)
    cleaned = decoded.withColumns({t: normalise(F.col(t)) for t in texts})
    kept = cleaned.where(F.col("nse_symbol").isNotNull() & F.col("company_name").isNotNull())
    return kept.withColumns({
        t: F.coalesce(F.col(t), F.lit("")) for t in ("nse_industry", "isin")})
