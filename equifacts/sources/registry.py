"""The indices whose constituents are collected, as a dimension table."""

from pyspark.sql import DataFrame, SparkSession

# Key, display name, constituent file, whether the index holds one sector only.
INDICES = [
    ("nifty_it", "Nifty IT", "ind_niftyitlist.csv", True),
    ("nifty_midcap_150", "Nifty Midcap 150", "ind_niftymidcap150list.csv", False),
    ("nifty_midsmallcap_400", "Nifty MidSmallcap 400", "ind_niftymidsmallcap400list.csv", False),
    ("nifty_smallcap_250", "Nifty Smallcap 250", "ind_niftysmallcap250list.csv", False),
    ("nifty_largemidcap_250", "Nifty LargeMidcap 250", "ind_niftylargemidcap250list.csv", False),
    ("nifty_midcap_select", "Nifty Midcap Select", "ind_niftymidcapselect_list.csv", False),
]

REGISTRY = (
    "index_key string, index_name string, csv_filename string, whole_sector boolean, "
    "index_rank int")


def index_registry(spark: SparkSession, selected: list[str] | None = None,
                   indices=INDICES) -> DataFrame:
    """Registry rows for a run in the requested order; an unknown key raises KeyError."""
    known = spark.createDataFrame([(*row, rank) for rank, row in enumerate(indices)], REGISTRY)
    if not selected:
        return known
    asked = spark.createDataFrame(
        list(zip(selected, range(len(selected)))), "index_key string, index_rank int")
    strange = asked.join(known, "index_key", "left_anti").select("index_key").collect()
    if strange:
        raise KeyError("no such index: " + ", ".join(r.index_key for r in strange))
    return known.drop("index_rank").join(asked, "index_key").select(known.columns)
