"""Which addresses an outside crawler has to fetch in a run."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from equifacts.functions.text import url_part
from equifacts.sources.feeds import REQUESTED_ROWS, RESULT_KINDS

# Paths of the feeds; the caller names the hosts.
SUGGEST_PATH = "/mccode/common/autosuggestion_solr.php?classic=true&query=%s&type=1&format=json"
PRICE_PATH = "/pricefeed/nse/equitycash/%s"
RESULTS_PATH = "/jsonapi/stocks/{kind}_results_responsive?sc_id=%s&type_format={kind}&start=0&limit={limit}"


def templates(suggest_host: str, price_host: str, results_host: str) -> dict[str, str]:
    """Address template of each stage that asks by id."""
    stages = {"resolve": suggest_host + SUGGEST_PATH, "pricefeed": price_host + PRICE_PATH}
    for kind in RESULT_KINDS:
        stages[kind] = results_host + RESULTS_PATH.format(kind=kind, limit=REQUESTED_ROWS)
    return stages


def request_manifest(universe: DataFrame, key: str, ids: dict[str, str],
                     stages: dict[str, str], page_link: str | None = None,
                     stale: str | None = None) -> DataFrame:
    """One row per request: ``ids`` names the id column of each stage. The page is asked
    for where ``stale`` holds. Rows without an id have nothing to ask."""
    wanted = [
        F.struct(
            F.lit(stage).alias("stage"),
            F.format_string(template, url_part(F.col(ids[stage]).cast("string"))).alias("url"),
            F.col(ids[stage]).isNotNull().alias("due"))
        for stage, template in stages.items()]
    if page_link:
        due = F.col(page_link).isNotNull()
        if stale:
            due = due & F.col(stale)
        wanted.append(F.struct(
            F.lit("profile").alias("stage"), F.col(page_link).alias("url"), due.alias("due")))
    exploded = universe.select(key, F.inline(F.array(*wanted)))
    return exploded.where("due").drop("due")


def index_requests(registry: DataFrame, base: str) -> DataFrame:
    return registry.select(
        "index_key", F.concat(F.lit(base), F.col("csv_filename")).alias("url"))
