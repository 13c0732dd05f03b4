"""Fields and holdings out of landed company pages."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from equifacts.functions import payload
from equifacts.functions.markup import container_text
from equifacts.functions.text import (
    clean_text,
    normalise,
    unescape,
    unescape_columns,
    unescape_each,
)

# Where the summary stands (enclosing id, class), first present wins.
SUMMARY_RULES = [("id", "company_info", "class", "morepls_cnt"),
                 ("id", "company_info", "class", "com_overviewcnt")]
# Summaries that mean "no summary".
NO_SUMMARY = ["data is not available", "data not available"]
# The hidden JSON block and the script variable with the holdings.
HIDDEN_BLOCK = (
    r'(?s)<div[^>]*style="display:\s*none;?"[^>]*>\s*(\{&quot;success&quot;.*?\})\s*</div>')
HOLDINGS_VARIABLE = r"(?s)var\s+summary_jsn\s*=\s*'(\{.*?\})'"
# Keys of the address parts, in print order.
ADDRESS_PARTS = ["address1", "address2", "city", "state", "pincode"]

NUMERIC_KINDS = "^(TINYINT|SMALLINT|INT|BIGINT|DECIMAL|FLOAT|DOUBLE|BOOLEAN)"


def extract_container(pages: DataFrame, html: str, rules, name: str) -> DataFrame:
    return pages.withColumn("_text", container_text(F.col(html), rules)).withColumn(
        name, clean_text(F.col("_text"))).drop("_text")


def flat_text(html: Column, tag: str) -> Column:
    """Text of the first ``tag`` element, for tags that do not hold their own kind."""
    inner = F.nullif(F.regexp_extract(html, rf"(?is)<{tag}\b[^>]*>(.*?)</{tag}\s*>", 1), F.lit(""))
    # Decoded twice: as markup, then as scraped text.
    return clean_text(unescape(F.regexp_replace(inner, "<[^>]*>", " ")))


def _matched(html: Column, pattern: str) -> Column:
    """First group of the first match, NULL without a match."""
    return F.nullif(F.regexp_extract(html, pattern, 1), F.lit(""))


def hidden_block(html: Column) -> Column:
    raw = _matched(html, HIDDEN_BLOCK)
    # Entities of the block.
    for entity, char in (("&quot;", '"'), ("&amp;", "&"), ("&#039;", "'")):
        raw = F.replace(raw, F.lit(entity), F.lit(char))
    return raw


def extract_pages(pages: DataFrame, keys: list[str], html: str = "body",
                  rules=SUMMARY_RULES) -> DataFrame:
    """Profile fields of each page; an absent or broken block leaves its fields NULL."""
    base = pages.select(
        *keys, F.col(html).alias("_html"),
        payload.child(payload.parse(hidden_block(F.col(html))), "$.data").alias("_info"))
    info = F.col("_info")
    raw = base.select(
        *keys,
        container_text(F.col("_html"), rules).alias("_summary"),
        *[payload.raw_text(info, f"$.address.{k}").alias(f"_{k}")
          for k in [*ADDRESS_PARTS, "web", "email", "telephone1"]],
        payload.raw_text(info, "$.registrars.name").alias("_registrar"),
        payload.raw_text(info, "$.details.bseId").alias("_bse"),
        payload.raw_text(info, "$.details.isinid").alias("_isin"),
        _people(info, "name").alias("_names"),
        _people(info, "designation").alias("_posts"))
    texts = ["_summary", *[f"_{k}" for k in ADDRESS_PARTS], "_web", "_email", "_telephone1",
             "_registrar", "_bse", "_isin"]
    decoded = unescape_columns(raw, texts)
    cleaned = decoded.select(
        *keys, *[normalise(F.col(t)).alias(t) for t in texts],
        F.transform(unescape_each(F.col("_names")), normalise).alias("_names"),
        F.transform(unescape_each(F.col("_posts")), normalise).alias("_posts"))
    people = F.zip_with(
        "_names", "_posts",
        lambda n, d: F.when(n.isNotNull(), F.concat(
            n, F.lit(" ("), F.coalesce(d, F.lit("None")), F.lit(")"))))
    plain = F.lower(F.regexp_replace(F.col("_summary"), r"^[. ]+|[. ]+$", ""))
    return cleaned.select(
        *keys,
        F.when(~plain.isin(NO_SUMMARY), F.col("_summary")).alias("business_summary"),
        F.col("_web").alias("website"), F.col("_email").alias("email"),
        F.nullif(F.concat_ws(", ", *[f"_{k}" for k in ADDRESS_PARTS]), F.lit("")).alias("address"),
        F.col("_telephone1").alias("phone"), F.col("_registrar").alias("registrar"),
        F.nullif(F.array_join(people, "; "), F.lit("")).alias("management"),
        F.col("_bse").alias("bse_symbol"), F.col("_isin").alias("isin"))


def _people(info: Column, key: str) -> Column:
    return F.transform(
        payload.items(info, "$.management"), lambda m: payload.raw_text(m, f"$.{key}"))


def holdings_json(html: Column, pattern: str = HOLDINGS_VARIABLE) -> Column:
    return _matched(html, pattern)


def holding_rows(df: DataFrame, keys: list[str], json: str) -> DataFrame:
    """(category, percent) rows of each JSON map in feed order; only numbers count."""
    parsed = df.where(F.col(json).isNotNull()).select(
        *keys, F.json_object_keys(json).alias("_order"),
        F.explode(F.try_variant_get(
            payload.parse(F.col(json)), "$", "map<string,variant>")).alias("category", "_v"))
    numeric = payload.kind(F.col("_v")).rlike(NUMERIC_KINDS)
    return parsed.where(numeric).select(
        *keys, "category",
        F.try_variant_get("_v", "$", "double").alias("percent"),
        (F.array_position("_order", F.col("category")) - 1).alias("pos"))


def extract_holdings(pages: DataFrame, keys: list[str], html: str = "body",
                     pattern: str = HOLDINGS_VARIABLE) -> DataFrame:
    found = pages.select(*keys, holdings_json(F.col(html), pattern).alias("_json"))
    return holding_rows(found, keys, "_json")
