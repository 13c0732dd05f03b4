"""Typed rows out of the landed JSON feeds."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from equifacts.functions import payload
from equifacts.functions.text import normalise, to_number, unescape_columns
from equifacts.schemas import PERIOD_FIELDS

# Price-feed keys of the price columns.
PRICE_KEYS = {
    "capitalisation_cr": "MKTCAP", "price": "pricecurrent", "pe": "PE", "pb": "PB",
    "industry_pe": "IND_PE", "dividend_yield": "DY", "book_value": "BV", "eps_ttm": "SC_TTM",
    "face_value": "FV", "week52_high": "52H", "week52_low": "52L", "shares_outstanding": "SHRS",
}
# Price-feed keys of the attributes, first filled one wins.
ATTRIBUTE_KEYS = {
    "feed_sector": ["main_sector"],
    "feed_industry": ["newSubsector", "SC_SUBSEC"],
    "feed_name": ["SC_FULLNM", "company"],
    "feed_bse_symbol": ["BSEID"],
    "feed_isin": ["isinid"],
}
# Results-feed keys of the measures, first parseable one wins.
LABEL_KEY = "yrc0"
MEASURE_KEYS = {
    "revenue": ["Net Sales/Income from operations", "Total Income From Operations"],
    "other_income": ["Other Income"],
    "total_income": ["Total Income From Operations", "Total Income"],
    "expenditure": ["Total Expenditure"],
    "interest": ["Interest"],
    "tax": ["Tax"],
    "net_profit": [
        "Net Profit/(Loss) For the Period", "P/L After Tax from Ordinary Activities"],
    "basic_eps": ["Basic EPS"],
}
# Measures of which a period row needs at least one.
DECISIVE = ["revenue", "net_profit", "total_income", "basic_eps"]
# Kinds of results feed and their period type; rows asked for in a request.
RESULT_KINDS = {"quarterly": "Q", "yearly": "Y"}
REQUESTED_ROWS = 8


def _texts(df: DataFrame, v: str, keys: list[str], carry: list) -> DataFrame:
    """The scalars of an object under its keys as decoded texts, beside ``carry``.

    Looking up and checking are two projections, so that each key is looked up once.
    """
    names = [f"_{i}" for i in range(len(keys))]
    paths = dict(zip(names, map(payload.key_path, keys)))
    found = df.select(*carry, v, *[
        F.try_variant_get(v, p, "string").alias(n) for n, p in paths.items()])
    scalars = found.withColumns({
        n: payload.scalar_only(F.col(n), F.col(v), p) for n, p in paths.items()})
    return unescape_columns(scalars.drop(v), names)


def _first(keys: list[str], wanted: list[str], make) -> Column:
    """First filled result of ``make`` over the texts of the wanted keys."""
    return F.coalesce(*[make(F.col(f"_{keys.index(k)}")) for k in wanted])


def suggest_entries(landed: DataFrame, keys: list[str], body: str = "body") -> DataFrame:
    """One row per object in a suggest array, with its feed position.

    A body that is no array yields nothing; elements that are no objects are skipped.
    """
    entries = landed.select(
        *keys, F.posexplode(payload.items(payload.parse(F.col(body)))).alias("pos", "_entry")
    ).where(payload.is_object(F.col("_entry")))
    entry = F.col("_entry")
    # The display text is matched as it came, the others are cleaned.
    display = F.coalesce(payload.raw_text(entry, "$.pdt_dis_nm"), F.lit("")).alias("display")
    names = {"sc_id": "sc_id", "link": "link_src", "name": "name", "sector": "sc_sector"}
    texts = _texts(entries, "_entry", list(names.values()), [*keys, "pos", display])
    return texts.select(
        *keys, "pos",
        *[normalise(F.col(f"_{i}")).alias(n) for i, n in enumerate(names)], "display")


def price_rows(landed: DataFrame, keys: list[str], body: str = "body") -> DataFrame:
    """Price columns and attributes of each price feed.

    ``feed_state`` tells a filled ``data`` object ("ok") from an empty or absent one
    ("empty") and from a body that is no JSON object ("invalid").
    """
    parsed = landed.withColumn("_feed", payload.parse(F.col(body)))
    data = parsed.withColumn("_data", payload.child(F.col("_feed"), "$.data"))
    state = (
        F.when(~payload.is_object(F.col("_feed")), "invalid")
        .when(~payload.is_object(F.col("_data")), "empty")
        .when(payload.kind(F.col("_data")) == "OBJECT<>", "empty")
        .otherwise("ok"))
    truths = {k: payload.truth(F.col("_data"), payload.key_path(k)).alias(f"_truth_{n}")
              for n, k in PRICE_KEYS.items()}
    names = [*PRICE_KEYS.values(), *(k for ks in ATTRIBUTE_KEYS.values() for k in ks)]
    texts = _texts(
        data, "_data", names, [*keys, state.alias("feed_state"), *truths.values()])
    return texts.select(
        *keys, "feed_state",
        *[F.coalesce(F.col(f"_truth_{n}"), _first(names, [k], to_number)).alias(n)
          for n, k in PRICE_KEYS.items()],
        *[_first(names, ks, normalise).alias(n) for n, ks in ATTRIBUTE_KEYS.items()])


def feed_entries(landed: DataFrame, keys: list[str], body: str = "body",
                 label_key: str = LABEL_KEY,
                 measures: dict[str, list[str]] = MEASURE_KEYS) -> DataFrame:
    """Every entry of each results feed with its place; a feed without entries keeps one row
    without a place. ``readable`` tells whether the body is a JSON object."""
    feed = F.col("_feed")
    entries = landed.withColumn("_feed", payload.parse(F.col(body))).select(
        *keys, payload.is_object(feed).alias("readable"),
        F.posexplode_outer(payload.items(feed, "$.data")).alias("pos", "_entry"))
    names = list(dict.fromkeys([label_key, *(k for ks in measures.values() for k in ks)]))
    texts = _texts(entries, "_entry", names, [*keys, "readable", "pos"])
    return texts.select(
        *keys, "readable", "pos", _first(names, [label_key], normalise).alias("period_label"),
        *[_first(names, ks, to_number).alias(n) for n, ks in measures.items()])


def result_rows(landed: DataFrame, keys: list[str], body: str = "body",
                label_key: str = LABEL_KEY,
                measures: dict[str, list[str]] = MEASURE_KEYS) -> DataFrame:
    """Period rows of each results feed: all entries that carry a label and a decisive
    measure, with their place in the feed."""
    entries = feed_entries(landed, keys, body, label_key, measures).drop("readable")
    return keep_filled(entries, [m for m in DECISIVE if m in measures])


def keep_filled(rows: DataFrame, decisive: list[str] = DECISIVE) -> DataFrame:
    """Drop rows without a label or without any decisive measure."""
    filled = F.coalesce(*[F.col(m).cast("string") for m in decisive]).isNotNull()
    return rows.where(F.col("period_label").isNotNull() & filled)


def typed_results(entries: DataFrame) -> DataFrame:
    """Entries of the results feeds as period rows; unknown kinds yield nothing."""
    pairs = [F.lit(x) for kv in RESULT_KINDS.items() for x in kv]
    known = keep_filled(entries.where(F.col("kind").isin(list(RESULT_KINDS))))
    return known.select(
        "nse_symbol",
        F.create_map(*pairs)[F.col("kind")].alias("period_type"),
        "period_label", *PERIOD_FIELDS, "pos")
