"""Extraction from pages and prose."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from equifacts.bindings.catalog import Data, query
from equifacts.functions.sentences import with_topics
from equifacts.plans.reports import facet_report
from equifacts.session import spread, stage
from equifacts.sources.pages import extract_container, extract_holdings, extract_pages, flat_text

SPACES = r"[\s\x0b\x1c-\x1f\x{0085}\x{00a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
# Some entities lack their semicolon.
PLAIN_SQL = r"""nullif(trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
  regexp_replace(regexp_replace({inner}, '<[^>]*>', ' ', 'g'),
  '&quot;?', '"', 'g'), '&copy;?', '©', 'g'), '&middot;?', '·', 'g'), '&amp;?', '&', 'g'),
  '\s+', ' ', 'g')), '')"""


@query(rf"""
SELECT page_id,
  {PLAIN_SQL.format(inner="regexp_extract(html, '(?s)<article>(.*?)</article>', 1)")} AS article,
  {PLAIN_SQL.format(inner="regexp_extract(html, '(?s)<title>(.*?)</title>', 1)")} AS title,
  TRY_CAST(regexp_extract(html, 'track\((\d+)\)', 1) AS BIGINT) AS tracker
FROM pages""")
def page_fields(d: Data) -> DataFrame:
    """The article by the container walk, the title and a script value by pattern."""
    walked = extract_container(d.pages, "html", [("tag", "article")], "article")
    return walked.select(
        "page_id", "article", flat_text(F.col("html"), "title").alias("title"),
        F.regexp_extract("html", r"track\((\d+)\)", 1).try_cast("long").alias("tracker"))


def company_pages(d: Data, customers: DataFrame | None = None) -> DataFrame:
    """A profile page per customer; some lack the container, the text or a sound block.

    Of the given ``customers``, or of all.
    """
    nation = F.col("c_nationkey")
    info = F.struct(F.lit(1).alias("success"), F.struct(
        F.struct(
            F.col("c_name").alias("address1"), F.lit("--").alias("address2"),
            F.concat("c_mktsegment", F.lit(" & Co/Row")).alias("city"),
            F.when(nation != 4, F.lit("State")).alias("state"),
            F.col("c_custkey").alias("pincode"),
            F.concat(F.lit("https://x/"), "c_custkey").alias("web"),
            F.when(nation > 6, F.concat(F.lit("q"), "c_custkey", F.lit("@x.example"))).otherwise("")
            .alias("email"), F.lit("020-1").alias("telephone1")).alias("address"),
        F.array(
            F.struct(F.col("c_name").alias("name"), F.lit("CEO").alias("designation")),
            F.struct(F.lit("O'Neil").alias("name"), F.when(nation > 9, "CFO").alias("designation")),
            F.struct(F.lit("--").alias("name"), F.lit("x").alias("designation"))).alias("management"),
        F.struct(F.col("c_mktsegment").alias("name")).alias("registrars"),
        F.struct(F.col("c_custkey").alias("bseId"),
                 F.concat(F.lit("IN"), "c_custkey").alias("isinid")).alias("details")).alias("data"))
    block = F.to_json(info)
    for char, entity in (("&", "&amp;"), ('"', "&quot;"), ("'", "&#039;")):
        block = F.replace(block, F.lit(char), F.lit(entity))
    block = F.when(nation == 2, F.concat(F.lit("{&quot;success&quot;:1,"), F.lit("oops}"))).otherwise(block)
    text = F.when(nation == 0, F.lit(" Data is not available. ")).otherwise(F.concat(
        F.lit("<p>"), "c_name", F.lit(" <b>serves"), F.lit("</b>\n<!-- x -->&amp;amp; "),
        "c_mktsegment", F.lit("<div><script>var a='<p>no</p>';</script>.</div></p>")))
    summary = F.when(nation == 1, F.lit("")).when(
        nation == 5, F.concat(F.lit('<div class="com_overviewcnt">'), text, F.lit("</div>"))
    ).otherwise(F.concat(
        F.lit('<div class="com_overviewcnt">more <div class="a morepls_cnt">'), text,
        F.lit("</div> after</div>")))
    holdings = F.concat(
        F.lit('{"Promoter":'), "c_acctbal", F.lit(',"Note":"x","FII":'), nation.cast("string"),
        F.lit(',"Asset":true,"Public":null}'))
    html = F.concat(
        F.lit('<html><body><div id="company_info">'), summary,
        F.lit('<div class="b" style="display: none;">\n'), block, F.lit("</div></div><script>\nvar summary_jsn = '"),
        holdings, F.lit("';</script></body></html>"))
    # A page is long and much is done with it, a customer's row is short.
    rows = spread((d.customer if customers is None else customers).select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"))
    return rows.select("c_custkey", html.alias("body"))


@query("""
SELECT c_custkey,
  CASE WHEN c_nationkey NOT IN (0, 1) THEN c_name || ' serves & ' || c_mktsegment || ' .'
  END AS business_summary,
  CASE WHEN c_nationkey <> 2 THEN 'https://x/' || c_custkey END AS website,
  CASE WHEN c_nationkey <> 2 THEN c_name || ', ' || c_mktsegment || ' & Co/Row, '
    || CASE WHEN c_nationkey <> 4 THEN 'State, ' ELSE '' END || c_custkey END AS address,
  CASE WHEN c_nationkey > 6 THEN 'q' || c_custkey || '@x.example' END AS email,
  CASE WHEN c_nationkey <> 2 THEN '020-1' END AS phone,
  CASE WHEN c_nationkey <> 2 THEN c_mktsegment END AS registrar,
  CASE WHEN c_nationkey <> 2 THEN c_name || ' (CEO); O''Neil ('
    || CASE WHEN c_nationkey > 9 THEN 'CFO' ELSE 'None' END || ')' END AS management,
  CASE WHEN c_nationkey <> 2 THEN CAST(c_custkey AS VARCHAR) END AS bse_symbol,
  CASE WHEN c_nationkey <> 2 THEN 'IN' || c_custkey END AS isin
FROM customer""")
def page_profile(d: Data) -> DataFrame:
    return extract_pages(company_pages(d), ["c_custkey"])


@query("""
SELECT c_custkey, 'Promoter' AS category, c_acctbal AS percent, 0 AS pos FROM customer
UNION ALL SELECT c_custkey, 'FII', CAST(c_nationkey AS DOUBLE), 2 FROM customer
UNION ALL SELECT c_custkey, 'Asset', 1.0, 3 FROM customer""")
def page_holdings(d: Data) -> DataFrame:
    rows = extract_holdings(company_pages(d), ["c_custkey"])
    return rows.withColumn("pos", F.col("pos").cast("int"))


TOPICS = {
    "frequent": r"the|und|les|que",
    "rare": r"with|nicht|dans|entre\s+la",
    "absent": r"order\s*book|qqq+",
}


def _topic_sql(words: str) -> str:
    hits = (
        rf"list_filter(parts, lambda s: regexp_matches(s, "
        rf"'(?i)(^|[^\p{{L}}\p{{N}}\p{{M}}_])({words})($|[^\p{{L}}\p{{N}}\p{{M}}_])'))")
    joined = (
        rf"array_to_string(list_transform({hits}, lambda s: "
        rf"regexp_replace(s, '^{SPACES}+|{SPACES}+$', '', 'g')), ' ')")
    return f"CASE WHEN len({hits}) > 0 THEN {joined} END"


PARTS_SQL = rf"""
split AS (
  SELECT doc_id, string_split(regexp_replace(regexp_replace(text, '\.{{2,}}', '. ', 'g'),
    '([.!?]){SPACES}+([A-Z0-9])', '\1' || chr(1) || '\2', 'g'), chr(1)) AS parts
  FROM documents)"""


@query(rf"""
WITH {PARTS_SQL}
SELECT doc_id, {_topic_sql(TOPICS["frequent"])} AS frequent,
  {_topic_sql(TOPICS["rare"])} AS rare, {_topic_sql(TOPICS["absent"])} AS absent
FROM split""")
def facets(d: Data) -> DataFrame:
    return with_topics(d.documents.select("doc_id", "text"), "text", TOPICS).drop("text")


@query(rf"""
WITH {PARTS_SQL}, topics AS (
  SELECT doc_id, {_topic_sql(TOPICS["rare"])} AS rare, {_topic_sql(TOPICS["absent"])} AS absent
  FROM split)
SELECT source AS "Company Name", CAST(doc_id AS VARCHAR) AS "NSE Symbol", rare AS "Facet"
FROM topics JOIN documents USING (doc_id) WHERE rare IS NOT NULL
UNION ALL
SELECT 'No facet information found in company profiles', NULL, NULL
WHERE NOT EXISTS (SELECT 1 FROM topics WHERE absent IS NOT NULL)""")
def facet_reports(d: Data) -> DataFrame:
    """A report with rows, and one that is empty and gets its placeholder."""
    named = d.documents.select(
        F.col("source").alias("company_name"), F.col("doc_id").cast("string").alias("nse_symbol"),
        "text")
    # Reports read stored facets, so the texts are searched once.
    found = with_topics(named, "text", {k: TOPICS[k] for k in ("rare", "absent")}).drop("text")
    view = stage(found, "facets")
    return facet_report(view, "rare", "Facet").unionByName(facet_report(view, "absent", "Facet"))
