import json

from equifacts.functions import sentences as s
from equifacts.sources import feeds, pages

INFO = {
    "success": 1,
    "data": {
        "address": {"address1": "7 Quay Road", "address2": "", "city": "Kochi",
                    "state": "Kerala", "pincode": 682009, "telephone1": "0484-998877",
                    "email": "desk@zelkova.example", "web": "https://zelkova.example"},
        "management": [{"name": "L Varghese", "designation": "CEO"}, {"name": "Nair &amp; Sen"},
                       "junk", {"name": "--", "designation": "CFO"}],
        "registrars": {"name": "Ledger Desk LLP"},
        "details": {"bseId": 531987, "nseId": "ZELKOVA", "isinid": "INE777Z01029"}}}
BLOB = json.dumps(INFO).replace("&", "&amp;").replace('"', "&quot;").replace("/", "\\/")
PAGE = f"""<html><body><div id="company_info"><h2>About</h2>
<div class="com_overviewcnt"><div class="text morepls_cnt">Zelkova Systems runs a
billing platform.<p>Its <b>customer</b>&nbsp;base is ports<br>and mills.</p>
<script>var x = "<div>";</script><!-- note --> The end</div> outside</div>
<div style="display: none;">{BLOB}</div></div>
<script>var summary_jsn = '{{"Promoter":60.5,"FII":10,"Text":"x","Flag":true,"Others":0.0}}';
</script></body></html>"""


def page_frame(spark, *htmls):
    return spark.createDataFrame(list(enumerate(htmls)), "id int, body string")


def test_page_fields(spark):
    row = pages.extract_pages(page_frame(spark, PAGE), ["id"]).first().asDict()
    assert row["business_summary"] == (
        "Zelkova Systems runs a billing platform. Its customer base is ports and mills. "
        "The end")
    assert row["address"] == "7 Quay Road, Kochi, Kerala, 682009"
    assert row["website"] == "https://zelkova.example"
    assert (row["email"], row["phone"]) == ("desk@zelkova.example", "0484-998877")
    assert row["registrar"] == "Ledger Desk LLP"
    assert row["management"] == "L Varghese (CEO); Nair & Sen (None)"
    assert (row["bse_symbol"], row["isin"]) == ("531987", "INE777Z01029")


def test_empty_and_broken_pages(spark):
    broken = '<div style="display:none">{&quot;success&quot;: oops}</div>'
    df = page_frame(spark, "<html><body></body></html>", broken, None)
    for row in pages.extract_pages(df, ["id"]).drop("id").collect():
        assert set(row.asDict().values()) == {None}
    assert pages.extract_holdings(df, ["id"]).count() == 0


def test_summary_container_rules(spark):
    box = '<div id="company_info">{}</div>'
    df = page_frame(
        spark,
        box.format('<div class="morepls_cnt">Data is not Available.</div>'),
        box.format('<div class="morepls_cnt"></div><div class="com_overviewcnt">Full</div>'),
        box.format('<div class="com_overviewcnt">Full <i>text</i></div>'),
        '<div class="morepls_cnt">not enclosed</div>',
        box.format('<div class="morepls_cnt">first<div>in</div></div>'
                   '<div class="morepls_cnt">second</div>'))
    got = [r.business_summary for r in pages.extract_pages(df, ["id"]).orderBy("id").collect()]
    assert got == [None, None, "Full text", None, "first in"]


def test_long_pages_are_read_whole(spark):
    box = '<div id="company_info"><div class="{}">Some &amp; more</div></div>'
    filler = "<p>x</p>" * 8190
    lead = "<p>x</p>" * 8180
    # Text of growing length moves the container across the border between two chunks.
    htmls = [lead + "y" * n + box.format("morepls_cnt") + filler for n in range(0, 91, 7)]
    htmls.append(box.format("com_overviewcnt") + filler + box.format("morepls_cnt").replace("Some", "Late"))
    htmls.append(filler * 3 + box.format("com_overviewcnt"))
    rows = pages.extract_pages(page_frame(spark, *htmls), ["id"]).orderBy("id").collect()
    got = [r.business_summary for r in rows]
    assert got == ["Some & more"] * 13 + ["Late & more", "Some & more"]


def test_holdings_in_feed_order(spark):
    rows = pages.extract_holdings(page_frame(spark, PAGE), ["id"]).orderBy("pos").collect()
    assert [(r.category, r.percent, r.pos) for r in rows] == [
        ("Promoter", 60.5, 0), ("FII", 10.0, 1), ("Flag", 1.0, 3), ("Others", 0.0, 4)]


def test_price_feed(spark):
    full = {"MKTCAP": 8123.75, "pricecurrent": "412.20", "PE": 21.06, "SC_TTM": "19.6",
            "52L": "377.40", "FV": True, "PB": {"x": 1}, "main_sector": "Software &amp; IT",
            "newSubsector": "", "SC_SUBSEC": "Consulting", "BSEID": 531987, "company": "Zelkova"}
    bodies = [json.dumps({"data": full}), '{"data": {}}', '{"data": []}', "[1]", "junk", None]
    df = spark.createDataFrame(list(enumerate(bodies)), "id int, body string")
    rows = feeds.price_rows(df, ["id"]).orderBy("id").collect()
    assert [r.feed_state for r in rows] == ["ok", "empty", "empty"] + ["invalid"] * 3
    first = rows[0]
    assert (first.capitalisation_cr, first.price, first.pe) == (8123.75, 412.2, 21.06)
    assert (first.eps_ttm, first.week52_low, first.face_value) == (19.6, 377.4, 1.0)
    assert (first.pb, first.dividend_yield) == (None, None)
    assert (first.feed_sector, first.feed_industry) == ("Software & IT", "Consulting")
    assert (first.feed_bse_symbol, first.feed_name, first.feed_isin) == ("531987", "Zelkova", None)


def test_result_rows(spark):
    data = [
        {"yrc0": "Mar '26", "Net Sales/Income from operations": "1,204.50",
         "Other Income": "88.00", "Total Income From Operations": "1,204.50",
         "Net Profit/(Loss) For the Period": "230.25", "Basic EPS": "6.35"},
        {"yrc0": "Dec '25", "Net Sales/Income from operations": "--"},
        {"no_label": True}, 7, None,
        {"yrc0": "Jun '25", "Interest": "1.00"},
        {"yrc0": "Sep '25", "Net Sales/Income from operations": "--",
         "Total Income From Operations": "9", "P/L After Tax from Ordinary Activities": "2"},
        {"yrc0": "Mar '25", "Basic EPS": 1},
        {"yrc0": "Dec '24", "Basic EPS": 1}]
    bodies = [json.dumps({"data": data}), '{"data": {}}', "[]", "x"]
    df = spark.createDataFrame(list(enumerate(bodies)), "id int, body string")
    rows = feeds.result_rows(df, ["id"]).orderBy("id", "pos").collect()
    assert [(r.period_label, r.pos) for r in rows] == [
        ("Mar '26", 0), ("Sep '25", 6), ("Mar '25", 7), ("Dec '24", 8)]
    assert (rows[0].revenue, rows[0].net_profit, rows[0].basic_eps) == (1204.5, 230.25, 6.35)
    assert (rows[1].revenue, rows[1].net_profit, rows[1].total_income) == (9.0, 2.0, 9.0)


def test_every_row_of_a_feed_is_kept(spark):
    data = ["junk"] * 9 + [{"yrc0": f"Mar '{n}", "Basic EPS": n} for n in range(10, 22)]
    df = spark.createDataFrame([(0, json.dumps({"data": data}))], "id int, body string")
    rows = feeds.result_rows(df, ["id"]).orderBy("pos").collect()
    assert [(r.pos, r.basic_eps) for r in rows] == [(n - 1, float(n)) for n in range(10, 22)]


def test_suggest_entries(spark):
    body = json.dumps([{"sc_id": "X1", "link_src": "u", "name": "A &amp; B"}, 3, {"sc_id": "--"}])
    df = spark.createDataFrame([("S", body), ("T", '{"a": 1}'), ("U", "x")], "symbol string, body string")
    rows = feeds.suggest_entries(df, ["symbol"]).orderBy("pos").collect()
    assert [(r.symbol, r.pos, r.sc_id, r.name, r.display) for r in rows] == [
        ("S", 0, "X1", "A & B", ""), ("S", 2, None, None, "")]


PROSE = ("Zelkova Systems began as a workshop. It now provides a tariff platform. Ports and "
         "mills form its customer base. An order backlog of 3 years remains. Staff number 240.")


def test_topics(spark):
    df = spark.createDataFrame([(0, PROSE), (1, None), (2, "Nothing to see.")], "i int, t string")
    rows = s.with_topics(df, "t").orderBy("i").collect()
    assert rows[0].products_services == (
        "It now provides a tariff platform.")
    assert rows[0].major_clients == "Ports and mills form its customer base."
    assert rows[0].order_book == "An order backlog of 3 years remains."
    for row in rows[1:]:
        assert (row.products_services, row.major_clients, row.order_book) == (None, None, None)


def test_sentence_edges(values):
    got = values(s.sentences, ["One..Two", "a. b", "Is it? Yes! 5 of them."])
    assert got == [["One.", "Two"], ["a. b"], ["Is it?", "Yes!", "5 of them."]]
    long = "client " + "x" * 5000
    assert values(lambda c: s.topic_sentences(s.sentences(c), "client"), [long]) == [long]
    assert values(lambda c: s.shorten(c, 12), ["short", "eight le tters"]) == ["short", "eight le..."]


def test_topic_words_are_whole_words(values):
    topic = lambda c: s.topic_sentences(s.sentences(c), s.CLIENT_WORDS)
    assert values(topic, ["Our clients are many.", "éclient", "FORTUNE 500 firms"]) == [
        None, None, "FORTUNE 500 firms"]


def test_unknown_kind_is_ignored(spark):
    df = spark.createDataFrame(
        [("A", "monthly", '{"data":[{"yrc0":"Mar 24","Basic EPS":1}]}'),
         ("A", "yearly", '{"data":[{"yrc0":"Mar 24","Basic EPS":1}]}')],
        "nse_symbol string, kind string, body string")
    rows = feeds.typed_results(feeds.feed_entries(df, ["nse_symbol", "kind"])).collect()
    assert [(r.period_type, r.basic_eps) for r in rows] == [("Y", 1.0)]
