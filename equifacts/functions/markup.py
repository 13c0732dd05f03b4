"""Text of an element in markup, by built-in functions: a tokeniser and a fold over its tags.

The markup is cut at its tags, comments and declarations; scripts and styles are one token with what
they hold. A fold over the tokens keeps the open elements and, for each rule, how much of its chain
they match. An end tag closes the newest open element of its name with all that is open inside, and
one that closes nothing is passed over, so wrong nesting harms no more than the elements it names.
"""

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from equifacts.functions.entities import unescape
from equifacts.functions.text import strip

# Elements that have no end, and elements whose text is not shown.
VOID = ["area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"]
SILENT = ["script", "style", "template"]

ATTRIBUTE = r"""[^\s/>"'=][^\s/=>]*(?:\s*=\s*(?:"[^"]*"|'[^']*'|[^>\s]*))?"""
# In runs, so that a long tag takes no deep recursion.
_REST = r"""(?:[^'">]++|"[^"]*+"|'[^']*+')*+"""
TOKEN = (
    r"(?is)<(?:!--.*?--\s*>"
    rf"|(?<silent>script|style)(?=[\s/>]){_REST}>.*?(?:</\k<silent>\s*>|\z)"
    rf"|[a-z][^\t\n\r\f />\x00]*{_REST}>"
    r"|/[^>]*>|!(?!--)[^>]*>)")
# What stands in a text without parting it.
UNSEEN = r"(?is)<(?:!doctype|\?)[^>]*>"


def _let(value: Column, body) -> Column:
    return F.transform(F.array(value), body)[0]


def _attribute(attributes: Column, name: str) -> Column:
    """The value of the last attribute of a name, decoded; "" without one."""
    own = F.filter(attributes, lambda a: a.rlike(rf"(?is)^{name}\s*(=|$)"))
    value = F.regexp_replace(F.try_element_at(own, F.lit(-1)), rf"(?is)^{name}\s*=?\s*", "")
    return F.coalesce(unescape(F.regexp_replace(value, r"""(?s)^(["'])(.*)\1$""", "$2")), F.lit(""))


def _tests(rules) -> list[tuple[str, str]]:
    return sorted({pair for rule in rules for pair in zip(rule[::2], rule[1::2])})


def _tags(marks: Column, tests) -> Column:
    """What each token is: its kind, its element's name, and whether it may meet a test."""
    named = F.transform(marks, lambda mark: F.struct(mark.alias("mark"), F.lower(F.regexp_extract(
        mark, r"^</?\s*([a-zA-Z][^\t\n\r\f />\x00]*)", 1)).alias("name")))

    def told(tag: Column) -> Column:
        mark, name = tag["mark"], tag["name"]
        # Only tokens are asked, so a name after the bracket tells a start, and one after the slash an end.
        kind = (
            F.when(name == "", "other").when(mark.startswith("</"), "end")
            .when(mark.rlike("(?i)^<(script|style)[\\s/>]") | name.isin(VOID), "other").otherwise("start"))
        # A tag that has no test's value, in no spelling, is not taken apart.
        likely = [name == value if what == "tag" else mark.contains(value) | mark.contains("&") for what, value in tests]
        return F.struct(mark.alias("mark"), name.alias("name"), kind.alias("kind"), reduce(or_, likely).alias("likely"))

    return F.transform(named, told)


def _met(tag: Column, tests) -> Column:
    """Which tests a start tag meets."""
    attributes = F.regexp_extract_all(
        F.regexp_replace(tag["mark"], r"^<[a-zA-Z][^\t\n\r\f />\x00]*", ""), F.lit(f"({ATTRIBUTE})"), 1)

    def met(what: str, value: str) -> Column:
        if what == "tag":
            return tag["name"] == value
        found = _attribute(attributes, what)
        return F.array_contains(F.split(found, r"\s+"), value) if what == "class" else found == value

    return F.array(*[met(*t) for t in tests])


def container_text(html: Column, rules) -> Column:
    """Text of the first rule's element that is present, its pieces joined by a space.

    A rule is a chain of (attribute, value) pairs, or ("tag", name), each nested in the one before.
    Markup that cannot hold such an element is not cut.
    """
    tests = _tests(rules)
    chains = [[tests.index(pair) for pair in zip(r[::2], r[1::2])] for r in rules]
    ids = range(len(chains))
    numbers = F.array().cast("array<int>")

    def after(acc: Column, opened: Column, silent: Column, found: list[Column], taking: list[Column]) -> Column:
        """The state after a token. The piece of text before it belongs to what is open before it."""
        return F.struct(
            opened.alias("open"), silent.alias("silent"),
            *[c.alias(f"found_{r}") for r, c in enumerate(found)],
            *[c.alias(f"taking_{r}") for r, c in enumerate(taking)],
            *[F.when((acc[f"taking_{r}"] >= 0) & (acc["silent"] == 0), F.concat(
                acc[f"text_{r}"], F.array(acc["at"]))).otherwise(acc[f"text_{r}"]).alias(f"text_{r}") for r in ids],
            (acc["at"] + 1).alias("at"))

    def kept(acc: Column, name: str) -> list[Column]:
        return [acc[f"{name}_{r}"] for r in ids]

    def top(acc: Column, field: str) -> Column:
        return F.try_element_at(acc["open"], F.lit(-1))[field]

    def done(acc: Column) -> list[Column]:
        """How far the newest element carries on each chain."""
        return [F.coalesce(top(acc, f"done_{r}"), F.lit(0)) for r in ids]

    def opened(acc: Column, tag: Column) -> Column:
        """The state after an element opens: pushed, with how far it carries on each chain."""
        silent = acc["silent"] + tag["name"].isin(SILENT).cast("int")

        def pushed(element: Column) -> Column:
            return F.concat(acc["open"], F.array(element))

        def element(carried: list[Column]) -> Column:
            return F.struct(tag["name"].alias("name"), *[c.alias(f"done_{r}") for r, c in enumerate(carried)])

        def carried(met: Column) -> Column:
            def further(before: Column, chain: list[int]) -> Column:
                step = F.lit(False)
                for n, test in enumerate(chain):
                    step = step | (met[test] & (before == n))
                return before + step.cast("int")

            return element([further(b, c) for b, c in zip(done(acc), chains)])

        def marked(new: Column) -> Column:
            # Below the first element that ends a chain, the chain is found already.
            first = [(new[f"done_{r}"] == len(chains[r])) & ~acc[f"found_{r}"] for r in ids]
            return after(
                acc, pushed(new), silent, [acc[f"found_{r}"] | first[r] for r in ids],
                [F.when(first[r], F.size(acc["open"])).otherwise(acc[f"taking_{r}"]) for r in ids])

        # What is bound to a name is copied, so a state is bound only for the few tags that may meet a test.
        return F.when(tag["likely"], _let(_let(_met(tag, tests), carried), marked)).otherwise(
            after(acc, pushed(element(done(acc))), silent, kept(acc, "found"), kept(acc, "taking")))

    def closed(acc: Column, tag: Column) -> Column:
        """The state after an end tag: all from the newest element of its name on is closed."""
        depth = F.size(acc["open"])
        place = F.array_position(F.reverse(acc["open"]["name"]), tag["name"]).cast("int")

        def cut(left: Column) -> Column:
            rest = F.slice(acc["open"], F.lit(1), left)
            silent = F.when(acc["silent"] == 0, 0).otherwise(F.size(F.filter(rest, lambda e: e["name"].isin(SILENT))))
            return after(acc, rest, silent, kept(acc, "found"), [
                F.when(acc[f"taking_{r}"] >= left, -1).otherwise(acc[f"taking_{r}"]) for r in ids])

        return F.when(top(acc, "name") == tag["name"], cut(depth - 1)).otherwise(
            _let(place, lambda at: F.when(at == 0, cut(depth)).otherwise(cut(depth - at))))

    elements = "array<struct<name:string," + ",".join(f"done_{r}:int" for r in ids) + ">>"
    begin = F.struct(
        F.array().cast(elements).alias("open"), F.lit(0).alias("silent"),
        *[F.lit(False).alias(f"found_{r}") for r in ids], *[F.lit(-1).alias(f"taking_{r}") for r in ids],
        *[numbers.alias(f"text_{r}") for r in ids], F.lit(0).alias("at"))

    def step(acc: Column, tag: Column) -> Column:
        # Once the first rule's element is closed, the rest cannot change the answer.
        return F.when(acc["found_0"] & (acc["taking_0"] < 0), acc).when(
            tag["kind"] == "start", opened(acc, tag)).when(tag["kind"] == "end", closed(acc, tag)).otherwise(
            after(acc, acc["open"], acc["silent"], kept(acc, "found"), kept(acc, "taking")))

    def walked(seen: Column) -> Column:
        def texts(end: Column) -> Column:
            def joined(r: int) -> Column:
                pieces = _let(F.split(seen, TOKEN), lambda between: F.transform(
                    end[f"text_{r}"], lambda at: strip(unescape(F.get(between, at)))))
                return F.array_join(F.filter(pieces, lambda p: p != ""), " ")

            return F.coalesce(*[F.when(end[f"found_{r}"], joined(r)) for r in ids])

        # After the last token comes the last piece of text.
        marks = F.concat(F.regexp_extract_all(seen, F.lit(f"({TOKEN})"), 1), F.array(F.lit("")))
        return _let(F.aggregate(_tags(marks, tests), begin, step), texts)

    possible = F.lit(False)
    for marker in {rule[1] for rule in rules}:
        possible = possible | F.contains(F.lower(html), F.lit(marker.lower()))
    unseen = html.contains("<!") | html.contains("<?")
    return F.when(possible, _let(F.when(unseen, F.regexp_replace(html, UNSEEN, "")).otherwise(html), walked))
