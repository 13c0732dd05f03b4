"""Column functions on generated texts whose result is known by construction."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from equifacts.functions import sentences as s
from equifacts.functions import text as t

GAPS = st.lists(
    st.sampled_from([" ", "\t", "\n", "\x1c", "\x85", "&nbsp;", "&#32;"]), min_size=1, max_size=3).map("".join)
MAYBE = st.one_of(st.just(""), GAPS)
WORDS = st.sampled_from([("plain", "plain"), ("M&amp;A", "M&A"), ("&#8377;9", "₹9"), ("é!", "é!"), ("&lt;b", "<b")])
batch = settings(
    max_examples=4, deadline=None, suppress_health_check=list(HealthCheck), derandomize=True)


def many(case):
    return st.lists(case, min_size=40, max_size=80)


@st.composite
def spaced(draw):
    """Words with white space between and round them, and the same words with single spaces."""
    words = draw(st.lists(WORDS, min_size=1, max_size=5))
    text = draw(MAYBE) + words[0][0]
    for word, _ in words[1:]:
        text += draw(GAPS) + word
    return text + draw(MAYBE), " ".join(plain for _, plain in words)


@st.composite
def amounts(draw):
    """A number in a page's spelling, and the number."""
    whole, cents = draw(st.integers(0, 10**7)), draw(st.integers(0, 99))
    sign = draw(st.sampled_from(["", "-", "+"]))
    before = draw(st.sampled_from(["", "Rs. ", "rs", "₹", "&#8377; "]))
    after = draw(st.sampled_from(["", "%", " Cr", " CR.", "&nbsp;"]))
    value = (whole + cents / 100) * (-1 if sign == "-" else 1)
    return f"{before}{sign}{whole:,}.{cents:02d}{after}", value


@st.composite
def prose(draw):
    """Sentences with white space between, and the sentences."""
    one = st.tuples(
        st.sampled_from(["Alpha", "9", "Zed"]), st.sampled_from(["", " b. c", ", a"]),
        st.sampled_from([".", "!", "?"])).map("".join)
    parts = draw(st.lists(one, min_size=1, max_size=4))
    return "".join(p + draw(st.sampled_from([" ", "  ", "\n\t"])) for p in parts[:-1]) + parts[-1], parts


@st.composite
def periods(draw):
    """A month label in one of its spellings, and its year and month."""
    year, month = draw(st.integers(2000, 2099)), draw(st.integers(1, 12))
    name = t.MONTHS[month - 1]
    name = draw(st.sampled_from([name, name.upper(), name.title(), name.title() + "x"]))
    shown = draw(st.sampled_from([f"{year}", f"{year % 100:02d}", f"'{year % 100:02d}"]))
    return f" {name} {shown}", (year, month)


@batch
@given(many(spaced()))
def test_clean_text(values, cases):
    assert values(t.clean_text, [c[0] for c in cases]) == [c[1] for c in cases]


@batch
@given(st.lists(st.tuples(MAYBE, st.sampled_from(["", "-", "--", "N.A.", "NA", "null", "None"]), MAYBE).map("".join),
                min_size=40, max_size=80))
def test_placeholders_are_null(values, samples):
    assert set(values(t.clean_text, samples)) == {None}
    assert set(values(t.parse_number, samples)) == {None}


@batch
@given(many(amounts()))
def test_parse_number(values, cases):
    got = values(t.parse_number, [c[0] for c in cases])
    assert [round(x, 2) for x in got] == [round(c[1], 2) for c in cases]


@batch
@given(many(prose()))
def test_sentences(values, cases):
    assert values(s.sentences, [c[0] for c in cases]) == [c[1] for c in cases]


@batch
@given(many(periods()))
def test_period_parts(values, cases):
    texts = [c[0] for c in cases]
    assert list(zip(values(t.period_year, texts), values(t.period_month, texts))) == [c[1] for c in cases]
