"""Topic sentences of a prose column."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from equifacts.functions.text import SPACE, rstrip, strip

# Words that mark a sentence of each topic.
PRODUCT_WORDS = (
    r"product|service|solution|platform|portfolio|offering|offers?|provides?|"
    r"develops?|specialis|specializ|segment")
CLIENT_WORDS = r"client|customer|serves?|caters?|Fortune\s*500"
ORDER_BOOK_WORDS = (
    r"order\s*book|order\s*backlog|deal\s*wins?|total\s*contract\s*value|TCV|"
    r"pipeline\s+of\s+orders")
TOPICS = {
    "products_services": PRODUCT_WORDS,
    "major_clients": CLIENT_WORDS,
    "order_book": ORDER_BOOK_WORDS,
}


def sentences(text: Column) -> Column:
    """Split after an end mark that is followed by space and a capital or digit."""
    spaced = F.regexp_replace(text, r"\.{2,}", ". ")
    return F.split(spaced, rf"(?<=[.!?]){SPACE}+(?=[A-Z0-9])")


def shorten(text: Column, length: int) -> Column:
    """The text, cut to a length that the caller of a report asks for."""
    cut = F.concat(rstrip(F.left(text, F.lit(length - 3))), F.lit("..."))
    return F.when(F.length(text) > length, cut).otherwise(text)


def topic_sentences(parts: Column, words: str) -> Column:
    """Sentences holding one of ``words`` as a whole word, joined; NULL when none does."""
    hits = F.filter(parts, lambda s: s.rlike(rf"(?iuU)\b({words})\b"))
    # A sentence that holds a word is not empty, so an empty text means no sentence.
    return F.nullif(F.array_join(F.transform(hits, strip), " "), F.lit(""))


def with_topics(df: DataFrame, text: str, topics: dict[str, str] = TOPICS) -> DataFrame:
    """Add one facet column per topic, with the whole text of its sentences.

    The split is a column of its own, so that it is computed once per row.
    """
    split = df.withColumn("_parts", sentences(F.col(text)))
    return split.withColumns({
        n: topic_sentences(F.col("_parts"), w) for n, w in topics.items()}).drop("_parts")
