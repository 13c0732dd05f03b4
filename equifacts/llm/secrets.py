"""Secret scans: candidates by pattern, false positives removed by a random forest.

Built-in functions and Spark's own forest only. A candidate is a run of at least sixteen
token characters with a digit. Its features are length, character shares and transitions,
how much of it the corpus's frequent words cover, whether it looks like a path, and the words
beside it. The forest learns from labelled findings; without any given, findings that a
secret's name is assigned to count as secrets and findings in plain numbers, paths or beside
placeholder words as none, and the rest teaches nothing.

Defined cases: a null text counts as empty; a text without candidates has no rows; repeated
rows are each scanned; a null id stays null; without findings of both kinds the rule for
labels decides alone; an empty table gives an empty result; further columns take no part.
"""

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from equifacts.llm.common import text_of, words_of
from equifacts.llm.pii import placed
from equifacts.session import stage

CANDIDATE = r"(?<![A-Za-z0-9_+/=-])(?=[A-Za-z0-9_+/=-]*[0-9])[A-Za-z0-9_+/=-]{16,}+"
NAMED = r"(?i)(?:token|secret|passw(?:or)?d|pwd|api[_-]?key|access[_-]?key|auth|credential|bearer|private[_-]?key)[\"']?\s*[:=]?\s*[\"']?$"
PLACEHOLDER = r"(?i)example|sample|dummy|test|placeholder|xxxx|changeme|commit|sha-?1|sha-?256|md5|uuid"
DICTIONARY_WORDS = 200
SAMPLE_FINDINGS = 20_000
TREES, DEPTH, SEED = 20, 6, 7
FEATURES = ["length", "digits", "capitals", "distinct", "changes", "vowels", "hexadecimal",
            "covered", "path", "named", "assigned", "placeholder"]


def candidates(docs: DataFrame) -> DataFrame:
    """``(doc_id, start, end, value, before, after)`` of each candidate, with 40 characters
    to either side."""
    text = F.col("text")
    found = docs.select("doc_id", text_of().alias("text")).where(text.rlike(CANDIDATE))
    hits = found.select("doc_id", "text", F.explode(placed(text, CANDIDATE)).alias("hit"))
    first = F.greatest(F.col("hit.start") - 40, F.lit(0))
    return hits.select(
        "doc_id", "hit.start", "hit.end", "hit.value",
        F.substring(text, first + 1, F.col("hit.start") - first).alias("before"),
        F.substring(text, F.col("hit.end") + 1, F.lit(40)).alias("after"))


def dictionary(docs: DataFrame, words: int = DICTIONARY_WORDS) -> list[str]:
    """The corpus's most frequent words of four letters or more."""
    word = F.explode(F.array_distinct(words_of(F.lower(text_of())))).alias("word")
    return [r["word"] for r in docs.select(word).where(F.col("word").rlike("^[a-z]{4,20}$"))
            .groupBy("word").count().orderBy(F.desc("count"), "word").limit(words).collect()]


def _share(value: Column, pattern: str) -> Column:
    """Share of the value's characters that the pattern's matches hold."""
    return 1.0 - F.length(F.regexp_replace(value, pattern, "")) / F.length(value)


def with_features(found: DataFrame, words: list[str]) -> DataFrame:
    value, before = F.col("value"), F.col("before")
    change = r"(?<=[0-9])(?=[A-Za-z])|(?<=[A-Za-z])(?=[0-9])|(?<=[a-z])(?=[A-Z])"
    letters = F.array_distinct(F.split(value, ""))
    covered = _share(F.lower(value), "|".join(words)) if words else F.lit(0.0)
    return found.select(
        "*", F.length(value).cast("double").alias("length"), _share(value, "[0-9]").alias("digits"),
        _share(value, "[A-Z]").alias("capitals"), (F.size(letters) / F.length(value)).alias("distinct"),
        ((F.size(F.split(value, change)) - 1) / F.length(value)).alias("changes"),
        _share(F.lower(value), "[aeiou]").alias("vowels"),
        value.rlike("^[0-9a-fA-F]+$").cast("double").alias("hexadecimal"), covered.alias("covered"),
        (value.rlike("/.*/") | before.rlike(r"(?i)https?:\S*$|[\\/.]$")).cast("double").alias("path"),
        before.rlike(NAMED).cast("double").alias("named"),
        before.rlike(r"[=:]\s*[\"']?$").cast("double").alias("assigned"),
        F.concat_ws(" ", before, value, "after").rlike(PLACEHOLDER).cast("double").alias("placeholder"))


def ruled(featured: DataFrame) -> Column:
    """1 for a secret, 0 for none, null where the rule cannot tell."""
    harmless = (F.col("digits") == 1) | (F.col("path") == 1) | (F.col("placeholder") == 1)
    return F.when((F.col("named") == 1) & (F.col("placeholder") == 0), 1.0).when(harmless, 0.0)


def scan(docs: DataFrame, findings: DataFrame | None = None, sample: int = SAMPLE_FINDINGS) -> DataFrame:
    """A row for each candidate: where it stands, its score and whether it is a secret.

    ``findings`` holds ``value, before, after, label`` of findings that people have judged.
    At most ``sample`` of the labelled findings, by hash, teach the forest.
    """
    words = dictionary(docs)
    found = stage(with_features(candidates(docs), words), "secret-candidates")
    labelled = found.withColumn("label", ruled(found)) if findings is None \
        else with_features(findings, words)
    assembler = VectorAssembler(inputCols=FEATURES, outputCol="features")
    lessons = stage(
        labelled.where(F.col("label").isNotNull()).select(*FEATURES, "label", "value", "before")
        .orderBy(F.xxhash64("value", "before"), "value", "before").limit(sample), "secret-lessons")
    plain = ["doc_id", "start", "end", "length", "named"]
    if lessons.select("label").distinct().count() < 2:
        score = F.coalesce(ruled(found), F.lit(0.0))
        judged = found.select(*plain, score.alias("score"))
    else:
        forest = RandomForestClassifier(
            numTrees=TREES, maxDepth=DEPTH, seed=SEED, cacheNodeIds=False).fit(assembler.transform(lessons))
        judged = forest.transform(assembler.transform(found)).select(
            *plain, vector_to_array("probability")[1].alias("score"))
    return judged.select(
        "doc_id", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"),
        "score", (F.col("score") >= 0.5).alias("is_secret"))
