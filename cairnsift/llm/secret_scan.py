"""Secrets: candidate strings, features, and a random forest that removes false positives.

A candidate is a run of at least 16 key-like characters with a digit in it, inside a word of the text. Features: length,
transitions between letter cases and digits, shares of digits and of distinct characters, dictionary coverage (which part
of its letters lies in pieces that are common words of the corpus), whether the source's name or the string itself reads
like a path or a test fixture, and the neighbouring words (a key's name, an assignment, quotes, placeholders).

The forest (Spark ML, on the JVM) is fitted on labelled findings, at most ``LABELLED`` of each label by least hash. Where
a caller has no labels, ``weak_labels`` gives those that need no judgement: quoted values assigned to a key's name on one
side; digits only, host names and placeholders on the other. A finding is kept at a score of at least ``threshold``.
With labels of one kind only there is nothing to learn, and the weak label decides.

Null and empty texts have no candidate; rows with a null id are scanned, too. Repeated rows give repeated findings.
``pos`` is the number of the word in the text, from 0. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from cairnsift.llm.shared import let, words
from cairnsift.session import stored

LABELLED = 5_000
COMMON = 20  # a dictionary word occurs at least this often

# Fixed values.
CANDIDATE = r"[A-Za-z0-9+/_=.~-]{16,}"
PIECE = r"[A-Za-z]{4,}"
KEY_NAME = r"(?i)token|secret|passw|api-?_?key|access-?_?key|private|credential|auth|bearer"
PLACEHOLDER = r"(?i)example|sample|dummy|test|fake|your|placeholder|changeme|xxxx|0000|1234"
HOST = r"(?i)^[a-z0-9-]+(\.[a-z0-9-]+)*\.(com|org|net|edu|gov|io|dev|info|example)(/|$)"
FIXTURE = r"(?i)test|example|sample|fixture|mock|doc"

FEATURES = ("length", "transitions", "digit_share", "distinct_share", "coverage", "hex", "path", "fixture", "key_name", "assigned", "quoted", "placeholder", "host", "next_plain")


def candidates(documents: DataFrame, doc_id: str, text: str, source: str | None) -> DataFrame:
    """One row per candidate with its neighbours."""
    base = documents.select(F.col(doc_id).alias("doc_id"), (F.col(source) if source else F.lit(None)).cast("string").alias("source"), F.col(text).alias("text"))

    def picked(w: Column) -> Column:
        # A word of fewer than 16 characters is none: the length is tested first, being cheap.
        at = F.filter(F.sequence(F.lit(0), F.size(w) - 1), lambda i: let(F.get(w, i), lambda x: (F.length(x) >= 16) & F.rlike(x, F.lit("[0-9]")) & F.rlike(x, F.lit(CANDIDATE))))
        return F.transform(at, lambda i: F.struct(
            i.alias("pos"), F.get(w, i).alias("word"), F.coalesce(F.get(w, i - 1), F.lit("")).alias("before"),
            F.coalesce(F.get(w, i - 2), F.lit("")).alias("earlier"), F.coalesce(F.get(w, i + 1), F.lit("")).alias("after")))

    listed = base.select("doc_id", "source", F.explode(let(words(F.col("text")), lambda w: F.when(F.size(w) > 0, picked(w)))).alias("f"))
    found = listed.select("doc_id", "source", "f.*").withColumn("candidate", F.explode(F.regexp_extract_all("word", F.lit(CANDIDATE), F.lit(0))))
    return found.where(F.rlike("candidate", F.lit("[0-9]")))


def dictionary(documents: DataFrame, text: str, least: int = COMMON) -> DataFrame:
    """Lower-case words of letters that are common in the corpus, counted over all texts."""
    said = documents.select(F.explode(words(F.lower(text))).alias("piece"))
    plain = said.where(F.length("piece") >= 4).select(F.regexp_extract("piece", f"^({PIECE})[.,;:!?]*$", 1).alias("piece")).where("piece <> ''")
    return plain.groupBy("piece").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least).select("piece")


def featured(found: DataFrame, known: DataFrame) -> DataFrame:
    """Candidates with their features. Rows are told apart by ``row``."""
    pieces = found.select("row", F.explode(F.regexp_extract_all(F.lower("candidate"), F.lit(PIECE), F.lit(0))).alias("piece"))
    covered = pieces.join(known, "piece").groupBy("row").agg(F.sum(F.length("piece")).alias("covered"))
    c, n = F.col("candidate"), F.length("candidate")
    letters = F.regexp_count(c, F.lit("[A-Za-z]"))
    near = F.concat_ws(" ", "earlier", "before", F.regexp_extract("word", r"^(.*?)" + CANDIDATE, 1))
    flag = lambda x: F.coalesce(x, F.lit(False)).cast("double")
    value = {
        "length": n.cast("double"),
        "transitions": F.regexp_count(c, F.lit("[a-z](?=[A-Z0-9])|[A-Z](?=[a-z0-9])|[0-9](?=[A-Za-z])")) / n,
        "digit_share": F.regexp_count(c, F.lit("[0-9]")) / n,
        "distinct_share": F.size(F.array_distinct(F.split(c, ""))) / n,
        "coverage": F.coalesce(F.col("covered"), F.lit(0)) / F.greatest(letters, F.lit(1)),
        "hex": flag(F.rlike(c, F.lit("^[0-9a-fA-F]+$"))),
        "path": flag(F.rlike("word", F.lit("://|^/|[A-Za-z]/[A-Za-z]"))),
        "fixture": flag(F.rlike("source", F.lit(FIXTURE))),
        "key_name": flag(F.rlike(near, F.lit(KEY_NAME))),
        "assigned": flag(F.rlike(near, F.lit("[=:]"))),
        "quoted": flag(F.rlike("word", F.lit("[\"'`]"))),
        "placeholder": flag(F.rlike(F.concat_ws(" ", c, "earlier", "before", "after"), F.lit(PLACEHOLDER))),
        "host": flag(F.rlike(c, F.lit(HOST))),
        "next_plain": flag(F.rlike("after", F.lit("^[A-Za-z]+[.,;]?$"))),
    }
    return found.join(covered, "row", "left").select("row", "doc_id", "pos", "candidate", *[value[k].cast("double").alias(k) for k in FEATURES])


def weak_labels(features: DataFrame) -> DataFrame:
    """The features with ``label``: 1.0, 0.0, or null where the markers do not decide."""
    sure = (F.col("key_name") == 1) & (F.col("assigned") == 1) & (F.col("quoted") == 1) & (F.col("placeholder") == 0) & (F.col("host") == 0) & (F.col("length") >= 20)
    never = (F.col("digit_share") == 1) | (F.col("host") == 1) | (F.col("distinct_share") < 0.15) | ((F.col("placeholder") == 1) & (F.col("key_name") == 0))
    return features.withColumn("label", F.when(sure, 1.0).when(never, 0.0))


def fitted(labelled: DataFrame, limit: int = LABELLED):
    """A forest from at most ``limit`` findings of each label, or None where a label is missing."""
    kinds = []
    for label in (0.0, 1.0):
        kinds.append(labelled.where(F.col("label") == label).orderBy(F.xxhash64("doc_id", "pos", "candidate"), "doc_id", "pos").limit(limit))
    # Bounded by the limit, so one partition holds it; the order makes the fit repeatable.
    sample = kinds[0].union(kinds[1]).select("label", *FEATURES).coalesce(1).sortWithinPartitions("label", *FEATURES)
    sample = stored(sample)
    if sample.select("label").distinct().count() < 2:
        return None
    forest = RandomForestClassifier(numTrees=40, maxDepth=6, seed=11, featureSubsetStrategy="sqrt", featuresCol="features", labelCol="label")
    return forest.fit(VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(sample.coalesce(1)))


def scan(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str | None = "source", labelled: DataFrame | None = None,
         threshold: float = 0.5) -> DataFrame:
    """``doc_id``, ``pos``, ``candidate``, ``score`` and ``is_secret`` of every candidate. ``labelled``: rows of
    ``featured`` with a ``label``; without them the weak labels are learnt."""
    found = stored(candidates(documents, doc_id, text, source).withColumn("row", F.monotonically_increasing_id()))
    features = stored(featured(found, dictionary(documents, text)))
    judged = weak_labels(features)
    model = fitted(labelled if labelled is not None else judged)
    if model is None:
        scored = judged.withColumn("score", F.coalesce("label", F.lit(0.0)))
    else:
        scored = model.transform(VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(features)).withColumn(
            "score", vector_to_array("probability")[1])
    return scored.select("doc_id", "pos", "candidate", "score", (F.col("score") >= threshold).alias("is_secret"))
