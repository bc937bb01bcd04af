"""Secret scan: candidate strings, and a random forest that tells secrets from look-alikes.

Everything is DataFrame functions and Spark ML. Candidates are whole words of a document that look
like a key or stand behind a name such as password; their features are length, transitions between
kinds of characters, how much of them dictionary words cover, the source the document comes from and
the words around. The forest is trained on labelled findings.

Without findings labelled by hand, published formats of keys and values of any form given to a name are
positive examples; addresses, masks, versions, dated names, numbers and plain words are negative ones. A
value given to a name that is itself a frequent word of the corpus is prose ("the secret: patience") and
a negative one too. The forest never sees those formats, only the features, and decides about all.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize

SPACE = r"[ \t\n\x0B\f\r]+"
#: A name that is given a value, with the value in the same word, the next or the next but one.
NAME = r"(?i)(?:pass(?:word|wd)?|pwd|secret|token|api[_-]?key|access[_-]?key|auth|credentials?)"
#: name=value in one word, and a name with its sign but without a value.
INSIDE, BARE = NAME + r"[\"']?[:=]+[^:=]", r"^[^0-9]*" + NAME + r"[\"']?[:=]+$"
#: Labelled findings used for training at most; more are sampled by hash.
TRAINING_ROWS = 200_000
TREES, DEPTH, SEED = 24, 6, 11
#: A run of letters is a dictionary word if so many words of the corpus equal it.
WORD_COUNT = 20

# Published formats of keys (fixed values).
KEY_FORMATS = (
    r"^AKIA[0-9A-Z]{16}$",
    r"^gh[pousr]_[A-Za-z0-9]{36}$",
    r"^sk_live_[A-Za-z0-9]{16,}$",
    r"^xox[abprs]-[A-Za-z0-9-]{10,}$",
    r"^AIza[0-9A-Za-z_-]{35}$",
    r"^eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]*$",
)
# Formats that are no keys (fixed values). The first are none even behind a name: addresses, masks, templates.
NEVER_FORMATS = (
    r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+$",
    r"^(?i)(?:https?://|www\.)",
    r"^[*xX._-]+$",
    r"^\$|^%.*%$",
    r"^[0-9]{1,3}$",
)
# Numbers, words, versions, dated names.
HARMLESS_FORMATS = (
    r"^[0-9 ()+.,:/-]+$",
    r"^[A-Za-z'-]+$",
    r"^v?[0-9]+(?:\.[0-9]+)+(?:[-+._]?[a-z]+[0-9]*[a-z]?)*$",
    r"^[A-Za-z]{2,}(?:[-_/.](?:[A-Za-z]{2,}[0-9]{0,4}|[0-9]{1,8}))+$",
)
#: Labelled rows of one value of a column are dealt into so many folds; a row does not see its own.
FOLDS = 5
FEATURES = ("length", "transitions", "digits", "upper", "variety", "coverage", "assigned", "cue", "source_rate", "before_rate")


def _any(value: Column, patterns: tuple[str, ...]) -> Column:
    found = F.lit(False)
    for p in patterns:
        found = found | value.rlike(p)
    return found


def candidates(docs: DataFrame) -> DataFrame:
    """(doc_id, source, word_no, value, assigned, before, cue): words that may be secrets.

    A candidate has 12 characters or more of those that keys are made of and a digit among them, or
    16 capitals, or is the value, of any length, given to a name such as password. A name with its
    sign is no value. Texts without any of these are passed over after one look.
    """
    named = docs.select("doc_id", F.coalesce("source", F.lit("")).alias("source"), "text")
    worth = named.filter(F.col("text").rlike(r"[0-9]|[A-Z]{16}") | F.col("text").rlike(NAME + r"[\"']?\s*[:=]"))
    words = worth.select("doc_id", "source", F.split("text", SPACE).alias("w"))
    parts = F.transform("w", lambda w, k: F.struct(w.alias("w"), k.alias("k")))
    looks = lambda w: w.rlike(r"^(?=.*[0-9])(?=.*[A-Za-z0-9_+/=-]{12})|[A-Z]{16}") | w.rlike(INSIDE)
    # name = "value" in three words or two: the name and the sign are looked for behind the value.
    back = lambda k, n: F.try_element_at("w", F.greatest(k - n + 1, F.lit(1)))
    sign = lambda w: w.rlike(r"^[:=]+$")
    apart = lambda w, k: (k >= 2) & sign(back(k, 1)) & back(k, 2).rlike(NAME + r"[\"']?$")
    colon = lambda w, k: (k >= 1) & back(k, 1).rlike(NAME + r"[\"']?[:=]+$")
    signed = lambda w, k: (k >= 1) & w.rlike(r"^[:=]+[^:=]") & back(k, 1).rlike(NAME + r"[\"']?$")
    behind = lambda w, k: (apart(w, k) | colon(w, k) | signed(w, k)) & ~sign(w)
    wanted = lambda p: (looks(p["w"]) | behind(p["w"], p["k"])) & ~p["w"].rlike(BARE)
    picked = words.select("doc_id", "source", "w", F.explode(F.filter(parts, wanted)).alias("p"))
    word, k = F.col("p.w"), F.col("p.k")
    inside = word.rlike(INSIDE)
    value = F.when(inside, F.regexp_replace(word, r"^.*?" + NAME + r"[\"']?[:=]+", "")).otherwise(word)
    value = F.when(signed(word, k), F.regexp_replace(value, r"^[:=]+", "")).otherwise(value)
    value = F.regexp_replace(value, r"^[\"'(\[{<]+|[\"')\]}>,;.!?]+$", "")
    at = lambda n: F.lower(F.coalesce(F.try_element_at("w", F.when(k - n >= 0, k - n + 1)), F.lit("")))
    after = F.lower(F.coalesce(F.try_element_at("w", k + 2), F.lit("")))
    return picked.select(
        "doc_id",
        "source",
        k.cast("long").alias("word_no"),
        value.alias("value"),
        (inside | behind(word, k)).cast("int").alias("assigned"),
        F.regexp_replace(F.when(at(1).rlike(r"^[:=]+$"), at(2)).otherwise(at(1)), r"[^a-z_-]", "").alias("before"),
        F.concat_ws(" ", at(3), at(2), at(1), after).alias("around"),
    ).filter(F.length("value") >= F.when(F.col("assigned") == 1, 1).otherwise(6))


def dictionary(docs: DataFrame, least: int = WORD_COUNT) -> DataFrame:
    """(part): lower-case runs of 3 to 20 letters that stand alone often enough, over all documents."""
    words = docs.select(F.explode(F.split(F.lower("text"), SPACE)).alias("part"))
    return words.filter(F.col("part").rlike("^[a-z]{3,20}$")).groupBy("part").count().filter(F.col("count") >= least).select("part")


def labelled(found: DataFrame) -> DataFrame:
    """found with label: 1.0 for published key formats and values given to names, 0.0 for harmless formats
    and for values that are words of the corpus as a whole, else null. Needs coverage."""
    value = F.col("value")
    word = F.col("coverage") >= 1.0
    return found.withColumn(
        "label",
        F.when(_any(value, KEY_FORMATS), 1.0)
        .when(_any(value, NEVER_FORMATS) | word, 0.0)
        .when(F.col("assigned") == 1, 1.0)
        .when(_any(value, HARMLESS_FORMATS), 0.0),
    )


def with_rate(rows: DataFrame, key: str) -> DataFrame:
    """Adds the smoothed share of secrets among the labelled findings with the same value of a column.

    Folds are dealt by the hash of the finding: a labelled one sees the labels of other folds only, so
    neither its own label nor that of its copies; an unknown one sees all.
    """
    folded = rows.withColumn("fold", F.pmod(F.xxhash64("value"), F.lit(FOLDS)))
    known = folded.filter(F.col("label").isNotNull()).groupBy(key, "fold").agg(F.sum("label").alias("s"), F.count("label").alias("n"))
    totals = known.groupBy(key).agg(
        F.sum("s").alias("s"), F.sum("n").alias("n"), F.map_from_entries(F.collect_list(F.struct("fold", F.struct("s", "n")))).alias("own")
    )
    own = F.when(F.col("label").isNotNull(), F.col("own")[F.col("fold")])
    rate = (F.col("s") - F.coalesce(own["s"], F.lit(0.0)) + 1) / (F.col("n") - F.coalesce(own["n"], F.lit(0)) + 2)
    return folded.join(totals, key, "left").withColumn(f"{key}_rate", F.coalesce(rate, F.lit(0.5))).drop("s", "n", "own", "fold")


def with_features(found: DataFrame, words: DataFrame) -> DataFrame:
    """Adds the numbers that the forest sees, and labels (null where unknown) if found has none."""
    value = F.col("value")
    kinds = F.regexp_replace(F.regexp_replace(F.regexp_replace(value, "[A-Z]", "A"), "[a-z]", "a"), "[0-9]", "0")
    kinds = F.regexp_replace(kinds, "[^Aa0]", "-")
    share = lambda pattern: 1 - F.length(F.regexp_replace(value, pattern, "")) / F.length(value)
    shaped = found.select(
        "*",
        F.length(value).cast("double").alias("length"),
        ((F.length(F.regexp_replace(kinds, r"(.)\1+", "$1")) - 1) / F.length(value)).alias("transitions"),
        share("[0-9]").alias("digits"),
        share("[A-Z]").alias("upper"),
        (F.size(F.array_distinct(F.split(value, ""))) / F.least(F.length(value), F.lit(36))).alias("variety"),
        F.col("around").rlike(NAME).cast("double").alias("cue"),
        F.regexp_extract_all(F.lower(value), F.lit("[a-z]{3,20}"), 0).alias("parts"),
    )
    # Letters of a value that lie in dictionary words: each distinct part is looked up once.
    parts = shaped.select(F.explode("parts").alias("part")).distinct()
    known = parts.join(words, "part", "left_semi").withColumn("letters", F.length("part"))
    cover = (
        shaped.select("value", "length", F.explode(F.array_distinct("parts")).alias("part"))
        .distinct()
        .join(known, "part")
        .groupBy("value")
        .agg(F.least(F.lit(1.0), F.sum("letters") / F.max("length")).alias("coverage"))
    )
    rows = shaped.drop("parts").join(cover, "value", "left").fillna({"coverage": 0.0})
    return with_rate(with_rate(rows if "label" in rows.columns else labelled(rows), "source"), "before")


def train(rows: DataFrame, most: int = TRAINING_ROWS):
    """A forest from rows with features and label, or None where one of the two labels is missing.

    At most `most` labelled rows are used, those with the least hash, so that the choice is the same
    on every run.
    """
    known = rows.filter(F.col("label").isNotNull())
    order = F.xxhash64("value", "source", "before")
    counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    if not counts.get(0.0) or not counts.get(1.0):
        return None
    if sum(counts.values()) > most:
        limit = known.select(F.percentile_approx(order, most / sum(counts.values()), 10_000)).first()[0]
        known = known.filter(order <= limit)
    sample = known.select(*FEATURES, "label").repartition(8, *FEATURES).sortWithinPartitions(*FEATURES, "label")
    vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="x").transform(sample)
    forest = RandomForestClassifier(
        featuresCol="x", labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=SEED, subsamplingRate=0.8
    )
    return forest.fit(vectors.select("x", "label"))


def score(rows: DataFrame, model) -> DataFrame:
    """Adds probability and is_secret. Without a model, as one of the labels does not occur, findings that
    are not labelled have the smoothed share of secrets among the labelled ones as their probability."""
    if model is None:
        s, n = rows.agg(F.coalesce(F.sum("label"), F.lit(0.0)), F.count("label")).first()
        return rows.withColumn("probability", F.coalesce("label", F.lit((s + 1) / (n + 2)))).withColumn("is_secret", F.col("probability") >= 0.5)
    seen = model.transform(VectorAssembler(inputCols=list(FEATURES), outputCol="x").transform(rows))
    chance = vector_to_array("probability")[1]
    return seen.withColumn("p", chance).drop("x", "rawPrediction", "probability", "prediction").withColumnRenamed("p", "probability").withColumn(
        "is_secret", F.col("probability") >= 0.5
    )


def scan(docs: DataFrame, findings: DataFrame | None = None) -> DataFrame:
    """(doc_id, word_no, value, n_chars, probability, is_secret), a row per candidate word.

    findings, if given, are labelled by hand: (value, label) with label 1.0 for secrets. Null and
    empty texts have no candidates; repeated rows have equal ones; a null source is one of its own;
    ids may be null; other columns are not read. An empty table gives an empty result.
    """
    found = candidates(docs)
    if findings is not None:
        known = findings.select(F.col("value"), F.col("label").cast("double")).groupBy("value").agg(F.max("label").alias("label"))
        found = found.join(known, "value", "left")
    found = materialize(found, "candidates")
    rows = materialize(with_features(found, dictionary(docs)), "features")
    return score(rows, train(rows)).select(
        "doc_id", "word_no", "value", F.length("value").cast("long").alias("n_chars"), F.round("probability", 6).alias("probability"), "is_secret"
    )
