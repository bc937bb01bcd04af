"""Quality rules: robust multivariate outliers per language and source.

Every document gives a vector of transformed statistics. The minimum covariance determinant estimate of
a group is centre and scatter of the half of its documents whose scatter is least, so junk does not
shape what it is measured against. Concentration steps lead to it from several starts, and the start
that ends with the least determinant counts. A document far from the centre of its group by its
Mahalanobis distance is rejected.

Groups are all documents, languages, and sources of a language. Each estimate is regularised: it is mixed with that of the group above as if `PRIOR` documents had come
from there. So a source of three documents is judged almost as its language is, one of a thousand by
its own, and nothing switches in between.

All documents take part in every step. A step is one aggregate for the distance quantile and one for
sums of products, both with map-side parts: a source that holds a third of all rows is a few numbers
per task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, raw_texts

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Transformed statistics. Shares are taken as square roots, which evens out their variance; a few
#: neutral words are added to each so that short texts do not jump to the extremes.
FEATURES = ("f_word_length", "f_symbols", "f_marks", "f_upper", "f_dup_lines", "f_repeats", "f_variety")
#: Least standard deviation per feature: what differs by less is no sign of poor quality. A greater one
#: is taken as it is. It also keeps the scatter invertible where a statistic is constant in a group.
FLOORS = (0.10, 0.03, 0.05, 0.06, 0.12, 0.12, 0.05)
#: Rejection radius in standard deviations or floors. A normal cloud of seven features has one document
#: in a thousand beyond it.
RADIUS = 5.0
#: Weight of the estimate of the group above, in documents.
PRIOR = 50
#: Concentration steps from each start.
STEPS = 3
#: Starts: medians and quartile ranges; mean and covariance; medians and the scatter of directions.
QUARTILES, CLASSICAL, DIRECTIONS = 0, 1, 2

SYMBOLS = b"#*$%&|<>"
MARKS = b"!?;:=~^_+@\\/{}[]()\"'"
UPPER = bytes(range(65, 91))
_STATS = pa.schema([(name, pa.int64()) for name in BASE] + [(name, pa.float64()) for name in FEATURES])


def _repeat_words(words: list[bytes]) -> tuple[int, int]:
    """Words inside three-word windows found twice or more, and the number of distinct words."""
    ids: dict[bytes, int] = {}
    w = np.fromiter((ids.setdefault(x, len(ids)) for x in words), np.int64, len(words))
    if len(w) < 4:
        return 0, len(ids)
    if len(ids) < 1 << 20:
        window = (w[:-2] * len(ids) + w[1:-1]) * len(ids) + w[2:]
    else:
        pair = np.unique(w[:-2] * len(ids) + w[1:-1], return_inverse=True)[1]
        window = pair * len(ids) + w[2:]
    order = np.argsort(window, kind="stable")
    same = window[order[1:]] == window[order[:-1]]
    twice = np.zeros(len(window), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(len(w), bool)
    for k in range(3):
        covered[k : k + len(window)] |= twice
    return int(covered.sum()), len(ids)


def statistics(text: bytes) -> tuple:
    """The five counts and the transformed vector of one text (UTF-8)."""
    words = text.split()
    n = len(words)
    joined = b"".join(words)
    chars = len(joined.decode("utf-8", "replace"))
    symbols = len(joined) - len(joined.translate(None, SYMBOLS))
    marks = len(joined) - len(joined.translate(None, MARKS))
    upper = len(joined) - len(joined.translate(None, UPPER))
    seen: set[bytes] = set()
    lines = repeated_lines = 0
    for line in text.split(b"\n"):
        if line.split(None, 1):
            lines += 1
            repeated_lines += line in seen
            seen.add(line)
    repeats, distinct = _repeat_words(words)
    share = lambda part, whole, even: math.sqrt(part / (whole + even))
    return (
        n,
        chars,
        symbols,
        repeated_lines,
        repeats,
        math.log((chars + 100) / (n + 20)),
        share(symbols, chars, 100),
        share(marks, chars, 100),
        share(upper, chars, 100),
        share(repeated_lines, lines, 4),
        share(repeats, n, 20),
        math.log(distinct + 10) / math.log(n + 20) if n else 1.0,
    )


def with_statistics(docs: DataFrame, columns: list[str]) -> DataFrame:
    """`columns` of docs (text among what is read) and the statistics of each text. No shuffle."""
    spark_schema = docs.select(*columns).schema
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in spark_schema] + [f"{n} long" for n in BASE] + [f"{n} double" for n in FEATURES])
    clash = "__text"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [statistics(t) for t in raw_texts(batch, clash)]
            found = [pa.array([r[k] for r in rows], f.type) for k, f in enumerate(_STATS)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(k) for k in range(len(columns))] + found, [*columns, *_STATS.names]
            )

    return docs.select(*columns, F.col("text").alias(clash)).mapInArrow(run, schema)


def base_failed(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < 50) | (100 * n_repeat_words > 50 * n_words)


D = len(FEATURES)
#: Median of the chi-square distribution with D degrees of freedom (Wilson and Hilferty).
MEDIAN_SQUARE = D * (1 - 2 / (9 * D)) ** 3
#: By how much the scatter of the inner half of a normal cloud of seven features is too small.
HALF_FACTOR = 1.695


def _distance() -> Column:
    """Squared Mahalanobis distance from columns m (centre) and p (precision, row by row)."""
    gap = [F.col(name) - F.col("m")[k] for k, name in enumerate(FEATURES)]
    total = F.lit(0.0)
    for i in range(D):
        row = F.lit(0.0)
        for j in range(D):
            row = row + F.col("p")[i * D + j] * gap[j]
        total = total + gap[i] * row
    return total


def floored(cov: np.ndarray, floors: np.ndarray) -> np.ndarray:
    """The covariance with each deviation raised to its floor and all correlations as they are."""
    deviation = np.sqrt(np.maximum(np.diag(cov), 0))
    correlation = cov / np.outer(*[np.where(deviation > 0, deviation, 1)] * 2)
    np.fill_diagonal(correlation, 1)
    raised = np.maximum(deviation, floors)
    return correlation * np.outer(raised, raised)


def regularised(
    n: float, mean: np.ndarray, cov: np.ndarray, above: tuple[np.ndarray, np.ndarray] | None, floors: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Mean and covariance of n documents mixed with those of the group above, whose weight is PRIOR; the
    first group of all is mixed with no correlation at all, so that its covariance has an inverse."""
    if above is None:
        above = (mean, np.diag(np.maximum(np.diag(cov), np.square(floors))))
    share = n / (n + PRIOR)
    mixed = share * floored(cov, floors) + (1 - share) * above[1]
    return share * mean + (1 - share) * above[0], floored(mixed, floors)


def _solve(moments: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Centre, scatter, precision and log determinant from sums of features and of their products."""
    floors = np.array(FLOORS)
    for frame in moments:
        out = []
        for r in frame.itertuples(index=False):
            mean = np.asarray(r.s, float) / r.n
            cov = np.zeros((D, D))
            cov[np.triu_indices(D)] = np.asarray(r.q, float) / r.n
            cov = cov + np.triu(cov, 1).T - np.outer(mean, mean)
            if r.centre is not None:
                # Directions are summed about their centre and have no scale of their own.
                mean = np.asarray(r.centre, float)
            above = None if r.am is None else (np.asarray(r.am, float), np.asarray(r.ac, float).reshape(D, D))
            mean, cov = regularised(r.n, mean, cov * r.factor, above, floors)
            out.append((r.g, r.start, mean.tolist(), cov.ravel().tolist(), np.linalg.inv(cov).ravel().tolist(), np.linalg.slogdet(cov)[1]))
        yield pd.DataFrame(out, columns=["g", "start", "m", "c", "p", "det"])


def _sums(rows: DataFrame, *columns: Column) -> DataFrame:
    """n, s, q per group and start: the number of rows, sums of D columns and of their products."""
    products = [F.sum(columns[i] * columns[j]) for i in range(D) for j in range(i, D)]
    return rows.groupBy("g", "start").agg(
        F.count(F.lit(1)).alias("n"), F.array(*[F.sum(c) for c in columns]).alias("s"), F.array(*products).alias("q")
    )


def _model(sums: DataFrame, above: DataFrame, name: str) -> DataFrame:
    """(g, start, m, c, p, det) from sums (with centre and factor), and the estimates above (g, start, am, ac)."""
    solved = sums.join(above, ["g", "start"]).mapInPandas(
        _solve, "g string, start int, m array<double>, c array<double>, p array<double>, det double"
    )
    return materialize(solved, name)


def least_determinant(rows: DataFrame, groups: DataFrame, steps: int = STEPS) -> DataFrame:
    """(g, m, c): centre and scatter of each group. rows are (g, features), a row for each group a document
    is in; groups are (g, g0), where g0 is the group above, null where there is none.

    Groups of all sizes are estimated side by side: a step mixes a group's sums with the estimate that
    the step before has given the group above.
    """
    features = [F.col(f) for f in FEATURES]
    spread = rows.groupBy("g").agg(*[F.percentile_approx(f, [0.25, 0.5, 0.75], 2000).alias(f"q_{f}") for f in FEATURES])
    centre = F.array(*[F.col(f"q_{f}")[1] for f in FEATURES])
    sigma = [F.greatest((F.col(f"q_{f}")[2] - F.col(f"q_{f}")[0]) / 1.349, F.lit(FLOORS[k])) for k, f in enumerate(FEATURES)]
    spread = materialize(spread.select("g", centre.alias("centre"), F.array(*sigma).alias("sigma")), "spread")

    def diagonal(power: int) -> Column:
        return F.array(*[F.pow(F.col("sigma")[i], power) if i == j else F.lit(0.0) for i in range(D) for j in range(D)])

    starts = F.explode(F.array(*[F.lit(k) for k in (QUARTILES, CLASSICAL, DIRECTIONS)])).alias("start")
    wanted = materialize(groups.select("g", "g0", starts), "wanted")

    def above(model: DataFrame) -> DataFrame:
        """The model of the group above, by group and start; null where there is none."""
        parent = model.select(F.col("g").alias("g0"), "start", F.col("m").alias("am"), F.col("c").alias("ac"))
        return wanted.join(parent, ["g0", "start"], "left").select("g", "start", "am", "ac")

    quartiles = spread.select("g", F.lit(QUARTILES).alias("start"), F.col("centre").alias("m"), diagonal(2).alias("c"), diagonal(-2).alias("p"))
    gap = [(features[k] - F.col("centre")[k]) / F.col("sigma")[k] for k in range(D)]
    length = F.sqrt(sum((g * g for g in gap), F.lit(0.0)))
    direction = [F.when(length > 0, g / length * F.col("sigma")[k]).otherwise(0.0) for k, g in enumerate(gap)]
    towards = rows.join(spread, "g").select("g", F.lit(DIRECTIONS).alias("start"), *[d.alias(f) for d, f in zip(direction, FEATURES)])
    both = _sums(rows.withColumn("start", F.lit(CLASSICAL)).unionByName(towards), *features)
    own = spread.select("g", F.lit(DIRECTIONS).alias("start"), "centre")
    factor = F.when(F.col("start") == DIRECTIONS, float(D)).otherwise(1.0).alias("factor")
    both = both.join(own, ["g", "start"], "left").select("*", factor)
    # The groups above are as their quartiles say, in every start.
    plain = quartiles.drop("start", "p").withColumn("start", F.explode(F.array(F.lit(CLASSICAL), F.lit(DIRECTIONS))))
    model = quartiles.unionByName(_model(both, above(plain), "starts").drop("det"))
    none = F.lit(None).cast("array<double>").alias("centre")
    for _ in range(steps):
        far = rows.join(model.select("g", "start", "m", "p"), "g").withColumn("d2", _distance()).drop("m", "p")
        half = far.groupBy("g", "start").agg(F.percentile_approx("d2", 0.5, 2000).alias("h"))
        # Written, so that its size is known: one row per group and start.
        inner = far.join(materialize(half, "half"), ["g", "start"]).filter("d2 <= h")
        sums = _sums(inner, *features).select("*", none, F.lit(HALF_FACTOR).alias("factor"))
        solved = _model(sums, above(model), "model")
        model = solved.drop("det")
    best = solved.groupBy("g").agg(F.min_by(F.struct("m", "c", "p"), F.struct("det", "start")).alias("b")).select("g", "b.*")
    best = materialize(best, "best")
    # What is left of the cloud's scale: the median distance says by how much the scatter is too small.
    far = rows.join(best.select("g", "m", "p"), "g").withColumn("d2", _distance())
    scale = far.groupBy("g").agg(F.greatest(F.lit(1.0), F.percentile_approx("d2", 0.5, 2000) / MEDIAN_SQUARE).alias("scale"))
    return best.join(scale, "g").select("g", "m", F.transform("c", lambda x: x * F.col("scale")).alias("c"))


def _inverse(found: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in found:
        frame["p"] = [np.linalg.inv(np.asarray(c, float).reshape(D, D)).ravel().tolist() for c in frame.c]
        yield frame[["l", "s", "m", "p"]]


def fit(stats: DataFrame, steps: int = STEPS) -> DataFrame:
    """(l, s, m, p): centre and precision for each language l and source s ('' for null).

    stats has lang, source, the base counts and the features; rows that fail the base rules take no
    part.
    """
    named = stats.filter(~base_failed(F.col("n_words"), F.col("n_repeat_words"))).select(
        F.coalesce("lang", F.lit("")).alias("l"), F.coalesce("source", F.lit("")).alias("s"), *FEATURES
    )
    # Groups of documents, of languages, of sources; the length keeps any two pairs of the last apart.
    keys = {
        "g0": F.lit("all"),
        "g1": F.concat(F.lit("language "), "l"),
        "g2": F.concat_ws(":", F.lit("source"), F.length("l").cast("string"), "l", "s"),
    }
    vectors = materialize(named.withColumns(keys), "vectors")
    pairs = materialize(vectors.select("l", "s", *keys).distinct(), "pairs")
    levels = [("g0", F.lit(None).cast("string")), ("g1", F.col("g0")), ("g2", F.col("g1"))]
    groups = reduce(DataFrame.unionByName, [pairs.select(F.col(g).alias("g"), up.alias("g0")) for g, up in levels]).distinct()
    rows = vectors.select(F.explode(F.array(*keys)).alias("g"), *FEATURES)
    estimate = least_determinant(rows, groups, steps).withColumnRenamed("g", "g2")
    last = pairs.select("l", "s", "g2").join(estimate, "g2").select("l", "s", "m", "c")
    return materialize(last.mapInPandas(_inverse, "l string, s string, m array<double>, p array<double>"), "fitted")


#: More pairs of language and source than this are joined by shuffle instead of broadcast.
BROADCAST_GROUPS = 20_000


def with_verdict(stats: DataFrame, fitted: DataFrame, radius: float = RADIUS) -> DataFrame:
    """Adds distance (null in a group of which all rows fail the base rules), base_failed and kept."""
    l, s = F.coalesce("lang", F.lit("")), F.coalesce("source", F.lit(""))
    model = fitted.withColumnsRenamed({"l": "__l", "s": "__s"})
    if fitted.count() <= BROADCAST_GROUPS:
        model = F.broadcast(model)
    failed = base_failed(F.col("n_words"), F.col("n_repeat_words"))
    return (
        stats.join(model, (l == F.col("__l")) & (s == F.col("__s")), "left")
        .withColumn("distance", F.sqrt(F.greatest(F.lit(0.0), _distance())))
        .withColumn("base_failed", failed)
        .withColumn("kept", ~failed & F.coalesce(F.col("distance") <= radius, F.lit(True)))
        .drop("__l", "__s", "m", "p")
    )


def judge(docs: DataFrame, radius: float = RADIUS) -> DataFrame:
    """(doc_id, lang, source, counts, features, distance, base_failed, kept), a row per row of docs.

    Needs doc_id, text, lang and source; other columns are not read. Null text counts as empty and
    fails the base rules; null language or source is a group of its own; repeated rows are judged
    alike. Empty tables give none.
    """
    stats = materialize(with_statistics(docs, ["doc_id", "lang", "source"]), "stats")
    return with_verdict(stats, fit(stats), radius)


def keep_good(docs: DataFrame, radius: float = RADIUS) -> DataFrame:
    """The rows of docs that pass, with all their columns unchanged.

    The estimate comes from one reading of the texts, the verdict from another, so that no text is
    shuffled or stored.
    """
    fitted = fit(materialize(with_statistics(docs, ["lang", "source"]), "stats"))
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), "text", "lang", "source")
    judged = with_verdict(with_statistics(whole, ["doc", "lang", "source"]), fitted, radius)
    return judged.filter("kept").select("doc.*")
