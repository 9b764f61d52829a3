"""Language detection that can say that a text is in none of its languages.

The closed detector (``plans.language``) always finds a best class. Here its answer must also pass two tests of
the winning language, both calibrated on labelled texts that the model was not fitted on:

- the log-likelihood of a token: the class's log-likelihood of the whole text over its number of tokens must not
  lie below what texts of that language and about that length show;
- unseen tokens: the share of the text's n-grams that no training text of the language holds must not lie above it.

The likelihood is what naive Bayes gives anyway; the n-grams of each language are kept as a bitmap of hashed n-grams,
one row a language, joined to the scored rows by their class. Everything is JVM expressions; the
limits are one row for each language and length class (a power of two of tokens).
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import NaiveBayesModel
from pyspark.ml.feature import StringIndexerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata.operators.partitioning import spread_rows
from lakestrata.plans.language import TEXT, UNKNOWN, load_detector, save_detector, train_language_detector
from lakestrata.sinks.commits import put_if_absent, read_small

BITS = 18  # bitmaps of 2**18 hashed n-grams: 32 KB a language
HELD_OUT = 4  # one in four labelled texts calibrates
DEVIATIONS = 5.0  # how far from the mean of a language's own texts a text may lie
MIN_TEXTS = 20  # in a length class, else the limits of all texts of the language hold


@dataclass
class OpenSetDetector:
    model: PipelineModel
    seen: dict[str, list[int]]  # language: bitmap of its n-grams
    limits: dict[str, dict[int, tuple[float, float]]]  # language: length class: least log-likelihood, largest unseen share


def _slot(token: Column) -> Column:
    return F.pmod(F.xxhash64(token), F.lit(1 << BITS))


def _tokens(df: DataFrame, model: PipelineModel) -> DataFrame:
    """``df`` with ``__tokens``: the detector's own n-grams."""
    out = df
    for stage in model.stages:
        if isinstance(stage, (StringIndexerModel, NaiveBayesModel)):
            break
        out = stage.transform(out)
    return out


def seen_grams(train: DataFrame, model: PipelineModel, label_col: str) -> dict[str, list[int]]:
    """The bitmap of each language's n-grams: bits are or-ed per task and word, words sent per language."""
    slots = _tokens(train, model).select(F.col(label_col).alias("code"), F.explode(F.array_distinct("__tokens")).alias("t"))
    slots = slots.select("code", _slot(F.col("t")).alias("s"))
    bit = F.expr("shiftleft(1L, cast(s % 64 as int))")
    words = slots.groupBy("code", F.floor(F.col("s") / 64).cast("int").alias("word")).agg(F.bit_or(bit).alias("bits"))
    out: dict[str, list[int]] = {}
    for r in words.collect():  # at most 2**BITS / 64 rows a language
        out.setdefault(r["code"], [0] * (1 << (BITS - 6)))[r["word"]] = r["bits"]
    return out


def measured(df: DataFrame, model: PipelineModel, seen: dict[str, list[int]], text_col: str) -> DataFrame:
    """``df`` with ``__code`` (best class), ``__confidence``, ``__n`` (tokens), ``__ll`` (log-likelihood of a token) and
    ``__unseen`` (share of tokens that the class's training texts lack)."""
    spark = df.sparkSession
    labels = next(s for s in model.stages if isinstance(s, StringIndexerModel)).labels
    scorer = PipelineModel([s for s in model.stages if not isinstance(s, StringIndexerModel)])
    prior = next(s for s in model.stages if isinstance(s, NaiveBayesModel)).pi.toArray().tolist()
    scored = scorer.transform(spread_rows(df).withColumn(TEXT, F.coalesce(F.col(text_col), F.lit(""))))
    best = F.col("__prediction").cast("int")
    names, priors = F.array(*[F.lit(x) for x in labels]), F.array(*[F.lit(float(x)) for x in prior])
    raw, top = vector_to_array(F.col("__raw")), F.array_max(vector_to_array(F.col("__probability")))
    even = 1.0 / max(1, len(labels))
    n = F.size("__tokens")
    out = scored.withColumns({
        "__code": F.get(names, best), "__n": n,
        "__confidence": (top - even) / (1 - even) if len(labels) > 1 else top,
        "__ll": F.when(n > 0, (F.get(raw, best) - F.get(priors, best)) / n),
    })
    maps = spark.createDataFrame([(c, b) for c, b in seen.items()], "__code string, __bits array<bigint>")
    out = out.join(F.broadcast(maps), "__code", "left")  # 32 KB a language

    def lacks(t: Column) -> Column:
        s = _slot(t)
        word = F.get(F.col("__bits"), F.shiftright(s, 6).cast("int"))
        return F.getbit(word, (s % 64).cast("int")) == 0

    unseen = F.size(F.filter("__tokens", lacks)) / n
    return out.withColumn("__unseen", F.when(n > 0, unseen)).select(*[F.col(f"`{c}`") for c in df.columns], "__code", "__confidence", "__n", "__ll", "__unseen")


def _length_class(n: Column) -> Column:
    return F.floor(F.log2(F.greatest(n, F.lit(1)))).cast("int")


ANY_LENGTH = -1


def _limits(held: DataFrame, label_col: str) -> dict[str, dict[int, tuple[float, float]]]:
    """Limits of each language, for its length classes with enough held-out texts and for all lengths together."""
    own = held.where((F.col("__code") == F.col(label_col)) & (F.col("__n") > 0)).select("__code", _length_class(F.col("__n")).alias("cls"), "__ll", "__unseen")
    both = own.unionByName(own.withColumn("cls", F.lit(ANY_LENGTH)))
    stats = [f(c).alias(n + c) for c in ("__ll", "__unseen") for f, n in ((F.avg, "mean"), (F.stddev_pop, "sd"))]
    out: dict[str, dict[int, tuple[float, float]]] = {}
    for r in both.groupBy("__code", "cls").agg(F.count("*").alias("n"), *stats).collect():  # at most 33 rows a language
        if r["n"] >= MIN_TEXTS or r["cls"] == ANY_LENGTH:
            least = r["mean__ll"] - DEVIATIONS * r["sd__ll"]
            out.setdefault(r["__code"], {})[r["cls"]] = (least, r["mean__unseen"] + DEVIATIONS * r["sd__unseen"] + 0.01)
    return out


def train_open_set(train: DataFrame, text_col: str = "text", label_col: str = "lang", **kw) -> OpenSetDetector:
    """Fit the closed detector and the bitmaps on three quarters of the labelled texts, calibrate on the others."""
    rows = train.where(F.col(text_col).isNotNull() & F.col(label_col).isNotNull()).select(F.col(text_col).alias(TEXT), F.col(label_col).alias("__lang"))
    held = F.pmod(F.xxhash64(TEXT), F.lit(HELD_OUT)) == 0  # copies of a text fall on one side
    fit = rows.where(~held)
    model = train_language_detector(fit, TEXT, "__lang", **kw)
    seen = seen_grams(spread_rows(fit), model, "__lang")
    judged = measured(rows.where(held).withColumnRenamed(TEXT, "__held"), model, seen, "__held")
    return OpenSetDetector(model, seen, _limits(judged, "__lang"))


def detect_open_set(
    df: DataFrame, detector: OpenSetDetector, text_col: str = "text", threshold: float = 0.1, out_col: str = "code", details: bool = False
) -> DataFrame:
    """Add ``out_col``: the language, or ``Unknown`` for a text without a letter, one that two languages fit alike, and one
    that fails a test of its best language. ``details`` keeps the measures (``token_ll``, ``unseen_share``)."""
    spark = df.sparkSession
    rows = [(code, cls, *by.get(cls, by[ANY_LENGTH])) for code, by in detector.limits.items() for cls in range(32)]
    limits = spark.createDataFrame(rows, "__code string, __cls int, __least double, __most double")
    got = measured(df, detector.model, detector.seen, text_col).withColumn("__cls", _length_class(F.col("__n")))
    got = got.join(F.broadcast(limits), ["__code", "__cls"], "left")  # 32 rows a language
    strange = (F.col("__ll") < F.col("__least")) | (F.col("__unseen") > F.col("__most")) | F.col("__least").isNull()
    unsure = ~F.coalesce(F.col(text_col), F.lit("")).rlike(r"\p{L}") | (F.col("__confidence") < threshold) | F.coalesce(strange, F.lit(True))
    extra = [F.col("__ll").alias("token_ll"), F.col("__unseen").alias("unseen_share")] if details else []
    return got.select(*[F.col(f"`{c}`") for c in df.columns], F.when(unsure, UNKNOWN).otherwise(F.col("__code")).alias(out_col), *extra)


def save_open_set(detector: OpenSetDetector, spark: SparkSession, path: str) -> None:
    """Store a detector at ``path`` (which must not hold one yet)."""
    save_detector(detector.model, f"{path.rstrip('/')}/model")
    rest = {"seen": detector.seen, "limits": {c: {str(k): v for k, v in by.items()} for c, by in detector.limits.items()}}
    if not put_if_absent(spark, f"{path.rstrip('/')}/open_set.json", json.dumps(rest)):
        raise ValueError(f"{path} already holds a detector")


def load_open_set(spark: SparkSession, path: str) -> OpenSetDetector:
    rest = json.loads(read_small(spark, f"{path.rstrip('/')}/open_set.json"))
    limits = {c: {int(k): (v[0], v[1]) for k, v in by.items()} for c, by in rest["limits"].items()}
    return OpenSetDetector(load_detector(f"{path.rstrip('/')}/model"), rest["seen"], limits)
