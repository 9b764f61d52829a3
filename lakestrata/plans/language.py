"""Comment language: detection, labelling and the type × language report (SRC7, PL15-PL17).

Detection is a Spark ML pipeline trained on labelled text — tokens of the whole text (character
trigrams, or words), hashed term frequencies and multinomial naive Bayes — so fitting is one
distributed aggregation and scoring is a per-row transform. Character n-grams are hashed and counted by ``GramCounts``,
many texts at a time in numpy: no string is made for each of them. A prediction whose top class
probability is below ``threshold`` is ``Unknown``.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.feature import HashingTF, IndexToString, RegexTokenizer, SQLTransformer, StringIndexer, StringIndexerModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasNumFeatures, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata.functions.literal import literal_table
from lakestrata.operators.partitioning import spread_rows
from lakestrata.session import checkpoint_root

UNKNOWN = "Unknown"

# Fixed lookup: detected language code → reported language, in the order of the original table.
LANGUAGE_BY_CODE = (
    ("ar", "English"), ("be", "English"), ("bg", "English"), ("cs", "English"),
    ("da", "English"), ("de", "English"), ("el", "English"), ("en", "English"),
    ("eo", "English"), ("es", "Spanish"), ("et", "English"), ("fa", "English"),
    ("fi", "English"), ("fr", "English"), ("he", "English"), ("hi", "English"),
    ("hu", "English"), ("ia", "English"), ("id", "English"), ("is", "English"),
    ("it", "English"), ("ja", "Japanese"), ("ko", "Korean"), ("la", "English"),
    ("lt", "English"), ("lv", "English"), ("mk", "English"), ("mr", "English"),
    ("nl", "English"), ("pl", "Polish"), ("pt", "Portuguese"), ("ro", "English"),
    ("ru", "Russian"), ("sk", "English"), ("sl", "English"), ("sr", "English"),
    ("sv", "English"), ("tl", "English"), ("tr", "English"), ("tt", "English"),
    ("uk", "English"), ("vi", "Vietnamese"), ("zh", "Chinese"), ("Unknown", "Unknown"),
)


def language_lookup(spark: SparkSession) -> DataFrame:
    """The 44-row ``(code, language)`` lookup as a constant relation (no Python RDD)."""
    return literal_table(spark, LANGUAGE_BY_CODE, ("code", "language"))


def label_languages(df: DataFrame, lookup: DataFrame | None = None, code_col: str = "code") -> DataFrame:
    """Add ``language`` for ``code`` by a left join: unknown codes keep their row with a null language.

    The built-in lookup has a fixed 44 rows and is broadcast; a caller's lookup is left to the
    planner, which broadcasts it only when its measured size is under the broadcast threshold.
    """
    if lookup is None:
        lookup = F.broadcast(language_lookup(df.sparkSession))
    if code_col != "code":
        lookup = lookup.withColumnRenamed("code", code_col)
    return df.join(lookup, code_col, "left")


def language_stats(event_languages: DataFrame, type_col: str = "type", lang_col: str = "language",
                   languages=None, drop_null: bool = False) -> DataFrame:
    """Per event type: one count per language, 0 when absent; a null language is counted in a
    column named ``null`` (dropped with ``drop_null``).

    The input (detection output) is expensive, and a pivot without fixed ``languages`` reads its
    input twice (once to find the values). So the (type, language) counts are aggregated once and
    checkpointed — a small table in the shared checkpoint folder — and the pivot runs over them.
    """
    counts = event_languages.groupBy(type_col, lang_col).agg(F.count(F.lit(1)).alias("__n"))
    if languages is None:
        checkpoint_root(event_languages.sparkSession)
        counts = counts.checkpoint(eager=True)
    grouped = counts.groupBy(type_col)
    pivoted = grouped.pivot(lang_col, list(languages)) if languages is not None else grouped.pivot(lang_col)
    out = pivoted.agg(F.sum("__n"))
    out = out.fillna(0, subset=[c for c in out.columns if c != type_col]).orderBy(type_col)
    return out.drop("null") if drop_null else out


TEXT = "__text"


def _gram_hasher(n: int, num_features: int):
    """A function from texts, given as their UTF-8 bytes one after another and their ``len(texts) + 1`` offsets, to the text
    and the slot of each of their ``n``-grams of code points, as Spark's ``HashingTF`` gives them over the n-grams as strings
    (murmur3 of the UTF-8 bytes, seed 42). All n-grams of a piece are hashed at once, whatever their scripts. It uses only
    what is defined in here, so that it travels to the workers by value: they need not have this package."""
    import numpy as np

    u = np.uint32
    tails = np.array([0, 0xFF, 0xFFFF, 0xFFFFFF], u)

    def mix(k: np.ndarray) -> np.ndarray:
        k = k * u(0xCC9E2D51)
        return (k << u(15) | k >> u(17)) * u(0x1B873593)

    def grams(data: np.ndarray, offsets: np.ndarray):
        starts = np.flatnonzero((data & 0xC0) != 0x80)  # first bytes of code points
        first = np.searchsorted(starts, offsets)
        many = np.maximum(np.diff(first) - n + 1, 0)
        rows = np.repeat(np.arange(len(many)), many)
        point = np.arange(len(rows)) + np.repeat(first[:-1] - (np.cumsum(many) - many), many)
        bounds = np.append(starts, len(data))
        begin = bounds[point]
        length = bounds[point + n] - begin
        padded = np.concatenate((data, np.zeros(4 * n + 4, np.uint8))).astype(u)
        words = padded[:-3] | padded[1:-2] << u(8) | padded[2:-1] << u(16) | padded[3:] << u(24)
        h = np.full(len(rows), 42, u)
        for i in range(4, int(length.max(initial=0)) + 1, 4):
            x = h ^ mix(words[begin + (i - 4)])
            h = np.where(length >= i, (x << u(13) | x >> u(19)) * u(5) + u(0xE6546B64), h)
        rest = length & 3
        h ^= mix(words[begin + (length - rest)] & tails[rest])
        h ^= length.astype(u)
        h = (h ^ h >> u(16)) * u(0x85EBCA6B)
        h = (h ^ h >> u(13)) * u(0xC2B2AE35)
        h ^= h >> u(16)
        return rows, np.mod(h.view(np.int32).astype(np.int64), num_features)

    return grams


def _gram_counter(n: int, num_features: int):
    """A function from a text to the indices (ascending) and counts of its hashed ``n``-grams, by value as ``_gram_hasher``."""
    import numpy as np

    grams = _gram_hasher(n, num_features)

    def count(text: str):
        data = np.frombuffer(text.encode(), np.uint8)
        slots, counts = np.unique(grams(data, np.array([0, len(data)]))[1], return_counts=True)
        return slots.astype(np.int32), counts.astype(np.float64)

    return count


def _text_pieces():
    """A function from an Arrow array of texts (null: empty) to pieces of it, each the numbers of its first and last text (not
    included), the bytes of its texts and their offsets; a piece has some hundred KB unless one text has more."""
    import numpy as np
    import pyarrow as pa

    size = 1 << 17

    def pieces(texts: pa.Array):
        if texts.null_count:
            texts = texts.fill_null("")
        if not len(texts):
            return
        _, places, data = texts.buffers()
        kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
        ends = np.frombuffer(places, kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
        data = np.frombuffer(data if data is not None else b"", np.uint8)
        i = 0
        while i < len(texts):
            j = max(i + 1, int(np.searchsorted(ends, ends[i] + size, "right")) - 1)
            yield i, j, data[ends[i] : ends[j]], ends[i : j + 1] - ends[i]
            i = j

    return pieces


class GramCounts(Transformer, HasInputCol, HasOutputCol, HasNumFeatures, DefaultParamsReadable, DefaultParamsWritable):
    """Hashed counts of the overlapping character n-grams of a text (a null text has none), as ``HashingTF`` gives them over
    the n-grams as strings."""

    n = Param(Params._dummy(), "n", "number of code points of a gram", typeConverter=TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None, numFeatures=1 << 16, n=3):
        super().__init__()
        self._setDefault(numFeatures=1 << 16, n=3)
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        size = self.getNumFeatures()
        grams, pieces = _gram_hasher(self.getOrDefault(self.n), size), _text_pieces()

        def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            import numpy as np
            import pyarrow as pa

            for batch in batches:
                found = np.zeros(len(batch) + 1, np.int32)
                slots, counts = [np.empty(0, np.int32)], [np.empty(0, np.float64)]
                for i, j, data, offsets in pieces(batch):
                    row, slot = grams(data, offsets)
                    keys = row * size + slot
                    if (j - i) * size <= 1 << 32:
                        keys = keys.astype(np.uint32)
                    keys.sort()
                    first = np.flatnonzero(np.concatenate((keys[:1] == keys[:1], keys[1:] != keys[:-1])))
                    counts.append(np.diff(np.append(first, len(keys))).astype(np.float64))
                    keys = keys[first].astype(np.int64)
                    slots.append((keys % size).astype(np.int32))
                    found[i + 1 : j + 1] = np.bincount(keys // size, minlength=j - i)
                ends = pa.array(np.cumsum(found, dtype=np.int32))
                lists = [pa.ListArray.from_arrays(ends, pa.array(np.concatenate(x))) for x in (slots, counts)]
                sparse = [pa.array(np.zeros(len(batch), np.int8)), pa.array(np.full(len(batch), size, np.int32))]
                yield pa.StructArray.from_arrays([*sparse, *lists], names=["type", "size", "indices", "values"])

        run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
        counted = F.arrow_udf(run, VectorUDT()).asNondeterministic()  # never evaluated twice
        return dataset.withColumn(self.getOutputCol(), counted(F.lower(F.col(self.getInputCol()))))


def detector_stages(label_col: str = "lang", analyzer: str = "chars", num_features: int = 1 << 16,
                      ngram: int = 3, smoothing: float = 1.0) -> Pipeline:
    """Unfitted pipeline on column ``__text``: tokens → hashed counts → naive Bayes over the indexed
    ``label_col``.

    ``analyzer="chars"`` uses character ``ngram``-grams, which also work for scripts without spaces;
    ``analyzer="words"`` uses lower-cased runs of letters, about half the work.
    """
    if analyzer == "words":
        features = [
            RegexTokenizer(inputCol=TEXT, outputCol="__tokens", pattern="[^\\p{L}]+", toLowercase=True),
            HashingTF(inputCol="__tokens", outputCol="__features", numFeatures=num_features),
        ]
    elif analyzer == "chars":
        # all overlapping n-grams: those at every n-th place, for each of n first places (no string for each character)
        runs = [f"regexp_extract_all(substring(lower({TEXT}), {i + 1}), '(?s){'.' * ngram}', 0)" for i in range(ngram)]
        features = [
            # for the open-set tests; where nothing reads the n-grams themselves, they are not made
            SQLTransformer(statement=f"SELECT *, concat({', '.join(runs)}) AS __tokens FROM __THIS__"),
            GramCounts(inputCol=TEXT, outputCol="__features", numFeatures=num_features, n=ngram),
        ]
    else:
        raise ValueError(f"unknown analyzer {analyzer!r}: use 'words' or 'chars'")
    index = StringIndexer(inputCol=label_col, outputCol="__label", handleInvalid="skip")
    nb = NaiveBayes(featuresCol="__features", labelCol="__label", smoothing=smoothing, modelType="multinomial",
                    predictionCol="__prediction", probabilityCol="__probability", rawPredictionCol="__raw")
    return Pipeline(stages=[*features, index, nb])


def train_language_detector(train: DataFrame, text_col: str = "text", label_col: str = "lang",
                            **kw) -> PipelineModel:
    """Fit the detector on labelled text (rows with a null text or label are ignored)."""
    rows = train.where(F.col(text_col).isNotNull() & F.col(label_col).isNotNull()).select(
        F.col(text_col).alias(TEXT), F.col(label_col)
    )
    *features, index, bayes = detector_stages(label_col, **kw).getStages()
    if not isinstance(features[-1], GramCounts):
        return Pipeline(stages=[*features, index, bayes]).fit(spread_rows(rows))
    # the sums of a task's texts go into the fit in place of their vectors; as a checkpoint they are computed once
    checkpoint_root(train.sparkSession)
    sums = _label_sums(spread_rows(rows), label_col, features[-1]).checkpoint(eager=True)
    texts = sums.groupBy(label_col).agg(F.sum("__weight").alias("n")).collect()  # a row a label
    # most frequent first, then by name: the order that the indexer's own pass over the rows gives
    labels = [r[0] for r in sorted(texts, key=lambda r: (-r["n"], r[0].encode("utf-16-be")))]
    index = StringIndexerModel.from_labels(labels, label_col, index.getOutputCol(), index.getHandleInvalid())
    return PipelineModel([*features, index, bayes.setWeightCol("__weight").fit(index.transform(sums))])


def _label_sums(rows: DataFrame, label_col: str, counts: GramCounts) -> DataFrame:
    """The label, ``__weight`` and ``__features`` that count for naive Bayes as the texts themselves do: of each task and label
    the sum of its texts' n-gram counts with weight 1, and, for the other texts, an empty vector with their number as weight."""
    size = counts.getNumFeatures()
    grams, pieces = _gram_hasher(counts.getOrDefault(counts.n), size), _text_pieces()

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        import pyarrow as pa

        places: dict[str, int] = {}
        total, texts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            names, which = np.unique(batch.column(0).to_numpy(zero_copy_only=False).astype(object), return_inverse=True)
            label = np.array([places.setdefault(x, len(places)) for x in names], np.int64)[which]
            more = len(places) - len(texts)
            total, texts = np.append(total, np.zeros(more * size, np.int64)), np.append(texts, np.zeros(more, np.int64))
            texts += np.bincount(label, minlength=len(places))
            for i, j, data, offsets in pieces(batch.column(1)):
                row, slot = grams(data, offsets)
                np.add.at(total, label[i:j][row] * size + slot, 1)
        for name, k in places.items():
            some = total[k * size : (k + 1) * size]
            slots = np.flatnonzero(some)
            columns = [name, name], [1, texts[k] - 1], [slots.tolist(), []], [some[slots].tolist(), []]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x[: 1 + (texts[k] > 1)], t) for x, t in zip(columns, types(), strict=True)],
                names=["label", "__weight", "slots", "counts"],
            )

    def types():
        import pyarrow as pa

        return [pa.string(), pa.float64(), pa.list_(pa.int32()), pa.list_(pa.float64())]

    def vector(slots: pa.Array, counts: pa.Array) -> pa.Array:
        import numpy as np
        import pyarrow as pa

        sparse = [pa.array(np.zeros(len(slots), np.int8)), pa.array(np.full(len(slots), size, np.int32))]
        return pa.StructArray.from_arrays([*sparse, slots, counts], names=["type", "size", "indices", "values"])

    vector.__annotations__ = {"slots": pa.Array, "counts": pa.Array, "return": pa.Array}
    texts = rows.select(F.col(label_col).cast("string"), F.lower(TEXT))
    sums = texts.mapInArrow(add_up, "label string, __weight double, slots array<int>, counts array<double>")
    vectors = F.arrow_udf(vector, VectorUDT())("slots", "counts").alias("__features")
    return sums.select(F.col("label").alias(label_col), "__weight", vectors)


def detect_language(df: DataFrame, model: PipelineModel, text_col: str = "text", threshold: float = 0.1,
                    out_col: str = "code", spread: bool = True) -> DataFrame:
    """Add ``out_col``: the predicted language code, ``Unknown`` below ``threshold`` confidence.

    The confidence is the top class probability scaled so that an even guess among the classes is
    0 and certainty is 1. The whole text is scored. A null text or one without a letter has nothing
    to judge and is ``Unknown``. ``spread=False`` is for rows that a shuffle has just dealt out evenly.
    """
    labels = next(s for s in model.stages if isinstance(s, StringIndexerModel)).labels
    # score with the feature stages and the classifier only: the label indexer needs a label column
    scorer = PipelineModel([s for s in model.stages if not isinstance(s, StringIndexerModel)])
    scored = scorer.transform((spread_rows(df) if spread else df).withColumn(TEXT, F.coalesce(F.col(text_col), F.lit(""))))
    scored = IndexToString(inputCol="__prediction", outputCol="__code", labels=labels).transform(scored)
    even = 1.0 / max(1, len(labels))
    top = F.array_max(vector_to_array(F.col("__probability")))
    confidence = (top - even) / (1.0 - even) if len(labels) > 1 else top
    unsure = ~F.col(TEXT).rlike(r"\p{L}") | (confidence < F.lit(threshold))
    code = F.when(unsure, F.lit(UNKNOWN)).otherwise(F.col("__code"))
    return scored.select(*[F.col(f"`{c}`") for c in df.columns], code.alias(out_col))


def save_detector(model: PipelineModel, path: str) -> None:
    """Store a fitted detector (any Hadoop file system)."""
    model.write().overwrite().save(path)


def load_detector(path: str) -> PipelineModel:
    return PipelineModel.load(path)
