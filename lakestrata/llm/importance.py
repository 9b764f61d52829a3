"""Target-distribution importance resampling over hashed word n-grams, hashed by length-bucketed CRC matrices.

A document's features are its runs of ``low`` to ``high`` consecutive words (ASCII letters lowered, joined by
one space), repeats counted; a feature's bucket is the unsigned crc32 of its bytes modulo ``buckets``. Buckets
counted over all documents and over all target texts give every bucket a gain, the floored thousandfold log
ratio of the two smoothed frequencies; a document's weight is the floored mean gain of its features. Weight plus
Gumbel noise drawn from the document's id ranks the documents, and the highest ranks are the sample.

The hash: the distinct features of an Arrow batch are grouped by length, each group is one two-dimensional
uint8 array with a feature a row, and all CRCs of a group advance together, column by column, through the
256-entry table; the results are scattered back to the features' places. A feature longer than ``SEGMENT``
bytes is cut into rows of that length, whose CRCs are joined by the linear map that a row of zeros applies.

At scale: documents are scanned twice (counts, then weights) and never shuffled or stored; each task sends at
most ``buckets`` partial counts and the driver holds ``buckets`` gains. Ranks need no global sort: scores are
integers, so a histogram of them (a row for each distinct score, some ten thousands whatever the corpus) gives
the cut and how many documents precede each score, and only drawn documents are sorted, score by score. A score
holds about 1 / 2700 of the documents at most, as the noise spreads even documents of one weight.

Defined results: null or wordless texts have no features, weight 0; a null id draws noise as the empty text and
comes after all others of its score; repeated rows are ranked one by one, in any order among themselves; an
empty corpus gives no rows, an empty target gives gains from the corpus alone. Only the id and the text are
read, so other columns cannot clash.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestrata.llm.common import prepare, read, text_column, word_lists
from lakestrata.session import scratch_dir

BUCKETS = 10_000
SEED = 2024
SHARE = 10  # per cent of the eligible documents
MIN_WORDS = 20
SEGMENT = 1024


def _crc_table() -> np.ndarray:
    """The 256-entry table of the reflected CRC-32 polynomial."""
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, (c >> 1) ^ np.uint32(0xEDB88320), c >> 1)
    return c


_TABLE = _crc_table()
_ONES = np.uint32(0xFFFFFFFF)


def _advance(state: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """CRC states after the bytes of ``rows`` (features x length), one column at a time."""
    for column in np.ascontiguousarray(rows.T):
        state = _TABLE[(state ^ column) & 0xFF] ^ (state >> 8)
    return state


def _zeros_map(length: int) -> np.ndarray:
    """What ``length`` zero bytes make of each single state bit (the map is linear)."""
    return _advance(np.uint32(1) << np.arange(32, dtype=np.uint32), np.zeros((32, length), np.uint8))


_SKIP = _zeros_map(SEGMENT)


def _long_crc(feature: bytes) -> int:
    head = len(feature) % SEGMENT
    data = np.frombuffer(feature, np.uint8)
    state = _advance(np.array([_ONES]), data[None, :head])[0]
    own = _advance(np.zeros(len(feature) // SEGMENT, np.uint32), data[head:].reshape(-1, SEGMENT))
    for s in own:
        state = np.bitwise_xor.reduce(_SKIP[(state >> np.arange(32, dtype=np.uint32)) & 1 == 1], initial=np.uint32(0)) ^ s
    return int(state ^ _ONES)


def crc_matrix(features: list[bytes]) -> np.ndarray:
    """Unsigned crc32 of every feature, by equal-length matrices."""
    out = np.zeros(len(features), np.uint32)
    lengths = np.fromiter(map(len, features), np.int64, len(features))
    order = np.argsort(lengths, kind="stable")
    starts = np.flatnonzero(np.diff(lengths[order], prepend=-1))
    for places in np.split(order, starts[1:]) if len(order) else ():
        length = int(lengths[places[0]])
        if length > SEGMENT:
            out[places] = [_long_crc(features[i]) for i in places]
            continue
        rows = np.frombuffer(b"".join([features[i] for i in places]), np.uint8).reshape(len(places), length)
        out[places] = _advance(np.full(len(places), _ONES), rows) ^ _ONES
    return out


def _features(text: str | None, low: int, high: int) -> Iterator[list[bytes]]:
    """The features of a whole text, a list for each piece of it; runs across pieces are kept."""
    tail: list[bytes] = []
    for words in word_lists(text):
        seq = tail + words
        out: list[bytes] = []
        for size in range(low, high + 1):
            first = max(0, len(tail) - size + 1)  # runs that end inside the tail were given before
            out += seq if size == 1 and not tail else [b" ".join(seq[i : i + size]) for i in range(first, len(seq) - size + 1)]
        tail = seq[-(high - 1) :] if high > 1 else []
        yield out


def _buckets_of(distinct: list[bytes], buckets: int) -> np.ndarray:
    return crc_matrix(distinct).astype(np.int64) % buckets


def _batch_texts(batch: pa.RecordBatch) -> list:
    return batch.column("text").to_pylist()


def bucket_counts(docs: DataFrame, *, text_col: str = "text", low: int = 1, high: int = 1, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts fall into each bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from collections import Counter

        total = np.zeros(buckets, np.int64)
        for batch in batches:
            seen: Counter = Counter()
            for text in _batch_texts(batch):
                for found in _features(text, low, high):
                    seen.update(found)
            places = _buckets_of(list(seen), buckets)
            np.add.at(total, places, np.fromiter(seen.values(), np.int64, len(seen)))
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], names=["bucket", "n"])

    parts = docs.select(text_column(docs, text_col).alias("text")).mapInArrow(count, "bucket bigint, n bigint")
    out = np.zeros(buckets, np.int64)
    for r in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # at most ``buckets`` rows
        out[r["bucket"]] = r["n"]
    return out


def bucket_gains(source: np.ndarray, target: np.ndarray) -> list[int]:
    """floor(1000 ln) of the ratio of smoothed target and source frequency of every bucket."""
    k = len(source)
    s_all, t_all = float(source.sum() + k), float(target.sum() + k)
    return [math.floor(1000 * math.log(float(t + 1) * s_all / (float(s + 1) * t_all))) for s, t in zip(source.tolist(), target.tolist(), strict=True)]


def weigh(
    docs: DataFrame, gains: list[int], *, key: str = "doc_id", text_col: str = "text", low: int = 1, high: int = 1,
) -> DataFrame:
    """``key``, ``n_words``, ``n_features`` and ``weight`` (floored mean gain) of every document."""
    buckets = len(gains)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = np.array(gains, np.int64)
        for batch in batches:
            texts = _batch_texts(batch)
            seen: set[bytes] = set()
            for text in texts:
                for found in _features(text, low, high):
                    seen.update(found)
            distinct = list(seen)
            known = dict(zip(distinct, gain[_buckets_of(distinct, buckets)].tolist(), strict=True))
            n_words, n_features, weight = [], [], []
            for text in texts:  # cut into features again: a very long text is never held as its features
                features = total = 0
                for found in _features(text, low, high):
                    features += len(found)
                    total += sum(map(known.__getitem__, found))
                n_features.append(features)
                weight.append(total // features if features else 0)
                n_words.append(features if low == high == 1 else sum(map(len, word_lists(text))))
            arrays = [batch.column("key"), *[pa.array(x, pa.int64()) for x in (n_words, n_features, weight)]]
            yield pa.RecordBatch.from_arrays(arrays, names=["key", "n_words", "n_features", "weight"])

    slim = docs.select(F.col(f"`{key}`").alias("key"), text_column(docs, text_col).alias("text"))
    ddl = f"key {slim.schema['key'].dataType.simpleString()}, n_words bigint, n_features bigint, weight bigint"
    return slim.mapInArrow(run, ddl)


def gumbel_score(weight: str, key: str, seed: int):
    """``weight`` plus thousandfold Gumbel noise from the first 32 bits of sha256(``seed:key``)."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 8), 16, 10).cast("bigint")
    uniform = (h.cast("double") + F.lit(0.5)) / F.lit(4294967296.0)
    return (F.col(weight) + F.floor(F.lit(-1000.0) * F.log(-F.log(uniform)))).cast("bigint")


def _materialise(df: DataFrame, name: str) -> DataFrame:
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def resample(
    docs: DataFrame, target: DataFrame, *, key: str = "doc_id", text_col: str = "text", target_text: str = "text",
    low: int = 1, high: int = 1, buckets: int = BUCKETS, seed: int = SEED, share: int = SHARE, min_words: int = MIN_WORDS,
) -> DataFrame:
    """One row for each document: ``key, n_words, n_features, weight, score, rank`` (null if not drawn)."""
    spark = prepare(docs.sparkSession)
    source = bucket_counts(docs, text_col=text_col, low=low, high=high, buckets=buckets)
    aim = bucket_counts(target, text_col=target_text, low=low, high=high, buckets=buckets)
    weighed = weigh(docs, bucket_gains(source, aim), key=key, text_col=text_col, low=low, high=high)
    scored = _materialise(weighed.withColumn("score", gumbel_score("weight", "key", seed)), "resample-scored")

    eligible = F.col("n_words") >= min_words
    histogram = scored.where(eligible).groupBy("score").agg(F.count("*").alias("n")).collect()  # a row a distinct score
    left = share * sum(r["n"] for r in histogram) // 100
    cut, before = [], 0
    for r in sorted(histogram, key=lambda r: -r["score"]):
        if before >= left:
            break
        cut.append((r["score"], before))
        before += r["n"]
    if not cut:
        return scored.withColumn("rank", F.lit(None).cast("bigint")).withColumnRenamed("key", key)
    low_score = cut[-1][0]
    above = spark.createDataFrame(cut, "score bigint, before bigint")
    reached = F.coalesce(eligible & (F.col("score") >= low_score), F.lit(False))
    within = F.row_number().over(_by_score()).cast("bigint")
    # distinct integer scores only: some ten thousand rows, broadcast
    ranked = scored.where(reached).join(F.broadcast(above), "score").withColumn("rank", F.col("before") + within)
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= left, F.col("rank")))
    out = ["key", "n_words", "n_features", "weight", "score", "rank"]
    rest = scored.where(~reached).withColumn("rank", F.lit(None).cast("bigint"))
    return ranked.select(*out).unionByName(rest.select(*out)).withColumnRenamed("key", key)


def _by_score():
    from pyspark.sql import Window

    return Window.partitionBy("score").orderBy(F.col("key").asc_nulls_last())


def op12_resample(spark, sf_dir) -> DataFrame:
    """Importance weight, score and rank of every document, with ``benchmark`` as the target."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    drawn = resample(docs, read(spark, sf_dir, "benchmark").select("text"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLE = rf"""
    WITH d AS (SELECT doc_id, row_number() OVER () AS r, {_WORDS} AS w FROM documents),
         b AS (SELECT {_WORDS} AS w FROM benchmark),
         dw AS (SELECT r, unnest(w) AS word FROM d),
         bw AS (SELECT unnest(w) AS word FROM b),
         tab AS (SELECT list(list_reduce(list_prepend(i, range(8)),
                                 lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
                 FROM range(256) AS x(i)),
         vocab AS (SELECT word, hex(encode(word)) AS h FROM (SELECT word FROM dw UNION SELECT word FROM bw)),
         crc AS (SELECT word, xor(list_reduce(
                            list_prepend(CAST(4294967295 AS BIGINT),
                                list_transform(range(0, length(h), 2), lambda i: CAST(('0x' || substr(h, CAST(i + 1 AS INTEGER), 2)) AS BIGINT))),
                            lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), CAST(4294967295 AS BIGINT)) % {BUCKETS} AS bucket
                 FROM vocab, tab),
         s AS (SELECT bucket, count(*) AS s FROM dw JOIN crc USING (word) GROUP BY 1),
         t AS (SELECT bucket, count(*) AS t FROM bw JOIN crc USING (word) GROUP BY 1),
         tot AS (SELECT (SELECT coalesce(sum(s), 0) FROM s) AS s_all, (SELECT coalesce(sum(t), 0) FROM t) AS t_all),
         gain AS (SELECT bucket, CAST(floor(1000 * ln(CAST(coalesce(t, 0) + 1 AS DOUBLE) * CAST(s_all + {BUCKETS} AS DOUBLE)
                                  / (CAST(s + 1 AS DOUBLE) * CAST(t_all + {BUCKETS} AS DOUBLE)))) AS BIGINT) AS g
                  FROM s LEFT JOIN t USING (bucket), tot),
         wt AS (SELECT r, count(*) AS n, CAST(sum(g) AS BIGINT) AS g FROM dw JOIN crc USING (word) JOIN gain USING (bucket) GROUP BY 1),
         sc AS (SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_features,
                       CAST(CASE WHEN n IS NULL THEN 0 ELSE floor(CAST(g AS DOUBLE) / n) END AS BIGINT) AS weight,
                       CAST('0x' || substr(sha256('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) AS h
                FROM d LEFT JOIN wt USING (r)),
         sg AS (SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score FROM sc),
         rk AS (SELECT *, row_number() OVER (PARTITION BY n_features >= {MIN_WORDS} ORDER BY score DESC, doc_id) AS k,
                       count(*) FILTER (WHERE n_features >= {MIN_WORDS}) OVER () AS n FROM sg)
    SELECT doc_id, n_features, weight, score,
           CASE WHEN n_features >= {MIN_WORDS} AND k <= {SHARE} * n // 100 THEN k END AS rank
    FROM rk"""
