"""Document fingerprints by closed syncmers, in SQL expressions only.

The text's alphabet is its pieces, each hashed: a run of at most ``WORD`` non-space code points is one piece, and
of a longer run (text without spaces, encoded data) every code point is one. So whether and where a piece is
cut depends on its own run only, and one more character in a long run moves no other cut. A k-mer is ``K``
consecutive pieces and holds ``K - S + 1`` inner s-mers of ``S`` pieces; it is a closed syncmer, and so an
anchor, when its least inner s-mer is the first or the last one. Whether a k-mer is chosen depends on the
k-mer alone, so anchors outside an edit stay, and the fingerprint lists them in text order for matching
by position. A text of fewer than ``K`` pieces has one anchor, all its pieces. The scheme is the same for texts of all
lengths. The likeness of two texts is the weighted Jaccard similarity of their anchors.

The next document in key order is found without one sorted stream: keys are cut into at most
``MAX_RANGES`` ranges at approximate quantiles, each range is one window group, and every range gets
one more row, a copy of the next range's first document (the heads: at most ``MAX_RANGES`` rows).

Defined results: null counts as empty; a text without pieces has an empty fingerprint; the likeness
of two empty fingerprints is 1, of an empty and another one 0; equal texts have equal fingerprints;
null keys come first and equal keys are ordered by text hash; a single document is its own next; an
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakestrata.llm.common import fresh, read, text_column

K, S = 6, 2  # K is a multiple of S
WORD = 16
PIECES = rf"(?<!\S)\S{{1,{WORD}}}(?!\S)|\S"
PER_RANGE = 4_000
MAX_RANGES = 1_024


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over ``value`` evaluated once (a lambda variable, not a copied expression)."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def anchors(text: Column) -> Column:
    """32-bit hashes of the anchors of ``text``, in order (array<int>)."""
    return closed_syncmers(F.regexp_extract_all(text, F.lit(PIECES), F.lit(0)), K, S)


def closed_syncmers(pieces: Column, k: int, s: int) -> Column:
    """32-bit hashes of the closed syncmers over ``pieces``, in order (array<int>)."""
    hashed = F.transform(pieces, lambda p: F.xxhash64(p))

    def chosen(h: Column) -> Column:
        inner = F.transform(h, lambda x, i: F.xxhash64(x, *[F.get(h, i + j) for j in range(1, s)]))

        def pick(m: Column) -> Column:
            def is_anchor(i: Column) -> Column:
                least = F.array_min(F.slice(m, i + 1, F.lit(k - s + 1)))
                return (least == F.get(m, i)) | (least == F.get(m, i + (k - s)))

            starts = F.filter(F.sequence(F.lit(0), F.size(h) - k), is_anchor)
            # a k-mer's hash from that of the s-mers it is made of
            return F.transform(starts, lambda i: short(F.xxhash64(*[F.get(m, i + j) for j in range(0, k, s)])))

        whole = F.when(F.size(h) > 0, F.array(short(F.xxhash64(h)))).otherwise(F.array().cast("array<int>"))
        return F.when(F.size(h) >= k, let(inner, pick)).otherwise(whole)

    return let(hashed, chosen)


def short(h: Column) -> Column:
    """The hash's low half as an int."""
    low = h.bitwiseAND(F.lit(0xFFFFFFFF))
    return F.when(low >= (1 << 31), low - (1 << 32)).otherwise(low).cast("int")


def printed(a: Column) -> Column:
    """Anchors as text: eight hex digits each, in order."""
    return F.concat_ws("", F.transform(a, lambda x: F.lpad(F.hex(x.cast("bigint").bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0")))


def likeness(a: Column, b: Column) -> Column:
    """Weighted Jaccard similarity of two anchor lists, by one walk over both, sorted together."""
    marked = F.sort_array(
        F.concat(
            F.transform(a, lambda x: x.cast("bigint") * 2), F.transform(b, lambda x: x.cast("bigint") * 2 + 1)
        )
    )
    zero = F.lit(0).cast("bigint")
    start = F.struct(F.lit(1 << 40).cast("bigint").alias("v"), zero.alias("left"), zero.alias("met"))

    def walk(acc: Column, x: Column) -> Column:
        value, second = F.shiftright(x, 1), x.bitwiseAND(F.lit(1).cast("bigint")) == 1
        left = F.when(acc["v"] == value, acc["left"]).otherwise(zero)
        meets = second & (left > 0)
        return F.struct(
            value.alias("v"),
            F.when(meets, left - 1).when(second, left).otherwise(left + 1).alias("left"),
            F.when(meets, acc["met"] + 1).otherwise(acc["met"]).alias("met"),
        )

    total = (F.size(a) + F.size(b)).cast("double")
    return let(
        F.aggregate(marked, start, walk, lambda acc: acc["met"]),
        lambda met: F.when(total == 0, F.lit(1.0)).otherwise(met / (total - met)),
    )


def fingerprint(docs: DataFrame, *, text_col: str = "text", out: str = "fingerprint") -> DataFrame:
    """``docs`` plus array<int> ``out``: the anchors of the whole text in order."""
    return docs.withColumn(out, anchors(text_column(docs, text_col)))


def with_next(docs: DataFrame, *, key: str, carry: list[str], hash_col: str, prefix: str, derived: dict[str, Column] | None = None) -> DataFrame:
    """``docs`` plus ``prefix + c`` for c in ``carry``: the value in the next row by (key, hash_col),
    the first row's after the last. ``key`` is numeric. ``derived`` columns are computed once for every row (and once
    more for the few that also close a range) and may be carried."""
    derived = derived or {}
    spark = docs.sparkSession
    n = docs.count()
    if not n:
        return docs.withColumns(derived).withColumns({prefix + c: F.col(c) for c in carry})
    ranges = max(1, min(MAX_RANGES, n // PER_RANGE))
    cuts = [i / ranges for i in range(1, ranges)]
    bounds: list = []
    if cuts:  # at most MAX_RANGES numbers
        found = docs.agg(F.percentile_approx(key, cuts, 20_000)).first()[0] or []
        bounds = sorted(set(found))
    bucket, last, group = fresh(docs, "_range"), fresh(docs, "_last"), F.col(key)
    if bounds:
        steps = F.array(*[F.lit(b) for b in bounds])
        place = F.when(group.isNull(), F.lit(0)).otherwise(F.size(F.filter(steps, lambda b: b <= group)))
    else:
        place = F.lit(0)
    placed = docs.withColumns({bucket: place, last: F.lit(0)})
    first = F.min(F.struct(F.when(group.isNull(), 0).otherwise(1).alias("n"), group.alias("k"), F.col(hash_col).alias("h")))
    heads = sorted((r[0], r[1]) for r in placed.groupBy(bucket).agg(first).collect())  # at most MAX_RANGES rows
    after = [(h["k"], h["h"], heads[i - 1][0]) for i, (_, h) in enumerate(heads)]
    kt = docs.schema[key].dataType.simpleString()
    k2, h2, b2 = "_head_key_", "_head_hash_", "_head_range_"
    marks = F.broadcast(spark.createDataFrame(after, f"{k2} {kt}, {h2} bigint, {b2} int"))
    guests = (
        placed.join(marks, group.eqNullSafe(F.col(k2)) & (F.col(hash_col) == F.col(h2)))
        .withColumns({bucket: F.col(b2), last: F.lit(1)})
        .select(*placed.columns)
    )
    order = Window.partitionBy(bucket).orderBy(last, F.col(key).asc_nulls_first(), hash_col)
    # after the join that keeps few rows, not below it
    led = placed.unionByName(guests).withColumns(derived).withColumns({prefix + c: F.lead(c).over(order) for c in carry})
    return led.where(F.col(last) == 0).drop(bucket, last)


def compare_with_edit(docs: DataFrame, *, key: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: ``key``, ``n_chars``, ``edited`` (its last quarter replaced by the start of the next
    document), both fingerprints as arrays, ``near_edited`` and ``near_next``."""
    base = docs.select(F.col(f"`{key}`").alias("key"), text_column(docs, text_col).alias("text"))
    base = base.withColumn("hash", F.xxhash64("text"))
    led = with_next(base, key="key", carry=["text", "anchors"], hash_col="hash", prefix="next_", derived={"anchors": anchors(F.col("text"))})
    n = F.length("text").cast("bigint")
    quarter = F.floor(n / 4).cast("int")
    edited = F.concat(
        F.substring("text", F.lit(1), n.cast("int") - quarter), F.substring("next_text", F.lit(1), quarter)
    )
    done = led.withColumn("edited", edited).withColumn("edited_anchors", anchors(F.col("edited")))
    return done.select(
        F.col("key").alias(key),
        n.alias("n_chars"),
        "edited",
        F.col("anchors").alias("fingerprint"),
        F.col("edited_anchors").alias("edited_fingerprint"),
        likeness(F.col("anchors"), F.col("edited_anchors")).alias("near_edited"),
        likeness(F.col("anchors"), F.col("next_anchors")).alias("near_next"),
    )


def op3_syncmers(spark, sf_dir) -> DataFrame:
    """Closed-syncmer fingerprints of every document and of its edited text."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return compare_with_edit(docs).select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        printed(F.col("fingerprint")).alias("fingerprint"),
        printed(F.col("edited_fingerprint")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )
