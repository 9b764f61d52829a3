"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Every benchmark item gives windows of ``window`` consecutive words (a shorter item is one window).
Windows of one length form one Wu-Manber table: blocks of two words index a shift table, so a scan
jumps over positions where no window can end; where the shift is zero, the suffix-block bucket,
narrowed by the window's first block, gives the few windows that are compared directly.

The windows are a stated query set: their total size is measured first, and a set whose tables would take more
than ``max_pattern_bytes`` is cut into blocks. A task holds one block's tables at a time and searches some
``HELD_TEXT`` bytes of texts with every block before it takes the next texts, so the documents are read once. The
items' texts themselves are shared with the workers up to ``max_shared_bytes``; only beyond that is there another pass
over the documents, with the result so far checkpointed between passes. Documents are only mapped, never
shuffled, so a hot passage costs its own occurrences and nothing else.

Defined results: null or word-free text has no words, no hits and is clean; an item without words
has no window; equal windows of several items count for each of them; a null item id is reported
as an empty id; repeated documents are judged one by one; an empty table on either side gives no
hits. Very long texts are scanned whole.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestrata.llm.common import doc_columns, fresh, text_column
from lakestrata.session import checkpoint_root

WINDOW = 13
MAX_PATTERN_BYTES = 32 * 1024 * 1024
MAX_SHARED_BYTES = 256 * 1024 * 1024
HELD_TEXT = 64 * 1024 * 1024

# Bytes of words: digits, lower-case letters and everything beyond ASCII; A-Z is lowered, the rest separates.
_TABLE = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)
_SPAN = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_DDL = "n_words bigint, spans array<struct<start:bigint,end:bigint>>, items array<string>"


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8").translate(_TABLE).split() if text else []


def windows_of(words: list[bytes], window: int = WINDOW) -> list[tuple[bytes, ...]]:
    if not words:
        return []
    if len(words) <= window:
        return [tuple(words)]
    return [tuple(words[i : i + window]) for i in range(len(words) - window + 1)]


class WuManber:
    """Tables for windows of one length ``m``: ``windows`` maps each window to its item ids."""

    def __init__(self, m: int, windows: dict[tuple[bytes, ...], list[str]]):
        self.m, self.block = m, min(2, m)
        self.default = m - self.block + 1
        self.shift: dict[tuple, int] = {}
        self.buckets: dict[tuple, dict[tuple, list[tuple]]] = {}
        self.items = windows
        b = self.block
        for window in windows:
            for end in range(b, m + 1):
                key = window[end - b : end]
                if m - end < self.shift.get(key, self.default):
                    self.shift[key] = m - end
            self.buckets.setdefault(window[m - b :], {}).setdefault(window[:b], []).append(window)

    def scan(self, words: list[bytes], spans: list[tuple[int, int]], items: set[str]) -> None:
        m, b, n, default = self.m, self.block, len(words), self.default
        shift, buckets, get = self.shift, self.buckets, self.shift.get
        end = m
        while end <= n:
            key = tuple(words[end - b : end])
            step = get(key, default)
            if step:
                end += step
                continue
            start = end - m
            for window in buckets[key].get(tuple(words[start : start + b]), ()):
                if tuple(words[start:end]) == window:
                    spans.append((start, end))
                    items.update(self.items[window])
            end += 1


def build_tables(items: list[tuple[str | None, str | None]], window: int = WINDOW) -> list[WuManber]:
    by_length: dict[int, dict[tuple[bytes, ...], list[str]]] = {}
    for item_id, text in items:
        for w in set(windows_of(words_of(text), window)):
            by_length.setdefault(len(w), {}).setdefault(w, []).append("" if item_id is None else str(item_id))
    return [WuManber(m, windows) for m, windows in sorted(by_length.items())]


def search_texts(texts: list, blocks: Iterable[list[WuManber]]) -> pa.StructArray:
    """Hits of all blocks' windows in every text; each block is taken once."""
    n_words = [0] * len(texts)
    found: list[list[tuple[int, int]]] = [[] for _ in texts]
    items: list[set[str]] = [set() for _ in texts]
    for tables in blocks:
        for i, text in enumerate(texts):
            words = words_of(text)
            n_words[i] = len(words)
            for table in tables:
                table.scan(words, found[i], items[i])
    all_spans = []
    for spans in found:
        merged: list[list[int]] = []
        for start, end in sorted(spans):
            if merged and start <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], end)
            else:
                merged.append([start, end])
        all_spans.append([{"start": s, "end": e} for s, e in merged])
    return pa.StructArray.from_arrays(
        [pa.array(n_words, pa.int64()), pa.array(all_spans, _SPAN), pa.array([sorted(x) for x in items], pa.list_(pa.string()))],
        names=["n_words", "spans", "items"],
    )


def _searcher(shared: list, window: int, held_text: int):
    """The search of the shared blocks as a column function. One block's tables are made once a task; of several, each is
    made anew for every ``held_text`` characters of texts."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        if len(shared) == 1:
            tables = build_tables(shared[0].value, window)
            for batch in batches:
                yield search_texts(batch.to_pylist(), [tables])
            return
        held: list[list] = []
        size = 0
        for batch in chain(batches, [None]):
            if batch is not None:
                held.append(batch.to_pylist())
                size += sum(len(t) for t in held[-1])
            if held and (batch is None or size >= held_text):
                got = search_texts([t for texts in held for t in texts], (build_tables(b.value, window) for b in shared))
                at = 0
                for texts in held:  # as many rows a batch as came in
                    yield got.slice(at, len(texts))
                    at += len(texts)
                held, size = [], 0

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, _DDL).asNondeterministic()


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    *,
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    words_per_hit: int = 20,
    max_pattern_bytes: int = MAX_PATTERN_BYTES,
    max_shared_bytes: int = MAX_SHARED_BYTES,
    held_text: int = HELD_TEXT,
    out: str = "decontamination",
) -> DataFrame:
    """``docs`` plus struct ``out``: ``n_words``, ``n_hit``, ``spans`` (word ranges inside any
    occurrence), ``items`` (sorted ids with an occurring window), ``contaminated`` (at least one hit
    word and ``words_per_hit`` × hits ≥ words)."""
    spark = docs.sparkSession
    items = items.select(
        F.col(f"`{item_id_col}`").cast("string").alias("item"), F.col(f"`{item_text_col}`").cast("string").alias("text")
    )
    # each word sits in up to `window` windows, so a table takes about that many times the text
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(total * window / max_pattern_bytes))
    a_pass = max(1, blocks // max(1, math.ceil(total / max_shared_bytes)))  # blocks whose texts are shared at once
    part = fresh(docs, "_found")
    merged = docs
    acc: str | None = None
    for first in range(0, blocks, a_pass):
        shared = []
        for b in range(first, min(blocks, first + a_pass)):
            chosen = items if blocks == 1 else items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == b)
            shared.append(spark.sparkContext.broadcast([(r["item"], r["text"]) for r in chosen.toLocalIterator()]))
        merged = merged.withColumn(part, _searcher(shared, window, held_text)(text_column(docs, text_col)))
        if acc is None:
            acc = fresh(merged, "_so_far")
            merged = merged.withColumnRenamed(part, acc)
        else:
            merged = merged.withColumn(
                acc,
                F.struct(
                    F.col(f"{acc}.n_words").alias("n_words"),
                    F.concat(f"{acc}.spans", f"{part}.spans").alias("spans"),
                    F.array_union(f"{acc}.items", f"{part}.items").alias("items"),
                ),
            ).drop(part)
        if first + a_pass < blocks:
            checkpoint_root(spark)
            merged = merged.checkpoint()
    hit = F.aggregate(
        F.array_sort(f"{acc}.spans"),
        F.struct(F.lit(0).cast("bigint").alias("hit"), F.lit(0).cast("bigint").alias("upto")),
        lambda a, s: F.struct(
            (a["hit"] + F.greatest(F.lit(0).cast("bigint"), s["end"] - F.greatest(a["upto"], s["start"]))).alias("hit"),
            F.greatest(a["upto"], s["end"]).alias("upto"),
        ),
        lambda a: a["hit"],
    )
    n = fresh(merged, "_hit")
    done = merged.withColumn(n, hit)
    return done.withColumn(
        out,
        F.struct(
            F.col(f"{acc}.n_words").alias("n_words"),
            F.col(n).alias("n_hit"),
            F.col(f"{acc}.spans").alias("spans"),
            F.array_sort(f"{acc}.items").alias("items"),
            ((F.col(n) > 0) & (F.lit(words_per_hit) * F.col(n) >= F.col(f"{acc}.n_words"))).alias("contaminated"),
        ),
    ).drop(acc, n)


def op6_decontaminate(spark, sf_dir) -> DataFrame:
    """Contamination of every document by the benchmark's 13-word windows."""
    from lakestrata.llm.common import read

    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    judged = decontaminate(docs, read(spark, sf_dir, "benchmark"), out="r")
    return judged.select(
        "doc_id",
        "r.n_words",
        "r.n_hit",
        F.size("r.items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "r.items"), 256).alias("items_sha256"),
        "r.contaminated",
    )


def stage(spark, docs, sf_dir) -> DataFrame:
    """Pipeline stage: contaminated documents go, the others stay as they are."""
    from lakestrata.llm.common import read

    out = fresh(docs, "_decontamination")
    judged = decontaminate(docs, read(spark, sf_dir, "benchmark"), out=out)
    return doc_columns(judged.where(~F.col(f"{out}.contaminated")), docs)


_WORDS_SQL = r"regexp_extract_all(translate({t}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLE = f"""
    WITH iw AS (SELECT item_id, {_WORDS_SQL.format(t="coalesce(text, '')")} AS w FROM benchmark),
         pat AS (SELECT item_id, CAST(least(13, len(w)) AS BIGINT) AS m,
                        array_to_string(w[p:p + least(13, len(w)) - 1], ' ') AS win
                 FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 12) + 1)) AS p FROM iw WHERE len(w) > 0)),
         lens AS (SELECT DISTINCT m FROM pat),
         d AS (SELECT doc_id, {_WORDS_SQL.format(t="coalesce(text, '')")} AS w FROM documents),
         occ AS (SELECT doc_id, m, p, array_to_string(w[p:p + m - 1], ' ') AS win
                 FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS p FROM d, lens WHERE len(w) >= m)),
         hits AS (SELECT o.doc_id, o.p, o.m, q.item_id FROM occ o JOIN pat q ON o.m = q.m AND o.win = q.win),
         hitw AS (SELECT doc_id, count(DISTINCT i) AS n_hit
                  FROM (SELECT doc_id, unnest(range(p, p + m)) AS i FROM hits) GROUP BY doc_id),
         its AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
                 FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
    SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(h.n_hit, 0) AS BIGINT) AS n_hit,
           CAST(coalesce(i.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(i.items, '')) AS items_sha256,
           coalesce(h.n_hit, 0) > 0 AND 20 * coalesce(h.n_hit, 0) >= len(d.w) AS contaminated
    FROM d LEFT JOIN hitw h USING (doc_id) LEFT JOIN its i USING (doc_id)"""
