"""Ranked lexical search by exact inner products over sparse ball trees.

Terms are maximal runs of letters, digits and non-ASCII characters (A-Z lowered). A document is the sparse vector
of its terms' saturated counts, a query the vector of its terms' weights times their repeats, all integers; the
score is their inner product. Only terms of the queries can matter, so vectors are kept on these alone.

Documents are held in trees: a node is a set of documents with their centroid c, the radius r of a ball around
it, and the support S, the terms that any of them holds. For a query q no document below scores more than
<q_S, c> + |q_S| r (outside S all its documents are zero). A node is split at the median of its documents'
projection on the line between two far members. A query walks a tree best bound first and stops at the first
bound below its tenth best score; in leaves scores are computed in 64-bit integers. Bounds are doubles, raised
by more than the rounding errors of their sums can take away, so pruning never loses a document, ties included.

At scale: documents are mapped, never shuffled. The vectors are written once; every task cuts its vectors into
trees of ``TREE_ROWS`` documents and carries the best scores from tree to tree, starting from the tenth best
among a bounded sample (a lower bound of the final one), and sends ten rows a query. Document frequencies are summed
per task first. Queries are taken in blocks of ``MAX_ITEM_BYTES`` of text (what a task holds of them).

Defined results: null or wordless texts have no terms, are not counted and never listed; queries without terms
have no rows; equal scores rank by ascending key, null keys last; repeated documents are ranked one by one and
repeated or null query ids are kept as queries of their own; empty tables give no rows. Only the named columns
are read, so others cannot clash.
"""

from __future__ import annotations

import heapq
import math
from bisect import insort
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakestrata.llm.common import prepare, read, text_column, unit_hash, word_lists
from lakestrata.session import scratch_dir

TOP = 10
LEAF = 32
TREE_ROWS = 4096
TREE_ENTRIES = 2_000_000
MAX_ITEM_BYTES = 8 << 20
QUERY_CELLS = 4_000_000  # terms times queries that a task holds densely
SAMPLE_ROWS = 20_000
SLACK = 1e-9  # relative; sums of up to millions of terms err by less


def impact(tf: np.ndarray, n: np.ndarray, docs: int, terms: int) -> np.ndarray:
    """Saturated term counts; ``n`` terms in the document, ``docs`` documents, ``terms`` in all."""
    m = 100 - 75 + (75 * n * docs) // max(terms, 1)
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def weight(df: int, docs: int) -> int:
    return math.floor(1000 * math.log((2 * docs + 2) / (2 * df + 1)))


class BallTree:
    """Tree over the rows of a sparse matrix (row ``i``: ``dims[ptr[i]:ptr[i+1]]`` with ``values``); no row is empty."""

    def __init__(self, ptr: np.ndarray, dims: np.ndarray, values: np.ndarray, n_dims: int, leaf: int = LEAF):
        self.ptr, self.dims, self.values, self.n_dims = ptr, dims, values, n_dims
        self.real = values.astype(np.float64)
        self.norm = np.add.reduceat(self.real * self.real, ptr[:-1])
        self.nodes: list[tuple] = []  # rows, support, centroid, radius
        self.children: dict[int, tuple[int, int]] = {}
        todo = [(np.arange(len(ptr) - 1), None)]
        while todo:
            rows, parent = todo.pop()
            node, halves = self._node(rows, leaf)
            if parent is not None:
                self.children[parent] = (*self.children.get(parent, ()), node)
            todo += [(h, node) for h in halves]

    def entries(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the rows' entries, and where each row's begin among them."""
        size = self.ptr[rows + 1] - self.ptr[rows]
        first = np.cumsum(size) - size
        return np.repeat(self.ptr[rows] - first, size) + np.arange(int(size.sum())), first

    def _node(self, rows: np.ndarray, leaf: int) -> tuple[int, list[np.ndarray]]:
        at, first = self.entries(rows)
        dims, real = self.dims[at], self.real[at]
        mean = np.bincount(dims, weights=real, minlength=self.n_dims) / len(rows)
        support = np.unique(dims)

        def dots(vector: np.ndarray) -> np.ndarray:
            return np.add.reduceat(real * vector[dims], first)

        def away(vector: np.ndarray, square: float) -> np.ndarray:
            return self.norm[rows] - 2 * dots(vector) + square

        square = float(mean @ mean)
        far = away(mean, square)
        # the difference of squares may cancel: raised by its rounding error
        radius = math.sqrt(max(0.0, float((far + SLACK * (self.norm[rows] + square)).max())))
        self.nodes.append((rows, support, mean[support], radius))
        if len(rows) <= leaf:
            return len(self.nodes) - 1, []
        a = self._dense(rows[int(far.argmax())])
        b = self._dense(rows[int(away(a, float(a @ a)).argmax())])
        order = np.argsort(dots(b - a), kind="stable")
        half = len(rows) // 2
        return len(self.nodes) - 1, [rows[order[:half]], rows[order[half:]]]

    def _dense(self, row: int) -> np.ndarray:
        out = np.zeros(self.n_dims)
        span = slice(self.ptr[row], self.ptr[row + 1])
        out[self.dims[span]] = self.real[span]
        return out


class Search:
    """Best-first walks of many queries (``q``: terms x queries, integers) through a tree."""

    def __init__(self, tree: BallTree, q: np.ndarray):
        self.tree, self.q = tree, q
        self.real = q.astype(np.float64)
        self.square = self.real * self.real
        self.known: dict[int, np.ndarray] = {}
        self.scored = 0  # leaves scored, over all queries

    def bounds(self, node: int) -> np.ndarray:
        got = self.known.get(node)
        if got is None:
            _, support, mean, radius = self.tree.nodes[node]
            reach = np.sqrt(self.square[support].sum(0))
            middle = mean @ self.real[support]
            slack = SLACK * reach * (radius + math.sqrt(float(mean @ mean)))
            got = self.known[node] = middle + reach * radius * (1 + SLACK) + slack + 1
        return got

    def run(self, query: int, keys: list, best: list, least: int, top: int) -> None:
        """Adds this tree's rows to ``best``, the sorted (-score, key is null, key) of the ``top`` best so far;
        rows that score less than ``least`` are of no interest."""
        def floor() -> int:
            return max(least, 1, -best[-1][0] if len(best) == top else 1)

        heap = [(-float(self.bounds(0)[query]), 0)]
        while heap:
            bound, node = heapq.heappop(heap)
            if -bound < floor():
                return
            children = self.tree.children.get(node)
            if children:
                for c in children:
                    b = float(self.bounds(c)[query])
                    if b >= floor():
                        heapq.heappush(heap, (-b, c))
                continue
            rows = self.tree.nodes[node][0]
            at, first = self.tree.entries(rows)
            scores = np.add.reduceat(self.tree.values[at] * self.q[self.tree.dims[at], query], first)
            self.scored += 1
            for i in np.flatnonzero(scores >= floor()):
                key = keys[rows[i]]
                insort(best, (-int(scores[i]), key is None, 0 if key is None else key))
                del best[top:]


# ---------------------------------------------------------------- queries
def _blocks(items: DataFrame, key: str, text_col: str, max_bytes: int) -> Iterator[list[tuple]]:
    """Blocks of (query key, term counts), by size of their texts."""
    block, size = [], 0
    for r in items.select(F.col(f"`{key}`").alias("key"), text_column(items, text_col).alias("text")).toLocalIterator():
        counts: Counter = Counter()
        for words in word_lists(r["text"]):
            counts.update(words)
        if not counts:
            continue
        weighs = len(r["text"].encode("utf-8"))
        if block and size + weighs > max_bytes:
            yield block
            block, size = [], 0
        block.append((r["key"], counts))
        size += weighs
    if block:
        yield block


def _materialise(df: DataFrame, name: str) -> DataFrame:
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def vectors(docs: DataFrame, vocabulary: dict[bytes, int], *, key: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(key, n, terms, tf): terms in all, and the vocabulary's terms in ascending order with their counts."""
    slim = docs.select(F.col(f"`{key}`").alias("key"), text_column(docs, text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = vocabulary.get
        for batch in batches:
            n, terms, counts = [], [], []
            for text in batch.column("text").to_pylist():
                total, seen = 0, np.zeros(0, np.int64)
                for words in word_lists(text):
                    total += len(words)
                    seen = np.concatenate([seen, np.array([t for t in map(place, words) if t is not None], np.int64)])
                t, c = np.unique(seen, return_counts=True)
                n.append(total)
                terms.append(t.tolist())
                counts.append(c.tolist())
            arrays = [batch.column("key"), pa.array(n, pa.int64()), pa.array(terms, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(arrays, names=["key", "n", "terms", "tf"])

    kind = slim.schema["key"].dataType.simpleString()
    return slim.mapInArrow(run, f"key {kind}, n bigint, terms array<int>, tf array<bigint>")


def frequencies(vecs: DataFrame, size: int) -> np.ndarray:
    """Documents that hold each term; tasks send sums."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            total += np.bincount(pa.compute.list_flatten(batch.column("terms")).to_numpy(), minlength=size)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], names=["term", "n"])

    out = np.zeros(size, np.int64)
    for r in vecs.select("terms").mapInArrow(count, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n")).collect():
        out[r["term"]] = r["n"]  # at most one row a term of the block
    return out


def _searched(vecs: DataFrame, q_terms: list, q_values: list, docs: int, terms: int, least: list[int], top: int, size: int) -> DataFrame:
    """(item, key, score): each task's best rows of every query, ``item`` being the query's number."""
    kind = vecs.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list] = [[] for _ in q_terms]
        owner = np.repeat(np.arange(len(q_terms)), [len(t) for t in q_terms])
        all_terms, all_values = np.concatenate(q_terms), np.concatenate(q_values)
        kind_of = None

        def search(keys: list, n: np.ndarray, dims: np.ndarray, tf: np.ndarray, lengths: np.ndarray) -> None:
            local, dims = np.unique(dims, return_inverse=True)
            where = np.full(size, -1)
            where[local] = np.arange(len(local))
            ptr = np.concatenate([[0], np.cumsum(lengths)])
            tree = BallTree(ptr, dims, impact(tf, np.repeat(n, lengths), docs, terms), len(local))
            step = max(1, min(256, QUERY_CELLS // max(1, len(local))))
            for lo in range(0, len(q_terms), step):
                use = (owner >= lo) & (owner < lo + step) & (where[all_terms] >= 0)
                q = np.zeros((len(local), min(step, len(q_terms) - lo)), np.int64)
                q[where[all_terms[use]], owner[use] - lo] = all_values[use]
                found = Search(tree, q)
                for i in range(q.shape[1]):
                    found.run(i, keys, best[lo + i], least[lo + i], top)

        held: list[tuple] = []

        def flush() -> None:
            if held:
                keys = [k for h in held for k in h[0]]
                search(keys, *[np.concatenate([h[j] for h in held]) for j in (1, 2, 3, 4)])
                held.clear()

        rows = entries = 0
        for batch in batches:
            kind_of = batch.schema.field("key").type
            lengths = pa.compute.list_value_length(batch.column("terms")).to_numpy(zero_copy_only=False).astype(np.int64)
            some = np.flatnonzero(lengths)
            keys = batch.column("key").take(pa.array(some)).to_pylist()
            n = batch.column("n").to_numpy()[some]
            dims = pa.compute.list_flatten(batch.column("terms")).to_numpy().astype(np.int64)
            tf = pa.compute.list_flatten(batch.column("tf")).to_numpy()
            ptr = np.concatenate([[0], np.cumsum(lengths[some])])
            at = 0
            while at < len(some):  # trees end at a number of rows or of entries
                end = min(len(some), at + TREE_ROWS - rows)
                end = max(at + 1, min(end, int(np.searchsorted(ptr, ptr[at] + TREE_ENTRIES - entries, "right")) - 1))
                held.append((keys[at:end], n[at:end], dims[ptr[at] : ptr[end]], tf[ptr[at] : ptr[end]], lengths[some][at:end]))
                rows, entries = rows + end - at, entries + int(ptr[end] - ptr[at])
                at = end
                if rows >= TREE_ROWS or entries >= TREE_ENTRIES:
                    flush()
                    rows = entries = 0
        flush()
        out = [(i, None if null else key, -score) for i, b in enumerate(best) for score, null, key in b]
        if out:
            item, key, score = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(item, pa.int32()), pa.array(key, kind_of), pa.array(score, pa.int64())], names=["item", "key", "score"])

    return vecs.select("key", "n", "terms", "tf").mapInArrow(run, f"item int, key {kind}, score bigint")


def _best(found: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("key").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def ranked_search(
    docs: DataFrame, items: DataFrame, *, key: str = "doc_id", text_col: str = "text", item_key: str = "item_id", item_text: str = "text",
    top: int = TOP, max_item_bytes: int = MAX_ITEM_BYTES, sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """(item_key, rank, key, score): the ``top`` best documents of every query."""
    spark = prepare(docs.sparkSession)
    item_kind, doc_kind = items.schema[item_key].dataType, docs.schema[key].dataType.simpleString()
    out = spark.createDataFrame([], f"item string, rank int, key {doc_kind}, score bigint").select(
        F.col("item").cast(item_kind).alias(item_key), "rank", F.col("key").alias(key), "score"
    )
    for block in _blocks(items, item_key, item_text, max_item_bytes):
        words = sorted({w for _, counts in block for w in counts})
        vocabulary = {w: i for i, w in enumerate(words)}
        vecs = _materialise(vectors(docs, vocabulary, key=key, text_col=text_col), "search-vectors")
        n_docs, n_terms = vecs.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
        df = frequencies(vecs, len(words))
        weights = np.array([weight(int(d), n_docs) for d in df], np.int64)
        q_terms = [np.array([vocabulary[w] for w in counts], np.int64) for _, counts in block]
        q_values = [weights[t] * np.array(list(counts.values()), np.int64) for t, (_, counts) in zip(q_terms, block, strict=True)]
        args = (q_terms, q_values, n_docs, n_terms)
        least = [1] * len(block)
        if n_docs > 2 * sample_rows:
            # the top-th best score of a sample is a lower bound of the final one
            sample = vecs.where(unit_hash(F.col("key"), seed=11) < sample_rows / n_docs)
            last = _best(_searched(sample, *args, least, top, len(words)), top).where(F.col("rank") == top)
            for r in last.select("item", "score").collect():  # one row a query
                least[r["item"]] = r["score"]
        found = _materialise(_best(_searched(vecs, *args, least, top, len(words)), top), "search-found")
        names = spark.createDataFrame([(i, None if k is None else str(k)) for i, (k, _) in enumerate(block)], "item int, name string")
        named = found.join(F.broadcast(names), "item")  # one row a query of the block
        out = out.unionByName(named.select(F.col("name").cast(item_kind).alias(item_key), "rank", F.col("key").alias(key), "score"))
    return out


def op11_search(spark, sf_dir) -> DataFrame:
    """The ten best documents of every benchmark item."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return ranked_search(docs, read(spark, sf_dir, "benchmark"))


_TERMS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

ORACLE = f"""
    WITH d AS (SELECT doc_id, row_number() OVER () AS r, {_TERMS} AS w FROM documents),
         b AS (SELECT item_id, row_number() OVER () AS i, {_TERMS} AS w FROM benchmark),
         q AS (SELECT i, item_id, term, count(*) AS qn FROM (SELECT i, item_id, unnest(w) AS term FROM b) GROUP BY ALL),
         tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM d) GROUP BY ALL),
         tot AS (SELECT CAST(count(*) FILTER (WHERE len(w) > 0) AS BIGINT) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_terms FROM d),
         df AS (SELECT term, count(*) AS df FROM tf GROUP BY 1),
         wt AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w FROM df, tot),
         m AS (SELECT r, doc_id, 100 - 75 + (75 * CAST(len(w) AS BIGINT) * n_docs) // n_terms AS m FROM d, tot WHERE len(w) > 0),
         s AS (SELECT i, item_id, r, doc_id, CAST(sum(qn * w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
               FROM q JOIN wt USING (term) JOIN tf USING (term) JOIN m USING (r) GROUP BY ALL)
    SELECT item_id, CAST(k AS INTEGER) AS rank, doc_id, score
    FROM (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id) AS k FROM s WHERE score > 0) WHERE k <= {TOP}"""
