"""Katz back-off n-gram model, counted and evaluated over packed, partitioned count tables.

P_j(w | h), h being the j - 1 words before: d_j(r) r / c(h) for an n-gram seen r = c(h, w) > 0 times, else
alpha(h) P_{j-1}(w | h without its first word), and just the latter for a context never seen; P_1 comes from the
word's count, with what its discounts free for one unknown-word event. d_j(r) is the Good-Turing discount of
level j for r <= 5 (absolute discounting where the counts of counts allow none); larger counts give up ``DELTA`` so
that every context keeps mass to back off. alpha(h) = (1 - sum of the seen P_j(w | h)) / (1 - sum of
P_{j-1} over the seen w): every context's distribution over the vocabulary and the unknown word sums to 1. A
text's score sums log10 P over its words and its end; contexts reach back over as many starts as needed.

Evaluation recurses by token: the longest n-gram that is seen gives the probability, and every longer context that
is seen gives its alpha. So the alpha of a context needs only its own n-grams and, as a seen n-gram's ending is seen
too, the counts of these endings: no alpha of a lower level.

How it runs. Documents are dealt to blocks of about ``BLOCK_CHARS`` characters. Each block asks for the
counts of its distinct n-grams of every level: sorted 64-bit hashes, cut into ranges of the hash and packed.
Every hash range is one partition of the count table: it adds up all blocks' training counts, answers
each block in the order asked, and names one block as owner of each entry. Blocks turn the answers
into per-document sums, and into partial statistics of each context from the entries they own; a
second table, partitioned by context, adds these up, computes alpha and returns the sums of log10
alpha for the documents that back off. Discounts are not needed until the end: documents and contexts
carry counts of small r instead. An n-gram is one entry a block however often it occurs, so hot words and copies
make no large group, and every group has a bounded size: equal rows are one row with its number of times
before they are dealt.

Defined results: null counts as empty, whose only token is the end; without training rows every
token is unknown with probability 1 (score 0); equal texts have equal scores; null keys count as the
empty text for the hold-out rule, which the caller applies; repeated rows (key, text and mark) are learned as often
as they occur and all returned; an empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestrata.llm.common import crc_mod, read, text_column
from lakestrata.session import scratch_dir

BLOCK_CHARS = 8_000_000
KEYS_PER_PART = 1_500_000
SMALL_R = 5  # Good-Turing counts
DELTA = 0.05
ORDER = 2  # what fits the disk and memory of the check tool; any order works

_U = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
END, START = _U(0x9D39247E33776D41), _U(0x2AF7398005AAA5C7)


# --- packed arrays: byte planes, compressed ---


def pack(a: np.ndarray) -> bytes:
    planes = np.ascontiguousarray(a, np.uint64).view(np.uint8).reshape(-1, 8).T
    used = [i for i in range(8) if planes[i].any()]
    body = b"".join(planes[i].tobytes() for i in used)
    return bytes([len(used), *used]) + len(a).to_bytes(8, "little") + zstandard.ZstdCompressor(level=1).compress(body)


def unpack(data: bytes) -> np.ndarray:
    k = data[0]
    used, n = data[1 : 1 + k], int.from_bytes(data[1 + k : 9 + k], "little")
    out = np.zeros((8, n), np.uint8)
    if n and k:
        body = np.frombuffer(zstandard.ZstdDecompressor().decompress(data[9 + k :]), np.uint8).reshape(k, n)
        for i, plane in zip(used, body, strict=True):
            out[i] = plane
    return np.ascontiguousarray(out.T).view(np.uint64).reshape(-1)


def pack_sorted(keys: np.ndarray) -> bytes:
    return pack(np.diff(keys, prepend=_U(0)))


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.add.accumulate(unpack(data), dtype=np.uint64)


# --- tokens ---


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _chunk_words(docs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of the documents and the number of words of each."""
    data = b"\n".join(docs)
    b = np.frombuffer(data, np.uint8)
    is_word = ~_SPACE[b]
    if not is_word.any():
        return np.empty(0, np.uint64), np.zeros(len(docs), np.int64)
    edge = np.diff(is_word.astype(np.int8), prepend=0, append=0)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    lengths = ends - starts
    first = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    letters = b[is_word].astype(np.uint64)
    place = np.arange(len(letters)) - np.repeat(first, lengths)
    power = np.full(int(lengths.max()), _U(0x100000001B3))
    power[0] = 1
    power = np.multiply.accumulate(power)
    h = _mix(np.add.reduceat((letters + _U(1)) * power[place], first) + lengths.astype(np.uint64) * _U(0x9E3779B97F4A7C15))
    offsets = np.concatenate([[0], np.cumsum([len(d) + 1 for d in docs])])
    return h, np.diff(np.searchsorted(starts, offsets))


def tokens_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of all texts (each text's words, then its end) and their texts' numbers."""
    hashes, counts, chunk, size = [], [], [], 0
    for text in [*texts, None]:
        if text is not None:
            chunk.append(text.encode("utf-8").lower())  # bytes: only A-Z change
            size += len(chunk[-1])
        if chunk and (text is None or size > 1_000_000):
            h, n = _chunk_words(chunk)
            hashes.append(h)
            counts.append(n)
            chunk, size = [], 0
    if not counts:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    n = np.concatenate(counts)
    doc = np.repeat(np.arange(len(n)), n + 1)
    last = np.cumsum(n + 1) - 1
    w = np.full(len(doc), END)
    inner = np.ones(len(doc), bool)
    inner[last] = False
    w[inner] = np.concatenate(hashes)
    return w, doc


def pair_keys(w: np.ndarray, h: np.ndarray) -> np.ndarray:
    return _mix(h * _U(0x9E3779B97F4A7C15) ^ _mix(w + _U(0x632BE59BD9B4E019)))


def _before(values: np.ndarray, doc: np.ndarray, start) -> np.ndarray:
    """Each token's predecessor's value, ``start`` for the first token of a text."""
    out = np.concatenate([np.array([start], values.dtype), values[:-1]]) if len(values) else values
    out[np.flatnonzero(np.diff(doc, prepend=-1))] = start
    return out


def levels_of(w: np.ndarray, doc: np.ndarray, order: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Hashes of the n-gram that ends at each token, of 1 .. order words, and of its context, of 0 .. order - 1."""
    grams, contexts, start = [w], [np.zeros(len(w), np.uint64)], START
    for _ in range(1, order):
        contexts.append(_before(grams[-1], doc, start))
        grams.append(pair_keys(w, contexts[-1]))
        start = pair_keys(np.array([START]), np.array([start]))[0]
    return grams, contexts


def _cut(keys: np.ndarray, parts: int) -> np.ndarray:
    """Bounds of the hash ranges in sorted keys; ``parts`` is a power of two."""
    if parts == 1:
        return np.array([0, len(keys)])
    shift = _U(64 - int(math.log2(parts)))
    inner = np.searchsorted(keys, np.arange(1, parts, dtype=np.uint64) << shift)
    return np.concatenate([[0], inner, [len(keys)]])


# --- the four steps ---


def _ask(parts: int, order: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        w, doc = tokens_of(list(pdf["text"]))
        train = pdf["train"].to_numpy(bool)[doc]
        rows = []
        for level, keys in enumerate(levels_of(w, doc, order)[0]):
            distinct, at = np.unique(keys, return_inverse=True)
            n = np.bincount(at[train], minlength=len(distinct))
            bounds = _cut(distinct, parts)
            for p in range(parts):
                a, b = bounds[p], bounds[p + 1]
                if b > a:
                    rows.append((level * parts + p, int(pdf["block"].iloc[0]), pack_sorted(distinct[a:b]), pack(n[a:b])))
        return pd.DataFrame(rows, columns=["part", "block", "keys", "n"])

    return run


def _answer(pdf: pd.DataFrame) -> pd.DataFrame:
    """Total counts in the order asked; the first block that asks for an entry owns it."""
    pdf = pdf.sort_values("block")
    asked = [unpack_sorted(x) for x in pdf["keys"]]
    sizes = [len(x) for x in asked]
    distinct, first, at = np.unique(np.concatenate(asked), return_index=True, return_inverse=True)
    total = np.bincount(at, weights=np.concatenate([unpack(x) for x in pdf["n"]]).astype(np.float64), minlength=len(distinct))
    total = total.astype(np.uint64)[at]
    own = np.zeros(len(at), bool)
    own[first] = True
    cuts = np.cumsum(sizes)[:-1]
    return pd.DataFrame(
        {
            "block": pdf["block"].to_numpy(),
            "part": pdf["part"].to_numpy(),
            "total": [pack(x) for x in np.split(total, cuts)],
            "own": [np.packbits(x).tobytes() for x in np.split(own, cuts)],
        }
    )


def _small_counts(r: np.ndarray, group: np.ndarray, n: int, upto: int = SMALL_R) -> np.ndarray:
    """(n x upto) how many of each group have r = 1 .. upto."""
    use = (r >= 1) & (r <= upto)
    flat = np.bincount(group[use] * upto + (r[use].astype(np.int64) - 1), minlength=n * upto)
    return flat.reshape(n, upto)


_STEP = (
    "kind string, block long, idx int, key {key}, train boolean, n_tokens long, n_known long, base double, fixed double, "
    "small array<long>, n_back long, n_unknown long, part int, keys binary, stats binary, asks binary, docs binary, times binary"
)
# a context's statistics: counts of r = 1 .. SMALL_R, number and sum of larger r, for its n-grams and for their endings, and the
# sum over its n-grams of the endings' context count
WIDTH = 2 * (SMALL_R + 2) + 1


def _evaluate(parts: int, ctx_parts: int, order: int):
    columns = [c.strip().split(" ")[0] for c in _STEP.split(", ")]

    def run(pdf: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        if pdf.empty:
            return _filled(pd.DataFrame({"kind": []}), columns)
        block, n_docs = int(pdf["block"].iloc[0]), len(pdf)
        w, doc = tokens_of(list(pdf["text"]))
        grams, contexts = levels_of(w, doc, order)
        answers = answers.sort_values("part")
        count, in_context, first, own = [], [], [], []  # by level
        for level, keys in enumerate(grams):
            rows = answers[(answers["part"] >= level * parts) & (answers["part"] < (level + 1) * parts)]
            totals = [unpack(x) for x in rows["total"]]
            owns = [np.unpackbits(np.frombuffer(o, np.uint8), count=len(t)).astype(bool) for o, t in zip(rows["own"], totals, strict=True)]
            _, at_first, at = np.unique(keys, return_index=True, return_inverse=True)
            total = np.concatenate(totals).astype(np.int64)
            count.append(total[at])
            first.append(at_first)
            own.append(np.where(np.concatenate(owns), total, 0))
            if level == 0:
                ends = int(count[0][w == END][0])
                in_context.append(np.zeros(len(w), np.int64))  # of level 1: all training tokens, known later
            else:  # a context occurs as often as the n-gram it is, a run of starts as often as the end
                in_context.append(_before(count[level - 1], doc, ends))
        known = count[0] > 0
        found = np.sum([c > 0 for c in count], axis=0)  # words of the longest seen n-gram

        def per_doc(values, use):
            return np.bincount(doc[use], weights=values[use], minlength=n_docs)

        def log(x):
            return np.log10(np.maximum(x, 1e-300))

        one, fixed, small = np.ones(len(w)), np.zeros(n_docs), []
        for level in range(order):
            c, here = count[level], found == level + 1
            fixed += per_doc(log(c - DELTA), here & (c > SMALL_R))
            if level:
                fixed -= per_doc(log(in_context[level]), here)
            small.append(_small_counts(np.where(here, c, 0), doc, n_docs))
        out = {
            "kind": ["doc"] * n_docs, "block": block, "idx": np.arange(n_docs), "key": list(pdf["key"]), "train": list(pdf["train"]),
            "n_tokens": np.bincount(doc, minlength=n_docs), "n_known": per_doc(one, known).astype(np.int64),
            "base": per_doc(np.log10(count[0] + 0.1), np.ones(len(w), bool)), "fixed": fixed, "small": list(np.concatenate(small, axis=1)),
            "n_back": per_doc(one, found == 1).astype(np.int64), "n_unknown": per_doc(one, ~known).astype(np.int64),
        }
        docs = pd.DataFrame(out)
        # totals of the entries this block owns: counts of counts, number and sum, level by level
        sums = []
        for x in own:
            sums += [*_small_counts(x, np.zeros(len(x), np.int64), 1, SMALL_R + 1)[0], int((x > 0).sum()), int(x.sum())]
        rows = []
        for level in range(1, order):
            rows += _context_rows(level, block, n_docs, doc, contexts, count, in_context, first[level][own[level] > 0], ctx_parts)
        total = pd.DataFrame([{"kind": "sum", "block": block, "small": sums}])
        return pd.concat([_filled(x, columns) for x in (docs, total, pd.DataFrame(rows))], ignore_index=True)

    return run


def _context_rows(level: int, block: int, n_docs: int, doc, contexts, count, in_context, mine, ctx_parts: int) -> list[dict]:
    """Statistics of a level's contexts from the n-grams at the tokens ``mine``, and which documents back off in which."""
    asks = (count[level] == 0) & (in_context[level] > 0)
    ctx, at_c = np.unique(np.concatenate([contexts[level][mine], contexts[level][asks]]), return_inverse=True)
    at_m, at_a = at_c[: len(mine)], at_c[len(mine) :]
    stats = np.zeros((len(ctx), WIDTH), np.int64)
    for j, r in enumerate((count[level][mine], count[level - 1][mine])):
        o = j * (SMALL_R + 2)
        stats[:, o : o + SMALL_R] = _small_counts(r, at_m, len(ctx))
        large = r > SMALL_R
        stats[:, o + SMALL_R] = np.bincount(at_m[large], minlength=len(ctx))
        stats[:, o + SMALL_R + 1] = np.bincount(at_m[large], weights=r[large], minlength=len(ctx))
    stats[:, -1] = np.bincount(at_m, weights=in_context[level - 1][mine], minlength=len(ctx))
    who, times = np.unique(at_a * n_docs + doc[asks], return_counts=True)
    n_asks = np.bincount(who // n_docs, minlength=len(ctx))
    who = who % n_docs
    upto = np.concatenate([[0], np.cumsum(n_asks)])
    bounds = _cut(ctx, ctx_parts)
    rows = []
    for p in range(ctx_parts):
        a, b = bounds[p], bounds[p + 1]
        if b > a:
            s, e = upto[a], upto[b]
            rows.append(
                {
                    "kind": "ctx", "block": block, "part": (level - 1) * ctx_parts + p, "keys": pack_sorted(ctx[a:b]),
                    "stats": pack(stats[a:b].T.reshape(-1)), "asks": pack(n_asks[a:b]), "docs": pack(who[s:e]), "times": pack(times[s:e]),
                }
            )
    return rows


def _filled(rows: pd.DataFrame, columns: list[str]) -> pd.DataFrame:
    """All columns of the step's rows; empty values where a kind of row has none."""
    rows = rows.copy()
    for c in columns:
        if c not in rows:
            empty = {"small": [], "keys": b"", "stats": b"", "asks": b"", "docs": b"", "times": b"", "key": None, "train": None}
            value = empty.get(c, 0.0 if c in ("base", "fixed") else 0)
            rows[c] = pd.Series([value] * len(rows), index=rows.index, dtype=object if c in empty else None)
    return rows[columns]


def _back_off(d: list[list[float]], total: float, ctx_parts: int):
    """Sums of log10 alpha for every document that backs off in a context of this partition."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        level = int(pdf["part"].iloc[0]) // ctx_parts + 1
        asked = [unpack_sorted(x) for x in pdf["keys"]]
        ctx, at = np.unique(np.concatenate(asked), return_inverse=True)
        stats = np.zeros((len(ctx), WIDTH))
        cuts = np.concatenate([[0], np.cumsum([len(x) for x in asked])])
        for i, x in enumerate(pdf["stats"]):
            np.add.at(stats, at[cuts[i] : cuts[i + 1]], unpack(x).astype(np.float64).reshape(WIDTH, -1).T)
        left = log_alpha(stats, d[level - 1], d[level], total if level == 1 else None)
        out = []
        for i, (block, n, docs, times) in enumerate(zip(pdf["block"], pdf["asks"], pdf["docs"], pdf["times"], strict=True)):
            who = unpack(docs).astype(np.int64)
            if not len(who):
                continue
            value = np.repeat(left[at[cuts[i] : cuts[i + 1]]], unpack(n).astype(np.int64)) * unpack(times).astype(np.float64)
            ids, place = np.unique(who, return_inverse=True)
            out.append(pd.DataFrame({"block": block, "idx": ids, "alpha": np.bincount(place, weights=value)}))
        return pd.concat(out) if out else pd.DataFrame({"block": [], "idx": [], "alpha": []})

    return run


def log_alpha(stats: np.ndarray, lower: list[float], own: list[float], total: float | None) -> np.ndarray:
    """log10 of the back-off weight from a context's statistics; ``lower`` and ``own`` are the discounts of the endings' level
    and of the context's, ``total`` the endings' context count if it is the same for all contexts."""
    r = np.arange(1, SMALL_R + 1)
    gram, ending = stats[:, : SMALL_R + 2], stats[:, SMALL_R + 2 : 2 * (SMALL_R + 2)]
    count = gram[:, :SMALL_R] @ r + gram[:, SMALL_R + 1]
    number = np.maximum(gram[:, :SMALL_R].sum(1) + gram[:, SMALL_R], 1)
    freed = gram[:, :SMALL_R] @ (r * (1 - np.array(own))) + DELTA * gram[:, SMALL_R]
    kept = ending[:, :SMALL_R] @ (r * np.array(lower)) + ending[:, SMALL_R + 1] - DELTA * ending[:, SMALL_R]
    over = stats[:, -1] / number if total is None else total  # the endings of one context share theirs
    return np.log10(np.maximum(freed, 1e-300) / np.maximum(count, 1)) - np.log10(np.maximum(1 - kept / np.maximum(over, 1), 1e-300))


def discounts(n: list[int]) -> list[float]:
    """Katz's Good-Turing discounts of r = 1 .. SMALL_R from counts of counts n[0] = n_1 ...; absolute
    discounting where these give no discount strictly between 0 and 1 for every r."""
    k = SMALL_R
    if all(x > 0 for x in n[: k + 1]):
        a = (k + 1) * n[k] / n[0]
        if a < 1:
            d = [(((r + 1) * n[r] / n[r - 1]) / r - a) / (1 - a) for r in range(1, k + 1)]
            if all(0 < x < 1 for x in d):
                return d
    n1, n2 = (n[0], n[1]) if len(n) > 1 else (0, 0)
    b = min(max(n1 / (n1 + 2 * n2), 0.1), 0.9) if n1 else 0.5
    return [(r - b) / r for r in range(1, k + 1)]


def katz_scores(
    docs: DataFrame, *, key: str = "doc_id", text_col: str = "text", train_col: str = "train", order: int = ORDER
) -> DataFrame:
    """Per document: ``key``, ``train``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` (add-0.1
    unigrams) and ``score`` (Katz, n-grams of ``order`` words), learned from the rows whose ``train_col`` is true."""
    if order < 1:
        raise ValueError("the order is at least 1")
    spark = docs.sparkSession
    rows = docs.select(
        F.col(f"`{key}`").alias("key"), text_column(docs, text_col).alias("text"), F.col(train_col).alias("train")
    )
    chars = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(chars / BLOCK_CHARS))
    parts = 1 << max(0, math.ceil(math.log2(max(1, chars / 6 / KEYS_PER_PART))))
    ctx_parts = max(1, parts // 2)
    placed = rows.withColumn("block", F.pmod(F.xxhash64("key", "text", F.spark_partition_id()), F.lit(blocks))).repartition(blocks, "block")
    asked = placed.groupBy("block").applyInPandas(_ask(parts, order), "part int, block long, keys binary, n binary")
    answers = asked.repartition(order * parts, "part").groupBy("part").applyInPandas(_answer, "block long, part int, total binary, own binary")
    kind = docs.schema[key].dataType.simpleString()
    stepped = (
        placed.groupBy("block")
        .cogroup(answers.repartition(blocks, "block").groupBy("block"))
        .applyInPandas(_evaluate(parts, ctx_parts, order), _STEP.format(key=kind))
    )
    path = scratch_dir(spark, "katz")
    stepped.write.partitionBy("kind").parquet(path)
    schema = stepped.schema
    table = spark.read.schema(schema).parquet(path)
    width = SMALL_R + 3
    sums = table.where("kind = 'sum'").agg(*[F.sum(F.get("small", F.lit(i))) for i in range(order * width)]).first()
    sums = [[int(x or 0) for x in sums[level * width : (level + 1) * width]] for level in range(order)]
    v, n = sums[0][SMALL_R + 1], sums[0][SMALL_R + 2]
    d = [discounts(x[: SMALL_R + 1]) for x in sums]
    seen_mass = sum((i + 1) * d[0][i] * sums[0][i] for i in range(SMALL_R))
    large = n - sum((i + 1) * sums[0][i] for i in range(SMALL_R))
    seen_mass += large - DELTA * (v - sum(sums[0][:SMALL_R]))
    unknown = math.log10(max(1 - seen_mass / n, 1e-300)) if n else 0.0
    logs = [F.get("small", F.lit(level * SMALL_R + i)) * math.log10(d[level][i] * (i + 1)) for level in range(order) for i in range(SMALL_R)]
    doc = table.where("kind = 'doc'").select(
        "block", "idx", "key", "train", "n_tokens", "n_known",
        (F.col("base") - F.col("n_tokens") * math.log10(n + 0.1 * (v + 1))).alias("base_score"),
        (F.col("fixed") + sum(logs, F.lit(0.0)) - F.col("n_back") * math.log10(max(n, 1)) + F.col("n_unknown") * unknown).alias("s"),
    )
    ctx = table.where("kind = 'ctx'").select("part", "block", "keys", "stats", "asks", "docs", "times")
    alpha = (
        ctx.repartition(max(1, order - 1) * ctx_parts, "part")
        .groupBy("part")
        .applyInPandas(_back_off(d, max(n, 1), ctx_parts), "block long, idx int, alpha double")
        .groupBy("block", "idx")
        .agg(F.sum("alpha").alias("alpha"))
    )
    return doc.join(alpha, ["block", "idx"], "left").select(
        F.col("key").alias(key), "train", "n_tokens", "n_known", F.lit(n).cast("bigint").alias("train_tokens"), "base_score",
        (F.col("s") + F.coalesce("alpha", F.lit(0.0))).alias("score"),
    )


def op4_katz(spark, sf_dir) -> DataFrame:
    """Katz score of every document, learned from those that are not held out."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    held = crc_mod(F.col("doc_id"), 10) == 0
    scored = katz_scores(docs.withColumn("train", ~held))
    return scored.select(
        "doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )
