"""Language identification with error-correcting output codes.

Every language gets a binary codeword; each bit has a classifier of its own, a log-linear model over
hashed character 1-, 2- and 3-grams that separates the languages whose codewords have that bit from
the others. A text's bit margins are decoded by loss: the codeword with the least weighted
exponential loss wins, and a near tie is flagged as ambiguous.

Codewords: for up to six languages every split of the languages is a bit (2**(n-1) - 1 of them);
beyond that, random splits of a fixed seed, about 10 * log2(n) of them.

N-gram counts come from at most ``max_per_language`` rows of each language, chosen by hash; the bit
weights (accuracy on the same rows) too. Prediction covers whole texts of all rows and only maps them.

Defined results: null text or text without a letter is ``und`` with score 0 and is not ambiguous;
rows with null text or language teach nothing; with no learned language every text is ``und``;
repeated rows get equal results; ties go to the first language in order.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestrata.llm.common import crc_mod, read, text_map, unit_hash

MAX_PER_LANGUAGE = 2_000
BUCKETS = 1 << 14
AMBIGUOUS = 0.15  # relative gap between the two least losses
_MAYBE_LETTER = re.compile(r"[^\W\d_]")  # letters, but also fractions, superscripts, Roman and circled numerals
_DDL = "lang string, score double, ambiguous boolean, second string"


def has_letter(text: str) -> bool:
    return any(m.group().isalpha() for m in _MAYBE_LETTER.finditer(text))


def gram_buckets(text: str) -> np.ndarray:
    """Buckets of the text's character 1- to 3-grams (letters lowered, runs of others as one space)."""
    c = np.frombuffer(text.lower().encode("utf-32-le"), np.uint32)
    word = (c > 127) | ((c >= 97) & (c <= 122))
    c = np.where(word, c, np.uint32(32))
    keep = np.ones(len(c), bool)
    keep[1:] = word[1:] | word[:-1]
    c = c[keep]
    out = [c * np.uint32(2654435761)]
    if len(c) > 1:
        two = c[:-1] * np.uint32(40503) + c[1:] * np.uint32(2246822519) + np.uint32(7)
        out.append(two * np.uint32(2654435761))
    if len(c) > 2:
        three = c[:-2] * np.uint32(3266489917) + c[1:-1] * np.uint32(668265263) + c[2:] * np.uint32(374761393)
        out.append((three ^ (three >> np.uint32(15))) * np.uint32(2654435761))
    return np.concatenate(out) >> np.uint32(32 - int(math.log2(BUCKETS)))


def codewords(n: int) -> np.ndarray:
    """(n languages) x (bits) of 0/1, no two rows and no two columns (or complements) alike."""
    if n <= 1:
        return np.zeros((n, 1), np.int8)
    if n <= 6:
        bits = [[(b >> i) & 1 for i in range(n - 1)] + [0] for b in range(1, 1 << (n - 1))]
        return np.array(bits, np.int8).T
    rng = np.random.default_rng(20240229)
    size = math.ceil(10 * math.log2(n))
    best, gap = None, -1
    for _ in range(40):
        code = (rng.random((n, size)) < 0.5).astype(np.int8)
        if (code.sum(0) % n == 0).any():
            continue
        d = min(int((code[i] != code[j]).sum()) for i in range(n) for j in range(i))
        if d > gap:
            best, gap = code, d
    return best


@dataclass
class LanguageModel:
    langs: list[str]
    code: np.ndarray  # languages x bits
    weights: np.ndarray  # BUCKETS x bits: log odds of each bit
    scale: np.ndarray  # bits: margin scale
    trust: np.ndarray  # bits: weight in decoding

    def margins(self, text: str) -> np.ndarray:
        grams = gram_buckets(text)
        counts = np.bincount(grams, minlength=BUCKETS).astype(np.float32)
        return (counts @ self.weights) / max(1, len(grams)) * self.scale

    def losses(self, margins: np.ndarray) -> np.ndarray:
        signs = 2.0 * self.code - 1.0
        return (self.trust * np.exp(-np.clip(signs * margins, -8, 8))).sum(1) / self.trust.sum()

    def predict(self, text: str | None) -> tuple[str, float, bool, str | None]:
        if not self.langs or not text or not has_letter(text):
            return "und", 0.0, False, None
        if len(self.langs) == 1:
            return self.langs[0], 1.0, False, None
        loss = self.losses(self.margins(text))
        order = np.argsort(loss, kind="stable")
        a, b = loss[order[0]], loss[order[1]]
        inv = (1.0 / np.maximum(loss, 1e-9)) ** 2
        return (
            self.langs[order[0]],
            float(inv[order[0]] / inv.sum()),
            bool((b - a) < AMBIGUOUS * max(b, 1e-9)),
            self.langs[order[1]],
        )


def _counts(sample: DataFrame) -> dict[str, np.ndarray]:
    """Gram counts of each language: one row per task and language reaches the driver, few tasks."""

    def count(batches):
        total: dict[str, np.ndarray] = {}
        for pdf in batches:
            for lang, text in zip(pdf["lang"], pdf["text"], strict=True):
                total.setdefault(lang, np.zeros(BUCKETS, np.float32))
                total[lang] += np.bincount(gram_buckets(text), minlength=BUCKETS)
        if total:
            yield pd.DataFrame({"lang": list(total), "counts": [v.tobytes() for v in total.values()]})

    sums: dict[str, np.ndarray] = {}
    for r in sample.mapInPandas(count, "lang string, counts binary").collect():
        v = np.frombuffer(r["counts"], np.float32).astype(np.float64)
        sums[r["lang"]] = sums.get(r["lang"], 0) + v
    return sums


def train_languages(
    docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", key: str = "doc_id",
    max_per_language: int = MAX_PER_LANGUAGE,
) -> LanguageModel:
    """Learn from the given rows (hold rows out before calling)."""
    rows = docs.select(
        F.col(f"`{lang_col}`").cast("string").alias("lang"), F.col(f"`{text_col}`").cast("string").alias("text"),
        F.col(f"`{key}`").cast("string").alias("k"),
    ).where("lang is not null")
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}  # one row per language
    if not sizes:
        return LanguageModel([], np.zeros((0, 1)), np.zeros((BUCKETS, 1), np.float32), np.ones(1), np.ones(1))
    share = F.create_map(*[x for lang, n in sorted(sizes.items()) for x in (F.lit(lang), F.lit(min(1.0, max_per_language / n)))])
    sample = (
        rows.where(unit_hash(F.col("k"), F.col("lang"), seed=2) < F.element_at(share, F.col("lang")))
        .where("text is not null")
        .select("lang", "text")
        .repartition(8)
        .persist()
    )
    try:
        counts = _counts(sample)
        langs = sorted(counts)
        if not langs:
            langs, counts = sorted(sizes), {lang: np.zeros(BUCKETS) for lang in sizes}
        code = codewords(len(langs))
        prob = np.array([(counts[x] + 0.5) / (counts[x].sum() + 0.5 * BUCKETS) for x in langs])
        bits = code.shape[1]
        weights = np.zeros((BUCKETS, bits), np.float32)
        for b in range(bits):
            one, zero = code[:, b] == 1, code[:, b] == 0
            if one.any() and zero.any():
                weights[:, b] = np.log(prob[one].mean(0)) - np.log(prob[zero].mean(0))
        model = LanguageModel(langs, code, weights, np.ones(bits), np.ones(bits))
        if len(langs) > 1:
            _calibrate(sample, model)
        return model
    finally:
        sample.unpersist()


def _calibrate(sample: DataFrame, model: LanguageModel) -> None:
    """Margin scale and weight of every bit from the sample: sums over tasks, a few numbers each."""
    bits = model.code.shape[1]

    def measure(batches):
        acc = np.zeros((3, bits))
        n = 0
        for pdf in batches:
            for lang, text in zip(pdf["lang"], pdf["text"], strict=True):
                m = model.margins(text)
                right = (2 * model.code[model.langs.index(lang)] - 1) * m
                acc += np.array([right > 0, right, np.abs(m)])
                n += 1
        yield pd.DataFrame({"n": [n], "acc": [acc.tobytes()]})

    total, n = np.zeros((3, bits)), 0
    for r in sample.mapInPandas(measure, "n long, acc binary").collect():
        total += np.frombuffer(r["acc"]).reshape(3, bits)
        n += r["n"]
    if n:
        accuracy = np.clip(total[0] / n, 0.5, 1 - 1e-3)
        model.scale = 2.0 / np.maximum(total[2] / n, 1e-6)
        model.trust = np.maximum(0.5 * np.log(accuracy / (1 - accuracy)), 1e-3)


def identify_languages(docs: DataFrame, model: LanguageModel, *, text_col: str = "text", out: str = "language") -> DataFrame:
    """``docs`` plus struct ``out``: ``lang``, ``score``, ``ambiguous``, ``second`` (next nearest)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # languages x bits and BUCKETS x bits numbers

    def factory():
        m = shared.value

        def run(texts):
            got = [m.predict(t) for t in texts]
            kinds = (pa.string(), pa.float64(), pa.bool_(), pa.string())
            return pa.StructArray.from_arrays(
                [pa.array([g[i] for g in got], k) for i, k in enumerate(kinds)],
                names=["lang", "score", "ambiguous", "second"],
            )

        return run

    return docs.withColumn(out, text_map(_DDL, factory)(F.col(f"`{text_col}`").cast("string")))


def op2_language(spark, sf_dir) -> DataFrame:
    """Language of every document, learned from the documents that are not held out."""
    docs = read(spark, sf_dir, "documents")
    held = crc_mod(F.col("doc_id"), 4) == 2
    model = train_languages(docs.where(~held))
    found = identify_languages(docs.select("doc_id", "text"), model, out="r")
    return found.select(
        "doc_id", held.alias("held_out"), F.col("r.lang").alias("lang_pred"), "r.score", "r.ambiguous",
        F.col("r.second").alias("lang_second"),
    )
