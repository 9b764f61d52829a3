"""Personal data by patterns and a skip-chain conditional random field.

Base spans are found by fixed patterns for e-mail addresses, IP addresses, card numbers and phone
numbers. A skip-chain CRF then labels the document's candidate tokens (white-space tokens with an
ASCII digit or ``@``): unary potentials from token shape, length and checks, chain potentials
between neighbouring candidates, and skip potentials between each candidate and the previous one
with the same digits or name, or of the same shape, however far apart. Tokens inside base spans are
clamped to their kind; loopy sum-product message passing over the whole document carries their
evidence along chain and skip edges, so that the same entity gets the same label throughout. Free
tokens whose posterior of a kind is at least ``min_posterior`` give the added spans. Every token has
at most one skip edge of each sort back, so the graph is linear in the document.

The potentials are counted from at most ``max_train`` documents chosen by hash, labelled by the base
spans. All edge potentials and the ``max_features`` most frequent (feature, label) counts a label come back to the
driver; a rarer feature has no potential of its own, so a token that has only such is labelled by the others. Search and labelling cover all rows and whole texts and only map the documents; the graphs of
one Arrow batch are solved together.

Defined results: null counts as empty text, which has no spans; equal texts have equal spans; with
nothing to learn from no span is added; an added span never overlaps a base span or another added
one; long runs without white space are one token; tokens with equal posteriors keep the first kind as listed;
repeated rows count and are labelled each; columns beside the text are left alone whatever their names, but one called
``out``, which is replaced.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestrata.llm.common import read, text_column, text_map, unit_hash

KINDS = ("email", "ip", "card", "phone")
MAX_TRAIN = 10_000
MIN_POSTERIOR = 0.9
ROUNDS = 8
DAMPING = 0.3
MAX_FEATURES = 4_096

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
# A match always starts at the start of a digit run, which keeps the search linear.
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_HINT = re.compile(r"[0-9@]")
_SPACE = re.compile(r"\s")
_DDL = "n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, spans array<struct<kind:string,start:bigint,end:bigint,base:boolean>>"


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind number, start, end) of the base patterns, by kind and start."""
    out = []
    at, done = text.find("@"), 0
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((0, start, m.end()))
            done = m.end()
        at = text.find("@", max(at + 1, done))
    if _HINT.search(text):
        for m in _IP.finditer(text):
            if all(len(g.lstrip("0")) <= 3 and int(g.lstrip("0")[:4] or "0") <= 255 for g in m.groups()):
                out.append((1, m.start(), m.end()))
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 16:
                d = _digits(m.group())
                if 16 <= len(d) <= 19 and luhn(d):
                    out.append((2, m.start(), m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 8 <= len(_digits(m.group())) <= 15:
                    out.append((3, m.start(), m.end()))
    return out


@dataclass
class Token:
    start: int
    end: int
    label: int  # 0 none, 1.. kind, as the base spans say
    features: list[str]
    same: str | None  # key of equal tokens
    like: str  # key of similar tokens
    glued: bool  # follows the previous candidate over white space only


def _shape(text: str) -> str:
    out, last = [], ""
    for c in text[:64]:
        k = "9" if "0" <= c <= "9" else "a" if c.isalpha() and c.islower() else "A" if c.isalpha() else c
        if k != last:
            out.append(k)
            last = k
    return "".join(out)[:12]


def tokens_of(text: str, base: list[tuple[int, int, int]]) -> list[Token]:
    """Candidate tokens in order, with the label of the base span they overlap."""
    out: list[Token] = []
    spans = sorted((s, e, k) for k, s, e in base)
    i, pos, n = 0, 0, len(text)
    reach: list[tuple[int, int, int]] = []
    m = _HINT.search(text)
    while m:
        hit = m.start()
        start = hit
        while start > pos and not text[start - 1].isspace():
            start -= 1
        sp = _SPACE.search(text, hit)
        end = sp.start() if sp else n
        word = text[start:end]
        while i < len(spans) and spans[i][0] < end:
            reach.append(spans[i])
            i += 1
        reach = [x for x in reach if x[1] > start]
        label = min((k + 1 for s, e, k in reach if s < end), default=0)
        digits = _digits(word)
        shape = _shape(word.strip(".,;:!?\"'"))
        feats = [f"s:{shape}", f"d:{min(len(digits), 20)}", f"n:{min(word.count('.'), 4)}", f"f:{word[0] if word[0] in '+(' else ''}"]
        if "@" in word:
            feats.append("at")
        if 13 <= len(digits) <= 19:
            feats.append(f"luhn:{luhn(digits)}")
        local = word.split("@", 1)[0].strip("<>(\"'").lower() if "@" in word else ""
        same = digits if len(digits) >= 5 else local or None
        glued = bool(out) and not text[out[-1].end : start].strip()
        out.append(Token(start, end, label, feats, same, shape, glued))
        pos = end
        m = _HINT.search(text, end)
    return out


def edges_of(tokens: list[Token]) -> list[tuple[int, int, int]]:
    """(earlier, later, sort): 0 chain, 1 same token, 2 similar token."""
    out, same, like = [], {}, {}
    for i, t in enumerate(tokens):
        if t.glued:
            out.append((i - 1, i, 0))
        if t.same is not None and t.same in same:
            out.append((same[t.same], i, 1))
        elif len(t.like) > 1 and t.like in like:
            out.append((like[t.like], i, 2))
        if t.same is not None:
            same[t.same] = i
        like[t.like] = i
    return out


L = len(KINDS) + 1


@dataclass
class CrfModel:
    unary: dict[str, np.ndarray] = field(default_factory=dict)
    prior: np.ndarray = field(default_factory=lambda: np.zeros(L))
    pair: np.ndarray = field(default_factory=lambda: np.zeros((3, L, L)))

    def potentials(self, tokens: list[Token]) -> np.ndarray:
        out = np.tile(self.prior, (len(tokens), 1))
        for i, t in enumerate(tokens):
            for f in t.features:
                v = self.unary.get(f)
                if v is not None:
                    out[i] += v
        return out


def message_passing(unary: np.ndarray, edges: np.ndarray, pair: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Posteriors by damped loopy sum-product; ``edges``: rows (a, b, sort)."""
    if not len(edges):
        p = np.exp(unary - unary.max(1, keepdims=True))
        return p / p.sum(1, keepdims=True)
    a = np.concatenate([edges[:, 0], edges[:, 1]])
    b = np.concatenate([edges[:, 1], edges[:, 0]])
    psi = np.exp(np.concatenate([pair[edges[:, 2]], pair[edges[:, 2]].transpose(0, 2, 1)]))
    m = len(edges)
    back = np.concatenate([np.arange(m, 2 * m), np.arange(m)])
    msg = np.zeros((2 * m, unary.shape[1]))  # log messages a -> b
    for _ in range(rounds):
        belief = unary.copy()
        np.add.at(belief, b, msg)
        out = belief[a] - msg[back]
        out = np.exp(out - out.max(1, keepdims=True))
        new = np.log(np.maximum(np.einsum("el,elk->ek", out, psi), 1e-30))
        new -= new.max(1, keepdims=True)
        msg = DAMPING * msg + (1 - DAMPING) * new
    belief = unary.copy()
    np.add.at(belief, b, msg)
    p = np.exp(belief - belief.max(1, keepdims=True))
    return p / p.sum(1, keepdims=True)


def _counted(texts: list[str]) -> dict[tuple[str, str, int, int], int]:
    """Counts of (feature, label) and (edge sort, label, label) in texts labelled by base spans."""
    n: dict[tuple[str, str, int, int], int] = {}
    for text in texts:
        toks = tokens_of(text, base_spans(text))
        for t in toks:
            for f in ["", *t.features]:
                key = ("f", f, t.label, 0)
                n[key] = n.get(key, 0) + 1
        for i, j, sort in edges_of(toks):
            key = ("e", str(sort), toks[i].label, toks[j].label)
            n[key] = n.get(key, 0) + 1
    return n


def train_pii(docs: DataFrame, *, text_col: str = "text", max_train: int = MAX_TRAIN, max_features: int = MAX_FEATURES) -> CrfModel:
    """Potentials as smoothed log ratios of counts over a bounded sample of the documents."""
    total = docs.count()
    if not total:
        return CrfModel()
    text = text_column(docs, text_col)
    sample = docs.select(text.alias("text")).where(unit_hash(text, seed=1) < min(1.0, max_train / total))

    def count(batches):
        for pdf in batches:
            n = _counted([t for t in pdf["text"] if _HINT.search(t)])
            if n:
                rows = [(*k, v) for k, v in n.items()]
                yield pd.DataFrame(rows, columns=["sort", "name", "a", "b", "n"])

    sums = (
        sample.mapInPandas(count, "sort string, name string, a int, b int, n long")
        .groupBy("sort", "name", "a", "b")
        .agg(F.sum("n").alias("n"))
    )
    # all edge counts, at most 3 * L * L rows, whatever the number of features
    features = sums.where("sort = 'f'").orderBy(F.desc("n"), "name", "a", "b").limit(max_features * L)
    rows = features.union(sums.where("sort <> 'f'")).collect()
    return fit_potentials([tuple(r) for r in rows])


def fit_potentials(rows: list[tuple[str, str, int, int, int]]) -> CrfModel:
    by_feature: dict[str, np.ndarray] = {}
    pairs = np.zeros((3, L, L))
    for sort, name, a, b, n in rows:
        if sort == "f":
            by_feature.setdefault(name, np.zeros(L))[a] += n
        else:
            pairs[int(name), a, b] += n
    if "" not in by_feature:
        return CrfModel()
    classes = by_feature.pop("") + 0.5
    model = CrfModel(prior=np.log(classes / classes.sum()))
    for name, n in by_feature.items():
        ratio = (n + 0.1) / (classes + 0.1 * L)
        model.unary[name] = np.clip(np.log(ratio / ratio.mean()), -4, 4) * 0.7
    for s in range(3):
        joint = pairs[s] + pairs[s].T if s else pairs[s]
        if joint.sum():
            p = (joint + 0.5) / (joint + 0.5).sum()
            model.pair[s] = np.clip(np.log(p / np.outer(p.sum(1), p.sum(0))), -3, 3)
    return model


def label_texts(texts: list[str], model: CrfModel, min_posterior: float = MIN_POSTERIOR) -> list[list[tuple[int, int, int, bool]]]:
    """All spans (kind, start, end, base) of each text, by kind and start; one graph for all texts."""
    base = [base_spans(t) if t else [] for t in texts]
    tokens = [tokens_of(t, b) if t and _HINT.search(t) else [] for t, b in zip(texts, base, strict=True)]
    out = [[(k, s, e, True) for k, s, e in b] for b in base]
    busy = [i for i, toks in enumerate(tokens) if any(t.label == 0 for t in toks)]
    if busy and model.unary:
        unary, edges, offset = [], [], 0
        for i in busy:
            u = model.potentials(tokens[i])
            for row, t in zip(u, tokens[i], strict=True):
                if t.label:
                    row[:] = -30.0
                    row[t.label] = 30.0
            unary.append(u)
            edges += [(a + offset, b + offset, s) for a, b, s in edges_of(tokens[i])]
            offset += len(u)
        post = message_passing(np.concatenate(unary), np.array(edges, np.int64).reshape(-1, 3), model.pair)
        offset = 0
        for i in busy:
            p = post[offset : offset + len(tokens[i])]
            offset += len(tokens[i])
            out[i] += _added(texts[i], tokens[i], p, base[i], min_posterior)
    return [sorted(x) for x in out]


def _added(text: str, tokens: list[Token], post: np.ndarray, base: list, min_posterior: float) -> list:
    """Runs of neighbouring free tokens with one sure kind, punctuation at their ends left out; a
    token that is an entity of its kind by itself is a run of its own."""
    found, run = [], None
    best = post.argmax(1)
    for i, t in enumerate(tokens):
        kind = int(best[i]) if not t.label and post[i, best[i]] >= min_posterior else 0
        alone = kind and any(k == kind - 1 for k, _, _ in base_spans(text[t.start : t.end]))
        if alone:
            if run:
                found.append(run)
            found.append([kind, t.start, t.end, i])
            run = None
            continue
        if kind and run and run[0] == kind and t.glued and run[3] == i - 1:
            run[2], run[3] = t.end, i
            continue
        if run:
            found.append(run)
        run = [kind, t.start, t.end, i] if kind else None
    if run:
        found.append(run)
    taken = [(s, e) for _, s, e in base]
    out = []
    for kind, start, end, _ in found:
        while start < end and not (text[start].isalnum() or text[start] in "+("):
            start += 1
        while start < end and not text[end - 1].isalnum():
            end -= 1
        if start < end and not any(s < end and start < e for s, e in taken):
            out.append((kind - 1, start, end, False))
    return out


def find_pii(docs: DataFrame, model: CrfModel, *, text_col: str = "text", min_posterior: float = MIN_POSTERIOR, out: str = "pii") -> DataFrame:
    """``docs`` plus struct ``out``: counts of base spans and ``spans`` (kind, start, end in code
    points with the end exclusive, base) by kind and start."""
    span_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))

    def factory():
        def run(texts):
            spans = label_texts(texts, model, min_posterior)
            counts = [[sum(1 for x in s if x[0] == k and x[3]) for s in spans] for k in range(len(KINDS))]
            listed = [[{"kind": KINDS[k], "start": s, "end": e, "base": b} for k, s, e, b in x] for x in spans]
            return pa.StructArray.from_arrays(
                [*[pa.array(c, pa.int64()) for c in counts], pa.array(listed, span_type)],
                names=[*[f"n_{k}" for k in KINDS], "spans"],
            )

        return run

    return docs.withColumn(out, text_map(_DDL, factory)(text_column(docs, text_col)))


def span_list(spans, only_base: bool = False):
    """``kind:start:end`` of the spans, comma-joined, in their order."""
    chosen = F.filter(spans, lambda x: x["base"]) if only_base else spans
    return F.concat_ws(",", F.transform(chosen, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))))


def op1_pii(spark, sf_dir) -> DataFrame:
    """Personal data in every document."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_pii(docs, train_pii(docs), out="r")
    return found.select(
        "doc_id", "r.n_email", "r.n_ip", "r.n_card", "r.n_phone",
        F.sha2(span_list(F.col("r.spans"), True), 256).alias("base_sha256"),
        span_list(F.col("r.spans")).alias("spans"),
    )
