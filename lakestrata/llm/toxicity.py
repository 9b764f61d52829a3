"""Toxicity by a weighted finite-state pattern grammar.

Words become symbols (insult, threat, target, negation, reporting verb, other). Three transducers
rewrite a clause's symbols: negation turns a following insult into a negated one, reported speech
turns insults and threats after a reporting verb into quoted ones, and the target transducer turns
an insult or threat that meets a second-person target into an aimed one. The three are composed into
one automaton, run over every clause that holds an insult or threat word; the weights of its output
symbols, summed over the document's matched clauses, give the score.

What is learned: insult words and word stems are added to the seed list from labelled rows (those
whose distinct contexts in toxic documents are significantly too many, after correction for the
number tried; contexts and not occurrences are counted, so a passage copied many times counts once),
and the symbol weights are fitted by regularised logistic regression. Both use at most ``max_train``
labelled rows, chosen by hash; scoring covers every row and whole texts and only maps the documents.

Defined results: null or empty text has no clause and gets the base score; rows with a null or
conflicting label are learned as toxic if any label says so, null labels are left out; without
labels the seed words and prior weights hold; repeated rows get equal scores.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestrata.llm.common import crc_mod, doc_columns, fresh, read, text_column, text_map, unit_hash

MAX_TRAIN = 8_000
MAX_CANDIDATES = 20_000
STEMS = (4, 5, 6)
THRESHOLD = 0.7

# Seed words of each symbol (English, German, French, Spanish).
SEEDS = {
    "insult": (
        "idiot moron stupid imbecile scum trash loser worthless pathetic disgusting clown fool dumb bastard "
        "dummkopf trottel abschaum depp wertlos imbécile crétin ordure minable estúpido imbécil basura inútil"
    ),
    "threat": (
        "kill hurt destroy beat stab shoot murder töten umbringen verletzen tuer frapper détruire matar golpear destruir"
    ),
    "target": "you your yourself u du dich dir euch ihr tu toi te vous ton votre tú te ti usted vosotros tu",
    "negation": "not no never nobody isn't don't kein keine nicht nie pas jamais aucun nunca jamás ningún",
    "report": "said says say claimed wrote quoted called asked sagte schrieb dit écrit appelé dijo escribió llamó",
}
SYMBOL = {"insult": "I", "threat": "H", "target": "T", "negation": "N", "report": "R"}
# Output symbols: aimed insult, aimed threat, insult, threat, negated insult, quoted insult or threat.
OUTPUTS = "AKIHiq"
PRIOR = {"bias": -3.0, "A": 4.5, "K": 5.0, "I": 4.0, "H": 0.5, "i": 0.5, "q": 1.0}
CLIP = 3
_WORD = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?")
_CLAUSE = re.compile(r"[.!?;:\n]+")
_DDL = "score double, predicted int, clauses int, patterns string"


class Transducer:
    """A deterministic letter transducer; a missing move keeps the state's default and copies."""

    def __init__(self, start, moves: dict, default: dict):
        self.start, self.moves, self.default = start, moves, default

    def step(self, state, symbol):
        move = self.moves.get((state, symbol))
        return move if move is not None else (self.default.get(state, state), symbol)


def negation_transducer(reach: int = 3) -> Transducer:
    moves = {(s, "N"): (reach, "N") for s in range(reach + 1)}
    moves |= {(s, "I"): (s - 1, "i") for s in range(1, reach + 1)}
    return Transducer(0, moves, {s: max(0, s - 1) for s in range(reach + 1)})


def report_transducer() -> Transducer:
    return Transducer(0, {(0, "R"): (1, "R"), (1, "I"): (1, "q"), (1, "H"): (1, "q")}, {0: 0, 1: 1})


def target_transducer() -> Transducer:
    """State 1: a target was seen; state 2: an insult or threat waits for its target."""
    moves = {
        (0, "T"): (1, "T"), (1, "I"): (1, "A"), (1, "H"): (1, "K"),
        (0, "I"): (2, "I"), (0, "H"): (3, "H"), (2, "T"): (1, "A"), (3, "T"): (1, "K"),
        (2, "H"): (3, "H"), (3, "I"): (2, "I"),
    }
    return Transducer(0, moves, {s: s for s in range(4)})


def compose(parts: list[Transducer]) -> tuple[tuple, dict]:
    """The product automaton over the input symbols: start state and (state, symbol) → (state, output)."""
    start = tuple(p.start for p in parts)
    table, todo, seen = {}, [start], {start}
    while todo:
        state = todo.pop()
        for symbol in "IHTNRO":
            out, nxt = symbol, []
            for part, s in zip(parts, state, strict=True):
                s, out = part.step(s, out)
                nxt.append(s)
            nxt = tuple(nxt)
            table[(state, symbol)] = (nxt, out)
            if nxt not in seen:
                seen.add(nxt)
                todo.append(nxt)
    return start, table


_START, _TABLE = compose([negation_transducer(), report_transducer(), target_transducer()])


@dataclass
class ToxicityModel:
    learned: list[str] = field(default_factory=list)
    weights: dict[str, float] = field(default_factory=lambda: dict(PRIOR))

    def symbols(self) -> dict[str, str]:
        table = {}
        for kind in ("report", "negation", "target", "threat", "insult"):
            table |= dict.fromkeys(SEEDS[kind].split(), SYMBOL[kind])
        return table | {w: "I" for w in self.learned if not w.endswith("*")}

    def stems(self) -> list[str]:
        return [w[:-1] for w in self.learned if w.endswith("*")]


class Grammar:
    def __init__(self, model: ToxicityModel):
        self.symbol = model.symbols()
        self.hot = frozenset(w for w, s in self.symbol.items() if s in "IH")
        self.stems = tuple(model.stems())
        self.stem_heads = frozenset(s[: STEMS[0]] for s in self.stems)
        self.weights = model.weights

    def hit(self, words: list[str]) -> bool:
        if not self.hot.isdisjoint(words):
            return True
        heads = self.stem_heads
        return bool(heads) and not heads.isdisjoint([w[:4] for w in words]) and any(w.startswith(self.stems) for w in words)

    def symbol_of(self, word: str) -> str:
        found = self.symbol.get(word)
        if found is None:
            found = "I" if word[:4] in self.stem_heads and word.startswith(self.stems) else "O"
        return found

    def patterns(self, text: str | None) -> tuple[int, str]:
        """(matched clauses, their output symbols) of one text."""
        lower = (text or "").lower()
        if not self.hit(_WORD.findall(lower)):
            return 0, ""
        clauses, found = 0, []
        for clause in _CLAUSE.split(lower):
            words = _WORD.findall(clause)
            if not self.hit(words):
                continue
            clauses += 1
            state = _START
            for w in words:
                state, out = _TABLE[(state, self.symbol_of(w))]
                if out in OUTPUTS:
                    found.append(out)
        return clauses, "".join(found)

    def score(self, patterns: str) -> float:
        w = self.weights
        z = w["bias"] + sum(w[s] * min(CLIP, patterns.count(s)) for s in OUTPUTS)
        return 1.0 / (1.0 + math.exp(-max(-40.0, min(40.0, z))))


def _learn_words(sample: DataFrame, max_candidates: int = MAX_CANDIDATES) -> list[str]:
    """Insult words and stems (``abcd*``) of the sample (columns ``id``, ``words``, ``toxic``).

    A first pass counts documents of each label for every word and every stem of 4 to 6 letters and
    keeps those that stand mostly in toxic documents; a second counts, for these, the distinct
    neighbourhoods in which they occur (at most three a document count), so text that is merely
    copied along proves nothing. The second pass takes the ``max_candidates`` forms that stand in most toxic documents
    (weighted by their share of them); rarer ones are not learned. The evidence is the Chernoff bound against the base rate.
    """
    units = sample.select("id", "toxic", F.explode(F.array_distinct("words")).alias("w"))
    forms = F.array_distinct(
        F.concat(
            F.array("w"),
            *[
                F.when(F.length("w") > n, F.array(F.concat(F.substring("w", 1, n), F.lit("*")))).otherwise(
                    F.array().cast("array<string>")
                )
                for n in STEMS
            ],
        )
    )
    base = sample.agg(F.avg("toxic")).first()[0]
    if not base or base >= 1:
        return []
    per_form = (
        units.select("id", "toxic", F.explode(forms).alias("form"))
        .distinct()
        .groupBy("form")
        .agg(F.sum("toxic").alias("pos"), F.count("*").alias("n"))
    )
    share = F.col("pos") / F.col("n")
    likely = per_form.where((F.col("pos") >= 3) & (share >= max(0.6, min(0.95, 2 * base))) & (F.length("form") > 2))
    tried = per_form.count()
    likely = [r["form"] for r in likely.orderBy(F.desc(F.col("pos") * share), "form").limit(max_candidates).collect()]
    if not likely:
        return []
    known = F.broadcast(sample.sparkSession.createDataFrame([(f,) for f in likely], "form string"))
    at = F.transform(
        "words",
        lambda w, i: F.struct(
            w.alias("w"),
            F.xxhash64(
                F.coalesce(F.get("words", i - 1), F.lit("")), F.coalesce(F.get("words", i + 1), F.lit(""))
            ).alias("ctx"),
        ),
    )
    near = (
        sample.select("id", "toxic", F.explode(at).alias("o"))
        .select("id", "toxic", "o.ctx", F.col("o.w").alias("w"))
        .select("id", "toxic", "ctx", F.explode(forms).alias("form"))
        .join(known, "form")
        .groupBy("form", "ctx")
        .agg(F.min(F.struct("id", "toxic")).alias("first"))
        .groupBy("form", "first.id", "first.toxic")
        .count()
        .groupBy("form")
        .agg(
            F.sum(F.least(F.lit(3), "count") * F.col("toxic")).alias("pos"),
            F.sum(F.least(F.lit(3), "count")).alias("n"),
            F.sum("toxic").alias("docs"),
        )
        .where("docs >= 3")
        .collect()  # at most max_candidates rows
    )
    need, evidence = math.log(max(tried, 1) / 0.01), {}
    for r in near:
        p = r["pos"] / r["n"]
        if p <= base or p < 0.6:
            continue
        kl = p * math.log(p / base) + ((1 - p) * math.log((1 - p) / (1 - base)) if p < 1 else 0.0)
        if r["n"] * kl >= need:
            evidence[r["form"]] = r["n"] * kl
    return sorted(_most_specific(evidence))


def _most_specific(evidence: dict[str, float]) -> set[str]:
    """Of nested stems the longest that loses nearly no evidence; nothing that it already covers."""
    kept: set[str] = set()
    for form in sorted(evidence, key=lambda f: (len(f), f)):
        stem = form.rstrip("*")
        if any(k.endswith("*") and stem.startswith(k[:-1]) for k in kept):
            continue
        if form.endswith("*"):
            longer = [f for f in evidence if f.startswith(stem) and evidence[f] >= 0.95 * evidence[form]]
            form = max(longer, key=lambda f: (len(f.rstrip("*")), not f.endswith("*")), default=form)
        kept.add(form)
    return kept


def _fit(rows: list[tuple[str, int, int]]) -> dict[str, float]:
    """Newton steps of logistic regression, drawn to the prior weights; rows: (patterns, toxic, count)."""
    names = ["bias", *OUTPUTS]
    prior = np.array([PRIOR[n] for n in names])
    if not rows:
        return dict(PRIOR)
    x = np.array([[1.0, *[min(CLIP, p.count(s)) for s in OUTPUTS]] for p, _, _ in rows])
    y = np.array([float(t) for _, t, _ in rows])
    n = np.array([float(c) for _, _, c in rows])
    w = prior.copy()
    for _ in range(30):
        q = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (n * (y - q)) - (w - prior)
        hess = (x * (n * q * (1 - q))[:, None]).T @ x + np.eye(len(w))
        step = np.clip(np.linalg.solve(hess, grad), -2, 2)
        w = w + step
        if np.abs(step).max() < 1e-6:
            break
    return dict(zip(names, map(float, w), strict=True))


def _pattern_map(model: ToxicityModel, with_score: bool):
    def factory():
        grammar = Grammar(model)

        def run(texts):
            got = [grammar.patterns(t) for t in texts]
            patterns = [p for _, p in got]
            if not with_score:
                return pa.array(patterns, pa.string())
            scores = [grammar.score(p) for p in patterns]
            return pa.StructArray.from_arrays(
                [
                    pa.array(scores, pa.float64()),
                    pa.array([int(s >= THRESHOLD) for s in scores], pa.int32()),
                    pa.array([c for c, _ in got], pa.int32()),
                    pa.array(patterns, pa.string()),
                ],
                names=["score", "predicted", "clauses", "patterns"],
            )

        return run

    return text_map(_DDL if with_score else "string", factory)


def train_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    *,
    key: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    max_train: int = MAX_TRAIN,
    max_candidates: int = MAX_CANDIDATES,
) -> ToxicityModel:
    """Learn from the given labels (hold rows out before calling); at most ``max_train`` labelled rows, of whose
    words at most ``max_candidates`` forms are examined."""
    spark = docs.sparkSession
    marked = (
        labels.select(F.col(f"`{key}`").cast("string").alias("k"), F.col(f"`{label_col}`").cast("int").alias("toxic"))
        .where("k is not null and toxic is not null")
        .groupBy("k")
        .agg(F.max("toxic").alias("toxic"))
    )
    n = marked.count()
    if not n:
        return ToxicityModel()
    chosen = marked.where(unit_hash(F.col("k"), seed=8) < min(1.0, max_train / n))
    sample = (
        docs.select(F.col(f"`{key}`").cast("string").alias("k"), text_column(docs, text_col).alias("text"))
        .join(F.broadcast(chosen), "k")  # about max_train rows of a key and a flag
        .select(F.xxhash64("text").alias("id"), "toxic", "text")
        .repartition(spark.sparkContext.defaultParallelism)
        .persist()
    )
    try:
        words = F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), F.lit(0))
        model = ToxicityModel(_learn_words(sample.select("id", words.alias("words"), "toxic"), max_candidates))
        rows = (
            sample.select(_pattern_map(model, False)(F.col("text")).alias("p"), "toxic")
            .select(*[F.least(F.lit(CLIP), F.length("p") - F.length(F.replace("p", F.lit(s)))).alias(f"n{i}") for i, s in enumerate(OUTPUTS)], "toxic")
            .groupBy(*[f"n{i}" for i in range(len(OUTPUTS))], "toxic")
            .count()
            .collect()  # at most 2 * (CLIP + 1) ** len(OUTPUTS) rows
        )
        model.weights = _fit([("".join(s * r[f"n{i}"] for i, s in enumerate(OUTPUTS)), r["toxic"], r["count"]) for r in rows])
        return model
    finally:
        sample.unpersist()


def score_toxicity(docs: DataFrame, model: ToxicityModel, *, text_col: str = "text", out: str = "toxicity") -> DataFrame:
    """``docs`` plus struct ``out``: ``score``, ``predicted``, ``clauses`` (matched), ``patterns``."""
    return docs.withColumn(out, _pattern_map(model, True)(text_column(docs, text_col)))


def _model(spark, docs, sf_dir) -> ToxicityModel:
    labels = read(spark, sf_dir, "labels").where(crc_mod(F.col("doc_id"), 3) != 1)
    return train_toxicity(docs, labels)


def op8_toxicity(spark, sf_dir) -> DataFrame:
    """Toxicity score of every document, learned from the labelled rows that are not held out."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score_toxicity(docs, _model(spark, docs, sf_dir), out="r")
    return scored.select(
        "doc_id", (crc_mod(F.col("doc_id"), 3) == 1).alias("held_out"), "r.score", "r.predicted", "r.patterns"
    )


def stage(spark, docs, sf_dir) -> DataFrame:
    """Pipeline stage: documents predicted toxic go."""
    out = fresh(docs, "_toxicity")
    scored = score_toxicity(docs, _model(spark, docs, sf_dir), out=out)
    return doc_columns(scored.where(F.col(f"{out}.predicted") == 0), docs)
