"""Secret scanning with a random forest that removes false positives; DataFrame and SQL only.

Candidates are runs of at least 12 key characters with a digit, and the values assigned to names
such as password or token. The forest judges each from its length, its character transitions and
classes, the share that a dictionary of corpus words covers, signs of a path or address around it,
and the words next to it. It is trained with Spark ML on labelled findings and then written out as one
SQL expression, so scoring happens inside the scan: nothing is exploded, shuffled or joined.

Labelled findings: ``labelled_findings`` marks the candidates of all documents, one finding for each
value, and the dictionary is counted over all documents. Positive: a random-looking value assigned to a secret's name, or a provider's key format.
Negative: numbers only, values found in several different sources' documents, words with a digit,
paths and addresses, placeholders. Others teach nothing. ``train_forest`` takes any findings table
with these columns, so findings labelled by people can be used instead.

Every match is a candidate with its own place and is judged by the text around that place. A value
found to be a secret at one of its places is a secret everywhere in that text: all its places, which are
those that redaction replaces, are listed, with the best of its scores.

Defined results: null counts as empty, which has no candidates; a place that both patterns find with
the same value is one candidate; without findings of both labels the labelling rules decide;
repeated rows get equal results; an empty table gives no rows.
"""

from __future__ import annotations

import re

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestrata.llm.common import doc_columns, fresh, read, text_column
from lakestrata.llm.syncmers import let

DICTIONARY = 400
THRESHOLD = 0.5
TREES, DEPTH = 12, 5
BEFORE, AFTER = 48, 16
SHORTEST = 10  # code points that every match has at least
BLOCK = 256

_RUN = r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*+[0-9])[A-Za-z0-9+/_-]{12,}+={0,2}"
_NAMED = (
    r"(?i:passw(?:or)?d|pwd|secret|token|api[_-]?key|access[_-]?key|private[_-]?key|credential)s?"
    r"[\"']?\s{0,3}[=:]\s{0,3}[\"']?([^\s\"'<>]{6,})"
)
# Formats of well-known providers' keys.
_PROVIDER = (
    r"^(AKIA|ASIA)[A-Z0-9]{16}$|^gh[pousr]_[A-Za-z0-9]{36,}$|^sk_(live|test)_[A-Za-z0-9]{16,}$"
    r"|^xox[abpr]-[A-Za-z0-9-]{10,}$|^AIza[A-Za-z0-9_-]{35}$|^eyJ[A-Za-z0-9_-]{16,}$|^glpat-[A-Za-z0-9_-]{20}$"
)
_NAME_NEAR = r"(?i)(passw(or)?d|pwd|secret|token|api[_-]?key|access[_-]?key|private[_-]?key|credential)s?[\"']?\s*[=:]\s*[\"']?$"
_KEY_WORDS = r"(?i)\b(password|passwd|pwd|secret|token|key|auth|bearer|credential|login|access)\b"
_PLACEHOLDER = r"(?i)(example|sample|dummy|changeme|placeholder|your[_-]|xxxx|0000000|1234567)"

FEATURES = [
    "length", "transitions", "digit_share", "upper_share", "hex_only", "digits_only", "distinct_share", "longest_run",
    "dictionary", "slashes", "path_near", "assigned", "quoted", "key_word_near", "placeholder",
]


def candidates(text: Column) -> Column:
    """Distinct candidate values of a text (array<string>)."""
    return F.array_distinct(F.transform(found_candidates(text), lambda c: c["value"]))


def _removed(text: Column, pattern: str) -> Column:
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def features(value: Column, before: Column, after: Column, dictionary: list[str]) -> dict[str, Column]:
    """The forest's features of one candidate as doubles."""
    n = F.greatest(F.length(value), F.lit(1)).cast("double")
    chars = F.split(value, "")
    # a transition is a place where lower case, upper case, digit or other changes
    kinds = F.regexp_replace(F.regexp_replace(F.regexp_replace(value, "[a-z]+", "l"), "[A-Z]+", "U"), "[0-9]+", "9")
    runs = F.regexp_extract_all(F.lower(value), F.lit("[a-z]{3,}"), F.lit(0))
    known = F.array(*[F.lit(w) for w in dictionary]) if dictionary else F.array(F.lit(""))
    covered = F.aggregate(
        F.filter(runs, lambda r: F.array_contains(known, r)), F.lit(0), lambda a, r: a + F.length(r)
    )
    longest = F.array_max(F.transform(F.regexp_extract_all(value, F.lit("[a-z]+|[A-Z]+|[0-9]+"), F.lit(0)), lambda r: F.length(r)))
    flag = lambda c: F.coalesce(c, F.lit(False)).cast("double")
    return {
        "length": n,
        "transitions": (F.length(kinds) - 1) / n,
        "digit_share": _removed(value, "[0-9]") / n,
        "upper_share": _removed(value, "[A-Z]") / n,
        "hex_only": flag(value.rlike("^([0-9a-f]+|[0-9A-F]+)$")),
        "digits_only": flag(value.rlike("^[0-9_-]+$")),
        "distinct_share": F.size(F.array_distinct(chars)) / n,
        "longest_run": F.coalesce(longest, F.lit(0)) / n,
        "dictionary": covered / n,
        "slashes": _removed(value, "[/_-]") / n,
        "path_near": flag(before.rlike(r"(https?://|www\.|[\w.-]+/|[\\])\S*$") | after.rlike(r"^(/|\.(com|org|net|html?|jpg|png|js|css)\b)")),
        "assigned": flag(before.rlike(r"[=:]\s*[\"']?$")),
        "quoted": flag(before.rlike("[\"']$") & after.rlike("^[\"']")),
        "key_word_near": flag(before.rlike(_KEY_WORDS)),
        "placeholder": flag(value.rlike(_PLACEHOLDER)),
    }


def _running(lengths: Column) -> Column:
    """0 and the running sums."""
    return F.aggregate(
        lengths, F.array(F.lit(0).cast("bigint")), lambda done, x: F.concat(done, F.array(F.element_at(done, -1) + x))
    )


def _starts(gaps: Column, matches: Column, body) -> Column:
    """``body`` over a function from a match's index to its place (code points, from 0); ``gaps`` are
    the texts between matches. Sums run in blocks, so a text of very many matches is no square."""
    lengths = F.transform(matches, lambda m, i: (F.length(F.get(gaps, i)) + F.length(m)).cast("bigint"))
    last = F.greatest(F.floor((F.size(matches) - 1) / BLOCK).cast("int"), F.lit(0))
    blocks = let(
        lengths, lambda x: F.transform(F.sequence(F.lit(0), last), lambda b: _running(F.slice(x, b * BLOCK + 1, F.lit(BLOCK))))
    )

    def start(x: Column, i: Column) -> Column:
        b = F.floor(i / BLOCK).cast("int")
        return F.get(x["offsets"], b) + F.get(F.get(x["blocks"], b), i % BLOCK) + F.length(F.get(gaps, i))

    both = let(
        blocks,
        lambda x: F.struct(x.alias("blocks"), _running(F.transform(x, lambda y: F.element_at(y, -1))).alias("offsets")),
    )
    return let(both, lambda x: body(lambda i: start(x, i)))


def _matches(text: Column, pattern: str, group: int) -> Column:
    """(start, value, before, after) of every match; ``group`` ends where the match ends. A text without a match, as
    most are, is read once."""
    none = F.array().cast("array<struct<start:bigint,value:string,before:string,after:string>>")
    parts = F.struct(
        F.split(text, pattern, -1).alias("gaps"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("whole"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("raw"),
    )

    def found(x: Column) -> Column:
        gaps, whole = x["gaps"], x["whole"]

        def joined(first: Column, last: Column, upto: Column) -> Column:
            piece = lambda j: F.concat(F.get(gaps, j), F.when(j < upto, F.get(whole, j)).otherwise(F.lit("")))
            return F.array_join(F.transform(F.sequence(first, last), piece), "")

        def one(m: Column, i: Column, start: Column) -> Column:
            raw, n = F.get(x["raw"], i), F.size(whole)
            value = F.regexp_replace(raw, r"[.,;:!?)\]}]+$", "")
            head = F.length(m) - F.length(raw)
            left = joined(F.greatest(i - -(-BEFORE // SHORTEST), F.lit(0)), i, i)
            right = joined(i + 1, F.least(i + -(-AFTER // SHORTEST), n), n)
            return F.struct(
                (start + head).cast("bigint").alias("start"),
                value.alias("value"),
                F.right(F.concat(left, F.substring(m, F.lit(1), head)), F.lit(BEFORE)).alias("before"),
                F.substring(F.concat(F.substring(raw, F.length(value) + 1, F.length(raw)), right), 1, AFTER).alias("after"),
            )

        return _starts(gaps, whole, lambda start: F.transform(whole, lambda m, i: one(m, i, start(i))))

    return F.when(text.rlike(pattern), let(parts, found)).otherwise(none)


def found_candidates(text: Column) -> Column:
    """All candidates in text order: start (code points, from 0), value and the text around it."""
    both = F.sort_array(F.concat(_matches(text, _RUN, 0), _matches(text, _NAMED, 1)))
    return let(both, lambda x: F.filter(x, lambda c, i: (F.length(c["value"]) >= 6) & ((i == 0) | (F.get(x, i - 1) != c))))


def _places(text: Column, value: Column) -> Column:
    """Where ``value`` stands in the text, as a replacement finds it (array<bigint>)."""
    literal = F.concat(F.lit("\\Q"), F.replace(value, F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit("\\E"))
    return let(
        F.split(text, literal, -1),
        lambda gaps: let(
            F.array_repeat(value, F.size(gaps) - 1),
            lambda same: _starts(gaps, same, lambda start: F.transform(same, lambda _, i: start(i).cast("bigint"))),
        ),
    )


def rule_label(value: Column, before: Column, after: Column, sources: Column) -> Column:
    """1 for a sure secret, 0 for a sure false positive, null else."""
    named = before.rlike(_NAME_NEAR)
    mixed = value.rlike("[0-9]") & value.rlike("[A-Za-z]")
    worded = value.rlike("^[A-Za-z]{4,}[0-9]{1,4}$") | value.rlike("^[0-9]{1,4}[A-Za-z]{4,}$")
    random = mixed & ~worded & ~value.rlike(_PLACEHOLDER)
    false = (
        value.rlike("^[0-9_-]+$") | value.rlike(_PLACEHOLDER) | worded | ~mixed | (sources > 3)
        | before.rlike(r"(https?://|www\.)\S*$") | value.rlike("^([A-Za-z]+[/_-])+[A-Za-z0-9]+$")
    )
    return F.when(value.rlike(_PROVIDER) | (named & random), 1).when(false, 0)


def labelled_findings(docs: DataFrame, *, text_col: str = "text", source_col: str | None = None) -> DataFrame:
    """(value, before, after, label) of every candidate value of the documents; its context is the least of all its places."""
    text = text_column(docs, text_col)
    source = F.col(f"`{source_col}`").cast("string") if source_col else F.lit("")
    found = docs.select(text.alias("t"), source.alias("s")).select("s", F.explode(found_candidates(F.col("t"))).alias("c"))
    per_value = found.groupBy(F.col("c.value").alias("value")).agg(
        F.size(F.collect_set(F.xxhash64("s") % 64)).alias("sources"), F.min(F.struct("c.before", "c.after")).alias("x")
    )
    v, b, a = F.col("value"), F.col("x.before"), F.col("x.after")
    return per_value.select(v, b.alias("before"), a.alias("after"), rule_label(v, b, a, F.col("sources")).alias("label"))


def corpus_dictionary(docs: DataFrame, *, text_col: str = "text", size: int = DICTIONARY) -> list[str]:
    """The words of three letters and more that most documents hold, counted over all of them."""
    text = text_column(docs, text_col)
    words = docs.select(F.explode(F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(r"\b[a-z]{3,12}\b"), F.lit(0)))).alias("w"))
    top = words.groupBy("w").count().orderBy(F.desc("count"), "w").limit(size)
    return sorted(r["w"] for r in top.collect())


class SecretModel:
    """A forest as a SQL expression: ``trees`` are nested (feature, threshold, left, right) or a share."""

    def __init__(self, trees: list, dictionary: list[str]):
        self.trees, self.dictionary = trees, dictionary

    def score(self, value: Column, before: Column, after: Column) -> Column:
        """Share of the trees' votes for a secret."""
        if not self.trees:
            return F.coalesce(rule_label(value, before, after, F.lit(1)), F.lit(0)).cast("double")
        made = features(value, before, after, self.dictionary)
        row = F.struct(*[made[f].alias(f) for f in FEATURES])
        votes = lambda x: sum((self._tree(t, x) for t in self.trees[1:]), self._tree(self.trees[0], x)) / len(self.trees)
        return F.get(F.transform(F.array(row), votes), F.lit(0))

    def _tree(self, node, row: Column) -> Column:
        if not isinstance(node, tuple):
            return F.lit(float(node))
        feature, threshold, left, right = node
        return F.when(row[FEATURES[feature]] <= threshold, self._tree(left, row)).otherwise(self._tree(right, row))


def _parse_tree(text: str):
    """Nested (feature, threshold, left, right) from a tree's printed form; leaves are their class."""
    lines = [x.strip() for x in text.splitlines() if re.match(r"\s*(If|Else|Predict)", x)]
    at = 0

    def node():
        nonlocal at
        line = lines[at]
        at += 1
        if line.startswith("Predict"):
            return float(line.split(":")[1])
        m = re.match(r"If \(feature (\d+) <= ([-0-9.Ee]+)\)", line)
        left = node()
        at += 1  # the Else line
        right = node()
        return (int(m.group(1)), float(m.group(2)), left, right)

    return node()


def train_forest(findings: DataFrame, dictionary: list[str], *, trees: int = TREES, depth: int = DEPTH) -> SecretModel:
    """A random forest over labelled findings (value, before, after, label; null labels are left out)."""
    known = findings.where("label is not null")
    made = features(F.col("value"), F.col("before"), F.col("after"), dictionary)
    rows = known.select(*[made[f].alias(f) for f in FEATURES], F.col("label").cast("double").alias("label")).persist()
    try:
        sizes = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
        if len(sizes) < 2:
            return SecretModel([], dictionary)
        even = sum(sizes.values()) / 2.0
        weight = F.when(F.col("label") == 1.0, even / sizes[1.0]).otherwise(even / sizes[0.0])
        data = VectorAssembler(inputCols=FEATURES, outputCol="x").transform(rows.withColumn("w", weight))
        forest = RandomForestClassifier(
            featuresCol="x", labelCol="label", weightCol="w", numTrees=trees, maxDepth=depth, seed=11, minInstancesPerNode=2
        ).fit(data)
        return SecretModel([_parse_tree(t.toDebugString) for t in forest.trees], dictionary)
    finally:
        rows.unpersist()


def find_secrets(docs: DataFrame, model: SecretModel, *, text_col: str = "text", threshold: float = THRESHOLD, out: str = "secrets") -> DataFrame:
    """``docs`` plus array ``out`` of (value, start, score, secret): all candidates' places and all
    places of values that are secrets, in text order."""
    text = text_column(docs, text_col)
    judged = F.transform(
        found_candidates(text),
        lambda c: F.struct(
            c["start"].alias("start"), c["value"].alias("value"),
            model.score(c["value"], c["before"], c["after"]).alias("score"),
        ),
    )

    def place(value: Column, start: Column, score: Column, secret: bool) -> Column:
        return F.struct(start.alias("start"), value.alias("value"), score.alias("score"), F.lit(secret).alias("secret"))

    def marked(all_: Column, values: Column) -> Column:
        others = F.transform(
            F.filter(all_, lambda c: ~F.array_contains(values, c["value"])), lambda c: place(c["value"], c["start"], c["score"], False)
        )
        best = lambda v: F.array_max(F.transform(F.filter(all_, lambda c: c["value"] == v), lambda c: c["score"]))
        secret = F.transform(
            values, lambda v: let(best(v), lambda s: F.transform(_places(text, v), lambda at: place(v, at, s, True)))
        )
        return F.transform(
            F.sort_array(F.concat(others, F.flatten(secret))),
            lambda c: F.struct(c["value"].alias("value"), c["start"].alias("start"), c["score"].alias("score"), c["secret"].alias("secret")),
        )

    hits = lambda x: F.array_distinct(F.transform(F.filter(x, lambda c: c["score"] >= threshold), lambda c: c["value"]))
    return docs.withColumn(out, let(judged, lambda x: let(hits(x), lambda values: marked(x, values))))


def redacted(text: Column, found: Column, mark: str = "[SECRET]") -> Column:
    """The text with every place of each secret replaced, longest first."""
    hits = F.array_distinct(F.transform(F.filter(found, lambda c: c["secret"]), lambda c: c["value"]))
    longest = F.sort_array(F.transform(hits, lambda v: F.struct(F.length(v).alias("n"), v.alias("v"))), asc=False)
    return F.aggregate(longest, text, lambda t, c: F.replace(t, c["v"], F.lit(mark)))


def train_secrets(docs: DataFrame, *, text_col: str = "text", source_col: str | None = None) -> SecretModel:
    dictionary = corpus_dictionary(docs, text_col=text_col)
    return train_forest(labelled_findings(docs, text_col=text_col, source_col=source_col), dictionary)


def op5_secrets(spark, sf_dir) -> DataFrame:
    """Candidates, places of secrets and redacted text digest of every document."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "source")
    found = find_secrets(docs, train_secrets(docs, source_col="source"), out="r")
    hits = F.filter("r", lambda c: c["secret"])
    return found.select(
        "doc_id",
        F.size("r").cast("bigint").alias("n_candidates"),
        F.size(hits).cast("bigint").alias("n_secrets"),
        F.array_join(
            F.transform(F.sort_array(F.transform(hits, lambda c: F.struct(c["start"].alias("s"), F.length(c["value"]).alias("n")))),
                        lambda c: F.concat_ws(":", c["s"].cast("string"), (c["s"] + c["n"]).cast("string"))), ",").alias("spans"),
        F.array_max(F.transform("r", lambda c: c["score"])).alias("max_score"),
        F.sha2(redacted(text_column(docs, "text"), F.col("r")), 256).alias("redacted_sha256"),
    )


def stage(spark, docs, sf_dir) -> DataFrame:
    """Pipeline stage: secrets are replaced by ``[SECRET]``; n_chars follows the new text."""
    source = "source" if "source" in docs.columns else None
    out = fresh(docs, "_secrets")
    found = find_secrets(docs, train_secrets(docs, source_col=source), out=out)
    has = F.exists(out, lambda c: c["secret"])
    clean = found.withColumn("text", F.when(has, redacted(F.col("text"), F.col(out))).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        clean = clean.withColumn("n_chars", F.when(has, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return doc_columns(clean, docs)
