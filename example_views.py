"""Views that give the driver's test tables the shapes of the event lake.

The test tables are flat (``events``, TPC-H ``orders``/``customer``, text tables). These functions
re-shape them with plain projections — no rows are invented, dropped or sampled — so the library's
operators run on data whose volume grows with the given tables:

- ``bronze_events``: ``events`` as nested bronze rows (``actor``/``repo``/``org`` structs and a
  ``payload`` struct whose filled fields depend on the event type, like inferred archive JSON);
- ``push_table`` / ``push_fact``: ``orders`` as push events and ``orders ⋈ customer`` as their fact
  rows (TPC-H dates span several years, which the time-ordering rules need);
- ``comment_tables``: the text tables as the four comment-bearing sources.

Every derivation here is mirrored in the DuckDB oracle SQL of ``__spark_entry__``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata.functions.timefmt import add_day, iso_text


_TABLES: dict[tuple[str, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One test table, resolved once per application and path (like a catalog entry).

    The files are read-only, so the same lazy DataFrame is handed out again instead of re-reading
    the Parquet footers (one small job per ``spark.read.parquet`` call) for every query.
    """
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (spark.sparkContext.applicationId, path)
    df = _TABLES.get(key)
    if df is None or df.sparkSession is not spark:
        df = _TABLES[key] = spark.read.parquet(path)
    return df


def _txt(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def props_k(props: str = "props") -> Column:
    """The integer ``k`` of the JSON ``props`` text (null when absent or not an integer)."""
    return F.get_json_object(F.col(props), "$.k").try_cast("bigint")


def bronze_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as nested bronze: ``id, type, created_at, actor, repo, org, payload, day``."""
    return bronze_from_events(table(spark, sf_dir, "events"))


def bronze_from_events(ev: DataFrame) -> DataFrame:
    """Row-wise reshaping of ``events`` rows into nested bronze rows (works on a stream too).

    ``props`` is parsed once in a lower projection; the structs then reuse the parsed value.
    """
    base = ev.select("event_id", "ts", "user_id", "event_type", "value", props_k().alias("__k"))
    k = F.col("__k")
    login = F.concat(F.lit("user"), _txt("user_id"))
    repo_name = F.concat(login, F.lit("/repo"), _txt(k))
    etype = F.col("event_type")
    bronze = base.select(
        _txt("event_id").alias("id"),
        etype.alias("type"),
        iso_text("ts").alias("created_at"),
        F.struct(
            F.col("user_id").alias("id"),
            login.alias("login"),
            login.alias("display_login"),
            F.lit("").alias("gravatar_id"),
            F.concat(F.lit("https://api.example.com/users/"), login).alias("url"),
        ).alias("actor"),
        F.struct(
            k.alias("id"),
            repo_name.alias("name"),
            F.concat(F.lit("https://api.example.com/repos/"), repo_name).alias("url"),
        ).alias("repo"),
        F.when(
            k < 10,
            F.struct(
                k.alias("id"),
                F.concat(F.lit("org"), _txt(k)).alias("login"),
                F.concat(F.lit("https://api.example.com/orgs/org"), _txt(k)).alias("url"),
            ),
        ).alias("org"),
        F.struct(
            F.when(etype == "purchase", F.col("value")).alias("amount"),
            F.when(etype == "purchase", k).alias("quantity"),
            F.when(etype == "error", k).alias("code"),
            F.when(
                etype.isin("click", "view"),
                F.struct(
                    k.alias("id"),
                    F.concat(F.lit("item"), _txt(k)).alias("name"),
                    F.concat(F.lit("https://shop.example.com/item/"), _txt(k)).alias("html_url"),
                ),
            ).alias("item"),
            F.when(etype == "signup", F.concat(F.lit("campaign"), _txt(k))).alias("campaign"),
        ).alias("payload"),
    )
    return add_day(bronze, "created_at")


def push_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders`` as push events: ``id, created_at, push_id, distinct_size, ref``.

    ``ref`` is ``refs/<status>/<priority>`` so its third ``/`` segment is the order priority.
    """
    o = table(spark, sf_dir, "orders")
    return o.select(
        _txt("o_orderkey").alias("id"),
        iso_text("o_orderdate").alias("created_at"),
        F.col("o_orderkey").alias("push_id"),
        F.floor(F.col("o_totalprice") / 1000).alias("distinct_size"),
        F.concat(F.lit("refs/"), F.col("o_orderstatus"), F.lit("/"), F.col("o_orderpriority")).alias("ref"),
    )


def push_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fact rows of the push events: ``orders ⋈ customer`` in the fact table's columns."""
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    j = o.join(c, o["o_custkey"] == c["c_custkey"])
    return j.select(
        _txt("o_orderkey").alias("id"),
        F.lit("PushEvent").alias("type"),
        iso_text("o_orderdate").alias("created_at"),
        F.col("c_custkey").alias("actor_id"),
        F.col("c_name").alias("actor_login"),
        F.lower(F.col("c_name")).alias("actor_display_login"),
        F.col("c_nationkey").alias("repo_id"),
        F.concat(F.col("c_mktsegment"), F.lit("/"), F.col("o_orderpriority")).alias("repo_name"),
        F.col("c_mktsegment").alias("org_login"),
    )


def comment_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The four comment-bearing sources in silver shape.

    ``commit_comment_event_df``, ``issue_comment_event_df`` and
    ``pull_request_review_comment_event_df`` hold ``id, comment_body``; the push commits child table
    ``push_event_df_commits_df`` holds ``fact_id, pos, message`` (one row per commit).
    """
    bench = table(spark, sf_dir, "benchmark")
    docs = table(spark, sf_dir, "documents")
    pages = table(spark, sf_dir, "pages")
    conv = table(spark, sf_dir, "conversations")
    return {
        "commit_comment_event_df": bench.select(_txt("item_id").alias("id"), F.col("text").alias("comment_body")),
        "issue_comment_event_df": docs.select(_txt("doc_id").alias("id"), F.col("text").alias("comment_body")),
        "pull_request_review_comment_event_df": pages.select(
            _txt("page_id").alias("id"), F.col("html").alias("comment_body")
        ),
        "push_event_df_commits_df": conv.select(
            _txt("conv_id").alias("fact_id"), F.col("turn").alias("pos"), F.col("text").alias("message")
        ),
    }


def event_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat fact rows of ``events`` (the silver fact of ``bronze_events``)."""
    from lakestrata.plans.silver import build_fact

    return build_fact(bronze_events(spark, sf_dir))


def nested_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``customer ⟕ nation ⟕ region`` as nested structs (struct in struct) for the flatten operators."""
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    j = c.join(n, c["c_nationkey"] == n["n_nationkey"], "left").join(r, n["n_regionkey"] == r["r_regionkey"], "left")
    return j.select(
        "c_custkey",
        "c_name",
        F.struct(F.col("c_acctbal").alias("acctbal"), F.col("c_mktsegment").alias("segment")).alias("account"),
        F.struct(
            F.col("n_name").alias("name"),
            F.struct(F.col("r_name").alias("name"), F.col("r_regionkey").alias("key")).alias("region"),
        ).alias("nation"),
    )


def document_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` as an event table with an array-of-struct column: every line of the whole text
    with its length (``lines: array<struct<line, n_chars>>``)."""
    d = table(spark, sf_dir, "documents")
    lines = F.transform(
        F.split(F.col("text"), "\n"),
        lambda line: F.struct(line.alias("line"), F.length(line).alias("n_chars")),
    )
    return d.select(_txt("doc_id").alias("id"), F.col("source").alias("type"), lines.alias("lines"))


def embedding_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``embeddings`` as an event table with a primitive array column."""
    e = table(spark, sf_dir, "embeddings")
    return e.select(_txt("vec_id").alias("id"), "label", "embedding")


def coded_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` as labelled comments: ``id, type, comment, code`` (the stored language code)."""
    d = table(spark, sf_dir, "documents")
    return d.select(
        _txt("doc_id").alias("id"), F.col("source").alias("type"), F.col("text").alias("comment"),
        F.col("lang").alias("code"),
    )


# Test-data mapping of the five ``events`` types onto archive event types (fixed values).
ARCHIVE_TYPE = {
    "purchase": "PushEvent",
    "click": "IssueCommentEvent",
    "error": "CommitCommentEvent",
    "signup": "PullRequestReviewCommentEvent",
    "view": "WatchEvent",
}
BRANCHES = ("master", "gh-pages", "dev")


def archive_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events ⟕ documents`` as archive-shaped bronze: push events whose commits are every line of the
    matching documents, comment events whose body is their whole text, watch events. Every document is some event's,
    spread evenly over the events and so over all their days: document ``d`` belongs to event
    ``d × (events // documents)`` modulo the number of events (their ids are dense); where several meet, their texts are
    joined by line breaks. A view that has a document is a commit comment.

    Same ``actor``/``repo``/``org`` structs as ``bronze_events``; ``type`` uses the archive names.
    """
    ev = table(spark, sf_dir, "events")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    n = max(1, ev.count())
    step = max(1, n // max(1, docs.count()))
    meet = docs.groupBy(F.pmod(F.col("doc_id") * step, F.lit(n)).alias("slot")).agg(F.collect_list(F.struct("doc_id", "text")).alias("d"))
    texts = F.transform(F.filter(F.array_sort("d"), lambda x: x["text"].isNotNull()), lambda x: x["text"])
    joined = meet.select("slot", F.when(F.size(texts) > 0, F.array_join(texts, "\n")).alias("text"))
    base = ev.join(joined, ev["event_id"] == joined["slot"], "left").select(
        "event_id", "ts", "user_id", F.when((F.col("event_type") == "view") & F.col("slot").isNotNull(), "error").otherwise(F.col("event_type")).alias("event_type"),
        props_k().alias("__k"), "text",
    )
    k = F.col("__k")
    etype = F.col("event_type")
    login = F.concat(F.lit("user"), _txt("user_id"))
    repo_name = F.concat(login, F.lit("/repo"), _txt(k))
    archive_type = F.create_map(*[F.lit(x) for kv in ARCHIVE_TYPE.items() for x in kv])[etype]
    is_push = etype == "purchase"
    is_comment = etype.isin("click", "error", "signup")
    branch = F.element_at(F.array(*[F.lit(b) for b in BRANCHES]), (F.pmod(k, F.lit(len(BRANCHES))) + 1).cast("int"))
    commits = F.transform(
        F.split(F.col("text"), "\n"),
        lambda line, i: F.struct(
            F.concat(_txt("event_id"), F.lit("-"), i.cast("string")).alias("sha"), line.alias("message")
        ),
    )
    bronze = base.select(
        _txt("event_id").alias("id"),
        archive_type.alias("type"),
        iso_text("ts").alias("created_at"),
        F.struct(
            F.col("user_id").alias("id"), login.alias("login"), login.alias("display_login"),
            F.lit("").alias("gravatar_id"),
        ).alias("actor"),
        F.struct(k.alias("id"), repo_name.alias("name")).alias("repo"),
        F.when(k < 10, F.struct(k.alias("id"), F.concat(F.lit("org"), _txt(k)).alias("login"))).alias("org"),
        F.struct(
            F.when(is_push, F.col("event_id")).alias("push_id"),
            F.when(is_push, k).alias("distinct_size"),
            F.when(is_push, F.concat(F.lit("refs/heads/"), branch)).alias("ref"),
            F.when(is_push, commits).alias("commits"),
            F.when(
                is_comment & F.col("text").isNotNull(),
                F.struct(F.col("event_id").alias("id"), F.col("text").alias("body")),
            ).alias("comment"),
            F.when(etype == "view", F.lit("started")).alias("action"),
        ).alias("payload"),
    )
    return add_day(bronze, "created_at")


SECOND_LOAD = 3  # every third document comes with the second load


def document_events(spark: SparkSession, sf_dir: str, load: str) -> DataFrame:
    """``documents`` as archive events over twenty days, one event a document, in two loads that share all days: push
    events whose commits are the document's lines, and two kinds of comment events whose body is the whole text.

    The second load's pushes also carry ``distinct_size`` and an array ``labels``, and their ``size`` is a fraction."""
    d = table(spark, sf_dir, "documents")
    late = F.pmod("doc_id", F.lit(SECOND_LOAD)) == 0
    return events_from_documents(d.where(late if load == "second" else ~late), load)


def events_from_documents(d: DataFrame, load: str = "first") -> DataFrame:
    """The rows of ``document_events`` from rows of ``documents`` (works on a stream too)."""
    n = F.col("doc_id")
    kind, user, repo = F.pmod(n, F.lit(4)), F.pmod(n, F.lit(97)), F.pmod(n, F.lit(31))
    login = F.concat(F.lit("user"), _txt(user))
    is_push = kind <= 1
    day = F.format_string("2024-03-%02d", F.pmod(n, F.lit(20)) + 1)
    commits = F.transform(F.split("text", "\n"), lambda line: F.struct(line.alias("message")))
    branch = F.element_at(F.array(*[F.lit(b) for b in BRANCHES]), (F.pmod(n, F.lit(len(BRANCHES))) + 1).cast("int"))
    fields = {
        "push_id": n,
        "ref": F.concat(F.lit("refs/heads/"), branch),
        "commits": commits,
        "size": F.length("text") / F.lit(2.0) if load == "second" else F.length("text").cast("bigint"),
    }
    if load == "second":
        fields |= {"distinct_size": F.pmod(n, F.lit(7)), "labels": F.array("lang", "source")}
    return d.select(
        _txt(n).alias("id"),
        F.when(is_push, "PushEvent").when(kind == 2, "IssueCommentEvent").otherwise("PullRequestReviewCommentEvent").alias("type"),
        F.concat(day, F.format_string("T%02d:00:00Z", F.pmod(n, F.lit(24)))).alias("created_at"),
        F.struct(user.alias("id"), login.alias("login"), login.alias("display_login")).alias("actor"),
        F.struct(repo.alias("id"), F.concat(F.lit("owner"), _txt(F.pmod(n, F.lit(13))), F.lit("/repo"), _txt(repo)).alias("name")).alias("repo"),
        F.struct(F.col("lang").alias("login")).alias("org"),
        F.struct(
            *[F.when(is_push, c).alias(name) for name, c in fields.items()],
            F.when(~is_push, F.struct(F.col("text").alias("body"))).alias("comment"),
        ).alias("payload"),
        day.alias("day"),
    )


def event_days(spark: SparkSession, sf_dir: str) -> list[str]:
    """Every calendar day from the first to the last event (``yyyy-MM-dd``), from one aggregate over
    the ``ts`` column: the day list of a per-day file plan."""
    import datetime as dt

    row = table(spark, sf_dir, "events").agg(F.min("ts").alias("lo"), F.max("ts").alias("hi")).first()
    if row.lo is None:
        return []
    first, last = row.lo.date(), row.hi.date()
    return [(first + dt.timedelta(days=i)).isoformat() for i in range((last - first).days + 1)]


def late_field_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``bronze_events`` whose purchases carry one more payload field and an array, but only in the
    last third of the days (from the 21st on): what a new version of the event source looks like."""
    bronze = bronze_events(spark, sf_dir)
    late = (F.col("type") == "purchase") & (F.substring("created_at", 9, 2) >= "21")
    quantity = F.col("payload.quantity")
    fields = [F.col("payload").getField(f).alias(f) for f in bronze.schema["payload"].dataType.fieldNames()]
    tags = F.array(F.concat(F.lit("tag"), _txt(quantity % 7)), F.concat(F.lit("size"), _txt(quantity % 3)))
    return bronze.withColumn(
        "payload",
        F.struct(*fields, F.when(late, quantity * 2).alias("bonus"), F.when(late, tags).alias("tags")),
    )


def landing_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as an inventory of hourly landing files: ``name``, ``length`` (bytes of the props)."""
    ev = table(spark, sf_dir, "events")
    name = F.concat(F.date_format("ts", "yyyy-MM-dd"), F.lit("-"), _txt(F.hour("ts")), F.lit(".json.gz"))
    return ev.groupBy(name.alias("name")).agg(F.sum(F.octet_length("props")).alias("length"))
