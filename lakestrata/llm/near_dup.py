"""Near-duplicate documents by BagMinHash signatures, bands and verified multiset overlap.

A document is the multiset of its five-word shingles (words: ASCII letters lowered, digits and
non-ASCII characters; fewer than five words make one shingle). Two texts are linked when the sum of
the minima of their shingle counts is at least 0.8 of the sum of the maxima.

Signature (``slots`` values): every shingle has one Poisson process for each dyadic block of its
discretised count, (0, 1], (1, 2], (2, 4], (4, 8] ..., with the block's width as rate; a point has a
time, a slot and a place inside its block, and counts if that place is within the shingle's count.
That is the hierarchical splitting of the process down to unit weights. A slot keeps its earliest
point, so two signatures agree in a slot with the probability of the weighted Jaccard similarity.
Points are made in order of time and a process ends once its time is beyond every slot.

Links: equal texts collapse to one node. Nodes that share a band's ``rows`` values meet in a bucket;
40 bands of 5 rows miss a pair of similarity 0.8 with probability 1e-7. A bucket is never expanded into
all its pairs: every member is compared with the bucket's most central node. Members that are not
linked to it, in buckets where these belong to different components, are compared with each other;
and a member that failed with a node but may have similarity of at least 0.6 to it is compared with
the nodes linked to that one (the similarity's distance is a metric, so farther ones cannot be linked
to them). Two filters inside the joins rule out pairs before their texts are fetched. Exactly: shingles
that stand in no other text are never shared, which bounds the overlap of any pair from both sides
(an edited copy's edits are mostly its own, so copies too far from each other go here). And by one
hashed bit of every slot: a linked pair differs in more slots than allowed with probability below
1e-5. What remains is decided by the overlap of the texts, so no link between texts that share a bucket is lost otherwise.

Everything is joins and partially aggregated groups in Spark; signatures and compared pairs are
written tables in the shared scratch folder, components use alternating stars with checkpoints.

Defined results: null counts as empty; a text without words is a copy of equal texts only; class ids
are the least non-null key of the class (null if it has none); repeated rows fall into one class;
equal keys with different texts are judged by their texts; an empty table has no classes; columns of any
name may stand beside. Nodes are 128-bit text digests, so that no two texts of a corpus of any size meet in one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestrata.llm.common import doc_columns, fresh, prepare, read, release_memory, text_column, text_map
from lakestrata.session import checkpoint_root, scratch_dir

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 40, 5
WORDS = 4  # 64-bit words of one-bit slots, for up to 256 slots
BITS = tuple(f"w{i}" for i in range(WORDS))
CARRY = (*BITS, "n", "own")  # what members carry into the joins
SPREAD = 5.0  # standard errors of the bit estimate
MEETING = 2_000  # rows of a hot key that meet others in one task
SIGNED_TOGETHER = 500_000  # characters of texts whose processes run side by side

# Word bytes as in benchmark decontamination: A-Z lowered, digits, a-z and non-ASCII kept, the rest separates.
_TABLE = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)
_U = np.uint64


def node_of(text: Column) -> Column:
    """The node of a text: its 16-byte digest."""
    return F.unhex(F.md5(text.cast("binary")))


def _mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit mixing (splitmix64 finaliser)."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def word_hashes(text: str | None) -> np.ndarray:
    """64-bit hash of every word of the text, in order."""
    data = (text or "").encode("utf-8").translate(_TABLE)
    b = np.frombuffer(data, np.uint8)
    is_word = b != 32
    if not is_word.any():
        return np.empty(0, np.uint64)
    edge = np.diff(is_word.astype(np.int8), prepend=0, append=0)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    lengths = ends - starts
    letters = b[is_word].astype(np.uint64)
    first = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    place = np.arange(len(letters)) - np.repeat(first, lengths)
    power = np.ones(int(lengths.max()), np.uint64)
    power[1:] = _U(0x100000001B3)
    power = np.multiply.accumulate(power)
    h = np.add.reduceat((letters + _U(1)) * power[place], first)
    return _mix(h + lengths.astype(np.uint64) * _U(0x9E3779B97F4A7C15))


def shingle_counts(text: str | None, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes (sorted) and their counts."""
    w = word_hashes(text)
    if not len(w):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    k = min(size, len(w))
    n = len(w) - k + 1
    h = np.full(n, k, np.uint64)
    for i in range(k):
        h = h * _U(0x9E3779B97F4A7C15) + w[i : i + n]
        h = h ^ (h >> _U(29))
    return np.unique(_mix(h), return_counts=True)


def overlap(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two multisets; 1 for two empty ones."""
    total = int(a[1].sum() + b[1].sum())
    if not total:
        return 1.0
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    least = int(np.minimum(a[1][i], b[1][j]).sum())
    return least / (total - least)


def signatures(bags: list[tuple[np.ndarray, np.ndarray]], slots: int) -> np.ndarray:
    """BagMinHash signatures (times as 64-bit patterns), one row for each bag; an empty bag's row is inf."""
    best = np.full((len(bags), slots), np.inf)
    doc, seed, rate, low, count = [], [], [], [], []
    for d, (shingles, counts) in enumerate(bags):
        block = 0
        while len(counts):
            lower = 0 if block == 0 else 1 << (block - 1)
            use = counts > lower
            if not use.any():
                break
            n = int(use.sum())
            doc.append(np.full(n, d))
            seed.append(_mix(shingles[use] + _U((block * 0xD1342543DE82EF95 + 1) & 0xFFFFFFFFFFFFFFFF)))
            width = 1 if block == 0 else lower
            rate.append(np.full(n, float(width)))
            low.append(np.full(n, lower))
            count.append(counts[use])
            block += 1
    if not doc:
        return best.view(np.uint64)
    doc, seed, rate = np.concatenate(doc), np.concatenate(seed), np.concatenate(rate)
    low, count = np.concatenate(low), np.concatenate(count)
    time = np.zeros(len(doc))
    flat = best.reshape(-1)
    point = 0
    while len(doc):
        point += 1
        r = _mix(seed + _U((point * 0xA0761D6478BD642F) & 0xFFFFFFFFFFFFFFFF))
        time = time - np.log(((r >> _U(11)).astype(np.float64) + 1.0) * 2.0**-53) / rate
        r2 = _mix(r ^ _U(0xE7037ED1A0B428DB))
        slot = (r2 & _U(0xFFFFFFFF)).astype(np.int64) % slots
        level = low + 1 + np.floor((r2 >> _U(32)).astype(np.float64) * 2.0**-32 * rate).astype(np.int64)
        hit = level <= count
        np.minimum.at(flat, doc[hit] * slots + slot[hit], time[hit])
        alive = time < best.max(1)[doc]
        doc, seed, rate, low, count, time = doc[alive], seed[alive], rate[alive], low[alive], count[alive], time[alive]
    return best.view(np.uint64)


def band_keys(sig: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """(documents x bands) 64-bit keys; the band's number is part of its key."""
    h = np.arange(1, bands + 1, dtype=np.uint64)[None, :] * _U(0x9E3779B97F4A7C15) + np.zeros((len(sig), 1), np.uint64)
    for r in range(rows):
        h = _mix(h * _U(0x100000001B3) + sig[:, r : bands * rows : rows])
    return h.view(np.int64)


def one_bit_slots(sig: np.ndarray) -> np.ndarray:
    """(documents x WORDS) signed 64-bit words with one hashed bit a slot."""
    bits = (_mix(sig) & _U(1)).astype(np.uint8)
    full = np.zeros((len(sig), 64 * WORDS), np.uint8)
    full[:, : bits.shape[1]] = bits
    return np.packbits(full, axis=1).view(np.int64)


def _by_size(texts: list, limit: int) -> Iterator[list]:
    """The texts in runs of about ``limit`` characters: what a task holds does not depend on their number."""
    some, size = [], 0
    for t in texts:
        some.append(t)
        size += len(t or "")
        if size >= limit:
            yield some
            some, size = [], 0
    if some:
        yield some


def _bands_map(bands: int, rows: int):
    def factory():
        def run(texts):
            keys, bits = [], []
            for some in _by_size(texts, SIGNED_TOGETHER):
                bags = [shingle_counts(t) for t in some]
                sig = signatures(bags, bands * rows)
                keys += [k if len(bag[0]) else [] for k, bag in zip(band_keys(sig, bands, rows).tolist(), bags, strict=True)]
                bits.append(one_bit_slots(sig))
            words = np.concatenate(bits) if bits else np.empty((0, WORDS), np.int64)
            return pa.StructArray.from_arrays(
                [pa.array(keys, pa.list_(pa.int64())), *[pa.array(words[:, j], pa.int64()) for j in range(WORDS)]],
                names=["bands", *BITS],
            )

        return run

    return text_map("bands array<bigint>, " + ", ".join(f"{b} bigint" for b in BITS), factory)


def _differ(x: str, y: str):
    """In how many one-bit slots two nodes differ; ``x`` and ``y`` prefix their words' names."""
    return sum((F.bit_count(F.col(x + b).bitwiseXOR(F.col(y + b))) for b in BITS[1:]), F.bit_count(F.col(x + BITS[0]).bitwiseXOR(F.col(y + BITS[0]))))


def _bag_map():
    """Number of shingles of a text, and its distinct shingles with their counts."""

    def factory():
        def run(texts):
            bags = [shingle_counts(t) for t in texts]
            return pa.StructArray.from_arrays(
                [
                    pa.array([int(c.sum()) for _, c in bags], pa.int64()),
                    pa.array([h.view(np.int64).tolist() for h, _ in bags], pa.list_(pa.int64())),
                    pa.array([c.tolist() for _, c in bags], pa.list_(pa.int32())),
                ],
                names=["n", "h", "c"],
            )

        return run

    return text_map("n bigint, h array<bigint>, c array<int>", factory)


def node_sizes(texts: DataFrame) -> DataFrame:
    """(node, n, own): shingles of each text, and how many of them stand in no other text."""
    bags = _materialise(texts.select("node", _bag_map()(F.col("text")).alias("bag")), "near-dup-bags")
    each = bags.select("node", F.explode(F.arrays_zip(F.col("bag.h").alias("h"), F.col("bag.c").alias("c"))).alias("e"))
    alone = (
        each.groupBy("e.h")
        .agg(F.count("*").alias("k"), F.min("node").alias("node"), F.min("e.c").alias("c"))
        .where("k = 1")
        .groupBy("node")
        .agg(F.sum("c").alias("own"))
    )
    return bags.select("node", "bag.n").join(alone, "node", "left").withColumn("own", F.coalesce("own", F.lit(0).cast("bigint")))


def _may_reach(x: str, y: str, threshold: float):
    """Whether two nodes can have the similarity at all: shingles of their own are never shared, so
    the overlap is at most what either has besides them."""
    most = F.least(F.col(x + "n") - F.col(x + "own"), F.col(y + "n") - F.col(y + "own"))
    return most >= (threshold - 1e-9) * (F.col(x + "n") + F.col(y + "n") - most)


def _similarity():
    """Multiset overlap of two texts; the last few texts' shingles are kept, since pairs come sorted."""
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        kept: dict[str, tuple] = {}

        def bag(text):
            got = kept.get(text)
            if got is None:
                if len(kept) >= 16:
                    kept.clear()
                got = kept[text] = shingle_counts(text)
            return got

        for left, right in batches:
            pairs = zip(left.to_pylist(), right.to_pylist(), strict=True)
            yield pa.array([overlap(bag(a) if len(a) < 200_000 else shingle_counts(a), bag(b)) for a, b in pairs], pa.float64())
        kept.clear()
        release_memory()

    run.__annotations__ = {"batches": Iterator[tuple[pa.Array, pa.Array]], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, "double").asNondeterministic()


def _materialise(df: DataFrame, name: str) -> DataFrame:
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges`` (a, b: of one ordered type) by alternating large and small stars:
    (node, comp) with comp the component's least node, for all nodes but those themselves."""
    spark = edges.sparkSession
    checkpoint_root(spark)
    cur = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    before = None
    while True:
        both = cur.union(cur.select(F.col("b"), F.col("a")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        low = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(low, "a").select(F.col("b").alias("x"), "m").union(low.select(F.col("a").alias("x"), "m"))
        cur = small.where("x <> m").select(F.col("x").alias("a"), F.col("m").alias("b")).distinct().checkpoint()
        state = cur.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if before == state:
            return cur.select(F.col("a").alias("node"), F.col("b").alias("comp"))
        before = state


def _compare(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """``pairs`` (a, b) with ``sim``, the overlap of their texts, as a written table."""
    left = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("ta")), "a")
    both = left.join(texts.select(F.col("node").alias("b"), F.col("text").alias("tb")), "b")
    return _materialise(both.select("a", "b", _similarity()(F.col("ta"), F.col("tb")).alias("sim")), "near-dup-compared")


def _links(compared: DataFrame, threshold: float) -> DataFrame:
    return compared.where(F.col("sim") >= threshold).select("a", "b")


def _placed(df: DataFrame, comps: DataFrame, node: str, out: str) -> DataFrame:
    """``df`` with the component of ``node`` (the node itself if it has no link)."""
    named = comps.select(F.col("node").alias(node), F.col("comp").alias(out))
    return df.join(named, node, "left").withColumn(out, F.coalesce(out, node))


def _prefixed(df: DataFrame, prefix: str, keep: tuple[str, ...] = ()) -> DataFrame:
    return df.select(*[F.col(c).alias(c if c in keep else prefix + c) for c in df.columns])


def _chunked(df: DataFrame, key: str, node: str, limit: int) -> DataFrame:
    """``df`` with ``chunk``, its row's share of the key's rows, and ``chunks``, in how many of about ``limit`` rows they are cut."""
    sizes = df.groupBy(key).agg(F.ceil(F.count("*") / F.lit(limit)).cast("int").alias("chunks"))
    return df.join(sizes, key).withColumn("chunk", F.pmod(F.xxhash64(node), F.col("chunks")).cast("int"))


def _meetings(left: DataFrame, limit: int) -> tuple[DataFrame, DataFrame]:
    """Both sides of the self-join of ``left`` on ``key``, cut so that no task holds all pairs of a hot key: a key's rows
    are chunks, and each pair of chunks (``lo``, ``hi``) meets apart."""
    cut = _materialise(_chunked(left, "key", "node", limit), "near-dup-chunks")
    many = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    many = many.withColumns({"lo": F.least("chunk", "other"), "hi": F.greatest("chunk", "other")}).drop("other", "chunks")
    return _prefixed(many, "l_"), _prefixed(many, "r_")


def link_nodes(members: DataFrame, texts: DataFrame, threshold: float, slots: int) -> DataFrame:
    """Components (node, comp) of the linked nodes; ``members``: key, node and CARRY."""
    # slots in which a linked pair can differ at most, and a pair near enough to pass a link on
    far = int(slots * (1 - threshold) / 2 + SPREAD * (slots * (1 - threshold) / 2 * (1 + threshold) / 2) ** 0.5)
    least = 2 * threshold - 1
    grey_far = int(slots * (1 - least) / 2 + (SPREAD - 1) * (slots * (1 - least) / 2 * (1 + least) / 2) ** 0.5)

    # every member against its bucket's most central node: the one that meets most others in all buckets
    sizes = members.groupBy("key").agg(F.count("*").alias("n"))
    met = members.select("key", "node").join(sizes, "key").groupBy("node").agg(F.sum("n").alias("central"))
    first = F.max(F.struct("central", "node", *CARRY)).alias("r")
    firsts = members.join(met, "node").groupBy("key").agg(first).select("key", F.col("r.node").alias("p_node"), *[F.col(f"r.{b}").alias("p_" + b) for b in CARRY])
    stars = members.join(firsts, "key").where("node <> p_node").withColumn("differ", _differ("", "p_"))
    stars = _materialise(stars, "near-dup-stars")
    pairs = stars.where((F.col("differ") <= far) & _may_reach("", "p_", threshold)).select(F.col("node").alias("a"), F.col("p_node").alias("b")).distinct()
    compared = _compare(pairs, texts)
    comps = components(_links(compared, threshold))
    linked = _links(compared, threshold).select(F.col("a").alias("node"), F.col("b").alias("p_node"))

    # members left over, in buckets that still mix components, against each other: the bits are compared
    # inside the join, so only pairs that may be linked come out of it
    left = stars.join(linked, ["node", "p_node"], "left_anti").select("key", "node", *CARRY)
    left = _placed(left, comps, "node", "comp")
    mixed = left.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("key")
    left = _materialise(left.join(mixed, "key"), "near-dup-left")
    l, r = _meetings(left, MEETING)  # noqa: E741
    near = (F.col("l_key") == F.col("r_key")) & (F.col("l_lo") == F.col("r_lo")) & (F.col("l_hi") == F.col("r_hi"))
    near &= ((F.col("l_chunk") != F.col("r_chunk")) | (F.col("l_lo") == F.col("l_hi"))) & (F.col("l_node") > F.col("r_node"))
    near &= (F.col("l_comp") != F.col("r_comp")) & (_differ("l_", "r_") <= far) & _may_reach("l_", "r_", threshold)
    pairs = l.join(r, near).select(F.col("l_node").alias("a"), F.col("r_node").alias("b")).distinct()
    found = _compare(pairs, texts)
    compared = compared.union(found)
    if not _links(found, threshold).isEmpty():
        comps = components(_links(compared, threshold))

    # x was near its bucket's first node p without a link; y is linked to p: the two may still be linked
    grey = stars.where((F.col("differ") <= grey_far) & _may_reach("", "p_", least)).join(linked, ["node", "p_node"], "left_anti")
    grey = _placed(grey.select("node", "p_node", *CARRY).distinct(), comps, "node", "comp")
    friend = stars.join(linked, ["node", "p_node"], "left_semi").select("node", "p_node", *CARRY).distinct()
    # a hot first node's rows of both sides are chunks too, each pair of which meets apart
    grey, friend = _chunked(grey, "p_node", "node", MEETING), _chunked(_placed(friend, comps, "node", "comp"), "p_node", "node", MEETING)
    sides = grey.groupBy("p_node").agg(F.first("chunks").alias("xs")).join(friend.groupBy("p_node").agg(F.first("chunks").alias("ys")), "p_node")
    sides = _materialise(sides, "near-dup-sides")
    grey = grey.drop("chunks").join(sides, "p_node").withColumn("meets", F.explode(F.sequence(F.lit(0), F.col("ys") - 1))).drop("xs", "ys")
    friend = friend.drop("chunks").join(sides, "p_node").withColumn("meets", F.explode(F.sequence(F.lit(0), F.col("xs") - 1))).drop("xs", "ys")
    x, y = _prefixed(grey, "x_", ("p_node",)), _prefixed(friend, "y_")
    near = (F.col("p_node") == F.col("y_p_node")) & (F.col("x_meets") == F.col("y_chunk")) & (F.col("x_chunk") == F.col("y_meets")) & (F.col("x_comp") != F.col("y_comp")) & (F.col("x_node") != F.col("y_node")) & (_differ("x_", "y_") <= far) & _may_reach("x_", "y_", threshold)
    pairs = x.join(y, near).select(F.greatest("x_node", "y_node").alias("a"), F.least("x_node", "y_node").alias("b")).distinct()
    found = _compare(pairs, texts)
    if not _links(found, threshold).isEmpty():
        comps = components(_links(compared.union(found), threshold))
    return comps


def near_duplicates(
    docs: DataFrame, *, key: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD,
    bands: int = BANDS, rows: int = ROWS,
) -> DataFrame:
    """One row for each document: ``key``, ``node`` (hash of its text), ``class_id`` (least key of its
    class), ``class_node`` (least node of the class), ``copies`` (rows with equal text)."""
    spark = prepare(docs.sparkSession)
    base = docs.select(F.col(f"`{key}`").alias("key"), text_column(docs, text_col).alias("text")).withColumn(
        "node", node_of(F.col("text"))
    )
    made = base.select("key", "node", _bands_map(bands, rows)(F.col("text")).alias("s"))
    sig = _materialise(made.select("key", "node", "s.*"), "near-dup-signatures")
    nodes = sig.groupBy("node").agg(F.min("key").alias("least"), F.count("*").alias("copies"))
    put = sig.select(F.explode("bands").alias("key"), "node", *BITS)
    shared = put.groupBy("key").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo < hi").select("key")
    # equal texts have equal rows here, so one row stays of each bucket and node
    members = _materialise(put.join(shared, "key").distinct(), "near-dup-members")
    involved = members.select("node").distinct()
    texts = _materialise(
        base.select("node", "text").join(involved, "node", "left_semi").groupBy("node").agg(F.first("text").alias("text")),
        "near-dup-texts",
    )
    members = _materialise(members.join(node_sizes(texts), "node"), "near-dup-members")
    comps = link_nodes(members, texts, threshold, bands * rows)
    placed = nodes.join(comps, "node", "left").withColumn("class_node", F.coalesce("comp", "node"))
    heads = placed.groupBy("class_node").agg(F.min("least").alias("class_id"))
    placed = placed.join(heads, "class_node").select("node", "class_node", "class_id", "copies")
    return sig.select("key", "node").join(placed, "node").select(F.col("key").alias(key), "node", "class_id", "class_node", "copies")


def op10_near_dup(spark, sf_dir) -> DataFrame:
    """Near-duplicate class of every document."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return near_duplicates(docs).select("doc_id", "class_id", "copies")


def stage(spark, docs, sf_dir) -> DataFrame:
    """Pipeline stage: of every class one document stays, the one with the least doc_id (then text hash).

    Rows that repeat the chosen document's id and text are dropped too."""
    classes = near_duplicates(docs)
    k, t, node = fresh(docs, "_key"), fresh(docs, "_text_node"), fresh(docs, "_node")
    # one (id, text) of each class; null ids come last
    order = F.struct(F.col("doc_id").isNull().alias("n"), F.col("doc_id").alias("k"), F.col("node").alias("t"))
    chosen = classes.groupBy("class_node").agg(F.min(order).alias("c")).select(F.col("c.k").alias(k), F.col("c.t").alias(t))
    slim = _materialise(classes.select(F.col("doc_id").alias(k), F.col("node").alias(t)), "near-dup-classes")
    chosen = _materialise(chosen, "near-dup-chosen")
    marked = docs.withColumn(node, node_of(text_column(docs, "text")))
    same = F.col("doc_id").eqNullSafe(F.col(k)) & (F.col(node) == F.col(t))
    kept = marked.join(chosen, same, "left_semi")
    other = chosen.withColumnsRenamed({k: k + "2", t: t + "2"})
    repeated = slim.groupBy(k, t).count().where("count > 1").select(k, t).join(
        other, F.col(k).eqNullSafe(F.col(k + "2")) & (F.col(t) == F.col(t + "2")), "left_semi"
    )
    if not repeated.isEmpty():
        once = kept.join(repeated, same, "left_semi").dropDuplicates(["doc_id", node])
        kept = kept.join(repeated, same, "left_anti").unionByName(once)
    return doc_columns(kept, docs)
