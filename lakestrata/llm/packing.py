"""Best-fit packing of tokenised documents into sequences, certified by dual-feasible functions.

A document is its token ids and one end id. Only a document longer than the capacity is cut: its first piece
takes the remainder, all others fill a sequence each. The shorter pieces are packed in rounds. Pieces are
dealt by hash to partitions of about ``group`` pieces; a partition is packed best-fit decreasing (a piece
goes to the fullest sequence that still holds it), and the largest bound that a family of dual-feasible
functions gives for its lengths is its certificate: as many sequences as the bound are optimal. A certified
partition keeps all its sequences but the emptiest. A partition with a gap opens its emptiest sequences,
enough of them that their free room would save the gap. The pieces of opened sequences are exchanged (dealt
anew over fewer partitions) and packed again, as long as that saves sequences; the last round is one
partition, or the packing before it where a rerun saved nothing. Nothing is dropped.

Dual-feasible functions (of a length x, capacity 1): x itself; Martello-Toth's (1 above 1 - l, 0 below l);
Fekete-Schepers' u_k, stair steps of k + 1; and their phi_l, which rounds what a long piece leaves over. All are
evaluated in integers on the histogram of lengths.

At scale: texts are tokenised once in place and give a table of pieces (five numbers each); only those
are shuffled. A task holds one partition at a time. Each round moves about one sequence a partition, so the
rows shrink by orders of magnitude and no task ever holds more than ``group`` pieces.

Defined results: null counts as empty, and an empty document is its end id alone; repeated rows are packed
one by one; equal lengths are taken in the order of the piece table; null ids stay null; an empty table
gives no rows. Only the id and the text are read, so other columns cannot clash.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestrata.llm.common import prepare, read, text_column
from lakestrata.session import scratch_dir

VOCABULARY = "byte_bpe_50k.json"
CAPACITY = 2048
END_ID = 0
GROUP = 8192
ROUNDS = 16
PIECE = "piece int, start bigint, length bigint, ids_crc32 bigint"


# ---------------------------------------------------------------- tokens
class Encoder:
    """Ids of texts by a tokenizer file. Where the file is plain byte-level BPE whose ids follow its merges,
    texts of unproblematic characters go through the faster merge loop of tiktoken, fed from the same file;
    all other texts (and all texts of other tokenizers) go through the tokenizers library."""

    # controls, superscripts, fractions and everything beyond Latin: character classes of the libraries may differ
    UNUSUAL = re.compile("[\x00-\x08\x0b-\x1f\x7f-\x9f\xb2\xb3\xb9\xbc-\xbeɐ-\U0010ffff]")

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        with open(path, encoding="utf-8") as f:
            self.special, self.fast = self._fast(json.load(f))

    @staticmethod
    def _fast(spec: dict):
        model, pre = spec.get("model", {}), spec.get("pre_tokenizer") or {}
        special = [t["content"] for t in spec.get("added_tokens", [])]
        plain = (
            spec.get("normalizer") is None and pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space")
            and model.get("type") == "BPE" and not model.get("dropout") and not model.get("ignore_merges")
            and not model.get("continuing_subword_prefix") and not model.get("end_of_word_suffix")
        )
        if not plain:
            return special, None
        vocab, merges = model["vocab"], [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        if any(vocab.get(a + b) != 256 + i for i, (a, b) in enumerate(merges)):
            return special, None  # ids do not follow the order of the merges
        import public_tokenizers
        import tiktoken

        # byte-level files write bytes as characters: printable ones as themselves, the others from U+0100 on
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte_of = {chr(b): b for b in shown}
        byte_of.update({chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(shown))})
        ranks = {bytes(byte_of[c] for c in t): i for t, i in vocab.items() if t not in special}
        return special, tiktoken.Encoding("packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> np.ndarray:
        if self.fast is None or self.UNUSUAL.search(text) or any(s in text for s in self.special):
            return np.array(self.tok.encode(text, add_special_tokens=False).ids, "<u4")
        return np.asarray(self.fast.encode_to_numpy(text, disallowed_special=()), "<u4")


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids."""
    head = n % capacity or min(n, capacity)
    return [(0, head), *[(at, capacity) for at in range(head, n, capacity)]]


def pieces(
    docs: DataFrame, path: str | None = None, *, key: str = "doc_id", text_col: str = "text",
    capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False,
) -> DataFrame:
    """One row for each piece: ``key, piece, start, length, ids_crc32`` and, on request, ``ids`` (unsigned
    little-endian 32-bit numbers). ``path`` is the tokenizer file on every machine."""
    slim = docs.select(F.col(f"`{key}`").alias("key"), text_column(docs, text_col).alias("text"))
    kind = slim.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path or vocabulary_path())
        for batch in batches:
            rows, place, start, length, crc, data = [], [], [], [], [], []
            for i, text in enumerate(batch.column("text").to_pylist()):
                ids = np.append(encoder.ids(text), np.array([end_id], "<u4"))
                for p, (at, n) in enumerate(cut(len(ids), capacity)):
                    raw = ids[at : at + n].astype("<u4").tobytes()
                    rows.append(i)
                    place.append(p)
                    start.append(at)
                    length.append(n)
                    crc.append(zlib.crc32(raw))
                    if with_ids:
                        data.append(raw)
            arrays = [batch.column("key").take(pa.array(rows, pa.int64())), pa.array(place, pa.int32())]
            arrays += [pa.array(x, pa.int64()) for x in (start, length, crc)] + ([pa.array(data, pa.binary())] if with_ids else [])
            names = ["key", "piece", "start", "length", "ids_crc32"] + (["ids"] if with_ids else [])
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return slim.mapInArrow(run, f"key {kind}, {PIECE}" + (", ids binary" if with_ids else ""))


# ---------------------------------------------------------------- packing of one partition
def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sequence, offset) of every length, and the free room of every sequence."""
    order = np.argsort(-lengths, kind="stable")
    bin_of, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    gaps: list[int] = []
    by_gap: list[list[int]] = [[] for _ in range(capacity + 1)]
    some = 0  # bit g: some sequence has room g
    for i, x in zip(order.tolist(), lengths[order].tolist(), strict=True):
        fits = some >> x
        if fits:
            g = x + (fits & -fits).bit_length() - 1
            b = by_gap[g].pop()
            if not by_gap[g]:
                some &= ~(1 << g)
        else:
            g, b = capacity, len(gaps)
            gaps.append(capacity)
        bin_of[i], offset[i] = b, capacity - g
        gaps[b] = g - x
        if g > x:
            by_gap[g - x].append(b)
            some |= 1 << (g - x)
    return bin_of, offset, np.array(gaps, np.int64)


def lower_bound(counts: np.ndarray, steps: int = 64) -> int:
    """Sequences that any packing needs: the largest bound of the dual-feasible functions, for
    ``counts[x]`` pieces of length x, x from 0 to the capacity."""
    c = len(counts) - 1
    x = np.arange(c + 1, dtype=np.int64)
    counts = counts.astype(np.int64)
    best = -(-int((x * counts).sum()) // c)
    # Martello-Toth: lengths above c - l count whole, those below l not at all
    number, total = np.concatenate([[0], np.cumsum(counts)]), np.concatenate([[0], np.cumsum(x * counts)])
    half = np.arange(1, c // 2 + 1)
    whole = number[c + 1] - number[c - half + 1]
    between = total[c - half + 1] - total[half]
    best = max(best, int((whole + -(-between // c)).max(initial=0)))
    used = np.flatnonzero(counts)
    n = counts[used]
    for k in range(1, steps + 1):  # u_k, scaled by k * c
        up = (k + 1) * used
        value = np.where(up % c == 0, used * k, (up // c) * c)
        best = max(best, -(-int((value * n).sum()) // (k * c)))
    long = 2 * used > c
    for step in used[~long]:  # phi, scaled by c // step
        most = c // int(step)
        value = np.where(long, most - (c - used) // step, (used >= step).astype(np.int64))
        best = max(best, -(-int((value * n).sum()) // most))
    return int(best)


def opened(gaps: np.ndarray, bound: int, capacity: int) -> np.ndarray:
    """Which sequences of a partition give their pieces to the exchange."""
    out = np.zeros(len(gaps), bool)
    order = np.argsort(-gaps, kind="stable")
    surplus = len(gaps) - bound
    room = np.cumsum(gaps[order])
    need = 1 if surplus <= 0 else int(np.searchsorted(room, (surplus + 1) * capacity)) + 1
    out[order[:need]] = True
    return out & (gaps > 0)


# ---------------------------------------------------------------- rounds over all partitions
def _materialise(df: DataFrame, name: str) -> DataFrame:
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _round(items: DataFrame, number: int, n: int, capacity: int, group: int, kind: str) -> DataFrame:
    """``items`` dealt to partitions and packed; ``open`` marks the pieces that go to the exchange."""
    groups = -(-n // group)

    def pack(table: pa.Table) -> pa.Table:
        table = table.sort_by([("rid", "ascending")])
        lengths = table.column("length").to_numpy()
        bins, offset, gaps = best_fit_decreasing(lengths, capacity)
        bound = lower_bound(np.bincount(lengths, minlength=capacity + 1))
        give = opened(gaps, bound, capacity) if groups > 1 else np.zeros(len(gaps), bool)
        g = table.column("g")[0].as_py()
        head = np.arange(len(lengths)) == 0  # one row a partition carries its figures
        values = {
            "sequence_id": (number << 56) + (g << 20) + bins,
            "offset": offset, "open": give[bins], "head": head,
            "bins": np.full(len(lengths), len(gaps)), "bound": np.full(len(lengths), bound), "given": np.full(len(lengths), int(give.sum())),
        }
        out = table.select([*columns])
        for name, value in values.items():
            out = out.append_column(name, pa.array(value))
        return out

    columns = ["key", "piece", "start", "length", "ids_crc32", "rid"]
    ddl = f"key {kind}, {PIECE}, rid bigint, sequence_id bigint, offset bigint, open boolean, head boolean, bins bigint, bound bigint, given bigint"
    dealt = items.select(*columns).withColumn("g", F.pmod(F.xxhash64(F.lit(number), "rid"), F.lit(groups)))
    return dealt.groupBy("g").applyInArrow(pack, ddl)


def pack(cut_pieces: DataFrame, *, capacity: int = CAPACITY, group: int = GROUP, rounds: int = ROUNDS) -> tuple[DataFrame, list[dict]]:
    """``cut_pieces`` (``key``, ``piece``, ``start``, ``length``, ``ids_crc32``) with ``sequence_id`` and ``offset``,
    and one report a round: pieces, partitions, certified partitions, sequences, and those given to the exchange."""
    if group > 1 << 20:
        raise ValueError("a partition holds at most 2**20 pieces")
    table = _materialise(cut_pieces.withColumn("rid", F.monotonically_increasing_id()), "packing-pieces")
    kind = table.schema["key"].dataType.simpleString()
    out = ["key", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    full = F.col("length") == capacity
    done = table.where(full).withColumns({"sequence_id": -F.col("rid") - 1, "offset": F.lit(0).cast("bigint")}).select(*out)
    items = table.where(~full)
    n, before, kept, reports = items.count(), None, None, []
    for number in range(1, rounds + 1):
        if not n:
            break
        packed = _materialise(_round(items, number, n, capacity, group, kind), f"packing-round-{number}")
        r = packed.agg(
            F.count_if("head").alias("partitions"), F.count_if(F.col("head") & (F.col("bins") == F.col("bound"))).alias("certified"),
            F.sum(F.when(F.col("head"), F.col("bins"))).alias("sequences"), F.sum(F.when(F.col("head"), F.col("given"))).alias("given"),
            F.count_if("open").alias("open"),
        ).first()
        reports.append({"pieces": n, **{k: r[k] for k in ("partitions", "certified", "sequences", "given")}})
        if before is not None and r["sequences"] >= before:
            done = done.unionByName(kept)  # the exchange saved nothing: the sequences stay as they were
            n = 0
            break
        done = done.unionByName(packed.where(~F.col("open")).select(*out))
        kept = packed.where("open").select(*out)
        items, n, before = packed.where("open"), r["open"], r["given"]
    if n and kept is not None:
        done = done.unionByName(kept)
    return done, reports


def sequences(placed: DataFrame, ids: DataFrame) -> DataFrame:
    """The packed rows themselves: (sequence_id, ids), ids as unsigned little-endian 32-bit numbers, from
    ``placed`` and ``pieces(..., with_ids=True)`` of a table whose ids are unique."""
    joined = placed.select("key", "piece", "sequence_id", "offset").join(ids.select("key", "piece", "ids"), ["key", "piece"])
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))  # at most ``capacity`` pieces a sequence
    joint = F.aggregate(parts, F.lit(b"").cast("binary"), lambda a, p: F.concat(a, p["ids"]))
    return joined.groupBy("sequence_id").agg(joint.alias("ids"))


def op13_packing(spark, sf_dir) -> DataFrame:
    """Place of every piece of every document in sequences of at most 2048 ids."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    placed, _ = pack(pieces(docs))
    return placed.withColumnRenamed("key", "doc_id")
