"""BPE encoding and decoding with content-defined chunk reuse.

A rolling hash over the text's bytes sets chunk boundaries that depend only on the bytes near them,
so a passage shared by documents falls into the same chunks wherever it stands. A chunk is encoded
once per task and kept in a bounded cache: its inner words as final ids, its first and last runs of
non-space characters open. Joining chunks repairs the boundary: the run that spans a join is taken
from both sides and re-encoded. No token of the vocabulary crosses ASCII white space (the
tokenizer's splitter drops it), so such a run is the smallest piece on which separate and whole
encoding agree exactly; the tests compare with the tokenizers library.

Documents are only mapped: nothing is shuffled, and memory is one Arrow batch plus the two caches.

Defined results: null text counts as empty; empty text has no ids; special-token strings inside a
text are encoded as the library does; repeated rows give equal results; long texts are encoded whole.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestrata.llm.common import fresh, text_column, text_map

VOCABULARY = "word_bpe_49k.json"
CHUNK_BITS = 9  # about 2**9 bytes a chunk
WORD_CACHE = 16 << 20  # bytes of entries in half of the word cache, and of the chunk cache
CHUNK_CACHE = 4 << 20
PORTION = 1 << 18  # characters of texts encoded together
CALL_WORDS = 1024  # words in one call of the library: its results are far larger than the ids kept of them
ENTRY = 300  # bytes that an entry's objects take besides their characters
_STOPS = frozenset(b".,")
_LETTERS = frozenset(range(97, 123))
_DDL = "n_tokens bigint, ids string, decoded string"


class Cache:
    """A map bounded in bytes: when the young half is full it becomes the old half, whose entries are
    dropped unless they were used again. ``size`` gives an entry's characters."""

    def __init__(self, limit: int, size):
        self.limit, self.size, self.held, self.young, self.old = limit, size, 0, {}, {}

    def get(self, key):
        value = self.young.get(key)
        if value is None:
            value = self.old.get(key)
            if value is not None:
                self.put(key, value)
        return value

    def put(self, key, value) -> None:
        if self.held >= self.limit:
            self.old, self.young, self.held = self.young, {}, 0
        self.young[key] = value
        self.held += ENTRY + len(key) + self.size(value)


def portions(texts: list[str | None], limit: int = PORTION) -> Iterator[list[str | None]]:
    """``texts`` in order, in lists of about ``limit`` characters: only the words of one list are held apart from the caches."""
    part, held = [], 0
    for text in texts:
        part.append(text)
        held += len(text or "")
        if held >= limit:
            yield part
            part, held = [], 0
    if part:
        yield part


def cut_points(data: bytes, bits: int = CHUNK_BITS) -> list[int]:
    """Ends of the content-defined chunks of ``data`` (UTF-8), the last being its length."""
    n = len(data)
    if n < 32:
        return [n] if n else []
    b = np.frombuffer(data, np.uint8)
    h = b.astype(np.uint32) * np.uint32(2654435761) + np.uint32(40503)
    h ^= h >> np.uint32(15)
    factor = 0x01000193
    for span in (1, 2, 4, 8):  # after these steps h[i] covers bytes i-15 .. i
        power = np.uint32(pow(factor, span, 1 << 32))
        rolled = h.copy()
        rolled[span:] += h[:-span] * power
        h = rolled
    h ^= h >> np.uint32(16)
    cut = (h & np.uint32((1 << bits) - 1)) == 0
    cut[:15] = False
    ends = np.flatnonzero(cut) + 1
    ends = ends[ends < n]
    ends = ends[(b[ends] & 0xC0) != 0x80]  # not inside a character
    return [*ends.tolist(), n]


# The splitter whose pieces hold no white space, and part full stops and commas from letters (fixed value).
_SPLITTER = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def check_tokenizer(spec: dict) -> bool:
    """Whether the tokenizer lowers its text; raises if chunks could not be joined exactly under it."""
    normalizer = spec.get("normalizer") or {}
    steps = normalizer.get("normalizers", [normalizer] if normalizer else [])
    blank = {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}
    if any(n.get("type") not in ("NFC", "Lowercase") and n != blank for n in steps):
        raise ValueError("the tokenizer's normalizer is not one of NFC, white space and lower case")
    split = spec.get("pre_tokenizer") or {}
    parts = split.get("pretokenizers", [split])
    first = parts[0]
    cuts = first.get("type") == "Split" and first.get("pattern") == {"Regex": _SPLITTER} and first.get("invert") and first.get("behavior") == "Removed"
    plain = [p.get("type") == "ByteLevel" and not p.get("add_prefix_space") and not p.get("use_regex") for p in parts[1:]]
    if not cuts or not all(plain) or spec.get("decoder") or any("<|" not in t["content"] for t in spec.get("added_tokens", [])):
        raise ValueError("the tokenizer does not drop white space between its pieces; its texts cannot be joined from chunks")
    return any(n.get("type") == "Lowercase" for n in steps)


class ChunkCoder:
    """Encodes texts chunk by chunk; the caches hold chunks and words and live as long as the coder."""

    def __init__(self, path: str, bits: int = CHUNK_BITS, words: int = WORD_CACHE, chunks: int = CHUNK_CACHE):
        self.tok = _tokenizer(path)
        self.lowers = check_tokenizer(json.loads(self.tok.to_str()))
        self.bits = bits
        self.words = Cache(words, lambda pair: len(pair[0]) + len(pair[1]))
        self.chunks = Cache(chunks, lambda e: sum(len(x) for x in e if x))
        self.encoded = 0  # chunks encoded, not found
        size = max(self.tok.get_vocab(with_added_tokens=True).values()) + 1
        self.number = [str(i) for i in range(size)]
        # the file has no decoder, so the library decodes to the tokens joined by one space
        self.piece = [self.tok.id_to_token(i) or "" for i in range(size)]

    def _learn(self, words: set[bytes]) -> dict[bytes, tuple[str, str]]:
        """ids and decoded text of each word."""
        known, missing = {}, []
        for w in words:
            got = self.words.get(w)
            if got is None:
                missing.append(w)
            else:
                known[w] = got
        number, piece = self.number, self.piece
        for at in range(0, len(missing), CALL_WORDS):
            words = missing[at : at + CALL_WORDS]
            texts = [w.decode("utf-8") for w in words]
            for w, enc in zip(words, self.tok.encode_batch_fast(texts, add_special_tokens=False), strict=True):
                ids = enc.ids
                pair = (" ".join([number[i] for i in ids]), " ".join([piece[i] for i in ids]))
                known[w] = pair
                self.words.put(w, pair)
        return known

    def code(self, texts: list[str | None]) -> list[tuple[int, str, str]]:
        """(number of ids, ids, decoded text) of each text; each of their words is looked up once."""
        plans, need, fresh_chunks = [], set(), {}
        for text in texts:
            data = (text or "").encode("utf-8")
            if self.lowers and b"<|" not in data:  # the tokenizer lowers all but its special tokens
                data = data.lower()
            parts, carry, at = [], b"", 0
            for end in cut_points(data, self.bits):
                chunk = data[at:end]
                at = end
                entry = self.chunks.get(chunk) or fresh_chunks.get(chunk)
                if entry is None:
                    entry = self._open(chunk)
                    fresh_chunks[chunk] = entry
                    need.update(entry[1] if isinstance(entry[1], list) else ())
                    self.encoded += 1
                head, inner, tail = entry[:3]
                if tail is None:  # no white space: the run goes on
                    carry += head
                    continue
                carry += head
                if carry:
                    need.add(carry)
                    parts.append(carry)
                parts.append((chunk, entry))
                carry = tail
            if carry:
                need.add(carry)
                parts.append(carry)
            plans.append(parts)
        known = self._learn(need)
        closed = {c: self._close(e, known) for c, e in fresh_chunks.items()}
        for c, e in closed.items():
            self.chunks.put(c, e)
        out = []
        for parts in plans:
            ids, decoded = [], []
            for part in parts:
                if isinstance(part, bytes):
                    a, b = known[part]
                else:
                    chunk, entry = part
                    _, _, _, a, b = closed.get(chunk) or entry
                if a:
                    ids.append(a)
                    decoded.append(b)
            joined = " ".join(ids)
            out.append((joined.count(" ") + 1 if joined else 0, joined, " ".join(decoded)))
        return out

    @staticmethod
    def _open(chunk: bytes) -> tuple:
        """(first run, inner words, last run); a chunk without white space is (chunk, [], None)."""
        words = chunk.split()
        if not words:
            return (b"", [], b"")
        lead, trail = chunk[:1].isspace(), chunk[-1:].isspace()
        if len(words) == 1 and not lead and not trail:
            return (chunk, [], None)
        head = b"" if lead else words.pop(0)
        tail = b"" if trail or not words else words.pop()
        inner = []
        for w in words:  # full stops and commas after an ASCII letter are pieces of their own
            if w[-1] in _STOPS and len(w) > 1 and w[-2] in _LETTERS:
                inner.append(w[:-1])
                inner.append(w[-1:])
            else:
                inner.append(w)
        return (head, inner, tail)

    @staticmethod
    def _close(entry: tuple, known: dict) -> tuple:
        head, inner, tail = entry
        pairs = [known[w] for w in inner]
        return (
            head,
            (),
            tail,
            " ".join(a for a, _ in pairs if a),
            " ".join(b for a, b in pairs if a),
        )


_TOKENIZERS: dict = {}


def _tokenizer(path: str):
    """The tokenizer of a file, loaded once per Python worker (of fixed size, unlike a coder's caches)."""
    from tokenizers import Tokenizer

    if path not in _TOKENIZERS:
        tok = Tokenizer.from_file(path)
        tok.no_truncation()
        tok.no_padding()
        _TOKENIZERS[path] = tok
    return _TOKENIZERS[path]


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def bpe_code(
    docs: DataFrame,
    path: str | None = None,
    *,
    text_col: str = "text",
    bits: int = CHUNK_BITS,
    out: str = "bpe",
) -> DataFrame:
    """``docs`` plus struct ``out``: ``n_tokens``, ``ids`` (decimal, joined by one space) and
    ``decoded``. ``path`` is the tokenizer file on every machine; without it each worker takes the
    installed vocabulary. A tokenizer whose pieces can hold white space is refused (ValueError)."""

    def factory():
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        coder = ChunkCoder(path or vocabulary_path(), bits)  # its caches go with the task

        def arrow(texts):
            coded = coder.code(texts)
            return pa.StructArray.from_arrays(
                [
                    pa.array([c[0] for c in coded], pa.int64()),
                    pa.array([c[1] for c in coded], pa.string()),
                    pa.array([c[2] for c in coded], pa.string()),
                ],
                names=["n_tokens", "ids", "decoded"],
            )

        return lambda texts: pa.concat_arrays([arrow(part) for part in portions(texts)] or [arrow([])])

    return docs.withColumn(out, text_map(_DDL, factory)(text_column(docs, text_col)))


def op9_bpe(spark, sf_dir) -> DataFrame:
    """Token count and digests of the ids and of the decoded text of every document."""
    from lakestrata.llm.common import read

    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe_code(docs, out="r")
    return coded.select(
        "doc_id",
        "r.n_tokens",
        F.sha2(F.col("r.ids"), 256).alias("ids_sha256"),
        F.sha2(F.col("r.decoded"), 256).alias("decoded_sha256"),
    )


def stage(spark, docs, sf_dir) -> DataFrame:
    """Last pipeline stage: the documents with their ids (space-joined), count and decoded digest.

    An earlier column called ``n_tokens``, ``token_ids`` or ``decoded_sha256`` is replaced."""
    out = fresh(docs, "_bpe")
    coded = bpe_code(docs, out=out)
    return (
        coded.withColumn("n_tokens", F.col(f"{out}.n_tokens"))
        .withColumn("token_ids", F.col(f"{out}.ids"))
        .withColumn("decoded_sha256", F.sha2(F.col(f"{out}.decoded"), 256))
        .drop(out)
    )
