"""Byte-level BPE: encoding with a priority queue of merge ranks, decoding by concatenated vocabulary strings."""

from __future__ import annotations

import codecs
import gc
import hashlib
import heapq
import json
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import accumulate, pairwise

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from stratum.llm.common import fresh

#: Fixed value: the public byte-level pattern that cuts a text into pieces; no merge crosses a cut.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: A text is worked through in slices of about so many characters, and results leave a task in batches of about so many ids.
SLICE, BATCH_IDS = 1 << 20, 1 << 22
#: A worker remembers up to twice so many pieces, none longer than the second number.
CACHE, CACHE_CHARS = 200_000, 64


class Kinds(dict):
    """Code point -> an ASCII character of the same kind for the pattern (letter, number, white space, other); ASCII stays."""

    SAMPLES = {r"\p{L}": "a", r"\p{N}": "0", r"\s": "\t"}

    def __missing__(self, cp: int) -> str:
        c = chr(cp)
        kind = next((s for k, s in self.SAMPLES.items() if regex.match(k, c)), "!") if cp > 127 else c
        self[cp] = kind
        return kind


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary: itself, or the next one from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b if b in plain else next(spare)) for b in range(256)]


@dataclass(frozen=True, eq=False)
class Vocabulary:
    """A vocabulary file's contents: a fixed public table, of bounded size whatever the corpus; equal if read from equal files."""
    tokens: dict[str, int]
    merges: list[tuple[str, str]]
    added: dict[str, int]
    digest: str

    def __eq__(self, other) -> bool:
        return isinstance(other, Vocabulary) and self.digest == other.digest

    def __hash__(self) -> int:
        return hash(self.digest)

    @classmethod
    def read(cls, path: str) -> Vocabulary:
        """Reads a byte-level BPE file; raises ValueError for a kind of tokenizer that works otherwise."""
        with open(path, "rb") as f:
            data = f.read()
        spec = json.loads(data.decode("utf-8"))
        model, pre = spec["model"], spec.get("pre_tokenizer") or {}
        plain = (model.get("type", "BPE") == "BPE" and not spec.get("normalizer") and pre.get("type") == "ByteLevel"
                 and pre.get("use_regex", True) and not pre.get("add_prefix_space")
                 and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges",
                                                    "byte_fallback")))
        added = spec.get("added_tokens", [])
        if not plain or any(a.get(k) for a in added for k in ("single_word", "lstrip", "rstrip")):
            raise ValueError(f"{path}: not a plain byte-level BPE file")
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        return cls(model["vocab"], merges, {a["content"]: a["id"] for a in added}, hashlib.sha256(data).hexdigest())


class Tokenizer:
    """Encodes texts; word pieces are remembered in two generations, so that frequent ones stay."""

    def __init__(self, vocabulary: Vocabulary):
        letters, tokens = byte_letters(), vocabulary.tokens
        self.first = [tokens[c] for c in letters]
        self.size = max([*tokens.values(), *vocabulary.added.values()]) + 1
        pairs = [tokens[a] * self.size + tokens[b] for a, b in vocabulary.merges]
        self.rank = {pair: rank for rank, pair in enumerate(pairs)}
        self.pair, self.made = pairs, [tokens[a + b] for a, b in vocabulary.merges]
        self.added = vocabulary.added
        self.special = (regex.compile("(" + "|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))) + ")")
                        if self.added else None)
        # on text whose other characters stand in by their kind, ASCII classes do
        ascii_pattern = PATTERN.replace(r"[^\s\p{L}\p{N}]", r"[^\sA-Za-z0-9]").replace(r"\p{L}", "[A-Za-z]").replace(r"\p{N}", "[0-9]")
        self.pattern = re.compile(ascii_pattern, re.ASCII)
        self.kinds, self.gap = Kinds(), regex.compile(r"(?<=\S)\s")
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def merge(self, data: bytes) -> list[int]:
        """The ids of one piece.

        Symbols form a doubly linked list.  A heap holds (rank, position), in
        one number, of every adjacent pair that may merge; an entry whose pair
        is no longer at its position is stale and skipped.  The lowest rank
        goes first, of equal ranks the leftmost.
        """
        size, rank_of, pair, made, push, pop = self.size, self.rank.get, self.pair, self.made, heapq.heappush, heapq.heappop
        sym = list(map(self.first.__getitem__, data))
        n = len(sym)
        heap = [r * n + i for i, (a, b) in enumerate(pairwise(sym)) if (r := rank_of(a * size + b)) is not None]
        if not heap:
            return sym
        heapq.heapify(heap)
        left, right = list(range(-1, n - 1)), [*range(1, n), -1]
        while heap:
            rank, i = divmod(pop(heap), n)
            j = right[i]
            if j < 0 or sym[i] * size + sym[j] != pair[rank]:
                continue
            sym[i] = new = made[rank]
            sym[j] = -1                              # no entry at j matches any more
            after = right[i] = right[j]
            if after >= 0:
                left[after] = i
                if (r := rank_of(new * size + sym[after])) is not None:
                    push(heap, r * n + i)
            before = left[i]
            if before >= 0 and (r := rank_of(sym[before] * size + new)) is not None:
                push(heap, r * n + before)
        return [s for s in sym if s >= 0]

    def pieces(self, text: str) -> list[str]:
        """``text`` cut by the pattern."""
        if text.isascii():
            return self.pattern.findall(text)
        ends = accumulate(map(len, self.pattern.findall(text.translate(self.kinds))), initial=0)
        return [text[a:b] for a, b in pairwise(ends)]

    def piece(self, text: str) -> bytes:
        """The ids of one piece as packed 32-bit integers."""
        ids = self.young.get(text)
        if ids is None:
            ids = self.old.get(text)
            if ids is None:
                ids = array("i", self.merge(text.encode("utf-8", "surrogatepass"))).tobytes()
            if len(text) <= CACHE_CHARS:
                if len(self.young) >= CACHE:
                    self.young, self.old = {}, self.young
                self.young[text] = ids
        return ids

    def slices(self, text: str) -> Iterator[str]:
        """``text`` in slices cut only before white space that follows something else: pieces never cross such a place."""
        start = 0
        while len(text) - start > SLICE:
            m = self.gap.search(text, start + SLICE)
            if m is None:
                break
            yield text[start:m.start()]
            start = m.start()
        yield text[start:]

    def encode(self, text: str | None) -> np.ndarray:
        """The ids of a text; added tokens' strings become their ids, as the library's default has it."""
        out = []
        for i, part in enumerate(self.special.split(text or "") if self.special else [text or ""]):
            if i % 2:
                out.append(np.array([self.added[part]], np.int32).tobytes())
            else:
                for s in self.slices(part):
                    out.append(b"".join(map(self.piece, self.pieces(s))))
        return np.frombuffer(b"".join(out), np.int32)


class Decoder:
    """Turns ids back into text."""

    def __init__(self, vocabulary: Vocabulary):
        byte_of = {c: b for b, c in enumerate(byte_letters())}
        self.bytes = {i: bytes(byte_of[c] for c in t) if all(c in byte_of for c in t) else t.encode()
                      for t, i in [*vocabulary.tokens.items(), *vocabulary.added.items()]}

    def decode(self, ids: np.ndarray) -> str:
        """Concatenated vocabulary strings, as UTF-8; broken bytes become U+FFFD and unknown ids nothing."""
        reader, out, known = codecs.getincrementaldecoder("utf-8")("replace"), [], self.bytes
        for i in range(0, len(ids), SLICE):
            out.append(reader.decode(b"".join(known.get(t, b"") for t in ids[i:i + SLICE].tolist())))
        return "".join(out) + reader.decode(b"", True)


@lru_cache(maxsize=1)
def tokenizer(vocabulary: Vocabulary) -> Tokenizer:
    """One tokenizer per worker process: what it remembers serves later tasks and, with an equal vocabulary, later queries too."""
    made = Tokenizer(vocabulary)
    gc.freeze()                                      # its tables need no looking through at every collection
    return made


@lru_cache(maxsize=1)
def decoder(vocabulary: Vocabulary) -> Decoder:
    return Decoder(vocabulary)


def shared(spark: SparkSession, path: str):
    """The vocabulary file at ``path``, read by the driver and broadcast (its size is the file's, not the corpus's)."""
    return spark.sparkContext.broadcast(Vocabulary.read(path))


def encode(docs: DataFrame, vocabulary, text_col: str = "text", out: str = "ids", keep: list[str] | None = None) -> DataFrame:
    """``docs`` with the array column ``out`` (int): the token ids of each whole text, by ``vocabulary`` from ``shared``.

    ``keep`` names the columns of ``docs`` to carry along (all of them if None).

    One map-side step: no row moves, none is dropped, repeated rows stay
    repeated.  Null and empty texts have no ids.  Other columns pass through;
    one named like ``out`` is replaced.  A text is worked through in slices cut
    at white space, so beside the text and its ids a task holds one slice's
    pieces; one run without white space is one slice.
    """
    keep = [c for c in (docs.columns if keep is None else keep) if c.lower() != out.lower()]
    text = fresh(keep, "_text")
    rows = docs.select(*keep, F.col(text_col).alias(text))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokenizer(vocabulary.value)
        for b in batches:
            at, held, size = 0, [], 0

            def batch():
                values = pa.array(np.concatenate(held) if held else np.zeros(0, np.int32), pa.int32())
                ends = pa.array(np.cumsum([0, *map(len, held)]), pa.int32())
                rest = b.slice(at, len(held)).select(keep)
                return pa.RecordBatch.from_arrays([*rest.columns, pa.ListArray.from_arrays(ends, values)], names=[*keep, out])

            for t in b.column(text):
                held.append(tok.encode(t.as_py()))
                size += len(held[-1])
                if size >= BATCH_IDS:
                    yield batch()
                    at, held, size = at + len(held), [], 0
            if held:
                yield batch()

    schema = docs.select(*keep).schema.add(out, ArrayType(IntegerType()))
    return rows.mapInArrow(run, schema)


def decode(rows: DataFrame, vocabulary, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """``rows`` with the string column ``out``: the text that the ids stand for, special tokens included.

    One map-side step.  Null ids give an empty text, unknown ids nothing.
    Other columns pass through; one named like ``out`` is replaced.
    """
    keep = [c for c in rows.columns if c.lower() != out.lower()]
    schema = rows.select(*keep).schema.add(out, "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = decoder(vocabulary.value)
        none = np.zeros(0, np.int32)
        for b in batches:
            col = b.column(ids_col)
            at, held, size = 0, [], 0

            def batch():
                rest = b.slice(at, len(held)).select(keep)
                return pa.RecordBatch.from_arrays([*rest.columns, pa.array(held, pa.string())], names=[*keep, out])

            for x in col:
                x = x.values
                ids = none if x is None else x.to_numpy(zero_copy_only=False)
                held.append(tok.decode(ids))
                size += len(ids)
                if size >= BATCH_IDS:
                    yield batch()
                    at, held, size = at + len(held), [], 0
            if held:
                yield batch()

    return rows.mapInArrow(run, schema)


def digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_tokens, ids_sha256, decoded_sha256 of its encoded and decoded again text; rules as in ``encode``."""
    vocabulary = shared(docs.sparkSession, path)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    both = decode(encode(rows, vocabulary, keep=["doc_id"]), vocabulary)
    listed = F.array_join(F.col("ids").cast("array<string>"), ",")
    return both.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(listed.cast("binary"), 256).alias("ids_sha256"),
                       F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
