"""Byte-level BPE encoding and decoding with a given vocabulary.

A piece of text is a doubly linked list of symbols. A priority queue holds the merges that
could be made, by rank, then position; an entry whose symbols have changed since is stale and
skipped. Decoding concatenates the byte strings of the vocabulary.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from chatlog.llm.workers import map_texts

# How this kind of vocabulary cuts text, in general and for plain ASCII.
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")
ASCII_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\t-\r A-Za-z0-9]+|[\t-\r ]+(?![^\t-\r ])|[\t-\r ]+")
#: Pieces up to this many characters are remembered, this many of them per worker.
KEEP_CHARS, KEEP_PIECES = 40, 250_000


def _byte_symbols() -> list[str]:
    """The character that stands for each byte: itself if printable, else one from U+0100 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    stand_ins = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(stand_ins)) for b in range(256)]


class Codec:
    def __init__(self, spec: str):
        spec = json.loads(spec)
        model = spec["model"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        symbols = _byte_symbols()
        byte_of = {s: b for b, s in enumerate(symbols)}
        ids = model["vocab"]
        self.first = [ids[s] for s in symbols]
        pairs = (m if isinstance(m, list) else m.split(" ", 1) for m in model["merges"])
        self.merges = {(ids[a], ids[b]): (rank, ids[a + b]) for rank, (a, b) in enumerate(pairs)}
        self.strings = [b""] * (1 + max(chain(ids.values(), self.special.values())))
        for token, i in ids.items():
            self.strings[i] = bytes(byte_of[c] for c in token)
        for token, i in self.special.items():
            self.strings[i] = token.encode()
        longest_first = sorted(self.special, key=len, reverse=True)
        self.cut = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if self.special else None
        self.known: dict[str, bytes] = {}

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one piece."""
        ids, merges = [self.first[b] for b in piece], self.merges
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue = []
        for i in range(n - 1):
            if found := merges.get((ids[i], ids[i + 1])):
                queue.append((found[0], i, ids[i], ids[i + 1]))
        heapify(queue)
        while queue:
            _, i, a, b = heappop(queue)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue  # stale: one of the two has been merged since
            ids[i], ids[j] = merges[a, b][1], -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if found := merges.get((ids[i], ids[k])):
                    heappush(queue, (found[0], i, ids[i], ids[k]))
            h = before[i]
            if h >= 0 and (found := merges.get((ids[h], ids[i]))):
                heappush(queue, (found[0], h, ids[h], ids[i]))
        return [i for i in ids if i >= 0]

    def _piece(self, piece: str) -> bytes:
        packed = np.array(self.merge(piece.encode()), "<u4").tobytes()
        if len(piece) <= KEEP_CHARS:
            if len(self.known) >= KEEP_PIECES:
                self.known.clear()
            self.known[piece] = packed
        return packed

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        out, known = [], self.known
        parts = self.cut.split(text) if self.cut else [text]
        for at, part in enumerate(parts):
            if at % 2:
                out.append(np.uint32(self.special[part]).astype("<u4").tobytes())
                continue
            pieces = (ASCII_PIECES if part.isascii() else PIECES).findall(part)
            out.extend([known.get(p) or self._piece(p) for p in pieces])
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        strings = self.strings
        return b"".join([strings[i] for i in np.frombuffer(ids, "<u4").tolist()]).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def codec(spec: str) -> Codec:
    """One per worker process and vocabulary."""
    return Codec(spec)


def encode_decode(docs: DataFrame, vocab_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document row: id, ids (packed little-endian unsigned 32-bit), decoded.

    The strings of special tokens count as those tokens; none is added. Null text is empty, and
    the empty text has no ids. Rows are independent: repeated rows, null ids and any other
    column make no difference. Nothing is shuffled; the vocabulary file, of a fixed size, is
    read by the driver and sent to each worker once.
    """
    with open(vocab_path, encoding="utf-8") as file:
        spec = docs.sparkSession.sparkContext.broadcast(file.read())

    def make():
        own = codec(spec.value)

        def work(texts: list[str]) -> list[pa.Array]:
            ids = [own.encode(t) for t in texts]
            return [pa.array(ids, pa.binary()), pa.array([own.decode(i) for i in ids], pa.string())]

        return work

    rows = docs.select(F.col(id_col), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_coded_text"))
    return map_texts(rows, make, "ids binary, decoded string")


def digests(encoded: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """n_tokens, ids_sha256 and decoded_sha256 of `encode_decode`'s rows."""
    return encoded.select(
        id_col, (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
