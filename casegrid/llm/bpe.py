"""Byte-level BPE: a minimal perfect hash for whole pre-tokens, a heap for the rest.

Tier one resolves a pre-token that is itself in the vocabulary: one hash, one
displacement, one comparison.  Tier two merges the bytes of any other pre-token:
a linked list of parts, and a heap of neighbouring pairs by rank and position.
Merges work on integers: one table names the token that two ids make.  Both
tiers write through a bounded cache of packed ids, which a worker process keeps
from task to task with the encoder.  The vocabulary, a fixed file, is the only
thing broadcast; its hash is built once a driver.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import struct
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Memo, kept_value, share_kept

#: Keys per bucket of the hash.
BUCKET = 2
#: Distinct pre-tokens whose ids a worker process keeps (twice: this generation and the last),
#: and the longest one that is kept.
CACHE = 250_000
KEPT_LENGTH = 64
#: Longest text whose pre-tokens are listed at once; longer ones go by slices of this many.
LISTED = 1 << 20
SLICE = 1 << 16


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and rank of a .tiktoken file, read on the driver."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


@lru_cache(maxsize=4)
def perfect_hash(path: str) -> PerfectHash:
    """Hash of a vocabulary file, built once in the life of a driver."""
    return PerfectHash(list(read_ranks(path)))


def _hash(key: bytes) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(key)


class PerfectHash:
    """Minimal perfect hash by displacement: n keys, n slots.

    Buckets are placed from the largest on, each with the first displacement that
    hits free slots only; buckets of one key take the free slots that are left,
    named directly as a negative number.
    """

    def __init__(self, keys: list[bytes]):
        n = len(keys)
        self.n, self.buckets = n, max(1, -(-n // BUCKET))
        shift = np.zeros(self.buckets, np.int64)
        slots: list[bytes | None] = [None] * n
        by_bucket: dict[int, list[tuple[int, bytes]]] = {}
        for key in keys:
            h = _hash(key)
            by_bucket.setdefault(h % self.buckets, []).append((h, key))
        single = []
        for bucket, held in sorted(by_bucket.items(), key=lambda x: -len(x[1])):
            if len(held) == 1:
                single.append((bucket, held[0][1]))
                continue
            for d in range(1 << 24):
                at = [self._slot(h, d) for h, _ in held]
                if len(set(at)) == len(at) and all(slots[x] is None for x in at):
                    break
            else:
                raise ValueError("two keys have one hash")
            shift[bucket] = d
            for x, (_, key) in zip(at, held, strict=True):
                slots[x] = key
        free = (x for x in range(n) if slots[x] is None)
        for (bucket, key), x in zip(single, free, strict=False):
            shift[bucket] = -x - 1
            slots[x] = key
        self.shift, self.slots = shift.tolist(), slots

    def _slot(self, h: int, d: int) -> int:
        x = (h ^ (d * 0x9E3779B97F4A7C15)) * 0xFF51AFD7ED558CCD & 0xFFFFFFFFFFFFFFFF
        return (x >> 24) % self.n

    def find(self, key: bytes) -> int:
        """Slot of a key of the table, -1 for any other."""
        if not self.n:
            return -1
        h = _hash(key)
        d = self.shift[h % self.buckets]
        slot = -d - 1 if d < 0 else self._slot(h, d)
        return slot if self.slots[slot] == key else -1


def pair_table(ranks: dict[bytes, int]) -> dict[int, int]:
    """Left id and right id, packed into one integer, to the id of the token they make."""
    table = {}
    for token, made in ranks.items():
        for cut in range(1, len(token)):
            left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
            if left is not None and right is not None:
                table[left << 32 | right] = made
    return table


def merge_ids(ids: list[int], pairs: dict[int, int]) -> list[int]:
    """Merge the ids of single bytes: always the lowest rank first, the leftmost of equals.

    A heap entry is a rank and the position of the left part in one integer; it
    is stale unless the two parts that stand there now still make that rank.
    """
    n = len(ids)
    find, push, pop = pairs.get, heapq.heappush, heapq.heappop
    heap = [
        made << 32 | i for i in range(n - 1) if (made := find(ids[i] << 32 | ids[i + 1])) is not None
    ]
    if not heap:
        return ids
    heapq.heapify(heap)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    parts = [*ids, -1]  # -1: merged into its left neighbour, or the end
    while heap:
        entry = pop(heap)
        made, i = entry >> 32, entry & 0xFFFFFFFF
        middle = after[i]
        left, right = parts[i], parts[middle]
        if left < 0 or right < 0 or find(left << 32 | right) != made:
            continue
        parts[i], parts[middle] = made, -1
        end = after[i] = after[middle]
        if end < n:
            before[end] = i
            if (new := find(made << 32 | parts[end])) is not None:
                push(heap, new << 32 | i)
        start = before[i]
        if start >= 0 and (new := find(parts[start] << 32 | made)) is not None:
            push(heap, new << 32 | start)
    return [part for part in parts if part >= 0]


class Encoder:
    """Pre-token -> ids packed as little-endian unsigned 32-bit integers, through a bounded cache."""

    def __init__(self, ranks: dict[bytes, int], table: PerfectHash, pattern: str):
        import regex

        self.ranks, self.table = ranks, table
        self.pairs = pair_table(ranks)
        self.byte_ids = [ranks[bytes([b])] for b in range(256)]
        self.slot_ids = [ranks[key] for key in table.slots]
        self.split = regex.compile(pattern)
        self.vocabulary = {rank: token for token, rank in ranks.items()}
        self.words = Memo(self._word, CACHE, lambda word: len(word) <= KEPT_LENGTH)

    def _word(self, word: str) -> bytes:
        data = word.encode("utf-8", "surrogatepass")
        slot = self.table.find(data)
        if slot >= 0:
            ids = [self.slot_ids[slot]]
        else:
            ids = merge_ids([self.byte_ids[b] for b in data], self.pairs)
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str) -> bytes:
        find = self.words.__getitem__
        if len(text) <= LISTED:
            return b"".join(map(find, self.split.findall(text)))
        words, out = (m.group() for m in self.split.finditer(text)), []
        while part := b"".join(map(find, islice(words, SLICE))):
            out.append(part)
        return b"".join(out)

    def decode(self, packed: bytes) -> bytes:
        ids = np.frombuffer(packed, "<u4")
        return b"".join(
            b"".join(map(self.vocabulary.__getitem__, ids[i : i + SLICE].tolist()))
            for i in range(0, len(ids), SLICE)
        )


def _kernel(shared, pattern: str, with_ids: bool):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = kept_value(shared, lambda value: Encoder(*value, pattern))
        for batch in batches:
            rows = []
            for doc, text in zip(batch["doc_id"], batch["text"], strict=True):
                packed = encoder.encode(text or "")
                decoded = encoder.decode(packed)
                rows.append((
                    doc, len(packed) // 4, hashlib.sha256(packed).hexdigest(),
                    hashlib.sha256(decoded).hexdigest(), *((packed, decoded) if with_ids else ()),
                ))
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", *(("ids", "decoded") if with_ids else ())]
            out = pd.DataFrame(rows, columns=names)
            out["doc_id"] = batch["doc_id"].to_numpy()
            yield out

    return run


def encode_documents(
    docs: DataFrame, ranks_path: str, pattern: str, text: str = "text", doc_id: str = "doc_id",
    with_ids: bool = False,
) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_sha256, decoded_sha256.

    `with_ids` adds ids (packed, little-endian, 32 bits) and decoded (bytes).  A
    NULL text is an empty one and has no tokens; repeated rows come out as often
    as they went in; other columns are ignored; an empty table gives no rows.
    """
    ranks = read_ranks(ranks_path)
    shared = share_kept(docs.sparkSession, (ranks, perfect_hash(ranks_path)))
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    if with_ids:
        schema += ", ids binary, decoded binary"
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInPandas(_kernel(shared, pattern, with_ids), schema)
