"""SentencePiece encoding and decoding: exact merge-type encoding by backtracking.

A sequence of pieces is the merge result of its text exactly when every two
neighbours are the merge result of theirs.  So a unit of text takes the longest
piece that fits at a position (all matches of one Aho-Corasick pass), checks it
against the piece before by merging the two anew, tries the next shorter piece
otherwise, and steps back where none is left; a bitfield keeps the positions
found to lead nowhere.  The text itself is never merged.

A text is cut into units where no piece can reach over: before a space mark that
follows another character (if no piece has one inside), and around characters
that are in no piece, which become byte pieces.  The model, a fixed file, is the
only thing broadcast; an executor's Python process keeps the encoder, its units
and its checked neighbours from task to task, both in bounded caches.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Memo, kept_value, share_kept

#: The mark that stands for a space.  Fixed value.
SPACE = "▁"
#: Longest unit that is kept in the cache.
KEPT_LENGTH = 64
#: Units kept (twice: the present and the last generation), and checked neighbours.
KEPT_UNITS, KEPT_PAIRS = 400_000, 1_000_000


def read_model(path: str) -> dict:
    """Pieces, scores and special ids of a model file, read on the driver.

    Raises ValueError for models this encoder does not reproduce: others than
    merge-type ones with identity normalisation, a dummy prefix and byte pieces.
    """
    from sentencepiece import sentencepiece_model_pb2 as pb

    model = pb.ModelProto()
    with open(path, "rb") as file:
        model.ParseFromString(file.read())
    trainer, norm = model.trainer_spec, model.normalizer_spec
    kinds = pb.ModelProto.SentencePiece
    if (
        trainer.model_type != pb.TrainerSpec.BPE or not trainer.byte_fallback
        or trainer.treat_whitespace_as_suffix or norm.precompiled_charsmap
        or norm.remove_extra_whitespaces or not norm.add_dummy_prefix or not norm.escape_whitespaces
        or any(p.type in (kinds.USER_DEFINED, kinds.UNUSED) for p in model.pieces)
    ):
        raise ValueError("not a plain merge-type model with byte pieces")
    return {
        "pieces": [p.piece for p in model.pieces],
        "scores": [p.score for p in model.pieces],
        "normal": [p.type == kinds.NORMAL for p in model.pieces],
        "bytes": {int(p.piece[3:5], 16): i for i, p in enumerate(model.pieces) if p.type == kinds.BYTE},
        "unknown": [i for i, p in enumerate(model.pieces) if p.type == kinds.UNKNOWN],
        "end": [p.piece for p in model.pieces].index(trainer.eos_piece or "</s>"),
    }


def merge(text: str, ranks: dict[str, tuple]) -> list[str]:
    """Merge result of a short text: best score first, the leftmost of equals."""
    parts = list(text)
    while True:
        found = [
            (rank, i) for i in range(len(parts) - 1)
            if (rank := ranks.get(parts[i] + parts[i + 1])) is not None
        ]
        if not found:
            return parts
        _, i = min(found)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]


class Encoder:
    """Encoder and decoder of one model; `encode_unit` is the backtracking itself."""

    def __init__(self, model: dict):
        import ahocorasick

        self.ranks = {p: -s for p, s, n in zip(model["pieces"], model["scores"], model["normal"], strict=True) if n}
        self.byte_ids = [model["bytes"][b] for b in range(256)]
        self.end, self.size = model["end"], len(model["pieces"])
        known = sorted({c for p in self.ranks for c in p})
        # characters of pieces that are no piece themselves get ids beyond the model's
        alone = [c for c in known if c not in self.ranks]
        self.text = [p if n else "" for p, n in zip(model["pieces"], model["normal"], strict=True)] + alone
        self.spelled = {self.size + i: self._bytes(c) for i, c in enumerate(alone)}
        # a piece that its own text does not merge to is never in a result
        usable = [i for i, p in enumerate(self.text) if p and (len(p) == 1 or merge(p, self.ranks) == [p])]
        ids = {self.text[i]: i for i in usable}
        self.length = [len(p) for p in self.text]
        self.shorter = [-1] * len(self.text)
        self.matches = ahocorasick.Automaton()
        for i in usable:
            piece = self.text[i]
            self.matches.add_word(piece, (i, len(piece)))
            self.shorter[i] = next((ids[piece[:k]] for k in range(len(piece) - 1, 0, -1) if piece[:k] in ids), -1)
        self.matches.make_automaton()
        inside = any(SPACE in p.lstrip(SPACE) for p in self.ranks)
        kept = "".join(map(re.escape, (c for c in known if c != SPACE)))
        word = f"[{SPACE}{kept}]+" if inside else f"{SPACE}*[{kept}]+|{SPACE}+"
        self.cut = re.compile(f"{word}|[^{SPACE}{kept}]+")
        self.known = frozenset(known)
        self.units = Memo(self._unit, KEPT_UNITS, lambda unit: len(unit) <= KEPT_LENGTH)
        self.pairs = Memo(self._fit, KEPT_PAIRS)
        self.plain = [p.replace(SPACE, " ").encode() for p in self.text[: self.size]]
        for i in model["unknown"]:
            self.plain[i] = " ⁇ ".encode()
        self.byte_of = {i: bytes([b]) for b, i in model["bytes"].items()}
        self.decimal = [str(i) for i in range(self.size)]

    def _bytes(self, text: str) -> list[int]:
        return [self.byte_ids[b] for b in text.encode("utf-8", "surrogatepass")]

    def _fit(self, pair: tuple[int, int]) -> bool:
        a, b = self.text[pair[0]], self.text[pair[1]]
        return merge(a + b, self.ranks) == [a, b]

    def encode_unit(self, unit: str) -> list[int]:
        """Pieces of a unit whose characters are all known; linear memory."""
        n = len(unit)
        longest = [-1] * n
        for last, (piece, size) in self.matches.iter(unit):
            longest[last - size + 1] = piece  # matches of a start come from short to long
        failed = bytearray(n // 8 + 1)
        length, shorter, pairs = self.length, self.shorter, self.pairs
        out: list[int] = []
        at, piece = 0, longest[0]
        while at < n:
            while piece >= 0:
                end = at + length[piece]
                if not failed[end >> 3] >> (end & 7) & 1 and (not out or pairs[out[-1], piece]):
                    break
                piece = shorter[piece]
            if piece >= 0:
                out.append(piece)
                at = end
                piece = longest[at] if at < n else -1
            else:
                failed[at >> 3] |= 1 << (at & 7)
                piece = out.pop()
                at -= length[piece]
                piece = shorter[piece]
        return out

    def _unit(self, unit: str) -> bytes:
        if unit[0] not in self.known:
            ids = self._bytes(unit)
        else:
            ids = self.encode_unit(unit)
            if self.spelled:
                ids = [x for i in ids for x in self.spelled.get(i, (i,))]
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str) -> np.ndarray:
        """Ids of a whole text with the end id."""
        marked = SPACE + text.replace(" ", SPACE) if text else ""
        packed = b"".join(map(self.units.__getitem__, self.cut.findall(marked)))
        return np.append(np.frombuffer(packed, "<u4"), np.uint32(self.end))

    def decode(self, ids: np.ndarray) -> str:
        """Text of ids: control ids vanish, byte pieces that are no UTF-8 become U+FFFD."""
        runs, spelled = [], []
        for i in ids.tolist():
            byte = self.byte_of.get(i)
            if byte is not None:
                spelled.append(byte)
                continue
            if spelled:
                runs.append(_utf8(b"".join(spelled)))
                spelled = []
            runs.append(self.plain[i])
        if spelled:
            runs.append(_utf8(b"".join(spelled)))
        first = next((k for k, run in enumerate(runs) if run), None)
        lead = first is not None and runs[first][:1] == b" " and self._starts_marked(ids)
        return b"".join(runs).decode()[1 if lead else 0 :]

    def _starts_marked(self, ids: np.ndarray) -> bool:
        for i in ids.tolist():
            if i in self.byte_of:
                return False
            if self.plain[i]:
                return self.text[i][:1] == SPACE
        return False

    def joined(self, ids: np.ndarray) -> str:
        return " ".join(map(self.decimal.__getitem__, ids.tolist()))


def _utf8(raw: bytes) -> bytes:
    """The bytes, each one that is not part of a character replaced by U+FFFD."""
    try:
        raw.decode()
        return raw
    except UnicodeDecodeError:
        pass
    out, i = [], 0
    while i < len(raw):
        for size in (1, 2, 3, 4):
            part = raw[i : i + size]
            try:
                part.decode()
            except UnicodeDecodeError:
                continue
            break
        else:
            part, size = "�".encode(), 1
        out.append(part)
        i += size
    return b"".join(out)


def _kernel(shared, with_ids: bool):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = kept_value(shared, Encoder)
        for batch in batches:
            rows = []
            for text in batch["text"]:
                ids = encoder.encode(text or "")
                decoded = encoder.decode(ids)
                rows.append((
                    len(ids), hashlib.sha256(encoder.joined(ids).encode()).hexdigest(),
                    hashlib.sha256(decoded.encode("utf-8", "surrogatepass")).hexdigest(),
                    *((ids.tolist(), decoded) if with_ids else ()),
                ))
            names = ["n_tokens", "ids_sha256", "decoded_sha256", *(("ids", "decoded") if with_ids else ())]
            out = pd.DataFrame(rows, columns=names)
            out.insert(0, "doc_id", batch["doc_id"].to_numpy())
            yield out

    return run


def encode_pieces(
    docs: DataFrame, model_path: str, text: str = "text", doc_id: str = "doc_id", with_ids: bool = False
) -> DataFrame:
    """One row per document: doc_id, n_tokens (with the end id), ids_sha256, decoded_sha256.

    `with_ids` adds ids (array) and decoded (string).  A NULL or empty text has
    the end id alone and decodes to an empty one; texts of any length are encoded
    whole; where scores tie, the leftmost pair merges; repeated rows come out as
    often as they went in; other columns are ignored; an empty table gives no rows.
    """
    shared = share_kept(docs.sparkSession, read_model(model_path))
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    if with_ids:
        schema += ", ids array<int>, decoded string"
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInPandas(_kernel(shared, with_ids), schema)
