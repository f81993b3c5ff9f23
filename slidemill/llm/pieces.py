"""SentencePiece encoding and decoding for merge-type vocabularies: a score-ordered agenda of adjacent symbol pairs."""

from __future__ import annotations

import functools
import heapq
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slidemill.llm.common import trimmed

SPACE = "▁"
#: Fixed values of the model file's format: kinds of pieces and of models.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
MERGES = 2
BITS, LEFT, GONE = 20, 40, -(1 << 30)


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """``(number, value)`` of the fields of one protobuf message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            b = data[at]
            at += 1
            value |= (b & 127) << shift
            shift += 7
            if b < 128:
                return value

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
        else:
            size = varint() if kind == 2 else 4 if kind == 5 else 8
            yield key >> 3, data[at : at + size]
            at += size


def read_model(path: str) -> tuple[list[tuple[str, float, int]], dict[int, int | bytes]]:
    """``(piece, score, kind)`` of every id, and the trainer's settings by field number."""
    with open(path, "rb") as f:
        data = f.read()
    pieces, trainer = [], {}
    for number, value in _fields(data):
        if number == 1:
            got = dict(_fields(value))
            pieces.append((got.get(1, b"").decode(), struct.unpack("<f", got.get(2, bytes(4)))[0], got.get(3, NORMAL)))
        elif number == 2:
            trainer = dict(_fields(value))
    return pieces, trainer


def packed(ids: list[int]) -> bytes:
    """Little-endian 32-bit numbers."""
    return struct.pack(f"<{len(ids)}i", *ids)


class PieceCoder:
    """Ids of texts, and texts of ids, for one model file.

    No piece holds a space sign behind another sign (looked up when the file is read), so what stands between a run of
    space signs and the next one is a unit of its own: no merge crosses its edges. Units of at most ``longest`` signs
    are remembered, about ``limit`` of them; then the memory is emptied. A file of another kind (no merges, no bytes for
    unknown signs, user-defined or unused pieces, space signs at the end of words) is refused with ``ValueError``.
    """

    def __init__(self, path: str, limit: int = 600_000, longest: int = 64):
        from sentencepiece import SentencePieceProcessor

        pieces, trainer = read_model(path)
        if trainer.get(3) != MERGES or not trainer.get(35) or trainer.get(24) or any(kind in (USER_DEFINED, UNUSED) for _, _, kind in pieces):
            raise ValueError("only merge-type vocabularies with bytes for unknown signs, without user-defined or unused pieces")
        self.library = SentencePieceProcessor(model_file=path)
        self.ids = {p: i for i, (p, _, kind) in enumerate(pieces) if kind == NORMAL}
        # signs that stand in pieces without being one get numbers behind all ids, so that they too can be merged
        self.signs = {c: i for i, c in enumerate(sorted({c for p in self.ids for c in p} - self.ids.keys()), len(pieces))}
        symbols = self.ids | self.signs
        self.first_sign = len(pieces)
        #: the piece that two symbols form, by ``left << BITS | right``; and each piece's place by score, the best first
        self.pairs = {symbols[p[:k]] << BITS | symbols[p[k:]]: i for p, i in self.ids.items() for k in range(1, len(p)) if p[:k] in symbols and p[k:] in symbols}
        places = {score: n << LEFT for n, score in enumerate(sorted({score for _, score, kind in pieces if kind == NORMAL}, reverse=True))}
        self.place = [places.get(score, 0) for _, score, _ in pieces]
        self.symbol = {c: i for c, i in symbols.items() if len(c) == 1}.get
        self.byte = {int(p[3:5], 16): i for i, (p, _, kind) in enumerate(pieces) if kind == BYTE}
        plain = not any(re.search(f"[^{SPACE}]{SPACE}", p) for p in self.ids)
        self.units = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+" if plain else r"(?s:.+)").findall
        self.spelt = [bytes([int(p[3:5], 16)]) if kind == BYTE else p.replace(SPACE, " ").encode() for p, _, kind in pieces]
        self.inside = {i for i, (_, _, kind) in enumerate(pieces) if kind in (UNKNOWN, CONTROL)}
        self.spaced = {i for p, i in self.ids.items() if p[0] == SPACE}
        self.end = self.library.eos_id()
        self.prefix = self.library.normalize("a") == SPACE + "a"
        self.near = {p[i : i + 2] for p in self.ids for i in range(len(p) - 1)}
        self.sign, self.mark = next((p, i) for p, i in self.ids.items() if len(p) == 1 and p.isalpha() and p.isascii())
        self.known: dict[str, tuple[bytes, str]] = {}
        self.parts: dict[str, bytes] = {}
        self.doubt: set[str] = set()
        self.decoded: list[str] = []
        self.as_library: list[bool] = []
        self.limit, self.longest = limit, longest

    def spell(self, unit: str) -> bytes:
        """The ids of a unit, cut further between signs that stand side by side in no piece: no merge crosses these either."""
        near, out, at = self.near, [], 0
        for i in range(1, len(unit) + 1):
            if i == len(unit) or unit[i - 1 : i + 1] not in near:
                part = unit[at:i]
                if (ids := self.parts.get(part)) is None:
                    ids = packed(self.segment(part))
                    if len(part) <= self.longest:
                        self.parts[part] = ids
                out.append(ids)
                at = i
        return out[0] if len(out) == 1 else b"".join(out)

    def segment(self, unit: str) -> list[int]:
        """Ids of one piece of a text: of all adjacent pairs that form a piece the one of best score, leftmost among equals, is merged first.

        The agenda holds a pair as one number, its piece's place by score above the position of its left symbol.
        """
        part = [self.symbol(c, -1) for c in unit]
        n, pair, place = len(part), self.pairs.get, self.place
        before, behind = list(range(-1, n - 1)), list(range(1, n + 1))
        agenda = [place[m] | i for i in range(n - 1) if (m := pair(part[i] << BITS | part[i + 1])) is not None]
        heapq.heapify(agenda)
        while agenda:
            entry = heapq.heappop(agenda)
            left = entry & (1 << LEFT) - 1
            right = behind[left]
            # stale if the left side went into another merge, or either grew: then the two form another piece, or none
            if part[left] == GONE or right >= n or (m := pair(part[left] << BITS | part[right])) is None or place[m] | left != entry:
                continue
            part[left], part[right] = m, GONE
            behind[left] = after = behind[right]
            if after < n:
                before[after] = left
                if (k := pair(m << BITS | part[after])) is not None:
                    heapq.heappush(agenda, place[k] | left)
            if (first := before[left]) >= 0 and (k := pair(part[first] << BITS | m)) is not None:
                heapq.heappush(agenda, place[k] | first)
        out = [i for i in part if i != GONE]
        if min(out) >= 0 and max(out) < self.first_sign:
            return out
        out = []
        for c, i in zip(unit, part, strict=True):  # what was never merged stands at its own sign
            if i != GONE:
                out.extend((i,) if 0 <= i < self.first_sign else map(self.byte.__getitem__, c.encode()))
        return out

    def learn(self, new: list[str]) -> dict[str, tuple[bytes, str]]:
        """Ids and text of units not met before, held against the library's word on them in one call each way."""
        ids = list(map(self.spell, new))
        lists = [memoryview(i).cast("i").tolist() for i in ids]
        # each unit is decoded behind a sign of its own kind, so that its space sign stays
        texts = [self.decode([self.mark, *i])[1:] for i in lists]
        theirs = self.library.encode([u[1:].replace(SPACE, " ") if self.prefix else u for u in new], num_threads=1)
        self.doubt.update(u for u, i, j in zip(new, lists, theirs, strict=True) if i != j)
        # all of them in one list, each behind the sign
        if self.library.decode([i for ids_ in lists for i in (self.mark, *ids_)]) != "".join(self.sign + t for t in texts):
            self.doubt.update(u for u, i, t in zip(new, lists, texts, strict=True) if self.library.decode([self.mark, *i])[1:] != t)
        return dict(zip(new, zip(ids, texts, strict=True), strict=True))

    def encode(self, texts: list[str], end: bool = True) -> list[bytes]:
        """Little-endian 32-bit ids of every text. ``decoded`` then holds the texts of those ids, ``as_library`` whether the library agrees."""
        held = [self.units(self.library.normalize(t)) if t else [] for t in texts]
        new = {u for units in held for u in units}
        new.difference_update(self.known)
        if len(self.parts) > self.limit:
            self.parts.clear()
        if len(self.known) + len(new) > self.limit:
            self.known.clear()
            new = {u for units in held for u in units}
        fresh = self.learn(list(new))
        known = self.known
        known.update((u, v) for u, v in fresh.items() if len(u) <= self.longest)
        rare = {u: v for u, v in fresh.items() if len(u) > self.longest}
        get = (lambda u: known.get(u) or rare[u]) if rare else known.__getitem__
        tail = packed([self.end] * end)
        out, self.decoded, self.as_library = [], [], [True] * len(texts)
        for i, units in enumerate(held):
            ids, said = zip(*map(get, units), strict=True) if units else ((), ())
            out.append(b"".join(ids) + tail)
            said = "".join(said)
            self.decoded.append(said[1:] if self.prefix else said)
            if self.doubt and not self.doubt.isdisjoint(units):  # the library sees such a unit otherwise when it stands alone: it is asked for the whole text
                whole = self.library.encode(texts[i], add_eos=end)
                self.as_library[i] = out[-1] == packed(whole) and self.library.decode(whole) == self.decoded[-1]
        return out

    def decode(self, ids: list[int]) -> str:
        """The text of ids: a last control piece says nothing, the space put before the first word goes, bytes join into signs.

        Unknown ids, control pieces elsewhere and bytes that form no sign are left to the library's own replacements.
        """
        if ids and ids[-1] == self.end:
            ids = ids[:-1]
        if self.inside.intersection(ids):
            return self.library.decode(ids)
        said = b"".join(map(self.spelt.__getitem__, ids))
        if self.prefix and ids and ids[0] in self.spaced:
            said = said[1:]
        try:
            return said.decode()
        except UnicodeDecodeError:
            return self.library.decode(ids)


@functools.lru_cache(1)
def coder_of(path: str) -> PieceCoder:
    """One coder for a worker process: what it has learnt serves its later tasks."""
    return PieceCoder(path)


def _steps(text: pa.Array, size: int = 1 << 22) -> Iterator[list[str]]:
    """The texts in runs of about as many bytes."""
    held, total = [], 0
    for value in text:
        held.append(value.as_py())
        total += len(held[-1])
        if total >= size:
            yield held
            held, total = [], 0
    if held:
        yield held


def _lists(parts: list[bytes]) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum([len(p) // 4 for p in parts])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(parts), "<i4"), pa.int32()))


def encode(docs: DataFrame, model_path: str, end: bool = True, decoded: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Ids of every whole text: ``(doc_id, ids, as_library)``, with ``decoded`` also ``decoded``, the text of those ids.

    One row per input row, in a narrow Arrow map without shuffle. The ids come from ``PieceCoder``. In each Arrow batch the
    sentencepiece library encodes the units not met before, and decodes their ids, as well; ``as_library`` says whether both agree. Null text
    counts as empty, which is the end id alone; null ids stay null; repeated rows repeat; a text without blanks is one
    unit, worked out in n log n steps. Other columns are not read; an empty table gives an empty result.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = coder_of(model_path)
        for batch in batches:
            at = 0
            for texts in _steps(pc.fill_null(batch.column(1), "")):
                ids = coder.encode(texts, end)
                columns = [batch.column(0).slice(at, len(texts)), _lists(ids)]
                if decoded:
                    columns.append(pa.array(coder.decoded, pa.string()))
                yield pa.RecordBatch.from_arrays([*columns, pa.array(coder.as_library)], ["doc_id", "ids", *["decoded"] * decoded, "as_library"])
                at += len(texts)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(trimmed(work), f"doc_id long, ids array<int>, {'decoded string, ' * decoded}as_library boolean")


def decode(rows: DataFrame, model_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``(doc_id, text)`` of rows of ids. Null lists, and lists without ids, give the empty text; null ids within a list are left out."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = coder_of(model_path)
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                texts = [coder.decode([i for i in ids if i is not None]) if ids else "" for ids in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return rows.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).cast("array<int>").alias("ids")).mapInArrow(trimmed(work), "doc_id long, text string")


def digests(encoded: DataFrame) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256, as_library`` of encoded and decoded rows."""
    spelt = F.array_join(F.col("ids").cast("array<string>"), " ")
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(spelt, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"), "as_library")
