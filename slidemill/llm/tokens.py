"""Exact token counts with a tokenizer file, batch encoding inside Arrow functions that return lengths only."""

from __future__ import annotations

import json
import os
import re
import struct
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slidemill.llm.common import trimmed

#: Words cut only between letters, single digits and runs of ASCII signs: no apostrophe, no mark, nothing that is neither; and where they are cut.
_EASY, _CUTS = r"^[\p{L}0-9!-&(-/:-@\[-`{-~]*$", r"([0-9]|[!-&(-/:-@\[-`{-~]+)"
#: Runs of Latin-1 alone: NFC leaves them as they are, and small letters are no matter of context.
_LATIN = r"^[!-~\x{AA}\x{B5}\x{BA}\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{FF}]+$"


#: The splitter and the normaliser whose files can be coded word by word.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
NORMAL = [("NFC", None), ("Replace", r"\s+"), ("Lowercase", None)]


def splits_at_blanks(file: dict) -> bool:
    """Whether a tokenizer file drops white space and splits, lower-cases and spells words in the way ``WordCoder`` relies on."""
    normal, split, model = file.get("normalizer") or {}, file.get("pre_tokenizer") or {}, file.get("model") or {}
    first, second = [*split.get("pretokenizers", []), {}, {}][:2]
    return (
        [(n["type"], (n.get("pattern") or {}).get("Regex")) for n in normal.get("normalizers", [])] == NORMAL
        and first.get("type") == "Split" and first.get("pattern") == {"Regex": SPLIT} and first.get("behavior") == "Removed" and first.get("invert") is True
        and second.get("type") == "ByteLevel" and not second.get("add_prefix_space") and second.get("use_regex") is False
        and all(t["content"].startswith("<|") and not re.search(r"\s", t["content"]) for t in file.get("added_tokens") or [])  # such words go to the library whole
        and len(split["pretokenizers"]) == 2 and model.get("type") == "BPE" and not any(file.get(k) for k in ("truncation", "padding", "post_processor"))
    )


_U4 = struct.Struct("<I").pack
#: Runs that are handed to the model in one line.
_LINE = 100


def byte_level_table() -> dict[int, int]:
    """The published byte-to-character rule of byte-level BPE: printable Latin-1 stays, the rest follows from 256 on."""
    keep = {*range(33, 127), *range(161, 173), *range(174, 256)}
    moved = iter(range(256, 512))
    return {b: b if b in keep else next(moved) for b in range(256)}


def safe_chunks(text: str, size: int = 1 << 20) -> Iterator[str]:
    """Cut a long text behind a blank or line end, which no token of a whitespace-dropping tokenizer spans."""
    at = 0
    while len(text) - at > size:
        near = at + size
        cut = min((x for x in (text.find(" ", near), text.find("\n", near)) if x >= 0), default=-1)
        if cut < 0:
            break
        yield text[at:cut]
        at = cut + 1
    yield text[at:] if at else text


Coded = tuple[np.ndarray, np.ndarray, np.ndarray]  # ids, and where in them those of each string begin and how many they are


def gathered(ids: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The ids of the strings that begin at ``starts``, one string after the other."""
    ends = np.cumsum(lengths)
    return ids[np.repeat(starts - ends + lengths, lengths) + np.arange(lengths.sum())]


def placed(n: int, parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> Coded:
    """Codes of ``n`` strings from those of some of them: ``(which, ids, lengths)``; the others have no ids."""
    starts, lengths, base = np.zeros(n, np.int64), np.zeros(n, np.int64), 0
    for which, ids, many in parts:
        starts[which], lengths[which] = base + np.cumsum(many) - many, many
        base += len(ids)
    return np.concatenate([np.zeros(0, "<u4"), *(ids for _, ids, _ in parts)]), starts, lengths


class Remembered:
    """Ids of strings seen before, in arrays. Beyond ``limit`` strings the half asked for last stays, and all that are asked for just now."""

    def __init__(self, limit: int):
        self.limit, self.calls, self.keys = limit, 0, pa.array([], pa.string())
        self.ids, self.starts, self.lengths, self.last = np.zeros(0, "<u4"), *(np.zeros(0, np.int64) for _ in range(3))

    def find(self, strings: pa.StringArray, learn: Callable[[pa.StringArray], Coded]) -> Coded:
        """Codes of distinct strings; those of strings not held are learnt."""
        self.calls += 1
        held = pc.index_in(strings, value_set=self.keys)
        new, at = held.is_null().to_numpy(zero_copy_only=False), pc.fill_null(held, 0).to_numpy().astype(np.int64)
        self.last[at[~new]] = self.calls
        if len(self.keys) > self.limit:
            at[~new] = self._forget()[at[~new]]
        if new.any():
            fresh = strings.filter(pa.array(new))
            at[new] = len(self.keys) + np.arange(len(fresh))
            ids, starts, lengths = learn(fresh)
            self.keys, self.starts = pa.concat_arrays([self.keys, fresh]), np.concatenate([self.starts, len(self.ids) + starts])
            self.ids, self.lengths = np.concatenate([self.ids, ids]), np.concatenate([self.lengths, lengths])
            self.last = np.concatenate([self.last, np.full(len(fresh), self.calls)])
        return self.ids, self.starts[at], self.lengths[at]

    def _forget(self) -> np.ndarray:
        """Drop what was asked for least lately; the new place of each string that stays."""
        stay = np.sort(np.argsort(-self.last, kind="stable")[: max(self.limit // 2, int((self.last == self.calls).sum()))])
        moved = np.zeros(len(self.last), np.int64)
        moved[stay] = np.arange(len(stay))
        self.keys, self.last = self.keys.take(pa.array(stay)), self.last[stay]
        self.ids, self.lengths = gathered(self.ids, self.starts[stay], self.lengths[stay]), self.lengths[stay]
        self.starts = np.cumsum(self.lengths) - self.lengths
        return moved


class WordCoder:
    """Token ids (or their number) of blank-separated words, remembered for words seen before.

    That is for files that drop white space (``splits_at_blanks``); with any other file whole texts go to the library, in
    batches of about as many bytes. For their number, words are encoded in such batches as they are. For ids, words are split further, only where the tokenizer's own pattern always splits (between an all-letter run and
    printable ASCII signs or digits); anything else goes to the library whole. Arrow splits a batch and finds its distinct words, and the
    library's model spells new runs joined by blanks. Memory stays bounded: what is remembered is emptied (for ids: halved) when it holds ``limit`` entries.
    """

    def __init__(self, path: str, lengths_only: bool, limit: int = 300_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tok, self.limit, self.lengths_only = Tokenizer.from_file(path), limit, lengths_only
        file = json.loads(self.tok.to_str())
        self.by_word = splits_at_blanks(file)
        self.pack = len if lengths_only else lambda ids: np.array(ids, "<u4").tobytes() if len(ids) > 16 else b"".join(map(_U4, ids))
        self.words: dict | Remembered = {} if lengths_only else Remembered(limit)
        if self.by_word and not lengths_only:
            self.runs = Remembered(limit)
            self.spaced = np.array([b if b == 32 else c for b, c in sorted(byte_level_table().items())], "<u2")
            self.model = Tokenizer(self.tok.model)
            self.model.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(" ")
            vocab, end = file["model"]["vocab"], file["model"].get("end_of_word_suffix")
            self.closes = np.zeros(1 + max(vocab.values(), default=0), bool)
            self.closes[[i for t, i in vocab.items() if end and t.endswith(end)]] = True

    def _spelt(self, lines: list[str], n: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of ``n`` normalised runs, joined to lines by blanks, and their numbers: the library's model spells them, ids that end a word part them again."""
        chars = [self.spaced[np.frombuffer(line.encode(), np.uint8)].tobytes().decode("utf-16-le") for line in lines]
        ids = np.fromiter(chain.from_iterable(e.ids for e in self.model.encode_batch_fast(chars, add_special_tokens=False)), "<u4")
        ends = np.flatnonzero(self.closes[ids])
        if len(ends) == n and (not n or ends[-1] == len(ids) - 1):
            return ids, np.diff(ends, prepend=-1)
        alone = [e.ids for e in self.model.encode_batch_fast([c for line in chars for c in line.split(" ")], add_special_tokens=False)]
        return np.fromiter(chain.from_iterable(alone), "<u4"), np.fromiter(map(len, alone), np.int64)

    def _learn_runs(self, runs: pa.StringArray) -> Coded:
        latin = pc.match_substring_regex(runs, _LATIN).to_numpy(zero_copy_only=False)
        rest = np.flatnonzero(~latin & (pc.binary_length(runs).to_numpy() > 0))  # the empty run has no ids
        n = int(latin.sum())
        bounds = pa.array([*range(0, n, _LINE), n], pa.int32())
        lines = pc.binary_join(pa.ListArray.from_arrays(bounds, runs.filter(pa.array(latin))), " ").to_pylist()
        parts = [(np.flatnonzero(latin), *self._spelt([line.lower() for line in lines], n))]
        if len(rest):
            strings = runs.take(pa.array(rest)).to_pylist()
            normal = self.tok.normalizer.normalize_str("\n".join(strings)).split(" ")
            letters = np.array([len(normal) == len(strings) and x.isalpha() for x in normal[: len(strings)]] + [False] * (len(strings) - len(normal)))
            spelt = [x for x, ok in zip(normal, letters, strict=False) if ok]
            parts.append((rest[letters], *self._spelt([" ".join(spelt[at : at + _LINE]) for at in range(0, len(spelt), _LINE)], len(spelt))))
            parts.append((rest[~letters], *self._by_library([x for x, ok in zip(strings, letters, strict=True) if not ok])))
        return placed(len(runs), parts)

    def _learn(self, words: pa.StringArray) -> Coded:
        easy = pc.and_(pc.match_substring_regex(words, _EASY), pc.invert(pc.match_substring(words, "<|")))
        cut = pc.split_pattern(pc.replace_substring_regex(pc.ascii_lower(words.filter(easy)), _CUTS, r" \1 "), " ")
        ids, many = self._of(cut, self.runs, self._learn_runs)
        easy = easy.to_numpy(zero_copy_only=False)
        parts = [(easy, ids, many)]
        if not easy.all():
            parts.append((~easy, *self._by_library(words.filter(pa.array(~easy)).to_pylist())))
        return placed(len(words), parts)

    def _of(self, lists: pa.ListArray, memory: Remembered, learn: Callable[[pa.StringArray], Coded]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of lists of strings, one list after the other, and their number for each list."""
        coded = lists.flatten().dictionary_encode()
        ids, starts, lengths = memory.find(coded.dictionary, learn)
        at = coded.indices.to_numpy()
        upto = np.concatenate([[0], np.cumsum(lengths[at])])[np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy())])]
        return gathered(ids, starts[at], lengths[at]), np.diff(upto)

    def _by_library(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found: dict = {}
        self._whole(words, found)
        codes = [found[word] for word in words]
        return np.frombuffer(b"".join(codes), "<u4"), np.fromiter(map(len, codes), np.int64) // 4

    def _whole(self, texts: list[str], to: dict, batch_bytes: int = 1 << 19) -> None:
        """Plain library encoding, in batches balanced by their bytes."""
        batch, held = [], 0
        for i, text in enumerate(texts):
            batch.append(text)
            held += len(text.encode())
            if held >= batch_bytes or i == len(texts) - 1:
                for t, e in zip(batch, self.tok.encode_batch_fast(batch, add_special_tokens=False), strict=True):
                    to[t] = self.pack(e.ids)
                batch, held = [], 0

    def batches(self, texts: list[str], batch_bytes: int = 1 << 21) -> Iterator[tuple[int, list]]:
        """(index of text, codes of the words of one chunk), chunks in order, learnt in batches balanced by bytes."""
        held, size = [], 0
        for i, text in enumerate(texts):
            for chunk in safe_chunks(text) if self.by_word else [text]:
                held.append((i, chunk))
                size += len(chunk) if chunk.isascii() else len(chunk.encode())
                if size >= batch_bytes:
                    yield from self._coded(held)
                    held, size = [], 0
        yield from self._coded(held)

    def _coded(self, held: list[tuple[int, str]]) -> Iterator[tuple[int, list]]:
        if not self.by_word:
            found: dict = {}
            self._whole(list({chunk for _, chunk in held}), found)
            for i, chunk in held:
                yield i, [found[chunk]]
            return
        if not self.lengths_only:
            lists = pc.split_pattern(pc.replace_substring(pa.array([chunk for _, chunk in held], pa.string()), "\n", " "), " ")
            ids, many = self._of(lists, self.words, self._learn)
            ends = np.cumsum(many)
            for (i, _), start, end in zip(held, ends - many, ends, strict=True):
                yield i, [ids[start:end].tobytes()]
            return
        held = [(i, chunk.replace("\n", " ").split(" ")) for i, chunk in held]
        known = self.words
        new = set()
        for _, words in held:
            new.update(words)
        new.difference_update(known)
        if len(known) > self.limit:
            known.clear()
            for _, words in held:
                new.update(words)
        self._whole(list(new), known)  # distinct words in batches
        for i, words in held:
            yield i, map(known.__getitem__, words)


def token_counts(docs: DataFrame, tokenizer_path: str, limit: int = 2048, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Tokens of every whole text: ``(doc_id, n_bytes, n_tokens, over_limit)``, one row per input row.

    ``tokenizer_path`` names any ``tokenizers`` file; one that drops white space is coded by distinct words, with long
    texts split at blanks, any other by whole texts. Counts equal those of ``encode(text, add_special_tokens=False)``; special strings inside a text count as the library's default has
    it. Null text counts as empty (0 bytes, 0 tokens); a null id stays null; repeated rows repeat. Other columns
    are not read. No shuffle: a narrow Arrow map over the scan.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = WordCoder(tokenizer_path, lengths_only=True)
        for batch in batches:
            text = pc.fill_null(batch.column(1), "")
            totals = [0] * len(text)
            for i, codes in coder.batches(text.to_pylist()):
                totals[i] += sum(codes)
            n = pa.array(totals, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), pc.cast(pc.binary_length(text), pa.int64()), n, pc.greater(n, limit)], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        trimmed(count), "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
    )
