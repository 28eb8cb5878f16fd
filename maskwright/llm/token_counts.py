"""Token counts by rank-synchronous merging of byte pairs.

The pre-tokens of a block of texts are held as one ragged numpy array of symbols. In a
round every pre-token finds the lowest rank among its neighbouring pairs and merges all
places of that pair at once, left to right; pre-tokens without a pair of the vocabulary
are done, and what symbols they have left is their number of tokens. A merge makes a
symbol whose own merges all rank higher, so this equals merging one pair at a time.

A vocabulary is a byte-level BPE file of the ``tokenizers`` library. Its special tokens
are recognised inside texts, as is that library's default, and count one each.

Defined results: null and empty texts have no tokens, very long texts are counted whole
(memory in proportion to the text), repeated rows count alike, an empty table stays
empty, further columns are kept and those named like a result are replaced.
"""

from __future__ import annotations

import json
import sys

import numpy as np
import pyarrow as pa
import regex
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: How texts are cut before merging: a fixed pattern of this family of vocabularies.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
BLOCK_BYTES = 1 << 21
#: Pre-tokens remembered between blocks, in number and in characters together; beyond either they
#: are forgotten and counted anew.
REMEMBERED, REMEMBERED_CHARS = 1 << 20, 1 << 24
_NO_RANK = np.int64(1 << 40)


class Vocabulary:
    """Merge ranks as sorted arrays, and how this vocabulary's library cuts texts."""

    def __init__(self, path: str):
        from tokenizers import pre_tokenizers

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, cut = spec["model"], spec["pre_tokenizer"]
        if spec["normalizer"] or cut["type"] != "ByteLevel" or cut["add_prefix_space"] or model.get("ignore_merges"):
            raise ValueError(f"{path} is no plain byte-level vocabulary")
        added = spec["added_tokens"]
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in added):
            raise ValueError(f"{path} has special tokens that take in their surroundings")
        ids = model["vocab"]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        left = np.array([ids[a] for a, _ in pairs], dtype=np.int64)
        right = np.array([ids[b] for _, b in pairs], dtype=np.int64)
        key = (left << 32) | right
        order = np.argsort(key)
        self.key, self.rank = key[order], order.astype(np.int64)
        self.merged = np.array([ids[a + b] for a, b in pairs], dtype=np.int64)
        # Bytes without a printable sign stand in the file as signs from 256 on, in order.
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in shown]
        sign = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}
        self.byte = np.array([ids[sign[b]] for b in range(256)], dtype=np.int64)
        self.special = regex.compile("|".join(regex.escape(t["content"]) for t in added)) if added else None
        self.cut = regex.compile(PATTERN)
        self.library = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
        self.agreed: set[str] = set()
        self.known: dict[str, int] = {}
        self.chars = 0

    def _same_kind(self, char: str) -> bool:
        """Whether library and pattern see ``char`` alike (Unicode versions differ)."""
        for before in ("a", "1", "!", " "):
            ours = len(self.cut.findall(before + char + "a"))
            if ours != len(self.library.pre_tokenize_str(before + char + "a")):
                return False
        return True

    def pieces(self, text: str) -> list[str]:
        new = set(text) - self.agreed
        if new:
            self.agreed |= {c for c in new if self._same_kind(c)}
            if new - self.agreed:
                return [text[a:b] for _, (a, b) in self.library.pre_tokenize_str(text)]
        return self.cut.findall(text)

    def count(self, pieces: list[str]) -> np.ndarray:
        """Tokens of each piece."""
        raw = [p.encode("utf-8") for p in pieces]
        length = np.array([len(r) for r in raw], dtype=np.int64)
        symbol = self.byte[np.frombuffer(b"".join(raw), dtype=np.uint8)]
        owner = np.repeat(np.arange(len(raw)), length)
        result = length.copy()
        while len(symbol):
            key = (symbol[:-1] << 32) | symbol[1:]
            at = np.searchsorted(self.key, key)
            at[at == len(self.key)] = 0
            rank = np.where((self.key[at] == key) & (owner[:-1] == owner[1:]), self.rank[at], _NO_RANK)
            rank = np.append(rank, _NO_RANK)
            first = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            sizes = np.append(first[1:], len(owner)) - first
            lowest = np.minimum.reduceat(rank, first)
            result[owner[first]] = sizes
            going = np.repeat(lowest < _NO_RANK, sizes)
            merge = going & (rank == np.repeat(lowest, sizes))
            # In a run of the same symbol every second pair is taken.
            place = np.arange(len(merge))
            begins = merge & ~np.append(False, merge[:-1])
            since = place - np.maximum.accumulate(np.where(begins, place, 0))
            merge &= since % 2 == 0
            symbol = np.where(merge, self.merged[np.where(merge, rank, 0)], symbol)
            stays = going & ~np.append(False, merge[:-1])
            symbol, owner = symbol[stays], owner[stays]
        return result

    def counts(self, texts: list[str | None]) -> list[int]:
        cut, fixed = [], []
        for text in texts:
            parts, n = [text or ""], 0
            if self.special is not None and text and self.special.search(text):
                parts = self.special.split(text)
                n = len(parts) - 1
            cut.append([p for part in parts if part for p in self.pieces(part)])
            fixed.append(n)
        if len(self.known) > REMEMBERED or self.chars > REMEMBERED_CHARS:
            self.known.clear()
            self.chars = 0
        new = list({p for pieces in cut for p in pieces if p not in self.known})
        if new:
            self.known.update(zip(new, self.count(new).tolist(), strict=True))
            self.chars += sum(map(len, new))
        look = self.known.__getitem__
        return [n + sum(map(look, pieces)) for n, pieces in zip(fixed, cut, strict=True)]


#: Vocabularies that a task has read. Not ``functools.cache``, whose functions executors would
#: have to import.
_read: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    if path not in _read:
        _read[path] = Vocabulary(path)
    return _read[path]


def blocks(texts: list[str | None], limit: int):
    """The texts in runs of about ``limit`` characters."""
    run, n = [], 0
    for text in texts:
        run.append(text)
        n += len(text or "")
        if n >= limit:
            yield run
            run, n = [], 0
    if run:
        yield run


def token_count(path: str):
    """A column function: the number of tokens of a text column under the vocabulary."""

    @F.arrow_udf(T.LongType())
    def counted(texts: pa.Array) -> pa.Array:
        own = vocabulary(path)
        out: list[int] = []
        for block in blocks(texts.to_pylist(), BLOCK_BYTES):
            out.extend(own.counts(block))
        return pa.array(out, pa.int64())

    return counted


def with_counts(df: DataFrame, path: str, text: str = "text", limit: int = 512) -> DataFrame:
    """Adds ``n_bytes``, ``n_tokens`` and ``over_limit``."""
    return df.withColumns({
        "n_bytes": F.coalesce(F.octet_length(text), F.lit(0)).cast("long"),
        "n_tokens": token_count(path)(F.col(text)),
    }).withColumn("over_limit", F.col("n_tokens") > limit)
