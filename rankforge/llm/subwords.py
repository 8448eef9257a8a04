"""Subword ids by the tokenizers library, with a bounded cache of whole words.

A tokenizer that drops white space and closes every piece encodes each word on its own, whatever stands
beside it. For such a vocabulary a text's ids are those of its words in turn, so that each different word
has to be encoded once. Any other vocabulary encodes whole texts.
"""

from __future__ import annotations

import json
import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from rankforge.llm.common import Words, ragged, words_of

#: Characters that form a piece of their own behind letters (no apostrophe: "'s" and the like are pieces too),
#: and the letters before them that need neither normalising nor a piece pattern.
TAIL = ".,!*#$%&;:?|()-"
LETTERS = "^[a-zß-öø-ÿ]+$"
SPECIAL = "<|"
#: Ids are put together for so many words at once.
RUN_WORDS = 1 << 18


class Ragged:
    """Runs of int32, appended to."""

    def __init__(self):
        self.flat, self.used = np.empty(1 << 16, np.int32), 0
        self.start, self.length, self.n = np.empty(1 << 14, np.int64), np.empty(1 << 14, np.int64), 0

    def add(self, flat: np.ndarray, lengths: np.ndarray) -> None:
        while self.used + len(flat) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.empty_like(self.flat)])
        while self.n + len(lengths) > len(self.start):
            self.start, self.length = (np.concatenate([x, np.empty_like(x)]) for x in (self.start, self.length))
        self.flat[self.used:self.used + len(flat)] = flat
        self.length[self.n:self.n + len(lengths)] = lengths
        self.start[self.n:self.n + len(lengths)] = self.used + np.cumsum(lengths) - lengths
        self.used += len(flat)
        self.n += len(lengths)

    def take(self, runs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        lengths = self.length[runs]
        return self.flat[ragged(self.start[runs], lengths)], lengths


def _numbers(found: list) -> tuple[np.ndarray, np.ndarray]:
    """Encodings as (flat ids, lengths)."""
    lengths = np.fromiter((len(x) for x in found), np.int64, len(found))
    flat = np.empty(int(lengths.sum()), np.int32)
    at = 0
    for x in found:
        flat[at:at + len(x)] = x.ids
        at += len(x)
    return flat, lengths


class SubwordEncoder:
    """``encode(column)`` gives the ids of all texts, flat, and where each text ends."""

    def __init__(self, path: str, most_words: int = 400_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core is one task's share
        from tokenizers import Tokenizer, pre_tokenizers

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.full = Tokenizer.from_file(path)
        self.size = self.full.get_vocab_size()
        self.most_words = most_words
        suffix = spec["model"].get("end_of_word_suffix") or ""
        splits = [p for p in (spec.get("pre_tokenizer") or {}).get("pretokenizers", []) if p["type"] == "Split"]
        self.by_word = bool(suffix) and any(p["invert"] and p["behavior"] == "Removed" and r"[^\s" in p["pattern"].get("Regex", "") for p in splits)
        if self.by_word:
            self.bare = Tokenizer(self.full.model)
            self.bare.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
            self.closes = np.zeros(self.size, bool)
            self.closes[[i for t, i in self.full.get_vocab().items() if t.endswith(suffix)]] = True
            self._clear()

    def _clear(self) -> None:
        self.code: dict[bytes, int] = {}
        self.ids = Ragged()

    def _plain(self, cores: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words of plain letters: many to a call, told apart by the ids that close a word."""
        text = [b" ".join(cores[i:i + 256]).decode() for i in range(0, len(cores), 256)]
        flat, _ = _numbers(self.bare.encode_batch_fast(text, add_special_tokens=False))
        return flat, np.diff(np.flatnonzero(self.closes[flat]), prepend=-1)

    def _any(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        return _numbers(self.full.encode_batch_fast([t.decode() for t in texts], add_special_tokens=False))

    def _runs(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """For each word the runs of ids that make it up: (letters or the whole word, what stands behind or -1)."""
        core = pc.ascii_rtrim(words, characters=TAIL)
        plain = pc.match_substring_regex(core, LETTERS)
        first = pc.if_else(plain, core, words).dictionary_encode()
        cut = pc.and_(plain, pc.not_equal(pc.binary_length(core), pc.binary_length(words)))
        tail = pc.replace_substring_regex(words.filter(cut), "^[^" + TAIL.replace("-", r"\-") + "]+", "").dictionary_encode()
        second = np.full(len(words), -1, np.int64)
        second[cut.to_numpy(zero_copy_only=False)] = self._codes(tail.dictionary)[tail.indices.to_numpy(zero_copy_only=False)]
        return self._codes(first.dictionary)[first.indices.to_numpy(zero_copy_only=False)], second

    def _codes(self, parts: pa.Array) -> np.ndarray:
        """The run of ids of each part; parts not met before are encoded."""
        known, parts = self.code, parts.cast(pa.binary()).to_pylist()
        if not parts:
            return np.empty(0, np.int64)
        new = [w for w in parts if w not in known]
        if new:
            plain = pc.match_substring_regex(pa.array(new, pa.binary()).cast(pa.string()), LETTERS).to_pylist()
            for kind, encode in ((True, self._plain), (False, self._any)):
                if batch := [w for w, k in zip(new, plain) if k is kind]:
                    known.update(zip(batch, range(len(known), len(known) + len(batch))))
                    self.ids.add(*encode(batch))
        return np.fromiter(map(known.__getitem__, parts), np.int64, len(parts))

    def encode(self, column: pa.Array, words: Words | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts as int32, ends of the texts); null has none. ``words``: the texts' lower-cased words,
        where the caller has them already."""
        column = pc.fill_null(column, "")
        if not self.by_word:
            ids, lengths = _numbers(self.full.encode_batch_fast(column.to_pylist(), add_special_tokens=False))
            return ids, np.cumsum(lengths)
        if len(self.code) > self.most_words:
            self._clear()
        # A special token's text is matched in its own case.
        special = pc.any(pc.match_substring(column, SPECIAL)).as_py()
        if words is None or special:
            words = words_of(column, lower=not special)
        runs = np.stack(self._runs(words.distinct), 1)
        there = runs >= 0
        size = np.where(there, self.ids.length[np.where(there, runs, 0)], 0).sum(1)[words.codes]
        ends = np.concatenate([[0], np.cumsum(size)])[words.ends]
        ids, at = np.empty(int(size.sum()), np.int32), 0
        for a in range(0, len(words.codes), RUN_WORDS):
            own = runs[words.codes[a:a + RUN_WORDS]].ravel()
            part, _ = self.ids.take(own[own >= 0])
            ids[at:at + len(part)] = part
            at += len(part)
        pa.default_memory_pool().release_unused()  # else each batch's buffers stay with the worker
        return ids, ends


def vocabulary_size(path: str) -> int:
    """Ids that the vocabulary can give, without loading a tokenizer."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    return 1 + max([*spec["model"]["vocab"].values(), *(t["id"] for t in spec.get("added_tokens", []))])


_ENCODERS: dict[str, SubwordEncoder] = {}


def encoder(path: str) -> SubwordEncoder:
    """One encoder for each vocabulary file in each Python worker; its cache serves all tasks of the worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = SubwordEncoder(path)
    return _ENCODERS[path]
