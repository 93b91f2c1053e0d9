"""Token ids of whole texts by a lower-casing word-end BPE, from a cache of words."""

from __future__ import annotations

import os
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Signs that, behind a letter, always begin a new word of the vocabulary's own splitting.
TAIL = ".,!?;:|"
WIDTH = 512


class WordEncoder:
    """Encodes texts chunk by chunk between ASCII white space, each distinct chunk once.

    The vocabulary lower-cases, drops white space and never joins over it, so the ids of a text are those of its
    chunks in order; and a chunk of letters with closing signs is its letters, then its signs. Words are kept in two
    generations of ``words`` each; the elder is dropped when the younger is full, and its words are encoded anew.
    """

    def __init__(self, path: str, words: int = 350_000, longest: int = 64) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._words, self._longest = words, longest
        self._young: dict[str, bytes] = {}
        self._old: dict[str, bytes] = {}

    def _plain(self, words: list[str]) -> list[bytes]:
        got = self._tokenizer.encode_batch_fast(words, add_special_tokens=False)
        return [np.array(e.ids, np.uint32).tobytes() for e in got]

    def _letters(self, words: list[str]) -> list[bytes]:
        """Words of letters only: each is one word of the splitting, so many go through in one call."""
        out = []
        for begin in range(0, len(words), WIDTH):
            part = words[begin : begin + WIDTH]
            got = self._tokenizer.encode(" ".join(part), add_special_tokens=False)
            ids, of = np.array(got.ids, np.uint32), np.array(got.word_ids)
            cuts = np.flatnonzero(np.diff(of)) + 1
            if len(cuts) + 1 != len(part):
                return self._plain(words)
            bounds = [0, *cuts.tolist(), len(ids)]
            data = ids.tobytes()
            out += [data[4 * a : 4 * b] for a, b in zip(bounds, bounds[1:])]
        return out

    def _lookup(self, words: list[str]) -> list[bytes]:
        young, old = self._young, self._old
        found = [young.get(w) for w in words]
        unknown: dict[str, bytes | None] = {}
        for w, ids in zip(words, found):
            if ids is None:
                unknown[w] = old.get(w)
        new = [w for w, ids in unknown.items() if ids is None]
        letters = [w for w in new if w.isalpha()]
        others = [w for w in new if not w.isalpha()]
        unknown.update(zip(letters, self._letters(letters)))
        unknown.update(zip(others, self._plain(others)))
        result = [unknown[w] if ids is None else ids for w, ids in zip(words, found)]
        if len(young) + len(unknown) > self._words:
            self._old, self._young = young, {}
        self._young.update((w, ids) for w, ids in unknown.items() if len(w) <= self._longest)
        return result

    def encode(self, texts: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
        """All ids in one row, and where each text's ids begin (one more number than texts)."""
        lowered = pc.ascii_lower(texts)
        # A special token's own spelling is case-sensitive: such texts keep theirs.
        special = pc.match_substring(texts, "<|")
        if pc.any(special).as_py():
            lowered = pc.if_else(special, texts, lowered)
        split = pc.ascii_split_whitespace(lowered)
        chunks = split.flatten().dictionary_encode()
        # The distinct chunks as words and closing signs, again each distinct one once.
        words = pc.ascii_rtrim(chunks.dictionary, TAIL)
        ends_in_letter = pc.match_substring_regex(words, r"\pL$")
        words = pc.if_else(ends_in_letter, words, chunks.dictionary)
        signs = pc.struct_field(pc.extract_regex(chunks.dictionary, f"(?P<signs>[{TAIL}]*)$"), "signs")
        signs = pc.if_else(ends_in_letter, signs, "")
        words, signs = words.dictionary_encode(), signs.dictionary_encode()
        ids = self._lookup(words.dictionary.to_pylist()) + self._lookup(signs.dictionary.to_pylist())
        sizes = np.fromiter(map(len, ids), np.int32, len(ids)) // 4
        starts = np.cumsum(sizes, dtype=np.int32) - sizes
        pool = np.frombuffer(b"".join(ids), np.uint32)
        codes = chunks.indices.to_numpy(zero_copy_only=False)
        parts = np.empty((len(codes), 2), np.int32)
        parts[:, 0] = words.indices.to_numpy(zero_copy_only=False)[codes]
        parts[:, 1] = signs.indices.to_numpy(zero_copy_only=False)[codes] + len(words.dictionary)
        parts = parts.ravel()
        lengths = sizes[parts]
        ends = np.cumsum(lengths, dtype=np.int64)
        total = int(ends[-1]) if len(ends) else 0
        place = np.repeat((starts[parts] - (ends - lengths)), lengths)
        place += np.arange(total)
        chunk_ends = np.concatenate(([0], ends[1::2]))
        bounds = split.offsets.to_numpy(zero_copy_only=False)
        return pool[place], chunk_ends[bounds - bounds[0]]


@lru_cache(maxsize=1)
def encoder(path: str) -> WordEncoder:
    """One encoder for each Python worker."""
    return WordEncoder(path)
