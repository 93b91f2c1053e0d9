"""Token counts by byte-pair merging on a heap and a linked list, without making token ids."""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.arrow import pieces, utf8

#: Fixed values of the vocabulary: how it splits a text, and the ranges of bytes that its symbols show as themselves.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
SHOWN = ((0x21, 0x7E), (0xA1, 0xAC), (0xAE, 0xFF))

ROWS = "doc_id long, n_bytes long, n_tokens long"


def byte_symbols() -> list[str]:
    """The symbol of each byte: itself where it can be shown, else the next free character from 256 on."""
    hidden = 256
    symbols = []
    for byte in range(256):
        shown = any(low <= byte <= high for low, high in SHOWN)
        symbols.append(chr(byte if shown else hidden))
        hidden += not shown
    return symbols


class PairCounter:
    """Counts the tokens that byte-pair merging leaves of a text.

    ``ranks`` has the rank of every pair of symbols that merges. Counts of short stretches between white space, and of
    the words in them, are remembered in two generations of ``words`` each; the elder goes when the younger is full.
    """

    def __init__(self, path: str, words: int = 300_000, longest: int = 64) -> None:
        with open(path, encoding="utf-8") as file:
            rules = json.load(file)
        model = rules["model"]
        self._ranks = {tuple(pair): rank for rank, pair in enumerate(model["merges"])}
        self._ending = model["end_of_word_suffix"] or ""
        self._bytes = byte_symbols()
        self._words = regex.compile(SPLIT)
        special = "|".join(regex.escape(t["content"]) for t in rules["added_tokens"])
        self._special = regex.compile(special) if special else None
        self._most, self._longest = words, longest
        self._young: dict[str, int] = {}
        self._old: dict[str, int] = {}

    def merged(self, symbols: list[str]) -> int:
        """How many symbols are left when no adjacent pair merges any more.

        The pair of the lowest rank goes first, the leftmost of equal ones. The heap holds rank and place as one
        number; a pair whose symbols have changed since is known by its rank, which is no longer that of the place.
        Memory is about 100 bytes for each symbol.
        """
        ranks, n = self._ranks, len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []
        for i in range(n - 1):
            rank = ranks.get((symbols[i], symbols[i + 1]))
            if rank is not None:
                heap.append(rank << 40 | i)
        heapq.heapify(heap)
        merges, places = 0, (1 << 40) - 1
        while heap:
            best = heapq.heappop(heap)
            i = best & places
            j = after[i]
            if symbols[i] is None or j >= n or ranks.get((symbols[i], symbols[j])) != best >> 40:
                continue
            symbols[i] += symbols[j]
            symbols[j] = None
            merges += 1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                rank = ranks.get((symbols[i], symbols[k]))
                if rank is not None:
                    heapq.heappush(heap, rank << 40 | i)
            h = before[i]
            if h >= 0:
                rank = ranks.get((symbols[h], symbols[i]))
                if rank is not None:
                    heapq.heappush(heap, rank << 40 | h)
        return n - merges

    def _known(self, text: str) -> int | None:
        found = self._young.get(text)
        if found is None:
            found = self._old.get(text)
            if found is not None:
                self._remember(text, found)
        return found

    def _remember(self, text: str, count: int) -> None:
        if len(text) > self._longest:
            return
        if len(self._young) >= self._most:
            self._old, self._young = self._young, {}
        self._young[text] = count

    def _word(self, word: str) -> int:
        data = word.encode()
        symbols = [self._bytes[b] for b in data]
        symbols[-1] += self._ending
        return self.merged(symbols)

    def _ordinary(self, text: str) -> int:
        """Tokens of a text without special strings: composed, lower-cased sign by sign, split, merged."""
        # A capital sigma at a word's end has a lower case of its own only when whole words are lower-cased.
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        total = 0
        for match in self._words.finditer(text):
            word = match.group()
            known = self._known(word)
            if known is None:
                known = self._word(word)
                self._remember(word, known)
            total += known
        return total

    def count(self, text: str) -> int:
        """Tokens of any text; each special string is one."""
        if self._special is None or "<" not in text:
            return self._ordinary(text)
        specials, total, begin = 0, 0, 0
        for match in self._special.finditer(text):
            total += self._ordinary(text[begin : match.start()])
            specials, begin = specials + 1, match.end()
        return total + specials + self._ordinary(text[begin:])

    def counts(self, texts: pa.LargeStringArray) -> np.ndarray:
        """Tokens of each text. No word goes over white space, so each distinct stretch between it is counted once."""
        split = pc.ascii_split_whitespace(texts)
        chunks = split.flatten().dictionary_encode()
        sizes = []
        for chunk in chunks.dictionary.to_pylist():
            # Stretches and words share the memory; a mark keeps a stretch apart from the lower-cased word of its spelling.
            known = self._known(" " + chunk)
            if known is None:
                known = self.count(chunk)
                self._remember(" " + chunk, known)
            sizes.append(known)
        each = np.array(sizes, np.int64)[chunks.indices.to_numpy(zero_copy_only=False)] if sizes else np.zeros(0, np.int64)
        sums = np.concatenate(([0], np.cumsum(each)))
        bounds = split.offsets.to_numpy(zero_copy_only=False)
        return np.diff(sums[bounds - bounds[0]])


@lru_cache(maxsize=1)
def counter(path: str) -> PairCounter:
    """One counter for each Python worker."""
    return PairCounter(path)


def tokenizer_path() -> str:
    """The public vocabulary's place on the machine that asks; executors ask for themselves."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def token_counts(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """One row per document: the text's UTF-8 bytes and its tokens, without begin or end marks. No shuffle.

    A null text is empty: no bytes, no tokens. Repeated rows and null ids give a row each; other columns are left
    out. A text of any length is read whole; memory grows with its longest word.
    """
    names = [f.split()[0] for f in ROWS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(tokenizer or tokenizer_path()).counts
        for batch in batches:
            for part in pieces(batch, "text"):
                texts = utf8(part.column("text"))
                columns = [part.column("doc_id"), pc.binary_length(texts).cast(pa.int64()), pa.array(count(texts))]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, ROWS)


def limited_counts(docs: DataFrame, limit: int = 2048, tokenizer: str | None = None) -> DataFrame:
    """The counts, and whether a document has more tokens than ``limit``."""
    return token_counts(docs, tokenizer).withColumn("over_limit", F.col("n_tokens") > limit)
