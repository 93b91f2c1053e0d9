"""Benchmark decontamination: one Aho-Corasick automaton of all test windows, one scan of every text."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from millrace.llm.arrow import pieces, raw

#: A-Z become a-z; what is no word byte (digit, letter, or part of a non-ASCII character) becomes a space.
FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)

#: Item bytes at most. They are broadcast; at this size a worker holds 450 MB of arrays, and 1.3 GB while it builds them.
MOST_BYTES = 20 << 20

#: Words of a segment that is scanned as one lane; stands between texts, and is no word of any.
LANE, MARK = 64, b"\x00"

SPANS = ArrayType(
    StructType([StructField("start", LongType()), StructField("end", LongType()), StructField("items", ArrayType(StringType()))])
)


class Automaton:
    """An Aho-Corasick automaton over word numbers, as arrays.

    Patterns are the items' windows. Nodes are numbered level by level, each level in the order of (parent, word), so
    one sorted array of these pairs holds all edges, and an edge leads to the node of its own place. ``fail`` is the
    longest proper suffix that is a node too, ``ends`` the longest pattern that ends with the node. Node 0 is the root.
    """

    def __init__(self, items: tuple[tuple[str, bytes], ...], width: int) -> None:
        #: Distinct item ids in the order of strings, so numbers and names sort alike.
        self.names = sorted({item for item, _ in items})
        number = {item: i for i, item in enumerate(self.names)}
        self.words: dict[bytes, int] = {MARK: -2}
        text, starts, lengths, owners = [np.zeros(0, np.int32)], [], [], []
        at = 0
        for item, content in items:
            words = content.translate(FOLD).split()
            if not words:
                continue
            text.append(np.array([self.words.setdefault(w, len(self.words) - 1) for w in words], np.int32))
            n = max(1, len(words) - width + 1)
            starts.append(np.arange(at, at + n))
            lengths.append(np.full(n, min(width, len(words))))
            owners.append(np.full(n, number[item]))
            at += len(words)
        line = np.concatenate(text)
        start, length, owner = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (starts, lengths, owners))
        self.shortest, self.longest = (int(length.min()), int(length.max())) if len(length) else (1, 0)
        self._build(line, start, length, owner)

    def _build(self, line: np.ndarray, start: np.ndarray, length: np.ndarray, owner: np.ndarray) -> None:
        node = np.zeros(len(start), np.int64)
        keys, fails, depths = [], [np.zeros(1, np.int32)], [np.zeros(1, np.int8 if self.longest < 128 else np.int32)]
        self.keys, self.fail, self.first = np.zeros(0, np.int64), fails[0], np.zeros(len(self.words), np.int64)
        size = 1
        for depth in range(1, self.longest + 1):
            alive = length >= depth
            pairs = node[alive] << 32 | line[start[alive] + depth - 1]
            level, place = np.unique(pairs, return_inverse=True)
            node[alive] = size + place
            # Failures of a level go by those of the levels above, whose edges are there.
            parent, word = level >> 32, (level & 0xFFFFFFFF).astype(np.int64)
            if depth == 1:
                self.first[word] = np.arange(size, size + len(level))
                fails.append(np.zeros(len(level), np.int32))
            else:
                fails.append(self._next(self.fail[parent].astype(np.int64), word).astype(np.int32))
            depths.append(np.full(len(level), depth, depths[0].dtype))
            keys.append(level)
            self.keys, self.fail = np.concatenate(keys), np.concatenate(fails)
            size += len(level)
        self.depth = np.concatenate(depths)
        # Which items own the pattern of a node.
        owned = np.unique(node << 32 | owner)
        self.patterns, counts = np.unique(owned >> 32, return_counts=True)
        self.offsets, self.owners = np.concatenate(([0], np.cumsum(counts))), (owned & 0xFFFFFFFF).astype(np.int32)
        self.ends = np.zeros(size, np.int32)
        self.ends[self.patterns] = self.patterns
        begin = 1
        for level in keys:
            nodes = np.arange(begin, begin + len(level))
            none = nodes[self.ends[nodes] == 0]
            self.ends[none] = self.ends[self.fail[none]]
            begin += len(level)

    def _next(self, state: np.ndarray, word: np.ndarray) -> np.ndarray:
        """The states behind known words."""
        out = np.zeros(len(state), np.int64)
        left = np.flatnonzero(state)
        at = state[left]
        while len(left):
            key = at << 32 | word[left]
            place = np.searchsorted(self.keys, key)
            place[place == len(self.keys)] = 0
            found = self.keys[place] == key
            out[left[found]] = place[found] + 1
            at = self.fail[at[~found]].astype(np.int64)
            left = left[~found]
            left, at = left[at > 0], at[at > 0]
        rest = out == 0
        out[rest] = self.first[word[rest]]
        return out

    def numbers(self, line: bytes, at_most: int = 4 << 20) -> np.ndarray:
        """The numbers of a line's words, -1 for such as no item has; a long line is split part by part."""
        parts, begin = [np.zeros(0, np.int64)], 0
        while begin < len(line):
            end = line.find(b" ", begin + at_most)
            end = len(line) if end < 0 else end
            words = line[begin:end].split()
            parts.append(np.fromiter(map(self.words.get, words, repeat(-1)), np.int64, len(words)))
            begin = end
        return np.concatenate(parts)

    def occurrences(self, line: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(word behind, node) of every occurrence of a pattern in a line of word numbers.

        Only stretches of known words are scanned, and of these only such as can hold a pattern. A state depends on no
        more words than the longest pattern has, so a stretch is cut into lanes of ``LANE`` words, each of which reads
        that many words before it, and all lanes go ahead together.
        """
        nothing = np.zeros(0, np.int64)
        known = np.concatenate(([False], line >= 0, [False]))
        edge = np.flatnonzero(known[1:] != known[:-1])
        begin, end = edge[::2], edge[1::2]
        fits = end - begin >= self.shortest
        begin, end = begin[fits], end[fits]
        if not len(begin) or not self.longest:
            return nothing, nothing
        lanes = -(-(end - begin) // LANE)
        nth = np.arange(lanes.sum()) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        new = np.repeat(begin, lanes) + nth * LANE
        stop = np.minimum(new + LANE, np.repeat(end, lanes))
        at = np.maximum(new - self.longest + 1, np.repeat(begin, lanes))
        order = np.argsort(at - stop, kind="stable")
        at, new, stop = at[order], new[order], stop[order]
        state, ends, nodes = np.zeros(len(at), np.int64), [], []
        while len(at):
            state = self._next(state, line[at])
            hit = np.flatnonzero((self.ends[state] > 0) & (at >= new))
            place, node = at[hit] + 1, self.ends[state[hit]].astype(np.int64)
            while len(node):
                ends.append(place), nodes.append(node)
                node = self.ends[self.fail[node]].astype(np.int64)
                place, node = place[node > 0], node[node > 0]
            at = at + 1
            going = int(np.count_nonzero(at < stop))
            # Lanes are in the order of their lengths, so those that go on are the first ones.
            at, new, stop, state = at[:going], new[:going], stop[:going], state[:going]
        return (np.concatenate(ends), np.concatenate(nodes)) if ends else (nothing, nothing)

    def items_of(self, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in ``nodes``, item number) of all items that own these patterns."""
        at = np.searchsorted(self.patterns, nodes)
        counts = self.offsets[at + 1] - self.offsets[at]
        nth = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        return np.repeat(np.arange(len(nodes)), counts), self.owners[np.repeat(self.offsets[at], counts) + nth]


@dataclass(frozen=True)
class Shared:
    """The items on every executor, and the name under which a worker keeps their automaton."""

    name: str
    items: Broadcast


_BUILT: dict[tuple[str, int], Automaton] = {}


def automaton(shared: Shared, width: int) -> Automaton:
    """The worker's automaton, built once; that of an earlier job goes."""
    key = (shared.name, width)
    if key not in _BUILT:
        _BUILT.clear()
        _BUILT[key] = Automaton(shared.items.value, width)
    return _BUILT[key]


class Scan:
    """What the texts of a batch share with the patterns: one pass over all their words."""

    def __init__(self, machine: Automaton, texts: list[bytes]) -> None:
        self.machine = machine
        joint = b" " + MARK + b" "
        line = machine.numbers(joint.join([*(text.translate(FOLD) for text in texts), b""]))
        #: Behind each text stands a mark.
        marks = np.flatnonzero(line == -2)
        self.begins = np.concatenate(([0], marks[:-1] + 1)) if len(marks) else marks
        self.n_words = marks - self.begins
        self.behind, self.nodes = machine.occurrences(line)
        self.text_of = np.searchsorted(marks, self.behind - 1)
        self.size = len(line)

    def covered(self) -> np.ndarray:
        """For each text its words inside any occurrence."""
        edges = np.zeros(self.size + 1, np.int64)
        np.add.at(edges, self.behind - self.machine.depth[self.nodes], 1)
        np.add.at(edges, self.behind, -1)
        inside = np.concatenate(([0], np.cumsum(np.cumsum(edges) > 0)))
        return inside[self.begins + self.n_words] - inside[self.begins]

    def items(self) -> dict[int, list[str]]:
        """The texts that have any, with their items in the order of strings."""
        place, item = self.machine.items_of(self.nodes)
        found: dict[int, list[str]] = {}
        for pair in np.unique(self.text_of[place] << 32 | item).tolist():
            found.setdefault(pair >> 32, []).append(self.machine.names[pair & 0xFFFFFFFF])
        return found

    def occurrences(self) -> dict[int, list[tuple[int, int, list[str]]]]:
        """For each text (first word, word behind, items), in the order of places."""
        place, item = self.machine.items_of(self.nodes)
        of: dict[int, list[str]] = {}
        for k, i in sorted(zip(place.tolist(), item.tolist())):
            of.setdefault(k, []).append(self.machine.names[i])
        found: dict[int, list[tuple[int, int, list[str]]]] = {}
        for k in np.lexsort((self.behind, self.text_of)).tolist():
            text = int(self.text_of[k])
            behind = int(self.behind[k] - self.begins[text])
            found.setdefault(text, []).append((behind - int(self.machine.depth[self.nodes[k]]), behind, of[k]))
        return found


def places(text: bytes, hits: list) -> list[dict]:
    """The hits as character ranges of the original text."""
    word = np.frombuffer(text.translate(FOLD), np.uint8) != 32
    edge = np.flatnonzero(np.diff(np.concatenate(([False], word, [False])).astype(np.int8)))
    # Characters before a byte: those that begin there, all bytes but continuation bytes.
    before = np.concatenate(([0], np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)))
    return [
        {"start": int(before[edge[2 * a]]), "end": int(before[edge[2 * b - 1]]), "items": list(of)} for a, b, of in hits
    ]


def shared_items(benchmark: DataFrame, most_bytes: int) -> Shared:
    """The items as a broadcast, after their size has been checked."""
    size = benchmark.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    if size > most_bytes:
        raise ValueError(f"{size} bytes of benchmark texts; at most {most_bytes} are sent to every executor")
    rows = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")), "text").filter("text is not null")
    items = tuple((item, content.encode()) for item, content in sorted(tuple(r) for r in rows.collect()))
    return Shared(uuid.uuid4().hex, benchmark.sparkSession.sparkContext.broadcast(items))


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    width: int = 10,
    spans: bool = False,
    most_bytes: int = MOST_BYTES,
) -> DataFrame:
    """Adds to each document what it shares with the test items (``item_id``, ``text``).

    A window is ``width`` consecutive words of an item; an item of fewer words is one window. Added columns:
    ``n_words``, ``n_hit`` (words inside any occurrence of a window), ``n_items``, ``items_sha256`` (of the item ids,
    sorted as strings, comma-joined), ``contaminated``, and with ``spans`` the occurrences as character ranges of the
    original text. A column of the documents with such a name is replaced. Null or empty texts have no words; null
    items have no windows, a null item_id is the id ``null``; repeated items count once.

    The items are measured first and must fit ``most_bytes``. Each worker builds one automaton of them, once, and scans
    every document once where it lies, so there is no shuffle.
    """
    shared = shared_items(benchmark, most_bytes)
    added = "n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"
    names = [f.split()[0] for f in added.split(", ")] + ["spans"] * spans
    kept = [c for c in docs.columns if c not in names]
    frame = docs.select(*kept)
    schema = StructType(list(frame.schema.fields))
    for name, kind in [f.split() for f in added.split(", ")] + [("spans", SPANS)] * spans:
        schema = schema.add(name, kind)
    span_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("items", pa.list_(pa.string()))]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nothing = hashlib.sha256(b"").hexdigest()
        for batch in batches:
            for part in pieces(batch, text):
                texts = raw(part.column(text))
                found = Scan(automaton(shared, width), texts)
                n_hit, items = found.covered(), found.items()
                digests = [hashlib.sha256(",".join(items[k]).encode()).hexdigest() if k in items else nothing for k in range(len(texts))]
                new = [
                    pa.array(found.n_words, pa.int64()),
                    pa.array(n_hit, pa.int64()),
                    pa.array([len(items.get(k, ())) for k in range(len(texts))], pa.int64()),
                    pa.array(digests, pa.string()),
                    pa.array(n_hit > 0, pa.bool_()),
                ]
                if spans:
                    where = found.occurrences()
                    new.append(pa.array([places(content, where.get(k, [])) for k, content in enumerate(texts)], span_type))
                yield pa.RecordBatch.from_arrays([*part.columns, *new], names=[*kept, *names])

    return frame.mapInArrow(run, schema)


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per document its counts against the benchmark; see :func:`find_contamination`."""
    return find_contamination(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), benchmark).drop("text")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", width: int = 10) -> DataFrame:
    """The documents that hold no window of a test item, all columns as they were."""
    shared = shared_items(benchmark, MOST_BYTES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, text):
                found = Scan(automaton(shared, width), raw(part.column(text)))
                clean = np.ones(part.num_rows, bool)
                clean[found.text_of] = False
                yield part.filter(pa.array(clean))

    return docs.mapInArrow(run, docs.schema)


_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

SQL = f"""
WITH docs AS (SELECT doc_id, {_WORDS} AS w FROM documents),
items AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
starts AS (SELECT item_id, w, least(10, len(w)) AS n, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS i FROM items WHERE len(w) > 0),
wins AS (SELECT DISTINCT item_id, n, array_to_string(w[i : i + n - 1], ' ') AS g FROM starts),
grams AS (
  SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs, (SELECT DISTINCT n FROM wins))),
hits AS (SELECT doc_id, i, n, item_id FROM grams JOIN wins USING (n, g)),
covered AS (
  SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM hits) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  coalesce(items_sha256, sha256('')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM docs LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""
