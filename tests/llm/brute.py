"""Brute-force versions of the operators, row by row in plain Python."""

import hashlib
import re

LOWER = str.maketrans({c: chr(ord(c) + 32) for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
SPACED = re.compile("[^\x20\x09-\x0d]+")


def contamination(docs, items):
    """docs and items as (id, text): doc_id -> (n_words, n_hit, n_items, digest, contaminated)."""
    of = {}
    for item, text in items:
        words = tuple(WORD.findall((text or "").translate(LOWER)))
        for i in range(max(1, len(words) - 9)) if words else ():
            of.setdefault(words[i : i + 10], set()).add(str(item))
    out = []
    for doc, text in docs:
        words = tuple(WORD.findall((text or "").translate(LOWER)))
        hit, found = set(), set()
        for n in {len(w) for w in of}:
            for i in range(len(words) - n + 1):
                if words[i : i + n] in of:
                    hit.update(range(i, i + n))
                    found |= of[words[i : i + n]]
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc, len(words), len(hit), len(found), digest, bool(hit)))
    return out


def near_duplicates(docs, share=75):
    """docs as (id, text), ids unique: doc_id -> (n_shingles, component_id)."""
    sets = {}
    for doc, text in docs:
        words = SPACED.findall((text or "").translate(LOWER))
        sets[doc] = {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()
    root = {doc: doc for doc in sets}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= share * len(sets[a] | sets[b]):
                x, y = top(a), top(b)
                root[max(x, y)] = min(x, y)
    return {doc: (len(s), top(doc)) for doc, s in sets.items()}


def removed(docs, length=100):
    """docs as (id, text), ids unique: doc_id -> (n_bytes, n_removed, n_spans, digest of the rest)."""
    seen, out = set(), {}
    for doc, text in sorted(docs):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - length + 1):
            string = data[p : p + length]
            if string in seen:
                gone[p : p + length] = b"\1" * length
            seen.add(string)
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out[doc] = (len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def fill_middle(docs):
    """docs as (id, text): rows (doc_id, n, form, prefix_chars, middle_chars, output)."""
    out = []
    for doc, text in docs:
        text = text or ""
        digest = hashlib.sha256(f"1:{'' if doc is None else doc}".encode()).hexdigest()
        h1, h2, h3, h4 = (int(digest[8 * i : 8 * i + 8], 16) for i in range(4))
        a, b = sorted((h1 % (len(text) + 1), h2 % (len(text) + 1)))
        p, m, s = text[:a], text[a:b], text[b:]
        if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
            out.append((doc, len(text), "plain", None, None, text))
        elif h4 % 100 < 20:
            out.append((doc, len(text), "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"))
        else:
            out.append((doc, len(text), "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"))
    return out


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def climb(nodes, fanout):
    """The root over the nodes, and for each node its siblings (left, right) level by level."""
    paths, places, level = [[] for _ in nodes], list(range(len(nodes))), list(nodes)
    while len(level) > 1:
        for path, place in zip(paths, places):
            begin = place - place % fanout
            path.append(("".join(level[begin:place]), "".join(level[place + 1 : begin + fanout])))
        level = [H(*level[i : i + fanout]) for i in range(0, len(level), fanout)]
        places = [place // fanout for place in places]
    return (level[0] if level else None), paths


def manifest(rows, fanout):
    """rows as (source, order, leaf): (source, order, leaf, subroot, root, path) for each, sources as bytes, null first."""
    by_source = {}
    for source, order, leaf in rows:
        by_source.setdefault(source, []).append((order is not None, order or 0, leaf))
    sources = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: climb([leaf for *_, leaf in sorted(by_source[s])], fanout) for s in sources}
    root, tops = climb([trees[s][0] for s in sources], fanout)
    out = []
    for source, top in zip(sources, tops):
        subroot, paths = trees[source]
        for (there, order, leaf), path in zip(sorted(by_source[source]), paths):
            out.append((source, order if there else None, leaf, subroot, root, tuple(path + top)))
    return out
