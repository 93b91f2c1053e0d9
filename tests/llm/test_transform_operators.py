"""Fill-in-middle, token counts and the manifest against plain Python and the tokenizer's own library."""

import hashlib
import random
import string
import zlib
from collections import Counter

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.llm import fill_middle, manifest, token_counts
from tests.llm import brute
from tests.llm.test_other_operators import ODD
from tests.llm.test_text_operators import docs_of, words

SIGNS = ["", "<P>", "a<S>b", "<M", "<P<P>", ">", "é", "日本語テキスト", "😀" * 7, "áb", "<", "P>", "\x00", "<S>" * 3]


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(token_counts.tokenizer_path())


@pytest.fixture(scope="module")
def counter():
    return token_counts.PairCounter(token_counts.tokenizer_path(), words=300)


def odd_rows():
    rng = random.Random(11)
    texts = ODD + SIGNS + [" ".join(words(rng, rng.randrange(1, 90))) + rng.choice(SIGNS) for _ in range(120)]
    rows = [(i if i % 41 else None, t) for i, t in enumerate(texts)] + [(5, texts[60]), (5, texts[60]), (6, "x" * 300_000)]
    return rows


def test_fill_middle(spark):
    rows = odd_rows()
    got = fill_middle.fill_middle(docs_of(spark, rows).repartition(3)).collect()
    assert Counter(tuple(r) for r in got) == Counter(brute.fill_middle(rows))
    assert {r.form for r in got} == {"plain", "psm", "spm"}
    back = fill_middle.restored(fill_middle.fill_middle(docs_of(spark, rows))).collect()
    assert Counter((r.doc_id, r.restored) for r in back) == Counter((d, t or "") for d, t in rows)


def test_fill_middle_digests(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    wanted = brute.fill_middle([(r.doc_id, r.text) for r in docs.collect()])
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    assert sorted(tuple(r) for r in fill_middle.digests(docs).collect()) == sorted(
        (*row[:5], sha(row[5]), sha(texts[row[0]])) for row in wanted
    )
    assert fill_middle.digests(docs.limit(0)).count() == 0


@given(st.text(alphabet="ab<PSM>é😀", max_size=30), st.integers(0, 99), st.integers(0, 99), st.sampled_from(["psm", "spm"]))
@settings(max_examples=300, deadline=None)
def test_rotations_and_their_inverse(text, one, two, form):
    if any(s in text for s in ("<P>", "<S>", "<M>")):
        return
    a, b = sorted((one % (len(text) + 1), two % (len(text) + 1)))
    data = bytearray(text.encode())
    fill_middle.arrange(data, len(text[:a].encode()), len(text[:b].encode()), form)
    p, m, s = text[:a], text[a:b], text[b:]
    assert data.decode() == (f"<P>{p}<S>{s}<M>{m}" if form == "psm" else f"<S>{s}<P>{p}<M>{m}")
    fill_middle.restore(data, form)
    assert data.decode() == text


def test_counts_are_the_tokenizers(spark, tokenizer):
    rows = odd_rows()
    got = token_counts.limited_counts(docs_of(spark, rows).repartition(2), limit=20).collect()
    wanted = Counter()
    for doc, text in rows:
        n = len(tokenizer.encode(text or "", add_special_tokens=False).ids)
        wanted[(doc, len((text or "").encode()), n, n > 20)] += 1
    assert Counter(tuple(r) for r in got) == wanted
    assert token_counts.limited_counts(docs_of(spark, [])).count() == 0


def test_counts_of_a_whole_table(spark, tokenizer):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    wanted = {r.doc_id: len(tokenizer.encode(r.text or "", add_special_tokens=False).ids) for r in rows}
    assert {r.doc_id: r.n_tokens for r in token_counts.token_counts(docs).collect()} == wanted


PARTS = ["'s", "'LL", "don't", "İ", "Σ", "ΑΣ", "ß", "é", "한", "ﬁ", "²", "٣", "<|endoftext|>", "<|ENDOFTEXT|>"]
PARTS += ["<|startoftext|>", "́", " ", " ", "\x1c", "\x85", "\x0b", "😀", "‍", " ", "\n", "the", "running", "!!", "..", "_", "1234"]


@given(st.lists(st.one_of(st.sampled_from(PARTS), st.text(alphabet=string.ascii_letters, max_size=6), st.text(max_size=3)), max_size=12))
@settings(max_examples=600, deadline=None)
def test_counts_of_odd_texts(tokenizer, counter, parts):
    text = "".join(parts)
    wanted = len(tokenizer.encode(text, add_special_tokens=False).ids)
    assert counter.counts(pa.array([text, "", text], pa.large_string())).tolist() == [wanted, 0, wanted]


def test_merges_go_by_rank_then_place(counter):
    assert counter.merged([]) == 0 and counter.merged(["q"]) == 1
    word = "xyzzyqqab" * 4000  # one word of 36,000 symbols: the heap keeps this from being quadratic
    assert counter.count(word) == counter.count(word)
    assert counter.count("a" * 3) < 3


SIZES = [1, 2, 3, 4, 5, 9, 27, 28]


@pytest.mark.parametrize("fanout", [3, 16])
def test_manifest(spark, fanout):
    rng = random.Random(fanout)
    rows = []
    for k, size in enumerate(SIZES):
        source = None if k == 0 else "" if k == 1 else f"s{'é' * (k % 3)}{k}"
        rows += [(source, rng.randrange(40), brute.H(str((k, i)))) for i in range(size)]
    rows += [("hot", i, brute.H(f"h{i}")) for i in range(300)] + [("hot", 7, brute.H("same"))] * 3 + [("hot", None, brute.H("null"))]
    frame = spark.createDataFrame(rows, "source string, at long, leaf string").repartition(5)
    frame = frame.withColumns({"lo": F.lit(1), "root": F.lit("x"), "path": F.lit(0), "tree": F.lit(9)})
    got = manifest.manifest(frame, "source", "at", "leaf", fanout=fanout).collect()
    wanted = Counter(brute.manifest(rows, fanout))
    assert Counter((r.source, r["at"], r.leaf, r.subroot, r.root, tuple((p.left, p.right) for p in r.path)) for r in got) == wanted


def test_manifest_of_one_row_and_of_none(spark):
    one = spark.createDataFrame([("s", 1, "leaf")], "source string, at long, leaf string")
    row = manifest.manifest(one, "source", "at", "leaf").first()
    assert (row.subroot, row.root, row.path) == ("leaf", "leaf", [])
    assert manifest.manifest(one.limit(0), "source", "at", "leaf").count() == 0


def part(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def test_documents_verify_unless_tampered(spark):
    rows = [(i, [None, "A b", "lower", "É ÀA", ""][i % 5], [None, "en", ""][i % 3], [None, "x", "y"][i * i % 3], i) for i in range(90)]
    rows += [(None, "Text", None, "x", None), (None, "Text", None, "x", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = manifest.verify_documents(docs.withColumns({"tampered": F.lit(1), "leaf": F.lit(2)})).collect()
    assert len(got) == len(rows)
    leaf = {r[0]: brute.H(part(r[0]), part(r[3]), part(r[2]), part(r[4]), part(r[1])) for r in rows}
    trees = brute.manifest([(r[3], r[0], leaf[r[0]]) for r in rows], 16)
    of = {(order, digest): (subroot, root, path) for _, order, digest, subroot, root, path in trees}
    texts = {r[0]: r[1] for r in rows}
    for r in got:
        subroot, root, path = of[(r.doc_id, r.leaf)]
        if r.doc_id is not None:
            assert (r.leaf, r.subroot, r.root) == (leaf[r.doc_id], subroot, root)
            assert r.proof_sha256 == brute.H(*[left + right for left, right in path])
        changed = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0
        differs = any(c in string.ascii_uppercase for c in texts[r.doc_id] or "")
        assert r.verified == (not (changed and differs)) == (r.folded_root == r.root)
    assert {r.verified for r in got} == {True, False}
