"""Packing, archives, pages, chat, sharding, neighbours and the classifier."""

import gzip
import hashlib
import io
import json
import random
import zipfile
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from millrace.llm import chat, html_text, neighbours, packing, quality, sharding, warc, zipfiles
from millrace.llm.tokens import WordEncoder
from tests.llm.test_text_operators import docs_of, words

ODD = [None, "", " \n\t ", "don't I'LL 's", "<|endoftext|> <|EndOfText|>", "İI ΑΣ ǅ", "a\x0bb\x1cc", "é ́x", "!!a?,b..", "x" * 9000]


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(packing.tokenizer_path())


def ids_of(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


def test_encoder_is_the_tokenizer(spark, sf_dir, tokenizer):
    texts = [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect()]
    texts += [t or "" for t in ODD]
    encoder = WordEncoder(packing.tokenizer_path(), words=500)
    for _ in range(2):  # with an empty cache, then with a full one
        flat, bounds = encoder.encode(pa.array(texts, pa.large_string()))
        assert [flat[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == [ids_of(tokenizer, t) for t in texts]


@pytest.mark.parametrize("capacity", [16, 4096])
def test_packing(spark, tokenizer, capacity):
    rng = random.Random(5)
    texts = ODD + [" ".join(words(rng, rng.randrange(1, 60))) for _ in range(60)] + [" ".join(words(rng, 9000))] + ["same text"] * 9
    docs = docs_of(spark, [(7 if t == "same text" else i if i else None, t) for i, t in enumerate(texts)])
    rows = packing.pack_documents(docs, capacity, keep_ids=True).collect()
    wanted = Counter()
    for i, t in enumerate(texts):
        ids = ids_of(tokenizer, t) + [1]
        for k, begin in enumerate(range(0, len(ids), capacity)):
            cut = ids[begin : begin + capacity]
            crc = zlib.crc32(np.array(cut, "<u4").tobytes())
            wanted[(7 if t == "same text" else i if i else None, k, begin, len(cut), crc, tuple(cut))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32, tuple(r.ids)) for r in rows) == wanted
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in sequences.values():
        ends = np.cumsum([n for _, n in sorted(places)])
        assert [o for o, _ in sorted(places)] == [0, *ends[:-1]] and ends[-1] <= capacity
    assert len(sequences) <= -(-sum(r.length for r in rows) // capacity) + 1


def test_packing_without_rows(spark):
    assert packing.pack_documents(docs_of(spark, [])).count() == 0


def test_fill_uses_exact_sums():
    counts = np.zeros(21, np.int64)
    for length in (20, 12, 8, 11, 5, 4, 13, 3, 3, 1, 6, 6, 6, 2):
        counts[length] += 1
    filled = list(packing.Fill(counts).sequences())
    assert all(sum(lengths) == 20 for lengths, _ in filled) and sum(n for _, n in filled) == 5
    assert [12, 8] in [lengths for lengths, _ in filled]
    assert list(packing.Fill(np.zeros(5, np.int64)).sequences()) == []


def test_archives(spark, tmp_path):
    long, other = "<p>" + "x" * 1200 + "é", "<p>" + "y" * 2000
    pages = [(1, "http://a/ b\n", long), (2, None, long), (9, "u", long), (3, "u", "short"), (4, "u", "short"), (5, "u", None)]
    pages += [(6, "u", ""), (7, "u", other), (7, "u", other), (8, "u", other), (None, "u", other), (10, "u", "a\r\n\r\nb" + "z" * 999)]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("digest", F.lit(1))
    folder = (tmp_path / "archives").as_uri()
    got = Counter(tuple(r) for r in warc.archive_pages(spark, frame.repartition(3), folder).collect())
    wanted = Counter()
    for page, _, html in pages:
        data = (html or "").encode()
        target = {long: 9, other: 8}.get(html)
        target = None if target == page else target
        kind = "revisit" if target is not None else "response"
        wanted[(page, len(data), hashlib.sha1(data).hexdigest(), kind, target)] += 1
    assert got == wanted
    packages = list((tmp_path / "archives").glob("*.wacz"))
    assert packages and all(zipfile.ZipFile(p).testzip() is None for p in packages)
    paths = spark.createDataFrame([(p.as_uri(),) for p in packages], "path string")
    assert Counter(tuple(r) for r in warc.read_archives(paths, run_bytes=10).collect()) == wanted
    assert warc.archive_pages(spark, frame.limit(0), (tmp_path / "none").as_uri()).count() == 0


def test_packages_made_elsewhere(spark, tmp_path):
    """Two archives, an index packed twice, one archive without index, requests, a heading and a misleading comment."""
    made = [warc.record(k, "http://a/", f"page {k}".encode() * 40, 3 if k == 4 else None)[0] for k in range(9)]
    info = zlib.compress(b"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:1>\r\nContent-Length: 2\r\n\r\nab\r\n\r\n", wbits=31)
    other = b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:uuid:2>\r\nContent-Length: 23\r\n\r\nHTTP/1.1 200 OK\r\n\r\nbody\r\n\r\n"
    lines = ["!meta 0 {not an entry"]
    for archive, records in (("a.warc.gz", [info, *made[:3]]), ("b.warc.gz", made[3:6])):
        at = 0
        for data in records:
            entry = {"filename": archive, "offset": str(at), "length": str(len(data))}
            lines += [f"com,a)/ 2020 {json.dumps(entry)}"] * 2
            at += len(data)
    index = gzip.compress("\n".join(lines).encode())
    path = tmp_path / "made.wacz"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_STORED) as package:
        package.writestr("archive/a.warc.gz", info + b"".join(made[:3]))
        package.writestr("archive/b.warc.gz", b"".join(made[3:6]))
        package.writestr("archive/c.warc.gz", b"".join(made[6:]) + zlib.compress(other, wbits=31))
        package.writestr(zipfile.ZipInfo("indexes/index.cdx.gz"), index, zipfile.ZIP_DEFLATED)
        package.comment = b"PK\x05\x06 and more " * 3
    paths = spark.createDataFrame([(path.as_uri(),)], "path string")
    for run_bytes in (10, 1 << 20):
        got = warc.read_archives(paths, run_bytes).collect()
        assert sorted((r.page_id if r.page_id is not None else -1, r.payload_bytes, r.refers_to) for r in got) == sorted(
            [(k, 240, 3 if k == 4 else None) for k in range(9)] + [(-1, 4, None)], key=lambda r: r[0]
        )
    with zipfile.ZipFile(path, "a") as package:
        package.writestr("indexes/wrong.cdxj", 'x 1 {"filename": "z.warc.gz", "offset": 0, "length": 1}')
    with pytest.raises(Exception, match="names the archive z"):
        warc.read_archives(paths).collect()


def test_directory_of_large_packages():
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w", zipfile.ZIP_STORED, allowZip64=True) as package:
        with package.open("a", "w", force_zip64=True) as member:
            member.write(b"first")
        for i in range(66_000):  # more members than the plain directory can count
            package.writestr(f"m{i}", str(i))
        package.comment = b"PK"
        package.writestr(zipfile.ZipInfo("packed"), b"z" * 99, zipfile.ZIP_DEFLATED)
    members = zipfiles.directory(data, len(data.getvalue()))
    assert len(members) == 66_002
    for name, content in (("a", b"first"), ("m65999", b"65999")):
        assert zipfiles.read_range(data, zipfiles.data_start(data, members[name]), members[name].size) == content
    with pytest.raises(ValueError):
        zipfiles.data_start(data, members["packed"])
    with pytest.raises(ValueError):
        zipfiles.directory(io.BytesIO(b"no package" * 9), 90)


PAGE = """<!doctype html><html><head><title>T &amp; t</title><style>p{}</style></head><body class="no-sidebar">
<header><h1>Site</h1></header><nav><ul><li><a href=/>Home</a></ul></nav><div class="cookie-notice">We set cookies</div>
%s<aside>See also</aside><section id=comments><h2>3 comments</h2><p>Nice!</section>
<form><label>Mail</label><button>Go</button></form><script>var t="</p><p>x";</script><footer>&copy; Site</footer></body></html>"""


def test_pages():
    body = '<h1>A  &lt;title&gt;</h1><p>One<br>two <b>three</b> <!-- x --> f&eacute;ur</p><div class="ad">Buy</div><ul><li>a<li>b</ul>'
    wanted = "A <title>\n\nOne two three féur\n\na\n\nb"
    assert html_text.extract(PAGE % f"<article>{body}<footer>By me</footer></article>") == wanted
    assert html_text.extract(PAGE % f"<main>{body}</main>") == wanted
    long = "Words of a long text. " * 10
    blocks = f"<div class=text><p>{long}<p>Short end.</div>"
    assert html_text.extract(PAGE % blocks) == long.strip() + "\n\nShort end."
    assert html_text.extract("just text & more") == "just text & more"
    assert html_text.extract("") == html_text.extract("<div><script>x") == html_text.extract(PAGE % "") == ""
    assert html_text.extract("<div" * 20_000) == "" and html_text.extract("<p title='" * 3000).count("\n") == 0


def test_pages_go_by_their_sums_also_when_an_article_is_marked():
    long = "Words of a long text. " * 30
    page = f"<body><div class=text><p>{long}</div><article><p>Teaser: read on</article></body>"
    assert html_text.extract(page) == long.strip()
    assert html_text.extract(f"<body><p>Tagline</p><article><p>{long}</article></body>") == long.strip()
    assert html_text.extract(f"<article><h1>T</h1><div class=ad>x</div><p>{long}</article><article>b</article>") == f"T\n\n{long.strip()}\n\nb"


def test_pages_go_on_behind_what_is_set_aside():
    one, two = ("Words of a long text. " * 40).strip(), ("More of the text here. " * 35).strip()
    for between in ("<div class=ad>x</div>", "<aside>See also</aside><form>Mail</form>", "<div class=notice>n</div><p>Short.</p><nav>m</nav>"):
        short = "Short.\n\n" if "Short." in between else ""
        for whole in ("<div class=post><p>%s</p>%s<p>%s</p></div>", "<body><p>%s</p>%s<p>%s</p></body>", "<article><p>%s</p>%s<p>%s</p></article>"):
            assert html_text.extract(whole % (one, between, two)) == f"{one}\n\n{short}{two}"
    page = f"<div class=post><section><p>{one}</section><div class=ad>x</div><section><p>{two}</section></div>"
    assert html_text.extract(page) == f"{one}\n\n{two}"
    assert html_text.extract(f"<div class=post><p>{one}</p><article><p>Quoted</article><p>{two}</div>") == f"{one}\n\nQuoted\n\n{two}"
    page = f"<body><div class=top><p>Tagline</div><nav>Menu</nav><div class=post><p>{one}</div></body>"
    assert html_text.extract(page) == one


def test_wrappers_named_after_a_side_are_not_set_aside():
    long = ("Words of a long text. " * 30).strip()
    side = "<div class=sidebar><p>Side text</div><div class='nav-menu'>Menu</div>"
    for name in ("layout has-sidebar", "no-sidebar", "content-sidebar-wrap", "with-sidebar", "main-nav-open", "page header-layout"):
        for body in (f"<article><p>{long}</article>", f"<main><p>{long}</main>", f"<div class=text><p>{long}</div>"):
            assert html_text.extract(f"<body><div class='{name}'>{body}{side}</div><footer>By us</footer></body>") == long, name
    assert html_text.extract("<body><div class='with-sidebar'><article>short</article></div></body>") == "short"
    others = f"<section class=comments><article><p>{long}</article></section><div class=related><article>r</article></div>"
    assert html_text.extract(f"<body><article><p>Short post</article>{others}</body>") == "Short post"
    assert html_text.extract(f"<body><div class=post><p>{long}</div><div class=sidebar><p>{long}</div></body>") == long


def test_pages_as_rows(spark):
    rows = [(1, "u", "<p>a"), (1, "u", "<p>a"), (None, None, None), (2, "v", "<p>" + "é" * 200_000)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit(5))
    got = sorted(str((r.page_id, r.url, len(r.text), r.n_chars)) for r in html_text.extract_pages(frame).collect())
    assert got == sorted(map(str, [(1, "u", 1, 1), (1, "u", 1, 1), (None, None, 0, 0), (2, "v", 200_000, 200_000)]))
    assert html_text.extract_pages(frame.limit(0)).count() == 0


def test_chat(spark):
    rows = [(1, 2, "bo", "c"), (1, 1, "al", None), (1, 1, "al", None), (1, 0, "system", "be kind"), (1, 3, None, "d")]
    rows += [(2, 0, "system", "alone"), (None, 0, "al", "é<|end|>")] + [(3, i, "al" if i % 2 else "bo", f"t{i}") for i in range(130)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("position", F.lit(0))
    got = {(r.conv_id, r.perspective, r.segment): r for r in chat.rotate(frame).collect()}
    assert set(got) == {(1, p, 0) for p in ("al", "bo", "unknown")} | {(None, "al", 0)} | {
        (3, p, s) for p in ("al", "bo") for s in range(3)
    }
    row = got[(1, "bo", 0)]
    assert row.n_turns == 5 and row.text.startswith("<|turn|>system\nbe kind<|end|>\n<|turn|>user name=al\n<|end|>\n")
    assert [row.text[slice(*map(int, m.split("-")))] for m in row["mask"].split(",")] == ["c<|end|>\n"]
    for who in ("al", "bo"):
        parts = [got[(3, who, s)] for s in range(3)]
        own = [p.text[slice(*map(int, m.split("-")))] for p in parts for m in p["mask"].split(",")]
        assert own == [f"t{i}<|end|>\n" for i in range(130) if (i % 2 == 1) == (who == "al")]
    assert chat.rotate(frame.limit(0)).count() == 0


def test_sharding(spark):
    rows = [(i, "é" * (i % 5) if i % 7 else None) for i in range(3000)] + [(5, "same")] * 700 + [(None, "n")] * 3
    got = sharding.place_documents(docs_of(spark, rows), cells=8).collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows
    )
    shard_of = {}
    for r in got:
        assert shard_of.setdefault(r.doc_id, r.shard) == r.shard and r.grown_shard in (r.shard, 8) and r.law == "key"
    for s in range(8):
        slots = sorted(r.slot for r in got if r.shard == s)
        assert slots == list(range(len(slots))) and len({d for d, x in shard_of.items() if x == s}) > 250
    assert 200 < len({r.doc_id for r in got if r.grown_shard == 8}) < 480
    assert sharding.place_documents(docs_of(spark, [])).count() == 0


def test_sharding_follows_the_weights(spark):
    keys = spark.range(20_000)
    weights = {0: 1.0, 3: 2.0, 9: 5.0}
    shards = sharding.shard_rows(keys, ["id"], weights)
    share = {r.shard: r["count"] / 20_000 for r in shards.groupBy("shard").count().collect()}
    assert all(abs(share[s] - w / 8) < 0.02 for s, w in weights.items())
    less = sharding.shard_rows(keys, ["id"], {0: 1.0, 9: 5.0}, "less").join(shards, "id")
    assert less.filter("shard <> 3 and shard <> less").count() == 0
    with pytest.raises(ValueError):
        sharding.rendezvous(["id"], {0: 0.0})


def brute_nearest(rows, k=10, every=100):
    best = {}
    for key, vector in rows:
        usable = key is not None and vector is not None and all(x is not None and np.isfinite(x) for x in vector) and any(vector)
        if usable and (key not in best or vector < best[key]):
            best[key] = vector
    out = {}
    for q, v in best.items():
        if q % every == 0:
            far = sorted((float(np.linalg.norm(np.subtract(v, w))), i) for i, w in best.items() if i != q and len(w) == len(v))
            out[q] = far[:k]
    return out


def test_neighbours(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=8).round(3).tolist()) for i in range(900)]
    rows += [(1000 + i, rows[0][1]) for i in range(300)] + [(2000, [0.0] * 8), (2100, None), (2200, [1.0] * 7 + [None])]
    rows += [(2300, [float("nan")] * 8), (2400, [float("inf")] * 8), (None, [1.0] * 8), (2500, []), (5, rows[5][1]), (6, [9.0] * 8)]
    rows += [(3000, [1.0, 2.0]), (3001, [1.0, 3.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("vec", F.lit(0))
    wanted = brute_nearest(rows)
    found, right = {}, 0
    for r in neighbours.nearest(frame, leaf_share=1 / 30, block_rows=16, block_queries=2).collect():
        found.setdefault(r.query_id, []).append((r["rank"], r.score, r.vec_id))
    assert set(found) == set(wanted)
    for q, near in found.items():
        near.sort()
        assert [r for r, _, _ in near] == list(range(1, len(near) + 1)) and len(near) == len(wanted[q])
        assert [x[1:] for x in near] == sorted(x[1:] for x in near)
        right += len({i for _, _, i in near} & {i for _, i in wanted[q]})
    assert right >= 0.9 * sum(map(len, wanted.values()))
    assert [i for _, _, i in found[0]] == list(range(1000, 1010))
    assert neighbours.nearest(frame.limit(0)).count() == 0


def test_recall_on_the_table(spark):
    frame = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    wanted = brute_nearest([(r.vec_id, r.embedding) for r in frame.collect()])
    got = {(r.query_id, r.vec_id) for r in neighbours.nearest(frame).collect()}
    right = {(q, i) for q, near in wanted.items() for _, i in near}
    assert len(got & right) >= 0.9 * len(right)


def test_held_out_grades(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    model = quality.train(docs, labels, sample=2500)
    rated = quality.graded(labels).join(docs, "doc_id")
    fitted = rated.orderBy(F.xxhash64("doc_id"), "doc_id").limit(2500).select("doc_id")
    graded = quality.grade_documents(rated.join(fitted, "doc_id", "left_anti"), model).select("grade", "accepted", "expected_grade").toPandas()
    assert len(graded) > 1000
    assert graded[graded.grade == 2].accepted.mean() > 0.97
    assert graded[graded.grade == 0].accepted.mean() < 0.2 and graded[graded.grade == 1].accepted.mean() < 0.2
    means = graded.groupby("grade").expected_grade.mean()
    assert means[0] < means[1] < means[2]


def test_classifier_of_odd_rows(spark):
    docs = docs_of(spark, [(1, None), (2, ""), (2, "good words"), (3, "bad words"), (None, "x")]).withColumn("p_tail", F.lit("x"))
    labels = spark.createDataFrame([(2, 1, 0), (3, 0, 1), (3, 1, 0), (3, None, None), (None, 1, 0), (9, 1, 0)], "doc_id long, quality int, toxic int")
    model = quality.train(docs, labels)
    rows = quality.grade_documents(docs, model).collect()
    assert len(rows) == 5 and all(0 <= r.p_tail <= 1 and 0 <= r.expected_grade <= 2 for r in rows)
    assert (np.diff(model.thresholds) > 0).all()
    assert quality.score_documents(docs, labels.limit(0)).count() == 5
    assert quality.score_documents(docs.limit(0), labels).count() == 0
    assert quality.keep_accepted(docs, labels).columns == docs.columns


def test_a_repeated_document_is_fitted_once(spark, monkeypatch):
    fitted = []
    real = quality.fit
    monkeypatch.setattr(quality, "fit", lambda *a: fitted.append(len(a[3])) or real(*a))
    rows = [(1, f"text number {i}") for i in range(50)] + [(2, "good words"), (2, None), (3, "bad words")]
    labels = spark.createDataFrame([(1, 0, 0), (2, 1, 0), (3, 0, 1)], "doc_id long, quality int, toxic int")
    model = quality.train(docs_of(spark, rows), labels, sample=2)
    again = quality.train(docs_of(spark, rows[::-1]), labels, sample=2)
    assert fitted == [2, 2] and (model.words == again.words).all()


def test_tails_fall_and_gradient_is_right():
    rng = np.random.default_rng(1)
    ids = rng.integers(0, 50, 600)
    starts = np.arange(0, 601, 6)
    dense = rng.normal(size=(100, quality.SHAPES))
    grades = np.clip(np.round(dense[:, 0] + 1.5), 0, 3).astype(int)
    model = quality.fit(ids, starts, dense, grades, 3, 64)
    tails = model.tails(ids, starts, dense)
    assert (np.diff(tails, axis=1) <= 0).all()
    assert np.corrcoef(tails.sum(axis=1), grades)[0, 1] > 0.9
