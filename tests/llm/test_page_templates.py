"""Pages of several templates, made from known blocks: what comes out is what was put in, and nothing else."""

import html
import random
import time

import pytest

from millrace.llm import html_text

SENTENCE = "This is one of the sentences that an article is made of, and it goes on for some time. "


def blocks_of(rng):
    """Paragraphs, headings, list items and quotes of an article, with characters that need references."""
    out = []
    for k in range(rng.randrange(4, 12)):
        kind = rng.choice(["p", "p", "p", "h2", "li", "blockquote", "pre"])
        text = {"h2": f"Heading {k}", "li": f"Point {k} of <the> list & more"}.get(kind, SENTENCE * rng.randrange(1, 5) + f"No. {k} – é")
        out.append((kind, text.strip()))
    return [("p", SENTENCE * 3 + "First."), *out, ("p", SENTENCE * 2 + "Last.")]


def marked_up(rng, blocks, extra):
    """The blocks as HTML; between them what the extra gives, which is no part of the text."""
    out = []
    for kind, text in blocks:
        shown = html.escape(text)
        if rng.random() < 0.3:
            shown = shown.replace("one", "<b>one</b>").replace("article", '<a href="/a">article</a>')
        out.append(f"<{kind}>{shown}</{kind}>" if kind != "li" else f"<ul><li>{shown}</ul>")
        out.append(extra(rng))
    return "\n".join(out)


INTERRUPTIONS = [
    "", "", '<div class="ad">Buy this now</div>', "<aside><p>See also the other page</aside>", "<script>var a = '<p>';</script>",
    "<svg/>", '<svg viewBox="0"><path d="M0"/></svg>', '<math/>', '<iframe src="x"/>', "<button>Share", "<select><option>1</select>",
    "<!-- <p>old text</p> -->", "<figure><img src=x alt=y></figure>", "<form><input name=q><button>Go</button></form>", "</section>", "<title>",
]

LINKS = "".join(f"<li><a href=/{k}>Item {k}</a>" for k in range(9))
COMMENTS = f'<section id="comments"><h3>2 comments</h3><div class="comment"><p>{SENTENCE * 2}</div></section>'

TEMPLATES = {
    "article": f"<body><header><h1>Site</h1></header><nav><ul>{LINKS}</ul></nav><article>%s</article>{COMMENTS}<footer>&copy; Site</footer>",
    "main in wrappers": f'<body class="has-sidebar"><div class="main-nav-open"><ul class="menu">{LINKS}</ul><main>%s</main></div><div class="sidebar"><ul>{LINKS}</ul></div>',
    "plain blocks": f'<body><div id="header">Site</div><div id="nav"><ul>{LINKS}</ul></div><div class="post">%s</div><div id="footer">Imprint</div>',
    "table layout": f"<body><table><tr><td class=menu><ul>{LINKS}</ul></td><td class=body>%s</td></tr></table>",
    "blog with teasers": f'<body><main><article class="post"><div class="entry">%s</div></article></main><div class="related"><article><p>{SENTENCE}</article></div>',
    "roles": f'<body><div role="banner">Site</div><div role="navigation"><ul>{LINKS}</ul></div><div role="main">%s</div><div role="contentinfo">Imprint</div>',
    "search words inside": f"<body><nav><ul>{LINKS}</ul></nav><article><div class='search-engine-history'>%s</div></article>",
}


@pytest.mark.parametrize("name", list(TEMPLATES))
def test_templates(name):
    for seed in range(25):
        rng = random.Random(f"{name}{seed}")
        blocks = blocks_of(rng)
        page = TEMPLATES[name] % marked_up(rng, blocks, lambda r: r.choice(INTERRUPTIONS)).replace("%", "%%")
        page = f"<!doctype html><html><head><title>T</title><style>p{{}}</style></head>{page}</body></html>"
        wanted = "\n\n".join(" ".join(text.split()) for _, text in blocks)
        got = html_text.extract(page)
        got = "\n\n".join(line for line in got.split("\n\n") if line != "Share")  # the label of a button that never ends
        assert got == wanted


def brute_runs(weights, window):
    """The runs of window sums above nothing, by adding up every window."""
    sums = [sum(weights[i : i + window]) for i in range(len(weights))]
    runs, begin = [], None
    for i, total in enumerate([*sums, 0]):
        if total and begin is None:
            begin = i
        if not total and begin is not None:
            runs.append((begin, i, max(sums[begin:i])))
            begin = None
    return runs


def test_unmarked_pages_against_brute_force():
    """Blocks of one flat page, some of them set aside: the runs that surge, or else the heaviest."""
    for seed in range(60):
        rng = random.Random(seed)
        lines = [(rng.random() < 0.35, "x" * rng.choice([1, 5, 20, 40, 90, 300])) for _ in range(rng.randrange(1, 25))]
        # Each line stands in a block of its own, and what is set aside stands between blocks of different parents.
        page = "<body>" + "".join(
            f"<nav><div>{text}</div></nav>" if aside else f"<section><div><p>{text}</p></div></section>" for aside, text in lines
        )
        weights, place, last_aside = [], [], True
        for aside, text in lines:
            if not aside:
                if last_aside and weights:
                    weights += [0] * html_text.WINDOW
                place.append((len(weights), text))
                weights.append(len(text))
            last_aside = aside
        runs = brute_runs(weights, html_text.WINDOW)
        found = html_text.extract(page).split("\n\n") if place else []
        within = [[t for p, t in place if a <= p < b] for a, b, _ in runs]
        strong = [run for run, (_, _, top) in zip(within, runs) if top >= html_text.SURGE]
        heaviest = max(within, key=lambda run: sum(map(len, run)), default=[])
        wanted = [t for run in strong for t in run] if strong else heaviest
        assert found == wanted


HOSTILE = 100_000


@pytest.mark.parametrize(
    "page",
    ["<div>" * HOSTILE + "</sect>" * HOSTILE, "</sect>" * (2 * HOSTILE), "<title>" * (2 * HOSTILE), "<svg>" * (2 * HOSTILE),
     "<button>" * HOSTILE + "</button>" * HOSTILE, "<svg>" * HOSTILE + "<title>x</title>" * HOSTILE, "<p>x" * HOSTILE, "<a href=x>" * HOSTILE,
     "<script>" * HOSTILE, "<div class=nav>" * HOSTILE + "x"],
    ids=range(10),
)
def test_hostile_pages_take_linear_time(page):
    begin = time.process_time()
    html_text.extract(page)
    assert time.process_time() - begin < 6  # a fraction of a second to two seconds; quadratic code takes hours


def test_what_is_never_text_ends_where_its_parent_does():
    around = "<body><article><p>%s before</p>%s<p>%s behind</p></article><footer>x</footer>"
    for between in ("<svg/>", "<svg class='i' />", "<math/>", '<iframe src="x"/>', "<button>", "<select>", "<title>", "<textarea>"):
        got = html_text.extract(around % (SENTENCE * 4, between, SENTENCE * 4))
        assert "before" in got and "behind" in got, between
    assert html_text.extract(around % (SENTENCE * 4, "<div><object>Go</div>", SENTENCE * 4) + "</object>").count("Go") == 0
    assert "gone" not in html_text.extract("<article><p>" + SENTENCE * 3 + "<template><p>gone</p></template><svg><g>gone</g></svg></article>")
