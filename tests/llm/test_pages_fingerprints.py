"""Page text and fingerprints against plain versions."""

from __future__ import annotations

import hashlib
import random

import numpy as np

from loanbook.llm.fingerprint import Fingerprint, edited, fingerprint_documents, in_order, paragraphs
from loanbook.llm.page_text import END, LEGAL, PEAK_SHARE, SURGE, WINDOW, extract, main_text, page_lines, stretches

FULL = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head>
<body class="page"><header><h1>Site</h1></header><nav><ul><li><a href="/a">Menu</a></li></ul></nav>
<div id="cookie-notice">We use cookies</div><div class="sidebar widget"><p>Side</p></div>
<article><h1>Head &amp; line</h1><p class="lead">First  <b>para</b>graph
 goes on.</p><div class="ad">Buy</div><p>Short.<p>Second&nbsp;<i>one</i> &lt;x&gt; &#233;<br>after</p>
<form><input name=a><label>Mail</label></form><section class="comments"><article class="comment"><p>Reader says</p></article></section></article>
<aside>More</aside><footer>&copy; 2020</footer></body></html>"""


def test_articles_without_the_rest():
    assert main_text(FULL) == "Head & line\nFirst paragraph goes on.\nShort.\nSecond one <x> é after"


def test_pages_without_an_article():
    body = "".join(f"<p>{'Long sentence number %d of the text. ' % i * 3}</p><p>Ti.</p>" for i in range(4))
    page = f"<html><body><div><a href=x>One</a> <a href=y>Two</a></div><ul><li><a>Link text of a list</a></li></ul><div class='menu'>M</div>{body}<div class=footer>Foot</div></body></html>"
    text = main_text(page)
    assert text.count("\n") == 7 and text.startswith("Long sentence number 0") and "Foot" not in text and "Link" not in text


PARAGRAPHS = [f"Sentence {i} of the body goes on for a while and says something. " * 4 for i in range(8)]
BODY = "".join(f"<p>{p}</p>" for p in PARAGRAPHS)
CARDS = "".join(f"<article><h3><a href=/{i}>Other story {i}</a></h3><p>Two words more.</p></article>" for i in range(5))


def test_marks_are_only_a_weight():
    want = "\n".join(p.strip() for p in PARAGRAPHS)
    assert main_text(f"<body><div>{BODY}</div><div>{CARDS}</div></body>") == want
    assert main_text(f"<body><main>{BODY}{CARDS}</main></body>") == want
    assert main_text(f"<body><main><article>{BODY}</article><p>{'Beside the article. ' * 6}</p></main></body>") == want
    short = "<h1>T</h1><div class=ad>x</div><form>y</form><div class=ad>z</div><p><a href=a>One</a></p><p><a href=b>Two</a></p><p><a href=c>Three</a></p><p>End.</p>"
    assert main_text(f"<article>{BODY}{short}</article>") == want + "\nT\nOne\nTwo\nThree\nEnd."
    both = main_text(f"<body><article>{BODY}</article><article>{BODY}</article></body>")
    assert both == want + "\n" + want


def test_removed_blocks_do_not_end_an_unmarked_text():
    long = "".join(f"<p>{p * 4}</p>" for p in PARAGRAPHS)
    want = main_text(f"<article>{long}</article>")
    end = ("Closing words of the text. " * 10).strip()
    for block in ("<div class=ad>Buy</div>", "<div id=cookie-notice>We use them</div>", "<ul class=menu><li><a href=a>Menu</a></li></ul>", "<form><p>Mail</p></form><div class=sponsor>By</div><div class=ad>Buy</div>"):
        page = f"<body><nav>Site</nav><div><h1>Title</h1>{block}{long}{block}<p>{end}</p></div><div class=footer>Foot</div><p>Legal.</p></body>"
        assert main_text(page) == f"Title\n{want}\n{end}", block
    assert main_text(f"<body><p>Slogan</p><header>Site</header>{long}</body>") == want
    assert main_text(f"<body><p><a href=a>One</a></p><ul class=menu><li>M</li></ul>{long}<ul class=menu><li>M</li></ul><p><a href=b>Two</a></p></body>") == want


def test_heading_slugs_are_no_adverts():
    slugs = ("related-work", "social-history", "navigation-systems", "market-share", "recommendations", "comments", "search", "ad-hoc-networks")
    parts = "".join(f"<section id='{s}'><h2 id={s}><a href='#{s}'>On {s}</a></h2><p>Text of {s}.</p></section>" for s in slugs)
    want = "\n".join(f"On {s}\nText of {s}." for s in slugs)
    title = '<header><h1>Title</h1></header><div class="entry-header"><h2>Subtitle</h2></div><div class="social-history">Kept.</div>'
    links = "<div class=share-links-top><a href=x>Here</a> <a href=y>There</a></div><div class='ad box'>Buy</div><div id=comments>Reader</div><p class=share>Share</p>"
    for tag in ("article", "main"):
        assert main_text(f"<body><{tag}>{title}{parts}{links}<p>End.</p></{tag}></body>") == f"Title\nSubtitle\nKept.\n{want}\nEnd."
    assert main_text(f"<body><div class=entry-header><h1>Title</h1></div>{BODY}<h2 id=recommendations>Advice</h2><section id=related-work><p>Work.</p></section></body>").split("\n")[::9] == ["Title", "Advice"]
    assert "Work." in main_text(f"<body>{BODY}<section id=related-work><p>Work.</p></section></body>")


def test_broken_markup_never_fails():
    rng = random.Random(6)
    for page in ["", "plain text only", "<", "<p", "<p>a<div>b</p>c</div>", "<!-- open", "<script>x", "<a href='>x", "</p></p>", "a & b &amp", "<nav>n<article>kept</article>",
                 "<p class=ad>gone<p>kept text", "<b>x" * 2000, "<div>" * 5000 + "deep"]:
        assert isinstance(main_text(page), str)
    assert main_text("plain text only") == "plain text only"
    assert main_text("<nav>n<article>kept</article>") == "kept"
    assert main_text("<p class=ad>gone<p>kept text") == "kept text"
    for _ in range(300):
        main_text("".join(rng.choice(FULL) for _ in range(200)))
        cut = rng.randint(0, len(FULL))
        main_text(FULL[:cut] + FULL[rng.randint(0, len(FULL)) :])


def plain_stretches(weight):
    """By loops: runs of lines whose window sums are above zero, cut to their first and last line of weight."""
    sums = [sum(weight[i : i + WINDOW]) for i in range(len(weight))]
    found, i = [], 0
    while i < len(sums):
        if sums[i] <= 0:
            i += 1
            continue
        j = i
        while j < len(sums) and sums[j] > 0:
            j += 1
        heavy = [k for k in range(i, j) if weight[k] > 0]
        found.append((heavy[0], heavy[-1] + 1, max(sums[i:j])))
        i = j
    return found


def plain_text(page):
    """The choice of lines by loops over all of them."""
    lines = page_lines(page)
    weight, text = [float(w) for w in lines.weights()], lines.text
    found = plain_stretches(weight)
    if not found:
        return ""
    peak = max(top for _, _, top in found)
    surge = max(1, min(peak, max(SURGE, PEAK_SHARE * peak)))
    kept = {k for k, (_, _, top) in enumerate(found) if top >= surge}
    for order in (range(len(found)), reversed(range(len(found)))):
        before = None
        for k in order:
            if before in kept and k not in kept:
                a, b = sorted((before, k))
                gap = range(found[a][1], found[b][0])
                own = range(found[k][0], found[k][1])
                if all(not text[i] and lines.section[i] != END for i in gap) and 2 * sum(lines.weight[i] for i in own) >= sum(len(text[i]) for i in own):
                    kept.add(k)
            before = k
    stays = set()
    last = None
    for k in sorted(kept):
        if last is not None and found[last][1] < found[k][0] and all(text[i] for i in range(found[last][1], found[k][0])):
            stays.update(range(found[last][1], found[k][0]))
        stays.update(range(found[k][0], found[k][1]))
        last = k
    for i in sorted(stays, reverse=True):
        if lines.marked[i] or (text[i] and not LEGAL.match(text[i])) or len(text[i]) > SURGE:
            break
        stays.remove(i)
    return "\n".join(text[i] for i in sorted(stays) if text[i])


def test_stretches_equal_loops():
    assert [tuple(x) for x in stretches(np.array([0, 0, 0, 0, 5, 9, 0, 3, 0, 0, 0, 0, 1.0]))] == [(4, 8, 14.0), (12, 13, 1.0)]
    assert stretches(np.zeros(0)) == [] and stretches(np.zeros(2)) == []
    rng = random.Random(9)
    for _ in range(300):
        weight = [rng.choice((0, 0, 0, 1, 40, 300)) for _ in range(rng.randint(0, 30))]
        assert stretches(np.array(weight, float)) == plain_stretches(weight)


def _random_page(rng):
    parts = []
    for _ in range(rng.randint(0, 25)):
        words = " ".join(["word"] * rng.choice((1, 2, 8, 40, 90)))
        parts.append(rng.choice((
            f"<p>{words}</p>", f"<p>{words}</p>", f"<li><a href=x>{words}</a></li>", f"<div class=ad>{words}</div>", f"<div class='{rng.choice(NAMES)}'><p>{words}</p>",
            "</div>", f"<nav>{words}</nav>", f"<article><p>{words}</p></article>", "<article>", "</article>", f"<footer>{words}</footer>", "<p>Copyright words</p>", f"<h2>{words}",
        )))
    return "<body>" + "".join(parts) + "</body>"


NAMES = ("site has-sidebar", "layout-no-sidebar", "page menu-open", "elementor-widget elementor-widget-text-editor", "search-result-page", "sidebar", "site-footer", "post-comments")


def test_chosen_lines_equal_loops_on_random_pages():
    rng = random.Random(11)
    filled = 0
    for _ in range(500):
        page = _random_page(rng)
        assert main_text(page) == plain_text(page)
        filled += bool(main_text(page))
    assert filled > 300


def test_wrappers_are_not_dropped_for_their_names():
    want = "\n".join(p.strip() for p in PARAGRAPHS)
    for name in NAMES[:5]:
        assert main_text(f"<body><nav>N</nav><div class='{name}'>{BODY}</div><div class=site-footer><p>About us and more.</p></div></body>") == want, name
        assert main_text(f"<body><div id='{name.split()[-1]}'><div class='{name}'>{BODY}</div></div></body>") == want
        assert main_text(f"<body><div class='{name}'><article>{BODY}</article><div class='sidebar-left'><p>Side words.</p></div></div></body>") == want
    widgets = "".join(f"<div class='{NAMES[3]}'><p>{p}</p></div>" for p in PARAGRAPHS[:4])
    assert main_text(f"<body>{widgets}<div class='elementor-widget'><p>Short.</p></div></body>").startswith("\n".join(p.strip() for p in PARAGRAPHS[:4]))
    for name in ("comments", "post-comments", "ad", "site-footer", "newsletter-box"):
        assert main_text(f"<body>{BODY}<div class='{name}'><p>{'Reader words here. ' * 9}</p></div></body>") == want, name


def test_link_lists_and_edges():
    want = [p.strip() for p in PARAGRAPHS]
    items = "".join(f"<li><a href=/{i}>Linked thing {i}</a></li>" for i in range(5))
    half = [f"<p>{p}</p>" for p in PARAGRAPHS]
    listed = main_text(f"<body>{''.join(half[:4])}<ul>{items}</ul>{''.join(half[4:])}</body>")
    assert listed == "\n".join(want[:4] + [f"Linked thing {i}" for i in range(5)] + want[4:])
    menu = "<ul><li><a href=a>Home</a></li><li><a href=b>World</a></li><li><a href=c>Sport</a></li><li><a href=d>Money</a></li></ul>"
    assert main_text(f"<body>{menu}{BODY}{menu}</body>") == "\n".join(want)
    assert main_text(f"<body>{BODY}<p>Copyright 2020 Example</p><p><a href=x>Imprint</a></p></body>") == "\n".join(want)
    assert main_text(f"<body>{BODY}<p>Copyright 2020 Example</p><p>Imprint</p><p>All rights reserved.</p></body>") == "\n".join(want)
    assert main_text(f"<article>{BODY}<p>Copyright law is old.</p></article>").endswith("Copyright law is old.")


def test_references_do_not_reach_over_tags():
    assert main_text("<p>A &<b>lt;</b> B &amp; C &#x41;</p>") == "A &lt; B & C A"


def test_extract(spark):
    rows = [(1, "u", FULL), (1, "u", FULL), (None, None, None), (3, "v", ""), (4, "w", "<p>" + "word " * 100_000)]
    pages = spark.createDataFrame([(*r, "own") for r in rows], "page_id long, url string, html string, text string")
    got = extract(pages).collect()
    assert sorted((str(r.page_id), r.n_chars, len(r.text)) for r in got) == sorted((str(i), len(main_text(h or "")), len(main_text(h or ""))) for i, _, h in rows)
    assert extract(pages.limit(0)).collect() == []


def test_fingerprints_are_homomorphic():
    rng = random.Random(7)
    parts = [f"paragraph number {i} with some words" for i in range(9)] + ["short", "short"]
    whole = Fingerprint.of(parts)
    shuffled = Fingerprint()
    for p in rng.sample(parts, len(parts)):
        shuffled = shuffled.insert(p)
    assert shuffled.digest() == whole.digest() == Fingerprint.of_text("\n\n ".join(parts)).digest()
    assert whole.delete("short").insert("short").digest() == whole.digest() != whole.delete("short").digest()
    assert (Fingerprint.of(parts[:4]) + Fingerprint.of(parts[4:])).digest() == whole.digest()
    assert Fingerprint.of([]).digest() == Fingerprint.of_text(" \n").digest() and whole.likeness(whole) == 1.0


def test_likeness_follows_shared_text(texts):
    long = [t for _, t in texts if t and len(t) > 3000][:12]
    for a, b in zip(long, long[1:], strict=False):
        near = Fingerprint.of_text(a).likeness(Fingerprint.of_text(a[: len(a) * 9 // 10]))
        half = Fingerprint.of_text(a).likeness(Fingerprint.of_text(edited(a, b)))
        assert 0.8 < near <= 1 and 0.25 < half < near


def plain_rows(rows):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]), reverse=True)
    for (doc_id, text), (_, following) in zip(order, order[1:] + order[:1], strict=True):
        new = edited(text, following)
        own, changed = Fingerprint.of_text(text), Fingerprint.of_text(new)
        yield (str(doc_id), len(text), hashlib.sha256(new.encode()).hexdigest(), own.digest().hex(), changed.digest().hex(),
               own.likeness(changed), own.likeness(Fingerprint.of_text(following)))


def test_documents_against_one_walk(spark, odd, nothing, texts):
    for frame in (odd, spark.createDataFrame(texts, "doc_id long, text string").repartition(7), odd.limit(1)):
        rows = [(r.doc_id, r.text or "") for r in frame.select("doc_id", "text").collect()]
        got = fingerprint_documents(frame.sparkSession.createDataFrame(rows, "doc_id long, text string")).collect()
        assert sorted((str(r.doc_id), *r[1:]) for r in got) == sorted(plain_rows(rows))
        assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    assert len(paragraphs("a\n\n b ")) == 2 and fingerprint_documents(nothing).collect() == []


def test_rows_of_one_id_are_spread(spark):
    rows = [(7 if k % 3 else None, f"{k:03d} " * (k % 5 + 1)) for k in range(300)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(setting, "false")
    try:
        held = in_order(frame).groupBy("doc_id", "part").count().collect()
        got = fingerprint_documents(frame).collect()
    finally:
        spark.conf.unset(setting)
    assert sum(r.doc_id == 7 for r in held) > 1 and max(r["count"] for r in held) < 200
    assert sorted((str(r.doc_id), *r[1:]) for r in got) == sorted(plain_rows(rows))
