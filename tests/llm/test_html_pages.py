"""Main text of pages written by hand, none of them from the generator that trains the model."""

import time

import pytest

from furrow.llm import html_extract

A = "The council met on Tuesday evening to discuss the new bridge across the river, and most members spoke in favour."
B = "Costs will rise, said the mayor, but the old crossing can not carry the traffic of the coming years."
C = "Work is to begin in spring. It should take about two years, if the weather allows."
T = "New bridge for the town"
NAV = '<nav><ul><li><a href="/">Home</a></li><li><a href="/news">News</a></li><li><a href="/sport">Sport</a></li></ul></nav>'
FOOT = "<footer><p>Copyright 2021 The Daily Paper. All rights reserved.</p></footer>"
ART = f"<h1>{T}</h1><p>{A}</p><p>{B}</p><p>{C}</p>"
ALL = f"{T} {A} {B} {C}"

PAGES = {
    "article and chrome": (f"<html><body>{NAV}<article>{ART}</article>{FOOT}</body></html>", ALL),
    "main without article": (f"<body><header><a href=/>The Paper</a></header><main>{ART}</main>{FOOT}", ALL),
    "div with content id": (f'<body><div id="menu"><a href=1>One</a> <a href=2>Two</a> <a href=3>Three</a></div><div id="content">{ART}</div><div id="footer">Contact us by mail</div>', ALL),
    "post body class": (f'<body><div class="navbar"><a href=1>Home</a><a href=2>About</a></div><div class="post"><div class="post-body">{ART}</div></div>', ALL),
    "loose menu in body": (f"<body>Home | About | Contact<article>{ART}</article></body>", ALL),
    "loose menu in wrapper": (f'<body><div class="wrap">Home | About | Contact<article>{ART}</article></div></body>', ALL),
    "loose links before": (f"<body><a href=1>Home</a> | <a href=2>About</a> | <a href=3>Contact</a><article>{ART}</article>{FOOT}</body>", ALL),
    "loose copyright after": (f"<body><article>{ART}</article>&copy; 2020 The Paper</body>", ALL),
    "one short paragraph": ("<html><body><div><p>Back in five minutes.</p></div></body></html>", "Back in five minutes."),
    "only text": ("We have moved to a new address, please update your links.", "We have moved to a new address, please update your links."),
    "cookie notice": (f'<body><div class="cookie-notice"><p>We use cookies to improve your visit.</p><button>Accept</button></div><article>{ART}</article></body>', ALL),
    "consent overlay at the end": (f'<body><article>{ART}</article><div id="gdpr-consent"><p>This site stores data on your device. You can refuse.</p><a href="#">Refuse</a></div></body>', ALL),
    "advert between paragraphs": (f'<article><h1>{T}</h1><p>{A}</p><div class="ad">Buy two shoes, get one free today only.</div><p>{B}</p><p>{C}</p></article>', ALL),
    "sponsored aside": (f'<article><h1>{T}</h1><p>{A}</p><p>{B}</p><p>{C}</p></article><aside class="sponsored"><p>Cheap flights to the sun, book now.</p></aside>', ALL),
    "sidebar with headlines": (f'<div class="sidebar"><h3>Most read</h3><ul><li><a href=1>Cat found</a></li><li><a href=2>Rain tomorrow</a></li><li><a href=3>Cup final</a></li></ul></div><div class="main-content">{ART}</div>', ALL),
    "reader comments": (f'<article>{ART}</article><section id="comments"><h2>3 comments</h2><div class="comment"><b>Ann</b><p>I do not think that we need a bridge at all, it is a waste of money.</p></div><div class="comment"><b>Bob</b><p>Finally!</p></div></section>', ALL),
    "comments as articles": (f'<main><article>{ART}</article><div class="comments"><article class="comment"><p>Nice to read about this at last, thank you for it.</p></article></div></main>', ALL),
    "search form": (f'<body><form class="search"><label>Search the site</label><input name=q><button>Go</button></form><article>{ART}</article></body>', ALL),
    "newsletter form": (f'<article>{ART}</article><form class="newsletter"><p>Subscribe to our letter and never miss a story.</p><input type=email><input type=submit></form>', ALL),
    "share links": (f'<article><h1>{T}</h1><div class="share"><a href=1>Facebook</a> <a href=2>Twitter</a></div><p>{A}</p><p>{B}</p><p>{C}</p></article>', ALL),
    "related box": (f'<article>{ART}</article><section class="related"><h3>More on this</h3><ul><li><a href=1>Old bridge closed</a></li><li><a href=2>Ferry runs late</a></li></ul></section>', ALL),
    "breadcrumbs": (f'<div class="breadcrumbs"><a href=/>Home</a> &gt; <a href=/n>News</a> &gt; <a href=/l>Local</a></div><article>{ART}</article>', ALL),
    "links in the text": (f'<article><h1>{T}</h1><p>{A} See <a href=1>the plans</a> and <a href=2>the map</a> of the site.</p><p>{B}</p></article>{FOOT}', f"{T} {A} See the plans and the map of the site. {B}"),
    "list in the text": (f"<article><h1>{T}</h1><p>{A}</p><ul><li>The bridge is 300 metres long.</li><li>It has two lanes and a path.</li></ul><p>{B}</p></article>", f"{T} {A} The bridge is 300 metres long. It has two lanes and a path. {B}"),
    "quotation": (f"<article><h1>{T}</h1><p>{A}</p><blockquote>We have waited for thirty years.</blockquote><p>{B}</p></article>", f"{T} {A} We have waited for thirty years. {B}"),
    "table in the text": (f"<article><h1>{T}</h1><p>{A}</p><table><tr><td>Length</td><td>300 m</td></tr><tr><td>Width</td><td>12 m</td></tr></table><p>{B}</p></article>", f"{T} {A} Length 300 m Width 12 m {B}"),
    "unclosed paragraphs": (f"<body>{NAV}<article><h1>{T}</h1><p>{A}<p>{B}<p>{C}</article>", ALL),
    "line breaks": (f"<body>{NAV}<article><h1>{T}</h1>{A}<br><br>{B}<br><br>{C}</article>{FOOT}", ALL),
    "inline elements": (f"<article><h1>{T}</h1><p>The <b>coun</b>cil met on <i>Tues<b>day</b></i> evening, as it does each week, to hear and to vote.</p><p>{B}</p></article>", f"{T} The council met on Tuesday evening, as it does each week, to hear and to vote. {B}"),
    "formula": (f"<article><h1>{T}</h1><p>{A} The load is <math><mi>F</mi><mo>=</mo><mi>m</mi><mi>a</mi></math> at most.</p><p>{B}</p></article>", f"{T} {A} The load is F=ma at most. {B}"),
    "text inside other elements": (f"<article><p>{A}</p><p>The sign reads <svg><text>Slow down</text></svg>, the film <video src=x>is not shown</video> here.</p><p>{B}</p></article>", f"{A} The sign reads Slow down, the film is not shown here. {B}"),
    "scripts and styles": (f"<article><h1>{T}</h1><script>var a = '<p>no</p>';</script><p>{A}</p><style>p {{ color: red }}</style><p>{B}</p><!-- <p>no</p> --></article>", f"{T} {A} {B}"),
    "references": ("<article><h1>Fish &amp; chips</h1><p>A meal for &lt;10 pounds&gt;, caf&eacute; included&#33; So good that we went there twice this week.</p></article>", "Fish & chips A meal for <10 pounds>, café included! So good that we went there twice this week."),
    "capital tags and attributes": (f"<HTML><BODY><DIV CLASS='NavBar'><A HREF=1>Home</A><A HREF=2>News</A></DIV><ARTICLE><H1>{T}</H1><P>{A}</P><P>{B}</P></ARTICLE></BODY></HTML>", f"{T} {A} {B}"),
    "deep wrappers": ("<div><div><div><section><div>" + f"<article>{ART}</article>" + "</div></section></div></div></div>", ALL),
    "stray end tags": (f"<body></div></p>{NAV}</span><article></b><h1>{T}</h1></i><p>{A}</p></em><p>{B}</p></article></section>", f"{T} {A} {B}"),
    "white space": (f"<article>\n <h1>\t{T}\n</h1>\n<p>\n  The   council\nmet\ton Tuesday, late in the evening, and voted.\n</p> <p>{B}</p>\n</article>\n", f"{T} The council met on Tuesday, late in the evening, and voted. {B}"),
}


@pytest.fixture(scope="module")
def trees():
    return html_extract.train()


def test_pages_by_hand(trees):
    got = dict(zip(PAGES, html_extract.main_texts([h for h, _ in PAGES.values()], trees), strict=True))
    wrong = {k: got[k] for k, (_, want) in PAGES.items() if got[k] != want}
    assert len(PAGES) >= 30
    assert len(wrong) <= 2, wrong


def test_parsing_is_linear():
    def took(n):
        best = 9.0
        for _ in range(3):
            began = time.perf_counter()
            html_extract.Page("<div>" * n + "</span>" * n + "<p>x" * n + "<b><td>" * n + "</b>" * n)
            html_extract.Page("<svg/>" * n + "<style/>" * n + "<ul>" + "<li>x" * n)
            best = min(best, time.perf_counter() - began)
        return best

    assert took(16000) < 12 * took(4000)


def test_a_run_beside_blocks_is_a_node_of_its_own():
    p = html_extract.Page("<body>menu<div>one<p>two</p>three <b>bold</b></div></body>")
    leaf = {t.strip(): k for k, _, _, t in p.runs}
    assert len(set(leaf.values())) == 4  # menu, one, two, three and bold
    assert p.tag[leaf["two"]] == "p"
    assert leaf["three"] == leaf["bold"]
    assert not set(p.parent) & set(leaf.values())
