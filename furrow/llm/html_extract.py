"""Main text of web pages by boosted trees over DOM nodes (operator 6).

A page becomes a tree of block nodes; a run of text that stands beside blocks is
a node of its own, so only leaves hold text. Gradient-boosted trees rate each node
by the text and link density of its subtree, attribute tokens of it and its
ancestors, depth, place and siblings. Decoding is hierarchical: the best set of
kept nodes is found bottom up under the rule that below a dropped node all is
dropped, so a node and its ancestors never contradict each other. The trees are
trained here on labelled pages written by a generator.

Scripts, styles, templates, frames, markup comments and the fields of forms are
never text; formulas and what stands inside drawings, players and the like is.
Character references are decoded, white space inside a block becomes one space, and
blocks are joined in page order by one space. Parsing takes time linear in the page.

Defined cases: null or empty html gives an empty text; unclosed and stray tags
are repaired as browsers do (what follows a less-than sign and a letter is a tag
up to the next greater-than sign); a page without any kept node gives an empty
text. A node that is as likely kept as dropped is dropped. Pages of any size are
read whole. Repeated rows each get a result; other columns
are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import html as html_lib
import random
import re
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from furrow.llm.common import read_table, ship, texts

#: Element groups: fixed values of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style template iframe noembed noframes".split())
GONE = RAW | frozenset("head title textarea select option datalist button annotation annotation-xml".split())
#: What may stand in a head; any other start tag or text closes it.
IN_HEAD = frozenset("head title base link meta style script noscript template basefont bgsound noframes html".split())
BLOCK = frozenset("address article aside blockquote body button caption center dd details dialog dir div dl dt datalist fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup html legend li listing main menu nav ol optgroup option p pre search section select summary table tbody td textarea tfoot th thead title tr ul".split())
#: What a start tag closes, and where the search for it stops.
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul li dt dd tr td th".split())
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "tbody": ("tbody", "thead", "tr", "td", "th"), "option": ("option",)}
SCOPE = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table",), "th": ("table",), "tbody": ("table",), "option": ("select",)}
P_SCOPE = frozenset("html body div article section main aside nav header footer form table td th li blockquote figure".split())
#: Attribute tokens by meaning.
TOKENS = {
    "content": "article articlebody body content contents entry main post posts story text prose markdown page paragraph maincontent hentry blogpost newsarticle",
    "nav": "nav navbar navigation menu menus breadcrumb breadcrumbs topbar tabs pagination pager toc sitemap skip submenu links",
    "header": "header masthead banner hero logo branding top head tagline",
    "footer": "footer foot bottom copyright colophon legal imprint footnav",
    "side": "sidebar side aside rail widget widgets related recommended recommendations more popular trending secondary complementary toplist latest",
    "ad": "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion promoted adsense adslot adbox dfp commercial",
    "notice": "cookie cookies consent notice notices alert gdpr popup modal overlay newsletter subscribe subscription signup paywall warning banner disclaimer privacy",
    "comment": "comment comments reply replies respond disqus discussion feedback responses commentlist reactions guestbook reader",
    "share": "share sharing social follow like tweet facebook twitter meta byline tags tagged author bio",
    "form": "form search login contact register input searchbox field fieldset",
    "hidden": "hidden invisible sr-only offscreen none",
}
_MEANING = {t: k for k, name in enumerate(TOKENS) for t in TOKENS[name].split()}
N_MEAN = len(TOKENS)
TAGS = ["article main", "section", "div", "p", "h1 h2 h3 h4 h5 h6", "li dt dd", "ul ol dl menu", "table tbody thead tr", "td th", "nav", "header hgroup", "footer", "aside", "form fieldset", "blockquote pre q", "figure figcaption", "body html"]
_TAG_NO = {t: k for k, names in enumerate(TAGS) for t in names.split()}

_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>")
_ATTR = re.compile(r"(?:^|[\s\"'])(class|id|role|itemprop|style|hidden|aria-label)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.I)
_PIECE = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_SPACE = " \t\n\f\r"


def is_block(tag: str) -> bool:
    """Known blocks and custom elements; other unknown elements run in a line, as in browsers."""
    return tag in BLOCK or "-" in tag


@lru_cache(20_000)
def meanings(attrs: str) -> tuple[int, ...]:
    """Numbers of the meanings that the class, id, role and the like of a tag hint at."""
    found = set()
    for name, value in _ATTR.findall(attrs):
        name, value = name.lower(), value.strip("\"'")
        if name == "hidden" or name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            found.add(N_MEAN - 1)
        elif name != "style":
            for word in re.split(r"[\s]+", value):
                if word.lower() in _MEANING:
                    found.add(_MEANING[word.lower()])
                for p in _PIECE.findall(word):
                    if p.lower() in _MEANING:
                        found.add(_MEANING[p.lower()])
    return tuple(found)


class Page:
    """Nodes in page order (parents first) and runs of text with their leaf and block."""

    __slots__ = ("tag", "parent", "means", "depth", "links", "inputs", "runs", "blocks", "lined")

    def __init__(self, source: str):
        self.tag, self.parent, self.means, self.depth, self.links, self.inputs = ["body"], [-1], [()], [0], [0], [0]
        self.runs: list[tuple[int, int, bool, str]] = []  # leaf, block, inside a link, text
        self.blocks = 0
        self._read(source)
        self._join_single_runs()

    def _open(self, tag: str, attrs: str, parent: int) -> int:
        self.tag.append(tag)
        self.parent.append(parent)
        self.means.append(meanings(attrs) if attrs else ())
        self.depth.append(self.depth[parent] + 1)
        self.links.append(0)
        self.inputs.append(0)
        return len(self.tag) - 1

    def _read(self, s: str) -> None:
        stack: list[tuple[str, int]] = []  # open elements and the block node that each stands in
        places: dict[str, list[int]] = {}  # of the open elements in the stack, by tag
        inner: list[int] = []  # those of blocks
        p_scopes: list[int] = []  # and of blocks that a new block doesn't reach beyond to close a paragraph
        node, link, gone, pos, n = 0, 0, 0, 0, len(s)
        leaf, leaf_of = -1, -1  # the run's node, and the block that it stands in
        runs = self.runs

        def pop_to(k: int) -> None:
            nonlocal node, link, gone, leaf_of
            while len(stack) > k:
                tag, _ = stack.pop()
                places[tag].pop()
                link -= tag == "a"
                gone -= tag in GONE
                if is_block(tag):
                    inner.pop()
                    if tag in P_SCOPE:
                        p_scopes.pop()
                    self.blocks += 1
                    leaf_of = -1
            node = stack[-1][1] if stack else 0

        def end_head() -> None:
            """Close an open head, unless something is open inside it."""
            if stack and stack[-1][0] == "head":
                pop_to(places["head"][0])

        def put(t: str) -> None:
            nonlocal leaf, leaf_of
            if leaf_of != node:
                if not t.strip(_SPACE):
                    return  # white space where no run has begun
                leaf, leaf_of = self._open("#text", "", node), node
            runs.append((leaf, self.blocks, link > 0, t))

        def last(tags: tuple[str, ...]) -> int:
            return max((places[t][-1] for t in tags if places.get(t)), default=-1)

        while pos < n:
            lt = s.find("<", pos)
            if lt < 0:
                lt = n
            if gone and s[pos:lt].strip(_SPACE):
                end_head()
            if lt > pos and not gone:
                put(s[pos:lt])
            if lt == n:
                break
            c = s[lt + 1 : lt + 2]
            if c == "!" or c == "?":
                if s.startswith("<!--", lt):
                    end = s.find("-->", lt + 4)
                    pos = n if end < 0 else end + 3
                else:
                    end = s.find(">", lt)
                    pos = n if end < 0 else end + 1
                continue
            m = _TAG.match(s, lt)
            if not m:
                if c == "/" or c.isalpha():  # a tag that never ends, or one with a stray quote
                    end = s.find(">", lt)
                    pos = n if end < 0 else end + 1
                else:
                    if gone:
                        end_head()
                    if not gone:
                        put("<")
                    pos = lt + 1
                continue
            pos = m.end()
            tag = m[2].lower()
            if m[1]:
                if places.get(tag) and (is_block(tag) or not inner or places[tag][-1] > inner[-1]):
                    pop_to(places[tag][-1])
                continue
            if gone and tag not in IN_HEAD:
                end_head()
            if tag in VOID:
                if tag == "br" or tag == "hr":
                    self.blocks += 1
                elif tag == "input":
                    self.inputs[node] += 1
                continue
            if tag in RAW or tag in ("title", "textarea"):
                if not m[3].rstrip().endswith("/"):
                    end = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(s, pos)
                    pos = end.end() if end else n
                continue
            if tag in ("html", "body"):
                if tag == "body":
                    self.means[0] = meanings(m[3])
                continue
            if tag in CLOSES_P and places.get("p") and places["p"][-1] > (p_scopes[-1] if p_scopes else -1):
                pop_to(places["p"][-1])
            if tag in CLOSES:
                floor = last(SCOPE[tag])
                if tag in ("tr", "tbody"):  # all rows and cells of the table that are open
                    own = [x[bisect_right(x, floor)] for t in CLOSES[tag] if (x := places.get(t)) and x[-1] > floor]
                    if own:
                        pop_to(min(own))
                elif (at := last(CLOSES[tag])) > floor:
                    pop_to(at)
            if m[3].endswith("/") and ("-" in tag or not is_block(tag)):  # <svg/> and the like
                continue
            if tag == "a":
                link += 1
                self.links[node] += 1
            elif tag in ("button", "select", "textarea"):
                self.inputs[node] += 1
            gone += tag in GONE
            places.setdefault(tag, []).append(len(stack))
            if is_block(tag):
                inner.append(len(stack))
                if tag in P_SCOPE:
                    p_scopes.append(len(stack))
                node = self._open(tag, m[3], node)
                self.blocks += 1
                leaf_of = -1
            stack.append((tag, node))

    def _join_single_runs(self) -> None:
        """A run that is all there is in its block is that block."""
        n = len(self.tag)
        kids = [0] * n
        for p in self.parent[1:]:
            kids[p] += 1
        to, kept = [0] * n, []
        for i in range(n):
            p = self.parent[i]
            if self.tag[i] == "#text" and p > 0 and kids[p] == 1:
                to[i] = to[p]
            else:
                to[i] = len(kept)
                kept.append(i)
        self.lined = [self.tag[self.parent[i]] if self.tag[i] == "#text" else self.tag[i] for i in kept]
        self.parent = [to[p] if p >= 0 else -1 for p in (self.parent[i] for i in kept)]
        self.tag, self.means, self.depth, self.links, self.inputs = ([x[i] for i in kept] for x in (self.tag, self.means, self.depth, self.links, self.inputs))
        self.runs = [(to[leaf], *x) for leaf, *x in self.runs]

    def features(self) -> tuple[np.ndarray, np.ndarray]:
        """A row for each node, and the code points of its own text."""
        n = len(self.tag)
        own, linked, marks = [0] * n, [0] * n, [0] * n
        first = [-1] * n
        total = 0
        for node, _, link, t in self.runs:
            k = len(t) if not t.isspace() else 0
            if k:
                own[node] += k
                linked[node] += k if link else 0
                marks[node] += t.count(".") + t.count(",") + t.count("?") + t.count("!") + t.count(";")
                if first[node] < 0:
                    first[node] = total
                total += k
        text, ltext, punct, desc, links, inputs = own[:], linked[:], marks[:], [1] * n, self.links[:], self.inputs[:]
        paras, items, kids, start = [int(t == "p") for t in self.tag], [int(t == "li") for t in self.tag], [0] * n, [x if x >= 0 else total for x in first]
        parent = self.parent
        long = [int(x - y > 80) for x, y in zip(own, linked, strict=True)]
        for i in range(n - 1, 0, -1):
            p = parent[i]
            text[p] += text[i]
            ltext[p] += ltext[i]
            punct[p] += punct[i]
            desc[p] += desc[i]
            links[p] += links[i]
            inputs[p] += inputs[i]
            paras[p] += paras[i]
            items[p] += items[i]
            long[p] += long[i]
            kids[p] += 1
            start[p] = min(start[p], start[i])
        place, seen = [0] * n, [0] * n
        same: dict[tuple[int, str], int] = {}
        for i in range(1, n):
            place[i] = seen[parent[i]]
            seen[parent[i]] += 1
            key = (parent[i], self.tag[i])
            same[key] = same.get(key, 0) + 1
        mean = np.zeros((n, N_MEAN))
        for i, ms in enumerate(self.means):
            for k in ms:
                mean[i, k] = 1
        above = np.zeros((n, N_MEAN + 6))
        kinds = {"nav": 0, "header": 1, "footer": 2, "aside": 3, "form": 4, "article": 5, "main": 5}
        for i in range(1, n):
            p = parent[i]
            above[i] = above[p]
            above[i, :N_MEAN] = np.maximum(above[i, :N_MEAN], mean[p])
            if self.tag[p] in kinds:
                above[i, N_MEAN + kinds[self.tag[p]]] = 1
        tags = np.zeros((n, len(TAGS) + 1))
        for i, t in enumerate(self.lined):
            if t in _TAG_NO:
                tags[i, _TAG_NO[t]] = 1
        tags[:, -1] = [t == "#text" for t in self.tag]
        par = np.maximum(np.array(parent), 0)
        a = np.array
        text_, ltext_ = a(text, float), a(ltext, float)
        density = ltext_ / np.maximum(text_, 1)
        share = text_ / max(total, 1)
        siblings = a(kids)[par]
        alike = np.array([same.get((parent[i], self.tag[i]), 1) for i in range(n)])
        top = share[1:].max() if n > 1 else 0
        numbers = np.stack([np.log1p(text_), density, a(punct) / np.maximum(text_, 1) * 100, np.log1p(a(desc)), text_ / a(desc), a(self.depth), a(place) / np.maximum(siblings, 1), np.log1p(siblings), alike / np.maximum(siblings, 1), share, a(start) / max(total, 1), np.log1p(a(paras)), np.log1p(a(items)), np.log1p(a(links)), np.log1p(a(inputs)), np.log1p(a(long)), density[par], share[par], a(own) - a(linked), share / max(top, 1e-9), a(long)[par] > 0, np.log1p(a(long)[par])], 1)
        return np.concatenate([numbers, tags, mean, above], 1).astype(np.float32), np.array(own)

    def text(self, keep: np.ndarray) -> str:
        """Kept text: blocks in page order."""
        out, block, parts = [], -1, []
        for node, b, _, t in self.runs:
            if not keep[node]:
                continue
            if b != block:
                if parts:
                    out += html_lib.unescape("".join(parts)).split()
                block, parts = b, []
            parts.append(t)
        if parts:
            out += html_lib.unescape("".join(parts)).split()
        return " ".join(out)


def decode(parent: list[int], logit: np.ndarray) -> np.ndarray:
    """The likeliest set of kept nodes in which every kept node's ancestors are kept."""
    n = len(parent)
    yes = (-np.logaddexp(0, -logit)).tolist()
    drop = (-np.logaddexp(0, logit)).tolist()
    for i in range(n - 1, 0, -1):
        yes[parent[i]] += max(yes[i], drop[i])
        drop[parent[i]] += drop[i]
    keep = np.zeros(n, dtype=bool)
    for i in range(n):
        keep[i] = (parent[i] < 0 or keep[parent[i]]) and yes[i] > drop[i]
    return keep


class Trees:
    """Boosted regression trees of one depth over binned features."""

    def __init__(self, cuts: list[np.ndarray], feature: np.ndarray, cut: np.ndarray, leaf: np.ndarray, base: float):
        self.cuts, self.feature, self.cut, self.leaf, self.base = cuts, feature, cut, leaf, base

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(c, x[:, j], side="right") for j, c in enumerate(self.cuts)], 1).astype(np.uint8)

    def logits(self, x: np.ndarray) -> np.ndarray:
        b = self.bins(x)
        rows, out = np.arange(len(b)), np.full(len(b), self.base)
        depth = int(np.log2(self.leaf.shape[1]))
        for f, c, v in zip(self.feature, self.cut, self.leaf, strict=True):
            at = np.zeros(len(b), dtype=np.int64)
            for _ in range(depth):
                at = 2 * at + 1 + (b[rows, f[at]] > c[at])
            out += v[at - (2**depth - 1)]
        return out


def boost(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.25, l2: float = 2.0) -> Trees:
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0.03, 0.97, 24))) for j in range(x.shape[1])]
    cuts = [c if len(np.unique(x[:, j])) > 2 else np.array([0.5]) for j, c in enumerate(cuts)]
    model = Trees(cuts, np.zeros((trees, 2**depth - 1), np.int64), np.full((trees, 2**depth - 1), 255, np.int64), np.zeros((trees, 2**depth)), float(np.log(y.mean() / (1 - y.mean()))))
    b = model.bins(x).astype(np.int64)
    width = max(map(len, cuts)) + 1
    k = x.shape[1]
    wide = k * width
    flat = b + np.arange(k) * width
    score = np.full(len(y), model.base)
    r = np.random.default_rng(3)
    for t in range(trees):
        p = 1 / (1 + np.exp(-score))
        drawn = r.random(len(y)) < 0.4  # each tree sees a part of the nodes
        g, h = (y - p) * drawn, p * (1 - p) * drawn
        own = np.flatnonzero(drawn)
        at = np.zeros(len(y), dtype=np.int64)
        for d in range(depth):
            n, first = 2**d, 2**d - 1
            key = (flat[own] + (at[own] - first)[:, None] * wide).ravel()
            gs, hs = (np.bincount(key, weights=np.repeat(w[own], k), minlength=n * wide).reshape(n, k, width).cumsum(2) for w in (g, h))
            gt, ht = gs[:, :, -1:], hs[:, :, -1:]
            gain = gs**2 / (hs + l2) + (gt - gs) ** 2 / (ht - hs + l2) - gt**2 / (ht + l2)
            gain[(hs < 1) | (ht - hs < 1)] = 0
            best = gain.reshape(n, wide).argmax(1)
            split = gain.reshape(n, wide)[np.arange(n), best] > 1e-12
            model.feature[t, first : first + n][split] = best[split] // width
            model.cut[t, first : first + n][split] = best[split] % width
            at = 2 * at + 1 + (b[np.arange(len(y)), model.feature[t, at]] > model.cut[t, at])
        leaf = at - (2**depth - 1)
        gs, hs = (np.bincount(leaf, weights=w, minlength=2**depth) for w in (g, h))
        model.leaf[t] = rate * gs / (hs + l2)
        score += model.leaf[t, leaf]
    return model


class Writer:
    """Writes labelled pages: kept text has words that begin with k, dropped text has words that begin with x."""

    def __init__(self, seed: int):
        self.r = random.Random(seed)

    def words(self, n: int, keep: bool) -> str:
        r = self.r
        w = [("k" if keep else "x") + "".join(r.choice("aeionrst") for _ in range(r.randint(1, 8))) for _ in range(n)]
        return " ".join(x + (r.choice([".", ",", "."]) if r.random() < 0.12 else "") for x in w)

    def attr(self, names: list[str]) -> str:
        r = self.r
        if r.random() < 0.3:
            return ""
        name = r.choice(names) if r.random() < 0.8 else "c" + str(r.randint(1, 99))
        return f' {r.choice(["class", "id", "class"])}="{name}{r.choice(["", "", "-1", " box", "_wrap"])}"'

    def links(self, n: int) -> str:
        r = self.r
        a = [f'<a href="/{k}">{self.words(r.randint(1, 3), False)}</a>' for k in range(n)]
        how = r.random()
        return "<ul>" + "".join(f"<li>{x}</li>" for x in a) + "</ul>" if how < 0.6 else " | ".join(a) if how < 0.8 else "".join(f"<div>{x}</div>" for x in a)

    def para(self, keep: bool = True) -> str:
        r = self.r
        n = r.choice([1, 3, 8, 20, 40, 60, 90, 150])
        t = self.words(n, keep)
        if r.random() < 0.25:
            t += f' <a href="#">{self.words(2, keep)}</a> {self.words(r.randint(1, 12), keep)}'
        if r.random() < 0.2:
            t = f"<b>{t}" + ("</b>" if r.random() < 0.5 else "<br>")
        return t

    def content(self) -> str:
        r = self.r
        out = [f"<h{h}>{self.words(r.randint(1, 9), True)}</h{h}>" for h in ([1] if r.random() < 0.8 else [])]
        for _ in range(r.choice([0, 1, 1, 2, 3, 5, 8, 14])):
            how = r.random()
            if how < 0.72:
                out.append(f"<p>{self.para()}" + ("</p>" if r.random() < 0.85 else ""))
            elif how < 0.8:
                out.append("<ul>" + "".join(f"<li>{self.words(r.randint(2, 25), True)}</li>" for _ in range(r.randint(1, 6))) + "</ul>")
            elif how < 0.84:
                out.append(f"<blockquote>{self.para()}</blockquote>")
            elif how < 0.87:
                out.append("<table>" + "".join("<tr>" + "".join(f"<td>{self.words(r.randint(1, 4), True)}</td>" for _ in range(3)) + "</tr>" for _ in range(r.randint(1, 5))) + "</table>")
            elif how < 0.92:
                out.append(f"<h2>{self.words(r.randint(1, 6), True)}</h2>")
            elif how < 0.95:
                out.append(f"<div>{self.para()}</div>")
            elif how < 0.97:
                out.append(f"<pre>{self.words(r.randint(5, 40), True)}</pre>" if r.random() < 0.5 else f"{self.para()}<br><br>{self.para()}")
            else:
                out.append(self.junk(inside=True))
        return "".join(out)

    def junk(self, inside: bool = False) -> str:
        r = self.r
        w = lambda lo, hi: self.words(r.randint(lo, hi), False)
        kinds = ["ad", "share", "notice", "related", "form"] if inside else ["ad", "notice", "side", "form", "related", "comments", "crumbs", "share", "nav"]
        kind = r.choice(kinds)
        if kind == "ad":
            return f'<div{self.attr(["ad", "ads", "advert", "sponsored", "promo", "ad-slot"]) or " class=ad"}>{r.choice(["", "<p>"])}{w(2, 60)}</div>'
        if kind == "notice":
            return f'<div{self.attr(["cookie-notice", "consent", "newsletter", "gdpr", "alert", "notice", "subscribe"]) or " class=cookie"}><p>{w(4, 40)}</p>' + r.choice(["<button>ok</button>", '<a href="#">xok</a>', ""]) + "</div>"
        if kind == "side":
            return f'<{(t := r.choice(["aside", "aside", "div"]))}{self.attr(["sidebar", "side", "widget", "rail"]) or " id=sidebar"}><h3>{w(1, 3)}</h3>{self.links(r.randint(2, 8))}' + (f"<p>{w(5, 50)}</p>" if r.random() < 0.5 else "") + f"</{t}>"
        if kind == "form":
            return f'<form{self.attr(["search", "login", "contact", "signup"])}><label>{w(1, 4)}</label><input name="q"> {w(0, 12)}' + r.choice(["<button>xgo</button>", '<input type="submit">', "<p>" + w(3, 20) + "</p><textarea>x</textarea>"]) + "</form>"
        if kind == "related":
            return f'<{(t := r.choice(["div", "section", "aside"]))}{self.attr(["related", "more", "recommended", "popular"]) or " class=related"}><h3>{w(1, 4)}</h3>{self.links(r.randint(2, 6))}</{t}>'
        if kind == "comments":
            one = lambda: f'<{(t := r.choice(["div", "li", "article"]))} class="comment">' + f"<b>{w(1, 2)}</b><p>{w(3, 70)}</p></{t}>"
            return f'<{(t := r.choice(["section", "div", "div"]))} {r.choice(["id", "class"])}="{r.choice(["comments", "discussion", "comment-list", "disqus", "responses", "replies"])}"><h2>{w(1, 3)}</h2>' + "".join(one() for _ in range(r.randint(1, 5))) + f"</{t}>"
        if kind == "crumbs":
            return f'<div class="{r.choice(["breadcrumb", "breadcrumbs", "pagination", "tabs"])}">{self.links(r.randint(2, 4))}</div>'
        if kind == "share":
            return f'<div class="{r.choice(["share", "social", "share-buttons", "follow"])}">{w(0, 2)}{self.links(r.randint(2, 5))}</div>'
        return f'<nav{self.attr(["menu", "nav", "toc"])}>{self.links(r.randint(2, 9))}</nav>'

    def loose(self) -> str:
        """Menus and notices as bare text beside the blocks."""
        r = self.r
        names = [self.words(r.randint(1, 2), False).strip(".,") for _ in range(r.randint(2, 6))]
        if r.random() < 0.4:
            names = [f'<a href="#">{x}</a>' for x in names]
        return r.choice([" | ", " &middot; ", " - ", " "]).join(names) if r.random() < 0.8 else f"&copy; {self.words(r.randint(2, 9), False)}"

    def small_page(self) -> str:
        """One or a few short blocks with hardly anything beside them."""
        r = self.r
        text = r.choice([lambda: f"<p>{self.words(r.randint(3, 30), True)}</p>", lambda: self.words(r.randint(3, 40), True), lambda: f"<h1>{self.words(r.randint(1, 6), True)}</h1><p>{self.words(r.randint(3, 30), True)}</p>", lambda: f"<p>{self.words(r.randint(5, 20), True)}</p><p>{self.words(r.randint(3, 20), True)}</p>"])()
        t = r.choice(["div", "div", "main", "article", "section", ""])
        text = f"<{t}{self.attr(['content', 'page', 'wrapper'])}>{text}</{t}>" if t else text
        before, after = (self.loose() if r.random() < 0.2 and t else "" for _ in range(2))
        nav = f"<nav>{self.links(r.randint(2, 5))}</nav>" if r.random() < 0.3 else ""
        return f"<html><body>{nav}{before}{text}{after}</body></html>"

    def page(self) -> str:
        r = self.r
        w = lambda lo, hi: self.words(r.randint(lo, hi), False)
        if r.random() < 0.15:
            return self.small_page()
        out = []
        if r.random() < 0.35:
            out.append(f'<{(t := r.choice(["header", "header", "div"]))}{self.attr(["header", "masthead", "banner", "top"]) or " id=header"}>' + r.choice([f"<h1>{w(1, 4)}</h1>", f'<a href="/">{w(1, 3)}</a>', f"<p>{w(2, 40)}</p>"]) + (self.links(r.randint(2, 6)) if r.random() < 0.4 else "") + f"</{t}>")
        if r.random() < 0.75:
            t = r.choice(["nav", "nav", "div"])
            out.append(f'<{t}{self.attr(["menu", "nav", "navbar", "navigation"]) or (" class=menu" if t == "div" else "")}>{self.links(r.randint(2, 12))}</{t}>')
        before, after = r.choice([0, 0, 1, 2]), r.choice([0, 1, 1, 2, 3])
        out += [self.junk() for _ in range(before)]
        loose = [self.loose() if r.random() < 0.12 else "" for _ in range(4)]
        body = self.content()
        t = r.choice(["article", "article", "article", "main", "div", "section", ""])
        if t:
            own = self.attr(["content", "post", "article-body", "entry-content", "main", "story"]) if t != "div" or r.random() < 0.7 else ' class="c7"'
            body = f"<{t}{own}>{body}</{t}>"
            if r.random() < 0.3:
                body = f'<{(u := r.choice(["main", "div", "section"]))}{self.attr(["main", "page", "wrapper", "container"])}>{self.junk() if r.random() < 0.3 else ""}{loose[0]}{body}{loose[1]}{self.junk() if r.random() < 0.4 else ""}</{u}>'
            out += [loose[2], body, loose[3]]
        else:
            out.append(body)
        out += [self.junk() for _ in range(after)]
        if r.random() < 0.75:
            t = r.choice(["footer", "footer", "div"])
            out.append(f'<{t}{self.attr(["footer", "bottom", "copyright"]) or (" id=footer" if t == "div" else "")}>' + r.choice([w(2, 14), w(10, 60), f"<p>{w(2, 50)}</p>", self.links(r.randint(1, 6)), f"<p>{w(2, 9)}</p>{self.links(3)}"]) + f"</{t}>")
        text = "".join(out)
        if r.random() < 0.2:
            text = f'<div{self.attr(["page", "wrapper", "container", "site"])}>{text}</div>'
        return f"<html><head><title>x</title></head><body>{text}" + r.choice(["</body></html>", ""])


def labelled_pages(n: int = 2400, seed: int = 11) -> Iterator[tuple[Page, np.ndarray]]:
    """Pages with a label for each node: 1 if any kept text stands in it or below."""
    w = Writer(seed)
    for _ in range(n):
        page = Page(w.page())
        y = np.zeros(len(page.tag))
        for node, _, _, t in page.runs:
            if t.split() and all(x[0] != "x" for x in t.split() if x[0].isalpha()) and any(x[0] == "k" for x in t.split()):
                y[node] = 1
        for i in range(len(y) - 1, 0, -1):
            y[page.parent[i]] = max(y[page.parent[i]], y[i])
        yield page, y


@lru_cache(2)
def train(n: int = 2400, seed: int = 11) -> Trees:
    xs, ys = [], []
    for page, y in labelled_pages(n, seed):
        x, _ = page.features()
        xs.append(x)
        ys.append(y)
    return boost(np.concatenate(xs), np.concatenate(ys))


def main_texts(sources: list[str], trees: Trees) -> list[str]:
    pages = [Page(s) for s in sources]
    if not pages:
        return []
    xs = [p.features()[0] for p in pages]
    logit = trees.logits(np.concatenate(xs))
    out, lo = [], 0
    for p, x in zip(pages, xs, strict=True):
        out.append(p.text(decode(p.parent, logit[lo : lo + len(x)])))
        lo += len(x)
    return out


def extract(pages: DataFrame, trees: Trees | None = None) -> DataFrame:
    """Rows (page_id, url, text, n_chars) for pages (page_id, url, html)."""
    ship(pages.sparkSession)
    held = pages.sparkSession.sparkContext.broadcast(trees or train())

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            items = texts(b, "html")
            for lo in range(0, len(items), 200):
                out = main_texts(items[lo : lo + 200], held.value)
                n = len(out)
                yield pa.RecordBatch.from_arrays([b.column("page_id").slice(lo, n).cast(pa.int64()), b.column("url").slice(lo, n).cast(pa.string()), pa.array(out, pa.string()), pa.array([len(t) for t in out], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", "html").mapInArrow(run, "page_id bigint, url string, text string, n_chars bigint")


def op6_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(read_table(spark, sf_dir, "pages"))
