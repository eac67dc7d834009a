"""Main text of web pages: gradient-boosted trees over DOM nodes and hierarchical decoding.

Method
    A page is parsed into a tree (broken and cut-off markup included). Each element gets features:
    its tag, tokens of its class, id and role and of its ancestors', depth, place, text and link
    density of its subtree, form controls, and how it stands among its siblings. Boosted trees
    give the log-odds that the element is part of the article. Decoding chooses for the whole
    tree at once: an element can only be kept in a kept parent, and a subtree is
    kept if the log-odds of what is kept in it sum to more than 0; so a dropped menu never has a
    kept entry, and a dropped advert can stand in a kept article.

Training
    The tables have no labelled pages, so the trees are trained here on ``TRAIN_PAGES`` generated
    pages of known parts (see ``page_maker``): articles in many kinds of markup, with menus, adverts, forms,
    notices, comments and so on around and inside them, with telling and with meaningless class names.

Text
    Blocks are the runs of text between block-level boundaries. Character references are decoded,
    white space is one space, blocks are trimmed and joined by one newline.

Defined results
    Null or empty html, and pages without kept text: empty text, n_chars 0. Truncated tags and
    references are text or dropped as HTML readers do. Very deep trees are handled without recursion.
    Repeated pages each get their row.
"""

from __future__ import annotations

import functools
import html as refs
import random
import re

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from carelake.llm import base, gbdt

TRAIN_PAGES, SEED = 1000, 11

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Content that is never text, whatever the trees say: code, the head, what a form or a medium shows.
OPAQUE = frozenset("script style template iframe svg canvas audio video head title textarea select option".split())
RAW = frozenset("script style textarea title iframe template".split())
BLOCK = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure "
                  "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup p pre section "
                  "summary table tbody td tfoot th thead tr ul caption".split())
#: Start tags that don't end an open head; any other, or text, does and implies the body.
IN_HEAD = frozenset("title meta link base style script noscript noframes template".split())
#: A start tag that ends an open element of these.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}}
NONE, PARAGRAPH = frozenset(), frozenset(["p"])
SCOPE = frozenset("ul ol dl table div section article main aside nav header footer form blockquote td th body li".split())

#: Tokens of class, id and role by what they tell.
TELLS = {
    "menu": "nav navbar navigation menu menubar breadcrumb breadcrumbs crumbs toolbar pagination pager tabs toc skip",
    "edge": "header masthead footer foot bottom topbar top colophon copyright legal contentinfo banner",
    "side": "sidebar aside side rail widget complementary related recommended more popular trending tags",
    "ad": "ad ads adv advert advertisement advertising sponsor sponsored promo promotion promoted outbrain taboola dfp",
    "notice": "cookie cookies consent gdpr notice alert popup modal overlay paywall subscribe newsletter signup dialog",
    "form": "form search login register input contact poll survey",
    "talk": "comment comments commentlist discussion disqus reply replies respond feedback review reviews thread",
    "share": "share sharing social follow facebook twitter meta byline author print email",
    "main": "article main content post entry story body text page blog news hentry maincontent articlebody",
}
_TELL = {w: i for i, ws in enumerate(TELLS.values()) for w in ws.split()}
TAGS = ("p", "div", "span", "a", "li", "ul", "ol", "h1", "h2", "h3", "article", "main", "section", "nav", "header",
        "footer", "aside", "form", "table", "td", "blockquote", "pre", "figure", "body", "label", "b", "button", "noscript")
_TAG = {t: i for i, t in enumerate(TAGS)}

TOKEN = re.compile(r"<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+)(?:>|\Z)"
                   r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)", re.S)
ATTR = re.compile(r"(class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", re.I)
#: End tags of RAW elements, in any case (of ASCII letters only), in the page as it is.
_END = {t: re.compile(rf"</{t}(?=[\s/>]|\Z)", re.I | re.A) for t in RAW}
PARTS = re.compile(r"[A-Z]?[a-z]+")


class Open:
    """The open elements, with the places of each tag among them: every question takes the same time at any depth."""

    __slots__ = ("items", "places", "blocks", "scopes", "opaque")

    def __init__(self):
        self.items: list[tuple[int, str]] = []
        self.places: dict[str, list[int]] = {}
        self.blocks: list[int] = [-1]
        self.scopes: list[int] = [-1]
        self.opaque = 0

    def push(self, e: int, name: str) -> None:
        at = len(self.items)
        self.items.append((e, name))
        self.places.setdefault(name, []).append(at)
        if name in BLOCK:
            self.blocks.append(at)
        if name in SCOPE:
            self.scopes.append(at)
        self.opaque += name in OPAQUE

    def cut(self, at: int) -> None:
        """Closes the elements from this place on."""
        while len(self.items) > at:
            name = self.items.pop()[1]
            self.places[name].pop()
            if name in BLOCK:
                self.blocks.pop()
            if name in SCOPE:
                self.scopes.pop()
            self.opaque -= name in OPAQUE

    def last(self, name: str) -> int:
        """The place of the innermost of these; -1 if none is open."""
        return at[-1] if (at := self.places.get(name)) else -1

    @property
    def top(self) -> int:
        return self.items[-1][0]

    def in_head(self) -> bool:
        """Whether an open head is the innermost element."""
        return self.opaque == 1 and self.items[-1][1] == "head"


class Page:
    """Elements in page order (0 is the root) and text runs with the element they stand in."""

    __slots__ = ("tag", "attrs", "parent", "runs", "depth", "implied")

    def __init__(self, html: str | None):
        self.tag, self.attrs, self.parent, self.depth = ["#root"], [""], [-1], [0]
        #: The body that the end of a head implied.
        self.implied = -1
        #: (element, text) or (element, None) for a block boundary
        self.runs: list[tuple[int, str | None]] = []
        if html:
            self._parse(html)

    def _parse(self, html: str) -> None:
        tag, runs = self.tag, self.runs
        stack, at = Open(), 0
        stack.push(0, "#root")
        for m in iter(lambda: TOKEN.search(html, at), None):
            self._text(stack, html, at, m.start())
            at = m.end()
            name = m[2] or m[5]
            if not name:
                continue
            name = name.lower()
            if m[1] or m[4]:
                self._end(stack, name)
                continue
            if stack.in_head() and name not in IN_HEAD and name != "body":
                if name in ("head", "html"):  # a second one is nothing
                    continue
                self._end_head(stack)
            if name in CLOSES or name in BLOCK:  # an open paragraph or item of the same list ends here
                k = max(stack.last(t) for t in CLOSES.get(name, NONE) | PARAGRAPH)
                if k > 0 and k >= stack.scopes[-1]:
                    stack.cut(k)
            attrs = m[3] or m[6] or ""
            if name in ("html", "body") and name in tag[1:3]:
                continue
            if name == "body" and not stack.opaque and self.implied > 0 and any(
                    stack.items[k][0] == self.implied for k in stack.places["body"][:2]):
                self.attrs[self.implied] = attrs
                continue
            if name == "br":
                runs.append((stack.top, " "))
                continue
            e = self._add(name, attrs, stack.top)
            if name in BLOCK:
                runs.append((e, None))
            if name == "body" and stack.opaque:  # a head that was not closed
                held = [x for x in stack.items if x[1] not in OPAQUE]
                stack = Open()
                for x in held:
                    stack.push(*x)
                self.parent[e] = stack.top
            if name in VOID or (m[3] or "").endswith("/") and name in OPAQUE:
                continue
            stack.push(e, name)
            if name in RAW:
                end = _END[name].search(html, at)
                at = end.start() if end else len(html)
        self._text(stack, html, at, len(html))

    def _text(self, stack: Open, html: str, a: int, z: int) -> None:
        """The text between two tags."""
        if a >= z or stack.opaque > 1 or stack.opaque and not stack.in_head():
            return
        if stack.in_head():
            if not html[a:z].strip():
                return
            self._end_head(stack)
        if len(stack.items) == 1 and html[a:z].strip():
            stack.push(self._body(), "body")
        self.runs.append((stack.top, html[a:z]))

    def _end(self, stack: Open, name: str) -> None:
        """An end tag: closes the innermost element of the name, an inline one only within its block."""
        k = stack.last(name)
        if k > 0 and (name in BLOCK or name in OPAQUE or k > stack.blocks[-1]):
            if name in BLOCK:
                self.runs.append((stack.items[k - 1][0], None))
            stack.cut(k)
        elif name == "p":  # an end without a start is an empty paragraph
            self.runs.append((stack.top, None))

    def _add(self, name: str, attrs: str, parent: int) -> int:
        self.tag.append(name)
        self.attrs.append(attrs)
        self.parent.append(parent)
        self.depth.append(self.depth[parent] + 1)
        return len(self.tag) - 1

    def _body(self, parent: int = 0) -> int:
        """The body that text outside of any element, or the end of a head, implies."""
        e = self._add("body", "", parent)
        self.runs.append((e, None))
        return e

    def _end_head(self, stack: Open) -> None:
        """Closes the head on top, by what can't be in one."""
        stack.cut(len(stack.items) - 1)
        if stack.last("body") < 0:
            self.implied = self._body(stack.top)
            stack.push(self.implied, "body")

    def features(self) -> np.ndarray:
        """One row per element."""
        n = len(self.tag)
        tag, parent, depth = self.tag, self.parent, self.depth
        own = [0] * n
        stops = [0] * n
        marks = [0] * n
        for e, t in self.runs:
            if t:
                size = len(t) if " " != t[:1] and "\n" not in t else len(t.strip())
                own[e] += size
                stops[e] += t.count(". ") + t.count(", ") + t.endswith(".")
                if "©" in t or "&copy" in t or "(c)" in t:
                    marks[e] = 1
        text, link, nodes = own[:], [0] * n, [1] * n
        paras, items, controls = [0] * n, [0] * n, [0] * n
        kids, kin = [0] * n, [0] * n
        links = [0] * n
        tells = [0] * n
        for e in range(n):
            t, a = tag[e], self.attrs[e]
            if a and "=" in a:
                for x in ATTR.finditer(a):
                    for w in PARTS.findall(x[2]):
                        i = _TELL.get(w.lower())
                        if i is not None:
                            tells[e] |= 1 << i
            if t == "p":
                paras[e] = 1
            elif t == "li":
                items[e] = 1
            elif t in ("input", "button", "select", "textarea", "label"):
                controls[e] = 1
            elif t == "a":
                links[e] = 1
        for e in range(n - 1, 0, -1):
            p = parent[e]
            if tag[e] == "a":
                link[e] = text[e]
            text[p] += text[e]
            link[p] += link[e]
            nodes[p] += nodes[e]
            stops[p] += stops[e]
            paras[p] += paras[e]
            items[p] += items[e]
            controls[p] += controls[e]
            links[p] += links[e]
            marks[p] |= marks[e] and nodes[p] < 12
            kids[p] += 1
        above, kind = [0] * n, [0] * n
        fat = [0] * n
        for e in range(1, n):
            p = parent[e]
            above[e] = above[p] | tells[p]
            kind[e] = kind[p] | (1 << _TAG.get(tag[p], 27))
            if text[e] > fat[p]:
                fat[p] = text[e]
        count: dict[tuple[int, str], int] = {}
        for e in range(1, n):
            k = (parent[e], tag[e])
            count[k] = count.get(k, 0) + 1
        total = max(1, text[0])
        x = np.zeros((n, len(NAMES)), np.float32)
        before = 0
        seen = [0] * n
        for e, t in self.runs:
            if t:
                if not seen[e]:
                    seen[e] = before + 1
                before += len(t)
        for e in range(n - 1, 0, -1):
            p = parent[e]
            if seen[e] and (not seen[p] or seen[e] < seen[p]):
                seen[p] = seen[e]
        plain = [
            depth, own, text, link, nodes, stops, paras, items, controls, kids, links, marks, seen, tells, above, kind]
        d, o, t, lk, nd, st, pa, it, co, ki, ls, mk, se, te, ab, kd = (np.array(v, np.float64) for v in plain)
        par = np.array(parent)
        par[0] = 0
        t1 = np.maximum(t, 1)
        cols = [d, np.log1p(o), np.log1p(t), t / total, lk / t1, nd / t1 * 100, st / t1 * 100, pa, it, co, ki, ls, mk,
                se / max(1, before), t / np.maximum(1, t[par]), t / np.maximum(1, np.array(fat)[par]), ki[par],
                np.array([count.get((parent[e], tag[e]), 0) for e in range(n)]), lk[par] / t1[par], pa[par], it[par],
                st[par] / t1[par] * 100, np.log1p(t[par])]
        for i, c in enumerate(cols):
            x[:, i] = c
        i = len(cols)
        ti = np.array([_TAG.get(v, len(TAGS)) for v in tag])
        x[np.arange(n), i + ti] = 1
        i += len(TAGS) + 1
        for group in (te, ab):
            g = group.astype(np.int64)
            for b in range(len(TELLS)):
                x[:, i] = (g >> b) & 1
                i += 1
        kd = kd.astype(np.int64)
        for b in ABOVE:
            x[:, i] = (kd >> _TAG[b]) & 1
            i += 1
        return x

    def decode(self, logits: np.ndarray) -> np.ndarray:
        """Which elements are kept: the best choice under "kept only in a kept parent"."""
        n = len(self.tag)
        best = logits.tolist()
        best[0] = 0.0
        for e in range(n - 1, 0, -1):
            if self.tag[e] in OPAQUE:
                best[e] = -1.0
            elif best[e] > 0:
                best[self.parent[e]] += best[e]
        keep = np.zeros(n, bool)
        keep[0] = True
        for e in range(1, n):
            keep[e] = keep[self.parent[e]] and best[e] > 0
        return keep

    def text(self, keep: np.ndarray) -> str:
        """Kept blocks joined by newlines."""
        blocks, now = [], []
        for e, t in self.runs:
            if t is None:
                if now:
                    blocks.append("".join(now))
                    now = []
            elif e and keep[e]:
                now.append(t)
        blocks.append("".join(now))
        out = (" ".join(refs.unescape(b).split()) for b in blocks)
        return "\n".join(b for b in out if b)


ABOVE = ("article", "main", "nav", "header", "footer", "aside", "form", "ul", "table", "p")
NAMES = (["depth", "own", "text", "share", "link density", "tag density", "stop density", "paragraphs", "items",
          "controls", "children", "links", "mark", "place", "share of parent", "share of longest sibling", "siblings",
          "siblings alike", "parent link density", "parent paragraphs", "parent items", "parent stops", "parent text"]
         + [f"tag {t}" for t in (*TAGS, "other")] + [f"own {t}" for t in TELLS] + [f"above {t}" for t in TELLS]
         + [f"in {t}" for t in ABOVE])


class page_maker:
    """Generated pages with their article's parts marked: the training set."""

    def __init__(self, seed: int):
        self.r = random.Random(seed)
        self.soup = ["an", "er", "tion", "the", "lo", "mi", "ka", "ez", "ou", "st", "ne", "ri", "vel", "da", "por"]

    def words(self, a: int, b: int) -> str:
        r = self.r
        out = ["".join(r.choices(self.soup, k=r.randint(1, 4))) for _ in range(r.randint(a, b))]
        return " ".join(out)

    def sentence(self, a: int = 3, b: int = 16) -> str:
        return self.words(a, b).capitalize() + "."

    def prose(self, most: int = 6) -> str:
        r = self.r
        if r.random() < 0.2:
            return self.sentence(1, 5)
        out = " ".join(self.sentence() for _ in range(r.randint(1, most)))
        if r.random() < 0.15:
            w = out.split(" ")
            k = r.randrange(len(w))
            w[k] = f'<a href="/{k}">{w[k]}</a>'
            out = " ".join(w)
        return out

    def named(self, tag: str, groups: tuple[str, ...], inner: str) -> str:
        """An element with a telling class or id, or with one that means nothing."""
        r = self.r
        x = r.random()
        if x < 0.6:
            word = r.choice(TELLS[r.choice(groups)].split())
            word = r.choice([word, f"{word}-{r.choice(['box', 'wrap', 'area', 'list', '1'])}", f"site-{word}"])
        elif x < 0.85:
            word = r.choice("abcdefghk") + r.choice("xyzw") + str(r.randint(0, 99))
        else:
            return f"<{tag}>{inner}</{tag}>"
        return f'<{tag} {r.choice(["class", "class", "id"])}="{word}">{inner}</{tag}>'

    def heading(self) -> str:
        h = f"h{self.r.randint(1, 4)}"
        return f"<{h}>{self.words(1, 3)}</{h}>"

    def boiler(self) -> str:
        r = self.r
        kind = r.choice(["menu", "menu", "ad", "ad", "notice", "form", "talk", "side", "share", "edge"])
        if kind == "menu":
            items = "".join(f'<li><a href="/{i}">{self.words(1, 3)}</a></li>' for i in range(r.randint(3, 9)))
            return r.choice([f"<nav><ul>{items}</ul></nav>", self.named("div", ("menu",), f"<ul>{items}</ul>")])
        if kind == "ad":
            inner = r.choice([self.sentence(), self.prose(2), f'<a href="/x">{self.words(3, 9)}</a>', f"<p>{self.prose(2)}</p>"])
            word = r.choice(TELLS["ad"].split())
            return r.choice([f'<div class="{word}">{inner}</div>', f'<aside class="{word}">{inner}</aside>',
                             f'<div id="{word}-{r.randint(1, 9)}">{inner}</div>'])
        if kind == "notice":
            word = r.choice(TELLS["notice"].split())
            return f'<div class="{word}"><p>{self.prose(2)}</p>{r.choice(["", "<button>OK</button>"])}</div>'
        if kind == "form":
            return self.named("form", ("form",), f"<label>{self.words(1, 3)}</label><input type=text>"
                                                 f"{r.choice(['', f'<p>{self.sentence()}</p>'])}<button>Go</button>")
        if kind == "talk":
            tag = r.choice(["li", "div", "article"])
            each = "".join(f'<{tag} class="{r.choice(["comment", "reply", "comment-body"])}"><b>{self.words(1, 2)}</b>'
                           f"<p>{self.prose(3)}</p></{tag}>" for _ in range(r.randint(1, 6)))
            word = r.choice(["comments", "commentlist", "discussion", "replies", "comments-area", "reviews"])
            tag = r.choice(["section", "div", "div", "ol"])
            return f'<{tag} {r.choice(["class", "id"])}="{word}">{self.heading()}{each}</{tag}>'
        if kind == "side":
            items = "".join(f'<li><a href="/{i}">{self.words(3, 8)}</a></li>' for i in range(r.randint(2, 6)))
            word = r.choice(TELLS["side"].split())
            return r.choice([f"<aside>{self.heading()}<ul>{items}</ul></aside>",
                             f'<div class="{word}"><p>{self.prose(3)}</p></div>',
                             f'<div id="{word}">{self.heading()}<p>{self.prose(3)}</p></div>',
                             f'<div class="sidebar"><p>{self.prose(2)}</p><ul>{items}</ul></div>',
                             f"<aside><p>{self.prose(2)}</p></aside>", self.named("aside", ("side",), f"<p>{self.prose(2)}</p>")])
        if kind == "share":
            return self.named("div", ("share",), " ".join(f'<a href="/{i}">{self.words(1, 1)}</a>' for i in range(3)))
        line = f"&copy; {r.choice(['', '2020 '])}{self.sentence(1, 4)} {r.choice(['', self.sentence(2, 6)])}"
        return r.choice([f'<div class="{r.choice(["copyright", "legal", "colophon"])}">{line}</div>', f"<div>{line}</div>"])

    def make(self) -> str:
        """A page; the elements of its article have the attribute data-main."""
        r = self.r
        m = ' data-main="1"'

        def block() -> str:
            x = r.random()
            if x < 0.7:
                return f"<p{m}>{self.prose()}" + r.choice(["</p>", "</p>", ""])
            if x < 0.78:
                return f"<h2{m}>{self.words(2, 7)}</h2>"
            if x < 0.86:
                t = r.choice(["ul", "ol"])
                return f"<{t}{m}>" + "".join(f"<li{m}>{self.prose(2)}</li>" for _ in range(r.randint(2, 5))) + f"</{t}>"
            if x < 0.91:
                return f"<blockquote{m}><p{m}>{self.prose(3)}</p></blockquote>"
            if x < 0.95:
                return f"<div{m}>{self.prose(3)}</div>"
            if x < 0.98:
                return f"<p{m}><b{m}>{self.words(3, 9)}<br>"
            return (f"<table{m}><tr{m}><td{m}>{self.words(1, 3)}</td><td{m}>{self.words(1, 4)}</td></tr></table>")

        parts = [block() for _ in range(r.choice([1, 2, 3, 5, 8, 14]))]
        if r.random() < 0.15:  # next to nothing
            parts = [f"<p{m}>{self.sentence(1, 3)}</p>" for _ in range(r.randint(1, 2))]
        for _ in range(r.choice([0, 0, 0, 1, 1, 2])):
            parts.insert(r.randint(0, len(parts)), self.boiler())
        title = self.words(1, 10)
        head = r.choice(["", f"<h1{m}>{title}</h1>", f"<h1{m}>{title}</h1>", f"<header{m}><h1{m}>{title}</h1></header>"])
        body = head + "".join(parts)
        word = r.choice(TELLS["main"].split())
        wrap = r.choice([f"<article{m}>%s</article>", f"<article{m}>%s</article>", f"<main{m}>%s</main>",
                         f'<div{m} class="{word}">%s</div>', f'<div{m} id="{word}">%s</div>', f"<div{m}>%s</div>",
                         f'<main{m}><article{m} class="{word}">%s</article></main>',
                         f'<div{m} class="wrap"><section{m}>%s</section></div>',
                         f"<table{m}><tr{m}><td{m}>%s</td></tr></table>"])
        top = [self.boiler() for _ in range(r.randint(0, 3))]
        end = [self.boiler() for _ in range(r.randint(0, 3))]
        if r.random() < 0.5:
            top.insert(0, self.named("header", ("edge",), f'<a href="/">{self.words(1, 3)}</a>'))
        if r.random() < 0.7:
            end.append(f"<footer>{r.choice(['', '&copy; '])}{self.words(1, 3)} &middot; {self.prose(2)}</footer>")
        if r.random() < 0.04:  # bare text
            return f"<body{m}>" + body if r.random() < 0.5 else f"<body{m}>{self.prose()}"
        html = (f"<!DOCTYPE html><html><head><title>{title}</title><style>p{{}}</style></head><body>"
                + "".join(top) + wrap % body + "".join(end) + "</body></html>")
        return html if r.random() < 0.9 else html[:-14]


def with_inline(html: str, maker: page_maker) -> str:
    """The page with formulas, fallbacks and buttons in some of its paragraphs, and a notice for readers without scripts."""
    r = maker.r

    def more(m: re.Match) -> str:
        x = r.random()
        if x < 0.15:
            t = r.choice(["math", "object", "noscript", "kbd", "i", "custom-part"])
            return f"{m[0]}{maker.words(1, 3)} <{t}>{maker.words(1, 6)}</{t}> "
        if x < 0.25:
            return f"{m[0]}<button>{maker.words(1, 2)}</button> "
        return m[0]

    html = re.sub(r"<p[^>]*>", more, html)
    if r.random() < 0.5:
        html = html.replace("<body>", f"<body><noscript>{r.choice(['<p>', '<div>', ''])}{maker.sentence()}</noscript>")
    return html


@functools.lru_cache(maxsize=2)
def train(pages: int = TRAIN_PAGES, seed: int = SEED) -> gbdt.Trees:
    """The trees, from generated pages; kept for later calls of the process."""
    maker, other = page_maker(seed), page_maker(seed + 1)
    xs, ys = [], []
    for i in range(pages):
        html = maker.make()
        page = Page(html if i % 4 else with_inline(html, other))
        main = np.array(["data-main" in a for a in page.attrs])
        for e in range(1, len(main)):  # inline elements belong where they stand, but for buttons
            if page.tag[e] not in BLOCK:
                main[e] = main[page.parent[e]] and page.tag[e] != "button"
        for e in range(len(main) - 1, 0, -1):
            if main[e] and page.tag[page.parent[e]] in ("html", "body", "#root"):
                main[page.parent[e]] = True
        keep = np.array([t not in OPAQUE for t in page.tag])
        keep[0] = False
        xs.append(page.features()[keep])
        ys.append(main[keep])
    return gbdt.fit(np.concatenate(xs), np.concatenate(ys).astype(float), trees=80)


def extract(pages: DataFrame, keep: list[str], html_col: str = "html", trees: gbdt.Trees | None = None) -> DataFrame:
    """``keep`` columns, ``text`` and ``n_chars``."""
    model = base.share(pages.sparkSession, trees or train())

    def make():
        forest = model()

        def fn(htmls):
            parsed = [Page(h) for h in htmls]
            sizes = np.cumsum([0, *(len(p.tag) for p in parsed)])
            logits = forest.logits(np.concatenate([p.features() for p in parsed]))
            texts = [p.text(p.decode(logits[a:z])) for p, a, z in zip(parsed, sizes[:-1], sizes[1:])]
            return [texts, [len(t) for t in texts]]
        return fn

    return base.append_columns(pages, html_col, keep, [("text", T.StringType()), ("n_chars", T.LongType())], make)


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(base.table(spark, sf_dir, "pages"), ["page_id", "url"])
