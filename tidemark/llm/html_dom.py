"""A small DOM of block elements and text runs, and features of its nodes.

Nodes come in page order with the index of their parent, so a subtree's sums
are one pass from the back and an ancestor's sums one pass from the front.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import numpy as np

# Fixed values of HTML: elements without content, elements that break a line, elements whose text nobody reads.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = set("""address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form
h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul""".split())
SILENT = set("head title script style noscript template iframe object canvas select textarea button datalist".split())
HEAD_TAGS = set("html head base basefont bgsound link meta title style script noscript noframes template".split())      # do not end a head
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
# an element of the key ends at the start of one of these, unless a container named last is between
ENDS = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
        "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
        "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"})}
MAIN_TAGS = {"article", "main"}
BOILER_TAGS = {"nav", "header", "footer", "aside", "form", "menu", "dialog", "search"}
MAIN_WORDS = set("article content post entry story main maincontent articlebody".split())
BOILER_WORDS = set("""ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies
disqus discussion dialog footer form header login masthead menu modal nav navbar navigation newsletter notice notification overlay
pagination pager popup promo promoted promotion recommended related reply replies respond search share sharing sidebar
signup skip social sponsor sponsored subscribe subscription toolbar widget""".split())
FEATURES = ("depth chars words density link_density children siblings place share stops block_chars boiler_own boiler_above main_own "
            "main_above main_below boiler_below heading paragraph item text_run sibling_chars sibling_links largest start").split()
F_AT = {n: i for i, n in enumerate(FEATURES)}
_WORD = re.compile(r"[a-z]+")
_STOP = re.compile(r"[.!?…。,;:]")


class Dom(HTMLParser):
    """tags, parents, texts (None for elements) of the nodes of one page."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.tags, self.parents, self.texts = ["#page"], [-1], [None]
        self.hints, self.linked = [(0, 0)], [0]
        self.stack: list[tuple[str, int]] = [("#page", 0)]       # open elements; inline ones keep their block's node
        self.silent = 0
        self.run: list[str] = []
        self.run_links = self.links = 0
        self.feed(html)
        self.close()
        self._flush()

    def _add(self, tag, text=None, hint=(0, 0), linked=0) -> int:
        self.tags.append(tag)
        self.parents.append(self.stack[-1][1])
        self.texts.append(text)
        self.hints.append(hint)
        self.linked.append(linked)
        return len(self.tags) - 1

    def _flush(self):
        text = " ".join("".join(self.run).split())
        if text:
            self._add("#text", text, linked=min(self.run_links, len(text)))
        self.run, self.run_links = [], 0

    def _pop_to(self, i: int):
        for tag, _ in self.stack[i:]:
            self.silent -= tag in SILENT
            self.links -= tag == "a"
        del self.stack[i:]

    def _close_open(self, tags, stop):
        for i in range(len(self.stack) - 1, 0, -1):
            tag = self.stack[i][0]
            if tag in tags:
                self._pop_to(i)
                return self._close_open(tags, stop)
            if tag in stop:
                return None
        return None

    def _end_head(self):
        """</head> is optional: what cannot lie in a head ends it."""
        if self.silent == 1:
            for i, (tag, _) in enumerate(self.stack):
                if tag == "head":
                    return self._pop_to(i)
        return None

    def handle_starttag(self, tag, attrs):
        if tag not in HEAD_TAGS:
            self._end_head()
        if tag == "br":
            self.run.append(" ")
            return
        if tag in BLOCK:
            self._flush()
            if tag not in ("html", "body"):
                self._close_open({"p"}, BLOCK - {"p"})
            if tag in ENDS:
                self._close_open(*ENDS[tag])
        if tag in VOID:
            return
        if tag in BLOCK:
            words = set(_WORD.findall(" ".join(v or "" for k, v in attrs if k in ("class", "id", "role")).lower()))
            hint = (len(words & MAIN_WORDS) + (tag in MAIN_TAGS), len(words & BOILER_WORDS) + (tag in BOILER_TAGS))
            node = self._add(tag, hint=hint)
        else:
            node = self.stack[-1][1]
        self.stack.append((tag, node))
        self.silent += tag in SILENT
        self.links += tag == "a"

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag not in BLOCK and tag not in SILENT:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag == "br":
            self.run.append(" ")
            return
        for i in range(len(self.stack) - 1, 0, -1):
            open_ = self.stack[i][0]
            if open_ == tag:
                if tag in BLOCK:
                    self._flush()
                self._pop_to(i)
                return
            if tag not in BLOCK and open_ in BLOCK:
                return

    def handle_data(self, data):
        if self.stack[-1][0] == "head" and data.strip():
            self._end_head()
        if not self.silent:
            self.run.append(data)
            if self.links:
                self.run_links += len(data.strip())


def features(dom: Dom) -> np.ndarray:
    """One row per node, columns FEATURES."""
    n = len(dom.tags)
    parent = dom.parents
    x = np.zeros((n, len(FEATURES)))
    chars, words, stops, linked, tags, blocks = ([0] * n for _ in range(6))
    depth, kids, place, start = ([0] * n for _ in range(4))
    below_main, below_boiler, above_main, above_boiler = ([0] * n for _ in range(4))
    seen = 0
    for i in range(n):
        t = dom.texts[i]
        start[i] = seen
        if i:
            p = parent[i]
            depth[i] = depth[p] + 1
            place[i] = kids[p]
            kids[p] += 1
            above_main[i] = above_main[p] + dom.hints[p][0]
            above_boiler[i] = above_boiler[p] + dom.hints[p][1]
        if t is not None:
            chars[i], words[i], stops[i], linked[i], blocks[i] = len(t), t.count(" ") + 1, len(_STOP.findall(t)), dom.linked[i], 1
            seen += len(t)
        else:
            tags[i] = 1
    for i in range(n - 1, 0, -1):
        p = parent[i]
        for a in (chars, words, stops, linked, tags, blocks):
            a[p] += a[i]
        below_main[p] += below_main[i] + dom.hints[i][0]
        below_boiler[p] += below_boiler[i] + dom.hints[i][1]
    most = [0] * n
    for i in range(1, n):
        most[parent[i]] = max(most[parent[i]], chars[i])
    c, up = np.array(chars, float), np.array([max(p, 0) for p in parent])
    k, total = np.array(kids, float), max(chars[0], 1)
    links = np.array(linked, float)
    one = np.maximum(k[up], 1)
    tag = np.array(dom.tags)
    cols = {
        "depth": depth, "chars": np.log1p(c), "words": np.log1p(words), "density": c / (np.array(tags) + 1), "link_density": links / np.maximum(c, 1),
        "children": k, "siblings": one, "place": np.array(place) / one, "share": c / total, "stops": np.array(stops) / np.maximum(words, 1),
        "block_chars": c / np.maximum(blocks, 1), "boiler_own": [h[1] for h in dom.hints], "boiler_above": above_boiler,
        "main_own": [h[0] for h in dom.hints], "main_above": above_main, "main_below": below_main, "boiler_below": below_boiler,
        "heading": np.isin(tag, list(HEADINGS)), "paragraph": (tag == "p") | (tag == "pre") | (tag == "blockquote"),
        "item": np.isin(tag, ["li", "ul", "ol", "dl", "dt", "dd"]), "text_run": tag == "#text",
        "sibling_chars": np.log1p(c[up] / one), "sibling_links": links[up] / np.maximum(c[up], 1),
        "largest": c / np.maximum(np.array(most)[up], 1), "start": np.array(start) / total}
    for name, v in cols.items():
        x[:, F_AT[name]] = v
    return x
