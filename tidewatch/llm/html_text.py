"""Main text of web pages by boosted trees over the nodes of the page.

Each element is described by its tag, the tokens of its class and id, its depth, how much text and how many links its subtree has, and how its
siblings look. Boosted trees say how likely it belongs to the article. Then the tree is decoded as a whole: an element that is dropped takes all
below it along, so no article text hangs below a dropped ancestor, and the choice with the highest total log-odds wins.

There are no labelled pages, so the trees are fitted on pages that ``templates`` makes by rule: articles amid menus, headers, footers,
sidebars, notices, adverts, forms and comments, under many names and shapes. They need no table and give the same model anywhere.

Cases: null or empty html gives an empty text; unclosed and stray tags are mended as browsers do for the common ones; a page cut off in the middle
of a tag loses that tag only; text outside any block belongs to its element; repeated rows give repeated results; an empty table gives an empty one.
Extra columns stay in ``extract``; a column named like the result is replaced.
"""

from __future__ import annotations

import random
from collections import Counter, deque
from collections.abc import Iterator
from functools import lru_cache
from html.parser import HTMLParser
from itertools import dropwhile

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidewatch.llm.common import prepare, text_of

#: Elements of the HTML standard by role.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
SILENT = set("script style noscript template head title svg math iframe object canvas textarea select button option datalist audio video map dialog".split())
#: Silent elements whose content is opaque to the tree; the others are nodes that are taken out of it, so what closes their parent closes them.
OPAQUE = set("script style title textarea head".split())
DROPPED = SILENT - OPAQUE
HEAD_CONTENT = set("base link meta noframes noscript script style template title".split())
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var".split())
ENDS_P = set("address article aside blockquote center details dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section table ul".split())
#: Which open element a new one closes, and where the search for it stops.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
          "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}

TAGS = "html body div section article main p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table tbody tr td th nav header footer aside form blockquote pre figure figcaption fieldset details summary address".split()
#: Tokens of class, id and role that pages use for their parts.
GOOD_TOKENS = "article content post entry body text story main page blog news single hentry prose markdown".split()
BAD_TOKENS = (
    "nav menu navbar breadcrumb breadcrumbs header masthead topbar banner logo footer foot bottom copyright sidebar side aside widget rail related recommended more "
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promoted cookie cookies consent gdpr notice notification alert modal popup overlay newsletter "
    "subscribe signup login form search share social sharing comment comments reply replies discussion disqus respond tags pagination pager toolbar skip legal byline meta"
).split()
FEATURES = [
    *(f"tag {t}" for t in TAGS), "other tag", *(f"good {t}" for t in GOOD_TOKENS), *(f"bad {t}" for t in BAD_TOKENS),
    "good tokens", "bad tokens", "good above", "bad above", "article above", "bad tag above", "depth", "place", "siblings", "same tag siblings", "text", "own text", "links", "link share", "words per block",
    "blocks", "stops per word", "share of page", "text before", "text of parent", "sibling link share", "inputs",
]


class Node:
    __slots__ = ("tag", "names", "parent", "children", "ended", "links")

    def __init__(self, tag: str, names: frozenset[str] = frozenset(), parent: Node | None = None):
        self.tag, self.names, self.parent, self.children = tag, names, parent, []
        self.ended, self.links = False, 0


class Page(HTMLParser):
    """A page as a tree of its block elements; inline elements leave their text, and links leave how much of it is theirs."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("html")
        self.silent: list[str] = []
        self.links = 0  # open links

    def handle_starttag(self, tag, attrs):
        if self.silent == ["head"]:  # its end tag may be left out: what is no head content ends it
            if tag in ("html", "head"):
                return
            if tag not in HEAD_CONTENT:
                self.silent.clear()
        elif self.silent[:1] == ["head"] and tag in ("body", "main", "article"):
            self.silent.clear()
        if self.silent:
            if tag not in VOID:
                self.silent.append(tag)
            return
        if tag in ("html", "body") and (tag == "html" or self.at.tag == "html"):
            if tag == "body":
                self._open(tag, attrs)
            return
        if tag == "input":
            self.at.children.append(("input", 0))
        if tag in VOID:
            if tag in ("br", "hr", "img", "wbr"):
                self.at.children.append((" ", 0))
            return
        if tag in OPAQUE:
            self.silent.append(tag)
            return
        if tag in DROPPED:
            self._open(tag, attrs)
            self.at.links = self.links
            return
        if tag in INLINE:
            self.links += tag == "a"
            return
        if tag in ENDS_P and self._find({"p"}, set(TAGS) - {"p"} | DROPPED) is not None:
            self._close({"p"}, set())
        if tag in CLOSES:
            for name in CLOSES[tag][0]:
                self._close({name}, CLOSES[tag][1] | DROPPED)
        self.links = 0
        self._open(tag, attrs)

    def _open(self, tag, attrs):
        names = " ".join(v for k, v in attrs if v and k in ("class", "id", "role")).lower()
        node = Node(tag, frozenset("".join(c if c.isalnum() else " " for c in names).split()), self.at)
        self.at.children.append(node)
        self.at = node

    def _find(self, tags, stop):
        node = self.at
        while node is not None and node.tag not in tags:
            if node.tag in stop:
                return None
            node = node.parent
        return node

    def _close(self, tags, stop):
        node = self._find(tags, stop)
        if node is not None and node.parent is not None:
            node.ended, self.at, self.links = True, node.parent, node.links

    def handle_endtag(self, tag):
        if self.silent:
            if tag in self.silent:
                while self.silent.pop() != tag:
                    pass
            elif tag in ("body", "html"):
                self.silent.clear()
            return
        if tag == "a":
            self.links = max(0, self.links - 1)
        elif tag == "p" and self._find({"p"}, set()) is None:
            return
        elif tag not in INLINE and tag not in ("html", "body") and tag not in VOID:
            self._close({tag}, {"body"} if tag in ENDS_P else {"table", "ul", "ol", "dl", "body"})

    def handle_data(self, data):
        if self.silent == ["head"] and data.strip():
            self.silent.clear()
        if not self.silent:
            self.at.children.append((data, self.links))


def without_dropped(root: Node) -> Node:
    """The tree without the dropped elements. One that is never ended loses what stands before its first block; the blocks stay."""
    stack = [root]
    while stack:
        node, kept = stack.pop(), []
        queue = deque(node.children)
        while queue:
            child = queue.popleft()
            if isinstance(child, Node):
                if child.tag in DROPPED:
                    if not child.ended:
                        queue.extendleft(reversed(list(dropwhile(lambda x: not isinstance(x, Node), child.children))))
                    continue
                child.parent = node
                stack.append(child)
            kept.append(child)
        node.children = kept
    return root


def parse(html: str) -> Node:
    """The page's tree. A tag that is cut off at the end is left out."""
    cut = html.rfind("<")
    if cut >= 0 and ">" not in html[cut:] and (html[cut + 1:cut + 2].isalpha() or html[cut + 1:cut + 2] in ("/", "!", "?", "")):
        html = html[:cut]
    page = Page()
    page.feed(html)
    page.close()
    return without_dropped(page.root)


def blocks(root: Node, kept: set[int] | None = None) -> list[str]:
    """Texts of the blocks in page order: runs of text between the edges of block elements."""
    out: list[str] = []
    held: list[str] = []

    def flush():
        text = " ".join("".join(held).split())
        held.clear()
        if text:
            out.append(text)

    stack = [(root, iter(root.children))]
    while stack:
        node, rest = stack[-1]
        child = next(rest, None)
        if child is None:
            flush()
            stack.pop()
        elif isinstance(child, Node):
            flush()
            if kept is None or id(child) in kept:
                stack.append((child, iter(child.children)))
        elif child[0] != "input":
            held.append(child[0])
    return out


def describe(root: Node) -> tuple[list[Node], np.ndarray, np.ndarray]:
    """The page's elements in page order, the place of each one's parent, and their features."""
    nodes, parents, stack = [], [], [(root, -1)]
    while stack:
        node, parent = stack.pop()
        me = len(nodes)
        nodes.append(node)
        parents.append(parent)
        stack += [(c, me) for c in reversed(node.children) if isinstance(c, Node)]
    n = len(nodes)
    own, links, stops, inputs = (np.zeros(n) for _ in range(4))
    for i, node in enumerate(nodes):
        for child in node.children:
            if not isinstance(child, Node):
                if child[0] == "input":
                    inputs[i] += 1
                    continue
                words = len(child[0].split())
                own[i] += words
                links[i] += words if child[1] else 0
                stops[i] += child[0].count(". ") + child[0].rstrip().endswith((".", "!", "?")) if words else 0
    text, all_links, all_stops, all_inputs, filled = own.copy(), links.copy(), stops.copy(), inputs.copy(), (own > 0).astype(float)
    for i in range(n - 1, 0, -1):
        p = parents[i]
        for x in (text, all_links, all_stops, all_inputs, filled):
            x[p] += x[i]
    before = np.zeros(n)
    before[1:] = np.cumsum(own)[:-1]
    siblings: dict[int, list[int]] = {}
    for i, p in enumerate(parents):
        siblings.setdefault(p, []).append(i)
    column = {name: k for k, name in enumerate(FEATURES)}
    x = np.zeros((n, len(FEATURES)))
    good, bad, tags = set(GOOD_TOKENS), set(BAD_TOKENS), set(TAGS)
    above = np.zeros((n, 5))  # good and bad tokens, article tags, parts' tags, depth
    for i, node in enumerate(nodes):
        p = parents[i]
        if p >= 0:
            q, tag = nodes[p], nodes[p].tag
            above[i] = above[p] + (bool(q.names & good), bool(q.names & bad), tag in ("article", "main"), tag in ("nav", "header", "footer", "aside", "form"), 1)
        x[i, column[f"tag {node.tag}"] if node.tag in tags else column["other tag"]] = 1
        for token in node.names & good:
            x[i, column[f"good {token}"]] = 1
        for token in node.names & bad:
            x[i, column[f"bad {token}"]] = 1
        x[i, column["good tokens"]], x[i, column["bad tokens"]] = len(node.names & good), len(node.names & bad)
    total = max(text[0], 1)
    own_share = all_links / np.maximum(text, 1)
    first = column["good above"]
    x[:, first:first + 4] = np.minimum(above[:, :4], 2)
    x[:, column["depth"]] = above[:, 4]
    for p, group in siblings.items():
        g = np.array(group)
        x[g, column["place"]] = np.arange(len(g)) / len(g)
        x[g, column["siblings"]] = len(g)
        tags_here = Counter(nodes[i].tag for i in group)
        x[g, column["same tag siblings"]] = [tags_here[nodes[i].tag] for i in group]
        x[g, column["text of parent"]] = np.log1p(text[p]) if p >= 0 else 0
        x[g, column["sibling link share"]] = all_links[g].sum() / max(text[g].sum(), 1)
    for name, values in (("text", np.log1p(text)), ("own text", np.log1p(own)), ("links", np.log1p(all_links)), ("link share", own_share), ("words per block", np.log1p(text / np.maximum(filled, 1))),
                         ("blocks", np.log1p(filled)), ("stops per word", all_stops / np.maximum(text, 1)), ("share of page", text / total), ("text before", before / total), ("inputs", all_inputs)):
        x[:, column[name]] = values
    return nodes, np.array(parents), x


class Boosted:
    """Gradient-boosted trees for a logistic loss, over binned features."""

    def __init__(self, rounds: int = 60, depth: int = 4, rate: float = 0.2, bins: int = 32, least: float = 5.0, ridge: float = 1.0):
        self.rounds, self.depth, self.rate, self.bins, self.least, self.ridge = rounds, depth, rate, bins, least, ridge
        self.trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def fit(self, x: np.ndarray, y: np.ndarray) -> Boosted:
        cuts = [np.unique(np.quantile(c, np.linspace(0, 1, self.bins + 1)[1:-1])) if len(np.unique(c)) > 2 else np.unique(c)[:-1] for c in x.T]
        binned = np.stack([np.searchsorted(c, v, side="left") for c, v in zip(cuts, x.T)], axis=1)  # bin b holds values up to cut b
        self.base = float(np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
        logit, n, width = np.full(len(y), self.base), x.shape[1], self.bins + 1
        flat = binned + np.arange(n) * width
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-logit))
            g, h = p - y, p * (1 - p)
            feature, cut, value = np.full(2 ** self.depth - 1, -1), np.zeros(2 ** self.depth - 1), np.zeros(2 ** (self.depth + 1) - 1)
            where = np.zeros(len(y), np.int64)
            for node in range(2 ** (self.depth + 1) - 1):
                rows = np.flatnonzero(where == node)
                if not len(rows):
                    continue
                total_g, total_h = g[rows].sum(), h[rows].sum()
                value[node] = -self.rate * total_g / (total_h + self.ridge)
                if node >= len(feature):
                    continue
                sums = [np.bincount(flat[rows].ravel(), np.repeat(v[rows], n), n * width).reshape(n, width).cumsum(axis=1)[:, :-1] for v in (g, h)]
                left_g, left_h = sums
                right_g, right_h = total_g - left_g, total_h - left_h
                gain = left_g**2 / (left_h + self.ridge) + right_g**2 / (right_h + self.ridge) - total_g**2 / (total_h + self.ridge)
                gain[(left_h < self.least * 0.05) | (right_h < self.least * 0.05)] = 0
                best = int(np.argmax(gain))
                f, b = divmod(best, width - 1)
                if gain.flat[best] <= 1e-6 or b >= len(cuts[f]):
                    continue
                feature[node], cut[node] = f, cuts[f][b]
                where[rows] = np.where(binned[rows, f] <= b, 2 * node + 1, 2 * node + 2)
            logit = logit + value[where]
            self.trees.append((feature, cut, value))
        return self

    def logit(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, cut, value in self.trees:
            at = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                inner = np.minimum(at, len(feature) - 1)
                f = np.where(at < len(feature), feature[inner], -1)
                step = 2 * at + 1 + (x[rows, np.maximum(f, 0)] > cut[inner])
                at = np.where(f >= 0, step, at)
            out += value[at]
        return out


def decode(parents: np.ndarray, logit: np.ndarray) -> np.ndarray:
    """Which elements to keep: the highest total of log-odds where whatever lies below a dropped element is dropped."""
    n = len(parents)
    dropped, kept = -logit.copy(), logit.copy()
    for i in range(n - 1, 0, -1):
        dropped[parents[i]] += dropped[i]
        kept[parents[i]] += max(kept[i], dropped[i])
    keep = np.zeros(n, bool)
    keep[0] = True
    for i in range(1, n):
        keep[i] = keep[parents[i]] and kept[i] > dropped[i]
    return keep


def templates(pages: int = 600, seed: int = 10) -> Iterator[str]:
    """Pages made by rule. Elements of the article bear the attribute ``data-keep``, which is no feature."""
    r = random.Random(seed)
    syllables = [a + b for a in "b c d f g l m n p r s t v th ch".split() for b in "a e i o u an er on ing".split()]
    word = lambda: "".join(r.choice(syllables) for _ in range(r.randint(1, 3)))
    few = lambda a, b: " ".join(word() for _ in range(r.randint(a, b)))
    link = lambda a=1, b=3: f'<a href="/{word()}">{few(a, b)}</a>'

    def sentence():
        return few(1, 18).capitalize() + r.choice([".", ".", ".", "!", "?", ""])

    def prose(a=1, b=6):
        parts = [sentence() for _ in range(r.randint(a, b))]
        if r.random() < 0.25:
            parts.insert(0, f"<b>{few(1, 5)}</b>")
        if r.random() < 0.2:
            parts.append(link())
        if r.random() < 0.1:
            parts = [few(4, 30)]
        if r.random() < 0.15:  # texts made of marks, upper case or cells
            mark = r.choice(["***", "%%%", "$$$", "###", "!!", " |"])
            parts = [" ".join(w + mark for w in " ".join(parts).split())]
        return " ".join(parts)

    def article():
        keep, out = " data-keep", []
        head = r.random()
        title = few(2, 12)
        if head < 0.6:
            out.append(f"<h1{keep}>{title}</h1>")
        elif head < 0.7:
            out.append(f"<header{keep}{r.choice(['', ' class=entry-header'])}><h1{keep}>{title}</h1></header>")
        elif head < 0.85:
            out.append(f"<div{keep} class='{r.choice(['title', 'entry-title', 'headline'])}'>{title}</div>")
        for _ in range(r.choice([1, 1, 2, 3, 4, 6, 9, 14, 25])):
            kind = r.random()
            if kind < 0.72:
                out.append(f"<p{keep}>{prose()}" + ("</p>" if r.random() < 0.9 else "<br>"))
            elif kind < 0.8:
                level = r.randint(2, 4)
                out.append(f"<h{level}{keep}>{few(1, 8)}</h{level}>")
            elif kind < 0.86:
                tag = r.choice(["ul", "ol"])
                out.append(f"<{tag}{keep}>" + "".join(f"<li{keep}>{prose(1, 2)}</li>" for _ in range(r.randint(1, 6))) + f"</{tag}>")
            elif kind < 0.9:
                out.append(f"<blockquote{keep}><p{keep}>{prose()}</p></blockquote>")
            elif kind < 0.93:
                out.append(f"<pre{keep}>{few(3, 40)}</pre>")
            elif kind < 0.96:
                out.append(f"<table{keep}>" + "".join(f"<tr{keep}>" + "".join(f"<td{keep}>{few(1, 4)}</td>" for _ in range(3)) + "</tr>" for _ in range(r.randint(1, 5))) + "</table>")
            else:
                out.append(f"<div{keep}>{prose()}</div>")
            if r.random() < 0.05:
                out.append(part(inside=True))
        body = "".join(out)
        wraps = ["<article{k}>{b}</article>", "<main{k}>{b}</main>", "<main{k}><article{k}>{b}</article></main>", "<div{k} class='{c}'>{b}</div>", "<div{k} id='{c}'><div{k} class='{d}'>{b}</div></div>",
                 "<section{k} class='{c}'>{b}</section>", "<article{k} class='{c}'><div{k} class='{d}'>{b}</div></article>", "<div{k}>{b}</div>", "<div{k}><div{k}>{b}</div></div>"]
        names = ["content", "post-content", "entry-content", "article-body", "story", "main-content", "post", "page-content", "text", "blog-post"]
        return r.choice(wraps).format(k=keep, b=body, c=r.choice(names), d=r.choice(names))

    def menu():
        items = [link(1, 2) for _ in range(r.randint(2, 10))]
        listed = "<ul>" + "".join(f"<li>{i}</li>" for i in items) + "</ul>"
        return r.choice([f"<nav>{listed}</nav>", f"<nav class='navbar'>{' '.join(items)}</nav>", f"<div class='{r.choice(['menu', 'main-nav', 'navigation menu', 'breadcrumbs'])}'>{listed}</div>", f"<div id='menu'>{' | '.join(items)}</div>", f"<div>{listed}</div>"])

    def comments():
        one = lambda: f"<div class='{r.choice(['comment', 'comment-body', 'reply'])}'><p class='{r.choice(['meta', 'author', 'by'])}'>{few(1, 3)}</p><p>{prose(1, 4)}</p></div>"
        tag, name = r.choice(["section", "div", "ol"]), r.choice(["comments", "comment-list", "discussion", "responses comments"])
        return f"<{tag} {r.choice(['class', 'id'])}='{name}'><h3>{few(1, 3)}</h3>{''.join(one() for _ in range(r.randint(1, 7)))}</{tag}>"

    def part(inside=False):
        kind = r.choice(["ad", "ad", "notice", "share", "related", "form"] + ([] if inside else ["sidebar", "comments", "newsletter", "promo"]))
        if kind == "ad":
            return f"<{(t := r.choice(['div', 'aside', 'section', 'p']))} class='{r.choice(['ad', 'ads', 'advert', 'ad-banner', 'sponsored', 'advertisement', 'promo'])}'>{r.choice([prose(1, 3), link(2, 8)])}</{t}>"
        if kind == "notice":
            text = prose(1, 3)
            return f"<div {r.choice(['class', 'id'])}='{r.choice(['cookie-notice', 'cookie', 'notice', 'gdpr consent', 'alert', 'cookie-banner', 'notification', 'popup'])}'>{r.choice([text, f'<p>{text}</p>', f'<p>{text}</p><button>{word()}</button>'])}</div>"
        if kind == "share":
            return f"<div class='{r.choice(['share', 'social', 'share-buttons', 'tags', 'meta'])}'>{' '.join(link(1, 2) for _ in range(r.randint(1, 5)))}</div>"
        if kind == "related":
            return f"<div class='{r.choice(['related', 'related-posts', 'recommended', 'more'])}'><h3>{few(1, 3)}</h3><ul>" + "".join(f"<li>{link(3, 9)}</li>" for _ in range(r.randint(2, 6))) + "</ul></div>"
        if kind == "form":
            return f"<form class='{r.choice(['search', 'login', 'signup', 'contact', ''])}'><label>{few(1, 3)}</label><input name='q'>{r.choice(['', f'<p>{prose(1, 2)}</p>'])}<input type='submit'></form>"
        if kind == "newsletter":
            return f"<div class='{r.choice(['newsletter', 'subscribe', 'signup'])}'><h4>{few(2, 5)}</h4><p>{prose(1, 2)}</p><input></div>"
        if kind == "promo":
            return f"<div class='{r.choice(['promo', 'sponsor', 'widget', 'banner'])}'><p>{prose(1, 3)}</p></div>"
        if kind == "comments":
            return comments()
        tag, attribute = r.choice([("aside", ""), ("aside", " class='sidebar'"), ("div", " class='sidebar'"), ("div", " id='sidebar'"), ("section", " class='side widget'")])
        return f"<{tag}{attribute}><h3>{few(1, 4)}</h3>{r.choice([f'<p>{prose(1, 4)}</p>', '<ul>' + ''.join(f'<li>{link(2, 7)}</li>' for _ in range(4)) + '</ul>'])}</{tag}>"

    for _ in range(pages):
        top = [f"<header{r.choice(['', ' class=site-header', ' id=masthead'])}>{r.choice([few(1, 6), f'<h1>{few(1, 3)}</h1><p>{few(2, 8)}</p>', menu()])}</header>" if r.random() < 0.4 else ""]
        top += [menu()] if r.random() < 0.85 else []
        top += [part() for _ in range(r.choice([0, 1, 1, 2]))]
        after = [part() for _ in range(r.choice([0, 0, 1, 2, 3]))] + ([comments()] if r.random() < 0.35 else [])
        foot = r.choice([f"<footer>&copy; {few(1, 4)} &middot; {prose(1, 3)}</footer>", f"<footer><p>{prose(1, 2)}</p>{menu()}</footer>", f"<div class='{r.choice(['footer', 'bottom copyright', 'legal'])}'>{prose(1, 2)}</div>", ""])
        middle = article()
        inner = "".join(top) + middle + "".join(after)
        if r.random() < 0.3:
            inner = f"<div data-keep class='{r.choice(['wrapper', 'container', 'page', 'site'])}'>{inner}</div>"
        yield f"<!DOCTYPE html><html><head><title>{few(2, 6)}</title></head><body>{inner}{foot}" + ("</body></html>" if r.random() < 0.9 else "")


class _Marked(Page):
    def _open(self, tag, attrs):
        super()._open(tag, attrs)
        if any(k == "data-keep" for k, _ in attrs) or tag == "body":
            self.at.names = self.at.names | {" keep"}


@lru_cache(maxsize=2)
def fitted(pages: int = 600) -> Boosted:
    """The trees, fitted on the template pages; below a dropped element nothing is learnt from."""
    xs, ys = [], []
    for html in templates(pages):
        page = _Marked()
        page.feed(html)
        page.close()
        nodes, parents, x = describe(page.root)
        keep = np.array([" keep" in node.names or i == 0 for i, node in enumerate(nodes)])
        for i in range(1, len(nodes)):
            keep[i] &= keep[parents[i]]
        xs.append(x)
        ys.append(keep)
    return Boosted().fit(np.concatenate(xs), np.concatenate(ys).astype(float))


def main_text(html: str, model: Boosted) -> str:
    return main_texts([html], model)[0]


def main_texts(pages: list[str], model: Boosted) -> list[str]:
    found = [describe(parse(html)) for html in pages]
    if not found:
        return []
    logits = np.split(model.logit(np.concatenate([x for _, _, x in found])), np.cumsum([len(n) for n, _, _ in found])[:-1])
    out = []
    for (nodes, parents, _), logit in zip(found, logits):
        keep = decode(parents, np.clip(logit, -8, 8))
        out.append("\n\n".join(blocks(nodes[0], {id(n) for n, k in zip(nodes, keep) if k})))
    return out


def extract(frame: DataFrame, html: str = "html", model: Boosted | None = None) -> DataFrame:
    """``frame`` without the html, with ``text``."""
    spark = prepare(frame.sparkSession)
    shared = spark.sparkContext.broadcast(model or fitted())

    @F.arrow_udf("string")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            pages = batch.to_pylist()
            yield pa.array([t for at in range(0, len(pages), 64) for t in main_texts(pages[at:at + 64], shared.value)], pa.string())

    rest = [F.col(f"`{c}`") for c in frame.columns if c not in (html, "text")]
    return frame.select(*rest, run(text_of(html)).alias("text"))


def report(pages: DataFrame) -> DataFrame:
    """Per page ``page_id``, ``url``, ``text``, ``n_chars``."""
    return extract(pages.select("page_id", "url", "html")).withColumn("n_chars", F.length("text").cast("bigint"))
