"""Main text of web pages: gradient-boosted trees over DOM nodes and a hierarchical decoding.

A page is read into a tree of elements. Every element gets features of its subtree (text, link and punctuation
density, paragraphs, descendants), of the tokens in its class, id and role, and of those above it, of its depth, and of
its place among its siblings and in the page. Boosted trees, trained in numpy on pages that ``sample_page`` makes up
(layouts, names and texts drawn at random, a fixed number of them), give the log odds that an element holds main text. The decoding
finds the set of elements with the largest sum of log odds that is closed upwards: an element is kept only with all its
ancestors, so that no kept text lies in a dropped part. It is exact, one pass from the leaves up.

Defined results: null or empty html gives empty text; broken markup is read leniently (unclosed and stray tags, void
elements, paragraphs that end where a block begins); head, scripts, styles, form controls and comments never count; ``br`` is white
space; a page of plain text is its text; pages are read whole, whatever their length.
"""

from __future__ import annotations

import functools
import html as entities
import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressmill.llm.common import small_batches, table

TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+|[^>]*+)>|<[!?][^>]*+>""", re.S)
END_OF = re.compile(r"</(script|style|noscript|iframe|textarea|title|template|svg|select|button|head|object|canvas)\b[^>]*>", re.I)
NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
ATTRIBUTE = re.compile(r"""([^\s"'>/=]++)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++)))?""")
MAY_HIDE = re.compile(r"hidden|display", re.I)
NO_DISPLAY = re.compile(r"(?:^|;)\s*display\s*:\s*none\b", re.I)
TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Text up to their own end tag, whatever stands in it.
RAW = frozenset("script style noscript iframe textarea title".split())
#: Elements read like any other, then dropped with all that is in them.
DROPPED = frozenset("template svg select button head object canvas".split())
IN_HEAD = frozenset("base link meta script style noscript template title object".split())
INLINE = frozenset("a abbr b bdi bdo big cite code data del dfn em font i ins kbd mark q s samp small span strike strong sub sup time tt u var label br img wbr input".split())
#: An opening tag ends these open elements, up to the nearest of the second set.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
TAG_GROUPS = ("article main", "section", "div", "p", "h1 h2 h3 h4 h5 h6", "ul ol dl menu", "li dd dt", "a", "table tbody thead tr td th", "nav", "header", "footer", "aside", "form fieldset", "figure figcaption", "blockquote pre", "body html")
#: These end a head, an svg and a dropped element that has no end tag.
BLOCKS = frozenset(" ".join(TAG_GROUPS).split()) - {"a", "html"}
GROUP_OF = {tag: i for i, tags in enumerate(TAG_GROUPS) for tag in tags.split()}
# Fixed word lists: what a class, id or role says about an element.
ROLES = (
    "nav navbar navigation menu menubar breadcrumb breadcrumbs crumbs pagination pager tabs toc topics categories",
    "header masthead banner topbar branding logo top tagline",
    "footer foot copyright colophon contentinfo legal bottom imprint",
    "sidebar aside secondary complementary widget widgets rail related recommended trending popular more sidecol teaser teasers",
    "ad ads advert adverts advertisement adsense adsbygoogle sponsor sponsored promo promotion promoted dfp outbrain taboola",
    "comment comments commentlist reply replies respond discussion disqus reader readers responses thread feedback",
    "notice cookie cookies consent gdpr alert warning popup modal overlay dialog message announcement disclaimer banner",
    "form search subscribe newsletter login signup register subscription contact poll survey",
    "share sharing social follow tweet facebook buttons toolbar tools print meta tags byline author date",
    "article content post entry body main story text page prose copy richtext maincontent news",
)
ROLE_OF: dict[str, int] = {}
for _i, _words in enumerate(ROLES):
    for _w in _words.split():
        ROLE_OF[_w] = ROLE_OF.get(_w, 0) | 1 << _i
TAG_ROLE = {"nav": 1, "menu": 1, "header": 2, "footer": 4, "aside": 8, "form": 128, "dialog": 64, "article": 512, "main": 512}
N_ROLES = len(ROLES)
N_FEATURES = len(TAG_GROUPS) + 1 + 2 * N_ROLES + 15


class Tree:
    """Elements in page order: parent, tag and roles of each; and the page's texts and block ends, in order."""

    __slots__ = ("parent", "tag", "roles", "items", "hidden")

    def __init__(self):
        self.parent, self.tag, self.roles, self.hidden = [-1], ["body"], [0], [False]
        self.items: list[tuple[int, str | None]] = []


_ROLE_CACHE: dict[str, int] = {}


def roles_of(attributes: str) -> int:
    found = _ROLE_CACHE.get(attributes)
    if found is None:
        found = 0
        for groups in NAMED.findall(attributes):
            for token in TOKEN.findall("".join(groups)):
                found |= ROLE_OF.get(token.lower(), 0)
        if len(_ROLE_CACHE) > 20_000:
            _ROLE_CACHE.clear()
        _ROLE_CACHE[attributes] = found
    return found


def hides(attributes: str) -> bool:
    """Whether hidden, aria-hidden="true" or display: none is among the attributes, by name and value."""
    if not MAY_HIDE.search(attributes):
        return False
    for name, *values in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), "".join(values)
        if name == "hidden" or (name == "aria-hidden" and value.strip().lower() == "true") or (name == "style" and NO_DISPLAY.search(value)):
            return True
    return False


def parse(page: str) -> Tree:
    tree = Tree()
    parent, tags, roles, hidden, items = tree.parent, tree.tag, tree.roles, tree.hidden, tree.items
    stack = [0]
    open_tags: dict[str, int] = {}
    dropped: list[bool] = [False]
    at, skip_to = 0, 0
    last_end = {m[1].lower(): m.start() for m in END_OF.finditer(page)}
    lenient: set[int] = set()  # open dropped elements that a block ends

    def close_to(depth: int) -> None:
        while len(stack) > depth:
            v = stack.pop()
            name = tags[v]
            open_tags[name] -= 1
            lenient.discard(v)
            if name not in INLINE and name not in DROPPED:
                items.append((stack[-1], None))

    def close_last(name: str) -> None:
        depth = len(stack) - 1
        while tags[stack[depth]] != name:
            depth -= 1
        close_to(depth)

    for m in TAG.finditer(page):
        start = m.start()
        if start < skip_to:
            continue
        if start > at:
            items.append((stack[-1], page[at:start]))
        at = m.end()
        name = m[2]
        if name is None:
            continue
        name = name.lower()
        if m[1]:
            if open_tags.get(name):
                close_last(name)
            continue
        empty = bool(m[3]) and m[3].endswith("/")
        if open_tags.get("head") and name not in IN_HEAD and not dropped[parent[stack[-1]]]:
            close_last("head")
        if name in BLOCKS and lenient and not open_tags.get("foreignobject"):
            for depth, v in enumerate(stack):
                if v in lenient:
                    close_to(depth)
                    break
        if name in RAW:
            end = re.compile(f"</{name}\\b[^>]*>", re.I).search(page, at) if last_end.get(name, -1) >= at else None
            if end or not empty:
                at = skip_to = end.end() if end else len(page)
            continue
        if name in DROPPED:
            if empty or (name == "head" and last_end.get(name, -1) < at):
                continue
            if name in ("button", "select") and open_tags.get(name):
                close_last(name)
            ended = last_end.get(name, -1) >= at
            if ended and name in ("button", "select", "canvas"):
                ended = bool(re.compile(f"<(/?){name}\\b", re.I).search(page, at)[1])
            if name == "svg" or not ended:
                lenient.add(len(parent))
        if name in ("html", "body"):
            roles[0] |= roles_of(m[3]) if m[3] else 0
            continue
        if name == "br":
            items.append((stack[-1], " "))
            continue
        if name in VOID:
            if name == "hr":
                items.append((stack[-1], None))
            continue
        if name not in INLINE and name not in DROPPED and not dropped[stack[-1]]:
            if open_tags.get("p"):
                depth = len(stack) - 1
                while tags[stack[depth]] != "p":
                    depth -= 1
                close_to(depth)
            if name in ENDS:
                shut, within = ENDS[name]
                depth = len(stack) - 1
                while depth > 0 and tags[stack[depth]] not in within and tags[stack[depth]] not in shut:
                    depth -= 1
                if depth > 0 and tags[stack[depth]] in shut:
                    close_to(depth)
            items.append((stack[-1], None))
        node = len(parent)
        attributes = m[3]
        parent.append(stack[-1])
        dropped.append(dropped[stack[-1]] or name in DROPPED)
        tags.append(name)
        roles.append((roles_of(attributes) if attributes else 0) | TAG_ROLE.get(name, 0))
        hidden.append(bool(attributes) and hides(attributes))
        if empty and name not in INLINE and name not in ("p", "div", "article", "section"):
            continue
        stack.append(node)
        open_tags[name] = open_tags.get(name, 0) + 1
    if at < len(page):
        items.append((stack[-1], page[at:]))
    left = [v for v, gone in enumerate(dropped) if not gone]
    place = {v: k for k, v in enumerate(left)}
    tree.parent, tree.tag, tree.roles, tree.hidden = [place.get(parent[v], -1) for v in left], *([of[v] for v in left] for of in (tags, roles, hidden))
    tree.items = [(place[n], entities.unescape(t) if t and "&" in t else t) for n, t in items if not dropped[n]]
    return tree


PUNCTUATION = re.compile(r"[.,;:!?]")


def features(tree: Tree) -> np.ndarray:
    n = len(tree.parent)
    parent = tree.parent
    own, links, stops, words, start, blocks = [0] * n, [0] * n, [0] * n, [0] * n, [-1] * n, [0] * n
    in_link, depth, above = [False] * n, [0] * n, [0] * n
    for v in range(1, n):
        p = parent[v]
        in_link[v] = in_link[p] or tree.tag[v] == "a"
        depth[v] = depth[p] + 1
        above[v] = above[p] | tree.roles[p]
    total = 0
    for v, t in tree.items:
        if t is None:
            continue
        t = t.strip()
        if not t:
            continue
        size = len(t)
        if start[v] < 0:
            start[v] = total
        own[v] += size
        words[v] += t.count(" ") + 1
        stops[v] += len(PUNCTUATION.findall(t))
        blocks[v] += 1
        if in_link[v]:
            links[v] += size
        total += size
    text, link, stop, word, run, below, paragraphs, children, first = own[:], links[:], stops[:], words[:], blocks[:], [0] * n, [int(t == "p") for t in tree.tag], [0] * n, start[:]
    order, same = [0] * n, [0] * n
    kinds: dict[tuple[int, str], int] = {}
    for v in range(1, n):
        p = parent[v]
        order[v] = children[p]
        children[p] += 1
        key = (p, tree.tag[v])
        kinds[key] = kinds.get(key, 0) + 1
    for v in range(n - 1, 0, -1):
        p = parent[v]
        text[p] += text[v]
        link[p] += link[v]
        stop[p] += stop[v]
        word[p] += word[v]
        run[p] += run[v]
        below[p] += below[v] + 1
        paragraphs[p] += paragraphs[v]
        if first[v] >= 0 and (first[p] < 0 or first[v] < first[p]):
            first[p] = first[v]
        same[v] = kinds[(p, tree.tag[v])]
    x = np.zeros((n, N_FEATURES), np.float32)
    groups = [GROUP_OF.get(t, len(TAG_GROUPS)) for t in tree.tag]
    x[np.arange(n), groups] = 1
    k = len(TAG_GROUPS) + 1
    bits = np.arange(N_ROLES)
    x[:, k : k + N_ROLES] = np.array(tree.roles)[:, None] >> bits & 1
    x[:, k + N_ROLES : k + 2 * N_ROLES] = np.array(above)[:, None] >> bits & 1
    k += 2 * N_ROLES
    text_, own_, below_ = np.array(text, float), np.array(own, float), np.array(below, float)
    siblings = np.array([0, *(children[parent[v]] for v in range(1, n))], float)
    some = np.maximum(text_, 1)
    x[:, k] = np.log1p(text_)
    x[:, k + 1] = np.array(link) / some
    x[:, k + 2] = np.log1p(own_)
    x[:, k + 3] = np.array(word) / np.maximum(run, 1)
    x[:, k + 4] = np.array(stop) / some
    x[:, k + 5] = depth
    x[:, k + 6] = np.array(order) / np.maximum(siblings - 1, 1)
    x[:, k + 7] = np.log1p(siblings)
    x[:, k + 8] = np.array(same) / np.maximum(siblings, 1)
    x[:, k + 9] = np.maximum(first, 0) / max(total, 1)
    x[:, k + 10] = text_ / max(total, 1)
    x[:, k + 11] = np.log1p(paragraphs)
    x[:, k + 12] = np.log1p(below_)
    x[:, k + 13] = np.log1p(text_ / (below_ + 1))
    x[:, k + 14] = [text[parent[v]] / max(total, 1) if v else 1 for v in range(n)]
    return x


class Boosted:
    """Trees of fixed depth on binned features, logistic loss; heap order, so prediction is the same steps for all rows."""

    def __init__(self, trees: int = 60, depth: int = 4, rate: float = 0.3, bins: int = 32, l2: float = 1.0):
        self.trees, self.depth, self.rate, self.bins, self.l2 = trees, depth, rate, bins, l2

    def fit(self, x: np.ndarray, y: np.ndarray) -> Boosted:
        n, m = x.shape
        self.edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, self.bins)[1:-1])) for f in range(m)]
        binned = np.stack([np.searchsorted(self.edges[f], x[:, f], "left") for f in range(m)], 1)
        self.base = float(np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
        inner = (1 << self.depth) - 1
        self.feature, self.threshold = np.zeros((self.trees, inner), np.int64), np.full((self.trees, inner), np.inf, np.float32)
        self.leaf = np.zeros((self.trees, inner + 1), np.float32)
        z = np.full(n, self.base)
        for t in range(self.trees):
            p = 1 / (1 + np.exp(-z))
            g, h = p - y, p * (1 - p)
            at = np.zeros(n, np.int64)
            for level in range(self.depth):
                first, width = (1 << level) - 1, 1 << level
                slot = at - first
                best, choice = np.full(width, 1e-9), [None] * width
                for f in range(m):
                    key = slot * self.bins + binned[:, f]
                    gs = np.bincount(key, g, width * self.bins).reshape(width, -1).cumsum(1)
                    hs = np.bincount(key, h, width * self.bins).reshape(width, -1).cumsum(1)
                    all_g, all_h = gs[:, -1:], hs[:, -1:]
                    gain = gs**2 / (hs + self.l2) + (all_g - gs) ** 2 / (all_h - hs + self.l2) - all_g**2 / (all_h + self.l2)
                    cut = gain[:, : len(self.edges[f])]
                    if not cut.shape[1]:
                        continue
                    k = cut.argmax(1)
                    for w in np.flatnonzero(cut[np.arange(width), k] > best):
                        best[w], choice[w] = cut[w, k[w]], (f, k[w])
                for w, found in enumerate(choice):
                    if found:
                        self.feature[t, first + w], self.threshold[t, first + w] = found[0], self.edges[found[0]][found[1]]
                at = 2 * at + 1 + (x[np.arange(n), self.feature[t, at]] > self.threshold[t, at])
            slot = at - inner
            gs, hs = np.bincount(slot, g, inner + 1), np.bincount(slot, h, inner + 1)
            self.leaf[t] = -self.rate * gs / (hs + self.l2)
            z += self.leaf[t, slot]
        return self

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        z, rows = np.full(len(x), self.base), np.arange(len(x))
        inner = (1 << self.depth) - 1
        for t in range(self.trees):
            at = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                at = 2 * at + 1 + (x[rows, self.feature[t, at]] > self.threshold[t, at])
            z += self.leaf[t, at - inner]
        return z


def decode(parent: list[int], odds: np.ndarray) -> list[bool]:
    """The upward-closed set of elements with the largest sum of log odds; the root is always kept."""
    n = len(parent)
    gain = odds.tolist()
    for v in range(n - 1, 0, -1):
        if gain[v] > 0:
            gain[parent[v]] += gain[v]
    kept = [True] * n
    for v in range(1, n):
        kept[v] = kept[parent[v]] and gain[v] > 0
    return kept


def written(tree: Tree, kept: list[bool]) -> str:
    """Kept texts: white space inside a block becomes one space, blocks are joined by a line end."""
    blocks, part = [], []
    for v, t in tree.items:
        if t is None:
            if part:
                blocks.append(" ".join("".join(part).split()))
                part = []
        elif kept[v] and not tree.hidden[v]:
            part.append(t)
    blocks.append(" ".join("".join(part).split()))
    return "\n".join(b for b in blocks if b)


# --- pages to train on ---


def sample_page(rng: random.Random) -> tuple[str, list[str]]:
    """A made-up page and the blocks of its main text. Parts of main text carry a mark that training reads off again."""
    stems = [a + b for a in ("ka", "ne", "to", "ri", "mu", "so", "la", "vi", "de") for b in ("n", "ra", "l", "st", "", "men")]

    def words(n: int, stop: bool = True) -> str:
        out = [rng.choice(stems) + rng.choice(("", "", rng.choice(stems))) for _ in range(max(1, n))]
        rate = rng.choice((0.03, 0.12, 0.12, 0.12, 0.4, 1))
        for i in range(len(out)):
            if stop and rng.random() < rate:
                out[i] += rng.choice((",", ",", ".", "."))
        return " ".join(out).capitalize() + ("." if stop else "")

    def link(n: int = 2) -> str:
        n = rng.choice((1, n))
        text = words(n, False) + rng.choice(("", "", "", ".", ",", "!", " &amp;"))
        return f'<a href="/{rng.randrange(999)}">{text}</a>'

    def named(*options: str) -> str:
        """An attribute with one of the names, or none, or one that says nothing."""
        r = rng.random()
        if r < 0.12:
            return ""
        if r < 0.2:
            return f' class="{rng.choice(("row", "col-6", "box", "block", "c12", "inner", "wrap"))}"'
        name = rng.choice(options)
        return f' {rng.choice(("class", "class", "id"))}="{rng.choice(("", "", "site-", "page-", "js-", "x "))}{name}"'

    def menu() -> str:
        tag = rng.choice(("nav", "nav", "div", "ul"))
        items = "".join(f"<li>{link(rng.randint(1, 3))}</li>" for _ in range(rng.randint(3, 12)))
        return f"<{tag}{named('menu', 'nav', 'navigation', 'breadcrumbs', 'main-nav', 'topics')}>{items if tag == 'ul' else '<ul>' + items + '</ul>'}</{tag}>"

    def head() -> str:
        tag = rng.choice(("header", "header", "div"))
        return f"<{tag}{named('header', 'masthead', 'top', 'branding')}>{link(1)}<{rng.choice(('p', 'span', 'div', 'h1'))}>{words(rng.randint(2, 9), False)}</p></{tag}>"

    def foot() -> str:
        tag = rng.choice(("footer", "footer", "div"))
        return f"<{tag}{named('footer', 'copyright', 'colophon')}>{rng.choice(('&copy; ', '', '2024 '))}{words(rng.randint(3, 25))}{' '.join(link(1) for _ in range(rng.randint(0, 6)))}</{tag}>"

    def advert() -> str:
        return f"<{(t := rng.choice(('div', 'div', 'aside', 'section')))}{named('ad', 'advert', 'sponsored', 'promo', 'ad-slot', 'ads')}>{words(rng.randint(3, 30))}</{t}>"

    def notice() -> str:
        return f"<{(t := rng.choice(('div', 'section', 'aside')))}{named('cookie-notice', 'notice', 'alert', 'gdpr-consent', 'message')}><p>{words(rng.randint(6, 35))}</p>{link(1)}</{t}>"

    def form() -> str:
        return f"<form{named('newsletter', 'search', 'subscribe', 'login')}><label>{words(2, False)}</label><p>{words(rng.randint(3, 14))}</p><input name=q><div>{words(1, False)}</div></form>"

    def side() -> str:
        tag = rng.choice(("aside", "aside", "div"))
        parts = [f"<h3>{words(2, False)}</h3><ul>{''.join(f'<li>{link(rng.randint(2, 7))}</li>' for _ in range(rng.randint(3, 9)))}</ul>" if rng.random() < 0.6 else f"<h4>{words(2, False)}</h4><p>{words(rng.randint(8, 40))}</p>" for _ in range(rng.randint(1, 4))]
        return f"<{tag}{named('sidebar', 'secondary', 'related', 'widget-area', 'recommended', 'rail')}>{''.join(parts)}</{tag}>"

    def comments() -> str:
        tag = rng.choice(("section", "div", "ol"))
        inner = rng.choice(("div", "article", "li"))
        many = "".join(f"<{inner}{named('comment', 'comment-body', 'reply')}><b>{words(1, False)}</b><p>{words(rng.randint(4, 60))}</p></{inner}>" for _ in range(rng.randint(1, 7)))
        name = f' {rng.choice(("class", "id"))}="{rng.choice(("comments", "comment-list", "discussion", "reader-comments", "responses", "disqus_thread"))}"'
        return f"<{tag}{name}><h3>{words(2, False)}</h3>{many}</{tag}>"

    def share() -> str:
        return f"<div{named('share', 'social', 'tools')}>{' '.join(link(1) for _ in range(rng.randint(2, 5)))}</div>"

    blocks: list[str] = []

    def block(text: str) -> str:
        blocks.append(text)
        return "\x01" + text

    def main() -> str:
        out = [f"<h1>{block(words(rng.randint(3, 10), False))}</h1>"] if rng.random() < 0.85 else []
        unit = rng.choice(("p", "p", "p", "p", "div"))
        for _ in range(rng.choice((1, 2, 4, 7, 12, 25))):
            r, text = rng.random(), words(rng.choice((1, 2, 5, 20, 40, 80, 150)))
            if r < 0.72:
                body = block(text)
                if rng.random() < 0.15:
                    cut = rng.randint(0, len(text))
                    body = "\x01" + text[:cut] + rng.choice(("<b>", "<i>", '<a href="#">')) + text[cut:] + ("</b>" if rng.random() < 0.8 else "")
                out.append(f"<{unit}>{body}" + (f"</{unit}>" if unit == "div" or rng.random() < 0.9 else ""))
            elif r < 0.8:
                out.append(f"<h2>{block(words(rng.randint(1, 6), False))}</h2>")
            elif r < 0.86:
                out.append(f"<blockquote><p>{block(text)}</p></blockquote>")
            elif r < 0.92:
                out.append("<ul>" + "".join(f"<li>{block(words(rng.randint(2, 16)))}</li>" for _ in range(rng.randint(2, 6))) + "</ul>")
            elif r < 0.95:
                out.append("<table><tr>" + "".join(f"<td>{block(words(2, False))}</td>" for _ in range(3)) + "</tr></table>")
            elif r < 0.97:
                out.append(advert())
            else:
                out.append(share())
        if rng.random() < 0.2:
            out.append(side().replace("aside", "div"))
        if rng.random() < 0.2:
            out.append(comments())
        if rng.random() < 0.12:
            out.append(notice())
        shape = rng.random()
        tag, name = ("article", named("post", "story", "x")) if shape < 0.5 else ("main", "") if shape < 0.62 else ("div", named("content", "post-body", "entry-content", "article", "story", "main", "text"))
        inner = "".join(out)
        if rng.random() < 0.3:
            inner = f"<div{named('content', 'body', 'entry', 'text')}>{inner}</div>"
        return f"<{tag}{name}>{inner}</{tag}>"

    before = [f() for f in (head, menu, notice, advert, side, form) if rng.random() < 0.42]
    rng.shuffle(before)
    article = main()
    after = [f() for f in (comments, side, advert, share, menu, form, notice) if rng.random() < 0.3]
    rng.shuffle(after)
    page = "".join(before) + article + "".join(after) + (foot() if rng.random() < 0.85 else "")
    if rng.random() < 0.4:
        page = f"<div{named('page', 'container', 'wrapper', 'main')}>{page}</div>"
    return f"<!DOCTYPE html><html><head><title>{words(4, False)}</title><style>p{{}}</style></head><body><script>var a='</p>';</script>{page}</body></html>", blocks


def labelled(tree: Tree) -> np.ndarray:
    """1 for each element that holds marked text, itself or below."""
    y = np.zeros(len(tree.parent))
    for v, t in tree.items:
        if t and "\x01" in t:
            y[v] = 1
    for v in range(len(y) - 1, 0, -1):
        y[tree.parent[v]] = max(y[tree.parent[v]], y[v])
    return y


def inherited(tree: Tree, y: np.ndarray) -> np.ndarray:
    """Inline elements inside main text belong to it."""
    for v in range(1, len(y)):
        if tree.tag[v] in INLINE and y[tree.parent[v]] and any(n == tree.parent[v] and t and "\x01" in t for n, t in tree.items):
            y[v] = 1
    return y


@functools.lru_cache
def trained(pages: int = 1000, seed: int = 11, **settings) -> Boosted:
    """The model of so many made-up pages; a process trains it once."""
    rng = random.Random(seed)
    xs, ys = [], []
    for _ in range(pages):
        marked = parse(sample_page(rng)[0])
        ys.append(inherited(marked, labelled(marked)))
        marked.items = [(v, t.replace("\x01", "") if t else t) for v, t in marked.items]
        xs.append(features(marked))
    return Boosted(**settings).fit(np.concatenate(xs), np.concatenate(ys))


def extract(pages: list[str], model: Boosted) -> list[str]:
    trees = [parse(p) for p in pages]
    sizes = np.cumsum([0, *(len(t.parent) for t in trees)])
    odds = model.log_odds(np.concatenate([features(t) for t in trees])) if trees else np.zeros(0)
    return [written(t, decode(t.parent, odds[a:b])) for t, a, b in zip(trees, sizes, sizes[1:])]


def main_text(pages: DataFrame, html_col: str = "html", model: Boosted | None = None) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    spark = pages.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model or trained())
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])

    def run(batches):
        for batch in batches:
            texts = extract([h or "" for h in batch.column(2).to_pylist()], shared.value)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], schema=schema)

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages"))
