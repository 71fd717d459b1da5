"""Main text of web pages: gradient-boosted trees over the nodes of a page, decoded so that the tree stays consistent.

A page is read into block elements and runs of text between block borders. A model gives every node the odds of being
main text, surroundings, or an element that holds both; features are the subtree's text, links and paragraphs, words of
the tag and its attributes, the same of its ancestors, depth and siblings. Decoding picks the likeliest labelling in
which whatever is below main text is main text and whatever is below surroundings is surroundings.

The model is trained here, on a bounded sample of the pages: their articles and surroundings (as their own tags tell
them apart) are put together anew in templates whose labels are known, with other tags, class words, comments, forms and
notices. Every page is then read whole.
"""

from __future__ import annotations

import html
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlake.llm.gbdt import Booster

#: Pages the model is trained on, of at most so many characters each, and templates made from them.
SAMPLE_PAGES, SAMPLE_CHARS, TEMPLATES = 100, 20_000, 300

MAIN, REST, BOTH = 0, 1, 2

# Element names of HTML by how they are read.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style title textarea noscript template iframe svg select head".split())
#: Of these, the ones that without an end tag take the rest of the page as their own text.
TO_END = set("script style title textarea".split())
BLOCK = set(
    "html body div p section article main nav header footer aside form ul ol li table thead tbody tfoot tr td th caption h1 h2 h3 h4 h5"
    " h6 blockquote pre figure figcaption details summary dl dt dd address fieldset legend dialog menu center button label hgroup search".split()
)
TAG_CLASS = dict.fromkeys("p blockquote pre".split(), 1) | dict.fromkeys("h1 h2 h3 h4 h5 h6".split(), 2) | dict.fromkeys("li dt dd".split(), 3) | dict.fromkeys("td th".split(), 4)
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
LISTS = set("ul ol menu dl table".split())

# Words that tags, classes, ids and roles are made of, by what they tell.
WORDS = {
    "main": "article main content post entry story body text prose",
    "menu": "nav navigation navbar menu breadcrumb breadcrumbs toc pagination pager tabs toolbar skip",
    "head": "header masthead banner top logo branding topbar",
    "foot": "footer foot bottom copyright legal contentinfo colophon",
    "side": "aside sidebar side widget rail complementary related recommended popular trending more tags share social author bio",
    "ad": "ad ads advert advertisement advertising adsense sponsor sponsored promo promotion banner",
    "note": "cookie cookies consent notice alert gdpr popup modal overlay toast announcement disclaimer paywall",
    "form": "form newsletter subscribe signup login search input button label fieldset dialog poll",
    "talk": "comment comments reply replies discussion respond disqus reactions responses commentlist feedback",
}
KINDS = list(WORDS)
_KIND = {w: sum(1 << k for k, words in enumerate(WORDS.values()) if w in words.split()) for words in WORDS.values() for w in words.split()}
_ATTRIBUTE = re.compile(r"""\b(class|id|role|aria-label|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_HIDDEN = re.compile(r"""\bhidden\b|display\s*:\s*none""", re.I)
# An empty comment may be as short as <!-->; others end with --> or --!>.
_TOKEN = re.compile(r"<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+|[^>]*)>", re.S)


def _kinds(tag: str, attributes: str) -> int:
    found = _KIND.get(tag, 0)
    if attributes:
        for m in _ATTRIBUTE.finditer(attributes):
            for word in re.findall(r"[a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", m[2] or m[3] or m[4] or "").lower()):
                found |= _KIND.get(word, 0)
    return found


class Page:
    """Nodes of a page in document order: parent, tag (empty: a run of text), kinds of words, text, characters in links."""

    def __init__(self, source: str):
        self.parent, self.tag, self.kinds, self.text, self.linked = [-1], ["#page"], [0], [""], [0]
        self._stack, self._run, self._links, self._in_link, self._endless = [0], [], 0, 0, set()
        self._open: Counter[str] = Counter()
        at, size = 0, len(source)
        while at < size:
            m = _TOKEN.search(source, at)
            self._words(source[at : m.start()] if m else source[at:])
            if not m:
                break
            at = m.end()
            if m[2]:
                at = self._tag(source, m, at)
        self._flush()

    def _words(self, text: str) -> None:
        if text:
            self._run.append(text)
            if self._in_link:
                self._links += len(text.strip())

    def _flush(self) -> None:
        if self._run:
            text = "".join(self._run)
            text = " ".join((html.unescape(text) if "&" in text else text).split())
            if text:
                self._add("", 0, text, min(self._links, len(text)))
        self._run, self._links = [], 0

    def _add(self, tag: str, kinds: int, text: str = "", linked: int = 0) -> int:
        self.parent.append(self._stack[-1])
        self.tag.append(tag)
        self.kinds.append(kinds)
        self.text.append(text)
        self.linked.append(linked)
        return len(self.tag) - 1

    def _tag(self, source: str, m: re.Match, at: int) -> int:
        name, closing = m[2].lower(), bool(m[1])
        if name in RAW:
            # Only a foreign element closes itself.
            if not closing and not (name == "svg" and m[3].endswith("/")):
                # A head without its end ends where the body begins; others that hold elements are read on after their tag.
                ends = r"</head\s*>|(?=<body[\s>])" if name == "head" else rf"</{re.escape(name)}\s*>"
                # Without an end here there is none further on; the page is not searched for it again.
                end = None if name in self._endless else re.compile(ends, re.I).search(source, at)
                if not end:
                    self._endless.add(name)
                self._run.append(" ")
                return end.end() if end else (len(source) if name in TO_END else at)
        elif name == "a":
            self._in_link = 0 if closing else 1
        elif name in ("br", "hr", "img", "wbr"):
            self._run.append("" if name == "wbr" else " ")
        elif name in BLOCK:
            self._flush()
            self._in_link = 0 if closing else self._in_link
            stack = self._stack
            if closing:
                # The stack is searched only for what is on it, so every step takes an element off.
                if self._open[name]:
                    self._close(next(i for i in range(len(stack) - 1, 0, -1) if self.tag[stack[i]] == name))
                return at
            if self.tag[stack[-1]] == "p":
                self._close(len(stack) - 1)
            ends = CLOSED_BY.get(name, ())
            if any(self._open[x] for x in ends):
                for i in range(len(stack) - 1, 0, -1):
                    if self.tag[stack[i]] in ends:
                        self._close(i)
                        break
                    if self.tag[stack[i]] in LISTS:
                        break
            kinds = _kinds(name, m[3]) | (1 << KINDS.index("note") if m[3] and _HIDDEN.search(m[3]) else 0)
            stack.append(self._add(name, kinds))
            self._open[name] += 1
        return at

    def _close(self, depth: int) -> None:
        for node in self._stack[depth:]:
            self._open[self.tag[node]] -= 1
        del self._stack[depth:]

    def features(self) -> np.ndarray:
        n = len(self.tag)
        size, linked, runs, paragraphs, words, stops, below = ([0] * n for _ in range(7))
        children, nth, depth, above = [0] * n, [0] * n, [0] * n, [0] * n
        for i in range(1, n):
            p = self.parent[i]
            nth[i], children[p] = children[p], children[p] + 1
            depth[i], above[i] = depth[p] + 1, above[p] | self.kinds[p]
        for i in range(n - 1, 0, -1):
            p, text = self.parent[i], self.text[i]
            if text:
                size[i], linked[i], runs[i], words[i] = len(text), self.linked[i], 1, text.count(" ") + 1
                stops[i] = sum(map(text.count, ".,;!?"))
            below[p] |= below[i] | self.kinds[i]
            paragraphs[p] += paragraphs[i] + (self.tag[i] == "p")
            for column in (size, linked, runs, words, stops):
                column[p] += column[i]
        total, before, out, bits = size[0] or 1, 0, [], []
        for i in range(n):
            p = max(0, self.parent[i])
            text, tag = self.text[i], self.tag[i] or self.tag[p]
            bits.append((self.kinds[i] if self.tag[i] else self.kinds[p], above[i], below[i]))
            out.append((
                size[i], size[i] / total, linked[i] / (size[i] or 1), words[i] / (runs[i] or 1), stops[i] / (words[i] or 1),
                paragraphs[i], runs[i], depth[i], nth[i] / (children[p] or 1), children[p], before / total, size[p] / total,
                linked[p] / (size[p] or 1), TAG_CLASS.get(tag, 0), not self.tag[i],
            ))
            if text:
                before += size[i]
        flags = (np.array(bits)[:, :, None] >> np.arange(len(KINDS)) & 1).reshape(n, -1)
        return np.concatenate([np.array(out, np.float64), flags], 1)

    def decode(self, odds: np.ndarray) -> str:
        """Main text under the likeliest consistent labels; a run of text cannot hold both."""
        n = len(self.tag)
        odds = odds.tolist()
        whole = [[o[MAIN], o[REST]] for o in odds]
        free = [o[BOTH] for o in odds]
        for i in range(n - 1, 0, -1):
            p = self.parent[i]
            best = max(whole[i]) if self.text[i] else max(*whole[i], free[i])
            free[p] += best
            whole[p][0] += whole[i][0]
            whole[p][1] += whole[i][1]
        label = [BOTH] * n
        for i in range(1, n):
            above = label[self.parent[i]]
            if above != BOTH:
                label[i] = above
            else:
                a, b = whole[i]
                label[i] = BOTH if not self.text[i] and free[i] > max(a, b) else MAIN if a > b else REST
        return "\n".join(t for t, k in zip(self.text, label) if t and k == MAIN)


def _templates(sources: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the nodes of pages put together from the sample's articles and surroundings."""
    draw = random.Random(7)
    bodies, asides = [], []
    for source in sources:
        page, inside = Page(source), {}
        for i in range(1, len(page.tag)):
            inside[i] = inside.get(page.parent[i], False) or page.tag[i] in ("article", "main")
        main = [t for i, t in enumerate(page.text) if t and inside[i]]
        bodies += [main] if main else []
        asides += [t for i, t in enumerate(page.text) if t and not inside[i]]
    bodies = bodies or [["Some words of a text, with a full stop. And more of them, for a while, until it ends."]]
    asides = asides or ["Home", "About", "Contact"]
    esc, pick = html.escape, draw.choice
    few = lambda low, high: [pick(asides) for _ in range(draw.randint(low, high))]
    said = lambda: pick(pick(bodies))  # noqa: E731  text as in an article, said elsewhere
    links = lambda items, tag="li": "".join(f'<{tag}><a href="/x">{esc(x)}</a></{tag}>' for x in items)
    named = lambda k: pick(WORDS[k].split())
    attr = lambda k: draw.choices((f' class="{named(k)}"', f' id="{named(k)}-{draw.randint(1, 9)}"', f' class="x-{named(k)} wide"', ""), (4, 2, 3, 1))[0]
    must = lambda k: f' class="{named(k)}"'

    def rest() -> str:
        kind = draw.randrange(9)
        paragraphs = lambda low, high: "".join(f"<p>{esc(said() if draw.random() < 0.5 else pick(asides))}</p>" for _ in range(draw.randint(low, high)))
        if kind == 0:
            tag = pick(("nav", "div"))
            return f"<{tag}{attr('menu') if tag == 'nav' else must('menu')}><ul>{links(few(2, 9))}</ul></{tag}>"
        if kind == 1:
            return f'<{(t := pick(("header", "div")))}{must("head")}><div>{esc(pick(asides))}</div>{links(few(0, 4), "span")}</{t}>'
        if kind == 2:
            return f'<{(t := pick(("footer", "div")))}{must("foot") if t == "div" else attr("foot")}>&copy; {esc(pick(asides))} &middot; {esc(said()[:200])}</{t}>'
        if kind == 3:
            return f'<{(t := pick(("aside", "div", "section")))}{must("side")}><h3>{esc(pick(asides))}</h3>{paragraphs(0, 3)}<ul>{links(few(1, 6))}</ul></{t}>'
        if kind == 4:
            return f'<div{must("ad")}>{pick((esc(pick(asides)), esc(said()), paragraphs(1, 2)))}</div>'
        if kind == 5:
            return f'<div{must("note")}>{paragraphs(1, 2)}<button>{esc(pick(asides))}</button></div>'
        if kind == 6:
            return f'<form{attr("form")}><label>{esc(pick(asides))}</label><input name="q">{paragraphs(0, 1)}<button>{esc(pick(asides)[:20])}</button></form>'
        if kind == 7:
            tag, each = pick((("section", "div"), ("div", "article"), ("ol", "li"), ("div", "div")))
            return f'<{tag}{must("talk")}><h3>{esc(pick(asides))}</h3>' + "".join(f'<{each}{attr("talk")}><b>{esc(pick(asides)[:20])}</b>{paragraphs(1, 3)}</{each}>' for _ in range(draw.randint(1, 5))) + f"</{tag}>"
        return f"<ul{attr('side')}>{links(few(3, 9))}</ul>"

    x, y = [], []
    for _ in range(TEMPLATES):
        body = pick(bodies)
        inner = [f"<h1>{esc(body[0])}</h1>"] if draw.random() < 0.8 else []
        for t in body[1:]:
            tag = draw.choices(("p", "li", "h2", "blockquote", "div"), (30, 1, 2, 1, 2))[0]
            text = esc(t) if draw.random() < 0.8 or len(t) < 40 else f'{esc(t[:20])}<a href="/y">{esc(t[20:40])}</a>{esc(t[40:])}'
            inner.append({"li": f"<ul><li>{text}</li></ul>"}.get(tag, f"<{tag}>{text}</{tag}>"))
        if draw.random() < 0.2 and inner:
            inner[0] = f"<header>{inner[0]}</header>"
        pieces = [f"<div data-main>{''.join(inner)}</div>"]
        while draw.random() < 0.35:
            pieces.insert(draw.randint(0, len(pieces)), rest())
        # Surroundings may also stand between the paragraphs, or after them in the same element.
        flat = draw.random() < 0.6
        at = draw.randint(0, len(inner))
        content = "\x01" + "".join(inner[:at]) + ("\x02" + rest() + "\x01" if draw.random() < 0.25 else "") + "".join(inner[at:]) + "\x02" if flat else "".join(f"\x01{p}\x02" if "data-main" in p else p for p in pieces)
        tag = draw.choices(("article", "main", "div", "section"), (4, 2, 4, 2))[0]
        shell = f"<{tag}{attr('main') if tag != 'div' else must('main')}>{content}</{tag}>"
        while draw.random() < 0.3:
            shell = f"<div{draw.choices((' class=wrap', ' id=page', attr('main')))[0]}>{shell}</div>"
        parts = [rest() for _ in range(draw.randint(0, 4))] + [shell] + [rest() for _ in range(draw.randint(0, 4))]
        page = Page(f"<html><head><title>t</title></head><body>{''.join(parts)}</body></html>")
        labels = _labels(page)
        keep = [i for i in range(len(labels)) if labels[i] is not None]
        rows = page.features()
        x += [rows[i] for i in keep]
        y += [labels[i] for i in keep]
    return np.array(x), np.array(y)


def _labels(page: Page) -> list:
    """Labels by the marks around main text, which are then taken out of the texts."""
    inside, of_run = False, {}
    for i, t in enumerate(page.text):
        if t:
            own = inside
            for c in t:
                inside = True if c == "\x01" else False if c == "\x02" else inside
                own = own or (c == "\x01")
            page.text[i] = t.replace("\x01", "").replace("\x02", "").strip()
            if page.text[i]:
                of_run[i] = MAIN if own and not t.startswith("\x02") else REST
    seen = [set() for _ in page.tag]
    for i in range(len(page.tag) - 1, 0, -1):
        if i in of_run:
            seen[i].add(of_run[i])
        seen[page.parent[i]] |= seen[i]
    return [None if not s else BOTH if len(s) == 2 else s.pop() for s in seen]


def train(pages: DataFrame, key: str = "page_id", column: str = "html") -> Booster:
    """A model from at most ``SAMPLE_PAGES`` pages of at most ``SAMPLE_CHARS`` characters, picked by a hash of key and url."""
    short = pages.where((F.length(column) > 0) & (F.length(column) <= SAMPLE_CHARS))
    sample = short.orderBy(F.xxhash64(key, column), key).select(column).limit(SAMPLE_PAGES).collect()
    return Booster().fit(*_templates([r[0] for r in sample]), 3)


def main_text(source: str | None, model: Booster) -> str:
    page = Page(source or "")
    return page.decode(model.log_probabilities(page.features()))


def extract(pages: DataFrame, model: Booster | None = None, key: str = "page_id", column: str = "html") -> DataFrame:
    """One row per page: ``page_id, url, text, n_chars`` (code points).

    Blocks of main text in page order, one per line, white space inside a block made one space, character references
    decoded. Null or empty pages, and pages without main text, have an empty text. Repeated rows come back as often. An
    empty table gives no rows. Other columns are not read.
    """
    model = pages.sparkSession.sparkContext.broadcast(model or train(pages, key, column))
    kind = pages.schema[key].dataType.simpleString()

    def run(batches):
        for b in batches:
            for low in range(0, b.num_rows, 64):
                part = b.slice(low, 64)
                read = [Page(x.as_py() or "") for x in part.column(2)]
                rows = [p.features() for p in read]
                odds = model.value.log_probabilities(np.concatenate(rows))
                borders = np.cumsum([len(f) for f in rows])[:-1]
                texts = [p.decode(o) for p, o in zip(read, np.split(odds, borders))]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"]
                )

    return pages.select(key, "url", column).mapInArrow(run, f"page_id {kind}, url string, text string, n_chars bigint")
