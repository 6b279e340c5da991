"""Main text of web pages by gradient-boosted trees over the nodes of the page.

Nodes are the block elements of a page. Features: depth, text and link density of the subtree, paragraphs and
punctuation, place in the page, statistics among siblings, the tags and the tokens of class, id and role of the node and of
those above it, each as its leaning (smoothed log-odds) in the training pages. Trees give each node the chance that its own text is main text. Decoding is hierarchical: every node is
above (holds both kinds), in or out; below a node that is out all are out, below one that is in there are none
above; the labelling of the whole page with the highest likelihood wins.

Training takes at most ``SAMPLE_PAGES`` pages that mark their article (article, main or role=main), chosen by a hash of
the id. Their nodes are labelled by that markup and by the tags for navigation, headers, footers, asides and forms. Each page is
also used in changed forms: the markers replaced by plain blocks, and blocks of furniture (``FURNITURE``) with words of the
page put in; so the trees learn attribute tokens and densities and not only the markers.

Output: white space within a block is one space, blocks are joined by one space in page order; line breaks end a block.
Defined results: NULL, empty and text-free pages give an empty text. Repeated rows each get a row. Without any marked page in the table,
training uses ``SEED_PAGE`` in its changed forms.
"""

from __future__ import annotations

import html
import random
import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, map_arrow

SAMPLE_PAGES, SAMPLE_BYTES = 100, 60_000
FORMS = 4
TREES, DEPTH, RATE, BINS = 60, 5, 0.2, 32

TAG = re.compile(r"<(?:!--.*?(?:-->|$)|!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|$)|[!?][^>]*(?:>|$)|(?P<close>/)?(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|$))", re.S)
ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
WORD = re.compile(r"[a-z]+")
# Fixed values of the HTML standard.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = set("script style noscript template textarea select button iframe svg math canvas object head title option datalist audio video".split())
RAW = set("script style textarea title noscript iframe".split())
BLOCK = set("html body main article section div header footer nav aside form fieldset p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption blockquote pre figure figcaption address details summary dialog menu center hgroup".split())
CLOSES_P = BLOCK - {"html", "body", "td", "th", "tr", "caption", "thead", "tbody", "tfoot"}
ITEM_OF = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
HOLDERS = set("ul ol dl table tbody thead tfoot menu".split())
# Tag and attribute words by which pages name what is not their article.
AWAY_TAGS = {"nav", "header", "footer", "aside", "form", "menu", "dialog"}
# Of these the ones that never hold main text, wherever they stand: the trees are not asked.
CLOSED_TAGS = {"nav", "aside", "form", "menu", "dialog"}
FURNITURE = (
    "ad ads advert advertisement sponsor sponsored promo promotion banner sidebar widget related recommended popular trending share sharing social follow menu nav navbar navigation breadcrumb breadcrumbs "
    "pagination pager header masthead footer copyright legal cookie cookies consent gdpr notice alert popup modal overlay newsletter subscribe signup login search form comment comments reply replies respond disqus "
    "discussion toolbar topbar skip tags meta print rail outbrain taboola"
).split()
CONTENT = "content article post entry story body main text page".split()
NEUTRAL = "wrap wrapper container row col inner outer box list area site layout block section group".split()
SEED_PAGE = "<html><body><nav><ul><li><a href=x>Home</a></li><li><a href=x>About</a></li></ul></nav><article><h1>A title of some words</h1>" + "<p>This is a paragraph of running text, with several words in it, and then some more.</p>" * 6 + "</article><footer>All rights reserved</footer></body></html>"


@dataclass(slots=True)
class Node:
    tag: str
    parent: int
    depth: int
    words: tuple[str, ...] = ()
    own: int = 0
    links: int = 0
    marks: int = 0
    start: int = 0
    children: list[int] = field(default_factory=list)


def parse(page: str) -> tuple[list[Node], list[tuple[int, str]]]:
    """Block nodes in page order (the first is a root), and the runs of text as (node, text); an empty text is a break."""
    nodes, runs = [Node("html", -1, 0)], []
    stack: list[tuple[str, int]] = [("html", 0)]  # open elements with their block node
    hidden = anchors = 0
    at = seen = 0

    def add(raw: str) -> None:
        nonlocal seen
        if hidden or not raw:
            return
        text = html.unescape(raw) if "&" in raw else raw
        k = stack[-1][1]
        runs.append((k, text))
        n = len(text) if not text.isspace() else 0
        node = nodes[k]
        node.own += n
        node.links += n if anchors else 0
        node.marks += text.count(",") + text.count(".") if n else 0
        seen += n

    def close(depth: int) -> None:
        nonlocal hidden, anchors
        while len(stack) > depth:
            name, k = stack.pop()
            hidden -= name in HIDDEN
            anchors -= name == "a"
            if name in BLOCK:
                runs.append((k, ""))

    size = len(page)
    while at < size:
        m = TAG.search(page, at)
        if not m:
            add(page[at:])
            break
        add(page[at : m.start()])
        at = m.end()
        if m["cdata"]:
            add(m["cdata"])
        if not (name := (m["name"] or "").lower()):
            continue
        if m["close"]:
            if name == "br":
                runs.append((stack[-1][1], ""))
            for d in range(len(stack) - 1, 0, -1):
                if stack[d][0] == name:
                    close(d)
                    break
                if stack[d][0] in BLOCK and name not in BLOCK:  # a stray end of an inline element does not end blocks
                    break
            continue
        if name in VOID:
            if name in ("br", "hr"):
                runs.append((stack[-1][1], ""))
            continue
        if name in RAW:
            end = re.compile(rf"</{name}\b[^>]*(?:>|$)", re.I).search(page, at)
            at = end.end() if end else size
            continue
        if name in ("html", "body") and any(s[0] == name for s in stack):
            continue
        if name in CLOSES_P:
            for d in range(len(stack) - 1, 0, -1):
                if stack[d][0] == "p":
                    close(d)
                    break
                if stack[d][0] in BLOCK:
                    break
        if name in ITEM_OF:
            for d in range(len(stack) - 1, 0, -1):
                if stack[d][0] in ITEM_OF[name]:
                    close(d)
                if stack[min(d, len(stack) - 1)][0] in HOLDERS:
                    break
        k = stack[-1][1]
        if name in BLOCK:
            words: list[str] = []
            for a in ATTRIBUTE.finditer(m["rest"] or ""):
                words += WORD.findall((a[2] or a[3] or a[4] or "").lower())
            parent, k = k, len(nodes)
            nodes.append(Node(name, parent, nodes[parent].depth + 1, tuple(words), start=seen))
            nodes[parent].children.append(k)
            runs.append((k, ""))
        if (m["rest"] or "").endswith("/") and name not in BLOCK:
            continue
        stack.append((name, k))
        hidden += name in HIDDEN
        anchors += name == "a"
    return nodes, runs


def features(nodes: list[Node], leanings: dict[str, float]) -> np.ndarray:
    n = len(nodes)
    text, links, marks, tags, paragraphs = (np.array(x, float) for x in zip(*((v.own, v.links, v.marks, 1, v.tag == "p") for v in nodes)))
    own = text.copy()
    for k in range(n - 1, 0, -1):  # children come after their parents
        p = nodes[k].parent
        for total in (text, links, marks, tags, paragraphs):
            total[p] += total[k]
    parent = np.array([max(v.parent, 0) for v in nodes])
    whole = max(text[0], 1)
    rank, count = np.zeros(n), np.ones(n)
    for v in nodes:
        for i, c in enumerate(v.children):
            rank[c], count[c] = i / len(v.children), len(v.children)
    numeric = np.stack([
        [v.depth for v in nodes], np.log1p(own), np.log1p(text), links / np.maximum(text, 1), np.log1p(text / tags), np.log1p(paragraphs), marks / np.maximum(text, 1) * 100, text / whole,
        text / np.maximum(text[parent], 1), np.array([v.start for v in nodes]) / whole, rank, np.log1p(count), np.log1p(tags),
        [len(v.children) for v in nodes], paragraphs[parent],
    ], 1)
    mine = np.zeros((n, 4))  # least and greatest leaning of its attribute tokens, leaning of its tag, whether it has tokens
    for k, v in enumerate(nodes):
        known = [leanings.get(w, 0.0) for w in v.words]
        mine[k] = min(known, default=0.0), max(known, default=0.0), leanings.get(f"<{v.tag}>", 0.0), bool(known)
    low, high = np.zeros((n, 3)), np.zeros((n, 3))  # the same of the nodes above it
    for k in range(1, n):
        p = nodes[k].parent
        low[k], high[k] = np.minimum(low[p], mine[p, :3]), np.maximum(high[p], mine[p, :3])
    return np.concatenate([numeric, mine, low, high], 1).astype(np.float32)


def leanings_of(found: list[tuple[list[Node], list[int | None]]]) -> dict[str, float]:
    """How far each attribute token and tag leans to main text: smoothed log-odds over the labelled nodes that have it."""
    count: dict[str, list[float]] = {}
    for nodes, label in found:
        for v, y in zip(nodes, label):
            if y is not None:
                for w in {*v.words, f"<{v.tag}>"} - {HEART_WORD}:
                    count.setdefault(w, [0.5, 0.5])[y] += 1
    return {w: float(np.log(b / a)) for w, (a, b) in count.items()}


class Trees:
    """Gradient boosting with logistic loss over binned features; every tree splits all its leaves to one depth."""

    def fit(self, x: np.ndarray, y: np.ndarray) -> Trees:
        self.cuts = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) if len(np.unique(c)) > 2 else np.array([0.5]) for c in x.T]
        b = self.bin(x)
        n, d = b.shape
        flat = b + np.arange(d) * BINS
        self.start = float(np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3)))
        score = np.full(n, self.start)
        self.trees = []
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-score))
            g, h = p - y, p * (1 - p)
            leaf = np.zeros(n, np.int64)
            splits = []
            for level in range(DEPTH):
                where = (leaf[:, None] * (d * BINS) + flat).ravel()
                shape = (1 << level, d, BINS)
                gl = np.bincount(where, np.repeat(g, d), np.prod(shape)).reshape(shape).cumsum(2)
                hl = np.bincount(where, np.repeat(h, d), np.prod(shape)).reshape(shape).cumsum(2)
                gt, ht = gl[:, :, -1:], hl[:, :, -1:]
                gain = gl**2 / (hl + 1) + (gt - gl) ** 2 / (ht - hl + 1) - gt**2 / (ht + 1)
                best = gain.reshape(1 << level, -1).argmax(1)
                feature, cut = best // BINS, best % BINS
                splits.append((feature, cut))
                leaf = leaf * 2 + (b[np.arange(n), feature[leaf]] > cut[leaf])
            value = -RATE * np.bincount(leaf, g, 1 << DEPTH) / (np.bincount(leaf, h, 1 << DEPTH) + 1)
            self.trees.append((splits, value))
            score += value[leaf]
        return self

    def bin(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(c, v, "left") for c, v in zip(self.cuts, x.T)], 1)

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        b = self.bin(x)
        rows = np.arange(len(b))
        out = np.full(len(b), self.start)
        for splits, value in self.trees:
            leaf = np.zeros(len(b), np.int64)
            for feature, cut in splits:
                leaf = leaf * 2 + (b[rows, feature[leaf]] > cut[leaf])
            out += value[leaf]
        return out


ABOVE, IN, OUT = 0, 1, 2
HEART_WORD = "x-heart"
ALLOWED = {ABOVE: (ABOVE, IN, OUT), IN: (IN, OUT), OUT: (OUT,)}


def decode(nodes: list[Node], log_odds: np.ndarray) -> list[int]:
    """The likeliest state of every node. A node above counts like one that is out; text right inside it is not main text."""
    n = len(nodes)
    weight = np.array([1 + np.log1p(v.own) for v in nodes]) * np.array([v.own > 0 for v in nodes])
    best = np.stack([np.zeros(n), weight * log_odds, np.zeros(n)], 1)
    best[:, ABOVE] -= 1e-3
    for k in range(n - 1, 0, -1):
        p = nodes[k].parent
        if nodes[k].tag in CLOSED_TAGS:
            best[k, ABOVE] = best[k, IN] = -np.inf
        for state in (ABOVE, IN, OUT):
            best[p, state] += max(best[k, s] for s in ALLOWED[state])
    out = [ABOVE] * n
    for k in range(n):
        allowed = ALLOWED[out[nodes[k].parent]] if k else (ABOVE, IN, OUT)
        out[k] = max(allowed, key=lambda s: best[k, s])
    return out


def render(runs: list[tuple[int, str]], states: list[int]) -> str:
    blocks: list[str] = []
    now: list[str] = []
    last = -1
    for k, text in [*runs, (-2, "")]:
        if not text or k != last:
            if now and (joined := " ".join("".join(now).split())):
                blocks.append(joined)
            now = []
        if text and states[k] == IN:
            now.append(text)
        last = k
    return " ".join(blocks)


def extract(page: str, model: dict) -> str:
    nodes, runs = parse(page)
    if not any(v.own for v in nodes):
        return ""
    return render(runs, decode(nodes, model["trees"].log_odds(features(nodes, model["leanings"]))))


def marked(nodes: list[Node]) -> list[int | None] | None:
    """Labels by markup: 1 in the article, 0 in furniture or outside the article, None for what holds it; None without an article."""
    n = len(nodes)
    heart = [v.tag in ("article", "main") or "main" in v.words and v.tag != "body" or HEART_WORD in v.words for v in nodes]
    if not any(heart):
        return None
    holds = [False] * n
    for k in range(n - 1, 0, -1):
        if heart[k] or holds[k]:
            holds[nodes[k].parent] = True
    label: list[int | None] = [None] * n
    for k, v in enumerate(nodes):
        up = label[v.parent] if k else None
        away = v.tag in AWAY_TAGS or any(w in FURNITURE_SET for w in v.words)
        if up == 0 and not heart[k] or away:
            label[k] = 0
        elif heart[k] or up == 1:
            label[k] = 1
        else:
            label[k] = None if holds[k] else 0
    return label


FURNITURE_SET = set(FURNITURE)


def changed(page: str, rng: random.Random) -> tuple[str, bool]:
    """The page with furniture put in, and whether its article markers are plain blocks now."""
    words = [w for w in re.sub(r"<[^>]*>", " ", page).split() if "<" not in w and ">" not in w and "{" not in w][:4000] or ["word"]
    some = lambda a, b: html.escape(" ".join(rng.choice(words) for _ in range(rng.randint(a, b))), quote=False)

    def furniture() -> str:
        name = rng.choice(FURNITURE)
        if rng.random() < 0.4:
            name = f"{name}-{rng.choice([rng.choice(NEUTRAL), rng.choice(FURNITURE)])}"
        where = rng.choice(["class", "class", "id"])
        tag = rng.choice(["div", "div", "div", "section", "aside", "ul", "p", "header", "footer", "form", "nav"])
        kind = rng.random()
        if kind < 0.35:
            body = "".join(f"<{x}><a href=x>{some(1, 6)}</a></{x}>" for x in [rng.choice(["li", "p", "div"])] * rng.randint(1, 8))
        elif kind < 0.75:
            body = "".join(f"<p>{some(3, 60)}.</p>" for _ in range(rng.randint(1, 5)))
        else:
            body = some(2, 25)
        if tag == "p":
            body = some(2, 40)
        plain = tag in ("aside", "nav", "form") and rng.random() < 0.5
        return f"<{tag}>{body}</{tag}>" if plain else f'<{tag} {where}="{name}">{body}</{tag}>'

    short, few = rng.random() < 0.5, rng.random() < 0.4
    left = rng.randint(1, 6)

    def shape(m: re.Match) -> str:
        """Short paragraphs, fewer of them, and the other blocks that articles have."""
        nonlocal left
        words_here = m[1].split()
        if few and (left := left - 1) < 0:
            return ""
        body = " ".join(words_here[: rng.randint(3, 30)]) if short else m[1]
        kind = rng.random()
        if kind < 0.06:
            return f"<h{2 + (kind < 0.03)}>{' '.join(words_here[:5])}</h{2 + (kind < 0.03)}><p>{body}</p>"
        if kind < 0.12:
            return f"<p>{body}</p><ul>" + "".join(f"<li>{some(2, 12)}</li>" for _ in range(rng.randint(2, 5))) + "</ul>"
        if kind < 0.16:
            return f"<blockquote><p>{body}</p></blockquote>"
        return f"<div>{body}</div>" if kind < 0.19 else f"<p>{body}</p>"

    page = re.sub(r"<p>([^<]+)</p>", shape, page)

    def spread(m: re.Match) -> str:
        return m[0] + (furniture() if rng.random() < 0.04 else "")

    page = re.sub(r"</p>(?=\s*<p\b)", spread, page)
    page = re.sub(r"(<article\b[^>]*>|<main\b[^>]*>)", lambda m: "".join(furniture() for _ in range(rng.randint(0, 3))) + m[0] + (furniture() if rng.random() < 0.2 else ""), page)
    page = re.sub(r"</(?:article|main)\s*>", lambda m: (furniture() if rng.random() < 0.5 else "") + m[0] + "".join(furniture() for _ in range(rng.randint(0, 3))), page)
    if rng.random() < 0.6:
        tag = rng.choice(["div", "div", "section", "main"])
        name = rng.choice(["", "", f' class="{rng.choice(CONTENT)}-{rng.choice(CONTENT + NEUTRAL)}"', f' class="{rng.choice(NEUTRAL)}"', f' id="{rng.choice(CONTENT)}"', f' class="{rng.choice(CONTENT)}"'])
        page = re.sub(r"<(?:article|main)\b[^>]*>", f'<{tag}{name} data-x-heart="1">', page)
        page = re.sub(r"</(?:article|main)\s*>", f"</{tag}>", page)
    head = rng.choice([f"<header>{some(1, 4)}</header>", f"<header><a href=x>{some(1, 3)}</a><p>{some(2, 9)}</p></header>", f'<div class="header">{some(1, 6)}</div>', ""])
    page = re.sub(r"<body\b[^>]*>", lambda m: m[0] + head + "".join(furniture() for _ in range(rng.randint(0, 2))), page, count=1)
    for _ in range(rng.choice([0, 0, 1, 2])):  # a holder around the article and some of what stands by it
        page = re.sub(r"(<(?:article|main)\b[^>]*>|<(?:div|section)[^>]*data-x-heart=\"1\">)(.*)(?=<footer|</body>)", lambda m: f'<div class="{rng.choice(NEUTRAL)}">{furniture() if rng.random() < 0.3 else ""}{m[0]}{furniture() if rng.random() < 0.5 else ""}</div>', page, count=1, flags=re.S)
    return page, "data-x-heart" in page


HEART = re.compile(r'<(?:div|section|main)[^>]*data-x-heart="1">')


def examples(page: str, rng: random.Random) -> list[tuple[list[Node], list[int | None]]]:
    out = []
    for form in range(FORMS + 1):
        text, plain = changed(page, rng) if form else (page, False)
        # The mark of a plain heart is a word that no vocabulary holds.
        text = HEART.sub(lambda m: re.sub(r' data-x-heart="1"', "", m[0]).replace(">", ' role="xheart">'), text)
        nodes, _ = parse(text)
        for v in nodes:
            if "xheart" in v.words:
                v.words = tuple(w for w in v.words if w != "xheart") + (HEART_WORD,)
        if (label := marked(nodes)) is not None:
            out.append((nodes, label))
    return out


def fit(pages: DataFrame, sample_pages: int = SAMPLE_PAGES, sample_bytes: int = SAMPLE_BYTES) -> dict:
    """At most ``sample_pages`` pages of at most ``sample_bytes`` bytes reach the driver."""
    fine = (F.octet_length("html") <= sample_bytes) & F.col("html").rlike("(?i)<(article|main)\\b|role=.?main")
    ids = pages.where(fine).select(F.col("page_id").cast("long").alias("page_id"), F.xxhash64("html").alias("mark")).orderBy(F.xxhash64("page_id", "mark"), "page_id", "mark").limit(sample_pages)
    got = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("html").cast("string").alias("html"), F.xxhash64("html").alias("mark")).join(F.broadcast(ids.distinct()), ["page_id", "mark"]).limit(sample_pages).collect()
    rng = random.Random(11)
    found = [e for r in sorted(got, key=lambda r: (r.page_id, r.html)) for e in examples(r.html, rng)]
    if not found:
        found = [e for _ in range(20) for e in examples(SEED_PAGE, rng)]
    leanings = leanings_of(found)
    x = np.concatenate([features(nodes, leanings) for nodes, _ in found])
    y = np.array([-1 if v is None else v for _, label in found for v in label])
    return {"leanings": leanings, "trees": Trees().fit(x[y >= 0], y[y >= 0].astype(float))}


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every row."""
    model = pages.sparkSession.sparkContext.broadcast(fit(pages))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("text"))

    def run(batches):
        for batch, texts in chunks(batches):
            found = [parse(t.decode("utf-8")) for t in texts]
            x = np.concatenate([features(nodes, model.value["leanings"]) for nodes, _ in found])
            odds = np.split(model.value["trees"].log_odds(x), np.cumsum([len(nodes) for nodes, _ in found])[:-1])
            out = [render(runs, decode(nodes, o)) for (nodes, runs), o in zip(found, odds)]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(out, pa.string()), pa.array([len(t) for t in out], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return map_arrow(rows, run, "page_id long, url string, text string, n_chars long")
