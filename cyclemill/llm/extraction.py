"""Main text of web pages by a recurrent labeller of blocks.

A page is read as its sequence of leaf blocks. Each block gives a vector: hashed
embeddings of its tag path (tags, classes, ids, neighbouring pairs), of its words, and
its length and share of links. A bidirectional LSTM in NumPy reads the sequence, so
each block is labelled in the context of the whole page; blocks labelled as main text
are joined in page order.

There are no labelled pages, so the training sequences are made from a bounded sample
of the pages: their blocks are told apart by plain signs of the markup (an article is
content; menus, footers and the like are not), and dealt out again under many other
tag paths that pages use for the same parts, with parts added that the sample lacks.
"""

from __future__ import annotations

import html
import re
import zlib

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cyclemill.llm.common import column, segments

TAG_BITS, WORD_BITS = 11, 11
TAG_DIM, WORD_DIM, HIDDEN = 16, 8, 16
NUMBERS = 4
MAX_PAGES = 400
GROUP = 256
KIND = "text string, blocks int, kept int"

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title svg math iframe object canvas select datalist".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr img input".split()
)
CLOSES_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr "
    "main menu nav ol p pre section table ul".split()
)
SAME = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
        "option": ("option",)}
SCOPE = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table"),
         "option": ("select",)}
TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?>\"[^\"]*+\"|'[^']*+'|[^'\">])*+)>|<[/!?a-zA-Z][^>]*+>", re.S
)
ATTRIBUTE = re.compile(r"(class|id|role|hidden|style|aria-label|itemprop)\s*+(?:=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'>]++)))?", re.I)
NAME = re.compile(r"[A-Za-z][a-z]*|[A-Z]+")
SPACE = re.compile(r"\s+")

# plain signs of parts that are not main text, and of main text, in class and id names
OTHER = frozenset(
    "nav navbar navigation menu header masthead footer sidebar aside widget ad ads advert adverts advertisement banner "
    "sponsor sponsored promo cookie cookies consent notice notices alert popup modal overlay comment comments reply "
    "replies respond disqus discussion form search login signup subscribe newsletter share sharing social breadcrumb "
    "breadcrumbs pagination pager related recommended toolbar copyright legal disclaimer gdpr".split()
)
MAIN = frozenset("article content main post entry story body text".split())
OTHER_TAGS = frozenset("nav header footer aside form button dialog menu".split())

# tag paths under which pages keep their parts, by part
PATHS = {
    "main": ("article", "main>article", "main", "div.content", "div#content", "div.post>div.entry-content", "div.article-body",
             "div.story>section", "section.post-content", "div#main>div.text", "main>div.article>section", "div.container>article",
             "div.page>div.main-content", "article>section", "article>div.body", "div.wrapper>article.post", "article>div", "div>article", "", "", "div"),
    "menu": ("nav>ul>li>a", "nav>a", "div.menu>ul>li>a", "div.navbar>a", "ul.navigation>li>a", "header>nav>ul>li>a", "div#nav>a",
             "div.breadcrumb>a", "nav.pagination>a", "menu>li>a", "div.toolbar>a", "nav>ol>li>a", "article>nav>a", "nav>ul>li"),
    "header": ("header>div", "header>p", "div.header>p", "div#masthead>div", "div.site-header>span", "header>h1>a", "div.banner>p",
               "header>h2", "div.top-header>h2", "header.site>p", "header>h1", "header>h1", "header>div>h1"),
    "footer": ("footer", "footer>p", "div.footer>p", "div#footer>div", "footer>div.copyright", "div.site-footer>ul>li", "div.legal>p",
               "footer>ul>li>a", "article>footer>p", "footer>section>p"),
    "side": ("aside", "aside>p", "div.sidebar>p", "div#sidebar>ul>li>a", "aside>div.widget>p", "div.related>ul>li", "aside>h3",
             "div.recommended>div>p", "div.sidebar>h3", "aside>ul>li", "article>aside>p", "section.related-posts>p"),
    "advert": ("div.ad", "div.ads>p", "div.advert>p", "div.advertisement", "aside.sponsored>p", "div#ad-top", "div.promo>p",
               "section.banner-ad>p", "div.sponsor>a", "article>div.ad", "article>div.advert>p", "p.ad", "span.ad-label", "ins.ads"),
    "notice": ("div.cookie-notice>p", "div#cookie-banner>p", "div.consent>p", "div.notice", "div.gdpr>p", "div.alert>p",
               "dialog>p", "div.popup>p", "div.modal>div>p", "div.newsletter>p", "section.subscribe>p", "div.disclaimer>p", "p.notice"),
    "form": ("form>label", "form>p", "form>div>label", "form.search>button", "div.login>form>p", "form>fieldset>legend", "button",
             "form.comment-form>p", "article>form>p", "div.signup>form>label", "form>button", "form"),
    "comments": ("section.comments>p", "div.comments>div.comment>p", "div#comments>ul>li>p", "ol.comment-list>li>div>p",
                 "div#disqus>p", "section#respond>h3", "div.comment>p", "article>section.comments>p", "article>div#comments>div>p",
                 "section.comments>article>p", "div.comments>article.comment>p", "div.replies>p", "section.discussion>p", "section.comments>h2"),
    "share": ("div.share>a", "ul.social>li>a", "div.social-share>span", "article>div.share>a", "p.share"),
}
LEAVES = ("p", "p", "p", "p", "h1", "h2", "h3", "ul>li", "ul>li", "ul>li", "ol>li", "ol>li", "blockquote>p", "pre", "table>tr>td", "div>p", "section>p",
          "figure>figcaption", "div", "p>b", "dl>dd", "p>a", "header>h1", "h4")
OTHER_LEAVES = ("p", "h2", "h3", "h4", "ul>li", "li", "div", "span", "a", "div>p", "strong", "ol>li")


class Block:
    __slots__ = ("path", "text", "linked")

    def __init__(self, path, text, linked):
        self.path, self.text, self.linked = path, text, linked


def names(attributes: str) -> list[str]:
    """Marks of an element: words of its class, id, role and label, and whether it is hidden."""
    marks = []
    for m in ATTRIBUTE.finditer(attributes):
        key, value = m.group(1).lower(), m.group(2) or m.group(3) or m.group(4) or ""
        if key == "hidden" or (key == "style" and "none" in value and "display" in value):
            marks.append("hidden")
        elif key != "style":
            marks += [w.lower() for w in NAME.findall(value)]
    return marks


DEPTH = 512  # of the elements that a path names


class Open:
    """The elements open at a place of a page: the outer ones with their marks, those nested deeper by their tags."""

    def __init__(self):
        self.stack: list[tuple[str, tuple]] = []
        self.deeper: list[str] = []
        self.n: dict[str, int] = {}

    def add(self, tag: str, marks: tuple) -> None:
        self.n[tag] = self.n.get(tag, 0) + 1
        if len(self.stack) < DEPTH:
            self.stack.append((tag, marks))
        else:
            self.deeper.append(tag)

    def close(self, tags, stop) -> None:
        """Close the innermost element of one of the tags and all within it, unless one that ``stop`` names lies between."""
        if not any(self.n.get(t) for t in tags):
            return
        for k in range(len(self.stack) + len(self.deeper) - 1, -1, -1):
            tag = self.stack[k][0] if k < len(self.stack) else self.deeper[k - len(self.stack)]
            if tag in tags:
                for t in [*(x for x, _ in self.stack[k:]), *self.deeper[max(0, k - len(self.stack)):]]:
                    self.n[t] -= 1
                del self.deeper[max(0, k - len(self.stack)):]
                del self.stack[k:]
                return
            if stop(tag):
                return


def leaf_blocks(page: str) -> list[Block]:
    """Text of the leaf blocks of a page in order, with the tag path of each; references decoded, white space as one space."""
    blocks: list[Block] = []
    open_ = Open()
    stack = open_.stack
    words: list[str] = []
    linked = 0
    path_now: tuple = ()

    def end():
        nonlocal words, linked
        if words:
            text = SPACE.sub(" ", "".join(words)).strip()
            if text:
                blocks.append(Block(path_now, text, min(1.0, linked / len(text))))
            words, linked = [], 0

    def add(raw: str):
        nonlocal linked, path_now
        if raw:
            text = html.unescape(raw) if "&" in raw else raw
            if not words:
                if text.isspace():
                    return
                path_now = tuple(stack)
            words.append(text)
            if any(t == "a" for t, _ in stack[-4:]):
                linked += len(text)

    at, last = 0, page.rfind(">") + 1
    while True:
        m = TAG.search(page, at, last) if at < last else None
        if m is None:
            add(page[at:])
            break
        add(page[at:m.start()])
        at = m.end()
        tag = m.group(2)
        if tag is None:
            continue
        tag = tag.lower()
        if m.group(1):  # a closing tag
            if tag not in INLINE:
                end()
            open_.close((tag,), lambda t: tag in INLINE and t not in INLINE)
            continue
        if tag in RAW and not m.group(3).endswith("/"):
            # no closing tag ends after the last bracket, which is what a search without one would run to
            close = re.compile(rf"</{re.escape(tag)}\b[^>]*+>", re.I).search(page, at, last)
            at = close.end() if close else len(page)
            if tag == "title" or tag in ("svg", "math") and words:
                continue
            if tag not in INLINE:
                words.append(" ") if words else None
            continue
        if tag == "br":
            words.append(" ") if words else None
            continue
        if tag in INLINE and tag in VOID:
            continue
        if tag not in INLINE:
            end()
        if tag in VOID:
            continue
        if tag in CLOSES_P:
            open_.close(("p",), lambda t: t not in INLINE)
        elif tag in SAME:
            open_.close(SAME[tag], lambda t: t in SCOPE[tag])
        if not m.group(3).endswith("/"):
            open_.add(tag, tuple(names(m.group(3))) if m.group(3) else ())
    end()
    return blocks


def hashed(text: str, bits: int) -> int:
    return zlib.crc32(text.encode()) & ((1 << bits) - 1)


def path_marks(path) -> list[str]:
    """What is said of a tag path: its tags, their marks, and tag pairs near the leaf."""
    marks = []
    for tag, own in path:
        if tag in ("html", "body"):
            continue
        marks.append(f"<{tag}")
        marks += [f".{w}" for w in own]
    near = [tag for tag, _ in path[-3:]]
    marks += [f"{a}>{b}" for a, b in zip(near, near[1:])]
    if near:
        marks.append(f"${near[-1]}")
    return marks


def features(blocks: list[Block], cache: dict) -> tuple[list[list[int]], list[list[int]], np.ndarray]:
    """Hashed path marks and words of every block, and its numbers."""
    paths, words = [], []
    numbers = np.zeros((len(blocks), NUMBERS), dtype=np.float32)
    for i, b in enumerate(blocks):
        keys = cache.get(b.path)
        if keys is None:
            if len(cache) > 20000:
                cache.clear()
            keys = cache[b.path] = sorted({hashed(m, TAG_BITS) for m in path_marks(b.path)}) or [0]
        paths.append(keys)
        words.append([hashed(w.lower(), WORD_BITS) for w in b.text.split(" ")])
        numbers[i] = (min(np.log1p(len(b.text)) / 8, 2), b.linked, i / len(blocks), b.text[-1] in ".!?…\"”")
    return paths, words, numbers


def bag(table: np.ndarray, keys: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Sum of the embeddings of each list of keys, and the lists' sizes."""
    sizes = np.array([len(k) for k in keys])
    flat = np.fromiter((x for k in keys for x in k), dtype=np.int64, count=int(sizes.sum()))
    return np.add.reduceat(table[flat], segments(sizes)[:-1], axis=0), sizes[:, None].astype(np.float32)


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class Labeller:
    """Embeddings, one LSTM in each direction, and a logistic layer over both states."""

    def __init__(self, seed: int = 5):
        rng = np.random.default_rng(seed)
        size = TAG_DIM + WORD_DIM + NUMBERS
        self.p = {
            "tags": rng.normal(0, 0.1, (1 << TAG_BITS, TAG_DIM)), "words": rng.normal(0, 0.1, (1 << WORD_BITS, WORD_DIM)),
            "out": rng.normal(0, 0.2, 2 * HIDDEN + TAG_DIM), "bias": np.zeros(1),
        }
        for way in ("f", "b"):
            self.p[f"x{way}"] = rng.normal(0, 0.2, (size, 4 * HIDDEN))
            self.p[f"h{way}"] = rng.normal(0, 0.2, (HIDDEN, 4 * HIDDEN))
            self.p[f"c{way}"] = np.concatenate((np.ones(HIDDEN), np.zeros(3 * HIDDEN)))
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}

    def inputs(self, paths, words, numbers):
        """Vectors of blocks: a path's embeddings are summed, so that one telling mark counts in any path; words averaged."""
        tags, _ = bag(self.p["tags"], paths)
        mean, sizes = bag(self.p["words"], words)
        return np.concatenate((tags, mean / sizes, numbers), axis=1), tags

    def run(self, x, lengths, way, keep):
        """States of one direction over padded sequences (time, page, size), with what the backward pass needs."""
        w, u, c = self.p[f"x{way}"], self.p[f"h{way}"], self.p[f"c{way}"]
        steps, pages = x.shape[:2]
        inner = x.reshape(-1, x.shape[2]) @ w + c
        inner = inner.reshape(steps, pages, -1)
        h, s = np.zeros((pages, HIDDEN), np.float32), np.zeros((pages, HIDDEN), np.float32)
        states, tape = np.zeros((steps, pages, HIDDEN), np.float32), []
        for t in range(steps) if way == "f" else range(steps - 1, -1, -1):
            z = inner[t] + h @ u
            f, i, o = (sigmoid(z[:, k * HIDDEN:(k + 1) * HIDDEN]) for k in range(3))
            g = np.tanh(z[:, 3 * HIDDEN:])
            live = (t < lengths)[:, None]
            new = f * s + i * g
            th = np.tanh(new)
            if keep:
                tape.append((t, h, s, f, i, o, g, th, live))
            s = np.where(live, new, 0)
            h = np.where(live, o * th, 0)
            states[t] = h
        return states, tape

    def back(self, x, way, tape, ds, grad):
        """Adds the gradients of one direction; returns that of its inputs."""
        w, u = self.p[f"x{way}"], self.p[f"h{way}"]
        dx = np.zeros_like(x)
        dh, dc = np.zeros_like(tape[0][1]), np.zeros_like(tape[0][1])
        for t, h, s, f, i, o, g, th, live in reversed(tape):
            down = np.where(live, ds[t] + dh, 0)
            dcell = np.where(live, dc + down * o * (1 - th * th), 0)
            dz = np.concatenate((
                dcell * s * f * (1 - f), dcell * g * i * (1 - i), down * th * o * (1 - o), dcell * i * (1 - g * g)), axis=1)
            grad[f"x{way}"] += x[t].T @ dz
            grad[f"h{way}"] += h.T @ dz
            grad[f"c{way}"] += dz.sum(axis=0)
            dx[t] = dz @ w.T
            dh, dc = dz @ u.T, dcell * f
        return dx

    def forward(self, paths, words, numbers, sizes, keep=False):
        """Logit of every block of the pages, which have so many blocks each."""
        flat, tags = self.inputs(paths, words, numbers)
        steps, pages = int(sizes.max()), len(sizes)
        page = np.repeat(np.arange(pages), sizes)
        step = np.arange(len(page)) - np.repeat(segments(sizes)[:-1], sizes)
        x = np.zeros((steps, pages, flat.shape[1]), np.float32)
        x[step, page] = flat
        fs, ft = self.run(x, sizes, "f", keep)
        bs, bt = self.run(x, sizes, "b", keep)
        seen = np.concatenate((fs[step, page], bs[step, page], tags), axis=1)
        return seen @ self.p["out"] + self.p["bias"][0], (x, step, page, seen, ft, bt)

    def gradients(self, paths, words, numbers, sizes, labels):
        logit, (x, step, page, seen, ft, bt) = self.forward(paths, words, numbers, sizes, keep=True)
        grad = {k: np.zeros_like(v) for k, v in self.p.items()}
        d = ((sigmoid(logit) - labels) / len(labels)).astype(np.float32)
        grad["out"], grad["bias"] = seen.T @ d, np.array([d.sum()], np.float32)
        ds = d[:, None] * self.p["out"][None, :]
        wide = np.zeros((*x.shape[:2], 2 * HIDDEN), np.float32)
        wide[step, page] = ds[:, :2 * HIDDEN]
        dx = self.back(x, "f", ft, wide[:, :, :HIDDEN], grad) + self.back(x, "b", bt, wide[:, :, HIDDEN:], grad)
        dflat = dx[step, page]
        dflat[:, :TAG_DIM] += ds[:, 2 * HIDDEN:]
        for name, keys, part in (("tags", paths, dflat[:, :TAG_DIM]), ("words", words, dflat[:, TAG_DIM:TAG_DIM + WORD_DIM])):
            count = np.array([len(k) for k in keys])
            flat = np.fromiter((v for k in keys for v in k), dtype=np.int64, count=int(count.sum()))
            share = part / count[:, None].astype(np.float32) if name == "words" else part
            np.add.at(grad[name], flat, np.repeat(share, count, axis=0))
        return grad, float(np.logaddexp(0, np.where(labels == 1, -logit, logit)).mean())


def part_of(block: Block) -> str:
    """Which part of a page a block is by the plain signs of its markup."""
    tags = {t for t, _ in block.path}
    marks = {w for _, own in block.path for w in own}
    inner = {w for t, own in block.path if t not in ("html", "body") for w in own}
    if tags & OTHER_TAGS or inner & OTHER or "hidden" in marks:
        return "other"
    return "main" if tags & {"article", "main"} or inner & MAIN else "unknown"


def path_from(text: str, base=(("html", ()), ("body", ()))) -> tuple:
    """A path from a short form like ``div.menu>ul>li``."""
    made = list(base)
    for step in filter(None, text.split(">")):
        tag, *marks = re.split(r"[.#]", step)
        made.append((tag, tuple(w.lower() for m in marks for w in NAME.findall(m))))
    return tuple(made)


def dealt_page(page: list[Block], pool: list[Block], rng) -> tuple[list[Block], list[int]]:
    """A training page: the blocks of a real one's main text under a likely path, among other parts."""
    main = [b for b in page if part_of(b) == "main"]
    if not main:
        main = [pool[k] for k in rng.integers(len(pool), size=rng.integers(1, 12))]
    if rng.random() < 0.3:
        main = main[:rng.integers(1, len(main) + 1)]
    blocks, labels = [], []

    frame = PATHS["main"][rng.integers(len(PATHS["main"]))]

    def part(kind, n, inside=False):
        where = PATHS[kind][rng.integers(len(PATHS[kind]))]
        if inside:  # within the main text's own element
            where = f"{frame}>{where}"
        long_, varied = rng.random() < 0.4, rng.random() < 0.4
        for _ in range(n):
            if varied:
                where = where.rsplit(">", 1)[0] if where.count(">") > 1 + inside * frame.count(">") and rng.random() < 0.3 else where
                where = f"{where}>{OTHER_LEAVES[rng.integers(len(OTHER_LEAVES))]}" if where.count(">") < 6 else where
            source = pool[rng.integers(len(pool))].text
            words = source.split(" ")
            size = rng.integers(1, len(words) + 1) if long_ else rng.integers(1, min(14, len(words)) + 1)
            path = path_from(where)
            blocks.append(Block(path, " ".join(words[:size]) or source, float("a" == path[-1][0])))
            labels.append(0)

    def some(kinds, chance, most):
        for kind in kinds:
            if rng.random() < chance:
                part(kind, int(rng.integers(1, most + 1)))

    around = rng.random() > 0.06  # some pages have nothing but their text
    some(("notice", "header", "menu"), 0.5 * around, 6)
    some(("advert", "form", "side", "share"), 0.25 * around, 3)
    as_is = rng.random() < 0.25
    for k, b in enumerate(main):
        if k and rng.random() < 0.06:
            part(str(rng.choice(["advert", "notice", "side", "form", "share"])), int(rng.integers(1, 3)), not as_is)
        leaf = "h1" if k == 0 and rng.random() < 0.6 else LEAVES[rng.integers(len(LEAVES))]
        if leaf == "header>h1" and "article" not in frame:
            leaf = "h1"
        path = b.path if as_is else path_from(f"{frame}>{leaf}")
        blocks.append(Block(path, b.text, float(path[-1:] != () and path[-1][0] == "a")))
        labels.append(1)
    if rng.random() < 0.4 * around:
        part(str(rng.choice(["share", "comments", "form", "advert", "side"])), int(rng.integers(1, 6)), not as_is)
    some(("share", "comments", "form", "side", "advert"), 0.3 * around, 5)
    some(("menu", "notice", "footer"), 0.5 * around, 5)
    return blocks, labels


def fit(pages: list[str], steps: int = 900, batch: int = 12, rate: float = 0.01, seed: int = 3) -> Labeller:
    """Train on dealt pages with Adam; the sample's own pages stand among them as they are."""
    rng = np.random.default_rng(seed)
    read = [b for b in (leaf_blocks(p or "") for p in pages) if b]
    if not read:
        read = [[Block(path_from("article>p"), "an article of a few words.", 0.0)]]
    pool = [b for page in read for b in page]
    model = Labeller()
    moment = {k: np.zeros_like(v) for k, v in model.p.items()}
    spread = {k: np.zeros_like(v) for k, v in model.p.items()}
    cache: dict = {}
    for t in range(1, steps + 1):
        paths, words, numbers, sizes, labels = [], [], [], [], []
        for _ in range(batch):
            page = read[rng.integers(len(read))]
            own = [part_of(b) for b in page]
            if rng.random() < 0.25 and "unknown" not in own:
                blocks, label = page, [int(k == "main") for k in own]
            else:
                blocks, label = dealt_page(page[:40], pool, rng)
            blocks, label = blocks[:120], label[:120]
            a, b, c = features(blocks, cache)
            paths += a
            words += b
            numbers.append(c)
            sizes.append(len(blocks))
            labels += label
        grad, _ = model.gradients(paths, words, np.concatenate(numbers), np.array(sizes), np.array(labels, np.float32))
        step = rate * min(1.0, 2 * (1 - t / (steps + 1)))
        for k, g in grad.items():
            moment[k] += 0.1 * (g - moment[k])
            spread[k] += 0.01 * (g * g - spread[k])
            model.p[k] -= step * (moment[k] / (1 - 0.9**t)) / (np.sqrt(spread[k] / (1 - 0.99**t)) + 1e-6)
    return model


def train(pages: DataFrame, max_pages: int = MAX_PAGES) -> Labeller:
    """Fit on about ``max_pages`` pages (twice as many at most) of the column html, by a hash of url and page."""
    n = pages.select("url").count()
    share = int((1 << 30) * min(1.0, max_pages / max(n, 1)))
    key = F.xxhash64(F.col("url").cast("string"), F.col("html"), F.lit(23))
    rows = pages.filter(F.pmod(key, F.lit(1 << 30)) < share).select("html", key.alias("key")).limit(2 * max_pages).collect()
    return fit([r["html"] for r in sorted(rows, key=lambda r: (r["key"], r["html"] or ""))])


def label_pages(model: Labeller, pages: list[str], cache: dict) -> list[tuple[str, int, int]]:
    """Main text of every page, its number of blocks and of those kept; pages of like length run together."""
    read = [leaf_blocks(p) for p in pages]
    result: list = [("", 0, 0)] * len(pages)
    order = sorted((k for k in range(len(pages)) if read[k]), key=lambda k: len(read[k]))
    at = 0
    while at < len(order):
        group, total = [], 0
        while at < len(order) and len(group) < GROUP and (not group or (len(group) + 1) * len(read[order[at]]) <= 1 << 15):
            group.append(order[at])
            at += 1
        made = [features(read[k], cache) for k in group]
        sizes = np.array([len(read[k]) for k in group])
        logit, _ = model.forward(
            [x for m in made for x in m[0]], [x for m in made for x in m[1]], np.concatenate([m[2] for m in made]), sizes)
        ends = segments(sizes)
        for g, k in enumerate(group):
            kept = [b.text for b, z in zip(read[k], logit[ends[g]:ends[g + 1]]) if z > 0]
            result[k] = (" ".join(kept), len(read[k]), len(kept))
    return result


def main_text(model: Labeller, page: str = "html") -> Column:
    """Struct of the main text of a whole page, its blocks and those kept; null and empty pages have none."""

    def kernel():
        cache: dict = {}
        return lambda pages: label_pages(model, [p.decode() for p in pages], cache)

    return column(kernel, KIND, page)
