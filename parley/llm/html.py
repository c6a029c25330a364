"""Main text of web pages by gradient-boosted trees over the nodes of the DOM.

A page becomes a tree of its block elements with the text runs between them; a run directly under the page is
a node of its own.  Every node has features of
its subtree (text density, link share, counts), attribute tokens, depth and siblings; boosted trees give
the chance that it holds main text.  The most likely labelling of the whole tree is taken in which no
node is main below one that is not, so ancestors and descendants never contradict each other.

The trees are trained on a bounded sample of pages.  The paragraphs of each sampled page are laid out
anew, as an article between menus, notices, adverts, forms, lists and comments of several designs, so the
label of every node is known and the model does not hang on one site's markup.
"""

from __future__ import annotations

import html as entities
import random
import re
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.llm.tables import map_rows

# Element names of the HTML standard by the role they play here.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style noscript template iframe object textarea title svg math canvas audio video head".split())
# Their end may be missing only by mistake, so without one they swallow nothing but their own tag.
HOLDER = RAW - set("script style textarea head".split())
FOREIGN = {"svg", "math"}  # "/>" ends them
INLINE = set(
    "a abbr acronym b bdi bdo big br cite code data del dfn em embed font i img ins kbd label link mark meta nobr q rp rt ruby s "
    "samp small span strike strong sub sup time tt u var wbr".split()
)
CLOSES_P = set(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
    "hgroup hr main menu nav ol p pre search section table ul".split()
)
SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPE = set("html body table td th ul ol dl div article section main aside nav footer header form blockquote figure fieldset button".split())

GROUPS = {
    "para": set("p blockquote pre dd dt figcaption".split()),
    "head": set("h1 h2 h3 h4 h5 h6".split()),
    "list": set("ul ol li menu dl".split()),
    "table": set("table tbody thead tfoot tr td th caption".split()),
    "main": set("article main".split()),
    "edge": set("nav footer header aside dialog address search".split()),
    "form": set("form button select option fieldset input legend datalist output".split()),
}
GOOD = "article articlebody body blog content entry main maincontent page post posting prose read story text".split()
BAD = (
    "ad ads advert advertisement adverts author banner bar breadcrumb breadcrumbs byline comment comments complementary consent contact "
    "cookie cookies copyright dialog disclaimer disqus feedback footer form header login masthead menu meta modal nav navbar navigation "
    "newsletter note notice overlay pagination pager popup privacy promo promoted promotion recommended related replies reply respond "
    "reviews search share sharing sidebar signup skip social sponsor sponsored subscribe tags teaser toolbar tracking warning widget widgets"
).split()
_GOOD, _BAD = set(GOOD), set(BAD)

MARKUP = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
LOOSE = re.compile(r"<(/?)([A-Za-z][^\s/>]*)([^>]*)>", re.S)
HOLDERS = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(script|style|textarea)(?=[\s/>]).*?(?:</\1\s*>|\Z)|<(/?)({'|'.join(sorted(HOLDER))})(?=[\s/>])((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S | re.I
)
ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role|itemprop|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
HIDDEN = re.compile(r"(?:^|\s)hidden(?:[\s=]|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)
CLOSED = re.compile(r"(?:^|[\s\"'])/\Z")
PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

FEATURES = (
    "depth own_chars chars nodes density link_share links paragraphs mean_run runs stops words_per_stop place siblings sibling_chars_share "
    "page_chars_share children good bad good_above bad_above hidden has_heading para head list table main edge form in_edge in_form in_main_tag list_share"
).split()


@dataclass
class Tree:
    """Block elements in page order; node 0 is the page.  ``runs`` are texts in page order with the node they stand in."""

    tag: list[str] = field(default_factory=lambda: ["html"])
    parent: list[int] = field(default_factory=lambda: [-1])
    words: list[tuple[str, ...]] = field(default_factory=lambda: [()])
    hidden: list[bool] = field(default_factory=lambda: [False])
    links: list[int] = field(default_factory=lambda: [0])
    link_chars: list[int] = field(default_factory=lambda: [0])
    runs: list[tuple[int, str]] = field(default_factory=list)


def _held(source: str) -> dict[int, int]:
    """Where each holder element that has an end tag of its own ends, by the end of its start tag."""
    ends: dict[int, int] = {}
    open_: dict[str, list[int]] = {name: [] for name in HOLDER}
    for found in HOLDERS.finditer(source):
        if found.group(3):
            name = found.group(3).lower()
            if not found.group(2) and not (name in FOREIGN and found.group(4).endswith("/")):
                open_[name].append(found.end())
            elif found.group(2) and open_[name]:
                ends[open_[name].pop()] = found.end()
    return ends


def parse(source: str) -> Tree:
    """Read a page, however broken; nothing is raised for any text."""
    tree = Tree()
    stack: list[tuple[str, int]] = [("html", 0)]  # open elements; an inline one has its block's node
    anchors = 0
    breaks = 0
    pending: list[str] = []
    held: dict[int, int] | None = None

    def add(tag: str, parent: int, words: tuple[str, ...], hidden: bool) -> int:
        tree.tag.append(tag)
        tree.parent.append(parent)
        tree.words.append(words)
        tree.hidden.append(hidden)
        tree.links.append(0)
        tree.link_chars.append(0)
        return len(tree.tag) - 1

    def flush() -> None:
        text = " ".join(entities.unescape("".join(pending)).split())
        pending.clear()
        if not text:
            return
        node = stack[-1][1]
        if not node:
            # A run directly under the page: a node of its own, with the links in it.
            node = add("", 0, (), False)
            for counts in (tree.links, tree.link_chars):
                counts[0], counts[node] = 0, counts[0]
        tree.runs.append((node, text))

    def close(depth: int) -> None:
        nonlocal anchors
        if any(tag not in INLINE for tag, _ in stack[depth:]):
            flush()
        anchors -= sum(tag == "a" for tag, _ in stack[depth:])
        del stack[depth:]

    def text(piece: str) -> None:
        nonlocal breaks
        pending.append(piece)
        if not piece.isspace():
            breaks = 0
        if anchors:
            tree.link_chars[stack[-1][1]] += len(piece)

    at, size = 0, len(source)
    while at < size:
        begin = source.find("<", at)
        if begin < 0:
            text(source[at:])
            break
        if begin > at:
            text(source[at:begin])
        found = MARKUP.match(source, begin) or LOOSE.match(source, begin)
        if not found:
            text("<")
            at = begin + 1
            continue
        at = found.end()
        name = found.group(2)
        if name is None:
            continue
        name = name.lower()
        if found.group(1):
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] == name:
                    close(depth)
                    break
                if name in INLINE and stack[depth][0] not in INLINE:
                    break
            continue
        if name == "br" or name == "hr":
            pending.append(" ")
            breaks += 1
            # Directly under the page an empty line ends a paragraph.
            if not stack[-1][1] and (breaks > 1 or name == "hr"):
                flush()
        if name in HOLDER:
            flush()
            if name not in FOREIGN or not (found.group(3) or "").endswith("/"):
                held = _held(source) if held is None else held
                at = held.get(at, at)
            continue
        if name in RAW and name != "head":
            end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(source, at)
            at = end.end() if end else size
            continue
        if name in ("html", "head", "body") or name in VOID:
            continue
        if name in CLOSES_P or name in SAME:
            shut = {"p"} if name in CLOSES_P else SAME[name]
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] in shut:
                    close(depth)
                    break
                if stack[depth][0] in SCOPE or (name in SAME and stack[depth][0] in ("ul", "ol", "dl", "table")):
                    break
        attributes = found.group(3) or ""
        if name in INLINE:
            # A "/" in an unquoted value, as in <a href=/>, ends nothing.
            if not CLOSED.search(attributes):
                stack.append((name, stack[-1][1]))
                if name == "a":
                    anchors += 1
                    tree.links[stack[-1][1]] += 1
            continue
        flush()
        named = [next(filter(None, m.groups()[1:]), "") for m in ATTRIBUTE.finditer(attributes)]
        words = tuple(p.lower() for p in PART.findall(" ".join(named)))
        stack.append((name, add(name, stack[-1][1], words, bool(attributes) and bool(HIDDEN.search(attributes)))))
    flush()
    return tree


def node_features(tree: Tree) -> np.ndarray:
    """One row of FEATURES per node; sums run from the leaves up, since a parent comes before its children."""
    n = len(tree.tag)
    parent = tree.parent
    own, runs, stops, words = np.zeros(n), np.zeros(n), np.zeros(n), np.zeros(n)
    for node, text in tree.runs:
        own[node] += len(text)
        runs[node] += 1
        stops[node] += text.count(".") + text.count("!") + text.count("?")
        words[node] += text.count(" ") + 1
    role = {g: np.array([t in tags for t in tree.tag], float) for g, tags in GROUPS.items()}
    depth, children, order = np.zeros(n), np.zeros(n), np.zeros(n)
    good = np.array([len(_GOOD.intersection(w)) for w in tree.words], float)
    bad = np.array([len(_BAD.intersection(w)) for w in tree.words], float)
    above = {"good": np.zeros(n), "bad": np.zeros(n), "edge": np.zeros(n), "form": np.zeros(n), "main": np.zeros(n)}
    for i in range(1, n):
        p = parent[i]
        depth[i] = depth[p] + 1
        order[i] = children[p]
        children[p] += 1
        for name, own_value in (("good", good), ("bad", bad), ("edge", role["edge"]), ("form", role["form"]), ("main", role["main"])):
            above[name][i] = above[name][p] + own_value[p]
    total = {"chars": own.copy(), "links": np.array(tree.links, float), "link_chars": np.array(tree.link_chars, float), "runs": runs.copy(),
             "stops": stops, "words": words, "nodes": np.ones(n), "para": role["para"].copy(), "head": role["head"].copy(), "list": own * role["list"]}
    for i in range(n - 1, 0, -1):
        for column in total.values():
            column[parent[i]] += column[i]
    up = np.array([max(p, 0) for p in parent])
    log = np.log1p
    chars = total["chars"]
    columns = [
        depth, log(own), log(chars), log(total["nodes"]), chars / total["nodes"], total["link_chars"] / np.maximum(chars, 1), log(total["links"]), log(total["para"]),
        log(chars / np.maximum(total["runs"], 1)), log(total["runs"]), log(total["stops"]), total["words"] / (total["stops"] + 1),
        order / np.maximum(children[up], 1), log(children[up]), chars / np.maximum(chars[up], 1), chars / max(chars[0], 1), log(children),
        good, bad, above["good"], above["bad"], np.array(tree.hidden, float), (total["head"] > 0).astype(float),
        role["para"], role["head"], role["list"], role["table"], role["main"], role["edge"], role["form"], above["edge"] + role["edge"], above["form"] + role["form"],
        above["main"] + role["main"], total["list"] / np.maximum(chars, 1),
    ]
    return np.column_stack(columns)


def decode(parent: list[int], chance: np.ndarray) -> np.ndarray:
    """The likeliest labels in which every node above a main one is main too."""
    chance = np.clip(chance, 1e-6, 1 - 1e-6)
    yes, no = np.log(chance), np.log(1 - chance)
    best = yes.copy()
    for i in range(len(parent) - 1, 0, -1):
        best[parent[i]] += max(best[i], no[i])
        no[parent[i]] += no[i]
    main = np.zeros(len(parent), bool)
    main[0] = True
    for i in range(1, len(parent)):
        main[i] = main[parent[i]] and best[i] > no[i]
    return main


def _layout(blocks: list[str], other: list[str], rng: random.Random) -> tuple[str, list[str]]:
    """A page of one of several designs; main paragraphs carry a mark, all other texts do not.

    Every page has a line of links in a block of any class or none, and a title of one to ten words, so that no fit lacks the
    cases that differ by little else.
    """
    esc = entities.escape
    some = lambda k: [esc(rng.choice(other)) for _ in range(k)]
    short = lambda: " ".join(esc(rng.choice(other)).split()[: rng.randint(1, 5)])
    kind = lambda *names: rng.choice(['class="%s"', 'id="%s"', 'class="x %s y"']) % rng.choice(names)
    menu = lambda: "<ul>" + "".join(f'<li><a href="/{i}">{short()}</a></li>' for i in range(rng.randint(2, 12))) + "</ul>"
    div = lambda inside, *names: f"<div {kind(*names)}>{inside}</div>"
    paras = lambda k: "".join(f"<p>{t}</p>" for t in some(k))
    head = lambda text: esc(" ".join(text.split()[: rng.randint(1, 10)]))

    def line() -> str:
        links = rng.choice([" ", " ", " | ", ", ", ""]).join(f'<a href="/{i}">{short()}</a>' for i in range(rng.randint(1, 8)))
        named = kind("top", "bar", "row", "links", "box", "inner", "line", "left", "c1", "hd", "body", "page")
        return rng.choice([f"<div>{links}</div>", f"<div {named}>{links}</div>", f"<div {named}>{links}</div>", f"<p>{links}</p>", f"<div {named}><p>{links}</p></div>", f"<table><tr><td>{links}</td></tr></table>"])

    def extra() -> str:
        return rng.choice(
            [
                lambda: div(some(1)[0], "ad", "advert", "ads", "sponsored", "promo"),
                lambda: f"<aside>{paras(rng.randint(1, 3))}</aside>",
                lambda: div(paras(1), "notice", "cookie-notice", "cookie", "banner", "consent", "warning", "disclaimer"),
                lambda: f"<form action='/s'><label>{short()}</label><input name=q><button>{short()}</button><p>{some(1)[0]}</p></form>",
                lambda: div(menu(), "related", "share", "social", "tags", "recommended", "breadcrumb"),
                lambda: div(f"<h3>{short()}</h3>" + paras(rng.randint(1, 3)), "newsletter", "subscribe", "widget", "sidebar", "popup"),
                lambda: f"<nav>{menu()}</nav>",
                line,
            ]
        )()

    def comments() -> str:
        each = lambda: rng.choice(
            [lambda: div(f"<b>{short()}</b>" + paras(rng.randint(1, 2)), "comment", "reply"), lambda: f"<li {kind('comment', 'reply')}><p>{some(1)[0]}</p></li>"]
        )()
        inside = f"<h2>{short()}</h2>" + "".join(each() for _ in range(rng.randint(1, 6)))
        return rng.choice([lambda: div(inside, "comments", "comment-list", "replies", "disqus", "reviews"), lambda: f"<section {kind('comments', 'replies')}>{inside}</section>"])()

    def block(text: str) -> str:
        t = esc(text)
        form = rng.random()
        if form < 0.08:
            return "<h{0}>\x01{1}</h{0}>".format(rng.randint(2, 4), head(text))
        if form < 0.12:
            return f"<ul><li>\x01{t}</li><li>\x01{t}</li></ul>"
        if form < 0.15:
            return f"<blockquote>\x01{t}</blockquote>"
        if form < 0.18:
            return f"<div>\x01{t}</div>"
        if form < 0.2:
            return f"<table><tr><td>\x01{t}</td></tr></table>"
        if form < 0.3:
            return f"<p>\x01{t} <a href='/z'>{t[:30]}</a></p>"
        return f"<p>\x01{t}</p>"

    level, named = rng.choice(["h1", "h1", "h1", "h2"]), rng.choice(["", "", "", ' class="title"', ' id="t1"'])
    inner = f"<{level}{named}>\x01{head(blocks[0])}</{level}>" + "".join(block(b) + (extra() if rng.random() < 0.06 else "") for b in blocks[1:])
    if rng.random() < 0.2:
        inner += comments()
    opened = rng.choice(
        [
            ("<article>", "</article>"), ("<article>", "</article>"), ("<main>", "</main>"), ("<article class='post'>", "</article>"),
            (f"<div {kind('content', 'post', 'entry-content', 'post-content', 'article', 'main', 'story', 'article-body')}>", "</div>"),
            (f"<div {kind('content', 'post', 'entry-content', 'main')}>", "</div>"), ("<section>", "</section>"), ("<div>", "</div>"), ("<div role='main'>", "</div>"),
            ("<main><article>", "</article></main>"), (f"<div {kind('wrapper', 'container')}><div {kind('content', 'post')}>", "</div></div>"),
        ]
    )
    body = opened[0] + inner + opened[1]
    before = [rng.choice([lambda: f"<nav>{menu()}</nav>", lambda: f"<header><p>{short()}</p>{menu()}</header>", lambda: f"<header><h1>{short()}</h1></header>", extra, lambda: div(menu(), "menu", "nav", "navbar", "header")])() for _ in range(rng.randint(0, 3))]
    before.insert(rng.randint(0, len(before)), line())
    after = [line()] * (rng.random() < 0.4) + [extra() for _ in range(rng.randint(0, 2))] + ([comments()] if rng.random() < 0.5 else [])
    after += [rng.choice([lambda: f"<footer>{short()} {some(1)[0]}</footer>", lambda: f"<footer>{paras(2)}</footer>", lambda: div(f"<p>{some(1)[0]}</p>" + menu(), "footer", "copyright")])()] if rng.random() < 0.9 else []
    page = "".join([*before, body, *after])
    if rng.random() < 0.3:
        page = f"<div {kind('page', 'wrap', 'site', 'container')}>{page}</div>"
    return f"<html><head><title>{esc(blocks[0])}</title></head><body>{page}</body></html>"


def _plain_layout(blocks: list[str], other: list[str], rng: random.Random) -> str:
    """A page whose main paragraphs, with a mark, stand directly under it between lines of links, short notices and some blocks."""
    esc = entities.escape
    short = lambda: " ".join(esc(rng.choice(other)).split()[: rng.randint(1, 5)])
    links = lambda: rng.choice([" | ", " ", " - "]).join(f"<a href='/{i}'>{short()}</a>" for i in range(rng.randint(2, 8)))
    block = lambda: rng.choice(["<div>{}</div>", "<ul><li>{}</li></ul>", "<nav>{}</nav>", "<footer>{}</footer>"]).replace("{}", links())
    edge = lambda k: [rng.choice([links, links, short, block])() for _ in range(k)]
    inline = lambda t: rng.choice(["{}", "{}", "{}", "{} <a href='/z'>more</a>", "<b>{}</b>", "<span>{}</span>"]).replace("{}", t)
    parts = edge(rng.randint(0, 2)) + [inline("\x01" + esc(b)) for b in blocks] + edge(rng.randint(0, 1)) + [links()]
    return "<html><body>" + rng.choice(["<br><br>", "<br/>\n<br/>", "<hr>"]).join(parts) + "</body></html>"


def training_rows(pages: list[str], layouts: int, seed: int, plain: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the nodes of ``layouts`` new pages per sampled page; a node is main if a marked text is in it.

    With ``plain``, of the runs directly under the page only, from pages that have the main text there.
    """
    rng = random.Random(seed)
    texts = [[t for _, t in parse(p).runs if len(t) >= 20] for p in pages]
    texts = [t for t in texts if t]
    pool = [t for page in texts for t in page]
    rows, labels = [], []
    for page in texts:
        for _ in range(layouts):
            blocks = [t for t in rng.sample(page, min(len(page), rng.randint(1, 14)))]
            tree = parse(_plain_layout(blocks, pool, rng) if plain else _layout([rng.choice(blocks)[:60], *blocks], pool, rng))
            label = np.zeros(len(tree.tag))
            for k, (node, text) in enumerate(tree.runs):
                if "\x01" in text:
                    while node >= 0 and not label[node]:
                        label[node] = 1
                        node = tree.parent[node]
            tree.runs = [(node, text.replace("\x01", "")) for node, text in tree.runs]
            used = np.array([tag == "" if plain else i > 0 for i, tag in enumerate(tree.tag)])
            rows.append(node_features(tree)[used])
            labels.append(label[used])
    return (np.concatenate(rows), np.concatenate(labels)) if rows else (np.zeros((0, len(FEATURES))), np.zeros(0))


@dataclass(frozen=True)
class Boosted:
    """Trees as arrays: a node's feature, threshold, children and value; a leaf's children are itself.  ``plain`` judges runs directly under the page."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    plain: Boosted | None = None

    def chance(self, rows: np.ndarray) -> np.ndarray:
        at = np.broadcast_to(self.roots, (len(rows), len(self.roots))).copy()
        which = np.arange(len(rows))[:, None]
        for _ in range(self.depth):
            at = np.where(rows[which, self.feature[at]] <= self.threshold[at], self.left[at], self.right[at])
        return 1 / (1 + np.exp(-2 * self.value[at].sum(1)))

    def judge(self, trees: list[Tree]) -> np.ndarray:
        """The chance of every node of ``trees``, one tree after the other."""
        rows = np.concatenate([node_features(t) for t in trees])
        chance = self.chance(rows)
        loose = np.array([tag == "" for t in trees for tag in t.tag])
        if self.plain and loose.any():
            chance[loose] = self.plain.chance(rows[loose])
        return chance


def _arrays(model: GBTClassificationModel, depth: int) -> Boosted:
    rows: list[list[float]] = []

    def add(node, weight: float) -> int:
        place = len(rows)
        rows.append([0, 0.0, place, place, node.prediction() * weight])
        if node.getClass().getSimpleName() == "InternalNode":
            rows[place][0] = node.split().featureIndex()
            rows[place][1] = node.split().threshold()
            rows[place][2] = add(node.leftChild(), weight)
            rows[place][3] = add(node.rightChild(), weight)
        return place

    roots = [add(tree._java_obj.rootNode(), weight) for tree, weight in zip(model.trees, model.treeWeights)]
    feature, threshold, left, right, value = zip(*rows)
    return Boosted(np.array(feature), np.array(threshold), np.array(left), np.array(right), np.array(value), np.array(roots), depth)


@dataclass(frozen=True)
class Training:
    """The fit sees ``sample_pages`` pages in ``layouts`` layouts each, however many pages there are."""

    sample_pages: int = 120
    layouts: int = 6
    trees: int = 20
    depth: int = 5
    seed: int = 11


def fit(pages: DataFrame, how: Training = Training(), id_col: str = "page_id", html_col: str = "html") -> Boosted | None:
    """Boosted trees from a bounded sample of pages, taken in the order of a hash of the id; None without any text."""
    rows = pages.where(F.col(html_col).isNotNull()).select(F.xxhash64(F.col(id_col), F.lit(how.seed)).alias("at"), F.col(html_col).alias("html"))
    sample = [r.html for r in rows.orderBy("at", F.xxhash64("html")).limit(how.sample_pages).collect()]
    model, plain = (_boosted(pages.sparkSession, *training_rows(sample, how.layouts, how.seed, kind), how) for kind in (False, True))
    return model and replace(model, plain=plain)


def _boosted(spark: SparkSession, x: np.ndarray, y: np.ndarray, how: Training) -> Boosted | None:
    if not len(y):
        return None
    # Both classes weigh the same.
    weight = len(y) / (2 * np.where(y > 0, max(y.sum(), 1), max((1 - y).sum(), 1)))
    table = spark.createDataFrame(pa.table({"label": y, "weight": weight, "row": pa.array(list(x), pa.list_(pa.float64()))}))
    table = table.select("label", "weight", array_to_vector("row").alias("features")).coalesce(4).cache()
    model = GBTClassifier(maxIter=how.trees, maxDepth=how.depth, stepSize=0.3, seed=how.seed, weightCol="weight").fit(table)
    table.unpersist()
    return _arrays(model, how.depth)


def main_text(tree: Tree, main: np.ndarray) -> str:
    return "\n\n".join(text for node, text in tree.runs if main[node])


def extract(pages: DataFrame, model: Boosted | None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id, url, text`` per row: the text runs of main nodes in page order, two line feeds between.

    White space in a run becomes one space and character references are decoded; scripts, styles, comments
    and other raw elements are never read.  A null or empty page, or one without main text, gives an empty
    text.  Rows repeated under one id are read each; other columns are not read.
    """

    def read(batch):
        source = batch.column("html").to_pylist()
        for begin in range(0, len(source), 64):
            trees = [parse(s or "") for s in source[begin : begin + 64]]
            chance = model.judge(trees) if model else np.zeros(sum(len(t.tag) for t in trees))
            texts, at = [], 0
            for tree in trees:
                # The page itself is always open, but holds no text.
                main = decode(tree.parent, chance[at : at + len(tree.tag)])
                at += len(tree.tag)
                texts.append(main_text(tree, main) if main[1:].any() else "")
            rows_ = batch.slice(begin, len(trees))
            yield [rows_.column("page_id"), rows_.column("url"), pa.array(texts, pa.string())]

    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    return map_rows(rows, "page_id long, url string, text string", read)


def fit_and_extract(pages: DataFrame, how: Training = Training(), **columns: str) -> DataFrame:
    """Fit on the sample, then read every page."""
    named = {k: v for k, v in columns.items() if k != "url_col"}
    return extract(pages, fit(pages, how, **named), **columns)
