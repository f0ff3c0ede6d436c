"""Main text of web pages by wrappers inferred for each host.

A page is read as a stream of tags and texts; menus, notices, comments and the like are set aside by their names, but
never what holds the article. Repeated siblings become a repeated group, and the streams of one
host are aligned level by level: matching tags merge, tags on one side only become optional groups, texts become
slots that stay constant as long as all pages agree. The result is a union-free expression of the host's pages.
It tells where the article stands and which slots in it are the template's own words; a page is then cut by it. The
article is what is marked as one, else the smallest element around all paragraphs, and the page's title.

Tasks merge the pages they read and send one expression a host; those are merged in two steps, so no task ever
holds the pages of a host.
"""

from __future__ import annotations

import functools
import html
import json
import re
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|</?[a-zA-Z](?:[^>\"']|\"[^\"]*\"|'[^']*')*>|</?[a-zA-Z][^<>]*(?:>|\Z)", re.S)
NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
ATTRIBUTE = re.compile(r"\b(class|id|role|itemprop|hidden|aria-hidden|style)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)

RAW = {"script", "style", "noscript", "template", "textarea", "title", "iframe", "svg", "math", "object"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
INLINE = {
    "a", "abbr", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label",
    "mark", "q", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr",
}
#: An opening tag closes the open elements named here, up to the next container.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
          "option": {"option"}}
CONTAINERS = {"ul", "ol", "dl", "table", "div", "section", "article", "main", "body", "td", "th", "blockquote"}
ASIDE_TAGS = {
    "nav", "header", "footer", "aside", "form", "menu", "button", "select", "dialog", "head", "figure", "fieldset", "input",
} | RAW
ASIDE_WORDS = {
    "nav", "navbar", "navigation", "menu", "header", "footer", "sidebar", "side", "ad", "ads", "advert", "adverts",
    "advertisement", "banner", "promo", "sponsor", "sponsored", "cookie", "cookies", "notice", "consent", "gdpr", "popup",
    "modal", "overlay", "newsletter", "subscribe", "signup", "share", "sharing", "social", "comment", "comments", "reply",
    "replies", "disqus", "respond", "related", "recommended", "breadcrumb", "breadcrumbs", "widget", "toolbar", "login",
    "search", "pager", "pagination", "complementary", "contentinfo", "alert", "hidden", "teaser",
}
#: Those of them that never hold the article.
FIRM_WORDS = {
    "ad", "ads", "advert", "adverts", "advertisement", "promo", "sponsor", "sponsored", "cookie", "cookies", "consent",
    "gdpr", "newsletter", "comment", "comments", "disqus", "hidden",
}
#: Set aside by these names unless the article is found inside.
LOOSE_TAGS = {"header", "form"}
#: Parts of a class name that tell of a state or a subject: such a name says nothing about what the element is.
STATE_WORDS = {"has", "have", "no", "not", "with", "without", "is", "category", "tag", "format", "type", "status"}
ARTICLE_WORDS = {"articlebody", "article", "main"}
PARAGRAPHS = {"p", "blockquote", "pre"}
#: Text right inside these is no paragraph of its own.
ENTRIES = {"li", "dt", "dd", "td", "th", "option", "caption", "h1", "h2", "h3", "h4", "h5", "h6"}
HEADINGS = {"h1", "h2", "h3"}
#: From this many different children an element's expression is one group of any of them.
MANY_CHILDREN = 64
#: A block counts towards the article's place if its paragraphs have this part of the longest block's.
BLOCK_SHARE = 20
#: Pages that must agree on a text before it counts as the template's.
TEMPLATE_PAGES = 5

#: Elements nested deeper count to the level above.
DEPTH = 150

KEY, MANY, MAYBE, PAGES, CHARS, SAME, INSIDE, SHORT = range(8)

#: Why an element is set aside: it is not, by a header's name, by another loose name, for good.
KEPT, HEADER, LOOSE, FIRM = range(4)


class Element:
    __slots__ = ("tag", "key", "aside", "article", "inside", "size", "paragraphs")

    def __init__(self, tag: str, key: str, aside: int, article: bool) -> None:
        self.tag, self.key, self.aside, self.article, self.inside = tag, key, aside, article, []
        self.size = self.paragraphs = 0


def _names_aside(name: str, words: set[str] = ASIDE_WORDS) -> bool:
    """Whether a class name is that of an aside: as a whole, or by its first or last part."""
    parts = re.findall("[a-z]+", name)
    return bool(parts) and STATE_WORDS.isdisjoint(parts) and not words.isdisjoint((parts[0], parts[-1]))


@functools.lru_cache(4096)
def _described(tag: str) -> tuple[str, str, int, bool]:
    name = NAME.match(tag).group(1).lower()
    names, hidden = [], False
    for attribute, *values in ATTRIBUTE.findall(tag[len(name) + 1 :]):
        value = next((v for v in values if v), "").lower()
        attribute = attribute.lower()
        if attribute in ("hidden",) or attribute == "aria-hidden" and value == "true":
            hidden = True
        elif attribute == "style":
            hidden |= re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value) is not None
        else:
            names += value.split()
    words = {w for x in names for w in re.findall("[a-z]+", x)}
    aside = KEPT
    if name not in ("html", "body"):
        named = [x for x in names if _names_aside(x)]
        if named or name in LOOSE_TAGS:
            header = name != "form" and all("header" in x for x in named)
            aside = HEADER if header else FIRM if any(_names_aside(x, FIRM_WORDS) for x in named) else LOOSE
    if hidden or name in ASIDE_TAGS and name not in LOOSE_TAGS:
        aside = FIRM
    article = name in ("article", "main") or not ARTICLE_WORDS.isdisjoint(words)
    return name, ".".join([name, *sorted(words)]), aside, article


def parse(page: str) -> Element:
    """The page's elements; a text is a plain string inside its element."""
    root = Element("", "", KEPT, False)
    stack = [root]
    place, n = 0, len(page)
    while place < n:
        found = TOKEN.search(page, place)
        if not found:
            stack[-1].inside.append(page[place:])
            break
        if found.start() > place:
            stack[-1].inside.append(page[place : found.start()])
        place, tag = found.end(), found.group()
        if tag[1] in "!?":
            continue
        if tag[1] == "/":
            name = NAME.match(tag).group(1).lower()
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == name:
                    del stack[k:]
                    break
            continue
        name, key, aside, article = _described(tag)
        if name in RAW:
            if not tag.endswith("/>"):
                end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, place)
                place = end.end() if end else n
            continue
        if name not in INLINE and name not in VOID:  # a block ends an open paragraph
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == "p":
                    del stack[k:]
                    break
                if stack[k].tag in CONTAINERS:
                    break
        for k in range(len(stack) - 1, 0, -1) if name in CLOSES else ():
            if stack[k].tag in CLOSES[name]:
                del stack[k:]
                break
            if stack[k].tag in CONTAINERS:
                break
        element = Element(name, key, aside, article)
        stack[-1].inside.append(element)
        if name not in VOID and not tag.endswith("/>") and len(stack) < DEPTH:
            stack.append(element)
    _settle(root)
    return root


def _measure(element: Element) -> None:
    """Characters inside the element, and those in its paragraphs."""
    for x in element.inside:
        if isinstance(x, str):
            element.size += len(x.strip())
        else:
            _measure(x)
            element.size += x.size
            element.paragraphs += x.paragraphs
    if element.tag in PARAGRAPHS:
        element.paragraphs = element.size


def _settle(root: Element) -> None:
    """Take back what the names alone set aside: an article's own header, and whatever holds the article itself."""
    _measure(root)
    outside = {"articles": 0, "text": 0, "paragraphs": 0}
    within: list[tuple[int, list[Element]]] = []
    loose: list[Element] = []

    def look(element: Element, chain: list[Element], firm: bool, inside: bool) -> None:
        if inside and element.aside == HEADER:
            element.aside = KEPT
        if element.aside:
            if not chain and element.aside == LOOSE:
                loose.append(element)
            chain, firm = [*chain, element], firm or element.aside == FIRM
        if element.article and element.size:
            if not chain:
                outside["articles"] += 1
            elif not firm:
                within.append((element.size, chain))
        inside = inside or element.article and element.tag != "main"
        if not chain and element.tag in PARAGRAPHS:
            outside["paragraphs"] += element.size
        for x in element.inside:
            if not isinstance(x, str):
                look(x, chain, firm, inside)
            elif not chain:
                outside["text"] += len(x.strip())

    look(root, [], False, False)
    opened: list[Element] = []
    if not outside["articles"]:
        size, chain = max(within, key=lambda x: x[0], default=(0, []))
        if size > (outside["paragraphs"] or outside["text"]):
            opened = chain
        elif not outside["text"] and loose:
            opened = [max(loose, key=lambda x: (x.paragraphs, x.size))]
    for element in opened:
        element.aside = KEPT


def folded(text: str) -> str:
    return " ".join(html.unescape(text).split())


# --- wrappers: [key, repeated, optional, pages, characters, constant text or None, children, their keys' shortening]


def named(key: str, short: int) -> str:
    """The key of a child: tag and names, the tag alone, or any element at all."""
    return key if not short or key == "#" else key.split(".")[0] if short == 1 else "*"


def parts(element: Element) -> list:
    """Texts and blocks in order; inline elements are no level of their own, those set aside are left out."""
    out: list = []
    for x in element.inside:
        if isinstance(x, str):
            out.append(x)
        elif x.tag in INLINE:
            if not x.aside:
                out += parts(x)
        else:
            out.append(x)
    return out


def blocks_of(element: Element) -> list:
    """The element's text blocks, each as one string with its white space folded, and its block elements."""
    out: list = []
    run: list[str] = []
    for x in [*parts(element), None]:
        if isinstance(x, str):
            run.append(x)
            continue
        if text := folded("".join(run)):
            out.append(text)
        run.clear()
        if x is not None and x.tag not in VOID and not x.aside:
            out.append(x)
    return out


def expression(element: Element) -> list:
    """The element as an expression of its own; nothing inside an aside element matters."""
    children = []
    for x in blocks_of(element):
        if isinstance(x, str):
            children.append(["#", False, False, 1, len(x), x if len(x) <= 200 else None, [], 0])
        else:
            children.append(expression(x))
    inside, short = _repeats(children)
    return [element.key, False, False, 1, sum(c[CHARS] for c in children), None, inside, short]


def _repeats(children: list) -> tuple[list, int]:
    """Neighbours of one key become one repeated group."""
    out: list = []
    for child in children:
        if out and out[-1][KEY] == child[KEY]:
            out[-1] = merged(out[-1], child)
            out[-1][MANY] = True
            out[-1][PAGES] = max(1, child[PAGES])
        else:
            out.append(child)
    return _any_of(out) if len(out) > MANY_CHILDREN else (out, 0)


def _any_of(children: list, short: int = 0) -> tuple[list, int]:
    """One group of any of the children, by key; by a shorter key, which is told, if those are too many."""
    while True:
        groups: dict[str, list] = {}
        for child in children:
            key = named(child[KEY], short)
            child = [key, True, True, *child[PAGES:]]
            groups[key] = merged(groups[key], child) if key in groups else child
        if len(groups) <= MANY_CHILDREN or short == 2:
            return [groups[k] for k in sorted(groups)], short
        short += 1


def merged(a: list, b: list) -> list:
    return [
        a[KEY], a[MANY] or b[MANY], a[MAYBE] or b[MAYBE], a[PAGES] + b[PAGES], a[CHARS] + b[CHARS],
        a[SAME] if a[SAME] == b[SAME] else None, *aligned(a[INSIDE], b[INSIDE], max(a[SHORT], b[SHORT])),
    ]


def aligned(a: list, b: list, short: int = 0) -> tuple[list, int]:
    """Longest common order of keys; what stands on one side only becomes optional."""
    if short:
        return _any_of([*a, *b], short)
    if [x[KEY] for x in a] == [x[KEY] for x in b]:
        return [merged(x, y) for x, y in zip(a, b)], 0
    n, m = len(a), len(b)
    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        for j in range(m - 1, -1, -1):
            same = a[i][KEY] == b[j][KEY]
            best[i][j] = best[i + 1][j + 1] + 1 if same else max(best[i + 1][j], best[i][j + 1])
    out, i, j = [], 0, 0
    while i < n or j < m:
        if i < n and j < m and a[i][KEY] == b[j][KEY]:
            out.append(merged(a[i], b[j]))
            i, j = i + 1, j + 1
        elif j == m or i < n and best[i + 1][j] >= best[i][j + 1]:
            out.append([*a[i][:MAYBE], True, *a[i][PAGES:]])
            i += 1
        else:
            out.append([*b[j][:MAYBE], True, *b[j][PAGES:]])
            j += 1
    return _any_of(out) if len(out) > MANY_CHILDREN else (out, 0)


def _around(blocks: list[tuple[int, str]]) -> str | None:
    """Path of the smallest element that holds all blocks of a fair size."""
    most = max((size for size, _ in blocks), default=0)
    if not most:
        return None
    paths = [path.split("/") for size, path in blocks if BLOCK_SHARE * size >= most]
    shared = []
    for names in zip(*paths):
        if len(set(names)) > 1:
            break
        shared.append(names[0])
    return "/".join(shared)


def rule_of(wrapper: list) -> dict:
    """Where the article stands in a host's pages, the constant texts inside it, and where keys are short."""
    articles, titles, short, nodes = [], [], {}, {}
    blocks: tuple[list, list, list] = ([], [], [])  # by paragraphs, by text of other elements, by any text

    def walk(node, path, inside_article):
        name, *words = node[KEY].split(".")
        nodes[path] = node
        if node[SHORT]:
            short[path] = node[SHORT]
        if not inside_article and (name in ("article", "main") or not ARTICLE_WORDS.isdisjoint(words)) and node[CHARS]:
            articles.append((node[CHARS], path))
            inside_article = True
        if name == "h1":
            titles.append(path)
        direct = sum(c[CHARS] for c in node[INSIDE] if c[KEY] == "#")
        blocks[0].append((sum(c[CHARS] for c in node[INSIDE] if c[KEY].split(".")[0] in PARAGRAPHS), path))
        blocks[1].append((0 if name in ENTRIES else direct, path))
        blocks[2].append((direct, path))
        for child in node[INSIDE]:
            if child[KEY] != "#":
                walk(child, f"{path}/{child[KEY]}", inside_article)

    walk(wrapper, "", False)
    if articles:
        most = max(size for size, _ in articles)
        chosen = [path for size, path in articles if 5 * size >= most]
    else:
        place = next((p for p in map(_around, blocks) if p is not None), None)
        chosen = [] if place is None else [place, *(t for t in titles if not f"{t}/".startswith(f"{place}/"))]
    constant = []
    for path in chosen:
        slots: list[tuple[str, list]] = []

        def gather(node, path):
            for child in node[INSIDE]:
                if child[KEY] == "#":
                    slots.append((path, child))
                else:
                    gather(child, f"{path}/{child[KEY]}")

        gather(nodes[path], path)
        if any(s[SAME] is None and s[CHARS] for _, s in slots):  # copies of one page tell nothing
            constant += [
                f"{p}\n{s[SAME]}"
                for p, s in slots
                if s[SAME] is not None and s[PAGES] >= TEMPLATE_PAGES
                and p.rsplit("/", 1)[-1].split(".")[0] not in HEADINGS  # a title may recur
            ]
    return {"at": sorted(set(chosen)), "constant": sorted(set(constant)), "short": short}


@functools.lru_cache(1024)
def _rule(text: str) -> tuple[frozenset, frozenset, dict]:
    rule = json.loads(text)
    return frozenset(rule["at"]), frozenset(rule["constant"]), rule["short"]


def extract(page: str, rule: str | None) -> str:
    """The page's main text by its host's rule; a page that the rule doesn't fit is cut by its own expression."""
    root = parse(page)
    for text in (rule, None):
        at, constant, short = _rule(text or json.dumps(rule_of(expression(root))))
        out: list[str] = []

        def walk(element, path, inside):
            inside = inside or path in at
            keys = short.get(path, 0)
            for x in blocks_of(element):
                if not isinstance(x, str):
                    walk(x, f"{path}/{named(x.key, keys)}", inside)
                elif inside and f"{path}\n{x}" not in constant:
                    out.append(x)

        walk(root, "", False)
        if out or text is None:
            return " ".join(out)
    return ""


def host_of(url: str | None) -> str:
    try:
        return (urlsplit(url or "").hostname or "").lower()
    except ValueError:
        return ""


def infer_rules(pages: DataFrame) -> DataFrame:
    """``host, rule`` of every host in ``url, html``."""

    def per_task(batches):
        held: dict[str, list] = {}

        def sent():
            hosts = list(held)
            out = pa.RecordBatch.from_pydict(
                {"host": hosts, "wrapper": [json.dumps(held[h]) for h in hosts]},
                pa.schema([("host", pa.string()), ("wrapper", pa.string())]),
            )
            held.clear()
            return out

        for batch in batches:
            for url, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                host, own = host_of(url), expression(parse(page or ""))
                held[host] = merged(held[host], own) if host in held else own
                if len(held) >= 2000:
                    yield sent()
        if held:
            yield sent()

    def joined(table: pa.Table) -> list:
        out = None
        for text in sorted(table.column("wrapper").to_pylist()):
            own = json.loads(text)
            out = merged(out, own) if out else own
        return out

    def halfway(table: pa.Table) -> pa.Table:
        return pa.table({"host": table.column("host")[:1], "wrapper": [json.dumps(joined(table))]})

    def whole(table: pa.Table) -> pa.Table:
        return pa.table({"host": table.column("host")[:1], "rule": [json.dumps(rule_of(joined(table)))]})

    parts = pages.select("url", "html").mapInArrow(per_task, "host string, wrapper string")
    parts = parts.withColumn("part", F.pmod(F.hash("wrapper"), F.lit(64)))
    parts = parts.groupBy("host", "part").applyInArrow(halfway, "host string, wrapper string")
    return parts.groupBy("host").applyInArrow(whole, "host string, rule string")


def extract_pages(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every row.

    Reads ``page_id, url, html`` only. Null html is empty and gives an empty text; a null or odd url counts to the
    host without a name; repeated rows are extracted each. Pages and rules are joined by host.
    """
    def with_host(batches):
        for batch in batches:
            hosts = pa.array([host_of(u) for u in batch.column(1).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([hosts, *batch.columns], ["host", "page_id", "url", "html"])

    def cut(batches):
        for batch in batches:
            texts = [
                extract(page or "", rule) for page, rule in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string())], ["page_id", "url", "text"]
            )

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    rows = rows.mapInArrow(with_host, "host string, page_id long, url string, html string")
    rows = rows.join(rules, "host", "left").select("page_id", "url", "html", "rule")
    found = rows.mapInArrow(cut, "page_id long, url string, text string")
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
