"""Main text of web pages with a site style tree.

The DOMs of a host's pages are merged into one tree: a node is a path of elements (tags with their
classes and ids). The tree holds, per node,

* the arrangements of its children over the pages (their sequence of elements). Presentation importance is
  the entropy of these arrangements to the base of the number of pages that have the node: 0 where every page
  looks alike, up to 1 where each is another;
* the words of its own text, each once a page. A word's entropy over the pages is 1 if all pages that have text there
  have it and 0 if one page does; content importance is 1 less the mean entropy of the node's words;
* the composite importance, passed up from leaves to branches: ``(1 - g**l) * presentation + g**l * (importance of
  what is below)`` with l arrangements, where what is below is the mean over the node's own text and its children,
  weighed by the pages that have them.

From each page go the branches of low composite importance, and single blocks, wherever they stand, that the site's
pages repeat as a whole and in their words (a block's entropy over the pages is a word's; a short block of
common words alone is not enough). Element names are a prior beside the tree:
navigation, adverts, forms and the like go at once, and where a page has an ``article`` or
``main``, the text is taken from there. If what the tree would take from a page's main text is half of it or
more, the page is a copy or a near copy of others, not boilerplate, and keeps its text.

Identical pages of a host count once (each copy weighs one over their number). All is added up as
(host, node, item) sums by many tasks; no DOM is gathered with another's. A host's judgement (nodes of
low importance; words that its pages repeat, with their entropy) meets the host's pages by one
shuffle in which it comes before them, in ``PARTS`` parts a host, and is held one host at a time. A
node's words that could be repeated (on three pages or so) are gathered before those that are stay: a
vocabulary, not texts.

Defined cases: null and empty pages give an empty text; a null or malformed url is a host of its
own by its text; unclosed, crossed and cut-off tags are read leniently; pages are read whole.
Repeated pages each get their text. A node is judged only where ``MIN_PAGES`` different pages have it. Words
with an entropy under ``REPEATED`` count as not repeated. There are no ties. Other columns of the
input, whatever their names, are ignored.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from math import log

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtside.llm.common import cut, raw_texts
from courtside.session import scratch_path

MIN_PAGES = 6
#: A host's pages meet its judgement in so many parts: a host may hold a third of all pages.
PARTS = 32
#: Branches and blocks with an importance below this go.
LEAST = 0.2
#: Share of what is below a node in its importance, to the power of its number of arrangements.
BELOW = 0.9
#: Least entropy of a word that counts as repeated by a site.
REPEATED = 0.5

# HTML's elements by what they hold.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
NOISE_TAGS = set("aside button datalist dialog fieldset footer form head header input menu nav object option optgroup select title".split())
MAIN = {"article", "main"}
#: Words in a class or id that name a part beside the article.
NOISE_WORDS = set(("ad ads advert adverts advertisement advertisements banner banners breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer "
                   "gdpr login masthead menu menus modal nav navbar navigation newsletter notice notices pager pagination popup promo promoted promotion related "
                   "reply replies respond search share sharing sidebar signup social sponsor sponsored subscribe toolbar topbar widget widgets").split())
NOISE_ROLES = set("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar form".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|noscript|template|textarea|iframe|svg|math|noembed|xmp)\b.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:\"[^\"]*\"|'[^']*'|[^\"'>])*|[^>]*)(?:>|\Z)", re.S | re.I)
_ATTR = re.compile(r"(class|id|role|hidden|style|aria-hidden)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class Node:
    __slots__ = ("tag", "label", "noise", "main", "block")

    def __init__(self, tag: str, attrs: str, up: Node | None) -> None:
        found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTR.finditer(attrs)} if attrs and "=" in attrs or "hidden" in attrs else {}
        names = sorted({x for k in ("class", "id") for x in re.split(r"[^a-z]+", re.sub(r"(?<=[a-z])(?=[A-Z])", " ", found.get(k, "")).lower()) if x})
        self.tag, self.block = tag, tag not in INLINE
        self.main = (up.main if up else False) or (tag in MAIN and not (up and up.noise))
        own = (bool(NOISE_WORDS.intersection(names)) or found.get("role", "").lower() in NOISE_ROLES or "hidden" in found
               or found.get("aria-hidden", "").lower() == "true" or bool(_HIDDEN.search(found.get("style", "")))
               or tag in NOISE_TAGS and not (tag == "header" and up is not None and up.main))
        self.noise = (up.noise if up else False) or own and tag not in ("html", "body")
        here = tag + "".join(f".{x}" for x in names)
        self.label = f"{up.label}/{here}" if up and self.block else up.label if up else here


#: Start tags that end an open element of the same kind; and those that end an open paragraph.
_SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_SCOPE = {"ul", "ol", "dl", "table", "article", "section", "div", "body", "main", "aside", "nav", "form"}


def blocks(page: str) -> list[tuple[str, str, bool, bool]]:
    """(path, text, is noise, is in the main element) of the blocks of a page in page order."""
    out: list[tuple[str, str, bool, bool]] = []
    stack: list[Node] = [Node("html", "", None)]
    held: list[str] = []

    def flush() -> None:
        if held:
            text = " ".join(html.unescape("".join(held)).split())
            held.clear()
            if text:
                top = stack[-1]
                out.append((top.label, text, top.noise, top.main))

    def close(upto: int) -> None:
        if any(n.block for n in stack[upto:]):
            flush()
        del stack[upto:]

    at = 0
    for m in _TOKEN.finditer(page):
        if m.start() > at:
            held.append(page[at : m.start()])
        at = m.end()
        tag = m["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if m["end"]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    close(i)
                    break
                if stack[i].tag in MAIN and tag not in ("body", "html", "main"):
                    break  # an end tag doesn't reach out of an article
            continue
        if tag == "br":
            held.append(" ")
            continue
        if tag in ("html", "body"):
            flush()
            continue
        block = tag not in INLINE
        if block:
            flush()
            if tag in MAIN:  # an article ends a page part that was left open before it
                for i in range(1, len(stack)):
                    if stack[i].tag in ("nav", "header", "footer", "head", "title", "form"):
                        close(i)
                        break
            for i in range(len(stack) - 1, 0, -1):
                t = stack[i].tag
                if t == "p" or t in _SAME.get(tag, ()):
                    close(i)
                elif t in _SCOPE:
                    break
        node = Node(tag, m["attrs"], stack[-1])
        if tag in VOID or m["attrs"].endswith("/") and not block:
            continue
        stack.append(node)
    if at < len(page):
        held.append(page[at:])
    flush()
    return out


_WORD = re.compile(r"\w+")


class _Hashes(dict):
    """Hashes of words (below 2**63), remembered."""

    def __missing__(self, word: str) -> int:
        h = self[word] = xxhash.xxh64_intdigest(word) >> 1
        return h


def words_of(text: str, hashes: _Hashes | None = None) -> list[int]:
    """Hashes of a block's words."""
    return list(map((_Hashes() if hashes is None else hashes).__getitem__, _WORD.findall(text.lower())))


def block_of(text: str) -> int:
    """Hash of a block as a whole."""
    return xxhash.xxh64_intdigest("\n" + text.lower()) >> 1


def arrangements(found: list[tuple[str, str, bool, bool]]) -> dict[str, list[str]]:
    """Of every inner node of a page: its children's elements in page order."""
    out: dict[str, list[str]] = {}
    before: list[str] = []
    for path, *_ in found:
        steps = path.split("/")
        same = 0
        while same < min(len(steps), len(before)) - 1 and steps[same] == before[same]:
            same += 1
        at = "/".join(steps[:same])
        for k in range(max(same, 1), len(steps)):
            at = "/".join(steps[:k])
            out.setdefault(at, []).append(steps[k])
        before = steps
    return out


class Site:
    """A host's judgement: nodes of low importance, and the entropies of words that its pages repeat."""

    def __init__(self, low: list[str] = (), nodes: list[str] = (), words: list[int] = (), entropies: list[float] = ()) -> None:
        self.low = frozenset(low)
        self.repeats: dict[str, dict[int, float]] = {}
        for n, w, e in zip(nodes, words, entropies):
            self.repeats.setdefault(n, {})[w] = e

    def takes(self, path: str, text: str) -> bool:
        """Whether the tree takes a block away."""
        if self.low:
            steps = path.split("/")
            if any("/".join(steps[: k + 1]) in self.low for k in range(len(steps))):
                return True
        known = self.repeats.get(path)
        if not known:
            return False
        if known.get(block_of(text), 0.0) < 1 - LEAST:
            return False
        found = words_of(text)
        return bool(found) and 1 - sum(known.get(w, 0.0) for w in found) / len(found) < LEAST


def main_text(page: str | None, site: Site = Site(), names: bool = True) -> str:
    """Text of the blocks that stay. ``names=False`` leaves the judgement to the tree alone."""
    found = [b for b in blocks(page) if not (names and b[2])] if page else []
    if names and any(b[3] for b in found):
        found = [b for b in found if b[3]]
    kept = [b for b in found if not site.takes(b[0], b[1])]
    if names and 2 * sum(len(b[1]) for b in kept) <= sum(len(b[1]) for b in found):
        kept = found
    return "\n".join(b[1] for b in kept)


def host_of(url_col: str):
    url = F.coalesce(F.col(url_col), F.lit(""))
    return F.lower(F.regexp_extract(url, r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?(?://)?([^/?#]*)", 1))


#: Word hashes that a task remembers.
KEPT_HASHES = 300_000


def tree_sums(pages: DataFrame) -> DataFrame:
    """``node, item, name, n`` from (host, html, weight): how many pages (each with its weight) have an item at a node.
    ``node`` is eight times the node's number, plus the kind of item: the node itself (``PAGE``, which alone has the
    node's name, host and path), text there (``LEAF``), an arrangement, a word, a whole block."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _Hashes()
        numbers: dict[tuple[str, str], int] = {}
        names: dict[int, str] = {}
        at: list[int] = []
        sizes: list[int] = []
        weights: list[float] = []
        items: list[int] = []

        def add(node: int, weight: float, some) -> None:
            at.append(node)
            sizes.append(len(some))
            weights.append(weight)
            items.extend(some)

        def number(host: str, path: str) -> int:
            if (k := numbers.get((host, path))) is None:
                k = numbers[host, path] = (xxhash.xxh64_intdigest(f"{host}\n{path}") >> 4) << 3
                names[k] = f"{host}\n{path}"
            return k

        def out() -> pa.RecordBatch:
            node, item, weight = np.repeat(np.array(at, np.int64), sizes), np.array(items, np.int64), np.repeat(np.array(weights), sizes)
            order = np.lexsort((item, node))
            node, item = node[order], item[order]
            first = np.flatnonzero((np.diff(node, prepend=-1) != 0) | (np.diff(item, prepend=-1) != 0))
            n = np.add.reduceat(weight[order], first)
            name = [names[k] if k & 7 == PAGE else None for k in node[first].tolist()]
            for x in (at, sizes, weights, items):
                x.clear()
            if len(hashes) + len(numbers) > KEPT_HASHES:
                hashes.clear()
                numbers.clear()
                names.clear()
            return pa.RecordBatch.from_arrays([pa.array(node[first]), pa.array(item[first]), pa.array(name, pa.string()), pa.array(n)], names=["node", "item", "name", "n"])

        for batch in batches:
            for host, page, weight in zip(batch.column(0).to_pylist(), raw_texts(batch.column(1)), batch.column(2).to_pylist()):
                found = blocks(page.decode("utf-8", "replace")) if page else []
                children = arrangements(found)
                texts: dict[str, list[str]] = {}
                for path, text, *_ in found:
                    texts.setdefault(path, []).append(text)
                for path in {*children, *texts}:
                    add(number(host, path) + PAGE, weight, (0,))
                for path, steps in children.items():
                    add(number(host, path) + STYLE, weight, (xxhash.xxh64_intdigest("/".join(steps)) >> 1,))
                for path, some in texts.items():
                    k = number(host, path)
                    add(k + LEAF, weight, (0,))
                    add(k + BLOCK, weight, set(map(block_of, some)))
                    add(k + WORD, weight, set(words_of("\n".join(some), hashes)))
                if len(items) > 1_000_000:
                    yield out()
        if items:
            yield out()

    return (pages.select("host", "html", "weight").mapInArrow(rows, "node long, item long, name string, n double")
            .groupBy("node", "item", "name").agg(F.sum("n").alias("n")))


#: Kinds of sums.
PAGE, LEAF, STYLE, WORD, BLOCK = range(5)


def composites(nodes: list[tuple[str, float, float, float, float]]) -> dict[str, float]:
    """Composite importance of a host's nodes from (path, pages, presentation, arrangements, content or NaN)."""
    children: dict[str, list[str]] = {}
    by = {n[0]: n for n in nodes}
    for path in by:
        if "/" in path:
            children.setdefault(path.rsplit("/", 1)[0], []).append(path)
    out: dict[str, float] = {}
    for path in sorted(by, key=lambda p: -p.count("/")):
        _, pages, presentation, kinds, content = by[path]
        below = [(by[c][1], out[c]) for c in children.get(path, [])]
        if content == content:
            below.append((pages, content))
        mean = sum(w * x for w, x in below) / sum(w for w, _ in below) if below else 1.0
        g = BELOW ** max(kinds, 1.0)
        out[path] = mean if not children.get(path) else (1 - g) * presentation + g * mean
    return out


def style_tree(pages: DataFrame) -> DataFrame:
    """From (host, html, weight): the nodes ``host, path, pages, presentation, kinds, content, repeated``, the last
    the words and blocks that the pages repeat at the node with their entropies (of nodes that enough pages have)."""
    n, kind = F.col("n"), F.col("node").bitwiseAND(F.lit(7))
    # a word's entropy over the pages with text at the node is spread / log(those pages)
    could = REPEATED * log(MIN_PAGES - 0.5)  # less than this is no repeated word at any node that is judged
    sums = tree_sums(pages).select(F.shiftright("node", 3).alias("node"), kind.alias("kind"), "item", "name", "n",
                                   F.when(kind.isin(WORD, BLOCK), F.greatest(F.lit(0.0), F.log("n"))).alias("spread"))
    kind = F.col("kind")
    def total(k: int, x=n):
        return F.sum(F.when(kind == k, x))
    nodes = cut(sums.groupBy("node").agg(
        F.max("name").alias("name"), total(PAGE).alias("pages"), total(LEAF).alias("leaves"),
        F.count_if(kind == STYLE).cast("double").alias("kinds"), total(STYLE, n * F.log("n")).alias("style"), total(STYLE).alias("styled"),
        F.count_if(kind == WORD).alias("words"), total(WORD, F.col("spread")).alias("spread"),
        F.collect_list(F.when(F.col("spread") >= could, F.struct(F.col("item").alias("word"), F.col("spread").alias("spread")))).alias("some"))
        .withColumns({"host": F.substring_index("name", "\n", 1), "path": F.substring_index("name", "\n", -1)}))
    many, texts = F.col("pages") > 1.5, F.col("leaves") > 1.5
    presentation = F.when(many & F.col("styled").isNotNull(), 1 - F.col("style") / (F.col("styled") * F.log("pages"))).otherwise(1.0)
    content = F.when(F.col("words") > 0, F.when(texts, 1 - F.col("spread") / (F.col("words") * F.log("leaves"))).otherwise(1.0))
    entropies = F.transform("some", lambda x: F.struct(x["word"].alias("word"), F.least(F.lit(1.0), x["spread"] / F.log("leaves")).alias("entropy")))
    repeated = F.when(F.col("leaves") >= MIN_PAGES - 0.5, F.filter(entropies, lambda x: x["entropy"] >= REPEATED))
    return nodes.select("host", "path", "pages", presentation.alias("presentation"), "kinds", content.alias("content"), repeated.alias("repeated"))


def judgements(tree: DataFrame) -> DataFrame:
    """A row a host: ``host, low, nodes, words, entropies``."""

    def of_hosts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], []]
            for found in batch.column(1).to_pylist():
                nodes = [(x["path"], x["pages"], x["presentation"], x["kinds"], float("nan") if x["content"] is None else x["content"]) for x in found]
                pages = {n[0]: n[1] for n in nodes}
                out[0].append([p for p, c in composites(nodes).items() if c < LEAST and pages[p] >= MIN_PAGES - 0.5 and "/" in p])
                words = [(x["path"], w["word"], w["entropy"]) for x in found for w in x["repeated"] or ()]
                for k in range(3):
                    out[k + 1].append([w[k] for w in words])
            kinds = (pa.string(), pa.string(), pa.int64(), pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x, pa.list_(k)) for x, k in zip(out, kinds))], names=["host", "low", "nodes", "words", "entropies"])

    gathered = tree.groupBy("host").agg(F.collect_list(F.struct("path", "pages", "presentation", "kinds", "content", "repeated")).alias("x"))  # one site's tree
    return (gathered.select("host", "x").mapInArrow(of_hosts, "host string, low array<string>, nodes array<string>, words array<bigint>, entropies array<double>")
            .where("size(low) > 0 or size(words) > 0"))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, url, text, n_chars) of every row of ``pages``."""
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"), host_of(url_col).alias("host"))
    hashed = rows.select("host", "html", F.xxhash64("html").alias("h"))
    copies = hashed.groupBy("host", "h").agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")
    place = scratch_path(pages.sparkSession, "copies")
    copies.write.parquet(place)  # its size is known to the planner then
    copies = pages.sparkSession.read.schema(copies.schema).parquet(place)
    weighed = hashed.join(copies, ["host", "h"], "left").select("host", "html", (1.0 / F.coalesce("copies", F.lit(1))).alias("weight"))
    judged = cut(judgements(style_tree(weighed)))

    kinds = dict(rows.dtypes)
    part = F.pmod(F.xxhash64("url", "id"), F.lit(PARTS)).cast("int")
    model = judged.select("host", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))).alias("part"), F.lit(0).alias("kind"),
                          F.lit(None).cast(kinds["id"]).alias("id"), F.lit(None).cast(kinds["url"]).alias("url"), F.lit(None).cast("string").alias("html"), "low", "nodes", "words", "entropies")
    own = rows.select("host", part.alias("part"), F.lit(1).alias("kind"), "id", "url", "html", *[F.lit(None).cast(model.schema[c].dataType).alias(c) for c in ("low", "nodes", "words", "entropies")])
    met = own.unionByName(model).repartition("host", "part").sortWithinPartitions("host", "part", "kind")
    schema = f"id {kinds['id']}, url {kinds['url']}, text string, n_chars long"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, site = None, Site()
        for batch in batches:
            texts, at = [], []
            hosts, kind = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            pages = raw_texts(batch.column(5))
            for i, host in enumerate(hosts):
                if kind[i] == 0:
                    if host != now:  # parts of one host may follow each other
                        now, site = host, Site(*[batch.column(k)[i].as_py() or () for k in range(6, 10)])
                    continue
                if host != now:
                    now, site = host, Site()
                at.append(i)
                texts.append(main_text(pages[i].decode("utf-8", "replace") if pages[i] else None, site))
            if at:
                some = pa.array(at, pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column(3).take(some), batch.column(4).take(some), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["id", "url", "text", "n_chars"])

    return met.mapInArrow(read, schema).withColumnsRenamed({"id": id_col, "url": url_col})
