import collections
import html
import math
import random
import re

from courtside.llm import html_main as H
from courtside.llm import queries as Q


def page(body):
    return f"<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t='</p><p>no';</script></head><body>{body}</body></html>"


def test_parts_beside_the_article():
    got = H.main_text(page(
        "<nav><ul><li><a href='/x'>Menu</a></ul></nav><!-- <p>gone</p> --><div class='ad'>Buy</div><div id=cookie-notice>OK?</div>"
        "<article><header><h1>Title &amp; more</h1></header><p>One <b>two</b>\n three&nbsp;four<br>five<p>Six &lt;b&gt; &#233;"
        "<ul><li>a<li>b</ul><form><input value=z>Mail</form><aside>See also</aside><section class='comments'><article><p>Reply</p></article></section>"
        "<table><tr><td>c1<td>c2</table></article><div class=sidebar>Side</div><footer>&copy; x</footer>"))
    assert got == "Title & more\nOne two three four five\nSix <b> é\na\nb\nc1\nc2"


def test_pages_without_article_and_broken_pages():
    assert H.main_text(page("<div role=navigation>n</div><div><p>One<p>Two</div><footer>f")) == "One\nTwo"
    assert H.main_text("<nav><ul><li>m<article><p>Text <b>bold") == "Text bold"
    assert H.main_text("plain < text & more") == "plain < text & more"
    assert H.main_text("<p>a</i></b>b</p></div>c") == "ab\nc"
    assert H.main_text("<p hidden>x</p><p style='display: none'>y</p>z<script>w") == "z"
    for x in (None, "", " ", "<", "<p", "<!--", "<a href='"):
        assert "\n" not in H.main_text(x)


def test_site_tree_removes_what_a_site_repeats(spark):
    rows = [(i, f"http://s.example/{i}", page(f"<div class=box><p>Same on all pages</p></div><div class=body><p>Own text {w(i)}</p><p>And {w(i + 50)} {w(i + 90)}</p></div>")) for i in range(9)]
    rows += [(20 + i, "http://copies.example/a", page("<div class=box><p>Top</p></div><article><p>A copy</p></article>")) for i in range(9)]
    rows += [(30, None, None), (31, "", ""), (32, "no url", page("<article><p>Lone</p></article>")), (32, "no url", page("<article><p>Lone</p></article>")), (None, "x", "<p>y")]
    pages = spark.createDataFrame([(*r, "extra", 1) for r in rows], "page_id long, url string, html string, text string, host int")
    got = H.extract(pages).collect()
    assert len(got) == len(rows) and all(r["n_chars"] == len(r["text"]) for r in got)
    text = {r["page_id"]: r["text"] for r in got}
    assert text[3] == f"Own text {w(3)}\nAnd {w(53)} {w(93)}" and text[22] == "A copy" and text[30] == "" and text[32] == "Lone" and text[None] == "y"
    assert H.extract(pages.limit(0)).count() == 0


def w(i):
    """A word of its own for every number."""
    return "".join("bcdfghjklmnp"[int(c)] + "aeiou"[int(c) % 5] for c in str(i * 7919 + 10_000))


def slow_tree(pages):
    """Nodes and word entropies of one host's different pages, straight from the definitions."""
    pages = list(dict.fromkeys(pages))
    have, arranged, times, leaf, whole = {}, {}, {}, {}, set()
    for k, p in enumerate(pages):
        found = H.blocks(p)
        for path, steps in H.arrangements(found).items():
            have.setdefault(path, set()).add(k)
            arranged.setdefault(path, []).append("/".join(steps))
        for path, text, *_ in found:
            have.setdefault(path, set()).add(k)
            leaf.setdefault(path, set()).add(k)
            for x in [*H.words_of(text), H.block_of(text)]:
                times.setdefault((path, x), {})[k] = 1
            whole.add((path, H.block_of(text)))
    def entropy(counts, m):
        total = sum(counts)
        return -sum(c / total * math.log(c / total) for c in counts) / math.log(m) if m > 1 else 0.0
    words = {key: entropy(list(c.values()), len(leaf[key[0]])) for key, c in times.items()}
    nodes = {}
    for path, who in have.items():
        kinds = collections.Counter(arranged.get(path, []))
        mine = [e for (q, x), e in words.items() if q == path and (q, x) not in whole]
        nodes[path] = (len(who), (entropy(list(kinds.values()), len(who)) if len(who) > 1 else 1.0) if kinds else None, len(kinds), 1 - sum(mine) / len(mine) if mine else None)
    return nodes, words


def site(n, newsletter="<p>Subscribe to our weekly letter and never miss a story again</p>"):
    """Pages of a site without telling names: menus in bare divs (their items vary), a letter inside the article."""
    out, good = [], []
    for i in range(n):
        r = random.Random(i)
        menu = "".join(f"<div><a href='/{k}'>{x}</a></div>" for k, x in enumerate(r.sample("home world sports culture money travel science".split(), 4)))
        own = [" ".join(w(1000 * i + 10 * k + j) for j in range(8)) for k in range(3 + i % 4)]
        body = "".join(f"<p>{x}</p>" for x in own)
        out.append(page(f"<div><div>{menu}</div></div><article><h1>{w(i)} {w(i + 500)}</h1>{body}{newsletter}</article><div><div><span>All rights reserved by the owner of this site</span></div></div>"))
        good.append({f"{w(i)} {w(i + 500)}", *own})
    return out, good


def test_sums_and_entropies_are_by_definition(spark):
    pages, _ = site(12)
    pages += [pages[0]] * 5  # copies count once
    frame = spark.createDataFrame([("h", p) for p in pages], "host string, html string").repartition(4)
    n = frame.groupBy("html").count()
    tree = H.style_tree(frame.join(n, "html").selectExpr("host", "html", "1d / count as weight"))
    nodes, entropies = slow_tree(pages)
    got = {r["path"]: r for r in tree.collect()}
    words = [(r["path"], x["word"], x["entropy"]) for r in got.values() for x in r["repeated"] or ()]
    assert set(got) == set(nodes)
    for path, (m, presentation, kinds, content) in nodes.items():
        r = got[path]
        assert abs(r["pages"] - m) < 1e-9 and r["kinds"] == kinds
        assert presentation is None or abs(r["presentation"] - presentation) < 1e-9
        assert (content is None) == (r["content"] is None) and (content is None or abs(r["content"] - content) < 1e-9)
    want = {k: e for k, e in entropies.items() if e >= H.REPEATED and nodes[k[0]][0] >= H.MIN_PAGES}
    assert {x[:2] for x in words} == set(want) and all(abs(e - want[p, x]) < 1e-9 for p, x, e in words)


def test_the_tree_alone_cleans_sites_without_names(spark):
    """Names off: precision and recall of the blocks that stay, over sites of several sizes."""
    kept = right = wanted = taken = 0
    for n in (8, 15, 40):
        pages, good = site(n)
        frame = spark.createDataFrame([("h", p, 1.0) for p in pages], "host string, html string, weight double")
        row = H.judgements(H.style_tree(frame)).first()
        judged = H.Site(row["low"] or (), row["nodes"] or (), row["words"] or (), row["entropies"] or ())
        for p, g in zip(pages, good):
            got = [x for x in H.main_text(p, judged, names=False).split("\n") if x]
            kept, right, wanted = kept + len(got), right + len(g.intersection(got)), wanted + len(g)
            taken += len(H.blocks(p)) - len(got)
    assert right / kept >= 0.9 and right / wanted >= 0.9 and taken == 7 * 63


def test_a_letter_inside_every_article_goes(spark):
    pages, good = site(20)
    rows = spark.createDataFrame([(i, f"http://a.example/{i}", p) for i, p in enumerate(pages)], "page_id long, url string, html string")
    for r in H.extract(rows).collect():
        assert set(r["text"].split("\n")) == good[r["page_id"]]


def test_long_and_broken_pages_take_linear_time():
    import time
    parts = {"tags": "<p class=x " * 40_000, "quotes": "<a href=\"" * 40_000, "open": "<div><p>word " * 3_000, "comments": "<!-- " * 40_000, "ends": "</p></div>" * 40_000}
    for x in parts.values():
        began = time.time()
        H.main_text(x)
        assert time.time() - began < 20


def test_whole_table(spark):
    rows = {r["page_id"]: r["html"] for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()}
    got = Q.QUERIES["op8_html"](spark, "/root/testdata/sf0.01").collect()
    assert len(got) == len(rows)
    for r in got:
        inner = re.search(r"<article>(.*?)</article>", rows[r["page_id"]], re.S)[1]
        parts = [" ".join(html.unescape(re.sub(r"<[^>]+>", "", x)).split()) for x in re.split(r"</?(?:p|h1)>|<br>", inner)]
        assert r["text"] == "\n".join(x for x in parts if x)
