import html as H
import json
import random

import pytest
import xxhash
from llm_data import pages

from stockgap.llm import html, queries

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu".split()


def _page(i, article, nav="Home Products About", extra=""):
    return (f'<!DOCTYPE html><html><head><title>T{i}</title><style>p{{}}</style><script>var a="</p><p>no";</script></head><body>'
            f'<header><h2>Site</h2></header><nav><ul>{"".join(f"<li>{x}" for x in nav.split())}</ul></nav><!-- ad <p>x</p> -->'
            f'<div class="ad-slot">Buy now {i}</div>{article}<aside>Popular {i}</aside>{extra}<footer>&copy; host</footer></body></html>')


def _text(i, n=3):
    return [" ".join(WORDS[(i * 7 + k + j) % len(WORDS)] for j in range(4 + k)) + f" {i}" for k in range(n)]


def _got(spark, rows):
    return {r.page_id: r.text for r in html.extract(pages(spark, rows)).collect()}


def test_articles_without_their_surroundings(spark):
    rows, want = [], {}
    for i in range(12):
        p = _text(i)
        inner = f"<h1>Title &amp; {i}</h1><p><b>{p[0]}<br><p>{p[1]}</p>\n <p>  {p[2]}&nbsp;&lt;x&gt; </p>"
        comments = "<section class='comments'><article class='comment'><p>First! " + "long comment " * 60 + "</p></article></section>"
        rows.append((i, f"https://h{i % 2}.example/{i}", _page(i, f"<article>{inner}{comments}</article>", extra="<form>Your mail <input></form>")))
        want[i] = f"Title & {i} {p[0]} {p[1]} {p[2]} <x>"
    assert _got(spark, rows) == want


def test_wrapper_finds_content_where_tags_say_nothing(spark):
    rows, want = [], {}
    for i in range(6):
        p = _text(i)
        body = f"<div><div>The Daily Bugle</div><div>Call 555-1234</div><div><h1>{p[0]}</h1><p>{p[1]}</p><p>{p[2]}</p></div><div>Made with care</div></div>"
        rows.append((i, "http://plain.example/a?i=%d" % i, f"<html><body>{body}</body></html>"))
        want[i] = " ".join(p)
    assert _got(spark, rows) == want


def test_paragraphs_that_a_host_shares_stay(spark):
    rows = [(i, "http://s.example/x", _page(i, f"<article><h1>Own {i}</h1><p>The very same passage everywhere.</p><p>{' '.join(_text(i))}</p><div>Share this story</div></article>")) for i in range(5)]
    got = _got(spark, rows)
    assert all(got[i] == f"Own {i} The very same passage everywhere. {' '.join(_text(i))}" for i in range(5))


def test_copies_of_a_page_are_no_template(spark):
    one = _page(1, "<article><p>Only one article here</p></article>")
    got = _got(spark, [(i, "http://c.example/", one) for i in range(6)])
    assert set(got.values()) == {"Only one article here"}


def test_nulls_empty_broken_and_long_pages(spark):
    long = _page(0, "<article>" + "<p>word</p>" * 20_000 + "</article>")
    rows = [(1, None, None), (2, "x", ""), (3, None, "just <b>te</b>xt &amp; more"), (4, "u", "<p>a<p>b</div></b><i>c"), (5, "u", "<script>x"), (6, "u", "<article><!-- open"),
            (7, "u", "<"), (8, "u", "a < b <c"), (None, "u", "<main>q</main>"), (9, "u", long), (9, "u", long), (10, "u", '<p title="a > b">t</p>'), (11, "u", '<p title="a>t</p>')]
    got = {r.page_id: r.text for r in html.extract(pages(spark, rows)).collect()}
    assert (got[1], got[2], got[3], got[4], got[5], got[6], got[7]) == ("", "", "just text & more", "a bc", "", "", "<")
    assert got[8].startswith("a < b") and got[None] == "q" and got[9] == " ".join(["word"] * 20_000) and got[10] == "t" and "t" in got[11]
    assert html.extract(pages(spark, [])).count() == 0


@pytest.mark.parametrize("markup,want", [
    ("<ul><li>a<li>b</ul>", "a b"), ("<table><tr><td>a<td>b<tr><td>c</table>", "a b c"), ("<p>x<div>y</div>z", "x y z"), ("<b>x<p>y</b>z", "x yz"),
    ("<em>a</em><em>b</em> c", "ab c"), ("a<br/>b<hr>c", "a b c"), ("<p hidden>no</p>yes", "yes"), ("<div style='display: none'>no</div>yes", "yes"), ("&#65;&eacute;&copy;", "Aé©")])
def test_markup(markup, want):
    assert html.text_in(html.parse(f"<article>{markup}</article>")) == want


def test_tree_matching_against_brute_force():
    import random
    rng = random.Random(1)

    def grow(depth):
        return (rng.choice("ab"), [grow(depth - 1) for _ in range(rng.randrange(0, 4) if depth else 0)])

    def flat(t):
        labels, kids = [], []

        def add(x):
            i = len(labels)
            labels.append(x[0])
            kids.append([])
            kids[i] = [add(c) for c in x[1]]
            return i
        add(t)
        return labels, kids

    def brute(a, b):
        if a[0] != b[0]:
            return 0

        def seq(x, y):
            return 0 if not x or not y else max(seq(x[1:], y), seq(x, y[1:]), brute(x[0], y[0]) + seq(x[1:], y[1:]))
        return 1 + seq(a[1], b[1])
    for _ in range(200):
        a, b = grow(2), grow(2)
        pairs = html.tree_match(flat(a), flat(b))
        assert len(pairs) == len({i for i, _ in pairs}) == len({j for _, j in pairs}) == brute(a, b)


def test_entities_are_decoded_once(spark):
    assert _got(spark, [(1, "u", "<article>" + H.escape("&amp; <b>") + "</article>")])[1] == "&amp; <b>"


def test_every_layout_of_a_host_has_a_wrapper(spark):
    rows, want = [], {}
    for i in range(30):
        p = _text(i)
        menu, tail = [("Start Shop Basket", "All rights with us"), ("Latest Sport Weather", "Printed daily"), ("Rooms Prices", "Call 555-1234")][i % 3]
        tag = ["div", "section", "center"][i % 3]
        varying = "".join(f"<div><p>{p[2]} {k}</p></div>" for k in range(i % 5))
        rows.append((i, f"http://many.example/{i}", f"<html><body><{tag}><{tag}>{menu}</{tag}><{tag}><h1>{p[0]}</h1><p>{p[1]}</p>{varying}</{tag}><{tag}>{tail}</{tag}></{tag}></body></html>"))
        want[i] = " ".join([p[0], p[1], *[f"{p[2]} {k}" for k in range(i % 5)]])
    assert _got(spark, rows) == want


def test_what_some_near_copies_share_is_no_template(spark):
    rows, want = [], {}
    for i in range(12):
        p = _text(i)
        shared = "This long report went out to several papers." if i < 5 else p[2]
        rows.append((i, f"http://near.example/{i}", f"<html><body><div>Our paper</div><div><h1>{p[0]}</h1></div><section>{shared}</section></body></html>"))
        want[i] = f"{p[0]} {shared}"
    assert _got(spark, rows) == want


@pytest.mark.parametrize("body,want", [
    ("<article><p>one</p></article><div><article><p>two is longer</p></article></div><article>three</article>", "one two is longer three"),
    ("<main><h1>Head</h1><p>lead</p><article><p>body</p></article><p>end</p></main>", "Head lead body end"),
    ("<article>a</article><main><p>b</p></main><article>c</article>", "a b c"),
    ("<main><article>a</article><article class='comment'>no</article><section class=related><article>no</article></section></main>", "a"),
    ("<article>a<article class='comment'>no</article></article><aside><article>no</article></aside>", "a"),
    ("<div class=main>m</div><p>n</p>", "m")])
def test_all_articles_in_page_order(body, want):
    assert html.main_text(f"<html><body><nav>menu</nav>{body}<footer>f</footer></body></html>") == want


@pytest.mark.parametrize("body,want", [
    ('<p>One</p><h2 id="how-to-search-files">How to search files</h2><p>Two</p>', "One How to search files Two"),
    ('<section id="share-prices"><p>Up</p></section><section id="replies"><p>All of them</p></section>', "Up All of them"),
    ('<div class="share-prices">Up</div><p class="notice">Note</p><li class="related">item</li>', "Up Note item"),
    ('a<div class="ad-slot">x</div><div class="related-posts">y</div><section id="comments">z</section><div class="search box">w</div>b', "a b"),
    ('<ul class="comment-list"><li class="comment"><p>no</p></ul><div class="newsletter-signup">no</div>yes', "yes")])
def test_names_take_only_containers_out_of_an_article(body, want):
    assert html.main_text(f"<article>{body}</article>") == want


def test_only_alignment_tells_menu_from_content(spark):
    """Menu and content have the same path, and some articles say what the menu says: the place decides, not the text."""
    rows, want = [], {}
    for i in range(12):
        said = "Home and about" if i % 4 == 0 else " ".join(_text(i))
        note = f"<div>Only today {i}</div>" if i % 3 == 0 else ""
        rows.append((i, f"http://al.example/{i}", f"<html><body><div>Home and about</div><div>{said}</div>{note}<table><tr><td>Printed daily</table></body></html>"))
        want[i] = said + (f" Only today {i}" if i % 3 == 0 else "")
    assert _got(spark, rows) == want


def _brute_wrapper(rows, least=html.LEAST):
    """Template by plain loops over all pages: places by matching each tree to its layout's frame."""
    from collections import Counter, defaultdict
    hosts = defaultdict(dict)
    for _, url, source in rows:
        hosts[(url or "").split("/")[2].lower() if "//" in (url or "") else ""].setdefault(source or "", html.digest(source or ""))
    constant = {}
    for h, found in hosts.items():
        layouts, shapes = defaultdict(list), defaultdict(list)
        for source, d in found.items():
            layouts[d[0]].append(d)
            shapes[d[1]].append((source, d))
        n, total, place = Counter(), Counter(), {}
        first = {s: min(own, key=lambda x: html_hash(x[0]))[1] for s, own in shapes.items()}
        for s, d in first.items():
            labels, kids = json.loads(d[2])
            place[s] = html._paths(labels, kids)
            frame = max({x[1] for x in layouts[d[0]]}, key=lambda t: (len(shapes[t]), t))
            if len(layouts[d[0]]) >= least:
                for i, j in html.tree_match((labels, kids), tuple(json.loads(first[frame][2])), (d[3], first[frame][3])):
                    place[s][i] = ("frame", d[0], j)
            for p in set(place[s]):
                total[p] += len(shapes[s])
            at = defaultdict(Counter)
            for _, x in shapes[s]:
                for i in {i for c in x[5] for i in c}:
                    at[i][x[3][i]] += 1
            best = Counter()
            for i, c in at.items():
                for says, k in c.items():
                    best[place[s][i], says] = max(best[place[s][i], says], k)
            n.update(best)
        good = {p for p, k in n.items() if k >= least and 2 * k > total[p[0]]}
        constant[h] = (place, good)
    out = {}
    for i, url, source in rows:
        h = (url or "").split("/")[2].lower() if "//" in (url or "") else ""
        d = html.digest(source or "")
        place, good = constant[h]
        keep = [x for x, c in zip(d[4], d[5]) if not any((place[d[1]][k], d[3][k]) in good for k in c)]
        out[i] = " ".join("".join(keep).split())
    return out


def html_hash(source):
    return xxhash.xxh64(source.encode(), seed=42).intdigest() - (1 << 64) * (xxhash.xxh64(source.encode(), seed=42).intdigest() >> 63)


def test_wrappers_against_brute_force(spark):
    rng, rows = random.Random(8), []
    for i in range(90):
        boxes = [f"<div>{rng.choice(['Start Shop', 'Start Shop', 'News'])}</div>", f"<div class=x>{' '.join(rng.choices(WORDS, k=3))}</div>",
                 f"<div>{rng.choice(['Printed daily', 'Start Shop'])}<span>{rng.choice('ab')}</span></div>", "<section><p>Same</p><div>Call us</div></section>"]
        body = "".join(rng.sample(boxes, rng.randrange(1, 5)) if i % 3 else boxes)  # every order and number of boxes
        if i % 5 == 0:
            body = f"<article><div>Share</div>{body}</article>"
        rows.append((i, f"http://h{min(i % 7, 3)}.example/{i}", f"<html><body>{body}</body></html>"))
    rows += [(100, None, "<div>x"), (101, None, None), (102, "http://H1.example", rows[1][2])]
    assert _got(spark, rows) == _brute_wrapper(rows)


def test_deep_pages_and_registered_query(spark, tmp_path):
    rows = [(i, "http://d.example/", "<div>" * 300 + f"deep {i}" + "</div>" * 300 + "<div>end</div>") for i in range(4)]
    pages(spark, rows).select("page_id", "url", "html").write.parquet(f"{tmp_path}/pages.parquet")
    got = queries.QUERIES["op4_html"](spark, str(tmp_path))
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted((r.page_id, r.text, r.n_chars) for r in got.collect()) == [(i, f"deep {i}", 6) for i in range(4)]
