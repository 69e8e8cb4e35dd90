import random

from pathweave.llm import html_text
from tests.llm.helpers import table

PAGES = "page_id long, url string, html string, text int"


def extract(spark, rows, **more):
    df = spark.createDataFrame([(*r, 1) for r in rows], PAGES)
    return {r.page_id: r.text for r in html_text.extract(df, **more).collect()}


def test_article_by_structure(spark):
    page = """<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{}</style><script>var a="</p>";</script></head><body>
    <header>Site</header><nav><ul><li>Home</li></ul></nav><div class="cookie-notice">We use cookies</div><!-- <p>no</p> -->
    <article><header><h1>Head&nbsp;line</h1><span>By X</span></header><p>One
      two<br>three &lt;b&gt; &#8364;&copy</p><P>Four <b>bold <i>x</P><div class=ad>Buy</div><aside>Side</aside><form><input>Send</form>
    <p hidden>gone</p><p title="a > b">Five</p><table><tr><td>a</td><td>b</td></tr></table><footer>Share</footer>
    <section class="comments"><p>Nice!</p></section></article><div id="sidebar">Links</div><footer>(c)</footer></body></html>"""
    got = extract(spark, [(1, "http://a.b/x", page)])
    assert got[1] == "Head line\nOne two three <b> €©\nFour bold x\nFive\na b"


def test_odd_pages_repeats_and_no_rows(spark):
    rows = [(1, None, None), (2, "http://h/", ""), (3, "nonsense", "plain & simple <"), (4, "http://h/", "<article><p>cut of&am"), (5, "http://h/", "<article><p>x <a href=\"y"),
            (6, "http://h/", "<article>" + "<p>word " * 30_000), (None, "http://h/", "<main>m</main>"), (7, "u", "<article>d"), (7, "u", "<article>d"), (8, "u", "<script>never closed")]
    got = extract(spark, rows)
    assert [got[i] for i in (1, 2, 3, 4, 5, None, 7, 8)] == ["", "", "plain & simple <", "cut of&am", "x", "m", "d", ""]
    assert got[6] == "\n".join(["word"] * 30_000)
    assert extract(spark, []) == {}


def test_runs_that_a_host_repeats(spark):
    random.seed(1)
    word = lambda: f"w{random.randrange(10**6)}"
    chrome = [word() for _ in range(12)]
    rows, want = [], {}
    for i in range(60):
        own = [word() for _ in range(30)]
        shared = chrome if i % 2 else chrome[:5]
        rows.append((i, f"https://host{i // 30}.example/{i}", f"<div>{' '.join(shared)}</div><div>{' '.join(own)}</div>"))
        want[i] = " ".join(own) if i % 2 else " ".join(shared) + "\n" + " ".join(own)
    rows.append((99, "https://alone.example/", f"<div>{' '.join(chrome)}</div>"))
    rows.append((99, "https://alone.example/", f"<div>{' '.join(chrome)}</div>"))
    want[99] = " ".join(chrome)
    assert extract(spark, rows) == want
    assert extract(spark, rows, pages_each=7) == want  # the same from several suffix arrays


def test_suffix_array_against_brute_force():
    random.seed(2)
    streams = [[random.choice("abc") for _ in range(random.randrange(40))] for _ in range(30)]
    for run in (1, 2, 5, 8):
        order, classes = html_text.suffix_classes(streams, run)
        flat = [(p, s) for p, x in enumerate(streams) for s in range(len(x))]
        window = lambda i: tuple(streams[flat[i][0]][flat[i][1]:flat[i][1] + run])
        assert sorted(order.tolist()) == [i for i in range(len(flat)) if len(window(i)) == run]
        of = {}
        for i, c in zip(order.tolist(), classes.tolist()):
            assert of.setdefault(c, window(i)) == window(i)
        assert len(of) == len(set(of.values()))


def test_every_page_of_the_table(spark):
    df = table(spark, "pages")
    got = {r.page_id: r for r in html_text.extract(df).collect()}
    assert len(got) == df.count() and all(r.n_chars == len(r.text) > 0 for r in got.values())


def test_articles_in_forms_and_marked_containers(spark):
    body = "<p>One two</p><p>three four</p>"
    rows = [
        (1, f"<form><article>{body}<form>Send</form></article></form>"), (2, f"<form>{body}</form>"), (3, f"<form>{body}</form><p>(c)</p>"),
        (4, f"<div class='layout-with-sidebar'>{body}</div>"), (5, f"<div class='no-sidebar has-header' id='search-results'>{body}</div>"),
        (6, f"<div class='sidebar'><main>{body}<aside>x</aside><div class=ad>Buy</div></main></div>"), (7, f"<div id='search'>{body}</div>"),
        (8, f"<article>{body}<section class=comments><article>Nice</article></section></article><aside class=related><article>More</article></aside>"),
        (9, f"<nav><p>Home</p></nav><div class='site-footer'>x</div><div class='article-header'><h1>Head</h1></div>{body}"),
    ]
    got = extract(spark, [(i, f"http://h{i}/", page) for i, page in rows])
    text = "One two\nthree four"
    assert got == {i: "Head\n" + text if i == 9 else text for i, _ in rows}


def test_copies_and_rare_runs_stay(spark):
    random.seed(3)
    words = lambda n: " ".join(f"w{random.randrange(10**6)}" for _ in range(n))
    chrome, quote = words(10), words(12)
    rows, want = [], {}
    for i in range(16):
        own = words(40)
        for at, copy in ((i, ""), (100 + i, "print/"), (200 + i, "mobile/")):  # each text at three addresses
            extra = f"<p>{quote}</p>" if i < 2 else ""
            rows.append((at, f"http://h.example/{copy}{i}", f"<div>{chrome}</div><div>{own}</div>{extra}"))
            want[at] = own + (f"\n{quote}" if extra else "")
    two = words(30)
    rows += [(300, "http://two.example/a", f"<div>{two}</div>"), (301, "http://two.example/print/a", f"<div>{two}</div>")]
    want |= {300: two, 301: two}
    assert extract(spark, rows) == want
    assert extract(spark, rows, share=2.0)[0] == f"{chrome}\n{want[0].split(chr(10))[0]}\n{quote}"  # no run is common enough
