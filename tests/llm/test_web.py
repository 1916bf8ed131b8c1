"""Operators over pages, and the pipeline."""

import collections
import random

from helpers import SYL, awkward, empty, frame, prose

from pairforge.llm import html_extract, packing, url_filter
from pairforge.llm.queries import url_list


# 6. HTML

def page(title, paragraphs, extra="", layout="article"):
    body = "".join(f"<p>{p}</p>" for p in paragraphs)
    return (f'<!DOCTYPE html><html><head><title>{title}</title><style>p{{margin:0}}</style><script>var t="</p>";</script></head>'
            f'<body><header><h2>Site</h2></header><nav><ul><li><a href="/">Home</a></li></ul></nav><!-- ad --><div class="ad">Buy now</div>'
            f"<{layout}><h1>{title}</h1>{body}</{layout}>{extra}"
            f'<div id="comments"><p>First!</p></div><form><label>Mail</label></form><footer>&copy; site</footer></body></html>')


def test_main_text_of_awkward_pages():
    want = "T\na & b\nc d"
    html = page("T", ["a &amp; b", "c\n  d"])
    assert html_extract.main_text(html, "/html/body/article") == want
    assert html_extract.main_text(html, None) == want
    assert html_extract.main_text(html, "/html/body/div.elsewhere") == want
    cases = {
        None: "", "": "", "   ": "", "plain  text": "plain text", "<p>open<p>next <b>bold": "open\nnext bold",
        "a < b and c > d": "a < b and c > d", "x<br>y": "x\ny", "<div>a</p>b</div></div>c": "a\nb",
        "<article><p>kept<div class='sidebar'><p>gone</div><p>also</article>": "kept\nalso",
        "<main><p>m</p></main><div>much longer text that is not in the main element</div>": "m",
        "<article>a<script>if (a<b) {}</script>b</article>": "a\nb", "<p>&lt;tag&gt; &#233;&nbsp;x": "<tag> é x",
        '<article><p title="a > b">t</p></article>': "t", '<p class="open>broken</p><p>t</p>': "broken\nt",
        "<article><aside>no</aside><ul><li>one<li>two</ul></article>": "one\ntwo", "<!-- only -->": "", "<": "<",
    }
    for html, want in cases.items():
        assert html_extract.main_text(html, None) == want, html


def test_extraction_over_hosts(spark):
    rng = random.Random(5)
    rows, want = [], collections.Counter()
    hosts = ["a.example.org"] * 30 + ["b.example.org"] * 5 + ["c.example.org"]
    for i, host in enumerate(hosts):
        ps = [prose(rng, 12) for _ in range(rng.randint(1, 4))]
        layout = "div" if host.startswith("b") else "article"
        extra = f'<div class="related">{prose(rng, 60)}</div>'
        rows.append((i, f"https://{host}/{i}", page(f"T{i}", ps, extra, layout)))
        want[i, "\n".join([f"T{i}", *ps])] += 1
    for i, h in ((900, None), (901, ""), (901, "")):
        rows.append((i, None, h))
        want[i, ""] += 1
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS host", "2 AS path", "3 AS text")
    got = html_extract.extract(df).collect()
    assert collections.Counter((r.page_id, r.text) for r in got) == want
    assert all(r.n_chars == len(r.text) for r in got)
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert html_extract.extract(none).count() == 0


def test_extraction_of_articles_in_sibling_slots(spark):
    rng = random.Random(8)
    top, end = '<div class="logo">The Site</div>', '<div class="legal">All rights of this site and its many long texts</div>'
    shapes = {
        "post.example.org": '<div class="post"><h1>{}</h1><div class="intro"><p>{}</p></div><div class="body"><p>{}</p></div></div>',
        "flat.example.org": '<h1>{}</h1><div class="intro">{}</div><div class="body"><p>{}</p></div>',
        "apart.example.org": '<div id="page"><div class="title"><h1>{}</h1></div><div class="lead">{}</div><div class="text"><p>{}</p></div></div>',
        "alone.example.org": '<div class="box"><h1>{}</h1><div class="a">{}</div><div class="b"><p>{}</p></div></div>',
    }
    rows, want = [], {}
    for host, shape in shapes.items():
        for i in range(1 if host.startswith("alone") else 6):
            parts = [prose(rng, n) for n in (3, 10, 80)]
            sides = host.startswith(("post", "apart"))
            related = f'<div class="related">{prose(rng, 200)}</div>'
            body = (top if sides else "") + shape.format(*parts) + related + (end if sides else "")
            rows.append((len(rows), f"https://{host}/{i}", f"<html><body>{body}</body></html>"))
            want[rows[-1][0]] = "\n".join(parts)
    for _ in range(3):  # the same page again and again
        rows.append((len(rows), "https://same.example.org/", "<html><body>" + shapes["post.example.org"].format("T", "A", "B") + "</body></html>"))
        want[rows[-1][0]] = "T\nA\nB"
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r.page_id: r.text for r in html_extract.extract(df).collect()} == want
    assert html_extract.main_text("<body>" + shapes["alone.example.org"].format("T", "A", "B") + "</body>", "/elsewhere") == "T\nA\nB"


# 9. URLs

RULES = {"org/": "allow", "example.org/es/": "block", "example.org/en/1": "block", "com/fr/": "allow", "com/de/": "block"}


def brute_url(url):
    if not url or "://" not in url:
        return "", "", None, "allow"
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:].split("?")[0].split("#")[0]

    def fits(key):
        h, _, p = key.partition("/")
        return (host == h or host.endswith("." + h)) and path.startswith("/" + p)

    own = [r for r in RULES if fits(r)]
    if own:
        return host, path, max(own, key=len), RULES[max(own, key=len)]
    return host, path, None, "block" if any(fits(h + "/") for h in url_filter.SPAM_HOSTS) else "allow"


def test_urls(spark):
    rng = random.Random(1)
    urls = [None, "", "no scheme", "://", "http://", "http://org", "http://org/", "HTTP://WWW.Example.ORG/es/x?y#z", "http://example.org/es",
            "http://xexample.org/en/12", "http://a.b.example.org/en/1", "ftp://x.com/fr/a://b/de/", "http://x.com?/de/", "http://com/de/",
            "http://m.free-bets.example.com/en/", "http://m.free-bets.example.com", "http://é.com/fr/", "http://a..org/", "http://x.com/de/\n#"]
    urls += ["".join(rng.choice(["http://", "https://"]) + ".".join(rng.choices(["a", "example", "org", "com", "free-bets"], k=3)) + "/" + rng.choice(
        ["es/", "en/1", "fr/", "de/", ""]) + str(rng.randint(0, 99)) for _ in range(1)) for _ in range(300)]
    rows = [(i % 200, u) for i, u in enumerate(urls)]
    df = spark.createDataFrame(rows, "page_id long, url string").selectExpr("*", "'x' AS key", "'y' AS best")
    for options in ({}, {"max_blocks": 1, "bits_per_key": 1, "k": 1}):  # the second filter lets nearly all pass
        got = url_filter.judge(df, url_list(spark), **options).collect()
        assert collections.Counter((r.page_id, r.host, r.path, r.rule, r.verdict) for r in got) == collections.Counter(
            (i, *brute_url(u)) for i, u in rows)
    none = spark.createDataFrame([], "page_id long, url string")
    assert url_filter.judge(none, url_list(spark)).count() == 0
    nothing = url_filter.judge(df, url_list(spark).limit(0))
    assert {r.verdict for r in nothing.collect()} == {"allow"}


def test_bloom_filter_has_no_false_negative(spark):
    keys = spark.range(500).selectExpr("concat('k', id) AS key")
    words = url_filter.bloom_words(keys, 16, 6)
    F = url_filter.F
    probe = spark.range(5000).selectExpr("concat('k', id) AS key", "id < 500 AS listed")
    hit = probe.groupBy("listed", url_filter.might_hold(words, F.col("key"), 16, 6).alias("hit")).count().collect()
    found = {(r.listed, r.hit): r["count"] for r in hit}
    assert (True, False) not in found and found[True, True] == 500
    assert found.get((False, True), 0) < 900


# The pipeline, stage by stage against brute force

def test_pipeline(spark, tmp_path):
    import corpus_pipeline as cp
    from test_dedup import brute_classes, brute_fp, brute_removed
    from test_texts import base, check_packing

    rng = random.Random(12)
    rows = [r for r in awkward() if r[0] not in (None, 12)]
    rows += [(100 + i, prose(rng, 140)) for i in range(60)]
    passage = prose(rng, 60)
    rows += [(200 + i, prose(rng, 70) + " " + passage + " " + prose(rng, 50)) for i in range(6)]
    rows += [(300 + i, rows[20 + i][1]) for i in range(10)]
    # a small corpus tells junk by its vocabulary only if that recurs
    junk = [f"spam{i}###" for i in range(12)]
    rows += [(400 + i, " ".join(rng.choices(junk, k=120))) for i in range(8)]
    rows += [(500, prose(rng, 80) + ' token = "abcdef0123456789" ' + prose(rng, 80))]
    docs = frame(spark, rows, clash=True).withColumn("n_chars", url_filter.F.length("text").cast("long"))
    labels = spark.createDataFrame([(i, 1, 0) for i, _ in rows if 100 <= i < 160], "doc_id long, quality int, toxic int")
    sf = str(tmp_path)
    docs.coalesce(1).write.parquet(f"{sf}/documents.parquet")
    labels.write.parquet(f"{sf}/labels.parquet")
    now = cp.table(spark, sf, "documents")
    texts = dict(rows)
    out = {}
    for name, stage in cp.STAGES:
        now = cp.spill_table(stage(spark, now, sf), "test-stage")
        out[name] = now
        if name != cp.STAGES[-1][0]:
            assert now.columns == docs.columns
    kept = {r.doc_id: r.text for r in out["quality rules"].collect()}
    assert {i for i in kept} == {i for i, t in rows if not base(t)[-1] and not (400 <= i < 408)}
    ids = sorted(kept)
    top = brute_classes([brute_fp(kept[i]) for i in ids], 4)
    one = sorted({min(ids[j] for j in range(len(ids)) if top[j] == c) for c in set(top)})
    assert sorted(r.doc_id for r in out["SimHash near-dedup"].collect()) == one
    data = [texts[i].encode() for i in one]
    left = {}
    for i, b, g in zip(one, data, brute_removed(data, 100)):
        t, at, s = texts[i], 0, ""
        for ch in t:
            n = len(ch.encode())
            s += "" if all(g[at:at + n]) else ch
            at += n
        left[i] = s
    got = {r.doc_id: (r.text, r.n_chars) for r in out["suffix-array dedup"].collect()}
    assert got == {i: (s, len(s)) for i, s in left.items()}
    clean = {r.doc_id: r.text for r in out["secret scans"].collect()}
    assert clean == {i: s.replace('token = "abcdef0123456789"', 'token = "[SECRET]"') for i, s in left.items()}
    check_packing(list(clean.items()), out["best-fit packing"].collect(), 2048)
    assert cp.run(spark, sf).count() == out["best-fit packing"].count()


def blog_page(i, rng):
    body = [prose(rng, 30) for _ in range(rng.randint(2, 4))]
    page = (f'<html><body class="page-id-{i}"><div class="top">Site {i % 3} slogan</div><article id="post-{i}" class="post-{i} hentry"><h1>Title {i}</h1>'
            + "".join(f"<p>{b}</p>" for b in body) + f'</article><div class="latest"><p>Latest: {prose(rng, 12)}</p></div></body></html>')
    return page, "\n".join([f"Title {i}", *body])


def test_article_pages_with_ids_of_their_own(spark):
    rng = random.Random(12)
    made = {i: blog_page(i, rng) for i in range(20)}
    lone = {100 + i: blog_page(100 + i, rng) for i in range(3)}  # a host without a template of its own
    rows = [(i, f"http://blog.example/{i}", h) for i, (h, _) in made.items()] + [(i, f"http://h{i}.example/", h) for i, (h, _) in lone.items()]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_extract.extract(df).collect()}
    assert got == {i: t for i, (_, t) in {**made, **lone}.items()}


def test_broken_and_deep_pages_take_linear_time():
    import time
    pages = ["<a " * 330_000, "<" * 1_000_000, "<div>" * 20_000 + "x" + "</p>" * 20_000, "<a '" * 250_000 + ">", "<!x" * 300_000, '<a ">' * 200_000,
             "<div>" * 20_000 + "deep text" + "</div>" * 20_000, "<p>" * 100_000 + "y"]
    for page in pages:
        t = time.time()
        html_extract.parse(page)
        assert time.time() - t < 5, page[:20]
    assert [t for _, _, t in html_extract.parse(pages[6])[0]] == ["deep text"]
    assert [t for _, _, t in html_extract.parse("<p title='a>b'>one</p><p title=\"open>two</p><!-- > x --> three <b>four</b> < five")[0]] == ["one", "two", "three four < five"]


def test_pipeline_of_nothing(spark):
    import corpus_pipeline as cp

    none = empty(spark).selectExpr("*", "'en' AS lang", "'s' AS source", "0L AS n_chars")
    for _, stage in cp.STAGES[1:]:
        assert stage(spark, none, "").count() == 0
    assert packing.pack_documents(none).count() == 0 and SYL
