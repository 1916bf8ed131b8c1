"""Operator 6, HTML extraction by equivalence-class template deduction.

Tokens are elements qualified by their path of containers (tag, id and classes).
Over the pages of a host each token has an occurrence vector, its count on every
page; vectors are compared by an order-free signature (a sum of hashes of page and
count), so a host with a third of all pages is one pre-aggregated row per token.
Tokens with one signature form an equivalence class; a class is valid if it is
frequent (on at least ``support`` of the host's pages) and large (``size`` tokens or
more).  Paths nest the valid classes into the host's template.  Hosts of fewer than
``pages`` pages have no vectors to compare and use the template of the whole table.

What is between template tokens are slots, named by the innermost template element
around them.  The host's main slot is the one with the most text outside menus,
headers, footers, sidebars, notices, adverts, forms and comments, an article or main
element before others.  Without such an element an article's title, intro and body may
be slots of their own, so the main slot is widened to the lowest template element
around it and around all other slots with such text on ``support`` of the pages; slots
that hold the same text on every page are template and do not widen it, unless all do.
A page's text is all that its main slot holds outside menus and the like; a page without
text there (another layout) takes its own article or main element, else the lowest
element around all containers of such text.

Blocks are the runs of text between block elements or line breaks; character
references are decoded, white space in a block becomes one blank, blocks are joined
in page order by one newline.

Edge cases: a null or empty page, or one without text, gives an empty text; unclosed
and stray tags are tolerated (end of page closes all); equal pages give equal texts;
ties between slots go to the first path in order; numbers in ids and classes are taken for one number, so
``post-12`` and ``post-13`` are one token; containers nested deeper than ``DEPTH`` count with the last one above,
their text stays; pages are lexed in one pass, broken tags and quotes included; an empty table gives an empty one;
other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from html import unescape

from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from pairforge.llm.common import pin, text_batches
from pairforge.llm.url_filter import url_host

_RAW = ("script", "style", "textarea", "title", "noscript", "template", "iframe", "svg", "noframes", "xmp")
_NAME = re.compile(r"<(/?)([A-Za-z][A-Za-z0-9:-]*)")
_MARK = re.compile(r"[\"'>]")
_DIGITS = re.compile(r"[0-9]+")
#: Containers nested deeper take the path of the last one that counts; their text stays.
DEPTH = 64
_ATTRIBUTE = re.compile(r"([A-Za-z_:][\w:.-]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rb rt rp s "
                    "samp small span strike strong sub sup time tt u var wbr img".split())
#: Blocks that hold running text; what is inside belongs to the container around them.
_LEAF = frozenset("p h1 h2 h3 h4 h5 h6 li ul ol dl dt dd blockquote pre table thead tbody tfoot tr td th caption "
                  "figure figcaption address details summary center".split())
_CLOSES_P = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl table blockquote pre div section article aside header footer nav main "
                      "form hr address figure".split())
_SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
             "th": ("td", "th"), "option": ("option",)}
_DROP = frozenset("head nav footer aside form button select option input datalist fieldset menu dialog object applet "
                  "audio video canvas map".split()) | frozenset(_RAW)
_DROP_ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar toolbar".split())
_DROP_WORDS = frozenset("""ad ads advert adverts advertisement advertising adsense promo promoted promotion sponsor sponsored
    sponsors nav navbar navigation menu menus topmenu breadcrumb breadcrumbs sidebar sidebars footer foot notice notices
    cookie cookies consent gdpr banner popup modal overlay alert comment comments commentlist disqus replies reply respond
    share sharing social related recommended subscribe newsletter signup login search widget widgets pagination pager
    masthead""".split())
_WORDS = re.compile(r"[a-z]+")


def _attributes(raw: str) -> dict[str, str]:
    return {m[1].lower(): unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(raw)} if raw.strip() else {}


def _is_boilerplate(tag: str, attrs: dict[str, str], in_article: bool) -> bool:
    if tag in _DROP or tag == "header" and not in_article or "hidden" in attrs or attrs.get("aria-hidden") == "true":
        return True
    if attrs.get("role", "").lower() in _DROP_ROLES or "display:none" in attrs.get("style", "").replace(" ", "").lower():
        return True
    names = f"{attrs.get('class', '')} {attrs.get('id', '')}".lower()
    return tag not in ("html", "body", "article", "main") and not _DROP_WORDS.isdisjoint(_WORDS.findall(names))


class _Lexer:
    """Tags of a page in one forward pass; what was found to be missing further on is not sought again."""

    def __init__(self, html: str):
        self.html, self.last = html, html.rfind(">")
        self.missing = set()  # quotes that do not occur from here on

    def tag(self, lt: int):
        """(end, closing, name, attributes) of the tag at ``lt``; no name for comments and declarations; None for text."""
        html = self.html
        if html.startswith("<!--", lt):
            end = html.find("-->", lt + 4)
            return (end + 3 if end >= 0 else len(html)), "", "", ""
        if lt > self.last:
            return None
        if html[lt + 1] in "!?":
            return html.find(">", lt) + 1, "", "", ""
        m = _NAME.match(html, lt)
        if not m:
            return None
        at = m.end()
        while True:
            mark = _MARK.search(html, at)  # there is a ">" further on
            if mark[0] == ">":
                end = mark.start()
                break
            close = -1 if mark[0] in self.missing else html.find(mark[0], mark.end())
            if close < 0:
                self.missing.add(mark[0])
            if close < 0 or close > self.last:  # an open quote does not count
                end = html.find(">", m.end())
                break
            at = close + 1
        return end + 1, m[1], m[2].lower(), html[m.end():end]


def parse(html: str) -> tuple[list[tuple[str, bool, str]], dict[str, int]]:
    """Blocks (container path, boilerplate, text) in page order, and how often each container path is opened."""
    blocks: list[tuple[str, bool, str]] = []
    opened: dict[str, int] = {}
    stack: list[tuple[str, str, bool, bool, int]] = []  # (tag, path, boilerplate, in article, containers)
    run: list[str] = []

    def flush():
        if run:
            text = " ".join("".join(run).split())
            run.clear()
            if text:
                top = stack[-1] if stack else ("", "", False, False, 0)
                blocks.append((top[1], top[2], text))

    def close(to: int):
        flush()
        open_tags.subtract(x[0] for x in stack[to:])
        del stack[to:]

    lexer, open_tags = _Lexer(html), Counter()
    at, n = 0, len(html)
    while at < n:
        lt = html.find("<", at)
        if lt < 0:
            run.append(unescape(html[at:]))
            break
        if lt > at:
            run.append(unescape(html[at:lt]))
        found = lexer.tag(lt)
        if not found:
            run.append("<")
            at = lt + 1
            continue
        at, closing, tag, raw = found
        if not tag:
            continue  # comment or declaration
        if closing:
            if tag in _INLINE:
                continue
            if tag == "br":
                flush()
            if not open_tags[tag]:
                flush()
                continue
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    close(i)
                    break
            continue
        if tag in _RAW:
            end = re.compile(rf"</{tag}\s*>", re.I).search(html, at)
            at = end.end() if end else n
            if tag not in ("svg",):
                flush()
            continue
        if tag in _INLINE:
            continue
        flush()
        if tag in _VOID:
            continue
        if tag in _CLOSES_P and open_tags["p"] > 0:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == "p":
                    close(i)
                    break
                if stack[i][0] not in _LEAF or stack[i][0] in ("td", "th", "li"):
                    break
        for sibling in _SIBLINGS.get(tag, ()):
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == sibling:
                    close(i)
                    break
                if stack[i][0] in ("ul", "ol", "dl", "table", "select") or stack[i][0] not in _LEAF:
                    break
        _, path, dropped, article, depth = stack[-1] if stack else ("", "", False, False, 0)
        attrs = _attributes(raw)
        dropped = dropped or _is_boilerplate(tag, attrs, article)
        if tag not in _LEAF:
            own = tag + "".join("." + c for c in sorted(attrs.get("class", "").split())) \
                + ("#" + attrs["id"] if attrs.get("id") else "")
            if depth < DEPTH:  # numbers in names are a page's own (post-12), not the template's
                path = f"{path}/{_DIGITS.sub('0', own.replace('/', '_'))}"
            opened[path] = opened.get(path, 0) + 1
            depth += 1
        open_tags[tag] += 1
        stack.append((tag, path, dropped, article or tag in ("article", "main"), depth))
    flush()
    return blocks, opened


def _weight(path: str) -> int:
    """An article goes before a main element, and this before all others."""
    tags = {re.split("[.#]", t, maxsplit=1)[0] for t in path.split("/")}
    return 2 if "article" in tags else 1 if "main" in tags else 0


def article_root(path: str) -> str:
    """``path`` up to its outermost article, else main element, else the whole."""
    for tag in ("article", "main"):
        parts = path.split("/")
        for i, p in enumerate(parts):
            if re.split("[.#]", p, maxsplit=1)[0] == tag:
                return "/".join(parts[:i + 1])
    return path


def _within(path: str, root: str) -> bool:
    return path == root or path.startswith(root + "/")


def main_text(html: str | None, slot: str | None) -> str:
    """Text of the main slot, or of the page's own best slot where that holds none."""
    if not html:
        return ""
    blocks = [(p, t) for p, dropped, t in parse(html)[0] if not dropped]
    inside = [(p, t) for p, t in blocks if slot is not None and _within(p, slot)]
    own = [t for _, t in inside]
    if inside and not _weight(slot) and any(_weight(p) == 2 for p, _ in inside):
        # the template knows no article, but the page has one: that goes before the rest of the slot
        mass: dict[str, int] = {}
        for p, t in inside:
            if _weight(p) == 2:
                mass[article_root(p)] = mass.get(article_root(p), 0) + len(t)
        best = max(sorted(mass), key=mass.__getitem__)
        own = [t for p, t in inside if article_root(p) == best]
    if not own and blocks:
        mass: dict[str, int] = {}
        for p, t in blocks:
            mass[article_root(p)] = mass.get(article_root(p), 0) + len(t)
        best = max(sorted(mass), key=lambda p: (_weight(p), mass[p]))
        if _weight(best):
            own = [t for p, t in blocks if article_root(p) == best]
        else:  # the lowest element around all containers
            paths = [p.split("/") for p in mass if p] or [[""]]
            low, high = min(paths), max(paths)
            same = next((i for i, (x, y) in enumerate(zip(low, high)) if x != y), min(len(low), len(high)))
            own = [t for p, t in blocks if _within(p, "/".join(low[:same]))]
    return "\n".join(own)


def main_slots(pages: DataFrame, key: str = "page_id", html: str = "html", support: float = 0.5, size: int = 2,
               min_pages: int = 3) -> tuple[DataFrame, str | None]:
    """((host, slot) for hosts with a template of their own, the whole table's slot); ``pages`` has column host."""

    def run(batches):
        import zlib

        import pyarrow as pa

        for b in batches:
            rows = []
            for i, h in enumerate(b.column(2).to_pylist()):
                blocks, opened = parse(h or "")
                chars: dict[str, int] = {}
                texts: dict[str, int] = {}
                for p, dropped, t in blocks:
                    if not dropped:
                        chars[p] = chars.get(p, 0) + len(t)
                        texts[p] = zlib.crc32((t + "\n").encode("utf-8", "surrogatepass"), texts.get(p, 0))
                for p in sorted({*opened, *chars}):
                    rows.append((i, p, opened.get(p, 0), chars.get(p, 0), texts.get(p)))
            at, path, n, c, x = zip(*rows) if rows else ((), (), (), (), ())
            take = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(take), b.column(1).take(take), pa.array(path, pa.string()), pa.array(n, pa.int64()),
                 pa.array(c, pa.int64()), pa.array(x, pa.int64())], names=["host", "page", "path", "n", "chars", "text"])

    per_page = pages.select("host", F.xxhash64(F.col(key)).alias("page"), html).mapInArrow(
        run, "host string, page long, path string, n long, chars long, text long")
    # one row per host and path: signature of the occurrence vector, support, text
    tokens = pin(per_page.groupBy("host", "path").agg(
        F.sum(F.xxhash64("page", "n").cast("decimal(38,0)")).alias("signature"),
        F.count(F.lit(1)).alias("support"), F.sum("n").alias("n"), F.sum("chars").alias("chars"),
        F.count("text").alias("held"), F.min("text").alias("low"), F.max("text").alias("high")))
    sizes = pages.groupBy("host").agg(F.count(F.lit(1)).alias("pages"))

    def slots(tokens, sizes):
        frequent = tokens.where("path <> '' and n > 0").join(sizes, "host").where(F.col("support") >= support * F.col("pages"))
        of_class = Window.partitionBy("host", "signature", "support")
        template = (frequent.withColumn("__size", F.count(F.lit(1)).over(of_class)).where(F.col("__size") >= size)
                    .select("host", F.col("path").alias("prefix"), F.lit(True).alias("valid")))
        # text that is the same on all pages of a frequent path is the template's own
        usual = F.col("held") >= support * F.col("pages")
        varies = (F.col("low") != F.col("high")) | ~usual | (F.col("pages") < 2)
        texts = tokens.where("chars > 0").join(sizes, "host").select("host", "path", "chars", "held", "pages", varies.alias("varies"))
        parts = F.split("path", "/")
        carried = ["chars", "held", "pages", "varies"]
        nested = texts.select("host", "path", *carried, F.explode(F.transform(
            F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, 1, i), "/"))).alias("prefix"))
        known = nested.join(template, ["host", "prefix"], "left")
        valid = F.coalesce("valid", F.col("prefix") == "")
        depth = F.length("prefix")
        first_gap = F.min(F.when(~valid, depth))
        inner = known.groupBy("host", "path", *carried).agg(
            first_gap.alias("gap"), F.sort_array(F.collect_list(F.struct(depth.alias("d"), "prefix"))).alias("all"))
        slot = F.element_at(F.filter("all", lambda x: F.col("gap").isNull() | (x["d"] < F.col("gap"))), -1)["prefix"]
        weighed = inner.select("host", F.coalesce(slot, F.lit("")).alias("slot"), "path", *carried)
        tag = r"(^|/)%s([.#/]|$)"
        cut = F.when(F.col("slot").rlike(tag % "article"), F.regexp_extract("slot", r"^(.*?/article[^/]*)", 1)).when(
            F.col("slot").rlike(tag % "main"), F.regexp_extract("slot", r"^(.*?/main[^/]*)", 1)).otherwise(F.col("slot"))
        weight = F.when(cut.rlike(tag % "article"), 2).when(cut.rlike(tag % "main"), 1).otherwise(0)
        mass = weighed.select("host", cut.alias("slot"), weight.alias("w"), *carried).groupBy("host", "pages", "slot", "w").agg(
            F.sum("chars").alias("chars"), F.sum("held").alias("held"), F.max("varies").alias("varies"))
        first = F.struct(-F.col("w"), -F.col("chars"), F.col("slot"))
        # steps that the first and the last of some paths share are shared by all
        steps = F.split("slot", "/")
        plain = F.when((F.col("w") == 0) & usual, steps)
        best = mass.groupBy("host").agg(
            F.min_by("slot", first).alias("slot"), F.max("w").alias("w"),
            F.min(F.when(F.col("varies"), plain)).alias("low"), F.max(F.when(F.col("varies"), plain)).alias("high"),
            F.min(plain).alias("any_low"), F.max(plain).alias("any_high"))
        best = best.select("host", "slot", "w", F.least(F.coalesce("low", "any_low"), steps).alias("low"),
                           F.greatest(F.coalesce("high", "any_high"), steps).alias("high"))
        short = F.least(F.size("low"), F.size("high"))
        apart = F.filter(F.sequence(F.lit(0), short - 1), lambda i: F.get("low", i) != F.get("high", i))
        wide = F.array_join(F.slice("low", 1, F.coalesce(F.array_min(apart), short)), "/")
        return best.select("host", F.when(F.col("w") == 0, wide).otherwise(F.col("slot")).alias("slot"))

    own = slots(tokens, sizes.where(F.col("pages") >= min_pages)).join(
        sizes.where(F.col("pages") >= min_pages).select("host"), "host", "left_semi")
    whole = tokens.groupBy(F.lit("").alias("host"), "path").agg(
        F.sum("signature").alias("signature"), F.sum("support").alias("support"), F.sum("n").alias("n"),
        F.sum("chars").alias("chars"), F.sum("held").alias("held"), F.min("low").alias("low"), F.max("high").alias("high"))
    all_pages = sizes.agg(F.sum("pages").alias("pages")).select(F.lit("").alias("host"), F.coalesce("pages", F.lit(0)).alias("pages"))
    found = slots(whole, all_pages).first()
    return own, found["slot"] if found else None


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", **options) -> DataFrame:
    """(key, url, text, n_chars) of every row."""
    text_batches(pages.sparkSession, 64)
    hosted = pages.select(F.col(key), F.col(url), F.col(html), url_host(url).alias("host"))
    own, whole = main_slots(hosted, key, html, **options)
    joined = hosted.join(pin(own), "host", "left").select(key, url, html, F.coalesce("slot", F.lit(whole)).alias("slot"))
    kinds = {f.name: f.dataType.simpleString() for f in pages.schema}

    def run(batches):
        import pyarrow as pa

        for b in batches:
            texts = [main_text(h, s) for h, s in zip(b.column(2).to_pylist(), b.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=[key, url, "text", "n_chars"])

    return joined.mapInArrow(run, f"`{key}` {kinds[key]}, `{url}` {kinds[url]}, text string, n_chars long")
