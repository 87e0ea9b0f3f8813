"""Main text of web pages by wrappers inferred per host.

Every page is read as a stream of tags and texts. Its expression is a
union-free regular expression over them: neighbouring elements of one kind
are a repeated group, texts are slots. Two expressions of a host are aligned
level by level; what only one of them has becomes optional, runs become
repeated, and slots that differ become variable. Expressions of one slice of
pages are merged where they are read, then those of a host in two steps over
salted groups, so a host with a third of all pages needs no single task.

The main text lies in the article or main element, else in the whole body. In
both the host's wrapper says which regions are left out: lists of links, what
a name marks as a menu, advert, notice and the like, and text that is the same
on three different pages or more and on most of the host's different pages.
A region that holds most of the host's text is never left out, headings of
sections stay, and where most of the text is the same on all pages nothing is
left out for being the same. Pages are told apart by a digest of their html;
how many different pages of a host have a node is counted over all of them:
pages with the same paths are one shape, and the shapes' counts add up.

Null or empty html gives an empty text; pages without a host form a group of
their own; broken markup (unclosed or stray tags, cut ends) is read as far as
it goes; repeated rows give the same text each; extra columns are ignored; an
empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import html as _html
import json
import re
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pawprint.llm.common import need, slices, stored

#: How elements are treated.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe svg math object textarea title".split())
BOILERPLATE = frozenset("nav header footer aside form script style noscript template iframe "
                        "svg math object button select textarea input label dialog menu "
                        "head title".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark "
                   "q rp rt ruby s samp small span strike strong sub sup time tt u var wbr "
                   "img".split())
CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figcaption "
                     "figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section "
                     "table ul".split())
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
            "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
CONTAINERS = frozenset("div section ul ol dl table tr td center".split())
LISTS = frozenset("ul ol dl table select body".split())
NAMES = re.compile(
    r"(?:^|[\s_-])(ads?|advert\w*|adsense|banner|promo\w*|sponsor\w*|sidebar|side|menu|nav\w*|"
    r"breadcrumbs?|footer|header|masthead|cookies?|consent|gdpr|notices?|alert|popup|modal|"
    r"newsletter|subscribe|share|sharing|social|related|recommend\w*|comments?|reply|replies|"
    r"disqus|pagination|pager|login|signup|search|toolbar|widget)(?=$|[\s_-])", re.I)
#: Names that tell of such a part elsewhere.
_ABOUT = re.compile(r"(?:^|[_-])(has|with|without|no)[_-]", re.I)
HEADINGS = frozenset("h2 h3 h4 h5 h6".split())
#: Children from which on class names are not told apart.
MANY = 64
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert menu "
                  "form".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)|"
    r"<(/?)([a-zA-Z][^\s/>]*)((?:[^\"'>]++|\"[^\"]*+\"|'[^']*+')*+)>|"
    r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|$)", re.S)
_NAME = re.compile(r"""(?:^|\s)(?:class|id)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_PLAIN = re.compile(r"[A-Za-z_-]{1,40}")
_ROLE = re.compile(r"""(?:^|\s)role\s*=\s*["']?([a-zA-Z]+)""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)(?:hidden(?=$|[\s=/])|aria-hidden\s*=\s*["']?true|"""
                     r"""style\s*=\s*["'][^"']*display\s*:\s*none)""", re.I)
#: Elements deeper than this are read as if they were at this depth.
DEPTH = 120


def label_of(tag: str, attrs: str) -> str:
    """Kind of an element: its tag, with ``!`` where its tag or role marks boilerplate,
    with ``%`` where only a name does, and behind a dot the class of a container."""
    if tag in BOILERPLATE:
        return tag + ("%" if tag == "form" else "!")
    if attrs:
        role = _ROLE.search(attrs)
        if role and role[1].lower() == "main":
            return "main"
        if (role and role[1].lower() in ROLES) or _HIDDEN.search(attrs):
            return tag + "!"
        kind = ""
        for m in _NAME.finditer(attrs):
            words = (m[1] or m[2] or m[3] or "").split()
            if tag not in ("html", "body", "article", "main") and any(
                    NAMES.search(word) and not _ABOUT.search(word) for word in words):
                return tag + "%"
            if words and m[0].lstrip()[:5].lower() == "class" and _PLAIN.fullmatch(words[0]):
                kind = "." + words[0].lower()
        if tag in CONTAINERS or tag == "p":
            return tag + kind
    return tag


def parse(page: str) -> list:
    """The page as a tree: [label, children, tag]; a text is a string."""
    root = ["", [], ""]
    stack = [root]
    at, raw_until = 0, None
    for m in _TOKEN.finditer(page):
        if raw_until is not None:
            if m[2] is None and m[5] is None or (m[2] or m[5]).lower() != raw_until or not (
                    m[1] or m[4]):
                continue
            raw_until = None
            at = m.end()
            stack.pop()
            continue
        if m.start() > at:
            stack[-1][1].append(page[at:m.start()])
        at = m.end()
        tag = m[2] or m[5]
        if tag is None:
            if m[0].startswith("<![CDATA["):
                stack[-1][1].append(m[0][9:].removesuffix("]]>").replace("&", "&amp;"))
            continue
        tag = tag.lower()
        if m[1] or m[4]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][2] == tag:
                    del stack[k:]
                    break
            continue
        attrs = (m[3] if m[2] else m[6]) or ""
        if tag in CLOSES_P:
            for k in range(len(stack) - 1, 0, -1):
                name = stack[k][2]
                if name == "p":
                    del stack[k:]
                    break
                if name not in INLINE:
                    break
        elif tag in SIBLINGS:
            for k in range(len(stack) - 1, 0, -1):
                name = stack[k][2]
                if name in SIBLINGS[tag]:
                    del stack[k:]
                    break
                if name in LISTS:
                    break
        node = [label_of(tag, attrs), [], tag]
        stack[-1][1].append(node)
        if tag in VOID or attrs.endswith("/") and tag in ("svg", "math"):
            continue
        if tag in RAW:
            stack.append(node)
            raw_until = tag
        elif len(stack) < DEPTH:
            stack.append(node)
    if at < len(page) and raw_until is None:
        tail = page[at:]
        cut = tail.rfind("<")  # a tag that the end of the page cut
        stack[-1][1].append(tail if cut < 0 or not re.match(r"</?[a-zA-Z]", tail[cut:])
                            else tail[:cut])
    mark_links(root)
    return root


def mark_links(node: list, in_link: bool = False) -> tuple[int, int]:
    """Put ``~`` behind the label of every container whose text is mostly links;
    the characters of its text, and those in links."""
    link = in_link or node[0] == "a"
    chars = links = 0
    for c in node[1]:
        if isinstance(c, str):
            n = len(c.strip())
            chars, links = chars + n, links + n * link
        else:
            n, m = mark_links(c, link)
            chars, links = chars + n, links + m
    if node[2] in CONTAINERS and node[0][-1] not in "!%" and 2 * links > chars:
        node[0] += "~"
    return chars, links


# ---- expressions -------------------------------------------------------------
# A node: [label, optional, repeated, pages, chars, link chars, slot, children].
# pages: names of the pages that have it, or how many of the host's different pages do.
# slot: None without text, a checksum while all texts are equal, -1 when they vary.
LABEL, OPT, REP, PAGES, CHARS, LINKS, SLOT, KIDS = range(8)


def expression(tree: list, in_link: bool = False, pages: tuple = (0,)) -> list:
    """Expression of one page's tree."""
    label, children, _ = tree
    link = in_link or label == "a"
    texts = [" ".join(c.split()) for c in children if isinstance(c, str)]
    text = " ".join(t for t in texts if t)
    node = [label, 0, 0, list(pages), len(text), len(text) if link else 0,
            zlib.crc32(text.encode()) if text else None, []]
    kids = [expression(c, link, pages) for c in children if not isinstance(c, str)]
    node[KIDS] = folded(kids)
    return node


def _shape(node: list) -> tuple:
    if node[LABEL] == "()":
        return ("()", *map(_shape, node[KIDS]))
    return (node[LABEL],)


def folded(kids: list) -> list:
    """Neighbours of one kind as a repeated element; repeated runs of two to four
    kinds as a repeated group."""
    out: list = []
    for k in kids:
        if out and _shape(out[-1]) == _shape(k):
            out[-1] = merged(out[-1], k)
            out[-1][REP] = 1
        else:
            out.append(k)
    for period in (2, 3, 4):
        at = 0
        while at + 2 * period <= len(out):
            first, then = out[at:at + period], out[at + period:at + 2 * period]
            if [_shape(x) for x in first] == [_shape(x) for x in then]:
                both = [merged(x, y) for x, y in zip(first, then)]
                group = ["()", 0, 1, both[0][PAGES], 0, 0, None, both]
                end = at + 2 * period
                while [_shape(x) for x in out[end:end + period]] == [_shape(x) for x in both]:
                    group[KIDS] = both = [merged(x, y) for x, y in
                                          zip(both, out[end:end + period])]
                    end += period
                out[at:end] = [group]
            at += 1
    return out


def _pages(a: list, b: list) -> list:
    return a if a == b else sorted({*a, *b})


def merged(a: list, b: list) -> list:
    """The expression that covers both of two of one kind."""
    slot = a[SLOT] if a[SLOT] == b[SLOT] else b[SLOT] if a[SLOT] is None else \
        a[SLOT] if b[SLOT] is None else -1
    return [a[LABEL], a[OPT] | b[OPT], a[REP] | b[REP], _pages(a[PAGES], b[PAGES]),
            a[CHARS] + b[CHARS], a[LINKS] + b[LINKS], slot, aligned(a[KIDS], b[KIDS])]


def aligned(x: list, y: list) -> list:
    """Children of two expressions on their longest common sequence of kinds;
    the others become optional."""
    if not x or not y:
        out = [list(k) for k in x or y]
        for k in out:
            k[OPT] = 1
        return out
    sx, sy = [_shape(k) for k in x], [_shape(k) for k in y]
    if sx == sy:
        return [merged(p, q) for p, q in zip(x, y)]
    n, m = len(x), len(y)
    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        for j in range(m - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if sx[i] == sy[j] else max(
                best[i + 1][j], best[i][j + 1])
    out, i, j = [], 0, 0
    while i < n or j < m:
        if i < n and j < m and sx[i] == sy[j]:
            out.append(merged(x[i], y[j]))
            i, j = i + 1, j + 1
        elif j >= m or (i < n and best[i + 1][j] >= best[i][j + 1]):
            out.append([*x[i]])
            out[-1][OPT] = 1
            i += 1
        else:
            out.append([*y[j]])
            out[-1][OPT] = 1
            j += 1
    if len(out) > MANY:
        for k in out:
            k[LABEL] = re.sub(r"\..*", "~" if k[LABEL].endswith("~") else "", k[LABEL])
    return folded(out)


def regular_expression(node: list) -> str:
    """The wrapper as text: ``?`` optional, ``+`` repeated, ``#`` a slot, ``=`` fixed text."""
    inner = ("" if node[SLOT] is None else "#" if node[SLOT] == -1 else "=") + "".join(
        map(regular_expression, node[KIDS]))
    mark = ("+" if node[REP] else "") + ("?" if node[OPT] else "")
    if node[LABEL] == "()":
        return f"({inner}){mark}"
    return f"{node[LABEL]}[{inner}]{mark}"


# ---- regions -----------------------------------------------------------------

def page_paths(tree: list) -> list[str]:
    """The paths (labels joined by /) of a page's tree outside boilerplate, each once."""
    out = set()

    def walk(node: list, path: str) -> None:
        here = f"{path}/{node[0]}"
        out.add(here)
        for c in node[1]:
            if not isinstance(c, str) and not c[0].endswith("!"):
                walk(c, here)

    walk(tree, "")
    return sorted(out)


def wrapper_nodes(node: list, path: str = ""):
    """(path, node) of the wrapper's nodes outside boilerplate; groups are no part of a path."""
    if node[LABEL].endswith("!"):
        return
    here = path if node[LABEL] == "()" else f"{path}/{node[LABEL]}"
    if here is not path:
        yield here, node
    for k in node[KIDS]:
        yield from wrapper_nodes(k, here)


def regions(wrapper: list) -> dict[str, int]:
    """Paths (labels joined by /) that hold no main text, as 1; paths that hold it
    although a name marks them, as 0."""
    totals: dict[str, list] = {}

    def walk(node: list, path: str) -> tuple[int, int, int]:
        """Characters, those in links, and those of variable slots outside links."""
        label = node[LABEL]
        if label.endswith("!"):
            return 0, 0, 0
        here = path if label == "()" else f"{path}/{label}"
        chars, links = node[CHARS], node[LINKS]
        varies = (chars - links) * (node[SLOT] == -1)
        again = node[REP]
        for k in node[KIDS]:
            c, n, v = walk(k, here)
            chars, links, varies = chars + c, links + n, varies + v
            again |= k[REP]
        if label != "()":
            t = totals.setdefault(here, [0, 0, 0, 0, 0])
            t[0] += chars
            t[1] += links
            t[2] += varies
            t[4] |= again
        return (0, 0, 0) if label.endswith("%") else (chars, links, varies)

    chars, links, changing = walk(wrapper, "")
    text = chars - links
    names: dict[str, set] = {}
    for path, node in wrapper_nodes(wrapper):
        if isinstance(node[PAGES], int):
            totals[path][3] = node[PAGES]
        else:
            names.setdefault(path, set()).update(node[PAGES])
    for path, found in names.items():
        totals[path][3] = len(found)
    n_pages = totals[f"/{wrapper[LABEL]}"][3]
    out = {}
    for path, (chars, links, varies, pages, again) in totals.items():
        *above, label = path.split("/")
        own, tag = chars - links, re.split(r"[~%.]", label)[0]
        if label.endswith("%"):
            if varies and not changing and own > text:
                out[path] = 0
        elif not chars or tag in INLINE or 2 * own > text:
            continue
        elif 2 * links > chars:
            if again and label.endswith("~") or not {"article", "main"} & {*above, label}:
                out[path] = 1
        elif (not varies and 2 * changing > text and tag not in HEADINGS and pages >= 3
              and 2 * pages > n_pages):
            out[path] = 1
    return out


def main_text(tree: list, skip: dict[str, int]) -> str:
    """Blocks of a page's main text, one per line."""
    blocks: list[str] = []
    words: list[str] = []

    def flush():
        text = " ".join(_html.unescape("".join(words)).split())
        if text:
            blocks.append(text)
        words.clear()

    def out_of(label, path):
        return label.endswith("!") or skip.get(path, int(label.endswith("%"))) == 1

    def find(node, path, out):
        """Article elements, else main elements, outside boilerplate."""
        for c in node[1]:
            if isinstance(c, str):
                continue
            here = f"{path}/{c[0]}"
            if not c[0].endswith("!") and (not c[0].endswith("%") or skip.get(here) == 0):
                if c[0] in ("article", "main"):
                    out.setdefault(c[0], []).append((c, here))
                    if c[0] == "article":
                        continue
                find(c, here, out)
        return out

    def emit(node, path):
        for c in node[1]:
            if isinstance(c, str):
                words.append(c)
                continue
            here = f"{path}/{c[0]}"
            if out_of(c[0], here):
                if c[2] not in INLINE:
                    flush()
            elif c[2] in INLINE:
                emit(c, here)
            else:
                flush()
                emit(c, here)
                flush()

    found = find(tree, "/", {})
    for c, here in found.get("article") or found.get("main") or [(tree, "/")]:
        emit(c, here)
        flush()
    return "\n".join(blocks)


# ---- Spark -------------------------------------------------------------------

_FOUND = ("host string, slice bigint, expression string, page binary, shape binary, "
          "paths array<string>")


def _digest(raw: bytes) -> bytes:
    return hashlib.blake2b(raw, digest_size=16).digest()


def _expression_rows(schema: pa.Schema):
    """One merged expression per host and slice of pages; host, digest and shape (digest of
    the paths) of every page; the paths of every shape of the slice."""
    def run(batches):
        from pyspark import TaskContext
        name = TaskContext.get().partitionId() << 32
        for part in slices(batches, "html"):
            by_host: dict[str, list] = {}
            out, shapes = [], {}
            for host, page in zip(part.column("host").to_pylist(),
                                  part.column("html").to_pylist()):
                if page:
                    tree = parse(page)
                    paths = page_paths(tree)
                    shape = _digest("\n".join(paths).encode("utf-8", "surrogatepass"))
                    shapes[shape] = paths
                    out.append({"host": host, "shape": shape,
                                "page": _digest(page.encode("utf-8", "surrogatepass"))})
                    e = expression(tree, pages=())
                    by_host[host] = merged(by_host[host], e) if host in by_host else e
            if by_host:
                out += [{"shape": k, "paths": v} for k, v in shapes.items()]
                out += [{"host": h, "slice": name, "expression": json.dumps(e)}
                        for h, e in by_host.items()]
                yield pa.RecordBatch.from_pylist(out, schema)
            name += 1
    return run


def _merge_group(key, table):
    out = None
    for raw in sorted(table.column("expression").to_pylist()):
        e = json.loads(raw)
        out = e if out is None else merged(out, e)
    return pa.table({"host": pa.array([key[0].as_py()], pa.string()),
                     "expression": pa.array([json.dumps(out)])})


def host_of(url):
    return F.coalesce(F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://([^/?#:]+)", 1),
                      F.lit(""))


def _path_rows(names: list[str]):
    """(host, path) of every node of a wrapper."""
    def run(batches):
        for part in batches:
            for host, raw in zip(part.column("host").to_pylist(),
                                 part.column("expression").to_pylist()):
                paths = sorted({path for path, _ in wrapper_nodes(json.loads(raw))})
                yield pa.RecordBatch.from_arrays([pa.array([host] * len(paths), pa.string()),
                                                  pa.array(paths, pa.string())], names=names)
    return run


def _counted_rows(names: list[str]):
    """The wrappers with the number of different pages at each node."""
    def run(batches):
        for part in batches:
            out = []
            for raw, paths, ns in zip(*[part.column(c).to_pylist() for c in (
                    "expression", "paths", "ns")]):
                wrapper, n = json.loads(raw), dict(zip(paths or (), ns or ()))
                for path, node in wrapper_nodes(wrapper):
                    node[PAGES] = n.get(path, 0)
                out.append(json.dumps(wrapper))
            yield pa.RecordBatch.from_arrays([part.column("host"), pa.array(out, pa.string())],
                                             names=names)
    return run


def infer(pages: DataFrame) -> DataFrame:
    """host, expression (JSON) of every host in ``pages(url, html)``."""
    found = stored(need(pages, "url", "html").select(host_of("url").alias("host"), "html")
                   .mapInArrow(_expression_rows(pa.schema([
                       ("host", pa.string()), ("slice", pa.int64()), ("expression", pa.string()),
                       ("page", pa.binary()), ("shape", pa.binary()),
                       ("paths", pa.list_(pa.string()))])), _FOUND), "expressions")
    parts = found.filter("expression IS NOT NULL").select("host", "slice", "expression")
    salts = max(1, int(parts.select("slice").distinct().count() ** 0.5))
    schema = "host string, expression string"
    some = (parts.withColumn("salt", F.pmod(F.xxhash64("slice"), F.lit(salts)))
            .groupBy("host", "salt").applyInArrow(_merge_group, schema))
    wrappers = stored(some.groupBy("host").applyInArrow(_merge_group, schema), "wrappers")
    # Every different page of a host counts once, at each of its paths.
    shapes = (found.filter("page IS NOT NULL").select("host", "page", "shape").distinct()
              .groupBy("host", "shape").agg(F.count(F.lit(1)).alias("n")))
    paths = found.filter("paths IS NOT NULL").groupBy("shape").agg(F.first("paths").alias("paths"))
    counts = (shapes.join(paths, "shape").select("host", F.explode("paths").alias("path"), "n")
              .groupBy("host", "path").agg(F.sum("n").alias("n")))
    asked = wrappers.mapInArrow(_path_rows(["host", "path"]), "host string, path string")
    known = (counts.join(asked, ["host", "path"]).groupBy("host")
             .agg(F.collect_list(F.struct("path", "n")).alias("e"))
             .select("host", F.col("e.path").alias("paths"), F.col("e.n").alias("ns")))
    return stored(wrappers.join(known, "host", "left").select("host", "expression", "paths", "ns")
                  .mapInArrow(_counted_rows(["host", "expression"]), schema), "counted")


def _region_rows(names: list[str]):
    def run(batches):
        for part in batches:
            yield pa.RecordBatch.from_arrays([part.column("host"), pa.array(
                [json.dumps(regions(json.loads(e))) for e in part.column("expression").to_pylist()],
                pa.string())], names=names)
    return run


def _extract_rows(names: list[str]):
    def run(batches):
        known: dict[str, dict] = {}
        for part in slices(batches, "html"):
            out = []
            for page, skip in zip(part.column("html").to_pylist(),
                                  part.column("regions").to_pylist()):
                if not page:
                    out.append("")
                    continue
                if skip not in known:
                    if len(known) > 1000:
                        known.clear()
                    known[skip] = json.loads(skip) if skip else {}
                out.append(main_text(parse(page), known[skip]))
            yield pa.RecordBatch.from_arrays([
                part.column("page_id"), part.column("url"), pa.array(out, pa.string()),
                pa.array([len(t) for t in out], pa.int64())], names=names)
    return run


def extract(pages: DataFrame, wrappers: DataFrame | None = None) -> DataFrame:
    """page_id, url, text and n_chars of every row of ``pages(page_id, url, html)``."""
    pages = need(pages, "page_id", "url", "html")
    wrappers = infer(pages) if wrappers is None else wrappers
    kind = pages.schema["page_id"].dataType.simpleString()
    names = ["page_id", "url", "text", "n_chars"]
    skips = stored(wrappers.select("host", "expression").mapInArrow(
        _region_rows(["host", "regions"]), "host string, regions string"), "regions")
    return (pages.withColumn("host", host_of("url")).join(skips, "host", "left")
            .select("page_id", "url", "html", "regions")
            .mapInArrow(_extract_rows(names),
                        f"page_id {kind}, url string, text string, n_chars bigint"))
