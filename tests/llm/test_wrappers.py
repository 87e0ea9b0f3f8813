"""Wrappers inside articles, name marks, copies of pages."""

import zlib

from pawprint.llm import wrappers


def page_text(rows):
    """Texts by page_id, inferred and applied in this process."""
    by_host = {}
    for _, url, page in rows:
        e = wrappers.expression(wrappers.parse(page), pages=(zlib.crc32(page.encode()),))
        host = url.split("/")[2]
        by_host[host] = wrappers.merged(by_host[host], e) if host in by_host else e
    skip = {h: wrappers.regions(e) for h, e in by_host.items()}
    return {i: wrappers.main_text(wrappers.parse(p), skip[u.split("/")[2]]) for i, u, p in rows}


def test_wrapper_decides_inside_articles(spark):
    def page(k):
        words = " ".join(f"w{k}x{j}" for j in range(20))
        return (f"<html><body><div class='content-with-sidebar'><article><h1>Title {k}</h1>"
                f"<div class='body'><h2>Ingredients</h2><p>{words}</p><p>and {k}</p></div>"
                "<div class='zzz'>Join our club today</div><ul><li><a href=1>More of this</a>"
                f"<li><a href=2>and of {k}</a></ul></article></div></body></html>")
    rows = [(k, f"http://d.example/{k}", page(k)) for k in range(6)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    text = {r.page_id: r.text for r in wrappers.extract(pages).collect()}
    for k in range(6):
        words = " ".join(f"w{k}x{j}" for j in range(20))
        assert text[k] == f"Title {k}\nIngredients\n{words}\nand {k}"


def test_name_marked_region_with_all_the_text():
    rows = [(k, "http://e.example/x", f"<body><nav>Menu</nav><div class=sidebar><p>Only text {k}"
             f"</p><p>is here {k}</p></div></body>") for k in range(4)]
    assert page_text(rows)[2] == "Only text 2\nis here 2"
    rows = [(k, "http://e.example/x", f"<body><p>Text {k}</p><div class=comments><p>A longer "
             f"remark of a reader {k}</p></div></body>") for k in range(4)]
    assert page_text(rows)[2] == "Text 2"


def test_identical_pages_keep_their_text(spark):
    page = ("<html><head><title>A long title of the page</title></head><body><div><h1>Head</h1>"
            "<table><tr><td>cell</table><p>Some text.</div></body></html>")
    rows = [(k, f"http://f.example/{k}", page) for k in range(5)]
    # Mirrors that differ in a stamp only.
    rows += [(10 + k, f"http://g.example/{k}", page.replace("</body>", f"<p>{k}</body>"))
             for k in range(5)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    text = {r.page_id: r.text for r in wrappers.extract(pages).collect()}
    assert all(text[k] == "Head\ncell\nSome text." for k in range(5))
    assert all(text[10 + k] == f"Head\ncell\nSome text.\n{k}" for k in range(5))


def test_text_of_a_few_pages_is_not_fixed():
    def page(k):
        return (f"<body><div><p>Text {k} of this page, it differs from others.</p><p>More {k}</p>"
                "</div>" + ("<table><tr><td>the same table</table>" if k < 4 else "")
                + "<section>Same words</section></body>")
    text = page_text([(k, "http://h.example/x", page(k)) for k in range(40)])
    assert text[1] == "Text 1 of this page, it differs from others.\nMore 1\nthe same table"
    assert text[9] == "Text 9 of this page, it differs from others.\nMore 9"


def test_share_of_pages_is_counted_over_all_pages(spark):
    """Fixed text is judged by all pages of a host, not by those with the smallest checksums."""
    def page(k, host, note):
        return (f"<body><div><p>Text {k} of a page of {host}, it differs.</p><p>More {k}</p></div>"
                + ("<section>Same words</section>" if note else "") + "</body>")

    def pick(host, note, n, low):
        made = sorted((page(k, host, note) for k in range(note * 1000, note * 1000 + 300)),
                      key=lambda p: zlib.crc32(p.encode()), reverse=not low)
        return made[:n]

    # 14 of 40 pages, all of them with small checksums; 26 of 40, all with large ones.
    rare = pick("r.example", True, 14, True) + pick("r.example", False, 26, False)
    often = pick("o.example", True, 26, False) + pick("o.example", False, 14, True)
    rows = [(i, "http://r.example/x", p) for i, p in enumerate(rare + rare[:14])]
    rows += [(100 + i, "http://o.example/x", p) for i, p in enumerate(often)]
    rows += [(200 + i, "http://o.example/x", often[-1]) for i in range(30)]  # copies count once
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    text = {r.page_id: r.text for r in wrappers.extract(pages).collect()}
    assert text == page_text(rows)
    assert all(("Same words" in text[i]) == (i % 40 < 14) for i in range(54))
    assert not any("Same words" in text[i] for i in text if i >= 100)
