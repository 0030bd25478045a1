"""HTML extraction on generated pages, the regex chain, and byte decoding."""

from pyspark.sql import functions as F

from trawl.functions.html import declared_charset, decode_bytes, html_to_text, html_to_text_py, strip_tags

PAGE = """<!DOCTYPE html><html><head><title>Tide tables</title><style>p {color: red}</style></head>
<body><h1>Harbour</h1><p>High water at <b>six</b>,
low water at noon.</p><ul><li>Buoys</li><li>Lights</li></ul><script>var x = "<p>no</p>";</script></body></html>"""
TEXT = "Harbour\n\nHigh water at six, low water at noon.\n\n  • Buoys\n  • Lights"


def test_generated_page(spark):
    assert html_to_text_py(PAGE) == TEXT
    df = spark.createDataFrame([(PAGE,)], "html string")
    assert df.select(html_to_text("html").alias("t")).first().t == TEXT


def test_strip_tags_drops_script_with_tag_in_string(spark):
    html = '<html><head><title>T</title></head><body><script>var t="</p>";</script><p>a &amp; b</p><ul><li>x</li></ul></body></html>'
    df = spark.createDataFrame([(html,)], "html string")
    assert df.select(strip_tags("html").alias("t")).first().t == "a & b\n\n  • x"


def test_decode_bytes(spark):
    df = spark.createDataFrame([(bytearray("héllo".encode()), None), (bytearray(b"caf\xe9"), "windows-1252"),
                                (bytearray(b"ab\xff"), None), (bytearray(b""), None)], "b binary, cs string")
    got = [r.t for r in df.select(decode_bytes(F.col("b"), F.col("cs")).alias("t")).collect()]
    assert got == ["héllo", "café", "ab�", ""]


def test_charset_is_found_anywhere_before_the_body(spark):
    far = "<html><head>" + "<!-- filler -->" * 2000 + '<meta charset="ISO-8859-2"></head><body>x'
    late = "<html><head></head><body><p><meta charset='koi8-r'>"
    df = spark.createDataFrame([(None, far), (None, late), ("text/html; charset=Big5", far)], "t string, h string")
    got = [r.c for r in df.select(declared_charset(F.coalesce("t", F.lit("")), F.col("h").cast("binary")).alias("c")).collect()]
    assert got == ["iso-8859-2", None, "big5"]


def generated_pages(n=200):
    """Well-formed pages of known words: blocks, inline marks, lists, tables, entities, comments, scripts."""
    import random

    rng = random.Random(5)
    marks = [("&amp;", "&"), ("&lt;", "<"), ("&quot;", '"'), ("&#39;", "'"), ("&copy;", "©")]

    def words(k):
        out = [(w, w) for w in (f"w{rng.randrange(999)}" for _ in range(k))]
        return [(h + e, t + c) if rng.random() < 0.1 else (h, t) for h, t in out for e, c in [rng.choice(marks)]]

    for _ in range(n):
        html, text = ["<!DOCTYPE html><html><head><title>not this</title><style>b {c: d}</style></head><body>"], []
        for _ in range(rng.randrange(1, 8)):
            tag = rng.choice(["p", "div", "h2", "section", "blockquote", "ul", "table", "br", "script", "comment"])
            ws = words(rng.randrange(1, 9))
            body = " ".join(f"<{m}>{h}</{m}>" if (m := rng.choice(["", "", "b", "em", "span"])) else h for h, _ in ws)
            if tag == "script":
                html.append("<script>var hidden = 1;</script>")
                continue
            if tag == "comment":
                html.append("<!-- hidden -->")
                continue
            text += [t for _, t in ws]
            if tag == "ul":
                text.insert(len(text) - len(ws), "•")
                html.append(f"<ul><li>{body}</li></ul>")
            elif tag == "table":
                html.append(f"<table><tr><td>{body}</td></tr></table>")
            elif tag == "br":
                html.append(f"<p>{body}<br>{body}</p>")
                text += [t for _, t in ws]
            else:
                html.append(f"<{tag} class='c'>{body}</{tag}>\n")
        yield "".join(html) + "</body></html>", text


def test_parser_and_regex_chain_agree_with_the_words_that_pages_were_made_of(spark):
    pages = list(generated_pages())
    df = spark.createDataFrame([(i, h) for i, (h, _) in enumerate(pages)], "i int, html string")
    got = df.select("i", html_to_text("html").alias("a"), strip_tags("html").alias("b")).orderBy("i").collect()
    for r, (_, want) in zip(got, pages, strict=True):
        assert r.a.split() == want and r.b.split() == want
