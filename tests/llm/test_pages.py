"""Main text of pages, and web archives."""

import hashlib
import html as entities
import random
import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tillmark.llm import html_extract, warc

CASES = [
    (None, ""), ("", ""), ("just text", "just text"), ("<p>a<p>b  c\n d", "a\n\nb c d"),
    ("<html><head><title>t</title><style>p{}</style></head><body><nav><a href=1>Home</a></nav><article><h1>H&eacute;ad</h1>"
     "<p>One &amp; two,<br>three.</p><script>x('</p>')</script><div class='comments'><p>Nice, very nice!</p></div></article>"
     "<aside>More</aside><footer>&copy; me</footer></body></html>", "Héad\n\nOne & two, three."),
    ("<body><div id=side-menu><ul><li><a href=a>x</a><li><a href=b>y</a></ul></div><div class=text><p>" + "word, " * 40 + "end.</p><ul><li>i"
     "<li>j</ul></div><div class='cookie-notice'>We use cookies</div><form><p>Name</p></form></body>", ("word, " * 40) + "end.\n\ni\n\nj"),
    ("<article><p>shadow <b class='shadow'>kept</b> <span hidden>gone</span></p><!-- note --><p>&lt;tag&gt; &#65;&nbsp;B</p></article>",
     "shadow kept\n\n<tag> A B"),
    ("<div role=navigation>no</div><main><table><tr><td>a<td>b<tr><td>c</table></main>", "a\n\nb\n\nc"),
    ("<body><h1>Head</h1><div><p>" + "word, " * 30 + "</p><p>more, words</p></div><div><a href=x>link</a></div></body>",
     "Head\n\n" + ("word, " * 30).strip() + "\n\nmore, words"),
    ("<div class='content has-sidebar'><p>Kept.</p></div>", "Kept."),
    ("<div class='site-header-wrap'><p>Kept.</p></div>", "Kept."), ("<div class='cookie-notice'><p>Gone.</p></div><div id=sidebar>Gone</div>", ""),
    ("<article><h2 id='related-work'>R</h2><p class='market-share'>a</p><h2 id='search'>S</h2><section id=search><p>b</p></section>"
     "<div class='social-share'><a href=x>Share</a></div><span class=nav-link>c</span></article>", "R\n\na\n\nS\n\nb\n\nc"),
    ("<body><h1>Head</h1><p>Short.</p><div class=x><p>" + "word, " * 30 + "</p></div>bare <b>text</b><ul><li>i</ul><table><tr><td>t</table>"
     "<ul><li><a href=x>link</a></ul></body>", "Head\n\nShort.\n\n" + ("word, " * 30).strip() + "\n\nbare text\n\ni\n\nt"),
    ("<div id=wrap><h1>Head</h1><div><p>" + "word, " * 30 + "</p></div><div><p>End.</p></div></div><div class=footer>(c)</div>",
     "Head\n\n" + ("word, " * 30).strip() + "\n\nEnd."),
    ("<article><p>text</p></article><section id=comments><article class=comment><p>" + "nice, " * 30 + "</p></article></section>", "text"),
    ("<section class=comment-list><article class='comment-body'><p>" + "nice, " * 90 + "</p></article></section><div><p>text</p></div>", "text"),
    ("<form id=page><div><input name=x><label>Name</label><p>" + "word, " * 40 + "</p></div></form>", ("word, " * 40).strip()),
    ("<form><p>Name</p></form>", ""),
    ("<article><p>unclosed <a href='x", "unclosed"), ("<header><h1>Site</h1></header><article><header><h1>T</h1></header><p>x</p></article>", "T\n\nx"),
]


@pytest.mark.parametrize(("page", "text"), CASES)
def test_main_text(page, text):
    assert html_extract.main_text(page) == text


KEPT = [  # markup round the words of a block of the article
    "<p>{}</p>", "<p class='market-share'>{}</p>", "<h2 id='related-work'>{}</h2>", "<h3 id=search>{}</h3>", "<ul><li>{}</li></ul>",
    "<blockquote id=comment-1><p>{}</p></blockquote>", "<table><tr><td>{}</td></tr></table>", "<pre>{}</pre>", "<div class=text>{}</div>",
    "<section id=related-methods><p>{}</p></section>", "<p><b>{}</b></p>", "<p id=footer>{}</p>", "<div class='no-ads'><p>{}</p></div>"]
GONE = [  # markup round words that are not the article's
    "<nav><p>{}</p></nav>", "<aside><p>{}</p></aside>", "<footer><p>{}</p></footer>", "<form><p>{}</p></form>", "<script>{}</script>",
    "<style>{}</style>", "<div class='cookie-notice'><p>{}</p></div>", "<div class='ad'><p>{}</p></div>", "<div id=comments><p>{}</p></div>",
    "<div role=navigation><p>{}</p></div>", "<div hidden><p>{}</p></div>", "<ul class=menu><li>{}</li></ul>", "<!-- {} -->",
    "<ol class='comment-list'><li><article class='comment'><p>{}</p></article></ol>", "<div class='newsletter-signup'><p>{}</p></div>"]
FRAMES = [
    "<body><article>{}</article></body>", "<body><main><h1>Title</h1>{}</main></body>", "<body><div class='content has-sidebar'>{}</div></body>",
    "<body><div id=wrap><div class='post comments-open'>{}</div></div></body>", "<body class='no-sidebar'>{}</body>"]


@pytest.mark.parametrize("seed", range(300))
def test_made_pages(seed):
    """Pages put together from parts that are known to belong to the article or not."""
    rng = random.Random(seed)
    frame, parts, expected = rng.choice(FRAMES), [], []
    for i in range(rng.randrange(3, 12)):
        words = f"w{i} " + ", ".join(rng.choice(["alpha", "beta", "gamma", "delta"]) for _ in range(rng.choice([1, 3, 20, 60])))
        keep = rng.random() < 0.6 or not expected
        part = rng.choice(KEPT if keep else GONE)
        if "related-methods" in part and "no-sidebar" in frame:  # nothing tells such a section from a list of links
            part = "<p>{}</p>"
        parts.append(part.format(words))
        expected += [words] if keep else []
    title = ["Title"] if "Title" in frame else []
    assert html_extract.main_text(frame.format("\n".join(parts))) == "\n\n".join(title + expected)


def test_deep_and_long_pages():
    assert html_extract.main_text("<div>" * 20_000 + "deep" + "</div>" * 20_000) == "deep"
    assert len(html_extract.main_text("<article>" + "<p>some words</p>" * 50_000 + "</article>")) == 12 * 50_000 - 2
    assert html_extract.main_text("<" * 50_000 + " x") == "<" * 50_000 + " x"  # and an unfinished tag ends the page:
    assert html_extract.main_text("a <b") == "a"
    assert html_extract.main_text("<a href='" * 3000) == ""


def test_test_pages(spark):
    """The pages' articles, cut out by pattern."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    found = html_extract.extract(pages).collect()
    by_id = {r.page_id: r for r in found}
    assert len(found) == pages.count()
    for r in pages.collect():
        inner = re.split(r"</article>|<footer>", r.html.split("<article>", 1)[1])[0]
        parts = re.split(r"</?(?:p|h1)>", inner.replace("<br>", " "))
        blocks = (" ".join(entities.unescape(re.sub(r"<[^>]*>", "", p)).split()) for p in parts)
        text = "\n\n".join(b for b in blocks if b)
        assert (by_id[r.page_id].text, by_id[r.page_id].n_chars) == (text, len(text))


def test_extract_frame(spark):
    pages = spark.createDataFrame([(1, None, "<p>ä𝄞</p>"), (1, "u", None), (None, "u", "<p>b</p>")], "page_id long, url string, html string")
    assert {tuple(r) for r in html_extract.extract(pages).collect()} == {(1, None, "ä𝄞", 2), (1, "u", "", 0), (None, "u", "b", 1)}
    assert html_extract.extract(pages.limit(0)).count() == 0
    with pytest.raises(ValueError, match="text"):
        html_extract.extract(pages.withColumn("text", F.lit("x")))


def test_archive_round_trip(spark):
    same = "<p>" + "same payload " * 30
    rows = [(i, f"http://x/{i}", same) for i in range(5, 60)] + [
        (100, None, None), (101, "", ""), (102, "http://x\r\ny", "short"), (103, "u: v", "short"), (104, "u", "é\r\n\r\nWARC/1.1\r\n" * 50),
        (105, "u", "x" * 99), (106, "u", "x" * 99), (107, "u", "x" * 100), (108, "u", "x" * 100), (None, "u", same), (200, "u", "ab€" * 90_000)]
    pages = spark.createDataFrame([(*r, 1, "c") for r in rows], "page_id long, url string, html string, size int, digest string").repartition(4)
    manifest = warc.write_archives(warc.record_chunks(pages, chunk_bytes=1000), archive_bytes=3000)
    assert manifest.agg(F.sum("records")).first()[0] == len(rows) and manifest.count() > 4
    chunks = warc.read_archives(manifest, chunk_bytes=700).collect()
    payloads = {}
    for r in sorted(chunks, key=lambda r: (str(r.target), r.chunk_no)):
        payloads[r.target] = payloads.get(r.target, b"") + r.data
        if r.record_type == "response":
            assert r.bytes_so_far == len(payloads[r.target])
            assert r.digest_so_far == hashlib.sha256(payloads[r.target]).hexdigest()
    records = {r.target: r for r in warc.record_table(warc.read_archives(manifest, with_data=False)).collect()}
    firsts = {}
    for i, _, text in rows:
        if i is not None and len((text or "").encode()) >= 100:
            firsts[text] = min(i, firsts.get(text, i))
    for i, url, text in rows:
        body = (text or "").encode()
        r = records[None if i is None else str(i)]
        refers = firsts.get(text) if firsts.get(text, i) != i else None
        assert (r.payload_bytes, r.payload_digest) == (len(body), hashlib.sha256(body).hexdigest())
        assert (r.record_type, r.refers_to) == (("response", None) if refers is None else ("revisit", str(refers)))
        assert payloads[r.target] == (body if refers is None else b"")
        assert r.url == (url if url is None else url.replace("\r", "%0D").replace("\n", "%0A"))


def test_damaged_archive(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "payload " * 100)], "page_id long, url string, html string")
    manifest = warc.write_archives(warc.record_chunks(pages))
    path = manifest.first()["archive"]
    data = open(path.removeprefix("file://"), "rb").read()
    broken = tmp_path / "broken.warc.gz"
    broken.write_bytes(data[:-40])
    with pytest.raises(Exception, match="ends inside|Error"):
        warc.read_archives(spark.createDataFrame([(str(broken),)], "archive string")).collect()


def test_lost_trailer(tmp_path):
    """An archive without the last bytes of its last gzip member is refused, though all of its payload is there."""
    writer = warc.ArchiveWriter(str(tmp_path), 1 << 30)
    for i in range(3):
        writer.add({"target": str(i), "url": "u", "size": 3, "digest": hashlib.sha256(b"abc").hexdigest(), "refers_to": None,
                    "chunk_no": 0, "data": b"abc", "last": True})
    writer.close()
    data = open(writer.done[0][0], "rb").read()
    for cut in range(9):
        source = pa.BufferReader(data[:len(data) - cut])
        if cut:
            with pytest.raises(ValueError, match="ends inside"):
                list(warc.archive_rows("a", source, 100, True))
        else:
            assert [r["data"] for r in warc.archive_rows("a", source, 100, True)] == [b"abc"] * 3


def test_revisits_name_the_record_they_refer_to():
    fields = lambda head: dict(x.split(b": ", 1) for x in head.split(b"\r\n\r\n")[0].split(b"\r\n")[1:])
    first = fields(warc.record_head("1", "u", 200, "d", None))
    later = [fields(warc.record_head("2", "u", 200, "d", "1")) for _ in range(2)]
    assert [x[b"WARC-Refers-To"] for x in later] == [first[b"WARC-Record-ID"]] * 2
    assert len({x[b"WARC-Record-ID"] for x in [first, *later]}) == 3


def test_no_pages(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    manifest = warc.write_archives(warc.record_chunks(pages))
    assert manifest.count() == warc.record_table(warc.read_archives(manifest)).count() == 0
