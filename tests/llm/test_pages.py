"""Operators on pages: hard cases by hand, and results against brute force."""

import gzip
import hashlib
import itertools
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F
from tillstream.llm import html_text, url_filter, warc
from tillstream.session import workspace

SHAPE = "page_id bigint, url string, html string"


def pages(spark, *rows):
    frame = spark.createDataFrame(list(rows), SHAPE)
    return frame.select("*", *[F.lit("other").alias(name) for name in ("host", "path", "text", "value", "content", "digest", "word", "rule")])


# URL filter -------------------------------------------------------------------------------------

RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
URLS = [
    None, "", "no scheme.net/x", "http://a.net", "http://a.net/", "https://A.B.NET/x?y#z", "http://net/", "http://internet/x",
    "http://example.net/en/1", "http://www.example.net/en/", "http://example.net/en", "http://badexample.net/en/1",
    "http://m.example.com/de/5", "http://example.com/DE/5", "http://example.com?x=/de/", "http://x.org/fr/", "http://x.org/fr",
    "http://org/fr/a://b.net/", "a://b://c.net/", "http://spam-farm.example.org/x", "http://my.casino/", "http://casinos.com/",
    "http://x.net:80/", "http://u@x.net/a", "http://example.com/de/\nnew", "http://é.net/ü", "http://a.net/" + "p" * 100_000,
]


def judged_by_hand(url):
    rest = (url or "").partition("://")[2] if "://" in (url or "") else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = host.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    fit = [(len(h + p), h + p, v) for h, p, v in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if fit:
        return host, path, max(fit)[1], max(fit)[2]
    unwanted = any(word in re.split("[^a-z0-9]+", host) for word in url_filter.UNWANTED_HOST_WORDS)
    return host, path, None, "block" if unwanted else "allow"


def test_urls_against_brute_force(spark):
    rows = [(i, url, None) for i, url in enumerate(URLS)] + [(None, URLS[4], ""), (4, URLS[4], "")]
    found = url_filter.judged_pages(pages(spark, *rows)).collect()
    expected = [(i, *judged_by_hand(url)) for i, url, _ in rows]
    assert sorted(map(tuple, found), key=repr) == sorted(expected, key=repr)
    assert url_filter.judged_pages(spark.createDataFrame([], SHAPE)).count() == 0


def test_rules_without_words_and_own_patterns(spark):
    any_rule = url_filter.Rule("any", r"(?s)^.{3}$", "block", (), 0)
    own = url_filter.Rule("own", r"(?s)/x\d+$", "block", ("x7",), 5)
    found = url_filter.judged_pages(pages(spark, (1, "h://abc", ""), (2, "h://abcd/x7", ""), (3, "h://abcd/x8", "")), [any_rule, own])
    assert {r.page_id: (r.rule, r.verdict) for r in found.collect()} == {1: ("any", "block"), 2: ("own", "block"), 3: (None, "allow")}


# main text --------------------------------------------------------------------------------------


def page(body, head=""):
    return f"<!DOCTYPE html><html><head><title>T</title>{head}</head><body>{body}</body></html>"


PROSE = "Some words of an article that goes on for a while, with a second sentence. "


def sample(number):
    menu = "".join(f"<li><a href='/{i}'>link {i}</a></li>" for i in range(6))
    prose = "".join(f"<p>{PROSE}{number} {i}</p>" for i in range(2 + number % 4))
    return page(
        f"<nav><ul>{menu}</ul></nav><!-- x --><div class=\"ad\">Buy now {number}</div><article><h1>Head {number}</h1>{prose}"
        f"</article><footer>&copy; me</footer>"
    )


@pytest.fixture(scope="module")
def trees():
    rng, rows, labels = np.random.default_rng(7), [], []
    for number in range(60):
        nodes = html_text.parse(sample(number))
        seen = [(nodes, html_text.taught(nodes))]
        seen += [x for x in (html_text._dressed(sample(number), rng) for _ in range(2)) if x]
        for tree, want in seen:
            rows.append(html_text.node_features(tree))
            labels.append(want)
    return html_text.boost(np.concatenate(rows), np.concatenate(labels))


def test_extraction_by_hand(spark):
    rows = [(i, f"u{i}", sample(i)) for i in range(40)]
    rows += [(100, None, None), (101, "u", ""), (102, "u", "plain text only"), (103, "u", "<p"), (None, "u", sample(1)), (1, "u1", sample(1))]
    frame = spark.createDataFrame(rows, SHAPE).withColumn("text", F.lit("other"))
    found = html_text.main_text(frame).collect()
    assert len(found) == len(rows) and all(r.n_chars == len(r.text) for r in found)
    of = {r.page_id: r.text for r in found}
    for i in range(40):
        assert of[i].split("\n") == [f"Head {i}", *[f"{PROSE}{i} {k}" for k in range(2 + i % 4)]]
    assert of[100] == of[101] == of[103] == "" and of[None] == of[1]
    assert html_text.main_text(spark.createDataFrame([], SHAPE)).count() == 0


@pytest.mark.parametrize(
    "extra",
    [
        "<aside class='sidebar'><p>Other things</p></aside>", "<div class='cookie-notice'>We use cookies</div>",
        "<section id='comments'><p>I think so too</p><p>Me too</p></section>", "<form class='subscribe'><p>Your mail</p></form>",
        "<header class='top'><p>Site name</p></header>", "<script>var x='<p>no</p>'</script>", "<style>p{}</style>",
    ],
)
@pytest.mark.parametrize("inside", [False, True])
def test_unwanted_blocks(trees, extra, inside):
    prose = f"<h1>Head</h1><p>{PROSE}one</p><p>{PROSE}two</p>"
    body = f"<article>{prose}{extra}</article>" if inside else f"{extra}<article>{prose}</article>{extra}"
    whole = page(f"<nav><ul><li><a href='/'>home</a></li></ul></nav>{body}<footer>c</footer>")
    [text] = html_text.extract([whole], trees)
    assert text == f"Head\n{PROSE}one\n{PROSE}two"


def test_blocks_of_a_tree():
    nodes = html_text.parse("<div>a &amp; b&nbsp;c<p>one\n two<b>bold<br>next<p>three<i> x</i></p>tail<hr>end<ul><li>1<li>2<ul><li>3</ul></ul></div>")
    texts = html_text.blocks(nodes, np.ones(len(nodes), np.int64))
    assert texts == ["a & b c", "one twobold next", "three x", "tail", "end", "1", "2", "3"]


@pytest.mark.parametrize("broken", ["<div class='x", "<div a=\"b><p>x</p>", "</p></div>", "<!-- open", "<script>never", "<<<>>>", "a < b > c", "<p/>" * 5000, "<div>" * 3000])
def test_broken_pages_are_read(trees, broken):
    alone, after = html_text.extract([broken, sample(3)[:-40] + broken], trees)
    assert isinstance(alone, str) and isinstance(after, str)


@pytest.mark.parametrize("size", [3, 63, 64, 200])
def test_place_among_siblings(size):
    """The place is counted among the siblings, however many there are."""
    rows = html_text.node_features(html_text.parse("<nav><p>a</p></nav>" + "<ul>" + "<li><p>x</p></li>" * size + "</ul>"))
    items = rows[4::2]  # after the document, nav, its paragraph and the list
    assert len(items) == size
    assert items[:, 7].tolist() == [min(k, 64) for k in range(size)] and set(items[:, 8]) == {min(size, 64)}


@pytest.mark.parametrize("tag", ["object", "noscript", "canvas", "audio", "video", "button"])
def test_text_of_embedded_elements_is_read(trees, tag):
    whole = f"<p>{PROSE}one <{tag}>{PROSE}fallback</{tag}> two</p>"
    nodes = html_text.parse(whole)
    assert html_text.blocks(nodes, np.ones(len(nodes), np.int64)) == [f"{PROSE}one", f"{PROSE}fallback", "two"]
    [text] = html_text.extract([page(f"<article><h1>Head</h1><p>{PROSE}</p><{tag}><p>{PROSE}fallback</p></{tag}></article>")], trees)
    assert f"{PROSE}fallback" in text


def test_formulas_and_drawings_belong_to_the_sentence():
    formula = "<math><mrow><mi>E</mi><mo>=</mo><msup><mi>mc</mi><mn>2</mn></msup></mrow></math>"
    nodes = html_text.parse(f"<p>So {formula} holds <svg><title>t</title><g><path d='x'/><text>here</text></g></svg> too</p>")
    assert html_text.blocks(nodes, np.ones(len(nodes), np.int64)) == ["So E=mc2 holds here too"]


def plain(number):
    prose = "".join(f"<p>{PROSE}{number} {i}</p>" for i in range(3))
    return page(f"<div><ul><li><a href='/'>home</a></li><li><a href='/b'>more</a></li></ul></div><div><h1>Head</h1>{prose}</div>")


def test_few_pages_that_name_their_content_are_found(spark):
    """Trees are learnt although no page of a sample of all would name a content element, or only seem to."""
    rows = [(i, "u", plain(i)) for i in range(60)] + [(100 + i, "u", sample(i)) for i in range(3)]
    rows += [(200 + i, "u", page(f"<nav><p class='main'>{i}</p></nav>")) for i in range(40)]
    frame = spark.createDataFrame(rows, SHAPE)
    ids = [r.page_id for r in frame.where("page_id < 100 OR page_id >= 200").orderBy(F.xxhash64("page_id")).limit(2).collect()]
    few = frame.where(F.col("page_id").isin(ids) | F.col("page_id").between(100, 102) | (F.col("page_id") >= 200))
    assert html_text.fit(few, 1) is not None


def test_without_any_named_content_density_decides(spark):
    frame = spark.createDataFrame([(i, "u", plain(i)) for i in range(5)] + [(9, "u", None)], SHAPE)
    assert html_text.fit(frame) is None
    found = {r.page_id: r.text for r in html_text.main_text(frame).collect()}
    assert found.pop(9) == ""
    assert all(text.split("\n") == ["Head", *[f"{PROSE}{i} {k}" for k in range(3)]] for i, text in found.items())


def test_decoding_is_the_best_of_all_labellings():
    """Small trees: no labelling that keeps to the rules is likelier."""
    rng = np.random.default_rng(4)
    for _ in range(60):
        nodes = html_text.parse("".join(rng.choice(["<div>", "</div>", "<ul>", "<li>", "x"]) for _ in range(9)))[:7]
        nodes = [html_text.Node(n.tag, n.words, n.parent, n.depth) for n in nodes]
        margin = rng.normal(0, 2, len(nodes))
        yes, no = -np.logaddexp(0, -margin), -np.logaddexp(0, margin)
        worth = lambda label: sum(yes[i] if kind == 1 else no[i] for i, kind in enumerate(label))
        allowed = []
        for label in itertools.product(range(3), repeat=len(nodes)):
            pairs = [(label[n.parent], label[i]) for i, n in enumerate(nodes) if i]
            if label[0] != 2 and all(not (up == 2 and own != 2) and not (up == 1 and own == 0) for up, own in pairs):
                allowed.append(worth(label))
        assert abs(worth(html_text.decode(nodes, margin)) - max(allowed)) < 1e-9


def without_names(page):
    """The page with containers all alike and without classes and ids."""
    page = re.sub(r"\s(?:class|id|role)=\"[^\"]*\"", "", page)
    return re.sub(r"<(/?)(?:article|nav|footer|aside|section|header|main)\b", r"<\1div", page)


def test_pages_without_any_names(spark):
    """Learnt from the table's pages, read on others whose elements' names tell nothing."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    trees = html_text.fit(pages.where("page_id % 2 = 0"))
    found = right = wanted = 0
    for row in pages.where("page_id % 2 = 1").collect():
        [named], [bare] = (html_text.extract([page], trees) for page in (row.html, without_names(row.html)))
        named, bare = named.split("\n"), bare.split("\n")
        found, wanted = found + len(bare), wanted + len(named)
        right += sum(block in named for block in bare)
    assert right / found > 0.95 and right / wanted > 0.95


@pytest.mark.parametrize("part", ["<div>", "<div><p>x", "<ul><li>", "<p>a</p>", "<table><tr><td>", "<span><b>", "</p></div>"])
def test_reading_takes_time_in_proportion(part):
    def seconds(size):
        began = time.perf_counter()
        html_text.node_features(html_text.parse(part * size))
        return time.perf_counter() - began

    seconds(1000)
    assert seconds(40_000) < 12 * max(seconds(10_000), 0.05)


def test_decoding_is_consistent():
    """Nothing below a node left out is chosen, and no frame lies in the content."""
    rng = np.random.default_rng(2)
    for _ in range(200):
        nodes = html_text.parse("".join(rng.choice(["<div>", "<p>", "</div>", "<ul>", "<li>", "x"]) for _ in range(40)))
        label = html_text.decode(nodes, rng.normal(0, 3, len(nodes)))
        for number, node in enumerate(nodes[1:], 1):
            above = label[node.parent]
            assert not (above == 2 and label[number] != 2) and not (above == 1 and label[number] == 0)


# archives ---------------------------------------------------------------------------------------

BIG = "<p>" + "x" * 150 + "</p>"
HARD = [
    (5, "http://a/", BIG), (2, "http://b c\n/é", BIG), (9, None, BIG), (2, "http://b", BIG), (3, "", "<p>small</p>"), (4, "u", "<p>small</p>"),
    (None, "http://n", BIG), (6, "http://e", None), (7, "http://e", ""), (8, "http://crlf", "a\r\n\r\nWARC/1.1\r\n\r\nContent-Length: 5\r\n" + "é日" * 60),
    (10, "http://only", "y" * 100), (11, "http://long", "long " * 200_000),
]


def test_archives(spark):
    found = warc.archived(pages(spark, *HARD).repartition(3), file_bytes=2000).collect()
    assert len(found) == len(HARD)
    payload = {}
    for i, _, html in HARD:
        payload.setdefault(hashlib.sha256((html or "").encode()).hexdigest(), []).append((i, html or ""))
    for row in found:
        same = payload[row.payload_digest]
        assert row.payload_bytes == len(same[0][1].encode())
        first = min(i for i, _ in same if i is not None)
        if row.record_type == "response":
            assert row.refers_to is None and (row.payload_bytes < 100 or row.page_id == first)
        else:
            assert row.refers_to == first and row.payload_bytes >= 100
    assert sorted(str(r.page_id) for r in found) == sorted(str(i) for i, _, _ in HARD)
    big = [r for r in found if r.payload_digest == hashlib.sha256(BIG.encode()).hexdigest()]
    assert sum(r.record_type == "response" for r in big) == 1 and len(big) == 5
    assert warc.archived(spark.createDataFrame([], SHAPE)).count() == 0


def test_both_arc_versions(spark):
    """Version blocks, field names and declared lengths; blocks may hold anything."""
    one = b"filedesc://x.arc 0.0.0.0 20060102030405 text/plain 76\n1 0 archive\nURL IP-address Archive-date Content-type Archive-length\n"
    body = b"HTTP/1.1 200 OK\r\nX-Page-Id: 7\r\n\r\nhttp://fake 0.0.0.0 20060102030405 text/html 3\n\n"
    fields = one.split(b"\n", 1)[1]
    one = one.replace(b" 76\n", f" {len(fields)}\n".encode())
    first = one + b"\nhttp://a/ 1.2.3.4 20060102030405 text/html " + str(len(body)).encode() + b"\n" + body + b"\n"
    two = b"2 0 archive\n" + warc.ARC_FIELDS["2"].encode() + b"\n"
    line = b"filedesc://y.arc 0.0.0.0 20070102030405 text/plain 200 - - 0 y.arc " + str(len(two)).encode() + b"\n"
    record = b"\nhttp://b/ 1.2.3.4 20070102030405 text/html 200 - - 99 y.arc " + str(len(body)).encode() + b"\n" + body
    rows = list(warc.parse_arc(first + line + two + record))
    assert [(name, f["URL"], f["Archive-date"], content) for name, _, f, content in rows] == [
        ("x.arc", "http://a/", "20060102030405", body), ("y.arc", "http://b/", "20070102030405", body),
    ]
    assert rows[1][2]["Result-code"] == "200"
    with pytest.raises(ValueError):
        list(warc.parse_arc((first + line + two + record)[:-3]))
    with pytest.raises(ValueError):
        list(warc.parse_arc(one.replace(b"1 0 archive", b"9 0 archive")))


def test_warc_records(spark):
    root = workspace(spark, "warc-test")
    warc.write_arc(pages(spark, *HARD[:2]), f"{root}/arc")
    records = warc.read_arc(spark, f"{root}/arc")
    assert {r.date for r in records.collect()} == {"2024-01-01T00:00:00Z"}
    assert {r.target_uri for r in records.collect()} == {"http://a/", "http://b%20c%0A/é"}
    warc.write_warc(warc.convert(records), f"{root}/warc")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(f"{root}/warc").collect()
    heads = [head for f in files for head, _ in warc.parse_warc(gzip.decompress(bytes(f.content)))]
    assert sorted(re.search(r"WARC-Type: (\w+)", head)[1] for head in heads) == ["response", "revisit"]
    revisit = next(head for head in heads if "revisit" in head)
    assert "WARC-Refers-To-Target-URI: http://b%20c%0A/é" in revisit and warc.REVISIT_PROFILE in revisit
    assert all(re.search(r"WARC-Record-ID: <urn:uuid:[0-9a-f-]{36}>", head) for head in heads)
