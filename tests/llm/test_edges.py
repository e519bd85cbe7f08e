"""Nulls, empty and very long texts, ties, repeated rows, empty tables, clashing columns."""

import base64
import json
import random
import re
import time
import tracemalloc
from collections import Counter
from fractions import Fraction

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from sentiseries.llm import (
    components, decontaminate, html_text, line_quality, mixing, near_duplicates, quality_rules, queries, repeated_bytes, secret_scan, toxicity, url_filter,
)
from sentiseries.llm.common import labelled_sample
from tests.llm import brute

DOCS = "doc_id long, text string, lang string, source string, n_chars long, k long, n long, score double, slot long, digest string, spans string, host string, row long"


def prose(seed, count):
    pick = random.Random(seed)
    return " ".join("".join(pick.choices(["ta", "re", "no", "mi", "el", "su", "ka"], k=pick.randint(1, 4))) for _ in range(count))


LONG = prose(1, 260_000)
PASSAGE = prose(2, 150)
TEXTS = [
    (1, "one two three four five six seven eight nine ten " + PASSAGE), (2, None), (3, ""), (None, prose(3, 40)), (5, " \n\t "),
    (6, PASSAGE + " other words follow here"), (7, "few words"), (8, "few words"), (8, "few words"), (9, "FEW  words"), (10, LONG),
    (11, LONG[3000:-5000]), (None, None), (13, prose(4, 300)), (14, prose(4, 299) + " x"), (15, "é" * 500 + " ü"), (16, "aba " * 300),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, None, ("a", "b", None)[j % 3], None, 7, 7, 0.5, 3, "d", "s", "h", 5) for j, (i, t) in enumerate(TEXTS)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (1, 1, 0), (7, 0, 1), (7, 0, 1), (8, 0, 0), (None, 1, 1), (3, None, None), (13, 1, 0), (5, 0, 1)], "doc_id long, quality int, toxic int")


def by_key(rows):
    return sorted(map(tuple, rows), key=repr)


def test_repeated_bytes(docs, none):
    got = by_key(repeated_bytes.remove(docs).collect())
    assert [r[1:] for r in got] and repeated_bytes.remove(none).count() == 0
    small = [(i, t) for i, t in TEXTS if t is None or len(t) < 10_000]
    frame = docs.filter("text is null or length(text) < 10000")
    want = by_key((i, *r) for (i, _), r in zip(small, brute.repeated_bytes(t for _, t in small)))
    assert by_key(repeated_bytes.remove(frame).collect()) == want
    long = {r[0]: r for r in got}
    assert long[10][2] == len(LONG) - 8000 and long[10][3] == 1
    assert long[11][2] == len(LONG) - 8000 and long[11][3] == 1


def test_repeated_bytes_by_counting_strings(docs, monkeypatch):
    """A gram with many classes takes the other way and gives the same."""
    frame = docs.filter("text is null or length(text) < 10000")
    want = by_key(repeated_bytes.remove(frame).collect())
    monkeypatch.setattr(repeated_bytes, "CLASSES", 1)
    assert by_key(repeated_bytes.remove(frame).collect()) == want


def test_suffix_order_is_the_byte_order():
    pick = random.Random(5)
    texts = [bytes(pick.choices(b"ab", k=pick.randint(1, 30))) for _ in range(300)]
    group = np.sort(np.array([pick.randint(0, 9) for _ in texts]))
    data = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.array(list(map(len, texts)))
    order = repeated_bytes.suffix_order(repeated_bytes.Hashes(data), data, np.cumsum(sizes) - sizes, sizes, group)
    assert order.tolist() == sorted(range(len(texts)), key=lambda i: (group[i], texts[i], i))


def test_classifiers(docs, none, labels):
    for module, label in ((line_quality, "quality"), (toxicity, "toxic")):
        model = module.train(docs, labels, F.lit(True), label)
        rows = docs.select("doc_id", module.score("text", model).alias("s")).collect()
        assert len(rows) == len(TEXTS) and all(0 <= r["s"] <= 1 for r in rows)
        assert len({r["s"] for r, (_, t) in zip(rows, TEXTS) if not (t or "").strip()}) == 1
        for empty in (labels.limit(0), labels.filter(F.col(label) == 1)):
            level = module.train(docs, empty, F.lit(True), label)
            assert docs.select(module.score("text", level)).count() == len(TEXTS)
        assert none.select(module.score("text", module.train(none, labels, F.lit(True), label))).count() == 0


def test_toxic_pieces_of_a_long_text_have_all_grams():
    data = toxicity.plain(prose(9, 300_000))
    assert len(data) > toxicity.PIECE
    whole = {data[i : i + 5] for i in range(len(data) - 4)}
    codes = np.unique(np.concatenate([g for g in toxicity.grams(data)]))
    parts = set()
    for w in sorted(whole)[:2000]:
        parts.update(next(g for n, g in enumerate(toxicity.grams(w)) if n == 1).tolist())
    assert parts <= set(codes.tolist())


def test_chain_marginals_equal_enumeration():
    pick = np.random.default_rng(3)
    model = line_quality.Chain(pick.normal(size=line_quality.width()), pick.normal(size=(2, 2)))
    lines = [pick.integers(0, 2, (n, line_quality.width())) for n in (1, 4, 3)]
    good, total, pairs = model.marginals(lines)
    for x, p, z, q in zip(lines, good, total, pairs):
        emit, weight, mean, both = x @ model.weights, 0.0, np.zeros(len(x)), np.zeros((2, 2))
        for code in range(2 ** len(x)):
            y = [(code >> t) & 1 for t in range(len(x))]
            s = np.exp(sum(emit[t] for t in range(len(x)) if y[t]) + sum(model.pairs[a, b] for a, b in zip(y, y[1:])))
            weight += s
            mean += s * np.array(y)
            for a, b in zip(y, y[1:]):
                both[a, b] += s
        assert np.allclose(p, mean / weight) and np.isclose(z, np.log(weight)) and np.allclose(q, both / weight)


URLS = [
    ("http://WWW.Example.COM/en/x?y#z", "www.example.com", "/en/x", "www.example.com/en/", "allow"),
    ("https://a.example.com/en/", "a.example.com", "/en/", "example.com/en/", "block"),
    ("https://a.example.com/EN/", "a.example.com", "/EN/", "com/", "allow"),
    ("https://badexample.com/en/", "badexample.com", "/en/", "com/", "allow"),
    ("x://net/es/://q", "net", "/es/://q", "net/es/", "block"), ("x://a.net/es", "a.net", "/es", None, "allow"),
    ("x://a.com", "a.com", "", None, "allow"), ("x://a.com?/en/", "a.com", "", None, "allow"),
    ("http://spam-farm.org/", "spam-farm.org", "/", None, "block"), ("http://x.spamfarm.org/", "x.spamfarm.org", "/", None, "allow"),
    ("http://x.org/spam-farm/", "x.org", "/spam-farm/", None, "allow"), ("http://casino-win.net/de/", "casino-win.net", "/de/", None, "block"),
    ("http://casino.com/", "casino.com", "/", "com/", "allow"), ("http://x.net/fr/é?", "x.net", "/fr/é", "net/fr/", "block"),
    ("no address", "", "", None, "allow"), (None, "", "", None, "allow"), ("", "", "", None, "allow"), ("://", "", "", None, "allow"),
    ("http://a\nb.com/x", "a\nb.com", "/x", "com/", "allow"), ("http://" + "a." * 50_000 + "com/", "a." * 50_000 + "com", "/", "com/", "allow"),
]


def test_urls(spark):
    frame = spark.createDataFrame([(i, u[0], "site", "fits", 1) for i, u in enumerate(URLS + URLS)], "page_id long, url string, site string, fits string, rule int")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.judge(frame).collect()}
    for i, u in enumerate(URLS + URLS):
        assert got[i] == u[1:], u
    assert url_filter.judge(frame.limit(0)).count() == 0
    with pytest.raises(ValueError):
        url_filter.judge(frame, rules=())


def test_urls_with_a_second_address(spark):
    """Host and path are those of the first ``://``, also where no path follows the host."""
    urls = [
        ("http://a.example.net?u=http://b.org/fr/x", "a.example.net", "", None, "allow"),
        ("http://a.example.net#http://b.net/es/x", "a.example.net", "", None, "allow"),
        ("http://A.example.net/es/?u=http://b.org/fr/x", "a.example.net", "/es/", "net/es/", "block"),
        ("http://www.example.com/en/://b.net/fr/", "www.example.com", "/en/://b.net/fr/", "www.example.com/en/", "allow"),
        ("http://a.com?u=x://y\n/z", "a.com", "", None, "allow"), ("http://?://b.net/fr/", "", "", None, "allow"),
        ("a/b://c.net/fr/", "c.net", "/fr/", "net/fr/", "block"), (":// ://b/fr/", " :", "//b/fr/", None, "allow"),
    ]
    frame = spark.createDataFrame([(i, u[0]) for i, u in enumerate(urls)], "page_id long, url string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.judge(frame).collect()}
    assert [got[i] for i in range(len(urls))] == [u[1:] for u in urls]
    sql = duckdb.connect()
    sql.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR)")
    sql.executemany("INSERT INTO pages VALUES (?, ?)", [(i, u[0]) for i, u in enumerate(urls + URLS[:-1])])
    told = {r[0]: r[1:] for r in sql.execute(queries.ORACLE["op3_url_filter"]).fetchall()}
    assert [told[i] for i in range(len(told))] == [u[1:] for u in urls + URLS[:-1]]


PAGE = """<!doctype html><html><head><title>No</title><style>p{}</style></head><body class="has-sidebar">
<header class="top"><h1>Site name</h1></header><div id="cookie-notice">We use cookies to make this site nice for you.</div>
<nav><ul><li><a href="/">Home</a><li><a href='/b'>B</a></ul></nav>
<div class="wrap"><div class="post-content"><h2>A &amp; B</h2><p>First   paragraph with <a href=x>a link</a>,
caf&eacute; &#8212; and many more words.<p>Second.<table><tr><td>cell</td></tr></table>
<div class="share-buttons">Share this with all of your many friends</div><form>Name <input><button>Go</button></form></div>
<aside><p>Related stories that are long enough to look like text in every way.</p></aside>
<section id="comments"><p>A reader writes a long and thoughtful remark about the article above.</p></section></div>
<div class="ad">Buy this thing, it is the very best thing that there is.</div>
<footer>Copyright</footer><script>if (a < b) document.write("<p>x</p>")</script></body>"""


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("   ", ""), ("<p>", ""), ("<!-- open <p>text", ""), ("<script>x", ""),
    (PAGE, "A & B First paragraph with a link, café — and many more words. Second. cell"),
    ("<p>A page with no marks at all, but with enough words.</p><p>And more.</p>", "A page with no marks at all, but with enough words. And more."),
    ("<ul><li><a href=a>One</a><li><a href=b>Two words</a></ul>", ""),
    ("a plain text without any tag, 1 < 2 and 3 > 2, as it is", "a plain text without any tag, 1 < 2 and 3 > 2, as it is"),
])
def test_pages(page, text):
    assert html_text.main_text(page, html_text.tree()) == text


@pytest.mark.parametrize("name", ["notice", "notices", "site-notice", "siteNotice", "noticeBox", "no-print notice"])
def test_notices_are_not_main_text(name):
    story = "This is the story of the page and it has more than ten words."
    notice = f'<div class="{name}">Please note that this site will be closed for repairs on the whole of next Sunday.</div>'
    for page in (f"{notice}<article><p>{story}</p></article>", f"<article><p>{story}</p>{notice}</article>", f"<div class=post><p>{story}</p></div>{notice}"):
        assert html_text.main_text(page, html_text.tree()) == story


@pytest.mark.parametrize("name", ["has-sidebar", "no_nav", "with-ads", "without-comments", "hasSidebar", "pageNoNav", "no-sidebar with-header"])
def test_layout_words_give_no_mark(name):
    assert html_text.marks_of("div", f' class="{name}"') == frozenset()


@pytest.mark.parametrize("page, parts", [
    ('<a "' * 400_000, None), ("<a" * 400_000, None), ("<a '<b \"" * 200_000, None), ("<a x" * 400_000, None),
    ("<div>" * 100_000 + "</span>" * 100_000, 0), ("</span>" * 100_000, 0), ("<script>" + "</script " * 100_000, 0),
    ("<p>" + "&#" + "9" * 100_000 + ";", 1), ("<p>&#" + "0" * 100_000 + "65;", 1), ("<!-" * 300_000, 0), ("<p title='" * 200_000, None),
], ids=range(11))
def test_malformed_pages_take_linear_time(page, parts):
    start = time.perf_counter()
    found = html_text.blocks(page)
    assert time.perf_counter() - start < 4
    if parts is not None:
        assert len(found) == parts


def test_tags_are_those_of_one_expression():
    """Against the grammar as a single pattern, on random strings of its signs."""
    pattern = re.compile(
        r"""<(?:!--(?:.*?--!?>|.*\Z)|(/?)([A-Za-z][^\s/>]*+)((?:"[^"]*"|'[^']*'|[^'">])*+)>|[!?/][^>]*(?:>|\Z))""", re.S
    )
    deal = random.Random(4)
    for _ in range(20_000):
        page = "".join(deal.choices(["<", ">", '"', "'", "/", "a", "B ", " ", "=", "!--", "-->", "?", "é"], k=deal.randint(1, 30)))
        tags, at = html_text.Tags(page), 0
        while True:
            m, got = pattern.search(page, at), tags.next(at)
            assert (m is None) == (got is None), page
            if m is None:
                break
            assert got == (m.start(), m.end(), bool(m[1]), (m[2] or "").lower(), m[3] or ""), page
            at = m.end()


def test_references_of_any_length():
    assert html_text.decoded("&#00000000000000000065;&#" + "9" * 9000 + ";&#x" + "f" * 30 + ";&#" + "0" * 40 + ";&amp;") == "A\ufffd\ufffd\ufffd&"


def test_long_and_many_pages(spark):
    body = "<article>" + "".join(f"<p>{prose(i, 30)}</p>" for i in range(2000)) + "</article>"
    frame = spark.createDataFrame([(1, body), (1, body), (None, None)], "page_id long, html string")
    texts = [r["t"] for r in frame.select(html_text.extract("html").alias("t")).collect()]
    assert texts[0] == texts[1] == " ".join(prose(i, 30) for i in range(2000)) and texts[2] == ""


def tlv(tag, body):
    size = len(body)
    head = bytes([size]) if size < 128 else bytes([0x82]) + size.to_bytes(2, "big")
    return bytes([tag]) + head + body


RSA = tlv(0x30, tlv(2, b"\0") + b"".join(tlv(2, bytes([k + 1]) * 40) for k in range(8)))
EC = tlv(0x30, tlv(2, b"\1") + tlv(4, bytes(range(1, 33))))
PKCS8 = tlv(0x30, tlv(2, b"\0") + tlv(0x30, tlv(6, b"*\x86H") + tlv(5, b"")) + tlv(4, EC))
JWT = ".".join(base64.urlsafe_b64encode(json.dumps(x).encode()).decode().rstrip("=") for x in ({"alg": "HS256"}, {"sub": "1"})) + ".c2ln"


def test_secrets_are_confirmed_by_structure():
    for key in (RSA, EC, PKCS8):
        text = "é key " + base64.b64encode(key).decode() + " end"
        assert ("der", 6, len(text) - 4) in secret_scan.scan(text)
        assert any(k == "der" for k, *_ in secret_scan.scan("x " + key.hex().upper() + " y"))
        broken = base64.b64encode(key[:-1]).decode()
        assert not any(k == "der" for k, *_ in secret_scan.scan("é key " + broken + " end"))
    pem = "-----BEGIN RSA PRIVATE KEY-----\n" + base64.encodebytes(RSA).decode() + "-----END RSA PRIVATE KEY-----"
    assert ("pem", 0, len(pem)) in secret_scan.scan(pem)
    assert not any(k == "pem" for k, *_ in secret_scan.scan(pem.replace("MI", "XX", 1)))
    assert ("jwt", 0, len(JWT)) in secret_scan.scan(JWT)
    assert not any(k == "jwt" for k, *_ in secret_scan.scan("eyJhbGci.eyJzdWIi.x"))
    ssh = base64.b64encode(b"openssh-key-v1\0" + bytes(60)).decode()
    assert any(k == "ssh" for k, *_ in secret_scan.scan(ssh))


def test_rarer_private_keys():
    dsa = tlv(0x30, tlv(2, b"\0") + b"".join(tlv(2, bytes([k + 1]) * n) for k, n in enumerate((128, 20, 128, 128, 20))))
    five = tlv(0x30, tlv(2, b"\0") + b"".join(tlv(2, bytes([k + 1]) * 40) for k in range(4)))
    for text in (base64.b64encode(dsa).decode(), dsa.hex()):
        assert ("der", 2, len(text) + 2) in secret_scan.scan(f"x {text} y")
    assert not any(k == "der" for k, *_ in secret_scan.scan(base64.b64encode(five).decode()))
    pem = "-----BEGIN DSA PRIVATE KEY-----\n" + base64.encodebytes(dsa).decode() + "-----END DSA PRIVATE KEY-----"
    assert ("pem", 0, len(pem)) in secret_scan.scan(pem)

    cipher = base64.encodebytes(bytes(random.Random(6).randbytes(320))).decode()
    head = "Proc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,0A1B2C3D4E5F60718293A4B5C6D7E8F9\n\n"
    block = "-----BEGIN RSA PRIVATE KEY-----\n{}-----END RSA PRIVATE KEY-----"
    locked = block.format(head + cipher)
    for text in (locked, locked.replace("\n", "\r\n"), locked.replace("\n", "\\n"), locked.replace("\n", "\n    ")):
        assert ("pem", 2, len(text) + 2) in secret_scan.scan(f"x {text} y")
        assert secret_scan.masked(f"x {text} y", secret_scan.scan(f"x {text} y")) == "x [secret] y"
    noted = block.format("Comment: made by hand\n\n" + base64.encodebytes(RSA).decode())
    assert ("pem", 0, len(noted)) in secret_scan.scan(noted)
    for text in (block.format(cipher), block.format("Comment: none\n\n" + cipher), block.format(head), block.format(head + "not base64!\n")):
        assert not any(k == "pem" for k, *_ in secret_scan.scan(text))


def test_secret_rows(docs, none):
    assert secret_scan.scan(None) == secret_scan.scan("") == []
    text = "ToKeN: short; secret=abcdefghijkl AKIA" + "A" * 14 + " 0123456789abcdef"
    assert [s for s in secret_scan.scan(text)] == brute.base_spans(text)
    assert secret_scan.masked("a token=abcdefghijklmno b", secret_scan.scan("a token=abcdefghijklmno b")) == "a [secret] b"
    found = secret_scan.find(docs).collect()
    assert len(found) == len(TEXTS) and found[1]["spans"] == []
    same = secret_scan.redact(docs)
    assert same.columns == docs.columns and by_key(same.collect()) == by_key(docs.collect())
    assert secret_scan.redact(none).count() == secret_scan.find(none).count() == 0


def test_containment(spark, docs, none):
    items = [(1, PASSAGE), (2, None), (3, ""), (None, "few words"), (5, " ".join(LONG.split()[100_000:100_040])), (5, PASSAGE[400:800]), (6, prose(77, 30)), (7, PASSAGE)]
    frame = spark.createDataFrame(items, "item_id long, text string")
    want = brute.contained([d for d in TEXTS], items)
    assert by_key(decontaminate.contained(docs, frame).collect()) == want
    assert decontaminate.contained(none, frame).count() == decontaminate.contained(docs, frame.limit(0)).count() == 0


@pytest.mark.parametrize("size", [5, 6, 7])
def test_no_small_item_is_missed(size):
    """Items of one to three shingles, each in one long text."""
    texts = [prose(1000 + i, 60) for i in range(3000)]
    items = [" ".join(t.split()[20 : 20 + size]) for t in texts]
    found = {(t, i) for t, i, shared, total in decontaminate.Index(items + [items[0], None]).search(texts)}
    assert {(i, i) for i in range(3000)} | {(0, 3000)} <= found
    assert all(" ".join(["", *(items + items[:1])[i].split(), ""]) in f" {texts[t]} " for t, i in found)


def test_containment_in_blocks(spark, docs, monkeypatch):
    items = [(i, " ".join(PASSAGE.split()[i : i + 20])) for i in range(5)]
    frame = spark.createDataFrame(items, "item_id long, text string").repartition(1)
    monkeypatch.setattr(decontaminate, "ITEMS", 2)
    assert by_key(decontaminate.contained(docs, frame).collect()) == brute.contained(TEXTS, items)


def test_mixing(docs, none):
    rows = mixing.mix(docs, block=2).collect()
    assert len(rows) == len(TEXTS) and len({(r["slot"], r["place"]) for r in rows}) == len(TEXTS)
    assert {r["source"] for r in rows} == {"a", "b", None}
    assert mixing.mix(none).count() == 0 and set(mixing.mix(none).columns) == {*docs.columns, "block", "place", "balanced"}
    with pytest.raises(ValueError):
        mixing.mix(docs, {"a": 1.0})
    with pytest.raises(ValueError):
        mixing.exact({"a": 0.0})


def test_mixing_splits_null_and_repeated_ids(spark, monkeypatch):
    """Rows without an id, or all of one id, fill as many slices as others, in the same order every time."""
    monkeypatch.setattr(mixing, "SLICE", 100)
    frame = spark.range(4000).select(
        F.when(F.col("id") % 2 > 0, F.lit(7)).alias("doc_id"), F.lit("a").alias("source"), F.concat(F.lit("text "), "id").alias("text"),
        F.create_map(F.lit("k"), "id").alias("extra"),
    )
    seen = []
    ahead = mixing._ahead
    monkeypatch.setattr(mixing, "_ahead", lambda spark, sizes, *rest: seen.append(sizes) or ahead(spark, sizes, *rest))
    placed = {r["text"]: (r["block"], r["place"]) for r in mixing.mix(frame).collect()}
    assert sorted(placed.values()) == [divmod(i, mixing.BLOCK) for i in range(4000)]
    assert len(seen[0]) == 40 and max(n for *_, n in seen[0]) < 160
    assert placed == {r["text"]: (r["block"], r["place"]) for r in mixing.mix(frame.repartition(5)).collect()}


def test_sample_takes_one_row_an_id_of_any_type(spark):
    many = spark.range(20_000).select(F.lit("b").alias("doc_id"), F.concat(F.lit("words "), "id").alias("text"))
    docs = many.union(spark.createDataFrame([("a", "good"), ("c", None), (None, "x")], "doc_id string, text string"))
    labels = spark.createDataFrame([("a", 1), ("b", 0), ("b", 0), ("c", 1), ("d", 1)], "doc_id string, quality int")
    pick = lambda frame: sorted(map(tuple, labelled_sample(frame, labels, "quality", F.lit(True), 5).collect()), key=repr)
    rows = pick(docs)
    assert [(t, y, w) for t, y, w in rows if y] == [("good", 1, 1.0), (None, 1, 1.0)] and len(rows) == 3
    assert rows == pick(docs.repartition(3))


def test_line_quality_fits_beside_one_long_text(monkeypatch):
    """Memory and steps follow the lines there are, not the longest text times the number of texts."""
    monkeypatch.setattr(line_quality, "ROUNDS", 60)
    rng = np.random.default_rng(3)
    lines = [(rng.random((n, line_quality.width())) < 0.2).astype(np.uint8) for n in [5] * 2000 + [100_000]]
    labels = np.array([i % 2 for i in range(2001)], float)
    for x, y in zip(lines, labels):
        x[:, 0] = y
    tracemalloc.start()
    begin = time.monotonic()
    model = line_quality.Chain.fit(lines, labels, np.ones(2001))
    assert tracemalloc.get_traced_memory()[1] < 500 << 20 and time.monotonic() - begin < 120
    tracemalloc.stop()
    good = model.marginals(lines[:100])[0]
    assert all((g > 0.5).all() == bool(y) for g, y in zip(good, labels))


def test_slices_of_a_source_follow_each_other(spark, monkeypatch):
    frame = spark.range(1000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 > 0, "big").alias("source"))
    want = by_key(mixing.mix(frame).collect())
    monkeypatch.setattr(mixing, "SLICE", 40)
    assert by_key(mixing.mix(frame).collect()) == want


@pytest.mark.parametrize("weights", [{"a": 1.0}, {"a": 5.0, "b": 1.0, None: 0.1}, dict.fromkeys(map(str, range(37)), 1.0), {str(i): 1.5**i for i in range(20)}])
def test_schedule_meets_all_deadlines(weights):
    shares = mixing.exact(weights)
    total = sum(shares.values())
    blocks = {s: 1000 * n // total + 1 for s, n in shares.items()}
    slots = mixing.schedule(shares, blocks)
    assert {s: len(x) for s, x in slots.items()} == blocks
    assert len({s for x in slots.values() for s in x}) == sum(blocks.values())
    for name, at in slots.items():
        for k, slot in enumerate(at):
            assert k * total // shares[name] <= slot < -(-(k + 1) * total // shares[name])


@pytest.mark.parametrize("sources, rows", [(20, 60_000), (1200, 24_000)])
def test_mixing_keeps_target_weights_with_a_hot_source(spark, sources, rows):
    """Less than one block from the weights asked for, not from rounded ones, in every slot."""
    frame = spark.range(rows).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 > 0, (F.col("id") % (sources - 1)).cast("string")).otherwise("hot").alias("source")
    )
    weights = mixing.tempered(Counter(r["source"] for r in frame.collect()))
    got = sorted((r["slot"], r["source"], r["block"]) for r in mixing.mix(frame, block=1).collect() if r["balanced"])
    assert [s for s, *_ in got] == list(range(len(got))) and len(got) > sources
    shares = mixing.exact(weights)
    total, done = sum(shares.values()), Counter()
    assert all(shares[s] * sum(map(Fraction, weights.values())) == total * Fraction(w) for s, w in weights.items())
    for slot, source, block in got:
        assert block == done[source]
        done[source] += 1
        for name in (source, "hot"):
            assert abs(done[name] * total - shares[name] * (slot + 1)) < total
    # a source that was not served for long is late by its next block's deadline at most
    for name, share in shares.items():
        assert abs(done[name] * total - share * len(got)) < total


def test_schedule_of_exact_weights_meets_all_deadlines():
    counts = {"hot": 100_000} | {str(i): 400 + i for i in range(499)}
    shares = mixing.exact(mixing.tempered(counts))
    total, blocks = sum(shares.values()), {s: n // 16 + 1 for s, n in counts.items()}
    slots = mixing.schedule(shares, blocks)
    assert {s: len(x) for s, x in slots.items()} == blocks and len({t for x in slots.values() for t in x}) == sum(blocks.values())
    for name, at in slots.items():
        assert all(k * total // shares[name] <= slot < -(-(k + 1) * total // shares[name]) for k, slot in enumerate(at))


def test_quality_rules(docs, none):
    rows = quality_rules.weigh(docs).collect()
    got = sorted(((r["doc_id"], *tuple(r)[1:6]) for r in rows), key=repr)
    assert got == sorted(((i, *brute.rule_measures(t)[:5]) for i, t in TEXTS), key=repr)
    assert all(0 <= r["quality"] <= 1 for r in rows)
    assert quality_rules.weigh(none).count() == 0


def test_fit_finds_the_rules_that_agree():
    patterns = [((1, 1, 1), 900), ((0, 0, 1), 80), ((0, 1, 1), 4), ((1, 0, 1), 4), ((1, 1, 0), 300)]
    odds, adds = quality_rules.fit(patterns)
    good = {p: odds + sum(adds[j, v] for j, v in enumerate(p)) > 0 for p, _ in patterns}
    assert good[(1, 1, 1)] and not good[(0, 0, 1)]


def test_near_duplicates(docs, none):
    rows = [(i, t) for i, t in TEXTS if i is not None]
    frame = docs.filter("doc_id is not null")
    want = by_key((i, *r) for (i, _), r in zip(rows, brute.near_groups(rows)))
    assert by_key(near_duplicates.group(frame).collect()) == want
    with_nulls = near_duplicates.group(docs).collect()
    assert len(with_nulls) == len(TEXTS) and by_key(r for r in with_nulls if r[0] is not None) == want
    assert near_duplicates.group(none).count() == 0


def test_near_duplicates_off_the_star(spark):
    """Chains and groups that meet in the same band keys, against all pairs."""
    pick = random.Random(8)
    base = prose(11, 120).split()
    rows = []
    for i in range(60):
        words = list(base)
        for _ in range(pick.choice([0, 1, 2, 4, 6])):
            words[pick.randrange(len(words))] = f"w{pick.randrange(40)}"
        rows.append((i, " ".join(words)))
    got = near_duplicates.group(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert by_key(got) == by_key((i, *r) for (i, _), r in zip(rows, brute.near_groups(rows)))


def test_near_duplicates_write_few_files(spark, monkeypatch):
    """No table of all rows, and one file for a round over few edges, however many partitions there are."""
    import glob

    pick = random.Random(5)
    rows = []
    for g in range(12):
        for i in range(8):
            words = prose(20 + g, 150).split()
            words[pick.randrange(150)] = f"w{i}"
            rows += [(len(rows) + c, " ".join(words)) for c in range(4)]
    tables = []

    def spy(df, name="table", f=near_duplicates.stored):
        if name == "classes":  # the pass over the texts runs once
            assert df._jdf.queryExecution().optimizedPlan().toString().count("ArrowEvalPython") == 1
        out = f(df, name)
        tables.append((name, out.count(), sum(len(glob.glob(p.removeprefix("file:") + "/part-*")) for p in {q.rpartition("/")[0] for q in out.inputFiles()})))
        return out

    monkeypatch.setattr(near_duplicates, "stored", spy)
    monkeypatch.setattr(components, "stored", spy)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = near_duplicates.group(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert by_key(got) == by_key((i, *r) for (i, _), r in zip(rows, brute.near_groups(rows)))
    assert len(rows) not in [n for name, n, _ in tables if name != "shared"], tables
    rounds = [files for name, _, files in tables if name == "edges"]
    assert len(rounds) > 1 and all(files == 1 for files in rounds[1:]), tables


def test_components(spark):
    pick = random.Random(4)
    pairs = [(i, i + 1) for i in range(0, 40)] + [(pick.randrange(100, 200), pick.randrange(100, 200)) for _ in range(60)] + [(7, 7), (None, 3), (500, 499)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in pairs:
        if a is not None and a != b:
            parent[max(find(a), find(b))] = min(find(a), find(b))
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {x: find(x) for x in list(parent)}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_pipeline_over_edges(spark, docs, none, labels, tmp_path):
    import corpus_pipeline

    for name, frame in (("some", docs), ("none", none)):
        folder = str(tmp_path / name)
        frame.write.parquet(f"{folder}/documents.parquet")
        labels.write.parquet(f"{folder}/labels.parquet")
        spark.createDataFrame([(1, PASSAGE[:300])], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
        rows = corpus_pipeline.run(spark, folder).collect()
        assert len(rows) <= frame.count() and not {r["doc_id"] for r in rows} & {1, 6}
        assert Counter(r["slot"] for r in rows).keys() == {r["slot"] for r in rows}


def test_stages_judge_rows_not_ids(spark, tmp_path):
    """Null, repeated and shared ids in the stages that remove near copies and contaminated documents."""
    import corpus_pipeline

    stages = dict(corpus_pipeline.STAGES)
    folder = str(tmp_path)
    spark.createDataFrame([(1, PASSAGE)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    dirty, clean = "before it " + PASSAGE + " after it", [prose(s, 60) for s in range(40, 46)]
    rows = [(None, dirty, "a"), (None, clean[0], "a"), (1, dirty, "a"), (1, dirty, "a"), (1, clean[1], "a"), (2, clean[2], "a"), (2, clean[2], "a"), (3, None, "a"), (1, "", None), (None, None, "b")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = by_key(stages["decontamination"](spark, frame, folder).collect())
    assert got == by_key(r for r in rows if r[1] != dirty)

    near = lambda s: s + " tail"
    groups = [
        [(None, clean[0], "a"), (None, clean[0], "a"), (None, near(clean[0]), "b")],
        [(None, clean[1], "a"), (5, near(clean[1]), "b"), (5, near(clean[1]), "b"), (5, near(clean[1]), None), (6, clean[1], "a")],
        [(7, clean[2], "a"), (7, clean[2].upper(), "a"), (8, clean[2], "a")],
        [(6, clean[3], "a")], [(8, clean[4], "a")], [(None, clean[5], "a")],
    ]
    wordless = [(5, None, "a"), (5, None, "a"), (8, "", "b"), (None, " ", "b"), (6, None, clean[1])]
    rows = [r for g in groups for r in g] + wordless
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    out = stages["near_duplicates"](spark, frame, folder)
    got = Counter(map(tuple, out.collect()))
    assert out.columns == frame.columns and sum(got.values()) == len(groups) + len(wordless)
    for g in groups:
        held = [r for r in set(g) for _ in range(got[r])]
        assert len(held) == 1 and held[0][0] == min((r[0] for r in g if r[0] is not None), default=None), held
    assert all(got[r] == n for r, n in Counter(wordless).items())
