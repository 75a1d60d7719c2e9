"""Page and vector operators."""

from __future__ import annotations

import gzip
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.cases import CLASHES
from tierline.llm import main_text, neighbours, suffix_sort, warc
from tierline.session import scratch_path

PAGE = (
    "<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a='</p>';</script></head><body>"
    "<nav><ul><li><a href='/a'>Home</a></li></ul></nav><div class=\"ad\">Buy this now please</div>"
    "<article><h1>Big   news &amp; more</h1><p><b>First text</b> of the\n page.<br>Still here.</p>"
    "<div class='advert'>Click the banner</div><p>x&lt;y &#8364; end.</p></article>"
    "<section id='comments'><p>I liked it very much, thanks a lot for it</p></section><footer>&copy; site</foo"
)
TEXT = "Big news & more\nFirst text of the page. Still here.\nx<y € end."


def test_main_text_of_marked_and_unmarked_pages(spark):
    pages = [(i, f"http://{i}", PAGE) for i in range(5)]
    plain = PAGE.replace("<article>", "<div>").replace("</article>", "</div>")
    pages += [(5, None, plain), (6, "u", None), (7, "u", ""), (8, "u", "<p>"), (9, "u", "just words"), (10, "u", plain), (10, "u", plain)]
    df = spark.createDataFrame(pages, "page_id bigint, url string, html string").select("*", *(F.lit(1).alias(c) for c in CLASHES.split()))
    out = main_text.extract(df)
    assert out.columns == [*df.columns, "text"]
    got = {r.page_id: r.text for r in out.collect()}
    assert got == {**dict.fromkeys([0, 1, 2, 3, 4, 5, 10], TEXT), 6: "", 7: "", 8: "", 9: "just words"}
    assert main_text.extract(df.limit(0)).count() == 0
    assert main_text.extract(df.where("page_id = 9")).first().text == "just words"  # without labelled pages


@pytest.mark.parametrize("seed", range(20))
def test_best_stretch_against_all_stretches(seed):
    rnd = np.random.default_rng(seed)
    scores = rnd.integers(-5, 5, 30).tolist()
    a, b = main_text.best_stretch(scores)
    assert sum(scores[a:b]) == max([0] + [sum(scores[i:j]) for i in range(30) for j in range(i, 31)])


def test_main_text_keeps_links_cells_and_items_of_an_article():
    """Also where pages have taught that words of such places mostly stand outside."""
    weights = {"|p|0|1": 3.0, "|p|1|1": 3.0, "|td|0|0": -1.0, "|li|0|0": -1.0}
    long = "many words of the article stand before and after it here"
    page = f"<p>{long} and <a href='x'>a link</a> too</p><table><tr><td>one cell</td></tr></table><ul><li>an item</li></ul><p>{long}</p>"
    assert main_text.main_text(page, weights) == f"{long} and a link too\none cell\nan item\n{long}"


ARTICLE = "<p>The story has quite a few words here, and more of them follow.</p>"
STORY = "The story has quite a few words here, and more of them follow."
COMMENTS = "<div class='comments'><article><p>I like it</p></article></div>"


@pytest.mark.parametrize(
    "page",
    [
        f"<form id=aspnetForm><div class=menu>Home</div><article>{ARTICLE}{COMMENTS}</article></form>",
        f"<div class='layout has-sidebar'><main>{ARTICLE}</main><div class=sidebar><article>Other news</article></div></div>",
        f"<div class='no-sidebar'><div class='ad-free'>{ARTICLE}</div><div class=comments>I like it</div></div>",
        f"<main><div class='with-comments'><div>{ARTICLE}</div><div id=comments>I like it</div></div></main>",
        f"<article>{ARTICLE}</article><aside><article><p>Other news</p></article></aside>",
        f"<div class='sidebar'><article>{ARTICLE}</article></div>",
    ],
)
def test_main_text_within_wrappers_that_are_named(page):
    assert main_text.main_text(f"<html><body>{page}</body></html>", {}) == STORY
    inside = [t for t, _, _, _, inside in main_text.tokens(page) if inside]
    assert inside == ([STORY] if "<article" in page or "<main" in page else [])


def without_names(html: str) -> str:
    import re

    return re.sub(r"""\s(?:class|id|role)\s*=\s*(?:"[^"]*"|'[^']*'|[^\s>]+)""", "", html)


def test_main_text_does_not_need_names(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    weights = main_text.learn_weights(pages)
    for r in pages.collect():
        found = main_text.main_text(r.html, weights)
        assert found and main_text.main_text(without_names(r.html), weights) == found
        bare = without_names(r.html).replace("<article>", "<div>").replace("</article>", "</div>")
        assert main_text.main_text(bare, weights) == found
    links = "<ul><li><a href='/'>Home page</a></li><li><a href='/c'>Contact us</a></li></ul>"
    box = "<div>Buy this now please, dear friends</div>"
    for page in (f"<article>{ARTICLE}</article>{links}", f"<div>{ARTICLE}</div>{links}", f"{links}{box}<div>{ARTICLE}</div>{links}", f"{box}<article>{ARTICLE}</article>"):
        assert main_text.main_text(f"<html><body>{page}</body></html>", weights) == STORY
    words = "All of this text stands in plain boxes with breaks. " * 5
    assert main_text.main_text(f"<div>{links}<div>{words}<br>{words}</div></div>", weights) == (words * 2).strip()


@pytest.mark.parametrize(
    ("inner", "text"),
    [
        ("<p class='notice-board'>On the board.</p>", "On the board."),
        ("<p class='toc'>No links here.</p>", "No links here."),
        ("<div class='search-tips'>Some tips.</div>", "Some tips."),
        ("<p>A <a href=\"x>Hello</p>", "A Hello"),
        ("<p>&amp<b>lt;</b></p>", "&lt;"),
        ("<p>&am<b>p;</b> &lt<i>x</i></p>", "&amp; <x"),
        ("<div class='share-buttons'>Tell others</div><div class='advert-box'>Buy</div><ul class=toc><li><a href=x>One</a></li></ul>", ""),
    ],
)
def test_main_text_within_an_article(inner, text):
    page = f"<article>{ARTICLE}{inner}{ARTICLE}</article>"
    assert main_text.main_text(page, {}) == "\n".join(t for t in (STORY, text, STORY) if t)


def test_main_text_between_articles():
    two = f"<article>{ARTICLE}</article><p>Between them</p><div>a box</div><article>{ARTICLE}</article>"
    assert main_text.main_text(two, {}) == f"{STORY}\n{STORY}"
    story = " ".join([STORY] * 5)
    assert main_text.main_text(f"<article><p>Teaser</p></article><p>{story}</p><article><p>Teaser</p></article>", {}) == f"Teaser\n{story}\nTeaser"


def test_main_text_leaves_out_long_comments():
    page = f"<div>{ARTICLE}</div><div id='comments' class='comments-area'>{'I like it very much indeed. ' * 40}</div>"
    assert main_text.main_text(page, {}) == STORY
    marked = page.replace("div>", "article>", 1).replace("</div>", "</article>", 1).replace("id='comments' ", "")
    assert main_text.main_text(marked, {}) == STORY


def test_main_text_of_a_very_long_page():
    assert main_text.main_text("<p>" + "word " * 200_000, {}).count(" ") == 199_999
    assert main_text.main_text("<div>" * 20_000 + "deep" + "</b>" * 20_000, {}) == "deep"


def archive_rows(spark, pages, **options):
    df = spark.createDataFrame(pages, "page_id bigint, url string, html string").select("*", F.lit(1).alias("payload"), F.lit(2).alias("first"))
    folder = scratch_path(spark, "test-warc")
    warc.write_archive(df, folder, **options)
    return warc.read_archive(spark, folder).collect()


def test_archive_round_trip(spark):
    inside = "a\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n\x1f\x8b\x08"
    pages = [(3, "u", "same"), (1, "v", "same"), (2, None, "same"), (4, "u\r\nX: y", inside), (5, "u", None), (6, "u", ""), (7, "u", "é" * 70_000), (7, "u", "é" * 70_000), (None, "u", "same")]
    rows = archive_rows(spark, pages)
    assert all(r.kind == "record" for r in rows) and len(rows) == len(pages)
    got = {(r.record_id, r.record_type, r.refers_to, r.payload_bytes, None if r.payload is None else bytes(r.payload).decode()) for r in rows}
    name = "<urn:page:{}>".format
    assert got == {
        (name(1), "response", None, 4, "same"), (name(2), "revisit", name(1), 4, None), (name(3), "revisit", name(1), 4, None),
        (name("none"), "revisit", name(1), 4, None), (name(4), "response", None, len(inside.encode()), inside), (name(5), "response", None, 0, ""),
        (name(6), "revisit", name(5), 0, None), (name(7), "response", None, 140_000, "é" * 70_000),
    }
    assert {r.record_type for r in archive_rows(spark, pages, min_bytes=5) if r.record_id != name(7)} == {"response"}


def record(page: int, payload: bytes, **changed) -> bytes:
    import base64
    import hashlib

    digest = changed.get("digest", base64.b32encode(hashlib.sha1(payload).digest()).decode())
    length = changed.get("length", len(payload))
    return (
        f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:{page}>\r\nWARC-Payload-Digest: sha1:{digest}\r\nContent-Length: {length}\r\n\r\n"
    ).encode() + payload + b"\r\n\r\n"


def salvaged(data: bytes):
    found = list(warc.salvage(data))
    return [x.fields["warc-record-id"] for x in found if isinstance(x, warc.Record)], [(g.offset, g.length) for g in found if isinstance(g, warc.Gap)]


def test_salvage_recovers_what_follows_damage():
    a, b, c = record(1, b"one"), record(2, b"two"), record(3, b"three")
    ids = ["<urn:page:1>", "<urn:page:2>", "<urn:page:3>"]
    assert salvaged(a + b + c) == (ids, [])
    assert salvaged(a + b[5:] + c) == ([ids[0], ids[2]], [(len(a), len(b) - 5)])
    assert salvaged(a + record(2, b"two", digest="A" * 32) + c) == ([ids[0], ids[2]], [(len(a), len(b))])
    assert salvaged(a + record(2, b"two", length=9999) + c)[0] == [ids[0], ids[2]]
    assert salvaged(a + b[:-2])[0] == [ids[0]]  # cut off
    assert salvaged(b"junk" + a) == ([ids[0]], [(0, 4)])
    assert salvaged(b"") == ([], [])
    assert salvaged(b"\x00" * 1000) == ([], [(0, 1000)])


def test_salvage_of_gzip_members():
    a, b, c = (gzip.compress(record(i, b"payload" * i * 50)) for i in (1, 2, 3))
    ids = ["<urn:page:1>", "<urn:page:2>", "<urn:page:3>"]
    assert salvaged(a + b + c) == (ids, [])
    broken = b[:30] + bytes([b[30] ^ 255]) + b[31:]
    assert salvaged(a + broken + c)[0] == [ids[0], ids[2]]
    assert salvaged(a + b[:-20] + c)[0][0] == ids[0]
    assert salvaged(a + b[:-20] + c)[0][-1] == ids[2]
    assert salvaged(a + record(2, b"plain") + c)[0] == ids


def test_salvage_of_a_member_with_many_records():
    records = [record(i, bytes([i % 251]) * 997 * i) for i in range(1, 60)]
    ids = [f"<urn:page:{i}>" for i in range(1, 60)]
    rnd = np.random.default_rng(1)
    noise = [record(i, rnd.bytes(3_000)) for i in range(1, 60)]  # does not compress, so that pieces end between records
    whole = gzip.compress(b"".join(noise))
    assert salvaged(gzip.compress(b"".join(records)) + whole) == (ids + ids, [])
    found, gaps = salvaged(whole[:-5_000] + records[0])  # cut near its end
    assert found[:57] == ids[:57] and found[-1] == ids[0] and [g[0] for g in gaps] == [0]
    broken = bytearray(whole)
    broken[100_000] ^= 255
    found, gaps = salvaged(bytes(broken) + whole)
    assert found[:30] == ids[:30] and found[-59:] == ids and gaps[-1] == (0, len(whole))
    inside = gzip.compress(b"".join([*noise[:9], noise[9][20:], *noise[10:]]))  # sound, but one record in it is not
    assert salvaged(inside) == (ids[:9] + ids[10:], [(0, len(noise[9]) - 20)])
    assert salvaged(gzip.compress(b"") + records[0]) == (ids[:1], [])
    nothing = gzip.compress(b"no record at all")
    assert salvaged(nothing + records[0]) == (ids[:1], [(0, len(nothing))])


def test_members_are_inflated_piece_by_piece():
    """A member of 300 MB, of which one record at a time is held."""
    import tracemalloc

    one = record(1, b"\0" * (1 << 20))
    packer, parts = __import__("zlib").compressobj(1, wbits=31), []
    for _ in range(300):
        parts.append(packer.compress(one))
    data = b"".join([*parts, packer.flush()])
    tracemalloc.start()
    assert sum(isinstance(x, warc.Record) for x in warc.salvage(data)) == 300
    assert tracemalloc.get_traced_memory()[1] < 30 << 20
    tracemalloc.stop()


def test_archives_of_any_name_are_read(spark, tmp_path):
    (tmp_path / "X.WARC.GZ").write_bytes(gzip.compress(record(1, b"one")))
    (tmp_path / "Y.warc").write_bytes(record(2, b"two"))
    (tmp_path / "Z.WARC_").write_bytes(b"")
    rows = warc.read_archive(spark, str(tmp_path)).collect()
    assert sorted((r.archive, r.record_id) for r in rows) == [("X.WARC.GZ", "<urn:page:1>"), ("Y.warc", "<urn:page:2>")]


def test_chi_square_quantile():
    assert neighbours.chi_square_quantile(0.95, 1) == pytest.approx(3.841, abs=1e-3)
    assert neighbours.chi_square_quantile(0.95, 10) == pytest.approx(18.307, abs=1e-3)


def nearest_by_brute_force(x: np.ndarray, q: int, k: int = 10) -> np.ndarray:
    d = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
    d[q] = np.inf
    return np.lexsort((np.arange(len(x)), d))[:k]


def test_nearest_neighbours(spark):
    rnd = np.random.default_rng(3)
    centres = rnd.standard_normal((20, 16))
    x = centres[rnd.integers(0, 20, 3000)] + rnd.standard_normal((3000, 16)) * 0.3
    x[10] = x[20] = x[30]  # ties
    rows = [(i, v.tolist(), 1) for i, v in enumerate(x)]
    odd = [(5000, None, 1), (5100, [], 1), (5200, [0.0] * 16, 1), (5300, [math.nan] * 16, 1), (5400, [None] * 16, 1), (5500, [1.0], 1), (None, [1.0] * 16, 1), (5600, [math.inf] * 16, 1)]
    rows += odd + rows[:3]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, score int").repartition(4)
    got: dict = {}
    shares = {}
    # Small blocks, so that there are several cells, slices of cells and groups of queries.
    for r in neighbours.nearest(df, query_where=lambda i: i % 10 == 0, block_rows=150, query_rows=50).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
        shares[r.query_id] = r.n_verified / 2999
    assert sorted(got) == list(range(0, 3000, 10))
    hits = 0
    for q, found in got.items():
        d = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
        assert sorted(found) == list(range(1, 11))
        assert all(s == pytest.approx(d[v], abs=1e-12) for v, s in found.values())
        assert [found[k] for k in range(1, 11)] == sorted(found.values(), key=lambda f: (f[1], f[0]))
        hits += len({v for v, _ in found.values()} & set(nearest_by_brute_force(x, q).tolist()))
    assert hits >= 0.9 * 10 * len(got)
    assert max(shares.values()) <= 1 and np.mean(list(shares.values())) < 0.2  # groups far apart are not looked at
    assert [got[10][1][0], got[20][1][0], got[30][1][0]] == [20, 10, 10]
    assert neighbours.nearest(df.limit(0), query_where=lambda i: i % 10 == 0).count() == 0
    few = neighbours.nearest(df.where("vec_id in (0, 1, 2)").dropDuplicates(["vec_id"]), query_where=lambda i: i == 0).collect()
    assert len(few) == 2


def test_nearest_neighbours_of_each_length_and_of_equal_vectors(spark):
    rnd = np.random.default_rng(5)
    plane, solid = rnd.standard_normal((300, 2)), rnd.standard_normal((200, 3))
    rows = [(i, v.tolist()) for i, v in enumerate(plane)] + [(1000 + i, v.tolist()) for i, v in enumerate(solid)]
    rows += [(2000 + i, [5.0] * 4) for i in range(300)] + [(3000, [1e-200, 0.0, 0.0, 0.0, 0.0]), (3001, [1e200, 0.0, 0.0, 0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got: dict = {}
    for r in neighbours.nearest(df, query_where=lambda i: i % 50 == 0, block_rows=64, query_rows=3, confidence=0.9999).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id))
    found = {q: [v for _, v in sorted(f)] for q, f in got.items()}
    assert sorted(found) == [*range(0, 300, 50), *range(1000, 1200, 50), *range(2000, 2300, 50), 3000]
    assert all(found[q] == nearest_by_brute_force(plane, q).tolist() for q in range(0, 300, 50))
    assert all(found[1000 + q] == (1000 + nearest_by_brute_force(solid, q)).tolist() for q in range(0, 200, 50))
    assert found[2000] == list(range(2001, 2011)) and found[2050] == list(range(2000, 2010))
    assert found[3000] == [3001]


def test_recall_on_the_given_vectors(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = sorted((r.vec_id, r.embedding) for r in table.select("vec_id", "embedding").collect())
    ids, x = np.array([i for i, _ in rows]), np.array([v for _, v in rows])
    found = neighbours.query(spark, "/root/testdata/sf0.1").collect()
    asked = np.flatnonzero(ids % 100 == 0)
    hits = sum(r.vec_id in ids[nearest_by_brute_force(x, q)] for q in asked for r in found if r.query_id == ids[q])
    assert len(found) == 10 * len(asked) and hits >= 0.9 * len(found)


@pytest.mark.parametrize("seed", range(12))
def test_deep_shallow_order(seed):
    rnd = np.random.default_rng(seed)
    alphabet = [b"ab", b"abc\0", b"a"][seed % 3]
    stems = [bytes(rnd.choice(list(alphabet), rnd.integers(0, 90)).astype(np.uint8)) for _ in range(12)]
    strings = [stems[rnd.integers(12)] + bytes(rnd.choice(list(alphabet), rnd.integers(0, 60)).astype(np.uint8)) for _ in range(400)] + stems
    order = suffix_sort.deep_shallow_order(strings)
    assert sorted(order.tolist()) == list(range(len(strings)))
    assert [strings[i] for i in order] == sorted(strings)
    prefixes = suffix_sort.neighbour_prefixes(strings, order, 200)
    for k in range(1, len(order)):
        assert prefixes[k] == min(200, suffix_sort.common_prefix(strings[order[k - 1]], strings[order[k]]))
