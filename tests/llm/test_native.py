"""Exact dedup, sharding, quality rules and page text: edge rows and brute force."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import pytest

from paxflow.llm import exact_dedup, sharding
from paxflow.llm.exact_dedup import drop_exact_copies, exact_groups
from paxflow.llm.html_text import RUN, blocks_of, main_text
from paxflow.llm.quality import Limits, keep_good, quality_rules, without_boilerplate
from paxflow.llm.queries import QUERIES
from paxflow.llm.sharding import sharded

SF_DIR = "/root/testdata/sf0.01"
CLASHES = "doc_id long, text string, source string, run int, row string, digest string, record int, slot int"


def docs(spark, rows, partitions=7):
    data = [(d, t, s, 1, "r", None, 2, None) for d, t, s in rows]
    return spark.createDataFrame(data, CLASHES).repartition(partitions)


EDGE = [(1, "a", "h"), (2, "a", "h"), (3, None, "h"), (4, "", None), (None, "a", "h"), (5, "A", "h"),
        (2, "a", "h"), (2, "a", "h"), (6, "w " * 40_000, "h"), (None, None, None), (7, "a ", "h")]


@pytest.mark.parametrize("fan_in", [2, 8])
@pytest.mark.parametrize("keep", ["largest", "smallest"])
def test_exact_groups(spark, monkeypatch, fan_in, keep):
    monkeypatch.setattr(exact_dedup, "FAN_IN", fan_in)
    found = exact_groups(docs(spark, EDGE), keep=keep).collect()
    assert len(found) == len(EDGE)
    groups = {}
    for d, t, _ in EDGE:
        groups.setdefault(hashlib.sha256((t or "").encode()).hexdigest(), []).append(d)
    best = lambda ids: (max if keep == "largest" else min)(ids, key=lambda d: (d is not None, d))
    for r in found:
        own = groups[r.text_sha256]
        assert (r.group_size, r.keep_id) == (len(own), best(own))
    kept = Counter(r.text_sha256 for r in found if r.kept)
    assert kept == {k: 1 for k in groups}


def test_drop_exact_copies(spark):
    table = docs(spark, EDGE)
    stay = drop_exact_copies(table)
    assert stay.columns == table.columns
    assert sorted(Counter(r.text or "" for r in stay.collect()).values()) == [1] * 5
    assert drop_exact_copies(table.limit(0)).count() == 0


@pytest.mark.parametrize("bucket_rows", [3, 512])
def test_shards(spark, monkeypatch, bucket_rows):
    monkeypatch.setattr(sharding, "BUCKET_ROWS", bucket_rows)
    rng = random.Random(bucket_rows)
    rows = EDGE + [(100 + i, "x" * rng.randrange(50), "h") for i in range(90)] + [(2, "a", "h")] * 60
    table = docs(spark, rows)
    found = sharded(table, 8, seed=3).collect()
    assert sorted(map(repr, (r.record for r in found))) == sorted(map(repr, table.collect()))
    sizes = Counter(r.shard for r in found)
    assert set(sizes) == set(range(8)) and max(sizes.values()) - min(sizes.values()) <= 1
    for shard, n in sizes.items():
        assert sorted(r.slot for r in found if r.shard == shard) == list(range(n))
    order = [r.record.doc_id for r in sorted(found, key=lambda r: (r.shard, r.slot))]
    assert order != sorted(order, key=str)
    assert sharded(table.limit(0), 8).count() == 0


def test_shuffle_is_a_function_of_seed_and_ids(spark):
    rows = [(i, f"t{i}", "h") for i in range(300)]
    one = {(r.record.doc_id, r.shard, r.slot) for r in sharded(docs(spark, rows, 3), 5, seed=1).collect()}
    two = {(r.record.doc_id, r.shard, r.slot) for r in sharded(docs(spark, rows, 9), 5, seed=1).collect()}
    other = {(r.record.doc_id, r.shard, r.slot) for r in sharded(docs(spark, rows, 3), 5, seed=2).collect()}
    assert one == two != other


def test_permutation_is_fisher_yates(spark):
    from pyspark.sql import functions as F

    def plain(n, seed, bucket):
        a = list(range(1, n + 1))
        for i in range(n, 1, -1):
            h = int(hashlib.md5(f"{seed}:{bucket}:{i}".encode()).hexdigest()[:15], 16)
            j = 1 + h % i
            a[i - 1], a[j - 1] = a[j - 1], a[i - 1]
        return a

    rows = spark.range(4).select("id", F.expr("cast(id * id * 7 + 1 as int)").alias("n"))
    for r in rows.select("id", "n", sharding.permutation(F.col("n"), 9, F.col("id")).alias("p")).collect():
        assert r.p == plain(r.n, 9, r.id)


def test_shard_query(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    found = QUERIES["op4_sharding"](spark, SF_DIR).collect()
    assert sorted(r.doc_id for r in found) == sorted(texts)
    for r in found:
        raw = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 16, zlib.crc32(raw), "rows", None)
    sizes = Counter(r.shard for r in found)
    assert len(sizes) == 40 and max(sizes.values()) - min(sizes.values()) <= 1


def test_quality_base_figures(spark):
    long = " ".join(f"w{i}" for i in range(30))
    rows = [(1, None, "h"), (2, "", None), (3, " \n\t", "h"), (4, long, "h"), (5, f"{long} {long}", "h"),
            (6, "x " * 50, "h"), (7, "a\nb\na\n \n \n#a$\n", "h"), (8, "é😀 ß\x0bq", None), (4, long, "h")]
    found = quality_rules(docs(spark, rows)).collect()
    assert len(found) == len(rows)
    for r in found:
        text = next(t for d, t, _ in rows if d == r.doc_id) or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
        often = Counter(windows)
        covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(8)}
        wanted = (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
                  len(lines) - len(set(lines)), len(covered))
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == wanted
        assert r.base_failed == (wanted[0] < 20 or 100 * wanted[4] > 30 * wanted[0])
        assert r.kept == (not r.base_failed)
    assert quality_rules(docs(spark, rows).limit(0)).count() == 0


def test_boilerplate_lines_deplete_documents(spark):
    line = " ".join(f"p{i}" for i in range(30))
    own = lambda i, n: " ".join(f"u{i}x{k}" for k in range(n))
    rows = [(i, f"{line.upper()}  \n{own(i, 25)}", "h") for i in range(30)]  # loses 30 of 55 words
    rows += [(100 + i, f"{line}\n{own(i, 40)}", "h") for i in range(30)]  # loses 30 of 70
    rows += [(200 + i, f"{line}\n{own(i, 22)}", f"h{i}") for i in range(5)]  # other hosts
    rows += [(300 + i, own(0, 60), "g") for i in range(50)]  # copies are one document
    table = docs(spark, rows)
    limits = Limits(min_documents=20, min_share=0.1)
    kept = {r.doc_id for r in quality_rules(table, limits).filter("kept").collect()}
    assert kept == {d for d, _, _ in rows if d >= 100}
    stay = keep_good(table, limits)
    assert stay.columns == table.columns and {r.doc_id for r in stay.collect()} == kept


def test_boilerplate_lines_leave_the_text(spark):
    rows = [(i, f"own {i}\n Share  THIS \n\nend {i}" if i < 25 else f"own {i}", "h") for i in range(300)]  # 8% of the host
    rows += [(400 + i, f"share this\nown {i}", "g") for i in range(5)] + [(3, rows[3][1], "h"), (500, None, None)]
    table = docs(spark, rows)
    out = without_boilerplate(table)
    assert out.columns == table.columns
    wanted = [(d, f"own {d}\n\nend {d}" if d is not None and d < 25 else t) for d, t, _ in rows]
    assert sorted(map(repr, ((r.doc_id, r.text) for r in out.collect()))) == sorted(map(repr, wanted))


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="menu">
<header>Top</header><nav><ul><li>Home</ul></nav><div class="cookie-notice">Ok?</div>
<article><header><h1>Head &amp; line</h1></header><p>One <b>bold</b>
 text&nbsp;x<p>Two<br>lines &lt;p&gt;<div class='ad'>Buy<p>now</div><script>"</p>"</script><!-- <p>no</p> -->
<p>x < y</p><form>Name</form><section class=comments><p>Nice!</p></section><p>End</article>
<aside>More</aside><footer>&copy; me</footer>"""


def test_article_blocks():
    assert blocks_of(PAGE) == (["Head & line", "One bold text x", "Two lines <p>", "x < y", "End"], [])
    assert blocks_of("") == blocks_of("<p></p>") == ([], [])
    assert blocks_of("plain") == ([], ["plain"]) and blocks_of("<p>a<p>b")[1] == ["a", "b"]


def test_host_boilerplate_on_pages_without_an_article(spark):
    shared = " ".join(f"s{i}" for i in range(RUN + 4))
    rows = [(i, "http://A.example/x", f"<div>{shared}</div><p>own{i} text of page {i}</p>") for i in range(3)]
    rows += [(9, "https://b.example", f"<div>{shared}</div><p>only here</p>"), (10, None, None), (11, "odd", ""),
             (12, "http://a.example", PAGE), (12, "http://a.example", PAGE)]
    rows += [(20 + i, "http://c.example", "<p>" + " ".join(f"c{k}" for k in range(20)) + "</p>") for i in range(2)]
    pages = spark.createDataFrame([(*r, "t", 1) for r in rows], "page_id long, url string, html string, text string, rest int")
    found = main_text(pages).collect()
    assert len(found) == len(rows)
    texts = {r.page_id: r.text for r in found}
    assert all(r.n_chars == len(r.text) for r in found)
    assert [texts[i] for i in range(3)] == [f"own{i} text of page {i}" for i in range(3)]
    assert texts[9] == f"{shared}\n\nonly here" and texts[10] == texts[11] == ""
    assert texts[12] == "\n\n".join(blocks_of(PAGE)[0])
    assert texts[20] == texts[21] != ""  # a copy of a page does not make it boilerplate
    assert main_text(pages.limit(0)).count() == 0


def test_boilerplate_is_a_share_of_all_pages_of_a_host(spark):
    foot = " ".join(f"f{i}" for i in range(RUN + 4))
    quote = " ".join(f"q{i}" for i in range(RUN + 2))
    own = lambda i: f"own{i} text of page {i}"
    rows = [(i, "http://a.example", f"<div>{foot}</div><p>{own(i)}{' ' + quote if i < 2 else ''}</p>") for i in range(60)]
    marked = lambda i: f"<nav>{foot}</nav><article><p>{own(i)}</p><p>{foot}</p></article>"
    rows += [(100 + i, "http://b.example", marked(i)) for i in range(3)]
    rows += [(110, "http://b.example", f"<div>{foot}</div><p>{own(110)}</p>")]
    rows += [(120, "http://c.example", f"<p class='share-price ad-hoc'>{own(120)}</p><div class='x site-footer'>no</div>")]
    found = {r.page_id: r.text for r in main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert found[0] == f"{own(0)} {quote}" and found[1] == f"{own(1)} {quote}"  # a quotation stays
    assert all(found[i] == own(i) for i in range(2, 60))
    assert found[100] == f"{own(0)}\n\n{foot}"  # a marked article is whole
    assert found[110] == own(110) and found[120] == own(120)


def test_page_query(spark):
    import html

    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()
    found = {r.page_id: r for r in QUERIES["op10_html_extraction"](spark, SF_DIR).collect()}
    assert len(found) == len(pages)
    for p in pages:
        article = re.search(r"<article>(.*?)</article>", p.html, re.S)[1]
        pieces = (re.sub(r"<[^>]*>", " ", x) for x in re.split(r"</?(?:p|h1)>", article))
        blocks = [" ".join(html.unescape(x).split()) for x in pieces]
        assert found[p.page_id].text == "\n\n".join(b for b in blocks if b)
