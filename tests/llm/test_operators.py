"""Each operator against its plain definition, on a corpus of odd cases and on none."""

from __future__ import annotations

import collections
import math

import pytest
from pyspark.sql import functions as F

from maskwright.llm import (
    arrays,
    components,
    decontaminate,
    html_text,
    jaccard_join,
    language_model,
    license_scan,
    line_dedup,
    mixing,
    quality_rules,
    suffix_dedup,
    token_counts,
)
from tests.llm import plain


def pairs(rows):
    return [(r[0], r[1]) for r in rows]


def ordered(found):
    return sorted((tuple(r) for r in found), key=repr)


BENCHMARK = [(1, None), (2, ""), (3, "one two three"), (None, "again and again " * 6), (10, "日本 語 的"), (10, "w1 nothing like this")]


@pytest.fixture(scope="module")
def benchmark_rows(rows):
    words = rows[14][1].split(" ")
    return [*BENCHMARK, (4, " ".join(words[5:45])), (5, " ".join(words[20:33]).upper() + "!"), (6, " ".join(words[60:90]))]


@pytest.fixture(scope="module")
def benchmark(spark, benchmark_rows):
    return spark.createDataFrame(benchmark_rows, "item_id long, text string")


def test_quality_of_long_texts(spark):
    """Windows that all repeat, that repeat apart and that do not, over many words."""
    texts = ["again and again " * 30_000, " ".join(f"w{i * i % 9973}" for i in range(60_000)), "x\n" * 50_000,
             " ".join(f"w{i}" for i in range(40_000)) + " w5 w6 w7", "w " * 3, "a b c a b c", "a b a b"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in quality_rules.ledger(df).collect():
        want = plain.quality(texts[r["doc_id"]])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == want


def test_license_scan(docs, rows, empty):
    found = license_scan.scanned(docs).select("doc_id", "text", "licenses", "n_licenses").collect()
    assert len(found) == len(rows) and sum(r["n_licenses"] for r in found) >= 2
    for r in found:
        want = plain.licenses(r["text"], license_scan.TEMPLATES)
        assert (r["licenses"], r["n_licenses"]) == (",".join(want), len(want))
    assert license_scan.scanned(empty).collect() == []
    assert license_scan.collision_probability(4 / 15) > 0.99


def test_license_scan_finds_whole_and_worn_notices(spark):
    body = dict(license_scan.TEMPLATES[2:3])["MIT"]
    worn = body.replace("sublicense", "relicense").replace("persons", "people")
    texts = ["before " * 11 + body + " after" * 9, worn.upper().replace(" ", "\n"), body[: len(body) // 2]]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = [r["licenses"] for r in license_scan.scanned(df).orderBy("doc_id").collect()]
    assert got == ["MIT", "MIT", ""]


def test_token_counts(spark, docs, rows, empty):
    public = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    path = public.path("byte_bpe_50k.json")
    theirs = Tokenizer.from_file(path)
    texts = [r[1] or "" for r in rows] + ["<|endoftext|>a<|endoftext|>", "don't  \n\n x\x1c\x85y", "aaaa" * 500, "\U00011f00Ɤ᠎"]
    own = token_counts.Vocabulary(path)
    assert own.counts(texts) == [len(e.ids) for e in theirs.encode_batch(texts, add_special_tokens=False)]
    found = token_counts.with_counts(docs, path).collect()
    want = collections.Counter(len(theirs.encode(r[1] or "", add_special_tokens=False).ids) for r in rows)
    assert collections.Counter(r["n_tokens"] for r in found) == want
    assert all(r["n_bytes"] == len((r["text"] or "").encode()) and r["over_limit"] == (r["n_tokens"] > 512) for r in found)
    assert token_counts.with_counts(empty, path).collect() == []


def test_mixing(docs, rows, empty):
    found = mixing.plan(docs).join(docs.select("doc_id", "source", "text").distinct(), "doc_id").collect()
    sizes = collections.Counter()
    for r in rows:
        sizes[r[3]] += len(plain.WORD.findall(r[1] or ""))
    targets = plain.mixing_targets(dict(sizes))
    assert math.isclose(sum(targets.values()), 1.5 * sum(sizes.values()))
    for r in found:
        assert math.isclose(r["target"], targets[r["source"]], rel_tol=1e-9) and r["source_size"] == sizes[r["source"]]
        assert r["taken"] in (r["size"] * math.floor(r["target"] / r["source_size"]), r["size"] * math.ceil(r["target"] / r["source_size"]))
    assert ordered(mixing.plan(docs).collect()) == ordered(mixing.plan(docs.repartition(5)).collect())
    mixed = mixing.mixed(docs)
    assert mixed.columns == [*docs.columns, "copy"]
    taken = mixing.plan(docs).agg(F.sum("copies")).first()[0]
    assert mixed.count() == taken
    assert mixing.plan(empty).collect() == [] and mixing.mixed(empty).collect() == []


def test_mixing_comes_near_its_targets(spark):
    df = spark.range(40_000).select(
        F.col("id").alias("doc_id"), F.repeat(F.lit("w "), (F.col("id") % 9 + 1).cast("int")).alias("text"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), (F.col("id") % 7).cast("string"))).alias("source"),
    )
    by = mixing.plan(df).join(df.select("doc_id", "source"), "doc_id").groupBy("source", "target").agg(F.sum("taken").alias("taken")).collect()
    assert len(by) == 8 and all(abs(r["taken"] - r["target"]) < 0.03 * r["target"] for r in by)


@pytest.mark.parametrize("block_bytes", [1 << 20, 150])
def test_decontamination(docs, rows, empty, benchmark, benchmark_rows, block_bytes):
    found = decontaminate.matched(docs, benchmark, carry=["doc_id", "text"], block_bytes=block_bytes).collect()
    got = [(r["text"], r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for r in found]
    want = [(r[1], *w) for r, w in zip(rows, plain.contamination([r[1] for r in rows], benchmark_rows))]
    assert ordered(got) == ordered(want)
    assert sum(r["contaminated"] for r in found) >= 4
    assert decontaminate.matched(empty, benchmark).collect() == []
    nothing = decontaminate.matched(docs, benchmark.limit(0)).collect()
    assert len(nothing) == len(rows) and not any(r["n_hit"] for r in nothing)
    kept = decontaminate.decontaminated(docs, benchmark)
    assert kept.columns == docs.columns and kept.count() == sum(not w[-1] for w in want)


def test_jaccard_join(docs, rows, empty):
    found = jaccard_join.near_duplicates(docs).collect()
    assert ordered(found) == ordered(plain.near_duplicates(pairs(rows)))
    assert jaccard_join.near_duplicates(empty).collect() == []


def test_jaccard_join_in_small_blocks(spark, docs, rows, monkeypatch):
    """Every bound at its lowest: other joins, more parts, the same components."""
    for name, value in {"GROUP": 2, "BLOCK": 3, "BROADCAST_ROWS": 0, "LEAST_LEVEL": 2, "FREQUENT": 40}.items():
        monkeypatch.setattr(jaccard_join, name, value)
    assert ordered(jaccard_join.near_duplicates(docs).collect()) == ordered(plain.near_duplicates(pairs(rows)))


def test_deduplicated_keeps_one_of_each_component(docs, rows):
    kept = jaccard_join.deduplicated(docs)
    assert kept.columns == docs.columns
    want = plain.near_duplicates(pairs(rows))
    staying = {key for key, _, component in want if key is not None and key == component}
    got = collections.Counter(r["doc_id"] for r in kept.select("doc_id").collect())
    assert {k for k in got if k is not None} == staying and all(n == 1 for k, n in got.items() if k is not None)
    assert got[None] == sum(r[0] is None for r in rows)


def test_components(spark):
    chain = [(i, i + 1) for i in range(30)] + [(100, 99), (98, 100), (7, 7)]
    links = spark.createDataFrame(chain, "a long, b long")
    roots = dict(map(tuple, components.components(links).collect()))
    assert roots == {**dict.fromkeys(range(31), 0), **dict.fromkeys((98, 99, 100), 98)}


PAGES = [
    (1, "http://h/a/1", "<div>Site name</div><div>One</div><p>Text &amp; more<br>of <b>a</b>ll</p><div>Legal</div>"),
    (2, "http://h/a/2", "<div>Site name</div><div>Two</div><p>Other <i>te</i>xt</p><div>Legal</div>"),
    (3, "http://h/z", "<nav>Menu</nav><article><h1>T</h1><p>Site name<p>x &lt; y</article><div>Legal</div>"),
    (4, "http://g/1", None), (5, None, ""), (6, "http://k/1", "<p>alone"), (6, "http://k/1", "<p>alone"),
    (7, "http://m/1", "<body><script>var t='</p>'</script><div class='ad'>buy<p>now</div><form>f</form><p>kept &copy; <!-- no --> here"),
    (8, "http://m/2", "<aside>s</aside><section id=comments><p>c</section><article class=x>a<footer>f</footer> b"), (None, "::bad", "<p>5 < 6 <"),
]


def test_html_extraction(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumn("text", F.lit("own")).repartition(2)
    got = ordered((r["page_id"], r["text"], r["n_chars"]) for r in html_text.main_text(pages).collect())
    want = {1: "One Text & more of all", 2: "Two Other text", 3: "T Site name x < y", 4: "", 5: "", 6: "alone", 7: "kept © here", 8: "a b", None: "5 < 6 <"}
    assert got == ordered((p, want[p], len(want[p])) for p, _, _ in PAGES)
    assert html_text.main_text(pages.limit(0)).collect() == []


def test_html_extraction_on_the_given_pages():
    import html
    import os
    import re

    import pyarrow.parquet as pq

    path = "/root/testdata/sf0.001/pages.parquet"
    if not os.path.exists(path):
        pytest.skip("test tables are not there")
    for page in pq.read_table(path).column("html").to_pylist():
        marked, inside, outside = html_text.lines(page)
        article = re.search(r"<article>(.*?)</article>", page, re.S)[1]
        spaced = re.sub(r"</?(?:p|h1|br)>", " ", re.sub(r"</?b>", "", article))
        assert marked and not outside and " ".join(inside) == " ".join(html.unescape(spaced).split())


def test_longest_common_lines():
    assert [list("abcbdab")[i] for i in html_text.common_lines(list("abcbdab"), list("bdcaba"))] in (list("bcba"), list("bdab"), list("bcab"))
    assert html_text.common_lines([], ["a"]) == [] and html_text.common_lines(["a", "a"], ["a"]) in ([0], [1])


@pytest.mark.parametrize("rows_broadcast", [line_dedup.BROADCAST_ROWS, 0])
def test_line_dedup(docs, rows, empty, monkeypatch, rows_broadcast):
    monkeypatch.setattr(line_dedup, "BROADCAST_ROWS", rows_broadcast)
    found = line_dedup.without_boilerplate(docs, min_sites=10)
    want = plain.line_dedup([(r[0], r[3], r[1]) for r in rows], 10, line_dedup.MIN_CHARS)
    assert ordered(found.select("doc_id", "text").collect()) == ordered((r[0], t) for r, t in zip(rows, want))
    assert found.where("n_removed > 0").count() >= 30
    assert line_dedup.without_boilerplate(empty).collect() == []
    cleaned = line_dedup.cleaned(docs)
    assert cleaned.columns == docs.columns and cleaned.where("n_removed <> 'own n_removed'").count() == 0
    assert cleaned.where("length(text) <> n_chars").count() == 0


@pytest.mark.parametrize("rows_broadcast", [suffix_dedup.BROADCAST_ROWS, 0])
def test_suffix_dedup(docs, rows, empty, monkeypatch, rows_broadcast):
    monkeypatch.setattr(suffix_dedup, "BROADCAST_ROWS", rows_broadcast)
    monkeypatch.setattr(suffix_dedup, "SORT_BYTES", 5000)
    found = suffix_dedup.removed(docs).collect()
    want = plain.repeats(pairs(rows))
    assert ordered(r[:5] for r in found) == ordered(want) and sum(w[2] for w in want) > 10_000
    assert suffix_dedup.removed(empty).collect() == []


def test_quality_rules(docs, rows, empty):
    found = quality_rules.ledger(docs)
    columns = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    got = ordered((r["text"], *[r[c] for c in columns]) for r in found.collect())
    assert got == ordered((r[1], *plain.quality(r[1])) for r in rows)
    assert found.where("base_failed and kept").count() == 0 and found.where("kept").count() > 10
    assert quality_rules.ledger(empty).collect() == []
    passing = quality_rules.passing(docs)
    assert passing.columns == docs.columns and passing.where("n_words <> 'own n_words'").count() == 0
    assert passing.count() == found.where("kept").count()


def test_quality_policies_and_ablations_come_from_the_stored_bits(docs):
    stored = quality_rules.ledger(docs).select("fail_bits", "kept")
    rows = stored.collect()
    for policy in quality_rules.POLICIES:
        mask = quality_rules.policy_bits(policy)
        for r in quality_rules.ablations(stored, policy).collect():
            bit = quality_rules.bit(r["rule"])
            assert r["n_failed"] == sum(bool(x["fail_bits"] & bit) for x in rows)
            assert r["n_failed_alone"] == sum(x["fail_bits"] & mask == bit for x in rows)
            assert r["n_kept"] == sum(not x["fail_bits"] & mask for x in rows)


def test_language_model(docs, rows, empty):
    found = language_model.scored(docs).collect()
    names = ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
    rounded = lambda r: (*r[:5], *(round(x, 6) for x in r[5:]))
    got = ordered(rounded([r[c] for c in names]) for r in found)
    assert got == ordered(rounded(r) for r in plain.language_model(pairs(rows), language_model.discounts))
    assert language_model.scored(empty).collect() == []


def test_language_model_counted_in_many_steps_and_parts(docs, rows, monkeypatch):
    """Results do not depend on how much a task holds, nor on the number of parts and shards."""
    for name, value in (("COUNTED", 300), ("LOOKED_UP", 64), ("PART_TOKENS", 1500), ("SHARD_WORDS", 100)):
        monkeypatch.setattr(language_model, name, value)
    made: list[language_model.Model] = []
    build = language_model.Model
    monkeypatch.setattr(language_model, "Model", lambda *a, **k: made.append(build(*a, **k)) or made[-1])
    got = sorted(round(r["score"], 6) for r in language_model.scored(docs).collect())
    assert got == sorted(round(r[6], 6) for r in plain.language_model(pairs(rows), language_model.discounts))
    assert made[0].parts >= made[0].n / 1500 and 1 << made[0].bits >= made[0].v / 100


def test_language_model_counts_pairs_in_bounded_memory(tmp_path):
    """A task's pairs used to be held as some twenty arrays of up to 2^22 numbers."""
    import random
    import tracemalloc

    import numpy as np
    import pyarrow as pa

    draw = random.Random(3)
    texts = [" ".join(draw.choices([f"w{i}" for i in range(3000)], k=100_000)) for _ in range(30)]
    batches = [pa.RecordBatch.from_arrays([pa.array(texts[i : i + 10])], names=["text"]) for i in range(0, 30, 10)]
    words = pa.Table.from_batches(language_model._word_counts(iter(batches))).group_by("word").aggregate([("n", "sum")])
    columns = [pa.array(np.zeros(len(words) + 1, dtype=np.int64))]
    columns += [pa.array([*words["word"].to_pylist(), int(language_model._START.view(np.int64))]), pa.array([*words["n_sum"].to_pylist(), 0])]
    path = str(tmp_path / "model")
    list(language_model._store_words(path)([pa.RecordBatch.from_arrays(columns, names=["shard", "word", "n"])]))
    model = language_model.Model(path, 0, 8, first=np.array([0, len(words) + 1]), n=3_000_030, v=len(words))
    tracemalloc.start()
    try:
        found = list(language_model._pair_counts(model)(iter(batches)))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    counts = [np.frombuffer(pa.decompress(r["n"], 8 * r["size"], codec="zstd"), dtype="<u8") for b in found for r in b.to_pylist()]
    assert sum(int(c.sum()) for c in counts) == 3_000_030 == sum(words["n_sum"].to_pylist())
    assert peak < 120e6, peak


def test_language_model_without_training_texts(spark):
    held = next(k for k in range(100) if plain.held_out(k))
    df = spark.createDataFrame([(held, "a b")], "doc_id long, text string")
    r = language_model.scored(df).first()
    assert r["held_out"] and (r["n_tokens"], r["n_known"], r["train_tokens"]) == (3, 0, 0) and r["score"] == 0.0


def test_words_as_arrays(rows):
    import pyarrow as pa

    texts = [r[1] for r in rows]
    offsets, data = arrays.buffers(pa.array(texts).slice(3, 40))
    hashes, first = arrays.words(offsets, data, arrays.BETWEEN_SPACES)
    flat = [w for t in texts[3:43] for w in plain.words(t)]
    assert len(hashes) == len(flat) == first[-1] and len(set(hashes.tolist())) == len(set(flat))
    assert len({(h, w) for h, w in zip(hashes.tolist(), flat)}) == len(set(flat))


@pytest.mark.parametrize("comment", [
    "<article>C</article>", "<div class='user-comments'>C</div>", "<section class='x reader-comments'>C</section>",
    "<div id=respond>C</div>", "<ol class='comment-thread depth-1'><li>C</ol>", "<div class=post-comments><p>C<p>C</div>",
])
def test_html_extraction_drops_reader_comments(comment):
    page = f"<body><article class='post comments-open'><div class='body has-comments'><p>the text</div>{comment}<p>of it</article>"
    assert html_text.lines(page) == (True, ["the text", "of it"], [])
    assert html_text.lines(f"<main><p>the text</p>{comment.replace('article', 'div class=comments')}</main>")[1] == ["the text"]


def test_common_lines_of_many_repeated_ones():
    import random
    import time

    rng, started = random.Random(4), time.time()
    for size, kinds in ((20_000, 1), (20_000, 3), (8_000, 4_000)):
        a, b = ([rng.randrange(kinds) for _ in range(size + d)] for d in (0, 77))
        found = html_text.common_lines(a, b)
        assert found == sorted(set(found)) and len(found) == html_text._lengths(a, b)[-1] >= size // 2 * (kinds < 4)
    assert time.time() - started < 120
    for _ in range(300):
        a, b = ([rng.randrange(4) for _ in range(rng.randrange(12))] for _ in range(2))
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
        found, rest = html_text.common_lines(a, b), iter(b)
        assert len(found) == best[-1][-1] and all(a[i] in rest for i in found)


def test_html_extraction_pairs_nearest_urls_on_a_large_host(spark):
    """A section's frame goes at every size of the host, and also behind a run of copies."""
    page = lambda k, s: f"<div>Site</div><div>Section {s}</div><p>text {k}<p>more {k}<p>end {k}"
    rows = [(k, f"http://h/s{k // 3:04d}/{k % 3}", page(k, k // 3)) for k in range(1500)]
    rows += [(k, f"http://c/a/{k:03d}", page("same", "c")) for k in range(2000, 2040)] + [(3000, "http://c/a/999", page("other", "c"))]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    got = {r["page_id"]: r["text"] for r in html_text.main_text(pages).collect()}
    want = lambda k: f"text {k} more {k} end {k}"
    assert got == {**{k: want(k) for k in range(1500)}, **{k: want("same") for k in range(2000, 2040)}, 3000: want("other")}


def test_html_extraction_keeps_the_text_of_near_copies(spark):
    """Copies with another date or one line more lose the frame, not the article they share."""
    article = "".join(f"<p>line {i} of the article" for i in range(8))
    page = lambda top, text: f"<div>Site</div><div>{top}</div>{text}<div>Legal</div>"
    rows = [
        (1, "http://h/a/1", page("Monday", article)), (2, "http://h/a/2", page("Tuesday", article)),
        (3, "http://h/a/3", page("Tuesday", article + "<p>one line more")), (4, "http://h/z", page("Friday", "<p>something else<p>and more")),
        (5, "http://k/1", page("Monday", article)), (6, "http://k/2", page("Tuesday", article)),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in html_text.main_text(pages).collect()}
    text = " ".join(f"line {i} of the article" for i in range(8))
    assert got == {
        1: f"Monday {text}", 2: f"Tuesday {text}", 3: f"Tuesday {text} one line more", 4: "Friday something else and more",
        5: f"Site Monday {text} Legal", 6: f"Site Tuesday {text} Legal",
    }


def test_html_extraction_differences_marked_pages_too(spark):
    """Every page meets its nearest differing URL, menus and articles included; what an article
    shares with another one stays."""
    page = lambda k, text: f"<nav><ul><li>Home<li>Only {k}</ul></nav><article>{text}</article><div>Site</div><footer>Legal</footer>"
    same = "".join(f"<p>line {i} of the copies" for i in range(5))
    rows = [
        (1, "http://h/a/1", page(1, "<h1>One</h1><p>first text of the page<p>MIT License")), (2, "http://h/a/2", page(2, "<h1>Two</h1><p>another text here<p>MIT License")),
        (3, "http://h/b/1", page(3, same)), (4, "http://h/b/2", page(4, same)), (5, "http://g/1", page(5, same)),
        (6, "http://k/1", page(6, "<p>marked text of both<p>and more of it")), (7, "http://k/2", "<p>Home<p>marked text of both<p>its own<p>and this as well<p>Site"),
    ]
    found = html_text.main_text(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)).collect()
    text = " ".join(f"line {i} of the copies" for i in range(5))
    assert {r["page_id"]: (r["text"], r["n_shared"]) for r in found} == {
        1: ("One first text of the page MIT License", 4), 2: ("Two another text here MIT License", 4),
        3: (text, 3), 4: (text, 3), 5: (text, 0),
        6: ("marked text of both and more of it", 3), 7: ("marked text of both its own and this as well", 3),
    }


def test_noise_left_open_inside_a_line_ends_with_its_parent():
    assert html_text.lines("<p>a <b>c <i hidden>x</b> d") == (False, [], ["a c", "d"])


@pytest.mark.parametrize("wrapped", [
    '<div class="layout has-sidebar">{}</div>', '<div id="search-results">{}</div>', '<div class="sidebar"><i>top</i>{}</div>',
    '<div class="menu"><section id="widget">{}</section></div>', '{}<div id="comments"><article class="comment">so true</article></div>',
    '<div class="site-footer ad-slot">f</div>{}<ul class="ad_300x250 x">buy</ul><p id="comments-section">c',
])
@pytest.mark.parametrize("opening", ["<article>", '<article class="post comments-open">', '<article class="widget">', '<main id="search">'])
def test_class_and_id_words_never_hide_an_article(wrapped, opening):
    page = wrapped.format(opening + "<p>the text<p class=ad>buy</p><div class='entry-header'>of it</div>" + ("</main>" if "main" in opening else "</article>"))
    assert html_text.lines(f"<body><nav>n</nav>{page}") == (True, ["the text", "of it"], ["top"] if "<i>" in page else [])


def test_a_teaser_in_a_sidebar_is_not_the_article():
    page = "<div class=sidebar><article>teaser</article></div><div>the long text of the page</div><form><article>f</article></form>"
    assert html_text.lines(page) == (False, [], ["teaser", "the long text of the page"])


@pytest.mark.parametrize("rows_broadcast", [suffix_dedup.BROADCAST_ROWS, 0])
def test_suffix_dedup_sorts_no_common_passage_in_one_task(spark, monkeypatch, rows_broadcast):
    """A passage in many surroundings: no sort gets more than its bound, results are the same."""
    import random

    draw = random.Random(5)
    letters = lambda n: "".join(draw.choices("abcdéfgh日 ", k=n))
    passage, before, after = letters(300), letters(120), letters(160)
    rows = [(k, letters(200 + k) + passage + letters(300)) for k in range(60)]
    rows += [(100 + k, letters(150) + before + passage + letters(200)) for k in range(9)]
    rows += [(200 + k, letters(90) + passage + after + letters(200 - k)) for k in range(9)]
    rows += [(300, rows[0][1]), (None, rows[1][1][:520]), (None, rows[1][1][:520]), (301, passage * 4), (302, None)]
    sort, bound = suffix_dedup.suffix_classes, 5000

    def sorted_within_bounds(data, left, depth):
        assert len(data) <= 2 * bound
        return sort(data, left, depth)

    monkeypatch.setattr(suffix_dedup, "SORT_BYTES", bound)
    monkeypatch.setattr(suffix_dedup, "BROADCAST_ROWS", rows_broadcast)
    monkeypatch.setattr(suffix_dedup, "suffix_classes", sorted_within_bounds)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got, want = [tuple(r[:5]) for r in suffix_dedup.removed(docs).collect()], plain.repeats(rows)
    assert ordered(got) == ordered(want) and sum(w[2] > 0 for w in want) >= 20


def test_html_extraction_needs_few_rounds_on_pages_without_text(spark, monkeypatch):
    """No page differs from one without text, which once tried all pages of its host one by one."""
    page = lambda k: f"<div>Site</div><p>text {k}<p>more {k}<p>end {k}"
    rows = [(k, f"http://h/{k:03d}", page(k)) for k in range(30)]
    rows += [(100, "http://h/900", None), (101, "http://h/901", ""), (102, "http://h/902", "<nav><p>Site</nav>")]
    rounds, write = [], html_text.written

    def written(df, what, **options):
        rounds.extend([what] * (what == "tried"))
        return write(df, what, **options)

    monkeypatch.setattr(html_text, "written", written)
    found = html_text.main_text(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)).collect()
    want = {k: (f"text {k} more {k} end {k}", 1) for k in range(30)} | {k: ("", 0) for k in (100, 101, 102)}
    assert {r["page_id"]: (r["text"], r["n_shared"]) for r in found} == want
    assert len(rounds) <= 4


def _plain_differs(page, other, common):
    own, its = (html_text.INSIDE if p["marked"] else html_text.OUTSIDE for p in (page, other))
    if sum(page["kinds"][i] == own for i, _ in common) == page["kinds"].count(own):
        return False
    text = [i for i, j in common if page["kinds"][i] == own and other["kinds"][j] == its]
    size = sum(len(page["texts"][i]) for i in text)
    return not any(
        2 * len(text) > p["kinds"].count(kind) and 2 * size > sum(len(x) for x, k in zip(p["texts"], p["kinds"]) if k == kind)
        for p, kind in ((page, own), (other, its))
    )


@pytest.mark.parametrize("lines_at_once", [html_text.TRIED_LINES, 5])
def test_html_extraction_aligns_whole_batches_as_page_by_page(monkeypatch, lines_at_once):
    import random

    import pyarrow as pa

    monkeypatch.setattr(html_text, "TRIED_LINES", lines_at_once)
    draw = random.Random(11)

    def drawn():
        texts = draw.choices(["a", "bb", "ccc", "dé", "eeeee", "f" * 9, "g", "h"][: draw.choice([2, 8])], k=draw.choice([0, 1, 3, 6, 9]))
        marked = draw.random() < 0.4
        kinds = draw.choices(range(3 if marked else 2), k=len(texts))
        return {"host": draw.choice("hhhk"), "path": "/" + "".join(draw.choices("xy", k=3)), "marked": marked, "texts": texts, "kinds": kinds}

    rows = [(drawn(), drawn(), draw.random() < 0.8, draw.random() < 0.8) for _ in range(600)]
    rows += [(x, {**x, "path": "/x"}, True, True) for x, *_ in rows[:40]]
    batch = {"a": list(range(0, 2 * len(rows), 2)), "b": list(range(1, 2 * len(rows), 2)), "up": [r[2] for r in rows], "down": [r[3] for r in rows]}
    for k, side in enumerate("ab"):
        batch |= {f"{side}_{c}": [r[k][c] for r in rows] for c in ("host", "path", "marked")}
        batch[f"{side}_frame"] = [html_text._frames(r[k]["texts"], r[k]["kinds"], [0, len(r[k]["texts"])])[0] for r in rows]
    want = []
    for k, (a, b, up, down) in enumerate(rows):
        for side, page, other, wanted in ((1, a, b, up), (-1, b, a, down)):
            if not wanted or a["host"] != b["host"]:
                continue
            common = html_text.common_places(page["texts"], other["texts"])
            state = int(_plain_differs(page, other, common))
            near = shared = kept = None
            if state:
                near, shared = html_text._shared_prefix(page["path"], other["path"]), len(common)
                if shared and not page["marked"]:
                    kept = [True] * len(page["texts"])
                    for i, j in common:
                        kept[i] = other["kinds"][j] == html_text.INSIDE
            elif not any(kind == (html_text.INSIDE if page["marked"] else html_text.OUTSIDE) for kind in page["kinds"]):
                state = -1
            pos = 2 * k if side > 0 else 2 * k + 1
            want.append((pos, side, pos + side, state, near, shared, kept))
    got = [tuple(r.values()) for x in html_text._tried(iter([pa.RecordBatch.from_pydict(batch)])) for r in x.to_pylist()]
    assert sorted(got, key=lambda r: r[:2]) == sorted(want, key=lambda r: r[:2])
    assert sum(r[3] == 0 for r in want) > 50 and sum(r[6] is not None for r in want) > 50 and sum(r[3] == -1 for r in want) > 20


def test_html_extraction_without_broadcasts(spark, monkeypatch):
    """Pairs still to be tried and what was found are joined by shuffle on larger tables."""
    page = lambda k, s: f"<div>Site</div><div>Section {s}</div><p>text {k}<p>more {k}<p>end {k}"
    rows = [(k, f"http://h/s{k // 3:04d}/{k % 3}", page(k, k // 3)) for k in range(30)]
    rows += [(k, f"http://c/a/{k:03d}", page("same", "c")) for k in range(200, 206)] + [(300, "http://c/a/999", page("other", "c")), (300, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    want = ordered(map(tuple, html_text.main_text(pages).collect()))
    monkeypatch.setattr(html_text, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(html_text, "BROADCAST_PAIRS", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert ordered(map(tuple, html_text.main_text(pages).collect())) == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(r[4] == 2 for r in want) >= 36
