"""Exact copies, clusters and importance draws against their plain definitions."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from maskwright.llm import centroid_clusters, exact_dedup, importance
from tests.llm import plain


def ordered(found):
    return sorted((tuple(r) for r in found), key=repr)


def pairs(rows):
    return [(r[0], r[1]) for r in rows]


# Exact copies

COLUMNS = ("doc_id", "keep_id", "group_size", "n_bytes", "text_sha256")


def owned(df, **options):
    return exact_dedup.owners(df, **options).select(*COLUMNS, "kept").collect()


@pytest.mark.parametrize("keep", ["last", "first"])
def test_owners(docs, rows, empty, keep):
    found = owned(docs, keep=keep)
    assert ordered(r[:5] for r in found) == ordered(plain.exact_owners(pairs(rows), keep))
    stay = [r for r in found if r["kept"]]
    assert len(stay) == len({r["text_sha256"] for r in found})  # one row of each text, repeated rows included
    assert all(r["doc_id"] == r["keep_id"] for r in stay)
    assert owned(empty) == []


def test_deduplicated_keeps_rows_as_they_are(docs, rows, empty):
    found = exact_dedup.deduplicated(docs)
    assert found.columns == docs.columns
    kept = found.collect()
    texts = [(r["text"] or "").translate(plain.LOWER) for r in kept]
    assert len(texts) == len(set(texts)) == len({(r[1] or "").translate(plain.LOWER) for r in rows})
    assert {tuple(r) for r in kept} <= {tuple(r) for r in docs.collect()}
    assert exact_dedup.deduplicated(empty).collect() == []


def test_owners_with_a_coarse_hash(docs, rows, monkeypatch):
    """The tries alone decide: hashes that say nothing, subtrees spilled early, hot partitions."""
    monkeypatch.setattr(exact_dedup, "content_hash", lambda text: F.pmod(F.octet_length(text), F.lit(2)).cast("long"))
    monkeypatch.setattr(exact_dedup, "SPILL_BYTES", 300)
    monkeypatch.setattr(exact_dedup, "HOT_BYTES", 500)
    assert ordered(r[:5] for r in owned(docs)) == ordered(plain.exact_owners(pairs(rows)))


def test_owners_beyond_broadcasts(docs, rows, monkeypatch):
    monkeypatch.setattr(exact_dedup, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(exact_dedup, "HOT_SHARE", 20)
    found = owned(docs)
    assert ordered(r[:5] for r in found) == ordered(plain.exact_owners(pairs(rows)))
    assert sum(r["kept"] for r in found) == len({r["text_sha256"] for r in found})


def test_texts_that_differ_beyond_ascii_letters(spark):
    texts = ["Straße É", "straße É", "straße é", "STRASSE é", "", None, "a\x00b", "A\x00B", "a" * 3_000_000, "A" * 3_000_000]
    rows = [(f"id{i}", t) for i, t in enumerate(texts)]
    found = owned(spark.createDataFrame(rows, "doc_id string, text string"))
    assert ordered(r[:5] for r in found) == ordered(plain.exact_owners(rows))


def test_trie_spills_whole_subtrees():
    rng = random.Random(3)
    keys = [bytes(rng.choices(b"ab", k=rng.randrange(40))) for _ in range(400)]
    trie, out = exact_dedup.Trie(exact_dedup.PREFERENCES["first"]), {}

    def take(found):
        for key, (least, n, same) in found:
            known = out.setdefault(key, [least, 0, 0])
            known[1] += n
            known[0] = min(known[0], least)

    for i, key in enumerate(keys):
        trie.add(key, i, 1, 1)
        while trie.bytes > 200:
            before = trie.bytes
            take(trie.spilled())
            assert 0 <= trie.bytes < before
    take(trie.drained())
    want = {key: [keys.index(key), keys.count(key), 0] for key in keys}
    assert out == want


# Importance draws


@pytest.fixture(scope="module")
def target(spark, rows):
    texts = [None, "", "w1 w2 w3", rows[11][1][:300], "MIT License " * 30]
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "item_id long, text string"), texts


@pytest.mark.parametrize("percent", [5, 100])
def test_resampling(docs, rows, empty, target, percent):
    columns = ("doc_id", *importance.RESULTS)
    found = importance.resampled(docs, target[0], percent=percent).select(*columns).collect()
    want = plain.resampling(pairs(rows), target[1], percent)
    # Rows that repeat each other may take each other's rank.
    assert ordered(r[:5] for r in found) == ordered(r[:5] for r in want)
    assert sorted((r["rank"], r["score"]) for r in found if r["rank"]) == sorted((r[5], r[4]) for r in want if r[5])
    assert importance.resampled(empty, target[0]).collect() == []
    assert {r["weight"] for r in importance.resampled(docs, empty).collect()}


def test_drawn_rows_are_whole(docs, rows, target, empty):
    found = importance.drawn(docs, target[0], percent=30)
    want = [r for r in plain.resampling(pairs(rows), target[1], 30) if r[5]]
    assert found.columns == docs.columns
    assert ordered((r["doc_id"],) for r in found.collect()) == ordered((r[0],) for r in want)
    assert importance.drawn(empty, target[0]).collect() == []


def test_checksums_of_runs():
    texts = ["a bc def", "", "x" * 300 + " é " + "y" * 64, "one", "日本 語 的 文", "A B"]
    joined = b"".join(t.translate(plain.LOWER).encode() + importance.SEPARATOR for t in texts)
    got = sorted((int(d), int(c)) for k in importance.features(joined) for d, c in zip(*k))
    assert got == sorted((i, zlib.crc32(g.encode())) for i, t in enumerate(texts) for g in plain.grams(t)[0])


# Clusters


def vectors(n=400, size=64, seed=2):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 0.3) for _ in range(size)] for _ in range(9)]
    out = [(i, [x + rng.gauss(0, 0.1) for x in rng.choice(centres)]) for i in range(n)]
    odd = [(n, None), (n + 1, []), (n + 2, [0.0] * 63), (n + 3, [float("nan")] + [0.0] * 63), (n + 4, [None] + [0.0] * 63),
           (n + 5, [float("inf")] * 64), (n + 6, [0.0] * 64), (n + 6, [0.0] * 64), (None, [0.0] * 64), (n + 7, [-0.0] * 64)]
    return out + odd + out[:5]


SCHEMA = "vec_id long, embedding array<double>"
RESULT = ("vec_id", *centroid_clusters.RESULTS)


def test_clusters(spark):
    rows = vectors()
    df = spark.createDataFrame(rows, SCHEMA).repartition(3).withColumns({c: F.lit(c) for c in ("label", "point", "c0", "Cluster", "upper")})
    found = centroid_clusters.clustered(df)
    assert found.columns == ["vec_id", "label", "point", "c0", "upper", *centroid_clusters.RESULTS]
    got = found.select(*RESULT).collect()
    assert ordered(got) == ordered(plain.clusters(rows))
    assert found.select("point").distinct().collect() == [("point",)]
    assert centroid_clusters.clustered(df.limit(0)).collect() == []
    few = rows[:5]
    assert ordered(centroid_clusters.clustered(spark.createDataFrame(few, SCHEMA)).select(*RESULT).collect()) == ordered(plain.clusters(few))


def test_clusters_of_large_components_and_many_rounds(spark):
    rows = [(i, [x * 1e7 for x in v[:8]]) for i, v in vectors(60)[:60]]
    df = spark.createDataFrame(rows, SCHEMA)
    found = centroid_clusters.clustered(df, size=8, scale=1, k=5, rounds=6, seed="s").select(*RESULT).collect()
    assert ordered(found) == ordered(plain.clusters(rows, 5, 6, 8, 1, "s"))


def test_loosening_bounds_every_point_and_spares_some():
    rng = np.random.default_rng(1)
    tighter = 0
    for _ in range(300):
        centre, old = rng.normal(size=(2, 6)) * 3
        new = old + rng.normal(size=6) * rng.uniform(0, 2)
        radius = rng.uniform(0, 4)
        out = rng.normal(size=(400, 6))
        out *= radius * rng.uniform(0, 1, size=(400, 1)) ** 0.1 / np.linalg.norm(out, axis=1, keepdims=True)
        nearer = np.linalg.norm(centre + out - old, axis=1) - np.linalg.norm(centre + out - new, axis=1)
        bound, drift = centroid_clusters.loosening(centre, radius, old, new), np.linalg.norm(new - old)
        assert nearer.max() <= bound + 1e-9 and bound <= drift + 1e-9
        tighter += bound < 0.9 * drift
    assert tighter > 100


def test_bounds_spare_scans():
    points = np.array([[np.floor(64 * x) for x in v] for _, v in vectors()[:400]], dtype=np.int64)
    centroids, cluster = points[:9].copy(), np.full(400, -1, dtype=np.int32)
    cluster, upper, lower, n = centroid_clusters.assigned(points, cluster, np.zeros(400), np.zeros(400), centroids, None)
    scanned = [n]
    for _ in range(6):
        radius = [float(upper[cluster == c].max(initial=0)) for c in range(9)]
        new = np.array([points[cluster == c].sum(0) // max(1, (cluster == c).sum()) for c in range(9)])
        moved = centroid_clusters.movement(centroids, new, radius)
        centroids = new
        cluster, upper, lower, n = centroid_clusters.assigned(points, cluster, upper, lower, centroids, moved)
        assert (cluster == centroid_clusters.squared(points, centroids).argmin(1)).all()
        scanned.append(n)
    assert sum(scanned[1:]) < 3 * 400
