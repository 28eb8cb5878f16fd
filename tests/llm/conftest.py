from __future__ import annotations

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng: random.Random, n: int, vocabulary: int = 400) -> str:
    return " ".join(f"w{rng.randrange(vocabulary)}" + ("é" if rng.random() < 0.1 else "") for _ in range(n))


def changed(rng: random.Random, text: str, share: float) -> str:
    return " ".join(f"x{rng.randrange(9999)}" if rng.random() < share else w for w in text.split(" "))


def corpus() -> list[tuple]:
    """Documents with nulls in every column, empty, odd and long texts, ties, repeated rows,
    exact and near copies, shared passages and lines."""
    rng = random.Random(5)
    base, passage, long_text = prose(rng, 120), prose(rng, 130), prose(rng, 9000, 3000)
    lines = [f"Shared line number {i} of all sites" for i in range(3)]
    texts = [
        None, "", " \n\t ", "one", "one two three", "one two three", "a" * 900, "ab" * 700, long_text,
        "\n".join(["same line here", "same line here", "", prose(rng, 60)]), "# " * 80, base, base, base.upper(),
        passage, f"{prose(rng, 40)} {passage} {prose(rng, 30)}", "Released under the MIT License.",
        f"{prose(rng, 70)}\nLicensed under the Apache License, Version 2.0.\n{prose(rng, 30)}",
        "日本 語 的 文 章", "x\x00y z w", " ".join(["again and again"] * 30),
    ]
    texts += [changed(rng, base, 0.01) for _ in range(12)]
    texts += [changed(rng, base, 0.03) for _ in range(12)]
    texts += [f"{prose(rng, 60)}\n{lines[i % 3]}\n  {lines[(i + 1) % 3]}\t\n{prose(rng, 20)}" for i in range(40)]
    rows = [(i, t, "en" if i % 3 else None, f"src{i % 13}" if i % 17 else None, len(t or "")) for i, t in enumerate(texts)]
    rows += [rows[11], rows[40], rows[40], (None, texts[11], "en", "src1", None), (None, prose(rng, 80), None, None, None)]
    return rows


@pytest.fixture(scope="session")
def rows() -> list[tuple]:
    return corpus()


@pytest.fixture(scope="session")
def docs(spark, rows):
    """The corpus, and columns whose names clash with what operators add."""
    from pyspark.sql import functions as F

    plain = spark.createDataFrame(rows, SCHEMA).repartition(3)
    clashing = ["n_words", "kept", "hash", "id", "_words", "version", "component_id", "n_removed", "_gone", "c0", "a.b"]
    return plain.withColumns({c: F.lit(f"own {c}") for c in clashing})


@pytest.fixture(scope="session")
def empty(docs):
    return docs.limit(0)
