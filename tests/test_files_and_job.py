from __future__ import annotations

import csv
import dataclasses
import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from maskwright import MaskingConfig, catalog, run_job
from maskwright.operators import catalog as cat
from maskwright.operators.rulebook import rulebook
from maskwright.plans.job import rulebook_errors, select_project
from maskwright.sources import files as fs
from maskwright.sources.dictionary_store import load_dictionary
from tests.plain import standard


def parquet(path, **columns):
    path.parent.mkdir(parents=True, exist_ok=True)
    pq.write_table(pa.table(columns), path)


@pytest.fixture
def tree(tmp_path):
    """A directory tree with all kinds of layout."""
    root = tmp_path / "in put"
    root.mkdir()
    (root / "customers.csv").write_text(
        'id,name,note\n1,Ana Lopez," two, parts "\n2,"O\'Neil, Bo","line\nbreak"\n3,,""\n', newline=""
    )
    parquet(root / "orders" / "part-0.parquet", o_id=[1, 2], o_name=["Ana", "Bo"])
    parquet(root / "orders" / "part-1.parquet", o_id=[3], o_name=["Cy"], o_extra=["Eve"])
    parquet(root / "my-dir a" / "year=2024" / "x.parquet", v=["abc"], w=[1.5])
    parquet(root / "my-dir a" / "year=007" / "y.parquet", v=["def"], w=[2.5])
    parquet(root / "nested" / "sub" / "z.parquet", v=["inner"])
    parquet(root / "nested" / "top.parquet", v=["outer"], extra=[1])
    (root / "mixed").mkdir()
    (root / "mixed" / "a.csv").write_text("v\nfrom csv\n")
    parquet(root / "mixed" / "b.parquet", v=["from parquet"])
    parquet(root / "spark.parquet" / "part-00000.parquet", v=["by spark"])
    (root / "spark.parquet" / "_SUCCESS").write_text("")
    (root / "_SUCCESS").write_text("")
    (root / ".x.csv.crc").write_text("x")
    (root / "log.json").write_text("{}")
    (root / "odd.name.csv").write_text("q\n1\n")
    return root


def test_inventory(spark, tree):
    rows = {
        (r["rel_dir"], r["file_name"]): (r["table"], r["format"], r["dataset"], r["layout"])
        for r in fs.inventory(spark, str(tree)).collect()
    }
    assert rows == {
        ("", "customers.csv"): ("customers", "csv", "customers.csv", "file"),
        ("", "log.json"): ("log", None, "log.json", "file"),
        ("", "odd.name.csv"): ("odd.name", "csv", "odd.name.csv", "file"),
        ("orders", "part-0.parquet"): ("orders", "parquet", "orders", "flat"),
        ("orders", "part-1.parquet"): ("orders", "parquet", "orders", "flat"),
        ("my-dir a/year=2024", "x.parquet"): ("my-dir a", "parquet", "my-dir a", "partitioned"),
        ("my-dir a/year=007", "y.parquet"): ("my-dir a", "parquet", "my-dir a", "partitioned"),
        ("nested", "top.parquet"): ("nested", "parquet", "nested", "flat"),
        ("nested/sub", "z.parquet"): ("nested", "parquet", "nested/sub", "flat"),
        ("mixed", "a.csv"): ("mixed", "csv", "mixed", "flat"),
        ("mixed", "b.parquet"): ("mixed", "parquet", "mixed", "flat"),
        ("spark.parquet", "part-00000.parquet"): ("spark", "parquet", "spark.parquet", "flat"),
    }
    counts = {r["format"]: r["n_files"] for r in fs.file_counts(fs.inventory(spark, str(tree))).collect()}
    assert counts == {"csv": 3, "parquet": 8}


def test_catalog(spark, tree):
    frame = catalog(spark, str(tree))
    rows = {(r["dataset"], r["format"], r["position"]): (r["table_norm"], r["column"], r["type"]) for r in frame.collect()}
    assert rows[("customers.csv", "csv", 2)] == ("customers", "name", "string")
    assert rows[("orders", "parquet", 3)] == ("orders", "o_extra", "string")
    assert rows[("my-dir a", "parquet", 3)] == ("my_dir_a", "year", "string")
    wide = {r["position"]: r for r in cat.wide(frame).collect()}
    assert wide[1]["my-dir a"] == "v" and wide[2]["orders"] == "o_name" and wide[3]["mixed"] is None
    mismatches = {(r["table"], r["column"], r["n_present"], r["n_datasets"]) for r in cat.schema_mismatches(frame).collect()}
    assert mismatches == {("nested", "extra", 1, 2)}
    rolled = {(r["column"], r["dataset"]) for r in cat.roll_up(frame).where("table = 'nested'").collect()}
    assert rolled == {("v", "nested"), ("extra", "nested")}


def test_wide_loses_no_column(spark):
    """Neither of names that look alike once normalised, nor of several datasets."""
    rows = [("my-dir", "a", 1, "d1"), ("my-dir", "b", 2, "d1"), ("my_dir", "c", 1, "e"), ("my_dir", "d", 2, "e"), ("my-dir", "x", 1, "d2")]
    frame = spark.createDataFrame(
        [(t, t.replace("-", "_"), d, "parquet", c, p, "string") for t, c, p, d in rows],
        "table string, table_norm string, dataset string, format string, column string, position int, type string",
    )
    wide = {r["position"]: (r["my-dir"], r["my_dir"]) for r in cat.wide(frame).collect()}
    assert wide == {1: ("a", "c"), 2: ("b", "d"), 3: ("x", None)}


def test_runs_differ_unless_told_otherwise(spark, tree):
    """Flag N: equal within a run, different between runs and between projects."""
    rules = rulebook(spark, [("orders", "o_name", "Standard", "N")])
    masks = []
    for i, changes in enumerate(({}, {}, {"run_id": "r"}, {"run_id": "r"}, {"run_id": "r", "project": "q"})):
        cfg = dataclasses.replace(config(tree), output=str(tree.parent / f"out{i}"), **changes)
        summary = run_job(spark, cfg, rules).where("status = 'masked'").collect()
        assert len({r["run_id"] for r in summary}) == 1 and summary[0]["run_id"]
        masks.append({r["o_name"] for r in spark.read.parquet(f"{cfg.output}/orders").collect()})
    assert masks[2] == masks[3] and len({frozenset(m) for m in masks}) == 4


def test_many_errors_stop_only_their_table(spark, tree):
    """No error is dropped, however many there are, and they are counted for the plan."""
    bad = [("mixed", f"no_column_{i}", "Nope", "X") for i in range(3000)]
    rules = rulebook(spark, [*bad, ("orders", "o_name", "Standard", "Y"), ("gone", "v", "Nope", "Y")])
    got = by_dataset(run_job(spark, config(tree), rules))
    assert got[("orders", "parquet")] == ("masked", 3, None)
    assert got[("mixed", "csv")][2] == "BAD_REF_INTEGRITY 3000; UNKNOWN_ATTRIBUTE 3000; UNKNOWN_RULE 3000"
    assert rulebook_errors(spark, config(tree), rules).count() == 9002


def test_one_table_under_two_spellings_is_a_duplicate(spark, tree):
    rules = rulebook(spark, [("my-dir a", "v", "Standard", "Y"), ("my dir a", "v", "Standard", "Y")])
    got = by_dataset(run_job(spark, config(tree), rules))
    assert got[("my-dir a", "parquet")] == ("invalid_rules", None, "DUPLICATE_RULE 1")


def test_names_that_clash(spark):
    names = spark.createDataFrame([("a b",), ("a-b",), ("a-b",), ("c",)], "table string")
    got = {r["table_norm"]: (r["n_names"], r["first_name"]) for r in cat.name_clashes(names).collect()}
    assert got == {"a_b": (2, "a b"), "c": (1, "c")}


RULES = [
    ("customers", "name", "Full Name", "Y"),
    ("customers", "note", "Physical Address", "Y"),
    ("orders", "o_name", "Standard", "Y"),
    ("orders", "o_extra", "Standard", "Y"),
    ("my_dir_a", "v", "Standard", "Y"),
    ("nested", "v", "Standard", "Y"),
    ("mixed", "v", "Standard", "Y"),
    ("spark", "v", "Standard", "Y"),
    ("elsewhere", "v", "Standard", "Y"),
]


def config(tree, **more):
    return MaskingConfig(
        project="p", key="test-key", input=str(tree), output=str(tree.parent / "out"), **more
    )


def by_dataset(summary):
    return {(r["dataset"], r["format"]): (r["status"], r["n_rows"], r["message"]) for r in summary.collect()}


def read_csv(directory):
    rows = []
    for name in sorted(os.listdir(directory)):
        if name.endswith(".csv"):
            with open(os.path.join(directory, name), newline="") as f:
                rows += list(csv.reader(f))[1:]
    return rows


@pytest.mark.parametrize("with_dictionary", [False, True])
def test_job(spark, tree, with_dictionary):
    more = {"dictionary": str(tree.parent / "dictionary")} if with_dictionary else {}
    cfg = config(tree, **more)
    got = by_dataset(run_job(spark, cfg, rulebook(spark, RULES)))
    assert got == {
        ("customers.csv", "csv"): ("masked", 3, None),
        ("odd.name.csv", "csv"): ("no_rules", None, None),
        ("orders", "parquet"): ("masked", 3, None),
        ("my-dir a", "parquet"): ("masked", 2, None),
        ("nested", "parquet"): ("masked", 1, None),
        ("nested/sub", "parquet"): ("masked", 1, None),
        ("mixed", "csv"): ("masked", 1, None),
        ("mixed", "parquet"): ("masked", 1, None),
        ("spark.parquet", "parquet"): ("masked", 1, None),
        (None, None): ("invalid_rules", None, "UNKNOWN_TABLE 1"),
    }
    out = tree.parent / "out"
    rows = sorted(read_csv(out / "customers.csv"))
    assert [r[0] for r in rows] == ["1", "2", "3"]
    assert rows[0][1] == f"{standard('Ana')} {standard('Lopez')}"
    assert rows[0][2].count("\n") == 1 and rows[1][2].count("\n") == 1
    assert rows[1][1] == f"{standard('O')}'{standard('Neil')}, {standard('Bo')}"
    assert rows[2][1] == ""
    orders = spark.read.parquet(str(out / "orders")).orderBy("o_id").collect()
    assert [tuple(r) for r in orders] == [
        (1, standard("Ana"), None), (2, standard("Bo"), None), (3, standard("Cy"), standard("Eve"))
    ]
    assert sorted(n for n in os.listdir(out / "my-dir a") if "=" in n) == ["year=007", "year=2024"]
    assert spark.read.parquet(str(out / "my-dir a/year=007")).first()["v"] == standard("def")
    assert spark.read.parquet(str(out / "nested/sub")).first()["v"] == standard("inner")
    assert spark.read.parquet(f"{out}/nested/*.parquet").first()["v"] == standard("outer")
    assert read_csv(out / "mixed/csv-flat") == [[standard("from csv")]]
    assert not (out / "odd.name.csv").exists() and not (out / "log.json").exists()
    # The masked copy names its tables as the original does.
    tables = {r["table"] for r in fs.inventory(spark, str(out)).select("table").distinct().collect()}
    assert tables == {"customers", "orders", "my-dir a", "nested", "mixed", "spark"}
    if with_dictionary:
        entries = {r["original"]: r["masked"] for r in load_dictionary(spark, cfg.dictionary).collect()}
        assert entries["Ana"] == standard("Ana") and entries["inner"] == standard("inner")
        size = len(entries)
        again = config(tree, overwrite=True, **more)
        assert by_dataset(run_job(spark, again, rulebook(spark, RULES))) == got
        assert load_dictionary(spark, cfg.dictionary).count() == size


@pytest.mark.parametrize("with_dictionary", [False, True])
def test_directories_of_one_schema_are_one_job(spark, tmp_path, monkeypatch, with_dictionary):
    """However many there are, and with the same layout; rows are counted for each."""
    import maskwright.plans.job as job

    root = tmp_path / "in put"
    for i in range(40):
        for part in range(1 + i % 2):
            parquet(root / "t" / f"area {i % 4}" / f"d%{i}" / f"{part}.parquet", v=[f"n{i}", "Ana"], __directory=[i, part])
    more = {"dictionary": str(tmp_path / "dictionary")} if with_dictionary else {}
    cfg = MaskingConfig(project="p", key="test-key", input=str(root), output=str(tmp_path / "out"), **more)
    monkeypatch.setattr(job, "write_dataset", None)
    rules = rulebook(spark, [("t", "v", "Standard", "Y")])
    got = by_dataset(run_job(spark, cfg, rules))
    assert got == {(f"t/area {i % 4}/d%{i}", "parquet"): ("masked", 2 * (1 + i % 2), None) for i in range(40)}
    for i in range(40):
        files = sorted((tmp_path / "out" / "t" / f"area {i % 4}" / f"d%{i}").glob("*.parquet"))
        rows = [r for f in files for r in pq.ParquetFile(f).read().to_pylist()]
        want = [{"v": standard(v), "__directory": d} for part in range(1 + i % 2) for v, d in ((f"n{i}", i), ("Ana", part))]
        assert sorted(map(repr, rows)) == sorted(map(repr, want))
    assert sorted(os.listdir(tmp_path / "out")) == ["_manifest", "t"]
    assert {r[0] for r in by_dataset(run_job(spark, cfg, rules)).values()} == {"failed"}  # nothing is overwritten unasked
    assert by_dataset(run_job(spark, dataclasses.replace(cfg, overwrite=True), rules)) == got


def test_a_run_goes_on_where_another_stopped(spark, tmp_path, monkeypatch):
    """What was written and has not changed is passed over; what has changed is replaced."""
    import maskwright.plans.job as job

    for name in "abcd":
        parquet(tmp_path / "in" / name / "x.parquet", v=[f"value {name}"])
    cfg = MaskingConfig(project="p", key="test-key", input=str(tmp_path / "in"), output=str(tmp_path / "out"), resume=True, tables_at_once=1)
    rules = rulebook(spark, [(t, "v", "Standard", "Y") for t in "abcd"])
    real, done = job.write_dataset, []

    def until_killed(df, root, dataset, overwrite):
        if len(done) == 2:
            raise KeyboardInterrupt
        done.append(dataset.path)
        real(df, root, dataset, overwrite)

    monkeypatch.setattr(job, "write_dataset", until_killed)
    with pytest.raises(KeyboardInterrupt):
        run_job(spark, cfg, rules)
    monkeypatch.setattr(job, "write_dataset", real)

    def statuses(config=cfg, rules=rules):
        return {r["table"]: (r["status"], r["n_rows"]) for r in run_job(spark, config, rules).collect()}

    assert statuses() == {"a": ("unchanged", 1), "b": ("unchanged", 1), "c": ("masked", 1), "d": ("masked", 1)}
    parquet(tmp_path / "in" / "b" / "x.parquet", v=["another value", "and one"])
    assert statuses() == {"a": ("unchanged", 1), "b": ("masked", 2), "c": ("unchanged", 1), "d": ("unchanged", 1)}
    rows = spark.read.parquet(f"{tmp_path}/out/b").collect()
    assert sorted(r["v"] for r in rows) == sorted([standard("another value"), standard("and one")])
    other = rulebook(spark, [(t, "v", "Full Name" if t == "d" else "Standard", "Y") for t in "abcd"])
    assert {t for t, s in statuses(rules=other).items() if s[0] == "masked"} == {"d"}
    assert {s[0] for s in statuses(dataclasses.replace(cfg, key="new"), other).values()} == {"masked"}
    assert {s[0] for s in statuses(dataclasses.replace(cfg, key="new", resume=False), other).values()} == {"failed"}


def test_directories_inside_others_stay_apart(spark, tree):
    parquet(tree / "nested" / "sub" / "deep" / "a.parquet", v=["deep"])
    parquet(tree / "nested" / "leaf1" / "a.parquet", v=["one"])
    parquet(tree / "nested" / "leaf2" / "a.parquet", v=["two"])
    got = by_dataset(run_job(spark, config(tree, overwrite=True), rulebook(spark, [("nested", "v", "Standard", "Y")])))
    assert {k: r[:2] for k, r in got.items() if r[0] == "masked"} == {
        (f"nested{d}", "parquet"): ("masked", 1) for d in ("", "/sub", "/sub/deep", "/leaf1", "/leaf2")}
    for d, v in (("sub", "inner"), ("sub/deep", "deep"), ("leaf1", "one"), ("leaf2", "two")):
        assert spark.read.parquet(f"{tree.parent}/out/nested/{d}/*.parquet").first()["v"] == standard(v)


def test_a_failing_directory_does_not_stop_its_neighbours(spark, tree):
    for name, values in (("a", [1.5]), ("b", WIDE), ("c", [2.5])):
        parquet(tree / "deep" / name / "x.parquet", v=values)
    got = by_dataset(run_job(spark, config(tree), rulebook(spark, [("deep", "v", "Standard", "Y")])))
    assert [got[(f"deep/{n}", "parquet")][0] for n in "abc"] == ["masked", "failed", "masked"]


# The masks of some of these are beyond what a double can hold.
WIDE = [1.0e308 + i * 1e306 for i in range(20)]


def test_one_failing_table_does_not_stop_the_others(spark, tree):
    parquet(tree / "bad" / "x.parquet", v=WIDE, k=["a"] * len(WIDE))
    (tree / "ragged.csv").write_text("v,w\nx,y,z\n")
    (tree / "torn.parquet").write_text("not a parquet file")
    rules = rulebook(
        spark,
        [
            ("bad", "v", "Standard", "Y"),
            ("ragged", "v", "Standard", "Y"),
            ("torn", "v", "Standard", "Y"),
            ("orders", "o_name", "Standard", "Y"),
            ("mixed", "gone", "Standard", "Y"),
            ("nested", "extra", "Standard", "Y"),
            ("spark", "v", "Custom Rule #1", "Y"),
        ],
    )
    got = by_dataset(run_job(spark, config(tree), rules))
    assert got[("orders", "parquet")] == ("masked", 3, None)
    for name, format_ in (("bad", "parquet"), ("ragged.csv", "csv"), ("torn.parquet", "parquet")):
        assert got[(name, format_)][0] == "failed"
        written = tree.parent / "out" / name
        assert not written.exists() or not [n for n in os.listdir(written) if n[0] not in "._"]
    assert got[("mixed", "csv")] == ("invalid_rules", None, "UNKNOWN_ATTRIBUTE 1")
    assert got[("nested", "parquet")] == ("masked", 1, None)
    assert got[("nested/sub", "parquet")] == ("failed", None, "no column extra")
    assert got[("spark.parquet", "parquet")] == ("failed", None, "no column IP Address v4")


def test_a_failing_table_does_not_stop_the_dictionary(spark, tree):
    parquet(tree / "bad" / "x.parquet", v=WIDE)
    rules = rulebook(spark, [("bad", "v", "Standard", "Y"), ("orders", "o_name", "Standard", "Y")])
    cfg = config(tree, dictionary=str(tree.parent / "dictionary"))
    got = by_dataset(run_job(spark, cfg, rules))
    assert got[("bad", "parquet")][0] == "failed"
    assert got[("orders", "parquet")] == ("masked", 3, None)
    originals = {r["original"] for r in load_dictionary(spark, cfg.dictionary).collect()}
    assert originals == {"Ana", "Bo", "Cy"}


def test_existing_output_is_not_overwritten_unasked(spark, tree):
    rules = rulebook(spark, [("orders", "o_name", "Standard", "Y")])
    assert by_dataset(run_job(spark, config(tree), rules))[("orders", "parquet")][0] == "masked"
    assert by_dataset(run_job(spark, config(tree), rules))[("orders", "parquet")][0] == "failed"


def test_rulebook_file_and_project(spark, tree):
    path = tree.parent / "rules.csv"
    path.write_text("Table,Attribute,Masking Rule,Ref Integrity\norders,o_name,Standard,Y\n")
    projects = {"one": config(tree, rulebook=str(path))}
    summary = run_job(spark, select_project(projects, "one"))
    assert by_dataset(summary)[("orders", "parquet")] == ("masked", 3, None)
    with pytest.raises(KeyError):
        select_project(projects, "two")


def test_rules_under_either_name_of_a_table_count(spark, tmp_path):
    parquet(tmp_path / "in" / "a-b" / "x.parquet", v=["Ana"], w=["Bo"])
    rules = rulebook(spark, [("a-b", "v", "Standard", "Y"), ("a_b", "w", "Standard", "Y")])
    cfg = MaskingConfig(project="p", key="test-key", input=str(tmp_path / "in"), output=str(tmp_path / "out"))
    run_job(spark, cfg, rules)
    assert tuple(spark.read.parquet(str(tmp_path / "out/a-b")).first()) == (standard("Ana"), standard("Bo"))


def test_output_inside_input_is_refused(spark, tree):
    cfg = MaskingConfig(project="p", key="k", input=str(tree), output=str(tree / "out"))
    with pytest.raises(ValueError, match="inside"):
        run_job(spark, cfg, rulebook(spark, RULES))


def test_csv_values_survive(spark, tmp_path):
    (tmp_path / "in").mkdir()
    text = 'a,b\n" x ",""\n,"q""uote"\n007,"back\\slash"\n'
    (tmp_path / "in" / "t.csv").write_text(text)
    [d] = fs.datasets(fs.inventory(spark, str(tmp_path / "in")))
    df = fs.read_dataset(spark, str(tmp_path / "in"), d)
    assert [tuple(r) for r in df.collect()] == [(" x ", ""), (None, 'q"uote'), ("007", "back\\slash")]
    fs.write_dataset(df, str(tmp_path / "out"), d)
    [again] = fs.datasets(fs.inventory(spark, str(tmp_path / "out")))
    back = fs.read_dataset(spark, str(tmp_path / "out"), again)
    assert sorted(map(repr, back.collect())) == sorted(map(repr, df.collect()))


@pytest.mark.parametrize("folder", ["t", "t/day=01"])
def test_csv_files_with_different_headers(spark, tmp_path, folder):
    """Each file is read with its own header, so no value escapes its rule."""
    where = tmp_path / "in" / folder
    where.mkdir(parents=True)
    (where / "a.csv").write_text("v,w\nsecret,open\n")
    (where / "b [1].csv").write_text("w,v\nopen,secret\n")
    (where / "c.csv").write_text('"v",extra\nsecret,more\n')
    (where / "d.csv").write_text("")
    cfg = MaskingConfig(project="p", key="test-key", input=str(tmp_path / "in"), output=str(tmp_path / "out"))
    summary = run_job(spark, cfg, rulebook(spark, [("t", "v", "Standard", "Y")])).collect()
    assert [(r["status"], r["n_rows"]) for r in summary] == [("masked", 3)]
    [d] = fs.datasets(fs.inventory(spark, str(tmp_path / "out")))
    rows = fs.read_dataset(spark, str(tmp_path / "out"), d).select("v", "w", "extra").collect()
    hidden = standard("secret")
    assert sorted(map(tuple, rows), key=str) == [(hidden, "open", None), (hidden, "open", None), (hidden, None, "more")]


@pytest.mark.parametrize("multiline", [True, False])
@pytest.mark.parametrize("text", ["\ufeffname,n\r\nAna,1\r\nBo,2\r\n", "name,n\nAna,1\nBo,2"])
def test_csv_with_byte_order_mark_and_line_ends(spark, tmp_path, text, multiline):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "t.csv").write_bytes(text.encode())
    cfg = MaskingConfig(
        project="p", key="test-key", input=str(tmp_path / "in"), output=str(tmp_path / "out"),
        csv_multiline=multiline,
    )
    summary = run_job(spark, cfg, rulebook(spark, [("t", "name", "Standard", "Y")])).collect()
    assert [(r["status"], r["n_rows"]) for r in summary] == [("masked", 2)]
    assert sorted(read_csv(tmp_path / "out/t.csv")) == sorted([[standard("Ana"), "1"], [standard("Bo"), "2"]])


def test_spread(spark):
    df = spark.range(100)
    small, big = fs.spread(df, 1, 1000), fs.spread(df, 1, 10 * fs.SPREAD_BYTES)
    assert small is df and big is not df
    assert fs.spread(df, 400, 400 * fs.ROW_GROUP_BYTES) is df
    assert fs.spread(df, 1, 100 * fs.ROW_GROUP_BYTES) is df
    assert fs.spread(df, 1, 100 * fs.ROW_GROUP_BYTES, splittable=False) is not df
