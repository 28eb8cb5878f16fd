"""The masking job: copy all ruled tables below a path, masked, to another path."""

from __future__ import annotations

import uuid
import warnings
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from maskwright.functions.generator import MaskContext
from maskwright.functions.rules import rule
from maskwright.operators.catalog import catalog_of, read_all
from maskwright.operators.conditions import fits
from maskwright.operators.dictionary import Lookups, apply_dictionary, new_entries
from maskwright.operators.masking import ColumnRule, mask
from maskwright.operators.rulebook import errors_by_table, invalid_rules, plan_rules, read_rulebook, table_id
from maskwright.plans.manifest import fingerprint, manifest, record
from maskwright.sources.dictionary_store import compact_dictionary, extend_dictionary, import_csv, load_dictionary
from maskwright.sources.files import (
    Dataset,
    datasets,
    inventory,
    qualified,
    read_together,
    spread,
    target_exists,
    together,
    write_dataset,
    write_together,
)
from maskwright.sources.local import local_frame

# A dataset that can be masked, and how.
_Item = tuple[Dataset, DataFrame, list[ColumnRule]]

SUMMARY_SCHEMA = (
    "table string, dataset string, format string, status string, n_rows long, message string,"
    " run_id string"
)


@dataclass(frozen=True)
class MaskingConfig:
    """One project: where its data, rulebook and dictionary are, and its key.

    With ``resume`` a run passes over what an earlier one has written and nothing has changed
    (``manifest``), and replaces what has.  Without ``dictionary`` masks come from the generator alone; ``dictionary_csv`` is one kept as
    CSV elsewhere, whose entries it takes over first, but for originals it knows.  Without ``run_id`` each
    run draws its own, so that masks of rules with flag ``N`` differ from run to run.
    """

    project: str
    key: str = field(repr=False)
    input: str
    output: str
    rulebook: str | None = None
    dictionary: str | None = None
    dictionary_csv: str | None = None
    run_id: str | None = None
    overwrite: bool = False
    resume: bool = False
    csv_multiline: bool = True
    tables_at_once: int = 4

    @property
    def context(self) -> MaskContext:
        return MaskContext(self.key, self.project, self.run_id)


def select_project(projects: Mapping[str, MaskingConfig], name: str) -> MaskingConfig:
    if name not in projects:
        raise KeyError(f"unknown project {name!r}; known: {sorted(projects)}")
    return projects[name]


@dataclass
class _Outcome:
    dataset: Dataset
    status: str
    n_rows: int | None = None
    message: str | None = None

    def row(self, run_id: str) -> tuple:
        d = self.dataset
        return (d.table, d.path, d.format, self.status, self.n_rows, self.message, run_id)


def _normal(name: str) -> str:
    return name.replace(" ", "_").replace("-", "_")


def _rules_by_table(
    plan: Mapping[str, list[ColumnRule]], tables: set[str]
) -> dict[str, list[ColumnRule]]:
    """Rules of each table.

    A rule whose table name is no table's own name belongs to all tables of the
    same normalised name.
    """
    found: dict[str, list[ColumnRule]] = {t: [] for t in tables}
    for name, rules in plan.items():
        for t in {name} & tables or {t for t in tables if _normal(t) == _normal(name)}:
            found[t].extend(rules)
    return found


def _missing_columns(df: DataFrame, rules: list[ColumnRule]) -> list[str]:
    """Columns the rules of a dataset need and it does not have."""
    needed = {r.attribute for r in rules}.union(*[rule(r.rule).requires for r in rules])
    return sorted(needed - set(df.columns))


def _message(error: Exception) -> str:
    """The error's class and condition; its text could quote data."""
    condition = getattr(error, "getCondition", lambda: None)()
    return f"{type(error).__name__}: {condition}" if condition else type(error).__name__


def run_job(
    spark: SparkSession, config: MaskingConfig, rules: DataFrame | None = None
) -> DataFrame:
    """Mask every ruled table below ``config.input`` into ``config.output``.

    Returns one summary row per dataset, and one per table that the rulebook speaks of
    but the input lacks.  Tables without rules are not copied.  A table with a rulebook
    error, or one that fails, is not written; the others still are.  The summary counts
    errors by code; ``rulebook_errors`` has them one by one.
    """
    config = replace(config, run_id=config.run_id or uuid.uuid4().hex)
    source, target = qualified(spark, config.input), qualified(spark, config.output)
    if f"{target}/".startswith(f"{source}/"):
        raise ValueError("the output must not lie inside the input")
    if config.dictionary_csv is not None and config.dictionary is None:
        raise ValueError("a dictionary to take the CSV entries over is required")
    rules = _rules(spark, config, rules)

    found = datasets(inventory(spark, config.input))
    names = local_frame(spark, [(d.table,) for d in found], "table string").distinct()
    names = names.select("table", table_id(F.col("table")).alias("table_norm"))
    spoken = rules.select(table_id(F.col("table")).alias("__norm")).distinct()
    with_rules = {r["table"] for r in names.join(spoken, F.col("table_norm") == F.col("__norm"), "left_semi").collect()}
    outcomes = [_Outcome(d, "no_rules") for d in found if d.table not in with_rules]
    ruled = [d for d in found if d.table in with_rules]

    frames = read_all(spark, config.input, ruled, config.csv_multiline)
    catalog = catalog_of(spark, ruled, frames)
    # What comes to the driver is bounded by the tables: a handful of codes for each.
    errors = errors_by_table(rules, catalog).persist()
    here = errors.join(names.select("table_norm").distinct(), "table_norm", "left_semi")
    bad: dict[str, list[str]] = {}
    for e in here.collect():
        bad.setdefault(e["table_norm"], []).append(f"{e['code']} {e['n']}")
    unreadable = {d.table for d, df in zip(ruled, frames) if isinstance(df, Exception)}
    sound = names.where(~F.col("table_norm").isin([*bad, *map(_normal, unreadable)]))
    by_table = _rules_by_table(plan_rules(rules, sound), {d.table for d in ruled})

    ready: list[_Item] = []
    for d, df in zip(ruled, frames):
        if isinstance(df, Exception):
            outcomes.append(_Outcome(d, "failed", message=_message(df)))
            continue
        if _normal(d.table) in bad:
            message = "; ".join(sorted(bad[_normal(d.table)]))
            outcomes.append(_Outcome(d, "invalid_rules", message=message))
            continue
        try:
            missing = _missing_columns(df, by_table[d.table])
        except Exception as error:  # one table's rules must not stop the others
            outcomes.append(_Outcome(d, "failed", message=_message(error)))
            continue
        if missing:
            outcomes.append(_Outcome(d, "failed", message="no column " + ", ".join(missing)))
            continue
        unfit = [r.attribute for r in by_table[d.table] if r.condition is not None and not fits(df, r.condition)]
        if unfit:
            outcomes.append(_Outcome(d, "failed", message="no predicate for " + ", ".join(unfit)))
            continue
        ready.append((d, df, by_table[d.table]))

    prints = {
        d.target: fingerprint(d, df, table_rules, config.context, config.dictionary is not None) for d, df, table_rules in ready
    }
    replaced: set[str] = set()
    if config.resume:
        # A line per dataset, as the driver has them anyway.
        before = {r["target"]: r for r in manifest(spark, config.output).collect()}
        there = [i for i in ready if i[0].target in before and target_exists(spark, config.output, i[0])]
        same = {i[0].target for i in there if before[i[0].target]["print"] == prints[i[0].target]}
        replaced = {i[0].target for i in there} - same
        outcomes += [_Outcome(i[0], "unchanged", before[i[0].target]["n_rows"]) for i in there if i[0].target in same]
        ready = [i for i in ready if i[0].target not in same]

    def overwrites(d: Dataset) -> bool:
        return config.overwrite or d.target in replaced

    lookups = None
    if config.dictionary is not None:
        if config.dictionary_csv is not None:
            _take_over(spark, config.dictionary, config.dictionary_csv, config.context.scope())
        ready, failed = _extend_dictionary(spark, config, ready)
        outcomes.extend(failed)
        compact_dictionary(spark, config.dictionary)
        lookups = Lookups(load_dictionary(spark, config.dictionary, makers_too=True), config.context)

    def masked(df: DataFrame, table_rules: list[ColumnRule]) -> DataFrame:
        if lookups is None:
            return mask(df, table_rules, config.context)
        return apply_dictionary(df, table_rules, lookups, config.context)

    def write(item: _Item) -> _Outcome:
        d, df, table_rules = item
        splittable = d.format == "parquet" or not config.csv_multiline
        try:
            if not d.keys:  # dealt-out rows would make files in every partition
                df = spread(df, d.n_files, d.n_bytes, splittable)
            counted = Observation()
            result = masked(df, table_rules).observe(counted, F.count(F.lit(1)).alias("n"))
            write_dataset(result, config.output, d, overwrites(d))
            n_rows = counted.get["n"]
            record(spark, config.output, [(d, prints[d.target], n_rows)], config.run_id)
            return _Outcome(d, "masked", n_rows)
        except Exception as error:  # one table's failure must not stop the others
            return _Outcome(d, "failed", message=_message(error))

    def write_table(items: list[_Item]) -> list[_Outcome]:
        """Directories of one schema in one job; what is left, and what fails, one by one."""
        done: list[_Outcome] = []
        free = [i for i in items if overwrites(i[0]) or not target_exists(spark, config.output, i[0])]
        for group in together([(d, df) for d, df, _ in free]):
            schema, table_rules = next((df.schema, rules) for d, df, rules in items if d == group[0])
            number = "__directory"
            while number in schema.names:
                number += "_"
            try:
                df = read_together(spark, config.input, group, schema, number)
                df = spread(df, sum(d.n_files for d in group), sum(d.n_bytes for d in group))
                n_rows = write_together(masked(df, table_rules), config.output, group, number, overwrites)
                record(spark, config.output, [(d, prints[d.target], n_rows[d.path]) for d in group], config.run_id)
            except Exception:  # to find the directory at fault
                continue
            done.extend(_Outcome(d, "masked", n_rows[d.path]) for d in group)
        paths = {o.dataset for o in done}
        return done + [write(i) for i in items if i[0] not in paths]

    # Datasets of one table stay in order, as one may lie inside another.
    tables: dict[str, list[_Item]] = {}
    for item in ready:
        tables.setdefault(item[0].path.split("/")[0], []).append(item)
    try:
        with ThreadPoolExecutor(config.tables_at_once) as pool:
            for part in pool.map(write_table, tables.values()):
                outcomes.extend(part)
    finally:
        if lookups is not None:
            lookups.close()

    summary = local_frame(spark, [o.row(config.run_id) for o in outcomes], SUMMARY_SCHEMA)
    absent = errors.join(names.select("table_norm").distinct(), "table_norm", "left_anti")
    messages = F.array_join(F.sort_array(F.collect_list(F.concat_ws(" ", "code", "n"))), "; ")
    absent = absent.groupBy(F.col("table_norm").alias("table")).agg(messages.alias("message"))
    return summary.unionByName(
        absent.select(
            "table", F.lit("invalid_rules").alias("status"), "message",
            F.lit(config.run_id).alias("run_id"),
        ),
        allowMissingColumns=True,
    )


def _rules(spark: SparkSession, config: MaskingConfig, rules: DataFrame | None) -> DataFrame:
    if rules is not None:
        return rules
    if config.rulebook is None:
        raise ValueError("a rulebook is required")
    return read_rulebook(spark, config.rulebook)


def rulebook_errors(
    spark: SparkSession, config: MaskingConfig, rules: DataFrame | None = None
) -> DataFrame:
    """All errors of the rulebook, checked against the tables below ``config.input``."""
    found = datasets(inventory(spark, config.input))
    frames = read_all(spark, config.input, found, config.csv_multiline)
    return invalid_rules(_rules(spark, config, rules), catalog_of(spark, found, frames))


def _take_over(spark: SparkSession, base: str, path: str, scope: str) -> None:
    """Entries of a CSV dictionary whose originals the dictionary lacks."""
    handed = import_csv(spark, path, scope)
    extend_dictionary(
        spark, base, lambda known: handed.join(known.select("scope", "original"), ["scope", "original"], "left_anti"))


def _extend_dictionary(
    spark: SparkSession,
    config: MaskingConfig,
    ready: list[_Item],
) -> tuple[list[_Item], list[_Outcome]]:
    """Store entries for all values the dictionary lacks, before any table is written.

    One pass over all tables; should it fail, table by table, to find the culprit.
    """
    base, context = config.dictionary, config.context

    def extend(items: list[_Item]) -> None:
        tables = [(df, rules) for _, df, rules in items]
        extend_dictionary(spark, base, lambda existing: new_entries(tables, context, existing, makers_too=True))

    if not ready:
        return ready, []
    try:
        extend(ready)
        return ready, []
    except Exception as reason:
        warnings.warn(f"the pass over all tables failed ({_message(reason)}); table by table", stacklevel=2)
        good, failed = [], []
        for item in ready:
            try:
                extend([item])
                good.append(item)
            except Exception as error:
                failed.append(_Outcome(item[0], "failed", message=_message(error)))
        return good, failed
