"""Masking of columns and whole tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from maskwright.functions.generator import MaskContext, canonical_text, is_text
from maskwright.functions.rules import Cell, Rule, RuleContext, mask_where, quoted, rule

# Prefixes of columns that exist only while a table is being masked.
STEP = "__step_"
FOUND = "__found_"


@dataclass(frozen=True)
class ColumnRule:
    """One rulebook row, already narrowed to a table."""

    attribute: str
    rule: str
    ref_integrity: str = "Y"
    ordinal: int = 0
    condition: str | None = None


def rule_of(r: ColumnRule) -> Rule:
    """The rule of a rulebook row, limited to the rows that meet its condition."""
    base = rule(r.rule)
    return base if r.condition is None else mask_where(base.name, base, lambda: F.expr(r.condition))


def mask(
    df: DataFrame,
    rules: Iterable[ColumnRule],
    context: MaskContext,
    found: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Mask the ruled columns of ``df`` in one pass.

    Other columns and the column order stay as they are.  Every rule sees the
    original row: a rule whose condition reads another column reads it unmasked.
    ``found`` holds dictionary hits by attribute.

    The work is laid out as a chain of projections (text, seed, masked text,
    result), because an expression that is used several times is computed once
    only if it is a column of the projection below.
    """
    found = found or {}
    seen: dict[str, tuple[Rule, RuleContext]] = {}
    for r in rules:
        if r.attribute in seen:
            raise ValueError(f"more than one rule for attribute {r.attribute}")
        dtype = df.schema[r.attribute].dataType
        if not rule(r.rule).accepts(dtype):
            raise ValueError(f"rule {r.rule} does not support {r.attribute} {dtype.simpleString()}")
        seen[r.attribute] = rule_of(r), RuleContext(context, dtype, r.ref_integrity)

    texts: dict[str, Column] = {}
    seeds: dict[str, Column] = {}
    masks: dict[str, Column] = {}
    results: dict[str, Column] = {}
    for i, (attribute, (this, rule_context)) in enumerate(seen.items()):
        value, dtype = quoted(attribute), rule_context.dtype
        text = value
        if not is_text(dtype):
            texts[f"{STEP}text_{i}"] = canonical_text(value, dtype)
            text = F.col(f"{STEP}text_{i}")
        seeds[f"{STEP}seed_{i}"] = this.seed(text, rule_context)
        cell = Cell(text, F.col(f"{STEP}seed_{i}"), rule_context)
        masks[f"{STEP}mask_{i}"] = this.masked_text(cell, found.get(attribute))
        results[attribute] = this.result(value, F.col(f"{STEP}mask_{i}"), dtype)

    staged = df
    for step in (texts, seeds, masks):
        if step:
            staged = staged.withColumns(step)
    columns = [c for c in df.columns if not c.startswith(FOUND)]
    return staged.select(
        *[results[c].alias(c) if c in results else quoted(c) for c in columns]
    )


def mask_column(
    df: DataFrame,
    attribute: str,
    rule_name: str,
    context: MaskContext,
    ref_integrity: str = "Y",
) -> DataFrame:
    """Apply one rule to one column."""
    return mask(df, [ColumnRule(attribute, rule_name, ref_integrity)], context)
