"""Rule-driven data masking on Spark."""

from maskwright.functions.generator import MaskContext
from maskwright.functions.rules import (
    Rule,
    RuleContext,
    mask_where,
    register_rule,
    rule,
    rule_names,
)
from maskwright.operators.catalog import catalog
from maskwright.operators.dictionary import apply_dictionary, new_entries
from maskwright.operators.masking import ColumnRule, mask, mask_column
from maskwright.operators.rulebook import invalid_rules, read_rulebook, rulebook
from maskwright.plans.job import MaskingConfig, run_job

__all__ = [
    "ColumnRule",
    "MaskContext",
    "MaskingConfig",
    "Rule",
    "RuleContext",
    "apply_dictionary",
    "catalog",
    "invalid_rules",
    "mask",
    "mask_column",
    "mask_where",
    "new_entries",
    "read_rulebook",
    "register_rule",
    "rule",
    "rule_names",
    "rulebook",
    "run_job",
]
