"""The masking rules and the registry that maps rule names to them.

A rule turns one column into its masked column.  All of them are expressions
over built-in functions, so a table is masked in a single projection.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from maskwright.functions.arrow_text import replace_pieces, replace_text
from maskwright.functions.generator import (
    MaskContext,
    canonical_text,
    character_classes,
    is_number,
    is_text,
    mask_number_text,
    mask_text,
    not_a_number,
    restore_type,
    seed_number,
    seed_of,
)
from maskwright.functions.key_permutation import permute_batch, permute_column
from maskwright.functions.places import CITIES, STATES, STREET_TYPES, STREETS

NULL_TEXT = "null"


def quoted(name: str) -> Column:
    """Column by its exact name, whatever characters it contains."""
    return F.col("`" + name.replace("`", "``") + "`")


@dataclass(frozen=True)
class RuleContext:
    """What a rule needs to know about the column it is applied to."""

    mask: MaskContext
    dtype: T.DataType = T.StringType()
    ref_integrity: str = "Y"

    def scope(self, namespace: str = "") -> str:
        return self.mask.scope(self.ref_integrity) + namespace

    def tag(self, namespace: str = "") -> str:
        return self.mask.tag(self.scope(namespace))


@dataclass(frozen=True)
class Cell:
    """A value about to be masked: its text, and the seed of that text."""

    text: Column
    seed: Column
    context: RuleContext

    def masked(self, text: Column) -> Column:
        """Another text, masked as it would be standing alone."""
        return self._replaced(text, seed_of(text, self.context.tag()))

    def masked_whole(self) -> Column:
        return self._replaced(self.text, self.seed)

    def masked_pieces(self, pieces: Column) -> Column:
        """An array of texts, each masked as it would be standing alone."""
        tag = self.context.tag()
        if self.context.mask.text_engine == "arrow":
            return replace_pieces(
                F.transform(pieces, character_classes),
                F.transform(pieces, lambda piece: seed_of(piece, tag)),
            )
        return F.transform(pieces, lambda piece: mask_text(piece, seed_of(piece, tag)))

    def _replaced(self, text: Column, seed: Column) -> Column:
        if self.context.mask.text_engine == "arrow":
            return replace_text(character_classes(text), seed)
        return mask_text(text, seed)


def _whole_text(text: Column) -> Column:
    return text


def _found_text(text: Column, found: Column) -> Column:
    return found


@dataclass(frozen=True)
class Rule:
    """One masking rule, working on the text of a value.

    ``generate``    cell -> replacement text, for values that are to be masked
    ``keeps``       value -> condition for rows the rule leaves untouched
    ``namespace``   separates results that must not mix with ordinary masks
    ``text_only``   the rule makes no sense on numbers
    ``digits``      the rule replaces digits, so NaN and infinities stay
    ``key``/``use`` what is looked up in a mask dictionary, and how a hit is used
    ``generate_key``  the mask of such a key, where it differs from ``generate``
    ``parts``       pieces of a value that leave dictionary entries of their own
    ``pieces``      all pieces of a value, which ``glue`` puts together again; each is masked as if
                    standing alone.  Null for values that are masked as a whole
    ``requires``    further columns the rule reads
    ``whole_digits``  digits before the point the result may need in a decimal
    ``keys``        the rule is for keys: texts, and integers of 16 bits or more
    ``made_by``     the rule whose masks of dictionary keys are the same, if not its own name
    """

    name: str
    generate: Callable[[Cell], Column]
    keeps: Callable[[Column], Column] | None = None
    namespace: str = ""
    text_only: bool = False
    digits: bool = True
    key: Callable[[Column], Column] = _whole_text
    use: Callable[[Column, Column], Column] = _found_text
    generate_key: Callable[[Cell], Column] | None = None
    parts: Callable[[Column], Column] | None = None
    pieces: Callable[[Column], Column] | None = None
    glue: str = ""
    requires: tuple[str, ...] = ()
    whole_digits: int = 0
    keys: bool = False
    made_by: str | None = None

    def maker(self, context: RuleContext) -> str:
        """Names the generator of dictionary keys: equal names give equal masks in a scope. The
        key is part of it, as entries made with another key are not what would be made now."""
        kind = "string" if is_text(context.dtype) else context.dtype.simpleString()
        check = hashlib.sha256(f"maker|{context.tag(self.namespace)}".encode()).hexdigest()[:8]
        return f"{self.made_by or self.name}/{kind}/{check}"

    def accepts(self, dtype: T.DataType) -> bool:
        if self.keys:
            return is_text(dtype) or isinstance(dtype, (T.ShortType, T.IntegerType, T.LongType))
        if isinstance(dtype, T.DecimalType) and dtype.precision - dtype.scale < self.whole_digits:
            return False
        return is_text(dtype) or (is_number(dtype) and not self.text_only)

    def untouched(self, value: Column, dtype: T.DataType) -> Column:
        """Rows that keep their value: nulls, the text 'null', the rule's own."""
        condition = value.isNull()
        if is_text(dtype):
            condition = condition | (value == NULL_TEXT)
        strange = not_a_number(value, dtype) if self.digits else None
        if strange is not None:
            condition = condition | strange
        if self.keeps is not None:
            condition = condition | F.coalesce(self.keeps(value), F.lit(False))
        return condition

    def seed(self, text: Column, context: RuleContext) -> Column:
        return seed_of(text, context.tag(self.namespace))

    def masked_text(self, cell: Cell, found: Column | None = None) -> Column:
        """The replacement as text; ``found`` is a dictionary hit, which wins."""
        masked = self.generate(cell)
        if found is None:
            return masked
        return F.when(found.isNotNull(), self.use(cell.text, found)).otherwise(masked)

    def result(self, value: Column, masked_text: Column, dtype: T.DataType) -> Column:
        """The masked column in its own type, untouched rows included."""
        return F.when(self.untouched(value, dtype), value).otherwise(
            restore_type(masked_text, dtype)
        )

    def masked_key(self, key: Column, context: RuleContext) -> Column:
        """The mask the rule gives a dictionary key."""
        generate = self.generate_key or self.generate
        return generate(Cell(key, self.seed(key, context), context))

    def __call__(self, value: Column | str, context: RuleContext) -> Column:
        """The masked column as one expression.

        ``mask`` does the same in steps, which computes shared parts only once.
        """
        value = quoted(value) if isinstance(value, str) else value
        text = canonical_text(value, context.dtype)
        cell = Cell(text, self.seed(text, context), context)
        return self.result(value, self.masked_text(cell), context.dtype)


# --------------------------------------------------------------------- e-mail


def _at_parts(text: Column) -> tuple[Column, Column, Column]:
    """(has exactly one @, user, domain)."""
    parts = F.split(text, "@")
    return F.size(parts) == 2, F.get(parts, 0), F.get(parts, 1)


def _user_and_domain(text: Column) -> Column:
    """User and domain are masked each on its own; anything else as a whole."""
    parts = F.split(text, "@")
    return F.when(F.size(parts) == 2, parts)


def _email(cell: Cell) -> Column:
    if not is_text(cell.context.dtype):
        return _standard(cell)
    whole = F.when(cell.text.isNotNull(), F.array(cell.text))
    return F.array_join(cell.masked_pieces(F.coalesce(_user_and_domain(cell.text), whole)), "@")


def _user(text: Column) -> Column:
    """The user part, or the whole text unless it has exactly one @."""
    simple, user, _ = _at_parts(text)
    return F.when(simple, user).otherwise(text)


def _with_domain(text: Column, masked_user: Column) -> Column:
    simple, _, domain = _at_parts(text)
    return F.concat(masked_user, F.when(simple, F.concat(F.lit("@"), domain)).otherwise(F.lit("")))


def _email_keep_domain(cell: Cell) -> Column:
    if not is_text(cell.context.dtype):
        return _standard(cell)
    return _with_domain(cell.text, cell.masked(_user(cell.text)))


def _email_user(text: Column) -> Column:
    simple, user, _ = _at_parts(text)
    return F.when(simple, F.array(user))


# ----------------------------------------------------------------- other rules

# A name is cut into words and what stands between them.
WORDS = r"[\p{L}\p{N}_]+"
WORDS_AND_GAPS = WORDS + r"|[^\p{L}\p{N}_]+"


def _standard(cell: Cell) -> Column:
    if is_number(cell.context.dtype):
        return mask_number_text(cell.text, cell.seed)
    return cell.masked_whole()


def _age(cell: Cell) -> Column:
    return (seed_number(cell.seed, 1, 8) % 83 + 18).cast("string")


def _words_and_gaps(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORDS_AND_GAPS), F.lit(0))


def _full_name(cell: Cell) -> Column:
    return F.array_join(cell.masked_pieces(_words_and_gaps(cell.text)), "")


def _name_words(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(text, F.lit(WORDS), F.lit(0)))


def _is_private_ten(value: Column) -> Column:
    return F.substring_index(value, ".", 1) == "10"


def _credit_card(cell: Cell) -> Column:
    digits = F.lpad(F.conv(F.substring(cell.seed, 1, 15), 16, 10), 19, "0")
    body = F.concat(F.lit("4"), F.substring(digits, 6, 14))
    # Luhn: of the 15 digits the 1st, 3rd, ... 15th count double, less 9 above 9.
    doubled = F.translate(body, "0123456789", "0246813579")

    total = F.lit(0)
    for place in range(1, 16):
        digit = F.substring(doubled if place % 2 else body, place, 1)
        total = total + F.ascii(digit) - 48
    check = (F.lit(10) - total % 10) % 10
    return F.concat(body, check.cast("string"))


def _pick(choices: tuple[str, ...], seed: Column, start: int) -> Column:
    table = F.expr("array('" + "', '".join(choices) + "')")
    return F.element_at(table, (seed_number(seed, start, 6) % len(choices) + 1).cast("int"))


def _address(cell: Cell) -> Column:
    seed = cell.seed
    number = (seed_number(seed, 1, 6) % 9999 + 1).cast("string")
    postcode = F.lpad((seed_number(seed, 31, 6) % 100000).cast("string"), 5, "0")
    street = F.concat_ws(" ", number, _pick(STREETS, seed, 7), _pick(STREET_TYPES, seed, 13))
    town = F.concat(
        _pick(CITIES, seed, 19), F.lit(", "), _pick(STATES, seed, 25), F.lit(" "), postcode
    )
    return F.concat(street, F.lit("\n"), town)


def _unique(cell: Cell) -> Column:
    tag = cell.context.tag("/key")
    if cell.context.mask.text_engine == "arrow":
        return permute_batch(cell.text, F.lit(tag))
    return permute_column(cell.text, tag)


# ------------------------------------------------------------------- registry

_RULES: dict[str, Rule] = {}


def register_rule(rule: Rule) -> Rule:
    """Add a rule, or replace the one of the same name."""
    _RULES[rule.name] = rule
    return rule


def rule(name: str) -> Rule:
    return _RULES[name]


def rule_names() -> list[str]:
    return sorted(_RULES)


def text_only_rules() -> list[str]:
    return sorted(name for name, r in _RULES.items() if r.text_only)


def accepts_type(rule_name: Column, type_name: Column) -> Column:
    """``Rule.accepts`` for columns holding rule names and Spark type names."""
    text = type_name.rlike(r"^(string|char\(|varchar\()")
    number = type_name.rlike(r"^(tinyint|smallint|int|bigint|float|double|decimal\()")
    size = [
        F.regexp_extract(type_name, r"^decimal\((\d+),(\d+)\)", i).try_cast("int") for i in (1, 2)
    ]
    whole_digits = F.lit(0)
    for name, r in sorted(_RULES.items()):
        if r.whole_digits:
            whole_digits = F.when(rule_name == name, r.whole_digits).otherwise(whole_digits)
    wide_enough = F.coalesce(size[0] - size[1] >= whole_digits, F.lit(True))
    keys = rule_name.isin([name for name, r in _RULES.items() if r.keys])
    number = F.when(keys, type_name.isin("smallint", "int", "bigint")).otherwise(number)
    return text | (number & ~rule_name.isin(text_only_rules()) & wide_enough)


def mask_where(
    name: str, base: Rule, condition: Callable[[], Column], requires: tuple[str, ...] = ()
) -> Rule:
    """``base`` limited to rows meeting a condition on other columns.

    Rows where the condition is null are masked: when in doubt, mask.
    """

    def keeps(value: Column) -> Column:
        other = ~F.coalesce(condition(), F.lit(True))
        return other if base.keeps is None else (other | base.keeps(value))

    made_by = base.made_by or base.name
    return replace(base, name=name, keeps=keeps, requires=base.requires + requires, made_by=made_by)


register_rule(Rule("Standard", _standard))
register_rule(Rule("Standard - Unique", _unique, namespace="/key", keys=True))
register_rule(Rule("Age", _age, namespace="/age", digits=False, whole_digits=3))
register_rule(Rule("Email", _email, parts=_email_user, pieces=_user_and_domain, glue="@"))
register_rule(
    Rule(
        "Email - Retain Domain",
        _email_keep_domain,
        key=_user,
        use=_with_domain,
        generate_key=_standard,
        made_by="Standard",
    )
)
register_rule(Rule("Full Name", _full_name, text_only=True, parts=_name_words, pieces=_words_and_gaps))
register_rule(Rule("Physical Address", _address, namespace="/address", text_only=True))
register_rule(Rule("IP Address", _standard, text_only=True, made_by="Standard"))
register_rule(
    Rule("IP Address - Ignore 10.", _standard, keeps=_is_private_ten, text_only=True, made_by="Standard")
)
register_rule(Rule("Credit Card", _credit_card, namespace="/card", text_only=True))
register_rule(
    mask_where(
        "Custom Rule #1",
        rule("Full Name"),
        lambda: ~quoted("IP Address v4").startswith("10."),
        requires=("IP Address v4",),
    )
)
