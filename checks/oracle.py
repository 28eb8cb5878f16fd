"""The same results in DuckDB SQL, written from the definitions.

Helpers below return SQL text for one expression; nothing is generated from the
Spark expressions.
"""

from __future__ import annotations

from checks.views import EVENT_CONDITIONS, EVENT_RULES, LEGACY_DICTIONARY, LEGACY_PIECES, PII_CUSTOMER, TABLES, duck_view
from maskwright.functions.places import CITIES, STATES, STREET_TYPES, STREETS

KEY = "correctness-check-key"
PROJECT = "project:checks"
RUN = "run:checks/run-1"

_LOWER = "abcdefghijklmnopqrstuvwxyz"
_UPPER = _LOWER.upper()
_BASE26 = "0123456789ABCDEFGHIJKLMNOP"

PII = f"pii as ({duck_view(PII_CUSTOMER)})"
RULES = f"rules as ({duck_view(EVENT_RULES)})"
LEGACY = f"legacy as ({LEGACY_DICTIONARY})"
IP = '"IP Address v4"'

_NAMES = ", ".join(f"'{t}'" for t in TABLES)
CATALOG = f"""catalog as (
  select table_name as "table", regexp_replace(table_name, '[ -]', '_', 'g') as table_norm,
    column_name as "column", cast(ordinal_position as int) as position,
    case data_type when 'BIGINT' then 'bigint' when 'INTEGER' then 'int' when 'VARCHAR' then 'string'
      when 'DOUBLE' then 'double' when 'FLOAT[]' then 'array<float>'
      when 'TIMESTAMP' then 'timestamp_ntz' when 'TIMESTAMP_NS' then 'timestamp_ntz'
      when 'TIMESTAMP WITH TIME ZONE' then 'timestamp' else data_type end as type
  from (select distinct table_name, column_name, ordinal_position, data_type
        from information_schema.columns where table_name in ({_NAMES})))"""


def tag(scope: str) -> str:
    return f"sha256('{KEY}|{scope}')[1:32]"


def seed(value: str, scope: str) -> str:
    return f"sha256({tag(scope)} || '|' || {value})"


def number(seed_sql: str, start: int, digits: int) -> str:
    return f"('0x' || substr({seed_sql}, {start}, {digits}))::bigint"


def std(value: str, scope: str = PROJECT) -> str:
    """Letters by letters, digits by digits, run by run."""
    classes = (
        f"regexp_replace(regexp_replace(regexp_replace({value}, '\\p{{Lu}}', 'A', 'g'),"
        " '\\p{Ll}', 'a', 'g'), '\\p{Nd}', '0', 'g')"
    )
    word = (
        "('0x' || substr(case when j <= 4 then s else sha256(s || '|' || ((j - 1) // 4)) end,"
        " 16 * ((j - 1) % 4) + 1, 15))::bigint"
    )
    letters = f"right(lpad(to_base({word}, 26), 19, '0'), length(p))"
    lower = f"translate({letters}, '{_BASE26}', '{_LOWER}')"
    run = (
        f"case when p[1] = 'a' then {lower}"
        f" when p[1] = 'A' and p[-1] = 'a' then upper({lower}[1]) || {lower}[2:]"
        f" when p[1] = 'A' then translate({letters}, '{_BASE26}', '{_UPPER}')"
        f" when p[1] = '0' then right(lpad(({word})::varchar, 19, '0'), length(p)) else p end"
    )
    runs = f"regexp_extract_all({classes}, 'A?a{{1,10}}|A{{1,11}}|0{{1,11}}|[^Aa0]+')"
    return (
        f"case when {value} is not null then list_transform([{seed(value, scope)}], lambda s:"
        f" coalesce(array_to_string(list_transform({runs}, lambda p, j: {run}), ''), ''))[1] end"
    )


def keep(value: str, masked: str, also: str = "false") -> str:
    return f"case when {value} is null or {value} = 'null' or {also} then {value} else {masked} end"


def standard(value: str, scope: str = PROJECT) -> str:
    return keep(value, std(value, scope))


def bigint(value: str) -> str:
    """Masked integer; on overflow the leading digit becomes 1."""
    text = std(f"({value})::varchar")
    return (
        f"list_transform([{text}], lambda m: coalesce(try_cast(m as bigint),"
        " (case when m like '-%' then '-1' else '1' end || substr(ltrim(m, '-'), 2))::bigint))[1]"
    )


def double(value: str) -> str:
    return f"({std(f'({value})::varchar')})::double"


def age(value: str, scope: str) -> str:
    return f"18 + {number(seed(value, scope + '/age'), 1, 8)} % 83"


def email(value: str) -> str:
    user, domain = f"split_part({value}, '@', 1)", f"split_part({value}, '@', 2)"
    return keep(
        value,
        f"case when len(string_split({value}, '@')) = 2 then {std(user)} || '@' || {std(domain)}"
        f" else {std(value)} end",
    )


def email_keep_domain(value: str) -> str:
    user, domain = f"split_part({value}, '@', 1)", f"split_part({value}, '@', 2)"
    return keep(
        value,
        f"case when len(string_split({value}, '@')) = 2 then {std(user)} || '@' || {domain}"
        f" else {std(value)} end",
    )


_WORDS = "[\\p{L}\\p{N}_]+"


def name_words(value: str) -> str:
    """Masked word by word, without the null and keep tests."""
    return (
        f"array_to_string(list_transform(regexp_extract_all({value}, '{_WORDS}|[^\\p{{L}}\\p{{N}}_]+'),"
        f" lambda w: {std('w')}), '')"
    )


def full_name(value: str, also: str = "false") -> str:
    return keep(value, name_words(value), also)


def ip_ignore_10(value: str) -> str:
    return keep(value, std(value), f"split_part({value}, '.', 1) = '10'")


def card(value: str, scope: str = PROJECT) -> str:
    body = f"'4' || right(lpad(({number(seed(value, scope + '/card'), 1, 15)})::varchar, 19, '0'), 14)"
    digits = "list_transform(range(1, 16), lambda i: substr(b, i, 1)::int * (1 + i % 2))"
    total = f"list_sum(list_transform({digits}, lambda d: case when d > 9 then d - 9 else d end))"
    return keep(
        value,
        f"list_transform([{body}], lambda b: b || ((10 - {total} % 10) % 10)::int::varchar)[1]",
    )


def _pick(choices: tuple[str, ...], start: int) -> str:
    items = ", ".join(f"'{c}'" for c in choices)
    return f"([{items}])[1 + {number('s', start, 6)} % {len(choices)}]"


def address(value: str, scope: str = PROJECT) -> str:
    text = (
        f"({number('s', 1, 6)} % 9999 + 1)::varchar || ' ' || {_pick(STREETS, 7)} || ' ' ||"
        f" {_pick(STREET_TYPES, 13)} || chr(10) || {_pick(CITIES, 19)} || ', ' || {_pick(STATES, 25)}"
        f" || ' ' || lpad(({number('s', 31, 6)} % 100000)::varchar, 5, '0')"
    )
    return keep(value, f"list_transform([{seed(value, scope + '/address')}], lambda s: {text})[1]")


def _moved(half: str, other: str, r: int, scope: str) -> str:
    """One round: every character of a half moves on within its alphabet."""
    first = "case when ch >= 'a' then 97 when ch >= 'A' then 65 else 48 end"
    block = "case when i <= 16 then k else sha256(k || '|' || (i - 1) // 16) end"
    number = f"('0x' || substr({block}, 4 * ((i - 1) % 16) + 1, 4))::int"
    one = f"chr({first} + (ascii(ch) - ({first}) + {number}) % (case when ch >= 'A' then 26 else 10 end))"
    key = f"sha256({tag(scope)} || '|{r}|' || shape || '|' || {other})"
    return (
        f"case when {half} = '' then '' else list_transform([{key}], lambda k: array_to_string("
        f"list_transform(string_split({half}, ''), lambda ch, i: {one}), ''))[1] end"
    )


def permuted(values: str, scope: str = PROJECT + "/key") -> str:
    """CTEs that end in perm(v, masked): every text of ``values`` (column v) along its cycle of
    its shape until it is of its own kind again."""
    shape = "regexp_replace(regexp_replace(regexp_replace(x, '[A-Z]', 'A', 'g'), '[a-z]', 'a', 'g'), '[0-9]', '0', 'g')"
    number = "try_cast({} as bigint)"
    kind = (
        "case when {0} = 'null' then -1 when coalesce(" + number + "::varchar = {0}, false) then case"
        " when " + number + " between -32768 and 32767 then 16"
        " when " + number + " between -2147483648 and 2147483647 then 32 else 64 end else 0 end"
    )
    symbols = "regexp_replace(x, '[^A-Za-z0-9]', '', 'g')"
    inner = f"""select v, own, x, step, {shape} as shape, {symbols}[1 : (length({symbols}) + 1) // 2] as l,
      {symbols}[(length({symbols}) + 1) // 2 + 1 :] as r from walk where step = 0 or {kind.replace('{0}', 'x').replace('{}', 'x')} <> own"""
    for turn in range(10):
        l = _moved("l", "r", turn, scope) if turn % 2 == 0 else "l"
        r = _moved("r", "l", turn, scope) if turn % 2 else "r"
        inner = f"select v, own, x, step, shape, {l} as l, {r} as r from ({inner})"
    kept = "length(regexp_replace(x[1 : i], '[^A-Za-z0-9]', '', 'g'))"
    placed = (
        "array_to_string(list_transform(range(1, length(x) + 1), lambda i:"
        f" case when regexp_matches(x[i], '[A-Za-z0-9]') then (l || r)[{kept}] else x[i] end), '')"
    )
    own = kind.replace("{0}", "v").replace("{}", "v")
    return f"""walk(v, own, x, step) as (select v, {own}, v, 0 from (select distinct v from ({values}) where v <> 'null')
      union all select v, own, {placed}, step + 1 from ({inner})),
    perm as (select v, arg_max(x, step) as masked from walk group by v)"""


def pii_query(expression: str) -> str:
    return f"with {PII} select c_custkey, {expression} as masked from pii"


def entries(*parts: str) -> str:
    """New dictionary entries from (original, ord, masked) selects, earliest first."""
    union = " union all ".join(parts)
    return f"""select scope, original, masked from (
      select scope, original, arg_min(masked, ord) as masked from ({union})
      where original is not null group by scope, original) e
    where not exists (select 1 from legacy l where l.scope = e.scope and l.original = e.original)"""


def entry(original: str, masked: str, order: int, source: str, scope: str = PROJECT) -> str:
    return (
        f"select distinct '{scope}' as scope, {original} as original, {masked} as masked,"
        f" {order} as ord from {source}"
    )


_USER = "(select distinct split_part(email, '@', 1) as u from pii where len(string_split(email, '@')) = 2)"


def _words_of(column: str, source: str) -> str:
    return f"(select distinct unnest(regexp_extract_all({column}, '{_WORDS}')) as w from {source})"


# Known pieces as one map; a whole value that is known wins over them.
KNOWN = "known as (select map(list(original), list(masked)) as m from legacy)"
_PIECES = f"legacy as ({LEGACY_PIECES}), {KNOWN}"


def _piece(value: str) -> str:
    return f"coalesce(m[{value}], {std(value)})"


def _email_pieces(value: str) -> str:
    user, domain = (_piece(f"split_part({value}, '@', {i})") for i in (1, 2))
    return f"case when len(string_split({value}, '@')) = 2 then {user} || '@' || {domain} else {std(value)} end"


def _name_pieces(value: str) -> str:
    """Word by word, a known word by its entry."""
    words = f"regexp_extract_all({value}, '{_WORDS}|[^\\p{{L}}\\p{{N}}_]+')"
    return f"array_to_string(list_transform({words}, lambda w: coalesce(m[w], {std('w')})), '')"


_EMAIL_ENTRIES = (
    entry("email", _email_pieces("email"), 0, "(select distinct email, m from pii, known where email <> 'null')"),
    entry("u", std("u"), 1, _USER),
)
_DICTIONARY_ENTRIES = (
    *_EMAIL_ENTRIES,
    entry("full_name", name_words("full_name"), 10, "(select distinct full_name from pii)"),
    entry("w", std("w"), 11, _words_of("full_name", "pii")),
    entry("first_name", std("first_name"), 20, "(select distinct first_name from pii)"),
    entry("username", std("username"), 30, "(select distinct username from pii)"),
    entry("ip", std("ip"), 40,
          f"(select distinct {IP} as ip from pii where split_part({IP}, '.', 1) <> '10')"),
    entry("a", f"({age('a', PROJECT)})::varchar", 50,
          "(select distinct age::varchar as a from pii)", PROJECT + "/age"),
    entry("c", f"({double('c::double')})::varchar", 60,
          "(select distinct c_acctbal::varchar as c from pii)"),
    entry("k", f"({bigint('k::bigint')})::varchar", 1000,
          "(select distinct o_custkey::varchar as k from orders)"),
    entry("o_orderpriority", std("o_orderpriority"), 1010,
          "(select distinct o_orderpriority from orders)"),
)

_PIECE_ENTRIES = (
    *_EMAIL_ENTRIES,
    entry("full_name", _name_pieces("full_name"), 10, "(select distinct full_name, m from pii, known)"),
    entry("w", std("w"), 11, _words_of("full_name", "pii")),
    entry("first_name", std("first_name"), 20, "(select distinct first_name from pii)"),
)

_TEXT_ONLY = (
    "'Full Name', 'Physical Address', 'IP Address', 'IP Address - Ignore 10.', 'Credit Card',"
    " 'Custom Rule #1'"
)
_ALL_RULES = _TEXT_ONLY + ", 'Standard', 'Age', 'Email', 'Email - Retain Domain'"
_TABLE_ID = """regexp_replace(r."table", '[ -]', '_', 'g')"""
_KNOWN_TABLE = f"exists (select 1 from catalog c where c.table_norm = {_TABLE_ID})"
_KNOWN_ATTRIBUTE = (
    f"exists (select 1 from catalog c where c.table_norm = {_TABLE_ID}"
    ' and c."column" = r.attribute)'
)
_INVALID = f"""problems as (
        select 'UNKNOWN_TABLE' as code, r.* from rules r where not {_KNOWN_TABLE}
        union all select 'UNKNOWN_ATTRIBUTE', r.* from rules r
          where {_KNOWN_TABLE} and not {_KNOWN_ATTRIBUTE}
        union all select 'UNKNOWN_RULE', r.* from rules r where "rule" not in ({_ALL_RULES})
        union all select 'BAD_REF_INTEGRITY', r.* from rules r
          where coalesce(ref_integrity, '') not in ('Y', 'N')
        union all select 'UNSUPPORTED_TYPE', r.* from rules r
          join catalog c on c.table_norm = {_TABLE_ID} and c."column" = r.attribute
          where "rule" in ({_ALL_RULES}) and type <> 'string'
            and (type not in ('int', 'bigint', 'double') or "rule" in ({_TEXT_ONLY}))),
  invalid as (
        select code, "table", attribute, count(*) as n_rules, min(ordinal) as first_ordinal
        from problems group by all
        union all select 'DUPLICATE_RULE', "table", attribute, count(*), min(ordinal)
        from rules group by "table", attribute having count(*) > 1)"""


def _job_row(table: str, status: str, message: str = "null", rows: str = "null") -> str:
    source = f" from {table}" if status == "masked" else ""
    return (
        f"select '{table}' as \"table\", 'parquet' as format, '{status}' as status,"
        f" {rows}::bigint as n_rows, {message}::varchar as message{source}"
    )


def _long(name: str, key: str, **values: str) -> str:
    return " union all ".join(
        f"select '{name}' as \"table\", {key} as key, '{c}' as attribute, ({v})::varchar as value from {name}"
        for c, v in values.items()
    )


def _scientific(mantissa: str, exponent: str) -> str:
    """A masked double with an exponent, of text 1.25E-7: the part before the E is masked."""
    masked = std("x.m").replace(seed("x.m", PROJECT), seed("x.m || 'E' || x.e", PROJECT))
    return (
        f"list_transform([{{'m': {mantissa}, 'e': ({exponent})::varchar}}],"
        f" lambda x: ({masked} || 'E' || x.e)::double)[1]"
    )


def small(value: str) -> str:
    """DuckDB writes 1e-07 for 1.0E-7."""
    m, e = (f"split_part(({value})::varchar, 'e', {i})" for i in (1, 2))
    return _scientific(f"case when {m} like '%.%' then {m} else {m} || '.0' end", f"{e}::int")


def large(value: str) -> str:
    """A negative whole number beyond 10^7: -1.25E8."""
    digits = f"ltrim(({value})::bigint::varchar, '-')"
    fraction = f"coalesce(nullif(rtrim({digits}[2:], '0'), ''), '0')"
    return _scientific(f"'-' || {digits}[1] || '.' || {fraction}", f"length({digits}) - 1")


def _masks(name: str, attribute: str, rule: str, masked: str) -> str:
    return f"""select '{name}' as "table", '{attribute}' as attribute, '{rule}' as rule, count(*) as n_masks,
      count(*) filter (n > 1) as n_colliding from (select {masked} as m, count(*) as n
        from (select distinct {attribute} from {name} where {attribute} is not null) group by m)"""


# Columns of the given tables that can hold keys: integers, and texts.
_KEYS = {
    "number": "region.r_regionkey nation.n_nationkey nation.n_regionkey customer.c_custkey customer.c_nationkey supplier.s_suppkey"
    " supplier.s_nationkey part.p_partkey part.p_size orders.o_orderkey orders.o_custkey lineitem.l_orderkey lineitem.l_partkey"
    " lineitem.l_suppkey lineitem.l_linenumber events.event_id events.user_id documents.doc_id documents.n_chars embeddings.vec_id"
    " embeddings.label pages.page_id benchmark.item_id labels.doc_id labels.quality labels.toxic conversations.conv_id conversations.turn",
    "text": "region.r_name nation.n_name customer.c_name customer.c_mktsegment supplier.s_name part.p_name part.p_brand part.p_type"
    " orders.o_orderstatus orders.o_orderpriority lineitem.l_returnflag lineitem.l_linestatus events.event_type events.props"
    " documents.text documents.lang documents.source pages.url pages.html benchmark.text conversations.role conversations.text",
}
_REFERENCES = f"""vals as ({' union all '.join(
    f"select '{t}' as t, '{c}' as c, '{kind}' as kind, {c}::varchar as v, count(*) as n from {t} where {c} is not null group by {c}"
    for kind, names in _KEYS.items() for t, c in (name.split('.') for name in names.split()))}),
  sizes as (select t, c, kind, count(*) as n_distinct, max(n) as most from vals group by all),
  refs as (select a.t as child_table, a.c as child_column, p.t as parent_table, p.c as parent_column,
      any_value(a.n_distinct) as n_child, any_value(p.n_distinct) as n_parent
    from sizes a join sizes p on a.kind = p.kind and (a.t <> p.t or a.c <> p.c) and p.most = 1
      and a.n_distinct <= p.n_distinct and a.n_distinct >= 50
    join vals x on x.t = a.t and x.c = a.c left join vals y on y.t = p.t and y.c = p.c and y.v = x.v
    group by a.t, a.c, p.t, p.c having count(*) = count(y.v))"""


_JOB_MASKED = ("customer", "orders", "supplier", "conversations")

ORACLE: dict[str, str] = {
    "mask_standard_str": f"""select source_table, id, part, {standard('text')} as text from (
        select 'documents' as source_table, doc_id as id, 0::bigint as part, text from documents
        union all select 'conversations', conv_id, turn, text from conversations)""",
    "mask_standard_int": f"select o_orderkey, {bigint('o_custkey')} as o_custkey from orders",
    "mask_standard_double": f"""select l_orderkey, l_linenumber,
        {double('l_extendedprice')} as l_extendedprice from lineitem""",
    "mask_standard_decimal": f"""select l_orderkey, l_linenumber,
        ({std('l_extendedprice::decimal(12,2)::varchar')})::decimal(12,2)::varchar as price,
        '0' || substr({std("l_discount::decimal(3,2)::varchar")}, 2) as discount from lineitem""",
    "mask_age": pii_query(f"({age('age::varchar', RUN)})::int"),
    "mask_age_text": pii_query(f"({age('username', PROJECT)})::varchar"),
    "mask_email": pii_query(email("email")),
    "mask_email_keep_domain": pii_query(email_keep_domain("email")),
    "mask_full_name": pii_query(full_name("full_name")),
    "mask_address": pii_query(address("address")),
    "mask_ip": pii_query(standard(IP)),
    "mask_ip_ignore_10": pii_query(ip_ignore_10(IP)),
    "mask_credit_card": pii_query(card("card_no")),
    "mask_conditional": pii_query(full_name("full_name", f"coalesce({IP}, '') like '10.%'")),
    "mask_condition_rows": f"""with {PII} select c_custkey,
        {full_name('full_name', f"coalesce({IP}, '') like '10.%'")} as full_name,
        {keep('username', std('username'), 'not (age >= 40 and c_acctbal > 0)')} as username,
        {address('address')} as address from pii""",
    "rules_conditions": f"""with {CATALOG}, conditions as ({duck_view(EVENT_CONDITIONS)}),
        problems as (
          select 'BAD_CONDITION' as code, r.* from conditions r where ordinal % 7 in (2, 4, 5)
          union all select 'UNKNOWN_CONDITION_COLUMN', r.* from conditions r
            join (values (0, 'c_acctbal'), (1, 'nowhere'), (3, 'text')) n(k, name) on k = ordinal % 7
            where {_KNOWN_TABLE} and not exists (select 1 from catalog c
              where c.table_norm = {_TABLE_ID} and c."column" = n.name))
        select code, "table", attribute, count(*) as n_rules, min(ordinal) as first_ordinal from problems group by all""",
    "mask_null_passthrough": f"""with {PII} select c_custkey, {standard('email')} as email,
        {address('full_name')} as full_name,
        ({age('nullif(age, 18)::varchar', PROJECT)})::int as age from pii""",
    "mask_table_customer": f"""with {PII} select c_custkey, {standard('first_name')} as first_name,
        {full_name('full_name')} as full_name, {standard('username')} as username,
        {email('email')} as email, {ip_ignore_10(IP)} as {IP},
        ({age('age::varchar', RUN)})::int as age, {card('card_no')} as card_no,
        {address('address', RUN)} as address, {double('c_acctbal')} as c_acctbal from pii""",
    "mask_single_run": f"""with {PII} select c_custkey, {standard('username')} as lasting,
        {standard('username', RUN)} as single_run from pii""",
    "masked_join_orders_customer": f"""
        with c as (select {standard('c_name')} as c_name, c_mktsegment from customer),
        o as (select {standard("'Customer#' || lpad(o_custkey::varchar, 9, '0')")} as o_name,
          round(o_totalprice * 100)::bigint as cents from orders)
        select c_mktsegment, count(*) as n_orders, sum(cents)::bigint as total_cents
        from c join o on c_name = o_name group by c_mktsegment""",
    "mask_key_permuted": f"""with recursive {permuted(
        'select o_orderkey::varchar as v from orders union all select o_custkey::varchar from orders')}
        select a.masked::bigint as o_orderkey, b.masked::bigint as o_custkey from orders
        left join perm a on a.v = o_orderkey::varchar left join perm b on b.v = o_custkey::varchar""",
    "mask_key_text": f"""with recursive {permuted('select c_name as v from customer')},
        {permuted('select c_mktsegment as v from customer', RUN + '/key').replace('walk', 'walk2').replace('perm ', 'perm2 ')}
        select c_custkey, a.masked as c_name, b.masked as c_mktsegment from customer
        left join perm a on a.v = c_name left join perm2 b on b.v = c_mktsegment""",
    "mask_key_collisions": "select '' as attribute, '' as masked, 0::bigint as n_originals where false",
    "mask_key_join": """select c_mktsegment, count(*) as n_orders, sum(n)::bigint as n_lines from orders
        join customer on o_custkey = c_custkey
        join (select l_orderkey, count(*) as n from lineitem group by l_orderkey) on l_orderkey = o_orderkey
        group by c_mktsegment""",
    "rules_for_table": f"with {RULES} select * from rules where \"table\" = 'customer'",
    "rules_first_match": f"""with {RULES} select "table", attribute, ordinal, "rule", ref_integrity
        from rules qualify row_number() over (partition by "table", attribute order by ordinal) = 1""",
    "unruled_tables": f"""with {RULES}, {CATALOG} select distinct c."table" from catalog c
        where not exists (select 1 from rules r where {_TABLE_ID} = c.table_norm)""",
    "rules_unknown_table": f"with {RULES}, {CATALOG} select r.* from rules r where not {_KNOWN_TABLE}",
    "rules_unknown_attribute": f"""with {RULES}, {CATALOG} select r.* from rules r
        where {_KNOWN_TABLE} and not {_KNOWN_ATTRIBUTE}""",
    "rules_invalid": f"with {RULES}, {CATALOG}, {_INVALID} select * from invalid",
    "rules_conflicting": f"""with {RULES} select attribute,
        count(distinct ("rule", coalesce(ref_integrity, ''))) as n_treatments, count(*) as n_rules
        from rules group by attribute
        having count(distinct ("rule", coalesce(ref_integrity, ''))) > 1""",
    "dict_new_entries": f"with {PII}, {LEGACY}, {KNOWN} {entries(*_DICTIONARY_ENTRIES)}",
    "dict_email_users": f"with {PII}, {LEGACY}, {KNOWN} {entries(*_EMAIL_ENTRIES)}",
    "dict_name_parts": f"""with {PII}, {LEGACY} {entries(
        entry('full_name', name_words('full_name'), 0, '(select distinct full_name from pii)'),
        entry('w', std('w'), 1, _words_of('full_name', 'pii')),
        entry('text', name_words('text'), 1000, '(select distinct text from conversations)'),
        entry('w', std('w'), 1001, _words_of('text', 'conversations')))}""",
    "dict_first_wins": f"""select '{PROJECT}' as scope, l_partkey::varchar as original,
        arg_min(concat_ws('-', l_suppkey, l_orderkey, l_linenumber),
          l_orderkey * 100 + l_linenumber) as masked from lineitem group by l_partkey""",
    "dict_overlay": f"""with {PII}, {LEGACY} select c_custkey,
        coalesce(u.masked, {std('username')}) as username,
        case when email is null or email = 'null' then email
          when len(string_split(email, '@')) = 2
            then coalesce(e.masked, {std("split_part(email, '@', 1)")}) || '@' || split_part(email, '@', 2)
          else {std('email')} end as email,
        {double('c_acctbal')} as c_acctbal
        from pii left join legacy u on u.original = username
        left join legacy e on e.original = split_part(email, '@', 1)""",
    "dict_overlay_parts": f"""with {PII}, {_PIECES} select c_custkey,
        {keep('email', f"coalesce(m[email], {_email_pieces('email')})")} as email,
        {keep('full_name', f"coalesce(m[full_name], {_name_pieces('full_name')})")} as full_name,
        {keep('first_name', _piece('first_name'))} as first_name from pii, known""",
    "dict_new_parts": f"with {PII}, {_PIECES} {entries(*_PIECE_ENTRIES)}",
    "dict_load": LEGACY_DICTIONARY,
    "dict_many_runs": LEGACY_DICTIONARY,
    "dict_roundtrip": f"""with {PII}, legacy as (select ''::varchar as scope, ''::varchar as original, ''::varchar as masked),
        {KNOWN} {entries(
        *_EMAIL_ENTRIES,
        entry('username', std('username'), 10, '(select distinct username from pii)'))}""",
    "mask_collisions": f"""select masked, count(*) as n_originals from (
        select {bigint('k')} as masked from (select distinct o_custkey as k from orders))
        group by masked having count(*) > 1""",
    "mask_unchanged": f"""with {PII} {' union all '.join(
        f"select '{a}' as attribute, '{r}' as rule, count({c}) as n_values,"
        f" count(*) filter ({m} = {c}) as n_unchanged from pii"
        for a, r, c, m in (
            ('first_name', 'Standard', 'first_name', standard('first_name')),
            ('username', 'Standard', 'username', standard('username')),
            ('full_name', 'Full Name', 'full_name', full_name('full_name')),
            ('email', 'Email', 'email', email('email')),
            ('IP Address v4', 'IP Address - Ignore 10.', IP, ip_ignore_10(IP)),
            ('age', 'Age', 'age', age('age::varchar', RUN)),
            ('card_no', 'Credit Card', 'card_no', card('card_no')),
            ('address', 'Physical Address', 'address', address('address', RUN)),
            ('c_acctbal', 'Standard', 'c_acctbal', double('c_acctbal'))))}""",
    "mask_job_collisions": " union all ".join((
        _masks("customer", "c_custkey", "Standard", bigint("c_custkey")), _masks("customer", "c_name", "Standard", standard("c_name")),
        _masks("customer", "c_mktsegment", "Standard", standard("c_mktsegment")),
        _masks("orders", "o_custkey", "Standard", bigint("o_custkey")),
        _masks("orders", "o_orderkey", "Standard - Unique", "o_orderkey"),
        _masks("orders", "o_orderpriority", "Full Name", full_name("o_orderpriority")),
        _masks("events", "user_id", "Standard", bigint("user_id")), _masks("events", "event_type", "Standard", standard("event_type")),
    )),
    "mask_leaks": f"""with {PII},
        notes as (select *, case when c_custkey % 17 = 0 then coalesce('see ' || email || ', or (' || username || ').',
          'nothing to see') else 'nothing to see' end as note from pii),
        cells as (
          select 'customers' as "table", unnest([{{'a': 'username', 't': {standard('username')}}}, {{'a': 'email', 't': {email('email')}}},
            {{'a': 'full_name', 't': {full_name('full_name')}}}, {{'a': 'note', 't': note}}]) as c from notes
          union all select 'conversations', unnest([{{'a': 'role', 't': role}}, {{'a': 'text', 't': text}}]) from conversations),
        words as (select "table", c.a as attribute, unnest(list_distinct(list_concat([c.t],
          regexp_extract_all(c.t, '[\\p{{L}}\\p{{N}}](?:[\\p{{L}}\\p{{N}}@._-]*[\\p{{L}}\\p{{N}}])?')))) as original
          from cells where c.t is not null),
        originals as (select distinct unnest([username, email, full_name]) as o from pii)
        select "table", attribute, original, count(*) as n_values from words
        where length(original) >= 5 and original <> 'null' and original in (select o from originals where o is not null)
        group by all""",
    "references_found": f"with {_REFERENCES} select * from refs",
    "references_mismatched": f"""with {_REFERENCES}, {RULES},
        firsts as (select regexp_replace("table", '[ -]', '_', 'g') as t, attribute as a, arg_min("rule", ordinal) as "rule",
          arg_min({{'f': ref_integrity}}, ordinal).f as flag from rules group by 1, 2)
        select child_table, child_column, parent_table, parent_column, x."rule" as child_rule, x.flag as child_flag,
          y."rule" as parent_rule, y.flag as parent_flag from refs
        left join firsts x on x.t = child_table and x.a = child_column
        left join firsts y on y.t = parent_table and y.a = parent_column
        where x."rule" is distinct from y."rule" or x.flag is distinct from y.flag""",
    "catalog_normalized": f"""with {CATALOG}, names as (select "table" as n from catalog
        union select o_orderpriority from orders union select p_name from part
        union select url from pages)
        select regexp_replace(n, '[ -]', '_', 'g') as table_norm, count(*) as n_names,
        min(n) as first_name from names group by 1""",
    "mask_job": " union all ".join(
        [_job_row(t, "masked", rows="count(*)") for t in _JOB_MASKED]
        + [
            _job_row(t, "no_rules")
            for t in TABLES
            if t not in _JOB_MASKED and t != "events"
        ]
        + [
            _job_row("events", "invalid_rules", "'UNSUPPORTED_TYPE 1'"),
            "select 'warehouse', null, 'invalid_rules', null, 'UNKNOWN_TABLE 1'",
        ]
    ),
    "mask_job_output": " union all ".join((
        _long("customer", "c_custkey::varchar", c_name=standard("c_name"), c_nationkey="c_nationkey",
              c_acctbal=f"({std('c_acctbal::varchar', RUN)})::double", c_mktsegment="c_mktsegment"),
        _long("orders", "o_orderkey::varchar", o_custkey=bigint("o_custkey"), o_orderstatus="o_orderstatus",
              o_orderpriority="o_orderpriority"),
        _long("supplier", "s_suppkey::varchar", s_name=full_name("s_name"), s_nationkey="s_nationkey",
              s_acctbal=f"({age('s_acctbal::varchar', RUN)})::double"),
        _long("conversations", "conv_id || '/' || turn", role="role", text=standard("text")),
    )),
    "mask_job_layout": f"""select 'orders/' || o_orderstatus || '/' || strftime(o_orderdate, '%Y-%m') as directory,
        o_orderkey, {bigint('o_custkey')} as o_custkey, o_orderpriority from orders""",
    "mask_job_restart": " union all ".join(
        f"select '{t}' as \"table\", '{status}' as status, count(*) as n_rows, count(*) as n_noted from {t}"
        for t, status in (("customer", "unchanged"), ("conversations", "unchanged"), ("orders", "unchanged"),
                          ("supplier", "unchanged"), ("nation", "masked"))),
    "mask_job_csv": f"""with {PII}, {_PIECES} select c_custkey::varchar as c_custkey,
        {keep('email', f"coalesce(m[email], {_email_pieces('email')})")} as email,
        {keep('full_name', f"coalesce(m[full_name], {_name_pieces('full_name')})")} as full_name,
        {keep('first_name', _piece('first_name'))} as first_name, {_piece('username')} as username,
        ({age('age::varchar', PROJECT)})::varchar as age, {std('c_acctbal::varchar')} as c_acctbal from pii, known""",
    "mask_job_partitions": f"""select o_orderkey, {bigint('o_custkey')} as o_custkey,
        strftime(o_orderdate, '%Y') as year, '0' || strftime(o_orderdate, '%m') as month from orders""",
    "rules_from_file": f"""with {RULES} select "table", attribute, "rule", ref_integrity,
        cast(row_number() over (order by ordinal) - 1 as int) as ordinal from rules""",
    "dict_csv": f"with legacy as ({LEGACY_PIECES}) select scope, original, min(masked) as masked from legacy group by scope, original",
    "mask_registered_rule": pii_query(
        keep("full_name", "regexp_replace(full_name, '([A-Za-z])[A-Za-z]*', '\\1.', 'g')", "not (age > 30)")),
    "job_status": f"""with {RULES}, {CATALOG}, {_INVALID},
        m as (select regexp_replace("table", '[ -]', '_', 'g') as t, string_agg(code || ' ' || n, '; '
          order by code || ' ' || n) as message from (select "table", code, count(*) as n from invalid
          group by "table", code) group by 1),
        t as (select distinct "table" from catalog)
        select coalesce("table", m.t) as "table",
          case when m.t is not null then 'invalid_rules' when "table" in ('supplier', 'conversations')
            then 'masked' else 'no_rules' end as status,
          case "table" when 'supplier' then (select count(*) from supplier)
            when 'conversations' then (select count(*) from conversations) end as n_rows, message
        from t full join m on m.t = t."table" """,
    "mask_double_exponent": f"""select l_orderkey, l_linenumber,
        {small('l_extendedprice * 1e-10')} as small,
        {large('round(l_extendedprice * 100) * -1e6')} as large from lineitem""",
}
