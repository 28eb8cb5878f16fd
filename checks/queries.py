"""One query per operator, each over whole tables."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.views import TABLES, event_conditions, event_rules, legacy_dictionary, legacy_pieces, pii_customer, spread_table, table
from maskwright.functions.generator import MaskContext
from maskwright.functions.rules import Rule, mask_where, quoted, register_rule
from maskwright.operators import audit, rulebook
from maskwright.operators import catalog as cat
from maskwright.operators import dictionary as dic
from maskwright.operators import references as ref
from maskwright.operators.masking import ColumnRule, mask, mask_column
from maskwright.plans.job import MaskingConfig, run_job, select_project
from maskwright.plans.manifest import manifest
from maskwright.sources.dictionary_store import (
    append_entries, compact_dictionary, export_csv, extend_dictionary, import_csv, load_dictionary, vacuum_dictionary,
)
from maskwright.sources.files import Dataset, csv_options, inventory, write_dataset, write_together
from maskwright.sources.local import local_frame

KEY = "correctness-check-key"
CONTEXT = MaskContext(KEY, project="checks", run_id="run-1")

UNIQUE = "Standard - Unique"

CUSTOMER_RULES = [
    ColumnRule("first_name", "Standard", "Y"),
    ColumnRule("username", "Standard", "Y"),
    ColumnRule("full_name", "Full Name", "Y"),
    ColumnRule("email", "Email", "Y"),
    ColumnRule("IP Address v4", "IP Address - Ignore 10.", "Y"),
    ColumnRule("age", "Age", "N"),
    ColumnRule("card_no", "Credit Card", "Y"),
    ColumnRule("address", "Physical Address", "N"),
    ColumnRule("c_acctbal", "Standard", "Y"),
]
DICTIONARY_RULES = [
    ColumnRule("email", "Email", "Y"),
    ColumnRule("full_name", "Full Name", "Y"),
    ColumnRule("first_name", "Standard", "Y"),
    ColumnRule("username", "Standard", "Y"),
    ColumnRule("IP Address v4", "IP Address - Ignore 10.", "Y"),
    ColumnRule("age", "Age", "Y"),
    ColumnRule("c_acctbal", "Standard", "Y"),
]


def shared_folder(spark: SparkSession) -> str:
    """A new folder every executor can reach, below ``spark.checkpoint.dir``.

    Only a local session may do without that setting; its folder goes with the process.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="maskwright-")
        atexit.register(shutil.rmtree, base, ignore_errors=True)
    return f"{base.rstrip('/')}/maskwright-{uuid.uuid4()}"


# -------------------------------------------------------------- masking rules


def mask_standard_str(spark: SparkSession, sf: str) -> DataFrame:
    documents = spread_table(spark, sf, "documents", "doc_id", "text").select(
        F.lit("documents").alias("source_table"), F.col("doc_id").alias("id"),
        F.lit(0).cast("long").alias("part"), "text",
    )
    turns = spread_table(spark, sf, "conversations", "conv_id", "turn", "text").select(
        F.lit("conversations").alias("source_table"), F.col("conv_id").alias("id"),
        F.col("turn").cast("long").alias("part"), "text",
    )
    return mask_column(documents.unionByName(turns), "text", "Standard", CONTEXT)


def mask_standard_int(spark: SparkSession, sf: str) -> DataFrame:
    orders = spread_table(spark, sf, "orders", "o_orderkey", "o_custkey")
    return mask_column(orders, "o_custkey", "Standard", CONTEXT)


def mask_standard_double(spark: SparkSession, sf: str) -> DataFrame:
    lines = spread_table(spark, sf, "lineitem", "l_orderkey", "l_linenumber", "l_extendedprice")
    return mask_column(lines, "l_extendedprice", "Standard", CONTEXT)


def mask_standard_decimal(spark: SparkSession, sf: str) -> DataFrame:
    columns = ("l_orderkey", "l_linenumber", "l_extendedprice", "l_discount")
    lines = spread_table(spark, sf, "lineitem", *columns).select(
        "l_orderkey", "l_linenumber",
        F.col("l_extendedprice").cast("decimal(12,2)").alias("price"),
        F.col("l_discount").cast("decimal(2,2)").alias("discount"),
    )
    result = mask(lines, [ColumnRule("price", "Standard"), ColumnRule("discount", "Standard")], CONTEXT)
    return result.select(
        "l_orderkey", "l_linenumber",
        F.col("price").cast("string").alias("price"),
        F.col("discount").cast("string").alias("discount"),
    )


def _pii_rule(column: str, name: str, flag: str = "Y") -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        result = mask_column(pii_customer(spark, sf), column, name, CONTEXT, flag)
        return result.select("c_custkey", quoted(column).alias("masked"))

    return query


def mask_condition_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Conditions that come with the rulebook, as rows of a table."""
    rules = rulebook.rulebook(spark, [
        ("customer", "full_name", "Full Name", "Y", "not (`IP Address v4` like '10.%')"),
        ("customer", "username", "Standard", "Y", "age >= 40 and c_acctbal > 0"),
        ("customer", "address", "Physical Address", "Y"),
    ])
    names = local_frame(spark, [("customer",)], "table_norm string")
    plan = rulebook.plan_rules(rules, names)["customer"]
    return mask(pii_customer(spark, sf), plan, CONTEXT).select("c_custkey", "full_name", "username", "address")


def rules_conditions(spark: SparkSession, sf: str) -> DataFrame:
    """Errors of a rulebook whose rules have conditions, good and bad ones."""
    return rulebook.invalid_rules(event_conditions(spark, sf), cat.catalog(spark, sf)).where(
        F.col("code").isin("BAD_CONDITION", "UNKNOWN_CONDITION_COLUMN"))


def mask_null_passthrough(spark: SparkSession, sf: str) -> DataFrame:
    some = pii_customer(spark, sf).withColumn("age", F.nullif("age", F.lit(18)))
    rules = [
        ColumnRule("email", "Standard"),
        ColumnRule("full_name", "Physical Address"),
        ColumnRule("age", "Age"),
    ]
    return mask(some.select("c_custkey", "email", "full_name", "age"), rules, CONTEXT)


def mask_table_customer(spark: SparkSession, sf: str) -> DataFrame:
    return mask(pii_customer(spark, sf), CUSTOMER_RULES, CONTEXT)


def mask_single_run(spark: SparkSession, sf: str) -> DataFrame:
    names = pii_customer(spark, sf).select(
        "c_custkey", F.col("username").alias("lasting"), F.col("username").alias("single_run")
    )
    rules = [ColumnRule("lasting", "Standard", "Y"), ColumnRule("single_run", "Standard", "N")]
    return mask(names, rules, CONTEXT)


def masked_join_orders_customer(spark: SparkSession, sf: str) -> DataFrame:
    """Join of a masked parent with its masked child on the masked key."""
    customer = table(spark, sf, "customer").select("c_name", "c_mktsegment").where("c_name is not null")
    customer = mask_column(customer, "c_name", "Standard", CONTEXT)
    name = F.concat(F.lit("Customer#"), F.lpad(F.col("o_custkey").cast("string"), 9, "0"))
    cents = F.round(F.col("o_totalprice") * 100).cast("long")
    # Pre-aggregated on the key before anything is masked or joined.
    spent = (
        table(spark, sf, "orders")
        .where("o_custkey is not null")
        .groupBy(name.alias("o_name"))
        .agg(F.count("*").alias("n"), F.sum(cents).alias("cents"))
    )
    spent = mask_column(spent, "o_name", "Standard", CONTEXT)
    # No masked key is null, and saying so spares masking once more for a null filter.
    return (
        customer.withColumn("key", F.coalesce("c_name", F.lit("")))
        .join(spent.withColumn("key", F.coalesce("o_name", F.lit(""))), "key")
        .groupBy("c_mktsegment")
        .agg(F.sum("n").alias("n_orders"), F.sum("cents").alias("total_cents"))
    )


def mask_key_permuted(spark: SparkSession, sf: str) -> DataFrame:
    orders = spread_table(spark, sf, "orders", "o_orderkey", "o_custkey")
    return mask(orders, [ColumnRule("o_orderkey", UNIQUE), ColumnRule("o_custkey", UNIQUE)], CONTEXT)


def mask_key_text(spark: SparkSession, sf: str) -> DataFrame:
    names = spread_table(spark, sf, "customer", "c_custkey", "c_name", "c_mktsegment")
    return mask(names, [ColumnRule("c_name", UNIQUE), ColumnRule("c_mktsegment", UNIQUE, "N")], CONTEXT)


def mask_key_collisions(spark: SparkSession, sf: str) -> DataFrame:
    """Masks of several originals: none, in three key columns."""
    found = [
        audit.collisions(table(spark, sf, name), column, UNIQUE, CONTEXT).select(
            F.lit(column).alias("attribute"), F.col("masked").cast("string").alias("masked"), "n_originals")
        for name, column in (("orders", "o_orderkey"), ("orders", "o_custkey"), ("customer", "c_name"))
    ]
    return reduce(DataFrame.unionByName, found)


def mask_key_join(spark: SparkSession, sf: str) -> DataFrame:
    """Joins on masked keys, of three tables, count what joins on the keys count."""
    customer = table(spark, sf, "customer").select("c_custkey", "c_mktsegment").where("c_custkey is not null")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    lines = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("n"))
    customer = mask_column(customer, "c_custkey", UNIQUE, CONTEXT)
    orders = mask(orders, [ColumnRule("o_orderkey", UNIQUE), ColumnRule("o_custkey", UNIQUE)], CONTEXT)
    lines = mask_column(lines, "l_orderkey", UNIQUE, CONTEXT)
    joined = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
    return joined.groupBy("c_mktsegment").agg(F.count("*").alias("n_orders"), F.sum("n").alias("n_lines"))


# ------------------------------------------------------------------ rulebooks


def rules_for_table(spark: SparkSession, sf: str) -> DataFrame:
    return rulebook.rules_for_table(event_rules(spark, sf), "customer")


def rules_first_match(spark: SparkSession, sf: str) -> DataFrame:
    return rulebook.first_match(event_rules(spark, sf))


def unruled_tables(spark: SparkSession, sf: str) -> DataFrame:
    return rulebook.unruled_tables(inventory(spark, sf), event_rules(spark, sf))


def rules_unknown_table(spark: SparkSession, sf: str) -> DataFrame:
    return rulebook.unknown_tables(event_rules(spark, sf), cat.catalog(spark, sf))


def rules_unknown_attribute(spark: SparkSession, sf: str) -> DataFrame:
    return rulebook.unknown_attributes(event_rules(spark, sf), cat.catalog(spark, sf))


def rules_invalid(spark: SparkSession, sf: str) -> DataFrame:
    return rulebook.invalid_rules(event_rules(spark, sf), cat.catalog(spark, sf))


def rules_conflicting(spark: SparkSession, sf: str) -> DataFrame:
    return rulebook.conflicting_rules(event_rules(spark, sf))


# --------------------------------------------------------------- dictionaries


def dict_new_entries(spark: SparkSession, sf: str) -> DataFrame:
    customers = pii_customer(spark, sf)
    orders = table(spark, sf, "orders")
    return dic.new_entries(
        [
            (customers, DICTIONARY_RULES),
            (orders, [ColumnRule("o_custkey", "Standard"), ColumnRule("o_orderpriority", "Standard")]),
        ],
        CONTEXT,
        legacy_dictionary(spark, sf),
    )


def dict_email_users(spark: SparkSession, sf: str) -> DataFrame:
    emails = pii_customer(spark, sf).select("email")
    return dic.new_entries(
        [(emails, [ColumnRule("email", "Email")])], CONTEXT, legacy_dictionary(spark, sf)
    )


def dict_name_parts(spark: SparkSession, sf: str) -> DataFrame:
    names = pii_customer(spark, sf).select("full_name")
    turns = table(spark, sf, "conversations").select("text")
    return dic.new_entries(
        [(names, [ColumnRule("full_name", "Full Name")]), (turns, [ColumnRule("text", "Full Name")])],
        CONTEXT,
        legacy_dictionary(spark, sf),
    )


def dict_first_wins(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem")
    candidates = lines.select(
        F.lit(CONTEXT.scope()).alias("scope"),
        F.col("l_partkey").cast("string").alias("original"),
        F.concat_ws("-", "l_suppkey", "l_orderkey", "l_linenumber").alias("masked"),
        (F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("ord"),
    )
    return dic.first_wins(candidates)


def dict_overlay(spark: SparkSession, sf: str) -> DataFrame:
    rules = [
        ColumnRule("username", "Standard"),
        ColumnRule("email", "Email - Retain Domain"),
        ColumnRule("c_acctbal", "Standard"),
    ]
    customers = pii_customer(spark, sf).select("c_custkey", "username", "email", "c_acctbal")
    return dic.apply_dictionary(customers, rules, legacy_dictionary(spark, sf), CONTEXT)


PIECE_RULES = [ColumnRule("email", "Email"), ColumnRule("full_name", "Full Name"), ColumnRule("first_name", "Standard")]


def dict_overlay_parts(spark: SparkSession, sf: str) -> DataFrame:
    """Users, domains and words that the dictionary knows, inside longer values."""
    customers = pii_customer(spark, sf).select("c_custkey", "email", "full_name", "first_name")
    return dic.apply_dictionary(customers, PIECE_RULES, legacy_pieces(spark, sf), CONTEXT)


def dict_new_parts(spark: SparkSession, sf: str) -> DataFrame:
    """New entries of addresses and names of which the dictionary knows pieces."""
    customers = pii_customer(spark, sf).select("email", "full_name", "first_name")
    return dic.new_entries([(customers, PIECE_RULES)], CONTEXT, legacy_pieces(spark, sf))


def dict_load(spark: SparkSession, sf: str) -> DataFrame:
    base = shared_folder(spark) + "/dictionary"
    missing = load_dictionary(spark, base)
    append_entries(legacy_dictionary(spark, sf), base)
    return load_dictionary(spark, base).unionByName(missing)


def dict_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Two runs: the second one stores only what the first one did not."""
    base = shared_folder(spark) + "/dictionary"
    emails = (pii_customer(spark, sf).select("email"), [ColumnRule("email", "Email")])
    names = (pii_customer(spark, sf).select("username"), [ColumnRule("username", "Standard")])
    for tables in ([emails], [emails, names]):
        extend_dictionary(spark, base, lambda known, tables=tables: dic.new_entries(tables, CONTEXT, known, makers_too=True))
    return load_dictionary(spark, base)


# --------------------------------------------------------------------- audits


def dict_many_runs(spark: SparkSession, sf: str) -> DataFrame:
    """A dictionary that grew over many runs, merged on the way."""
    base = shared_folder(spark) + "/dictionary"
    entries = legacy_dictionary(spark, sf)
    for part in range(12):
        append_entries(entries.where(F.pmod(F.substring("original", 5, 20).cast("int"), F.lit(12)) == part), base)
        compact_dictionary(spark, base)
    vacuum_dictionary(spark, base)
    return load_dictionary(spark, base)


def mask_collisions(spark: SparkSession, sf: str) -> DataFrame:
    return audit.collisions(table(spark, sf, "orders"), "o_custkey", "Standard", CONTEXT)


def mask_unchanged(spark: SparkSession, sf: str) -> DataFrame:
    return audit.unchanged(pii_customer(spark, sf), CUSTOMER_RULES, CONTEXT)


AUDITED = {
    "customer": [ColumnRule("c_custkey", "Standard"), ColumnRule("c_name", "Standard"), ColumnRule("c_mktsegment", "Standard")],
    "orders": [ColumnRule("o_custkey", "Standard"), ColumnRule("o_orderkey", UNIQUE), ColumnRule("o_orderpriority", "Full Name")],
    "events": [ColumnRule("user_id", "Standard"), ColumnRule("event_type", "Standard")],
}


def mask_job_collisions(spark: SparkSession, sf: str) -> DataFrame:
    """Masks of several originals, counted for all ruled columns at once."""
    return audit.job_collisions([(name, table(spark, sf, name), rules) for name, rules in AUDITED.items()], CONTEXT)


def mask_leaks(spark: SparkSession, sf: str) -> DataFrame:
    """Originals that stand in the masked copy: in a note that no rule speaks of, and by chance."""
    customers = pii_customer(spark, sf).select("c_custkey", "username", "email", "full_name")
    note = F.when(F.col("c_custkey") % 17 == 0, F.concat(F.lit("see "), "email", F.lit(", or ("), "username", F.lit(").")))
    customers = customers.withColumn("note", F.coalesce(note, F.lit("nothing to see")))
    rules = [ColumnRule("username", "Standard"), ColumnRule("email", "Email"), ColumnRule("full_name", "Full Name")]
    written = {"customers": mask(customers, rules, CONTEXT), "conversations": table(spark, sf, "conversations")}
    return audit.leaks([(customers, rules)], written)


def _all_tables(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return {name: table(spark, sf, name) for name in TABLES}


def references_found(spark: SparkSession, sf: str) -> DataFrame:
    """Columns of any table that refer to a key of any table."""
    return ref.references(spark, _all_tables(spark, sf))


def references_mismatched(spark: SparkSession, sf: str) -> DataFrame:
    """References whose columns the rulebook of events does not treat alike."""
    return ref.mismatched(ref.references(spark, _all_tables(spark, sf)), event_rules(spark, sf))


# -------------------------------------------------------------------- catalog


def catalog_normalized(spark: SparkSession, sf: str) -> DataFrame:
    """Names from the catalog and, for want of odd ones there, from the data."""
    tables = cat.catalog(spark, sf).select("table")
    priorities = table(spark, sf, "orders").select(F.col("o_orderpriority").alias("table"))
    parts = table(spark, sf, "part").select(F.col("p_name").alias("table"))
    urls = table(spark, sf, "pages").select(F.col("url").alias("table"))
    return cat.name_clashes(tables.union(priorities).union(parts).union(urls))


# ------------------------------------------------------------------------ job

JOB_RULES = [
    ("customer", "c_name", "Standard", "Y"),
    ("customer", "c_acctbal", "Standard", "N"),
    ("orders", "o_custkey", "Standard", "Y"),
    ("supplier", "s_name", "Full Name", "Y"),
    ("supplier", "s_acctbal", "Age", "N"),
    ("conversations", "text", "Standard", "Y"),
    ("events", "ts", "Standard", "Y"),
    ("warehouse", "w_name", "Standard", "Y"),
]


def _job(spark: SparkSession, sf: str, dictionary: bool) -> tuple[DataFrame, str]:
    folder = shared_folder(spark)
    config = MaskingConfig(
        project="checks", key=KEY, input=sf, output=f"{folder}/masked", run_id="run-1",
        dictionary=f"{folder}/dictionary" if dictionary else None,
    )
    return run_job(spark, config, rulebook.rulebook(spark, JOB_RULES)), config.output


def mask_job(spark: SparkSession, sf: str) -> DataFrame:
    summary, _ = _job(spark, sf, dictionary=True)
    return summary.select("table", "format", "status", "n_rows", "message")


def _long(df: DataFrame, name: str, keys: tuple[str, ...], columns: tuple[str, ...]) -> DataFrame:
    """A table as rows (table, key, attribute, value), all text."""
    values = F.map_from_arrays(
        F.array(*[F.lit(c) for c in columns]), F.array(*[F.col(c).cast("string") for c in columns])
    )
    return df.select(F.lit(name).alias("table"), F.concat_ws("/", *keys).alias("key"), F.explode(values).alias("attribute", "value"))


WRITTEN = {
    "customer": (("c_custkey",), ("c_name", "c_nationkey", "c_acctbal", "c_mktsegment")),
    "orders": (("o_orderkey",), ("o_custkey", "o_orderstatus", "o_orderpriority")),
    "supplier": (("s_suppkey",), ("s_name", "s_nationkey", "s_acctbal")),
    "conversations": (("conv_id", "turn"), ("role", "text")),
}


def mask_job_output(spark: SparkSession, sf: str) -> DataFrame:
    """What the job wrote, for all its tables."""
    _, output = _job(spark, sf, dictionary=False)
    parts = [
        _long(spark.read.parquet(f"{output}/{name}.parquet"), name, *shape) for name, shape in WRITTEN.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def _leaf_directories(spark: SparkSession, sf: str, root: str) -> None:
    """Orders in directories of status and month, without ``key=value`` names."""
    orders = table(spark, sf, "orders")
    place = F.concat_ws("/", F.lit("orders"), "o_orderstatus", F.date_format("o_orderdate", "yyyy-MM"))
    places = [r[0] for r in orders.select(place.alias("p")).distinct().orderBy("p").collect()]
    numbers = local_frame(spark, [(p, i) for i, p in enumerate(places)], "__place string, __number int")
    placed = orders.withColumn("__place", place).join(F.broadcast(numbers), "__place").drop("__place")
    found = [Dataset("orders", p, "parquet", "flat") for p in places]
    write_together(placed.repartition("__number"), root, found, "__number")


def mask_job_layout(spark: SparkSession, sf: str) -> DataFrame:
    """A table of many directories: every row of the masked copy with its directory."""
    folder = shared_folder(spark)
    _leaf_directories(spark, sf, f"{folder}/input")
    config = MaskingConfig(project="checks", key=KEY, input=f"{folder}/input", output=f"{folder}/masked")
    run_job(spark, config, rulebook.rulebook(spark, [("orders", "o_custkey", "Standard", "Y")]))
    written = spark.read.option("recursiveFileLookup", True).parquet(config.output)
    place = F.regexp_extract("_metadata.file_path", "/masked/(.*)/[^/]*$", 1)
    return written.select(place.alias("directory"), "o_orderkey", "o_custkey", "o_orderpriority")


def mask_job_restart(spark: SparkSession, sf: str) -> DataFrame:
    """A run that has done half of the tables, and one that goes on from there."""
    config = MaskingConfig(project="checks", key=KEY, input=sf, output=f"{shared_folder(spark)}/masked", resume=True)
    lasting = [r for r in JOB_RULES if r[0] in ("customer", "orders", "supplier", "conversations") and r[3] == "Y"]
    run_job(spark, config, rulebook.rulebook(spark, [r for r in lasting if r[0] < "o"]))
    run_job(spark, config, rulebook.rulebook(spark, lasting))
    summary = run_job(spark, config, rulebook.rulebook(spark, [*lasting, ("nation", "n_name", "Standard", "Y")]))
    written = manifest(spark, config.output).select(F.regexp_replace("target", "[.]parquet$", "").alias("table"), F.col("n_rows").alias("n_noted"))
    return summary.where("status in ('masked', 'unchanged')").select("table", "status", "n_rows").join(written, "table")


CSV_RULES = [
    ("customers", "email", "Email", "Y"), ("customers", "full_name", "Full Name", "Y"), ("customers", "first_name", "Standard", "Y"),
    ("customers", "username", "Standard", "Y"), ("customers", "age", "Age", "Y"), ("customers", "c_acctbal", "Standard", "Y"),
]


def mask_job_csv(spark: SparkSession, sf: str) -> DataFrame:
    """From CSV to CSV with a rulebook and a dictionary kept as CSV, for one project of two."""
    folder = shared_folder(spark)
    customers = pii_customer(spark, sf).select("c_custkey", *[r[1] for r in CSV_RULES])
    write_dataset(customers, f"{folder}/input", Dataset("customers", "customers", "csv", "flat"))
    names = ("Table", "Attribute", "Masking Rule", "Ref Integrity")
    spark.createDataFrame(CSV_RULES, names).coalesce(1).write.csv(f"{folder}/rules.csv", header=True)
    export_csv(legacy_pieces(spark, sf), f"{folder}/legacy.csv")
    config = MaskingConfig(
        project="checks", key=KEY, input=f"{folder}/input", output=f"{folder}/masked", rulebook=f"{folder}/rules.csv",
        dictionary=f"{folder}/dictionary", dictionary_csv=f"{folder}/legacy.csv",
    )
    other = replace(config, project="other", output=f"{folder}/other")
    run_job(spark, select_project({"checks": config, "other": other}, "checks"))
    return spark.read.options(**csv_options()).csv(f"{config.output}/customers")


def mask_job_partitions(spark: SparkSession, sf: str) -> DataFrame:
    """A table of ``key=value`` directories of several files each; partition values stay text."""
    folder = shared_folder(spark)
    orders = table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", F.date_format("o_orderdate", "yyyy").alias("year"),
        F.lpad(F.date_format("o_orderdate", "MM"), 3, "0").alias("month"))
    orders.repartition(3).write.partitionBy("year", "month").parquet(f"{folder}/input/orders")
    config = MaskingConfig(project="checks", key=KEY, input=f"{folder}/input", output=f"{folder}/masked")
    run_job(spark, config, rulebook.rulebook(spark, [("orders", "o_custkey", "Standard", "Y")]))
    schema = "o_orderkey long, o_custkey long, year string, month string"
    return spark.read.schema(schema).parquet(f"{config.output}/orders")


def rules_from_file(spark: SparkSession, sf: str) -> DataFrame:
    """A rulebook written as CSV and read back, in the order of the file."""
    path = f"{shared_folder(spark)}/rules.csv"
    rules = event_rules(spark, sf).orderBy("ordinal").select(
        F.col("table").alias("Table"), F.col("attribute").alias("Attribute"), F.col("rule").alias("Masking Rule"),
        F.col("ref_integrity").alias("Ref Integrity"))
    rules.coalesce(1).write.csv(path, header=True, escape='"')
    return rulebook.read_rulebook(spark, path)


def dict_csv(spark: SparkSession, sf: str) -> DataFrame:
    """A dictionary written as CSV and taken over from there."""
    path = f"{shared_folder(spark)}/dictionary.csv"
    export_csv(legacy_pieces(spark, sf), path)
    return import_csv(spark, path, CONTEXT.scope())


def mask_registered_rule(spark: SparkSession, sf: str) -> DataFrame:
    """A rule that a user adds: initials of names, for people above 30."""
    initials = Rule("Initials", lambda cell: F.regexp_replace(cell.text, "([A-Za-z])[A-Za-z]*", "$1."), text_only=True)
    register_rule(mask_where("Initials", initials, lambda: F.col("age") > 30, requires=("age",)))
    result = mask_column(pii_customer(spark, sf), "full_name", "Initials", CONTEXT)
    return result.select("c_custkey", F.col("full_name").alias("masked"))


def job_status(spark: SparkSession, sf: str) -> DataFrame:
    """A rulebook with every kind of error beside good tables: only the faulty ones stay out."""
    good = rulebook.rulebook(spark, [r for r in JOB_RULES if r[0] in ("supplier", "conversations")])
    config = MaskingConfig(project="checks", key=KEY, input=sf, output=f"{shared_folder(spark)}/masked")
    summary = run_job(spark, config, event_rules(spark, sf).unionByName(good))
    return summary.select("table", "status", "n_rows", "message")


def mask_double_exponent(spark: SparkSession, sf: str) -> DataFrame:
    """Very small and very large doubles keep their exponent; their digits are replaced."""
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", (F.col("l_extendedprice") * F.lit(1e-10)).alias("small"),
        (F.round(F.col("l_extendedprice") * 100) * F.lit(-1e6)).alias("large"),
    )
    return mask(lines, [ColumnRule("small", "Standard"), ColumnRule("large", "Standard")], CONTEXT)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "mask_standard_str": mask_standard_str,
    "mask_standard_int": mask_standard_int,
    "mask_standard_double": mask_standard_double,
    "mask_standard_decimal": mask_standard_decimal,
    "mask_age": _pii_rule("age", "Age", "N"),
    "mask_age_text": _pii_rule("username", "Age"),
    "mask_email": _pii_rule("email", "Email"),
    "mask_email_keep_domain": _pii_rule("email", "Email - Retain Domain"),
    "mask_full_name": _pii_rule("full_name", "Full Name"),
    "mask_address": _pii_rule("address", "Physical Address"),
    "mask_ip": _pii_rule("IP Address v4", "IP Address"),
    "mask_ip_ignore_10": _pii_rule("IP Address v4", "IP Address - Ignore 10."),
    "mask_credit_card": _pii_rule("card_no", "Credit Card"),
    "mask_conditional": _pii_rule("full_name", "Custom Rule #1"),
    "mask_condition_rows": mask_condition_rows,
    "rules_conditions": rules_conditions,
    "mask_null_passthrough": mask_null_passthrough,
    "mask_table_customer": mask_table_customer,
    "mask_single_run": mask_single_run,
    "masked_join_orders_customer": masked_join_orders_customer,
    "mask_key_permuted": mask_key_permuted,
    "mask_key_text": mask_key_text,
    "mask_key_collisions": mask_key_collisions,
    "mask_key_join": mask_key_join,
    "rules_for_table": rules_for_table,
    "rules_first_match": rules_first_match,
    "unruled_tables": unruled_tables,
    "rules_unknown_table": rules_unknown_table,
    "rules_unknown_attribute": rules_unknown_attribute,
    "rules_invalid": rules_invalid,
    "rules_conflicting": rules_conflicting,
    "dict_new_entries": dict_new_entries,
    "dict_email_users": dict_email_users,
    "dict_name_parts": dict_name_parts,
    "dict_first_wins": dict_first_wins,
    "dict_overlay": dict_overlay,
    "dict_overlay_parts": dict_overlay_parts,
    "dict_new_parts": dict_new_parts,
    "dict_load": dict_load,
    "dict_roundtrip": dict_roundtrip,
    "dict_many_runs": dict_many_runs,
    "mask_collisions": mask_collisions,
    "mask_unchanged": mask_unchanged,
    "mask_job_collisions": mask_job_collisions,
    "mask_leaks": mask_leaks,
    "references_found": references_found,
    "references_mismatched": references_mismatched,
    "catalog_normalized": catalog_normalized,
    "mask_job": mask_job,
    "mask_job_output": mask_job_output,
    "mask_job_layout": mask_job_layout,
    "mask_job_restart": mask_job_restart,
    "mask_job_csv": mask_job_csv,
    "mask_job_partitions": mask_job_partitions,
    "rules_from_file": rules_from_file,
    "dict_csv": dict_csv,
    "mask_registered_rule": mask_registered_rule,
    "job_status": job_status,
    "mask_double_exponent": mask_double_exponent,
}
