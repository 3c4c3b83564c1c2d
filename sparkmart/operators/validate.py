"""Validate every row of a raw table and route it to clean or quarantine.

The work stays in one frame: an ``errors`` column grows from stage to stage
and the routes are two filters on it. No stage gathers the rows of a key in
one task. Row rules are map-only. References are left joins from the rows to
unique keys, whose large side adaptive execution can split. Rows checked so
far are written once. Duplicates are then found from their keys alone, and only
rows that can have a repeated key are moved.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmart import schemas as S
from sparkmart.operators.rules import MESSAGES, RULES, Check, Duplicates, Reference, RuleSet
from sparkmart.session import written

#: Repeated keys that are sent to every task as they are; slots of the filter for more of them.
SENT, SLOTS = 20_000, 1 << 18


def row_number() -> Column:
    return F.col(S.ROW_NUMBER)


def valid() -> Column:
    return F.size("errors") == 0


def error(label: str, code: str) -> Column:
    return F.struct(
        F.lit(label).alias("column"), F.lit(code).alias("code"), F.lit(MESSAGES[code]).alias("message")
    )


def first_error(label: str, checks: list[Check]) -> Column:
    """Error of the first check that holds; NULL when none does."""
    (code, condition), *rest = checks
    chain = F.when(condition, error(label, code))
    for code, condition in rest:
        chain = chain.when(condition, error(label, code))
    return chain


def collect_errors(candidates: list[Column]) -> Column:
    """Errors that occurred, in declared order."""
    return F.array_compact(F.array(*candidates))


def parse_rows(raw: DataFrame, rules: RuleSet) -> DataFrame:
    """Add trimmed text, exact number and typed value of every declared column."""
    texts = raw.select("*", *[f.text().alias(f"t_{f.name}") for f in rules.fields])
    numbers = texts.select(
        "*",
        *[n.alias(f"n_{f.name}") for f in rules.fields if (n := f.number()) is not None],
    )
    return numbers.select("*", *[f.value().alias(f"v_{f.name}") for f in rules.fields])


def check_rows(raw: DataFrame, table: str) -> DataFrame:
    """Raw columns, typed values and the errors found in the row itself."""
    rules = RULES[table]
    candidates = [first_error(r.name, r.checks()) for r in (*rules.fields, *rules.spans)]
    return parse_rows(raw, rules).select(
        S.ROW_NUMBER,
        *S.SOURCE_COLUMNS[table],
        *[f"v_{f.name}" for f in rules.fields],
        collect_errors(candidates).alias("errors"),
    )


def _spread(df: DataFrame, name: str, usable: Column) -> Column:
    """Join key of usable rows; other rows get scattered values.

    Without it the missing keys of all rejected rows would meet in one task.
    The join condition also tests ``usable``, so such a value never matches.
    """
    if dict(df.dtypes)[name] == "string":
        return F.when(usable, F.col(name)).otherwise(F.concat(F.lit("#"), row_number().cast("string")))
    return F.when(usable, F.col(name)).otherwise(-row_number())


def _lookup(df: DataFrame, reference: DataFrame, keys: dict[str, str], marker: str) -> DataFrame:
    """Left join to unique reference keys; valid rows with a match get ``marker``."""
    (lead_ref, lead), *others = keys.items()
    probe = f"{marker}_probe"
    df = df.withColumn(probe, _spread(df, lead, valid()))
    condition = (F.col(probe) == reference[lead_ref]) & valid()
    for ref_column, column in others:
        condition = condition & (F.col(column) == reference[ref_column])
    joined = df.join(reference.withColumn(marker, F.lit(True)), condition, "left")
    return joined.drop(probe, *[reference[c] for c in keys])


def check_references(
    df: DataFrame, references: tuple[Reference, ...], clean: dict[str, DataFrame]
) -> DataFrame:
    """Append an error for every missing key to rows without errors so far.

    References of one call are checked in one pass and may all be reported.
    """
    candidates = []
    for i, ref in enumerate(references):
        target = clean[ref.table].select(
            *[F.col(c).alias(f"_k{i}_{c}") for c in ref.keys],
            *[F.col(c).alias(f"r_{c}") for c in ref.carry],
        )
        keys = {f"_k{i}_{c}": column for c, column in ref.keys.items()}
        df = _lookup(df, target, keys, f"_found{i}")
        candidates.append(F.when(F.col(f"_found{i}").isNull(), error(ref.label, ref.code)))
    found = F.when(valid(), collect_errors(candidates)).otherwise(F.col("errors"))
    return df.withColumn("errors", found).drop(*[f"_found{i}" for i in range(len(references))])


def repeated_keys(df: DataFrame, rule: Duplicates) -> DataFrame:
    """Keys of more than one valid row (``_d_`` columns), the first row number and, if it counts, that row's signature.

    Only keys, row numbers and signatures are read and combined before they move.
    """
    first = [F.min(row_number()).alias("_first_row"), F.count("*").alias("_rows")]
    if rule.signature:
        first.append(F.min_by(_signature(rule), row_number()).alias("_first_signature"))
    keys = [F.col(f"v_{k}").alias(f"_d_v_{k}") for k in rule.keys]
    return df.filter(valid()).groupBy(*keys).agg(*first).filter(F.col("_rows") > 1)


def _signature(rule: Duplicates) -> Column:
    return F.struct(*[F.col(f"v_{c}").alias(c) for c in rule.signature])


def check_duplicates(df: DataFrame, rule: Duplicates) -> DataFrame:
    """Mark valid rows after the first valid row of their key.

    Equal signatures (NULLs equal) make an exact, others a conflicting duplicate.
    ``df`` should be a written table, as it is read more than once. Repeated keys
    are found first, from narrow columns. None leaves the rows as they are; up to
    SENT of them go to every task; of more, the hash slots they fall into go to
    every task, and only rows in such a slot are shuffled and joined.
    """
    repeated = written(repeated_keys(df, rule), "repeated")
    n = repeated.count()
    if not n:
        return df
    keys = {f"_d_v_{k}": f"v_{k}" for k in rule.keys}
    if n <= SENT:
        return _marked(df, F.broadcast(repeated), keys, rule)
    slots = repeated.select(_slot(list(keys)).alias("_slot")).distinct()  # SLOTS rows at most
    placed = df.withColumn("_at", F.when(valid(), _slot(list(keys.values()))))
    placed = placed.join(F.broadcast(slots.withColumn("_hit", F.lit(True))), F.col("_at") == F.col("_slot"), "left")
    alone = placed.filter(F.col("_hit").isNull()).select(*df.columns)
    suspects = placed.filter("_hit").select(*df.columns)
    return alone.unionByName(_marked(suspects, repeated, keys, rule))


def _slot(keys: list[str]) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(SLOTS))


def _marked(df: DataFrame, repeated: DataFrame, keys: dict[str, str], rule: Duplicates) -> DataFrame:
    # A number leads, so that rejected rows scatter on it.
    joined = _lookup(df, repeated, dict(reversed(keys.items())), "_repeated")
    exact = error(rule.label, "EXACT_DUPLICATE")
    if rule.signature:
        same = _signature(rule).eqNullSafe(F.col("_first_signature"))
        exact = F.when(same, exact).otherwise(error(rule.label, "CONFLICTING_DUPLICATE"))
    later = F.col("_repeated") & (row_number() > F.col("_first_row"))
    return joined.withColumn(
        "errors", F.when(later, F.array(exact)).otherwise(F.col("errors"))
    ).select(*df.columns)


def validate(raw: DataFrame, table: str, clean: dict[str, DataFrame]) -> DataFrame:
    """All stages: row rules, references, duplicates. One output row per raw row."""
    rules = RULES[table]
    df = check_rows(raw, table)
    for references in rules.references:
        df = check_references(df, references, clean)
    return check_duplicates(written(df, "checked"), rules.duplicates) if rules.duplicates else df


def route_clean(validated: DataFrame, table: str) -> DataFrame:
    """Typed rows without errors."""
    return validated.filter(valid()).select(
        *[F.col(f"v_{c}").alias(c) for c in S.SOURCE_COLUMNS[table]]
    )


def route_quarantine(validated: DataFrame, table: str) -> DataFrame:
    """Untouched raw text of rejected rows with their errors."""
    return validated.filter(~valid()).select(
        F.lit(S.SOURCE_FILES[table]).alias("source_file"),
        S.ROW_NUMBER,
        *S.SOURCE_COLUMNS[table],
        F.col("errors").alias("error_details"),
        F.current_timestamp().alias("detected_at"),
    )


def reconcile(raw: DataFrame, clean: DataFrame, quarantine: DataFrame, table: str) -> DataFrame:
    """Row counts of the three zones and whether they add up."""
    counts = None
    for zone, df in (("raw", raw), ("clean", clean), ("quarantine", quarantine)):
        part = df.agg(F.count("*").alias("n")).withColumn("zone", F.lit(zone))
        counts = part if counts is None else counts.unionByName(part)
    of = {z: F.sum(F.when(F.col("zone") == z, F.col("n"))) for z in ("raw", "clean", "quarantine")}
    return counts.agg(
        F.lit(table).alias("table_name"),
        of["raw"].alias("raw_count"),
        of["clean"].alias("clean_count"),
        of["quarantine"].alias("quarantine_count"),
        (of["raw"] == of["clean"] + of["quarantine"]).alias("is_reconciled"),
    )


def error_codes(validated: DataFrame) -> DataFrame:
    """Row number and codes of rejected rows, in order, as flat text."""
    return validated.filter(~valid()).select(
        S.ROW_NUMBER,
        F.array_join(F.transform("errors", lambda e: F.concat_ws(":", e["column"], e["code"])), ";").alias(
            "errors"
        ),
    )
