"""Cleaning in a fixed rule order, with the rows each rule removes kept and counted.

Order: null removal, keep-first by the uncleaned key, validity, text cleaning, filling, whole numbers.
Duplicates are removed before validity is looked at, so a key whose first row is invalid is gone.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankweave.functions.numeric import all_of, finite, is_text, once, parsed_number, whole_number
from rankweave.functions.text import clean_text, digest, fill_empty
from rankweave.operators.dedup import keep_first, mark_first, within
from rankweave.schemas import BEST_RANK, CLEAN, DISLIKE, METRICS


@dataclass(frozen=True)
class CleanRules:
    """What to check and change, by column name.

    order_by    identifies a row and says which of several duplicates is the first
    required    text columns that must not be null ('' is allowed)
    positive    numbers that must be present and above zero
    not_above   numbers that must be present and at most the given bound; dropped afterwards
    keys        columns that together make a duplicate, compared before cleaning
    text        columns to clean
    fill        target column to the cleaned column that replaces it when empty
    whole       numbers written as bigint in the result
    output      columns of the result, in order
    long_keys   compare keys by digest, for keys of document size
    """

    order_by: list[str]
    keys: list[str]
    output: list[str]
    required: list[str] = field(default_factory=list)
    positive: list[str] = field(default_factory=list)
    not_above: dict[str, float] = field(default_factory=dict)
    text: list[str] = field(default_factory=list)
    fill: dict[str, str] = field(default_factory=dict)
    whole: list[str] = field(default_factory=list)
    long_keys: bool = False

    def __post_init__(self) -> None:
        if clash := set(self.whole) & {*self.order_by, *self.keys}:
            raise ValueError(f"whole numbers change their value and cannot order or identify rows: {sorted(clash)}")


VIDEO_RULES = CleanRules(
    order_by=["file_name", "pos"],
    keys=["up", "title"],
    required=["up", "title", "tname"],
    positive=[*METRICS, BEST_RANK],
    not_above={DISLIKE: 0.0},
    text=["period", "up", "title", "tname", "desc", "rcmd_reason"],
    fill={"desc": "title", "rcmd_reason": "title"},
    whole=[*METRICS, BEST_RANK],
    output=CLEAN.fieldNames(),
)
# Records read from files: names may repeat in other folders, and then the path decides.
FILE_RULES = replace(VIDEO_RULES, order_by=["file_name", "file_path", "pos"])


def rules_for(df: DataFrame) -> CleanRules:
    """The rules for records or documents, with the path where they have one."""
    return FILE_RULES if "file_path" in df.columns else VIDEO_RULES


def drop_null(df: DataFrame, required: list[str]) -> DataFrame:
    """Rows in which none of these columns is null."""
    return df.where(all_of([F.col(name).isNotNull() for name in required]))


NULL_FIELD = "null_field"
DUPLICATE = "duplicate"
INVALID = "invalid"


def _parsed(df: DataFrame, rules: CleanRules) -> tuple[DataFrame, dict[str, Column], dict[str, Column]]:
    """The table, the double value of each checked number, and the bigint of each whole one.

    Number texts are parsed once per row; columns that are numbers already are used as they are.
    """
    checked = dict.fromkeys([*rules.positive, *rules.not_above, *rules.whole])
    texts = [name for name in checked if is_text(df, name)]
    numbers = {name: F.col(f"_numbers.{name}" if name in texts else name) for name in checked}
    whole = {
        name: whole_number(F.col(name), numbers[name]) if name in texts else F.col(name).try_cast("bigint")
        for name in rules.whole
    }
    if texts:
        values = F.struct(*[parsed_number(F.col(name)).alias(name) for name in texts])
        df = df.select("*", once(values).alias("_numbers"))
    return df, numbers, whole


def _complete(rules: CleanRules, numbers: dict[str, Column]) -> Column:
    """No required column is null and every checked number is one."""
    checked = [numbers[name] for name in (*rules.positive, *rules.not_above)]
    return all_of([F.col(name).isNotNull() for name in rules.required] + [finite(value) for value in checked])


def _valid(rules: CleanRules, numbers: dict[str, Column], whole: dict[str, Column]) -> Column:
    """Every number is inside its bound, and whole numbers fit a bigint."""
    checks = [numbers[name] > 0 for name in rules.positive]
    checks += [numbers[name] <= bound for name, bound in rules.not_above.items()]
    return all_of(checks + [value.isNotNull() for value in whole.values()])


def valid_rows(df: DataFrame, rules: CleanRules = VIDEO_RULES) -> DataFrame:
    """Rows that pass the number checks, as they are; the bounds are pushed to the scan."""
    parsed, numbers, whole = _parsed(df, rules)
    checked = [finite(numbers[name]) for name in (*rules.positive, *rules.not_above)]
    return parsed.where(all_of([*checked, _valid(rules, numbers, whole)])).select(*df.columns)


def _flag(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def _dedup_keys(rules: CleanRules) -> list[str]:
    return ["_key"] if rules.long_keys else rules.keys


def stage(df: DataFrame, rules: CleanRules, also: list[str] | None = None) -> DataFrame:
    """Row-wise checks as flags `_complete` and `_valid`, numbers already whole, text untouched, and columns `also`.

    Done before the one shuffle, so that it moves bigints and two flags instead of number texts.
    """
    parsed, numbers, whole = _parsed(df, rules)
    used = dict.fromkeys([*rules.order_by, *rules.keys, *rules.text, *rules.output, *(also or [])])
    columns = [whole[name].alias(name) if name in whole else F.col(name) for name in used]
    if rules.long_keys:
        columns.append(digest(*[F.col(key) for key in rules.keys]).alias("_key"))
    return parsed.select(
        *columns,
        _complete(rules, numbers).alias("_complete"),
        _flag(_valid(rules, numbers, whole)).alias("_valid"),
    )


def first_complete(df: DataFrame, rules: CleanRules) -> DataFrame:
    """Staged rows after null removal and keep-first; `_valid` still to be applied."""
    return keep_first(stage(df, rules).where("_complete"), _dedup_keys(rules), rules.order_by)


def finish(staged: DataFrame, rules: CleanRules) -> DataFrame:
    """Validity, text cleaning, filling and column order on rows from `first_complete`."""
    cleaned = staged.where("_valid").withColumns({c: clean_text(F.col(c)) for c in rules.text})
    filled = cleaned.withColumns(
        {target: fill_empty(F.col(target), F.col(source)) for target, source in rules.fill.items()}
    )
    return filled.select(*rules.output)


def clean(df: DataFrame, rules: CleanRules = VIDEO_RULES) -> DataFrame:
    """All rules in order: one shuffle, by key, after a pre-shuffle group limit."""
    return finish(first_complete(df, rules), rules)


def rejected(df: DataFrame, rules: CleanRules = VIDEO_RULES) -> DataFrame:
    """The rows `clean` leaves out, with all their input columns and the rule that removed them."""
    parsed, numbers, whole = _parsed(df, rules)
    flagged = parsed.withColumns(
        {"_complete": _flag(_complete(rules, numbers)), "_valid": _flag(_valid(rules, numbers, whole))}
    )
    if rules.long_keys:
        flagged = flagged.withColumn("_key", digest(*[F.col(key) for key in rules.keys]))
    incomplete = flagged.where(~F.col("_complete")).withColumn("reason", F.lit(NULL_FIELD))
    marked = mark_first(flagged.where("_complete"), _dedup_keys(rules), rules.order_by, "_first")
    others = marked.where(~(F.col("_first") & F.col("_valid"))).withColumn(
        "reason", F.when(F.col("_first"), INVALID).otherwise(DUPLICATE)
    )
    return incomplete.select(*df.columns, "reason").unionByName(others.select(*df.columns, "reason"))


def audit(df: DataFrame, rules: CleanRules = VIDEO_RULES) -> DataFrame:
    """`(step, rule, rows_in, rows_out)` in rule order; for fill rules `rows_out` is the filled rows.

    One pass: each key is reduced to its row counts and the flags of its first complete row, with
    partial aggregation before the shuffle, and the groups are summed up.
    """
    flags = {"_valid": F.col("_valid")}
    for target in rules.fill:
        flags[f"_empty_{target}"] = clean_text(F.col(target)) == ""
    keys = _dedup_keys(rules)
    place = F.struct(*within(keys, rules.order_by), *[value.alias(name) for name, value in flags.items()])
    groups = (
        stage(df, rules)
        .groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.count_if(_flag(F.col("_complete"))).alias("complete"),
            F.min(F.when(F.col("_complete"), place)).alias("first"),
        )
    )
    kept = F.col("first._valid")
    totals = groups.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("n_all"),
        F.coalesce(F.sum("complete"), F.lit(0)).alias("n_complete"),
        F.count_if(F.col("first").isNotNull()).alias("n_first"),
        F.count_if(kept).alias("n_valid"),
        *[F.count_if(kept & F.col(f"first._empty_{t}")).alias(f"n_fill_{t}") for t in rules.fill],
    )
    return audit_rows(totals, rules)


def audit_rows(totals: DataFrame, rules: CleanRules) -> DataFrame:
    """The audit from one row of totals `n_all`, `n_complete`, `n_first`, `n_valid` and `n_fill_<target>`."""
    steps = [
        ("drop_null", "n_all", "n_complete"),
        ("keep_first", "n_complete", "n_first"),
        ("drop_invalid", "n_first", "n_valid"),
        *[(f"fill_{target}", "n_valid", f"n_fill_{target}") for target in rules.fill],
    ]
    rows = [
        F.struct(
            F.lit(step).cast("bigint").alias("step"),
            F.lit(rule).alias("rule"),
            F.col(rows_in).cast("bigint").alias("rows_in"),
            F.col(rows_out).cast("bigint").alias("rows_out"),
        )
        for step, (rule, rows_in, rows_out) in enumerate(steps, start=1)
    ]
    return totals.select(F.inline(F.array(*rows)))
