"""Rule-based data quality: annotate rows with issues, split them, measure and gate."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from orderloom.schemas import ISSUE
from orderloom.session import materialize

ERROR, WARN = "error", "warn"
_NULL_SALTS = 1024


@dataclass(frozen=True)
class Rule:
    """One check. ``violated`` yields the failing condition; it is None for a uniqueness rule."""

    name: str
    level: str
    columns: tuple[str, ...]
    message: str
    violated: Callable[[], Column] | None = None
    metadata: Mapping[str, str] | None = None


def rule_max(column: str, limit: float, level: str = WARN) -> Rule:
    """``column`` must not exceed ``limit``; NULL passes."""
    return Rule(
        name=f"{column}_greater_than_limit",
        level=level,
        columns=(column,),
        message=f"{column} is greater than {limit}",
        violated=lambda: F.col(column) > F.lit(limit),
    )


def rule_not_empty(
    columns: Sequence[str], level: str = ERROR, metadata: Mapping[str, str] | None = None, trim: bool = True
) -> list[Rule]:
    """One rule per column: neither NULL nor empty; with ``trim`` blanks alone count as empty."""

    def empty(column: str) -> Column:
        text = F.col(column).cast("string")
        return F.col(column).isNull() | ((F.trim(text) if trim else text) == "")

    return [
        Rule(
            name=f"{column}_is_null_or_empty",
            level=level,
            columns=(column,),
            message=f"{column} is null or empty",
            violated=lambda column=column: empty(column),
            metadata=metadata,
        )
        for column in columns
    ]


def rule_unique(columns: Sequence[str], level: str = ERROR) -> Rule:
    """Every copy of a repeated key fails; a key with a NULL part is exempt."""
    return Rule(
        name="_".join(columns) + "_is_not_unique",
        level=level,
        columns=tuple(columns),
        message="(" + ", ".join(columns) + ") occurs more than once",
    )


def repeated_keys(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of copies. Counts combine map-side."""
    present = df.select(*columns).na.drop("any")
    return present.groupBy(*columns).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


def _mark_repeated(df: DataFrame, columns: Sequence[str], flag: str) -> DataFrame:
    """``df`` plus ``flag``: its key is repeated.

    The repeated keys are written out first: usually few, they are then broadcast by their measured
    size and ``df`` is not shuffled. When they are many the join shuffles, and rows with a NULL key,
    which match nothing, spread by input partition instead of meeting in one task.
    """
    repeated = materialize(repeated_keys(df, columns), "repeated")
    keys = repeated.select(
        *[F.col(c).alias(f"_key_{i}") for i, c in enumerate(columns)], F.lit(0).alias("_key_salt")
    )
    absent = F.lit(False)
    for column in columns:
        absent = absent | F.col(column).isNull()
    salt = F.when(absent, F.pmod(F.spark_partition_id(), F.lit(_NULL_SALTS)) + 1)
    salted = df.withColumn("_salt", F.coalesce(salt, F.lit(0)).cast("int"))
    matches = F.col("_salt") == F.col("_key_salt")
    for i, column in enumerate(columns):
        matches = matches & (F.col(column) == F.col(f"_key_{i}"))
    joined = salted.join(keys, matches, "left")
    return joined.select(*df.columns, F.col("_key_salt").isNotNull().alias(flag))


def _issue(rule: Rule, failed: Column) -> Column:
    pairs = [F.lit(part) for pair in (rule.metadata or {}).items() for part in pair]
    metadata = F.create_map(*pairs) if pairs else F.lit(None).cast("map<string,string>")
    return F.when(
        failed,
        F.struct(
            F.lit(rule.name).alias("name"),
            F.lit(rule.message).alias("message"),
            F.array(*[F.lit(c) for c in rule.columns]).alias("columns"),
            metadata.alias("metadata"),
        ),
    )


def _issues_of(rules: Sequence[tuple[Rule, Column]]) -> Column:
    """Array of the failed rules, NULL when none failed; built for failing rows only."""
    if not rules:
        return F.lit(None).cast(ISSUE)
    any_failed = F.lit(False)
    for _, failed in rules:
        any_failed = any_failed | F.coalesce(failed, F.lit(False))
    return F.when(any_failed, F.array_compact(F.array(*[_issue(rule, failed) for rule, failed in rules]))).cast(ISSUE)


def annotate(df: DataFrame, rules: Sequence[Rule], repeated: str | None = None) -> DataFrame:
    """``df`` plus ``_errors`` and ``_warnings``: arrays of the failed rules, NULL when clean.

    ``repeated`` names a boolean column of ``df`` that already tells whether the key of its uniqueness rule is
    repeated; it is not in the result.
    """
    unknown = {rule.level for rule in rules} - {ERROR, WARN}
    if unknown:
        raise ValueError(f"unknown rule levels {unknown}")
    columns = [c for c in df.columns if c != repeated]
    if repeated and sum(rule.violated is None for rule in rules) > 1:
        raise ValueError("one column cannot answer several uniqueness rules")
    conditions: list[tuple[Rule, Column]] = []
    for position, rule in enumerate(rules):
        if rule.violated is None and repeated:
            conditions.append((rule, F.col(repeated)))
        elif rule.violated is None:
            flag = f"_repeated_{position}"
            df = _mark_repeated(df, rule.columns, flag)
            conditions.append((rule, F.col(flag)))
        else:
            conditions.append((rule, rule.violated()))
    errors = [(rule, failed) for rule, failed in conditions if rule.level == ERROR]
    warnings = [(rule, failed) for rule, failed in conditions if rule.level == WARN]
    return df.select(*columns, _issues_of(errors).alias("_errors"), _issues_of(warnings).alias("_warnings"))


def valid_rows(annotated: DataFrame) -> DataFrame:
    """Rows without an error (warnings allowed), in their original columns."""
    return annotated.filter(F.col("_errors").isNull()).drop("_errors", "_warnings")


def invalid_rows(annotated: DataFrame) -> DataFrame:
    """Rows with any error or warning, annotations kept."""
    return annotated.filter(F.col("_errors").isNotNull() | F.col("_warnings").isNotNull())


def split(annotated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, invalid). A row with only warnings is in both."""
    return valid_rows(annotated), invalid_rows(annotated)


def issues(invalid: DataFrame, *carry: str) -> DataFrame:
    """One row per issue: the carried columns, the rule name and its level."""
    none = F.array().cast(ISSUE)

    def tagged(column: str, level: str) -> Column:
        found = F.coalesce(F.col(column), none)
        return F.transform(found, lambda issue: F.struct(issue["name"].alias("name"), F.lit(level).alias("level")))

    listed = invalid.select(*carry, F.explode(F.concat(tagged("_errors", ERROR), tagged("_warnings", WARN))).alias("i"))
    return listed.select(*carry, F.col("i.name").alias("name"), F.col("i.level").alias("level"))


def _counts() -> list[Column]:
    clean = F.col("_errors").isNull()
    return [
        F.count_if(clean).alias("valid"),
        F.count_if(~clean | F.col("_warnings").isNotNull()).alias("invalid"),
        F.count(F.lit(1)).alias("rows"),
    ]


def observed(annotated: DataFrame) -> tuple[DataFrame, Observation]:
    """``annotated`` that counts its rows while an action writes what is derived from it.

    Counted are the rows that pass here, in the tasks of that action, so place no shuffle behind it: a task that
    runs again for a lost shuffle file would count its rows again.
    """
    seen = Observation(f"quality-{uuid.uuid4().hex}")
    return annotated.observe(seen, *_counts()), seen


def observed_ratio(seen: Observation, denominator: str = "outputs") -> tuple[int, int, float]:
    """(valid, invalid, ratio) as of ``dq_ratio``, from the counts of a write that has ended."""
    if denominator not in ("outputs", "rows"):
        raise ValueError(f"unknown denominator {denominator}")
    counts = seen.get
    good, bad, rows = (int(counts.get(name) or 0) for name in ("valid", "invalid", "rows"))
    total = good + bad if denominator == "outputs" else rows
    return good, bad, bad / total if total else 0.0


def dq_ratio(annotated: DataFrame, denominator: str = "outputs") -> DataFrame:
    """One row: valid, invalid and the quarantined share, from a single pass.

    ``"outputs"`` divides by valid + invalid, where rows with only warnings count twice;
    ``"rows"`` divides by the number of rows. An empty input has ratio 0.
    """
    if denominator not in ("outputs", "rows"):
        raise ValueError(f"unknown denominator {denominator}")
    counts = annotated.agg(*_counts())
    total = F.col("valid") + F.col("invalid") if denominator == "outputs" else F.col("rows")
    ratio = F.when(total > 0, F.col("invalid") / total).otherwise(F.lit(0.0))
    return counts.select("valid", "invalid", ratio.alias("ratio"))


class QuarantineRatioExceeded(RuntimeError):
    """Too many rows were quarantined."""


def gate(valid: int, invalid: int, ratio: float, threshold: float) -> None:
    """Raise when the quarantined share is strictly above ``threshold``."""
    if ratio > threshold:
        raise QuarantineRatioExceeded(
            f"quarantine ratio {ratio:.3f} above {threshold} (valid={valid}, invalid={invalid})"
        )


# The order limit and the metadata carried by the completeness rules.
ORDER_TOTAL_LIMIT = 1000
COMPLETENESS = {"check_type": "completeness", "responsible_data_steward": "someone@email.com"}


def order_rules(limit: float = ORDER_TOTAL_LIMIT) -> list[Rule]:
    """The checks of the bronze orders."""
    return [
        rule_max("total", limit),
        *rule_not_empty(["id", "id_customer"], metadata=COMPLETENESS),
        rule_unique(["id"]),
    ]
