"""Data-quality assertions.

Each assertion is a lazy DataFrame of offenders; zero rows means pass.  All
of them aggregate before they shuffle: a unique check counts per value with a
map-side partial, a relationship check first reduces the child to its
distinct keys (with row counts), so a hot key costs one row per task, not a
third of the table in one task.

``QualitySuite`` runs a list of checks.  ``report`` builds one DataFrame with
a row per check, batching the checks of each relation: all not-null checks of
a relation are one scan and one global aggregate; all unique checks of a
relation share one shuffle (values stacked with their check id); all
relationship checks share one anti join.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postline.operators.bloom import BITS, KeyFilter


# --- single assertions ------------------------------------------------------

def not_null(df: DataFrame, col: str) -> DataFrame:
    """Q1: rows where ``col`` is NULL."""
    return df.where(F.col(col).isNull())


def unique(df: DataFrame, col: str) -> DataFrame:
    """Q2: values of ``col`` seen more than once (NULLs ignored)."""
    return (df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n_records"))
            .where("n_records > 1"))


def relationships(child: DataFrame, col: str, parent: DataFrame, field_name: str,
                  where: str | Column | None = None) -> DataFrame:
    """Child keys with no parent row, with how many child rows carry each.

    NULL child keys are not checked.  The child is reduced to distinct keys
    before the anti join.
    """
    c = child.where(F.col(col).isNotNull())
    if where is not None:
        c = c.where(where)
    keys = c.groupBy(col).agg(F.count(F.lit(1)).alias("n_records"))
    parents = parent.select(F.col(field_name).alias(col)).where(F.col(col).isNotNull())
    return keys.join(parents, col, "left_anti")


def relationships_filtered(child: DataFrame, col: str, parent: DataFrame, field_name: str,
                           where: str | Column | None = None, bits: int = BITS) -> DataFrame:
    """``relationships`` for parents and children too large to shuffle whole, with filters of a fixed size.

    A child key outside the filter of the parents is an orphan at once.  The others meet
    only those parents that lie in the filter of these keys, in an exact anti join.
    """
    c = child.where(F.col(col).isNotNull())
    if where is not None:
        c = c.where(where)
    keys = c.groupBy(col).agg(F.count(F.lit(1)).alias("n_records"))
    parents = parent.select(F.col(field_name).alias(col))
    known, asked = KeyFilter(parents, [F.col(col)], bits), [F.col(col)]
    open_keys = known.may_meet(keys, asked)
    met = KeyFilter(open_keys, asked, bits).may_meet(parents, asked)
    return known.meets_none(keys, asked).unionByName(open_keys.join(met, col, "left_anti"))


def composite_key_unique(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Key combinations seen more than once; NULLs compare equal."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("duplicate_count")).where("duplicate_count > 1")


def dates_not_future(df: DataFrame, col: str, now: datetime | Column | None = None) -> DataFrame:
    """Q5/A10: one row with the number of future values, none when there are none."""
    limit = F.current_timestamp() if now is None else (now if isinstance(now, Column) else F.lit(now))
    return (df.where(F.col(col).isNotNull() & (F.col(col) > limit))
            .agg(F.count(F.lit(1)).alias("future_dates")).where("future_dates > 0"))


def posting_matches_staging(stg: DataFrame, posting: DataFrame) -> DataFrame:
    """Staged keys with a company that have no posting."""
    staged = stg.where(F.nullif(F.trim("company_name"), F.lit("")).isNotNull()).select("business_key")
    return staged.join(posting.select("business_key"), "business_key", "left_anti")


def bridge_unique_triples(bridge: DataFrame) -> DataFrame:
    """Q7: the bridge holds each (job, skill, category) once."""
    return composite_key_unique(bridge, ["job_id", "skill_id", "skill_cat_id"])


# --- suites -----------------------------------------------------------------

@dataclass(frozen=True)
class Check:
    kind: str                      # not_null | unique | relationships | composite_key_unique | dates_not_future
    relation: str
    columns: tuple[str, ...]
    parent: str | None = None
    parent_field: str | None = None
    where: str | None = None

    @property
    def name(self) -> str:
        cols = ",".join(self.columns)
        if self.kind == "relationships":
            return f"relationships({self.relation}.{cols} -> {self.parent}.{self.parent_field})"
        return f"{self.kind}({self.relation}.{cols})"

    def offenders(self, tables: Mapping[str, DataFrame], now: datetime | None = None) -> DataFrame:
        df = tables[self.relation]
        if self.kind == "not_null":
            return not_null(df, self.columns[0])
        if self.kind == "unique":
            return unique(df, self.columns[0])
        if self.kind == "relationships":
            return relationships(df, self.columns[0], tables[self.parent], self.parent_field, self.where)
        if self.kind == "composite_key_unique":
            return composite_key_unique(df, list(self.columns))
        if self.kind == "dates_not_future":
            return dates_not_future(df, self.columns[0], now)
        raise ValueError(self.kind)


@dataclass(frozen=True)
class Singular:
    """A named assertion given as a function of the tables (Q6, Q7)."""
    name: str
    relation: str
    build: object = field(compare=False)

    kind = "singular"

    def offenders(self, tables: Mapping[str, DataFrame], now: datetime | None = None) -> DataFrame:
        return self.build(tables)


def model_checks() -> list[Check | Singular]:
    """The 57 column/table assertions on the models plus the 2 singular ones."""
    checks: list[Check | Singular] = [
        Check("not_null", "stg_raw_jobs", ("raw_job_id",)),
        Check("not_null", "stg_raw_jobs", ("business_key",)),
        Check("unique", "stg_raw_jobs", ("business_key",)),
        Check("dates_not_future", "stg_raw_jobs", ("ingested_at",)),
        Check("unique", "stg_job_skills_exploded", ("skill_assignment_id",)),
        Check("not_null", "stg_job_skills_exploded", ("skill_assignment_id",)),
        Check("unique", "stg_job_type_skills_exploded", ("grouped_skill_assignment_id",)),
        Check("not_null", "stg_job_type_skills_exploded", ("grouped_skill_assignment_id",)),
    ]
    dims = {
        "company": ("company_id", "company_name"),
        "country": ("country_id", "country_name"),
        "platform": ("platform_id", "platform_name"),
        "schedule_type": ("schedule_type_id", "schedule_name"),
        "job_title_category": ("title_cat_id", "job_title_short"),
        "salary_rate_type": ("rate_type_id", "rate_name"),
        "skill": ("skill_id", "skill_name"),
        "skill_category": ("skill_cat_id", "category_name"),
    }
    for rel, cols in dims.items():
        for c in cols:
            checks += [Check("unique", rel, (c,)), Check("not_null", rel, (c,))]
    checks += [
        Check("unique", "job_posting", ("job_id",)),
        Check("not_null", "job_posting", ("job_id",)),
        Check("unique", "job_posting", ("business_key",)),
        Check("not_null", "job_posting", ("business_key",)),
        Check("not_null", "job_posting", ("company_id",)),
    ]
    for col, parent in [("company_id", "company"), ("title_cat_id", "job_title_category"),
                        ("schedule_type_id", "schedule_type"), ("platform_id", "platform"),
                        ("country_id", "country"), ("rate_type_id", "salary_rate_type")]:
        checks.append(Check("relationships", "job_posting", (col,), parent, col))
    checks += [
        Check("composite_key_unique", "job_skill", ("job_id", "skill_id", "skill_cat_id")),
        Check("not_null", "job_skill", ("job_id",)),
        Check("relationships", "job_skill", ("job_id",), "job_posting", "job_id"),
        Check("not_null", "job_skill", ("skill_id",)),
        Check("relationships", "job_skill", ("skill_id",), "skill", "skill_id"),
        Check("relationships", "job_skill", ("skill_cat_id",), "skill_category", "skill_cat_id",
              where="skill_cat_id is not null"),
        Singular("job_posting_matches_staging", "job_posting",
                 lambda t: posting_matches_staging(t["stg_raw_jobs"], t["job_posting"])),
        Singular("job_skill_unique_combination", "job_skill",
                 lambda t: bridge_unique_triples(t["job_skill"])),
    ]
    return checks


def _failures(check, tables, now) -> Column:
    """Failure count of one check (number of offending rows, or child rows for relationships)."""
    off = check.offenders(tables, now)
    if isinstance(check, Check) and check.kind == "relationships":
        return off.agg(F.coalesce(F.sum("n_records"), F.lit(0)).cast("long").alias("failures"))
    return off.agg(F.count(F.lit(1)).alias("failures"))


class QualitySuite:
    def __init__(self, checks: Sequence[Check | Singular] | None = None):
        self.checks = list(checks) if checks is not None else model_checks()

    def report(self, tables: Mapping[str, DataFrame], now: datetime | None = None) -> DataFrame:
        """One row per check: (check_name, relation, kind, failures).

        Built as one SQL statement over the relations (one analysis, however
        many checks), plus the offender count of each singular check.  Not-null checks: one scan + global aggregate per
        relation.  Unique checks of *all* relations: one shuffle (values
        stacked with a check id).  Relationship checks of all relations: one
        shuffle of distinct child keys, one of parent keys, one anti join.
        """
        spark = next(iter(tables.values())).sparkSession
        batched = [ch for ch in self.checks if isinstance(ch, Check)]
        parts = []
        if batched:
            text, used = report_sql(batched, now)
            parts.append(spark.sql(text, **{_ref(r): tables[r] for r in used}))
        for ch in self.checks:
            if not isinstance(ch, Check):
                parts.append(_failures(ch, tables, now).select(
                    F.lit(ch.name).alias("check_name"), F.lit(ch.relation).alias("relation"),
                    F.lit(ch.kind).alias("kind"), "failures"))
        return reduce(DataFrame.unionByName, parts)

    def run(self, tables: Mapping[str, DataFrame], fail_fast: bool = True,
            now: datetime | None = None) -> list[tuple[str, int]]:
        """Q8: the checks in order with their failures, up to the first failing one with ``fail_fast``.

        One batched report counts them all (a number per check reaches the driver).
        """
        counts: dict[tuple[str, str], int] = {(r["check_name"], r["kind"]): int(r["failures"])
                                              for r in self.report(tables, now).collect()}
        results = []
        for ch in self.checks:
            results.append((ch.name, counts[ch.name, ch.kind]))
            if fail_fast and results[-1][1]:
                break
        return results


def _ref(rel: str) -> str:
    return f"t_{rel}"


def _lit(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def report_sql(checks: Sequence[Check], now: datetime | None = None) -> tuple[str, set[str]]:
    """SQL text of the batched report and the relations it reads."""
    used: set[str] = set()

    def t(rel: str) -> str:
        used.add(rel)
        return "{" + _ref(rel) + "}"

    limit = "current_timestamp()" if now is None else f"TIMESTAMP {_lit(now.isoformat(sep=' '))}"
    ctes: list[str] = []
    selects: list[str] = []
    meta: list[str] = []          # (check_id, check_name, relation, kind) of batched checks

    def head(ch) -> str:
        return f"{_lit(ch.name)} AS check_name, {_lit(ch.relation)} AS relation, {_lit(ch.kind)} AS kind"

    by_rel: dict[str, list[Check]] = {}
    uniques: list[tuple[int, Check]] = []
    rels: list[tuple[int, Check]] = []
    for i, ch in enumerate(checks):
        if isinstance(ch, Check) and ch.kind == "not_null":
            by_rel.setdefault(ch.relation, []).append(ch)
        elif isinstance(ch, Check) and ch.kind == "unique":
            uniques.append((i, ch))
        elif isinstance(ch, Check) and ch.kind == "relationships":
            rels.append((i, ch))
        elif isinstance(ch, Check) and ch.kind == "composite_key_unique":
            cols = ", ".join(ch.columns)
            selects.append(f"SELECT {head(ch)}, count(*) AS failures FROM (SELECT {cols} FROM {t(ch.relation)} "
                           f"GROUP BY {cols} HAVING count(*) > 1)")
        elif isinstance(ch, Check) and ch.kind == "dates_not_future":
            c = ch.columns[0]
            selects.append(f"SELECT {head(ch)}, count(*) AS failures FROM (SELECT count(*) AS n FROM {t(ch.relation)} "
                           f"WHERE {c} IS NOT NULL AND {c} > {limit} HAVING count(*) > 0)")
        else:
            raise ValueError(f"unknown kind of check: {ch.kind}")

    for rel, group in by_rel.items():
        # one scan and one global aggregate per relation; its checks become rows via inline()
        aggs = ", ".join(f"count_if({ch.columns[0]} IS NULL) AS c{k}" for k, ch in enumerate(group))
        rows = ", ".join(f"named_struct('check_name', {_lit(ch.name)}, 'relation', {_lit(ch.relation)}, "
                         f"'kind', 'not_null', 'failures', c{k})" for k, ch in enumerate(group))
        selects.append(f"SELECT inline(array({rows})) FROM (SELECT {aggs} FROM {t(rel)})")

    if uniques:
        vals = " UNION ALL ".join(
            f"SELECT {i} AS check_id, CAST({ch.columns[0]} AS STRING) AS v FROM {t(ch.relation)} "
            f"WHERE {ch.columns[0]} IS NOT NULL" for i, ch in uniques)
        ctes.append(f"uq AS (SELECT check_id, count(*) AS failures FROM (SELECT check_id, v FROM ({vals}) "
                    f"GROUP BY check_id, v HAVING count(*) > 1) GROUP BY check_id)")
        meta += [f"({i}, {_lit(ch.name)}, {_lit(ch.relation)}, 'unique')" for i, ch in uniques]
    if rels:
        child = " UNION ALL ".join(
            f"SELECT {i} AS check_id, CAST({ch.columns[0]} AS STRING) AS k FROM {t(ch.relation)} "
            f"WHERE {ch.columns[0]} IS NOT NULL" + (f" AND ({ch.where})" if ch.where else "")
            for i, ch in rels)
        parent = " UNION ALL ".join(
            f"SELECT {i} AS check_id, CAST({ch.parent_field} AS STRING) AS k FROM {t(ch.parent)}" for i, ch in rels)
        ctes.append(f"rc AS (SELECT check_id, k, count(*) AS n FROM ({child}) GROUP BY check_id, k)")
        ctes.append(f"rp AS (SELECT DISTINCT check_id, k FROM ({parent}) WHERE k IS NOT NULL)")
        ctes.append("rf AS (SELECT c.check_id, sum(c.n) AS failures FROM rc c LEFT ANTI JOIN rp p "
                    "ON c.check_id = p.check_id AND c.k = p.k GROUP BY c.check_id)")
        meta += [f"({i}, {_lit(ch.name)}, {_lit(ch.relation)}, 'relationships')" for i, ch in rels]
    if meta:
        ctes.append(f"meta AS (SELECT * FROM VALUES {', '.join(meta)} AS m(check_id, check_name, relation, kind))")
        counts = " UNION ALL ".join(x for x in [
            "SELECT check_id, failures FROM uq" if uniques else "",
            "SELECT check_id, failures FROM rf" if rels else ""] if x)
        selects.append("SELECT m.check_name, m.relation, m.kind, coalesce(f.failures, 0) AS failures "
                       f"FROM meta m LEFT JOIN ({counts}) f ON f.check_id = m.check_id")
    body = " UNION ALL ".join(
        f"SELECT check_name, relation, kind, CAST(failures AS BIGINT) AS failures FROM ({x})" for x in selects)
    return (("WITH " + ", ".join(ctes) + " ") if ctes else "") + body, used
