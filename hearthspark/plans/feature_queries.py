"""Queries over the household features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthspark.operators import features as ft
from hearthspark.operators.columns import replace_infinite
from hearthspark.operators.joins import group_value_on_rows, join_household_columns
from hearthspark.plans.registry import query, with_tables
from hearthspark.sources.survey import Survey


def rounded(df: DataFrame, *names: str) -> DataFrame:
    """Six decimals, so that summation order cannot show in a comparison."""
    return df.withColumns({name: F.round(name, 6) for name in names})


def _features(s: Survey, chosen: Sequence[ft.Feature]) -> DataFrame:
    return ft.build_features(s.persons, chosen)


def _grouped(columns: str) -> str:
    return with_tables(f"select id, {columns} from personas group by id")


def _any(column: str, code: int, name: str) -> str:
    return f"cast(max(case when {column}={code} then 1 else 0 end) as int) as {name}"


def _count(condition: str) -> str:
    return f"cast(count(case when {condition} then 1 end) as bigint)"


# SQL of the first set, feature by feature; the same texts serve the single
# queries and the query that builds all of them at once.
MODE_SQL = """(select id, coalesce(max(case when r=1 then a end),0) as {name} from (
    select id, a, row_number() over (partition by id order by case when a is null then 1 else 0 end, n desc, a) as r
    from (select id, {answer} as a, count(*) as n from personas group by id, {answer})) group by id)"""

SQL = {
    "mean_age": "round(avg(P6040),6) as mean_age_household",
    "any": ", ".join([_any("P6090", 1, "has_social_program"), _any("P6240", 1, "P6240_someone_works"),
                      _any("P6210", 6, "has_university_education"), _any("P6590", 1, "receives_food_payment")]),
    "education": "cast(sum(case when P6210 is null then 0 else greatest(0, P6210-1) end) as bigint) as educ_attainment",
    "unemployment": "round(case when count(case when P6240 in (1,2) then 1 end)=0 then 0.0e0 "
                    "else cast(count(case when P6240=2 then 1 end) as double)"
                    "/count(case when P6240 in (1,2) then 1 end) end,6) as P6240_unemployment_rate",
    "subsidies": ", ".join([_any(c, 1, n) for c, n in ft.SUBSIDIES.items()]
                           + ["cast(" + "+".join(f"max(case when {c}=1 then 1 else 0 end)" for c in ft.SUBSIDIES)
                              + " as int) as total_subsidies"]),
    "pension": """case when count(P6920)=0 then null else cast(max(case when P6920=1 then 1 else 0 end) as int) end
        as has_pension_contributor,
      case when count(P6920)=0 then null else cast(max(case when P6920=3 then 1 else 0 end) as int) end as has_pensioner,
      case when count(P6920)=0 then null else round(sum(case when P6920=1 then 1.0e0 else 0 end)/count(*),6) end
        as prop_pension_contributors,
      case when count(P6920)=0 then null else round(sum(case when P6920=3 then 1.0e0 else 0 end)/count(*),6) end
        as prop_pensioners,
      case when count(P6920)=0 then null
        when count(case when P6920=1 then 1 end)>0 and count(case when coalesce(P6920,2) in (2,3) then 1 end)>0
          then 'mixed'
        when count(case when P6920=1 then 1 end)=count(*) then 'all_contributing'
        when count(case when P6920=3 then 1 end)=count(*) then 'all_pensioners'
        when count(case when coalesce(P6920,2)=2 then 1 end)=count(*) then 'none'
        else 'other' end as pension_status""",
    "ages": "count(*) as household_size, count(*) as num_individuals, "
            f"{_count('P6040<18')} as num_under_18, {_count('P6040>65')} as num_over_65, "
            "cast(max(case when P6040>65 then 1 else 0 end) as int) as has_over_65",
    "dependency": """round(cast(count(case when P6040<15 or P6040>64 then 1 end) as double)
        /nullif(count(case when P6040 between 15 and 64 then 1 end),0),6) as dependency_ratio""",
    "head": "coalesce(bool_or(P6050=1 and P6020=2),false) as is_female_headed",
    "insurance": "coalesce(bool_or(P6090=1),false) as has_health_insurance, "
                 "round(sum(case when P6090=1 then 1.0e0 else 0 end)/count(*),6) as insurance_coverage_rate",
}
DIVERSITY_SQL = """(select id, round(coalesce(1-sum(cast(n as double)*n)
    /nullif(cast(sum(n) as double)*cast(sum(n) as double),0),0),6) as P6240_activity_diversity
    from (select id, P6240, count(P6240) as n from personas group by id, P6240) group by id)"""
ACTIVITY_MODE = MODE_SQL.format(name="P6240_main_household_activity", answer="P6240")
INSURANCE_MODE = MODE_SQL.format(name="main_insurance_type", answer="case when P6090=1 then P6100 end")


@query(_grouped(SQL["mean_age"]))
def feat_mean_age(s: Survey) -> DataFrame:
    return rounded(_features(s, [ft.mean_age()]), "mean_age_household")


@query(_grouped(SQL["any"]))
def feat_any_flag(s: Survey) -> DataFrame:
    works = ft.any_code("P6240_someone_works", "P6240", ft.WORKING)
    return _features(s, [ft.social_program(), works, ft.university(), ft.food_payment()])


@query(_grouped(SQL["education"]))
def feat_education_sum(s: Survey) -> DataFrame:
    return _features(s, [ft.education_sum()])


@query(_grouped(SQL["unemployment"]))
def feat_unemployment_rate(s: Survey) -> DataFrame:
    return rounded(_features(s, ft.activity()), "P6240_unemployment_rate").select("id", "P6240_unemployment_rate")


@query(with_tables(f"select * from {ACTIVITY_MODE} m"))
def feat_mode(s: Survey) -> DataFrame:
    return _features(s, ft.activity()).select("id", "P6240_main_household_activity")


@query(with_tables(f"select * from {DIVERSITY_SQL} d"))
def feat_diversity(s: Survey) -> DataFrame:
    return rounded(_features(s, ft.activity()), "P6240_activity_diversity").select("id", "P6240_activity_diversity")


@query(with_tables("select id, coalesce(max(case when r=1 then a end),0) as most_frequent_job from (select id, a, "
                   "row_number() over (partition by id order by case when a is null then 1 else 0 end, n desc, a) "
                   "as r from (select id, P6430 as a, count(*) as n from personas group by id, P6430)) group by id"))
def feat_mode_open_domain(s: Survey) -> DataFrame:
    return ft.answer_mode(s.persons, "P6430", "most_frequent_job")


@query(with_tables("select id, round(coalesce(1-sum(cast(n as double)*n)/nullif(cast(sum(n) as double)"
                   "*cast(sum(n) as double),0),0),6) as job_diversity from (select id, P6430, count(P6430) as n "
                   "from personas group by id, P6430) group by id"))
def feat_diversity_open_domain(s: Survey) -> DataFrame:
    return rounded(ft.answer_diversity(s.persons, "P6430", "job_diversity"), "job_diversity")


@query(with_tables("select id, cast(coalesce(min(case when n=top and a is not null then a end),0) as int) as "
                   "P6240_main_household_activity, round(coalesce(1-sum(cast(n as double)*n)/nullif(cast(sum(n) as double)"
                   "*cast(sum(n) as double),0),0),6) as P6240_activity_diversity from (select *, max(n) over "
                   "(partition by id) as top from (select id, P6430 as a, count(P6430) as n from personas "
                   "group by id, P6430)) group by id"))
def feat_unlisted_answers(s: Survey) -> DataFrame:
    """The activity features over answers of which many are outside the questionnaire's activity codes."""
    answered = s.persons.withColumn("P6240", F.col("P6430"))
    made = rounded(ft.build_features(answered, ft.activity()), "P6240_activity_diversity")
    return made.select("id", "P6240_main_household_activity", "P6240_activity_diversity")


@query(_grouped(SQL["subsidies"]))
def feat_subsidies(s: Survey) -> DataFrame:
    return _features(s, ft.subsidies())


@query(_grouped(SQL["pension"]))
def feat_pension_status(s: Survey) -> DataFrame:
    return rounded(_features(s, ft.pension()), "prop_pension_contributors", "prop_pensioners")


@query(_grouped(SQL["ages"]))
def feat_age_counts(s: Survey) -> DataFrame:
    return _features(s, ft.ages())


@query(_grouped(SQL["dependency"] + ", count(case when P6040 between 15 and 64 then 1 end)=0 as no_working_age"))
def feat_dependency_ratio(s: Survey) -> DataFrame:
    features = _features(s, [ft.dependency()]).withColumn("no_working_age", F.col("dependency_ratio") == float("inf"))
    return rounded(replace_infinite(features, ["dependency_ratio"]), "dependency_ratio")


@query(_grouped(SQL["head"]))
def feat_head_flags(s: Survey) -> DataFrame:
    return _features(s, [ft.female_head()])


@query(with_tables(f"select g.*, m.main_insurance_type from (select id, {SQL['insurance']} from personas group by id) "
                   f"g join {INSURANCE_MODE} m using (id)"))
def feat_insurance(s: Survey) -> DataFrame:
    return rounded(_features(s, ft.insurance()), "insurance_coverage_rate")


_ALL_PARTS = ("mean_age", "any", "education", "unemployment", "subsidies", "pension", "ages", "dependency", "head",
              "insurance")
_FILLED = ("has_social_program", "educ_attainment", "P6240_someone_works", "P6240_unemployment_rate",
           "P6240_main_household_activity", "P6240_activity_diversity")
ENHANCED_SQL = f"""select h.*, f.* exclude (id, {", ".join(_FILLED)}),
    {", ".join(f"coalesce(f.{n},0) as {n}" for n in _FILLED)}
  from hogares h left join (
    select g.*, m.P6240_main_household_activity, d.P6240_activity_diversity, i.main_insurance_type
    from (select id, {", ".join(SQL[p] for p in _ALL_PARTS)} from personas group by id) g
    join {ACTIVITY_MODE} m using (id) join {DIVERSITY_SQL} d using (id) join {INSURANCE_MODE} i using (id)
  ) f using (id)"""

FRACTIONS = ("mean_age_household", "P6240_unemployment_rate", "P6240_activity_diversity",
             "prop_pension_contributors", "prop_pensioners", "dependency_ratio", "insurance_coverage_rate")


@query(with_tables(ENHANCED_SQL))
def household_features_join(s: Survey) -> DataFrame:
    enhanced = ft.enhance(s.households, s.persons)
    return rounded(replace_infinite(enhanced, ["dependency_ratio"]), *FRACTIONS)


@query(with_tables("select p.* exclude (l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_shipdate, "
                   "l_discount, l_tax, l_returnflag, l_linestatus), h.P5000, h.P5010, h.P5090 "
                   "from personas p left join hogares h using (id)"))
def persons_with_household(s: Survey) -> DataFrame:
    return join_household_columns(s.persons, s.households, ["P5000", "P5010", "P5090"])


@query(with_tables("select id, P6040, count(*) over (partition by id) as num_individuos, "
                   "round(avg(P6040) over (partition by id),6) as mean_age from personas"))
def window_group_broadcast(s: Survey) -> DataFrame:
    values = {"num_individuos": F.count(F.lit(1)), "mean_age": F.avg("P6040")}
    return rounded(group_value_on_rows(s.persons.select("id", "P6040"), values), "mean_age")


# ---- second set ---------------------------------------------------------------

def _any3(condition: str, name: str) -> str:
    return (f"cast(case when max(case when {condition} then 1 end)=1 then 1 "
            f"when count({condition})<count(*) then null else 0 end as int) as {name}")


def _share(condition: str, name: str) -> str:
    return (f"round(100*avg(case when {condition} then 1.0e0 when not ({condition}) then 0.0e0 end),6) as {name}")


SQL_2 = {
    "counts": f"count(*) as num_individuos, {_count('P6040<18')} as num_individuos_menores_18, "
              f"{_count('P6040>65')} as num_individuos_mayores_65",
    "null_aware": ", ".join([_any3("P6040>65", "dummy_mayores_65"), _any3("P6050=1 and P6020=2", "jefe_mujer"),
                             _any3("P6210=6", "alguno_universidad")]),
    "head": ", ".join([_any("P6050=1 and P6090", 2, "jefe_pension"), _any("P6050=1 and P6210", 6, "jefe_uni")]),
    "employment": ", ".join([_share("P6240=1", "porcentaje_laborando"),
                             _share("P6240=1 and P6430=1", "share_empleado_privado"),
                             _share("P6240=1 and P6430=2", "share_empleado_publico"),
                             _share("P6240=1 and P6430=4", "share_empleado_cuentapropia")]),
    "flags": ", ".join([_any("P6590", 1, "alimentos"), _any("P6920", 1, "pension"), _any("P7150", 1, "subempleo_cap"),
                        _any("P7495", 1, "recibir_pension"), _any("P7510s3", 1, "subsidio")]),
    "hours": "cast(coalesce(sum(P6800),0) as bigint) as horas_total_bruto, "
             "round(coalesce(avg(P6800),0.0e0),6) as horas_promedio_bruto",
}
HOUSING_SQL = ("cast(case when h.P5090=1 then 1 else 0 end as int) as casa_propia, "
               "round(case when h.P5000>0 and h.P5010 is not null then cast(h.P5010 as double)/h.P5000 "
               "else 0.0e0 end,6) as cuartospersona")
SECOND_SET_SQL = (f"select f.*, h.* exclude (id), {HOUSING_SQL} from (select id, {', '.join(SQL_2.values())} "
                  "from personas group by id) f left join hogares h using (id)")
SHARES_2 = ("porcentaje_laborando", "share_empleado_privado", "share_empleado_publico", "share_empleado_cuentapropia")


@query(_grouped(SQL_2["counts"]))
def rfeat_counts(s: Survey) -> DataFrame:
    return _features(s, ft.counts_2())


@query(_grouped(SQL_2["null_aware"]))
def rfeat_any_null_aware(s: Survey) -> DataFrame:
    return _features(s, ft.null_aware_2())


@query(_grouped(SQL_2["head"]))
def rfeat_head(s: Survey) -> DataFrame:
    return _features(s, ft.head_2())


@query(_grouped(SQL_2["employment"]))
def rfeat_employment_shares(s: Survey) -> DataFrame:
    return rounded(_features(s, ft.employment_2()), *SHARES_2)


@query(_grouped(SQL_2["flags"]))
def rfeat_flags(s: Survey) -> DataFrame:
    return _features(s, ft.flags_2())


@query(_grouped(SQL_2["hours"]))
def rfeat_hours(s: Survey) -> DataFrame:
    return rounded(_features(s, ft.hours_2()), "horas_promedio_bruto")


@query(with_tables(f"select h.id, {HOUSING_SQL} from (select distinct id from personas) p left join hogares h using (id)"))
def rfeat_housing(s: Survey) -> DataFrame:
    members = _features(s, [ft.counts_2()[0]]).select("id")
    joined = members.join(s.households.select("id", "P5000", "P5010", "P5090"), "id", "left")
    return rounded(ft.housing_flags(joined), "cuartospersona").select("id", "casa_propia", "cuartospersona")


@query(with_tables(SECOND_SET_SQL))
def rfeat_all(s: Survey) -> DataFrame:
    return rounded(ft.enhance_2(s.households, s.persons), *SHARES_2, "horas_promedio_bruto", "cuartospersona")
