"""Queries over splits, balance, imputation, encoding and preparation."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthspark.operators import columns as c
from hearthspark.operators import encode as e
from hearthspark.operators import features as ft
from hearthspark.operators import impute as i
from hearthspark.operators import sampling as sm
from hearthspark.plans import prepare as pr
from hearthspark.plans.feature_queries import ENHANCED_SQL, FRACTIONS, rounded
from hearthspark.plans.registry import query, with_tables
from hearthspark.plans.table_queries import ENHANCED_NAMES, KEYS, SEED, filled_sql, md5_order
from hearthspark.session import materialize
from hearthspark.sources.survey import LABEL, LEAKY, SPARSE, Survey

RANKED = f"""select *, row_number() over (partition by {{by}} order by {md5_order()}) as r,
    count(*) over (partition by {{by}}) as n from {{table}}"""


@query(with_tables("select id, case when r<=floor(n*0.8e0) then 'train' else 'test' end as split from ("
                   + RANKED.format(by="1", table="train") + ")"))
def split_random(s: Survey) -> DataFrame:
    return sm.split_random(s.train.select("id"), "id", 0.8, SEED)


@query(with_tables("select id, Pobre, case when r<=floor(n*0.8e0) then 'train' else 'test' end as split from ("
                   + RANKED.format(by="Pobre", table="train") + ")"))
def split_stratified(s: Survey) -> DataFrame:
    return sm.split_stratified(s.train.select("id", LABEL), "id", LABEL, 0.8, SEED)


@query(with_tables("select id, Pobre from (" + RANKED.format(by="Pobre", table="train") + ") where r>floor(n*0.7e0)"))
def split_complement(s: Survey) -> DataFrame:
    rows = s.train.select("id", LABEL)
    part = sm.split_stratified(rows, "id", LABEL, 0.7, SEED).filter("split = 'train'")
    return sm.complement(rows, part, "id")


@query(with_tables("select id, Pobre, cast(" + "+".join(f"(case when r-1>=(n*{j})//5 then 1 else 0 end)"
                                                       for j in range(1, 5)) + " as int) as fold from ("
                   + RANKED.format(by="Pobre", table="train") + ")"))
def kfold_stratified(s: Survey) -> DataFrame:
    return sm.folds(s.train.select("id", LABEL), "id", 5, LABEL, SEED)


@query(with_tables("select id, Pobre, Fex_c from (" + RANKED.format(by="Pobre", table="train")
                   + ") where r<=(select min(k) from (select count(*) as k from train group by Pobre))"))
def undersample_majority(s: Survey) -> DataFrame:
    return sm.undersample(s.train.select("id", LABEL, "Fex_c"), "id", LABEL, SEED)


@query(with_tables("select Pobre, count(*) as n, round((select count(*) from train)/(2.0e0*count(*)),6) as weight "
                   "from train group by Pobre"))
def class_weights(s: Survey) -> DataFrame:
    return rounded(sm.class_weights(s.train, LABEL), "weight")


MATCHED_SQL = f"""select id, Clase, P5000, P5090, P5100, P5130 from (
    select t.*, q.prop from ({RANKED.format(by=", ".join(KEYS), table="train")}) t left join (
      select {", ".join(KEYS)}, count(*)/cast(sum(count(*)) over (partition by {", ".join(KEYS[:-1])}) as double) as prop
      from test group by {", ".join(KEYS)}) q
    on {" and ".join(f"t.{k} is not distinct from q.{k}" for k in KEYS)}
  ) where r <= round_even(least(1.0e0, coalesce(prop, 1.0e0))*n, 0)"""


@query(with_tables(MATCHED_SQL))
def stratum_matched_sample(s: Survey) -> DataFrame:
    return sm.matched_sample(s.train.select("id", *KEYS), s.test.select("id", *KEYS), "id", KEYS, SEED)


# ---- imputation ------------------------------------------------------------------

GAPS = ["P5100", "P5130", "P5140"]
GAPS_R = ["alguno_universidad", "dummy_mayores_65", "jefe_mujer"]


def _medians(names: list[str], table: str = "train") -> str:
    return "(select " + ", ".join(f"median({n}) as m_{n}" for n in names) + f" from {table})"


@query(with_tables("select id, " + ", ".join(f"round(coalesce({n},m_{n}),6) as {n}" for n in GAPS)
                   + f" from test, {_medians(GAPS)}"))
def impute_median(s: Survey) -> DataFrame:
    fitted = i.fit_median(s.train, GAPS)
    return rounded(i.apply_fill(s.test.select("id", *GAPS), fitted), *GAPS)


JOBS = {1: "private", 2: "public", 4: "own"}
JOB_SQL = "cast(case P6430 when 1 then 'private' when 2 then 'public' when 4 then 'own' end as varchar)"


@query(with_tables(f"""select id, coalesce(job, m) as job, coalesce(P6210, e) as P6210 from
    (select id, {JOB_SQL} as job, P6210 from personas),
    (select job as m from (select {JOB_SQL} as job, count(*) as n from personas group by 1) where job is not null
      order by n desc, job limit 1),
    (select P6210 as e from (select P6210, count(*) as n from personas group by 1) where P6210 is not null
      order by n desc, P6210 limit 1)"""))
def impute_mode(s: Survey) -> DataFrame:
    rows = c.recode(s.persons.select("id", "P6430", "P6210"), "P6430", JOBS, "job").drop("P6430")
    return i.apply_fill(rows, i.fit_mode(rows, ["job", "P6210"]))


@query(with_tables(f"""select id, round(coalesce(P6800, a),6) as P6800, coalesce(job, m) as job from
    (select id, P6800, {JOB_SQL} as job from personas), (select avg(P6800) as a from personas),
    (select job as m from (select {JOB_SQL} as job, count(*) as n from personas group by 1) where job is not null
      order by n desc, job limit 1)"""))
def impute_mean_mode(s: Survey) -> DataFrame:
    rows = c.recode(s.persons.select("id", "P6800", "P6430"), "P6430", JOBS, "job").drop("P6430")
    return rounded(i.apply_fill(rows, i.fit_mean_or_mode(rows, ["P6800", "job"])), "P6800")


# ---- encoding ----------------------------------------------------------------------

# The numeric columns of the households.
NUMBERS = ["Clase", "Depto", "P5000", "P5010", "P5090", "P5100", "P5130", "P5140", "Nper", "Npersug", "Li", "Lp",
           "Fex_c", "Fex_dpto"]
SCALED = NUMBERS


@query(with_tables("select id, " + ", ".join(f"round(({n}-a_{n})/case when s_{n}=0 then 1 else s_{n} end,6) as {n}"
                                             for n in SCALED) + " from test, (select "
                   + ", ".join(f"avg({n}) as a_{n}, stddev_pop({n}) as s_{n}" for n in SCALED) + " from train)"))
def standard_scale(s: Survey) -> DataFrame:
    fitted = e.fit_scale(s.train, SCALED)
    return rounded(e.apply_scale(s.test.select("id", *SCALED), fitted), *SCALED)


def _hot(name: str, levels: list[object]) -> str:
    return ", ".join(f"cast(case when {name}='{v}' then 1 else 0 end as int) as {name}_{v}" for v in levels)


PRIORITIES = [1, 2, 3, 4, 5]
STATUSES = ["all_contributing", "all_pensioners", "mixed", "none", "other"]


@query(with_tables(f"select id, {_hot('P5090', PRIORITIES)}, {_hot('pension_status', STATUSES)} "
                   f"from ({ENHANCED_SQL}) where part='test'"))
def onehot_ignore_unknown(s: Survey) -> DataFrame:
    rows = ft.enhance(s.households, s.persons).select("id", "part", "P5090", "pension_status")
    train, test = rows.filter("part = 'train'"), rows.filter("part = 'test'").drop("part")
    return e.onehot_columns(test, {n: e.fit_levels(train, n) for n in ("P5090", "pension_status")})


@query(with_tables(f"select id, {_hot('P5090', PRIORITIES[1:])}, {_hot('pension_status', STATUSES[1:])} "
                   f"from ({ENHANCED_SQL}) where part='test'"))
def onehot_drop_first(s: Survey) -> DataFrame:
    rows = ft.enhance(s.households, s.persons).select("id", "part", "P5090", "pension_status")
    train, test = rows.filter("part = 'train'"), rows.filter("part = 'test'").drop("part")
    return e.onehot_columns(test, {n: e.fit_levels(train, n) for n in ("P5090", "pension_status")}, drop_first=True)


PIPED = [n for n in NUMBERS if n != "Clase"]
PIPED_TEXT = ["Dominio", "pension_status", "Clase"]
LEVEL_SQL = ", ".join(f"(select l from (select distinct v, dense_rank() over (order by v)-1 as l from (select "
                      f"coalesce(cast({n} as varchar),'missing') as v from enhanced where part='train')) q "
                      f"where q.v=coalesce(cast(e.{n} as varchar),'missing')) as {n}_level" for n in PIPED_TEXT)


@query(with_tables(f"""select id, {", ".join(f"round((coalesce({n},m_{n})-a_{n})/s_{n},6) as {n}" for n in PIPED)},
    {LEVEL_SQL} from enhanced e, (select {", ".join(f"avg(coalesce({n},m_{n})) as a_{n}, "
    f"stddev_pop(coalesce({n},m_{n})) as s_{n}" for n in PIPED)} from train, {_medians(PIPED)}), {_medians(PIPED)}
    where part='test'""", enhanced=ENHANCED_SQL))
def preprocess_pipeline(s: Survey) -> DataFrame:
    """Scaled numbers and the position of the hot entry in each category block."""
    rows = ft.enhance(s.households, s.persons).select("id", "part", *PIPED, *PIPED_TEXT)
    train, test = rows.filter("part = 'train'"), rows.filter("part = 'test'")
    fitted = e.fit_preprocessor(train, PIPED, PIPED_TEXT)
    parts = [F.round(F.col("v")[i], 6).alias(n) for i, n in enumerate(PIPED)]
    start = len(PIPED) + 1
    for name in PIPED_TEXT:
        block = F.slice("v", start, fitted.levels[name])
        parts.append((F.nullif(F.array_position(block, F.lit(1.0)), F.lit(0)) - 1).alias(f"{name}_level"))
        start += fitted.levels[name]
    return fitted.transform(test, ["id"]).select("id", vector_to_array("features").alias("v")).select("id", *parts)


# ---- preparation ----------------------------------------------------------------------

def _prepared(label: str) -> str:
    filled = ", ".join(f"round(coalesce({n},m_{n}),6) as {n}" for n in NUMBERS)
    return f"""select id, Dominio, {filled}, {label} as Pobre, part from hogares, {_medians(NUMBERS)}"""


@query(with_tables(_prepared("case when part='train' then Pobre end")))
def prepare_data(s: Survey) -> DataFrame:
    # Read by five jobs: the join of the source tables is done once.
    rows = materialize(s.households)
    fitted = pr.fit_prepare(rows.filter("part = 'train'").drop("part"))
    train = pr.apply_prepare(rows.filter("part = 'train'").drop("part"), fitted).withColumn("part", F.lit("train"))
    test = pr.apply_prepare(rows.filter("part = 'test'").drop("part", LABEL), fitted).withColumn("part", F.lit("test"))
    return rounded(train.unionByName(test), *NUMBERS)


@query(with_tables("select count(*) as n_rows, cast(15 as int) as n_columns, cast(sum("
                   + "+".join(f"case when {n} is null then 1 else 0 end" for n in [*NUMBERS, "ratio"])
                   + ") as bigint) as missing_cells, cast(sum(case when isinf(ratio) then 1 else 0 end) as bigint) "
                   "as infinite_cells from hogares left join (select id, coalesce(cast(count(case when P6040<15 or P6040>64 "
                   "then 1 end) as double)/nullif(count(case when P6040 between 15 and 64 then 1 end),0), "
                   "cast('inf' as double)) as ratio from personas group by id) using (id)"))
def ready_checks(s: Survey) -> DataFrame:
    """Rows, columns, missing and infinite cells of numeric columns before they are filled and replaced."""
    rows = ft.enhance(s.households, s.persons).select(*NUMBERS, "dependency_ratio")
    return pr.ready_checks(rows)


READY = [n for n in ENHANCED_NAMES if n not in ("part", *LEAKY, *SPARSE)]
READY_SQL = ", ".join(filled_sql(n) for n in READY)


@query(with_tables(f"select id, {READY_SQL} from ({ENHANCED_SQL}) where part='train'"))
def ready_table(s: Survey) -> DataFrame:
    rows = c.replace_infinite(ft.enhance(s.households, s.persons), ["dependency_ratio"])
    train = rows.filter("part = 'train'").drop("part")
    test = c.drop_columns(rows.filter("part = 'test'"), ["part", LABEL, *LEAKY])
    return rounded(pr.ready_table(train, test), *FRACTIONS)
