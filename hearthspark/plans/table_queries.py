"""Queries over sources, columns, joins by key, profiles and order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthspark.operators import columns as c
from hearthspark.operators import features as ft
from hearthspark.operators import joins as j
from hearthspark.operators import ordering as o
from hearthspark.operators import profile as p
from hearthspark.plans.feature_queries import ENHANCED_SQL, FRACTIONS, SECOND_SET_SQL, rounded
from hearthspark.plans.registry import query, with_tables
from hearthspark.session import fresh_path
from hearthspark.sources.files import read_csv, write_csv
from hearthspark.sources.survey import HOUSEHOLD_COLUMNS, LABEL, LEAKY, PERSON_COLUMNS, Survey

TEST_COLUMNS = [n for n in HOUSEHOLD_COLUMNS if n not in (LABEL, *LEAKY, "part")]
# The columns a model of the survey starts from.
HOUSEHOLD_NAMES = ["id", "Clase", "Dominio", "P5000", "P5010", "P5090", "P5100", "P5130", "P5140", "Nper", "Npersug", "Li", "Lp", "Fex_c",
                   "Depto", "Fex_dpto", "Pobre"]
# Training and test households together, the latter without labels.
BOTH_SQL = ("select * from train union all select * replace (null as Pobre, null as Npobres, null as Indigente, "
            "null as Nindigentes) from test")
NULLABLE = [n for n in PERSON_COLUMNS if n not in ("id", "P6020", "P6040", "P6050", "Estrato1")]
SEED = 42
# The stated order of the persons of a household.
ORDER_SQL = ("l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_shipdate, l_discount, l_tax, "
             "l_returnflag, l_linestatus")


def md5_order(alias: str = "id", seed: int = SEED) -> str:
    return f"md5(concat_ws('|', cast({alias} as varchar), '{seed}'))"


# ---- sources -------------------------------------------------------------------

@query(with_tables("select * from hogares"))
def scan_csv_roundtrip(s: Survey) -> DataFrame:
    path = fresh_path(s.spark, "households-csv")
    write_csv(s.households, path)
    return read_csv(s.spark, path, s.households.schema)


@query(with_tables("select * from hogares"))
def scan_csv_reordered(s: Survey) -> DataFrame:
    """Written with its columns in reverse order and one more between them, read back by name."""
    path = fresh_path(s.spark, "households-csv")
    names = s.households.columns[::-1]
    write_csv(s.households.select(*names[:3], F.lit("x").alias("extra"), *names[3:]), path)
    return read_csv(s.spark, path, s.households.schema)


@query(with_tables("select id, Clase, Dominio, Fex_c from hogares order by id limit 10"))
def preview_head(s: Survey) -> DataFrame:
    return o.preview(s.households.select("id", "Clase", "Dominio", "Fex_c"), 10, ["id"])


@query(with_tables(f"select count(*) as n_rows, cast({len(PERSON_COLUMNS)} as int) as n_columns from personas"))
def table_shape(s: Survey) -> DataFrame:
    return p.shape(s.persons)


# ---- columns --------------------------------------------------------------------

@query(with_tables(f"select {', '.join(HOUSEHOLD_NAMES)} from train"))
def project_features(s: Survey) -> DataFrame:
    return c.project(s.train, HOUSEHOLD_NAMES)


@query(with_tables("select * exclude (part, id, Pobre) from train"))
def drop_columns(s: Survey) -> DataFrame:
    return c.drop_columns(s.train, ["id", LABEL])


@query(with_tables(f"select {', '.join(TEST_COLUMNS)}, Pobre from train"))
def common_columns(s: Survey) -> DataFrame:
    return c.common_columns(s.train, s.test, keep=[LABEL])


@query(with_tables("select * exclude (part, Npobres, Indigente, Nindigentes) from train"))
def drop_leaky(s: Survey) -> DataFrame:
    return c.drop_columns(s.train, LEAKY)


@query(with_tables("select * exclude (part, Pobre, Npobres, Indigente, Nindigentes), cast(null as int) as Pobre, "
                   "cast(null as int) as Npobres, cast(null as int) as Indigente, cast(null as int) as Nindigentes "
                   "from test"))
def align_schema(s: Survey) -> DataFrame:
    return c.align(s.test, s.train.schema)


@query(with_tables("select * exclude (part, Dominio) from train"))
def numeric_columns(s: Survey) -> DataFrame:
    return s.train.select(*c.numeric_names(s.train))


@query(with_tables(f"select * exclude (part) from ({BOTH_SQL}) where Pobre is not null"))
def filter_labeled(s: Survey) -> DataFrame:
    """The labelled rows of training and test households together; the latter have none."""
    return c.labeled(s.train.unionByName(s.test, allowMissingColumns=True), LABEL)


@query(with_tables("select id, P6040, P6090, P6210, P6240, P6920 from personas where P6090 is not null "
                   "and P6210 is not null and P6240 is not null and P6920 is not null"))
def dropna_rows(s: Survey) -> DataFrame:
    return c.drop_incomplete_rows(s.persons.select("id", "P6040", "P6090", "P6210", "P6240", "P6920"))


@query(with_tables("select * exclude (part, Pobre, Npobres, Indigente, Nindigentes) from test"))
def drop_all_null_columns(s: Survey) -> DataFrame:
    return c.drop_empty_columns(c.align(s.test, s.train.schema))


@query(with_tables("select id, " + ", ".join(f"coalesce({n},0) as {n}" for n in NULLABLE) + " from personas"))
def fill_constant(s: Survey) -> DataFrame:
    return c.fill_constant(s.persons.select("id", *NULLABLE), {n: 0 for n in NULLABLE})


def filled_sql(name: str) -> str:
    if name in ("pension_status", "Dominio", "part"):
        return f"coalesce({name},'0') as {name}"
    if name in ("is_female_headed", "has_health_insurance"):
        return f"coalesce({name},false) as {name}"
    return f"coalesce({name},0) as {name}"


ENHANCED_NAMES = [n for n in HOUSEHOLD_COLUMNS if n != "id"] + [f.name for f in ft.first_set()]


@query(with_tables(f"select id, {', '.join(filled_sql(n) for n in ENHANCED_NAMES)} from ({ENHANCED_SQL})"))
def fill_all(s: Survey) -> DataFrame:
    """Every column of the widened households, an infinite ratio counting as missing."""
    enhanced = c.replace_infinite(ft.enhance(s.households, s.persons), ["dependency_ratio"])
    return rounded(c.fill_all(enhanced), *FRACTIONS)


@query(with_tables("select id, round(Fex_c/1e6,12) as Fex_c, round(Li/1e6,12) as Li from hogares"))
def rescale_columns(s: Survey) -> DataFrame:
    scaled = c.rescale(s.households.select("id", "Fex_c", "Li"), ["Fex_c", "Li"])
    return c.per_column(scaled, ["Fex_c", "Li"], lambda n: F.round(n, 12))


DEPENDENCY_SQL = """select id, cast(count(case when P6040<15 or P6040>64 then 1 end) as double)
    /nullif(count(case when P6040 between 15 and 64 then 1 end),0) as ratio from personas group by id"""


@query(with_tables(f"select id, round(coalesce(ratio,-1.0e0),6) as dependency_ratio from ({DEPENDENCY_SQL})"))
def replace_infinite(s: Survey) -> DataFrame:
    features = ft.build_features(s.persons, [ft.dependency()])
    return rounded(c.replace_infinite(features, ["dependency_ratio"], -1.0), "dependency_ratio")


# ---- joins by key -----------------------------------------------------------------

@query(with_tables("select id, Clase, Fex_c, Pobre from train where Nper>2"))
def reattach_label(s: Survey) -> DataFrame:
    """The label on a part of the training rows that went without it."""
    return j.reattach_label(s.train.filter("Nper > 2").select("id", "Clase", "Fex_c"), s.train, LABEL)


@query(with_tables("select * exclude (part, Pobre, Npobres, Indigente, Nindigentes), Pobre, 0 as is_test from train "
                   "union all select * exclude (part, Pobre, Npobres, Indigente, Nindigentes), null, 1 from test"))
def union_tagged(s: Survey) -> DataFrame:
    return c.union_tagged(c.drop_columns(s.train, LEAKY), s.test, "is_test")


# ---- profiles -----------------------------------------------------------------------

def _missing_sql(names: list[str], table: str) -> str:
    return " union all ".join(
        f"select '{n}' as variable, 100.0e0*(count(*)-count({n}))/count(*) as pct_missing from {table}" for n in names
    )


@query(with_tables(f"select variable, round(pct_missing,6) as pct_missing from "
                   f"({_missing_sql(list(PERSON_COLUMNS), 'personas')})"))
def missing_percentage(s: Survey) -> DataFrame:
    return rounded(p.missing_percentage(s.persons), "pct_missing")


@query(with_tables(f"select variable, round(pct_missing,6) as pct_missing from "
                   f"({_missing_sql(list(PERSON_COLUMNS), 'personas')}) where pct_missing>0"))
def columns_with_missing(s: Survey) -> DataFrame:
    return rounded(p.columns_with_missing(s.persons), "pct_missing")


@query(with_tables("select cast(" + "+".join(f"(count(*)-count({n}))" for n in PERSON_COLUMNS)
                   + " as bigint) as missing_cells from personas"))
def missing_total(s: Survey) -> DataFrame:
    return p.missing_total(s.persons)


@query(with_tables(f"select count(*) as infinite_cells from ({DEPENDENCY_SQL}) where ratio is null"))
def infinite_total(s: Survey) -> DataFrame:
    features = ft.build_features(s.persons, [ft.dependency(), ft.mean_age()])
    return p.infinite_total(features, c.fractional_names(features))


DESCRIBED = [n for n in PERSON_COLUMNS if n != "id"]


@query(with_tables(" union all ".join(
    f"select '{n}' as variable, round(100.0e0*count({n})/count(*),6) as pct_present, "
    f"round_even(avg({n}),2) as mean, round_even(stddev_samp({n}),2) as sd from personas" for n in DESCRIBED)))
def describe_variables(s: Survey) -> DataFrame:
    return rounded(p.describe(s.persons, DESCRIBED), "pct_present")


@query(with_tables("select Pobre, count(*) as n from (select Pobre from train union all "
                   "select null from test) group by Pobre"))
def class_distribution(s: Survey) -> DataFrame:
    both = s.train.unionByName(s.test, allowMissingColumns=True)
    return p.class_distribution(both, LABEL)


@query(with_tables("select Estrato1, Pobre, count(*) as n, round(count(*)/cast(sum(count(*)) over "
                   "(partition by Estrato1) as double),6) as share from personas join train using (id) "
                   "group by Estrato1, Pobre"))
def stratum_label_share(s: Survey) -> DataFrame:
    people = s.persons.select("id", "Estrato1").join(s.train.select("id", LABEL), "id")
    return rounded(p.stratum_label_share(people, "Estrato1", LABEL), "share")


@query(with_tables("""select 'jefe_mujer' as category, round(avg(jefe_mujer),6) as average from first_rows
    union all select 'jefe_uni_female', round(avg(case when P6020=2 then jefe_uni end),6) from first_rows
    union all select 'jefe_uni_male', round(avg(case when P6020=1 then jefe_uni end),6) from first_rows""",
                   first_rows=f"""select id, P6020, jefe_mujer, jefe_uni from (select id, P6020, row_number() over (
    partition by id order by {ORDER_SQL}) as r from personas) join ({SECOND_SET_SQL}) using (id) where r=1"""))
def conditional_means(s: Survey) -> DataFrame:
    """University education of heads by the sex of the household's first listed person, whose row is the kept one."""
    heads = ft.build_features(s.persons, [*ft.null_aware_2(), *ft.head_2()])
    order = [n.strip() for n in ORDER_SQL.split(",")]
    kept = o.first_row_per_key(s.ordered_persons.select("id", "P6020", *order), "id", order).select("id", "P6020")
    heads = heads.join(kept, "id")
    female, male = F.col("P6020") == 2, F.col("P6020") == 1
    means = {"jefe_mujer": ("jefe_mujer", None), "jefe_uni_female": ("jefe_uni", female),
             "jefe_uni_male": ("jefe_uni", male)}
    return rounded(p.conditional_means(heads, means), "average")


@query(with_tables("select Clase, variable, value from (select Clase, cast(count(*) as double) as households, "
                   "round(avg(Fex_c),6) as weight, round(avg(cast(Pobre as double)),6) as poor from hogares "
                   "group by Clase) unpivot (value for variable in (households, weight, poor))"))
def unpivot_summary(s: Survey) -> DataFrame:
    summary = s.households.groupBy("Clase").agg(
        F.count(F.lit(1)).cast("double").alias("households"),
        F.round(F.avg("Fex_c"), 6).alias("weight"),
        F.round(F.avg(F.col(LABEL).cast("double")), 6).alias("poor"),
    )
    return p.unpivot(summary, ["Clase"], ["households", "weight", "poor"], "variable", "value")


KEYS = ["Clase", "P5000", "P5090", "P5100", "P5130"]


@query(with_tables("select Clase, P5000, P5090, P5100, P5130, count(*) as n, round(count(*)/cast(sum(count(*)) over "
                   "(partition by Clase, P5000, P5090, P5100) as double),6) as prop from test "
                   "group by Clase, P5000, P5090, P5100, P5130"))
def nested_proportions(s: Survey) -> DataFrame:
    return rounded(p.share_within(s.test, KEYS, KEYS[:-1]), "prop")


@query(with_tables("select count(distinct Pobre) as n_labels, cast(max(case when Pobre is null then 1 else 0 end) "
                   f"as int) as has_missing from ({BOTH_SQL})"))
def distinct_labels(s: Survey) -> DataFrame:
    return p.distinct_labels(s.train.unionByName(s.test, allowMissingColumns=True), LABEL)


# ---- order ---------------------------------------------------------------------------

@query(with_tables(f"select * exclude (r, {ORDER_SQL}) from (select *, row_number() over (partition by id order by "
                   f"{ORDER_SQL}) as r from personas) where r=1"))
def first_row_per_key(s: Survey) -> DataFrame:
    order = [n.strip() for n in ORDER_SQL.split(",")]
    return o.first_row_per_key(s.ordered_persons, "id", order).drop(*order)


@query(with_tables(f"select id, Clase, Pobre, row_number() over (partition by Clase, Pobre order by {md5_order()}) "
                   "as position from hogares"))
def row_number_in_group(s: Survey) -> DataFrame:
    return o.row_numbers(s.households.select("id", "Clase", LABEL), "position", "id", ["Clase", LABEL])


@query(with_tables(f"select id, Fex_c, row_number() over (order by {md5_order()}) as position from hogares"))
def shuffle_rows(s: Survey) -> DataFrame:
    return o.row_numbers(s.households.select("id", "Fex_c"), "position", "id")


@query(with_tables("select id, Fex_c from hogares order by Fex_c desc, id limit 10"))
def top_k(s: Survey) -> DataFrame:
    return o.top_k(s.households.select("id", "Fex_c"), "Fex_c", 10, "id")
