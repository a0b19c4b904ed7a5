"""Queries over metrics and distribution tests.

The scores come from a column expression, so SQL can compute the same ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthspark.operators import drift as d
from hearthspark.operators import features as ft
from hearthspark.operators import metrics as m
from hearthspark.operators import sampling as sm
from hearthspark.operators.impute import apply_fill, fit_mean
from hearthspark.plans.feature_queries import SECOND_SET_SQL, rounded
from hearthspark.plans.registry import query, with_tables
from hearthspark.plans.sampling_queries import MATCHED_SQL
from hearthspark.plans.table_queries import KEYS, SEED
from hearthspark.sources.survey import Survey

CUT = 0.8
PREDICTED = f"(select id, label, score, case when score>{CUT}e0 then 1 else 0 end as prediction from scored)"


def _rates(hits: str, predicted: str, actual: str) -> str:
    return f"""case when {predicted}=0 then 0.0e0 else cast({hits} as double)/{predicted} end as precision,
      case when {actual}=0 then 0.0e0 else cast({hits} as double)/{actual} end as recall"""


F1 = "case when precision+recall=0 then 0.0e0 else 2*precision*recall/(precision+recall) end"
ROUNDED = f"round(precision,6) as precision, round(recall,6) as recall, round({F1},6) as f1"


@query(with_tables(f"select * from {PREDICTED}"))
def apply_cutoff(s: Survey) -> DataFrame:
    return m.apply_cutoff(s.scored, CUT)


@query(with_tables(f"select a.v as actual, b.v as predicted, (select count(*) from {PREDICTED} where label=a.v and "
                   "prediction=b.v) as n from (values (0),(1)) a(v), (values (0),(1)) b(v)"))
def confusion_matrix(s: Survey) -> DataFrame:
    return m.confusion_matrix(m.apply_cutoff(s.scored, CUT))


@query(with_tables(f"""select positive, {ROUNDED} from (select positive, {_rates('hits', 'predicted', 'actual')} from (
    select v as positive, count(case when label=v and prediction=v then 1 end) as hits,
      count(case when prediction=v then 1 end) as predicted, count(case when label=v then 1 end) as actual
    from {PREDICTED}, (values (0),(1)) c(v) group by v))"""))
def f1_score(s: Survey) -> DataFrame:
    predicted = m.apply_cutoff(s.scored, CUT)
    parts = [m.scores(predicted, v).withColumn("positive", F.lit(v)) for v in (0, 1)]
    return rounded(parts[0].unionByName(parts[1]), "precision", "recall", "f1")


@query(with_tables(f"""select class, round(precision,6) as precision, round(recall,6) as recall, round(f1,6) as f1,
    cast(support as bigint) as support from (
    select class, precision, recall, f1, support from classes
    union all select 'accuracy', null, null, sum(hits)/cast(sum(support) as double), sum(support) from classes
    union all select 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) from classes
    union all select 'weighted avg', sum(precision*support)/sum(support), sum(recall*support)/sum(support),
      sum(f1*support)/sum(support), sum(support) from classes)""",
    classes=f"""select class, precision, recall, {F1} as f1, actual as support, hits from (
      select class, hits, actual, {_rates('hits', 'predicted', 'actual')} from (
        select cast(v as varchar) as class, count(case when label=v and prediction=v then 1 end) as hits,
          count(case when prediction=v then 1 end) as predicted, count(case when label=v then 1 end) as actual
        from {PREDICTED}, (values (0),(1)) c(v) group by v))"""))
def classification_report(s: Survey) -> DataFrame:
    return rounded(m.classification_report(m.apply_cutoff(s.scored, CUT)), "precision", "recall", "f1")


@query(with_tables("""select round(sum(pos*(cum-neg+neg/2.0e0))/(sum(pos)*cast(sum(neg) as double)),6) as auc,
    cast(sum(pos) as bigint) as n_pos, cast(sum(neg) as bigint) as n_neg from (
    select score, pos, neg, sum(neg) over (order by score) as cum from (select score, sum(label) as pos,
      count(*)-sum(label) as neg from scored group by score))"""))
def roc_auc(s: Survey) -> DataFrame:
    return rounded(m.roc_auc(s.scored), "auc")


SWEEP = f"""(select threshold, precision, recall, {F1} as f1 from (select threshold,
    {_rates('hits', 'predicted', 'actual')} from (select threshold, count(case when label=1 and score>threshold then 1 end)
    as hits, count(case when score>threshold then 1 end) as predicted, count(case when label=1 then 1 end) as actual
    from scored, (select i/100.0e0 as threshold from range(10, 91) r(i)) group by threshold)))"""


@query(with_tables(f"select threshold, round(precision,6) as precision, round(recall,6) as recall, round(f1,6) as f1 "
                   f"from {SWEEP}"))
def threshold_sweep(s: Survey) -> DataFrame:
    return rounded(m.threshold_table(s.scored, m.cutoffs(10, 90)), "precision", "recall", "f1")


@query(with_tables(f"select threshold, round(precision,6) as precision, round(recall,6) as recall, round(f1,6) as f1 "
                   f"from {SWEEP} order by f1 desc, threshold limit 1"))
def best_cutoff(s: Survey) -> DataFrame:
    table = m.threshold_table(s.scored, m.cutoffs(10, 90))
    return rounded(m.best_threshold(table), "precision", "recall", "f1")


CURVE = """(select score as threshold, precision, recall, 2*precision*recall/(precision+recall+1e-8) as f1 from (
    select score, cast(hits as double)/predicted as precision, cast(hits as double)/(select sum(label) from scored)
      as recall from (
      select score, sum(pos) over (order by score desc) as hits, sum(n) over (order by score desc) as predicted
      from (select score, sum(label) as pos, count(*) as n from scored group by score))))"""


@query(with_tables(f"select round(threshold,9) as threshold, round(precision,6) as precision, round(recall,6) as recall, "
                   f"round(f1,6) as f1 from {CURVE}"))
def pr_curve(s: Survey) -> DataFrame:
    curve = m.precision_recall_curve(s.scored)
    return rounded(curve.withColumn("threshold", F.round("threshold", 9)), "precision", "recall", "f1")


@query(with_tables(f"select round(threshold,9) as threshold, round(precision,6) as precision, round(recall,6) as recall, "
                   f"round(f1,6) as f1 from {CURVE} c order by round(c.f1,12) desc, c.threshold limit 1"))
def pr_curve_best(s: Survey) -> DataFrame:
    best = m.best_threshold(m.precision_recall_curve(s.scored), digits=12)
    return rounded(best.withColumn("threshold", F.round("threshold", 9)), "precision", "recall", "f1")


# ---- distribution tests -----------------------------------------------------------

TESTED = ["Clase", "Depto", "P5000", "P5010", "P5090", "P5100", "P5130", "P5140", "Nper", "Npersug", "Li", "Lp",
          "Fex_c", "Fex_dpto"]

ODD_TERMS = "+".join(f"exp(-pi()*pi()/8*{(2 * k - 1) ** 2}/(x*x))" for k in range(1, 21))
TAIL_TERMS = "".join(f"{'+' if k % 2 else '-'}2.0e0*exp(-2.0e0*{k * k}*x*x)" for k in range(1, 21))
KS_SQL = f"""select variable, d, n_a, n_b, case when x<0.04e0 then 1.0e0
      when x<1 then 1-sqrt(2*pi())/x*({ODD_TERMS}) else greatest(0.0e0, {TAIL_TERMS}) end as p_value
  from (select *, sqrt(cast(n_a as double)*n_b/(n_a+n_b))*d as x from (
    select variable, max(abs(ca/cast(n_a as double)-cb/cast(n_b as double))) as d, max(n_a) as n_a, max(n_b) as n_b
    from (select variable, value, sum(a) over w as ca, sum(b) over w as cb,
        sum(a) over (partition by variable) as n_a, sum(b) over (partition by variable) as n_b
      from (select variable, value, count(case when side=0 then 1 end) as a, count(case when side=1 then 1 end) as b
        from long where value is not null group by variable, value)
      window w as (partition by variable order by value)) group by variable))"""
KS_LONG = " union all ".join(
    f"select '{n}' as variable, cast({n} as double) as value, {mark} as side from {table}"
    for n in TESTED for mark, table in enumerate(("train", "test")))


@query(with_tables(f"select variable, round(d,9) as d, cast(n_a as bigint) as n_a, cast(n_b as bigint) as n_b, "
                   f"round(p_value,6) as p_value from ({KS_SQL})", long=KS_LONG))
def ks_two_sample(s: Survey) -> DataFrame:
    table = d.kolmogorov_smirnov(s.train, s.test, TESTED)
    return rounded(table.withColumn("d", F.round("d", 9)), "p_value")


def _ks_long(train: str) -> str:
    return KS_LONG.replace(" from train", f" from {train}")


@query(with_tables(f"select variable, round(d,9) as d, cast(n_a as bigint) as n_a, cast(n_b as bigint) as n_b, "
                   f"round(p_value,6) as p_value from ({KS_SQL})",
                   imputed="select " + ", ".join(f"coalesce(cast({n} as double), (select avg({n}) from train)) as {n}"
                                                 for n in TESTED) + " from train", long=_ks_long("imputed")))
def ks_imputed(s: Survey) -> DataFrame:
    """Training columns with their means in missing cells against the test columns as they are."""
    filled = apply_fill(s.train.select(*TESTED), fit_mean(s.train, TESTED))
    table = d.kolmogorov_smirnov(filled, s.test, TESTED)
    return rounded(table.withColumn("d", F.round("d", 9)), "p_value")


@query(with_tables(f"select variable, round(d,9) as d, cast(n_a as bigint) as n_a, cast(n_b as bigint) as n_b, "
                   f"round(p_value,6) as p_value from ({KS_SQL})",
                   matched=f"select * from train where id in (select id from ({MATCHED_SQL}))", long=_ks_long("matched")))
def ks_matched(s: Survey) -> DataFrame:
    """A training sample with the strata of the test table against the test columns."""
    sample = sm.matched_sample(s.train.select("id", *TESTED), s.test.select("id", *KEYS), "id", KEYS, SEED)
    table = d.kolmogorov_smirnov(sample, s.test, TESTED)
    return rounded(table.withColumn("d", F.round("d", 9)), "p_value")


@query(with_tables(f"select variable, round(d,9) as d from ({KS_SQL}) order by d desc, variable limit 5", long=KS_LONG))
def top_drift_features(s: Survey) -> DataFrame:
    top = d.top_drift(d.kolmogorov_smirnov(s.train, s.test, TESTED), 5)
    return top.select("variable", F.round("d", 9).alias("d"))


def _moments(names: list[str], first: str, second: str) -> str:
    return " union all ".join(f"""select '{n}' as variable, (select avg({n}) from {first}) as m_a,
      (select var_samp({n})/count({n}) from {first}) as e_a, (select count({n}) from {first}) as n_a,
      (select avg({n}) from {second}) as m_b, (select var_samp({n})/count({n}) from {second}) as e_b,
      (select count({n}) from {second}) as n_b""" for n in names)


@query(with_tables("select variable, round((m_a-m_b)/sqrt(e_a+e_b),6) as t, "
                   "round((e_a+e_b)*(e_a+e_b)/(e_a*e_a/(n_a-1)+e_b*e_b/(n_b-1)),4) as df from ("
                   + _moments(TESTED, "train", "test") + ")"))
def welch_t_test(s: Survey) -> DataFrame:
    table = d.welch_t(s.train, s.test, TESTED, with_p=False)
    return rounded(table.withColumn("df", F.round("df", 4)), "t")


# The variables of the published comparison.
COMPARED = ["num_individuos", "num_individuos_menores_18", "num_individuos_mayores_65", "dummy_mayores_65",
            "jefe_mujer", "alguno_universidad", "porcentaje_laborando", "share_empleado_privado",
            "share_empleado_publico", "share_empleado_cuentapropia", "alimentos", "horas_total_bruto",
            "horas_promedio_bruto", "pension", "subsidio"]


def _summary(name: str, part: str) -> str:
    return (f"round((select 100.0e0*count({name})/count(*) from features where part='{part}'),6) as pct_present_{part}, "
            f"round_even((select avg({name}) from features where part='{part}'),2) as mean_{part}, "
            f"round_even((select stddev_samp({name}) from features where part='{part}'),2) as sd_{part}")


@query(with_tables(" union all ".join(f"select '{n}' as variable, {_summary(n, 'train')}, {_summary(n, 'test')}"
                                      for n in COMPARED), features=SECOND_SET_SQL))
def compare_summary(s: Survey) -> DataFrame:
    rows = ft.enhance_2(s.households, s.persons)
    table = d.compare_parts(rows, "part", COMPARED)
    return rounded(table.drop("p_value"), "pct_present_train", "pct_present_test")


# Two-sided tail of the t distribution by Simpson's rule on 4,000 intervals.
P_SQL = """select variable, round(greatest(0.0e0, 1-2*exp(lgamma((df+1)/2)-lgamma(df/2))/sqrt(df*pi())*abs(t)/12000.0e0*(
    select sum((case when i=0 or i=4000 then 1 when i%2=1 then 4 else 2 end)
      *power(1+(t*i/4000.0e0)*(t*i/4000.0e0)/df, -(df+1)/2)) from range(0,4001) r(i))),3) as p_value
  from (select variable, (m_a-m_b)/sqrt(e_a+e_b) as t,
    (e_a+e_b)*(e_a+e_b)/(e_a*e_a/(n_a-1)+e_b*e_b/(n_b-1)) as df from ({moments}))"""


@query(with_tables(P_SQL.format(moments=_moments(COMPARED, "ftrain", "ftest")), features=SECOND_SET_SQL,
                   ftrain="select * from features where part='train'", ftest="select * from features where part='test'"))
def compare_summary_p_values(s: Survey) -> DataFrame:
    rows = ft.enhance_2(s.households, s.persons)
    return d.compare_parts(rows, "part", COMPARED).select("variable", "p_value")
