"""Household features: one grouped pass over the persons.

A ``Feature`` names the partial aggregates it needs and how to finish them.
Features of one request share their partials, so any number of features costs
one shuffle of map-side combined rows, and a household with very many persons
shrinks to one row per map task before it travels.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthspark.functions.nulls import (
    any_three_valued,
    any_two_valued,
    members,
    or_zero,
    safe_ratio,
    share_of_all,
    share_of_known,
)

# Answer codes of the survey questionnaire. Other answers are counted too, only less directly.
ACTIVITY_CODES = (1, 2, 3, 4, 5, 6)
INSURANCE_CODES = (1, 2, 3, 9)
WORKING, SEEKING = 1, 2
CONTRIBUTES, NO_PENSION, PENSIONER = 1, 2, 3
UNIVERSITY = 6
SUBSIDIES = {
    "P6585s1": "has_food_subsidy",
    "P6585s2": "has_transport_subsidy",
    "P6585s3": "has_family_subsidy",
    "P6585s4": "has_school_subsidy",
}


@dataclass(frozen=True)
class Feature:
    """``parts`` builds partial aggregates by name; ``finish`` combines them."""

    name: str
    parts: Callable[[], dict[str, Column]]
    finish: Callable[[], Column] | None = None
    # Value for a household that has no person rows; None leaves NULL.
    absent: object = field(default=None)
    # By stem an answer and the codes that ``parts`` counts; any other answer is counted beside them.
    answers: Callable[[], dict[str, tuple[Column, Sequence[int]]]] = dict

    def value(self) -> Column:
        return self.finish() if self.finish else F.col(self.name)


def build_features(persons: DataFrame, features: Iterable[Feature], key: str = "id") -> DataFrame:
    chosen = list(features)
    parts: dict[str, Column] = {}
    answers: dict[str, tuple[Column, Sequence[int]]] = {}
    for feature in chosen:
        parts.update(feature.parts())
        answers.update(feature.answers())
    grouped = persons.groupBy(key).agg(*[column.alias(name) for name, column in parts.items()])
    if answers:
        grouped = grouped.join(unlisted_counts(persons, answers, key), F.col(key).eqNullSafe(F.col("_key")), "left")
    return grouped.select(key, *[feature.value().alias(feature.name) for feature in chosen])


def unlisted_counts(persons: DataFrame, answers: dict[str, tuple[Column, Sequence[int]]], key: str) -> DataFrame:
    """Per household an array of (stem, code, n) over the answers outside the code lists.

    Counted per (household, answer) first, so that a household is no more rows
    than it has different answers. Usually there are none, and the join with
    an empty side is dropped while it runs.
    """
    entries = [F.when(answer.isNotNull() & ~answer.isin(*codes), F.struct(
        F.lit(stem).alias("stem"), answer.cast("long").alias("code"))) for stem, (answer, codes) in answers.items()]
    odd = persons.select(F.col(key).alias("_key"), F.explode(F.array_compact(F.array(*entries))).alias("_entry"))
    counted = odd.groupBy("_key", "_entry").agg(F.count(F.lit(1)).alias("n"))
    return counted.groupBy("_key").agg(
        F.collect_list(F.struct("_entry.stem", "_entry.code", "n")).alias("_unlisted"))


def single(name: str, make: Callable[[], Column], absent: object = None) -> Feature:
    return Feature(name, lambda: {name: make()}, None, absent)


def any_code(name: str, column: str, code: int, absent: object = None) -> Feature:
    """1 if any member gave the code, missing answers counting as no."""
    return single(name, lambda: any_two_valued(F.col(column) == code), absent)


# ---- answers with a short code list: counts per code, in the same pass --------

def _code_counts(column: str, codes: Sequence[int], where: Callable[[], Column] | None = None,
                 prefix: str | None = None) -> dict[str, Column]:
    stem = prefix or column
    answer = F.col(column) if where is None else F.when(where(), F.col(column))
    return {f"{stem}_{code}": F.count_if(answer == code) for code in codes}


def _unlisted(stem: str) -> Column:
    """(code, n) of the household's answers outside the list, an empty array mostly."""
    own = F.filter("_unlisted", lambda e: e["stem"] == stem)
    return F.coalesce(own, F.array().cast("array<struct<stem:string,code:bigint,n:bigint>>"))


def _most_frequent(stem: str, codes: Sequence[int]) -> Column:
    """Smallest code with the top count; 0 where nobody answered."""
    counts = {code: F.col(f"{stem}_{code}") for code in sorted(codes)}
    top = F.greatest(*counts.values())
    pick = F.coalesce(*[F.when((n == top) & (top > 0), F.lit(code)) for code, n in counts.items()], F.lit(0))
    listed = F.struct((-top).alias("minus"), pick.cast("long").alias("code"))
    others = F.transform(_unlisted(stem), lambda e: F.struct((-e["n"]).alias("minus"), e["code"].alias("code")))
    among = F.array_min(F.concat(F.array(listed), others))["code"].cast("int")
    return F.when(F.col("_unlisted").isNull(), pick).otherwise(among)


def _simpson(stem: str, codes: Sequence[int]) -> Column:
    """1 minus the sum of squared shares; 0 where nobody answered."""
    counts = [F.col(f"{stem}_{code}").cast("double") for code in codes]
    total, squares = counts[0], counts[0] * counts[0]
    for n in counts[1:]:
        total, squares = total + n, squares + n * n
    others = F.transform(_unlisted(stem), lambda e: e["n"].cast("double"))
    total = total + F.aggregate(others, F.lit(0.0), lambda a, n: a + n)
    squares = squares + F.aggregate(others, F.lit(0.0), lambda a, n: a + n * n)
    return F.coalesce(F.lit(1.0) - F.try_divide(squares, total * total), F.lit(0.0))


def _seeking_share(stem: str) -> Column:
    seeking, working = F.col(f"{stem}_{SEEKING}"), F.col(f"{stem}_{WORKING}")
    return F.coalesce(safe_ratio(seeking, seeking + working), F.lit(0.0))


# ---- first feature set ---------------------------------------------------------

def mean_age() -> Feature:
    return single("mean_age_household", lambda: F.avg("P6040"))


def social_program() -> Feature:
    return any_code("has_social_program", "P6090", 1, absent=0)


def education_sum() -> Feature:
    def build() -> Column:
        level = F.greatest(F.lit(0), F.col("P6210").cast("int") - 1)
        return F.sum(F.when(F.col("P6210").isNull(), F.lit(0)).otherwise(level))

    return single("educ_attainment", build, absent=0)


def activity(codes: Sequence[int] = ACTIVITY_CODES) -> list[Feature]:
    stem = "P6240"
    codes = sorted({*codes, WORKING, SEEKING})

    def parts() -> dict[str, Column]:
        return _code_counts(stem, codes)

    def answers() -> dict[str, tuple[Column, Sequence[int]]]:
        return {stem: (F.col(stem), codes)}

    return [
        Feature("P6240_someone_works", parts, lambda: (F.col(f"{stem}_{WORKING}") > 0).cast("int"), 0),
        Feature("P6240_unemployment_rate", parts, lambda: _seeking_share(stem), 0),
        Feature("P6240_main_household_activity", parts, lambda: _most_frequent(stem, codes), 0, answers),
        Feature("P6240_activity_diversity", parts, lambda: _simpson(stem, codes), 0, answers),
    ]


def subsidies() -> list[Feature]:
    flags = [any_code(name, column, 1) for column, name in SUBSIDIES.items()]

    def parts() -> dict[str, Column]:
        return {name: column for flag in flags for name, column in flag.parts().items()}

    def total() -> Column:
        first, *rest = [F.col(name) for name in SUBSIDIES.values()]
        for one in rest:
            first = first + one
        return first

    return [*flags, Feature("total_subsidies", parts, total)]


def pension() -> list[Feature]:
    """Missing answers count as "no pension" unless the whole household is missing."""

    def parts() -> dict[str, Column]:
        answer = F.col("P6920")
        return {
            "members": members(),
            "pension_known": F.count(answer),
            "pension_contributes": F.count_if(answer == CONTRIBUTES),
            "pension_none": F.count_if(F.coalesce(answer, F.lit(NO_PENSION)) == NO_PENSION),
            "pension_pensioner": F.count_if(answer == PENSIONER),
        }

    def known(value: Column) -> Column:
        return F.when(F.col("pension_known") > 0, value)

    def share(part: str) -> Callable[[], Column]:
        return lambda: known(F.col(part) / F.col("members"))

    def flag(part: str) -> Callable[[], Column]:
        return lambda: known((F.col(part) > 0).cast("int"))

    def status() -> Column:
        n, paying = F.col("members"), F.col("pension_contributes")
        without, retired = F.col("pension_none"), F.col("pension_pensioner")
        return known(
            F.when((paying > 0) & ((without > 0) | (retired > 0)), "mixed")
            .when(paying == n, "all_contributing")
            .when(retired == n, "all_pensioners")
            .when(without == n, "none")
            .otherwise("other")
        )

    return [
        Feature("has_pension_contributor", parts, flag("pension_contributes")),
        Feature("has_pensioner", parts, flag("pension_pensioner")),
        Feature("prop_pension_contributors", parts, share("pension_contributes")),
        Feature("prop_pensioners", parts, share("pension_pensioner")),
        Feature("pension_status", parts, status),
    ]


def dependency() -> Feature:
    """Members under 15 or over 64 per member of working age; +inf without any."""

    def parts() -> dict[str, Column]:
        age = F.col("P6040")
        return {
            "dependants": F.count_if((age < 15) | (age > 64)),
            "working_age": F.count_if(age.between(15, 64)),
        }

    def finish() -> Column:
        return F.coalesce(safe_ratio(F.col("dependants"), F.col("working_age")), F.lit(float("inf")))

    return Feature("dependency_ratio", parts, finish)


def female_head() -> Feature:
    return Feature(
        "is_female_headed",
        lambda: {"is_female_headed": any_two_valued((F.col("P6050") == 1) & (F.col("P6020") == 2))},
        lambda: F.col("is_female_headed") == 1,
    )


def insurance(codes: Sequence[int] = INSURANCE_CODES) -> list[Feature]:
    def insured() -> Column:
        return F.col("P6090") == 1

    return [
        Feature("has_health_insurance", lambda: {"n_insured": F.count_if(insured())},
                lambda: F.col("n_insured") > 0),
        Feature("main_insurance_type", lambda: _code_counts("P6100", codes, insured, "insured_type"),
                lambda: _most_frequent("insured_type", codes),
                answers=lambda: {"insured_type": (F.when(insured(), F.col("P6100")), codes)}),
        single("insurance_coverage_rate", lambda: share_of_all(insured())),
    ]


def ages() -> list[Feature]:
    return [
        single("household_size", members),
        single("num_individuals", members),
        single("num_under_18", lambda: F.count_if(F.col("P6040") < 18)),
        single("num_over_65", lambda: F.count_if(F.col("P6040") > 65)),
        single("has_over_65", lambda: any_two_valued(F.col("P6040") > 65)),
    ]


def university() -> Feature:
    return any_code("has_university_education", "P6210", UNIVERSITY)


def food_payment() -> Feature:
    return any_code("receives_food_payment", "P6590", 1)


def first_set(activity_codes: Sequence[int] = ACTIVITY_CODES,
              insurance_codes: Sequence[int] = INSURANCE_CODES) -> list[Feature]:
    return [
        mean_age(), social_program(), education_sum(), *activity(activity_codes), *subsidies(), *pension(),
        *ages(), dependency(), female_head(), *insurance(insurance_codes), university(), food_payment(),
    ]


def join_features(households: DataFrame, features: DataFrame, chosen: Iterable[Feature],
                  key: str = "id") -> DataFrame:
    """Households with their features; both sides hold one row per household."""
    joined = households.join(features, key, "left")
    filled = {f.name: F.coalesce(F.col(f.name), F.lit(f.absent)) for f in chosen if f.absent is not None}
    return joined.withColumns(filled) if filled else joined


def enhance(households: DataFrame, persons: DataFrame, key: str = "id", **codes) -> DataFrame:
    """Households widened by the whole first feature set."""
    chosen = first_set(**codes)
    return join_features(households, build_features(persons, chosen, key), chosen, key)


# ---- open code domains -----------------------------------------------------------

def answer_mode(persons: DataFrame, column: str, name: str, key: str = "id",
                where: Column | None = None) -> DataFrame:
    """Most frequent answer per household for any domain; lowest on ties, 0 if none.

    Counts per (household, answer) first, so a huge household is a few rows
    by the time it is compared.
    """
    answer = F.col(column) if where is None else F.when(where, F.col(column))
    answers = persons.select(key, answer.alias("answer"))
    counts = answers.groupBy(key, "answer").agg(F.count("answer").alias("n"))
    best = F.min_by("answer", F.when(F.col("n") > 0, F.struct(-F.col("n"), F.col("answer"))))
    return counts.groupBy(key).agg(or_zero(best).alias(name))


def answer_diversity(persons: DataFrame, column: str, name: str, key: str = "id") -> DataFrame:
    """1 minus the sum of squared answer shares per household, for any domain."""
    counts = persons.groupBy(key, column).agg(F.count(column).cast("double").alias("n"))
    total = F.sum("n")
    value = F.lit(1.0) - F.try_divide(F.sum(F.col("n") * F.col("n")), total * total)
    return counts.groupBy(key).agg(F.coalesce(value, F.lit(0.0)).alias(name))


# ---- second feature set ------------------------------------------------------------

def _head() -> Column:
    return F.col("P6050") == 1


def _known_flag(name: str, condition: Callable[[], Column]) -> Feature:
    return single(name, lambda: any_three_valued(condition()))


def _percent(name: str, condition: Callable[[], Column]) -> Feature:
    return single(name, lambda: share_of_known(condition()) * 100)


def counts_2() -> list[Feature]:
    return [
        single("num_individuos", members),
        single("num_individuos_menores_18", lambda: F.count_if(F.col("P6040") < 18)),
        single("num_individuos_mayores_65", lambda: F.count_if(F.col("P6040") > 65)),
    ]


def null_aware_2() -> list[Feature]:
    return [
        _known_flag("dummy_mayores_65", lambda: F.col("P6040") > 65),
        _known_flag("jefe_mujer", lambda: _head() & (F.col("P6020") == 2)),
        _known_flag("alguno_universidad", lambda: F.col("P6210") == UNIVERSITY),
    ]


def head_2() -> list[Feature]:
    # "jefe_pension" reads the health affiliation answer; the published formula is kept.
    return [
        single("jefe_pension", lambda: any_two_valued(_head() & (F.col("P6090") == 2))),
        single("jefe_uni", lambda: any_two_valued(_head() & (F.col("P6210") == UNIVERSITY))),
    ]


def employment_2() -> list[Feature]:
    def works() -> Column:
        return F.col("P6240") == WORKING

    kinds = {"share_empleado_privado": 1, "share_empleado_publico": 2, "share_empleado_cuentapropia": 4}
    return [
        _percent("porcentaje_laborando", works),
        *[_percent(name, lambda code=code: works() & (F.col("P6430") == code)) for name, code in kinds.items()],
    ]


def flags_2() -> list[Feature]:
    answers = {"alimentos": "P6590", "pension": "P6920", "subempleo_cap": "P7150",
               "recibir_pension": "P7495", "subsidio": "P7510s3"}
    return [any_code(name, column, 1) for name, column in answers.items()]


def hours_2() -> list[Feature]:
    return [
        single("horas_total_bruto", lambda: or_zero(F.sum("P6800"))),
        single("horas_promedio_bruto", lambda: F.coalesce(F.avg("P6800"), F.lit(0.0))),
    ]


def second_set() -> list[Feature]:
    return [*counts_2(), *null_aware_2(), *head_2(), *employment_2(), *flags_2(), *hours_2()]


def housing_flags(table: DataFrame) -> DataFrame:
    """Own dwelling and bedrooms per room, from household columns already joined on.

    Both are constant inside a household, so they need no grouping.
    """
    rooms = F.when(F.col("P5000") > 0, safe_ratio(F.col("P5010"), F.col("P5000")))
    return table.withColumns({
        "casa_propia": F.coalesce((F.col("P5090") == 1).cast("int"), F.lit(0)),
        "cuartospersona": F.coalesce(rooms, F.lit(0.0)),
    })


def enhance_2(households: DataFrame, persons: DataFrame, key: str = "id") -> DataFrame:
    """One row per household that has persons, with the whole second feature set."""
    features = build_features(persons, second_set(), key)
    return housing_flags(features.join(households, key, "left"))
