"""Column rules that turn raw exam fields into canonical values."""

from __future__ import annotations

from decimal import Decimal
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from gradewell import types as t

GRADE_TYPE = "decimal(3,1)"

# --- fixed values: raw spellings and the value they stand for ----------------
BEST_GRADE_TYPO = "10"
BLANKS = "\t\n\f\r "
BEST, PASS_LIMIT, FAIL = Decimal("1.0"), Decimal("4.0"), Decimal("5.0")
NON_GRADES = ("0,0 mE", "02.01.1900", "angemeldet", "bestanden")
SUCCESS_REMARK = "mit Erfolg"
NOT_SITTING_REMARKS = ("krank", "nicht zugelassen")
NO_SHOW_REMARK = "unentschuldigt gefehlt"
REGISTERED_ONLY = "angemeldet"
YEAR_TYPO, YEAR_MEANT = 29, 19

# Module names that identify a numberless record, first match wins.
NUMBER_BY_NAME = (
    (("Wahlpflichtmodul (Ausnahme)", "Wahlpflichtmodul (anerkannt)"), t.ELECTIVE),
    (("Zusatzmodul",), t.ADDITIONAL),
    (("Forschungs-/Entwicklungsprojekt",), "I705"),
    (("Mathematische/Stochastische Modelle",), "I886"),
)
NUMBER_BY_WORD = {"Zusatzmodul": t.ADDITIONAL, "Wahlpflichtmodul": t.ELECTIVE}
# --- end of fixed values ------------------------------------------------------


def first_match(*arms: tuple[Column, object]) -> Column:
    """Value of the first arm whose condition is true, else NULL."""
    chain = F.when(arms[0][0], arms[0][1])
    for condition, value in arms[1:]:
        chain = chain.when(condition, value)
    return chain


def is_main_grade(module_name: Column) -> Column:
    """True for named modules without any partial-examination marker."""
    return reduce(lambda a, b: a & b, [~module_name.contains(m) for m in t.PARTIAL_EXAM_MARKERS])


def module_number(number: Column, name: Column) -> Column:
    by_name = [
        (number.isNull() & reduce(lambda a, b: a | b, [name.contains(n) for n in names]), F.lit(code))
        for names, code in NUMBER_BY_NAME
    ]
    by_word = [(number == word, F.lit(code)) for word, code in NUMBER_BY_WORD.items()]
    return first_match(*by_name, *by_word).otherwise(F.coalesce(number, F.lit(t.UNKNOWN_MODULE)))


def clean_grade(note: Column) -> Column:
    """Grade text without blanks and line ends; markers that are no grade give NULL."""
    return first_match(
        (note == BEST_GRADE_TYPO, F.lit("1,0")),
        (~note.isin(*NON_GRADES), F.translate(note, BLANKS, "")),
    )


def grade_numeric(cleaned: Column) -> Column:
    """Cleaned grade text as decimal(3,1), NULL where it is not a number."""
    return F.replace(cleaned, F.lit(","), F.lit(".")).try_cast(GRADE_TYPE)


def exam_status(note: Column, remark: Column, cleaned: Column, number: Column) -> Column:
    """Passed, failed or withdrawn; the order of the arms is the precedence."""
    no_grade = cleaned.isNull() | (cleaned == "")
    return first_match(
        (note == t.PASSED, t.PASSED),
        (no_grade & (remark == SUCCESS_REMARK), t.PASSED),
        (note.isNull() & remark.isNull(), t.WITHDRAWN),
        (remark.isin(*NOT_SITTING_REMARKS), t.WITHDRAWN),
        ((note == REGISTERED_ONLY) & remark.isNull(), t.WITHDRAWN),
        (remark == NO_SHOW_REMARK, t.FAILED),
        (number.between(BEST, PASS_LIMIT), t.PASSED),
        (number == FAIL, t.FAILED),
        (remark == t.WITHDRAWN, t.WITHDRAWN),
        (~no_grade, t.PASSED),
    )


def semester(raw: Column) -> Column:
    """Canonical spelling of the two terms; anything else is left as it is."""
    by_upper = [(F.upper(raw) == name.upper(), F.lit(name)) for name in t.SEMESTERS]
    return first_match(*by_upper).otherwise(raw)


def exam_year(raw: Column) -> Column:
    return first_match(
        (raw == YEAR_TYPO, F.lit(YEAR_MEANT).cast("bigint")),
        (raw.between(t.FIRST_YEAR, t.LAST_YEAR), raw.cast("bigint")),
    )


def clean_remark(note: Column, remark: Column) -> Column:
    """Canonical remark; a plain ``5`` keeps none but the no-show remark."""
    overridden = F.coalesce((note == "5") & (remark != NO_SHOW_REMARK), F.lit(False))
    return F.when(remark.isin(*t.REMARKS) & ~overridden, remark)


def in_domain(value: Column, domain: tuple[str, ...]) -> Column:
    """True for NULL and for the listed values."""
    return value.isNull() | value.isin(*domain)


def checked(value: Column, domain: tuple[str, ...], label: str) -> Column:
    """The value itself; a value outside its domain stops the job."""
    message = F.concat(F.lit(f"{label} outside its domain: "), value)
    return F.when(in_domain(value, domain), value).otherwise(F.raise_error(message).cast("string"))


def term_index(year: Column, semester_type: Column) -> Column:
    """Position on the term axis: summer before winter of the same year."""
    return year * 2 + F.when(semester_type == t.SUMMER, 1).otherwise(2)


def semester_order(semester_type: Column) -> Column:
    """Sort position of the term name in term tables (winter first)."""
    return F.when(semester_type == t.WINTER, 0).otherwise(1)


def term_date(year: Column, semester_type: Column) -> Column:
    """Nominal first day of a term: 1 March or 1 October."""
    month = first_match((semester_type == t.SUMMER, 3), (semester_type == t.WINTER, 10))
    return F.make_date((year + 2000).cast("int"), month, F.lit(1))


def regulations_year(year_of_matriculation: Column) -> Column:
    return F.when(year_of_matriculation < t.REGULATIONS[1], t.REGULATIONS[0]).otherwise(t.REGULATIONS[1])


def module_key(year: Column, semester_type: Column, number: Column, field: Column) -> Column:
    """Key parts joined by '-'; a missing part counts as an empty one."""
    parts = [F.coalesce(c.cast("string"), F.lit("")) for c in (year, semester_type, number, field)]
    return F.concat(parts[0], F.lit("-"), parts[1], F.lit("-"), parts[2], F.lit("-"), parts[3])
