"""Row rules declared as data, one rule set per source table."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from sparkmart import schemas as S
from sparkmart.functions import text as X

MESSAGES = {
    "REQUIRED": "a value is required",
    "REQUIRED_FOR_COURSEWORK": "coursework needs a due date",
    "TOO_LONG": "the value is too long",
    "INVALID_INTEGER": "the value is not a whole number",
    "INVALID_DECIMAL": "the value is not a number with at most two decimals",
    "SMALLINT_OUT_OF_RANGE": "the number does not fit 16 bits",
    "INTEGER_OUT_OF_RANGE": "the number does not fit 32 bits",
    "BIGINT_OUT_OF_RANGE": "the number does not fit 64 bits",
    "OUT_OF_RANGE": "the number is outside the allowed range",
    "NOT_POSITIVE": "the number must be above zero",
    "NEGATIVE": "the number must not be negative",
    "INVALID_VALUE": "the value is not in the list of allowed values",
    "INVALID_DATE_ORDER": "the end lies before the start",
    "INCOMPLETE_WEEK_RANGE": "start and end must be given together",
    "INVALID_WEEK_ORDER": "the last week lies before the first",
    "COURSE_NOT_FOUND": "no such module presentation",
    "STUDENT_NOT_FOUND": "no such student in the module presentation",
    "ASSESSMENT_NOT_FOUND": "no such assessment",
    "STUDENT_NOT_FOUND_FOR_ASSESSMENT": "the student does not take the module of the assessment",
    "SITE_NOT_FOUND": "no such site in the module presentation",
    "EXACT_DUPLICATE": "the row repeats an earlier valid row",
    "CONFLICTING_DUPLICATE": "the row contradicts an earlier valid row with the same key",
}


def text_of(name: str) -> Column:
    """Trimmed text of a source column."""
    return F.col(f"t_{name}")


def number_of(name: str) -> Column:
    """Exact parsed number, before it is narrowed."""
    return F.col(f"n_{name}")


def value_of(name: str) -> Column:
    """Typed value; NULL when the text does not hold one."""
    return F.col(f"v_{name}")


Check = tuple[str, Column]


@dataclass(frozen=True)
class Text:
    name: str
    max_length: int

    def text(self) -> Column:
        return X.blank_to_null(F.col(self.name))

    def number(self) -> Column | None:
        return None

    def value(self) -> Column:
        return text_of(self.name)

    def checks(self) -> list[Check]:
        t = text_of(self.name)
        return [("REQUIRED", t.isNull()), ("TOO_LONG", F.length(t) > self.max_length)]


@dataclass(frozen=True)
class Choice:
    name: str
    allowed: list[str]
    required: bool = True
    spellings: dict[str, str] = field(default_factory=dict)

    def text(self) -> Column:
        return X.canonical(X.blank_to_null(F.col(self.name)), self.spellings)

    def number(self) -> Column | None:
        return None

    def value(self) -> Column:
        return text_of(self.name)

    def checks(self) -> list[Check]:
        t = text_of(self.name)
        checks = [("REQUIRED", t.isNull())] if self.required else []
        return [*checks, ("INVALID_VALUE", ~t.isin(self.allowed))]


@dataclass(frozen=True)
class Integer:
    name: str
    width: str = "int"
    required: bool = True
    minimum: int | None = None
    allowed: list[int] | None = None
    required_when: tuple[str, list[str]] | None = None

    def text(self) -> Column:
        return X.blank_to_null(F.col(self.name))

    def number(self) -> Column | None:
        return X.parse_integer(text_of(self.name), self.width)

    def value(self) -> Column:
        return X.narrow(number_of(self.name), self.width)

    def checks(self) -> list[Check]:
        t, n = text_of(self.name), number_of(self.name)
        checks: list[Check] = []
        if self.required:
            checks.append(("REQUIRED", t.isNull()))
        if self.required_when:
            other, values = self.required_when
            checks.append(("REQUIRED_FOR_COURSEWORK", t.isNull() & text_of(other).isin(values)))
        checks.append(("INVALID_INTEGER", ~X.is_integer_text(t)))
        beyond = X.INTEGER_WIDTHS[self.width][3]
        checks.append((beyond, t.isNotNull() & (n.isNull() | ~X.within_width(n, self.width))))
        if self.minimum == 1:
            checks.append(("NOT_POSITIVE", n < 1))
        elif self.minimum == 0:
            checks.append(("NEGATIVE", n < 0))
        if self.allowed:
            checks.append(("INVALID_VALUE", ~n.isin(self.allowed)))
        return checks


@dataclass(frozen=True)
class Decimal:
    name: str
    low: int
    high: int
    required: bool = True

    def text(self) -> Column:
        return X.blank_to_null(F.col(self.name))

    def number(self) -> Column | None:
        return X.parse_decimal(text_of(self.name))

    def value(self) -> Column:
        return X.narrow(number_of(self.name), "decimal(5,2)")

    def checks(self) -> list[Check]:
        t, n = text_of(self.name), number_of(self.name)
        checks = [("REQUIRED", t.isNull())] if self.required else []
        return [
            *checks,
            ("INVALID_DECIMAL", ~X.is_decimal_text(t)),
            ("OUT_OF_RANGE", t.isNotNull() & (n.isNull() | ~n.between(self.low, self.high))),
        ]


@dataclass(frozen=True)
class Span:
    """Two columns that form a range."""

    start: str
    end: str
    order_code: str
    incomplete_code: str | None = None

    @property
    def name(self) -> str:
        return f"{self.start}, {self.end}"

    def checks(self) -> list[Check]:
        checks: list[Check] = []
        if self.incomplete_code:
            one_sided = text_of(self.start).isNull() != text_of(self.end).isNull()
            checks.append((self.incomplete_code, one_sided))
        return [*checks, (self.order_code, value_of(self.end) < value_of(self.start))]


@dataclass(frozen=True)
class Reference:
    """Key that must exist in a clean table.

    ``keys`` maps columns of the reference to working columns of the row;
    ``carry`` keeps reference columns as ``r_<name>`` for later references.
    """

    table: str
    keys: dict[str, str]
    code: str
    label: str
    carry: tuple[str, ...] = ()


@dataclass(frozen=True)
class Duplicates:
    """Rows after the first valid one of a key; without ``signature`` the key is the row."""

    keys: tuple[str, ...]
    signature: tuple[str, ...] = ()

    @property
    def label(self) -> str:
        return ", ".join(self.keys)


@dataclass(frozen=True)
class RuleSet:
    fields: tuple
    spans: tuple[Span, ...] = ()
    references: tuple[tuple[Reference, ...], ...] = ()
    duplicates: Duplicates | None = None


_MODULE = Text("code_module", 3)
_PRESENTATION = Text("code_presentation", 5)
_COURSE = ("code_module", "code_presentation")


def _course_reference() -> Reference:
    return Reference(
        "courses", {c: f"v_{c}" for c in _COURSE}, "COURSE_NOT_FOUND", ", ".join(_COURSE)
    )


def _student_reference() -> Reference:
    return Reference(
        "student_info",
        {c: f"v_{c}" for c in ("id_student", *_COURSE)},
        "STUDENT_NOT_FOUND",
        ", ".join((*_COURSE, "id_student")),
    )


RULES: dict[str, RuleSet] = {
    "courses": RuleSet(
        fields=(_MODULE, _PRESENTATION, Integer("module_presentation_length", minimum=1)),
        duplicates=Duplicates(_COURSE, ("module_presentation_length",)),
    ),
    "student_info": RuleSet(
        fields=(
            _MODULE,
            _PRESENTATION,
            Integer("id_student", "bigint", minimum=1),
            Choice("gender", S.GENDERS),
            Choice("region", S.REGIONS),
            Choice("highest_education", S.EDUCATIONS),
            Choice("imd_band", S.IMD_BANDS, required=False, spellings=S.IMD_CANONICAL),
            Choice("age_band", S.AGE_BANDS),
            Integer("num_of_prev_attempts", minimum=0),
            Integer("studied_credits", minimum=1),
            Choice("disability", S.DISABILITIES),
            Choice("final_result", S.RESULTS),
        ),
        references=((_course_reference(),),),
        duplicates=Duplicates((*_COURSE, "id_student"), tuple(S.SOURCE_COLUMNS["student_info"][3:])),
    ),
    "student_registration": RuleSet(
        fields=(
            _MODULE,
            _PRESENTATION,
            Integer("id_student", "bigint", minimum=1),
            Integer("date_registration", required=False),
            Integer("date_unregistration", required=False),
        ),
        spans=(Span("date_registration", "date_unregistration", "INVALID_DATE_ORDER"),),
        references=((_student_reference(),),),
        duplicates=Duplicates(
            (*_COURSE, "id_student"), ("date_registration", "date_unregistration")
        ),
    ),
    "assessments": RuleSet(
        fields=(
            _MODULE,
            _PRESENTATION,
            Integer("id_assessment", "bigint", minimum=1),
            Choice("assessment_type", S.ASSESSMENT_TYPES),
            Integer(
                "date",
                required=False,
                minimum=0,
                required_when=("assessment_type", S.COURSEWORK_TYPES),
            ),
            Decimal("weight", 0, 100),
        ),
        references=((_course_reference(),),),
        duplicates=Duplicates(("id_assessment",), (*_COURSE, "assessment_type", "date", "weight")),
    ),
    "student_assessment": RuleSet(
        fields=(
            Integer("id_assessment", "bigint", minimum=1),
            Integer("id_student", "bigint", minimum=1),
            Integer("date_submitted"),
            Integer("is_banked", "smallint", allowed=[0, 1]),
            Decimal("score", 0, 100, required=False),
        ),
        references=(
            (
                Reference(
                    "assessments",
                    {"id_assessment": "v_id_assessment"},
                    "ASSESSMENT_NOT_FOUND",
                    "id_assessment",
                    carry=_COURSE,
                ),
            ),
            (
                Reference(
                    "student_info",
                    {"id_student": "v_id_student", **{c: f"r_{c}" for c in _COURSE}},
                    "STUDENT_NOT_FOUND_FOR_ASSESSMENT",
                    "id_assessment, id_student",
                ),
            ),
        ),
        duplicates=Duplicates(
            ("id_assessment", "id_student"), ("date_submitted", "is_banked", "score")
        ),
    ),
    "vle": RuleSet(
        fields=(
            Integer("id_site", "bigint", minimum=1),
            _MODULE,
            _PRESENTATION,
            Choice("activity_type", S.ACTIVITY_TYPES),
            Integer("week_from", required=False),
            Integer("week_to", required=False),
        ),
        spans=(Span("week_from", "week_to", "INVALID_WEEK_ORDER", "INCOMPLETE_WEEK_RANGE"),),
        references=((_course_reference(),),),
        duplicates=Duplicates(("id_site",), (*_COURSE, "activity_type", "week_from", "week_to")),
    ),
    "student_vle": RuleSet(
        fields=(
            _MODULE,
            _PRESENTATION,
            Integer("id_student", "bigint", minimum=1),
            Integer("id_site", "bigint", minimum=1),
            Integer("date"),
            Integer("sum_click", minimum=1),
        ),
        references=(
            (
                _student_reference(),
                Reference(
                    "vle",
                    {c: f"v_{c}" for c in ("id_site", *_COURSE)},
                    "SITE_NOT_FOUND",
                    ", ".join(("id_site", *_COURSE)),
                ),
            ),
        ),
        duplicates=Duplicates(tuple(S.SOURCE_COLUMNS["student_vle"])),
    ),
}


def referenced_tables(table: str) -> list[str]:
    return list(dict.fromkeys(r.table for group in RULES[table].references for r in group))


def reference_levels() -> list[list[str]]:
    """Tables grouped so that references of a group lie in earlier groups."""
    levels: list[list[str]] = []
    done: set[str] = set()
    while len(done) < len(RULES):
        level = [t for t in RULES if t not in done and done.issuperset(referenced_tables(t))]
        levels.append(level)
        done.update(level)
    return levels
