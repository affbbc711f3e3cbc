"""The formal line's clean feature row (F22): fit on training rows, apply anywhere.

``fit_features`` learns, from the rows it is given and nothing else:
tiered medians of the age role, class medians of the fare role, the mode of
the port role, the frequent ticket prefixes, and the quartile edges of the
*imputed* fare.  Each is a small parameter table, materialised once.
``apply_features`` turns any batch with the raw roles into the 27 clean
columns through broadcast joins and built-in expressions.

``by`` (e.g. ``["fold"]``) prefixes every statistic with extra keys: fit on
rows expanded per training fold and apply on rows tagged with the fold whose
parameters they need, and all folds are handled by the same jobs.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import exprs as X
from ..session import materialize
from .fit import STAT, mode, quantile_edges, tiered_quantiles
from .lookup import join_params, apply_tiered, keep_if_listed


@dataclass(frozen=True)
class Roles:
    """Column names of the raw record plus the rule parameters of the feature row.

    Defaults are the reference's own column names and fixed values.
    """
    key: str = "PassengerId"
    label: str = "Survived"
    cls: str = "Pclass"
    name: str = "Name"
    sex: str = "Sex"
    age: str = "Age"
    sibsp: str = "SibSp"
    parch: str = "Parch"
    ticket: str = "Ticket"
    fare: str = "Fare"
    cabin: str = "Cabin"
    embarked: str = "Embarked"
    sex_codes: dict = field(default_factory=lambda: dict(X.SEX_CODES))
    priority_value: str = X.PRIORITY_SEX
    child_below: float = X.CHILD_AGE_BELOW
    age_edges: tuple = tuple(X.AGE_EDGES)
    age_labels: tuple = tuple(X.AGE_LABELS)
    ticket_min_count: int = X.TICKET_MIN_COUNT
    fare_quantiles: int = 4

    def raw_features(self) -> list[str]:
        return [self.key, self.cls, self.name, self.sex, self.age, self.sibsp, self.parch,
                self.ticket, self.fare, self.cabin, self.embarked]


# Output schema of the clean feature row (names fixed by the reference).
CLEAN_COLUMNS = [
    "PassengerId", "Pclass", "Sex", "SexEncoded", "AgeFilled", "AgeBand", "SibSp", "Parch",
    "FamilySize", "FamilyGroup", "IsAlone", "FareFilled", "FareLog", "FarePerPerson",
    "FareBand", "EmbarkedFilled", "Title", "CabinDeck", "HasCabin", "TicketPrefix",
    "SexPclass", "AgePclass", "NameLength", "WomenChildPriority", "AgeMissing",
    "FareMissing", "CabinMissing",
]

# Which clean columns are scaled, passed through and one-hot encoded.
SCALED_COLUMNS = ["AgeFilled", "FareFilled"]
PASSTHROUGH_COLUMNS = [
    "SexEncoded", "SibSp", "Parch", "FamilySize", "IsAlone", "FareLog", "FarePerPerson",
    "HasCabin", "AgePclass", "NameLength", "WomenChildPriority", "AgeMissing",
    "FareMissing", "CabinMissing",
]
CATEGORICAL_COLUMNS = [
    "Pclass", "Sex", "EmbarkedFilled", "Title", "CabinDeck", "TicketPrefix", "AgeBand",
    "FareBand", "FamilyGroup", "SexPclass",
]

_TITLE, _PREFIX = "_title", "_prefix"


def age_tiers(r: Roles) -> list[list[str]]:
    return [[_TITLE, r.cls, r.sex], [_TITLE, r.cls], [r.cls], []]


def fare_tiers(r: Roles) -> list[list[str]]:
    return [[r.cls], []]


@dataclass
class FeatureParams:
    age: DataFrame          # (_tier, _title, cls, sex, by..., median)
    fare: DataFrame         # (_tier, cls, by..., median)
    port_mode: DataFrame    # (by..., mode)
    prefixes: DataFrame     # (by..., _prefix, count)
    fare_edges: DataFrame   # (by..., edges)
    by: tuple = ()

    def tables(self) -> dict[str, DataFrame]:
        return {"age": self.age, "fare": self.fare, "port_mode": self.port_mode,
                "prefixes": self.prefixes, "fare_edges": self.fare_edges}


def _derived(df: DataFrame, r: Roles, by: Sequence[str]) -> DataFrame:
    return X.nan_as_null(df, r.raw_features()).select(*by, r.cls, r.sex, r.age, r.fare, r.embarked,
                     X.title_b(r.name).alias(_TITLE), X.ticket_prefix(r.ticket).alias(_PREFIX))


def fit_features(train: DataFrame, r: Roles = Roles(), by: Sequence[str] = ()) -> FeatureParams:
    """Learn every statistic of the feature row from ``train`` only.

    The label is never read, so flipping it cannot change a parameter (D11).
    """
    by = tuple(by)
    absent = [c for c in [*by, *r.raw_features()] if c not in train.columns]
    if absent:
        raise ValueError(f"the training rows lack the columns {absent}")
    # the narrow projection every statistic reads: computed once (one scan of
    # the training rows and their joins), not once per statistic
    d = materialize(_derived(train, r, by))
    both = materialize(tiered_quantiles(d, [("age", age_tiers(r), r.age), ("fare", fare_tiers(r), r.fare)],
                                        by=by))
    age = both.where(F.col(STAT) == "age").drop(STAT)
    fare = both.where(F.col(STAT) == "fare").drop(STAT, _TITLE, r.sex)
    # port and ticket-prefix frequencies in one GROUPING SETS pass
    freq = materialize(d.groupingSets([[*by, r.embarked], [*by, _PREFIX]], *by, r.embarked, _PREFIX)
                       .agg(F.count(F.lit(1)).alias("count"), F.grouping_id().alias("_gid")))
    only_port = freq.where(F.col(r.embarked).isNotNull() & F.col(_PREFIX).isNull())
    port = mode(only_port.select(*by, r.embarked, "count"), r.embarked, by=by, weight="count")
    prefixes = freq.where(F.col(_PREFIX).isNotNull() & F.col(r.embarked).isNull()
                          & (F.col("count") >= r.ticket_min_count)).select(*by, _PREFIX, "count")
    filled = apply_tiered(d, fare, fare_tiers(r), r.fare, "_fare_filled", by=by)
    edges = materialize(quantile_edges(filled, "_fare_filled", r.fare_quantiles, by=by))
    return FeatureParams(age, fare, port, prefixes, edges, by)


def apply_features(df: DataFrame, p: FeatureParams, r: Roles = Roles(),
                   keep: Sequence[str] = ()) -> DataFrame:
    """Clean feature row for every row of ``df`` (the 27 ``CLEAN_COLUMNS``).

    ``keep`` lists extra input columns to carry along (label, fold tags).  The
    batch is read once; all parameter joins are broadcast hash joins.
    """
    by = list(p.by)
    base = X.nan_as_null(df, r.raw_features()).select(*dict.fromkeys([*keep, *by, *r.raw_features()]),
                     X.title_b(r.name).alias(_TITLE), X.ticket_prefix(r.ticket).alias(_PREFIX))
    t = apply_tiered(base, p.age, age_tiers(r), r.age, "_age_filled", by=by)
    t = apply_tiered(t, p.fare, fare_tiers(r), r.fare, "_fare_filled", by=by)
    t = join_params(t, p.port_mode, [], "_pm_", ["mode"], by)
    t = join_params(t, p.fare_edges, [], "_fe_", ["edges"], by)
    t = keep_if_listed(t, p.prefixes, _PREFIX, _PREFIX, "_prefix_kept", X.TICKET_OTHER, by)

    fam = X.family_size(r.sibsp, r.parch)
    age_f = F.col("_age_filled")
    fare_f = F.col("_fare_filled")
    cols = {
        "PassengerId": F.col(r.key).cast("long"),
        "Pclass": F.col(r.cls).cast("int"),
        "Sex": F.col(r.sex).cast("string"),
        "SexEncoded": X.two_value_code(r.sex, r.sex_codes),
        "AgeFilled": age_f,
        "AgeBand": X.cut_right(age_f, list(r.age_edges), list(r.age_labels)),
        "SibSp": F.col(r.sibsp).cast("int"),
        "Parch": F.col(r.parch).cast("int"),
        "FamilySize": fam,
        "FamilyGroup": X.cut_right(fam, X.FAMILY_EDGES, X.FAMILY_LABELS),
        "IsAlone": X.flag(fam == 1),
        "FareFilled": fare_f,
        "FareLog": X.log1p(fare_f),
        "FarePerPerson": X.ratio(fare_f, fam),
        "FareBand": X.learned_bin(fare_f, F.col("_fe_edges"), most=r.fare_quantiles - 1),
        "EmbarkedFilled": F.coalesce(F.col(r.embarked), F.col("_pm_mode")),
        "Title": F.col(_TITLE),
        "CabinDeck": X.first_letter(r.cabin, X.CABIN_UNKNOWN),
        "HasCabin": X.flag(F.col(r.cabin).isNotNull()),
        "TicketPrefix": F.col("_prefix_kept"),
        "SexPclass": X.interaction(r.sex, r.cls),
        "AgePclass": X.product(age_f, F.col(r.cls)),
        "NameLength": X.char_length(r.name),
        "WomenChildPriority": X.priority_rule(r.sex, age_f, r.priority_value, r.child_below),
        "AgeMissing": X.flag(F.col(r.age).isNull()),
        "FareMissing": X.flag(F.col(r.fare).isNull()),
        "CabinMissing": X.flag(F.col(r.cabin).isNull()),
    }
    # the key comes first, then what is carried along (the label at position 1)
    carried = [c for c in dict.fromkeys([*keep, *by]) if c not in cols]
    key, *rest = [e.alias(n) for n, e in cols.items()]
    return t.select(key, *carried, *rest)
