"""Leakage-safe preparation of all cross-validation splits at once.

``prepare(raw, roles)`` stores one row per input row, whatever the number of splits:
the masks of the splits it trains and validates, and every clean column as an array
of one value, or of one per split where the fitted statistics make it differ.  All
statistics (tiered medians, modes, frequent prefixes, fare bands, scales, bins and
mutual information) are fitted per split on its training rows only, from split-count
vectors.  :class:`Design` turns the stored rows into a split's design matrix.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import exprs as X
from ..operators import split_stats as V
from ..operators.features import (_PREFIX, _TITLE, CATEGORICAL_COLUMNS, PASSTHROUGH_COLUMNS, SCALED_COLUMNS, Roles, age_tiers, fare_tiers)
from ..operators.logistic import MAX_COLUMNS
from ..operators.select import class_counts, mi_from_counts, mi_of_cells, rank_features, value_cells
from ..operators.split_stats import TRAIN, VALID, Splits
from ..session import materialize, scratch_path, sized_broadcast

SPLIT = "split"
KEY = "PassengerId"      # the clean feature row names its key column so
# encoded features scored as continuous (binned at learned deciles first)
CONTINUOUS = ["AgeFilled", "FareFilled", "FareLog", "FarePerPerson", "AgePclass"]
MI_BINS = 10
NUMERIC = [*SCALED_COLUMNS, *PASSTHROUGH_COLUMNS]
NUMBERED = {"Pclass"}    # categories in the order of their numbers


@dataclass
class Prepared:
    roles: Roles
    splits: Splits
    rows: DataFrame         # one row per input row: KEY, label, masks, an array per clean column
    design: Design
    names: list             # encoded feature names in column order (union over splits)
    ranking: DataFrame      # (split, feature, mi, position, rank)


def score_features(clean: DataFrame, r: Roles, names: list) -> DataFrame:
    """E5a/E5b on the clean rows of one training set; ranked (O3).  Scaling a measure does
    not move its bins, so the scores need no encoder."""
    cells = value_cells(clean, r.label, NUMERIC, CATEGORICAL_COLUMNS)
    mi = mi_of_cells(cells, r.label, class_counts(clean, r.label), CONTINUOUS, MI_BINS)
    positions = clean.sparkSession.createDataFrame(list(enumerate(names)), "position int, feature string")
    return rank_features(mi, positions)


class Design:
    """Design matrices from stored rows: scaled measures, passthrough numbers, one
    column per category; a category that a split's training rows lack is all zeros
    there and so has no weight."""

    def __init__(self, label: str, scale: dict, categories: dict[str, list[str]]):
        self.label, self.categories = label, categories
        self.scale = {c: [(m or 0.0, d or 1.0) for m, d in v] for c, v in scale.items()}  # no deviation: scale 1

    def names(self) -> list[str]:
        return NUMERIC + [f"{c}_{v}" for c, own in self.categories.items() for v in own]

    def columns(self, batch: pa.RecordBatch) -> dict[str, tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(where a row's values start, whether it has one per split, all values) of every
        column; categories by their place in the list, -1 for any other."""
        out = {}
        for c in [*NUMERIC, *self.categories]:
            lists = batch.column(c)
            lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
            starts = np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64)
            flat = lists.flatten()
            if c in self.categories:
                flat = pc.fill_null(pc.index_in(flat, pa.array(self.categories[c], pa.string())), -1)
            out[c] = starts, lengths > 1, np.nan_to_num(flat.to_numpy(zero_copy_only=False).astype(np.float64))
        return out

    def __call__(self, batch: pa.RecordBatch, splits: Sequence[int]) -> Iterator[tuple]:
        y, train, valid = self.marks(batch)
        yield from self.matrices(Block.of(self.columns(batch), NUMERIC, list(self.categories)), y, train, valid, splits)

    def marks(self, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return batch.column(self.label).to_numpy(zero_copy_only=False).astype(np.float64), *(batch.column(c).to_numpy() for c in (TRAIN, VALID))

    def matrices(self, block: Block, y: np.ndarray, train: np.ndarray, valid: np.ndarray, splits: Sequence[int]) -> Iterator[tuple]:
        """For each split (split, matrix, label, in training, in validation).  It is one matrix
        that is changed where the next split differs, so it must not be kept."""
        first = len(NUMERIC) + np.cumsum([0, *map(len, self.categories.values())])
        x = np.zeros((len(y), first[-1]), order="F")  # whole columns are written
        x[:, :len(NUMERIC)] = block.numbers
        for j, own in enumerate(block.codes.T):
            hot = np.flatnonzero(own >= 0)
            x[hot, first[j] + own[hot]] = 1.0
        raw = {c: block.numbers[:, NUMERIC.index(c)].copy() for c in self.scale}
        now = {j: block.codes[rows, j].astype(np.int64) for j, rows, _, _ in block.varied_codes}
        for s in splits:
            for i, rows, own, table in block.varied_numbers:
                values = table[own, s]
                if NUMERIC[i] in raw:
                    raw[NUMERIC[i]][rows] = values
                else:
                    x[rows, i] = values
            for c, scale in self.scale.items():
                mean, deviation = scale[s]
                x[:, NUMERIC.index(c)] = (raw[c] - mean) / deviation
            for j, rows, own, table in block.varied_codes:
                new = table[own, s].astype(np.int64)
                other = np.flatnonzero(new != now[j])
                for codes, value in ((now[j], 0.0), (new, 1.0)):
                    known = other[codes[other] >= 0]
                    x[rows[known], first[j] + codes[known]] = value
                now[j] = new
            yield s, x, y, (train >> s & 1).astype(bool), (valid >> s & 1).astype(bool)


@dataclass(frozen=True)
class Block:
    """Some rows with everything that a design matrix needs: the values of the first split,
    and for the rows of a column that differ between splits (row, number of the vector) and the
    table of the vectors, one value per split."""
    numbers: np.ndarray
    codes: np.ndarray
    varied_numbers: list
    varied_codes: list

    @staticmethod
    def of(columns: dict, numeric: Sequence[str], categorical: Sequence[str]) -> Block:
        found: list[list] = []
        plain: list[np.ndarray] = []
        for names, kind in ((numeric, np.float64), (categorical, np.int16)):
            matrix, varied = np.zeros((len(columns[(names or numeric)[0]][0]), len(names)), kind), []
            for j, c in enumerate(names):
                starts, many, values = columns[c]
                matrix[:, j] = values[starts]
                rows = np.flatnonzero(many)
                if len(rows):
                    width = (np.append(starts, len(values))[rows + 1] - starts[rows]).min()
                    own = values[starts[rows, None] + np.arange(width)]
                    differ = (own != own[:, :1]).any(axis=1)
                    rows, own = rows[differ], own[differ]
                if len(rows):
                    seen: dict[bytes, int] = {}
                    number = np.array([seen.setdefault(v.tobytes(), len(seen)) for v in np.ascontiguousarray(own)], np.int32)
                    table = np.frombuffer(b"".join(seen)).reshape(-1, width).astype(kind)
                    varied.append((j, rows.astype(np.int32), number, table))
            plain.append(matrix)
            found.append(varied)
        return Block(*plain, *found)


BLOCK_ROWS = 1024
FILE_BLOCKS = 256  # a reader holds a file's blocks at once


class Packed:
    """Design of rows that :func:`packed` has stored in blocks."""

    def __init__(self, design: Design):
        self.design = design

    def __call__(self, batch: pa.RecordBatch, splits: Sequence[int]) -> Iterator[tuple]:
        for block in batch.column("block"):
            yield from self.design.matrices(*pickle.loads(block.as_buffer()), splits)


def packed(p: Prepared) -> tuple[DataFrame, Packed]:
    """The rows again, ``BLOCK_ROWS`` of them in a record, in the form the solver's passes
    calculate with: read and looked up once, not in every pass."""
    design, spark = p.design, p.rows.sparkSession

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(i, BLOCK_ROWS)
                block = Block.of(design.columns(part), NUMERIC, list(design.categories)), *design.marks(part)
                yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(block, 5)], pa.binary())], names=["block"])

    path = scratch_path(spark, "tables")
    p.rows.mapInArrow(run, "block binary").write.option("maxRecordsPerFile", FILE_BLOCKS).parquet(path)
    return spark.read.parquet(path), Packed(design)


def _members(raw: DataFrame, r: Roles, splits: Splits, seed: int) -> DataFrame:
    d = X.nan_as_null(raw.select(*dict.fromkeys([*r.raw_features(), r.label])), r.raw_features())
    narrow = d.select("*", X.title_b(r.name).alias(_TITLE), X.ticket_prefix(r.ticket).alias(_PREFIX))
    return materialize(V.with_masks(narrow, r.key, r.label, splits, seed))


def _by_mask(members: DataFrame, key: str, splits: Splits) -> DataFrame:
    """Split-count vectors of a column with few values: rows are counted by mask first."""
    masks = members.groupBy(key, TRAIN).agg(F.count(F.lit(1)).alias("_m"))
    one = F.lit(1).cast("long")
    return masks.groupBy(key).agg(*[F.sum(F.shiftright(TRAIN, i).bitwiseAND(one) * F.col("_m")).alias(n) for i, n in enumerate(splits.counts)])


def _port_modes(members: DataFrame, r: Roles, splits: Splits) -> DataFrame:
    """One row: the most frequent port of every split (A4)."""
    counts = _by_mask(members.where(F.col(r.embarked).isNotNull()), r.embarked, splits)
    first = [F.min(F.when(F.col(n) > 0, F.struct((-F.col(n)).alias("c"), F.col(r.embarked).alias("v"))))["v"] for n in splits.counts]
    return counts.agg(F.array(*first).alias("_ports"))


def _prefix_masks(members: DataFrame, r: Roles, splits: Splits) -> DataFrame:
    """(prefix, mask of the splits where it is frequent)."""
    counts = _by_mask(members, _PREFIX, splits)
    mask = F.lit(0).cast("long")
    for i, n in enumerate(splits.counts):
        mask = mask + F.when(F.col(n) >= r.ticket_min_count, F.lit(1 << i).cast("long")).otherwise(F.lit(0).cast("long"))
    return counts.select(F.col(_PREFIX).alias("_listed"), mask.alias("_kept")).where("_kept <> 0")


def _fare_edges(members: DataFrame, cells: DataFrame, fills: DataFrame, cuts: list[float], r: Roles, splits: Splits) -> list[list[float]]:
    """Inner edges of the imputed fare's bands of every split (A7): the counts of the
    seen fares plus, at each class's fill value, the number of its missing ones."""
    missing = members.where(F.col(r.fare).isNull()).groupBy(r.cls).agg(*V.bit_counts(F.col(TRAIN), splits)) \
        .withColumn(r.fare, F.lit(None).cast("double"))
    at_fill = V.filled(missing, fills, fare_tiers(r), r.fare, "_fills", splits)
    one = F.explode(F.array(*[F.struct(F.get("_fills", F.lit(i)).alias("_v"), *[(F.col(n) if i == j else F.lit(0).cast("long")).alias(n) for j, n in enumerate(splits.counts)])
                              for i in range(len(splits))]))  # classes x splits, not rows
    placed = materialize(at_fill.select(one.alias("_c")).select("_c.*").where("_v IS NOT NULL"))
    q = r.fare_quantiles
    probs = [i / q for i in range(q + 1)]

    def counts(seen: DataFrame, placed: DataFrame) -> DataFrame:
        return materialize(seen.select("_v", *splits.counts).unionByName(placed).groupBy("_v").agg(*V.added(splits)))

    kept = V.cells_of(counts(cells, placed.withColumn("_v", V.narrowed(F.col("_v"), cuts))), [], "_v", probs, splits)
    seen = counts(V.narrowed_counts(members, [], r.fare, splits, cuts, kept), placed)
    found: dict[int, dict[int, float]] = {}
    for x in V.vector_quantiles(seen, [], "_v", probs, splits).collect():
        found.setdefault(x[V.INDEX], {})[x["i"]] = x["q"]
    return [sorted(set(found[s].values()))[1:-1] if s in found else [] for s in range(len(splits))]


def _bands(fare: Column, edges: list[list[float]], each: Column) -> Column:
    """The fare's band in every split: one value where the splits' edges agree on it."""
    lists = [F.array(*[F.lit(float(e)) for e in own]) if own else F.array().cast("array<double>") for own in edges]
    bands = F.array(*lists)
    many = F.transform(each, lambda s: X.learned_bin(V.at_split(fare, s), F.get(bands, s)))
    if len({len(own) for own in edges}) > 1:
        return many
    value, apart = F.get(fare, F.lit(0)), F.lit(False)
    for same in zip(*edges):  # between the lowest and the highest of an edge the splits differ
        apart = apart | (value > F.lit(float(min(same)))) & (value <= F.lit(float(max(same))))
    return F.when((F.size(fare) == 1) & ~F.coalesce(apart, F.lit(False)), F.array(X.learned_bin(value, lists[0], most=len(edges[0])))).otherwise(many)


def _clean_rows(members: DataFrame, ages: DataFrame, fares: DataFrame, edges: list, r: Roles, splits: Splits) -> DataFrame:
    """F22 for every split: each clean column an array of one value or one per split."""
    t = V.filled(members, ages, age_tiers(r), r.age, "AgeFilled", splits)
    t = V.filled(t, fares, fare_tiers(r), r.fare, "FareFilled", splits)
    t = t.crossJoin(F.broadcast(materialize(_port_modes(members, r, splits))))  # one row
    listed = sized_broadcast(materialize(_prefix_masks(members, r, splits)))
    t = t.join(listed, F.col(_PREFIX) == F.col("_listed"), "left")
    each = F.sequence(F.lit(0), F.lit(len(splits) - 1))
    age, fare, kept = F.col("AgeFilled"), F.col("FareFilled"), F.coalesce("_kept", F.lit(0).cast("long"))
    # inside a lambda a name could be taken for the clean column of that name
    t = t.withColumns({"_cls": F.col(r.cls), "_sex": F.col(r.sex), "_fam": X.family_size(r.sibsp, r.parch), "_raw_prefix": F.col(_PREFIX)})
    fam = F.col("_fam")
    prefix = F.when(kept == (1 << len(splits)) - 1, F.array(F.col("_raw_prefix"))).when(kept == 0, F.array(F.lit(X.TICKET_OTHER))).otherwise(
        F.transform(each, lambda s: F.when(F.call_function("shiftright", kept, s).bitwiseAND(F.lit(1).cast("long")) == 1, F.col("_raw_prefix")).otherwise(F.lit(X.TICKET_OTHER))))
    cols: dict[str, Column] = {
        "AgeFilled": age, "FareFilled": fare,
        "SexEncoded": F.array(X.two_value_code(r.sex, r.sex_codes)),
        "SibSp": F.array(F.col(r.sibsp)), "Parch": F.array(F.col(r.parch)), "FamilySize": F.array(fam), "IsAlone": F.array(X.flag(fam == 1)),
        "FareLog": F.transform(fare, X.log1p), "FarePerPerson": F.transform(fare, lambda v: X.ratio(v, fam)),
        "HasCabin": F.array(X.flag(F.col(r.cabin).isNotNull())), "AgePclass": F.transform(age, lambda v: X.product(v, F.col("_cls"))),
        "NameLength": F.array(X.char_length(r.name)),
        "WomenChildPriority": F.transform(age, lambda v: X.priority_rule("_sex", v, r.priority_value, r.child_below)),
        "AgeMissing": F.array(X.flag(F.col(r.age).isNull())), "FareMissing": F.array(X.flag(F.col(r.fare).isNull())),
        "CabinMissing": F.array(X.flag(F.col(r.cabin).isNull())),
        "Pclass": F.array(F.col(r.cls).cast("int")), "Sex": F.array(F.col(r.sex)),
        "EmbarkedFilled": F.when(F.col(r.embarked).isNotNull(), F.array(F.col(r.embarked))).otherwise(F.col("_ports")),
        "Title": F.array(F.col(_TITLE)), "CabinDeck": F.array(X.first_letter(r.cabin, X.CABIN_UNKNOWN)), "TicketPrefix": prefix,
        "AgeBand": F.transform(age, lambda v: X.cut_right(v, list(r.age_edges), list(r.age_labels))),
        "FareBand": _bands(fare, edges, each),
        "FamilyGroup": F.array(X.cut_right(fam, X.FAMILY_EDGES, X.FAMILY_LABELS)), "SexPclass": F.array(X.interaction(r.sex, r.cls)),
    }
    kinds = {c: "array<double>" if c in NUMERIC else "array<string>" for c in cols}
    return materialize(t.select(F.col(r.key).cast("long").alias(KEY), r.label, TRAIN, VALID, *[e.cast(kinds[c]).alias(c) for c, e in cols.items()]))


def _binned(cells: DataFrame, label: str, splits: Splits) -> DataFrame:
    """``(split, feature, value, label, _c)`` of the continuous features, cut at their
    learned deciles: the counts up to each edge come out of the rank search.  ``cells``
    holds stand-ins for the values that no decile can fall on."""
    hot = [F.sum(F.when(F.col(label) == 1, F.col(n)).otherwise(0)).alias(f"_p{i}") for i, n in enumerate(splits.counts)]
    counts = materialize(cells.where(F.col("feature").isin(CONTINUOUS)).groupBy("feature", "num").agg(*V.added(splits), *hot))
    found: dict[tuple, dict[int, tuple]] = {}
    for x in V.vector_quantiles(counts, ["feature"], "num", [i / MI_BINS for i in range(MI_BINS + 1)], splits, carry=["_p"]).collect():
        found.setdefault((x["feature"], x[V.INDEX]), {})[x["i"]] = (x["q"], x["_upto"], x["_p_upto"], x["_of"], x["_p_of"])
    out = []
    for (feature, s), by_i in found.items():  # features x splits x deciles
        (low, *_), (high, _, _, n, p) = by_i[0], by_i[MI_BINS]
        edges = sorted({v for v in by_i.values() if low < v[0] < high})
        cuts = {e[0]: e for e in edges}
        before, upto = (0, 0), [(e[1], e[2]) for e in cuts.values()] + [(n, p)]
        for b, (all_, ones) in enumerate(upto):
            out += [(splits.ids[s], feature, float(b), 1, ones - before[1]), (splits.ids[s], feature, float(b), 0, all_ - ones - before[0] + before[1])]
            before = (all_, ones)
    kept = [row for row in out if row[-1] > 0]
    return cells.sparkSession.createDataFrame(kept, f"{SPLIT} int, feature string, value double, `{label}` int, _c long")


def _decile_cells(cells: DataFrame, splits: Splits) -> dict[str, list[float]]:
    """Ends of the cells of every continuous feature that hold a decile of any split."""
    own = cells.where(F.col("feature").isin(CONTINUOUS)).groupBy("feature", "num").agg(*V.added(splits)).orderBy("feature", "num").collect()  # features x cells
    probs, out = [i / MI_BINS for i in range(MI_BINS + 1)], {}
    for c in {x["feature"] for x in own}:
        mine = [x for x in own if x["feature"] == c]
        out[c] = V.ends_in(np.array([x["num"] for x in mine]), np.array([[x[n] for n in splits.counts] for x in mine]), probs).tolist()
    return out


def _categories(cells: DataFrame) -> dict[str, list[str]]:
    """The categories of every column, over all splits (bounded by the solver's columns)."""
    rows = cells.where("cat IS NOT NULL").select("feature", "cat").distinct().limit(MAX_COLUMNS + 1).collect()
    if len(rows) > MAX_COLUMNS:
        raise ValueError(f"more than {MAX_COLUMNS} categories: too many for the search's design matrix")
    order = {c: (lambda v: (float(v), v)) if c in NUMBERED else (lambda v: v) for c in CATEGORICAL_COLUMNS}
    return {c: sorted((x["cat"] for x in rows if x["feature"] == c), key=order[c]) for c in CATEGORICAL_COLUMNS}


def prepare(raw: DataFrame, r: Roles, nested: bool = True, seed: int = 42) -> Prepared:
    splits = Splits(nested=nested)
    members = _members(raw, r, splits, seed)
    age_keys, fare_keys = [_TITLE, r.cls, r.sex], [r.cls]
    cuts = V.cut_points(members, {"age": F.col(r.age), "fare": F.col(r.fare)})
    ages = materialize(V.tiered_medians(members, age_tiers(r), age_keys, r.age, splits, cuts["age"])[0])
    found, counted = V.tiered_medians(members, fare_tiers(r), fare_keys, r.fare, splits, cuts["fare"])
    fares = materialize(found)
    rows = _clean_rows(members, ages, fares, _fare_edges(members, counted, fares, cuts["fare"], r, splits), r, splits)
    cuts = V.cut_points(rows, {c: F.get(c, F.lit(0)) for c in CONTINUOUS})
    cells = V.counted_cells(rows, r.label, splits, NUMERIC, CATEGORICAL_COLUMNS, cuts)
    deciles = V.counted_cells(rows, r.label, splits, CONTINUOUS, [], cuts, _decile_cells(cells, splits))
    middle = {c: cuts[c][len(cuts[c]) // 2] if cuts[c] else 0.0 for c in SCALED_COLUMNS}
    design = Design(r.label, V.array_moments(rows, middle, splits), _categories(cells))
    discrete = cells.where(~F.col("feature").isin(CONTINUOUS)).withColumn("value", F.coalesce("num", F.lit(1.0))) \
        .withColumn("feature", F.concat_ws("_", "feature", "cat"))
    counts = V.per_split(discrete, splits, ["feature", "value", r.label], SPLIT, "_c").select(SPLIT, "feature", "value", r.label, "_c")
    classes = V.per_split(materialize(rows.groupBy(r.label).agg(*V.bit_counts(F.col(TRAIN), splits))), splits, [r.label], SPLIT, "_ny")
    mi = mi_from_counts(materialize(counts.unionByName(_binned(deciles, r.label, splits))), r.label, classes, by=[SPLIT])
    names = design.names()
    positions = raw.sparkSession.createDataFrame(list(enumerate(names)), "position int, feature string")
    return Prepared(r, splits, rows, design, names, materialize(rank_features(mi, positions, by=[SPLIT])))
