"""Impute, scale and index the model inputs with exact, distributed statistics."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.ml import Estimator, Model
from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.param import Param, Params
from pyspark.ml.util import (
    DefaultParamsReader,
    DefaultParamsWriter,
    MLReadable,
    MLReader,
    MLWritable,
    MLWriter,
)
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from riskloom.config import RiskConfig, ScaleLimits
from riskloom.operators.ordering import exact_quantiles
from riskloom.roles import feature_groups
from riskloom.session import join_path, pin

INFREQUENT = "infrequent"
#: Number of a stored row, which values in long form carry.
ROW = "_row"
FEATURES = "features"


def numeric_statistics(df: DataFrame, columns: list[str], limits: ScaleLimits) -> list[dict]:
    """Median, and mean and population deviation after filling with the median.

    Columns without any value are left out; a constant column is scaled by 1.
    """
    if not columns:
        return []
    numbers = df.select(*[_number(df.schema[c]).alias(c) for c in columns])
    medians = exact_quantiles(numbers, columns, [0.5], limits)
    used = [c for c in columns if medians[c] is not None]
    if not used:
        return []
    filled = {c: F.coalesce(F.col(c), F.lit(medians[c][0])) for c in used}
    row = numbers.agg(
        *[F.avg(filled[c]).alias(f"m{i}") for i, c in enumerate(used)],
        *[F.stddev_pop(filled[c]).alias(f"s{i}") for i, c in enumerate(used)],
    ).first()
    return [
        {"name": c, "median": medians[c][0], "mean": row[f"m{i}"], "scale": row[f"s{i}"] or 1.0}
        for i, c in enumerate(used)
    ]


def _number(field: T.StructField) -> Column:
    value = F.col(field.name).cast("double")
    return F.when(~F.isnan(value), value)


def category_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(feature, value, rows), missing values included, combined before the shuffle."""
    pairs = F.array(
        *[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value")) for c in columns]
    )
    return (
        df.select(F.explode(pairs).alias("p"))
        .groupBy("p.feature", "p.value")
        .agg(F.count("*").alias("rows"))
    )


def most_frequent_values(counts: DataFrame) -> dict[str, str]:
    """The filling value per feature: most rows, then smallest value."""
    best = F.min(F.struct((-F.col("rows")).alias("r"), F.col("value").alias("value")))
    rows = counts.filter(F.col("value").isNotNull()).groupBy("feature").agg(best.alias("b"))
    return {r["feature"]: r["b"]["value"] for r in rows.collect()}


@dataclass(frozen=True)
class CategoryIndex:
    """The indexed values (pinned) and, per feature, the few numbers about them."""

    frame: DataFrame
    modes: dict[str, str]
    values: dict[str, int]
    frequent: dict[str, int]
    any_rare: dict[str, bool]


def _per_feature(values: dict[str, Any], kind: str) -> Column:
    pairs = [F.lit(x) for f, v in values.items() for x in (f, v)]
    return F.create_map(*pairs)[F.col("feature")].cast(kind)


def numbered(frequent: DataFrame, rows: int, limits: ScaleLimits) -> DataFrame:
    """Adds ``index``: the place of a value among those of its feature, from 0.

    Beyond ``rows_per_run`` values ranges of (feature, value) are numbered apart and shifted
    by the sizes of the ranges before them, so no task sorts a whole feature.
    """
    parts = -(-rows // limits.rows_per_run)
    if parts <= 1:
        in_order = Window.partitionBy("feature").orderBy("value")
        return frequent.withColumn("index", F.row_number().over(in_order) - 1)
    ranged = pin(
        frequent.repartitionByRange(parts, "feature", "value").withColumn("_part", F.spark_partition_id())
    )
    # One row per range and feature.
    earlier = Window.partitionBy("feature").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = ranged.groupBy("feature", "_part").agg(F.count("*").alias("_n"))
    sizes = sizes.select("feature", "_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    in_order = Window.partitionBy("feature", "_part").orderBy("value")
    index = (F.col("_before") + F.row_number().over(in_order) - 1).cast("int")
    return ranged.join(F.broadcast(sizes), ["feature", "_part"]).withColumn("index", index).drop("_part", "_before")


def category_index(
    counts: DataFrame, min_rows: int, limits: ScaleLimits | None = None
) -> CategoryIndex:
    """Index per (feature, value); all rare values share the last index.

    Missing values count for the most frequent value, which replaces them;
    features without any value are left out. ``slots`` is the number of one-hot
    columns. Only what there is one of per feature passes through the driver.
    """
    modes = most_frequent_values(counts)
    if not modes:
        return CategoryIndex(counts.limit(0), {}, {}, {}, {})
    totals = pin(
        counts.filter(F.col("feature").isin(*modes))
        .groupBy("feature", F.coalesce("value", _per_feature(modes, "string")).alias("value"))
        .agg(F.sum("rows").alias("rows"))
        .withColumn("is_rare", F.col("rows") < min_rows)
    )
    sizes = (
        totals.groupBy("feature")
        .agg(F.count("*").alias("values"), F.count_if("is_rare").alias("rare"))
        .collect()
    )
    values = {r["feature"]: r["values"] for r in sizes}
    frequent = {r["feature"]: r["values"] - r["rare"] for r in sizes}
    any_rare = {r["feature"]: r["rare"] > 0 for r in sizes}
    # Only the values that become columns are numbered.
    indexed = numbered(totals.filter(~F.col("is_rare")), sum(frequent.values()), limits or ScaleLimits())
    indexed = indexed.unionByName(
        totals.filter("is_rare").withColumn("index", _per_feature(frequent, "int"))
    )
    slots = {f: n + any_rare[f] for f, n in frequent.items()}
    frame = pin(indexed.withColumn("slots", _per_feature(slots, "int")))
    return CategoryIndex(frame, modes, values, frequent, any_rare)


class TabularEncoder(Estimator):
    """Learns how to turn a wide table into one vector column."""

    def __init__(self, cfg: RiskConfig) -> None:
        super().__init__()
        self.cfg = cfg

    def _fit(self, dataset: DataFrame) -> "TabularEncoderModel":
        groups = feature_groups(dataset.schema, self.cfg)
        limits = self.cfg.limits
        categories = None
        described: list[dict] = []
        if groups.categorical:
            counts = pin(category_counts(dataset, list(groups.categorical)))
            index = category_index(counts, self.cfg.min_category_count, limits)
            categories = index.frame
            described = self._describe(index, list(groups.categorical))
        return TabularEncoderModel(
            {
                "numeric": numeric_statistics(dataset, list(groups.numeric), limits),
                "categorical": described,
                "broadcast_rows": limits.broadcast_rows,
            },
            categories,
        )

    @staticmethod
    def _describe(index: CategoryIndex, order: list[str]) -> list[dict]:
        """Per feature its place and width in the vector; the names stay in the table."""
        if not index.modes:
            return []
        # Values that look like the name of the shared column, and the filling values' places.
        alike = F.col("value").rlike(f"^{INFREQUENT}_*$") & ~F.col("is_rare")
        is_mode = F.col("value") == _per_feature(index.modes, "string")
        few = index.frame.filter(alike | is_mode).select("feature", "value", "index").collect()
        taken = {(r["feature"], r["value"]) for r in few}
        places = {r["feature"]: r["index"] for r in few if r["value"] == index.modes[r["feature"]]}
        described, offset = [], 0
        for f in order:
            if f not in index.modes:
                continue
            shared = None
            if index.any_rare[f]:
                shared = INFREQUENT
                while (f, shared) in taken:
                    shared += "_"
            width = index.frequent[f] + index.any_rare[f]
            described.append(
                {
                    "name": f,
                    "mode": index.modes[f],
                    "mode_index": places[f],
                    "values": index.values[f],
                    "width": width,
                    "offset": offset,
                    "shared": shared,
                }
            )
            offset += width
        return described


class TabularEncoderModel(Model, MLWritable, MLReadable):
    """Adds the ``features`` vector: scaled numbers, then one-hot categories.

    A value never seen in training becomes all zeros; a column the input lacks
    counts as missing. A vocabulary of at most ``broadcast_rows`` values is looked up
    column by column without a shuffle; a larger one in long form (see ``slots``).
    """

    state = Param(Params._dummy(), "state", "learned statistics as JSON")

    def __init__(self, learned: dict | None = None, categories: DataFrame | None = None) -> None:
        super().__init__()
        self._set(state=json.dumps(learned or {}))
        self.categories = categories

    @property
    def learned(self) -> dict:
        return json.loads(self.getOrDefault(self.state))

    @property
    def input_columns(self) -> list[str]:
        learned = self.learned
        return [c["name"] for c in learned["numeric"] + learned["categorical"]]

    @property
    def width(self) -> int:
        """Entries of a feature vector."""
        learned = self.learned
        return len(learned["numeric"]) + sum(c["width"] for c in learned["categorical"])

    def names(self, places: Sequence[int]) -> dict[int, str]:
        """What stands at the given places of the vector; only these names are read."""
        learned = self.learned
        first = len(learned["numeric"])
        found = {i: learned["numeric"][i]["name"] for i in places if i < first}
        offsets = {c["name"]: c["offset"] + first for c in learned["categorical"]}
        for c in learned["categorical"]:
            last = offsets[c["name"]] + c["width"] - 1
            if c["shared"] is not None and last in places:
                found[last] = f"{c['name']}_{c['shared']}"
        rest = [i for i in places if i not in found]
        if rest:
            place = _per_feature(offsets, "int") + F.col("index")
            named = self.categories.filter(~F.col("is_rare")).select(
                place.alias("place"), F.concat_ws("_", "feature", "value").alias("name")
            )
            found |= {r["place"]: r["name"] for r in named.filter(F.col("place").isin(*rest)).collect()}
        return found

    def scaled(self, dataset: DataFrame) -> DataFrame:
        """Numeric inputs filled with the median and standardized, as ``_n_<name>``."""
        columns = {}
        for c in self.learned["numeric"]:
            value = (
                _number(dataset.schema[c["name"]])
                if c["name"] in dataset.columns
                else F.lit(None).cast("double")
            )
            filled = F.coalesce(value, F.lit(c["median"]))
            columns[f"_n_{c['name']}"] = (filled - F.lit(c["mean"])) / F.lit(c["scale"])
        return dataset.withColumns(columns) if columns else dataset

    def looked_up(self, dataset: DataFrame) -> DataFrame:
        """One-hot vector per categorical input, as ``_v_<name>``, by broadcast joins."""
        out = dataset
        described = self.learned["categorical"]
        for c in described:
            name = c["name"]
            value = F.col(name).cast("string") if name in dataset.columns else F.lit(None)
            lookup = self.categories.filter(F.col("feature") == name).select(
                F.col("value").alias("_v"), F.col("index").alias("_x")
            )
            index = F.coalesce(F.col("_x"), F.lit(c["width"])).cast("double")
            # With the sizes in the column metadata, fitting the encoder reads no rows.
            size = {"type": "nominal", "name": f"_i_{name}", "num_vals": c["width"]}
            out = (
                out.withColumn("_known", F.coalesce(value, F.lit(c["mode"])))
                .join(F.broadcast(lookup), F.col("_known") == F.col("_v"), "left")
                .withColumn(f"_i_{name}", index)
                .withMetadata(f"_i_{name}", {"ml_attr": size})
                .drop("_known", "_v", "_x")
            )
        indexes = [f"_i_{c['name']}" for c in described]
        # Dropping the extra slot for invalid values makes the unknown value all zeros.
        encoder = OneHotEncoder(
            inputCols=indexes,
            outputCols=[f"_v_{c['name']}" for c in described],
            handleInvalid="keep",
            dropLast=True,
        )
        return encoder.fit(out).transform(out).drop(*indexes)

    def slots(self, rows: DataFrame) -> DataFrame:
        """(ROW, slots): the one-hot places of each row of ``rows``, which has the ROW column.

        Values go to rows (ROW, feature, value), are joined with the vocabulary at once, and
        come together again by ROW, whatever the number of columns. The most frequent values
        are broadcast, so none of them meets in one task, and missing values are not joined at
        all. Rows without any known value have an empty list.
        """
        described = self.learned["categorical"]
        values = {
            c["name"]: F.col(c["name"]).cast("string") if c["name"] in rows.columns else F.lit(None).cast("string")
            for c in described
        }
        filled = [
            F.when(values[c["name"]].isNull(), F.lit(c["offset"] + c["mode_index"])) for c in described
        ]
        missing = rows.select(ROW, F.explode_outer(F.array_compact(F.array(*filled))).alias("slot"))
        tall = rows.select(
            ROW,
            F.explode(
                F.array(*[F.struct(F.lit(f).alias("feature"), v.alias("value")) for f, v in values.items()])
            ).alias("_p"),
        ).select(ROW, F.col("_p.feature").alias("feature"), F.col("_p.value").alias("value"))
        tall = tall.filter(F.col("value").isNotNull())
        slot = (_per_feature({c["name"]: c["offset"] for c in described}, "int") + F.col("index")).alias("slot")
        known = self.categories.select("feature", "value", "rows", slot)
        by_use = (F.desc("rows"), F.asc("feature"), F.asc("value"))
        head = pin(known.orderBy(*by_use).limit(self.learned["broadcast_rows"]).drop("rows"))
        keys = ["feature", "value"]
        tail = known.drop("rows").join(F.broadcast(head.select(keys)), keys, "left_anti")
        common = tall.join(F.broadcast(head), keys).select(ROW, "slot")
        others = tall.join(F.broadcast(head.select(keys)), keys, "left_anti").join(tail, keys).select(ROW, "slot")
        found = missing.unionByName(common).unionByName(others)
        return found.groupBy(ROW).agg(F.sort_array(F.collect_list("slot")).alias("slots"))

    def in_long_form(self, dataset: DataFrame) -> DataFrame:
        """The one-hot part of the vector as ``_v_all``; rows are numbered and stored first."""
        width = sum(c["width"] for c in self.learned["categorical"])
        rows = dataset
        if ROW not in dataset.columns:
            rows = pin(dataset.withColumn(ROW, F.monotonically_increasing_id()))
        ones = F.transform("slots", lambda _: F.lit(1.0))
        # Stored in the layout of a sparse vector, and read as one.
        sparse = F.struct(
            F.lit(0).cast("tinyint").alias("type"), F.lit(width).alias("size"),
            F.col("slots").alias("indices"), ones.alias("values"),
        )
        schema = T.StructType([T.StructField(ROW, T.LongType()), T.StructField("_v_all", VectorUDT())])
        hot = pin(self.slots(rows).select(ROW, sparse.alias("_v_all")), schema=schema)
        size = {"ml_attr": {"num_attrs": width}}
        out = rows.join(hot, ROW).withMetadata("_v_all", size)
        return out if ROW in dataset.columns else out.drop(ROW)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        described = self.learned["categorical"]
        numeric = [f"_n_{c['name']}" for c in self.learned["numeric"]]
        vectors: list[str] = []
        wide = dataset
        if described and sum(c["values"] for c in described) <= self.learned["broadcast_rows"]:
            vectors = [f"_v_{c['name']}" for c in described]
            wide = self.looked_up(wide)
        elif described:
            vectors = ["_v_all"]
            wide = self.in_long_form(wide)
        wide = self.scaled(wide)
        assembled = VectorAssembler(inputCols=numeric + vectors, outputCol=FEATURES)
        return assembled.transform(wide).drop(*numeric, *vectors)

    def write(self) -> MLWriter:
        return _EncoderWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _EncoderReader()


class _EncoderWriter(MLWriter):
    def __init__(self, instance: TabularEncoderModel) -> None:
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession)
        if self.instance.categories is not None:
            self.instance.categories.write.parquet(join_path(path, "categories"))


class _EncoderReader(MLReader):
    def load(self, path: str) -> TabularEncoderModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = TabularEncoderModel()
        model._resetUid(metadata["uid"])
        model._set(state=metadata["paramMap"]["state"])
        if model.learned["categorical"]:
            model.categories = self.sparkSession.read.parquet(join_path(path, "categories"))
        return model
