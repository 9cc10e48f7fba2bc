"""The metric registry: validated entries, run in dependency order, written and published as views."""

from __future__ import annotations

import graphlib
import hashlib
import inspect
import sys
import sysconfig
from collections.abc import Callable
from dataclasses import dataclass, field
from decimal import Decimal
from functools import lru_cache

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from tidemark.sources.schemas import SCHEMAS

Value = str | int | float | bool
#: Points of the longest series that is exported: days of some 270 years.
MOST_POINTS = 100_000


@dataclass(frozen=True)
class Metric:
    """One metric: SQL with named parameters over views, or a function of those views."""

    name: str
    version: int
    definition: str
    sql: str | None = None
    build: Callable[[dict[str, DataFrame], dict[str, Value]], DataFrame] | None = None
    params: dict[str, Value] = field(default_factory=dict)
    depends_on: tuple[str, ...] = ()
    reads: tuple[str, ...] | None = None  # sources that it reads; None: any of them
    changelog: tuple[str, ...] = ()
    export: bool = True
    shard_by: str | None = None
    keyed: Callable[[dict[str, DataFrame]], dict[str, DataFrame]] | None = None  # sources that have the shard key, for sharded runs

    def __post_init__(self):
        if not self.name.isidentifier():
            raise ValueError(f"{self.name!r} is no metric name")
        if self.version < 1:
            raise ValueError(f"{self.name}: versions count from 1")
        if (self.sql is None) == (self.build is None):
            raise ValueError(f"{self.name}: give either sql or build")
        if not all(isinstance(v, Value) for v in self.params.values()):
            raise ValueError(f"{self.name}: parameters are strings, numbers or booleans")


def ordered(metrics: list[Metric]) -> list[Metric]:
    """Metrics after all that they depend on; unknown names, repeated names and cycles are errors."""
    named = {m.name: m for m in metrics}
    if len(named) < len(metrics):
        raise ValueError("a metric name is given twice")
    for m in metrics:
        if unknown := [d for d in m.depends_on if d not in named]:
            raise ValueError(f"{m.name} depends on unknown metrics: {', '.join(unknown)}")
    try:
        return [named[n] for n in graphlib.TopologicalSorter({m.name: m.depends_on for m in metrics}).static_order()]
    except graphlib.CycleError as error:
        raise ValueError(f"metrics depend on each other: {' -> '.join(error.args[1])}") from error


def evaluate(spark: SparkSession, metric: Metric, views: dict[str, DataFrame]) -> DataFrame:
    """A metric's rows from the views it reads; SQL finds them by name and its parameters by :name."""
    if metric.build is not None:
        return metric.build(views, metric.params)
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return spark.sql(metric.sql, args=metric.params)


class Materialised(dict[str, DataFrame]):
    """Written metrics by name, and how many rows each was written with."""

    def __init__(self):
        super().__init__()
        self.rows: dict[str, int] = {}


Source = DataFrame | Callable[[], DataFrame]


def materialise(spark: SparkSession, metrics: list[Metric], sources: dict[str, Source], folder: str) -> Materialised:
    """Run all metrics into folder/<name>, with columns metric and version; each result is read back for those after it.

    A source may be a function: it is called when the first metric that reads it runs, and not at all if none does. Rows
    are counted while they are written.
    """
    built: dict[str, DataFrame] = {}
    done = Materialised()

    def source(m: Metric, name: str) -> DataFrame:
        if name not in sources:
            raise ValueError(f"{m.name} reads an unknown source: {name}")
        if name not in built:
            given = sources[name]
            built[name] = given() if callable(given) else given
        return built[name]

    for m in ordered(metrics):
        path, seen = f"{folder.rstrip('/')}/{m.name}", Observation()
        # A metric that says what it reads sees that and what it depends on; one that doesn't sees everything so far.
        before = m.depends_on if m.reads is not None else done
        views = {name: source(m, name) for name in (sources if m.reads is None else m.reads)} | {name: done[name].drop("metric", "version") for name in before}
        rows = evaluate(spark, m, views).withColumns({"metric": F.lit(m.name), "version": F.lit(m.version)})
        rows.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").option("compression", "zstd").parquet(path)
        done[m.name], done.rows[m.name] = spark.read.parquet(path), seen.get["rows"]
    return done


def row_counts(done: Materialised) -> DataFrame:
    """(metric, rows) of written metrics, as counted while they were written."""
    spark = next(iter(done.values())).sparkSession
    return spark.createDataFrame(list(done.rows.items()), "metric string, rows long")


def exported_points(done: Materialised, metrics: list[Metric]) -> DataFrame:
    """(position, metric, version, timestampMs, value): what is exported, one row per point, metrics numbered in run order.

    NULL values are exported as 0. Nothing is gathered, so a series may have any number of points.
    """
    point = [F.col("timestamp_ms").alias("timestampMs"), F.coalesce(F.col("value").cast("double"), F.lit(0.0)).alias("value")]
    rows = None
    for n, m in enumerate(x for x in ordered(metrics) if x.export):
        one = done[m.name].select(F.lit(n).alias("position"), F.lit(m.name).alias("metric"), F.lit(m.version).alias("version"), *point)
        rows = one if rows is None else rows.unionByName(one)
    if rows is None:
        raise ValueError("no metric is exportable")
    return rows


def export(done: Materialised, metrics: list[Metric]) -> DataFrame:
    """One row per exportable metric in run order: (position, metric, version, points), points sorted by time.

    NULL values are exported as 0. For the document of write_export, in which each series is one row: one of more than
    MOST_POINTS points, such as a minute series, is refused here; exported_points has no such bound.
    """
    rows = None
    for n, m in enumerate(x for x in ordered(metrics) if x.export):
        points = F.sort_array(F.collect_list(F.struct(F.col("timestamp_ms").alias("timestampMs"), F.coalesce(F.col("value").cast("double"), F.lit(0.0)).alias("value"))))
        if done.rows[m.name] > MOST_POINTS:
            raise ValueError(f"{m.name} has too many points to be exported")
        one = done[m.name].agg(points.alias("points")).select(F.lit(n).alias("position"), F.lit(m.name).alias("metric"), F.lit(m.version).alias("version"), "points")
        rows = one if rows is None else rows.unionByName(one)
    if rows is None:
        raise ValueError("no metric is exportable")
    return rows.orderBy("position")


def write_export(rows: DataFrame, path: str) -> None:
    """The export as one JSON document: {"series": [{metric, version, points}]}."""
    series = F.transform(F.sort_array(F.collect_list(F.struct("position", "metric", "version", "points"))), lambda x: F.struct(x["metric"].alias("metric"), x["version"].alias("version"), x["points"].alias("points")))
    rows.agg(F.to_json(F.struct(series.alias("series"))).alias("value")).coalesce(1).write.mode("overwrite").text(path)


def materialise_sharded(spark: SparkSession, metric: Metric, sources: dict[str, DataFrame], folder: str, buckets: int, only: list[int] | None = None) -> DataFrame:
    """A shard_by metric, bucket by bucket, so that a stopped run goes on where it was.

    The sources that have the key column (`keyed` makes them, where the metric has it) are cut into buckets once; a
    bucket then reads its own partition. Each finished bucket is noted in a manifest with a fingerprint of the metric,
    the code that builds it and its inputs. A bucket is skipped only if it has a valid note and its part is there; the
    result equals one pass.
    """
    if metric.shard_by is None:
        raise ValueError(f"{metric.name} has no shard_by")
    key, base = metric.shard_by, f"{folder.rstrip('/')}/{metric.name}"
    bucket = bucket_of(key, buckets)
    sources = {name: df() if callable(df) else df for name, df in sources.items() if metric.reads is None or name in metric.reads}
    # A sum as well as an exclusive or: pairs of equal rows cancel in the latter.
    inputs = [tuple(df.agg(F.count("*"), F.bit_xor(F.xxhash64("*")), F.sum(F.xxhash64("*").cast("decimal(38,0)"))).first()) for _, df in sorted(sources.items())]
    code = [definition(f) for f in (metric.build, metric.keyed)]
    parts = (metric.name, metric.version, metric.sql, code, sorted(metric.params.items()), buckets, sorted(sources), inputs)
    fingerprint = hashlib.sha256(repr(parts).encode()).hexdigest()
    schema = "bucket int, fingerprint string"
    noted = {r["bucket"] for r in (found_or_none(spark, f"{base}.manifest", schema) or spark.createDataFrame([], schema)).where(F.col("fingerprint") == fingerprint).collect()}
    wanted = [b for b in (range(buckets) if only is None else only) if b not in noted or found_or_none(spark, f"{base}/bucket={b}") is None]
    if wanted:
        own = metric.keyed(sources) if metric.keyed else sources
        cut: dict[str, DataFrame] = {}
        for name, df in own.items():
            if key in df.columns:
                path = f"{base}.shards/{fingerprint[:16]}/{name}"
                if found_or_none(spark, f"{path}/_SUCCESS", "value string", "text") is None:
                    # A rebalanced bucket is split where it is large: a task sorts and writes one piece of it.
                    df.withColumn("_bucket", bucket).hint("rebalance", "_bucket").write.mode("overwrite").partitionBy("_bucket").parquet(path)
                cut[name] = spark.read.schema(StructType([*df.schema.fields, StructField("_bucket", IntegerType())])).parquet(path)
        for b in wanted:
            views = own | {name: df.where(F.col("_bucket") == b).drop("_bucket") for name, df in cut.items()}
            evaluate(spark, metric, views).where(bucket == b).write.mode("overwrite").parquet(f"{base}/bucket={b}")
            spark.createDataFrame([(b, fingerprint)], schema).write.mode("append").parquet(f"{base}.manifest")
    return spark.read.parquet(base).drop("bucket")


def bucket_of(key: str, buckets: int) -> Column:
    """The bucket of a row by its key, from 0; null counts as the empty text."""
    return F.pmod(F.xxhash64(F.coalesce(F.col(key).cast("string"), F.lit(""))), F.lit(buckets)).cast("int")


def definition(f: Callable | None) -> str:
    """Digest of what a function does: its code and that of all it reaches, through names, modules, classes and closures.

    Code of installed libraries is named but not followed. What a function finds in other ways, such as by a computed
    name or an attribute of an object, is not seen.
    """
    found: dict[str, str] = {}
    _describe(f, found)
    return hashlib.sha256(repr(sorted(found.items())).encode()).hexdigest()


def _describe(value, found: dict[str, str]) -> str:
    """Text that stands for a value; functions and classes of ours are put into found under their names."""
    if inspect.isfunction(value):
        name = f"{value.__module__}.{value.__qualname__}:{value.__code__.co_firstlineno if '<' in value.__qualname__ else ''}"
        if _is_ours(value.__module__) and name not in found:
            found[name] = ""  # so that a circle ends
            code, inner = value.__code__, [c.cell_contents for c in value.__closure__ or ()]
            parts = [_of_code(code), [_describe(x, found) for x in inner], _describe(value.__defaults__, found), _describe(value.__kwdefaults__, found)]
            for owner in (n for n in sorted(_names(code)) if n in value.__globals__):
                reached = value.__globals__[owner]
                if inspect.ismodule(reached):
                    if _is_ours(reached.__name__):
                        parts += [(owner, n, _describe(vars(reached)[n], found)) for n in sorted(_names(code)) if n in vars(reached)]
                else:
                    parts.append((owner, _describe(reached, found)))
            found[name] = repr(parts)
        return name
    if inspect.isclass(value):
        name = f"{value.__module__}.{value.__qualname__}"
        if _is_ours(value.__module__) and name not in found:
            found[name] = ""
            found[name] = repr([(k, _describe(v, found)) for k, v in sorted(vars(value).items()) if not k.startswith("__") or inspect.isfunction(v)])
        return name
    if isinstance(value, (staticmethod, classmethod)):
        return _describe(value.__func__, found)
    if isinstance(value, (list, tuple)):
        return repr([_describe(x, found) for x in value])
    if isinstance(value, (set, frozenset)):
        return repr(sorted(_describe(x, found) for x in value))
    if isinstance(value, dict):
        return repr(sorted((_describe(k, found), _describe(v, found)) for k, v in value.items()))
    if value is None or isinstance(value, (str, bytes, int, float, Decimal)):
        return repr(value)
    return f"{type(value).__module__}.{type(value).__qualname__}"


def _of_code(code) -> str:
    return repr((code.co_code.hex(), code.co_names, code.co_varnames, [_of_code(c) if hasattr(c, "co_code") else repr(c) for c in code.co_consts]))


def _names(code) -> set[str]:
    """Names that a function's code, and the functions inside of it, look up."""
    return set(code.co_names).union(*[_names(c) for c in code.co_consts if hasattr(c, "co_code")])


@lru_cache(maxsize=None)
def _is_ours(module: str) -> bool:
    """Whether a module is of this package, or neither Python's nor an installed library's."""
    if module.split(".")[0] == __name__.split(".")[0]:
        return True
    file = getattr(sys.modules.get(module.split(".")[0]), "__file__", None) or getattr(sys.modules.get(module), "__file__", None)
    return file is not None and not any(file.startswith(sysconfig.get_path(p)) for p in ("stdlib", "platstdlib", "purelib", "platlib"))


def found_or_none(spark: SparkSession, path: str, schema: str | None = None, kind: str = "parquet") -> DataFrame | None:
    """A table, or None where nothing was written."""
    try:
        return (spark.read.schema(schema) if schema else spark.read).format(kind).load(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return None


def empty(spark: SparkSession, name: str) -> DataFrame:
    return spark.createDataFrame([], SCHEMAS[name])
