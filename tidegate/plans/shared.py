"""Extracts of a whole table of contracts, with one scan of a source for all contracts of one layout.

A layout is what must be equal for contracts to share a scan and a writer: the source table, the
fields they filter, the fields they keep and the order. Contracts of a layout differ in filter values and
caps, and there may be any number of them:

* Contracts are parsed and their values checked by tasks, not by the driver; a broken one becomes a failed row.
* Contracts with the same filters are one shape. Shapes meet the rows of the source in an equality join, on one of
  the equality fields or, where there is none, on bins of a range field cut at the source's quantiles;
  other filters are conditions of that join. A row meets a shape once.
* Every task keeps at most the largest cap of a shape's rows. What is left is dealt out by ranges of (shape, order) and
  counted per range, which gives each row its rank in its shape without gathering a shape in one task.
* A contract takes the ranks up to its cap. All contracts of the layout are written by one job into
  a folder each.

The number of Spark jobs depends on the number of layouts only.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator
from decimal import ROUND_CEILING, ROUND_FLOOR, Decimal
from functools import reduce
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..contracts import ContractError, ExtractSpec, typed_value
from ..functions.hashing import SourceIdentity, fingerprint
from ..operators.extract import _INTEGRAL_RANGE, _fits
from ..operators.idempotency import plan_extracts
from ..session import path_exists, run_folder, time_limit
from ..sinks.extracts import CSV_OPTIONS, csv_ready
from ..sinks.objects import write_objects
from .extracts import MARKER_SCHEMA, SUMMARY_SCHEMA, read_extract_markers
from .skew import join_back

BINS = 64
#: Seconds that the jobs of one layout may take, however many contracts it has.
LONGEST = 86_400
#: Partition column of written extracts.
OUTPUT = "tidegate_output"
_ROW_BITS = 33
_PARSED = (
    "fingerprint string, marker_key string, output_key string, template_id string, row_limit bigint, timeout_seconds bigint, error string, "
    "layout string, shape string, empty boolean, equal map<string, array<string>>, "
    "ranges map<string, struct<low: string, high: string, needed: boolean>>")


# Contracts

def _text(value: Any, dtype: T.DataType) -> str:
    """The literal as text that casts back to the column's type."""
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return repr(float(value))
    if isinstance(value, Decimal):
        return str(int(value)) if isinstance(dtype, T.IntegralType) else format(value, "f")
    if isinstance(dtype, T.TimestampNTZType):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, bool):
        return "true" if value else "false"
    return value if isinstance(value, str) else value.isoformat()


def _bound(value: Any, dtype: T.DataType, lower: bool) -> tuple[str | None, bool]:
    """A bound tightened to what the column can hold, or None, and whether any value is within it."""
    if isinstance(dtype, (T.IntegralType, T.DecimalType)):
        unit = Decimal(1) if isinstance(dtype, T.IntegralType) else Decimal(1).scaleb(-dtype.scale)
        limit = Decimal(1 << _INTEGRAL_RANGE[type(dtype)]) if isinstance(dtype, T.IntegralType) else Decimal(10) ** (dtype.precision - dtype.scale)
        if not -limit < value < limit:
            return None, (value < 0) == lower
        value = (value / unit).to_integral_value(ROUND_CEILING if lower else ROUND_FLOOR) * unit
    return _text(value, dtype), True


def _fields_of(spec: ExtractSpec, schema: T.StructType) -> dict[str, Any]:
    """Layout, shape and typed values of one contract; raises where it does not fit the table."""
    types = {f.name: f.dataType for f in schema.fields}

    def known(name: str, code: str) -> T.DataType:
        if name not in types:
            raise ContractError(code, f"field '{name}' does not exist in the table")
        return types[name]
    equal: dict[str, list[str]] = {}
    ranges: dict[str, dict[str, Any]] = {}
    empty = False
    for f in spec.filters:
        dtype = known(f.field, "unknown_field")
        if f.operator in ("equal", "in"):
            values = [typed_value(v, dtype, f.field) for v in (f.value if f.operator == "in" else [f.value])]
            texts = list(dict.fromkeys(_text(v, dtype) for v in dict.fromkeys(v for v in values if _fits(v, dtype))))
            equal[f.field] = sorted(t for t in texts if f.field not in equal or t in equal[f.field])
            empty = empty or not equal[f.field]
        else:
            bound, some = _bound(typed_value(f.value, dtype, f.field), dtype, f.operator == "min")
            ranges.setdefault(f.field, {"low": None, "high": None, "needed": True})["low" if f.operator == "min" else "high"] = bound
            empty = empty or not some
    for name in spec.select_fields:
        known(name, "unknown_select_field")
    shown = list(spec.select_fields) or schema.names
    if spec.order_field is not None and spec.order_field not in shown:
        raise ContractError("unknown_order_field", f"field '{spec.order_field}' does not exist in the table")
    layout = {"schema": spec.schema, "table": spec.table, "equal": sorted(equal), "range": sorted(ranges), "select": shown,
              "order": spec.order_field, "descending": spec.descending}
    return {"layout": json.dumps(layout), "shape": json.dumps([empty, sorted(equal.items()), sorted(ranges.items())]), "empty": empty,
            "equal": equal, "ranges": ranges}


def parse_contracts(contracts: DataFrame, sources: dict[tuple[str, str], str], errors: dict[tuple[str, str], str]) -> DataFrame:
    """Every contract with its layout, shape and values, or an error; ``sources`` holds table schemas as JSON."""
    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        schemas = {key: T.StructType.fromJson(json.loads(text)) for key, text in sources.items()}
        for batch in batches:
            out = []
            for row in batch.to_dict("records"):
                made: dict[str, Any] = {"error": None, "layout": None, "shape": None, "empty": None, "equal": None, "ranges": None}
                try:
                    spec = ExtractSpec.from_dict({
                        "params": json.loads(row["params"]), "template_id": row["template_id"],
                        "row_limit": int(row["row_limit"]), "timeout_seconds": int(row["timeout_seconds"])})
                    if (spec.schema, spec.table) in errors:
                        made["error"] = errors[spec.schema, spec.table]
                    else:
                        made |= _fields_of(spec, schemas[spec.schema, spec.table])
                except (ContractError, ValueError, TypeError) as exc:
                    made["error"] = f"{type(exc).__name__}: {exc}"
                out.append({k: v for k, v in row.items() if k != "params"} | made)
            yield pd.DataFrame(out, columns=[c.split()[0] for c in _COLUMNS])
    return contracts.select("fingerprint", "marker_key", "output_key", "template_id", "row_limit", "timeout_seconds", "params").mapInPandas(parse, _PARSED)


_COLUMNS = ("fingerprint", "marker_key", "output_key", "template_id", "row_limit", "timeout_seconds", "error", "layout", "shape", "empty", "equal", "ranges")


# Shapes and rows

def _bins(rows: DataFrame, field: str, dtype: T.DataType) -> Callable[[Column], Column]:
    """A function from a value to the number of its bin; one bin for types without quantiles."""
    if not isinstance(dtype, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)):
        return lambda value: F.when(value.isNotNull(), F.lit(0))
    shares = [i / BINS for i in range(1, BINS)]
    cuts = rows.agg(F.percentile_approx(F.col(f"`{field}`"), shares, 10_000).alias("cuts")).first()["cuts"] or []
    marks = F.array(*[F.lit(c).cast(dtype) for c in sorted(set(cuts))]).cast(T.ArrayType(dtype))
    return lambda value: F.when(value.isNotNull(), F.size(F.filter(marks, lambda mark: mark <= value)))


def _met(rows: DataFrame, shapes: DataFrame, layout: dict[str, Any]) -> DataFrame:
    """Rows with every shape they belong to, once each; the row's columns stay in ``row``."""
    types = {f.name: f.dataType for f in rows.schema.fields}
    column = lambda name: F.col("row")[name]
    wide = rows.select(F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("row"))
    keyed = shapes
    for i, name in enumerate(layout["range"]):
        bound = F.col("ranges")[name]
        keyed = keyed.withColumns({f"low_{i}": bound["low"].cast(types[name]), f"high_{i}": bound["high"].cast(types[name])})
    for i, name in enumerate(layout["equal"]):
        keyed = keyed.withColumn(f"any_{i}", F.col("equal")[name].cast(T.ArrayType(types[name])))
    checks = [column(name) == F.col("key") if i == 0 else F.array_contains(F.col(f"any_{i}"), column(name)) for i, name in enumerate(layout["equal"])]
    for i, name in enumerate(layout["range"]):
        low, high = F.col(f"low_{i}"), F.col(f"high_{i}")
        checks += [column(name).isNotNull(), low.isNull() | (column(name) >= low), high.isNull() | (column(name) <= high)]
    if layout["equal"]:
        keyed, wide = keyed.withColumn("key", F.explode("any_0")), wide.withColumn("met", column(layout["equal"][0]))
    elif layout["range"]:
        at = _bins(rows, layout["range"][0], types[layout["range"][0]])
        first, last = F.coalesce(at(F.col("low_0")), F.lit(0)), F.coalesce(at(F.col("high_0")), F.lit(BINS))
        keyed = keyed.where(first <= last).withColumn("key", F.explode(F.sequence(first, last)))
        wide = wide.withColumn("met", at(column(layout["range"][0])))
    else:
        # Without filters there is one shape.
        keyed, wide = keyed.withColumn("key", F.lit(0)), wide.withColumn("met", F.lit(0))
    joined = wide.join(keyed.drop("equal", "ranges"), reduce(lambda a, b: a & b, checks, F.col("met") == F.col("key")))
    return joined.select("row", "shape", "most")


def _ranked(met: DataFrame, layout: dict[str, Any], key: tuple[str, ...], most: int, folder: str) -> tuple[DataFrame, DataFrame]:
    """Rows with their range and place in it, and per range of a shape how many ranks come before."""
    spark, order = met.sparkSession, []
    names = [n for n in ([layout["order"]] if layout["order"] else []) + list(key if layout["order"] else ()) if n in met.schema["row"].dataType.names]
    rows = met.withColumns({"scanned": F.monotonically_increasing_id(), "task": F.spark_partition_id()})
    for i, name in enumerate(dict.fromkeys(names)):
        rows = rows.withColumn(f"by_{i}", F.col("row")[name])
        order.append(F.col(f"by_{i}").desc_nulls_last() if i == 0 and layout["descending"] else F.col(f"by_{i}").asc_nulls_last())
    order.append(F.col("scanned").asc())
    # Each task's share first: Spark cuts it before anything is sent.
    cut = rows.withColumn("nth", F.row_number().over(Window.partitionBy("shape", "task").orderBy(*order)))
    cut = cut.where(F.col("nth") <= most).where(F.col("nth") <= F.col("most"))
    kept = F.struct(*[F.col("row")[name].alias(name) for name in layout["select"]]).alias("row")
    cut = cut.select("shape", kept, *[c for c in rows.columns if c.startswith("by_")], "scanned")
    cut.write.parquet(f"{folder}/cut")
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = spark.read.parquet(f"{folder}/cut").repartitionByRange(ranges, "shape", *order).sortWithinPartitions("shape", *order)
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    # Range bounds come from a sample and would differ in a second run of the plan, so the ranges are written once.
    dealt.select("shape", "row", place.alias("place"), F.spark_partition_id().alias("part")).write.parquet(f"{folder}/dealt")
    dealt = spark.read.parquet(f"{folder}/dealt")
    sizes = dealt.groupBy("shape", "part").agg(F.min("place").alias("first"), F.count("*").alias("size"))
    before = F.sum("size").over(Window.partitionBy("shape").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    sizes.withColumn("start", F.coalesce(before, F.lit(0)) - F.col("first")).write.parquet(f"{folder}/ranges")
    return dealt, spark.read.parquet(f"{folder}/ranges")


def _folder_of(output_key: Column) -> Column:
    return F.regexp_replace(output_key, "/[^/]*$", "")


def output_path(root: str, output_key: str) -> str:
    """Where the files of one contract are: the folder its key names, with its name as a partition value."""
    folder, _, name = output_key.rpartition("/")
    return f"{root}/{folder}/{OUTPUT}={name}"


def _write(rows: DataFrame, path: str, output_format: str) -> None:
    """One folder an output; its part files follow the ranks."""
    ranges = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(ranges, OUTPUT, "rank").sortWithinPartitions(OUTPUT, "rank").select(OUTPUT, "row.*")
    writer = (csv_ready(dealt) if output_format == "csv" else dealt).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy(OUTPUT)
    if output_format == "csv":
        writer.options(**CSV_OPTIONS).csv(path)
    elif output_format == "parquet":
        writer.parquet(path)
    else:
        writer.option("ignoreNullFields", "false").json(path)


def _run_layout(spark: SparkSession, contracts: DataFrame, layout: dict[str, Any], rows: DataFrame, root: str, key: tuple[str, ...],
                output_format: str, folder: str) -> DataFrame:
    """Write the extracts of one layout and return fingerprint and number of rows of each."""
    able = contracts.where("NOT empty")
    shapes = able.groupBy("shape").agg(F.max("row_limit").alias("most"), F.first("equal").alias("equal"), F.first("ranges").alias("ranges"))
    most = able.agg(F.max("row_limit")).first()[0] or 0
    dealt, ranges = _ranked(_met(rows, shapes, layout), layout, key, most, folder)
    asked = contracts.select("fingerprint", "shape", "row_limit", _folder_of(F.col("output_key")).alias("folder"),
                             F.substring_index("output_key", "/", -1).alias("output"))
    # Contracts go to the ranges that hold ranks of theirs, so a shape of many contracts is spread like its rows.
    taken = join_back(ranges, asked, ["shape"], "inner").where(F.col("start") + F.col("first") < F.col("row_limit"))
    taken.write.parquet(f"{folder}/taken")
    taken = spark.read.parquet(f"{folder}/taken")
    chosen = dealt.join(taken, ["shape", "part"]).withColumn("rank", F.col("start") + F.col("place")).where("rank < row_limit")
    for place in sorted(r["folder"] for r in asked.select("folder").distinct().collect()):
        _write(chosen.where(F.col("folder") == place).select(F.col("output").alias(OUTPUT), "rank", "row"), f"{root}/{place}", output_format)
    counts = taken.groupBy("fingerprint").agg(F.sum(F.least("size", F.col("row_limit") - F.col("start") - F.col("first"))).alias("row_count"))
    counted = asked.join(counts, "fingerprint", "left").withColumn("row_count", F.coalesce("row_count", F.lit(0)))
    if output_format == "csv":
        header = ",".join(f'"{n}"'.replace('"', '""')[1:-1] if any(c in n for c in ',"\n') else n for n in layout["select"]) + "\n"
        write_objects(counted.where("row_count = 0").select(
            F.concat_ws("/", "folder", F.concat(F.lit(f"{OUTPUT}="), "output"), F.lit("part-00000.csv")).alias("key"),
            F.lit(header).cast("binary").alias("content")), root)
    return counted.select("fingerprint", "row_count")


def _sizes(spark: SparkSession, root: str, folders: list[str]) -> DataFrame:
    """Bytes of every output below some folders, from the listing alone."""
    there = [f"{root}/{f}" for f in folders if path_exists(spark, f"{root}/{f}")]
    if not there:
        return spark.createDataFrame([], "output string, bytes bigint")
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*").load(there)
    return listing.groupBy(F.regexp_extract("path", f"{OUTPUT}=([^/]*)/[^/]*$", 1).alias("output")).agg(F.sum("length").alias("bytes"))


def run_shared(
    spark: SparkSession, contracts: DataFrame, table: Callable[[str, str], DataFrame], root: str,
    table_key: Callable[[str, str], tuple[str, ...]] = lambda schema, name: (), output_format: str = "csv",
) -> DataFrame:
    """Run every contract of a table and return a summary row for each.

    ``contracts`` has ``fingerprint`` (once each), ``marker_key``, ``output_key``, ``template_id``, ``params``,
    ``row_limit`` and ``timeout_seconds``. The jobs of a layout may take as long as its contracts may together. Markers follow
    the data in one write; contracts of a layout that failed get none and may be run again, which
    replaces their folders. Which rows an unordered cap keeps is open, as it is for one contract.
    """
    folder, started = run_folder(spark, "shared"), time.time()
    named = contracts.withColumns({n: F.get_json_object("params", f"$.{n}") for n in ("schema", "table")})
    sources: dict[tuple[str, str], DataFrame] = {}
    errors: dict[tuple[str, str], str] = {}
    for r in named.select("schema", "table").where("schema IS NOT NULL AND table IS NOT NULL").distinct().collect():
        try:
            sources[r["schema"], r["table"]] = table(r["schema"], r["table"])
        except Exception as exc:  # a source that is gone fails its own contracts
            errors[r["schema"], r["table"]] = f"{type(exc).__name__}: {exc}"
    parse_contracts(contracts, {k: df.schema.json() for k, df in sources.items()}, errors).write.parquet(f"{folder}/parsed")
    parsed = spark.read.schema(_PARSED).parquet(f"{folder}/parsed")
    layouts = [r["layout"] for r in parsed.where("layout IS NOT NULL").select("layout").distinct().orderBy("layout").collect()]
    done: list[DataFrame] = []
    failed: list[tuple[str, str]] = []
    for i, text in enumerate(layouts):
        layout, mine = json.loads(text), parsed.where(F.col("layout") == text)
        source = (layout["schema"], layout["table"])
        try:
            allowed = mine.agg(F.sum("timeout_seconds")).first()[0]
            with time_limit(spark, min(allowed, LONGEST)):
                made = _run_layout(spark, mine, layout, sources[source], root, table_key(*source), output_format, f"{folder}/layout-{i}")
                made.write.parquet(f"{folder}/done-{i}")
            done.append(spark.read.parquet(f"{folder}/done-{i}"))
        except Exception as exc:  # one layout must not stop the others
            failed.append((text, f"{type(exc).__name__}: {exc}"))
    counts = reduce(DataFrame.unionByName, done, spark.createDataFrame([], "fingerprint string, row_count bigint"))
    reasons = spark.createDataFrame(failed, "layout string, reason string")
    spans = [r["folder"] for r in parsed.where("layout IS NOT NULL").select(_folder_of(F.col("output_key")).alias("folder")).distinct().collect()]
    rows = parsed.withColumn("output", F.substring_index("output_key", "/", -1)).join(F.broadcast(reasons), "layout", "left").join(
        counts, "fingerprint", "left").join(_sizes(spark, root, spans), "output", "left")
    ok = F.col("row_count").isNotNull()
    summary = rows.select(
        "fingerprint", "marker_key", F.when(ok, F.col("output_key")).otherwise("").alias("output_key"),
        F.coalesce("row_count", F.lit(0)).alias("row_count"), F.when(ok, F.coalesce("bytes", F.lit(0))).otherwise(0).cast("bigint").alias("file_size_bytes"),
        F.lit(time.time() - started).alias("duration_seconds"), F.lit(False).alias("skipped"), F.when(ok, "done").otherwise("failed").alias("status"),
        F.when(ok, "").otherwise(F.coalesce("error", "reason", F.lit(""))).alias("error"), "template_id", "row_limit", "timeout_seconds")
    summary.write.parquet(f"{folder}/summary")
    summary = spark.read.parquet(f"{folder}/summary")
    marker_names = [f.split()[0] for f in MARKER_SCHEMA.split(", ")]
    summary.where("status = 'done'").select(*marker_names).write.mode("append").parquet(f"{root}/markers")
    return summary.select(*[f.split()[0] for f in SUMMARY_SCHEMA.split(", ")])


def extract_all(
    spark: SparkSession, contracts: DataFrame, table: Callable[[str, str], DataFrame], root: str, session: str,
    table_key: Callable[[str, str], tuple[str, ...]] = lambda schema, name: (), output_format: str = "csv",
    source: SourceIdentity = SourceIdentity(),
) -> DataFrame:
    """Run the contracts of a table that have no marker yet; a summary row for each row.

    ``contracts`` has ``contract_id``, ``params``, ``template_id``, ``row_limit`` and ``timeout_seconds``. Of equal contracts
    the first by id is run; the others, and those finished by an earlier call, are skipped.
    """
    folder = run_folder(spark, "contracts")
    keyed = contracts.withColumns({"session": F.lit(session), "fingerprint": fingerprint(
        F.col("params"), F.col("template_id"), F.col("row_limit"), F.col("timeout_seconds"), source)})
    plan_extracts(keyed, read_extract_markers(spark, root), ["contract_id"]).write.parquet(folder)
    planned = spark.read.parquet(folder)
    ran = run_shared(spark, planned.where("action = 'run'"), table, root, table_key, output_format)
    nothing = {"output_key": "", "row_count": 0, "file_size_bytes": 0, "duration_seconds": 0.0, "error": ""}
    skipped = planned.where("action <> 'run'").select("fingerprint", "marker_key", *[F.lit(v).alias(k) for k, v in nothing.items()],
                                                      F.lit(True).alias("skipped"), F.lit("skipped").alias("status"))
    return ran.unionByName(skipped.select(*[F.col(f.name).cast(f.dataType) for f in ran.select(*skipped.columns).schema.fields]))
