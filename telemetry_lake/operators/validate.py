"""Record validation: JSON text to typed rows, with a reason for every refusal.

Three tiers. A record that the typed parser reads without a gap, and that written out again is the very text it came
from, has every field in its natural type: writing puts quotes around text and none around numbers, leaves out
unknown and repeated fields, and knows one order. Compact records of one producer pass here. The others are parsed
into a VARIANT, whose type description tells in one comparison whether a record has the expected shape in any
order and layout. Only what is left is looked at field by field. Everything is a built-in expression, so a batch scan
and a stream run the same plan and nothing is shuffled.
"""

from __future__ import annotations

from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telemetry_lake.functions.frames import evaluated
from telemetry_lake.functions.time import event_timestamp, is_event_timestamp, normal_stamp
from telemetry_lake.schema import SILVER_COLUMNS, TELEMETRY

MODES = ("lax", "strict")
NOT_JSON = "not_json"

# Number text that stands for a whole number, such as 12 or 12.0.
_WHOLE = r"^[+-]?[0-9]+([.]0+)?$"
_NUMBER_TYPES = r"^(BIGINT|BOOLEAN|DOUBLE|FLOAT|DECIMAL.*)$"
_INTEGERS = (T.IntegerType, T.LongType)


def check_records(df: DataFrame, value_col: str = "value", mode: str = "lax") -> DataFrame:
    """Every input row, typed, with ``valid``, ``reject_reasons`` and (if refused) ``raw`` text.

    ``lax`` accepts a number written as text or as a whole-valued fraction where an integer is
    due; ``strict`` accepts integers only. Text fields never accept numbers. Unknown fields are
    ignored, a missing and a null field are both refused.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    rows = df.select(F.col(value_col).alias("_raw"), F.from_json(value_col, TELEMETRY).alias("_read"))
    rows = rows.withColumn("_first_at", event_timestamp(F.col("_read.timestamp")))
    rows = rows.withColumn("_quick", F.coalesce(_is_same_text(), F.lit(False)))
    # Rows that have been read have no document, and the steps that follow pass them by.
    rows = rows.withColumn("_doc", F.when(~F.col("_quick"), F.try_parse_json("_raw")))
    rows = rows.withColumns(
        {
            "_shape": F.schema_of_variant("_doc"),
            "_record": F.try_variant_get("_doc", "$", TELEMETRY.simpleString()),
            "_stamp": F.when(F.col("_quick"), F.col("_read.timestamp")).otherwise(F.try_variant_get("_doc", "$.timestamp", "string")),
        }
    )
    rows = rows.withColumn("_at", F.when(F.col("_quick"), F.col("_first_at")).otherwise(event_timestamp(F.col("_stamp"))))
    rows = rows.withColumn("_timed", F.col("_quick") | is_event_timestamp(F.col("_stamp"), F.col("_at")))
    rows = rows.withColumn("_plain", ~F.col("_quick") & F.coalesce(_is_plain(), F.lit(False)))
    rows = rows.withColumn("_fine", F.col("_quick") | F.col("_plain"))
    rows = rows.withColumn("_checked", _inspected(mode))

    stamp = normal_stamp(F.col("_stamp"), F.col("_at"))
    record = F.when(F.col("_quick"), F.col("_read")).when(F.col("_plain"), F.col("_record")).otherwise(F.col("_checked.record"))
    reasons = F.when(F.col("_fine"), F.array().cast("array<string>")).otherwise(F.col("_checked.reasons"))
    rows = rows.select(
        F.when(F.col("_timed"), stamp).alias("timestamp"),
        record.alias("_record"),
        (F.col("_fine") | (F.size(reasons) == 0)).alias("valid"),
        reasons.alias("reject_reasons"),
        F.when(~F.col("_fine") & (F.size(reasons) > 0), F.col("_raw")).alias("raw"),
    )
    fields = [F.col(f"_record.{n}").alias(n) for n in TELEMETRY.fieldNames() if n != "timestamp"]
    return evaluated(rows.select("timestamp", *fields, "valid", "reject_reasons", "raw"))


def validate(df: DataFrame, value_col: str = "value", mode: str = "lax") -> tuple[DataFrame, DataFrame]:
    """(valid records, rejects with their text and reasons). Together they are the input."""
    checked = check_records(df, value_col, mode)
    valid = checked.filter("valid").select(*TELEMETRY.fieldNames())
    rejects = checked.filter("NOT valid").select("raw", "reject_reasons")
    return valid, rejects


def _paths(struct: T.StructType, prefix: str = "") -> list[tuple[str, T.DataType]]:
    """Every field, nested ones after their parent, with its type."""
    found = []
    for field in struct.fields:
        found.append((prefix + field.name, field.dataType))
        if isinstance(field.dataType, T.StructType):
            found.extend(_paths(field.dataType, f"{prefix}{field.name}."))
    return found


def _plain_name(path: str) -> str:
    return path.replace(".", "_")


def _inspected(mode: str) -> Column:
    """Record and reasons of a row that is not plain, NULL for the others.

    Written as steps over a one-element array, so that each step can use the one before by name
    and plain rows, which have no array, skip all of it.
    """

    def look(x: Column) -> Column:
        found = [x["doc"].alias("doc"), x["timed"].alias("timed"), x["object"].alias("object")]
        for path, _ in _paths(TELEMETRY):
            value = F.try_variant_get(x["doc"], f"$.{path}", "variant")
            text = F.try_variant_get(x["doc"], f"$.{path}", "string")
            found.append(F.struct(F.schema_of_variant(value).alias("kind"), text.alias("text")).alias(_plain_name(path)))
        return F.struct(*found)

    def judge(x: Column) -> Column:
        fits = [
            F.coalesce(_fits(x, path, dtype, mode), F.lit(False)).alias(_plain_name(path))
            for path, dtype in _paths(TELEMETRY)
        ]
        return F.struct(x.alias("seen"), F.struct(*fits).alias("ok"))

    def settle(x: Column) -> Column:
        read = F.struct(*[_value(x, f.name, f.dataType).alias(f.name) for f in TELEMETRY.fields])
        reasons = F.array_except(F.array(*_reasons(x)), _null_text())
        reasons = F.when(x["seen"]["object"], reasons).otherwise(F.array(F.lit(NOT_JSON)))
        return F.struct(read.alias("record"), reasons.alias("reasons"))

    is_object = F.coalesce(F.startswith(F.col("_shape"), F.lit("OBJECT")), F.lit(False))
    start = F.struct(F.col("_doc").alias("doc"), F.col("_timed").alias("timed"), is_object.alias("object"))
    steps = F.when(~F.col("_fine"), F.array(start))
    for step in (look, judge, settle):
        steps = F.transform(steps, step)
    return steps[0]


def _shape(dtype: T.DataType) -> str:
    """How a VARIANT describes a value of this type; objects list their fields by name."""
    if isinstance(dtype, T.StructType):
        inner = sorted((f.name, _shape(f.dataType)) for f in dtype.fields)
        return "OBJECT<" + ", ".join(f"{name}: {kind}" for name, kind in inner) + ">"
    if isinstance(dtype, T.ArrayType):
        return f"ARRAY<{_shape(dtype.elementType)}>"
    return "BIGINT" if isinstance(dtype, _INTEGERS) else "STRING"


def _is_same_text() -> Column:
    """Records that were read whole, whose time reads, and that written out again are the text they came from."""
    same = (F.to_json("_read") == F.col("_raw")) & is_event_timestamp(F.col("_read.timestamp"), F.col("_first_at"))
    for path, dtype in _paths(TELEMETRY):
        if not isinstance(dtype, T.StructType):
            same = same & F.col(f"_read.{path}").isNotNull()
    return same & _has_no_null(F.col("_read.flags"))


def _is_plain() -> Column:
    """Records whose every field has its natural JSON type, whose numbers fit and whose time reads."""
    usual = _shape(TELEMETRY)
    shapes = []
    for stamp, flags in product(("STRING", "BIGINT"), ("STRING", "VOID")):
        shape = usual.replace("timestamp: STRING", f"timestamp: {stamp}")
        shapes.append(shape.replace("flags: ARRAY<STRING>", f"flags: ARRAY<{flags}>"))
    plain = F.col("_shape").isin(*shapes) & F.col("_timed") & _has_no_null(F.col("_record.flags"))
    for path, dtype in _paths(TELEMETRY):
        if isinstance(dtype, _INTEGERS):
            plain = plain & F.col(f"_record.{path}").isNotNull()
    return plain


def _null_text() -> Column:
    return F.array(F.lit(None).cast("string"))


def _has_no_null(texts: Column) -> Column:
    return F.size(F.array_except(_null_text(), texts)) == 1


def _number_in_text(text: Column, dtype: T.DataType) -> Column:
    return F.regexp_replace(F.trim(text), r"[.]0+$", "").try_cast(dtype)


def _fits(x: Column, path: str, dtype: T.DataType, mode: str) -> Column:
    field = x[_plain_name(path)]
    kind, text = field["kind"], field["text"]
    if isinstance(dtype, T.StructType):
        return kind.startswith("OBJECT")
    if isinstance(dtype, T.ArrayType):
        # An empty array has no element type.
        texts = F.try_variant_get(x["doc"], f"$.{path}", "array<string>")
        return kind.isin("ARRAY<STRING>", "ARRAY<VOID>") & _has_no_null(texts)
    if path == "timestamp":
        return x["timed"] & ((kind == "STRING") | (kind.rlike(_NUMBER_TYPES) & (kind != "BOOLEAN")))
    if isinstance(dtype, T.StringType):
        return kind == "STRING"
    number = F.try_variant_get(x["doc"], f"$.{path}", dtype.simpleString())
    if mode == "strict":
        return (kind == "BIGINT") & number.isNotNull()
    double = F.try_variant_get(x["doc"], f"$.{path}", "double")
    whole_number = kind.rlike(_NUMBER_TYPES) & number.isNotNull() & (double == F.floor(double))
    whole_text = F.trim(text).rlike(_WHOLE) & _number_in_text(text, dtype).isNotNull()
    return F.when(kind == "STRING", whole_text).otherwise(whole_number)


def _reasons(x: Column) -> list[Column]:
    """One entry per field, NULL when it is fine; a nested field speaks only if its parent is there."""
    reasons = []
    for path, _ in _paths(TELEMETRY):
        kind = x["seen"][_plain_name(path)]["kind"]
        reason = F.when(kind.isNull() | (kind == "VOID"), F.lit(f"{path}: missing")).when(
            ~x["ok"][_plain_name(path)], F.lit(f"{path}: wrong type")
        )
        parent = path.rpartition(".")[0]
        reasons.append(F.when(x["ok"][parent], reason) if parent else reason)
    return reasons


def _value(x: Column, path: str, dtype: T.DataType) -> Column:
    field, doc = x["seen"][_plain_name(path)], x["seen"]["doc"]
    if isinstance(dtype, T.StructType):
        value = F.struct(*[_value(x, f"{path}.{f.name}", f.dataType).alias(f.name) for f in dtype.fields])
    elif isinstance(dtype, T.ArrayType):
        value = F.try_variant_get(doc, f"$.{path}", "array<string>")
    elif isinstance(dtype, T.StringType):
        value = field["text"]
    else:
        number = F.try_variant_get(doc, f"$.{path}", dtype.simpleString())
        value = F.when(field["kind"] == "STRING", _number_in_text(field["text"], dtype)).otherwise(number)
    return F.when(x["ok"][_plain_name(path)], value)


def parse_events(df: DataFrame, value_col: str = "value") -> tuple[DataFrame, DataFrame]:
    """Detector parse: the six fields it uses plus ``ts``; other fields are ignored.

    Returns (events, rejects). A line that is not a JSON object, or lacks a readable time,
    source or number, goes to the rejects instead of stopping the job. Numbers written as text
    are read, fractions are cut off, and an absent number counts as zero.
    """
    numbers = {"bytes_sent": "bigint", "latency_ms": "int"}
    schema = T.StructType([T.StructField(name, T.StringType()) for name in SILVER_COLUMNS])
    parsed = df.select(F.col(value_col).alias("raw"), F.from_json(value_col, schema).alias("r"))
    typed = {name: F.col(f"r.{name}") for name in SILVER_COLUMNS}
    for name, kind in numbers.items():
        text = F.coalesce(typed[name], F.lit("0"))
        typed[name] = F.coalesce(text.try_cast(kind), text.try_cast("decimal(38,9)").try_cast(kind))
    typed["ts"] = event_timestamp(F.col("r.timestamp"))
    rows = evaluated(parsed.select("raw", *[column.alias(name) for name, column in typed.items()]))
    readable = F.lit(True)
    for name in ("ts", "src_ip", *numbers):
        readable = readable & F.col(name).isNotNull()
    return rows.filter(readable).drop("raw"), rows.filter(~readable).select("raw")
