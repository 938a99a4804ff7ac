"""Strict validation of JSON rows into typed records, or quarantine with the first reason.

A row's text is parsed to a variant, which refuses duplicate keys and NaN and
keeps the type of every value, so ``1`` and ``"1"`` and ``1.0`` stay apart.  All
checks of an entity are one ``coalesce`` of (code, field, detail); the first that
fails wins.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions.identity import canonical_json
from ..functions.money import parse_money
from ..functions.times import has_offset, parse_date, parse_instant
from ..schemas import CURRENCY, ENTITIES, Entity, Field, MANIFEST, MANIFEST_SCHEMA_VERSION, record_type

_FAIL = "struct<code: string, field: string, detail: string>"


def fail(code: str, field: str | Column, detail: str | Column) -> Column:
    as_col = lambda x: x if isinstance(x, Column) else F.lit(x)
    return F.struct(F.lit(code).alias("code"), as_col(field).alias("field"), as_col(detail).alias("detail"))


def _kind(v: Column, name: str) -> Column:
    """Type of a field's value; null where the key is absent."""
    return F.schema_of_variant(F.try_variant_get(v, f"$.{name}", "variant"))


def _text(v: Column, name: str) -> Column:
    return F.when(_kind(v, name) == "STRING", F.try_variant_get(v, f"$.{name}", "string"))


class _Fields:
    """A payload's fields as columns beside it: of each the value, its kind (VOID where it is null or absent) and its text, null for other kinds."""

    def __init__(self, e: Entity):
        self.names = [f.name for f in e.fields]

    def __getitem__(self, name: str) -> dict[str, Column]:
        return {c: F.col(f"_{c}_{name}") for c in ("value", "kind", "text")}

    def beside(self, rows: DataFrame) -> DataFrame:
        """Rows with a parsed text ``_v`` and its fields; each step reads columns of the one before, so nothing is worked out twice."""
        df = rows.withColumn("_fields", F.try_variant_get("_v", "$", "map<string, variant>"))
        df = df.withColumns({"_keys": F.map_keys("_fields")} | {
            f"_value_{n}": F.try_element_at("_fields", F.lit(n)) for n in self.names
        })
        kind = lambda n: F.coalesce(F.schema_of_variant(f"_value_{n}"), F.lit("VOID"))
        df = df.withColumns({f"_kind_{n}": kind(n) for n in self.names})
        text = lambda n: F.when(F.col(f"_kind_{n}") == "STRING", F.col(f"_value_{n}").try_cast("string"))
        return df.withColumns({f"_text_{n}": text(n) for n in self.names})


def check(fields: _Fields, f: Field) -> Column:
    """(code, field, detail) of the first fault of a field, or null."""
    x, none = fields[f.name], F.lit(None).cast(_FAIL)
    text, kind = x["text"], x["kind"]
    if f.kind == "int":
        n = x["value"].try_cast("bigint")
        return F.when(
            kind != "BIGINT", fail("INVALID_TYPE", f.name, "must be an integer")
        ).when(n <= 0, fail("INVALID_VALUE", f.name, "must be positive")).otherwise(none)
    if f.kind in ("count", "version"):
        n, least = x["value"].try_cast("bigint"), 0 if f.kind == "count" else 1
        out = F.when(
            kind != "BIGINT", fail("INVALID_TYPE", f.name, "must be an integer")
        ).when(n < least, fail("INVALID_VALUE", f.name, f"must be {least} or more"))
        if f.kind == "version":
            out = out.when(
                n != MANIFEST_SCHEMA_VERSION,
                fail("UNSUPPORTED_SCHEMA_VERSION", f.name, f"must be {MANIFEST_SCHEMA_VERSION}")
            )
        return out.otherwise(none)
    if f.kind in ("money", "money0", "signed"):
        amount = parse_money(text, f.kind == "signed")
        bad = (kind != "STRING") | amount.isNull()
        out = F.when(bad, fail("INVALID_AMOUNT", f.name, "must be a decimal string with two places"))
        if f.kind == "money":
            out = out.when(amount <= 0, fail("INVALID_AMOUNT", f.name, "must be greater than zero"))
        if f.kind == "signed":
            capture = fields["movement_type"]["text"] == "CAPTURE"
            out = out.when(
                (capture & (amount <= 0)) | (~capture & (amount >= 0)),
                fail("INVALID_MONEY_SIGN", f.name, "has the wrong sign for its movement")
            )
        return out.otherwise(none)
    out = F.when(kind != "STRING", fail("INVALID_TYPE", f.name, "must be a string"))
    out = out.when(
        (text == "") | F.rlike(text, F.lit(r"\A\s|\s\z")),
        fail("INVALID_VALUE", f.name, "must be text without outer white space")
    )
    if f.kind == "enum":
        out = out.when(~text.isin(*f.values), fail("INVALID_VALUE", f.name, "is not a known value"))
    elif f.kind == "sha256":
        out = out.when(
            ~F.rlike(text, F.lit(r"\A[0-9a-f]{64}\z")),
            fail("INVALID_VALUE", f.name, "must be 64 lower-case hex digits")
        )
    elif f.kind == "currency":
        out = out.when(text != CURRENCY, fail("UNSUPPORTED_CURRENCY", f.name, f"must be {CURRENCY}"))
    elif f.kind == "ts":
        out = out.when(~has_offset(text), fail("INVALID_VALUE", f.name, "must have an explicit offset"))
        out = out.when(parse_instant(text).isNull(), fail("INVALID_VALUE", f.name, "must be an ISO-8601 instant"))
    elif f.kind == "date":
        out = out.when(parse_date(text).isNull(), fail("INVALID_VALUE", f.name, "must be a YYYY-MM-DD date"))
    return out.otherwise(none)


def first_fault(e: Entity) -> Column:
    """The first fault of a payload whose fields stand beside it: keys, then the entity's leading fields, then the others in order."""
    fields, keys = _Fields(e), F.col("_keys")
    names = [f.name for f in e.fields if not (e.dated and f.name == "available_on")]
    known = F.array(*[F.lit(f.name) for f in e.fields])
    # Names are listed for faulty rows alone; sort_array is compiled, and array_sort would keep the whole step from it.
    missing = F.sort_array(F.array_except(F.array(*[F.lit(n) for n in names]), keys))
    extra = F.sort_array(F.array_except(keys, known))
    there = {f.name: fields[f.name]["value"].isNotNull() for f in e.fields}
    n_known = reduce(lambda a, b: a + b, [x.cast("int") for x in there.values()])
    checks = [
        F.when(
            ~reduce(lambda a, b: a & b, [there[n] for n in names]),
            fail("MISSING_FIELD", missing[0], F.concat(F.lit("missing: "), F.array_join(missing, ", ")))
        ),
        F.when(
            F.size(keys) > n_known,
            fail("UNEXPECTED_FIELD", extra[0], F.concat(F.lit("unexpected: "), F.array_join(extra, ", ")))
        ),
    ]
    by_name = {f.name: f for f in e.fields}
    for name in e.first:
        if e.dated and name == "available_on":
            dated = fields["status"]["text"] == e.dated
            checks += [
                F.when(dated & ~there[name], fail("MISSING_FIELD", name, f"is required with status {e.dated}")),
                F.when(~dated & there[name], fail("INVALID_VALUE", name, f"needs status {e.dated}")),
                F.when(dated, check(fields, by_name[name]))
            ]
        else:
            checks.append(check(fields, by_name[name]))
    checks += [check(fields, f) for f in e.fields if f.name not in e.first]
    return F.when(
        F.col("_fields").isNull(), fail("INVALID_TYPE", F.lit(None).cast("string"), "must be an object")
    ).otherwise(F.coalesce(*checks))


def _value(v: Column, f: Field) -> Column:
    text = _text(v, f.name)
    if f.kind in ("int", "count", "version"):
        return F.try_variant_get(v, f"$.{f.name}", "int" if f.name == "attempt_number" else "bigint")
    if f.kind in ("money", "money0", "signed"):
        return parse_money(text, f.kind == "signed")
    return {"ts": parse_instant, "date": parse_date}.get(f.kind, lambda x: x)(text)


def payload_hash(record: Column, entity: str) -> Column:
    """SHA-256 of a record's canonical JSON with its system and entity."""
    e = ENTITIES[entity]
    cols = {f.name: (record[f.name], f.dataType) for f in record_type(entity).fields}
    cols |= {"_source_system": (F.lit(e.system), StringType()), "_entity_type": (F.lit(entity), StringType())}
    return F.sha2(canonical_json(cols), 256)


def validate(rows: DataFrame, entity: str, payload_col: str = "payload") -> tuple[DataFrame, DataFrame]:
    """Split rows of JSON text into (valid, quarantine).

    ``valid`` has the other columns, ``source_system, entity_type, source_id,
    source_version, payload_hash`` and the typed ``record``; ``quarantine`` has
    them and ``entity_type, source_id`` (only if it is text), ``reason_code,
    reason_detail, raw_payload_json`` (canonical).  Every row is in one of them.
    Text that is no strict JSON is quarantined with ``INVALID_JSON``.
    """
    return split(_parsed(rows, _entity(entity), payload_col), entity, payload_col)


def judged(rows: DataFrame, entity: str, payload_col: str = "payload") -> DataFrame:
    """Rows of JSON text with what it says (``_v``) and its first fault (``_fault``, null for none); the costly half of ``validate``."""
    return _parsed(rows, _entity(entity), payload_col)


def _entity(name: str) -> Entity:
    if name not in ENTITIES:
        raise ValueError(f"UNSUPPORTED_ENTITY_TYPE: {name}")
    return ENTITIES[name]


def _parsed(rows: DataFrame, e: Entity, payload_col: str) -> DataFrame:
    """Rows with their parsed text (``_v``, null where it is no strict JSON) and first fault (``_fault``).

    Both come out of an ``explode`` of one element: a filter on a column of a projection is moved below it
    together with the whole expression, one on what an ``explode`` yields is not.  So a text is parsed once a
    row, and its checks are made once.  They are made on columns, not inside a function of an array's elements,
    which Spark does not compile.
    """
    fault = F.when(
        F.col("_v").isNull(), fail("INVALID_JSON", F.lit(None).cast("string"), "is not strict JSON")
    ).otherwise(first_fault(e))
    read = _Fields(e).beside(rows.withColumn("_v", F.try_parse_json(payload_col)))
    one = F.explode(F.array(F.struct("_v", fault.alias("_fault")))).alias("_judged")
    return read.select(*rows.columns, one).select(*rows.columns, "_judged._v", "_judged._fault")


def split(rows: DataFrame, entity: str, payload_col: str = "payload") -> tuple[DataFrame, DataFrame]:
    """``validate``'s two frames from checked rows."""
    e, rest = ENTITIES[entity], [c for c in rows.columns if c not in (payload_col, "_fault", "_v")]
    read, v = rows if "_v" in rows.columns else rows.withColumn("_v", F.try_parse_json(payload_col)), F.col("_v")
    good = read.where("_fault IS NULL").select(
        *rest, F.lit(e.system).alias("source_system"), F.lit(entity).alias("entity_type"),
        F.struct(*[_value(v, f).alias(f.name) for f in e.fields]).alias("record")
    )
    good = good.select(
        *rest, "source_system", "entity_type", F.col(f"record.{e.id_field}").alias("source_id"),
        F.col("record.source_version").alias("source_version"),
        payload_hash(F.col("record"), entity).alias("payload_hash"), "record"
    )
    where = F.when(F.col("_fault.field").isNotNull(), F.concat(F.col("_fault.field"), F.lit(": "))).otherwise("")
    bad = read.where("_fault IS NOT NULL").select(
        *rest, F.lit(entity).alias("entity_type"), _text(v, e.id_field).alias("source_id"),
        F.col("_fault.code").alias("reason_code"), F.concat(where, F.col("_fault.detail")).alias("reason_detail"),
        F.coalesce(F.to_json(v), F.col(payload_col)).alias("raw_payload_json")
    )
    return good, bad


def verdicts(rows: DataFrame, entity: str, payload_col: str = "payload") -> DataFrame:
    """What ``validate`` says of each row, in one pass: ``source_id`` (only if it is text) and ``reason_code``, null for valid rows."""
    read = _parsed(rows, _entity(entity), payload_col)
    rest = [c for c in rows.columns if c != payload_col]
    return read.select(
        *rest, _text(F.col("_v"), ENTITIES[entity].id_field).alias("source_id"), F.col("_fault.code").alias("reason_code")
    )


def parse_manifests(rows: DataFrame, payload_col: str = "payload") -> tuple[DataFrame, DataFrame]:
    """Split JSON texts of manifests in their contract form into (valid, faulty).

    ``valid`` has the other columns and the typed ``manifest``; ``faulty`` has them,
    ``reason_code`` and ``reason_detail`` of the first fault.
    """
    rest = [c for c in rows.columns if c != payload_col]
    read, v = _parsed(rows, MANIFEST, payload_col), F.col("_v")
    good = read.where("_fault IS NULL").select(
        *rest, F.struct(*[_value(v, f).alias(f.name) for f in MANIFEST.fields]).alias("manifest")
    )
    where = F.when(F.col("_fault.field").isNotNull(), F.concat(F.col("_fault.field"), F.lit(": "))).otherwise("")
    bad = read.where("_fault IS NOT NULL").select(
        *rest, F.col("_fault.code").alias("reason_code"), F.concat(where, F.col("_fault.detail")).alias("reason_detail")
    )
    return good, bad
