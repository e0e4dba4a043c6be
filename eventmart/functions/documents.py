"""Search documents: the fixed event document and schema-driven dynamic fields."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmart.functions.instants import utc_seconds_text
from eventmart.functions.wide_rows import joined_key

# Dynamic-field suffix per type; other types are left out.
SUFFIXES = {
    T.StringType: "_s", T.LongType: "_l", T.IntegerType: "_i", T.DoubleType: "_d", T.FloatType: "_f",
    T.BooleanType: "_b", T.TimestampType: "_tdt", T.TimestampNTZType: "_tdt", T.DateType: "_tdt",
}
TEXT_SUFFIX = "_t"


def event_documents(events, carry=()):
    """One search document per event, with id `type:event_id`."""
    return events.select(
        joined_key("event_type", "event_id").alias("id"),
        "account_id", "app_id",
        utc_seconds_text("event_timestamp").alias("event_time_stamp"),
        "event_id", "event_type", "purchase", "payment_type", "session_id", "latitude", "longitude",
        *carry,
    )


def dynamic_fields(df, id_column, overrides=None):
    """Columns renamed by type suffix; a string with a space goes to `_t`, any other to `_s`.

    An override replaces the suffix of its column and is taken as given. Arrays are left out even
    with an override. Nulls stay null here and disappear in `as_json`.
    """
    overrides = overrides or {}
    fields = [F.col(id_column).cast("string").alias("id")]
    for field in df.schema:
        column, name = F.col(field.name), field.name
        if isinstance(field.dataType, T.ArrayType):
            continue
        suffix = overrides.get(name) or SUFFIXES.get(type(field.dataType))
        if suffix is None:
            continue
        if name not in overrides and suffix == "_s":
            spaced = F.instr(column, " ") > 0
            fields.append(F.when(~spaced, column).alias(name + suffix))
            fields.append(F.when(spaced, column).alias(name + TEXT_SUFFIX))
        else:
            fields.append(column.alias(name + suffix))
    return df.select(*fields)


def variant_documents(df, id_column, overrides=None, alias="document"):
    """(id, document): each row as one VARIANT object of the fields it has.

    Suffixes are those of `dynamic_fields`. The entries of a map with string keys and the fields of a struct are fields of
    their own, with the suffix of their values; arrays and values of other types are left out, and so is what is null.
    Fields of equal names are one: the later column's.
    """
    overrides, entries = overrides or {}, []
    for name, column, kind in _leaves(df):
        suffix = overrides.get(name) or SUFFIXES.get(type(kind.valueType if isinstance(kind, T.MapType) else kind))
        if suffix is None or isinstance(kind, T.ArrayType) or isinstance(kind, T.MapType) and not isinstance(kind.keyType, T.StringType):
            continue
        free = name not in overrides and suffix == "_s"
        if isinstance(kind, T.MapType):
            entries.append(F.coalesce(F.transform(F.map_entries(column), _entry_namer(suffix, free)), F.array().cast(ENTRIES)))
        else:
            entries.append(F.array(_entry(F.lit(name), column, suffix, free)))
    given = F.filter(F.concat(F.array().cast(ENTRIES), *entries), lambda e: e["value"].isNotNull())
    rows = df.select(F.col(id_column).cast("string").alias("id"), given.alias("given"))
    last = F.filter("given", lambda e, i: ~F.exists(F.slice("given", i + 2, F.size("given")), lambda later: later["key"] == e["key"]))
    return rows.select("id", F.to_variant_object(F.map_from_entries(last)).alias(alias))


ENTRIES = "array<struct<key:string,value:variant>>"


def _entry(name, value, suffix, free):
    end = _text_suffix(value) if free else F.lit(suffix)
    return F.struct(F.concat(name, end).alias("key"), value.cast("variant").alias("value"))


def _entry_namer(suffix, free):
    return lambda e: _entry(e["key"], e["value"], suffix, free)


def _text_suffix(column):
    return F.when(F.instr(column, " ") > 0, F.lit(TEXT_SUFFIX)).otherwise(F.lit("_s"))


def _leaves(df):
    """(name, column, type) of every column, those of structs one by one."""
    def leaves(name, column, kind):
        if isinstance(kind, T.StructType):
            for field in kind:
                yield from leaves(field.name, column[field.name], field.dataType)
        else:
            yield name, column, kind
    for field in df.schema:
        yield from leaves(field.name, F.col(f"`{field.name}`"), field.dataType)


def field_names(document="document"):
    """The names of a VARIANT document's fields, sorted."""
    return F.array_sort(F.map_keys(F.col(document).cast("map<string,variant>")))


def as_xml(df, row_tag, alias="xml"):
    """Each row as one XML element with a child for every field that is not null."""
    return df.select(F.to_xml(F.struct("*"), {"rowTag": row_tag}).alias(alias))


def from_xml(df, schema, row_tag, column="xml"):
    """Rows of such elements; a missing child is null, an element that does not fit the schema an error."""
    parsed = F.from_xml(column, schema, {"rowTag": row_tag, "mode": "FAILFAST", "ignoreSurroundingSpaces": "false"})
    return df.select(parsed.alias("row")).select("row.*")


def as_json(df, alias="json"):
    """Each row as one JSON object without its null fields."""
    return df.select(F.to_json(F.struct("*")).alias(alias))


def ordered(documents, *columns):
    """Documents sorted by fields, those without a value last."""
    return documents.orderBy(*[F.col(c).asc_nulls_last() for c in columns])
