"""JSON payloads of the log API."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from brontide.functions import exact_json
from brontide.operators.project import column

# Fixed values ------------------------------------------------------------------------------
# Keys under which an object may hold its text, in the order in which they are tried.
TEXT_KEYS = ("content", "message", "log", "logs", "data", "text", "body")
# Keys under which an object may hold its list of task instances, in order.
TASK_LIST_KEYS = ("task_instances", "taskInstances", "tasks", "items", "results")
# Keys under which an object may hold the address of an external log, in order.
URL_KEYS = ("url", "external_log_url", "externalLogUrl", "log_url", "logUrl")
JSON_CONTENT_TYPE = "application/json"
# -------------------------------------------------------------------------------------------


# The JVM's parser stops behind the first value and says nothing of what follows. So a payload is read as the first
# element of a list that must end in this mark.
_MARK = "~end of payload~"
_VALUE = (f"get(transform(array(try_parse_json(concat('[', {{p}}, ',\"{_MARK}\"]'))), w -> CASE WHEN try_variant_get(w, '$[1]', 'string') = '{_MARK}' "
          f"AND try_variant_get(w, '$[2]', 'variant') IS NULL AND NOT contains({{p}}, '{_MARK}') THEN try_variant_get(w, '$[0]', 'variant') END), 0)")
# What that parser refuses although it looks like JSON: for its size, its depth, a repeated key, or because it is none.
_REFUSED = "(j IS NULL AND (left(ltrim(' \\t\\r\\n', {p}), 1) IN ('[', '{{', '\"') OR {p} RLIKE '^[ \\\\t\\\\r\\\\n]*-?[0-9][-+.0-9eE]*[ \\\\t\\\\r\\\\n]*$'))"
# What it reads in a way of its own: numbers with an exponent or more digits than a decimal has, and halves of surrogates.
_ODD = "{p} RLIKE '(^|[\\\\[:,\\\\s])-?[0-9]+([.][0-9]+)?[eE]|(^|[\\\\[:,\\\\s])-?[0-9.]{{30}}|\\\\\\\\u[dD][89a-fA-F]'"


def _let(value: str, name: str, body: str) -> str:
    """SQL of ``body`` with ``name`` for a value that is computed once, however often it is used."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def _parsed(payload: str, regular: str, odd: bool = True) -> Column:
    """A struct of one parse: ``regular``, SQL of the value ``j``, and ``ask``, the payload if it needs the exact reading. To be
    a column of its own, so that it is computed once."""
    ask = _REFUSED + (f" OR (j IS NOT NULL AND {_ODD})" if odd else "")
    return F.expr(_let(_VALUE.format(p=payload), "j",
                       f"named_struct('ask', CASE WHEN {ask.format(p=payload)} THEN {payload} END, 'regular', {regular})"))


def _read(payload: pd.Series, of_value) -> pd.Series:
    """``of_value`` of each payload's JSON value; None where there is none."""
    def one(text):
        try:
            return None if text is None else of_value(exact_json.loads(text))
        except ValueError:
            return None
    return pd.Series([one(text) for text in payload], dtype=object)


@F.pandas_udf(T.StringType())
def _exact_canonical(payload: pd.Series) -> pd.Series:
    return _read(payload, exact_json.dumps)


def with_canonical_json(df: DataFrame, payload: str, only: Column | None = None) -> DataFrame:
    """A column of payloads as compact JSON with sorted keys; NULL becomes ``{}``, text that is not JSON a JSON string.

    Equal values have equal texts, whichever reader took them: see ``exact_json.dumps``. With ``only`` the other rows
    are not read and become NULL.
    """
    use = F.lit(True) if only is None else F.coalesce(only, F.lit(False))
    named = df.withColumns({"_given": F.when(use, column(payload)), "_use": use})
    read = named.withColumn("_read", _parsed("_given", "to_json(j)"))
    # By way of a list, as a cast to variant has a limit of size.
    listed = F.to_json(F.array("_given"))
    quoted = F.when(F.col("_given").isNotNull(), F.substring(listed, F.lit(2), F.length(listed) - 2))
    canonical = F.coalesce(_exact_canonical("_read.ask"), "_read.regular", quoted, F.lit("{}"))
    return read.withColumn(payload, F.when(F.col("_use"), canonical)).drop("_given", "_use", "_read")


def _plain_text(value: str) -> str:
    """Text of a string, '' of JSON null or nothing, NULL for whatever needs a closer look."""
    return _let(f"schema_of_variant({value})", "kind",
                f"CASE WHEN kind IS NULL OR kind = 'VOID' THEN '' "
                f"WHEN kind = 'STRING' THEN try_variant_get({value}, '$', 'string') END")


def _object_text(value: str, keys: tuple[str, ...] = TEXT_KEYS) -> str:
    """Text of an object that has a plain one under its first telling key, else NULL."""
    if not keys:
        return "CAST(NULL AS STRING)"
    later = _object_text(value, keys[1:])
    this = _let(f"try_variant_get({value}, '$.{keys[0]}', 'variant')", "v", _plain_text("v"))
    return _let(this, "t", f"CASE WHEN t <> '' THEN t WHEN t = '' THEN {later} END")


def regular_text(payload: str) -> Column:
    """Text of a column of flat payloads, NULL for an irregular one: deeper nesting, bare numbers,
    objects without a telling key, and objects or lists that the JVM's parser refuses, as for a
    repeated key. See ``logs.extract_log_text``.

    Written as SQL text: built from Column calls, an expression of this size takes longer to
    put together than a small table to process. The column's name must be a plain one.
    """
    # Whatever is not a list is treated as a list of itself.
    elements = ("CASE WHEN startswith(schema_of_variant(j), 'ARRAY') "
                "THEN try_variant_get(j, '$', 'array<variant>') ELSE array(j) END")
    text = (f"CASE WHEN startswith(schema_of_variant(e), 'OBJECT') THEN {_object_text('e')} "
            f"ELSE {_plain_text('e')} END")
    joined = _let(f"transform({elements}, e -> {text})", "texts",
                  "CASE WHEN NOT exists(texts, x -> x IS NULL) "
                  "THEN array_join(filter(texts, x -> x <> ''), '\\n') END")
    parsed = (f"CASE WHEN j IS NOT NULL THEN {joined} WHEN left(ltrim(' \\t\\r\\n', {payload}), 1) "
              f"NOT IN ('[', '{{', '\"') THEN {payload} END")
    return F.expr(f"CASE WHEN {payload} IS NULL THEN '' "
                  f"ELSE {_let(_VALUE.format(p=payload), 'j', parsed)} END")


def _nested_text(value) -> str:
    """Text of any JSON value, by a walk with a stack of its own: children first."""
    texts: dict[int, str] = {}

    def text_of(item) -> str:
        if isinstance(item, str):
            return item
        if item is None:
            return ""
        return texts[id(item)] if isinstance(item, (list, dict)) else exact_json.dumps(item)

    def joined(items) -> str:
        return "\n".join(filter(None, map(text_of, items)))

    todo = [(value, False)]
    while todo:
        item, seen = todo.pop()
        if not isinstance(item, (list, dict)):
            continue
        if not seen:
            todo.append((item, True))
            todo += [(child, False) for child in (item.values() if isinstance(item, dict) else item)]
        elif isinstance(item, list):
            texts[id(item)] = joined(item)
        else:
            told = next(filter(None, (text_of(item[key]) for key in TEXT_KEYS if key in item)), "")
            texts[id(item)] = (told or joined(v for v in item.values() if isinstance(v, (str, list, dict)))
                               or exact_json.dumps(item))
    return text_of(value)


def _payload_text(payload: str) -> str:
    try:
        return _nested_text(exact_json.loads(payload))
    except ValueError:  # not JSON
        return payload


@F.pandas_udf(T.StringType())
def irregular_text(payload: pd.Series) -> pd.Series:
    """Text of any payload."""
    return payload.map(_payload_text, na_action="ignore")


def is_json(content_type: Column) -> Column:
    return F.coalesce(content_type.contains(JSON_CONTENT_TYPE), F.lit(False))


def _task_items(value) -> list[str]:
    if isinstance(value, dict):
        value = next((value[key] for key in TASK_LIST_KEYS if isinstance(value.get(key), list)), None)
    return [exact_json.dumps(item) for item in value if isinstance(item, dict)] if isinstance(value, list) else []


@F.pandas_udf(T.ArrayType(T.StringType()))
def _exact_items(payload: pd.Series) -> pd.Series:
    return _read(payload, _task_items)


def with_task_instances(df: DataFrame, payload: str, name: str) -> DataFrame:
    """Add the array of the task-instance objects in a column of payloads, as JSON.

    The payload is the list itself or an object with the list under one of ``TASK_LIST_KEYS``;
    a key that holds something else is passed over.
    """
    # Only a real list: a cast could also turn a string of JSON into one.
    lists = [_let(f"try_variant_get(j, '{path}', 'variant')", "v",
                  "CASE WHEN startswith(schema_of_variant(v), 'ARRAY') "
                  "THEN try_variant_get(v, '$', 'array<variant>') END")
             for path in ("$", *(f"$.{key}" for key in TASK_LIST_KEYS))]
    regular = (f"transform(filter(coalesce({', '.join(lists)}), item -> startswith(schema_of_variant(item), 'OBJECT')), "
               "item -> to_json(item))")
    read = df.withColumn("_read", _parsed(payload, regular))
    return read.withColumn(name, F.coalesce(_exact_items("_read.ask"), "_read.regular")).drop("_read")


def _url(value) -> str | None:
    if isinstance(value, str):
        return value if value.startswith("http") else None
    if isinstance(value, dict):
        return next((value[key] for key in URL_KEYS if isinstance(value.get(key), str) and value[key]), None)
    return None


@F.pandas_udf(T.StringType())
def _exact_url(payload: pd.Series) -> pd.Series:
    return _read(payload, _url)


def is_unreadable(payload: str) -> Column:
    """Whether a column's payload looks like JSON and is none: a list, object, string or number that does not end well."""
    refused = _parsed(payload, "1", odd=False)["ask"]
    return refused.isNotNull() & _exact_canonical(refused).isNull()


def external_log_url(payload: str) -> Column:
    """Address of an external log in a column of payloads, else NULL: the first non-empty string
    under one of ``URL_KEYS``, or the payload itself if it is a string that starts with http."""
    def string(value: str, condition: str) -> str:
        text = f"CASE WHEN schema_of_variant({value}) = 'STRING' THEN try_variant_get({value}, '$', 'string') END"
        return _let(text, "t", f"CASE WHEN {condition} THEN t END")

    under_keys = [_let(f"try_variant_get(j, '$.{key}', 'variant')", "v", string("v", "t <> ''"))
                  for key in URL_KEYS]
    itself = string("j", "startswith(t, 'http')")
    plain = f"CASE WHEN j IS NULL AND startswith({payload}, 'http') THEN {payload} END"
    read = _parsed(payload, f"coalesce({', '.join([*under_keys, itself, plain])})", odd=False)
    return F.coalesce(_exact_url(read["ask"]), read["regular"])
