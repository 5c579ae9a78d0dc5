"""Registered queries: the log corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from brontide.catalog.common import LINE_EXPR, Registry, event_lines, table, write_attempts
from brontide.functions import payload as P, text as X
from brontide.operators import chunking as C, logs as L
from brontide.plans import collect
from brontide.session import small_frame, work_dir
from brontide.sources import tables

registry = Registry()

# Line terminators and whitespace in the notation of DuckDB's expressions.
_LINES = r"""regexp_split_to_array({text}, '\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{{85}}\x{{2028}}\x{{2029}}]')"""
_SPACES = "||".join(f"chr({ord(c)})" for c in X.WHITESPACE)


def lines_sql(source: str, key: str, text: str) -> str:
    """Rows ``key, i, line`` of the lines of a text column."""
    return (f"select {key}, unnest(range(1, len(l) + 1)) as i, unnest(l) as line from (select {key}, "
            f"case when p[-1] = '' then p[:-2] else p end as l from (select {key}, "
            f"{_LINES.format(text=text)} as p from {source}))")


def chunks_sql(lines: str, key: str, max_lines: int, max_chars: int) -> str:
    """Chunks of rows ``key, i, line``, found by walking the lines one by one."""
    return f"""
    with recursive lines as materialized ({lines}),
    walk as (
      select {key}, i, i as head, cast(1 as bigint) as n, cast(length(line) as bigint) as joined
      from lines where i = 1
      union all
      select {key}, i, case when ends then i else head end, case when ends then 1 else n + 1 end,
             case when ends then size else joined + 1 + size end
      from (select w.{key}, x.i, w.head, w.n, w.joined, length(x.line) as size,
                   w.n >= {max_lines} or w.joined + 1 + length(x.line) >= {max_chars} as ends
            from walk w join lines x on x.{key} = w.{key} and x.i = w.i + 1)
    ),
    placed as (
      select w.{key}, w.head, w.i, x.line,
             coalesce(sum(length(x.line) + 1) over (partition by w.{key} order by w.i
                      rows between unbounded preceding and 1 preceding), 0) as before
      from walk w join lines x on x.{key} = w.{key} and x.i = w.i
    ),
    spans as (
      select {key}, head, max(i) as tail, min(before) as char_start,
             min(before) + sum(length(line) + 1) as char_end,
             trim(string_agg(line, chr(10) order by i), {_SPACES}) as message
      from placed group by {key}, head
    )
    select {key}, row_number() over (partition by {key} order by head) - 1 as chunk_index,
           cast(head as bigint) as line_start, cast(tail as bigint) as line_end,
           cast(char_start as bigint) as char_start, cast(char_end as bigint) as char_end, message
    from spans where message <> ''"""


_LEVEL_SQL = """case when contains(upper({m}), 'ERROR') then 'ERROR' when contains(upper({m}), 'WARN') then 'WARN'
    when contains(upper({m}), 'INFO') then 'INFO' when contains(upper({m}), 'DEBUG') then 'DEBUG' end"""
_ERROR_SQL = "(" + " or ".join(f"contains(upper({{m}}), '{t}')" for t in X.ERROR_TOKENS) + ")"
_EVENT_LINES = f"select event_id, {LINE_EXPR} as line from events"


# --- content --------------------------------------------------------------------------------

_CONTENT = {
    "raw_text": "case when doc_id % 3 = 0 then text when doc_id % 3 = 1 then null else '' end",
    "raw_content": "case when doc_id % 2 = 0 then source end",
}
_CONTENT_SQL = ", ".join(f"{e} as {c}" for c, e in _CONTENT.items())


@registry.add(f"""select doc_id, coalesce(raw_text, raw_content, '') as content
                  from (select doc_id, {_CONTENT_SQL} from documents)""")
def pick_content(spark, sf_dir):
    df = table(spark, sf_dir, "documents").withColumns(
        {c: F.expr(e) for c, e in _CONTENT.items()})
    return df.select("doc_id", X.pick_content(F.col("raw_text"), F.col("raw_content")).alias("content"))


@registry.add(f"""select d.doc_id, sha256(text) as content_hash, cast(strlen(text) as bigint) as content_size_bytes,
    cast(coalesce(n, 0) as int) as line_count from documents d
    left join (select doc_id, count(*) as n from ({lines_sql('documents', 'doc_id', 'text')}) group by 1) c
    on c.doc_id = d.doc_id""")
def fingerprint_text(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("content"))
    return L.fingerprint_text(docs).drop("content")


# Every seventh event has no JSON at all; the others have keys out of order, blanks, a key that repeats, an integer longer than
# any number type, numbers in all notations, a key beyond the 16-bit characters, half a surrogate, or a second value.
_LONG = "123456789012345678901234567890123456789012345"
_PROPS = f"""case when event_id % 7 = 0 then null
    when event_id % 7 = 1 then concat('{{"type": "first",  "props": ', props, ', "type": "', event_type, '"}}')
    when event_id % 7 = 2 then concat('{{"type": "', event_type, '",  "n": {_LONG}}}')
    when event_id % 7 = 3 then concat('{{"type": "', event_type, '",  "n": [1.0, -0.0, 0.10, ', event_id, '.50], "big": ', case event_id % 3
        when 0 then '1e-7, "huge": 1E400, "id": 1234567890123456' when 1 then '1234567890123456.0' else '[true, 1.5e3]' end, '}}')
    when event_id % 7 = 4 then concat('{{"\U0001f600": 1, "\uff5e": "', event_type, case when event_id % 2 = 0 then '", "a": "\\\\ud800"}}' else '", "a": "?"}}' end)
    when event_id % 7 = 5 then concat('{{"type": "', event_type, '"}} ', event_id)
    else concat('{{"type": "', event_type, '",  "props": ', props, '}}') end"""
_PROPS_SQL = f"""case when event_id % 7 = 0 then '{{}}' when event_id % 7 = 2 then concat('{{"n":{_LONG},"type":"', event_type, '"}}')
    when event_id % 7 = 3 then concat('{{"big":', case event_id % 3 when 0 then '0.0000001,"huge":1{'0' * 400},"id":1234567890123456'
        when 1 then '1234567890123456' else '[true,1500]' end, ',"n":[1,0,0.1,', event_id, '.5],"type":"', event_type, '"}}')
    when event_id % 7 = 4 then concat('{{"a":"?","\U0001f600":1,"\uff5e":"', event_type, '"}}')
    when event_id % 7 = 5 then concat('"{{\\"type\\": \\"', event_type, '\\"}} ', event_id, '"')
    else concat('{{"props":', cast(json(props) as varchar), ',"type":"', event_type, '"}}') end"""


@registry.add(f"""select event_id, raw_json, sha256(raw_json) as content_hash,
    cast(strlen(raw_json) as bigint) as content_size_bytes from (select event_id, {_PROPS_SQL} as raw_json from events)""")
def normalize_json_source(spark, sf_dir):
    df = table(spark, sf_dir, "events").select("event_id", F.expr(_PROPS).alias("raw_json"))
    return L.normalize_json_source(df)


@registry.add(f"""select event_id, content_type, raw_content, raw_json,
    sha256(coalesce(raw_content, raw_json)) as content_hash,
    cast(strlen(coalesce(raw_content, raw_json)) as bigint) as content_size_bytes,
    case when raw_content is not null then 1 end as line_count
    from (select event_id, case when event_type = 'view' then 'JSON' else 'TEXT' end as content_type,
                 case when event_type <> 'view' then {LINE_EXPR} end as raw_content,
                 case when event_type = 'view' then {_PROPS_SQL} end as raw_json from events)""")
def route_sources(spark, sf_dir):
    df = event_lines(spark, sf_dir).select(
        "event_id", F.when(F.col("event_type") == "error", F.col("line")).alias("raw_text"),
        F.when(~F.col("event_type").isin("error", "view"), F.col("line")).alias("raw_content"),
        F.expr(_PROPS).alias("raw_json"))
    return L.route_sources(df)


@registry.add("""select event_id, event_type from events where event_type not in ('click', 'view', 'signup')""")
def invalid_categories(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "event_type")
    return L.invalid_categories(events, "event_type", ["click", "view", "signup"])


@registry.add("""select event_id, greatest(1, cast(user_id % 4 as int) - 1) as try_number,
    cast(event_id % 3 as int) - 1 as map_index, event_id % 3 >= 1 as is_mapped from events""")
def normalize_attempt(spark, sf_dir):
    df = table(spark, sf_dir, "events").selectExpr(
        "event_id", "user_id % 4 - 1 as try_number", "cast(event_id % 3 - 1 as string) as map_index")
    return L.normalize_attempt(df)


# --- payloads -------------------------------------------------------------------------------


# One payload shape after the other over the events.
_SHAPES = [
    ("'plain ' || props", "'plain ' || props"),
    ("'{\"content\": \"' || event_type || '\", \"log\": \"no\"}'", "event_type"),
    ("'{\"data\": {\"text\": \"' || event_type || '\"}}'", "event_type"),
    ("'[{\"message\": \"' || event_type || '\"}, {\"message\": \"\"}, \"' || user_id || '\"]'",
     "event_type || chr(10) || '{\"message\":\"\"}' || chr(10) || user_id"),
    ("'{\"content\": \"\", \"log\": null, \"body\": \"' || user_id || '\"}'", "cast(user_id as varchar)"),
    ("'{\"x\": \"' || event_type || '\", \"n\": 1, \"y\": [\"' || user_id || '\"]}'",
     "event_type || chr(10) || user_id"),
    ("'{\"n\": ' || user_id || ', \"a\": true}'", "'{\"a\":true,\"n\":' || user_id || '}'"),
    ("'\"' || event_type || '\"'", "event_type"),
    ("cast(user_id as string)", "cast(user_id as varchar)"),
    ("cast(null as string)", "''"),
    ("'[[\"' || event_type || '\"], {\"logs\": [\"a\", \"b\"]}]'", "event_type || chr(10) || 'a' || chr(10) || 'b'"),
    ("'{\"content\": \"no\", \"content\": \"' || event_type || '\"}'", "event_type"),
    (f"'{{\"n\": {_LONG}, \"a\": ' || user_id || '}}'", f"'{{\"a\":' || user_id || ',\"n\":{_LONG}}}'"),
    ("'{\"n\": 1e-7, \"a\": ' || user_id || '.0}'", "'{\"a\":' || user_id || ',\"n\":0.0000001}'"),
    ("user_id || ' workers of {}'", "user_id || ' workers of {}'"),
    ("'{\"content\": \"no\", \"content\": \"' || event_type || '\\\\udfff\"}'", "event_type || '?'"),
    ("'{\"content\": \"' || event_type || '\"}' || chr(10) || '{\"content\": \"b\"}'", "'{\"content\": \"' || event_type || '\"}' || chr(10) || '{\"content\": \"b\"}'"),
]


def _shaped(part: int) -> str:
    cases = " ".join(f"when {i} then {shape[part]}" for i, shape in enumerate(_SHAPES))
    return f"case event_id % {len(_SHAPES)} {cases} end"


# The one dialect reads a backslash as it is, the other an escape.
_BODIES_SQL = _shaped(0).replace(r"\\", "\\")


@registry.add(f"select event_id, {_shaped(1)} as text from events")
def extract_log_text(spark, sf_dir):
    df = table(spark, sf_dir, "events").select("event_id", F.expr(_shaped(0)).alias("payload"))
    return L.extract_log_text(df)


@registry.add(f"""select event_id, case when event_type in ('click', 'view') then {_shaped(1)}
    else coalesce({_BODIES_SQL}, '') end as text from events""")
def decode_payload(spark, sf_dir):
    content_type = F.expr("""case event_type when 'click' then 'application/json'
        when 'view' then 'application/json; charset=utf-8' when 'error' then 'text/plain'
        when 'signup' then 'application/x-ndjson' end""")
    df = table(spark, sf_dir, "events").select(
        "event_id", content_type.alias("content_type"), F.expr(_shaped(0)).alias("body"))
    return L.decode_payload(df)


def _item(one: str, name: str) -> str:
    return (f"'{{\"id\":' || case when event_id % 7 = 6 then '{_LONG}' else '{one}' end || "
            f"',\"task_id\":\"{name}' || event_type || '\",\"try_number\":' || user_id || '}}'")


# As it comes, and in its canonical form.
_GIVEN = _item("1.0", "\\\\ud800")
_ITEM = _item("1", "?")


@registry.add(f"""select event_id, cast(i as int) as item_no, {_ITEM} as task_instance
    from events, lateral (select unnest(case event_id % 7 when 0 then [0, 1] when 1 then [0]
        when 2 then [0] when 3 then [] when 4 then [0, 1, 2] else [0, 1] end) as i)""")
def explode_task_instances(spark, sf_dir):
    payload = f"""case event_id % 7
        when 5 then '{{"tasks": [' || {_GIVEN} || '], "tasks": [' || {_GIVEN} || ',' || {_GIVEN} || ']}}'
        when 6 then '{{"tasks": [' || {_GIVEN} || ', 3, ' || {_GIVEN} || ']}}'
        when 0 then '[' || {_GIVEN} || ', 7, "x", ' || {_GIVEN} || ']'
        when 1 then '{{"task_instances": 3, "tasks": [' || {_GIVEN} || ']}}'
        when 2 then '{{"results": [[1], ' || {_GIVEN} || ', null], "total": 1}}'
        when 3 then '{{"items": "[{{}}]"}}'
        else '{{"taskInstances": [' || {_GIVEN} || ',' || {_GIVEN} || ',' || {_GIVEN} || '], "items": [{{}}]}}' end"""
    df = table(spark, sf_dir, "events").select("event_id", F.expr(payload).alias("payload"))
    return L.explode_task_instances(df)


@registry.add("""select page_id, case page_id % 6 when 2 then null when 4 then null else url end as log_url from pages""")
def external_log_url(spark, sf_dir):
    payload = """case page_id % 6 when 5 then concat('{"url": "old", "url": "', url, '"}') when 0 then concat('{"url": "", "logUrl": "', url, '"}')
        when 1 then url when 2 then concat('{"link": "', url, '"}') when 3 then concat('"', url, '"')
        else concat('["', url, '"]') end"""
    df = table(spark, sf_dir, "pages").select("page_id", F.expr(payload).alias("payload"))
    return df.select("page_id", P.external_log_url("payload").alias("log_url"))


@registry.add("select page_id from pages where page_id % 3 = 0")
def unreadable_payloads(spark, sf_dir):
    payload = """case page_id % 3 when 0 then concat('{"url": "', url) when 1 then concat('{"url": "', url, '", "url": ""}') else url end"""
    df = table(spark, sf_dir, "pages").select("page_id", F.expr(payload).alias("payload"))
    return L.unreadable_payloads(df).select("page_id")


# --- lines and chunks -----------------------------------------------------------------------

@registry.add(f"""select doc_id, cast(i as bigint) as line_no, line
                  from ({lines_sql('documents', 'doc_id', 'text')})""")
def split_lines(spark, sf_dir):
    return C.split_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))


@registry.add(chunks_sql(lines_sql("documents", "doc_id", "text"), "doc_id", 80, 8000))
def chunk_text(spark, sf_dir):
    return C.chunk_text(table(spark, sf_dir, "documents").select("doc_id", "text"))


@registry.add(chunks_sql(lines_sql("documents", "doc_id", "text"), "doc_id", 5, 800))
def chunk_text_small(spark, sf_dir):
    return C.chunk_text(table(spark, sf_dir, "documents").select("doc_id", "text"), "text", 5, 800)


# All events of a type form one log, so a log is a large part of the table.
_LOG_PER_TYPE = f"""select event_type, row_number() over (partition by event_type order by ts, event_id) as i,
    {LINE_EXPR} as line from events"""


def _lines_per_type(spark, sf_dir) -> DataFrame:
    lines = event_lines(spark, sf_dir).select("event_type", "ts", "event_id", "line")
    return C.number_lines(lines, ["event_type"], ["ts", "event_id"])


@registry.add(f"select event_type, i as line_no, line from ({_LOG_PER_TYPE})")
def number_lines(spark, sf_dir):
    return _lines_per_type(spark, sf_dir).select("event_type", "line_no", "line")


# A walk by recursion over a log this long takes DuckDB minutes at larger scale; lines of bounded
# length allow to state the chunks directly: with these limits only the number of lines counts.
@registry.add(f"""
    with placed as (
      select event_type, i, line, (i - 1) // 80 as chunk_index,
             coalesce(sum(length(line) + 1) over (partition by event_type order by i
                      rows between unbounded preceding and 1 preceding), 0) as before
      from ({_LOG_PER_TYPE}))
    select event_type, chunk_index, min(i) as line_start, max(i) as line_end,
           cast(min(before) as bigint) as char_start,
           cast(min(before) + sum(length(line) + 1) as bigint) as char_end,
           string_agg(line, chr(10) order by i) as message
    from placed group by event_type, chunk_index""")
def chunk_lines(spark, sf_dir):
    lines = _lines_per_type(spark, sf_dir).select("event_type", "line_no", "line")
    return C.chunk_lines(lines, ["event_type"])


# Here the length decides; documents are short enough to walk.
@registry.add(chunks_sql(lines_sql("documents", "doc_id", "text"), "doc_id", 20, 600))
def chunk_lines_by_length(spark, sf_dir):
    lines = C.split_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return C.chunk_lines(lines, ["doc_id"], 20, 600, block_lines=32, fan_out=4)


@registry.add(f"select event_id, {_LEVEL_SQL.format(m='line')} as level from ({_EVENT_LINES})")
def guess_level(spark, sf_dir):
    return event_lines(spark, sf_dir).select("event_id", X.guess_level(F.col("line")).alias("level"))


@registry.add(f"select event_id, {_ERROR_SQL.format(m='line')} as is_error from ({_EVENT_LINES})")
def is_error(spark, sf_dir):
    return event_lines(spark, sf_dir).select("event_id", X.is_error(F.col("line")).alias("is_error"))


@registry.add(f"""select event_id, line as message, sha256(line) as message_hash, {_LEVEL_SQL.format(m='line')} as level,
    {_ERROR_SQL.format(m='line')} as is_error,
    case when {_ERROR_SQL.format(m='line')} then 'possible_error_chunk' end as error_hint from ({_EVENT_LINES})""")
def annotate_chunks(spark, sf_dir):
    return L.annotate_chunks(event_lines(spark, sf_dir).select("event_id", F.col("line").alias("message")))


# --- upserts --------------------------------------------------------------------------------

# The first half of the month is the table, the second half the batch applied to it.
_CUT = "2024-01-16"
_SOURCE_COLUMNS = {
    "pipeline_run_id": "user_id % 50",
    "pipeline_task_run_id": "nullif(event_id % 3, 2)",
    "source_type": "'AIRFLOW_LOG'",
    "source_uri": "case when event_id % 4 > 0 then event_type end",
    "dag_id": "event_type",
    "dag_run_id": "cast(user_id as varchar(20))",
    "task_id": "case event_id % 5 when 0 then null when 1 then '' else 't' end",
    "try_number": "cast(nullif(event_id % 2, 1) as int)",
    "map_index": "cast(case event_id % 7 when 0 then null when 1 then -1 else 2 end as int)",
    "resource_type": "case when event_id % 3 > 0 then 'SPARK' end",
    "resource_id": "case event_id % 11 when 0 then '' when 1 then 'r' end",
}
_SOURCE_KEYS = """pipeline_run_id, coalesce(pipeline_task_run_id, 0), source_type, coalesce(task_id, ''),
    coalesce(try_number, 0), coalesce(map_index, -1), coalesce(resource_id, '')"""
_KEPT = ["pipeline_run_id", "source_type", "task_id", "try_number", "resource_id"]
_TAKEN = ["content_type", "source_uri", "dag_id", "dag_run_id", "map_index", "resource_type",
          "raw_content", "raw_json", "collected_at"]


def _select_list(columns: dict[str, str]) -> str:
    return ", ".join(f"{e} as {c}" for c, e in columns.items())


def _folded_sql(rows: str, keys: str, kept: list[str], filled: list[str], taken: list[str]) -> str:
    """Sequential application of ``rows`` in the order of ``o``, by window functions."""
    first = ", ".join(f"first_value({c}) over f as {c}" for c in kept)
    fill = ", ".join(f"last_value({c} ignore nulls) over f as {c}" for c in filled)
    last = ", ".join(f"last_value({c}) over f as {c}" for c in taken)
    return f"""select {', '.join(kept + filled + taken)} from (
        select {first}, {fill}, {last}, row_number() over (partition by {keys} order by o) as _rn
        from ({rows}) window f as (partition by {keys} order by o
                                   rows between unbounded preceding and unbounded following)) where _rn = 1"""


_SOURCES_SQL = f"""select {_select_list(_SOURCE_COLUMNS)},
    case when event_type = 'view' then 'JSON' else 'TEXT' end as content_type,
    case when event_type <> 'view' then {LINE_EXPR} end as raw_content,
    case when event_type = 'view' then {_PROPS_SQL} end as raw_json, ts as collected_at, event_id as o
    from events"""


def _halves(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    before = F.col("ts") < F.lit(_CUT).cast("timestamp_ntz")
    return df.filter(before), df.filter(~before)


@registry.add(f"""select *, sha256(coalesce(raw_content, raw_json)) as content_hash,
    cast(strlen(coalesce(raw_content, raw_json)) as bigint) as content_size_bytes,
    case when raw_content is not null then 1 end as line_count
    from ({_folded_sql(_SOURCES_SQL, _SOURCE_KEYS, _KEPT, ['pipeline_task_run_id'], _TAKEN)})""")
def upsert_log_sources(spark, sf_dir):
    events = event_lines(spark, sf_dir).select(
        "ts", F.col("event_id").alias("seq"),
        *[F.expr(e).alias(c) for c, e in _SOURCE_COLUMNS.items()],
        F.when(F.col("event_type") != "view", F.col("line")).alias("raw_text"),
        F.lit(None).cast("string").alias("raw_content"), F.expr(_PROPS).alias("raw_json"))
    old, new = (L.route_sources(half) for half in _halves(events))
    stored = old.withColumns({"id": F.lit(""), "collected_at": F.col("ts")}).drop("ts", "seq")
    base = L.upsert_log_sources(small_frame(spark, [], stored.schema), old, F.col("ts"))
    return L.upsert_log_sources(base, new, F.col("ts")).drop("id")


_RESOURCE_COLUMNS = {
    "pipeline_run_id": "user_id % 50",
    "pipeline_task_run_id": "nullif(event_id % 3, 2)",
    "resource_type": "event_type",
    "resource_id": "cast(event_id % 2 as varchar(20))",
    "resource_name": "case when event_id % 4 > 0 then cast(event_id as varchar(20)) end",
    "parent_resource_type": "case when event_id % 5 > 2 then event_type end",
    "parent_resource_id": "case when event_id % 6 = 1 then cast(user_id as varchar(20)) end",
    "namespace": "cast(null as varchar(20))",
    "cluster_name": "case when event_id % 7 < 2 then cast(event_id as varchar(20)) end",
    "application_id": "case when event_id % 50 = 1 then cast(event_id as varchar(20)) end",
    "started_at": "case when event_id % 3 = 0 then ts end",
    "finished_at": "case when event_id % 9 = 0 then ts end",
    "duration_sec": "case when event_id % 2 = 0 then value end",
    "discovered_from": "case when event_id % 2 = 0 then 'AIRFLOW_LOG' else 'SPARK_LOG' end",
    "confidence": "case when event_id % 5 = 0 then 'low' else 'high' end",
    "updated_at": "ts",
}
_RESOURCE_KEYS = "pipeline_run_id, coalesce(pipeline_task_run_id, 0), resource_type, resource_id"
_RESOURCES_SQL = (f"select {_select_list(_RESOURCE_COLUMNS)}, {_PROPS_SQL} as raw_payload, "
                  "event_id as o from events")


@registry.add(_folded_sql(
    _RESOURCES_SQL, _RESOURCE_KEYS, list(L.RESOURCE_RULE.keep), list(L.RESOURCE_RULE.fill),
    list(L.RESOURCE_RULE.overwrite)))
def upsert_resources(spark, sf_dir):
    found = table(spark, sf_dir, "events").select(
        "ts", F.col("event_id").alias("seq"), F.expr(_PROPS).alias("raw_payload"),
        *[F.expr(e).alias(c) for c, e in _RESOURCE_COLUMNS.items() if c != "updated_at"])
    old, new = _halves(found)
    stored = old.withColumn("updated_at", F.col("ts")).drop("ts", "seq")
    base = L.upsert_resources(small_frame(spark, [], stored.schema), old, F.col("ts"))
    return L.upsert_resources(base, new, F.col("ts"))


# Chunks of a first collection; a second one brings other chunks for the documents that are not
# English, the same chunk more than once, and nothing for the others.
_BASE_CHUNKS = "select doc_id as log_source_id, i as chunk_index, line as message from lines where line <> ''"
_NEW_CHUNKS = """select doc_id as log_source_id, (i - 1) // 2 as chunk_index, upper(lang) || ' ' || i as message, i as seq
    from lines join documents using (doc_id) where lang <> 'en'"""


def _replacement(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    docs = table(spark, sf_dir, "documents")
    base = (C.split_lines(docs.select("doc_id", "text")).filter("line <> ''")
             .selectExpr("doc_id as log_source_id", "line_no as chunk_index", "line as message"))
    lines = C.split_lines(docs.select("doc_id", "lang", "text")).filter("lang <> 'en'")
    new = lines.selectExpr("doc_id as log_source_id", "(line_no - 1) div 2 as chunk_index",
                           "concat(upper(lang), ' ', line_no) as message", "line_no as seq")
    return base, new


@registry.add(f"""with lines as ({lines_sql('documents', 'doc_id', 'text')}), base as ({_BASE_CHUNKS}),
    new as ({_NEW_CHUNKS})
    select log_source_id, chunk_index, message from base where log_source_id not in (select log_source_id from new)
    union all select log_source_id, chunk_index, arg_max(message, seq) from new group by 1, 2""")
def replace_chunks(spark, sf_dir):
    base, new = _replacement(spark, sf_dir)
    return L.replace_chunks(base, new, "seq")


@registry.add(f"""with lines as ({lines_sql('documents', 'doc_id', 'text')}), new as ({_NEW_CHUNKS})
    select log_source_id, count(*) as affected_rows from new group by 1""")
def affected_rows(spark, sf_dir):
    return L.affected_rows(_replacement(spark, sf_dir)[1])


# --- the whole collection -------------------------------------------------------------------

# A log per turn of a conversation, collected in two rounds: first the text of the turn, then for
# assistants a longer log, for users an empty one that must not take the old chunks away.
def _responses(spark, sf_dir, second: bool) -> DataFrame:
    nothing = F.lit(None).cast("string")
    body = F.col("text")
    if second:
        body = F.when(F.col("role") == "assistant",
                      F.to_json(F.struct(F.array(F.lit("ERROR retry"), F.col("text")).alias("content"))))
    return table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("pipeline_run_id"), F.lit(None).cast("bigint").alias("pipeline_task_run_id"),
        F.lit("AIRFLOW_LOG").alias("source_type"), nothing.alias("source_uri"),
        F.col("role").alias("dag_id"), F.col("conv_id").cast("string").alias("dag_run_id"),
        F.lit("turn").alias("task_id"), F.col("turn").cast("int").alias("try_number"),
        F.lit(-1).alias("map_index"), nothing.alias("resource_type"), nothing.alias("resource_id"),
        F.lit("application/json" if second else "text/plain").alias("content_type"),
        body.alias("body"), F.lit(0).alias("seq"))


_LOGS_SQL = """select conv_id * 10000 + turn as k, case when role = 'assistant'
    then 'ERROR retry' || chr(10) || text else text end as log from conversations"""


@registry.add(f"""select k // 10000 as pipeline_run_id, cast(k % 10000 as int) as try_number, chunk_index, line_start,
    line_end, char_start, char_end, message, {_LEVEL_SQL.format(m='message')} as level,
    {_ERROR_SQL.format(m='message')} as is_error
    from ({chunks_sql(lines_sql(f'({_LOGS_SQL})', 'k', 'log'), 'k', 4, 300)})""")
def collect_logs(spark, sf_dir):
    base, target = work_dir(spark, "corpus"), work_dir(spark, "published")
    for batch in (0, 1):
        collect.append_logs(collect.log_texts(_responses(spark, sf_dir, batch == 1)), base, batch,
                            max_lines=4, max_chars=300)
    collect.publish_logs(spark, base, target)
    sources = collect.published(spark, target, "log_sources").select("id", "try_number")
    chunks = collect.published(spark, target, "log_chunks")
    return (chunks.join(sources, chunks["log_source_id"] == sources["id"])
                  .select("pipeline_run_id", "try_number", "chunk_index", "line_start", "line_end",
                          "char_start", "char_end", "message", "level", "is_error"))


@registry.add("""select conv_id as pipeline_run_id, cast(turn as int) as try_number, role as dag_id, 'dag_id' as why
    from conversations where role not in ('user', 'assistant')
    union all select count(*), -1, 'kept', '' from conversations where role in ('user', 'assistant')""")
def quarantine(spark, sf_dir):
    """Turns of other roles than the two allowed ones are set aside, the others are written."""
    base = work_dir(spark, "corpus")
    written = collect.append_logs(collect.log_texts(_responses(spark, sf_dir, False)), base, 0,
                                  allowed={"dag_id": ["user", "assistant"], "source_type": ["AIRFLOW_LOG"]})
    aside = spark.read.parquet(f"{base}/quarantine").select(
        "pipeline_run_id", "try_number", "dag_id", F.array_join("quarantined_for", ",").alias("why"))
    kept = aside.sparkSession.range(1).select(F.lit(written["log_sources"]).cast("bigint"), F.lit(-1), F.lit("kept"), F.lit(""))
    return aside.unionAll(kept)


# All events of a type and day form one log file. A second collection finds other lines for views and blank
# logs for clicks, which must not take the old chunks away. Logs beyond some bytes count as too long for a cell.
_CELL = 250
_LOG_PER_DAY = """select event_type || '/' || strftime(ts, '%Y-%m-%d') as k,
    row_number() over (partition by event_type, strftime(ts, '%Y-%m-%d') order by ts, event_id) as i,
    {line} as line from events"""
_LAST_LINES = _LOG_PER_DAY.format(line=f"{LINE_EXPR} || case when event_type = 'view' then ' again' else '' end")


@registry.add(f"""with texts as (
      select k, string_agg(line || chr(10), '' order by i) as text, count(*) as n from ({_LAST_LINES}) group by k),
    sources as (
      select k, case when k like 'click/%' then sha256(chr(10)) else sha256(text) end as content_hash,
             case when k like 'click/%' then 1 else strlen(text) end as content_size_bytes,
             case when k like 'click/%' then 1 else n end as line_count from texts)
    select split_part(c.k, '/', 1) as dag_id, cast(split_part(c.k, '-', 3) as bigint) * 1000 + ascii(c.k) as pipeline_run_id, c.* exclude (k),
    sha256(message) as message_hash, {_LEVEL_SQL.format(m='message')} as level, {_ERROR_SQL.format(m='message')} as is_error,
    content_hash, cast(content_size_bytes as bigint) as content_size_bytes, cast(line_count as int) as line_count
    from ({chunks_sql(_LAST_LINES, 'k', 5, 200)}) c join sources s on s.k = c.k""")
def collect_attempts(spark, sf_dir):
    base, lines = work_dir(spark, "corpus"), event_lines(spark, sf_dir)
    runs = lines.select(F.col("event_type").alias("dag_id"), F.date_format("ts", "yyyy-MM-dd").alias("dag_run_id"),
                        (F.dayofmonth("ts") * 1000 + F.ascii("event_type")).alias("pipeline_run_id")).distinct()
    again = lines.filter("event_type = 'view'").withColumn("line", F.concat("line", F.lit(" again")))
    blank = (lines.filter("event_type = 'click'").withColumn("day", F.to_date("ts")).dropDuplicates(["day"])
                  .drop("day").withColumn("line", F.lit("")))
    for batch, found in enumerate((lines, again.unionByName(blank))):
        root = work_dir(spark, "attempts")
        write_attempts(found, root, whole=True)
        collect.append_attempts(spark, root, runs, base, batch, cell_bytes=_CELL, max_lines=5, max_chars=200)
    sources = collect.current_sources(spark, base).select(
        F.col("id").alias("log_source_id"), "dag_id", "content_hash", "content_size_bytes", "line_count")
    chunks = collect.current_chunks(spark, base).select(
        "log_source_id", "pipeline_run_id", "chunk_index", "line_start", "line_end", "char_start", "char_end", "message",
        "message_hash", "level", "is_error")
    return chunks.join(sources, "log_source_id").drop("log_source_id")
