"""The registered queries over the driver's tables, each with its oracle.

The tables hold numbers, so the queries first make measurement lines of them and then
treat these as any other text. The oracles compute from the numbers directly: a query
agrees only if writing, scanning, splitting, parsing and summing are all right.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from measure_rollup.functions import f32_text, f32_units, mean_tenths, mean_units, tenths_text, units
from measure_rollup.operators import (
    apply_mode,
    classify,
    counted,
    entries,
    finalize,
    finalize_float,
    line_counts,
    merge_float_states,
    merge_summaries,
    numbered,
    parse_records,
    partial_float_state,
    partial_summary,
    quarantine,
    read_summaries,
    report_line,
    report_parts,
    split_line,
    summarize,
    summarize_float,
    write_entries,
    write_report,
    write_summary,
)
from measure_rollup.plans.files import file_totals, update_files
from measure_rollup.plans.rollup import rollup, run, summary_of
from measure_rollup.sources import (
    CORRUPT,
    new_folder,
    read_lines,
    read_measurements,
    well_formed_rows,
    write_lines,
)
from measure_rollup.sources.shared import files_of
from measure_rollup.streaming import (
    compact_parts,
    compact_summary,
    latest_parts,
    latest_summary,
    malformed_lines,
    run_parts,
    run_summary,
)


class Query(NamedTuple):
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


def _register(sql: str | None = None, name: str | None = None):
    def keep(function):
        QUERIES[name or function.__name__] = Query(function, sql)
        return function

    return keep


class Measure(NamedTuple):
    """Columns of a table that serve as name and value, in SQL of both engines."""

    table: str
    name: str
    value: str


SEGMENT = Measure("customer", "c_mktsegment", "c_acctbal")
EVENT = Measure("events", "event_type", "value")
USER = Measure("events", "cast(user_id as varchar(20))", "value")
FLAG = Measure("lineitem", "concat(l_returnflag, '/', l_linestatus)", "l_extendedprice")
PART = Measure("lineitem", "concat('part ', cast(l_partkey as varchar(20)))", "l_extendedprice")
PRIORITY = Measure("orders", "o_orderpriority", "o_totalprice")
SUPPLIER = Measure("supplier", "s_name", "s_acctbal")


def _lines(spark: SparkSession, folder: str, measure: Measure, *more: str) -> DataFrame:
    """The table as lines ``name;-12.3``, with further columns if wanted."""
    tenths = spark.read.parquet(f"{folder}/{measure.table}.parquet").selectExpr(
        f"{measure.name} as name", f"cast(floor({measure.value} * 10) as bigint) as t", *more
    )
    digits = "if(t < 0, '-', ''), cast(abs(t) div 10 as string), '.', cast(abs(t) % 10 as string)"
    names = [c for c in tenths.columns if c not in ("name", "t")]
    return tenths.selectExpr(f"concat(name, ';', {digits}) as value", *names)


def _written(spark: SparkSession, lines: DataFrame) -> str:
    path = new_folder(spark, "lines")
    write_lines(lines, path)
    return path


def _tenths_sql(measure: Measure, *more: str) -> str:
    columns = ", ".join([f"{measure.name} as name", f"cast(floor({measure.value} * 10) as bigint) as t", *more])
    return f"(select {columns} from {measure.table})"


_STATE_SQL = "min(t) as min_t, max(t) as max_t, cast(sum(t) as bigint) as sum_t, count(t) as cnt"


def _state_sql(measure: Measure) -> str:
    return f"select name, {_STATE_SQL} from {_tenths_sql(measure)} group by name"


def _result_sql(measure: Measure) -> str:
    return f"""
        select name, min_t / 10.0::double as min, sum_t::double / cnt::double / 10.0::double as mean,
               max_t / 10.0::double as max, cnt
        from ({_state_sql(measure)})"""


def _text_sql(tenths: str) -> str:
    return f"(({tenths})::decimal(18, 1) / 10)::decimal(18, 1)::varchar"


_MEAN_SQL = "(case when sum_t < 0 then -1 else 1 end) * ((2 * abs(sum_t) + cnt) // (2 * cnt))"


def _entries_sql(measure: Measure) -> str:
    text = " || '/' || ".join(_text_sql(t) for t in ("min_t", _MEAN_SQL, "max_t"))
    return f"select name, name || '=' || {text} as entry from ({_state_sql(measure)})"


def _report_sql(entries_sql: str) -> str:
    joined = "coalesce(string_agg(entry, ', ' order by name), '')"
    return f"select 0::bigint as part, '{{' || {joined} || '}}' as report from ({entries_sql})"


def _parts_sql(entries_sql: str) -> str:
    return f"""
        select pos - 1 as part, (case when pos = 1 then '{{' else ', ' end) || entry
               || (case when pos = total then '}}' else '' end) as report
        from (select entry, row_number() over (order by name) as pos, count(*) over () as total
              from ({entries_sql}))"""


def _float_sql(measure: Measure) -> str:
    return f"""
        select name, min(x)::double as min, round(avg(x), 4) as mean, max(x)::double as max, count(x) as cnt
        from (select name, (t / 10.0::double)::float as x from {_tenths_sql(measure)}) group by name"""


def _rounded(summary: DataFrame) -> DataFrame:
    return summary.withColumn("mean", F.round("mean", 4))


# --- the whole query -------------------------------------------------------------------


@_register(_report_sql(_entries_sql(SEGMENT)))
def station_report(spark: SparkSession, folder: str) -> DataFrame:
    """Lines to the report, few names, with negative values."""
    return report_line(summary_of(_lines(spark, folder, SEGMENT)))


@_register(_parts_sql(_entries_sql(FLAG)))
def file_report(spark: SparkSession, folder: str) -> DataFrame:
    """Text files to the report."""
    return run(spark, _written(spark, _lines(spark, folder, FLAG)))


@_register(_result_sql(PART))
def file_rollup(spark: SparkSession, folder: str) -> DataFrame:
    """Text files to the sorted result, many names."""
    return rollup(spark, _written(spark, _lines(spark, folder, PART)))


# --- scans -----------------------------------------------------------------------------


@_register(_state_sql(EVENT))
def text_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Line scan of written text."""
    return summary_of(read_lines(spark, _written(spark, _lines(spark, folder, EVENT))))


@_register(
    "select count(*) as n, sum(length(value))::bigint as bytes from (select c_name || ';x' as value from customer)"
)
def line_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Each written line comes back once, whole, CRLF ends removed."""
    customer = spark.read.parquet(f"{folder}/customer.parquet")
    path = _written(spark, customer.selectExpr("concat(c_name, ';x\r') as value"))
    return read_lines(spark, path).agg(
        F.count("*").alias("n"), F.sum(F.octet_length("value").cast("bigint")).alias("bytes")
    )


@_register(
    f"""select name, {_STATE_SQL} from (
        select * from {_tenths_sql(EVENT)} union all select * from {_tenths_sql(PRIORITY)}
        union all select * from {_tenths_sql(SEGMENT)}) group by name"""
)
def paths_scan(spark: SparkSession, folder: str) -> DataFrame:
    """A list of paths: two folders and a glob."""
    events, orders, customers = (
        _written(spark, _lines(spark, folder, measure)) for measure in (EVENT, PRIORITY, SEGMENT)
    )
    return summary_of(read_lines(spark, [events, orders, f"{customers}/part-*"]))


@_register(_float_sql(EVENT))
def csv_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Delimited scan with 32-bit floats."""
    path = _written(spark, _lines(spark, folder, EVENT))
    return _rounded(summarize_float(read_measurements(spark, path), value="value"))


@_register(
    f"""select name, min(t) / 10.0::double as min, sum(t)::bigint / 10.0::double as sum,
               max(t) / 10.0::double as max, count(t) as cnt
        from {_tenths_sql(SEGMENT)} group by name"""
)
def csv_decimal_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Delimited scan with exact decimals."""
    path = _written(spark, _lines(spark, folder, SEGMENT))
    scan = read_measurements(spark, path, value_type="decimal(18,1)")
    return scan.groupBy("name").agg(
        F.min("value").cast("double").alias("min"),
        F.sum("value").cast("double").alias("sum"),
        F.max("value").cast("double").alias("max"),
        F.count("value").alias("cnt"),
    )


@_register(_state_sql(SEGMENT))
def key_value_folders(spark: SparkSession, folder: str) -> DataFrame:
    """Folders named like partitions are only folders."""
    path = new_folder(spark, "folders")
    lines = _lines(spark, folder, SEGMENT, "c_custkey % 3 as shard")
    for shard, name in enumerate(("value=x", "name=y", "t=1")):
        write_lines(lines.where(F.col("shard") == shard), f"{path}/{name}")
    return summary_of(read_lines(spark, path))


# --- projections -----------------------------------------------------------------------


@_register(_float_sql(SEGMENT))
def float_summary(spark: SparkSession, folder: str) -> DataFrame:
    """Values as 32-bit floats."""
    return _rounded(summary_of(_lines(spark, folder, SEGMENT), number="float"))


# A float of a tenth or more is a multiple of 2^-27, so these sums are exact.
def _exact_sql(measure: Measure) -> str:
    return f"""
        select name, min(x)::double as min, max(x)::double as max, count(x) as cnt,
               sum((x::double * 134217728)::bigint)::bigint::double / 134217728 / count(x) as mean
        from (select name, (t / 10.0::double)::float as x from {_tenths_sql(measure)}) group by name"""


@_register(_exact_sql(EVENT))
def exact_float_summary(spark: SparkSession, folder: str) -> DataFrame:
    """Values as 32-bit floats, summed exactly: every bit of the mean."""
    return summary_of(_lines(spark, folder, EVENT), number="exact")


@_register(
    f"""select {_text_sql('t')} as text, t / 10.0::double as value, count(*) as n
        from {_tenths_sql(SUPPLIER)} group by t"""
)
def number_text(spark: SparkSession, folder: str) -> DataFrame:
    """Tenths parsed, rescaled and written again, per distinct value."""
    records = parse_records(_lines(spark, folder, SUPPLIER))
    t = F.col("t")
    return records.groupBy("t").agg(F.count("*").alias("n")).select(
        tenths_text(t).alias("text"), units(t).alias("value"), "n"
    )


@_register(
    f"""select printf('%.1f', (t::float * 0.1::float)::double) as text, count(*) as n
        from {_tenths_sql(SEGMENT)} group by 1"""
)
def number_text_f32(spark: SparkSession, folder: str) -> DataFrame:
    """The same in 32-bit floats."""
    records = parse_records(_lines(spark, folder, SEGMENT))
    by_value = records.groupBy("t").agg(F.count("*").alias("n"))
    return by_value.groupBy(f32_text(f32_units(F.col("t"))).alias("text")).agg(F.sum("n").alias("n"))


# Lines with two delimiters, without a value, without a delimiter, and good ones.
_DAMAGED = """
    case c_custkey % 10 when 0 then c_mktsegment
        when 1 then concat(c_mktsegment, ';')
        when 2 then concat(c_mktsegment, ';abc')
        when 3 then concat(c_mktsegment, ';x;1.0')
        when 4 then concat(c_mktsegment, ';12.34')
        when 5 then concat(c_mktsegment, ';+', cast(c_custkey % 100 as varchar(20)), '.5')
        when 6 then concat(c_mktsegment, ';;')
        else concat(c_mktsegment, ';', cast(c_custkey % 100 as varchar(20)), '.5') end"""
_DAMAGED_SQL = f"(select {_DAMAGED} as value from customer)"


def _damaged(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/customer.parquet").selectExpr(f"{_DAMAGED} as value")


@_register(
    f"""select name, rest, count(*) as n from (
          select case when strpos(value, ';') > 0 then substr(value, 1, strpos(value, ';') - 1) end as name,
                 case when strpos(value, ';') > 0 then substr(value, strpos(value, ';') + 1) end as rest
          from {_DAMAGED_SQL}) group by name, rest"""
)
def split_first(spark: SparkSession, folder: str) -> DataFrame:
    return split_line(_damaged(spark, folder), "first").groupBy("name", "rest").agg(F.count("*").alias("n"))


@_register(
    f"""select name, rest, count(*) as n from (
          select case when strpos(value, ';') > 0 then regexp_extract(value, '^(.*);([^;]*)$', 1) end as name,
                 case when strpos(value, ';') > 0 then regexp_extract(value, '^(.*);([^;]*)$', 2) end as rest
          from {_DAMAGED_SQL}) group by name, rest"""
)
def split_last(spark: SparkSession, folder: str) -> DataFrame:
    return split_line(_damaged(spark, folder), "last").groupBy("name", "rest").agg(F.count("*").alias("n"))


# Names with a byte that is not UTF-8, right in front of the delimiter.
def _latin(spark: SparkSession, folder: str) -> DataFrame:
    customer = spark.read.parquet(f"{folder}/customer.parquet")
    broken = "if(c_custkey % 2 = 0, X'E9', X'FF')"
    value = "cast(concat(';', c_custkey % 100, '.5') as binary)"
    line = f"concat(cast(c_mktsegment as binary), {broken}, {value})"
    return customer.selectExpr(f"cast({line} as string) as value")


_LATIN_T = "cast(c_custkey % 100 * 10 + 5 as bigint) as t"


@_register(
    f"select name, {_STATE_SQL} from (select c_mktsegment || chr(65533) as name, {_LATIN_T} from customer) "
    "group by name"
)
def utf8_lossy(spark: SparkSession, folder: str) -> DataFrame:
    """Damaged names that become the same text are one group."""
    return summary_of(read_lines(spark, _written(spark, _latin(spark, folder))), encoding="lossy")


@_register(
    f"""select name, {_STATE_SQL} from (
          select hex(c_mktsegment) || case when c_custkey % 2 = 0 then 'E9' else 'FF' end as name, {_LATIN_T}
          from customer) group by name"""
)
def utf8_bytes(spark: SparkSession, folder: str) -> DataFrame:
    """Names with different bytes are different groups; shown in hexadecimal."""
    summary = summary_of(read_lines(spark, _written(spark, _latin(spark, folder))), encoding="bytes")
    return summary.withColumn("name", F.hex(F.col("name").cast("binary")))


def _condition(df: DataFrame) -> str:
    """The error condition that counting the rows ends in."""
    try:
        df.count()
    except PySparkException as error:
        return error.getCondition() or type(error).__name__
    return "none"


@_register(f"select *, 'INVALID_UTF8_STRING' as damaged from ({_state_sql(PRIORITY)})")
def utf8_strict(spark: SparkSession, folder: str) -> DataFrame:
    """Valid text passes the strict policy unchanged; damaged lines stop even a count."""
    damaged = _condition(parse_records(_latin(spark, folder), encoding="strict"))
    summary = summary_of(_lines(spark, folder, PRIORITY), encoding="strict")
    return summary.withColumn("damaged", F.lit(damaged))


# --- record quality --------------------------------------------------------------------

_STATUS_SQL = """
    case when strpos(value, ';') = 0 then 'no_delimiter'
         when substr(value, strpos(value, ';') + 1) = '' then 'empty_value'
         when not regexp_full_match(substr(value, strpos(value, ';') + 1), '-?[0-9]+[.][0-9]') then 'bad_value'
         else 'ok' end"""
_GOOD_SQL = f"""(select split_part(value, ';', 1) as name,
                        cast(replace(split_part(value, ';', 2), '.', '') as bigint) as t
                 from {_DAMAGED_SQL} where {_STATUS_SQL} = 'ok')"""


@_register(f"select status, count(*) as n from (select {_STATUS_SQL} as status from {_DAMAGED_SQL}) group by status")
def classify_lines(spark: SparkSession, folder: str) -> DataFrame:
    return classify(_damaged(spark, folder)).groupBy("status").agg(F.count("*").alias("n"))


@_register(
    f"""select status, count(*) as n, sum(length(value))::bigint as chars from (
          select value, {_STATUS_SQL} as status
          from (select unnest(string_split(text, chr(10))) as value from documents))
        group by status"""
)
def classify_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Every line of every document; prose is not a measurement."""
    documents = spark.read.parquet(f"{folder}/documents.parquet")
    lines = documents.select(F.explode(F.split("text", "\n")).alias("value"))
    return classify(lines).groupBy("status").agg(
        F.count("*").alias("n"), F.sum(F.length("value").cast("bigint")).alias("chars")
    )


@_register(
    f"select value, status, count(*) as n from (select value, {_STATUS_SQL} as status from {_DAMAGED_SQL}) "
    "where status <> 'ok' group by value, status"
)
def quarantine_lines(spark: SparkSession, folder: str) -> DataFrame:
    return quarantine(_damaged(spark, folder)).groupBy("value", "status").agg(F.count("*").alias("n"))


@_register(
    f"""select shard, value, status, count(*) as n from (
          select value, {_STATUS_SQL} as status, shard
          from (select {_DAMAGED} as value, 'shard-' || (c_custkey % 3)::varchar as shard from customer))
        where status <> 'ok' group by shard, value, status"""
)
def malformed_places(spark: SparkSession, folder: str) -> DataFrame:
    """Each malformed line with the folder of the file it is in."""
    path = new_folder(spark, "shards")
    customer = spark.read.parquet(f"{folder}/customer.parquet")
    for shard in range(3):
        lines = customer.where(F.col("c_custkey") % 3 == shard).selectExpr(f"{_DAMAGED} as value")
        write_lines(lines, f"{path}/shard-{shard}")
    found = quarantine(read_lines(spark, path, place=True))
    shard = F.element_at(F.split("file", "/"), -2).alias("shard")
    return found.groupBy(shard, "value", "status").agg(F.count("*").alias("n"))


@_register(
    f"""select status, n, (select count(*) from {_GOOD_SQL}) as summed
        from (select status, count(*) as n from (select {_STATUS_SQL} as status from {_DAMAGED_SQL}) group by status)"""
)
def status_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Lines by status, counted in the pass that makes the summary."""
    seen = Observation("lines")
    summary = summarize(counted(parse_records(read_lines(spark, _written(spark, _damaged(spark, folder)))), seen))
    summed = summary.agg(F.sum("cnt")).first()[0]
    rows = [(status, n, summed) for status, n in line_counts(seen).items() if n]
    return spark.createDataFrame(rows, "status string, n bigint, summed bigint")


@_register(f"select name, {_STATE_SQL} from {_GOOD_SQL} group by name")
def drop_malformed(spark: SparkSession, folder: str) -> DataFrame:
    """A summary skips malformed lines."""
    return summary_of(_damaged(spark, folder), mode="drop")


@_register(f"select name, t, count(*) as n from {_GOOD_SQL} group by name, t")
def kept_records(spark: SparkSession, folder: str) -> DataFrame:
    """The well-formed lines as rows."""
    return apply_mode(parse_records(_damaged(spark, folder)), "drop").groupBy("name", "t").agg(F.count("*").alias("n"))


@_register(
    f"""select name, {_STATE_SQL} from (
          select regexp_extract(value, '^(.*);([^;]*)$', 1) as name,
                 cast(replace(regexp_extract(value, '^(.*);([^;]*)$', 2), '.', '') as bigint) as t
          from {_DAMAGED_SQL} where regexp_matches(value, ';-?[0-9]+[.][0-9]$')) group by name"""
)
def drop_malformed_last(spark: SparkSession, folder: str) -> DataFrame:
    """The same, splitting at the last delimiter: a name may hold the delimiter."""
    return summary_of(_damaged(spark, folder), split="last")


@_register(f"select *, 'USER_RAISED_EXCEPTION' as damaged from ({_state_sql(FLAG)})")
def fail_malformed(spark: SparkSession, folder: str) -> DataFrame:
    """Clean input passes the strict mode unchanged; malformed lines stop even a count."""
    damaged = _condition(apply_mode(parse_records(_damaged(spark, folder)), "fail"))
    summary = summary_of(_lines(spark, folder, FLAG), mode="fail")
    return summary.withColumn("damaged", F.lit(damaged))


# The delimited reader takes any float, so 12.34 and +7.5 are well formed here, and an
# empty value is null.
_CSV_BAD_SQL = "c_custkey % 10 in (0, 2, 3, 6)"


@_register(
    f"select value, count(*) as n from (select {_DAMAGED} as value from customer where {_CSV_BAD_SQL}) "
    "group by value"
)
def csv_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    scan = read_measurements(spark, _written(spark, _damaged(spark, folder)), mode="quarantine")
    malformed = scan.where(F.col(CORRUPT).isNotNull())
    return malformed.groupBy(F.col(CORRUPT).alias("value")).agg(F.count("*").alias("n"))


_CSV_GOOD_SQL = f"""
    select name, min(x)::double as min, round(avg(x), 4) as mean, max(x)::double as max, count(x) as cnt
    from (select c_mktsegment as name, (case c_custkey % 10 when 1 then null when 4 then 12.34
              else c_custkey % 100 + 0.5 end)::float as x from customer where not {_CSV_BAD_SQL})
    group by name"""


@_register(_CSV_GOOD_SQL)
def csv_drop(spark: SparkSession, folder: str) -> DataFrame:
    path = _written(spark, _damaged(spark, folder))
    return _rounded(summarize_float(read_measurements(spark, path, mode="drop"), value="value"))


@_register(_CSV_GOOD_SQL)
def csv_kept(spark: SparkSession, folder: str) -> DataFrame:
    """The kept side of a quarantine scan."""
    scan = read_measurements(spark, _written(spark, _damaged(spark, folder)), mode="quarantine")
    return _rounded(summarize_float(well_formed_rows(scan), value="value"))


# --- aggregation -----------------------------------------------------------------------


@_register(
    f"select name, {_STATE_SQL}, sum(t)::bigint::double / count(t)::double / 10.0::double as mean "
    f"from {_tenths_sql(SEGMENT)} group by name"
)
def tenths_summary(spark: SparkSession, folder: str) -> DataFrame:
    """State per name, and the mean in units."""
    summary = summary_of(_lines(spark, folder, SEGMENT))
    return summary.withColumn("mean", mean_units(F.col("sum_t"), F.col("cnt")))


@_register(_state_sql(FLAG))
def lineitem_summary(spark: SparkSession, folder: str) -> DataFrame:
    """The largest table, few names."""
    return summary_of(_lines(spark, folder, FLAG))


@_register(_state_sql(PART))
def lineitem_part_summary(spark: SparkSession, folder: str) -> DataFrame:
    """The largest table, many names."""
    return summary_of(_lines(spark, folder, PART))


@_register(f"select part, name, {_STATE_SQL} from {_tenths_sql(SEGMENT, 'c_custkey % 7 as part')} group by part, name")
def partial_summaries(spark: SparkSession, folder: str) -> DataFrame:
    """One state per part of the data and name."""
    records = parse_records(_lines(spark, folder, SEGMENT, "c_custkey % 7 as shard"))
    return partial_summary(records, F.col("shard"))


@_register(_result_sql(SEGMENT), "merge_summaries")
def merged_summaries(spark: SparkSession, folder: str) -> DataFrame:
    """Summaries of parts, merged and finalised, equal the direct result."""
    records = parse_records(_lines(spark, folder, SEGMENT, "c_custkey % 7 as shard"))
    return finalize(merge_summaries(partial_summary(records, F.col("shard"))))


@_register(
    f"""select name, {_STATE_SQL} from (select * from {_tenths_sql(EVENT)} union all
        select * from {_tenths_sql(SEGMENT)} union all select * from {_tenths_sql(EVENT)}) group by name"""
)
def united_summaries(spark: SparkSession, folder: str) -> DataFrame:
    """Summaries of different inputs merge, whichever names each of them has."""
    events, customers = (summary_of(_lines(spark, folder, m)) for m in (EVENT, SEGMENT))
    return merge_summaries(events, customers, events)


@_register(_state_sql(FLAG))
def stored_summaries(spark: SparkSession, folder: str) -> DataFrame:
    """Summaries of parts stored as a table, read again and merged."""
    lines = _lines(spark, folder, FLAG, "cast(year(l_shipdate) as int) as year")
    path = new_folder(spark, "summaries")
    write_summary(partial_summary(parse_records(lines), F.col("year")), path)
    return merge_summaries(read_summaries(spark, path))


@_register(_exact_sql(FLAG))
def stored_float_states(spark: SparkSession, folder: str) -> DataFrame:
    """Float states of parts stored as a table, one part written twice, read again and merged."""
    lines = _lines(spark, folder, FLAG, "cast(year(l_shipdate) as int) as year")
    records = parse_records(lines, number="float")
    path = new_folder(spark, "float-states")
    write_summary(partial_float_state(records, F.col("year")), path)
    write_summary(partial_float_state(records.where("year = 1995"), F.col("year")), path)
    return finalize_float(merge_float_states(read_summaries(spark, path, number="exact")))


@_register(f"""select name, {_STATE_SQL} from (
    select * from {_tenths_sql(EVENT)} union all select * from {_tenths_sql(SEGMENT)}) group by name""")
def replaced_files(spark: SparkSession, folder: str) -> DataFrame:
    """A summary of files after some were replaced, deleted and added: only these are read again."""
    source, table = new_folder(spark, "files"), new_folder(spark, "versions")
    kept = _lines(spark, folder, EVENT)
    write_lines(kept, f"{source}/kept")
    write_lines(_lines(spark, folder, PRIORITY), f"{source}/first")
    update_files(spark, source, table)
    of, system = files_of(spark, source)
    system.delete(of(f"{source}/first"), True)
    write_lines(_lines(spark, folder, SEGMENT), f"{source}/second")
    update_files(spark, source, table)
    return file_totals(spark, table)


# --- order and rendering ---------------------------------------------------------------


@_register(
    f"""select name, {_STATE_SQL}, row_number() over (order by name) as pos, count(*) over () as total
        from {_tenths_sql(USER)} group by name"""
)
def sorted_names(spark: SparkSession, folder: str) -> DataFrame:
    """The summary in name order, with positions."""
    return numbered(summary_of(_lines(spark, folder, USER)))


@_register(_entries_sql(USER))
def report_entries(spark: SparkSession, folder: str) -> DataFrame:
    """One entry per name, many names."""
    return entries(summary_of(_lines(spark, folder, USER)))


@_register(_parts_sql(_entries_sql(PART)), "report_parts")
def parts_of_report(spark: SparkSession, folder: str) -> DataFrame:
    """The report with a row for each of many names."""
    return report_parts(summary_of(_lines(spark, folder, PART)))


@_register(f"select report, strlen(report)::bigint as n_bytes from ({_report_sql(_entries_sql(PRIORITY))})")
def written_report(spark: SparkSession, folder: str) -> DataFrame:
    """The report as one file: its bytes."""
    path = new_folder(spark, "report")
    write_report(summary_of(_lines(spark, folder, PRIORITY)), path)
    file = spark.read.format("binaryFile").load(path)
    return file.select(F.col("content").cast("string").alias("report"), F.col("length").alias("n_bytes"))


@_register(
    f"""select (case when part = 0 then report else report[3:] end) as value,
               (sum(strlen(report)) over ())::bigint as n_bytes from ({_parts_sql(_entries_sql(PART))})"""
)
def written_long_report(spark: SparkSession, folder: str) -> DataFrame:
    """The report of many names as one line: what stands between its separators, and its size."""
    path = new_folder(spark, "report")
    write_report(summary_of(_lines(spark, folder, PART)), path)
    size = spark.read.format("binaryFile").load(path).select(F.col("length").alias("n_bytes"))
    return spark.read.option("lineSep", ", ").text(path).join(F.broadcast(size))


@_register(f"select entry as value from ({_entries_sql(SUPPLIER)})")
def written_entries(spark: SparkSession, folder: str) -> DataFrame:
    """One entry per line as text files, read again."""
    path = new_folder(spark, "entries")
    write_entries(summary_of(_lines(spark, folder, SUPPLIER)), path)
    return read_lines(spark, path)


def _f32_sql(value: str) -> str:
    return f"printf('%.1f', ({value})::double)"


_F32_STATE = ("min_t::float * 0.1::float", "(sum_t::float / cnt::float) * 0.1::float", "max_t::float * 0.1::float")


@_register(
    _report_sql(
        "select name, name || '=' || "
        + " || '/' || ".join(_f32_sql(v) for v in _F32_STATE)
        + f" as entry from ({_state_sql(EVENT)})"
    )
)
def report_f32(spark: SparkSession, folder: str) -> DataFrame:
    """The report with every step in 32-bit floats."""
    return report_line(summary_of(_lines(spark, folder, EVENT)), render="f32")


def _float_entries_sql(measure: Measure) -> str:
    text = " || '/' || ".join(_f32_sql(v) for v in ("min", "mean::float", "max"))
    return f"""
        select name, name || '=' || {text} as entry from (
            select name, min(x) as min, avg(x) as mean, max(x) as max
            from (select name, (t / 10.0::double)::float as x from {_tenths_sql(measure)}) group by name)"""


@_register(_report_sql(_float_entries_sql(EVENT)))
def report_float(spark: SparkSession, folder: str) -> DataFrame:
    """The report of the float path."""
    return report_line(summary_of(_lines(spark, folder, EVENT), number="float"), render="float")


@_register(_parts_sql(_float_entries_sql(PRIORITY)))
def csv_report(spark: SparkSession, folder: str) -> DataFrame:
    """Delimited scan to the report."""
    return run(spark, _written(spark, _lines(spark, folder, PRIORITY)), reader="csv")


@_register(f"select name, {_MEAN_SQL} as mean_t from ({_state_sql(USER)})")
def rounded_means(spark: SparkSession, folder: str) -> DataFrame:
    """Means rounded to whole tenths, halves away from zero."""
    summary = summary_of(_lines(spark, folder, USER))
    return summary.select("name", mean_tenths(F.col("sum_t"), F.col("cnt")).cast("bigint").alias("mean_t"))


# --- streaming -------------------------------------------------------------------------


@_register(f"""select name, {_STATE_SQL} from (
    select * from {_tenths_sql(EVENT)} union all select * from {_tenths_sql(SEGMENT)}) group by name""")
def stream_summary(spark: SparkSession, folder: str) -> DataFrame:
    """A running summary: some files, a snapshot, then a second run that finds more."""
    source, output = new_folder(spark, "arriving"), new_folder(spark, "running")
    write_lines(_lines(spark, folder, EVENT), f"{source}/first")
    run_summary(spark, source, output)
    compact_summary(spark, output)
    write_lines(_lines(spark, folder, SEGMENT), f"{source}/second")
    run_summary(spark, source, output)
    return latest_summary(spark, output)


@_register(f"""select name, {_STATE_SQL} from (
    select * from {_GOOD_SQL} union all select * from {_tenths_sql(EVENT)}) group by name""")
def stream_parts(spark: SparkSession, folder: str) -> DataFrame:
    """The summary of files that arrive in two runs, malformed lines among them."""
    return latest_parts(spark, _arrived(spark, folder))


@_register(
    f"select value, status, count(*) as n from (select value, {_STATUS_SQL} as status from {_DAMAGED_SQL}) "
    "where status <> 'ok' group by value, status"
)
def stream_malformed(spark: SparkSession, folder: str) -> DataFrame:
    """The malformed lines of the same files: the other output."""
    found = malformed_lines(spark, _arrived(spark, folder))
    return found.groupBy("value", "status").agg(F.count("*").alias("n"))


def _arrived(spark: SparkSession, folder: str) -> str:
    source, output = new_folder(spark, "arriving"), new_folder(spark, "parts")
    write_lines(_damaged(spark, folder), f"{source}/first")
    run_parts(spark, source, output, mode="quarantine")
    compact_parts(spark, output)
    write_lines(_lines(spark, folder, EVENT), f"{source}/second")
    run_parts(spark, source, output, mode="quarantine")
    return output


@_register(_exact_sql(EVENT))
def stream_floats(spark: SparkSession, folder: str) -> DataFrame:
    """Exact floats of files that arrive, one file a batch."""
    source, output = new_folder(spark, "arriving"), new_folder(spark, "parts")
    write_lines(_lines(spark, folder, EVENT).repartition(3), source)
    run_parts(spark, source, output, number="exact", max_files=1)
    return finalize_float(latest_parts(spark, output, "exact"))
