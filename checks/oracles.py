"""DuckDB SQL giving the same result as the query of the same name."""

from __future__ import annotations

from checks.fixture import RAW_SQL

# Raw text columns in CSV form: an empty string is read back as NULL.
_CSV = """
  "timestamp", sending_address, receiving_address, amount, risk_score, transaction_type,
  nullif(location_region, '') as location_region
"""

_LONG = r"""
  case when regexp_full_match({0}, '\s*[+-]?[0-9]+([.][0-9]*)?\s*')
       then try_cast(regexp_extract({0}, '([+-]?[0-9]+)', 1) as bigint) end
"""


def _long(text: str) -> str:
    return _LONG.format(text)


_CURATED = f"""
curated as (
  select {_long('"timestamp"')} as "timestamp",
    trim(sending_address) as sending_address,
    trim(receiving_address) as receiving_address,
    try_cast(amount as double) as amount,
    try_cast(risk_score as double) as risk_score,
    trim(transaction_type) as transaction_type,
    trim(location_region) as location_region,
    try_cast(processing_date as date) as processing_date
  from (select distinct * from raw)
)
"""

_REGIONS = """
regions as (
  select location_region, risk_score from curated
  where location_region is not null and location_region not in ('', '0')
)
"""

_AVG = """
avg_risk as (
  select location_region, round(avg(risk_score), 4) as avg_risk_score
  from regions where risk_score is not null group by location_region
)
"""

_LATEST = """
latest as (
  select receiving_address, amount, "timestamp" from curated
  where transaction_type = 'sale' and receiving_address <> ''
    and amount is not null and "timestamp" is not null
  qualify row_number() over (
    partition by receiving_address order by "timestamp" desc, amount desc) = 1
)
"""

_TOP3 = """
top3 as (select * from latest order by amount desc, receiving_address limit 3)
"""

_COUNTS = f"""
counts as (
  select
    count(*) filter (try_cast(amount as double) is null) as invalid_amount_records,
    count(*) filter (try_cast(risk_score as double) is null) as invalid_risk_score_records,
    count(*) filter ({_long('"timestamp"')} is null) as invalid_timestamp_records,
    count(*) filter (location_region is null or trim(location_region) = ''
      or location_region = '0') as invalid_location_region_records,
    count(*) filter (receiving_address is null or trim(receiving_address) = '')
      as invalid_receiving_address_records
  from raw
)
"""

_DAY = f"""(((coalesce({_long('"timestamp"')}, 0) % 3) + 3) % 3)"""

# Three days of one source as they are at the end, in place of all raw rows.
_DAYS = """
days as (select *, {day} as day from raw),
kept as ({kept}),
raw as (select * exclude (day) replace (cast('2024-02-01' as date) + cast({date} as integer) as processing_date)
  from kept)
"""

_SUMMARY = """
totals as (
  select (select count(*) from raw) as total_records,
    (select count(*) from raw) - (select count(*) from (select distinct * from raw))
      as duplicate_records
),
errors as (
  select *, duplicate_records + invalid_amount_records + invalid_risk_score_records
    + invalid_timestamp_records + invalid_location_region_records
    + invalid_receiving_address_records as total_error_records
  from totals, counts
),
summary as (
  select *, case when total_records > 0
    then round((total_records - total_error_records) / total_records * 100, 4)
    else 0 end as conformity_percentage
  from errors
)
"""

_CHECKS = """
  true as avg_path_exists,
  (select count(*) from avg_risk) as avg_record_count,
  'location_region,avg_risk_score' as avg_expected_columns,
  true as avg_columns_match,
  true as avg_is_ordered_desc,
  true as top3_path_exists,
  (select count(*) from top3) as top3_record_count,
  'receiving_address,amount,timestamp' as top3_expected_columns,
  true as top3_columns_match,
  (select count(*) from top3) <= 3 as top3_has_expected_limit
"""

_TWO_DATES = """
dated as (
  select raw.* replace (d as processing_date)
  from raw, (values ('2024-02-01'), ('2024-02-02')) as dates(d)
)
"""


def _days(select: str, kept: str, date: str, *ctes: str) -> str:
    """``select`` over raw rows that ``kept`` chooses from ``days`` and ``date`` dates."""
    source = RAW_SQL.replace("raw as (", "source as (")
    days = _DAYS.format(day=_DAY, kept=kept, date=date).replace("from raw)", "from source)")
    return ",".join([source, days, *ctes]) + select


def _sql(select: str, *ctes: str) -> str:
    return ",".join([RAW_SQL, *ctes]) + select


_TRIMMED = """
  "timestamp", trim(sending_address) as sending_address,
  trim(receiving_address) as receiving_address, amount, risk_score,
  trim(transaction_type) as transaction_type, trim(location_region) as location_region,
  processing_date
"""

ORACLES: dict[str, str] = {
    "csv_all_string_scan": _sql(f"select {_CSV}, processing_date from raw"),
    "land_snapshot": _sql(
        """
        select "timestamp" as "Timestamp", sending_address as "Sending Address",
          receiving_address as " Receiving Address ", amount as "AMOUNT",
          risk_score as "Risk Score", transaction_type as "Transaction Type",
          nullif(location_region, '') as "Location Region"
        from raw
        """
    ),
    "table_roundtrip": _sql("select * from dated", _TWO_DATES),
    "dynamic_partition_overwrite": _sql(
        """
        select * from dated
        where processing_date = '2024-02-02' or transaction_type = ' sale '
        """,
        _TWO_DATES,
    ),
    "full_overwrite": _sql("select * from raw where transaction_type = ' sale '"),
    "normalize_columns": _sql("select * exclude (processing_date) from raw"),
    "stamp_processing_date": _sql("select * replace ('2024-02-02' as processing_date) from raw"),
    "cast_double": _sql(
        """
        select amount as amount_text, try_cast(amount as double) as amount,
          risk_score as risk_score_text, try_cast(risk_score as double) as risk_score
        from raw
        """
    ),
    "cast_long": _sql(
        f"select text, {_long('text')} as seconds from texts",
        """
        texts as (
          select case right("timestamp", 1)
            when '7' then "timestamp" || '.9'
            when '3' then "timestamp" || '.'
            when '1' then '  ' || "timestamp" || ' '
            else "timestamp" end as text
          from raw
        )
        """,
    ),
    "epoch_to_timestamp": _sql(
        f"""
        select "timestamp" as text,
          make_timestamp({_long('"timestamp"')} * 1000000) as utc_time
        from raw
        """
    ),
    "trim_columns": _sql(f"select {_TRIMMED} from raw"),
    "cast_date": _sql(
        "select text, try_cast(text as date) as processing_date from texts",
        _TWO_DATES,
        """
        texts as (
          select case when amount = 'abc' then 'undated' else processing_date end as text
          from dated
        )
        """,
    ),
    "curate_transactions": _sql("select * from curated", _CURATED),
    "valid_region_filter": _sql(
        f"select {_TRIMMED} from raw where trim(location_region) not in ('', '0')"
    ),
    "sale_filter": _sql(f"select {_TRIMMED} from raw where trim(transaction_type) = 'sale'"),
    "exact_dedup": _sql("select distinct * from raw"),
    "avg_by_region_unsorted": _sql(
        """
        select location_region, round(avg(risk_score), 4) as avg_risk_score
        from curated group by location_region
        """,
        _CURATED,
    ),
    "avg_risk_score_by_region": _sql(
        "select * from avg_risk order by avg_risk_score desc, location_region",
        _CURATED,
        _REGIONS,
        _AVG,
    ),
    "latest_sale_per_address": _sql("select * from latest", _CURATED, _LATEST),
    "top3_latest_sale_amount": _sql("select * from top3", _CURATED, _LATEST, _TOP3),
    "dq_counts": _sql("select * from counts", _COUNTS),
    "dq_duplicates": _sql(
        """
        select copies, count(*) as distinct_rows
        from (select count(*) as copies from raw group by all_columns)
        group by copies
        """.replace(
            "all_columns",
            '"timestamp", sending_address, receiving_address, amount, risk_score, '
            "transaction_type, location_region, processing_date",
        )
    ),
    "dq_summary": _sql("select * from summary", _COUNTS, _SUMMARY),
    "dq_layer_reconciliation": _sql(
        """
        select (select count(*) from raw) as raw_total_records,
          (select count(*) from curated) as curated_total_records,
          (select count(*) from raw) - (select count(*) from curated) as removed_records
        """,
        _CURATED,
    ),
    "dq_output_checks": _sql(
        f"select {_CHECKS}", _CURATED, _REGIONS, _AVG, _LATEST, _TOP3
    ),
    "raw_load": _sql(f"select {_CSV}, processing_date from raw"),
    "curate_job_two_dates": _sql(
        """
        select curated.* replace (cast(d as date) as processing_date)
        from curated, (values ('2024-02-01'), ('2024-02-02')) as dates(d)
        """,
        _CURATED,
    ),
    "dq_report": _sql(
        f"""
        select '2024-02-01' as execution_date,
          true as landing_file_exists,
          '/landing/transactions/ingest_date=2024-02-01' as landing_file_path,
          summary.*,
          (select count(*) from curated) as curated_total_records,
          total_records - (select count(*) from curated) as curated_removed_records,
          {_CHECKS}
        from summary
        """,
        _CURATED,
        _REGIONS,
        _AVG,
        _LATEST,
        _TOP3,
        _COUNTS,
        _SUMMARY,
    ),
    "pipeline_end_to_end": _sql(
        """
        select 'avg_risk_score' as output, location_region as key, avg_risk_score as value
        from avg_risk
        union all select 'latest_amount', receiving_address, amount from top3
        union all select 'latest_time', receiving_address, cast("timestamp" as double) from top3
        union all select 'rows', 'raw', cast(count(*) as double) from raw
        union all select 'rows', 'curated', cast(count(*) as double) from curated
        """,
        _CURATED,
        _REGIONS,
        _AVG,
        _LATEST,
        _TOP3,
    ),
    "dq_stored_layers": _sql(
        """
        select count(*) as raw_total_records,
          2 * (select count(*) from curated) as curated_total_records,
          count(*) - 2 * (select count(*) from curated) as removed_records
        from raw
        """,
        _CURATED,
    ),
    "dq_mismatched_outputs": _sql(
        """
        select true as avg_path_exists,
          (select count(distinct coalesce(location_region, '-')) from curated)
            as avg_record_count,
          'location_region,avg_risk_score' as avg_expected_columns,
          false as avg_columns_match,
          true as avg_is_ordered_desc,
          true as top3_path_exists,
          (select count(*) from latest) as top3_record_count,
          'receiving_address,amount,timestamp' as top3_expected_columns,
          true as top3_columns_match,
          (select count(*) from latest) <= 3 as top3_has_expected_limit
        """,
        _CURATED,
        _LATEST,
    ),
    "incremental_two_days": _days(
        """
        select 'report' as output, key, cast(value as double) as value
        from (select columns(*)::double, duplicate_records::double as removed_records
          from summary) unpivot (value for key in (*))
        union all select 'avg_risk_score', location_region, avg_risk_score from avg_risk
        union all select 'latest_amount', receiving_address, amount from top3
        union all select 'latest_time', receiving_address, cast("timestamp" as double) from top3
        union all select 'rows', 'raw', cast(count(*) as double) from raw
        union all select 'rows', 'curated', cast(count(*) as double) from curated
        """,
        "select * from days where day < 2",
        "day",
        _CURATED,
        _REGIONS,
        _AVG,
        _LATEST,
        _TOP3,
        _COUNTS,
        _SUMMARY,
    ),
    "keyed_latest_sales": _days(
        "select * from latest",
        """select * from days where day <> 1
           or coalesce(length(receiving_address) + length(amount), 0) % 2 = 0""",
        "day",
        _CURATED,
        _LATEST,
    ),
    "sketched_ranges": _days(
        """
        select cast(a.d as varchar) as first_date, cast(b.d as varchar) as last_date,
          count(*) as curated_records, count(risk_score) as risk_scores,
          count(distinct nullif(receiving_address, '')) as addresses,
          true as addresses_within, true as risk_p25_within, true as risk_p50_within,
          true as risk_p75_within, true as risk_p95_within
        from (select distinct processing_date as d from curated) a
          join (select distinct processing_date as d from curated) b on a.d <= b.d
          join curated on processing_date between a.d and b.d
        group by a.d, b.d
        """,
        """select * from days where day <> 1
           or coalesce(length(receiving_address) + length(amount), 0) % 2 = 0""",
        "day",
        _CURATED,
    ),
    "empty_load": _sql(
        """
        select stage, layer, case when stage = 'first' then 0 else n end as n, columns
        from (values ('first'), ('later')) as v(stage), (
          select 'raw' as layer, count(*) as n, 'timestamp,sending_address,receiving_address,'
            || 'amount,risk_score,transaction_type,location_region,processing_date' as columns
          from raw
          union all select 'curated', count(*), 'timestamp,sending_address,receiving_address,'
            || 'amount,risk_score,transaction_type,location_region,processing_date'
          from curated
          union all select 'avg_risk', count(*), 'location_region,avg_risk_score' from avg_risk
          union all select 'top3', count(*), 'receiving_address,amount,timestamp' from top3
        )
        """,
        _CURATED,
        _REGIONS,
        _AVG,
        _LATEST,
        _TOP3,
    ),
    "narrow_load": _sql(
        f"""
        select "timestamp", sending_address, receiving_address, amount, risk_score,
          transaction_type, nullif(location_region, '') as location_region, processing_date
        from curated
        union all
        select distinct "timestamp", null, receiving_address, amount, null, transaction_type,
          location_region, date '2024-02-02'
        from (
          select {_long('"timestamp"')} as "timestamp", trim(receiving_address)
              as receiving_address, try_cast(amount as double) as amount,
            trim(transaction_type) as transaction_type,
            nullif(trim(location_region), '') as location_region
          from (select distinct "timestamp", receiving_address, amount, transaction_type,
            location_region from raw)
        )
        """,
        _CURATED,
    ),
    "dq_missing_output": _sql(
        """
        select false as landing_file_exists, count(*) as total_records,
          false as avg_path_exists, 0::bigint as avg_record_count,
          'location_region,avg_risk_score' as avg_expected_columns,
          false as avg_columns_match, false as avg_is_ordered_desc,
          false as top3_path_exists, 0::bigint as top3_record_count,
          'receiving_address,amount,timestamp' as top3_expected_columns,
          false as top3_columns_match, false as top3_has_expected_limit
        from raw
        """
    ),
    "one_version_back": _sql(
        """
        select *, 'before' as version from raw
        union all select *, 'current' from raw where transaction_type = ' sale '
        """
    ),
    "previous_transaction": _sql(
        """
        select s.receiving_address, s."timestamp", s.amount, s.sending_address,
          r."timestamp" as previous_timestamp, r.amount as previous_amount
        from (select * from curated where transaction_type = 'sale'
            and receiving_address <> '' and "timestamp" is not null) s
        asof left join (
          select receiving_address, "timestamp", max(amount) as amount from curated
          where amount is not null and "timestamp" is not null
          group by receiving_address, "timestamp"
        ) r on s.receiving_address = r.receiving_address and s."timestamp" > r."timestamp"
        """,
        _CURATED,
    ),
    "within_an_hour": _sql(
        """
        select a.location_region, a."timestamp", a.receiving_address, a.amount,
          b.location_region as next_location_region, b."timestamp" as next_timestamp,
          b.receiving_address as next_receiving_address, b.amount as next_amount
        from curated a join curated b on a.location_region = b.location_region
          and b."timestamp" > a."timestamp" and b."timestamp" <= a."timestamp" + 3600
        where a.location_region not in ('', '0')
        """,
        _CURATED,
    ),
    "risk_cube": _sql(
        """
        select location_region, transaction_type, processing_date,
          cast(grouping_id(location_region, transaction_type, processing_date) as bigint)
            as grouping_id,
          sum(risk_score) as total, count(*) as n
        from (select curated.* replace (cast(d as date) as processing_date)
          from curated, (values ('2024-02-01'), ('2024-02-02')) as dates(d))
        where risk_score is not null
        group by cube (location_region, transaction_type, processing_date)
        """,
        _CURATED,
    ),
    "streamed_load": _days(
        f"select {_CSV}, strftime(processing_date, '%Y-%m-%d') as processing_date from raw",
        "select * from days where day < 2",
        "0",
    ),
}
