"""The same results as plain SQL over the given tables."""

from __future__ import annotations

# Ranked windows on purpose: another way to the same bars than the one under test.
BARS = """
sales AS (
    SELECT CAST(l_shipdate AS DATE) AS date, p_brand AS symbol,
           l_orderkey, l_linenumber,
           CAST(l_extendedprice AS DECIMAL(10,4)) AS price,
           CAST(l_quantity AS BIGINT) AS quantity
    FROM lineitem JOIN part ON l_partkey = p_partkey
),
ranked AS (
    SELECT *,
           row_number() OVER (PARTITION BY date, symbol
               ORDER BY l_orderkey, l_linenumber, price) AS from_first,
           row_number() OVER (PARTITION BY date, symbol
               ORDER BY l_orderkey DESC, l_linenumber DESC, price DESC) AS from_last
    FROM sales
),
bars AS (
    SELECT date,
           max(CASE WHEN from_first = 1 THEN price END) AS open_price,
           max(price) AS high,
           min(price) AS low,
           max(CASE WHEN from_last = 1 THEN price END) AS close_price,
           CAST(sum(quantity) AS BIGINT) AS volume,
           symbol
    FROM ranked GROUP BY date, symbol
)"""

RAISED = """
raised AS (
    SELECT date, CAST(open_price + 1 AS DECIMAL(10,4)) AS open_price,
           high, low, close_price, volume, symbol
    FROM bars WHERE date >= DATE '1999-01-01'
)"""

DATES = """
days AS (
    SELECT CAST(strftime(date, '%Y%m%d') AS INTEGER) AS date_key, date AS full_date,
           CAST(extract(day FROM date) AS INTEGER) AS day_of_month,
           CAST(extract(month FROM date) AS INTEGER) AS month_number,
           CAST(extract(year FROM date) AS INTEGER) AS year
    FROM (SELECT DISTINCT date FROM bars) AS d
)"""

FACT = """
fact AS (
    SELECT date_key, symbol AS symbol_code, open_price, high AS high_price,
           low AS low_price, close_price, volume
    FROM bars JOIN days ON date = full_date
)"""

MERGED = """
first_load AS (SELECT * FROM fact WHERE date_key < 20000101),
second_load AS (
    SELECT date_key, symbol_code, CAST(open_price + 1 AS DECIMAL(10,4)) AS open_price,
           high_price, low_price, close_price, {volume} AS volume
    FROM fact WHERE date_key >= 19990101
)
SELECT * FROM second_load
UNION ALL
SELECT * FROM first_load AS f
WHERE NOT EXISTS (SELECT 1 FROM second_load AS s
                  WHERE s.date_key = f.date_key AND s.symbol_code = f.symbol_code)"""

STAGED = f"WITH {BARS} SELECT * FROM bars"
ALL_FACTS = f"WITH {BARS}, {DATES}, {FACT} SELECT * FROM fact"
UPSERTED = f"WITH {BARS}, {DATES}, {FACT}, {MERGED.format(volume='volume')}"

CALENDAR_NULLS = """
    SELECT date_key, full_date, CAST(NULL AS INTEGER) AS day_of_week,
           CAST(NULL AS VARCHAR) AS day_name, day_of_month,
           CAST(NULL AS INTEGER) AS day_of_year, CAST(NULL AS INTEGER) AS week_of_year,
           month_number, CAST(NULL AS VARCHAR) AS month_name,
           CAST(NULL AS INTEGER) AS quarter_number, CAST(NULL AS VARCHAR) AS quarter_name,
           year
    FROM days"""

# Keys count up in the order of the md5 of the symbol.
SYMBOLS = """
symbols AS (
    SELECT CAST(row_number() OVER (ORDER BY md5(symbol)) AS INTEGER) AS symbol_key,
           symbol AS symbol_code, 'N/A' AS company_name
    FROM (SELECT DISTINCT symbol FROM bars) AS s
)"""


def _violations(check: str, table: str, source: str, bad: str) -> str:
    return (
        f"SELECT '{check}' AS check_name, '{table}' AS table_name, "
        f"CAST(count(*) AS BIGINT) AS violations FROM {source} WHERE {bad}"
    )


def _surplus(check: str, table: str, source: str, *key: str) -> str:
    """Rows beyond the first of each whole key."""
    whole = " AND ".join(f"{k} IS NOT NULL" for k in key)
    return (
        f"SELECT '{check}', '{table}', CAST(count(*) - count(DISTINCT ({', '.join(key)})) AS BIGINT) "
        f"FROM {source} WHERE {whole}"
    )


def _orphans(column: str, dimension: str) -> str:
    return (
        f"{column} IS NOT NULL AND NOT EXISTS "
        f"(SELECT 1 FROM {dimension} AS d WHERE d.{column} = bad_fact.{column})"
    )


def _audit() -> str:
    staging, fact = "stock_prices", "fact_stock_prices"
    checks = [
        _violations("symbol not null", staging, "bad_staging", "symbol IS NULL"),
        _violations("symbol length", staging, "bad_staging", "length(symbol) > 10"),
        _violations("date_key not null", "dim_date", "bad_days", "date_key IS NULL"),
        _violations("full_date not null", "dim_date", "bad_days", "full_date IS NULL"),
        _violations("day_name length", "dim_date", "bad_days", "length(day_name) > 10"),
        _violations("month_name length", "dim_date", "bad_days", "length(month_name) > 10"),
        _violations("quarter_name length", "dim_date", "bad_days", "length(quarter_name) > 2"),
        _surplus("date_key unique", "dim_date", "bad_days", "date_key"),
        _violations("symbol_code not null", "dim_symbol", "bad_symbols", "symbol_code IS NULL"),
        _violations("symbol_code length", "dim_symbol", "bad_symbols", "length(symbol_code) > 10"),
        _violations("company_name length", "dim_symbol", "bad_symbols", "length(company_name) > 255"),
        _surplus("symbol_code unique", "dim_symbol", "bad_symbols", "symbol_code"),
        _violations("date_key not null", fact, "bad_fact", "date_key IS NULL"),
        _violations("symbol_code not null", fact, "bad_fact", "symbol_code IS NULL"),
        _violations("symbol_code length", fact, "bad_fact", "length(symbol_code) > 10"),
        _violations("date_key known", fact, "bad_fact", _orphans("date_key", "bad_days")),
        _violations("symbol_code known", fact, "bad_fact", _orphans("symbol_code", "bad_symbols")),
        _surplus("date_key, symbol_code unique", fact, "bad_fact", "date_key", "symbol_code"),
    ]
    for price in ("open_price", "high", "low", "close_price"):
        checks.append(
            _violations(f"{price} range", staging, "bad_staging", f"abs({price}) >= 1000000")
        )
    for price in ("open_price", "high_price", "low_price", "close_price"):
        checks.append(_violations(f"{price} range", fact, "bad_fact", f"abs({price}) >= 1000000"))

    def raised(price: str, key: str, symbol: str) -> str:
        return (
            f"CAST({price} AS DECIMAL(13,4)) + CASE WHEN {key} = '{symbol}' THEN 1000000 ELSE 0 END AS {price}"
        )

    staged = [
        raised(price, "symbol", symbol)
        for price, symbol in (
            ("open_price", "Brand#15"), ("high", "Brand#21"), ("low", "Brand#22"), ("close_price", "Brand#23")
        )
    ]
    loaded = [
        raised(price, "symbol_code", symbol)
        for price, symbol in (
            ("open_price", "Brand#1"), ("high_price", "Brand#2"), ("low_price", "Brand#3"),
            ("close_price", "Brand#4"),
        )
    ]
    return (
        f"WITH {BARS}, {DATES}, {FACT}, "
        f"""
bad_staging AS (
    SELECT date, {', '.join(staged)}, volume,
           CASE WHEN symbol = 'Brand#14' THEN 'Brand#14-long'
                WHEN symbol <> 'Brand#13' THEN symbol END AS symbol
    FROM bars
),
bad_days AS (
    SELECT CASE WHEN month_number <> 3 THEN date_key END AS date_key,
           CASE WHEN month_number <> 2 THEN full_date END AS full_date,
           CASE WHEN month_number = 4 THEN 'a long day name' END AS day_name,
           CASE WHEN month_number = 5 THEN 'a long month name' END AS month_name,
           CASE WHEN month_number = 6 THEN 'Q12' END AS quarter_name
    FROM (SELECT * FROM days WHERE month_number <> 12
          UNION ALL SELECT * FROM days WHERE month_number = 1) AS d
),
bad_symbols AS (
    SELECT CASE WHEN symbol = 'Brand#16' THEN 'Brand#16-long'
                WHEN symbol <> 'Brand#17' THEN symbol END AS symbol_code,
           repeat('x', CASE WHEN symbol = 'Brand#12' THEN 256 ELSE 255 END) AS company_name
    FROM (SELECT DISTINCT symbol FROM bars WHERE symbol <> 'Brand#25'
          UNION ALL SELECT DISTINCT symbol FROM bars WHERE symbol = 'Brand#11') AS s
),
bad_fact AS (
    SELECT CASE WHEN NOT (date_key // 10000 = 1997 AND symbol_code = 'Brand#18') THEN date_key END AS date_key,
           CASE WHEN date_key // 10000 = 1996 AND symbol_code = 'Brand#19' THEN 'Brand#19-long'
                WHEN NOT (date_key // 10000 = 1996 AND symbol_code = 'Brand#20') THEN symbol_code END
               AS symbol_code,
           {', '.join(loaded)}, volume
    FROM (SELECT * FROM fact
          UNION ALL SELECT * FROM fact WHERE date_key BETWEEN 19990101 AND 19991231) AS f
)
"""
        + "\nUNION ALL\n".join(checks)
    )


ORACLE: dict[str, str] = {
    "staging_load": STAGED,
    "payload_roundtrip": STAGED,
    "payload_rejects": f"""
WITH {BARS},
documents AS (SELECT DISTINCT symbol, extract(year FROM date) AS year FROM bars),
judged AS (
    SELECT symbol,
           CASE WHEN year = 1996 THEN 'no daily series'
                WHEN symbol = 'Brand#13' THEN 'not a valid document'
                WHEN year = 1998 THEN 'empty daily series'
                WHEN symbol IN ('Brand#22', 'Brand#23', 'Brand#24', 'Brand#25', 'Brand#11', 'Brand#12')
                    THEN 'not a valid document' END AS reason
    FROM documents
)
SELECT symbol, reason, CAST(count(*) AS BIGINT) AS payloads
FROM judged WHERE reason IS NOT NULL GROUP BY symbol, reason""",
    "csv_roundtrip": STAGED,
    "csv_replace": f"""
WITH {BARS}, {RAISED}
SELECT * FROM bars WHERE symbol >= 'Brand#2'
UNION ALL
SELECT * FROM raised WHERE symbol < 'Brand#2'""",
    "csv_by_name": STAGED,
    "staging_refresh": f"WITH {BARS}, {RAISED} SELECT * FROM raised",
    "csv_ragged_lines": f"""
WITH {BARS}
SELECT CASE WHEN symbol IN ('Brand#11', 'Brand#12') THEN 'ragged line' ELSE 'staged' END AS reason,
       CAST(count(*) AS BIGINT) AS lines
FROM bars GROUP BY 1""",
    "quarantine_rows": f"""
WITH {BARS}, spoilt AS (
    SELECT * FROM bars UNION ALL SELECT * FROM bars WHERE symbol = 'Brand#22'
)
SELECT CASE WHEN symbol = 'Brand#11' THEN strftime(date, '%Y')
            WHEN symbol <> 'Brand#21' THEN strftime(date, '%Y-%m-%d') END AS timestamp,
       CASE WHEN symbol = 'Brand#12' THEN '1e' ELSE CAST(open_price AS VARCHAR) END AS open,
       CASE WHEN symbol = 'Brand#13' THEN '999999.99995' ELSE CAST(high AS VARCHAR) END AS high,
       CAST(low AS VARCHAR) AS low,
       CAST(close_price AS VARCHAR) AS close,
       CASE WHEN symbol = 'Brand#14' THEN CAST(volume AS VARCHAR) || '.5'
            ELSE CAST(volume AS VARCHAR) END AS volume,
       CASE WHEN symbol = 'Brand#15' THEN 'Brand#15-long'
            WHEN symbol <> 'Brand#16' THEN symbol END AS symbol,
       CASE symbol WHEN 'Brand#11' THEN 'date is not a date'
                   WHEN 'Brand#12' THEN 'open_price is not a decimal(10,4)'
                   WHEN 'Brand#13' THEN 'high is not a decimal(10,4)'
                   WHEN 'Brand#14' THEN 'volume is not a bigint'
                   WHEN 'Brand#15' THEN 'symbol is longer than 10'
                   WHEN 'Brand#16' THEN 'symbol is missing'
                   WHEN 'Brand#21' THEN 'date is missing'
                   WHEN 'Brand#22' THEN 'repeated key' END AS reason
FROM spoilt
WHERE symbol IN ('Brand#11', 'Brand#12', 'Brand#13', 'Brand#14', 'Brand#15', 'Brand#16', 'Brand#21',
                 'Brand#22')""",
    "quarantine_kept": f"""
WITH {BARS}
SELECT date, open_price, high, low, close_price,
       CASE WHEN symbol <> 'Brand#15' THEN volume END AS volume, symbol
FROM bars WHERE symbol <> 'Brand#14'""",
    "empty_refresh": f"""
WITH {BARS}
SELECT CAST(count(*) AS BIGINT) AS row_count, 0 AS step FROM bars
UNION ALL SELECT CAST(0 AS BIGINT), 1""",
    "table_list": f"""
WITH {BARS}
SELECT 'staging' AS schema_name, 'stock_prices' AS table_name, CAST(count(*) AS BIGINT) AS row_count FROM bars
UNION ALL SELECT 'public', 'dim_date', CAST(count(DISTINCT date) AS BIGINT) FROM bars
UNION ALL SELECT 'public', 'dim_symbol', CAST(count(DISTINCT symbol) AS BIGINT) FROM bars
UNION ALL SELECT 'public', 'fact_stock_prices', CAST(count(*) AS BIGINT) FROM bars""",
    "distributed_join": f"""
WITH {BARS}, {RAISED}
SELECT b.symbol, b.date, b.open_price AS first_price, r.open_price AS second_price
FROM bars AS b JOIN raised AS r ON b.symbol = r.symbol AND b.date = r.date
WHERE b.date < DATE '2000-01-01'""",
    "staging_count": f"WITH {BARS} SELECT CAST(count(*) AS BIGINT) AS row_count FROM bars",
    "staging_peek": f"WITH {BARS} SELECT * FROM bars ORDER BY date, symbol LIMIT 10",
    "dim_date": f"WITH {BARS}, {DATES} SELECT * FROM days",
    "dim_date_full_ddl": f"WITH {BARS}, {DATES} {CALENDAR_NULLS}",
    "dim_date_incremental": f"""
WITH {BARS}, {DATES},
first_load AS (SELECT *, 1 AS batch FROM days WHERE date_key < 20000101),
second_load AS (SELECT *, 2 AS batch FROM days WHERE date_key >= 19990101)
SELECT * FROM first_load
UNION ALL
SELECT * FROM second_load WHERE date_key NOT IN (SELECT date_key FROM first_load)""",
    "calendar_attributes": f"""
WITH {BARS}, {DATES}
SELECT date_key,
       CAST(extract(isodow FROM full_date) AS INTEGER) AS day_of_week,
       dayname(full_date) AS day_name,
       CAST(extract(doy FROM full_date) AS INTEGER) AS day_of_year,
       CAST(extract(week FROM full_date) AS INTEGER) AS week_of_year,
       monthname(full_date) AS month_name,
       CAST(extract(quarter FROM full_date) AS INTEGER) AS quarter_number,
       'Q' || extract(quarter FROM full_date) AS quarter_name
FROM days""",
    "dim_symbol": f"WITH {BARS}, {SYMBOLS} SELECT * FROM symbols",
    "dim_symbol_incremental": f"""
WITH {BARS},
numbered AS (
    SELECT symbol, symbol < 'Brand#2' AS early,
           row_number() OVER (PARTITION BY symbol < 'Brand#2' ORDER BY md5(symbol)) AS n
    FROM (SELECT DISTINCT symbol FROM bars) AS s
)
SELECT CAST(CASE WHEN early THEN n
                 ELSE n + (SELECT count(*) FROM numbered WHERE early) END AS INTEGER)
           AS symbol_key,
       symbol AS symbol_code,
       CASE WHEN symbol = 'Brand#12' THEN 'Twelve Ltd' ELSE 'N/A' END AS company_name
FROM numbered""",
    "dim_symbol_requested": f"""
WITH {BARS}, {SYMBOLS}
SELECT * FROM symbols
UNION ALL
SELECT CAST(count(*) + 1 AS INTEGER), 'UNSEEN', 'N/A' FROM symbols""",
    "symbol_key_properties": f"""
WITH {BARS}, counts AS (
    SELECT CAST(count(DISTINCT symbol) AS BIGINT) AS n,
           CAST(count(DISTINCT CASE WHEN symbol < 'Brand#2' THEN symbol END) AS BIGINT) AS early
    FROM bars
)
SELECT n AS symbols, n AS codes, n AS keys, 1 AS first_key, CAST(n AS INTEGER) AS last_key,
       CAST(early AS INTEGER) AS last_known_key, CAST(early + 1 AS INTEGER) AS first_new_key,
       early AS unchanged
FROM counts""",
    "fact_one_symbol": f"{ALL_FACTS} WHERE symbol_code = 'Brand#12'",
    "fact_all_symbols": ALL_FACTS,
    "fact_upsert": UPSERTED,
    "fact_upsert_nulls": f"WITH {BARS}, {DATES}, {FACT}, "
    + MERGED.format(volume="CASE WHEN date_key >= 20000101 THEN volume END"),
    "fact_date_range": f"""
SELECT * FROM ({UPSERTED}) AS merged
WHERE date_key BETWEEN 19981215 AND 19990114 AND symbol_code IN ('Brand#12', 'Brand#21')""",
    "fact_duplicate_keys": f"""
WITH {BARS}, {DATES}, {FACT},
twice AS (
    SELECT * FROM fact
    UNION ALL SELECT * FROM fact WHERE date_key BETWEEN 19990101 AND 19991231
)
SELECT date_key, symbol_code, CAST(count(*) AS BIGINT) AS copies
FROM twice GROUP BY date_key, symbol_code HAVING count(*) > 1""",
    "constraint_audit": _audit(),
    "load_all_steps": ALL_FACTS,
    "load_two_days": UPSERTED,
    "load_old_day_again": UPSERTED,
    "stream_late_document": UPSERTED,
    "csv_mixed_headers": STAGED,
    "fact_count": f"""
SELECT date_key // 100 AS month_key, CAST(count(*) AS BIGINT) AS row_count
FROM ({UPSERTED}) AS merged GROUP BY 1""",
    "table_exists": f"""
WITH {BARS}
SELECT 'staging.stock_prices' AS table_name, CAST(NULL AS VARCHAR) AS reason, CAST(count(*) AS BIGINT) AS row_count FROM bars
UNION ALL SELECT 'public.dim_date', NULL, CAST(count(DISTINCT date) AS BIGINT) FROM bars
UNION ALL SELECT 'public.fact_stock_prices', NULL, CAST(count(*) AS BIGINT) FROM bars
UNION ALL SELECT name, 'table ' || name || ' does not exist; create the warehouse first', 0
FROM (VALUES ('public.dim_symbol'), ('public.dim_company')) AS gone(name)""",
    "input_exists": f"""
WITH {BARS}, documents AS (SELECT DISTINCT symbol, extract(year FROM date) AS year FROM bars)
SELECT 20240105 AS landed, true AS exists, CAST(count(*) AS BIGINT) AS files FROM documents WHERE year < 2000
UNION ALL SELECT 20240106, true, CAST(count(*) AS BIGINT) FROM documents WHERE year >= 1999
UNION ALL SELECT 20240107, false, 0""",
    "load_counts": f"""
WITH {BARS}, sent AS (
    SELECT 0 AS load, 'inserted_rows' AS fate, * FROM bars WHERE date < DATE '2000-01-01'
    UNION ALL
    SELECT 1, CASE WHEN date < DATE '2000-01-01' THEN 'replaced_rows' ELSE 'inserted_rows' END, *
    FROM bars WHERE date >= DATE '1999-01-01'
    UNION ALL
    SELECT 2, 'late_rows', * FROM bars WHERE extract(year FROM date) = 1999
),
usable AS (SELECT * FROM sent WHERE symbol <> 'Brand#13'),
loaded AS (SELECT * FROM usable WHERE symbol <> 'Brand#15'),
loads AS (SELECT unnest([0, 1, 2]) AS load),
fates AS (SELECT load, unnest(['inserted_rows', 'replaced_rows', 'late_rows']) AS fate FROM loads)
SELECT load, 'documents' AS step, CAST(count(DISTINCT (symbol, extract(year FROM date))) AS BIGINT) AS number
FROM sent GROUP BY load
UNION ALL
SELECT load, 'rejected_documents', CAST(count(DISTINCT extract(year FROM date)) AS BIGINT)
FROM sent WHERE symbol = 'Brand#13' GROUP BY load
UNION ALL SELECT load, 'extracted_rows', CAST(count(*) AS BIGINT) FROM usable GROUP BY load
UNION ALL SELECT load, 'read_rows', CAST(count(*) AS BIGINT) FROM usable GROUP BY load
UNION ALL
SELECT load, 'rejected_rows', CAST(count(*) AS BIGINT) FROM usable WHERE symbol = 'Brand#15' GROUP BY load
UNION ALL SELECT load, 'staged_rows', CAST(count(*) AS BIGINT) FROM loaded GROUP BY load
UNION ALL
SELECT load, fate, CAST(count(symbol) AS BIGINT) FROM fates LEFT JOIN loaded USING (load, fate)
GROUP BY load, fate""",
    "load_symbols_apart": f"{STAGED} WHERE symbol = 'Brand#21'",
    "incremental_stream": UPSERTED,
    "packed_stream": ALL_FACTS,
    "stream_with_rejects": f"""
WITH {BARS}
SELECT symbol, CAST(count(*) AS BIGINT) AS number, 'fact rows' AS kind
FROM bars WHERE symbol >= 'Brand#2' GROUP BY symbol
UNION ALL
SELECT symbol, CAST(count(DISTINCT extract(year FROM date)) AS BIGINT), 'rejected documents'
FROM bars WHERE symbol < 'Brand#2' GROUP BY symbol""",
}
