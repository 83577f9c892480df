"""DuckDB SQL for every query, written independently of the Spark code.

Money is whole cents here, so the rounding is plain integer arithmetic.
"""

from __future__ import annotations

RAW = """
purchases AS (
  SELECT l_suppkey AS vendornumber,
         CASE WHEN l_suppkey % 3 = 0 THEN '  ' || s_name || ' ' ELSE s_name END AS vendorname,
         l_partkey AS brand,
         p_name || ' ' || l_partkey AS description,
         CASE WHEN p_size = 50 THEN 0 ELSE (list_cents * 16 + 5) // 10 END AS price_c,
         CAST(l_quantity AS BIGINT) AS quantity,
         CASE WHEN p_size = 50 THEN 0 ELSE (list_cents * 16 * CAST(l_quantity AS BIGINT) + 5) // 10 END AS dollars_c
  FROM lineitem
  JOIN (SELECT *, CAST(round(p_retailprice * 100) AS BIGINT) AS list_cents FROM part) ON l_partkey = p_partkey
  JOIN supplier ON l_suppkey = s_suppkey
  WHERE l_linestatus = 'O'),
purchase_prices AS (
  SELECT p_partkey % 10 AS vendornumber, p_partkey AS brand,
         CAST(round(p_retailprice * 100) AS BIGINT) * 2 AS price_c,
         CASE WHEN p_size = 49 THEN 'Unknown' ELSE CAST(p_size * 50 AS VARCHAR) END AS volume
  FROM part),
lines AS (
  SELECT *, CAST(round(l_extendedprice * 100) AS BIGINT) AS amount, CAST(round(l_tax * 100) AS BIGINT) AS tax,
         CAST(round(l_discount * 100) AS BIGINT) AS discount, CAST(l_quantity AS BIGINT) AS q
  FROM lineitem),
vendor_invoice AS (
  SELECT l_suppkey AS vendornumber, l_orderkey AS ponumber,
         CAST((sum(amount * tax) + 50) // 100 AS BIGINT) AS freight_c
  FROM lines WHERE l_linestatus = 'O' AND l_suppkey % 7 <> 0 GROUP BY ALL),
sales AS (
  SELECT l_suppkey AS vendorno, l_partkey AS brand, q AS salesquantity,
         (amount * (100 - discount) + 50) // 100 AS dollars_c,
         (2 * amount + q) // (2 * q) AS price_c,
         (amount * tax + 50) // 100 AS tax_c
  FROM lines WHERE l_linestatus = 'F'),
inventory AS (
  SELECT p_partkey AS brand, p_size AS onhand, CAST(round(p_retailprice * 100) AS BIGINT) / 100.0 AS price FROM part)
"""

SUMMARY = RAW + """,
freight AS (SELECT vendornumber, sum(freight_c)::BIGINT AS freight_c FROM vendor_invoice GROUP BY ALL),
bought AS (
  SELECT p.vendornumber, p.vendorname, p.brand, p.description, p.price_c, pp.price_c AS actual_c, pp.volume,
         sum(p.quantity)::BIGINT AS bought_q, sum(p.dollars_c)::BIGINT AS bought_c
  FROM purchases p JOIN purchase_prices pp ON p.brand = pp.brand
  WHERE p.price_c > 0
  GROUP BY ALL),
sold AS (
  SELECT vendorno, brand, sum(salesquantity)::BIGINT AS sold_q, sum(dollars_c)::BIGINT AS sold_c,
         sum(price_c)::BIGINT AS sold_price_c, sum(tax_c)::BIGINT AS sold_tax_c
  FROM sales GROUP BY ALL),
pairs AS (
  SELECT b.*, s.sold_q, s.sold_c, s.sold_price_c, s.sold_tax_c, f.freight_c
  FROM bought b
  LEFT JOIN sold s ON b.vendornumber = s.vendorno AND b.brand = s.brand
  LEFT JOIN freight f ON b.vendornumber = f.vendornumber),
summary AS (
  SELECT vendornumber, vendorname, brand, description, price_c / 100.0 AS purchaseprice,
         actual_c / 100.0 AS actual_price, volume, bought_q AS total_purchase_quantity,
         bought_c / 100.0 AS total_purchase_dollars, sold_q AS total_sales_quantity,
         sold_c / 100.0 AS total_sales_dollars, sold_price_c / 100.0 AS total_sales_price,
         sold_tax_c / 100.0 AS total_excise_tax, freight_c / 100.0 AS freight_cost
  FROM pairs)
"""

CLEAN = SUMMARY + """,
filled AS (
  SELECT vendornumber, trim(coalesce(vendorname, '0')) AS vendorname, brand,
         trim(coalesce(description, '0')) AS description, coalesce(purchaseprice, 0) AS purchaseprice,
         coalesce(actual_price, 0) AS actual_price,
         coalesce(TRY_CAST(volume AS DOUBLE), 0) AS volume,
         coalesce(total_purchase_quantity, 0) AS total_purchase_quantity,
         coalesce(total_purchase_dollars, 0) AS total_purchase_dollars,
         coalesce(total_sales_quantity, 0) AS total_sales_quantity,
         coalesce(total_sales_dollars, 0) AS total_sales_dollars,
         coalesce(total_sales_price, 0) AS total_sales_price,
         coalesce(total_excise_tax, 0) AS total_excise_tax,
         coalesce(freight_cost, 0) AS freight_cost,
         total_sales_dollars AS raw_sales
  FROM summary),
clean AS (
  SELECT * EXCLUDE (raw_sales), total_sales_dollars - total_purchase_dollars AS gross_profit,
         CASE WHEN total_sales_dollars = 0 THEN 0
              ELSE (total_sales_dollars - total_purchase_dollars) / total_sales_dollars * 100 END AS profit_margin,
         CASE WHEN total_purchase_quantity = 0 THEN 0
              ELSE total_sales_quantity / total_purchase_quantity END AS stock_turnover,
         CASE WHEN total_purchase_dollars = 0 THEN 0
              ELSE total_sales_dollars / total_purchase_dollars END AS sales_to_purchase_ratio
  FROM filled),
good AS (
  SELECT * FROM clean WHERE gross_profit > 0 AND profit_margin > 0 AND total_sales_quantity > 0)
"""

BRANDS = CLEAN + """,
performance AS (
  SELECT description, sum(total_sales_dollars) AS total_sales, avg(profit_margin) AS avg_profit_margin
  FROM good GROUP BY description),
limits AS (
  SELECT quantile_cont(total_sales, 0.15) AS low_sales_threshold,
         quantile_cont(avg_profit_margin, 0.85) AS high_margin_threshold
  FROM performance),
judged AS (
  SELECT *, total_sales <= low_sales_threshold AND avg_profit_margin >= high_margin_threshold AS is_target
  FROM performance, limits)
"""

SHARES = CLEAN + """,
totals AS (
  SELECT vendorname, sum(total_purchase_dollars) AS bought, sum(gross_profit) AS profit,
         sum(total_sales_dollars) AS sold
  FROM good GROUP BY vendorname),
shares AS (SELECT *, bought / (SELECT sum(bought) FROM totals) * 100 AS share FROM totals),
top AS (
  SELECT vendorname, round(bought, 2) AS bought, round(profit, 2) AS profit, round(sold, 2) AS sold,
         round(share, 2) AS share, row_number() OVER (ORDER BY shares.share DESC, vendorname) AS place
  FROM shares ORDER BY shares.share DESC, vendorname LIMIT 10)
"""

SIZES = CLEAN + """,
edges AS (
  SELECT quantile_cont(total_purchase_quantity::DOUBLE, 0.3333333333333333) AS t1,
         quantile_cont(total_purchase_quantity::DOUBLE, 0.6666666666666666) AS t2
  FROM good),
sized AS (
  SELECT good.*, total_purchase_dollars / total_purchase_quantity AS unit_purchase_price,
         CASE WHEN total_purchase_quantity <= t1 THEN 'Small'
              WHEN total_purchase_quantity <= t2 THEN 'Medium' ELSE 'Large' END AS order_size
  FROM good, edges)
"""

BANDS = CLEAN + """,
cuts AS (
  SELECT quantile_cont(total_sales_dollars, 0.75) AS top_threshold,
         quantile_cont(total_sales_dollars, 0.25) AS low_threshold
  FROM good),
banded AS (
  SELECT 'top' AS band, profit_margin FROM good, cuts WHERE total_sales_dollars >= top_threshold
  UNION ALL
  SELECT 'low' AS band, profit_margin FROM good, cuts WHERE total_sales_dollars <= low_threshold)
"""

NUMERIC = [
    "vendornumber", "brand", "purchaseprice", "actual_price", "volume", "total_purchase_quantity",
    "total_purchase_dollars", "total_sales_quantity", "total_sales_dollars", "total_sales_price",
    "total_excise_tax", "freight_cost", "gross_profit", "profit_margin", "stock_turnover",
    "sales_to_purchase_ratio",
]


def with_(ctes: str, body: str) -> str:
    return f"WITH {ctes} {body}"


def long_(table: str, columns: list[str] | None = None, keep: str = "") -> str:
    return " UNION ALL ".join(
        f"SELECT {keep}'{c}' AS series, CAST({c} AS DOUBLE) AS value FROM {table}" for c in columns or NUMERIC
    )


def rounded(columns: list[str], digits: int = 6) -> str:
    return ", ".join(f"round({c}, {digits}) AS {c}" for c in columns)


def label(value: str) -> str:
    """Money label of a value rounded to cents, from its exact double."""
    return (
        f"CASE WHEN {value} >= 1000000 THEN format('{{:.2f}}M', CAST({value} AS DOUBLE) / 1000000.0)"
        f" WHEN {value} >= 1000 THEN format('{{:.2f}}K', CAST({value} AS DOUBLE) / 1000.0)"
        f" ELSE CAST({value} AS VARCHAR) END"
    )


def half_away(top: str, bottom: str, scale: int) -> str:
    """top / bottom times scale as a whole number, halves away from zero; bottom > 0."""
    return f"sign({top}) * ((2 * {scale} * abs({top})::HUGEINT + {bottom}) // (2 * {bottom}))"


PURCHASE_COLUMNS = (
    "vendornumber, vendorname, brand, description, price_c / 100.0 AS purchaseprice, quantity, dollars_c / 100.0 AS dollars"
)
SALES_COLUMNS = (
    "vendorno, brand, salesquantity, dollars_c / 100.0 AS salesdollars, price_c / 100.0 AS salesprice,"
    " tax_c / 100.0 AS excisetax"
)
PREVIEWS = {
    "purchases": PURCHASE_COLUMNS,
    "purchase_prices": "vendornumber, brand, price_c / 100.0 AS price, volume",
    "vendor_invoice": "vendornumber, ponumber, freight_c / 100.0 AS freight",
    "sales": SALES_COLUMNS,
}
FRACTIONS = [c for c in NUMERIC if c not in ("vendornumber", "brand", "total_purchase_quantity", "total_sales_quantity")]
CLEAN_ROUNDED = (
    "vendornumber, vendorname, brand, description, total_purchase_quantity, total_sales_quantity, " + rounded(FRACTIONS)
)
RAW_SUMMARY_TYPES = [
    ("vendornumber", "bigint"), ("vendorname", "string"), ("brand", "bigint"), ("description", "string"),
    ("purchaseprice", "decimal(15,2)"), ("actual_price", "decimal(15,2)"), ("volume", "string"),
    ("total_purchase_quantity", "bigint"), ("total_purchase_dollars", "decimal(25,2)"),
    ("total_sales_quantity", "bigint"), ("total_sales_dollars", "decimal(25,2)"),
    ("total_sales_price", "decimal(25,2)"), ("total_excise_tax", "decimal(25,2)"), ("freight_cost", "decimal(25,2)"),
]
PADDED = "vendorname LIKE ' %' OR vendorname LIKE '% ' OR vendorname <> trim(vendorname)"


def vendor_rows() -> str:
    columns = [
        "table_name", "vendornumber", "vendorname", "brand", "description", "purchaseprice", "quantity", "dollars",
        "price", "volume", "ponumber", "freight", "salesquantity", "salesdollars", "salesprice", "excisetax",
    ]
    return f"""
    SELECT {', '.join(columns)} FROM (
      SELECT 'purchases' AS table_name, {PURCHASE_COLUMNS} FROM purchases WHERE vendornumber = 4
      UNION ALL BY NAME
      SELECT 'purchase_prices' AS table_name, {PREVIEWS['purchase_prices']} FROM purchase_prices WHERE vendornumber = 4
      UNION ALL BY NAME
      SELECT 'vendor_invoice' AS table_name, {PREVIEWS['vendor_invoice']} FROM vendor_invoice WHERE vendornumber = 4
      UNION ALL BY NAME
      SELECT 'sales' AS table_name, {SALES_COLUMNS.replace('vendorno,', 'vendorno AS vendornumber,')}
      FROM sales WHERE vendorno = 4)"""


def histogram(ctes: str, source: str) -> str:
    return with_(ctes, f"""
    , v AS (SELECT * FROM ({source}) WHERE value IS NOT NULL),
    span AS (
      SELECT series, CASE WHEN min(value) = max(value) THEN min(value) - 0.5 ELSE min(value) END AS low,
             CASE WHEN min(value) = max(value) THEN max(value) + 0.5 ELSE max(value) END AS high
      FROM v GROUP BY series),
    edges AS (
      SELECT series, CAST(i AS INTEGER) AS bin, low + i * ((high - low) / 30) AS bin_low,
             CASE WHEN i = 29 THEN high ELSE low + (i + 1) * ((high - low) / 30) END AS bin_high
      FROM span, range(30) r(i)),
    folded AS (SELECT series, value, count(*) AS n FROM v GROUP BY ALL)
    SELECT e.series, e.bin, round(bin_low, 6) AS bin_low, round(bin_high, 6) AS bin_high,
           CAST(coalesce(sum(n), 0) AS BIGINT) AS "rows"
    FROM edges e LEFT JOIN folded f
      ON e.series = f.series AND f.value >= e.bin_low AND (f.value < e.bin_high OR (e.bin = 29 AND f.value <= e.bin_high))
    GROUP BY ALL""")


def density(ctes: str, source: str) -> str:
    return with_(ctes, f"""
    , v AS (SELECT series, value, count(*) AS w FROM ({source}) WHERE value IS NOT NULL GROUP BY ALL),
    flat AS (SELECT * FROM ({source}) WHERE value IS NOT NULL),
    shape AS (
      SELECT series, count(*) AS n, min(value) AS low, (max(value) - min(value)) / 199 AS step,
             stddev_samp(value) * pow(count(*), -0.2) AS h
      FROM flat GROUP BY series HAVING stddev_samp(value) > 0),
    grid AS (SELECT series, n, h, CAST(i AS INTEGER) AS point, low + i * step AS x FROM shape, range(200) r(i))
    SELECT g.series, g.point, round(g.x, 4) AS x,
           round(sum(w * exp(-0.5 * pow((v.value - g.x) / h, 2))) / (n * h * sqrt(2 * pi())), 10) AS density
    FROM grid g JOIN v ON g.series = v.series
    GROUP BY g.series, g.point, g.x, n, h""")


def boxes(ctes: str, source: str, keys: str) -> str:
    using = ", ".join(k.strip() for k in keys.split(","))
    return with_(ctes, f"""
    , v AS (SELECT * FROM ({source}) WHERE value IS NOT NULL),
    q AS (
      SELECT {keys}, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
             quantile_cont(value, 0.75) AS q3
      FROM v GROUP BY ALL)
    SELECT {keys}, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
           round(least(min(value) FILTER (value >= q1 - 1.5 * (q3 - q1)), q1), 6) AS whisker_low,
           round(greatest(max(value) FILTER (value <= q3 + 1.5 * (q3 - q1)), q3), 6) AS whisker_high,
           count(*) FILTER (value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)) AS outliers
    FROM v JOIN q USING ({using}) GROUP BY {keys}, q1, median, q3""")


def correlation(table: str) -> str:
    cells = " UNION ALL ".join(
        f"SELECT '{a}' AS col_a, '{b}' AS col_b, corr({a}, {b}) AS r FROM {table}" for a in NUMERIC for b in NUMERIC
    )
    return with_(CLEAN, f"SELECT col_a, col_b, CASE WHEN NOT isnan(r) THEN round(r, 6) END AS corr FROM ({cells})")


def top_by(name: str) -> str:
    return with_(CLEAN, f"""
    , t AS (SELECT {name}, round(sum(total_sales_dollars), 2) AS total_sales_dollars FROM good GROUP BY {name})
    SELECT {name}, total_sales_dollars, {label('total_sales_dollars')} AS sales_label
    FROM t ORDER BY total_sales_dollars DESC, {name} LIMIT 10""")


# Expansion of Student's quantile around the normal 0.975 quantile z, in powers of 1 / v.
T_975 = """(z + (pow(z,3) + z) / 4 / v + (5*pow(z,5) + 16*pow(z,3) + 3*z) / 96 / pow(v,2)
  + (3*pow(z,7) + 19*pow(z,5) + 17*pow(z,3) - 15*z) / 384 / pow(v,3)
  + (79*pow(z,9) + 776*pow(z,7) + 1482*pow(z,5) - 1920*pow(z,3) - 945*z) / 92160 / pow(v,4))"""

STRICT = with_(SUMMARY, f"""
, f AS (
  SELECT *, coalesce(sold_q, 0) AS sq, coalesce(sold_c, 0) AS sc, coalesce(sold_c, 0) - bought_c AS gp FROM pairs),
m AS (
  SELECT *, CASE WHEN sc = 0 THEN 0 ELSE {half_away('gp', 'sc', 10000)} END AS margin2,
         CASE WHEN bought_q = 0 THEN 0 ELSE {half_away('sq', 'bought_q', 10000)} END AS turn4,
         CASE WHEN bought_c = 0 THEN 0 ELSE {half_away('sc', 'bought_c', 10000)} END AS ratio4
  FROM f)
SELECT CAST(vendornumber AS INTEGER) AS vendornumber, trim(vendorname) AS vendorname, CAST(brand AS INTEGER) AS brand,
       description, price_c / 100.0 AS purchaseprice, actual_c / 100.0 AS actual_price,
       TRY_CAST(volume AS DOUBLE) AS volume, bought_q AS total_purchase_quantity,
       bought_c / 100.0 AS total_purchase_dollars, sq AS total_sales_quantity, sc / 100.0 AS total_sales_dollars,
       coalesce(sold_price_c, 0) / 100.0 AS total_sales_price, coalesce(sold_tax_c, 0) / 100.0 AS total_excise_tax,
       freight_c / 100.0 AS freight_cost, gp / 100.0 AS gross_profit,
       CAST(margin2 AS BIGINT) / 100.0 AS profit_margin,
       CAST((turn4 + 50) // 100 AS BIGINT) / 100.0 AS stock_turnover,
       CAST((ratio4 + 50) // 100 AS BIGINT) / 100.0 AS sales_to_purchase_ratio
FROM m""")

ORACLE_SQL: dict[str, str] = {
    "table_row_counts": with_(RAW, " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS total_rows FROM {source}"
        for name, source in [
            ("purchases", "purchases"), ("purchase_prices", "purchase_prices"), ("vendor_invoice", "vendor_invoice"),
            ("sales", "sales"), ("begin_inventory", "inventory"), ("end_inventory", "inventory"),
        ])),
    **{f"preview_{t}": with_(RAW, f"SELECT {c} FROM {t} ORDER BY ALL LIMIT 5") for t, c in PREVIEWS.items()},
    "preview_begin_inventory": with_(RAW, "SELECT * FROM inventory ORDER BY ALL LIMIT 5"),
    "preview_end_inventory": with_(RAW, "SELECT * REPLACE (onhand - (onhand + 2) // 3 AS onhand) FROM inventory ORDER BY ALL LIMIT 5"),
    "vendor_rows": with_(RAW, vendor_rows()),
    "vendor_purchases_by_price": with_(RAW, """
        SELECT brand, price_c / 100.0 AS purchaseprice, sum(quantity)::BIGINT AS total_quantity,
               sum(dollars_c)::BIGINT / 100.0 AS total_dollars
        FROM purchases WHERE vendornumber = 4 GROUP BY brand, price_c ORDER BY 1, 2"""),
    "vendor_sales_by_brand": with_(RAW, """
        SELECT brand, sum(dollars_c)::BIGINT / 100.0 AS sales_dollars, sum(price_c)::BIGINT / 100.0 AS sales_price,
               sum(salesquantity)::BIGINT AS sales_quantity
        FROM sales WHERE vendorno = 4 GROUP BY brand"""),
    "duplicate_pos": with_(RAW, """
        SELECT ponumber, count(ponumber) AS count_of_duplicates FROM vendor_invoice
        GROUP BY ponumber HAVING count(ponumber) > 1 ORDER BY 2 DESC, 1"""),
    "duplicate_vendor_pos": with_(RAW, """
        SELECT vendornumber, ponumber, count(ponumber) AS count_of_duplicates FROM vendor_invoice
        GROUP BY ALL HAVING count(ponumber) > 1"""),
    "duplicate_sales_pairs": with_(RAW, """
        SELECT vendorno, brand, count(*) AS "rows" FROM sales GROUP BY ALL HAVING count(*) > 1"""),
    "heavy_vendor_sales": with_(RAW, """
        SELECT vendorno AS name, sum(dollars_c) / 100.0 AS total FROM sales GROUP BY vendorno
        ORDER BY sum(dollars_c) DESC, vendorno LIMIT 10"""),
    "heavy_purchase_descriptions": with_(RAW, """
        SELECT description AS name, count(*) AS total FROM purchases GROUP BY description
        ORDER BY count(*) DESC, description LIMIT 10"""),
    "sales_below_price": with_(RAW, """
        SELECT vendorno, count(*) AS lines, count(*) FILTER (s.price_c < p.price_c) AS lines_below,
               sum((p.price_c - s.price_c) * salesquantity) FILTER (s.price_c < p.price_c) / 100.0 AS shortfall
        FROM sales s LEFT JOIN (SELECT brand, min(price_c) AS price_c FROM purchase_prices GROUP BY brand) p USING (brand)
        GROUP BY vendorno"""),
    "price_fan_out": with_(RAW, """
        SELECT brand, count(*) AS "rows", 'duplicate key' AS violation FROM purchase_prices
        GROUP BY brand HAVING count(*) > 1"""),
    "price_vendor_brands": with_(RAW, """
        SELECT vendornumber, count(*) AS "rows", 'duplicate key' AS violation FROM purchase_prices
        GROUP BY vendornumber HAVING count(*) > 1"""),
    "freight_by_vendor": with_(SUMMARY, "SELECT vendornumber, freight_c / 100.0 AS freight_cost FROM freight"),
    "purchase_summary": with_(SUMMARY, """
        SELECT vendornumber, vendorname, brand, description, price_c / 100.0 AS purchaseprice,
               actual_c / 100.0 AS actual_price, volume, bought_q AS total_purchase_quantity,
               bought_c / 100.0 AS total_purchase_dollars
        FROM bought"""),
    "sales_summary": with_(SUMMARY, """
        SELECT vendorno, brand, sold_q AS total_sales_quantity, sold_c / 100.0 AS total_sales_dollars,
               sold_price_c / 100.0 AS total_sales_price, sold_tax_c / 100.0 AS total_excise_tax
        FROM sold"""),
    "vendor_summary": with_(SUMMARY, """
        SELECT * FROM summary ORDER BY total_purchase_dollars DESC NULLS FIRST, vendornumber, brand"""),
    "chunk_ledger": with_(SUMMARY, """
        SELECT 'purchases' AS table_name, 4 AS chunks, count(*) AS rows FROM purchases WHERE price_c > 0
        UNION ALL SELECT 'sales', 4, count(*) FROM sales
        UNION ALL SELECT 'vendor_invoice', 4, count(*) FROM vendor_invoice
        UNION ALL SELECT 'purchase_prices', 1, count(*) FROM purchase_prices"""),
    "csv_quoted_breaks": with_(SUMMARY, """
        SELECT vendornumber, count(*) AS rows, CAST(sum(length(description || chr(10) || '"' || vendorname || '"')) AS BIGINT) AS characters,
               CAST(sum(quantity) AS BIGINT) AS quantity
        FROM purchases GROUP BY vendornumber"""),
    "csv_row_rejects": with_(SUMMARY, """
        SELECT 'row' AS kind, count(*) AS records, sum(CASE WHEN ponumber % 10 <> 2 THEN freight_c END) / 100.0 AS freight
        FROM vendor_invoice WHERE ponumber % 10 NOT IN (0, 1)
        UNION ALL SELECT 'freight does not fit decimal(15,2)', count(*), NULL FROM vendor_invoice WHERE ponumber % 10 = 0 HAVING count(*) > 0
        UNION ALL SELECT 'too many fields', count(*), NULL FROM vendor_invoice WHERE ponumber % 10 = 1 HAVING count(*) > 0"""),
    "invoice_versions": with_(SUMMARY, """
        SELECT 1 AS version, count(*) AS rows, sum(freight_c) / 100.0 AS freight FROM vendor_invoice
        UNION ALL SELECT 2, count(*), sum(freight_c) / 100.0 FROM vendor_invoice WHERE freight_c > 0"""),
    "summary_clean_py": with_(CLEAN, "SELECT * FROM clean"),
    "summary_clean_sql": STRICT,
    "null_profile": with_(SUMMARY, "SELECT " + ", ".join(
        f"count(*) - count({c}) AS {c}_nulls" for c, _ in RAW_SUMMARY_TYPES) + " FROM summary"),
    "column_profile": with_(SUMMARY, " UNION ALL ".join(
        f"SELECT {i} AS ordinal, '{c}' AS column_name, '{t}' AS data_type, true AS is_nullable, count(*) - count({c}) AS nulls FROM summary"
        for i, (c, t) in enumerate(RAW_SUMMARY_TYPES, start=1))),
    "untrimmed_names": with_(SUMMARY, f"""
        SELECT vendorname, CAST(length(vendorname) AS INTEGER) AS original_length,
               CAST(length(trim(vendorname)) AS INTEGER) AS trimmed_length
        FROM summary WHERE {PADDED}"""),
    "visible_whitespace": with_(SUMMARY, """
        SELECT vendorname, replace(vendorname, ' ', '•') AS visible_whitespace
        FROM summary WHERE vendorname LIKE ' %' OR vendorname LIKE '% ' ORDER BY vendorname"""),
    "padded_before_cleaning": with_(SUMMARY, f"""
        SELECT vendorname, CAST(length(vendorname) AS INTEGER) AS current_length,
               '>' || vendorname || '<' AS visualized
        FROM summary WHERE {PADDED}"""),
    "summary_preview": with_(CLEAN, f"SELECT {CLEAN_ROUNDED} FROM clean ORDER BY clean.vendornumber, clean.brand LIMIT 10"),
    "duplicate_keys": with_(CLEAN, """
        SELECT vendornumber, brand, count(*) AS "rows" FROM clean GROUP BY ALL HAVING count(*) > 1"""),
    "key_violations": with_(CLEAN, """
        SELECT vendornumber, brand, count(*) AS "rows",
               CASE WHEN vendornumber IS NULL OR brand IS NULL THEN 'null key' ELSE 'duplicate key' END AS violation
        FROM clean GROUP BY vendornumber, brand
        HAVING count(*) > 1 OR vendornumber IS NULL OR brand IS NULL"""),
    "post_clean_check": with_(CLEAN, f"""
        SELECT vendorname, CAST(length(vendorname) AS INTEGER) AS current_length,
               '>' || vendorname || '<' AS visualized
        FROM clean WHERE {PADDED}"""),
    "distinct_vendors": with_(SUMMARY, "SELECT DISTINCT vendorname FROM summary ORDER BY 1"),
    "distinct_good_brands": with_(CLEAN, "SELECT DISTINCT description FROM good ORDER BY 1"),
    "profitable_rows": with_(CLEAN, f"SELECT {CLEAN_ROUNDED} FROM good"),
    "low_turnover": with_(CLEAN, """
        SELECT vendorname, round(avg(stock_turnover), 6) AS avg_stock FROM clean
        WHERE stock_turnover < 1 GROUP BY vendorname"""),
    "low_turnover_profitable": with_(CLEAN, """
        SELECT vendorname, round(avg(stock_turnover), 6) AS avg_stock FROM good
        WHERE stock_turnover < 1 GROUP BY vendorname"""),
    "low_turnover_having": with_(CLEAN, """
        SELECT vendorname, round(avg(stock_turnover), 6) AS avg_stock FROM clean
        GROUP BY vendorname HAVING avg(stock_turnover) < 1"""),
    "low_turnover_top10": with_(CLEAN, """
        SELECT vendorname, round(avg(stock_turnover), 6) AS avg_stock FROM good
        WHERE stock_turnover < 1 GROUP BY vendorname ORDER BY avg(stock_turnover), vendorname LIMIT 10"""),
    "brand_performance": with_(BRANDS, f"""
        SELECT description, {rounded(['total_sales', 'avg_profit_margin'])} FROM performance"""),
    "brand_thresholds": with_(BRANDS, f"SELECT {rounded(['low_sales_threshold', 'high_margin_threshold'])} FROM limits"),
    "sales_thresholds": with_(BANDS, f"SELECT {rounded(['top_threshold', 'low_threshold'])} FROM cuts"),
    "brand_categories": with_(BRANDS, f"""
        SELECT description,
               {rounded(['total_sales', 'avg_profit_margin', 'low_sales_threshold', 'high_margin_threshold'])},
               CASE WHEN is_target THEN 'Target Brand' ELSE 'Other Brand' END AS brand_category
        FROM judged"""),
    "target_brands": with_(BRANDS, f"""
        SELECT description, {rounded(['total_sales', 'avg_profit_margin'])} FROM judged WHERE is_target"""),
    "brand_scatter": with_(BRANDS, f"""
        SELECT description,
               {rounded(['total_sales', 'avg_profit_margin', 'low_sales_threshold', 'high_margin_threshold'])}, is_target
        FROM judged WHERE judged.total_sales < 10000"""),
    "top_vendors_sales": top_by("vendorname"),
    "top_brands_sales": top_by("description"),
    "vendor_totals": with_(SHARES, """
        SELECT vendorname, round(bought, 2) AS total_purchase_dollars, round(profit, 2) AS gross_profit,
               round(sold, 2) AS total_sales_dollars
        FROM totals"""),
    "purchase_shares": with_(SHARES, """
        SELECT vendorname, round(bought, 6) AS total_purchase_dollars, round(share, 6) AS purchase_contribution
        FROM shares"""),
    "vendor_pareto": with_(SHARES, f"""
        SELECT vendorname, {label('bought')} AS total_purchase_dollars, {label('profit')} AS gross_profit,
               {label('sold')} AS total_sales_dollars, share AS purchase_contribution,
               round(sum(share) OVER (ORDER BY place ROWS UNBOUNDED PRECEDING), 2)
                 AS cumulative_contribution
        FROM top"""),
    "top10_concentration": with_(SHARES, "SELECT round(sum(share), 2) AS top10_contribution FROM top"),
    "purchase_share_with_rest": with_(SHARES, """
        SELECT vendorname, share AS purchase_contribution FROM top
        UNION ALL SELECT 'Other Vendors', round(100 - sum(share), 2) FROM top"""),
    "frequency_top10": with_(CLEAN, " UNION ALL ".join(
        f"""(SELECT '{c}' AS series, {c} AS value, count(*) AS "rows" FROM good
             GROUP BY {c} ORDER BY 3 DESC, 2 LIMIT 10)""" for c in ("vendorname", "description"))),
    "order_size_classes": with_(SIZES, """
        SELECT order_size, count(*) AS "rows", min(total_purchase_quantity) AS least,
               max(total_purchase_quantity) AS most
        FROM sized GROUP BY order_size"""),
    "order_size_prices": with_(SIZES, """
        SELECT order_size, round(avg(unit_purchase_price), 6) AS avg_unit_price FROM sized GROUP BY order_size"""),
    "unsold_total": with_(CLEAN, """
        SELECT round(sum((total_purchase_quantity - total_sales_quantity) * purchaseprice), 2) AS unsold_value
        FROM good"""),
    "unsold_by_vendor": with_(CLEAN, f"""
        , t AS (SELECT vendorname,
                       round(sum((total_purchase_quantity - total_sales_quantity) * purchaseprice), 2) AS unsold_value
                FROM good GROUP BY vendorname)
        SELECT vendorname, unsold_value, {label('unsold_value')} AS unsold_label
        FROM t ORDER BY unsold_value DESC, vendorname LIMIT 10"""),
    "unsold_all_vendors": with_(CLEAN, """
        SELECT vendorname,
               round(sum((total_purchase_quantity - total_sales_quantity) * purchaseprice), 2) AS unsold_value
        FROM good GROUP BY vendorname"""),
    "describe_numeric": with_(CLEAN, f"""
        SELECT series, count(value) AS "count", round(avg(value), 4) AS mean, round(stddev_samp(value), 4) AS std,
               round(min(value), 4) AS "min", round(quantile_cont(value, 0.25), 4) AS q1,
               round(quantile_cont(value, 0.5), 4) AS median, round(quantile_cont(value, 0.75), 4) AS q3,
               round(max(value), 4) AS "max"
        FROM ({long_('clean')}) GROUP BY series"""),
    "correlation_matrix": correlation("good"),
    "correlation_matrix_all": correlation("clean"),
    "histogram_30": histogram(CLEAN, long_("clean")),
    "histogram_30_profitable": histogram(CLEAN, long_("good")),
    "histogram_margin_bands": histogram(BANDS, "SELECT band || '_margin' AS series, profit_margin AS value FROM banded"),
    "density_curve": density(CLEAN, long_("clean")),
    "density_curve_profitable": density(CLEAN, long_("good")),
    "density_margin_bands": density(BANDS, "SELECT band || '_margin' AS series, profit_margin AS value FROM banded"),
    "box_stats": boxes(CLEAN, long_("clean"), "series"),
    "box_stats_by_order_size": boxes(
        SIZES, long_("sized", ["unit_purchase_price"], "order_size, "), "order_size, series"),
    "margin_ci": with_(BANDS, f"""
        , g AS (SELECT band, count(*) AS n, avg(profit_margin) AS m, stddev_samp(profit_margin) AS s,
                       count(*) - 1 AS v, 1.959963984540054::DOUBLE AS z
                FROM banded GROUP BY band)
        SELECT band, n, round(m, 6) AS mean, round(s, 6) AS std, round(s / sqrt(n), 6) AS std_err,
               round(m - {T_975} * s / sqrt(n), 6) AS lower, round(m + {T_975} * s / sqrt(n), 6) AS upper
        FROM g"""),
    "margin_welch": with_(BANDS, """
        , g AS (
          SELECT count(*) FILTER (band = 'top') AS n_a, avg(profit_margin) FILTER (band = 'top') AS mean_a,
                 var_samp(profit_margin) FILTER (band = 'top') / count(*) FILTER (band = 'top') AS a,
                 count(*) FILTER (band = 'low') AS n_b, avg(profit_margin) FILTER (band = 'low') AS mean_b,
                 var_samp(profit_margin) FILTER (band = 'low') / count(*) FILTER (band = 'low') AS b
          FROM banded),
        w AS (
          SELECT *, (mean_a - mean_b) / sqrt(a + b) AS t,
                 pow(a + b, 2) / (pow(a, 2) / (n_a - 1) + pow(b, 2) / (n_b - 1)) AS v
          FROM g),
        area AS (
          -- Simpson's rule for the density between 0 and |t|
          SELECT sum((CASE WHEN i IN (0, 20000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END)
                     * pow(1 + pow(i * abs(t) / 20000, 2) / v, -(v + 1) / 2)) * abs(t) / 20000 / 3
                 * exp(lgamma((v + 1) / 2) - lgamma(v / 2)) / sqrt(v * pi()) AS half
          FROM w, range(20001) r(i) GROUP BY t, v)
        SELECT n_a, round(mean_a, 6) AS mean_a, n_b, round(mean_b, 6) AS mean_b, round(t, 6) AS t_stat,
               round(v, 6) AS df, round(greatest(1 - 2 * half, 0), 6) AS p_value, 1 - 2 * half < 0.05 AS reject
        FROM w, area"""),
    "csv_load_audit": with_(RAW, """
        SELECT 'Purchases.CSV' AS file, 'purchases' AS table_name, count(*) AS "rows", 'loaded' AS status FROM purchases
        UNION ALL SELECT 'Purchase Prices.CSV', 'purchase_prices', count(*), 'loaded' FROM purchase_prices
        UNION ALL SELECT 'Vendor Invoice.CSV', 'vendor_invoice', count(*), 'loaded' FROM vendor_invoice
        UNION ALL SELECT 'Sales.CSV', 'sales', count(*), 'loaded' FROM sales"""),
}
ORACLE_SQL["csv_ingest_roundtrip"] = ORACLE_SQL["vendor_summary"]
ORACLE_SQL["clustered_vendor_rows"] = ORACLE_SQL["vendor_rows"]
ORACLE_SQL["repeated_order_lines"] = """
    SELECT l_orderkey, l_partkey, count(*) AS rows FROM lineitem GROUP BY l_orderkey, l_partkey HAVING count(*) > 1"""
ORACLE_SQL["incremental_vendor_summary"] = ORACLE_SQL["vendor_summary"]
ORACLE_SQL["csv_chunked_sales"] = ORACLE_SQL["sales_summary"]
