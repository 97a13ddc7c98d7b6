"""Source tables in the shape of the ERP, derived from the given star schema.

Each text is plain SQL that both Spark and the oracle read; names in braces are
the tables it is built on. A short ``VALUES`` list next to a table repeats its rows;
Spark does that row by row (``LATERAL VIEW``), without a join. They stand in for the tables a user would have, so
that every plan runs over whole tables that grow with the data.
"""

VIEWS: dict[str, str] = {}

# --- orders ---------------------------------------------------------------

VIEWS["vbak"] = """
SELECT lpad(CAST(o_orderkey AS STRING), 10, '0') AS vbeln,
  CASE o_orderkey % 16 WHEN 0 THEN 'ZKL' WHEN 1 THEN 'ZKA' WHEN 2 THEN 'ZBGR'
    WHEN 3 THEN 'ZREB' WHEN 4 THEN 'Z23' WHEN 5 THEN 'ZXX' ELSE 'ZOR' END AS auart,
  CASE o_orderkey % 7 WHEN 0 THEN 'H' WHEN 1 THEN 'K' WHEN 2 THEN 'L' WHEN 3 THEN 'B'
    ELSE 'C' END AS vbtyp,
  CASE WHEN o_orderkey % 11 = 0 THEN '01' WHEN o_orderkey % 13 = 0 THEN ' ' END AS lifsk,
  CASE WHEN o_orderkey % 17 = 0 THEN 'C' WHEN o_orderkey % 19 = 0 THEN 'B' ELSE 'A' END AS cmgst,
  CASE WHEN o_orderkey % 23 = 0 THEN 'C' WHEN o_orderkey % 3 = 0 THEN 'A' END AS faksk,
  CASE WHEN o_custkey % 4 <> 0 THEN 'Z0' || CAST(o_custkey % 9 AS STRING) END AS augru,
  CAST(o_orderdate AS DATE) AS audat,
  CAST(o_orderdate AS DATE) + CAST(o_orderkey % 60 AS INT) AS vdatu,
  CASE o_custkey % 8 WHEN 0 THEN '62T0' WHEN 1 THEN '6230' WHEN 2 THEN '66J0'
    WHEN 3 THEN '61A0' ELSE '60B0' END AS vkorg,
  'H' || lpad(CAST(o_custkey % 12 AS STRING), 3, '0') AS vkbur,
  CASE WHEN o_custkey % 3 = 0 THEN '10' ELSE '20' END AS vtweg,
  CASE WHEN o_orderkey % 29 = 0 THEN 'SE' WHEN o_orderkey % 5 = 0 THEN 'AC' ELSE 'FG' END AS spart,
  substring(o_orderpriority, 1, 1) AS bsark,
  'U' || CAST(o_custkey % 20 AS STRING) AS ernam,
  'REF' || CAST(o_orderkey AS STRING) AS bstnk,
  CASE WHEN o_orderkey % 6 = 0 THEN 'pex' END AS submi,
  CASE WHEN o_orderkey % 2 = 0 THEN '01' ELSE '02' END AS vsbed,
  lpad(CAST(o_orderkey AS STRING), 10, '0') AS knumv
FROM {orders}
"""

VIEWS["vbap"] = """
SELECT lpad(CAST(l_orderkey AS STRING), 10, '0') AS vbeln,
  lpad(CAST(l_linenumber * 10 AS STRING), 6, '0') AS posnr,
  sum(l_quantity) AS kwmeng,
  lpad(CAST(max(l_partkey) AS STRING), 8, '0') AS matnr,
  CASE WHEN max(l_partkey) % 31 = 0 THEN 'R1' END AS abgru,
  'W' || CAST(max(l_suppkey) % 4 AS STRING) AS lgort,
  'P' || CAST(max(l_suppkey) % 3 AS STRING) AS werks,
  'S' || CAST(max(l_suppkey) % 5 AS STRING) AS vstel,
  'R' || CAST(max(l_partkey) % 30 AS STRING) AS route,
  CASE WHEN max(l_suppkey) % 17 = 0 THEN 'ZTAX' ELSE 'TAN' END AS pstyv,
  'A' || CAST(max(l_partkey) % 28 AS STRING) AS zzlarea,
  CASE WHEN max(l_partkey) % 3 = 0 THEN CAST(max(l_shipdate) AS DATE) END AS zzso_bookdate,
  CASE WHEN max(l_partkey) % 2 = 0 THEN CAST(min(l_shipdate) AS DATE) END AS zzso_pbsdate
FROM {lineitem} GROUP BY l_orderkey, l_linenumber
"""

VIEWS["lips"] = """
SELECT '8' || lpad(CAST(l_orderkey AS STRING), 8, '0') || l_linestatus AS vbeln,
  lpad(CAST(l_linenumber * 10 AS STRING), 6, '0') AS posnr,
  lpad(CAST(l_orderkey AS STRING), 10, '0') AS vgbel,
  lpad(CAST(l_linenumber * 10 AS STRING), 6, '0') AS vgpos,
  sum(l_quantity) AS lfimg,
  lpad(CAST(max(l_partkey) AS STRING), 8, '0') AS matnr,
  'A' || CAST(max(l_partkey) % 28 AS STRING) AS zzlarea,
  'H' || lpad(CAST(max(l_suppkey) % 12 AS STRING), 3, '0') AS vkbur,
  'W' || CAST(max(l_suppkey) % 4 AS STRING) AS lgort
FROM {lineitem} WHERE l_returnflag <> 'N'
GROUP BY l_orderkey, l_linenumber, l_linestatus
"""

VIEWS["likp"] = """
SELECT '8' || lpad(CAST(l_orderkey AS STRING), 8, '0') || l_linestatus AS vbeln,
  CASE WHEN l_linestatus = 'F' THEN max(CAST(l_shipdate AS DATE)) END AS wadat_ist,
  CASE WHEN l_orderkey % 3 <> 0 THEN max(CAST(l_shipdate AS DATE)) + 2 END AS zzdate_slot,
  'J' AS vbtyp, 'LF' AS lfart,
  'R' || CAST(l_orderkey % 30 AS STRING) AS route,
  min(CAST(l_shipdate AS DATE)) AS kodat,
  max(CAST(l_shipdate AS DATE)) + 5 AS lfdat,
  CASE WHEN l_orderkey % 3 <> 0 THEN 'BOOKED' END AS zzbook_slot
FROM {lineitem} WHERE l_returnflag <> 'N'
GROUP BY l_orderkey, l_linestatus
"""

VIEWS["vbbe"] = """
SELECT lpad(CAST(l_orderkey AS STRING), 10, '0') AS vbeln,
  lpad(CAST(l_linenumber * 10 AS STRING), 6, '0') AS posnr,
  lpad(CAST(1 + l_suppkey % 2 AS STRING), 4, '0') AS etenr,
  'W' || CAST(l_partkey % 2 AS STRING) AS lgort,
  CASE WHEN l_partkey % 5 = 0 THEN 0.0e0 ELSE CAST(floor(l_quantity / 2) AS DOUBLE) END AS vmeng
FROM {lineitem} WHERE l_linestatus = 'O'
"""

VIEWS["vbep"] = """
SELECT lpad(CAST(l_orderkey AS STRING), 10, '0') AS vbeln,
  lpad(CAST(l_linenumber * 10 AS STRING), 6, '0') AS posnr,
  lpad(CAST(1 + l_suppkey % 2 AS STRING), 4, '0') AS etenr,
  max(CAST(l_shipdate AS DATE)) AS edatu,
  CASE WHEN max(l_partkey) % 2 = 0 THEN '080000' ELSE '140000' END AS ezeit,
  min(CAST(l_shipdate AS DATE)) AS tddat,
  CASE WHEN max(l_partkey) % 4 = 0 THEN 0.0e0 ELSE sum(l_quantity) END AS bmeng
FROM {lineitem} GROUP BY l_orderkey, l_linenumber, 1 + l_suppkey % 2
"""

VIEWS["vbpa"] = """
SELECT lpad(CAST(o_orderkey AS STRING), 10, '0') AS vbeln, '000000' AS posnr, role AS parvw,
  lpad(CAST(o_custkey + place AS STRING), 8, '0') AS kunnr
FROM {orders}, (VALUES ('SP', 0), ('BP', 1), ('ZC', 2), ('ZD', 3), ('ZE', 4), ('YB', 5),
  ('YD', 6), ('YA', 7), ('YC', 8)) AS roles(role, place)
WHERE NOT (o_orderstatus = 'P' AND place IN (1, 3, 6))
UNION ALL
SELECT vbeln, posnr, role AS parvw,
  CASE WHEN CAST(matnr AS INT) % 5 = 0 THEN ' ' ELSE '9' || substring(matnr, 2, 7) END AS kunnr
FROM {vbap}, (VALUES ('SP'), ('BP'), ('YD')) AS roles(role)
WHERE lgort = 'W1' OR (lgort = 'W2' AND role = 'BP')
"""

VIEWS["tvak"] = """
SELECT DISTINCT auart, vbtyp FROM (
  SELECT CASE n_nationkey % 7 WHEN 0 THEN 'ZKL' WHEN 1 THEN 'ZKA' WHEN 2 THEN 'ZBGR'
      WHEN 3 THEN 'ZREB' WHEN 4 THEN 'ZOR' WHEN 5 THEN 'ZYY' ELSE 'ZZZ' END AS auart,
    CASE n_nationkey % 7 WHEN 0 THEN 'C' WHEN 1 THEN 'C' WHEN 2 THEN 'C' WHEN 3 THEN 'H'
      WHEN 4 THEN 'C' WHEN 5 THEN 'K' ELSE 'X' END AS vbtyp
  FROM {nation}) t
"""

# --- texts ----------------------------------------------------------------

VIEWS["tvakt"] = """
SELECT DISTINCT spras, auart, CASE spras WHEN 'EN' THEN 'Order ' ELSE 'Auftrag ' END || auart AS bezei
FROM {tvak}, (VALUES ('EN'), ('DE')) AS languages(spras)
"""

VIEWS["return_reasons"] = """
SELECT DISTINCT 'Z0' || CAST(n_nationkey % 8 AS STRING) AS order_reason,
  CAST((n_nationkey % 8) * 10 + 10 AS STRING) AS motive,
  'C' || CAST(n_nationkey % 8 % 3 AS STRING) AS cause,
  CASE WHEN n_nationkey % 8 <> 5 THEN 'Reason ' || CAST(n_nationkey % 8 AS STRING) END AS motive_descr
FROM {nation}
"""

VIEWS["block_texts"] = """
SELECT DISTINCT lpad(CAST(n_regionkey AS STRING), 2, '0') AS lifsk,
  'Block ' || CAST(n_regionkey AS STRING) AS text
FROM {nation}
"""

VIEWS["category_texts"] = """
SELECT DISTINCT CASE n_nationkey % 5 WHEN 0 THEN 'C' WHEN 1 THEN 'H' WHEN 2 THEN 'K'
    WHEN 3 THEN 'L' ELSE 'J' END AS vbtyp,
  'Category ' || CAST(n_nationkey % 5 AS STRING) AS text
FROM {nation}
"""

VIEWS["source_texts"] = """
SELECT DISTINCT substring(o_orderpriority, 1, 1) AS bsark, o_orderpriority AS text
FROM {orders} WHERE o_orderpriority <> '5-LOW'
"""

VIEWS["areas"] = """
SELECT 'A' || CAST(n_nationkey AS STRING) AS zzlarea, n_name AS text FROM {nation}
"""

VIEWS["routes"] = """
SELECT 'R' || CAST(n_nationkey AS STRING) AS route,
  CASE WHEN n_nationkey % 6 <> 0 THEN 'Route ' || n_name END AS text
FROM {nation}
"""

# --- companies, markets, rates ------------------------------------------------

VIEWS["company_currency"] = """
SELECT DISTINCT company, currency FROM (SELECT
    CASE n_nationkey % 4 WHEN 0 THEN '66J0' WHEN 1 THEN '61A0' WHEN 2 THEN '62T0' END AS company,
    CASE n_nationkey % 4 WHEN 0 THEN 'GBP' WHEN 1 THEN 'PLN' ELSE 'CZK' END AS currency
  FROM {nation}) c WHERE company IS NOT NULL
"""

VIEWS["budget_fx"] = """
SELECT DISTINCT currency, CAST(year(o_orderdate) AS INT) AS year,
  CASE currency WHEN 'GBP' THEN 0.5e0 WHEN 'PLN' THEN 4.0e0 ELSE 1.0e0 END AS beg_balance
FROM {orders}, (VALUES ('GBP'), ('PLN'), ('EUR')) AS currencies(currency)
WHERE currency <> 'PLN' OR year(o_orderdate) <> 1997
"""

VIEWS["yearly_rates"] = """
SELECT currency || '|' || CAST(year AS STRING) AS key_currency, 1 / beg_balance AS exchange_value
FROM {budget_fx}
"""

VIEWS["market_raw"] = """
SELECT DISTINCT
  CASE c_custkey % 4 WHEN 0 THEN '66-J0' WHEN 1 THEN '61A0 ' WHEN 2 THEN '60B0' ELSE '60B0' END AS sales_organization,
  'H' || lpad(CAST(c_custkey % 12 AS STRING), 3, '0') AS sales_office,
  CASE c_custkey % 4 WHEN 0 THEN '80' WHEN 1 THEN '7' WHEN 2 THEN '46' ELSE '46' END AS company,
  CAST(c_custkey % 12 AS STRING) AS network,
  'R_' || CAST(c_custkey % 12 % 3 AS STRING) AS responsible_code1,
  'Region ' || CAST(c_custkey % 12 % 3 AS STRING) AS responsible_descr1,
  'S_' || CAST(c_custkey % 12 % 5 AS STRING) AS responsible_code3,
  'Subcluster ' || CAST(c_custkey % 12 % 5 AS STRING) AS responsible_descr3,
  'C_' || CAST(c_custkey % 12 % 4 AS STRING) AS responsible_code,
  'Cluster ' || CAST(c_custkey % 12 % 4 AS STRING) AS responsible_descr,
  'M_' || CAST(c_custkey % 12 AS STRING) AS market_budget,
  'Market ' || CAST(c_custkey % 12 AS STRING) AS market_budget_descr
FROM {customer}
"""

VIEWS["line_offices"] = """
SELECT DISTINCT 'H' || lpad(CAST(s_suppkey % 3 * 4 AS STRING), 3, '0') AS sales_office,
  lpad(CAST(s_suppkey % 5 AS STRING), 2, '0') AS line,
  CAST(s_suppkey % 3 * 4 + s_suppkey % 5 % 2 * 4 AS STRING) AS network
FROM {supplier}
"""

VIEWS["product_lines"] = """
SELECT lpad(CAST(p_partkey AS STRING), 8, '0') AS product_code,
  lpad(CAST(p_size % 6 AS STRING), 2, '0') AS line_code
FROM {part} WHERE p_size <= 45
"""

VIEWS["market_rules"] = """
SELECT DISTINCT sales_organization, sales_office, line,
  company, network, market FROM (
  SELECT '66J0' AS sales_organization, sales_office, line, '80' AS company, network,
    'M' || network AS market FROM {line_offices}
  UNION ALL
  SELECT CASE c_custkey % 2 WHEN 0 THEN '61A0' ELSE '60B0' END,
    'H' || lpad(CAST(c_custkey % 11 AS STRING), 3, '0'), CAST(NULL AS STRING),
    CASE c_custkey % 2 WHEN 0 THEN '07' ELSE '46' END,
    CAST(c_custkey % 11 AS STRING), 'M' || CAST(c_custkey % 11 AS STRING)
  FROM {customer}) t
"""

VIEWS["tcurr"] = """
SELECT max(CAST(o_orderdate AS DATE)) AS exchange_date,
  CASE WHEN max(o_custkey) % 5 = 0 THEN -2.0e0 WHEN max(o_custkey) % 7 = 0 THEN NULL
    ELSE CAST(1 + max(o_custkey) % 50 AS DOUBLE) END AS exchange_value,
  CASE WHEN o_custkey % 9 = 8 THEN 'M' ELSE 'EURX' END AS type,
  'C' || CAST(o_custkey % 9 AS STRING) AS currency,
  CASE WHEN o_custkey % 9 = 7 THEN 'USD' ELSE 'EUR' END AS target
FROM {orders} GROUP BY o_custkey % 9, year(o_orderdate), month(o_orderdate)
"""

VIEWS["cutoffs"] = """
SELECT max(CAST(o_orderdate AS DATE)) - 3 AS cutoff_date,
  min(CAST(date_trunc('month', o_orderdate) AS DATE)) AS month
FROM {orders} GROUP BY year(o_orderdate), month(o_orderdate)
"""

# --- prices ---------------------------------------------------------------

VIEWS["lines"] = """
SELECT l_orderkey, l_linenumber, max(l_partkey) AS part, max(l_suppkey) AS supp,
  sum(l_quantity) AS qty, max(l_extendedprice) AS price, max(l_discount) AS disc,
  max(l_tax) AS tax
FROM {lineitem} GROUP BY l_orderkey, l_linenumber
"""

VIEWS["prcd"] = """
SELECT lpad(CAST(l_orderkey AS STRING), 10, '0') AS knumv,
  lpad(CAST(l_linenumber * 10 AS STRING), 6, '0') AS kposn,
  lpad(CAST(place AS STRING), 3, '0') AS stunr, '01' AS zaehk, kschl,
  CASE kschl WHEN 'MWST' THEN price * tax WHEN 'ZNSV' THEN price * (1 - disc)
    WHEN 'ZTTV' THEN price WHEN 'ZCDS' THEN -qty WHEN 'ZNET' THEN price * 2
    WHEN 'PB00' THEN qty * (part % 2) WHEN 'ZWEE' THEN qty * 0.25e0 WHEN 'ZFEE' THEN qty * 0.5e0
    WHEN 'ZGSV' THEN price WHEN 'RENT' THEN qty WHEN 'PPNT' THEN qty ELSE qty * 3 END AS kwert,
  tax * 100 AS kbetr,
  CASE supp % 4 WHEN 0 THEN -2.0e0 WHEN 1 THEN 2.0e0 ELSE 1.0e0 END AS kkurs,
  CASE kschl WHEN 'MWST' THEN 'V' || CAST(supp % 3 AS STRING) END AS mwsk1
FROM {lines}, (VALUES ('MWST', 1, 0, 999), ('ZNSV', 2, 3, 999), ('ZTTV', 3, 0, 46),
  ('ZCDS', 4, 20, 40), ('ZNET', 5, 0, 35), ('PB00', 6, 10, 30), ('ZWEE', 7, 5, 25),
  ('ZFEE', 8, 15, 999), ('ZGSV', 9, 0, 999), ('RENT', 10, 8, 20), ('PPNT', 11, 8, 20),
  ('ZFR2', 12, 30, 45), ('ZXXX', 13, 0, 20)) AS codes(kschl, place, low, high)
WHERE qty BETWEEN low AND high
"""

VIEWS["prcd_source"] = """
SELECT knumv, kposn, stunr, kschl, source, kwert + source AS kwert, kkurs,
  lpad(CAST(1 + (CAST(kposn AS INT) + source * source) % 3 AS STRING), 2, '0') AS zaehk,
  CAST('2024-01-01' AS DATE) + CAST((CAST(kposn AS INT) / 10 + copy * 5) AS INT) AS deltadate
FROM {prcd}, (VALUES (1), (2), (3)) AS sources(source), (VALUES (0), (1)) AS copies(copy)
WHERE (source = 2 OR (source = 1 AND kkurs < 2) OR (source = 3 AND kbetr > 2))
  AND (copy = 0 OR (source = 2 AND kschl IN ('ZNSV', 'ZTTV')))
"""

# --- deliveries and invoices -------------------------------------------------

VIEWS["vbrk"] = """
SELECT '9' || substring(vbeln, 2, 8) AS vbeln,
  CASE CAST(substring(vbeln, 2, 8) AS INT) % 9 WHEN 0 THEN 'ZRE' WHEN 1 THEN 'ZG2'
    WHEN 2 THEN 'ZL2' WHEN 3 THEN 'ZS1' WHEN 4 THEN 'ZXX' WHEN 5 THEN 'ZL3' ELSE 'ZF2' END AS fkart,
  wadat_ist + 3 AS fkdat,
  CASE WHEN CAST(substring(vbeln, 2, 8) AS INT) % 10 = 0 THEN 'X' END AS fksto,
  CASE WHEN CAST(substring(vbeln, 2, 8) AS INT) % 9 = 3
    THEN '9' || lpad(CAST(CAST(substring(vbeln, 2, 8) AS INT) - 2 AS STRING), 8, '0')
    WHEN CAST(substring(vbeln, 2, 8) AS INT) % 2 = 0 THEN '' END AS sfakn,
  CASE WHEN CAST(substring(vbeln, 2, 8) AS INT) % 12 = 0 THEN 'A' ELSE 'C' END AS buchk,
  'B' || substring(vbeln, 2, 8) AS belnr, 'M' AS vbtyp,
  CASE CAST(substring(vbeln, 2, 8) AS INT) % 5 WHEN 0 THEN '62T0' WHEN 1 THEN '66J0'
    WHEN 2 THEN '61A0' ELSE '60B0' END AS vkorg,
  '10' AS vtweg, 'FG' AS spart, 1.0e0 AS kurrf,
  'T' || CAST(CAST(substring(vbeln, 2, 8) AS INT) % 30 AS STRING) AS zterm,
  CASE WHEN CAST(substring(vbeln, 2, 8) AS INT) % 3 = 0 THEN 'IT' ELSE 'GB' END AS land1,
  '0' || '9' || substring(vbeln, 2, 8) AS knumv
FROM {likp} WHERE wadat_ist IS NOT NULL
"""

VIEWS["corrected_rate_texts"] = """
SELECT vkorg AS company_code, vbeln AS billing_document,
  CASE CAST(substring(vbeln, 2, 8) AS INT) % 3 WHEN 0 THEN '/1,25' WHEN 1 THEN '2,5' ELSE '0,8' END AS exchange_rate_text
FROM {vbrk} WHERE CAST(substring(vbeln, 2, 8) AS INT) % 4 < 2
"""

VIEWS["vbrp"] = """
SELECT '9' || substring(vbeln, 2, 8) AS vbeln, posnr,
  CASE WHEN CAST(matnr AS INT) % 3 = 0 THEN posnr END AS pospa,
  lfimg * 10 AS netwr, matnr, vbeln AS vgbel, posnr AS vgpos, vgbel AS aubel, vgpos AS aupos,
  CAST(floor(lfimg * (CAST(matnr AS INT) % 3) / 2) AS DOUBLE) AS fkimg,
  CASE WHEN CAST(matnr AS INT) % 2 = 0 THEN vkbur WHEN CAST(matnr AS INT) % 5 = 0 THEN ' ' END AS vkbur
FROM {lips} WHERE substring(vbeln, 10, 1) = 'F'
"""

VIEWS["prcd_invoice"] = """
SELECT '0' || '9' || substring(knumv, 3, 8) AS knumv, kposn, stunr, zaehk, kschl, kwert, kbetr,
  kkurs, mwsk1
FROM {prcd}
"""

VIEWS["vbfa"] = """
SELECT vbeln AS vbelv, '7' || substring(vbeln, 2, 9) AS vbeln, 'Q' AS vbtyp_n, 'J' AS vbtyp_v,
  posnr AS posnn FROM {lips}
UNION ALL
SELECT '9' || lpad(CAST(CAST(substring(vbeln, 2, 8) AS INT) - 1 AS STRING), 8, '0') AS vbelv,
  vbeln, 'O' AS vbtyp_n, 'M' AS vbtyp_v, posnr AS posnn
FROM {vbrp} WHERE vbeln IN (SELECT vbeln FROM {vbrk} WHERE fkart = 'ZG2')
"""

VIEWS["delivery_kinds"] = """
SELECT DISTINCT 'LF' AS lfart, 'Outbound ' || r_name AS text FROM {region} WHERE r_regionkey = 0
"""

VIEWS["vttp"] = """
SELECT 'T' || CAST(CAST(substring(vbeln, 2, 8) AS INT) % 97 AS STRING) AS tknum, vbeln FROM {likp}
UNION ALL
SELECT 'T' || CAST(CAST(substring(vbeln, 2, 8) AS INT) % 89 AS STRING), vbeln
FROM {likp} WHERE zzbook_slot IS NULL
"""

VIEWS["vttk"] = """
SELECT DISTINCT tknum,
  CASE WHEN CAST(substring(tknum, 2, 3) AS INT) % 6 <> 5
    THEN lpad(CAST(CAST(substring(tknum, 2, 3) AS INT) % 6 AS STRING), 2, '0') END AS vsart
FROM {vttp}
"""

VIEWS["shipping_texts"] = """
SELECT lpad(CAST(r_regionkey AS STRING), 2, '0') AS vsart, 'By ' || r_name AS text
FROM {region} WHERE r_name <> 'EUROPE'
"""

VIEWS["t052"] = """
SELECT 'T' || CAST(n_nationkey AS STRING) AS zterm,
  CASE WHEN (n_nationkey + copy) % 4 <> 0 THEN 'P' || CAST((n_nationkey + copy) % 3 AS STRING) END AS zlsch,
  CAST(n_regionkey + copy AS DOUBLE) AS zprz1
FROM {nation}, (VALUES (0), (1)) AS copies(copy)
"""

VIEWS["t042"] = """
SELECT DISTINCT spras, land1, 'P' || CAST(r_regionkey % 3 AS STRING) AS zlsch,
  'Pay ' || land1 || CAST(r_regionkey % 3 AS STRING) || spras AS text2
FROM {region}, (VALUES ('E'), ('D')) AS l(spras), (VALUES ('IT'), ('GB')) AS c(land1)
"""

VIEWS["payment_texts"] = """
SELECT 'T' || CAST(n_nationkey AS STRING) AS zterm, 'Terms ' || n_name AS text
FROM {nation} WHERE n_regionkey <> 3
"""

VIEWS["customer_offices"] = """
SELECT DISTINCT kunnr || '|' || vkorg || '|10|FG' AS key_knvv,
  'K' || substring(kunnr, 6, 3) AS vkbur
FROM (SELECT DISTINCT kunnr FROM {vbpa}) p, (VALUES ('66J0'), ('61A0')) AS o(vkorg)
WHERE kunnr <> ' '
"""

# --- change log ------------------------------------------------------------

VIEWS["cdhdr"] = """
SELECT 'VERKBELEG' AS objectclas, lpad(CAST(user_id AS STRING), 10, '0') AS objectid,
  lpad(CAST(event_id AS STRING), 10, '0') AS changenr,
  CASE WHEN event_id % 13 = 0 THEN ' ' ELSE 'U' || CAST(event_id % 17 AS STRING) END AS username,
  CAST(ts AS DATE) AS udate, '120000' AS utime
FROM {events}
"""

VIEWS["cdpos"] = """
SELECT CASE WHEN event_type = 'signup' AND event_id % 2 = 0 THEN 'EINKBELEG' ELSE 'VERKBELEG' END AS objectclas,
  lpad(CAST(user_id AS STRING), 10, '0') AS objectid,
  lpad(CAST(event_id AS STRING), 10, '0') AS changenr,
  CASE WHEN event_type = 'view' THEN 'VBAP' ELSE 'VBAK' END AS tabname,
  CASE event_type WHEN 'click' THEN 'LIFSK' WHEN 'error' THEN 'CMGST' WHEN 'purchase' THEN 'CMGST'
    ELSE 'NETWR' END AS fname,
  CASE event_type WHEN 'click' THEN CASE WHEN event_id % 3 = 0 THEN ' ' ELSE '01' END
    ELSE CASE event_id % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'B' ELSE 'C' END END AS value_new,
  CASE event_type WHEN 'click' THEN CASE WHEN event_id % 3 = 0 THEN '01' ELSE '' END
    ELSE CASE event_id % 4 WHEN 0 THEN 'B' WHEN 1 THEN 'A' ELSE 'D' END END AS value_old
FROM {events}
"""

# --- costs and budget ---------------------------------------------------------

VIEWS["transfer_price"] = """
SELECT 'EUR' AS currency, company, network, lpad(CAST(p_partkey AS STRING), 8, '0') AS product_code, year,
  CASE WHEN (p_partkey + year) % 3 <> 0 THEN CAST(p_size + year % 7 AS DOUBLE) END AS tp_commerciale,
  CASE WHEN (p_partkey + year) % 4 <> 0 THEN CAST(p_size + year % 5 AS DOUBLE) END AS tp_itcy
FROM {part}, (VALUES (1995), (1996), (1997), (1998), (1999), (2000), (2001)) AS y(year), (VALUES ('80', '4'), ('07', '2'), ('46', '3')) AS u(company, network)
WHERE year <= 1995 + p_size / 8
"""

VIEWS["freight"] = """
SELECT company, network, lpad(CAST(p_partkey AS STRING), 8, '0') AS product_code, year,
  CASE WHEN (p_partkey + year) % 3 <> 1 THEN CAST(p_size % 4 + 1 AS DOUBLE) END AS freight_in_eur,
  CASE WHEN (p_partkey + year) % 5 <> 2 THEN CAST(p_size % 3 AS DOUBLE) END AS transport_cost_infra_eur
FROM {part}, (VALUES (1995), (1996), (1997), (1998), (1999), (2000), (2001)) AS y(year), (VALUES ('80', '4'), ('07', '2'), ('46', '3')) AS u(company, network)
WHERE year <> 1998
"""

VIEWS["commercial"] = """
SELECT 'EUR' AS currency, lpad(CAST(p_partkey AS STRING), 8, '0') AS product_code,
  CAST(year AS STRING) || quarter AS year_quarter,
  CASE WHEN (p_partkey + year) % 4 <> 0 THEN CAST(p_size + year % 3 AS DOUBLE) END AS std_prod_cost_commercial
FROM {part}, (VALUES (1995), (1996), (1997), (1998), (1999), (2000), (2001)) AS y(year), (VALUES ('Q1'), ('Q3')) AS q(quarter)
WHERE p_type <> 'PROMO'
"""

VIEWS["indefinite"] = """
SELECT CASE WHEN p_partkey % 9 = 0 THEN 'USD' ELSE 'EUR' END AS currency,
  lpad(CAST(p_partkey AS STRING), 8, '0') AS product_code, year,
  CASE WHEN (p_partkey + year) % 3 <> 0 THEN CAST(p_size + 10 AS DOUBLE) END AS std_prod_cost_no_tca,
  CASE WHEN (p_partkey + year) % 2 = 0 THEN CAST(p_size % 5 AS DOUBLE) END AS tca
FROM {part}, (VALUES (1995), (1996), (1997), (1998), (1999), (2000), (2001)) AS y(year) WHERE year IN (1996, 1998, 2000)
"""

VIEWS["company_network"] = """
SELECT lpad(CAST(n_nationkey % 5 AS STRING), 2, '0') AS company,
  lpad(CAST(n_nationkey AS STRING), 2, '0') AS network,
  CASE n_nationkey % 6 WHEN 0 THEN '62T0' WHEN 1 THEN '66J0' ELSE '60B0' END AS sales_organization,
  'H' || lpad(CAST(n_nationkey AS STRING), 3, '0') AS sales_office
FROM {nation}
"""

VIEWS["budget_export"] = """
SELECT account, CAST(p_partkey % 5 AS STRING) || '_' || CAST(p_partkey % 25 AS STRING) AS organization,
  'Export_QTY' AS client, currency, lpad(CAST(p_partkey AS STRING), 8, '0') AS product_code,
  'FY' || substring(CAST(year AS STRING), 3, 2) AS years,
  CAST(p_size AS DOUBLE) AS Jan, p_size + 1.0e0 AS Feb, p_size + 2.0e0 AS Mar, p_size + 3.0e0 AS Apr,
  p_size + 4.0e0 AS May, p_size + 5.0e0 AS Jun, p_size + 6.0e0 AS Jul, p_size + 7.0e0 AS Aug,
  p_size + 8.0e0 AS Sep, p_size + 9.0e0 AS Oct, CASE WHEN p_size % 2 = 0 THEN 10.0e0 END AS Nov,
  p_size + 11.0e0 AS Dec,
  CASE WHEN (p_partkey + year) % 4 = 0 THEN CAST(year AS STRING) || '0301' ELSE CAST(year AS STRING) || '0601' END AS ingestion_date,
  'f' || CAST(year AS STRING) AS input_file_name
FROM {part}, (VALUES (1997), (1998), (1999)) AS y(year), (VALUES ('2000_ASO_CALC', 'Local'), ('1095_LFG', 'EUR'), ('2090_LFG', 'Local'),
  ('A_NSV_MEDIO', 'EUR'), ('A_NSV_MEDIO', 'Local'), ('OTHER', 'EUR')) AS a(account, currency)
WHERE NOT (account = '1095_LFG' AND p_size > 40)
"""

VIEWS["cost_export"] = """
SELECT account, CAST(p_partkey % 5 AS STRING) || '_' || CAST(p_partkey % 25 AS STRING) AS organization,
  'X_' || CAST((p_partkey + 1) % 5 AS STRING) || '_' || CAST((p_partkey + 1) % 25 AS STRING) AS client,
  'EUR' AS currency, lpad(CAST(p_partkey AS STRING), 8, '0') AS product_code,
  'FY' || substring(CAST(year AS STRING), 3, 2) AS years,
  CASE WHEN (p_partkey + place) % 7 <> 0 THEN CAST(p_size + place AS DOUBLE) END AS beg_balance,
  CASE WHEN (p_partkey + year) % 3 = 0 THEN CAST(year AS STRING) || '0301' ELSE CAST(year AS STRING) || '0601' END AS ingestion_date,
  '/in/' || CAST(year AS STRING) || '/Q' || CAST(1 + year % 4 AS STRING) || '/part.parquet' AS input_file_name
FROM {part}, (VALUES (1995), (1996), (1997), (1998), (1999), (2000), (2001)) AS y(year), (VALUES ('A_CDC_1', 1), ('A_CDC_2', 2), ('A_CDC_3', 3), ('A_TRC_TOT', 4),
  ('A_HANIC', 5), ('A_NAHNW', 6), ('TP_Commerciale_Definitive', 7), ('TP_Commerciale_Indicative', 8),
  ('TP_ITCY_Indicative', 9), ('STD_Prod_Cost_No_TCA_Definitive', 10),
  ('STD_Prod_Cost_No_TCA_Indicative', 11), ('TCA_Indicative', 12)) AS a(account, place)
WHERE p_size > place * 3
"""

VIEWS["forecast_export"] = """
SELECT pl_destination AS account, currency, 'SKU_' || lpad(CAST(p_partkey AS STRING), 8, '0') AS material_sku,
  CASE WHEN p_partkey % 4 = 0 THEN 'Brd_None' ELSE 'Brd_' || p_brand END AS product_brand,
  'SO_H' || CAST(p_partkey % 12 AS STRING) AS sales_offices,
  CASE WHEN p_partkey % 3 = 0 THEN 'None' ELSE 'SrcPlant_P' || CAST(p_partkey % 3 AS STRING) END AS source_plant,
  'FCT' AS scenario, 'FY' || substring(CAST(year AS STRING), 3, 2) AS years,
  CAST(p_size AS DOUBLE) AS Jan, p_size + 1.0e0 AS Feb, p_size + 2.0e0 AS Mar, p_size + 3.0e0 AS Apr,
  p_size + 4.0e0 AS May, p_size + 5.0e0 AS Jun, p_size + 6.0e0 AS Jul, p_size + 7.0e0 AS Aug,
  p_size + 8.0e0 AS Sep, p_size + 9.0e0 AS Oct, CASE WHEN p_size % 2 = 0 THEN 10.0e0 END AS Nov,
  p_size + 11.0e0 AS Dec,
  CAST(year AS STRING) || CASE WHEN p_partkey % 2 = 0 THEN '0315' ELSE '0615' END AS ingestion_date,
  'f' || CAST(year AS STRING) AS input_file_name
FROM {part}, (VALUES (1997), (1998), (1999)) AS y(year), (VALUES ('2090_CALC', 'Local'), ('Dest_1095', 'EUR'), ('Dest_2000', 'Local'),
  ('NSV', 'Local')) AS a(pl_destination, currency)
"""

# --- measure bases: one row per line item ---------------------------------------

VIEWS["sales_lines"] = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount,
  l_tax, l_returnflag, l_linestatus, CAST(l_shipdate AS DATE) AS ship_date,
  o_custkey, CAST(o_orderdate AS DATE) AS order_date, o_orderstatus
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey
"""

VIEWS["measure_base"] = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, order_date, ship_date,
  CASE l_orderkey % 9 WHEN 0 THEN NULL WHEN 1 THEN 5 WHEN 2 THEN 6 WHEN 3 THEN 7 WHEN 4 THEN 12
    ELSE 4 END AS doc_type_code,
  CASE l_partkey % 6 WHEN 0 THEN 'ZKA' WHEN 1 THEN 'ZKB' WHEN 2 THEN 'ZREB' WHEN 3 THEN 'ZREG'
    ELSE 'ZOR' END AS order_type_code,
  CASE l_orderkey % 3 WHEN 0 THEN 'H' ELSE 'C' END AS category,
  CASE WHEN l_orderkey % 3 = 0 THEN -1 ELSE 1 END AS return_sign,
  CASE l_suppkey % 5 WHEN 0 THEN NULL WHEN 1 THEN 0.5e0 ELSE 2.0e0 END AS exchange_rate_erp,
  CASE l_suppkey % 3 WHEN 0 THEN 1.0e0 WHEN 1 THEN 0.5e0 ELSE 2.0e0 END AS exchange,
  CASE l_suppkey % 3 WHEN 0 THEN 1.0e0 WHEN 1 THEN 2.0e0 ELSE 0.5e0 END AS exchange_to_local,
  CASE WHEN l_partkey % 11 = 0 THEN NULL ELSE 10.0e0 + l_partkey % 7 END AS cons_cost_unit,
  CAST(l_suppkey % 4 AS DOUBLE) AS tca_unit,
  CASE WHEN l_partkey % 13 = 0 THEN NULL ELSE CAST(l_partkey % 3 AS DOUBLE) END AS freight_in_unit,
  CAST(l_partkey % 2 AS DOUBLE) AS infra_unit,
  CASE WHEN l_partkey % 17 = 0 THEN NULL ELSE 20.0e0 + l_partkey % 9 END AS comm_cost_unit,
  CASE WHEN l_partkey % 13 = 5 THEN NULL WHEN l_partkey % 13 = 6 THEN 0.0e0
    ELSE l_extendedprice END AS net_total,
  CASE WHEN l_partkey % 7 = 5 THEN NULL ELSE l_extendedprice * 1.25e0 END AS gross_total,
  CASE WHEN l_linenumber % 2 = 0 THEN -l_quantity END AS ic_discount,
  CASE WHEN l_partkey % 4 = 0 THEN NULL ELSE l_extendedprice * 2 END AS list_price_tot,
  CASE WHEN l_partkey % 4 = 1 THEN NULL ELSE l_quantity * 3 END AS forced_price_tot,
  CASE WHEN l_partkey % 5 = 0 THEN NULL ELSE l_quantity * 0.5e0 END AS removable_charges_tot,
  CASE WHEN l_partkey % 8 = 0 THEN NULL ELSE l_quantity * 0.25e0 END AS transport_total,
  l_quantity * (1 + l_suppkey % 3) AS ord_qty_orig,
  1.0e0 / (1 + l_suppkey % 3) AS share,
  order_date + CAST(l_linenumber * 15 AS INT) AS requested_delivery_date,
  CASE l_linenumber % 4 WHEN 0 THEN 'Blocked' WHEN 1 THEN 'In Picking' WHEN 2 THEN 'Confirmed SAP'
    ELSE 'Not Deliverables' END AS order_status
FROM {sales_lines}
"""

VIEWS["ord_base"] = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, doc_type_code, order_type_code, category,
  return_sign, exchange_rate_erp, exchange, exchange_to_local, cons_cost_unit, tca_unit,
  freight_in_unit, infra_unit, comm_cost_unit, l_quantity AS ord_qty_fabs, ord_qty_orig,
  share AS pct_ord_qty, net_total AS ord_nsv_lc_tot, gross_total AS ord_gsv_lc_tot,
  ic_discount AS ord_ic_discount, list_price_tot, forced_price_tot, removable_charges_tot,
  requested_delivery_date, order_status
FROM {measure_base}
"""

VIEWS["del_base"] = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, doc_type_code, order_type_code, category,
  return_sign, exchange_rate_erp, exchange, exchange_to_local, cons_cost_unit, tca_unit,
  freight_in_unit, infra_unit, comm_cost_unit, l_quantity AS del_qty_fabs,
  CASE WHEN l_partkey % 19 = 0 THEN 0.0e0 ELSE ord_qty_orig END AS ord_qty_orig,
  share AS pct_del_qty, net_total AS del_nsv_lc_tot, gross_total AS del_gsv_lc_tot,
  ic_discount AS del_ic_discount, list_price_tot, forced_price_tot, removable_charges_tot,
  transport_total AS del_raee_lc
FROM {measure_base}
"""

VIEWS["inv_base"] = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, doc_type_code, order_type_code,
  return_sign, exchange_rate_erp, exchange, exchange_to_local, cons_cost_unit, tca_unit,
  freight_in_unit, infra_unit, comm_cost_unit, l_quantity AS inv_qty_fabs,
  net_total AS inv_nsv_lc_temp, gross_total AS inv_gsv_lc_temp,
  CASE WHEN l_partkey % 2 = 0 THEN l_quantity END AS inv_gsv_bonus_lc_temp,
  ic_discount AS inv_ic_discount, list_price_tot, forced_price_tot,
  transport_total AS inv_transport_cost_lc_temp, removable_charges_tot AS removable_charges_lc,
  CASE WHEN l_partkey % 9 = 0 THEN NULL ELSE l_quantity END AS inv_raee_lc,
  ship_date AS time_id
FROM {measure_base}
"""

VIEWS["legacy_sales"] = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  CAST(1 + l_partkey % 3 AS INT) AS data_type,
  CASE l_orderkey % 6 WHEN 0 THEN 5 WHEN 1 THEN 6 WHEN 2 THEN 7 WHEN 3 THEN 9 ELSE 4 END AS doc_type_code,
  l_quantity AS quantity,
  CASE l_partkey % 5 WHEN 0 THEN NULL WHEN 1 THEN 0.0e0 ELSE l_extendedprice END AS acc_extra_amount,
  CASE l_partkey % 7 WHEN 0 THEN NULL ELSE l_extendedprice * 2 END AS extra_amount,
  CASE l_suppkey % 8 WHEN 0 THEN NULL WHEN 1 THEN 0.0e0 WHEN 2 THEN 4.0e0 WHEN 3 THEN 0.5e0
    ELSE 1.0e0 END AS currency_euro_exch,
  CASE l_partkey % 3 WHEN 0 THEN NULL ELSE l_quantity END AS removable_charges,
  CASE l_partkey % 11 WHEN 0 THEN NULL ELSE l_extendedprice END AS tot_amount_no_transport,
  CASE l_partkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 0.0e0 ELSE l_extendedprice * 3 END AS acc_amount,
  CASE l_partkey % 6 WHEN 0 THEN NULL ELSE l_extendedprice * 2 END AS doc_total_amount,
  CASE l_partkey % 8 WHEN 0 THEN NULL WHEN 1 THEN 0.0e0 ELSE CAST(l_partkey % 40 AS DOUBLE) END AS cons_cost_of_sales,
  CASE l_partkey % 4 WHEN 0 THEN NULL ELSE CAST(l_suppkey % 2 AS DOUBLE) END AS tca,
  CASE l_partkey % 5 WHEN 3 THEN NULL ELSE CAST(l_partkey % 6 AS DOUBLE) END AS transport_cost,
  CAST(l_partkey % 2 AS DOUBLE) AS transport_cost_infra,
  CASE l_partkey % 9 WHEN 0 THEN NULL WHEN 1 THEN 0.0e0 ELSE CAST(l_partkey % 50 AS DOUBLE) END AS comm_cost_of_sales,
  CASE l_partkey % 10 WHEN 0 THEN NULL ELSE CAST(l_partkey % 60 AS DOUBLE) END AS revised_comm_cos,
  CASE WHEN l_suppkey % 3 <> 0 THEN CAST('1998-06-01' AS DATE) END AS start_date_tprice_revised,
  order_date AS document_date,
  CASE WHEN l_partkey % 6 <> 0 THEN l_quantity END AS delivery_quantity,
  CASE WHEN l_partkey % 7 <> 0 THEN l_extendedprice END AS delivery_nsv_amount,
  CASE WHEN l_partkey % 5 <> 0 THEN CAST(l_partkey % 90 AS DOUBLE) END AS std_sale_price,
  l_extendedprice * 4 AS delivery_total_amount,
  CASE WHEN l_partkey % 9 <> 0 THEN l_quantity * 2 END AS order_qty,
  CASE l_partkey % 8 WHEN 0 THEN NULL WHEN 1 THEN 0.0e0 ELSE l_extendedprice END AS order_nsv_amount,
  l_extendedprice * 3 AS order_doc_total_amount,
  CASE WHEN l_partkey % 3 <> 0 THEN l_quantity * 5 END AS network_budget,
  CASE WHEN l_partkey % 4 <> 0 THEN l_quantity * 6 END AS quantity_revised,
  CASE WHEN l_suppkey % 4 <> 0 THEN CAST('1999-01-01' AS DATE) END AS start_date_nsv_revised,
  CASE WHEN l_partkey % 6 <> 0 THEN CAST(l_partkey % 70 AS DOUBLE) END AS revised_sale_price,
  CASE l_partkey % 7 WHEN 0 THEN NULL WHEN 1 THEN 0.0e0 ELSE CAST(l_partkey % 30 AS DOUBLE) END AS transfpri_revised_nsv,
  CAST(l_suppkey % 3 AS INT) AS t3316lng, CAST(l_partkey % 2 AS INT) AS evaluation_type,
  CAST(l_linenumber AS INT) AS order_alloc_status,
  CASE WHEN l_partkey % 3 <> 0 THEN CAST(l_partkey % 80 AS INT) END AS order_blocking_code,
  'W' || CAST(l_suppkey % 2 AS STRING) AS order_delivery_warehouse,
  'W' || CAST(l_partkey % 2 AS STRING) AS allocation_warehouse,
  CAST(l_partkey % 5 AS INT) AS company, CAST(l_suppkey % 25 AS INT) AS network,
  lpad(CAST(l_partkey AS STRING), 8, '0') AS product_code,
  CASE WHEN o_custkey % 10 <> 0 THEN 'C' || CAST(o_custkey AS STRING) END AS customer,
  CASE WHEN o_custkey % 12 <> 0 THEN 'C' || CAST(o_custkey AS STRING) END AS inv_customer,
  CAST(l_partkey % 2 AS INT) AS flag_bgrade, ship_date AS order_requested_delivery_date,
  'D' || CAST(l_orderkey AS STRING) AS document_code, 'O' || CAST(l_orderkey AS STRING) AS order_number,
  CAST(l_linenumber AS STRING) AS order_line, 'N' || CAST(l_orderkey AS STRING) AS despatching_note,
  CASE WHEN l_orderkey % 5 = 0 THEN 'R' || CAST(l_orderkey AS STRING) END AS ref_invoice
FROM {sales_lines}
"""

VIEWS["legacy_base"] = """
SELECT s.*, order_requested_delivery_date AS mrdd,
  CASE WHEN l_partkey % 13 <> 0 THEN CAST(l_partkey % 100 AS DOUBLE) END AS budget_price,
  CASE WHEN l_partkey % 13 <> 0 THEN CAST(l_partkey % 100 AS DOUBLE) END AS budget_price_revised,
  CASE WHEN data_type = 2 THEN CASE WHEN order_alloc_status = 6 AND coalesce(order_blocking_code, 0) < 50
      THEN 'In Picking' WHEN coalesce(order_blocking_code, 0) < 50 THEN 'Not Blocked' ELSE 'Blocked' END
    WHEN data_type = 1 THEN 'Invoiced' WHEN data_type = 3 THEN 'Delivered' END AS potential_status
FROM {legacy_sales} s
"""

VIEWS["unit_currency"] = """
SELECT DISTINCT lpad(CAST(n_regionkey AS STRING), 2, '0') AS company,
  'C' || CAST(n_regionkey AS STRING) AS currency
FROM {nation} WHERE n_name <> 'NATION_3'
"""

VIEWS["budget_prices"] = """
SELECT DISTINCT n.sales_organization || '-@-' || n.sales_office || '-@-' || product_code || '-@-'
    || CAST(year(document_date) AS STRING) || '-@-' || CAST(month(document_date) AS STRING) AS key,
  CAST(l_partkey % 100 AS DOUBLE) AS nsv_local
FROM {legacy_sales} s JOIN {company_network} n
  ON lpad(CAST(s.company AS STRING), 2, '0') = n.company AND lpad(CAST(s.network AS STRING), 2, '0') = n.network
WHERE std_sale_price IS NULL OR std_sale_price > 10
"""

# --- report rows -------------------------------------------------------------------

# Codes of a report row that its facts share.
REPORT_CODES = """order_date, confirmed_date, area_code, order_blocking_code, order_customer_reference_1, order_type_code,
  order_delivery_warehouse, ab_grade, warehouse_classification, main_group_code, sale_zone_code, salesman_code,
  sale_director_code, rsm_code, market_budget, market_budget_descr"""

VIEWS["report_lines"] = """
SELECT CASE WHEN l_orderkey % 4 <> 0 THEN order_date + 10 END AS confirmed_date, 'A' || CAST(l_suppkey % 7 AS STRING) AS area_code,
  CASE WHEN l_orderkey % 11 = 0 THEN '01' END AS order_blocking_code, 'R' || CAST(l_orderkey % 40 AS STRING) AS order_customer_reference_1,
  CASE l_orderkey % 4 WHEN 0 THEN 'ZKA' WHEN 1 THEN 'ZBGR' WHEN 2 THEN 'Z?' ELSE 'ZOR' END AS order_type_code,
  'W' || CAST(l_suppkey % 4 AS STRING) AS order_delivery_warehouse, CASE l_orderkey % 4 WHEN 1 THEN 'B' ELSE 'A' END AS ab_grade,
  '0' || CAST(o_custkey % 3 AS STRING) AS warehouse_classification, 'M' || CAST(o_custkey % 6 AS STRING) AS main_group_code,
  CASE WHEN o_custkey % 10 <> 0 THEN 'Z' || CAST(o_custkey % 9 AS STRING) END AS sale_zone_code,
  lpad(CAST(o_custkey % 12 AS STRING), 4, '0') AS salesman_code, 'D' || CAST(o_custkey % 5 AS STRING) AS sale_director_code,
  CASE o_custkey % 7 WHEN 0 THEN 'none' ELSE CAST(o_custkey % 7 AS STRING) END AS rsm_code,
  CASE WHEN l_suppkey % 3 <> 0 THEN 'M' || lpad(CAST(l_suppkey % 25 AS STRING), 2, '0') END AS market_budget,
  CASE WHEN l_suppkey % 3 <> 0 THEN 'Market ' || lpad(CAST(l_suppkey % 25 AS STRING), 2, '0') END AS market_budget_descr,
  l_orderkey, l_linenumber, lpad(CAST(l_partkey AS STRING), 8, '0') AS product_code,
  'C' || CAST(o_custkey AS STRING) AS dest_id, 'C' || CAST(o_custkey % 50 AS STRING) AS inv_id,
  lpad(CAST(l_suppkey % 5 AS STRING), 2, '0') AS company, lpad(CAST(l_suppkey % 25 AS STRING), 2, '0') AS network,
  CASE l_suppkey % 6 WHEN 0 THEN '62T0' WHEN 1 THEN '66J0' ELSE '60B0' END AS sales_organization,
  'H' || lpad(CAST(l_suppkey % 25 AS STRING), 3, '0') AS sales_office,
  CASE l_partkey % 4 WHEN 0 THEN 'AC' ELSE 'FG' END AS division,
  CASE l_partkey % 3 WHEN 0 THEN 'cas' ELSE 'sap' END AS source,
  CASE l_partkey % 3 WHEN 0 THEN 0 ELSE 1 END AS flag_erp,
  CASE l_orderkey % 9 WHEN 0 THEN NULL WHEN 1 THEN 5 WHEN 2 THEN 7 ELSE 4 END AS doc_type_code,
  CASE WHEN o_custkey % 3 = 0 THEN 'Z0' || CAST(o_custkey % 8 AS STRING) END AS return_reason,
  CAST(o_orderkey_text AS STRING) AS order_number, order_date, ship_date,
  order_date + CAST(l_linenumber * 20 AS INT) AS first_req_del_date, ship_date AS requested_delivery_date,
  'S' || CAST(o_custkey % 4 AS STRING) AS super_group_code,
  CASE WHEN o_custkey % 5 <> 0 THEN 'Super ' || CAST(o_custkey % 4 AS STRING) END AS super_group_descr,
  'P' || CAST(o_custkey % 7 AS STRING) AS purchase_group_code,
  CASE WHEN o_custkey % 6 <> 0 THEN 'Purchase ' || CAST(o_custkey % 7 AS STRING) END AS purchase_group_descr,
  CASE l_partkey % 10 WHEN 0 THEN 0.0e0 ELSE l_quantity END AS qty,
  CASE l_partkey % 10 WHEN 0 THEN 0.0e0 ELSE l_extendedprice END AS nsv_eur,
  CASE l_partkey % 10 WHEN 0 THEN 0.0e0 ELSE l_extendedprice * 2 END AS gsv_eur,
  CASE l_partkey % 20 WHEN 0 THEN 0.0e0 ELSE l_extendedprice - l_quantity END AS gm_tp_eur,
  CASE l_partkey % 20 WHEN 0 THEN 0.0e0 ELSE l_extendedprice - l_quantity * 2 END AS gm_cp_eur
FROM (SELECT *, l_orderkey AS o_orderkey_text FROM {sales_lines}) s
"""

VIEWS["report_orders"] = """
SELECT product_code, dest_id, inv_id, company, network, sales_organization, sales_office, division, source,
  flag_erp, doc_type_code, return_reason, order_number, first_req_del_date, requested_delivery_date,
  @@CODES@@, super_group_code, super_group_descr, purchase_group_code, purchase_group_descr,
  CAST('1998-08-15' AS DATE) AS document_date, qty AS ord_qty, nsv_eur AS ord_nsv_eur, gsv_eur AS ord_gsv_eur,
  gm_tp_eur AS ord_gm_tp_eur, gm_cp_eur AS ord_gm_cp_eur
FROM {report_lines} WHERE ship_date >= CAST('1998-06-01' AS DATE)
""".replace("@@CODES@@", REPORT_CODES)

VIEWS["report_deliveries"] = """
SELECT product_code, dest_id, inv_id, company, network, sales_organization, sales_office, division, source,
  flag_erp, doc_type_code, return_reason, order_number, first_req_del_date, requested_delivery_date,
  @@CODES@@, super_group_code, super_group_descr, purchase_group_code, purchase_group_descr,
  CAST('1998-08-15' AS DATE) AS document_date, qty AS del_qty, nsv_eur AS del_nsv_eur, gsv_eur AS del_gsv_eur,
  gm_tp_eur AS del_gm_tp_eur, gm_cp_eur AS del_gm_cp_eur
FROM {report_lines} WHERE ship_date BETWEEN CAST('1998-03-01' AS DATE) AND CAST('1998-09-30' AS DATE)
""".replace("@@CODES@@", REPORT_CODES)

VIEWS["report_invoices"] = """
SELECT product_code, dest_id, inv_id, company, network, sales_organization, sales_office, division, source,
  flag_erp, doc_type_code, return_reason, order_number, first_req_del_date, requested_delivery_date,
  @@CODES@@, super_group_code, super_group_descr, purchase_group_code, purchase_group_descr,
  ship_date AS time_id, qty AS inv_qty, nsv_eur AS inv_nsv_eur, gsv_eur AS inv_gsv_eur,
  gm_tp_eur AS inv_gm_tp_eur, gm_cp_eur AS inv_gm_cp_eur
FROM {report_lines}
""".replace("@@CODES@@", REPORT_CODES)

VIEWS["report_budget"] = """
SELECT lpad(CAST(p_partkey AS STRING), 8, '0') AS product_code, lpad(CAST(p_size % 5 AS STRING), 2, '0') AS company,
  lpad(CAST(p_size % 25 AS STRING), 2, '0') AS network, CASE p_size % 6 WHEN 0 THEN '62T0' ELSE '60B0' END AS sales_organization,
  'H' || CAST(p_size % 25 AS STRING) AS sales_office, 1998 AS year, month,
  CAST(p_size * month AS DOUBLE) AS qty_sold, p_retailprice AS nsv_eur, p_retailprice * 2 AS nsv_local,
  p_retailprice * p_size AS budget_nsv_eur, p_retailprice * p_size * 2 AS budget_nsv_local
FROM {part}, (VALUES (1), (2), (3), (4), (5), (6), (7), (8), (9), (10), (11), (12)) AS m(month)
"""

VIEWS["network_markets"] = """
SELECT company, network, 'M' || network AS market_budget, 'Market ' || network AS market_budget_descr
FROM {company_network} WHERE network <> '07'
"""

VIEWS["network_responsibles"] = """
SELECT company, network, 'C' || network AS responsible_code, 'Cluster ' || network AS responsible_descr, 'R' || company AS responsible_code1,
  'Region ' || company AS responsible_descr1, 'S' || company || network AS responsible_code3, CASE WHEN network <> '03' THEN 'Sub ' || network END AS responsible_descr3
FROM {company_network} WHERE network <> '09'
"""

VIEWS["sales_names"] = """
SELECT DISTINCT 'M' || CAST(c_custkey % 6 AS STRING) AS code, 'Main ' || CAST(c_custkey % 6 AS STRING) AS name FROM {customer}
UNION ALL SELECT DISTINCT 'Z' || CAST(c_custkey % 8 AS STRING), 'Zone ' || CAST(c_custkey % 8 AS STRING) FROM {customer}
UNION ALL SELECT DISTINCT lpad(CAST(c_custkey % 12 AS STRING), 4, '0'), 'Salesman ' || CAST(c_custkey % 12 AS STRING) FROM {customer}
UNION ALL SELECT DISTINCT 'D' || CAST(c_custkey % 5 AS STRING), 'Director ' || CAST(c_custkey % 5 % 3 AS STRING) FROM {customer}
UNION ALL SELECT DISTINCT CAST(c_custkey % 7 AS STRING), 'Manager ' || CAST(c_custkey % 7 AS STRING) FROM {customer}
"""

VIEWS["customer_codes"] = """
SELECT 'C' || CAST(c_custkey AS STRING) AS customer, CAST(c_custkey * 10 AS STRING) AS code
FROM {customer} WHERE c_mktsegment <> 'BUILDING'
"""

# --- products as attributes -----------------------------------------------------

VIEWS["attributes"] = """
SELECT sku, class_id, tree_name, key, value, ingestion_date, ingestion_type FROM (
  SELECT lpad(CAST(p_partkey AS STRING), 8, '0') AS sku, CAST(NULL AS STRING) AS class_id,
    CAST(NULL AS STRING) AS tree_name, key,
    CASE key WHEN 'Release Status' THEN CASE p_partkey % 5 WHEN 0 THEN 'Out of Production'
        WHEN 1 THEN ' rejected ' WHEN 2 THEN 'Released' WHEN 3 THEN 'Obsolete 2' ELSE 'Draft' END
      WHEN 'Brand [12]' THEN p_brand
      WHEN 'Packed Product Height (mm)' THEN CASE WHEN p_partkey % 6 = 0 THEN 'n/a' ELSE CAST(p_size * 100 AS STRING) END
      WHEN 'Packed Product Width (mm)' THEN CAST(p_size * 10 AS STRING)
      WHEN 'Packed Product Depth (mm)' THEN '500'
      WHEN 'Start Date' THEN CASE WHEN p_partkey % 7 = 0 THEN 'soon' ELSE '2020-01-' || lpad(CAST(1 + p_size % 28 AS STRING), 2, '0') END
      WHEN 'Object Type' THEN CASE WHEN p_partkey % 4 = 0 THEN '1' ELSE '1-Model' END
      WHEN 'Markets' THEN CASE p_partkey % 3 WHEN 0 THEN 'IT~UK~FR' WHEN 1 THEN 'IT' END
      WHEN 'Factory CAS' THEN 'F' || CAST(p_size % 4 AS STRING) || CASE WHEN p_partkey % 8 <> 0 THEN '-Factory ' || CAST(p_size % 4 AS STRING) ELSE '' END
      WHEN 'Supplier Code SAP' THEN CASE WHEN p_partkey % 3 = 0 THEN CAST(p_size % 9 AS STRING) || '-Supplier' END
      ELSE CASE WHEN p_partkey % 10 = 0 THEN lpad(CAST(p_partkey + 1 AS STRING), 8, '0') || '~' || lpad(CAST(p_partkey + 2 AS STRING), 8, '0') END
      END AS value,
    CASE WHEN p_partkey % 2 = 0 THEN '2024-01-05' ELSE '2024-01-09' END AS ingestion_date,
    'delta' AS ingestion_type
  FROM {part}, (VALUES ('Release Status'), ('Brand [12]'), ('Packed Product Height (mm)'),
    ('Packed Product Width (mm)'), ('Packed Product Depth (mm)'), ('Start Date'), ('Object Type'),
    ('Markets'), ('Factory CAS'), ('Supplier Code SAP'), ('Related Derivate Model')) AS k(key)
  UNION ALL
  SELECT lpad(CAST(p_partkey AS STRING), 8, '0'), p_type,
    CASE WHEN p_size % 2 = 0 THEN 'MKT Tree' ELSE 'EPREL Tree' END, 'Energy (kWh)',
    CAST(p_retailprice AS STRING), '2024-01-07', 'bulk' FROM {part}
  UNION ALL
  SELECT lpad(CAST(p_partkey AS STRING), 8, '0'), 'X' || CAST(p_partkey % 4 AS STRING), 'MKT Tree',
    'Noise', CAST(p_size AS STRING), '2024-01-08', 'delta' FROM {part} WHERE p_type = 'PROMO'
) a WHERE value IS NOT NULL
"""

VIEWS["attribute_kinds"] = """
SELECT DISTINCT std_key, kind FROM {region}, (VALUES ('Packed_Product_Height_mm', 'Number'),
  ('Packed_Product_Width_mm', 'Number'), ('Packed_Product_Depth_mm', 'Number'), ('Noise', 'Number'),
  ('Start_Date', 'Date'), ('Markets', 'Array'), ('Related_Derivate_Model', 'Array')) AS k(std_key, kind)
"""

VIEWS["products"] = """
SELECT CASE WHEN p_partkey % 7 = 0 THEN CAST(1 + p_partkey % 2 AS STRING) || '-@-' ELSE 'P' END || CAST(p_partkey AS STRING) AS product_id,
  lpad(CAST(p_partkey AS STRING), 8, '0') AS product_code,
  CASE p_partkey % 5 WHEN 0 THEN '1' WHEN 1 THEN '2' WHEN 2 THEN '3' WHEN 3 THEN 'W' END AS product_type_code,
  p_brand AS line_code, 'Line ' || p_type AS line_descr, p_type AS business_sector_code,
  CASE WHEN p_size % 9 <> 0 THEN 'Sector ' || p_type END AS business_sector_descr,
  CAST(p_size % 4 AS STRING) AS ind_division_code, 'Division ' || CAST(p_size % 4 AS STRING) AS ind_division_descr,
  CASE WHEN p_size % 3 = 0 THEN 'FOB' END AS fob
FROM {part}
"""

# --- what is known of a product elsewhere ---------------------------------------

VIEWS["workflow"] = """
SELECT CASE p_partkey % 2 WHEN 0 THEN 'Release' ELSE 'SMD input' END AS task_name,
  lpad(CAST(p_partkey AS STRING), 8, '0') || '~' || lpad(CAST(p_partkey + 2 AS STRING), 8, '0') AS item_ids,
  CAST('2023-01-01' AS DATE) + CAST(p_size AS INT) AS done_on, CAST('2023-06-01' AS DATE) + CAST(p_partkey % 30 AS INT) AS last_mod_date
FROM {part}
"""

VIEWS["characteristics"] = """
SELECT lpad(CAST(p_partkey AS STRING), 8, '0') AS product_code, CAST(p_size % 5 AS STRING) AS characteristic_id, p_brand AS characteristic_value
FROM {part}
"""

VIEWS["characteristic_names"] = """
SELECT CAST(r_regionkey AS STRING) AS characteristic_id, CASE r_regionkey WHEN 0 THEN 'ZPROD_COMCODEEXT'
  WHEN 1 THEN 'ZPREF_ORIG' WHEN 2 THEN 'ZPROD_INWCODE' ELSE 'ZOTHER' END AS characteristic
FROM {region}
"""

VIEWS["trade_classes"] = """
SELECT lpad(CAST(p_partkey AS STRING), 8, '0') AS product_code, 'HS' || CAST(p_size * 10 + copy AS STRING) AS customs_number,
  CAST('2024-03-01' AS DATE) + CAST(copy * 60 - p_size * 3 AS INT) AS validity_end_date, CAST('2024-01-01' AS DATE) + CAST(copy AS INT) AS last_update
FROM {part}, (VALUES (0), (1)) AS copies(copy)
"""

VIEWS["plants"] = """
SELECT lpad(CAST(p_partkey AS STRING), 8, '0') AS product_code, 'P' || CAST(p_size % 3 AS STRING) AS plant_status
FROM {part} WHERE p_partkey % 5 <> 0
"""

VIEWS["materials"] = """
SELECT lpad(CAST(p_partkey AS STRING), 8, '0') AS product_code, 'G' || CAST(p_size % 8 AS STRING) AS material_group
FROM {part} WHERE p_partkey % 9 <> 0
"""
