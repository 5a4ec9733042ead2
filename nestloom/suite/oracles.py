"""SQL counterparts of the registered queries, written independently of the Spark code.

They join first and aggregate later, the plain way round, over the same whole tables.
"""

from __future__ import annotations

from nestloom.sources.tables import STAR_KEYS, STAR_SCHEMAS

ORDER_CAP = 5
MEMBER_CAP = 25
PAGE = 100
PROFILED = ["customer", "documents", "events", "lineitem", "orders", "part", "supplier"]

MONEY = "DECIMAL(18,2)"
ISO = "%Y-%m-%dT%H:%M:%SZ"


def _optional(name: str, column: str, quoted: bool = True) -> str:
    """JSON field that is left out when NULL."""
    value = f"""'"' || {column} || '"'""" if quoted else f"CAST({column} AS VARCHAR)"
    return f"""CASE WHEN {column} IS NOT NULL THEN ',"{name}":' || {value} ELSE '' END"""


LINES = f"""
lines AS (
  SELECT l_orderkey, count(*) AS n,
    '[' || string_agg(
      '{{"InvoiceLineId":' || l_linenumber || ',"TrackId":' || l_partkey
      || ',"UnitPrice":' || CAST(CAST(l_extendedprice AS {MONEY}) AS VARCHAR)
      || ',"Quantity":' || CAST(l_quantity AS BIGINT)
      || {_optional("TrackName", "p_name")}
      || {_optional("ArtistName", "n_name")}
      || {_optional("AlbumTitle", "s_name")} || '}}',
      ',' ORDER BY l_linenumber, l_partkey, CAST(l_extendedprice AS {MONEY}), l_quantity) || ']' AS items
  FROM lineitem
  LEFT JOIN part ON p_partkey = l_partkey
  LEFT JOIN supplier ON s_suppkey = p_size
  LEFT JOIN nation ON n_nationkey = s_nationkey
  GROUP BY l_orderkey)"""

ORDER_ITEMS = f"""
order_items AS (
  SELECT 'CUSTOMER#' || o_custkey AS "PK",
    'ORDER#' || strftime(o_orderdate, '{ISO}') || '#' || o_orderkey AS "SK",
    'Order' AS "EntityType", o_orderkey AS "InvoiceId",
    strftime(o_orderdate, '{ISO}') AS "InvoiceDate",
    CAST(CAST(o_totalprice AS {MONEY}) AS DOUBLE) AS "Total",
    CAST(coalesce(n, 0) AS BIGINT) AS "LineItemCount",
    CASE WHEN n > {ORDER_CAP} THEN true END AS "LargeOrder",
    CAST(NULL AS VARCHAR) AS "BillingAddress", o_orderpriority AS "BillingCity",
    CAST(NULL AS VARCHAR) AS "BillingState", nullif(o_orderstatus, 'P') AS "BillingCountry",
    CAST(NULL AS VARCHAR) AS "BillingPostalCode",
    CASE WHEN n IS NULL THEN '[]' WHEN n <= {ORDER_CAP} THEN items END AS "LineItems"
  FROM orders LEFT JOIN lines ON l_orderkey = o_orderkey)"""

ORDER_PAGES = f"""
order_pages AS (
  SELECT 'CUSTOMER#' || o_custkey AS "PK",
    'ORDER_LINES#' || strftime(o_orderdate, '{ISO}') || '#' || o_orderkey || '#PAGE#' || page AS "SK",
    'OrderLinesPage' AS "EntityType", o_orderkey AS "InvoiceId", page AS "Page", count(*) AS "PageLineCount",
    '[' || string_agg(
      '{{"InvoiceLineId":' || l_linenumber || ',"TrackId":' || l_partkey
      || ',"UnitPrice":' || CAST(price AS VARCHAR) || ',"Quantity":' || quantity
      || {_optional("TrackName", "p_name")}
      || {_optional("ArtistName", "n_name")}
      || {_optional("AlbumTitle", "s_name")} || '}}', ',' ORDER BY rn) || ']' AS "LineItems"
  FROM (
    SELECT *, CAST((rn - 1) // {ORDER_CAP} + 1 AS BIGINT) AS page FROM (
      SELECT *, CAST(l_extendedprice AS {MONEY}) AS price, CAST(l_quantity AS BIGINT) AS quantity,
        count(*) OVER (PARTITION BY l_orderkey) AS n,
        row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, CAST(l_extendedprice AS {MONEY}), CAST(l_quantity AS BIGINT)) AS rn
      FROM lineitem) WHERE n > {ORDER_CAP})
  JOIN orders ON o_orderkey = l_orderkey
  LEFT JOIN part ON p_partkey = l_partkey
  LEFT JOIN supplier ON s_suppkey = p_size
  LEFT JOIN nation ON n_nationkey = s_nationkey
  GROUP BY o_custkey, o_orderdate, o_orderkey, page)"""

PROFILES = f"""
profiles AS (
  SELECT 'CUSTOMER#' || c_custkey AS "PK", 'PROFILE' AS "SK", 'CustomerProfile' AS "EntityType",
    c_custkey AS "CustomerId", split_part(c_name, '#', 1) AS "FirstName", split_part(c_name, '#', 2) AS "LastName",
    lower(c_name) || '@example.com' AS "Email", n_name AS "Country", c_mktsegment AS "City",
    count(o_orderkey) AS "TotalOrders",
    CAST(coalesce(sum(CAST(o_totalprice AS {MONEY})), 0) AS DOUBLE) AS "TotalSpent",
    nullif(c_mktsegment, 'BUILDING') AS "Company",
    CASE WHEN c_acctbal >= 0 THEN c_name END AS "Address", CAST(NULL AS VARCHAR) AS "State",
    CAST(c_custkey AS VARCHAR) AS "PostalCode", CAST(NULL AS VARCHAR) AS "Phone", CAST(NULL AS VARCHAR) AS "Fax",
    CAST(nullif(c_nationkey, 0) AS BIGINT) AS "SupportRepId",
    CASE WHEN c_nationkey <> 0 THEN split_part(s_name, '#', 1) || ' ' || split_part(s_name, '#', 2) END AS "SupportRepName",
    'EMAIL#' || lower(c_name) || '@example.com' AS "GSI1PK", 'CUSTOMER#' || c_custkey AS "GSI1SK"
  FROM customer
  LEFT JOIN nation ON n_nationkey = c_nationkey
  LEFT JOIN supplier ON s_suppkey = c_nationkey
  LEFT JOIN orders ON o_custkey = c_custkey
  GROUP BY c_custkey, c_name, n_name, c_mktsegment, c_acctbal, c_nationkey, s_name)"""

CUSTOMER_TARGET = f"""
WITH {LINES}, {ORDER_ITEMS}, {ORDER_PAGES}, {PROFILES},
target AS (SELECT * FROM profiles UNION ALL BY NAME SELECT * FROM order_items UNION ALL BY NAME SELECT * FROM order_pages)"""

ARTISTS = """
artists AS (
  SELECT 'ARTIST#' || n_nationkey AS "PK", 'METADATA' AS "SK", 'Artist' AS "EntityType",
    CAST(n_nationkey AS BIGINT) AS "ArtistId", n_name AS "Name",
    count(DISTINCT c_custkey) AS "AlbumCount", count(DISTINCT o_orderkey) AS "TrackCount",
    'ARTIST_NAME#' || n_name AS "GSI1PK", 'ARTIST#' || n_nationkey AS "GSI1SK"
  FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey LEFT JOIN orders ON o_custkey = c_custkey
  GROUP BY n_nationkey, n_name)"""

ALBUMS = """
albums AS (
  SELECT 'ARTIST#' || c_nationkey AS "PK", 'ALBUM#' || c_custkey AS "SK", 'Album' AS "EntityType",
    c_custkey AS "AlbumId", c_name AS "Title", CAST(c_nationkey AS BIGINT) AS "ArtistId", n_name AS "ArtistName",
    count(o_orderkey) AS "TrackCount", 'ALBUM_TITLE#' || c_name AS "GSI1PK", 'ALBUM#' || c_custkey AS "GSI1SK"
  FROM customer JOIN nation ON n_nationkey = c_nationkey LEFT JOIN orders ON o_custkey = c_custkey
  GROUP BY c_custkey, c_name, c_nationkey, n_name)"""

TRACKS = f"""
tracks AS (
  SELECT 'ALBUM#' || o_custkey AS "PK", 'TRACK#' || o_orderkey AS "SK", 'Track' AS "EntityType",
    o_orderkey AS "TrackId", 'Order ' || o_orderkey AS "Name", o_custkey AS "AlbumId", c_name AS "AlbumTitle",
    CAST(c_nationkey AS BIGINT) AS "ArtistId", n_name AS "ArtistName",
    CAST(CAST(o_totalprice AS {MONEY}) AS DOUBLE) AS "UnitPrice", nullif(o_orderstatus, 'P') AS "Composer",
    nullif(o_custkey, 0) AS "Milliseconds", CAST(NULL AS BIGINT) AS "Bytes",
    CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS "GenreId", g.r_name AS "GenreName",
    CASE o_orderstatus WHEN 'P' THEN CAST(1 AS BIGINT) WHEN 'O' THEN CAST(2 AS BIGINT) END AS "MediaTypeId",
    CASE WHEN o_orderstatus IN ('P', 'O') THEN m.r_name END AS "MediaTypeName",
    'TRACK_NAME#Order ' || o_orderkey AS "GSI1PK", 'TRACK#' || o_orderkey AS "GSI1SK", 'GENRE#' || g.r_name AS "GSI2PK"
  FROM orders
  JOIN customer ON c_custkey = o_custkey
  JOIN nation ON n_nationkey = c_nationkey
  LEFT JOIN region g ON g.r_regionkey = CAST(substr(o_orderpriority, 1, 1) AS INTEGER)
  LEFT JOIN region m ON m.r_regionkey = CASE o_orderstatus WHEN 'P' THEN 1 WHEN 'O' THEN 2 ELSE 0 END)"""

CATALOG = f"""
WITH {ARTISTS}, {ALBUMS}, {TRACKS},
catalog AS (SELECT * FROM artists UNION ALL BY NAME SELECT * FROM albums UNION ALL BY NAME SELECT * FROM tracks)"""

MEMBERS = f"""
pairs AS (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem),
members AS (
  SELECT l_partkey, count(*) AS n, CAST(sum(s_suppkey * 10) AS BIGINT) AS duration,
    '[' || string_agg(
      '{{"TrackId":' || l_suppkey || ',"Name":"' || s_name || '"'
      || {_optional("Duration", "nullif(s_suppkey * 10, 0)", False)}
      || {_optional("UnitPrice", f"nullif(CAST(s_acctbal AS {MONEY}), 0)", False)}
      || {_optional("ArtistName", "r_name")}
      || {_optional("AlbumTitle", "n_name")} || '}}', ',' ORDER BY s_name, l_suppkey) || ']' AS items
  FROM pairs
  LEFT JOIN supplier ON s_suppkey = l_suppkey
  LEFT JOIN nation ON n_nationkey = s_nationkey
  LEFT JOIN region ON r_regionkey = n_regionkey
  GROUP BY l_partkey),
containers AS (
  SELECT 'PLAYLIST#' || p_partkey AS "PK", 'METADATA' AS "SK", 'Playlist' AS "EntityType",
    p_partkey AS "PlaylistId", p_name AS "Name", CAST(coalesce(n, 0) AS BIGINT) AS "TrackCount",
    CAST(coalesce(duration, 0) AS BIGINT) AS "TotalDuration",
    CASE WHEN n IS NULL THEN '[]' WHEN n <= {MEMBER_CAP} THEN items END AS "Tracks",
    CASE WHEN n > {MEMBER_CAP} THEN true END AS "LargePlaylist"
  FROM part LEFT JOIN members ON l_partkey = p_partkey)"""

PAGES = f"""
pairs AS (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem),
placed AS (
  SELECT l_suppkey, l_partkey, p_name, p_size, p_retailprice, s_name, n_name,
    row_number() OVER (PARTITION BY l_suppkey ORDER BY p_name, l_partkey) AS rn,
    count(*) OVER (PARTITION BY l_suppkey) AS n
  FROM pairs
  LEFT JOIN part ON p_partkey = l_partkey
  LEFT JOIN (SELECT s_suppkey, s_name, n_name FROM supplier LEFT JOIN nation ON n_nationkey = s_nationkey) a
    ON a.s_suppkey = p_size),
pages AS (
  SELECT 'PLAYLIST#' || l_suppkey AS "PK", 'TRACKS_PAGE#' || ((rn - 1) // {PAGE} + 1) AS "SK",
    'PlaylistTracksPage' AS "EntityType", l_suppkey AS "PlaylistId",
    CAST((rn - 1) // {PAGE} + 1 AS BIGINT) AS "Page", count(*) AS "PageTrackCount",
    '[' || string_agg(
      '{{"TrackId":' || l_partkey || ',"Name":"' || p_name || '"'
      || {_optional("Duration", "nullif(p_size * 1000, 0)", False)}
      || {_optional("UnitPrice", f"nullif(CAST(p_retailprice AS {MONEY}), 0)", False)}
      || {_optional("ArtistName", "n_name")}
      || {_optional("AlbumTitle", "s_name")} || '}}', ',' ORDER BY rn) || ']' AS "Tracks"
  FROM placed WHERE n > {PAGE}
  GROUP BY l_suppkey, (rn - 1) // {PAGE} + 1)"""

MEMBER_PAGES = f"""
member_places AS (
  SELECT l_partkey, l_suppkey, s_name, s_acctbal, n_name, r_name,
    row_number() OVER (PARTITION BY l_partkey ORDER BY s_name, l_suppkey) AS rn, count(*) OVER (PARTITION BY l_partkey) AS n
  FROM pairs
  LEFT JOIN supplier ON s_suppkey = l_suppkey
  LEFT JOIN nation ON n_nationkey = s_nationkey
  LEFT JOIN region ON r_regionkey = n_regionkey),
member_pages AS (
  SELECT 'PLAYLIST#' || l_partkey AS "PK", 'TRACKS_PAGE#' || ((rn - 1) // {MEMBER_CAP} + 1) AS "SK",
    'PlaylistTracksPage' AS "EntityType", l_partkey AS "PlaylistId",
    CAST((rn - 1) // {MEMBER_CAP} + 1 AS BIGINT) AS "Page", count(*) AS "PageTrackCount",
    '[' || string_agg(
      '{{"TrackId":' || l_suppkey || ',"Name":"' || s_name || '"'
      || {_optional("Duration", "nullif(l_suppkey * 10, 0)", False)}
      || {_optional("UnitPrice", f"nullif(CAST(s_acctbal AS {MONEY}), 0)", False)}
      || {_optional("ArtistName", "r_name")}
      || {_optional("AlbumTitle", "n_name")} || '}}', ',' ORDER BY rn) || ']' AS "Tracks"
  FROM member_places WHERE n > {MEMBER_CAP}
  GROUP BY l_partkey, (rn - 1) // {MEMBER_CAP} + 1)"""

STAFF = """
staff AS (
  SELECT e.*, s_suppkey - s_suppkey % 10 AS manager, s_suppkey % 10 = 0 AS is_manager FROM supplier e),
employees AS (
  SELECT 'EMPLOYEE#' || e.s_suppkey AS "PK", 'PROFILE' AS "SK", 'Employee' AS "EntityType", e.s_suppkey AS "EmployeeId",
    split_part(e.s_name, '#', 1) AS "FirstName", split_part(e.s_name, '#', 2) AS "LastName",
    CASE WHEN e.is_manager THEN 'Manager' ELSE 'Agent' END AS "Title",
    count(l_orderkey) AS "CustomerCount",
    CASE WHEN NOT e.is_manager THEN nullif(e.manager, 0) END AS "ReportsTo",
    CASE WHEN NOT e.is_manager AND e.manager <> 0
      THEN split_part(m.s_name, '#', 1) || ' ' || split_part(m.s_name, '#', 2) END AS "ManagerName",
    CAST(NULL AS VARCHAR) AS "BirthDate", CAST(NULL AS VARCHAR) AS "HireDate", CAST(NULL AS VARCHAR) AS "Address",
    CAST(NULL AS VARCHAR) AS "City", CAST(NULL AS VARCHAR) AS "State", CAST(e.s_nationkey AS VARCHAR) AS "Country",
    CAST(NULL AS VARCHAR) AS "PostalCode", CAST(NULL AS VARCHAR) AS "Phone", CAST(NULL AS VARCHAR) AS "Fax",
    lower(e.s_name) || '@example.com' AS "Email"
  FROM staff e
  LEFT JOIN supplier m ON m.s_suppkey = e.manager
  LEFT JOIN lineitem ON l_suppkey = e.s_suppkey
  GROUP BY e.s_suppkey, e.s_name, e.s_nationkey, e.is_manager, e.manager, m.s_name)"""

CHANGES = """
changes AS (
  SELECT o_orderkey, o_custkey, 'X' AS o_orderstatus, 1.0::DOUBLE AS o_totalprice, 1 AS version
  FROM orders WHERE o_orderstatus = 'O'
  UNION ALL
  SELECT o_orderkey, o_custkey, NULL, 2.0::DOUBLE, 2 FROM orders WHERE o_orderstatus = 'O'),
last AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY version DESC) AS rn FROM changes) WHERE rn = 1),
upserted AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders
  WHERE o_orderkey NOT IN (SELECT o_orderkey FROM last)
  UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM last)"""

SNAPSHOTS = """
old AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderkey % 10 <> 3),
new AS (
  SELECT o_orderkey, o_custkey, o_orderstatus,
    CASE WHEN o_orderkey % 10 = 5 THEN 1.5 ELSE o_totalprice END::DOUBLE AS o_totalprice
  FROM orders WHERE o_orderkey % 10 <> 7)"""


def _columns(table: str) -> list[tuple[str, str]]:
    return [tuple(c.strip().split(" ", 1)) for c in STAR_SCHEMAS[table].split(",")]


def _profile(table: str) -> str:
    parts = []
    for column, kind in _columns(table):
        numeric = kind in ("int", "bigint", "double")
        value = column if numeric else "NULL"
        size = f"length({column})" if kind == "string" else "NULL"
        parts.append(f"""
SELECT '{table}' AS "table", '{column}' AS "column", count(*) AS row_count,
  count(DISTINCT {column}) AS distinct_values, count(*) FILTER (WHERE {column} IS NULL) AS null_count,
  CASE WHEN count(*) > 0 THEN round(100.0 * count(*) FILTER (WHERE {column} IS NULL) / count(*), 2) ELSE 0 END::DOUBLE AS null_percentage,
  round(min({value})::DOUBLE, 2) AS min_value, round(max({value})::DOUBLE, 2) AS max_value,
  round(avg({value}::DOUBLE), 2) AS average_value,
  min({size})::BIGINT AS min_length, max({size})::BIGINT AS max_length,
  round(avg({size}::DOUBLE), 2) AS average_length
FROM {table}""")
    return " UNION ALL ".join(parts)


def _counts() -> str:
    return " UNION ALL ".join(f"""SELECT '{t}' AS "table", count(*) AS row_count FROM {t}""" for t in STAR_SCHEMAS)


def _schema_catalog() -> str:
    rows = ", ".join(
        f"('{t}', {i}, '{c}', '{k}', {str(c in STAR_KEYS[t].primary).lower()})"
        for t in STAR_SCHEMAS
        for i, (c, k) in enumerate(_columns(t))
    )
    return f"""
WITH counts AS ({_counts()}), listed("table", position, "column", type, primary_key) AS (VALUES {rows})
SELECT "table", position::BIGINT AS position, "column", type, false AS not_null, primary_key, row_count
FROM listed JOIN counts USING ("table")"""


def _relationships() -> str:
    return " UNION ALL ".join(
        f"""
SELECT '{t}' AS "table", '{c}' AS "column", '{p}' AS references_table, '{pc}' AS references_column,
  count(*) AS child_rows, count(DISTINCT {c}) AS distinct_references,
  count(*) FILTER (WHERE {c} NOT IN (SELECT {pc} FROM {p})) AS orphan_rows FROM {t}"""
        for t, spec in STAR_KEYS.items()
        for c, (p, pc) in spec.foreign.items()
    )


def _uniqueness() -> str:
    parts = []
    for t, spec in STAR_KEYS.items():
        declared = {**spec.indexes, **({f"{t}_pk": (spec.primary, True)} if spec.primary else {})}
        for name, (columns, unique) in declared.items():
            listed = ", ".join(columns)
            parts.append(f"""
SELECT '{t}' AS "table", '{name}' AS "index", '{",".join(columns)}' AS columns, {str(unique).lower()} AS declared_unique,
  CAST(sum(n) AS BIGINT) AS rows, count(*) AS distinct_keys, sum(n) = count(*) AS is_unique
FROM (SELECT count(*) AS n FROM {t} GROUP BY {listed})""")
    return " UNION ALL ".join(parts)


def _missing(column: str, expression: str) -> str:
    return f"""
SELECT '{column}' AS "column", count(*) AS row_count, count(*) - count({expression}) AS null_count,
  round(100.0 * (count(*) - count({expression})) / count(*), 4)::DOUBLE AS null_percentage FROM customer"""


def _complete(attribute: str, source: str, kept: str) -> str:
    return f"""
SELECT '{attribute}' AS attribute, count({source}) AS source_values, count({kept}) AS target_values,
  count({source}) = count({kept}) AS preserved FROM customer"""


def _all_targets() -> str:
    """All items of the four targets; lines have an id that grows over the whole table."""
    line_id = "|| (l_orderkey * 100 + l_linenumber)"
    lines, pages = (part.replace("|| l_linenumber", line_id) for part in (LINES, ORDER_PAGES))
    return f"""
WITH {ARTISTS}, {ALBUMS}, {TRACKS}, {lines}, {ORDER_ITEMS}, {pages}, {PROFILES}, {MEMBERS}, {MEMBER_PAGES}, {STAFF}
SELECT 'MusicCatalog' AS target, * FROM artists
UNION ALL BY NAME SELECT 'MusicCatalog' AS target, * FROM albums
UNION ALL BY NAME SELECT 'MusicCatalog' AS target, * FROM tracks
UNION ALL BY NAME SELECT 'CustomerOrders' AS target, * FROM profiles
UNION ALL BY NAME SELECT 'CustomerOrders' AS target, * FROM order_items
UNION ALL BY NAME SELECT 'CustomerOrders' AS target, * FROM order_pages
UNION ALL BY NAME SELECT 'Playlists' AS target, * FROM containers
UNION ALL BY NAME SELECT 'Playlists' AS target, * FROM member_pages
UNION ALL BY NAME SELECT 'EmployeeManagement' AS target, * FROM employees"""


def sql() -> dict[str, str]:
    """SQL by query name."""
    found = {
        "order_documents": f"WITH {LINES}, {ORDER_ITEMS} SELECT * FROM order_items",
        "customer_profiles": f"WITH {PROFILES} SELECT * FROM profiles",
        "customer_orders_target": f"{CUSTOMER_TARGET} SELECT * FROM target",
        "customer_orders_whole": f"""
WITH o AS (SELECT o_orderkey, count(l_orderkey) AS n FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey)
SELECT 'CustomerProfile' AS "EntityType", count(*) AS items, CAST(NULL AS BIGINT) AS lines, CAST(NULL AS BIGINT) AS paged_lines,
  CAST(NULL AS BIGINT) AS held_lines FROM customer
UNION ALL SELECT 'Order', count(*), CAST(sum(n) AS BIGINT), NULL, CAST(sum(n) FILTER (n <= {ORDER_CAP}) AS BIGINT) FROM o
UNION ALL SELECT 'OrderLinesPage', CAST(sum(ceil(n / {ORDER_CAP}.0)) AS BIGINT), NULL, CAST(sum(n) AS BIGINT), CAST(sum(n) AS BIGINT)
FROM o WHERE n > {ORDER_CAP}""",
        "root_rollup": f"WITH {ARTISTS} SELECT * FROM artists",
        "mid_rollup": f"WITH {ALBUMS} SELECT * FROM albums",
        "leaf_enriched": f"WITH {TRACKS} SELECT * FROM tracks",
        "catalog_target": f"{CATALOG} SELECT * FROM catalog",
        "container_members": f"WITH {MEMBERS} SELECT * FROM containers",
        "container_pages": f"WITH {PAGES} SELECT * FROM pages",
        "containers_target": f"""
WITH pairs AS (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem),
sizes AS (SELECT p_partkey, count(l_suppkey) AS n FROM part LEFT JOIN pairs ON l_partkey = p_partkey GROUP BY p_partkey)
SELECT 'Playlist' AS "EntityType", count(*) AS items, CAST(sum(n) AS BIGINT) AS members,
  CAST(NULL AS BIGINT) AS paged_members,
  CAST(sum(CASE WHEN n <= {MEMBER_CAP} THEN n ELSE 0 END) AS BIGINT) AS listed_members FROM sizes
UNION ALL
SELECT 'PlaylistTracksPage', CAST(sum(ceil(n / {MEMBER_CAP}.0)) AS BIGINT), NULL, CAST(sum(n) AS BIGINT), CAST(sum(n) AS BIGINT)
FROM sizes WHERE n > {MEMBER_CAP} HAVING count(*) > 0""",
        "container_counts": """
SELECT p_partkey AS "PlaylistId", p_name AS "Name", count(l_suppkey) AS "TrackCount"
FROM part LEFT JOIN lineitem ON l_partkey = p_partkey GROUP BY p_partkey, p_name""",
        "member_sample": f"""
SELECT s_suppkey AS "TrackId", s_name AS "TrackName", s_suppkey * 10 AS "Milliseconds",
  CAST(CAST(s_acctbal AS {MONEY}) AS DOUBLE) AS "UnitPrice", r_name AS "ArtistName", n_name AS "AlbumTitle"
FROM (SELECT DISTINCT l_suppkey FROM lineitem WHERE l_partkey = 1)
JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey
ORDER BY s_name, s_suppkey LIMIT 5""",
        "staff_items": f"WITH {STAFF} SELECT * FROM employees",
        "order_totals": f"""
SELECT c_custkey AS "CustomerId", split_part(c_name, '#', 1) AS "FirstName", split_part(c_name, '#', 2) AS "LastName",
  lower(c_name) || '@example.com' AS "Email", n_name AS "Country", c_mktsegment AS "City",
  nullif(c_mktsegment, 'BUILDING') AS "Company", count(o_orderkey) AS "OrderCount",
  CAST(coalesce(sum(CAST(o_totalprice AS {MONEY})), 0) AS DOUBLE) AS "TotalSpent"
FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey LEFT JOIN orders ON o_custkey = c_custkey
GROUP BY c_custkey, c_name, n_name, c_mktsegment""",
        "hierarchy_tree": f"""
WITH flat AS (
  SELECT r_regionkey, r_name, n_nationkey, n_name, c_custkey, c_name,
    (row_number() OVER (PARTITION BY r_regionkey ORDER BY n_nationkey NULLS FIRST, c_custkey NULLS FIRST) - 1) // {PAGE} + 1 AS page
  FROM region LEFT JOIN nation ON n_regionkey = r_regionkey LEFT JOIN customer ON c_nationkey = n_nationkey),
nations AS (
  SELECT r_regionkey, r_name, page, n_nationkey, count(c_custkey) AS n,
    '{{"n_nationkey":' || n_nationkey || ',"n_name":"' || n_name || '","leaves":['
    || coalesce(string_agg('{{"c_custkey":' || c_custkey || ',"c_name":"' || c_name || '"}}', ',' ORDER BY c_custkey), '') || ']}}' AS j
  FROM flat GROUP BY r_regionkey, r_name, page, n_nationkey, n_name)
SELECT CAST(r_regionkey AS BIGINT) AS r_regionkey, r_name, CAST(page AS BIGINT) AS page, CAST(sum(n) AS BIGINT) AS leaf_count,
  '[' || coalesce(string_agg(j, ',' ORDER BY n_nationkey), '') || ']' AS children
FROM nations GROUP BY r_regionkey, r_name, page""",
        "catalog_tree": f"""
WITH flat AS (
  SELECT n_nationkey, n_name, c_custkey, c_name, o_orderkey,
    (row_number() OVER (PARTITION BY n_nationkey ORDER BY c_custkey NULLS FIRST, o_orderkey NULLS FIRST) - 1) // {PAGE} + 1 AS page
  FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey LEFT JOIN orders ON o_custkey = c_custkey),
albums AS (
  SELECT n_nationkey, n_name, page, c_custkey, count(o_orderkey) AS n,
    '{{"AlbumId":' || c_custkey || ',"AlbumTitle":"' || c_name || '","leaves":['
    || coalesce(string_agg('{{"TrackId":' || o_orderkey || ',"TrackName":"Order ' || o_orderkey || '"}}', ',' ORDER BY o_orderkey), '') || ']}}' AS j
  FROM flat GROUP BY n_nationkey, n_name, page, c_custkey, c_name)
SELECT CAST(n_nationkey AS BIGINT) AS "ArtistId", n_name AS "ArtistName", CAST(page AS BIGINT) AS page,
  CAST(sum(n) AS BIGINT) AS leaf_count, '[' || coalesce(string_agg(j, ',' ORDER BY c_custkey), '') || ']' AS children
FROM albums GROUP BY n_nationkey, n_name, page""",
        "typed_items": f"""
SELECT 'CUSTOMER#' || c_custkey AS "PK",
  '{{"PK":{{"S":"CUSTOMER#' || c_custkey || '"}},"SK":{{"S":"PROFILE"}},"CustomerId":{{"N":"' || c_custkey || '"}}'
  || CASE WHEN c_mktsegment <> 'BUILDING' THEN ',"Segment":{{"S":"' || c_mktsegment || '"}}' ELSE '' END
  || ',"Balance":{{"N":"' || CAST(CAST(c_acctbal AS {MONEY}) AS VARCHAR) || '"}}'
  || ',"RawBalance":{{"N":"' || CAST(c_acctbal AS VARCHAR) || '"}}'
  || CASE WHEN c_acctbal < 0 THEN ',"Overdrawn":{{"BOOL":true}}' ELSE '' END
  || ',"Names":{{"L":[{{"M":{{"Name":{{"S":"' || c_name || '"}},"Nation":{{"N":"' || c_nationkey || '"}}}}}}]}}}}' AS item
FROM customer""",
        "lookup_collection": f"""{CUSTOMER_TARGET}
SELECT "PK", "SK", "EntityType", "Total", "TotalOrders" FROM target WHERE "PK" = 'CUSTOMER#1'""",
        "lookup_prefix": f"""{CUSTOMER_TARGET}
SELECT "PK", "SK", "InvoiceId", "Total", "LineItemCount" FROM target WHERE "PK" = 'CUSTOMER#7' AND starts_with("SK", 'ORDER#')""",
        "lookup_recent": f"""{CUSTOMER_TARGET}
SELECT "PK", "SK", "InvoiceId", "Total" FROM target WHERE "PK" = 'CUSTOMER#7' AND starts_with("SK", 'ORDER#')
ORDER BY "SK" DESC LIMIT 20""",
        "lookup_point": f"""{CUSTOMER_TARGET}
SELECT "PK", "SK", "Email", "TotalOrders", "TotalSpent" FROM target WHERE "PK" = 'CUSTOMER#3' AND "SK" = 'PROFILE'""",
        "lookup_parent": f"""{CATALOG}
SELECT "PK", "SK", "EntityType", "Name", "Title", "AlbumCount", "TrackCount", lower("EntityType") AS part
FROM catalog WHERE "PK" = 'ARTIST#4'""",
        "lookup_children": f"""{CATALOG}
SELECT "PK", "SK", "Name", "AlbumTitle", "UnitPrice", "GenreName" FROM catalog WHERE "PK" = 'ALBUM#5'""",
        "lookup_index": f"""{CATALOG}
SELECT "GSI1PK", "GSI1SK", "PK", "SK", "EntityType" FROM catalog
WHERE "GSI1PK" IN ('ALBUM_TITLE#Customer#000000009', 'ARTIST_NAME#NATION_3', 'TRACK_NAME#Order 12')""",
        "lookup_by_email": f"""WITH {PROFILES}
SELECT "GSI1PK", "PK", "SK", "FirstName", "LastName" FROM profiles WHERE "Email" = 'customer#000000011@example.com'""",
        "lookup_genre": f"""{CATALOG}
SELECT "GSI2PK", "PK", "SK", "Name" FROM catalog WHERE "GSI2PK" = 'GENRE#ASIA' ORDER BY "SK" LIMIT 50""",
        "index_sizes": f"""
SELECT 'GENRE#' || r_name AS "GSI2PK", count(*) AS items, CAST(sum(CAST(o_totalprice AS {MONEY})) AS DOUBLE) AS price
FROM orders JOIN customer ON c_custkey = o_custkey JOIN region ON r_regionkey = CAST(substr(o_orderpriority, 1, 1) AS INTEGER)
GROUP BY r_name""",
        "lookup_page": f"""WITH {PAGES}
SELECT "PK", "SK", "Page", "PageTrackCount" FROM pages WHERE "PK" = 'PLAYLIST#2' AND "SK" = 'TRACKS_PAGE#1'""",
        "lookup_batch": f"""{CUSTOMER_TARGET}
SELECT "PK", "SK", "EntityType", "InvoiceId", "TotalOrders" FROM target
WHERE "PK" IN (SELECT 'CUSTOMER#' || c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""",
        "entity_scan": f"""WITH {ALBUMS} SELECT "PK", "SK", "Title", "ArtistName", "TrackCount" FROM albums""",
        "latest_orders": f"""
SELECT "PK", "SK", o_orderkey, o_totalprice FROM (
  SELECT 'CUSTOMER#' || o_custkey AS "PK", 'ORDER#' || strftime(o_orderdate, '{ISO}') || '#' || o_orderkey AS "SK",
    o_orderkey, o_totalprice,
    row_number() OVER (PARTITION BY o_custkey ORDER BY strftime(o_orderdate, '{ISO}') || '#' || o_orderkey DESC) AS rn
  FROM orders) WHERE rn <= 3""",
        "access_counts": """
SELECT 'customer with orders' AS pattern,
  (SELECT count(*) FROM customer WHERE c_custkey = 1) + (SELECT count(*) FROM orders WHERE o_custkey = 1)
  + (SELECT CAST(coalesce(sum((n + 4) // 5), 0) AS BIGINT) FROM (SELECT count(*) AS n FROM lineitem JOIN orders ON o_orderkey = l_orderkey
     WHERE o_custkey = 1 GROUP BY l_orderkey) WHERE n > 5) AS items
UNION ALL SELECT 'customer orders', (SELECT count(*) FROM orders WHERE o_custkey = 1)
UNION ALL SELECT 'orders of a month', (SELECT count(*) FROM orders WHERE o_custkey = 2 AND strftime(o_orderdate, '%Y') = '1998')
UNION ALL SELECT 'profile', (SELECT count(*) FROM customer WHERE c_custkey = 9)
UNION ALL SELECT 'unknown', 0""",
        "database_overview": f"""
WITH counts AS ({_counts()})
SELECT "table", row_count, round(100.0 * row_count / (SELECT sum(row_count) FROM counts), 2)::DOUBLE AS percentage,
  (SELECT count(*) FROM counts) AS total_tables, (SELECT CAST(sum(row_count) AS BIGINT) FROM counts) AS total_rows FROM counts""",
        "schema_catalog": _schema_catalog(),
        "relationship_report": _relationships(),
        "uniqueness_report": _uniqueness(),
        "duplicate_lines": """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, count(*) AS rows FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
        "missing_rates": " UNION ALL ".join(
            [
                _missing("c_custkey", "c_custkey"),
                _missing("segment", "nullif(c_mktsegment, 'BUILDING')"),
                _missing("balance", "CASE WHEN c_acctbal >= 0 THEN c_acctbal END"),
                _missing("nation", "nullif(c_nationkey, 3)"),
            ]
        ),
        "entity_counts": """
SELECT 'Artist' AS "EntityType", count(*) AS items FROM nation
UNION ALL SELECT 'Album', count(*) FROM customer JOIN nation ON n_nationkey = c_nationkey
UNION ALL SELECT 'Track', count(*) FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey""",
        "reconcile_counts": """
WITH c AS (
  SELECT 'MusicCatalog' AS name, (SELECT count(*) FROM nation) + (SELECT count(*) FROM customer) + (SELECT count(*) FROM orders) AS s,
    (SELECT count(*) FROM nation) + (SELECT count(*) FROM customer) + (SELECT count(*) FROM orders) AS t
  UNION ALL SELECT 'CustomerOrders', (SELECT count(*) FROM customer) + (SELECT count(*) FROM orders),
    (SELECT count(*) FROM customer) + (SELECT count(*) FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer))
  UNION ALL SELECT 'Playlists', (SELECT count(*) FROM part), (SELECT count(*) FROM part)
  UNION ALL SELECT 'EmployeeManagement', (SELECT count(*) FROM supplier), (SELECT count(*) FROM supplier WHERE s_suppkey % 10 <> 0))
SELECT name, s AS source_count, t AS target_count, s = t AS count_match FROM c""",
        "reconcile_by_entity": """
WITH c AS (
  SELECT 'Artist' AS name, count(*) AS n FROM nation UNION ALL SELECT 'Album', count(*) FROM customer
  UNION ALL SELECT 'Track', count(*) FROM orders)
SELECT name, n AS source_count, n AS target_count, true AS count_match FROM c""",
        "checksums": f"""
WITH d AS (
  SELECT md5(concat_ws('|', o_orderkey, o_custkey, o_orderstatus, o_orderpriority,
    CAST(CAST(o_totalprice AS {MONEY}) * 100 AS BIGINT))) AS d FROM orders)
SELECT substr(d, 1, 1) AS bucket, count(*) AS row_count, CAST(sum(CAST('0x' || substr(d, 1, 8) AS BIGINT)) AS DOUBLE) AS digest_1,
  CAST(sum(CAST('0x' || substr(d, 9, 8) AS BIGINT)) AS DOUBLE) AS digest_2, CAST(sum(CAST('0x' || substr(d, 17, 8) AS BIGINT)) AS DOUBLE) AS digest_3,
  CAST(sum(CAST('0x' || substr(d, 25, 8) AS BIGINT)) AS DOUBLE) AS digest_4
FROM d GROUP BY substr(d, 1, 1)""",
        "checksum_sides": "SELECT count(*) AS row_count, CAST(1 AS BIGINT) AS different_checksums, CAST(2 AS BIGINT) AS sides FROM orders",
        "sample_mismatch": f"""
SELECT * FROM (SELECT 'CUSTOMER#' || o_custkey AS "PK", 'ORDER#' || strftime(o_orderdate, '{ISO}') || '#' || o_orderkey AS "SK",
  CASE WHEN o_orderkey % 97 = 5 THEN 'missing' ELSE 'altered' END AS issue
FROM orders WHERE o_orderkey % 97 = 5 OR o_orderkey % 89 = 3)
WHERE CAST('0x' || substr(md5('0|' || "PK" || '|' || "SK"), 1, 15) AS BIGINT) <= {int(0.5 * (16**15 - 1))}""",
        "completeness": " UNION ALL ".join(
            [
                _complete("Company", "nullif(c_mktsegment, 'BUILDING')", "nullif(c_mktsegment, 'BUILDING')"),
                _complete("Address", "c_name", "CASE WHEN c_acctbal >= 0 THEN c_name END"),
                _complete("City", "c_mktsegment", "c_mktsegment"),
                _complete("Fax", "''", "CAST(NULL AS VARCHAR)"),
                _complete("PostalCode", "c_custkey", "c_custkey"),
            ]
        ),
        "computed_recheck": f"""
SELECT c_custkey AS "CustomerId", count(o_orderkey) + 1 AS "stored_TotalOrders",
  CAST(coalesce(sum(CAST(o_totalprice AS {MONEY})), 0) AS DOUBLE) AS "stored_TotalSpent",
  count(o_orderkey) AS "expected_TotalOrders",
  CAST(coalesce(sum(CAST(o_totalprice AS {MONEY})), 0) AS DOUBLE) AS "expected_TotalSpent"
FROM customer LEFT JOIN orders ON o_custkey = c_custkey WHERE c_custkey % 10 = 0 GROUP BY c_custkey""",
        "orphans": """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey, l_quantity FROM lineitem
WHERE NOT EXISTS (SELECT 1 FROM part WHERE p_partkey = l_partkey AND p_size > 5)""",
        "extraction_metrics": """
SELECT 'orders' AS source, count(*) AS rows, count(*) FILTER (WHERE NOT o_orderdate >= TIMESTAMP '1996-01-01') AS early,
  count(*) FILTER (WHERE NOT o_totalprice < 400000) AS large FROM orders""",
        "quality_rejects": """
SELECT * FROM (
  SELECT o_orderkey, CASE WHEN NOT o_totalprice > 1000 THEN 'positive price' WHEN o_orderstatus = 'P' THEN 'status required'
    WHEN o_orderpriority <> '5-LOW' THEN 'o_orderpriority as bigint' END AS failed_rule FROM orders)
WHERE failed_rule IS NOT NULL""",
        "column_rules": """
SELECT c_custkey, lower(c_name) AS name, '+1' || c_custkey || '5500' AS phone, lower(c_mktsegment) AS segment,
  CAST(split_part(c_name, '#', 2) AS BIGINT) AS number, CAST(NULL AS BIGINT) AS bad_number FROM customer""",
        "masked_copy": """
SELECT c_custkey, regexp_replace(c_name, '[0-9]', 'n', 'g') AS c_name, sha256('pepper:' || CAST(c_nationkey AS VARCHAR)) AS c_nationkey,
  CAST(NULL AS DOUBLE) AS c_acctbal, md5('pepper:' || c_mktsegment) AS c_mktsegment FROM customer""",
        "oversize_items": f"""
WITH {LINES}, {ORDER_ITEMS}, sized AS (
  SELECT "PK", "SK", "LineItemCount", CAST(strlen('{{"PK":"' || "PK" || '","SK":"' || "SK" || '","LineItemCount":' || "LineItemCount"
    || CASE WHEN "LineItems" IS NOT NULL THEN ',"LineItems":' || "LineItems" ELSE '' END || '}}') AS BIGINT) AS item_bytes FROM order_items)
SELECT * FROM sized WHERE item_bytes > 600""",
        "timestamp_extract": """
SELECT o_orderkey, o_custkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS placed FROM orders
WHERE o_orderdate > TIMESTAMP '1998-01-01'""",
        "highwater_extract": "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderkey > 0",
        "snapshot_diff": f"""
WITH {SNAPSHOTS}
SELECT CASE WHEN o.o_orderkey IS NULL THEN 'insert' WHEN n.o_orderkey IS NULL THEN 'delete'
    WHEN o.o_totalprice <> n.o_totalprice THEN 'update' ELSE 'same' END AS op,
  coalesce(o.o_orderkey, n.o_orderkey) AS o_orderkey, n.o_custkey, n.o_orderstatus, n.o_totalprice
FROM old o FULL OUTER JOIN new n ON o.o_orderkey = n.o_orderkey""",
        "snapshot_apply": f"WITH {SNAPSHOTS} SELECT * FROM new",
        "upsert_latest": f"WITH {CHANGES} SELECT * FROM upserted",
        "upsert_with_deletes": f"WITH {CHANGES} SELECT * FROM upserted WHERE NOT (o_totalprice = 2.0 AND o_orderkey % 2 = 0)",
        "upsert_replay": f"""WITH {CHANGES}
SELECT * FROM upserted WHERE o_orderkey <> 0
UNION ALL SELECT o_orderkey, NULL, 'Z', NULL FROM orders WHERE o_orderkey = 0""",
        "latest_lines": """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey, l_quantity FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC) AS rn FROM lineitem) WHERE rn = 1""",
        "refresh_equivalence": _all_targets(),
        "load_with_updates_and_deletes": f"{CATALOG} SELECT * FROM catalog",
        "index_after_upsert": f"""{CATALOG}
SELECT 'ALBUM_TITLE#Renamed' AS "GSI1PK", "PK", "SK", 'Renamed' AS "Title", "EntityType" FROM catalog
WHERE "EntityType" = 'Album' AND "AlbumId" = 9
UNION ALL SELECT "GSI1PK", "PK", "SK", "Title", "EntityType" FROM catalog
WHERE "GSI1PK" = 'ARTIST_NAME#NATION_3' OR "GSI1PK" = 'ALBUM_TITLE#Customer#000000009' AND "AlbumId" <> 9""",
        "lookup_loaded_index": f"""{CATALOG}
SELECT "PK", "SK", "EntityType", "GSI1PK", "GSI2PK", "UnitPrice" FROM catalog
WHERE "GSI1PK" = 'ALBUM_TITLE#Customer#000000009' OR "GSI2PK" = 'GENRE#ASIA'""",
        "load_validation": """
WITH c AS (
  SELECT 'MusicCatalog' AS target, 'Artist' AS entity, count(*) AS n FROM nation
  UNION ALL SELECT 'MusicCatalog', 'Album', count(*) FROM customer
  UNION ALL SELECT 'MusicCatalog', 'Track', count(*) FROM orders
  UNION ALL SELECT 'EmployeeManagement', 'Employee', count(*) FROM supplier)
SELECT target, entity, n AS source_count, n AS target_count, true AS count_match, CAST(0 AS BIGINT) AS stale_items FROM c""",
        "feed_upsert": """
SELECT user_id, event_id, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events) WHERE rn = 1""",
        "feed_late_after_delete": """
SELECT user_id, event_id, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events)
WHERE rn = 1 AND (event_id % 2 = 0 OR NOT coalesce(value > 50, false))""",
        "load_late_rows": f"{CATALOG} SELECT * FROM catalog",
        "load_rejects": f"""{CATALOG}, marked AS (
  SELECT *, CASE WHEN "EntityType" = 'Track' AND coalesce("UnitPrice", 0) < 50000 THEN 'price'
    WHEN coalesce(length(coalesce("Name", "Title")) > 11, true) THEN 'name' END AS failed_rule FROM catalog)
SELECT "PK", "SK", "EntityType", failed_rule, (SELECT count(*) FROM catalog) AS rows FROM marked WHERE failed_rule IS NOT NULL""",
        "access_counts_table": """
SELECT CAST(c_custkey AS VARCHAR) AS pattern, count(o_orderkey) AS items
FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND year(o_orderdate) = 1997 GROUP BY c_custkey""",
        "reconcile_tree": """
SELECT o_orderkey, CASE WHEN o_orderkey % 1009 = 7 THEN 'missing' ELSE 'altered' END AS issue
FROM orders WHERE o_orderkey % 1009 = 7 OR o_orderkey % 997 = 5 AND o_totalprice + 1 <> o_totalprice
UNION ALL SELECT -1 - o_orderkey, 'unexpected' FROM orders WHERE o_orderkey % 1013 = 9""",
    }
    found |= {f"profile_{t}": _profile(t) for t in PROFILED}
    found["profile_two_loads"] = f"SELECT *, true AS estimate_holds FROM ({_profile('lineitem')})"
    return found
