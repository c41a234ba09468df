"""The registered queries in SQL over the benchmark tables themselves, without any notification."""

from __future__ import annotations

_EVENTS = """
e AS (
  SELECT user_id, epoch_us(ts) // 1000 AS t, value, event_type, event_id, ts,
         (event_id * 7919) % 100003 + (event_id // 100003) * 100003 AS a
  FROM events
)"""

_HOURLY = (
    _EVENTS
    + """,
h AS (
  SELECT *, epoch_ms(date_trunc('hour', ts)) AS hour_ms FROM e
),
r AS (
  SELECT *, row_number() OVER (PARTITION BY user_id, hour_ms ORDER BY a) AS rn,
         row_number() OVER (PARTITION BY user_id, hour_ms ORDER BY a DESC) AS back
  FROM h
)"""
)


def _fold(deleted: str = "FALSE", time: str = "t", where: str = "TRUE") -> str:
    """Common table `acc`: the accepted rows of the lastdata fold."""
    return f"""
x AS (SELECT *, {time} AS tt, {deleted} AS gone FROM e WHERE {where}),
cut AS (SELECT user_id, max(a) FILTER (WHERE gone) AS last_cut FROM x GROUP BY user_id),
alive AS (SELECT x.* FROM x JOIN cut USING (user_id) WHERE last_cut IS NULL OR a > last_cut),
m AS (
  SELECT *, max(tt) OVER (PARTITION BY user_id ORDER BY a ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS high
  FROM alive
),
acc AS (SELECT * FROM m WHERE high IS NULL OR tt IS NULL OR tt > high)"""


_LATEST = f"""
WITH {_EVENTS},
n AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY t DESC, a) AS rn FROM e)
SELECT 'U' || user_id AS entityid, t AS ts_ms, value, event_type AS kind FROM n WHERE rn = 1
"""

_LAST_ACCEPTED = """
SELECT 'U' || user_id AS entityid, tt AS ts_ms, value, event_type AS kind
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY a DESC) AS rn FROM acc) WHERE rn = 1
"""

_REFOLDED = (
    f"WITH {_EVENTS},{_fold('event_type = ' + chr(39) + 'error' + chr(39), 'CASE WHEN event_type <> ' + chr(39) + 'view' + chr(39) + ' THEN t END')}"
    f" {_LAST_ACCEPTED}"
)

_STREAM_HISTORIC = f"""
            WITH {_HOURLY}
            SELECT 'U' || user_id AS entityid, CASE WHEN rn = 1 THEN hour_ms END AS ts_ms, value, CASE WHEN rn = 1 THEN event_type END AS kind,
              CASE WHEN rn = 1 THEN 'stored' ELSE 'city DUPLICATE_KEY ' || a END AS outcome FROM r"""

_SANE = "regexp_replace(lower(regexp_replace(trim({0}), '^/|/$', '', 'g')), '[^a-zA-Z0-9_]', '_', 'g')"

_CUSTOMER = """
c AS (
  SELECT c_custkey, lower(n_name) AS tenant, lower(c_mktsegment) AS path, c_mktsegment, c_name
  FROM customer JOIN nation ON c_nationkey = n_nationkey
)"""

_ORDER_ENTITIES = """
oe AS (
  SELECT *, 0 AS entity_pos, 'O' || o_orderkey AS entityid, 'Order' AS entitytype FROM orders
  UNION ALL
  SELECT *, 1, 'C' || o_custkey, 'Customer' FROM orders
)"""

_ISO = "strftime({0}, '%Y-%m-%dT%H:%M:%S.') || lpad(CAST(epoch_ms({0}) % 1000 AS VARCHAR), 3, '0') || 'Z'"

_NUMBER = "CASE WHEN {0} = round({0}, 0) THEN CAST(CAST({0} AS BIGINT) AS VARCHAR) ELSE CAST({0} AS VARCHAR) END"

_SHAPE = """
s AS (
  SELECT p_partkey, p_size, p_partkey % 8 AS form,
         CAST(p_partkey % 170 AS VARCHAR) AS x, CAST(p_partkey % 80 AS VARCHAR) AS y
  FROM part
),
g AS (
  SELECT *, x || '.5 ' || y || '.25' AS p1,
         x || '.5 ' || y || '.25, ' || x || '.75 ' || y || '.5' AS line,
         x || ' ' || y || ', ' || x || '.5 ' || y || ', ' || x || '.5 ' || y || '.5, ' || x || ' ' || y AS ring
  FROM s
),
w AS (
  SELECT *, CASE form WHEN 0 THEN 'POINT (' || p1 || ')' WHEN 1 THEN 'LINESTRING (' || line || ')'
    WHEN 2 THEN 'POLYGON ((' || ring || '))' WHEN 3 THEN 'MULTIPOINT (' || line || ')'
    WHEN 4 THEN 'MULTILINESTRING ((' || line || '))' WHEN 5 THEN 'MULTIPOLYGON (((' || ring || ')))' END AS wkt
  FROM g
)"""

_LOG = """
l AS (
  SELECT CASE WHEN event_type <> 'view' THEN event_type ELSE 'unknown' END AS flow,
         CASE WHEN user_id % 7 <> 0 THEN 't' || (user_id % 5) ELSE 'default' END AS service,
         CASE WHEN event_type = 'error' THEN 'error' ELSE 'success' END AS result,
         greatest(value - 2.0, 0.0) AS duration_s, ts
  FROM events
)"""

_VIOLATIONS = f"""
{_ORDER_ENTITIES},
v AS (
  SELECT *, 'shop.' || lower(o_orderstatus) || '_' || lower(entitytype) AS target FROM oe
),
bad AS (
  SELECT target, '' AS "column", 'TABLE_MISSING' AS code, o_orderkey, entity_pos, 0 AS rank,
         'ERROR: relation "' || target || '" does not exist' AS error
  FROM v WHERE entity_pos = 1
  UNION ALL
  SELECT target, 'total', 'TYPE_MISMATCH', o_orderkey, entity_pos, 1,
         'ERROR: column "total" is of type boolean but expression is of type double precision'
  FROM v WHERE entity_pos = 0 AND o_orderstatus = 'O'
  UNION ALL
  SELECT target, 'note', 'NULL_VALUE', o_orderkey, entity_pos, 2,
         'ERROR: null value in column "note" violates not-null constraint'
  FROM v WHERE entity_pos = 0 AND o_orderstatus = 'O'
  UNION ALL
  SELECT target, 'urgent', 'UNKNOWN_COLUMN', o_orderkey, entity_pos, 1,
         'ERROR: column "urgent" of relation does not exist'
  FROM v WHERE entity_pos = 0 AND o_orderstatus = 'P'
)"""

_DEAD = """
d AS (
  SELECT o_orderkey, o_orderkey % 4 AS w, CAST(o_orderkey AS VARCHAR) AS k, lower(o_orderstatus) AS st,
         CASE WHEN o_totalprice = round(o_totalprice, 0) THEN CAST(CAST(o_totalprice AS BIGINT) AS VARCHAR)
              ELSE CAST(o_totalprice AS VARCHAR) END AS total,
         CASE WHEN o_orderstatus = 'F' THEN 'true' ELSE 'false' END AS done
  FROM orders
),
dl AS (
  SELECT *, CASE WHEN w = 0 THEN 'shop' ELSE st END AS tenant,
    CASE w WHEN 0 THEN 'ERROR: duplicate key ' || k || ' - Detail: Key exists.'
           WHEN 1 THEN 'Sink failed for ' || k || chr(10) || 'Caused by: timeout'
           WHEN 2 THEN 'Value too big' ELSE 'Unknown error' END AS error,
    CASE w WHEN 0 THEN 'INSERT INTO "shop.orders" ("id","total") VALUES (' || k || ',1.5)'
           WHEN 3 THEN '{"id":' || k || '}'
           ELSE 'INSERT INTO "' || st || '"."' || CASE WHEN w = 1 THEN 'orders_lastdata' ELSE 'unknown_table' END ||
                '" ("entityid","total","note","done") VALUES (''O''''' || k || ''',' || total || ',NULL,' || done || ')' END AS query
  FROM d
)"""

_ESCAPED = "replace(replace(replace({0}, '\\', '\\\\'), '\"', '\\\"'), chr(10), '\\n')"

_SLUG = "trim(regexp_replace(lower(strip_accents({0})), '[^a-z0-9]+', '-', 'g'), '-')"


def oracle() -> dict[str, str]:
    """SQL by query name."""
    route_1 = f"WITH {_CUSTOMER} SELECT tenant AS target_schema, path || '_key_account_lastdata' AS target_table, count(*) AS n FROM c GROUP BY ALL"
    route_2 = f"WITH {_CUSTOMER} SELECT path AS target_schema, path || '_key_account' AS target_table, count(*) AS n FROM c GROUP BY ALL"
    route_3 = f"WITH {_CUSTOMER} SELECT path AS target_schema, 'key_account_mutable' AS target_table, count(*) AS n FROM c GROUP BY ALL"
    sql = {
        "lastdata_latest": _LATEST,
        "lastdata_fold": _LATEST,
        "lastdata_onto_existing": f"""
            WITH {_EVENTS},
            n AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY t DESC, event_type <> 'signup', a) AS rn FROM e)
            SELECT 'U' || user_id AS entityid, t AS ts_ms, value, event_type AS kind FROM n WHERE rn = 1""",
        "stream_lastdata": _LATEST,
        "stream_restart": _LATEST,
        "lastdata_with_deletes": f"WITH {_EVENTS},{_fold('event_type = ' + chr(39) + 'error' + chr(39))} {_LAST_ACCEPTED}",
        "lastdata_no_time": f"WITH {_EVENTS},{_fold(time='CASE WHEN event_type <> ' + chr(39) + 'view' + chr(39) + ' THEN t END')} {_LAST_ACCEPTED}",
        "lastdata_partial_columns": f"""
            WITH {_EVENTS},{_fold()}
            SELECT 'U' || user_id AS entityid, arg_max(tt, a) AS ts_ms,
                   arg_max(value, a) FILTER (WHERE event_type IN ('click', 'purchase')) AS value,
                   arg_max(event_type, a) FILTER (WHERE event_type <> 'view') AS kind
            FROM acc GROUP BY user_id""",
        "entities_flat": f"""
            WITH {_ORDER_ENTITIES}
            SELECT o_orderkey AS "offset", entity_pos, entityid, entitytype, 'shop' AS service,
                   '/' || lower(o_orderstatus) AS servicepath FROM oe""",
        "attributes_long": """
            SELECT attr_name, kind, count(*) AS n FROM lineitem,
            (VALUES ('timeinstant', 'string'), ('quantity', 'double'), ('price', 'double'), ('shipped', 'timestamp'),
                    ('flag', 'string')) AS k(attr_name, kind)
            GROUP BY ALL""",
        "attributes_typed": f"""
            WITH {_ORDER_ENTITIES}
            SELECT o_orderkey AS "offset", entity_pos, attr_name, attr_pos, kind,
              CASE attr_name WHEN 'timeinstant' THEN {_ISO.format('o_orderdate')} WHEN 'status' THEN o_orderstatus END AS v_string,
              CASE attr_name WHEN 'total' THEN o_totalprice END AS v_double,
              CASE attr_name WHEN 'urgent' THEN o_orderpriority LIKE '1%' END AS v_bool,
              CASE attr_name WHEN 'ordered' THEN epoch_ms(o_orderdate) END AS v_ms,
              attr_name = 'note' AS is_null
            FROM oe, (VALUES ('timeinstant', 0, 'string'), ('total', 1, 'double'), ('status', 2, 'string'),
                             ('ordered', 3, 'timestamp'), ('urgent', 4, 'boolean'), ('note', 5, 'string'))
                     AS k(attr_name, attr_pos, kind)""",
        "nested_json_text": """
            SELECT 'E' || event_id AS entityid, attr_name, 'string' AS kind,
              CASE attr_name WHEN 'props' THEN CAST(json(props) AS VARCHAR)
                WHEN 'listed' THEN '["' || event_type || '","' || user_id || '"]'
                WHEN 'quoted' THEN '"' || event_type || '"' ELSE CAST(user_id AS VARCHAR) END AS v_string
            FROM events, (VALUES ('props'), ('listed'), ('quoted'), ('loose')) AS k(attr_name)""",
        "timestamps_parsed": """
            WITH o AS (
              SELECT o_orderkey, o_orderkey % 10 AS f,
                o_orderdate + to_hours(o_custkey % 24) + to_minutes(o_orderkey % 60) AS ts FROM orders)
            SELECT 'O' || o_orderkey AS entityid, CASE WHEN f = 9 THEN 'string' ELSE 'timestamp' END AS kind,
              CASE f WHEN 0 THEN epoch_ms(date_trunc('day', ts)) WHEN 1 THEN epoch_ms(date_trunc('hour', ts))
                WHEN 6 THEN epoch_ms(ts) - 7200000 WHEN 7 THEN epoch_ms(ts) - 7200000
                WHEN 8 THEN epoch_ms(ts) + 19800000 WHEN 9 THEN NULL ELSE epoch_ms(ts) END AS ms,
              f = 9 AS date_error FROM o""",
        "timestamps_week": """
            WITH o AS (SELECT o_orderkey, o_orderkey % 10 AS f, date_trunc('day', o_orderdate) AS d FROM orders)
            SELECT 'O' || o_orderkey AS entityid, CASE WHEN f >= 7 THEN 'string' ELSE 'timestamp' END AS kind,
              CASE f WHEN 0 THEN epoch_ms(d) WHEN 1 THEN epoch_ms(date_trunc('week', d)) WHEN 2 THEN epoch_ms(d)
                WHEN 3 THEN epoch_ms(d) + 36930000 WHEN 4 THEN epoch_ms(d) + 29700000
                WHEN 5 THEN epoch_ms(d) + 86400000 WHEN 6 THEN epoch_ms(d) + 86400000 END AS ms,
              f >= 7 AS date_error FROM o""",
        "change_counts": """
            SELECT 'lastdata' AS flow, CASE event_type WHEN 'error' THEN 'delete' WHEN 'signup' THEN 'create'
              WHEN 'view' THEN 'change' ELSE 'update' END AS change, count(*) AS n FROM events GROUP BY ALL
            UNION ALL
            SELECT 'sgtr', CASE event_type WHEN 'error' THEN 'delete' WHEN 'click' THEN 'update'
              WHEN 'view' THEN 'change' ELSE 'create' END, count(*) FROM events GROUP BY ALL""",
        "deletes_in_batch": f"""
            WITH {_ORDER_ENTITIES}
            SELECT o_orderkey AS "offset", entity_pos, entityid, CASE WHEN o_orderstatus <> 'F' THEN 'update'
              WHEN entity_pos = 0 THEN 'delete' ELSE 'ignored' END AS change FROM oe""",
        "parse_quarantine": """
            WITH p AS (SELECT o_orderkey, substr(o_orderpriority, 1, 1) AS p FROM orders)
            SELECT o_orderkey AS "offset", CASE p WHEN '1' THEN 'BAD_JSON' WHEN '2' THEN 'NO_ENTITIES' WHEN '3' THEN k ELSE 'OK' END AS code
            FROM p, (VALUES ('NULL_ENTITY'), ('NO_ENTITY_ID'), ('OK')) AS x(k)
            WHERE p = '3' OR k = 'OK'""",
        "empty_notifications": "SELECT 'historic' AS flow, count(*) FILTER (WHERE o_orderstatus = 'P') AS no_entities FROM orders",
        "tenant_context": """
            SELECT c_custkey AS "offset", lower(c_mktsegment) AS service, '/seg/' || c_nationkey AS servicepath,
                   CAST(NULL AS VARCHAR) AS datamodel, CAST(NULL AS VARCHAR) AS correlator FROM customer""",
        "header_decode": """
            SELECT c_custkey AS "offset", lower(c_mktsegment) AS service, 2 AS n_headers, 'ñandú' AS note FROM customer""",
        "legacy_normalise": """
            SELECT 'O' || o_orderkey AS entityid, 'Order' AS entitytype, 'old' AS service, '/shop' AS servicepath, attr_name, attr_type,
              kind, CASE WHEN attr_name = 'status' THEN o_orderstatus END AS v_string,
              CASE WHEN attr_name = 'total' THEN o_totalprice END AS v_double
            FROM orders, (VALUES ('total', 'Number', 'double'), ('status', '', 'string')) AS k(attr_name, attr_type, kind)""",
        "historic_append": f"WITH {_HOURLY} SELECT 'U' || user_id AS entityid, hour_ms AS ts_ms, value, event_type AS kind FROM r WHERE rn = 1",
        "historic_rejects": f"""
            WITH {_HOURLY} SELECT 'U' || user_id AS entityid, hour_ms AS ts_ms, a AS "offset", value, 'DUPLICATE_KEY' AS code
            FROM r WHERE rn > 1""",
        "historic_onto_existing": f"""
            WITH {_HOURLY},
            held AS (SELECT DISTINCT user_id, hour_ms FROM h WHERE event_type = 'signup'),
            o AS (SELECT h.*, held.user_id IS NOT NULL AS known,
                    row_number() OVER (PARTITION BY h.user_id, h.hour_ms ORDER BY a) AS nth
                  FROM h LEFT JOIN held ON h.user_id = held.user_id AND h.hour_ms = held.hour_ms
                  WHERE event_type <> 'signup')
            SELECT event_type AS kind, CASE WHEN known OR nth > 1 THEN 'refused' ELSE 'stored' END AS outcome, count(*) AS n
            FROM o GROUP BY ALL""",
        "historic_partitions": f"""
            WITH {_EVENTS},
            h AS (SELECT *, epoch_ms(date_trunc('hour', ts)) AS hour_ms FROM e),
            r AS (SELECT *, row_number() OVER (PARTITION BY user_id, hour_ms ORDER BY a % 5, a) AS rn FROM h)
            SELECT 'U' || user_id AS entityid, hour_ms AS ts_ms, value, CASE WHEN rn = 1 THEN 'STORED' ELSE 'DUPLICATE_KEY' END AS code FROM r""",
        "lastdata_partitions": f"""
            WITH {_EVENTS},
            n AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY t DESC, a % 5, a) AS rn FROM e)
            SELECT 'U' || user_id AS entityid, t AS ts_ms, value, event_type AS kind FROM n WHERE rn = 1""",
        "historic_without_key": "SELECT 'U' || user_id AS entityid, count(*) AS n FROM events GROUP BY user_id",
        "mutable_upsert": f"WITH {_HOURLY} SELECT 'U' || user_id AS entityid, hour_ms AS ts_ms, value, event_type AS kind FROM r WHERE back = 1",
        "mutable_partial": f"""
            WITH {_HOURLY}
            SELECT 'U' || user_id AS entityid, hour_ms AS ts_ms,
                   arg_max(value, a) FILTER (WHERE event_type IN ('click', 'purchase')) AS value,
                   arg_max(event_type, a) FILTER (WHERE event_type <> 'view') AS kind
            FROM h GROUP BY user_id, hour_ms""",
        "route_dm1": route_1,
        "route_dm2": route_2,
        "route_dm3": route_3,
        "route_errors": f"WITH {_CUSTOMER} SELECT tenant AS target_schema, tenant || '_error_log' AS target_table, count(*) AS n FROM c GROUP BY ALL",
        "route_http_errors": f"WITH {_CUSTOMER} SELECT tenant AS target_schema, tenant || '_error_log' AS target_table, count(*) AS n FROM c GROUP BY ALL",
        "route_precedence": f"""
            WITH {_CUSTOMER}
            SELECT c_custkey AS "offset", CASE c_custkey % 4 WHEN 0 THEN path || '.key_account' WHEN 1 THEN path || '.' || path || '_key_account'
              WHEN 2 THEN tenant || '.' || path || '_key_account' END AS target,
              CASE WHEN c_custkey % 4 = 3 THEN 'Unknown datamodel: dm-none' END AS route_error FROM c""",
        "route_missing_path": f"""
            WITH {_CUSTOMER}, p AS (SELECT CASE WHEN c_mktsegment = 'BUILDING' THEN '' ELSE path END AS path FROM c)
            SELECT 'dm-by-entity-type-database' AS model, path || '_key_account' AS target_table, CAST(NULL AS VARCHAR) AS route_error, count(*) AS n
            FROM p GROUP BY ALL
            UNION ALL
            SELECT 'dm-by-entity-type-database-schema', CASE WHEN path <> '' THEN path || '_key_account' END,
              CASE WHEN path = '' THEN 'Required header missing or empty: fiware-servicepath' END, count(*) FROM p GROUP BY ALL""",
        "route_overrides": f"WITH {_CUSTOMER} SELECT 'fixed' AS target_schema, upper(tenant) || '_anything_x' AS target_table, count(*) AS n FROM c GROUP BY ALL",
        "sanitise_names": f"""
            SELECT p_partkey, {_SANE.format('p_name')} AS name, {_SANE.format("' /' || p_brand || '/' || p_type || '//'")} AS path FROM part""",
        "envelope_publish": f"""
            WITH {_ORDER_ENTITIES}
            SELECT o_orderkey AS "offset", entity_pos,
              '{{"schema":{{"type":"struct","fields":[{{"field":"entityid","type":"string","optional":false}},' ||
              '{{"field":"entitytype","type":"string","optional":false}},{{"field":"fiwareservicepath","type":"string","optional":false}},' ||
              '{{"field":"timeinstant","type":"string","optional":false}},{{"field":"total","type":"double","optional":false}},' ||
              '{{"field":"status","type":"string","optional":false}},' ||
              '{{"field":"ordered","type":"int64","name":"org.apache.kafka.connect.data.Timestamp","optional":false}},' ||
              '{{"field":"urgent","type":"boolean","optional":false}},{{"field":"note","type":"string","optional":true}},' ||
              '{{"field":"recvtime","type":"string","optional":false}}],"optional":false}},"payload":{{"entityid":"' || entityid ||
              '","entitytype":"' || entitytype || '","fiwareservicepath":"/' || lower(o_orderstatus) || '","timeinstant":"' ||
              {_ISO.format('o_orderdate')} || '","total":' || {_NUMBER.format('o_totalprice')} || ',"status":"' || o_orderstatus ||
              '","ordered":' || epoch_ms(o_orderdate) || ',"urgent":' || (CASE WHEN o_orderpriority LIKE '1%' THEN 'true' ELSE 'false' END) ||
              ',"note":null,"recvtime":"2024-06-01T00:00:00.000Z"}}}}' AS message,
              '{{"schema":{{"type":"struct","fields":[{{"field":"entityid","type":"string","optional":false}},' ||
              '{{"field":"timeinstant","type":"string","optional":false}}],"optional":false}},"payload":{{"entityid":"' || entityid ||
              '","timeinstant":"' || {_ISO.format('o_orderdate')} || '"}}}}' AS message_key
            FROM oe""",
        "routing_headers": f"""
            WITH {_CUSTOMER}
            SELECT c_custkey AS "offset", 'in_' || tenant || '_lastdata_out' AS out_topic,
              'fiware-service=' || tenant || ';fiware-servicepath=' || path || ';fiware-datamodel=;entityType=key_account;entityId=' ||
              {_SANE.format('c_name')} || ';suffix=_lastdata' AS headers FROM c""",
        "receipt_times": "SELECT '2024-06-01T00:00:00.000Z' AS recvtime, 2 * count(*) AS n FROM orders",
        "contract_rejects": f'WITH {_VIOLATIONS} SELECT o_orderkey AS "offset", entity_pos AS pos, target, "column", code FROM bad',
        "contract_missing_time": """
            SELECT o_orderkey AS "offset", CASE WHEN o_orderkey % 3 = 0 THEN 'NULL_VALUE' END AS code,
              CASE WHEN o_orderkey % 3 = 0 THEN 'Invalid null value for required STRING field' END AS error FROM orders""",
        "contract_ok": """
            SELECT o_orderkey AS "offset", 'O' || o_orderkey AS entityid, 'Order' AS entitytype, '/f' AS fiwareservicepath,
              epoch_ms(TIMESTAMP '2024-06-01 00:00:00') AS recv_ms, epoch_ms(o_orderdate) AS ts_ms, o_totalprice AS total, o_orderstatus AS status,
              epoch_ms(o_orderdate) AS ordered_ms, o_orderpriority LIKE '1%' AS urgent, CAST(NULL AS VARCHAR) AS note
            FROM orders WHERE o_orderstatus = 'F'""",
        "numeric_limits": """
            WITH x AS (
              SELECT l_orderkey, 'small' AS "column", round_even(l_extendedprice, 0) NOT BETWEEN -32768 AND 32767 AS over FROM lineitem
              UNION ALL SELECT l_orderkey, 'whole', round_even(l_extendedprice * 1e5, 0) NOT BETWEEN -2147483648 AND 2147483647 FROM lineitem
              UNION ALL SELECT l_orderkey, 'big', l_extendedprice * 1e14 >= 9223372036854775808.0 FROM lineitem
              UNION ALL SELECT l_orderkey, 'exact', l_extendedprice * 1e10 >= 1e15 FROM lineitem
              UNION ALL SELECT l_orderkey, 'short', l_extendedprice * 1e34 >= 3.4028235677973366e38 FROM lineitem)
            SELECT l_orderkey AS "offset", "column", 'OUT_OF_RANGE' AS code FROM x WHERE over""",
        "contract_cast": """
            SELECT 'L' || l_orderkey AS entityid, CAST(sum(CAST(round_even(l_extendedprice, 0) AS BIGINT)) AS BIGINT) AS sum_n,
              CAST(CAST(sum(CAST(l_extendedprice AS DECIMAL(30, 15))) AS DECIMAL(38, 2)) AS VARCHAR) AS sum_d,
              min(CASE WHEN l_extendedprice = round(l_extendedprice, 0) THEN CAST(CAST(l_extendedprice AS BIGINT) AS VARCHAR)
                       ELSE CAST(l_extendedprice AS VARCHAR) END) AS min_t
            FROM lineitem GROUP BY l_orderkey""",
        "schema_evolve": f"""
            SELECT 'O' || o_orderkey AS entityid, epoch_ms(o_orderdate) AS ts_ms, {_NUMBER.format('o_totalprice')} AS total,
              o_orderstatus AS orderstatus, o_orderpriority LIKE '1%' AS urgent, CAST(NULL AS DOUBLE) AS pressure
            FROM orders WHERE o_orderstatus = 'F'""",
        "native_error_log": f"""
            WITH {_VIOLATIONS}, f AS (SELECT *, row_number() OVER (PARTITION BY o_orderkey, entity_pos ORDER BY rank) AS rn FROM bad)
            SELECT 'shop' AS tenant, 'contract' AS stage, code, error, count(*) AS n FROM f WHERE rn = 1 GROUP BY ALL""",
        "batch_isolation": f"""
            WITH {_VIOLATIONS}
            SELECT target, count(*) AS entities, count(*) FILTER (WHERE target = 'shop.f_order') AS written,
              count(*) FILTER (WHERE target <> 'shop.f_order') AS rejected, TRUE AS balanced FROM v GROUP BY target""",
        "error_log": f'WITH {_DEAD} SELECT o_orderkey AS "offset", tenant, error, query FROM dl',
        "error_events": f"""
            WITH {_DEAD} SELECT o_orderkey AS "offset", 'in_' || tenant || '_error_log_out' AS out_topic,
              '2024-06-01T00:00:00.000Z' AS stamped, error, 'dm-postgis-errors' AS model FROM dl""",
        "error_truncation": """
            WITH m AS (SELECT doc_id, 'Failed: ' || text AS t FROM documents),
            x AS (SELECT doc_id, CASE WHEN length(t) > 4000
                    THEN substr(t, 1, 4000) || '... [truncated ' || (length(t) - 4000) || ' chars]' ELSE t END AS e FROM m)
            SELECT doc_id AS "offset", 'unknown' AS tenant, md5(e) AS error_md5, length(e) AS error_length, '{"a":1}' AS query FROM x""",
        "geo_points": """
            WITH c AS (SELECT c_custkey, c_mktsegment, (c_custkey % 3600) / 10.0 - 180.0 AS lon, (c_custkey % 1700) / 10.0 - 85.0 AS lat FROM customer),
            t AS (SELECT *, CASE WHEN lon = round(lon, 0) THEN CAST(CAST(lon AS BIGINT) AS VARCHAR) ELSE CAST(lon AS VARCHAR) END AS lo,
                    CASE WHEN lat = round(lat, 0) THEN CAST(CAST(lat AS BIGINT) AS VARCHAR) ELSE CAST(lat AS VARCHAR) END AS la FROM c)
            SELECT 'G' || c_custkey AS entityid, CASE WHEN c_mktsegment = 'MACHINERY' THEN 'string' ELSE 'geometry' END AS kind,
              CASE WHEN c_mktsegment <> 'MACHINERY' THEN 'POINT (' || lo || ' ' || la || ')' END AS wkt,
              CASE WHEN c_mktsegment = 'MACHINERY' THEN 'nowhere' END AS v_string FROM t""",
        "geo_polygons": """
            WITH s AS (SELECT s_suppkey, s_suppkey % 170 AS x, s_suppkey % 80 AS y FROM supplier)
            SELECT 'G' || s_suppkey AS entityid, 'geometry' AS kind,
              'POLYGON ((' || x || ' ' || y || ', ' || (x + 1) || ' ' || y || ', ' || (x + 1) || ' ' || (y + 1) || ', ' || x || ' ' || y || '))' AS wkt
            FROM s""",
        "geo_geojson": f"""
            WITH {_SHAPE} SELECT 'G' || p_partkey AS entityid, CASE WHEN wkt IS NULL THEN 'bad_geometry' ELSE 'geometry' END AS kind, wkt FROM w""",
        "geo_wkb": f"""
            WITH {_SHAPE},
            n AS (SELECT p_partkey, wkt, list_transform(regexp_extract_all(wkt, '[0-9.]+'), lambda s: CAST(s AS DOUBLE)) AS v FROM w WHERE wkt IS NOT NULL),
            b AS (SELECT p_partkey, wkt, list_transform(v, lambda d: lpad(to_hex(CASE WHEN d = 0 THEN 0::UBIGINT ELSE
                    (CAST(floor(log2(d)) AS UBIGINT) + 1023) * 4503599627370496::UBIGINT
                    + CAST((d / pow(2, floor(log2(d))) - 1) * 4503599627370496 AS UBIGINT) END), 16, '0')) AS big FROM n WHERE list_min(list_filter(v, lambda d: d > 0)) >= 1 OR list_max(v) = 0
                  UNION ALL
                  SELECT p_partkey, wkt, list_transform(v, lambda d: CASE WHEN d = 0 THEN '0000000000000000' WHEN d = 0.25 THEN '3FD0000000000000'
                    WHEN d = 0.5 THEN '3FE0000000000000' WHEN d = 0.75 THEN '3FE8000000000000' ELSE lpad(to_hex(
                    (CAST(floor(log2(greatest(d, 1))) AS UBIGINT) + 1023) * 4503599627370496::UBIGINT
                    + CAST((greatest(d, 1) / pow(2, floor(log2(greatest(d, 1)))) - 1) * 4503599627370496 AS UBIGINT)), 16, '0') END) AS big
                  FROM n WHERE NOT (list_min(list_filter(v, lambda d: d > 0)) >= 1 OR list_max(v) = 0)),
            c AS (SELECT p_partkey, wkt, list_transform(big, lambda h: substr(h, 15, 2) || substr(h, 13, 2) || substr(h, 11, 2) || substr(h, 9, 2)
                    || substr(h, 7, 2) || substr(h, 5, 2) || substr(h, 3, 2) || substr(h, 1, 2)) AS x FROM b)
            SELECT 'G' || p_partkey AS entityid, wkt, CASE p_partkey % 8
                WHEN 0 THEN '0101000000' WHEN 1 THEN '010200000002000000' WHEN 2 THEN '01030000000100000004000000'
                WHEN 3 THEN '0104000000020000000101000000' WHEN 4 THEN '010500000001000000010200000002000000'
                ELSE '01060000000100000001030000000100000004000000' END
              || CASE WHEN p_partkey % 8 = 3 THEN x[1] || x[2] || '0101000000' || x[3] || x[4] ELSE array_to_string(x, '') END AS wkb FROM c""",
        "expect_geometry": "SELECT 'G' || p_partkey AS entityid FROM part WHERE p_partkey % 8 = 0 AND p_partkey % 3 = 0",
        "geo_reject_counts": f"""
            WITH {_SHAPE} SELECT CASE WHEN wkt IS NULL THEN 'BAD_GEOMETRY' ELSE 'OK' END AS code, count(*) AS n FROM w GROUP BY ALL""",
        "documents_build": f"""
            SELECT 'D' || doc_id AS entity, lang AS type, md5(text) AS text_md5,
              '{{"lang":{{"type":"Text","value":"' || lang || '"}}}}' AS metadata, n_chars, '2024-06-01T00:00:00.000Z' AS received,
              '{{"database":"sth_library","collection":"sth_library_' || {_SANE.format('source')} || '_' || lang || '"}}' AS document_key
            FROM documents""",
        "documents_namespace": f"""
            SELECT 'sth_library' AS database, 'sth_library_' || {_SANE.format('source')} || '_' || lang AS collection, count(*) AS n
            FROM documents GROUP BY ALL""",
        "graph_create": f"""
            WITH q AS (
              SELECT doc_id, 'mutation {{ createTourdocument(dti: "kg_graph_prd", input: {{ object: {{ externalId: "Doc:' || doc_id || '", body: "' ||
                {_ESCAPED.format('text')} || '", size: ' || n_chars || ', ready: true, about: {{ lang: "' || lang || '", sources: ["' || source ||
                '"] }} }} }}) {{ uri }} }}' AS query FROM documents)
            SELECT doc_id AS "offset", 'create' AS action, md5(query) AS query_md5, length(query) AS query_length FROM q""",
        "graph_update": f"""
            SELECT p_partkey AS "offset", 'update' AS action,
              'mutation {{ updatePart(dti: "", input: {{ object: {{ externalId: "Part:' || p_partkey || '", name: "' || {_ESCAPED.format('p_name')} ||
              '", price: ' || {_NUMBER.format('p_retailprice')} || ', size: ' || p_size || ', gone: null }} }}, staging: true) {{ uri }} }}' AS query
            FROM part""",
        "graph_delete": """
            SELECT s_suppkey AS "offset", 'delete' AS action,
              'mutation { deleteData(dti: "tenant", uris: ["http://example.org/tenant/resource/Supplier:' || s_suppkey || '"]) }' AS query
            FROM supplier""",
        "graph_slug_uri": f"""
            SELECT p_partkey AS "offset", 'mutation {{ createPart(dti: "", input: {{ object: {{ externalId: "part-' || p_partkey ||
              '", brand: {{ uri: "http://example.org/Brand/' || {_SLUG.format('p_brand')} || '" }}, name: "' || {_ESCAPED.format('p_name')} ||
              '" }} }}) {{ uri }} }}' AS query FROM part""",
        "graph_locations": f"""
            WITH {_SHAPE}
            SELECT p_partkey AS "offset", CASE WHEN p_size % 5 <> 0 AND p_size > 10 THEN wkt END AS wkt,
              CASE WHEN p_size % 5 = 0 OR (p_size > 10 AND wkt IS NULL) THEN 'AsGeoJSON,externalId' ELSE 'externalId,asWkt' END AS members
            FROM w""",
        "http_classify": """
            SELECT CASE WHEN p = '1' THEN 'accepted' WHEN p = '2' THEN 'exists' ELSE 'failed' END AS outcome,
              CASE p WHEN '3' THEN 'Server replied with status code 200 and body with retryable GraphQL errors: {"errors":[{"message":"URI y already exists"},{"message":"no such relation"}]}'
                WHEN '4' THEN 'Server replied with status code 500 and body oops'
                WHEN '5' THEN 'Server replied with status code none and body oops' END AS error, count(*) AS n
            FROM (SELECT substr(o_orderpriority, 1, 1) AS p FROM orders) GROUP BY ALL""",
        "flow_counts": f"WITH {_LOG} SELECT flow, service, result, count(*) AS messages FROM l GROUP BY ALL",
        "flow_durations": f"""
            WITH {_LOG} SELECT flow, arg_max(duration_s, ts) AS last_duration_s, round(sum(duration_s), 3) AS total_duration_s,
              round(avg(duration_s), 4) AS mean_duration_s, epoch_us(max(ts)) // 1000 AS last_ms FROM l GROUP BY flow""",
        "flow_summary": f"""
            WITH {_LOG} SELECT flow, count(*) AS total_events, count(*) FILTER (WHERE result = 'success') AS success_events,
              count(*) FILTER (WHERE result = 'error') AS error_events FROM l GROUP BY flow ORDER BY flow""",
        "pipeline_snapshot": f"""
            WITH {_LOG} SELECT count(*) AS total_events, count(*) FILTER (WHERE result = 'success') AS success_events,
              count(*) FILTER (WHERE result = 'error') AS error_events,
              round(count(*) FILTER (WHERE result = 'success') / count(*), 6) AS success_rate,
              count(DISTINCT service) AS active_services, count(DISTINCT flow) AS active_flows FROM l""",
        "throughput_1m": """
            SELECT epoch_ms(date_trunc('minute', ts)) AS start_ms, epoch_ms(date_trunc('minute', ts)) + 60000 AS end_ms, event_type AS flow,
              count(*) AS records, count(*) / 60.0 AS rate FROM events GROUP BY ALL""",
        "throughput_5m_sliding": """
            WITH w AS (SELECT event_type, epoch_ms(date_trunc('minute', ts)) - k * 60000 AS s FROM events, range(5) AS r(k))
            SELECT s AS start_ms, s + 300000 AS end_ms, event_type AS flow, count(*) AS records, count(*) / 5.0 AS rate FROM w GROUP BY ALL""",
        "consumer_lag": """
            WITH x AS (SELECT 'raw_' || event_type AS topic, user_id % 6 AS p, event_id AS o, ts FROM events),
            ends AS (SELECT topic, p, max(o) + 1 AS e FROM x GROUP BY ALL),
            done AS (SELECT CASE WHEN p < 3 THEN 'early' ELSE 'late' END AS g, topic, p, max(o) + 1 AS d FROM x
                     WHERE ts < TIMESTAMP '2024-01-15' GROUP BY ALL),
            w AS (SELECT DISTINCT g, topic FROM done)
            SELECT w.g AS consumer_group, w.topic, CAST(sum(greatest(e - coalesce(d, 0), 0)) AS BIGINT) AS lag
            FROM w JOIN ends USING (topic) LEFT JOIN done ON done.g = w.g AND done.topic = w.topic AND done.p = ends.p GROUP BY ALL""",
        "partition_count": "SELECT 'raw_' || event_type AS topic, count(DISTINCT user_id % 6) AS partitions FROM events GROUP BY ALL",
        "replay_dedup": "SELECT 'raw_' || event_type AS topic, count(*) AS n FROM events GROUP BY ALL",
        "expect_missing": """
            SELECT o_orderkey AS orderkey FROM orders WHERE NOT EXISTS (
              SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_extendedprice >= 50000 AND l_returnflag IN ('R', 'A'))""",
        "expect_forbidden": """
            SELECT o_orderkey AS orderkey FROM orders WHERE EXISTS (
              SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_shipdate < o_orderdate)""",
        "expect_ranges": """
            SELECT o_orderkey AS orderkey FROM orders WHERE NOT EXISTS (
              SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_extendedprice > o_totalprice / 10
                AND l_extendedprice <= o_totalprice AND (o_orderstatus = 'P' OR l_returnflag = 'N'))""",
        "expect_tolerance": "SELECT o_orderkey AS orderkey FROM orders WHERE o_orderkey % 2 <> 0",
        "expect_count": "SELECT count(*) AS rows, CAST(10000 AS BIGINT) AS expected, count(*) = 10000 AS ok FROM events",
        "expect_documents": "SELECT 'D' || doc_id AS entity FROM documents WHERE lang = 'de'",
        "reconcile_counts": f"""
            WITH {_HOURLY}
            SELECT 'U' || user_id AS entityid, count(*) AS entities, count(*) FILTER (WHERE rn = 1) AS written,
              count(*) FILTER (WHERE rn > 1) AS rejected, TRUE AS balanced FROM r GROUP BY user_id""",
        "stream_historic": _STREAM_HISTORIC,
        "stream_outage": _STREAM_HISTORIC,
        "stream_replay": _LATEST,
        "stream_backlog": f"""
            WITH {_VIOLATIONS}, f AS (SELECT *, row_number() OVER (PARTITION BY o_orderkey, entity_pos ORDER BY rank) AS rn FROM bad)
            SELECT 'O' || o_orderkey AS entityid, 'shop.f_order' AS outcome FROM orders WHERE o_orderstatus = 'F'
            UNION ALL SELECT o_orderkey || '-' || entity_pos, code FROM f WHERE rn = 1""",
        "repeat_errors_by_tenant": f"""
            WITH {_HOURLY} SELECT 'city' AS tenant, 'DUPLICATE_KEY' AS code, a AS "offset", 'U' || user_id AS entityid FROM r WHERE rn > 1""",
        "sink_routed": f"WITH {_CUSTOMER} SELECT c_name AS entityid, tenant AS target_schema, path || '_key_account' AS target_table FROM c",
        "sink_documents": f"""
            SELECT 'sth_library_' || {_SANE.format('source')} || '_' || lang AS collection, 'D' || doc_id AS entity, md5(text) AS text_md5 FROM documents""",
        "sink_error_log": f"WITH {_DEAD} SELECT tenant, error, query FROM dl",
        "publish_files": f"WITH {_DEAD} SELECT 'in_' || tenant || '_error_log_out' AS topic, error FROM dl",
        "rejected_records": """
            SELECT o_orderkey AS "offset", CASE WHEN o_orderkey % 4 = 1 THEN 'orders_lastdata' END AS target_table,
              CASE o_orderkey % 4 WHEN 0 THEN 1 WHEN 1 THEN 4 WHEN 2 THEN 3 ELSE 1 END AS headers FROM orders""",
        "observed_flow": """
            SELECT count(*) AS rows, count(*) AS passed, epoch_us(min(ts)) AS oldest_us, epoch_us(max(ts)) AS newest_us FROM events""",
        "backlog_marker": "SELECT 'U' || max(user_id) AS marker, TRUE AS arrived FROM events UNION ALL SELECT 'nobody', FALSE",
        "stream_documents": f"""
            SELECT 'sth_library' AS database, 'sth_library_' || {_SANE.format('source')} || '_' || lang AS collection, 'D' || doc_id AS entity, n_chars
            FROM documents""",
        "stream_error_log": f'WITH {_DEAD} SELECT o_orderkey AS "offset", tenant, error, query FROM dl',
        "stream_graph": """
            SELECT p_partkey AS "offset", CASE p_size % 3 WHEN 0 THEN 'exists' WHEN 1 THEN 'HTTP' ELSE 'accepted' END AS outcome,
              CASE WHEN p_size % 3 = 1 THEN 'graph' END AS tenant FROM part""",
        "expect_micros": "SELECT event_id, epoch_us(ts) - 1 AS asked_us FROM events",
        "numeric_rounding": """
            SELECT 'O' || o_orderkey AS entityid,
              CASE WHEN o_orderkey % 200 < 95 THEN ((9905 + o_orderkey % 200) // 10) // 10 || '.' || ((9905 + o_orderkey % 200) // 10) % 10 END AS stored,
              CASE WHEN o_orderkey % 200 >= 95 THEN 'OUT_OF_RANGE' END AS code FROM orders""",
        "delete_missing_table": f"""
            WITH {_EVENTS} SELECT a AS "offset", CASE WHEN event_type = 'error' THEN 'delete' ELSE 'update' END AS change, 'TABLE_MISSING' AS code FROM e""",
        "throughput_5m": """
            SELECT epoch_ms(time_bucket(INTERVAL 5 MINUTE, ts)) AS start_ms, epoch_ms(time_bucket(INTERVAL 5 MINUTE, ts)) + 300000 AS end_ms,
              event_type AS flow, count(*) AS records, count(*) / 300.0 AS rate FROM events GROUP BY ALL""",
        "graph_slug": f"SELECT conv_id, turn, {_SLUG.format('text')} AS slug FROM conversations",
        "lastdata_refolded": _REFOLDED,
        "stream_folded": _REFOLDED,
        "stateful_lastdata": _REFOLDED,
        "stream_evolution": f"""
            WITH {_EVENTS},{_fold()},
            l AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY a DESC) AS rn FROM acc)
            SELECT 'U' || user_id AS entityid, t AS ts_ms,
                   CASE WHEN value = round(value, 0) THEN CAST(CAST(value AS BIGINT) AS VARCHAR) ELSE CAST(value AS VARCHAR) END AS value,
                   event_type AS label,
                   CASE WHEN a > (SELECT floor((min(a) + max(a)) / 2) FROM e) THEN event_id END AS event
            FROM l WHERE rn = 1""",
        "stream_flow_log": """
            SELECT 'lastdata' AS flow, r AS result, CAST(sum(n) AS BIGINT) AS messages, min(oldest) AS oldest_us, max(newest) AS newest_us FROM (
              SELECT CASE WHEN event_type = 'error' THEN 'error' ELSE 'success' END AS r, count(*) AS n,
                     (SELECT epoch_us(min(ts)) FROM events) AS oldest, (SELECT epoch_us(max(ts)) FROM events) AS newest
              FROM events GROUP BY ALL) GROUP BY ALL""",
        "stream_lag": """
            WITH x AS (SELECT 'raw_' || event_type AS topic, user_id % 6 AS p, event_id AS o, ts FROM events),
            ends AS (SELECT topic, p, max(o) + 1 AS e FROM x GROUP BY ALL),
            done AS (SELECT topic, p, max(o) + 1 AS d FROM x WHERE ts < TIMESTAMP '2024-01-15' GROUP BY ALL)
            SELECT topic, CAST(sum(greatest(e - coalesce(d, 0), 0)) AS BIGINT) AS lag
            FROM ends LEFT JOIN done USING (topic, p) WHERE topic IN (SELECT topic FROM done) GROUP BY ALL""",
        "stream_replay_dedup": "SELECT 'raw_' || event_type AS topic, count(*) AS n FROM events GROUP BY ALL",
        "stream_sliding": """
            WITH w AS (SELECT date_trunc('day', ts) - k * INTERVAL 1 DAY AS s FROM events, range(3) AS r(k))
            SELECT epoch_ms(s) AS start_ms, 'lastdata' AS flow, count(*) AS records, round(count(*) / 72.0, 6) AS rate FROM w
            WHERE s + INTERVAL 3 DAY <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events) GROUP BY ALL""",
        "stream_throughput": """
            SELECT epoch_ms(date_trunc('day', ts)) AS start_ms, 'lastdata' AS flow, count(*) AS records, count(*) / 24.0 AS rate FROM events
            WHERE date_trunc('day', ts) + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events) GROUP BY ALL""",
    }
    return sql
