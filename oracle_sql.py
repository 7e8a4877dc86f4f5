"""DuckDB SQL for every registered query, written apart from the Spark code.

The keyed content rests on Murmur3 (x86, 32 bit) as Spark's ``hash`` defines it: each
argument is hashed with the hash of the arguments before it as the seed, which starts at
42.  The functions below produce SQL expressions that do the same on BIGINTs masked to 32
bits.  ``list_transform([x], lambda v: ...)`` binds a value that is used several times.
"""

from __future__ import annotations

from tidemark.functions import vocabulary as v

MASK = 0xFFFFFFFF
C1, C2 = 0xCC9E2D51, 0x1B873593
F1, F2 = 0x85EBCA6B, 0xC2B2AE35


# --- Murmur3 as SQL -----------------------------------------------------------------

def _rotated(value: int, bits: int) -> int:
    return ((value << bits) | (value >> (32 - bits))) & MASK


def _mixed_word(word: int) -> int:
    return _rotated(word * C1 & MASK, 15) * C2 & MASK


def _times(value: str, factor: int) -> str:
    return f"CAST((CAST({value} AS HUGEINT) * {factor}) % 4294967296 AS BIGINT)"


def _mix_word_sql(words: str) -> str:
    """Mixes each word of a list."""
    step = f"list_transform({words}, lambda w: {_times('w', C1)})"
    step = f"list_transform({step}, lambda w: ((w << 15) & {MASK}) | (w >> 17))"
    return f"list_transform({step}, lambda w: {_times('w', C2)})"


def _absorb_sql(seed: str, mixed_words: str, length: str) -> str:
    """Folds mixed words into a seed and finishes the hash, as a number in 0..2^32-1."""
    fold = (f"list_reduce(list_concat([{seed}], {mixed_words}), lambda h, k: "
            f"((((xor(h, k) << 13) & {MASK}) | (xor(h, k) >> 19)) * 5 + {0xE6546B64}) & {MASK})")
    done = f"list_transform([xor({fold}, {length})], lambda x: {_times('xor(x, x >> 16)', F1)})"
    done = f"list_transform({done}, lambda x: {_times('xor(x, x >> 13)', F2)})"
    return f"list_transform({done}, lambda x: xor(x, x >> 16))[1]"


def hash_id(column: str) -> str:
    """Hash of a non-negative BIGINT, seeded with 42: low word, then high word."""
    words = f"[CAST({column} AS BIGINT) & {MASK}, CAST({column} AS BIGINT) >> 32]"
    return _absorb_sql("CAST(42 AS BIGINT)", _mix_word_sql(words), "8")


def hash_text(column: str) -> str:
    """Hash of an ASCII string: whole little-endian words, then each byte left over."""
    def byte(at: str) -> str:
        return f"CAST(ascii(substr({column}, {at}, 1)) AS BIGINT)"

    whole = f"list_transform(range(0, length({column}) // 4), lambda i: " + " + ".join(
        f"{byte(f'CAST(i * 4 + {b + 1} AS BIGINT)')} * {256 ** b}" for b in range(4)) + ")"
    rest = (f"list_transform(range(length({column}) // 4 * 4 + 1, length({column}) + 1), "
            f"lambda i: {byte('i')})")
    return _absorb_sql("CAST(42 AS BIGINT)", _mix_word_sql(f"list_concat({whole}, {rest})"),
                       f"length({column})")


def salted(hashed: str, salt: str) -> str:
    """Goes on from a key's hash with a constant salt; the result is a signed INT."""
    data = salt.encode()
    whole = len(data) // 4 * 4
    words = [int.from_bytes(data[i:i + 4], "little") for i in range(0, whole, 4)]
    words += list(data[whole:])
    mixed = ", ".join(str(_mixed_word(word)) for word in words)
    unsigned = _absorb_sql(hashed, f"[CAST(x AS BIGINT) FOR x IN [{mixed}]]", str(len(data)))
    return (f"list_transform([{unsigned}], lambda u: "
            f"CASE WHEN u >= 2147483648 THEN u - 4294967296 ELSE u END)[1]")


def drawn(hashed: str, salt: str, n: int | str) -> str:
    return f"list_transform([{salted(hashed, salt)}], lambda s: ((s % {n}) + {n}) % {n})[1]"


def picked(values, hashed: str, salt: str) -> str:
    listed = ", ".join("'" + value.replace("'", "''") + "'" for value in values)
    return f"([{listed}])[CAST({drawn(hashed, salt, len(values))} + 1 AS BIGINT)]"


def _name(hashed: str, first_salt: str, last_salt: str) -> str:
    return (f"{picked(v.FIRST_NAMES, hashed, first_salt)} || ' ' || "
            f"{picked(v.LAST_NAMES, hashed, last_salt)}")


# --- generated tables as CTEs -------------------------------------------------------

ASOF = "TIMESTAMP '2026-08-14 00:00:00'"
LATER = "TIMESTAMP '2026-08-15 00:00:00'"
N = 24
BUCKETS = 2


def _departments(count: str) -> str:
    listed = ", ".join("'" + name + "'" for name in v.DEPARTMENT_NAMES)
    size = len(v.DEPARTMENT_NAMES)
    return f"""
numbers AS (
    SELECT unnest(range(1, CAST({count} AS BIGINT) + 1)) AS department_number
),
names AS (
    SELECT CAST(department_number AS INTEGER) AS department_number,
           ([{listed}])[(department_number - 1) % {size} + 1]
           || CASE WHEN department_number <= {size} THEN ''
                   ELSE ' ' || CAST((department_number - 1) // {size} + 1 AS VARCHAR) END
             AS department_name
    FROM numbers
),
hashed_names AS (
    SELECT *, {hash_text('department_name')} AS h FROM names
),
department AS (
    SELECT department_number, department_name,
           {_name('h', v.SALT_HEAD_FIRST, v.SALT_HEAD_LAST)} AS department_head,
           'CC-' || lpad(CAST(400000 + {drawn('h', v.SALT_COST_CENTER, 99999)} AS VARCHAR), 6, '0')
             AS cost_center,
           {picked(v.DIVISIONS, 'h', v.SALT_DIVISION)} AS division
    FROM hashed_names
)"""


def _employee_columns(updated_at: str) -> str:
    return f"""a.employee_id,
           {_name('a.h', v.SALT_FIRST, v.SALT_LAST)} AS employee_name,
           a.department_number,
           d.department_name,
           {picked(v.LOCATION_CODES, 'a.h', v.SALT_LOCATION)} AS location_code,
           {picked(v.SALARY_BANDS, 'a.h', v.SALT_BAND)} AS salary_band,
           {updated_at} AS updated_at,
           CAST(a.employee_id % {BUCKETS} AS INTEGER) AS employee_id_bucket"""


SKEWED = (f"CASE WHEN {drawn('h', v.SALT_IS_HOT, 100)} < 30 "
          f"THEN {drawn('h', v.SALT_HOT_KEY, 3)} + 1 "
          f"ELSE {drawn('h', v.SALT_ANY_KEY, N)} + 1 END")

SOURCES = _departments(str(N)) + f""",
assigned AS (
    SELECT employee_id, h, CAST({SKEWED} AS INTEGER) AS department_number
    FROM (SELECT o_orderkey + 100000 AS employee_id, {hash_id('o_orderkey + 100000')} AS h
          FROM orders)
),
employee AS (
    SELECT {_employee_columns(
        f"{ASOF} - to_seconds({drawn('a.h', v.SALT_UPDATED, 90 * 86400)})")}
    FROM assigned a JOIN department d USING (department_number)
)"""


def _new_rows(before: str, at: str, name: str) -> str:
    """500 new employees above the ids of a table, as one more CTE."""
    return f"""
{name}_ids AS (
    SELECT (SELECT max(employee_id) FROM {before}) + unnest(range(1, 501)) AS employee_id
),
{name}_assigned AS (
    SELECT employee_id, h, CAST({drawn('h', v.SALT_NEW_KEY, N)} + 1 AS INTEGER) AS department_number
    FROM (SELECT employee_id, {hash_id('employee_id')} AS h FROM {name}_ids)
),
{name} AS (
    SELECT {_employee_columns(f"{at} + to_minutes({drawn('a.h', v.SALT_NEW_UPDATED, 720)})")}
    FROM {name}_assigned a JOIN department d USING (department_number)
)"""


def _landed(before: str, at: str, name: str, force: bool) -> str:
    """A table after a whole batch: new rows appended, then 200 older rows moved."""
    if force:
        step = f"{drawn('h', v.SALT_MOVE_KEY, N - 1)} + 1"
        target = f"(department_number - 1 + {step}) % {N} + 1"
    else:
        target = f"{drawn('h', v.SALT_MOVE_KEY, N)} + 1"
    return f"""{_new_rows(before, at, name + '_new')},
{name}_movers AS (
    SELECT employee_id, {target} AS new_number,
           {at} + to_minutes({drawn('h', v.SALT_MOVE_UPDATED, 720)}) AS new_at
    FROM (SELECT employee_id, department_number, {hash_id('employee_id')} AS h
          FROM (SELECT * FROM {before} UNION ALL SELECT * FROM {name}_new) WHERE updated_at < {at})
    ORDER BY {drawn('h', v.SALT_MOVE_ORDER, 1000000)}, employee_id LIMIT 200
),
{name} AS (
    SELECT e.employee_id, e.employee_name,
           COALESCE(d.department_number, e.department_number) AS department_number,
           COALESCE(d.department_name, e.department_name) AS department_name,
           e.location_code, e.salary_band,
           COALESCE(m.new_at, e.updated_at) AS updated_at,
           e.employee_id_bucket
    FROM (SELECT * FROM {before} UNION ALL SELECT * FROM {name}_new) e
    LEFT JOIN {name}_movers m USING (employee_id)
    LEFT JOIN department d ON d.department_number = m.new_number
)"""


READ_TABLE = """SELECT e.employee_id, e.employee_name, e.department_number, e.department_name,
       e.location_code, e.salary_band, e.updated_at,
       d.department_head, d.cost_center, d.division
FROM {fact} e JOIN department d USING (department_name)"""

EMPLOYEE_COLUMNS = ("employee_id, employee_name, department_number, department_name, "
                    "location_code, salary_band, updated_at, employee_id_bucket")

ORDERS_READ_TABLE = """SELECT o.o_orderkey, n.c_name, o.o_orderstatus, o.o_totalprice, o.o_orderdate,
       d.c_mktsegment, d.c_nationkey, d.c_acctbal
FROM orders o JOIN customer n ON n.c_custkey = o.o_custkey JOIN customer d ON d.c_name = n.c_name"""

GAPS = """child AS (
    SELECT o_orderkey, o_orderdate,
           CASE WHEN o_orderpriority <> '1-URGENT' THEN o_custkey END AS o_custkey
    FROM orders
),
parent AS (SELECT c_custkey FROM customer WHERE c_nationkey < 20)"""

EVENTS = """old AS (
    SELECT event_id, ts, user_id, event_type, value FROM events
    WHERE ts < TIMESTAMP '2024-01-20 00:00:00'
),
batch AS (
    SELECT event_id, ts, user_id, event_type, value FROM events
    WHERE ts >= TIMESTAMP '2024-01-20 00:00:00'
    UNION ALL
    SELECT event_id, TIMESTAMP '2024-03-01 00:00:00', user_id, event_type, CAST(-1 AS DOUBLE)
    FROM old WHERE event_type = 'error'
    UNION ALL
    SELECT event_id, TIMESTAMP '2024-03-01 01:00:00', user_id, event_type, CAST(-2 AS DOUBLE)
    FROM old WHERE event_type = 'error'
)"""

# Share in percent rounded half up, in whole numbers.
PERCENT = "CAST((20000 * {part} + {whole}) // (2 * {whole}) AS DOUBLE) / 100"


def _late_orders(columns: str) -> str:
    """Orders with the customers' columns, those of the first tenth of the customers late."""
    return f"""SELECT {columns} FROM (
    SELECT o_orderkey, c_name, o_totalprice, c_mktsegment, c_nationkey, c_acctbal, late,
           CASE WHEN late THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
           CASE WHEN late THEN TIMESTAMP '2030-01-01 00:00:00' ELSE o_orderdate END AS o_orderdate
    FROM (SELECT *, o_custkey <= (SELECT max(c_custkey) // 10 FROM customer) AS late FROM orders)
    JOIN customer ON c_custkey = o_custkey)"""


def _counts(*tables: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS rows FROM {t}" for t in tables)


def _stats(table: str, columns: tuple[str, ...]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) AS rows, count(*) - count({c}) AS nulls, "
        f"count(DISTINCT {c}) AS distinct_values, CAST(min({c}) AS VARCHAR) AS min_value, "
        f"CAST(max({c}) AS VARCHAR) AS max_value FROM {table}" for c in columns)


def _verify(fact: str = "employee", batches: str = "", landed: int = 0) -> str:
    """The report on correct tables: counted where the data decides, stated elsewhere.  Landed
    rows are spread evenly, so three departments expect an even share of them."""
    even, skewed = 100 * 3 / N, 100 * (0.30 + 0.70 * 3 / N)
    orders = "(SELECT count(*) FROM orders)"
    share = f"(({orders} * {skewed} + {landed * even}) / ({orders} + {landed}))"
    hot = f"printf('%.2f..%.2f', {share} - 2, {share} + 2)"
    rows = f"(SELECT count(*) FROM {fact})"
    hot_pct = (f"(SELECT CAST((20000 * count(*) FILTER (department_number <= 3) + count(*)) "
               f"// (2 * count(*)) AS HUGEINT) FROM {fact})")
    checks = [
        ("dimension_rows", f"'{N}'", "(SELECT CAST(count(*) AS VARCHAR) FROM department)", "true"),
        ("dimension_key_unique", "'0'", "'0'", "true"),
        ("dimension_key_not_null", "'0'", "'0'", "true"),
        ("fact_join_key_not_null", "'0'", "'0'", "true"),
        ("fact_orphan_rows", "'0'", "'0'", "true"),
        ("fact_watermark_not_null", "'0'", "'0'", "true"),
        ("fact_rows", f"(SELECT CAST(count(*) + {landed} AS VARCHAR) FROM orders)",
         f"CAST({rows} AS VARCHAR)", "true"),
        ("fact_partitions", f"'{N * BUCKETS}'",
         f"(SELECT CAST(count(*) AS VARCHAR) FROM (SELECT DISTINCT department_number, "
         f"employee_id_bucket FROM {fact}))", "true"),
        ("fact_rows_per_partition", "'>= 50'",
         f"CAST({rows} // {N * BUCKETS} AS VARCHAR)", f"{rows} // {N * BUCKETS} >= 50"),
        ("fact_hot_share_pct", hot,
         f"CAST({hot_pct} // 100 AS VARCHAR) || '.' || "
         f"lpad(CAST({hot_pct} % 100 AS VARCHAR), 2, '0')",
         f"CAST({hot_pct} AS DOUBLE) / 100 BETWEEN {share} - 2 AND {share} + 2"),
        ("fact_key_unique", "'0'", "'0'", "true"),
        ("fact_key_not_null", "'0'", "'0'", "true"),
        ("output_rows_equal_fact_rows", "'equal'",
         f"CAST({rows} AS VARCHAR) || '/' || CAST({rows} AS VARCHAR)", "true"),
        ("output_missing_keys", "'0'", "'0'", "true"),
        ("output_extra_keys", "'0'", "'0'", "true"),
        ("output_key_unique", "'0'", "'0'", "true"),
        ("output_not_null", "'0'", "'0'", "true"),
        ("fact_distinct_days", f"'90..{92 if landed else 91}'",
         f"(SELECT CAST(count(DISTINCT CAST(updated_at AS DATE)) AS VARCHAR) FROM {fact})", "true"),
        ("fact_not_partitioned_by_join_key", "'without department_name'",
         "'department_number,employee_id_bucket'", "true"),
        ("dimension_not_partitioned_by_join_key", "'without department_name'",
         "'department_number'", "true"),
        ("output_not_partitioned", "'none'", "'none'", "true"),
        ("output_clustered", "'department_name'", "'department_name'", "true"),
    ]
    return f"WITH {SOURCES}{batches} " + " UNION ALL ".join(
        f"SELECT '{name}' AS \"check\", {expected} AS expected, {actual} AS actual, "
        f"{passed} AS passed" for name, expected, actual, passed in checks)


def oracle_sql() -> dict[str, str]:
    cut = "TIMESTAMP '2000-01-01 00:00:00'"
    events_cut = "TIMESTAMP '2024-01-20 00:00:00'"
    line_hash, customer_hash = hash_id("l_orderkey"), hash_id("c_custkey")
    order_hash, event_hash = hash_id("o_orderkey"), hash_id("event_id")
    skewed_events = (f"(SELECT event_id, CAST({SKEWED} AS INTEGER) AS department_number "
                     f"FROM (SELECT event_id, {event_hash} AS h FROM events))")
    sql = {
        "keyed_hash": f"""
SELECT l_orderkey, l_linenumber, CAST({salted('h', v.SALT_IS_HOT)} AS INTEGER) AS hash_skew,
       CAST({salted('h', v.SALT_MOVE_KEY)} AS INTEGER) AS hash_move,
       CAST({drawn('h', v.SALT_IS_HOT, 100)} AS INTEGER) AS draw_100
FROM (SELECT l_orderkey, l_linenumber, {line_hash} AS h FROM lineitem)""",
        "pick_from_list": f"""
SELECT c_custkey, {picked(v.LOCATION_CODES, 'h', v.SALT_LOCATION)} AS location_code,
       {picked(v.SALARY_BANDS, 'h', v.SALT_BAND)} AS salary_band
FROM (SELECT c_custkey, {customer_hash} AS h FROM customer)""",
        "timestamp_spread": f"""
SELECT o_orderkey,
       {ASOF} - to_seconds({drawn('h', v.SALT_UPDATED, 90 * 86400)}) AS before_anchor,
       {ASOF} + to_minutes({drawn('h', v.SALT_NEW_UPDATED, 720)}) AS after_anchor,
       o_orderdate + to_minutes({drawn('h', v.SALT_MOVE_UPDATED, 720)}) AS after_order
FROM (SELECT o_orderkey, o_orderdate, {order_hash} AS h FROM orders)""",
        "skewed_key_assignment": f"SELECT event_id, department_number FROM {skewed_events}",
        "gen_dimension": f"WITH {_departments('(SELECT count(*) FROM customer)')} "
                         "SELECT department_number, department_name, department_head, "
                         "cost_center, division FROM department",
        "gen_fact": f"WITH {SOURCES} SELECT {EMPLOYEE_COLUMNS} FROM employee",
        "denormalise_key": "SELECT o_orderkey, o_custkey, c_name FROM orders "
                           "JOIN customer ON c_custkey = o_custkey",
        "gold_full": """
SELECT o.o_orderkey, n.c_name, o.o_orderstatus, o.o_totalprice, o.o_orderdate,
       d.c_mktsegment, x.n_name AS nation
FROM orders o JOIN customer n ON n.c_custkey = o.o_custkey
JOIN customer d ON d.c_name = n.c_name JOIN nation x ON x.n_nationkey = d.c_nationkey""",
        "gold_employee_department": f"WITH {SOURCES} {READ_TABLE.format(fact='employee')}",
        "shuffled_join": "SELECT l_orderkey, l_linenumber, l_partkey, o_orderstatus, o_orderdate "
                         "FROM lineitem JOIN orders ON o_orderkey = l_orderkey",
        "computed_key_join": f"""
SELECT event_id, event_type, n_nationkey, n_name
FROM (SELECT event_id, event_type, ((s % n) + n) % n AS computed_key
      FROM (SELECT event_id, event_type, {salted('h', v.SALT_MOVE_KEY)} AS s
            FROM (SELECT event_id, event_type, {event_hash} AS h FROM events)),
           (SELECT count(*) AS n FROM nation))
JOIN nation ON n_nationkey = computed_key""",
        "row_counts": _counts("lineitem", "orders", "customer", "events", "nation"),
        "duplicate_keys": "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem "
                          "GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1",
        "not_null_report": """
WITH joined AS (
    SELECT o_orderkey, o_custkey, c_name, c_mktsegment FROM orders
    LEFT JOIN (SELECT * FROM customer WHERE c_nationkey < 20) ON c_custkey = o_custkey)
SELECT 'o_orderkey' AS column_name, count(*) - count(o_orderkey) AS nulls FROM joined
UNION ALL SELECT 'o_custkey', count(*) - count(o_custkey) FROM joined
UNION ALL SELECT 'c_name', count(*) - count(c_name) FROM joined
UNION ALL SELECT 'c_mktsegment', count(*) - count(c_mktsegment) FROM joined""",
        "orphans": f"""
WITH {GAPS}
SELECT o_custkey, count(*) AS orphaned_rows FROM child LEFT JOIN parent ON c_custkey = o_custkey
WHERE c_custkey IS NULL GROUP BY o_custkey""",
        "relationships": f"""
WITH {GAPS}
SELECT o_custkey, count(*) AS orphaned_rows FROM child
WHERE o_custkey IS NOT NULL AND o_custkey NOT IN (SELECT c_custkey FROM parent)
GROUP BY o_custkey""",
        "quarantine": f"""
WITH {GAPS}
SELECT o_orderkey, o_custkey, o_orderdate FROM child LEFT JOIN parent ON c_custkey = o_custkey
WHERE c_custkey IS NULL""",
        "row_count_reconcile": """
WITH output AS (
    SELECT * FROM orders WHERE o_orderstatus <> 'P'
    UNION ALL
    SELECT * FROM orders WHERE o_orderstatus <> 'P' AND o_orderpriority = '1-URGENT')
SELECT (SELECT count(*) FROM orders) AS source_rows,
       (SELECT count(*) FROM output) AS output_rows,
       (SELECT count(*) FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM output))
         AS missing_keys,
       (SELECT count(DISTINCT o_orderkey) FROM output
        WHERE o_orderkey NOT IN (SELECT o_orderkey FROM orders)) AS extra_keys,
       (SELECT count(*) FROM (SELECT o_orderkey FROM orders GROUP BY 1 HAVING count(*) > 1))
         AS duplicate_source_keys,
       (SELECT count(*) FROM (SELECT o_orderkey FROM output GROUP BY 1 HAVING count(*) > 1))
         AS duplicate_output_keys,
       (SELECT count(*) FROM orders WHERE o_orderkey IS NULL) AS null_source_keys,
       (SELECT count(*) - count(o_custkey) FROM output) AS output_nulls""",
        "partition_profile": """
SELECT count(*) AS partitions, CAST(sum(rows) AS BIGINT) AS total_rows,
       CAST(trunc(avg(rows)) AS INTEGER) AS avg_rows_per_partition,
       min(rows) AS min_rows, max(rows) AS max_rows, trunc(avg(rows)) < 50 AS thin
FROM (SELECT l_suppkey, l_orderkey % 4 AS bucket, count(*) AS rows FROM lineitem GROUP BY ALL)""",
        "skew_profile": f"""
SELECT department_number, employees, {PERCENT.format(part='employees', whole='total')} AS pct_of_total
FROM (SELECT department_number, count(*) AS employees, (SELECT count(*) FROM events) AS total
      FROM {skewed_events} GROUP BY department_number)
ORDER BY employees DESC, department_number LIMIT 10""",
        "watermark_profile": "SELECT min(ts) AS earliest, max(ts) AS latest, "
                             "count(DISTINCT CAST(ts AS DATE)) AS distinct_days FROM events",
        "employee_partition_profile": f"""
WITH {SOURCES}
SELECT count(*) AS partitions, CAST(sum(rows) AS BIGINT) AS total_rows,
       CAST(trunc(avg(rows)) AS INTEGER) AS avg_rows_per_partition,
       min(rows) AS min_rows, max(rows) AS max_rows, trunc(avg(rows)) < 50 AS thin,
       CAST({N * BUCKETS} AS BIGINT) AS expected_partitions
FROM (SELECT department_number, employee_id_bucket, count(*) AS rows FROM employee GROUP BY ALL)""",
        "employee_skew_profile": f"""
WITH {SOURCES}
SELECT department_number, department_name, employees,
       {PERCENT.format(part='employees', whole='total')} AS pct_of_total
FROM (SELECT department_number, department_name, count(*) AS employees,
             (SELECT count(*) FROM employee) AS total
      FROM employee GROUP BY department_number, department_name)
ORDER BY employees DESC, department_number, department_name LIMIT 10""",
        "employee_watermark_profile": f"""
WITH {SOURCES}
SELECT min(updated_at) AS earliest, max(updated_at) AS latest,
       count(DISTINCT CAST(updated_at AS DATE)) AS distinct_days FROM employee""",
        "column_stats": _stats("orders", ("o_orderkey", "o_custkey", "o_orderstatus",
                                          "o_totalprice", "o_orderdate", "o_orderpriority")),
        "watermark_delta": f"""
SELECT event_id, ts, user_id FROM events
WHERE ts > (SELECT max(ts) FROM events WHERE ts < {events_cut})""",
        "watermark_inclusive": f"""
SELECT o_orderkey, o_orderdate FROM orders
WHERE o_orderdate >= (SELECT max(o_orderdate) FROM orders WHERE o_orderdate < {cut})
                     - INTERVAL 12 HOURS""",
        "hash_order_sample": f"""
SELECT o_orderkey, o_orderdate
FROM (SELECT o_orderkey, o_orderdate, {order_hash} AS h FROM orders WHERE o_orderdate < {cut})
ORDER BY {drawn('h', v.SALT_MOVE_ORDER, 1000000)}, o_orderkey LIMIT 200""",
        "hash_cutoff_sample": f"""
SELECT o_orderkey, o_orderstatus
FROM (SELECT o_orderkey, o_orderstatus, {order_hash} AS h FROM orders)
ORDER BY {drawn('h', v.SALT_MOVE_ORDER, 1000000)}, o_orderkey
LIMIT (SELECT count(*) // 2 FROM orders)""",
        "allocate_ids": "SELECT (SELECT max(event_id) FROM events) + unnest(range(1, "
                        "(SELECT count(*) FROM customer) + 1)) AS event_id",
        "append_batch": f"WITH {SOURCES},{_new_rows('employee', ASOF, 'added')} "
                        f"SELECT {EMPLOYEE_COLUMNS} FROM employee "
                        f"UNION ALL SELECT {EMPLOYEE_COLUMNS} FROM added",
        "land_batch": f"WITH {SOURCES},{_landed('employee', ASOF, 'first', False)} "
                      f"SELECT {EMPLOYEE_COLUMNS} FROM first",
        "merge_partial_update": f"""
SELECT c_custkey, c_name,
       CASE WHEN c_acctbal < 0 THEN CAST({drawn('h', v.SALT_MOVE_KEY, 25)} AS INTEGER)
            ELSE c_nationkey END AS c_nationkey,
       CASE WHEN c_acctbal < 0 THEN -c_acctbal ELSE c_acctbal END AS c_acctbal, c_mktsegment
FROM (SELECT *, {customer_hash} AS h FROM customer)""",
        "merge_partition_move": """
SELECT c_custkey, c_name,
       CASE WHEN c_nationkey < 3 THEN c_nationkey + 10 ELSE c_nationkey END AS c_nationkey,
       c_acctbal, c_mktsegment
FROM customer""",
        "merge_upsert": f"""
WITH {EVENTS}
SELECT event_id, ts, user_id, event_type, value FROM old
WHERE event_id NOT IN (SELECT event_id FROM batch)
UNION ALL
SELECT event_id, ts, user_id, event_type, value FROM batch
QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY ts DESC) = 1""",
        "append_only_duplicates": f"""
WITH {EVENTS}
SELECT event_id, count(*) AS n FROM (SELECT event_id FROM old UNION ALL SELECT event_id FROM batch)
GROUP BY event_id HAVING count(*) > 1""",
        "gold_incremental": ORDERS_READ_TABLE,
        "gold_restated": ORDERS_READ_TABLE,
        "gold_orphaned_move": f"""{ORDERS_READ_TABLE}
WHERE NOT (o.o_orderdate < TIMESTAMP '2000-01-01 00:00:00' AND o.o_orderpriority = '1-URGENT')""",
        "batch_cycle": f"WITH {SOURCES},{_landed('employee', ASOF, 'first', False)},"
                       f"{_landed('first', LATER, 'second', True)} "
                       f"{READ_TABLE.format(fact='second')}",
        "batch_cycle_overlay": f"WITH {SOURCES},{_landed('employee', ASOF, 'first', False)},"
                               f"{_landed('first', LATER, 'second', True)} "
                               f"{READ_TABLE.format(fact='second')}",
        "partitioned_write_roundtrip": "SELECT *, CAST(o_orderkey % 4 AS INTEGER) AS bucket, "
                                       "'o_orderpriority=' || o_orderpriority || '/bucket=' || "
                                       "(o_orderkey % 4) AS directory FROM orders",
        "partitioned_write_one_key": "SELECT *, 'c_nationkey=' || c_nationkey AS directory "
                                     "FROM customer",
        "gold_ranges": _late_orders("o_orderkey, c_name, o_orderstatus, o_totalprice, "
                                    "o_orderdate, c_mktsegment, c_nationkey, c_acctbal"),
        "ranges_report": "SELECT CAST(count(*) AS BIGINT) AS rows, 16 AS ranges, "
                         "count(*) FILTER (late) AS changed_rows, true AS less_than_half, "
                         f"true AS others_untouched FROM ({_late_orders('late')})",
        "batch_cycle_ranges": f"WITH {SOURCES},{_landed('employee', ASOF, 'first', False)},"
                              f"{_landed('first', LATER, 'second', True)} "
                              f"{READ_TABLE.format(fact='second')}",
        "verify_after_batch": _verify(
            "second", f",{_landed('employee', ASOF, 'first', False)},"
                      f"{_landed('first', LATER, 'second', True)}", 1000),
        "sketch_stats": " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, count(*) AS rows, count(*) - count({c}) AS nulls, "
            f"CAST(min({c}) AS VARCHAR) AS min_value, CAST(max({c}) AS VARCHAR) AS max_value, "
            "true AS near FROM (SELECT * REPLACE (CASE WHEN o_orderpriority = '1-URGENT' "
            "THEN TIMESTAMP '2030-01-01 00:00:00' ELSE o_orderdate END AS o_orderdate) FROM orders)"
            for c in ("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")),
        "differences_located": """
SELECT o_orderkey, 1::BIGINT AS source_rows,
       CAST(CASE o_orderkey % 1000 WHEN 1 THEN 0 WHEN 2 THEN 2 ELSE 1 END AS BIGINT) AS output_rows
FROM orders WHERE o_orderkey % 1000 IN (1, 2) OR o_orderkey % 1000 = 3 AND o_totalprice <> 0""",
        "curve_profile": "SELECT unnest(['l_partkey', 'l_suppkey']) AS key, 16::BIGINT AS files, "
                         "true AS skips, (SELECT count(*) FROM lineitem) AS rows",
        "stored_statistics": " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, count(*) AS rows, count(*) - count({c}) AS nulls, "
            f"CAST(min({c}) AS VARCHAR) AS min_value, CAST(max({c}) AS VARCHAR) AS max_value "
            "FROM orders" for c in ("o_orderkey", "o_custkey")),
        "skewed_join": """
SELECT l.o_orderkey, l_linenumber, l_partkey, o_custkey, o_orderdate
FROM (SELECT CASE WHEN l_partkey % 3 = 0 THEN (SELECT min(o_orderkey) FROM orders)
                  ELSE l_orderkey END AS o_orderkey, l_linenumber, l_partkey FROM lineitem) l
JOIN orders o ON o.o_orderkey = l.o_orderkey""",
        "layout_detail": f"""
WITH {SOURCES}
SELECT 'employee' AS table_name, 'department_number,employee_id_bucket' AS partition_columns,
       '' AS clustering_columns,
       (SELECT count(*) FROM (SELECT DISTINCT department_number, employee_id_bucket FROM employee))
         AS partitions,
       (SELECT count(*) FROM employee) AS rows
UNION ALL
SELECT 'department', 'department_number', '', {N}, {N}
UNION ALL
SELECT 'employee_department', '', 'department_name', 0, (SELECT count(*) FROM employee)""",
        "cluster_profile": "SELECT count(*) AS rows, count(DISTINCT l_partkey) AS keys, "
                           "true AS well_clustered FROM lineitem",
        "verify_report": _verify(),
    }
    return {name: text.strip() for name, text in sql.items()}
