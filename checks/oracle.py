"""The same questions in plain SQL, for DuckDB.

Written another way than the package: window functions where it aggregates,
pairwise joins where it reduces first, regular expressions where it measures
lengths, and expected values for phone spellings the feeds do not contain. The
feeds (:mod:`checks.fixture`), the format patterns and the column lists are the
package's own, and the phone rule for numbers in the feeds is the same reading.
"""

from __future__ import annotations

from checks import fixture
from rollcall.rules import EMAIL_PATTERN, PHONE_PATTERN, ProfileSpec
from rollcall.schemas import (
    ANALYTICS_COLUMNS,
    CRM_RAW,
    MASTER_COLUMNS,
    SAMPLE_COLUMNS,
    TRANSACTION_RAW,
)

AS_OF = f"DATE '{fixture.AS_OF}'"

CRM_TEXT, TRX_TEXT = tuple(CRM_RAW.names), tuple(TRANSACTION_RAW.names)


# --- expressions --------------------------------------------------------------


def pct(part: str, whole: str) -> str:
    """Half-up percentage with two places, in integers until the last step."""
    scaled = f"(2 * 10000 * CAST({part} AS BIGINT) + CAST({whole} AS BIGINT))"
    return (
        f"CASE WHEN {whole} > 0 THEN CAST({scaled} // (2 * CAST({whole} AS BIGINT)) "
        "AS DOUBLE) / 100 ELSE CAST(0 AS DOUBLE) END"
    )


def day(text: str) -> str:
    return (
        rf"CASE WHEN regexp_full_match({text}, '\d{{4}}-\d{{2}}-\d{{2}}') "
        f"THEN CAST(try_strptime({text}, '%Y-%m-%d') AS DATE) "
        rf"WHEN regexp_full_match({text}, '\d{{8}}') "
        f"THEN CAST(try_strptime({text}, '%Y%m%d') AS DATE) END"
    )


def mail(text: str) -> str:
    return rf"lower(regexp_replace(trim({text}), '\s+', '', 'g'))"


def _uk(national: str) -> str:
    return (
        f"CASE WHEN regexp_full_match({national}, '0([0-9]{{7}}|[0-9]{{9,10}})') "
        f"THEN '+44' || substr({national}, 2) "
        f"WHEN regexp_full_match({national}, '[0-9]{{4,10}}') THEN '+44' || {national} END"
    )


def _fr(national: str) -> str:
    return (
        f"CASE WHEN regexp_full_match({national}, '0[0-9]{{9}}') "
        f"THEN '+33' || substr({national}, 2) "
        f"WHEN regexp_full_match({national}, '[0-9]{{9}}') THEN '+33' || {national} END"
    )


def _coded(digits: str) -> str:
    rest = f"substr({digits}, 3)"
    return (
        f"CASE WHEN {digits} LIKE '44%' THEN {_uk(rest)} "
        f"WHEN {digits} LIKE '33%' THEN {_fr(rest)} END"
    )


_UK_VALID = "([1-357-9][0-9]{9}|[18][0-9]{8}|8[0-9]{6})"
_FR_VALID = "([1-9][0-9]{8})"


def _domestic(code: str, longest: int, valid: str, national) -> str:
    own = "regexp_replace(substr(digits, 3), '^0', '')"
    return (
        "coalesce(CASE "
        f"WHEN regexp_matches(digits, '^00[1-9]') THEN {_coded('substr(digits, 3)')} "
        f"WHEN digits LIKE '{code}%' AND (length(digits) > {longest} "
        f"OR (NOT regexp_full_match(digits, '{valid}') AND regexp_full_match({own}, '{valid}'))) "
        f"THEN {national(own)} ELSE {national('digits')} END, '+{code}' || kept)"
    )


def with_phone(source: str, country: str = "country") -> str:
    """``source`` with normalized_phone (and helpers kept, digits)."""
    return f"""(
  SELECT *, CASE
    WHEN kept = '' THEN NULL
    WHEN kept LIKE '+%' THEN coalesce({_coded('digits')}, kept)
    WHEN trim({country}) = 'UK' THEN {_domestic('44', 10, _UK_VALID, _uk)}
    WHEN trim({country}) = 'France' THEN {_domestic('33', 9, _FR_VALID, _fr)}
    ELSE kept END AS normalized_phone
  FROM (SELECT *, regexp_replace(kept, '^\\++|\\++$', '', 'g') AS digits
        FROM (SELECT *, regexp_replace(phone, '[^0-9+]', '', 'g') AS kept FROM {source})))"""


def _expected_phone() -> str:
    """Numbers dialled abroad and in other scripts, one value per case; else the rule."""
    n8, local = "lpad(CAST(id AS VARCHAR), 8, '0')", "country IN ('UK', 'France')"
    return f"""CASE id % 30
      WHEN 24 THEN CASE WHEN {local} THEN '+1415555' ELSE '001415555' END || substr({n8}, 5, 4)
      WHEN 25 THEN CASE WHEN {local} THEN '+35386' ELSE '0035386' END || substr({n8}, 2, 7)
      WHEN 26 THEN CASE WHEN {local} THEN '+49151' ELSE '0049151' END || {n8}
      WHEN 27 THEN '+35386' || substr({n8}, 2, 7)
      WHEN 28 THEN '+4479' || {n8}
      WHEN 29 THEN CASE country WHEN 'UK' THEN '+4479' WHEN 'France' THEN '+33079'
        ELSE '079' END || {n8}
      ELSE normalized_phone END"""


def months(a: str, d: str) -> str:
    return f"""CAST(round(CAST(CASE
  WHEN day({a}) = day({d}) OR ({a} = last_day({a}) AND {d} = last_day({d}))
    THEN CAST((year({a}) - year({d})) * 12 + month({a}) - month({d}) AS DOUBLE)
  ELSE CAST(round(CAST((year({a}) - year({d})) * 12 + month({a}) - month({d})
    + (day({a}) - day({d})) / 31.0 AS DECIMAL(18, 10)), 8) AS DOUBLE)
  END AS DECIMAL(18, 8)), 1) AS DOUBLE)"""


def tenure_columns(registered: str) -> str:
    return (
        f"CAST(date_diff('day', {registered}, {AS_OF}) AS INTEGER) AS customer_tenure_days, "
        f"{months(AS_OF, registered)} AS customer_tenure_months"
    )


def active(last: str) -> str:
    return f"({last} IS NOT NULL AND date_diff('day', {last}, {AS_OF}) <= 365)"


def score(email: str) -> str:
    return (
        f"CAST(CASE WHEN {email} IS NOT NULL THEN 25 ELSE 0 END "
        "+ CASE WHEN phone LIKE '+%' THEN 25 ELSE 10 END "
        "+ CASE WHEN address IS NOT NULL THEN 20 ELSE 0 END "
        "+ CASE WHEN city IS NOT NULL THEN 15 ELSE 0 END "
        "+ CASE WHEN country IS NOT NULL THEN 15 ELSE 0 END AS INTEGER)"
    )


BAND = "CASE WHEN {c} >= 0.8 THEN 'high' WHEN {c} >= 0.5 THEN 'medium' ELSE 'low' END"


# --- shared steps -------------------------------------------------------------


def _newest(source: str, key: str, newest: str, columns: tuple[str, ...]) -> str:
    ties = ", ".join(f"{c} ASC NULLS LAST" for c in columns if c not in (key, newest))
    return (
        f"SELECT {', '.join(columns)} FROM (SELECT *, row_number() OVER (PARTITION BY {key} "
        f"ORDER BY {newest} DESC NULLS LAST, {ties}) AS rn FROM {source}) WHERE rn = 1"
    )


CRM_TIDY = CRM_TEXT + ("normalized_email", "normalized_phone")
TRX_TIDY = TRX_TEXT + ("normalized_email", "normalized_phone")


def _pairs(rule: str, confidence: str, keys: tuple[str, ...], label: str) -> str:
    same = " AND ".join(f"c.{k} = t.{k} AND c.{k} <> ''" for k in keys)
    return (
        f"SELECT c.customer_id AS crm_customer_id, t.transaction_id, {label} AS match_key, "
        f"'{rule}' AS match_type, CAST({confidence} AS DOUBLE) AS confidence_score "
        f"FROM crm c JOIN trx t ON {same}"
    )


STEPS = {
    "crm_raw": fixture.duckdb(fixture.CRM_RAW_SQL),
    "trx_raw": fixture.duckdb(fixture.TRX_RAW_SQL),
    "crm_tidy": f"""SELECT trim(customer_id) AS customer_id, trim(first_name) AS first_name,
      trim(last_name) AS last_name, email, phone, trim(address) AS address,
      trim(city) AS city, trim(country) AS country,
      {day('registration_date')} AS registration_date, {day('last_updated')} AS last_updated,
      {mail('email')} AS normalized_email, normalized_phone
      FROM {with_phone('crm_raw')}""",
    "trx_tidy": f"""SELECT trim(transaction_id) AS transaction_id, customer_email,
      trim(first_name) AS first_name, trim(last_name) AS last_name, phone,
      trim(shipping_address) AS shipping_address, trim(city) AS city,
      trim(country) AS country, {day('purchase_date')} AS purchase_date,
      {mail('customer_email')} AS normalized_email, normalized_phone
      FROM {with_phone('trx_raw')}""",
    "crm": "SELECT *, 'CRM' AS source FROM ("
    + _newest("crm_tidy", "customer_id", "last_updated", CRM_TIDY) + ")",
    "trx": "SELECT *, 'TRX' AS source FROM ("
    + _newest("trx_tidy", "transaction_id", "purchase_date", TRX_TIDY) + ")",
    "pairs_email": _pairs("email", "1.0", ("normalized_email",), "c.normalized_email"),
    "pairs_phone": _pairs("phone", "0.8", ("normalized_phone",), "c.normalized_phone"),
    "pairs_name": _pairs(
        "name_address", "0.6", ("first_name", "last_name", "city", "country"),
        "c.first_name || '|' || c.last_name || '|' || c.city",
    ),
    "pairs": "SELECT * FROM pairs_email UNION ALL SELECT * FROM pairs_phone "
    "UNION ALL SELECT * FROM pairs_name",
    "best": """SELECT crm_customer_id, transaction_id, match_type, confidence_score,
      concat_ws('_', 'GOLD', crm_customer_id) AS gold_customer_id
      FROM (SELECT *, row_number() OVER (PARTITION BY crm_customer_id
        ORDER BY confidence_score DESC, transaction_id ASC NULLS LAST) AS rn
        FROM pairs WHERE confidence_score >= 0.5) WHERE rn = 1""",
    "unmatched": """SELECT customer_id AS crm_customer_id, CAST(NULL AS VARCHAR) AS transaction_id,
      CAST(NULL AS VARCHAR) AS match_type, CAST(0 AS DOUBLE) AS confidence_score,
      concat_ws('_', 'GOLD', customer_id) AS gold_customer_id
      FROM crm WHERE NOT EXISTS (
        SELECT 1 FROM best WHERE crm_customer_id IS NOT DISTINCT FROM customer_id)""",
    "mapping": "SELECT * FROM best UNION ALL SELECT * FROM unmatched",
    "latest": """SELECT normalized_email, normalized_phone AS txn_normalized_phone,
      phone AS txn_phone_raw, customer_email AS txn_email,
      transaction_id AS latest_transaction_id, first_name AS txn_first_name,
      last_name AS txn_last_name, shipping_address AS txn_address, city AS txn_city,
      country AS txn_country
      FROM (SELECT *, row_number() OVER (PARTITION BY normalized_email
        ORDER BY purchase_date DESC NULLS LAST, transaction_id DESC NULLS LAST) AS rn FROM trx)
      WHERE rn = 1""",
    "facts": """SELECT g.*, l.* EXCLUDE (normalized_email) FROM (
      SELECT normalized_email, min(purchase_date) AS first_purchase_date,
        max(purchase_date) AS last_purchase_date, count(*) AS total_transactions,
        array_to_string(list(transaction_id ORDER BY transaction_id)[1:100], ',')
          AS sample_transaction_ids
      FROM trx GROUP BY normalized_email) g
      JOIN latest l ON g.normalized_email IS NOT DISTINCT FROM l.normalized_email""",
    "merged": f"""SELECT m.gold_customer_id,
      coalesce(c.first_name, f.txn_first_name) AS first_name,
      coalesce(c.last_name, f.txn_last_name) AS last_name,
      c.normalized_email AS email,
      coalesce(c.normalized_phone, f.txn_normalized_phone) AS phone,
      c.phone AS raw_crm_phone, f.txn_phone_raw,
      coalesce(f.txn_address, c.address) AS address,
      coalesce(f.txn_city, c.city) AS city, coalesce(f.txn_country, c.country) AS country,
      c.registration_date, c.last_updated, f.first_purchase_date, f.last_purchase_date,
      coalesce(f.total_transactions, 0) AS total_transactions,
      coalesce(f.sample_transaction_ids, '') AS sample_transaction_ids,
      m.match_type, m.confidence_score AS confidence,
      {BAND.format(c='m.confidence_score')} AS match_quality,
      m.crm_customer_id AS crm_id, m.transaction_id AS txn_id, f.latest_transaction_id
      FROM mapping m LEFT JOIN crm c ON m.crm_customer_id IS NOT DISTINCT FROM c.customer_id
      LEFT JOIN facts f ON c.normalized_email = f.normalized_email
        AND trim(c.normalized_email) <> ''""",
    "master": f"""SELECT *, {tenure_columns('registration_date')},
      {active('last_purchase_date')} AS is_active, {score('email')} AS data_quality_score,
      'GOLDEN_RECORD' AS source FROM merged""",
}


def _until(table: str, tidy: str, key: str, newest: str, columns: tuple[str, ...], lots: int) -> str:
    """The newest rows of the first batches."""
    lot = {"crm": fixture.CRM_LOT, "trx": fixture.TRX_LOT}[table]
    lot = lot.replace(f"right({newest}, 1)", f"right(CAST({newest} AS VARCHAR), 1)")
    return _newest(f"(SELECT * FROM {tidy} WHERE {lot} < {lots})", key, newest, columns)


def _touched() -> str:
    """Customers that the last batch brings or renews, or that share a key with a transaction it changes."""
    last = fixture.BATCHES
    crm = [_until("crm", "crm_tidy", "customer_id", "last_updated", CRM_TIDY, k + 1) for k in range(last)]
    trx = [_until("trx", "trx_tidy", "transaction_id", "purchase_date", TRX_TIDY, k + 1) for k in range(last)]
    rules = (("normalized_email",), ("normalized_phone",), ("first_name", "last_name", "city", "country"))
    shared = " UNION ".join(
        "SELECT c.customer_id FROM versions c JOIN changed t ON "
        + " AND ".join(f"c.{k} = t.{k} AND trim(c.{k}) <> ''" for k in keys)
        for keys in rules
    )
    return f"""(WITH versions AS ({' UNION '.join(f'({x})' for x in crm)}),
      before AS ({trx[-2]}), now AS ({trx[-1]}),
      changed AS ((TABLE now EXCEPT TABLE before) UNION (TABLE before EXCEPT TABLE now))
      {shared} UNION SELECT customer_id FROM (({crm[-1]}) EXCEPT ({crm[-2]})))"""


def _snapshots() -> str:
    """The merged record after each day, as ``s``, 0 on."""
    parts = []
    for number, day in enumerate(fixture.SNAPSHOT_DAYS):
        bought = {"trx": f"SELECT * FROM ({STEPS['trx']}) WHERE purchase_date <= DATE '{day}'"}
        steps = ", ".join(f"{name} AS ({sql})" for name, sql in (STEPS | bought).items())
        parts.append(f"SELECT {number} AS s, m AS record FROM (WITH {steps} SELECT * FROM merged) m")
    return " UNION ALL ".join(parts)


def _history() -> str:
    days = ", ".join(f"DATE '{day}'" for day in fixture.SNAPSHOT_DAYS)
    same = "OVER (PARTITION BY record.crm_id ORDER BY s)"
    return f"""WITH snapshots AS ({_snapshots()}),
      marked AS (SELECT *, s = 0 OR lag(record) {same} IS DISTINCT FROM record AS begins FROM snapshots),
      intervals AS (SELECT record, [{days}][s + 1] AS valid_from, [{days}][lead(s) {same} + 1] AS valid_to FROM marked WHERE begins)
      SELECT unnest(record), valid_from, valid_to FROM intervals"""


def _households() -> str:
    """The smallest id reachable over hubs of shared keys, by recursion."""
    hubs = " UNION ".join(
        f"SELECT customer_id AS a, min(customer_id) OVER (PARTITION BY {', '.join(keys)}) AS b FROM crm "
        f"WHERE customer_id IS NOT NULL AND {' AND '.join(f'{k} IS NOT NULL' for k in keys)}"
        for keys in fixture.HOUSEHOLD_KEYS
    )
    steps = ",\n".join(f"{name} AS ({sql})" for name, sql in STEPS.items())
    return f"""WITH RECURSIVE {steps}, one_way AS (SELECT a, b FROM ({hubs}) WHERE a <> b),
      links AS (SELECT a, b FROM one_way UNION SELECT b, a FROM one_way),
      reach(id, other) AS (SELECT customer_id, customer_id FROM crm WHERE customer_id IS NOT NULL
        UNION SELECT r.id, l.b FROM reach r JOIN links l ON r.other = l.a),
      named AS (SELECT id AS customer_id, min(other) AS household_id FROM reach GROUP BY id)
      SELECT customer_id, household_id, count(*) OVER (PARTITION BY household_id) AS members FROM named
      UNION ALL SELECT NULL, NULL, 1 FROM crm WHERE customer_id IS NULL"""


def _chain(final: str) -> str:
    """``final`` after all steps; DuckDB evaluates only those it needs."""
    steps = ",\n".join(f"{name} AS ({sql})" for name, sql in STEPS.items())
    return f"WITH {steps}\n{final}"


# --- quality reports ----------------------------------------------------------


def _completeness(source: str, columns: tuple[str, ...]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count({c}) AS complete_count, "
        f"count(*) AS total_records, count(*) - count({c}) AS null_count, "
        f"{pct(f'count({c})', 'count(*)')} AS completeness_percentage FROM {source}"
        for c in columns
    )


def _validity(source: str, formats) -> str:
    def one(label: str, column: str, pattern: str) -> str:
        good = f"count(*) FILTER (WHERE regexp_matches({column}, '{pattern}'))"
        return (
            f"SELECT '{label}' AS field, {good} AS valid_count, "
            f"count({column}) AS non_null_count, count({column}) - {good} AS invalid_count, "
            f"{pct(good, f'count({column})')} AS validity_percentage FROM {source}"
        )

    return " UNION ALL ".join(one(*entry) for entry in formats)


def _uniqueness(source: str, columns: tuple[str, ...]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST(coalesce(sum(n), 0) AS BIGINT) AS total_records, "
        f"count(*) AS distinct_records, "
        f"CAST(coalesce(sum(n), 0) AS BIGINT) - count(*) AS duplicate_count, "
        f"count(*) FILTER (WHERE n > 1) AS duplicate_groups_count, "
        f"{pct('count(*)', 'coalesce(sum(n), 0)')} AS uniqueness_percentage "
        f"FROM (SELECT {c}, count(*) AS n FROM {source} GROUP BY {c})"
        for c in columns
    )


def _lines(name: str, source: str, width: int, columns, formats, key, dated) -> str:
    """A whole profile as tidy lines."""
    parts = []

    def add(section: str, label: str, metrics: tuple[str, ...], rows: str) -> None:
        parts.extend(
            f"SELECT '{section}' AS section, {label} AS column_name, "
            f"'{metric if metric != 'non_null_count' else 'total_records'}' AS metric, "
            f"CAST({metric} AS DOUBLE) AS metric_value, CAST(NULL AS DATE) AS metric_date "
            f"FROM ({rows})"
            for metric in metrics
        )

    add("summary", "CAST(NULL AS VARCHAR)", ("total_records", "column_count"),
        f"SELECT count(*) AS total_records, {width} AS column_count FROM {source}")
    add("completeness", "column_name",
        ("complete_count", "total_records", "null_count", "completeness_percentage"),
        _completeness(source, columns))
    if formats:
        add("format_validity", "field",
            ("valid_count", "non_null_count", "invalid_count", "validity_percentage"),
            _validity(source, formats))
    if key:
        add("uniqueness", "column_name",
            ("total_records", "distinct_records", "duplicate_count",
             "duplicate_groups_count", "uniqueness_percentage"),
            _uniqueness(source, (key,)))
    parts += [
        f"SELECT 'freshness', '{dated}', '{bound}_date', CAST(NULL AS DOUBLE), "
        f"{bound}({dated}) FROM {source}"
        for bound in ("min", "max")
    ]
    return f"SELECT '{name}' AS source, * FROM ({' UNION ALL '.join(parts)})"


def _list(columns: tuple[str, ...], *leave_out: str) -> str:
    return ", ".join(c for c in columns if c not in leave_out)


_FULL_NAME = "lower({x}.first_name || ' ' || {x}.last_name)"
_NEAR_NAMES = f"""SELECT *, levenshtein(name, other_name) AS edits
  FROM (SELECT DISTINCT {_FULL_NAME.format(x='c')} AS name, city, country FROM crm c)
  JOIN (SELECT DISTINCT {_FULL_NAME.format(x='t')} AS other_name, city, country FROM trx t) USING (city, country)
  WHERE levenshtein(name, other_name) <= 1"""

SPEC = ProfileSpec()
_CRM_LINES = _lines("CRM", "crm", 14, SPEC.columns, SPEC.formats, "customer_id", "last_updated")
_CONTACT = (("email", "email", EMAIL_PATTERN), ("phone", "phone", PHONE_PATTERN))
_MASTER = _list(MASTER_COLUMNS, "ingestion_timestamp")

FINAL = {
    # An empty field of a CSV file is NULL.
    "crm_csv_roundtrip": "SELECT * REPLACE (nullif(email, '') AS email) FROM crm_raw",
    "trx_csv_roundtrip": "SELECT * REPLACE (nullif(customer_email, '') AS customer_email) FROM trx_raw",
    "feed_accepted": "SELECT * REPLACE (nullif(email, '') AS email) FROM crm_raw "
    "WHERE cast(coalesce(substr(trim(customer_id), 4), '0') as int) % 50 NOT IN (3, 7, 11)",
    "feed_rejects": "SELECT CASE kind WHEN 11 THEN 'encoding' ELSE 'columns' END AS reason, line "
    f"FROM ({fixture.FEED_LINES_SQL.format(crm_raw='SELECT * FROM crm_raw')}) WHERE damaged",
    "crm_clean": "SELECT * FROM crm_tidy",
    "trx_clean": "SELECT * FROM trx_tidy",
    "normalize_email": f"SELECT id, email, {mail('email')} AS normalized_email "
    f"FROM ({fixture.duckdb(fixture.EMAIL_CASES_SQL)})",
    "normalize_phone": f"SELECT id, country, phone, {_expected_phone()} AS normalized_phone FROM "
    + with_phone(f"({fixture.duckdb(fixture.PHONE_CASES_SQL)})"),
    "normalize_date": f"SELECT id, text, {day('text')} AS parsed, coalesce({day('text')}, "
    "CASE WHEN text LIKE '%T10:00:00' THEN CAST(text[:10] AS DATE) END) AS parsed_optional "
    f"FROM ({fixture.duckdb(fixture.DATE_CASES_SQL)})",
    "dedup_crm": _newest("crm_raw", "customer_id", "last_updated", CRM_TEXT),
    "dedup_trx": _newest("trx_raw", "transaction_id", "purchase_date", TRX_TEXT),
    "lineage_columns": "SELECT customer_id, last_updated, 'CRM' AS source, "
    f"'{fixture.AS_OF_TIME}' AS ingested FROM crm_raw",
    "crm_clean_dedup": "SELECT * FROM crm",
    "trx_clean_dedup": "SELECT * FROM trx",
    "row_counts": " UNION ALL ".join(
        f"SELECT '{t}' AS source, count(*) AS total_records FROM {t}"
        for t in ("crm_raw", "trx_raw", "crm", "trx")
    ),
    "quality_completeness": _completeness("crm", SPEC.columns),
    "quality_missing_column": _completeness("trx", ("first_name", "normalized_email"))
    + " UNION ALL SELECT 'loyalty_tier', NULL, count(*), NULL, NULL FROM trx",
    "quality_validity": _validity("crm", SPEC.formats),
    "quality_uniqueness": _uniqueness(
        "crm_tidy", ("customer_id", "normalized_email", "city")
    ),
    "quality_freshness": "SELECT 'purchase_date' AS column_name, min(purchase_date) AS min_date, "
    "max(purchase_date) AS max_date FROM trx UNION ALL "
    "SELECT 'last_updated', CAST(NULL AS DATE), CAST(NULL AS DATE)",
    "quality_report_crm": _CRM_LINES,
    "quality_report_trx": _lines(
        "TRX", "trx", 13, SPEC.columns, SPEC.formats, "transaction_id", "purchase_date"
    ),
    "quality_report_master": _lines(
        "GOLDEN", "master", 28, ("first_name", "last_name", "city", "country"), (), None,
        "last_updated",
    ),
    "quality_report_master_full": _lines(
        "GOLDEN", "master", 28,
        ("first_name", "last_name", "email", "phone", "city", "country"),
        _CONTACT, "gold_customer_id", "last_updated",
    ),
    "match_email": "SELECT * FROM pairs_email",
    "match_phone": "SELECT * FROM pairs_phone",
    "match_name_address": "SELECT * FROM pairs_name",
    "all_matches": "SELECT * FROM pairs",
    "match_threshold": "SELECT * FROM pairs WHERE confidence_score >= 0.7",
    "match_key_counts": """SELECT match_type, match_key, count(DISTINCT crm_customer_id) AS customers,
      count(DISTINCT transaction_id) AS transactions, count(*) AS pairs FROM (
        SELECT p.match_type, coalesce(p.crm_customer_id, '-') AS crm_customer_id, p.transaction_id,
          CASE WHEN match_type = 'name_address' THEN match_key || '|' || c.country ELSE match_key END
            AS match_key
        FROM pairs p JOIN crm c ON c.customer_id IS NOT DISTINCT FROM p.crm_customer_id)
      GROUP BY match_type, match_key""",
    "near_names": f"SELECT * FROM ({_NEAR_NAMES})",
    "fuzzy_match": f"""SELECT customer_id AS crm_customer_id, transaction_id, match_key, edits FROM (
      SELECT c.customer_id, t.transaction_id, {_FULL_NAME.format(x='c')} AS match_key, n.edits,
        row_number() OVER (PARTITION BY c.customer_id ORDER BY n.edits, t.transaction_id) AS rn
      FROM crm c JOIN ({_NEAR_NAMES}) n ON n.name = {_FULL_NAME.format(x='c')} AND n.city = c.city AND n.country = c.country
      JOIN trx t ON n.other_name = {_FULL_NAME.format(x='t')} AND n.city = t.city AND n.country = t.country) WHERE rn = 1""",
    "best_match": "SELECT * FROM best",
    "unmatched_customers": "SELECT * FROM unmatched",
    "reconcile": "SELECT * FROM mapping",
    "staged_reuse": "SELECT * FROM mapping",
    "match_stats": "SELECT match_type, count(*) AS count, "
    + pct("count(*)", "(SELECT count(*) FROM mapping)")
    + " AS percentage FROM mapping GROUP BY match_type",
    "match_stats_empty": "SELECT match_type, count(*) AS count, "
    + pct("count(*)", "count(*)")
    + " AS percentage FROM mapping m JOIN crm c ON c.customer_id IS NOT DISTINCT FROM m.crm_customer_id "
    "WHERE c.country = 'Atlantis' GROUP BY match_type",
    "match_rate": "SELECT count(match_type) AS matched, count(*) AS total, "
    + pct("count(match_type)", "count(*)") + " AS match_rate FROM mapping",
    "txn_aggregate": "SELECT * FROM facts",
    "latest_transaction": "SELECT * FROM latest",
    "survivorship": "SELECT * FROM merged",
    "match_quality": "SELECT crm_customer_id, confidence_score, "
    + BAND.format(c="confidence_score") + " AS match_quality FROM mapping",
    "tenure": "SELECT customer_id, registration_date, "
    + tenure_columns("registration_date") + " FROM crm",
    "is_active": f"SELECT transaction_id, purchase_date, {active('purchase_date')} "
    "AS is_active FROM trx",
    "data_quality_score": "SELECT customer_id, "
    + score("normalized_email") + " AS data_quality_score FROM crm",
    "master_record": f"SELECT {_MASTER} FROM master",
    "analytics_subset": f"SELECT {_list(ANALYTICS_COLUMNS)} FROM master",
    "master_sample": f"SELECT {_list(SAMPLE_COLUMNS)} FROM master "
    "ORDER BY gold_customer_id LIMIT 10",
    "incremental_master": f"SELECT {_MASTER} FROM master",
    # An empty field of a CSV file is NULL; an email of blanks stays one.
    "stream_trx_clean_dedup": "SELECT * REPLACE (nullif(customer_email, '') AS customer_email, "
    "CASE WHEN customer_email <> '' THEN normalized_email END AS normalized_email) FROM trx",
    "incremental_touched": f"""SELECT crm_id, match_type, txn_id, total_transactions FROM merged m
      WHERE EXISTS (SELECT 1 FROM {_touched()} t WHERE t.customer_id IS NOT DISTINCT FROM m.crm_id)""",
    "sink_master_parquet": f"SELECT {_MASTER} FROM master",
    "sink_analytics_parquet": f"SELECT {_list(ANALYTICS_COLUMNS)} FROM master",
    "sink_quality_json": _CRM_LINES,
}


def statements() -> dict[str, str]:
    return {name: _chain(final) for name, final in FINAL.items()} | {
        "master_history": _history(),
        "households": _households(),
    }
