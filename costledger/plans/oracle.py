"""The registered queries as plain SQL over the same tables, to check the DataFrame plans against."""

from __future__ import annotations

from costledger.operators.contract import COUNTER_LABELS
from costledger.operators.reconcile import BODY, Letter
from costledger.plans import views
from costledger.plans.queries import CHUNK, DRY_RUN_LIMIT
from costledger.schemas import REFERENCE

YEARS = range(1995, 2002)


def _number(text: str) -> str:
    """Finite number in a text, else NULL."""
    pattern = r"^[+-]?([0-9](_?[0-9])*\.?([0-9](_?[0-9])*)?|\.[0-9](_?[0-9])*)([eE][+-]?[0-9](_?[0-9])*)?$"
    return f"CASE WHEN regexp_matches({text}, '{pattern}') THEN TRY_CAST(replace({text}, '_', '') AS DOUBLE) END"


def _loose(column: str) -> str:
    return f"coalesce(TRY_CAST(trim({column}) AS DOUBLE), 0.0)"


def _money(column: str) -> str:
    return f"CAST(sum(CAST({column} AS DECIMAL(18,2))) AS DOUBLE)"


# Cells with the canonical names of headers.
_NAMED = """SELECT *, CASE lower(regexp_replace(trim(cell), ' +', ' ', 'g')) WHEN 'school' THEN 'school' WHEN 'subject' THEN 'subject'
        WHEN 'subject no' THEN 'subject_no' WHEN 'subject no.' THEN 'subject_no' WHEN 'subject number' THEN 'subject_no'
        WHEN 'teaching session' THEN 'teaching_session' WHEN 'incl oncosts' THEN 'incl_oncosts' WHEN 'incl. oncosts' THEN 'incl_oncosts'
        WHEN 'student count' THEN 'student_count' ELSE coalesce(trim(cell), '') END AS name FROM {0}"""

# Named subqueries, each with those it builds on.
PARTS: dict[str, tuple[tuple[str, ...], str]] = {
    "contract_raw": ((), views.plain(views.CONTRACT_RAW)),
    "contract_lines": ((), views.plain(views.CONTRACT_LINES)),
    "digests": (
        ("contract_lines",),
        """SELECT subject_no, sum(strlen(line) + 1)::BIGINT AS length, sha256(string_agg(line || chr(10), '' ORDER BY line)) AS sha256
        FROM contract_lines GROUP BY subject_no""",
    ),
    "remarks": ((), views.plain(views.REMARKS)),
    "typed": (
        ("contract_raw",),
        f"""SELECT trim(school) AS school, trim(subject_no) AS subject_no, trim(subject) AS subject,
        TRY_CAST(nullif(regexp_extract(teaching_session, '(19|20)[0-9][0-9]', 0), '') AS INTEGER) AS year,
        {_number("trim(replace(replace(incl_oncosts, '$', ''), ',', ''))")} AS cost,
        CAST(trunc({_number("trim(replace(student_count, ',', ''))")}) AS HUGEINT) AS students FROM contract_raw""",
    ),
    "classified": (
        ("typed",),
        """SELECT *, CASE WHEN lower(school) IN ('total', 'sum', 'result') OR lower(subject) IN ('total', 'sum', 'result') THEN 'summary row'
        WHEN coalesce(school, '') = '' OR coalesce(subject_no, '') = '' OR coalesce(subject, '') = '' THEN 'missing key'
        WHEN year IS NULL THEN 'no year' WHEN students < 0 THEN 'negative students' ELSE 'kept' END AS reason FROM typed""",
    ),
    "kept": (
        ("classified",),
        """SELECT school, subject_no, subject, year, coalesce(cost, 0.0) AS cost, coalesce(students, 0) AS students
        FROM classified WHERE reason = 'kept'""",
    ),
    "subject_year": (
        ("kept",),
        f"""SELECT *, CASE WHEN total_students > 0 THEN total_oncosts / CAST(total_students AS DOUBLE) WHEN total_oncosts = 0 THEN 0.0 END AS cps,
        CASE WHEN total_students > 0 THEN 'OK' WHEN total_oncosts = 0 THEN 'No activity' ELSE 'Undefined (0 students)' END AS status
        FROM (SELECT school, subject_no, subject, year, {_money("cost")} AS total_oncosts, sum(students) AS total_students
        FROM kept GROUP BY ALL)""",
    ),
    "school_year": (
        ("kept",),
        f"""SELECT *, CASE WHEN total_students > 0 THEN total_oncosts / CAST(total_students AS DOUBLE) WHEN total_oncosts = 0 THEN 0.0 END AS cps,
        CASE WHEN total_students > 0 THEN 'OK' WHEN total_oncosts = 0 THEN 'No activity' ELSE 'Undefined (0 students)' END AS status
        FROM (SELECT school, year, {_money("cost")} AS total_oncosts, sum(students) AS total_students
        FROM kept GROUP BY ALL)""",
    ),
    "anchors": (
        ("school_year",),
        """SELECT year, min(x) AS a, (min(x) FILTER (WHERE place = (n + 1) // 2) + min(x) FILTER (WHERE place = n // 2 + 1)) / 2 AS b, max(x) AS c
        FROM (SELECT year, x, row_number() OVER (PARTITION BY year ORDER BY x NULLS LAST) AS place, count(x) OVER (PARTITION BY year) AS n
        FROM (SELECT year, CASE WHEN cps > 0 THEN cps END AS x FROM school_year)) GROUP BY year""",
    ),
    "memberships": (
        ("school_year", "anchors"),
        """SELECT s.school, s.year, s.cps AS x, a, b, c,
        CASE WHEN b <= a THEN CASE WHEN x <= a THEN 1.0 ELSE 0.0 END WHEN x <= a THEN 1.0 WHEN x >= b THEN 0.0 ELSE (b - x) / (b - a) END AS mu_low,
        CASE WHEN b <= a OR c <= b THEN CASE WHEN x = b THEN 1.0 ELSE 0.0 END WHEN x <= a OR x >= c THEN 0.0
             WHEN x <= b THEN (x - a) / (b - a) ELSE (c - x) / (c - b) END AS mu_medium,
        CASE WHEN c <= b THEN CASE WHEN x >= c THEN 1.0 ELSE 0.0 END WHEN x <= b THEN 0.0 WHEN x >= c THEN 1.0 ELSE (x - b) / (c - b) END AS mu_high
        FROM school_year AS s JOIN anchors USING (year) WHERE s.cps > 0""",
    ),
    "bands": (
        ("memberships",),
        """SELECT *, CASE WHEN mu_medium >= mu_low AND mu_medium >= mu_high THEN 'Medium' WHEN mu_low >= mu_high THEN 'Low' ELSE 'High' END AS band
        FROM memberships""",
    ),
    "counters": (
        ("classified", "subject_year", "school_year"),
        """SELECT CAST(count(*) AS BIGINT) AS rows_seen, count(*) FILTER (WHERE reason = 'missing key') AS dropped_missing_keys,
        count(*) FILTER (WHERE reason = 'no year') AS dropped_missing_year,
        count(*) FILTER (WHERE reason = 'summary row') AS dropped_summary_rows,
        count(*) FILTER (WHERE reason IN ('kept', 'negative students') AND cost IS NULL) AS missing_cost,
        count(*) FILTER (WHERE reason IN ('kept', 'negative students') AND students IS NULL) AS missing_students,
        count(*) FILTER (WHERE reason = 'negative students') AS negative_students,
        (SELECT count(*) FROM subject_year) AS subject_year_groups, (SELECT count(*) FROM school_year) AS school_year_groups,
        (SELECT count(*) FROM subject_year WHERE status = 'Undefined (0 students)') AS undefined_groups,
        (SELECT count(*) FROM subject_year WHERE status = 'No activity') AS no_activity_groups FROM classified""",
    ),
    "counter_rows": (("counters",), f"UNPIVOT counters ON {', '.join(COUNTER_LABELS)} INTO NAME metric VALUE value"),
    "reference_raw": ((), views.plain(views.REFERENCE_RAW)),
    "reference": (
        ("reference_raw",),
        """SELECT CASE WHEN length(trim(tr_code)) >= 7 THEN trim(tr_code) ELSE lpad(trim(tr_code), 7, '0') END AS tr_code,
        trim(staff_id) AS staff_id, first_name, family_name, email FROM reference_raw""",
    ),
    "reference_faulty": ((), views.plain(views.REFERENCE_FAULTY)),
    "transactions_raw": ((), views.plain(views.TRANSACTIONS_RAW)),
    "tx_all": (
        ("transactions_raw",),
        f"""SELECT nullif(regexp_extract(trim(activity), '^0*([0-9][0-9][0-9][0-9][0-9][0-9][0-9])', 1), '') AS tr_code,
        activity AS account_name, {_loose("debit")} AS debit, {_loose("credit")} AS credit, {_loose("net_amount")} AS net_amount,
        CAST(year AS INTEGER) AS year, month, journal_line_desc AS description, src_row // {CHUNK} AS batch_id, src_row FROM transactions_raw""",
    ),
    "tx": (("tx_all",), "SELECT * FROM tx_all WHERE tr_code IS NOT NULL"),
    "transactions_text": ((), views.plain(views.TRANSACTIONS_TEXT)),
    "text_years": (
        ("transactions_text",),
        f"""SELECT src_row, src_row // {CHUNK} AS batch_id, activity, year AS year_text, month,
        nullif(regexp_extract(trim(activity), '^0*([0-9][0-9][0-9][0-9][0-9][0-9][0-9])', 1), '') AS tr_code,
        CASE WHEN TRY_CAST(year AS DOUBLE) = floor(TRY_CAST(year AS DOUBLE)) THEN CAST(TRY_CAST(year AS DOUBLE) AS INTEGER) END AS year
        FROM transactions_text""",
    ),
    "batches": (
        ("tx_all",),
        "SELECT batch_id, count(tr_code) AS n_rows, count(*) AS n_all FROM tx_all GROUP BY batch_id",
    ),
    "batches_before": (
        ("batches",),
        """SELECT *, CAST(coalesce(sum(n_rows) OVER (ORDER BY batch_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT)
        AS rows_before FROM batches""",
    ),
    "matched": (
        ("tx", "reference"),
        "SELECT tx.*, staff_id, first_name, family_name, email FROM tx JOIN reference USING (tr_code)",
    ),
    "staff_totals": (
        ("matched",),
        f"""SELECT staff_id, arg_min(first_name, src_row) AS first_name,
        arg_min(coalesce(family_name, '-'), src_row) AS family_key, arg_min(email, src_row) AS email,
        count(*) AS txn_count, {_money("debit")} AS total_debit, {_money("credit")} AS total_credit,
        {_money("net_amount")} AS total_net_spend FROM matched WHERE staff_id IS NOT NULL GROUP BY staff_id""",
    ),
    "spender_files": ((), views.plain(views.SPENDER_FILES)),
    "spender_typed": (
        ("spender_files",),
        """SELECT *, TRY_CAST(replace(total_net_spend, ',', '') AS DOUBLE) AS v FROM spender_files""",
    ),
    "code_rows": (
        ("spender_files",),
        """SELECT file_key, row_num, 'tr_code' AS rule,
        concat(file_key, ': invalid TR_Code at row ', row_num, ': ''', trim(coalesce(tr_code, '')), '''') AS message
        FROM spender_files WHERE NOT regexp_full_match(trim(coalesce(tr_code, '')), '[0-9]{7}')""",
    ),
    "spender_order": (
        ("spender_typed",),
        """SELECT file_key, row_num, 'not sorted' AS rule, concat(file_key, ': Total_Net_Spend not sorted DESC at row ', row_num) AS message
        FROM (SELECT *, lag(v) OVER (PARTITION BY file_key ORDER BY row_num) AS p FROM spender_typed WHERE v IS NOT NULL) WHERE v > p""",
    ),
    "spender_cells": (
        ("spender_typed",),
        """SELECT file_key, row_num, CASE WHEN coalesce(trim(total_net_spend), '') = '' THEN 'missing value' ELSE 'invalid number' END AS rule,
        CASE WHEN coalesce(trim(total_net_spend), '') = '' THEN concat(file_key, ': missing Total_Net_Spend at row ', row_num)
        ELSE concat(file_key, ': invalid Total_Net_Spend at row ', row_num, ': ''', trim(total_net_spend), '''') END AS message
        FROM spender_typed WHERE v IS NULL""",
    ),
    "order_violations": (
        ("spender_order", "spender_cells", "code_rows"),
        """SELECT v.* FROM (SELECT * FROM spender_order UNION ALL SELECT * FROM spender_cells UNION ALL SELECT * FROM code_rows) AS v
        LEFT JOIN (SELECT file_key, min(row_num) AS stop FROM spender_order GROUP BY file_key) AS f USING (file_key)
        WHERE stop IS NULL OR row_num <= stop""",
    ),
    "trend_files": ((), views.plain(views.TREND_FILES)),
    "trend_typed": (
        ("trend_files",),
        """SELECT *, TRY_CAST(year AS DOUBLE) AS y, trim(month) AS m FROM trend_files""",
    ),
    "trend_order": (
        ("trend_typed",),
        """SELECT file_key, row_num, 'not sorted' AS rule,
        concat(file_key, CASE WHEN y > py THEN ': Year' ELSE ': Month' END, ' not sorted DESC at row ', row_num) AS message
        FROM (SELECT *, lag(y) OVER w AS py, lag(m) OVER w AS pm FROM trend_typed WHERE y = floor(y) AND m <> ''
        WINDOW w AS (PARTITION BY file_key ORDER BY row_num)) WHERE y > py OR (y = py AND m > pm)""",
    ),
    "trend_cells": (
        ("trend_typed",),
        """SELECT file_key, row_num, CASE WHEN coalesce(trim(year), '') = '' THEN 'missing value' WHEN y IS NULL THEN 'invalid number'
        WHEN y <> floor(y) THEN 'not whole' ELSE 'missing value' END AS rule,
        concat(file_key, CASE WHEN coalesce(trim(year), '') = '' THEN ': missing Year at row ' WHEN y IS NULL THEN ': invalid Year at row '
        WHEN y <> floor(y) THEN ': Year not an integer at row ' ELSE ': missing Month at row ' END, row_num,
        CASE WHEN trim(year) <> '' AND y IS NULL THEN concat(': ''', trim(year), '''') ELSE '' END) AS message
        FROM trend_typed WHERE y IS NULL OR y <> floor(y) OR coalesce(m, '') = ''""",
    ),
    "month_order_violations": (
        ("trend_order", "trend_cells"),
        """SELECT v.* FROM (SELECT * FROM trend_order UNION ALL SELECT * FROM trend_cells) AS v
        LEFT JOIN (SELECT file_key, min(row_num) AS stop FROM trend_order GROUP BY file_key) AS f USING (file_key)
        WHERE stop IS NULL OR row_num <= stop""",
    ),
    "statement_files": ((), views.plain(views.STATEMENT_FILES)),
    "statement_typed": (
        ("statement_files",),
        """SELECT *, trim(description) = 'TOTAL' AS is_total, TRY_CAST(coalesce(debit, '0') AS DECIMAL(38,4)) AS d,
        TRY_CAST(coalesce(credit, '0') AS DECIMAL(38,4)) AS c, TRY_CAST(coalesce(net_amount, '0') AS DECIMAL(38,4)) AS n FROM statement_files""",
    ),
    "last_total": (
        ("statement_typed",),
        """SELECT file_key, d, c, n FROM statement_typed WHERE is_total
        QUALIFY row_number() OVER (PARTITION BY file_key ORDER BY row_num DESC) = 1""",
    ),
    "statement_sums": (
        ("statement_typed", "last_total"),
        """SELECT s.*, l.d, l.c, l.n FROM (SELECT file_key, count(*) FILTER (WHERE is_total) AS n_totals,
        coalesce(sum(d) FILTER (WHERE NOT is_total), 0) AS sd, coalesce(sum(c) FILTER (WHERE NOT is_total), 0) AS sc,
        coalesce(sum(n) FILTER (WHERE NOT is_total), 0) AS sn FROM statement_typed GROUP BY file_key) AS s
        LEFT JOIN last_total AS l USING (file_key)""",
    ),
    "total_violations": (
        ("statement_sums", "statement_typed"),
        """SELECT file_key, CAST(NULL AS BIGINT) AS row_num, 'several totals' AS rule, concat(file_key, ': multiple TOTAL rows found') AS message
        FROM (SELECT file_key, unnest(range(1, n_totals)) FROM statement_sums)
        UNION ALL SELECT file_key, NULL, 'no total', concat(file_key, ': TOTAL row not found') FROM statement_sums WHERE n_totals = 0
        UNION ALL SELECT file_key, NULL, 'invalid number', concat(file_key, ': invalid Debit at row 0') FROM statement_sums WHERE n_totals > 0 AND d IS NULL
        UNION ALL SELECT file_key, NULL, 'invalid number', concat(file_key, ': invalid Credit at row 0') FROM statement_sums WHERE n_totals > 0 AND c IS NULL
        UNION ALL SELECT file_key, NULL, 'invalid number', concat(file_key, ': invalid Net_Amount at row 0') FROM statement_sums WHERE n_totals > 0 AND n IS NULL
        UNION ALL SELECT file_key, NULL, 'total differs', concat(file_key, ': TOTAL Debit does not match recomputed sum') FROM statement_sums
          WHERE n_totals > 0 AND abs(coalesce(d, 0) - sd) > 0.01
        UNION ALL SELECT file_key, NULL, 'total differs', concat(file_key, ': TOTAL Credit does not match recomputed sum') FROM statement_sums
          WHERE n_totals > 0 AND abs(coalesce(c, 0) - sc) > 0.01
        UNION ALL SELECT file_key, NULL, 'total differs', concat(file_key, ': TOTAL Net_Amount does not match recomputed sum') FROM statement_sums
          WHERE n_totals > 0 AND abs(coalesce(n, 0) - sn) > 0.01
        UNION ALL SELECT file_key, row_num, 'invalid number', concat(file_key, ': invalid Debit at row ', row_num) FROM statement_typed WHERE NOT is_total AND d IS NULL
        UNION ALL SELECT file_key, row_num, 'invalid number', concat(file_key, ': invalid Credit at row ', row_num) FROM statement_typed WHERE NOT is_total AND c IS NULL
        UNION ALL SELECT file_key, row_num, 'invalid number', concat(file_key, ': invalid Net_Amount at row ', row_num) FROM statement_typed WHERE NOT is_total AND n IS NULL""",
    ),
    "packages": ((), views.plain(views.PACKAGES)),
    "missing_tables": (
        ("packages",),
        """SELECT file_key, CAST(NULL AS BIGINT) AS row_num, 'missing table' AS rule, concat(file_key, ': missing ', name) AS message
        FROM (SELECT file_key, unnest(['Transaction_Ledger', 'All_Spenders', 'Monthly_Trends', 'Spending_by_Account']) AS name
        FROM (SELECT DISTINCT file_key FROM packages)) ANTI JOIN packages USING (file_key, name)""",
    ),
    "all_violations": (
        ("order_violations", "month_order_violations", "total_violations", "missing_tables"),
        """SELECT * FROM order_violations UNION ALL SELECT * FROM month_order_violations
        UNION ALL SELECT * FROM total_violations UNION ALL SELECT * FROM missing_tables""",
    ),
    "error_counts": (("all_violations",), "SELECT file_key, count(*) AS n_errors FROM all_violations GROUP BY file_key"),
    "raw_sheet": ((), views.plain(views.RAW_SHEET)),
    "sheet_cells": (
        ("raw_sheet",),
        """SELECT sheet_ord, sheet, row_idx, unnest([_c0, _c1, _c2, _c3, _c4, _c5, _c6, _c7]) AS cell, unnest(range(8)) AS position
        FROM raw_sheet WHERE row_idx <= 30""",
    ),
    "sheet_names": (
        ("sheet_cells",),
        _NAMED.format("sheet_cells"),
    ),
    "all_cells": (("raw_sheet",), "SELECT unnest([_c0, _c1, _c2, _c3, _c4, _c5, _c6, _c7]) AS cell FROM raw_sheet"),
    "all_names": (("all_cells",), _NAMED.format("all_cells")),
    "located": (
        ("sheet_names",),
        """SELECT sheet_ord, sheet, row_idx AS header_row, CAST(max(position) FILTER (WHERE name = 'school') AS INTEGER) AS school,
        CAST(max(position) FILTER (WHERE name = 'subject_no') AS INTEGER) AS subject_no,
        CAST(max(position) FILTER (WHERE name = 'subject') AS INTEGER) AS subject,
        CAST(max(position) FILTER (WHERE name = 'teaching_session') AS INTEGER) AS teaching_session,
        CAST(max(position) FILTER (WHERE name = 'incl_oncosts') AS INTEGER) AS incl_oncosts,
        CAST(max(position) FILTER (WHERE name = 'student_count') AS INTEGER) AS student_count
        FROM sheet_names GROUP BY ALL HAVING school IS NOT NULL AND subject_no IS NOT NULL AND subject IS NOT NULL
        AND teaching_session IS NOT NULL AND incl_oncosts IS NOT NULL AND student_count IS NOT NULL
        ORDER BY sheet_ord, header_row LIMIT 1""",
    ),
    "people_raw": ((), views.plain(views.PEOPLE_RAW)),
    "people_words": ((), views.plain(views.PEOPLE_WORDS)),
    "people_phrases": ((), views.plain(views.PEOPLE_PHRASES)),
}


def _dictionary(keys: str) -> str:
    """Dictionary out of a query of (key, is_id)."""
    return f"""SELECT arg_max(key, ord) AS key, key_lower, arg_max(alias, ord) AS alias, arg_max(is_id, ord) AS is_id FROM (
        SELECT key, lower(key) AS key_lower, is_id, CASE WHEN is_id THEN 1000000000000 ELSE 0 END + n AS ord,
        CASE WHEN is_id THEN concat('9', CASE WHEN n < 1000000 THEN lpad(CAST(n AS VARCHAR), 6, '0') ELSE CAST(n AS VARCHAR) END)
        ELSE concat('RedactedName_', n) END AS alias
        FROM (SELECT key, is_id, row_number() OVER (PARTITION BY is_id ORDER BY CASE WHEN is_id THEN 0 ELSE -length(key) END, key) AS n
        FROM (SELECT DISTINCT key, is_id FROM ({keys}) WHERE key <> ''))) GROUP BY key_lower"""


def _names(table: str, *columns: str) -> str:
    return " UNION ALL ".join(f"SELECT trim({c}) AS key, false AS is_id FROM {table}" for c in columns)


PARTS["staff_dictionary"] = (
    ("reference_raw",),
    _dictionary(
        _names("reference_raw", "first_name", "family_name")
        + " UNION ALL SELECT key, false FROM (SELECT unnest(string_split_regex(split_part(email, '@', 1), '[._-]')) AS key"
        + " FROM reference_raw WHERE contains(email, '@')) WHERE length(key) > 2"
        + " UNION ALL SELECT trim(staff_id), true FROM reference_raw"
    ),
)
PARTS["people_dictionary"] = (("people_raw",), _dictionary(_names("people_raw", "first_name")))
PARTS["word_dictionary"] = (("people_words",), _dictionary(_names("people_words", "first_name")))
PARTS["phrase_dictionary"] = (("people_phrases",), _dictionary(_names("people_phrases", "first_name")))

RUNS = r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_]+"


def _redacted(table: str, key: str, column: str, dictionary: str) -> str:
    """Each run of a text looked up on its own."""
    return f"""SELECT {key}, string_agg(coalesce(alias, run), '' ORDER BY i) AS shown FROM (
    SELECT {key}, unnest(runs) AS run, unnest(range(1, len(runs) + 1)) AS i
    FROM (SELECT {key}, regexp_extract_all({column}, '{RUNS}') AS runs FROM {table})) LEFT JOIN {dictionary} ON key_lower = lower(run)
    GROUP BY {key}"""


# Phrases are a word, a space and a word, so two of them can only share a word. Of a chain of shared ones the first,
# third, ... are taken.
PARTS["text_runs"] = (
    (),
    f"""SELECT doc_id, i, run FROM (SELECT doc_id, unnest(runs) AS run, unnest(range(1, len(runs) + 1)) AS i
    FROM (SELECT doc_id, regexp_extract_all(text, '{RUNS}') AS runs FROM documents))""",
)
PARTS["phrase_starts"] = (
    ("text_runs", "phrase_dictionary"),
    """SELECT doc_id, i, alias FROM (SELECT doc_id, i, lower(concat(run, lead(run, 1) OVER w, lead(run, 2) OVER w)) AS phrase
    FROM text_runs WINDOW w AS (PARTITION BY doc_id ORDER BY i)) JOIN phrase_dictionary ON phrase = key_lower""",
)
PARTS["phrases_taken"] = (
    ("phrase_starts",),
    """SELECT doc_id, i, alias FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, chain ORDER BY i) AS place FROM (
    SELECT *, i - 2 * row_number() OVER (PARTITION BY doc_id, i % 2 ORDER BY i) AS chain FROM phrase_starts)) WHERE place % 2 = 1""",
)


def _sql(select: str, *needs: str) -> str:
    """The query with the subqueries it needs, in order."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        for other in PARTS[name][0]:
            visit(other)
        if name not in ordered:
            ordered.append(name)

    for name in needs:
        visit(name)
    ctes = ",\n".join(f"{name} AS ({PARTS[name][1]})" for name in ordered)
    return f"WITH {ctes}\n{select}" if ctes else select


def _per_year(expression: str) -> str:
    return ", ".join(expression.format(y=y) for y in YEARS)


def _message_body() -> str:
    letter = Letter()
    text = BODY.format(
        general_contact=letter.general_contact, finance_contact=letter.finance_contact, signature=letter.signature
    )
    values = ["trim(first_name)", "CAST(txn_count AS VARCHAR)"] + [
        f"format('{{:,.2f}}', {c})" for c in ("total_debit", "total_credit", "total_net_spend")
    ]
    pieces = [f"'{piece}'" for piece in text.split("%s")]
    parts = [pieces[0]]
    for value, piece in zip(values, pieces[1:]):
        parts += [value, piece]
    return f"concat({', '.join(parts)})"


_FAMILY = "CASE WHEN family_key = '-' THEN NULL ELSE family_key END"
_SAFE = f"concat(trim(first_name), '_', coalesce({_FAMILY}, 'None'))"
_YEAR_COLUMNS = "school, {keys}year, total_oncosts, TRY_CAST(total_students AS BIGINT) AS total_students, cps AS oncosts_per_student, status"


def _case(column: str, values: dict[str, str]) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in values.items()) + " END"


ORACLE: dict[str, str] = {
    "clean_rows": _sql("SELECT * REPLACE (TRY_CAST(students AS BIGINT) AS students) FROM kept", "kept"),
    "drop_reasons": _sql("SELECT reason, count(*) AS n_rows FROM classified GROUP BY reason", "classified"),
    "quality_counters": _sql("SELECT metric, value FROM counter_rows", "counter_rows"),
    "subject_year": _sql(
        f"SELECT {_YEAR_COLUMNS.format(keys='subject_no, subject, ')} FROM subject_year", "subject_year"
    ),
    "school_year": _sql(f"SELECT {_YEAR_COLUMNS.format(keys='')} FROM school_year", "school_year"),
    "status_counts": _sql(
        "SELECT 'subject_year' AS grain, status, count(*) AS n_groups FROM subject_year GROUP BY status "
        "UNION ALL SELECT 'school_year', status, count(*) FROM school_year GROUP BY status",
        "subject_year",
        "school_year",
    ),
    "year_anchors": _sql(
        "SELECT year, a AS anchor_min, b AS anchor_median, c AS anchor_max FROM anchors",
        "anchors",
    ),
    "anchor_lines": _sql(
        "SELECT year, CASE WHEN a IS NULL THEN 'No finite positive values' "
        "ELSE format('min {:.2f}, median {:.2f}, max {:.2f}', a, b, c) END AS anchors FROM anchors",
        "anchors",
    ),
    "fuzzy_bands": _sql(
        "SELECT school, year, x AS cost_per_student, mu_low, mu_medium, mu_high, band, "
        "CAST(CASE band WHEN 'Low' THEN 0 WHEN 'Medium' THEN 0.5 ELSE 1 END AS DOUBLE) AS band_score, "
        "a AS anchor_min, b AS anchor_median, c AS anchor_max FROM bands",
        "bands",
    ),
    "rounded_bands": _sql(
        "SELECT school, year, x AS cost_per_student, "
        + ", ".join(
            f"CAST(format('{{:.4f}}', {c}) AS DOUBLE) AS {name}"
            for c, name in {
                "mu_low": "mu_low", "mu_medium": "mu_medium", "mu_high": "mu_high",
                "a": "anchor_min", "b": "anchor_median", "c": "anchor_max",
            }.items()
        )
        + ", band, CAST(CASE band WHEN 'Low' THEN 0 WHEN 'Medium' THEN 0.5 ELSE 1 END AS DOUBLE) AS band_score FROM bands",
        "bands",
    ),
    "band_summary": _sql(
        "SELECT year, count(*) FILTER (WHERE band = 'Low') AS low, count(*) FILTER (WHERE band = 'Medium') AS medium, "
        "count(*) FILTER (WHERE band = 'High') AS high, count(*) AS total FROM bands GROUP BY year",
        "bands",
    ),
    "trend_matrix": _sql(
        f"""SELECT school, {_per_year('max(cps) FILTER (WHERE year = {y}) AS "{y}"')} FROM school_year GROUP BY school""",
        "school_year",
    ),
    "subject_report": _sql(
        "SELECT school, subject_no, subject, "
        + _per_year('coalesce(max(total_oncosts) FILTER (WHERE year = {y}), 0.0) AS "{y} Incl Oncosts"')
        + ", "
        + _per_year('max(cps) FILTER (WHERE year = {y}) AS "{y} Incl Oncosts Per Student"')
        + ", "
        + _per_year('coalesce(max(TRY_CAST(total_students AS BIGINT)) FILTER (WHERE year = {y}), 0) AS "{y} Student Count"')
        + " FROM subject_year GROUP BY school, subject_no, subject",
        "subject_year",
    ),
    "processing_summary": _sql(
        "SELECT 0 AS ord, 'Input file SHA-256' AS label, sha256(string_agg(sha256, chr(10) ORDER BY sha256)) AS value FROM digests UNION ALL SELECT 1, 'Input sheet', sheet FROM located "
        "UNION ALL SELECT 2, 'Header row (1-based)', CAST(header_row AS VARCHAR) FROM located UNION ALL SELECT "
        + _case("metric", {name: str(i + 3) for i, name in enumerate(COUNTER_LABELS)})
        + ", "
        + _case("metric", {name: f"'{label}'" for name, label in COUNTER_LABELS.items()})
        + ", CAST(value AS VARCHAR) FROM counter_rows UNION ALL SELECT year + 1000, CAST(year AS VARCHAR), "
        "format('min {:.4f}, median {:.4f}, max {:.4f}', a, b, c) FROM anchors",
        "counter_rows",
        "anchors",
        "located",
        "digests",
    ),
    "reference_clean": _sql("SELECT * FROM reference", "reference"),
    "reference_issues": _sql(
        """SELECT 'missing TR_Code' AS rule, NULL AS tr_code, count(*) AS n_rows FROM reference_faulty WHERE tr_code IS NULL HAVING count(*) > 0
        UNION ALL SELECT 'empty TR_Code', NULL, count(*) FROM reference_faulty WHERE trim(tr_code) = '' OR lower(trim(tr_code)) = 'nan' HAVING count(*) > 0
        UNION ALL SELECT 'duplicate TR_Code', lpad(trim(tr_code), 7, '0'), count(*) FROM reference_faulty
        WHERE trim(tr_code) <> '' AND lower(trim(tr_code)) <> 'nan' GROUP BY 2 HAVING count(*) > 1""",
        "reference_faulty",
    ),
    "tx_clean": _sql("SELECT * FROM tx", "tx"),
    "tx_year_text": _sql("SELECT src_row, year, month FROM text_years WHERE tr_code IS NOT NULL", "text_years"),
    "bad_row_sample": _sql(
        """SELECT batch_id, src_row AS row_idx, 'TR_Code' AS "column", account_name AS value, 'Extraction Failed' AS issue
        FROM tx_all WHERE tr_code IS NULL QUALIFY row_number() OVER (PARTITION BY batch_id ORDER BY src_row) <= 5""",
        "tx_all",
    ),
    "data_issues": _sql(
        """SELECT batch_id, src_row AS row_idx, 'TR_Code' AS "column", activity AS value, 'Extraction Failed' AS issue
        FROM text_years WHERE tr_code IS NULL QUALIFY row_number() OVER (PARTITION BY batch_id ORDER BY src_row) <= 5
        UNION ALL SELECT batch_id, src_row, 'Year', year_text, 'Not a whole number' FROM text_years WHERE year IS NULL
        QUALIFY row_number() OVER (PARTITION BY batch_id ORDER BY src_row) <= 5""",
        "text_years",
    ),
    "scorecard": _sql(
        "SELECT count(*) AS input_rows, count(tr_code) AS valid_rows, count(tr_code) / count(*) * 100.0 AS retention_pct FROM tx_all",
        "tx_all",
    ),
    "batch_totals": _sql("SELECT batch_id, n_rows, rows_before FROM batches_before", "batches_before"),
    "dry_run_batches": _sql(
        f"SELECT batch_id, n_all AS n_rows, n_rows AS n_valid FROM batches_before WHERE rows_before < {DRY_RUN_LIMIT}",
        "batches_before",
    ),
    "source_batches": f"SELECT o_orderkey // {CHUNK} AS batch_id, count(*) AS n_rows, min(o_orderkey) AS first_key, "
    "CAST(sum(o_orderkey) AS BIGINT) AS key_sum FROM orders GROUP BY 1",
    "ledger": _sql(
        "SELECT batch_id, tr_code, account_name, description, debit, credit, net_amount, year, month, staff_id, first_name, "
        "family_name, email FROM matched WHERE staff_id IS NOT NULL AND first_name IS NOT NULL AND family_name IS NOT NULL "
        "AND email IS NOT NULL",
        "matched",
    ),
    "spenders": _sql(
        f"SELECT staff_id, first_name, family_name, email, count(net_amount) AS txn_count, {_money('debit')} AS total_debit, "
        f"{_money('credit')} AS total_credit, {_money('net_amount')} AS total_net_spend FROM matched "
        "GROUP BY staff_id, first_name, family_name, email",
        "matched",
    ),
    "monthly_trends": _sql(
        f"SELECT year, month, count(*) AS txn_count, {_money('net_amount')} AS total_net_spend FROM tx GROUP BY year, month", "tx"
    ),
    "account_summary": _sql(
        f"SELECT account_name, {_money('net_amount')} AS total_net_spend, count(*) AS txn_count FROM tx GROUP BY account_name",
        "tx",
    ),
    "active_staff": _sql("SELECT DISTINCT staff_id FROM matched", "matched"),
    "staff_statement_one": _sql(
        "SELECT tr_code, account_name, debit, credit, net_amount, year, month, description, batch_id, first_name, family_name, "
        "email, staff_id FROM matched WHERE staff_id = '9021'",
        "matched",
    ),
    "staff_totals": _sql(
        f"SELECT staff_id, first_name, {_FAMILY} AS family_name, email, txn_count, total_debit, total_credit, total_net_spend "
        "FROM staff_totals",
        "staff_totals",
    ),
    "sorted_spenders": _sql(
        "SELECT row_number() OVER (ORDER BY total_net_spend DESC NULLS LAST, staff_id NULLS FIRST, first_name NULLS FIRST, family_name NULLS FIRST, "
        f"email NULLS FIRST) AS place, staff_id, first_name, family_name, email FROM (SELECT staff_id, first_name, family_name, email, "
        f"{_money('net_amount')} AS total_net_spend FROM matched GROUP BY staff_id, first_name, family_name, email)",
        "matched",
    ),
    "sorted_trends": _sql(
        "SELECT row_number() OVER (ORDER BY year DESC NULLS LAST, month DESC NULLS LAST) AS place, CAST(year AS VARCHAR) AS year, month "
        "FROM (SELECT DISTINCT year, month FROM tx)",
        "tx",
    ),
    "sorted_accounts": _sql(
        "SELECT row_number() OVER (ORDER BY total_net_spend DESC NULLS LAST, account_name NULLS FIRST) AS place, account_name "
        f"FROM (SELECT account_name, {_money('net_amount')} AS total_net_spend FROM tx GROUP BY account_name)",
        "tx",
    ),
    "sorted_report": _sql(
        "SELECT row_number() OVER (ORDER BY school, subject_no, subject) AS place, school, subject_no, subject "
        "FROM (SELECT DISTINCT school, subject_no, subject FROM subject_year)",
        "subject_year",
    ),
    "sorted_bands": _sql(
        "SELECT row_number() OVER (ORDER BY school, year) AS place, school, CAST(year AS VARCHAR) AS year FROM bands", "bands"
    ),
    "sorted_statements": _sql(
        "SELECT row_number() OVER (ORDER BY staff_id, is_total, batch_id NULLS FIRST, src_row NULLS FIRST) AS place, staff_id, is_total, src_row "
        "FROM (SELECT staff_id, false AS is_total, batch_id, src_row FROM matched WHERE staff_id IS NOT NULL "
        "UNION ALL SELECT staff_id, true, NULL, NULL FROM staff_totals)",
        "staff_totals",
    ),
    "indexed_statement": _sql(
        "SELECT tr_code, account_name, debit, credit, net_amount, year, month, description, batch_id, first_name, family_name, "
        "email, staff_id, false AS is_total FROM matched WHERE staff_id = '9021' UNION ALL "
        "SELECT NULL, NULL, total_debit, total_credit, total_net_spend, NULL, NULL, 'TOTAL', NULL, NULL, NULL, NULL, staff_id, true "
        "FROM staff_totals WHERE staff_id = '9021'",
        "staff_totals",
    ),
    "statements": _sql(
        "SELECT tr_code, account_name, debit, credit, net_amount, year, month, description, batch_id, first_name, family_name, "
        "email, staff_id, false AS is_total FROM matched WHERE staff_id IS NOT NULL UNION ALL "
        "SELECT NULL, NULL, total_debit, total_credit, total_net_spend, NULL, NULL, 'TOTAL', NULL, NULL, NULL, NULL, staff_id, true "
        "FROM staff_totals",
        "staff_totals",
    ),
    "messages": _sql(
        f"SELECT staff_id, concat('{Letter().title} - ', {_SAFE}) AS subject, '{Letter().sender}' AS sender, "
        f"coalesce(email, 'None') AS recipient, '' AS cc, {_message_body()} AS body, "
        f"concat('{Letter().title}_', {_SAFE}, '_', staff_id) AS attachment_name FROM staff_totals",
        "staff_totals",
    ),
    "pii_dictionary": _sql("SELECT key, key_lower, alias, is_id FROM staff_dictionary", "staff_dictionary"),
    "pii_dictionary_people": _sql("SELECT key, key_lower, alias, is_id FROM people_dictionary", "people_dictionary"),
    "redacted_documents": _sql(
        "SELECT doc_id, coalesce(shown, text) AS text FROM documents LEFT JOIN "
        f"({_redacted('documents', 'doc_id', 'text', 'word_dictionary')}) USING (doc_id)",
        "word_dictionary",
    ),
    "redacted_by_join": _sql(
        "SELECT doc_id, coalesce(shown, text) AS text FROM documents LEFT JOIN "
        f"({_redacted('documents', 'doc_id', 'text', 'word_dictionary')}) USING (doc_id)",
        "word_dictionary",
    ),
    "redacted_phrases": _sql(
        """SELECT doc_id, coalesce(string_agg(shown, '' ORDER BY i), any_value(text)) AS text FROM (
        SELECT d.doc_id, d.text, r.i, CASE WHEN s.alias IS NOT NULL THEN s.alias
        WHEN c1.alias IS NOT NULL OR c2.alias IS NOT NULL THEN '' ELSE r.run END AS shown
        FROM documents AS d LEFT JOIN text_runs AS r ON r.doc_id = d.doc_id
        LEFT JOIN phrases_taken AS s ON s.doc_id = r.doc_id AND s.i = r.i
        LEFT JOIN phrases_taken AS c1 ON c1.doc_id = r.doc_id AND c1.i = r.i - 1
        LEFT JOIN phrases_taken AS c2 ON c2.doc_id = r.doc_id AND c2.i = r.i - 2) GROUP BY doc_id""",
        "phrases_taken",
    ),
    "redacted_reference": _sql(
        "SELECT "
        + ", ".join(f"coalesce({c}_shown.shown, {c}) AS {c}" for c in REFERENCE.names)
        + " FROM (SELECT *, tr_code AS code FROM reference_raw)"
        + "".join(
            f" LEFT JOIN ({_redacted('(SELECT *, tr_code AS code FROM reference_raw)', 'code', c, 'staff_dictionary')}) AS {c}_shown USING (code)"
            for c in REFERENCE.names
        ),
        "staff_dictionary",
    ),
    "code_violations": _sql("SELECT * FROM code_rows", "code_rows"),
    "order_violations": _sql("SELECT * FROM order_violations", "order_violations"),
    "month_order_violations": _sql("SELECT * FROM month_order_violations", "month_order_violations"),
    "total_violations": _sql("SELECT * FROM total_violations", "total_violations"),
    "missing_tables": _sql("SELECT * FROM missing_tables", "missing_tables"),
    "first_messages": _sql(
        "SELECT * FROM all_violations QUALIFY row_number() OVER "
        "(PARTITION BY file_key ORDER BY rule <> 'missing table', row_num ASC NULLS LAST, "
        "list_position(['tr_code', 'missing value', 'invalid number', 'not whole', 'not sorted', 'several totals', 'no total', "
        "'total differs'], rule) NULLS FIRST, message) <= 5",
        "all_violations",
    ),
    "error_counts": _sql("SELECT * FROM error_counts", "error_counts"),
    "verdict": _sql(
        "SELECT CASE WHEN count(*) = 0 THEN 'PASS' ELSE 'FAIL' END AS verdict, CAST(coalesce(sum(n_errors), 0) AS BIGINT) AS n_errors, "
        "count(*) AS n_files FROM error_counts",
        "error_counts",
    ),
    "located_header": _sql("SELECT * FROM located", "located"),
    "positional_rows": _sql(
        "SELECT _c7 AS school, _c0 AS subject_no, _c2 AS subject, _c3 AS teaching_session, _c4 AS incl_oncosts, _c6 AS student_count "
        "FROM raw_sheet JOIN located ON raw_sheet.sheet_ord = located.sheet_ord AND row_idx > header_row",
        "raw_sheet",
        "located",
    ),
    "header_names": _sql("SELECT cell, name FROM all_names", "all_names"),
    "csv_roundtrip": _sql(
        "SELECT CAST(src_row AS VARCHAR) AS src_row, activity, debit, credit, net_amount, CAST(year AS VARCHAR) AS year, month, "
        "journal_line_desc FROM transactions_raw",
        "transactions_raw",
    ),
    "stream_ingest": _sql("SELECT * EXCLUDE (batch_id) FROM tx", "tx"),
    "file_digests": _sql("SELECT * FROM digests", "digests"),
    "quoted_records": _sql(
        "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, remark, amount, row_number() OVER (ORDER BY part, o_orderkey) - 1 AS src_row FROM remarks",
        "remarks",
    ),
    "dry_run_files": _sql(
        f"SELECT batch_id, n_all AS n_rows, n_rows AS n_valid FROM batches_before WHERE rows_before < {DRY_RUN_LIMIT}",
        "batches_before",
    ),
    "replaced_reference": _sql("SELECT * FROM reference", "reference"),
    "appended_transactions": _sql("SELECT * FROM tx", "tx"),
    "stored_codes": _sql("SELECT tr_code FROM reference WHERE CAST(tr_code AS BIGINT) % 2 = 0", "reference"),
    "loaded_reference": _sql("SELECT * FROM reference", "reference"),
}
