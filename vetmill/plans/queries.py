"""Queries over the driver's tables, each with the SQL that gives the same rows.

(spark, sf_dir) -> DataFrame; every query calls the library's operators on an input of `inputs`.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vetmill.functions.json_ids import ID_KEYS, json_ids, json_or_text
from vetmill.functions.text import fold_key, norm_text
from vetmill.operators import audit, importing, intervals, inventory, names, normalize, payloads, reminders, resolve, sync
from vetmill.plans import inputs as I
from vetmill.sources import cursors, feeds, partitioned, workbooks
from vetmill.sources.shared import folder, kept
from vetmill.streaming import commits, keyed
from vetmill.streaming import sync as stream

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def put(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = re.sub(r"\n\s*", " ", sql)
        return f

    return put


# ---- shared SQL ------------------------------------------------------------------------------

#: White space as the library strips it.
_WS = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
_N = r"trim(regexp_replace({}, '\s+', ' ', 'g'))"
ACC = f"""(SELECT feed_pos, id AS account_id, code AS pims_code, other AS pims_id, {_N.format('first')} AS first_name,
  coalesce({_N.format('middle')}, '') AS middle_name, {_N.format('last')} AS last_name,
  concat_ws(' ', {_N.format('first')}, {_N.format('middle')}, {_N.format('last')}) AS display_name, regexp_replace(phone, '[^0-9]', '', 'g') AS primary_phone,
  trim(mail) AS email, updated AS updated_at, deleted AS deleted_at, deleted IS NOT NULL AS is_deleted FROM {I.sql(I.ACCOUNTS)} a)"""
ACC_COLUMNS = "account_id, pims_code, pims_id, first_name, middle_name, last_name, display_name, primary_phone, email, updated_at, deleted_at, is_deleted"
APP = f"""(SELECT '' || id AS appointment_id, '' || type AS appointment_type_id, '' || patient AS patient_id, day AS starts_at, day AS updated_at,
  (canceled IS NOT NULL OR status = 'canceled') AS is_canceled, confirmed AS is_confirmed FROM {I.sql(I.APPOINTMENTS)} a)""".replace("'' || patient AS", "CASE WHEN patient <> 0 THEN '' || patient END AS")
REM = f"(SELECT pid, due, off, sent FROM {I.sql(I.REMINDERS)} r)"


def _json(fields: dict[str, tuple[str, str]]) -> str:
    """SQL for canonical JSON; kinds: s text, b boolean, j JSON already."""
    parts = []
    for i, n in enumerate(sorted(fields)):
        e, kind = fields[n]
        text = f"""'"' || {e} || '"'""" if kind == "s" else f"CAST({e} AS VARCHAR)" if kind == "b" else e
        parts.append(f"""'{"," if i else "{"}"{n}":' || coalesce({text}, 'null')""")
    return "(" + " || ".join(parts) + " || '}')"


ACC_FIELDS = {c: (c, "b" if c == "is_deleted" else "s") for c in ACC_COLUMNS.split(", ")}
APP_FIELDS = {c: (c, "b" if c.startswith("is_") else "s") for c in "appointment_id appointment_type_id patient_id starts_at updated_at is_canceled is_confirmed".split()}

# ---- feeds and normal forms ------------------------------------------------------------------


@query("accounts_normalized", f"SELECT {ACC_COLUMNS} FROM {ACC} a")
def accounts_normalized(spark: SparkSession, d: str) -> DataFrame:
    return normalize.normalize_accounts(I.accounts(spark, d))


_CONTACT = {"source_system": ("'practice'", "s"), "source_account_id": ("account_id", "s"), "clinic_id": ("'clinic-1'", "s"), "is_active": ("NOT is_deleted", "b"),
            **{c: (c, "s") for c in "pims_code pims_id display_name first_name middle_name last_name primary_phone email updated_at deleted_at".split()}}


@query("contacts_projected", f"""SELECT {", ".join(f'{e} AS {n}' for n, (e, _) in _CONTACT.items())}, sha256({_json(_CONTACT)}) AS payload_hash FROM {ACC} a""")
def contacts_projected(spark, d):
    return normalize.project_contacts(normalize.normalize_accounts(I.accounts(spark, d)), "clinic-1")


@query("appointments_normalized", f"SELECT * FROM {APP} a")
def appointments_normalized(spark, d):
    return normalize.normalize_appointments(I.appointments(spark, d))


_TYPES = f"(SELECT DISTINCT id AS tid, name AS tname FROM {I.sql(I.TYPES)} t)"
_TYPE = """CASE WHEN tid IS NULL THEN NULL ELSE '{"id":' || tid || ',"name":"' || tname || '"}' END"""


@query("appointments_with_type", f"""SELECT appointment_id, tid AS type_id, tname AS type_name, sha256(CASE WHEN appointment_type_id IS NULL THEN {_json(APP_FIELDS)} ELSE {_json({**APP_FIELDS, "appointment_type": (_TYPE, "j")})} END) AS source_hash,
  CASE WHEN is_canceled THEN 'needs_review' ELSE 'clear' END AS conflict_status FROM {APP} a LEFT JOIN {_TYPES} t ON CAST(a.appointment_type_id AS BIGINT) = t.tid""")
def appointments_with_type(spark, d):
    rows = normalize.enrich_types(normalize.normalize_appointments(I.appointments(spark, d)), I.types(spark, d))
    return sync.with_hashes(rows, "appointments").select(
        "appointment_id", F.col("appointment_type.id").alias("type_id"), F.col("appointment_type.name").alias("type_name"), "source_hash", "conflict_status")


@query("appointment_changes", f"""SELECT id, coalesce(new_status, status) AS status, coalesce(new_at, canceled) AS "canceledAt", coalesce(new_confirmed, confirmed) AS "isConfirmed"
  FROM {I.sql(I.APPOINTMENTS)} a LEFT JOIN (SELECT event_id + 1 AS cid, CASE WHEN event_id % 3 = 0 THEN 'canceled' END AS new_status, CASE WHEN event_id % 3 = 0 THEN '2024-06-02' END AS new_at,
  CASE WHEN event_id % 3 = 1 THEN false END AS new_confirmed FROM events WHERE event_id % 4 = 0) c ON a.id = c.cid""")
def appointment_changes(spark, d):
    e = spark.read.parquet(f"{d}/events.parquet").where("event_id % 4 = 0")
    change = "event_id + 1 AS id", "CASE WHEN event_id % 3 = 0 THEN 'canceled' END AS status", "CASE WHEN event_id % 3 = 1 THEN false END AS isConfirmed"
    new = e.selectExpr(*change, "'b' AS changed_at", "CASE WHEN event_id % 3 = 0 THEN '2024-06-02' END AS canceledAt")
    old = e.selectExpr(*change, "'a' AS changed_at", "'2024-06-01' AS canceledAt")
    rows, _ = normalize.apply_appointment_changes(I.appointments(spark, d), new.unionByName(old))
    return rows.select("id", "status", "canceledAt", "isConfirmed")


@query("appointment_changes_unknown", "SELECT event_id + 1000000000 AS id FROM events WHERE event_id % 4 = 1")
def appointment_changes_unknown(spark, d):
    e = spark.read.parquet(f"{d}/events.parquet").where("event_id % 4 < 2")
    changes = e.selectExpr("CASE WHEN event_id % 4 = 0 THEN event_id + 1 ELSE event_id + 1000000000 END AS id", "'a' AS changed_at", "'x' AS status", "true AS isConfirmed", "'2024' AS canceledAt")
    return normalize.apply_appointment_changes(I.appointments(spark, d), changes)[1].select("id")


@query("appointments_merged", f"""SELECT id, CASE WHEN (id - 1) % 35 = 0 THEN '2031-01-01' ELSE day END AS "startsAt", CASE WHEN (id - 1) % 5 = 0 THEN 'canceled' ELSE status END AS status,
  CASE WHEN (id - 1) % 5 = 0 THEN '2024-06-02' ELSE canceled END AS "canceledAt", confirmed AS "isConfirmed" FROM {I.sql(I.APPOINTMENTS)} a
  UNION ALL SELECT event_id + 1000000000, '2031-01-01', 'canceled', '2024-06-02', NULL FROM events WHERE event_id % 70 = 0""")
def appointments_merged(spark, d):
    """Appointments by day, one fifth of them changed, some moved to another day, some new; the merge is asked for twice."""
    path, rows = folder(spark, "appointments"), I.appointments(spark, d).select("id", "startsAt", "status", "canceledAt", "isConfirmed")
    partitioned.write(rows, path, "startsAt")
    e = spark.read.parquet(f"{d}/events.parquet").where("event_id % 5 = 0")
    moved = F.expr("CASE WHEN event_id % 35 = 0 THEN '2031-01-01' END").alias("startsAt")
    change = lambda e, at: e.selectExpr("event_id + 1 AS id", "event_id", "'canceled' AS status").select("id", "status", moved, F.lit(f"2024-06-0{at}").alias("canceledAt"), F.lit(at).alias("changed_at"))
    new = change(e.where("event_id % 70 = 0"), 2).withColumn("id", F.col("id") - 1 + 1000000000)
    for _ in range(2):
        partitioned.merge(change(e, 1).unionByName(change(e, 2)).unionByName(new), path, rows.schema, "id", "startsAt", "fifth", insert=True)
    return partitioned.read(spark, path, rows.schema).select(*rows.columns)


@query("appointment_time_filter", f"SELECT id, day FROM {I.sql(I.APPOINTMENTS)} a WHERE day >= '2024-01-05' AND day < '2024-01-20'")
def appointment_time_filter(spark, d):
    return feeds.filter_time_range(I.appointments(spark, d), "startsAt", "2024-01-05", "2024-01-20").select("id", F.col("startsAt").alias("day"))


@query("appointment_page_after", f"SELECT id, day FROM {I.sql(I.APPOINTMENTS)} a WHERE id > 500 ORDER BY id LIMIT 100")
def appointment_page_after(spark, d):
    return feeds.page_after(I.appointments(spark, d), "id", 500).select("id", F.col("startsAt").alias("day"))


@query("appointment_page_before", f"SELECT id, day FROM {I.sql(I.APPOINTMENTS)} a WHERE id < 500 ORDER BY id DESC LIMIT 40")
def appointment_page_before(spark, d):
    return feeds.page_before(I.appointments(spark, d), "id", 500, 40).select("id", F.col("startsAt").alias("day"))


@query("appointments_hydrated", f"SELECT id, CASE WHEN id % 3 = 0 THEN 'detail' ELSE status END AS status, CASE WHEN id % 3 = 0 THEN id * 2 END AS extra FROM {I.sql(I.APPOINTMENTS)} a")
def appointments_hydrated(spark, d):
    listed = I.appointments(spark, d).select("id", "status")
    detail = listed.where("id % 3 = 0").select("id", F.lit("detail").alias("status"), (F.col("id") * 2).alias("extra"))
    return feeds.hydrate(listed, detail)


@query("accounts_looked_up", f"SELECT id FROM {I.sql(I.ACCOUNTS)} a WHERE feed_pos IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')")
def accounts_looked_up(spark, d):
    keys = spark.read.parquet(f"{d}/orders.parquet").where("o_orderstatus = 'P'").selectExpr("'acct-' || o_custkey AS id")
    return feeds.lookup(I.accounts(spark, d), keys).select("id")


@query("records_looked_up", f"""WITH k AS (SELECT '' || o_custkey AS c, 'P' || o_custkey AS o, 'building FAMILY' || (o_custkey % 211) AS n, 'acct-' || o_custkey AS a FROM orders WHERE o_orderstatus = 'P')
  SELECT 'pimsCode' AS kind, id FROM {I.sql(I.ACCOUNTS)} x WHERE code IN (SELECT c FROM k) UNION ALL SELECT 'pimsId', id FROM {I.sql(I.ACCOUNTS)} x WHERE other IN (SELECT o FROM k)
  UNION ALL SELECT 'name', account_id FROM {ACC} x WHERE lower(display_name) IN (SELECT lower(n) FROM k)
  UNION ALL SELECT 'patient pimsCode', id FROM {I.sql(I.PATIENTS)} x WHERE code IN (SELECT 'PT' || c FROM k) UNION ALL SELECT 'accountId', id FROM {I.sql(I.PATIENTS)} x WHERE account IN (SELECT a FROM k)""")
def records_looked_up(spark, d):
    """Accounts by code, further code and name, patients by code and account."""
    keys = spark.read.parquet(f"{d}/orders.parquet").where("o_orderstatus = 'P'").selectExpr(
        """explode(map('pimsCode', '' || o_custkey, 'pimsId', ' P' || o_custkey, 'name', 'building  FAMILY' || (o_custkey % 211), 'patient pimsCode', 'PT' || o_custkey, 'accountId', 'acct-' || o_custkey)) AS (kind, value)""")
    accounts = _accounts(spark, d).withColumnRenamed("account_id", "id")
    found = feeds.lookup_by(accounts, keys, {"pimsCode": "pims_code", "pimsId": "pims_id", "name": "display_name"}, folded=("name",)).select("kind", "id")
    return found.unionByName(feeds.lookup_by(I.patients(spark, d), keys, {"patient pimsCode": "pimsCode", "accountId": "accountId"}).select("kind", "id"))


@query("pages_flattened", "SELECT conv_id AS page_no, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) - 1 AS INTEGER) AS pos, turn, role FROM conversations")
def pages_flattened(spark, d):
    turns = spark.read.parquet(f"{d}/conversations.parquet").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("list"))
    empty = F.lit(None).cast("array<struct<turn:bigint,role:string,text:string>>")
    pages = turns.select(F.col("conv_id").alias("page_no"), F.when(F.col("conv_id") % 2 == 0, F.col("list")).otherwise(empty).alias("appointments"), F.col("list").alias("data"))
    return feeds.flatten_pages(pages, "appointments").drop("text")


@query("text_normalized", rf"""SELECT doc_id, trim(regexp_replace(text, '[\s\x0b\x1c-\x1f\x{{85}}\x{{a0}}\x{{1680}}\x{{2000}}-\x{{200a}}\x{{2028}}\x{{2029}}\x{{202f}}\x{{205f}}\x{{3000}}]+', ' ', 'g')) AS plain FROM documents""")
def text_normalized(spark, d):
    return spark.read.parquet(f"{d}/documents.parquet").select("doc_id", norm_text("text").alias("plain"))


# ---- reminder sheets -------------------------------------------------------------------------

_TXT = {c: f"coalesce({_N.format(c)}, '')" for c in [*reminders.IDENTITY, *reminders.DUE]}
_MARK = f"""(SELECT file, sheet, row_number AS rn, {", ".join(f"{e} AS {c}" for c, e in _TXT.items())}, due_date AS raw_due,
  {" || ".join(_TXT[c] for c in reminders.IDENTITY)} <> '' AS has_id, {" || ".join(_TXT[c] for c in reminders.DUE)} <> '' AS has_due FROM {I.sql(I.SHEET)} s)"""
_OPEN = f"""(SELECT *, max(CASE WHEN has_id THEN rn END) OVER w AS head, max(CASE WHEN NOT has_id AND NOT has_due THEN rn END) OVER w AS gap FROM {_MARK} m
  WINDOW w AS (PARTITION BY file, sheet ORDER BY rn))"""
_GOOD = f"""(SELECT o.file, o.sheet, o.rn AS row_number, o.head AS header_row, h.client, h.client_name, h.phone_no, h.patient_name, h.species, h.breed, o.code, o.item_due, o.raw_due
  FROM {_OPEN} o JOIN {_MARK} h ON o.file = h.file AND o.sheet = h.sheet AND o.head = h.rn WHERE (o.has_id AND o.has_due) OR (NOT o.has_id AND o.has_due AND o.head > coalesce(o.gap, -1)))"""


def _sheet(spark, d):
    return reminders.group_sheet_rows(I.rows(spark, d, I.SHEET))


@query("sheet_groups", f"SELECT file, sheet, row_number, header_row, client, client_name, phone_no, patient_name, species, breed, code, item_due FROM {_GOOD} g")
def sheet_groups(spark, d):
    return _sheet(spark, d)[0].drop("due_date")


@query("sheet_errors", f"""SELECT file, sheet, rn AS row_number, CASE WHEN has_id THEN 'header_without_reminder' ELSE 'continuation_without_header' END AS reason FROM {_OPEN} o
  WHERE (has_id AND NOT has_due) OR (NOT has_id AND has_due AND (head IS NULL OR head < coalesce(gap, -1)))""")
def sheet_errors(spark, d):
    return _sheet(spark, d)[1]


def _due_sql(raw: str) -> str:
    t = _N.format(raw)
    year = rf"regexp_extract({t}, '([0-9]+)$', 1)"
    full = f"CASE WHEN length({year}) = 4 THEN {year} WHEN {year} >= '69' THEN '19' || {year} ELSE '20' || {year} END"
    month, day = rf"lpad(regexp_extract({t}, '^([0-9]+)', 1), 2, '0')", rf"lpad(regexp_extract({t}, '^[0-9]+[/-]([0-9]+)', 1), 2, '0')"
    form = rf"regexp_matches({t}, '^[0-9]{{1,2}}(/[0-9]{{1,2}}/|-[0-9]{{1,2}}-)([0-9]{{4}}|[0-9]{{2}})$')"
    return f"CASE WHEN {form} THEN TRY_CAST({full} || '-' || {month} || '-' || {day} AS DATE) END"


def _repr_sql(text: str) -> str:
    slashes = f"replace({text}, chr(92), chr(92) || chr(92))"
    return f"""CASE WHEN contains({text}, chr(39)) AND NOT contains({text}, chr(34)) THEN chr(34) || {slashes} || chr(34)
      ELSE chr(39) || replace({slashes}, chr(39), chr(92) || chr(39)) || chr(39) END"""


def _error_sql(raw: str, due: str) -> str:
    return f"CASE WHEN {due} IS NOT NULL THEN NULL WHEN {raw} IS NULL OR {raw} = '' THEN 'Missing due date' ELSE 'Unsupported due date format: ' || {_repr_sql(_N.format(raw))} END"


@query("due_date_parse", f"SELECT id, CAST(due AS VARCHAR) AS due, {_error_sql('raw', 'due')} AS error FROM (SELECT id, raw, {_due_sql('raw')} AS due FROM {I.sql(I.DATES)} d) x")
def due_date_parse(spark, d):
    return I.rows(spark, d, I.DATES).select("id", reminders.parse_due_date("raw").cast("string").alias("due"), reminders.due_date_error("raw").alias("error"))


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_EXCLUDED = ", ".join(map(_quoted, reminders.EXCLUDED))
_EXACT = ", ".join(f"({_quoted(k)}, {_quoted(v)})" for k, v in reminders.EXACT.items())
_RULES = " ".join(rf"WHEN regexp_matches({{0}}, '(?i)^\Q{s}\E\b') THEN {_quoted(t)}" for s, t in reminders.BEGINNINGS)


def _map_sql(label: str, exact: str) -> str:
    return f"CASE WHEN {label} IN ({_EXCLUDED}) THEN NULL WHEN {exact} IS NOT NULL THEN {exact} {_RULES.format(label)} END"


@query("label_mapping", f"SELECT id, label, {_map_sql('label', 'v')} AS mapped FROM {I.sql(I.LABELS)} l LEFT JOIN (VALUES {_EXACT}) e(k, v) ON l.label = e.k")
def label_mapping(spark, d):
    return I.rows(spark, d, I.LABELS).select("id", "label", reminders.map_label(F.col("label")).alias("mapped"))


_CLASS = f"""(SELECT *, CASE WHEN item_due = '' THEN 'missing_source_label' WHEN error IS NOT NULL THEN 'bad_due_date: ' || error WHEN item_due IN ({_EXCLUDED}) THEN 'excluded_non_reminder_item'
  WHEN mapped IS NULL THEN 'no_mapping' END AS reason FROM (SELECT x.*, {_error_sql('raw_due', 'due')} AS error, {_map_sql('item_due', 'v')} AS mapped
  FROM (SELECT *, {_due_sql('raw_due')} AS due FROM {_GOOD} g) x LEFT JOIN (VALUES {_EXACT}) e(k, v) ON x.item_due = e.k) y)"""


@query("reminder_classification", f"""SELECT file, sheet, row_number, header_row, item_due, reason, CASE WHEN reason IS NULL THEN mapped END AS mapped_label,
  CASE WHEN reason IS NULL THEN CAST(due AS VARCHAR) END AS due FROM {_CLASS} c""")
def reminder_classification(spark, d):
    return reminders.classify_reminders(_sheet(spark, d)[0]).select("file", "sheet", "row_number", "header_row", "item_due", "reason", "mapped_label", "due")


@query("reminder_reasons", f"SELECT coalesce(split_part(reason, ':', 1), 'valid') AS reason, count(*) AS n FROM {_CLASS} c GROUP BY 1")
def reminder_reasons(spark, d):
    return reminders.reason_counts(reminders.classify_reminders(_sheet(spark, d)[0]))


_PLANS = f"""(SELECT file, sheet, header_row, client, client_name, phone_no, patient_name, count(*) FILTER (WHERE reason IS NULL) AS n_valid,
  coalesce(string_agg(CASE WHEN reason IS NULL THEN row_number || '=' || mapped || '@' || CAST(due AS VARCHAR) END, ';' ORDER BY row_number), '') AS valid,
  coalesce(string_agg(CASE WHEN reason IS NOT NULL THEN row_number || '=' || reason END, ';' ORDER BY row_number), '') AS skipped FROM {_CLASS} c GROUP BY ALL)"""


def _plans(spark, d):
    plans = reminders.build_plans(reminders.classify_reminders(_sheet(spark, d)[0]))
    text = lambda c, f: F.array_join(F.transform(c, f), ";")
    return plans.select(
        "file", "sheet", "header_row", "client", "client_name", "phone_no", "patient_name", F.size("valid_reminders").cast("bigint").alias("n_valid"),
        text("valid_reminders", lambda x: F.concat(x["row_number"].cast("string"), F.lit("="), x["mapped_label"], F.lit("@"), x["due_date"])).alias("valid"),
        text("skipped_rows", lambda x: F.concat(x["row_number"].cast("string"), F.lit("="), x["reason"])).alias("skipped"))


@query("import_plans", f"SELECT * FROM {_PLANS} p")
def import_plans(spark, d):
    return _plans(spark, d)


@query("first_plans", f"SELECT file, sheet, header_row, n_valid FROM {_PLANS} p ORDER BY file, sheet, header_row LIMIT 50")
def first_plans(spark, d):
    return reminders.first_plans(_plans(spark, d), 50).select("file", "sheet", "header_row", "n_valid")


@query("plan_json", f"""SELECT file, sheet, header_row, CAST(to_json({{'patient': {{'client': client, 'client_name': client_name, 'phone_no': phone_no, 'patient_name': patient_name, 'species': species, 'breed': breed, 'header_row_number': header_row}},
  'valid_reminders': coalesce(list({{'source_code': code, 'source_label': item_due, 'mapped_label': mapped, 'due_date': CAST(due AS VARCHAR), 'row_number': row_number}} ORDER BY row_number) FILTER (WHERE reason IS NULL), []),
  'skipped_rows': coalesce(list({{'source_code': code, 'source_label': item_due, 'reason': reason, 'row_number': row_number}} ORDER BY row_number) FILTER (WHERE reason IS NOT NULL), [])}}) AS VARCHAR) AS plan
  FROM {_CLASS} c GROUP BY file, sheet, header_row, client, client_name, phone_no, patient_name, species, breed""")
def plan_json(spark, d):
    return reminders.plan_json(reminders.build_plans(reminders.classify_reminders(_sheet(spark, d)[0])))


@query("plan_json_zero", SQL["plan_json"])
def plan_json_zero(spark, d):
    """The export with a limit of 0, which stands for all plans."""
    plans = reminders.build_plans(reminders.classify_reminders(_sheet(spark, d)[0]))
    return reminders.plan_json(reminders.first_plans(plans, 0, zero_is_all=True))


@query("dry_run_none", f"""SELECT file, sheet, header_row, 'valid: none' AS line FROM {_CLASS} c GROUP BY file, sheet, header_row HAVING count(*) FILTER (WHERE reason IS NULL) = 0
  UNION ALL SELECT file, sheet, header_row, 'skipped: none' FROM {_CLASS} c GROUP BY file, sheet, header_row HAVING count(reason) = 0""")
def dry_run_none(spark, d):
    return reminders.empty_halves(reminders.build_plans(reminders.classify_reminders(_sheet(spark, d)[0])))


@query("dry_run_lines", f"""SELECT file, sheet, header_row, row_number, CASE WHEN reason IS NULL THEN patient_name || ' (' || client || ') row ' || row_number || ': ' || item_due || ' -> ' || mapped || ' due ' || CAST(due AS VARCHAR)
  ELSE patient_name || ' (' || client || ') row ' || row_number || ': skipped ' || item_due || ': ' || reason END AS line FROM {_CLASS} c""")
def dry_run_lines(spark, d):
    return reminders.dry_run_lines(reminders.classify_reminders(_sheet(spark, d)[0]))


# ---- resolution ------------------------------------------------------------------------------

_SRC = I.sql(I.SOURCES)
_CODE = f"""(SELECT src_id, account_id, min(priority) AS priority, any_value(feed_pos) AS feed_pos FROM (
  SELECT src_id, account_id, 0 AS priority, feed_pos FROM {_SRC} s JOIN {ACC} a ON s.client = a.pims_code WHERE s.client <> ''
  UNION ALL SELECT src_id, account_id, 1, feed_pos FROM {_SRC} s JOIN {ACC} a ON s.client = a.pims_id WHERE s.client <> '') u GROUP BY src_id, account_id)"""


def _words(name: str) -> str:
    return f"array_to_string(list_sort(list_filter(string_split(replace(lower({_N.format(name)}), ',', ' '), ' '), lambda w: w <> '')), ' ')"


_CAND = f"""(SELECT src_id, account_id, feed_pos, lower({_N.format('client_name')}) = lower(display_name) AS exact,
  regexp_replace(phone_no, '[^0-9]', '', 'g') <> '' AND regexp_replace(phone_no, '[^0-9]', '', 'g') = primary_phone AS phone_eq,
  regexp_replace(phone_no, '[^0-9]', '', 'g') = '' OR primary_phone = '' OR regexp_replace(phone_no, '[^0-9]', '', 'g') = primary_phone AS phone_ok
  FROM (SELECT *, {_words('client_name')} AS key FROM {_SRC} s WHERE client_name <> '') s JOIN (SELECT *, {_words('display_name')} AS key FROM {ACC} a) a USING (key))"""
_OWNER = f"(SELECT * FROM (SELECT *, rank() OVER (PARTITION BY src_id ORDER BY exact DESC, phone_eq DESC) AS r FROM {_CAND} c) x WHERE r = 1)"
_REST = f"SELECT src_id FROM {_CODE} c"
_STRICT = f"""(SELECT s.*, CASE WHEN n = 1 THEN o.account_id END AS account_id, CASE WHEN n IS NULL THEN 'not_found' WHEN n > 1 THEN 'ambiguous' ELSE 'resolved' END AS account_status
  FROM {_SRC} s LEFT JOIN (SELECT src_id, count(*) AS n, min(account_id) AS account_id FROM (SELECT src_id, account_id FROM {_CODE} c UNION ALL SELECT src_id, account_id FROM {_OWNER} o WHERE src_id NOT IN ({_REST})) b
  GROUP BY src_id) o USING (src_id))"""
_LENIENT = f"""(SELECT s.*, o.account_id, CASE WHEN o.account_id IS NULL THEN 'not_found' ELSE 'resolved' END AS account_status FROM {_SRC} s LEFT JOIN (
  SELECT src_id, arg_min(account_id, priority * 1e12 + feed_pos) AS account_id FROM {_CODE} c GROUP BY src_id
  UNION ALL SELECT src_id, arg_min(account_id, CASE WHEN exact AND phone_ok THEN 0 ELSE 1e12 END + feed_pos) FROM {_CAND} c WHERE src_id NOT IN ({_REST}) GROUP BY src_id) o USING (src_id))"""


def _patients_sql(resolved: str) -> str:
    return f"""(SELECT r.*, CASE WHEN account_id IS NULL THEN 'account_' || account_status WHEN n IS NULL THEN 'not_found' WHEN n > 1 THEN 'ambiguous' ELSE 'resolved' END AS patient_status, CASE WHEN n = 1 THEN pid END AS patient_id
      FROM {resolved} r LEFT JOIN (SELECT account, lower(name) AS k, count(*) AS n, min(id) AS pid FROM {I.sql(I.PATIENTS)} p GROUP BY ALL) p ON r.account_id = p.account AND lower(r.patient_name) = p.k)"""


def _accounts(spark, d):
    return normalize.normalize_accounts(I.accounts(spark, d), "feed_pos")


@query("resolve_account_by_code", f"SELECT src_id, account_id, priority FROM {_CODE} c")
def resolve_account_by_code(spark, d):
    return resolve.accounts_by_code(I.rows(spark, d, I.SOURCES), _accounts(spark, d)).select("src_id", "account_id", "priority")


@query("resolve_account_by_owner", f"SELECT src_id, account_id, exact, phone_eq FROM {_OWNER} o")
def resolve_account_by_owner(spark, d):
    return resolve.accounts_by_owner(I.rows(spark, d, I.SOURCES), _accounts(spark, d)).select("src_id", "account_id", "exact", "phone_eq")


def _set(name: str) -> str:
    return f"list_sort(list_distinct(list_filter(string_split(replace(replace(lower({_N.format(name)}), ',', ' '), '.', ' '), ' '), lambda w: w <> '')))"


@query("owners_by_part", f"""WITH s AS (SELECT src_id, lower({_N.format('client_name')}) AS name, {_set('client_name')} AS ws, regexp_replace(phone_no, '[^0-9]', '', 'g') AS phone FROM {I.sql(I.PARTIAL)} s WHERE trim(client_name) <> ''),
  h AS (SELECT lower(display_name) AS other, {_set('display_name')} AS os, primary_phone, account_id FROM {ACC} a),
  p AS (SELECT ws, os FROM (SELECT DISTINCT ws FROM s) s, (SELECT DISTINCT os FROM h) h WHERE ws = os OR (least(len(ws), len(os)) >= 2 AND (list_has_all(ws, os) OR list_has_all(os, ws)))),
  c AS (SELECT src_id, account_id, phone <> '' AND phone = primary_phone AS own, CASE WHEN name = other THEN 0 WHEN s.ws = h.os THEN 1 ELSE 2 END AS level FROM s JOIN p ON s.ws = p.ws JOIN h ON p.os = h.os),
  b AS (SELECT * FROM c QUALIFY rank() OVER (PARTITION BY src_id ORDER BY level, own DESC) = 1)
  SELECT src_id, ['exact', 'words', 'part'][any_value(level) + 1] AS level, count(*) AS n, CASE WHEN count(*) = 1 THEN min(account_id) END AS account_id FROM b GROUP BY src_id""")
def owners_by_part(spark, d):
    return names.owners_by_part(I.rows(spark, d, I.PARTIAL), _accounts(spark, d))


def _resolved(spark, d, mode):
    found = resolve.resolve_accounts(I.rows(spark, d, I.SOURCES), _accounts(spark, d), mode)
    return resolve.resolve_patients(found, I.patients(spark, d))


_OUT = "src_id, account_id, account_status, patient_id, patient_status"


@query("resolve_patient_strict", f"SELECT {_OUT} FROM {_patients_sql(_STRICT)} p")
def resolve_patient_strict(spark, d):
    return _resolved(spark, d, "strict").select(*_OUT.split(", "))


@query("resolve_patient_lenient", f"SELECT {_OUT} FROM {_patients_sql(_LENIENT)} p")
def resolve_patient_lenient(spark, d):
    return _resolved(spark, d, "lenient").select(*_OUT.split(", "))


@query("submission_table", f"""SELECT src_id, client, patient_name, n_valid, CASE WHEN n_valid = 0 THEN 'skipped_no_valid_reminders' WHEN patient_status = 'resolved' THEN 'submitted' ELSE 'unresolved_' || patient_status END AS status,
  CASE WHEN n_valid > 0 AND patient_status = 'resolved' THEN patient_id END AS patient_id FROM (SELECT *, src_id % 3 AS n_valid FROM {_patients_sql(_STRICT)} p) x""")
def submission_table(spark, d):
    plans = I.rows(spark, d, I.SOURCES).selectExpr("src_id", "client", "patient_name", "src_id % 3 AS n_valid")
    return resolve.submission_table(plans, _resolved(spark, d, "strict")).select("src_id", "client", "patient_name", "n_valid", "status", "patient_id")


# ---- audits and filters ----------------------------------------------------------------------

_STRIP = f"regexp_replace({{}}, '^{_WS.replace('{', '{{').replace('}', '}}')}|{_WS.replace('{', '{{').replace('}', '}}')}$', '', 'g')"
_OWNER_NAME = f"nullif(concat_ws(' ', nullif({_STRIP.format('first')}, ''), nullif({_STRIP.format('last')}, '')), '')"


def _audit_sql(count: str) -> str:
    return f"""SELECT {_OWNER_NAME} AS client_name, name AS patient_name, phone AS phone_no, {count} AS reminder_count, id AS patient_id, account AS account_id, code AS pims_code
      FROM {I.sql(I.PATIENTS)} p LEFT JOIN (SELECT pid, count(*) AS n FROM {REM} r WHERE pid IS NOT NULL GROUP BY pid) r ON p.id = r.pid"""


@query("patient_reminder_audit", _audit_sql("coalesce(n, 0)"))
def patient_reminder_audit(spark, d):
    return audit.patient_audit(I.patients(spark, d), I.reminders(spark, d))


@query("reminder_count_unknown", _audit_sql("CAST(NULL AS BIGINT)"))
def reminder_count_unknown(spark, d):
    return audit.patient_audit(I.patients(spark, d), I.reminders(spark, d, scoped=False))


@query("patient_audit_owner_apart", f"""SELECT CASE WHEN CAST(p.id AS BIGINT) % 3 = 0 THEN {_OWNER_NAME} ELSE who END AS client_name, name AS patient_name, CASE WHEN CAST(p.id AS BIGINT) % 3 = 0 THEN p.phone ELSE o.phone END AS phone_no,
  coalesce(n, 0) AS reminder_count, p.id AS patient_id, account AS account_id, code AS pims_code FROM {I.sql(I.PATIENTS)} p LEFT JOIN (SELECT pid, count(*) AS n FROM {REM} r WHERE pid IS NOT NULL GROUP BY pid) r ON p.id = r.pid
  LEFT JOIN (SELECT id AS owner, phone, concat_ws(' ', trim(first), trim(middle), trim(last)) AS who FROM {I.sql(I.ACCOUNTS)} a WHERE feed_pos % 10 > 0) o ON p.account = o.owner""")
def patient_audit_owner_apart(spark, d):
    """Two thirds of the patients are landed without their owner; accounts come in two versions, some not at all."""
    p, a = I.patients(spark, d), I.accounts(spark, d).where("feed_pos % 10 > 0")
    p = p.withColumn("account", F.when(F.col("id").cast("bigint") % 3 == 0, F.col("account")))
    old = a.withColumns({"updatedAt": F.lit("2001-01-01"), "primaryContact": F.col("primaryContact").withField("nameLast", F.lit("Before"))})
    return audit.patient_audit(normalize.with_owner(p, old.unionByName(a)), I.reminders(spark, d))


def _filtered(name, status, test, after, before):
    where = f"{test}" + (f" AND due >= '{after}'" if after else "") + (f" AND due <= '{before}'" if before else "")

    @query(f"reminder_filter_{name}", f"SELECT pid, due, off, sent FROM {REM} r WHERE {where}")
    def run(spark, d):
        rows = audit.filter_reminders(I.reminders(spark, d), None, status, after, before)
        return rows.select(F.coalesce("patientId", "patient_id", "patient.id").alias("pid"), F.col("dueAt").alias("due"), F.col("deactivatedAt").alias("off"), F.col("sentAt").alias("sent"))


_filtered("active_due", "active", "off IS NULL", "1997-01-01", "1998-12-31")
_filtered("inactive", "inactive", "off IS NOT NULL", None, "1996-06-30")
_filtered("sent", "sent", "sent IS NOT NULL", "2000-01-01", None)
_filtered("unsent", "unsent", "sent IS NULL", None, None)


@query("reminder_filter_bulk", f"""SELECT query_id, due, off, sent FROM {REM} r JOIN {I.sql(I.QUERIES)} q ON CAST(r.pid AS BIGINT) = q.patient_id
  AND CASE status WHEN 'active' THEN off IS NULL WHEN 'inactive' THEN off IS NOT NULL WHEN 'sent' THEN sent IS NOT NULL WHEN 'unsent' THEN sent IS NULL ELSE status IS NULL END
  AND (due_after IS NULL OR due >= due_after) AND (due_before IS NULL OR due <= due_before)""")
def reminder_filter_bulk(spark, d):
    rows = audit.filter_reminders_bulk(I.reminders(spark, d), I.rows(spark, d, I.QUERIES))
    return rows.select("query_id", F.col("dueAt").alias("due"), F.col("deactivatedAt").alias("off"), F.col("sentAt").alias("sent"))


@query("reminder_filter_binned", SQL["reminder_filter_bulk"].replace(I.sql(I.REMINDERS), I.sql(I.CROWDED)).replace(I.sql(I.QUERIES), I.sql(I.SHORT)))
def reminder_filter_binned(spark, d):
    """Seven patients have all reminders: bins of 500 rows."""
    rows = intervals.filter_reminders_binned(I.reminders(spark, d, source=I.CROWDED), I.rows(spark, d, I.SHORT), chunk=500)
    return rows.select("query_id", F.col("dueAt").alias("due"), F.col("deactivatedAt").alias("off"), F.col("sentAt").alias("sent"))


class _Blank(str):
    def format(self, name: str) -> str:
        return f"count(*) FILTER (WHERE {_STRIP.format(f'coalesce("{name}", {chr(39) * 2})')} = '')"


_BLANK = _Blank()
_DUP = f"(SELECT {_STRIP.format('"PMS_ID"')} AS value, count(*) AS n FROM {I.sql(I.LIST)} l WHERE {_STRIP.format('"PMS_ID"')} <> '' GROUP BY 1 HAVING count(*) > 1)"


@query("csv_audit", f"""SELECT count(*) AS total_rows, 'PMS_ID' AS selected_identifier_column, {_BLANK.format('PMS_ID')} AS missing_identifier_rows, (SELECT count(*) FROM {_DUP} d) AS duplicate_identifier_values,
  least({_BLANK.format('Owner')}, {_BLANK.format('EMail ')}, {_BLANK.format('Client  Phone')}) AS missing_owner, {_BLANK.format('Patient')} AS missing_patient_name, {_BLANK.format('species')} AS missing_species,
  count(*) AS missing_breed, {_BLANK.format('Gender')} AS missing_sex, false AS has_unique_identifier, false AS has_required_fields FROM {I.sql(I.LIST)} l""")
def csv_audit(spark, d):
    return audit.audit_patients(I.rows(spark, d, I.LIST))


@query("csv_duplicates", f"SELECT value, n FROM {_DUP} d")
def csv_duplicates(spark, d):
    return audit.duplicate_ids(I.rows(spark, d, I.LIST), "PMS_ID")


# ---- payloads and ids ------------------------------------------------------------------------


@query("patient_payloads", f"""SELECT key, '{{"accountId":"' || "accountId" || '","breedId":' || "breedId" || ',"name":"' || name || '","speciesId":"canine","alertIds":[' || CASE a WHEN 0 THEN '101' ELSE '999,' || a || ',101' END
  || '],"reminderIds":[' || (b + 200) || CASE b + 200 WHEN 201 THEN ',202' WHEN 202 THEN ',201' ELSE ',201,202' END || ']' || coalesce(',"color":"' || color || '"', '') || coalesce(',"pimsCode":"' || "pimsCode" || '"', '') || '}}' AS payload
  FROM {I.sql(I.PAYLOADS)} p WHERE "accountId" IS NOT NULL AND "speciesId" IS NOT NULL""")
def patient_payloads(spark, d):
    return payloads.build_patient_payloads(I.payload_rows(spark, d), 101, [201, 202])[0].select("key", "payload")


@query("patient_payload_rejects", f"""SELECT key, CASE WHEN "accountId" IS NULL THEN 'accountId' ELSE 'speciesId' END AS reason FROM {I.sql(I.PAYLOADS)} p WHERE "accountId" IS NULL OR "speciesId" IS NULL""")
def patient_payload_rejects(spark, d):
    return payloads.build_patient_payloads(I.payload_rows(spark, d), 101, [201, 202])[1].select("key", "reason")


_IDS = f"""(SELECT feed_pos, CASE kind WHEN 0 THEN list_distinct_in_order([77, a, b]) WHEN 1 THEN list_distinct_in_order([a, b]) ELSE [] END AS ids FROM {I.sql(I.BLOBS)} b)"""
_IDS = _IDS.replace("list_distinct_in_order([77, a, b])", "list_filter([77, a, b], lambda x, i: list_position([77, a, b], x) = i)").replace(
    "list_distinct_in_order([a, b])", "list_filter([a, b], lambda x, i: list_position([a, b], x) = i)")


@query("json_id_walk", f"SELECT feed_pos, array_to_string(ids, ',') AS ids FROM {_IDS} i")
def json_id_walk(spark, d):
    return I.blobs(spark, d).select("feed_pos", F.array_join(json_ids(F.col("raw"), ID_KEYS).cast("array<string>"), ",").alias("ids"))


_ALERTS = f"(SELECT feed_pos, CASE kind WHEN 0 THEN CASE WHEN a = b THEN [a] ELSE [a, b] END WHEN 1 THEN CASE WHEN a = b THEN [a] ELSE [a, b] END ELSE [] END AS ids FROM {I.sql(I.BLOBS)} b)"


# ---- sync ------------------------------------------------------------------------------------


def _export_sql(feed: str, key: str, fields: dict, frame: str, conflict: str, mark: str | None, where: str) -> str:
    basis = _json({"source_type": (_quoted(feed), "s"), "source_id": (key, "s"), "watermark_in": (_quoted(mark) if mark else "CAST(NULL AS VARCHAR)", "s")})
    return f"""SELECT 'practice' AS source_system, {key} AS source_id, '{feed[:-1]}' AS source_type, sha256({basis}) AS idempotency_key, {conflict} AS conflict_status, sha256({_json(fields)}) AS source_hash FROM {frame} f WHERE {where}"""


def _flat(records: DataFrame) -> DataFrame:
    return records.select("source_system", "source_id", "source_type", "idempotency_key", "conflict_status", F.col("payload.source_hash").alias("source_hash"))


@query("sync_export_accounts", _export_sql("accounts", "account_id", ACC_FIELDS, ACC, "'clear'", "2024-01-10T00:00:00Z", "updated_at >= '2024-01-10T00:00:00Z'"))
def sync_export_accounts(spark, d):
    rows = normalize.normalize_accounts(I.accounts(spark, d))
    return _flat(sync.sync_batch(rows, "accounts", {"accounts": "2024-01-10T00:00:00Z"})[0])


_NEEDS = "CASE WHEN is_canceled THEN 'needs_review' ELSE 'clear' END"


@query("sync_export_appointments", _export_sql("appointments", "appointment_id", APP_FIELDS, APP, _NEEDS, None, "true"))
def sync_export_appointments(spark, d):
    return _flat(sync.sync_batch(normalize.normalize_appointments(I.appointments(spark, d)), "appointments", {})[0])


@query("sync_first_records", f"SELECT account_id AS source_id FROM {ACC} a ORDER BY account_id LIMIT 20")
def sync_first_records(spark, d):
    rows = normalize.normalize_accounts(I.accounts(spark, d))
    return sync.sync_batch(rows, "accounts", {}, max_records=20)[0].select("source_id")


@query("sync_bundle_counts", f"SELECT 'account' AS source_type, count(*) AS record_count FROM {ACC} a UNION ALL SELECT 'appointment', count(*) FROM {APP} b")
def sync_bundle_counts(spark, d):
    a = sync.sync_batch(normalize.normalize_accounts(I.accounts(spark, d)), "accounts", {})[0]
    b = sync.sync_batch(normalize.normalize_appointments(I.appointments(spark, d)), "appointments", {})[0]
    return sync.feed_counts(_flat(a).unionByName(_flat(b)))


@query("sync_latest_per_id", """SELECT CAST(user_id AS VARCHAR) AS id, CAST(max(ts) AS VARCHAR) AS updated_at FROM events GROUP BY user_id""")
def sync_latest_per_id(spark, d):
    rows = spark.read.parquet(f"{d}/events.parquet").selectExpr("CAST(user_id AS STRING) AS id", "CAST(ts AS STRING) AS updated_at", "sha2(CAST(event_id AS STRING), 256) AS source_hash")
    return sync.latest_per_id(rows, "id").select("id", "updated_at")


_STREAM_SQL = _export_sql("appointments", "appointment_id", APP_FIELDS, APP, _NEEDS, None, "true")


def _landed_stream(spark, d) -> DataFrame:
    at = f"{d}/events.parquet"
    schema = spark.read.parquet(at).schema
    landed = spark.readStream.schema(schema).parquet(at if _is_dir(spark, at) else f"{d}/events*.parquet")
    table, columns = I.APPOINTMENTS
    return landed.selectExpr(*[f"{e} AS `{n}`" for n, e in columns.items()]).select(
        "id", F.col("type").cast("bigint").alias("appointmentTypeId"), F.col("patient").cast("bigint").alias("patientId"), F.col("day").alias("startsAt"), F.col("day").alias("updatedAt"),
        F.col("canceled").alias("canceledAt"), "status", F.col("confirmed").alias("isConfirmed"))


def _streamed(spark, d, times: int) -> DataFrame:
    base = folder(spark, "sync")
    for i in range(times):
        rows = _landed_stream(spark, d)
        stream.sync_stream(rows, normalize.normalize_appointments, "appointments", f"{base}/sink", f"{base}/state-{i}").awaitTermination()
    return _flat(spark.read.parquet(f"{base}/sink"))


@query("sync_stream", _STREAM_SQL)
def sync_stream(spark, d):
    """Events as a stream of landed files, exported once; the sink's rows are those of the batch."""
    return _streamed(spark, d, 1)


@query("sync_replay", _STREAM_SQL)
def sync_replay(spark, d):
    """The stream's state is lost and all events come again: the sink's keys let nothing in twice."""
    return _streamed(spark, d, 2)


_RECORD = "source_system string, source_id string, source_type string, idempotency_key string, conflict_status string, payload struct<source_hash:string>"


@query("sync_keyed", _STREAM_SQL)
def sync_keyed(spark, d):
    """Every event lands three times; the stream's own state lets each key through once."""
    base, rows = folder(spark, "keyed"), _landed_stream(spark, d).withColumn("again", F.explode(F.array(*map(F.lit, range(3))))).drop("again")
    keyed.sync_keyed(rows, normalize.normalize_appointments, "appointments", f"{base}/sink", f"{base}/state").awaitTermination()
    return _flat(commits.read(spark, f"{base}/sink", _RECORD))


@query("sync_committed", _export_sql("accounts", "account_id", ACC_FIELDS, ACC, "'clear'", None, "updated_at < '2024-01-15T00:00:00Z'") + " UNION ALL "
       + _export_sql("accounts", "account_id", ACC_FIELDS, ACC, "'clear'", "2024-01-14T00:00:00Z", "updated_at >= '2024-01-14T00:00:00Z'"))
def sync_committed(spark, d):
    """Two runs, of which the second starts from the watermark that the first committed and is asked for twice."""
    sink, rows = folder(spark, "committed"), normalize.normalize_accounts(I.accounts(spark, d))
    for name, some in (("one", rows.where("updated_at < '2024-01-15T00:00:00Z'")), ("two", rows), ("two", rows)):
        commits.sync_committed(some, "accounts", sink, name)
    return _flat(commits.read(spark, sink, _RECORD))


def _is_dir(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(at).isDirectory()


# ---- inventory -------------------------------------------------------------------------------

_STOCK = f"""(SELECT name, details, frequency, status, CAST(regexp_extract(avg_use, '^([0-9.]+)', 1) AS DECIMAL(12,2)) AS use_value, 'month' AS use_unit, CAST(split_part(orders_count, ' ', 1) AS INTEGER) AS orders,
  CAST(left(date_range, 10) AS DATE) AS first_order, CAST(right(date_range, 10) AS DATE) AS last_order, CAST(regexp_replace(total_cost, '[$,]', '', 'g') AS DECIMAL(12,2)) AS cost,
  CAST(split_part(amount, ' ', 2) AS DECIMAL(12,2)) AS quantity, split_part(amount, ' ', 3) AS quantity_unit FROM {I.sql(I.STOCK)} s)"""


@query("inventory_typed", f"SELECT name, details, frequency, status, CAST(use_value AS VARCHAR) AS use_value, use_unit, orders, CAST(first_order AS VARCHAR) AS first_order, CAST(last_order AS VARCHAR) AS last_order, CAST(cost AS VARCHAR) AS cost, CAST(quantity AS VARCHAR) AS quantity, quantity_unit FROM {_STOCK} s")
def inventory_typed(spark, d):
    rows = inventory.parse_inventory(I.rows(spark, d, I.STOCK))
    return rows.select(*[F.col(c).cast("string").alias(c) if c in ("use_value", "first_order", "last_order", "cost", "quantity") else c for c in rows.columns])


@query("inventory_rollup", f"SELECT frequency, quantity_unit, status, count(*) AS n, CAST(sum(orders) AS BIGINT) AS orders, CAST(sum(quantity) AS VARCHAR) AS quantity, CAST(sum(cost) AS VARCHAR) AS cost FROM {_STOCK} s GROUP BY ALL")
def inventory_rollup(spark, d):
    rows = inventory.inventory_rollup(inventory.parse_inventory(I.rows(spark, d, I.STOCK)))
    return rows.select("frequency", "quantity_unit", "status", "n", "orders", F.col("quantity").cast("string").alias("quantity"), F.col("cost").cast("string").alias("cost"))


_FOLDED = SQL["text_normalized"].replace("AS plain", "AS text")


@query("names_folded", f"SELECT doc_id, sha256(replace(lower(text), 'ß', 'ss')) AS key FROM ({_FOLDED}) d")
@query("names_folded_all", f"SELECT doc_id, sha256(replace(lower(text), 'ß', 'ss')) AS key FROM ({_FOLDED}) d")
def names_folded(spark, d):
    """All documents. lower() and sharp s are all of case folding that their letters need; tests hold fold_key against str.casefold."""
    return spark.read.parquet(f"{d}/documents.parquet").select("doc_id", F.sha2(fold_key("text").cast("binary"), 256).alias("key"))


_DEFAULTS = f"""SELECT 'alert' AS kind, id, min(feed_pos) AS feed_pos FROM (SELECT feed_pos, unnest(ids) AS id FROM {_ALERTS} i) x GROUP BY id
  UNION ALL SELECT 'reminder', b, min(feed_pos) FROM {I.sql(I.BLOBS)} l WHERE kind IN (1, 2) GROUP BY b"""


@query("default_ids", _DEFAULTS)
@query("default_ids_all", _DEFAULTS)
def default_ids(spark, d):
    raw = I.blobs(spark, d)
    both = payloads.alert_ids(raw).withColumn("kind", F.lit("alert")).unionByName(payloads.reminder_ids(raw).withColumn("kind", F.lit("reminder")))
    return both.select("kind", "id", F.col("pos.feed_pos").alias("feed_pos"))


# ---- files: what a query writes is read back by the library's sources ---------------------------


@query("sheet_read", f"SELECT * REPLACE (nullif(item_due, '') AS item_due, nullif(due_date, '') AS due_date) FROM {I.sql(I.SHEET)} s")
def sheet_read(spark, d):
    """A CSV extract whose header names nothing and that has a tenth and an eleventh column."""
    rows, path = I.rows(spark, d, I.SHEET), folder(spark, "sheet")
    feeds.write_csv(rows.select(*rows.columns[:3], *[F.col(c).alias(f"column {i}") for i, c in enumerate(rows.columns[3:])],
                                F.lit("x").alias("note"), F.lit(None).cast("string").alias("more")), path)
    return feeds.read_sheet(spark, path, fmt="csv")


_CELLS = "client, client_name, phone_no, patient_name, species, breed, code, item_due"


@query("workbook_read", f"""WITH s AS (SELECT *, file || '-' || (row_number // 5000) AS f FROM {I.sql(I.SHEET)} s),
  g AS (SELECT f, sheet, coalesce(lag(row_number) OVER (PARTITION BY f, sheet ORDER BY row_number), 1) + 1 AS n, row_number FROM s)
  SELECT f AS file, sheet, row_number, {_CELLS}, CASE WHEN row_number % 4 <> 1 THEN due_date END AS due_date, CASE WHEN row_number % 4 = 1 THEN DATE '2024-01-01' + (row_number % 300)::INT END AS due_date_typed FROM s
  UNION ALL SELECT f, sheet, n, {", ".join(["NULL"] * 10)} FROM g WHERE n < row_number""")
def workbook_read(spark, d):
    """The sheet as xlsx workbooks; a row that stands for those left out comes before each gap's end."""
    return workbooks.sheet_rows(kept(I.workbooks(spark, d), "workbooks"))


@query("csv_audit_from_file", SQL["csv_audit"])
def csv_audit_from_file(spark, d):
    """The list as a CSV file that begins with a byte-order mark."""
    path = folder(spark, "list")
    feeds.write_csv(I.rows(spark, d, I.LIST).withColumnRenamed("PMS_ID", "\ufeffPMS_ID"), path)
    return audit.audit_patients(feeds.read_csv(spark, path))


@query("inventory_read", SQL["inventory_typed"].replace("details,", """details || ' 2", "y"' AS details,""", 1))
def inventory_read(spark, d):
    path = folder(spark, "inventory")
    feeds.write_csv(I.rows(spark, d, I.STOCK).withColumn("details", F.concat("details", F.lit(' 2", "y"'))), path)
    rows = inventory.parse_inventory(feeds.read_csv(spark, path))
    return rows.select(*[F.col(c).cast("string").alias(c) if c in ("use_value", "first_order", "last_order", "cost", "quantity") else c for c in rows.columns])


@query("pages_landed", f"SELECT feed_pos // 100 AS page, feed_pos % 100 AS pos, id, code AS pims_code, updated AS updated_at FROM {I.sql(I.ACCOUNTS)} a")
def pages_landed(spark, d):
    """Accounts landed as API pages of 100, a file each, every second page a bare list."""
    page, path = F.floor(F.col("feed_pos") / 100), folder(spark, "pages")
    items = I.accounts(spark, d).groupBy(page.alias("page")).agg(F.sort_array(F.collect_list(F.struct("feed_pos", F.struct("id", "pimsCode", "updatedAt").alias("item"))))["item"].alias("items"))
    body = F.when(F.col("page") % 2 == 0, F.to_json(F.struct(F.col("items").alias("data")))).otherwise(F.to_json("items"))
    items.select("page", body.alias("value")).repartition("page").write.partitionBy("page").text(path)
    got = feeds.flatten_pages(feeds.read_pages(spark, path, "accounts"), "accounts")
    return got.select(F.regexp_extract("page_no", "page=([0-9]+)", 1).cast("bigint").alias("page"), F.col("pos").cast("bigint").alias("pos"), "id",
                      F.col("pimsCode").alias("pims_code"), F.col("updatedAt").alias("updated_at"))


def _bundle(spark, d) -> DataFrame:
    a = sync.sync_batch(normalize.normalize_accounts(I.accounts(spark, d)), "accounts", {})[0]
    b = sync.sync_batch(normalize.normalize_appointments(I.appointments(spark, d)), "appointments", {})[0]
    return _flat(a).unionByName(_flat(b))


_BUNDLE_SQL = f"""SELECT * FROM ({_export_sql("accounts", "account_id", ACC_FIELDS, ACC, "'clear'", None, "true")}) a
  UNION ALL BY NAME SELECT * FROM ({_STREAM_SQL}) b"""


@query("bundle_written", _BUNDLE_SQL)
def bundle_written(spark, d):
    """Both feeds' records in one JSON export, a folder a feed, nulls written."""
    records, path = _bundle(spark, d), folder(spark, "bundle")
    feeds.write_json(records, path, "source_type")
    return spark.read.schema(records.schema).json(path).select(*records.columns)


@query("bundle_first_per_feed", f"SELECT * FROM ({_BUNDLE_SQL}) u QUALIFY row_number() OVER (PARTITION BY source_type ORDER BY source_id) <= 20")
def bundle_first_per_feed(spark, d):
    return sync.first_per_feed(_bundle(spark, d), 20)


@query("sync_state_saved", f"SELECT 'accounts' AS feed, max(updated_at) AS watermark FROM {ACC} a UNION ALL SELECT 'appointments', max(updated_at) FROM {APP} b UNION ALL SELECT 'patients', NULL")
def sync_state_saved(spark, d):
    """Both feeds are synced by the state as loaded, which is saved after each; patients never moved."""
    path = folder(spark, "state")
    sync.save_state(spark, path, {"patients": None, "accounts": "2024-01-10T00:00:00Z"})
    for feed, rows in (("accounts", normalize.normalize_accounts(I.accounts(spark, d))), ("appointments", normalize.normalize_appointments(I.appointments(spark, d)))):
        sync.save_state(spark, path, sync.sync_batch(rows, feed, sync.load_state(spark, path), advance=True)[1])
    return spark.read.schema(sync.STATE).json(path)


@query("accounts_not_deleted", f"SELECT id, code AS pims_code FROM {I.sql(I.ACCOUNTS)} a WHERE deleted IS NULL")
def accounts_not_deleted(spark, d):
    return feeds.exclude_deleted(I.accounts(spark, d)).select("id", F.col("pimsCode").alias("pims_code"))


@query("sample_payloads", f"""SELECT id AS account_id, '{{"accountId":"' || id || '","breedId":7,"name":"Trial","speciesId":"canine","alertIds":[101],"reminderIds":[201]'
  || coalesce(',"pimsCode":"' || other || '"', '') || ',"sexId":"f"}}' AS payload FROM {I.sql(I.ACCOUNTS)} a""")
def sample_payloads(spark, d):
    rows = payloads.sample_patients(normalize.normalize_accounts(I.accounts(spark, d)), "Trial", 7, "canine", "f")
    return payloads.build_patient_payloads(rows, 101, [201])[0].select(F.col("accountId").alias("account_id"), "payload")


@query("json_or_text", f"""SELECT feed_pos, CASE WHEN feed_pos % 11 = 0 OR kind = 3 THEN NULL WHEN kind = 0 THEN '{{"alerts":[{{"id":' || a || '}},{{"alertId":"' || b || '"}}],"id":77}}'
  WHEN kind = 1 THEN '{{"data":{{"id":' || a || ',"x":{{"reminderId":' || b || ',"y":["' || a || '"]}}}}}}' ELSE '[{{"reminderLabelId":' || b || '}},{{"note":"n' || a || '"}}]' END AS json,
  CASE WHEN feed_pos % 11 <> 0 AND kind = 3 THEN 'no json' END AS text FROM {I.sql(I.BLOBS)} b""")
def json_or_text_(spark, d):
    """Landed texts, every eleventh of them empty."""
    raw = F.when(F.col("feed_pos") % 11 == 0, "").otherwise(F.col("raw"))
    return I.blobs(spark, d).select("feed_pos", json_or_text(raw).alias("x")).select("feed_pos", "x.*")


# ---- landed pages in the order of their cursors ------------------------------------------------


def _page_rows(spark, d, size: int) -> DataFrame:
    """Accounts in pages of some size: k, from 0, and the page's items."""
    k = F.floor(F.col("feed_pos") / size)
    item = F.struct("id", "pimsCode", "updatedAt")
    return I.accounts(spark, d).groupBy(k.alias("k")).agg(F.sort_array(F.collect_list(F.struct("feed_pos", item.alias("item"))))["item"].alias("items"))


@query("pages_in_cursor_order", f"SELECT row_number() OVER (ORDER BY feed_pos) - 1 AS feed_pos, id, code AS pims_code, updated AS updated_at FROM {I.sql(I.ACCOUNTS)} a")
def pages_in_cursor_order(spark, d):
    """Pages of 25 under names that say nothing of their order; half of them carry metadata, half plain cursors."""
    path, pages = folder(spark, "pages"), _page_rows(spark, d, 25)
    last = pages.agg(F.max("k").alias("last"))
    own, after = F.when(F.col("k") > 0, F.concat(F.lit("c"), F.col("k"))), F.when(F.col("k") < F.col("last"), F.concat(F.lit("c"), F.col("k") + 1))
    body = F.when(F.col("k") % 2 == 0, F.to_json(F.struct(F.col("items").alias("accounts"), F.struct(after.alias("after"), own.alias("before")).alias("metadata")))).otherwise(
        F.to_json(F.struct(F.col("items").alias("data"), after.alias("nextPageCursor"), own.alias("pageCursor"))))
    pages.crossJoin(last).select(F.md5(F.concat(F.lit("page"), F.col("k"))).alias("name"), body.alias("value")).repartition("name").write.partitionBy("name").text(path)
    got = cursors.flatten_in_order(feeds.read_pages(spark, path, "accounts"), "accounts")[0]
    return got.select("feed_pos", "id", F.col("pimsCode").alias("pims_code"), F.col("updatedAt").alias("updated_at"))


_FAULT = "CASE WHEN k % 60 = 41 THEN 'lost' WHEN k % 60 > 50 THEN 'own' WHEN k % 60 = 7 THEN 'twice' WHEN k % 60 = 20 THEN 'forked' ELSE '' END"


@query("pages_rejected", f"""SELECT copy || '-' || k AS page_no, CASE WHEN fault = 'twice' AND copy = 'b' THEN 'repeat' WHEN fault = 'forked' THEN 'fork' WHEN fault = 'own' AND k % 2 = 1 THEN 'loop' ELSE 'gap' END AS reason
  FROM (SELECT DISTINCT feed_pos // 5 AS k FROM {I.sql(I.ACCOUNTS)} a) p JOIN (VALUES ('a'), ('b')) c(copy) ON true JOIN LATERAL (SELECT {_FAULT} AS fault) f ON true
  WHERE fault <> 'lost' AND (copy = 'a' OR fault IN ('twice', 'forked')) AND (fault IN ('forked', 'own') OR copy = 'b' OR k > 20)""")
def pages_rejected(spark, d):
    """Pages of which some are lost, landed twice, differ under one cursor, name themselves as the next or hang on nothing."""
    p = _page_rows(spark, d, 5).withColumn("fault", F.expr(_FAULT)).where("fault <> 'lost'")
    p = p.withColumn("copy", F.explode(F.when(F.col("fault").isin("twice", "forked"), F.array(F.lit("a"), F.lit("b"))).otherwise(F.array(F.lit("a")))))
    odd = F.concat(F.lit("odd"), F.col("k"))
    own = F.when(F.col("fault") == "own", odd).when(F.col("k") > 0, F.concat(F.lit("c"), F.col("k")))
    after = F.when(F.col("fault") == "own", F.when(F.col("k") % 2 == 1, odd)).when((F.col("fault") == "forked") & (F.col("copy") == "b"), "elsewhere").otherwise(F.concat(F.lit("c"), F.col("k") + 1))
    pages = p.select(F.concat_ws("-", "copy", "k").alias("page_no"), F.col("items").alias("data"), own.alias("cursor"), after.alias("next_cursor"))
    return cursors.order_pages(pages, "accounts")[1]


#: Items of a landed page, or so: a page is read as a whole, so that more rows must make more pages, not larger ones.
_LANDED = 50_000


@query("feeds_landed", f"""SELECT 'appointments' AS feed, id, patient AS patient_id, kind, day AS at FROM (SELECT CASE WHEN id % 2 = 0 THEN 'a-' || id ELSE '' || id END AS id, CASE WHEN patient % 3 = 0 THEN 'p-' || patient ELSE '' || patient END AS patient,
  CASE WHEN type IS NULL THEN NULL ELSE '' || type END AS kind, day FROM {I.sql(I.APPOINTMENTS)} a) a
  UNION ALL SELECT 'patients', id, NULL, name, NULL FROM {I.sql(I.PATIENTS)} p UNION ALL SELECT 'reminders', NULL, pid, NULL, due FROM {REM} r""")
def feeds_landed(spark, d):
    """Three more feeds landed as pages whose ids are texts in some rows and numbers in others."""
    a = I.appointments(spark, d)
    text = lambda c, test, mark: F.when(test, F.concat(F.lit(f'"{mark}-'), c, F.lit('"'))).otherwise(c.cast("string"))
    item = F.concat(F.lit('{"id":'), text(F.col("id"), F.col("id") % 2 == 0, "a"), F.lit(',"patientId":'), text(F.col("patientId"), F.col("patientId") % 3 == 0, "p"),
                    F.lit(',"appointmentTypeId":'), F.coalesce(F.when(F.col("id") % 5 == 0, F.concat(F.lit('"'), F.col("appointmentTypeId"), F.lit('"'))).otherwise(F.col("appointmentTypeId").cast("string")), F.lit("null")),
                    F.lit(',"startsAt":"'), F.col("startsAt"), F.lit('"}'))
    p = I.patients(spark, d).select("id", "name", "accountId")
    whole = F.concat(F.lit('{"id":'), "id", F.lit(',"name":"'), "name", F.lit('","accountId":"'), "accountId", F.lit('"}'))
    r = I.reminders(spark, d)
    out = []
    for feed, items in (("appointments", a.select(item.alias("item"))), ("patients", p.select(whole.alias("item"))), ("reminders", r.select(F.to_json(F.struct(*r.columns)).alias("item")))):
        path = folder(spark, feed)
        page = F.pmod(F.xxhash64("item"), F.lit(max(20, -(-items.count() // _LANDED)))).alias("page")
        items.select(page, "item").groupBy("page").agg(F.collect_list("item").alias("items")).select(
            "page", F.concat(F.lit('{"data":['), F.array_join("items", ","), F.lit("]}")).alias("value")).write.partitionBy("page").text(path, compression="gzip")
        out.append(feeds.flatten_pages(feeds.read_pages(spark, path, feed), feed))
    none = F.lit(None).cast("string")
    n = normalize.normalize_appointments(out[0])
    rows = n.select(F.lit("appointments").alias("feed"), F.col("appointment_id").alias("id"), "patient_id", F.col("appointment_type_id").alias("kind"), F.col("starts_at").alias("at"))
    rows = rows.unionByName(out[1].select(F.lit("patients").alias("feed"), "id", none.alias("patient_id"), F.col("name").alias("kind"), none.alias("at")))
    return rows.unionByName(out[2].select(F.lit("reminders").alias("feed"), "id", F.coalesce("patientId", "patient_id", "patient.id").alias("patient_id"), none.alias("kind"), F.col("dueAt").alias("at")))


# ---- one giant sheet, and the import from sheet to submission ------------------------------------

_ONE = ("events", {**I.SHEET[1], "file": "'f'", "sheet": "'s'"})


@query("sheet_groups_giant", SQL["sheet_groups"].replace(I.sql(I.SHEET), I.sql(_ONE)))
def sheet_groups_giant(spark, d):
    """All rows as one sheet, which many tasks share."""
    return reminders.group_sheet_rows(I.rows(spark, d, _ONE), giant=True)[0].drop("due_date")


@query("sheet_errors_giant", SQL["sheet_errors"].replace(I.sql(I.SHEET), I.sql(_ONE)))
def sheet_errors_giant(spark, d):
    return reminders.group_sheet_rows(I.rows(spark, d, _ONE), giant=True)[1]


_IMPORT_PLANS = _PLANS.replace(I.sql(I.SHEET), I.sql(I.IMPORT))
_IMPORT_SRC = f"(SELECT DISTINCT client || chr(31) || client_name || chr(31) || phone_no || chr(31) || patient_name AS src_id, client, client_name, phone_no, patient_name FROM {_IMPORT_PLANS} p WHERE n_valid > 0)"


def _import_sql(resolved: str) -> str:
    found = _patients_sql(resolved).replace(_SRC, _IMPORT_SRC).replace(I.sql(I.PATIENTS), I.sql(I.PETS))
    return f"""SELECT file, sheet, header_row, p.client, p.patient_name, n_valid, CASE WHEN n_valid = 0 THEN 'skipped_no_valid_reminders' WHEN patient_status = 'resolved' THEN 'submitted' ELSE 'unresolved_' || patient_status END AS status,
      CASE WHEN n_valid > 0 AND patient_status = 'resolved' THEN patient_id END AS patient_id, CASE WHEN n_valid > 0 AND patient_status = 'resolved' THEN valid END AS reminders
      FROM {_IMPORT_PLANS} p LEFT JOIN {found} f ON f.src_id = p.client || chr(31) || p.client_name || chr(31) || p.phone_no || chr(31) || p.patient_name"""


def _imported(spark, d, mode):
    out, _ = importing.import_sheets(I.rows(spark, d, I.IMPORT), _accounts(spark, d), I.patients(spark, d, I.PETS), mode)
    line = lambda x: F.concat(x["row_number"].cast("string"), F.lit("="), x["mapped_label"], F.lit("@"), x["due_date"])
    return out.withColumn("reminders", F.array_join(F.transform("reminders", line), ";"))


@query("import_result", re.sub(r"\n\s*", " ", _import_sql(_STRICT)))
def import_result(spark, d):
    """The whole import: sheet, plans, distinct sources, resolution, submission."""
    return _imported(spark, d, "strict")


@query("import_result_lenient", re.sub(r"\n\s*", " ", _import_sql(_LENIENT)))
def import_result_lenient(spark, d):
    return _imported(spark, d, "lenient")
