"""Clinic-shaped inputs drawn from the driver's tables by plain projections.

Each input is a list of columns with expressions that Spark and DuckDB read alike, so that a query
and its SQL start from the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ACCOUNTS = ("customer", {
    "feed_pos": "c_custkey", "id": "'acct-' || c_custkey", "code": "'' || c_custkey",
    "other": "CASE WHEN c_custkey % 3 = 0 THEN 'P' || (c_custkey + 7) END",
    "first": "'  ' || c_mktsegment || ' '", "middle": "CASE WHEN c_custkey % 4 = 0 THEN 'van   der' END", "last": "' Family' || (c_custkey % 211)",
    "mail": "CASE WHEN c_custkey % 2 = 0 THEN ' User' || c_custkey || '@example.org' END", "phone": "'+1 (555) ' || c_custkey",
    "updated": "'2024-01-' || lpad('' || (c_custkey % 28 + 1), 2, '0') || 'T00:00:00Z'",
    "deleted": "CASE WHEN c_acctbal < 0 THEN '2024-02-01T00:00:00Z' END"})
PATIENTS = ("orders", {
    "id": "'' || o_orderkey", "name": "o_orderpriority", "account": "'acct-' || o_custkey", "code": "'PT' || o_orderkey",
    "first": "CASE WHEN o_custkey % 9 = 0 THEN chr(9) ELSE chr(160) || 'Ann  B ' END", "last": "CASE WHEN o_custkey % 9 = 0 THEN NULL ELSE 'Lee' || (o_custkey % 50) END",
    "phone": "CASE WHEN o_custkey % 5 = 0 THEN NULL ELSE '+49 ' || o_custkey END"})
REMINDERS = ("lineitem", {
    "line": "l_linenumber", "pid": "CASE WHEN l_linenumber < 7 THEN '' || l_orderkey END", "due": "'' || CAST(l_shipdate AS DATE)",
    "off": "CASE WHEN l_returnflag = 'R' THEN '2024-01-01' END", "sent": "CASE WHEN l_linestatus = 'F' THEN '2024-01-02' END"})
APPOINTMENTS = ("events", {
    "id": "event_id + 1", "type": "CASE WHEN event_id % 17 = 0 THEN NULL ELSE length(event_type) * 1000 + ascii(event_type) END", "patient": "user_id",
    "day": "'' || CAST(ts AS DATE)", "canceled": "CASE WHEN event_type = 'error' AND event_id % 2 = 0 THEN '2024-05-05' END",
    "status": "CASE WHEN event_type = 'error' THEN 'canceled' WHEN event_id % 10 = 1 THEN 'Canceled' ELSE 'booked' END",
    "confirmed": "CASE WHEN event_type = 'purchase' THEN TRUE END"})
TYPES = ("events", {"id": "length(event_type) * 1000 + ascii(event_type)", "name": "event_type"})
SHEET = ("events", {
    "file": "'f' || (user_id % 3)", "sheet": "'s' || user_id", "row_number": "event_id + 2",
    "client": "CASE WHEN event_type = 'signup' THEN ' ' || (user_id % 1500) || ' ' ELSE ' ' END", "client_name": "CASE WHEN event_type = 'signup' THEN 'Owner  ' || user_id END",
    "phone_no": "CASE WHEN event_type = 'signup' THEN '555-' || user_id END", "patient_name": "CASE WHEN event_type = 'signup' THEN 'Pet ' || (event_id % 5) END",
    "species": "CASE WHEN event_type = 'signup' THEN 'canine' END", "breed": "CAST(NULL AS STRING)",
    "code": "CASE WHEN event_type = 'error' OR event_id % 50 = 0 THEN '  ' ELSE 'C' || (event_id % 9) END",
    "item_due": "CASE WHEN event_type = 'error' OR event_id % 50 = 0 THEN NULL ELSE CASE event_id % 8 WHEN 0 THEN 'Annual  Wellness Exam' WHEN 1 THEN 'heartgard plus 26-50' WHEN 2 THEN 'Inject - B12' "
                "WHEN 3 THEN 'Something new' WHEN 4 THEN '' WHEN 5 THEN 'Rabies Canine 3 yr' WHEN 6 THEN 'Antech Fecal w Giardia' ELSE 'Antech Fecalysis' END END",
    "due_date": "CASE WHEN event_type = 'error' OR event_id % 50 = 0 THEN NULL ELSE CASE event_id % 7 WHEN 0 THEN month(ts) || '/' || day(ts) || '/' || year(ts) WHEN 1 THEN month(ts) || '-' || day(ts) || '-' || substr('' || year(ts), 3, 2) "
                "WHEN 2 THEN '02/30/2024' WHEN 3 THEN '' WHEN 4 THEN '' || CAST(ts AS DATE) WHEN 5 THEN '1/2/69' ELSE ' 3-4-68 ' END END"})
#: The same sheet with owners in place of some client codes, and patients of such names as it has.
IMPORT = ("events", {**SHEET[1], "client": "CASE WHEN event_type = 'signup' AND event_id % 3 > 0 THEN ' ' || (user_id % 1500) || ' ' ELSE ' ' END",
    "client_name": "CASE WHEN event_type = 'signup' THEN CASE WHEN event_id % 3 = 0 THEN 'building  FAMILY' || (user_id % 211) ELSE 'Owner  ' || user_id END END"})
PETS = ("orders", {**PATIENTS[1], "name": "'PET ' || (o_orderkey % 7)"})
DATES = ("orders", {
    "id": "o_orderkey",
    "raw": "CASE o_orderkey % 9 WHEN 0 THEN month(o_orderdate) || '/' || day(o_orderdate) || '/' || year(o_orderdate) WHEN 1 THEN month(o_orderdate) || '-' || day(o_orderdate) || '-' || year(o_orderdate) "
           "WHEN 2 THEN month(o_orderdate) || '/' || day(o_orderdate) || '/' || substr('' || year(o_orderdate), 3, 2) WHEN 3 THEN lpad('' || month(o_orderdate), 2, '0') || '-' || lpad('' || day(o_orderdate), 2, '0') || '-68' "
           "WHEN 4 THEN '' || CAST(o_orderdate AS DATE) WHEN 5 THEN NULL WHEN 6 THEN '' WHEN 7 THEN CASE o_orderkey % 4 WHEN 0 THEN '  ' WHEN 1 THEN 'it' || chr(39) || 's' WHEN 2 THEN chr(34) || 'a' || chr(39) || chr(92) ELSE chr(92) || chr(34) END ELSE '13/' || day(o_orderdate) || '/69' END"})
LABELS = ("part", {
    "id": "p_partkey",
    "label": "CASE p_partkey % 10 WHEN 0 THEN 'Physical Exam' WHEN 1 THEN 'physical exam' WHEN 2 THEN 'HEARTGARD PLUS ' || p_size WHEN 3 THEN 'Nexgard Plus for Dogs ' || p_size WHEN 4 THEN 'Simparica Trios' "
             "WHEN 5 THEN 'Microchip Implant' WHEN 6 THEN 'inject - proheart 12 x' WHEN 7 THEN 'Thyroid T4 only' WHEN 8 THEN p_name ELSE 'Dermatonin Implant' END"})
LIST = ("customer", {
    "PMS_ID": "CASE WHEN c_custkey % 22 = 0 THEN '  ' WHEN c_custkey % 11 = 0 THEN chr(9) || chr(160) WHEN c_custkey % 10 = 0 THEN 'K' || CAST(floor(c_custkey / 10.0) AS INT) || chr(9) "
              "WHEN c_custkey % 5 = 0 THEN chr(160) || 'K' || CAST(floor(c_custkey / 10.0) AS INT) ELSE 'U' || c_custkey || ' ' END", "Patient": "c_name",
    "Owner": "CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE c_name END", "EMail ": "CASE WHEN c_custkey % 6 = 0 THEN '' ELSE 'x@example.org' END", "Client  Phone": "CASE WHEN c_custkey % 9 = 0 THEN '' ELSE '555' END",
    "species": "c_mktsegment", "Gender": "CASE WHEN c_custkey % 13 = 0 THEN ' ' ELSE 'f' END"})
SOURCES = ("orders", {
    "src_id": "o_orderkey", "client": "CASE o_orderkey % 4 WHEN 0 THEN '' || o_custkey WHEN 1 THEN 'P' || o_custkey ELSE '' END",
    "client_name": "CASE o_orderkey % 7 WHEN 0 THEN '' WHEN 1 THEN 'Family' || (o_custkey % 211) || ', BUILDING' ELSE 'building  FAMILY' || (o_custkey % 211) END",
    "phone_no": "CASE WHEN o_orderkey % 3 = 0 THEN '1-555-' || o_custkey ELSE '' END", "patient_name": "o_orderpriority"})
QUERIES = ("orders", {
    "query_id": "o_orderkey", "patient_id": "o_orderkey", "status": "CASE o_orderkey % 6 WHEN 0 THEN 'active' WHEN 1 THEN 'inactive' WHEN 2 THEN 'sent' WHEN 3 THEN 'unsent' WHEN 4 THEN 'other' END",
    "due_after": "CASE WHEN o_orderkey % 2 = 0 THEN '1996-01-01' END", "due_before": "CASE WHEN o_orderkey % 5 = 0 THEN '1999-06-30' END"})
#: Owners whose names have fewer or more words than the accounts'.
PARTIAL = ("orders", {**SOURCES[1], "client_name": "CASE o_orderkey % 8 WHEN 0 THEN ' ' WHEN 1 THEN 'Family' || (o_custkey % 211) || ', BUILDING' WHEN 2 THEN 'building  FAMILY' || (o_custkey % 211) "
    "WHEN 3 THEN 'Family' || (o_custkey % 211) WHEN 4 THEN 'Building B. Family' || (o_custkey % 211) WHEN 5 THEN 'Family' || (o_custkey % 211) || ' van Der' "
    "WHEN 6 THEN 'furniture  van   der family' || (o_custkey % 211) ELSE 'Nobody Else' || o_custkey END"})
#: Reminders of seven patients only, and queries of a few days each for them.
CROWDED = ("lineitem", {**REMINDERS[1], "pid": "CASE WHEN l_linenumber < 7 THEN '' || (l_orderkey % 7) END"})
SHORT = ("part", {
    "query_id": "p_partkey", "patient_id": "p_partkey % 8", "status": "CASE p_partkey % 5 WHEN 0 THEN 'active' WHEN 1 THEN 'unsent' END",
    "due_after": "CASE WHEN p_partkey % 997 = 0 THEN NULL ELSE '199' || (2 + p_partkey % 7) || '-0' || (1 + p_partkey % 9) || '-11' END",
    "due_before": "CASE WHEN p_partkey % 997 = 0 THEN NULL ELSE '199' || (2 + p_partkey % 7) || '-0' || (1 + p_partkey % 9) || '-14' END"})
STOCK = ("part", {
    "name": "p_name", "details": "p_type", "frequency": "CASE WHEN p_size % 2 = 0 THEN 'Monthly' ELSE 'EOW' END", "avg_use": "'0.5' || (p_size % 10) || ' / month'",
    "orders_count": "CASE WHEN p_size = 1 THEN '1 order' ELSE p_size || ' orders' END",
    "date_range": "CASE WHEN p_partkey % 3 = 0 THEN '2024-03-05' ELSE '2024-01-02 — 2025-02-03' END",
    "total_cost": "CASE WHEN p_partkey % 7 = 0 THEN '$-' || p_size || '.50' ELSE '$1,' || lpad('' || p_size, 3, '0') || '.25' END",
    "amount": "CASE WHEN p_partkey % 7 = 0 THEN 'for -' || p_size || ' box' ELSE 'for ' || p_size || ' vial' END", "status": "'Not mapped'"})
PAYLOADS = ("orders", {
    "accountId": "CASE WHEN o_orderkey % 31 = 0 THEN NULL ELSE 'acct-' || o_custkey END", "breedId": "CAST(o_orderkey % 40 AS INT)", "name": "o_orderpriority",
    "speciesId": "CASE WHEN o_orderkey % 37 = 0 THEN NULL ELSE 'canine' END", "color": "CASE WHEN o_orderkey % 2 = 0 THEN 'brown' END", "pimsCode": "CASE WHEN o_orderkey % 3 = 0 THEN 'PT' || o_orderkey END",
    "a": "o_orderkey % 3", "b": "o_orderkey % 5", "key": "o_orderkey"})
BLOBS = ("events", {"feed_pos": "event_id", "a": "event_id % 50", "b": "event_id % 7", "kind": "event_id % 4"})


def rows(spark: SparkSession, sf_dir: str, source) -> DataFrame:
    table, columns = source
    return spark.read.parquet(f"{sf_dir}/{table}.parquet").selectExpr(*[f"{e} AS `{n}`" for n, e in columns.items()])


def sql(source) -> str:
    table, columns = source
    return "(SELECT " + ", ".join(f'{e} AS "{n}"' for n, e in columns.items()).replace("AS STRING", "AS VARCHAR") + f" FROM {table})"


def _details(*items: dict[str, str]):
    fields = ("type", "kind", "value", "number", "phoneNumber", "email")
    return F.array(*[F.struct(*[(F.expr(x[f]) if f in x else F.lit(None).cast("string")).alias(f) for f in fields]) for x in items])


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = rows(spark, sf_dir, ACCOUNTS)
    both = _details({"type": "'Email'", "value": "mail"}, {"kind": "'Mobile'", "value": "''", "number": "phone"})
    contact = F.struct(F.col("first").alias("nameFirst"), F.col("middle").alias("nameMiddle"), F.col("last").alias("nameLast"),
                       F.when(F.col("mail").isNotNull(), both).otherwise(_details({"value": "phone"})).alias("communicationDetails"))
    return r.select("feed_pos", "id", F.col("code").alias("pimsCode"), F.col("other").alias("pimsId"), contact.alias("primaryContact"),
                    F.col("updated").alias("updatedAt"), F.col("deleted").alias("deletedAt"))


def patients(spark: SparkSession, sf_dir: str, source=PATIENTS) -> DataFrame:
    r = rows(spark, sf_dir, source)
    contact = F.struct(F.col("first").alias("nameFirst"), F.lit(None).cast("string").alias("nameMiddle"), F.col("last").alias("nameLast"),
                       _details({"type": "'email'", "value": "'x'"}, {"type": "'phone'", "phoneNumber": "phone"}).alias("communicationDetails"))
    return r.select("id", "name", F.col("account").alias("accountId"), F.col("code").alias("pimsCode"), F.struct(contact.alias("primaryContact")).alias("account"))


def reminders(spark: SparkSession, sf_dir: str, scoped: bool = True, source=REMINDERS) -> DataFrame:
    r = rows(spark, sf_dir, source)
    pid = F.col("pid") if scoped else F.lit(None).cast("string")
    at = lambda k: F.when(F.col("line") % 3 == k, pid)
    return r.select(at(0).alias("patientId"), at(1).alias("patient_id"), F.struct(at(2).alias("id")).alias("patient"),
                    F.col("due").alias("dueAt"), F.col("off").alias("deactivatedAt"), F.col("sent").alias("sentAt"))


def appointments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows(spark, sf_dir, APPOINTMENTS).select(
        F.col("id").cast("bigint").alias("id"), F.col("type").cast("bigint").alias("appointmentTypeId"), F.col("patient").cast("bigint").alias("patientId"), F.col("day").alias("startsAt"),
        F.col("day").alias("updatedAt"), F.col("canceled").alias("canceledAt"), "status", F.col("confirmed").alias("isConfirmed"))


def types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows(spark, sf_dir, TYPES).select(F.col("id").cast("bigint").alias("id"), "name").distinct()


def payload_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = F.array(F.lit(999), F.col("a").cast("int"), F.lit(999))
    return rows(spark, sf_dir, PAYLOADS).withColumns({"alertIds": F.when(F.col("a") > 0, ids), "reminderIds": F.array(F.col("b").cast("int") + 200)}).drop("a", "b")


def blobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON texts of four shapes: nested objects, digit texts, label ids, and no JSON."""
    raw = (F.when(F.col("kind") == 0, F.format_string('{"alerts":[{"id":%d},{"alertId":"%d"}],"id":77}', "a", "b"))
           .when(F.col("kind") == 1, F.format_string('{"data":{"id":%d,"x":{"reminderId":%d,"y":["%d"]}}}', "a", "b", "a"))
           .when(F.col("kind") == 2, F.format_string('[{"reminderLabelId":%d},{"note":"n%d"}]', "b", "a")).otherwise(F.lit("no json")))
    return rows(spark, sf_dir, BLOBS).select("feed_pos", raw.alias("raw"))


_SHEET_CELLS = ("client", "client_name", "phone_no", "patient_name", "species", "breed", "code", "item_due", "due_date")


def workbooks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sheet's rows as xlsx workbooks (file, content): one for 5,000 row numbers of a sheet, every fourth due date a day."""
    r = rows(spark, sf_dir, SHEET).withColumns({"file": F.format_string("%s-%d", "file", F.floor(F.col("row_number") / 5000)), "row_number": F.col("row_number").cast("bigint")})
    serial = F.when(F.col("row_number") % 4 == 1, 45292 + F.col("row_number") % 300)
    r = r.select("file", "sheet", "row_number", *_SHEET_CELLS, serial.alias("serial"))
    return r.repartition("file", "sheet").sortWithinPartitions("file", "sheet", "row_number").mapInArrow(_workbooks, "file string, content binary")


def _workbooks(batches):
    """Rows in the order of file and sheet to workbooks, some hundreds at a time: most have a few rows only."""
    from itertools import batched, groupby

    import pyarrow as pa

    rows = (x for b in batches for x in zip(*[c.to_pylist() for c in b.columns], strict=True))
    made = ((file, _workbook(sheet, some)) for (file, sheet), some in groupby(rows, key=lambda x: x[:2]))
    for some in batched(made, 200):
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in some], pa.string()), pa.array([x[1] for x in some], pa.binary())], names=["file", "content"])


def _workbook(sheet, rows) -> bytes:
    """One sheet as a workbook: shared texts in the first columns, inline ones in the others."""
    import zipfile
    from io import BytesIO
    from xml.sax.saxutils import escape

    shared: dict[str, int] = {}
    lines = ['<row r="1"><c r="A1" t="inlineStr"><is><t>Client</t></is></c></row>']
    text = lambda v: f'<t xml:space="preserve">{escape(v)}</t>'
    for _, _, n, *values, serial in rows:
        cells = []
        for i, (letter, v) in enumerate(zip("ABCDEFGHI", values, strict=True)):
            if i == 8 and serial is not None:
                cells.append(f'<c r="{letter}{n}" s="1"><v>{serial}.5</v></c>')
            elif v is None:
                continue
            elif i < 5:
                cells.append(f'<c r="{letter}{n}" t="s"><v>{shared.setdefault(v, len(shared))}</v></c>')
            else:
                cells.append(f'<c r="{letter}{n}" t="inlineStr"><is>{text(v)}</is></c>')
        lines.append(f'<row r="{n}">{"".join(cells)}<c r="K{n}"><v>7</v></c></row>')
    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    out = BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        put = lambda name, xml: z.writestr(zipfile.ZipInfo(name), xml, zipfile.ZIP_DEFLATED)
        put("xl/workbook.xml", f'<workbook {main} xmlns:r="{rel}"><sheets><sheet name="{escape(sheet)}" sheetId="1" r:id="rId1"/></sheets></workbook>')
        put("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Type="{rel}/worksheet" Target="worksheets/sheet1.xml"/></Relationships>')
        put("xl/styles.xml", f'<styleSheet {main}><cellXfs count="2"><xf numFmtId="0"/><xf numFmtId="14"/></cellXfs></styleSheet>')
        put("xl/sharedStrings.xml", f'<sst {main}>{"".join(f"<si>{text(v)}</si>" for v in shared)}</sst>')
        put("xl/worksheets/sheet1.xml", f'<worksheet {main}><sheetData>{"".join(lines)}</sheetData></worksheet>')
    return out.getvalue()
