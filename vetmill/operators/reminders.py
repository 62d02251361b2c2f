"""Grouped reminder sheets: groups, due dates, label mapping, classification and import plans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vetmill.functions.text import norm_text
from vetmill.sources.shared import kept

IDENTITY = ["client", "client_name", "phone_no", "patient_name", "species", "breed"]
DUE = ["code", "item_due", "due_date"]
SHEET = ["file", "sheet"]

#: Source label to target label.
EXACT = {
    "Annual Wellness Exam": "Annual Exam",
    "Bloodwork - annual w/ Heartworm": "Annual Bloodwork",
    "Bordetella Oral Vaccine": "Bordetella Oral Parainfluenza Vaccine",
    "Credelio for Cats 4.1 - 17.0#": "Flea / Tick Prevention",
    "DA2P Annual (w/o Lepto)": "DA2P Annual ( w/o Lepto)",
    "DA2PP + Leptospirosis 4 Annual": "DA2P + Leptospirosis 4",
    "Dhlp Parvo - Corona K4": "DHLP Vaccine",
    "Feline Leukemia Annual": "Feline Leukemia (FeLV) Vaccine",
    "Feline Rabies 1 yr/Purevax": "Rabies Vaccine (Feline)",
    "Fvrcpc Annual": "FVRCP Vaccine",
    "General Senior Profile (IRL 78": "Senior Blood Work",
    "Heartworm Test - Previous Vete": "Heartworm Test",
    "In House Flex 4 Rapid Test": "Heartworm Test",
    "In House Imagyst Fecal/Oocysts": "Fecal Analysis",
    "Inject - Cytopoint": "Cytopoint Injection",
    "Inject - ProHeart 12": "ProHeart 12 Injection",
    "Inject - Solensia": "Solensia Injection",
    "Leptospirosis 4 Vaccine Annual": "Leptospirosis Vaccine",
    "Lyme Vaccine Annual": "Borrelia burgdorferi (Lyme) Vaccine",
    "Nexgard COMBO for Cats 5.6 - 16#": "Flea / Tick / Heartworm Prevention",
    "Nexgard Plus for Dogs 17 - 33#": "Flea / Tick / Heartworm Prevention",
    "Physical Exam": "Annual Exam",
    "Rabies Canine 1 yr": "Rabies Vaccine (Canine)",
    "Rabies Canine 3 yr": "Rabies 3 yr Vaccine (Canine)",
    "Rabies Canine 3yr": "Rabies 3 yr Vaccine (Canine)",
    "Revolution Plus Cat 11.1 - 22#": "Flea / Tick / Heartworm Prevention",
    "Revolution Plus Cat 5.6 - 11#": "Flea / Tick / Heartworm Prevention",
    "Simparica Trio 44.1 - 88#": "Flea / Tick / Heartworm Prevention",
    "Thyroid T4 only": "Thyroid Level",
    "Antech Canine Urine Microalbum": "Urinalysis",
    "Antech Feline Urine Microalbum": "Urinalysis",
    "Urinalysis (In House)": "Urinalysis",
    "Antech Sr Canine Wellness w/ A": "Senior Blood Work",
    "Antech Thyroid (Total T4)": "Thyroid Level",
    "Antech Thyroid T4, FT4, cTSH": "Thyroid Level",
    "Antech Free T4 (Equilibrium Di": "Thyroid Level",
    "Antech Phenobarb Levels ( Add-": "Phenobarbital Level",
    "Antech CBC, CHEM25, T4, freeT4": "Comprehensive Bloodwork",
    "Antech Urine Protein / Creatin": "Urinalysis",
    "In House Abaxis T4 / Cholester": "Thyroid Level",
    "Antech Feline Comp Well Screen": "Annual Bloodwork",
    "Antech Cholesterol/Triglycerid": "Annual Bloodwork",
    "Antech Accuplex 4 ( HW plus Ti": "Heartworm Test",
    "Antech Canine Heartworm ANTIGE": "Heartworm Test",
    "Dermatonin Implant": "Dermatonin Implant",
    "Dermatonin Implant 8.0mg": "Dermatonin Implant",
}
#: Labels that never become reminders.
EXCLUDED = [
    "Antech Urine MIC Culture", "In House Abx CBC", "In House Abx Chem 17", "In House Glucose Curve", "Inject - Adequan Canine",
    "Inject - Adequan Feline", "Inject - B12", "Inject - Convenia", "Inject - Dexamethasone SP", "Inject - Depo Medrol",
    "Metacam Injection", "Microchip Implant",
]
#: Label beginnings (whole words, any case) in order, with their target.
BEGINNINGS = [
    ("Heartgard Plus", "Heartworm Prevention"),
    ("Nexgard Plus for Dogs", "Flea / Tick / Heartworm Prevention"),
    ("Nexgard COMBO for Cats", "Flea / Tick / Heartworm Prevention"),
    ("Revolution Plus Cat", "Flea / Tick / Heartworm Prevention"),
    ("Simparica Trio", "Flea / Tick / Heartworm Prevention"),
    ("Credelio for Cats", "Flea / Tick Prevention"),
    ("Antech Fecal", "Fecal Analysis"),
    ("Inject - ProHeart 12", "ProHeart 12 Injection"),
]


def _carried_in_sheets(marked: DataFrame, opener: Column) -> DataFrame:
    """The last opener of each row's sheet up to the row, by one window over the sheet."""
    seen = Window.partitionBy(*SHEET).orderBy("row_number").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return marked.withColumn("_open", F.last(opener, ignorenulls=True).over(seen))


def _carried_in_stretches(marked: DataFrame, opener: Column) -> DataFrame:
    """The same by a segmented scan: rows are dealt by ranges of (sheet, row number), so that many tasks share a sheet;
    each carries within its stretch, and a stretch that goes on with a sheet takes the last opener before it.

    What is carried over is a row for each stretch that begins within a sheet, so its broadcast is bounded by the number
    of tasks."""
    place = [*SHEET, "row_number"]
    dealt = kept(marked.withColumn("_opener", opener).repartitionByRange(*place).withColumn("_stretch", F.spark_partition_id()), "sheet")
    last = dealt.groupBy(*SHEET, "_stretch").agg(F.max(F.when(F.col("_opener").isNotNull(), F.struct("row_number", "_opener")))["_opener"].alias("_last"))
    before = Window.partitionBy(*SHEET).orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    carry = last.withColumn("_before", F.last("_last", ignorenulls=True).over(before)).where("_before is not null").drop("_last")
    seen = Window.partitionBy("_stretch", *SHEET).orderBy("row_number").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = dealt.withColumn("_here", F.last("_opener", ignorenulls=True).over(seen)).join(F.broadcast(carry), [*SHEET, "_stretch"], "left")
    return rows.withColumn("_open", F.coalesce("_here", "_before")).drop("_here", "_before", "_opener", "_stretch")


def group_sheet_rows(rows: DataFrame, strict: bool = False, giant: bool = False) -> tuple[DataFrame, DataFrame]:
    """Rows of a sheet in their patient groups, and the rows that break the layout.

    rows: file, sheet, row_number, nine text columns, perhaps due_date_typed. A row with identity
    opens a group; a blank one ends it; others carry on. The first frame has header_row and the
    header's identity on every row; the second has row_number and reason. One window over each
    sheet does it all; sheets are independent. giant: a sheet may be longer than a task can hold, and is
    shared by many (both ways give the same rows). strict: the job fails on a broken row."""
    typed = "due_date_typed" in rows.columns
    date = F.coalesce(F.col("due_date_typed").cast("string"), F.col("due_date")) if typed else F.col("due_date")
    has_id = F.concat(*[norm_text(c) for c in IDENTITY]) != ""
    has_due = F.concat(norm_text("code"), norm_text("item_due"), norm_text(date)) != ""
    marked = rows.withColumns({"_id": has_id, "_due": has_due})
    opener = F.when(F.col("_id") | ~F.col("_due"), F.struct(
        F.col("_id").alias("opens"), F.col("row_number").alias("row"), *[norm_text(c).alias(c) for c in IDENTITY]))
    marked = (_carried_in_stretches if giant else _carried_in_sheets)(marked, opener).where("_id or _due")
    reason = F.when(F.col("_id") & ~F.col("_due"), "header_without_reminder").when(
        ~F.coalesce(F.col("_open.opens"), F.lit(False)), "continuation_without_header")
    marked = marked.withColumn("_reason", reason)
    if strict:
        marked = marked.withColumn("_reason", F.when(F.col("_reason").isNotNull(), F.raise_error(
            F.concat(F.col("_reason"), F.lit(" at row "), F.col("row_number"))).cast("string")))
    good = marked.where("_reason is null").select(
        *SHEET, "row_number", F.col("_open.row").alias("header_row"), *[F.col(f"_open.{c}").alias(c) for c in IDENTITY],
        norm_text("code").alias("code"), norm_text("item_due").alias("item_due"), "due_date", *["due_date_typed"] * typed)
    return good, marked.where("_reason is not null").select(*SHEET, "row_number", F.col("_reason").alias("reason"))


def parse_due_date(text: Column | str, typed: Column | None = None) -> Column:
    """A date cell, or text as month, day and year with / or -; two-digit years from 69 on are 19xx."""
    plain = norm_text(text)
    pattern = r"^([0-9]{1,2})([/-])([0-9]{1,2})\2([0-9]{4}|[0-9]{2})$"
    month, day, year = (F.regexp_extract(plain, pattern, i) for i in (1, 3, 4))
    full = F.when(F.length(year) == 4, year).otherwise(F.concat(F.when(year >= "69", "19").otherwise("20"), year))
    found = F.when(plain.rlike(pattern), F.try_to_date(F.concat_ws("-", full, F.lpad(month, 2, "0"), F.lpad(day, 2, "0")), "yyyy-MM-dd"))
    return found if typed is None else F.coalesce(typed, found)


def due_date_error(text: Column | str, typed: Column | None = None) -> Column:
    """Why parse_due_date gives nothing; null where it gives a date. The text stands in single quotes, in
    double ones if it holds only single ones; backslashes and quotes that would end it are escaped."""
    raw = F.col(text) if isinstance(text, str) else text
    missing = raw.isNull() | (raw == "")
    text = F.replace(norm_text(raw), F.lit("\\"), F.lit("\\\\"))
    double = F.contains(text, F.lit("'")) & ~F.contains(text, F.lit('"'))
    quoted = F.when(double, F.concat(F.lit('"'), text, F.lit('"'))).otherwise(F.concat(F.lit("'"), F.replace(text, F.lit("'"), F.lit("\\'")), F.lit("'")))
    why = F.when(missing, F.lit("Missing due date")).otherwise(F.concat(F.lit("Unsupported due date format: "), quoted))
    return F.when(parse_due_date(raw, typed).isNull(), why)


def excluded(label: Column, labels: list[str] | None = None) -> Column:
    return label.isin(EXCLUDED if labels is None else labels)


def map_label(label: Column, exact: dict[str, str] | None = None, beginnings=None, out: list[str] | None = None) -> Column:
    """The target label: null if excluded, else by the dictionary, else by the first beginning."""
    pairs = EXACT if exact is None else exact
    table = F.create_map(*[F.lit(x) for kv in pairs.items() for x in kv]) if pairs else None
    rule = F.lit(None).cast("string")
    for start, target in reversed(BEGINNINGS if beginnings is None else beginnings):
        rule = F.when(label.rlike(rf"(?i)^\Q{start}\E\b"), F.lit(target)).otherwise(rule)
    hit = F.coalesce(F.try_element_at(table, label), rule) if table is not None else rule
    return F.when(~excluded(label, out), hit)


def classify_reminders(rows: DataFrame, exact=None, beginnings=None, out=None) -> DataFrame:
    """Rows with mapped_label, due (ISO text) and reason: no label, then bad date, then excluded,
    then unmapped; null for a valid reminder."""
    typed = F.col("due_date_typed") if "due_date_typed" in rows.columns else None
    label, error = F.col("item_due"), due_date_error("due_date", typed)
    reason = (F.when(label == "", "missing_source_label").when(error.isNotNull(), F.concat(F.lit("bad_due_date: "), error))
              .when(excluded(label, out), "excluded_non_reminder_item").when(F.col("_mapped").isNull(), "no_mapping"))
    rows = rows.withColumn("_mapped", map_label(label, exact, beginnings, out)).withColumn("reason", reason)
    valid = F.col("reason").isNull()
    return rows.select(*[c for c in rows.columns if c not in ("_mapped", "reason")], "reason",
                       F.when(valid, F.col("_mapped")).alias("mapped_label"),
                       F.when(valid, parse_due_date("due_date", typed).cast("string")).alias("due"))


def reason_counts(classified: DataFrame) -> DataFrame:
    """Rows for each reason; valid ones under 'valid', bad dates without their text."""
    return classified.groupBy(F.coalesce(F.substring_index("reason", ":", 1), F.lit("valid")).alias("reason")).agg(F.count("*").alias("n"))


def build_plans(classified: DataFrame) -> DataFrame:
    """One row for each group: identity, valid_reminders and skipped_rows in the sheet's order."""
    valid = F.when(F.col("reason").isNull(), F.struct("row_number", F.col("code").alias("source_code"), F.col("item_due").alias("source_label"), "mapped_label", F.col("due").alias("due_date")))
    skipped = F.when(F.col("reason").isNotNull(), F.struct("row_number", F.col("code").alias("source_code"), F.col("item_due").alias("source_label"), "reason"))
    return classified.groupBy(*SHEET, "header_row", *IDENTITY).agg(
        F.array_sort(F.collect_list(valid)).alias("valid_reminders"), F.array_sort(F.collect_list(skipped)).alias("skipped_rows"))


def first_plans(plans: DataFrame, limit: int | None, zero_is_all: bool = False) -> DataFrame:
    """The first plans in sheet order; None: all. zero_is_all: 0 stands for all too, as in the JSON export."""
    if limit is None or (zero_is_all and not limit):
        return plans
    return plans.orderBy(*SHEET, "header_row").limit(max(limit, 0))


def plan_json(plans: DataFrame) -> DataFrame:
    """Plans as JSON texts with nulls written."""
    last = lambda name, fields: F.transform(name, lambda x: F.struct(*[x[f].alias(f) for f in [*fields, "row_number"]])).alias(name)
    patient = F.struct(*IDENTITY, F.col("header_row").alias("header_row_number")).alias("patient")
    valid = last("valid_reminders", ["source_code", "source_label", "mapped_label", "due_date"])
    body = F.to_json(F.struct(patient, valid, last("skipped_rows", ["source_code", "source_label", "reason"])), {"ignoreNullFields": "false"})
    return plans.select(*SHEET, "header_row", body.alias("plan"))


def dry_run_lines(classified: DataFrame) -> DataFrame:
    """One readable line for each row of the plans, in sheet order columns."""
    line = F.when(F.col("reason").isNull(), F.format_string("%s (%s) row %d: %s -> %s due %s", "patient_name", "client", "row_number", "item_due", "mapped_label", "due")).otherwise(
        F.format_string("%s (%s) row %d: skipped %s: %s", "patient_name", "client", "row_number", "item_due", "reason"))
    return classified.select(*SHEET, "header_row", "row_number", line.alias("line"))


def empty_halves(plans: DataFrame) -> DataFrame:
    """A line "valid: none" or "skipped: none" for each half of a plan without rows."""
    half = lambda c, name: F.when(F.size(c) == 0, F.lit(f"{name}: none"))
    lines = F.array_compact(F.array(half("valid_reminders", "valid"), half("skipped_rows", "skipped")))
    return plans.select(*SHEET, "header_row", F.explode(lines).alias("line"))
