import zipfile
from datetime import date

import pytest

from vetmill.sources import workbooks

MAIN = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
ONE = """<row r="1"><c r="A1" t="s"><v>0</v></c></row>
<row r="2"><c r="A2"><v>77</v></c><c r="B2" t="s"><v>1</v></c><c r="C2"><v>5.50</v></c><c r="F2" t="b"><v>1</v></c><c r="G2" t="e"><v>#N/A</v></c><c r="H2" t="str"><v>a &amp; b</v></c><c r="I2" s="1"><v>45293.75</v></c><c r="J2"><v>1</v></c></row>
<row r="3"><c r="A3" s="2"><v>59</v></c><c r="B3" s="3"><v>0.5</v></c><c r="I3" t="d"><v>2024-03-04T05:06:07</v></c></row>
<row r="7"><c t="inlineStr"><is><r><t>in</t></r><r><t>line</t></r><rPh><t>no</t></rPh></is></c><c><v>1E3</v></c><c r="I7" t="s"><v>2</v></c><c r="AA7"><v>9</v></c></row><row><c r="A8" s="1"/></row>"""
STYLES = '<numFmts><numFmt numFmtId="164" formatCode="[$-409]d\\-mmm;@"/><numFmt numFmtId="165" formatCode="[h]:mm &quot;days&quot;"/></numFmts><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/><xf numFmtId="164"/><xf numFmtId="165"/></cellXfs>'


def book(path, sheets, kind="", styles=STYLES):
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {MAIN} xmlns:r="{REL}">{kind}<sheets>' + "".join(f'<sheet name="{n}" sheetId="{i}" r:id="r{i}"/>' for i, n in enumerate(sheets)) + "</sheets></workbook>")
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">' + "".join(f'<Relationship Id="r{i}" Target="{"/xl/" if i else ""}worksheets/s{i}.xml"/>' for i in range(len(sheets))) + "</Relationships>")
        if styles:
            z.writestr("xl/styles.xml", f"<styleSheet {MAIN}>{styles}</styleSheet>")
            z.writestr("xl/sharedStrings.xml", f'<sst {MAIN}><si><t>Client</t></si><si><t xml:space="preserve"> Jo  </t></si><si><r><t>1/2</t></r><r><t>/2024</t></r></si></sst>')
        for i, body in enumerate(sheets.values()):
            z.writestr(f"xl/worksheets/s{i}.xml", f"<worksheet {MAIN}><sheetData>{body}</sheetData></worksheet>")


def test_cells_of_every_kind(spark, tmp_path):
    book(tmp_path / "a.xlsx", {"one": ONE, "empty": "", "head": '<row r="1"/>'})
    book(tmp_path / "b.xlsx", {"old": '<row r="2"><c r="I2" s="1"><v>1</v></c></row>'}, '<workbookPr date1904="1"/>')
    book(tmp_path / "c.xlsx", {"bare": '<row><c><v>1</v></c></row><row><c><v>2</v></c></row>'}, styles=None)
    (tmp_path / "note.txt").write_text("not a workbook")
    rows = workbooks.read_workbooks(spark, str(tmp_path))
    got = sorted((r.file.rsplit("/", 1)[1], *tuple(r)[1:]) for r in rows.collect() if r.row_number)
    none = (None,)
    assert [x for x in got if x[1] == "one"] == [
        ("a.xlsx", "one", 2, "77", " Jo  ", "5.5", None, None, "True", "#N/A", "a & b", None, date(2024, 1, 2)),
        ("a.xlsx", "one", 3, "1900-02-28 00:00:00", "0.5", *none * 7, date(2024, 3, 4)),
        ("a.xlsx", "one", 4, *none * 10),
        ("a.xlsx", "one", 7, "inline", "1000.0", *none * 6, "1/2/2024", None),
        ("a.xlsx", "one", 8, *none * 10)]
    assert [x for x in got if x[1] != "one"] == [("b.xlsx", "old", 2, *none * 9, date(1904, 1, 2)), ("c.xlsx", "bare", 2, "1", *none * 9), ("c.xlsx", "bare", 3, "2", *none * 9)]
    assert workbooks.read_workbooks(spark, str(tmp_path), "old").count() == 1 and workbooks.read_workbooks(spark, str(tmp_path), "none").count() == 0


def test_a_file_that_is_no_workbook_fails(spark, tmp_path):
    (tmp_path / "x.xlsx").write_text("text")
    with pytest.raises(Exception, match="not a zip file"):
        workbooks.read_workbooks(spark, str(tmp_path)).collect()


def test_many_small_workbooks_share_batches(spark, tmp_path, monkeypatch):
    """Workbooks and rows are handed on by the hundred, not one by one; a long sheet reads the same as a stream."""
    from io import BytesIO

    import pyarrow as pa

    def made(i):
        out = BytesIO()
        book(out, {"a": f'<row r="2"><c r="A2"><v>{i}</v></c></row>', "b": ONE})
        return out.getvalue()

    batch = pa.RecordBatch.from_arrays([pa.array([f"f{i}" for i in range(300)]), pa.array([made(i) for i in range(300)], pa.binary())], names=["file", "content"])
    packed = list(workbooks._take_apart(iter([batch])))
    assert [b.num_rows for b in packed] == [256, 256, 88]
    rows = list(workbooks._rows(iter(packed)))
    assert [b.num_rows for b in rows] == [300 + 300 * 5]
    assert [r for r in rows[0].to_pylist() if r["sheet"] == "a"] == [{"file": f"f{i}", "sheet": "a", "row_number": 2, **dict.fromkeys(rows[0].schema.names[3:]), "client": str(i)} for i in range(300)]
    monkeypatch.setattr(workbooks, "WHOLE", 10)
    monkeypatch.setattr(workbooks, "MOST", 1)
    packed = list(workbooks._take_apart(iter([batch])))
    assert len(packed) == 600 and list(workbooks._rows(iter(packed)))[0].equals(rows[0])
