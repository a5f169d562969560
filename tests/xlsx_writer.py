"""Minimal .xlsx writer for tests (standard library only)."""

import zipfile
from xml.sax.saxutils import escape

MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
RELS = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
PKG = "http://schemas.openxmlformats.org/package/2006/relationships"


def col_letters(i: int) -> str:
    s = ""
    i += 1
    while i:
        i, rem = divmod(i - 1, 26)
        s = chr(65 + rem) + s
    return s


def write_xlsx(path, sheets: dict, date1904: bool = False, inline: bool = False):
    """sheets: name -> list of rows (row index = list index); values str / float / None."""
    strings, index = [], {}
    parts = {}
    for n, (name, rows) in enumerate(sheets.items(), start=1):
        xml_rows = []
        for r, row in enumerate(rows):
            cells = []
            for c, v in enumerate(row):
                if v is None:
                    continue
                ref = f"{col_letters(c)}{r + 1}"
                if isinstance(v, str):
                    if inline:
                        cells.append(f'<c r="{ref}" t="inlineStr"><is><t xml:space="preserve">{escape(v)}</t></is></c>')
                    else:
                        if v not in index:
                            index[v] = len(strings)
                            strings.append(v)
                        cells.append(f'<c r="{ref}" t="s"><v>{index[v]}</v></c>')
                else:
                    cells.append(f'<c r="{ref}"><v>{repr(float(v))}</v></c>')
            if cells:
                xml_rows.append(f'<row r="{r + 1}">{"".join(cells)}</row>')
        parts[f"xl/worksheets/sheet{n}.xml"] = (
            f'<?xml version="1.0" encoding="UTF-8"?><worksheet xmlns="{MAIN}"><sheetData>'
            + "".join(xml_rows) + "</sheetData></worksheet>")
    names = list(sheets)
    wb_sheets = "".join(f'<sheet name="{escape(nm)}" sheetId="{i}" r:id="rId{i}"/>'
                        for i, nm in enumerate(names, start=1))
    pr = '<workbookPr date1904="1"/>' if date1904 else ""
    parts["xl/workbook.xml"] = (f'<?xml version="1.0" encoding="UTF-8"?><workbook xmlns="{MAIN}" '
                                f'xmlns:r="{RELS}">{pr}<sheets>{wb_sheets}</sheets></workbook>')
    rels = "".join(f'<Relationship Id="rId{i}" Type="{RELS}/worksheet" Target="worksheets/sheet{i}.xml"/>'
                   for i in range(1, len(names) + 1))
    rels += f'<Relationship Id="rIdS" Type="{RELS}/sharedStrings" Target="sharedStrings.xml"/>'
    parts["xl/_rels/workbook.xml.rels"] = f'<?xml version="1.0" encoding="UTF-8"?><Relationships xmlns="{PKG}">{rels}</Relationships>'
    sis = "".join(f'<si><t xml:space="preserve">{escape(s)}</t></si>' for s in strings)
    parts["xl/sharedStrings.xml"] = (f'<?xml version="1.0" encoding="UTF-8"?><sst xmlns="{MAIN}" '
                                     f'count="{len(strings)}" uniqueCount="{len(strings)}">{sis}</sst>')
    parts["_rels/.rels"] = (f'<?xml version="1.0" encoding="UTF-8"?><Relationships xmlns="{PKG}">'
                            f'<Relationship Id="rId1" Type="{RELS}/officeDocument" Target="xl/workbook.xml"/>'
                            '</Relationships>')
    parts["[Content_Types].xml"] = (
        '<?xml version="1.0" encoding="UTF-8"?><Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types">'
        '<Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
        '<Default Extension="xml" ContentType="application/xml"/></Types>')
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for name, body in parts.items():
            z.writestr(name, body)
