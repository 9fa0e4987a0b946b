"""Writes small workbooks with the standard library."""

from __future__ import annotations

import zipfile
from xml.sax.saxutils import escape

MONTHS = ("Ene", "Feb", "Mar", "Abr", "May", "Jun", "Jul", "Ago", "Sep", "Oct", "Nov", "Dic")
NAMES = ("Enero", "Febrero", "Marzo", "Abril", "Mayo", "Junio", "Julio", "Agosto", "Septiembre", "Octubre", "Noviembre", "Diciembre")


def letters(column: int) -> str:
    out = ""
    column += 1
    while column:
        column, rest = divmod(column - 1, 26)
        out = chr(65 + rest) + out
    return out


def write(path, sheets: dict[str, list[list]], shared: bool = True) -> str:
    strings: list[str] = []
    with zipfile.ZipFile(path, "w") as z:
        rels, names = [], []
        for k, (name, rows) in enumerate(sheets.items(), 1):
            lines = []
            for i, row in enumerate(rows):
                cells = []
                for j, v in enumerate(row):
                    at = f'r="{letters(j)}{i + 1}"'
                    if isinstance(v, str) and shared:
                        strings.append(v)
                        cells.append(f'<c {at} t="s"><v>{len(strings) - 1}</v></c>')
                    elif isinstance(v, str):
                        cells.append(f'<c {at} t="inlineStr"><is><t>{escape(v)}</t></is></c>')
                    elif isinstance(v, bool):
                        cells.append(f'<c {at} t="b"><v>{int(v)}</v></c>')
                    elif v is not None:
                        cells.append(f"<c {at}><v>{v}</v></c>")
                if cells:
                    lines.append(f'<row r="{i + 1}">{"".join(cells)}</row>')
            z.writestr(f"xl/worksheets/sheet{k}.xml", f'<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>{"".join(lines)}</sheetData></worksheet>')
            names.append(f'<sheet name="{escape(name)}" sheetId="{k}" r:id="rId{k}"/>')
            rels.append(f'<Relationship Id="rId{k}" Target="worksheets/sheet{k}.xml" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/worksheet"/>')
        z.writestr("xl/workbook.xml", f'<workbook xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets>{"".join(names)}</sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">{"".join(rels)}</Relationships>')
        if shared:
            items = "".join(f"<si><t>{escape(s)}</t></si>" for s in strings)
            z.writestr("xl/sharedStrings.xml", f'<sst xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main">{items}</sst>')
    return str(path)


def rate_value(year: int, month: int) -> float:
    return (31 * year + 17 * month) % 101 / 4


def rate_grid(years: int = 3, first: int = 2022, months: int = 12, values=None) -> list[list]:
    wide = 1 + months * years
    row = lambda label, f: [label, *(f(y, m) for y in range(years) for m in range(months))]
    grid = [[None] * wide for _ in range(11)]
    grid[5][0], grid[10][0] = "Hogares", "País"
    grid.append(row("Concepto", lambda y, m: first + y if m == 0 else None))
    grid.append(row(None, lambda y, m: MONTHS[m]))
    grid += [row(label, lambda y, m, v=v: v) for label, v in (("Población", 70.0), ("Activos", 60.0), ("Ocupados", 50.0))]
    grid.append(row("Tasa de Desocupación (TD)", lambda y, m: values[m] if values else rate_value(y, m)))
    grid.append(["Fuente: X"])
    return grid


def index_value(year: int, month: int) -> float:
    return 80 + 12 * year + month + 0.25


def index_grid() -> list[list]:
    """Two whole years and two months of a third."""
    grid: list[list] = [[None] * 4 for _ in range(8)]
    grid[2][0], grid[4][0] = "Serie", "Base\n2018"
    grid.append(["Mes", 2023, 2024, 2025])
    for m, name in enumerate(NAMES):
        grid.append([name, *(index_value(y, m) if y < 2 or m < 2 else None for y in range(3))])
    return [*grid, [], ["Fuente: X."], ["Nota"]]
