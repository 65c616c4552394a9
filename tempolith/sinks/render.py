"""Tables as text: bar-, comma- and tab-separated, and HTML, as Column expressions."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: the frame of an HTML table, its foot as readers of such files know it
_HTML_HEAD = "<!DOCTYPE html>\n<html>\n<head>\n<style>\ntable {\n  margin-left: auto;\n  margin-right: auto;\n}\n</style>\n</head>\n<body>\n\n<table>\n"
_HTML_FOOT = " <tfoot>\n  <tf>\n  </tf>\n <tfoot>\n</table>\n</body>\n</html>\n"


@dataclass(frozen=True)
class Form:
    """How a table becomes text: a row of columns, the head of names, what joins rows and what ends a table."""

    row: Callable[[list[str]], Column]
    head: Callable[[tuple[str, ...]], str]
    between: str = "\n"
    foot: str = "\n\n"


def _quoted(c: Column) -> Column:
    text = F.coalesce(c, F.lit(""))
    return F.when(text.rlike('[",\r\n]'), F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(text)


def _escaped(c: Column) -> Column:
    text = F.coalesce(c, F.lit(""))
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(a), F.lit(b))
    return text


def _plain(sep: str) -> Form:
    return Form(lambda columns: F.concat_ws(sep, *(F.coalesce(c, F.lit("")) for c in columns)), lambda names: sep.join(f" {n} " for n in names) + "\n")


def _html_row(columns: list[str]) -> Column:
    cells = [F.concat(F.lit("    <td>"), _escaped(F.col(c)), F.lit("</td>\n")) for c in columns]
    return F.concat(F.lit("  <tr>\n"), *cells, F.lit("  </tr>\n"))


def _html_head(names: tuple[str, ...]) -> str:
    return _HTML_HEAD + " <thead>\n  <tr>\n" + "".join(f"    <th> {n} </th>\n" for n in names) + "  </tr>\n </thead>\n"


#: the forms by their names; a table may be written in any other that is added here
FORMS = {
    "bsv": _plain("|"),
    "csv": Form(lambda columns: F.concat_ws(",", *(_quoted(F.col(c)) for c in columns)), _plain(",").head),
    "tab": _plain("\t"),
    "html": Form(_html_row, _html_head, "", _HTML_FOOT),
}
FORMATS = tuple(FORMS)


def _form(name: str) -> Form:
    if name not in FORMS:
        raise ValueError(f"{name} is none of {tuple(FORMS)}")
    return FORMS[name]


def row(form: str, columns: list[str]) -> Column:
    """One row of a table."""
    return _form(form).row(columns)


def head(form: str, names: tuple[str, ...]) -> str:
    return _form(form).head(names)


def document_tables(rows: DataFrame, form: str, names: tuple[str, ...], columns: list[str], keys: list[str]) -> DataFrame:
    """(keys, content): the whole table of each document, rows in the order of ``sort_key``; an empty line ends a table of text."""
    lines = rows.select(*keys, "sort_key", row(form, columns).alias("line"))
    body = F.transform(F.array_sort(F.collect_list(F.struct("sort_key", "line"))), lambda x: x["line"])
    how = _form(form)
    text = F.concat(F.lit(how.head(names)), F.array_join(body, how.between), F.lit(how.foot))
    return lines.groupBy(*keys).agg(text.alias("content"))
