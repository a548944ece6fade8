"""What one page holds, read in a single pass inside a task: its tables, their rows and cells.

Small helpers on one page's text; the job around them (``html_tables``) deals pages over tasks and does the rest.
In its patterns white space, digits and case are those of ASCII, word bounds those of Unicode, as in Java's regular expressions."""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping
from functools import cached_property
from html.entities import html5

_FLAGS = re.IGNORECASE | re.ASCII | re.DOTALL


def _re(pattern: str) -> re.Pattern:
    return re.compile(pattern.replace(r"\b", r"(?u:\b)"), _FLAGS)


UNSEEN = _re(r"<!--.*?(?:-->|\Z)|<script\b.*?(?:</script\s*>|\Z)|<style\b.*?(?:</style\s*>|\Z)")
TABLE_TAG = _re(r"<(?:table\b|/table\s*>)")
TABLE_OPEN, TABLE_CLOSE, TABLE_EDGE = _re(r"<table\b"), _re(r"</table"), _re(r"</?table\b[^>]*>")
HIDDEN = _re(r"<table\b[^>]*\bstyle\s*=\s*(?:\"[^\"]*display\s*:\s*none|'[^']*display\s*:\s*none|[^\s\"'>]*display:none)")
THEAD_OPEN, THEAD_END = _re(r"<thead\b[^>]*>"), _re(r"</thead\s*>|<tbody\b|<tfoot\b")
ROW_OPEN, CELL, CELL_OPEN, CELL_ATTRS = _re(r"<tr\b[^>]*>"), _re(r"<t[hd]\b"), _re(r"<t[hd]\b[^>]*>"), _re(r"<t[hd]\b([^>]*)>")
TD, TD_OPEN, TH, TH_CELL = _re(r"<td\b"), _re(r"<td\b[^>]*>"), _re(r"<th\b"), _re(r"<th\b[^>]*>.*?(?=<t[hd]\b|$)")
SPAN, ROWSPAN, COLSPAN = (_re(rf"<t[hd]\b[^>]*\b(?:{n})\s*=") for n in ("rowspan|colspan", "rowspan", "colspan"))
ROWS_SPANNED, COLUMNS_SPANNED = (_re(rf"\b{n}\s*=\s*[\"']?\s*(\d+)") for n in ("rowspan", "colspan"))
TAG = re.compile(r"<[^>]*>")
CELL_TAG = _re(r"t[hd]\b")
#: The tags that most rows are made of.
_CELL_TAGS, _END_TAGS = {"td", "th", "TD", "TH"}, {"/td", "/th", "/tr", "/a", "/TD", "/TH", "/TR", "/A"}
#: What holds no text: tags and blanks.
NO_TEXT = re.compile(r"(?:<[^>]*>|[\s\u00a0])*+", re.ASCII)

_REFERENCE = re.compile(r"&(#[xX][0-9a-fA-F]{1,6}|#[0-9]{1,7}|[A-Za-z][A-Za-z0-9]*);")
_OTHER_REFERENCE = re.compile(r"&(?!(?:amp|lt|gt|quot|apos);)(?:#|[A-Za-z])")
# Characters that a page keeps as references until its markup has been read.
_MARKUP = {"&": "&amp;", "<": "&lt;", ">": "&gt;", '"': "&quot;", "'": "&apos;"}
_CELL_MARK = "\u0001"


def _kept(ref: re.Match) -> str:
    name = ref[1]
    if name[0] == "#":
        code = int(name[2:], 16) if name[1] in "xX" else int(name[1:])
        text = "\ufffd" if 0xD800 <= code < 0xE000 or code > 0x10FFFF else chr(code)
    else:
        text = html5.get(name + ";", ref[0])
    return _MARKUP.get(text, text)


def holds(html: str) -> bool:
    """Whether there is text outside tags."""
    return NO_TEXT.match(html).end() < len(html)


def row_texts(row: str, sep: str = "") -> list[str]:
    """Visible text of every cell of a row: references decoded, white space collapsed; tags become ``sep``."""
    if _CELL_MARK in row:
        return _marked_texts(row, sep)
    before, *pieces = row.split("<td>")
    if "<" in before:
        cells = _parted_texts(row, sep)
    else:
        cells = []
        for piece in pieces:  # most cells hold text alone
            if piece.endswith("</td>") and piece.count("<") == 1:
                cells.append(piece[:-5])
            elif (found := _parted_texts("<td>" + piece, sep)) is None:
                cells = None
                break
            else:
                cells += found
    if cells is None:  # a tag that holds a '<', or text that does
        return _marked_texts(row, sep)
    return [" ".join((_decoded(c) if "&" in c else c).split()) for c in cells]


def _parted_texts(row: str, sep: str) -> list[str] | None:
    """The raw text of every cell, other tags replaced by ``sep``; None if a '<' is not closed before the next."""
    cells: list[str] = []
    for part in row.split("<")[1:]:
        tag, closed, text = part.partition(">")
        if not closed:
            return None
        if tag in _CELL_TAGS or tag not in _END_TAGS and CELL_TAG.match(tag):
            cells.append(text)
        elif cells and (sep or text):
            cells[-1] += sep + text
    return cells


def _decoded(text: str) -> str:
    for char, name in reversed(_MARKUP.items()):  # the ampersand last
        text = text.replace(name, char)
    return text


def _marked_texts(row: str, sep: str) -> list[str]:
    """``row_texts`` of any row: cell starts become a marker before the other tags are taken out."""
    text = _decoded(TAG.sub(sep, CELL_OPEN.sub(_CELL_MARK, row)))
    return [c.strip(" ") for c in " ".join(text.split()).split(_CELL_MARK)[1:]]


def _span(attrs: str, pattern: re.Pattern) -> int:
    found = pattern.search(attrs)
    n = int(found[1]) if found and len(found[1]) < 20 else 1
    return max(n, 1) if n < 1 << 31 else 1


def spanned_cells(row: str) -> list[tuple[str, int]]:
    """(text, row span) of the cells, each repeated over the columns it spans (1,000 at most, by the HTML standard)."""
    attrs = CELL_ATTRS.findall(row)
    out = []
    for i, text in enumerate(row_texts(row)):
        about = attrs[i] if i < len(attrs) else ""
        out += [(text, _span(about, ROWS_SPANNED))] * min(_span(about, COLUMNS_SPANNED), 1000)
    return out


def grid(rows: list[str]) -> Iterator[list[str]]:
    """The label of every column after each row: a column still covered by a row span from above keeps its label, the
    others take the row's cells in order."""
    state: list[tuple[str, int]] = []
    for row in map(spanned_cells, rows):
        now, at = [], 0
        for j in range(max(len(state), sum(rem > 0 for _, rem in state) + len(row))):
            if j < len(state) and state[j][1] > 0:
                now.append((state[j][0], state[j][1] - 1))
            else:
                text, span = row[at] if at < len(row) else ("", 1)
                now.append((text, span - 1))
                at += 1
        state = now
        yield [label for label, _ in state]


def owned(page: str | None) -> list[tuple[str, bool]]:
    """(html, shown) of every table in page order: every piece of text between table tags goes to its innermost table.  A
    table is shown if it holds text (nested tables' included) and neither its own nor an outer table's style hides it."""
    if not page:
        return []
    low = page.lower()
    if "<!--" in page or "<script" in low or "<style" in low:
        page = UNSEEN.sub(" ", page)
    page = page.replace("&nbsp;", "\u00a0")
    if "&" in page and _OTHER_REFERENCE.search(page):
        page = _REFERENCE.sub(_kept, page)
    cuts = [m.start() for m in TABLE_TAG.finditer(page)]
    texts: list[list[str]] = []
    shown: list[bool] = []
    open_: list[tuple[int, int, bool]] = []  # (table, pieces with text before it, hidden)
    held = 0
    if not cuts or cuts[0]:
        cuts.insert(0, 0)
    for start, end in zip(cuts, [*cuts[1:], len(page)]):
        piece = page[start:end]
        owner = open_[-1][0] if open_ else -1
        if TABLE_OPEN.match(piece):
            owner = len(texts)
            open_.append((owner, held, bool(HIDDEN.match(piece)) or bool(open_) and open_[-1][2]))
            texts.append([])
            shown.append(False)
        elif TABLE_CLOSE.match(piece):
            owner = -1
            if open_:
                table, before, hidden = open_.pop()
                shown[table] = held > before and not hidden
                owner = open_[-1][0] if open_ else -1
        held += holds(piece)
        if owner >= 0:
            edge = TABLE_EDGE.match(piece)
            texts[owner].append(piece[edge.end():] if edge else piece)
    for table, before, hidden in open_:
        shown[table] = held > before and not hidden
    return [("".join(t), s) for t, s in zip(texts, shown)]


def _rows(html: str) -> list[str]:
    return [r for r in ROW_OPEN.split(html)[1:] if CELL.search(r)]


class Table:
    """One table: ``rows`` that have cells, of which the first ``n_header`` are header rows (those of <thead> that hold
    text, or else the leading rows made of <th> cells only)."""

    def __init__(self, html: str, aliases: Mapping[str, str] | None = None, cell: str | None = None):
        self.html, self.low, self.aliases, self.cell = html, html.lower(), aliases or {}, cell
        rows = _rows(html)
        head = None
        if "<thead" in self.low and (found := THEAD_OPEN.search(html)):
            end = THEAD_END.search(html, found.end())
            head = _rows(html[found.end():end.start() if end else len(html)])
        if head:
            kept = [r for r in head if holds(r)]
            self.rows, self.n_header = kept + rows[len(head):], len(kept)
        else:
            self.rows, self.n_header = rows, next((i for i, r in enumerate(rows) if TD.search(r)), len(rows))

    @cached_property
    def labels(self) -> list[str]:
        """The label of each column, of several header rows the last."""
        if not self.n_header:
            return []
        if "span" in self.low and SPAN.search(self.html):
            return list(grid(self.rows[:self.n_header]))[-1]
        return row_texts(self.rows[self.n_header - 1])

    @cached_property
    def canonical(self) -> list[str]:
        return [self.aliases.get(x, x) for x in self.labels]

    @cached_property
    def body(self) -> list[list[str]]:
        """Cell texts of the body rows, spans laid out."""
        rows = self.rows[self.n_header:]
        if "rowspan" in self.low and any(ROWSPAN.search(r) for r in rows):
            return list(grid(rows))
        spans = "colspan" in self.low
        return [[t for t, _ in spanned_cells(r)] if spans and COLSPAN.search(r) else row_texts(r) for r in rows]

    @cached_property
    def first_row(self) -> list[str] | None:
        return row_texts(self.rows[0], " ") if self.rows else None

    @cached_property
    def data_cells(self) -> list[dict[str, list[str] | str | None]]:
        """The <td> cells of each row behind the first, <th> cells cut out: their texts, and as ``cell`` the html of the one
        below the label ``self.cell`` of the first row (null where the row does not reach it)."""
        at = (self.first_row or []).index(self.cell) + 1
        rows = (TH_CELL.sub("", r) if ("<th" in r or "<T" in r or "<tH" in r) and TH.search(r) else r for r in self.rows[1:])
        return [{"texts": row_texts(r, " "), "cell": tds[at] if at < len(tds := TD_OPEN.split(r, at + 1)) else None} for r in rows]
