"""HTML pages: simple tags and links by pattern, nested tables by a small parser."""

from __future__ import annotations

import functools
import html.entities
import json
import re
from collections.abc import Callable, Iterator
from html import unescape
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trialweave.functions import lists, text
from trialweave.functions.values import SPACE, keyword_flag, split_ratio, yes_no
from trialweave.operators.columns import learn_names
from trialweave.session import stage

# One element per table row: is it a header, and per cell its own text nodes, all text
# nodes, and the text nodes that are direct children of cells of a nested table.
_TEXTS = T.ArrayType(T.StringType())
TABLE_ROWS = T.ArrayType(T.StructType([
    T.StructField("header", T.BooleanType()),
    T.StructField("cells", T.ArrayType(T.StructType([T.StructField(n, _TEXTS) for n in ("own", "all", "nested")]))),
]))


# Pages that leave a worker at once, and bytes of them whose tags are nested at once.
CHUNK_PAGES, CHUNK_CHARS = 64, 1 << 20

# A plain tag, comment or document type with the text up to the next one, read as the standard library's parser reads it.
_BLANK = r"[ \t\n\r\f]"
_ATTRIBUTE = rf"""{_BLANK}+[A-Za-z_][A-Za-z0-9_:.-]*(?:=(?:"[^"<>]*"|'[^'<>]*'|[^\s"'<>=`/]+(?={_BLANK}|>)))?"""
_START = rf"(?:{_ATTRIBUTE})*{_BLANK}*(/)?"
_DECLARATION = r"!(?:(?i:DOCTYPE)\b[^<>]*|--(?![>-])(?:[^<>-]|-(?![->]))+--)"
_TAG = re.compile(rf"<(?:(/)?([A-Za-z][A-Za-z0-9]*)(?(1){_BLANK}*|{_START})|{_DECLARATION})>([^<]*)")
_RAW_TAGS = frozenset(("script", "style", "title", "textarea", "xmp", "iframe", "noembed", "noframes", "noscript", "plaintext"))
_NO_END = frozenset(("br", "img", "input", "hr", "meta", "link"))

# The same as TABLE_ROWS, as Arrow writes it.
_ARROW_CELL = pa.struct([(n, pa.list_(pa.string())) for n in ("own", "all", "nested")])
_ARROW_ROWS = pa.list_(pa.struct([("header", pa.bool_()), ("cells", pa.list_(_ARROW_CELL))]))


def tag_texts(html: Column, tag: str) -> Column:
    """Text of every element of a tag that has no element inside."""
    return F.regexp_extract_all(html, F.lit(rf"(?is)<{tag}(?:\s[^>]*)?>([^<]*)</{tag}>"), F.lit(1))


def meta_values(html: Column, attribute: str) -> Column:
    """Values of one attribute over all meta elements."""
    return F.regexp_extract_all(html, F.lit(rf'(?is)<meta\b[^>]*\b{attribute}="([^"]*)"'), F.lit(1))


def label_values(html: Column, label_tag: str, value_tag: str) -> Column:
    """Map of labels to the values that directly follow them; markup inside either is cut.

    A label without a value of its own is left out, so the pairs after it stay right. Texts
    are trimmed; of a repeated label the last value counts.
    """
    inside = rf"((?:(?!</?(?:{label_tag}|{value_tag})\b).)*)"
    pair = rf"(?is)<{label_tag}(?:\s[^>]*)?>{inside}(?:</{label_tag}>)?\s*<{value_tag}(?:\s[^>]*)?>{inside}"

    def side(group: int) -> Column:
        found = F.regexp_extract_all(html, F.lit(pair), F.lit(group))
        return F.transform(found, lambda c: text.strip(F.regexp_replace(F.regexp_replace(c, r"<[^>]*>", ""), r"\s+", " ")))

    return lists.pairs_to_map(F.arrays_zip(side(1).alias("key"), side(2).alias("value")))


_REFERENCE = r"&(?:#[0-9]{1,8}|#[xX][0-9a-fA-F]{1,7}|[A-Za-z][A-Za-z0-9]*);"


@functools.cache
def _named_references() -> str:
    """The named character references of HTML and what they stand for, as a JSON object."""
    return json.dumps({n.removesuffix(";"): mark for n, mark in html.entities.html5.items() if n.endswith(";")})


def _control_marks() -> str:
    """Numbers 128 to 159 stand for the marks of the Windows code page, where it has one."""
    marks = {str(i): bytes([i]).decode("cp1252", "ignore") for i in range(128, 160)}
    return json.dumps({i: mark for i, mark in marks.items() if mark})


def decoded(c: Column) -> Column:
    """Character references, named and numeric, as the characters they stand for, each once; unknown ones stay.

    A number that is no character (zero, a surrogate, beyond Unicode) becomes the replacement character.
    """
    table = F.from_json(F.lit(_named_references()), "map<string,string>")
    controls = F.from_json(F.lit(_control_marks()), "map<string,string>")

    def character(reference: Column) -> Column:
        name = F.substr(reference, F.lit(2), F.length(reference) - 2)
        hexadecimal = name.rlike("^#[xX]")
        digits = F.when(hexadecimal, F.substr(name, F.lit(3))).otherwise(F.substr(name, F.lit(2)))
        number = F.conv(F.when(hexadecimal, digits).otherwise(F.conv(digits, 10, 16)), 16, 10).cast("long")
        sound = (number > 0) & (number < 0x110000) & ~number.between(0xD800, 0xDFFF)
        plain = F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")
        numeric = F.when(sound, F.coalesce(F.try_element_at(controls, number.cast("string")), plain)).otherwise("\ufffd")
        return F.when(name.startswith("#"), numeric).otherwise(F.coalesce(F.try_element_at(table, name), reference))

    marks = F.transform(F.regexp_extract_all(c, F.lit(f"({_REFERENCE})"), F.lit(1)), character)
    pieces = F.zip_with(F.split(c, _REFERENCE, -1), F.concat(marks, F.array(F.lit(""))), lambda text, mark: F.concat(text, mark))
    return F.when(c.contains("&"), F.array_join(pieces, "")).otherwise(c)


_HREF = r"""(?is)<a\s(?:[^>]*?\s)?href\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""


def hrefs(html: Column) -> Column:
    """Addresses of all links in page order, in double, single or no quotes, decoded and trimmed."""
    double, single, bare = [F.regexp_extract_all(html, F.lit(_HREF), F.lit(i)) for i in (1, 2, 3)]
    either = F.transform(F.arrays_zip(double.alias("d"), single.alias("s"), bare.alias("b")), lambda x: F.concat(x["d"], x["s"], x["b"]))
    return F.transform(either, lambda c: text.strip(decoded(c)))


def links(df: DataFrame, html: str, url: str, out: str = "link") -> DataFrame:
    """All links of a page with their place, made absolute against the page address."""
    listed = df.select("*", F.posexplode(hrefs(F.col(html))).alias("place", "href"))
    return listed.withColumn(out, absolute(F.col("href"), F.col(url))).drop("href", html)


def without_dots(address: Column) -> Column:
    """Resolve . and .. in the path of an absolute address; .. never leaves the site."""
    site = F.regexp_extract(address, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    path = F.regexp_extract(address, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    rest = F.regexp_extract(address, r"^[^?#]*(.*)$", 1)

    def step(done: Column, part: Column) -> Column:
        up = F.when(F.size(done) > 1, F.slice(done, F.lit(1), F.size(done) - 1)).otherwise(done)
        return F.when(part == "..", up).when(part == ".", done).otherwise(F.concat(done, F.array(part)))

    # A path that ends in a dot segment names a folder.
    marked = F.regexp_replace(path, r"/(\.\.?)$", "/$1/")
    resolved = F.array_join(F.aggregate(F.split(marked, "/"), F.array().cast("array<string>"), step), "/")
    dotted = (site != "") & path.rlike(r"/\.\.?(/|$)")
    return F.when(dotted, F.concat(site, resolved, rest)).otherwise(address)


def absolute(href: Column, base: Column) -> Column:
    """Relative to absolute: full, protocol-relative, rooted, query, fragment and plain links, dot segments resolved."""
    scheme = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1)
    site = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    page = F.regexp_extract(base, r"^([^?#]*)", 1)
    folder = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*[^?#]*/)", 1)
    # A bare host such as http://h has no folder of its own: its root is meant.
    folder = F.when(F.length(folder) > F.length(site), folder).otherwise(F.concat(site, F.lit("/")))
    return without_dots(
        F.when(href == "", base)
        .when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), href)
        .when(href.startswith("//"), F.concat(scheme, F.lit(":"), href))
        .when(href.startswith("/"), F.concat(site, href))
        .when(href.startswith("?"), F.concat(page, href))
        .when(href.startswith("#"), F.concat(F.regexp_extract(base, r"^([^#]*)", 1), href))
        .otherwise(F.concat(folder, href))
    )


def next_page(html: Column, marker: str) -> Column:
    """Address of the first link whose text holds the marker, else null."""
    pattern = _HREF + r"[^>]*>(?:(?!</a>).)*?" + re.escape(marker)
    found = F.concat(*[F.regexp_extract(html, pattern, i) for i in (1, 2, 3)])
    return F.nullif(text.strip(decoded(found)), F.lit(""))


def page_parser() -> Callable[[pa.Array], pa.Array]:
    """A function from pages to ``TABLE_ROWS`` as Arrow has them, made here so that it travels to the workers by value.

    Pages whose elements are all closed in their order are taken apart together: tags are found by their brackets, told by one pattern,
    and nested by counting, all in arrays. Where a page is not like that its tags and texts pass a parser one by one, cut by the pattern if it
    fits the whole page and by the standard library otherwise. The rows are the same either way.
    """
    arrow_rows, arrow_cell = _ARROW_ROWS, _ARROW_CELL
    tag, raw_tag, no_end = _TAG, _RAW_TAGS, _NO_END

    class _Rows(HTMLParser):
        """Collects table rows; nested tables also report to the cell around them."""

        def __init__(self):
            super().__init__(convert_charrefs=True)
            self.rows: list[dict] = []
            self.open: list[dict] = []  # open rows, innermost last
            self.path: list[str] = []

        def handle_starttag(self, tag, attrs):
            if tag == "tr":
                self._close("tr", until="table")
                row = {"header": False, "cells": [], "in_cell": False}
                self.rows.append(row)
                self.open.append(row)
            elif tag in ("td", "th") and self.open:
                self._close(tag, until="tr")
                row = self.open[-1]
                row["header"] = row["header"] or tag == "th"
                row["cells"].append({"own": [], "all": [], "nested": []})
                row["in_cell"] = True
            if tag not in no_end:
                self.path.append(tag)

        def _close(self, tag: str, until: str):
            """End an element that was left open before its next sibling."""
            for i in range(len(self.path) - 1, -1, -1):
                if self.path[i] == until:
                    return
                if self.path[i] == tag:
                    self.handle_endtag(tag)
                    return

        def handle_endtag(self, tag):
            if tag not in self.path:
                return
            while self.path:
                closed = self.path.pop()
                if closed == "tr" and self.open:
                    self.open.pop()
                elif closed in ("td", "th") and self.open:
                    self.open[-1]["in_cell"] = False
                if closed == tag:
                    return

        def handle_data(self, data):
            if not data.strip():
                return
            direct = bool(self.path) and self.path[-1] in ("td", "th")
            depth = 0
            for row in reversed(self.open):
                if row["in_cell"]:
                    cell = row["cells"][-1]
                    cell["all"].append(data)
                    if direct:
                        cell["nested" if depth else "own"].append(data)
                    depth += 1

    def well_formed(parser, page) -> bool:
        """Hand the tags and texts of a page to the parser; False, and nothing handed over, where the pattern does not fit it all."""
        tags = tag.findall(page)
        if len(tags) != page.count("<"):
            return False
        # What is inside such elements is not markup; they may hold one plain text.
        for i, (end, name, _, text) in enumerate(tags):
            if not end and name.lower() in raw_tag:
                after = tags[i + 1] if i + 1 < len(tags) else ("", "", "", "")
                if "&" in text or after[0] != "/" or after[1].lower() != name.lower():
                    return False
        start, stop, data = parser.handle_starttag, parser.handle_endtag, parser.handle_data
        for end, name, empty, text in tags:
            name = name.lower()
            if end:
                stop(name)
            elif name:
                start(name, ())
                if empty:
                    stop(name)
            if text and not text.isspace():
                data(unescape(text) if "&" in text else text)
        return True

    def parsed(page):
        parser = _Rows()
        if page and not well_formed(parser, page):
            parser.feed(page)
            parser.close()
        return [{"header": r["header"], "cells": r["cells"]} for r in parser.rows]

    # What a tag is: not plain, without effect on nesting, opening, closing. Names of table elements come first.
    ODD, IDLE, OPEN, CLOSE = range(4)
    TABLE, TR, TD, TH = range(4)
    names = {"table": TABLE, "tr": TR, "td": TD, "th": TH}
    known: dict[bytes, tuple[int, int, bool]] = {}

    def told(body: bytes) -> tuple[int, int, bool]:
        """Of what stands between the brackets: what it is, the number of its name and whether its text is no markup."""
        found = tag.fullmatch(f"<{body.decode()}>")
        if not found:
            return ODD, -1, False
        end, name, empty, _ = found.groups()
        name = (name or "").lower()
        if not name or name in no_end:
            return IDLE, -1, False
        number = names.setdefault(name, len(names))
        if empty:
            return ODD if number <= TH or name in raw_tag else IDLE, -1, False
        return (CLOSE if end else OPEN), number, not end and name in raw_tag

    def nested(opens):
        """For tags that close in their order: the opening tag of each closing one, and of each opening one that around it or -1."""
        import numpy as np

        step = np.where(opens, 1, -1)
        level = np.cumsum(step) + ~opens
        order = np.argsort(level.astype(np.int16), kind="stable")
        first, last = order[0::2], order[1::2]
        mate, around = np.full(len(opens), -1), np.full(len(opens), -1)
        mate[last] = first
        if len(first):
            key = level[first] * len(opens) + first
            around[first] = np.where(level[first] > 1, first[np.searchsorted(key, key - len(opens)) - 1], -1)
        return mate, around

    def rows_of(pages):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        def bounds(of, count):
            """Where the items of each of so many owners begin and end, the items being in the order of their owners ``of``."""
            return pa.array(np.append(0, np.cumsum(np.bincount(of, minlength=count))).astype(np.int32))

        n = len(pages)
        pages = pc.fill_null(pages.cast(pa.string()), "")
        ends = np.append(0, np.cumsum(pc.binary_length(pages).to_numpy(zero_copy_only=False), dtype=np.int64))
        size = int(ends[-1])
        whole = b"".join(pages.cast(pa.binary()).to_pylist()) + bytes(8)
        raw = np.frombuffer(whole, np.uint8)[:size]
        # A tag goes from one bracket to the next, its text from there to the next tag or the end of the page.
        signs = np.flatnonzero((raw == 60) | (raw == 62))
        left = np.flatnonzero(raw[signs] == 60)
        at, stop = signs[left], np.append(signs, size)[left + 1]
        page = np.repeat(np.arange(n), np.diff(np.searchsorted(at, ends)))
        after = np.minimum(np.append(at, size)[1:], ends[1:][page])
        cut = stop < after
        begin = np.where(cut, stop + 1, after)
        length = np.where(cut, stop - at - 1, 0)
        # Short tags are told apart by their bytes and length in one number, others one by one.
        short = length <= 7
        eight = np.ndarray(size + 1, "<u8", whole, strides=(1,))[at + 1]
        word = (eight & np.array([(1 << 8 * i) - 1 for i in range(8)], np.uint64)[np.minimum(length, 7)]) << np.uint64(8) | length.astype(np.uint64)
        coded = pa.array(word[short]).dictionary_encode()
        kinds = [told(int(w).to_bytes(8, "little")[1:1 + (int(w) & 255)]) for w in coded.dictionary.to_numpy()]
        kind, name, plain = np.zeros(len(at), np.int8), np.full(len(at), -1), np.zeros(len(at), bool)
        if kinds:
            table, codes = np.array(kinds), coded.indices.to_numpy()
            kind[short], name[short], plain[short] = table[codes, 0], table[codes, 1], table[codes, 2]
        for i in np.flatnonzero(~short):
            body = whole[at[i] + 1:stop[i]]
            if body not in known:
                if len(known) >= 10_000:
                    known.clear()
                known[body] = told(body)
            kind[i], name[i], plain[i] = known[body]
        odd = np.zeros(n, bool)
        odd[page[(kind == ODD) | ~cut]] = True
        sign = np.flatnonzero(raw == 38)
        referred = np.searchsorted(sign, begin) < np.searchsorted(sign, after) if len(sign) else np.zeros(len(at), bool)
        unmarked = np.flatnonzero(plain)
        if len(unmarked):
            then = np.minimum(unmarked + 1, len(at) - 1)
            closed = (then > unmarked) & (page[then] == page[unmarked]) & (kind[then] == CLOSE) & (name[then] == name[unmarked])
            odd[page[unmarked[~closed | referred[unmarked]]]] = True
        # Elements must close in their order, in each page.
        moves = np.flatnonzero((kind >= OPEN) & ~odd[page])
        level, of = np.cumsum(np.where(kind[moves] == OPEN, 1, -1)), page[moves]
        base = np.append(0, level)[np.searchsorted(of, np.arange(n + 1))]
        odd[base[1:] != base[:-1]] = True
        odd[of[(level < base[of]) | (level > base[of] + 10_000)]] = True
        while True:
            moves = moves[~odd[page[moves]]]
            inside, opens = name[moves], kind[moves] == OPEN
            mate, around = nested(opens)
            wrong = np.flatnonzero(~opens)
            wrong = wrong[inside[wrong] != inside[mate[wrong]]]
            if not len(wrong):
                break
            odd[page[moves[wrong]]] = True
        is_row, is_cell = inside == TR, (inside == TD) | (inside == TH)

        def climbed(element, wanted):
            """The element itself or the innermost one around it that is wanted, or -1."""
            done, element = np.append(wanted, True), element.copy()
            todo = np.flatnonzero(~done[element])
            while len(todo):
                element[todo] = around[element[todo]]
                todo = todo[~done[element[todo]]]
            return element

        # A row needs a table between it and the next row around it, a cell needs a row.
        rows, cells = np.flatnonzero(opens & is_row), np.flatnonzero(opens & is_cell)
        row_around, cell_in = climbed(around[rows], inside <= TR), climbed(around[cells], is_row | is_cell)
        odd[page[moves[rows[np.append(is_row, False)[row_around]]]]] = True
        odd[page[moves[cells[~np.append(is_row, False)[cell_in]]]]] = True
        rows, sound = rows[~odd[page[moves[rows]]]], ~odd[page[moves[cells]]]
        cells, row_of, cell_of = cells[sound], np.full(len(moves), -1), np.full(len(moves) + 1, -1)
        row_of[rows] = np.arange(len(rows))
        cell_row = row_of[cell_in[sound]]
        order = np.argsort(cell_row, kind="stable")
        cells, cell_row = cells[order], cell_row[order]
        cell_of[cells] = np.arange(len(cells))
        cell_around = cell_of[climbed(around[cells], is_cell)]
        header = np.zeros(len(rows), bool)
        header[cell_row[inside[cells] == TH]] = True
        # Texts that are not blank, as far as ASCII tells.
        mark = np.ones(256, bool)
        mark[[9, 10, 11, 12, 13, 28, 29, 30, 31, 32]] = False
        marks = np.append(0, np.cumsum(mark[raw], dtype=np.int32))
        texts = np.flatnonzero((marks[after] > marks[begin]) & ~odd[page])
        moved = np.zeros(len(at), np.int8)
        moved[moves] = 1
        last = np.cumsum(moved, dtype=np.int64)[texts] - 1
        top = np.where(np.append(opens, True)[last], last, np.append(around, -1)[np.append(mate, -1)[last]])
        cell, direct = cell_of[climbed(top, is_cell)], np.append(is_cell, False)[top]
        texts, cell, direct = texts[cell >= 0], cell[cell >= 0], direct[cell >= 0]
        first, stop = begin[texts], after[texts]
        taken = np.zeros(size + 1, np.int8)
        taken[first] += 1
        taken[stop] -= 1
        kept = raw[np.cumsum(taken[:size], dtype=np.int8).view(bool)]
        offsets = np.append(0, np.cumsum(stop - first)).astype(np.int32)
        words = pa.StringArray.from_buffers(len(texts), pa.py_buffer(offsets), pa.py_buffer(kept))
        # Character references and blanks beyond ASCII are looked at one by one.
        mark[128:] = False
        marks = np.append(0, np.cumsum(mark[raw], dtype=np.int32)) if (raw >= 128).any() else marks
        doubt = np.flatnonzero(referred[texts] | (marks[stop] == marks[first]))
        if len(doubt):
            clear = [unescape(t) for t in words.take(pa.array(doubt)).to_pylist()]
            swap = np.zeros(len(texts), bool)
            swap[doubt] = True
            words = pc.replace_with_mask(words, pa.array(swap), pa.array(clear, pa.string()))
            cell[doubt[[not t.strip() for t in clear]]] = -1
        # A text belongs to the cell it stands in and to all cells around that one.
        text_at, depth, found = np.flatnonzero(cell >= 0), 0, []
        cell = cell[text_at]
        while len(text_at):
            found.append((cell, text_at, np.full(len(cell), depth)))
            outer = cell_around[cell]
            cell, text_at, depth = outer[outer >= 0], text_at[outer >= 0], depth + 1
        cell, text_at, depth = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, int),) * 3
        order = np.argsort(cell * max(len(words), 1) + text_at, kind="stable")
        cell, text_at, depth = cell[order], text_at[order], depth[order]
        direct = direct[text_at]

        def lists_of(some):
            return pa.ListArray.from_arrays(bounds(cell[some], len(cells)), words.take(pa.array(text_at[some])))

        parts = [lists_of(direct & (depth == 0)), lists_of(slice(None)), lists_of(direct & (depth > 0))]
        row_cells = pa.ListArray.from_arrays(bounds(cell_row, len(rows)), pa.StructArray.from_arrays(parts, fields=list(arrow_cell)))
        page_rows = pa.StructArray.from_arrays([pa.array(header), row_cells], fields=list(arrow_rows.value_type))
        out = pa.ListArray.from_arrays(bounds(page[moves[rows]], n), page_rows)
        others = np.flatnonzero(odd)
        if not len(others):
            return out
        index = np.arange(n)
        index[others] = n + np.arange(len(others))
        singly = pa.array([parsed(p) for p in pages.take(pa.array(others)).to_pylist()], arrow_rows)
        return pa.concat_arrays([out, singly]).take(pa.array(index))

    return rows_of


def over_pages(pages: str, kind: T.DataType, use: Callable[[pa.Array], pa.Array]) -> Column:
    """What ``use`` makes of the rows of pages, in Python workers.

    Few pages are parsed at once, so a worker's memory follows ``CHUNK_PAGES`` and ``CHUNK_CHARS``, not the session's Arrow batches.
    """
    chunk_pages, chunk_chars, rows_of = CHUNK_PAGES, CHUNK_CHARS, page_parser()

    @F.arrow_udf(kind)
    def parse(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        import numpy as np
        import pyarrow.compute as pc

        for column in columns:
            ends, at = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False), dtype=np.int64), 0
            while at < len(column):
                stop = min(len(column), int(np.searchsorted(ends, (ends[at - 1] if at else 0) + chunk_chars)) + 1)
                made = use(rows_of(column[at:stop]))
                for i in range(0, len(made), chunk_pages):
                    yield made[i:i + chunk_pages]
                at = stop

    return parse(pages)


def table_rows(pages: str) -> Column:
    """Rows of all tables of a page; nesting is beyond what a pattern can follow."""
    return over_pages(pages, TABLE_ROWS, lambda rows: rows)


def row_texts(pages: str, first: dict[str, tuple[str, str, str]], every: dict[str, tuple[str, str, str]], pairs: dict[str, str]) -> Column:
    """Texts of a page's rows, by name. A row has a ``code`` in its first cell, a ``label`` in the second and a value in the third.

    ``first`` and ``every`` name the first text and all texts of one part of the third cell (``own``, ``all``, ``nested``) of the rows that a test
    of (``code`` is, ``label`` is, ``code`` contains) a text holds for; null if such a row has no third cell. ``pairs`` gives the own texts of the
    second and third cell of the rows whose code contains a text, as key and value.
    """
    space = SPACE
    text_list = pa.list_(pa.string())
    pair = pa.struct([("key", pa.string()), ("value", pa.string())])

    def texts(pages):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        n, rows = len(pages), pages.flatten()
        page = np.repeat(np.arange(n), np.diff(pages.offsets.to_numpy()))
        bounds, cells = rows.field("cells").offsets.to_numpy(), rows.field("cells").values
        parts = {p: cells.field(p) for p in ("own", "all", "nested")}

        def cell(i, part, at=None):
            at = np.arange(len(rows)) if at is None else at
            place = bounds[at] + i
            return parts[part].take(pa.array(place, mask=place >= bounds[at + 1]))

        def trimmed(column):
            return pc.utf8_trim(column, characters=space)

        def line(column):
            return trimmed(pc.replace_substring_regex(column, pattern="[ \\t\\n\\x0B\\f\\r]+", replacement=" "))

        whole = pc.binary_join(cell(0, "all"), "")
        code, label = line(whole), line(pc.binary_join(cell(1, "all"), ""))

        def where(test, value):
            return np.flatnonzero(pc.fill_null(pc.match_substring(whole, value), False).to_numpy(zero_copy_only=False) if test == "contains" else numbers[test] == values[test].index(value))

        def placed(hits):
            """Rows found for several names one after another, and where those of each name and page begin and end."""
            slot = np.concatenate([i * n + page[at] for i, at in enumerate(hits)])
            return np.concatenate(hits), slot, np.searchsorted(slot, np.arange(len(hits) * n + 1))

        values = {test: sorted({v for t, v, _ in (first | every).values() if t == test}) for test in ("code", "label")}
        numbers = {test: pc.fill_null(pc.index_in(column, value_set=pa.array(values[test], pa.string())), -1).to_numpy() for test, column in (("code", code), ("label", label))}
        out = {}
        for part in parts:
            some = [(name, test, value) for name, (test, value, of) in (first | every).items() if of == part]
            if not some:
                continue
            at, slot, bounds_ = placed([where(test, value) for _, test, value in some])
            found = cell(2, part, at)
            length = pc.fill_null(pc.list_value_length(found), 0).to_numpy(zero_copy_only=False)
            void = np.zeros(len(some) * n, bool)
            void[slot[pc.is_null(found).to_numpy(zero_copy_only=False)]] = True
            items, ends = found.flatten(), np.append(0, np.cumsum(length))[bounds_].astype(np.int32)
            lead = items.take(pa.array(ends[:-1], mask=void | (ends[1:] == ends[:-1])))
            for i, (name, _, _) in enumerate(some):
                here = slice(i * n, i * n + n)
                out[name] = lead[here] if name in first else pa.ListArray.from_arrays(pa.array(ends[i * n:i * n + n + 1]), items, mask=pa.array(void[here]))
        if pairs:
            at, _, ends = placed([where("contains", value) for value in pairs.values()])
            sides = pa.StructArray.from_arrays([trimmed(pc.binary_join(cell(i, "own", at), "")) for i in (1, 2)], fields=list(pair))
            for i, name in enumerate(pairs):
                out[name] = pa.ListArray.from_arrays(pa.array(ends[i * n:i * n + n + 1].astype(np.int32)), sides)
        kinds = [(k, pa.string() if k in first else text_list if k in every else pa.list_(pair)) for k in [*first, *every, *pairs]]
        return pa.StructArray.from_arrays([out[k].cast(t) for k, t in kinds], fields=[pa.field(k, t) for k, t in kinds])

    both = T.ArrayType(T.StructType([T.StructField(k, T.StringType()) for k in ("key", "value")]))
    kind = T.StructType([T.StructField(k, T.StringType() if k in first else _TEXTS if k in every else both) for k in [*first, *every, *pairs]])
    return over_pages(pages, kind, texts)


def older_register(df: DataFrame, html: str, url: str, age_labels: list[str] | None = None, limit: int = 5000) -> DataFrame:
    """Records of the older EU register from its detail pages.

    A page row has a section code, a label and a value. ``age_labels`` name the columns
    ``Age_<label>``; without them one job learns the labels, up to ``limit``, from the
    texts of the rows, which are staged so that no page is parsed twice.
    """
    # Section codes and labels of the register's page.
    first = {
        "eudract_nr": ("code", "A.2", "all"),
        "nct_nr": ("contains", "NCT", "all"),
        "start_date": ("label", "Date of Competent Authority Decision", "all"),
        "end_date": ("label", "Date of the global end of the trial", "all"),
        "Protocol": ("code", "A.4.1", "all"),
        "Sponsor": ("code", "B.1.1", "all"),
        "therapeutic_area": ("code", "E.1.1.2", "all"),
        "Gender_F": ("code", "F.2.1", "own"),
        "Gender_M": ("code", "F.2.2", "own"),
        "status": ("label", "End of Trial Status", "own"),
    }
    every = {name: ("code", section, "nested") for name, section in
             {"title": "A.3", "condition": "E.1.1", "inclusion_crt": "E.3", "exclusion_crt": "E.4"}.items()}
    pairs = {"trial_design": "E.8.", "trial_scope": "E.6.", "trial_phase": "E.7.", "ages": "F.1."}
    rows = df.select(F.col(url).alias("url"), row_texts(html, first, every, pairs).alias("found"))
    if age_labels is None:
        rows = stage(rows, "page-rows")

    def found(name: str) -> Column:
        return F.col("found")[name]

    def labelled(name: str) -> Column:
        # Label and value are paired within their row, so a row without a value does
        # not shift the values of the rows after it.
        known = F.filter(found(name), lambda p: p["key"] != "")
        return lists.pairs_to_map(F.transform(known, lambda p: F.struct(p["key"].alias("key"), yes_no(p["value"]).alias("value"))))

    def as_json_list(name: str) -> Column:
        return F.to_json(F.transform(found(name), text.strip))

    ages = labelled("ages")
    if age_labels is None:
        age_labels = learn_names(rows, F.map_keys(ages), limit)
    return rows.select(
        text.strip(F.array_join(found("title"), "\n")).alias("title"),
        text.strip(found("eudract_nr")).alias("eudract_nr"),
        found("nct_nr").alias("nct_nr"),
        F.to_json(labelled("trial_design")).alias("trial_design"),
        F.to_json(labelled("trial_scope")).alias("trial_scope"),
        F.to_json(labelled("trial_phase")).alias("trial_phase"),
        text.strip(found("start_date")).alias("start_date"),
        found("end_date").alias("end_date"),
        found("Protocol").alias("Protocol"),
        text.strip(found("Sponsor")).alias("Sponsor"),
        found("therapeutic_area").alias("therapeutic_area"),
        as_json_list("condition").alias("condition"),
        *[F.try_element_at(ages, F.lit(a)).alias("Age_" + a.replace(" ", "_")) for a in age_labels],
        yes_no(text.strip(found("Gender_F"))).alias("Gender_F"),
        yes_no(text.strip(found("Gender_M"))).alias("Gender_M"),
        as_json_list("inclusion_crt").alias("inclusion_crt"),
        as_json_list("exclusion_crt").alias("exclusion_crt"),
        found("status").alias("status"),
        "url",
    )


# Columns of the programme table, in page order.
PROGRAMME_FIELDS = ["Nome", "DCI", "decisao", "data_decisao", "detalhes", "n_doentes", "cond_observ"]


def programme_table(df: DataFrame, html: str) -> DataFrame:
    """Early-access programmes from the rows of a published table."""
    rows = df.select(table_rows(html).alias("rows"))

    def cells(row: Column) -> Column:
        own = F.flatten(F.transform(row["cells"], lambda c: c["own"]))
        return F.filter(F.transform(own, text.strip), lambda v: v != "")

    header_row = F.coalesce(F.get(F.filter("rows", lambda r: r["header"]), F.lit(0)), F.get("rows", F.lit(0)))
    table = rows.select(
        cells(header_row).alias("headers"),
        F.explode(F.filter("rows", lambda r: ~r["header"])).alias("row"),
    ).select("headers", cells(F.col("row")).alias("cells")).where(F.size("cells") > 0)
    named = table.select(*[
        c.alias(n) for n, c in lists.zip_fields(F.col("headers"), F.col("cells"), PROGRAMME_FIELDS).items()
    ])
    return programme_fields(named)


def programme_fields(named: DataFrame) -> DataFrame:
    """Flags and patient numbers of programme rows, read from their texts."""
    number, recurring = split_ratio(F.col("n_doentes"))
    observed = F.coalesce(F.col("cond_observ"), F.lit(""))
    # Words of the published table.
    return named.withColumns({
        "PAP_act": observed.contains("PAP ativo"),
        "c_custos": F.when(observed.contains("com custos"), True).when(observed.contains("sem custos"), False),
        "deferimento": keyword_flag(F.col("decisao"), ["indefer"], ["defer"]),
        "n_doentes": number,
        "recurr_n_dtes": recurring,
    })
