"""Web pages by the rules of their layouts, in one pass over each page.

The reader knows the path of open elements, each with its number on the page, so a layout is three patterns over paths:
what opens a section, what names a field, what is a value.  They are matched once for each path, while the page is read;
the reader keeps the section and the field it is in and gathers runs of text by label and value.  What leaves a page is
one row for each field, whose runs are joined and cleaned by column expressions; no row moves between tasks.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from html.parser import HTMLParser

from pyspark.sql import Column, DataFrame, functions as F

from yearloom.functions import text as X

#: Section titles of anchors (fixed values).
ANCHORS = {
    "Intro": "Introduction", "Introduction": "Introduction", "Geo": "Geography", "Geography": "Geography", "People": "People",
    "People and Society": "People and Society", "Govt": "Government", "Government": "Government", "Econ": "Economy", "Economy": "Economy",
    "Comm": "Communications", "Communications": "Communications", "Trans": "Transportation", "Transportation": "Transportation", "Military": "Military",
    "Issues": "Transnational Issues", "Transnational Issues": "Transnational Issues",
}
#: Elements that never hold others, and those that end where the next one of their kind begins.
VOID = {"area", "base", "br", "col", "hr", "img", "input", "link", "meta", "source", "wbr"}
LOOSE = {"li": {"li"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "p": {"p"}, "option": {"option"}}
SHOWN = ("name", "sectiontitle")


class _Runs(HTMLParser):
    """Tells take(path, text) each run of a page in order; a break is a run of a bar.  Runs of a link wait for its end, as
    one with a picture says nothing."""

    def __init__(self, take):
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, str]] = []
        self.take, self.told, self.count = take, False, 0
        self.link: list[tuple[str, str]] | None = None
        self.path, self.closed, self.pictured, self.silent = "/", None, False, 0

    def run(self, text: str) -> None:
        self.told = True
        if self.link is None:
            self.take(self.path, text)
        else:
            self.link.append((self.path, text))

    def pass_on(self) -> None:
        """What an open link has said so far counts."""
        for path, text in self.link or ():
            self.take(path, text)
        self.link = None

    def cut(self, k: int) -> None:
        """Closes the elements from the k-th on."""
        self.silent -= sum(t in ("script", "style") for t, _ in self.open[k:])
        del self.open[k:]
        self.path = "/" + "/".join(x for _, x in self.open)

    def handle_starttag(self, tag, attrs):
        a = {k: (v or "").replace("/", " ") for k, v in attrs}
        if tag == "br":
            self.run("|")
        if tag == "img" and self.link is not None:
            self.pictured = True
        if tag in VOID:
            return
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k][0] in LOOSE.get(tag, ()):
                self.cut(k)
                break
            if self.open[k][0] in ("table", "ul", "ol", "select"):
                break
        if tag in ("p", "div") and self.told and self.closed == tag:
            self.run("|")
        self.count += 1
        ident = f"#{a['id']}" if a.get("id") else ""
        shown = "".join(f"[{k}={a[k]}]" for k in SHOWN if a.get(k)) + ("[rank]" if "rank.html" in a.get("href", "") else "")
        self.open.append((tag, f"{tag}{ident}{''.join('.' + c for c in a.get('class', '').split())}{shown}:{self.count}"))
        self.silent += tag in ("script", "style")
        self.path = "/" + "/".join(x for _, x in self.open)
        if tag == "a":
            self.pass_on()
            self.link, self.pictured = [], False
            if a.get("name"):
                self.run("")
        self.closed = None

    def handle_endtag(self, tag):
        if tag == "a":
            if self.pictured:
                self.link = None
            self.pass_on()
            self.pictured = False
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k][0] == tag:
                self.cut(k)
                break
        self.closed = tag

    def handle_data(self, data):
        if not self.silent:
            self.run(data)
            if data.strip():
                self.closed = None


@dataclass(frozen=True)
class Pages:
    """Patterns over paths.  In each, group 1 is what is asked for: the section's title (or its element's number, and its
    text is the title), the label's number, the value's number."""

    section: str
    label: str
    value: str
    titled: bool = True  # the section's pattern gives the title itself
    sibling: bool = False  # a value stands beside its label, in the same element
    anchors: bool = False  # sections are named by ANCHORS; others open none
    rankings: bool = False  # an element that points to a ranking is no value
    pair: str = " | "  # between values of a field


LAYOUTS = {
    "table": Pages(r"/a[^/]*\[name=([^\]]+)\]", r"/td[^/:]*\.FieldLabel[^/]*:(\d+)", r"/td[^/]*:(\d+)", sibling=True, anchors=True),
    "collapsiblepanel": Pages(
        r"/(?:td[^/]*\.CollapsiblePanelTab[^/]*/(?:.*/)?span\.category:(\d+)|h2[^/:]*\.question[^/]*:(\d+))",
        r"/tr[^/:]*_light[^/]*:(\d+)",
        r"/(?:div|span)\.category(?:_data)?[^/]*:(\d+)(?!.*/(?:div|span)\.category)",
        titled=False,
    ),
    "expandcollapse": Pages(
        r"/h2[^/]*\[sectiontitle=([^\]]+)\]", r"/div#field\.category[^/]*:(\d+)", r"/div[^/]*:(\d+)/span\.category|/(?:div|span)\.category_data[^/]*:(\d+)"
    ),
    "modern": Pages(r"/a\.tabHead[^/]*:(\d+)", r"#field-anchor-[^/]*:(\d+)", r"#field-(?!anchor)[^/]*/(?:.*/)?[^/]*\.category_data[^/]*:(\d+)", titled=False, rankings=True),
}


class _Fields:
    """The fields of one page, as its runs come."""

    def __init__(self, rule: Pages):
        self.rule = rule
        self.patterns = [re.compile(p) for p in (rule.section, rule.label, rule.value)]
        self.parent = re.compile(r"^(.*)/td[^/:]*\.FieldLabel")
        self.beside_key = re.compile(r"/td[^/]*:(\d+)")
        self.marks: dict[str, tuple[str | None, str | None, str | None, str | None]] = {}
        self.at = 0
        self.section = self.field = self.beside = None
        self.since, self.start = -1, -1
        self.titles: dict[str, list[str]] = {}
        self.labels: dict[tuple[str, str | None], tuple[int, list[str]]] = {}
        #: Of each field its values by element, each a list of (whether part of a sub-field, text).
        self.values: dict[str, dict[str, list[tuple[bool, str]]]] = {}
        self.ranks: set[str] = set()
        self.texts: list[str] = []

    def marked(self, path: str) -> tuple[str | None, str | None, str | None, str | None]:
        """Section, label and value of a path, and the element beside which a label's value stands."""
        if path not in self.marks:
            found = [p.search(path) for p in self.patterns]
            section, label, value = (next((g for g in m.groups() if g), None) if m else None for m in found)
            if self.rule.anchors and section is not None:
                section = ANCHORS.get(section)
            parent = self.parent.search(path) if self.rule.sibling else None
            self.marks[path] = section, label, value, parent and parent[1] or None
        return self.marks[path]

    def take(self, path: str, text: str) -> None:
        section, label, value, parent = self.marked(path)
        if section is not None:
            self.section, self.since = section, self.at
            self.titles.setdefault(section, []).append(text)
        if label is not None:
            self.field, self.start = label, self.at
            self.labels.setdefault((label, self.section), (self.at, []))[1].append(text)
        if parent is not None:
            self.beside = parent
        # What stands in a label or opens a section is no value; a section ends the field before it.
        if label is None and self.since < self.start:
            if self.rule.sibling:
                value = None
                if self.beside is not None and path.startswith(self.beside + "/td"):
                    key = self.beside_key.match(path, len(self.beside))
                    value = key[1] if key else ""
            elif section is not None:
                value = None
            if value is not None:
                self.values.setdefault(self.field, {}).setdefault(value, []).append((".subfield" in path, text))
        if self.rule.rankings and value is not None and "[rank]" in path and ".subfield" not in path:
            self.ranks.add(value)
        if text.strip() and text != "|":
            self.texts.append(text)
        self.at += 1

    def rows(self) -> tuple[list[dict], list[str]]:
        """The fields, and the page's texts where no field is sure to say anything."""
        out, sure = [], False
        for (label, section), (place, texts) in self.labels.items():
            values = []
            for key, parts in self.values.get(label, {}).items():
                # Of a part that points to a ranking only its sub-fields count.
                kept = [t for sub, t in parts if sub or key not in self.ranks]
                if kept:
                    values.append(kept)
            out.append({"place": place, "section": section, "title": self.titles.get(section, []), "label": texts, "parts": values})
            sure |= any(map(str.isalnum, "".join(texts))) and any(c.isalnum() for v in values for t in v for c in t)
        return out, [] if sure else self.texts


def _said(texts: Column) -> Column:
    """Runs joined, white space and bars shrunk."""
    return X._piped(F.array_join(texts, " "))


def page_rows(pages: DataFrame, page: str, html: str, layout: str) -> DataFrame:
    """(page, place, category, field, content) of pages in one of LAYOUTS.

    place orders fields as they stand.  A field before any section belongs to General; a page without fields gives one,
    the whole text of the page, however long, and a null page none.  Repeated pages are read each by itself.
    """
    import pyarrow as pa

    rule = LAYOUTS[layout]
    fields = "array<struct<place:int,section:string,title:array<string>,label:array<string>,parts:array<array<string>>>>"
    text = pa.string()
    members = [("place", pa.int32()), ("section", text), ("title", pa.list_(text)), ("label", pa.list_(text)), ("parts", pa.list_(pa.list_(text)))]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 64):
                batch = whole.slice(start, 64)
                found, texts = [], []
                for source in batch.column(1).to_pylist():
                    one = _Fields(rule)
                    parser = _Runs(one.take)
                    parser.feed(source or "")
                    parser.close()
                    parser.pass_on()
                    rows, rest = one.rows()
                    found.append(rows)
                    texts.append(rest)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.struct(members))), pa.array(texts, pa.list_(text))], names=["page", "fields", "texts"])

    source = pages.select(F.col(page).alias("page"), F.col(html).alias("html"))
    told = source.mapInArrow(read, f"page {source.schema['page'].dataType.simpleString()}, fields {fields}, texts array<string>")

    def said(x: Column) -> Column:
        parts = F.filter(F.transform(x["parts"], _said), lambda t: t != "")
        if rule.sibling:  # the first element beside the label
            content = F.get(parts, F.lit(0))
        else:
            content = F.when(F.size(parts) > 0, F.array_join(parts, rule.pair))
        category = x["section"] if rule.titled else F.trim(F.get(F.split(_said(x["title"]), "::"), F.lit(0)))
        category = F.coalesce(F.nullif(category, F.lit("")), F.lit("General"))
        return F.struct(x["place"].alias("place"), category.alias("category"), F.rtrim(_said(x["label"]), F.lit(": ")).alias("field"), content.alias("content"))

    rows = F.filter(F.transform("fields", said), lambda x: (x["field"] != "") & x["content"].isNotNull())
    plain = X.stripped(F.regexp_replace(F.array_join("texts", "\n"), r"\n\s*\n", "\n"))
    rest = F.struct(F.lit(0).alias("place"), F.lit("Full Content").alias("category"), F.lit("Text").alias("field"), plain.alias("content"))
    rows = X.bound(rows, lambda r: F.when(F.size(r) > 0, r).otherwise(F.filter(F.array(rest), lambda x: x["content"] != "")))
    return told.select("page", F.inline(rows))
