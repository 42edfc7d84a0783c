"""Entries of RSS and Atom bodies by a pull parser in an Arrow function.

Elements are known by namespace and name, whatever prefix a feed binds, and items are
found at any depth, as feeds nest them. Items (`item` without a namespace) make a body
RSS; else its Atom entries count. Of an entry's children only the first of each name is
read, and of that the text before its first child. Nothing but the fields of the entries
is kept while a body is read; there is no tree. A body that does not parse to its end
gives no entries, but one row with the parser's reason.
"""

from __future__ import annotations

from collections.abc import Iterator
from xml.parsers import expat

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..session import batched

ENTRIES = "ord int, form string, title string, desc string, url string, stamp string, error string"
CHUNK = 1 << 16
MOST = 1 << 21

# Namespaces.
ATOM, CONTENT, DC = "http://www.w3.org/2005/Atom", "http://purl.org/rss/1.0/modules/content/", "http://purl.org/dc/elements/1.1/"


def _atom(name: str) -> str:
    return f"{ATOM}}}{name}"


ITEM, ENTRY, LINK = "item", _atom("entry"), _atom("link")
WANTED = {
    ITEM: {"title", "link", "guid", "description", "pubDate", f"{CONTENT}}}encoded", f"{DC}}}date"},
    ENTRY: {_atom(x) for x in ("title", "content", "summary", "published", "updated")},
}


class _Open:
    """An entry that is being read."""

    def __init__(self, kind: str, depth: int, ord: int):
        self.kind, self.depth, self.ord = kind, depth, ord
        self.texts: dict[str, str] = {}
        self.links: list[tuple[str | None, str | None]] = []

    def row(self) -> tuple:
        t = self.texts.get
        if self.kind == ITEM:
            guid = (t("guid") or "").strip()
            url = (t("link") or "").strip() or (guid if guid.startswith("http") else "")
            return t("title"), t(f"{CONTENT}}}encoded") or t("description"), url, t("pubDate") or t(f"{DC}}}date")
        own = next((href for rel, href in self.links if rel in (None, "alternate")), None)
        url = (own or "").strip() or next((href.strip() for _, href in self.links if href), "")
        return t(_atom("title")), t(_atom("content")) or t(_atom("summary")), url, t(_atom("published")) or t(_atom("updated"))


class FeedReader:
    """Reads one body; `rows` are its entries in document order, RSS items and Atom entries apart."""

    def __init__(self):
        self.parser = p = expat.ParserCreate("utf-8", "}")
        p.buffer_text = True
        p.StartElementHandler, p.EndElementHandler, p.CharacterDataHandler, p.SkippedEntityHandler = self._start, self._end, self._text, self._skipped
        self.depth = 0
        self.open: list[_Open] = []
        self.field: tuple[int, str, list[str]] | None = None  # depth, name and text of the child that is being read
        self.rows: dict[str, list[tuple[int, tuple]]] = {ITEM: [], ENTRY: []}
        self.found = {ITEM: 0, ENTRY: 0}

    def _skipped(self, name, is_parameter):
        raise ValueError(f"undefined entity &{name};")

    def _close_field(self):
        depth, name, said = self.field
        self.open[-1].texts.setdefault(name, "".join(said))
        self.field = None

    def _start(self, name, attributes):
        self.depth += 1
        if self.field:
            self._close_field()  # a child of the child: the text before it is all that counts
        if self.open and self.depth == self.open[-1].depth + 1:
            entry = self.open[-1]
            if name in WANTED[entry.kind] and name not in entry.texts:
                self.field = (self.depth, name, [])
            elif name == LINK and entry.kind == ENTRY:
                entry.links.append((attributes.get("rel"), attributes.get("href")))
        if name in WANTED:
            if self.field:
                self._close_field()
            self.open.append(_Open(name, self.depth, self.found[name]))
            self.found[name] += 1

    def _text(self, data):
        if self.field:
            self.field[2].append(data)

    def _end(self, name):
        if self.field and self.field[0] == self.depth:
            self._close_field()
        if self.open and self.open[-1].depth == self.depth:
            entry = self.open.pop()
            self.rows[entry.kind].append((entry.ord, entry.row()))
        self.depth -= 1

    def read(self, body: str) -> Iterator[tuple[str, int, tuple]]:
        """(form, ord, (title, desc, url, stamp)) of each entry."""
        for at in range(0, len(body), CHUNK):
            self.parser.Parse(body[at : at + CHUNK].encode(), False)
        self.parser.Parse(b"", True)
        kind, form = (ITEM, "rss") if self.rows[ITEM] else (ENTRY, "atom")
        for ord, row in sorted(self.rows[kind], key=lambda x: x[0]):
            yield form, ord, row


def _entries_of(body: str | None) -> Iterator[tuple]:
    """Rows as in ENTRIES."""
    if body is None or not body.strip():
        yield None, None, None, None, None, None, "empty body"
        return
    try:
        rows = list(FeedReader().read(body.lstrip("\ufeff")))
    except (expat.ExpatError, ValueError) as e:
        yield None, None, None, None, None, None, f"{type(e).__name__}: {e}"[:200]
        return
    for form, ord, (title, desc, url, stamp) in rows:
        yield ord, form, title or "", desc or "", url, stamp or "", None
    if not rows:
        yield None, None, None, None, None, None, None


def entries(bodies: DataFrame) -> DataFrame:
    """The key columns and ord, form (rss, atom), title, desc, url, stamp, error; a body without entries gives one row with a null ord.

    Batches of bodies are bounded, and the entries of each body are handed on once they hold MOST characters.
    """
    keys = [c for c in bodies.columns if c != "body"]
    schema = T.StructType([*(bodies.schema[c] for c in keys), *T.StructType.fromDDL(ENTRIES)])
    names = [x.split()[0] for x in ENTRIES.split(", ")]
    types = [f.type for f in to_arrow_schema(T.StructType.fromDDL(ENTRIES))]

    def run(batches):
        for batch in batches:
            own = batch.select(keys)

            def made(at, rows):
                found = [pa.array(c, t) for c, t in zip(zip(*rows), types)]
                return pa.RecordBatch.from_arrays([*(c.take(pa.array(at)) for c in own.columns), *found], names=[*keys, *names])  # noqa: B023

            at, rows, size = [], [], 0
            for i, body in enumerate(batch.column("body")):
                for row in _entries_of(body.as_py()):
                    at.append(i)
                    rows.append(row)
                    size += sum(len(x) for x in row[1:] if x)
                    if size > MOST:
                        yield made(at, rows)
                        at, rows, size = [], [], 0
            if rows:
                yield made(at, rows)

    return batched(bodies.select(*keys, "body"), run, schema)
