"""Wiki markup to rows of nodes: pages, sections, templates, properties, links, tables and cells.

A recursive grammar, so it runs in Python, Arrow batch by Arrow batch; everything after it is DataFrame work.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import pandas as pd
from pyspark.sql import DataFrame

SCHEMA = "node_id int, parent_id int, kind string, line int, level int, key string, title string, text string, target string, is_external boolean, rowspan int, colspan int"
_COLUMNS = [c.split()[0] for c in SCHEMA.split(", ")]
_SKIPPED = re.compile(r"<!--.*?-->|<ref[^>]*/>|<ref[^>]*>.*?</ref>|<math[^>]*>.*?</math>", re.S)
_SPAN = re.compile(r"\b(row|col)span\s*=\s*[\"']?\s*(\d+)", re.I)
_HEAD = re.compile(r"^(={1,6})\s*(.*?)\s*\1\s*$")


class MarkupError(ValueError):
    """An opened construct is never closed."""


def blank_skipped(source: str) -> str:
    """Comments, references and formulas go; the lines they held stay counted."""
    return _SKIPPED.sub(lambda m: "\n" * m.group().count("\n"), source)


#: What opens and closes nested constructs; compiled once a mark, so plain text between is skipped by the engine.
_NESTED = r"\[\[|\{\{|\{\||\]\]|\}\}|\|\}"


@cache
def _marks(mark: str) -> re.Pattern:
    return re.compile(f"{_NESTED}|{re.escape(mark)}")


@cache
def _pair(opened: str, closed: str) -> re.Pattern:
    return re.compile(f"({re.escape(opened)})|{re.escape(closed)}")


def split_top(body: str, mark: str) -> list[str]:
    """Split at a mark outside of nested links, templates and tables."""
    parts, depth, last, i, found = [], 0, 0, 0, _marks(mark).search
    while m := found(body, i):
        i = m.start()
        two = body[i : i + 2]
        if two in ("[[", "{{", "{|"):
            depth, i = depth + 1, i + 2
        elif two in ("]]", "}}", "|}") and depth:
            depth, i = depth - 1, i + 2
        elif not depth and body.startswith(mark, i):
            parts.append(body[last:i])
            i += len(mark)
            last = i
        else:
            i += 1
    return [*parts, body[last:]]


def closing(source: str, at: int, opened: str, closed: str) -> int:
    """Index after the mark that closes what opens at ``at``."""
    depth = 0
    for m in _pair(opened, closed).finditer(source, at):
        depth += 1 if m[1] else -1
        if not depth:
            return m.end()
    raise MarkupError(f"{opened} at {at} is not closed")


class Parser:
    def __init__(self):
        self.rows: list[dict] = []

    def node(self, parent, kind, line, **fields) -> int:
        self.rows.append(dict.fromkeys(_COLUMNS) | {"node_id": len(self.rows), "parent_id": parent, "kind": kind, "line": line} | fields)
        return len(self.rows) - 1

    def page(self, title: str, source: str) -> list[dict]:
        root = self.node(None, "page", 1, title=title)
        self.inline(root, blank_skipped(source), 1, True)
        return self.rows

    def text(self, parent: int, s: str, line: int) -> None:
        if s.strip():
            self.node(parent, "text", line + len(s) - len(s.lstrip("\n")), text=s.strip())

    def inline(self, parent: int, s: str, line: int, sections: bool = False) -> None:
        home, held, i = parent, 0, 0
        at = lambda k: line + s.count("\n", 0, k)
        starters = (("{{", self.template, "{{", "}}"), ("{|", self.table, "{|", "|}"), ("[[", self.link, "[[", "]]"))
        while i < len(s):
            if sections and s[i] == "=" and (i == 0 or s[i - 1] == "\n"):
                end = s.find("\n", i)
                end = len(s) if end < 0 else end
                if m := _HEAD.match(s[i:end]):
                    self.text(parent, s[held:i], at(held))
                    parent = self.node(home, "section", at(i), level=len(m[1]), title=m[2])
                    i = held = end
                    continue
            for mark, parse, opened, closed in starters:
                if s.startswith(mark, i):
                    end = closing(s, i, opened, closed)
                    self.text(parent, s[held:i], at(held))
                    parse(parent, s[i + 2 : end - 2], at(i))
                    i = held = end
                    break
            else:
                if s[i] == "[" and re.match(r"\[(?:https?|ftp)://", s[i:]) and (end := s.find("]", i)) > 0:
                    self.text(parent, s[held:i], at(held))
                    target, _, label = s[i + 1 : end].partition(" ")
                    self.node(parent, "link", at(i), target=target, text=label or target, is_external=True)
                    i = held = end + 1
                else:
                    i += 1
        self.text(parent, s[held:], at(held))

    def link(self, parent: int, body: str, line: int) -> None:
        parts = split_top(body, "|")
        self.node(parent, "link", line, target=parts[0].strip(), text=parts[-1].strip(), is_external=False)

    def template(self, parent: int, body: str, line: int) -> None:
        parts = split_top(body, "|")
        me = self.node(parent, "template", line, title=" ".join(parts[0].replace("_", " ").split()))
        at, position = line + parts[0].count("\n"), 0
        for p in parts[1:]:
            key, equals, value = p.partition("=")
            if not equals or "[[" in key or "{{" in key:
                position += 1
                key, value = str(position), p
            prop = self.node(me, "property", at, key=key.strip(), text=value.strip())
            self.inline(prop, value, at)
            at += p.count("\n")

    def table(self, parent: int, body: str, line: int) -> None:
        me, row, current = self.node(parent, "table", line), None, line
        for chunk in split_top(body, "\n"):
            t = chunk.strip()
            if t.startswith("|+"):
                self.node(me, "caption", current, text=t[2:].strip())
            elif t.startswith("|-"):
                row = self.node(me, "row", current)
            elif t[:1] in ("|", "!") and t:
                row = self.node(me, "row", current) if row is None else row
                for cell in split_top(t[1:], "||" if t[0] == "|" else "!!"):
                    parts = split_top(cell, "|")
                    attrs, value = (parts[0], "|".join(parts[1:])) if len(parts) > 1 else ("", cell)
                    span = {k.lower(): int(v) for k, v in _SPAN.findall(attrs)}
                    c = self.node(row, "header" if t[0] == "!" else "cell", current, text=value.strip(), rowspan=span.get("row", 1), colspan=span.get("col", 1))
                    self.inline(c, value, current)
            current += chunk.count("\n") + 1


def parse_pages(pages: DataFrame) -> DataFrame:
    """pages (page_id, title, source) -> page_id, error and node columns; a page that doesn't parse is one row with its error."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for page_id, title, source in zip(pdf["page_id"], pdf["title"], pdf["source"]):
                try:
                    out += [{"page_id": page_id, "error": None} | r for r in Parser().page(title, source or "")]
                except MarkupError as e:
                    out.append(dict.fromkeys(_COLUMNS) | {"page_id": page_id, "error": str(e), "kind": "page", "title": title})
            frame = pd.DataFrame(out, columns=["page_id", "error", *_COLUMNS])
            for c in ("node_id", "parent_id", "line", "level", "rowspan", "colspan"):
                frame[c] = frame[c].astype("Int32")
            yield frame

    return pages.select("page_id", "title", "source").mapInPandas(run, "page_id long, error string, " + SCHEMA)
