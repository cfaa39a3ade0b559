"""T-SQL tokens, batches, and what each batch defines and refers to. Plain Python on one text; never raises on bad SQL."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

TOKEN = re.compile(
    r"""(?P<space>\s+|--[^\n]*)
    |(?P<string>[Nn]?'(?:[^']|'')*'?)
    |(?P<bracket>\[(?:[^\]]|\]\])*\]?)
    |(?P<quoted>"(?:[^"]|"")*"?)
    |(?P<var>@@?[\w#$@]*)
    |(?P<word>[^\W\d][\w$@#]*|\#{1,2}[\w$@#]+)
    |(?P<number>\d[\w.]*)
    |(?P<mark>.)""",
    re.X | re.S,
)
GO = re.compile(r"^[ \t]*GO(?:[ \t]+\d+)?[ \t]*;?[ \t]*\r?$", re.I | re.M)

#: What a CREATE or ALTER word makes, and table hints of the old form without WITH.
OBJECT_KINDS = {"TABLE": "TABLE", "VIEW": "VIEW", "PROC": "PROC", "PROCEDURE": "PROC", "FUNCTION": "FUNC", "TYPE": "TYPE", "SEQUENCE": "SEQUENCE", "TRIGGER": "TRIGGER", "SYNONYM": "SYNONYM"}
HINTS = {"NOLOCK", "READUNCOMMITTED", "UPDLOCK", "HOLDLOCK", "ROWLOCK", "TABLOCK", "TABLOCKX", "READPAST", "PAGLOCK", "XLOCK", "SERIALIZABLE", "NOWAIT"}
STOP_ALIAS = {"ON", "WHERE", "JOIN", "INNER", "LEFT", "RIGHT", "FULL", "CROSS", "OUTER", "GROUP", "ORDER", "HAVING", "UNION", "EXCEPT", "INTERSECT", "SET", "WITH", "OPTION", "USING", "WHEN", "FOR", "VALUES", "SELECT", "INSERT", "UPDATE", "DELETE", "MERGE", "EXEC", "EXECUTE", "GO", "BEGIN", "END", "IF", "ELSE", "RETURN", "OUTPUT", "PIVOT", "UNPIVOT", "TABLESAMPLE", "CREATE", "ALTER", "DECLARE", "APPLY"}


@dataclass
class Token:
    kind: str
    text: str
    at: int
    end: int


@dataclass
class Batch:
    index: int
    text: str
    defines: list[dict] = field(default_factory=list)
    alters: list[dict] = field(default_factory=list)
    refs: list[dict] = field(default_factory=list)
    fk_children: list[dict] = field(default_factory=list)


def blank_comments(text: str) -> str:
    """Block comments, nested ones too, as spaces of the same length; strings and names are left alone."""
    if "/*" not in text:
        return text
    out, at = [], 0
    opener = re.compile(r"/\*|--[^\n]*|'(?:[^']|'')*'?|\[(?:[^\]]|\]\])*\]?|\"(?:[^\"]|\"\")*\"?")
    while m := opener.search(text, at):
        if m[0] != "/*":
            out.append(text[at : m.end()])
            at = m.end()
            continue
        depth, end = 1, m.end()
        while depth and (n := re.compile(r"/\*|\*/").search(text, end)):
            depth += 1 if n[0] == "/*" else -1
            end = n.end()
        end = len(text) if depth else end
        out.append(text[at : m.start()] + re.sub(r"[^\n]", " ", text[m.start() : end]))
        at = end
    return "".join(out) + text[at:]


def tokens_of(text: str) -> list[Token]:
    return [Token(m.lastgroup, m[0], m.start(), m.end()) for m in TOKEN.finditer(text) if m.lastgroup != "space"]


def split_batches(text: str) -> list[str]:
    """Parts between lines that are only GO."""
    clean = blank_comments(text)
    parts, at = [], 0
    for m in GO.finditer(clean):
        parts.append(clean[at : m.start()])
        at = m.end()
    parts.append(clean[at:])
    return [p for p in parts if p.strip()]


def unquote(t: Token) -> str:
    if t.kind == "bracket":
        return t.text[1:-1].replace("]]", "]") if t.text.endswith("]") else t.text[1:]
    if t.kind == "quoted":
        return t.text[1:-1].replace('""', '"')
    return t.text


class Recogniser:
    """One pass over a batch's tokens."""

    def __init__(self, batch: Batch):
        self.batch, self.t = batch, tokens_of(batch.text)
        self.words = [t.text.upper() if t.kind == "word" else "" for t in self.t]

    def word(self, i: int) -> str:
        return self.words[i] if 0 <= i < len(self.words) else ""

    def mark(self, i: int) -> str:
        return self.t[i].text if 0 <= i < len(self.t) and self.t[i].kind == "mark" else ""

    def name(self, i: int) -> tuple[dict | None, int]:
        """A name of up to four parts at i, and the index after it."""
        parts, expect = [], True
        while i < len(self.t):
            t = self.t[i]
            if expect and t.kind in ("word", "bracket", "quoted", "var"):
                parts.append(unquote(t))
                expect = False
            elif t.text == "." and t.kind == "mark":
                if expect:
                    parts.append("")
                expect = True
            else:
                break
            i += 1
            if not expect and self.mark(i) != ".":
                break
        if not parts or expect:
            return None, i
        parts = ["", "", *parts][-3:]
        return {"db": parts[0] or None, "schema": parts[1] or None, "name": parts[2]}, i

    def close(self, i: int) -> int:
        """Index after the parenthesis that closes the one at i."""
        depth = 0
        while i < len(self.t):
            depth += {"(": 1, ")": -1}.get(self.mark(i), 0)
            i += 1
            if not depth:
                break
        return i

    def refer(self, name: dict | None, kind: str | None, relation: str) -> None:
        if name and not name["name"].startswith(("#", "@")):
            self.batch.refs.append(name | {"kind": kind, "relation": relation})

    def define(self, name: dict | None, kind: str, at: int, end: int) -> None:
        if name:
            self.batch.defines.append(name | {"kind": kind, "text": self.batch.text[at:end].strip()})

    def written(self, i: int) -> int:
        """A target: a named table reference as well as one that is written."""
        name, j = self.name(i)
        if name is None or self.mark(j) == "(" and self.word(i) in ("OPENQUERY", "OPENROWSET"):
            return j
        self.refer(name, "TABLE_OR_VIEW", "ReadsFrom")
        self.refer(name, "TABLE", "WritesTo")
        return j

    def skip_top(self, i: int) -> int:
        if self.word(i) == "TOP":
            i = self.close(i + 1) if self.mark(i + 1) == "(" else i + 2
            i += self.word(i) == "PERCENT"
        return i

    def sources(self, i: int) -> int:
        """A list of table sources after FROM, JOIN, APPLY or USING."""
        while i < len(self.t):
            if self.mark(i) == "(":
                return i  # the scan goes into it and finds what it holds
            name, j = self.name(i)
            if name is None:
                return j
            if self.mark(j) == "(":
                if self.word(j + 1) in HINTS:
                    self.refer(name, "TABLE_OR_VIEW", "ReadsFrom")
                j = self.close(j)
            else:
                self.refer(name, "TABLE_OR_VIEW", "ReadsFrom")
            j += self.word(j) == "AS"
            if j < len(self.t) and self.t[j].kind in ("word", "bracket", "quoted") and self.word(j) not in STOP_ALIAS:
                j += 1
            if self.word(j) == "WITH" and self.mark(j + 1) == "(":
                j = self.close(j + 1)
            if self.mark(j) != ",":
                return j
            i = j + 1
        return i

    def table_keys(self, i: int, end: int) -> int:
        """Table-level foreign keys among the items i to end; their number."""
        found, depth, fresh = 0, 0, True
        while i < end:
            m = self.mark(i)
            if depth == 0 and fresh:
                j = i
                if self.word(j) == "CONSTRAINT":
                    _, j = self.name(j + 1)
                if self.word(j) == "FOREIGN" and self.word(j + 1) == "KEY":
                    j += 2
                    j = self.close(j) if self.mark(j) == "(" else j
                    if self.word(j) == "REFERENCES":
                        name, i = self.name(j + 1)
                        self.refer(name, "TABLE", "ForeignKey")
                        found += bool(name)
                        fresh = False
                        continue
            fresh = m == "," and depth == 0
            depth += {"(": 1, ")": -1}.get(m, 0)
            i += 1
        return found

    def create(self, i: int) -> int:
        at, j = self.t[i].at, i + 1
        either = self.word(j) == "OR" and self.word(j + 1) == "ALTER"
        j += 2 * either
        kind = OBJECT_KINDS.get(self.word(j))
        if kind is None:
            return i + 1
        name, j = self.name(j + 1)
        if name is None:
            return j
        end = len(self.batch.text)
        if kind == "TABLE":
            if self.mark(j) == "(":
                stop = self.close(j)
                self.define(name, kind, at, self.t[stop - 1].end)
                if self.table_keys(j + 1, stop - 1):
                    self.batch.fk_children.append(name)
                return stop
            self.define(name, kind, at, end)
            return j
        if kind == "SYNONYM":
            self.define(name, kind, at, end)
            if self.word(j) == "FOR":
                target, j = self.name(j + 1)
                self.refer(target, None, "SynonymFor")
            return j
        if kind == "TYPE" and self.word(j) == "AS" and self.word(j + 1) == "TABLE":
            self.define(name, kind, at, end)
            return self.close(j + 2) if self.mark(j + 2) == "(" else j + 2
        if either:
            return j
        self.define(name, kind, at, end)
        if kind == "TYPE" and self.word(j) == "FROM":
            return self.name(j + 1)[1]
        if kind == "TRIGGER" and self.word(j) == "ON":
            target, j = self.name(j + 1)
            self.refer(target, None, "On")
        return j

    def alter(self, i: int) -> int:
        at, kind = self.t[i].at, OBJECT_KINDS.get(self.word(i + 1))
        if kind is None:
            return i + 1
        name, j = self.name(i + 2)
        if name is None:
            return j
        if kind in ("VIEW", "PROC", "FUNC"):
            self.batch.alters.append(name | {"kind": kind})
            return j
        if kind != "TABLE":
            return j
        if self.word(j) == "WITH" and self.word(j + 1) in ("CHECK", "NOCHECK"):
            j += 2
        if self.word(j) == "ADD":
            depth, stop = 0, j + 1
            while stop < len(self.t) and not (depth == 0 and (self.mark(stop) == ";" or self.word(stop) in ("ALTER", "CREATE", "INSERT", "UPDATE", "DELETE", "SELECT", "EXEC", "MERGE", "DROP") and self.word(stop - 1) != "ON")):
                depth += {"(": 1, ")": -1}.get(self.mark(stop), 0)
                stop += 1
            self.define(name, "TABLE", at, self.t[stop - 1].end)
            if self.table_keys(j + 1, stop):
                self.batch.fk_children.append(name)
            return stop
        return j

    def run(self) -> None:
        i, fetch, trims = 0, False, []
        while i < len(self.t):
            w, before = self.word(i), self.word(i - 1)
            m = self.mark(i)
            if m == "(":
                trims.append(before == "TRIM")
            elif m == ")" and trims:
                trims.pop()
            elif m == ";":
                fetch = False
            if w in ("SELECT", "INSERT", "UPDATE", "DELETE", "MERGE", "EXEC", "BEGIN", "END", "WHILE", "IF"):
                fetch = False
            if w == "FETCH":
                fetch = True
            if w == "CREATE":
                i = self.create(i)
            elif w == "ALTER":
                i = self.alter(i)
            elif w == "FROM" and not fetch and before != "DISTINCT" and not (trims and trims[-1]):
                i = self.sources(i + 1)
            elif w in ("JOIN", "APPLY") or w == "USING" and not self.mark(i + 1) == "(":
                i = self.sources(i + 1)
            elif w == "INSERT":
                j = self.skip_top(i + 1)
                i = self.written(j + (self.word(j) == "INTO"))
            elif w == "UPDATE" and before not in ("ON", "FOR", "AFTER", "OF", ",") and self.word(i + 1) not in ("STATISTICS", "SET") and self.mark(i + 1) not in ("(", ",") and self.mark(i - 1) != ",":
                i = self.written(self.skip_top(i + 1))
            elif w == "DELETE" and before not in ("ON", "FOR", "AFTER", "OF", "THEN") and self.mark(i + 1) != "," and self.mark(i - 1) != ",":
                j = self.skip_top(i + 1)
                i = self.written(j + (self.word(j) == "FROM"))
            elif w == "MERGE":
                j = self.skip_top(i + 1)
                i = self.written(j + (self.word(j) == "INTO"))
            elif w in ("EXEC", "EXECUTE") and self.word(i + 1) != "AS" and before not in ("GRANT", "DENY", "REVOKE", "WITH"):
                j = i + 1
                if j < len(self.t) and self.t[j].kind == "var" and self.mark(j + 1) == "=":
                    j += 2
                if j < len(self.t) and self.t[j].kind in ("word", "bracket", "quoted"):
                    name, j = self.name(j)
                    self.refer(name, "PROC", "Executes")
                i = max(j, i + 1)
            elif w == "INTO" and before != "INSERT" and before != "MERGE":
                i += 1
            else:
                i += 1


def recognise(text: str) -> list[Batch]:
    """Batches of a script after sqlcmd preprocessing."""
    out = []
    for k, part in enumerate(split_batches(text)):
        batch = Batch(k, part)
        Recogniser(batch).run()
        out.append(batch)
    return out
