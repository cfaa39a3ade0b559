"""C# tokens and a brace-structured recogniser: types, members, invocations and string literals of one file.

Plain Python on one text. It keeps going on code it doesn't understand: an unknown construct is skipped to its end.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

TYPES = {"class", "struct", "record", "interface", "enum"}
MODIFIERS = {"public", "private", "protected", "internal", "static", "abstract", "sealed", "partial", "readonly", "virtual", "override", "async", "extern", "unsafe", "new", "const", "volatile", "required", "file", "ref"}
#: Words before "(" that make no call, and words after which an identifier starts an expression.
NO_CALL = {"if", "while", "for", "foreach", "switch", "catch", "using", "lock", "return", "typeof", "sizeof", "default", "checked", "unchecked", "when", "fixed", "is", "as", "in", "and", "or", "not", "await", "throw", "case", "yield", "base", "this", "stackalloc", "delegate", "where", "operator", "new", "out", "else", "do"}
LEADS = {"return", "await", "throw", "in", "else", "case", "when", "is", "as", "out", "ref", "do", "and", "or", "not", "yield", "select", "where", "from", "let", "on", "equals", "by", "into", "group", "orderby", "join"}
SIMPLE = {"n": "\n", "t": "\t", "r": "\r", "0": "\0", "a": "\a", "b": "\b", "f": "\f", "v": "\v", "e": "\x1b"}

START = re.compile(
    r"""(?P<space>\s+)|(?P<doc>///[^\n]*)|(?P<line>//[^\n]*)|(?P<block>/\*.*?(?:\*/|\Z))
    |(?P<directive>\#[^\n]*)
    |(?P<raw>\$*\"{3,})|(?P<verb>(?:@\$|\$@)\"|@\"|\$\")|(?P<str>\")
    |(?P<char>'(?:\\.[^']*|[^'\\\n])')
    |(?P<id>@?[^\W\d]\w*)|(?P<num>\d[\w.]*)
    |(?P<op>=>|\?\.|::|&&|\|\||\?\?|[-+*/%&|^<>=!]=|\+\+|--|->|.)""",
    re.X | re.S,
)


@dataclass
class Token:
    kind: str  # id, str, istr, char, num, op
    text: str
    at: int
    end: int
    line: int
    value: str | None = None


@dataclass
class File:
    classes: list[dict] = field(default_factory=list)
    members: list[dict] = field(default_factory=list)
    invocations: list[dict] = field(default_factory=list)
    literals: list[dict] = field(default_factory=list)


def unescape(text: str) -> str:
    def one(m):
        c = m[1]
        if c[0] in "uUx" and len(c) > 1:
            return chr(min(int(c[1:], 16), 0x10FFFF))
        return SIMPLE.get(c, c)

    return re.sub(r"\\(u[0-9a-fA-F]{4}|U[0-9a-fA-F]{8}|x[0-9a-fA-F]{1,4}|.)", one, text, flags=re.S)


def raw_value(body: str) -> str:
    """A raw literal's text: a multi-line one loses its first and last line break and the closing line's indent."""
    if "\n" not in body:
        return body
    lines = body.replace("\r\n", "\n").split("\n")
    indent = lines[-1]
    return "\n".join(x[len(indent) :] if x.startswith(indent) else x.lstrip() for x in lines[1:-1])


class Lexer:
    def __init__(self, text: str):
        self.text, self.tokens, self.docs = text, [], []
        self.line_at = [0, *(m.end() for m in re.finditer("\n", text))]
        self.lex(0, len(text))

    def line(self, at: int) -> int:
        import bisect

        return bisect.bisect_right(self.line_at, at)

    def add(self, kind, at, end, value=None):
        self.tokens.append(Token(kind, self.text[at:end], at, end, self.line(at), value))

    def lex(self, at: int, stop: int, hole: bool = False) -> int:
        depth, live = 0, []
        while at < stop:
            m = START.match(self.text, at, stop)
            kind, end = m.lastgroup, m.end()
            if kind == "directive":
                end = self.directive(m[0], end, stop, live)
            elif kind == "doc":
                self.docs.append((at, m[0]))
            elif kind == "raw":
                end = self.raw(m[0], at, end, stop)
            elif kind in ("verb", "str"):
                end = self.string(m[0], at, end, stop)
            elif kind in ("id", "num", "char", "op"):
                if hole and kind == "op":
                    if m[0] in "([{":
                        depth += 1
                    elif m[0] in ")]}":
                        if not depth:
                            return at
                        depth -= 1
                    elif m[0] == ":" and not depth:
                        close = self.text.find("}", at)
                        return close if close >= 0 else stop
                self.add(kind, at, end)
            at = end
        return at

    def directive(self, text: str, end: int, stop: int, live: list) -> int:
        """With no symbols defined, an #if part counts only for a negated or true condition; others are skipped."""
        word = re.match(r"#\s*(\w*)\s*(.*)", text)
        name, rest = word[1], word[2].split("//")[0].strip()
        true = rest == "true" or bool(re.fullmatch(r"!\s*\w+", rest)) and rest.lstrip("! ") != "true"
        if name == "if":
            live.append(true)
            if true:
                return end
        elif name in ("elif", "else") and live:
            taken = live[-1]
            live[-1] = taken or name == "else" or true
            if not taken and live[-1]:
                return end
        elif name == "endif":
            if live:
                live.pop()
            return end
        else:
            return end
        nested = 0
        for m in re.compile(r"^[ \t]*#\s*(if|elif|else|endif)\b[^\n]*", re.M).finditer(self.text, end, stop):
            if m[1] == "if":
                nested += 1
            elif nested:
                nested -= m[1] == "endif"
            else:
                return m.start() + m[0].index("#")
        return stop

    def raw(self, opener: str, at: int, end: int, stop: int) -> int:
        quotes = opener.lstrip("$")
        close = self.text.find(quotes, end, stop)
        close = stop if close < 0 else close
        body = self.text[end:close]
        if opener.startswith("$"):
            self.add("istr", at, min(stop, close + len(quotes)))
        else:
            self.add("str", at, min(stop, close + len(quotes)), raw_value(body))
        return min(stop, close + len(quotes))

    def string(self, opener: str, at: int, end: int, stop: int) -> int:
        verbatim, interpolated = "@" in opener, "$" in opener
        place = len(self.tokens)
        if interpolated:
            self.add("istr", at, end)
        i = end
        while i < stop:
            c = self.text[i]
            if c == '"':
                if verbatim and self.text[i + 1 : i + 2] == '"':
                    i += 2
                    continue
                break
            if c == "\\" and not verbatim:
                i += 2
            elif c == "\n" and not verbatim:
                break
            elif c == "{" and interpolated:
                if self.text[i + 1 : i + 2] == "{":
                    i += 2
                else:
                    i = self.lex(i + 1, stop, hole=True) + 1
            else:
                i += 1
        done = min(stop, i + 1)
        if interpolated:
            self.tokens[place].text, self.tokens[place].end = self.text[at:done], done
        else:
            body = self.text[end:i]
            self.add("str", at, done, body.replace('""', '"') if verbatim else unescape(body))
        return done


class Recogniser:
    def __init__(self, text: str):
        self.text = text
        lexer = Lexer(text)
        self.t, self.docs, self.line_of = lexer.tokens, lexer.docs, lexer.line
        self.match: dict[int, int] = {}
        self.out = File()
        stack: list[tuple[str, int]] = []
        for i, t in enumerate(self.t):
            if t.kind == "op" and t.text in "([{":
                stack.append((t.text, i))
            elif t.kind == "op" and t.text in ")]}":
                want = {")": "(", "]": "[", "}": "{"}[t.text]
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] == want:
                        self.match[stack[k][1]] = i
                        del stack[k:]
                        break
        self.declarations(0, len(self.t), "", "", None)
        self.expressions()

    def is_op(self, i: int, text: str) -> bool:
        return 0 <= i < len(self.t) and self.t[i].kind == "op" and self.t[i].text == text

    def is_id(self, i: int) -> bool:
        return 0 <= i < len(self.t) and self.t[i].kind == "id"

    def close(self, i: int, stop: int) -> int:
        return min(self.match.get(i, stop - 1), stop - 1)

    def span(self, i: int, j: int) -> str:
        return self.text[self.t[i].at : self.t[j - 1].end] if i < j else ""

    def angle(self, i: int, stop: int) -> int:
        """Index after a type argument list at i, or i if it is none."""
        depth, j = 0, i
        while j < stop and (depth or self.is_op(j, "<")):
            t = self.t[j]
            if t.kind == "op" and t.text == "<":
                depth += 1
            elif t.kind == "op" and t.text == ">":
                depth -= 1
                if not depth:
                    return j + 1
            elif not (t.kind == "id" or t.kind == "op" and t.text in ".,?[]():*" or t.text == "::"):
                return i
            j += 1
        return i

    def attributes(self, i: int, stop: int) -> tuple[list[dict], int]:
        found = []
        while self.is_op(i, "["):
            end = self.close(i, stop)
            j = i + 1
            if self.is_id(j) and self.is_op(j + 1, ":"):
                j += 2
            while j < end:
                k = j
                while k < end and (self.is_id(k) or self.is_op(k, ".") or self.is_op(k, "::")):
                    k += 1
                name, args = self.span(j, k), []
                if self.is_op(k, "("):
                    last = self.close(k, stop)
                    args = [a["raw"] for a in self.arguments(k, last)]
                    k = last + 1
                if name:
                    found.append({"name": name, "args": args})
                while k < end and not self.is_op(k, ","):
                    k += 1
                j = k + 1
            i = end + 1
        return found, i

    def split(self, i: int, end: int) -> list[tuple[int, int]]:
        """Comma-separated parts of tokens i to end, outside brackets and type arguments."""
        parts, at, j = [], i, i
        while j < end:
            t = self.t[j]
            if t.kind == "op" and t.text in "([{":
                j = self.close(j, end + 1) + 1
                continue
            if t.kind == "op" and t.text == "<" and (after := self.angle(j, end)) > j and (after >= end or self.t[after].kind == "id" or self.t[after].text in "(),.>;{?"):
                j = after
                continue
            if t.kind == "op" and t.text == ",":
                parts.append((at, j))
                at = j + 1
            j += 1
        return [*parts, (at, end)] if at < end else parts

    def arguments(self, i: int, end: int) -> list[dict]:
        """Arguments between the parentheses at i and end."""
        out = []
        for a, b in self.split(i + 1, end):
            raw, name = self.span(a, b), None
            if self.is_id(a) and self.is_op(a + 1, ":"):
                name, a = self.t[a].text, a + 2
            one = self.t[a] if b - a == 1 else None
            text = self.span(a, b)
            out.append({"name": name, "text": text, "raw": raw, "literal": one.value if one and one.kind == "str" else None, "ident": one.text if one and one.kind == "id" else None, "line": self.t[a].line if a < b else self.t[i].line})
        return out

    # Declarations

    def declarations(self, i: int, stop: int, ns: str, block_ns: str, owner: dict | None) -> None:
        while i < stop:
            start = i
            attrs, i = self.attributes(i, stop)
            head = i
            while self.is_id(i) and self.t[i].text in MODIFIERS and not (self.t[i].text == "file" and self.is_op(i + 1, ".")):
                i += 1
            word = self.t[i].text if self.is_id(i) and i < stop else ""
            if word in ("using", "extern") and owner is None or word == "delegate" and self.is_id(i + 1):
                while i < stop and not self.is_op(i, ";"):
                    i = self.close(i, stop) + 1 if self.is_op(i, "{") else i + 1
                i += 1
            elif word == "namespace":
                j = i + 1
                while j < stop and not (self.is_op(j, "{") or self.is_op(j, ";")):
                    j += 1
                name = re.sub(r"\s+", "", self.span(i + 1, j))
                if self.is_op(j, "{"):
                    end = self.close(j, stop)
                    self.declarations(j + 1, end, name, name, None)
                    i = end + 1
                else:
                    ns, block_ns, i = name, "", j + 1
            elif word in TYPES and (self.is_id(i + 1) or word == "record"):
                i = self.type_declaration(start, i, stop, ns, block_ns, attrs)
            elif owner is not None:
                i = max(self.member(start, head, i, stop, owner, attrs), start + 1)
            else:
                i = self.close(i, stop) + 1 if i < stop and self.t[i].text in ("{", "(", "[") else i + 1

    def type_declaration(self, start: int, i: int, stop: int, ns: str, block_ns: str, attrs: list[dict]) -> int:
        kind = self.t[i].text
        j = i + 1
        if kind == "record" and self.is_id(j) and self.t[j].text in ("class", "struct"):
            j += 1
        name = self.t[j].text if self.is_id(j) else ""
        j = self.angle(j + 1, stop)
        if self.is_op(j, "("):
            j = self.close(j, stop) + 1
        bases = []
        if self.is_op(j, ":"):
            k = j + 1
            while k < stop and not (self.is_op(k, "{") or self.is_op(k, ";") or self.is_id(k) and self.t[k].text == "where"):
                k = self.close(k, stop) + 1 if self.is_op(k, "(") else k + 1
            bases = [self.span(a, b) for a, b in self.split(j + 1, k)]
            j = k
        while j < stop and not (self.is_op(j, "{") or self.is_op(j, ";")):
            j += 1
        end = self.close(j, stop) if self.is_op(j, "{") else j
        end = min(end, stop - 1)
        info = {"ord": len(self.out.classes), "kind": kind, "name": name, "ns": ns, "ns_block": block_ns, "bases": bases, "attrs": attrs, "start": self.t[start].line, "end": self.line_of(self.t[end].end - 1), "text": self.span(start, end + 1), "_at": (j, end)}
        self.out.classes.append(info)
        if kind != "enum" and self.is_op(j, "{"):
            self.declarations(j + 1, end, ns, block_ns, info)
        return end + 2 if self.is_op(end + 1, ";") else end + 1

    def member(self, start: int, head: int, i: int, stop: int, owner: dict, attrs: list[dict]) -> int:
        """One member of a type; the index after it."""
        j, paren = i, None
        words = set()
        while j < stop:
            t = self.t[j]
            if t.kind == "op" and t.text == "(":
                if self.is_op(j - 1, ">") or self.is_id(j - 1) and self.t[j - 1].text not in MODIFIERS or "operator" in words:
                    paren = j if paren is None else paren
                j = self.close(j, stop) + 1
                if paren is None:
                    continue
                if self.is_op(j, "(") or self.is_id(j) and self.t[j].text not in ("where",) and "operator" not in words and not self.is_op(j, ":"):
                    paren = None  # a tuple type before the name
                continue
            if t.kind == "op" and t.text == "[":
                j = self.close(j, stop) + 1
                continue
            if t.kind == "op" and t.text == "<" and "operator" not in words and (after := self.angle(j, stop)) > j:
                j = after
                continue
            if t.kind == "op" and (t.text in ("{", ";", "=>") or t.text == "=" and "operator" not in words):
                break
            if t.kind == "op" and t.text == ":" and paren is not None:
                while j < stop and not (self.is_op(j, "{") or self.is_op(j, ";") or self.is_op(j, "=>")):
                    j = self.close(j, stop) + 1 if self.is_op(j, "(") else j + 1
                break
            if t.kind == "id":
                words.add(t.text)
            j += 1
        body, end = j, j
        if self.is_op(j, "{"):
            end = self.close(j, stop)
            if paren is None and self.is_op(end + 1, "="):
                while end < stop and not self.is_op(end, ";"):
                    end = self.close(end, stop) + 1 if self.t[end].text in ("(", "{", "[") and end != j else end + 1
        else:
            while end < stop and not self.is_op(end, ";"):
                end = self.close(end, stop) + 1 if self.t[end].kind == "op" and self.t[end].text in "([{" else end + 1
        end = min(end, stop - 1)
        before = [k for k in range(head, (paren if paren is not None else body)) if self.t[k].kind != "op" or self.t[k].text not in ","]
        name, kind, type_text = "", "field", ""
        if "event" in words or "implicit" in words or "explicit" in words:
            kind = "event" if "event" in words else "conversion"
        elif self.is_op(i, "~"):
            kind, name = "destructor", self.t[i + 1].text if self.is_id(i + 1) else ""
        elif "this" in words and paren is None and self.is_op(body, "{") | self.is_op(body, "=>"):
            kind = "indexer"
        elif "operator" in words:
            kind, name = "operator", self.span(next(k for k in range(i, stop) if self.t[k].text == "operator") + 1, paren or body).strip()
        elif paren is not None:
            k = paren - 1
            while k > i and self.t[k].kind == "op" and self.t[k].text != ".":
                if self.t[k].text == ">":
                    depth = 0
                    while k > i:
                        depth += {">": 1, "<": -1}.get(self.t[k].text, 0)
                        k -= 1
                        if not depth:
                            break
                    break
                k -= 1
            name = self.t[k].text if self.is_id(k) else ""
            kind = "ctor" if k == i and name == owner["name"] else "method"
            type_text = self.span(i, k)
        elif before:
            k = before[-1]
            name = self.t[k].text
            type_text = self.span(i, k)
            kind = "property" if self.is_op(body, "{") or self.is_op(body, "=>") else "field"
        # What comes before on lines of its own is the member's, and what follows on its last line.
        lead = self.t[start - 1].end if start else 0
        line_end = self.text.find("\n", lead, self.t[start].at)
        opens = (line_end + 1 if line_end >= 0 else self.t[start].at) if start else 0
        follows = self.t[end + 1].at if end + 1 < len(self.t) else len(self.text)
        line_end = self.text.find("\n", self.t[end].end, follows)
        closes = line_end + 1 if line_end >= 0 else follows
        docs = [d for at, d in self.docs if lead <= at < self.t[start].at]
        params = len(self.split(paren + 1, self.close(paren, stop))) if paren is not None else 0
        accessors = bool(kind == "property" and self.is_op(body, "{"))
        self.out.members.append({
            "ord": len(self.out.members), "kind": kind, "name": name, "class_ord": owner["ord"], "class": owner["name"], "class_kind": owner["kind"], "ns": owner["ns"], "ns_block": owner["ns_block"], "type_text": type_text.strip(), "params": params, "param_text": self.span(paren + 1, self.close(paren, stop)) if paren is not None else "",
            "start_line": self.t[start].line, "end_line": self.line_of(self.t[end].end - 1), "doc": "".join(docs), "text": self.span(start, end + 1), "full_text": self.text[opens:closes], "accessors": accessors, "_at": (body, end),
        })
        return end + 1

    # Expressions

    def expressions(self) -> None:
        owner = [-1] * (len(self.t) + 1)
        for m in self.out.members:
            for k in range(m["_at"][0], m["_at"][1] + 1):
                owner[k] = m["ord"]
        holder = [-1] * (len(self.t) + 1)
        for c in self.out.classes:
            for k in range(c["_at"][0], c["_at"][1] + 1):
                holder[k] = c["ord"]
        for i, t in enumerate(self.t):
            if t.kind == "str":
                named = self.is_op(i - 1, "=") and self.is_id(i - 2)
                self.out.literals.append({"ord": len(self.out.literals), "value": t.value, "line": t.line, "decl_name": self.t[i - 2].text if named else None, "member_ord": owner[i]})
            elif t.kind == "op" and t.text == "(" and i:
                self.call(i, owner[i], holder[i])

    def back_angle(self, k: int) -> int:
        """Index of the "<" whose list ends at k, or -1."""
        depth = 0
        for j in range(k, max(-1, k - 60), -1):
            text = self.t[j].text if self.t[j].kind == "op" else ""
            depth += {">": 1, "<": -1}.get(text, 0)
            if not depth:
                return j
            if text in ("(", ";", "{"):
                break
        return -1

    def call(self, i: int, member: int, holder: int) -> None:
        k, targ = i - 1, None
        if self.is_op(k, ">"):
            j = self.back_angle(k)
            if j <= 0:
                return
            targ, k = self.span(j + 1, k), j - 1
        if not self.is_id(k) or self.t[k].text in NO_CALL:
            return
        back = {v: o for o, v in self.match.items()} if not hasattr(self, "_back") else self._back
        self._back = back
        names = [(self.t[k].text, targ)]
        first, nested, j = k, False, k - 1
        while j > 0 and self.t[j].kind == "op" and self.t[j].text in (".", "?.", "!", "?"):
            j -= 1
            while j > 0 and self.t[j].kind == "op" and self.t[j].text in ("!", "?", ".", "?."):
                j -= 1
            if self.is_id(j):
                if not nested:
                    names.insert(0, (self.t[j].text, None))
                first, j = j, j - 1
            elif self.is_op(j, ">") and (a := self.back_angle(j)) > 0 and self.is_id(a - 1):
                if not nested:
                    names.insert(0, (self.t[a - 1].text, None))
                first, j = a - 1, a - 2
            elif self.t[j].kind == "op" and self.t[j].text in ")]" and j in back:
                nested, first = True, back[j]
                j = first - 1
                if self.is_op(j, ">") and (a := self.back_angle(j)) > 0:
                    j = a - 1
                if self.is_id(j) and self.t[j].text not in LEADS:
                    first, j = j, j - 1
            elif self.t[j].kind in ("str", "istr", "num", "char"):
                first, j = j, j - 1
            else:
                break
        before = self.t[first - 1] if first else None
        if before is not None and before.kind == "id" and before.text == "new":
            if not nested:
                return
            first -= 1
            before = self.t[first - 1] if first else None
        if before is not None and (before.kind == "id" and before.text not in LEADS or before.kind == "op" and before.text in (">", "]") and first == k and not self.is_op(first - 1, "=>")) and first == k:
            if not (before.kind == "op" and before.text == "]" and self.is_op(first - 1, ".")):
                return  # a declaration: a type stands before the name
        if member < 0 and (holder >= 0 or before is not None and before.text in ("[", ",")):
            return  # an attribute or a member's own parameter list
        end = self.close(i, len(self.t))
        self.out.invocations.append({
            "ord": len(self.out.invocations), "call_text": self.span(first, i), "name": self.t[k].text, "targ": targ, "chain": [n for n, _ in names], "raw": self.span(first, end + 1), "line": self.t[first].line, "member_ord": member, "class_ord": holder, "at": self.t[i].at, "first_at": self.t[first].at,
            "end_at": self.t[end].end, "args": [{x: a[x] for x in ("name", "text", "literal", "ident", "line")} for a in self.arguments(i, end)],
        })


def recognise(text: str) -> File:
    out = Recogniser(text.lstrip("﻿")).out
    for rows in (out.classes, out.members):
        for r in rows:
            r.pop("_at", None)
    return out
