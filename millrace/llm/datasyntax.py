"""Recursive-descent recognisers for JSON and TOML with panic-mode recovery: all errors as (line, message)."""

from __future__ import annotations

import re

_WS = re.compile(r"[ \t\n\r]*")
_STRING = re.compile(r'"(?:[^"\\\x00-\x1f]|\\(?:["\\/bfnrt]|u[0-9a-fA-F]{4}))*"')
_ATOM = re.compile(r"-?(?:0|[1-9]\d*)(?:\.\d+)?(?:[eE][+-]?\d+)?|true|false|null|NaN|-?Infinity", re.A)
_SYNC = re.compile(r'[,\]}\n]')


class _Json:
    def __init__(self, text: str):
        self.t, self.i, self.errors = text, 0, []

    def fail(self, why: str) -> None:
        self.errors.append((self.t.count("\n", 0, self.i) + 1, why))

    def ws(self) -> str:
        self.i = _WS.match(self.t, self.i).end()
        return self.t[self.i : self.i + 1]

    def sync(self) -> None:
        """Panic mode: on to the next separator, closing bracket or line end."""
        m = _SYNC.search(self.t, self.i)
        self.i = m.start() if m else len(self.t)

    def value(self, depth: int = 0) -> None:
        c = self.ws()
        if depth > 400:
            self.fail("nested too deeply")
            self.i = len(self.t)
        elif c == "{":
            self.members(depth, "}")
        elif c == "[":
            self.members(depth, "]")
        else:
            m = (_STRING if c == '"' else _ATOM).match(self.t, self.i)
            if m:
                self.i = m.end()
                return
            self.fail("unterminated or invalid string" if c == '"' else "expecting value")
            if c == '"':
                self.i += 1
            self.sync()

    def members(self, depth: int, end: str) -> None:
        self.i += 1
        if self.ws() == end:
            self.i += 1
            return
        while True:
            at = self.i
            if end == "}":
                self.ws()
                m = _STRING.match(self.t, self.i)
                if not m:
                    self.fail("expecting property name enclosed in double quotes")
                    self.sync()
                else:
                    self.i = m.end()
                    if self.ws() == ":":
                        self.i += 1
                        self.value(depth + 1)
                    else:
                        self.fail("expecting ':' delimiter")
                        self.sync()
            else:
                self.value(depth + 1)
            c = self.ws()
            if c == ",":
                self.i += 1
            elif c == end:
                self.i += 1
                return
            elif not c:
                self.fail(f"expecting ',' or '{end}' before the end")
                return
            else:
                self.fail(f"expecting ',' or '{end}'")
                if c in "]}":
                    self.i += 1
                    return
                self.i += self.i == at
                self.sync()
                if self.i < len(self.t) and self.t[self.i] == "\n":
                    self.i += 1


def json_errors(text: str) -> list[tuple[int, str]]:
    """All (line, message); empty for a valid JSON text (with the usual NaN and Infinity)."""
    p = _Json(text)
    p.value()
    if not p.errors and p.ws():
        p.fail("extra data")
    return p.errors


_BARE = re.compile(r"[A-Za-z0-9_-]+")
_T_BASIC = re.compile(r'"(?:[^"\\\x00-\x08\x0a-\x1f\x7f]|\\(?:[btnfr"\\]|u[0-9a-fA-F]{4}|U[0-9a-fA-F]{8}))*"')
_T_LITERAL = re.compile(r"'[^'\x00-\x08\x0a-\x1f\x7f]*'")
_T_MBASIC = re.compile(
    r'"""(?:[^"\\\x00-\x08\x0b-\x1f\x7f]|"(?!"")|\\(?:[btnfr"\\]|u[0-9a-fA-F]{4}|U[0-9a-fA-F]{8}|[ \t]*\n[ \t\n]*))*"{3,5}'
)
_T_MLITERAL = re.compile(r"'''(?:[^'\x00-\x08\x0b-\x1f\x7f]|'(?!''))*'{3,5}")
_T_DATE = re.compile(
    r"\d{4}-(?:0[1-9]|1[0-2])-(?:0[1-9]|[12]\d|3[01])(?:[Tt ](?:[01]\d|2[0-3]):[0-5]\d:[0-5]\d(?:\.\d+)?(?:[Zz]|[+-](?:[01]\d|2[0-3]):[0-5]\d)?)?"
    r"|(?:[01]\d|2[0-3]):[0-5]\d:[0-5]\d(?:\.\d+)?", re.A
)
_T_NUMBER = re.compile(
    r"0x[0-9a-fA-F](?:_?[0-9a-fA-F])*|0o[0-7](?:_?[0-7])*|0b[01](?:_?[01])*"
    r"|[+-]?(?:0|[1-9](?:_?\d)*)(?:\.\d(?:_?\d)*)?(?:[eE][+-]?\d(?:_?\d)*)?|[+-]?(?:inf|nan)", re.A
)
_T_GAP = re.compile(r"[ \t]*")
_T_COMMENT = re.compile(r"#[^\n\x00-\x08\x0b-\x1f\x7f]*")


class _Fault(Exception):
    pass


class _Toml:
    """Statements are lines; a fault skips to the next line that can begin a statement."""

    def __init__(self, text: str):
        self.t, self.i, self.errors = text, 0, []
        self.root: dict = {}
        self.table: dict = self.root
        self.closed: set[int] = set()  # ids of tables that cannot be added to: inline ones and arrays
        self.declared: set[int] = set()
        self.dotted: set[int] = set()

    def gap(self) -> str:
        self.i = _T_GAP.match(self.t, self.i).end()
        return self.t[self.i : self.i + 1]

    def lines(self) -> str:
        while True:
            c = self.gap()
            if c == "#":
                self.i = _T_COMMENT.match(self.t, self.i).end()
                c = self.t[self.i : self.i + 1]
                if c and c != "\n":
                    raise _Fault("illegal character in comment")
            if c != "\n":
                return c
            self.i += 1

    def key(self) -> list[str]:
        parts = []
        while True:
            c = self.gap()
            m = _T_BASIC.match(self.t, self.i) if c == '"' else _T_LITERAL.match(self.t, self.i) if c == "'" else _BARE.match(self.t, self.i)
            if not m:
                raise _Fault("invalid key")
            parts.append(m[0][1:-1] if c and c in "\"'" else m[0])
            self.i = m.end()
            if self.gap() != ".":
                return parts
            self.i += 1

    def value(self, depth: int = 0):
        c = self.gap()
        t, i = self.t, self.i
        if depth > 200:
            raise _Fault("nested too deeply")
        if c == "[":
            self.i += 1
            out: list = []
            while True:
                if self.lines() == "]":
                    self.i += 1
                    self.closed.add(id(out))
                    return out
                out.append(self.value(depth + 1))
                c = self.lines()
                if c == ",":
                    self.i += 1
                elif c != "]":
                    raise _Fault("unclosed array")
        if c == "{":
            self.i += 1
            table: dict = {}
            if self.gap() == "}":
                self.i += 1
            else:
                while True:
                    self.pair(table, depth + 1)
                    c = self.gap()
                    self.i += 1
                    if c == "}":
                        break
                    if c != ",":
                        raise _Fault("unclosed inline table")
            self.closed.add(id(table))
            return table
        if c == '"':
            m = _T_MBASIC.match(t, i) if t.startswith('"""', i) else _T_BASIC.match(t, i)
        elif c == "'":
            m = _T_MLITERAL.match(t, i) if t.startswith("'''", i) else _T_LITERAL.match(t, i)
        elif t.startswith("true", i) or t.startswith("false", i):
            self.i += 4 if t[i] == "t" else 5
            return True
        else:
            m = _T_DATE.match(t, i) or _T_NUMBER.match(t, i)
        if not m:
            raise _Fault("unterminated or invalid string" if c and c in "\"'" else "invalid value")
        self.i = m.end()
        return m[0]

    def pair(self, into: dict, depth: int = 0) -> None:
        parts = self.key()
        if self.gap() != "=":
            raise _Fault("expected '=' after a key in a key/value pair")
        self.i += 1
        v = self.value(depth)
        for p in parts[:-1]:
            nxt = into.get(p)
            if nxt is None:
                nxt = into[p] = {}
                self.dotted.add(id(nxt))
            elif not isinstance(nxt, dict) or id(nxt) in self.closed or id(nxt) in self.declared:
                raise _Fault("cannot redefine a key")
            into = nxt
        if parts[-1] in into:
            raise _Fault("cannot overwrite a value")
        into[parts[-1]] = v

    def header(self) -> None:
        many = self.t.startswith("[[", self.i)
        self.i += 1 + many
        parts = self.key()
        if not self.t.startswith("]]" if many else "]", self.i):
            raise _Fault("expected ']' at the end of a table declaration")
        self.i += 1 + many
        into = self.root
        for p in parts[:-1]:
            nxt = into.setdefault(p, {})
            if isinstance(nxt, list) and id(nxt) not in self.closed:
                nxt = nxt[-1]
            if not isinstance(nxt, dict) or id(nxt) in self.closed:
                raise _Fault("cannot extend a value that is no table")
            into = nxt
        last = parts[-1]
        if many:
            rows = into.setdefault(last, [])
            if not isinstance(rows, list) or id(rows) in self.closed:
                raise _Fault("cannot extend a value that is no array of tables")
            rows.append({})
            self.table = rows[-1]
        else:
            own = into.setdefault(last, {})
            if not isinstance(own, dict) or id(own) in self.closed or id(own) in self.declared or id(own) in self.dotted:
                raise _Fault("cannot declare a table twice")
            self.declared.add(id(own))
            self.table = own

    def run(self) -> None:
        while True:
            start = self.i
            try:
                c = self.lines()
                if not c:
                    return
                start = self.i
                self.header() if c == "[" else self.pair(self.table)
                c = self.gap()
                if c == "#":
                    self.i = _T_COMMENT.match(self.t, self.i).end()
                    c = self.t[self.i : self.i + 1]
                if c and c != "\n":
                    raise _Fault("expected newline or end of document after a statement")
            except _Fault as e:
                self.errors.append((self.t.count("\n", 0, min(self.i, len(self.t))) + 1, str(e)))
                at = self.t.find("\n", start)
                if at < 0:
                    return
                self.i = at + 1


def toml_errors(text: str) -> list[tuple[int, str]]:
    """All (line, message); empty for a valid TOML 1.0 text."""
    p = _Toml(text.replace("\r\n", "\n"))
    p.run()
    return p.errors
