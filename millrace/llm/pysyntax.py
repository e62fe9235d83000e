"""Recursive-descent recogniser for Python 3.13 with precedence-climbing expressions and panic-mode recovery.

The text is reduced to *shapes* first: every name, number and string literal becomes one placeholder, comments go
away. A logical line's validity depends on its shape alone, and shapes repeat endlessly in a corpus, so each one is
parsed once per worker and looked up after that; the descent over statements (suites, clauses, decorators) runs for
every file. An error in a line or clause is recorded and parsing goes on at the next synchronising line.
"""

from __future__ import annotations

import re
import unicodedata

STR, BYT, BAD = "\ue000", "\ue001", "\ue002"
KEYWORDS = frozenset(
    "False None True and as assert async await break class continue def del elif else except finally for from global if "
    "import in is lambda nonlocal not or pass raise return try while with yield".split()
)
SOFT = frozenset(("match", "case", "type"))
_START = re.compile(r"#[^\n]*|(?:(?<!\w)([bBrRuUfF]{1,2}))?(\"\"\"|'''|\"|')|[\ue000-\ue002]")
_BODY = {
    '"': re.compile(r'[^"\\\n]*(?:\\.[^"\\\n]*)*"', re.S),
    "'": re.compile(r"[^'\\\n]*(?:\\.[^'\\\n]*)*'", re.S),
    '"""': re.compile(r'[^"\\]*(?:(?:\\.|"(?!""))[^"\\]*)*"""', re.S),
    "'''": re.compile(r"[^'\\]*(?:(?:\\.|'(?!''))[^'\\]*)*'''", re.S),
}
_PREFIXES = frozenset(("r", "u", "b", "f", "br", "rb", "fr", "rf"))
_NAME = re.compile(r"\b(?!(?:%s)\b)[^\W\d]\w*" % "|".join(sorted(KEYWORDS | SOFT)))
_NUMBER = re.compile(
    r"(?<![\w.])(?:0[xX](?:_?[0-9a-fA-F])+|0[bB](?:_?[01])+|0[oO](?:_?[0-7])+"
    r"|(?:\d(?:_?\d)*\.(?:\d(?:_?\d)*)?|\.\d(?:_?\d)*)(?:[eE][+-]?\d(?:_?\d)*)?[jJ]?"
    r"|\d(?:_?\d)*(?:[eE][+-]?\d(?:_?\d)*[jJ]?|[jJ])|0(?:_?0)*|[1-9](?:_?\d)*)(?!\w)"
)
_TOKEN = re.compile(
    r"\s*(\*\*=|//=|>>=|<<=|\.\.\.|->|:=|\*\*|//|>>|<<|<=|>=|==|!=|[-+*/%&|^@]=|[-+*/%&|^~<>()\[\]{}:;,.=@]|\w+|[\ue000-\ue002]|\S)"
)
_ESCAPE = re.compile(r"\\(?:N(\{[^}]*\})?|x([0-9a-fA-F]{2})?|u([0-9a-fA-F]{4})?|U([0-9a-fA-F]{8})?|.)", re.S)
_F_STOP = re.compile(r"[{}\\\n\"']")
_F_EXPR = re.compile(r"[()\[\]{}!:=\"'#<>]|\n")


class SyntaxFault(Exception):
    """Where and why a text is not valid."""


def _bad_escape(body: str, byte: bool) -> str:
    for m in _ESCAPE.finditer(body):
        e = m[0][1:2]
        if e == "x" and not m[2]:
            return "truncated \\x escape"
        if not byte:
            if e == "u" and not m[3] or e == "U" and (not m[4] or int(m[4], 16) > 0x10FFFF):
                return "truncated \\u escape"
            if e == "N":
                try:
                    unicodedata.lookup(m[1][1:-1] if m[1] else "")
                except KeyError:
                    return "unknown Unicode character name"
    return ""


def _f_end(text: str, pos: int, quote: str, raw: bool, depth: int = 0, spec: bool = False) -> int:
    """The place after an f-string (or a format spec, before its brace) that begins at ``pos``; raises SyntaxFault."""
    if depth > 8:
        raise SyntaxFault("f-string: too many nested expressions")
    n = len(text)
    while True:
        m = _F_STOP.search(text, pos)
        if not m:
            raise SyntaxFault("unterminated f-string literal")
        c, pos = m[0], m.end()
        if c == "\\" and not raw:
            e = _ESCAPE.match(text, pos - 1)
            if e and e[0][1:2] in "NxuU" and _bad_escape(e[0], False):
                raise SyntaxFault("bad escape in f-string")
            pos = e.end() if e else pos + 1
        elif c == "\\":
            # in a raw text a backslash still keeps the quote after it
            if text[pos : pos + 1] in "\"'\\" and pos < n:
                pos += 1
        elif c == "\n":
            if len(quote) == 1:
                raise SyntaxFault("unterminated f-string literal")
        elif c in "\"'":
            if text.startswith(quote, pos - 1):
                if spec:
                    raise SyntaxFault("f-string: expecting '}'")
                return pos - 1 + len(quote)
        elif c == "{":
            if not spec and text[pos : pos + 1] == "{":
                pos += 1
            else:
                pos = _f_field(text, pos, quote, raw, depth)
        elif spec:
            return pos - 1
        elif text[pos : pos + 1] == "}":
            pos += 1
        else:
            raise SyntaxFault("f-string: single '}' is not allowed")


def _f_field(text: str, pos: int, quote: str, raw: bool, depth: int) -> int:
    start, stack = pos, 0
    while True:
        m = _F_EXPR.search(text, pos)
        if not m:
            raise SyntaxFault("f-string: expecting '}'")
        c, pos = m[0], m.end()
        if c in "([{":
            stack += 1
        elif c in ")]" or c == "}" and stack:
            stack -= 1
            if stack < 0:
                raise SyntaxFault("f-string: unmatched ')'")
        elif c in "\"'":
            at = q = pos - 1
            while at > start and q - at < 2 and text[at - 1] in "rbfuRBFU":
                at -= 1
            if at > start and (text[at - 1].isalnum() or text[at - 1] == "_"):
                at = q
            _, pos = _literal(text, at, depth + 1)
        elif c == "#":
            raise SyntaxFault("f-string expression part cannot include '#'")
        elif stack == 0 and c in "!:=}":
            if c in "!=" and text[pos : pos + 1] == "=":
                pos += 1
                continue
            if c == "=" and text[pos - 2 : pos - 1] in ("<", ">", "!", "="):
                continue
            break
    expr, at = text[start : pos - 1], pos - 1
    if not expr_ok(expr):
        raise SyntaxFault("f-string: invalid syntax")
    if text[at] == "=":
        at += 1
        while text[at : at + 1].isspace():
            at += 1
    if text[at : at + 1] == "!":
        m = re.compile(r"!\s*[sra]\s*").match(text, at)
        if not m:
            raise SyntaxFault("f-string: invalid conversion character")
        at = m.end()
    if text[at : at + 1] == ":":
        at = _f_end(text, at + 1, quote, raw, depth + 1, True)
    if text[at : at + 1] != "}":
        raise SyntaxFault("f-string: expecting '}'")
    return at + 1


def _literal(text: str, at: int, depth: int = 0) -> tuple[str, int]:
    """Placeholder and end of the string literal at ``at``; raises SyntaxFault if it has no end or is not valid."""
    m = _START.match(text, at)
    if not m or not m[2]:
        raise SyntaxFault("invalid string prefix")
    prefix, quote = (m[1] or "").lower(), m[2]
    if prefix and prefix not in _PREFIXES:
        raise SyntaxFault("invalid string prefix")
    if "f" in prefix:
        return STR, _f_end(text, m.end(), quote, "r" in prefix, depth)
    b = _BODY[quote].match(text, m.end())
    if not b:
        raise SyntaxFault("unterminated triple-quoted string literal" if len(quote) == 3 else "unterminated string literal")
    byte, body = "b" in prefix, b[0]
    if byte and not body.isascii():
        raise SyntaxFault("bytes can only contain ASCII literal characters")
    if "\\" in body and "r" not in prefix and (why := _bad_escape(body, byte)):
        raise SyntaxFault(why)
    return BYT if byte else STR, b.end()


def _shape(text: str, errors: list[tuple[int, str]] | None) -> str:
    """The text with literals, names and numbers as placeholders; faults in literals go to ``errors`` or are raised."""
    out, pos = [], 0
    search = _START.search
    while m := search(text, pos):
        out.append(text[pos : m.start()])
        pos = m.end()
        if m[2]:
            try:
                mark, end = _literal(text, m.start())
            except SyntaxFault as e:
                if errors is None:
                    raise
                errors.append((text.count("\n", 0, m.start()) + 1, str(e)))
                out.append(BAD)
                if len(m[2]) == 3:
                    pos = len(text)
                else:
                    pos = text.find("\n", pos)
                    pos = len(text) if pos < 0 else pos
                continue
            out.append(mark)
            if m[2] and "\n" in text[pos:end]:
                out.append("\x00" * text.count("\n", pos, end))  # keeps the count of lines
            pos = end
        elif m[0][0] != "#":
            out.append(BAD)
    out.append(text[pos:])
    return _NUMBER.sub("0", _NAME.sub("N", "".join(out)))


_EXPR_CACHE: dict[str, bool] = {}


def expr_ok(expr: str) -> bool:
    """Whether a replacement field's expression is valid."""
    key = _NAME.sub("N", expr)
    ok = _EXPR_CACHE.get(key)
    if ok is None:
        try:
            p = _Line(_shape(expr, None).replace("\n", " ").replace("\x00", ""))
            if p.tok == "yield":
                p.yield_expr()
            else:
                p.star_exprs()
            ok = p.tok == ""
        except SyntaxFault:
            ok = False
        if len(_EXPR_CACHE) < 100_000:
            _EXPR_CACHE[key] = ok
    return ok


_BINARY = {"or": 1, "and": 2, "|": 5, "^": 6, "&": 7, "<<": 8, ">>": 8, "+": 9, "-": 9, "*": 10, "/": 10, "//": 10, "%": 10, "@": 10}
_COMPARE = frozenset(("<", ">", "==", ">=", "<=", "!=", "in", "is", "not"))
_AUG = frozenset(("+=", "-=", "*=", "/=", "//=", "%=", "@=", "&=", "|=", "^=", ">>=", "<<=", "**="))
_NAMES = SOFT | {"N"}


class _Line:
    """A parser over one logical line's shape. Expressions return their kind, for the checks of targets."""

    def __init__(self, shape: str):
        self.toks = _TOKEN.findall(shape)
        self.toks.append("")
        self.i, self.tok, self.depth = 0, self.toks[0], 0

    def next(self) -> str:
        t = self.tok
        self.i += 1
        self.tok = self.toks[self.i] if self.i < len(self.toks) else ""
        return t

    def back(self, i: int) -> None:
        self.i, self.tok = i, self.toks[i]

    def want(self, t: str) -> None:
        if self.tok != t:
            raise SyntaxFault(f"expected '{t}'")
        self.next()

    def take(self, t: str) -> bool:
        if self.tok == t:
            self.next()
            return True
        return False

    def name(self) -> None:
        if self.tok not in _NAMES:
            raise SyntaxFault("invalid syntax")
        self.next()

    # expressions

    def star_exprs(self) -> tuple:
        """Comma list with stars."""
        first = self.star_expr()
        if self.tok != ",":
            return first
        items = [first]
        while self.take(","):
            if not self.starts():
                break
            items.append(self.star_expr())
        return ("tuple", items)

    def star_expr(self, named: bool = False) -> tuple:
        if self.take("*"):
            return ("star", [self.binary(5)])
        return self.named() if named else self.expr()

    def starts(self) -> bool:
        t = self.tok
        return t in _NAMES or t in "0([{+-~*" and t != "" or t in (STR, BYT, "...", "not", "lambda", "await", "None", "True", "False")

    def named(self) -> tuple:
        if self.tok in _NAMES and self.toks[self.i + 1] == ":=":
            self.next()
            self.next()
            self.expr()
            return ("op",)
        return self.expr()

    def expr(self) -> tuple:
        self.depth += 1
        if self.depth > 180:
            raise SyntaxFault("too many nested parentheses")
        if self.tok == "lambda":
            self.next()
            self.params(":", False)
            self.want(":")
            self.expr()
            self.depth -= 1
            return ("op",)
        left = self.binary(1)
        if self.tok == "if":
            self.next()
            self.binary(1)
            if not self.take("else"):
                raise SyntaxFault("expected 'else' after 'if' expression")
            self.expr()
            left = ("op",)
        self.depth -= 1
        return left

    def binary(self, least: int) -> tuple:
        """Precedence climbing."""
        t = self.tok
        if t == "not":
            if least > 3:
                raise SyntaxFault("invalid syntax")
            self.next()
            self.binary(3)
            left = ("op",)
        elif t in ("+", "-", "~"):
            self.next()
            self.binary(11)
            left = ("op",)
        else:
            left = self.primary()
            if self.tok == "**":
                self.next()
                self.binary(11)
                left = ("op",)
        while True:
            t = self.tok
            p = _BINARY.get(t)
            if p is None:
                if t not in _COMPARE or least > 4:
                    return left
                if t == "not":
                    if self.toks[self.i + 1] != "in":
                        return left
                    self.next()
                elif t == "is" and self.toks[self.i + 1] == "not":
                    self.next()
                p = 4
            elif p < least:
                return left
            self.next()
            self.binary(p + 1)
            left = ("op",)

    def primary(self) -> tuple:
        waits = self.take("await")
        t = self.tok
        if t in _NAMES:
            self.next()
            left: tuple = ("name",)
        elif t == "0" or t in ("None", "True", "False", "..."):
            self.next()
            left = ("const",)
        elif t == STR or t == BYT:
            while self.tok in (STR, BYT):
                if self.next() != t:
                    raise SyntaxFault("cannot mix bytes and nonbytes literals")
            left = ("const",)
        elif t == "(":
            left = self.paren()
        elif t == "[":
            left = self.bracket()
        elif t == "{":
            left = self.brace()
        else:
            raise SyntaxFault("invalid syntax")
        while True:
            t = self.tok
            if t == ".":
                self.next()
                self.name()
                left = ("attr",)
            elif t == "(":
                self.next()
                self.args()
                left = ("call",)
            elif t == "[":
                self.next()
                self.subscript()
                left = ("sub",)
            else:
                return ("op",) if waits else left

    def comp_for(self) -> bool:
        """The rest of a comprehension, if one begins here."""
        any_ = False
        while self.tok == "for" or self.tok == "async" and self.toks[self.i + 1] == "for":
            any_ = True
            self.take("async")
            self.next()
            self.target_list()
            self.want("in")
            self.binary(1)
            while self.take("if"):
                if self.tok in _NAMES and self.toks[self.i + 1] == ":=":
                    raise SyntaxFault("invalid syntax")
                self.binary(1)
        return any_

    def target_list(self) -> None:
        items, comma = [], False
        while True:
            items.append(("star", [self.binary(5)]) if self.take("*") else self.binary(5))
            if not self.take(","):
                break
            comma = True
            if self.tok in ("in", "=", ""):
                break
        for x in items:
            self.target(x)
        if len(items) == 1 and not comma and items[0][0] == "star":
            raise SyntaxFault("starred assignment target must be in a list or tuple")

    def target(self, x: tuple, kinds: tuple = ("name", "attr", "sub")) -> None:
        if x[0] in kinds:
            return
        if x[0] in ("tuple", "list"):
            for y in x[1]:
                self.target(y[1][0] if y[0] == "star" else y)
            return
        if x[0] == "paren":
            return self.target(x[1][0])
        if x[0] == "star" and len(x[1]) == 1:
            return self.target(x[1][0])
        raise SyntaxFault("cannot assign to expression")

    def paren(self) -> tuple:
        self.next()
        if self.take(")"):
            return ("tuple", [])
        if self.tok == "yield":
            self.yield_expr()
            self.want(")")
            return ("op",)
        first = self.star_expr(True)
        if self.tok in ("for", "async"):
            if first[0] == "star":
                raise SyntaxFault("iterable unpacking cannot be used in comprehension")
            self.comp_for()
            self.want(")")
            return ("op",)
        if self.take(")"):
            if first[0] == "star":
                raise SyntaxFault("cannot use starred expression here")
            return ("paren", [first]) if first[0] in ("name", "attr", "sub", "tuple", "list", "paren") else ("op",)
        items = [first]
        while self.take(","):
            if self.tok == ")":
                break
            items.append(self.star_expr(True))
        if self.tok != ")":
            raise SyntaxFault("invalid syntax. Perhaps you forgot a comma?")
        self.next()
        return ("tuple", items)

    def bracket(self) -> tuple:
        self.next()
        if self.take("]"):
            return ("list", [])
        items = [self.star_expr(True)]
        if self.tok in ("for", "async"):
            if items[0][0] == "star":
                raise SyntaxFault("iterable unpacking cannot be used in comprehension")
            self.comp_for()
            self.want("]")
            return ("op",)
        while self.take(","):
            if self.tok == "]":
                break
            items.append(self.star_expr(True))
        if self.tok != "]":
            raise SyntaxFault("invalid syntax. Perhaps you forgot a comma?")
        self.next()
        return ("list", items)

    def brace(self) -> tuple:
        self.next()
        if self.take("}"):
            return ("op",)
        kind = ""
        while True:
            if self.take("**"):
                this = "dict"
                self.binary(5)
            elif self.tok == "*":
                this = "set"
                self.star_expr()
            else:
                walrus = self.tok in _NAMES and self.toks[self.i + 1] == ":="
                self.named()
                this = "set"
                if not walrus and self.take(":"):
                    this = "dict"
                    self.expr()
                if not kind and self.tok in ("for", "async"):
                    self.comp_for()
                    self.want("}")
                    return ("op",)
            if kind and kind != this:
                raise SyntaxFault("':' expected after dictionary key")
            kind = this
            if self.take(","):
                if self.take("}"):
                    return ("op",)
            elif self.take("}"):
                return ("op",)
            else:
                raise SyntaxFault("invalid syntax. Perhaps you forgot a comma?")

    def args(self) -> None:
        """Call arguments after the opening parenthesis, with the closing one."""
        seen_key = seen_double = False
        count = 0
        bare = False
        while True:
            if self.take(")"):
                if bare and count > 1:
                    raise SyntaxFault("Generator expression must be parenthesized")
                return
            count += 1
            if self.take("**"):
                seen_double = True
                self.expr()
            elif self.take("*"):
                if seen_double:
                    raise SyntaxFault("iterable argument unpacking follows keyword argument unpacking")
                self.expr()
            elif self.tok in _NAMES and self.toks[self.i + 1] == "=":
                self.next()
                self.next()
                self.expr()
                seen_key = True
            else:
                if seen_key or seen_double:
                    raise SyntaxFault("positional argument follows keyword argument")
                self.named()
                if self.tok in ("for", "async"):
                    self.comp_for()
                    bare = True
            if self.tok == ")":
                continue
            if not self.take(","):
                raise SyntaxFault("invalid syntax. Perhaps you forgot a comma?")
            if bare and self.tok == ")":
                raise SyntaxFault("Generator expression must be parenthesized")

    def subscript(self) -> None:
        while True:
            if self.tok == "*":
                self.star_expr()
            else:
                if self.tok != ":":
                    self.named()
                if self.take(":"):
                    if self.tok not in (":", ",", "]"):
                        self.expr()
                    if self.take(":") and self.tok not in (",", "]"):
                        self.expr()
            if self.take("]"):
                return
            self.want(",")
            if self.take("]"):
                return

    def params(self, end: str, typed: bool) -> None:
        default = star = slash = False
        first = True
        while self.tok != end:
            if not first and not self.prev_comma:
                raise SyntaxFault("invalid syntax")
            if self.take("/"):
                if slash or star or first:
                    raise SyntaxFault("invalid syntax")
                slash = True
            elif self.take("**"):
                self.name()
                if typed and self.take(":"):
                    self.expr()
                self.take(",")
                if self.tok != end:
                    raise SyntaxFault("arguments cannot follow var-keyword argument")
                return
            elif self.take("*"):
                if star:
                    raise SyntaxFault("* argument may appear only once")
                star = True
                if self.tok in _NAMES:
                    self.next()
                    if typed and self.take(":"):
                        self.star_expr()
                elif self.tok != "," or self.toks[self.i + 1] in (end, "**"):
                    raise SyntaxFault("named arguments must follow bare *")
            else:
                self.name()
                if typed and self.take(":"):
                    self.expr()
                if self.take("="):
                    self.expr()
                    default = True
                elif default and not star:
                    raise SyntaxFault("parameter without a default follows parameter with a default")
            self.prev_comma = self.take(",")
            first = False

    def type_params(self) -> None:
        if not self.take("["):
            return
        while True:
            if self.take("*") or self.take("**"):
                self.name()
            else:
                self.name()
                if self.take(":"):
                    self.expr()
            if self.take("="):
                self.star_expr()
            if self.take("]"):
                return
            self.want(",")
            if self.take("]"):
                return

    def yield_expr(self) -> None:
        self.next()
        if self.take("from"):
            self.expr()
        elif self.starts():
            self.star_exprs()

    # statements

    def simple_line(self) -> None:
        while True:
            self.simple()
            if not self.take(";"):
                break
            if self.tok == "":
                break
        if self.tok != "":
            raise SyntaxFault("invalid syntax")

    def simple(self) -> None:
        t = self.tok
        if t in ("pass", "break", "continue"):
            self.next()
        elif t == "return":
            self.next()
            if self.starts():
                self.star_exprs()
        elif t == "raise":
            self.next()
            if self.starts():
                self.expr()
                if self.take("from"):
                    self.expr()
        elif t in ("global", "nonlocal"):
            self.next()
            self.name()
            while self.take(","):
                self.name()
        elif t == "del":
            self.next()
            x = self.star_exprs()
            for y in x[1] if x[0] == "tuple" and len(x) > 1 else [x]:
                if y[0] == "star":
                    raise SyntaxFault("cannot delete starred")
                self.target(y)
        elif t == "assert":
            self.next()
            self.named_or_expr()
            if self.take(","):
                self.expr()
        elif t == "import":
            self.next()
            self.dotted_as()
            while self.take(","):
                self.dotted_as()
        elif t == "from":
            self.from_import()
        elif t == "type" and self.toks[self.i + 1] in _NAMES and self.toks[self.i + 2] in ("=", "["):
            self.next()
            self.name()
            self.type_params()
            self.want("=")
            self.expr()
        else:
            self.assignment()

    def named_or_expr(self) -> None:
        self.expr()

    def dotted_as(self) -> None:
        self.name()
        while self.take("."):
            self.name()
        if self.take("as"):
            self.name()

    def from_import(self) -> None:
        self.next()
        dots = False
        while self.tok in (".", "..."):
            self.next()
            dots = True
        if self.tok in _NAMES:
            self.name()
            while self.take("."):
                self.name()
        elif not dots:
            raise SyntaxFault("invalid syntax")
        self.want("import")
        if self.take("*"):
            return
        paren = self.take("(")
        while True:
            self.name()
            if self.take("as"):
                self.name()
            if not self.take(","):
                break
            if paren and self.tok == ")":
                break
            if not paren and self.tok in ("", ";"):
                raise SyntaxFault("trailing comma not allowed without surrounding parentheses")
        if paren:
            self.want(")")

    def assignment(self) -> None:
        if self.tok == "yield":
            self.yield_expr()
            if self.tok == "=":
                raise SyntaxFault("assignment to yield expression not possible")
            return
        left = self.star_exprs()
        t = self.tok
        if t == "=":
            while self.take("="):
                self.target(left)
                if left[0] == "star":
                    raise SyntaxFault("starred assignment target must be in a list or tuple")
                if self.tok == "yield":
                    self.yield_expr()
                    if self.tok == "=":
                        raise SyntaxFault("assignment to yield expression not possible")
                    return
                left = self.star_exprs()
        elif t in _AUG:
            if left[0] not in ("name", "attr", "sub") and not (left[0] == "paren" and left[1][0][0] in ("name", "attr", "sub")):
                raise SyntaxFault("illegal expression for augmented assignment")
            self.next()
            self.yield_expr() if self.tok == "yield" else self.star_exprs()
        elif t == ":":
            if left[0] not in ("name", "attr", "sub") and not (left[0] == "paren" and left[1][0][0] in ("name", "attr", "sub")):
                raise SyntaxFault("illegal target for annotation")
            self.next()
            self.expr()
            if self.take("="):
                self.yield_expr() if self.tok == "yield" else self.star_exprs()

    def colon(self, kind: str) -> tuple[str, bool]:
        if self.tok != ":":
            raise SyntaxFault("expected ':'")
        self.next()
        if self.tok == "":
            return kind, False
        self.simple_line()
        return kind, True

    def statement(self) -> tuple[str, bool]:
        """Kind of the line, and whether a header has its body in the same line."""
        t = self.tok
        if t in ("if", "elif", "while"):
            self.next()
            self.named()
            return self.colon(t)
        if t in ("else", "try", "finally"):
            self.next()
            return self.colon(t)
        if t == "async":
            self.next()
            if self.tok not in ("def", "for", "with"):
                raise SyntaxFault("invalid syntax")
            t = self.tok
        if t == "for":
            self.next()
            self.target_list()
            self.want("in")
            self.star_exprs()
            return self.colon("for")
        if t == "def":
            self.next()
            self.name()
            self.type_params()
            self.want("(")
            self.params(")", True)
            self.want(")")
            if self.take("->"):
                self.expr()
            return self.colon("def")
        if t == "class":
            self.next()
            self.name()
            self.type_params()
            if self.take("("):
                self.args()
            return self.colon("class")
        if t == "with":
            self.next()
            self.with_items()
            return self.colon("with")
        if t == "except":
            self.next()
            star = self.take("*")
            if self.tok != ":":
                self.expr()
                if self.tok == ",":
                    raise SyntaxFault("multiple exception types must be parenthesized")
                if self.take("as"):
                    self.name()
                return self.colon("except")
            if star:
                raise SyntaxFault("expected one or more exception types")
            return self.colon("except")
        if t == "@":
            self.next()
            self.named()
            if self.tok != "":
                raise SyntaxFault("invalid syntax")
            return "decorator", False
        if t in ("match", "case"):
            try:
                self.simple_line()
                return "simple", False
            except SyntaxFault as e:
                self.back(1)
                self.depth = 0
                try:
                    if t == "match":
                        self.star_named_list()
                        if self.tok != ":" or self.toks[self.i + 1] != "":
                            raise SyntaxFault("expected ':'")
                        return "match", False
                    self.patterns(":")
                    if self.take("if"):
                        self.named()
                    return self.colon("case")
                except SyntaxFault:
                    raise e from None
        self.simple_line()
        return "simple", False

    def star_named_list(self) -> None:
        self.star_expr(True)
        while self.take(","):
            if not self.starts():
                break
            self.star_expr(True)

    def with_items(self) -> None:
        if self.tok == "(":
            i = self.i
            try:
                self.next()
                while True:
                    self.with_item()
                    if self.take(")"):
                        break
                    self.want(",")
                    if self.take(")"):
                        break
                if self.tok == ":":
                    return
            except SyntaxFault:
                pass
            self.back(i)
            self.depth = 0
        self.with_item()
        while self.take(","):
            self.with_item()

    def with_item(self) -> None:
        self.expr()
        if self.take("as"):
            self.target(self.star_target())

    def star_target(self) -> tuple:
        return ("star", [self.binary(5)]) if self.take("*") else self.binary(5)

    # patterns of match

    def patterns(self, end: str) -> None:
        self.pattern(True)
        while self.take(","):
            if self.tok in (end, "if", ")", "]"):
                return
            self.pattern(True)

    def pattern(self, star: bool = False) -> None:
        if star and self.take("*"):
            self.name()
            return
        self.closed_pattern()
        while self.take("|"):
            self.closed_pattern()
        if self.take("as"):
            self.name()

    def closed_pattern(self) -> None:
        t = self.tok
        if t in ("None", "True", "False"):
            self.next()
        elif t in (STR, BYT):
            while self.tok in (STR, BYT):
                self.next()
        elif t in ("0", "-"):
            self.take("-")
            self.want("0")
            if self.tok in ("+", "-"):
                self.next()
                self.want("0")
        elif t in ("(", "["):
            self.next()
            end = ")" if t == "(" else "]"
            if self.tok != end:
                self.patterns(end)
            self.want(end)
        elif t == "{":
            self.next()
            while not self.take("}"):
                if self.take("**"):
                    self.name()
                else:
                    if self.tok in _NAMES:
                        self.name()
                        while self.take("."):
                            self.name()
                    else:
                        self.closed_pattern()
                    self.want(":")
                    self.pattern()
                if self.tok != "}":
                    self.want(",")
        else:
            self.name()
            while self.take("."):
                self.name()
            if self.take("("):
                key = False
                while not self.take(")"):
                    if self.tok in _NAMES and self.toks[self.i + 1] == "=":
                        self.next()
                        self.next()
                        key = True
                    elif key:
                        raise SyntaxFault("positional patterns follow keyword patterns")
                    self.pattern()
                    if self.tok != ")":
                        self.want(",")


_LINE_CACHE: dict[str, tuple] = {}
_CLOSE = {")": "(", "]": "[", "}": "{"}
_BRACKETS = re.compile(r"[()\[\]{}]")
_FOLLOW = {"if": ("elif", "else"), "elif": ("elif", "else"), "for": ("else",), "while": ("else",), "try": ("except", "else", "finally")}
MAX_LEVELS = 99


def _line(shape: str) -> tuple[str, bool, str]:
    """Kind, inline body and error of a logical line, or what is left open of brackets: ('(', ...)."""
    known = _LINE_CACHE.get(shape)
    if known is None:
        try:
            kind, inline = _Line(shape).statement()
            known = (kind, inline, "")
        except SyntaxFault as e:
            known = ("bad", False, str(e))
        except RecursionError:
            known = ("bad", False, "too many nested parentheses")
        if len(_LINE_CACHE) < 200_000:
            _LINE_CACHE[shape] = known
    return known


_OPEN_CACHE: dict[str, bool] = {}


def _brackets(line: str, stack: list[str]) -> str:
    for b in _BRACKETS.findall(line):
        if b in "([{":
            stack.append(b)
        elif not stack:
            return f"unmatched '{b}'"
        elif stack.pop() != _CLOSE[b]:
            return f"closing parenthesis '{b}' does not match opening parenthesis"
    return ""


def _logical(text: str, errors: list[tuple[int, str]]) -> list[tuple[int, str, bool, int]]:
    """(column, kind, inline, line number) of every logical line; what is wrong within lines goes to ``errors``."""
    lines = _shape(text, errors).split("\n")
    out, i, n, no = [], 0, len(lines), 0
    while i < n:
        raw = lines[i]
        i += 1
        no += 1
        s = raw.strip(" \t\f\r")
        if not s:
            continue
        at = no
        head = raw[: len(raw) - len(raw.lstrip(" \t\f"))]
        if "\x00" in s:
            no += s.count("\x00")
            s = s.replace("\x00", "")
        whole = _OPEN_CACHE.get(s)
        if whole is None:
            stack: list[str] = []
            whole = not (s.endswith("\\") or _brackets(s, stack) or stack)
            if len(_OPEN_CACHE) < 200_000:
                _OPEN_CACHE[s] = whole
        if not whole:
            stack, parts, j, why, m = [], [s], i, _brackets(s, []), no
            why = _brackets(s, stack)
            while not why and (stack or parts[-1].endswith("\\")):
                if parts[-1].endswith("\\"):
                    parts[-1] = parts[-1][:-1]
                if j >= n:
                    why = f"'{stack[0]}' was never closed" if stack else "unexpected EOF while parsing"
                    break
                nxt = lines[j].strip(" \t\f\r")
                j += 1
                m += 1
                if "\x00" in nxt:
                    m += nxt.count("\x00")
                    nxt = nxt.replace("\x00", "")
                parts.append(nxt)
                why = _brackets(nxt, stack)
            if why:
                errors.append((at, why))
                out.append((_column(head), "bad", False, at))
                continue  # panic mode: go on with the next physical line
            s, i, no = " ".join(parts), j, m
            if not s.strip():
                continue
        kind, inline, why = _line(s)
        if why:
            errors.append((at, why))
        out.append((_column(head), kind, inline, at))
    return out


def _column(head: str) -> int:
    if "\t" not in head and "\f" not in head:
        return len(head)
    col = 0
    for c in head:
        col = 0 if c == "\f" else (col // 8 + 1) * 8 if c == "\t" else col + 1
    return col


class _Blocks:
    """Descent over statements: suites by indentation, clauses in their order."""

    def __init__(self, lines: list[tuple[int, str, bool, int]], errors: list[tuple[int, str]]):
        self.lines, self.errors, self.i, self.n = lines, errors, 0, len(lines)

    def suite(self, col: int, level: int, cases: bool = False) -> None:
        lines, n = self.lines, self.n
        if level > MAX_LEVELS:
            self.errors.append((lines[self.i][3], "too many levels of indentation"))
            self.i = n
        while self.i < n:
            c, kind, inline, no = lines[self.i]
            if c < col:
                return
            if c > col:
                self.errors.append((no, "unexpected indent"))
                while self.i < n and lines[self.i][0] > col:
                    self.i += 1
                continue
            if kind == "simple":
                if cases:
                    self.errors.append((no, "expected 'case'"))
                self.i += 1
                continue
            self.i += 1
            if kind == "bad":
                while self.i < n and lines[self.i][0] > col:  # what stands under a bad header isn't judged
                    self.i += 1
                continue
            if kind in ("elif", "else", "except", "finally") or (kind == "case") != cases:
                self.errors.append((no, "invalid syntax"))
                self.body(col, kind, inline, no, level)
            elif kind == "decorator":
                while self.i < n and lines[self.i][0] == col and lines[self.i][1] == "decorator":
                    self.i += 1
                if self.i >= n or lines[self.i][0] != col or lines[self.i][1] not in ("def", "class", "bad"):
                    self.errors.append((no, "invalid syntax after decorator"))
            else:
                self.body(col, kind, inline, no, level)
                if kind in _FOLLOW:
                    self.clauses(col, kind, no, level)

    def clauses(self, col: int, kind: str, no: int, level: int) -> None:
        tried = kind == "try"
        seen: list[str] = []
        last = kind
        while self.i < self.n:
            c, k, inline, at = self.lines[self.i]
            if c != col or k not in _FOLLOW[kind]:
                break
            if tried:
                if "finally" in seen or k == "except" and "else" in seen or k == "else" and "except" not in seen:
                    break
            elif last == "else":
                break
            seen.append(k)
            last = k
            self.i += 1
            self.body(col, k, inline, at, level)
        if tried and "except" not in seen and "finally" not in seen:
            self.errors.append((no, "expected 'except' or 'finally' block"))

    def body(self, col: int, kind: str, inline: bool, no: int, level: int) -> None:
        if inline:
            return
        if self.i < self.n and self.lines[self.i][0] > col:
            self.suite(self.lines[self.i][0], level + 1, kind == "match")
        else:
            self.errors.append((no, f"expected an indented block after '{kind}'"))


def python_errors(text: str) -> list[tuple[int, str]]:
    """All (line, message) that the recogniser finds, in order of place; empty for a valid text."""
    errors: list[tuple[int, str]] = []
    if "\x00" in text:
        return [(text.count("\n", 0, text.index("\x00")) + 1, "source code cannot contain null bytes")]
    if text.startswith("\ufeff"):
        text = text[1:]
    if "\r" in text:
        text = text.replace("\r\n", "\n").replace("\r", "\n")
    lines = _logical(text, errors)
    if lines:
        b = _Blocks(lines, errors)
        if lines[0][0] > 0:
            errors.append((lines[0][3], "unexpected indent"))
        while b.i < b.n:
            at = b.i
            b.suite(0, 0)
            if b.i == at:
                b.i += 1
    return sorted(errors)
