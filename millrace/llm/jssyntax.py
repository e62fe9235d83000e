"""Recursive-descent recogniser for JavaScript (scripts and modules) with precedence climbing and panic-mode recovery.

Simple statements are looked up by their shape (names and literals as placeholders), so each shape is parsed once.
Nesting has no bound of its own: calls of Python functions stand on the heap, and the interpreter's limit follows the text."""

from __future__ import annotations

import re
import sys

from millrace.llm.pysyntax import SyntaxFault

_SCAN = re.compile(
    r"(?P<ws>[ \t\f\v\xa0\ufeff\u2000-\u200a\u3000\r]+)|(?P<nl>[\n\u2028\u2029]+)|(?P<com>//[^\n]*|/\*[\s\S]*?\*/)"
    r"|(?P<num>0[xX][0-9a-fA-F](?:_?[0-9a-fA-F])*n?|0[bB][01](?:_?[01])*n?|0[oO][0-7](?:_?[0-7])*n?"
    r"|(?:\d(?:_?\d)*\.?(?:\d(?:_?\d)*)?|\.\d(?:_?\d)*)(?:[eE][+-]?\d(?:_?\d)*)?n?)"
    r"|(?P<name>#?[A-Za-z_$\u00aa-\uffff\U00010000-\U0010ffff][\w$\u200c\u200d]*)"
    r"|(?P<str>\"(?:[^\"\\\n]|\\[\s\S])*\"|'(?:[^'\\\n]|\\[\s\S])*')"
    r"|(?P<op>\.\.\.|=>|>>>=|\*\*=|&&=|\|\|=|\?\?=|<<=|>>=|>>>|===|!==|\*\*|\+\+|--|<<|>>|<=|>=|==|!=|&&|\|\||\?\?|\?\.(?!\d)|[-+*%&|^]=|[{}()\[\];,<>+\-*%&|^!~?:=.@])"
    r"|(?P<slash>/=?)|(?P<tick>`)"
)
_REGEX = re.compile(r"/(?:[^/\\\[\n*]|\\[^\n]|\[(?:[^\]\\\n]|\\[^\n])*\])(?:[^/\\\[\n]|\\[^\n]|\[(?:[^\]\\\n]|\\[^\n])*\])*/[A-Za-z]*")
RESERVED = frozenset(
    "break case catch class const continue debugger default delete do else enum export extends false finally for function if "
    "import in instanceof new null return super switch this throw true try typeof var void while with".split()
)
WORDS = RESERVED | {"let", "static", "async", "await", "of", "get", "set", "yield", "from", "as", "target", "meta"}
_ENDS = frozenset((")", "]", "}", "N", "0", "S", "T", "this", "super", "null", "true", "false", "++", "--"))
_ASSIGN = frozenset(("=", "+=", "-=", "*=", "/=", "%=", "**=", "<<=", ">>=", ">>>=", "&=", "|=", "^=", "&&=", "||=", "??="))
_BIN = {"??": 1, "||": 2, "&&": 3, "|": 4, "^": 5, "&": 6, "==": 7, "!=": 7, "===": 7, "!==": 7, "<": 8, ">": 8, "<=": 8, ">=": 8, "instanceof": 8, "in": 8,
        "<<": 9, ">>": 9, ">>>": 9, "+": 10, "-": 10, "*": 11, "/": 11, "%": 11, "**": 12}


def _tokens(text: str, lineno: int = 1) -> tuple[list[str], list[bool], list[int], list[tuple[int, str]]]:
    toks: list[str] = []
    newline: list[bool] = []
    lines: list[int] = []
    errors: list[tuple[int, str]] = []
    pos, n, nl, line = 0, len(text), False, lineno
    if text.startswith("#!"):
        pos = max(0, text.find("\n"))
    match = _SCAN.match
    while pos < n:
        m = match(text, pos)
        if not m:
            errors.append((line, "invalid or unexpected token"))
            toks.append("?")
            newline.append(nl)
            lines.append(line)
            nl = False
            end = text.find("\n", pos) if text[pos] in "\"'" else pos + 1
            pos = n if end < 0 else end
            continue
        kind, t = m.lastgroup, m[0]
        pos = m.end()
        if kind == "ws":
            continue
        if kind == "nl":
            nl = True
            line += len(t)
            continue
        if kind == "com":
            if "\n" in t:
                nl = True
                line += t.count("\n")
            continue
        at = line
        if kind == "name":
            if t not in WORDS:
                t = "N" if t[0] != "#" else "#N"
        elif kind == "num":
            if text[pos : pos + 1].isalnum() or text[pos : pos + 1] in ("_", "$") and pos < n:
                errors.append((line, "identifier directly after number"))
                t = "?"
            else:
                t = "0"
        elif kind == "str":
            line += t.count("\n")
            t = "S"
        elif kind == "slash":
            if not toks or toks[-1] not in _ENDS:
                m = _REGEX.match(text, pos - len(t))
                if m:
                    pos, t = m.end(), "S"
                elif t == "/" and text[pos : pos + 1] == "*":
                    errors.append((line, "unterminated comment"))
                    pos = n
                    t = "?"
        elif kind == "tick":
            start = pos
            try:
                pos = _template(text, pos)
                t = "T"
            except SyntaxFault as e:
                errors.append((line, str(e)))
                pos, t = n, "?"
            line += text.count("\n", start, pos)
        toks.append(t)
        newline.append(nl)
        lines.append(at)
        nl = False
    return toks, newline, lines, errors


def _template(text: str, pos: int) -> int:
    """The place after the template literal whose opening tick is before ``pos``."""
    n = len(text)
    while pos < n:
        c = text[pos]
        if c == "\\":
            pos += 2
        elif c == "`":
            return pos + 1
        elif c == "$" and text[pos + 1 : pos + 2] == "{":
            start, depth, pos = pos + 2, 1, pos + 2
            while pos < n and depth:
                m = _SCAN.match(text, pos)
                if not m:
                    raise SyntaxFault("invalid token in template")
                pos = m.end()
                if m.lastgroup == "tick":
                    pos = _template(text, pos)
                elif m[0] == "{":
                    depth += 1
                elif m[0] == "}":
                    depth -= 1
            if depth:
                break
            toks, nl, lines, errors = _tokens(text[start : pos - 1])
            p = _Js(toks, nl, lines)
            if errors:
                raise SyntaxFault(errors[0][1])
            p.expression()
            if p.tok:
                raise SyntaxFault("unexpected token in template")
        else:
            pos += 1
    raise SyntaxFault("unterminated template literal")


_SIMPLE: dict[str, bool] = {}


class _Js:
    def __init__(self, toks: list[str], newline: list[bool], lines: list[int]):
        self.toks, self.nl, self.lines = [*toks, "", "", ""], [*newline, True, True, True], [*lines, *[lines[-1] if lines else 1] * 3]
        self.i, self.tok = 0, self.toks[0]
        self.errors: list[tuple[int, str]] = []
        self.pairs: dict[int, int] | None = None

    def next(self) -> str:
        t = self.tok
        self.i += 1
        self.tok = self.toks[self.i] if self.i < len(self.toks) else ""
        return t

    def to(self, i: int) -> None:
        self.i, self.tok = i, self.toks[i]

    def peek(self, k: int = 1) -> str:
        return self.toks[self.i + k] if self.i + k < len(self.toks) else ""

    def take(self, t: str) -> bool:
        if self.tok == t:
            self.next()
            return True
        return False

    def want(self, t: str) -> None:
        if self.tok != t:
            raise SyntaxFault(f"expected '{t}'")
        self.next()

    def is_name(self, t: str) -> bool:
        return t == "N" or t in WORDS and t not in RESERVED

    def semicolon(self) -> None:
        if self.take(";") or self.tok in ("}", "") or self.nl[self.i]:
            return
        raise SyntaxFault("unexpected token")

    # expressions; the kind tells what can be assigned to

    def expression(self, no_in: bool = False) -> str:
        k = self.assign(no_in)
        while self.take(","):
            self.assign(no_in)
            k = "value"
        return k

    def assign(self, no_in: bool = False) -> str:
        t = self.tok
        if t == "yield" and (self.peek() in ("*", ";", ")", "]", "}", ",", "", "N", "S", "0", "T", "(", "[", "{", "this", "new", "null", "true", "false") or self.nl[self.i + 1]):
            self.next()
            self.take("*")
            if self.tok not in (";", ")", "]", "}", ",", "", ":") and not self.nl[self.i]:
                self.assign(no_in)
            return "value"
        if t == "async" and self.is_name(self.peek()) and self.peek(2) == "=>":
            self.next()
        if self.is_name(self.tok) and self.peek() == "=>":
            self.next()
            return self.arrow(no_in)
        if t == "(" or t == "async" and self.peek() == "(":
            i = self.i
            if t == "async":
                self.next()
            end = self.closing(self.i)
            if end and self.toks[end + 1] == "=>" and not self.nl[end + 1]:
                self.next()
                self.params(")")
                return self.arrow(no_in)
            self.to(i)
        start = self.i
        k = self.conditional(no_in)
        if self.tok in _ASSIGN:
            if self.tok == "=" and self.toks[start] in ("[", "{") and k == "literal":
                pass
            elif k != "target":
                raise SyntaxFault("invalid assignment target")
            self.next()
            self.assign(no_in)
            return "value"
        return k

    def closing(self, i: int) -> int:
        if self.pairs is None:
            self.pairs, opened = {}, []
            for j, t in enumerate(self.toks):
                if t in ("(", "[", "{"):
                    opened.append(j)
                elif t in (")", "]", "}") and opened:
                    self.pairs[opened.pop()] = j
        return self.pairs.get(i, 0)

    def arrow(self, no_in: bool) -> str:
        self.want("=>")
        if self.tok == "{":
            self.block()
        else:
            self.assign(no_in)
        return "arrow"

    def conditional(self, no_in: bool) -> str:
        k = self.binary(1, no_in)
        if self.take("?"):
            self.assign()
            self.want(":")
            self.assign(no_in)
            return "value"
        return k

    def binary(self, least: int, no_in: bool = False) -> str:
        """Precedence climbing."""
        if self.tok == "#N" and self.peek() == "in":
            self.next()
            k = "value"
        else:
            k = self.unary()
        while True:
            t = self.tok
            p = _BIN.get(t)
            if p is None or p < least or t == "in" and no_in or k == "arrow":
                return k
            if t == "**" and k == "unary":
                raise SyntaxFault("unary operator used immediately before exponentiation")
            self.next()
            self.binary(p if t == "**" else p + 1, no_in)
            k = "value"

    def unary(self) -> str:
        t = self.tok
        if t in ("!", "~", "+", "-", "typeof", "void", "delete") or t == "await" and self.peek() not in (")", ";", ",", "=", "=>", ".", "", "}", "]", ":"):
            self.next()
            self.unary()
            return "unary"
        if t in ("++", "--"):
            self.next()
            if self.unary() != "target":
                raise SyntaxFault("invalid left-hand side expression in prefix operation")
            return "value"
        k = self.call()
        if self.tok in ("++", "--") and not self.nl[self.i]:
            if k != "target":
                raise SyntaxFault("invalid left-hand side expression in postfix operation")
            self.next()
            return "value"
        return k

    def call(self) -> str:
        t = self.tok
        if t == "new":
            self.next()
            if self.take("."):
                self.want("target")
                k = "value"
            else:
                k = self.member_only()
                if self.tok == "(":
                    self.args()
                k = "value"
        elif t == "import":
            self.next()
            if self.take("."):
                self.want("meta")
            elif self.tok != "(":
                raise SyntaxFault("cannot use import statement inside an expression")
            k = "value"
        elif t == "super":
            self.next()
            if self.tok not in ("(", ".", "["):
                raise SyntaxFault("'super' keyword unexpected here")
            k = "value"
        else:
            k = self.atom()
        while True:
            t = self.tok
            if t == ".":
                self.next()
                self.prop()
                k = "target"
            elif t == "?.":
                self.next()
                if self.tok == "(":
                    self.args()
                elif self.take("["):
                    self.expression()
                    self.want("]")
                else:
                    self.prop()
                k = "value"
            elif t == "[":
                self.next()
                self.expression()
                self.want("]")
                k = "target"
            elif t == "(":
                self.args()
                k = "value"
            elif t == "T":
                self.next()
                k = "value"
            else:
                return k

    def member_only(self) -> str:
        if self.tok == "new":
            self.next()
            k = self.member_only()
            if self.tok == "(":
                self.args()
        else:
            k = self.atom()
        while True:
            if self.take("."):
                self.prop()
            elif self.take("["):
                self.expression()
                self.want("]")
            elif self.tok == "T":
                self.next()
            else:
                return k

    def prop(self) -> None:
        if not (self.tok in ("N", "#N") or self.tok in WORDS):
            raise SyntaxFault("unexpected token")
        self.next()

    def args(self) -> None:
        self.want("(")
        while not self.take(")"):
            self.take("...")
            self.assign()
            if self.tok != ")":
                if self.tok != ",":
                    raise SyntaxFault("missing ) after argument list")
                self.next()

    def atom(self) -> str:
        t = self.tok
        if t in ("0", "S", "T", "this", "null", "true", "false"):
            self.next()
            return "value"
        if t == "async" and self.peek() == "function" and not self.nl[self.i + 1]:
            self.next()
            t = "function"
        if t == "function":
            self.next()
            self.take("*")
            if self.is_name(self.tok):
                self.next()
            self.function_rest()
            return "value"
        if t == "class":
            self.class_(False)
            return "value"
        if self.is_name(t):
            self.next()
            return "target"
        if t == "(":
            self.next()
            k = self.expression()
            self.want(")")
            return "target" if k == "target" else "value"
        if t == "[":
            self.next()
            while not self.take("]"):
                if self.take(","):
                    continue
                self.take("...")
                self.assign()
                if self.tok != "]":
                    self.want(",")
            return "literal"
        if t == "{":
            self.object()
            return "literal"
        if t == "@":
            self.class_(False)
            return "value"
        raise SyntaxFault("unexpected end of input" if not t else "unexpected token")

    def object(self) -> None:
        self.want("{")
        while not self.take("}"):
            if self.take("..."):
                self.assign()
            else:
                self.member(False)
            if self.tok != "}":
                self.want(",")

    def member(self, in_class: bool) -> None:
        word, plain = self.tok, True
        for w in ("static",) * in_class + ("async", "get", "set"):
            if self.tok == w and self.peek() not in ("(", ",", ":", "=", "}", ";", "") and not (w == "async" and self.nl[self.i + 1]):
                if in_class and w == "static" and self.peek() == "{":
                    self.next()
                    self.block()
                    return
                self.next()
                plain = w == "static" and plain
        if self.take("*"):
            plain = False
        word = self.tok
        if self.take("["):
            self.assign()
            self.want("]")
            word = "["
        elif word in ("N", "S", "0") or word in WORDS or in_class and word == "#N":
            self.next()
        else:
            raise SyntaxFault("unexpected token")
        if self.tok == "(":
            self.function_rest()
            return
        if not plain:
            raise SyntaxFault("unexpected token")
        if in_class:
            if self.take("="):
                self.assign()
            self.semicolon()
        elif self.take(":"):
            self.assign()
        elif not self.is_name(word):
            raise SyntaxFault("unexpected token")
        elif self.take("="):  # a default in a pattern
            self.assign()

    def class_(self, named: bool) -> None:
        while self.take("@"):
            self.call()
        self.want("class")
        if self.is_name(self.tok):
            self.next()
        elif named:
            raise SyntaxFault("class statement requires a name")
        if self.take("extends"):
            self.call()
        self.want("{")
        while not self.take("}"):
            if self.take(";"):
                continue
            while self.take("@"):
                self.call()
            self.member(True)

    def function_rest(self) -> None:
        self.want("(")
        self.params(")")
        self.block()

    def params(self, end: str) -> None:
        while not self.take(end):
            rest = self.take("...")
            self.binding()
            if not rest and self.take("="):
                self.assign()
            if rest and self.tok != end:
                raise SyntaxFault("rest parameter must be last formal parameter")
            if self.tok != end:
                if self.tok != ",":
                    raise SyntaxFault("missing ) after formal parameters")
                self.next()

    def binding(self) -> None:
        if self.is_name(self.tok):
            self.next()
        elif self.take("["):
            while not self.take("]"):
                if self.take(","):
                    continue
                self.take("...")
                self.binding()
                if self.take("="):
                    self.assign()
                if self.tok != "]":
                    self.want(",")
        elif self.take("{"):
            while not self.take("}"):
                if self.take("..."):
                    self.binding()
                else:
                    t = self.tok
                    if self.take("["):
                        self.assign()
                        self.want("]")
                        self.want(":")
                        self.binding()
                    else:
                        if not (t in ("N", "S", "0") or t in WORDS):
                            raise SyntaxFault("unexpected token")
                        self.next()
                        if self.take(":"):
                            self.binding()
                        elif not self.is_name(t):
                            raise SyntaxFault("unexpected token")
                    if self.take("="):
                        self.assign()
                if self.tok != "}":
                    self.want(",")
        else:
            raise SyntaxFault("unexpected token")

    # statements

    def block(self) -> None:
        self.want("{")
        self.list("}")
        self.want("}")

    def list(self, end: str) -> None:
        while self.tok not in (end, ""):
            start = self.i
            try:
                self.statement()
            except SyntaxFault as e:
                self.errors.append((self.lines[self.i], str(e)))
                self.to(max(self.i, start + 1) if self.tok else self.i)  # panic mode: past the next ; or to a }
                while self.tok not in (";", "}", ""):
                    self.next()
                if self.tok == ";" or self.tok == "}" and end != "}":
                    self.next()

    def known(self) -> bool:
        """Whether a simple statement of a known valid shape was skipped."""
        toks, i = self.toks, self.i
        try:
            j = toks.index(";", i, i + 24)
        except ValueError:
            return False
        key = " ".join(toks[i : j + 1])
        good = _SIMPLE.get(key)
        if good is None:
            good = False
            if "{" not in key and "}" not in key:
                p = _Js(toks[i : j + 1], [False] * (j + 1 - i), [1] * (j + 1 - i))
                try:
                    p.statement_()
                    good = p.tok == ""
                except SyntaxFault:
                    pass
            if len(_SIMPLE) < 100_000:
                _SIMPLE[key] = good
        if good:
            self.to(j + 1)
        return good

    def statement(self) -> None:
        if self.tok not in ("{", "}", "function", "class", "if", "for", "while", "do", "try", "switch") and self.known():
            return
        self.statement_()

    def paren(self) -> None:
        self.want("(")
        self.expression()
        self.want(")")

    def statement_(self) -> None:
        t = self.tok
        if t == "{":
            self.block()
        elif t == ";":
            self.next()
        elif t in ("var", "const") or t == "let" and (self.is_name(self.peek()) or self.peek() in ("[", "{")):
            self.next()
            self.declarators(t)
            self.semicolon()
        elif t == "function" or t == "async" and self.peek() == "function" and not self.nl[self.i + 1]:
            self.take("async")
            self.next()
            self.take("*")
            if not self.is_name(self.tok):
                raise SyntaxFault("function statement requires a function name")
            self.next()
            self.function_rest()
        elif t in ("class", "@"):
            self.class_(True)
        elif t == "if":
            self.next()
            self.paren()
            self.statement()
            while self.take("else"):
                if not self.take("if"):
                    self.statement()
                    break
                self.paren()
                self.statement()
        elif t == "for":
            self.for_()
        elif t == "while":
            self.next()
            self.paren()
            self.statement()
        elif t == "do":
            self.next()
            self.statement()
            self.want("while")
            self.paren()
            self.take(";")
        elif t == "return":
            self.next()
            if self.tok not in (";", "}", "") and not self.nl[self.i]:
                self.expression()
            self.semicolon()
        elif t in ("break", "continue"):
            self.next()
            if self.is_name(self.tok) and not self.nl[self.i]:
                self.next()
            self.semicolon()
        elif t == "throw":
            self.next()
            if self.nl[self.i]:
                raise SyntaxFault("illegal newline after throw")
            self.expression()
            self.semicolon()
        elif t == "try":
            self.next()
            self.block()
            if self.tok not in ("catch", "finally"):
                raise SyntaxFault("missing catch or finally after try")
            if self.take("catch"):
                if self.take("("):
                    self.binding()
                    self.want(")")
                self.block()
            if self.take("finally"):
                self.block()
        elif t == "switch":
            self.next()
            self.paren()
            self.want("{")
            while not self.take("}"):
                if not self.take("default"):
                    self.want("case")
                    self.expression()
                self.want(":")
                while self.tok not in ("case", "default", "}", ""):
                    self.statement()
        elif t == "import" and self.peek() not in ("(", "."):
            self.import_()
        elif t == "export":
            self.export()
        elif t == "debugger":
            self.next()
            self.semicolon()
        elif t == "with":
            self.next()
            self.paren()
            self.statement()
        elif self.is_name(t) and self.peek() == ":":
            self.next()
            self.next()
            self.statement()
        else:
            self.expression()
            self.semicolon()

    def declarators(self, word: str, no_in: bool = False) -> None:
        while True:
            pattern = self.tok in ("[", "{")
            self.binding()
            if self.take("="):
                self.assign(no_in)
            elif (pattern or word == "const") and not no_in:
                raise SyntaxFault("missing initializer in declaration")
            if not self.take(","):
                return

    def for_(self) -> None:
        self.next()
        self.take("await")
        self.want("(")
        t = self.tok
        if t in ("var", "const") or t == "let" and (self.is_name(self.peek()) or self.peek() in ("[", "{")):
            self.next()
            self.declarators(t, True)
        elif t != ";":
            self.expression(True)
        if self.take("of"):
            self.assign()
        elif self.take("in"):
            self.expression()
        else:
            self.want(";")
            if self.tok != ";":
                self.expression()
            self.want(";")
            if self.tok != ")":
                self.expression()
        self.want(")")
        self.statement()

    def import_(self) -> None:
        self.next()
        if self.tok != "S":
            if self.is_name(self.tok):
                self.next()
                if self.tok == ",":
                    self.next()
            if self.take("*"):
                self.want("as")
                self.next()
            elif self.tok == "{":
                self.names()
            self.want("from")
        self.want("S")
        if self.take("with"):
            self.object()
        self.semicolon()

    def names(self) -> None:
        self.want("{")
        while not self.take("}"):
            if not (self.tok in ("N", "S") or self.tok in WORDS):
                raise SyntaxFault("unexpected token")
            self.next()
            if self.take("as"):
                self.next()
            if self.tok != "}":
                self.want(",")

    def export(self) -> None:
        self.next()
        if self.take("default"):
            if self.tok == "function" or self.tok == "class" or self.tok == "async" and self.peek() == "function":
                self.atom()
            else:
                self.assign()
                self.semicolon()
        elif self.take("*"):
            if self.take("as"):
                self.next()
            self.want("from")
            self.want("S")
            self.semicolon()
        elif self.tok == "{":
            self.names()
            if self.take("from"):
                self.want("S")
            self.semicolon()
        elif self.tok in ("var", "let", "const", "function", "class", "async", "@"):
            self.statement()
        else:
            raise SyntaxFault("unexpected token")


def js_errors(text: str) -> list[tuple[int, str]]:
    """All (line, message) that the recogniser finds; empty for a valid text."""
    limit = sys.getrecursionlimit()
    sys.setrecursionlimit(min(limit + 1_000 + 16 * len(text), (1 << 31) - 1))  # a token opens eight calls at most
    try:
        toks, nl, lines, errors = _tokens(text)
        p = _Js(toks, nl, lines)
        while True:
            p.list("")
            if not p.tok:
                break
        return sorted(errors + p.errors)
    finally:
        sys.setrecursionlimit(limit)
