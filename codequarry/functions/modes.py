"""Where literals, comments and template holes of TypeScript-family code begin and end.

One pass over the marks of a text: quotes, backticks, slashes and brackets. A stack holds the open
brackets and template holes, so a ``}`` either closes a bracket or leads back into its template. A
slash is a comment by its second character; otherwise the token before it decides between a regex
literal and division. Where brackets don't match, the marks still follow each other to the end.
"""

import re
from collections.abc import Iterator

_MARK = re.compile(r"""[(){}\[\]"'`/]""")
_COMMENT = r"(?:/\*(?:[^*]++|\*(?!/))*+(?:\*/)?|//[^\n]*+)"
# Comments with nothing but blanks between them are one mark.
_COMMENTS = re.compile(rf"{_COMMENT}(?:[ \t\n\v\f\r]*+{_COMMENT})*+")
_QUOTED = {q: re.compile(rf"{q}(?:[^{q}\\\n]++|\\[\s\S])*+{q}?") for q in "\"'"}
# Template text up to its end or to a hole.
_TEMPLATE = re.compile(r"(?:[^`\\$]++|\\[\s\S]|\$(?!\{))*+")
_REGEX = re.compile(r"/(?![/*])(?:[^\\/\[\n]++|\\[^\n]|\[(?:[^\]\\\n]++|\\[^\n])*+\])++/[A-Za-z]*+")
# A slash that begins or ends no comment; and a plain text's marks with the text before them.
_LONE_SLASH = re.compile(r"/(?<![/*]/)(?![/*])")
_PLAIN = re.compile(
    rf"""((?:[^(){{}}\[\]"'`/]++|/(?![/*]))*+)(?:{_COMMENTS.pattern}|{_QUOTED['"'].pattern}|{_QUOTED["'"].pattern}"""
    r"""|`(?:[^`\\]++|\\[\s\S])*+`?|[(){}\[\]]|\Z)"""
)
# A word and a dot before it, read backwards: so it is looked for at one place only.
_LAST_WORD = re.compile(r"((?:\w|\$)++)[ \t\n]*+(\.?)")
_BLANKS = " \t\n\v\f\r"

# Words an operand follows; words whose parentheses a statement follows.
_OPERATORS = frozenset("return typeof case in of delete void throw new instanceof yield await else do".split())
_CONDITIONS = frozenset(("if", "while", "for", "with"))
_OPENS_BLOCK = frozenset(("else", "do"))

_PARTNERS = {")": ("(",), "]": ("[",), "}": ("{", "${")}
OPENING, CLOSING = ("(", "[", "{", "${"), (")", "]", "}")


def _in_word(c: str) -> bool:
    return c.isalnum() or c in "_$"


class Modes:
    """The state between two marks of a text, or of a piece of a text that ends with a line.

    With ``inner``, brackets may have been opened before the piece: closing ones without a partner
    are kept in ``closed``, and at a ``}`` without one, which may lead back into a template, the
    scan stops and ``stopped`` is the place behind it.
    """

    def __init__(self, mode: str = "code", stack: list[tuple[str, bool]] | None = None, inner: bool = False) -> None:
        self.mode, self.stopped = mode, -1
        self.closed: str | None = "" if inner else None
        # Open brackets and holes: the bracket, and whether a value stands where it closes.
        self.stack = list(stack or [])
        # The last token, and whether it ends a value, which a slash would divide.
        self.last, self.value = "", False
        self.holes = sum(bracket == "${" for bracket, _ in self.stack)

    def _pass(self, noise: str) -> None:
        """Take up the last token of text without marks."""
        tail = noise.rstrip(_BLANKS)
        if not tail:
            return
        if _in_word(tail[-1]):
            word, dot = _LAST_WORD.match(tail[:-81:-1]).groups()
            self.last = dot + word[::-1]
            self.value = bool(dot) or self.last not in _OPERATORS
            return
        if tail.endswith("!"):
            # Behind a value without a blank it says "not null".
            self.value = (self.value and noise[0] == "!" and len(tail) == 1) or bool(re.search(r"[\w$]!\Z", tail[-2:]))
        else:
            self.value = tail.endswith(("++", "--"))
        self.last = tail[-2:] if tail.endswith("=>") else tail[-1]

    def _opens_block(self) -> bool:
        if self.last[:1] == "." or self.last in ("", ";", "{", "}", ")", "=>") or self.last in _OPENS_BLOCK:
            return True
        return _in_word(self.last[0]) and self.last not in _OPERATORS

    def _open(self, bracket: str) -> None:
        after = self.last not in _CONDITIONS if bracket == "(" else bracket != "{" or not self._opens_block()
        self.stack.append((bracket, after))
        self.holes += bracket == "${"
        self.last, self.value = bracket, False

    def _close(self, bracket: str) -> bool | None:
        """Whether a template goes on behind it; none if that depends on brackets opened before."""
        partner = _PARTNERS[bracket]
        if bracket == "}":
            while self.stack and self.stack[-1][0] not in partner:
                self.stack.pop()
        if self.closed is not None and not self.stack:
            if bracket == "}":
                return None
            self.closed += bracket
        opened, after = self.stack.pop() if self.stack and self.stack[-1][0] in partner else ("", True)
        self.holes -= opened == "${"
        self.last, self.value = bracket, after
        return opened == "${"

    def scan(self, text: str, at: int = 0) -> Iterator[tuple[int, int, int, str]]:
        """(start of the text before it, start, end, kind) of each mark from ``at`` on; the last has
        no kind.

        A template is a string up to its end, or template text up to a hole, then the hole's
        brackets with what they hold, and so on. ``mode`` says what ``at`` stands in, and in the end
        what the end of the text does.
        """
        begin = at
        first = at if self.mode == "template" else -1
        if self.mode == "comment":
            stop = text.find("*/", at)
            at = len(text) if stop < 0 else stop + 2
            yield begin, begin, at, "comment"
            begin = at
            if stop < 0:
                yield begin, begin, begin, ""
                return
        self.mode = "code"
        while first >= 0 or (mark := _MARK.search(text, at)):
            if first < 0:
                start, c = mark.start(), mark[0]
                # The other marks set the last token themselves.
                if c in "({/":
                    self._pass(text[at:start])
            else:
                # A piece that begins in a template.
                start = end = first
                c = ""
            if c and c in "\"'":
                end, kind = _QUOTED[c].match(text, start).end(), "string"
                self.last, self.value = c, True
            elif c == "/":
                if text.startswith(("//", "/*"), start):
                    end, kind = _COMMENTS.match(text, start).end(), "comment"
                    if end == len(text) and _is_open(text[start:]):
                        self.mode = "comment"
                elif not self.value and (regex := _REGEX.match(text, start)):
                    end, kind = regex.end(), "string"
                    self.last, self.value = "/", True
                else:
                    self.last, self.value = "/", False
                    at = start + 1
                    continue
            elif c and c in "([{":
                end, kind = start + 1, c
                self._open(c)
            else:
                if c == "`":
                    end, first = start + 1, start
                elif c:
                    end, kind = start + 1, c
                    goes_on = self._close(c)
                    if goes_on is None:
                        self.stopped = end
                        return
                    if goes_on:
                        yield begin, start, end, kind
                        begin = first = end
                if first >= 0:
                    # Template text behind the backtick or the hole.
                    stop = _TEMPLATE.match(text, end).end()
                    if text.startswith("${", stop):
                        if stop > first:
                            yield begin, first, stop, "template"
                            begin = stop
                        start, end, kind = stop, stop + 2, "${"
                        self._open("${")
                    else:
                        if stop == len(text):
                            self.mode = "template"
                        start, end, kind = first, min(stop + 1, len(text)), "string"
                        self.last, self.value = "`", True
                    first = -1
            yield begin, start, end, kind
            begin = at = end
        self._pass(text[at:])
        yield begin, len(text), len(text), ""


def marks_of(text: str) -> Iterator[tuple[int, int, int, str]]:
    """(start of the text before it, start, end, kind) of each mark, as ``Modes.scan`` gives them.

    In a plain text, without regex literals, divisions and template holes, patterns find them all;
    its last mark, too, has no kind.
    """
    if ("`" in text and "${" in text) or _LONE_SLASH.search(text):
        yield from Modes().scan(text)
        return
    for m in _PLAIN.finditer(text):
        start, end = m.end(1), m.end()
        c = text[start:start + 1]
        yield m.start(), start, end, "comment" if c == "/" else "string" if c and c in "\"'`" else c


def _is_open(comments: str) -> bool:
    """Whether the last of adjoining comments is a block that doesn't end."""
    last = [m[0] for m in re.finditer(_COMMENT, comments)][-1]
    return last.startswith("/*") and (len(last) < 4 or not last.endswith("*/"))


def whole_literals(text: str) -> Iterator[tuple[int, int]]:
    """(start, end) of each comment and literal, templates with all that their holes hold."""
    modes, outer = Modes(), -1
    for _, start, end, kind in modes.scan(text):
        if modes.holes:
            continue
        if outer >= 0:
            if kind == "string":
                yield outer, end
                outer = -1
        elif kind == "template":
            outer = start
        elif kind == "comment":
            # One mark may hold several, with blanks between them.
            for comment in re.finditer(_COMMENT, text[start:end]):
                yield start + comment.start(), start + comment.end()
        elif kind == "string":
            yield start, end
    if outer >= 0:
        yield outer, len(text)
