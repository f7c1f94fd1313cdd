"""Declarations in configuration code: where a block ends, and removal of named blocks with those that depend on them."""

from __future__ import annotations

import re

_MARK = re.compile(r'/\*.*?(?:\*/|\Z)|(?:#|//)[^\n]*|<<-?([A-Za-z_]\w*)[^\n]*\n|["{}]', re.S)
_IN_TEXT = re.compile(r'\\.|"|[$%]\{|\$\$\{|%%\{', re.S)


def _after(code: str, at: int) -> tuple[int, str]:
    """The next brace at or after ``at`` that is code: where it ends, and which. Comments, here-documents and strings are passed over, and code inside
    ``${...}`` or ``%{...}`` of a string belongs to the string."""
    while m := _MARK.search(code, at):
        at = m.end()
        if m[1]:
            end = re.compile(rf"^[ \t]*{m[1]}[ \t]*$", re.M).search(code, at)
            at = end.end() if end else len(code)
        elif m[0] == '"':
            at = _text_end(code, at)
        elif m[0] in "{}":
            return at, m[0]
    return len(code), ""


def _text_end(code: str, at: int) -> int:
    """After the quote that closes a string opened before ``at``."""
    while m := _IN_TEXT.search(code, at):
        at = m.end()
        if m[0] == '"':
            return at
        if m[0] in ("${", "%{"):
            depth = 1
            while depth:
                at, brace = _after(code, at)
                if not brace:
                    return at
                depth += 1 if brace == "{" else -1
    return len(code)


def block_end(lines: list[str], start: int) -> int:
    """Line after the one that closes the braces opened from ``start``."""
    code, at, depth = "\n".join(lines[start:]), 0, 0
    while True:
        at, brace = _after(code, at)
        if not brace:
            raise ValueError(f"no end of the block in line {start + 1}")
        depth += 1 if brace == "{" else -1
        line = start + code.count("\n", 0, at)
        if depth < 0:
            raise ValueError(f"unbalanced brace in line {line + 1}")
        if not depth:
            return line + 1


_HEADER = re.compile(r'^\s*([a-z_]+)\s+"([^"]+)"(?:\s+"([^"]+)")?')


def strip_blocks(code: str, retired: tuple[str, ...], dependants: bool = False) -> str:
    """Code without the top-level blocks whose header names a retired type, and without one blank line after each.

    ``dependants``: blocks that refer to one taken out (``type.name``) go too, until none is left; a reference outside of any block can't be taken
    out, which is an error.
    """
    lines = code.split("\n")
    blocks, i = [], 0
    while retired and i < len(lines):
        if (m := _HEADER.match(lines[i])) and "{" in lines[i]:
            end = block_end(lines, i)
            blocks.append((i, end, m[2], f"{'data.' if m[1] == 'data' else ''}{m[2]}.{m[3]}" if m[3] else ""))
            i = end
        else:
            i += 1
    gone = {b for b in blocks if b[2] in retired}
    while dependants:
        names = [re.compile(rf"(?<![\w.]){re.escape(b[3])}(?![\w-])") for b in gone if b[3]]
        uses = lambda a, b: any(n.search("\n".join(lines[a:b])) for n in names)
        more = {b for b in blocks if b not in gone and uses(b[0], b[1])}
        if not more:
            inside = {k for b in blocks for k in range(b[0], b[1])}
            if any(uses(k, k + 1) for k in range(len(lines)) if k not in inside):
                raise ValueError("a reference outside of blocks")
            break
        gone |= more
    out, i = [], 0
    ends = {b[0]: b[1] for b in gone}
    while i < len(lines):
        if i in ends:
            i = ends[i]
            if i < len(lines) and not lines[i].strip() and (not out or not out[-1].strip()):
                i += 1
        else:
            out.append(lines[i])
            i += 1
    return "\n".join(out)
