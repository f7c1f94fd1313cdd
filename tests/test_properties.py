"""Properties over generated values."""

import re

from hypothesis import given, settings
from hypothesis import strategies as st

from textkiln.functions import html as H
from textkiln.functions import markdown as M
from textkiln.operators.curation import decoded
from textkiln.sources.archive import safe_member

lines = st.lists(st.sampled_from(["", "# A", "## B", "text here", "- item", "  - sub", "1. one", "> quote", "```", "| a | b |", "|---|---|", "| 1 | 2 |", "    code", "---", "[r]: http://x", "<div>", "[l](https://h/p)"]), max_size=14)
tags = st.lists(st.sampled_from(["<p>", "</p>", "<b>", "</b>", "<ul>", "<li>", "</ul>", "text", " ", "\n", "<a href=x>", "</a>", "<pre>", "</pre>", "<table>", "<tr>", "<td>", "</table>", "<h2>", "</h2>", "<br>", "<img src=i>", "<nav>", "</nav>", "&lt;"]), max_size=20)


@given(lines)
@settings(max_examples=150, deadline=None)
def test_blocks_hold_their_lines(parts):
    body = "\n".join(parts) + "\n"
    kept = body.splitlines(keepends=True)
    for b in M.blocks(body):
        assert 0 <= b.start < b.end <= len(kept) and b.text == "".join(kept[b.start:b.end])
    assert len({b.location for b in M.addressed(body)}) == len(M.addressed(body))


@given(lines, st.integers(1, 60))
@settings(max_examples=100, deadline=None)
def test_sections_partition(parts, most):
    body = "\n".join(parts)
    kept = body.splitlines(keepends=True)
    spans = M.sections(body, most)
    assert "".join("".join(kept[a:b]) for a, b in spans) == body


@given(lines)
@settings(max_examples=100, deadline=None)
def test_unlink_keeps_labels(parts):
    body = "\n".join(parts)
    out = M.unlink(body, M.references(body))
    assert "](https" not in re.sub(r"(?s)```.*|^    .*$", "", out, flags=re.M) or not M.references(out)


@given(tags)
@settings(max_examples=200, deadline=None)
def test_any_html_renders(parts):
    body, assets = H.render(H.parse("".join(parts)), "https://example.com/")
    assert body.endswith("\n") and body == H.normalized(body) and "\n\n\n" not in body
    assert all(a["url"].startswith("https://") for a in assets)


@given(st.text(alphabet="ab&;%25amp#x\\*", max_size=20))
@settings(max_examples=200, deadline=None)
def test_decoding_reaches_a_fixed_point(text):
    try:
        once = decoded(text, rounds=50)
    except ValueError:
        return
    assert decoded(once) == once


@given(st.text(alphabet="ab./\\:", max_size=12))
def test_safe_members_stay_inside(name):
    import posixpath

    if safe_member(name):
        joined = posixpath.normpath(posixpath.join("/root/x", name))
        assert joined.startswith("/root/x/")
