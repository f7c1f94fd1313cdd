import pytest

from textkiln.functions import html as H
from textkiln.functions import markdown as M

BASE = "https://example.com/docs/page"


def md(html, base=BASE):
    return H.render(H.parse(html), base)


@pytest.mark.parametrize("html, want", [
    ("<h1>A</h1><p>one <b>two</b> <i>three</i></p>", "# A\n\none **two** *three*\n"),
    ("<ul><li>a</li><li>b<ul><li>c</li></ul></li></ul>", "- a\n- b\n  - c\n"),
    ("<ol start=3><li>x</li><li>y</li></ol>", "3. x\n4. y\n"),
    ('<pre><code class="language-json">{"a": 1}</code></pre>', '```json\n{"a": 1}\n```\n'),
    ("<pre>a<br>b</pre>", "```\na\nb\n```\n"),
    ("<table><tr><th>a</th><th>b</th></tr><tr><td>1</td><td>2</td></tr></table>", "| a | b |\n| --- | --- |\n| 1 | 2 |\n"),
    ('<div class="callout"><strong>Warning</strong><p>Look.</p></div>', "> **Warning**\n>\n> Look.\n"),
    ('<a href="/x">to x</a>', "[to x](https://example.com/x)\n"),
    ("<p>5 < 6 * 7_8</p>", "5 \\< 6 \\* 7\\_8\n"),
    ("<blockquote><p>q</p></blockquote>", "> q\n"),
    ("<p>a<br>b</p>", "a\nb\n"),
    ("", "\n"),
])
def test_render(html, want):
    assert md(html)[0] == want


def test_chrome_and_images():
    body, assets = md('<nav>n</nav><main><p>t</p><img src="a.png" alt="A"><img src="data:x"><img role=presentation src="b.png"><img src="c.png"></main><footer>f</footer><div class="Cookie-bar">c</div>')
    assert [a["placeholder"] for a in assets] == ["asset://00000000", "asset://00000003"]
    assert assets[0]["url"] == "https://example.com/docs/a.png"
    assert "f" not in body.replace("asset", "") and "c" not in body.split("asset")[0]


def test_unclosed_tags_nest():
    body, _ = md("<article><p><b>bold<br><p>next</p></article><p>after</p>")
    assert "next" in body and "after" in body


def test_classify():
    def verdict(html):
        root = H.parse(html)
        return H.classify("", root.strings(), H.page_measures(root))

    assert verdict("<a href=1>a</a><a href=2>b</a><a href=3>c</a>") == "navigation"
    assert verdict("<p>Sign in to continue</p>") == "auth_wall"
    assert verdict("<p>Page not found</p>") == "not_found"
    assert verdict("<p>text</p>" * 6) == "content"


BODY = "# A\n\npara [x](https://h/a) end\nmore\n\n- i\n  - j\n\n| a | b |\n|---|---|\n| 1 | 2 |\n\n```\n[no](https://h/n)\n```\n\n## B\n\nonly\n\n## B\n\n[r]: http://x\n"


def test_blocks_cover():
    b = M.blocks(BODY)
    kinds = [x.kind for x in b]
    assert kinds.count("heading") == 3 and kinds.count("section") == 3 and kinds.count("table_row") == 1 and kinds.count("fence") == 1 and kinds.count("reference") == 1
    lines = BODY.splitlines(keepends=True)
    assert all(x.text == "".join(lines[x.start:x.end]) for x in b)
    covered = {i for x in b for i in range(x.start, x.end)}
    assert all(i in covered for i, line in enumerate(lines) if line.strip())
    assert len({x.location for x in M.addressed(BODY)}) == len(b)


def test_references_and_edits():
    refs = M.references(BODY)
    assert [r["url"] for r in refs] == ["https://h/a"]
    assert "para x end" in M.unlink(BODY, refs)
    with pytest.raises(ValueError):
        M.unlink("#" + BODY, refs)
    only = next(b for b in M.blocks(BODY) if b.text == "only\n")
    out = M.remove_blocks(BODY, [(only.location, only.sha256)])
    assert out.count("## B") == 1  # the section that it left empty goes too
    with pytest.raises(ValueError):
        M.remove_blocks(BODY, [(only.location, "0")])


def test_sections_are_lossless():
    lines = BODY.splitlines(keepends=True)
    for most in (1, 30, 10_000):
        spans = M.sections(BODY, most)
        assert "".join("".join(lines[a:b]) for a, b in spans) == BODY


def test_anchors():
    assert {"a", "b", "b-1"} <= M.anchors(BODY)


def test_sections_left_without_content_go_and_empty_ones_stay():
    body = "# A\n\ntext\n\n## Empty before\n\n## B\n\ngone\n\n---\n\n### C\n\n## D\n\nstays\n"
    gone = next(b for b in M.blocks(body) if b.kind == "paragraph" and b.text.strip() == "gone")
    assert M.remove_blocks(body, [(gone.location, gone.sha256)]) == "# A\n\ntext\n\n## Empty before\n\n## D\n\nstays\n"
    with pytest.raises(ValueError):
        M.remove_blocks(body, [(gone.location, gone.sha256)] * 2)
    assert M.remove_blocks(body, []) == body
