import hashlib

import pytest

from textkiln.functions import html as H
from textkiln.functions import markdown as M
from textkiln.functions.code import block_end, strip_blocks

CODE = 'resource "old_thing" "a" {\n  x = "}"  # }\n  nested {\n  }\n}\n\nresource "new_thing" "b" {\n  y = 1 /* { */\n}\n'


def test_blocks_end_at_their_brace():
    lines = CODE.split("\n")
    assert block_end(lines, 0) == 5 and block_end(lines, 6) == 9
    with pytest.raises(ValueError):
        block_end(["a {", "b"], 0)


def test_strip_blocks():
    assert strip_blocks(CODE, ("old_thing",)) == 'resource "new_thing" "b" {\n  y = 1 /* { */\n}\n'
    assert strip_blocks(CODE, ()) == CODE


def test_braces_in_strings_templates_and_here_documents():
    code = ['a "x" "y" {', '  s = "open { ${join("}", [for k in m : "${k}}"])} \\" {"', "  t = <<-EOT", "  } not code {{", "    EOT", "  u = {", "  }", "}", "b {}"]
    assert block_end(code, 0) == 8 and block_end(code, 8) == 9
    with pytest.raises(ValueError):
        block_end(["}"], 0)


def test_dependants_go_with_their_blocks():
    code = 'resource "old" "a" {\n}\n\nresource "new" "b" {\n  x = old.a.id\n}\n\nresource "new" "c" {\n  y = new.b.id\n}\n\nresource "new" "d" {\n  z = old.ab.id\n}\n'
    assert strip_blocks(code, ("old",), dependants=True) == 'resource "new" "d" {\n  z = old.ab.id\n}\n'
    assert 'resource "new" "b"' in strip_blocks(code, ("old",))
    with pytest.raises(ValueError):
        strip_blocks(code + "x = old.a.id\n", ("old",), dependants=True)


def test_clean_post():
    html = '<h1><a class="anchor" href="#r"></a>Routing</h1><p>Author: x</p><p>Text <span class="mention">@a</span></p><img class="emoji" src="e.png"><img width="16" height="16" src="i.png"><div class="lightbox-wrapper"><a class="lightbox" href="https://h/full.png"><img src="/small.png" alt="D"></a></div><button>b</button>'
    body, assets = H.render(H.clean_post(H.parse(html)), "https://h/t/1")
    assert body == "# Routing\n\nText\n\n![D](asset://00000000)\n"
    assert assets[0]["url"] == "https://h/full.png"


def test_cut_and_images():
    root = H.cut_at_heading(H.parse("<div><p>a</p><h2>More Content</h2><p>b</p></div><p>c</p>"), "more content")
    assert H.render(root, "")[0] == "a\n\nc\n"
    assert H.image_urls('<img src="/b.png"><img data-src="a.png"><img>', "https://h/x/") == ["https://h/b.png", "https://h/x/a.png"]


def test_remove_prose():
    body = "# T\n\nKeep this. Drop this. Keep too.\n\n```\nDrop this.\n```\n"
    at = body.index("Drop this.")
    sha = hashlib.sha256(b"Drop this.").hexdigest()
    assert M.remove_prose(body, [(at, at + 10, sha)]) == "# T\n\nKeep this. Keep too.\n\n```\nDrop this.\n```\n"
    with pytest.raises(ValueError):
        M.remove_prose(body, [(at, at + 9, sha)])
    code = body.rindex("Drop this.")
    with pytest.raises(ValueError):
        M.remove_prose(body, [(code, code + 10, sha)])
