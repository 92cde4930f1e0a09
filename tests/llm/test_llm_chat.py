"""The template language, and conversations formatted by it and read back."""

from __future__ import annotations

import random

import pytest

from fleetstate.llm import chat
from fleetstate.llm.template import TURN, Const, If, Output, TemplateError, Text, _operators, compile_template, escape, fold, parse, unescape

BITS = ["<", "role>", "text>", "/turn>", ">", "\\", "\\\\", "</turn>", "<role>", "<text>", "a", "\n", " "]


def render(source, controls=(), **names):
    return "".join(p[0] for p in compile_template(source, controls)(names) if p is not TURN)


@pytest.mark.parametrize(
    "source, expected",
    [
        ("a{{ 'b' | upper }}{# note #}c", "aBc"),
        ("{{ 1 + 2 }}{{ 'x' ~ 1 }}{{ name | trim | length }}", "3x11"),
        ("{% if name == 'no' %}1{% elif 'n' in name and not none %}2{% else %}3{% endif %}", "2"),
        ("{{ 'yes' if m.key == 'v' else 'no' }}{{ m['key'] }}{{ m.missing }}", "yesv"),
        ("{% set x = name | title %}{{ x }}", " N "),
        ("{% for m in items %}{{ loop.index0 }}{% if loop.first %}!{% endif %}{{ m }}{% endfor %}", "0!p1q"),
        ("a  {{- 'b' -}}  c", "abc"),
        ("{{ \"it's\" }}{{ 'a\\n' }}", "it'sa\n"),
    ],
)
def test_language(source, expected):
    assert render(source, name=" n ", m={"key": "v"}, items=["p", "q"]) == expected


@pytest.mark.parametrize(
    "source",
    ["{{ x.__class__() }}", "{{ open('f') }}", "{{ 1 }", "{% if x", "{% if x %}", "{% foo %}", "{{ x | eval }}", "{% endif %}", "{{ }}", "{{ a b }}",
     "{% for m in messages %}{% endfor %}{% for m in messages %}{% endfor %}"],
)
def test_what_is_not_in_the_language(source):
    with pytest.raises(TemplateError):
        compile_template(source)


def test_objects_have_no_attributes():
    assert render("{{ x.__class__ }}{{ x.real }}", x=5) == ""


def test_constants_are_folded():
    tree = fold(parse("{% if 'a' == 'a' %}x{{ 'y' | upper }}{{ 1 + 2 }}{% else %}{{ z }}{% endif %}w"), _operators(()))
    assert tree.items == (Text("xY3w"),)
    tree = fold(parse("{% if a and false %}x{% endif %}{{ a }}"), _operators(()))
    assert [type(x) for x in tree.items] == [If, Output]
    assert fold(parse("{{ true or a }}"), _operators(())).items == (Text("True"),)
    assert Const(1) == Const(1)


def test_escapes_are_reversible():
    rng = random.Random(1)
    write = compile_template(chat.TEMPLATE, chat.CONTROLS)
    for _ in range(5000):
        text = "".join(rng.choice(BITS) for _ in range(rng.randrange(9)))
        broken = escape(text, chat.CONTROLS)
        assert unescape(broken, chat.CONTROLS) == text and not any(c in broken for c in chat.CONTROLS)
        turns = [{"role": rng.choice(["user", "assistant", text]), "text": "".join(rng.choice(BITS) for _ in range(6))} for _ in range(3)]
        out = "".join(p[0] for p in write({"messages": iter(turns)}) if p is not TURN)
        assert list(chat.read_turns([out])) == [(t["role"], t["text"]) for t in turns]


def test_conversations_stream_through_parts(spark, monkeypatch):
    rng = random.Random(2)
    rows = [(c, t, rng.choice(["user", "assistant", "system", None]), "".join(rng.choice(BITS) for _ in range(rng.randrange(400))), "x")
            for c in (1, 2, None) for t in range(60)]
    rows += [(3, None, "user", None, "x"), (3, 0, "assistant", "", "x"), (3, 0, "assistant", "", "x"), (4, 0, "assistant", "y" * 200_000, "x")]
    rows += [(4, 1, "assistant", "é🙂", "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, part string").repartition(4)
    formatted = chat.format_conversations(df)
    assert formatted.filter("conv_id = 4").count() == 2
    found = {r.conv_id: r for r in chat.digests(formatted).collect()}
    import hashlib

    for conv in (1, 2, 3, 4, None):
        turns = sorted(((t is not None, t or 0, r or "", x or "") for c, t, r, x, _ in rows if c == conv))
        whole = "".join(f"{r}\n{x}\n" for _, _, r, x in turns)
        learned = "".join(x for _, _, r, x in turns if r == "assistant")
        assert found[conv].n_turns == len(turns)
        assert found[conv].turns_sha256 == hashlib.sha256(whole.encode()).hexdigest()
        assert (found[conv].loss_chars, found[conv].loss_sha256) == (len(learned), hashlib.sha256(learned.encode()).hexdigest())
    assert chat.digests(chat.format_conversations(df.limit(0))).collect() == []
